from __future__ import annotations

import random

from strandloom.llm import mojibake as mb

WORDS = {
    "fr": "la crème été où garçon même théâtre pour dans après forêt noël".split(),
    "ru": "город новый после школа земля народ год красный вода дом".split(),
    "en": "the harbour meeting was held on market day and it’s “quite” fine".split(),
}


def corpus(n=900, seed=6):
    rng, rows, bad = random.Random(seed), [], {}
    for i in range(n):
        lang = rng.choice(list(WORDS))
        lines = [" ".join(rng.choice(WORDS[lang]) for _ in range(7)) for _ in range(5)]
        text = "\n".join(lines)
        if i % 9 == 0:
            way = rng.choice([("utf-8", "cp1252"), ("utf-8", "latin-1")] + ([("cp1251", "koi8-r")] if lang == "ru" else []))
            k = rng.randrange(5)
            if any(ord(c) > 127 for c in lines[k]):
                lines[k] = mb._through(lines[k], (way,))
                bad[i] = text
                text = "\n".join(lines)
        rows.append((i, text, rng.choice(["a", "b", None]), "extra"))
    return rows, bad


def test_garbled_pages_are_found_and_restored(spark):
    rows, bad = corpus()
    rows += [(5000, None, "a", "x"), (5001, "", None, "x"), (5002, "  \n", "a", "x"), (5003, "lost � here", "a", "x"), (5004, "é" * 3000, "b", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_garbled string")
    got = {r.doc_id: r for r in mb.repaired(df, "doc_id").collect()}
    assert 5003 in got and got[5003].n_restored == 0
    found = set(got) - {5003}
    assert len(found & set(bad)) >= 0.97 * len(bad) and len(found - set(bad)) <= 2
    assert sum(got[i].text == bad[i] for i in found & set(bad)) >= 0.95 * len(bad)


def test_empty_table(spark):
    assert mb.repaired(spark.createDataFrame([], "doc_id bigint, text string, source string"), "doc_id").collect() == []


def test_undo_reverses_every_chain():
    for chain in mb.CHAINS:
        for text in ("é", "ß", "ж", "λ", "ł", "abc"):
            image = mb._through(text[0], chain) if len(text) == 1 else "".join(mb._through(c, chain) for c in text)
            if image is not None:
                assert mb.undo(image, chain) == text


def test_one_line_of_a_rare_codec_is_restored(spark):
    rng = random.Random(3)
    words = WORDS["en"] + "für wäre größe schön über käse".split()
    rows = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(7)) for _ in range(5)), "a") for i in range(600)]
    german = "für wäre schön über käse größe"
    cyrillic = [(1000 + i, " ".join(rng.choice(WORDS["ru"]) for _ in range(30)), "b") for i in range(100)]
    bad = {}
    for k, (text, read) in enumerate([(german, "iso8859-15"), (WORDS["ru"][0] + " народ школа земля", "cp1254"), (WORDS["ru"][1] + " народ школа земля", "koi8-u")]):
        bad[2000 + k] = text
        rows.append((2000 + k, "".join(mb._through(c, (("utf-8", read),)) for c in text), "a"))
    df = spark.createDataFrame(rows + cyrillic, "doc_id bigint, text string, source string")
    assert {r.doc_id: r.text for r in mb.repaired(df, "doc_id").collect()} == bad


def test_skipped_lines_cannot_be_garbled(monkeypatch):
    import numpy as np

    rows, _ = corpus(200)
    texts = [r[1] for r in rows]
    cls, n_lines = mb.classes_of(texts)
    codes, line = mb.transitions(cls)
    seen, counts = np.unique(codes, return_counts=True)
    pools = np.zeros(n_lines.sum(), np.int64)
    model = mb.next_model(True, seen, counts.astype(float), np.bincount(cls, minlength=mb.N).astype(float), np.ones(mb.POOLS), None)

    def judged():
        lines, clean, (number, chain, p) = mb.posteriors(model, codes, line, pools)
        assert np.allclose(clean + np.bincount(number, p, len(lines)), 1, atol=1e-3)
        return dict(zip(lines.tolist(), clean)), {(int(lines[k]), int(c)): q for k, c, q in zip(number, chain, p)}

    some, chains = judged()
    for name in ("ODDS", "LEAST_GROUP", "LEAST_ENTRY"):
        monkeypatch.setattr(mb, name, -1e9)
    full, every = judged()
    assert len(some) < len(full) and all(full[x] > 0.9 for x in set(full) - set(some))
    assert all(abs(some[x] - full[x]) < 0.02 for x in some) and all(abs(q - every[x]) < 0.02 for x, q in chains.items())


def test_a_wholly_garbled_source_of_a_third_of_the_rows(spark):
    rng = random.Random(2)
    for way in (("utf-8", "cp1252"), ("cp1251", "koi8-r"), ("cp1250", "cp1252")):
        own = {"cp1250": "příliš žluťoučký kůň úpěl ďábelské ódy městě řeka".split(), "cp1251": WORDS["ru"]}.get(way[0], WORDS["fr"])
        rows, bad = [], {}
        for i in range(600):
            text = "\n".join(" ".join(rng.choice(own if i % 2 or i % 3 == 0 else WORDS["en"]) for _ in range(7)) for _ in range(3))
            if i % 3 == 0:
                bad[i], text = text, "".join(mb._through(c, (way,)) or c for c in text)
            rows.append((i, text, "abc"[i % 3]))
        got = {r.doc_id: r.text for r in mb.repaired(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "doc_id").collect()}
        assert len(set(got) & set(bad)) >= 0.97 * len(bad) and len(set(got) - set(bad)) <= 2, way
        assert sum(got.get(i) == t for i, t in bad.items()) >= 0.95 * len(bad), way


def test_sources_of_one_language_each_are_clean(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(WORDS[("fr", "ru", "en")[i % 3]]) for _ in range(20)), "abc"[i % 3]) for i in range(600)]
    assert mb.repaired(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "doc_id").count() == 0
