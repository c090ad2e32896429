from __future__ import annotations

import random

from strandloom.llm import leaks as lk

SYL = ["ton", "ham", "wick", "ley", "bar", "gra", "mun", "sal", "hol", "rid", "per", "stone", "worth", "field"]


def words(rng, n):
    return [rng.choice(["the", "of", "a", "in", "was", "to", "market", "storm", "village", "train"]) if rng.random() < 0.3 else "".join(rng.choice(SYL) for _ in range(rng.randint(2, 4))) for _ in range(n)]


def spoiled(rng, w):
    out = []
    for x in w:
        if rng.random() < 0.08:
            i = rng.randrange(len(x))
            x = x[:i] + rng.choice("aeoctu") + x[i + 1 :]
        out.append(x.upper() if rng.random() < 0.05 else x + rng.choice(["", "", ",", "."]))
    return out


def lines(rng, w, width=6):
    got = []
    for i in range(0, len(w), width):
        line = " ".join(w[i : i + width])
        got.append(line)
    for i in range(len(got) - 1):
        if rng.random() < 0.4 and len(got[i + 1]) > 6:
            got[i], got[i + 1] = got[i] + " " + got[i + 1][:2] + "-", got[i + 1][2:]
    return got


def boxes_for(n, x=50):
    return [(x, 20 * i, x + 300, 20 * i + 14, None) for i in range(n)]


def corpus():
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, rng.randint(24, 50)))) for i in range(40)]
    rows, want = [], set()
    for d in range(240):
        w, kind = words(rng, 60), d % 6
        it = rng.randrange(40)
        iw = items[it][1].split()
        if kind == 0:
            want.add((d, it))
            part = spoiled(rng, iw)
        elif kind == 1:
            n = rng.randint(18, 24)
            k = rng.randint(0, len(iw) - n)
            want.add((d, it))
            part = spoiled(rng, iw[k : k + n])
        elif kind == 2:
            part = iw[:9]
        elif kind == 3:
            part = rng.sample(iw, len(iw))
        else:
            part = []
        ls = lines(rng, w[:30] + part + w[30:])
        if kind == 0 and d % 12 == 0:
            ls = ls[:8] + ["BARGAIN WEEK", "Apply at the counter"] + ls[8:]
        b = boxes_for(len(ls))
        if d % 4 == 1:
            half = len(ls) // 2
            left, right = list(zip(ls[:half], boxes_for(half))), list(zip(ls[half:], boxes_for(len(ls) - half, 600)))
            mixed = [p for i in range(max(len(left), len(right))) for p in ([left[i]] if i < len(left) else []) + ([right[i]] if i < len(right) else [])]
            ls, b = [p[0] for p in mixed], [p[1] for p in mixed]
        rows.append((d, "\n".join(ls), rng.choice(["s", None]), b, "x"))
    return items, rows, want


SCHEMA = "doc_id bigint, text string, source string, boxes array<struct<x0:int,y0:int,x1:int,y1:int,conf:float>>, item_id string"


def test_leaks_are_found(spark):
    items, rows, want = corpus()
    rows += [(900, None, "s", None, "x"), (901, "", "s", [], "x"), (902, "  ", None, [], "x"), (903, items[3][1] + "\n" + "word " * 20000, "s", [], "x")]
    want.add((903, 3))
    docs = spark.createDataFrame(rows, SCHEMA)
    its = spark.createDataFrame([*items, (77, None), (78, "")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in lk.leaked(docs, its).collect()}
    assert got <= want and len(got) >= 0.97 * len(want)


def test_items_in_blocks_and_empty_tables(spark, monkeypatch):
    items, rows, _ = corpus()
    docs = spark.createDataFrame(rows[:60], SCHEMA)
    its = spark.createDataFrame(items, "item_id bigint, text string")
    one = {tuple(r) for r in lk.leaked(docs, its).collect()}
    monkeypatch.setattr(lk, "BLOCK_CHARS", 3000)
    assert {tuple(r) for r in lk.leaked(docs, its).collect()} == one
    assert lk.leaked(docs.limit(0), its).collect() == [] and lk.leaked(docs, its.limit(0)).collect() == []


def test_edits():
    assert lk.edits(b"kitten", b"sitting") == 3 and lk.edits(b"", b"ab") == 2 and lk.edits(b"abc", b"abc") == 0
    assert lk.edits(b"abcdef", b"uvwxyz", 2) > 2


def test_repeated_walks_agree():
    a, _, s = lk.letters_of("the market of Graworton was held in the village hall today again and again")
    got = []
    for _ in range(2):
        lk.embed(a, s, 0, lambda k, who, h, ptr: got.append(h.copy()))
    assert len(got) == 2 * len(lk.LENGTHS) and all((x == y).all() for x, y in zip(got, got[len(lk.LENGTHS) :]))


def found(items, page):
    index = lk.make_index(list(enumerate(items)))
    return {i for _, i in lk.leaks_in(index, lk.opened(index), [page])}


def test_short_items_match_as_a_whole():
    rng = random.Random(3)
    pages = [" ".join(words(rng, 40)) for _ in range(30)]
    for n in range(1, 11):
        for _ in range(6):
            item = words(rng, n)
            page = rng.choice(pages) + " " + " ".join(w.upper() if rng.random() < 0.2 else w for w in item) + "\n" + rng.choice(pages)
            assert found([" ".join(item)], page) == {0}, item
    # a word of all but the last letters is no whole item; items of signs alone match nothing
    assert found(["grumble torpedo wick", "— §", ""], "they saw grumble xx wick — § and") == set()


def test_signs_count_as_words_of_the_stretch_they_touch():
    rng = random.Random(7)
    item = words(rng, 30)
    item[8] = "—"
    assert found([" ".join(item)], "before it was\n" + " ".join(item[2:17]) + "\nafter it") == {0}
    assert found([" ".join(item)], "before it was\n" + " ".join(item[12:23]) + "\nafter it") == set()


def test_recall_of_shortest_stretches_by_misread_letters():
    """Every page carries 15 to 20 words of one item; compared with what was put there, not with other seeds."""
    for rate, least in ((0.0, 0.99), (0.02, 0.96), (0.04, 0.93)):
        rng, hits = random.Random(int(rate * 100)), 0
        items = [words(rng, 30) for _ in range(60)]
        index = lk.make_index([(i, " ".join(w)) for i, w in enumerate(items)])
        sieves = lk.opened(index)
        for i, w in enumerate(items):
            n = 15 + i % 6
            part = " ".join(w[5 : 5 + n])
            part = "".join(rng.choice("aeoctul") if ch.isalpha() and rng.random() < rate else ch for ch in part)
            page = "\n".join([" ".join(words(rng, 12)), part[:40], " ".join(words(rng, 7)), part[40:], " ".join(words(rng, 30))]) if part[40:41] == " " else " ".join(words(rng, 12)) + "\n" + part + "\n" + " ".join(words(rng, 30))
            hits += i in {b for _, b in lk.leaks_in(index, sieves, [page])}
        assert hits >= least * len(items), (rate, hits)


def carried(item, page):
    """Words of the item that the page carries, by the exact check alone."""
    import numpy as np

    index = lk.make_index([(0, item)])
    letters, at, _ = lk.letters_of(page)
    line = np.cumsum(np.array([ch == "\n" for ch in page]))[at]
    return lk.stretch_words(index.items[0], letters, line)


def test_long_dense_matter_inside_a_leak():
    rng = random.Random(5)
    item = words(rng, 20)
    first, second = " ".join(item[:10]), " ".join(item[10:])
    for n in (25, 60, 400):
        # other matter of the same syllables, so that chance matches crowd in
        advert = [" ".join(words(rng, 5)) for _ in range(n)]
        assert carried(" ".join(item), "\n".join(["before it", first, *advert, second, "after it"])) >= 18
        assert carried(" ".join(item), "\n".join(["before it", first, *advert, "after it"])) < 15


def test_the_longest_chain_counts_even_if_others_score_more():
    # exact copies of 14 words score best, while the whole text stands there with misread letters
    rng = random.Random(9)
    item = ["".join(rng.choice("abcdefghknoprtuvwy") for _ in range(7)) for _ in range(14)] + ["an", "of", "to", "we"]
    part = " ".join(item[:14])
    whole = " ".join(w[:3] + "z" + w[4:] if i % 2 and i < 14 else w for i, w in enumerate(item))
    assert carried(" ".join(item), "\n".join([part, "xx"] * 5 + [whole])) >= 17
