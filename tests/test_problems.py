"""The general problems on small tables: brute force, nulls, ties, empty tables, clashing extra columns."""

from __future__ import annotations

import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strandloom.functions.attributes import byte_rows, split_values
from strandloom.operators import bad_rows
from strandloom.operators.bad_rows import cheapest_parses, rejected_lines, valid_lines
from strandloom.operators.hierarchy import hierarchy
from strandloom.operators.multivalue import explode_values, pick_values
from strandloom.operators.components import components
from strandloom.operators.skew import skew_join
from strandloom.operators.sweep import coverage_segments
from strandloom.operators.tree_agg import heavy_keys, tree_aggregate
from tests.brute import attribute_values
from tests.brute import hierarchy as brute_hierarchy


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- p1


def test_tree_aggregate_agrees_with_group_by(spark):
    rng = random.Random(1)
    data = [("a" if rng.random() < 0.6 else rng.choice(["b", None]), rng.choice([None, 1, 2, 7]), i) for i in range(500)]
    df = spark.createDataFrame(data, "k string, v bigint, __node bigint").repartition(5)
    got = tree_aggregate(df, ["k"], {"n": ("count_all", None), "c": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v"), "d": ("count_distinct", "v")}, chunk_rows=7, fan_in=3)
    want = []
    for k in {x[0] for x in data}:
        v = [x[1] for x in data if x[0] == k and x[1] is not None]
        want.append((k, sum(x[0] == k for x in data), len(v), sum(v), min(v), max(v), sum(v) / len(v), len(set(v))))
    assert rows(got) == sorted(want, key=repr)


def test_tree_aggregate_empty_and_one_key(spark):
    none = spark.createDataFrame([], "k string, v bigint")
    assert tree_aggregate(none, ["k"], {"n": ("count_all", None)}).collect() == []
    one = spark.createDataFrame([("x", None)] * 9, "k string, v bigint")
    assert rows(tree_aggregate(one, ["k"], {"s": ("sum", "v"), "d": ("count_distinct", "v")}, 2, 2)) == [("x", None, 0)]


def test_heavy_keys_count_null_rows_in_total_only(spark):
    df = spark.createDataFrame([("a", "x")] * 4 + [(None, "x")] * 90 + [("b", "y")] * 3 + [("c", None)] * 3, "s string, c string")
    assert rows(heavy_keys(df, ["s", "c"], 4, 100)) == [("a", "x")]


# ---- p2


ATTR = st.text(alphabet="ab=;,| \"'\\.\t%", max_size=24)


def values_of(fields):
    r, p, k, v, broken = split_values(*byte_rows(pa.array(fields, pa.string())))
    out = [[] for _ in fields]
    for a in zip(r, p, k, v):
        out[a[0]].append((a[1], a[2].decode(), a[3].decode()))
    return out, broken


@settings(max_examples=300, deadline=None)
@given(st.lists(ATTR, min_size=1, max_size=5))
def test_tokenizer_agrees_with_brute_force(fields):
    got, broken = values_of(fields)
    for f, g, b in zip(fields, got, broken):
        want, ok = attribute_values(f)
        assert bool(b) == (not ok)
        if ok:
            assert g == want


def test_tokenizer_cases():
    got, _ = values_of([None, "", ".", ";;", "Alias=", "x", "ID = 'a;b' ; Note=\"say \\\"hi\\\"\"\"!\"|z, w", "é \"ü|\" ;k v w"])
    assert got[:6] == [[]] * 6
    assert got[6] == [(1, "ID", "a;b"), (2, "Note", 'say "hi""!'), (3, "Note", "z"), (4, "Note", "w")]
    assert got[7] == [(1, "é", "ü|"), (2, "k", "v w")]


def test_brackets_protect_separators():
    r, p, k, v, _ = split_values(*byte_rows(pa.array(["k=f(a,b),c;j=[x;(y]"])), brackets="()[]")
    assert list(zip(k, v))[:2] == [(b"k", b"f(a,b)"), (b"k", b"c")]


def test_long_field_and_repeated_rows(spark):
    long = ";".join(f"k{i}={i}" for i in range(5000))
    df = spark.createDataFrame([(1, long, "x"), (2, "a=1", "x"), (2, "a=1", "x"), (3, None, None)], "id bigint, f string, pos string")
    got = explode_values(df, "id", "f")
    assert got.count() == 5002 and got.filter("id = 1 and pos = 4999 and attr_key = 'k4998'").count() == 1
    assert explode_values(df.limit(0), "id", "f").collect() == []
    assert rows(pick_values(df.filter("id > 1"), "f", ["a", "b"], "v_").select("id", "v_a", "v_b")) == [(2, "1", None), (2, "1", None), (3, None, None)]


# ---- p3


def test_hierarchy_agrees_with_brute_force(spark):
    rng = random.Random(4)
    for n in (1, 90):
        parent = {i: rng.choice([None, i, rng.randint(0, n + 3), rng.randint(0, n), max(0, i - 1)]) for i in range(1, n + 1)}
        df = spark.createDataFrame(list(parent.items()), "node bigint, parent bigint")
        got = {r.node: (r.root, r.depth, r.n_desc) for r in hierarchy(df, 3).collect()}
        assert got == brute_hierarchy(parent)


def test_hierarchy_with_a_hot_parent(spark, monkeypatch):
    import strandloom.operators.hierarchy as h

    parent = {1: None} | {i: 1 for i in range(2, 80)} | {i: i - 78 for i in range(80, 150)} | {200: 200, 201: 200, 202: 201}
    df = spark.createDataFrame(list(parent.items()), "node bigint, parent bigint")
    monkeypatch.setattr(h, "SHARE", 10)
    monkeypatch.setattr(h, "SALTS", 3)
    got = {r.node: (r.root, r.depth, r.n_desc) for r in hierarchy(df, 2).collect()}
    assert got == brute_hierarchy(parent)


def test_hierarchy_paths_circles_and_empty(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 1, "x"), (3, 2, "x"), (4, 5, "x"), (5, 4, "x"), (6, 5, "x"), (7, 99, "x")], "node bigint, parent bigint, depth string")
    got = {r.node: (r.path, r.on_circle) for r in hierarchy(df).collect()}
    assert got == {1: ([1], False), 2: ([1, 2], False), 3: ([1, 2, 3], False), 4: (None, True), 5: (None, True), 6: (None, False), 7: ([7], False)}
    assert hierarchy(spark.createDataFrame([], "node bigint, parent bigint")).collect() == []


def test_skew_join_is_a_join(spark):
    many = spark.createDataFrame([("h", i) for i in range(300)] + [("c", 1), (None, 2), ("z", 3)], "k string, i bigint")
    one = spark.createDataFrame([("h", "H"), ("c", "C"), ("q", "Q")], "k string, v string")
    for how in ("left", "inner"):
        assert rows(skew_join(many, one, ["k"], how, salts=4, share=10, least=50)) == rows(many.join(one, ["k"], how))


def test_components_of_large_ids_stars_and_chains(spark):
    big = 1 << 62
    edges = [(big + i, big + i + 1) for i in range(40)] + [(-big, -big + i) for i in range(1, 60)] + [(5, 5), (None, 7), (8, 9), (9, 8), (9, 10)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {big + i: big for i in range(41)} | {-big + i: -big for i in range(60)} | {5: 5, 8: 8, 9: 8, 10: 8}


def test_components_with_hot_parents(spark, monkeypatch):
    from strandloom.operators import components as c
    from strandloom.operators import skew

    rng = random.Random(8)
    edges = [(rng.randint(0, 3), i) for i in range(4, 120)] + [(i, i + 1) for i in range(200, 230)] + [(rng.randint(300, 330), rng.randint(300, 330)) for _ in range(25)]
    plain = {tuple(r) for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    monkeypatch.setattr(c, "hot_keys", lambda many, on, share=20, least=1: skew.hot_keys(many, on, 20, 1))
    monkeypatch.setattr(c, "skew_join", lambda many, one, on, how: skew.skew_join(many, one, on, how, 3, 20, 1))
    assert {tuple(r) for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()} == plain


# ---- p5


GOOD = "1\tens\texon\t5\t9\t.\t+\t.\t"


def test_lines_are_judged(spark):
    cases = {
        1: (GOOD + "ID=a", None), 2: (GOOD + "ID=a\r", None), 3: ("", "skip"), 4: ("  ", "skip"), 5: ("#x", "skip"), 6: ("track y", "skip"), 7: (None, "skip"),
        8: ("1\tens", "columns"), 9: (GOOD + "ID=a\tb", "columns"), 10: (GOOD + 'ID="a', "quoting"), 11: (GOOD + "ID='a'b", "quoting"), 12: (GOOD + "Note=3' end", None),
        13: ("?" + GOOD[1:] + "ID=a", "value"), 14: (GOOD.replace("5", "10") + "ID=a", "value"), 15: (GOOD.replace("5", "٥") + "ID=a", "value"),
        16: (GOOD + "word", "value"), 17: (GOOD + ".", None), 18: (GOOD + "", "value"), 19: ("\xa0" + GOOD + "ID=a", "value"), 20: (GOOD.replace("5", "9" * 30) + "ID=a", "value"),
        21: ("a" * 300_000, "columns"), 22: (GOOD + "ID=" + "x" * 300_000, None), 23: (GOOD + "=", "value"), 24: (GOOD + "ID=a\r\r", None), 25: (GOOD + "ID= \r", "value"), 26: ("track" + GOOD + "ID=a", "skip"),
    }
    df = spark.createDataFrame([(i, c[0], "r") for i, c in cases.items()], "line_id bigint, line string, reason string")
    assert rows(rejected_lines(df).select("line_id", "reason")) == sorted(((i, c[1]) for i, c in cases.items() if c[1] not in (None, "skip")), key=repr)
    good = valid_lines(df)
    assert sorted(r.line_id for r in good.collect()) == [i for i, c in cases.items() if c[1] is None]
    assert dict(good.dtypes)["start"] == "bigint"
    assert rejected_lines(df.limit(0)).collect() == [] and valid_lines(df.limit(0)).collect() == []


def edited(text, edits):
    """text after the named edits, whose places count in the text as it was."""
    out, names = list(text), {"tab": "\t", "separator": ";"}
    quotes = iter([])
    for e in reversed(edits):
        op, what, _, at = e.split()
        if op == "delete":
            del out[int(at) - 1]
        else:
            out.insert(int(at) - 1, names.get(what) or next(quotes))
    return "".join(out)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="a=; \"'\\", max_size=8))
def test_edits_of_a_field_are_least(field):
    cost, edits = cheapest_parses([field.encode()], ninth=True)[0]
    whole = lambda f: attribute_values(f)[1]
    near, best = {field}, 0
    while not any(map(whole, near)) and best < 2:
        best += 1
        near = {f[:i] + q + f[i:] for f in near for i in range(len(f) + 1) for q in "\"';"} | {f[:i] + f[i + 1 :] for f in near for i in range(len(f)) if f[i] in "\"';"}
    assert cost == len(edits) and (cost == best if any(map(whole, near)) else cost > best)
    if all("insert quote" not in e for e in edits):
        assert whole(edited(field, edits))


def test_tabs_are_put_where_columns_fit():
    good = "1\tens\texon\t5\t9\t.\t+\t.\tID=a"
    one = lambda line: cheapest_parses([line.encode()])[0]
    assert one(good) == (0, [])
    assert one("1\tens\texon\t5\tx\t9\t.\t+\t.\tID=a")[0] == 1
    split = "1\tens\tex\ton\t5\t9\t.\t+\t.\tID=a"
    assert one(split)[0] == 1 and edited(split, one(split)[1]).split("\t")[3:] == good.split("\t")[3:]
    assert one("1\tens\texon\t5\t9\t.\t+\tID=a")[0] == 1 and edited("1\tens\texon\t5\t9\t.\t+.\tID=a", one("1\tens\texon\t5\t9\t.\t+.\tID=a")[1]) == good
    assert one(good + "\t" + good)[0] == 9
    # a broken quote in a line of ten fields: one tab and one quote
    assert sorted(e.split(" at")[0] for e in one("1\tens\tex\ton\t5\t9\t.\t+\t.\tID='a")[1]) == ["delete quote", "delete tab"]
    # every tab is edited before a quote is, so reasons follow from the edits
    for line in (good + '"\'"', good + '="x"y "z\'', "\t" * 3, "a", "\t" * 12):
        edits = one(line)[1]
        assert sum("tab" in e for e in edits) == abs(line.count("\t") - 8)


def test_the_parse_states_the_reason(monkeypatch):
    import pyarrow as pa

    lines = ["a\tb", GOOD + "ID='a"]
    batch = pa.record_batch(
        [pa.array([1, 2]), pa.array(lines), pa.array([2, 9], pa.int32()), pa.array([None, "ID='a"]), pa.array(["start", None]), pa.array([False, False])], names=["id", "line", "n", "ninth", "fails", "first"]
    )
    assert [v[0] for v in bad_rows._judge(batch)] == ["columns", "quoting"]
    monkeypatch.setattr(bad_rows, "cheapest_parses", lambda texts, ninth=False: [(0, [])] * len(texts))
    assert "columns" not in [v[0] for v in bad_rows._judge(batch)]


def test_a_line_of_many_tabs_is_quick():
    import time

    began = time.process_time()
    cost, edits = cheapest_parses([b"\t" * 10_000])[0]
    assert cost == len(edits) == 10_000 - 8 and time.process_time() - began < 1


# ---- p6


def brute_segments(data, max_gap):
    out, by = [], {}
    for k, s, e in data:
        if s is not None and e is not None and s <= e:
            by.setdefault(k, set()).update(range(s, e + 1))
    for k, bases in by.items():
        runs = []
        for b in sorted(bases):
            if runs and runs[-1][1] == b - 1:
                runs[-1][1] = b
            else:
                runs.append([b, b])
        out += [(k, "period", a, z) for a, z in runs]
        out += [(k, "gap", p[1] + 1, q[0] - 1) for p, q in zip(runs, runs[1:]) if q[0] - p[1] - 1 <= max_gap]
    return sorted(out, key=repr)


def test_segments_agree_with_brute_force(spark):
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), s, s + rng.randint(-2, 9)) for s in (rng.randint(1, 400) for _ in range(120))] + [("a", None, 5), ("a", 3, None), ("c", 7, 7), ("c", 7, 7), ("c", 8, 9)]
    df = spark.createDataFrame([(*x, "t") for x in data], "k string, start bigint, end bigint, __p string")
    assert rows(coverage_segments(df, ["k"], "start", "end", 12, bin_bits=4)) == brute_segments(data, 12)
    assert coverage_segments(df.limit(0), ["k"], "start", "end").collect() == []


def test_short_and_long_parses_cost_the_same(monkeypatch):
    """The costs of short texts fit 32 bits: no unreachable cost may turn negative."""
    from strandloom.operators import bad_rows as br

    texts = [b"", b"\t", b"a\tb", b'c\ts\tt\t1\t2\t.\t+\t.\tID="x', b'c\ts\tt\t1\t2\t.\t+\t.\tID="x"y;k=\'', b"\t" * 30 + b"'", b"x" * 50, b'"' * 40]
    short = br.cheapest_parses(texts)
    monkeypatch.setattr(br, "SHORT", 0)
    assert br.cheapest_parses(texts) == short
