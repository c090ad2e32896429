from __future__ import annotations

import random

from strandloom.llm import splits
from strandloom.llm.splits import assign_splits, choose, choose_all, related_groups, split_chunks
from strandloom.operators.components import components


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_components_agree_with_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randint(1, 60), rng.randint(1, 60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7), (None, 3)]
    parent = {x: x for e in edges for x in e if None not in e}
    for u, v in edges:
        if u is not None:
            a, b = sorted((find(parent, u), find(parent, v)))
            parent[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: find(parent, x) for x in parent}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


CHUNK = "chunk_id bigint, species string, chrom string, begin bigint, end bigint, strand string, seq string, size int"
SEQ = "species string, chrom string, length bigint"


def tables(spark, n=300, seed=5):
    rng = random.Random(seed)
    chunks = []
    for i in range(1, n + 1):
        b = rng.choice([None, rng.randint(0, 900), rng.randint(0, 900)]) if i % 7 == 0 else rng.randint(0, 900)
        chunks.append((i, rng.choice(["s", "s", "t", None]), rng.choice(["1", "1", "2", "zz", None]), b, None if b is None else b + rng.choice([1, 2, 3, 40]), rng.choice(["forward", "backward", None]), "A", 0))
    return chunks, [("s", "1", 1000), ("s", "2", 950), ("t", "1", 1000), ("t", "2", 1000)]


def brute(chunks, seqs):
    length, iv = {(s, c): n for s, c, n in seqs}, {}
    for i, s, c, b, e, strand, *_ in chunks:
        if None in (s, c, b, e):
            continue
        if strand == "backward":
            if (s, c) not in length:
                continue
            b, e = length[s, c] - e, length[s, c] - b
        iv[i] = (s, c, b, e)
    parent = {i: i for i in iv}
    ids = sorted(iv)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if iv[i][:2] == iv[j][:2] and iv[i][2] < iv[j][3] and iv[j][2] < iv[i][3]:
                a, b = sorted((find(parent, i), find(parent, j)))
                parent[b] = a
    groups = {}
    for i in ids:
        groups.setdefault(find(parent, i), []).append(i)
    return {i: g for g, m in groups.items() if len(m) > 1 for i in m}, {i: g for g, m in groups.items() for i in m}


def test_groups_and_splits(spark):
    chunks, seqs = tables(spark)
    c, s = spark.createDataFrame(chunks, CHUNK), spark.createDataFrame(seqs, SEQ)
    want, every = brute(chunks, seqs)
    assert {r.chunk_id: r.group_id for r in related_groups(c, s).collect()} == want
    split = {r.chunk_id: r.split for r in split_chunks(c, s).collect()}
    assert sorted(split) == [x[0] for x in chunks]
    for i, g in every.items():
        assert split[i] == split[g]
    share = {k: list(split.values()).count(k) / len(chunks) for k in ("train", "validation", "test")}
    assert abs(share["validation"] - 0.1) < 0.02 and abs(share["test"] - 0.1) < 0.02


def test_empty_tables(spark):
    c, s = spark.createDataFrame([], CHUNK), spark.createDataFrame([], SEQ)
    assert related_groups(c, s).collect() == [] and split_chunks(c, s).collect() == []


def subset_sums(sizes):
    reach = {0}
    for s, m in sizes.items():
        reach = {r + s * k for r in reach for k in range(m + 1)}
    return reach


def test_choose_is_as_close_as_any_subset():
    rng = random.Random(2)
    cases = [({25: 5, 23: 4, 9: 10}, 92)]
    for _ in range(1500):
        sizes = {rng.randint(1, 30): rng.randint(1, 10) for _ in range(rng.randint(1, 5))}
        cases.append((sizes, rng.randint(0, sum(s * m for s, m in sizes.items()))))
    for sizes, target in cases:
        got = choose(sizes, target)
        assert all(got[s] <= sizes[s] for s in got)
        assert abs(sum(s * k for s, k in got.items()) - target) == min(abs(r - target) for r in subset_sums(sizes)), (sizes, target)


def test_choose_with_a_small_table(monkeypatch):
    monkeypatch.setattr(splits, "MOST_BITS", 64)
    rng = random.Random(5)
    for _ in range(300):
        sizes = {rng.randint(2, 60): rng.randint(1, 8) for _ in range(rng.randint(1, 5))}
        total = sum(s * m for s, m in sizes.items())
        target = rng.randint(0, total // 2)
        got = choose(sizes, target)
        assert all(got[s] <= sizes[s] for s in got) and abs(sum(s * k for s, k in got.items()) - target) <= max(sizes)


def test_two_targets_are_chosen_together():
    rng = random.Random(3)
    for _ in range(150):
        sizes = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(rng.randint(1, 4))}
        total = sum(s * m for s, m in sizes.items())
        targets = [rng.randint(0, total // 3), rng.randint(0, total // 3)]
        reach = {(0, 0)}
        for s, m in sizes.items():
            reach = {(v + s * i, t + s * j) for v, t in reach for i in range(m + 1) for j in range(m + 1 - i)}
        got = choose_all(sizes, targets)
        assert all(got[0].get(s, 0) + got[1].get(s, 0) <= m for s, m in sizes.items())
        off = sum(abs(sum(s * k for s, k in g.items()) - t) for g, t in zip(got, targets))
        assert off == min(abs(v - targets[0]) + abs(t - targets[1]) for v, t in reach), (sizes, targets)


def test_assign_keeps_quota(spark):
    g = spark.createDataFrame([(i, 1 if i > 20 else 5) for i in range(220)], "root bigint, size bigint")
    got = assign_splits(g, {"a": 0.25, "b": 0.5}, "c", buckets=7).join(g, "root").groupBy("split").sum("size").collect()
    total = 21 * 5 + 199
    assert {r[0]: r[1] for r in got} == {"a": round(total / 4), "b": round(total / 2), "c": total - round(total / 4) - round(total / 2)}
