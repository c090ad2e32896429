"""Text decoded with the wrong encoding: find it and restore it (problem 9).

Every line has a latent chain of wrong decodings (none, or: written in one encoding, read in another, up to three
times). Expectation-maximization over all lines of all records estimates a bigram model of clean text and, per source
and field, how often each chain occurs. A chain's model of garbled text is the clean model pushed through the chain,
so weak evidence in one line is pooled with that of all others; each record is then repaired by its posterior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.session import drop_table, materialize

#: Public 8-bit codecs that texts were written in or read with; UTF-8 as written encoding goes with each of them.
READ_AS = ["cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "cp437", "cp850", "cp852", "mac-roman", "mac-cyrillic", "cp1253", "iso8859-7", "iso8859-5", "cp737", "iso8859-15", "cp1254", "cp1257", "iso8859-9", "koi8-u", "cp855", "mac-greek", "mac-latin2"]
#: Families of 8-bit codecs that are mistaken for each other (same script), and those any of them is read as.
FAMILIES = [["cp1252", "mac-roman", "cp437", "cp850", "iso8859-15"], ["cp1250", "iso8859-2", "cp852", "mac-latin2"], ["cp1251", "koi8-r", "cp866", "iso8859-5", "mac-cyrillic", "cp855"], ["cp1253", "iso8859-7", "cp737", "mac-greek"]]
WESTERN = ["cp1252", "latin-1", "cp437", "cp850", "mac-roman"]
#: Chains start with this share of the lines; sources are pooled into this many priors; rounds of EM at most.
START_SHARE, POOLS, ROUNDS = 0.0005, 4096, 8
#: UTF-8 read as something else leaves pairs that clean text hardly has: up to this share of a character's occurrences
#: may have been garbled in one way.
MOST = 0.2
#: Pools with more than this share of the rows are first judged by the clean text of all others: were one wrongly
#: decoded throughout, its own text would make that look clean. EM ends when the chains' lines change less than SETTLED.
HEAVY, SETTLED = 0.1, 0.05
#: Share of clean lines in a pool, at least.
LEAST_CLEAN = 0.02
#: A line gets its posterior where an upper bound of the summed odds of all chains comes to this logarithm; a line is
#: garbled above 0, so none below can be. Of such a line, groups of chains whose bound shows them a tenth of that are
#: left out of the sum, and chains of odds under a thousandth,
#: or under a millionth of the line's most probable one.
ODDS, LEAST_GROUP, LEAST_ENTRY, LEAST_SHARE = -2.3, -4.6, -6.9, 1e-6
#: Chains of a garbled line that are tried for its repair have at least this posterior.
LEAST_CHAIN = 1e-3

#: ASCII is seen by class: lower, upper, digit, blank, line end, other.
_ASCII_CLASSES, _OTHER = 6, 6


def _byte_table(codec: str) -> list[str]:
    """Character of each byte; bytes without one stand for the control character of that number, as browsers do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


_TABLES = {c: _byte_table(c) for c in {*READ_AS, *WESTERN, *(c for f in FAMILIES for c in f)}}
_INVERSE = {c: {ch: b for b, ch in reversed(list(enumerate(t)))} for c, t in _TABLES.items()}


def _chains() -> list[tuple[tuple[str, str], ...]]:
    steps = [("utf-8", r) for r in READ_AS]
    for f in FAMILIES:
        steps += [(w, r) for w in f for r in dict.fromkeys(f + WESTERN) if r != w]
    one = [(s,) for s in dict.fromkeys(steps)]
    a, b = ("utf-8", "cp1252"), ("utf-8", "latin-1")
    return one + [(a, a), (b, b), (a, b), (b, a), (a, a, a), (b, b, b)]


CHAINS = _chains()


def _groups() -> tuple[np.ndarray, np.ndarray]:
    """Group of each chain by what was read as what, so that chains of a group say much the same of a transition, and
    part of the group by the last codec and the kind of the first."""
    script = {r: i for i, f in enumerate([[*FAMILIES[0], "latin-1", "cp1254", "iso8859-9"], *FAMILIES[1:]]) for r in f} | {"koi8-u": 2, "cp1257": 1}
    kinds = [(len(c) > 1, c[0][0] == "utf-8" or script[c[0][0]], script[c[-1][1]]) for c in CHAINS]
    parts = [(*k, c[-1][1]) for k, c in zip(kinds, CHAINS)]
    return tuple(np.array([sorted(set(x)).index(k) for k in x]) for x in (kinds, parts))


GROUP, PART = _groups()
#: Parts of each group, and chains of each part.
PARTS = [np.unique(PART[GROUP == g]) for g in range(GROUP.max() + 1)]
MEMBERS = [np.flatnonzero(PART == g) for g in range(PART.max() + 1)]


def _through(ch: str, chain) -> str | None:
    """What a character becomes on a chain; None if it cannot have been written so."""
    for written, read in chain:
        out = []
        for c in ch:
            if written == "utf-8":
                data = c.encode("utf-8", "surrogatepass")
            else:
                b = _INVERSE[written].get(c)
                if b is None:
                    return None
                data = bytes([b])
            out += [_TABLES[read][x] for x in data]
        ch = "".join(out)
    return ch


def undo(line: str, chain) -> str | None:
    """The text before the chain; characters lost on the way stay as U+FFFD. None if the line cannot come from it."""
    for written, read in reversed(chain):
        inv, data = _INVERSE[read], bytearray()
        for c in line:
            b = inv.get(c)
            if b is None:
                if c == "�":
                    b = 0xFF if written == "utf-8" else inv.get("?", 0x3F)
                elif written == "utf-8":
                    data += c.encode("utf-8", "surrogatepass")
                    continue
                else:
                    return None
            data.append(b)
        if written == "utf-8":
            line = bytes(data).decode("utf-8", "replace")
        else:
            line = "".join(_TABLES[written][b] for b in data)
    return line


#: Unicode blocks of the characters that are modelled one by one, besides those of the codecs: Latin, Greek, Cyrillic,
#: general punctuation, currency, letterlike signs and number forms, ligatures.
BLOCKS = [(0x80, 0x180), (0x370, 0x400), (0x400, 0x460), (0x490, 0x492), (0x2010, 0x2060), (0x20A0, 0x20C0), (0x2100, 0x2190), (0xFB00, 0xFB07)]


def _universe() -> dict[str, int]:
    chars = sorted({ch for t in _TABLES.values() for ch in t if ord(ch) > 127} | {chr(c) for a, b in BLOCKS for c in range(a, b)} | {"�"})
    return {ch: _OTHER + 1 + i for i, ch in enumerate(chars)}


_INDEX = _universe()
N = _OTHER + 1 + len(_INDEX)


def _class_table() -> np.ndarray:
    t = np.full(0x110000, _OTHER, np.uint16)
    for c in range(128):
        ch = chr(c)
        t[c] = 4 if ch == "\n" else 0 if ch.islower() else 1 if ch.isupper() else 2 if ch.isdigit() else 3 if ch.isspace() else 5
    for ch, i in _INDEX.items():
        t[ord(ch)] = i
    return t


_CLASS = _class_table()
_CONTROL = np.isin(np.arange(N), [_INDEX[chr(c)] for c in range(0x80, 0xA0)])


@dataclass
class Model:
    row: np.ndarray  # bigram code -> row of llr, -1 if it never occurred
    llr: list[np.ndarray]  # per part, rows x its chains: log-likelihood of the transition on the chain over that in clean text
    best: list[np.ndarray]  # per group, rows x its parts: the most that it says for any chain of the part
    most: np.ndarray  # rows x groups: the most that it says for any chain of the group
    prior: np.ndarray  # pools x chains: log share of the chain over that of clean lines
    part: np.ndarray  # pools x parts: logarithm of the part's summed shares over that of clean lines
    group: np.ndarray  # pools x groups: the same of the group


def _pushed():
    """Per chain: first and last character index of each character's image (-1: none), and pairs inside images."""
    got = []
    for chain in CHAINS:
        first, last = np.full(N, -1, np.int64), np.full(N, -1, np.int64)
        first[:_ASCII_CLASSES] = last[:_ASCII_CLASSES] = np.arange(_ASCII_CLASSES)
        owner, inner = [], []
        for ch, i in _INDEX.items():
            image = _through(ch, chain)
            if image is None:
                continue
            idx = [_INDEX.get(x, _OTHER) if ord(x) > 127 else int(_CLASS[ord(x)]) for x in image]
            first[i], last[i] = idx[0], idx[-1]
            for x, y in zip(idx, idx[1:]):
                owner.append(i)
                inner.append(x * N + y)
        got.append((first, last, np.array(owner, np.int64), np.array(inner, np.int64)))
    return got


def make_model(codes: np.ndarray, counts: np.ndarray, seen: np.ndarray, singles: np.ndarray, prior: np.ndarray) -> Model:
    """Model from the bigrams of clean text (codes, counts), all bigrams seen, and counts of single characters.

    The pairs inside the image of one character are taken off the clean counts as far as garbling explains them, so
    that lines not yet found garbled don't make their own garbling look clean; control characters are never clean.
    """
    row = np.full(N * N, -1, np.int32)
    row[seen] = np.arange(len(seen))
    a, b, ascii_left = codes // N, codes % N, singles[:_ASCII_CLASSES]
    smooth = 0.5

    def push(k: int, counts: np.ndarray):
        """Expected bigrams seen, and transitions by first character, of clean text on chain k."""
        first, last, owner, inner = _PUSHED[k]
        ok = (last[a] >= 0) & (first[b] >= 0)
        code, w = np.concatenate([last[a[ok]] * N + first[b[ok]], inner]), np.concatenate([counts[ok], singles[owner]])
        sums = np.bincount(code // N, w, N)
        sums[:_ASCII_CLASSES] = ascii_left
        at = row[code]
        return np.bincount(at[at >= 0], w[at >= 0], len(seen)), sums

    def log_p(g, sums):
        return np.log((g + smooth / N) / (sums[seen // N] + smooth))

    explained = np.zeros(len(seen))
    for _, _, owner, inner in _PUSHED:
        at = row[inner]
        np.maximum(explained, MOST * np.bincount(at[at >= 0], singles[owner][at >= 0], len(seen)), out=explained)
    counts = np.where(_CONTROL[a] | _CONTROL[b], 0, np.maximum(counts - explained[row[codes]], 0))
    clean = np.zeros(len(seen))
    clean[row[codes]] = counts
    sums = np.bincount(a, counts, N)
    sums[:_ASCII_CLASSES] = ascii_left
    base = log_p(clean, sums)
    llr = np.zeros((len(seen), len(CHAINS)), np.float32)
    for k in range(len(CHAINS)):
        llr[:, k] = log_p(*push(k, counts)) - base
    llr = [np.ascontiguousarray(llr[:, m]) for m in MEMBERS]
    top = np.stack([x.max(axis=1) for x in llr], axis=1) if len(seen) else np.zeros((0, len(MEMBERS)), np.float32)
    best = [np.ascontiguousarray(top[:, g]) for g in PARTS]
    summed = lambda x, sets: np.stack([np.logaddexp.reduce(x[:, m], axis=1) for m in sets], axis=1)
    part = summed(prior, MEMBERS)
    return Model(row, llr, best, np.stack([top[:, g].max(axis=1) for g in PARTS], axis=1), prior, part, summed(part, PARTS))


_PUSHED = _pushed()


def classes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes of the texts, each ended and the whole begun by a line end; the number of lines of each."""
    whole = "\n" + "\n".join(texts) + "\n"
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[points], np.array([t.count("\n") + 1 for t in texts])


def transitions(cls: np.ndarray):
    """Codes of the transitions that touch a character outside ASCII, and the line of each."""
    wide = cls >= _OTHER
    at = np.flatnonzero(wide[:-1] | wide[1:])
    ends = np.flatnonzero(cls == 4)
    # a transition belongs to the line of its non-ASCII character: lines lie between line ends
    line = np.searchsorted(ends, np.where(wide[at], at, at + 1), side="right") - 1
    return cls[at].astype(np.int64) * N + cls[at + 1], line


def _added(values: np.ndarray, rows: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per stretch of rows (start, number): the sum of their values."""
    first = np.cumsum(n) - n
    return np.add.reduceat(values[rows[np.arange(n.sum()) + np.repeat(starts - first, n)]], first, axis=0)


def posteriors(model: Model, codes: np.ndarray, line: np.ndarray, pool_of_line: np.ndarray):
    """(lines, probability of clean, (number in lines, chain, probability)) of the lines that could be garbled; all others
    are clean. The transitions come line by line. Chains that say next to nothing for a line, by the bounds of their
    group and part, have no entry there."""
    none = np.zeros(0, np.int64)
    rows = model.row[codes]
    known = np.flatnonzero(rows >= 0)
    rows, own = rows[known], line[known]
    if not len(rows):
        return none, np.zeros(0), (none, none, np.zeros(0))
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    n, lines = np.diff(np.append(starts, len(own))), own[starts]
    pools = pool_of_line[lines]
    bound = np.add.reduceat(model.most[rows], starts, axis=0) + model.group[pools]
    pick = np.flatnonzero(np.logaddexp.reduce(bound, axis=1) > ODDS)
    at, chain, odds = [none], [none], [np.zeros(0)]
    for g, parts in enumerate(PARTS):
        x = pick[bound[pick, g] > LEAST_GROUP]
        if not len(x):
            continue
        fine = _added(model.best[g], rows, starts[x], n[x]) + model.part[pools[x]][:, parts]
        for k, part in enumerate(parts):
            y = x[fine[:, k] > LEAST_GROUP]
            if len(y):
                score = _added(model.llr[part], rows, starts[y], n[y]) + model.prior[pools[y]][:, MEMBERS[part]]
                i, c = np.nonzero(score > LEAST_ENTRY)
                at.append(y[i])
                chain.append(MEMBERS[part][c])
                odds.append(score[i, c])
    at, chain, odds = np.concatenate(at), np.concatenate(chain), np.concatenate(odds)
    hit, number = np.unique(at, return_inverse=True)
    top = np.zeros(len(hit))  # logarithm of the odds of clean
    np.maximum.at(top, number, odds)
    p, clean = np.exp(odds - top[number]), np.exp(-top)
    whole = clean + np.bincount(number, p, len(hit))
    p, keep = p / whole[number], p > LEAST_SHARE
    return lines[hit], clean / whole, (number[keep], chain[keep], p[keep])


def posteriors_by(models: list[Model], slot: np.ndarray, codes: np.ndarray, line: np.ndarray, pool_of_line: np.ndarray):
    """The posteriors where each line is judged by the model of its pool's slot."""
    if len(models) == 1:
        return posteriors(models[0], codes, line, pool_of_line)
    own = slot[pool_of_line[line]]
    got = [posteriors(models[k], codes[own == k], line[own == k], pool_of_line) for k in range(len(models))]
    before = np.cumsum([0, *(len(g[0]) for g in got)])
    entries = [np.concatenate([g[2][x] + (before[k] if x == 0 else 0) for k, g in enumerate(got)]) for x in range(3)]
    return np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]), tuple(entries)


def _slices(column: pa.Array, chars: int = 1 << 20):
    """Row ranges of about this many characters."""
    sizes, begin, total = pa.compute.binary_length(column).to_numpy(zero_copy_only=False), 0, 0
    for i, s in enumerate(np.nan_to_num(sizes)):
        total += s
        if total > chars:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(column):
        yield begin, len(column)


def _pool(source, field_no):
    return F.pmod(F.xxhash64(F.coalesce(source, F.lit("")), F.lit(field_no)), F.lit(POOLS)).cast("int")


def _long(df: DataFrame, source: str, fields: list[str]) -> DataFrame:
    """(pool, text): all fields under each other."""
    parts = [df.select(_pool(F.col(source), i).alias("pool"), F.col(f).alias("text")).filter(F.col(f).isNotNull()) for i, f in enumerate(fields)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: One row per slice of texts: lines of each pool, transitions of its lines, and counts of single characters by slot.
_SLICE = T.StructType([
    T.StructField("pool", T.ArrayType(T.IntegerType())), T.StructField("size", T.ArrayType(T.IntegerType())), T.StructField("codes", T.ArrayType(T.IntegerType())),
    T.StructField("char", T.ArrayType(T.IntegerType())), T.StructField("seen", T.ArrayType(T.LongType())),
])


def _transition_table(texts: DataFrame, slot: np.ndarray) -> DataFrame:
    """The transitions of every line, written once: all that the rounds need of the texts. Lines without any stay with
    size 0, for they count as clean lines of their pool."""

    def run(batches):
        for b in batches:
            pools, column = b.column(0).to_numpy(), b.column(1)
            for lo, hi in _slices(column):
                cls, n_lines = classes_of(column.slice(lo, hi - lo).to_pylist())
                codes, line = transitions(cls)
                pool_of_line = np.repeat(pools[lo:hi], n_lines)
                line_of = np.minimum(np.cumsum(cls == 4) - 1, len(pool_of_line) - 1)
                char, seen = np.unique(slot[pool_of_line][line_of] * N + cls, return_counts=True)
                one = lambda x, kind: pa.array([x.tolist()], pa.list_(kind))
                size = np.bincount(line, minlength=len(pool_of_line))
                yield pa.record_batch(
                    [one(pool_of_line, pa.int32()), one(size, pa.int32()), one(codes, pa.int32()), one(char, pa.int32()), one(seen, pa.int64())], names=_SLICE.names
                )

    return materialize(texts.mapInArrow(run, _SLICE), "transitions")


def _summed(table: DataFrame, of_slice) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{kind: (keys, values)}: of_slice gives (kind, keys, values) for each row of a transition table; values are summed."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                pool, size, codes, char, seen = (b.column(k)[i].values.to_numpy(zero_copy_only=False) for k in range(5))
                for kind, keys, values in of_slice(pool.astype(np.int64), np.repeat(np.arange(len(size)), size), codes.astype(np.int64), char, seen):
                    keys, values = _sums(keys, values)
                    yield pa.record_batch([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(values.astype(np.float64))], names=["kind", "key", "value"])

    got = table.mapInArrow(run, "kind int, key bigint, value double").groupBy("kind", "key").agg(F.sum("value").alias("value")).toPandas()
    return {k: (g["key"].to_numpy(), g["value"].to_numpy()) for k, g in got.groupby("kind")}


def _filled(got, kind: int, size: int) -> np.ndarray:
    out = np.zeros(size)
    if kind in got:
        out[got[kind][0]] = got[kind][1]
    return out


def fit(df: DataFrame, source: str = "source", fields: tuple[str, ...] = ("text",), rounds: int = ROUNDS) -> Model:
    """Expectation-maximization over all rows of df. One pass over the texts writes the transitions of every line; each
    round reads those and adds up what garbled lines take from the clean counts. What the driver gets is bounded by the
    alphabet of the codecs squared (times 1 / HEAVY in the first round) and by POOLS x chains, whatever the corpus. Null
    sources share a pool."""
    spark = df.sparkSession
    texts = _long(df, source, list(fields))
    rows = texts.groupBy("pool").count().toPandas()
    heavy = rows["pool"][rows["count"] > HEAVY * rows["count"].sum()].to_numpy()
    slot = np.zeros(POOLS, np.int64)
    slot[heavy] = np.arange(len(heavy)) + 1
    table = _transition_table(texts, slot)

    def count(pool, line, codes, char, seen):
        yield 0, slot[pool[line]] * N * N + codes, np.ones(len(codes))
        yield 1, char, seen
        yield 2, pool, np.ones(len(pool))

    got = _summed(table, count)
    keys, values = got.get(0, (np.zeros(0, np.int64), np.zeros(0)))
    codes, inv = np.unique(keys % (N * N), return_inverse=True)
    counts = np.bincount(keys // (N * N) * len(codes) + inv, values, (len(heavy) + 1) * len(codes)).reshape(len(heavy) + 1, len(codes))
    singles = _filled(got, 1, (len(heavy) + 1) * N).reshape(-1, N)
    lines = _filled(got, 2, POOLS)
    # slot 0 is judged by all; a heavy pool, as long as nothing is known of it, by all others
    models = [next_model(True, codes, counts.sum(axis=0) - (counts[k] if k else 0), singles.sum(axis=0) - (singles[k] if k else 0), lines, None) for k in range(len(heavy) + 1)]
    counts, singles, before = counts.sum(axis=0), singles.sum(axis=0), None
    for _ in range(rounds - 1):
        shared = spark.sparkContext.broadcast(models)

        def expect(pool, line, codes, char, seen, shared=shared):
            at, clean, (number, chain, p) = posteriors_by(shared.value, slot, codes, line, pool)
            if not len(at):
                return
            yield 3, pool[at[number]] * len(CHAINS) + chain, p
            garbled = np.zeros(len(pool))
            garbled[at] = 1 - clean
            lost = garbled[line]
            some = np.flatnonzero(lost)
            yield 0, codes[some], lost[some]
            yield 1, codes[some] // N, lost[some]

        got = _summed(table, expect)
        taken, value = got.get(0, (np.zeros(0, np.int64), np.zeros(0)))
        clean = counts.astype(float)
        clean[np.searchsorted(codes, taken)] -= value
        kept = singles - _filled(got, 1, N)
        kept[:_OTHER] = singles[:_OTHER]
        share = _filled(got, 3, POOLS * len(CHAINS)).reshape(POOLS, len(CHAINS))
        models = [next_model(False, codes, np.maximum(clean, 0), np.maximum(kept, 0), lines, share)]
        shared.unpersist()
        now = share.sum(axis=0)
        if before is not None and np.abs(now - before).sum() <= SETTLED * now.sum():
            break
        before = now
    drop_table(table)
    return models[0]


def next_model(first: bool, codes, counts, singles, lines, share) -> Model:
    """Maximization: the model from clean bigrams, single characters, lines of each pool and lines of each chain."""
    if first:
        rate = np.full((POOLS, len(CHAINS)), START_SHARE)
    else:
        # a pool's shares lean on those of all pools with the weight of 200 lines
        overall = (share.sum(axis=0) + 1e-5 * lines.sum()) / max(lines.sum(), 1)
        rate = (share + 200 * overall) / (lines[:, None] + 200)
    rate = np.maximum(rate, 1e-12)
    prior = np.log(rate) - np.log(np.maximum(1 - rate.sum(axis=1, keepdims=True), LEAST_CLEAN))
    return make_model(codes, counts, codes, singles, prior)


def _sums(keys: np.ndarray, weight: np.ndarray):
    u, inv = np.unique(keys, return_inverse=True)
    return u, np.bincount(inv, weights=weight, minlength=len(u))


def judge(model: Model, texts: list[str], pools: np.ndarray):
    """Garbled lines of the texts: (text number, line number in it, chains by falling probability); without chains a
    line only has lost characters."""
    cls, n_lines = classes_of(texts)
    codes, line = transitions(cls)
    lines, clean, (number, chain, p) = posteriors(model, codes, line, np.repeat(pools, n_lines))
    bad: dict[int, list[int]] = {int(x): [] for x in lines[clean < 0.5]}
    for i in np.lexsort((chain, -p)).tolist():
        x = int(lines[number[i]])
        if x in bad and p[i] >= LEAST_CHAIN:
            bad[x].append(int(chain[i]))
    lost = _INDEX["�"]
    for x in np.unique(line[(codes // N == lost) | (codes % N == lost)]).tolist():
        bad.setdefault(x, [])
    first = np.concatenate([[0], np.cumsum(n_lines)])
    for x in sorted(bad):
        t = int(np.searchsorted(first, x, side="right")) - 1
        yield t, x - int(first[t]), bad[x]


def repair_line(line: str, chains: list[int]) -> str:
    """The line by its most probable chain, or by the next ones if that one loses characters."""
    best = None
    for k in chains:
        new = undo(line, CHAINS[k])
        if new is None:
            # a character that this chain cannot give stands in the line: undo the stretches between such characters
            new = "".join(x if u is None else u for x in _runs(line, CHAINS[k]) for u in [undo(x, CHAINS[k])])
        if new != line and new.count("�") <= line.count("�"):
            return new
        best = best or new
    return best or line


def repair_texts(model: Model, texts: list[str], pools: np.ndarray) -> dict[int, tuple[str, int, int]]:
    """{text number: (repaired text, garbled lines, lines restored)} for the texts with garbled lines."""
    got: dict[int, list] = {}
    for t, i, chains in judge(model, texts, pools):
        lines, garbled, restored = got.get(t) or (texts[t].split("\n"), 0, 0)
        new = repair_line(lines[i], chains)
        if new != lines[i] or "�" in lines[i]:
            restored += new != lines[i]
            lines[i] = new
            got[t] = [lines, garbled + 1, restored]
    return {t: ("\n".join(ls), g, r) for t, (ls, g, r) in got.items()}


def _runs(line: str, chain) -> list[str]:
    known, out = _INVERSE[chain[-1][1]], []
    for ch in line:
        ok = ch in known
        if out and ok == (out[-1][-1] in known):
            out[-1] += ch
        else:
            out.append(ch)
    return out


def repaired(df: DataFrame, id_col: str, text: str = "text", source: str = "source", model: Model | None = None) -> DataFrame:
    """(id_col, text, n_garbled, n_restored): the rows with at least one character from a wrong decoding, repaired.

    n_garbled counts lines with such characters, n_restored those that were changed; replacement characters stay.
    Null and empty texts never come out; repeated rows come out repeated; other columns are not read.
    """
    model = model or fit(df, source, (text,))
    shared = df.sparkSession.sparkContext.broadcast(model)
    out = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("text", T.StringType()), T.StructField("n_garbled", T.IntegerType()), T.StructField("n_restored", T.IntegerType())])

    def run(batches):
        m = shared.value
        for b in batches:
            for lo, hi in _slices(b.column(1)):
                got = repair_texts(m, b.column(1).slice(lo, hi - lo).to_pylist(), b.column(2).slice(lo, hi - lo).to_numpy())
                at = sorted(got)
                yield pa.record_batch(
                    [b.column(0).take(pa.array([lo + i for i in at], pa.int64())), pa.array([got[i][0] for i in at], pa.string()), pa.array([got[i][1] for i in at], pa.int32()), pa.array([got[i][2] for i in at], pa.int32())],
                    names=["id", "text", "n_garbled", "n_restored"],
                )

    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"), _pool(F.col(source), 0).alias("pool")).filter("text is not null and text <> ''")
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)
