"""Rows that fail to parse: valid lines as typed rows, the others with the reason (problem 5).

Each line gets the parse of least cost: one dynamic program over the states of all nine columns may insert or delete
tabs, quotes and separators. A tab costs more than any number of quotes and separators, and those more than any number
of ill-typed columns. A line that parses at cost zero and whose values have their types loads; for any other the edits
of its cheapest parse, or the value test that failed, state the reason.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.attributes import _TRANS, JUNK, UNCLOSED, _classes, broken_quoting, byte_rows, split_values

#: Fixed values of the nine-column format.
COLUMNS = ["chr", "source", "type", "start", "end", "score", "strand", "phase", "attributes"]
_ALNUM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_CHR_SIGNS, _DIGITS, _STRANDS, _PHASES = b"_.-", b"0123456789", b"+-.?", b"012."

#: Costs: an ill-typed column, a quote or separator, a tab; what no path reaches.
_ILL, _MARK, _TAB, _BIG = 1, 1 << 20, 1 << 40, 1 << 60


def _automaton():
    """(next state of each state and byte, cost of leaving each state's column, first state of each column)."""
    kinds = ["chr", "any", "any", "digits", "digits", "any", "strand", "phase"]
    first, leave, rows = [], [], []
    for kind in kinds:
        at = len(leave)
        first.append(at)
        if kind == "any":
            rows.append(np.full(256, at))
            leave.append(0)
            continue
        # nothing yet (of chr: nothing but signs), good, bad
        good = {"chr": _ALNUM, "digits": _DIGITS, "strand": _STRANDS, "phase": _PHASES}[kind]
        for state in range(3):
            row = np.full(256, at + 2)
            if state < 2:
                longer = state == 0 or kind in ("chr", "digits")
                row[list(good)] = at + 1 if longer else at + 2
                if kind == "chr":
                    row[list(_CHR_SIGNS)] = at + state
            rows.append(row)
        leave += [_ILL, 0, _ILL]
    first.append(len(leave))
    rows += list(len(leave) + _TRANS[:, _classes(";,|")].astype(np.int64))
    return np.array(rows), np.array(leave, np.int64), first


_NEXT, _LEAVE, _FIRST = _automaton()
_N, _NINTH = len(_NEXT), _FIRST[8]
_JUNK = _NINTH + JUNK
_MARKS = {ord('"'): "quote", ord("'"): "quote", ord(";"): "separator"}
_DROPS = {**_MARKS, ord(","): "separator", ord("|"): "separator"}
_FINAL = _NINTH + np.flatnonzero(~UNCLOSED & (np.arange(len(_TRANS)) != JUNK))


def _insertions():
    """Least cost of leading from each state to each other by insertions alone, and the first byte put in on that way."""
    cost, byte = np.full((_N, _N), _BIG, np.int64), np.zeros((_N, _N), np.int64)
    np.fill_diagonal(cost, 0)
    hop = []
    for c in range(8):
        hop += [(s, _FIRST[c + 1], 9, _TAB + _LEAVE[s]) for s in range(_FIRST[c], _FIRST[c + 1])]
    hop += [(s, int(_NEXT[s, b]), b, _MARK) for s in range(_NINTH, _N) for b in _MARKS if s != _JUNK and _NEXT[s, b] != _JUNK]
    for _ in range(_N):
        for s, t, b, w in hop:
            better = w + cost[t] < cost[s]
            cost[s] = np.where(better, w + cost[t], cost[s])
            byte[s] = np.where(better, b, byte[s])
    return cost, byte


def _consumed(b: int) -> np.ndarray:
    """Least cost of leading from each state to each other by reading or deleting a byte."""
    out = np.full((_N, _N), _BIG, np.int64)
    for s in range(_N):
        if b == 9:
            if s < _NINTH:
                out[s, next(f for f in _FIRST if f > s)] = _LEAVE[s]
            out[s, s] = _TAB
        elif _NEXT[s, b] != _JUNK:
            out[s, _NEXT[s, b]] = 0
        if b in _DROPS and s >= _NINTH:
            out[s, s] = min(out[s, s], _MARK)
    return out


_INSERT, _PUT = _insertions()


def _steps():
    """Bytes by kind (bytes of one kind lead everywhere alike); per kind the cost of insertions and one byte after them,
    by target and source state, and that of the byte alone."""
    alike = np.concatenate([_NEXT, [[b if b == 9 or b in _DROPS else -1 for b in range(256)]]])
    _, example, of_byte = np.unique(alike, axis=1, return_index=True, return_inverse=True)
    read = np.stack([_consumed(int(b)) for b in example])
    step = np.stack([(_INSERT[:, :, None] + k[None]).min(axis=1).T for k in read])
    return of_byte.reshape(-1), np.minimum(step, _BIG), read


_KIND, _STEP, _READ = _steps()


def _narrow(cost: np.ndarray) -> np.ndarray:
    """Costs in 32 bits, for texts of fewer than SHORT tabs and marks."""
    tabs, marks, ill = cost >> 40, (cost >> 20) & (_MARK - 1), cost & (_MARK - 1)
    return np.where(cost >= _BIG, 1 << 29, (tabs << 20) | (marks << 10) | ill).astype(np.int32)


SHORT = 500
_SETS = {True: (_narrow(_STEP), _narrow(_INSERT), np.int32(1 << 29)), False: (_STEP, _INSERT, np.int64(_BIG))}


def cheapest_parses(texts: list[bytes], ninth: bool = False) -> list[tuple[int, list[str]]]:
    """(number of edits, edits) of the parse of least cost of each line, or (ninth) of each text as a ninth column.

    Min-plus dynamic programming over states, all texts in lock-step by position; linear in the length of a text.
    Edits name what is inserted before or deleted at which byte, counted from 1, in order.
    """
    base = _NINTH if ninth else 0
    n, width = len(texts), _N - base
    length = np.array([len(t) for t in texts], np.int64)
    short = np.array([sum(t.count(bytes([b])) for b in (9, *_DROPS)) < SHORT for t in texts], bool)
    order = np.lexsort((-length, short))
    out: list = [None] * n
    lo = 0
    while lo < n:  # texts of about one length go together, as many as their pointers may take up memory
        hi = lo + max(1, (1 << 17) // max(1, int(length[order[lo]])))
        group = order[lo:hi]
        group = group[short[group] == short[group[0]]]
        lo += len(group)
        steps, insert, big = _SETS[bool(short[group[0]])]
        steps = [np.ascontiguousarray(x[base:, base:]) for x in steps]
        size, raw = length[group], np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        begin = np.cumsum(size) - size
        cost = np.full((len(group), width), big)
        cost[:, 0] = 0
        back = np.zeros((int(size[0]), len(group), width), np.uint8)
        for t in range(int(size[0])):
            live = int(np.searchsorted(-size, -t, side="left"))
            kind = _KIND[raw[begin[:live] + t]]
            for k in np.unique(kind):
                rows = np.flatnonzero(kind == k)
                total = cost[rows, None, :] + steps[k]
                by = total.argmin(axis=2)
                back[t, rows] = by
                cost[rows] = np.minimum(np.take_along_axis(total, by[:, :, None], axis=2)[:, :, 0], big)
        end = cost[:, :, None] + insert[None, base:, _FINAL]
        for g, i in enumerate(group):
            s, f = np.unravel_index(end[g].argmin(), end[g].shape)
            edits = [(int(size[g]), "insert", b) for b in _path(base + s, _FINAL[f])]
            for t in range(int(size[g]) - 1, -1, -1):
                to, s = base + s, back[t, g, s]
                byte = raw[begin[g] + t]
                read = _READ[_KIND[byte]][:, to]
                if base + s != to or read[to]:
                    via = int((_INSERT[base + s] + read).argmin())
                    if via == to and read[to] >= _MARK:
                        edits.append((t, "delete", byte))
                    edits += [(t, "insert", b) for b in reversed(_path(base + s, via))]
            out[i] = (len(edits), [f"{op} {'tab' if b == 9 else _DROPS[int(b)]} at {t + 1}" for t, op, b in reversed(edits)])
    return out


def _path(s: int, t: int) -> list[int]:
    """The bytes whose insertion leads from one state to another at least cost."""
    put = []
    while s != t:
        b = int(_PUT[s, t])
        put.append(b)
        s = next(f for f in _FIRST if f > s) if b == 9 else int(_NEXT[s, b])
    return put


#: A line that is valid but for the order of start and end: nine fields, good values, no quote that would need a parse.
#: Possessive throughout, so that no line makes it go back far.
_PLAIN = r"""^(?!track)(?=[_.\-]*+[A-Za-z0-9])[A-Za-z0-9_.\-]++\t[^\t]*+\t[^\t]*+\t[0-9]{1,18}+\t[0-9]{1,18}+\t[^\t]*+\t[^\t]*+\t[^\t]*+\t(?:\.| *+[^;,|= "'\t]++(?: *+= *+| ++)[^;,|= "'\t\r][^"'\t]*+)\r?\z"""


def _split_lines(df: DataFrame, id_col: str, line: str) -> tuple[DataFrame, DataFrame]:
    """(id, line) of the lines that built-in expressions find valid, and of the others with n, the number of fields, ninth,
    the ninth of them, fails, the column whose value fails (chr, start, or null), and first, whether the ninth begins with
    a key and a value. Null, blank and comment lines are left out; lines come without their carriage return."""
    rows = df.select(F.col(id_col).alias("id"), F.col(line).alias("line")).filter("line is not null")
    f = F.split("line", "\t", 6)
    start, end = (F.try_element_at(f, F.lit(k)).try_cast("bigint") for k in (4, 5))
    plain = F.col("line").rlike(_PLAIN) & F.coalesce((start >= 1) & (start <= end), F.lit(False))
    bare = F.regexp_replace("line", r"\r\z", "").alias("line")
    rest = rows.filter(~plain & F.col("line").rlike(r"[^ \t\n\r\x0b\f]") & ~F.col("line").startswith("#") & ~F.col("line").startswith("track"))
    rest = rest.select("id", bare).withColumn("f", F.split("line", "\t", -1))
    at = lambda k: F.try_element_at("f", F.lit(k))
    number = lambda k: F.coalesce(at(k).rlike(r"^[0-9]++\z"), F.lit(False))
    chr_ok = F.coalesce(at(1).rlike(r"^(?=[_.\-]*+[A-Za-z0-9])[A-Za-z0-9_.\-]++\z"), F.lit(False))
    start_ok = F.coalesce(number(4) & number(5) & (at(4).try_cast("bigint") >= 1) & (at(4).try_cast("bigint") <= at(5).try_cast("bigint")), F.lit(False))
    pair = at(9).rlike(r"""^ *+[^;,|= "'\t]++( *+= *+| ++)(["'][^"'\\]|[^;,|= "'\t])""")
    rest = rest.select("id", "line", F.size("f").alias("n"), at(9).alias("ninth"), F.when(~chr_ok, "chr").when(~start_ok, "start").alias("fails"), F.coalesce(pair, F.lit(False)).alias("first"))
    return rows.filter(plain).select("id", bare), rest


def _judge(b: pa.RecordBatch) -> list:
    """Per row of lines in doubt: None (valid), or (reason, cost, edits)."""
    n, fails = b.column(2).to_numpy(), b.column(4).to_pylist()
    verdict: list = [None] * b.num_rows
    nine = np.flatnonzero(n == 9)
    ninth = b.column(3).take(pa.array(nine))
    bad = broken_quoting(*byte_rows(ninth))
    open_rows = nine[bad]
    wrong = np.flatnonzero(n != 9)
    for rows, column, alone in ((wrong, 1, False), (open_rows, 3, True)):
        texts = b.column(column).take(pa.array(rows)).cast(pa.binary()).to_pylist()
        for i, (cost, edits) in zip(rows.tolist(), cheapest_parses(texts, alone)):
            verdict[i] = ("columns" if any(" tab " in e for e in edits) else "quoting", cost, "; ".join(edits))
    # no key with a value: rows that don't begin with one are parsed
    doubt = nine[~bad & ~b.column(5).take(pa.array(nine)).to_numpy(zero_copy_only=False)]
    field = b.column(3).take(pa.array(doubt))
    has = np.zeros(len(doubt), bool)
    has[split_values(*byte_rows(field))[0]] = True
    empty = set(doubt[~has & ~np.array([x == "." for x in field.to_pylist()], bool)].tolist())
    for i in nine[~bad].tolist():
        if fails[i] or i in empty:
            verdict[i] = ("value", 0, fails[i] or "attributes")
    return verdict


def rejected_lines(df: DataFrame, id_col: str = "line_id", line: str = "line") -> DataFrame:
    """(id, reason, cost, edits): the lines that fail. reason is the first that applies of columns, quoting, value.

    cost counts the edits of the cheapest parse (0 for value) and edits lists them all, or names the column whose value
    fails: a parse that inserts or deletes tabs means columns, one that does so with quotes or separators quoting. Null,
    blank and comment lines are neither valid nor failed; a carriage return at the end is no part of the line. Narrow:
    one pass, no shuffle; extra columns are not read. Lines that built-in expressions find valid need no Python.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            v = _judge(b)
            at = [i for i, x in enumerate(v) if x]
            yield pa.record_batch(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array([v[i][0] for i in at], pa.string()), pa.array([v[i][1] for i in at], pa.int32()), pa.array([v[i][2] for i in at], pa.string())],
                names=[id_col, "reason", "cost", "edits"],
            )

    return _split_lines(df, id_col, line)[1].mapInArrow(run, f"`{id_col}` {kind}, reason string, cost int, edits string")


def valid_lines(df: DataFrame, id_col: str = "line_id", line: str = "line") -> DataFrame:
    """(id, nine typed columns): the lines that parse at cost zero with valid values; start and end are BIGINT."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            at = pa.array([i for i, x in enumerate(_judge(b)) if not x], pa.int64())
            yield pa.record_batch([b.column(0).take(at), b.column(1).take(at)], names=["id", "line"])

    plain, rest = _split_lines(df, id_col, line)
    good = plain.unionByName(rest.mapInArrow(run, f"id {kind}, line string"))
    f = F.split("line", "\t", -1)
    typed = [f[j].cast("bigint").alias(c) if c in ("start", "end") else f[j].alias(c) for j, c in enumerate(COLUMNS)]
    return good.select(F.col("id").alias(id_col), *typed)
