"""Attribute fields of GFF3/GTF rows: a quote-aware finite-state tokenizer that runs over whole Arrow batches.

One transition table drives every row of a batch in lock-step (one numpy step per byte position), so the work per
byte is a table look-up. States tell plain text, quotes, escapes and separators apart; a depth counter protects
bracketed text where ``brackets`` names bracket pairs.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

# classes of bytes
_OTHER, _SEP, _BLANK, _EQ, _DQ, _SQ, _BS = range(7)
# states: piece start, bare word, blanks after the word, value start, plain value, in "...", after a backslash there,
# after a quote there, the same three for '...', blanks after a closed quote, junk after a closed quote, separator
START, WORD, GAP, VSTART, PLAIN, D_IN, D_ESC, D_END, S_IN, S_ESC, S_END, AFTER, JUNK, SEPARATOR = range(14)
_N_STATES = 14


def _transitions() -> np.ndarray:
    t = np.zeros((_N_STATES, 7), np.uint8)
    for s in (START, SEPARATOR):
        t[s] = [WORD, SEPARATOR, START, VSTART, D_IN, S_IN, WORD]
    t[WORD] = [WORD, SEPARATOR, GAP, VSTART, WORD, WORD, WORD]
    t[GAP] = [PLAIN, SEPARATOR, GAP, VSTART, D_IN, S_IN, PLAIN]
    t[VSTART] = [PLAIN, SEPARATOR, VSTART, PLAIN, D_IN, S_IN, PLAIN]
    t[PLAIN] = [PLAIN, SEPARATOR, PLAIN, PLAIN, PLAIN, PLAIN, PLAIN]
    for inside, esc, end, quote in ((D_IN, D_ESC, D_END, _DQ), (S_IN, S_ESC, S_END, _SQ)):
        t[inside] = inside
        t[inside, quote], t[inside, _BS] = end, esc
        t[esc] = inside
        t[esc, _BS] = esc
        t[end] = [JUNK, SEPARATOR, AFTER, JUNK, JUNK, JUNK, JUNK]
        t[end, quote] = inside
    t[AFTER] = [JUNK, SEPARATOR, AFTER, JUNK, JUNK, JUNK, JUNK]
    t[JUNK] = [JUNK, SEPARATOR, JUNK, JUNK, JUNK, JUNK, JUNK]
    return t


_TRANS = _transitions()
_ESCAPED = {q: re.compile(rb"\\" + q + b"|" + q + q) for q in (b'"', b"'")}
UNCLOSED = np.isin(np.arange(_N_STATES), [D_IN, D_ESC, S_IN, S_ESC])
_QUOTED = np.isin(np.arange(_N_STATES), [D_IN, D_ESC, D_END, S_IN, S_ESC, S_END])


def _classes(separators: str) -> np.ndarray:
    c = np.full(256, _OTHER, np.uint8)
    for ch, k in ((" ", _BLANK), ("\t", _BLANK), ("=", _EQ), ('"', _DQ), ("'", _SQ), ("\\", _BS)):
        c[ord(ch)] = k
    for ch in separators:
        c[ord(ch)] = _SEP
    return c


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a string column with each row's first and last+1 position (null rows are empty)."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first, last = off[:-1].copy(), off[1:].copy()
    if column.null_count:
        last = np.where(np.asarray(column.is_valid()), last, first)
    return raw, first, last


def run_states(raw, first, last, separators=";,|", brackets="") -> np.ndarray:
    """The state after each byte of every row, all rows in lock-step by position."""
    classes, out = _classes(separators), np.zeros(len(raw), np.uint8)
    length = last - first
    order = np.argsort(-length, kind="stable")
    begin, sizes = first[order], length[order]
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
    state = np.full(len(begin), START, np.uint8)
    opens = np.isin(np.arange(256), [ord(c) for c in brackets[::2]])
    closes = np.isin(np.arange(256), [ord(c) for c in brackets[1::2]])
    depth = np.zeros(len(begin), np.int32) if brackets else None
    for t, m in enumerate(active):
        byte = raw[begin[:m] + t]
        kind = classes[byte]
        if depth is not None:
            free = ~_QUOTED[state[:m]]
            depth[:m] += (opens[byte] & free).astype(np.int32)
            depth[:m] = np.maximum(depth[:m] - (closes[byte] & free), 0)
            kind = np.where((kind == _SEP) & (depth[:m] > 0), _OTHER, kind)
        state[:m] = _TRANS[state[:m], kind]
        out[begin[:m] + t] = state[:m]
    return out


def broken_quoting(raw, first, last, separators=";,|") -> np.ndarray:
    """Per row: a quote isn't closed, or something other than blanks stands between a closing quote and a separator."""
    states = run_states(raw, first, last, separators)
    ends = np.where(last > first, states[np.maximum(last - 1, 0)], START) if len(raw) else np.zeros(len(first), np.uint8)
    junk = np.concatenate([[0], np.cumsum(states == JUNK)])
    return UNCLOSED[ends] | (junk[last] > junk[first])


def _unquote(text: bytes, closed: bool) -> bytes:
    """Content of a value that starts with a quote: outer quotes off, the escaped quote (doubled or after \\) undone."""
    q = text[:1]
    body = text[1:-1] if closed else text[1:]
    return _ESCAPED[q].sub(q, body) if q in body else body


def split_values(raw, first, last, separators=";,|", brackets="", keys: set[bytes] | None = None, mark: bool = False):
    """Values of every row: lists (row number, position from 1, key, value), plus per row: quoting broken.

    keys: keep these keys only (positions still count all values). mark: also a list that tells which values stand beside a
    key of their own. A row that is empty or a lone '.' has no values.
    """
    states = run_states(raw, first, last, separators, brackets)
    n = len(first)
    sep_at = np.flatnonzero(states == SEPARATOR)
    if len(sep_at):
        order = np.argsort(first, kind="stable")  # rows lie one after another in the buffer
        owner = order[np.searchsorted(first[order], sep_at, side="right") - 1]
        keep = (sep_at >= first[owner]) & (sep_at < last[owner])
        sep_at, owner = sep_at[keep], owner[keep]
    else:
        owner = np.zeros(0, np.int64)
    # pieces: from a row's start or after a separator up to the next separator or the row's end
    row_of = np.concatenate([np.arange(n), owner])
    cut_s = np.concatenate([first, sep_at + 1])
    o = np.lexsort((cut_s, row_of))
    row_of, cut_s = row_of[o], cut_s[o]
    nxt = np.concatenate([cut_s[1:] - 1, [0]])
    same = np.concatenate([row_of[1:] == row_of[:-1], [False]]) if len(row_of) else np.zeros(0, bool)
    cut_e = np.where(same, nxt, last[row_of]) if len(row_of) else cut_s

    def count(flag):
        c = np.concatenate([[0], np.cumsum(flag)])
        return c[cut_e] - c[cut_s]

    words, valued = count(states == WORD), count(states == VSTART)
    quoted, junk, plain = count(_QUOTED[states]), count(states == JUNK), count(states == PLAIN)
    ends = np.where(last > first, states[np.maximum(last - 1, 0)], START) if len(raw) else np.zeros(n, np.uint8)
    open_end = UNCLOSED[ends]
    broken = open_end.copy()
    if len(junk):
        np.logical_or.at(broken, row_of[junk > 0], True)
    data = raw.tobytes()
    out_row, out_pos, out_key, out_val, out_own = [], [], [], [], []
    at, key, pos = -1, None, 0
    todo = np.flatnonzero(cut_e > cut_s)
    for row, s, e, w, v, q, j, p in zip(*(a[todo].tolist() for a in (row_of, cut_s, cut_e, words, valued, quoted, junk, plain))):
        if row != at:
            at, key, pos = row, None, 0
        piece = data[s:e].strip(b" \t")
        if not piece:
            continue
        if v or q or p:
            if w:
                key, rest = piece[:w], piece[w:].lstrip(b" \t")
            else:
                rest = piece
            if v and rest[:1] == b"=":
                rest = rest[1:].lstrip(b" \t")
            val = _unquote(rest, not (open_end[row] and e == last[row])) if q and not j else rest
        else:
            val = piece
        if not val or key is None:
            continue
        pos += 1
        if keys is None or key in keys:
            out_row.append(row)
            out_pos.append(pos)
            out_key.append(key)
            out_val.append(val)
            out_own.append(bool(w and (v or q or p)))
    return (out_row, out_pos, out_key, out_val, broken, out_own) if mark else (out_row, out_pos, out_key, out_val, broken)
