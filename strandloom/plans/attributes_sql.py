"""Attribute fields in SQL: pieces outside quotes, their keys and values, written apart from the Spark tokenizer."""

from __future__ import annotations

#: Pieces of a field: each match takes a separator (one is put in front) and all up to the next one outside quotes.
_PIECES = r"""regexp_extract_all(';' || attributes, '[;,|][ \t]*(?:[^;,|= \t"''][^;,|= \t]*)?[ \t]*=?[ \t]*(?:"(?:[^"\\]|\\.|"")*"?[^;,|]*|''(?:[^''\\]|\\.|'''')*''?[^;,|]*|[^;,|"''][^;,|]*)?')"""
#: A piece's key with what follows it up to the value.
_KEY = r"""'^[;,|]?[ \t]*([^;,|= \t"''][^;,|= \t]*)(?:[ \t]*=[ \t]*|[ \t]+)'"""


def _plain(v: str) -> str:
    """A value without its quotes, escaped quotes undone."""
    one = lambda q: rf"""regexp_replace(regexp_extract({v}, '^{q}((?:[^{q}\\]|\\.|{q}{q})*)', 1), '\\{q}|{q}{q}', '{q}', 'g')"""
    return f"""CASE WHEN {v}[1:1] = '"' THEN {one('"')} WHEN {v}[1:1] = '''' THEN {one("''")} ELSE {v} END"""


def with_pairs(table: str, name: str) -> str:
    """CTEs: name has the rows of table and ps, the list of (k, v) of its attributes; k is '' where a piece has no key."""
    return f"""{name}_w AS (SELECT *, list_transform(list_transform({_PIECES}, lambda p: rtrim(p, ' ' || chr(9))), lambda p: {{'k': regexp_extract(p, {_KEY}, 1), 'r': trim(regexp_replace(regexp_replace(p, {_KEY}, ''), '^[;,|]', ''), ' ' || chr(9))}}) AS pq FROM {table}),
    {name} AS (SELECT * EXCLUDE (pq), list_transform(pq, lambda x: {{'k': x.k, 'v': {_plain('x.r')}}}) AS ps FROM {name}_w)"""


def first_value(key: str) -> str:
    """The first value of a key in ps: later pieces without a key belong to keys that had one."""
    return f"(list_filter(ps, lambda x: x.k = '{key}' AND x.v <> ''))[1].v"
