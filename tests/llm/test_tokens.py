from __future__ import annotations

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandloom.llm import tokens as tk

pytestmark = pytest.mark.skipif(not os.path.exists(tk.VOCABULARY), reason="no vocabulary files here")
PIECES = st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "'", "'re", "r", "1", ".", "é", "ж", " ", "　", "<|endoftext|>", "\r\n", "\x1c", "\x85", "👩", "the", " ll"]), max_size=40).map("".join)


RUNS = st.lists(st.sampled_from(["ab", "a", "the", "ing", "жи", "中文", "字", "aaa", "s", "re"]), max_size=60).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.one_of(PIECES, RUNS), st.integers(1, 9))
def test_tree_equals_whole(text, leaf):
    codec = tk.codec(tk.VOCABULARY)
    assert tk.encode_tree(text, codec, leaf) == codec.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(PIECES, PIECES, PIECES)
def test_join_is_associative(a, b, c):
    codec = tk.codec(tk.VOCABULARY)
    a, b, c = (codec.encode_ordinary(x) for x in (a, b, c))
    assert tk.join(tk.join(a, b, codec), c, codec) == tk.join(a, tk.join(b, c, codec), codec)


def test_windows_stay_small_without_blanks():
    import random

    codec, rng = tk.codec(tk.VOCABULARY), random.Random(2)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "中文字典用於測試", "жизнь"):
        text, seen = "".join(rng.choice(letters) for _ in range(32768)), []

        def encode(t, seen=seen):
            seen.append(len(t))
            return codec.encode_ordinary(t)

        assert tk.encode_tree(text, codec, encode=encode) == codec.encode_ordinary(text)
        assert sum(seen) < 1.5 * len(text)


def test_json_vocabulary_gives_the_same_ids():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(tk.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    for x in ("Hello  world <|endoftext|> it's", "ж é\n\n  x", "a" * 300):
        assert tk.encode_tree(x, tk.codec(tk.VOCABULARY), 5) == t.encode(x, add_special_tokens=False).ids


def test_documents_long_ones_by_segments(spark):
    texts = [(1, None), (2, ""), (3, " "), (4, "word " * 700 + "end"), (5, "x" * 2500), (6, "it's Ünïcode\n" * 200)]
    df = spark.createDataFrame([(*t, "q") for t in texts], "doc_id bigint, text string, ids string")
    encode = tk.codec(tk.VOCABULARY).encode_ordinary
    want = {i: encode(t) if t else [] for i, t in texts}
    for segment in (1 << 19, 300):
        got = tk.encode_texts(df, "doc_id", "text", leaf=64, segment=segment)
        assert {r.doc_id: list(r.ids) for r in got.collect()} == want
    back = {r.doc_id: r.text for r in tk.decode_texts(got, "doc_id").collect()}
    assert back == {i: t or "" for i, t in texts}
    assert tk.encode_texts(df.limit(0), "doc_id", "text").collect() == []


def test_repeated_and_null_ids_of_long_texts(spark):
    texts = [(1, "abc " * 50), (1, "xyz, " * 50), (None, "one two " * 40), (1, None)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    encode = tk.codec(tk.VOCABULARY).encode_ordinary
    got = sorted(((r.doc_id, list(r.ids)) for r in tk.encode_texts(df, "doc_id", "text", leaf=16, segment=50).collect()), key=repr)
    assert got == sorted(((i, encode(t) if t else []) for i, t in texts), key=repr)
