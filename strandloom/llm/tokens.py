"""Encoding of whole texts by a public byte-level BPE tokenizer (problem 7): a monoid tree reduction.

A text is encoded by halves: leaves are encoded on their own, and two neighbours A, B join by encoding again only a
window of tokens around their border. The window grows on a side until its outermost token there is the one that the
side had before. Tokens outside are then provably those of the whole text: a list of tokens is the encoding of a word
exactly if each two neighbours in it are (merges are local), the neighbours at the window's ends were neighbours
before, and those inside come from an encoding. Nor do words differ: a window that doesn't begin with an apostrophe
(which may or may not begin a contraction) nor end between a blank and a word is cut into words as the whole text is. Joining is associative, so long
texts are cut into segments that are encoded by different tasks and joined in rounds of pairs.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.session import drop_table, materialize

#: The place of the vocabulary files and the file used.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the tokenizer's word pattern, as its public description gives it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a leaf, and of a segment that one task encodes; tokens of a side that a window starts with.
LEAF_CHARS, SEGMENT_CHARS, WINDOW = 1024, 1 << 19, 4

_CODECS: dict[str, object] = {}


def codec(vocabulary: str):
    """The tokenizer of a rank file, made once per Python worker."""
    if vocabulary not in _CODECS:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CODECS[vocabulary] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _CODECS[vocabulary]


def _text(codec, ids: list[int]) -> str:
    return codec.decode_bytes(ids).decode("utf-8", "replace")


def _blank(ch: str) -> bool:
    """A blank to the word pattern: the four separators of ASCII are none there."""
    return ch.isspace() and not "\x1c" <= ch <= "\x1f"


def join(a: list[int], b: list[int], codec, encode=None) -> list[int]:
    """The monoid's operation on the ids of two neighbouring texts."""
    if not a or not b:
        return a or b
    encode, first = encode or codec.encode_ordinary, codec.decode_single_token_bytes
    i, j = min(WINDOW, len(a)), min(WINDOW, len(b))
    while True:
        # windows begin and end between characters, don't begin with an apostrophe and don't part a blank from a word
        while i < len(a) and (first(a[-i])[0] & 0xC0 == 0x80 or first(a[-i])[0] == 0x27):
            i += 1
        while j < len(b) and (first(b[j])[0] & 0xC0 == 0x80 or (_blank(_text(codec, b[max(0, j - 4) : j])[-1:]) and not _blank(_text(codec, b[j : j + 4])[:1]))):
            j += 1
        window = encode(_text(codec, a[-i:] + b[:j]))
        left, right = i == len(a) or window[0] == a[-i], j == len(b) or window[-1] == b[j - 1]
        if left and right:
            return a[: len(a) - i] + window + b[j:]
        i, j = i if left else min(2 * i, len(a)), j if right else min(2 * j, len(b))


def joined(level: list[list[int]], codec, encode=None) -> list[int]:
    """The ids of a text from those of its parts, joined in rounds of pairs."""
    while len(level) > 1:
        level = [join(level[k], level[k + 1], codec, encode) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0]


def encode_tree(text: str, codec, leaf: int = LEAF_CHARS, encode=None) -> list[int]:
    """Ids of a text by halves."""
    encode = encode or codec.encode_ordinary
    return joined([encode(text[k : k + leaf]) for k in range(0, max(len(text), 1), leaf)], codec, encode)


def encode_texts(df: DataFrame, id_col: str, text: str, vocabulary: str = VOCABULARY, leaf: int = LEAF_CHARS, segment: int = SEGMENT_CHARS) -> DataFrame:
    """(id_col, ids): the token ids of every row's text, without special tokens.

    Null and empty texts give an empty list; strings that look like special tokens are ordinary text; repeated rows
    and repeated or null ids give a result for each row. Other columns are not read. Texts up to ``segment`` characters
    take one narrow pass. Longer ones are numbered, cut into segments, encoded by as many tasks, and joined in
    log2(segments) rounds of pairs that carry ids only.
    """
    kind = df.schema[id_col].dataType
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    longest = rows.agg(F.max(F.length("text"))).first()[0] or 0
    listed = pa.list_(pa.int32())
    out = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        c = codec(vocabulary)
        for b in batches:
            ids = [encode_tree(t, c, leaf) if t else [] for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(ids, listed)], names=["id", "ids"])

    if longest <= segment:
        return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)
    short = rows.filter(f"text is null or length(text) <= {segment}").mapInArrow(run, out)
    long = materialize(rows.filter(f"length(text) > {segment}").withColumn("row", F.monotonically_increasing_id()), "texts")

    def cut(batches):
        for b in batches:
            for row, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for no in range(0, -(-len(t) // segment)):
                    yield pa.record_batch([pa.array([row]), pa.array([no]), pa.array([t[no * segment : (no + 1) * segment]])], names=["row", "no", "text"])

    def leaves(batches):
        c = codec(vocabulary)
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array([encode_tree(t, c, leaf) for t in b.column(2).to_pylist()], listed)], names=["row", "no", "ids"])

    def pairs(batches):
        c = codec(vocabulary)
        for b in batches:
            got = [x if y is None else join(x, y, c) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(got, listed)], names=["row", "no", "ids"])

    state = "row bigint, no bigint, ids array<int>"
    pieces = long.select("row", "text").mapInArrow(cut, "row bigint, no bigint, text string").repartition("row", "no")
    level, n = materialize(pieces.mapInArrow(leaves, state), "tokens"), -(-longest // segment)
    while n > 1:
        even = level.filter("no % 2 = 0").withColumn("no", F.expr("no div 2"))
        odd = level.filter("no % 2 = 1").select("row", F.expr("no div 2").alias("no"), F.col("ids").alias("next"))
        after = materialize(even.join(odd, ["row", "no"], "left").select("row", "no", "ids", "next").mapInArrow(pairs, state), "tokens")
        drop_table(level)
        level, n = after, -(-n // 2)
    return short.unionByName(long.select("row", "id").join(level, "row").select("id", "ids")).withColumnRenamed("id", id_col)


def decode_texts(df: DataFrame, id_col: str, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id_col, text): the texts of lists of ids; an empty list gives '', null gives null. Unknown ids fail."""
    kind = df.schema[id_col].dataType
    out = T.StructType([T.StructField("id", kind), T.StructField("text", T.StringType())])

    def run(batches):
        decode = codec(vocabulary).decode_bytes
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([None if x is None else decode(x).decode("utf-8") for x in b.column(1).to_pylist()], pa.string())], names=["id", "text"])

    return df.select(F.col(id_col).alias("id"), F.col(ids).alias("ids")).mapInArrow(run, out).withColumnRenamed("id", id_col)
