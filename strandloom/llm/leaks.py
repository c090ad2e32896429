"""Held-out test passages that turn up in corpus pages (problem 8).

Both sides become streams of folded letters: pages with their lines in the order of their columns and wrong decodings
undone, so that broken words, case, punctuation and lost accents make no difference. A CGK random walk embeds the
window at each word start: every step emits the letter under the pointer and moves on by a random bit of step and
letter, so that a small edit distance becomes a small Hamming distance. Locality-sensitive hashing samples the steps,
several times over with fresh walks and samples; windows whose samples agree are candidates. Windows fit the item: the
longest walk that an item has room for, up to STEPS. An exact check then chains what page and item share, measures the
edits between, and counts the item's words in the longest unbroken stretch.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.llm.mojibake import Model, _pool, _slices, fit, repair_texts
from strandloom.session import materialize

#: Steps of the longest walk (28 letters on average), share of the steps that each of the repetitions samples, and the
#: lengths of walks: an item has windows of the longest of them that it has room for.
STEPS, SAMPLED, REPEATS, LENGTHS = 56, 0.6, 8, (7, 14, 28, 56)
#: Words of an item that make a leak, and letters of the exact seeds that the check chains.
MIN_WORDS, SEED = 15, 6
#: Items are indexed in blocks of at most this many characters; each block is one pass over the corpus.
BLOCK_CHARS = 2_000_000
#: Pixels between the left edges of two columns, at least.
COLUMN_GAP = 100
#: Letters of an item that may lie between two matches of a chain.
MAX_GAP = 40

#: Signs that scanning takes for one another, under one letter.
LOOKALIKES = {"0": "o", "1": "l", "i": "l", "j": "l", "5": "s", "8": "b"}
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _fold_tables() -> tuple[np.ndarray, np.ndarray]:
    """Code of each character (0: not kept), and whether it belongs to a word. Latin letters with accents are dropped
    on both sides: a wrong decoding may have lost them for good."""
    code, inside = np.zeros(0x110000, np.uint8), np.zeros(0x110000, bool)
    letters: dict[str, int] = {}
    for c in range(0x30, 0x530):
        ch = chr(c)
        if not ch.isalnum():
            continue
        inside[c] = True
        base = unicodedata.normalize("NFD", ch.lower())[0]
        if c > 127 and not ("Ͱ" <= base < "԰"):
            continue
        base = LOOKALIKES.get(base, base)
        base = "σ" if base == "ς" else base
        code[c] = letters.setdefault(base, len(letters) + 1)
    inside[0xFFFD] = True
    return code, inside


_CODE, _INSIDE = _fold_tables()
_N = int(_CODE.max()) + 1


def _walks():
    """Per repetition: the moves of each step and letter, and the steps that are sampled."""
    rng = np.random.default_rng(8)
    out = []
    for _ in range(REPEATS):
        move = rng.integers(0, 2, (STEPS, _N)).astype(np.int64)
        sampled, first = np.zeros(STEPS, bool), 0
        for length in LENGTHS:  # the same share of each length
            sampled[first + rng.choice(length - first, round(SAMPLED * (length - first)), replace=False)] = True
            first = length
        out.append((move, sampled))
    return out


_WALKS = _walks()


def letters_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded letters of a text, the character position of each, and which of them start a word."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    code, inside = _CODE[points], _INSIDE[points]
    at = np.flatnonzero(code)
    before = np.concatenate([[False], inside[:-1]])
    return code[at], at, np.flatnonzero(~before[at])


def embed(letters: np.ndarray, start: np.ndarray, rep: int, visit) -> None:
    """Walks of one repetition from each start. After each of the lengths, visit(number of the length, numbers of the
    starts that still walk, hashes of the sampled steps, places reached) tells which of them go on (None: all)."""
    move, sampled = _WALKS[rep]
    padded = np.concatenate([letters, np.zeros(STEPS + 1, np.uint8)])
    ptr, h, who = start.astype(np.int64), np.zeros(len(start), np.uint64), np.arange(len(start))
    for j in range(STEPS):
        c = padded[ptr]
        if sampled[j]:
            h = (h + c + np.uint64(1)) * _MUL
            h ^= h >> np.uint64(29)
        ptr = ptr + move[j][c]
        if j + 1 in LENGTHS:
            on = visit(LENGTHS.index(j + 1), who, h, ptr)
            if on is not None:
                ptr, h, who = ptr[on], h[on], who[on]


#: Bits of the sieve at each length: walks that no item's window shares so far need not go on.
_SIEVES = (1 << 16, 1 << 22, 1 << 22, 1)


def _bit(h: np.ndarray, k: int) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (_SIEVES[k] - 1)


@dataclass
class Item:
    id: object
    letters: np.ndarray
    word: np.ndarray  # word number of each letter
    n_words: int
    grams: np.ndarray = field(default=None)  # sorted seeds
    gram_at: np.ndarray = field(default=None)


@dataclass
class Index:
    items: list[Item]
    keys: list  # per repetition and length: sorted hashes of the windows of that length
    owner: list  # item number of each hash
    sieves: list  # per repetition and length: packed bits of the hashes there of all longer windows, None at the last
    tiny: list[int]  # items without room for any walk


def _grams(letters: np.ndarray) -> np.ndarray:
    n = len(letters) - SEED + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    g = np.zeros(n, np.int64)
    for k in range(SEED):
        g = g * 256 + letters[k : k + n]
    return g


def make_index(rows: list[tuple[object, str]]) -> Index:
    items, starts, streams, owners, ends, base = [], [], [], [], [], 0
    for ident, text in rows:
        words = text.split()
        parts = [letters_of(w)[0] for w in words]
        letters = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        word = np.repeat(np.arange(len(words)), [len(p) for p in parts])
        it = Item(ident, letters, word, len(words))
        g = _grams(letters)
        it.gram_at = np.argsort(g, kind="stable")
        it.grams = g[it.gram_at]
        items.append(it)
        _, _, first = letters_of(" ".join(words))
        starts.append(first + base)
        owners.append(np.full(len(first), len(items) - 1))
        ends.append(np.full(len(first), base + len(letters)))
        streams += [letters, np.zeros(STEPS + 1, np.uint8)]
        base += len(letters) + STEPS + 1
    none = np.zeros(0, np.int64)
    start, owner, end = (np.concatenate([none, *x]) for x in (starts, owners, ends))
    stream = np.concatenate([np.zeros(0, np.uint8), *streams])
    index = Index(items, [], [], [], [])
    length_of, walked = np.full(len(items), -1), []
    for rep in range(REPEATS):
        seen: list = []
        embed(stream, start, rep, lambda _, who, h, ptr, seen=seen: seen.append((h.copy(), ptr <= end)))
        walked.append(seen)
        for k, (_, fits) in enumerate(seen):
            length_of[owner[fits]] = np.maximum(length_of[owner[fits]], k)
    length_of[[len(it.letters) >= STEPS for it in items]] = len(LENGTHS) - 1
    index.tiny = [i for i, it in enumerate(items) if length_of[i] < 0 and len(it.letters)]
    last = length_of[owner]
    for seen in walked:
        keys, owners, sieves = [], [], []
        for k, (h, fits) in enumerate(seen):
            # windows that reach beyond the item's end can only be met at the end of a page
            own = np.flatnonzero((last == k) & (fits | (k == len(LENGTHS) - 1)))
            order = own[np.argsort(h[own], kind="stable")]
            keys.append(h[order])
            owners.append(owner[order])
            longer = h[last > k]
            bits = np.zeros(_SIEVES[k], bool)
            bits[_bit(longer, k)] = True
            sieves.append(np.packbits(bits) if k < len(LENGTHS) - 1 else None)
        index.keys.append(keys)
        index.owner.append(owners)
        index.sieves.append(sieves)
    return index


def opened(index: Index) -> list:
    return [[None if s is None else np.unpackbits(s).astype(bool) for s in per] for per in index.sieves]


def candidates(index: Index, sieves, letters: np.ndarray, start: np.ndarray):
    """(start number, item number) of windows and items whose samples agree in some repetition."""
    got_s, got_i = [], []
    for rep in range(REPEATS):

        def visit(k, who, h, ptr, rep=rep):
            keys = index.keys[rep][k]
            if len(keys):
                lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
                n = hi - lo
                got_s.append(np.repeat(who, n))
                got_i.append(index.owner[rep][k][np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)])
            return None if sieves[rep][k] is None else np.flatnonzero(sieves[rep][k][_bit(h, k)])

        embed(letters, start, rep, visit)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *got_s]), np.concatenate([none, *got_i])


def edits(a: bytes, b: bytes, most: int = 1 << 30) -> int:
    """Edit distance by bit-parallel dynamic programming; most + 1 as soon as it is sure to be above most."""
    if not a or not b:
        return len(a) + len(b)
    left = len(b)
    mask, peq = (1 << len(a)) - 1, {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << i
    pv, mv, score, top = mask, 0, len(a), 1 << (len(a) - 1)
    for c in b:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv), pv & xh
        score += bool(ph & top) - bool(mh & top)
        left -= 1
        if score - left > most:
            return most + 1
        ph, mh = (ph << 1) | 1, mh << 1
        pv, mv = (mh | ~(xv | ph)) & mask, ph & xv & mask
    return score


def _seeds(item: Item, page: np.ndarray):
    """Maximal exact matches (item position, page position, length) that start from equal seeds, in this order."""
    g = _grams(page)
    lo, hi = np.searchsorted(item.grams, g, "left"), np.searchsorted(item.grams, g, "right")
    n = hi - lo
    d = np.repeat(np.arange(len(g)), n)
    i = item.gram_at[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    order = np.lexsort((d, d - i))
    d, i = d[order], i[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(d) != 1) | (np.diff(i) != 1)])) if len(d) else np.zeros(0, np.int64)
    length = np.diff(np.append(new, len(d))) + SEED - 1
    i, d = i[new], d[new]
    order = np.lexsort((d, i))
    return i[order], d[order], length[order]


def _bags(numbers: int, owner_from: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Letter counts of stretches: each triple is (letters, begins, ends) with one stretch per number; summed."""
    out = np.zeros(numbers * _N, np.int64)
    for letters, lo, hi in owner_from:
        n = np.maximum(hi - lo, 0)
        at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
        out += np.bincount(np.repeat(np.arange(numbers), n) * _N + letters[at], minlength=len(out))
    return out.reshape(numbers, _N)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least edits that two stretches of these letter counts can have."""
    d = a - b
    return np.maximum(np.maximum(d, 0).sum(axis=1), np.maximum(-d, 0).sum(axis=1))


def _links(item: np.ndarray, page: np.ndarray, i: np.ndarray, d: np.ndarray, n: np.ndarray, begins: np.ndarray, ends: np.ndarray):
    """(match, earlier match, letters cut off the match, least edits between) of all pairs that may follow each other.

    Item and page either go on by about as many letters, or the page goes on by whole lines of other matter, however
    many, from the end of the line of the earlier match to the begin of the line of the later one.
    """
    ei, ed, longest = i + n, d + n, int(n.max())
    tail = ends[ed - 1]
    step = max(1, (1 << 20) // len(i))
    for k0 in range(0, len(i), step):
        k = np.arange(k0, min(k0 + step, len(i)))[:, None]
        j = np.arange(np.searchsorted(i, i[k0] - MAX_GAP - longest), k[-1, 0])[None, :]
        cut = np.maximum(np.maximum(ei[j] - i[k], ed[j] - d[k]), 0)
        want = i[k] + cut - ei[j]
        k, j = np.nonzero((j < k) & (cut <= n[k] - 2) & (want <= MAX_GAP))
        cut, want, k, j = cut[k, j], want[k, j], k + k0, j + np.searchsorted(i, i[k0] - MAX_GAP - longest)
        allowed = 2 + want * 2 // 5
        at = d[k] + cut
        over = np.abs(at - ed[j] - want)
        head = begins[at]
        far = (over > allowed) & (at - ed[j] > want) & (tail[j] <= head)
        over = np.where(far, np.abs(tail[j] - ed[j] + at - head - want), over)
        ok = np.flatnonzero(over <= allowed)
        for o in range(0, len(ok), 1 << 14):
            x = ok[o : o + (1 << 14)]
            jx, kx, fx, ax = j[x], k[x], far[x], at[x]
            inner = _bags(len(x), [(item, ei[jx], i[kx] + cut[x])])
            outer = _bags(len(x), [(page, ed[jx], np.where(fx, tail[jx], ax)), (page, np.where(fx, head[x], ax), ax)])
            least = _apart(inner, outer)
            y = x[least <= allowed[x]]
            yield from zip(*(v.tolist() for v in (k[y], j[y], cut[y], least[least <= allowed[x]], far[y])))


def stretch_words(item: Item, page: np.ndarray, lines: np.ndarray) -> int:
    """Words of the item in the longest unbroken stretch that the page carries; counting ends at a leak's."""
    if len(item.letters) < SEED:
        return item.n_words if len(item.letters) and item.letters.tobytes() in page.tobytes() else 0
    i, d, n = _seeds(item, page)
    if not len(i):
        return 0
    ib, db = item.letters.tobytes(), page.tobytes()
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(lines)) + 1, [len(lines)]])
    nth = np.searchsorted(cuts, np.arange(len(lines)), side="right")
    begins, ends = cuts[nth - 1], cuts[nth]
    # per match the best chain that ends with it: score, item begin, page begin; and whether another one goes on from it
    links = groupby(_links(item.letters, page, i, d, n, begins, ends), itemgetter(0))
    begins, ends = begins.tolist(), ends.tolist()
    i, d, n = i.tolist(), d.tolist(), n.tolist()
    best, last = list(zip(n, i, d)), [True] * len(n)
    for k, pairs in links:
        top, by = best[k], None
        for least, j, cut, far in sorted((least + cut - best[j][0], j, cut, far) for _, j, cut, least, far in pairs):
            if n[k] - least <= top[0]:  # the rest scores less
                break
            i0, i1, d0, d1 = i[j] + n[j], i[k] + cut, d[j] + n[j], d[k] + cut
            allowed = 2 + (i1 - i0) * 2 // 5
            cost = edits(ib[i0:i1], db[d0 : ends[d0 - 1]] + db[begins[d1] : d1] if far else db[d0:d1], allowed)
            if cost <= allowed and best[j][0] + n[k] - cut - cost > top[0]:
                top, by = (best[j][0] + n[k] - cut - cost, *best[j][1:]), j
        if by is not None:
            best[k], last[by] = top, False
    edge = np.searchsorted(item.word, np.arange(item.n_words + 1))
    # one chain for each match that no other goes on from, and the words at which its begin and its end are cut
    ends_at = np.flatnonzero(last)
    bi, bd = np.array([best[k][1] for k in ends_at]), np.array([best[k][2] for k in ends_at])
    ei, ed = np.array(i)[ends_at] + np.array(n)[ends_at], np.array(d)[ends_at] + np.array(n)[ends_at]
    first, final = item.word[bi], item.word[ei - 1]
    cut_l, cut_r = bi - edge[first], edge[final + 1] - ei
    far_l = _apart(_bags(len(bi), [(item.letters, edge[first], bi)]), _bags(len(bi), [(page, np.maximum(bd - cut_l, 0), bd)]))
    far_r = _apart(_bags(len(ei), [(item.letters, ei, edge[final + 1])]), _bags(len(ei), [(page, ed, np.minimum(ed + cut_r, len(page)))]))
    whole_l, whole_r = edge[first + 1] - edge[first], edge[final + 1] - edge[final]
    # where that alone is too far the word counts only if its matched part outweighs the rest
    stop_l, stop_r = far_l * 3 > np.maximum(whole_l, 3), far_r * 3 > np.maximum(whole_r, 3)
    lone_l, lone_r = np.where(3 * cut_l <= whole_l, first, first + 1), np.where(3 * cut_r <= whole_r, final, final - 1)
    need, most, edge, begun = min(MIN_WORDS, item.n_words), 0, edge.tolist(), {}
    for x in np.argsort(bi - ei, kind="stable").tolist():
        left = int(lone_l[x]) if stop_l[x] else begun.get((bi[x], bd[x]))
        if left is None:
            left = begun[bi[x], bd[x]] = _grow(edge, ib, db, int(bi[x]), int(bd[x]), int(first[x]), -1)
        right = int(lone_r[x]) if stop_r[x] else _grow(edge, ib, db, int(ei[x]), int(ed[x]), int(final[x]), 1)
        most = max(most, right - left + 1)
        if most >= need:
            break
    return most


def _grow(edge: list[int], ib: bytes, db: bytes, i: int, d: int, w: int, step: int) -> int:
    """The outermost word in this direction that the page still carries next to position d; edge has the words' begins
    and the end of the last one."""
    while True:  # letters of the border word that are still outside the match
        lo, hi = edge[w], edge[w + 1]
        rest = ib[lo:i] if step < 0 else ib[i:hi]
        if rest:
            near = db[max(0, d - len(rest)) : d] if step < 0 else db[d : d + len(rest)]
            most = max(hi - lo, 3) // 3
            if near != rest and edits(rest, near, most) > most:
                # the word counts only if its matched part outweighs the rest
                return w if 3 * len(rest) <= hi - lo else w - step
            d = max(0, d - len(rest)) if step < 0 else d + len(rest)
            i = lo if step < 0 else hi
        w += step
        if not 0 <= w < len(edge) - 1 or (hi == len(ib) and step > 0) or (lo == 0 and step < 0):
            return w - step


def column_order(doc: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Order of lines by page, column from the left and height; a column begins where left edges leave a gap."""
    by_x = np.lexsort((x, doc))
    jump = (np.diff(x[by_x]) > COLUMN_GAP) & (np.diff(doc[by_x]) == 0)
    column = np.empty(len(x), np.int64)
    column[by_x] = np.concatenate([[0], np.cumsum(jump)]) if len(x) else np.zeros(0, np.int64)
    return np.lexsort((np.arange(len(x)), y, column, doc))


def in_columns(texts: list[str], xs: pa.ListArray, ys: pa.ListArray) -> list[str]:
    """The texts with their lines in the order of their columns; a text whose boxes don't fit its lines stays."""
    sizes = np.array([0 if v is None else v for v in pa.compute.list_value_length(xs).to_pylist()], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    x, y = (np.nan_to_num(a.flatten().to_numpy(zero_copy_only=False)).astype(np.int64) for a in (xs, ys))
    order = column_order(doc, x, y)
    first = np.concatenate([[0], np.cumsum(sizes)])
    moved = np.unique(doc[order != np.arange(len(order))])
    for t in moved.tolist():
        lines = texts[t].split("\n")
        if len(lines) == sizes[t]:
            texts[t] = "\n".join(lines[i] for i in (order[first[t] : first[t + 1]] - first[t]).tolist())
    return texts


def leaks_in(index: Index, sieves, texts: list[str]):
    """(text number, item number) of the leaks in these texts."""
    whole = "\n".join(texts)
    letters, at, start = letters_of(whole)
    ends = np.cumsum(np.array([len(t) + 1 for t in texts]))
    doc_of_start = np.searchsorted(ends, at[start], side="right")
    who, item = candidates(index, sieves, letters, start)
    pairs = np.unique(doc_of_start[who].astype(np.int64) * len(index.items) + item)
    if index.tiny:  # these are looked for as they are
        pairs = np.union1d(pairs, (np.arange(len(texts))[:, None] * len(index.items) + np.array(index.tiny)).ravel())
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    line = np.cumsum(points == 10)[at] if len(pairs) else None
    bounds = np.searchsorted(at, np.concatenate([[0], ends]))
    for p in pairs.tolist():
        t, i = divmod(p, len(index.items))
        lo, hi = bounds[t], bounds[t + 1]
        it = index.items[i]
        if stretch_words(it, letters[lo:hi], line[lo:hi]) >= min(MIN_WORDS, it.n_words):
            yield t, i


def leaked(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", boxes: str | None = "boxes", source: str = "source", model: Model | None = None) -> DataFrame:
    """(doc_id, item_id): every page that carries an item's whole text or an unbroken stretch of MIN_WORDS of its words.

    Words lie between blanks; a sign that stands alone counts with the words it touches, for scanning drops signs. Null
    and empty texts, and items without any letter, match nothing; an item of fewer words matches as a whole; equal items are all named; repeated
    rows of docs give repeated rows. boxes (arrays of structs with x0 and y0, one per line) give the column order;
    without them lines stay as they are. Items are indexed in blocks of bounded size, each one narrow pass over the pages;
    of several blocks the pages are repaired and ordered once and written. An item of fewer than SEED letters matches
    where a page has those letters.
    """
    spark = docs.sparkSession
    model = model or fit(docs, source, (text,))
    shared = spark.sparkContext.broadcast(model)
    known = items.filter(F.col(text).isNotNull()).select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    blocks = max(1, -(-int(known.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS))
    places = (F.col(f"{boxes}.x0").alias("x"), F.col(f"{boxes}.y0").alias("y")) if boxes else (F.lit(None).cast("array<int>").alias("x"), F.lit(None).cast("array<int>").alias("y"))
    kind = docs.schema[doc_id].dataType
    raw = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), _pool(F.col(source), 0).alias("pool"), *places).filter("text is not null and text <> ''")
    out = T.StructType([T.StructField(doc_id, kind), T.StructField(item_id, items.schema[item_id].dataType)])

    def readable(part):
        """The texts of a slice of raw pages: wrong decodings undone, lines in the order of their columns."""
        texts = part.column(1).to_pylist()
        for t, (fixed, _, _) in repair_texts(shared.value, texts, part.column(2).to_numpy()).items():
            texts[t] = fixed
        return in_columns(texts, part.column(3), part.column(4))

    def ordered(batches):
        for b in batches:
            for lo, hi in _slices(b.column(1)):
                part = b.slice(lo, hi - lo)
                yield pa.record_batch([part.column(0), pa.array(readable(part), pa.string())], names=["id", "text"])

    pages = raw if blocks == 1 else materialize(raw.mapInArrow(ordered, T.StructType([T.StructField("id", kind), T.StructField("text", T.StringType())])), "pages")
    found = None
    for k in range(blocks):
        block = known if blocks == 1 else known.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        given = spark.sparkContext.broadcast(make_index([tuple(r) for r in block.collect()]))

        def run(batches, given=given):
            idx = given.value
            sieves, kinds = opened(idx), pa.array([it.id for it in idx.items])
            for b in batches:
                for lo, hi in _slices(b.column(1)):
                    part = b.slice(lo, hi - lo)
                    texts = readable(part) if blocks == 1 else part.column(1).to_pylist()
                    got = list(leaks_in(idx, sieves, texts)) if idx.items else []
                    if got:
                        yield pa.record_batch([part.column(0).take(pa.array([g[0] for g in got])), kinds.take(pa.array([g[1] for g in got]))], names=[doc_id, item_id])

        part = pages.mapInArrow(run, out)
        found = part if found is None else found.unionByName(part)
    return found
