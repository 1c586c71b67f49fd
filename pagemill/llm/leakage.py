"""Problem 7: passages of evaluation items inside corpus documents.

Method: windows of both texts are embedded by the CGK random walk, which turns edit distance into
Hamming distance; repeated bit-sampling LSH on the embeddings gives candidate window pairs; each
is verified exactly (identical stretch, or edit distance within a band) against the two texts.
Around every verified window its neighbours are verified too, so what is covered of an item does
not hang on which of the windows met.

Windows are of the size of the part of an item that is to be found, less the stride: item windows
start at every letter, document windows at every ``stride`` letters, so a passage holds an aligned
pair at any phase, and identical stretches of ``window + stride - 1`` letters meet with certainty.
For edited passages the repetitions are derived: the fewest with which stated passages (``passage``
letters with an edit in every ``spacing``) come up with the probability ``recall``.

Items of up to ``block_letters`` letters are the stated query set: one index goes to the executors
and the documents are read once, without a shuffle. More items are joined with the documents by
window key; a table of bits of fixed size, which says what keys items have, goes to the executors,
so that only windows with such a key are shuffled.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.canonical_text import _GONE
from pagemill.session import cut_lineage

_NOT_ALNUM = re.compile(r"[\W_]+")
#: Letters of items that one index may hold: about 20 MB a repetition on each executor's worker.
BLOCK_LETTERS = 1_000_000
MOST_REPETITIONS = 64
#: Bits of the table of item keys, for more items than that: 32 MB.
KEY_BITS = 28
#: Letters of documents that are windowed at once, and windows that are embedded at once.
CHUNK_LETTERS = 1_000_000
BLOCK_WINDOWS = 32_768


@dataclass(frozen=True)
class Search:
    """What is to be found: ``recall`` of the passages of ``passage`` letters with an edit in every
    ``spacing``, and how: windows, their stride in documents, letters sampled per key."""

    window: int
    stride: int
    passage: int
    spacing: int
    recall: float
    samples: int = 8


#: Identical stretches of 42 letters are certain; one edit in 20 letters of a passage of 60.
PASSAGES = Search(31, 12, 60, 20, 0.95)
#: Identical stretches of 31 letters are certain; one edit in 15 letters of a passage of 45.
CLOSE = Search(28, 4, 45, 15, 0.99)


def letters_only(text: str | None) -> str:
    """Letters and digits; case, width and compatibility form and accent composition ignored."""
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.translate(_GONE))
        text = unicodedata.normalize("NFKC", text.casefold())
    else:
        text = text.lower()
    return _NOT_ALNUM.sub("", text)


class Embedding:
    """CGK walks and bit samples: ``keys`` maps windows to one LSH key per repetition."""

    def __init__(self, window: int, samples: int, repetitions: int, seed: int = 11):
        self.window, self.repetitions = window, repetitions
        # a walk is at step j some j / 2 letters on: 2 * window steps see the whole window
        steps = 2 * window
        rngs = [np.random.default_rng((seed, r)) for r in range(repetitions)]
        self.mul = np.array([g.integers(1, 2**63, steps, dtype=np.uint64) for g in rngs]) | np.uint64(1)
        self.sampled = [np.isin(np.arange(steps), g.choice(steps, min(samples, steps), replace=False)) for g in rngs]

    def only(self, r: int) -> Embedding:
        """One repetition alone."""
        one = Embedding(self.window, 1, 1)
        one.repetitions, one.mul, one.sampled = 1, self.mul[r : r + 1], self.sampled[r : r + 1]
        return one

    def keys(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(repetitions, windows) keys of the windows of ``codes`` that begin at ``starts``."""
        out = np.empty((self.repetitions, len(starts)), np.uint64)
        wide = np.append(codes.astype(np.uint64), np.zeros(2 * self.window, np.uint64))
        for a in range(0, len(starts), BLOCK_WINDOWS):
            block = starts[a : a + BLOCK_WINDOWS]
            for r in range(self.repetitions):
                at = block.astype(np.int64)
                key = np.full(len(block), r + 1, np.uint64)
                for j in range(int(np.nonzero(self.sampled[r])[0].max()) + 1):
                    c = wide[at]
                    if j >= self.window:
                        c[at >= block + self.window] = 0  # padding for walks that have left the window
                    if self.sampled[r][j]:
                        key ^= c
                        key *= np.uint64(0x9E3779B97F4A7C15)
                        key ^= key >> np.uint64(31)
                    c += np.uint64(j)
                    c *= self.mul[r, j]
                    c >>= np.uint64(63)
                    at += c.view(np.int64)
                out[r, a : a + BLOCK_WINDOWS] = key
        return out


def window_starts(texts: list[str], window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows in the joined texts, the text of each, and where each text begins."""
    size = np.array([len(t) for t in texts], np.int64)
    base = np.append(0, np.cumsum(size))
    each = np.maximum(0, (size - window) // stride + 1)
    owner = np.repeat(np.arange(len(texts)), each)
    return base[owner] + stride * (np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)), owner, base


def letter_codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def edit_within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``; only a band of the table is filled."""
    if abs(len(a) - len(b)) > most:
        return False
    row = {j: j for j in range(min(most, len(b)) + 1)}
    for i, ca in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            if j == 0:
                new[j] = i
                continue
            new[j] = min(row.get(j - 1, 99) + (ca != b[j - 1]), row.get(j, 99) + 1, new.get(j - 1, 99) + 1)
        row = new
        if min(row.values()) > most:
            return False
    return row.get(len(b), 99) <= most


class ItemIndex:
    """The windows of a block of items, by LSH key."""

    def __init__(self, ids: list[int], texts: list[str], emb: Embedding):
        self.emb, self.ids, self.texts = emb, ids, texts
        self.codes = codes = letter_codes(texts)
        self.start, self.owner, base = window_starts(texts, emb.window, 1)
        self.offset, self.end = self.start - base[self.owner], base[1:]
        keys = emb.keys(codes, self.start)
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.sorted = np.take_along_axis(keys, self.order, axis=1)

    def candidates(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window pairs (row of ``keys``, item window) that agree in any repetition, each once."""
        pairs, size = [], max(1, len(self.owner))
        for r in range(self.emb.repetitions):
            a = np.searchsorted(self.sorted[r], keys[r], "left")
            hit = np.nonzero(self.sorted[r][np.minimum(a, size - 1)] == keys[r])[0]
            n = np.searchsorted(self.sorted[r], keys[r][hit], "right") - a[hit]
            at = np.repeat(a[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pairs.append(np.repeat(hit, n) * size + self.order[r][at])
        both = np.unique(np.concatenate(pairs))
        return both // size, both % size


def common_run(a: str, i: int, b: str, j: int) -> tuple[int, int]:
    """Start in ``a`` and length of the identical stretch around a[i] = b[j]."""
    lo = 0
    while i - lo > 0 and j - lo > 0 and a[i - lo - 1] == b[j - lo - 1]:
        lo += 1
    hi = 0
    while i + hi < len(a) and j + hi < len(b) and a[i + hi] == b[j + hi]:
        hi += 1
    return i - lo, lo + hi


def spread_edits(texts: np.ndarray, spacing: int, kind: str, rng: np.random.Generator) -> list[np.ndarray]:
    """Each row with one edit in every ``spacing`` letters: ``sub``, ``del``, ``ins``, or any (``mix``)."""
    out = []
    for row in texts:
        letters = row.tolist()
        for a in range(len(letters) // spacing * spacing - spacing, -1, -spacing):
            at, new = a + int(rng.integers(spacing)), int(rng.integers(97, 123))
            k = kind if kind != "mix" else ("sub", "del", "ins")[int(rng.integers(3))]
            letters[at : at + (k != "ins")] = [] if k == "del" else [new]
        out.append(np.array(letters, np.uint32))
    return out


def tune(search: Search, count: int = 1000) -> tuple[int, float]:
    """The fewest repetitions that bring up an aligned window of the stated passages, of random
    letters and at any phase, for the worst kind of edit; and the share of them that come up."""
    rng = np.random.default_rng(23)
    w, passage = search.window, max(search.passage, search.window)
    whole = rng.integers(97, 123, (count, passage), dtype=np.uint32)
    n = passage - w + 1
    item_starts = (np.arange(count)[:, None] * passage + np.arange(n)).ravel()
    item_of = np.repeat(np.arange(count, dtype=np.uint64), n)
    cases = []
    for kind in ("sub", "del", "ins"):
        edited = spread_edits(whole, search.spacing, kind, rng)
        base = np.cumsum([0, *map(len, edited)])[:-1]
        at = [np.arange(int(rng.integers(search.stride)), len(e) - w + 1, search.stride) for e in edited]
        cases.append((np.concatenate(edited), np.concatenate([b + x for b, x in zip(base, at)]).astype(np.int64), np.repeat(np.arange(count, dtype=np.uint64), [len(x) for x in at])))
    mark = lambda of: of * np.uint64(0xD6E8FEB86659FD93)
    all_ = Embedding(w, search.samples, MOST_REPETITIONS)
    met, reached = [np.zeros(count, bool) for _ in cases], 0.0
    for r in range(MOST_REPETITIONS):
        one = all_.only(r)
        ours = one.keys(whole.ravel(), item_starts)[0] + mark(item_of)
        for (codes, starts, of), m in zip(cases, met):
            m[of[np.isin(one.keys(codes, starts)[0] + mark(of), ours)].astype(np.int64)] = True
        reached = min(float(m.mean()) for m in met)
        if reached >= search.recall:
            return r + 1, reached
    return MOST_REPETITIONS, reached


def most_edits(search: Search) -> int:
    """Edits that a window can hold if every ``spacing`` letters hold one."""
    return -(-(search.window - 1) // search.spacing) + 1


def near_spans(codes: np.ndarray, at: np.ndarray, index: ItemIndex, item: np.ndarray, q: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose document window at ``codes[at]`` is within ``most`` edits of a stretch of the item
    around position ``q`` of all items' letters; start and end of that stretch. All rows are filled
    together, in a band of ``most`` diagonals on either side."""
    w, width = index.emb.window, 2 * most + 1
    rows = np.arange(len(at))
    low, high = (index.end - np.array([len(t) for t in index.texts], np.int64))[item], index.end[item]
    cost = [np.zeros(len(at), np.int16) for _ in range(width)]
    begin = [q - most + b for b in range(width)]
    for i in range(w):
        if i % 6 == 5:  # most pairs that met by chance are far apart after a few letters
            ok = np.minimum.reduce(cost) <= most
            rows, at, q, low, high = (x[ok] for x in (rows, at, q, low, high))
            cost, begin = [x[ok] for x in cost], [x[ok] for x in begin]
        mine = codes[at + i]
        new, first = [], []
        for b in range(width):
            to = q - most + i + b
            inside = (to >= low) & (to < high)
            other = index.codes[np.clip(to, 0, len(index.codes) - 1)]
            c, s = cost[b] + ~(inside & (mine == other)), begin[b]
            if b + 1 < width:
                less = cost[b + 1] + 1 < c
                c, s = np.where(less, cost[b + 1] + 1, c), np.where(less, begin[b + 1], s)
            if b:
                less = new[b - 1] + 1 < c
                c, s = np.where(less, new[b - 1] + 1, c), np.where(less, first[b - 1], s)
            new.append(c.astype(np.int16))
            first.append(s)
        cost, begin = new, first
    # the middle diagonal first, so that a tie is not drawn to the edge of the band
    order = sorted(range(width), key=lambda b: abs(b - most))
    best = np.stack([cost[b] for b in order]).argmin(axis=0)
    pick = np.array(order)[best]
    least = np.stack(cost)[pick, np.arange(len(rows))]
    start = np.stack(begin)[pick, np.arange(len(rows))]
    end = q - most + w + pick
    ok = least <= most
    return rows[ok], np.clip(start, low, high)[ok], np.clip(end, low, high)[ok]


def match_texts(texts: list[str], index: ItemIndex, stride: int, max_edits: int) -> list[tuple[int, int, int, int]]:
    """(text, item, longest identical stretch, letters of the item covered by verified windows)."""
    w = index.emb.window
    start, owner, base = window_starts(texts, w, stride)
    if not len(start) or not len(index.owner):
        return []
    codes = letter_codes(texts)
    inner = np.zeros(len(codes) + 1, bool)
    # inside a run of one letter every window meets what the first and the last window of it meet
    turns = np.append(0, np.cumsum(codes[1:] != codes[:-1]))
    p = np.arange(stride, max(stride, len(codes) - w - stride + 1))
    text_of = np.searchsorted(base, p, "right") - 1
    p = p[(p - stride >= base[text_of]) & (p + w + stride <= base[text_of + 1])]
    inner[p] = turns[p + w + stride - 1] == turns[p - stride]
    owner, start = owner[~inner[start]], start[~inner[start]]
    mine, theirs = index.candidates(index.emb.keys(codes, start))
    doc, item, p, q = owner[mine], index.owner[theirs], start[mine], index.start[theirs]
    same = np.ones(len(p), bool)
    for j in range(w):
        same &= codes[p + j] == index.codes[q + j]
    found: dict[tuple[int, int], list] = {}
    for d, i, k, j in zip(doc[same].tolist(), (p - base[doc])[same].tolist(), item[same].tolist(), index.offset[theirs][same].tolist()):
        best = found.setdefault((d, k), [0, [], {}])
        if best[2].get(j - i, -1) >= i + w:  # this diagonal is verified up to here already
            continue
        a, n = common_run(texts[d], i, index.texts[k], j)
        best[0] = max(best[0], n)
        best[1].append((j - i + a, j - i + a + n))
        best[2][j - i] = a + n
    if max_edits:
        wide = len(index.codes) + len(codes) + 2 * max_edits + 2  # a number for each pair of a window and a diagonal
        number = lambda p, q: p * wide + (q - p + len(codes) + max_edits)
        seen = np.unique(number(p[same], q[same]))
        ok = same.copy()
        ok[np.nonzero(~same)[0][near_spans(codes, p[~same], index, item[~same], q[~same], max_edits)[0]]] = True
        # from here on windows next to verified ones, first those that met
        doc, item, p, q = doc[ok], item[ok], p[ok], q[ok]
        todo = (doc[~same[ok]], item[~same[ok]], p[~same[ok]], q[~same[ok]])
        near = (doc[same[ok]], item[same[ok]], p[same[ok]], q[same[ok]])
        while len(todo[0]) or len(near[0]):
            for step in (-1, 1):
                edge = ~np.isin(number(near[2] + step, near[3] + step), seen)
                far = step * np.arange(1, w + 1)
                d, k = (np.repeat(x[edge], w) for x in near[:2])
                a, b = ((x[edge][:, None] + far).ravel() for x in near[2:])
                inside = (a >= base[d]) & (a + w <= base[d + 1]) & ~inner[np.clip(a, 0, len(codes))] & (b + w + max_edits > 0) & (b < len(index.codes) + max_edits)
                todo = tuple(np.concatenate([x, y[inside]]) for x, y in zip(todo, (d, k, a, b)))
            key, once = np.unique(number(todo[2], todo[3]), return_index=True)
            once = once[~np.isin(key, seen)]
            seen = np.union1d(seen, key)
            todo = tuple(x[once] for x in todo)
            at, lo, hi = near_spans(codes, todo[2], index, todo[1], todo[3], max_edits)
            near = (todo[0][at], todo[1][at], todo[2][at], lo)
            first = index.end[near[1]] - np.array([len(t) for t in index.texts], np.int64)[near[1]]
            for d, k, a, b in zip(near[0].tolist(), near[1].tolist(), (lo - first).tolist(), (hi - first).tolist()):
                found.setdefault((d, k), [0, [], {}])[1].append((a, b))
            todo = tuple(x[:0] for x in todo)
    out = []
    for (d, k), (longest, spans, _) in found.items():
        covered, end = 0, 0
        for a, b in sorted(spans):
            covered += max(0, b - max(a, end))
            end = max(end, b)
        if covered:
            out.append((d, k, longest, covered))
    return out


def _clean(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t): keys and letters of the rows that have both."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"k": pdf["k"], "t": [letters_only(t) for t in pdf["t"]]})

    kind = df.schema[key].dataType.simpleString()
    return df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, t string")


def leaks(docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text", search: Search = CLOSE, repetitions: int | None = None, max_edits: int | None = None, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """(doc, item, longest_run, covered, item_letters): documents that hold passages of items.

    longest_run is the longest identical stretch found, covered the letters of the item inside
    verified windows. Every common stretch of ``window + stride - 1`` letters is found, and the
    stated share of edited passages; ``repetitions`` and ``max_edits`` follow from the search if
    they are not given. Texts that are null, empty or shorter than a window, and rows without an id,
    match nothing; repeated rows each give their own. Whole texts are read.
    """
    spark = docs.sparkSession
    kinds = docs.schema[doc].dataType.simpleString(), items.schema[item].dataType.simpleString()
    schema = f"{doc} {kinds[0]}, {item} {kinds[1]}, longest_run int, covered int, item_letters int"
    columns = [doc, item, "longest_run", "covered", "item_letters"]
    if max_edits is None:
        max_edits = most_edits(search)
    if repetitions is None:
        repetitions = tune(search)[0]
    emb, stride = Embedding(search.window, search.samples, repetitions), search.stride
    cleaned = cut_lineage(_clean(items, item, text), "p7-items")
    size = cleaned.agg(F.sum(F.length("t"))).collect()[0][0] or 0
    if size > block_letters:
        return _joined(docs, cleaned, doc, text, emb, stride, max_edits, schema, columns)
    rows = cleaned.where(F.length("t") >= search.window).collect()  # block_letters letters at most
    shared = spark.sparkContext.broadcast(ItemIndex([r["k"] for r in rows], [r["t"] for r in rows], emb))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for pdf in batches:
            rows: list[tuple] = []
            chunk: list[str] = []
            keys: list = []
            size = 0

            def flush() -> None:
                for d, k, longest, covered in match_texts(chunk, index, stride, max_edits):
                    rows.append((keys[d], index.ids[k], longest, covered, len(index.texts[k])))

            for d, t in zip(pdf["d"], pdf["t"]):
                chunk.append(letters_only(t))
                keys.append(d)
                size += len(chunk[-1])
                if size >= CHUNK_LETTERS:
                    flush()
                    chunk, keys, size = [], [], 0
            flush()
            yield pd.DataFrame(rows, columns=columns)

    return docs.where(F.col(text).isNotNull() & F.col(doc).isNotNull()).select(F.col(doc).alias("d"), F.col(text).alias("t")).mapInPandas(run, schema)


def _joined(docs: DataFrame, items: DataFrame, doc: str, text: str, emb: Embedding, stride: int, max_edits: int, schema: str, columns: list[str]) -> DataFrame:
    """The same for any number of items: windows meet by their key in a shuffle, pairs of a document
    and an item that met are verified on their own."""
    spark, w, bits = docs.sparkSession, emb.window, np.uint64(64 - KEY_BITS)

    def windows(df: DataFrame, step: int, known=None) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                texts = pdf["t"].tolist()
                start, owner, _ = window_starts(texts, w, step)
                keys = emb.keys(letter_codes(texts), start)
                k, of = keys.ravel(), np.tile(owner, emb.repetitions)
                if known is not None:
                    slot = (k * np.uint64(0x9E3779B97F4A7C15)) >> bits
                    hit = (known.value[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
                    k, of = k[hit], of[hit]
                yield pd.DataFrame({"key": k.view(np.int64), "k": pdf["k"].to_numpy()[of]}).drop_duplicates()

        return df.mapInPandas(run, f"key long, k {df.schema['k'].dataType.simpleString()}").distinct()

    theirs = cut_lineage(windows(items, 1), "p7-item-windows")

    def word_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = (pdf["key"].to_numpy(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> bits
            yield pd.DataFrame({"word": (s >> np.uint64(6)).astype(np.int64), "bit": (np.uint64(1) << (s & np.uint64(63))).view(np.int64)}).groupby("word", as_index=False).agg(bit=("bit", np.bitwise_or.reduce))

    table = np.zeros(1 << (KEY_BITS - 6), np.uint64)
    words = theirs.select("key").mapInPandas(word_bits, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()  # as many rows as the table has words
    table[words["word"].to_numpy(np.int64)] = words["bit"].to_numpy(np.int64).view(np.uint64)
    cleaned = _clean(docs, doc, text)
    mine = windows(cleaned, stride, spark.sparkContext.broadcast(table))
    met = cut_lineage(mine.select("key", F.col("k").alias("d")).join(theirs.select("key", F.col("k").alias("i")), "key").select("d", "i").distinct(), "p7-met")
    pairs = met.join(cleaned.select(F.col("k").alias("d"), F.col("t").alias("dt")), "d").join(items.select(F.col("k").alias("i"), F.col("t").alias("it")), "i")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for d, i, dt, it in zip(pdf["d"], pdf["i"], pdf["dt"], pdf["it"]):
                rows += [(d, i, longest, covered, len(it)) for _, _, longest, covered in match_texts([dt], ItemIndex([i], [it], emb), stride, max_edits)]
            yield pd.DataFrame(rows, columns=columns)

    return pairs.select("d", "i", "dt", "it").mapInPandas(verify, schema)


def leaked(docs: DataFrame, items: DataFrame, min_run: int = 60, search: Search = PASSAGES) -> DataFrame:
    """(doc_id, item_id): a common stretch of at least ``min_run`` letters or digits, which has to be
    one that the search is certain to meet."""
    if search.window + search.stride - 1 > min_run:
        raise ValueError("windows and their stride are longer than the stretch to be found")
    return leaks(docs, items, search=search).where(F.col("longest_run") >= min_run).select("doc_id", "item_id").distinct()


def leak_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per item: its split, documents that hold passages of it, and the largest share of it in one."""
    found = leaks(docs, items)
    return (
        items.select("item_id", "split")
        .join(found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("docs"), F.max(F.col("covered") / F.col("item_letters")).alias("largest_share")), "item_id", "left")
        .select("item_id", "split", F.coalesce("docs", F.lit(0)).cast("bigint").alias("docs"), F.coalesce("largest_share", F.lit(0.0)).alias("largest_share"))
    )
