"""Problem 9: texts that a field limit or a broken transfer cut off, and their rate per source.

Method: intact values (bounded sample) are cut artificially to make positives; a hashed logistic
regression over closing characters, punctuation, the open sentence and length-to-limit is trained
on them in numpy; every record is scored. Intact values also come without their last full stop, or
with an ellipsis for it, as negatives: an unusual ending alone is no cut.

What follows the last sentence (emoticons, remarks in brackets, signatures, an ellipsis) is peeled
off first, so it decides nothing by itself. Word statistics (how often a word stands inside and at
the end of a sentence) are counted over all documents, by hash bucket; length limits come from the
lengths of all documents per source.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BITS = 18
WORD_BITS = 18
_END = ".!?。！？．｡"
_CLOSE = "\"'”’»」』）)]】〉》*_"
_SENTENCE = re.compile(rf"[{re.escape(_END)}][{re.escape(_CLOSE)}]*(?:\s+|(?<=[。！？｡])|(?<=[」』]))")
_DOTS = "…‥⋯"
_FACE = re.compile(r"\^[_.]?\^|[:;=]-?[)(DPp]|<3|[xX]D|[♪♥★☆]+|w{2,}|ㅋ+|ㅎ+")
_REMARK = re.compile(r"\s[(\[（【][^()\[\]（）【】\n]{1,24}[)\]）】]$")
_SIGNED = re.compile(r"[-–—~]\s*\S{1,30}(?:\s\S{1,30})?|[A-Z]{2,4}\s?[/:]\s?\S{1,30}")
_ENTITY = re.compile(r"&#?[a-zA-Z0-9]{0,8}$")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_SPEAKER = re.compile(r"^\s*\S{1,30}(?: \S{1,30})?[:：]\s")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
_KO = re.compile(r"[가-힣ᄀ-ᇿ]")
_QUOTE = re.compile(r"\n\s*“|[“”「」]")


def _hash(*parts: object) -> int:
    return zlib.crc32("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"))


@lru_cache(1 << 16)
def word_bucket(w: str) -> int:
    return _hash("w", w) & ((1 << WORD_BITS) - 1)


def end_of(t: str) -> int:
    """Where the full stop that ends a text stands, whatever number of closing marks follows; -1 if
    none does."""
    at = len(t.rstrip(_CLOSE)) - 1
    return at if at >= 0 and t[at] in _END else -1


def without_dots(t: str) -> str:
    """The text without an ellipsis at its end; the same if there is none."""
    bare = t.rstrip()
    if bare[-1:] in _DOTS and bare:
        return bare[:-1].rstrip()
    return bare.rstrip(".").rstrip() if bare.endswith("..") else t


def peel(text: str) -> tuple[str, bool]:
    """The text without what was added after its last sentence, and whether an ellipsis was."""
    t, dots = text.rstrip(), False
    t = t.rstrip("​‌‍⁠﻿­").rstrip()
    while True:
        line = t.rfind("\n")
        word = max(line, *(t.rfind(c) for c in " \t\u3000\u00a0"))
        if line > 0 and _SIGNED.fullmatch(t[line + 1 :].lstrip()):
            t = t[:line].rstrip()
        elif word > 0 and _FACE.fullmatch(t[word + 1 :]):
            t = t[:word].rstrip()
        elif (m := _REMARK.search(t, max(0, len(t) - 27))) and m.start() > 0:  # a remark has 27 characters at most
            t = t[: m.start()].rstrip()
        elif (less := without_dots(t)) != t:
            t, dots = less, True
        else:
            return t, dots


def markup_open(t: str) -> bool:
    """Whether a text ends inside a tag or a character reference."""
    tail = t[max(0, t.rfind("<")) :]
    tag = tail[:1] == "<" and ">" not in tail and "\n" not in tail and (len(tail) == 1 or tail[1] in "/!" or (tail[1].isascii() and tail[1].isalpha()))
    return tag or bool(_ENTITY.search(t, max(0, len(t) - 10)))


def quotation_open(t: str) -> bool:
    """Whether a quotation is open at the end. An open one may begin again with a paragraph."""
    double = corner = 0
    for q in _QUOTE.findall(t):
        if q == "「":
            corner += 1
        elif q == "」":
            corner = max(0, corner - 1)
        elif q == "”":
            double = max(0, double - 1)
        else:
            double = double + 1 if q == "“" else max(1, double)
    return double > 0 or corner > 0


def last_sentence(t: str) -> tuple[str, bool]:
    """The last sentence of a peeled text, as far as it goes, and whether it is ended."""
    stop = end_of(t)
    body = t[:stop] if stop >= 0 else t
    at = 0
    for m in _SENTENCE.finditer(body):
        at = m.end()
    s = body[at:]
    m = _SPEAKER.match(s)
    return (s[m.end() :] if m else s), stop >= 0


class Statistics:
    """Per word bucket: counts inside sentences and at the end of one."""

    def __init__(self, inside: np.ndarray, final: np.ndarray, limits: dict[str, list[tuple[str, int]]]):
        self.inside, self.final, self.limits = inside, final, limits

    def known(self, w: str) -> int:
        k = word_bucket(w)
        return min(4, int(math.log2(1 + self.inside[k] + self.final[k])) // 2)

    def ends(self, w: str) -> int:
        k = word_bucket(w)
        a, b = float(self.inside[k]), float(self.final[k])
        return -1 if a + b < 2 else int(4 * (b + 0.1) / (a + b + 0.2))

    def at_limit(self, source: str | None, text: str) -> bool:
        own = self.limits.get(source or "", ())
        if not own:
            return False
        bare = text.rstrip()
        chars, size = {len(text), len(bare)}, {len(x.encode("utf-8", "surrogatepass")) for x in (text, bare)}
        return any(limit in chars if unit == "chars" else any(limit - 3 <= n <= limit for n in size) for unit, limit in own)


def count_words(texts: Iterator[str], inside: np.ndarray, final: np.ndarray) -> None:
    """Add the words of whole texts; the last word of the last open sentence counts nowhere."""
    for t in texts:
        ends = [m.start() for m in _SENTENCE.finditer(t)] + ([len(t)] if end_of(t.rstrip()) >= 0 and without_dots(t) == t else [])
        found = [*_WORD.finditer(t)]
        if not found:
            continue
        start = np.array([m.start() for m in found])
        bucket = np.array([word_bucket(m.group().lower()) for m in found])
        # a word is final if a sentence ends after it and before the next one begins
        closed = np.searchsorted(ends, np.append(start[1:], len(t) + 1), "left") > np.searchsorted(ends, start, "left")
        np.add.at(final, bucket[closed], 1)
        open_ = ~closed
        open_[-1] = False
        np.add.at(inside, bucket[open_], 1)


def hashed(text: str, source: str | None, st: Statistics) -> list[int]:
    """The feature buckets of a text. An empty text has features of its own."""
    core, dots = peel(text)
    s, ended = last_sentence(core)
    words = [w.lower() for w in _WORD.findall(s)]
    raw = _WORD.findall(s)
    script = "j" if _CJK.search(s) else "k" if _KO.search(s) else "l"
    state = "e" if ended else "o"
    space = (state, script)
    out = [_hash(*space, "bias"), _hash(*space, "dots", dots)]
    add = lambda *p: out.append(_hash(*space, *p))
    end = core[-1:]
    markup = markup_open(core)
    add("markup", markup)
    add("broken", "�" in core[-4:])
    add("opens", quotation_open(core))
    for n in (1, 2, 3, 4):
        add("c", n, core[-n:].lower() if script == "l" else core[-n:])
    add("kind", "p" if end and not end.isalnum() else "a", end if end and not end.isalnum() else "")
    if not ended:
        add("limit", st.at_limit(source, text))
    n = min(len(words), 40)
    last = words[-1] if words else ""
    known, ends = (st.known(last), st.ends(last)) if words else (-1, -1)
    capital = bool(raw) and raw[-1][:1].isupper() and raw[-1] != raw[-1].upper()
    add("n", n)
    add("known", known, capital)
    add("ends", ends, known, capital)
    add("last", last if known >= 1 else last[-2:])
    # the sentence's skeleton: frequent words as they are, others by what is known of them
    shape = [w if st.known(w) >= 3 and st.ends(w) <= 0 else ("N" if r[:1].isupper() and i else "E" if st.ends(w) >= 1 else "W" if st.known(w) >= 1 else "U") for i, (w, r) in enumerate(zip(words, raw))]
    for k in (1, 2, 3, 4, 6):
        add("s", k, *shape[-k:])
    head = ["N" if i == 0 and w == "U" else w for i, w in enumerate(shape[:2])]  # a name may begin a sentence
    add("first", *words[:2], n)
    add("head1", *head[:1], n)
    add("head2", *head, n)
    add("head2s", *head, n, *shape[-1:])
    add("head1s", *head[:1], *shape[-3:])
    add("head2k", *head, n, known, ends, capital)
    add("all", *head, *shape[2:])
    add("tailk", *shape[-3:-1], known, ends, capital)
    add("since", *next(((w, len(words) - i) for i, w in reversed([*enumerate(shape)]) if w not in "NEWU"), ("", 0)))
    add("since2", *[w for w in shape if w not in "NEWU"][-2:], len(words) - max((i for i, w in enumerate(shape) if w not in "NEWU"), default=0), *shape[-1:])
    return [h & ((1 << BITS) - 1) for h in out]


def cut(text: str, rng: np.random.Generator) -> str | None:
    """An intact text cut inside a sentence, with one of the things that may follow a cut."""
    core, _ = peel(text)
    if len(core) < 12:
        return None
    at = int(rng.integers(max(6, len(core) - 300), len(core) - 1))
    t = core[:at].rstrip()
    if not t or end_of(t) >= 0 or t[-1] in ":：" or len(t) < 4:
        return None
    x = rng.random()
    if x < 0.40:
        return t + ("…" if rng.random() < 0.7 else "..." if rng.random() < 0.7 else " …")
    if x < 0.45:
        return t + ("&quot;"[: int(rng.integers(1, 6))] if rng.random() < 0.5 else '<a href="'[: int(rng.integers(1, 9))])
    return t + "�" if x < 0.48 else t


def cut_at(text: str, unit: str, limit: int, rng: np.random.Generator) -> str | None:
    """An intact text cut by a field limit, with the ellipsis inside the limit or none at all."""
    mark = "" if rng.random() < 0.6 else "…" if rng.random() < 0.5 else "..."
    if unit == "chars":
        t = text[: limit - len(mark)]
    else:
        t = text.encode("utf-8", "replace")[: limit - len(mark.encode())].decode("utf-8", "ignore")
    if len(t) + len(mark) >= len(text) or not t or not t[-1].isalnum():
        return None
    return t + mark


def soften(text: str, rng: np.random.Generator) -> str | None:
    """An intact text with another ending: no full stop, or an ellipsis for it."""
    core, _ = peel(text)
    stop = end_of(core)
    if stop < 0:
        return None
    t = core[:stop]
    if not t or not t[-1].isalnum():
        return None
    return t if rng.random() < 0.6 else t + ("…" if rng.random() < 0.7 else "...")


class CutModel:
    def __init__(self, weights: np.ndarray, threshold: float, held_out: dict[str, float]):
        self.weights, self.threshold, self.held_out = weights, threshold, held_out
        #: per source: share of held-out cuts that are found, of held-out intact values that are flagged
        self.per_source: dict[str | None, tuple[float | None, float | None]] = {}

    def score(self, features: list[list[int]]) -> np.ndarray:
        if not features:
            return np.zeros(0)
        size = np.array([len(f) for f in features])
        flat = np.concatenate([np.array(f, dtype=np.int64) for f in features])
        z = np.add.reduceat(self.weights[flat], np.concatenate([[0], np.cumsum(size)[:-1]]))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(values: list[tuple[str, str | None]], st: Statistics, epochs: int = 6, rate: float = 0.25, batch: int = 256, l2: float = 1e-5, seed: int = 3) -> CutModel:
    """Fit on intact values (text, source): each as it is, softened, cut twice, and cut once at a
    field limit if it is longer than one. A fifth of the values is held out, with all that was made
    of them, for the reported rates."""
    fields = [(s, unit, n) for s, own in sorted(st.limits.items()) for unit, n in own]
    rng = np.random.default_rng(seed)
    feats: list[list[int]] = []
    y: list[int] = []
    held: list[bool] = []
    origin: list[str | None] = []
    for i, (t, source) in enumerate(values):
        made = [(t, source, 0), (soften(t, rng), source, 0), (cut(t, rng), source, 1), (cut(t, rng), source, 1)]
        if fields:
            of, unit, n = fields[int(rng.integers(len(fields)))]
            made.append((cut_at(t, unit, n, rng), of, 1))
        for v, src, label in made:
            if v is not None:
                feats.append(hashed(v, src, st))
                y.append(label)
                held.append(i % 5 == 0)
                origin.append(src)
    w = np.zeros(1 << BITS)
    if not feats:
        return CutModel(w, 2.0, {})  # without intact values nothing is called truncated
    size = np.array([len(f) for f in feats])
    start = np.concatenate([[0], np.cumsum(size)])
    flat = np.concatenate([np.array(f, dtype=np.int64) for f in feats])
    label = np.array(y, dtype=float)
    ids = np.nonzero(~np.array(held))[0]
    seen = np.zeros(1 << BITS)
    for _ in range(epochs):
        rng.shuffle(ids)
        for a in range(0, len(ids), batch):
            sel = ids[a : a + batch]
            idx = np.concatenate([flat[start[i] : start[i + 1]] for i in sel])
            n = size[sel]
            z = np.add.reduceat(w[idx], np.concatenate([[0], np.cumsum(n)[:-1]]))
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[sel]
            u, inv = np.unique(idx, return_inverse=True)
            gu = np.bincount(inv, weights=np.repeat(g, n)) + l2 * len(ids) * w[u] * (len(sel) / len(ids))
            seen[u] += gu * gu
            w[u] -= rate * gu / np.sqrt(seen[u] + 1e-6)
    m = CutModel(w, 0.5, {})
    out = [i for i, h in enumerate(held) if h]
    if out:
        p, truth = m.score([feats[i] for i in out]) >= 0.5, label[out] > 0
        m.held_out = {"cut_found": float(p[truth].mean()) if truth.any() else 0.0, "intact_flagged": float(p[~truth].mean()) if (~truth).any() else 0.0, "values": float(len(out))}
    for src in {origin[i] for i in out}:
        own = [k for k, i in enumerate(out) if origin[i] == src]
        q, real = p[own], truth[own]
        m.per_source[src] = (float(q[real].mean()) if real.any() else None, float(q[~real].mean()) if (~real).any() else None)
    return m


def statistics(docs: DataFrame, text: str, source: str) -> Statistics:
    """Word and length statistics over all rows. What comes to the driver is bounded by the number
    of buckets, and by the few lengths per source at which texts pile up."""
    size = 1 << WORD_BITS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inside, final = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for pdf in batches:
            count_words((t for t in pdf["t"] if t), inside, final)
        k = np.nonzero(inside + final)[0]
        yield pd.DataFrame({"bucket": k, "inside": inside[k], "final": final[k]})

    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("t"))
    inside, final = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in rows.mapInPandas(run, "bucket int, inside long, final long").groupBy("bucket").agg(F.sum("inside").alias("a"), F.sum("final").alias("b")).collect():
        inside[r["bucket"]], final[r["bucket"]] = r["a"], r["b"]
    return Statistics(inside, final, limits(docs, text, source))


def limits(docs: DataFrame, text: str, source: str, pile: float = 8.0, least: int = 5) -> dict[str, list[tuple[str, int]]]:
    """Lengths, in characters or bytes, at which a source has far more texts than around them."""
    out: dict[str, list[tuple[str, int]]] = {}
    body = F.col(text)
    lengths = F.array(F.struct(F.lit("chars").alias("unit"), F.length(body).alias("n")), F.struct(F.lit("bytes").alias("unit"), F.octet_length(body).alias("n")))
    each = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(source), F.lit("")).alias("s"), F.inline(lengths)).groupBy("s", "unit", "n").agg(F.count("*").alias("c"))
    # a byte limit cuts at up to three bytes less: windows of 4 against the 40 lengths around
    near = each.select("s", "unit", "c", F.explode(F.when(F.col("unit") == "bytes", F.sequence(F.col("n"), F.col("n") + 3)).otherwise(F.array("n"))).alias("n")).groupBy("s", "unit", "n").agg(F.sum("c").alias("c"))
    around = each.select("s", "unit", "c", F.explode(F.sequence(F.col("n") - 20, F.col("n") + 20)).alias("n")).groupBy("s", "unit", "n").agg(F.sum("c").alias("all"))
    width = F.when(F.col("unit") == "bytes", 4.0).otherwise(1.0)
    usual = (F.col("all") - F.col("c") + 1) / (41.0 - width) * width
    piles = near.join(around, ["s", "unit", "n"]).where((F.col("c") >= least) & (F.col("c") >= pile * usual))
    for r in piles.orderBy("s", "unit", "n").collect():
        out.setdefault(r["s"], []).append((r["unit"], r["n"]))
    return out


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", sample_rows: int = 6000) -> tuple[CutModel, Statistics]:
    """Statistics over all documents, and the model from at most ``sample_rows`` intact ones: texts
    that end a sentence, chosen by hash of the key."""
    st = statistics(docs, text, source)
    ended = F.substring(F.rtrim(F.col(text)), -12, 12).rlike(r"[^.…‥⋯\s][.!?。！？][\"'”’»」』）)\]]*$")  # an ellipsis may hide a cut
    pool = docs.where(F.col(text).isNotNull() & ended)
    n = pool.count()
    share = min(1.0, 2 * sample_rows / max(1, n))  # what is sorted and sent to the driver stays bounded
    h = F.xxhash64(F.col(key).cast("string"), F.lit("cut"))
    rows = pool.select(F.col(text).alias("t"), F.col(source).alias("s"), h.alias("h")).where(F.pmod("h", F.lit(1_000_000)) < math.ceil(share * 1_000_000)).orderBy("h").limit(sample_rows).collect()
    return train([(r["t"], r["s"]) for r in rows], st), st


def scored(docs: DataFrame, model: CutModel, st: Statistics, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, probability, truncated) of every row with a key. A null or blank text is not
    truncated, a null source has no limits; repeated rows are each scored."""
    b = docs.sparkSession.sparkContext.broadcast((model, st))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, s = b.value
        for pdf in batches:
            body = [t is not None and bool(t.strip()) for t in pdf["t"]]
            p = m.score([hashed(t if ok else "", src, s) for t, src, ok in zip(pdf["t"], pdf["s"], body)])
            p = np.where(body, p, 0.0)
            yield pd.DataFrame({"k": pdf["k"], "s": pdf["s"], "probability": p, "truncated": p >= m.threshold})

    kind = docs.schema[key].dataType.simpleString()
    out = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(source).alias("s"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, s string, probability double, truncated boolean")
    return out.withColumnRenamed("k", key).withColumnRenamed("s", source)


def truncated(docs: DataFrame) -> DataFrame:
    """(doc_id): documents cut inside a word or sentence."""
    model, st = fit(docs)
    return scored(docs, model, st).where("truncated").select("doc_id")


def rates(docs: DataFrame) -> DataFrame:
    """Per source: documents, truncated ones, their rate, and what the model does on held-out values
    of the source (sources of the bounded sample only): the share of artificial cuts that it finds,
    and of intact values that it flags."""
    model, st = fit(docs)
    per = scored(docs, model, st).groupBy("source").agg(F.count("*").alias("docs"), F.count_if("truncated").alias("truncated"), F.avg(F.col("truncated").cast("double")).alias("rate"))
    held = docs.sparkSession.createDataFrame([(s, *x) for s, x in model.per_source.items()], "s string, held_out_found double, held_out_flagged double")
    return per.join(held, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
