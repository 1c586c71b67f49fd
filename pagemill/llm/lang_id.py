"""Problem 3: the language of each text and of each one-language stretch of it.

Method: averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient
descent in numpy, with calibrated rejection. The average of embeddings followed by a linear map is
the average of per-subword scores, so a trained model is one table of scores per hash bucket;
scoring a text is a gather. Each letter gets the mean score of the subwords that cover it, summed
over a window; runs of one best language are the stretches. Confidences are softmax values at a
temperature fitted on held-out rows; a stretch under the calibrated threshold is not accepted.

Training rows are a bounded sample (``sample_rows``, by hash of the key) of the labelled rows, with
a least number of each label; scoring covers every row and every letter.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import strip
from pagemill.llm.canonical_text import canonical

# Spellings of labels, and labels that say nothing.
LABEL_SPELLING = {"jp": "ja", "ja-jp": "ja", "kr": "ko", "ko-kr": "ko"}
NO_LABEL = ("", "unknown", "und")

_TOP = 0x110000
_LETTER = np.zeros(_TOP, dtype=bool)
_LETTER[[c for c in range(0x323B0) if unicodedata.category(chr(c))[0] == "L"]] = True
_LOWER = np.arange(_TOP, dtype=np.uint32)
for _c in range(0x10000):
    if len(_l := chr(_c).lower()) == 1:
        _LOWER[_c] = ord(_l)

SCRIPT_RANGES = {
    "ja": [(0x3005, 0x3007), (0x3041, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
    "ko": [(0x1100, 0x11FF), (0x3131, 0x318E), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)],
}


def script_table() -> np.ndarray:
    """Code point to 0 (none) or 1 + the index of its language in SCRIPT_RANGES; letters only."""
    t = np.zeros(_TOP, dtype=np.uint8)
    for k, ranges in enumerate(SCRIPT_RANGES.values(), 1):
        for a, b in ranges:
            t[a : b + 1] = k
    return np.where(_LETTER, t, 0).astype(np.uint8)


def clean_label(c: Column) -> Column:
    """A label in lower case and one spelling; null if it says nothing."""
    spelling = F.create_map(*[F.lit(x) for kv in LABEL_SPELLING.items() for x in kv])

    def one(s: Column) -> Column:
        return F.when(~s.isin(*NO_LABEL), F.coalesce(F.element_at(spelling, s), s))

    # a lambda variable, so that the text is stripped once and not at each mention
    return F.get(F.transform(F.array(F.lower(strip(c))), one), F.lit(0))


#: Line feeds around every text: no subword reaches farther, so none reaches into another text.
GAP = 3


def flatten(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all texts, with gaps before, between and after them; the row of each; and
    where each text begins."""
    cps = np.frombuffer(("\n" * GAP + "".join(t + "\n" * GAP for t in texts)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.array([len(t) + GAP for t in texts], dtype=np.int64)
    begin = GAP + np.cumsum(size) - size
    return cps, np.concatenate([np.zeros(GAP, np.int64), np.repeat(np.arange(len(texts)), size)]), begin


def features(cps: np.ndarray, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For every letter the buckets of the subwords that cover it: (letters, features), positions.

    Subwords: the letter, its block of 128 code points (so that unseen letters of a known script
    have evidence), and the n-grams around it, where all that is no letter is one symbol."""
    low = np.where(_LETTER[cps], _LOWER[cps], 32).astype(np.uint64)
    pos = np.nonzero(_LETTER[cps])[0]
    at = lambda k: low[np.clip(pos + k, 0, len(low) - 1)]
    mix = np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - bits)

    def bucket(parts: list[np.ndarray], tag: int) -> np.ndarray:
        h = np.full(len(pos), tag * 0x632BE5AB + 1, dtype=np.uint64)
        for p in parts:
            h = (h ^ p) * mix
            h ^= h >> np.uint64(29)
        return ((h * mix) >> shift).astype(np.int32)

    cols = [bucket([at(0)], 1), bucket([at(0) >> np.uint64(7)], 2)]
    for n in orders:
        for first in {2: (-1, 0), 3: (-1,), 4: (-2, -1), 5: (-2,), 6: (-3,)}[n]:
            cols.append(bucket([at(first + k) for k in range(n)], n))
    return np.stack(cols, axis=1) if len(pos) else np.zeros((0, len(cols)), np.int32), pos


@dataclass
class LangModel:
    labels: list[str]
    orders: tuple[int, ...] = (2, 3)
    bits: int = 16
    window: int = 0
    min_run: int = 1
    temperature: float = 1.0
    threshold: float = 0.0
    accuracy: float = 0.0
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    def letter_scores(self, cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        f, pos = features(cps, self.orders, self.bits)
        out = np.zeros((len(pos), len(self.labels)), dtype=np.float32)
        for j in range(f.shape[1]):
            out += self.table[f[:, j]]
        return out / max(1, f.shape[1]), pos

    def confidence(self, mean_scores: np.ndarray) -> np.ndarray:
        z = mean_scores / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def segments(self, texts: list[str]) -> dict[str, np.ndarray]:
        """All stretches of all texts: row, start and end in code points, label index, confidence,
        letters. A stretch runs from its first letter to the next one's first letter or the end."""
        cps, row_of, begin = flatten(texts)
        scores, pos = self.letter_scores(cps)
        none = {k: np.zeros(0, np.int64) for k in ("row", "start", "end", "label", "letters")} | {"confidence": np.zeros(0, np.float32), "accepted": np.zeros(0, bool)}
        if not len(pos):
            return none
        rows = row_of[pos]
        smooth = scores
        if self.window:
            total = np.vstack([np.zeros((1, scores.shape[1]), np.float64), np.cumsum(scores, axis=0, dtype=np.float64)])
            first, last = np.searchsorted(rows, rows, "left"), np.searchsorted(rows, rows, "right")
            i = np.arange(len(pos))
            smooth = total[np.minimum(i + self.window + 1, last)] - total[np.maximum(i - self.window, first)]
        label = smooth.argmax(axis=1)
        new = np.ones(len(pos), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (label[1:] != label[:-1])
        if self.min_run > 1:  # a run too short to be trusted takes the label of the run before, else after
            starts = np.nonzero(new)[0]
            size = np.diff(np.append(starts, len(pos)))
            run_label, run_row = label[starts], rows[starts]
            for k in np.nonzero(size < self.min_run)[0]:
                if k and run_row[k - 1] == run_row[k]:
                    run_label[k] = run_label[k - 1]
                elif k + 1 < len(starts) and run_row[k + 1] == run_row[k]:
                    run_label[k] = run_label[k + 1]
            label = np.repeat(run_label, size)
            new[1:] = (rows[1:] != rows[:-1]) | (label[1:] != label[:-1])
        starts = np.nonzero(new)[0]
        letters = np.diff(np.append(starts, len(pos)))
        mean = np.add.reduceat(scores, starts, axis=0) / letters[:, None]
        conf = self.confidence(mean)[np.arange(len(starts)), label[starts]]
        row = rows[starts]
        start = pos[starts] - begin[row]
        ends_row = np.append(row[1:] != row[:-1], True)
        length = np.array([len(t) for t in texts], dtype=np.int64)
        end = np.where(ends_row, length[row], np.append(start[1:], 0))
        return {"row": row, "start": start, "end": end, "label": label[starts], "letters": letters, "confidence": conf, "accepted": conf >= self.threshold}


def train(texts: list[str], labels: list[str], orders: tuple[int, ...] = (2, 3), bits: int = 16, dim: int = 12, epochs: int = 3, rate: float = 0.15, batch: int = 128, window: int = 0, min_run: int = 1, reject: float = 0.01, seed: int = 7) -> LangModel:
    """Fit the model on labelled texts; a fifth of them is held out for temperature and threshold.

    The threshold is the ``reject`` quantile of the confidence on held-out texts whose label agrees
    with the model, so about that share of right texts is given up. Without any labelled text the
    only label is ``und``.
    """
    names = sorted(set(labels))
    m = LangModel(names, orders, bits, window, min_run, table=np.zeros((1 << bits, max(1, len(names))), np.float32))
    if not names:
        m.labels = ["und"]
        return m
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    texts = [texts[i] for i in order]
    y = np.array([names.index(labels[i]) for i in order])
    cps, row_of, _ = flatten(texts)
    f, pos = features(cps, orders, bits)
    rows = row_of[pos]
    bound = np.searchsorted(rows, np.arange(len(texts) + 1), "left")
    emb = rng.normal(0, 0.1, (1 << bits, dim)).astype(np.float32)
    out = np.zeros((dim, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    seen, seen_out = np.zeros(1 << bits, np.float32), np.zeros_like(out)  # squared gradients, for steps of even size
    n_train = max(1, len(texts) - len(texts) // 5)
    with_letters = bound[1:] > bound[:-1]
    steps = max(1, epochs * n_train // batch)
    step = 0
    width = f.shape[1]
    weight = np.bincount(y[:n_train], minlength=len(names)).astype(np.float32)
    weight = (weight.sum() / np.maximum(weight, 1) / len(names)) ** 0.5
    for _ in range(epochs):
        ids = rng.permutation(n_train)
        for b in range(0, n_train, batch):
            sel = ids[b : b + batch]
            sel = sel[with_letters[sel]]
            if not len(sel):
                continue
            lr = rate * (1 - step / (steps + 1))
            step += 1
            idx = np.concatenate([f[bound[i] : bound[i + 1]].ravel() for i in sel])
            count = (bound[sel + 1] - bound[sel]) * width
            seg = np.concatenate([[0], np.cumsum(count)[:-1]])
            mean = np.add.reduceat(emb[idx], seg, axis=0) / count[:, None]
            z = mean @ out + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = z / z.sum(axis=1, keepdims=True)
            g[np.arange(len(sel)), y[sel]] -= 1
            g *= weight[y[sel]][:, None] / len(sel)
            g_mean = (g @ out.T) / count[:, None]
            g_out = mean.T @ g
            seen_out += g_out**2
            out -= lr * g_out / np.sqrt(seen_out + 1e-12)
            bias -= lr * g.sum(axis=0)
            # gradient of each embedding: sum over its occurrences, by sorting instead of scattering
            who = np.repeat(np.arange(len(sel)), count)
            by = np.argsort(idx, kind="stable")
            uniq, first = np.unique(idx[by], return_index=True)
            g_emb = np.add.reduceat(g_mean[who[by]], first, axis=0)
            seen[uniq] += (g_emb**2).mean(axis=1)
            emb[uniq] -= lr * g_emb / np.sqrt(seen[uniq] + 1e-16)[:, None]
    known = np.zeros(1 << bits, bool)
    known[f[: bound[n_train]].ravel()] = True
    emb[~known] = 0  # a subword never seen says nothing
    m.table = (emb @ out + bias).astype(np.float32)
    held = [i for i in range(n_train, len(texts)) if with_letters[i]] or [i for i in range(n_train) if with_letters[i]]
    scores, p = m.letter_scores(cps)
    means = np.array([scores[bound[i] : bound[i + 1]].mean(axis=0) for i in held]).reshape(-1, len(names))
    if len(held):
        best = (np.inf, 1.0)
        for t in (0.02, 0.05, 0.1, 0.2, 0.4, 0.7, 1.0, 1.5, 2.5):
            m.temperature = t
            loss = -np.log(np.maximum(1e-9, m.confidence(means)[np.arange(len(held)), y[held]])).mean()
            best = min(best, (loss, t))
        m.temperature = best[1]
        conf = m.confidence(means)
        right = conf.argmax(axis=1) == y[held]
        m.accuracy = float(right.mean())
        m.threshold = float(np.quantile(conf.max(axis=1)[right], reject)) if right.any() else 0.0
    return m


def fit(df: DataFrame, key: str, text: str = "transcript", label: str = "lang", keep: tuple[str, ...] = ("ja", "ko", "latin"), sample_rows: int = 6000, **kw) -> LangModel:
    """Train on ``sample_rows`` rows with one of the labels ``keep``, chosen by hash of the key, and on
    more of a label that has less than a fifth of an even share among them, up to that many."""
    labelled = df.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), clean_label(F.col(label)).alias("l")).where(F.col("t").isNotNull() & F.col("l").isin(*keep))
    sizes = {r["l"]: r["n"] for r in labelled.groupBy("l").agg(F.count("*").alias("n")).collect()}  # one row per label
    least = max(1, sample_rows // (5 * len(keep)))
    share = 2 * sample_rows / max(1, sum(sizes.values()))  # what is sorted and sent to the driver stays bounded
    most = {l: math.ceil(min(1.0, max(share, 2 * least / n)) * 1_000_000) for l, n in sizes.items()}
    bound = F.coalesce(*[F.when(F.col("l") == l, n) for l, n in most.items()], F.lit(0))
    drawn = sorted(labelled.withColumn("h", F.xxhash64("k", F.lit("lang"))).where(F.pmod("h", F.lit(1_000_000)) < bound).collect(), key=lambda r: (r["h"], r["t"]))
    rows, rest = drawn[:sample_rows], drawn[sample_rows:]
    for l in sorted(sizes):
        rows += [r for r in rest if r["l"] == l][: max(0, least - sum(r["l"] == l for r in rows))]
    return train([canonical(r["t"]) for r in rows], [r["l"] for r in rows], **kw)


#: Settings for prose in one of many languages: longer subwords, a window of letters, no short runs.
DOCUMENTS = {"keep": ("en", "fr", "de", "es", "ja", "ko"), "sample_rows": 1500, "orders": (2, 3, 4, 5), "bits": 17, "dim": 8, "epochs": 8, "rate": 0.3, "window": 24, "min_run": 20, "batch": 32}

SEGMENTS = "array<struct<start:int,end:int,lang:string,confidence:double,accepted:boolean,text:string>>"


def identify(df: DataFrame, model: LangModel, key: str, text: str, enough: int = 4) -> DataFrame:
    """(key, lang, confidence, segments): one row per input row that has a key.

    A language is in a text if its stretches hold at least ``enough`` letters or, if none does, if
    it has the most. lang is that language, ``mixed`` for several, ``und`` if the text is null or
    has no letters; the confidence is the mean over letters. Offsets count the code points of the
    canonical form, of which ``text`` is a piece; every stretch is listed, however short.
    """
    b = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = b.value
        for pdf in batches:
            texts = [canonical(t) if t is not None else "" for t in pdf["t"]]
            s = m.segments(texts)
            per: list[list] = [[] for _ in texts]
            for r, a, e, lab, c, ok, n in zip(s["row"].tolist(), s["start"].tolist(), s["end"].tolist(), s["label"].tolist(), s["confidence"].tolist(), s["accepted"].tolist(), s["letters"].tolist()):
                per[r].append((n, {"start": a, "end": e, "lang": m.labels[lab], "confidence": c, "accepted": ok, "text": texts[r][a:e].rstrip()}))
            lang, conf = [], []
            for segs in per:
                held: dict[str, int] = {}
                for n, x in segs:
                    held[x["lang"]] = held.get(x["lang"], 0) + n
                kinds = {k for k, n in held.items() if n >= min(enough, max(held.values()))}
                lang.append("und" if not kinds else kinds.pop() if len(kinds) == 1 else "mixed")
                total = sum(n for n, _ in segs)
                conf.append(sum(n * x["confidence"] for n, x in segs) / total if total else 0.0)
            yield pd.DataFrame({"k": pdf["k"], "lang": lang, "confidence": conf, "segments": [[x for _, x in segs] for segs in per]})

    kind = df.schema[key].dataType.simpleString()
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, lang string, confidence double, segments {SEGMENTS}").withColumnRenamed("k", key)


def languages(df: DataFrame, model: LangModel, key: str, text: str, carry: str) -> DataFrame:
    """(key, carry, lang, accepted, letters, confidence, script_letters, most): the languages of a text.

    A stretch that the model accepts names its language; of a stretch that it rejects, being less
    sure of it than the calibrated threshold, every letter names the language of its own script
    (which is also how a language without any labelled row comes in). ``carry`` is the column of
    that name, as it is, for a later comparison. accepted counts the letters of accepted stretches,
    letters those of all the language has been named by, confidence is their mean for the accepted
    ones; script_letters counts the letters of its script, most is the largest script_letters of the
    text. Vectorised over whole Arrow batches."""
    b = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, scripts, names = b.value, script_table(), list(SCRIPT_RANGES)
        labels = [*m.labels, *[x for x in names if x not in m.labels]]
        to_script = np.array([names.index(x) if x in names else -1 for x in labels])
        of_script = np.array([labels.index(x) for x in names])
        for pdf in batches:
            texts = [canonical(t) if t is not None else "" for t in pdf["t"]]
            s = m.segments(texts)
            n, c = len(texts), len(labels)
            cell, ok = s["row"] * c + s["label"], s["accepted"]
            count = lambda at, w: np.bincount(at, weights=w, minlength=n * c).reshape(n, c)
            accepted = count(cell[ok], s["letters"][ok])
            sure = count(cell[ok], s["letters"][ok] * s["confidence"][ok].astype(float))
            cps, row_of, begin = flatten(texts)
            k = scripts[cps]
            own = np.bincount(row_of[k > 0] * len(names) + k[k > 0] - 1, minlength=n * len(names)).reshape(n, len(names))
            named = accepted.copy()
            if not ok.all():  # letters of rejected stretches, by script
                change = np.zeros(len(cps) + 1, np.int64)
                np.add.at(change, begin[s["row"][~ok]] + s["start"][~ok], 1)
                np.add.at(change, begin[s["row"][~ok]] + s["end"][~ok], -1)
                open_ = (np.cumsum(change)[:-1] > 0) & (k > 0)
                named += count(row_of[open_] * c + of_script[k[open_] - 1], None)
            r, lab = np.nonzero(named)
            at = to_script[lab]
            yield pd.DataFrame({
                "k": pdf["k"].to_numpy()[r], "carry": pdf["carry"].to_numpy()[r], "lang": np.array(labels, dtype=object)[lab], "accepted": accepted[r, lab].astype(np.int64), "letters": named[r, lab].astype(np.int64),
                "confidence": sure[r, lab] / np.maximum(1, accepted[r, lab]), "script_letters": np.where(at >= 0, own[r, at], 0), "most": own.max(axis=1)[r],
            })

    kind = df.schema[key].dataType.simpleString()
    schema = f"k {kind}, carry string, lang string, accepted long, letters long, confidence double, script_letters long, most long"
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(carry).alias("carry"), F.col(text).alias("t")).mapInPandas(run, schema).withColumnRenamed("k", key)


def wrong_labels(df: DataFrame, model: LangModel, key: str = "ord", text: str = "transcript", label: str = "lang", enough: int = 4) -> DataFrame:
    """(key, lang): the languages of each text whose label is missing or not the right one.

    The stretches of a text name its languages (see ``languages``); the exact check after it keeps
    one with at least ``enough`` letters of its script or, if none has, the one with most (all of
    them at a tie): what a language is in a text for is defined by a count of letters. The right
    label is that language, or ``mixed`` for several. Texts that are null or without letters give
    no rows. The key must be unique; it is the only thing that is grouped by.
    """
    found = languages(df, model, key, text, label)
    kept = found.where((F.col("script_letters") > 0) & ((F.col("script_letters") >= enough) | ((F.col("most") < enough) & (F.col("script_letters") == F.col("most")))))
    per = kept.groupBy(key).agg(F.first("carry").alias("label"), F.collect_set("lang").alias("langs"))  # at most one entry per label
    right = F.when(F.size("langs") > 1, "mixed").otherwise(F.get("langs", F.lit(0)))
    said = clean_label(F.col("label"))
    return per.where(said.isNull() | (said != right)).select(F.col(key), F.explode("langs").alias("lang"))


def decisions(df: DataFrame, model: LangModel, key: str = "ord", text: str = "transcript", label: str = "lang") -> DataFrame:
    """Per language: texts in which accepted stretches name it, those in which only letters of rejected
    ones do, and the mean confidence of the former."""
    sure = F.col("accepted") > 0
    return languages(df, model, key, text, label).groupBy("lang").agg(F.count_if(sure).alias("accepted_texts"), F.count_if(~sure).alias("rejected_texts"), F.avg(F.when(sure, F.col("confidence"))).alias("confidence"))


def report(model: LangModel) -> str:
    return f"labels {model.labels}, held-out agreement {model.accuracy:.4f}, temperature {model.temperature}, threshold {model.threshold:.3f}, table {sys.getsizeof(model.table)} bytes"
