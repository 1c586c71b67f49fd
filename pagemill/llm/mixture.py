"""Problem 8: one mixture of sources whose token totals follow target weights.

Method: Sainte-Laguë apportionment. The mixture is a number of equal-token blocks; each block goes
to the source with the highest quotient share / (2k + 1), then to a shard of the source in the
same way by its tokens. A block is so small that every source and every shard is worth
``LEAST_BLOCKS`` of them at least (or one token), whatever the size of the data. A shard is a
seeded random order of its documents, laid on a circle of its tokens; its quota of blocks covers
the circle from a seeded block on, as often round as the quota is long, the last block only as far
as the cap of repeats goes. So a source misses its target by about a document a shard, and no
document passes its cap.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pagemill.session import cut_lineage

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the split pattern that belongs to the public rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str, tokenizer: str = TOKENIZER):
    """A column: tokens of a text column under a rank file; 0 for null and empty texts."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(tokenizer)
        for texts in batches:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in texts], index=texts.index, dtype="int64")

    # nondeterministic in name only: else a filter on the count would encode every text twice
    return F.pandas_udf(count, LongType()).asNondeterministic()(F.col(text))


#: Blocks that each source and each shard is worth at least.
LEAST_BLOCKS = 400


def sainte_lague(weights: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats by highest quotients weight / (2k + 1), none above its cap; ties go to the earlier one.
    Seats that no cap leaves room for are not given.

    All quotients above a divisor are found at once, by bisection; only the last seats, fewer than
    there are weights, are given one by one. So the work does not grow with the seats."""
    w, most = np.asarray(weights, float), np.asarray(caps, np.int64)
    most = np.where(w > 0, np.maximum(most, 0), 0)
    if not len(w) or seats >= int(most.sum()):
        return most.tolist()

    def above(quotient: float) -> np.ndarray:
        """Seats whose quotient is greater: those k with 2k + 1 < weight / quotient."""
        return np.minimum(most, np.maximum(0, np.ceil((w / quotient - 1) / 2))).astype(np.int64)

    low, high = 0.0, float(w.max()) * 2  # above(high) has no seat, above(low) too many
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if int(above(middle).sum()) > seats:
            low = middle
        else:
            high = middle
    got = above(high)
    heap = [(-w[i] / (2 * int(got[i]) + 1), i) for i in range(len(w)) if got[i] < most[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-w[i] / (2 * int(got[i]) + 1), i))
    return got.tolist()


def mixture(docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", total_tokens: int | None = None, blocks: int = 10_000, shard_docs: int = 250_000, seed: int = 42, tokenizer: str = TOKENIZER) -> DataFrame:
    """(key, source, tokens, uses): the documents of the mixture and how often each is used.

    Shares are taken among the sources that have both a target and documents with tokens. Without
    ``total_tokens`` the mixture is the largest in which every such source can reach its share
    under its cap; with more than that, capped sources stay short and the others fill up.
    ``blocks`` is the least number of blocks. Documents of null source, without tokens or of a
    source without a target are not used. A null or negative share or cap counts as 0; of a source
    listed twice the first by share counts. The table of targets, a setting, is read by the driver.
    """
    return _mix(_counted(docs, key, text, tokenizer), targets, key, total_tokens, blocks, shard_docs, seed)


def _counted(docs: DataFrame, key: str, text: str, tokenizer: str) -> DataFrame:
    return cut_lineage(docs.where("source is not null").select(key, "source", token_count(text, tokenizer).alias("tokens")).where("tokens > 0"), "p8-tokens")


def _mix(counted: DataFrame, targets: DataFrame, key: str, total_tokens: int | None, blocks: int, shard_docs: int, seed: int) -> DataFrame:
    spark = counted.sparkSession
    goal: dict[str, tuple[float, int]] = {}
    for r in targets.select("source", "target_share", "max_repeats").collect():
        goal[r[0]] = max(goal.get(r[0], (0.0, 0)), (max(0.0, r[1] or 0.0), max(0, r[2] or 0)))
    wanted = spark.createDataFrame([(s,) for s, (w, n) in sorted(goal.items(), key=str) if s is not None and w > 0 and n > 0], "source string")
    counted = counted.join(wanted, "source")
    have = {r["source"]: r for r in counted.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")).collect()}  # a row per target at most
    names = sorted(have)
    n_shards = spark.createDataFrame([(s, max(1, -(-have[s]["docs"] // shard_docs))) for s in names], "source string, shards int")
    rows = counted.join(n_shards, "source").select(key, "source", "tokens", F.xxhash64(F.col(key), F.lit(seed)).alias("order"), F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.col("shards")).cast("int").alias("shard"))
    plan: list[tuple] = []
    if names:
        share = {s: goal[s][0] for s in names}
        scale = sum(share.values())
        share = {s: w / scale for s, w in share.items()}
        capacity = {s: have[s]["tokens"] * goal[s][1] for s in names}
        total = total_tokens or min(capacity[s] / share[s] for s in names)
        shards: dict[str, list] = {s: [] for s in names}
        for r in rows.groupBy("source", "shard").agg(F.sum("tokens").alias("n")).collect():  # a row per shard_docs documents
            shards[r["source"]].append((r["shard"], r["n"]))
        # the least that a source or a shard contributes, in tokens
        part = min(share[s] * total * min(n for _, n in shards[s]) / have[s]["tokens"] for s in names)
        block = max(1, int(min(total / blocks, part / LEAST_BLOCKS)))
        seats = sainte_lague([share[s] for s in names], round(total / block), [-(-capacity[s] // block) for s in names])
        for s, q in zip(names, seats):
            own = sorted(shards[s])
            repeats = goal[s][1]
            for (k, n), got in zip(own, sainte_lague([n for _, n in own], q, [-(-n * repeats // block) for _, n in own])):
                first = (seed * 7919 + k * 104729) % -(-n // block) * block
                plan.append((s, k, n, min(got * block, n * repeats), first))
    quotas = spark.createDataFrame(plan, "source string, shard int, shard_tokens long, quota long, first long")
    w = Window.partitionBy("source", "shard").orderBy("order", key).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("tokens").over(w), F.lit(0))).join(quotas, ["source", "shard"])
    # the quota covers the circle of tokens from its first one on; a document counts by its own first token
    turn = F.pmod(F.col("before") - F.col("first"), F.col("shard_tokens"))
    uses = F.expr("quota div shard_tokens") + F.when(turn < F.col("quota") % F.col("shard_tokens"), 1).otherwise(0)
    return placed.select(key, "source", "tokens", uses.cast("int").alias("uses")).where("uses > 0")


def mixture_shares(docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """Per source of either table: the target, tokens available, used, the share reached, most uses."""
    counted = _counted(docs, key, text, kw.pop("tokenizer", TOKENIZER))
    args = {"total_tokens": None, "blocks": 10_000, "shard_docs": 250_000, "seed": 42} | kw
    used = _mix(counted, targets, key, **args).groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("used_tokens"), F.max("uses").alias("most_uses"), F.count("*").alias("used_docs"))
    all_ = counted.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    per = targets.select("source", "target_share", "max_repeats").join(all_, "source", "full").join(used, "source", "left")
    total = F.sum("used_tokens").over(Window.partitionBy())  # over one row per source
    return per.select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), "max_repeats", zero("docs"), zero("tokens"), zero("used_docs"), zero("used_tokens"), zero("most_uses"), F.coalesce(F.try_divide(F.col("used_tokens"), total), F.lit(0.0)).alias("share"))


def kept_targets(docs: DataFrame, targets: DataFrame, tolerance: float = 0.005, **kw) -> DataFrame:
    """Per source that can be mixed: whether its share is within ``tolerance`` of its target (the
    targets of these sources scaled to one), and whether no document passes its cap."""
    per = mixture_shares(docs, targets, **kw).where("docs > 0 and target_share > 0 and max_repeats > 0")
    goal = F.col("target_share") / F.sum("target_share").over(Window.partitionBy())  # over one row per source
    return per.select("source", (F.abs(F.col("share") - goal) <= tolerance).alias("share_kept"), (F.col("most_uses") <= F.col("max_repeats")).alias("cap_kept"))
