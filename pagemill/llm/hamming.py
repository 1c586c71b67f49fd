"""64-bit perceptual codes and an exact prefix-filter join on their Hamming distance.

A code is cut into ``b = ell + radius + 1`` blocks; each (block, value) is a shingle. Codes that
differ in at most ``radius`` bits share at least ``t = ell + 1`` of the ``b`` shingles. With one
global order of the shingles, rarest first, sets that share ``t`` of ``b`` shingles share at least
``ell`` of them within their first ``b - t + ell = ell + radius`` shingles. So the join key is
every ``ell``-subset of that prefix: exact, and the most frequent shingles never become keys.

A shingle holds its block, so equal shingles stand at the same place of the code; and a key ends one
shingle before the end of the order at the latest, so what is left of both codes always suffices for
the one shingle more that ``t`` asks for: the position filter is part of the keys. The length filter
on the numbers of set bits is a condition of the join.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
#: What a key row costs, in candidates checked.
KEY_COST = 8


def code64(phash: Column) -> Column:
    """Hex text of 16 digits, any case, as a signed BIGINT; anything else is null."""
    h = F.lower(F.trim(phash))
    return F.when(h.rlike("^[0-9a-f]{16}$"), F.conv(h, 16, -10).cast("bigint"))


def informative(phash: Column) -> Column:
    """The code if its bits are not all equal, else null."""
    c = code64(phash)
    return F.when((c != 0) & (c != -1), c)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def widths(blocks: int) -> list[int]:
    return [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]


def _blocks(code: Column, blocks: int) -> list[Column]:
    out, at = [], 0
    for w in widths(blocks):
        out.append(F.shiftrightunsigned(code, at).bitwiseAND(F.lit((1 << w) - 1)).cast("int"))
        at += w
    return out


def choose_ell(n_index: int, radius: int) -> int:
    """The length of the keys for which key rows and candidates of a probe together cost least. It
    moves work between the two; the result is the same for every ``ell``."""

    def cost(ell: int) -> float:
        blocks, keys = ell + radius + 1, comb(ell + radius, ell)
        return KEY_COST * keys + n_index * keys / 2 ** (BITS * ell / blocks)

    return min(range(1, 13), key=cost)


def shingle_order(index: DataFrame, code: str, blocks: int) -> tuple[list[int], int]:
    """The rank of each (block, value), rarest in the index first, and the offset of each block is
    implied by the widths. At most ``sum(2**w)`` entries whatever the data: under 3,000."""
    offs, at = [], 0
    for w in widths(blocks):
        offs.append(at)
        at += 1 << w
    ids = F.explode(F.array(*[b + F.lit(o) for b, o in zip(_blocks(F.col(code), blocks), offs)]))
    counts = {r["s"]: r["n"] for r in index.select(ids.alias("s")).groupBy("s").agg(F.count("*").alias("n")).collect()}
    rank = [0] * at
    for r, s in enumerate(sorted(range(at), key=lambda s: (counts.get(s, 0), s))):
        rank[s] = r
    return rank, at


def prefix_keys(code: Column, rank: list[int], ell: int, radius: int) -> Column:
    """ARRAY<BIGINT>: the keys of a code, one per ell-subset of its rarest shingles."""
    blocks, p = ell + radius + 1, ell + radius
    ranks = F.lit(rank)
    ids, at = [], 0
    for w, b in zip(widths(blocks), _blocks(code, blocks)):
        ids.append(F.get(ranks, b + F.lit(at)))
        at += 1 << w
    sorted_ids = F.array_sort(F.array(*ids))

    def key(t: Column) -> Column:
        keys = []
        for c in combinations(range(p), ell):
            k = F.lit(0).cast("bigint")
            for i in c:
                k = k * at + F.get(t, F.lit(i)).cast("bigint")
            keys.append(k)
        return F.array(*keys)

    # one element only: binds the sorted array to a lambda variable, so it is computed once
    return F.get(F.transform(F.array(sorted_ids), key), F.lit(0))


def hamming_pairs(index: DataFrame, probe: DataFrame | None = None, radius: int = 6, code: str = "code") -> DataFrame:
    """All pairs of codes at most ``radius`` bits apart, as (code_a, code_b), each once.

    ``index`` and ``probe`` hold one column of distinct non-null codes. With both, code_a is from
    the index and code_b from the probe, equal codes included. With the index alone it is a
    self-join with code_a < code_b. Empty inputs give no rows.
    """
    n = index.count()
    ell = choose_ell(n, radius)
    rank, _ = shingle_order(index, code, ell + radius + 1)

    def keyed(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(code).alias(name), F.explode(prefix_keys(F.col(code), rank, ell, radius)).alias("key"))

    a, b = keyed(index, "code_a"), keyed(index if probe is None else probe, "code_b")
    # length filter: the numbers of set bits differ by at most the radius; then exact verification
    near = (F.abs(F.bit_count("code_a") - F.bit_count("code_b")) <= radius) & (distance(F.col("code_a"), F.col("code_b")) <= radius)
    if probe is None:
        near = near & (F.col("code_a") < F.col("code_b"))
    # merge: the planner judges the exploded keys by the codes they come from, 28 times too small
    return a.join(b.hint("merge"), "key").where(near).select("code_a", "code_b").distinct()
