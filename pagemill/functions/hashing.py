"""Deterministic hash scores and the series split built on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = 18446744073709551616.0


def unit_score(salt: str, c: Column) -> Column:
    """The first 8 bytes of sha256(``salt:value``) on a scale of 0 to 1."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), c), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(_SCALE)


@dataclass(frozen=True)
class SplitRule:
    """Ratios and salt of a series split; the ratios must sum to 1 at six decimals."""

    train: float = 0.8
    val: float = 0.1
    test: float = 0.1
    salt: str = "series-split-v1"

    def __post_init__(self) -> None:
        if round(self.train + self.val + self.test, 6) != 1.0:
            raise ValueError("split ratios must sum to 1.0")

    def assign(self, series: Column) -> Column:
        s = unit_score(self.salt, series)
        return F.when(s < self.train, "train").when(s < self.train + self.val, "val").when(s.isNotNull(), "test")
