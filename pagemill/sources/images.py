"""Image bytes: format, size, hashes, and a content-addressed store."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File signatures.
PNG = "89504E470D0A1A0A"
JPEG = "FFD8"
RIFF = "52494646"
WEBP = "57454250"
GIF = ("474946383761", "474946383961")


def _hex(data: Column, start: int, count: int) -> Column:
    return F.hex(F.substring(data, start + 1, count))


def _number(data: Column, start: int, count: int, little: bool = False) -> Column:
    if not little:
        return F.conv(_hex(data, start, count), 16, 10).cast("bigint")
    return sum((F.conv(_hex(data, start + i, 1), 16, 10).cast("bigint") * 256**i for i in range(count)), F.lit(0).cast("bigint"))


def extension(data: Column, fallback: str = "bin") -> Column:
    """png, jpg, webp or gif by signature, else the fallback."""
    head = _hex(data, 0, 12)
    webp = head.startswith(RIFF) & head.endswith(WEBP)
    return F.when(head.startswith(PNG), "png").when(head.startswith(JPEG), "jpg").when(webp, "webp").when(head.startswith(GIF[0]) | head.startswith(GIF[1]), "gif").otherwise(fallback)


def png_size(data: Column) -> tuple[Column, Column]:
    """Width and height from the header of a PNG; null for anything else."""
    ok = _hex(data, 0, 8).eqNullSafe(PNG) & (F.octet_length(data) >= 24)
    return F.when(ok, _number(data, 16, 4)), F.when(ok, _number(data, 20, 4))


def webp_size(data: Column) -> tuple[Column, Column]:
    """Width and height from the three kinds of WEBP header; null for anything else."""
    ok = _hex(data, 0, 4).eqNullSafe(RIFF) & _hex(data, 8, 4).eqNullSafe(WEBP) & (F.octet_length(data) >= 30)
    kind = _hex(data, 12, 4)
    low = lambda s, n: _number(data, s, n, little=True)
    bits = low(21, 4)
    width = F.when(kind == "56503858", low(24, 3) + 1).when(kind == "5650384C", bits % 16384 + 1).when(kind == "56503820", low(26, 2) % 16384)
    height = F.when(kind == "56503858", low(27, 3) + 1).when(kind == "5650384C", F.floor(bits / 16384) % 16384 + 1).when(kind == "56503820", low(28, 2) % 16384)
    return F.when(ok, width), F.when(ok, height)


#: Start-of-frame markers, the ones that carry the size of a JPEG.
_FRAMES = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}


def jpeg_dimensions(data: bytes) -> tuple[int | None, int | None]:
    """The size in the first frame header, found by walking the segments."""
    i, n = 2, len(data)
    while i < n:
        if data[i] != 0xFF:
            i += 1
            continue
        while i < n and data[i] == 0xFF:
            i += 1
        if i >= n:
            break
        marker, i = data[i], i + 1
        if marker in (0xD8, 0xD9):
            continue
        if i + 2 > n:
            break
        length = int.from_bytes(data[i : i + 2], "big")
        if marker in _FRAMES:
            if i + 7 > n:
                break
            return int.from_bytes(data[i + 5 : i + 7], "big"), int.from_bytes(data[i + 3 : i + 5], "big")
        i += max(2, length)
    return None, None


def _jpeg(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for data in batches:
        yield pd.DataFrame([jpeg_dimensions(bytes(d)) if d is not None else (None, None) for d in data], columns=["width", "height"]).astype("Int64")


def perceptual_hash(grey: Column) -> Column:
    """The 64-bit difference hash of 72 grey values (8 rows of 9), as 16 hex digits; null for any
    other number of values."""
    bit = lambda i: F.when(F.get(grey, (F.floor(i / 8) * 9 + i % 8).cast("int")) > F.get(grey, (F.floor(i / 8) * 9 + i % 8 + 1).cast("int")), "1").otherwise("0")
    bits = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), "")
    return F.when(F.size(grey) == 72, F.lower(F.lpad(F.conv(bits, 2, 16), 16, "0")))


def _grey(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """72 grey values per image; null where the optional decoder is missing or fails."""
    try:
        import io

        from PIL import Image
    except ImportError:
        Image = None  # noqa: N806
    for data in batches:
        out = []
        for d in data:
            try:
                out.append(list(Image.open(io.BytesIO(bytes(d))).convert("L").resize((9, 8)).getdata()) if Image and d is not None else None)
            except Exception:  # noqa: BLE001 - an unreadable image has no hash
                out.append(None)
        yield pd.Series(out, index=data.index)


def fingerprint(images: DataFrame, data: str = "content") -> DataFrame:
    """Each image with sha256, extension, width, height and phash. Only JPEG bytes go to Python for
    their size; hashing and the other formats are native."""
    d = F.col(data)
    jpeg = F.pandas_udf(_jpeg, "width long, height long")
    grey = F.pandas_udf(_grey, "array<int>")
    ext = images.withColumn("extension", extension(d))
    is_jpeg = F.col("extension") == "jpg"
    sized = ext.withColumn("j", jpeg(F.when(is_jpeg, d))).withColumn("grey", grey(d))
    return sized.select(
        *[c for c in images.columns], F.sha2(d, 256).alias("sha256"), "extension",
        F.coalesce(png_size(d)[0], webp_size(d)[0], F.col("j.width")).alias("width"), F.coalesce(png_size(d)[1], webp_size(d)[1], F.col("j.height")).alias("height"), perceptual_hash(F.col("grey")).alias("phash"),
    )


def read_images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def store_path(sha: Column, ext: Column) -> Column:
    """Where the content-addressed store keeps an image."""
    return F.concat(F.lit("raw/"), F.substring(sha, 1, 2), F.lit("/"), sha, F.lit("."), ext)


def store(images: DataFrame, root: str, data: str = "content") -> None:
    """Write each distinct image once under its hash, unless it is there. ``root`` is a folder that
    all executors share; files appear whole, by renaming."""
    rows = images.select(store_path(F.col("sha256"), F.col("extension")).alias("to"), data).dropDuplicates(["to"])

    def write(part: Iterator) -> None:
        import os
        from pathlib import Path

        for r in part:
            to = Path(root, r["to"])
            if not to.exists():
                to.parent.mkdir(parents=True, exist_ok=True)
                tmp = to.with_name(f".{to.name}.{os.getpid()}")
                tmp.write_bytes(bytes(r[data]))
                tmp.rename(to)

    rows.foreachPartition(write)
