"""What the operators of this package share: words, staging in the shared folder, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words are runs without the ASCII blanks that bytes.split() splits at: 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Text handled at once within a batch, in characters; it bounds the working memory of a task.
SLICE_CHARS = 4_000_000
# Words a worker remembers before it forgets them all; it bounds memory and changes no result.
MEMORY_WORDS = 300_000
# Bits of a filter of hashed keys, and of a row of it, which bitmap_construct_agg fixes.
KEY_BITS, KEY_ROW = 1 << 25, 1 << 15

_own_folder: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where none is set, one of our own on a local master.

    Executors elsewhere could not read such a folder, so on a cluster an unset one is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="andesite-llm-"))
    return _own_folder[0]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once into the shared folder and read it from there.

    This cuts the lineage: a lost executor costs a read, not the work behind the frame.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _key_place(key: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(KEY_BITS))


def key_filter(keys: DataFrame) -> DataFrame:
    """(row, bits): a bit for each row of ``keys``, at its hash; at most 4 MB, whatever the number of keys."""
    place = keys.select(_key_place([F.col(c) for c in keys.columns]).alias("place"))
    return stage(place.groupBy(F.expr(f"place div {KEY_ROW}").alias("row")).agg(
        F.bitmap_construct_agg(F.col("place") % KEY_ROW).alias("bits")), "filter")


def split_by_filter(rows: DataFrame, key: list[Column], bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be in the filter, a few others among them, and those whose key is not.

    No row is shuffled: the filter is broadcast.  ``key`` has the types of the keys that made it.
    """
    place = _key_place(key)
    within = F.pmod(place, F.lit(KEY_ROW)).cast("int")
    byte = F.substring(bits["bits"], F.floor(within / 8).cast("int") + 1, F.lit(1))
    bit = F.pmod(F.floor(F.conv(F.hex(byte), 16, 10).cast("int") / F.pow(F.lit(2), within % 8)), F.lit(2))
    found = F.coalesce(bit == 1, F.lit(False))
    joined = rows.join(F.broadcast(bits), F.floor(place / KEY_ROW) == bits["row"], "left")
    own = [rows[f"`{c}`"] for c in rows.columns]
    return joined.filter(found).select(*own), joined.filter(~found).select(*own)


def slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of at least one text each that hold about ``limit`` characters at most."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text as UTF-8; ``lower`` turns A-Z into a-z and leaves the rest."""
    raw = text.encode("utf-8", "replace") if text else b""
    return (raw.translate(LOWER_ASCII) if lower else raw).split()


class WordHashes(dict):
    """64-bit hash of a word, computed once while the word is remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words; with fewer words, one for the whole sequence."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    h = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        h = h * ODD + words[j : n - size + 1 + j]
    return mix(h)
