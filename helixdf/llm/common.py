"""Shared helpers of the text operators."""

from __future__ import annotations

import uuid
from contextlib import nullcontext

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir, shuffles_dropped

#: Java regular expression of the six white space characters that separate words.
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Byte tables: A-Z to lower case, and the six separators.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


#: Bytes of rows that go to a Python worker at once, unless the session says otherwise.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_UNSET = "67108863b"  # what asking for it gives where nobody has set it


def bound_batches(spark: SparkSession) -> None:
    """Texts differ in length, so batches are bounded by bytes: buffers outside the heap and
    copies in workers stay small. A size that the session sets is kept."""
    if spark.conf.get(_BATCH, _UNSET) == _UNSET:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str = "step", drop: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and a
    lost executor costs no more than reading it again. With ``drop`` its shuffle files go
    as soon as it is written."""
    spark = df.sparkSession
    bound_batches(spark)
    path = shared_path(spark, name)
    with shuffles_dropped(spark) if drop else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: 64-bit words of a sieve: 2 MB of bits, whatever the number of keys.
SIEVE = 1 << 18


def sieve(keys: DataFrame, key: Column) -> DataFrame:
    """A bit for each key's hash, in at most ``SIEVE`` rows. More keys only let more rows through."""
    at = F.xxhash64(key)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    return keys.select(_word(at).alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))


def _word(at: Column) -> Column:
    return F.pmod(F.shiftright(at, 6), F.lit(SIEVE).cast("long"))


def sifted(rows: DataFrame, key: Column, bits: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key may be one of a sieve's, which are all that are; with ``left_anti`` the others,
    none of which is. Rows stay where they are: only the sieve is sent."""
    at = F.xxhash64(key)
    bit = F.call_function("shiftright", F.col("__bits"), at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
    return rows.join(F.broadcast(bits), (_word(at) == F.col("__word")) & (bit == 1), how)


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` and more fields."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def ascii_lower(c: Column) -> Column:
    """A-Z to lower case; every other character stays."""
    return F.translate(c, UPPER, UPPER.lower())


def words(c: Column) -> Column:
    """Words between the six separators; null text has none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE), "")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: One fixed pseudo-random 64-bit value per byte.
_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x2545F4914F6CDD1D)


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    p = np.full(max(n, 1), base, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte and end byte of each word of already lower-cased bytes."""
    b = np.frombuffer(data, dtype=np.uint8)
    empty = np.zeros(0, dtype=np.int64)
    if not len(b):
        return np.zeros(0, dtype=np.uint64), empty, empty
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = ~IS_SPACE[b]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), empty, empty
    # sum of byte code * base^(index from the word's start): prefix sums of the
    # whole text, divided by the power at the word's start (base is odd, so it
    # has an inverse modulo 2^64)
    acc = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[b] * _pow(len(b)), out=acc[1:])
    h = (acc[ends] - acc[starts]) * _inv_pow(len(b))[starts]
    return mix64(h + (ends - starts).astype(np.uint64)), starts, ends


_POW = powers(1 << 12)
_INV = powers(1 << 12, np.uint64(pow(int(_BASE), -1, 1 << 64)))


def _pow(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n:
        _POW = powers(2 * n)
    return _POW[:n]


def _inv_pow(n: int) -> np.ndarray:
    global _INV
    if len(_INV) < n:
        _INV = powers(2 * n, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    return _INV[:n]


def as_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
