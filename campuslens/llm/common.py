"""Helpers shared by the training-data operators: stage tables, Arrow buffers, byte tables."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslens.session import scratch_dir

#: Text bytes that one numpy pass works on, whatever the size of an Arrow batch.
PIECE_BYTES = 1 << 20
#: Blank bytes of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = r"\x20\x09-\x0D"


class Stage:
    """A frame written once to the shared folder; ``frame`` reads it, ``drop`` removes it."""

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = f"{scratch_dir(self.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.frame = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """For stages that no returned frame reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of finished steps: it does so when the driver has
    collected the plans that refer to them, which a driver with much free memory puts off."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stage(df: DataFrame, label: str) -> DataFrame:
    return Stage(df, label).frame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, stem: str) -> str:
    """Column name that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def packed(df: DataFrame) -> DataFrame:
    """Whole rows in one column ``row`` beside ``text``, so that no column name of an input can
    clash with what an operator adds; ``select("row.*")`` restores them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.col("text").cast("string").alias("text"))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and len + 1 offsets into them; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, one row at least."""
    offsets = text_buffers(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class RollingHash:
    """Hashes of byte or word spans from prefix sums modulo 2**64: the span's sum of
    value * base**position, shifted back to position zero by the inverse power."""

    BASE = 0x5851F42D4C957F2D
    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._powers) < n:
            size = 1 << (n - 1).bit_length()
            inverse = pow(cls.BASE, -1, 1 << 64)
            made = []
            for base in (cls.BASE, inverse):
                step = np.full(size, base, np.uint64)
                step[0] = 1
                made.append(np.multiply.accumulate(step))
            cls._powers, cls._inverse = made
        return cls._powers[:n], cls._inverse[:n]

    def __init__(self, values: np.ndarray):
        up, self.down = self.powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def windows(self, width: int) -> np.ndarray:
        """``spans`` of all stretches of ``width`` values, in order."""
        n = max(0, len(self.sums) - width)
        return mix64((self.sums[width:] - self.sums[:n]) * self.down[:n])


#: One random-looking 64-bit value per byte.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def sliding(values: np.ndarray, width: int, combine) -> np.ndarray:
    """combine over values[i : i + width] for each i that has a whole window."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = combine(out[:len(out) - step], out[step:])
        have += step
    return out


def window_minima(hashes: np.ndarray, width: int, whole: np.ndarray) -> np.ndarray:
    """Winnowing marks: position p is kept when it holds the minimum of at least one window
    hashes[i : i + width] with whole[i]; equal minima are all kept. ``hashes`` are above 0."""
    if len(hashes) < width:
        return np.zeros(len(hashes), bool)
    low = sliding(hashes, width, np.minimum)
    low = np.where(whole[:len(low)], low, np.uint64(0))
    pad = np.zeros(width - 1, np.uint64)
    best = sliding(np.concatenate([pad, low, pad]), width, np.maximum)
    return best == hashes


def row_hashes(df: DataFrame, columns: list[str]) -> list:
    """Two independent 64-bit hashes of a row's values, null included."""
    return [F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]) for seed in (11, 12)]
