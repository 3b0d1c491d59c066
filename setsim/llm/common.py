"""Shared helpers of the operators: written intermediates and text batches."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setsim.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
SLICE_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches between Spark and Python at 4 MiB, whatever the
    length of the texts, unless the session asks for less."""
    now = spark.conf.get(_BATCH, None)
    if now is None or not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def write_step(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    The written table cuts the lineage, so a lost executor costs a re-read and
    not the whole plan; the shuffle files of the finished step are dropped.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._setsim_path = path
    return out


def drop_step(*steps: DataFrame) -> None:
    """Delete written steps that no later plan reads."""
    for df in steps:
        path = getattr(df, "_setsim_path", None)
        if path is None:
            continue
        spark = df.sparkSession
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows kept out of every fit: crc32 of the id as text leaves 2 mod 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def row_slices(batches: Iterator[pa.RecordBatch], text_col: str,
               max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut Arrow batches into slices of at most ``max_bytes`` of text (one row
    at least), each with its texts as UTF-8 bytes or None."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text_col))
        raw = col.cast(pa.large_binary()) if not pa.types.is_binary(col.type) else col
        start = size = 0
        for i in range(len(raw)):
            n = len(raw[i].as_buffer()) if raw[i].is_valid else 0
            if i > start and size + n > max_bytes:
                yield batch.slice(start, i - start), raw.slice(start, i - start).to_pylist()
                start, size = i, 0
            size += n
        if len(raw) > start:
            yield batch.slice(start), raw.slice(start).to_pylist()


#: White space bytes to a space; FOLD also takes A-Z to a-z.
GAPS = bytes(32 if 9 <= c <= 13 else c for c in range(256))
FOLD = bytes(c + 32 if 65 <= c <= 90 else g for c, g in enumerate(GAPS))
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd multipliers for sequence hashes, one stream for each salt.
def multipliers(n: int, salt: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(struct.pack("<qq", salt, i)) | 1 for i in range(n)], np.uint64)


def _byte_values() -> np.ndarray:
    values = multipliers(256, 20)
    values[32] = 0
    return values


class WordHasher:
    """64-bit hashes of the words of texts, in numpy: the sum over a word's bytes
    of a random value for the byte times a power for its place."""

    def __init__(self, table: bytes):
        self.table, self.values = table, _byte_values()
        self.powers = self._powers(1 << 10)

    @staticmethod
    def _powers(n: int) -> np.ndarray:
        return np.cumprod(np.full(n, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and the number of words of each text."""
        buf = np.frombuffer((b" ".join(t or b"" for t in texts) + b" ").translate(self.table), np.uint8)
        sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
        solid = buf != 32
        edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        if len(solid) and solid[0]:
            edge = np.concatenate([[0], edge])
        starts, ends = edge[::2], edge[1::2]
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):  # chunks of whole words
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + _CHUNK, "right")))
            low, high = starts[i], ends[j - 1]
            s = starts[i:j] - low
            place = np.arange(high - low) - np.repeat(s, np.diff(s, append=high - low))
            if (most := int(place.max())) >= len(self.powers):
                self.powers = self._powers(2 * most)
            out[i:j] = np.add.reduceat(self.values[buf[low:high]] * self.powers[place], s)
            i = j
        counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
        return mix(out + (ends - starts).astype(np.uint64)), counts


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return x.view(np.int64)
