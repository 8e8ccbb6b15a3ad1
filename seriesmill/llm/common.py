"""Helpers shared by the corpus operators: tables, storage, Arrow batches, hashes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmill.sources.shared import new_shared_path

#: Bytes of text that one step of a task holds at once.
PIECE_BYTES = (2 << 20) - 16
#: Bits of a table that tells which rows or terms are asked for, and the ranges it travels in.
MARKS = 1 << 27
_BIT_RANGES = 1 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs only the reading of files all can see.
    """
    path = new_shared_path(df.sparkSession, "written")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that one operator writes, reads and removes again.

    What a table was made from is let go at once: Spark removes shuffle files of plans that
    nobody holds any more, but looks for them only when the driver collects garbage.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def written(self, df: DataFrame) -> DataFrame:
        path = new_shared_path(self._spark, "scratch")
        df.write.parquet(path)
        self._paths.append(path)
        self.release()
        return self._spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        gc.collect()
        self._spark._jvm.java.lang.System.gc()

    def drop(self) -> None:
        """Only when all that was made from the tables is stored elsewhere."""
        for path in self._paths:
            at = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(at, True)
        self._paths.clear()
        self.release()


#: Bytes of an Arrow batch sent to a Python worker: the JVM and the worker hold it at once, the JVM in memory beside its heap.
BATCH_BYTES = 4 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def lean_batches(spark: SparkSession) -> None:
    """From now on plans of the session send rows to Python in batches of ``BATCH_BYTES`` at most, unless it has a limit of its own."""
    if spark.conf.get(_BATCHES, None) is None:
        spark.conf.set(_BATCHES, BATCH_BYTES)


def free_memory() -> None:
    """Gives memory that is free back to the system: a worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # the C library may not have it
        ctypes.CDLL(None).malloc_trim(0)


def labelled(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """All training rows: one label per id (the largest), fold 0 of 5 held out."""
    rows = labels.select(doc_id, F.col(label).cast("int").alias(label)).dropna()
    return rows.filter(crc_bucket(doc_id) != 0).groupBy(doc_id).agg(F.max(label).alias(label))


def labelled_sample(labels: DataFrame, label: str, most: int, doc_id: str = "doc_id") -> DataFrame:
    """At most ``most`` of the training rows.

    Which rows is decided by a hash of the id, so it is the same in every run.
    """
    return labelled(labels, label, doc_id).orderBy(F.xxhash64(doc_id), doc_id).limit(most)


def crc_bucket(doc_id, of: int = 5):
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of ``column`` each, or one row.

    After the last one, memory that is free goes back to the system: the worker lives
    on for other tasks.
    """
    if not batch.num_rows:
        return
    ends = np.cumsum(lengths(batch.column(column)))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text; null counts 0."""
    data, starts = flat(column)
    return np.diff(starts)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and where each starts (one more at the end)."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, starts - starts[0]


_MASK = (1 << 64) - 1


def u64(x: int) -> np.uint64:
    """The integer modulo 2 ** 64."""
    return np.uint64(x & _MASK)


_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: The values of two bytes at once, by both as a 16-bit number; complex numbers are only 16 bytes to copy.
_TWO_BYTES = np.stack((np.tile(_BYTE, 256), np.repeat(_BYTE, 256)), axis=1).view(np.complex128).ravel()
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of the rolling hash, and of its inverse."""
    if len(_POWERS[0]) < n:
        m = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(m, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` gets the hash of any stretch of ``data``."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    rest = sums[1:]  # no second array of this size
    even = len(data) & ~1
    np.take(_TWO_BYTES, np.ascontiguousarray(data[:even]).view("<u2"), out=rest[:even].view(np.complex128), mode="clip")
    rest[even:] = _BYTE[data[even:]]
    rest *= up[: len(data)]
    np.cumsum(rest, out=rest)
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``; equal stretches have equal hashes anywhere."""
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of every stretch of ``size`` bytes."""
    sums, n = prefix_sums(data), max(0, len(data) - size + 1)
    return mixed((sums[size : size + n] - sums[:n]) * powers(len(sums))[1][:n] + u64(size))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


#: Bytes that are not in words of letters and digits; all non-ASCII signs are, A-Z must be lowered before.
WORD_BREAK = np.ones(256, bool)
WORD_BREAK[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def lowered(texts: pa.Array) -> pa.Array:
    """Texts in lower case; null becomes empty."""
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))


def word_spans(data: np.ndarray, starts: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are not ``breaks``, and the index of its text.

    By default the words ``[^\\x20\\x09-\\x0D]+``.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = (data != 32) & (data - np.uint8(9) > 4) if breaks is _SPACE else ~breaks[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cut = starts[(starts > 0) & (starts < len(data))]
    opens[cut] = inside[cut]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[cut - 1] = inside[cut - 1]
    begin = np.flatnonzero(opens)
    return begin, np.flatnonzero(closes) + 1, owners(begin, starts)


def owners(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of the stretch, from one start to the next, of each of ascending places, the first start not behind them."""
    ends = np.concatenate((np.searchsorted(places, starts[1:]), [len(places)]))
    return np.repeat(np.arange(len(starts)), np.diff(ends, prepend=0))


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ASCII-lower-cased word of all texts, and the index of its text."""
    data, starts = flat(column)
    data = lower_ascii(data)
    begin, end, owner = word_spans(data, starts)
    return span_hashes(prefix_sums(data), begin, end), owner


def shingles(words: np.ndarray, owner: np.ndarray, size: int, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words of each text, sorted by text and value.

    A text with fewer words has its whole sequence as the only one; without words, none.
    """
    count = np.bincount(owner, minlength=n_texts)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    odd = [u64((2 * k + 1) * 0xD6E8FEB86659FD93) for k in range(size)]
    n = max(0, len(words) - size + 1)
    value = np.zeros(n, np.uint64)
    for k in range(size):
        value = mixed(value * np.uint64(3) + words[k : k + n] * odd[k]) if n else value
    ok = owner[:n] == owner[size - 1 : size - 1 + n] if n else np.zeros(0, bool)
    value, of = value[ok], owner[:n][ok]
    short = np.flatnonzero((count > 0) & (count < size))
    extra = np.zeros(len(short), np.uint64)
    for i, d in enumerate(short):
        x = count[d : d + 1].astype(np.uint64)
        for w in words[first[d] : first[d] + count[d]]:
            x = mixed(x * np.uint64(5) + w)
        extra[i] = x[0]
    value, of = np.concatenate((value, extra)), np.concatenate((of, short))
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], of[new]


def ranges(hashes: np.ndarray, n: int) -> np.ndarray:
    """Range of each hash, ascending with it."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def planes(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane: the planes of small ones are empty."""
    if len(values) < 128:
        return values.view(np.uint8).reshape(len(values), -1).T.tobytes()
    rest = values.view(f"u{values.dtype.itemsize}")
    out = np.zeros((rest.itemsize, len(rest)), np.uint8)
    for k in range(-(-int(rest.max()).bit_length() // 8)):
        out[k] = rest >> rest.dtype.type(8 * k)  # the lowest byte is kept
    return out.tobytes()


def unplanes(raw: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def bit_table(rows: DataFrame, places: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """One table of ``size`` bits, in bytes, with the bits at the ``places`` of all rows."""
    width = size // 8 // _BIT_RANGES

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size >> 3, np.uint8)
        for batch in batches:
            if batch.num_rows:
                at = places(batch)
                np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        some = np.flatnonzero(bits.reshape(_BIT_RANGES, width).any(axis=1))
        blobs = [zstandard.compress(bits[k * width : (k + 1) * width].tobytes(), 1) for k in some.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(blobs, pa.binary())], ["at", "bits"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.uint8)
        for blob in table["bits"]:
            total |= np.frombuffer(zstandard.decompress(blob.as_py()), np.uint8)
        return pa.table({"at": table["at"][:1], "bits": pa.array([zstandard.compress(total.tobytes(), 1)], pa.binary())})

    out = np.zeros((_BIT_RANGES, width), np.uint8)
    for r in rows.mapInArrow(mark, "at long, bits binary").groupBy("at").applyInArrow(add, "at long, bits binary").collect():
        out[r["at"]] = np.frombuffer(zstandard.decompress(r["bits"]), np.uint8)
    return out.ravel()


def numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the place from 0 of a row among those of its ``keys`` by ``order``, and their number ``total``.

    Nulls come first. Rows are sorted into ranges by everything, so any share of them
    may have one key; places follow from the counts of the ranges. Rows that are equal
    in ``order`` take the order they have in ``rows``, which should be a stored table.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in keys + order + ["_tie"]]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    in_ranges = tied.repartitionByRange(tasks, *by).sortWithinPartitions(*by).drop("_tie")
    stored = written(in_ranges.withColumn("_row", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_row", 33))
    counts = stored.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    ahead = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    counts = counts.withColumn("total", F.sum("_n").over(Window.partitionBy(*keys))).alias("c")
    same = F.col("r._part") == F.col("c._part")
    for k in keys:
        same &= F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}"))
    at = (F.col("r._row") - F.col("c._first") + F.col("c._ahead")).alias("at")
    return stored.alias("r").join(counts, same).select(*[F.col(f"r.{c}") for c in rows.columns], at, F.col("c.total").alias("total"))
