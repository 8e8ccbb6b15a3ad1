"""Incremental monthly rollup over landed page files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import Material, Roles
from ..operators.monthly import filter_material, typed_rows

# A month counts as closed once data two months newer has been seen.
LATENESS = "62 days"
_SUMS = "category string, month date, count double"


def read_page_stream(
    spark: SparkSession,
    directory: str,
    schema: StructType,
    fmt: str = "csv",
    files_per_batch: int = 100,
    pattern: str | None = None,
) -> DataFrame:
    """Page files as they land, a bounded number per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(directory)


def stream_rollup(
    rows: DataFrame, roles: Roles, words: Material | None = None, lateness: str = LATENESS
) -> DataFrame:
    """Running ``category, month, count`` over a stream of raw rows.

    The material filter keeps its exact stage only: the fallback needs the whole
    table. State is one sum per category and open month; the watermark closes
    months in append and update mode, where later rows for them are dropped.
    Complete mode keeps everything and equals the batch rollup.
    """
    if words is not None and roles.material:
        rows = filter_material(rows, roles.material, words, strict=True)
    typed = typed_rows(rows, roles, by_row=True).withColumn("month", F.col("month").cast("timestamp"))
    return (
        typed.withWatermark("month", lateness)
        .groupBy("category", "month")
        .agg(F.sum("count").alias("count"))
        .withColumn("month", F.col("month").cast("date"))
    )


class _Folder:
    """Files of a target on whichever file system its scheme names, seen from the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        root = self._at()
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        if not self._fs.exists(self._at()):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._at())]

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Written beside and moved into place, so that a reader finds all of it or nothing."""
        stream = self._fs.create(self._at(f"_{name}.new"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.remove(name)
        self._fs.rename(self._at(f"_{name}.new"), self._at(name))


_POINTER = "_sums-"


def _pointer(folder: _Folder) -> dict:
    """The folder with the sums so far and the last batch in it: the newest pointer says."""
    names = sorted(n for n in folder.names() if n.startswith(_POINTER))
    return json.loads(folder.read(names[-1])) if names else {"state": None, "batch": -1}


def _point(folder: _Folder, state: str, batch: int) -> None:
    """From now on ``state`` counts. Of older folders the one before stays, as readers may still be in it."""
    before = _pointer(folder)
    folder.put(f"{_POINTER}{batch:012d}", json.dumps({"state": state, "batch": batch}))
    for name in folder.names():
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= before["batch"]:
            folder.remove(name)
        if name.startswith("state=") and name not in (state, before["state"]):
            folder.remove(name)
        if name.startswith(_POINTER) and int(name.removeprefix(_POINTER)) not in (batch, before["batch"]):
            folder.remove(name)


def _batches(folder: _Folder, after: int) -> list[int]:
    found = [int(n.removeprefix("batch=")) for n in folder.names() if n.startswith("batch=")]
    return sorted(b for b in found if b > after)


def compact(spark: SparkSession, target: str) -> None:
    """All batches so far into one folder of sums, one row per key.

    The pointer is written last: until then readers use the old folder and its batches,
    and what a lost driver left behind is overwritten the next time.
    """
    folder = _Folder(spark, target)
    new = _batches(folder, _pointer(folder)["batch"])
    if new:
        state = f"state={new[-1]}"
        latest_sums(spark, target).write.mode("overwrite").parquet(f"{target}/{state}")
        _point(folder, state, new[-1])


def write_batches(sums: DataFrame, target: str, checkpoint: str, mode: str = "update", every: int = 20) -> StreamingQuery:
    """Run a rollup over all available files, one Parquet folder per micro-batch.

    A batch folder is overwritten when its batch is replayed, so a restart after a
    lost executor or driver cannot count anything twice. ``latest_sums`` reads the
    newest value of every key back. Modes: ``update`` (sums that changed, made one folder
    after ``every`` batches), ``append`` (months that are closed, each key once) or
    ``complete`` (all sums each time; the newest folder is all there is to read).
    """
    if mode not in ("update", "append", "complete"):
        raise ValueError(f"no such mode: {mode}")

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = _Folder(spark, target)
        if mode == "complete":
            state = f"state={batch_id}"
            batch.write.mode("overwrite").parquet(f"{target}/{state}")
            _point(folder, state, batch_id)
            return
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        if batch_id - _pointer(folder)["batch"] >= every:
            compact(spark, target)

    return (
        sums.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )


def latest_sums(spark: SparkSession, target: str) -> DataFrame:
    """The current rollup behind ``write_batches``: one folder of sums and the batches after it."""
    folder = _Folder(spark, target)
    now = _pointer(folder)
    parts = [(now["batch"], now["state"])] if now["state"] else []
    parts += [(b, f"batch={b}") for b in _batches(folder, now["batch"])]
    if not parts:
        return spark.createDataFrame([], _SUMS)
    if len(parts) == 1:
        return spark.read.schema(_SUMS).parquet(f"{target}/{parts[0][1]}")
    at = F.regexp_extract("_metadata.file_path", r".*/(?:batch|state)(?:=|%3D)(\d+)/", 1).cast("long")
    rows = spark.read.schema(_SUMS).option("recursiveFileLookup", True).parquet(*[f"{target}/{name}" for _, name in parts])
    return rows.groupBy("category", "month").agg(F.max_by("count", at).alias("count"))
