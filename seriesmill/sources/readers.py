"""Sources (S1-S4)."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever file system its scheme names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder on its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def normalise_headers(df: DataFrame) -> DataFrame:
    """Header names trimmed, unquoted and lower-cased."""
    return df.toDF(*[c.strip().strip('"').strip("'").lower() for c in df.columns])


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, max_rows: int | None = None, multi_line: bool = False
) -> DataFrame:
    """A CSV (all columns text) or Parquet table, optionally limited.

    Text is typed later by the coercing expressions, so no inference pass is
    needed. Which rows a limit keeps is not defined, as in any distributed scan.
    ``multi_line`` reads quoted line breaks in CSV; a file is then one task's work.
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    try:
        if fmt == "csv":
            df = _csv(spark, multi_line).option("header", True).csv(path)
        else:
            df = spark.read.format(fmt).load(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            raise _no_data(path) from err
        raise
    return df.limit(max_rows) if max_rows and max_rows > 0 else df


def _csv(spark: SparkSession, multi_line: bool):
    return spark.read.option("escape", '"').option("multiLine", multi_line)


def _no_data(path: str) -> FileNotFoundError:
    return FileNotFoundError(f"there is nothing to read at {path}")


def _headers(spark: SparkSession, directory: str) -> list[list[str]]:
    """The different headers of all files: the driver gets a line for each of them, not for each file."""
    lines = spark.read.text(directory).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.where("file_block_start = 0 AND trim(value) <> ''").withColumn("at", F.monotonically_increasing_id())
    firsts = lines.groupBy("file_path").agg(F.min_by("value", "at").alias("line")).select("line").distinct()
    found = sorted({r.line.removeprefix("\ufeff").rstrip("\r") for r in firsts.collect()})
    return [next(csv.reader([line])) for line in found]


def read_pages(spark: SparkSession, directory: str, max_rows: int | None = None, multi_line: bool = True) -> DataFrame:
    """S3: page files landed in one directory, read as one table.

    Every page carries its own header line; empty pages add no rows. Columns are matched
    by header name, a column that a page lacks is null there, and text may hold quoted line breaks
    (without ``multi_line`` large files are split, and it may not). A header is one line.

    A first pass over the text finds the names, which come in the order of the sorted headers.
    Records are then read by place; a task knows the header of the file it is in, so no
    file is listed on the driver and nothing is joined or shuffled.
    """
    if not path_exists(spark, directory):
        raise _no_data(directory)
    headers = _headers(spark, directory)
    if not headers:
        return read_table(spark, directory, "csv", max_rows)
    names = list(dict.fromkeys(name for header in headers for name in header))
    if len(headers) == 1 and len(names) == len(headers[0]):
        whole = _csv(spark, multi_line).option("header", True).schema(_text(names)).csv(directory)
    else:
        whole = _by_header(spark, directory, names, max(map(len, headers)), multi_line)
    return whole.limit(max_rows) if max_rows and max_rows > 0 else whole


def _text(names: list[str]) -> str:
    return ", ".join("`" + name.replace("`", "``") + "` string" for name in names)


def _by_header(spark: SparkSession, directory: str, names: list[str], width: int, multi_line: bool) -> DataFrame:
    """Records by place to columns by name. The first record of a file is its header."""
    if not multi_line:
        # A split file has its header in one task only.
        raise ValueError("pages with different headers are read with multi_line")
    places = [f"c{k}" for k in range(width)]
    records = _csv(spark, True).option("header", False).schema(_text(places)).csv(directory)
    records = records.select(*places, F.col("_metadata.file_path").alias("file"))

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, at = None, {}
        for batch in batches:
            files = batch.column("file").to_pylist()
            begin = 0
            while begin < len(files):
                end = begin + 1
                while end < len(files) and files[end] == files[begin]:
                    end += 1
                part = batch.slice(begin, end - begin)
                if files[begin] != file:
                    file = files[begin]
                    header = [part.column(p)[0].as_py() for p in places]
                    # Of a name that stands twice in a header, the first place counts.
                    at = {name.removeprefix("\ufeff"): p for p, name in reversed(list(zip(places, header, strict=True))) if name}
                    part = part.slice(1)
                empty = pa.nulls(part.num_rows, pa.string())
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([part.column(at[n]).cast(pa.string()) if n in at else empty for n in names], names)
                begin = end

    return records.mapInArrow(rename, _text(names))


def snapshot(spark: SparkSession, path: str, load: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet copy at ``path`` if one was completed, else load and write it."""
    if not path_exists(spark, path.rstrip("/") + "/_SUCCESS"):
        load().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
