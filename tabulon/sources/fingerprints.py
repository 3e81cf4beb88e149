"""Fingerprints of files and of tables."""

from __future__ import annotations

import functools
import hashlib
import operator
import re
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.session import materialize

WHOLE_BYTES = 1 << 30  # of a file with a compressed one's name, that one row may hold; Spark ends at 2 GB
ROW_BYTES = 1 << 25  # of any other; a task holds a row about four times
PIECE_BYTES = 1 << 24  # a file with larger pieces is a row, too
BATCH_BYTES = 1 << 22  # of pieces that Python gets at once
_BOM = b"\xef\xbb\xbf"
_DECOMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def file_fingerprint(spark: SparkSession, path: str, pattern: str | None = None, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """(file, size, md5) per file below ``path``, by its path from there; equals ``md5sum``.

    Files are spread over the tasks and read through Spark's file systems. One of at most ``ROW_BYTES`` is a row in a task. A
    larger one is read at once, by one task, in pieces between line feeds that are added up as they come, so that no more
    than a few are held; nothing is shuffled. A file with a piece above ``PIECE_BYTES`` is a row up to ``whole_bytes``; beyond, its pieces must be
    below 2 GB. Spark would unpack a file with a compressed file's name, so that one is a row up to ``whole_bytes``, and
    beyond it is refused. Spark does not list empty files.
    """

    def read(source: str, longest: int = (1 << 31) - 1) -> DataFrame:
        files = spark.read.format(source).option("recursiveFileLookup", "true").option("lineSep", "\n")
        files = files.option("mapreduce.input.linerecordreader.line.maxlength", longest)  # longer pieces are left out
        return (files.option("pathGlobFilter", pattern) if pattern else files).load(path)

    files, limit = read("binaryFile"), min(ROW_BYTES, whole_bytes)
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/") + "/"
    below = F.when(F.contains("path", F.lit(root)), F.substring_index("path", root, -1))
    name = F.coalesce(below, F.element_at(F.split("path", "/"), -1)).alias("file")
    packed = F.lit(False)
    for end in _DECOMPRESSED:
        packed = packed | F.endswith("_metadata.file_name", F.lit(end))
    whole = [name, F.col("length").alias("size"), F.md5("content").alias("md5")]
    found = files.where(F.col("length") <= limit).select(whole)  # pushed down: the content of others is not read
    large = files.where(F.col("length") > limit).select("path", "length", packed.alias("packed"), F.col("_metadata.file_path").alias("at"))
    if refused := large.where(F.col("packed") & (F.col("length") > whole_bytes)).limit(5).collect():
        raise ValueError(f"large files with names of compressed ones cannot be read in pieces: {[r.path for r in refused]}")
    largest = {r.packed: r.length for r in large.groupBy("packed").agg(F.max("length").alias("length")).collect()}
    again = large.where("packed").select("path", "length").collect() if True in largest else []
    if False in largest:
        kept = (F.col("_metadata.file_size") > limit) & ~packed
        summed = _large_files(read("text", PIECE_BYTES).where(kept), largest[False]).where("md5 is not null")
        found = found.unionByName(summed.select(name, "size", "md5"))
        left = large.where("not packed").join(summed.select("at"), "at", "left_anti").select("path", "length", "at").collect()  # names only
        again += [r for r in left if r.length <= whole_bytes]
        if longest := [r.at for r in left if r.length > whole_bytes]:
            summed = _large_files(read("text").where(F.col("_metadata.file_path").isin(longest)), largest[False])
            if broken := summed.where("md5 is null").limit(5).collect():
                raise ValueError(f"files of which not all bytes were read: {[r.path for r in broken]}")
            found = found.unionByName(summed.select(name, "size", "md5"))
    if again:
        sizes = functools.reduce(operator.or_, (F.col("length") == n for n in sorted({r.length for r in again})))  # pushed down
        found = found.unionByName(files.where(sizes & F.col("path").isin([r.path for r in again])).select(whole))
    return found


@contextmanager
def _undivided(spark: SparkSession, size: int) -> Iterator[None]:
    """Queries that run inside read a file of up to ``size`` bytes in one task, from its beginning to its end."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = {k: spark.conf.get(k) for k in names}
    for k, v in zip(names, (size, size, BATCH_BYTES)):
        spark.conf.set(k, f"{v}b")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _large_files(lines: DataFrame, largest: int) -> DataFrame:
    """(at, path, size, md5) of the files of which ``lines`` are the pieces between line feeds; no md5 if some are missing."""
    pieces = lines.select(
        F.col("_metadata.file_path").alias("at"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(at: str, size: int, plain, marked, total: int) -> pa.RecordBatch:
            ends, begins = (size - total) % 3 == 1, size - total >= 3  # a last line feed and a byte order mark are not in the pieces
            digest = marked if begins else plain
            if ends:
                digest.update(b"\n")
            md5 = digest.hexdigest() if size - total in (0, 1, 3, 4) else None
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (at, unquote(at), size, md5)], schema=schema)

        now = None
        for batch in batches:
            paths, start = batch.column("at"), 0
            for end in pc.run_end_encode(paths).run_ends.to_pylist() if len(batch) else []:
                path, size = paths[start].as_py(), batch.column("size")[start].as_py()
                joined = b"\n".join(batch.column("piece").slice(start, end - start).to_pylist())
                start = end
                if now is None or now[0] != path:
                    if now is not None:
                        yield result(*now)
                    now = (path, size, hashlib.md5(), hashlib.md5(_BOM), 0)
                else:
                    joined = b"\n" + joined
                for digest in now[2:4]:
                    digest.update(joined)
                now = (*now[:4], now[4] + len(joined))
        if now is not None:
            yield result(*now)

    schema = pa.schema([("at", pa.string()), ("path", pa.string()), ("size", pa.int64()), ("md5", pa.string())])  # metadata escape paths
    with _undivided(lines.sparkSession, largest):
        return materialize(pieces.mapInArrow(run, "at string, path string, size long, md5 string"))


def _exact_text(column: str, kind: T.DataType) -> Column:
    """Text of a value that is the same on other engines; null differs from every value.

    A float is written as whole millionths and the next nine digits, both exact in double
    arithmetic; one too large for that in Spark's own form.
    """
    value = F.col(column)
    text = value.cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        scaled = value.cast("double") * 1e6
        rest = (scaled - F.floor(scaled)) * 1e9
        parts = F.concat(F.floor(scaled).cast("string"), F.lit(":"), F.floor(rest).cast("string"))
        text = F.when(F.abs(value) < 1e11, parts).otherwise(text)
    return F.coalesce(F.concat(F.lit("v"), text), F.lit("n"))


def table_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """(dataset_row_count, dataset_checksum) over whole rows: does not depend on row order or on files."""
    digest = F.md5(F.concat_ws(",", *[_exact_text(c, df.schema[c].dataType) for c in columns]))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("decimal(38,0)")
    return df.agg(
        F.count("*").alias("dataset_row_count"),
        F.sum(number).cast("decimal(38,0)").alias("dataset_checksum"),
    )
