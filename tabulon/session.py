"""Session set-up and the shared folder in which intermediate results are kept."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OPEN = threading.local()


def build_session(app: str = "tabulon", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; cluster settings given by spark-submit win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session in one process may fall back to a temporary folder: on a cluster, a local one of
    several processes too, a machine-local folder would be lost together with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tabulon-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder. All paths of an application lie in one folder of
    its own, which can be removed as a whole once the application has ended."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/tabulon-{application}/{label}-{uuid.uuid4().hex}"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query begun inside are deleted as soon as it has ended, not when the driver
    happens to collect its garbage. Nothing reads them again: every later query starts from stored tables."""
    already = spark.conf.get(_RELEASE, "false") == "true"
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if not already:
            spark.conf.set(_RELEASE, "false")


@contextmanager
def more_partitions(spark: SparkSession, least: int) -> Iterator[int]:
    """Shuffles of queries that run inside have at least so many partitions, which adaptive execution may join. Gives their number."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    now = max(int(before), least)
    spark.conf.set("spark.sql.shuffle.partitions", str(now))
    try:
        yield now
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


class Scratch:
    """The tables stored while a ``scratch_tables`` block is open."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self.paths: dict[str, str | None] = {}  # with the name in the catalog, if any
        self._kept: set[str] = set()

    def keep(self, *stored: DataFrame) -> None:
        """These outlive the block, as what it returns still reads them."""
        self._kept |= {df._scratch_path for df in stored}

    def drop(self, *stored: DataFrame) -> None:
        """These are not read any more."""
        for df in stored:
            self._delete(df._scratch_path)

    def _delete(self, path: str) -> None:
        if path in self.paths:
            if name := self.paths.pop(path):
                self._spark.sql(f"DROP TABLE IF EXISTS {name}")
            at = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(at, True)

    def close(self, failed: bool) -> None:
        for path in list(self.paths):
            if failed or path not in self._kept:
                self._delete(path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Scratch]:
    """Owns the intermediate tables that this thread stores inside and deletes them at the end, but for those
    that are kept. A kept table of an inner block belongs to the block around it."""
    stack = _OPEN.__dict__.setdefault("stack", [])
    scratch, failed = Scratch(spark), True
    stack.append(scratch)
    try:
        yield scratch
        failed = False
    finally:
        stack.pop()
        scratch.close(failed)
        if stack:
            stack[-1].paths |= scratch.paths


def store_parquet(df: DataFrame, label: str, by: Sequence[str] = (), buckets: int = 0, **options: str) -> DataFrame:
    """Write ``df`` to a new path in the shared folder and read it back; in ``buckets`` by the hash of ``by``, if
    these are given. The catalog entry that buckets need has the name of the folder."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_") if buckets else None
    if stack := _OPEN.__dict__.get("stack"):
        stack[-1].paths[path] = name
    with released_shuffles(spark):
        if buckets:
            df.write.options(**options).option("path", path).bucketBy(buckets, *by).saveAsTable(name)
        else:
            df.write.options(**options).parquet(path)
    stored = spark.table(name) if buckets else spark.read.schema(df.schema).parquet(path)
    stored._scratch_path = path
    return stored


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps start from the stored columns instead of repeating shuffles, a lost executor
    costs no lineage, unused columns are not read, and Catalyst knows the size of the result.
    """
    return store_parquet(df, "table")


def materialize_sized(df: DataFrame) -> tuple[DataFrame, int]:
    """Like ``materialize``, with the number of rows, which the stored files know by themselves."""
    stored = materialize(df)
    return stored, stored.count()
