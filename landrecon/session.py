"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here relies on. The lookup joins are written so that adaptive
# execution may split a hot key: one side always has at most one row per key.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Java interprets methods of more bytes than this instead of compiling them; Spark then had better not write one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Intermediate tables are mostly ids and short codes, which zstd writes in about half the bytes.
COMPRESSION = {"compression": "zstd"}

# Called when stages are dropped, by whoever keeps frames that read them.
ON_DROP: list[Callable[[], None]] = []


def build_session(cores: str = "*", app: str = "landrecon", memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in spark.checkpoint.dir, else the
    session's warehouse. A warehouse on the machine's own disk will do only where driver and executors
    are one process; on a cluster the executors could not read each other's files there."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    one_process = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    if not one_process and at_path(spark, warehouse)[1].getUri().getScheme() == "file":
        raise ValueError(f"spark.checkpoint.dir must name a shared folder; {warehouse} is each machine's own")
    return warehouse


def at_path(spark: SparkSession, folder: str):
    """A Hadoop path and the file system that has it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def listing(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of a folder's files and of the files of its sub-folders."""
    path, files = at_path(spark, folder)
    found = []
    for status in files.listStatus(path):
        own = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in own]
    return tuple(sorted(found))


def stages_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/landrecon-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, below one folder per application, which goes when the
    application ends."""
    folder = stages_dir(spark)
    path, files = at_path(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; frames that read them are no longer valid."""
    path, files = at_path(spark, stages_dir(spark))
    files.delete(path, True)
    for table in spark.catalog.listTables():
        if re.fullmatch("stage_[0-9a-f]{32}", table.name):
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    for forget in ON_DROP:
        forget()


@dataclass(frozen=True)
class Layout:
    """Rows of a key lie together: in one of so many buckets of every stage."""

    key: str
    buckets: int


_layout: ContextVar[Layout | None] = ContextVar("layout", default=None)
# A join on more columns than the layout's key may use the layout as it is.
SUBSET = "spark.sql.requireAllClusterKeysForCoPartition"
# Rows that lie together need no broadcast: estimates, made from the bytes of compressed files, take large lookups
# for small ones, which the driver would have to gather.
IN_PLACE = {SUBSET: "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def layout(keys: Iterable[str]) -> Layout | None:
    """The layout in force, if it keeps rows with equal keys together."""
    at = _layout.get()
    return at if at is not None and at.key in keys else None


@contextmanager
def co_located(spark: SparkSession, key: str, buckets: int):
    """Within this block stages are bucketed by ``key``, and lookups and pair joins whose keys include
    it take the rows where they lie. No key may be too large for a task. What the block computes has to
    be staged in it. Rows enter by ``deal``."""
    before = {name: spark.conf.get(name) for name in IN_PLACE}
    for name, value in IN_PLACE.items():
        spark.conf.set(name, value)
    token = _layout.set(Layout(key, buckets))
    try:
        yield
    finally:
        _layout.reset(token)
        for name, value in before.items():
            spark.conf.set(name, value)


# What is staged in the innermost ``passing`` block: (frame, path, table of the catalogue).
_staged: ContextVar[list | None] = ContextVar("staged", default=None)


@contextmanager
def passing(spark: SparkSession):
    """What is staged within this block goes at its end, but the frames given to the function that the block
    gets. So do the files of its shuffles, which lie on the disks until the driver's memory is swept."""
    outer, here, kept = _staged.get(), [], []
    token = _staged.set(here)
    try:
        yield kept.append
    finally:
        _staged.reset(token)
        for entry in here:
            df, path, table = entry
            if any(df is k for k in kept):
                if outer is not None:
                    outer.append(entry)
                continue
            if table is not None:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            place, files = at_path(spark, path)
            files.delete(place, True)
        spark._jvm.System.gc()


def dealt(df: DataFrame) -> DataFrame:
    """Rows moved to where the layout in force has their key, if there is one."""
    at = layout(df.columns)
    return df if at is None else df.repartition(at.buckets, at.key)


def deal(df: DataFrame, name: str = "dealt") -> DataFrame:
    """Lay rows out as the layout in force says: their one shuffle."""
    at = _layout.get()
    return stage(df.repartition(at.buckets, at.key), name)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an intermediate result as Parquet and read it back.

    Cuts the lineage durably: lost executors re-read the files instead of recomputing the
    chain, later steps keep column pruning, and the planner sees true sizes.
    """
    path = new_path(df.sparkSession, name)
    at = layout(df.columns)
    if at is None:
        df.write.options(**COMPRESSION).parquet(path)
        return _noted_stage(df.sparkSession.read.schema(df.schema).parquet(path), path, None)
    # Only tables of the catalogue have buckets; the files lie in the shared folder all the same.
    table = f"stage_{path.rsplit('-', 1)[1]}"
    df.write.options(**COMPRESSION).bucketBy(at.buckets, at.key).option("path", path).format("parquet").saveAsTable(table)
    return _noted_stage(df.sparkSession.table(table), path, table)


def _noted_stage(df: DataFrame, path: str, table: str | None) -> DataFrame:
    if (here := _staged.get()) is not None:
        here.append((df, path, table))
    return df
