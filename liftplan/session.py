"""Session settings, the shared scratch area, and frames kept for reuse."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators count on. Skewed joins are split at run time even
# where the split costs one more exchange further down.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# What a task reads at most, of a shuffle (unless one key holds more) and of files: rows that are sorted, or turned into
# twelve by a month table, take about 50 times the memory of their shuffled bytes, rows grouped as they are read about 14 times that of their file.
TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_SIZES = {TASK_SIZE: 16 << 20, "spark.sql.files.maxPartitionBytes": 32 << 20}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "liftplan", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session; ``conf`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere; smaller task sizes of its own stay."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in TASK_SIZES.items():
        if in_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark


def scratch_base(spark: SparkSession) -> str:
    """Folder all executors can write to: ``spark.checkpoint.dir``, or the session's checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_base(spark)}/liftplan/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each write inside as the write ends, not when the driver's garbage is collected.

    For rows that are read back from where they were written, so that their shuffles have no second reader.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


_owned: ContextVar[list[str] | None] = ContextVar("owned_frames", default=None)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch area and read it back.

    Used where a costly frame feeds several outputs: later reads prune columns,
    start from a short lineage and survive the loss of executors. The frame
    belongs to the enclosing ``staging`` block, if there is one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    with shuffles_released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, label: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """:func:`stage` with the rows dealt into buckets by ``keys`` and sorted by them inside each.

    Joins and groupings on these keys, one after the other, read the buckets as they lie: no shuffle above the scan, where both sides
    have the same number of buckets (default: the session's shuffle partitions). The layout is kept in the session's catalog, as Spark's
    bucketed tables are; the table goes with the enclosing ``staging`` block. A key that holds a large share of all
    rows makes one large bucket, so frames with hot keys are staged plainly and shuffled, where Spark splits them.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    name = re.sub(r"\W", "_", path.rsplit("/", 1)[1])
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
        owned.append(f"table:{name}")
    # Dealt the same way before the write, so that a bucket is one file.
    dealt = df.repartition(buckets, *keys)
    with shuffles_released(spark):
        dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name)


#: Slices in which the joins of large staged frames are made.
SLICES = 8


class Slices:
    """:func:`stage` with the rows dealt into slices by ``keys``, each in a folder of its own that can be read and dropped alone.

    The write is partitioned and needs no shuffle. Equal keys, nulls too, are in the slice of one number in all frames cut by as many columns of the same types.
    """

    def __init__(self, df: DataFrame, label: str, keys: Sequence[str], slices: int = SLICES):
        self.spark, self.schema, self.slices = df.sparkSession, df.schema, slices
        self.path = scratch_path(self.spark, label)
        owned = _owned.get()
        if owned is not None:
            owned.append(self.path)
        number = F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int")
        with shuffles_released(self.spark):
            df.withColumn("__slice", number).write.option("compression", "zstd").partitionBy("__slice").parquet(self.path)

    def take(self, i: int) -> DataFrame:
        fs, handle, _ = hadoop_fs(self.spark, f"{self.path}/__slice={i}")
        if not fs.exists(handle):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/__slice={i}")

    def drop(self, i: int) -> None:
        fs, handle, _ = hadoop_fs(self.spark, f"{self.path}/__slice={i}")
        fs.delete(handle, True)


def stage_sliced(join: Callable[..., DataFrame], label: str, *frames: Slices) -> DataFrame:
    """``join`` of the frames slice by slice, staged.

    For joins whose rows meet inside a slice only. A slice's shuffles and its input are gone before the next slice is read, so the
    disk holds the shuffles of one slice, and the input not yet joined or the rows made of it.
    """
    spark = frames[0].spark
    path = scratch_path(spark, label)
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    for i in range(frames[0].slices):
        made = join(*[f.take(i) for f in frames])
        with shuffles_released(spark):
            made.write.option("compression", "zstd").mode("append").parquet(path)
        for f in frames:
            f.drop(i)
    return spark.read.schema(made.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable]:
    """Drop the frames staged inside the block at its end, and no others.

    Put a job and the writing of its outputs inside; what is left to read lazily
    after the block would no longer find its input. Blocks of other threads and
    enclosing blocks keep their own frames. The block's value calls a function whose staged frames belong to the
    enclosing block and gives its result, for frames that outlive this one.
    """
    outer = _owned.get()
    mine: list[str] = []
    token = _owned.set(mine)

    def kept(make: Callable):
        inside = _owned.set(outer)
        try:
            return make()
        finally:
            _owned.reset(inside)

    try:
        yield kept
    finally:
        _owned.reset(token)
        for path in mine:
            if path.startswith("table:"):
                spark.sql(f"DROP TABLE IF EXISTS {path.removeprefix('table:')}")
                continue
            fs, handle, _ = hadoop_fs(spark, path)
            fs.delete(handle, True)


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for the actions inside the block and always release it."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def hadoop_fs(spark: SparkSession, path: str):
    """File system and path handles for moving whole folders."""
    jvm = spark.sparkContext._jvm
    handle = jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), handle, jvm
