"""Writing frames: append, replace, replace-while-reading, and SQL views."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from liftplan.session import hadoop_fs, shuffles_released, stage, staging
from liftplan.sources.catalog import MANIFEST, PLAIN, POINTER, VERSION, TableSpec, Version, _load, current, live_version, versions, with_months


#: How long a replaced version stays for readers that opened it.
GRACE_SECONDS = 24 * 3600.0


def _writer(df: DataFrame, spec: TableSpec, partition_by: Sequence[str], files: int | None):
    if files is not None:
        # A shuffle rather than coalesce(): the stage before keeps its width.
        df = df.repartition(files)
    elif partition_by:
        # Even-sized files per partition value, split further where one value is large.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(spec.format).options(**spec.options)
    if spec.format == "csv":
        writer = writer.option("header", "true")
    if spec.format == "jdbc":
        writer = writer.option("dbtable", spec.location)
    return writer.partitionBy(*partition_by) if partition_by else writer


def _folders(df: DataFrame, target: TableSpec, partition_by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Rows with their month folders, and all folder columns."""
    return with_months(df, target), [*target.months.values(), *[c for c in partition_by if c not in target.months.values()]]


def append(df: DataFrame, target: TableSpec, partition_by: Sequence[str] = ()) -> None:
    """Add the rows of ``df`` to the table and keep what is there.

    A version that shares partition folders with older ones gets a new version with the rows in new folders of their own.
    """
    df, partition_by = _folders(df, target, partition_by)
    spark = df.sparkSession
    if target.format in ("jdbc", "delta"):
        writer = _writer(df, target, partition_by, None).mode("append")
        writer.save() if target.format == "jdbc" else writer.save(target.location)
        return
    live = live_version(spark, target)
    if live is not None and live.parts is not None:
        merge_partitions(df, target, partition_by, keep_old_rows=True)
        return
    _writer(df, target, partition_by, None).mode("append").save(current(spark, target))


def replace(df: DataFrame, target: TableSpec, partition_by: Sequence[str] = (),
            files: int | None = None) -> None:
    """Make the table hold exactly ``df``, columns included.

    ``df`` must not read the table it replaces, unless the table has versions: then a new one is added, as by
    :func:`safe_replace`.
    """
    df, partition_by = _folders(df, target, partition_by)
    if target.format not in ("jdbc", "delta") and versions(df.sparkSession, target):
        _add_version(df, target, partition_by, files)
        return
    writer = _writer(df, target, partition_by, files).mode("overwrite")
    if target.format == "jdbc":
        writer.option("truncate", "true").save()
        return
    if target.format == "delta":
        writer = writer.option("overwriteSchema", "true")
    with shuffles_released(df.sparkSession):
        writer.save(target.location)


def safe_replace(df: DataFrame, target: TableSpec, partition_by: Sequence[str] = (), grace_seconds: float = GRACE_SECONDS) -> None:
    """Replace a table that ``df`` itself may read, while others read it too.

    File formats: the new content is written to a version folder inside the table, then one small pointer file is switched in a
    single rename. Readers see the old version until then and the new one after it; a run that fails before the switch changes
    nothing. Versions replaced within the last ``grace_seconds`` stay, so that a reader that opened one before the switch finishes;
    older ones go (:func:`drop_versions`). Database tables: the rows are staged first, then the table is emptied and written in the database's
    own transaction, if its driver has one. Delta keeps snapshots, so a plain overwrite is already safe.
    """
    if target.format == "jdbc":
        replace(stage(df, "safe-replace"), target)
        return
    if target.format == "delta":
        replace(df, target, partition_by)
        return
    df, partition_by = _folders(df, target, partition_by)
    _add_version(df, target, partition_by, None)
    drop_versions(df.sparkSession, target, grace_seconds)


def _add_version(df: DataFrame, target: TableSpec, partition_by: Sequence[str], files: int | None) -> None:
    name = f"{VERSION}{uuid.uuid4().hex}"
    with shuffles_released(df.sparkSession):
        _writer(df, target, partition_by, files).mode("overwrite").save(f"{target.location.rstrip('/')}/{name}")
    _point_to(df.sparkSession, target, name)


def _partition_folders(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition folders below ``folder``, such as ``a=1/b=2``."""
    fs, handle, _ = hadoop_fs(spark, folder)
    if not fs.exists(handle):
        return []
    found = []
    for entry in fs.listStatus(handle):
        name = entry.getPath().getName()
        if entry.isDirectory() and "=" in name:
            found += [name] if depth == 1 else [f"{name}/{rest}" for rest in _partition_folders(spark, f"{folder}/{name}", depth - 1)]
    return found


def merge_partitions(df: DataFrame, target: TableSpec, partition_by: Sequence[str], keep_old_rows: bool = False) -> list[str]:
    """Replace the partitions that ``df`` has rows for and leave all others as they are; returns the folders written.

    Only ``df`` is written. The new version's manifest names for each partition the version folder that holds it, so untouched
    folders are neither read nor moved. ``df`` may read the table itself. ``keep_old_rows`` adds the old rows of the touched partitions to those of ``df``. The
    manifest has an entry per partition folder, which is what the driver lists. A table that is not partitioned so is refused.
    """
    if target.format in ("jdbc", "delta") or not partition_by:
        raise ValueError("partitions are merged in partitioned file tables")
    spark, base = df.sparkSession, target.location.rstrip("/")
    live = live_version(spark, target) or Version(PLAIN)
    parts = dict(live.parts) if live.parts is not None else {p: live.name for p in _partition_folders(spark, f"{base}/{live.name}", len(partition_by))}
    fs, handle, _ = hadoop_fs(spark, f"{base}/{live.name}")
    if not parts and fs.exists(handle) and any(not e.getPath().getName().startswith(("_", ".")) for e in fs.listStatus(handle)):
        raise ValueError(f"{base} is not partitioned by {list(partition_by)}")
    if keep_old_rows and parts:
        touched = df.select(*partition_by).distinct()
        old = _load(spark.read.format(target.format).options(**target.options), target, Version(live.name, parts))
        same = [old[c].cast("string").eqNullSafe(touched[c].cast("string")) for c in partition_by]
        df = df.unionByName(old.join(touched, same, "left_semi").select(*[F.col(c).cast(df.schema[c].dataType) for c in df.columns if c in old.columns]), allowMissingColumns=True)
    name = f"{VERSION}{uuid.uuid4().hex}"
    _writer(df, target, partition_by, None).mode("overwrite").save(f"{base}/{name}")
    written = sorted(_partition_folders(spark, f"{base}/{name}", len(partition_by)))
    write_text(spark, f"{base}/{name}/{MANIFEST}", json.dumps(parts | dict.fromkeys(written, name), indent=0))
    _point_to(spark, target, name)
    return written


def drop_versions(spark: SparkSession, target: TableSpec, older_than: float, now: float | None = None) -> list[str]:
    """Delete versions replaced more than ``older_than`` seconds ago, and what failed runs left before that; returns their names.

    Partition folders that the present version, or one that stays, shares with a dropped one stay. Readers must not
    take longer than ``older_than``.
    """
    listed, base = versions(spark, target), target.location.rstrip("/")
    if not listed:
        return []
    limit = (time.time() if now is None else now) - older_than
    kept = [(n, at) for n, at in listed if at is None or at >= limit]
    needed = set().union(*(live_version(spark, target, n).folders() for n, _ in kept))
    still: dict[str, set[str]] = {}
    for n, _ in kept:
        for part, folder in (live_version(spark, target, n).parts or {}).items():
            still.setdefault(folder, set()).add(part)
    fs, handle, _ = hadoop_fs(spark, base)
    dropped = []
    for entry in fs.listStatus(handle):
        name = entry.getPath().getName()
        plain = not name.startswith(VERSION)
        folder = PLAIN if plain else name
        if name.startswith(POINTER) or any(n == folder for n, _ in kept):
            continue
        known = any(n == folder for n, _ in listed)
        if not known and entry.getModificationTime() / 1000 >= limit:
            continue  # perhaps a run that is still writing
        if folder in needed:
            # Only partitions that nobody needs any more go.
            depth = max(p.count("/") + 1 for p in still[folder])
            for part in ([name] if plain and depth == 1 and "=" in name else _partition_folders(spark, f"{base}/{folder}", depth)):
                if part not in still[folder]:
                    dropped.append(f"{folder}/{part}")
                    fs.delete(hadoop_fs(spark, f"{base}/{folder}/{part}")[1], True)
            continue
        dropped.append(name)
        fs.delete(entry.getPath(), True)
    _write_pointer(spark, base, kept)
    return dropped


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, handle, _ = hadoop_fs(spark, path)
    out = fs.create(handle, True)
    out.write(bytearray(text.encode()))
    out.close()


def _point_to(spark: SparkSession, target: TableSpec, name: str) -> None:
    """Make ``name`` the present version; the one before it is marked with the time."""
    base = target.location.rstrip("/")
    before = versions(spark, target)
    if not before:
        fs, handle, _ = hadoop_fs(spark, base)
        if any(not e.getPath().getName().startswith(("_", ".")) for e in fs.listStatus(handle)):
            before = [(PLAIN, None)]
    now = time.time()
    _write_pointer(spark, base, [(name, None), *[(n, now if at is None else at) for n, at in before]])
    spark.catalog.refreshByPath(base)


def _write_pointer(spark: SparkSession, base: str, listed: Sequence[tuple[str, float | None]]) -> None:
    """Switch the table's pointer; the rename replaces the old pointer in one step."""
    fresh_path = f"{base}/{POINTER}-{uuid.uuid4().hex}"
    write_text(spark, fresh_path, "\n".join(n if at is None else f"{n}\t{at}" for n, at in listed))
    fs, fresh, jvm = hadoop_fs(spark, fresh_path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(fresh), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}")), options)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its number of rows, filled by the action that computes it; no second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def write_outputs(spark: SparkSession, job: Callable[[], Mapping[str, DataFrame]], targets: Mapping[str, TableSpec],
                  partition_by: Mapping[str, Sequence[str]] | None = None) -> dict[str, int]:
    """Run a job and write each of its frames that has a target, then drop what the job staged; returns the rows of each.

    A table that the job reads is replaced safely; a frame without a target is not computed. Rows are counted as they are written.
    """
    with staging(spark):
        made = job()
        unknown = set(targets) - set(made)
        if unknown:
            raise KeyError(f"the job has no outputs {sorted(unknown)}")
        rows = {}
        for name, target in targets.items():
            df, seen = counted(made[name], name)
            safe_replace(df, target, (partition_by or {}).get(name, ()))
            rows[name] = seen.get["n_rows"]
        return rows


def publish(df: DataFrame, view: str) -> DataFrame:
    """Expose ``df`` to SQL text under ``view``."""
    df.createOrReplaceTempView(view)
    return df
