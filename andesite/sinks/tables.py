"""Table writes: full refresh, guarded refresh, keyed upsert and dual write."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from andesite.operators.dedupe import latest, merge, same_values

log = logging.getLogger(__name__)

# What a failed job or command raises.
SPARK_ERRORS = (PySparkException, Py4JJavaError)


def snapshot_parquet(
    df: DataFrame, base: str, source: str, run_date: dt.date, required: bool = True
) -> str | None:
    """Write a run-dated copy under ``<base>/<source>/yyyy/MM/dd`` and return its path.

    With ``required=False`` a failed copy is logged and None returned.
    """
    path = f"{base}/{source}/{run_date:%Y/%m/%d}"
    try:
        df.write.mode("overwrite").parquet(path)
    except SPARK_ERRORS as e:
        if required:
            raise
        log.warning("snapshot %s skipped: %s", path, e)
        return None
    return path


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    return df.select(*df.sparkSession.table(table).columns)


def _spread(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Gather the rows of a table partition into few files; adaptive execution splits big ones."""
    return df.hint("rebalance", *partitions) if partitions else df


@contextmanager
def _overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """Have overwrites replace the whole table (static) or only partitions with rows (dynamic).

    ``insertInto`` takes the mode from the session alone and ignores it as a write option.
    """
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, mode)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace a table's content; columns are matched by name, types by store assignment."""
    partitions = _partition_columns(df.sparkSession, table)
    rows = _spread(_in_table_order(df, table), partitions)
    with _overwriting(df.sparkSession, "static"):
        rows.write.insertInto(table, overwrite=True)


def overwrite_if_nonempty(df: DataFrame, table: str, staging: str | None = None) -> bool:
    """Replace a table's content unless the frame is empty; tells whether it did.

    The frame is computed once, into the shared folder, and tested and written from there.
    """
    with staged(df, staging) as kept:
        if kept.isEmpty():
            return False
        overwrite_table(kept, table)
        return True


def staging_path(spark: SparkSession, folder: str | None = None) -> str:
    """A new path under the shared folder that the cluster names for checkpoints."""
    base = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/staged-{uuid.uuid4().hex}"


def _discard(spark: SparkSession, path: str) -> None:
    """Delete a staging path that this run has written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staged(df: DataFrame, folder: str | None = None) -> Iterator[DataFrame]:
    """The frame, written once to the shared folder and read from there.

    A lost executor costs a read, not the work behind the frame.  The rows are deleted after
    success; after a failure they are kept, and the log names their path.
    """
    spark = df.sparkSession
    path = staging_path(spark, folder)
    schema = df.schema
    df.write.parquet(path)
    try:
        yield spark.read.schema(schema).parquet(path)
    except SPARK_ERRORS:
        log.error("a write failed; its staged rows are kept at %s", path)
        raise
    _discard(spark, path)


def _conformed(df: DataFrame, table: str, partitions: Sequence[str]) -> DataFrame:
    """The rows as the table will hold them: its columns and types, and partition values as stored.

    An empty text in a partition column is stored as the null partition, so it is null here.
    """
    columns = []
    for f in df.sparkSession.table(table).schema:
        value = F.col(f.name).cast(f.dataType)
        if f.name in partitions and f.dataType.typeName() == "string":
            value = F.nullif(value, F.lit(""))
        columns.append(value.alias(f.name))
    return df.select(*columns)


def _touched(winners: DataFrame, existing: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The rows of ``existing`` in partitions that ``winners`` has rows for.

    Partitions without nulls are matched by equality, which lets Spark prune them; the few with
    a null in them are matched so that nulls equal each other.
    """
    values = winners.select(*[F.col(p).alias(f"_in_{p}") for p in partitions]).distinct()
    has_null = F.lit(False)
    for p in partitions:
        has_null = has_null | F.col(p).isNull()
    whole, partly = existing.filter(~has_null), existing.filter(has_null)
    equal = F.lit(True)
    for p in partitions:
        equal = equal & (whole[p] == values[f"_in_{p}"])
    return whole.join(values, equal, "left_semi").unionByName(
        partly.join(values, same_values(partly, values, partitions), "left_semi")
    )


def upsert_by_key(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    keys: Sequence[str] = ("category", "id"),
    order_by: Sequence[str] = ("ingestion_timestamp",),
    staging: str | None = None,
) -> None:
    """Write documents over the ones of equal key, add the others.

    Only table partitions that the batch touches are read and rewritten; the partition columns
    must be among ``keys``.  The batch is reduced to one row per key once, into the shared
    folder, and serves from there to find partitions, to match and to add.  The merged rows are
    staged too, so the table is never overwritten while it is being read.
    """
    partitions = _partition_columns(spark, table)
    if not set(partitions) <= set(keys):
        raise ValueError(f"partition columns {partitions} of {table} must be among {list(keys)}")
    with staged(latest(_conformed(df, table, partitions), keys, order_by), staging) as winners:
        existing = spark.table(table)
        if partitions:
            existing = _touched(winners, existing, partitions)
        with staged(merge(existing, winners, keys), staging) as merged:
            with _overwriting(spark, "dynamic"):
                _spread(merged, partitions).write.insertInto(table, overwrite=True)


def _file_system(spark: SparkSession, path: str) -> tuple:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _files_below(fs, folder) -> list:
    found, each = [], fs.listFiles(folder, True)
    while each.hasNext():
        found.append(each.next().getPath())
    return found


def finish_upserts(spark: SparkSession, path: str) -> int:
    """Complete the upserts of a folder that were cut off after their commit, and discard those before it.

    An upsert is committed when the list of the files it replaces is complete.  Completing it moves
    its new files in and deletes the replaced ones; every step may be repeated.
    """
    fs, folder = _file_system(spark, path)
    below = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    made = spark._jvm.org.apache.hadoop.fs.Path
    finished = 0
    for new in (p for p in below if p.getName().startswith("_upsert-")):
        replaced = made(folder, new.getName().replace("_upsert-", "_replaced-"))
        if fs.exists(made(replaced, "_SUCCESS")):
            for file in _files_below(fs, new):
                inner = file.toUri().getPath()[len(new.toUri().getPath()) + 1 :]
                if not file.getName().startswith(("_", ".")):
                    target = made(folder, inner)
                    fs.mkdirs(target.getParent())
                    if not fs.rename(file, target):
                        raise OSError(f"cannot move {file} to {target}")
            for row in spark.read.schema("path string").json(replaced.toString()).collect():
                fs.delete(made(row.path), False)
            finished += 1
        fs.delete(new, True)
        fs.delete(replaced, True)
    for left in (p for p in below if p.getName().startswith("_replaced-")):
        fs.delete(left, True)
    spark.catalog.refreshByPath(path)
    return finished


def upsert_files(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    partitions: Sequence[str] = (),
    staging: str | None = None,
) -> int:
    """Write rows over those of equal key in a folder of Parquet files, add the others.

    Only files that hold a key of the batch are rewritten, whatever the size of their partition: the
    batch is semi-joined to the keys of the files, read with the path of their file and narrowed by
    the least and greatest keys of the batch, so row groups outside them are skipped.  Returns how many
    files were replaced; their names pass through the driver.

    The new files are written beside the table, then the list of the replaced ones, then the new ones
    are moved in and the old ones deleted.  ``finish_upserts``, which every upsert runs first,
    completes what was cut off.  Readers may see both versions of a row between the last two
    steps.  One upsert at a time may work on a folder.
    """
    if not set(partitions) <= set(keys):
        raise ValueError(f"partition columns {list(partitions)} must be among {list(keys)}")
    finish_upserts(spark, path)
    schema = spark.read.parquet(path).schema
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    name = uuid.uuid4().hex
    with staged(latest(df.select(*columns), keys, order_by), staging) as winners:
        ends = [F.struct(F.min(k).alias("least"), F.max(k).alias("most"), F.count_if(F.col(k).isNull()).alias("nulls")).alias(k)
                for k in keys]
        bounds = winners.agg(*ends).first()
        table = spark.read.schema(schema).parquet(path)
        if all(b["least"] is None and not b["nulls"] for b in bounds):
            return 0
        near = table.select(*keys, F.col("_metadata.file_path").alias("_file"))
        for k, b in zip(keys, bounds):
            if not b["nulls"]:
                near = near.filter(F.col(k).between(F.lit(b["least"]), F.lit(b["most"])))
        wanted = winners.select(*[F.col(k).alias(f"_in_{k}") for k in keys])
        hit = near.join(wanted, same_values(near, wanted, keys), "left_semi").select("_file").distinct()
        old = sorted(r[0] for r in hit.collect())
        paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(o)).toString() for o in old]
        touched = spark.read.schema(schema).option("basePath", path).parquet(*paths) if old else table.limit(0)
        writer = _spread(merge(touched, winners, keys), partitions).write
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(f"{path}/_upsert-{name}")
        listed = spark.createDataFrame([(p,) for p in paths], "path string").coalesce(1)
        listed.write.json(f"{path}/_replaced-{name}")
    finish_upserts(spark, path)
    return len(old)


def jdbc_overwrite(df: DataFrame, jdbc: Mapping[str, str]) -> None:
    """Replace a database table, keeping its definition (keys, types, indexes) when it exists.

    ``jdbc`` has ``url`` and ``dbtable`` and may set any other option of the JDBC sink, such as
    ``numPartitions`` (the number of connections) and ``batchsize``.
    """
    options = {"truncate": "true", **jdbc}
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def dual_write(df: DataFrame, table: str, jdbc: Mapping[str, str] | None = None) -> None:
    """Full refresh of a table and of its serving copy.

    The serving copy is read from the table just written: the frame is evaluated once, and
    both copies carry the same load time.
    """
    overwrite_table(df, table)
    if jdbc is not None:
        jdbc_overwrite(df.sparkSession.table(table), jdbc)
