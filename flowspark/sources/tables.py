"""Reading source tables and keeping derived ones."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowspark import schemas
from flowspark.functions import day_index, marked_distinct, partition_day
from flowspark.functions.times import PARTITION_DAY, RECORDING_TIMES
from flowspark.sources.admission import CORRUPT


_CLUSTER = "_cluster"


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the declared columns, cast to the declared types; absent ones become null.

    Timestamps without a zone are taken as session time. A partition day, if
    `materialize` wrote one, is kept for pruning.
    """
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in StructType.fromDDL(ddl)
    ]
    return df.select(*columns, *partition_day(df))


def read_source(
    spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet", keep_corrupt: bool = False
) -> DataFrame:
    """A source table by its declared schema: from a path, or the catalog table of that name.

    JSON lines are read with the schema given, so nothing is inferred and nested records stay JSON text. A line that is no JSON, or has
    other types, is a row of nulls; with `keep_corrupt` such rows have the line as `_corrupt_record`: see `admit`.
    """
    ddl = schemas.SOURCES[name]
    if path is None:
        return conform(spark.table(name), ddl)
    if fmt == "json":
        reader = spark.read.schema(f"{ddl}, {CORRUPT} string" if keep_corrupt else ddl)
        return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return conform(spark.read.format(fmt).load(path), ddl)


def materialize(
    df: DataFrame,
    *,
    path: str | None = None,
    table: str | None = None,
    date_column: str | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: str | None = None,
    clusters: int = 32,
    bloom: Sequence[str] = (),
    distinct: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
) -> DataFrame:
    """Write a view once, to a path or a catalog table, and return it read back.

    With a `date_column`, the recording time, the data is partitioned by `partition_by` (such as `log_type`) and then by
    day, and look-backs prune the partitions. Days are cut from the instants, whatever the session's time zone. Rows are
    ordered by time within files, so that a bound of an hour skips most row groups of a day. Files are balanced by
    size, and a day that holds most of the data is split.

    `mode` is Spark's, or "replace days" for a path: partitions that `df` has rows for are overwritten, all others stay,
    so a day can be parsed again.

    With `cluster_by`, a column such as an address, rows are dealt to `clusters` groups of files by its hash, so what is equal in
    it lies in the files of one group a day; together with a Bloom filter on it (`bloom`, several columns) a reader that looks for
    one value skips the others. Without `cluster_by` such filters only help to find rare values.

    With `distinct` columns, rows that agree in all of them are written once, and the table says so: operators that
    would remove repeats themselves (`azure_flow_logs_join_vm_nics`) then don't.
    """
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")
    if date_column not in (None, *RECORDING_TIMES):
        raise ValueError(f"look-backs are on {RECORDING_TIMES}; partitioning by another time would not fit them")
    if mode == "replace days" and (path is None or date_column is None):
        raise ValueError("days are replaced in a path that is partitioned by a recording time")
    if distinct:
        if mode not in ("overwrite", "replace days") or mode == "replace days" and date_column not in distinct:
            raise ValueError("rows are distinct in a whole table, or in whole days by a time that is among the columns")
        df = marked_distinct(df.dropDuplicates([*distinct]), distinct)
    cut = [*partition_by, *([PARTITION_DAY] if date_column else [])]
    if date_column is not None:
        df = df.withColumn(PARTITION_DAY, day_index(F.col(date_column)))
    columns = df.columns
    if cut or cluster_by:
        dealt = [*cut]
        if cluster_by is not None:
            df = df.withColumn(_CLUSTER, F.pmod(F.xxhash64(cluster_by), F.lit(clusters)).cast("int"))
            dealt.append(_CLUSTER)
        df = df.hint("rebalance", *dealt) if cluster_by is None else df.repartition(clusters, *dealt)
        df = df.sortWithinPartitions(*dealt, *([date_column] if date_column else [])).select(*columns)
    writer = df.write.format(fmt).mode("overwrite" if mode == "replace days" else mode)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if cut:
        writer = writer.partitionBy(*cut)
    if mode == "replace days":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    spark = df.sparkSession
    if table is not None:
        writer.saveAsTable(table)
        return spark.table(table)
    writer.save(path)
    return spark.read.format(fmt).schema(df.schema).load(path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], expected: Iterable[Mapping[str, object]] = ()
) -> None:
    """Write partitions of a table at a path in place of what they held; others stay.

    Of the `expected` partitions those that `df` has no rows for are emptied.
    """
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = {}
    for values in expected:
        at = hadoop("/".join([path, *[f"{name}={values[name]}" for name in partition_by]]))
        if files.exists(at):
            before[at] = {f.getPath().getName() for f in files.listStatus(at)}
    ordered = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by)
    writer = ordered.write.mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    for at, names in before.items():
        if names and names <= {f.getPath().getName() for f in files.listStatus(at)}:
            files.delete(at, True)


def replace_days(df: DataFrame, path: str, days: Iterable[int] = ()) -> None:
    """Write days of a table, cut by its partition day, in place of what they held; of `days` those without rows are emptied."""
    replace_partitions(df, path, [PARTITION_DAY], [{PARTITION_DAY: day} for day in days])


def _shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def new_kept_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing else has."""
    return f"{_shared_folder(spark)}/kept-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Compute a view that is read more than once, and read it back from `path`, by default a new one in the shared folder.

    It is written as a table rather than checkpointed, so that readers still prune columns
    and know its size. Lost executors do not take it with them. It is removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = path or new_kept_path(spark)
    kept = materialize(df, path=path)
    remove_at_exit(spark, path)
    return kept


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have what was written at a path go with the driver's JVM at the latest, also when the session was stopped before."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)


def remove_kept(spark: SparkSession, path: str) -> None:
    """Remove a kept table; nothing built on it can be computed any more."""
    context = spark.sparkContext
    if context._jsc is not None:
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
