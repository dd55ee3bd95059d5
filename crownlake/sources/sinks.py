"""Sinks, catalogue registration and row audits.

Row counts are taken with ``DataFrame.observe`` on the write itself, so an
audited write is still one pass over the data (no trailing ``count()``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **extra: F.Column) -> tuple[DataFrame, Observation]:
    """Attach a row counter (and any extra aggregate) to ``df``; read it after the action."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in extra.items()]
    return df.observe(obs, *metrics), obs


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Cluster rows by the output partition columns before a partitioned write.

    Without it every task writes one file per partition value it holds
    (tasks x days files). ``repartition(col)`` would fix that but put a hot
    day into one task; the REBALANCE hint lets AQE split skewed partitions and
    coalesce small ones, so file sizes stay even either way."""
    return df.hint("rebalance", *partition_by) if partition_by else df


# Up to so many days, tasks of the usual size write files large enough without a shuffle by day.
FEW_DAYS = 31


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    audit: str | None = None,
    partition_overwrite: str | None = None,
    few_days: bool = False,
) -> dict:
    """Parquet write. With ``partition_by`` and ``partition_overwrite=
    "dynamic"`` only the partitions present in ``df`` are replaced; "static"
    replaces the whole table. ``few_days``: rows are not shuffled once more to bring
    days together; each task writes one file a day. Returns observed counts."""
    obs = None
    df = df if few_days else rebalanced(df, partition_by)
    if audit:
        # Observed after the rebalance exchange, i.e. in the writing stage.
        df, obs = observed(df, audit)
    writer = df.write.mode(mode)
    if partition_overwrite:
        writer = writer.option("partitionOverwriteMode", partition_overwrite)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return dict(obs.get) if obs is not None else {}


def write_sorted(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Files that each hold one range of ``by``, in order, and whose names follow the ranges."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def checked_order(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """The rows of a table with ``in_order``: not before the row ahead of it in its file, nor before any file ahead of its own.

    A file is one window: as much as the task that wrote it held.
    """
    key = F.struct(*by)
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.max(key).alias("_most"))
    ahead = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    limits = files.select("_file", F.max("_most").over(ahead).alias("_limit"))
    within = F.lag(key).over(Window.partitionBy("_file").orderBy("_row"))
    checked = rows.withColumn("_before", within).join(limits, "_file")
    fine = (F.col("_before").isNull() | (F.col("_before") <= key)) & (F.col("_limit").isNull() | (F.col("_limit") <= key))
    return checked.withColumn("in_order", fine).drop("_file", "_row", "_before", "_limit")


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ("ingestion_date",),
               mode: str = "overwrite", audit: str | None = None,
               metrics: dict[str, F.Column] | None = None, few_days: bool = False) -> dict:
    """Gzipped JSON sink partitioned by landing day (dynamic overwrite).

    ``metrics`` are extra aggregates observed on the same pass as the row count; ``few_days`` as in ``write_parquet``."""
    obs = None
    df = df if few_days else rebalanced(df, partition_by)
    if audit:
        # Observed after the rebalance exchange, i.e. in the writing stage.
        df, obs = observed(df, audit, **(metrics or {}))
    writer = df.write.mode(mode).option("compression", "gzip")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
    return dict(obs.get) if obs is not None else {}


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def register_table(
    spark: SparkSession,
    database: str,
    name: str,
    path: str,
    schema: str | None = None,
    partitioned_by: Sequence[str] = (),
) -> str:
    """``CREATE TABLE IF NOT EXISTS db.t USING PARQUET LOCATION 'path'``.

    A table over a partitioned folder knows no partitions until repaired
    (``repair_table``)."""
    ensure_database(spark, database)
    qualified = f"`{database}`.`{name}`"
    cols = f"({schema})" if schema else ""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified} {cols} USING PARQUET{parts} LOCATION '{path}'")
    return qualified


def repair_table(spark: SparkSession, qualified: str) -> None:
    """Discover partitions written since registration."""
    spark.sql(f"MSCK REPAIR TABLE {qualified}")


def add_partitions(spark: SparkSession, qualified: str, column: str, values: Sequence) -> None:
    """Make known new partitions visible without listing the whole table."""
    specs = " ".join(f"PARTITION (`{column}` = '{v}')" for v in values)
    if specs:
        spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS {specs}")


def catalogue_partitions(spark: SparkSession, qualified: str) -> set[str]:
    """Partition folder names (``day=…``) that the catalogue knows; one row per landing day."""
    return {row.partition for row in spark.sql(f"SHOW PARTITIONS {qualified}").collect()}


def _spec(part: str) -> str:
    key, value = part.split("=", 1)
    return f"PARTITION (`{key}` = '{value}')"


def _alter_partitions(spark: SparkSession, qualified: str, add: dict[str, str], drop: set[str]) -> None:
    if add:
        spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS " + " ".join(f"{_spec(p)} LOCATION '{at}'" for p, at in sorted(add.items())))
    if drop:
        spark.sql(f"ALTER TABLE {qualified} DROP IF EXISTS " + ", ".join(_spec(p) for p in sorted(drop)))


def point_partitions(spark: SparkSession, qualified: str, places: dict[str, str], whole: bool) -> None:
    """Point partitions at ``places`` (folder name -> location); with ``whole`` the table has no others."""
    have = catalogue_partitions(spark, qualified)
    _alter_partitions(spark, qualified, {p: at for p, at in places.items() if p not in have}, have - set(places) if whole else set())
    for part in have & set(places):
        spark.sql(f"ALTER TABLE {qualified} {_spec(part)} SET LOCATION '{places[part]}'")


def sync_partitions(spark: SparkSession, qualified: str, path: str) -> tuple[list[str], list[str]]:
    """S10, both ways: partition folders that the catalogue lacks are added, partitions without a folder dropped.

    Returns both lists. Unlike a plain repair, a day whose folder was removed goes from the catalogue too.
    """
    from crownlake.plans.publish import children

    have = catalogue_partitions(spark, qualified)
    found = {c for c in children(spark, path) if "=" in c}
    _alter_partitions(spark, qualified, {c: f"{path.rstrip('/')}/{c}" for c in found - have}, have - found)
    return sorted(found - have), sorted(have - found)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what it holds, on any Hadoop filesystem."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def list_databases(spark: SparkSession) -> list[str]:
    """``SHOW DATABASES``."""
    return [d.name for d in spark.catalog.listDatabases()]


def ddl_of(df: DataFrame, exclude: Sequence[str] = ()) -> str:
    """Column list for ``CREATE TABLE`` from a DataFrame schema."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in exclude)
