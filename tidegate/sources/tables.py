"""Partitioned parquet tables in the session catalog."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import schemas
from tidegate.config import JobConfig

PARTITION_COLUMN = "scoring_date"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    root: str | None = None,
    partitioned: bool = True,
) -> None:
    """Create if absent, under ``root`` when given (an external table)."""
    place = f"LOCATION '{root}/{name}'" if root else ""
    by = f"PARTITIONED BY ({PARTITION_COLUMN})" if partitioned else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet {by} {place}")


def attach_partitions(spark: SparkSession, name: str) -> None:
    """Register partitions already on disk, for a session without a lasting catalog."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def create_tables(spark: SparkSession, cfg: JobConfig) -> None:
    for name, schema, partitioned in (
        (cfg.features_table, schemas.FEATURES, True),
        (cfg.predictions_table, schemas.PREDICTIONS, True),
        (cfg.ledger_table, schemas.RUN_LEDGER, False),
        (cfg.metrics_table, schemas.RUN_METRICS, False),
        (cfg.logs_table, schemas.RUN_LOGS, False),
        (cfg.registry_table, schemas.MODEL_REGISTRY, False),
    ):
        create_table(spark, name, schema, cfg.table_root, partitioned)


def partition(df: DataFrame, day: dt.date) -> DataFrame:
    """S3: one logical date, pruned to one partition directory."""
    return df.where(F.col(PARTITION_COLUMN) == F.lit(day))


def partitions(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """A window of logical dates, both ends included."""
    return df.where(F.col(PARTITION_COLUMN).between(F.lit(first), F.lit(last)))


def is_populated(df: DataFrame, day: dt.date) -> bool:
    return not partition(df, day).select(PARTITION_COLUMN).isEmpty()


def clustered(df: DataFrame) -> DataFrame:
    """Layout before a partitioned write: few files per date, sorted by vendor.

    REBALANCE lets adaptive execution split a large (date, vendor) group over
    several tasks and merge small ones; a plain repartition by date would put a
    whole date into one task.
    """
    return df.hint("rebalance", PARTITION_COLUMN, "vendor_id").sortWithinPartitions(
        PARTITION_COLUMN, "vendor_id"
    )


def _in_table_order(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.table(name).schema])


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """``insertInto`` ignores the writer option of this name, so the conf is scoped."""
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def _counted(df: DataFrame, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Rows written, counted by the write itself.

    The observation sits above every shuffle, in the stage that writes: result
    tasks report once even when executors are lost and map stages re-run.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


def append_rows(spark: SparkSession, df: DataFrame, name: str) -> int:
    out, seen = _counted(_in_table_order(spark, df, name))
    out.write.mode("append").insertInto(name)
    return int(seen.get["rows"])


def replace_table(spark: SparkSession, df: DataFrame, name: str) -> int:
    """Make a date-partitioned table hold exactly ``df``.

    A static overwrite removes the old files before it writes. This one swaps each date
    when the job commits, so an error at any stage keeps the old rows, and then empties
    the dates that no row came for.
    """
    held = [r[PARTITION_COLUMN] for r in spark.table(name).select(PARTITION_COLUMN).distinct().collect()]
    out, seen = _counted(clustered(_in_table_order(spark, df, name)), F.collect_set(PARTITION_COLUMN).alias("dates"))
    with _overwrite_mode(spark, "dynamic"):
        out.write.mode("overwrite").insertInto(name)
    arrived = set(seen.get["dates"])
    for day in held:
        if day not in arrived:
            clear_partition(spark, name, day)
    return int(seen.get["rows"])


def clear_partition(spark: SparkSession, name: str, day: dt.date) -> None:
    """Empty one partition: a static overwrite from a relation with no rows."""
    columns = [f for f in spark.table(name).schema if f.name != PARTITION_COLUMN]
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in columns)
    spark.sql(
        f"INSERT OVERWRITE {name} PARTITION ({PARTITION_COLUMN} = DATE'{day.isoformat()}') "
        f"SELECT {nothing} WHERE false"
    )


def partition_counts(df: DataFrame, days: Iterable[dt.date]) -> dict[dt.date, int]:
    """Row count per requested date; one small row per date reaches the driver."""
    days = list(days)
    rows = df.where(F.col(PARTITION_COLUMN).isin(days)).groupBy(PARTITION_COLUMN).count().collect()
    found = {r[PARTITION_COLUMN]: int(r["count"]) for r in rows}
    return {day: found.get(day, 0) for day in days}


def replace_partitions(spark: SparkSession, df: DataFrame, name: str, days: Iterable[dt.date]) -> dict[str, int]:
    """Make the table hold exactly ``df`` for the given dates.

    A dynamic overwrite swaps a partition only when the job commits, so a crash
    keeps the old rows; but it leaves a date alone when no row arrives for it.
    Those dates are emptied afterwards, by a write that cannot half-fail.
    """
    days = list(days)
    removed = partition_counts(spark.table(name), days)
    wanted = df.where(F.col(PARTITION_COLUMN).isin(days))
    out, seen = _counted(
        _in_table_order(spark, wanted, name), F.collect_set(PARTITION_COLUMN).alias("dates")
    )
    with _overwrite_mode(spark, "dynamic"):
        out.write.mode("overwrite").insertInto(name)
    arrived = set(seen.get["dates"])
    for day in days:
        if removed[day] and day not in arrived:
            clear_partition(spark, name, day)
    return {"rows_written": int(seen.get["rows"]), "rows_removed": sum(removed.values())}
