"""Tables laid out for what is done with them: buckets for joins on a key, swaps for readers at work."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.sources.tables import PARTITION_COLUMN, _counted, _in_table_order, replace_partitions

#: Rows of a bucket: a task that sorts and joins two of them, with the columns of the feature view, holds some 600 MB.
BUCKET_ROWS = 2_000_000


def bucket_count(rows: int, least: int = 1) -> int:
    """A number of buckets that grows with the table, since a task sorts and joins a whole bucket."""
    return max(least, -(-rows // BUCKET_ROWS))


def create_bucketed_table(spark: SparkSession, name: str, schema: T.StructType, key: str, buckets: int, root: str) -> None:
    """S5 with every date cut into the same buckets of ``key``: one file for each bucket and date.

    Tables to be joined need the same number; ``bucket_count`` of the larger suits.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet PARTITIONED BY ({PARTITION_COLUMN}) "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{root}/{name}'"
    )


def replace_bucketed(spark: SparkSession, df: DataFrame, name: str, key: str, buckets: int, days: Iterable[dt.date]) -> dict[str, int]:
    """S9 for such a table. The one shuffle, by which a task writes one bucket, saves that of each later join.

    Rows that come from a table with these buckets, unchanged in the key, are not shuffled again.
    """
    return replace_partitions(spark, df.repartition(buckets, key), name, days)


def partition_place(spark: SparkSession, name: str, day: dt.date) -> str | None:
    """Where the catalog says a date's files are."""
    shown = spark.sql(f"SHOW PARTITIONS {name} PARTITION ({PARTITION_COLUMN} = DATE'{day}')")
    if shown.isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({PARTITION_COLUMN} = DATE'{day}')")
    return described.where("col_name = 'Location'").first()["data_type"]


def swap_partitions(spark: SparkSession, df: DataFrame, name: str, days: Iterable[dt.date]) -> dict[str, object]:
    """S9, S7 for tables that are read meanwhile: make the table hold exactly ``df`` for the given dates.

    The rows are written to a new folder beside the table, then the catalog points each date
    there, also a date without rows. A reader sees a date's old rows or its new ones, never
    none or a mixture; dates change one after another. A job that dies before leaves the
    table as it was. Old files stay for readers that planned with them; ``replaced`` names
    their folders, to be deleted when none is left. The catalog must last, as recovering
    partitions from the table's own folder would find the old ones.
    """
    days = sorted(set(days))
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    folder = f"{place.rstrip('/')}-swapped/{uuid.uuid4().hex}"
    wanted = _in_table_order(spark, df.where(F.col(PARTITION_COLUMN).isin(days)), name)
    out, seen = _counted(wanted)
    out.write.partitionBy(PARTITION_COLUMN).parquet(folder)
    replaced = []
    for day in days:
        spec, new = f"PARTITION ({PARTITION_COLUMN} = DATE'{day}')", f"{folder}/{PARTITION_COLUMN}={day}"
        path = spark._jvm.org.apache.hadoop.fs.Path(new)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
        old = partition_place(spark, name, day)
        if old is None:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION '{new}'")
        else:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{new}'")
            replaced.append(old)
    spark.catalog.refreshTable(name)
    return {"rows_written": int(seen.get["rows"]), "replaced": replaced}
