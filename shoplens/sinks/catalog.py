"""Catalog tables (S1, S3, S4).  Managed tables in the session catalog,
written in Parquet; bucketing is available for tables that later jobs join or
aggregate on the same key (the join then needs no shuffle on that side)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def from_rows(spark: SparkSession, rows: Iterable, schema) -> DataFrame:
    """S3: a small fixed dimension (e.g. a city list) as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)


#: A version's table is the name, this, the time in ms and eight hex digits.
_VERSION = "__v_"


def _version(name: str) -> str:
    return f"{name}{_VERSION}{time.time_ns() // 1_000_000:014d}_{uuid.uuid4().hex[:8]}"



def replace_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    sort_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    keep: int = 2,
) -> str:
    """Write ``df`` as a new table and point the view ``name`` at it.

    Replacing a view's definition is one catalog operation, so readers meet
    the old rows or the new ones, never a missing table; a failure before it
    leaves the old table in place, and ``df`` may read it.  The ``keep`` newest
    versions stay, for readers that planned on them.  A plain table of that
    name, from before there were versions, becomes the first version."""
    spark = df.sparkSession
    version = _version(name)
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(int(n), *cols)
        if sort_by:
            w = w.sortBy(*sort_by)
    w.saveAsTable(version)
    facts = _facts(spark, name)
    if facts and facts.get("Type") != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}{_VERSION}{0:014d}_{uuid.uuid4().hex[:8]}")
    _point(spark, name, version)
    # what the view showed until now counts as the newest of the old ones
    before = facts.get("View Text", "").rpartition(" ")[2]
    old = sorted((v for v in versions(spark, name) if v != version), key=lambda v: (v == before, v))
    for v in old[: max(0, len(old) - (keep - 1))]:
        spark.sql(f"DROP TABLE IF EXISTS {v}")
    return version


def _facts(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog tells of a table or view; empty where there is none."""
    if not spark.catalog.tableExists(name):
        return {}
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _point(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")


def versions(spark: SparkSession, name: str) -> list[str]:
    """The tables behind ``name``, oldest first."""
    database, _, short = name.rpartition(".")
    found = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{short}{_VERSION}*'").collect()
    prefix = f"{database}." if database else ""
    return sorted(f"{prefix}{r.tableName}" for r in found)


def read_table(spark: SparkSession, name: str, schema=None) -> DataFrame:
    """S1 + P12: scan a catalog table, optionally enforcing a declared schema."""
    df = spark.table(name)
    if schema is not None:
        from shoplens.sources.schemas import enforce

        df = enforce(df, schema)
    return df
