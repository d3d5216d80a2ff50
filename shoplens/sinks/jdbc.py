"""Relational result tables over JDBC.

Rows go from the executors into a *staging* table, one connection and one
transaction per partition, each row with the run, its partition and its number
in it; then one statement moves them into the target.  A task or a job that is
tried again may put rows into the staging table twice, but under the same
numbers, and the statement takes one of each; a run that is published again adds
nothing, because its id is already in the log table.  So the target has all
rows of a run once, or none.

``max_connections`` bounds the database's load by dealing the rows out to that
many partitions; what is dealt out is checkpointed, so a row keeps its number
whatever is computed again.  Unlike the reference's statement runner, failures
are not swallowed: a failed task fails the job (K17).  The JDBC driver jar must
be on the cluster's classpath.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import checkpoint_root

#: Columns that the staging table has before the target's.
RUN, PART, ROW = "run_id", "part_no", "row_no"
STAGING_SUFFIX, LOG_SUFFIX = "_staging", "_published"


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    batchsize: int = 1000,
    isolation_level: str = "READ_COMMITTED",
    extra: Mapping | None = None,
) -> dict[str, str]:
    opts = {
        "url": url,
        "dbtable": table,
        "batchsize": str(int(batchsize)),
        "isolationLevel": isolation_level,
    }
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def numbered(df: DataFrame, run: str, max_connections: int | None = 10) -> DataFrame:
    """``df`` with the run, the partition and the row's number in it, the same
    however often a partition is computed again."""
    checkpoint_root(df.sparkSession)  # the shared folder must be configured
    if max_connections:  # a shuffle, so that the stage before keeps its own parallelism
        df = df.repartition(int(max_connections))
    low = (1 << 33) - 1  # monotonically_increasing_id: partition above, row below
    return df.checkpoint().select(
        F.lit(run).alias(RUN),
        F.spark_partition_id().alias(PART),
        F.monotonically_increasing_id().bitwiseAND(F.lit(low)).alias(ROW),
        "*",
    )


def publish_statements(table: str, columns: Sequence[str], run: str) -> list[tuple[str, list[str]]]:
    """(SQL, parameters) that move a run from the staging table into the
    target, in one transaction: the log row, whose key refuses a run that is
    there; the rows, one of each number; and the staging rows' removal."""
    names = ", ".join(columns)
    staging, log = table + STAGING_SUFFIX, table + LOG_SUFFIX
    return [
        (f"INSERT INTO {log} ({RUN}) VALUES (?)", [run]),
        (
            f"INSERT INTO {table} ({names}) SELECT {names} FROM ("
            f"SELECT s.*, ROW_NUMBER() OVER (PARTITION BY {PART}, {ROW} ORDER BY {ROW}) AS copy_no "
            f"FROM {staging} s WHERE {RUN} = ?) t WHERE copy_no = 1",
            [run],
        ),
        (f"DELETE FROM {staging} WHERE {RUN} = ?", [run]),
    ]


def setup_statements(table: str, staging_columns: str, log_key: str = "VARCHAR(64)") -> list[str]:
    """Tables that ``append`` needs beside the target; ``staging_columns``: the
    target's columns in the database's own types."""
    return [
        f"CREATE TABLE {table + LOG_SUFFIX} ({RUN} {log_key} PRIMARY KEY)",
        f"CREATE TABLE {table + STAGING_SUFFIX} ({RUN} {log_key}, {PART} INT, {ROW} BIGINT, {staging_columns})",
    ]


class Connection:
    """Statements on one JDBC connection of the driver, in one transaction."""

    def __init__(self, spark: SparkSession, options: Mapping[str, str]):
        sc = spark.sparkContext
        jvm = sc._jvm
        properties = jvm.java.util.Properties()
        for key in ("user", "password"):
            if key in options:
                properties.setProperty(key, options[key])
        if options.get("driver"):  # from the session's jars, which the driver manager does not look into
            loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
            made = loader.loadClass(options["driver"]).getDeclaredConstructor(sc._gateway.new_array(jvm.java.lang.Class, 0))
            driver = made.newInstance(sc._gateway.new_array(jvm.java.lang.Object, 0))
        else:
            driver = jvm.java.sql.DriverManager.getDriver(options["url"])
        self.connection = driver.connect(options["url"], properties)
        if self.connection is None:
            raise ValueError(f"{options['driver']} does not take {options['url']}")

    def count(self, sql: str, parameters: Sequence[str]) -> int:
        statement = self._prepared(sql, parameters)
        try:
            rows = statement.executeQuery()
            rows.next()
            return int(rows.getLong(1))
        finally:
            statement.close()

    def _prepared(self, sql: str, parameters: Sequence[str]):
        statement = self.connection.prepareStatement(sql)
        for i, value in enumerate(parameters, 1):
            statement.setString(i, value)
        return statement

    def run(self, statements: Sequence[tuple[str, Sequence[str]]]) -> None:
        """All statements, or none."""
        self.connection.setAutoCommit(False)
        try:
            for sql, parameters in statements:
                statement = self._prepared(sql, parameters)
                try:
                    statement.executeUpdate()
                finally:
                    statement.close()
            self.connection.commit()
        except Exception:
            self.connection.rollback()
            raise

    def close(self) -> None:
        self.connection.close()


def publish(connection, table: str, columns: Sequence[str], run: str) -> bool:
    """Move a staged run into the target; False if it was there already."""
    if connection.count(f"SELECT COUNT(*) FROM {table + LOG_SUFFIX} WHERE {RUN} = ?", [run]):
        return False
    connection.run(publish_statements(table, columns, run))
    return True


def append(df: DataFrame, max_connections: int | None = 10, run: str | None = None, connect=Connection, **options) -> str:
    """Append ``df`` to the table (columns matched by name) and return
    the run's id.  A caller that tries a whole job again passes the same
    ``run``: rows that it already published are not added again."""
    run = run or uuid.uuid4().hex
    opts = jdbc_options(**options)
    connection = connect(df.sparkSession, opts)
    try:
        table = opts["dbtable"]
        if not connection.count(f"SELECT COUNT(*) FROM {table + LOG_SUFFIX} WHERE {RUN} = ?", [run]):
            stage_rows(numbered(df, run, max_connections), opts)
            publish(connection, table, df.columns, run)
    finally:
        connection.close()
    return run


def stage_rows(rows: DataFrame, opts: Mapping[str, str]) -> None:
    """Numbered rows into the target's staging table."""
    rows.write.format("jdbc").options(**{**opts, "dbtable": opts["dbtable"] + STAGING_SUFFIX}).mode("append").save()


def insert_row(spark: SparkSession, row: Sequence, schema, **options) -> str:
    """A single row, through the same writer."""
    return append(spark.createDataFrame([tuple(row)], schema), max_connections=1, **options)


def read(spark: SparkSession, **options):
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()
