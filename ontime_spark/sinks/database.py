"""Mart tables in a relational database that knows ``ON CONFLICT``, over JDBC.

Tasks write in parallel to a staging table of the batch's own; one transaction then merges it and
drops it. Repeating a batch finds or makes the same staging table and ends the same.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ontime_spark.schemas import MARTS
from ontime_spark.sinks.cached import cached
from ontime_spark.sinks.conform import conform


def create_table_statement(table: str) -> str:
    """DDL of a mart. Append-only tables number their rows and stamp them by themselves."""
    mart = MARTS[table]
    lines = [] if mart.keys else ["id SERIAL PRIMARY KEY"]
    for name, sql_type in mart.columns:
        lines.append(f"{name} {sql_type}" + (" DEFAULT NOW()" if name == mart.stamp else ""))
    if mart.keys:
        lines.append(f"PRIMARY KEY ({', '.join(mart.keys)})")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(lines)})"


def upsert_statements(table: str, staging: str) -> list[str]:
    """Merge ``staging`` into ``table`` and drop it. A table of keys alone keeps its rows."""
    mart = MARTS[table]
    columns = ", ".join(mart.names)
    values = [f"{n} = EXCLUDED.{n}" for n in mart.names if n not in mart.keys]
    action = f"UPDATE SET {', '.join(values)}" if values else "NOTHING"
    return [
        f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} "
        f"ON CONFLICT ({', '.join(mart.keys)}) DO {action}",
        f"DROP TABLE IF EXISTS {staging}",
    ]


BATCH_LOG = "written_batches"


def batch_log_statement() -> str:
    """DDL of the table that knows which batches append-only tables hold already."""
    return (
        f"CREATE TABLE IF NOT EXISTS {BATCH_LOG} (table_name VARCHAR(100), run VARCHAR(100), "
        "batch_id BIGINT, PRIMARY KEY (table_name, run, batch_id))"
    )


def append_statements(
    table: str, staging: str, columns: list[str], run: str, batch_id: int
) -> list[str]:
    """Add ``staging`` to ``table`` unless the log has the batch, log it, and drop ``staging``."""
    names = ", ".join(columns)
    batch = f"'{table}', '{run}', {int(batch_id)}"
    logged = f"SELECT 1 FROM {BATCH_LOG} WHERE (table_name, run, batch_id) = ({batch})"
    return [
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} WHERE NOT EXISTS ({logged})",
        f"INSERT INTO {BATCH_LOG} VALUES ({batch}) ON CONFLICT DO NOTHING",
        f"DROP TABLE IF EXISTS {staging}",
    ]


def run_statements(spark: SparkSession, jdbc: dict[str, str], statements: list[str]) -> None:
    """Statements in one transaction, from the driver."""
    jvm = spark.sparkContext._jvm
    if "driver" in jdbc:
        jvm.java.lang.Class.forName(jdbc["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(
        jdbc["url"], jdbc.get("user"), jdbc.get("password")
    )
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        connection.commit()
    finally:
        connection.close()


def create_tables(spark: SparkSession, jdbc: dict[str, str], *tables: str) -> None:
    run_statements(spark, jdbc, [create_table_statement(t) for t in tables or MARTS])


def staging_name(table: str, run: str, batch_id: int) -> str:
    """The table that a batch is written to first; the run's name becomes part of a statement."""
    if not re.fullmatch(r"\w+", run):
        raise ValueError(f"a run is named by letters, digits and underscores, not {run!r}")
    return f"{table}_stage_{run}_{batch_id}"


def upsert(
    df: DataFrame,
    jdbc: dict[str, str],
    table: str,
    batch_id: int = 0,
    run: str = "default",
    unique: bool = False,
) -> DataFrame | None:
    """Merge a batch into a keyed table; returns the report of rows it cannot take."""
    with cached(df):
        if df.isEmpty():
            return None
        good, report = conform(df, table, unique)
        staging = staging_name(table, run, batch_id)
        good.write.format("jdbc").options(dbtable=staging, **jdbc).mode("overwrite").save()
        run_statements(df.sparkSession, jdbc, upsert_statements(table, staging))
        return report


def append(
    df: DataFrame, jdbc: dict[str, str], table: str, batch_id: int = 0, run: str = "default"
) -> DataFrame | None:
    """Add a batch to an append-only table, once: a repeat of a logged batch adds nothing.

    The rows go to a staging table; one transaction adds them and logs the batch.
    """
    staging = staging_name(table, run, batch_id)
    with cached(df):
        if df.isEmpty():
            return None
        good, report = conform(df, table)
        stamp = MARTS[table].stamp
        if stamp and stamp not in df.columns:
            good = good.drop(stamp)
        good.write.format("jdbc").options(dbtable=staging, **jdbc).mode("overwrite").save()
        statements = append_statements(table, staging, good.columns, run, batch_id)
        run_statements(df.sparkSession, jdbc, [batch_log_statement(), *statements])
        return report
