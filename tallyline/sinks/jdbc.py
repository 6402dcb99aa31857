"""Database sinks.

Rows go from the tasks to the database; the driver only sends statements.  Connection
settings, credentials included, are the caller's options.  Rows are staged in a table of
a fresh name, so calls do not meet, and staging goes with the statement that uses it.
The target itself is never created or replaced by a write: its key, defaults and grants
stay.  Statements are in the dialect of ``ON CONFLICT`` databases.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Column types of the database for Spark's (fixed values).
_TYPES = {
    "string": "TEXT", "double": "DOUBLE PRECISION", "float": "REAL", "bigint": "BIGINT", "int": "INTEGER",
    "smallint": "SMALLINT", "tinyint": "SMALLINT", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMPTZ",
    "timestamp_ntz": "TIMESTAMP", "binary": "BYTEA",
}


def _write(df: DataFrame, url: str, table: str, mode: str, options: dict[str, str]) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(
        mode
    ).save()


def _staging(table: str) -> str:
    return f"{table}_{uuid.uuid4().hex[:12]}"


def jdbc_executor(spark: SparkSession, url: str, **options: str) -> Callable[[str], None]:
    """Sends one statement at a time over a connection of its own, from the driver."""

    def execute(statement: str) -> None:
        settings = spark._jvm.java.util.Properties()
        for key, value in options.items():
            settings.setProperty(key, value)
        connection = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            connection.createStatement().execute(statement)
        finally:
            connection.close()

    return execute


def table_statement(table: str, schema: T.StructType, keys: Sequence[str]) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with the schema's types and a primary key."""

    def column(f: T.StructField) -> str:
        name = f.dataType.simpleString()
        kind = name.replace("decimal", "NUMERIC") if name.startswith("decimal") else _TYPES[name]
        return f"{f.name} {kind}{' NOT NULL' if f.name in keys else ''}"

    columns = ", ".join(column(f) for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}, PRIMARY KEY ({', '.join(keys)}))"


def append_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    _write(df, url, table, "append", options)


def overwrite_jdbc(
    df: DataFrame, url: str, table: str, execute: Callable[[str], None], **options: str
) -> None:
    """Replaces the table's rows through a staging table, in one transaction.

    ``df`` may read the very table it replaces, so that stays untouched until the new
    rows are complete.  ``execute`` runs one text of statements in the database.
    """
    staging = _staging(table)
    _write(df, url, staging, "overwrite", options)
    execute(replace_statement(table, staging, df.columns))


def replace_statement(table: str, staging: str, columns: Sequence[str]) -> str:
    names = ", ".join(columns)
    return (
        f"BEGIN; DELETE FROM {table}; INSERT INTO {table} ({names}) SELECT {names} FROM {staging}; "
        f"DROP TABLE {staging}; COMMIT;"
    )


def upsert_statement(
    table: str, staging: str, columns: Sequence[str], keys: Sequence[str]
) -> str:
    """One ``INSERT … SELECT … ON CONFLICT`` over a staged batch."""
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    action = f"DO UPDATE SET {updates}" if updates else "DO NOTHING"
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) {action}"
    )


def delete_statement(table: str, staging: str, keys: Sequence[str]) -> str:
    """Removes the rows whose keys are staged."""
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return f"DELETE FROM {table} t USING {staging} s WHERE {match}"


def upsert_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str],
    execute: Callable[[str], None],
    removed: DataFrame | None = None,
    **options: str,
) -> None:
    """Keyed upsert: parallel write to a staging table, then one statement.

    ``removed`` holds keys to delete; they are staged the same way and go in the same
    transaction.  All of it is repeatable, so a failed call can simply run again.
    """
    staging, gone = _staging(table), _staging(table)
    _write(df, url, staging, "overwrite", options)
    statements = [upsert_statement(table, staging, df.columns, keys), f"DROP TABLE {staging}"]
    if removed is not None:
        _write(removed.select(*keys), url, gone, "overwrite", options)
        statements += [delete_statement(table, gone, keys), f"DROP TABLE {gone}"]
    execute(f"BEGIN; {'; '.join(statements)}; COMMIT;")
