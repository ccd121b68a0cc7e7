"""JDBC report sinks.

``jdbc_append`` is Spark's JDBC writer in append mode (a second run with the
same keys fails on the database's key). ``jdbc_upsert`` makes the write
rerun-safe: Spark appends the rows to a staging table in parallel, then one
MERGE statement in the database moves them into the target by key, so the
database applies the whole batch atomically. Both raise on failure.

These need a reachable database; nothing in this repository starts one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from adtally.session import unique_name


def jdbc_append(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], num_partitions: int | None = None
) -> None:
    """Append rows over JDBC; ``num_partitions`` caps concurrent connections."""
    if num_partitions:
        df = df.coalesce(num_partitions)
    df.write.mode("append").jdbc(url, table, properties=dict(properties))


def with_null_key(df: DataFrame, keys: Sequence[str], placeholder: str) -> DataFrame:
    """Replace NULL in the string key columns by ``placeholder``."""
    string_keys = [f.name for f in df.schema.fields if f.name in keys and f.dataType.typeName() == "string"]
    return df.fillna(placeholder, subset=string_keys) if string_keys else df


def _quote(name: str, mark: str) -> str:
    return f"{mark}{name.replace(mark, mark + mark)}{mark}"


def merge_statement(
    target: str, staging: str, keys: Sequence[str], columns: Sequence[str], url: str = ""
) -> str:
    """The upsert from ``staging`` into ``target`` on ``keys``: ANSI MERGE, or
    for a ``jdbc:mysql:`` or ``jdbc:mariadb:`` url INSERT ... ON DUPLICATE KEY
    UPDATE. Columns are quoted, as Spark quotes those it creates; the table
    names are taken as given, as they may hold a schema."""
    mysql = url.startswith(("jdbc:mysql:", "jdbc:mariadb:"))
    mark = "`" if mysql else '"'
    q = {c: _quote(c, mark) for c in [*columns, *keys]}
    values = [c for c in columns if c not in keys]
    cols = ", ".join(q[c] for c in columns)
    vals = ", ".join(f"s.{q[c]}" for c in columns)
    if mysql:
        # with nothing to update a key is set to itself
        update = ", ".join(f"{q[c]} = s.{q[c]}" for c in values or keys[:1])
        return f"INSERT INTO {target} ({cols}) SELECT {vals} FROM {staging} s ON DUPLICATE KEY UPDATE {update}"
    on = " AND ".join(f"t.{q[k]} = s.{q[k]}" for k in keys)
    update = ", ".join(f"{q[c]} = s.{q[c]}" for c in values)
    matched = f"WHEN MATCHED THEN UPDATE SET {update} " if values else ""
    return (
        f"MERGE INTO {target} t USING {staging} s ON {on} "
        f"{matched}"
        f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})"
    )


def jdbc_upsert(
    df: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str],
    properties: Mapping[str, str],
    staging_table: str | None = None,
    merge_sql: str | None = None,
    null_key: str | None = None,
) -> None:
    """Stage with Spark's JDBC writer, then MERGE by ``keys`` in the database.

    The MERGE runs through the JDBC source's ``sessionInitStatement`` on a
    one-row read: a single task opens one connection and executes it, using
    only public Spark API. The statement is idempotent (re-merging the same
    staging rows changes nothing), so a retried task is harmless.

    Key columns must be non-NULL in a database key: ``null_key`` (e.g.
    ``"unknown"``) replaces NULL in string key columns before staging.
    The staging table has a name of its own for each run and is dropped after
    it, unless ``staging_table`` names one. ``merge_sql`` overrides the
    generated statement (it must then name ``staging_table``).
    """
    staging = staging_table or f"{table}_{unique_name('staging')}"
    if null_key is not None:
        df = with_null_key(df, keys, null_key)
    df.write.mode("overwrite").jdbc(url, staging, properties=dict(properties))
    statement = merge_sql or merge_statement(table, staging, list(keys), df.columns, url)
    _execute(df.sparkSession, url, properties, table, statement)
    if staging_table is None:
        _execute(df.sparkSession, url, properties, table, f"DROP TABLE {staging}")


def _execute(spark: SparkSession, url: str, properties: Mapping[str, str], table: str, statement: str) -> None:
    """Run one statement in the database when a one-row read opens its connection."""
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in properties.items():
        reader = reader.option(k, v)
    (
        reader.option("query", f"SELECT COUNT(*) AS n FROM {table}")
        .option("sessionInitStatement", statement)
        .load()
        .collect()
    )
