"""Results out to files, and a target database's tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def to_json(df: DataFrame, path: str) -> None:
    """JSON lines; a sorted frame is written as range-sorted files in order of name."""
    df.write.mode("overwrite").json(path)


def to_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def jdbc_upsert_sql(
    target: str,
    staging: str,
    key: Sequence[str],
    columns: Sequence[str],
    dialect: str = "postgres",
    version: Sequence[str] = (),
) -> list[str]:
    """Statements that bring a staging table's newest-per-key rows (with ``_op``) into ``target``.

    ``version`` names columns, among ``columns``, that order a row's changes: where the target keeps them, a late
    change neither overwrites nor deletes a newer row. A row that is deleted leaves no version behind.
    """
    names = ", ".join(columns)
    older = lambda old, new: f"({', '.join(f'{old}.{v}' for v in version)}) < ({', '.join(f'{new}.{v}' for v in version)})"
    rest = [c for c in columns if c not in key]
    if dialect == "postgres":
        match = " AND ".join(f"t.{k} = s.{k}" for k in key)
        sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in rest)
        return [
            f"DELETE FROM {target} t USING {staging} s WHERE {match} AND s._op = 'DELETE'"
            + (f" AND {older('t', 's')}" if version else ""),
            f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} WHERE _op <> 'DELETE' "
            f"ON CONFLICT ({', '.join(key)}) DO UPDATE SET {sets}" + (f" WHERE {older(target, 'EXCLUDED')}" if version else ""),
        ]
    if dialect == "merge":
        match = " AND ".join(f"t.{k} = s.{k}" for k in key)
        sets = ", ".join(f"{c} = s.{c}" for c in rest)
        values = ", ".join(f"s.{c}" for c in columns)
        # Spelled out: row values can't be compared everywhere.
        steps = [" AND ".join([f"t.{v} = s.{v}" for v in version[:i]] + [f"t.{c} < s.{c}"]) for i, c in enumerate(version)]
        newer = f" AND ({' OR '.join(steps)})" if version else ""
        return [
            f"MERGE INTO {target} t USING {staging} s ON {match} "
            f"WHEN MATCHED AND s._op = 'DELETE'{newer} THEN DELETE "
            f"WHEN MATCHED AND s._op <> 'DELETE'{newer} THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED AND s._op <> 'DELETE' THEN INSERT ({names}) VALUES ({values})"
        ]
    raise ValueError(f"unknown dialect {dialect}")


def jdbc_upsert(
    newest: DataFrame,
    url: str,
    target: str,
    key: Sequence[str],
    columns: Sequence[str],
    options: Mapping[str, str],
    writers: int = 8,
    dialect: str = "postgres",
) -> None:
    """Upsert newest-per-key rows (with ``_op``) into a database table made beforehand.

    ``writers`` connections fill a staging table; then the database merges it in one
    transaction, so a repeated batch leaves the same rows.
    """
    staging = f"{target}_staging"
    rows = newest.select(*columns, "_op")
    rows.repartition(writers).write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=staging, truncate="true", **dict(options)
    ).save()
    spark = newest.sparkSession
    properties = spark._jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in jdbc_upsert_sql(target, staging, key, columns, dialect):
            statement.executeUpdate(sql)
        connection.commit()
    finally:
        connection.close()
