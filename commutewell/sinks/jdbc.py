"""Warehouse writers over JDBC: full refresh and staged upsert.

Needs the database's driver on the class path; the upsert also needs a DB-API connection for the
one statement that runs inside the database.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import closing

from pyspark.sql import DataFrame

from commutewell.sources.jdbc import jdbc_options


def refresh_table(df: DataFrame, url: str, table: str, keep_constraints: bool = True, **extra: str) -> None:
    """Replace the rows of ``table``; with ``keep_constraints`` it is truncated, not dropped."""
    options = jdbc_options(url, table, truncate=str(keep_constraints).lower(), **extra)
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def upsert_statement(
    target: str, staging: str, columns: Iterable[str], keys: Iterable[str], update: Iterable[str]
) -> str:
    """SQL that inserts ``staging`` into ``target`` and updates rows with an equal key."""
    listed = ", ".join(columns)
    assigned = ", ".join(f"{c} = excluded.{c}" for c in update)
    action = f"UPDATE SET {assigned}" if assigned else "NOTHING"
    return (
        f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO {action}"
    )


def upsert_table(
    df: DataFrame,
    url: str,
    target: str,
    staging: str,
    keys: Iterable[str],
    update: Iterable[str],
    connect: Callable[[], object],
    **extra: str,
) -> None:
    """Stage ``df`` in parallel, then merge and drop the staging table in one transaction.

    Errors are passed on after a rollback.
    """
    refresh_table(df, url, staging, keep_constraints=False, **extra)
    with closing(connect()) as connection:
        try:
            with closing(connection.cursor()) as cursor:
                cursor.execute(upsert_statement(target, staging, df.columns, keys, update))
                cursor.execute(f"DROP TABLE {staging}")
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
