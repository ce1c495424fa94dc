"""Audit columns of stored tables and the stamps on changed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tables whose name ends like this are temporary and carry no audit columns.
UNAUDITED_SUFFIXES = ("__dbt_tmp", "_dbt_backup")


def audit_columns(table: str) -> dict[str, str]:
    """Audit column names and types of a table."""
    return {
        f"{table}_crtd_id": "string",
        f"{table}_crtd_dt": "timestamp",
        f"{table}_updt_id": "string",
        f"{table}_updt_dt": "timestamp",
        f"{table}_table_id": "string",
    }


def is_audited(table: str) -> bool:
    return not table.endswith(UNAUDITED_SUFFIXES)


def created_values(table: str, user: Column | None, now: Column | None, row_id: Column | None) -> dict[str, Column]:
    """Audit values of a new row; ``row_id`` defaults to a random id."""
    return {
        f"{table}_crtd_id": user if user is not None else F.current_user(),
        f"{table}_crtd_dt": now if now is not None else F.current_timestamp(),
        f"{table}_updt_id": F.lit(None).cast("string"),
        f"{table}_updt_dt": F.lit(None).cast("timestamp"),
        f"{table}_table_id": row_id if row_id is not None else F.uuid(),
    }


def with_audit(
    df: DataFrame,
    table: str,
    user: Column | None = None,
    now: Column | None = None,
    row_id: Column | None = None,
) -> DataFrame:
    """Add the audit columns that are missing; temporary tables come back unchanged.

    Pass ``row_id`` (a hash of the natural key) where a rerun must give the same ids.
    """
    if not is_audited(table):
        return df
    values = created_values(table, user, now, row_id)
    return df.select("*", *[c.alias(n) for n, c in values.items() if n not in df.columns])
