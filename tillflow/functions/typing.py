"""Text to typed columns. Unreadable text turns into NULL, never into an error."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from tillflow.schemas import COLUMN_ALIASES, MASTER_TYPES, SALES_TYPES


def typed_columns(types: Mapping[str, str]) -> list[str]:
    """One SQL expression per column, for ``selectExpr``."""
    return [
        name if kind == "string" else f"try_cast({name} AS {kind}) AS {name}"
        for name, kind in types.items()
    ]


def typed_sales(bronze: DataFrame) -> DataFrame:
    """The eight sale columns of bronze in their real types."""
    return bronze.selectExpr(*typed_columns(SALES_TYPES))


def typed_master(bronze: DataFrame, master: str, kept: Iterable[str] = ()) -> DataFrame:
    """The columns of one master that silver uses, in their real types, and those kept."""
    return with_current_names(bronze, master).selectExpr(
        *typed_columns(MASTER_TYPES[master]), *kept
    )


def with_current_names(df: DataFrame, feed: str) -> DataFrame:
    """Old column names replaced by the names in use."""
    aliases = COLUMN_ALIASES.get(feed)
    if not aliases:
        return df
    present = set(df.columns)
    renames = {
        old: new for old, new in aliases.items() if old in present and new not in present
    }
    return df.withColumnsRenamed(renames) if renames else df


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, in one projection."""
    return df.selectExpr(*[f"CAST(`{name}` AS STRING) AS `{name}`" for name in df.columns])
