"""Cleansing of text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def standardise(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Upper-case and trim all descriptive text; identifiers stay as they are."""
    skipped = set(skip)

    def upper(field: T.StructField) -> str:
        name = field.name
        if not is_text(field) or name.endswith("_id") or name in skipped:
            return f"`{name}`"
        return f"trim(upper(`{name}`)) AS `{name}`"

    return df.selectExpr(*[upper(field) for field in df.schema.fields])


def without_null_text(name: str) -> str:
    """SQL for trimmed text; blank text and the word NULL in any case are missing.

    Only text of the word's length is put in upper case to be compared with it.
    """
    text = f"trim(`{name}`)"
    return f"CASE WHEN octet_length({text}) = 4 AND upper({text}) = 'NULL' THEN NULL WHEN {text} <> '' THEN {text} END"


def cleanse(
    df: DataFrame, emails: Iterable[str] = ("email",), phones: Iterable[str] = ("phone",)
) -> DataFrame:
    """Trim, read NULL words as NULL, lower-case e-mails, drop phone hyphens."""
    emails, phones = set(emails), set(phones)

    def clean(field: T.StructField) -> str:
        name = field.name
        if not is_text(field):
            return f"`{name}`"
        value = without_null_text(name)
        if name in emails:
            value = f"lower({value})"
        if name in phones:
            value = f"replace({value}, '-', '')"
        return f"{value} AS `{name}`"

    return df.selectExpr(*[clean(field) for field in df.schema.fields])
