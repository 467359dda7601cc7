"""The thirteen raw feeds: where they lie, how they are read."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.accesslog import parse_access_log
from tillflow.functions.typing import all_text, with_current_names
from tillflow.schemas import COLUMN_ALIASES, CORRUPT, EXTRA, FEED_COLUMNS, feed_schema


# Numbers that parsing may have written otherwise than the line has them.
CHANGED = r"^(0|-?[0-9]+(\.[0-9]+([eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+))$"


class FeedError(ValueError):
    """A feed that cannot be landed; ``code`` tells why."""

    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


@dataclass(frozen=True)
class Feed:
    name: str
    folder: str
    kind: str
    dated: bool = False

    @property
    def suffix(self) -> str:
        return "log" if self.kind == "text" else self.kind


# Folder and format of each feed; dated feeds get one file a day.
FEEDS = {
    feed.name: feed
    for feed in (
        Feed("pos_transactions", "pos/transactions", "csv", dated=True),
        Feed("online_orders", "ecommerce", "json", dated=True),
        Feed("web_clickstream", "web/clickstream", "text", dated=True),
        Feed("customer_master", "crm", "json"),
        Feed("loyalty_members", "crm", "csv"),
        Feed("coupon_dispatches", "crm", "json"),
        Feed("product_master", "erp", "csv"),
        Feed("category_master", "erp", "csv"),
        Feed("supplier_master", "erp", "csv"),
        Feed("store_master", "erp", "csv"),
        Feed("inventory_balance", "erp", "parquet"),
        Feed("retail_calendar", "reference", "csv"),
        Feed("holiday_calendar", "reference", "csv"),
    )
}


def feed_path(feed: Feed, root: str, job_date: str | None = None) -> str:
    """The feed's file; a dated feed without a date gives all its days."""
    stem = f"{root.rstrip('/')}/{feed.folder}/{feed.name}"
    if feed.dated:
        stamp = "*" if job_date is None else date.fromisoformat(job_date).strftime("%Y%m%d")
        stem = f"{stem}_{stamp}"
    return f"{stem}.{feed.suffix}"


def date_in_path(path: Column) -> Column:
    """The job date a dated file carries in its name, as ``yyyy-MM-dd``."""
    digits = F.regexp_extract(path, r"_(\d{8})\.", 1)
    return F.date_format(F.try_to_timestamp(digits, F.lit("yyyyMMdd")), "yyyy-MM-dd")


def read_files(spark: SparkSession, feed: Feed, path: str) -> DataFrame:
    """The feed as text columns plus ``_source_file``, lazily.

    CSV columns go by the names in the header, which must be the same in all
    files read together. Short rows are padded with NULL and long ones cut, and
    ``_corrupt_record`` keeps such a row's whole text. JSON lines see ``json_fields``.
    """
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if feed.kind == "csv":
        reader = reader.option("header", True).option("encoding", "UTF-8")
        names = reader.option("inferSchema", False).csv(path).schema
        # Every file's own header is checked, as columns are read by position.
        files = reader.schema(with_corrupt(names)).option("enforceSchema", False).csv(path)
    elif feed.kind in ("json", "text"):
        files = reader.text(path)
    else:
        files = reader.parquet(path)
    return to_text_columns(files, feed)


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def json_fields(lines: DataFrame, feed: Feed) -> DataFrame:
    """The contract's fields of JSON lines (column ``value``) as the text they are in the file.

    A line that is no JSON object is kept in ``_corrupt_record``; fields that the
    contract does not name are kept as a JSON map in ``_extra_fields``. Blank
    lines hold nothing.
    """
    schema = feed_schema(feed.name)
    old = COLUMN_ALIASES.get(feed.name, {})
    schema = T.StructType([*schema.fields, *(T.StructField(n, T.StringType()) for n in old)])
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json("value", with_corrupt(schema), options)
    others = F.map_filter(
        F.from_json("value", T.MapType(T.StringType(), T.StringType())),
        lambda name, _: ~F.array_contains(known, name),
    )
    rows = lines.where(F.trim("value") != "").withColumns({"_parsed": parsed, "_others": others})
    fields = {f.name: _as_written(f.name, F.col("_parsed")[f.name]) for f in schema.fields}
    for before, now in old.items():
        fields[now] = F.coalesce(fields[now], fields.pop(before))
    kept = [name for name in lines.columns if name != "value"]
    return rows.select(
        *[column.alias(name) for name, column in fields.items()],
        F.col("_parsed")[CORRUPT].alias(CORRUPT),
        F.when(F.size("_others") > 0, F.to_json("_others")).alias(EXTRA),
        *kept,
    )


def _as_written(name: str, value: Column) -> Column:
    """A number as the line has it: parsing drops zeros at its end.

    It leaves whole numbers alone, other than a zero, which may have had a sign; so only for the other
    numbers is the line searched and text cast, which throws inside where it is none.
    """
    written = F.regexp_extract("value", f'"{name}"\\s*:\\s*(-?[0-9][0-9.eE+-]*)', 1)
    same = written.try_cast("double") == value.try_cast("double")
    return F.when(value.rlike(CHANGED), F.coalesce(F.when(same, written), value)).otherwise(value)


def to_text_columns(files: DataFrame, feed: Feed) -> DataFrame:
    """Text columns of a scanned feed; also used on streams."""
    source = F.col("_metadata.file_path").alias("_source_file")
    rows = files.select("*", source)
    if feed.kind == "text":
        return parse_access_log(rows)
    if feed.kind == "json":
        return json_fields(rows, feed)
    return with_current_names(all_text(rows), feed.name)


def require_columns(df: DataFrame, names: list[str], what: str) -> DataFrame:
    """``df`` itself, or an E003 error naming the columns it lacks."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise FeedError("E003", f"{what} lacks {', '.join(missing)}")
    return df


def open_feed(spark: SparkSession, feed: Feed, path: str) -> DataFrame:
    """As ``read_files``, but a missing or empty source is an E002 error."""
    try:
        rows = read_files(spark, feed, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FeedError("E002", f"{feed.name}: no file at {path}") from error
        raise
    if not rows.columns or rows.isEmpty():
        raise FeedError("E002", f"{feed.name}: no rows in {path}")
    return require_columns(rows, FEED_COLUMNS[feed.name], f"{feed.name} at {path}")
