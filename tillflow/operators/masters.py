"""Master data: current rows, and joining them to sales without hot tasks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.sources.tables import planned_bytes

# Largest side that may be sent to every executor, as estimated by the planner.
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of one key that make it worth splitting.
HOT_ROWS = 5_000_000
# Keys a sketch follows, and the most it names.
TRACKED = 65_536
MOST_HOT = 10_000


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return planned_bytes(df) <= limit


def current_rows(master: DataFrame, key: str, latest_by: Iterable[str] = ()) -> DataFrame:
    """One row per key: the latest by ``latest_by``, ties by all columns.

    Keeps a master with repeated keys from multiplying sales. Copies of a key
    are combined before the shuffle. Rows without a key match no sale and go.
    """
    columns = master.columns
    order = [*latest_by, *[name for name in columns if name not in latest_by]]
    return (
        master.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.expr(f"max(struct({', '.join(order)})) AS _newest"))
        .selectExpr(*[f"_newest.{name}" for name in columns])
    )


def hot_keys(rows: DataFrame, key: str, min_rows: int = HOT_ROWS, tracked: int = TRACKED) -> DataFrame:
    """The keys with ``min_rows`` rows or more, and into how many parts to split each.

    Counted by a sketch of ``tracked`` keys per task, so sketches are shuffled and not
    keys. Its counts are off by up to 3.5 parts in ``tracked`` of all rows; a key that is
    short of ``min_rows`` by them may be missed and is then joined in one part. There is
    one such key at most for each ``min_rows`` rows. Write the list before joining with
    it: both sides of the join must see the same one.
    """
    most = F.call_function("approx_top_k", F.col(key), F.lit(min(tracked, MOST_HOT)), F.lit(tracked))
    found = rows.where(F.col(key).isNotNull()).agg(most.alias("_top")).select(F.inline("_top"))
    return found.where(F.col("count") >= min_rows).select(
        F.col("item").alias("_hot_key"), F.ceil(F.col("count") / min_rows).cast("int").alias("_parts"))


def attach(
    sales: DataFrame,
    master: DataFrame,
    key: str,
    columns: Mapping[str, str],
    on: str | None = None,
    spread_by: str = "transaction_id",
    hot: DataFrame | None = None,
    size_of: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
    found: str | None = None,
) -> DataFrame:
    """Left join of a master with unique keys; every sale stays, once.

    ``columns`` maps master columns to their names in the result; ``on`` is the
    sale column if it is not called ``key``; ``found`` names a column telling
    whether the master knows the key.

    A master the planner estimates within ``limit`` is broadcast. A larger one
    is joined by shuffle: sales without a key are spread over many tasks, and
    keys listed in ``hot`` (see ``hot_keys``) are split with the master row
    repeated per part. ``size_of`` is the table that has one row for each row of
    the master, for masters whose own plan hides their size behind lookups.
    """
    on = on or key
    taken = [f"{key} AS _key", *[f"{old} AS {new}" for old, new in columns.items()]]
    added = list(columns.values())
    if found:
        taken.append(f"true AS {found}")
        added.append(f"coalesce({found}, false) AS {found}")
    side = master.selectExpr(*taken)
    kept = sales.columns

    if fits_broadcast(side if size_of is None else size_of, limit):
        joined = sales.join(F.broadcast(side), F.expr(f"{on} = _key"), "left")
    else:
        left, right = _split_keys(sales, side, on, spread_by, hot)
        joined = left.join(right, F.expr(f"{on} = _key AND _slot = _part"), "left")
    return joined.selectExpr(*kept, *added)


def _split_keys(
    sales: DataFrame, side: DataFrame, on: str, spread_by: str, hot: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a second join column that divides keyless and hot rows."""
    # A row without a key finds no partner, so any slot will do.
    slot = f"CASE WHEN {on} IS NULL THEN xxhash64({spread_by})"
    right = side.where("_key IS NOT NULL")
    if hot is None:
        # An exploded part, unlike a constant, is not folded into a filter.
        return (
            sales.selectExpr("*", f"{slot} ELSE 0L END AS _slot"),
            right.selectExpr("*", "explode(array(0L)) AS _part"),
        )
    listed = F.broadcast(hot) if fits_broadcast(hot) else hot
    left = sales.join(listed, F.expr(f"{on} = _hot_key"), "left")
    right = right.join(listed, F.expr("_key = _hot_key"), "left")
    slot += f" WHEN _parts IS NOT NULL THEN pmod(xxhash64({spread_by}), _parts) ELSE 0L END"
    parts = "explode(sequence(0L, CAST(coalesce(_parts, 1) - 1 AS BIGINT))) AS _part"
    return (
        left.selectExpr(*sales.columns, f"{slot} AS _slot"),
        right.selectExpr(*side.columns, parts),
    )
