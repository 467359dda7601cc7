"""Sales with the attributes of their masters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tillflow.operators.masters import BROADCAST_BYTES, attach, fits_broadcast

# Per step: the master, its key, the sale column, and the columns taken over.
STEPS = (
    ("product_master", "product_id", "product_id",
     {"product_name": "product_name", "category_id": "category_id"}),
    ("category_master", "category_id", "category_id",
     {"category_name": "category_name"}),
    ("customer_master", "customer_id", "customer_id",
     {"customer_name": "customer_name"}),
    ("store_master", "store_id", "store_id",
     {"store_name": "store_name", "region": "store_region"}),
    ("retail_calendar", "date", "transaction_date",
     {"fiscal_year": "fiscal_year", "is_retail_peak": "is_retail_peak"}),
)
# A sale that names a key these masters do not know is kept and flagged.
CHECKED = ("product_master", "customer_master", "store_master")


def enrich(
    sales: DataFrame,
    masters: Mapping[str, DataFrame],
    hot: Mapping[str, DataFrame] | None = None,
    sizes: Mapping[str, DataFrame] | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left joins with the masters given; ``missing_masters`` names unknown keys.

    Masters must have unique keys (see ``current_rows``). ``hot`` and ``sizes``
    hold the arguments of ``attach`` per master. A missing master leaves out its
    columns; a guest sale (no customer) is not flagged.
    """
    hot, sizes = hot or {}, sizes or {}
    steps = [step for step in STEPS if step[0] in masters]
    known, taken, order = {*sales.columns}, [], list(sales.columns)
    for master, key, on, columns in steps:
        if on in known:
            known.update(columns.values())
            taken.append((master, key, on, columns))
            order += columns.values()
    # Masters that are broadcast come last, so that what they add is not shuffled for the others.
    large = [master for master, *_ in taken if not fits_broadcast(sizes.get(master, masters[master]), limit)]
    flags: dict[str, str] = {}
    for master, key, on, columns in sorted(taken, key=lambda step: step[0] not in large or step[2] not in sales.columns):
        found = f"_has_{master}" if master in CHECKED else None
        sales = attach(
            sales, masters[master], key, columns,
            on=on, hot=hot.get(master), size_of=sizes.get(master), limit=limit, found=found,
        )
        if found:
            flags[found] = f"CASE WHEN NOT {found} AND {on} IS NOT NULL THEN 'E006:{on}' END"
    if not flags:
        return sales.select(*order)
    # The warnings are in the order of the steps.
    listed = [flags[f"_has_{master}"] for master, *_ in taken if master in CHECKED]
    return sales.selectExpr(*order, f"array_compact(array({', '.join(listed)})) AS missing_masters")
