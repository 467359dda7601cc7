"""A bounded, repeatable sample of labelled texts for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.tables import settled

LONGEST = 32_768


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    columns: list[str],
    per_class: int,
    allowed: Column,
    id: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
) -> tuple[list[tuple[bytes, tuple[int, ...]]], dict[tuple[int, ...], int]]:
    """At most ``per_class`` texts of each combination of label values, and each combination's count.

    Counts are over all labelled rows for which ``allowed`` (of the column
    ``doc_id``) holds. The sample is the rows with the least hash of the id among
    those that have a text of at most ``longest`` bytes. Where a combination has
    fewer than ``per_class`` of them, longer ones follow, by hash too, as long as
    it holds at most ``per_class * longest`` bytes; one text is taken in any case.
    A row with a null id or label is no labelled row; of contradicting labels of
    one id the least counts, of several texts the shortest.
    """
    known = labels.select(F.col(id).alias("doc_id"), *columns).dropna().groupBy("doc_id").agg(
        *[F.min(F.col(c).cast("int")).alias(c) for c in columns]).where(allowed)
    counts = {tuple(r[c] for c in columns): r["count"] for r in known.groupBy(*columns).count().collect()}
    texts = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    sizes = texts.groupBy("doc_id").agg(F.min(F.octet_length("text")).alias("size")).dropna()
    sized = settled(known.join(sizes, "doc_id"))
    chosen = []
    for values in sorted(counts):
        part = sized
        for column, value in zip(columns, values):
            part = part.where(F.col(column) == value)
        held = 0
        for row in part.orderBy(F.col("size") > longest, F.xxhash64("doc_id"), "doc_id").limit(per_class).collect():
            if held == 0 or held + row["size"] <= per_class * longest:
                held += row["size"]
                chosen.append(row)
    if not chosen:
        return [], counts
    picked = docs.sparkSession.createDataFrame(chosen, sized.schema)
    rows = texts.join(F.broadcast(picked), "doc_id").where(F.octet_length("text") == F.col("size")).groupBy(
        "doc_id", *columns).agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda row: row["doc_id"])
    return [(row["text"].encode(), tuple(row[c] for c in columns)) for row in rows], counts


def crc_fold(column: str, folds: int = 3) -> Column:
    """CRC-32 of the value as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds
