"""Exact top-k search by inner product with a pivot table.

Vectors become points of a metric space in which nearer means a larger inner
product: a candidate x gets one more coordinate, sqrt(M^2 - |x|^2) with M the
largest norm, a query q gets 0 there, and |q' - x'|^2 = |q|^2 + M^2 - 2 q.x. The
distances of every point to the pivots are computed once. By the triangle
inequality the largest difference of two points' distances to any pivot is a lower
bound of their distance, and so gives an upper bound of the score. A query's
candidates are evaluated in the order of these bounds, ``FIRST`` at a time, then
twice as many, and so on. Each stride raises the k-th best score; the search stops
exactly where no bound left reaches it.

Candidates and queries are dealt by hash into groups of bounded size; each pair
of a candidate group and a query group is one small search, and a query's results
are merged over its groups.

Pivots are taken farthest first from a sample of ``SAMPLE`` rows; they change the
work only, never the result.

Defined results: vectors that are null, or hold null or non-finite components, and
rows without id take no part; of rows with one id the least vector counts, so an
id is neither found twice nor found for itself; missing trailing components count
as zero; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.tables import map_arrow, settled, ship_code

PIVOTS = 32
SAMPLE = 1_024
FIRST = 256
BLOCK = 16
CANDIDATES = 8_192
QUERIES = 4_096


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of numbers as rows of ``width`` columns, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def raised(x: np.ndarray, largest: float) -> np.ndarray:
    """Candidates with the coordinate that lifts them to the sphere of the largest norm."""
    return np.column_stack([x, np.sqrt(np.maximum(0.0, largest - (x * x).sum(axis=1)))])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points * points).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(0.0, square))


def choose_pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Farthest first, from the point farthest from the mean."""
    if len(points) == 0:
        return points
    chosen = [int(np.argmax(((points - points.mean(axis=0)) ** 2).sum(axis=1)))]
    nearest = distances(points, points[chosen])[:, 0]
    while len(chosen) < min(count, len(points)) and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def whole_numbers(x: np.ndarray, largest: float) -> np.ndarray:
    """``x`` in the smallest type that holds its inner products with vectors of at most ``largest`` exactly."""
    limit = np.abs(x).max(initial=0) * largest * x.shape[1]
    return x.astype(np.float32 if limit < 2**24 else np.float64 if limit < 2**53 else np.int64)


def score_limits(far: np.ndarray, table: np.ndarray, square: np.ndarray, largest: float) -> np.ndarray:
    """Per query (row of ``far``) and candidate (column of ``table``) a score that it cannot exceed."""
    bound = np.zeros((len(far), table.shape[1]), np.float32)
    for query, pivot in zip(far.T, table):
        np.maximum(bound, np.abs(query[:, None] - pivot), out=bound)
    # Distances were rounded to single precision; scores are whole numbers.
    rounding = 4 * np.finfo(np.float32).eps * max(far.max(initial=0), table.max(initial=0))
    near = np.maximum(0.0, bound.astype(np.float64) - rounding)
    return 0.5 + (square[:, None] + largest - near * near) / 2


def best_first(ids: np.ndarray, x: np.ndarray, limit: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k candidates best for ``q``, which are evaluated in the order of their limits.

    Strides grow, so that few of them are made; after each the k-th best score rises,
    and the search stops where no further limit reaches it. A limit equal to that
    score is still evaluated, as its candidate may win by its id.
    """
    order = np.argsort(-limit)
    falling = -limit[order]
    names, scores = ids[:0], np.zeros(0, np.int64)
    at, stride = 0, FIRST
    while at < len(order):
        end = min(len(order), at + stride)
        if len(scores) == k:
            end = min(end, int(np.searchsorted(falling, -scores[-1], side="right")))
            if end <= at:
                break
        part = order[at:end]
        score = (np.take(x, part, axis=0) @ q).astype(np.int64)
        if len(scores) == k:
            good = score >= scores[-1]
            part, score = part[good], score[good]
        names, scores = np.concatenate([names, ids[part]]), np.concatenate([scores, score])
        top = np.lexsort((names, -scores))[:k]
        names, scores = names[top], scores[top]
        at, stride = end, 2 * stride
    return names, scores


def search(
    ids: np.ndarray, x: np.ndarray, table: np.ndarray,
    query_ids: np.ndarray, queries: np.ndarray, query_table: np.ndarray, largest: float, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best candidates here: query id, candidate id, score."""
    found = []
    pivots = np.ascontiguousarray(table.T, np.float32)
    values = whole_numbers(x, np.abs(queries).max(initial=0))
    own = {name: place for place, name in enumerate(ids.tolist())}
    for at in range(0, len(query_ids), BLOCK):
        part = queries[at:at + BLOCK]
        limits = score_limits(
            query_table[at:at + BLOCK].astype(np.float32), pivots, (part * part).sum(axis=1), largest)
        for query, q, limit in zip(query_ids[at:at + BLOCK].tolist(), part.astype(values.dtype), limits):
            place = own.get(query)
            # Its own row, one at most, is asked for and then left out.
            names, scores = best_first(ids, values, limit, q, k + (place is not None))
            if place is not None:
                other = names != query
                names, scores = names[other][:k], scores[other][:k]
            found.append((np.full(len(names), query), names, scores))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(column) for column in zip(*found))


def top_k(
    rows: DataFrame,
    k: int,
    is_query: Column,
    id: str = "vec_id",
    vector: Column | str = "embedding",
    pivots: int = PIVOTS,
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products, ties to the smaller id.

    ``vector`` has whole numbers as doubles; ``is_query`` is a condition on the
    column ``vec_id``.
    """
    spark = rows.sparkSession
    vector = F.col(vector) if isinstance(vector, str) else vector
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = settled(
        rows.select(F.col(id).cast("long").alias("vec_id"), vector.alias("vector"))
        .where(F.col("vec_id").isNotNull() & sound)
        .groupBy("vec_id").agg(F.min("vector").alias("vector")))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    count, asked, largest, width = known.agg(
        F.count("*"), F.count_if(is_query), F.coalesce(F.max(norm), F.lit(0.0)),
        F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    drawn = known.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    points = choose_pivots(raised(matrix(drawn["vector"], width), largest), pivots)

    def measure(batches):
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            flat = np.column_stack([x, np.zeros(len(x))])
            tables = [distances(raised(x, largest), points), distances(flat, points)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(list(t), pa.list_(pa.float64())) for t in tables)],
                names=["vec_id", "vector", "as_candidate", "as_query"])

    measured = map_arrow(
        known, measure,
        "vec_id bigint, vector array<double>, as_candidate array<double>, as_query array<double>")
    groups, asking = max(1, -(-count // candidates)), max(1, -(-asked // queries))
    hashed = F.xxhash64("vec_id")
    left = measured.select(
        F.pmod(hashed, F.lit(groups)).alias("c"), F.explode(F.expr(f"sequence(0L, {asking - 1}L)")).alias("q"),
        "vec_id", "vector", F.col("as_candidate").alias("far"))
    right = measured.where(is_query).select(
        F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("c"),
        F.pmod(hashed, F.lit(asking)).alias("q"), "vec_id", "vector", F.col("as_query").alias("far"))

    def pair(here: pa.Table, ask: pa.Table) -> pa.Table:
        far = len(points)
        result = search(
            here["vec_id"].to_numpy(), matrix(here["vector"], width), matrix(here["far"], far),
            ask["vec_id"].to_numpy(), matrix(ask["vector"], width), matrix(ask["far"], far), largest, k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), result)))

    ship_code(spark)
    found = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(
        pair, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
