import numpy as np

from tillflow.operators.distributions import field_sketches, merged_sketches, quantile, shifts


def test_quantiles_shifts_and_merges(spark):
    rng = np.random.default_rng(1)
    rows = [(day, float(v) if v < 130 else None, 1) for day in range(4)
            for v in rng.normal(100 if day != 2 else 140, 10, 4_000)]
    df = spark.createDataFrame(rows, "day INT, price DOUBLE, units INT")
    found = field_sketches(df, ["price", "units"], "day").cache()
    assert found.count() == 8
    for r in found.where("field = 'price'").withColumns({"m": quantile(0.5), "p99": quantile(0.99)}).collect():
        values = np.array([v for day, v, _ in rows if day == r.day and v is not None])
        assert (r.n, r.nulls) == (len(values), 4_000 - len(values))
        assert abs((values <= r.m).mean() - 0.5) < 0.02 and abs((values <= r.p99).mean() - 0.99) < 0.02
    judged = {(r.field, r.day): r.shifted for r in shifts(found, "day").collect()}
    assert {k for k, v in judged.items() if v} == {("price", 2), ("price", 3)}
    whole = merged_sketches(found).where("field = 'price'").withColumn("m", quantile(0.5)).first()
    values = np.array([v for _, v, _ in rows if v is not None])
    assert whole.n == len(values) and abs((values <= whole.m).mean() - 0.5) < 0.02
    none = field_sketches(df.selectExpr("day", "CAST(NULL AS DOUBLE) AS price"), ["price"], "day")
    assert {(r.n, r.nulls, r.distance, r.shifted) for r in shifts(none, "day").collect()} == {(0, 4_000, None, False)}
    assert none.select(quantile(0.5).alias("q")).first().q is None
    assert field_sketches(df.where("false"), ["price"], "day").isEmpty()
