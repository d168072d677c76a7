"""Titles are attached to a top-k that is evaluated once."""

from pyspark.sql import functions as F

from pricescope.operators import ranked as rk


def _frames(spark):
    rows = spark.range(1000).selectExpr("concat('M', id) as market_ticker", "id * 7 % 1009 as score", "if(id % 9 = 0, null, id) as x")
    dim = spark.range(0, 1000, 2).selectExpr("concat('M', id) as market_ticker", "concat('title ', id) as title", "id as more")
    order = [F.col("score").desc(), F.col("market_ticker")]
    return rk.top(rows, 40, *order), dim, order


def test_rows_without_a_title_and_nulls_stay(spark):
    topk, dim, order = _frames(spark)
    got = rk.attach(topk, dim, "market_ticker", ["title"], order, ["market_ticker", "title", "score", "x"]).collect()
    want = sorted(((f"M{i}", f"title {i}" if i % 2 == 0 else None, i * 7 % 1009, None if i % 9 == 0 else i) for i in range(1000)),
                  key=lambda r: (-r[2], r[0]))[:40]
    assert [tuple(r) for r in got] == want


def test_the_top_k_is_evaluated_once(spark):
    topk, dim, order = _frames(spark)
    out = rk.attach(topk, dim, "market_ticker", ["title"], order, ["market_ticker", "title", "score", "x"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("TakeOrderedAndProject") == 1 and "ReusedExchange" in plan
