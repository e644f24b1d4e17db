"""Generations of files, and counts that the saving job takes."""

import datetime
import json

import pytest

from tallyfield.operators import frontier, reports
from tallyfield.sources import products as tables


def test_generations_are_read_as_one_table(spark, tmp_path):
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    put("v1", [(1, "u1", 5, None)], "item_id int, url string, price int, gone string")
    put("v1", [(2, "u2", 6)], "item_id int, url string, price int")  # a file that lacks a column
    put("v2", [(3, "u3", "7.5", '["a"]', "2024-01-02 03:04:05", "3"), (4, "u4", "x", "", "never", "4000000000"), (5, "u5", None, "{bad", None, "1.0")], "item_id long, url string, price string, images string, crawled_at string, stock_qty string")
    put("v3", [(6, "u6", [("t", 1, "more")], ["i"], 9_000_000_000, True)], "item_id long, url string, variants array<struct<title:string,price:int,odd:string>>, images array<string>, stock_qty long, in_stock boolean")
    put("v4", [(7, "u7", ["x"], {"a": 1}, 2.0)], "item_id long, url string, name array<string>, specs map<string,int>, tags double")
    df = tables.read_generations(spark, str(tmp_path))
    assert df.schema == tables.PRODUCTS
    r = {x.item_id: x for x in df.collect()}
    assert [r[k].price for k in range(1, 6)] == [5.0, 6.0, 7.5, None, None] and [r[k].images for k in range(3, 7)] == [["a"], None, None, ["i"]]
    assert r[3].crawled_at == datetime.datetime(2024, 1, 2, 3, 4, 5) and r[4].crawled_at is None and (r[3].stock_qty, r[4].stock_qty, r[6].stock_qty) == (3, None, None)
    assert [(v.title, v.price, v.sku) for v in r[6].variants] == [("t", 1.0, None)] and r[6].in_stock == 1
    assert json.loads(r[7].name) == ["x"] and r[7].specs == {"a": "1"} and r[7].tags is None
    assert tables.read_generations(spark, f"{tmp_path}/none").collect() == []
    plan = df.filter("item_id = 3").select("url")._jdf.queryExecution().executedPlan().toString()
    assert "item_id" in plan and "images" not in plan


def jobs_of(spark, name, f):
    spark.sparkContext.setJobGroup(name, name)
    try:
        f()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_a_run_is_counted_while_it_is_saved(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("other", 5)], "source string, x int")
    sites, bad = (spark.createDataFrame([(x,) for x in names], "source string") for names in ("abc", "b"))
    got = reports.save_run(rows, f"{tmp_path}/r", sites, bad)
    assert sorted(map(tuple, got.collect())) == [("a", 2, False, False), ("b", 1, True, False), ("c", 0, False, True)]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, reports.run_summary(sites, rows, bad).collect()))
    assert spark.read.parquet(f"{tmp_path}/r").count() == 5
    with pytest.raises(reports.NothingSaved):
        reports.save_run(rows.filter("x > 9"), f"{tmp_path}/e", sites, bad)


def test_fetches_are_counted_while_they_are_saved(spark, tmp_path):
    rows = [("https://h/a", 200, "text/html", True), ("https://h/b", 500, "text/html", None), ("https://h/c", 200, "text/html", False), ("https://h/d", 200, "image/png", True)]
    df = spark.createDataFrame(rows, "url string, status int, content_type string, allowed boolean")
    assert jobs_of(spark, "save fetches", lambda: frontier.save_fetches(df, f"{tmp_path}/f")) == 1
    assert tuple(frontier.save_fetches(df, f"{tmp_path}/f").first()) == (1, 2, 1) == tuple(frontier.fetch_counts(df).first())
    assert [r.url for r in spark.read.parquet(f"{tmp_path}/f").collect()] == ["https://h/a"]
    assert tuple(frontier.save_fetches(df.filter("false"), f"{tmp_path}/g").first()) == (0, 0, 0)
