"""Work that grows with the tables and no faster."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows


@pytest.fixture
def small_retail(spark, lake_dir):
    """Test tables of 60 lines."""
    from tidemart.testbed.bindings import SCHEMAS, Retail
    day = "timestamp_ntz '2020-01-01' + make_dt_interval(cast(id AS int))"
    made = {
        "nation": spark.range(2).selectExpr("cast(id AS int) n_nationkey",
                                            "concat('NATION_', id) n_name", "0 n_regionkey"),
        "region": spark.range(1).selectExpr("cast(id AS int) r_regionkey", "'R' r_name"),
        "customer": spark.range(5).selectExpr(
            "id c_custkey", "concat('c', id) c_name", "cast(id % 2 AS int) c_nationkey",
            "cast(id AS double) c_acctbal", "'M' c_mktsegment"),
        "supplier": spark.range(3).selectExpr("id s_suppkey", "concat('s', id) s_name",
                                              "cast(id % 2 AS int) s_nationkey", "1d s_acctbal"),
        "part": spark.range(4).selectExpr("id p_partkey", "'p' p_name", "'b' p_brand",
                                          "'PROMO' p_type", "3 p_size", "2.5d p_retailprice"),
        "orders": spark.range(20).selectExpr(
            "id o_orderkey", "id % 5 o_custkey", "'F' o_orderstatus", "1d o_totalprice",
            f"{day} o_orderdate", "'5-LOW' o_orderpriority"),
        "lineitem": spark.range(60).selectExpr(
            "id % 20 l_orderkey", "id % 4 l_partkey", "id % 3 l_suppkey",
            "cast(id / 20 AS int) l_linenumber", "1d l_quantity", "cast(id AS double) "
            "l_extendedprice", "0d l_discount", "0.05d l_tax", "'N' l_returnflag",
            "'O' l_linestatus", f"{day} l_shipdate"),
        "events": spark.range(40).selectExpr(
            "id event_id", f"{day} ts", "id user_id", "if(id % 2 = 0, 'view', 'click') "
            "event_type", "2d value", "'text' props"),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{lake_dir}/{name}.parquet")
    assert set(made) == set(SCHEMAS)
    return Retail(spark, lake_dir)


def test_published_tables_make_the_fact_once(small_retail):
    from tidemart.testbed.registry import published_frames
    frames = published_frames(small_retail)
    for name in ("fact_order_items", "order_summary", "customer_metrics", "seller_performance",
                 "product_performance"):
        plan = frames[name]._jdf.queryExecution().executedPlan().toString()
        assert "l_orderkey" not in plan and plan.count("FileScan") == 1
    assert rows(frames["fact_order_items"]) == rows(small_retail.fact)
    assert rows(frames["customer_metrics"]) == rows(small_retail.customer_metrics)


def test_buckets_grow_with_the_rows(small_retail, monkeypatch):
    from tidemart.sources import tables
    from tidemart.testbed.registry import live_lake
    assert [tables.buckets_for(n) for n in (0, 4_000_000, 36_000_001)] == [4, 4, 37]
    assert small_retail.buckets() == 4 and small_retail.buckets(8) == 8
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 5)
    assert small_retail.buckets() == 12
    assert live_lake(small_retail, "live")[0].buckets == 12


@pytest.mark.parametrize("version", [None, "at"])
def test_an_upsert_deals_its_rows_once(spark, lake_dir, monkeypatch, version):
    """Keys repeat in the table, are missing on both sides, and versions may be older or none."""
    from tidemart.operators.upsert import merge_by_key
    from tidemart.sources import tables
    t = tables.StoredTable(spark, f"{tables.database_at(spark, lake_dir)}.t", f"{lake_dir}/t",
                           keys=["k", "n"], buckets=4)
    t.overwrite(spark.createDataFrame(
        [(1, 1, 5, "a"), (1, 1, 6, "a"), (1, 2, 5, "a"), (2, 1, None, "a"), (3, 1, 9, "a"),
         (None, 1, 5, "a"), (4, 1, 5, "a")], "k int, n int, at int, v string"))
    feed = spark.createDataFrame(
        [(1, 1, 7, "b", 1), (1, 2, 4, "b", 1), (2, 1, 1, "b", 1), (3, 1, None, "b", 1),
         (None, 1, 6, "b", 1), (9, None, 6, "b", 1), (8, 1, 6, "b", 1)],
        "k int, n int, at int, v string, more int")
    want = rows(merge_by_key(t.read(), feed, ["k", "n"], version))
    plans, insert = [], tables.StoredTable._insert

    def watched(self, name, frame, *rest):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return insert(self, name, frame, *rest)

    monkeypatch.setattr(tables.StoredTable, "_insert", watched)
    t.upsert(feed, version)
    assert rows(t.read()) == want
    assert "hashpartitioning(k" in plans[0] and ", n#" not in "".join(
        line for line in plans[0].splitlines() if "hashpartitioning" in line)
    # a bucket that is too large for a task is still split by adaptive execution
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 0)
    t.upsert(feed.where("k IS NOT NULL AND n IS NOT NULL"), version)
    assert "Join" in plans[1] and rows(t.read()) == want


@pytest.mark.parametrize("month", [None, "day"])
def test_an_upsert_leaves_old_rows_in_their_buckets(spark, lake_dir, monkeypatch, month):
    """Only the feed is shuffled, and its scratch copy is gone afterwards. Names of columns are
    like those used inside."""
    from tidemart.operators.upsert import merge_by_key
    from tidemart.sources import tables
    from tidemart.sources.paths import exists
    t = tables.StoredTable(spark, f"{tables.database_at(spark, lake_dir)}.t", f"{lake_dir}/t",
                           keys=["k", "n"], buckets=3, month=month)
    made = "id % 50 AS k", "cast(id / 50 AS int) AS n", "id AS new", "id AS _of_new", (
        "timestamp '2020-01-01' + make_dt_interval(cast(id % 70 AS int)) AS day")
    t.overwrite(spark.range(200).selectExpr(*made))
    feed = spark.range(150, 250).selectExpr(*made).withColumn("new", F.lit(-1).cast("long"))
    want = rows(merge_by_key(t.read(), feed, ["k", "n"]))
    plans, insert, scratch = [], tables.StoredTable._insert, []

    def watched(self, name, frame, *rest):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return insert(self, name, frame, *rest)

    def folder(spark, label):
        scratch.append(f"{lake_dir}/{label}")
        return scratch[-1]

    monkeypatch.setattr(tables.StoredTable, "_insert", watched)
    monkeypatch.setattr(tables, "scratch_dir", folder)
    t.upsert(feed, unique=True)
    dealt = [line for line in plans[0].splitlines() if "Exchange hashpartitioning(k#" in line]
    assert len(dealt) == 1 and rows(t.read()) == want
    assert scratch and not exists(spark, scratch[0])


def test_a_stage_frees_its_shuffle_files(spark):
    from types import SimpleNamespace

    from tidemart.session import FREED, frees_shuffles

    @frees_shuffles
    def stage(lake, fails):
        assert lake.spark.conf.get(FREED) == "true"
        return 1 / fails

    before = spark.conf.get(FREED)
    assert stage(SimpleNamespace(spark=spark), fails=1) == 1
    with pytest.raises(ZeroDivisionError):
        stage(SimpleNamespace(spark=spark), fails=0)
    assert spark.conf.get(FREED) == before
