"""Batches and live files through all layers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemart.plans.stages import Lake, build_gold, export_warehouse, run_bronze, run_silver
from tidemart.specs import ALL_SPECS, CONTRACT_DDL, REFERENCE_SPECS, TRANSACTIONAL_SPECS, contract
from tidemart.plans.refresh import changed_orders, refresh_gold
from tidemart.streaming.live import load_name, run_live
from tidemart.sources.bronze import LIVE_BATCH, read_batch
from tests.conftest import rows

ORDERS = {"orders": TRANSACTIONAL_SPECS["orders"]}


def csv_file(spark, path, name, data):
    spec = ALL_SPECS[name]
    full = [tuple(row.get(c) for c in spec.columns) for row in data]
    (spark.createDataFrame(full, spec.csv_schema).coalesce(1)
     .write.mode("overwrite").option("header", True).csv(f"{path}/{spec.source_file}"))


def order(i, status="shipped", at="2018-01-01 10:00:00"):
    return {"order_id": f"o{i}", "customer_id": f"c{i % 3}", "order_status": status,
            "order_purchase_timestamp": at}


def write_batches(spark, raw, batches=("1", "2", "3", "4"), missing=()):
    for b in batches:
        n = int(b) * 10
        csv_file(spark, f"{raw}/batch_{b}", "orders", [order(n + i) for i in range(3)])
        if "order_items" not in missing:
            csv_file(spark, f"{raw}/batch_{b}", "order_items", [
                {"order_id": f"o{n + i}", "order_item_id": "1", "product_id": "p1",
                 "seller_id": "s1", "price": "10.5", "freight_value": "x"} for i in range(3)] * 2)
        csv_file(spark, f"{raw}/batch_{b}", "order_payments", [
            {"order_id": f"o{n}", "payment_sequential": "1", "payment_type": "not_defined",
             "payment_value": "10.5", "payment_installments": "1"}])
        csv_file(spark, f"{raw}/batch_{b}", "order_reviews", [
            {"review_id": f"r{n}", "order_id": f"o{n}", "review_score": "5"}])
    if "1" in batches:
        csv_file(spark, f"{raw}/batch_1", "category_translation", [
            {"product_category_name": "moveis", "product_category_name_english": "furniture"}])
        csv_file(spark, f"{raw}/batch_1", "geolocation", [
            {"geolocation_zip_code_prefix": "01310", "geolocation_lat": lat,
             "geolocation_lng": "-46.5", "geolocation_city": "sp", "geolocation_state": "SP"}
            for lat in ("-23.5", "-23.7")])
        csv_file(spark, f"{raw}/batch_1", "sellers", [
            {"seller_id": "s1", "seller_zip_code_prefix": "01310", "seller_city": " sao paulo",
             "seller_state": "sp "}])
        csv_file(spark, f"{raw}/batch_1", "customers", [
            {"customer_id": f"c{i}", "customer_unique_id": f"u{i}", "customer_state": "rj",
             "customer_city": "rio", "customer_zip_code_prefix": "20000"} for i in range(3)])
        csv_file(spark, f"{raw}/batch_1", "products", [
            {"product_id": "p1", "product_category_name": "moveis", "product_name_lenght": "9"}])


def small_lake(spark, root):
    return Lake(spark, f"{root}/lake", buckets=4)


@pytest.fixture(scope="module")
def loaded(spark):
    """A lake after batches 1 to 4, with batches 2 to 4 in another order."""
    from tidemart.session import scratch_dir
    root = scratch_dir(spark, "pipeline")
    write_batches(spark, f"{root}/raw")
    lake = small_lake(spark, root)
    for b in "1324":
        assert run_bronze(lake, f"{root}/raw", b).errors == {}
        run_silver(lake, b)
    return root, lake


def test_all_batches_are_in_silver_once(loaded):
    _, lake = loaded
    assert lake.silver("orders").read().count() == 12
    assert lake.silver("order_items").read().count() == 12
    assert rows(lake.silver("order_payments").read().select("payment_type").distinct()) == [
        ("unknown",)]
    assert set(lake.silver("orders").read().columns) == set(ALL_SPECS["orders"].columns)
    assert rows(lake.silver("sellers").read()) == [("s1", "01310", "Sao Paulo", "SP")]
    assert lake.silver("products").read().first()["product_category_name_english"] == "furniture"


def test_a_finished_batch_is_skipped_until_reset(loaded):
    root, lake = loaded
    assert run_bronze(lake, f"{root}/raw", "2").skipped
    lake.ledger.reset("2")
    again = run_bronze(lake, f"{root}/raw", "2")
    assert not again.skipped and again.rows["orders"] == 3
    run_silver(lake, "2")
    assert lake.silver("orders").read().count() == 12


def test_gold_and_warehouse(loaded):
    _, lake = loaded
    built = build_gold(lake).rows
    assert built["fact_order_items"] == 12 and set(built) == set(CONTRACT_DDL)
    assert lake.read_gold("customer_metrics").columns == contract("customer_metrics").names
    assert rows(lake.gold("dim_sellers").read(), "seller_lat") == [(-23.6,)]
    tables = export_warehouse(lake)
    for name, df in tables.items():
        assert df.schema == contract(name) and df.count() == built[name]


def test_the_fact_is_joined_without_a_shuffle(spark, loaded):
    from tidemart.plans import gold
    _, lake = loaded
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.fact_order_items(*(lake.silver(n).read() for n in (
            "orders", "order_items", "order_payments", "order_reviews")))
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 4
        assert fact.count() == 12
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def bytes_read(spark):
    """Bytes that all stages so far have read from files."""
    sc = spark.sparkContext
    none, doubles = None, sc._gateway.new_array(sc._jvm.double, 0)
    stages = sc._jsc.sc().statusStore().stageList(
        none, False, False, doubles, sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).inputBytes() for i in range(stages.size()))


def metrics(lake):
    return {n: rows(lake.read_gold(n)) for n in (
        "fact_order_items", "order_summary", "customer_metrics", "seller_performance",
        "product_performance")}


def test_incremental_gold_equals_a_rebuild(spark, lake_dir):
    raw = f"{lake_dir}/raw"
    write_batches(spark, raw)
    lake = Lake(spark, f"{lake_dir}/lake", buckets=4)
    for b in "12":
        run_bronze(lake, raw, b)
        run_silver(lake, b)
    build_gold(lake)
    for b in "34":
        run_bronze(lake, raw, b)
        run_silver(lake, b)
        changed = changed_orders(lake, f"batch_{b}")
        refresh_gold(lake, changed, f"run-{b}")
        once = metrics(lake)
        refresh_gold(lake, changed, f"run-{b}")      # the same run again counts nothing twice
        assert metrics(lake) == once
    # an order moves to another customer and an earlier month: the old last date goes
    live_csv(f"{lake_dir}/live", "20260101_000000",
             [order(20, "moved", "2016-01-01 10:00:00") | {"customer_id": "c9"},
              order(41, "late", "2015-01-01 10:00:00")])
    orders_only = Lake(spark, lake.root, {}, ORDERS, buckets=4)
    run_live(orders_only, f"{lake_dir}/live", f"{lake_dir}/offsets")
    refresh_gold(lake, changed_orders(lake, LIVE_BATCH), "live-1")
    grown = metrics(lake)
    assert ("c9",) in [r[:1] for r in grown["customer_metrics"]]
    build_gold(lake)
    assert grown == metrics(lake)


def test_a_small_change_reads_little(spark, lake_dir):
    """One order or two thousand: a run reads the buckets of its orders, not the whole lake."""
    lake = Lake(spark, f"{lake_dir}/lake", buckets=8)
    at = "timestamp'2018-01-05' + make_interval(0, 0, 0, cast(id % 200 AS int))"
    ids = spark.range(40_000).selectExpr("concat('o', id) AS order_id", "id")
    lake.silver("orders").overwrite(ids.selectExpr(
        "order_id", "concat('c', id % 9000) AS customer_id", "'x' AS order_status",
        f"{at} AS order_purchase_timestamp", f"{at} AS order_approved_at",
        f"{at} AS order_delivered_carrier_date", f"{at} AS order_delivered_customer_date",
        f"{at} AS order_estimated_delivery_date"))
    lake.silver("order_items").overwrite(ids.selectExpr(
        "order_id", "1 AS order_item_id", "concat('p', id % 7000) AS product_id",
        "concat('s', id % 5000) AS seller_id", "cast(id AS double) AS price",
        "cast(rand(1) AS double) AS freight_value"))
    lake.silver("order_payments").overwrite(ids.selectExpr(
        "order_id", "1 AS payment_sequential", "'card' AS payment_type",
        "1 AS payment_installments", "cast(rand(2) AS double) AS payment_value"))
    lake.silver("order_reviews").overwrite(ids.selectExpr(
        "concat('r', id) AS review_id", "order_id", "cast(1 + id % 5 AS int) AS review_score"))
    build_gold(lake, ("fact_order_items", "order_summary", "customer_metrics",
                      "seller_performance", "product_performance"))

    def read_by(n):
        before = bytes_read(spark)
        refresh_gold(lake, ids.where(f"id % {40_000 // n} = 0").select("order_id"), f"run-{n}")
        return bytes_read(spark) - before

    one, many = read_by(1), read_by(2000)
    assert one < many / 2, (one, many)


def test_unknown_batch(spark, lake_dir):
    for stage in (lambda: run_bronze(small_lake(spark, lake_dir), lake_dir, "5"),
                  lambda: run_silver(small_lake(spark, lake_dir), "live")):
        with pytest.raises(ValueError, match="unknown batch"):
            stage()


def test_one_failing_table_keeps_the_batch_open(spark, lake_dir):
    raw, lake = f"{lake_dir}/raw", small_lake(spark, lake_dir)
    write_batches(spark, raw, ("2",), missing=("order_items",))
    first = run_bronze(lake, raw, "2")
    assert set(first.errors) == {"order_items"} and first.rows["orders"] == 3
    assert not lake.ledger.is_done("2", "bronze")
    write_batches(spark, raw, ("2",))
    assert run_bronze(lake, raw, "2").errors == {}
    assert lake.ledger.is_done("2", "bronze")
    assert spark.read.parquet(lake.bronze_path("orders")).count() == 3
    assert REFERENCE_SPECS.keys() & first.rows.keys() == set()


def live_csv(path, stamp, data):
    """A single live file, as a feed delivers it."""
    import os
    spec = ALL_SPECS["orders"]
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{stamp}_{spec.source_file}", "w") as f:
        f.write(",".join(spec.columns) + "\n")
        for row in data:
            f.write(",".join(row.get(c) or "" for c in spec.columns) + "\n")


def test_live_files_are_processed_once_and_upserted(spark, lake_dir):
    lake = Lake(spark, f"{lake_dir}/lake", {}, ORDERS, buckets=4)
    live, offsets = f"{lake_dir}/live", f"{lake_dir}/offsets"
    assert run_live(lake, live, offsets) == {"orders": 0}
    live_csv(live, "20260101_000000", [order(1), order(2), order(2)])
    live_csv(live, "20260101_001000", [order(1, "delivered")])
    assert run_live(lake, live, offsets, files_per_trigger=1) == {"orders": 4}
    assert rows(lake.silver("orders").read(), "order_id", "order_status") == [
        ("o1", "delivered"), ("o2", "shipped")]
    assert run_live(lake, live, offsets) == {"orders": 0}
    live_csv(live, "20260101_002000", [order(3)])
    assert run_live(lake, live, offsets) == {"orders": 1}
    assert lake.silver("orders").read().count() == 3
    stored = read_batch(spark, lake.bronze_path("orders"), LIVE_BATCH)
    assert stored.count() == 5
    assert rows(stored.select("source_file").distinct())[0][0].endswith("orders_dataset.csv")
    assert "batch_id" not in lake.silver("orders").read().columns


def test_a_row_that_arrives_again_is_stored_once(spark, lake_dir):
    lake = Lake(spark, f"{lake_dir}/lake", {}, ORDERS, buckets=4)
    live, offsets = f"{lake_dir}/live", f"{lake_dir}/offsets"
    live_csv(live, "20260101_000000", [order(1), order(2), order(2)])
    live_csv(live, "20260101_001000", [order(1), order(2, "delivered")])
    once = dict(files_per_trigger=1, once_within="1 hour")
    assert run_live(lake, live, offsets, **once) == {"orders": 3}
    live_csv(live, "20260101_002000", [order(1), order(2, "delivered"), order(3)])
    assert run_live(lake, live, offsets, **once) == {"orders": 1}
    stored = read_batch(spark, lake.bronze_path("orders"), LIVE_BATCH)
    assert rows(stored, "order_id", "order_status") == [
        ("o1", "shipped"), ("o2", "delivered"), ("o2", "shipped"), ("o3", "shipped")]
    assert lake.silver("orders").read().count() == 3


def test_the_state_of_arrived_rows_is_bounded(spark, lake_dir):
    import os
    import time

    from tidemart.streaming.live import ONCE, start_live
    lake = Lake(spark, f"{lake_dir}/lake", {}, ORDERS, buckets=4)
    live, now = f"{lake_dir}/live", time.time()
    for i in range(4):
        live_csv(live, f"20260101_00{i}000", [order(10 * i + k) for k in range(5)])
        name = f"{live}/20260101_00{i}000_{ORDERS['orders'].source_file}"
        os.utime(name, (now + i * 7200, now + i * 7200))
    stream = start_live(lake, live, ORDERS["orders"], f"{lake_dir}/offsets", ONCE,
                        files_per_trigger=1, merge=False, once_within="1 hour")
    stream.awaitTermination()
    held = [s["numRowsTotal"] for p in stream.recentProgress for s in p["stateOperators"]]
    assert max(held) <= 10 and read_batch(
        spark, lake.bronze_path("orders"), LIVE_BATCH).count() == 20


def test_new_columns_are_rescued(spark, lake_dir):
    import os
    lake = Lake(spark, f"{lake_dir}/lake", {}, ORDERS, buckets=4)
    live, offsets = f"{lake_dir}/live", f"{lake_dir}/offsets"
    live_csv(live, "20260101_000000", [order(1)])
    assert run_live(lake, live, offsets, evolving=True) == {"orders": 1}
    names = ["channel", "order_status", "order_id", "Customer_ID"]
    with open(f"{live}/20260101_001000_orders_dataset.csv", "w") as f:
        f.write(",".join(names) + "\n" + 'app,"new, x",o2,007\n' + ",new,o3,8\n")
    live_csv(live, "20260101_002000", [order(4)])
    assert run_live(lake, live, offsets, evolving=True) == {"orders": 3}
    assert os.path.isdir(f"{offsets}/orders")
    stored = read_batch(spark, lake.bronze_path("orders"), LIVE_BATCH).selectExpr(
        "order_id", "customer_id", "order_status",
        "variant_get(rescued, '$.channel', 'string') AS channel")
    assert rows(stored) == [("o1", "c1", "shipped", None), ("o2", "007", "new, x", "app"),
                            ("o3", "8", "new", None), ("o4", "c1", "shipped", None)]
    assert "rescued" not in lake.silver("orders").read().columns
    assert lake.silver("orders").read().count() == 4


def test_a_failing_read_raises_and_leaves_no_stream(spark, lake_dir):
    from tidemart.streaming.live import live_counts
    two = {n: TRANSACTIONAL_SPECS[n] for n in ("orders", "order_payments")}
    lake = Lake(spark, f"{lake_dir}/lake", {}, two, buckets=4)
    live = f"{lake_dir}/live"
    live_csv(live, "20260101_000000", [order(1)])
    with open(f"{live}/20260101_000000_order_payments_dataset.csv", "w") as f:
        f.write("wrong,header\n1,2\n")
    with pytest.raises(Exception):
        run_live(lake, live, f"{lake_dir}/a")
    assert lake.silver("orders").read().count() == 1 and not spark.streams.active
    with pytest.raises(Exception):
        live_counts(lake, live, f"{lake_dir}/b")
    good = Lake(spark, lake.root, {}, ORDERS, buckets=4)
    live_csv(live, "20260101_001000", [order(2), order(3)])
    assert rows(live_counts(good, live, f"{lake_dir}/c", files_per_trigger=1)) == [
        ("orders", 3, 2)]
    assert rows(live_counts(good, live, f"{lake_dir}/c")) == [("orders", 0, 0)]


def test_a_second_load_keeps_its_new_column(spark, lake_dir):
    from tidemart.sources.bronze import write_batch
    from tidemart.sources.csv import with_audit
    first = with_audit(spark.createDataFrame([(1,)], "k int"), "live", "a", "f")
    write_batch(first, lake_dir)
    write_batch(with_audit(spark.createDataFrame([(2, "x")], "k int, extra string"),
                           "live", "b", "f"), lake_dir)
    assert rows(read_batch(spark, lake_dir, "live"), "k", "extra") == [(1, None), (2, "x")]


def test_live_result_equals_batch_result(spark, lake_dir):
    data = [order(i) for i in range(5)]
    live_csv(f"{lake_dir}/live", "20260101_000000", data)
    streamed = Lake(spark, f"{lake_dir}/a", {}, ORDERS, buckets=4)
    run_live(streamed, f"{lake_dir}/live", f"{lake_dir}/offsets")
    csv_file(spark, f"{lake_dir}/raw/batch_1", "orders", data)
    batch = Lake(spark, f"{lake_dir}/b", {}, ORDERS, buckets=4)
    run_bronze(batch, f"{lake_dir}/raw", "1")
    run_silver(batch, "1")
    assert rows(streamed.silver("orders").read()) == rows(batch.silver("orders").read())


def test_a_new_checkpoint_does_not_replace_older_loads():
    assert load_name("/a", 0) != load_name("/b", 0) and load_name("/a", 0) < load_name("/a", 1)


def test_processed_files_are_archived(spark, lake_dir):
    import os
    lake = Lake(spark, f"{lake_dir}/lake", {}, ORDERS, buckets=4)
    live, archive = f"{lake_dir}/live", f"{lake_dir}/archive"
    for i in range(3):
        live_csv(live, f"20260101_00{i}000", [order(i)])
        run_live(lake, live, f"{lake_dir}/offsets", archive=archive)
    assert len(os.listdir(live)) < 3
    assert any(files for _, _, files in os.walk(archive))
    assert lake.silver("orders").read().count() == 3


def test_live_rows_can_carry_the_merge_time(spark, lake_dir):
    csv_file(spark, f"{lake_dir}/raw/batch_1", "orders", [order(1)])
    lake = Lake(spark, f"{lake_dir}/lake", {}, ORDERS, buckets=4, stamp_live=True)
    run_bronze(lake, f"{lake_dir}/raw", "1")
    run_silver(lake, "1")
    live_csv(f"{lake_dir}/live", "20260101_000000", [order(2)])
    run_live(lake, f"{lake_dir}/live", f"{lake_dir}/offsets")
    got = lake.silver("orders").read().select(
        "order_id", F.col("cdc_merge_timestamp").isNotNull())
    assert rows(got) == [("o1", False), ("o2", True)]


def test_newer_version_survives_a_late_row(spark, lake_dir):
    from dataclasses import replace
    spec = {"orders": replace(ORDERS["orders"], version="order_purchase_timestamp")}
    lake = Lake(spark, f"{lake_dir}/lake", {}, spec, buckets=4)
    live = f"{lake_dir}/live"
    live_csv(live, "20260101_000000", [order(1, "new", "2018-05-01 00:00:00")])
    run_live(lake, live, f"{lake_dir}/offsets")
    live_csv(live, "20260101_001000", [order(1, "late", "2018-04-01 00:00:00")])
    run_live(lake, live, f"{lake_dir}/offsets")
    got = lake.silver("orders").read().select("order_status", F.month("order_purchase_timestamp"))
    assert rows(got) == [("new", 5)]
