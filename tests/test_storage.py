"""Stored tables, raw layer, ledger, published tables, catalog."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemart.sources.bronze import has_batch, read_batch, write_batch
from tidemart.sources.csv import scan_csv, scan_declared, with_audit
from tidemart.sources.ledger import Ledger
from tidemart.sources.paths import matching
from tidemart.sources.publish import publish, published, quarantined, row_counts
from tidemart.sources.tables import (
    LIVE, PART, StoredTable, database_at, missing_tables, read_first, register, register_location,
)
from tidemart.specs import ALL_SPECS, CONTRACT_DDL, contract
from tests.conftest import rows

DDL = "k int, v string"


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


def table(spark, root, name="t", **layout):
    return StoredTable(spark, f"{database_at(spark, root)}.{name}", f"{root}/{name}", **layout)


@pytest.mark.parametrize("buckets", [1, 4])
def test_upsert_creates_updates_and_ignores_an_empty_source(spark, lake_dir, buckets):
    t = table(spark, lake_dir, keys=["k"], buckets=buckets)
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    t.upsert(frame(spark, [(1, "a"), (2, "a"), (2, "b")]))
    assert rows(t.read()) == [(1, "a"), (2, "a")]
    files = set(t.read().inputFiles())
    assert t.upsert(frame(spark, [])) == 0 and set(t.read().inputFiles()) == files
    t.upsert(frame(spark, [(2, "c"), (3, "c")]))
    t.upsert(frame(spark, [(2, "c"), (3, "c")]))
    assert rows(t.read()) == [(1, "a"), (2, "c"), (3, "c")]


@pytest.mark.parametrize("buckets", [1, 4])
def test_rows_without_a_key_are_kept_and_never_matched(spark, lake_dir, buckets):
    t = table(spark, lake_dir, keys=["k"], buckets=buckets)
    t.overwrite(frame(spark, [(1, "a"), (None, "a")]))
    t.upsert(frame(spark, [(1, "b"), (None, "b")]))
    assert rows(t.read()) == [(1, "b"), (None, "a"), (None, "b")]
    t.upsert(frame(spark, [(None, "c")]))
    assert t.read().count() == 4


def test_upsert_replaces_only_touched_buckets(spark, lake_dir):
    t = table(spark, lake_dir, keys=["k"], buckets=16)
    t.overwrite(spark.range(200).selectExpr("cast(id AS int) k", "'a' v"))
    before = set(t.read().inputFiles())
    assert t.upsert(frame(spark, [(7, "b")])) < 40
    after = set(t.read().inputFiles())
    folders = {f.rsplit("/", 2)[1] for f in before ^ after}
    assert len(folders) == 1
    assert t.read().count() == 200 and rows(t.read().where("v = 'b'")) == [(7, "b")]


def test_keys_of_another_type_find_their_bucket(spark, lake_dir):
    t = table(spark, lake_dir, keys=["k"], buckets=8)
    t.overwrite(spark.range(50).selectExpr("cast(id AS int) k", "'a' v"))
    t.upsert(spark.range(40, 60).selectExpr("id k", "'b' v"))
    assert rows(t.read().groupBy("v").count()) == [("a", 40), ("b", 20)]
    t.upsert(spark.range(50).selectExpr("cast(id AS string) k", "'c' v"))
    assert rows(t.read().groupBy("v").count()) == [("b", 10), ("c", 50)]


def test_a_bucket_is_a_file(spark, lake_dir):
    t = table(spark, lake_dir, keys=["k"], buckets=8)
    t.upsert(spark.range(5000).selectExpr("cast(id AS int) k", "'a' v"))
    assert len(t.read().inputFiles()) <= 8


def test_new_column_reads_null_in_old_rows(spark, lake_dir):
    t = table(spark, lake_dir, keys=["k"], buckets=4)
    t.overwrite(frame(spark, [(1, "a"), (2, "a")]))
    t.upsert(frame(spark, [(2, "b", 9)], "k int, v string, extra int"))
    assert rows(t.read()) == [(1, "a", None), (2, "b", 9)]
    t.upsert(frame(spark, [(1, "c")]))
    assert rows(t.read()) == [(1, "c", None), (2, "b", 9)]


def test_a_reader_keeps_its_rows_and_a_failed_write_changes_nothing(spark, lake_dir):
    t = table(spark, lake_dir)
    t.overwrite(frame(spark, [(1, "a")]))
    old = t.read()
    bad = frame(spark, [(2, "b")]).withColumn("bad", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception):
        t.overwrite(bad)
    assert rows(t.read()) == [(1, "a")]
    t.overwrite(frame(spark, [(2, "b")]))
    assert rows(old) == [(1, "a")] and rows(t.read()) == [(2, "b")]
    t.overwrite(frame(spark, [(3, "c", 1)], "k int, v string, n int"))
    assert rows(old) == [(1, "a")] and rows(t.read()) == [(3, "c", 1)]
    assert spark.catalog.listTables(t.name.split(".")[0])[0].name == "t"
    keyed = table(spark, lake_dir, "keyed", keys=["k"], buckets=2)
    keyed.overwrite(frame(spark, [(1, "a")]))
    with pytest.raises(Exception):
        keyed.upsert(frame(spark, [(1, "x")]).withColumn(
            "v", F.raise_error(F.lit("boom")).cast("string")))
    assert rows(keyed.read()) == [(1, "a")]


def test_empty_bucketed_table(spark, lake_dir):
    t = table(spark, lake_dir, keys=["k"], buckets=4)
    t.overwrite(frame(spark, []))
    assert t.read().schema.simpleString() == "struct<k:int,v:string>" and t.read().isEmpty()
    t.upsert(frame(spark, [(1, "a")]))
    assert rows(t.read()) == [(1, "a")]


def dated(spark, data):
    return spark.createDataFrame(data, "k int, at string, v string").withColumn(
        "at", F.col("at").cast("timestamp"))


def months(t):
    return {f.split(f"{PART}=")[1].split("/")[0] for f in t.spark.table(t.name).inputFiles()}


def test_a_row_moves_to_another_month(spark, lake_dir):
    t = table(spark, lake_dir, keys=["k"], buckets=0, month="at")
    t.overwrite(dated(spark, [(1, "2020-01-05", "a"), (2, "2020-02-05", "a"),
                              (3, "2020-03-01", "a"), (4, None, "a"), (5, "2020-05-01", "a")]))
    # month 1 and the month of rows without a date are emptied
    assert t.upsert(dated(spark, [(1, "2020-02-09", "b"), (4, "2020-04-01", "b")])) == 3
    assert rows(t.read().select("k", F.month("at"), "v")) == [
        (1, 2, "b"), (2, 2, "a"), (3, 3, "a"), (4, 4, "b"), (5, 5, "a")]
    t.upsert(dated(spark, [(6, "2020-01-09", "c")]))
    assert t.read().count() == 6
    assert t.spark.table(t.name).where(f"NOT {LIVE}").count() == 4
    wanted = t.rows_of(spark.createDataFrame([(1,), (6,)], "k int"))
    assert rows(wanted, "k", "v") == [(1, "b"), (6, "c")]
    late = dated(spark, [(1, "2019-12-31", "old"), (6, "2020-06-01", "new")])
    t.upsert(late, version_col="at")
    assert rows(t.read().where("k IN (1, 6)"), "k", "v") == [(1, "b"), (6, "new")]


def test_a_feed_over_two_months_reads_and_writes_only_those(spark, lake_dir, monkeypatch):
    t = table(spark, lake_dir, keys=["k"], buckets=0, month="at", moves=False)
    t.overwrite(dated(spark, [(m * 10 + i, f"2020-{m:02d}-05", "a")
                              for m in range(1, 13) for i in range(5)]))
    before = set(spark.table(t.name).inputFiles())
    merged = []
    insert = StoredTable._insert

    def watched(self, name, frame_, emptied=()):
        merged.append(frame_)
        return insert(self, name, frame_, emptied)

    monkeypatch.setattr(StoredTable, "_insert", watched)
    assert t.upsert(dated(spark, [(32, "2020-03-05", "b"), (71, "2020-07-05", "b"),
                                  (79, "2020-07-31", "b")])) == 11
    after = set(spark.table(t.name).inputFiles())
    changed = {f.split(f"{PART}=")[1].split("/")[0] for f in before ^ after}
    assert changed == {"2020-03", "2020-07"} and len(months(t)) == 12
    plan = merged[0]._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert rows(t.read().where("v = 'b'"), "k") == [(32,), (71,), (79,)]


def test_tables_in_the_same_buckets_are_joined_without_a_shuffle(spark, lake_dir):
    a = table(spark, lake_dir, "a", keys=["k"], buckets=4)
    b = table(spark, lake_dir, "b", keys=["k", "n"], buckets=4)
    c = table(spark, lake_dir, "c", keys=["k"], buckets=4, month="at")
    a.overwrite(frame(spark, [(i, "a") for i in range(50)]))
    b.overwrite(spark.range(200).selectExpr("cast(id % 60 AS int) k", "id n"))
    c.overwrite(dated(spark, [(i, f"2020-{1 + i % 3:02d}-01", "c") for i in range(40)]))
    a.upsert(frame(spark, [(7, "b"), (99, "b")]))
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.read().join(b.read().groupBy("k").agg(F.count("n").alias("n")), "k").join(
            c.read().drop("v"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 3
        assert joined.agg(F.sum("n")).first()[0] == sum(3 + (i < 20) for i in range(40))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_lookups_are_broadcast_by_their_statistics(spark, lake_dir):
    """A lookup that is too big to broadcast is not, a filter that leaves little of it is known
    to, and a hot category of the other side is split."""
    from tidemart.operators.clean import join_lookup
    from tidemart.specs import Lookup
    big = table(spark, lake_dir, "big")
    big.overwrite(spark.range(20_000).selectExpr("id AS k", "concat('name ', id) AS name"))
    lookup, conf = Lookup("big", "k"), {
        "spark.sql.autoBroadcastJoinThreshold": "50000",
        "spark.sql.cbo.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000"}
    keep = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        few = lambda: big.read().where("k < 100")
        products = spark.range(60_000).selectExpr(
            "id AS product_id", "if(id % 3 = 0, 7, id % 20000) AS k", "uuid() AS text")
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan(join_lookup(products, few(), lookup))
        big.analyze("k")
        assert "BroadcastHashJoin" in plan(join_lookup(products, few(), lookup))
        joined = join_lookup(products, big.read(), lookup)
        assert "Broadcast" not in plan(joined)
        assert joined.where("name = 'name 7'").count() == 20_000 + 2
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_fallback_prefers_the_curated_table(spark, lake_dir):
    raw, curated = (table(spark, lake_dir, n) for n in ("raw", "curated"))
    with pytest.raises(FileNotFoundError):
        read_first(curated, raw)
    raw.overwrite(frame(spark, [(1, "raw")]))
    assert rows(read_first(curated, raw)) == [(1, "raw")]
    curated.overwrite(frame(spark, [(1, "curated")]))
    assert rows(read_first(curated, raw)) == [(1, "curated")]


def test_batch_written_twice_leaves_one_copy(spark, lake_dir):
    def batch(n, size):
        return with_audit(spark.range(size), f"batch_{n}", source_file="f.csv")
    for n, size in ((1, 5), (2, 7), (2, 3), (1, 5)):
        assert write_batch(batch(n, size), lake_dir) == size
    got = spark.read.parquet(lake_dir).groupBy("batch_id").count()
    assert rows(got) == [("batch_1", 5), ("batch_2", 3)]
    assert has_batch(spark, lake_dir, "batch_2") and not has_batch(spark, lake_dir, "batch_3")


def test_reading_a_batch_lists_only_its_partition(spark, lake_dir):
    for n in (1, 2):
        write_batch(with_audit(spark.range(5), f"batch_{n}", source_file="f"), lake_dir)
    one = read_batch(spark, lake_dir, "batch_2")
    assert all("batch_id=batch_2" in f for f in one.inputFiles())
    assert rows(one.select("batch_id").distinct()) == [("batch_2",)]
    filtered = spark.read.parquet(lake_dir).where("batch_id = 'batch_2'")
    assert "PartitionFilters: [isnotnull(batch_id" in (
        filtered._jdf.queryExecution().executedPlan().toString())


def test_csv_keeps_leading_zeros_and_checks_the_header(spark, lake_dir):
    spec = ALL_SPECS["sellers"]
    df = spark.createDataFrame([("s", "01310", "x", "SP", "more")],
                               "seller_id string, seller_zip_code_prefix string, "
                               "seller_city string, seller_state string, extra string")
    df.write.option("header", True).csv(f"{lake_dir}/a")
    got = scan_csv(spark, f"{lake_dir}/a", spec)
    assert rows(got, "seller_zip_code_prefix", "extra") == [("01310", "more")]
    df.select("seller_id", "seller_state").write.option("header", True).csv(f"{lake_dir}/b")
    with pytest.raises(ValueError, match="missing from the header"):
        scan_csv(spark, f"{lake_dir}/b", spec)
    with pytest.raises(Exception):
        scan_declared(spark, f"{lake_dir}/b", spec).collect()


def test_audit_takes_the_real_file_name(spark, lake_dir):
    spark.range(1).selectExpr("'s' seller_id", "'1' seller_zip_code_prefix", "'c' seller_city",
                              "'S' seller_state").write.option("header", True).csv(lake_dir)
    got = with_audit(scan_csv(spark, lake_dir, ALL_SPECS["sellers"]), "batch_1").first()
    assert got["source_file"].startswith("part-") and got["ingestion_timestamp"] is not None


def test_ledger(spark, lake_dir):
    ledger = Ledger(spark, f"{lake_dir}/ledger")
    assert not ledger.is_done("1", "bronze") and ledger.status().isEmpty()
    ledger.mark_done("1", "bronze", 10)
    ledger.mark_done("1", "bronze", 12)
    ledger.mark_done("2", "bronze", 5)
    ledger.mark_done("2", "silver", 4)
    assert ledger.is_done("1", "bronze") and not ledger.is_done("1", "silver")
    ledger.reset("2")
    assert not ledger.is_done("2", "bronze") and ledger.is_done("2", "silver")
    assert rows(ledger.status(), "batch", "stage", "status", "rows") == [
        ("1", "bronze", "completed", 12), ("2", "bronze", "reset", 0),
        ("2", "silver", "completed", 4)]
    asked = spark.createDataFrame([("1",), ("2",), ("3",)], "batch string")
    assert rows(ledger.pending(asked, "bronze")) == [("2",), ("3",)]


def test_publish_matches_by_name_and_sets_bad_rows_aside(spark, lake_dir):
    df = spark.createDataFrame(
        [("10.5", "3", "p1", "x"), ("oops", "4", "p2", "x"), (None, None, "p3", "x")],
        "TOTAL_SALES string, Total_Quantity string, product_id string, unknown string")
    want = contract("product_performance")
    assert publish(df, want, lake_dir) == 3
    good = published(spark, lake_dir, want)
    assert good.schema == want
    assert rows(good, "product_id", "total_sales", "total_quantity", "avg_price") == [
        ("p1", 10.5, 3, None), ("p3", None, None, None)]
    bad = quarantined(spark, lake_dir, want)
    assert [r["failed_columns"] for r in bad.collect()] == ["total_sales"]
    assert '"product_id":"p2"' in bad.first()["raw_row"]
    publish(df.limit(1), want, lake_dir)
    assert published(spark, lake_dir, want).count() == 1
    assert quarantined(spark, lake_dir, want).isEmpty()


def test_a_failed_publish_leaves_the_old_table(spark, lake_dir):
    want = contract("product_performance")
    good = spark.createDataFrame([("p1", 1.0)], "product_id string, total_sales double")
    publish(good, want, lake_dir)
    reader = published(spark, lake_dir, want)
    with pytest.raises(Exception, match="boom"):
        publish(good.withColumn("avg_price", F.raise_error(F.lit("boom")).cast("double")),
                want, lake_dir)
    assert rows(published(spark, lake_dir, want), "product_id") == [("p1",)]
    publish(good.withColumn("product_id", F.lit("p2")), want, lake_dir)
    assert rows(published(spark, lake_dir, want), "product_id") == [("p2",)]
    assert rows(reader, "product_id") == [("p1",)]


def test_catalog_registration_is_repeatable(spark, lake_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    spark.range(3).write.parquet(f"{lake_dir}/a")
    spark.range(5).write.parquet(f"{lake_dir}/b")
    for _ in range(2):
        register_location(spark, "gold_test.dim_sellers", f"{lake_dir}/a")
    assert spark.table("gold_test.dim_sellers").count() == 3
    register_location(spark, "gold_test.dim_sellers", f"{lake_dir}/b")
    assert spark.table("gold_test.dim_sellers").count() == 5
    gaps = missing_tables(spark, list(CONTRACT_DDL), "gold_test")
    assert len(CONTRACT_DDL) == 9 and gaps.count() == 8
    spark.sql("DROP DATABASE gold_test CASCADE")
    assert len(matching(spark, f"{lake_dir}/a/*.parquet")) > 0


def test_register_view_follows_the_table(spark, lake_dir):
    t = table(spark, lake_dir)
    t.overwrite(frame(spark, [(1, "a")]))
    register(spark, "registered_rows", t)
    assert rows(spark.sql("SELECT * FROM registered_rows")) == [(1, "a")]
    t.overwrite(frame(spark, [(2, "b")]))
    register(spark, "registered_rows", t)
    assert rows(spark.table("registered_rows")) == [(2, "b")]


def test_row_counts(spark):
    got = row_counts({"b": spark.range(2), "a": spark.range(0)})
    assert [tuple(r) for r in got.collect()] == [("a", 0), ("b", 2)]
