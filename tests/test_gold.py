"""Star schema and KPI queries on hand-made rows, and the shape of their plans."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemart.operators.skew import hot_slots
from tidemart.plans import cohorts, gold, kpi
from tests.conftest import rows

DAY = datetime(2018, 1, 10, 12)


def at(day, hour=12, second=0):
    return datetime(2018, 1, day, hour, 0, second)


@pytest.fixture(scope="module")
def shop(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", at(1, 23), at(2, 0, 1), at(5)),
         ("o2", "c1", "delivered", at(1), at(5), at(5)),
         ("o3", "c2", "delivered", at(1), at(9), at(5)),
         ("o4", "c2", "shipped", at(1), None, at(5)),
         ("o5", "c3", "delivered", at(1), at(3), None)],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp, order_delivered_customer_date timestamp, "
        "order_estimated_delivery_date timestamp")
    items = spark.createDataFrame(
        [("o1", i, "p1", "s1", 10.0, 1.25) for i in (1, 2, 3)]
        + [("o2", 1, "p1", "s1", 20.0, 0.0), ("o3", 1, "p2", "s2", 5.0, 5.0),
           ("o4", 1, "p2", "s3", 7.0, None), ("o5", 1, "p2", "s2", 1.0, 1.0),
           ("o9", 1, "p2", "s2", 1.0, 1.0)],
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "price double, freight_value double")
    payments = spark.createDataFrame(
        [("o1", 1, "card", 30.0, 2), ("o1", 2, "voucher", 3.75, 1)],
        "order_id string, payment_sequential int, payment_type string, "
        "payment_value double, payment_installments int")
    reviews = spark.createDataFrame(
        [("r1", "o1", 4), ("r2", "o1", 5), ("r3", "o3", 1)],
        "review_id string, order_id string, review_score int")
    fact = gold.fact_order_items(orders, items, payments, reviews).cache()
    return {"orders": orders, "items": items, "payments": payments, "reviews": reviews,
            "fact": fact}


def test_payments_and_reviews_do_not_multiply_lines(shop):
    f = shop["fact"]
    assert f.where("order_id = 'o1'").count() == 3 and f.count() == 7
    assert rows(f.where("order_id = 'o1'").select(
        "payment_value", "payment_type", "avg_installments", "review_score").distinct()) == [
        (33.75, "voucher", 1.5, 4.5)]
    assert f.columns == gold_columns()


def gold_columns():
    from tidemart.specs import contract
    return contract("fact_order_items").fieldNames()


def test_fact_is_the_same_when_a_third_of_the_lines_belong_to_one_order(retail):
    items = retail.silver("order_items")
    third = items.where("product_id % 3 = 0").selectExpr(
        "7L AS order_id", "CAST(order_id * 10 + order_item_id AS INT) AS order_item_id",
        "product_id", "seller_id", "price", "freight_value")
    items = items.where("product_id % 3 <> 0").select(third.columns).unionByName(third)
    rest = [retail.silver(n) for n in ("order_payments", "order_reviews")]
    hot = hot_slots(items, ["order_id"], share=0.01, min_piece=20)
    assert hot and max(pieces for _, pieces in hot) > 20
    orders = retail.silver("orders")
    assert rows(gold.fact_order_items(orders, items, *rest, hot)) == rows(
        gold.fact_order_items(orders, items, *rest))


def test_delivery_flags(shop):
    got = rows(shop["fact"].select("order_id", "delivery_days", "delay_flag", "on_time_flag")
               .distinct())
    assert got == [("o1", 1, 0, 1),      # a second after midnight is the next day
                   ("o2", 4, 0, 1),      # exactly at the estimate
                   ("o3", 8, 1, 0),
                   ("o4", None, None, None),
                   ("o5", 2, 0, 0)]      # delivered, no estimate


def test_unreviewed_score_is_zero_and_null_freight_gives_null_total(shop):
    assert rows(shop["fact"].where("order_id = 'o4'"), "review_score", "total_amount") == [
        (0.0, None)]


def test_seller_with_nothing_delivered_has_no_rate(shop):
    got = rows(gold.seller_performance(shop["fact"]), "seller_id", "on_time_delivery_rate",
               "total_orders")
    assert got == [("s1", 100.0, 2), ("s2", 0.0, 2), ("s3", None, 1)]


def test_summary_adds_up_to_the_fact(shop):
    want = shop["fact"].agg(F.sum("total_amount")).first()[0]
    got = gold.order_summary(shop["fact"]).agg(F.sum("total_amount")).first()[0]
    assert abs(got - want) < 1e-9


def test_order_value_differs_from_line_value(shop):
    per_line = dict(rows(gold.customer_metrics(shop["fact"]), "customer_id", "avg_order_value"))
    per_order = dict(rows(gold.order_value_per_customer(shop["fact"])))
    assert per_line["c1"] == 13.44 and per_order["c1"] == 26.88


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([("c1", "SP"), ("c2", "d'or"), ("c4", "RJ")],
                                 "customer_id string, customer_state string")


def test_filters_all_and_one_value_with_a_quote(shop, customers, spark):
    f = shop["fact"]
    both = [tuple(r) for r in kpi.revenue_by_state(f, customers).collect()]
    assert both == [("SP", 34.0, 1), ("d'or", 10.0, 1)]
    assert rows(kpi.revenue_by_state(f, customers, "d'or")) == [("d'or", 10.0, 1)]
    sql = kpi.run_sql(spark, kpi.STATE_REVENUE_SQL, {"low": 1, "high": 5, "state": "d'or"},
                      fact=f, customers=customers)
    assert rows(sql) == [("d'or", 10.0, 1)]
    everything = kpi.run_sql(spark, kpi.STATE_REVENUE_SQL, {"low": 0, "high": 5, "state": None},
                             fact=f, customers=customers)
    assert rows(everything) == rows(kpi.revenue_by_state(f, customers, low=0))


def test_sql_and_dataframe_status_agree(shop, spark):
    summary = gold.order_summary(shop["fact"])
    for status in (None, "shipped"):
        sql = kpi.run_sql(spark, kpi.STATUS_REVENUE_SQL, {"status": status}, order_summary=summary)
        assert rows(sql) == rows(kpi.revenue_by_status(summary, status).drop("grand_total"))


def test_overview_on_no_rows(shop, customers):
    got = kpi.overview(shop["fact"], customers, state="nowhere").first()
    assert got["total_orders"] == 0 and got["unique_customers"] == 0
    assert got["on_time_pct"] is None and got["delay_pct"] is None


def test_customers_without_a_dimension_row(shop, customers):
    assert rows(gold.unmatched_customers(shop["fact"], customers)) == [("c3", 1, 2.0)]


def test_pivot_fills_missing_pairs(shop):
    got = rows(kpi.delay_score_pivot(shop["fact"]))
    assert got == [(0, 0, 0, 0, 0, 3, 0), (1, 1, 0, 0, 0, 0, 0)]


def test_cohorts(spark):
    orders = spark.createDataFrame(
        [("a", "c1", datetime(2018, 1, 5)), ("b", "c1", datetime(2018, 1, 9)),
         ("c", "c1", datetime(2018, 3, 1)), ("d", "c2", datetime(2018, 1, 7)),
         ("e", "c3", datetime(2018, 12, 1)), ("f", "c3", datetime(2019, 1, 1))],
        "order_id string, customer_id string, order_purchase_timestamp timestamp")
    got = rows(cohorts.retention(orders), F.month("cohort"), "month_offset", "active_customers",
               "orders", "retention")
    assert got == [(1, 0, 2, 3, 1.0), (1, 2, 1, 1, 0.5), (12, 0, 1, 1, 1.0), (12, 1, 1, 1, 1.0)]


def test_category_totals_of_a_hot_product_equal_their_twin(spark):
    import duckdb

    from tidemart.testbed.oracle import CTES

    prod = [("p1", 10 ** 10, 1e12, 100.0, 4.5), ("p2", 3, 30.25, 10.08, 3.0),
            ("p3", 10 ** 13, 2e15 + 0.5, 200.0, 4.0), ("p4", 2, 999999999999.99, 5e11, None),
            ("p5", 1, None, None, 1.0)]
    dim = [("p1", "toys"), ("p2", "toys"), ("p3", None), ("p4", "books"), ("p5", "none")]
    kinds = ("product_id string, total_quantity bigint, total_sales double, avg_price double, "
             "avg_review_score double", "product_id string, product_category_name_english string")
    con = duckdb.connect()
    for name, kind, data in zip(("prod", "s_products"), kinds, (prod, dim)):
        con.execute(f"CREATE TABLE {name} ({kind})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(data[0]))})", data)
    frames = [spark.createDataFrame(data, kind) for data, kind in zip((prod, dim), kinds)]
    want = con.execute(CTES["categories"]).fetchall()
    assert [tuple(r) for r in kpi.category_performance(*frames).collect()] == want
    assert [tuple(r) for r in kpi.top12_categories(*frames).collect()] == want
    assert [r[1] for r in want] == [2e15 + 1, 1e12 + 30, 1e12, None]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_kpis_fold_the_fact_before_any_join(shop, customers, lake_dir, spark):
    shop["fact"].write.parquet(f"{lake_dir}/f")
    stored = spark.read.parquet(f"{lake_dir}/f")
    text = plan(kpi.revenue_by_state(stored, customers))
    join = next(i for i, line in enumerate(text.splitlines()) if "Join" in line)
    below = "\n".join(text.splitlines()[join:])
    assert "HashAggregate(keys=[customer_id" in below
    assert "ReadSchema: struct<order_id:string,customer_id:string,total_amount:double," \
           "review_score:double>" in text
    assert "PushedFilters: [IsNotNull(review_score), GreaterThanOrEqual(review_score" in text
    assert "TakeOrderedAndProject" in text


def test_unused_payments_are_not_read(retail):
    text = plan(kpi.monthly_revenue(retail.fact))
    assert "event_type" not in text and "PythonUDF" not in text


def test_no_query_uses_python_rows(retail):
    for df in (retail.fact, retail.order_summary, kpi.overview(retail.fact, retail.customers)):
        assert not {"ArrowEvalPython", "BatchEvalPython"} & set(plan(df).replace("(", " ").split())


def test_amounts_of_any_size_are_added(spark):
    from tidemart.functions.numbers import amount, exact
    tiny = spark.range(1_000_000).select(F.lit(4e-7).alias("x"))
    assert tiny.agg(amount(F.sum(exact("x")))).first()[0] == 0.4
    large = spark.createDataFrame([(1e12,), (1.0,), (2.0,), (1e13,), (None,), (float("nan"),)],
                                  "x double")
    assert large.agg(amount(F.sum(exact("x")))).first()[0] == 11e12 + 3
    with pytest.raises(Exception):
        spark.createDataFrame([(1e30,), (1.0,)], "x double").agg(F.sum(exact("x"))).collect()
    orders = spark.createDataFrame([("a", 2e12), ("a", 1e-7), ("b", 3.0)],
                                   "order_status string, total_amount double")
    assert rows(kpi.revenue_by_status(orders), "order_status", "revenue") == [
        ("a", 2e12), ("b", 3.0)]
    assert rows(kpi.run_sql(spark, kpi.STATUS_REVENUE_SQL, {"status": "a"},
                            order_summary=orders)) == [("a", 2e12)]


def test_a_score_outside_the_scale_is_counted(spark):
    fact = spark.createDataFrame([(6.0, 0, 3), (5.0, 0, 3), (5.0, 1, 2), (7.4, 1, 1)],
                                 "review_score double, delay_flag int, delivery_days int")
    assert rows(kpi.delay_score_pivot(fact), "delay_flag", "score_5", "score_other") == [
        (0, 1, 1), (1, 1, 1)]


def test_months_merge_to_exact_distinct_counts(spark, lake_dir):
    from tidemart.plans import months
    lines = [(i, i % 4, datetime(2018, 1 + i % 3, 5)) for i in range(12)] + [
        (100_000, 7, datetime(2018, 1, 9)), (100_000, 7, datetime(2018, 1, 9)),
        (-5, None, datetime(2019, 1, 9)), (9, 1, None)]
    fact = spark.createDataFrame(lines, "order_id long, customer_id long, "
                                 "purchase_timestamp timestamp").selectExpr(
        "*", "1.5D AS total_amount", "2 AS delivery_days", "1 AS on_time_flag",
        "0 AS delay_flag", "4.0D AS review_score")
    months.store_months(fact, lake_dir)
    months.store_months(fact.where("month(purchase_timestamp) = 1"), lake_dir)
    got = months.overview_months(spark, lake_dir, F.floor(F.col("month") / 100).cast("int"))
    assert rows(got, "period", "total_orders", "unique_customers", "total_revenue") == [
        (2018, 13, 5, 21.0), (2019, 1, 0, 2.0)]
    some = months.overview_months(spark, lake_dir, F.when(
        F.col("month").between(201801, 201802), "early"))
    assert rows(some, "total_orders", "unique_customers") == [(9, 5)]
    with pytest.raises(TypeError, match="integer ids"):
        months.month_ids(fact.withColumn("order_id", F.col("order_id").cast("string")))


def test_values_of_the_dashboard_are_never_text(spark, lake_dir):
    from tidemart.plans import dashboard
    from tidemart.sources.tables import database_at
    db = database_at(spark, lake_dir)
    from tidemart.specs import CONTRACT_DDL
    for name, ddl in CONTRACT_DDL.items():
        spark.createDataFrame([], ddl).write.saveAsTable(f"{db}.{name}")
    dashboard.install(spark, db)
    dashboard.install(spark, db)
    for name in dashboard.FUNCTIONS:
        assert dashboard.ask(spark, db, name).count() == (name == "overview")
    for value in ("D'OESTE", "x' OR '1'='1", "'; DROP TABLE t", "\\"):
        assert dashboard.ask(spark, db, "revenue_by_state", state=value).isEmpty()
    with pytest.raises(ValueError, match="unknown question"):
        dashboard.ask(spark, db, "x() UNION SELECT 1")
