"""Features, chart tables and quantiles on small frames."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import adapter
from patronscope.functions.quantiles import exact_quantiles, sorted_quantiles
from patronscope.functions.sampling import fixed_sample
from patronscope.operators import charts, features, joins
from patronscope.plans import pipeline

T0 = "2020-01-01 00:00:00"


def tiny(spark, orders, items=(), payments=(), reviews=()):
    """Orders are (order, person, status, purchased, delivered, estimated, state)."""

    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    times = "order_purchase_timestamp string, order_delivered_customer_date string, order_estimated_delivery_date string"
    o = frame([(a, f"c{a}", s, p, d, e) for a, _, s, p, d, e, _ in orders], f"order_id string, customer_id string, order_status string, {times}")
    for c in ("order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"):
        o = o.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return {
        "orders": o,
        "customers": frame(
            [(f"c{a}", w, st, None if st is None else f"{st} city") for a, w, _, _, _, _, st in orders],
            "customer_id string, customer_unique_id string, customer_state string, customer_city string",
        ),
        "order_items": frame(items, "order_id string, order_item_id int, product_id string, price double, freight_value double, seller_id string"),
        "products": frame([("p1", "x"), ("p2", "y"), ("p3", None)], "product_id string, product_category_name string"),
        "category_name_translation": frame([("x", "ex"), ("y", "ey")], "product_category_name string, product_category_name_english string"),
        "order_payments": frame(payments, "order_id string, payment_type string, payment_installments int"),
        "order_reviews": frame(reviews, "order_id string, review_score int"),
    }


@pytest.fixture
def shop(spark):
    return tiny(
        spark,
        [
            ("o1", "ann", "delivered", T0, "2020-01-05 12:00:00", "2020-01-06 00:00:00", None),
            ("o2", "ann", "canceled", "2020-02-01 10:00:00", None, "2020-02-09 00:00:00", "sp"),
            ("o3", "ann", None, None, None, None, "rj"),
            ("o4", "bob", "delivered", "2020-03-01 00:00:00", "2020-03-04 00:00:00", "2020-03-03 00:00:00", "mg"),
            ("o5", "cat", "unavailable", None, None, None, "sp"),
            ("o6", None, "delivered", "2020-05-01 00:00:00", None, None, "sp"),
        ],
        [
            ("o1", 1, "p2", 10.0, 1.0, "s"), ("o1", 2, "p1", 0.0, 2.0, "s"), ("o1", 3, "p3", 5.5, None, "s"),
            ("o3", 1, "p1", 100.0, 1.0, "s"), ("o6", 1, "p1", 1.0, 1.0, "s"),
        ],
        [("o1", "voucher", 1), ("o1", "boleto", 2), ("o2", None, 4), ("zz", "card", 9), ("o4", "card", 3)],
        [("o1", 5), ("o1", None), ("o3", 2), ("zz", 1)],
    )


def rows(df):
    return {r.customer_unique_id: r.asDict() for r in df.collect()}


def test_feature_rules(shop):
    got = rows(features.customer_features(shop))
    assert set(got) == {"ann", "bob"}  # cat has no dated order, o6 no customer
    ann, bob = got["ann"], got["bob"]
    # the snapshot is 2020-05-02, a day after the last purchase of anyone
    assert (ann["recency"], ann["frequency"], ann["tenure_days"]) == (90, 2, 31)
    assert ann["monetary"] == 18.5 and ann["avg_order_value"] == 9.25  # undated o3 is not counted
    assert ann["preferred_category"] == "ex"  # p1 in o1 and in o3
    assert ann["category_diversity"] == 2
    assert (ann["customer_state"], ann["customer_city"]) == ("sp", "sp city")  # o1 has none
    assert ann["return_rate"] == pytest.approx(1 / 3)
    assert ann["preferred_channel"] == "boleto"  # tie, smallest name
    assert ann["avg_installments"] == pytest.approx(7 / 3)
    assert ann["avg_review_score"] == 3.5
    assert ann["delivery_delay"] == -1.0 and ann["avg_delivery_time"] == 4.0
    assert ann["avg_freight_ratio"] == pytest.approx((0.1 + 0.01) / 2)
    # bob has no items, review or category
    assert (bob["monetary"], bob["preferred_category"], bob["category_diversity"]) == (0.0, None, 0)
    assert (bob["avg_review_score"], bob["avg_freight_ratio"], bob["delivery_delay"]) == (None, None, 1.0)


def test_one_chain_equals_flat_definition(shop):
    a, b = rows(features.customer_features(shop)), rows(features.features_from_flat(shop))
    assert set(a) == set(b)
    for who in a:
        for c, v in a[who].items():
            assert v == pytest.approx(b[who][c]) if isinstance(v, float) else v == b[who][c], (who, c)


def test_random_shops_agree(spark):
    rng = random.Random(5)
    orders, items, payments, reviews = [], [], [], []
    for i in range(300):
        who = "hot" if i % 3 == 0 else f"w{rng.randrange(40)}"  # one customer holds a third
        bought = None if rng.random() < 0.1 else f"2020-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d} {rng.randrange(24):02d}:00:00"
        came = None if bought is None or rng.random() < 0.3 else f"2021-01-{rng.randrange(1, 28):02d} {rng.randrange(24):02d}:30:00"
        orders.append((f"o{i}", who, rng.choice(["delivered", "canceled", None]), bought, came, "2021-01-10 00:00:00", rng.choice([None, "sp", "rj"])))
        # one order holds a third of all items
        for j in range(150 if i == 0 else rng.randrange(3)):
            items.append((f"o{i}", j, rng.choice(["p1", "p2", "p3", "p9"]), rng.choice([0.0, 10.25, 3.99, None]), rng.choice([1.5, 2.0, None]), "s"))
        payments += [(f"o{i}", rng.choice(["a", "b", None]), rng.choice([1, 2, None])) for _ in range(rng.randrange(3))]
        reviews += [(f"o{i}", rng.choice([1, 5, None])) for _ in range(rng.randrange(3))]
    shop = tiny(spark, orders, items, payments, reviews)
    a, b = rows(features.customer_features(shop)), rows(features.features_from_flat(shop))
    assert set(a) == set(b)
    for who in a:
        for c, v in a[who].items():
            assert v == pytest.approx(b[who][c]) if isinstance(v, float) else v == b[who][c], (who, c)


def test_values_are_hashed_as_plain_numbers(shop):
    """Texts of an order in the rows of its values would be shuffled once for each, and make Spark sort them."""
    plan = features.customer_features(shop)._jdf.queryExecution().sparkPlan().toString()
    steps = [s for s in plan.splitlines() if "Aggregate(" in s and all(k in s.split("functions=")[0] for k in ("kind#", "customer_unique_id#"))]
    assert steps and all("HashAggregate(" in s and "customer_city" not in s for s in steps)


def test_repeated_order_ids_use_the_flat_plan(spark, shop):
    twice = {**shop, "orders": shop["orders"].unionByName(shop["orders"].where("order_id = 'o4'"))}
    got = rows(pipeline.build_features(twice))
    assert got["bob"]["frequency"] == 1


def test_order_totals_of_nothing_are_zero(shop):
    totals = {r.order_id: r.order_total_with_freight for r in features.order_totals(joins.flat_table(shop)).collect()}
    assert totals == {"o1": 18.5, "o2": 0.0, "o4": 0.0}


def test_months_without_orders(shop):
    got = [(str(r.month), r.n) for r in charts.monthly_orders(shop).collect()]
    assert got == [("2020-01-01", 1), ("2020-02-01", 1), ("2020-03-01", 1), ("2020-04-01", 0), ("2020-05-01", 1)]


def test_top_values_ties(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccd"] + [(None,)], "v string")
    assert [tuple(r) for r in charts.top_values(df, "v", 2).collect()] == [("a", 2), ("b", 2)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 39, 40, 40]] + [(None,)], "v double")
    got = {r.bin: r.n for r in charts.histogram(df, "v").collect()}
    assert len(got) == 40 and (got[0], got[1], got[38], got[39]) == (1, 1, 0, 3)
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [tuple(r)[:1] + (r.n,) for r in charts.histogram(same, "v").collect()] == [(0, 2)]
    assert charts.histogram(df.where("v > 99"), "v").count() == 0


def test_correlations(spark):
    data = pd.DataFrame({"a": [1, 2, 3, None, 5], "b": [2, 1, None, 4, 8], "c": [1, 1, 1, 1, 1]}, dtype=float)
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in data.to_numpy()], "a double, b double, c double")
    got = {(r.feature_x, r.feature_y): r.r for r in charts.correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(data.corr().loc["a", "b"]) and got["a", "b"] == got["b", "a"]
    assert got["a", "c"] is None and got["a", "a"] == pytest.approx(1)


def test_sample_size(spark):
    df = spark.range(50)
    assert fixed_sample(df, ["id"], 3000, 1).count() == 50
    first = [r.id for r in fixed_sample(df, ["id"], 10, 1).collect()]
    assert first == [r.id for r in fixed_sample(df.repartition(7), ["id"], 10, 1).collect()]
    assert first != [r.id for r in fixed_sample(df, ["id"], 10, 2).collect()]
    assert fixed_sample(df.where("id < 0"), ["id"], 10, 1).count() == 0


def test_sample_rows(spark):
    """The rows of least digest, repeated rows included."""
    ids = [i // 2 for i in range(1000)]
    plain = sorted(ids, key=lambda i: hashlib.md5(f"{i}-1".encode()).hexdigest())
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    for size in (1, 9, 500, 1000):
        assert [r.id for r in fixed_sample(df, ["id"], size, 1).collect()] == plain[:size]


@pytest.mark.parametrize("seed", range(3))
def test_quantile_search(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.lognormal(3, 2, 3000), np.full(2000, 7.0), -rng.integers(0, 5, 1000)])
    df = spark.createDataFrame([(float(v), float(i % 11)) for i, v in enumerate(values)] + [(None, None)], "v double, w double")
    wanted = {"v": [0.0, 0.01, 0.25, 0.5, 0.99, 1.0], "w": [0.5, 0.999]}
    got = exact_quantiles(df.repartition(5), wanted)
    assert got["v"] == pytest.approx(list(np.quantile(values, wanted["v"])), rel=1e-12)
    assert got["w"] == pytest.approx(list(np.quantile([i % 11 for i in range(len(values))], wanted["w"])))
    assert exact_quantiles(df.where("v is null"), {"v": [0.5]}) == {"v": [None]}


def test_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    values = [-0.0, 0.0, 5e-324, -5e-324, 1.5, -1.5, inf, -inf, 1e308, -1e308, 2.0**53, 2.0**53 + 2, nan]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, n int").repartition(3)
    places = [i / (len(values) - 1) for i in range(len(values))]
    got = exact_quantiles(df, {"v": places, "n": [0.5]})
    assert [repr(v) for v in got["v"][:-1]] == [repr(v + 0.0) for v in sorted(values[:-1])] and np.isnan(got["v"][-1])
    assert got["n"] == [6.0] and exact_quantiles(df, {}) == {}
    near = [1.0 + i * 2.0**-52 for i in range(300)]  # differ in the last digit only
    close = spark.createDataFrame([(v,) for v in near], "v double")
    assert exact_quantiles(close, {"v": [0.0, 0.5, 1.0]})["v"] == [near[0], (near[149] + near[150]) / 2, near[-1]]


def test_quantiles_by_sorting(spark):
    values = [None, float("nan"), -0.0, 0.0, 3.5, 3.5, 3.5, -7.0, 1e300, float("-inf"), 2.0]
    df = spark.createDataFrame([(v, None) for v in values * 3], "x double, y double")
    ps = [0.0, 0.1, 0.25, 0.5, 0.77, 0.9]
    wanted = {"x": ps, "y": [0.5]}
    direct = df.agg(F.percentile("x", F.array(*map(F.lit, ps))).alias("x")).first()["x"]
    got = sorted_quantiles(df, wanted)
    assert got["y"] == [None] and np.array_equal(got["x"], direct, equal_nan=True)
    assert np.array_equal(got["x"], exact_quantiles(df, wanted)["x"], equal_nan=True)


def test_plan_reads_only_needed_columns(spark):
    t = adapter.tables(spark, "/root/testdata/sf0.001")
    plan = features.customer_features(t)._jdf.queryExecution().executedPlan().toString()
    assert "review_comment" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_values_meet_their_orders_without_a_window(spark):
    """A window over the values of an order shuffles all of them a second time and sorts them."""
    plan = features.customer_features(adapter.tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_orders_without_items_count_their_days_once(spark):
    late = "2020-01-06 00:00:00"
    shop = tiny(
        spark,
        [("o1", "ann", "delivered", "2020-01-01 00:00:00", late, "2020-01-02 00:00:00", "sp"),
         ("o2", "ann", "delivered", "2020-01-01 00:00:00", "2020-01-03 00:00:00", "2020-01-02 00:00:00", "sp")],
        [("o2", 0, "p1", 1.0, 1.0, "s"), ("o2", 1, "p1", 1.0, 1.0, "s"), ("o2", 2, "p9", None, 1.0, "s")],
        [("o1", "a", 1), ("o1", "b", 3), ("o2", "a", 2)], [("o1", 4), ("o1", 5)],
    )
    ann = rows(features.customer_features(shop))["ann"]
    assert (ann["frequency"], ann["monetary"]) == (2, 5.0)
    assert ann["delivery_delay"] == pytest.approx((4 + 3 * 1) / 4) and ann["avg_delivery_time"] == pytest.approx((5 + 3 * 2) / 4)
    assert (ann["avg_installments"], ann["avg_review_score"], ann["preferred_channel"]) == (2.0, 4.5, "a")


def test_values_travel_as_numbers_and_are_only_counted(shop):
    """Texts and sums in the rows that are shuffled per value were most of the MB that the table moved."""
    plan = features.customer_features(shop)._jdf.queryExecution().sparkPlan().toString()
    steps = [s for s in plan.splitlines() if "Aggregate(" in s and re.search(r"keys=\[customer_unique_id#\d+, kind#\d+, value#\d+", s)]
    assert steps
    for s in steps:
        assert re.search(r"value#\d+L", s) and re.search(r"functions=\[(partial_)?count\(1\)\]", s), s


def test_sums_have_one_row_per_order(shop):
    got = [df.orderBy("order_id").collect() for df in features.order_sums(shop)]
    assert [tuple(r) for r in got[0]] == [
        ("o1", 3, 185_000, 0.1, 1), ("o3", 1, 1_010_000, 0.01, 1), ("o6", 1, 20_000, 1.0, 1),
    ]
    assert [tuple(r) for r in got[1]] == [("o1", 3.0, 2), ("o2", 4.0, 1), ("o4", 3.0, 1), ("zz", 9.0, 1)]
    assert [tuple(r) for r in got[2]] == [("o1", 5.0, 1), ("o3", 2.0, 1), ("zz", 1.0, 1)]


def test_numbers_of_values_keep_the_order_of_their_texts(spark, shop):
    names = [f"n{i:03d}" for i in range(300)] + [None, "Z", "é", ""]
    random.Random(1).shuffle(names)
    payments = spark.createDataFrame([("o1", n) for n in names * 2], "order_id string, payment_type string").repartition(5)
    got = features.value_ids({**shop, "order_payments": payments}).orderBy("id").collect()
    assert [r.text for r in got] == sorted({*names, "ex", "ey"} - {None}, key=lambda t: t.encode())
    assert len({r.id for r in got}) == len(got)


def test_repeated_products_count_as_their_join_does(spark, shop):
    """A product listed twice doubles its items, in sums and in counts; without a category it has no say in the favorite."""
    more = spark.createDataFrame([("p1", "y"), ("p1", None), ("p3", None)], "product_id string, product_category_name string")
    twice = {**shop, "products": shop["products"].unionByName(more)}
    ann = rows(features.customer_features(twice))["ann"]
    assert ann["monetary"] == pytest.approx(11.0 + 3 * 2.0 + 2 * 5.5)
    assert (ann["preferred_category"], ann["category_diversity"]) == ("ey", 2)  # ey 1 + 2, ex 2
    assert ann["avg_freight_ratio"] == pytest.approx((0.1 + 3 * 0.01) / 4)
