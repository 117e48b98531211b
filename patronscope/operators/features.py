"""Customer features: recency, frequency, monetary value and behavior.

``customer_features`` builds the whole table in one chain. The single-feature functions
take the flat table (see ``joins.flat_table``) and make no assumption about its keys.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronscope.functions.columns import floor_days, from_money, money, most_common, ratio, union_all
from patronscope.operators import joins
from patronscope.schema import FEATURE_COLUMNS, RETURN_STATES
from patronscope.session import settle
from patronscope.sources.catalog import Tables, require

WHO = "customer_unique_id"
PURCHASED = "order_purchase_timestamp"
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"
CATEGORY = "product_category_name_english"


def returned(status: Column) -> Column:
    """An order with an unknown status is not a return."""
    return F.coalesce(status.isin(RETURN_STATES), F.lit(False))


def snapshot_frame(df: DataFrame) -> DataFrame:
    """One row: the day after the last purchase."""
    return df.agg((F.max(PURCHASED) + F.expr("INTERVAL '1' DAY")).alias("snapshot_date"))


def snapshot_column(df: DataFrame, snapshot: datetime | None = None) -> Column:
    """The snapshot as a scalar: given, or looked up by a one-row subquery."""
    if snapshot is not None:
        return F.lit(snapshot).cast("timestamp_ntz")
    return snapshot_frame(df).scalar()


# --- single features from the flat table ------------------------------------------------


def known_customers(df: DataFrame) -> DataFrame:
    return df.where(F.col(WHO).isNotNull())


def order_totals(flat: DataFrame) -> DataFrame:
    """Price and freight per (order, customer, purchase time); nothing to add gives 0."""
    keys = ["order_id", WHO, PURCHASED]
    units = flat.dropna(subset=keys).groupBy(*keys).agg(
        F.coalesce(F.sum(money(F.col("price"))), F.lit(0)).alias("price_units"),
        F.coalesce(F.sum(money(F.col("freight_value"))), F.lit(0)).alias("freight_units"),
    )
    return units.select(
        *keys,
        from_money(F.col("price_units")).alias("order_total"),
        from_money(F.col("freight_units")).alias("order_freight"),
        from_money(F.col("price_units") + F.col("freight_units")).alias("order_total_with_freight"),
    )


def rfm(flat: DataFrame, snapshot: datetime | None = None, dated: DataFrame | None = None) -> DataFrame:
    """Recency, frequency, monetary value and average order value. ``dated``: the orders, if they are at hand without their items."""
    # Orders are counted at order grain first, so a customer with very many items is
    # reduced before the second shuffle.
    orders = flat.dropna(subset=["order_id", WHO, PURCHASED]).groupBy(WHO, "order_id").agg(
        F.max(PURCHASED).alias("last_ts"),
        F.sum(
            F.coalesce(money(F.col("price")), F.lit(0)) + F.coalesce(money(F.col("freight_value")), F.lit(0))
        ).alias("units"),
    )
    customers = orders.groupBy(WHO).agg(
        F.max("last_ts").alias("last_ts"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("units").alias("units"),
    )
    monetary = from_money(F.col("units"))
    return customers.select(
        WHO,
        floor_days(F.col("last_ts"), snapshot_column(flat if dated is None else dated, snapshot)).alias("recency"),
        "frequency",
        monetary.alias("monetary"),
        (monetary / F.col("frequency")).alias("avg_order_value"),
    )


def _favorite(df: DataFrame, value: str, name: str) -> DataFrame:
    counted = known_customers(df).groupBy(WHO, value).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(WHO).agg(most_common(F.col(value), F.col("n")).alias(name))


def preferred_category(flat: DataFrame) -> DataFrame:
    """Most frequent English category over items, ties to the smallest name."""
    return _favorite(flat, CATEGORY, "preferred_category")


def category_diversity(flat: DataFrame) -> DataFrame:
    kinds = known_customers(flat).groupBy(WHO, CATEGORY).agg(F.count(F.lit(1)).alias("n"))
    return kinds.groupBy(WHO).agg(F.count(CATEGORY).alias("category_diversity"))


def area(flat: DataFrame) -> DataFrame:
    """State and city of the earliest order that has one; undated orders come last."""

    def earliest(c: str) -> Column:
        order = F.struct(F.col(PURCHASED).isNull(), PURCHASED, "order_id", c)
        return F.min(F.when(F.col(c).isNotNull(), order))[c].alias(c)

    return known_customers(flat).groupBy(WHO).agg(earliest("customer_state"), earliest("customer_city"))


def return_rate(flat: DataFrame) -> DataFrame:
    """Share of a customer's orders that were canceled or unavailable."""
    orders = flat.dropna(subset=[WHO, "order_id"]).groupBy(WHO, "order_id").agg(
        F.min("order_status").alias("order_status")
    )
    return orders.groupBy(WHO).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(returned(F.col("order_status"))).alias("problematic_orders"),
    ).withColumn("return_rate", F.col("problematic_orders") / F.col("total_orders"))


def preferred_channel(payments: DataFrame) -> DataFrame:
    """Most frequent payment type; ``payments`` carries the customer."""
    return _favorite(payments, "payment_type", "preferred_channel")


def avg_installments(payments: DataFrame) -> DataFrame:
    return known_customers(payments).groupBy(WHO).agg(F.avg("payment_installments").alias("avg_installments"))


def avg_review_score(reviews: DataFrame) -> DataFrame:
    return known_customers(reviews).groupBy(WHO).agg(F.avg("review_score").alias("avg_review_score"))


def delivery(flat: DataFrame) -> DataFrame:
    """Mean days late (+) or early (-) and mean days to deliver, weighted by items."""
    return known_customers(flat).groupBy(WHO).agg(
        F.avg(floor_days(F.col(ESTIMATED), F.col(DELIVERED))).alias("delivery_delay"),
        F.avg(floor_days(F.col(PURCHASED), F.col(DELIVERED))).alias("avg_delivery_time"),
    )


def freight_ratio(flat: DataFrame) -> DataFrame:
    return known_customers(flat).groupBy(WHO).agg(
        F.avg(ratio(F.col("freight_value"), F.col("price"))).alias("avg_freight_ratio")
    )


def tenure(flat: DataFrame) -> DataFrame:
    return known_customers(flat).groupBy(WHO).agg(
        floor_days(F.min(PURCHASED), F.max(PURCHASED)).alias("tenure_days")
    )


def features_from_flat(tables: Tables, snapshot: datetime | None = None) -> DataFrame:
    """The feature table by joining the single features; works for repeated order ids.

    Each feature reads the smallest join that has its columns, and each join is written once for all that read it.
    """
    orders = settle(joins.orders_with_customers(tables).select(
        "order_id", WHO, "order_status", PURCHASED, DELIVERED, ESTIMATED, "customer_state", "customer_city"
    ), "orders")
    items = settle(
        orders.drop("order_status", "customer_state", "customer_city")
        .join(tables["order_items"].select("order_id", "product_id", "price", "freight_value"), "order_id", "left"), "items",
    )
    kinds = settle(items.select(WHO, "product_id").join(joins.product_names(tables), "product_id", "left").select(WHO, CATEGORY), "kinds")
    customers = orders.select("order_id", WHO).distinct()
    payments = settle(tables["order_payments"].select("order_id", "payment_type", "payment_installments").join(customers, "order_id", "left"), "payments")
    reviews = tables["order_reviews"].select("order_id", "review_score").join(customers, "order_id", "left")
    out = rfm(items, snapshot, orders)
    for part in (
        preferred_category(kinds), area(orders), return_rate(orders).select(WHO, "return_rate"),
        preferred_channel(payments), avg_installments(payments), avg_review_score(reviews),
        delivery(items), freight_ratio(items), category_diversity(kinds), tenure(orders),
    ):
        out = out.join(part, WHO, "left")
    return out.select(*FEATURE_COLUMNS)


# --- the whole table in one chain -------------------------------------------------------

ITEM, PAYMENT = 0, 1


def value_ids(tables: Tables) -> DataFrame:
    """(text, id) of all English categories and payment types, written once; ids are in the order of the texts."""
    texts = union_all(
        [
            tables["category_name_translation"].select(F.col(CATEGORY).cast("string").alias("text")),
            tables["order_payments"].select(F.col("payment_type").cast("string").alias("text")),
        ]
    )
    ids = texts.where(F.col("text").isNotNull()).distinct().orderBy("text")
    return settle(ids.select("text", F.monotonically_increasing_id().alias("id")), "values")


def order_values(tables: Tables, ids: DataFrame) -> DataFrame:
    """The id of the English category of each item and of the type of each payment; those without one are left out."""
    names = joins.product_names(tables).join(ids, F.col(CATEGORY).cast("string") == F.col("text"))
    items = tables["order_items"].select("order_id", "product_id").join(names.select("product_id", "id"), "product_id")
    payments = tables["order_payments"].join(ids, F.col("payment_type").cast("string") == F.col("text"))
    return union_all([df.select("order_id", F.lit(kind).alias("kind"), F.col("id").alias("value")) for df, kind in ((items, ITEM), (payments, PAYMENT))])


def order_sums(tables: Tables) -> list[DataFrame]:
    """Sums and counts per order over items, over payments and over reviews.

    A product that is listed n times counts its items n times, as their join would.
    """
    require(tables, "order_items", "order_payments", "order_reviews")
    listed = joins.product_names(tables).groupBy("product_id").agg(F.count(F.lit(1)).alias("listed"))
    repeated = settle(listed.where("listed > 1"), "repeated")  # as a rule empty, so that no item is moved for it
    n = F.coalesce(F.col("listed"), F.lit(1))
    price, freight = (F.coalesce(money(F.col(c)), F.lit(0)) for c in ("price", "freight_value"))
    share = ratio(F.col("freight_value"), F.col("price"))
    installments, score = (F.col(c).cast("double") for c in ("payment_installments", "review_score"))
    return [
        tables["order_items"].join(repeated, "product_id", "left").groupBy("order_id").agg(
            F.sum(n).alias("items"),
            F.sum((price + freight) * n).alias("units"),
            F.sum(share * n).alias("shares"),
            F.sum(F.when(share.isNotNull(), n)).alias("shared"),
        ),
        tables["order_payments"].groupBy("order_id").agg(F.sum(installments).alias("installments"), F.count(installments).alias("paid")),
        tables["order_reviews"].groupBy("order_id").agg(F.sum(score).alias("scores"), F.count(score).alias("scored")),
    ]


def customer_features(tables: Tables, snapshot: datetime | None = None) -> DataFrame:
    """The 17-column feature table, one row per customer with a dated order.

    Order ids and per-order customer ids must be unique (``audit.duplicate_keys`` tells);
    otherwise use ``features_from_flat``.

    The orders with their customers are written once. All that is summed is reduced to one row per order, on the map side
    first, before it meets them. Only numbers of categories and payment types travel one by one: they meet their orders in one
    inner join, whose hot keys adaptive execution splits, and are counted per (customer, kind, value) and then per customer.
    """
    placed = tables["orders"].select(
        "order_id", "customer_id", PURCHASED,
        returned(F.col("order_status")).alias("returned"),
        floor_days(F.col(ESTIMATED), F.col(DELIVERED)).alias("delay"),
        floor_days(F.col(PURCHASED), F.col(DELIVERED)).alias("days"),
    )
    orders = settle(
        joins.orders_with_customers({**tables, "orders": placed})
        .where(F.col(WHO).isNotNull())
        .select("order_id", WHO, PURCHASED, "customer_state", "customer_city", "returned", "delay", "days"),
        "orders",
    )
    per_order = orders
    for sums in order_sums(tables):
        per_order = per_order.join(sums, "order_id", "left")

    # delivery days count once per item row, and once for an order without items
    weight = F.coalesce(F.col("items"), F.lit(1))
    totals = per_order.groupBy(WHO).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count(PURCHASED).alias("frequency"),
        F.count_if("returned").alias("returned_orders"),
        F.min(PURCHASED).alias("first_ts"),
        F.max(PURCHASED).alias("last_ts"),
        F.coalesce(F.sum(F.when(F.col(PURCHASED).isNotNull(), F.col("units"))), F.lit(0)).alias("units"),
        *[
            ratio(F.sum(F.col(c) * weight), F.sum(F.when(F.col(c).isNotNull(), weight)).cast("double")).alias(name)
            for c, name in (("delay", "delivery_delay"), ("days", "avg_delivery_time"))
        ],
        *[
            ratio(F.sum(c), F.sum(n).cast("double")).alias(name)
            for c, n, name in (
                ("shares", "shared", "avg_freight_ratio"), ("installments", "paid", "avg_installments"), ("scores", "scored", "avg_review_score"),
            )
        ],
    ).where("frequency > 0")

    # the table of all values keeps plain numbers, which Spark hashes instead of sorting
    ids = value_ids(tables)
    counted = order_values(tables, ids).join(orders.select("order_id", WHO), "order_id").groupBy(WHO, "kind", "value").agg(F.count(F.lit(1)).alias("n"))

    def of(kind: int, c: Column) -> Column:
        return F.when(F.col("kind") == kind, c)

    rank = F.struct((-F.col("n")).alias("n"), "value")
    favorites = counted.groupBy(WHO).agg(
        F.min(of(ITEM, rank))["value"].alias("category"),
        F.count(of(ITEM, F.col("value"))).alias("kinds"),
        F.min(of(PAYMENT, rank))["value"].alias("channel"),
    )

    def named(df: DataFrame, c: str, name: str) -> DataFrame:
        return df.join(ids.select(F.col("id").alias(c), F.col("text").alias(name)), c, "left")

    out = totals.join(favorites, WHO, "left").join(area(orders), WHO, "left")
    out = named(named(out, "category", "preferred_category"), "channel", "preferred_channel")
    monetary = from_money(F.col("units"))
    return out.select(
        WHO,
        floor_days(F.col("last_ts"), snapshot_column(tables["orders"], snapshot)).alias("recency"),
        "frequency",
        monetary.alias("monetary"),
        (monetary / F.col("frequency")).alias("avg_order_value"),
        "preferred_category", "customer_state", "customer_city",
        (F.col("returned_orders") / F.col("orders")).alias("return_rate"),
        "preferred_channel", "avg_installments", "avg_review_score",
        "delivery_delay", "avg_delivery_time", "avg_freight_ratio",
        F.coalesce(F.col("kinds"), F.lit(0)).alias("category_diversity"),
        floor_days(F.col("first_ts"), F.col("last_ts")).alias("tenure_days"),
    ).select(*FEATURE_COLUMNS)
