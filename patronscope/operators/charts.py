"""The tables behind the exploratory charts.

Counts are ordered by count descending, then value ascending. Nulls are not counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronscope.functions.columns import clip, union_all
from patronscope.functions.quantiles import exact_quantiles
from patronscope.functions.sampling import fixed_sample
from patronscope.operators import joins
from patronscope.operators.clean import delivery_days
from patronscope.schema import NUMERIC_FEATURES
from patronscope.sources.catalog import Tables

BINS = 40
TOP = 10
SCATTER_ROWS = 3_000
SCATTER_SEED = 1
#: Rows, sums and squares of the first and the second column and their products, over rows where both are known.
PARTS = ["n", "x", "y", "xx", "yy", "xy"]
#: A squared deviation below this part of the sum of squares is rounding: the column is constant.
NO_SPREAD = 1e-12


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def ranked(counts: DataFrame, column: str) -> DataFrame:
    return counts.orderBy(F.desc("n"), column)


def top_values(df: DataFrame, column: str, size: int = TOP) -> DataFrame:
    return ranked(value_counts(df, column), column).limit(size)


def with_share(counts: DataFrame, scale: float = 1.0) -> DataFrame:
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.lit(scale) * F.col("n") / total)


def histogram(df: DataFrame, column: str, bins: int = BINS, bounds: tuple | None = None) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are listed.

    If all values are equal everything falls into bin 0. ``bounds`` are min and max where they are known.
    """
    spark = df.sparkSession
    low, high = bounds or df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return spark.createDataFrame([], "bin long, bin_start double, bin_end double, n long")
    low, high = float(low), float(high)
    value = F.col(column).cast("double")
    if high > low:
        number = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("long")
    else:
        number = F.lit(0).cast("long")
    counts = df.where(F.col(column).isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (high - low) / bins
    return (
        spark.range(bins if high > low else 1)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).alias("bin_start"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        )
        .orderBy("bin")
    )


def clipped_histogram(df: DataFrame, column: str, p: float = 0.99, bins: int = BINS) -> DataFrame:
    low, upper = exact_quantiles(df, {column: [0.0, p]})[column]
    return histogram(df.select(clip(F.col(column), upper=upper).alias(column)), column, bins, (low, upper))


# --- tables over the cleaned data -------------------------------------------------------


def order_status(tables: Tables) -> DataFrame:
    return ranked(value_counts(tables["orders"], "order_status"), "order_status")


def review_scores(tables: Tables) -> DataFrame:
    return value_counts(tables["order_reviews"], "review_score").orderBy("review_score")


def monthly_orders(tables: Tables) -> DataFrame:
    """Orders per calendar month; months without orders between the first and last are 0."""
    counts = (
        tables["orders"]
        .where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(F.trunc(F.col("order_purchase_timestamp").cast("date"), "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    spine = counts.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null").select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL '1' MONTH"))).alias("month")
    )
    return (
        spine.join(counts, "month", "left")
        .select("month", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
        .orderBy("month")
    )


def top_states(df: DataFrame) -> DataFrame:
    return top_values(df, "customer_state")


def category_counts(tables: Tables) -> DataFrame:
    """Items per English category. Items are counted per product before the join, so a
    product with a large share of the items is one row there."""
    per_product = tables["order_items"].groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_product.join(joins.product_names(tables), "product_id")
        .where(F.col("product_category_name_english").isNotNull())
        .groupBy("product_category_name_english")
        .agg(F.sum("n").alias("n"))
    )


def top_categories(tables: Tables, size: int = TOP) -> DataFrame:
    name = "product_category_name_english"
    return ranked(category_counts(tables), name).limit(size)


def top_category_items(tables: Tables) -> DataFrame:
    """Items of the categories with most items."""
    name = "product_category_name_english"
    return joins.items_with_categories(tables).join(top_categories(tables).select(name), name, "left_semi")


def payment_types(tables: Tables) -> DataFrame:
    shares = with_share(value_counts(tables["order_payments"], "payment_type"), 100.0)
    return ranked(shares, "payment_type")


def installments(tables: Tables) -> DataFrame:
    return value_counts(tables["order_payments"], "payment_installments").orderBy("payment_installments")


def price_histogram(tables: Tables) -> DataFrame:
    return clipped_histogram(tables["order_items"], "price")


def price_freight_sample(tables: Tables, size: int = SCATTER_ROWS, seed: int = SCATTER_SEED) -> DataFrame:
    keys = ["order_id", "order_item_id"]
    return fixed_sample(tables["order_items"].select(*keys, "price", "freight_value"), keys, size, seed)


def delivery_histogram(tables: Tables) -> DataFrame:
    """Whole days from purchase to delivery, 0 to 60."""
    return histogram(delivery_days(tables["orders"]), "days")


def top_sellers(tables: Tables) -> DataFrame:
    top = top_values(tables["order_items"], "seller_id")
    place = F.row_number().over(Window.orderBy(F.desc("n"), "seller_id"))  # over ten rows
    return top.withColumn("rank_label", F.concat(F.lit("S"), place.cast("string")))


def top_category_scores(tables: Tables) -> DataFrame:
    """Mean review score of the ten categories with most items, lowest first.

    Reviews are averaged over items. Reviews, orders and items are counted per order
    before they are joined, so no join repeats a key on both sides.
    """
    name = "product_category_name_english"
    chosen = top_categories(tables).select(name)
    items = (
        tables["order_items"].select("order_id", "product_id")
        .join(joins.product_names(tables).join(chosen, name, "left_semi"), "product_id")
        .groupBy("order_id", name)
        .agg(F.count(F.lit(1)).alias("items"))
    )
    reviews = tables["order_reviews"].groupBy("order_id").agg(
        F.sum("review_score").alias("score"), F.count("review_score").alias("scored")
    )
    orders = tables["orders"].groupBy("order_id").agg(F.count(F.lit(1)).alias("orders"))
    weight = F.col("items") * F.col("orders")
    return (
        items.join(reviews, "order_id").join(orders, "order_id")
        .groupBy(name)
        .agg(F.sum(weight * F.col("score")).alias("score"), F.sum(weight * F.col("scored")).alias("scored"))
        .select(name, F.try_divide(F.col("score").cast("double"), F.col("scored")).alias("avg_review_score"))
        .orderBy("avg_review_score", name)
    )


def eda_tables(tables: Tables) -> dict[str, DataFrame]:
    return {
        "order_status": order_status(tables),
        "review_scores": review_scores(tables),
        "monthly_orders": monthly_orders(tables),
        "top_states": top_states(tables["customers"]),
        "top_categories": top_categories(tables),
        "payment_types": payment_types(tables),
        "installments": installments(tables),
        "price_histogram": price_histogram(tables),
        "price_freight_sample": price_freight_sample(tables),
        "delivery_histogram": delivery_histogram(tables),
        "top_sellers": top_sellers(tables),
        "top_category_scores": top_category_scores(tables),
    }


# --- tables over the customer features --------------------------------------------------


def correlations(features: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """(feature_x, feature_y, r) over rows where both are known; null for a constant.

    Every task adds up masked moment matrices of its rows (counts, sums, squares and cross products of each pair,
    over rows where both are known), shifted by the column means. Only these matrices are shuffled.
    """
    size = len(columns)
    values = features.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    means = values.agg(*[F.avg(c) for c in values.columns]).first()
    origin = np.array([0.0 if m is None else m for m in means])

    def moments(batches):
        total = np.zeros((6, size, size))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            x = np.where(known > 0, x - origin, 0.0)
            total += np.stack([known.T @ known, x.T @ known, known.T @ x, (x * x).T @ known, known.T @ (x * x), x.T @ x])
        at = np.indices((size, size)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([*map(pa.array, at.astype(np.int32)), *map(pa.array, total.reshape(6, -1))], ["i", "j", *PARTS])

    parts = values.mapInArrow(moments, "i int, j int, " + ", ".join(f"{p} double" for p in PARTS))
    m = {p: F.col(p) for p in PARTS}
    left, right = m["xx"] - m["x"] * m["x"] / m["n"], m["yy"] - m["y"] * m["y"] / m["n"]
    varied = (m["n"] > 0) & (left > m["xx"] * NO_SPREAD) & (right > m["yy"] * NO_SPREAD)
    r = F.when(varied, (m["xy"] - m["x"] * m["y"] / m["n"]) / F.sqrt(left * right))
    names = F.array(*[F.lit(c) for c in columns])
    summed = parts.groupBy("i", "j").agg(*[F.sum(p).alias(p) for p in PARTS])
    return summed.select(F.get(names, F.col("i")).alias("feature_x"), F.get(names, F.col("j")).alias("feature_y"), r.alias("r"))


def monetary_histogram(features: DataFrame) -> DataFrame:
    return clipped_histogram(features, "monetary")


def recency_frequency_sample(features: DataFrame, size: int = SCATTER_ROWS, seed: int = SCATTER_SEED) -> DataFrame:
    columns = ["customer_unique_id", "recency", "frequency", "monetary"]
    return fixed_sample(features.select(*columns), columns[:1], size, seed)


def top_preferred_categories(features: DataFrame) -> DataFrame:
    return top_values(features, "preferred_category")


def feature_tables(features: DataFrame) -> dict[str, DataFrame]:
    return {
        "correlations": correlations(features),
        "monetary_histogram": monetary_histogram(features),
        "recency_frequency_sample": recency_frequency_sample(features),
        "top_states_features": top_states(features),
        "preferred_categories": top_preferred_categories(features),
    }


def segment_sizes(profile: DataFrame) -> DataFrame:
    return profile.select("segment", "pct_of_customers").orderBy("segment")


def stacked_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table of a set."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in frames.items()]
    )
