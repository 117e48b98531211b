"""Audits of raw tables and checks of business rules on typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronscope.functions.columns import union_all
from patronscope.operators.inspect import per_column, quoted
from patronscope.schema import HIDDEN_NULL_TOKENS
from patronscope.session import settle
from patronscope.sources.catalog import Tables, require


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def missing_values(tables: Tables) -> DataFrame:
    """(dataset, column, count, percentage) of nulls, one scan per table."""
    frames = [
        per_column(df, name, lambda c: F.count_if(c.isNull()), df.columns, "count")
        for name, df in tables.items()
    ]
    share = F.when(F.col("rows") > 0, F.col("count") / F.col("rows") * 100)
    return union_all(frames).select("dataset", "column", "count", share.alias("percentage"))


def exact_duplicates(tables: Tables) -> DataFrame:
    """(dataset, exact_duplicates): rows equal to an earlier row, null equal to null."""
    return union_all(
        [
            _repeated_rows(df).select(F.lit(name).alias("dataset"), F.col("n").alias("exact_duplicates"))
            for name, df in tables.items()
        ]
    )


def _repeated_rows(df: DataFrame) -> DataFrame:
    """Only 8-byte digests of all rows are shuffled; whole rows are compared just where a
    digest occurs twice, so wide text columns of unique rows never leave their task. The digests that
    repeat are written first: else the join would move all rows before it knows how few these are."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    digested = plain.withColumn("digest", F.xxhash64(*plain.columns))
    repeated = settle(
        digested.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "digests"
    )
    if repeated.isEmpty():  # no second pass
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("n"))
    groups = (
        digested.join(repeated, "digest", "left_semi")
        .groupBy("digest", *plain.columns)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n"))


def duplicate_keys(df: DataFrame, key: str = "order_id") -> DataFrame:
    """One row: how many rows repeat an earlier key; null counts as a value."""
    if key not in df.columns:
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("duplicates"))
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))
    )


def hidden_nulls(tables: Tables) -> DataFrame:
    """(dataset, column, hidden_null_count) of text columns that hold null tokens."""
    frames = [
        per_column(df, name, lambda c: F.count_if(c.isin(HIDDEN_NULL_TOKENS)), text_columns(df), "hidden_null_count")
        for name, df in tables.items()
        if text_columns(df)
    ]
    if not frames:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "dataset string, column string, hidden_null_count long")
    return union_all(frames).where("hidden_null_count > 0").drop("rows")


def _positive(column: str) -> Column:
    return F.col(column) <= 0


# (rule, table, condition that marks a row as invalid), in report order
RULES = [
    ("price > 0", "order_items", lambda: _positive("price")),
    ("freight_value >= 0", "order_items", lambda: F.col("freight_value") < 0),
    ("payment_value > 0", "order_payments", lambda: _positive("payment_value")),
    (
        "review_score between 1 and 5",
        "order_reviews",
        # a missing score is a violation, unlike in the other rules
        lambda: ~F.coalesce(F.col("review_score").between(1, 5), F.lit(False)),
    ),
    ("product_weight_g > 0", "products", lambda: _positive("product_weight_g")),
    ("product_length_cm > 0", "products", lambda: _positive("product_length_cm")),
    ("product_height_cm > 0", "products", lambda: _positive("product_height_cm")),
    ("product_width_cm > 0", "products", lambda: _positive("product_width_cm")),
    (
        "delivery_date >= purchase_date",
        "orders",
        lambda: F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp"),
    ),
]


def business_rules(tables: Tables, positions: list[int] | None = None) -> DataFrame:
    """(position, rule, invalid_count), one scan per table; only the rules at ``positions``, if given."""
    chosen = [(i, *rule) for i, rule in enumerate(RULES) if positions is None or i in positions]
    require(tables, *{table for _, _, table, _ in chosen})
    frames = []
    for table in dict.fromkeys(t for _, _, t, _ in chosen):
        rules = [(i, rule, bad) for i, rule, t, bad in chosen if t == table]
        counted = tables[table].agg(*[F.count_if(bad()).alias(f"r{i}") for i, _, bad in rules])
        entries = [
            F.struct(F.lit(i).alias("position"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("invalid_count"))
            for i, rule, _ in rules
        ]
        frames.append(counted.select(F.inline(F.array(*entries))))
    return union_all(frames)


# --- counts gathered while a table is written ---------------------------------------------


def raw_counts(df: DataFrame) -> list[Column]:
    """Nulls of every column and null tokens of every text column, named by their position."""
    text = set(text_columns(df))
    missing = [F.count_if(quoted(df, c).isNull()).alias(f"missing{i}") for i, c in enumerate(df.columns)]
    return missing + [
        F.count_if(quoted(df, c).isin(HIDDEN_NULL_TOKENS)).alias(f"hidden{i}") for i, c in enumerate(df.columns) if c in text
    ]


def rule_counts(table: str) -> list[Column]:
    """Violations of the rules of a typed table."""
    return [F.count_if(bad()).alias(f"rule{i}") for i, (_, t, bad) in enumerate(RULES) if t == table]


def from_counts(spark: SparkSession, tables: Tables, counted: dict[str, dict]) -> dict[str, DataFrame]:
    """The audits of missing values and hidden nulls and the rule report from the counts above, by table."""
    columns = [(n, i, c, counted[n]) for n, df in tables.items() for i, c in enumerate(df.columns)]
    missing = [(n, c, m[f"missing{i}"], m[f"missing{i}"] / m["rows"] * 100 if m["rows"] else None) for n, i, c, m in columns]
    hidden = [(n, c, m[f"hidden{i}"]) for n, i, c, m in columns if m.get(f"hidden{i}")]
    rules = [(i, rule, counted[t][f"rule{i}"]) for i, (rule, t, _) in enumerate(RULES)]
    return {
        "missing_values_audit": spark.createDataFrame(missing, "dataset string, column string, count long, percentage double"),
        "hidden_nulls_audit": spark.createDataFrame(hidden, "dataset string, column string, hidden_null_count long"),
        "business_rule_validation": spark.createDataFrame(rules, "position int, rule string, invalid_count long"),
    }
