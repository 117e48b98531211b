"""One query per operator, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapter
from patronscope import schema
from patronscope.functions import columns as fx
from patronscope.functions.quantiles import exact_quantiles, sorted_quantiles
from patronscope.functions.sampling import fixed_sample
from patronscope.operators import audit, charts, clean, cluster, density, evaluate, features, inspect, joins, prep, segments
from patronscope.operators.ward import fit_ward
from patronscope.plans import pipeline
from patronscope.session import scratch_path, settle
from patronscope.sources import catalog, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
WHO = "customer_unique_id"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because sums of fractions depend on the order of the rows."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else c for c, t in df.dtypes])


def _tables(spark, folder, *names):
    return adapter.tables(spark, folder, *names)


def _flat(spark, folder):
    return joins.flat_table(_tables(spark, folder))


def _items(spark, folder):
    """The flat table without products, for features that read none of their columns."""
    return joins.flat_items(_tables(spark, folder, "orders", "customers", "order_items"))


def _orders(spark, folder):
    return joins.orders_with_customers(_tables(spark, folder, "orders", "customers"))


def _features(spark, folder):
    return features.customer_features(_tables(spark, folder))


def _written_features(spark, folder):
    return pipeline.saved(_features(spark, folder), scratch_path(spark, "customer_features"))


def _scaled(spark, folder):
    table = _written_features(spark, folder)
    return prep.fit_scaling(table).transform(table)


def _rule_labeled(df: DataFrame, name: str) -> DataFrame:
    """A label that both engines can compute: customer modulo 5."""
    return df.withColumn(name, F.pmod(F.col(WHO), F.lit(5)).cast("int"))


def _profile(spark, folder):
    return settle(segments.profile_segments(_rule_labeled(_written_features(spark, folder), "segment")))


# --- sources and sinks ------------------------------------------------------------------


def _as_csv(spark, folder):
    out = scratch_path(spark, "csv")
    for name, df in _tables(spark, folder).items():
        sinks.write_table(df, f"{out}/{catalog.csv_pattern(name).replace('*', 'shop_')}", "csv")
    return out


@query
def io1_csv_load(spark, folder):
    return inspect.shapes(catalog.load_csv_tables(spark, _as_csv(spark, folder)).tables)


def contents(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column, known, total): rows with a value, and the sum of what each value stands for: digits of its
    digest, ten-thousandths, or microseconds."""
    frames = []
    for name, df in tables.items():
        entries, sums = [], []
        for i, (c, kind) in enumerate(df.dtypes):
            if kind == "string":
                value = F.conv(F.substring(F.md5(c), 1, 8), 16, 10)
            elif kind.startswith("timestamp"):
                value = F.unix_micros(F.col(c).cast("timestamp"))
            else:
                value = F.round(F.col(c).cast("double") * 10_000)
            sums += [F.count(c).alias(f"n{i}"), F.sum(value.cast("decimal(28,0)")).alias(f"s{i}")]
            entries.append(F.struct(F.lit(name).alias("dataset"), F.lit(c).alias("column"), F.col(f"n{i}").alias("known"),
                                    F.col(f"s{i}").cast("string").alias("total")))
        frames.append(df.agg(*sums).select(F.inline(F.array(*entries))))
    return fx.union_all(frames)


@query
def io1_csv_contents(spark, folder):
    """All tables through CSV and back, read as text and typed."""
    loaded = catalog.load_csv_tables(spark, _as_csv(spark, folder)).tables
    return contents(clean.clean_tables(loaded).tables)


@query
def io1_quoted_csv(spark, folder):
    """Reviews with line breaks, quotes and commas inside quotes, in one file that many tasks read."""
    reviews = _tables(spark, folder, "order_reviews")["order_reviews"]
    text = F.when(F.col("review_id") % 3 == 0, F.concat(F.lit('a "quoted"\nline, '), F.col("review_comment_message"), F.lit('\n\n"end"')))
    table = reviews.select("review_id", "order_id", text.alias("review_comment_message"), "review_score")
    path = sinks.write_table(table.coalesce(1), scratch_path(spark, "quoted"), "csv")
    size, short = "spark.sql.files.maxPartitionBytes", max(4096, sinks.bytes_at(spark, path) // 1_000)
    before = spark.conf.get(size)
    spark.conf.set(size, str(short))  # many blocks also for a small file; every task reports to the driver, so not more for a large one
    try:
        back = settle(catalog.read_csv(spark, [path], multiline=True))
    finally:
        spark.conf.set(size, before)
    return back.select(
        F.col("review_id").cast("long").alias("review_id"), F.col("order_id").cast("long").alias("order_id"),
        "review_comment_message", F.col("review_score").cast("int").alias("review_score"),
    )


@query
def io5_clean_contents(spark, folder):
    """The cleaned tables as written, with the audits counted on the way."""
    return contents(clean.clean_and_write(_tables(spark, folder), scratch_path(spark, "clean")).tables)


@query
def io6_observed_audits(spark, folder):
    """Audits that are counted while the tables are written."""
    audits = clean.clean_and_write(_tables(spark, folder), scratch_path(spark, "clean")).audits
    missing = audits["missing_values_audit"].select(F.lit("missing").alias("audit"), "dataset", F.col("column").alias("name"), F.col("count").alias("n"))
    rules = audits["business_rule_validation"].select(F.lit("rule"), F.lit(""), "rule", "invalid_count")
    return missing.union(rules)


@query
def cl9_dirty_flow(spark, folder):
    """Untidy names, tokens, labels and texts of dates and numbers through the whole flow."""
    tables = {n: _as_text(df) for n, df in _tables(spark, folder).items()}
    mess = F.when(F.col("order_id").cast("long") % 7 == 0, F.lit(" N/A ")).otherwise(F.concat(F.lit("  "), F.upper("order_status")))
    tables["orders"] = tables["orders"].withColumn("order_status", mess).withColumnRenamed("order_status", " Order Status ")
    return contents(clean.clean_and_write(tables, scratch_path(spark, "clean")).tables)


@query
def io2_missing_tables(spark, folder):
    """A partly missing set is loaded and the absent tables are named."""
    out = scratch_path(spark, "partial")
    sinks.write_table(_tables(spark, folder, "orders")["orders"], f"{out}/shop_orders_dataset.csv", "csv")
    found = catalog.load_csv_tables(spark, out)
    try:
        catalog.load_csv_tables(spark, f"{out}/nothing")
        failed = False
    except FileNotFoundError:
        failed = True
    return found.tables["orders"].agg(F.count(F.lit(1)).alias("orders")).select(
        "orders", F.lit(",".join(sorted(found.missing))).alias("missing"), F.lit(failed).alias("fails_if_empty")
    )


@query
def io3_null_tokens(spark, folder):
    path = sinks.write_table(adapter.dirty(spark, folder)["catalog"], scratch_path(spark, "tokens"), "csv")
    df = clean.rename_columns({"t": catalog.read_csv(spark, [path])})["t"]
    return df.select(F.col("item_id").cast("long").alias("item_id"), "product_label", "channel", "returned")


@query
def io4_feature_reload(spark, folder):
    path = sinks.write_table(_features(spark, folder), scratch_path(spark, "features"))
    return pipeline.load_features(spark, path).select(WHO, "recency", "frequency", "monetary", "preferred_category")


@query
def io5_clean_sink(spark, folder):
    written = sinks.write_tables(clean.clean_tables(_tables(spark, folder)).tables, scratch_path(spark, "clean"), "_clean")
    return inspect.shapes({n: spark.read.parquet(p) for n, p in written.items()})


@query
def io6_audit_sink(spark, folder):
    written = sinks.write_tables(clean.clean_tables(_tables(spark, folder)).audits, scratch_path(spark, "audits"))
    return charts.stacked_counts({n: spark.read.parquet(p) for n, p in written.items()})


@query
def io7_feature_sink(spark, folder):
    path = sinks.write_table(_features(spark, folder), scratch_path(spark, "features"), "csv")
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("frequency").cast("long")).alias("orders"),
        F.count("preferred_category").alias("with_category"),
    ).withColumn("columns", F.lit(len(back.columns)))


@query
def io8_profile_sink(spark, folder):
    path = sinks.write_table(segments.name_segments(_profile(spark, folder)), scratch_path(spark, "profile"), "csv")
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("segment").cast("int").alias("segment"), F.col("customers").cast("long").alias("customers"), "segment_name")


@query
def io9_insight_text(spark, folder):
    named = segments.name_segments(_profile(spark, folder))
    path = sinks.write_text(segments.insights(named), scratch_path(spark, "insights"))
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def io10_model_bundle(spark, folder):
    table = _written_features(spark, folder)
    scaling = prep.fit_scaling(table)
    model = cluster.fit_kmeans(scaling.transform(table), 5)
    path = cluster.save_model(scaling, model, scratch_path(spark, "model"))
    return cluster.score(cluster.load_model(spark, path), table)


# --- inspection, audits, rules ----------------------------------------------------------


@query
def in1_columns(spark, folder):
    return inspect.column_list(_tables(spark, folder))


@query
def in2_shapes(spark, folder):
    return inspect.shapes(_tables(spark, folder))


@query
def in3_column_info(spark, folder):
    return inspect.column_info(_tables(spark, folder))


@query
def in4_describe(spark, folder):
    return rounded(inspect.describe_all(_tables(spark, folder)), 4)


@query
def au1_missing_values(spark, folder):
    return rounded(audit.missing_values(_tables(spark, folder)))


@query
def au2_exact_duplicates(spark, folder):
    return audit.exact_duplicates(_tables(spark, folder))


@query
def au3_duplicate_order_ids(spark, folder):
    """On payments, where ids do repeat, and on orders."""
    t = _tables(spark, folder, "orders", "order_payments")
    return fx.union_all([audit.duplicate_keys(df).select(F.lit(n).alias("dataset"), "duplicates") for n, df in t.items()])


@query
def au4_hidden_nulls(spark, folder):
    raw = adapter.dirty(spark, folder)
    return audit.hidden_nulls({**raw, **_tables(spark, folder)})


@query
def dq7_business_rules(spark, folder):
    return audit.business_rules(_tables(spark, folder))


def _rule(*positions):
    def run(spark, folder):
        named = {audit.RULES[i][1] for i in positions}
        return audit.business_rules(_tables(spark, folder, *named), list(positions)).drop("position")

    return run


QUERIES["dq1_price"] = _rule(0)
QUERIES["dq2_freight"] = _rule(1)
QUERIES["dq3_payment"] = _rule(2)
QUERIES["dq4_review_score"] = _rule(3)
QUERIES["dq5_dimensions"] = _rule(4, 5, 6, 7)
QUERIES["dq6_delivery_date"] = _rule(8)


# --- cleaning ---------------------------------------------------------------------------


@query
def cl1_column_names(spark, folder):
    return clean.rename_columns(adapter.dirty(spark, folder))["catalog"]


@query
def cl2_strip_and_nulls(spark, folder):
    return clean.strip_text(clean.rename_columns(adapter.dirty(spark, folder)))["catalog"]


@query
def cl3_lower(spark, folder):
    return clean.lower_text(clean.rename_columns(adapter.dirty(spark, folder)))["catalog"]


def _labeled_catalog(spark, folder):
    named = clean.rename_columns(adapter.dirty(spark, folder))
    return clean.standardize_labels(clean.lower_text(clean.strip_text(named)))


@query
def cl4_labels(spark, folder):
    return _labeled_catalog(spark, folder)["catalog"]


@query
def cl5_label_log(spark, folder):
    named = clean.lower_text(clean.strip_text(clean.rename_columns(adapter.dirty(spark, folder))))
    return clean.label_log(spark, named)


@query
def s9_column_types(spark, folder):
    """Dates with and without a time, with ``T`` and with fractions, whole numbers beyond 32 bits and fractions: all are read."""
    t = _tables(spark, folder, "orders", "order_items", "order_reviews")
    at = F.col("order_purchase_timestamp")
    iso = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    kind = F.pmod(F.col("order_id"), F.lit(4))
    orders = t["orders"].select(
        F.col("order_id").cast("string").alias("order_id"),
        F.when(kind == 0, F.date_format(at, "yyyy-MM-dd")).when(kind == 1, F.replace(iso, F.lit(" "), F.lit("T")))
        .when(kind == 2, F.concat(iso, F.lit(".25"))).otherwise(iso).alias("order_purchase_timestamp"),
        F.date_format("order_estimated_delivery_date", "dd/MM/yyyy").alias("order_estimated_delivery_date"),
    )
    number = F.col("order_item_id").cast("string")
    items = t["order_items"].select(
        F.col("order_id").cast("string").alias("order_id"),
        F.when(F.col("order_id") % 5 == 0, F.concat(number, F.lit(".5"))).otherwise(F.concat(number, F.lit(".0"))).alias("order_item_id"),
    )
    reviews = t["order_reviews"].select(
        F.col("order_id").cast("string").alias("order_id"), F.concat(F.lit("300000000"), F.col("review_score").cast("string")).alias("review_score")
    )
    typed = clean.fix_types({"orders": orders, "order_items": items, "order_reviews": reviews})
    frames = [
        typed["orders"].select(
            F.lit("orders").alias("dataset"), F.col("order_id").cast("long").alias("id"),
            F.unix_micros(F.col("order_purchase_timestamp").cast("timestamp")).cast("double").alias("a"),
            F.unix_micros(F.col("order_estimated_delivery_date").cast("timestamp")).cast("double").alias("b")),
        typed["order_items"].select(F.lit("order_items"), F.col("order_id").cast("long"), F.col("order_item_id").cast("double"), F.lit(None).cast("double")),
        typed["order_reviews"].select(F.lit("order_reviews"), F.col("order_id").cast("long"), F.col("review_score").cast("double"), F.lit(None).cast("double")),
    ]
    return frames[0].union(frames[1]).union(frames[2])


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query
def cl6_timestamps(spark, folder):
    """Every third text is a date in another format, which becomes null."""
    df = _as_text(_tables(spark, folder, "orders")["orders"])
    c = "order_purchase_timestamp"
    mixed = df.withColumn(c, F.when(F.col("order_id").cast("long") % 3 == 0, F.replace(c, F.lit("-"), F.lit("/"))).otherwise(F.col(c)))
    typed = clean.fix_types({"orders": mixed})["orders"]
    return typed.select(
        F.col("order_id").cast("long").alias("order_id"), F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("purchased"),
        F.date_format("order_delivered_customer_date", "yyyy-MM-dd HH:mm:ss").alias("delivered"),
    )


@query
def cl7_numbers(spark, folder):
    df = _as_text(_tables(spark, folder, "order_items")["order_items"])
    mixed = df.withColumn("price", F.when(F.col("order_id").cast("long") % 3 == 0, F.concat(F.lit("R$ "), "price")).otherwise(F.col("price")))
    typed = clean.fix_types({"order_items": mixed})["order_items"]
    return typed.select(F.col("order_id").cast("long").alias("order_id"), "order_item_id", "price", "freight_value")


@query
def cl8_categories(spark, folder):
    typed = clean.fix_types(_tables(spark, folder, "orders"))["orders"]
    return typed.groupBy("order_status").agg(F.count(F.lit(1)).alias("n"))


@query
def cl9_cleaning_flow(spark, folder):
    result = clean.clean_tables(_tables(spark, folder))
    return rounded(audit.missing_values(result.tables))


@query
def cl10_dated_orders(spark, folder):
    orders = _tables(spark, folder, "orders")["orders"]
    return clean.delivered_orders(orders).select("order_id", "order_status")


@query
def cl11_delivery_range(spark, folder):
    orders = _tables(spark, folder, "orders")["orders"]
    return clean.delivery_days(orders)


@query
def cl13_rename(spark, folder):
    products = _tables(spark, folder, "products")["products"]
    return clean.product_categories(products)


# --- joins ------------------------------------------------------------------------------


@query
def jn1_orders_customers(spark, folder):
    t = _tables(spark, folder, "orders", "customers")
    return joins.orders_with_customers(t).select("order_id", "order_status", WHO, "customer_state", "customer_city")


@query
def jn2_orders_items(spark, folder):
    t = _tables(spark, folder, "orders", "order_items")
    return joins.orders_with_items(t).select("order_id", "order_item_id", "product_id", "price")


@query
def jn3_items_products(spark, folder):
    t = _tables(spark, folder, "order_items", "products")
    return joins.items_with_products(t).select(
        "order_id", "order_item_id", "product_category_name", "product_weight_g"
    )


@query
def jn4_category_names(spark, folder):
    return joins.product_names(_tables(spark, folder, "products", "category_name_translation"))


@query
def jn5_flat_table(spark, folder):
    return _flat(spark, folder).select(
        "order_id", WHO, "order_status", "order_item_id", "product_id", "price", "freight_value",
        "product_category_name", "product_category_name_english", "customer_state",
    )


@query
def jn6_payments_customers(spark, folder):
    return joins.payments_with_customers(_tables(spark, folder, "orders", "customers", "order_payments"))


@query
def jn7_reviews_customers(spark, folder):
    t = _tables(spark, folder, "orders", "customers", "order_reviews")
    return joins.reviews_with_customers(t).select("review_id", "order_id", "review_score", WHO)


@query
def jn8_feature_assembly(spark, folder):
    """The feature table assembled by joins on the customer."""
    return rounded(features.features_from_flat(_tables(spark, folder)))


@query
def jn9_items_categories(spark, folder):
    t = _tables(spark, folder, "order_items", "products", "category_name_translation")
    return joins.items_with_categories(t).select("order_id", "order_item_id", "product_id", "product_category_name_english")


@query
def jn10_reviews_categories(spark, folder):
    return joins.reviews_with_categories(_tables(spark, folder)).select(
        "review_id", "order_id", "review_score", "product_id", "product_category_name_english"
    )


@query
def jn11_top_category_items(spark, folder):
    t = _tables(spark, folder, "order_items", "products", "category_name_translation")
    return charts.top_category_items(t).select("order_id", "order_item_id", "product_category_name_english")


@query
def jn12_segment_favorites(spark, folder):
    return _profile(spark, folder).select("segment", "top_category", "top_channel")


# --- features ---------------------------------------------------------------------------


@query
def fe1_snapshot(spark, folder):
    df = features.snapshot_frame(_tables(spark, folder, "orders")["orders"])
    return df.select(F.date_format("snapshot_date", "yyyy-MM-dd HH:mm:ss").alias("snapshot_date"))


@query
def fe2_order_totals(spark, folder):
    return features.order_totals(_items(spark, folder)).select(
        "order_id", WHO, "order_total", "order_freight", "order_total_with_freight"
    )


def _rfm_column(column):
    return lambda spark, folder: features.rfm(_items(spark, folder), dated=_orders(spark, folder)).select(WHO, column)


QUERIES["fe3_recency"] = _rfm_column("recency")
QUERIES["fe4_frequency"] = _rfm_column("frequency")
QUERIES["fe5_monetary"] = _rfm_column("monetary")


@query
def fe6_rfm(spark, folder):
    return features.rfm(_items(spark, folder), dated=_orders(spark, folder))


@query
def fe7_preferred_category(spark, folder):
    return features.preferred_category(_flat(spark, folder))


@query
def fe8_area(spark, folder):
    return features.area(_orders(spark, folder))


@query
def fe9_return_rate(spark, folder):
    return features.return_rate(_orders(spark, folder))


def _payments(spark, folder):
    return joins.payments_with_customers(_tables(spark, folder, "orders", "customers", "order_payments"))


@query
def fe10_preferred_channel(spark, folder):
    return features.preferred_channel(_payments(spark, folder))


@query
def fe11_avg_installments(spark, folder):
    return features.avg_installments(_payments(spark, folder))


@query
def fe12_avg_review_score(spark, folder):
    t = _tables(spark, folder, "orders", "customers", "order_reviews")
    return features.avg_review_score(joins.reviews_with_customers(t))


@query
def fe13_delivery_delay(spark, folder):
    return features.delivery(_items(spark, folder)).select(WHO, "delivery_delay")


@query
def fe14_delivery_time(spark, folder):
    return features.delivery(_items(spark, folder)).select(WHO, "avg_delivery_time")


@query
def fe15_freight_ratio(spark, folder):
    return rounded(features.freight_ratio(_items(spark, folder)))


@query
def fe16_category_diversity(spark, folder):
    return features.category_diversity(_flat(spark, folder))


@query
def fe17_tenure(spark, folder):
    return features.tenure(_orders(spark, folder))


@query
def fe18_feature_table(spark, folder):
    return rounded(_features(spark, folder))


# --- chart tables -----------------------------------------------------------------------


def _chart(f, digits=6):
    return lambda spark, folder: rounded(f(_tables(spark, folder)), digits)


QUERIES["ch1_order_status"] = _chart(charts.order_status)
QUERIES["ch2_review_scores"] = _chart(charts.review_scores)
QUERIES["ch3_monthly_orders"] = lambda s, d: charts.monthly_orders(_tables(s, d)).select(
    F.date_format("month", "yyyy-MM-dd").alias("month"), "n"
)
QUERIES["ch4_top_states"] = _chart(lambda t: charts.top_states(t["customers"]))
QUERIES["ch5_top_categories"] = _chart(charts.top_categories)
QUERIES["ch6_payment_types"] = _chart(charts.payment_types)
QUERIES["ch7_installments"] = _chart(charts.installments)
QUERIES["ch8_price_histogram"] = _chart(charts.price_histogram)
QUERIES["ch9_price_freight_sample"] = _chart(charts.price_freight_sample)
QUERIES["ch10_delivery_histogram"] = _chart(charts.delivery_histogram)
QUERIES["ch11_top_sellers"] = _chart(charts.top_sellers)
QUERIES["ch12_top_category_scores"] = _chart(charts.top_category_scores)


def _feature_chart(f, digits=6):
    return lambda spark, folder: rounded(f(_written_features(spark, folder)), digits)


QUERIES["ch13_correlations"] = _feature_chart(charts.correlations)
QUERIES["ch14_monetary_histogram"] = _feature_chart(charts.monetary_histogram)
QUERIES["ch15_recency_frequency_sample"] = _feature_chart(charts.recency_frequency_sample)
QUERIES["ch16_top_states_features"] = _feature_chart(charts.top_states)
QUERIES["ch17_preferred_categories"] = _feature_chart(charts.top_preferred_categories)


@query
def ch18_k_curve(spark, folder):
    return cluster.choose_k(_scaled(spark, folder)).curve


@query
def ch19_segment_sizes(spark, folder):
    return rounded(charts.segment_sizes(_profile(spark, folder)))


@query
def ch20_all_tables(spark, folder):
    frames = {**charts.eda_tables(_tables(spark, folder)), **charts.feature_tables(_written_features(spark, folder))}
    return charts.stacked_counts(frames)


# --- column functions -------------------------------------------------------------------


@query
def s6_clip(spark, folder):
    items = _tables(spark, folder, "order_items")["order_items"]
    upper = exact_quantiles(items, {"price": [0.99]})["price"][0]
    return items.select("order_id", "order_item_id", fx.clip(F.col("price"), lower=1000.0, upper=upper).alias("price"))


@query
def s10_floor_days(spark, folder):
    orders = _tables(spark, folder, "orders")["orders"]
    day = fx.floor_days(F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date"))
    return orders.select("order_id", day.alias("days"))


@query
def s12_quantiles(spark, folder):
    """By sorting, and by the radix search."""
    items = _tables(spark, folder, "order_items")["order_items"]
    wanted = {"price": [0.25, 0.5, 0.99], "freight_value": [0.25, 0.5, 0.99]}
    ways = {"direct": sorted_quantiles(items, wanted), "search": exact_quantiles(items, wanted)}
    values = [
        F.struct(F.lit(way).alias("way"), F.lit(c).alias("column"), F.lit(p).alias("p"), F.lit(v).alias("value"))
        for way, found in ways.items() for c, vs in found.items() for p, v in zip(wanted[c], vs)
    ]
    total = items.agg(F.count(F.lit(1)).alias("rows"))
    return rounded(total.select("rows", F.inline(F.array(*values))))


@query
def s14_fixed_sample(spark, folder):
    return fixed_sample(_tables(spark, folder, "orders")["orders"].select("order_id", "order_status"), ["order_id"], 3000, 7)


@query
def s15_shares(spark, folder):
    orders = _tables(spark, folder, "orders")["orders"]
    return rounded(charts.with_share(charts.value_counts(orders, "order_status")))


@query
def s17_number_text(spark, folder):
    table = _features(spark, folder)
    return table.select(
        WHO, fx.fixed_decimal_text(F.col("avg_review_score")).alias("score"),
        fx.whole_text(F.col("avg_order_value")).alias("value"),
        fx.whole_text(F.col("return_rate") * 100).alias("returns"),
    )


# --- modeling and evaluation ------------------------------------------------------------


@query
def ml1_log_features(spark, folder):
    logs = [f"{c}_log" for c in schema.LOG_FEATURES]
    return rounded(prep.add_logs(_features(spark, folder)).select(WHO, *logs))


@query
def ml2_imputed(spark, folder):
    table = _written_features(spark, folder)
    filled = prep.impute(prep.add_logs(table), prep.fit_scaling(table).medians)
    return rounded(filled.select(WHO, *schema.MODEL_FEATURES))


@query
def ml3_scaled(spark, folder):
    return rounded(_scaled(spark, folder).select(WHO, *prep.SCALED))


@query
def ml4_choose_k(spark, folder):
    choice = cluster.choose_k(_scaled(spark, folder))
    return choice.curve.withColumn("chosen", F.col("k") == choice.k)


@query
def ml5_kmeans(spark, folder):
    scaled = _scaled(spark, folder)
    return scaled.select(WHO, cluster.fit_kmeans(scaled, 5).label().alias("label"))


@query
def ml6_k_override(spark, folder):
    """K from the curve when none is given, else the given one."""
    scaled = _scaled(spark, folder)
    chosen = cluster.choose_k(scaled).k
    rows = [F.struct(F.lit("chosen").alias("way"), F.lit(chosen).alias("k")),
            F.struct(F.lit("default").alias("way"), F.lit(cluster.DEFAULT_K).alias("k"))]
    return scaled.agg(F.count(F.lit(1)).alias("customers")).select("customers", F.inline(F.array(*rows)))


@query
def ml7_dbscan(spark, folder):
    return density.dbscan(_scaled(spark, folder), WHO, prep.SCALED)


@query
def ml7_few_pivots(spark, folder):
    """With 16 pivots, so that most points are settled by the metric index."""
    return density.dbscan(_scaled(spark, folder), WHO, prep.SCALED, pivots=16)


@query
def ml8_hierarchical(spark, folder):
    scaled = settle(_scaled(spark, folder))
    return fit_ward(scaled, prep.SCALED).labels(scaled, cluster.DEFAULT_K).select(WHO, "label")


@query
def ml8_planted(spark, folder):
    """Five groups of orders far apart, more different points than leaves; Ward linkage finds the groups."""
    group = F.pmod(F.col("order_id"), F.lit(15))
    places = F.when(group < 5, 0).when(group < 9, 1).when(group < 12, 2).when(group < 14, 3).otherwise(4)
    orders = _tables(spark, folder, "orders")["orders"].select("order_id", places.alias("place"))
    points = orders.select(
        "order_id", (F.pmod(F.col("order_id") * 37, F.lit(1009)) / 1009 + F.col("place") * 40).alias("x"),
        (F.pmod(F.col("order_id") * 101, F.lit(2003)) / 2003 - F.pmod(F.col("place"), F.lit(2)) * 60).alias("y"),
    )
    return fit_ward(points, ["x", "y"], leaves=500).labels(points, 5).select("order_id", "label")


@query
def ml9_three_models(spark, folder):
    models = cluster.fit_models(_scaled(spark, folder))
    return fx.union_all([df.select(F.lit(n).alias("model"), WHO, "label") for n, df in models.labeled.items()])


def _planted(spark, folder):
    """Model input with five groups of orders far apart in two features; the others are 0."""
    group = F.pmod(F.col("order_id"), F.lit(15))
    place = F.when(group < 5, 0).when(group < 9, 1).when(group < 12, 2).when(group < 14, 3).otherwise(4)
    x = F.pmod(F.col("order_id") * 37, F.lit(101)) / 101 + place * 40
    y = F.pmod(F.col("order_id") * 53, F.lit(103)) / 103 + F.pmod(place, F.lit(2)) * 60
    zero = {z: F.lit(0.0) for z in prep.SCALED}
    columns = {**zero, prep.SCALED[0]: x, prep.SCALED[1]: y}
    orders = _tables(spark, folder, "orders")["orders"]
    return settle(orders.select(F.col("order_id").alias(WHO), *[c.alias(n) for n, c in columns.items()]))


def _groups(labeled: DataFrame) -> DataFrame:
    """Each customer with the first member of its cluster, whatever the clusters are called."""
    first = labeled.groupBy("label").agg(F.min(WHO).alias("first"))
    return labeled.select(WHO, "label").join(first, "label").select(WHO, "first")


@query
def ml4_planted(spark, folder):
    """Choosing K finds the number of planted groups."""
    choice = cluster.choose_k(_planted(spark, folder), restarts=4)
    return choice.curve.select("k", (F.col("k") == choice.k).alias("chosen"))


@query
def ml5_planted(spark, folder):
    planted = _planted(spark, folder)
    return _groups(planted.select(WHO, cluster.fit_kmeans(planted, 5).label().alias("label")))


@query
def ml9_planted(spark, folder):
    """All three models find the planted groups."""
    models = cluster.fit_models(_planted(spark, folder))
    return fx.union_all([_groups(df).select(F.lit(n).alias("model"), WHO, "first") for n, df in models.labeled.items()])


@query
def io10_planted(spark, folder):
    """A saved model that is loaded again gives the planted groups from raw features."""
    planted = _planted(spark, folder)
    raw = {z: c for z, c in zip(prep.SCALED, schema.MODEL_FEATURES)}
    model = cluster.fit_kmeans(planted, 5)
    plain = prep.Scaling({}, {c: 0.0 for c in schema.MODEL_FEATURES}, {c: 1.0 for c in schema.MODEL_FEATURES})
    path = cluster.save_model(plain, model, scratch_path(spark, "model"))
    logs = {f"{c}_log": c for c in schema.LOG_FEATURES}
    table = planted.select(WHO, *[
        (F.expm1(F.col(z)) if c in logs else F.col(z)).alias(logs.get(c, c)) for z, c in raw.items()
    ])
    return _groups(cluster.score(cluster.load_model(spark, path), table))


@query
def ev4_planted(spark, folder):
    """The comparison of two labelings of the planted groups: the right one, and one that joins two of them."""
    planted = _planted(spark, folder)
    group = F.pmod(F.col(WHO), F.lit(15))
    place = F.when(group < 5, 0).when(group < 9, 1).when(group < 12, 2).when(group < 14, 3)
    labeled = {"right": planted.withColumn("label", F.coalesce(place, F.lit(4))), "joined": planted.withColumn("label", F.coalesce(place, F.lit(3)))}
    scores = evaluate.evaluate_all(labeled)
    return rounded(scores.select("model", "davies_bouldin"))


@query
def ev1_silhouette(spark, folder):
    labeled = _rule_labeled(_scaled(spark, folder), "label")
    return rounded(evaluate.silhouettes(labeled, WHO, prep.SCALED, ["label"]))


@query
def ev2_davies_bouldin(spark, folder):
    return rounded(evaluate.davies_bouldin(_rule_labeled(_scaled(spark, folder), "label"), prep.SCALED))


@query
def ev3_cluster_sizes(spark, folder):
    return rounded(evaluate.cluster_sizes(_rule_labeled(_scaled(spark, folder), "label")))


@query
def ev4_model_comparison(spark, folder):
    return evaluate.evaluate_all(cluster.fit_models(_scaled(spark, folder)).labeled)


@query
def ev5_assign_segments(spark, folder):
    table = _written_features(spark, folder)
    labels = _rule_labeled(table, "label").select(WHO, "label")
    return segments.assign_segments(table, labels).select(WHO, "segment", "avg_review_score")


# --- segments ---------------------------------------------------------------------------


@query
def pr1_profile(spark, folder):
    return rounded(_profile(spark, folder).drop("pct_of_customers", "pct_of_revenue", "top_category", "top_channel"), 4)


@query
def pr2_shares(spark, folder):
    return rounded(_profile(spark, folder).select("segment", "pct_of_customers", "pct_of_revenue"))


@query
def pr3_favorites(spark, folder):
    return _profile(spark, folder).select("segment", "customers", "top_category", "top_channel")


@query
def pr4_segment_names(spark, folder):
    return segments.name_segments(_profile(spark, folder)).select("segment", "segment_name")


@query
def pr5_named_segments(spark, folder):
    return segments.ranked_segments(segments.name_segments(_profile(spark, folder)))


@query
def pr6_insights(spark, folder):
    return segments.insights(segments.name_segments(_profile(spark, folder)))


@query
def pl1_pipeline(spark, folder):
    """The whole run; named segments of the K-means clustering."""
    result = pipeline.run(_tables(spark, folder), restarts=2)
    return result.profile.select("segment", "customers", "segment_name", "pct_of_customers", "pct_of_revenue")


@query
def pl1_saved_run(spark, folder):
    """Everything that a run has written and that does not depend on a clustering, read back by a second run, which computes nothing."""
    out = scratch_path(spark, "run")
    pipeline.run(_tables(spark, folder), out, restarts=1, k_search=False)
    again = pipeline.run(_tables(spark, folder), out, restarts=1, k_search=False)
    frames = {**again.eda, **again.feature_views, "customers": again.features, "labels": again.labeled["hierarchical"], "segments": again.segments}
    return charts.stacked_counts(frames).withColumn("computed", F.lit(len(again.computed)))


@query
def pl1_from_csv(spark, folder):
    """From CSV files to the feature table of the run."""
    result = pipeline.run_from_csv(spark, _as_csv(spark, folder), fmt="csv", eda=False, feature_views=False, k_search=False, restarts=1)
    return rounded(result.features.select(F.col(WHO).cast("long").alias(WHO), "recency", "frequency", "monetary", "preferred_category", "avg_review_score"))
