"""Reading, auditing and cleaning on small frames."""

import os

import pytest

from checks import queries
from patronscope.functions import columns as fx
from patronscope.operators import audit, clean, inspect
from patronscope.sources import catalog, csv_blocks, sinks
from pyspark.sql import functions as F


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_tables(spark, folder):
    write(folder, "shop_order_reviews_dataset.csv", 'review_id,order_id,review_comment_message\n1,a,"two\nlines, ""quoted"""\n2,b,NA\n3,c,Null\n4,d,-\n')
    write(folder, "product_category_name_translation.csv", "product_category_name,product_category_name_english\ncama,bed\n")
    found = catalog.load_csv_tables(spark, folder)
    assert sorted(found.tables) == ["category_name_translation", "order_reviews"]
    assert "orders" in found.missing and len(found.missing) == 7
    rows = {r[0]: r[2] for r in found.tables["order_reviews"].collect()}
    assert rows == {"1": 'two\nlines, "quoted"', "2": None, "3": "Null", "4": "-"}


def test_no_table_at_all(spark, folder):
    with pytest.raises(FileNotFoundError):
        catalog.load_csv_tables(spark, folder)


def test_missing_table_is_named(spark):
    with pytest.raises(KeyError, match="order_payments"):
        audit.business_rules({"orders": spark.range(1)})


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], ["  Order--ID ", "Price (R$)"])
    assert clean.rename_columns({"t": df})["t"].columns == ["order_id", "price_r"]
    with pytest.raises(ValueError):
        clean.rename_columns({"t": spark.createDataFrame([(1, 2)], ["a b", "a-b"])})


def test_strip_keeps_empty_text(spark):
    df = spark.createDataFrame([("\t x \n",), ("  ",), (" N/A ",), ("-",), (None,), ("n/a",)], "v string")
    got = [r.v for r in clean.strip_text({"t": df})["t"].collect()]
    assert got == ["x", "", None, None, None, "n/a"]


def test_strip_is_no_pattern(spark):
    """All white space of Unicode goes at both ends, as by the pattern, and nothing else."""
    inner = [chr(c) for c in (*range(0x1, 0x21), 0x85, 0xA0, 0x180E, 0x1680, *range(0x1FFE, 0x2010), *range(0x2027, 0x2030), 0x205F, 0x2060, 0x3000, 0xFEFF)]
    texts = [f"{c}{d}a {c} b{d}{c}" for c in inner for d in ("", "\n", " ")] + ["", " \t\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fx.strip(F.col("t")).alias("got"))
    assert "regexp_replace" not in df._jdf.queryExecution().analyzed().toString()
    assert df.where(~F.col("got").eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+$", ""))).count() == 0


def test_labels_and_log(spark):
    df = spark.createDataFrame([("online", "y"), ("phone", "no"), (None, "yes")], "channel string, returned string")
    out = clean.standardize_labels({"t": df, "u": spark.range(1)})
    assert [tuple(r) for r in out["t"].collect()] == [("Online", "Yes"), ("phone", "No"), (None, "Yes")]
    log = {(r.column, r.old_value): r.rows for r in clean.label_log(spark, {"t": df, "u": spark.range(1)}).collect()}
    assert len(log) == 7 and {k for k, n in log.items() if n == 1} == {("channel", "online"), ("returned", "y"), ("returned", "no"), ("returned", "yes")}
    empty = clean.label_log(spark, {"u": spark.range(1)})
    assert empty.count() == 0 and empty.columns == ["dataset", "column", "old_value", "new_value", "rows"]


def test_types(spark):
    orders = spark.createDataFrame(
        [("a", "2017-10-02 10:56:33"), ("b", "2017/10/02"), ("c", "2017-13-02 10:00:00"), ("d", None)],
        "order_id string, order_purchase_timestamp string",
    )
    items = spark.createDataFrame(
        [("1", "58.9"), ("2.0", "x"), ("2.5", "1e2"), (None, "")], "order_item_id string, price string"
    )
    out = clean.fix_types({"orders": orders, "order_items": items})
    assert [r[1] is not None for r in out["orders"].collect()] == [True, False, False, False]
    assert [tuple(r) for r in out["order_items"].collect()] == [(1, 58.9), (2, None), (2.5, 100.0), (None, None)]
    assert dict(out["order_items"].dtypes) == {"order_item_id": "double", "price": "double"}


def test_types_follow_the_votes(spark):
    def types_of(column, values, table="order_items"):
        df = spark.createDataFrame([(v,) for v in values], f"{column} string")
        found = clean.infer_types({table: df})[table, column]
        return found, [r[0] for r in clean.fix_types({table: df})[table].collect()]

    whole, got = types_of("order_item_id", ["1", "2.0", " x", None, "-3"])
    assert (whole.kind, whole.texts, whole.lost, got) == ("int", 4, 1, [1, 2, None, None, -3])
    assert types_of("order_item_id", ["3000000000", "1"])[1] == [3000000000, 1]
    assert types_of("order_item_id", ["9007199254740993", "1e3"])[1] == [9007199254740993, 1000]
    mixed, got = types_of("order_item_id", ["1", "2.5", "1e30"])
    assert (mixed.kind, got) == ("double", [1.0, 2.5, 1e30])
    assert types_of("order_item_id", [None, None])[0].kind == "int"

    def dates(values):
        found, got = types_of("shipping_limit_date", values)
        return found, [str(v) if v else None for v in got]

    iso, got = dates(["2020-01-02", "2020-01-02t03:04", "2020-01-02 03:04:05.25", "2020-02-30", "02/01/2020", None])
    assert (iso.notation, iso.lost) == ("iso", 2)
    assert got == ["2020-01-02 00:00:00", "2020-01-02 03:04:00", "2020-01-02 03:04:05.250000", None, None, None]
    assert dates(["01/02/2020", "13/02/2020 10:00"])[1] == ["2020-02-01 00:00:00", "2020-02-13 10:00:00"]
    assert dates(["01/02/2020", "02/13/2020"])[1] == ["2020-01-02 00:00:00", "2020-02-13 00:00:00"]
    assert dates(["2020/01/02", "x"])[0].lost == 1


def test_written_tables_have_the_audits_of_the_lazy_flow(spark, folder):
    from checks import adapter

    raw = adapter.tables(spark, "/root/testdata/sf0.001")
    raw["orders"] = raw["orders"].select(*[F.col(c).cast("string").alias(c) for c in raw["orders"].columns]).withColumns(
        {"channel": F.expr("case when order_id % 2 = 0 then ' ONLINE' else 'N/A' end"), "note": F.lit("-")})
    lazy, eager = clean.clean_tables(raw), clean.clean_and_write(raw, folder, fmt="csv")
    for name, df in lazy.audits.items():
        got, want = ({tuple(r) for r in x.select(*sorted(df.columns)).collect()} for x in (eager.audits[name], df))
        assert got == want, name
    for name, df in lazy.tables.items():
        assert eager.tables[name].dtypes == df.dtypes
        assert eager.tables[name].exceptAll(df).count() == 0 == df.exceptAll(eager.tables[name]).count(), name


def test_quoted_csv_in_blocks(spark, folder):
    """Any cut of the file into blocks gives the records of a plain reader."""
    import csv
    import random

    chance = random.Random(2)
    parts = ["a", ",", "\n", "\r\n", '"', "\n\n", "long text " * 4, "", " ", "é"]
    rows = [[str(i), "".join(chance.choices(parts, k=chance.randint(0, 6))), chance.choice(["x", "", "y z"])] for i in range(400)]
    rows[200][1] = "\n" * 3000  # covers several blocks
    os.mkdir(os.path.join(folder, "t"))
    for i, (low, high) in enumerate([(0, 300), (300, 400)]):
        with open(os.path.join(folder, "t", f"part{i}.csv"), "w", encoding="utf-8", newline="") as f:
            out = csv.writer(f, lineterminator="\r\n" if i else "\n")
            out.writerows([["id", "some text", "c"], *rows[low:high]])
    want = sorted((i, t or None, c or None) for i, t, c in rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("100", "357", "4096", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = csv_blocks.read_quoted_csv(spark, [os.path.join(folder, "t")])
            assert df.columns == ["id", "some text", "c"]
            assert sorted((tuple(r) for r in df.collect()), key=lambda r: r[0]) == want, size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    write(folder, "open.csv", 'a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="inside quotes"):
        csv_blocks.read_quoted_csv(spark, [os.path.join(folder, "open.csv")])


def test_two_exports_of_a_table(spark, folder):
    for name in ("a_orders_dataset.csv", "b_orders_dataset.csv"):
        write(folder, name, f"order_id\n{name[0]}\n")
    with pytest.raises(ValueError, match="several files"):
        catalog.load_csv_tables(spark, folder)
    assert [r[0] for r in catalog.load_csv_tables(spark, folder, prefix="b_").tables["orders"].collect()] == ["b"]


def test_missing_review_score_is_a_violation(spark):
    def table(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    tables = {
        "order_items": table("price double, freight_value double", (0.0, -1.0), (None, None), (1.0, 0.0)),
        "order_payments": table("payment_value double", (0.0,), (None,)),
        "order_reviews": table("review_score int", (None,), (0,), (5,)),
        "products": table(
            "product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double",
            (0.0, 1.0, None, -1.0),
        ),
        "orders": spark.sql(
            "select timestamp_ntz'2020-01-02' order_purchase_timestamp, timestamp_ntz'2020-01-01' order_delivered_customer_date"
        ),
    }
    got = [r.invalid_count for r in audit.business_rules(tables).orderBy("position").collect()]
    assert got == [1, 1, 1, 2, 1, 0, 0, 1, 1]


def test_duplicates_treat_nulls_as_equal(spark):
    rows = [(1, None), (1, None), (None, "a"), (None, "a"), (None, "a"), (1, "a")]
    df = spark.createDataFrame(rows, "k int, v string")
    assert audit.exact_duplicates({"t": df}).first().exact_duplicates == 3
    assert audit.duplicate_keys(df, "k").first().duplicates == 4
    assert audit.duplicate_keys(df, "order_id").first().duplicates == 0


def test_duplicates_with_one_row_in_a_third_of_the_table(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"), F.lit("t").alias("b"))
    assert audit.exact_duplicates({"t": df}).first().exact_duplicates == 9_999


def test_hidden_nulls(spark):
    df = spark.createDataFrame([("NA", 1), ("", 2), (" - ", 3), (None, 4)], "a string, n int")
    assert [tuple(r) for r in audit.hidden_nulls({"t": df, "u": spark.range(2)}).collect()] == [("t", "a", 2)]


def test_describe(spark):
    df = spark.sql(
        "select * from values (1, 'b', timestamp_ntz'2020-01-01'), (2, 'a', null), (4, null, timestamp_ntz'2020-01-03') t(n, s, ts)"
    )
    got = {r.column: r for r in inspect.describe(df, "t").collect()}
    assert (got["n"]["count"], got["n"].mean, got["n"].p25, got["n"].max) == (3, 7 / 3, 1.5, 4.0)
    assert (got["s"]["count"], got["s"].unique, got["s"].top, got["s"].freq) == (2, 2, "a", 1)
    assert got["ts"].std is None and got["ts"].p50 == 1577923200.0


def test_csv_sink_keeps_text(spark, folder):
    df = spark.createDataFrame([(1, '  a "b", c\nd ')], "k int, v string")
    sinks.write_table(df, f"{folder}/t", "csv")
    assert catalog.read_csv(spark, [f"{folder}/t"], multiline=True).first().v == '  a "b", c\nd '


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (5.0,), (-1.0,)], "v double")
    assert [r[0] for r in df.select(fx.clip(F.col("v"), 0.0, 3.0)).collect()] == [None, 3.0, 0.0]


def test_days_are_floored(spark):
    row = spark.sql(
        "select timestamp_ntz'2020-01-01 12:00:00' a, timestamp_ntz'2020-01-01 00:00:00' b, timestamp_ntz'2020-01-02 11:59:59' c"
    ).select(fx.floor_days(F.col("a"), F.col("b")), fx.floor_days(F.col("a"), F.col("c"))).first()
    assert tuple(row) == (-1, 0)


def test_number_text_rounds_like_exact_binary_values(spark):
    values = [0.5, 1.5, 2.25, 2.35, 2.45, 2.65, 4.95, 0.05, 3.0, 99.95, -2.45, 1e6 + 0.25]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(fx.fixed_decimal_text(F.col("v")), fx.whole_text(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [(f"{v:.1f}", f"{v:.0f}") for v in values]


def test_quoted_csv_query_has_bounded_blocks(spark, monkeypatch):
    """Blocks grow with the file beyond a thousand of them, as each has tasks that report to the driver."""
    used = []
    monkeypatch.setattr(sinks, "bytes_at", lambda spark, path: 50_000_000)
    monkeypatch.setattr(catalog, "read_csv", lambda s, paths, multiline: used.append(s.conf.get("spark.sql.files.maxPartitionBytes")) or s.read.option("header", True).csv(paths))
    queries.QUERIES["io1_quoted_csv"](spark, "/root/testdata/sf0.001")
    assert used == ["50000"]


def test_duplicates_move_digests_only(spark, folder):
    """Whole rows are not shuffled to find out how few digests repeat."""
    df = spark.range(4_000).select(F.col("id"), F.expr("repeat(md5(cast(id as string)), 20)").alias("text"))
    path = sinks.write_table(df.union(df.where("id in (5, 9)")), f"{folder}/rows")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "50000")
    try:
        found = audit._repeated_rows(spark.read.parquet(path))
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.first()["n"] == 2
    finally:
        spark.conf.set(limit, before)
