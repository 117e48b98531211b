"""Cleaning steps. Each takes and returns a dict of tables; inputs are not changed."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronscope import schema
from patronscope.functions.columns import floor_days, null_if_in, strip, union_all
from patronscope.operators import audit
from patronscope.sources import sinks
from patronscope.sources.catalog import Tables, require


def plain_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def rename_columns(tables: Tables) -> Tables:
    out = {}
    for dataset, df in tables.items():
        names = [plain_name(c) for c in df.columns]
        clash = {n for n in names if names.count(n) > 1}
        if clash:
            raise ValueError(f"{dataset}: column names collide after cleaning: {sorted(clash)}")
        out[dataset] = df.toDF(*names)
    return out


def _map_text(tables: Tables, f) -> Tables:
    out = {}
    for name, df in tables.items():
        text = set(audit.text_columns(df))
        out[name] = df.select(*[f(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns])
    return out


def strip_text(tables: Tables) -> Tables:
    """Trim text, then turn null tokens into null; an empty text stays as it is."""
    tokens = [t for t in schema.HIDDEN_NULL_TOKENS if t]
    return _map_text(tables, lambda c: null_if_in(strip(c), tokens))


def lower_text(tables: Tables) -> Tables:
    return _map_text(tables, lambda c: strip(F.lower(c)))


def standardize_labels(tables: Tables) -> Tables:
    """Replace whole values of the label columns where they occur."""
    out = {}
    for name, df in tables.items():
        for column, labels in schema.STANDARD_LABELS.items():
            if column in df.columns:
                df = df.replace(labels, subset=[column])
        out[name] = df
    return out


def label_log(spark: SparkSession, tables: Tables) -> DataFrame:
    """(dataset, column, old_value, new_value, rows): every replacement rule and the rows it changes in ``tables``."""
    frames = []
    for name, df in tables.items():
        rules = label_rules(df)
        if rules:
            entries = [
                F.struct(F.lit(name).alias("dataset"), F.lit(c).alias("column"), F.lit(old).alias("old_value"),
                         F.lit(new).alias("new_value"), F.col(m).alias("rows"))
                for m, (c, old, new) in rules.items()
            ]
            counted = df.agg(*[label_count(c, old).alias(m) for m, (c, old, _) in rules.items()])
            frames.append(counted.select(F.inline(F.array(*entries))))
    return union_all(frames) if frames else spark.createDataFrame([], LOG_SCHEMA)


LOG_SCHEMA = "dataset string, column string, old_value string, new_value string, rows long"


def label_rules(df: DataFrame) -> dict[str, tuple[str, str, str]]:
    """(column, old value, new value) of the rules that apply to the columns of ``df``, by a name for their count."""
    found = [(c, old, new) for c, labels in schema.STANDARD_LABELS.items() if c in df.columns for old, new in labels.items()]
    return {f"label{i}": rule for i, rule in enumerate(found)}


def label_count(column: str, old: str) -> Column:
    return F.count_if(F.col(column) == old)


# --- types ------------------------------------------------------------------------------

#: Notations of dates: name, pattern, and how the groups make a text that a cast reads. Fixed values. Earlier ones win ties.
DATE_NOTATIONS = [
    ("iso", r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[ tT](.*))?$", "$1-$2-$3 $4"),
    ("year/month/day", r"^(\d{4})/(\d{1,2})/(\d{1,2})(?:[ tT](.*))?$", "$1-$2-$3 $4"),
    ("day/month/year", r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})(?:[ tT](.*))?$", "$3-$2-$1 $4"),
    ("month/day/year", r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})(?:[ tT](.*))?$", "$3-$1-$2 $4"),
]
INTEGER, LONG, DOUBLE = "int", "bigint", "double"
EXACT_DOUBLE = float(1 << 53)


def parse_timestamp(c: Column, notation: str = "iso") -> Column:
    """A date, or a date and a time of day with or without seconds and their fraction, as wall-clock time; else null."""
    _, pattern, text = next(n for n in DATE_NOTATIONS if n[0] == notation)
    read = F.trim(F.regexp_replace(c, pattern, text)).try_cast("timestamp_ntz")
    # most ISO texts can be cast as they are, which saves rewriting them
    return F.when(c.rlike(pattern), F.coalesce(c.try_cast("timestamp_ntz"), read) if notation == "iso" else read)


def parse_number(c: Column, kind: str) -> Column:
    """A number of the kind; whole numbers also when written with a zero fraction such as ``40.0``. Anything else is null."""
    number = c.try_cast("double")
    if kind == DOUBLE:
        return number
    whole = F.when((number == F.floor(number)) & (F.abs(number) <= EXACT_DOUBLE), number.try_cast("bigint"))
    return F.coalesce(c.try_cast("bigint"), whole).try_cast(kind)


@dataclass(frozen=True)
class ColumnType:
    """How the texts of a column are read, and how many are lost by that."""

    kind: str  # timestamp_ntz, int, bigint or double
    notation: str | None
    texts: int
    lost: int

    def read(self, c: Column) -> Column:
        return parse_timestamp(c, self.notation) if self.notation else parse_number(c, self.kind)


def infer_types(tables: Tables) -> dict[tuple[str, str], ColumnType]:
    """The type of every declared column that is text, by the votes of all its values; one aggregate per table.

    A date column has the notation that most of its texts follow. A column of whole numbers is ``int``, or ``bigint`` if one
    needs it; a fraction in it makes it ``double``, so no number is lost.
    """
    found = {}
    for name, df in tables.items():
        text = set(audit.text_columns(df))
        dates = [c for c in schema.TIMESTAMP_COLUMNS.get(name, []) if c in text]
        whole = [c for c in schema.INTEGER_COLUMNS.get(name, []) if c in text]
        doubles = [c for c in schema.DOUBLE_COLUMNS.get(name, []) if c in text]
        votes = {(c, "texts"): F.count(c) for c in [*dates, *whole, *doubles]}
        votes |= {(c, n): F.count(parse_timestamp(F.col(c), n)) for c in dates for n, _, _ in DATE_NOTATIONS}
        votes |= {(c, k): F.count(parse_number(F.col(c), k)) for c in whole for k in (INTEGER, LONG, DOUBLE)}
        votes |= {(c, DOUBLE): F.count(parse_number(F.col(c), DOUBLE)) for c in doubles}
        if not votes:
            continue
        row = df.agg(*[v.alias(f"v{i}") for i, v in enumerate(votes.values())]).first()
        n = dict(zip(votes, row, strict=True))
        for c in dates:
            best = max((n[c, k] for k, _, _ in DATE_NOTATIONS))
            notation = next(k for k, _, _ in DATE_NOTATIONS if n[c, k] == best)
            found[name, c] = ColumnType("timestamp_ntz", notation, n[c, "texts"], n[c, "texts"] - best)
        for c in whole:
            kind = next(k for k in (INTEGER, LONG, DOUBLE) if n[c, k] == n[c, DOUBLE])
            found[name, c] = ColumnType(kind, None, n[c, "texts"], n[c, "texts"] - n[c, DOUBLE])
        for c in doubles:
            found[name, c] = ColumnType(DOUBLE, None, n[c, "texts"], n[c, "texts"] - n[c, DOUBLE])
    return found


def type_log(spark: SparkSession, types: dict[tuple[str, str], ColumnType]) -> DataFrame:
    """(dataset, column, kind, notation, texts, lost) of the inferred types."""
    rows = [(d, c, t.kind, t.notation, t.texts, t.lost) for (d, c), t in types.items()]
    return spark.createDataFrame(rows, "dataset string, column string, kind string, notation string, texts long, lost long")


def fix_types(tables: Tables, types: dict[tuple[str, str], ColumnType] | None = None) -> Tables:
    """Typed columns; values that cannot be read become null. Absent columns are skipped, typed ones keep their numbers."""
    types = infer_types(tables) if types is None else types
    out = {}
    for name, df in tables.items():
        casts = {c: t.read(F.col(c)) for (d, c), t in types.items() if d == name}
        text = set(audit.text_columns(df))
        casts |= {c: F.col(c).cast("timestamp_ntz") for c in schema.TIMESTAMP_COLUMNS.get(name, []) if c not in text}
        casts |= {c: F.col(c).cast(T.DoubleType()) for c in schema.DOUBLE_COLUMNS.get(name, []) if c not in text}
        # category columns stay strings: Parquet encodes them with a dictionary
        out[name] = df.withColumns({c: e for c, e in casts.items() if c in df.columns})
    return out


# --- rows and names by column -----------------------------------------------------------


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Orders with a delivery date."""
    return orders.dropna(subset=["order_delivered_customer_date"])


def delivery_days(orders: DataFrame, longest: int = 60) -> DataFrame:
    """(order_id, days): whole days from purchase to delivery, 0 to ``longest``."""
    days = floor_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    return orders.select("order_id", days.alias("days")).where(F.col("days").between(0, longest))


def product_categories(products: DataFrame) -> DataFrame:
    return products.select("product_id", F.col("product_category_name").alias("category"))


# --- the whole step ---------------------------------------------------------------------


@dataclass
class CleanResult:
    tables: Tables
    audits: dict[str, DataFrame]


def _named(tables: Tables) -> Tables:
    return lower_text(strip_text(rename_columns(tables)))


def clean_tables(tables: Tables) -> CleanResult:
    """Audit the raw tables, clean and type them, then check the business rules."""
    require(tables, "orders")
    spark = tables["orders"].sparkSession
    named = _named(tables)
    types = infer_types(named)
    typed = fix_types(standardize_labels(named), types)
    audits = {
        "missing_values_audit": audit.missing_values(tables),
        "exact_duplicates_audit": audit.exact_duplicates(tables),
        "duplicate_order_ids": audit.duplicate_keys(tables["orders"]),
        "hidden_nulls_audit": audit.hidden_nulls(tables),
        "text_label_mapping_log": label_log(spark, named),
        "business_rule_validation": audit.business_rules(typed),
    }
    return CleanResult(typed, {**audits, "type_log": type_log(spark, types)})


def clean_and_write(tables: Tables, folder: str, suffix: str = "_clean", fmt: str = "parquet") -> CleanResult:
    """The same, with the cleaned tables written to ``folder`` and read back.

    Missing values, hidden nulls, label changes and rule violations are counted while a table is written, so each table
    is read once for all of them. Only the types of text columns and the duplicates need passes of their own.
    """
    require(tables, "orders", *{t for _, t, _ in audit.RULES})
    spark = tables["orders"].sparkSession
    types = infer_types(_named(tables))
    written, counted = {}, {}
    for name, df in tables.items():
        seen = Observation(f"raw {name}")
        raw = df.observe(seen, F.count(F.lit(1)).alias("rows"), *audit.raw_counts(df))
        named = _named({name: raw})[name]
        labels, rules = label_rules(named), audit.rule_counts(name)
        changed, checked = Observation(f"labels {name}"), Observation(f"rules {name}")
        if labels:
            named = named.observe(changed, *[label_count(c, old).alias(m) for m, (c, old, _) in labels.items()])
        typed = fix_types(standardize_labels({name: named}), {k: t for k, t in types.items() if k[0] == name})[name]
        if rules:
            typed = typed.observe(checked, *rules)
        path = sinks.write_table(typed, f"{folder.rstrip('/')}/{name}{suffix}", fmt)
        written[name] = sinks.read_table(spark, path, typed.schema, fmt)
        counted[name] = seen.get | (changed.get if labels else {}) | (checked.get if rules else {})
    audits = audit.from_counts(spark, tables, counted)
    audits["exact_duplicates_audit"] = audit.exact_duplicates(tables)
    audits["duplicate_order_ids"] = audit.duplicate_keys(tables["orders"])
    log = [(n, *rule, counted[n][m]) for n, df in tables.items() for m, rule in label_rules(rename_columns({n: df})[n]).items()]
    audits["text_label_mapping_log"] = spark.createDataFrame(log, LOG_SCHEMA)
    audits["type_log"] = type_log(spark, types)
    return CleanResult(written, audits)
