"""The whole run from input tables to segment findings."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronscope.operators import audit, charts, cluster, evaluate, features, prep, segments
from patronscope.operators.clean import clean_and_write
from patronscope.operators.inspect import column_list
from patronscope.plans.stages import Manifest, table_signature
from patronscope.session import scratch_path
from patronscope.sources import sinks
from patronscope.sources.catalog import Tables, load_csv_tables


@dataclass
class RunResult:
    """Tables of a run, read from where they are written, and the stages that this run has computed."""

    tables: Tables
    columns: DataFrame
    audits: dict[str, DataFrame]
    features: DataFrame
    segments: DataFrame
    labeled: dict[str, DataFrame]
    evaluation: DataFrame
    sizes: DataFrame
    profile: DataFrame
    insights: DataFrame
    k: int
    model: str
    eda: dict[str, DataFrame] = field(default_factory=dict)
    feature_views: dict[str, DataFrame] = field(default_factory=dict)
    k_curve: DataFrame | None = None
    computed: list[str] = field(default_factory=list)


def saved(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a table and continue from the written copy, which needs no recomputation."""
    spark = df.sparkSession
    sinks.write_table(df, path, fmt)
    if fmt == "csv":
        return spark.read.option("header", True).option("escape", '"').schema(df.schema).csv(path)
    return spark.read.parquet(path)


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """The saved feature table, to start at the clustering stage."""
    return spark.read.parquet(path)


def build_features(tables: Tables) -> DataFrame:
    """The one-chain plan if order keys are unique, else the plan over the flat table."""
    repeated = audit.duplicate_keys(tables["orders"], "order_id").first()[0]
    repeated += audit.duplicate_keys(tables["customers"], "customer_id").first()[0]
    return features.features_from_flat(tables) if repeated else features.customer_features(tables)


def run(
    raw: Tables,
    out: str | None = None,
    eda: bool = True,
    feature_views: bool = True,
    k: int | None = cluster.DEFAULT_K,
    restarts: int = cluster.RESTARTS,
    k_search: bool = True,
    fmt: str = "parquet",
) -> RunResult:
    """Clean, derive, cluster, evaluate and describe.

    ``out`` is the folder for results, by default one below the shared folder; ``fmt`` is parquet or csv. ``k=None`` takes the K of the highest
    silhouette; the curve is written also when K is given, unless ``k_search`` is off. A second run with the same inputs and settings reads
    what the first has written, and one with other settings begins at the first stage that they change.
    """
    spark = next(iter(raw.values())).sparkSession
    out = (out or scratch_path(spark, "run")).rstrip("/")
    manifest = Manifest(spark, out, fmt)

    def clean():
        cleaned = clean_and_write(raw, f"{out}/processed", fmt=fmt)
        return {**{f"processed/{n}_clean": df for n, df in cleaned.tables.items()}, **{f"metrics/{n}": df for n, df in cleaned.audits.items()}}, {}

    first = manifest.run("clean", {}, [f"{n} {table_signature(df)}" for n, df in sorted(raw.items())], clean, str)
    tables = {n: first.tables[f"processed/{n}_clean"] for n in raw}
    table = manifest.run("features", {}, [first.signature], lambda: ({"customer_features": build_features(tables)}, {}), "processed/{}".format)
    features_ = table.tables["customer_features"]
    chart = "charts/{}".format
    views = {}
    if eda:
        views = manifest.run("eda", {}, [first.signature], lambda: (charts.eda_tables(tables), {}), chart).tables
    feature_charts = {}
    if feature_views:
        feature_charts = manifest.run("feature views", {}, [table.signature], lambda: (charts.feature_tables(features_), {}), chart).tables

    def curve():
        scaled = prep.fit_scaling(features_).transform(features_)
        choice = cluster.choose_k(scaled, restarts=restarts)
        return {"k_curve": choice.curve}, {"k": choice.k}

    search = None
    if k_search or k is None:
        search = manifest.run("k search", {"restarts": restarts}, [table.signature], curve, "metrics/{}".format)
    k = search.values["k"] if k is None else k

    def models():
        scaling = prep.fit_scaling(features_)
        found = cluster.fit_models(scaling.transform(features_), k, restarts)
        cluster.save_model(scaling, found.kmeans, f"{out}/models/segments")
        return {f"labels_{m}": df.select(cluster.WHO, *prep.SCALED, "label") for m, df in found.labeled.items()}, {"model": f"{out}/models/segments"}

    fitted = manifest.run("clusterings", {"k": k, "restarts": restarts}, [table.signature], models, "models/{}".format)
    labeled = {n.removeprefix("labels_"): df for n, df in fitted.tables.items()}

    def scores():
        sizes = [evaluate.cluster_sizes(df).select(F.lit(m).alias("model"), "label", "share") for m, df in labeled.items()]
        return {"clustering_model_comparison": evaluate.evaluate_all(labeled), "cluster_sizes": reduce(DataFrame.unionByName, sizes)}, {}

    scored = manifest.run("evaluation", {}, [fitted.signature], scores, "metrics/{}".format).tables

    def report():
        return {"customer_segments": segments.assign_segments(features_, labeled["kmeans"])}, {}

    assigned = manifest.run("segments", {}, [table.signature, fitted.signature], report, "segments/{}".format)

    def profile():
        named = segments.name_segments(segments.profile_segments(assigned.tables["customer_segments"]))  # one row per segment
        return {"segment_profile_named": named}, {}

    named = manifest.run("profile", {}, [assigned.signature], profile, "segments/{}".format)

    def findings():
        rows = named.tables["segment_profile_named"]
        lines = segments.insights(rows)
        sinks.write_text(lines, f"{out}/segments/business_insights")
        return {"segment_profile_table": rows.drop("segment_name"), "insight_lines": lines}, {}

    told = manifest.run("findings", {}, [named.signature], findings, "segments/{}".format)
    return RunResult(
        tables=tables,
        columns=column_list(tables),
        audits={n.removeprefix("metrics/"): df for n, df in first.tables.items() if n.startswith("metrics/")},
        features=features_,
        segments=assigned.tables["customer_segments"],
        labeled=labeled,
        evaluation=scored["clustering_model_comparison"],
        sizes=scored["cluster_sizes"],
        profile=named.tables["segment_profile_named"],
        insights=told.tables["insight_lines"],
        k=k,
        model=fitted.values["model"],
        eda=views,
        feature_views=feature_charts,
        k_curve=search.tables["k_curve"] if search else None,
        computed=manifest.computed,
    )


def run_from_csv(spark: SparkSession, folder: str, out: str | None = None, prefix: str = "*", **options) -> RunResult:
    return run(load_csv_tables(spark, folder, prefix=prefix).tables, out, **options)
