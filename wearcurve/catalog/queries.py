"""Registered queries: one per operator, over whole tables."""

from __future__ import annotations

import posixpath
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.catalog.panels import (
    events_panel,
    lineitem_panel,
    silver_panel,
    table,
)
from wearcurve.catalog.staging import (
    FOREST_POINT,
    TRIAL_DATE,
    cleaned_summary,
    cleaned_table,
    forest_search,
    gold,
    gold_table,
    once,
    prepared,
    raw_path,
    raw_paths,
    source_panels,
    trained,
    tuned,
)
from wearcurve.models import forest, registry, ridge
from wearcurve.models.trees import node_table, walk
from wearcurve.operators import conform, features, normalize, quality, split, stores
from wearcurve.operators.metrics import evaluate, select_model, stack_predictions
from wearcurve.operators.ordered import over_units
from wearcurve.operators.summary import ROWS, merge_summaries, unit_summary
from wearcurve.plans.medallion import build_gold, clean, run
from wearcurve.plans.scoring import score_fleet
from wearcurve.plans.training import compare, predict
from wearcurve.schema import BRONZE_SCHEMA, CONSTANT_SENSORS, KEYS, LABEL, RAW_FIELDS, TREND_SENSORS, feature_columns, require_columns
from wearcurve.sources.sinks import shared_dir, write_bronze, write_csv, write_parquet
from wearcurve.sources.tables import load, read_csv, read_many
from wearcurve.sources.text_log import parse_lines, read_raw

# Digits kept where engines may add in different orders: deviations behind scaled values, and errors.
# Everything else is the same to the last bit.
SCALED, SUMMED, PREDICTED, RECORDED = 4, 6, 3, 5

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, less a trailing underscore."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def tidy(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Fractions as doubles, as they are or to ``digits`` digits."""

    def column(field: T.StructField):
        if not isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.col(field.name)
        value = F.col(field.name).cast("double")
        return (value if digits is None else rounded(value, digits)).alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def rounded(value, digits: int):
    scale = float(10**digits)
    return F.floor(value * scale + 0.5) / scale


# Sources and sinks


@query
def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(read_raw(spark, raw_path(spark, sf_dir)).rows)


@query
def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth line gets a field too many, every seventh an unreadable unit."""
    lines = spark.read.text(raw_path(spark, sf_dir)).select(F.trim(F.regexp_replace("value", "\t", "")).alias("value"))
    cycle = F.split("value", " ")[1].cast("int")
    broken = (
        F.when(cycle % 5 == 0, F.concat("value", F.lit(" 1.0")))
        .when(cycle % 7 == 0, F.concat(F.lit("x"), "value"))
        .otherwise(F.col("value"))
    )
    parsed = parse_lines(lines.select(broken.alias("value")))
    return parsed.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def bronze_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_csv(lineitem_panel(spark, sf_dir), shared_dir(spark, "bronze"))
    back = read_csv(spark, path)
    return tidy(back.select(*KEYS, *[F.col(c).cast("double").alias(c) for c in back.columns if c not in KEYS]))


@query
def csv_typed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_csv(lineitem_panel(spark, sf_dir), shared_dir(spark, "bronze"))
    return tidy(read_csv(spark, path, BRONZE_SCHEMA))


@query
def bronze_read_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "bronze-many")
    paths = [
        write_csv(df, posixpath.join(root, f"bronze_{i}"), compression="gzip") for i, df in enumerate(source_panels(spark, sf_dir))
    ]
    found = conform.union_sources([conform.cast_columns(df) for df in read_many(spark, paths)])
    return tidy(found.select("source", "unit", "cycle", "T24", "T50", "W32"))


@query
def load_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = silver_panel(spark, sf_dir)
    root = shared_dir(spark, "load")
    write_parquet(panel, f"{root}.parquet")
    write_csv(panel, f"{root}.csv")
    inputs = {"parquet": f"{root}.parquet", "csv": f"{root}.csv", "dataframe": panel}
    reports = [quality.raw_stats(load(spark, i)).select(F.lit(k).alias("kind"), "*") for k, i in inputs.items()]
    return reduce(DataFrame.unionByName, reports)


@query
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_path(spark, sf_dir)
    path = write_bronze(read_raw(spark, raw).rows, raw, shared_dir(spark, "bronze"), compression="gzip")
    return tidy(conform.cast_columns(read_csv(spark, path)))


@query
def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(write_parquet(silver_panel(spark, sf_dir), shared_dir(spark, "silver") + ".parquet"))


@query
def silver_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(cleaned_table(spark, sf_dir))


# Silver


@query
def silver_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_panel(spark, sf_dir)


@query
def drop_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(conform.drop_constant(silver_panel(spark, sf_dir)))


@query
def drop_correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(conform.drop_correlated(silver_panel(spark, sf_dir)))


@query
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.constant_columns(silver_panel(spark, sf_dir), RAW_FIELDS[2:])


@query
def correlated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of sensors that vary, repeated ones included."""
    varying = [c for c in RAW_FIELDS[2:] if c not in (*CONSTANT_SENSORS, "op_setting_3")]
    return tidy(conform.correlated_pairs(silver_panel(spark, sf_dir), varying), SUMMED)


@query
def silver_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(conform.union_sources(source_panels(spark, sf_dir)))


@query
def unit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(conform.conform(source_panels(spark, sf_dir)))


@query
def unit_offset_by_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = conform.conform(source_panels(spark, sf_dir), offset_by="max")
    return shifted.select("source", "unit", "cycle")


@query
def shared_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.shared_units(conform.union_sources(source_panels(spark, sf_dir)))


@query
def source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one summary a source, merged: the panel is read once."""
    panels = enumerate(source_panels(spark, sf_dir), start=1)
    parts = [unit_summary(df.withColumn("source", F.lit(i)), by=("source",)) for i, df in panels]
    return quality.source_stats(merge_summaries(parts, by=("source",)), rows=ROWS)


# Quality


@query
def integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.integrity(cleaned_summary(spark, sf_dir), rows=ROWS)


@query
def unit_summary_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_summary(cleaned_table(spark, sf_dir))


@query
def integrity_by_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text through every written layer."""
    return run(spark, [raw_path(spark, sf_dir)], shared_dir(spark, "layers"), compression="gzip")["integrity"]


@query
def layers_of_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three raw logs with colliding unit ids through every written layer: what silver makes of each."""
    return _by_source(run(spark, raw_paths(spark, sf_dir), shared_dir(spark, "layers"), compression="gzip"))


@query
def layers_of_a_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three logs, given as one pattern."""
    pattern = posixpath.join(posixpath.dirname(raw_paths(spark, sf_dir)[0]), "train_*.txt")
    return _by_source(run(spark, [pattern]))


def _by_source(layers: dict[str, DataFrame]) -> DataFrame:
    return layers["silver"].groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("unit").alias("n_units"),
        F.min("unit").alias("min_unit"),
        F.max("unit").alias("max_unit"),
        F.count("W32").alias("n_w32"),
    )


@query
def raw_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.raw_stats(read_raw(spark, raw_path(spark, sf_dir)).rows)


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"))


@query
def distinct_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.distinct_units(cleaned_table(spark, sf_dir))


# Features


@query
def max_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.last_cycles(cleaned_table(spark, sf_dir))


@query
def rul_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_rul(cleaned_table(spark, sf_dir)).select(*KEYS, LABEL)


@query
def rul_via_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = cleaned_table(spark, sf_dir)
    return features.rul_via_join(panel, summary=cleaned_summary(spark, sf_dir)).select(*KEYS, LABEL)


def _rolled(df: DataFrame, **blocks) -> DataFrame:
    rolled = features.add_rolling_mean(df.select(*KEYS, *TREND_SENSORS), **blocks)
    return tidy(rolled.drop(*TREND_SENSORS))


@query
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(cleaned_table(spark, sf_dir))


@query
def rolling_mean_hot_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answer with every unit treated as hot and cut into blocks of 64 cycles."""
    return _rolled(cleaned_table(spark, sf_dir), hot_rows=100, block_bits=6)


@query
def delta1(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = cleaned_table(spark, sf_dir).select(*KEYS, *TREND_SENSORS)
    return tidy(features.add_delta(panel).drop(*TREND_SENSORS))


@query
def delta1_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences where three rows share each cycle, every unit cut into blocks: all rows but a unit's first have one."""
    panel = cleaned_table(spark, sf_dir).select("unit", F.floor(F.col("cycle") / 3).cast("int").alias("cycle"), "Nc")
    rows = over_units(
        panel, lambda w: {"delta": F.col("Nc") - F.lag("Nc").over(w)}, columns=("Nc",), depth=1, ties=True, hot_rows=100, block_bits=4
    )
    return rows.groupBy("unit", "cycle").agg(F.count(F.lit(1)).alias("n_rows"), F.count("delta").alias("n_deltas"))


@query
def ratio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = cleaned_table(spark, sf_dir)
    return tidy(panel.select(*KEYS, *features.ratio_columns(panel)))


@query
def lifecycle_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_lifecycle(cleaned_table(spark, sf_dir).select(*KEYS))


@query
def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and all features before scaling."""
    return tidy(features.engineer(cleaned_table(spark, sf_dir)))


@query
def engineered_hot_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answer with every unit treated as hot and cut into blocks of 16 cycles."""
    return tidy(features.engineer(cleaned_table(spark, sf_dir), hot_rows=100, block_bits=4))


@query
def engineered_in_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the two features that need the unit's last cycle."""
    return tidy(features.engineer(cleaned_table(spark, sf_dir), include_lifecycle=False).drop(LABEL))


@query
def events_rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other sensors, another key: users and their events."""
    panel = events_panel(spark, sf_dir)
    return tidy(features.add_delta(features.add_rolling_mean(panel, ("value", "k"), 3), ("value", "k")), SUMMED)


@query
def events_rul(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_rul(events_panel(spark, sf_dir)).select(*KEYS, LABEL)


# Gold


@query
def feature_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(build_gold(spark, cleaned_table(spark, sf_dir)).metadata, SUMMED)


@query
def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaling alone, on the cleaned sensors."""
    return tidy(normalize.standardize(cleaned_table(spark, sf_dir))[0], SCALED)


@query
def apply_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the training units, stored as CSV, applied to every unit."""
    panel = split.assign_split(cleaned_table(spark, sf_dir))
    metadata = normalize.fit_metadata(panel, feature_columns(panel), F.col("split") == "train")
    path = write_csv(metadata, shared_dir(spark, "metadata") + ".csv", single_file=True)
    saved = spark.read.schema("feature string, mean double, std double").option("header", True).csv(path)
    return tidy(normalize.apply_metadata(panel.drop("split"), saved), SCALED)


@query
def gold_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(build_gold(spark, cleaned_table(spark, sf_dir)).full, SCALED)


@query
def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(build_gold(spark, cleaned_table(spark, sf_dir)).features, SCALED)


@query
def label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.label_store(features.add_rul(cleaned_table(spark, sf_dir)))


@query
def feature_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_table(spark, sf_dir)
    return tidy(stores.join_stores(stores.feature_store(gold), stores.label_store(gold)), SCALED)


@query
def co_located_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stores in the same buckets of the row key; their join has no exchange."""
    found = gold(spark, sf_dir)
    features_, labels = stores.write_co_located(found.narrow, stores.buckets_for(found.narrow), finish=found.scaled)
    return tidy(stores.join_stores(features_, labels), SCALED)


# Split, folds, bootstrap


@query
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.unit_split(cleaned_summary(spark, sf_dir))


@query
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel, summary = cleaned_table(spark, sf_dir), cleaned_summary(spark, sf_dir)
    return split.split_rows(panel, "test", summary=summary).select(*KEYS, "split")


@query
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the summary alone."""
    return split.split_sizes(split.assign_split(cleaned_summary(spark, sf_dir)), rows=ROWS)


@query
def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = cleaned_table(spark, sf_dir)
    return split.assign_folds(panel, summary=cleaned_summary(spark, sf_dir)).select(*KEYS, "fold")


@query
def oot_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = features.add_rul(cleaned_table(spark, sf_dir))
    return tidy(split.bootstrap(gold).select("draw", "unit", "cycle", "T24", LABEL))


# Quality of predictions


def _two_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing mean and previous value of T24, as two models of T24."""
    panel = split.assign_split(cleaned_table(spark, sf_dir).select(*KEYS, "T24"))
    guessed = over_units(
        panel,
        lambda w: {"mean": F.avg("T24").over(w.rowsBetween(-4, 0)), "previous": F.lag("T24").over(w)},
        columns=("T24",),
        depth=4,
    )
    stacked = stack_predictions(guessed, {"mean": "mean", "previous": "previous"}, target="T24", keep=("split",))
    return evaluate(stacked, target="T24")


@query
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_two_guesses(spark, sf_dir), SUMMED)


@query
def select_model_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(select_model(_two_guesses(spark, sf_dir), ("previous", "mean")), SUMMED)


# Models


@query
def require_columns_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_columns(cleaned_table(spark, sf_dir), KEYS, "panel").select(*KEYS)


@query
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector of the filled, scaled features: its size and its sum."""
    gold = gold_table(spark, sf_dir)
    names = feature_columns(gold)
    vectors = ridge.assembler(names).transform(normalize.fill_missing(gold, names))
    values = vector_to_array(ridge.VECTOR)
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return vectors.select(*KEYS, F.size(values).alias("n_features"), rounded(total, SCALED).alias("total"))


@query
def ridge_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared(spark, sf_dir)
    found = ridge.moments(ready.train, [*ready.features, LABEL])
    return found.select("fold", "i", "j", rounded(F.col("value"), 2).alias("value"))


@query
def ridge_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients under the grid's best penalty."""
    ready = prepared(spark, sf_dir)
    return tidy(ridge.coefficients(tuned(spark, sf_dir).model, ready.features, ready.train), 3)


@query
def ridge_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared(spark, sf_dir)
    found = ridge.grid(ready.train, ready.features)
    return found.select("alpha", "fold", rounded(F.col("r2"), SUMMED).alias("r2"))


@query
def forest_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of a fitted forest whatever its splits: the first point of the library's grid."""
    ready = prepared(spark, sf_dir)
    point = {name: values[0] for name, values in FOREST_POINT.items()}
    model = once(spark, sf_dir, "forest", lambda: forest.fit(ready.train, ready.features, **point))
    fitted = model.stages[-1]
    scores = [float(x) for x in fitted.featureImportances.toArray()]
    beats = compare(ready.rows, {"RandomForest": model}).agg((F.min("r2") > 0).alias("beats_mean"))
    return beats.select(
        F.lit(len(scores)).alias("n_features"),
        rounded(F.lit(sum(scores)), SUMMED).alias("importance"),
        F.lit(min(scores) >= 0).alias("none_negative"),
        F.lit(fitted.getNumTrees).alias("n_trees"),
        F.lit(max(tree.depth for tree in fitted.trees)).alias("deepest"),
        "beats_mean",
    )


@query
def forest_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows sent down saved nodes. Without resampling a leaf says the mean of its rows, so at every cut of every
    tree the predictions of all rows add up to their labels."""
    ready = prepared(spark, sf_dir)
    depths, splits, n = (0, 3, 8), (2, 500), 4
    model = forest.fit(ready.train, ready.features, maxDepth=8, numTrees=n, featureSubsetStrategy="sqrt", bootstrap=False)
    fitted = model.stages[-1]
    said = walk(
        ready.train.select(LABEL, *ready.features), node_table(fitted), ready.features, trees=n, depths=depths,
        splits=splits, levels=max(t.depth for t in fitted.trees), n_nodes=fitted.totalNumNodes, keep=(),
    )
    stacked = F.array(*[
        F.struct(F.lit(d).alias("depth"), F.lit(s).alias("min_rows"), F.col(f"p_{d}_{s}").alias("p")) for d in depths for s in splits
    ])
    each = said.select("tree", F.inline(stacked))
    totals = each.groupBy("tree", "depth", "min_rows").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("p").alias("total"))
    return totals.withColumn("total", rounded(F.col("total"), 1))


@query
def forest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean error of all 48 points of the forest's grid, every tree grown on a draw of all rows of its folds."""
    return forest_search(spark, sf_dir).results


@query
def grid_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean score of every penalty, best first."""
    scores = ridge.mean_scores(tuned(spark, sf_dir).results)
    ordered = scores.orderBy(F.desc("mean_r2"), "alpha")
    return ordered.select("alpha", rounded(F.col("mean_r2"), SUMMED).alias("mean_r2"))


@query
def predict_(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = predict(tuned(spark, sf_dir).model, prepared(spark, sf_dir).rows)
    return tidy(predicted.select(*KEYS, "split", LABEL, "RUL_pred"), PREDICTED)


@query
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge in numbers; a forest's splits depend on its engine, so of it whether it beats the mean."""
    exact = F.col("model") == "Ridge"
    found = trained(spark, sf_dir)[0].metrics
    scores = [F.when(exact, rounded(F.col(c), RECORDED)).alias(c) for c in ("mae", "rmse", "r2")]
    return found.select("model", "split", "n_rows", *scores, (F.col("r2") > 0).alias("beats_mean"))


@query
def model_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = trained(spark, sf_dir)[0]
    best = found.metrics.filter("split = 'val'").agg(F.max("r2"))
    is_best = (F.col("r2") == best.scalar()).alias("is_best")
    return found.selected.select("split", "n_rows", is_best, F.col("model").isin(*registry.MODEL_NAMES).alias("known_name"))


def _facts(record: DataFrame) -> DataFrame:
    """A record without the forest's own numbers."""
    m = F.col("metrics")
    scores = [
        rounded(m["Ridge"][split][name], RECORDED).alias(f"ridge_{split.lower()}_{name.lower()}")
        for split in ("Val", "Test")
        for name in ("MAE", "RMSE", "R2")
    ]
    best = F.greatest(m["Ridge"]["Val"]["R2"], m["RandomForest"]["Val"]["R2"])
    first = F.when(m["RandomForest"]["Val"]["R2"] >= m["Ridge"]["Val"]["R2"], "RandomForestRegressor")
    named = F.col("model_name") == first.otherwise("RidgeRegression")
    return record.select(
        "model_version",
        "train_date",
        F.array_join("features_used", ",").alias("features_used"),
        F.size("features_used").alias("n_features"),
        "train_size",
        "val_size",
        "test_size",
        "random_seed",
        F.array_join(F.col("split_shares").cast("array<string>"), ",").alias("split_shares"),
        *scores,
        ((m["Selected"]["Val_R2"] == best) & named).alias("selected_is_best"),
    )


@query
def model_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(trained(spark, sf_dir)[0].record)


@query
def save_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selected model beside its record."""
    found, _ = trained(spark, sf_dir)
    bank = shared_dir(spark, "models")
    registry.save(found.model, found.record, bank)
    return _facts(registry.records(spark, bank))


@query
def latest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(registry.latest(spark, trained(spark, sf_dir)[1]))


def _ridge_bank(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the tuned ridge and a record of it alone."""

    def make() -> str:
        bank, ready, model = shared_dir(spark, "models"), prepared(spark, sf_dir), tuned(spark, sf_dir).model
        metrics = compare(ready.rows, {"Ridge": model})
        sizes = split.split_sizes(ready.rows)
        record = registry.build_record(
            metrics, sizes, ready.features, TRIAL_DATE, seed=ready.seed, shares=ready.shares
        )
        registry.save(model, record, bank)
        return bank

    return once(spark, sf_dir, "ridge-bank", make)


@query
def load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a ridge that went through storage."""
    bank = _ridge_bank(spark, sf_dir)
    version = registry.latest(spark, bank).first()["model_version"]
    predicted = predict(registry.load(bank, version), prepared(spark, sf_dir).rows)
    return tidy(predicted.select(*KEYS, "split", LABEL, "RUL_pred"), PREDICTED)


@query
def oot_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir).rows
    scored = score_fleet(spark, rows, _ridge_bank(spark, sf_dir), out=shared_dir(spark, "oot"))
    return tidy(scored.predictions, PREDICTED)


@query
def oot_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_fleet(spark, prepared(spark, sf_dir).rows, _ridge_bank(spark, sf_dir))
    return tidy(scored.metrics.drop("model"), SUMMED)
