"""The registered queries as plain SQL over the same tables, for checking by another engine."""

from __future__ import annotations

from collections.abc import Sequence

from wearcurve.catalog.panels import LINEITEM_ORDER, LINEITEM_SENSORS
from wearcurve.schema import (
    CONSTANT_SENSORS,
    CORRELATED_SENSORS,
    EXPECTED_UNITS,
    OOT_UNITS,
    RATIO_EPSILON,
    RATIOS,
    RAW_FIELDS,
    SEED,
    TREND_SENSORS,
)

# Penalties and folds of the ridge grid.
ALPHAS = (0.1, 1.0, 10.0, 50.0, 100.0)
CV_FOLDS = 3
# Groups from this number on hold all folds.
WHOLE = 1000

SENSORS = RAW_FIELDS[2:]
KEPT = [c for c in SENSORS if c not in CONSTANT_SENSORS + CORRELATED_SENSORS]
TRENDS = [f"{s}_{kind}" for s in TREND_SENSORS for kind in ("roll5_mean", "delta1")]
LIFECYCLE = ["cycle_norm", "health_index"]
FEATURES = [*KEPT, *TRENDS, *RATIOS, *LIFECYCLE]


def _panel(*keep: str) -> str:
    fields = ",\n       ".join(f"{sql} AS {name}" for name, sql in LINEITEM_SENSORS.items())
    extra = "".join(f", {c}" for c in keep)
    return f"""SELECT CAST(l_suppkey AS INT) AS unit,
       CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY {", ".join(LINEITEM_ORDER)}) AS INT) AS cycle,
       {fields}{extra}
FROM lineitem"""


def _floats(columns: Sequence[str]) -> str:
    return ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in columns)


def _rounded(expression: str, digits: int) -> str:
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"floor(({expression}) * {scale} + 0.5) / {scale}"


def _tidy(columns: Sequence[str], digits: int | None = None) -> str:
    values = {c: f"CAST({c} AS DOUBLE)" for c in columns}
    return ", ".join(f"{v if digits is None else _rounded(v, digits)} AS {c}" for c, v in values.items())


def _trend(s: str) -> str:
    return (
        f"avg(CAST({s} AS DOUBLE)) OVER (PARTITION BY unit ORDER BY cycle ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
        f" AS {s}_roll5_mean, COALESCE({s} - lag({s}) OVER (PARTITION BY unit ORDER BY cycle), CAST(0 AS FLOAT))"
        f" AS {s}_delta1"
    )


def _ratio(name: str) -> str:
    a, b = RATIOS[name]
    guarded = f"NULLIF({b} + CAST({RATIO_EPSILON} AS FLOAT), CAST(0 AS FLOAT))"
    return f"CAST(CAST({a} AS DOUBLE) / CAST({guarded} AS DOUBLE) AS FLOAT) AS {name}"


_SHARE = "CAST(cycle AS DOUBLE) / CAST(max(cycle) OVER (PARTITION BY unit) AS DOUBLE)"
_LIFECYCLE = f"{_SHARE} AS cycle_norm, 1 - {_SHARE} AS health_index"
_RUL = "max(cycle) OVER (PARTITION BY unit) - cycle AS RUL"


def _mean(c: str) -> str:
    """Summed as floats, which is exact in double, plus the rest."""
    coarse = f"CAST(CAST({c} AS FLOAT) AS DOUBLE)"
    return f"(sum({coarse}) + sum(CAST({c} AS DOUBLE) - {coarse})) / count({c})"


def _stats(columns: Sequence[str], source: str, where: str = "") -> str:
    """One row of mean and deviation per column; a column that does not vary has its value and 1."""
    fields = ", ".join(
        f"CASE WHEN min({c}) = max({c}) THEN CAST(min({c}) AS DOUBLE) ELSE {_mean(c)} END AS {c}_m, "
        f"CASE WHEN min({c}) = max({c}) THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS {c}_s"
        for c in columns
    )
    return f"SELECT {fields} FROM {source} {where}"


def _scaled_by_subquery(columns: Sequence[str]) -> str:
    """Scaled columns whose statistics are scalar subqueries of the table ``s``."""
    return ", ".join(f"(CAST({c} AS DOUBLE) - (SELECT {c}_m FROM s)) / (SELECT {c}_s FROM s) AS {c}" for c in columns)


def _scaled(columns: Sequence[str]) -> str:
    return ", ".join(f"(CAST({c} AS DOUBLE) - {c}_m) / {c}_s AS {c}" for c in columns)


_ORDER = f"md5('{SEED}:' || unit), unit"
_SPLIT = f"""SELECT unit, CASE WHEN place <= floor(n * 0.7::DOUBLE) THEN 'train'
              WHEN place <= floor(n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split, place, n
FROM (SELECT unit, row_number() OVER (ORDER BY {_ORDER}) AS place, count(*) OVER () AS n
      FROM (SELECT DISTINCT unit FROM cleaned))"""

CTES = {
    "panel": _panel(),
    "silver": f"SELECT unit, cycle, {_floats(SENSORS)} FROM panel",
    "cleaned": f"SELECT unit, cycle, {', '.join(KEPT)} FROM silver",
    "engineered": f"""SELECT unit, cycle, {", ".join(KEPT)}, {_RUL},
       {", ".join(map(_trend, TREND_SENSORS))},
       {", ".join(map(_ratio, RATIOS))}, {_LIFECYCLE} FROM cleaned""",
    "stats": _stats(FEATURES, "engineered"),
    "gold": f"SELECT unit, cycle, {_scaled(FEATURES)}, RUL FROM engineered CROSS JOIN stats",
    "splits": _SPLIT,
    "flagged": _panel("l_returnflag"),
    "sources": f"""SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS source, unit, cycle,
       {", ".join(c for c in SENSORS if c != "W32")},
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE W32 END AS W32
FROM flagged""",
    "guesses": """SELECT unit, cycle, T24,
       avg(CAST(T24 AS DOUBLE)) OVER (PARTITION BY unit ORDER BY cycle ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS mean,
       CAST(lag(T24) OVER (PARTITION BY unit ORDER BY cycle) AS DOUBLE) AS previous
FROM cleaned""",
    "stacked": """SELECT model, split, CASE WHEN p IS NOT NULL THEN CAST(T24 AS DOUBLE) END AS y, p FROM (
  SELECT unit, T24, 'mean' AS model, mean AS p FROM guesses
  UNION ALL SELECT unit, T24, 'previous', previous FROM guesses) JOIN splits USING (unit)""",
    "scores": """SELECT model, split, count(y) AS n_rows, count(*) - count(y) AS n_skipped, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
       CASE WHEN count(y) < 2 THEN NULL
            WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))
            WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END AS r2
FROM stacked GROUP BY model, split""",
    "filled": f"""SELECT unit, cycle, {", ".join(f"COALESCE({c}, 0.0) AS {c}" for c in FEATURES)}, RUL FROM gold""",
    "folded": """SELECT *, CAST(ntile(3) OVER (ORDER BY unit, cycle) - 1 AS INT) AS fold
FROM filled JOIN (SELECT unit, split FROM splits) USING (unit) WHERE split = 'train'""",
}
# What each of them reads, directly.
USES = {
    "silver": ["panel"], "cleaned": ["silver"], "engineered": ["cleaned"], "stats": ["engineered"],
    "gold": ["engineered", "stats"], "splits": ["cleaned"], "sources": ["flagged"], "guesses": ["cleaned"],
    "stacked": ["guesses", "splits"], "scores": ["stacked"], "filled": ["gold"], "folded": ["filled", "splits"],
}


def _with(body: str, *needs: str, **own: str) -> str:
    """``body`` behind the common table expressions it needs, and its own."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        for used in USES.get(name, []):
            add(used)
        wanted.add(name)

    for name in needs:
        add(name)
    # Each is computed once: several are read twice, as rows and as the statistics of these rows.
    parts = [f"{n} AS MATERIALIZED ({sql})" for n, sql in CTES.items() if n in wanted]
    parts += [f"{n} AS ({sql})" for n, sql in own.items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}"


def _ridge(groups: str) -> dict[str, str]:
    """Ridge per group of moment rows by Gaussian elimination on standardised features.

    ``groups`` selects ``g, alpha, i, j, value``: sums of products of (1, features, label) for i <= j.
    The penalty keeps every pivot positive, so rows need no exchange. Yields ``weights(g, i, w)`` with
    the intercept at 0.
    """
    p, y = len(FEATURES), len(FEATURES) + 1
    return {
        "grams": groups,
        "size": "SELECT g, value AS n FROM grams WHERE i = 0 AND j = 0",
        "means": "SELECT g, j AS i, value / n AS mean FROM grams JOIN size USING (g) WHERE grams.i = 0 AND j > 0",
        "spreads": """SELECT g, i, mean, CASE WHEN v > 1e-12 * greatest(mean * mean, 1e-300) THEN sqrt(v) END AS std
FROM (SELECT means.g, means.i, mean, value / n - mean * mean AS v
      FROM means JOIN grams ON grams.g = means.g AND grams.i = means.i AND grams.j = means.i
      JOIN size ON size.g = means.g)""",
        "cells": f"""SELECT grams.g, grams.i, grams.j,
       CASE WHEN a.std IS NULL OR (b.std IS NULL AND grams.j < {y}) THEN 0.0
            ELSE (value - n * a.mean * b.mean) / a.std / CASE WHEN grams.j = {y} THEN 1.0 ELSE b.std END END
       + CASE WHEN grams.i = grams.j THEN alpha ELSE 0.0 END AS v
FROM grams JOIN spreads a ON a.g = grams.g AND a.i = grams.i JOIN spreads b ON b.g = grams.g AND b.i = grams.j
JOIN size ON size.g = grams.g WHERE grams.i BETWEEN 1 AND {p} AND grams.j >= 1""",
        "whole": f"SELECT g, i, j, v FROM cells UNION ALL SELECT g, j, i, v FROM cells WHERE i < j AND j <= {p}",
        "start": """SELECT g, list(line ORDER BY i) AS m FROM (
  SELECT g, i, list(v ORDER BY j) AS line FROM whole GROUP BY g, i) GROUP BY g""",
        "steps": f"""SELECT g, 1 AS k, m FROM start
UNION ALL SELECT g, k + 1, list_transform(m, lambda line, r: list_transform(line, lambda x, c:
         CASE WHEN r = k THEN x / m[k][k] ELSE x - line[k] * m[k][c] / m[k][k] END)) FROM steps WHERE k <= {p}""",
        "slopes": f"""SELECT s.g, i, m[i][{y}] / COALESCE(std, 1.0) AS w, mean
FROM steps s JOIN spreads USING (g) WHERE k = {y} AND i <= {p}""",
        "weights": f"""SELECT g, i, w FROM slopes
UNION ALL SELECT slopes.g, 0, any_value(y.mean) - sum(w * slopes.mean)
FROM slopes JOIN means y ON y.g = slopes.g AND y.i = {y} GROUP BY slopes.g""",
    }


def _report(source: str) -> str:
    return f"""SELECT count(*) AS n_rows, count(DISTINCT unit) AS n_units,
       count(DISTINCT unit) <> {EXPECTED_UNITS} AS warning FROM {source}"""


def _offset(size: str) -> str:
    return f"""SELECT source, CAST(COALESCE(sum(size) OVER (ORDER BY source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS off
FROM (SELECT source, {size} AS size FROM sources GROUP BY source)"""


def oracles() -> dict[str, str]:
    panel = _with(f"SELECT unit, cycle, {_tidy(SENSORS)} FROM panel", "panel")
    silver = _with(f"SELECT unit, cycle, {_tidy(SENSORS)} FROM silver", "silver")
    rul = _with(f"SELECT unit, cycle, {_RUL} FROM cleaned", "cleaned")
    means = [f"{s}_roll5_mean" for s in TREND_SENSORS]
    rolled = _with(f"SELECT unit, cycle, {_tidy(means)} FROM engineered", "engineered")
    measured = [c for c in FEATURES if c not in LIFECYCLE]
    engineered = _with(f"SELECT unit, cycle, RUL, {_tidy(FEATURES)} FROM engineered", "engineered")
    gold = _with(f"SELECT unit, cycle, RUL, {_tidy(FEATURES, 4)} FROM gold", "gold")
    scored = _with(f"SELECT model, split, n_rows, n_skipped, {_tidy(['mae', 'rmse', 'r2'], 6)} FROM scores", "scores")
    stats = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_rounded(f'{c}_m', 6)} AS mean, {_rounded(f'{c}_s', 6)} AS std FROM stats"
        for c in FEATURES
    )
    events = """SELECT CAST(user_id AS INT) AS unit,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts) AS INT) AS cycle,
       value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"""
    columns = [*FEATURES, "RUL"]
    terms = ["CAST(1 AS DOUBLE)", *[f"CAST({c} AS DOUBLE)" for c in columns]]
    long = " UNION ALL ".join(
        f"SELECT unit, cycle, fold, {i} AS i, {term} AS v FROM folded" for i, term in enumerate(terms)
    )
    products = f"""SELECT a.fold, a.i, b.i AS j, sum(a.v * b.v) AS value
FROM long a JOIN long b ON a.unit = b.unit AND a.cycle = b.cycle AND a.i <= b.i GROUP BY a.fold, a.i, b.i"""
    # One group per penalty and held-out fold, over the other folds, and one per penalty over all of them.
    penalties = ", ".join(f"({CV_FOLDS * n}, {alpha}::DOUBLE)" for n, alpha in enumerate(ALPHAS))
    without_fold = f"""SELECT base + k AS g, alpha, i, j, sum(value) AS value
FROM products, (VALUES {penalties}) AS penalties(base, alpha), range({CV_FOLDS}) AS folds(k)
WHERE fold <> k GROUP BY base, k, alpha, i, j"""
    everything = f"""SELECT {WHOLE} + base AS g, alpha, i, j, sum(value) AS value
FROM products, (VALUES {penalties}) AS penalties(base, alpha) GROUP BY base, alpha, i, j"""
    last = len(columns)
    held_out = {
        "residual": f"""SELECT g, i, -w AS r FROM weights WHERE g < {WHOLE}
UNION ALL SELECT DISTINCT g, {last}, 1.0 FROM weights WHERE g < {WHOLE}""",
        "scored": f"""SELECT a.g,
       sum(CASE WHEN p.i = p.j THEN 1 ELSE 2 END * a.r * b.r * p.value) AS sse,
       max(CASE WHEN p.i = {last} AND p.j = {last} THEN p.value END)
       - max(CASE WHEN p.i = 0 AND p.j = {last} THEN p.value END) ** 2
       / max(CASE WHEN p.i = 0 AND p.j = 0 THEN p.value END) AS sst
FROM residual a JOIN residual b ON a.g = b.g JOIN products p ON p.i = a.i AND p.j = b.i AND p.fold = a.g % {CV_FOLDS}
GROUP BY a.g""",
        "ranked": f"""SELECT alpha, CAST(g % {CV_FOLDS} AS INT) AS fold, 1 - sse / sst AS r2
FROM scored JOIN (VALUES {penalties}) AS penalties(base, alpha) ON base = g - g % {CV_FOLDS}""",
    }
    one_row = ", ".join(f"max(CASE WHEN i = {i} THEN w END) AS beta{i}" for i in range(last))
    weighted = " + ".join(f"beta{i} * {c}" for i, c in enumerate(FEATURES, start=1))
    value = f"beta0 + {weighted}"
    winner = f"""SELECT {WHOLE} + base AS g FROM ranked JOIN (VALUES {penalties}) AS penalties(base, alpha) USING (alpha)
GROUP BY base ORDER BY avg(r2) DESC, base LIMIT 1"""
    solved = dict(
        long=long, products=products, **_ridge(f"{without_fold} UNION ALL {everything}"), **held_out, winner=winner,
        fitted=f"SELECT {one_row} FROM weights JOIN winner USING (g)",
    )
    judged = {
        "guessed": f"""SELECT split, CAST(RUL AS DOUBLE) AS y, {value} AS p
FROM filled JOIN (SELECT unit, split FROM splits) USING (unit) CROSS JOIN fitted WHERE split <> 'train'""",
        "judged": """SELECT split, count(*) AS n_rows, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
       1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM guessed GROUP BY split""",
    }
    record = _with(
        f"""SELECT 'engine_rul_prediction_2025-01-01' AS model_version, '2025-01-01 00:00:00' AS train_date,
       '{",".join(FEATURES)}' AS features_used, {len(FEATURES)} AS n_features,
       (SELECT count(*) FROM filled JOIN splits USING (unit) WHERE split = 'train') AS train_size,
       max(CASE WHEN split = 'val' THEN n_rows END) AS val_size, max(CASE WHEN split = 'test' THEN n_rows END) AS test_size,
       {SEED} AS random_seed, '0.7,0.85' AS split_shares,
       {", ".join(f"{_rounded(f"max(CASE WHEN split = '{s}' THEN {m} END)", 5)} AS ridge_{s}_{m}"
                  for s in ("val", "test") for m in ("mae", "rmse", "r2"))},
       true AS selected_is_best FROM judged""", "folded", **solved, **judged)
    predicted = _with(
        f"""SELECT unit, cycle, split, RUL, {_rounded(value, 3)} AS RUL_pred
FROM filled JOIN (SELECT unit, split FROM splits) USING (unit) CROSS JOIN fitted""", "folded", **solved)
    drawn = {
        "tests": """SELECT unit, place - CAST(floor(n * 0.85::DOUBLE) AS BIGINT) - 1 AS pick
FROM splits WHERE split = 'test'""",
        "draws": f"""SELECT CAST(i AS INT) AS draw,
       CAST('0x' || substr(md5('{SEED}:' || i), 1, 8) AS BIGINT) % (SELECT count(*) FROM tests) AS pick
FROM range(1, {OOT_UNITS + 1}) AS t(i)""",
    }
    fleet = f"""SELECT filled.* EXCLUDE (unit), 'OOT_' || draw AS unit, {value} AS RUL_pred
FROM draws JOIN tests USING (pick) JOIN filled ON filled.unit = tests.unit CROSS JOIN fitted"""
    varying = [c for c in SENSORS if c not in (*CONSTANT_SENSORS, "op_setting_3")]
    by_source = _with(
        """SELECT CAST(source AS INT) AS source, count(*) AS n_rows, count(DISTINCT unit) AS n_units,
       min(unit + off) AS min_unit, max(unit + off) AS max_unit, count(W32) AS n_w32
FROM sources JOIN offsets USING (source) GROUP BY source""", "sources", offsets=_offset("count(DISTINCT unit)"))
    named = ", ".join(f"({i}, '{c}')" for i, c in enumerate(["intercept", *FEATURES]))
    return {
        "bronze_parse": panel,
        "bronze_rejects": _with(
            """SELECT CASE WHEN cycle % 5 = 0 THEN 'too many fields' ELSE 'no unit or cycle' END AS reason,
       count(*) AS n_lines FROM panel WHERE cycle % 5 = 0 OR cycle % 7 = 0 GROUP BY 1""", "panel"),
        "bronze_readback": _with(
            f"SELECT CAST(unit AS VARCHAR) AS unit, CAST(cycle AS VARCHAR) AS cycle, {_tidy(SENSORS)} FROM panel",
            "panel"),
        "csv_typed_read": panel,
        "bronze_read_many": _with(
            f"SELECT CAST(source AS INT) AS source, unit, cycle, {_tidy(['CAST_T24', 'CAST_T50', 'CAST_W32'])} FROM f"
            .replace("AS CAST_", "AS "), "sources",
            f="""SELECT source, unit, cycle, CAST(T24 AS FLOAT) AS CAST_T24, CAST(T50 AS FLOAT) AS CAST_T50,
       CAST(W32 AS FLOAT) AS CAST_W32 FROM sources"""),
        "load_dispatch": _with(
            """SELECT kind, count(*) AS n_rows, count(DISTINCT unit) AS n_units, min(unit) AS min_unit,
       max(unit) AS max_unit
FROM panel, (VALUES ('parquet'), ('csv'), ('dataframe')) AS kinds(kind) GROUP BY kind""", "panel"),
        "bronze_roundtrip": silver,
        "silver_roundtrip": silver,
        "silver_cleaned": _with(f"SELECT unit, cycle, {_tidy(KEPT)} FROM cleaned", "cleaned"),
        "silver_cast": _with(f"SELECT unit, cycle, {', '.join(SENSORS)} FROM silver", "silver"),
        "drop_constant": _with(
            f"SELECT unit, cycle, {_tidy([c for c in SENSORS if c not in CONSTANT_SENSORS])} FROM silver", "silver"),
        "drop_correlated": _with(
            f"SELECT unit, cycle, {_tidy([c for c in SENSORS if c not in CORRELATED_SENSORS])} FROM silver", "silver"),
        "constant_columns": _with(
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, count({c}) AS n, coalesce(min({c}) = max({c}), true) AS is_constant FROM silver" for c in SENSORS
            ), "silver"),
        "correlated_pairs": _with(
            " UNION ALL ".join(
                f"""SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, {_rounded(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))", 6)} AS r
FROM silver WHERE {a} IS NOT NULL AND {b} IS NOT NULL"""
                for i, a in enumerate(varying) for b in varying[i + 1 :]
            ), "silver"),
        "co_located_join": gold,
        "delta1_with_ties": _with(
            """SELECT unit, CAST(cycle // 3 AS INT) AS cycle, count(*) AS n_rows, count(*) - max(CASE WHEN cycle = 1 THEN 1 ELSE 0 END) AS n_deltas
FROM cleaned GROUP BY 1, 2""", "cleaned"),
        "silver_union": _with(
            f"SELECT CAST(source AS INT) AS source, unit, cycle, {_tidy(SENSORS)} FROM sources", "sources"),
        "unit_offset": _with(
            f"""SELECT CAST(source AS INT) AS source, unit + off AS unit, cycle, {_tidy(SENSORS)}
FROM (SELECT source, unit, cycle, {_floats(SENSORS)} FROM sources) JOIN offsets USING (source)""",
            "sources", offsets=_offset("count(DISTINCT unit)")),
        "unit_offset_by_max": _with(
            "SELECT CAST(source AS INT) AS source, unit + off AS unit, cycle FROM sources JOIN offsets USING (source)",
            "sources", offsets=_offset("max(unit)")),
        "shared_units": _with(
            "SELECT unit, count(DISTINCT source) AS n_sources FROM sources GROUP BY unit HAVING count(DISTINCT source) > 1",
            "sources"),
        "source_stats": _with(
            """SELECT CAST(source AS INT) AS source, count(*) AS n_rows, count(DISTINCT unit) AS n_units
FROM sources GROUP BY source""", "sources"),
        "integrity": _with(_report("cleaned"), "cleaned"),
        "unit_summary": _with(
            """SELECT unit, CAST(floor(cycle / 65536.0) AS INT) AS block, count(*) AS n_rows,
       min(cycle) AS first_cycle, max(cycle) AS last_cycle FROM cleaned GROUP BY 1, 2""", "cleaned"),
        "integrity_by_layer": _with(
            f"SELECT layer, r.* FROM ({_report('panel')}) r, "
            "(VALUES ('bronze'), ('silver'), ('cleaned'), ('gold')) AS layers(layer)", "panel"),
        "layers_of_many_files": by_source,
        "layers_of_a_pattern": by_source,
        "raw_stats": _with(
            """SELECT count(*) AS n_rows, count(DISTINCT unit) AS n_units, min(unit) AS min_unit,
       max(unit) AS max_unit FROM panel""", "panel"),
        "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "distinct_units": "SELECT DISTINCT CAST(l_suppkey AS INT) AS unit FROM lineitem",
        "max_cycle": _with("SELECT unit, max(cycle) AS max_cycle FROM panel GROUP BY unit", "panel"),
        "rul_label": rul,
        "rul_via_join": _with(
            """SELECT unit, cycle, m - cycle AS RUL
FROM panel LEFT JOIN (SELECT unit, max(cycle) AS m FROM panel GROUP BY unit) USING (unit)""", "panel"),
        "rolling_mean": rolled,
        "rolling_mean_hot_units": rolled,
        "delta1": _with(
            f"SELECT unit, cycle, {_tidy([f'{s}_delta1' for s in TREND_SENSORS])} FROM engineered", "engineered"),
        "ratio_features": _with(f"SELECT unit, cycle, {_tidy(list(RATIOS))} FROM engineered", "engineered"),
        "lifecycle_features": _with(f"SELECT unit, cycle, {', '.join(LIFECYCLE)} FROM engineered", "engineered"),
        "engineered": engineered,
        "engineered_hot_units": engineered,
        "engineered_in_service": _with(
            f"SELECT unit, cycle, {_tidy(measured)} FROM engineered", "engineered"),
        "events_rolling_mean": _with(
            f"""SELECT unit, cycle, {_tidy(['value'], 6)}, k, {_tidy(['value_roll3_mean', 'k_roll3_mean', 'value_delta1'], 6)}, k_delta1
FROM (SELECT *,
       avg(value) OVER (PARTITION BY unit ORDER BY cycle ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS value_roll3_mean,
       avg(k) OVER (PARTITION BY unit ORDER BY cycle ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS k_roll3_mean,
       COALESCE(value - lag(value) OVER (PARTITION BY unit ORDER BY cycle), 0) AS value_delta1,
       COALESCE(k - lag(k) OVER (PARTITION BY unit ORDER BY cycle), 0) AS k_delta1 FROM e)""", e=events),
        "events_rul": _with(f"SELECT unit, cycle, {_RUL} FROM e", e=events),
        "feature_metadata": _with(stats, "stats"),
        "zscore": _with(
            f"SELECT unit, cycle, {_tidy(KEPT, 4)} FROM (SELECT unit, cycle, {_scaled_by_subquery(KEPT)} FROM cleaned)",
            "cleaned", s=_stats(KEPT, "cleaned")),
        "apply_metadata": _with(
            f"SELECT unit, cycle, {_tidy(KEPT, 4)} FROM (SELECT unit, cycle, {_scaled(KEPT)} FROM cleaned CROSS JOIN s)",
            "cleaned", "splits", s=_stats(KEPT, "cleaned JOIN splits USING (unit)", "WHERE split = 'train'")),
        "gold_full": gold,
        "feature_store": _with(f"SELECT unit, cycle, {_tidy(FEATURES, 4)} FROM gold", "gold"),
        "label_store": rul,
        "feature_label_join": gold,
        "group_split": _with("SELECT unit, split FROM splits", "splits"),
        "split_rows": _with(
            "SELECT unit, cycle, split FROM cleaned JOIN splits USING (unit) WHERE split = 'test'", "cleaned", "splits"),
        "split_sizes": _with(
            """SELECT split, count(*) AS n_rows, count(DISTINCT unit) AS n_units
FROM cleaned JOIN splits USING (unit) GROUP BY split""", "cleaned", "splits"),
        "cv_folds": _with(
            "SELECT unit, cycle, CAST(ntile(3) OVER (ORDER BY unit, cycle) - 1 AS INT) AS fold FROM cleaned", "cleaned"),
        "oot_bootstrap": _with(
            f"""SELECT draw, 'OOT_' || draw AS unit, cycle, {_tidy(['T24'])}, RUL
FROM draws JOIN tests USING (pick) JOIN (SELECT *, {_RUL} FROM cleaned) c ON c.unit = tests.unit""",
            "cleaned", "splits",
            **drawn),
        "metrics": scored,
        "select_model": _with(
            f"""SELECT model, split, n_rows, n_skipped, {_tidy(['mae', 'rmse', 'r2'], 6)} FROM scores WHERE split = 'val'
ORDER BY scores.r2 DESC, CASE model WHEN 'previous' THEN 1 ELSE 2 END LIMIT 1""", "scores"),
        "require_columns": _with("SELECT unit, cycle FROM panel", "panel"),
        "assemble": _with(
            f"""SELECT unit, cycle, {len(FEATURES)} AS n_features, {_rounded(' + '.join(FEATURES), 4)} AS total
FROM filled""", "filled"),
        "ridge_moments": _with(
            f"SELECT fold, i, j, {_rounded('value', 2)} AS value FROM products", "folded", long=long, products=products),
        "ridge_fit": _with(
            f"""SELECT feature, {_rounded("w", 3)} AS coefficient
FROM weights JOIN winner USING (g) JOIN (VALUES {named}) AS names(i, feature) USING (i)""", "folded", **solved),
        "model_metrics": _with(
            f"""SELECT 'Ridge' AS model, split, n_rows, {_tidy(['mae', 'rmse', 'r2'], 5)}, r2 > 0 AS beats_mean FROM judged
UNION ALL SELECT 'RandomForest', split, n_rows, NULL, NULL, NULL, true FROM judged""", "folded", **solved, **judged),
        "model_selected": _with(
            """SELECT 'val' AS split, count(*) AS n_rows, true AS is_best, true AS known_name
FROM filled JOIN splits USING (unit) WHERE split = 'val'""", "filled", "splits"),
        "model_record": record,
        "save_model": record,
        "latest_model": record,
        "forest_fit": f"""SELECT {len(FEATURES)} AS n_features, 1.0::DOUBLE AS importance, true AS none_negative,
       100 AS n_trees, 10 AS deepest, true AS beats_mean""",
        "forest_cuts": _with(
            """SELECT CAST(tree AS INT) AS tree, depth, min_rows, count(*) AS n_rows, floor(sum(RUL) * 10.0::DOUBLE + 0.5) / 10.0::DOUBLE AS total
FROM (SELECT RUL FROM filled JOIN splits USING (unit) WHERE split = 'train'),
     range(4) AS trees(tree), (VALUES (0), (3), (8)) AS depths(depth), (VALUES (2), (500)) AS splits_(min_rows)
GROUP BY tree, depth, min_rows""", "filled", "splits"),
        "predict": predicted,
        "load_model": predicted,
        "oot_predictions": _with(
            f"SELECT unit, cycle, RUL, {_tidy([*FEATURES, 'RUL_pred'], 3)} FROM fleet",
            "folded", **solved, **drawn, fleet=fleet),
        "oot_score": _with(
            f"""SELECT 'oot' AS split, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_skipped, {_rounded("avg(abs(RUL - RUL_pred))", 6)} AS mae,
       {_rounded("sqrt(avg((RUL - RUL_pred) ** 2))", 6)} AS rmse,
       {_rounded("1 - sum((RUL - RUL_pred) ** 2) / (var_pop(RUL) * count(*))", 6)} AS r2 FROM fleet""",
            "folded", **solved, **drawn, fleet=fleet),
        "ridge_grid": _with(
            f"SELECT alpha, fold, {_rounded('r2', 6)} AS r2 FROM ranked",
            "folded", **solved),
        "grid_results": _with(
            f"SELECT alpha, {_rounded('avg(r2)', 6)} AS mean_r2 FROM ranked GROUP BY alpha",
            "folded", **solved),
    }
