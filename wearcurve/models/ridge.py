"""Ridge regression on standardised features.

The grid is scored from second moments per fold: one pass over the rows whatever the number of
penalties, where refitting per fold and penalty would take two passes each. The chosen penalty is
fitted by MLlib, so the stored model is a stock pipeline.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.schema import LABEL

# Penalties of the grid.
ALPHAS = (0.1, 1.0, 10.0, 50.0, 100.0)
FOLDS = 3
VECTOR = "_vector"


def assembler(features: Sequence[str], handle_invalid: str = "error") -> VectorAssembler:
    """Feature columns -> vector. Missing values are an error unless the caller says otherwise."""
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid=handle_invalid)


def moments(df: DataFrame, columns: Sequence[str], by: str = "fold") -> DataFrame:
    """``by, i, j, value``: sums of products of (1, *columns) per group, for i <= j.

    Each task sends one small triangle per group to the shuffle.
    """
    width = len(columns) + 1
    upper = np.triu_indices(width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            rows = np.ones((batch.num_rows, width))
            for i in range(1, width):
                rows[:, i] = batch.column(i).to_numpy(zero_copy_only=False)
            if np.isnan(rows).any():
                raise ValueError("missing value in a regression column; fill or filter it first")
            for g in np.unique(groups):
                part = rows[groups == g]
                sums[int(g)] = sums.get(int(g), 0) + part.T @ part
        for g, square in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(upper[0]), g), pa.int32()),
                    pa.array(upper[0], pa.int32()),
                    pa.array(upper[1], pa.int32()),
                    pa.array(square[upper], pa.float64()),
                ],
                names=[by, "i", "j", "value"],
            )

    narrow = df.select(F.col(by).cast("int"), *[F.col(c).cast("double") for c in columns])
    partials = narrow.mapInArrow(partial, f"{by} int, i int, j int, value double")
    return partials.groupBy(by, "i", "j").agg(F.sum("value").alias("value"))


def _squares(moment_rows: DataFrame, width: int, by: str) -> dict[int, np.ndarray]:
    """Moments as one symmetric matrix per group. Their size depends on the columns alone."""
    out: dict[int, np.ndarray] = {}
    for r in moment_rows.collect():
        square = out.setdefault(r[by], np.zeros((width, width)))
        square[r["i"], r["j"]] = square[r["j"], r["i"]] = r["value"]
    return out


def _solve(square: np.ndarray, alpha: float) -> np.ndarray:
    """Weights (intercept, *features) on raw columns; the penalty acts on standardised ones."""
    n = square[0, 0]
    mean = square[0, 1:] / n
    spread = square[1:, 1:] / n - np.outer(mean, mean)
    variance = np.diag(spread)[:-1]
    # A column that does not vary is centred to 0 and gets weight 0, as in MLlib's fit. On scaled columns,
    # which are 0 throughout or have deviation 1, the margin for rounding makes no difference to that rule.
    varies = variance > 1e-12 * np.maximum(mean[:-1] ** 2, 1e-300)
    std = np.where(varies, np.sqrt(np.where(varies, variance, 1.0)), 1.0)
    scaled = spread[:-1, :-1] / np.outer(std, std) * np.outer(varies, varies)
    target = spread[:-1, -1] / std * varies
    weights = np.linalg.solve(scaled * n + alpha * np.eye(len(std)), target * n) / std
    return np.concatenate([[mean[-1] - mean[:-1] @ weights], weights])


def _r2(square: np.ndarray, weights: np.ndarray) -> float:
    """R² of the weights on the rows summed in ``square``."""
    residual = np.concatenate([-weights, [1.0]])
    sse = max(float(residual @ square @ residual), 0.0)
    sst = float(square[-1, -1] - square[0, -1] ** 2 / square[0, 0])
    if sst <= 0:
        return 1.0 if sse == 0 else 0.0
    return 1.0 - sse / sst


@dataclass(frozen=True)
class RidgeSearch:
    model: PipelineModel
    alpha: float
    results: DataFrame


def _fold_squares(df: DataFrame, features: Sequence[str], label: str, fold: str) -> dict[int, np.ndarray]:
    columns = [*features, label]
    return _squares(moments(df, columns, fold), len(columns) + 1, fold)


def _scores(squares: dict[int, np.ndarray], alphas: Sequence[float]) -> list[tuple[float, int, float]]:
    total = sum(squares.values())
    return [
        (float(alpha), int(k), float(_r2(held_out, _solve(total - held_out, alpha))))
        for alpha in alphas
        for k, held_out in sorted(squares.items())
    ]


def _results(df: DataFrame, scores: list[tuple[float, int, float]]) -> DataFrame:
    return df.sparkSession.createDataFrame(scores, "alpha double, fold int, r2 double")


def grid(
    df: DataFrame, features: Sequence[str], alphas: Sequence[float] = ALPHAS, *, label: str = LABEL, fold: str = "fold"
) -> DataFrame:
    """``alpha, fold, r2`` of every penalty on every held-out fold."""
    return _results(df, _scores(_fold_squares(df, features, label, fold), alphas))


def mean_scores(results: DataFrame) -> DataFrame:
    return results.groupBy("alpha").agg(F.avg("r2").alias("mean_r2"))


def fit(
    df: DataFrame,
    features: Sequence[str],
    alpha: float = 1.0,
    *,
    label: str = LABEL,
    size: tuple[float, float] | None = None,
) -> PipelineModel:
    """Ridge with penalty ``alpha`` on standardised features and a free intercept.

    MLlib divides the loss by n and standardises the label too, hence the rescaled penalty. ``size`` is
    the row count and the label's deviation, counted here when not known.
    """
    n, std = size or df.agg(F.count(label), F.stddev_pop(label)).first()
    regression = LinearRegression(
        featuresCol=VECTOR, labelCol=label, predictionCol="prediction", solver="normal",
        elasticNetParam=0.0, standardization=True, regParam=alpha * (std or 1.0) / n,
    )
    return Pipeline(stages=[assembler(features), regression]).fit(df)


def search(
    df: DataFrame, features: Sequence[str], alphas: Sequence[float] = ALPHAS, *, label: str = LABEL, fold: str = "fold"
) -> RidgeSearch:
    """Best mean R² over the folds, earlier penalties first on a tie, then a fit on all rows."""
    squares = _fold_squares(df, features, label, fold)
    scores = _scores(squares, alphas)
    mean = {a: np.mean([r2 for alpha, _, r2 in scores if alpha == float(a)]) for a in alphas}
    best = max(alphas, key=mean.__getitem__)
    total = sum(squares.values())
    n = total[0, 0]
    std = np.sqrt(max(total[-1, -1] / n - (total[0, -1] / n) ** 2, 0.0))
    model = fit(df, features, best, label=label, size=(float(n), float(std)))
    return RidgeSearch(model, float(best), _results(df, scores))


def coefficients(model: PipelineModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """``feature, coefficient``, with the intercept under its own name."""
    fitted = model.stages[-1]
    pairs = [("intercept", float(fitted.intercept)), *zip(features, map(float, fitted.coefficients))]
    return df.sparkSession.createDataFrame(pairs, "feature string, coefficient double")
