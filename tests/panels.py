"""Small panels for the tests."""

import numpy as np
import pandas as pd

from wearcurve.schema import RAW_FIELDS, SILVER_TYPES


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def small(spark, rows, schema="unit int, cycle int, s float"):
    return spark.createDataFrame(rows, schema)


def fleet(lengths, seed=0, gaps=True, missing=0.1):
    """A pandas panel with units of the given lengths, gaps in the cycles and missing readings."""
    rng = np.random.default_rng(seed)
    parts = []
    for unit, n in enumerate(lengths, start=1):
        steps = rng.integers(1, 40 if gaps else 2, size=n)
        part = pd.DataFrame({"unit": unit, "cycle": np.cumsum(steps)})
        for name in RAW_FIELDS[2:]:
            values = rng.normal(100, 5, size=n).astype("float32")
            part[name] = np.where(rng.random(n) < missing, np.nan, values)
        parts.append(part)
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, pdf):
    schema = ", ".join(f"{c} {SILVER_TYPES[c].simpleString()}" for c in pdf.columns)
    clean = pdf.astype(object).where(pdf.notna(), None)
    rows = [
        tuple(int(v) if c in ("unit", "cycle") else v for c, v in zip(pdf.columns, row))
        for row in clean.itertuples(index=False)
    ]
    return spark.createDataFrame(rows, schema)
