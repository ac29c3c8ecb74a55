"""Column contract of the sensor panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Positional fields of the raw log, in file order.
RAW_FIELDS = (
    "unit", "cycle", "op_setting_1", "op_setting_2", "op_setting_3",
    "T2", "T24", "T30", "T50", "P2", "P15", "P30", "Nf", "Nc",
    "epr", "Ps30", "phi", "NRf", "NRc", "BPR", "farB", "htBleed",
    "Nf_dmd", "PCNfR_dmd", "W31", "W32",
)

# Sensors dropped because they never vary, and because another sensor repeats them.
CONSTANT_SENSORS = ("PCNfR_dmd", "farB", "Nf_dmd", "epr", "P2", "T2")
CORRELATED_SENSORS = ("NRc", "NRf", "Ps30")

# Sensors that get a trailing mean and a first difference.
TREND_SENSORS = ("T24", "T30", "T50", "P15", "P30", "Nf", "Nc")

# Output name -> (numerator, denominator), and the amount added to the denominator.
RATIOS = {
    "T_ratio_24_30": ("T24", "T30"),
    "T_ratio_30_50": ("T30", "T50"),
    "P_ratio_15_30": ("P15", "P30"),
    "N_ratio_f_c": ("Nf", "Nc"),
}
RATIO_EPSILON = 1e-6

ROLL_ROWS = 5
KEYS = ("unit", "cycle")
LABEL = "RUL"
NOT_FEATURES = (*KEYS, LABEL)

# Split shares, seed, expected fleet size and bootstrap size.
TRAIN_SHARE, VAL_SHARE = 0.7, 0.85
SEED = 42
EXPECTED_UNITS = 600
OOT_UNITS = 90

BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c in KEYS else T.DoubleType()) for c in RAW_FIELDS]
)
SILVER_TYPES = {c: T.IntegerType() if c in KEYS else T.FloatType() for c in RAW_FIELDS}


def feature_columns(df: DataFrame, exclude: tuple[str, ...] = NOT_FEATURES) -> list[str]:
    """Every numeric column that is neither a key nor the label, in schema order."""
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def require_columns(df: DataFrame, columns: tuple[str, ...] = KEYS, name: str = "input") -> DataFrame:
    """Fail at plan time, before any job, when a required column is absent."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise KeyError(f"{name} is missing required columns {absent}")
    return df
