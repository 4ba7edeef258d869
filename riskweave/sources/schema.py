"""Declared schemas and fixed field lists of the transaction data model."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, DOUBLE, STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

KEY, LABEL, TIME = "TransactionID", "isFraud", "TransactionDT"

# Names and ranges of the wide columns.
C_COLS = [f"C{i}" for i in range(1, 15)]
D_COLS = [f"D{i}" for i in range(1, 16)]
M_COLS = [f"M{i}" for i in range(1, 10)]
V_COLS = [f"V{i}" for i in range(1, 340)]
ID_COLS = [f"id_{i:02d}" for i in range(1, 39)]

# Columns kept out of the feature vector, imputed columns, normalised
# columns, encoded columns, smoothing weight.
EXCLUDED = [KEY]
IMPUTED = [
    "TransactionAmt", "card1", "card2", "card3", "card5",
    *C_COLS, *D_COLS, "addr1", "addr2", "dist1", "dist2",
]
NORM_COLS = ["D1", "D4", "D10"]
NORM_GROUP = "card1"
ENCODED = ["card4", "card6", "P_emaildomain", "R_emaildomain"]
SMOOTHING = 10.0


def _fields(*groups: tuple[list[str], T.DataType]) -> list[T.StructField]:
    return [T.StructField(n, t) for names, t in groups for n in names]


TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField(KEY, LONG, False),
        T.StructField(LABEL, INT),
        T.StructField(TIME, LONG),
        T.StructField("TransactionAmt", DOUBLE),
        T.StructField("ProductCD", STRING),
        T.StructField("card1", LONG),
        *_fields(
            (["card2", "card3"], DOUBLE),
            (["card4"], STRING),
            (["card5"], DOUBLE),
            (["card6"], STRING),
            (["addr1", "addr2", "dist1", "dist2"], DOUBLE),
            (["P_emaildomain", "R_emaildomain"], STRING),
            (C_COLS, DOUBLE),
            (D_COLS, DOUBLE),
            (M_COLS, STRING),
            (V_COLS, DOUBLE),
        ),
    ]
)

# Every id column is a string: some hold mixed values.
IDENTITY_SCHEMA = T.StructType(
    [
        T.StructField(KEY, LONG, False),
        *_fields((ID_COLS, STRING), (["DeviceType", "DeviceInfo"], STRING)),
    ]
)

STAMP, BOOL = T.TimestampType(), T.BooleanType()

PREDICTION_LOG_SCHEMA = T.StructType(
    [
        T.StructField("prediction_id", STRING),
        T.StructField("timestamp", STAMP),
        T.StructField("fraud_probability", DOUBLE),
        T.StructField("prediction", INT),
        T.StructField("threshold_used", DOUBLE),
        T.StructField("latency_ms", DOUBLE),
        T.StructField("model_version", STRING),
    ]
)
DRIFT_LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", STAMP),
        T.StructField("feature_name", STRING),
        T.StructField("psi_score", DOUBLE),
        T.StructField("alert_fired", BOOL),
        T.StructField("baseline_mean", DOUBLE),
        T.StructField("current_mean", DOUBLE),
        T.StructField("window_days", INT),
    ]
)

# Defaults of the scoring request. A default fills an absent field;
# an explicit null stays null.
REQUEST_DEFAULTS: dict[str, float | None] = {
    "TransactionAmt": 68.5,
    "TransactionDT": 86400.0,
    "card1": 9500.0,
    "card2": 325.0,
    "card3": 150.0,
    "card5": 226.0,
    "addr1": 299.0,
    "addr2": 87.0,
    "dist1": None,
    "dist2": None,
    "C1": 1.0,
    "C2": 1.0,
    "C3": 0.0,
    "C4": 0.0,
    "C5": 0.0,
    "C6": 1.0,
    "C7": 0.0,
    "C8": 0.0,
    "C9": 1.0,
    "C10": 0.0,
    "C11": 1.0,
    "C12": 0.0,
    "C13": 1.0,
    "C14": 1.0,
    "D1": 14.0,
    **{f"D{i}": None for i in range(2, 16)},
}

# Names and types of the registered features.
REGISTERED_FEATURES: list[tuple[str, str]] = [
    ("time_of_day", "INT64"),
    ("day_of_week", "INT64"),
    ("hour_of_day", "INT64"),
    ("log_transaction_amt", "DOUBLE"),
    ("amt_to_d1_ratio", "DOUBLE"),
    ("is_round_amt", "INT64"),
    ("D1_card_norm", "DOUBLE"),
    ("D4_card_norm", "DOUBLE"),
    ("D10_card_norm", "DOUBLE"),
    ("card4_te", "DOUBLE"),
    ("card6_te", "DOUBLE"),
    ("P_emaildomain_te", "DOUBLE"),
    ("R_emaildomain_te", "DOUBLE"),
    ("TransactionAmt", "DOUBLE"),
    ("card1", "INT64"),
    ("addr1", "DOUBLE"),
    ("addr2", "DOUBLE"),
    ("dist1", "DOUBLE"),
    ("dist2", "DOUBLE"),
    *[(c, "DOUBLE") for c in C_COLS],
    *[(c, "DOUBLE") for c in D_COLS],
]
SPARK_TYPE = {"INT64": "bigint", "DOUBLE": "double"}


def numeric_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.NumericType)]


def columns_with_prefix(schema: T.StructType, prefix: str) -> list[str]:
    return [n for n in schema.names if n.startswith(prefix)]


def present(schema: T.StructType, wanted: list[str]) -> list[str]:
    have = set(schema.names)
    return [c for c in wanted if c in have]
