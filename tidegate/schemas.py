"""Declared table schemas; nothing is inferred."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


PROBS = T.ArrayType(_schema(("label", T.LongType()), ("prob", T.DoubleType())))

SOURCE_TRIPS = _schema(
    ("pickup_datetime", T.TimestampType()),
    ("dropoff_datetime", T.TimestampType()),
    ("vendor_id", T.StringType()),
    ("passenger_count", T.LongType()),
    ("trip_distance", T.DoubleType()),
    ("fare_amount", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("payment_type", T.StringType()),
)

FEATURES = _schema(
    ("trip_id", T.StringType()),
    ("pickup_datetime", T.TimestampType()),
    ("dropoff_datetime", T.TimestampType()),
    ("vendor_id", T.StringType()),
    ("passenger_count", T.LongType()),
    ("trip_distance", T.DoubleType()),
    ("fare_amount", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("payment_type", T.StringType()),
    ("is_high_tip", T.LongType()),
    ("scoring_date", T.DateType()),
)

PREDICTIONS = _schema(
    ("trip_id", T.StringType()),
    ("vendor_id", T.StringType()),
    ("predicted_is_high_tip", T.LongType()),
    ("predicted_is_high_tip_probs", PROBS),
    ("model_name", T.StringType()),
    ("scored_at", T.TimestampType()),
    ("scoring_date", T.DateType()),
)

RUN_LEDGER = _schema(
    ("event", T.StringType()),
    ("status", T.StringType()),
    ("exit_code", T.StringType()),
    ("target_date", T.StringType()),
    ("execution", T.StringType()),
    ("duration_s", T.DoubleType()),
    ("rows_scored", T.LongType()),
    ("psi", T.DoubleType()),
    ("psi_threshold", T.DoubleType()),
    ("roc_auc", T.DoubleType()),
    ("status_message", T.StringType()),
    ("finished_at", T.TimestampType()),
)

RUN_METRICS = _schema(
    ("name", T.StringType()),
    ("kind", T.StringType()),
    ("ts", T.TimestampType()),
    ("value", T.DoubleType()),
    ("attributes", T.MapType(T.StringType(), T.StringType())),
)

RUN_LOGS = _schema(
    ("ts", T.TimestampType()),
    ("source", T.StringType()),
    ("severity", T.StringType()),
    ("message", T.StringType()),
    ("fields", T.StringType()),
)

MODEL_REGISTRY = _schema(
    ("model_name", T.StringType()),
    ("version", T.StringType()),
    ("path", T.StringType()),
    ("train_start", T.DateType()),
    ("train_end", T.DateType()),
    ("train_rows", T.LongType()),
    ("eval_rows", T.LongType()),
    ("eval_roc_auc", T.DoubleType()),
    ("registered_at", T.TimestampType()),
)

# Columns of the feature view: the only ones a model, guard or report may read.
VIEW_COLUMNS = (
    "trip_id",
    "scoring_date",
    "pickup_datetime",
    "vendor_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "is_high_tip",
)
FORBIDDEN_COLUMNS = ("total_amount", "tip_amount", "payment_type", "dropoff_datetime")
NUMERIC_FEATURES = ("passenger_count", "trip_distance", "fare_amount")
CATEGORICAL_FEATURES = ("vendor_id",)
LABEL = "is_high_tip"

# Columns some view predicate filters on, so every write path must fill them.
FILTERED_COLUMNS = (
    "vendor_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "payment_type",
)
