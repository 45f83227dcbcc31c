"""Column contract, labels and fixed parameters of the booking model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, labels and limits that define the results ----------
TARGET = "is_canceled"
KEY = "booking_id"
SEED = 42
TEST_SHARE = 0.2
THRESHOLD = 0.5
BASE_RATE = 0.37

# Tokens read as null in a raw CSV: the project's own four plus the usual reader defaults.
NA_TOKENS = ["NULL", "NA", "NaN", ""]
DEFAULT_NA_TOKENS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "None", "n/a", "nan", "null",
]

# Texts that mean "absent" at feature time (compared trimmed and in lower case).
ABSENT_WORDS = ["", "nan", "none", "no_company", "unknown", "desconocido"]

LEAKAGE_COLUMNS = [
    "reservation_status",
    "reservation_status_date",
    "required_car_parking_spaces",
    "assigned_room_type",
    "arrival_date_year",
]

CATEGORICAL = [
    "hotel",
    "arrival_date_month",
    "meal",
    "country",
    "market_segment",
    "distribution_channel",
    "reserved_room_type",
    "deposit_type",
    "customer_type",
    "agent",
    "company",
]

NUMERIC = [
    "lead_time",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "booking_changes",
    "days_in_waiting_list",
    "adr",
    "total_of_special_requests",
]

DERIVED = ["has_company", "has_agent", "noches"]
FEATURES = NUMERIC + CATEGORICAL
MODEL_NUMERIC = NUMERIC + DERIVED

RARE_COLUMNS = ["agent", "country", "company"]
RARE_NULL_LABELS = {"agent": "Desconocido", "country": "Desconocido", "company": "no_company"}
RARE_OTHER = "Otros"
RARE_MIN_N = 100
RARE_HI = 0.60
RARE_LO = 0.30
UNKNOWN = "Unknown"

ADR_MAX = 5400.0
CLASS_LABELS = ["No cancelada", "Cancelada"]
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]
SUMMARY_COLUMNS = ["lead_time", "adr", "stays_in_week_nights", "total_of_special_requests"]
LEAD_BANDS = [(7, "0-7"), (30, "8-30"), (90, "31-90"), (180, "91-180"), (365, "181-365"), (10000, "365+")]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
TOP_COUNTRIES, TOP_AGENTS, TOP_COMPANIES = 30, 30, 20

# (column, lower limit, upper limit); None = unbounded.
RANGES = [
    ("lead_time", 0, None),
    ("arrival_date_week_number", 1, 53),
    ("arrival_date_day_of_month", 1, 31),
    ("stays_in_weekend_nights", 0, None),
    ("stays_in_week_nights", 0, None),
    ("adults", 0, None),
    ("children", 0, None),
    ("babies", 0, None),
    ("is_repeated_guest", 0, 1),
    ("previous_cancellations", 0, None),
    ("previous_bookings_not_canceled", 0, None),
    ("booking_changes", 0, None),
    ("days_in_waiting_list", 0, None),
    ("adr", None, None),
    ("total_of_special_requests", 0, None),
]

EXAMPLE = {
    "hotel": "City Hotel",
    "lead_time": 100,
    "arrival_date_month": "August",
    "arrival_date_week_number": 33,
    "arrival_date_day_of_month": 15,
    "stays_in_weekend_nights": 2,
    "stays_in_week_nights": 5,
    "adults": 2,
    "children": 0,
    "babies": 0,
    "meal": "BB",
    "country": "PRT",
    "market_segment": "Online TA",
    "distribution_channel": "TA/TO",
    "is_repeated_guest": 0,
    "previous_cancellations": 0,
    "previous_bookings_not_canceled": 0,
    "reserved_room_type": "A",
    "booking_changes": 0,
    "deposit_type": "No Deposit",
    "agent": "9",
    "company": "no_company",
    "days_in_waiting_list": 0,
    "customer_type": "Transient",
    "adr": 100.0,
    "total_of_special_requests": 1,
}

# Model parameters and search grids.
MODEL_PARAMS = {
    "Logistic Regression": {"max_iter": 1000},
    "Decision Tree": {"max_depth": 12, "min_leaf": 50},
    "Random Forest": {"trees": 200, "max_depth": 18, "min_leaf": 20},
    "Gradient Boosting": {"trees": 500, "max_depth": 14, "rate": 0.1, "subsample": 0.9, "colsample": 0.9},
    "Neural Network": {"hidden": [64, 32, 16], "max_iter": 60},
}
CV_FOLDS = 3
RANDOM_SEARCH_SIZE = 12
GRIDS = {
    "Logistic Regression": {"C": [0.01, 0.1, 1.0, 10.0], "class_weight": [None, "balanced"]},
    "Decision Tree": {
        "max_depth": [6, 8, 12, None],
        "min_leaf": [20, 50, 100],
        "criterion": ["gini", "entropy"],
    },
    "Random Forest": {
        "trees": [200, 300, 400],
        "max_depth": [12, 18, None],
        "min_leaf": [5, 10, 20],
        "max_features": ["sqrt", "log2"],
    },
    "Gradient Boosting": {
        "trees": [300, 400, 500, 600],
        "max_depth": [8, 10, 12, 14, 16],
        "rate": [0.03, 0.05, 0.1],
        "subsample": [0.8, 0.9, 1.0],
        "colsample": [0.8, 0.9, 1.0],
    },
}
SHAP_SAMPLE, SHAP_TOP = 2000, 20
SCATTER_SAMPLE, GRID_SIDE = 1500, 300
# ------------------------------------------------------------------------------

# The deepest tree Spark ML grows; stands for "no depth limit".
SPARK_MAX_DEPTH = 30

_INT = [c for c in NUMERIC if c not in ("children", "adr")]

RAW_SCHEMA = T.StructType(
    [T.StructField(KEY, T.LongType())]
    + [
        T.StructField(c, T.IntegerType() if c in _INT else T.DoubleType() if c in NUMERIC else T.StringType())
        for c in FEATURES
    ]
    + [
        T.StructField(TARGET, T.IntegerType()),
        T.StructField("arrival_date_year", T.IntegerType()),
        T.StructField("assigned_room_type", T.StringType()),
        T.StructField("required_car_parking_spaces", T.IntegerType()),
        T.StructField("reservation_status", T.StringType()),
        T.StructField("reservation_status_date", T.StringType()),
    ]
)

BOOKING_SCHEMA = T.StructType([f for f in RAW_SCHEMA if f.name in [KEY, *FEATURES]])
