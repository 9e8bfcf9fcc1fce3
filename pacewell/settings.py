"""Ranges, defaults, bucket bounds, panel steps and alert rules.

All of these are data that results depend on; operators take them as
arguments and use these as defaults.
"""

from dataclasses import dataclass

MODEL_VERSION = "1.0"
SEED = 42
TEST_SIZE = 0.2
MIN_LABELLED_ROWS = 10
MAX_BATCH_RECORDS = 10_000
EPSILON = 0.000001

# Clip ranges used in cleaning.
CLIP_BOUNDS = {
    "sleep_hours": (0.0, 24.0),
    "sleep_quality": (1.0, 10.0),
    "stress_level": (1.0, 10.0),
    "recovery_score": (1.0, 10.0),
    "training_load": (0.0, 1000.0),
    "resting_heart_rate": (30.0, 120.0),
    "hrv": (0.0, 200.0),
}

# Values for inputs missing at scoring time.
SERVING_DEFAULTS = {
    "sleep_hours": 7.0,
    "sleep_quality": 7.0,
    "training_load": 200.0,
    "stress_level": 5.0,
    "recovery_score": 7.0,
    "resting_heart_rate": 60.0,
    "hrv": 50.0,
}

# Values for a sensor column the input does not have at all.
ABSENT_SENSOR_VALUES = {"resting_heart_rate": 60.0, "hrv": 50.0}


@dataclass(frozen=True)
class Range:
    """Allowed closed range of one field; ``None`` leaves a side open."""

    field: str
    low: float | None
    high: float | None
    required: bool = True


@dataclass(frozen=True)
class Length:
    """Allowed text length of one field."""

    field: str
    low: int
    high: int


@dataclass(frozen=True)
class Present:
    """The field must not be missing."""

    field: str


# Validation profiles. They disagree on purpose: each intake path has its own.
PROFILES = {
    "ingest": (
        Length("athlete_id", 1, 100),
        Present("record_date"),
        Range("sleep_hours", 0, 24),
        Range("sleep_quality", 1, 10),
        Range("training_load", 0, 2000),
        Range("stress_level", 1, 10),
        Range("recovery_score", 1, 10),
        Range("resting_heart_rate", 30, 120, required=False),
        Range("hrv", 0, 200, required=False),
        Range("performance_score", 0, 100, required=False),
    ),
    "api": (
        Present("athlete_id"),
        Present("record_date"),
        Range("sleep_hours", 0, 24),
        Range("sleep_quality", 1, 10),
        Range("training_load", 0, None),
        Range("stress_level", 1, 10),
        Range("recovery_score", 1, 10),
        Range("resting_heart_rate", 30, 120, required=False),
        Range("hrv", 0, None, required=False),
        Range("performance_score", 0, 100, required=False),
    ),
    "predict": (
        Present("athlete_id"),
        Present("prediction_date"),
        Range("sleep_hours", 0, 24),
        Range("sleep_quality", 1, 10),
        Range("training_load", 0, None),
        Range("stress_level", 1, 10),
        Range("recovery_score", 1, 10),
        Range("resting_heart_rate", 30, 120, required=False),
        Range("hrv", 0, None, required=False),
    ),
}

# Upper bounds of the latency histogram in seconds; +Inf is implied.
LATENCY_BOUNDS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)

# Paths that are not measured.
UNMEASURED_PATHS = ("/metrics", "/health")

SERVICES = ("api", "data-ingestion", "ml-trainer")

# Panel colours: lowest value each colour starts at, ascending.
SERVICES_UP_STEPS = ((None, "red"), (1.0, "yellow"), (3.0, "green"))
SUCCESS_RATIO_STEPS = ((None, "red"), (0.05, "yellow"), (0.2, "green"))


@dataclass(frozen=True)
class AlertRule:
    """Fire when ``value <compare> threshold`` has held for ``hold`` seconds."""

    name: str
    compare: str
    threshold: float
    hold: int
    severity: str
    summary: str
    description: str


SERVICE_DOWN = AlertRule(
    "ServiceDown", "==", 0.0, 120, "critical",
    "{job} is down",
    "Service {job} has been unreachable for 2 minutes.",
)
HIGH_LATENCY = AlertRule(
    "HighApiLatencyP95", ">", 1.0, 300, "warning",
    "High API latency p95",
    "API p95 latency is above 1 second for 5 minutes.",
)
HIGH_ERROR_RATE = AlertRule(
    "HighApiErrorRate", ">", 0.05, 300, "critical",
    "High API error rate",
    "API 5xx error rate is above 5% for 5 minutes.",
)
