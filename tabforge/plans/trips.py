"""Ready-made settings for the trip-price table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import types as T

from .fitted import FeaturePlan

# Column names, value rules and record domains of the trip table.
TARGET = "Trip_Price"
NUMERIC_COLUMNS = (
    "Trip_Distance_km", "Passenger_Count", "Base_Fare", "Per_Km_Rate", "Per_Minute_Rate", "Trip_Duration_Minutes",
)
CATEGORICAL_COLUMNS = ("Time_of_Day", "Day_of_Week", "Traffic_Conditions", "Weather")
CONSTRAINTS = {
    "Trip_Distance_km": {"min": 0.0, "max": 140.0, "dtype": "float", "action": "clip"},
    "Passenger_Count": {"min": 1, "max": 6, "dtype": "int", "action": "clip"},
    "Trip_Duration_Minutes": {"min": 0.0, "max": 120.0, "dtype": "float", "action": "clip"},
    "Base_Fare": {"min": 0.0, "dtype": "float", "action": "mean"},
    "Per_Km_Rate": {"min": 0.0, "dtype": "float", "action": "mean"},
    "Per_Minute_Rate": {"min": 0.0, "dtype": "float", "action": "mean"},
    "Trip_Price": {"min": 0.0, "dtype": "float", "action": "drop"},
    "Speed_kmh": {"min": 0.0, "max": 160.0, "dtype": "float", "action": "clip"},
}
INTERACTION_PAIRS = (("Trip_Distance_km", "Per_Km_Rate"), ("Trip_Duration_Minutes", "Per_Minute_Rate"))
RECORD_RULES = {
    "Trip_Distance_km": {"min": 1.0, "max": 100.0},
    "Time_of_Day": {"options": ["Morning", "Afternoon", "Evening", "Night"]},
    "Day_of_Week": {"options": ["Weekday", "Weekend"]},
    "Passenger_Count": {"min": 1, "max": 6},
    "Traffic_Conditions": {"options": ["Low", "Medium", "High"]},
    "Weather": {"options": ["Clear", "Rain", "Fog"]},
    "Base_Fare": {"min": 1.0, "max": 10.0},
    "Per_Km_Rate": {"min": 0.3, "max": 2.0},
    "Per_Minute_Rate": {"min": 0.1, "max": 1.0},
    "Trip_Duration_Minutes": {"min": 5.0, "max": 200.0},
}

TRIP_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in NUMERIC_COLUMNS]
    + [T.StructField(c, T.StringType()) for c in CATEGORICAL_COLUMNS]
    + [T.StructField(TARGET, T.DoubleType())]
)


def trip_plan(key: Sequence[str], *, with_interactions: bool = False, **changes: Any) -> FeaturePlan:
    """Median and mode fills, one-hot without the first level, standard scaling; ``key`` identifies trips."""
    settings: dict[str, Any] = {"target": TARGET, "key": list(key), "constraints": CONSTRAINTS}
    if with_interactions:
        settings["interaction_pairs"] = INTERACTION_PAIRS
    return FeaturePlan(**{**settings, **changes})
