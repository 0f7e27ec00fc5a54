"""The trip table end to end: shapes that a run must show, and rows with levels never seen."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.models.linear import term_count
from tabforge.operators import clean
from tabforge.plans.training import prepare, run_training
from tabforge.plans.trips import CATEGORICAL_COLUMNS, CONSTRAINTS, NUMERIC_COLUMNS, RECORD_RULES, TARGET, trip_plan
from tabforge.sources.readers import read_csv


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    """1000 trips in a CSV file, with gaps everywhere; 49 prices are missing."""
    rng = np.random.default_rng(42)
    n = 1000
    pdf = pd.DataFrame(
        {
            "trip": np.arange(n),
            "Trip_Distance_km": rng.uniform(1, 150, n).round(2),
            "Time_of_Day": rng.choice(["Morning", "Afternoon", "Evening", "Night"], n),
            "Day_of_Week": rng.choice(["Weekday", "Weekend"], n),
            "Passenger_Count": rng.integers(1, 5, n).astype(float),
            "Traffic_Conditions": rng.choice(["Low", "Medium", "High"], n),
            "Weather": rng.choice(["Clear", "Rain", "Snow"], n),
            "Base_Fare": rng.uniform(2, 5, n).round(2),
            "Per_Km_Rate": rng.uniform(0.5, 2, n).round(2),
            "Per_Minute_Rate": rng.uniform(0.1, 0.5, n).round(2),
            "Trip_Duration_Minutes": rng.uniform(5, 120, n).round(2),
        }
    )
    pdf[TARGET] = (
        pdf.Base_Fare + pdf.Trip_Distance_km * pdf.Per_Km_Rate + pdf.Trip_Duration_Minutes * pdf.Per_Minute_Rate
    ).round(2)
    for c in (*NUMERIC_COLUMNS, *CATEGORICAL_COLUMNS):
        pdf.loc[rng.random(n) < 0.05, c] = None
    pdf.loc[rng.choice(n, 49, replace=False), TARGET] = None
    path = tmp_path_factory.mktemp("trips") / "trips.csv"
    pdf.to_csv(path, index=False)
    return read_csv(spark, str(path))


@pytest.fixture(scope="module")
def run(trips):
    settings = {
        "polynomial": {"degree": 3, "alpha": 1.0},
        "extra_trees": {"n_estimators": 8, "max_depth": 8},
        "boosted_trees": {"n_estimators": 8, "learning_rate": 0.3},
    }
    return run_training(trips, trip_plan(["trip"]), names=list(settings), hyperparams=settings)


def test_shapes_of_a_run(trips, run):
    trained, fitted = run
    assert trips.count() == 1000 and prepare(trips, CONSTRAINTS).count() == 951
    assert trained.data_info() == {"n_train": 760, "n_test": 191, "n_features": 18}
    # missing text is a level of its own; for the day it is the first level, which one-hot drops
    assert sum(c.endswith("_nan") for c in fitted.features) == 3
    subset = trained.results["polynomial"]["hyperparams"]["feature_subset"]
    assert {"Trip_Distance_km", "Per_Km_Rate"} <= set(subset)
    assert term_count(3, 3) == 19
    assert all(r["test_r2"] > 0.7 for r in trained.results.values())


def test_unseen_levels_score_as_zeros(spark, run):
    trained, fitted = run
    new = spark.createDataFrame(
        [(1, 12.5, "Morning", "Monday", 2, "Low", "Rainy", 3.0, 1.2, 0.3, 25), (2, 30.0, "Evening", "Friday", 1, "High", "Clear", 4.0, 1.0, 0.2, 45)],
        "trip int, Trip_Distance_km double, Time_of_Day string, Day_of_Week string, Passenger_Count int, Traffic_Conditions string, "
        "Weather string, Base_Fare double, Per_Km_Rate double, Per_Minute_Rate double, Trip_Duration_Minutes int",
    )
    ready = fitted.transform(new)
    rows = {r["trip"]: r for r in ready.collect()}
    days = [c for c in ready.columns if c.startswith("Day_of_Week_")]
    assert len(days) == 2 and all(rows[t][c] == 0 for t in rows for c in days)
    assert rows[1]["Traffic_Conditions_low"] == 1 and rows[1]["Time_of_Day_morning"] == 1
    assert trained.predict(ready).where("prediction is null").count() == 0


def test_interactions_and_record_rules(trips):
    _, ready = trip_plan(["trip"], with_interactions=True).fit_transform(prepare(trips, CONSTRAINTS))
    assert {"Trip_Distance_km_x_Per_Km_Rate", "Trip_Duration_Minutes_x_Per_Minute_Rate"} <= set(ready.columns)
    checked = clean.validate_rows(trips, RECORD_RULES)
    snow = checked.where("Weather = 'Snow'").where(F.array_contains("violations", "Weather"))
    assert snow.count() == checked.where("Weather = 'Snow'").count() > 0
