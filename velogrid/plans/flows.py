"""The three flows: training, scoring and the comparison of a day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velogrid.operators.cleaning import clean_users, on_day, train_part, type_trips, valid_trips
from velogrid.operators.comparison import compare_stations, model_performance
from velogrid.operators.boosting import fit_patient_trees
from velogrid.operators.columns import drop_prefixed
from velogrid.operators.grid import station_grid
from velogrid.operators.learning import predict
from velogrid.operators.metrics import regression_metrics
from velogrid.operators.scoring import input_kind, validate_input
from velogrid.operators.splits import split_by_week, validation_days
from velogrid.schemas import BASE_FEATURES, TARGET
from velogrid.stages import Stage, stage

TEXT_COLUMNS = ["nombre_estacion", "direccion_estacion", "modelo_mas_comun"]


@dataclass
class Trained:
    """A model and its metrics, which read the staged grid until ``close`` deletes it; ``with`` closes at the end."""

    model: object
    features: list[str]
    train_metrics: DataFrame
    val_metrics: DataFrame
    best: int
    errors: list[float]
    staged: list[Stage]

    def close(self) -> None:
        while self.staged:
            self.staged.pop().close()

    def __enter__(self) -> Trained:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def training_grid(trips: DataFrame, users: DataFrame | None, until: tuple[int, int] = (2024, 8)) -> DataFrame:
    """The model grid of the trips up to the cut month, names left out."""
    return drop_prefixed(station_grid(train_part(trips, *until), users, salt=None), TEXT_COLUMNS)


def train(
    trips: DataFrame,
    users: DataFrame | None,
    features: list[str] = BASE_FEATURES,
    until: tuple[int, int] = (2024, 8),
    patience: int = 25,
    **learner,
) -> Trained:
    """Grid, weekly split, boosted trees that stop with patience, and their metrics.

    The grid is a stage, clustered by station, as the fit and both evaluations read it. It stays for the lazy metrics; ``close`` the result.
    """
    rows = training_grid(trips, users, until).select("timestamp", TARGET, *features)
    grid = stage(rows, "grid", "id_estacion" if "id_estacion" in features else None)
    days = stage(validation_days(grid.read()), "days")
    part, val = split_by_week(grid.read(), days=days.read())
    fit = fit_patient_trees(part, val, features, patience=patience, **learner)
    metrics = [regression_metrics(predict(fit.model, rows, features)) for rows in (part, val)]
    return Trained(fit.model, features, *metrics, fit.best, fit.errors, [grid, days])


def scoring_features(df: DataFrame, users: DataFrame | None = None, clean: bool = True, features: list[str] = BASE_FEATURES) -> DataFrame:
    """Ready features as they are; raw trips through the same cleaning and grid as in training.

    ``clean=False`` leaves short trips and all ages in.
    """
    check = validate_input(df, features)
    if not check.valid:
        raise ValueError(f"these rows can't be scored: {check.reason} {', '.join(check.columns)}")
    if input_kind(df, features) == "processed":
        return df
    trips = type_trips(df)
    if clean:
        trips = valid_trips(trips)
        users = None if users is None else clean_users(users)
    return drop_prefixed(station_grid(trips, users, salt=None, lags=6 if any("_prev" in f for f in features) else 0), TEXT_COLUMNS)


def score(model, df: DataFrame, users: DataFrame | None = None, clean: bool = True, features: list[str] = BASE_FEATURES) -> DataFrame:
    """Predicted arrivals for raw trips or ready features; real arrivals stay beside them."""
    return predict(model, scoring_features(df, users, clean, features), features)


def compare_day(predicted: DataFrame, stations: DataFrame | None, day: str, hour: int | None = 8) -> tuple[DataFrame, DataFrame]:
    """(rows per station, performance) for a day and an hour; a day without data gives none."""
    chosen = on_day(predicted, day)
    rows = compare_stations(chosen, stations, hour)
    return rows, model_performance(rows).filter(F.col("total_stations") > 0)
