"""From raw status to the split feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidedock import schemas
from tidedock.functions.timefns import GRID
from tidedock.operators.features import build_features, feature_frame
from tidedock.operators.regularise import attach_statics, bin_status, fill_forward
from tidedock.operators.split import time_based_split
from tidedock.sources.writers import write_dataset
from tidedock.staging import stage


def regular_series(
    status: DataFrame, information: DataFrame, freq: str = GRID, min_days: int | None = None, known_only: bool = False
) -> DataFrame:
    """Filled grid rows with station constants.

    Raw rows shuffle once, already reduced to bins; the constants join onto bins. ``known_only``
    drops stations without constants right there.
    """
    bins = bin_status(status, freq, lasts=["is_renting", "is_returning"])
    placed = attach_statics(bins, information, "inner" if known_only else "left")
    return fill_forward(placed, freq, min_days=min_days).na.drop(subset=schemas.COUNT_COLS)


def feature_table(
    status: DataFrame, information: DataFrame, freq: str = GRID, min_days: int | None = None
) -> DataFrame:
    """Features without nulls. Unknown stations would all be dropped at the end, so they never enter."""
    return feature_frame(build_features(regular_series(status, information, freq, min_days, known_only=True)))


def split_table(status: DataFrame, information: DataFrame, freq: str = GRID, min_days: int | None = None) -> DataFrame:
    """The labelled feature table. Features are written once; cuts, labels and later passes read them."""
    return time_based_split(stage(feature_table(status, information, freq, min_days), "features"))


def build_dataset(
    status: DataFrame, information: DataFrame, path: str, freq: str = GRID, min_days: int | None = 7
) -> None:
    """Write the split dataset, long-lived stations only."""
    write_dataset(split_table(status, information, freq, min_days), path)
