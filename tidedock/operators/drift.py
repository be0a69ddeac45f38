"""Distribution and error drift: PSI, two-sample KS, rolling MAE, alerts and reports.

All distributions of a report are compared together. PSI needs only ranges and bin counts; for the KS supremum values
are counted per (group, value), which shrinks before the shuffle, and range-partitioned, never one sorted list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.functions import labels
from tidedock.functions.stats import bin_index, ks_p_value, mae_alert, psi_term
from tidedock.operators.metrics import regression_metrics
from tidedock.operators.ordered import blocked_window, global_index, keyed_windows, value_parts
from tidedock.staging import stage_small

# Defaults of the drift measures. 96 rows are 24 hours on the 15-minute grid.
PSI_BINS = 10
KS_ALPHA = 0.05
PSI_THRESHOLD = 0.2
ROLLING_ROWS = 96
MIN_PREDICTIONS = 96
#: Up to so many pairs of sample sizes the p-value counts orderings exactly; a parameter, not a property of the data.
EXACT_PAIRS = 250_000


def _rolling_mae(rows: DataFrame, order: WindowSpec, window: int) -> DataFrame:
    """Trailing mean of ``_error``; null until the window is full, and while it holds a missing error.

    A bounded frame: what has left the window, a missing or a huge error, has no effect on later rows.
    """
    recent = order.rowsBetween(-(window - 1), 0)
    mean = F.when(F.count("_error").over(recent) == window, F.avg("_error").over(recent))
    return rows.withColumn("rolling_mae", mean)


def _error(actual: str, predicted: str) -> Column:
    return labels.null_if_nan(F.abs(F.col(actual) - F.col(predicted)).cast("double"))


def rolling_mae_by_station(
    df: DataFrame, actual: str, predicted: str, time_col: str, window: int = ROLLING_ROWS,
    by: list[str] | None = None, block_rows: int | None = None,
) -> DataFrame:
    """Trailing MAE over ``window`` rows of each station (or other group).

    On the grid a station is bounded by time. ``block_rows`` spreads groups of any size over blocks.
    """
    by = by or ["station_id"]
    rows = df.withColumn("_error", _error(actual, predicted))
    if block_rows is None:
        out = _rolling_mae(rows, W.partitionBy(*by).orderBy(time_col), window)
    else:
        out = keyed_windows(rows, by, [time_col], window - 1, 0, lambda r, o: _rolling_mae(r, o, window), block_rows)
    return out.drop("_error")


def rolling_mae_global(
    df: DataFrame, actual: str, predicted: str, order_by: list[str], window: int = ROLLING_ROWS,
    block_rows: int = 100_000,
) -> DataFrame:
    """Trailing MAE over the whole frame in ``order_by`` order, with the row position ``idx``."""
    rows = df.select(*order_by, _error(actual, predicted).alias("_error"))
    indexed = global_index(rows, order_by, "rolling-mae")
    out = blocked_window(indexed, window - 1, 0, lambda r, o: _rolling_mae(r, o, window), block_rows=block_rows)
    return out.drop("_error")


def with_alert_lines(rolling: DataFrame, baseline_mae: Column) -> DataFrame:
    """Baseline and alert level next to the rolling error."""
    return rolling.withColumns(
        {"baseline_mae": baseline_mae, "alert_mae": baseline_mae * F.lit(labels.MAE_ALERT_FACTOR)}
    )


def two_sides(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Long form ``(feature, value, ref, cur)`` with one row per non-null value of either side."""

    def melt(df: DataFrame, ref: int, cur: int) -> DataFrame:
        schemas.require_columns(df, features)
        wide = df.select(*[labels.null_if_nan(F.col(c).cast("double")).alias(c) for c in features])
        long = wide.unpivot([], features, "feature", "value").where(F.col("value").isNotNull())
        return long.select("feature", "value", F.lit(ref).alias("ref"), F.lit(cur).alias("cur"))

    return melt(reference, 1, 0).unionByName(melt(current, 0, 1))


def psi_scores(long: DataFrame, group: str = "feature", n_bins: int = PSI_BINS) -> DataFrame:
    """``psi``, ``n_ref`` and ``n_cur`` per group from ``(group, value, ref, cur)`` rows.

    Two aggregations with map-side combine, one for the range and one for the bins; no value is shuffled. The rows are
    read twice.
    """
    profile = long.groupBy(group).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur")
    )
    profile = stage_small(profile.where((F.col("n_ref") >= 2) & (F.col("n_cur") >= 2)), "value-profile")
    binned = long.join(profile, group).select(
        group, "ref", "cur", "n_ref", "n_cur", bin_index(F.col("value"), F.col("lo"), F.col("hi"), n_bins).alias("bin")
    )
    side = lambda i, c: F.sum(F.when(F.col("bin") == i, F.col(c)).otherwise(0)).alias(f"{c[0]}{i}")
    counts = binned.groupBy(group).agg(
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
        *[side(i, c) for i in range(n_bins) for c in ("ref", "cur")],
    )
    terms = [psi_term(F.col(f"r{i}"), F.col(f"c{i}"), F.col("n_ref"), F.col("n_cur")) for i in range(n_bins)]
    return counts.select(group, reduce(lambda a, b: a + b, terms).alias("psi"), "n_ref", "n_cur")


def ks_statistics(long: DataFrame, group: str = "feature") -> DataFrame:
    """``ks_statistic``, ``n_ref`` and ``n_cur`` per group.

    Counted values are range-partitioned on (group, value). Running counts inside a part and the counts ahead of it give
    both distribution functions at every value, wherever the parts were cut.
    """
    counts = long.groupBy(group, "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    rows = value_parts(counts, [group], "value", "value-sides")
    sides = rows.groupBy(group, "part").agg(F.sum("ref").alias("r"), F.sum("cur").alias("c"))
    ahead = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(group)
    offsets = sides.select(
        group,
        "part",
        F.coalesce(F.sum("r").over(ahead), F.lit(0)).alias("r_before"),
        F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("c_before"),
        F.sum("r").over(whole).alias("n_ref"),
        F.sum("c").over(whole).alias("n_cur"),
    ).where((F.col("n_ref") >= 2) & (F.col("n_cur") >= 2))
    running = W.partitionBy(group, "part").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    inside = rows.select(
        group, "part", F.sum("ref").over(running).alias("r"), F.sum("cur").over(running).alias("c")
    )
    gap = (F.col("r_before") + F.col("r")) / F.col("n_ref") - (F.col("c_before") + F.col("c")) / F.col("n_cur")
    joined = inside.join(offsets, [group, "part"])
    return joined.groupBy(group).agg(
        F.max(F.abs(gap)).alias("ks_statistic"), F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur")
    )


def exceeding_share(statistic: Column, n: Column, m: Column) -> Column:
    """Share of the equally likely orderings of two samples whose KS statistic reaches ``statistic``.

    An ordering is a path from (0, 0) to (n, m). The share of paths to a point that have touched the bound before is a weighted
    mean of the shares at the two points ahead of it, so one sweep over the diagonals needs only sums of
    positive terms and keeps small values exact to many digits. A diagonal has as many points as the smaller sample.
    """
    small, large = F.least(n, m).cast("long"), F.greatest(n, m).cast("long")
    reach = F.round(statistic * small * large)
    places = F.sequence(F.lit(0).cast("long"), small)

    def next_diagonal(share: Column, s: Column) -> Column:
        def at(i: Column) -> Column:
            left = F.coalesce(F.get(share, (i - 1).cast("int")), F.lit(0.0)) * i
            below = F.get(share, i.cast("int")) * F.greatest(s - i, F.lit(0).cast("long"))
            return F.when(F.abs(i * large - (s - i) * small) >= reach, 1.0).otherwise((left + below) / s)

        return F.transform(places, at)

    first = F.transform(places, lambda i: F.when(reach <= 0, 1.0).otherwise(0.0))
    last = F.aggregate(F.sequence(F.lit(1).cast("long"), small + large), first, next_diagonal)
    return F.element_at(last, -1)


def with_p_values(ks: DataFrame, exact_pairs: int = EXACT_PAIRS) -> DataFrame:
    """``ks_p_value`` for (ks_statistic, n_ref, n_cur): exact for small samples, the Kolmogorov series beyond."""
    # Few bytes but long sweeps: dealt by a given number, which adaptive execution does not merge into one task.
    ks = ks.repartition(int(ks.sparkSession.conf.get("spark.sql.shuffle.partitions")), *ks.columns)
    sizes = F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")
    exact = F.when(F.col("n_ref") * F.col("n_cur") <= exact_pairs, exceeding_share(*sizes))
    return ks.select(*ks.columns, exact.otherwise(ks_p_value(*sizes)).alias("ks_p_value"))


def compare_distributions(
    long: DataFrame, group: str = "feature", n_bins: int = PSI_BINS, exact_pairs: int = EXACT_PAIRS
) -> DataFrame:
    """PSI, KS statistic and its p-value per group from ``(group, value, ref, cur)`` rows, which are read three times."""
    ks = with_p_values(ks_statistics(long, group), exact_pairs)
    both = psi_scores(long, group, n_bins).select(group, "psi").join(ks, group)
    return both.select(group, "psi", "ks_statistic", "ks_p_value", "n_ref", "n_cur")


def feature_drift(
    reference: DataFrame,
    current: DataFrame,
    features: list[str] = schemas.FEATURE_COLS,
    psi_threshold: float = PSI_THRESHOLD,
    ks_alpha: float = KS_ALPHA,
) -> DataFrame:
    """One row per feature; features with fewer than two values on a side are left out."""
    compared = compare_distributions(two_sides(reference, current, features))
    return with_verdict(compared, psi_threshold, ks_alpha)


def split_sides(
    splits: DataFrame, features: list[str], reference: str = "train", current: str = "test"
) -> DataFrame:
    """Long form of two values of a ``split`` column, reading the table once."""
    rows = splits.where(F.col("split").isin(reference, current))
    wide = rows.select(
        (F.col("split") == reference).cast("int").alias("ref"),
        (F.col("split") == current).cast("int").alias("cur"),
        *[labels.null_if_nan(F.col(c).cast("double")).alias(c) for c in features],
    )
    return wide.unpivot(["ref", "cur"], features, "feature", "value").where(F.col("value").isNotNull())


def split_feature_drift(
    splits: DataFrame, features: list[str] = schemas.FEATURE_COLS, reference: str = "train", current: str = "test"
) -> DataFrame:
    long = split_sides(splits, features, reference, current)
    return with_verdict(compare_distributions(long), PSI_THRESHOLD, KS_ALPHA)


def with_verdict(compared: DataFrame, psi_threshold: float, ks_alpha: float) -> DataFrame:
    """Drift flag, status and severity of compared distributions."""
    drifted = (F.col("psi") > psi_threshold) | (F.col("ks_p_value") < ks_alpha)
    return compared.select(
        "feature",
        "psi",
        "ks_statistic",
        "ks_p_value",
        drifted.alias("drifted"),
        labels.drift_status(drifted).alias("status"),
        labels.psi_severity(F.col("psi")).alias("severity"),
    )


def ranked(drift: DataFrame) -> DataFrame:
    return drift.orderBy(F.col("psi").desc(), "feature")


def drift_summary(drift: DataFrame) -> DataFrame:
    """Share and number of drifted features, mean and largest PSI; zeros when there are none."""
    n, hit = F.count("*"), F.count_if("drifted")
    out = drift.agg(
        F.coalesce(F.try_divide(hit, n), F.lit(0.0)).alias("drift_score"),
        n.alias("n_features"),
        hit.alias("n_drifted"),
        F.coalesce(F.avg("psi"), F.lit(0.0)).alias("avg_psi"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
    )
    return out.withColumn("severity", labels.score_severity(F.col("drift_score")))


def model_distributions(pairs: DataFrame, by: str = "model_name") -> DataFrame:
    """Long form of actual (reference) against predicted (current) values per model."""
    return pairs.select(
        by,
        F.explode(
            F.array(
                F.struct(F.col("actual_value").alias("value"), F.lit(1).alias("ref"), F.lit(0).alias("cur")),
                F.struct(F.col("predicted_value").alias("value"), F.lit(0).alias("ref"), F.lit(1).alias("cur")),
            )
        ).alias("e"),
    ).select(by, "e.*")


def drift_report(
    pairs: DataFrame,
    baselines: DataFrame,
    threshold: float = 0.20,
    ks_alpha: float = KS_ALPHA,
    min_predictions: int = MIN_PREDICTIONS,
) -> DataFrame:
    """One row per model with enough complete pairs and a known baseline MAE."""
    errors = regression_metrics(pairs, "actual_value", "predicted_value", ["model_name"], with_count=True)
    errors = errors.where(F.col("n") >= min_predictions)
    known = baselines.select(F.col("model").alias("model_name"), F.col("mae").alias("baseline_mae"))
    distributions = compare_distributions(model_distributions(pairs), "model_name")
    report = errors.join(known, "model_name").join(distributions, "model_name")
    return report.select(
        "model_name",
        F.col("mae").alias("current_mae"),
        "baseline_mae",
        mae_alert(F.col("mae"), F.col("baseline_mae"), threshold).alias("mae_alert"),
        F.col("psi").alias("psi_score"),
        "ks_statistic",
        "ks_p_value",
        (F.col("ks_p_value") < ks_alpha).alias("distribution_drift"),
        F.col("n").alias("n_predictions"),
    )


def mae_delta(report: DataFrame) -> DataFrame:
    """Change of the error against the baseline; none without a baseline."""
    delta = F.when(F.col("baseline_mae") != 0, F.col("current_mae") - F.col("baseline_mae")).otherwise(0.0)
    return report.withColumn("mae_delta", delta)


def rounded_report(report: DataFrame) -> DataFrame:
    """The serialised form: measures with six decimals."""
    measures = ["current_mae", "baseline_mae", "psi_score", "ks_statistic", "ks_p_value"]
    return report.withColumns({c: F.bround(c, 6) for c in measures})


def numeric_columns(df: DataFrame) -> list[str]:
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [c for c, t in df.dtypes if t in numeric or t.startswith("decimal")]


def data_drift_table(reference: DataFrame, current: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Column-by-column drift over the given, else over all numeric columns both sides have."""
    if columns is None:
        columns = [c for c in numeric_columns(reference) if c in set(numeric_columns(current))]
    return feature_drift(reference, current, columns)


def regression_quality_table(
    reference: DataFrame, current: DataFrame, target: str = "target", prediction: str = "prediction"
) -> DataFrame:
    """Error metrics, mean error and its deviation for both sides."""
    both = reference.select(target, prediction, F.lit("reference").alias("side")).unionByName(
        current.select(target, prediction, F.lit("current").alias("side"))
    )
    error = F.col(prediction) - F.col(target)
    quality = regression_metrics(both, target, prediction, ["side"], with_count=True)
    spread = both.groupBy("side").agg(F.avg(error).alias("mean_error"), F.stddev_samp(error).alias("error_std"))
    return quality.join(spread, "side")
