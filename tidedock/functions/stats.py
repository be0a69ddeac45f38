"""Aggregate and scalar expressions for error metrics, binning and distribution tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PSI_EPSILON = 1e-4  # fixed value, added to each bin share after normalising


def regression_aggregates(actual: Column, predicted: Column) -> dict[str, Column]:
    """``mae``, ``rmse`` and ``r2`` as one set of mergeable aggregates.

    A constant target scores 1 when every prediction is exact and 0 otherwise; fewer than two
    rows have no R².
    """
    error = actual - predicted
    sse = F.sum(error * error)
    total = F.count(error) * F.var_pop(F.when(error.isNotNull(), actual))
    r2 = (
        F.when(F.count(error) < 2, F.lit(None).cast("double"))
        .when(total == 0, F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(sse, total))
    )
    return {"mae": F.avg(F.abs(error)), "rmse": F.sqrt(F.avg(error * error)), "r2": r2}


def improvement_pct(value: Column, baseline: Column) -> Column:
    return (1 - F.try_divide(value, baseline)) * 100


def bin_index(value: Column, low: Column, high: Column, n_bins: int) -> Column:
    """Zero-based equal-width bin, each bin closed on the left and the last one on both sides.

    The first estimate comes from a division; it is then compared with the edges
    ``low + i * step`` so that values on an edge fall where the edge itself says.
    A zero-width range has a single occupied bin, the last.
    """
    step = (high - low) / F.lit(float(n_bins))
    raw = F.floor(F.try_divide((value - low), step)).cast("int")
    guess = F.greatest(F.lit(0), F.least(F.lit(n_bins - 1), raw))
    down = (value < low + guess * step).cast("int")
    up = ((value >= low + (guess + 1) * step) & (guess < n_bins - 1)).cast("int")
    return F.when(high <= low, F.lit(n_bins - 1)).otherwise(guess - down + up)


def psi_term(reference: Column, current: Column, n_reference: Column, n_current: Column) -> Column:
    """One bin's contribution; the shares are smoothed after normalising."""
    ref = reference / n_reference + F.lit(PSI_EPSILON)
    cur = current / n_current + F.lit(PSI_EPSILON)
    return (cur - ref) * F.log(cur / ref)


def ks_p_value(statistic: Column, n_reference: Column, n_current: Column, terms: int = 100) -> Column:
    """Two-sided p from the Kolmogorov series with the usual small-sample scaling of the argument."""
    effective = n_reference * n_current / (n_reference + n_current)
    root = F.sqrt(effective)
    lam = (root + 0.12 + 0.11 / root) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    # Below 0.2 the distribution function is 0 to more than ten digits and the series needs more terms.
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def mae_alert(current: Column, baseline: Column, threshold: float = 0.20) -> Column:
    """Strictly above the allowed degradation; without a positive baseline any error alerts."""
    return F.when(baseline <= 0, current > 0).otherwise(current > baseline * F.lit(1 + threshold))
