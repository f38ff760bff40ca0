"""Choosing strategies under limits, and calling a rollout back when it does badly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rollbacks(requests: DataFrame, group: list[str], order: str, last: int = 20, least_all: int = 10, least_trial: int = 5, performance: float = 0.6, errors: float = 0.1) -> DataFrame:
    """requests (group columns, order, trial, performance, failed) with trial_mean, error_rate and roll_back, as known after each.

    trial_mean is over trial requests among the `last` ones. A rollout goes back when that is under `performance` or more
    than `errors` of all requests failed, once there are least_all requests and least_trial trial ones among the last.
    """
    w = Window.partitionBy(*group).orderBy(order)
    recent, so_far = w.rowsBetween(1 - last, 0), w.rowsBetween(Window.unboundedPreceding, 0)
    out = requests.withColumns({
        "trial_mean": F.avg(F.when(F.col("trial"), F.col("performance"))).over(recent),
        "error_rate": F.avg(F.coalesce(F.col("failed"), F.lit(False)).cast("double")).over(so_far),
        "_trials": F.count(F.when(F.col("trial"), 1)).over(recent), "_n": F.count("*").over(so_far),
    })
    bad = (F.col("trial_mean") < performance) | (F.col("error_rate") > errors)
    return out.withColumn("roll_back", F.coalesce((F.col("_n") >= least_all) & (F.col("_trials") >= least_trial) & bad, F.lit(False))).drop("_trials", "_n")


def within_limits(chosen: Column, strategies: list[tuple[str, float, float]], pages: Column, seconds: Column, resource: Column) -> Column:
    """The chosen strategy, or the first that meets a limit which it breaks: time first, then resources. Null limits don't bind.

    strategies: (name, seconds a page, share of resources), in order of preference.
    """
    of = lambda k: F.element_at(F.create_map(*[F.lit(x) for s in strategies for x in (s[0], float(s[k]))]), chosen)

    def first(meets) -> Column:
        return F.coalesce(*[F.when(meets(s), s[0]) for s in strategies])

    in_time, in_means = first(lambda s: s[1] * pages <= seconds), first(lambda s: F.lit(float(s[2])) <= resource)
    return F.coalesce(F.when(of(1) * pages > seconds, in_time), F.when(of(2) > resource, in_means), chosen)


def backoff_seconds(attempt: Column, first: float = 1.0, most: float = 60.0) -> Column:
    """How long to wait before attempt n, from 0: doubling from `first`, up to `most`."""
    return F.least(first * F.pow(F.lit(2.0), attempt), F.lit(most))
