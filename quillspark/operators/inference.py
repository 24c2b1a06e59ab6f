"""Resampling tests and normal intervals."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.ranks import RankedCounts, quantile, summarise
from quillspark.stages import settle

SEED, REPS, LEAST = 20260529, 3000, 5


def bootstrap_interval(values: np.ndarray, before: np.ndarray, after: np.ndarray, reps: int = REPS) -> tuple[float, float]:
    """2.5 % and 97.5 % quantiles of the resampled difference of medians of two groups; NaN for fewer than LEAST values.

    The groups come as one histogram, as in permutation_p.
    """
    if before.sum() < LEAST or after.sum() < LEAST:
        return math.nan, math.nan
    ranks = drawn_ranks(int(before.sum()), int(after.sum()), reps)
    return interval_of(*[_at(values, c, ranks[k]) for k, c in (("after low", after), ("after high", after), ("before low", before), ("before high", before))])


def interval_of(after_low: np.ndarray, after_high: np.ndarray, before_low: np.ndarray, before_high: np.ndarray) -> tuple[float, float]:
    """The interval from the middle values of every resample of either group."""
    diff = (after_low + after_high) / 2 - (before_low + before_high) / 2
    return float(np.quantile(diff, 0.025)), float(np.quantile(diff, 0.975))


def _at(values: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The values of a histogram at ranks from 0."""
    return values[np.searchsorted(np.cumsum(counts), ranks, "right")]


def drawn_ranks(n: int, m: int, reps: int = REPS) -> dict[str, np.ndarray]:
    """All ranks that the tests of a group of n and another of m values ask for, a draw of each for every repetition.

    The median of a resample depends on ranks only: the k-th of n uniform draws is Beta(k, n - k + 1), so two ranks are
    drawn for each repetition in place of n values. A relabelling deals the pooled ranks to the groups, and all that its
    medians depend on is where the middle members of each group fall.
    """
    rng = np.random.default_rng(SEED)
    after, before = _resampled_middles(m, rng, reps), _resampled_middles(n, rng, reps)
    dealt = _dealt_middles(n, m, np.random.default_rng(SEED), reps)
    names = ["after low", "after high", "before low", "before high", "dealt low", "dealt high", "dealt first", "dealt last"]
    return dict(zip(names, [*after, *before, *dealt], strict=True))


def _resampled_middles(n: int, rng: np.random.Generator, reps: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, among n values, of the two middle members of a resample."""
    rank = lambda r: np.minimum((r * n).astype("i8"), n - 1)
    k = (n + 1) // 2
    low = rng.beta(k, n - k + 1, reps)
    if n % 2:
        return rank(low), rank(low)
    # The next draw above the k-th: the least of n - k uniform ones over what is left.
    high = low + (1 - low) * (1 - rng.random(reps) ** (1 / (n - k)))
    return rank(low), rank(high)


def permutation_p(values: np.ndarray, before: np.ndarray, after: np.ndarray, reps: int = REPS) -> float:
    """Two-sided p of the difference of medians of two groups, (extreme + 1) / (reps + 1); NaN for fewer than LEAST values.

    The groups come as one histogram: distinct `values` in order, and how often each group has them.
    """
    n, m = int(before.sum()), int(after.sum())
    if n < LEAST or m < LEAST:
        return math.nan
    seen = abs(_middle(values, after) - _middle(values, before))
    ranks = drawn_ranks(n, m, reps)
    return share_beyond(seen, *[_at(values, before + after, ranks[f"dealt {k}"]) for k in ("low", "high", "first", "last")])


def share_beyond(seen: float, low: np.ndarray, high: np.ndarray, first: np.ndarray, last: np.ndarray) -> float:
    """p of a difference from the middle values of both groups in every relabelling."""
    moved = np.abs((first + last) / 2 - (low + high) / 2)
    return float((np.count_nonzero(moved >= seen) + 1) / (len(moved) + 1))


def _middle(values: np.ndarray, counts: np.ndarray) -> float:
    """The median of a histogram."""
    n = int(counts.sum())
    low, high = _at(values, counts, np.array([(n - 1) // 2, n // 2]))
    return float((low + high) / 2)


def _dealt_middles(n: int, m: int, rng: np.random.Generator, reps: int) -> list[np.ndarray]:
    """Pooled ranks of the two middle members of a group of n, then of the other group of m, when n + m ranks are dealt at random.

    The places are drawn by halving the ranks again and again: how many of a group's members lie in the lower half is
    hypergeometric.
    """
    targets = [(True, (n - 1) // 2), (True, n // 2), (False, (m - 1) // 2), (False, m // 2)]
    # A target's stretch of ranks, how many members of the first group are in it, and which member of its own is sought.
    start, size = np.zeros((4, reps), "i8"), np.full((4, reps), n + m)
    own = np.full((4, reps), n)
    sought = np.repeat(np.array([[k] for _, k in targets]), reps, axis=1)
    while (size > 1).any():
        half = size // 2
        drawn = np.zeros((4, reps), "i8")
        for t, (mine, _) in enumerate(targets):
            drawn[t] = rng.hypergeometric(own[t], size[t] - own[t], half[t])
            # Targets in one stretch see one and the same deal.
            for u in range(t):
                same = (start[t] == start[u]) & (size[t] == size[u])
                drawn[t] = np.where(same, drawn[u], drawn[t])
        for t, (mine, _) in enumerate(targets):
            lower = drawn[t] if mine else half[t] - drawn[t]
            up = sought[t] >= lower
            sought[t] -= np.where(up, lower, 0)
            start[t] += np.where(up, half[t], 0)
            own[t] = np.where(up, own[t] - drawn[t], drawn[t])
            size[t] = np.where(up, size[t] - half[t], half[t])
    return list(start)


def _draws(batches: Iterator[pd.DataFrame], reps: int) -> Iterator[pd.DataFrame]:
    """Rows (template, metric, n_before, n_after) to the ranks that their tests ask for, and those of the medians themselves."""
    for pdf in batches:
        for key in pdf.itertuples(index=False):
            n, m = int(key.n_before), int(key.n_after)
            ranks = {f"{side} middle": np.array([(size - 1) // 2, size // 2]) for side, size in (("before", n), ("after", m)) if size}
            ranks |= drawn_ranks(n, m, reps) if min(n, m) >= LEAST else {}
            for kind, r in ranks.items():
                yield pd.DataFrame({"template": key.template, "metric": key.metric, "series": kind.split()[0], "kind": kind, "rep": np.arange(len(r)), "rank": r})


def _judged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """One row of tests from the values at the ranks that were drawn: as many as repetitions ask for, whatever the group."""
    found = {kind: part.sort_values("rep").value.to_numpy(float) for kind, part in pdf.groupby("kind")}
    middle = [float(found[k].mean()) if k in found else math.nan for k in ("before middle", "after middle")]
    low = high = p = diff = math.nan
    if "dealt low" in found:
        diff = middle[1] - middle[0]
        low, high = interval_of(*[found[k] for k in ("after low", "after high", "before low", "before high")])
        p = share_beyond(abs(diff), *[found[f"dealt {k}"] for k in ("low", "high", "first", "last")])
    return pd.DataFrame([[*key, *middle, diff, low, high, p]])


def year_tests(records: DataFrame, metrics: list[str], before: int, after: int, reps: int = REPS) -> DataFrame:
    """Medians of two years, the bootstrap interval of their difference and the permutation p, by template and metric.

    Values are counted first, partially before the shuffle; the counts of either year and of both lie in ranges of values.
    From the sizes of the groups alone all ranks of all repetitions are drawn, and answered by merges with the cumulative
    counts, range by range: no task holds a group's values, its histogram or a resample. What meets in one task for a
    template and metric are the answers, 8 for each repetition. Results don't depend on how rows arrive.
    """
    rows = records.filter(F.col("year").isin(before, after)).select("template", "year", *[F.col(m).cast("double").alias(m) for m in metrics])
    long = rows.unpivot(["template", "year"], metrics, "metric", "value").filter("value is not null and not isnan(value)")
    counted = long.groupBy("template", "metric", "value").agg(F.count_if(F.col("year") == before).alias("before"), F.count_if(F.col("year") == after).alias("after"))
    series = F.inline(F.array(*[F.struct(F.lit(s).alias("series"), n.alias("n")) for s, n in (("before", F.col("before")), ("after", F.col("after")), ("dealt", F.col("before") + F.col("after")))]))
    ranked = RankedCounts(counted.select("template", "metric", "value", series).filter("n > 0"), ["template", "metric", "series"])
    own = lambda s: F.coalesce(F.sum(F.when(F.col("series") == s, F.col("n"))), F.lit(0)).alias(f"n_{s}")
    sizes = ranked.totals().groupBy("template", "metric").agg(own("before"), own("after"))
    asked = sizes.mapInPandas(lambda it: _draws(it, reps), "template string, metric string, series string, kind string, rep long, rank long")
    met = ranked.at(settle(asked, "draws"))
    schema = "template string, metric string, median_before double, median_after double, difference double, ci_low double, ci_high double, p double"
    tests = met.groupBy("template", "metric").applyInPandas(_judged, schema)
    named = tests.withColumnsRenamed({"template": "_t", "metric": "_m"})
    return sizes.join(named, F.col("template").eqNullSafe(F.col("_t")) & F.col("metric").eqNullSafe(F.col("_m"))).drop("_t", "_m")


def significant(tests: DataFrame, level: float = 0.05) -> DataFrame:
    return tests.filter((F.col("p") <= level) & ((F.col("ci_low") > 0) | (F.col("ci_high") < 0)))


#: Steps of the integral behind erf; its error is below 1e-9.
STEPS = 1000


def erf(c: Column) -> Column:
    """The error function, by Simpson's rule over 0 to |c|; Spark has no built-in one. It differs from 1 by under 1e-15 beyond 6."""
    x = F.least(F.abs(c), F.lit(6.0))
    bell = lambda i: F.exp(-F.pow(x * i / STEPS, F.lit(2.0)))
    inner = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS - 1)), F.lit(0.0), lambda s, i: s + F.when(i % 2 == 1, 4.0).otherwise(2.0) * bell(i))
    return F.signum(c) * 2 / math.sqrt(math.pi) * x / (3 * STEPS) * (1 + inner + F.exp(-x * x))


def metric_intervals(long: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """n, mean, median, extremes and the normal 95 % interval of the mean by group; one value is its own interval."""
    g = summarise(
        long, keys,
        F.count(value).alias("n"), F.try_divide(F.round(F.sum(value), 6), F.count(value)).alias("_mean"), quantile(value, 0.5).alias("median"), F.min(value).alias("minimum"), F.max(value).alias("maximum"), F.stddev_samp(value).alias("_std"),
    )
    half = F.coalesce(1.96 * F.col("_std") / F.sqrt("n"), F.lit(0.0))
    zero = lambda c: F.coalesce(F.round(c, 4), F.lit(0.0))
    return g.withColumns({"mean": zero(F.col("_mean")), "lower": zero(F.col("_mean") - half), "upper": zero(F.col("_mean") + half)}).withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("median", "minimum", "maximum")})


def with_p(intervals: DataFrame) -> DataFrame:
    """The two-sided normal p of a mean of 0: 1 for fewer than two values, 0 where all values are the same."""
    t = F.abs(F.col("_mean")) / (F.col("_std") / F.sqrt("n"))
    p = F.when(F.col("n") < 2, 1.0).when(F.col("_std") == 0, 0.0).otherwise(2 * (1 - 0.5 * (1 + erf(F.when((F.col("n") > 1) & (F.col("_std") > 0), t / math.sqrt(2))))))
    return intervals.withColumn("p", p).drop("_mean", "_std")
