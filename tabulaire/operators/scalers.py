"""Column scalers: fit (one aggregate of one row), then transform any table by a plain projection.

Missing values are skipped by fits and stay missing in results. Standard
deviations are those of the population, quantiles are exact and interpolated,
and a scale of 0 becomes 1. A scaler says once, as columns, what it learns from a
column's statistics; that serves three ways: ``fit`` collects it, and
transforms by literals; ``apply`` leaves it in the plan as a scalar subquery, so
no job runs before the result is asked for; ``finish`` takes statistics that
were merged from parts (see ``plans.state``).
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, functions as F

from tabulaire.functions.columns import finite, numeric_columns, replaced
from tabulaire.plans.state import sketched_quantiles, statistics
from tabulaire.plans.stats import WIDE, Aggregates, collected, quantiles, summary

EPS = 2.220446049250313e-16  #: fixed value: the spacing of doubles at 1

#: A statistic of a column by its name.
Stat = Callable[[str], Column]


def safe_scale(scale: Column) -> Column:
    """1 for a scale that is 0 but for rounding; null stays null."""
    return F.when(scale < 10 * EPS, F.lit(1.0)).otherwise(scale)


@dataclass
class Fitted:
    """What a fit learned: a list a statistic, aligned with ``columns``; None where a column has no values."""

    columns: list[str]
    rows: int
    counts: list[int]
    values: dict[str, list]

    @property
    def samples_seen(self) -> int | list[int] | None:
        """The values that were seen: one number if every column has as many, else one a column."""
        return (self.counts[0] if len(set(self.counts)) == 1 else self.counts) if self.counts else None


@dataclass
class Scaler:
    """Base of the scalers: ``columns`` None or empty means every number column."""

    columns: list[str] | None = None
    wide: int = field(default=WIDE, repr=False)

    #: Statistics that ``learned_from`` needs besides n.
    aggregates = property(lambda self: {})

    def learned_from(self, stat: Stat) -> dict[str, Column]:
        """What is learned of a column, from its statistics."""
        raise NotImplementedError

    def expression(self, x: Column, learned: Stat) -> Column:
        """The scaled value."""
        raise NotImplementedError

    def kept(self, values: dict[str, list]) -> dict[str, list]:
        """What of all that was learned the flags leave."""
        return values

    @property
    def flags(self) -> dict[str, object]:
        """The parameters besides the columns."""
        return {k: v for k, v in asdict(self).items() if k not in ("columns", "wide")}

    def plan(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """One row: rows, and found, all that is learned of each column in order."""
        one = summary(df, columns, self.aggregates, self.wide)
        return self._learn(one)

    def _learn(self, one: DataFrame) -> DataFrame:
        def learn(f: Column) -> Column:
            made = self.learned_from(lambda name: f[name])
            return F.struct(f["n"].alias("n"), f["bad"].alias("bad"), *[c.alias(k) for k, c in made.items()])

        return one.select("rows", F.transform("found", learn).alias("found"))

    def fit(self, df: DataFrame) -> Fitted:
        columns = numeric_columns(df, self.columns)
        return self.fitted(columns, *collected(self.plan(df, columns), columns))

    def fitted(self, columns: list[str], rows: int, found: list[dict]) -> Fitted:
        names = [k for k in (found[0] if found else {}) if k not in ("n", "bad")]
        if not names or len(found[0]) == 1:  # a stacked table without rows: nothing was learned
            names = list(self.learned_from(lambda name: F.lit(None).cast("double")))
        values = {k: [f.get(k) for f in found] for k in names}
        return Fitted(columns, rows, [f["n"] for f in found], self.kept(values))

    def stated(self, state: DataFrame) -> DataFrame:
        """A merged state with the statistics that ``learned_from`` asks for."""
        return statistics(state)

    def finish(self, state: DataFrame, columns: list[str] | None = None) -> Fitted:
        """The fit of a merged state (see ``plans.state``), a row a column; by default all its columns, by name."""
        made = self.learned_from(F.col)
        state = self.stated(state)
        rows = {r["column_name"]: r.asDict() for r in state.select("column_name", "rows", "n", F.col("infinite").alias("bad"), *[c.alias(k) for k, c in made.items()]).collect()}
        columns = list(columns or self.columns or sorted(rows))
        if absent := [c for c in columns if c not in rows]:
            raise ValueError(f"the state has no columns {absent}")
        if infinite := [c for c in columns if rows[c]["bad"]]:
            raise ValueError(f"Input contains infinity in columns: {infinite}")
        return self.fitted(columns, max((r["rows"] for r in rows.values()), default=0), [{k: v for k, v in rows[c].items() if k not in ("column_name", "rows")} for c in columns])

    def learned(self, fitted: Fitted) -> dict[str, object]:
        """What a report says of a fit; min-max and max-abs have seen every row, missing or not."""
        return {**fitted.values, "samples_seen": fitted.rows}

    def transform(self, df: DataFrame, fitted: Fitted) -> DataFrame:
        """``df`` with the fitted columns scaled, as doubles; other columns and the order stay."""
        numeric_columns(df, fitted.columns)
        return replaced(df, {c: self.expression(finite(c), lambda name, i=i: F.lit(fitted.values[name][i])) for i, c in enumerate(fitted.columns)})

    def apply(self, df: DataFrame) -> DataFrame:
        """Fit and transform in one plan: no job runs here; the fit is a scalar subquery, found once before the scan of the result."""
        columns = numeric_columns(df, self.columns)
        name = "fit"
        while name in df.columns:
            name += "_"
        # the numbers go with each row as one array, which generated code reads in place
        whole = df.select("*", self.plan(df, columns).select("found").scalar().alias(name))
        return replaced(whole, {c: self.expression(finite(c), lambda k, i=i: F.get(name, F.lit(i))[k]) for i, c in enumerate(columns)}, df.columns)


@dataclass
class Standard(Scaler):
    """(x - mean) / standard deviation."""

    with_mean: bool = True
    with_std: bool = True

    @property
    def aggregates(self) -> Aggregates:
        return {"mean": F.avg, "variance": F.var_pop}

    def learned_from(self, stat: Stat) -> dict[str, Column]:
        n, mean, variance = stat("n"), stat("mean"), stat("variance")
        # a variance within the rounding of its own computation is that of a constant
        rounding = n * EPS * variance + (n * mean * EPS) * (n * mean * EPS)
        return {"mean": mean, "variance": variance, "scale": F.when(variance <= rounding, F.lit(1.0)).otherwise(F.sqrt(variance))}

    def kept(self, values: dict[str, list]) -> dict[str, list]:
        return {"mean": values["mean"] if self.with_mean or self.with_std else [], "variance": values["variance"] if self.with_std else [], "scale": values["scale"] if self.with_std else []}

    def expression(self, x: Column, learned: Stat) -> Column:
        if self.with_mean:
            x = x - learned("mean")
        return x / learned("scale") if self.with_std else x

    def learned(self, fitted: Fitted) -> dict[str, object]:
        return {**fitted.values, "samples_seen": fitted.samples_seen}


@dataclass
class MinMax(Scaler):
    """Each column's range mapped to ``feature_range``, clipped to it if asked."""

    feature_range: tuple[float, float] = (0, 1)
    clip: bool = False

    def __post_init__(self) -> None:
        if not self.feature_range[0] < self.feature_range[1]:
            raise ValueError(f"featureRange must rise: {self.feature_range}")

    @property
    def aggregates(self) -> Aggregates:
        return {"low": F.min, "high": F.max}

    def learned_from(self, stat: Stat) -> dict[str, Column]:
        low, high = map(float, self.feature_range)
        span = stat("high") - stat("low")
        scale = F.lit(high - low) / safe_scale(span)
        return {"min_adjustment": F.lit(low) - stat("low") * scale, "scale": scale, "data_min": stat("low"), "data_max": stat("high"), "data_range": span}

    def expression(self, x: Column, learned: Stat) -> Column:
        y = x * learned("scale") + learned("min_adjustment")
        low, high = map(float, self.feature_range)
        # least and greatest skip nulls, so missing values have to be kept out of them
        return F.when(y.isNotNull(), F.least(F.greatest(y, F.lit(low)), F.lit(high))) if self.clip else y


@dataclass
class MaxAbs(Scaler):
    """x / the largest absolute value. ``clip`` is accepted and has no effect."""

    clip: bool = False

    def __post_init__(self) -> None:
        if self.clip:
            warnings.warn("clip has no effect on the max-abs scaler", stacklevel=3)

    @property
    def aggregates(self) -> Aggregates:
        return {"top": lambda x: F.max(F.abs(x))}

    def learned_from(self, stat: Stat) -> dict[str, Column]:
        return {"max_abs": stat("top"), "scale": safe_scale(stat("top"))}

    def expression(self, x: Column, learned: Stat) -> Column:
        return x / learned("scale")


@dataclass
class Robust(Scaler):
    """(x - median) / (upper - lower quantile), optionally to unit variance for normal data."""

    with_centering: bool = True
    with_scaling: bool = True
    quantile_range: tuple[float, float] = (25.0, 75.0)
    unit_variance: bool = False

    def __post_init__(self) -> None:
        low, high = self.quantile_range
        if not 0 < low < high < 100:
            raise ValueError(f"quantileRange must satisfy 0 < low < high < 100: {self.quantile_range}")

    @property
    def odds(self) -> list[float]:
        low, high = (q / 100 for q in self.quantile_range)
        return [low, 0.5, high]

    @property
    def adjust(self) -> float:
        """What the quantiles of a normal distribution of unit variance are apart, if scales are to give that."""
        low, _, high = self.odds
        return NormalDist().inv_cdf(high) - NormalDist().inv_cdf(low) if self.unit_variance else 1.0

    def plan(self, df: DataFrame, columns: list[str]) -> DataFrame:
        return self._learn(quantiles(df, columns, self.odds, self.wide))

    def stated(self, state: DataFrame) -> DataFrame:
        """Quantiles of a state are those of its sketch: near ones, unless it has seen few values."""
        return sketched_quantiles(state, self.odds)

    def learned_from(self, stat: Stat) -> dict[str, Column]:
        at = lambda i: F.get(stat("q").cast("array<double>"), F.lit(i))
        return {"center": at(1), "scale": safe_scale(at(2) - at(0)) / F.lit(self.adjust)}

    def kept(self, values: dict[str, list]) -> dict[str, list]:
        return {"center": values["center"] if self.with_centering else None, "scale": values["scale"] if self.with_scaling else None}

    def expression(self, x: Column, learned: Stat) -> Column:
        if self.with_centering:
            x = x - learned("center")
        return x / learned("scale") if self.with_scaling else x

    def learned(self, fitted: Fitted) -> dict[str, object]:
        return {**fitted.values, "n_features_in": len(fitted.columns)}


METHODS: dict[str, type[Scaler]] = {"standard": Standard, "min_max": MinMax, "max_abs": MaxAbs, "robust": Robust}


def standardize(df: DataFrame, method: str, columns: list[str] | None = None, **flags) -> DataFrame:
    """Fit and transform as one lazy plan."""
    return METHODS[method](columns, **flags).apply(df)
