"""Contrast coding, logistic regression and chi-squared tests."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import astuple, dataclass, replace
from math import exp, log, sqrt

import numpy as np
import pandas as pd
from pyspark.errors import UnsupportedOperationException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexday.functions import chi_squared_tail, normal_two_sided
from indexday.operators.separation import Separation, find_separation, predictor

# Normal and chi-squared (one degree of freedom) quantiles for 95 % intervals.
Z_95 = 1.959963984540054
CHI2_95 = 3.841458820694124

MAX_LEVELS = 1000
MAX_ITERATIONS = 25
MAX_PROFILE_STEPS = 60
PROFILE_TOLERANCE = 1e-7
INTERCEPT = "(Intercept)"

# Columns, or columns with their levels in order.
Levels = Sequence[str] | Mapping[str, Sequence[str]]


def level_values(
    df: DataFrame, column: str, order: Sequence[str] | None = None, max_levels: int = MAX_LEVELS
) -> list[str]:
    """The levels of a categorical predictor that have rows, in ``order`` or else alphabetically.

    Levels become model columns, so a column with more than ``max_levels`` is refused, as is a
    level that ``order`` does not name.
    """
    rows = df.filter(F.col(column).isNotNull()).select(column).distinct().limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels")
    found = {r[0] for r in rows}
    if order is None:
        return sorted(found)
    if unknown := found.difference(order):
        raise ValueError(f"{column} has levels without a place: {sorted(unknown)}")
    return [level for level in order if level in found]


def contrast_name(column: str, position: int) -> str:
    return f"{column}_{position}"


def dummy_name(column: str, level: str) -> str:
    # A dot would read as a field access in a column name.
    return f"{column}_{level}".replace(".", "_")


def sum_contrasts(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """Add sum-to-zero columns: 1 for the own level, -1 for the last level, else 0; NULL for NULL."""
    c = F.col(column)
    coded = [
        F.when(c == level, 1).when(c == levels[-1], -1).when(c.isNotNull(), 0).alias(contrast_name(column, i))
        for i, level in enumerate(levels[:-1], 1)
    ]
    return df.select("*", *coded)


def dummies(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """Add a 0/1 column for every level but the first, which is the baseline; NULL for NULL."""
    c = F.col(column)
    coded = [F.when(c == level, 1).when(c.isNotNull(), 0).alias(dummy_name(column, level)) for level in levels[1:]]
    return df.select("*", *coded)


def covariate_patterns(df: DataFrame, outcome: str, predictors: Sequence[str]) -> DataFrame:
    """Complete rows folded to distinct covariate patterns and outcome, with their number.

    The likelihood depends on nothing else, so a fit reads patterns instead of persons.
    """
    return df.select(outcome, *predictors).dropna().groupBy(outcome, *predictors).agg(F.count("*").alias("weight"))


@dataclass(frozen=True)
class Design:
    """Predictors of a model: numeric as they are, dummy coded and sum coded ones with levels."""

    outcome: str
    numeric: tuple[str, ...]
    dummy: Mapping[str, Sequence[str]]
    summed: Mapping[str, Sequence[str]]

    @property
    def predictors(self) -> list[str]:
        return [*self.numeric, *self.dummy, *self.summed]

    @property
    def terms(self) -> list[str]:
        out = list(self.numeric)
        for c, levels in self.dummy.items():
            out += [dummy_name(c, level) for level in levels[1:]]
        for c, levels in self.summed.items():
            out += [contrast_name(c, i) for i in range(1, len(levels))]
        return out

    def frame(self, df: DataFrame) -> DataFrame:
        """Weighted patterns with one column per term added."""
        out = covariate_patterns(df, self.outcome, self.predictors)
        for c, levels in self.dummy.items():
            out = dummies(out, c, levels)
        for c, levels in self.summed.items():
            out = sum_contrasts(out, c, levels)
        return out.withColumns({"label": F.col(self.outcome).cast("double"), "weight": F.col("weight").cast("double")})


def design(
    df: DataFrame,
    outcome: str,
    numeric: Sequence[str] = (),
    dummy: Levels = (),
    summed: Levels = (),
    max_levels: int = MAX_LEVELS,
) -> Design:
    """A design whose levels are those present in complete rows.

    A level without rows would make a term redundant, as happens in subgroups. ``dummy`` and
    ``summed`` name columns, whose levels are then in alphabetical order, or map columns to their
    ordered levels: the first dummy level is the baseline, the last summed level the one coded -1.
    """
    used = df.select(outcome, *numeric, *dummy, *summed).dropna()

    def levels(columns: Levels) -> dict[str, list[str]]:
        orders = columns if isinstance(columns, Mapping) else dict.fromkeys(columns)
        return {c: level_values(used, c, order, max_levels) for c, order in orders.items()}

    return Design(outcome, tuple(numeric), levels(dummy), levels(summed))


def independent_terms(rows: DataFrame, terms: Sequence[str], tolerance: float = 1e-8) -> list[str]:
    """Terms that are not a linear combination of the intercept and the terms before them.

    A constant term goes first. The others are read off their correlation matrix, which Spark
    computes over the patterns: a term goes when nothing of its variance is left once the kept
    ones are accounted for.
    """
    spread = rows.agg(*[(F.max(t) > F.min(t)).alias(t) for t in terms]).first()
    varying = [t for t in terms if spread[t]]
    if not varying:
        return []
    vectors = VectorAssembler(inputCols=varying, outputCol="features").transform(rows)
    left = Correlation.corr(vectors, "features").head()[0].toArray()
    kept = []
    for i, term in enumerate(varying):
        if left[i, i] > tolerance:
            kept.append(term)
            left = left - np.outer(left[:, i], left[i]) / left[i, i]
    return kept


def fit_terms(
    rows: DataFrame, terms: Sequence[str], offset: str | None = None, unit: float = 1.0
) -> GeneralizedLinearRegressionModel:
    """Unregularised logistic fit of weighted rows, with weights in units of ``unit``.

    The unit leaves the coefficients as they are and multiplies standard errors by its root. It should be about the
    largest weight: the iterations start at log-odds of log(1 + 2 * weight) either way, and from far out they run away.
    """
    if not terms:
        raise ValueError("no predictor varies")
    weighted = rows.withColumn("weight", F.col("weight") / unit)
    vectors = VectorAssembler(inputCols=list(terms), outputCol="features").transform(weighted)
    glm = GeneralizedLinearRegression(
        family="binomial", link="logit", regParam=0.0, weightCol="weight", labelCol="label",
        tol=1e-8, maxIter=MAX_ITERATIONS,
    )
    if offset is not None:
        glm = glm.setOffsetCol(offset)
    return glm.fit(vectors)


@dataclass(frozen=True)
class Fit:
    """A fit of ``terms`` on ``rows``: all patterns, or those that no separation decides.

    ``model`` is None where no term varies in these rows; ``level`` is then the logit of their outcome, if it has one.
    ``unit`` is that of the model's weights.
    """

    rows: DataFrame
    terms: list[str]
    model: GeneralizedLinearRegressionModel | None
    apart: Separation
    rank: int
    level: float | None = None
    unit: float = 1.0

    @property
    def estimates(self) -> dict[str, float]:
        if self.model is None:
            return {} if self.level is None else {INTERCEPT: self.level}
        return dict(zip([*self.terms, INTERCEPT], [*self.model.coefficients.toArray().tolist(), self.model.intercept]))

    @property
    def converged(self) -> bool:
        return self.model is None or self.model.summary.numIterations < MAX_ITERATIONS

    def errors(self) -> dict[str, float]:
        """Standard errors; none where the fit has no information matrix to invert."""
        if self.model is None:
            if self.level is None:
                return {}
            return {INTERCEPT: 1 / sqrt(_moments(self.rows, [], np.array([[self.level]]))[0][2][0, 0])}
        try:
            # The model summary lists the intercept after the terms.
            errors = [e / sqrt(self.unit) for e in self.model.summary.coefficientStandardErrors]
            return dict(zip([*self.terms, INTERCEPT], errors))
        except UnsupportedOperationException:
            return {}


def fit_rows(rows: DataFrame, terms: Sequence[str]) -> Fit:
    """Fit weighted patterns, which should be cached.

    A fit that ends without convergence or standard errors is tested for separation. If outcomes separate, the
    coefficients that have no finite estimate are found, and the others come from the rows that no
    separating direction decides, where the likelihood has its maximum in the limit.
    """
    independent = independent_terms(rows, terms)
    unit = rows.agg(F.max("weight")).first()[0]
    model = fit_terms(rows, independent, unit=unit)
    first = Fit(rows, independent, model, Separation(), len(independent) + 1, unit=unit)
    if first.converged and first.errors():
        return first
    apart = find_separation(rows, independent, _moments, INTERCEPT)
    if not apart.directions:
        return first
    left = rows.filter(~apart.decides())
    if left.isEmpty():
        return Fit(left, [], None, apart, first.rank)
    rest = independent_terms(left, independent)
    if rest:
        return Fit(left, rest, fit_terms(left, rest, unit=unit), apart, first.rank, unit=unit)
    share = left.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).first()[0]
    return Fit(left, [], None, apart, first.rank, log(share / (1 - share)))


def fitted_outcome(df: DataFrame, design_: Design) -> DataFrame:
    """Covariate patterns with their weight and the outcome probability a fit gives them.

    Patterns that a separation decides have the probability 0 or 1 of their outcome. The patterns are cached
    for the fit only.
    """
    rows = design_.frame(df).persist()
    try:
        if rows.isEmpty():
            return design_.frame(df).withColumn("fitted", F.lit(None).cast("double"))
        fit = fit_rows(rows, design_.terms)
    finally:
        rows.unpersist()
    patterns = design_.frame(df)
    if fit.model is None:
        free = F.lit(None if fit.level is None else 1 / (1 + exp(-fit.level))).cast("double")
        return patterns.withColumn("fitted", F.when(fit.apart.decides(), F.col("label")).otherwise(free))
    vectors = VectorAssembler(inputCols=fit.terms, outputCol="features").transform(patterns)
    fitted = F.when(fit.apart.decides(), F.col("label")).otherwise(F.col("prediction"))
    return fit.model.transform(vectors).withColumn("fitted", fitted).drop("prediction")


@dataclass(frozen=True)
class Coefficient:
    term: str
    estimate: float | None = None
    std_error: float | None = None
    z_value: float | None = None
    p_value: float | None = None
    ci_lower: float | None = None
    ci_upper: float | None = None
    interval: str | None = None
    converged: bool = True
    separated: bool = False


COEFFICIENT_SCHEMA = (
    "term string, estimate double, std_error double, z_value double, p_value double, "
    "ci_lower double, ci_upper double, interval string, converged boolean, separated boolean"
)


def _wald(fit: Fit, terms: Sequence[str]) -> list[Coefficient]:
    """Intercept and terms with Wald limits; a term that was not fitted or is infinite has none of them."""
    estimates, errors, converged = fit.estimates, fit.errors(), fit.converged
    out = []
    for term in [INTERCEPT, *terms]:
        b, se = estimates.get(term), errors.get(term)
        if term in fit.apart.infinite:
            out.append(Coefficient(term, converged=converged, separated=True))
        elif b is None or not se:
            out.append(Coefficient(term, b, converged=converged))
        else:
            z = b / se
            out.append(
                Coefficient(term, b, se, z, normal_two_sided(z), b - Z_95 * se, b + Z_95 * se, "wald", converged)
            )
    return out


def _moments(rows: DataFrame, terms: Sequence[str], points: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Log-likelihood, gradient and information at each point (a row: the terms, then the intercept).

    One pass over the patterns for all points: tasks add up their sums, which are added by
    position, so what arrives is one number per sum.
    """
    n, size = points.shape

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n, 1 + size + size * size))
        for frame in frames:
            x = np.column_stack([frame[list(terms)].to_numpy(float), np.ones(len(frame))])
            y, w = frame["label"].to_numpy(), frame["weight"].to_numpy()
            for i, point in enumerate(points):
                eta = x @ point
                fitted = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
                spread = w * fitted * (1 - fitted)
                total[i, 0] += w @ (y * eta - np.logaddexp(0, eta))
                total[i, 1 : 1 + size] += x.T @ (w * (y - fitted))
                total[i, 1 + size :] += ((x.T * spread) @ x).ravel()
        yield pd.DataFrame({"at": np.arange(total.size), "value": total.ravel()})

    used = rows.select(*[F.col(t).cast("double").alias(t) for t in terms], "label", "weight")
    sums = used.mapInPandas(add, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.zeros(n * (1 + size + size * size))
    for r in sums.collect():
        flat[r["at"]] = r["value"]
    out = flat.reshape(n, -1)
    return [(o[0], o[1 : 1 + size], o[1 + size :].reshape(size, size)) for o in out]


@dataclass(frozen=True)
class ProfileEnd:
    """A limit of a term: the point (terms, then the intercept) where the constrained likelihood has fallen far enough."""

    term: str
    side: str
    reached: bool
    limit: float
    point: tuple[float, ...]


def profile_ends(
    rows: DataFrame, terms: Sequence[str], estimates: Sequence[float], wanted: Sequence[str]
) -> list[ProfileEnd]:
    """Where the deviance, with the term held fixed and the rest refitted, has risen by the 95 % quantile.

    Both ends of all terms are sought together. An end is a point where the log-likelihood is
    lower by half the quantile and has no slope in the other terms; Newton steps on these
    equations start from the Wald limit, and a step that does not come nearer is halved. Each
    step of all ends is one pass. An end may not be reached within ``MAX_PROFILE_STEPS``.
    """
    centre = np.array(estimates, float)
    best, _, information = _moments(rows, terms, centre[None])[0]
    cov = np.linalg.inv(information)
    errors = np.sqrt(np.diag(cov))
    ends = [(terms.index(t), sign) for t in wanted for sign in (-1, 1)]
    points = np.array([centre + sign * sqrt(CHI2_95) * cov[:, j] / errors[j] for j, sign in ends])
    known: list[tuple | None] = [None] * len(ends)
    reached = [False] * len(ends)
    trial = points.copy()
    for _ in range(MAX_PROFILE_STEPS):
        open_ = [i for i, done in enumerate(reached) if not done]
        if not open_:
            break
        for i, (level, slope, info) in zip(open_, _moments(rows, terms, trial[open_]), strict=True):
            j, sign = ends[i]
            others = np.arange(len(centre)) != j
            gap = level - best + CHI2_95 / 2
            off = max(abs(gap), float(np.abs(slope[others] * errors[others]).max(initial=0.0)))
            if known[i] is not None and not off < known[i][0]:
                trial[i] = (trial[i] + points[i]) / 2
                continue
            points[i], known[i] = trial[i], (off,)
            reached[i] = off < PROFILE_TOLERANCE
            system = np.vstack([slope, -info[others]])
            try:
                step = np.linalg.solve(system, np.append(gap, slope[others]))
            except np.linalg.LinAlgError:
                continue
            trial[i] = points[i] - step
            if sign * (trial[i][j] - centre[j]) <= 0:  # across the estimate lies the other end
                trial[i] = (points[i] + centre) / 2
    return [
        ProfileEnd(terms[j], "upper" if sign > 0 else "lower", done, float(point[j]), tuple(point.tolist()))
        for (j, sign), done, point in zip(ends, reached, points, strict=True)
    ]


def _profile_limits(
    rows: DataFrame, terms: Sequence[str], estimates: Sequence[float], wanted: Sequence[str]
) -> dict[str, tuple[float | None, float | None]]:
    """(lower, upper) by term; a limit that was not reached is None."""
    found = {(e.term, e.side): e.limit if e.reached else None for e in profile_ends(rows, terms, estimates, wanted)}
    return {t: (found[t, "lower"], found[t, "upper"]) for t in wanted}


def profile_certificate(df: DataFrame, design_: Design) -> DataFrame:
    """(term, side, limit, reached, beyond, deviance_rise, steepest): the profile limits of a fit, evaluated anew.

    The likelihood and its slopes are added up from the patterns by column expressions, apart from the search
    that found the limits. At a limit ``deviance_rise`` is the 95 % quantile of chi-squared and ``steepest``, the largest slope
    in another term (in units of its standard error), is 0: then the rest is at its constrained maximum, and since
    the likelihood is concave the limit is the profile's. ``beyond`` tells whether it lies on its side of the estimate. Separated
    terms have no limits and no rows.
    """
    spark = df.sparkSession
    schema = "term string, side string, limit double, reached boolean, beyond boolean, deviance_rise double, steepest double"
    rows = design_.frame(df).persist()
    try:
        fit = None if rows.isEmpty() else fit_rows(rows, design_.terms)
        errors = {} if fit is None else fit.errors()
        wanted = [t for t in ([] if fit is None else fit.terms) if errors.get(t) and t not in fit.apart.infinite]
        if not wanted:
            return spark.createDataFrame([], schema)
        centre = list(fit.estimates.values())
        ends = profile_ends(fit.rows, fit.terms, centre, wanted)
        points = [centre, *(e.point for e in ends)]
        names = [*fit.terms, INTERCEPT]
        eta = F.array(*[predictor(fit.terms, p) for p in points])
        each = fit.rows.select("label", "weight", *fit.terms, F.lit(1.0).alias(INTERCEPT), F.posexplode(eta).alias("at", "eta"))
        # log(1 + exp(eta)) without overflow
        level = F.col("label") * F.col("eta") - F.greatest("eta", F.lit(0.0)) - F.log1p(F.exp(-F.abs("eta")))
        residual = F.col("weight") * (F.col("label") - 1 / (1 + F.exp(-F.col("eta"))))
        slopes = [F.sum(residual * F.col(f"`{n}`")).alias(f"slope_{i}") for i, n in enumerate(names)]
        found = {r["at"]: r for r in each.groupBy("at").agg(F.sum(F.col("weight") * level).alias("level"), *slopes).collect()}
    finally:
        rows.unpersist()
    out = []
    for i, end in enumerate(ends, 1):
        steep = [abs(found[i][f"slope_{k}"]) * errors[n] for k, n in enumerate(names) if n != end.term]
        side = end.limit > fit.estimates[end.term] if end.side == "upper" else end.limit < fit.estimates[end.term]
        rise = 2 * (found[0]["level"] - found[i]["level"])
        out.append((end.term, end.side, end.limit, bool(end.reached), bool(side), rise, max(steep, default=0.0)))
    return spark.createDataFrame(out, schema)


def fit_logistic(
    df: DataFrame, design_: Design, *, interval: str = "wald", profiled: Sequence[str] | None = None
) -> list[Coefficient]:
    """Coefficients of a logistic regression, intercept first.

    ``interval="profile"`` replaces the Wald limits of the ``profiled`` terms (all but the
    intercept if not given) by profile-likelihood limits; a limit that was not found is None.
    ``interval`` in the result tells them apart, ``converged`` whether the fit itself has. Where the outcomes separate,
    coefficients without a finite estimate are ``separated`` and have no figures (see :func:`fit_rows`).
    """
    rows = design_.frame(df).persist()
    try:
        if rows.isEmpty():
            return []
        fit = fit_rows(rows, design_.terms)
        table = _wald(fit, design_.terms)
        if interval == "wald":
            return table
        wanted = [
            c.term for c in table if c.std_error and c.term != INTERCEPT and (profiled is None or c.term in profiled)
        ]
        limits = _profile_limits(fit.rows, fit.terms, list(fit.estimates.values()), wanted) if wanted else {}
        return [
            replace(c, ci_lower=limits[c.term][0], ci_upper=limits[c.term][1], interval="profile")
            if c.term in limits
            else c
            for c in table
        ]
    finally:
        rows.unpersist()


@dataclass(frozen=True)
class FitSummary:
    n: int
    terms: int
    null_deviance: float
    deviance: float
    aic: float


def fit_summary(df: DataFrame, design_: Design) -> FitSummary:
    """Rows used, terms estimated (the intercept included), deviances and AIC of a fit.

    Rows that a separation decides add nothing to the deviance in the limit; their terms count.
    """
    rows = design_.frame(df).persist()
    try:
        fit = fit_rows(rows, design_.terms)
        whole = rows.agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("treated")).first()
        share = whole.treated / whole.n
        null = -2 * sum(n * log(p) for n, p in ((whole.treated, share), (whole.n - whole.treated, 1 - share)) if n)
        point = np.array([list(fit.estimates.values())])
        deviance = -2 * _moments(fit.rows, fit.terms, point)[0][0] if point.size else 0.0
        return FitSummary(int(whole.n), fit.rank, null, deviance, deviance + 2 * fit.rank)
    finally:
        rows.unpersist()


def coefficient_frame(spark, table: Sequence[Coefficient]) -> DataFrame:
    """The coefficient table with odds ratios; one row per model term."""
    return spark.createDataFrame([astuple(c) for c in table], COEFFICIENT_SCHEMA).withColumn("odds_ratio", F.exp("estimate"))


def odds_ratio(estimate: float) -> float:
    return exp(estimate)


def fit_by_group(
    df: DataFrame,
    flags: Sequence[str],
    outcome: str,
    numeric: Sequence[str] = (),
    dummy: Levels = (),
    summed: Levels = (),
) -> dict[str, list[Coefficient]]:
    """The same model on each subgroup with the flag set, with the levels the subgroup has."""
    out = {}
    for flag in flags:
        part = df.filter(F.col(flag) == 1)
        out[flag] = fit_logistic(part, design(part, outcome, numeric, dummy, summed))
    return out


def plot_table(table: Sequence[Coefficient], column: str, labels: Sequence[str]) -> list[dict]:
    """Rows of a coefficient plot: no intercept, contrasts named by level, significance at 5 %.

    Raises when the number of contrasts of ``column`` is not one less than its labels.
    """
    names = {contrast_name(column, i): label for i, label in enumerate(labels[:-1], 1)}
    contrasts = [c.term for c in table if c.term.startswith(f"{column}_")]
    if len(contrasts) != len(labels) - 1:
        raise ValueError(f"{column} has {len(contrasts)} contrasts, expected {len(labels) - 1}")
    return [
        {
            "group": f"{names[c.term]} vs {column} grand mean" if c.term in names else c.term,
            "coefficient": c.estimate,
            "lower": c.ci_lower,
            "upper": c.ci_upper,
            "significant": c.p_value is not None and c.p_value < 0.05,
        }
        for c in table
        if c.term != INTERCEPT
    ]


def crosstab_cells(df: DataFrame, predictors: Sequence[str], target: str) -> DataFrame:
    """Counts by predictor, level and outcome for all predictors in one pass; NULLs left out."""
    text = df.select(F.col(target).cast("string").alias("outcome"), *[F.col(p).cast("string").alias(p) for p in predictors])
    cells = text.unpivot(["outcome"], list(predictors), "predictor", "level")
    cells = cells.filter(F.col("outcome").isNotNull() & F.col("level").isNotNull())
    return cells.groupBy("predictor", "level", "outcome").agg(F.count("*").alias("n"))


def chi_squared(cells: DataFrame, correct: bool = True) -> DataFrame:
    """Chi-squared statistic and degrees of freedom per predictor from its cells.

    A table with one level or one outcome has nothing to be independent of; as in R's test, its counts are then
    tested for being equal (goodness of fit, one degree less than counts). With a single count there is no
    test: the statistic is NULL, the degrees of freedom are 0.

    A cell without rows is absent and contributes its expected count; over all cells these sum
    to the total, so the absent ones make up what the present ones leave. In a two-by-two table
    every cell is equally far from its expected count, so the continuity correction is a factor
    on the whole statistic. All of this runs on finished counts.
    """
    sized = cells.select(
        "*",
        F.sum("n").over(W.partitionBy("predictor", "level")).alias("row_n"),
        F.sum("n").over(W.partitionBy("predictor", "outcome")).alias("col_n"),
        F.sum("n").over(W.partitionBy("predictor")).alias("total"),
    )
    expected = F.col("row_n") * F.col("col_n") / F.col("total")
    gap = F.abs(F.col("n") - F.col("expected"))
    per = sized.withColumn("expected", expected).groupBy("predictor").agg(
        F.sum(gap * gap / F.col("expected")).alias("present"),
        (F.max("total") - F.sum("expected")).alias("absent"),
        F.max(gap).alias("gap"),
        F.countDistinct("level").alias("rows"),
        F.countDistinct("outcome").alias("cols"),
        F.max("total").alias("total"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    )
    plain = F.col("present") + F.col("absent")
    shrink = F.pow(F.greatest(F.col("gap") - 0.5, F.lit(0.0)) / F.col("gap"), F.lit(2.0))
    two_by_two = (F.col("rows") == 2) & (F.col("cols") == 2) & (F.col("gap") > 0) & F.lit(correct)
    counts = F.col("rows") * F.col("cols")
    line = (F.col("rows") == 1) | (F.col("cols") == 1)
    even = F.when(counts > 1, F.col("squares") * counts / F.col("total") - F.col("total"))
    return per.select(
        "predictor",
        F.when(line, even).when(two_by_two, plain * shrink).otherwise(plain).alias("statistic"),
        F.when(line, counts - 1).otherwise((F.col("rows") - 1) * (F.col("cols") - 1)).cast("int").alias("df"),
    )


def crosstab_test(df: DataFrame, predictors: Sequence[str], target: str, correct: bool = True) -> DataFrame:
    """Chi-squared test of each predictor against the outcome."""
    tested = chi_squared(crosstab_cells(df, predictors, target), correct)
    return tested.withColumn("p_value", chi_squared_tail(F.col("statistic"), F.col("df")))
