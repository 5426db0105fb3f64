"""Descriptive statistics: percentiles, imputation, histograms, box statistics, table 1."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexday.operators.selection import order_statistics
from indexday.operators.sizing import BROADCAST_BYTES, is_small
from indexday.sources import StageStore

# Rank error of percentile_approx is at most rows / ACCURACY.
ACCURACY = 10_000


def _counts_by_value(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_freq"))


def _snap(df: DataFrame, by: Sequence[str], value: str, points: Sequence[float], large: int) -> DataFrame:
    """Move values that cannot be near a wanted rank onto the end of the bracket below or above.

    The brackets come from a mergeable sketch whose rank error is bounded, so each holds the
    wanted rank and a few ten-thousandths of the rows. The move keeps the order, so every order
    statistic inside a bracket stays what it was, while the number of distinct values left no
    longer grows with the column. Groups of up to ``large`` rows stay as they are.
    """
    margin = 3 / ACCURACY
    edges = sorted({min(max(p + d, 0.0), 1.0) for p in points for d in (-margin, margin)})
    sketch = F.percentile_approx(value, F.array(*[F.lit(e) for e in edges]), ACCURACY)
    ends = df.groupBy(*by).agg(sketch.alias("_edges"), F.count(value).alias("_n"))
    if by:
        # Few groups, as strata are, spare the rows a shuffle by group. A row of ends takes some
        # ten times the bytes of its keys.
        if is_small(df.select(*by).distinct(), BROADCAST_BYTES // 10):
            ends = F.broadcast(ends)
        on = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in by]
        both = df.alias("_l").join(ends.alias("_r"), on).select("_l.*", "_edges", "_n")
    else:
        one = ends.select(F.struct("_edges", "_n").alias("_s"))
        both = df.withColumn("_s", one.scalar()).select("*", "_s.*").drop("_s")
    v = F.col(value)
    at = {e: F.get("_edges", F.lit(i)) for i, e in enumerate(edges)}
    snapped: Column | None = None
    for p in sorted(points):
        lo, hi = at[min(max(p - margin, 0.0), 1.0)], at[min(max(p + margin, 0.0), 1.0)]
        # Below a bracket: its lower end. Inside: unchanged.
        step = F.when(v < lo, lo).when(v <= hi, v)
        snapped = step if snapped is None else snapped.when(v < lo, lo).when(v <= hi, v)
        last = hi
    return both.withColumn(value, F.when(F.col("_n") <= large, v).otherwise(snapped.otherwise(last))).drop("_edges", "_n")


def percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    points: Sequence[float],
    names: Sequence[str],
    *,
    discrete: bool = False,
    large: int = 1_000_000,
) -> DataFrame:
    """Exact interpolated percentiles per group, NULLs left out.

    Values are counted first, so a task that ends a group holds its distinct values, not its
    rows. All values that are not near a wanted rank are folded away before, since the distinct
    values of a measure grow with the data; the result is the same. ``discrete`` says that they
    do not, as those of ages, scores and day counts, and spares the passes that fold.
    """
    df = df.select(*by, value)
    if not discrete:
        df = _snap(df.filter(F.col(value).isNotNull()), by, value, points, large)
    wanted = F.array(*[F.lit(float(p)) for p in points])
    out = _counts_by_value(df, by, value).groupBy(*by).agg(F.percentile(value, wanted, F.col("_freq")).alias("_p"))
    return out.select(*by, *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)])


def median(df: DataFrame, value: str, name: str = "median", *, discrete: bool = False) -> DataFrame:
    """Exact median as one row; NULL when there is no value."""
    return percentiles(df, [], value, [0.5], [name], discrete=discrete)


def impute_median(df: DataFrame, column: str, *, discrete: bool = False) -> DataFrame:
    """Replace NULLs by the column's median, which enters the plan as a scalar subquery."""
    middle = median(df, column, discrete=discrete)
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), middle.scalar()))


def histogram(
    df: DataFrame, column: str, width: float, origin: float | None = None, *, closed: str = "left", name: str = "n"
) -> DataFrame:
    """Rows per bin of a fixed width, empty bins left out.

    With an ``origin`` bins run on from it on both sides, closed to the left or right. Without
    one the first bin starts at the smallest value and the last one includes the largest.
    """
    rows = df.filter(F.col(column).isNotNull())
    x = F.col(column).cast("double")
    if origin is not None:
        place = (x - F.lit(float(origin))) / F.lit(float(width))
        bin_no = F.floor(place) if closed == "left" else F.ceil(place) - 1
        counts = rows.groupBy(bin_no.cast("long").alias("bin")).agg(F.count("*").alias(name))
        return counts.select("bin", (F.lit(float(origin)) + F.col("bin") * float(width)).alias("bin_start"), name)
    ends = rows.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("ends"))
    placed = rows.select(x.alias("_x")).withColumn("_ends", ends.scalar())
    lo, hi = F.col("_ends.lo"), F.col("_ends.hi")
    last = F.greatest(F.ceil((hi - lo) / width) - 1, F.lit(0))
    bin_no = F.least(F.floor((F.col("_x") - lo) / width), last).cast("long")
    counts = placed.select(bin_no.alias("bin"), lo.alias("_lo")).groupBy("bin", "_lo").agg(F.count("*").alias(name))
    return counts.select("bin", (F.col("_lo") + F.col("bin") * float(width)).alias("bin_start"), name)


def box_stats(df: DataFrame, column: str, *, reach: float = 1.5, discrete: bool = False) -> DataFrame:
    """Five-number summary, whisker ends and number of values beyond them, as one row.

    A whisker ends at the most extreme value within ``reach`` interquartile ranges of the box.
    """
    names = ["min", "q1", "median", "q3", "max"]
    five = percentiles(df, [], column, [0, 0.25, 0.5, 0.75, 1], names, discrete=discrete)
    values = df.select(F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    boxed = values.withColumn("_b", five.select(F.struct(*names).alias("b")).scalar())
    spread = (F.col("_b.q3") - F.col("_b.q1")) * reach
    inside = F.col("_v").between(F.col("_b.q1") - spread, F.col("_b.q3") + spread)
    return boxed.agg(
        F.count("*").alias("n"),
        *[F.max(f"_b.{n}").alias(n) for n in names],
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def category_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def summarize_continuous(
    df: DataFrame, stratum: str, columns: Sequence[str], *, discrete: Sequence[str] = (), store: StageStore | None = None
) -> DataFrame:
    """Count, mean, SD, median, range and missing count per stratum and variable.

    With a ``store`` the medians of all variables are selected by rank in one pass over written ranges, so that no
    task ends a stratum alone. ``discrete`` names the variables whose distinct values do not grow with the data, which can do
    without."""
    moments = []
    for c in columns:
        x = F.col(c).cast("double")
        moments.append(
            F.struct(
                F.count(x).alias("n"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("sd"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
                F.count_if(x.isNull()).alias("missing"),
            ).alias(c)
        )
    wide = df.groupBy(stratum).agg(*moments)
    tidy = wide.unpivot([stratum], list(columns), "variable", "_m").select(stratum, "variable", "_m.*")
    if store is not None:
        middle = order_statistics(df, [stratum], columns, [0.5], ["median"], store)
        return _beside(tidy, middle, stratum)
    counted = [c for c in columns if c in discrete]
    parts = []
    if counted:
        values = df.select(stratum, *[F.col(c).cast("double").alias(c) for c in counted])
        values = values.unpivot([stratum], counted, "variable", "_v")
        parts.append(percentiles(values, [stratum, "variable"], "_v", [0.5], ["median"], discrete=True))
    for c in columns:
        if c not in discrete:
            values = df.select(stratum, F.lit(c).alias("variable"), F.col(c).cast("double").alias("_v"))
            parts.append(percentiles(values, [stratum, "variable"], "_v", [0.5], ["median"]))
    middle = parts[0]
    for p in parts[1:]:
        middle = middle.unionByName(p)
    return _beside(tidy, middle, stratum)


def _beside(tidy: DataFrame, middle: DataFrame, stratum: str) -> DataFrame:
    same = F.col(f"t.{stratum}").eqNullSafe(F.col(f"m.{stratum}")) & (F.col("t.variable") == F.col("m.variable"))
    return tidy.alias("t").join(middle.alias("m"), same, "left").select("t.*", "m.median")


def summarize_categorical(df: DataFrame, stratum: str, columns: Sequence[str]) -> DataFrame:
    """Count and percentage of each level per stratum and variable.

    A NULL level counts the missing values; percentages are of all rows of the stratum.
    """
    text = df.select(stratum, *[F.col(c).cast("string").alias(c) for c in columns])
    counts = text.unpivot([stratum], list(columns), "variable", "level").groupBy(stratum, "variable", "level")
    counted = counts.agg(F.count("*").alias("n"))
    # The window runs over finished counts: one row per level.
    whole = F.sum("n").over(W.partitionBy(stratum, "variable"))
    return counted.withColumn("pct", 100.0 * F.col("n") / whole)


def table_one(
    df: DataFrame,
    stratum: str,
    categorical: Sequence[str] = (),
    continuous: Sequence[str] = (),
    labels: Mapping[str, str] | None = None,
    discrete: Sequence[str] = (),
    store: StageStore | None = None,
) -> DataFrame:
    """Stratified summary in long form: a row per level of a categorical variable, and a row per
    continuous variable, with a readable label for each. ``discrete`` and ``store`` are as in
    :func:`summarize_continuous`."""
    names = F.create_map(*[F.lit(x) for kv in (labels or {}).items() for x in kv]) if labels else None
    parts = []
    if categorical:
        parts.append(summarize_categorical(df, stratum, categorical))
    if continuous:
        parts.append(summarize_continuous(df, stratum, continuous, discrete=discrete, store=store))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    label = F.col("variable") if names is None else F.coalesce(names[F.col("variable")], F.col("variable"))
    return out.withColumn("label", label)
