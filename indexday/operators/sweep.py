"""Windows around many dates of a subject, by one sweep over its days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexday.operators.concepts import tag_by_map
from indexday.operators.features import INDEX, SUBJECT, of_subjects
from indexday.spec import CodeGroup


def flags_around_dates(
    dates: DataFrame,
    events: DataFrame,
    mapping: DataFrame,
    groups: Sequence[CodeGroup],
    *,
    person: str = "person_id",
    code: str = "condition_source_concept_id",
    date: str = "condition_start_date",
) -> DataFrame:
    """(subject, date) with a 0/1 column per code group: some event of the group in the window around the date.

    A subject may have any number of dates. Events, folded to one row per subject and day, and dates are
    put into one order per subject; the last day of a group up to the end of the window, a running maximum over a range of days, then
    tells whether the window holds one. A subject costs its days once, where a join would meet each event with each
    date, and a window partition holds at most two rows per day of the calendar. ``None`` leaves a side of a window open. Equal dates of
    a subject are one row; NULL dates and subjects are left out, as are undated events.
    """
    names = [g.name for g in groups]
    asked = dates.select(SUBJECT, F.col(INDEX).alias("_day")).dropna().distinct().withColumn("_asked", F.lit(True))
    hits = tag_by_map(events.select(person, code, date).filter(F.col(date).isNotNull()), code, mapping)
    hits = of_subjects(hits, asked, person).select(F.col(person).alias(SUBJECT), F.col(date).alias("_day"), *names)
    hits = hits.groupBy(SUBJECT, "_day").agg(*[F.max(n).alias(n) for n in names])
    days = hits.unionByName(asked, allowMissingColumns=True).withColumn("_at", F.unix_date("_day"))
    in_order = W.partitionBy(SUBJECT).orderBy("_at")
    flags = []
    for g in groups:
        ahead = W.unboundedFollowing if g.after is None else g.after
        last = F.max(F.when(F.col(g.name) == 1, F.col("_at"))).over(in_order.rangeBetween(W.unboundedPreceding, ahead))
        inside = last.isNotNull() if g.before is None else last >= F.col("_at") - g.before
        flags.append(F.when(inside, 1).otherwise(0).alias(g.name))
    return days.select(SUBJECT, F.col("_day").alias(INDEX), "_asked", *flags).filter("_asked").drop("_asked")
