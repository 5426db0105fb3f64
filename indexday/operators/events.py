"""Selecting events and finding each person's index event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexday.operators.concepts import in_concepts
from indexday.operators.intervals import points_in_intervals


def qualifying_events(
    events: DataFrame,
    encounters: DataFrame,
    event_codes: DataFrame,
    encounter_codes: DataFrame,
    *,
    code: str = "condition_concept_id",
    encounter_code: str = "visit_concept_id",
    encounter: str = "visit_occurrence_id",
    event_columns: Sequence[str] = (
        "condition_occurrence_id",
        "person_id",
        "condition_concept_id",
        "condition_start_date",
        "condition_end_date",
    ),
    encounter_columns: Sequence[str] = ("visit_start_date", "visit_end_date", "discharge_to_concept_id"),
) -> DataFrame:
    """Events with a code in one set that took place in an encounter with a type in another.

    Both sides are cut down by their code set before they meet, so only matching rows shuffle.
    """
    chosen = in_concepts(events.select(encounter, *event_columns), code, event_codes)
    places = in_concepts(encounters.select(encounter, encounter_code, *encounter_columns), encounter_code, encounter_codes)
    return chosen.join(places.drop(encounter_code), encounter).select(*event_columns, *encounter_columns)


def _earliest(date: str, tie: str, others: Sequence[str]) -> Column:
    """The earliest row as a struct; an aggregate, so each task sends one row per group on."""
    return F.min(F.struct(date, tie, *others))


def index_event(events: DataFrame, person: str, date: str, tie: str) -> DataFrame:
    """Each person's first event, the lowest ``tie`` on that day.

    A plain aggregate: no task ever sorts all the events of one person.
    """
    others = [c for c in events.columns if c not in (person, date, tie)]
    first = (
        events.filter(F.col(date).isNotNull()).groupBy(person).agg(_earliest(date, tie, others).alias("first_event"))
    )
    return first.select(*[F.col(f"first_event.{c}") if c != person else F.col(c) for c in events.columns])


def distinct_days(events: DataFrame, person: str, date: str) -> DataFrame:
    """The days each person has an event on, numbered from the earliest.

    Events are folded to days before the window sees them, so a window partition holds at most
    as many rows as the calendar has days, however many events a person has.
    """
    days = events.filter(F.col(date).isNotNull()).select(person, date).distinct()
    return days.withColumn("day_rank", F.dense_rank().over(W.partitionBy(person).orderBy(date)))


def rank_days(events: DataFrame, person: str, date: str) -> DataFrame:
    """Every event with the number of its day among the person's distinct days."""
    return events.join(distinct_days(events, person, date), [person, date])


def index_with_confirmation(
    events: DataFrame, person: str, date: str, tie: str, count: str | None = None
) -> DataFrame:
    """Each person's first event with the next day that has an event.

    Adds ``second_day`` (NULL if there is none) and, under the name ``count``, the person's
    number of events. Events are first folded to one row per person and day; then only each
    person's two earliest days pass on, which Spark prunes in every task ahead of the exchange
    (window group limit). A count needs all days and forgoes the pruning.
    """
    others = [c for c in events.columns if c not in (person, date, tie)]
    days = (
        events.filter(F.col(date).isNotNull())
        .groupBy(person, date)
        .agg(F.min(F.struct(tie, *others)).alias("first_event"), F.count("*").alias("n"))
    )
    ranked = days.withColumn("day_rank", F.row_number().over(W.partitionBy(person).orderBy(date)))
    if count is None:
        ranked = ranked.filter(F.col("day_rank") <= 2)
    first, second = F.col("day_rank") == 1, F.col("day_rank") == 2
    people = ranked.groupBy(person).agg(
        F.min(F.when(first, F.col(date))).alias("index_day"),
        F.min(F.when(second, F.col(date))).alias("second_day"),
        F.min(F.when(first, F.col("first_event"))).alias("first_event"),
        F.sum("n").alias("n"),
    )
    names = {person: F.col(person), date: F.col("index_day").alias(date)}
    row = [names[c] if c in names else F.col(f"first_event.{c}") for c in events.columns]
    return people.select(*row, "second_day", *([F.col("n").alias(count)] if count else []))


def confirm_within(events: DataFrame, person: str, date: str, tie: str, days: int = 180) -> DataFrame:
    """First events of the persons whose second distinct day follows within ``days`` days."""
    found = index_with_confirmation(events, person, date, tie)
    return found.filter(F.datediff("second_day", date) <= days)


def require_observation(
    index: DataFrame,
    periods: DataFrame,
    *,
    person: str,
    date: str,
    before: int = 180,
    after: int = 180,
    period_person: str = "person_id",
    start: str = "observation_period_start_date",
    end: str = "observation_period_end_date",
    keep: Sequence[str] = ("observation_period_id",),
) -> DataFrame:
    """Index rows with enough observed time on both sides, once per period that gives it.

    That is the index date inside a period shortened on both sides; a period too short for both holds no day.
    """
    out = points_in_intervals(
        index,
        periods.withColumnRenamed(period_person, person),
        key=person,
        point=date,
        start=start,
        end=end,
        keep=[start, end, *keep],
        first=F.date_add(start, before),
        last=F.date_sub(end, after),
    )
    return out.select(person, *[c for c in out.columns if c != person])


def first_day_events(events: DataFrame, person: str, date: str) -> DataFrame:
    """All events on each person's first day, ties included.

    One pass: a rank of 1 is a window group limit, by which each task passes on only the rows that are on a
    person's first day among its own, so the exchange carries little more than the result.
    """
    dated = events.filter(F.col(person).isNotNull() & F.col(date).isNotNull())
    ranked = dated.withColumn("_rank", F.rank().over(W.partitionBy(person).orderBy(date)))
    return ranked.filter(F.col("_rank") == 1).select(person, date, *[c for c in events.columns if c not in (person, date)])
