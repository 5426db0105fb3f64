"""Flags, outcome, scores and coverage measured around each cohort row's index date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexday.functions import (
    categorize,
    days_between,
    in_window,
    threshold_label,
    year_age,
)
from indexday.operators.concepts import tag_by_ids, tag_by_map
from indexday.operators.intervals import points_in_intervals
from indexday.operators.sizing import is_small
from indexday.spec import CategoryRule, CodeGroup, CodeSet

SUBJECT = "subject_id"
INDEX = "cohort_start_date"


def _attach(cohort: DataFrame, per_person: DataFrame, person: str) -> DataFrame:
    """Left join a frame with one row per person to the cohort."""
    return cohort.join(per_person.withColumnRenamed(person, SUBJECT), SUBJECT, "left")


def subject_dates(cohort: DataFrame) -> DataFrame:
    """Each subject once, with its index date; a subject has only one."""
    return cohort.select(SUBJECT, INDEX).dropDuplicates([SUBJECT])


def known_small(cohort: DataFrame) -> DataFrame | None:
    """Subjects and index dates marked for broadcasting, or None unless the plan shows they fit.

    A written cohort has a known size. One that is still to be computed counts as large: to
    measure it would be to compute it.
    """
    if not is_small(cohort.select(SUBJECT, INDEX), measure=False):
        return None
    return F.broadcast(subject_dates(cohort))


def of_subjects(events: DataFrame, cohort: DataFrame, person: str) -> DataFrame:
    """Events of the cohort's subjects if that can be told in the scan's own task, else all.

    Only for use ahead of a join with the cohort: it saves the aggregate between from
    shuffling persons nobody asked for.
    """
    subjects = cohort.select(F.col(SUBJECT).alias(person))
    if not is_small(subjects, measure=False):
        return events
    return events.join(F.broadcast(subjects), person, "left_semi")


def events_in_window(
    cohort: DataFrame,
    events: DataFrame,
    *,
    person: str,
    date: str,
    before: int | None = 0,
    after: int | None = None,
) -> DataFrame:
    """Events of the cohort's subjects whose date lies in a window around their index date.

    ``None`` leaves a side open. A cohort known to be small meets the events in their own task;
    otherwise both shuffle by person and AQE splits the partition of a heavy one.
    """
    spine = known_small(cohort)
    if spine is None:
        spine = subject_dates(cohort)
    day, index = F.col(date), F.col(INDEX)
    near = events.withColumnRenamed(person, SUBJECT).join(spine, SUBJECT)
    if before is not None:
        near = near.filter(day >= F.date_sub(index, before))
    return near if after is None else near.filter(day <= F.date_add(index, after))


def condition_flags(
    cohort: DataFrame,
    events: DataFrame,
    sets: Sequence[CodeSet],
    *,
    person: str = "person_id",
    code: str = "condition_concept_id",
    date: str = "condition_start_date",
    strict: bool = False,
) -> DataFrame:
    """Add a 0/1 column per code set: events on two distinct days, one of them on or after the index.

    The first and last date per person and set answer both questions, so one pass over the
    events serves all sets and no event meets another. ``strict`` asks the first event, not
    just some event, to be on or after the index.
    """
    tagged = of_subjects(tag_by_ids(events.select(person, code, date), code, sets), cohort, person)
    spans = []
    for s in sets:
        day = F.when(F.col(s.name) == 1, F.col(date))
        spans += [F.min(day).alias(f"{s.name}_first"), F.max(day).alias(f"{s.name}_last")]
    flags = []
    for s in sets:
        first, last = F.col(f"{s.name}_first"), F.col(f"{s.name}_last")
        on_time = (first if strict else last) >= F.col(INDEX)
        flags.append(F.when((first < last) & on_time, 1).otherwise(0).alias(s.name))
    return _attach(cohort, tagged.groupBy(person).agg(*spans), person).select(*cohort.columns, *flags)


def outcome_flag(
    cohort: DataFrame,
    procedures: DataFrame,
    codes: Sequence[str],
    *,
    column: str,
    labels: tuple[str, str],
    person: str = "person_id",
    code: str = "procedure_source_value",
    date: str = "procedure_date",
) -> DataFrame:
    """Add a label that tells whether a listed procedure took place on or after the index date.

    Codes are compared as text: a column of billing codes holds letters too. Whether some
    procedure is late enough is known from the latest one, so each person sends one date on.
    """
    listed = of_subjects(procedures.filter(F.col(code).isin(*codes)).select(person, date), cohort, person)
    last = listed.groupBy(person).agg(F.max(date).alias("_last"))
    yes, no = labels
    status = F.when(F.col("_last") >= F.col(INDEX), yes).otherwise(no).alias(column)
    return _attach(cohort, last, person).select(*cohort.columns, status)


def window_flags(
    cohort: DataFrame,
    events: DataFrame,
    mapping: DataFrame,
    groups: Sequence[CodeGroup],
    *,
    person: str = "person_id",
    code: str = "condition_source_concept_id",
    date: str = "condition_start_date",
    subjects: DataFrame | None = None,
) -> DataFrame:
    """Add a 0/1 column per code group: some event of the group inside the group's window.

    One pass over the events for all groups, whatever their windows. With a cohort known to be
    small the events meet it in their own task and fold to one row per person there. Otherwise
    they fold to one row per person and day before the join by person, which bounds what a
    single heavy person can bring to one task. Either way the flags are found per subject and
    joined to the cohort, whose rows all stay, equal ones too. ``subjects`` is a written frame
    that holds all of the cohort's subjects with their index dates, for a cohort that is itself
    still a plan.
    """
    names = [g.name for g in groups]
    hits = tag_by_map(events.select(person, code, date).filter(F.col(date).isNotNull()), code, mapping)
    hits = hits.select(F.col(person).alias(SUBJECT), F.col(date).alias("_day"), *names)

    flags = []
    for g in groups:
        inside = (F.col(g.name) == 1) & in_window("_day", INDEX, g.before, g.after)
        flags.append(F.max(F.when(inside, 1).otherwise(0)).alias(g.name))

    known = cohort if subjects is None else subjects
    spine = known_small(known)
    if spine is None:
        spine = subject_dates(known)
        hits = hits.groupBy(SUBJECT, "_day").agg(*[F.max(n).alias(n) for n in names])
    found = hits.join(spine, SUBJECT).groupBy(SUBJECT).agg(*flags)
    out = cohort.join(found, SUBJECT, "left")
    return out.select(*cohort.columns, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names])


def stay_severity(
    cohort: DataFrame,
    *,
    limit: int = 7,
    labels: tuple[str, str],
    start: str = INDEX,
    end: str = "visit_end_date",
) -> DataFrame:
    """Add the days from the index date to the end of the stay, and their severity class."""
    stay = cohort.withColumn("initial_ip_duration", days_between(start, end))
    return stay.withColumn("severity", threshold_label("initial_ip_duration", limit, *labels))


def demographics(cohort: DataFrame, person: DataFrame) -> DataFrame:
    """Add age in calendar years and gender; NULL for subjects without a person record."""
    who = person.select(F.col("person_id").alias(SUBJECT), "year_of_birth", F.col("gender_source_value").alias("gender"))
    joined = cohort.join(who, SUBJECT, "left")
    age = year_age(INDEX, "year_of_birth").alias("patient_age")
    return joined.select(*cohort.columns, age, "gender")


def coverage_at_index(
    cohort: DataFrame,
    periods: DataFrame,
    rules: Sequence[CategoryRule],
    *,
    person: str = "person_id",
    payer: str = "payer_concept_id",
    value: str = "payer_source_value",
    start: str = "payer_plan_period_start_date",
    end: str = "payer_plan_period_end_date",
) -> DataFrame:
    """Plans active on the index date with their plan class.

    A subject with overlapping plans has a row for each, one without any plan has none.
    """
    plans = periods.select(F.col(person).alias(SUBJECT), value, categorize(rules, payer, value).alias("insurance_plan"), start, end)
    keep = [value, "insurance_plan"]
    covered = points_in_intervals(
        cohort.select(SUBJECT, INDEX), plans, key=SUBJECT, point=INDEX, start=start, end=end, keep=keep
    )
    return covered.select(SUBJECT, *keep)


def comorbidity_score(
    cohort: DataFrame,
    events: DataFrame,
    weights: DataFrame,
    *,
    person: str = "person_id",
    code: str = "condition_concept_id",
    date: str = "condition_start_date",
) -> DataFrame:
    """Sum of the weights of the condition groups found up to the index date.

    ``weights`` maps ``concept_id`` to ``score_group`` and ``weight``; a group counts once, with
    the largest weight found. Subjects without any group have no row. The earliest date per
    person, group and weight says whether it was found in time, so events fold before the join.
    """
    found = of_subjects(tag_by_map(events.select(person, code, date), code, weights), cohort, person)
    first = found.groupBy(F.col(person).alias(SUBJECT), "score_group", "weight").agg(F.min(date).alias("_first"))
    in_time = subject_dates(cohort).join(first, SUBJECT).filter(F.col("_first") <= F.col(INDEX))
    per_group = in_time.groupBy(SUBJECT, "score_group").agg(F.max("weight").alias("weight"))
    return per_group.groupBy(SUBJECT).agg(F.sum("weight").cast("double").alias("score"))


def as_covariates(scores: DataFrame, covariate_id: int, value: str = "score") -> DataFrame:
    """Scores in the keyed covariate format."""
    return scores.select(
        F.col(SUBJECT).alias("rowId"),
        F.lit(covariate_id).cast("long").alias("covariateId"),
        F.col(value).cast("double").alias("covariateValue"),
    )


def weight_map(spark, weights: Mapping[int, tuple[str, int]]) -> DataFrame:
    """A weight table from a plain mapping of concept id to group and weight."""
    rows = [(int(c), str(g), int(w)) for c, (g, w) in weights.items()]
    return spark.createDataFrame(rows, "concept_id long, score_group string, weight int")
