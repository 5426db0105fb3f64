"""Profiles: counts, top lists and utilisation after the index date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexday.functions import relabel
from indexday.operators.features import INDEX, SUBJECT, known_small, of_subjects, subject_dates


def group_counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def by_count(counts: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Largest count first, equal counts by key."""
    return counts.orderBy(F.desc(name), *keys)


def top_k(df: DataFrame, key: str, k: int = 20, name: str = "n") -> DataFrame:
    """The ``k`` keys with the most rows."""
    return by_count(group_counts(df, key, name=name), key, name=name).limit(k)


def distinct_persons(events: DataFrame, person: str = "person_id", name: str = "n_persons") -> DataFrame:
    return events.agg(F.countDistinct(person).alias(name))


def persons_below(events: DataFrame, person: str, limit: int, name: str = "n_persons") -> DataFrame:
    """Number of persons with fewer than ``limit`` events."""
    return group_counts(events, person).filter(F.col("n") < limit).agg(F.count("*").alias(name))


def earliest_rows(events: DataFrame, date: str, tie: Sequence[str], k: int = 100) -> DataFrame:
    """The ``k`` earliest rows in a total order."""
    return events.orderBy(date, *tie).limit(k)


def code_profile(
    events: DataFrame, person_id: int, code: str, concept: DataFrame, *, person: str = "person_id", how: str = "inner"
) -> DataFrame:
    """One person's records by code, with concept names.

    ``how="left"`` keeps codes without a concept. The person is picked at the scan and the
    counts are made before names are looked up.
    """
    counts = group_counts(events.filter(F.col(person) == person_id), code)
    names = concept.select(F.col("concept_id").alias(code), "concept_name")
    return by_count(counts.join(names, code, how), code)


def after_index(cohort: DataFrame, events: DataFrame, *, person: str, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Number of events on or after the index date, by subject and the ``by`` columns.

    A cohort known to be small meets the events in their own task. Otherwise events are counted
    by day ahead of the join, which bounds what one heavy person brings to a task.
    """
    named = events.select(F.col(person).alias(SUBJECT), F.col(date).alias("_day"), *by)
    spine = known_small(cohort)
    if spine is None:
        named = named.groupBy(SUBJECT, "_day", *by).agg(F.count("*").alias("_n"))
        spine = subject_dates(cohort)
    else:
        named = named.withColumn("_n", F.lit(1))
    late = named.join(spine, SUBJECT).filter(F.col("_day") >= F.col(INDEX))
    return late.groupBy(SUBJECT, *by).agg(F.sum("_n").alias("n"))


def utilisation_by_specialty(
    cohort: DataFrame, visits: DataFrame, provider: DataFrame, k: int = 20, unknown: str = "No Specialty"
) -> DataFrame:
    """Provider specialties with the most visits on or after the index date.

    Visits are summed per provider before the provider table is joined.
    """
    with_provider = visits.filter(F.col("provider_id").isNotNull())
    seen = after_index(cohort, with_provider, person="person_id", date="visit_start_date", by=["provider_id"])
    per_provider = seen.groupBy("provider_id").agg(F.sum("n").alias("n"))
    named = per_provider.join(provider.select("provider_id", "specialty_source_value"), "provider_id")
    per_specialty = named.groupBy("specialty_source_value").agg(F.sum("n").alias("n"))
    top = by_count(per_specialty, "specialty_source_value").limit(k)
    return top.withColumn("specialty_source_value", relabel("specialty_source_value", None, unknown))


def services_per_person(cohort: DataFrame, services: DataFrame) -> DataFrame:
    """Number of services on or after the index date, for subjects that have any."""
    return after_index(cohort, services, person="person_id", date="procedure_date")


def service_status(
    cohort: DataFrame, services: DataFrame, flag: str, labels: tuple[str, str] = ("not_null", "null")
) -> DataFrame:
    """Each subject and flag with a label for any or no service on or after the index date."""
    own = of_subjects(services.select("person_id", "procedure_date"), cohort, "person_id")
    last = own.groupBy(F.col("person_id").alias(SUBJECT)).agg(F.max("procedure_date").alias("_last"))
    joined = cohort.select(SUBJECT, INDEX, flag).join(last, SUBJECT, "left")
    some = F.max(F.when(F.col("_last") >= F.col(INDEX), 1).otherwise(0)) == 1
    return joined.groupBy(SUBJECT, flag).agg(F.when(some, labels[0]).otherwise(labels[1]).alias("person_status"))


def service_split(status: DataFrame, flag: str) -> DataFrame:
    """Subjects without and with a service, in all and by flag, as one row."""

    def cell(label: str, value: int | None) -> Column:
        test = F.col("person_status") == label
        return F.count_if(test if value is None else test & (F.col(flag) == value))

    cells = [cell(s, None).alias(f"count_{s}") for s in ("null", "not_null")]
    cells += [cell(s, v).alias(f"count_{s}_{flag}_{v}") for v in (1, 0) for s in ("null", "not_null")]
    return status.agg(*cells)


def service_split_long(split: DataFrame, flag: str, labels: tuple[str, str]) -> DataFrame:
    """The one-row split as rows of status, flag and count."""
    none, some = labels
    cells = [f"count_{s}_{flag}_{v}" for s in ("null", "not_null") for v in (1, 0)]
    tidy = split.unpivot([], cells, "cell", "n")
    return tidy.select(
        F.when(F.col("cell").startswith("count_null_"), none).otherwise(some).alias("status"),
        F.substring_index("cell", "_", -1).cast("int").alias(flag),
        "n",
    )


def discharge_counts(
    cohort: DataFrame, events: DataFrame, visits: DataFrame, concept: DataFrame, relabels: tuple[str, str]
) -> DataFrame:
    """Index events by the place their encounter was discharged to, with names.

    The cohort picks its events first; only those look up their encounter.
    """
    key, encounter, code = "condition_occurrence_id", "visit_occurrence_id", "discharge_to_concept_id"
    picked = events.select(key, encounter).join(cohort.select(key), key)
    counts = group_counts(picked.join(visits.select(encounter, code), encounter), code)
    names = concept.select(F.col("concept_id").alias(code), "concept_name")
    named = counts.join(names, code)
    return by_count(named.withColumn("concept_name", relabel("concept_name", *relabels)), code)


def funnel(*steps: tuple[str, DataFrame, str]) -> DataFrame:
    """Rows and persons that are left after each step, in step order.

    Each step is (name, frame, person column). Give it written stages: it then reads one column
    of each instead of computing the chain again for every step.
    """
    counted = [
        df.agg(F.count("*").alias("n_rows"), F.countDistinct(person).alias("n_persons")).select(
            F.lit(i).alias("step"), F.lit(name).alias("name"), "n_rows", "n_persons"
        )
        for i, (name, df, person) in enumerate(steps, 1)
    ]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out
