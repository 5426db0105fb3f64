"""The study from base relations to the model frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexday.functions import any_flag, categorize, cut, label_to_flag, strip_prefix
from indexday.operators.concepts import code_map, concepts_below, in_concepts
from indexday.operators.describe import impute_median
from indexday.operators.events import (
    confirm_within,
    index_with_confirmation,
    qualifying_events,
    require_observation,
)
from indexday.operators.features import (
    INDEX,
    SUBJECT,
    condition_flags,
    coverage_at_index,
    demographics,
    outcome_flag,
    stay_severity,
    window_flags,
)
from indexday.operators.reshape import to_long
from indexday.sources import StageStore, rows_without_date
from indexday.spec import CohortSpec, ModelSpec, StudySpec

Relations = Mapping[str, DataFrame]

PERSON, DATE, EVENT = "person_id", "condition_start_date", "condition_occurrence_id"


def select_events(spec: CohortSpec, tables: Relations) -> DataFrame:
    """Events with a condition and an encounter type below the study's ancestors."""
    ancestry, concept = tables["concept_ancestor"], tables["concept"]
    return qualifying_events(
        tables["condition_occurrence"],
        tables["visit_occurrence"],
        concepts_below(ancestry, concept, spec.event_ancestors),
        concepts_below(ancestry, concept, spec.encounter_ancestors),
    )


def observed_cohort(spec: CohortSpec, events: DataFrame, tables: Relations) -> DataFrame:
    """Confirmed index events with enough observation time, one row per person and period."""
    index = confirm_within(events, PERSON, DATE, EVENT, spec.confirm_days).drop("second_day")
    observed = require_observation(
        index,
        tables["observation_period"],
        person=PERSON,
        date=DATE,
        before=spec.observed_before,
        after=spec.observed_after,
    )
    return observed.select(
        F.col(PERSON).alias(SUBJECT),
        EVENT,
        "condition_concept_id",
        F.col(DATE).alias(INDEX),
        "condition_end_date",
        F.date_add(DATE, spec.milestone_days).alias("six_months_after_index"),
        "visit_start_date",
        "visit_end_date",
        "discharge_to_concept_id",
        categorize(spec.destinations, "discharge_to_concept_id").alias("discharge_location"),
        "observation_period_start_date",
        F.col("observation_period_end_date").alias("cohort_end_date"),
        "observation_period_id",
    )


def build_cohort(spec: CohortSpec, tables: Relations, events: DataFrame | None = None) -> DataFrame:
    """The cohort with its diagnosis flags; ``events`` is the qualifying stage if already there."""
    if events is None:
        events = select_events(spec, tables)
    cohort = observed_cohort(spec, events, tables)
    flagged = condition_flags(cohort, tables["condition_occurrence"], spec.flag_sets, strict=spec.strict_flags)
    return flagged.select(
        *cohort.columns, *spec.flags, F.lit(spec.definition_id).alias("cohort_definition_id")
    )


def attrition(spec: CohortSpec, tables: Relations) -> DataFrame:
    """Rows and persons left after each step of the cohort definition.

    Two passes over the events give all steps: one counts the events with a listed code, the
    other carries each person's number of qualifying events along the chain to the flags, so
    no step computes the ones before it again.
    """
    ids = concepts_below(tables["concept_ancestor"], tables["concept"], spec.event_ancestors)
    coded = in_concepts(tables["condition_occurrence"], "condition_concept_id", ids)
    first = coded.agg(F.count("*").alias("n_rows"), F.countDistinct(PERSON).alias("n_persons"))
    first = first.select(F.lit(1).alias("step"), F.lit("condition").alias("name"), "n_rows", "n_persons")

    people = index_with_confirmation(select_events(spec, tables), PERSON, DATE, EVENT, count="n_events")
    people = people.select(PERSON, DATE, "second_day", "n_events")
    confirmed = F.coalesce(F.datediff("second_day", DATE) <= spec.confirm_days, F.lit(False))
    people = people.select(
        F.col(PERSON).alias(SUBJECT), F.col(DATE).alias(INDEX), "n_events", confirmed.alias("confirmed")
    )
    periods = tables["observation_period"].select(
        F.col("person_id").alias(SUBJECT), "observation_period_start_date", "observation_period_end_date"
    )
    span = (F.date_add("observation_period_start_date", spec.observed_before) <= F.col(INDEX)) & (
        F.date_add(INDEX, spec.observed_after) <= F.col("observation_period_end_date")
    )
    # Confirmed persons meet their periods; the others stay as one row without any.
    seen = people.join(periods, SUBJECT, "left").groupBy(*people.columns).agg(F.count_if(span).alias("n_periods"))
    flagged = condition_flags(seen, tables["condition_occurrence"], spec.flag_sets, strict=spec.strict_flags)
    rows = F.when(F.col("confirmed"), F.col("n_periods")).otherwise(0)
    target = F.when(any_flag(*spec.flags), F.col("_rows")).otherwise(0)
    counts = flagged.withColumn("_rows", rows).withColumn("_target", target)
    wide = counts.agg(
        F.struct(F.coalesce(F.sum("n_events"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_persons")).alias("encounter"),
        F.struct(F.count_if("confirmed").alias("n_rows"), F.count_if("confirmed").alias("n_persons")).alias("confirmed"),
        F.struct(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"), F.count_if(F.col("_rows") > 0).alias("n_persons")
        ).alias("observed"),
        F.struct(
            F.coalesce(F.sum("_target"), F.lit(0)).alias("n_rows"), F.count_if(F.col("_target") > 0).alias("n_persons")
        ).alias("target"),
    )
    steps = wide.unpivot([], wide.columns, "name", "_c")
    number = F.create_map(*[F.lit(x) for i, n in enumerate(wide.columns, 2) for x in (n, i)])
    rest = steps.select(number[F.col("name")].alias("step"), "name", "_c.n_rows", "_c.n_persons")
    return first.unionByName(rest)


def target_population(cohort: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Cohort rows with at least one flag."""
    return cohort.filter(any_flag(*flags))


def _with_outcome(spec: StudySpec, tables: Relations, cohort: DataFrame) -> DataFrame:
    m = spec.model
    return outcome_flag(
        target_population(cohort, spec.cohort.flags),
        tables["procedure_occurrence"],
        m.procedure_codes,
        column=m.outcome_column,
        labels=m.outcome_labels,
    )


def build_outcome(spec: StudySpec, tables: Relations, cohort: DataFrame) -> DataFrame:
    """Treatment outcome of the target population."""
    return _with_outcome(spec, tables, cohort).select(SUBJECT, spec.model.outcome_column)


def build_features(spec: StudySpec, tables: Relations, cohort: DataFrame) -> DataFrame:
    """Feature matrix of the target population.

    Each step extends the cohort row at hand, so nothing is joined back to the cohort.
    """
    m = spec.model
    mapping = code_map(tables["concept"], m.code_groups)
    rows = _with_outcome(spec, tables, cohort).select(SUBJECT, INDEX, "visit_end_date", m.outcome_column)
    rows = window_flags(rows, tables["condition_occurrence"], mapping, m.code_groups, subjects=cohort)
    rows = stay_severity(rows, limit=m.severity_days, labels=m.severity_labels)
    rows = demographics(rows, tables["person"])
    return rows.select(
        SUBJECT, m.outcome_column, *m.features, "initial_ip_duration", "severity", "patient_age", "gender"
    )


def build_coverage(spec: StudySpec, tables: Relations, cohort: DataFrame) -> DataFrame:
    """Plans of the target population on the index date."""
    target = target_population(cohort, spec.cohort.flags)
    return coverage_at_index(target, tables["payer_plan_period"], spec.model.coverage_rules)


def build_model_frame(
    features: DataFrame,
    covariates: DataFrame,
    coverage: DataFrame,
    spec: ModelSpec,
    score: str = "cci",
    store: StageStore | None = None,
    discrete_score: bool = True,
) -> DataFrame:
    """Features with score and coverage, ready for modelling.

    The order matters: the median is taken over the joined rows, uncovered persons gone and
    persons with two plans counted twice, but before the age limit. The joined rows are read
    once for the median and again for the frame, and models and tables read the frame more than
    once; with a ``store`` both are written, so nobody computes them twice. A sum of whole
    weights is a discrete score; say so if yours is not.
    """
    scores = covariates.select(F.col("rowId").alias(SUBJECT), F.col("covariateValue").alias(score))
    joined = features.join(scores, SUBJECT, "left").join(coverage, SUBJECT)
    if store is not None:
        joined = store.put("joined", joined)
    imputed = impute_median(joined, score, discrete=discrete_score)
    adults = imputed.filter(F.col("patient_age") >= spec.min_age)
    coded = label_to_flag(spec.outcome_column, spec.outcome_labels[0])
    frame = adults.withColumns({spec.outcome_column: coded, "age_group": cut("patient_age", spec.age_breaks)})
    return frame if store is None else store.put("model_frame", frame)


def build_long_frame(
    flags: DataFrame, model_frame: DataFrame, conditions: Sequence[str], name: str, prefix: str = "has_"
) -> DataFrame:
    """A model row per subject and condition the subject has, the condition named without prefix."""
    present = to_long(flags, [SUBJECT], conditions, name, "present").filter(F.col("present") == 1)
    named = present.withColumn(name, strip_prefix(name, prefix)).drop("present")
    return named.join(model_frame, SUBJECT)


@dataclass(frozen=True)
class StudyStages:
    """The persisted stages of one run."""

    events: DataFrame
    cohort: DataFrame
    outcome: DataFrame
    features: DataFrame
    coverage: DataFrame
    undated: DataFrame
    counts: Mapping[str, int]

    def funnel(self) -> DataFrame:
        """(step, name, n_rows) of the written stages, from the counts of the writes: no job reads a stage again."""
        rows = [(i, name, n) for i, (name, n) in enumerate(self.counts.items(), 1)]
        return self.events.sparkSession.createDataFrame(rows, "step int, name string, n_rows long")


def undated_events(tables: Relations) -> DataFrame:
    """Rows of each event relation that have no date, which the steps leave out of account."""
    dates = {
        "condition_occurrence": "condition_start_date",
        "procedure_occurrence": "procedure_date",
        "visit_occurrence": "visit_start_date",
    }
    parts = [
        rows_without_date(tables[name], date).select(F.lit(name).alias("relation"), F.col(date).alias("n_rows"))
        for name, date in dates.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_study(spec: StudySpec, tables: Relations, store: StageStore) -> StudyStages:
    """Run the steps in order, each written before the next reads it.

    The written cohort has a known size, so the feature step can broadcast it instead of
    shuffling the event table.
    """
    events = store.put("qualifying_events", select_events(spec.cohort, tables), counted=True)
    cohort = store.put("cohort", build_cohort(spec.cohort, tables, events), counted=True)
    outcome = store.put("outcome", build_outcome(spec, tables, cohort), counted=True)
    features = store.put("features", build_features(spec, tables, cohort), counted=True)
    coverage = store.put("coverage", build_coverage(spec, tables, cohort), counted=True)
    undated = store.put("undated_events", undated_events(tables))
    return StudyStages(events, cohort, outcome, features, coverage, undated, dict(store.counts))
