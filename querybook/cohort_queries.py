"""Queries for scans, predicates, joins, windows and the cohort operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from indexday.functions import any_flag, categorize, code_matches, days_between, strip_prefix
from indexday.operators import events as ev
from indexday.operators import features as ft
from indexday.operators.concepts import expand_concepts, tag_by_map
from indexday.operators.intervals import points_in_intervals
from indexday.operators.profile import group_counts
from indexday.operators.reshape import append, as_text
from indexday.operators.sweep import flags_around_dates
from indexday.plans import study
from indexday.sources import RELATIONS, load_covariates, preview, run_sql, save_covariates
from querybook.book import Context, query
from querybook.oracle import FEATURES, code_test, ints, rules_expr, texts, window_expr
from querybook.params import COHORT, MODEL, STUDY

PERSON, DATE, EVENT = "person_id", "condition_start_date", "condition_occurrence_id"
COHORT_COLUMNS = (
    "subject_id, condition_occurrence_id, condition_concept_id, cohort_start_date, condition_end_date, "
    "six_months_after_index, visit_start_date, visit_end_date, discharge_to_concept_id, discharge_location, "
    "observation_period_start_date, cohort_end_date, observation_period_id"
)


# Scans and SQL text


@query(
    "s1_relation_sizes",
    "S1",
    " union all ".join(f"select '{r}' as relation, count(*) as n_rows from {r}" for r in RELATIONS),
)
def _(q: Context):
    sizes = [q.t[r].agg(F.count("*").alias("n_rows")).select(F.lit(r).alias("relation"), "n_rows") for r in RELATIONS]
    return append(*sizes)


@query(
    "s2_sql_text",
    "S2 S3",
    "select location_id, count(*) as n from person where year_of_birth >= 1960 group by location_id",
)
def _(q: Context):
    text = "select location_id, count(*) as n from {people} where year_of_birth >= :born group by location_id"
    return run_sql(q.spark, text, {"people": q.t.person}, {"born": 1960})


@query(
    "s4_written_stage",
    "S4",
    """select gender_source_value, count(*) as n, true as refused from person group by gender_source_value""",
)
def _(q: Context):
    store = q.store
    store.put("people", q.t.person.select("person_id", "gender_source_value"))
    try:
        store.put("people", q.t.person)
        refused = False
    except AnalysisException:  # a written stage stays as it is
        refused = True
    counted = store.get("people").groupBy("gender_source_value").agg(F.count("*").alias("n"))
    return counted.withColumn("refused", F.lit(refused))


@query("s5_preview", "S5", "select person_id, location_id from person order by person_id limit 5")
def _(q: Context):
    return preview(q.t.person.select("person_id", "location_id").orderBy("person_id"))


@query(
    "s6_covariate_file",
    "S6",
    """select cast(person_id as bigint) as "rowId", 1 as "covariateId", cast(year_of_birth as double) as "covariateValue"
       from person""",
)
def _(q: Context):
    born = q.t.person.select(
        F.col("person_id").cast("long").alias("rowId"),
        F.lit(1).alias("covariateId"),
        F.col("year_of_birth").cast("double").alias("covariateValue"),
    )
    path = q.store.target("covariates")
    save_covariates(born, path)
    return load_covariates(q.spark, path)


# Projections and filters


@query(
    "p1_project_rename",
    "P1 P3",
    "select person_id as subject_id, gender_source_value as gender, 1 as cohort_definition_id from person",
)
def _(q: Context):
    return q.t.person.select(
        F.col("person_id").alias("subject_id"),
        F.col("gender_source_value").alias("gender"),
        F.lit(1).alias("cohort_definition_id"),
    )


@query(
    "p2_star_and_more",
    "P2 J2 J16",
    "select p.*, l.state, 1 as marker from person p join location l on l.location_id = p.location_id",
)
def _(q: Context):
    p, loc = q.t.person.alias("p"), q.t.location.alias("l")
    return p.join(loc, "location_id").select("p.*", "l.state", F.lit(1).alias("marker"))


_LISTED = tuple(sorted({i for s in COHORT.flag_sets for i in s.ids}))


@query(
    "p4_in_list",
    "P4",
    f"""select condition_occurrence_id, person_id, condition_concept_id from condition_occurrence
        where condition_concept_id in ({ints(_LISTED)})""",
)
def _(q: Context):
    found = q.t.condition_occurrence.filter(F.col("condition_concept_id").isin(*_LISTED))
    return found.select(EVENT, PERSON, "condition_concept_id")


@query(
    "p5_text_in_list",
    "P5",
    f"""select person_id, procedure_date, procedure_source_value from procedure_occurrence
        where procedure_source_value in ({texts(MODEL.procedure_codes)})""",
)
def _(q: Context):
    found = q.t.procedure_occurrence.filter(F.col("procedure_source_value").isin(*MODEL.procedure_codes))
    return found.select(PERSON, "procedure_date", "procedure_source_value")


@query("p6_equality", "P6", "select person_id, measurement_date from measurement where measurement_concept_id = 2")
def _(q: Context):
    return q.t.measurement.filter(F.col("measurement_concept_id") == 2).select(PERSON, "measurement_date")


@query(
    "p7_code_patterns",
    "P7 P8",
    "select concept_id, "
    + ", ".join(f"case when {code_test(g, 'concept_code')} then 1 else 0 end as {g.name}" for g in MODEL.code_groups)
    + " from concept where "
    + " or ".join(code_test(g, "concept_code") for g in MODEL.code_groups),
)
def _(q: Context):
    return q.code_map


@query(
    "p8_exact_code",
    "P8",
    """select concept_id, concept_code from concept
       where concept_code = 'P07.1' or regexp_matches(concept_code, '^M10(\\.[A-Za-z0-9]|$)')""",
)
def _(q: Context):
    return q.t.concept.filter(code_matches("concept_code", ["M10"], ["P07.1"])).select("concept_id", "concept_code")


_GROUPED = " or ".join(code_test(g, "k.concept_code") for g in MODEL.code_groups)


def _events_near(q: Context, before: int, after: int):
    events = q.t.condition_occurrence.select(PERSON, EVENT, DATE, "condition_source_concept_id")
    coded = tag_by_map(events, "condition_source_concept_id", q.code_map.select("concept_id"))
    near = ft.events_in_window(q.staged_target, coded, person=PERSON, date=DATE, before=before, after=after)
    return near.select("subject_id", EVENT, days_between("cohort_start_date", DATE).alias("day_offset"))


def _near_sql(before: int, after: int) -> str:
    return f"""
        select t.subject_id, e.condition_occurrence_id,
               cast(e.condition_start_date - t.cohort_start_date as int) as day_offset
        from target t join condition_occurrence e on e.person_id = t.subject_id
        where e.condition_source_concept_id in (select k.concept_id from concept k where {_GROUPED})
          and e.condition_start_date - t.cohort_start_date between -{before} and {after}"""


@query("p9_events_around_index", "P9 J9 J13 X6 X8 X9", _near_sql(180, 30))
def _(q: Context):
    return _events_near(q, 180, 30)


@query("p10_events_after_index", "P10 J9 X9", _near_sql(0, 30))
def _(q: Context):
    return _events_near(q, 0, 30)


@query(
    "p11_on_or_after_index",
    "P11 J8",
    f"""select r.person_id as subject_id, r.procedure_date, r.procedure_source_value
        from procedure_occurrence r join target t on t.subject_id = r.person_id
        where r.procedure_date >= t.cohort_start_date
          and r.procedure_source_value in ({texts(MODEL.procedure_codes)})""",
)
def _(q: Context):
    listed = q.t.procedure_occurrence.filter(F.col("procedure_source_value").isin(*MODEL.procedure_codes))
    listed = listed.select(PERSON, "procedure_date", "procedure_source_value")
    late = ft.events_in_window(q.staged_target, listed, person=PERSON, date="procedure_date")
    return late.drop("cohort_start_date")


@query(
    "p13_index_inside_interval",
    "P13 J10",
    """select t.subject_id, y.payer_concept_id from target t join payer_plan_period y on y.person_id = t.subject_id
       where y.payer_plan_period_start_date <= t.cohort_start_date
         and y.payer_plan_period_end_date >= t.cohort_start_date""",
)
def _(q: Context):
    spans = q.t.payer_plan_period.withColumnRenamed(PERSON, "subject_id")
    ends = {"start": "payer_plan_period_start_date", "end": "payer_plan_period_end_date"}
    points = q.target.select("subject_id", "cohort_start_date")
    inside = points_in_intervals(points, spans, key="subject_id", point="cohort_start_date", keep=["payer_concept_id"], **ends)
    return inside.drop("cohort_start_date")


@query(
    "j10_stays_over_events",
    "J10 P13",
    """select e.condition_occurrence_id, v.visit_occurrence_id as stay from condition_occurrence e
       join visit_occurrence v on v.person_id = e.person_id
       where v.visit_start_date <= e.condition_start_date and v.visit_end_date >= e.condition_start_date""",
)
def _(q: Context):
    """Every stay that covers an event of the same person: many intervals and many points per person."""
    events = q.t.condition_occurrence.select(PERSON, EVENT, DATE)
    stays = q.t.visit_occurrence.withColumnRenamed("visit_occurrence_id", "stay")
    ends = {"start": "visit_start_date", "end": "visit_end_date"}
    met = points_in_intervals(events, stays, key=PERSON, point=DATE, keep=["stay"], **ends)
    return met.select(EVENT, "stay")


def _years(q: Context):
    """Observation year by year: several periods per person, which overlap."""
    seen = q.t.visit_occurrence.groupBy(PERSON, F.year("visit_start_date").alias("observation_period_id"))
    return seen.agg(
        F.date_sub(F.min("visit_start_date"), 300).alias("observation_period_start_date"),
        F.date_add(F.max("visit_start_date"), 300).alias("observation_period_end_date"),
    )


@query(
    "c4_observed_in_years",
    "C4 P12 X7 J10",
    """with years as (
           select person_id, cast(extract(year from visit_start_date) as int) as observation_period_id,
                  cast(min(visit_start_date) - 300 as date) as first_day, cast(max(visit_start_date) + 300 as date) as last_day
           from visit_occurrence group by 1, 2)
       select i.person_id, i.condition_start_date, y.observation_period_id
       from index_rows i join years y on y.person_id = i.person_id
       where y.first_day + 180 <= i.condition_start_date and i.condition_start_date + 180 <= y.last_day""",
)
def _(q: Context):
    index = ev.index_event(q.qualifying, PERSON, DATE, EVENT)
    seen = ev.require_observation(index, _years(q), person=PERSON, date=DATE)
    return seen.select(PERSON, DATE, "observation_period_id")


@query("p15_not_null", "P15", "select provider_id, count(*) as n from visit_occurrence where provider_id is not null group by provider_id")
def _(q: Context):
    return group_counts(q.t.visit_occurrence.filter(F.col("provider_id").isNotNull()), "provider_id")


@query("p18_adults", "P18", "select subject_id, patient_age from features where patient_age >= 18")
def _(q: Context):
    return q.features.filter(F.col("patient_age") >= 18).select("subject_id", "patient_age")


@query("p19_subgroup", "P19", "select subject_id, cohort_start_date from cohort where has_b = 1")
def _(q: Context):
    return q.cohort.filter(F.col("has_b") == 1).select("subject_id", "cohort_start_date")


@query("p20_rename_drop", "P20", "select subject_id as person, score as cci from scores")
def _(q: Context):
    return q.covariates.withColumnsRenamed({"rowId": "person", "covariateValue": "cci"}).drop("covariateId")


# Joins


@query("j4_semi_join_concepts", "J4 J6", "select condition_occurrence_id, person_id, condition_start_date from index_conditions")
def _(q: Context):
    return q.index_conditions.select(EVENT, PERSON, DATE)


@query(
    "j5_semi_join_persons",
    "J5",
    """select condition_occurrence_id, person_id from qualifying
       where person_id in (select person_id from confirmed)""",
)
def _(q: Context):
    confirmed = ev.confirm_within(q.qualifying, PERSON, DATE, EVENT, COHORT.confirm_days).select(PERSON)
    return q.qualifying.select(EVENT, PERSON).join(confirmed, PERSON, "left_semi")


@query(
    "j11_left_join_flag",
    "J11 X4 X20",
    """select c.subject_id, case when t.subject_id is null then 0 else 1 end as in_target
       from cohort c left join target t on t.subject_id = c.subject_id""",
)
def _(q: Context):
    # Names resolve whatever their case.
    return q.cohort.select("SUBJECT_ID", F.when(any_flag(*COHORT.flags), 1).otherwise(0).alias("in_target")).toDF(
        "subject_id", "in_target"
    )


@query(
    "j15_left_join_named_keys",
    "J15",
    "select f.subject_id, f.patient_age, s.score from features f left join scores s on s.subject_id = f.subject_id",
)
def _(q: Context):
    scores = q.covariates.select("rowId", F.col("covariateValue").alias("score"))
    joined = q.features.join(scores, q.features["subject_id"] == scores["rowId"], "left")
    return joined.select("subject_id", "patient_age", "score")


# Windows and index events


@query("w1_index_event", "W1 P16", "select * from index_rows")
def _(q: Context):
    return ev.index_event(q.qualifying, PERSON, DATE, EVENT)


@query(
    "w2_day_rank",
    "W2",
    """select condition_occurrence_id, person_id, condition_start_date,
              cast(dense_rank() over (partition by person_id order by condition_start_date) as int) as day_rank
       from qualifying""",
)
def _(q: Context):
    return ev.rank_days(q.qualifying.select(EVENT, PERSON, DATE), PERSON, DATE)


# Cohort


@query("c1_concept_expansion", "C1 J4 J6 A6", "select distinct cast(concept_id as bigint) as concept_id from event_codes")
def _(q: Context):
    return expand_concepts(q.t.concept_ancestor, q.t.concept, COHORT.event_ancestors)


@query("c2_qualifying_events", "C2 J1 J4", "select * from qualifying")
def _(q: Context):
    return q.qualifying


@query("c3_confirmed_persons", "C3 J7 A5 P16 X6", "select person_id from confirmed")
def _(q: Context):
    return ev.confirm_within(q.qualifying, PERSON, DATE, EVENT, COHORT.confirm_days).select(PERSON)


@query(
    "c4_observed_persons",
    "C4 P12 X7 J10",
    """select i.person_id, i.condition_start_date, o.observation_period_id
       from index_rows i join observation_period o on o.person_id = i.person_id
       where o.observation_period_start_date <= i.condition_start_date - 180
         and o.observation_period_end_date >= i.condition_start_date + 180""",
)
def _(q: Context):
    index = ev.index_event(q.qualifying, PERSON, DATE, EVENT)
    seen = ev.require_observation(index, q.t.observation_period, person=PERSON, date=DATE)
    return seen.select(PERSON, DATE, "observation_period_id")


@query("c5_cohort_without_flags", "C5 J5 X1 P3 X7", f"select {COHORT_COLUMNS} from cohort_plain")
def _(q: Context):
    return study.observed_cohort(COHORT, q.qualifying, q.t)


@query("c6_condition_flags", "C6 J7 J8 J11 X4", "select subject_id, has_a, has_b, has_c from cohort")
def _(q: Context):
    plain = study.observed_cohort(COHORT, q.qualifying, q.t)
    flagged = ft.condition_flags(plain, q.t.condition_occurrence, COHORT.flag_sets)
    return flagged.select("subject_id", *COHORT.flags)


@query(
    "c6_condition_flags_strict",
    "C6",
    """select c.subject_id, case when count(distinct e.condition_start_date) >= 2
                                  and min(e.condition_start_date) >= c.cohort_start_date then 1 else 0 end as has_b
       from cohort_plain c left join condition_occurrence e
            on e.person_id = c.subject_id and e.condition_concept_id in (2, 7, 12)
       group by c.subject_id, c.cohort_start_date""",
)
def _(q: Context):
    plain = study.observed_cohort(COHORT, q.qualifying, q.t)
    flagged = ft.condition_flags(plain, q.t.condition_occurrence, COHORT.flag_sets[1:2], strict=True)
    return flagged.select("subject_id", "has_b")


@query(
    "c7_cohort",
    "C7 C3 C4 C5 C6 J11 P2 P3 F1",
    f"select {COHORT_COLUMNS}, has_a, has_b, has_c, cohort_definition_id from cohort",
)
def _(q: Context):
    return q.cohort


@query("c8_target_population", "C8 P14 X11", "select subject_id, cohort_start_date from target")
def _(q: Context):
    return q.target.select("subject_id", "cohort_start_date")


@query("c9_treatment_outcome", "C9 P5 P11 X5 J8", "select subject_id, treatment_status from treatment")
def _(q: Context):
    return study.build_outcome(STUDY, q.t, q.cohort)


@query(
    "c10_comorbidity_flags",
    "C10 J9 J13 P7 P8 P9 A6",
    "select subject_id, has_park, has_migr, has_depr, has_inso, has_deme from window_features",
)
def _(q: Context):
    groups = [g for g in MODEL.code_groups if g.before]
    out = ft.window_flags(q.target, q.t.condition_occurrence, q.code_map, groups)
    return out.select("subject_id", *[g.name for g in groups])


@query(
    "c10_flags_around_events",
    "C10 C11 J9 J13 P9 P10 A6",
    f"""select d.subject_id, d.cohort_start_date, {", ".join(window_expr(g, "d") for g in MODEL.code_groups)}
        from (select distinct person_id as subject_id, condition_start_date as cohort_start_date from qualifying) d""",
)
def _(q: Context):
    """The flags around every day with a qualifying event: many dates per person."""
    dates = q.qualifying.select(F.col(PERSON).alias("subject_id"), F.col(DATE).alias("cohort_start_date"))
    return flags_around_dates(dates, q.t.condition_occurrence, q.code_map, MODEL.code_groups)


@query("c11_forward_flags", "C11 P10", "select subject_id, has_para, has_isch from window_features")
def _(q: Context):
    groups = [g for g in MODEL.code_groups if not g.before]
    out = ft.window_flags(q.target, q.t.condition_occurrence, q.code_map, groups)
    return out.select("subject_id", *[g.name for g in groups])


@query("c12_stay_severity", "C12 X3 X8", "select subject_id, initial_ip_duration, severity from stays")
def _(q: Context):
    stay = ft.stay_severity(q.cohort, limit=MODEL.severity_days, labels=MODEL.severity_labels)
    return stay.select("subject_id", "initial_ip_duration", "severity")


@query("c13_demographics", "C13 X10 J2", "select subject_id, patient_age, gender from people")
def _(q: Context):
    return ft.demographics(q.cohort, q.t.person).select("subject_id", "patient_age", "gender")


@query(
    "c14_feature_matrix",
    "C14 C9 C10 C11 C12 C13 F2 J11",
    f"select subject_id, treatment_status, {FEATURES}, initial_ip_duration, severity, patient_age, gender from features",
)
def _(q: Context):
    return q.features


@query("c15_coverage_at_index", "C15 X2 P13 J10 F3", "select subject_id, payer_source_value, insurance_plan from coverage")
def _(q: Context):
    return q.coverage


@query(
    "c20_first_day_events",
    "C20 J14 A4",
    """select condition_occurrence_id, person_id, condition_concept_id, condition_start_date from (
           select e.*, rank() over (partition by person_id order by condition_start_date) as nr
           from index_conditions e) ranked
       where nr = 1""",
)
def _(q: Context):
    events = q.index_conditions.select(EVENT, PERSON, "condition_concept_id", DATE)
    return ev.first_day_events(events, PERSON, DATE)


@query(
    "c21_funnel",
    "C21",
    """select 1 as step, 'condition' as name, count(*) as n_rows, count(distinct person_id) as n_persons
       from index_conditions
       union all select 2, 'encounter', count(*), count(distinct person_id) from qualifying
       union all select 3, 'confirmed', count(*), count(distinct person_id) from confirmed
       union all select 4, 'observed', count(*), count(distinct subject_id) from cohort
       union all select 5, 'target', count(*), count(distinct subject_id) from target""",
)
def _(q: Context):
    return study.attrition(COHORT, q.t)


@query(
    "c21_written_stages",
    "C21 S4 S7",
    """select 1 as step, 'qualifying_events' as name, count(*) as n_rows from qualifying
       union all select 2, 'cohort', count(*) from cohort
       union all select 3, 'outcome', count(*) from treatment
       union all select 4, 'features', count(*) from features
       union all select 5, 'coverage', count(*) from coverage""",
)
def _(q: Context):
    return study.run_study(STUDY, q.t, q.store).funnel()


@query("c22_comorbidity_score", "C22 J8", "select subject_id, score from scores")
def _(q: Context):
    return q.covariates.select(F.col("rowId").alias("subject_id"), F.col("covariateValue").alias("score"))


# Scalar expressions


@query(
    "x1_discharge_location",
    "X1",
    f"""select visit_occurrence_id, {rules_expr(COHORT.destinations, "discharge_to_concept_id")} as discharge_location
        from visit_occurrence""",
)
def _(q: Context):
    place = categorize(COHORT.destinations, "discharge_to_concept_id").alias("discharge_location")
    return q.t.visit_occurrence.select("visit_occurrence_id", place)


@query(
    "x2_plan_class",
    "X2",
    f"""select person_id, payer_concept_id,
               {rules_expr(MODEL.coverage_rules, "payer_concept_id", "payer_source_value")} as insurance_plan
        from payer_plan_period""",
)
def _(q: Context):
    plan = categorize(MODEL.coverage_rules, "payer_concept_id", "payer_source_value").alias("insurance_plan")
    return q.t.payer_plan_period.select(PERSON, "payer_concept_id", plan)


@query(
    "x18_categories_as_text",
    "X18",
    """select visit_occurrence_id, cast(visit_concept_id as varchar) as visit_concept_id,
              cast(discharge_to_concept_id as varchar) as discharge_to_concept_id
       from visit_occurrence""",
)
def _(q: Context):
    codes = ["visit_concept_id", "discharge_to_concept_id"]
    return as_text(q.t.visit_occurrence.select("visit_occurrence_id", *codes), codes)


@query(
    "x17_clean_labels",
    "X17 X19",
    """select provider_id, lower(replace(specialty_source_value, 'SPEC_', '')) as specialty,
              cast(provider_id as varchar) as provider_text, 'provider ' || cast(provider_id as varchar) as provider_name
       from provider""",
)
def _(q: Context):
    text = F.col("provider_id").cast("string")
    return q.t.provider.select(
        "provider_id",
        strip_prefix("specialty_source_value", "SPEC_").alias("specialty"),
        text.alias("provider_text"),
        F.concat(F.lit("provider "), text).alias("provider_name"),
    )
