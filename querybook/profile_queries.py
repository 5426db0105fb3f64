"""Queries for aggregates, top lists, reshaping and utilisation profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexday.functions import relabel
from indexday.operators import profile as pr
from indexday.operators import reshape as rs
from indexday.operators.bitmaps import distinct_ids
from indexday.operators.describe import histogram
from querybook.book import Context, query
from querybook.params import COHORT, PROFILED_PERSON, RELABEL_HOME

GENDERS = ("F", "M")
SPLIT_LABELS = ("No services", "One or more services")


def _cohort_people(q: Context):
    person = q.t.person.select(F.col("person_id").alias("subject_id"), "gender_source_value", "location_id", "year_of_birth")
    return q.cohort.select("subject_id", "has_b").join(person, "subject_id")


# Aggregates


@query("a1_births_by_year", "A1 L1", "select year_of_birth, count(*) as n from person group by year_of_birth")
def _(q: Context):
    return pr.by_count(pr.group_counts(q.t.person, "year_of_birth"), "year_of_birth")


@query("a2_distinct_persons", "A2 P4", "select count(distinct person_id) as n_persons from index_conditions")
def _(q: Context):
    return pr.distinct_persons(q.index_conditions)


@query(
    "a2_distinct_persons_by_code",
    "A2",
    "select condition_concept_id, count(distinct person_id) as n_persons from condition_occurrence group by 1",
)
def _(q: Context):
    return distinct_ids(q.t.condition_occurrence, "person_id", ["condition_concept_id"], "n_persons")


@query(
    "a3_low_count_persons",
    "A3 P17",
    """select count(*) as n_persons from (
           select person_id from index_conditions group by person_id having count(*) < 3) few""",
)
def _(q: Context):
    return pr.persons_below(q.index_conditions, "person_id", 3)


@query(
    "a4_first_dates",
    "A4",
    "select person_id, min(condition_start_date) as first_date from index_conditions group by person_id",
)
def _(q: Context):
    return q.index_conditions.groupBy("person_id").agg(F.min("condition_start_date").alias("first_date"))


@query("a5_group_as_distinct", "A5", "select person_id, condition_concept_id from condition_occurrence group by 1, 2")
def _(q: Context):
    return q.t.condition_occurrence.select("person_id", "condition_concept_id").distinct()


@query(
    "a7_conditional_counts",
    "A7 A8",
    """select person_id, count(*) as n, sum(case when condition_start_date >= date '1998-01-01' then 1 else 0 end)::bigint
              as n_late
       from condition_occurrence group by person_id""",
)
def _(q: Context):
    late = F.col("condition_start_date") >= F.lit("1998-01-01").cast("date")
    return q.t.condition_occurrence.groupBy("person_id").agg(F.count("*").alias("n"), F.count_if(late).alias("n_late"))


@query(
    "a9_two_key_sizes",
    "A9",
    """select year_of_birth, has_b, count(*) as n from cohort_people
       where year_of_birth is not null and has_b is not null group by year_of_birth, has_b""",
)
def _(q: Context):
    return pr.group_counts(_cohort_people(q).dropna(subset=["year_of_birth", "has_b"]), "year_of_birth", "has_b")


# Sort and limit


def _placed(df):
    """Finished rows with the place they come in."""
    rows = df.coalesce(1).withColumn("_at", F.monotonically_increasing_id())
    return rows.select((F.col("_at") + 1).alias("place"), *df.columns)


@query(
    "l2_top_persons",
    "L2 L1 C24",
    """select row_number() over (order by n desc, person_id) as place, * from (
           select person_id, count(*) as n from observation group by person_id order by n desc, person_id limit 20) t""",
)
def _(q: Context):
    return _placed(pr.top_k(q.t.observation, "person_id", 20))


@query(
    "l3_earliest_measurements",
    "L3",
    """select row_number() over (order by measurement_date, person_id) as place, * from (
           select person_id, measurement_concept_id, measurement_date from measurement where measurement_concept_id = 2
           order by measurement_date, person_id limit 100) t""",
)
def _(q: Context):
    picked = q.t.measurement.filter(F.col("measurement_concept_id") == 2)
    rows = pr.earliest_rows(picked, "measurement_date", ["person_id"], 100)
    return _placed(rows.select("person_id", "measurement_concept_id", "measurement_date"))


@query(
    "l4_ordered_peek",
    "L4 S5",
    """select condition_occurrence_id, person_id, condition_start_date from index_conditions
       order by condition_start_date, condition_occurrence_id, person_id limit 100""",
)
def _(q: Context):
    events = q.index_conditions.select("condition_occurrence_id", "person_id", "condition_start_date")
    return pr.earliest_rows(events, "condition_start_date", ["condition_occurrence_id", "person_id"], 100)


# Reshape


@query(
    "r1_year_by_flag",
    "R1 D7 A9",
    """select year_of_birth, count(*) filter (has_b = 0) as without_b, count(*) filter (has_b = 1) as with_b
       from cohort_people group by year_of_birth""",
)
def _(q: Context):
    return rs.pivot_counts(_cohort_people(q), "year_of_birth", "has_b", [0, 1], ["without_b", "with_b"])


@query(
    "d7_year_by_gender",
    "D7 R1",
    """select year_of_birth, count(*) filter (gender_source_value = 'F') as f,
              count(*) filter (gender_source_value = 'M') as m
       from cohort_people group by year_of_birth""",
)
def _(q: Context):
    return rs.pivot_counts(_cohort_people(q), "year_of_birth", "gender_source_value", GENDERS, ["f", "m"])


_STATE = """
    select l.state, count(*) filter (c.has_b = 0) as without_b, count(*) filter (c.has_b = 1) as with_b
    from cohort_people c join location l on l.location_id = c.location_id group by l.state"""


def _by_state(q: Context):
    people = _cohort_people(q).join(q.t.location, "location_id")
    return rs.pivot_counts(people, "state", "has_b", [0, 1], ["without_b", "with_b"])


@query(
    "l5_state_by_flag_sorted",
    "L5 D7 A10 P20",
    f"select row_number() over (order by without_b + with_b desc, state) as place, * from ({_STATE}) s",
)
def _(q: Context):
    return _placed(rs.sort_by_row_total(_by_state(q), ["without_b", "with_b"], "state"))


@query("a10_row_totals", "A10 R1", f"select *, without_b + with_b as total from ({_STATE}) s")
def _(q: Context):
    return rs.with_row_total(_by_state(q), ["without_b", "with_b"])


@query(
    "r2_wide_to_long",
    "R2 X17",
    " union all ".join(f"select subject_id, '{f}' as name, {f} as present from cohort" for f in COHORT.flags),
)
def _(q: Context):
    return rs.to_long(q.cohort, ["subject_id"], COHORT.flags, "name", "present")


# Utilisation after the index date


@query(
    "c16_visits_by_specialty",
    "C16 J8 L2 X12",
    """select coalesce(specialty_source_value, 'No Specialty') as specialty_source_value, n from (
           select r.specialty_source_value, count(*) as n
           from cohort c join visit_occurrence v on v.person_id = c.subject_id
                and v.visit_start_date >= c.cohort_start_date
           join provider r on r.provider_id = v.provider_id
           group by r.specialty_source_value order by n desc, r.specialty_source_value limit 20) top""",
)
def _(q: Context):
    return pr.utilisation_by_specialty(q.staged_cohort, q.t.visit_occurrence, q.t.provider)


_SPLIT = """
    select count(*) filter (person_status = 'null') as count_null,
           count(*) filter (person_status = 'not_null') as count_not_null,
           count(*) filter (person_status = 'null' and has_b = 1) as count_null_has_b_1,
           count(*) filter (person_status = 'not_null' and has_b = 1) as count_not_null_has_b_1,
           count(*) filter (person_status = 'null' and has_b = 0) as count_null_has_b_0,
           count(*) filter (person_status = 'not_null' and has_b = 0) as count_not_null_has_b_0
    from (select c.subject_id, c.has_b,
                 case when exists (select 1 from services s where s.person_id = c.subject_id
                                   and s.procedure_date >= c.cohort_start_date)
                      then 'not_null' else 'null' end as person_status
          from cohort c) statuses"""


@query("c17_service_split", "C17 J12 A7 A8 P15 X5", _SPLIT)
def _(q: Context):
    return pr.service_split(pr.service_status(q.staged_cohort, q.services, "has_b"), "has_b")


@query(
    "r3_service_split_long",
    "R3 C17",
    " union all ".join(
        f"select '{label}' as status, {v} as has_b, count_{s}_has_b_{v} as n from ({_SPLIT}) x"
        for s, label in (("null", SPLIT_LABELS[0]), ("not_null", SPLIT_LABELS[1]))
        for v in (1, 0)
    ),
)
def _(q: Context):
    split = pr.service_split(pr.service_status(q.staged_cohort, q.services, "has_b"), "has_b")
    return pr.service_split_long(split, "has_b", SPLIT_LABELS)


@query("c18_service_counts", "C18 J8 L1", "select subject_id, n from service_counts")
def _(q: Context):
    return pr.by_count(pr.services_per_person(q.staged_cohort, q.services), "subject_id")


@query(
    "d3_service_histogram",
    "D3",
    """with ends as (select min(n) as lo, max(n) as hi from service_counts)
       select cast(least(floor((s.n - e.lo) / 1.0), greatest(ceil((e.hi - e.lo) / 1.0) - 1, 0)) as bigint) as bin,
              cast(e.lo + 1 * least(floor((s.n - e.lo) / 1.0), greatest(ceil((e.hi - e.lo) / 1.0) - 1, 0)) as double)
                  as bin_start,
              count(*) as n
       from service_counts s, ends e group by 1, 2""",
)
def _(q: Context):
    return histogram(pr.services_per_person(q.staged_cohort, q.services), "n", 1)


@query(
    "c19_discharge_counts",
    "C19 X13 J1",
    """select v.discharge_to_concept_id, count(*) as n,
              case k.concept_name when 'No matching concept' then 'Discharged to Home' else k.concept_name end
                  as concept_name
       from cohort c join condition_occurrence e on e.condition_occurrence_id = c.condition_occurrence_id
       join visit_occurrence v on v.visit_occurrence_id = e.visit_occurrence_id
       join concept k on k.concept_id = v.discharge_to_concept_id
       group by v.discharge_to_concept_id, k.concept_name""",
)
def _(q: Context):
    return pr.discharge_counts(q.staged_cohort, q.t.condition_occurrence, q.t.visit_occurrence, q.t.concept, RELABEL_HOME)


# One person's records


def _profile_sql(relation: str, code: str, join: str = "join") -> str:
    return f"""
        select r.{code}, count(*) as n, any_value(k.concept_name) as concept_name
        from {relation} r {join} concept k on k.concept_id = r.{code}
        where r.person_id = {PROFILED_PERSON} group by r.{code}"""


def _register_profile(domain: str, relation: str, code: str, how: str, covers: str) -> None:
    @query(f"c23_person_{domain}", covers, _profile_sql(relation, code, "left join" if how == "left" else "join"))
    def _(q: Context):
        return pr.code_profile(q.t[relation], PROFILED_PERSON, code, q.t.concept, how=how)


_register_profile("visits", "visit_occurrence", "visit_concept_id", "inner", "C23 J2 P6")
_register_profile("measurements", "measurement", "measurement_concept_id", "inner", "C23 J2 P6")
_register_profile("devices", "device_exposure", "device_concept_id", "inner", "C23 J2 P6")
_register_profile("conditions", "condition_occurrence", "condition_concept_id", "left", "C23 J3 P6")


@query(
    "j3_unmapped_codes",
    "J3 X12",
    """select m.measurement_concept_id, m.n, coalesce(k.concept_name, 'unmapped') as concept_name
       from (select measurement_concept_id, count(*) as n from measurement group by 1) m
       left join concept k on k.concept_id = m.measurement_concept_id""",
)
def _(q: Context):
    counts = pr.group_counts(q.t.measurement, "measurement_concept_id")
    names = q.t.concept.select(F.col("concept_id").alias("measurement_concept_id"), "concept_name")
    named = counts.join(names, "measurement_concept_id", "left")
    return named.withColumn("concept_name", relabel("concept_name", None, "unmapped"))


@query(
    "c24_top_devices",
    "C24 L2 A1",
    "select person_id, count(*) as n from device_exposure group by person_id order by n desc, person_id limit 20",
)
def _(q: Context):
    return pr.top_k(q.t.device_exposure, "person_id", 20)
