"""Check SQL: the study's relations in their plain form, for DuckDB.

They say what a result is, not how to get it fast: correlated subqueries, one scan per flag,
distinct counts. The operators under test take other routes to the same rows.
"""

from __future__ import annotations

import re

from indexday.spec import CategoryRule, CodeGroup, CodeSet
from querybook.binding import oracle_views
from querybook.params import COHORT, MODEL, SERVICE_CONCEPTS, STRATA


def ints(values) -> str:
    return ", ".join(str(v) for v in values)


def texts(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def flag_expr(s: CodeSet, row: str) -> str:
    source = (
        f"from condition_occurrence e where e.person_id = {row}.subject_id "
        f"and e.condition_concept_id in ({ints(s.ids)})"
    )
    return (
        f"case when exists (select 1 {source} and e.condition_start_date >= {row}.cohort_start_date) "
        f"and (select count(distinct e.condition_start_date) {source}) >= 2 then 1 else 0 end as {s.name}"
    )


def code_test(g: CodeGroup, column: str) -> str:
    tests = [f"regexp_matches({column}, '^{p}(\\.[A-Za-z0-9]|$)')" for p in g.prefixes]
    tests += [f"{column} = '{c}'" for c in g.codes]
    return "(" + " or ".join(tests) + ")"


def window_expr(g: CodeGroup, row: str) -> str:
    return (
        f"case when exists (select 1 from condition_occurrence e join concept k "
        f"on k.concept_id = e.condition_source_concept_id where e.person_id = {row}.subject_id "
        f"and {code_test(g, 'k.concept_code')} and e.condition_start_date >= {row}.cohort_start_date - {g.before} "
        f"and e.condition_start_date <= {row}.cohort_start_date + {g.after}) then 1 else 0 end as {g.name}"
    )


def rules_expr(rules: tuple[CategoryRule, ...], code: str, value: str = "''") -> str:
    whens = []
    for r in rules:
        tests = ([f"{code} in ({ints(r.ids)})"] if r.ids else []) + ([f"{value} in ({texts(r.values)})"] if r.values else [])
        whens.append(f"when {' or '.join(tests)} then '{r.label}'")
    return "case " + " ".join(whens) + " end"


def age_expr(column: str) -> str:
    b = MODEL.age_breaks
    whens = [f"when {column} >= {lo} and {column} < {hi} then '{lo}-{hi - 1}'" for lo, hi in zip(b, b[1:])]
    return "case " + " ".join(whens) + f" when {column} >= {b[-1]} then '{b[-1]}+' end"


ANY_FLAG = " or ".join(f"{f} = 1" for f in COHORT.flags)
FEATURES = ", ".join(MODEL.features)
STRATA_COLUMNS = ", ".join(STRATA)

# Later relations may read earlier ones.
RELATIONS: dict[str, str] = oracle_views() | {
    "event_codes": f"""
        select descendant_concept_id as concept_id from concept_ancestor
        where ancestor_concept_id in ({ints(COHORT.event_ancestors)})
          and descendant_concept_id in (select concept_id from concept)""",
    "encounter_codes": f"""
        select descendant_concept_id as concept_id from concept_ancestor
        where ancestor_concept_id in ({ints(COHORT.encounter_ancestors)})
          and descendant_concept_id in (select concept_id from concept)""",
    "qualifying": """
        select e.condition_occurrence_id, e.person_id, e.condition_concept_id, e.condition_start_date,
               e.condition_end_date, v.visit_start_date, v.visit_end_date, v.discharge_to_concept_id
        from visit_occurrence v join condition_occurrence e on e.visit_occurrence_id = v.visit_occurrence_id
        where exists (select 1 from event_codes k where k.concept_id = e.condition_concept_id)
          and exists (select 1 from encounter_codes k where k.concept_id = v.visit_concept_id)""",
    "index_rows": """
        select * exclude (nr) from (
            select q.*, row_number() over (
                partition by person_id order by condition_start_date, condition_occurrence_id) as nr
            from qualifying q) numbered
        where nr = 1""",
    "day_numbers": """
        select person_id, condition_start_date,
               row_number() over (partition by person_id order by condition_start_date) as day_no
        from (select distinct person_id, condition_start_date from qualifying) days""",
    "confirmed": f"""
        select person_id from day_numbers where day_no <= 2 group by person_id
        having count(*) = 2 and max(condition_start_date) - min(condition_start_date) <= {COHORT.confirm_days}""",
    "cohort_plain": f"""
        select i.person_id as subject_id, i.condition_occurrence_id, i.condition_concept_id,
               i.condition_start_date as cohort_start_date, i.condition_end_date,
               cast(i.condition_start_date + {COHORT.milestone_days} as date) as six_months_after_index,
               i.visit_start_date, i.visit_end_date, i.discharge_to_concept_id,
               {rules_expr(COHORT.destinations, "i.discharge_to_concept_id")} as discharge_location,
               o.observation_period_start_date, o.observation_period_end_date as cohort_end_date,
               o.observation_period_id
        from index_rows i, observation_period o, confirmed c
        where c.person_id = i.person_id and o.person_id = i.person_id
          and o.observation_period_start_date + {COHORT.observed_before} <= i.condition_start_date
          and i.condition_start_date + {COHORT.observed_after} <= o.observation_period_end_date""",
    "cohort": f"""
        select p.*, {", ".join(flag_expr(s, "p") for s in COHORT.flag_sets)},
               {COHORT.definition_id} as cohort_definition_id
        from cohort_plain p""",
    "target": f"select * from cohort where {ANY_FLAG}",
    "treatment": f"""
        select t.subject_id, case when t.subject_id in (
            select r.person_id from procedure_occurrence r join target u on u.subject_id = r.person_id
            where r.procedure_date >= u.cohort_start_date
              and r.procedure_source_value in ({texts(MODEL.procedure_codes)}))
            then 'treated' else 'untreated' end as treatment_status
        from target t""",
    "window_features": f"""
        select t.subject_id, {", ".join(window_expr(g, "t") for g in MODEL.code_groups)} from target t""",
    "stays": f"""
        select subject_id, cast(visit_end_date - cohort_start_date as int) as initial_ip_duration,
               case when visit_end_date - cohort_start_date > {MODEL.severity_days} then 'severe'
                    when visit_end_date is not null then 'mild' end as severity
        from cohort""",
    "people": """
        select c.subject_id, cast(extract(year from c.cohort_start_date) as int) - p.year_of_birth as patient_age,
               p.gender_source_value as gender
        from cohort c join person p on p.person_id = c.subject_id""",
    "features": f"""
        select r.subject_id, r.treatment_status, {FEATURES}, s.initial_ip_duration, s.severity,
               p.patient_age, p.gender
        from treatment r join window_features w on w.subject_id = r.subject_id
        left join stays s on s.subject_id = r.subject_id left join people p on p.subject_id = r.subject_id""",
    "coverage": f"""
        select t.subject_id, y.payer_source_value,
               {rules_expr(MODEL.coverage_rules, "y.payer_concept_id", "y.payer_source_value")} as insurance_plan
        from target t join payer_plan_period y on y.person_id = t.subject_id
        where t.cohort_start_date between y.payer_plan_period_start_date and y.payer_plan_period_end_date""",
    "scores": """
        select subject_id, cast(sum(weight) as double) as score from (
            select c.subject_id, w.score_group, max(w.weight) as weight
            from cohort c join condition_occurrence e on e.person_id = c.subject_id
                 and e.condition_start_date <= c.cohort_start_date
            join score_weights w on w.concept_id = e.condition_concept_id
            group by c.subject_id, w.score_group) found
        group by subject_id""",
    "scored": """
        select f.*, s.score as raw_score, g.payer_source_value, g.insurance_plan
        from features f left join scores s on s.subject_id = f.subject_id
        join coverage g on g.subject_id = f.subject_id""",
    "model_frame": f"""
        select subject_id, case when treatment_status = 'treated' then 1 else 0 end as treatment_status, {FEATURES},
               initial_ip_duration, severity, patient_age, gender,
               coalesce(raw_score, (select median(raw_score) from scored)) as cci,
               payer_source_value, insurance_plan, {age_expr("patient_age")} as age_group
        from scored where patient_age >= {MODEL.min_age}""",
    "long_frame": f"""
        select condition_group, {STRATA_COLUMNS} from model_frame m join (
            {" union all ".join(f"select subject_id as sid, '{f[4:]}' as condition_group from cohort where {f} = 1" for f in COHORT.flags)}
        ) l on l.sid = m.subject_id""",
    "strata": f"""
        select condition_group, {STRATA_COLUMNS} from long_frame
        union all
        select 'Total' as condition_group, {STRATA_COLUMNS} from (select distinct {STRATA_COLUMNS} from long_frame) once""",
    "services": f"select * from procedure_occurrence where procedure_concept_id in ({ints(SERVICE_CONCEPTS)})",
    "service_counts": """
        select c.subject_id, count(*) as n from cohort c join services s on s.person_id = c.subject_id
        where s.procedure_date >= c.cohort_start_date group by c.subject_id""",
    "index_conditions": """
        select * from condition_occurrence where condition_concept_id in (select concept_id from event_codes)""",
    "cohort_people": """
        select c.*, p.gender_source_value, p.location_id, p.year_of_birth
        from cohort c join person p on p.person_id = c.subject_id""",
}

_ORDER = list(RELATIONS)


def _reads(text: str, below: int) -> set[str]:
    return {n for n in _ORDER[:below] if re.search(rf"(?:from|join|,)\s+{n}\b", text)}


def with_relations(text: str) -> str:
    """The text with the relations it reads, and those they read, put in front."""
    wanted: set[str] = set()
    todo = _reads(text, len(_ORDER))
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo |= _reads(RELATIONS[name], _ORDER.index(name))
    parts = [f"{n} as ({RELATIONS[n].strip()})" for n in _ORDER if n in wanted]
    text = text.strip()
    if not parts:
        return text
    own = re.match(r"with\s+(.*)", text, re.DOTALL)
    return f"with {', '.join(parts)}" + (f", {own[1]}" if own else f" {text}")
