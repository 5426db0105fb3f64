"""The claims relations as projections of the test tables.

Every expression is valid in Spark SQL and in DuckDB, so both sides of a check read the same
relations. ``{name}`` is a test table.
"""

from __future__ import annotations

import re
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from indexday.sources import Tables, run_sql

_CODE = (
    "concat(substr(p_type, 1, 1), case when p_size < 10 then '0' else '' end, cast(p_size as varchar(10)), "
    "case when p_partkey % 3 = 0 then '' else concat('.', cast(p_partkey % 10 as varchar(10))) end)"
)

VIEWS: dict[str, str] = {
    "person": """
        select c_custkey as person_id, c_nationkey as location_id,
               case when c_custkey % 2 = 0 then 'F' else 'M' end as gender_source_value,
               cast(greatest(1937, 1930 + (c_custkey * 37) % 75) as int) as year_of_birth
        from {customer}""",
    "location": "select n_nationkey as location_id, n_name as state from {nation}",
    "provider": """
        select s_suppkey as provider_id,
               case when s_suppkey % 3 = 0 then null
                    else concat('SPEC_', cast(s_nationkey as varchar(10))) end as specialty_source_value
        from {supplier}""",
    "visit_occurrence": """
        select o_orderkey as visit_occurrence_id, o_custkey as person_id,
               200 + cast(substr(o_orderpriority, 1, 1) as int) as visit_concept_id,
               cast(o_orderdate as date) as visit_start_date,
               cast(cast(o_orderdate as date) + cast(o_orderkey % 15 as int) as date) as visit_end_date,
               case o_orderkey % 7 when 0 then 401 when 1 then 402 when 2 then 403 when 3 then 404
                    when 4 then 405 when 5 then 400 else 499 end as discharge_to_concept_id,
               case when o_orderkey % 5 = 0 then null else o_orderkey % 100 end as provider_id
        from {orders}""",
    "condition_occurrence": """
        select ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey as condition_occurrence_id,
               o_custkey as person_id, l_orderkey as visit_occurrence_id,
               s_nationkey as condition_concept_id, 10000 + l_partkey as condition_source_concept_id,
               cast(cast(o_orderdate as date) + (l_linenumber - 1) as date) as condition_start_date,
               cast(cast(o_orderdate as date) + (l_linenumber + 2) as date) as condition_end_date
        from {lineitem} join {orders} on l_orderkey = o_orderkey join {supplier} on l_suppkey = s_suppkey""",
    "procedure_occurrence": """
        select o_custkey as person_id, cast(l_shipdate as date) as procedure_date,
               l_suppkey % 50 as procedure_concept_id,
               cast(92500 + l_partkey % 500 as varchar(10)) as procedure_source_value
        from {lineitem} join {orders} on l_orderkey = o_orderkey where l_returnflag = 'R'""",
    "observation_period": """
        select o_custkey as observation_period_id, o_custkey as person_id,
               cast(min(cast(o_orderdate as date)) - cast(o_custkey % 400 as int) as date)
                   as observation_period_start_date,
               cast(max(cast(o_orderdate as date)) + cast(o_custkey % 300 as int) as date)
                   as observation_period_end_date
        from {orders} group by o_custkey""",
    # The second branch leaves out persons on purpose: some must have no plan on their index date.
    "payer_plan_period": """
        select c_custkey as person_id, 501 as payer_concept_id, concat('A|', c_mktsegment) as payer_source_value,
               date '1995-01-01' as payer_plan_period_start_date, date '1998-06-30' as payer_plan_period_end_date
        from {customer}
        union all
        select c_custkey, 502 + cast(c_nationkey % 4 as int), concat('B|', c_mktsegment),
               date '1998-06-01', date '2001-12-31'
        from {customer} where c_custkey % 10 <> 0""",
    "concept": f"""
        select cast(n_nationkey as bigint) as concept_id, n_name as concept_name, n_name as concept_code
        from {{nation}}
        union all select 10000 + p_partkey, p_name, {_CODE} from {{part}}
        union all select cast(pri as bigint), nm, nm from (
            select distinct 200 + cast(substr(o_orderpriority, 1, 1) as int) as pri, o_orderpriority as nm
            from {{orders}}) priorities
        union all select cast(cid as bigint), nm, code from (values
            (400, 'No matching concept', 'D0'), (401, 'Home', 'D1'), (402, 'Rehab', 'D2'),
            (403, 'Nursing', 'D3'), (404, 'Acute', 'D4'), (405, 'Other', 'D5')) places(cid, nm, code)""",
    "concept_ancestor": """
        select 100 + n_regionkey as ancestor_concept_id, n_nationkey as descendant_concept_id from {nation}
        union all select n_nationkey, n_nationkey from {nation}
        union all select anc, des from (values (300, 201), (300, 202), (201, 201), (202, 202)) kinds(anc, des)""",
    "measurement": """
        select user_id as person_id, cast(ts as date) as measurement_date,
               case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2
                    when 'signup' then 3 else 999 end as measurement_concept_id
        from {events}""",
    "observation": "select user_id as person_id from {events}",
    "device_exposure": """
        select user_id as person_id, case event_type when 'error' then 1 else 999 end as device_concept_id
        from {events} where event_type in ('error', 'view')""",
}

# Condition groups and weights for the comorbidity score. The region the index conditions come
# from has none, so persons without another condition have no score.
SCORE_WEIGHTS = """
    select cast(n_nationkey as bigint) as concept_id, cast(n_regionkey as varchar(10)) as score_group,
           1 + n_nationkey % 3 as weight
    from {nation} where n_regionkey > 0"""

_PLACE = re.compile(r"\{(\w+)\}")


_SCHEMAS: dict[str, StructType] = {}


def _table(spark: SparkSession, path: str) -> DataFrame:
    """A test table; its schema is read from the files once, as that takes a job each time."""
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _read(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return run_sql(spark, text, {t: _table(spark, f"{sf_dir}/{t}.parquet") for t in _PLACE.findall(text)})


_BOUND: WeakKeyDictionary[SparkSession, dict[str, Tables]] = WeakKeyDictionary()


def bind(spark: SparkSession, sf_dir: str) -> Tables:
    """The relations over one folder of test tables.

    The plans are kept per session, since parsing them costs more than some queries; no data is.
    """
    bound = _BOUND.setdefault(spark, {})
    if sf_dir not in bound:
        bound[sf_dir] = Tables(lambda name: _read(spark, sf_dir, VIEWS[name]))
    return bound[sf_dir]


def score_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, SCORE_WEIGHTS)


def oracle_views() -> dict[str, str]:
    """The same relations as SQL over the registered tables."""
    views = VIEWS | {"score_weights": SCORE_WEIGHTS}
    return {name: _PLACE.sub(r"\1", text) for name, text in views.items()}
