"""Queries for the model frame, descriptive statistics and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexday.functions import cut, label_to_flag
from indexday.operators import describe as ds
from indexday.operators import reshape as rs
from indexday.operators import stats as st
from indexday.operators.selection import order_statistics
from querybook.book import Context, query
from querybook.oracle import FEATURES, STRATA_COLUMNS, age_expr
from querybook.params import CATEGORICAL, COHORT, CONTINUOUS, LABELS, MODEL, PREDICTORS, STRATA

MODEL_COLUMNS = (
    f"subject_id, treatment_status, {FEATURES}, initial_ip_duration, severity, patient_age, gender, cci, "
    "payer_source_value, insurance_plan, age_group"
)
OUTCOME = MODEL.outcome_column
SEVERITIES = ("mild", "severe")
AGE_LEVELS = ("18-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80+")


def _rounded(df, *columns: str):
    return df.withColumns({c: F.round(c, 9) for c in columns})


# Model frame


@query("a11_median_score", "A11", "select median(raw_score) as median from scored")
def _(q: Context):
    return ds.median(q.scored, "cci", discrete=True)


@query(
    "x15_score_imputed",
    "X15 A11",
    """select subject_id, insurance_plan, coalesce(raw_score, (select median(raw_score) from scored)) as cci
       from scored""",
)
def _(q: Context):
    return ds.impute_median(q.scored, "cci", discrete=True).select("subject_id", "insurance_plan", "cci")


@query(
    "a13_measure_percentiles",
    "A13 A11",
    """select o_orderpriority as priority, round(quantile_cont(o_totalprice, 0.25), 6) as q1,
              round(quantile_cont(o_totalprice, 0.5), 6) as median, round(quantile_cont(o_totalprice, 0.9), 6) as p90
       from orders group by o_orderpriority""",
)
def _(q: Context):
    measured = q.source("orders").select(F.col("o_orderpriority").alias("priority"), "o_totalprice")
    out = ds.percentiles(measured, ["priority"], "o_totalprice", [0.25, 0.5, 0.9], ["q1", "median", "p90"], large=10_000)
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "p90")})


@query(
    "a13_order_statistics",
    "A13 A11 D4",
    " union all ".join(
        f"""select o_orderpriority as priority, '{v}' as variable, round(quantile_cont({v}, 0.25), 6) as q1,
                   round(quantile_cont({v}, 0.5), 6) as median, round(quantile_cont({v}, 0.99), 6) as p99
            from (select o_orderpriority, o_totalprice::double as o_totalprice, o_custkey::double as o_custkey from orders) o
            group by o_orderpriority"""
        for v in ("o_totalprice", "o_custkey")
    ),
)
def _(q: Context):
    measured = q.source("orders").select(F.col("o_orderpriority").alias("priority"), "o_totalprice", "o_custkey")
    names = ("q1", "median", "p99")
    out = order_statistics(measured, ["priority"], ["o_totalprice", "o_custkey"], [0.25, 0.5, 0.99], names, q.store)
    return out.withColumns({c: F.round(c, 6) for c in names})


@query("x16_age_groups", "X16", f"select subject_id, patient_age, {age_expr('patient_age')} as age_group from features")
def _(q: Context):
    return q.features.select("subject_id", "patient_age", cut("patient_age", MODEL.age_breaks).alias("age_group"))


@query(
    "x14_outcome_flag",
    "X14",
    "select subject_id, case when treatment_status = 'treated' then 1 else 0 end as treated from features",
)
def _(q: Context):
    return q.features.select("subject_id", label_to_flag(OUTCOME, MODEL.outcome_labels[0]).alias("treated"))


@query("j16_model_frame", "J15 J16 X14 X15 X16 P18 P20 S7", f"select {MODEL_COLUMNS} from model_frame")
def _(q: Context):
    return q.model_frame


@query("u1_long_frame", "R2 X17 X18 P19 J16", f"select condition_group, {STRATA_COLUMNS} from long_frame")
def _(q: Context):
    return q.long_frame


@query("u2_strata_with_total", "U1 U2 A6", f"select condition_group, {STRATA_COLUMNS} from strata")
def _(q: Context):
    return q.strata


# Descriptive statistics


def _table_sql(stratum: str, source: str) -> str:
    cats = " union all ".join(
        f"""select {stratum}, '{c}' as variable, cast({c} as varchar) as level, count(*) as n,
                   round(100.0 * count(*) / sum(count(*)) over (partition by {stratum}), 9)::double as pct,
                   null::double as mean, null::double as sd, null::double as min, null::double as max,
                   null::bigint as missing, null::double as median, '{LABELS.get(c, c)}' as label
            from {source} group by {stratum}, {c}""".replace("Parkinson's", "Parkinson''s")
        for c in CATEGORICAL
    )
    conts = " union all ".join(
        f"""select {stratum}, '{c}', null, count({c}), null, round(avg({c}), 9), round(stddev_samp({c}), 9),
                   min({c})::double, max({c})::double, count(*) - count({c}), median({c})::double, '{LABELS.get(c, c)}'
            from {source} group by {stratum}"""
        for c in CONTINUOUS
    )
    return f"{cats} union all {conts}"


def _table(df, store):
    return _rounded(ds.table_one(df, "condition_group", CATEGORICAL, CONTINUOUS, LABELS, store=store), "pct", "mean", "sd")


@query("d1_table_one", "D1 D2 A13", _table_sql("condition_group", "long_frame"))
def _(q: Context):
    return _table(q.long_frame, q.store)


@query("d1_table_one_total", "D1 D2 A13 U1 U2", _table_sql("condition_group", "strata"))
def _(q: Context):
    return _table(q.strata, q.store)


@query(
    "d3_score_histogram",
    "D3",
    """select cast(floor(score + 0.5) as bigint) as bin, floor(score + 0.5) - 0.5 as bin_start, count(*) as n
       from scores group by 1, 2""",
)
def _(q: Context):
    return ds.histogram(q.covariates, "covariateValue", 1, -0.5)


@query(
    "d3_age_histogram",
    "D3",
    """select cast(patient_age as bigint) as bin, cast(patient_age as double) as bin_start, count(*) as n
       from model_frame group by patient_age""",
)
def _(q: Context):
    return ds.histogram(q.model_frame, "patient_age", 1, 0)


@query(
    "d4_box_stats",
    "D4",
    """with five as (select quantile_cont(score, 0.25) as q1, quantile_cont(score, 0.5) as md,
                            quantile_cont(score, 0.75) as q3 from scores)
       select count(*) as n, min(score) as min, any_value(q1) as q1, any_value(md) as median, any_value(q3) as q3,
              max(score) as max, min(score) filter (score >= q1 - 1.5 * (q3 - q1)) as whisker_low,
              max(score) filter (score <= q3 + 1.5 * (q3 - q1)) as whisker_high,
              count(*) filter (score < q1 - 1.5 * (q3 - q1) or score > q3 + 1.5 * (q3 - q1)) as n_outliers
       from scores, five""",
)
def _(q: Context):
    return ds.box_stats(q.covariates, "covariateValue")


@query("d5_age_group_counts", "D5", "select age_group, count(*) as n from model_frame group by age_group")
def _(q: Context):
    return ds.category_counts(q.model_frame, "age_group")


def _flagged_model(q: Context):
    """Model rows with the cohort's flags, as the overlap counts read them."""
    return q.model_frame.join(q.staged_cohort.select("subject_id", *COHORT.flags), "subject_id")


_MEMBERS = "select distinct c.subject_id, has_a, has_b, has_c from cohort c join model_frame m on m.subject_id = c.subject_id"


def _overlap_sql() -> str:
    sets = [["has_a"], ["has_b"], ["has_c"], ["has_a", "has_b"], ["has_a", "has_c"], ["has_b", "has_c"], [*COHORT.flags]]
    rows = [
        f"select '{' & '.join(s)}' as sets, count(*) as n from ({_MEMBERS}) x where {' and '.join(f'{f} = 1' for f in s)}"
        for s in sets
    ]
    return " union all ".join(rows)


@query("u3_overlap_counts", "U3 D6 J16", _overlap_sql())
def _(q: Context):
    return rs.overlap_counts(_flagged_model(q), "subject_id", COHORT.flags, ids=q.staged_cohort)


@query(
    "u3_set_row_sizes",
    "U3 D6",
    " union all ".join(
        f"select '{f}' as sets, count(*) as n from model_frame m join cohort c on c.subject_id = m.subject_id where {f} = 1"
        for f in COHORT.flags
    ),
)
def _(q: Context):
    return rs.set_sizes(_flagged_model(q), COHORT.flags)


@query(
    "u4_overlap_regions",
    "U4 D6",
    f"""with members as ({_MEMBERS}), regions(region, a, b, c) as (values
           ('has_a only', 1, 0, 0), ('has_b only', 0, 1, 0), ('has_c only', 0, 0, 1),
           ('has_a & has_b only', 1, 1, 0), ('has_a & has_c only', 1, 0, 1), ('has_b & has_c only', 0, 1, 1),
           ('has_a & has_b & has_c only', 1, 1, 1))
       select region, count(subject_id) as n from regions
       left join members on has_a = a and has_b = b and has_c = c group by region""",
)
def _(q: Context):
    return rs.overlap_regions(_flagged_model(q), "subject_id", COHORT.flags, ids=q.staged_cohort)


# Tests and models


def _cells_sql() -> str:
    return " union all ".join(
        f"""select '{p}' as predictor, cast({p} as varchar) as level, cast(treatment_status as varchar) as outcome,
                   count(*) as n
            from model_frame where {p} is not null and treatment_status is not null group by 2, 3"""
        for p in PREDICTORS
    )


@query("a12_crosstab", "A12", _cells_sql())
def _(q: Context):
    return st.crosstab_cells(q.model_frame, PREDICTORS, OUTCOME)


_CHI = f"""
    with cells as ({_cells_sql()}),
    grid as (
        select r.predictor, r.n as row_n, k.n as col_n, t.n as total, coalesce(c.n, 0) as n, t.levels, t.outcomes
        from (select predictor, level, sum(n) as n from cells group by 1, 2) r
        join (select predictor, outcome, sum(n) as n from cells group by 1, 2) k on k.predictor = r.predictor
        join (select predictor, sum(n) as n, count(distinct level) as levels, count(distinct outcome) as outcomes
              from cells group by 1) t on t.predictor = r.predictor
        left join cells c on c.predictor = r.predictor and c.level = r.level and c.outcome = k.outcome)
    select predictor,
           case when levels > 1 and outcomes > 1
                then round(sum(power(abs(n - row_n * col_n / total)
                                     - case when levels = 2 and outcomes = 2
                                            then least(0.5, abs(n - row_n * col_n / total)) else 0 end, 2)
                               / (row_n * col_n / total)), 9)
                when levels * outcomes > 1 then round(sum(power(n - total / (levels * outcomes), 2) / (total / (levels * outcomes))), 9)
           end as statistic,
           cast(case when levels > 1 and outcomes > 1 then (levels - 1) * (outcomes - 1)
                     else levels * outcomes - 1 end as int) as df
    from grid group by predictor, levels, outcomes, total"""


@query("m10_chi_squared", "M10 A12", _CHI)
def _(q: Context):
    return _rounded(st.chi_squared(st.crosstab_cells(q.model_frame, PREDICTORS, OUTCOME)), "statistic")


def _upper_gamma(a: str, x: str) -> str:
    """SQL for the upper regularised gamma function by the series of the lower one."""
    term = f"exp(({a} + i) * ln({x}) - {x} - lgamma(({a} + i + 1)::double))"
    series = f"1 - list_sum([{term} for i in generate_series(0, 1500)])"
    return f"case when {x} is null then null when {x} <= 0 then 1.0 else greatest(0.0, {series}) end"


@query(
    "f4_crosstab_test",
    "F4 M10",
    f"select predictor, statistic, df, round({_upper_gamma('df / 2.0', '(statistic / 2)')}, 7) as p_value from ({_CHI}) tested",
)
def _(q: Context):
    tested = st.crosstab_test(q.model_frame, PREDICTORS, OUTCOME)
    return _rounded(tested, "statistic").withColumn("p_value", F.round("p_value", 7))


@query(
    "m7_sum_contrasts",
    "M7",
    "select subject_id, insurance_plan, age_group, "
    + ", ".join(
        f"case age_group when '{level}' then 1 when '80+' then -1 else 0 end as age_group_{i}"
        for i, level in enumerate(AGE_LEVELS[:-1], 1)
    )
    + " from model_frame",
)
def _(q: Context):
    return st.sum_contrasts(q.model_frame.select("subject_id", "insurance_plan", "age_group"), "age_group", AGE_LEVELS)


@query(
    "m8_dummy_columns",
    "M8 M9",
    """select subject_id, insurance_plan, case when severity = 'severe' then 1 else 0 end as severity_severe,
              case when gender = 'M' then 1 else 0 end as gender_M
       from model_frame where severity is not null and gender is not null""",
)
def _(q: Context):
    rows = q.model_frame.select("subject_id", "insurance_plan", "severity", "gender").dropna(subset=["severity", "gender"])
    coded = st.dummies(st.dummies(rows, "severity", SEVERITIES), "gender", ("F", "M"))
    return coded.drop("severity", "gender")


@query(
    "m9_covariate_patterns",
    "M9 M1",
    f"""select treatment_status, {', '.join(PREDICTORS)}, cci, count(*) as weight from model_frame
        where severity is not null and gender is not null and age_group is not null and cci is not null
        group by all""",
)
def _(q: Context):
    return st.covariate_patterns(q.model_frame, OUTCOME, [*PREDICTORS, "cci"])


def _design(df):
    return st.design(df, OUTCOME, [*MODEL.features, "cci"], ["severity", "gender"], {"age_group": AGE_LEVELS})


# A model with as many terms as groups has closed forms: its estimates are linear in the groups'
# logits, whose variance is the sum of the reciprocal counts.


def _closed_sql(cells: str) -> str:
    """Coefficient table from (term, estimate, variance); a term without estimate is separated."""
    return f"""
        select term, round(estimate, 5) as estimate, round(sqrt(variance), 5) as std_error,
               round(estimate / sqrt(variance), 4) as z_value,
               round({_upper_gamma('0.5', '(estimate * estimate / variance / 2)')}, 5) as p_value,
               round(estimate - {st.Z_95} * sqrt(variance), 5) as ci_lower,
               round(estimate + {st.Z_95} * sqrt(variance), 5) as ci_upper,
               case when estimate is not null then 'wald' end as interval, true as converged,
               estimate is null as separated, round(exp(estimate), 5) as odds_ratio
        from ({cells}) closed"""


def _logits_sql(column: str) -> str:
    """Logit of each level, NULL where all its rows have one outcome: there it is infinite."""
    return f"""
        select level, t, n, case when t between 1 and n - 1 then ln(t / (n - t)) end as logit,
               case when t between 1 and n - 1 then 1 / t + 1 / (n - t) end as variance
        from (select {column} as level, sum(treatment_status)::double as t, count(*)::double as n
              from model_frame where {column} is not null group by {column}) counted"""


def _closed_model(q: Context, **columns):
    frame = q.model_frame
    out = st.coefficient_frame(q.spark, st.fit_logistic(frame, st.design(frame, OUTCOME, **columns)))
    fine = ("estimate", "std_error", "p_value", "ci_lower", "ci_upper", "odds_ratio")
    return out.withColumns({c: F.round(c, 5) for c in fine} | {"z_value": F.round("z_value", 4)})


@query(
    "m3_two_group_model",
    "M1 M3 M5 M8",
    _closed_sql(
        f"""select '(Intercept)' as term, logit as estimate, variance from ({_logits_sql('severity')}) a where level = 'mild'
            union all
            select 'severity_severe', b.logit - a.logit, a.variance + b.variance
            from ({_logits_sql('severity')}) a, ({_logits_sql('severity')}) b
            where a.level = 'mild' and b.level = 'severe'"""
    ),
)
def _(q: Context):
    return _closed_model(q, dummy={"severity": SEVERITIES})


@query(
    "m7_contrast_model",
    "M1 M3 M5 M7",
    _closed_sql(
        f"""with logits as ({_logits_sql('age_group')}),
                 whole as (select case when count(logit) = count(*) then avg(logit) end as mean, sum(variance) as variance,
                                  count(*) as k from logits)
            select '(Intercept)' as term, mean as estimate, case when mean is not null then variance / (k * k) end as variance from whole
            union all
            select 'age_group_' || row_number() over (order by level), logit - mean,
                   case when mean is not null then l.variance * (1 - 2.0 / k) + w.variance / (k * k) end
            from logits l, whole w qualify row_number() over (order by level) < k"""
    ),
)
def _(q: Context):
    return _closed_model(q, summed={"age_group": AGE_LEVELS})


@query("m1_logistic_model", "M1 M3 M6 M7 M8 M9")
def _(q: Context):
    frame = q.model_frame.persist()
    try:
        return st.coefficient_frame(q.spark, st.fit_logistic(frame, _design(frame)))
    finally:
        frame.unpersist()


def _totals_sql(source: str, extra: str = "") -> str:
    complete = "severity is not null and gender is not null and age_group is not null and cci is not null"
    return " union all ".join(
        f"""select {extra}'{p}' as predictor, cast({p} as varchar) as level, round(sum(treatment_status), 4)::double as treated
            from {source} where {complete} group by {p}"""
        for p in PREDICTORS
    )


def _fitted_totals(df):
    """Fitted number of treated rows by predictor and level.

    At the maximum of the likelihood it equals the observed number for every level a model has
    an own term for, which is how plain counting can check a fit.
    """
    fitted = st.fitted_outcome(df, _design(df))
    text = fitted.select("weight", "fitted", *[F.col(p).cast("string").alias(p) for p in PREDICTORS])
    cells = text.unpivot(["weight", "fitted"], list(PREDICTORS), "predictor", "level")
    return cells.groupBy("predictor", "level").agg(F.round(F.sum(F.col("weight") * F.col("fitted")), 4).alias("treated"))


@query("m1_fitted_totals", "M1 M7 M8 M9", _totals_sql("model_frame"))
def _(q: Context):
    return _fitted_totals(q.model_frame)


_JOINED = "(select m.*, has_a, has_b, has_c from model_frame m join cohort c on c.subject_id = m.subject_id) j"


@query(
    "m2_fitted_totals_by_group",
    "M2 P19",
    " union all ".join(
        _totals_sql(f"(select * from {_JOINED} where {f} = 1) g", f"'{f}' as flag, ") for f in COHORT.flags
    ),
)
def _(q: Context):
    flagged = _flagged_model(q)
    parts = []
    for f in COHORT.flags:
        part = flagged.filter(F.col(f) == 1)
        parts.append(_fitted_totals(part).select(F.lit(f).alias("flag"), "*"))
    return rs.append(*parts)


@query("m2_logistic_by_group", "M2 M3 P19")
def _(q: Context):
    flagged = _flagged_model(q).persist()
    try:
        fits = st.fit_by_group(
            flagged, COHORT.flags, OUTCOME, [*MODEL.features, "cci"], ["severity", "gender"], {"age_group": AGE_LEVELS}
        )
    finally:
        flagged.unpersist()
    parts = [st.coefficient_frame(q.spark, t).select(F.lit(f).alias("flag"), "*") for f, t in fits.items()]
    return rs.append(*parts)


def _profile_sql(column: str, contrast: str, first: int, name: str) -> str:
    """Profile limits of contrasts of the levels' logits, for a model with a term per level.

    With a contrast c held at a value, the fitted counts are t - m * c for some multiplier m, so the
    profile is a curve over m and the limit is found by halving. ``contrast`` is the weight of level i in term j.
    """
    p = "(ts[i] + side * ({m}) * cs[i]) / ns[i]"

    def rise(m: str) -> str:
        q = p.format(m=m)
        return f"""2 * list_sum([ts[i] * ln(ts[i] / ns[i] / ({q})) + (ns[i] - ts[i]) * ln((1 - ts[i] / ns[i]) / (1 - {q}))
                                 for i in generate_series(1, k)])"""

    reach = "case when side * cs[i] > 0 then (ns[i] - ts[i]) / abs(cs[i]) when cs[i] = 0 then 1e18 else ts[i] / abs(cs[i]) end"
    fine = p.format(m="near")
    return f"""
        recursive groups as (
            select list(t order by level) as ts, list(n order by level) as ns, list(level order by level) as levels, count(*) as k,
                   bool_and(t between 1 and n - 1) as fine from ({_logits_sql(column)}) l
        ), terms as (
            select *, {name} as term, [{contrast} for i in generate_series(1, k)] as cs
            from groups, (select unnest(generate_series({first}, 7)) as j) numbers where j < k + {first} - 1
        ), search as (
            select term, j, side, ts, ns, cs, k, 0.0::double as near,
                   list_min([{reach} for i in generate_series(1, k)])::double as far, 0 as step
            from terms, (values (-1), (1)) sides(side) where fine
            union all
            select term, j, side, ts, ns, cs, k, case when {rise('(near + far) / 2')} < {st.CHI2_95} then (near + far) / 2 else near end,
                   case when {rise('(near + far) / 2')} < {st.CHI2_95} then far else (near + far) / 2 end, step + 1
            from search where step < 90
        ), limits as (
            select term, side, list_sum([cs[i] * ln(({fine}) / (1 - {fine})) for i in generate_series(1, k)]) as value
            from search where step = 90
        ), found as (
            select term, levels[j] as level, fine,
                   case when fine then list_sum([cs[i] * ln(ts[i] / (ns[i] - ts[i])) for i in generate_series(1, k)]) end as estimate,
                   case when fine then list_sum([cs[i] * cs[i] * (1 / ts[i] + 1 / (ns[i] - ts[i])) for i in generate_series(1, k)]) end as variance,
                   (select value from limits l where l.term = t.term and side = -1) as lower,
                   (select value from limits l where l.term = t.term and side = 1) as upper
            from terms t
        )"""


_CONTRAST = ("case when i = j then 1.0 else 0.0 end - 1.0 / k", 1, "'age_group_' || j")
_DUMMY = ("case when i = j then 1.0 when i = 1 then -1.0 else 0.0 end", 2, "'severity_' || levels[j]")


def _limits_sql(column: str, shape: tuple) -> str:
    return f"""select term, round(estimate, 5) as estimate, round(lower, 5) as ci_lower, round(upper, 5) as ci_upper,
                      not fine as separated
               from (with {_profile_sql(column, *shape)} select * from found) closed"""


def _limits(q: Context, **columns):
    frame = q.model_frame
    out = st.coefficient_frame(q.spark, st.fit_logistic(frame, st.design(frame, OUTCOME, **columns), interval="profile"))
    out = out.filter(F.col("term") != st.INTERCEPT).select("term", "estimate", "ci_lower", "ci_upper", "separated")
    return out.withColumns({c: F.round(c, 5) for c in ("estimate", "ci_lower", "ci_upper")})


@query("m4_contrast_limits", "M4 M7", _limits_sql("age_group", _CONTRAST))
def _(q: Context):
    return _limits(q, summed={"age_group": AGE_LEVELS})


@query("m4_two_group_limits", "M4 M8", _limits_sql("severity", _DUMMY))
def _(q: Context):
    return _limits(q, dummy={"severity": SEVERITIES})


_COMPLETE = "severity is not null and gender is not null and age_group is not null and cci is not null"


@query(
    "m4_profile_certificate",
    "M4 M3",
    f"""with used as (select * from model_frame where {_COMPLETE}),
             terms as (
                 {" union all ".join(f"select '{c}' as term from used having count(distinct {c}) > 1" for c in (*MODEL.features, "cci"))}
                 union all select 'severity_severe' from used having count(distinct severity) > 1
                 union all select 'gender_M' from used having count(distinct gender) > 1
                 union all select 'age_group_' || unnest(generate_series(1, count(distinct age_group) - 1)) from used)
        select term, side, true as reached, true as beyond, {round(st.CHI2_95, 5)}::double as deviance_rise, 0.0::double as steepest
        from terms, (values ('lower'), ('upper')) sides(side)""",
)
def _(q: Context):
    """Every limit of the large model, evaluated anew: the check holds what a profile limit must be."""
    frame = q.model_frame.persist()
    try:
        found = st.profile_certificate(frame, _design(frame)).drop("limit")
    finally:
        frame.unpersist()
    return found.withColumns({c: F.round(c, 5) for c in ("deviance_rise", "steepest")})


@query(
    "f5_contrast_plot",
    "F5 M4 M5 M7",
    f"""select level || ' vs age_group grand mean' as term, round(estimate, 5) as coefficient, round(lower, 5) as lower,
               round(upper, 5) as upper, coalesce(abs(estimate) / sqrt(variance) > {st.Z_95}, false) as significant
        from (with {_profile_sql("age_group", *_CONTRAST)} select * from found) closed""",
)
def _(q: Context):
    frame = q.model_frame
    d = st.design(frame, OUTCOME, summed={"age_group": AGE_LEVELS})
    out = _plot(q, st.plot_table(st.fit_logistic(frame, d, interval="profile"), "age_group", d.summed["age_group"]))
    return out.withColumns({c: F.round(c, 5) for c in ("coefficient", "lower", "upper")})


def _plot(q: Context, rows: list[dict]):
    return q.spark.createDataFrame(
        [(r["group"], r["coefficient"], r["lower"], r["upper"], r["significant"]) for r in rows],
        "term string, coefficient double, lower double, upper double, significant boolean",
    )


@query("m4_profile_intervals", "M4 M3")
def _(q: Context):
    frame = q.model_frame.persist()
    try:
        return st.coefficient_frame(q.spark, st.fit_logistic(frame, _design(frame), interval="profile"))
    finally:
        frame.unpersist()


@query("f5_coefficient_plot_table", "F5 M5")
def _(q: Context):
    frame = q.model_frame.persist()
    try:
        d = _design(frame)
        return _plot(q, st.plot_table(st.fit_logistic(frame, d, interval="profile"), "age_group", d.summed["age_group"]))
    finally:
        frame.unpersist()
