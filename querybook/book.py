"""The registered queries: each an operator on the test tables, with its check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexday.operators.concepts import code_map, concepts_below, in_concepts
from indexday.operators.features import as_covariates, comorbidity_score
from indexday.operators.reshape import with_total
from indexday.plans import study
from indexday.session import tune
from indexday.sources import StageStore, Tables
from querybook.binding import bind, score_weights
from querybook.oracle import with_relations
from querybook.params import COHORT, MODEL, SERVICE_CONCEPTS, STRATA, STUDY


class Context:
    """The relations and study frames a query reads, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        self.t: Tables = bind(spark, sf_dir)

    def source(self, name: str) -> DataFrame:
        """A test table as it is."""
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def weights(self) -> DataFrame:
        return score_weights(self.spark, self.sf_dir)

    @cached_property
    def qualifying(self) -> DataFrame:
        return study.select_events(COHORT, self.t)

    @cached_property
    def cohort(self) -> DataFrame:
        return study.build_cohort(COHORT, self.t, self.qualifying)

    @cached_property
    def store(self) -> StageStore:
        return StageStore(self.spark)

    @cached_property
    def staged_cohort(self) -> DataFrame:
        """The cohort written out, for queries that read it more than once."""
        return self.store.put("cohort", self.cohort)

    @cached_property
    def target(self) -> DataFrame:
        return study.target_population(self.cohort, COHORT.flags)

    @cached_property
    def staged_target(self) -> DataFrame:
        return study.target_population(self.staged_cohort, COHORT.flags)

    @cached_property
    def features(self) -> DataFrame:
        return study.build_features(STUDY, self.t, self.cohort)

    @cached_property
    def coverage(self) -> DataFrame:
        return study.build_coverage(STUDY, self.t, self.cohort)

    def _scores(self, cohort: DataFrame) -> DataFrame:
        return as_covariates(comorbidity_score(cohort, self.t.condition_occurrence, self.weights), 1)

    @cached_property
    def covariates(self) -> DataFrame:
        return self._scores(self.cohort)

    @cached_property
    def scored(self) -> DataFrame:
        """Features with score and coverage, before imputation, written out."""
        cohort = self.staged_cohort
        scores = self._scores(cohort).select(F.col("rowId").alias("subject_id"), F.col("covariateValue").alias("cci"))
        features = study.build_features(STUDY, self.t, cohort)
        coverage = study.build_coverage(STUDY, self.t, cohort)
        return self.store.put("scored", features.join(scores, "subject_id", "left").join(coverage, "subject_id"))

    @cached_property
    def model_frame(self) -> DataFrame:
        cohort = self.staged_cohort
        return study.build_model_frame(
            study.build_features(STUDY, self.t, cohort),
            self._scores(cohort),
            study.build_coverage(STUDY, self.t, cohort),
            MODEL,
            store=self.store,
        )

    @cached_property
    def long_frame(self) -> DataFrame:
        flags = self.staged_cohort.select("subject_id", *COHORT.flags)
        return study.build_long_frame(flags, self.model_frame, COHORT.flags, "condition_group").select(
            "condition_group", *STRATA
        )

    @cached_property
    def strata(self) -> DataFrame:
        return with_total(self.long_frame, "condition_group", STRATA)

    @cached_property
    def services(self) -> DataFrame:
        return self.t.procedure_occurrence.filter(F.col("procedure_concept_id").isin(*SERVICE_CONCEPTS))

    @cached_property
    def index_conditions(self) -> DataFrame:
        ids = concepts_below(self.t.concept_ancestor, self.t.concept, COHORT.event_ancestors)
        return in_concepts(self.t.condition_occurrence, "condition_concept_id", ids)

    @property
    def code_map(self) -> DataFrame:
        return code_map(self.t.concept, MODEL.code_groups)


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Context], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Context(spark, sf_dir))


BOOK: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query under a name, with the inventory ids it covers and its check SQL."""

    def add(build: Callable[[Context], DataFrame]):
        if name in BOOK:
            raise ValueError(f"query {name} is there already")
        BOOK[name] = Query(name, tuple(covers.split()), build, with_relations(sql) if sql else None)
        return build

    return add
