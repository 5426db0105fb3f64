"""The claims relations an analysis reads, and the columns each must have."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Relation and column names of the public common data model that is read.
RELATIONS: dict[str, dict[str, str]] = {
    "condition_occurrence": {
        "condition_occurrence_id": "int",
        "person_id": "int",
        "condition_concept_id": "int",
        "condition_start_date": "date",
        "condition_end_date": "date",
        "visit_occurrence_id": "int",
        "condition_source_concept_id": "int",
    },
    "visit_occurrence": {
        "visit_occurrence_id": "int",
        "person_id": "int",
        "visit_concept_id": "int",
        "visit_start_date": "date",
        "visit_end_date": "date",
        "discharge_to_concept_id": "int",
        "provider_id": "int",
    },
    "concept": {"concept_id": "int", "concept_code": "string", "concept_name": "string"},
    "concept_ancestor": {"ancestor_concept_id": "int", "descendant_concept_id": "int"},
    "observation_period": {
        "observation_period_id": "int",
        "person_id": "int",
        "observation_period_start_date": "date",
        "observation_period_end_date": "date",
    },
    "procedure_occurrence": {
        "person_id": "int",
        "procedure_date": "date",
        "procedure_source_value": "string",
        "procedure_concept_id": "int",
    },
    "person": {
        "person_id": "int",
        "year_of_birth": "int",
        "gender_source_value": "string",
        "location_id": "int",
    },
    "payer_plan_period": {
        "person_id": "int",
        "payer_concept_id": "int",
        "payer_source_value": "string",
        "payer_plan_period_start_date": "date",
        "payer_plan_period_end_date": "date",
    },
    "location": {"location_id": "int", "state": "string"},
    "provider": {"provider_id": "int", "specialty_source_value": "string"},
    "measurement": {"person_id": "int", "measurement_concept_id": "int", "measurement_date": "date"},
    "observation": {"person_id": "int"},
    "device_exposure": {"person_id": "int", "device_concept_id": "int"},
}

_KINDS = {
    "int": (T.IntegerType, T.LongType, T.ShortType),
    "date": (T.DateType,),
    "string": (T.StringType, T.VarcharType, T.CharType),
}


class ContractError(ValueError):
    """A relation lacks a column, or has it with another type."""


def check_relation(name: str, df: DataFrame) -> DataFrame:
    """Return ``df`` unchanged when its schema has the columns the relation needs.

    Only the schema is read. Dates must be DATE: a timestamp would turn day windows into
    windows of hours.
    """
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    wrong = []
    for column, kind in RELATIONS[name].items():
        if column not in have:
            wrong.append(f"{column} is missing")
        elif not isinstance(have[column], _KINDS[kind]):
            wrong.append(f"{column} is {have[column].simpleString()}, expected {kind}")
    if wrong:
        raise ContractError(f"{name}: " + "; ".join(wrong))
    return df


def rows_without_date(df: DataFrame, *dates: str) -> DataFrame:
    """Number of rows with a NULL in each date column, as one row.

    The operators leave events without a date out of account. This reports how many there are.
    """
    return df.agg(*[F.count_if(F.col(d).isNull()).alias(d) for d in dates])


_PARTITIONING = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(schema: str, name: str, common: Mapping[str, str], own: Mapping[str, str]) -> dict[str, str]:
    """Reader options of one relation; a partitioning is given in full or not at all."""
    merged = {**common, **own, "dbtable": f"{schema}.{name}"}
    given = [k for k in _PARTITIONING[:3] if k in merged]
    if given and len(given) + ("numPartitions" in merged) < len(_PARTITIONING):
        raise ValueError(f"{name}: a partitioned read needs {', '.join(_PARTITIONING)}")
    return merged


def cuts_query(table: str, column: str, parts: int) -> str:
    """A subquery with the least key of each of ``parts`` equal shares of a table's rows, in standard SQL."""
    shares = f"SELECT {column} AS k, NTILE({parts}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    return f"(SELECT part, MIN(k) AS cut FROM ({shares}) shares GROUP BY part) cuts"


def _literal(value: object) -> str:
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no key value: {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return f"{'TIMESTAMP' if isinstance(value, dt.datetime) else 'DATE'} '{value}'"
    return "'" + str(value).replace("'", "''") + "'"


def balanced_predicates(column: str, cuts: Sequence[object]) -> list[str]:
    """Conditions that deal all rows to ranges which begin at the cuts, each row to one; NULL keys go with the first.

    Equal cuts, as a key with more rows than a share gives, are one cut.
    """
    starts = [_literal(c) for c in sorted(set(cuts))[1:]]
    if not starts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(starts, starts[1:])]
    return [f"({column} < {starts[0]} OR {column} IS NULL)", *middle, f"{column} >= {starts[-1]}"]


class Tables(Mapping[str, DataFrame]):
    """The relations of one database; each is resolved and checked on first use."""

    def __init__(self, reader: Callable[[str], DataFrame], check: bool = True):
        self._reader = reader
        self._check = check
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Tables:
        return cls(lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}"))

    @classmethod
    def from_catalog(cls, spark: SparkSession, schema: str) -> Tables:
        return cls(lambda name: spark.table(f"{schema}.{name}"))

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        schema: str,
        per_table: Mapping[str, Mapping[str, str]] | None = None,
        balanced: Mapping[str, tuple[str, int]] | None = None,
        **options: str,
    ) -> Tables:
        """``options`` hold for all relations, ``per_table`` for single ones.

        A relation is read in parallel with its own ``partitionColumn``, ``lowerBound``,
        ``upperBound`` and ``numPartitions``, or as ``balanced`` names it: (key column, parts). Then the database is asked
        once for the keys that cut its rows into equal shares, and each share is read by a task of its own, however
        unevenly the keys are spread. Relations without either are read by one task.
        """
        chosen = {name: jdbc_options(schema, name, options, (per_table or {}).get(name, {})) for name in RELATIONS}
        for name in balanced or {}:
            if name not in RELATIONS:
                raise KeyError(name)
            if "partitionColumn" in chosen[name]:
                raise ValueError(f"{name}: either a partition column or balanced parts")

        def read(name: str) -> DataFrame:
            own = chosen[name]
            if name not in (balanced or {}):
                return spark.read.format("jdbc").options(**own).load()
            column, parts = balanced[name]
            asked = {k: v for k, v in own.items() if k not in _PARTITIONING}
            cuts = spark.read.format("jdbc").options(**{**asked, "dbtable": cuts_query(own["dbtable"], column, parts)}).load()
            predicates = balanced_predicates(column, [r["cut"] for r in cuts.collect()])
            rest = {k: v for k, v in asked.items() if k not in ("url", "dbtable")}
            return spark.read.jdbc(own["url"], own["dbtable"], predicates=predicates, properties=rest)

        return cls(read)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RELATIONS:
            raise KeyError(name)
        if name not in self._frames:
            frame = self._reader(name)
            self._frames[name] = check_relation(name, frame) if self._check else frame
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in RELATIONS:
            return self[name]
        raise AttributeError(name)

    def __iter__(self):
        return iter(RELATIONS)

    def __len__(self) -> int:
        return len(RELATIONS)
