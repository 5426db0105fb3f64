"""Parameters of a study, kept apart from the operators that use them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CodeSet:
    """A named set of concept ids."""

    name: str
    ids: tuple[int, ...]


@dataclass(frozen=True)
class CodeGroup:
    """A named set of concepts chosen by source code, with its window around the index date.

    A code belongs to the group when it equals one of ``codes``, or when it is one of
    ``prefixes`` either on its own or followed by a dot and a letter or digit.
    ``before`` and ``after`` are days, both ends included.
    """

    name: str
    prefixes: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    before: int = 180
    after: int = 30
    vocabulary: str | None = None


@dataclass(frozen=True)
class CategoryRule:
    """One branch of an ordered mapping: the first rule that matches gives the label."""

    label: str
    ids: tuple[int, ...] = ()
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class CohortSpec:
    """Who enters the cohort, and on which date."""

    encounter_ancestors: tuple[int, ...]
    event_ancestors: tuple[int, ...]
    flag_sets: tuple[CodeSet, ...]
    destinations: tuple[CategoryRule, ...]
    confirm_days: int = 180
    observed_before: int = 180
    observed_after: int = 180
    milestone_days: int = 180
    definition_id: int = 1
    strict_flags: bool = False

    @property
    def flags(self) -> tuple[str, ...]:
        return tuple(s.name for s in self.flag_sets)


@dataclass(frozen=True)
class ModelSpec:
    """Outcome, features and coverage measured on the cohort."""

    procedure_codes: tuple[str, ...]
    outcome_column: str
    outcome_labels: tuple[str, str]
    code_groups: tuple[CodeGroup, ...]
    severity_days: int
    severity_labels: tuple[str, str]
    coverage_rules: tuple[CategoryRule, ...]
    age_breaks: tuple[int, ...] = (18, 30, 40, 50, 60, 70, 80)
    min_age: int = 18

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(g.name for g in self.code_groups)


@dataclass(frozen=True)
class StudySpec:
    cohort: CohortSpec
    model: ModelSpec
