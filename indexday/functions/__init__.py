from indexday.functions.expressions import (
    any_flag,
    bin_labels,
    categorize,
    code_matches,
    cut,
    days_between,
    in_interval,
    in_window,
    label_to_flag,
    matched,
    relabel,
    strip_prefix,
    threshold_label,
    year_age,
)
from indexday.functions.distributions import chi_squared_tail, normal_two_sided

__all__ = [
    "any_flag",
    "bin_labels",
    "categorize",
    "chi_squared_tail",
    "code_matches",
    "cut",
    "days_between",
    "in_interval",
    "in_window",
    "label_to_flag",
    "matched",
    "normal_two_sided",
    "relabel",
    "strip_prefix",
    "threshold_label",
    "year_age",
]
