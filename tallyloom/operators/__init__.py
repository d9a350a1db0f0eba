from tallyloom.operators.constraints import (
    Constraints,
    constraint_rules,
    count_violations,
    observe_rules,
    observed_metrics,
)
from tallyloom.operators.latest import latest_per_key
from tallyloom.operators.prefilter import KeyFilter
from tallyloom.operators.quality import (
    QualityError,
    first_cell_rule,
    null_rules,
    require,
    require_observed,
    row_count_rules,
    scalar_rule,
)
from tallyloom.operators.tally import count_outcomes, count_per_key, tally, tally_counts

__all__ = [
    "Constraints",
    "KeyFilter",
    "QualityError",
    "constraint_rules",
    "count_outcomes",
    "count_per_key",
    "count_violations",
    "first_cell_rule",
    "latest_per_key",
    "null_rules",
    "observe_rules",
    "observed_metrics",
    "require",
    "require_observed",
    "row_count_rules",
    "scalar_rule",
    "tally",
    "tally_counts",
]
