"""Plan shapes that keep order-dependent work spread over many tasks."""

from tidemill.plans.decay import decayed_sum
from tidemill.plans.lookup import lookup_join, param_join
from tidemill.plans.ordered import asof_fill, exact_quantiles, prefix_sum, previous, running
from tidemill.plans.scratch import materialize, scratch_path

__all__ = [
    "asof_fill",
    "decayed_sum",
    "exact_quantiles",
    "lookup_join",
    "materialize",
    "param_join",
    "prefix_sum",
    "previous",
    "running",
    "scratch_path",
]
