"""Generic, reusable DataFrame operators (column names are parameters)."""

from slotwise.operators.band import band_join
from slotwise.operators.latest import latest_by_key
from slotwise.operators.rules import first_failure
from slotwise.operators.topn import top_n_per_group

__all__ = [
    "band_join",
    "first_failure",
    "latest_by_key",
    "top_n_per_group",
]
