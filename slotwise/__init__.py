"""slotwise: a Spark-native engine that pairs over-subscribed slots with
under-used larger ones and publishes advisory swaps.

Every stage is a DataFrame -> DataFrame function; Catalyst plans the work.
"""

from slotwise.params import Params

__all__ = ["Params"]
