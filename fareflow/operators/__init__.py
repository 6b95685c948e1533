from .copies import copy_order, first_copies, later_copies, stream_first_copies, unseen
from .lookup import checked_lookup, enrich_zone, zone_lookup
from .rules import count_violations, expect_or_drop, observe_rules

__all__ = [
    "checked_lookup",
    "copy_order",
    "count_violations",
    "enrich_zone",
    "expect_or_drop",
    "first_copies",
    "later_copies",
    "observe_rules",
    "stream_first_copies",
    "unseen",
    "zone_lookup",
]
