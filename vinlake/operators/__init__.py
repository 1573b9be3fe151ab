"""Relational building blocks that hold up when one key owns a third of the rows."""

from vinlake.operators.hot_groups import Keep, as_planned, attach, in_folder, per_slice, slices_used, with_slice
from vinlake.operators.joins import left_join_splittable
from vinlake.operators.latest import first_per_key, latest_per_key
from vinlake.operators.repeats import flag_repeats
from vinlake.operators.unknown_keys import flag_unknown

__all__ = [
    "Keep",
    "as_planned",
    "attach",
    "first_per_key",
    "flag_repeats",
    "flag_unknown",
    "in_folder",
    "latest_per_key",
    "left_join_splittable",
    "per_slice",
    "slices_used",
    "with_slice",
]
