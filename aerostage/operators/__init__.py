"""Reusable DataFrame operators."""

from aerostage.operators.dedup import asc, desc, keep_first, rank_within  # noqa: F401
from aerostage.operators.nested import align, explode_array, flatten, select_paths  # noqa: F401
from aerostage.operators.pair_merge import pair_merge  # noqa: F401
from aerostage.operators.surrogate import global_row_number  # noqa: F401
