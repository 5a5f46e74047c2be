"""Size bounds that decide between two ways of doing the same work.

Results never depend on them: each bound is checked, and beyond it another exact
way takes over.
"""

from dataclasses import dataclass


@dataclass
class Limits:
    # A join key is treated apart above this many rows and above this share of all rows.
    hot_min_rows: int = 200_000
    hot_share: float = 0.005
    # Rows of either side of a hot key that one task of a join meets.
    hot_cell_rows: int = 10_000
    # Rows of a shuffle partition that a task joins, merges and sorts; larger tables get more partitions.
    partition_rows: int = 500_000
    # A lookup table within both bounds may be broadcast.
    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 512 * 1024 * 1024
    # The same for a table that rows look their id up in: every task counts it as its own memory, the driver collects it.
    lookup_max_bytes: int = 64 * 1024 * 1024
    # The largest group sorted inside one task.
    group_max_rows: int = 1_000_000
    # The longest list built in one record; looking ids up in a list is linear in it.
    list_max_items: int = 10_000
    # The most values that a line of a prediction file may have; its format allows no second way.
    line_max_values: int = 10_000_000


LIMITS = Limits()
