"""Joins and checks that hold when one key carries a large share of the rows."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from feedmill.operators.limits import LIMITS
from feedmill.operators.storage import known_size, materialised, size_of_rows


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the biggest group; counts are combined before the shuffle."""
    row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()
    return row["n"] or 0


def small_enough(df: DataFrame) -> bool:
    """Checked size bound for a broadcast of ``df``: its rows and the sum of their real widths.

    Known from when it was written (``storage.materialised(..., sized=True)``), else one
    distributed aggregation that moves two numbers per task.
    """
    n, size = known_size(df) or df.agg(*size_of_rows(df)).first()
    return n <= LIMITS.broadcast_max_rows and (size or 0) <= min(LIMITS.broadcast_max_bytes, LIMITS.lookup_max_bytes)


def parts_of(spark: SparkSession, rows: int) -> int | None:
    """Partitions for a shuffle of ``rows`` rows where the session's would hold more than LIMITS.partition_rows each; else None."""
    wanted = -(-rows // LIMITS.partition_rows)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def dealt_by(df: DataFrame, keys: list[str], parts: int | None) -> DataFrame:
    """``df`` dealt by ``keys`` to so many partitions, or as it is for None: the operator behind it then shuffles by the session's settings."""
    return df if parts is None else df.repartition(parts, *keys)


def fits_a_task(rows: int) -> bool:
    """Whether a group of ``rows`` rows may be sorted by one task."""
    return rows <= LIMITS.group_max_rows


def fits_a_list(items: int) -> bool:
    """Whether ``items`` values may be kept as a list in one record."""
    return items <= LIMITS.list_max_items


def hot_keys(df: DataFrame, key: str) -> list:
    """Keys holding more rows than LIMITS.hot_min_rows and LIMITS.hot_share of all rows.

    One pass with a frequent-items sketch per task.  At most ``1 / hot_share``
    keys can qualify.  The answer only decides how rows are routed, never which
    rows a result has, so the sketch's error does not matter for correctness.
    """
    k = int(1 / LIMITS.hot_share)
    found = df.agg(
        F.expr(f"approx_top_k(`{key}`, {k}, {k * 100})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    floor = max(LIMITS.hot_min_rows, LIMITS.hot_share * found["n"])
    return [t["item"] for t in found["top"] if t["count"] > floor and t["item"] is not None]


_KINDS = {"inner": "inner", "left": "left", "leftouter": "left", "right": "right", "rightouter": "right", "full": "full",
          "outer": "full", "fullouter": "full", "semi": "left_semi", "leftsemi": "left_semi", "anti": "left_anti", "leftanti": "left_anti"}


def _dealt(rows: DataFrame, keys: list[str], own: str, own_cells: str, other: str, other_cells: str) -> DataFrame:
    """Rows dealt evenly over the cells of their own side and repeated for those of the other side.

    Equal rows are dealt apart as well, by their place in the table; written first, so
    that a task that runs again deals alike.
    """
    place = F.pmod(F.monotonically_increasing_id(), F.col(own_cells)).alias(own)
    others = F.expr(f"sequence(0L, {other_cells} - 1)").alias("_others")
    values = [c for c in rows.columns if c not in (own_cells, other_cells)]
    written = materialised(rows.select(*values, place, others), "dealt")
    return written.withColumn(other, F.explode("_others")).drop("_others")


def join_tables(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Any join of two tables on equal columns, also where a key has very many rows on both sides.

    Columns come as from ``left.join(right, on, how)``.  Without a hot key (see :func:`hot_keys`) on either side it is that join.
    Otherwise rows of hot keys are split off.  A hot key that both sides have makes a
    grid of cells: each row is dealt to one cell of its own side and repeated for all of the other, so every pair meets
    once and no task sees more than about LIMITS.hot_cell_rows of either side.  All these rows have a
    partner, so an outer join has nothing to add.  Rows of a hot key that the other side lacks, and
    rows with a null in a key, match nothing: they are kept or left out without a shuffle.

    Both sides are read once to find hot keys: write an expensive one out first.  Use
    :func:`lookup_join` where the right side has one row per key.
    """
    kind = _KINDS.get(how.lower().replace("_", ""))
    if kind is None:
        raise ValueError(f"how must be one of {sorted(set(_KINDS.values()))}, not {how!r}")
    on = [on] if isinstance(on, str) else list(on)
    one_sided = kind in ("left_semi", "left_anti")
    names = [*on, *[c for c in left.columns if c not in on], *([] if one_sided else [c for c in right.columns if c not in on])]

    def own_names(df, prefix):
        values = [c for c in df.columns if c not in on]
        columns = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(on)] + [F.col(f"`{c}`").alias(f"{prefix}{i}") for i, c in enumerate(values)]
        return df.select(*columns)

    l, r = own_names(left, "_l"), own_names(right, "_r")
    keys = [f"_k{i}" for i in range(len(on))]
    # Both sides hash a key as the type in which the join compares it.
    common = l.select(*keys).union(r.select(*keys)).schema
    if any(isinstance(l.schema[k].dataType, T.StringType) != isinstance(r.schema[k].dataType, T.StringType) for k in keys):
        return left.join(right, on, kind)
    hashed, complete = F.xxhash64(*[F.col(k).cast(common[k].dataType) for k in keys]), F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    hot = sorted({h for df in (l, r) for h in hot_keys(df.where(complete).select(hashed.alias("_hash")), "_hash")})
    if not hot:
        return left.join(right, on, kind)

    is_hot = complete & hashed.isin(hot)
    is_cold = complete & ~hashed.isin(hot)
    columns = [*l.columns, *([] if one_sided else [c for c in r.columns if c not in keys])]

    def alone(rows, other):
        """Rows without a partner, with nulls for the other side."""
        nulls = {f.name: F.lit(None).cast(f.dataType) for f in other.schema if f.name not in keys and f.name in columns}
        return rows.withColumns(nulls).select(*columns)

    counted = [df.where(is_hot).groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for df, n in ((l, "_nl"), (r, "_nr"))]
    # As many rows as there are hot keys.
    cells = [F.expr(f"cast(ceil({n} / {LIMITS.hot_cell_rows}) as bigint)").alias(c) for n, c in (("_nl", "_cl"), ("_nr", "_cr"))]
    both = F.broadcast(materialised(counted[0].join(counted[1], keys).select(*keys, *cells), "hot-keys"))
    hot_l, hot_r = l.where(is_hot), r.where(is_hot)

    parts = [l.where(is_cold).join(r.where(is_cold), keys, kind).select(*columns)]
    if kind == "left_semi":
        parts.append(hot_l.join(both, keys, "left_semi"))
    elif kind != "left_anti":
        grid_l = _dealt(hot_l.join(both, keys), keys, "_a", "_cl", "_b", "_cr")
        grid_r = _dealt(hot_r.join(both, keys), keys, "_b", "_cr", "_a", "_cl")
        parts.append(grid_l.join(grid_r, [*keys, "_a", "_b"]).select(*columns))
    if kind in ("left", "full", "left_anti"):
        parts += [alone(hot_l.join(both, keys, "left_anti"), r), alone(l.where(~complete), r)]
    if kind in ("right", "full"):
        parts += [alone(hot_r.join(both, keys, "left_anti"), l), alone(r.where(~complete), l)]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part.select(*columns))
    return joined.toDF(*names)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to a table with at most one row per key.

    A right side within the checked broadcast bound is broadcast, so ``left`` is
    not shuffled at all.  A larger one is shuffled; keys that are hot in ``left``
    are split off first and joined by broadcasting just their rows of ``right``
    (no more than ``hot_keys`` can give), so no task receives a hot key whole.  Rows
    without a key match nothing: they are never shuffled.

    ``right`` is counted first, so write an expensive one out with
    ``storage.materialised``.  ``hot_from`` names a table with the keys in about
    the same shares that is cheaper to read than ``left``, for finding hot keys.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    if small_enough(right):
        return left.join(F.broadcast(right), on, how)
    keys = hot_keys(left if hot_from is None else hot_from, on)
    is_hot = F.col(on).isin(keys) if keys else F.lit(False)
    joined = left.where(F.col(on).isNotNull() & ~is_hot).join(right, on, how)
    if keys:
        joined = joined.unionByName(left.where(is_hot).join(F.broadcast(right.where(F.col(on).isin(keys))), on, how))
    if how == "inner":
        return joined
    missing = {f.name: F.lit(None).cast(f.dataType) for f in right.schema if f.name != on}
    return joined.unionByName(left.where(F.col(on).isNull()).withColumns(missing).select(*joined.columns))
