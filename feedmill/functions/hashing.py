"""Seeded hashes: reproducible randomness that does not depend on partitioning."""

from pyspark.sql import Column, functions as F


# Stands for a null key, so that keys of several columns stay apart.
NULL_MARK = "null"


def _col(part):
    return part if isinstance(part, Column) else F.lit(part)


def seeded_md5(seed, *parts) -> Column:
    """Hex md5 of ``seed|part|part...``; sorting by it is a seeded shuffle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(_col(p).cast("string"), F.lit(NULL_MARK)) for p in parts]))


def seeded_int(seed, *parts) -> Column:
    """A bigint in [0, 2^32), the first eight hex digits of :func:`seeded_md5`."""
    return F.conv(F.substring(seeded_md5(seed, *parts), 1, 8), 16, 10).cast("bigint")
