"""Small helpers that the corpus operators share."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The white space of the contracts, the letters that are lower-cased.
WHITE_SPACE = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def text_hash(text: Column, salt: int) -> Column:
    """64 bits of ``text``; two salts together identify a text."""
    return F.xxhash64(F.lit(salt), text)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other characters as they are.

    ``lower`` does just that on a text of one byte per character, and is many times faster than ``translate``.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def bytes_of(df: DataFrame, width: Column) -> int:
    """The summed size of the rows of ``df``, from their real widths."""
    return df.agg(F.sum(width)).first()[0] or 0
