"""Text, duration and struct expressions."""

from pyspark.sql import Column, functions as F, types as T


def tokens(text: Column, at_most: int | None = None) -> Column:
    """Whitespace tokens of the whole text, case kept, empties dropped.

    With ``at_most`` the text is only split as far as that many tokens need.
    """
    # A first piece can be empty and the last one is the unsplit rest.
    limit = -1 if at_most is None else at_most + 2
    pieces = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+", limit), lambda t: t != "")
    return pieces if at_most is None else F.slice(pieces, 1, at_most)


def joined_with_space(*columns: Column) -> Column:
    """Columns joined by one space; null when any of them is null."""
    parts = []
    for c in columns:
        parts += [F.lit(" "), c]
    return F.concat(*parts[1:])


def duration_text(interval: Column) -> Column:
    """``D days H:M:S`` without zero padding, from a day-time interval.

    Days are floored, so the clock part is never negative; fractions of a second
    are cut off.
    """
    seconds = F.floor(
        F.extract(F.lit("DAY"), interval).cast("bigint") * 86400
        + F.extract(F.lit("HOUR"), interval) * 3600
        + F.extract(F.lit("MINUTE"), interval) * 60
        + F.extract(F.lit("SECOND"), interval).cast("decimal(18,6)")
    ).cast("bigint")
    rest = F.pmod(seconds, F.lit(86400))
    days = (seconds - rest) / 86400
    return F.concat(
        days.cast("bigint").cast("string"),
        F.lit(" days "),
        F.floor(rest / 3600).cast("string"),
        F.lit(":"),
        F.floor(F.pmod(rest, F.lit(3600)) / 60).cast("string"),
        F.lit(":"),
        F.pmod(rest, F.lit(60)).cast("string"),
    )


def flattened_columns(schema: T.StructType, source: str = "", name: str = "") -> list[Column]:
    """One column per leaf of a nested schema, named child-parent-grandparent."""
    out = []
    for field in schema.fields:
        path = f"{source}.`{field.name}`" if source else f"`{field.name}`"
        label = f"{field.name}-{name}" if name else field.name
        if isinstance(field.dataType, T.StructType):
            out += flattened_columns(field.dataType, path, label)
        else:
            out.append(F.col(path).alias(label))
    return out
