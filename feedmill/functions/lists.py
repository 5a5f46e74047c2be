"""Operators on one list column, as expressions over a single row.

They work unchanged on batch and streaming DataFrames and never shuffle.  A row
is one record, so the list is as long as it was stored.  Membership tests scan
the clicked list once per element: meant for lists up to some ten thousand ids.
"""

from pyspark.sql import Column, DataFrame, functions as F

from feedmill.functions.hashing import seeded_int, seeded_md5


def fail(*message) -> Column:
    """Raise an error for the row when evaluated.

    The empty piece of a uuid makes the expression nondeterministic, which keeps
    the optimizer from evaluating it ahead of a filter that removes the row.
    """
    return F.raise_error(F.concat(*message, F.substring(F.uuid(), 1, 0)))


def explode_rows(df: DataFrame, keep: list, items, pos: str, value: str) -> DataFrame:
    """One row per list element with its 0-based ``pos``; empty and null lists give none.

    A plain explode makes the optimizer filter on the list beforehand, which
    evaluates a computed list twice; the outer form with the filter behind it
    evaluates it once.
    """
    return df.select(*keep, F.posexplode_outer(items).alias(pos, value)).where(F.col(pos).isNotNull())


def _clicked_or_empty(clicked: Column, inview: Column) -> Column:
    return F.coalesce(clicked, F.slice(inview, 1, 0))


def binary_labels(inview: Column, clicked: Column) -> Column:
    """1 for each in-view id that was clicked, else 0.  No clicked list means no click."""
    return F.transform(
        inview,
        lambda x: F.coalesce(F.array_contains(clicked, x), F.lit(False)).cast("tinyint"),
    )


def without_clicked(inview: Column, clicked: Column) -> Column:
    """In-view ids that were not clicked, in order, duplicates kept."""
    seen = _clicked_or_empty(clicked, inview)
    return F.filter(inview, lambda x: ~F.coalesce(F.array_contains(seen, x), F.lit(False)))


def tail(items: Column, n: int) -> Column:
    """The last ``n`` elements; lists are expected oldest first."""
    return F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), F.lit(n))


def tail_padded(items: Column, n: int, padding) -> Column:
    """The last ``n`` elements, padded on the left to exactly ``n``.  Null stays null."""
    return F.slice(F.concat(F.array_repeat(F.lit(padding), n), items), -n, n)


def pad_right(items: Column, n: int, padding) -> Column:
    """The first ``n`` elements, padded on the right to exactly ``n``."""
    return F.slice(F.concat(items, F.array_repeat(F.lit(padding), n)), 1, n)


def shuffled(items: Column, seed, *key) -> Column:
    """``items`` in the order of md5(seed, key, position)."""
    tagged = F.transform(
        items, lambda x, i: F.struct(seeded_md5(seed, *key, i + 1).alias("h"), i.alias("i"), x.alias("x"))
    )
    return F.transform(F.sort_array(tagged), lambda t: t["x"])


def sampled_without_replacement(items: Column, n: int, seed, *key) -> Column:
    """``n`` distinct positions of ``items``; fails when the list is shorter than ``n``."""
    return (
        F.when(items.isNull() | (F.size(items) >= n), F.slice(shuffled(items, seed, *key), 1, n))
        .otherwise(fail(F.lit(f"cannot draw {n} items without replacement from a shorter list")))
    )


def sampled_with_replacement(items: Column, n: int, seed, *key) -> Column:
    """``n`` independent draws from ``items``; an empty list gives ``n`` nulls."""
    def draw(j):
        at = F.pmod(seeded_int(seed, *key, j), F.size(items)) + 1
        return F.when(F.size(items) > 0, F.get(items, (at - 1).cast("int")))

    return F.transform(F.sequence(F.lit(1), F.lit(n)), draw)


def negatives_per_click(pool: Column, n: int, with_replacement: bool, seed, key: Column, click_pos: Column) -> Column:
    """``n`` unclicked ids for one click.

    With replacement each draw hashes to a pool position.  Without, the pool is
    read in shuffled order from a hashed starting point, wrapping around: ``n``
    distinct positions for the price of ``n`` lookups per click.
    """
    if with_replacement:
        return sampled_with_replacement(pool, n, seed, key, click_pos)
    size = F.size(pool)
    start = F.pmod(seeded_int(seed, key, click_pos), size)
    drawn = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.get(pool, F.pmod(start + j, size).cast("int"))
    )
    return F.when(size >= n, drawn).otherwise(
        fail(F.lit(f"cannot draw {n} negatives without replacement from a smaller pool"))
    )


def label_position(labels: Column) -> Column:
    """0-based position of the first 1; 0 when there is none, as argmax gives."""
    return F.greatest(F.array_position(labels, F.lit(1).cast("tinyint")) - 1, F.lit(0)).cast("int")


def chunked(items: Column, k: int) -> Column:
    """Split a list into consecutive sublists of ``k``; the last may be shorter.

    Elements are picked by position, since slicing copies the whole list each time.
    """
    size = F.size(items)
    n_chunks = F.ceil(size / F.lit(k)).cast("int")

    def chunk(c):
        last = F.least((c + 1) * k, size) - 1
        return F.transform(F.sequence(c * k, last), lambda i: F.get(items, i))

    whole = F.transform(F.sequence(F.lit(0), F.greatest(n_chunks, F.lit(1)) - 1), chunk)
    return F.when(items.isNotNull(), F.slice(whole, F.lit(1), F.greatest(n_chunks, F.lit(0))))


def rank_by_score(scores: Column) -> Column:
    """Rank of each score in its own list, 1 = highest, later position first on ties."""
    tagged = F.transform(scores, lambda s, i: F.struct(s.alias("s"), i.alias("i")))
    order = F.transform(F.reverse(F.sort_array(tagged)), lambda t: t["i"])
    ranked = F.sort_array(F.transform(order, lambda i, r: F.struct(i.alias("i"), (r + 1).alias("r"))))
    return F.transform(ranked, lambda t: t["r"])


def softmax(scores: Column) -> Column:
    """Softmax over one list of scores."""
    top = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s - top))
    return F.transform(scores, lambda s: F.exp(s - top) / total)


def list_cross_entropy(scores: Column, label_at: Column) -> Column:
    """logsumexp(scores) - scores[label_at] for one list."""
    top = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s - top))
    return top + F.ln(total) - F.get(scores, label_at)


def top_position(scores: Column) -> Column:
    """0-based position of the highest score, the first one on ties."""
    return F.array_position(scores, F.array_max(scores)) - 1
