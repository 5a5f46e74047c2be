"""Lines whose rows lie in many range partitions, and the plan that reads them."""

import pytest

from feedmill.llm import lines
from feedmill.llm.lines import drop_repeated_lines, line_bitmaps
from tests.llm.fixtures import odd_documents

A = "a line of enough characters to be looked at by all means"
B = "another line of enough characters to be looked at as well"


def rows():
    """Two lines in very many documents, one in four, one in five of which two share an id; some documents hold a line often."""
    out = [(i, "\n".join([A] * (1 + i % 3) + [f"own {i}", B.upper()] * (i % 2)), "en", "a") for i in range(300)]
    out += [(1000 + i, f"four documents hold this line, which is one too few {'x' * 20}", "en", "a") for i in range(4)]
    out += [(2000 + i // 2, f"five documents, of which two have the same id, hold this\n{i}", "en", "a") for i in range(5)]
    return [*out, (None, A, "en", "a"), (None, f"{A}\n{B}", "en", "a"), (299, f"{B}\nmore", "en", "a")]


def brute(docs):
    import re

    keyed = [(i, t, [re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).lower() for x in t.split("\n")]) for i, t, *_ in docs]
    holders = {}
    for i, t, keys in keyed:
        for k in keys:
            if len(k) >= 40:
                holders.setdefault(k, set()).add((i, t))
    stays = {k: max((i for i, _ in h if i is not None), default=None) for k, h in holders.items() if len(h) >= 5}
    out = []
    for i, t, keys in keyed:
        kept = [x for x, k in zip(t.split("\n"), keys) if k not in stays or stays[k] == i]
        out.append((str(i), len(keys), len(keys) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("partitions", ["1", "4", "60"])
def test_lines_across_partitions(spark, partitions):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = drop_repeated_lines(odd_documents(spark, rows())).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((str(r.doc_id), r._n_lines, r._n_dropped, r._kept_text) for r in found) == brute(rows())


def test_no_join_by_line(spark, monkeypatch):
    """Lines are told apart by their order alone: whatever is joined by hash is the table of partition ends."""
    plan = line_bitmaps(odd_documents(spark, rows()))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "SortMergeJoin" not in physical and "ShuffledHashJoin" not in physical
    assert physical.count("BroadcastHashJoin") == 1 and "Window" in physical
    assert lines.MIN_DOCUMENTS == 5
