"""What op11 holds: small batches, one shard at a time in a worker, no shard that has been used."""

import os
import weakref

import pytest
from pyspark.sql import functions as F

from feedmill.llm import phrases
from tests.llm.test_worker_memory import largest_batch


def documents(spark, n=60):
    return spark.range(0, n, 1, 2).select(F.lit("en").alias("lang"), F.concat(F.lit("some words of a text that repeats "), F.col("id") % 3).alias("text"))


def test_batches_are_small(spark):
    long = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.repeat(F.lit("word "), 4_000).alias("text"))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    phrases.chunks(long, "text", "lang")
    assert largest_batch(long) < 3 << 20  # all texts: 12 MB


def test_used_shards_are_let_go(spark, monkeypatch):
    made, shards = [], phrases._shards

    def noted(*args):
        made.extend(out := shards(*args))
        return out

    monkeypatch.setattr(phrases, "_shards", noted)
    monkeypatch.setattr(phrases, "SHARD", 3)
    rows = phrases.collocations(documents(spark), 20).collect()
    assert len(made) > 4 and rows
    assert not any(os.path.exists(shard._path) for shard in made)


@pytest.mark.parametrize("n", [1, 3])
def test_a_worker_holds_one_shard(n):
    class Value:
        pass

    alive = weakref.WeakSet()

    class Shard:
        @property
        def value(self):
            if "_value" not in vars(self):
                self._value = Value()
                alive.add(self._value)
            return self._value

    shards, held = [Shard() for _ in range(n)], []
    phrases._through(shards, lambda value: held.append(len(alive)))
    assert held == [1] * n
    assert len(alive) == (1 if n == 1 else 0)
