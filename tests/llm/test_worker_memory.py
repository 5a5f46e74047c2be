"""What executors and their Python workers hold: batches of bounded bytes, slices to match, and nothing of an earlier operator."""

import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedmill.llm import arrow, bpe
from feedmill.llm.jaccard import near_groups
from feedmill.llm.language import identify

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def largest_batch(df):
    """Bytes of the largest batch that a worker gets."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return df.mapInArrow(run, "n bigint").agg(F.max("n")).first()[0]


@pytest.mark.parametrize("planned", [lambda d: bpe.digests(d, VOCABULARY), lambda d: identify(d, None), lambda d: near_groups(d.limit(1))])
def test_batches_of_long_texts(spark, planned):
    long = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 4_000).alias("text"))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    planned(long)
    assert largest_batch(long) < 3 << 20  # all texts: 12 MB


def test_a_worker_forgets_the_vocabulary_of_an_earlier_operator():
    bpe.vocabulary(VOCABULARY)
    arrow.begin_task(bpe.vocabulary)
    assert bpe.vocabulary.cache_info().currsize == 1
    arrow.begin_task()
    assert bpe.vocabulary.cache_info().currsize == 0


def test_a_task_of_another_operator_forgets(spark):
    docs = spark.range(0, 8, 1, 1).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([bpe.vocabulary.cache_info().currsize], pa.int32())], ["n"])

    assert bpe.digests(docs, VOCABULARY).count() == 8
    assert identify(docs, None).count() == 8
    assert docs.coalesce(1).mapInArrow(held, "n int").agg(F.max("n")).first()[0] == 0


def test_encoding_a_batch_takes_little_besides_it(spark):
    """Words of all texts are Python strings for a slice only."""
    texts = pa.array([" ".join(f"w{i % 7}x{(i * j) % 991}" for i in range(500)) + "  end" for j in range(600)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    encoder = bpe.vocabulary(VOCABULARY).encoder
    encoder.encode(texts.slice(0, 1))
    tracemalloc.start()
    for part in bpe.byte_slices(batch, 0, bpe._SLICE_BYTES):
        encoder.encode(part.column(0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
