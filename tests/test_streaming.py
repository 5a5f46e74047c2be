"""The row-local operators on a streaming DataFrame."""

from pyspark.sql import functions as F

from feedmill import schema as S
from feedmill.functions import lists as L
from feedmill.functions import text as X
from feedmill.operators import impressions as I


def test_row_local_operators_stream(spark, tmp_path):
    rows = [(1, 10, None, [1, 2, 3], [2]), (2, 20, None, [4, 5], None)]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, S.BEHAVIORS_SCHEMA).write.parquet(source)

    def work(df):
        labelled = df.transform(I.add_labels).transform(I.truncate_history, S.INVIEW, 4, 0)
        return labelled.select(
            S.IMPRESSION_ID, S.INVIEW, S.LABELS,
            L.chunked(F.col(S.LABELS), 2).alias("chunks"),
            X.joined_with_space(F.lit("a"), F.lit("b")).alias("text"),
        )

    stream = work(spark.readStream.schema(S.BEHAVIORS_SCHEMA).parquet(source))
    assert stream.isStreaming
    query = (
        stream.writeStream.format("memory").queryName("labelled")
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    query.processAllAvailable()
    query.stop()
    batch = work(spark.read.schema(S.BEHAVIORS_SCHEMA).parquet(source))
    assert sorted(map(tuple, spark.table("labelled").collect())) == sorted(map(tuple, batch.collect()))
