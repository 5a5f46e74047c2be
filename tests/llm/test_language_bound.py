"""One mislabelled document does not lift the bound of rejection."""

from pyspark.sql import Window, functions as F

from feedmill.llm.language import CALIBRATES, held_out, identify, train
from tests.conftest import SMALL
from tests.llm.fixtures import odd_documents


def test_a_mislabelled_calibration_text(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where(~held_out()).select("doc_id", "text", "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    bad = docs.withColumn("r", rank).where((F.col("r") % CALIBRATES == 0) & (F.col("lang") == "de")).agg(F.min("doc_id")).first()[0]
    english = " ".join(r.text for r in docs.where("lang = 'en'").orderBy("doc_id").limit(3).collect())
    planted = docs.withColumn("text", F.when(F.col("doc_id") == bad, english).otherwise(F.col("text")))
    clean, model = train(docs), train(planted)
    assert model.worst["de"] <= clean.worst["de"] + 0.2
    noise = "xqzk vwpj qqxz zkkv jwqx zzxq kvjq xwzp " * 5
    assert not identify(odd_documents(spark, [(1, noise, None, None)]), model, prefix="p_").collect()[0].p_accepted
    german = identify(docs.where((F.col("lang") == "de") & (F.col("doc_id") != bad)), model)
    assert german.where("accepted").count() >= 0.97 * german.count()
