"""One query per corpus operator, over its whole table, and its SQL where SQL can say it."""

import public_tokenizers
from pyspark.sql import functions as F

from feedmill.llm.bpe import digests
from feedmill.llm.exact import exact_duplicates
from feedmill.llm.fingerprints import fingerprints
from feedmill.llm.html_text import extract
from feedmill.llm.jaccard import near_groups
from feedmill.llm.language import held_out, identify, train
from feedmill.llm.lines import drop_repeated_lines
from feedmill.llm.mixing import mix
from feedmill.llm.negatives import hard_negatives
from feedmill.llm.phrases import collocations
from feedmill.llm.sharding import shard_rows
from feedmill.llm.tables import read, whole
from feedmill.llm.threshold import top_k
from feedmill.llm.token_files import through_files

QUERIES, ORACLES = {}, {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_mix_sources(spark, sf_dir):
    return mix(read(spark, sf_dir, "documents")).drop("copies", "text_hash")


@query
def op2_line_dedup(spark, sf_dir):
    docs = drop_repeated_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2("_kept_text", 256).alias("kept_sha256"),
    )


_STRIPPED = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
ORACLES["op2_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, {_STRIPPED}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS stays FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, pos, line, stays IS NOT NULL AND stays <> doc_id AS dropped FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op3_fingerprints(spark, sf_dir):
    return fingerprints(read(spark, sf_dir, "documents"))


@query
def op4_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


@query
def op5_shard(spark, sf_dir):
    return shard_rows(read(spark, sf_dir, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op6_bpe(spark, sf_dir):
    return digests(read(spark, sf_dir, "documents"), VOCABULARY)


@query
def op7_ngram_jaccard(spark, sf_dir):
    return near_groups(read(spark, sf_dir, "documents")).drop("text_hash")


@query
def op8_html_text(spark, sf_dir):
    pages = extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))


@query
def op9_token_files(spark, sf_dir):
    tokens = through_files(read(spark, sf_dir, "documents"), VOCABULARY)
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_exact_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return exact_duplicates(docs, extra={"text_sha256": F.sha2(whole(), 256)})


ORACLES["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query
def op11_phrases(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents"))


ORACLES["op11_phrases"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM placed, range(1, 6) AS lengths(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 100
), inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS held
  FROM candidates, range(1, 6) AS starts(i), range(2, 5) AS sizes(m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), left_over AS (
  SELECT c.* FROM candidates c LEFT JOIN inside h USING (lang, phrase) WHERE h.held IS NULL OR 100 * h.held < 100 * c.a
), cuts AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:k], ' ') AS tail
  FROM left_over, range(1, 5) AS cut(j) WHERE j < k
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.tail
  JOIN totals t ON t.lang = c.lang
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest
) WHERE rank <= 2000
"""


@query
def op12_top_k_search(spark, sf_dir):
    return top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


_VECTORS = """
vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""
ORACLES["op12_top_k_search"] = f"""
WITH {_VECTORS}, scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
) WHERE rank <= 5
"""


@query
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


ORACLES["op13_hard_negatives"] = f"""
WITH {_VECTORS}, labelled AS (
  SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM vectors WHERE label IS NOT NULL
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM labelled a JOIN labelled c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, rank, vec_id AS negative_id, positive_score, score AS negative_score FROM (
  SELECT p.*, s.vec_id, s.score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
) WHERE rank <= 10
"""
