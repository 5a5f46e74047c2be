"""ANSI SQL giving the result of each registered query on the same tables."""

from feedmill.plans.queries import (
    ARTICLE_VOCABULARY, BATCH, DIM, EMBEDDING_DIM, FRACTION, HEAD_DIM, HEADS, HIDDEN, HISTORY_PAGE, HISTORY_SIZE, NPRATIO,
    SEED, TEXT_LENGTH, TITLE_LENGTH, VOCABULARY,
)

ORACLES = {}

_SPLIT_WHERE = {
    "history": "impression_time < TIMESTAMP '1998-01-01'",
    "train": "impression_time >= TIMESTAMP '1998-01-01' AND impression_time < TIMESTAMP '2000-01-01'",
    "validation": "impression_time >= TIMESTAMP '2000-01-01' AND impression_time < TIMESTAMP '2001-01-01'",
    "test": "impression_time >= TIMESTAMP '2001-01-01'",
}


def _md5(*parts):
    marked = ", ".join(f"coalesce(({p})::VARCHAR, 'null')" for p in parts)
    return f"md5(concat_ws('|', {marked}))"


def _hash(*parts):
    """A bigint in [0, 2^32) from the md5 of the parts joined by '|'."""
    return f"('0x' || substr({_md5(*parts)}, 1, 8))::BIGINT"


_SEED = f"'{SEED}'"
_SCORE = f"(({_hash(repr('s'), 'impression_id', 'article_id')} % 100)::DOUBLE / 100 - 0.5::DOUBLE)"

# Each part may use the parts before it.
_PARTS = {
    "items": """
        SELECT o_orderkey AS impression_id, o_custkey AS user_id, o_orderdate AS impression_time,
               l_partkey AS article_id, min(l_linenumber) AS ln,
               max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS clicked
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""",
    "cand": """
        SELECT *, row_number() OVER (PARTITION BY impression_id ORDER BY ln, article_id) AS pos FROM items""",
    "times": """
        SELECT o_orderkey AS impression_id, o_custkey AS user_id, o_orderdate AS impression_time FROM orders""",
    "hist": f"""
        SELECT user_id, article_id,
               row_number() OVER (PARTITION BY user_id
                   ORDER BY impression_time, impression_id, pos) AS hist_pos,
               row_number() OVER (PARTITION BY user_id
                   ORDER BY impression_time DESC, impression_id DESC, pos DESC) AS newest
        FROM cand WHERE clicked = 1 AND {_SPLIT_WHERE['history']}""",
    # slot 1..HISTORY_SIZE, padded on the left
    "recent": f"""
        SELECT user_id, {HISTORY_SIZE} + 1 - newest AS slot, article_id, hist_pos FROM hist
        WHERE newest <= {HISTORY_SIZE}""",
    "padded": f"""
        SELECT u.user_id, s.slot, r.article_id
        FROM (SELECT DISTINCT user_id FROM recent) u
        CROSS JOIN (SELECT unnest(range(1, {HISTORY_SIZE} + 1)) AS slot) s
        LEFT JOIN recent r ON r.user_id = u.user_id AND r.slot = s.slot""",
    "padded_text": """
        SELECT user_id, string_agg(coalesce(article_id, 0)::VARCHAR, ',' ORDER BY slot) AS history
        FROM padded GROUP BY user_id""",
    "train": f"SELECT * FROM cand WHERE {_SPLIT_WHERE['train']}",
    "validation": f"SELECT * FROM cand WHERE {_SPLIT_WHERE['validation']}",
    "test": f"SELECT * FROM cand WHERE {_SPLIT_WHERE['test']}",
    "ranked": f"""
        SELECT impression_id, pos, article_id, {_SCORE} AS score,
               row_number() OVER (PARTITION BY impression_id ORDER BY {_SCORE} DESC, pos DESC) AS rank
        FROM test""",
    "pool": """
        SELECT impression_id, article_id,
               row_number() OVER (PARTITION BY impression_id ORDER BY pos) - 1 AS place,
               count(*) OVER (PARTITION BY impression_id) AS n
        FROM train WHERE clicked = 0""",
    "clicks": """
        SELECT impression_id, article_id,
               row_number() OVER (PARTITION BY impression_id ORDER BY pos) AS click_pos
        FROM train WHERE clicked = 1""",
    "lists": f"""
        SELECT d.impression_id, d.click_pos, d.slot, p.article_id, 0 AS label
        FROM (SELECT c.impression_id, c.click_pos, s.slot,
                     {_hash(_SEED, 'c.impression_id', 'c.click_pos', 's.slot')} % z.n AS place
              FROM clicks c CROSS JOIN (SELECT unnest(range(1, {NPRATIO} + 1)) AS slot) s
              LEFT JOIN (SELECT DISTINCT impression_id, n FROM pool) z ON z.impression_id = c.impression_id) d
        LEFT JOIN pool p ON p.impression_id = d.impression_id AND p.place = d.place
        UNION ALL
        SELECT impression_id, click_pos, {NPRATIO} + 1, article_id, 1 FROM clicks""",
    # the pool in seeded order, for impressions with at least NPRATIO unclicked ids
    "mixed_pool": f"""
        SELECT impression_id, article_id, n,
               row_number() OVER (PARTITION BY impression_id
                   ORDER BY {_md5(_SEED, 'impression_id', 'place + 1')}, place) - 1 AS place
        FROM pool WHERE n >= {NPRATIO}""",
    "mixed": f"""
        SELECT impression_id, click_pos, article_id, label,
               row_number() OVER (PARTITION BY impression_id, click_pos
                   ORDER BY {_md5(_SEED, 'impression_id', 'click_pos', 'slot')}, slot) AS slot
        FROM lists""",
    "scored_lists": f"SELECT *, {_SCORE} AS score FROM mixed",
    "doc_words": r"""
        SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words
        FROM documents""",
    "vocab": f"""
        SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 1 AS token_id
        FROM (SELECT token, count(*) AS n FROM (SELECT unnest(words) AS token FROM doc_words)
              GROUP BY token ORDER BY n DESC, token LIMIT {VOCABULARY})""",
    "doc_tokens": """
        SELECT w.doc_id, w.place, coalesce(v.token_id, 1) AS token_id
        FROM (SELECT doc_id, unnest(words) AS token, unnest(range(1, len(words) + 1)) AS place
              FROM doc_words) w
        LEFT JOIN vocab v ON v.token = w.token""",
    "article_words": r"""
        SELECT p_partkey AS article_id,
               list_filter(regexp_split_to_array(p_name || ' ' || p_type, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')
                   AS words
        FROM part""",
    "article_vocab": f"""
        SELECT token, row_number() OVER (ORDER BY n DESC, token) + 1 AS token_id
        FROM (SELECT token, count(*) AS n FROM (SELECT unnest(words) AS token FROM article_words)
              GROUP BY token ORDER BY n DESC, token LIMIT {ARTICLE_VOCABULARY})""",
    # token ids 0..TITLE_LENGTH-1 of each article, plus article -1: padding only
    "article_ids": f"""
        SELECT a.article_id, s.pos, CASE WHEN w.token IS NULL THEN 0 ELSE coalesce(v.token_id, 1) END AS id
        FROM (SELECT article_id FROM article_words UNION ALL SELECT -1) a
        CROSS JOIN (SELECT unnest(range(0, {TITLE_LENGTH})) AS pos) s
        LEFT JOIN (SELECT article_id, unnest(words) AS token, unnest(range(0, len(words))) AS pos
                   FROM article_words) w ON w.article_id = a.article_id AND w.pos = s.pos
        LEFT JOIN article_vocab v ON v.token = w.token""",
    "emb": """
        SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS i
        FROM embeddings""",
}


def _weight(i, j, shift=0):
    return f"(((31 * {i} + 17 * {j} + {shift}) % 13) - 6)::DOUBLE / 50"


def _attention(prefix, seq, causal=False, lengths=None):
    """CTEs for self-attention over ``seq`` (key, pos, i, x); the result is ``<prefix>_out``.

    ``lengths`` names a CTE (key, n) for key and query lengths.
    """
    score = "sum(q.v * k.v) / sqrt(%d::DOUBLE)" % HEAD_DIM
    if causal:
        score += " + CASE WHEN k.pos > q.pos THEN -1e12 ELSE 0 END"
    if lengths:
        score = f"CASE WHEN k.pos < l.n THEN {score} ELSE -1e12 END"
    length_join = f"JOIN {lengths} l ON l.key = q.key" if lengths else ""
    length_key = ", l.n" if lengths else ""
    zero = "CASE WHEN s.qpos < l.n THEN sum(s.w * v.v) ELSE 0 END" if lengths else "sum(s.w * v.v)"
    length_join_out = f"JOIN {lengths} l ON l.key = s.key" if lengths else ""
    return {
        f"{prefix}_proj": f"""
            SELECT key, pos, t.name, d.j, sum(x * {_weight('i', 'd.j', 't.shift')}) AS v
            FROM {seq} CROSS JOIN (SELECT unnest(range(0, {DIM})) AS j) d
            CROSS JOIN (VALUES ('q', 0), ('k', 5), ('v', 9)) t(name, shift)
            GROUP BY key, pos, t.name, d.j""",
        f"{prefix}_scores": f"""
            SELECT q.key, q.pos AS qpos, k.pos AS kpos, q.j // {HEAD_DIM} AS head, {score} AS s
            FROM {prefix}_proj q JOIN {prefix}_proj k ON k.key = q.key AND k.j = q.j {length_join}
            WHERE q.name = 'q' AND k.name = 'k'
            GROUP BY q.key, q.pos, k.pos, q.j // {HEAD_DIM}{length_key}""",
        f"{prefix}_exp": f"""
            SELECT *, exp(s - max(s) OVER (PARTITION BY key, qpos, head)) AS e FROM {prefix}_scores""",
        f"{prefix}_soft": f"""
            SELECT key, qpos, kpos, head, e / sum(e) OVER (PARTITION BY key, qpos, head) AS w
            FROM {prefix}_exp""",
        f"{prefix}_out": f"""
            SELECT s.key, s.qpos AS pos, v.j AS i, {zero} AS x
            FROM {prefix}_soft s JOIN {prefix}_proj v
              ON v.key = s.key AND v.pos = s.kpos AND v.j // {HEAD_DIM} = s.head {length_join_out}
            WHERE v.name = 'v' GROUP BY s.key, s.qpos, v.j{length_key}""",
    }


def _pooled(prefix, seq):
    """CTEs for additive attention over ``seq`` (key, pos, i, x); the result is ``<prefix>_pooled``."""
    return {
        f"{prefix}_hidden": f"""
            SELECT key, pos, d.j, tanh(sum(x * {_weight('i', 'd.j')})) * {_weight('d.j', '0')} AS h
            FROM {seq} CROSS JOIN (SELECT unnest(range(0, {HIDDEN})) AS j) d GROUP BY key, pos, d.j""",
        f"{prefix}_att": f"SELECT key, pos, sum(h) AS s FROM {prefix}_hidden GROUP BY key, pos",
        f"{prefix}_atte": f"SELECT key, pos, exp(s - max(s) OVER (PARTITION BY key)) AS e FROM {prefix}_att",
        f"{prefix}_pooled": f"""
            SELECT q.key, q.i, sum(q.x * a.e) / sum(a.e) AS x
            FROM {seq} q JOIN {prefix}_atte a ON a.key = q.key AND a.pos = q.pos GROUP BY q.key, q.i""",
    }


_PARTS["title_seq"] = """
    SELECT article_id AS key, pos, e.i, e.x FROM article_ids JOIN emb e ON e.vec_id = article_ids.id"""
_PARTS |= _attention("title", "title_seq") | _pooled("title", "title_out")
_PARTS["user_seq"] = """
    SELECT p.user_id AS key, p.slot AS pos, t.i, t.x
    FROM padded p JOIN title_pooled t ON t.key = coalesce(p.article_id, -1)
    UNION ALL
    SELECT -1, s.slot, t.i, t.x FROM title_pooled t
    CROSS JOIN (SELECT DISTINCT slot FROM padded) s WHERE t.key = -1"""
_PARTS |= _attention("user", "user_seq") | _pooled("user", "user_out")


def _model_scores(split):
    return f"""
        SELECT c.impression_id, c.pos, c.article_id, sum(u.x * a.x) AS score
        FROM {split} c
        JOIN user_pooled u ON u.key = CASE WHEN c.user_id IN (SELECT user_id FROM recent)
                                           THEN c.user_id ELSE -1 END
        JOIN title_pooled a ON a.key = c.article_id AND a.i = u.i
        GROUP BY c.impression_id, c.pos, c.article_id"""


_PARTS["model_validation"] = _model_scores("validation")
_PARTS["model_test"] = _model_scores("test")

# Article embeddings of padded histories; ids without an embedding and padding are zeros.
_PARTS["history_seq"] = f"""
    SELECT p.user_id AS key, p.slot - 1 AS pos, d.i, coalesce(e.x, 0) AS x
    FROM padded p CROSS JOIN (SELECT unnest(range(0, {EMBEDDING_DIM})) AS i) d
    LEFT JOIN emb e ON e.vec_id = p.article_id AND e.i = d.i"""
_PARTS["history_len"] = "SELECT user_id AS key, count(*) AS n FROM recent GROUP BY user_id"


def _sql(parts, body, extra=None):
    """``body`` with the named parts, and whatever they use, as CTEs."""
    known = dict(_PARTS) | (extra or {})
    order = list(known)
    needed, todo = set(), list(parts.split()) + list(extra or {})
    while todo:
        name = todo.pop()
        if name in needed:
            continue
        needed.add(name)
        words = known[name].replace("(", " ").replace(")", " ").replace(",", " ").split()
        todo += [w for a, w in zip(words, words[1:]) if a.upper() in ("FROM", "JOIN") and w in known]
    ctes = ",\n".join(f"{n} AS ({known[n]})" for n in order if n in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def _oracle(name, parts, body, extra=None):
    ORACLES[name] = _sql(parts, body, extra)


# --- scans, sources, sinks -------------------------------------------------

_TIME = "strftime(impression_time, '%Y-%m-%d %H:%M:%S') AS impression_time"
for _name in ("scan_history", "history_positions"):
    _oracle(_name, "hist", "SELECT user_id, hist_pos, article_id FROM hist")
for _name in ("scan_behaviors", "paged_behaviors"):
    _oracle(_name, "cand", f"SELECT impression_id, user_id, {_TIME}, pos, article_id FROM cand")
_oracle("scan_articles", "", """
    SELECT p_partkey AS article_id, p_name AS title, p_type AS subtitle, p_brand AS category FROM part""")
_oracle("split_counts", "items", f"""
    SELECT CASE WHEN {_SPLIT_WHERE['history']} THEN 'history' WHEN {_SPLIT_WHERE['train']} THEN 'train'
                WHEN {_SPLIT_WHERE['validation']} THEN 'validation' ELSE 'test' END AS split,
           count(DISTINCT impression_id) AS impressions, count(*) AS candidates, sum(clicked)::BIGINT AS clicks
    FROM items GROUP BY 1""")


def _monthly(split, first_year):
    return f"""
        SELECT ((year(impression_time) - {first_year}) * 12 + month(impression_time) - 1)::BIGINT AS epoch,
               strftime(max(impression_time), '%Y-%m-%d %H:%M:%S') AS ignore, round(avg(clicked), 6) AS auc
        FROM items WHERE {_SPLIT_WHERE[split]} GROUP BY 1"""


_oracle("metric_log_read", "items", _monthly("validation", 2000))
_oracle("metric_curves", "items", f"""
    SELECT epoch, auc, set, max(epoch) OVER () AS max_epoch FROM (
        SELECT epoch, auc, 'Training' AS set FROM ({_monthly('train', 1998)})
        UNION ALL SELECT epoch, auc, 'Validation' AS set FROM ({_monthly('validation', 2000)}))""")
_LINE = "impression_id::VARCHAR || ' [' || string_agg(rank::VARCHAR, ',' ORDER BY pos) || ']'"
_oracle("prediction_lines", "ranked", f"SELECT {_LINE} AS line FROM ranked GROUP BY impression_id")
_oracle("prediction_rejects", "ranked", f"""
    SELECT CASE fault WHEN 1 THEN 'x' || line WHEN 2 THEN split_part(line, ' ', 1) ELSE replace(line, ']', '') END AS line,
           CASE fault WHEN 1 THEN 'the id is not a whole number' WHEN 2 THEN 'there is no list'
                      ELSE 'the list does not hold numbers only' END AS reason
    FROM (SELECT impression_id % 5 AS fault, {_LINE} AS line FROM ranked GROUP BY impression_id) WHERE fault BETWEEN 1 AND 3""")
for _name in ("prediction_roundtrip", "prediction_gzip_roundtrip", "rank_scores"):
    _oracle(_name, "ranked", "SELECT impression_id, pos, rank FROM ranked")

# --- projections, filters, samples ----------------------------------------

_oracle("project_train_columns", "train padded_text", """
    SELECT t.impression_id, t.user_id, h.history, t.pos, t.article_id, t.clicked AS label
    FROM train t LEFT JOIN padded_text h ON h.user_id = t.user_id""")
_oracle("filter_min_candidates", "items", f"""
    SELECT impression_id, count(*) AS n_candidates FROM items GROUP BY 1 HAVING count(*) > {NPRATIO} + 1""")
_oracle("known_user_flag", "times", f"""
    SELECT impression_id, user_id,
           user_id IN (SELECT user_id FROM times WHERE {_SPLIT_WHERE['train']}) AS is_known_user
    FROM times WHERE {_SPLIT_WHERE['validation']}""")
_TRAIN_IDS = f"SELECT impression_id, user_id FROM times WHERE {_SPLIT_WHERE['train']}"
_oracle("head_impressions", "times", f"{_TRAIN_IDS} ORDER BY impression_id LIMIT {4 * BATCH}")
_oracle("sample_fraction_exact", "times", f"""
    SELECT impression_id, user_id FROM (
        SELECT *, row_number() OVER (ORDER BY {_md5(_SEED, 'impression_id')}, impression_id) AS r,
               count(*) OVER () AS n FROM ({_TRAIN_IDS}))
    WHERE r <= floor(n * {FRACTION}::DOUBLE)""")
_oracle("sample_fraction_hash", "times", f"""
    SELECT impression_id, user_id FROM ({_TRAIN_IDS})
    WHERE {_hash(_SEED, 'impression_id')} < {int(FRACTION * 2**32)}""")
_oracle("shuffle_rows", "times", f"""
    SELECT impression_id, user_id,
           row_number() OVER (ORDER BY {_md5(_SEED, 'impression_id')}, impression_id) - 1 AS shuffled_pos
    FROM times""")

# --- joins -----------------------------------------------------------------

_PAGE = f"(hist_pos - 1) // {HISTORY_PAGE}"
_oracle("behaviors_with_history", "times hist", f"""
    SELECT t.impression_id, t.user_id, coalesce(h.page, 0) AS page, h.history FROM ({_TRAIN_IDS}) t LEFT JOIN (
        SELECT user_id, {_PAGE} AS page, string_agg(article_id::VARCHAR, ',' ORDER BY hist_pos) AS history
        FROM hist GROUP BY ALL) h ON h.user_id = t.user_id""")
for _name, _how in (("impressions_with_clicks", "INNER"), ("clicks_with_impressions", "RIGHT"), ("impressions_and_clicks", "FULL")):
    _oracle(_name, "times items", f"""
        SELECT coalesce(t.user_id, h.user_id) AS user_id, coalesce(t.impression_id, 0) AS impression_id,
               coalesce(h.clicked_in, 0) AS clicked_in, coalesce(h.article_id, 0) AS article_id
        FROM ({_TRAIN_IDS}) t {_how} JOIN (
            SELECT user_id, impression_id AS clicked_in, article_id FROM items
            WHERE clicked = 1 AND {_SPLIT_WHERE['history']}) h ON h.user_id = t.user_id""")

_oracle("users_full_join", "times", f"""
    SELECT coalesce(t.user_id, v.user_id) AS user_id, coalesce(n_train, 0) AS n_train,
           coalesce(n_validation, 0) AS n_validation
    FROM (SELECT user_id, count(*) AS n_train FROM times WHERE {_SPLIT_WHERE['train']} GROUP BY 1) t
    FULL JOIN (SELECT user_id, count(*) AS n_validation FROM times WHERE {_SPLIT_WHERE['validation']}
               GROUP BY 1) v ON v.user_id = t.user_id""")

# --- list operators --------------------------------------------------------

_oracle("binary_labels", "cand", "SELECT impression_id, pos, article_id, clicked AS label FROM cand")
_oracle("remove_positives", "items", "SELECT impression_id, article_id FROM items WHERE clicked = 0")
_oracle("truncate_history", "recent", """
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY slot) AS hist_pos, article_id FROM recent""")
_oracle("truncate_pad_history", "padded_text", "SELECT user_id, history FROM padded_text")
_oracle("sample_without_replacement", "cand", f"""
    SELECT impression_id, draw, article_id FROM (
        SELECT impression_id, article_id, count(*) OVER (PARTITION BY impression_id) AS n,
               row_number() OVER (PARTITION BY impression_id
                   ORDER BY {_md5(_SEED, 'impression_id', 'pos')}, pos) AS draw FROM cand)
    WHERE n >= 2 AND draw <= 2""")
_oracle("sample_with_replacement", "cand", f"""
    SELECT z.impression_id, z.draw, t.article_id FROM (
        SELECT impression_id, draw, {_hash(_SEED, 'impression_id', 'draw')} % n + 1 AS place FROM (
            SELECT impression_id, count(*) AS n FROM cand GROUP BY 1)
        CROSS JOIN (SELECT unnest(range(1, 5)) AS draw)) z
    JOIN cand t ON t.impression_id = z.impression_id AND t.pos = z.place""")
_LIST_COLUMNS = "impression_id, click_pos, slot, coalesce(article_id, -1) AS article_id, label"
_oracle("negative_sampling", "lists", f"SELECT {_LIST_COLUMNS} FROM lists")
_oracle("negative_sampling_shuffled", "mixed", f"SELECT {_LIST_COLUMNS} FROM mixed")
_oracle("negative_sampling_distinct", "clicks mixed_pool", f"""
    SELECT d.impression_id, d.click_pos, d.slot, p.article_id, 0 AS label
    FROM (SELECT c.impression_id, c.click_pos, s.slot,
                 ({_hash(_SEED, 'c.impression_id', 'c.click_pos')} + s.slot - 1) % z.n AS place
          FROM clicks c CROSS JOIN (SELECT unnest(range(1, {NPRATIO} + 1)) AS slot) s
          JOIN (SELECT DISTINCT impression_id, n FROM mixed_pool) z ON z.impression_id = c.impression_id) d
    JOIN mixed_pool p ON p.impression_id = d.impression_id AND p.place = d.place
    UNION ALL
    SELECT impression_id, click_pos, {NPRATIO} + 1, article_id, 1 FROM clicks
    WHERE impression_id IN (SELECT impression_id FROM mixed_pool)""")
_oracle("shuffle_list", "cand", f"""
    SELECT impression_id, article_id,
           row_number() OVER (PARTITION BY impression_id
               ORDER BY {_md5(_SEED, 'impression_id', 'pos')}, pos) AS shuffled_pos FROM cand""")


def _map_ids(element, keep="TRUE"):
    return f"""
        SELECT c.c_custkey AS user_id,
               string_agg({element}, ',' ORDER BY r.hist_pos) FILTER (WHERE {keep}) AS labels
        FROM customer c LEFT JOIN hist r ON r.user_id = c.c_custkey
        LEFT JOIN embeddings e ON e.vec_id = r.article_id GROUP BY 1"""


_oracle("map_ids_fill", "hist", _map_ids("coalesce(e.label, -1)::VARCHAR"))
_oracle("map_ids_drop", "hist", _map_ids("e.label::VARCHAR", "e.label IS NOT NULL"))
_oracle("map_ids_keep", "hist", _map_ids("coalesce(e.label::VARCHAR, 'null')"))
_oracle("candidate_counts", "times items", """
    SELECT t.impression_id, count(i.article_id) AS n_samples
    FROM times t LEFT JOIN items i ON i.impression_id = t.impression_id GROUP BY 1""")
_oracle("candidate_rows", "validation padded_text", """
    SELECT t.impression_id, t.user_id, h.history, t.pos, t.article_id, t.clicked AS label
    FROM validation t LEFT JOIN padded_text h ON h.user_id = t.user_id""")
_oracle("attach_scores", "ranked", "SELECT impression_id, pos, article_id, score FROM ranked")
_oracle("label_position", "mixed", """
    SELECT impression_id, click_pos, min(slot) FILTER (WHERE label = 1) - 1 AS label_position
    FROM mixed GROUP BY 1, 2""")
_oracle("chunk_list", "doc_words", """
    SELECT doc_id, chunk, len(words[(chunk - 1) * 100 + 1 : chunk * 100]) AS n_words,
           md5(array_to_string(words[(chunk - 1) * 100 + 1 : chunk * 100], ' ')) AS content
    FROM (SELECT doc_id, words, unnest(range(1, ceil(len(words) / 100)::BIGINT + 1)) AS chunk FROM doc_words)""")

# --- text, dates, structs --------------------------------------------------

_oracle("concat_columns", "", """
    SELECT p_partkey AS article_id, p_name || ' ' || p_type AS "title-subtitle" FROM part""")
_oracle("build_vocabulary", "vocab", "SELECT token, n, token_id FROM vocab")
_oracle("encode_text", "doc_tokens", f"""
    SELECT d.doc_id, string_agg(coalesce(t.token_id, 0)::VARCHAR, ',' ORDER BY s.place) AS text_encode_tok
    FROM documents d CROSS JOIN (SELECT unnest(range(1, {TEXT_LENGTH} + 1)) AS place) s
    LEFT JOIN doc_tokens t ON t.doc_id = d.doc_id AND t.place = s.place GROUP BY 1""")
_oracle("encode_text_unpadded", "doc_tokens", """
    SELECT d.doc_id, coalesce(t.n, 0) AS n_tokens, md5(coalesce(t.ids, '')) AS content
    FROM documents d LEFT JOIN (
        SELECT doc_id, count(*) AS n, string_agg(token_id::VARCHAR, ',' ORDER BY place) AS ids
        FROM doc_tokens GROUP BY 1) t ON t.doc_id = d.doc_id""")
_oracle("format_duration", "", """
    SELECT event_id, (s // 86400 - CASE WHEN s % 86400 < 0 THEN 1 ELSE 0 END)::VARCHAR || ' days '
           || (r // 3600)::VARCHAR || ':' || (r % 3600 // 60)::VARCHAR || ':' || (r % 60)::VARCHAR AS duration
    FROM (SELECT *, (s % 86400 + 86400) % 86400 AS r FROM (
        SELECT event_id,
               floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-10 12:00:00')) / 1000000.0)::BIGINT AS s
        FROM events))""")
_oracle("flatten_struct", "", """
    SELECT event_id, event_type AS "type-event", user_id AS "id-user-event",
           regexp_extract(props, '"k": *(-?[0-9]+)', 1)::BIGINT AS "k-props" FROM events""")

# --- lookup tables ---------------------------------------------------------

_oracle("article_lookup", "", """
    SELECT l_partkey AS key, l_suppkey AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey
            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS r FROM lineitem)
    WHERE r = 1""")
_oracle("user_index", "", """
    SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS id
    FROM (SELECT DISTINCT o_custkey AS user_id FROM orders)""")


def _matrix(row0):
    return f"""
        SELECT idx, coalesce(vec_id, -1) AS vec_id, i AS dim, round(x, 5) AS value FROM (
            SELECT dense_rank() OVER (ORDER BY vec_id) AS idx, vec_id, i, x FROM emb
            UNION ALL SELECT 0, NULL, i, {row0} FROM emb GROUP BY i)"""


_oracle("lookup_matrix_zeros", "emb", _matrix("0::DOUBLE"))
_oracle("lookup_matrix_mean", "emb", _matrix("avg(x)::FLOAT::DOUBLE"))
_oracle("embedding_lookup", "cand", f"""
    SELECT v.impression_id, v.pos, v.article_id, coalesce(e.idx, 0) AS idx,
           round(coalesce(e.embedding[1], 0)::DOUBLE, 6) AS first_value,
           round(coalesce(e.embedding[{EMBEDDING_DIM}], 0)::DOUBLE, 6) AS last_value
    FROM cand v LEFT JOIN (
        SELECT vec_id, embedding, row_number() OVER (ORDER BY vec_id) AS idx FROM embeddings) e
      ON e.vec_id = v.article_id""")

# --- metrics ---------------------------------------------------------------

_oracle("auc_pooled", "test", f"""
    SELECT ties, sum(pos * (below + CASE WHEN ties = 'half' THEN neg / 2 ELSE 0 END))
                 / (sum(pos) * sum(neg))::DOUBLE AS auc
    FROM (SELECT pos::DOUBLE AS pos, neg::DOUBLE AS neg, coalesce(sum(neg::DOUBLE) OVER (
                     ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM (SELECT {_SCORE} AS score, sum(clicked) AS pos, sum(1 - clicked) AS neg FROM test GROUP BY 1))
    CROSS JOIN (VALUES ('strict'), ('half')) t(ties) GROUP BY ties""")
_oracle("accuracy_top1", "scored_lists", """
    SELECT avg(CASE WHEN label = 1 THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM (
        SELECT label, row_number() OVER (PARTITION BY impression_id, click_pos ORDER BY score DESC, slot) AS r
        FROM scored_lists) WHERE r = 1""")
_oracle("accuracy_threshold", "validation", f"""
    SELECT avg(CASE WHEN ({_SCORE} > 0) = (clicked = 1) THEN 1.0::DOUBLE ELSE 0 END) AS accuracy
    FROM validation""")
_oracle("loss_listwise", "scored_lists", f"""
    SELECT round(avg(l), 9) AS loss FROM (
        SELECT avg(loss) AS l FROM (
            SELECT loss, (row_number() OVER (ORDER BY impression_id, click_pos) - 1) // {BATCH} AS batch_id FROM (
                SELECT impression_id, click_pos,
                       ln(sum(exp(score))) - sum(CASE WHEN label = 1 THEN score ELSE 0 END) AS loss
                FROM scored_lists GROUP BY 1, 2))
        GROUP BY batch_id)""")
_oracle("loss_batch", "validation", f"""
    SELECT round(avg(l), 8) AS loss FROM (
        SELECT sum(clicked) * ln(sum(exp(score))) - sum(clicked * score) AS l FROM (
            SELECT clicked, {_SCORE} AS score,
                   (dense_rank() OVER (ORDER BY impression_id) - 1) // {BATCH} AS batch_id FROM validation)
        GROUP BY batch_id)""")
_oracle("softmax_scores", "cand", f"""
    SELECT impression_id, pos, article_id,
           round(exp(score) / sum(exp(score)) OVER (PARTITION BY impression_id), 9) AS prob
    FROM (SELECT *, {_SCORE} AS score FROM cand)""")
_oracle("npratio", "items", """
    SELECT round(sum(1 - clicked)::DOUBLE / sum(clicked)::DOUBLE, 9) AS npratio FROM items""")
_oracle("row_drop_report", "items", f"""
    SELECT rows_before, rows_after, round((rows_before - rows_after)::DOUBLE / rows_before * 100, 2) AS pct_dropped
    FROM (SELECT count(*) AS rows_before, count(*) FILTER (WHERE n > {NPRATIO} + 1) AS rows_after
          FROM (SELECT impression_id, count(*) AS n FROM items GROUP BY 1))""")

# --- ranking, ordering, batches --------------------------------------------

_oracle("top_article", "ranked", "SELECT impression_id, article_id, score FROM ranked WHERE rank = 1")
_oracle("ordered_impressions", "times", f"""
    SELECT impression_id, user_id, {_TIME} FROM times ORDER BY impression_id""")
_oracle("batch_assignment", "times", f"""
    SELECT impression_id, user_id, i // {BATCH} AS batch_id, i % {BATCH} AS slot FROM (
        SELECT *, row_number() OVER (ORDER BY impression_id) - 1 AS i FROM times)""")

# --- attention, vectors, scores --------------------------------------------

_POOL = "SELECT key AS label, i AS dim, round(x, 6) AS value FROM label_pooled"
for _name, _where in (
    ("attention_pool", "TRUE"),
    ("attention_pool_masked", "vec_id IN (SELECT vec_id FROM embeddings WHERE embedding[1] > 0)"),
):
    _label_seq = {"label_seq": f"SELECT label AS key, vec_id AS pos, i, x FROM emb WHERE {_where}"}
    _oracle(_name, "emb", _POOL, _label_seq | _pooled("label", "label_seq"))
_ATTENDED = "SELECT key AS user_id, pos, i AS dim, round(x, 6) AS value FROM hist_att_out"
_oracle("self_attention", "history_seq", _ATTENDED, _attention("hist_att", "history_seq"))
_oracle("self_attention_causal", "history_seq", _ATTENDED, _attention("hist_att", "history_seq", causal=True))
_oracle("self_attention_lengths", "history_seq history_len", _ATTENDED,
        _attention("hist_att", "history_seq", lengths="history_len"))
_oracle("article_vectors", "title_pooled", """
    SELECT key AS article_id, i AS dim, round(x, 8) AS value FROM title_pooled WHERE key <> -1""")
_oracle("user_vectors", "user_pooled", """
    SELECT key AS user_id, i AS dim, round(x, 9) AS value FROM user_pooled WHERE key <> -1""")
_oracle("click_scores", "model_validation", """
    SELECT impression_id, pos, article_id, round(score, 10) AS score FROM model_validation""")
_oracle("click_probability", "model_validation", """
    SELECT impression_id, pos, article_id, round(1 / (1 + exp(-score)), 9) AS probability FROM model_validation""")
_oracle("predict_test", "model_test", f"""
    SELECT {_LINE} AS line FROM (
        SELECT impression_id, pos, row_number() OVER (
            PARTITION BY impression_id ORDER BY round(score, 9) DESC, pos DESC) AS rank FROM model_test)
    GROUP BY impression_id""")

# --- the chains that training and evaluation run -----------------------------

_CHAIN = {
    "article_index": "SELECT p_partkey AS article_id, row_number() OVER (ORDER BY p_partkey) AS idx FROM part",
    "index_text": """
        SELECT p.user_id, string_agg(coalesce(i.idx, 0)::VARCHAR, ',' ORDER BY p.slot) AS history
        FROM padded p LEFT JOIN article_index i ON i.article_id = p.article_id GROUP BY 1""",
}


def _fifth(keys, table):
    order = ", ".join(keys)
    return f"""
        SELECT {order} FROM (
            SELECT *, row_number() OVER (ORDER BY {_md5(_SEED, *keys)}, {order}) AS r, count(*) OVER () AS n
            FROM (SELECT DISTINCT {order} FROM {table}))
        WHERE r <= floor(n * {FRACTION}::DOUBLE)"""


def _chain_sql(keys, table, kept, position):
    """Rows of the kept records: articles and histories as places in the article index."""
    order = ", ".join(f"r.{k}" for k in keys)
    same = " AND ".join(f"k.{k} = r.{k}" for k in keys)
    return f"""
        SELECT {order}, r.{position}, coalesce(i.idx, 0) AS article_index, r.label, coalesce(h.history, '0') AS history
        FROM {table} r JOIN {kept} k ON {same}
        JOIN times t ON t.impression_id = r.impression_id
        LEFT JOIN article_index i ON i.article_id = r.article_id
        LEFT JOIN index_text h ON h.user_id = t.user_id"""


_LISTED, _SHOWN = ["impression_id", "click_pos"], ["impression_id"]
_oracle("train_rows", "mixed times index_text", _chain_sql(_LISTED, "mixed", "kept_lists", "slot"),
        _CHAIN | {"kept_lists": _fifth(_LISTED, "mixed")})
_oracle("validation_rows", "validation times index_text", _chain_sql(
    _SHOWN, "(SELECT *, clicked AS label FROM validation)", "kept_impressions", "pos"),
    _CHAIN | {"kept_impressions": _fifth(_SHOWN, "validation")})
_oracle("click_model_optimality", "lists", f"""
    SELECT d.dim, 0.0::DOUBLE AS gradient, l.n_rows, l.n_clicks
    FROM (SELECT unnest(range(-1, {DIM})) AS dim) d
    CROSS JOIN (SELECT count(*) AS n_rows, sum(label)::BIGINT AS n_clicks FROM lists) l""")
