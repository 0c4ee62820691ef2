"""The registered queries of this subpackage and their SQL twins.

Each applies its operator, with the parameters of production, to a whole table. Twins are left out where SQL cannot express the
operator (tokenizers, language models, packing, flows, archives); tests hold those against brute force.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F

from gridvoice.llm import (
    decontaminate,
    kneser_ney,
    minhash,
    multi_index,
    packing,
    periodic_runs,
    reshard,
    rules,
    templates,
    toxicity,
    warc,
    whitening,
    wordpiece,
)
from gridvoice.llm.common import table
from gridvoice.sources import scratch

QUERIES = {}
SQL = {}

PACKING_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def content(path: str) -> str:
    """A vocabulary file, read where the job is started; tasks get its content."""
    return Path(path).read_text(encoding="utf-8")


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return wrap


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORDS = r"'[^\x20\x09-\x0D]+'"


@query(
    "op1_decontamination",
    f"""WITH iw AS (SELECT item_id, regexp_extract_all({_LOWER}, {_PLAIN_WORDS}) AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id, size, unnest(grams) AS gram FROM (SELECT item_id, least(len(w), 10) AS size,
      CASE WHEN len(w) >= 10 THEN [array_to_string(w[i:i+9], ' ') for i in range(1, len(w) - 8)] ELSE [array_to_string(w, ' ')] END AS grams
      FROM iw WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT size FROM windows),
    dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_PLAIN_WORDS}) AS w FROM documents),
    spots AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS p,
      unnest([array_to_string(w[i:i+size-1], ' ') for i in range(1, len(w) - size + 2)]) AS gram FROM dw, sizes WHERE len(w) >= size),
    hits AS (SELECT doc_id, p, spots.size, item_id FROM spots JOIN windows USING (gram, size)),
    covered AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS x FROM hits) GROUP BY 1),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def decontamination(spark, directory):
    found = decontaminate.contamination(table(spark, directory, "documents"), table(spark, directory, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_T = templates.Settings(long_words=50)


@query(
    "op2_line_templates",
    rf"""WITH l AS (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
    t AS (SELECT doc_id, line_no, line, regexp_extract_all(regexp_replace(line, '[0-9]+', '<*>', 'g'), {_WORDS}) AS tokens FROM l),
    m AS (SELECT doc_id, line_no, line, len(tokens) AS size, tokens[1:{_T.depth}] AS lead, tokens FROM t WHERE len(tokens) > 0),
    leaves AS (SELECT size, lead FROM m GROUP BY ALL HAVING count(DISTINCT doc_id) >= {_T.min_docs}),
    d AS (SELECT DISTINCT size, lead, tokens, doc_id FROM m SEMI JOIN leaves USING (size, lead)),
    e AS (SELECT size, lead, tokens, doc_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS place FROM d),
    c AS (SELECT size, lead, place, token FROM e GROUP BY ALL HAVING count(DISTINCT doc_id) >= {_T.min_docs}),
    k AS (SELECT size, lead, tokens, string_agg(place || ':' || token, ' ' ORDER BY place) AS template
      FROM (SELECT DISTINCT size, lead, tokens, token, place FROM e) JOIN c USING (size, lead, place, token) GROUP BY ALL
      HAVING count(*) * 100 >= size * {_T.constant_percent}),
    r AS (SELECT size, lead, template, min(doc_id) AS keeper FROM k JOIN d USING (size, lead, tokens) GROUP BY ALL HAVING count(DISTINCT doc_id) >= {_T.min_docs}),
    longs AS (SELECT line, min(doc_id) AS keeper FROM l JOIN m USING (doc_id, line_no, line) WHERE size >= {_T.long_words} GROUP BY 1 HAVING count(DISTINCT doc_id) > 1),
    gone AS (SELECT m.doc_id, m.line_no FROM m JOIN k USING (size, lead, tokens) JOIN r USING (size, lead, template) WHERE m.doc_id <> r.keeper
      UNION SELECT m.doc_id, m.line_no FROM m JOIN longs USING (line) WHERE m.doc_id <> longs.keeper AND m.size >= {_T.long_words})
    SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_dropped,
      md5(CASE WHEN text IS NULL THEN NULL WHEN n IS NULL THEN text ELSE coalesce(left_over, '') END) AS text_left_md5
    FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) USING (doc_id)
    LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS left_over FROM l ANTI JOIN gone USING (doc_id, line_no) GROUP BY 1) USING (doc_id)""",
)
def line_templates(spark, directory):
    left = templates.dedup(table(spark, directory, "documents"), _T)
    return left.select("doc_id", "n_lines", "n_dropped", F.md5("text_left").alias("text_left_md5"))


@query("op3_resharding")
def resharding(spark, directory):
    places = reshard.reshard(table(spark, directory, "documents"), scratch.new_path(spark, "shards"))
    return places.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


@query("op4_perplexity")
def perplexity(spark, directory):
    judged = kneser_ney.classify(table(spark, directory, "documents"), table(spark, directory, "labels"))
    return judged.select("doc_id", "lang", "n_chars_scored", "perplexity", "threshold", "kept")


@query("op5_packing")
def packed(spark, directory):
    cut = packing.pieces(table(spark, directory, "documents"), content(PACKING_VOCABULARY))
    return packing.pack(cut)


@query("op6_toxicity")
def toxic(spark, directory):
    scored = toxicity.score(table(spark, directory, "documents"), table(spark, directory, "labels"))
    return scored.select(
        "doc_id", "held_out", "score", "predicted", "n_tokens", "evidence", F.size("passages").cast("long").alias("n_passages")
    )


@query("op7_archives")
def archives(spark, directory):
    index = warc.captures(table(spark, directory, "pages"))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "timestamp"
    )


_SIMILAR = minhash.Settings(words=3, percent=85)


@query(
    "op8_near_duplicates",
    f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i+2], ' ') for i in range(1, len(w) - 1)]
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, x.b FROM reach r JOIN both_ways x ON r.b = x.a),
    least_id AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
      coalesce(component_id, doc_id) = doc_id AS kept
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least_id USING (doc_id)""",
)
def near_duplicates(spark, directory):
    return minhash.near_duplicates(table(spark, directory, "documents"), _SIMILAR)


@query(
    "op9_quality_rules",
    rf"""WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines FROM documents),
    g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, unnest([array_to_string(w[i:i+7], ' ') for i in range(1, len(w) - 6)]) AS gram FROM w WHERE len(w) >= 8),
    twice AS (SELECT doc_id, gram FROM g GROUP BY ALL HAVING count(*) > 1),
    covered AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS x FROM g JOIN twice USING (doc_id, gram)) GROUP BY 1),
    c AS (SELECT doc_id, text, lines, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
      coalesce(n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN covered USING (doc_id)),
    b AS (SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM c)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR word_chars < n_words * 2 OR word_chars > n_words * 15
      OR n_symbols * 10 > n_words OR n_dup_lines * 10 > len(lines) * 3 OR length(regexp_replace(text, '[^A-Z]+', '', 'g')) * 2 > word_chars
      OR length(regexp_replace(text, '[\x20\x09-\x0D\p{{L}}]+', '', 'g')) * 2 > word_chars
      OR len(list_filter(lines, lambda line: regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) * 10 > len(lines) * 3
      OR len(list_filter(lines, lambda line: regexp_matches(line, '^[\x20\x09-\x0D]*[-*•]'))) * 10 > len(lines) * 9) AS kept FROM b""",
)
def quality_rules(spark, directory):
    return rules.judge(table(spark, directory, "documents"))


@query("op10_token_counts")
def token_counts(spark, directory):
    return wordpiece.token_counts(table(spark, directory, "documents"), content(PIECE_VOCABULARY))


@query("op11_periodic_runs")
def runs_of_words(spark, directory):
    docs = periodic_runs.with_planted_runs(table(spark, directory, "documents"))
    found = periodic_runs.periodic_runs(docs)
    # runs are ordered by start and period, so the first of equal exponents is the one wanted
    best = F.aggregate(
        "runs",
        F.expr("CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>)"),
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )
    lines = F.transform(
        "runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text_collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


@query("op12_whitening")
def whitened(spark, directory):
    return whitening.whiten(table(spark, directory, "embeddings"))


@query(
    "op13_embedding_duplicates",
    """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
    links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
      AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, x.b FROM reach r JOIN links x ON r.b = x.a),
    n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1),
    least_id AS (SELECT a AS vec_id, least(a, min(b)) AS component_id FROM reach GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
      coalesce(component_id, vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN least_id USING (vec_id)""",
)
def embedding_duplicates(spark, directory):
    return multi_index.near_duplicates(table(spark, directory, "embeddings"))
