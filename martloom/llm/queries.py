"""The corpus operators as queries over the whole tables, and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    bagminhash,
    brown,
    byte_bpe,
    decontaminate,
    embedding_dedup,
    fill_middle,
    packing,
    phrases,
    pii,
    preference,
    token_counts,
    toxicity,
    url_filter,
)
from martloom.llm.common import fold, table, utf8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)
PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def query(key: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = build
        if sql is not None:
            ORACLES[key] = sql
        return build

    return add


@query("op1_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    model = toxicity.fit(toxicity.labelled_sample(docs, labels))
    scored = toxicity.score_toxicity(docs, model, toxicity.THRESHOLD)
    return scored.withColumn("doc_id", F.col("row.doc_id")).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted"
    )


@query("op2_lm_scoring")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = docs.where(fold("doc_id", 5) != 1).select(utf8("text").alias("text"))
    scored = brown.score(docs, brown.fit(train))
    return scored.select(
        "doc_id",
        (fold("doc_id", 5) == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query("op3_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.fit(docs))
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[number(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


_URL_SQL = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM cut
), keyed AS (
    SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '')
        || regexp_replace(path, '(/index\.html|\.html|/+)$', '') END AS url_key
    FROM parts
), rules(verdict, h, p) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fitting AS (
    SELECT DISTINCT host, path, h || p AS rule, verdict
    FROM (SELECT DISTINCT host, path FROM keyed) u
    JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC) = 1
), listed AS (
    SELECT DISTINCT url_key AS listed_key FROM keyed WHERE page_id % 20 = 0 AND url_key IS NOT NULL
)
SELECT page_id, k.host, k.path, rule,
    coalesce(verdict, CASE WHEN listed_key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed k
LEFT JOIN fitting f ON f.host = k.host AND f.path = k.path
LEFT JOIN listed ON listed_key = url_key
"""


@query("op4_url_filter", _URL_SQL)
def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the URLs of the pages whose id is divisible by 20."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(F.col("page_id") % 20 == 0)
    listed = listed.select(url_filter.canonical(F.col("url").cast("string")).alias("url_key"))
    return url_filter.judge_urls(pages, RULES, listed)


_PREFERENCE_SQL = r"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
    SELECT *, row_number() OVER w AS i FROM turns
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), replies AS (
    SELECT conv_id, max(i) AS last_i, count(*) AS n, arg_min(text, i) AS first_text
    FROM numbered WHERE role = 'assistant' GROUP BY conv_id
), sides AS (
    SELECT n.*, last_i, CASE WHEN i = last_i THEN CASE WHEN r.n > 1 THEN first_text ELSE '' END ELSE text END AS worse
    FROM numbered n JOIN replies r USING (conv_id)
), told AS (
    SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS a,
        '<|' || role || '|>' || chr(10) || worse || '<|end|>' || chr(10) AS b,
        min(CASE WHEN text <> worse THEN i END) OVER (PARTITION BY conv_id) AS differs
    FROM sides
), placed AS (
    SELECT *, i < coalesce(differs, 1000000000) AS shared,
        coalesce(sum(CASE WHEN i < coalesce(differs, 1000000000) THEN 0 ELSE length(a) END) OVER w, 0)::INT AS at_a,
        coalesce(sum(CASE WHEN i < coalesce(differs, 1000000000) THEN 0 ELSE length(b) END) OVER w, 0)::INT AS at_b,
        (length(role) + 5)::INT AS skip
    FROM told
    WINDOW w AS (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT conv_id AS pair_id, (count(*) FILTER (shared))::INT AS n_prompt_turns,
    coalesce(string_agg(a, '' ORDER BY i) FILTER (shared), '') AS prompt,
    coalesce(string_agg(a, '' ORDER BY i) FILTER (NOT shared), '') AS chosen,
    coalesce(string_agg(b, '' ORDER BY i) FILTER (NOT shared), '') AS rejected,
    coalesce(string_agg((at_a + skip) || '-' || (at_a + length(a)), ',' ORDER BY i)
        FILTER (NOT shared AND role = 'assistant'), '') AS chosen_spans,
    coalesce(string_agg((at_b + skip) || '-' || (at_b + length(b)), ',' ORDER BY i)
        FILTER (NOT shared AND role = 'assistant'), '') AS rejected_spans
FROM placed GROUP BY conv_id
"""


@query("op5_preference_format", _PREFERENCE_SQL)
def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with its last reply replaced by its first."""
    chosen = preference.gather_turns(table(spark, sf_dir, "conversations"), "conv_id", "chosen")
    made = preference.format_preferences(chosen, preference.with_earlier_reply(chosen))
    shown = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ","
    )
    return made.withColumn("chosen_spans", shown("chosen_spans")).withColumn(
        "rejected_spans", shown("rejected_spans")
    )


@query("op6_token_counts")
def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(PIECE_MODEL), token_counts.LIMIT)
    return counted.select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_tokens", "over_limit", "cut_chars"
    )


@query("op7_embedding_dedup")
def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_minhash_dedup")
def near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its class; a document in no class is its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bagminhash.near_duplicates(docs).select("doc_id", "class_id", "kept")


_CONTAMINATION_SQL = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS k,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
    SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS t
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT n FROM windows
), hits AS (
    SELECT k, i, c.n, item
    FROM (SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n) c
    JOIN windows ON windows.n = c.n AND windows.t = array_to_string(w[i:i + c.n - 1], ' ')
), per_doc AS (
    SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
    FROM hits GROUP BY k
), covered AS (
    SELECT k, count(DISTINCT p) AS n_hit
    FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hits) GROUP BY k
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN per_doc USING (k) LEFT JOIN covered USING (k)
"""


@query("op9_decontamination", _CONTAMINATION_SQL)
def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    judged = decontaminate.digest(found)
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        "contaminated",
    )


@query("op10_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(WORD_MODEL))

_PHRASE_SQL = r"""
WITH pieces AS (
    SELECT lang, k, p, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (
        SELECT lang, k, generate_subscripts(s, 1) AS p, unnest(s) AS piece
        FROM (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS k,
                regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS s
            FROM documents
        )
    )
), placed AS (
    SELECT lang, k, p, generate_subscripts(w, 1) AS i, unnest(w) AS a FROM pieces
), told AS (
    SELECT lang, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM placed
    WINDOW o AS (PARTITION BY k, p ORDER BY i)
), f AS MATERIALIZED (
    SELECT lang, a AS phrase, 1 AS size, count(*) AS n FROM told GROUP BY ALL HAVING count(*) >= 10
    UNION ALL
    SELECT lang, a || ' ' || b, 2, count(*) FROM told WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
    UNION ALL
    SELECT lang, a || ' ' || b || ' ' || c, 3, count(*) FROM told WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
    SELECT lang, phrase, size, n AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1)
), scored AS (
    SELECT c.lang, c.phrase, c.size, a, x.n AS l, y.n AS r,
        ((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n))::BIGINT AS score
    FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.phrase = c.head
    JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, phrase, max(n) AS longer
    FROM (
        SELECT lang, n, array_to_string(w[1:2], ' ') AS phrase FROM (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size = 3)
        UNION ALL
        SELECT lang, n, array_to_string(w[2:3], ' ') FROM (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size = 3)
    ) GROUP BY ALL
), totals AS (
    SELECT lang, count(*) AS n FROM placed GROUP BY lang
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
    s.phrase, a, l, r, t.n, score
FROM scored s
JOIN totals t ON t.lang = s.lang
LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase AND s.size = 2
WHERE i.longer IS NULL OR 100 * i.longer < 50 * a
QUALIFY row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) <= 2000
"""


@query("op11_phrases", _PHRASE_SQL)
def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    scored = phrases.score_phrases(*phrases.mine_phrases(docs))
    ranked = phrases.rank_phrases(phrases.without_parts(scored), 2000)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_FILL_SQL = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
        sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), draws AS (
    SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM units
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
            THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM draws
), parts AS (
    SELECT *, array_to_string(u[1:i], '') AS prefix, array_to_string(u[i + 1:j], '') AS middle,
        array_to_string(u[j + 1:], '') AS suffix
    FROM cut
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""


@query("op12_fill_in_middle", _FILL_SQL)
def filled_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_middle.fill_in_middle(docs)
    hashed = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        F.col("row.doc_id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        hashed(F.col("output")).alias("output_sha256"),
        hashed(fill_middle.restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


@query("op13_byte_bpe")
def byte_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(BYTE_RANKS)
    coded = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, keep=["doc_id"])
    return coded.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), path), 256).alias("decoded_sha256"),
    )
