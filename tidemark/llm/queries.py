"""The operators of this subpackage as registered queries, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.byte_pairs import decoded, encoded
from tidemark.llm.chat_format import formatted_turns, read_back
from tidemark.llm.common import table
from tidemark.llm.decontamination import contained_items
from tidemark.llm.embedding_dedup import near_duplicate_vectors
from tidemark.llm.hard_negatives import hard_negatives
from tidemark.llm.language_id import identified, profiles
from tidemark.llm.lexical_search import ranked_documents
from tidemark.llm.license_scan import scan_licenses
from tidemark.llm.minhash_dedup import near_duplicates
from tidemark.llm.secret_scan import scan_secrets
from tidemark.llm.source_mixing import mixed_sources
from tidemark.llm.toxicity import labelled, scored, trained
from tidemark.llm.warc_bundles import archived
from tidemark.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under a name."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(prepare(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query(
    "op8_minhash_near_dedup",
    r"""
    WITH RECURSIVE word AS (
      SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
      FROM documents
    ), sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
               ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS s
      FROM word
    ), one AS (
      SELECT min(doc_id) AS id, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
    ), flat AS (SELECT id, n, unnest(s) AS x FROM one),
    links AS (
      SELECT l.id AS a, r.id AS b FROM flat l JOIN flat r ON l.x = r.x AND l.id <> r.id
        AND 100 * least(l.n, r.n) >= 80 * greatest(l.n, r.n)
      GROUP BY l.id, r.id, l.n, r.n HAVING 100 * count(*) >= 80 * (l.n + r.n - count(*))
    ), reach AS (
      SELECT id, id AS other FROM one
      UNION
      SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other
    ), least_of AS (SELECT id, min(other) AS component FROM reach GROUP BY id),
    grouped AS (SELECT one.s, component FROM one JOIN least_of USING (id))
    SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id,
           coalesce(component, doc_id) = doc_id AS kept
    FROM sets LEFT JOIN grouped ON sets.s = grouped.s
    """,
)
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query(
    "op9_benchmark_decontamination",
    r"""
    WITH texts AS (
      SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
    ), word AS (
      SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                                   lambda x: x <> '') AS w FROM texts
    ), sets AS (
      SELECT kind, id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
               ELSE list_distinct(list_transform(range(1, len(w) - 3),
                                                 lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
      FROM word
    ), item AS (SELECT id, len(s) AS n, unnest(s) AS x FROM sets WHERE kind = 'b'),
    doc AS (SELECT id, unnest(s) AS x FROM sets WHERE kind = 'd')
    SELECT doc.id AS doc_id, item.id AS item_id, n::BIGINT AS n_item, count(*)::BIGINT AS n_shared,
           count(*) / n AS containment
    FROM doc JOIN item USING (x) GROUP BY doc.id, item.id, n HAVING count(*) >= 0.8 * n
    """,
)
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_source_mixing")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))


@query("op2_secret_scan")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def held_out(modulus: int, remainder: int):
    """Whether a document is kept from training by its id alone."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


@query("op6_language_id")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(4, 2))
    learnt = profiles(docs.where("NOT held_out"))
    return identified(docs.select("doc_id", "held_out", "text"), learnt).drop("text", "known")


# A conversation that every run adds: its texts hold the template's own control strings.
CONTROL = r"\### Assistant: </turn> ok"


@query(
    "op4_chat_format",
    r"""
    WITH every AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
      UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), shaped AS (
      SELECT *, length(text) + length(regexp_replace(regexp_replace(text, '[^#]+', ' ', 'g'), '#(#*)', '\1', 'g'))
                - length(regexp_replace(regexp_replace(text, '[^#]+', ' ', 'g'), '#+', '', 'g'))
                + length(text) - length(replace(text, '\', ''))
                + (length(text) - length(replace(text, '</', ''))) // 2 AS escaped
      FROM every
    )
    SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(4 + length(role) + 2 + escaped + 9)::BIGINT AS formatted_chars
    FROM shaped GROUP BY conv_id
    """,
)
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(1).select(
        F.lit(-7).alias("conv_id"),
        F.explode(F.array(F.struct(F.lit(0), F.lit("user")), F.struct(F.lit(1), F.lit("assistant")))).alias("t"),
    )
    added = added.select("conv_id", F.col("t.col1").alias("turn"), F.col("t.col2").alias("role"), F.lit(CONTROL).alias("text"))
    return read_back(formatted_turns(turns.unionByName(added)))


@query("op10_toxicity")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out(5, 0))
    model = trained(labelled(docs.where("NOT held_out"), table(spark, sf_dir, "labels")))
    return scored(docs, model).drop("text")


@query(
    "op7_warc_bundles",
    """
    WITH payload AS (
      SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
    ), held AS (
      SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS holder FROM payload
    )
    SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id < holder THEN holder END AS refers_to
    FROM held
    """,
)
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages")).drop("url", "payload")


@query(
    "op1_embedding_near_dedup",
    """
    WITH RECURSIVE able AS (
      SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
      SELECT l.vec_id AS a, r.vec_id AS b FROM able l JOIN able r ON l.vec_id <> r.vec_id
      WHERE len(l.e) = len(r.e) AND list_cosine_similarity(l.e, r.e) >= 0.95
    ), reach AS (
      SELECT vec_id AS id, vec_id AS other FROM embeddings
      UNION
      SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other
    ), least_of AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
    FROM least_of LEFT JOIN counted ON a = id
    """,
)
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


@query("op3_license_scan")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op11_byte_pairs")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    read_back = decoded(encoded(table(spark, sf_dir, "documents"), path), path)
    return read_back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op13_lexical_search",
    r"""
    WITH words AS (
      SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
      FROM documents WHERE text IS NOT NULL
    ), item AS (
      SELECT DISTINCT item_id, unnest(list_distinct(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t
      FROM benchmark
    ), doc AS (SELECT doc_id, len(t)::BIGINT AS n, t FROM words WHERE len(t) > 0),
    total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM doc),
    tf AS (
      SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS t FROM doc)
      WHERE t IN (SELECT t FROM item) GROUP BY doc_id, n, t
    ), weight AS (
      SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t, docs
    ), scored AS (
      SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
      FROM item JOIN tf USING (t) JOIN weight USING (t), total GROUP BY item_id, doc_id
    )
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
)
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op12_hard_negatives",
    """
    WITH able AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
             list_inner_product(a.v::DOUBLE[], r.v::DOUBLE[])::BIGINT AS score
      FROM able a JOIN able r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 50 = 0
    ), positive AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, positive_id,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
      AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
    """,
)
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, relabelled=moved)
