"""The registered queries of this package: each applies one operator to its whole table and derives the digests."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import (
    byte_bpe, fill_in_middle, hyperminhash, katz, kmeans_tree, packing, page_difference, pii_crf, prefix_trie, projection_forest,
    quality_fm, token_counts, warc_segments,
)
from tallybook.llm.common import crc_fold
from tallybook.scratch import scratch_dir

MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")

#: Documents scored at least this are accepted.
ACCEPTED = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return page_difference.main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors within a label."""
    return projection_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by the factorisation machine."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality_fm.fit(docs, table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, machine).select(
        "doc_id", (crc_fold("doc_id", quality_fm.FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


def op4_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page to WARC archives with revisits, and back."""
    archive = scratch_dir(spark, "warc")
    warc_segments.write_archive(table(spark, sf_dir, "pages"), archive, scratch_dir(spark, "warc-copies"))
    read = warc_segments.reassemble(warc_segments.read_records(spark, archive))
    rows = warc_segments.page_report(read)
    return warc_segments.with_revisits(rows, scratch_dir(spark, "warc-pages"))


def op5_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector."""
    return kmeans_tree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text to ids and back to bytes."""
    path = MULTI_RANKS
    return byte_bpe.tokens_report(table(spark, sf_dir, "documents"), lambda: byte_bpe.tokenizer_of_ranks(path))


def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by shingles of three words, at a similarity of 0.85."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op8_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's chance under the language model of the documents outside the held-out fold."""
    return katz.train_and_score(table(spark, sf_dir, "documents"), scratch_dir(spark, "katz"), order=3)


def op9_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of power-of-two lengths."""
    path = BPE_JSON
    return packing.pack(table(spark, sf_dir, "documents"), lambda: byte_bpe.tokenizer_of_json(path)).drop("ids").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document by patterns and the field."""
    field = pii_crf.train_table(pii_crf.labelled_table(spark))
    return pii_crf.find(table(spark, sf_dir, "documents"), field).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed for filling in its middle, and restored."""
    return fill_in_middle.transform(table(spark, sf_dir, "documents"))


def op13_token_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BPE_JSON)


QUERIES = {f.__name__: f for f in (
    op1_page_difference, op2_projection_forest, op3_fm_quality, op4_warc_segments, op5_kmeans_tree, op6_byte_bpe, op7_hyperminhash, op8_katz_backoff,
    op9_power_of_two_packing, op10_crf_pii, op11_prefix_trie, op12_fill_in_middle, op13_token_transducer)}

ORACLE = {
    "op2_projection_forest": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
                   sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda e: e * e))) AS size
            FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: NOT coalesce(isfinite(e), false))) = 0),
        links AS (
            SELECT s.vec_id AS a, t.vec_id AS b
            FROM v s JOIN v t ON s.label = t.label AND len(s.x) = len(t.x) AND s.vec_id <> t.vec_id
            WHERE s.size > 0 AND t.size > 0 AND list_dot_product(s.x, t.x) / (s.size * t.size) >= 0.93),
        reached(vec_id, other) AS (
            SELECT a, b FROM links
            UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a),
        least_of AS (SELECT vec_id, min(other) AS other FROM reached GROUP BY 1),
        n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1)
        SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
               least(vec_id, coalesce(other, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(other, vec_id)) AS kept
        FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN least_of USING (vec_id)""",
    "op4_warc_segments": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        k AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest)
                           ELSE page_id END AS keeper
            FROM p)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> keeper THEN keeper END AS refers_to,
               CAST(NULL AS VARCHAR) AS damage
        FROM k""",
    "op7_hyperminhash": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE
                WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1),
                                                         lambda i: array_to_string(words[i:i + 2], ' '))
                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingles
            FROM w),
        t AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS c
            FROM t x JOIN t y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
                AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
            GROUP BY 1, 2),
        links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (n + m - c)),
        ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached(doc_id, other) AS (
            SELECT a, b FROM ends
            UNION SELECT r.doc_id, e.b FROM reached r JOIN ends e ON r.other = e.a),
        least_of AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY 1)
        SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles,
               least(doc_id, coalesce(other, doc_id)) AS component_id,
               doc_id = least(doc_id, coalesce(other, doc_id)) AS kept
        FROM s LEFT JOIN least_of USING (doc_id)""",
    "op11_prefix_trie": """
        WITH own AS (
            SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role,
                                 md5(octet_length(encode(role)) || ' ' || role || text)) AS turns
            FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
            WHERE conv_id IS NOT NULL GROUP BY 1),
        heads AS (
            SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295, list_transform(
                    range(1, length(CAST(conv_id AS VARCHAR)) + 1),
                    lambda i: CAST(ord(substr(CAST(conv_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT))),
                lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295) % 4 AS h
            FROM own),
        rebuilt AS (
            SELECT c.conv_id, list_concat(CASE WHEN f.turns IS NULL THEN [] ELSE f.turns[1:c.h] END, c.turns[c.h + 1:]) AS turns
            FROM heads c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 20),
        prefixes AS (
            SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
        nodes AS (
            SELECT depth, turns[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                                   FILTER (len(turns) = depth), '')) AS ends_sha256
            FROM prefixes GROUP BY 1, 2),
        children AS (
            SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
        told AS (
            SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * len(
                       regexp_extract_all(n.prefix[n.depth].text, '[^\x20\x09-\x0D]+')) END AS saved
            FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.prefix = n.prefix),
        above AS (
            SELECT unnest(range(0, depth + 1)) AS top, prefix, n_children, saved FROM told),
        sums AS (
            SELECT top AS depth, prefix[1:top] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved
            FROM above GROUP BY 1, 2)
        SELECT t.conv_id, CAST(t.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(t.n_convs AS BIGINT) AS n_convs,
               CAST(t.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
               CAST(s.saved AS BIGINT) AS saved_tokens, t.ends_sha256
        FROM told t JOIN sums s ON s.depth = t.depth AND s.prefix = t.prefix
        LEFT JOIN nodes p ON p.depth = t.depth - 1 AND p.prefix = t.prefix[1:t.depth - 1]""",
    "op12_fill_in_middle": """
        WITH units AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents),
        numbers AS (
            SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                        WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM units),
        parts AS (
            SELECT doc_id, n, form, text, array_to_string(u[1:least(x, y)], '') AS prefix,
                   array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle,
                   array_to_string(u[greatest(x, y) + 1:], '') AS suffix
            FROM numbers)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
}
