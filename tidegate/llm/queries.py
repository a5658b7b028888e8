"""The registered queries of this subpackage over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import ship_package
from . import (
    ann,
    binpack,
    boundpack,
    bpe,
    divergence,
    embdedup,
    hostrank,
    linededup,
    packing,
    quality,
    simhash,
    trie,
    warc,
)
from .shared import staged


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, _vocabulary("byte_bpe_50k.json"), _pattern())


def op4_binpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    packed = staged(
        binpack.matrices(docs, _vocabulary("byte_bpe_50k.json"), _pattern()), "id-matrices"
    )
    return packed.select(
        "sequence",
        "n_tokens",
        "doc_ids",
        "starts",
        "cu_seqlens",
        "position_resets",
        F.sha2("ids", 256).alias("ids_sha256"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return clean.select(
        "doc_id",
        F.size("lines_removed").alias("n_removed"),
        F.concat_ws(",", F.transform("lines_removed", lambda k: k.cast("string"))).alias("lines_removed"),
        F.octet_length("text").cast("long").alias("text_bytes"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


def op6_host_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrank.judge(_table(spark, sf_dir, "pages"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.encoded(docs, _vocabulary("byte_bpe_50k.tiktoken"), _pattern())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_bound_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundpack.pack(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.numbered(_table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(*trie.with_shared_heads(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_warc,
        op3_packing,
        op4_binpack,
        op5_line_dedup,
        op6_host_rank,
        op7_embedding_dedup,
        op8_bpe,
        op9_quality,
        op10_ann,
        op11_source_divergence,
        op12_bound_packing,
        op13_prefix_trie,
    )
}

ORACLE: dict[str, str] = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT d.page_id, payload_bytes, payload_digest,
            CASE WHEN first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first <> d.page_id THEN first END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)
    """,
    "op7_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), s AS (
            SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
                AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM s a JOIN s b
                ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
        n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
        SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
        FROM v JOIN c ON v.vec_id = c.vec_id LEFT JOIN n ON v.vec_id = n.vec_id
    """,
    "op11_source_divergence": r"""
        WITH d AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS rid,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), w AS (
            SELECT lang, source, rid, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ), kept AS (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT rid) >= 3),
        c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
        size AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
        g AS (
            SELECT lang, source, coalesce(sum(n), 0) AS n
            FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY 1, 2
        ), p AS (
            SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
                1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + v)::HUGEINT AS p
            FROM g JOIN size USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
        ), q AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (t.n + 1)) // (all_.n + v)::HUGEINT AS q
            FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2) t
            JOIN (SELECT lang, sum(n) AS n FROM c GROUP BY 1) all_ USING (lang) JOIN size USING (lang)
        ), both_ AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
        ), parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(both_.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN both_ ON both_.lang = a.lang AND both_.source = a.source AND both_.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM parts
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR r <= 200
    """,
    "op13_prefix_trie": """
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, length(coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), size AS (SELECT c, count(*) AS n FROM t GROUP BY 1),
        plan AS (
            SELECT c, n, c - c % 100 AS head, xor(4294967295::BIGINT, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                    lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END))) % 6 AS h
            FROM size
        ), plans AS (
            SELECT plan.*, least(h, coalesce(size.n, 0)) AS taken FROM plan LEFT JOIN size ON size.c = plan.head
        ), rebuilt AS (
            SELECT plans.c, pos - h + taken AS pos, role, text FROM plans JOIN t ON t.c = plans.c WHERE pos > h
            UNION ALL
            SELECT plans.c, pos, role, text FROM plans JOIN t ON t.c = plans.head WHERE pos <= taken
        ), lens AS (SELECT plans.c, count(pos) AS n FROM plans LEFT JOIN rebuilt USING (c) GROUP BY 1),
        members AS (
            SELECT c, 0 AS d, 0 AS chars, [] AS key FROM lens
            UNION ALL
            SELECT c, pos, length(text), list([role, text]) OVER (PARTITION BY c ORDER BY pos) FROM rebuilt
        ), node AS (SELECT d, key, min(c) AS id, count(*) AS n, any_value(chars) AS chars FROM members GROUP BY 1, 2),
        path AS (SELECT m.c, m.d, node.id, node.n, node.chars FROM members m JOIN node USING (d, key)),
        kids AS (
            SELECT p.id, p.d, count(DISTINCT q.id) AS k FROM path p JOIN path q ON p.c = q.c AND q.d = p.d + 1 GROUP BY 1, 2
        ), nodes AS (
            SELECT DISTINCT path.id, path.d, n, chars, coalesce(k, 0) AS k FROM path LEFT JOIN kids USING (id, d)
        ), below AS (
            SELECT a.id, a.d, sum((b.n - 1) * b.chars) AS saved, count(*) FILTER (b.k = 0) AS leaves
            FROM nodes b JOIN path a ON a.c = b.id AND a.d <= b.d GROUP BY 1, 2
        ), ends AS (
            SELECT id, d, string_agg(path.c::VARCHAR, ',' ORDER BY path.c) AS ids
            FROM path JOIN lens ON lens.c = path.c AND lens.n = path.d GROUP BY 1, 2
        )
        SELECT nodes.id AS conv_id, CAST(nodes.d AS BIGINT) AS depth, up.id AS parent_conv_id, nodes.n AS n_convs,
            nodes.k AS n_children, below.leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
            sha256(coalesce(ids, '')) AS ends_sha256
        FROM nodes JOIN below ON below.id = nodes.id AND below.d = nodes.d
        LEFT JOIN path up ON up.c = nodes.id AND up.d = nodes.d - 1
        LEFT JOIN ends ON ends.id = nodes.id AND ends.d = nodes.d
    """,
}
