"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.embedding_dedup import embedding_dedup
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.html_text import html_text
from tessera.llm.merkle import merkle_manifest
from tessera.llm.mixing import mix
from tessera.llm.quality import quality_scores
from tessera.llm.secrets import KINDS, secret_scan
from tessera.llm.sentencepiece import decode, encode
from tessera.llm.simhash import simhash_dedup
from tessera.llm.substring_dedup import WINDOW, substring_dedup
from tessera.llm.toxicity import toxicity_scores
from tessera.llm.url_filter import RULES, url_filter
from tessera.llm.whitening import by_component, whiten

#: Shingle length and bit distance of SimHash near-duplicates.
SHINGLE, DISTANCE = 4, 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(_table(spark, sf_dir, "pages"), RULES)


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint) AS n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"), "n_layers")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = decode(encode(docs))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"),
                        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        # a marker in a text reads back as a space
                        (F.col("decoded") == F.translate("text", "▁", " ")).alias("round_trip"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"), cosine=0.95)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_lines", "n_shared")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup(_table(spark, sf_dir, "documents"), shingle=SHINGLE, distance=DISTANCE)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), digest=True)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    bad = F.pmod(F.crc32(docs["doc_id"].cast("string").cast("binary")), F.lit(7)) == 0
    found = merkle_manifest(docs, found={"n_chars": F.when(bad, docs["n_chars"] + 1).otherwise(docs["n_chars"])})
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.translate(F.array_join("proof", ""), "|", ""), 256).alias("proof_sha256"),
                        "folded_root", "verified", F.size("proof").alias("n_steps"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_component(whiten(_table(spark, sf_dir, "embeddings")))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"), window=WINDOW).drop("removed")


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_secret_scan, op3_toxicity, op4_sentencepiece, op5_quality, op6_embedding_dedup,
    op7_mixing, op8_html_text, op9_simhash, op10_exact_dedup, op11_merkle, op12_whitening, op13_substring_dedup)}

#: What SQL can say whole, from the definitions.  op11: the trees are lists of
#: nodes, level by level; crc32 by its table.  op13: windows as texts.
ORACLE_SQL = {
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op11_merkle": """
        WITH RECURSIVE crc AS (SELECT """ + "list_transform(" * 8 + "range(256)" + ", lambda c: xor(c >> 1, 3988292384 * (c & 1)))" * 8 + """ AS tab),
        docs AS (
          SELECT *, (xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
                     lambda c, b: xor(c >> 8, crc.tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)) % 7 = 0 AS bad
          FROM documents, crc),
        texts AS (
          SELECT doc_id, lang, n_chars, bad,
                 list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), CAST(n_chars + 1 AS VARCHAR), text],
                                lambda v: coalesce(octet_length(encode(v)) || ':' || v, '-')) AS f FROM docs),
        hashed AS (
          SELECT doc_id, lang, sha256(f[1] || f[2] || f[3] || f[4] || f[6]) AS leaf,
                 sha256(f[1] || f[2] || f[3] || (CASE WHEN bad THEN f[5] ELSE f[4] END) || f[6]) AS seen FROM texts),
        leaves AS (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed),
        tree(lang, level, nodes) AS (
          SELECT lang, 0, list(leaf ORDER BY place) FROM leaves GROUP BY lang
          UNION ALL
          SELECT lang, level + 1, list_transform(range(0, len(nodes), 2), lambda k: sha256(array_to_string(nodes[k + 1:k + 2], '')))
          FROM tree WHERE len(nodes) > 1),
        subroots AS (
          SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM tree WHERE len(nodes) = 1),
        over(level, nodes) AS (
          SELECT 0, list(subroot ORDER BY place) FROM subroots
          UNION ALL
          SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda k: sha256(array_to_string(nodes[k + 1:k + 2], '')))
          FROM over WHERE len(nodes) > 1),
        steps AS (
          SELECT l.doc_id, l.leaf, l.seen, l.lang, l.place, 0 AS part, t.level, l.place >> t.level AS k, t.nodes
          FROM leaves l JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND len(t.nodes) > 1
          UNION ALL
          SELECT l.doc_id, l.leaf, l.seen, l.lang, l.place, 1, o.level, s.place >> o.level, o.nodes
          FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang, over o WHERE len(o.nodes) > 1),
        sides AS (
          SELECT doc_id, leaf, seen, lang, place, part, level,
                 CASE WHEN k % 2 = 1 THEN 'L' || nodes[k] ELSE 'R' || coalesce(nodes[k + 2], '') END AS side FROM steps),
        proofs AS (
          SELECT lang, place, list(side ORDER BY part, level) AS sides FROM sides GROUP BY lang, place)
        SELECT l.doc_id, l.leaf, s.subroot, (SELECT nodes[1] FROM over WHERE len(nodes) = 1) AS root,
               sha256(array_to_string(list_transform(coalesce(p.sides, []), lambda x: x[2:]), '')) AS proof_sha256,
               list_reduce(coalesce(p.sides, []), lambda h, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || h ELSE h || x[2:] END), l.seen) AS folded_root,
               folded_root = (SELECT nodes[1] FROM over WHERE len(nodes) = 1) AS verified,
               CAST(len(coalesce(p.sides, [])) AS INTEGER) AS n_steps
        FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
        LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.place = l.place""",
    "op13_substring_dedup": r"""
        WITH docs AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (
          SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM docs, unnest(range(1, len(w) - 48)) AS t(p)),
        gone AS (
          SELECT doc_id, p FROM windows JOIN (SELECT h, min(doc_id) AS low FROM windows GROUP BY h) USING (h) WHERE low < doc_id),
        words AS (
          SELECT d.doc_id, i, w[i] AS word, coalesce(max(g.p) OVER (PARTITION BY d.doc_id ORDER BY i) > i - 50, false) AS covered
          FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs) d LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.p = d.i)
        SELECT doc_id, CAST(count(i) AS BIGINT) AS n_words, CAST(count(*) FILTER (WHERE covered) AS BIGINT) AS n_removed,
               sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT covered), '')) AS kept_sha256
        FROM docs LEFT JOIN words USING (doc_id) GROUP BY doc_id""",
}
