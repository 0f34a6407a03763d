"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftplan.llm import (decontaminate, exact_dedup, hard_negatives, license_scan, mixing, ngram_join, packing, prefix_trie, sharding,
                          substring_dedup, token_file, toxicity, warc)
from liftplan.llm.shared import prepare, table
from liftplan.session import scratch_path

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}

_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_WORDS = r"'[^\x20\x09-\x0D]+'"


def _shingles_sql(kind: str, id_col: str, table_name: str) -> str:
    """Distinct five-word shingles of a table's texts: kind, id, h."""
    return f"""SELECT DISTINCT '{kind}' AS kind, id, md5(array_to_string(CASE WHEN len(words) >= 5 THEN list_slice(words, i, i + 4) ELSE words END, ' ')) AS h
  FROM (SELECT {id_col} AS id, regexp_extract_all({_LOWER_SQL}, {_WORDS}) AS words FROM {table_name}) w,
       unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) t(i)"""


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``key``."""
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        run.__name__, run.__doc__ = key, fn.__doc__
        LLM_QUERIES[key] = run
        if sql:
            LLM_ORACLES[key] = sql
        return fn
    return register


@query("op2_token_planes")
def token_planes(spark, folder):
    """Token ids of all documents through the byte-plane file."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    token_file.write_tokens(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_file.read_tokens(spark, path, digest=True)


@query("op4_exact_dedup", f"""
WITH n AS (SELECT doc_id, {_LOWER_SQL} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n""")
def exact(spark, folder):
    """Owners of equal texts: the largest id stays."""
    made = exact_dedup.exact_dedup(table(spark, folder, "documents"))
    return made.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op5_virtual_slots")
def virtual_slots(spark, folder):
    """All documents over eight shards by a slot map that evens out bytes."""
    made = sharding.shard_documents(table(spark, folder, "documents"), scratch_path(spark, "slot-map"), 8)
    return made.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


@query("op6_pareto_mix", mixing.oracle())
def pareto_mix(spark, folder):
    """Words that the mix takes of each document."""
    return mixing.mix_sources(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * i + 1}, 5))::INT >> {shift}) & 31) + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0))


@query("op8_warc_splits", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
o AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS owner FROM p)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM owner THEN owner END AS refers_to
FROM o""")
def warc_splits(spark, folder):
    """Pages through WARC archives read in byte ranges."""
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), path)
    made = warc.read_warc(spark, path, with_payload=False)
    return made.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op1_ngram_jaccard", f"""
WITH RECURSIVE shingles AS ({_shingles_sql('d', 'doc_id', 'documents')}),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared_by AS (SELECT a.id AS a, b.id AS b, count(*) AS o FROM shingles a JOIN shingles b ON a.h = b.h AND a.id < b.id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared_by JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reached.id, ends.b FROM reached JOIN ends ON reached.r = ends.a)
SELECT reached.id AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes ON sizes.id = reached.id GROUP BY reached.id""")
def jaccard(spark, folder):
    """Components of documents linked by shingle Jaccard similarity of 0.75 or more."""
    return ngram_join.ngram_jaccard(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op3_toxicity")
def toxic(spark, folder):
    """Toxicity scores of all documents; labels are learned from rows that are not held out."""
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query("op7_benchmark_decontamination", f"""
WITH docs AS ({_shingles_sql('d', 'doc_id', 'documents')}),
items AS ({_shingles_sql('i', 'item_id', 'benchmark')}),
sizes AS (SELECT id, count(*) AS n_item FROM items GROUP BY id),
met AS (SELECT docs.id AS doc_id, items.id AS item_id, count(*) AS shared FROM docs JOIN items USING (h) GROUP BY 1, 2)
SELECT doc_id, item_id, shared, n_item, shared::DOUBLE / n_item::DOUBLE AS containment
FROM met JOIN sizes ON sizes.id = item_id WHERE 100 * shared >= 75 * n_item""")
def decontamination(spark, folder):
    """Documents and the benchmark items that they contain."""
    made = decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return made.select("doc_id", "item_id", "shared", "n_item", "containment")


@query("op9_substring_dedup", f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS words FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(words, i, i + 19), ' ')) AS h FROM w, unnest(range(1, len(words) - 18)) t(i)),
firsts AS (SELECT h, min((doc_id, i)) AS place FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, j FROM win JOIN firsts USING (h), unnest(range(i, i + 20)) t(j) WHERE (doc_id, i) > place),
each AS (SELECT doc_id, j, words[j] AS word FROM w, unnest(range(1, len(words) + 1)) t(j)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text FROM each ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (SELECT count(*) FROM gone WHERE gone.doc_id = w.doc_id)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""")
def substrings(spark, folder):
    """Words left in each document when repeated 20-word windows go."""
    made = substring_dedup.substring_dedup(table(spark, folder, "documents"), with_text=False)
    return made.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op10_license_scan")
def licenses(spark, folder):
    """License phrases and notices in each document."""
    made = license_scan.license_scan(table(spark, folder, "documents"))
    return made.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op11_hilbert_negatives", hard_negatives.oracle())
def negatives(spark, folder):
    """Hard negatives of every hundredth vector; labels of every seventh are moved on by one."""
    moved = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query("op12_prefix_trie", prefix_trie.oracle())
def trie(spark, folder):
    """Nodes of the prefix trie of conversations rebuilt on shared heads."""
    return prefix_trie.prefix_trie(prefix_trie.shared_heads(table(spark, folder, "conversations")))


@query("op13_best_fit_packing")
def packed(spark, folder):
    """Pieces of all documents in sequences of at most 4,096 tokens."""
    import public_tokenizers

    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
