"""The registered queries of the training-data operators: ``opN_<name>`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import arc, audit, bpe, decontam, licenses, quality, quotes, shards, simhash, sketch, spelling, suffix, tokens
from shelfline.llm.common import read_table


def op1_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality score of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out("doc_id").alias("held_out"), "score",
                                             (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as ARC files, converted to WARC files, read back."""
    return (arc.pages_round_trip(read_table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


#: SHA-1 in base32: four digits of 5 bits from every five hexadecimal ones.
BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 5 * (i // 4)}, 5))::BIGINT >> {15 - 5 * (i % 4)}) & 31)::INT, 1)"
                     for i in range(32))
OP2_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
     d AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS best, {BASE32} AS digest FROM p)
SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM d
"""


def op3_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of the conversations with its links and its text without quotes, in reply order."""
    rows = quotes.linked(read_table(spark, sf_dir, "conversations"))
    return rows.select(F.col("conv").alias("conv_id"), "turn", "role", "reply_turn", "thread_turn", "n_quotes", "n_linked", "max_depth",
                       F.col("own").alias("text"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents covered by a 100-byte string that also starts earlier, removed."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return suffix.remove_repeats(docs, length=100).select(
        "doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"), "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"))


def op5_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes, equal texts side by side."""
    body = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(body).cast("long") + 1
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = shards.histogram_shards(docs, F.xxhash64(body), "doc_id", size, 16)
    # the digests are those of the sharded rows
    return out.select("doc_id", size.alias("size"), F.crc32(body).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the library of the lower-case word vocabulary."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
                                                         .alias("n_bytes"), "text")
    return tokens.token_counts(docs).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 4-word shingles, links at 4 or fewer bits."""
    near = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       F.col("component").alias("component_id"))


def op8_spaced_seed_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds (13 tokens or more, 80 % of them equal)."""
    hits = decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return hits.select(F.col("row_id").alias("doc_id"), F.col("item").alias("item_id"), "n_tokens", "n_equal",
                       F.col("n_item").alias("item_tokens")).distinct()


def op9_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold-scaled sketches of every document, of its edited text, and their likeness."""
    rows = sketch.compared_with_edits(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       sketch.fingerprint(F.col("own")).alias("fingerprint"),
                       sketch.fingerprint(F.col("edited_hashes")).alias("edited_fingerprint"),
                       sketch.containment(F.col("own"), F.col("edited_hashes")).alias("near_edited"),
                       sketch.containment(F.col("own"), F.col("next_hashes")).alias("near_next"))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and their decoding, as digests."""
    return bpe.round_trip(read_table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    rows = licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("scan.spans")
    base = F.filter(spans, lambda x: x["exact"])
    starts = base["start"]
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c["label"])), ",")
    return rows.select("doc_id", F.col("scan.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
                       F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                       joined(base).alias("base_labels"), joined(spans).alias("labels"),
                       F.coalesce(F.array_max(spans["share"]), F.lit(0.0)).alias("score"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their neighbours one edit away, their common form and its root."""
    return spelling.variants(read_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, for every source."""
    failed = audit.failures(read_table(spark, sf_dir, "documents"))
    return audit.interactions(failed, read_table(spark, sf_dir, "labels"))


#: The words of a text are counted in lists; the orders are 120 strings and their five steps.
OP13_SQL = """
WITH RECURSIVE letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders(o) AS (SELECT f FROM letters UNION ALL SELECT o || f FROM orders, letters WHERE NOT contains(o, f)),
steps AS (SELECT o, s::INT AS step, (SELECT bit FROM letters WHERE f = substr(o, s::INT, 1)) AS bit,
                 coalesce((SELECT sum(bit) FROM letters WHERE contains(left(o, s::INT - 1), f)), 0)::INT AS before
          FROM orders, generate_series(1, 5) g(s) WHERE length(o) = 5),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
             + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT
             + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
      FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask)
SELECT part, o AS filter_order, step,
       sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN mask & bit <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
FROM c, steps GROUP BY part, o, step
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_ranking, op2_arc_to_warc, op3_quote_linking, op4_suffix_dedup, op5_histogram_shards, op6_token_counts, op7_simhash, op8_spaced_seed_decontam, op9_scaled_sketch, op10_bpe_round_trip,
                             op11_license_scan, op12_spelling_variants, op13_filter_audit)}

#: The others hash, learn, sort suffixes or tokenize in ways that SQL does not express; tests use brute force or the library.
ORACLE_SQL: dict[str, str] = {"op2_arc_to_warc": OP2_SQL, "op13_filter_audit": OP13_SQL}
