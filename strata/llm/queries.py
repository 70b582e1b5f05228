"""The registered queries of the training-data operators: each applies its
operator to the whole of its table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, lower_ascii, read_table
from strata.llm import bpe, langid, merkle, pieces, pii, sharding, spotsigs, urlfilter
from strata.llm.oracle import OP11_SQL, OP13_SQL
from strata.llm.exactdedup import dedup_rows
from strata.llm.packing import pack, token_pieces
from strata.llm.simhash import hex_fingerprint, simhash_components
from strata.llm.substrings import remove_repeats
from strata.llm.trie import prefix_trie


def op1_redirect_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = urlfilter.judge(read_table(spark, sf_dir, "pages"), Scratch(spark, "op1"), carry=["page_id"])
    return rows.select("row.page_id", "host", "path", "rule", "verdict")


def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(read_table(spark, sf_dir, "documents")), Scratch(spark, "op2"))


def op3_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_rows(read_table(spark, sf_dir, "documents"), Scratch(spark, "op3"))
    return rows.select("row.doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_de_bruijn_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = remove_repeats(docs, Scratch(spark, "op4"))
    return rows.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_duckdb_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs).select(
        "row.doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_spotsigs_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spotsigs.edited_fingerprints(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("sigs")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_components(read_table(spark, sf_dir, "documents"), Scratch(spark, "op7"))
    return rows.select("doc_id", hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op8_table_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sharding.place(docs, sharding.production_shards())
    return rows.select("row.doc_id", "slot", "shard", F.octet_length(F.coalesce("row.text", F.lit(""))).cast("long").alias("n_bytes"))


def op9_pii_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs, Scratch(spark, "op9")))
    return found.select("row.doc_id", *[pii.count_of(k).alias(f"n_{k}") for k in pii.KINDS], F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op10_ppm_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rows = langid.predict(docs, langid.fit(docs))
    return rows.select("row.doc_id", langid.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op11")
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    shown = merkle.leaf_digest([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in merkle.COLUMNS])
    manifest = merkle.build(docs, scratch, carry=[F.col("doc_id"), F.when(tampered, shown).alias("shown")])
    ask = F.struct("row.doc_id", "leaf").alias("ask")
    found = merkle.verify(manifest, manifest.leaves.select("tree", "rank", ask, F.coalesce("row.shown", "leaf").alias("leaf")), scratch)
    return found.select("ask.doc_id", "ask.leaf", "subroot", F.lit(manifest.root).alias("root"), "proof_sha256", "folded_root", "verified")


def op12_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.round_trip(docs).select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.btrim(F.to_json("ids"), F.lit("[]")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"), Scratch(spark, "op13"))


QUERIES = {
    "op1_redirect_url_filter": op1_redirect_url_filter,
    "op2_pattern_packing": op2_pattern_packing,
    "op3_streaming_exact_dedup": op3_streaming_exact_dedup,
    "op4_de_bruijn_substring_dedup": op4_de_bruijn_substring_dedup,
    "op5_duckdb_byte_bpe": op5_duckdb_byte_bpe,
    "op6_spotsigs_fingerprints": op6_spotsigs_fingerprints,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_table_sharding": op8_table_sharding,
    "op9_pii_candidate_boosting": op9_pii_candidate_boosting,
    "op10_ppm_language_id": op10_ppm_language_id,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_piece_agenda": op12_piece_agenda,
    "op13_conversation_trie": op13_conversation_trie,
}
# translate() lower-cases A-Z only, as the operator does.
ORACLE_SQL: dict[str, str] = {
    "op3_streaming_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
    "op11_merkle_manifest": OP11_SQL,
    "op13_conversation_trie": OP13_SQL,
}
