"""Every registered query on the smallest tables, and the whole pipeline."""

import hashlib

import pytest

import __spark_entry__ as E
import corpus_pipeline
from strata.llm.pieces import PieceBpe, public_pieces
from strata.llm.queries import ORACLE_SQL, QUERIES
from tools.compare_oracle import canon, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["page_id", "host", "path", "rule", "verdict"],
    "op2": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op3": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op5": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op7": ["doc_id", "fingerprint", "component_id"],
    "op8": ["doc_id", "slot", "shard", "n_bytes"],
    "op9": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op10": ["doc_id", "held_out", "lang_pred", "score"],
    "op11": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"],
    "op13": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name.split("_")[0]]
    rows = [tuple(r) for r in df.collect()]
    if not name.startswith("op13_"):  # that has a row per node of the trie
        table = "pages" if name.startswith("op1_") else "documents"
        ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(COLUMNS[name.split("_")[0]][0]).collect()}
        assert {r[0] for r in rows} == ids
        if not name.startswith("op2_"):
            assert len(rows) == len(ids)
    if name in ORACLE_SQL:
        res = duck(SF).execute(ORACLE_SQL[name])
        assert canon(df.columns, rows) == canon([d[0] for d in res.description], res.fetchall())


def test_round_trip_of_the_encoder(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op5_duckdb_byte_bpe"](spark, SF).collect():
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_pieces_agree_with_the_library(spark):
    p = PieceBpe(public_pieces()).library
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op12_piece_agenda"](spark, SF).collect():
        ids = p.encode(texts[r.doc_id])
        assert r.agrees and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(p.decode(ids).encode()).hexdigest()


def test_one_query_for_each_operator_and_the_pipeline():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert E.queries()["pipeline"] is corpus_pipeline.run and set(QUERIES) <= set(E.queries())


def test_pipeline(spark):
    rows = [
        (1, "The and with this that fox runs over the hill again", "en", "s", 51),
        (2, "THE AND WITH THIS THAT FOX RUNS OVER THE HILL AGAIN", "en", "s", 51),
        (3, "", "en", "s", 0),
        (4, None, "en", "s", None),
        (5, "mail a@b.cc for the other thing that is with you", "en", "s", 48),
        (6, "!!! 123", "en", None, 7),
        (7, "some quite different words of the text here and there", None, "s", 53),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
            kept = out.collect()
            out = spark.createDataFrame(kept, schema)
            ids = sorted(r.doc_id for r in kept)
            assert ids == ([1, 2, 5, 7] if name == "language_id" else [2, 5, 7]), name
        docs = out
    texts = {r.doc_id: (r.text, r.n_chars) for r in kept}
    assert texts[5] == ("mail <email> for the other thing that is with you", 49)
    assert sorted({r.doc_id for r in docs.collect()}) == [2, 5, 7]
    empty = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == [], name


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == COLUMNS["op2"] and out.count() > 150
