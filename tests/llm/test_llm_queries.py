"""Registered queries: their columns and types, and SQL over whole tables where there is some."""

import hashlib
import zlib
from pathlib import Path

import pytest
from compare import difference, duck
from llm_rows import package  # noqa: F401

import __spark_entry__ as entry_module
from starmill.llm import bpe, parity_join, secret_scan
from starmill.llm.queries import ORACLES, QUERIES

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="needs the test tables")

COLUMNS = {
    "op1_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2_edit_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                             "near_edited double, near_next double, near_edited_bands bigint, near_next_bands bigint",
    "op4_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op5_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
                        "labels string, score double",
    "op6_hnsw": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op7_parity_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op8_swap_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op11_entropy_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint, copies int, rate double",
    "op12_source_divergence": "lang string, source string, part string, item string, value bigint, rank int",
    "op13_merkle_manifest": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                            "verified boolean"}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    assert difference(QUERIES[name](spark, ROOT), duck(ROOT), ORACLES[name]) is None


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, ROOT)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    if name not in ("op6_hnsw", "op8_swap_packing", "op12_source_divergence"):
        assert df.count() == spark.read.parquet(f"{ROOT}/documents.parquet").count()


def test_digests(spark):
    import public_tokenizers

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    codec = bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for r in QUERIES["op1_byte_bpe"](spark, ROOT).collect():
        ids = codec.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids)).encode()), sha(docs[r.doc_id].encode()))
    for r in QUERIES["op4_secret_scan"](spark, ROOT).collect():
        spans = [f"{k}:{a}:{b}" for k, a, b, _ in secret_scan.find_spans(docs[r.doc_id])]
        assert r.spans == ",".join(spans)
        assert r.base_sha256 == sha(",".join(s for s in spans if not s.startswith("guess")).encode())
    for r in QUERIES["op7_parity_join"](spark, ROOT).collect():
        assert r.n_shingles == len(parity_join.shingles(docs[r.doc_id]))
    for r in QUERIES["op9_toxicity"](spark, ROOT).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
