"""The pipeline and the registered queries on the smallest tables."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from coinwharf.llm import decontaminate, quality, secrets, simhash
from coinwharf.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    kept = {r["doc_id"] for r in quality.quality(docs).where("kept").collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
        if name == "quality_rules":
            assert {r["doc_id"] for r in docs.collect()} == kept
        if name == "simhash_near_dedup":
            groups = {r["group"] for r in simhash.near_groups(before).collect()}
            assert {r["doc_id"] for r in docs.collect()} == groups
        if name == "benchmark_decontamination":
            found = {r["doc_id"] for r in decontaminate.benchmark_matches(before, table(spark, SF_DIR, "benchmark")).collect()}
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()} - found
    assert not any(secrets.find_secrets(r["text"]) for r in docs.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
    assert packed.groupBy("sequence_id").sum("length").where(f"`sum(length)` > {corpus_pipeline.CAPACITY}").isEmpty()


def test_native_operators_have_no_python(spark):
    from coinwharf.llm import pii

    docs = table(spark, SF_DIR, "documents")
    for df in (quality.measures(docs), quality.quality(docs), pii.pseudonymised(docs, "k")):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


EXPECTED = {
    "op1_": ["doc_id", "item_id"],
    "op2_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op3_": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op5_": ["doc_id", "license"],
    "op6_": ["doc_id", "text"],
    "op7_": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op8_": ["doc_id", "fingerprint", "component_id"],
    "op9_": ["doc_id", "held_out", "score", "predicted"],
    "op10_": ["page_id", "url", "text", "n_chars"],
}


@pytest.mark.parametrize("prefix", list(EXPECTED))
def test_query_columns(spark, prefix):
    (name,) = [n for n in contract.queries() if n.startswith(prefix)]
    df = contract.queries()[name](spark, SF_DIR)
    assert df.columns[: len(EXPECTED[prefix])] == EXPECTED[prefix]
    assert df.count() > 0


def test_fingerprints_are_hex(spark):
    rows = contract.queries()["op8_simhash"](spark, SF_DIR).collect()
    assert all(len(r["fingerprint"]) == 16 and set(r["fingerprint"]) <= set("0123456789abcdef") for r in rows)
    assert all(r["component_id"] <= r["doc_id"] for r in rows)
