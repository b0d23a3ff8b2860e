"""One query per text operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from coinwharf.llm import align, bpe, decontaminate, htmltext, licenses, packing, pii, quality, secrets, simhash, spelling, token_files, toxicity
from coinwharf.llm.common import reach_workers, table
from coinwharf.session import work_path

CAPACITY, PACK_END, FILE_END = 2048, 0, 1
#: The key of the pseudonyms in the query; a real one is a secret of the caller.
PSEUDONYM_KEY = "coinwharf"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.cut_texts(table(spark, sf_dir, "documents"), tokenizer, PACK_END, CAPACITY)
    return packing.pack(pieces, CAPACITY).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_notices(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), FILE_END)
    return token_files.token_digests(token_files.read_tokens(spark, path))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("group").alias("component_id"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.page_texts(table(spark, sf_dir, "pages"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.token_links(table(spark, sf_dir, "documents"), *paths)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.there_and_back(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def _reaching(query: Callable) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    query.__name__: _reaching(query)
    for query in (op1_decontaminate, op2_secrets, op3_quality, op4_packing, op5_licenses, op6_pii, op7_token_files, op8_simhash, op9_toxicity, op10_html, op11_alignment, op12_spelling, op13_bpe)
}
#: None of these has a whole equivalent in SQL; tests/llm holds brute-force versions.
ORACLE: dict[str, str] = {}
