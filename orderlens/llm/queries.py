"""Registered queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, chat, divergence, merkle, mixing, ngram_join, ngram_lm, packing, quality, secrets, suffix_dedup
from . import url_filter, warc
from .common import scratch, written


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _secret_scan(spark, sf_dir):
    return secrets.digest(secrets.find_secrets(_read(spark, sf_dir, "documents"), ["doc_id"]))


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _pack_sequences(spark, sf_dir):
    return packing.packed_documents(_read(spark, sf_dir, "documents"), _tokenizer())


def _url_filter(spark, sf_dir):
    return url_filter.filter_urls(_read(spark, sf_dir, "pages"), ["page_id"])


def _quality_rules(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality.judge(docs).select("doc_id", *quality.MEASURES, "base_failed", "kept")


def _score_language(spark, sf_dir):
    return ngram_lm.score(_read(spark, sf_dir, "documents"))


def _near_duplicates(spark, sf_dir):
    return ngram_join.near_duplicates(_read(spark, sf_dir, "documents"))


def _warc_normalise(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages")
    return warc.round_trip(pages, scratch(pages, "warc"))


def _chat_format(spark, sf_dir):
    turns = chat.with_control_case(spark, _read(spark, sf_dir, "conversations"))
    return chat.read_back(chat.examples(turns))


def _nearest_vectors(spark, sf_dir):
    return ann.search(_read(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", 10)


def _mix_sources(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sizes = written(mixing.prepared(docs).drop("text"), "mixing-sizes")
    return mixing.mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


def _source_divergence(spark, sf_dir):
    return divergence.audit(_read(spark, sf_dir, "documents"))


def _merkle_manifest(spark, sf_dir):
    return merkle.audit(_read(spark, sf_dir, "documents"))


def _suffix_dedup(spark, sf_dir):
    return suffix_dedup.digest(suffix_dedup.without_repeats(_read(spark, sf_dir, "documents")))


def _pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_secret_scan": _secret_scan,
    "op2_pack_sequences": _pack_sequences,
    "op3_url_filter": _url_filter,
    "op4_quality_rules": _quality_rules,
    "op5_score_language": _score_language,
    "op6_ngram_jaccard": _near_duplicates,
    "op7_warc_normalise": _warc_normalise,
    "op8_chat_format": _chat_format,
    "op9_nearest_vectors": _nearest_vectors,
    "op10_mix_sources": _mix_sources,
    "op11_source_divergence": _source_divergence,
    "op12_suffix_dedup": _suffix_dedup,
    "op13_merkle_manifest": _merkle_manifest,
    "pipeline": _pipeline,
}

ORACLE_SQL = {
    "op3_url_filter": url_filter.oracle_sql(),
    "op4_quality_rules": quality.oracle_sql(),
    "op7_warc_normalise": warc.oracle_sql(),
    "op8_chat_format": chat.oracle_sql(),
    "op10_mix_sources": mixing.oracle_sql(),
    "op11_source_divergence": divergence.oracle_sql(),
    "op13_merkle_manifest": merkle.oracle_sql(),
}
