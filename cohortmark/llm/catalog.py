"""The queries of this subpackage, by name, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, exact_dup, lexical, main_text, merkle, mixing, near_dup, neighbours, pii, piece_codec, quality, secret_scan, warc


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(documents(spark, sf_dir), piece_model())


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii(documents(spark, sf_dir))


def op7_exact_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dup.exact_dup(documents(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(documents(spark, sf_dir))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_dup(documents(spark, sf_dir))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def queries() -> dict:
    found = (
        op1_sentencepiece, op2_warc, op3_quality_rules, op4_main_text, op5_mixing, op6_pii, op7_exact_dup, op8_secret_scan, op9_chat, op10_near_dup,
        op11_neighbours, op12_merkle, op13_lexical,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": warc.ORACLE_SQL,
        "op7_exact_dup": exact_dup.ORACLE_SQL,
        "op9_chat": chat.ORACLE_SQL,
        "op12_merkle": merkle.ORACLE_SQL,
        "op13_lexical": lexical.ORACLE_SQL,
    }
