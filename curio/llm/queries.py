"""Registered queries of the training-data operators: thin wrappers with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curio.llm.common import table


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import jaccard_join

    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import line_dedup

    return line_dedup.report(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import decontaminate

    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from curio.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import media

    return media.report(table(spark, sf_dir, "documents"))


def media_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import media

    return media.report_clips(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from curio.llm import token_counts

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import toxicity

    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import warc

    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from curio.llm import token_ids

    return token_ids.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import surrogates

    key = spark.conf.get("spark.curio.surrogates.key", "registered query")  # a deployment sets a secret of its own
    return surrogates.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import fill_middle

    return fill_middle.report(table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import quality

    return quality.report(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curio.llm import spelling

    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_media": op1_media,
    "media_clips": media_clips,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_packing": op8_packing,
    "op9_token_ids": op9_token_ids,
    "op10_surrogates": op10_surrogates,
    "op11_fill_middle": op11_fill_middle,
    "op12_quality": op12_quality,
    "op13_spelling": op13_spelling,
}


def _oracles() -> dict[str, str]:
    from curio.llm import decontaminate, fill_middle, warc

    return {"op4_warc": warc.ORACLE, "op7_decontaminate": decontaminate.ORACLE, "op11_fill_middle": fill_middle.ORACLE}


ORACLES: dict[str, str] = _oracles()
