"""The registered queries of the operators, with the parameters of production use, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.llm import collocation, conversations, decontaminate, embedding_dedup, language, main_text, mixing, pii, ppm, quality, simhash, token_output, toxicity
from pulselake.llm.common import table


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies on this machine; it comes with an installed package."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as token ids in Simple-8b segments, read back from the files."""
    return token_output.encode_table(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors at a cosine of 0.95 or more."""
    return embedding_dedup.near_embeddings(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text by its nearest labelled examples."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all whole texts that lie inside ten-word windows of benchmark items."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text by cross-parsing entropy."""
    return language.languages(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all whole texts and their groups at two or fewer differing bits."""
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when sources weigh 1, 2, 3, repeating, and repeat at most three times."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every whole text under byte-level prediction by partial matching."""
    return ppm.scores(table(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every whole page by a recurrent labeller of its blocks."""
    return main_text.main_text(table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text by a conditional random field over its lines."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged in known ways, with the cheapest edits that put their turns right."""
    return conversations.report(conversations.damaged(table(spark, sf_dir, "conversations")), F.col("lost"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all whole texts: base spans, and those that the weakly supervised classifier adds."""
    return pii.report(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language whose words keep together, over all whole texts."""
    return collocation.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_language_id": op5_language_id,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_mixing": op7_mixing,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_main_text": op9_main_text,
    "op10_quality": op10_quality,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_personal_data": op12_personal_data,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op4_benchmark_decontamination": decontaminate.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op13_collocations": collocation.ORACLE,
}
