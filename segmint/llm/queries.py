"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from segmint.llm import chat, collocations, url_reputation
from segmint.llm.text import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.secret_scan import secret_digests
    return secret_digests(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.packing import packing_digests
    return packing_digests(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.toxicity import toxicity_scores
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.jaccard import Join, jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"), Join(words=3, percent=90, n2=2))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


@query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.language_model import lm_scores
    return lm_scores(table(spark, sf_dir, "documents"))


@query
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.vector_join import vector_components
    return vector_components(table(spark, sf_dir, "embeddings"))


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.url_reputation import url_verdicts
    return url_verdicts(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


ORACLE["op5_url_filter"] = url_reputation.ORACLE


@query
def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.pseudonyms import private_digests
    return private_digests(table(spark, sf_dir, "documents"))


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.licenses import license_paragraphs
    return license_paragraphs(table(spark, sf_dir, "documents"))


@query
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(chat.with_example(table(spark, sf_dir, "conversations")))


ORACLE["op11_chat_format"] = chat.oracle()


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.alignment import alignment_digests
    return alignment_digests(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op13_collocations"] = collocations.ORACLE
