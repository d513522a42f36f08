"""One registered query per operator: production settings, whole tables, whole results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import bpe
from landfall.llm.centroids import centroid_clusters
from landfall.llm.collocations import collocations
from landfall.llm.common import table
from landfall.llm.decontaminate import find_passages
from landfall.llm.html_extract import html_extract
from landfall.llm.language_id import language_id
from landfall.llm.lm_score import lm_score
from landfall.llm.near_dedup import near_dedup
from landfall.llm.quality_classifier import quality_classifier
from landfall.llm.quality_rules import fit_quality, quality_rules
from landfall.llm.sql import CLUSTERS, COLLOCATIONS, NEAR_DEDUP, SUFFIX_DEDUP
from landfall.llm.suffix_dedup import suffix_dedup
from landfall.llm.toxicity import toxicity
from landfall.llm.url_filter import url_filter

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {"op3_suffix_dedup": SUFFIX_DEDUP, "op10_near_dedup": NEAR_DEDUP,
                           "op12_centroid_clusters": CLUSTERS, "op13_collocations": COLLOCATIONS}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return language_id(table(spark, sf_dir, "documents"), held_out)


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("_which")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_rules(documents, fit_quality(documents, table(spark, sf_dir, "labels")))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


@query
def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(table(spark, sf_dir, "pages"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).drop("_which")


@query
def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return lm_score(table(spark, sf_dir, "documents"), held_out)


@query
def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
