"""The dealt operators as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from . import (
    bitplane_store,
    decontaminate,
    fill_in_middle,
    language_id,
    license_scan,
    lsh_forest,
    packing,
    page_text,
    prefix_counts,
    quality_rules,
    sharding,
    spelling,
    suffix_dedup,
)
from .common import table
from .oracles import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and its verdict by distance from the languages' histograms."""
    return quality_rules.quality(table(spark, sf_dir, "documents"))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document without all repeated 400-byte strings, as counts and a digest.

    A last column counts the words of repeated passages of over 50 words, which may have fewer bytes.
    """
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), passage=51).drop("kept")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents")).drop("k1", "k2")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they contain."""
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("k1", "k2")


@query
def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, without what recurs over its host's pages."""
    return page_text.page_texts(table(spark, sf_dir, "pages"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a network trained on rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return language_id.language_id(docs, language_id.fit_language_model(docs))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template matches of every document."""
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and how much of it fits 2048 tokens."""
    return prefix_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, at Jaccard 0.8 on two-word shingles."""
    groups = lsh_forest.near_duplicate_groups(table(spark, sf_dir, "documents"), words=2, percent=80)
    # a null id that is its component's only id counts as that component's smallest
    return groups.select("doc_id", "n_shingles", "component_id",
                         F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as bit planes and read back, as places and checksums."""
    path = shared_path(spark, "token-ids")
    bitplane_store.write_token_ids(table(spark, sf_dir, "documents"), path)
    return bitplane_store.read_token_ids(spark, path, with_ids=False).drop("ids")


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in 16 shards with row counts at most one apart, equal texts together."""
    placed = sharding.balanced_shards(table(spark, sf_dir, "documents"), shards=16, link_by=("text",))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "n_linked", "n_cut")


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of all documents, with each word's more frequent form one edit away."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and rearranged for filling in the middle, and restored, as checksums."""
    return fill_in_middle.transform_digests(table(spark, sf_dir, "documents"))
