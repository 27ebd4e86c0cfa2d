"""A corpus from raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet to the shared folder and reads it back as the
next one's docs. All but the last return the columns of ``documents``. No
stage's rows can be expressed in SQL (a trained network, minimum-slack packing
by library tokens), so ORACLE_SQL is None and the tests compare the stages
with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlake.llm.common import table, written
from flowlake.llm.decontaminate import without_contaminated
from flowlake.llm.language_id import fit_language_model, keep_identified
from flowlake.llm.lsh_forest import keep_one_of_each_group
from flowlake.llm.packing import pack
from flowlake.llm.suffix_dedup import without_repeats

#: A passage of over 50 words has at least this many bytes in the languages at hand:
#: the shortest of 51 words in clean prose of sf0.1 has 230.
REPEATED_BYTES = 200


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language the network cannot tell."""
    return keep_identified(docs, fit_language_model(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked at Jaccard 0.8 on five-word shingles."""
    return keep_one_of_each_group(docs, words=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every passage of REPEATED_BYTES bytes or more that also stands elsewhere."""
    return without_repeats(docs, threshold=REPEATED_BYTES, digit=REPEATED_BYTES // 2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of 2048 tokens; one row per piece."""
    # its workers hold what the stages before left, so the encoder remembers less
    return pack(docs, remembered=600_000).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
