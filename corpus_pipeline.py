"""Documents made ready for training, in five stages; each works on all that the one before it kept.

Quality classifier, near-dedup (SimHash of five-word shingles, then a Jaccard similarity of at least 0.8), suffix-array dedup, benchmark decontamination, packing. All but the last return the
columns of `documents`: rejected rows, all but one of near copies, and contaminated rows go; repeated passages are cut out
of the texts. The last returns the pieces of the packed sequences.

SQL can't express a trained classifier or the tokenizer, so there is none for the whole. Tests hold near-dedup, repeats,
decontamination and packing against brute-force versions; the classifier only by its accuracy.

Null texts count as empty ones, a null doc_id is a document like others, repeated rows are copies (near-dedup keeps one), empty tables stay
empty, and further columns are carried along up to packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cladeforge.llm import decontamination, near_simhash, packing, quality_model, suffix_dedup
from cladeforge.llm.common import table
from cladeforge.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_simhash.keep_one(docs)


def exact_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.strip_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [("quality_classifier", quality), ("simhash_near_dedup", near_dedup), ("suffix_dedup", exact_substrings), ("decontamination", decontaminated), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over documents. Between stages the lineage is cut in the shared checkpoint folder."""
    from cladeforge.llm.common import checkpointed

    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
