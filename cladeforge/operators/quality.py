"""Quality scores of structures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.functions.text import half_up
from cladeforge.operators.asof import asof_release

#: Parts of words in comments that each cost 2.
BAD_WORDS = ["chimer", "circular", "disorder", "error", "incorrect", "interrupted", "misfolded", "missing", "mistraced", "mutant", "permut", "truncat"]
#: Offsets and widths that scale the four checks of the second program.
WHATCHECK = [(8.0, 16.0), (8.0, 12.0), (5.0, 7.0), (10.0, 15.0)]


def _unknown(resolution: Column) -> Column:
    return resolution.isNull() | (resolution == 0)


def spaci(df: DataFrame) -> DataFrame:
    """df (method, resolution, r_factor, procheck1..3, whatcheck1..4) with effective values, both summaries and spaci."""
    method, resolution = F.col("method"), F.col("resolution")
    e_res = F.when(method.rlike("^NMR[0-9]"), 3.8).when(method.startswith("NMR"), 4.0).when(method.startswith("THEORY"), 20.0).when(_unknown(resolution), 5.0).otherwise(resolution)
    e_r = F.when(method.startswith("NMR"), 0.25).when(method.startswith("THEORY"), 1.0).when(_unknown(resolution), 0.5).otherwise(F.coalesce("r_factor", F.lit(0.25)))
    pro = F.coalesce((F.col("procheck1") + F.col("procheck2") + F.col("procheck3") - 3.0) / 6.0, F.lit(1.0))
    parts = [(F.col(f"whatcheck{i + 1}") + a) / b for i, (a, b) in enumerate(WHATCHECK)]
    what = F.coalesce(1.0 - (parts[0] + parts[1] + parts[2] + parts[3]) / 4.0, F.lit(1.0))
    out = df.select("*", e_res.alias("effective_resolution"), e_r.alias("effective_r_factor"), what.alias("summary_whatcheck"), pro.alias("summary_procheck"))
    return out.withColumn("spaci", 0.1 + 1.0 / F.col("effective_resolution") - (F.col("effective_r_factor") - 0.1) - 0.1 * F.col("summary_whatcheck") - 0.1 * F.col("summary_procheck"))


def aerospaci(df: DataFrame, comments: DataFrame) -> DataFrame:
    """df (pdb_release_id, method, spaci) with aerospaci: less 2 for each bad word in comments (pdb_release_id, description), less 5 for theory."""
    found = comments.groupBy("pdb_release_id").agg(*(F.max(F.lower("description").contains(w).cast("int")).alias(f"__{i}") for i, w in enumerate(BAD_WORDS)))
    count = sum((F.coalesce(F.col(f"__{i}"), F.lit(0)) for i in range(len(BAD_WORDS))), F.lit(0))
    theory = F.when(F.col("method").startswith("THEORY"), 5.0).otherwise(0.0)
    return df.join(found, "pdb_release_id", "left").withColumn("aerospaci", F.col("spaci") - 2.0 * count - theory).drop(*(f"__{i}" for i in range(len(BAD_WORDS))))


def freeze_quality(releases: DataFrame, snapshots: DataFrame, measures: DataFrame, comments: DataFrame, literature: DataFrame, freeze_date: str) -> DataFrame:
    """entry_id, pdb_release_id, spaci, aerospaci of the release of each entry at a date; literature entries are left out."""
    valid = asof_release(releases, snapshots, freeze_date).select("entry_id", F.col("id").alias("pdb_release_id")).join(literature.select("entry_id"), "entry_id", "left_anti")
    return aerospaci(spaci(valid.join(measures, "pdb_release_id")), comments).select("entry_id", "pdb_release_id", "spaci", "aerospaci")


def rank_by_quality(df: DataFrame, measure: str) -> DataFrame:
    """df (question, code, measure) with rank, is_best and is_preferred by measure; ties share a rank.

    A question with a missing value has no ranks at all; one with a tie for best has no preferred code.
    """
    own = Window.partitionBy("question")
    complete = F.count(measure).over(own) == F.count("*").over(own)
    rank = F.when(complete, F.rank().over(own.orderBy(F.desc(measure))))
    out = df.withColumn("rank", rank)
    best = F.col("rank") == 1
    ties = F.sum(best.cast("int")).over(own)
    return out.withColumn("is_best", F.coalesce(best, F.lit(False))).withColumn("is_preferred", F.coalesce(best & (ties == 1), F.lit(False)))


def score_items(items: DataFrame, scores: DataFrame) -> DataFrame:
    """items (id, entry_id) with the entry's score rounded to 0.01, halves up; 0 if it has none. scores: entry_id, aerospaci."""
    return items.join(scores.select("entry_id", "aerospaci"), "entry_id", "left").withColumn("score", F.coalesce(half_up(F.col("aerospaci")), F.lit(0.0))).drop("aerospaci")
