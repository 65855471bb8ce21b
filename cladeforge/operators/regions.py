"""Hits between sequences, and algebra on the regions [start, start + length) that they and annotations cover."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.operators.residues import HEADER, RECORD, packed, place, residues
from cladeforge.sources.scratch import written


def hit_metrics(hits: DataFrame) -> DataFrame:
    """hits (identities, len1, len2, evalue) with pct_identical and blast_log10_e; E of 0 is -9999."""
    e = F.when(F.col("evalue") == 0, -9999.0).otherwise(F.log10("evalue"))
    return hits.withColumn("pct_identical", 200.0 * F.col("identities") / (F.col("len1") + F.col("len2"))).withColumn("blast_log10_e", e)


def alignment_gaps(alignments: DataFrame, min_len: int = 10) -> DataFrame:
    """hit_id, gap_start, gap_length: runs of `-` in the hit's line, in places of the query; one at the end isn't given.

    alignments: hit_id, query, hit, start (of the query). Within a row, by regular expression over the hit's line.
    """

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        run = re.compile("-{%d,}" % min_len)
        for frame in frames:
            rows = []
            for hit_id, query, hit, start in frame.itertuples(index=False):
                for m in run.finditer(hit or ""):
                    if m.end() < len(hit):
                        before = m.start() - query.count("-", 0, m.start())
                        rows.append((hit_id, start + before, len(m.group()) - query.count("-", m.start(), m.end())))
            yield pd.DataFrame(rows, columns=["hit_id", "gap_start", "gap_length"])

    return alignments.select("hit_id", "query", "hit", "start").mapInPandas(scan, "hit_id long, gap_start long, gap_length long")


def hit_regions(hits: DataFrame, gaps: DataFrame) -> DataFrame:
    """hit_id, start, length: a hit's range without its gaps. hits: hit_id, start, length; gaps: hit_id, gap_start, gap_length."""
    cuts = gaps.groupBy("hit_id").agg(F.array_sort(F.collect_list(F.struct("gap_start", "gap_length"))).alias("gaps"))
    rows = hits.join(cuts, "hit_id", "left").withColumn("gaps", F.coalesce("gaps", F.expr("cast(array() as array<struct<gap_start:bigint,gap_length:bigint>>)")))
    begins = F.concat(F.array(F.col("start").cast("long")), F.transform("gaps", lambda g: g["gap_start"] + g["gap_length"]))
    ends = F.concat(F.transform("gaps", lambda g: g["gap_start"]), F.array((F.col("start") + F.col("length")).cast("long")))
    parts = F.filter(F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("start"), (e - b).alias("length"))), lambda x: x["length"] > 0)
    return rows.select("hit_id", F.explode(parts).alias("p")).select("hit_id", "p.*")


def significant_hits(hits: DataFrame, domains: DataFrame, log10e: float = -4, classes: str = "a-h") -> DataFrame:
    """Hits of at most a log10 E whose target is a domain of the classes. hits: seq1_id, seq2_id, style2_id, blast_log10_e; domains: seq_id, style_id, sccs."""
    good = domains.filter(F.col("sccs").rlike(f"^[{classes}]")).select(F.col("seq_id").alias("seq2_id"), F.col("style_id").alias("style2_id"), F.col("id").alias("target_id"))
    return hits.filter(F.col("blast_log10_e") <= log10e).join(good, ["seq2_id", "style2_id"])


def significant_model_hits(hits: DataFrame, models: DataFrame) -> DataFrame:
    """Model hits of at least the trusted score, three quarters of the model, and a type under 3."""
    own = models.select(F.col("id").alias("model_id"), F.col("length").alias("model_length"), "trusted_cutoff", "type_id")
    return hits.join(own, "model_id").filter((F.col("score") >= F.col("trusted_cutoff")) & (F.col("hmm_length") >= 0.75 * F.col("model_length")) & (F.col("type_id") < 3))


def best_hit_per_target(hits: DataFrame, min_length: int = 20, max_change: int = 10) -> DataFrame:
    """Per chain and target sequence the hit that covers most residues; short ones go, and those to targets of several
    chains, gone since (null), or changed by more than some residues.

    hits: hit_id, chain_id, target_seq_id, length, target_chains, target_length, target_length_now.
    """
    alive = hits.filter((F.col("length") >= min_length) & (F.col("target_chains") == 1) & (F.abs(F.col("target_length") - F.col("target_length_now")) <= max_change))
    return alive.groupBy("chain_id", "target_seq_id").agg(F.max_by(F.struct("hit_id", "length"), F.struct("length", -F.col("hit_id"))).alias("__best")).select("chain_id", "target_seq_id", "__best.*")


def min_max_hit(hits: DataFrame) -> DataFrame:
    """chain_id with the hits of least and largest log10 E, the smaller id of equal ones."""
    low, high = F.struct("blast_log10_e", "hit_id"), F.struct("blast_log10_e", -F.col("hit_id"))
    return hits.groupBy("chain_id").agg(F.min_by("hit_id", low).alias("min_hit"), F.max_by("hit_id", high).alias("max_hit"))


def _shared(s1: Column, l1: Column, s2: Column, l2: Column) -> Column:
    return F.greatest(F.least(s1 + l1, s2 + l2) - F.greatest(s1, s2), F.lit(0))


def region_overlap(pairs: DataFrame) -> DataFrame:
    """Pairs (pair_id, a, b: arrays of start, length of one size) with overlap, unmatched and max_end_error by position."""
    zipped = F.arrays_zip("a", "b")
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + v)
    both = total(F.transform(zipped, lambda z: _shared(z["a"]["start"], z["a"]["length"], z["b"]["start"], z["b"]["length"])))
    either = total(F.transform(zipped, lambda z: z["a"]["length"] + z["b"]["length"]))
    error = F.array_max(F.transform(zipped, lambda z: F.greatest(F.abs(z["a"]["start"] - z["b"]["start"]), F.abs(z["a"]["start"] + z["a"]["length"] - z["b"]["start"] - z["b"]["length"]))))
    return pairs.filter(F.size("a") == F.size("b")).select("pair_id", both.alias("overlap"), (either - 2 * both).alias("unmatched"), error.alias("max_end_error"))


#: Places of one bin of ranges. Pairs of a chain's regions from which on the best matches are sought by distance. Distances of those rounds.
BIN, MANY, ROUNDS = 256, 1_000_000, (2, 16, 128)


def _overlapping(one: DataFrame, two: DataFrame) -> DataFrame:
    """chain_id, a_id, b_id, end_error of ranges (chain_id, a_id, s1, e1 and chain_id, b_id, s2, e2) that overlap: each lies in all bins that it
    touches, and a pair comes out in the bin of its later start alone."""

    def binned(rows: DataFrame, s: str, e: str) -> DataFrame:
        return rows.filter(f"{e} > {s}").withColumn("bin", F.explode(F.sequence(F.floor(F.col(s) / BIN), F.floor((F.col(e) - 1) / BIN))))

    met = binned(one, "s1", "e1").join(binned(two, "s2", "e2"), ["chain_id", "bin"]).filter("s1 < e2 and s2 < e1").filter(F.col("bin") == F.floor(F.greatest("s1", "s2") / BIN))
    return met.select("chain_id", "a_id", "b_id", F.greatest(F.abs(F.expr("s1 - s2")), F.abs(F.expr("e1 - e2"))).alias("end_error"))


def _sides(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    end = F.col("start") + F.col("length")
    return a.select("chain_id", F.col("id").alias("a_id"), F.col("start").alias("s1"), end.alias("e1")), b.select("chain_id", F.col("id").alias("b_id"), F.col("start").alias("s2"), end.alias("e2"))


def all_region_matches(a: DataFrame, b: DataFrame) -> DataFrame:
    """chain_id, a_id, b_id, end_error of annotations (chain_id, id, start, length) that overlap on a chain. Empty regions overlap nothing."""
    return _overlapping(*_sides(a, b))


def _nearest(one: DataFrame, two: DataFrame) -> DataFrame:
    """The best matches on chains with many regions, without all their pairs.

    Regions are points (start, end), the end error is their distance by the larger difference. Equal points are one. Rounds of growing
    distance look for partners in the own and the neighbouring cells of a grid of that width: a best partner at most that far away can't lie elsewhere,
    and what has found one is done. What is left after the last round meets all that it overlaps.
    """
    points = written(one.filter("e1 > s1").groupBy("chain_id", "s1", "e1").agg(F.count("*").alias("n")).drop("n"))
    partners = written(two.filter("e2 > s2").groupBy("chain_id", "s2", "e2").agg(F.min("b_id").alias("b_id")))
    best = F.min_by(F.struct("b_id", "end_error"), F.struct("end_error", "b_id")).alias("m")
    left, found = points, None
    for width in ROUNDS:
        near = F.explode(F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (-1, 0, 1) for y in (-1, 0, 1))))
        mine = left.withColumn("near", near).select("chain_id", "s1", "e1", (F.floor(F.col("s1") / width) + F.col("near.x")).alias("x"), (F.floor(F.col("e1") / width) + F.col("near.y")).alias("y"))
        theirs = partners.select("*", F.floor(F.col("s2") / width).alias("x"), F.floor(F.col("e2") / width).alias("y"))
        error = F.greatest(F.abs(F.expr("s1 - s2")), F.abs(F.expr("e1 - e2")))
        met = mine.join(theirs, ["chain_id", "x", "y"]).filter("s1 < e2 and s2 < e1").withColumn("end_error", error).filter(F.col("end_error") <= width)
        done = written(met.groupBy("chain_id", "s1", "e1").agg(best))
        found = done if found is None else found.union(done)
        left = written(left.join(done, ["chain_id", "s1", "e1"], "left_anti"))
        if left.isEmpty():
            break
    rest = _overlapping(left.withColumn("a_id", F.struct("s1", "e1")), partners).groupBy("chain_id", F.col("a_id.s1").alias("s1"), F.col("a_id.e1").alias("e1")).agg(best)
    return one.join(found.union(rest), ["chain_id", "s1", "e1"]).groupBy("a_id").agg(F.min_by("m", F.struct("m.end_error", "m.b_id")).alias("m")).select("a_id", "m.*")


def best_region_match(a: DataFrame, b: DataFrame) -> DataFrame:
    """a_id, b_id, end_error: per annotation of a the one of b that it overlaps with the least end error, the smaller id of equal ones.

    On chains whose regions make up to MANY pairs by their numbers, all that overlap are compared; on larger ones nearby ones first.
    """
    one, two = _sides(a, b)
    sizes = one.groupBy("chain_id").agg(F.count("*").alias("n1")).join(two.groupBy("chain_id").agg(F.count("*").alias("n2")), "chain_id")
    large = written(sizes.filter(F.col("n1") * F.col("n2") > MANY).select("chain_id"))
    best = F.min_by(F.struct("b_id", "end_error"), F.struct("end_error", "b_id")).alias("m")
    if large.isEmpty():
        return _overlapping(one, two).groupBy("a_id").agg(best).select("a_id", "m.*")
    few = _overlapping(one.join(large, "chain_id", "left_anti"), two).groupBy("a_id").agg(best).select("a_id", "m.*")
    return few.union(_nearest(one.join(large, "chain_id", "left_semi"), two.join(large, "chain_id", "left_semi")))


def _parsed(df: DataFrame, raf: DataFrame) -> DataFrame:
    """df (pdb_chain_id, start_id, end_id) with start, length, and the chain's atom: a letter a residue, `.` where it isn't observed."""
    rows = df.join(packed(raf).drop("letters"), "pdb_chain_id")
    rows = rows.withColumn("__first", place(F.col("runs"), F.col("start_id"))).withColumn("__last", place(F.col("runs"), F.col("end_id"), last=True))
    good = F.col("__last") >= F.col("__first")
    return rows.select(*df.columns, "atom", F.when(good, F.col("__first")).cast("long").alias("start"), F.when(good, F.col("__last") - F.col("__first") + 1).cast("long").alias("length"))


def parse_regions(df: DataFrame, raf: DataFrame) -> DataFrame:
    """df (pdb_chain_id, start_id, end_id) with start, length in letters of the sequence: first residue of the start id to last of the end id."""
    return _parsed(df, raf).drop("atom")


def format_regions(df: DataFrame, raf: DataFrame, chain: str = "A") -> DataFrame:
    """df (pdb_chain_id, start, length) with region text: ends move inwards to observed residues; `A:` for a whole chain,
    null where nothing observed is left."""
    rows = df.join(raf.select("pdb_chain_id", residues(F.col("line")).alias("parts")), "pdb_chain_id")
    seen = F.filter("parts", lambda r: r["atom"].isNotNull())
    rows = rows.withColumn("seen", seen).withColumn("own", F.filter(F.col("seen"), lambda r: (r["idx"] >= F.col("start")) & (r["idx"] < F.col("start") + F.col("length"))))
    whole = (F.get("own", F.lit(0))["idx"] == F.get("seen", F.lit(0))["idx"]) & (F.element_at("own", -1)["idx"] == F.element_at("seen", -1)["idx"])
    text = F.when(F.size("own") > 0, F.when(whole, F.lit(f"{chain}:")).otherwise(F.concat(F.lit(f"{chain}:"), F.get("own", F.lit(0))["res_id"], F.lit("-"), F.element_at("own", -1)["res_id"])))
    return rows.select(*df.columns, text.alias("regions"))


def merged(regions: DataFrame, key: str = "chain_id") -> DataFrame:
    """key, start, end of the union of regions: runs whose start isn't within what came before."""
    own = Window.partitionBy(key).orderBy("start", "length")
    reach = F.max(F.col("start") + F.col("length")).over(own.rowsBetween(Window.unboundedPreceding, -1))
    rows = regions.filter("length > 0").withColumn("new", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0))
    return rows.withColumn("run", F.sum("new").over(own)).groupBy(key, "run").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end")).drop("run")


def subtract_regions(a: DataFrame, b: DataFrame) -> DataFrame:
    """chain_id, start, length: what a covers and b doesn't. Holes between b's merged runs are cut with a's runs."""
    cut = merged(b)
    own = Window.partitionBy("chain_id").orderBy("start")
    far = 1 << 40
    holes = cut.select("chain_id", F.coalesce(F.lag("end").over(own), F.lit(-far)).alias("h0"), F.col("start").alias("h1"))
    holes = holes.union(cut.groupBy("chain_id").agg(F.max("end").alias("h0"), F.lit(far).alias("h1")))
    kept = merged(a).join(holes, "chain_id", "left").withColumn("s", F.greatest("start", F.coalesce("h0", F.lit(-far)))).withColumn("e", F.least("end", F.coalesce("h1", F.lit(far))))
    return kept.filter("e > s").select("chain_id", F.col("s").alias("start"), (F.col("e") - F.col("s")).alias("length"))


def max_gap(a: DataFrame) -> DataFrame:
    """chain_id, max_gap: the largest hole between a chain's regions, 0 if there is none."""
    own = Window.partitionBy("chain_id").orderBy("start")
    return merged(a).withColumn("gap", F.col("start") - F.lag("end").over(own)).groupBy("chain_id").agg(F.coalesce(F.max("gap"), F.lit(0)).alias("max_gap"))


def coverage_stats(regions: DataFrame, lengths: DataFrame, min_run: int = 1) -> DataFrame:
    """chain_id, covered, covered_in_runs, uncovered_in_runs, longest_run, longest_start, pct_covered of chains (lengths: chain_id, chain_length)."""
    clipped = regions.join(lengths, "chain_id").withColumn("e", F.least(F.col("start") + F.col("length"), "chain_length")).withColumn("start", F.greatest("start", F.lit(0))).select("chain_id", "start", (F.col("e") - F.col("start")).alias("length"))
    runs = merged(clipped).withColumn("n", F.col("end") - F.col("start"))
    holes = subtract_regions(lengths.select("chain_id", F.lit(0).alias("start"), F.col("chain_length").alias("length")), clipped)
    covered = runs.groupBy("chain_id").agg(F.sum("n").alias("covered"), F.sum(F.when(F.col("n") >= min_run, F.col("n"))).alias("covered_in_runs"), F.max("n").alias("longest_run"), F.max_by("start", F.struct("n", -F.col("start"))).alias("longest_start"))
    open_ = holes.filter(F.col("length") >= min_run).groupBy("chain_id").agg(F.sum("length").alias("uncovered_in_runs"))
    out = lengths.join(covered, "chain_id", "left").join(open_, "chain_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("chain_id", *map(zero, ("covered", "covered_in_runs", "uncovered_in_runs", "longest_run")), F.col("longest_start").cast("long"), F.round(100.0 * F.coalesce("covered", F.lit(0)) / F.col("chain_length"), 6).alias("pct_covered"))


def close_short_holes(regions: DataFrame, shorter_than: int) -> DataFrame:
    """chain_id, start, end of merged regions, with holes shorter than a length closed."""
    own = Window.partitionBy("chain_id").orderBy("start")
    runs = merged(regions).withColumn("new", F.when(F.col("start") - F.lag("end").over(own) < shorter_than, 0).otherwise(1))
    return runs.withColumn("run", F.sum("new").over(own)).groupBy("chain_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def domain_coverage_check(regions: DataFrame, raf: DataFrame, previous: DataFrame) -> DataFrame:
    """pdb_chain_id, issue, n. regions: pdb_chain_id, domain_id, start_id, end_id; previous: pdb_chain_id, length.

    Issues: overlap (residues in several domains), unknown-residue, unobserved-end, uncovered (observed residues in none),
    length-change (by over ten). A chain without a map is unknown-chain.
    """
    known = raf.select("pdb_chain_id").distinct()
    unknown = regions.join(known, "pdb_chain_id", "left_anti").groupBy("pdb_chain_id").agg(F.count("*").alias("n")).select("pdb_chain_id", F.lit("unknown-chain").alias("issue"), "n")
    # of the maps only what the regions need: observed residues before their ends and on the whole, so that nothing is written out residue by residue
    seen = lambda text: F.length(F.replace(text, F.lit("."), F.lit("")))
    start, end = F.col("start").cast("int"), (F.col("start") + F.col("length")).cast("int")
    hidden = lambda at: (F.substr("atom", at, F.lit(1)) == ".").cast("int")
    placed = _parsed(regions, raf).select(
        "pdb_chain_id", "domain_id", "start", "length", seen(F.col("atom")).alias("seen"), seen(F.left("atom", start)).alias("seen_before"), seen(F.left("atom", end)).alias("seen_up_to"), (hidden(start + 1) + hidden(end)).alias("hidden")
    )
    lost = placed.filter("start is null").groupBy("pdb_chain_id").agg(F.count("*").alias("n")).select("pdb_chain_id", F.lit("unknown-residue").alias("issue"), "n")
    real = placed.filter("start is not null")
    blind = real.filter("hidden > 0").groupBy("pdb_chain_id").agg(F.sum("hidden").alias("n")).select("pdb_chain_id", F.lit("unobserved-end").alias("issue"), "n")
    own = merged(real.select(F.struct("pdb_chain_id", "domain_id").alias("key"), "start", "length"), "key")
    steps = own.select("key.pdb_chain_id", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("by")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("by")))).alias("s")).groupBy("pdb_chain_id", "s.at").agg(F.sum("s.by").alias("by"))
    along = Window.partitionBy("pdb_chain_id").orderBy("at")
    depths = steps.select("pdb_chain_id", F.sum("by").over(along).alias("depth"), (F.lead("at").over(along) - F.col("at")).alias("n"))
    twice = depths.filter("depth > 1").groupBy("pdb_chain_id").agg(F.sum("n").alias("n")).select("pdb_chain_id", F.lit("overlap").alias("issue"), "n")
    chain = Window.partitionBy("pdb_chain_id").orderBy(F.col("start").asc_nulls_last(), "length")
    reach = F.max("seen_up_to").over(chain.rowsBetween(Window.unboundedPreceding, -1))
    # what a region adds to the observed residues of those that start before it
    added = F.greatest(F.col("seen_up_to") - F.greatest("seen_before", F.coalesce(reach, F.lit(0))), F.lit(0))
    left = placed.withColumn("added", F.coalesce(added, F.lit(0))).groupBy("pdb_chain_id").agg((F.max("seen") - F.sum("added")).alias("n"))
    bare = left.filter("n > 0").select("pdb_chain_id", F.lit("uncovered").alias("issue"), "n")
    size = raf.select("pdb_chain_id", F.greatest(F.floor((F.length("line") - HEADER) / RECORD), F.lit(0)).alias("now")).join(previous, "pdb_chain_id").filter(F.abs(F.col("now") - F.col("length")) > 10)
    changed = size.select("pdb_chain_id", F.lit("length-change").alias("issue"), F.abs(F.col("now") - F.col("length")).cast("long").alias("n"))
    return unknown.union(lost).union(blind).union(twice).union(bare).union(changed)


def merge_adjacent_differences(diffs: DataFrame) -> DataFrame:
    """Differences (pdb_chain_id, dbref_id, category_id, diff_start, diff_end, diff_seq) with touching ones of one category and reference made one."""
    own = Window.partitionBy("pdb_chain_id", "dbref_id", "category_id").orderBy("diff_start", "diff_end")
    rows = diffs.withColumn("new", F.when(F.col("diff_start") == F.lag("diff_end").over(own) + 1, 0).otherwise(1)).withColumn("run", F.sum("new").over(own))
    parts = F.array_sort(F.collect_list(F.struct("diff_start", "diff_end", "diff_seq")))
    return rows.groupBy("pdb_chain_id", "dbref_id", "category_id", "run").agg(F.min("diff_start").alias("diff_start"), F.max("diff_end").alias("diff_end"), F.array_join(F.transform(parts, lambda x: x["diff_seq"]), "").alias("diff_seq")).drop("run")
