"""Predicted domains: from hits on a chain to accepted annotations, checks against reasons, and places in the tree."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.functions.text import normalise_species
from cladeforge.operators.regions import best_region_match
from cladeforge.operators.tree import numbered

SUFFIXES = "123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0"

Runs = list[tuple[int, int]]


class Taken:
    """A set of disjoint runs [start, end) in order, looked up by bisection."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def _near(self, start: int, end: int) -> range:
        """Places of the runs that share a residue with [start, end)."""
        return range(bisect_right(self.ends, start), bisect_left(self.starts, end))

    def overlap(self, start: int, end: int) -> int:
        return sum(min(end, self.ends[i]) - max(start, self.starts[i]) for i in self._near(start, end))

    def free(self, start: int, end: int) -> Runs:
        """What of [start, end) isn't taken."""
        out, at = [], start
        for i in self._near(start, end):
            if self.starts[i] > at:
                out.append((at, self.starts[i]))
            at = self.ends[i]
        return out + [(at, end)] if at < end else out

    def add(self, start: int, end: int) -> None:
        for s, e in self.free(start, end):
            i = bisect_left(self.starts, s)
            self.starts.insert(i, s)
            self.ends.insert(i, e)


class Chain:
    """What is accepted on a chain, from hits that come one by one in their order; nothing of a rejected hit is held."""

    def __init__(self, max_overlap: int = 10, fill: int = 50, unmatched: int = 20) -> None:
        self.limits = max_overlap, fill, unmatched
        self.taken = Taken()
        self.found: list[tuple[str, Runs]] = []

    def offer(self, name: str, runs: Runs) -> None:
        """One that overlaps the accepted by at most the limit, or half of itself, joins without the overlap. Regions of its own that overlap are one."""
        joined: Runs = []
        for s, e in sorted(runs):
            joined[-1:] = [(joined[-1][0], max(e, joined[-1][1]))] if joined and s < joined[-1][1] else [*joined[-1:], (s, e)]
        runs = joined
        total = sum(e - s for s, e in runs)
        if sum(self.taken.overlap(s, e) for s, e in runs) > min(self.limits[0], total // 2):
            return
        left = [x for s, e in runs for x in self.taken.free(s, e)]
        if left:
            if len(self.found) >= len(SUFFIXES):
                raise ValueError("more domains than there are suffixes")
            self.found.append((name, left))
            for s, e in left:
                self.taken.add(s, e)

    def annotations(self, length: int) -> list[tuple[str, Runs]]:
        """Names and runs by start. An annotation's holes shorter than `fill` close, all or none: none if another one is in any of them.
        Bare runs of at least `unmatched` are annotations."""
        _, fill, unmatched = self.limits
        out, every = [], Taken()
        for name, runs in self.found:
            holes = [(e, s) for (_, e), (s, _) in zip(runs, runs[1:], strict=False) if s - e < fill]
            closed = bool(holes) and not any(self.taken.overlap(e, s) for e, s in holes)
            joined = [runs[0]]
            for s, e in runs[1:]:
                joined[-1:] = [(joined[-1][0], e)] if closed and s - joined[-1][1] < fill else [joined[-1], (s, e)]
            out.append((name, joined))
            for s, e in joined:
                every.add(s, e)
        bare = [("unmatched", [(s, e)]) for s, e in every.free(0, length) if e - s >= unmatched]
        return sorted(out + bare, key=lambda x: x[1])


def accept(hits: list[tuple], length: int, max_overlap: int = 10, fill: int = 50, unmatched: int = 20) -> list[tuple[str, Runs]]:
    """Names and runs of what is accepted of one chain's hits (is_model, log10e, total length, is_sequence_hit, name, runs), in any order."""
    chain = Chain(max_overlap, fill, unmatched)
    for _, _, _, _, name, runs in sorted(hits, key=lambda h: (h[0], h[1], -h[2], not h[3], h[4], h[5])):
        chain.offer(name, runs)
    return chain.annotations(length)


def accept_annotations(hits: DataFrame, lengths: DataFrame, max_overlap: int = 10, fill: int = 50, unmatched: int = 20) -> DataFrame:
    """chain_id, number, suffix, name, start, end, region of the accepted annotations, one row a region.

    hits: chain_id, hit_id, name, is_model, is_sequence_hit, log10e, start, length (one row a region, the regions of a hit apart; equal rows
    count once); lengths: chain_id, chain_length. Models come last; then least E, longest, sequence hits first, name, regions and
    hit_id decide, each hit against those accepted before it.

    The hits of a chain pass through one task in this order, dealt by chain and sorted within partitions (which spills): of a chain
    of any number of hits only the accepted runs are held, those of 62 domains at most. One whole-chain annotation has the suffix
    `_`; 62 domains or more are an error. A chain without hits is unmatched.
    """
    runs = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))))
    facts = [F.min(c).alias(c) for c in ("name", "is_model", "is_sequence_hit", "log10e")]
    whole = hits.groupBy("chain_id", "hit_id").agg(*facts, runs.alias("runs"))
    total = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    order = ["chain_id", "is_model", "log10e", F.desc("total"), F.desc("is_sequence_hit"), "name", "runs", "hit_id"]
    rows = lengths.join(whole, "chain_id", "left").withColumn("total", total)
    dealt = rows.repartition("chain_id").sortWithinPartitions(*order).select("chain_id", "chain_length", "name", "runs")

    def lines(chain_id: int, length: int, chain: Chain) -> list[tuple]:
        found = chain.annotations(length)
        if len(found) >= len(SUFFIXES):
            raise ValueError(f"chain {chain_id}: more domains than there are suffixes")
        whole = len(found) == 1 and found[0][1] == [(0, length)]
        return [(chain_id, i + 1, "_" if whole else SUFFIXES[i], name, s, e, j) for i, (name, runs) in enumerate(found) for j, (s, e) in enumerate(runs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["chain_id", "number", "suffix", "name", "start", "end", "region"]
        types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32())
        now: tuple[int, int] | None = None
        chain = Chain(max_overlap, fill, unmatched)

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            out: list[tuple] = []
            for chain_id, length, name, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (chain_id, length):
                    if now:
                        out += lines(*now, chain)
                    now, chain = (chain_id, length), Chain(max_overlap, fill, unmatched)
                if runs:
                    chain.offer(name, [(r["start"], r["end"]) for r in runs])
            yield batch_of(out)
        if now:
            yield batch_of(lines(*now, chain))

    return dealt.mapInArrow(run, "chain_id long, number int, suffix string, name string, start long, end long, region int")


def fill_gaps(regions: DataFrame, min_gap: int = 50) -> DataFrame:
    """chain_id, id, start, end of annotations (one row a region, none overlapping) with their holes shorter than min_gap closed, all or none:
    none if another annotation is in any of them. As nothing overlaps, that is where the chain's next region isn't the own next one."""
    own, chain = Window.partitionBy("chain_id", "id").orderBy("start"), Window.partitionBy("chain_id").orderBy("start")
    rows = regions.select("chain_id", "id", "start", "end").withColumn("next", F.lead("start").over(own)).withColumn("after", F.lead("start").over(chain)).withColumn("before", F.lag("end").over(own))
    taken = (F.col("next") - F.col("end") < min_gap) & (F.col("after") < F.col("next"))
    rows = rows.withColumn("taken", F.max(F.coalesce(taken, F.lit(False))).over(Window.partitionBy("chain_id", "id")))
    opens = F.col("before").isNull() | (F.col("start") - F.col("before") >= min_gap) | F.col("taken")
    rows = rows.withColumn("run", F.sum(opens.cast("int")).over(own))
    return rows.groupBy("chain_id", "id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def unmatched_regions(regions: DataFrame, lengths: DataFrame, min_length: int = 20) -> DataFrame:
    """chain_id, start, end of bare runs of at least min_length. regions: chain_id, start, end; lengths: chain_id, chain_length."""
    ends = lengths.select("chain_id", F.col("chain_length").alias("start"), F.col("chain_length").alias("end"))
    every = regions.join(lengths.select("chain_id"), "chain_id", "left_semi").select("chain_id", "start", "end").union(ends)
    before = Window.partitionBy("chain_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    rows = every.withColumn("free", F.coalesce(F.max("end").over(before), F.lit(0)))
    return rows.filter(F.col("start") - F.col("free") >= min_length).select("chain_id", F.col("free").alias("start"), F.col("start").alias("end"))


def number_domains(domains: DataFrame, prefix: str = "u") -> DataFrame:
    """chain_id, id, sid of domains (chain_id, sid of the chain, id, start, is_whole) numbered by start: 1 to 9, a to z, A to Z; `_` for one that is the
    whole chain. 62 or more on a chain are an error."""
    own = Window.partitionBy("chain_id")
    rows = domains.withColumn("n", F.count("*").over(own)).withColumn("number", F.row_number().over(own.orderBy("start", "id")))
    suffix = F.when((F.col("n") == 1) & F.col("is_whole"), "_").otherwise(F.substr(F.lit(SUFFIXES), F.col("number"), F.lit(1)))
    checked = F.when(F.col("n") >= len(SUFFIXES), F.raise_error(F.concat(F.lit("more domains than there are suffixes: chain "), "chain_id"))).otherwise(suffix)
    return rows.select("chain_id", "id", F.concat(F.lit(prefix), "sid", checked).alias("sid"))


def extend_to_ends(regions: DataFrame, observed: DataFrame, limit: int) -> DataFrame:
    """regions (chain_id, id, start, end) grown to the ends of the observed runs they end in, by at most a limit and not into others.

    observed: chain_id, idx, run_start, run_end.
    """
    own = Window.partitionBy("chain_id").orderBy("start")
    rows = regions.withColumn("before", F.coalesce(F.lag("end").over(own), F.lit(0))).withColumn("after", F.lead("start").over(own))
    left = observed.select("chain_id", F.col("idx").alias("start"), "run_start")
    right = observed.select("chain_id", (F.col("idx") + 1).cast("long").alias("end"), "run_end")
    rows = rows.join(left, ["chain_id", "start"], "left").join(right, ["chain_id", "end"], "left")
    down = F.greatest(F.coalesce("run_start", "start"), "before")
    up = F.least(F.coalesce(F.col("run_end") + 1, F.col("end")), F.coalesce("after", F.lit(1 << 40)))
    new_start = F.when(F.col("start") - down <= limit, down).otherwise(F.col("start"))
    new_end = F.when(up - F.col("end") <= limit, up).otherwise(F.col("end"))
    return rows.select("chain_id", "id", new_start.cast("long").alias("start"), new_end.cast("long").alias("end"))


def split_linkers(regions: DataFrame, max_linker: int) -> DataFrame:
    """regions (chain_id, id, start, end, missed_after, missed_before) with holes to the next one, up to a limit, shared out.

    missed_after: residues of the own target beyond its end; missed_before: of the next's target before its start. The left one
    gets the hole's share missed_after / (both), rounded down; half if neither misses any.
    """
    own = Window.partitionBy("chain_id").orderBy("start")

    def share(hole: Column, left: Column, right: Column) -> Column:
        both = left + right
        return F.when(both > 0, F.floor(hole * left / both)).otherwise(F.floor(hole / 2))

    hole = F.lead("start").over(own) - F.col("end")
    gained = F.when((hole > 0) & (hole <= max_linker), share(hole, F.col("missed_after"), F.lead("missed_before").over(own))).otherwise(0)
    rows = regions.withColumn("hole", hole).withColumn("gained", gained)
    given = F.when((F.lag("hole").over(own) > 0) & (F.lag("hole").over(own) <= max_linker), F.lag("hole").over(own) - F.lag("gained").over(own)).otherwise(0)
    return rows.withColumn("given", given).select("chain_id", "id", (F.col("start") - F.col("given")).cast("long").alias("start"), (F.col("end") + F.col("gained")).cast("long").alias("end"))


def predict_domains(hits: DataFrame, chains: DataFrame) -> DataFrame:
    """chain_id, sid, regions, seq, header of the accepted annotations. chains: chain_id, code, chain, seq."""
    lengths = chains.select("chain_id", F.length("seq").alias("chain_length"))
    found = accept_annotations(hits, lengths)
    parts = F.array_sort(F.collect_list(F.struct("region", "start", "end")))
    rows = found.groupBy("chain_id", "number", "suffix", "name").agg(parts.alias("parts")).join(chains, "chain_id")
    regions = F.array_join(F.transform("parts", lambda x: F.concat(F.col("chain"), F.lit(":"), x["start"] + 1, F.lit("-"), x["end"])), ",")
    text = F.array_join(F.transform("parts", lambda x: F.substr(F.col("seq"), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))), "X")
    sid = F.concat(F.lit("e"), F.lower("code"), F.lower("chain"), "suffix")
    return rows.select("chain_id", sid.alias("sid"), regions.alias("regions"), text.alias("seq"), F.concat(sid, F.lit(" ("), regions, F.lit(") "), "name").alias("header"))


#: Bits of the filter and the reasons that belong to them, in the order of testing.
FILTERS = [
    (0, "no-desc"), (1, "not-entire-chain"), (8, "not-one-domain"), (0, "genetic-domain"), (2, "short-hit"), (4, "hit-wrong-regions"), (32, "low-res"), (32, "nmr-model"), (32, "unk-res"), (32, "ribo"), (32, "synthetic"),
    (32, "fragment"), (32, "fragment2"), (64, "entire-chain-not-classified"), (128, "not-all-same-chain"), (256, "unmatched-residues"),
]


def filter_predictions(p: DataFrame, bits: int) -> DataFrame:
    """p with the first reason against each prediction under the bits, and whether it passed.

    p: id, chain_id, description, unmatched_parts, domains_in_chain, is_genetic, hit_start, hit_end, target_length, regions,
    target_regions, gate (of the resolution gate), is_ribosomal, is_synthetic, length, is_reject, observed, target_domains,
    target_chain_id, gap_residues, unmatched_residues.
    """
    own = Window.partitionBy("chain_id")
    other_chain = F.min("target_chain_id").over(own) != F.max("target_chain_id").over(own)
    change = F.abs(F.col("target_length") - F.col("length"))
    tests = {
        "no-desc": F.col("description").isNull(),
        "not-entire-chain": F.col("unmatched_parts") > 0,
        "not-one-domain": F.col("domains_in_chain") != 1,
        "genetic-domain": F.col("is_genetic"),
        "short-hit": (F.col("hit_start") >= 10) | (F.col("target_length") - F.col("hit_end") > 10),
        "hit-wrong-regions": F.col("regions") != F.col("target_regions"),
        **{k: F.col("gate") == k for k in ("low-res", "nmr-model", "unk-res")},
        "ribo": F.col("is_ribosomal"),
        "synthetic": F.col("is_synthetic"),
        "fragment": (change > F.least(F.lit(30), F.col("target_length") / 3)) | (F.col("is_reject") == 1),
        "fragment2": F.col("observed") < 0.8 * F.col("length"),
        "entire-chain-not-classified": F.col("target_domains") != 1,
        "not-all-same-chain": F.col("other_chain"),
        "unmatched-residues": (F.col("gap_residues") > 0) | (F.col("unmatched_residues") > 0),
    }
    reason = F.lit(None).cast("string")
    for bit, name in reversed(FILTERS):
        if bit == 0 or bits & bit:
            reason = F.when(F.coalesce(tests[name], F.lit(False)), name).otherwise(reason)
    return p.withColumn("other_chain", other_chain).select("id", reason.alias("reason")).withColumn("passed", F.col("reason").isNull())


def evaluate_predictions(predictions: DataFrame, truth: DataFrame, shared: DataFrame) -> DataFrame:
    """id, match_id, end_error, shared_level, correct of predictions (id, chain_id, start, length, target_node) against domains
    of the next release (chain_id, id, start, length, node). shared: a, b, shared_level of two nodes.

    Correct: end error of at most 10 and a fifth of the length, and one superfamily at least.
    """
    best = best_region_match(predictions, truth.select("chain_id", "id", "start", "length")).withColumnRenamed("a_id", "id").withColumnRenamed("b_id", "match_id")
    rows = predictions.join(best, "id", "left").join(truth.select(F.col("id").alias("match_id"), "node"), "match_id", "left")
    rows = rows.join(shared.select(F.col("a").alias("target_node"), F.col("b").alias("node"), "shared_level"), ["target_node", "node"], "left")
    good = (F.col("end_error") <= 10) & (F.col("end_error") <= F.floor(F.col("length") / 5)) & (F.coalesce("shared_level", F.lit(0)) >= 4)
    return rows.select("id", "match_id", "end_error", F.coalesce("shared_level", F.lit(0)).alias("shared_level"), F.coalesce(good, F.lit(False)).alias("correct"))


def precision_recall(evaluated: DataFrame, by: str) -> DataFrame:
    """by, n, correct, precision, recall up to each value: sums over distinct values, of which there are far fewer than rows.

    Running sums go within ranges of values; the ranges' totals are added before them.
    """
    bins = evaluated.groupBy(by).agg(F.count("*").alias("k"), F.sum(F.col("is_correct").cast("int")).alias("c"))
    dealt = numbered(bins, [by], "order").withColumn("block", F.floor(F.col("order") / 10_000))
    totals = dealt.groupBy("block").agg(F.sum("k").alias("bk"), F.sum("c").alias("bc"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for 10,000 values
    totals = totals.select("block", F.coalesce(F.sum("bk").over(before), F.lit(0)).alias("k0"), F.coalesce(F.sum("bc").over(before), F.lit(0)).alias("c0"))
    own = Window.partitionBy("block").orderBy("order")
    rows = dealt.withColumn("k1", F.sum("k").over(own)).withColumn("c1", F.sum("c").over(own)).join(totals, "block")
    every = evaluated.agg(F.sum(F.col("is_correct").cast("int")).alias("all")).select("all").scalar()
    n, c = F.col("k0") + F.col("k1"), F.col("c0") + F.col("c1")
    return rows.select(by, n.alias("n"), c.alias("correct"), F.round(c / n, 9).alias("precision"), F.round(c / every, 9).alias("recall"))


def promotion_gate(chains: DataFrame, frozen: DataFrame, obsolete: DataFrame, curated: DataFrame) -> DataFrame:
    """id, reason against promoting a chain, or null. chains: id, entry_id, chain, line, frozen_line; frozen, obsolete: entry_id; curated: chain_id."""
    clash = F.count("*").over(Window.partitionBy("entry_id", F.lower("chain"))) > 1
    flag = lambda d, k, n: d.select(F.col(k), F.lit(True).alias(n)).distinct()
    rows = chains.withColumn("clash", clash).join(flag(frozen, "entry_id", "in_set"), "entry_id", "left").join(flag(obsolete, "entry_id", "gone"), "entry_id", "left").join(flag(curated.withColumnRenamed("chain_id", "id"), "id", "curated"), "id", "left")
    reason = F.when(F.col("in_set").isNull(), "not-in-frozen-set").when(F.col("gone"), "entry-obsolete").when(F.col("line") != F.col("frozen_line"), "map-changed").when(F.col("curated"), "curated-domains").when(F.col("clash"), "case-clash")
    return rows.select("id", reason.alias("reason"))


def assign_parents(p: DataFrame, genes: DataFrame, species: DataFrame, same_family: float = 55, same_protein: float = 99) -> DataFrame:
    """id with family_id, protein_id, species_id; null where the "automated matches" sibling is to be made.

    p: id, pct, gene, species, taxid, superfamily_id, family_id, protein_id (of the target); genes: gene, superfamily_id,
    family_id, protein_id; species: protein_id, species_id, scientific_name, taxid. The target's family is kept at a high
    identity, or if the gene is found in it and in no other family of the superfamily; its protein at a higher one, or if the
    gene is found in it; then the species of that name or taxid under the protein, the smaller id of several.
    """
    by_family = genes.groupBy("superfamily_id", "gene").agg(F.min("family_id").alias("f0"), F.max("family_id").alias("f1"))
    in_protein = genes.select("gene", "protein_id").distinct().withColumn("has_gene", F.lit(True))
    rows = p.join(by_family, ["superfamily_id", "gene"], "left").join(in_protein, ["gene", "protein_id"], "left")
    family = F.coalesce(F.col("pct") >= same_family, F.lit(False)) | F.coalesce((F.col("f0") == F.col("family_id")) & (F.col("f1") == F.col("family_id")), F.lit(False))
    protein = family & (F.coalesce(F.col("pct") >= same_protein, F.lit(False)) | F.coalesce("has_gene", F.lit(False)))
    rows = rows.select("id", "taxid", normalise_species(F.col("species")).alias("name"), F.when(family, F.col("family_id")).alias("family_id"), F.when(protein, F.col("protein_id")).alias("protein_id"))
    for name, column in (("name", "scientific_name"), ("taxid", "taxid")):
        least = species.filter(F.col(column).isNotNull()).groupBy("protein_id", F.col(column).alias(name)).agg(F.min("species_id").alias(f"by_{name}"))
        rows = rows.join(least, ["protein_id", name], "left")
    return rows.select("id", "family_id", "protein_id", F.least("by_name", "by_taxid").alias("species_id"), F.col("name").isNotNull().alias("has_species"))


def find_tags(chains: DataFrame, annotated: DataFrame, known: DataFrame, references: DataFrame, min_len: int = 5) -> DataFrame:
    """chain_id, type (N or C), start, end, source of artificial ends, by annotation, else by a chain of one sequence, else by a
    known tag (longest first, of a least length, without x) that the sequence begins or ends with.

    chains: chain_id, seq_id, seq; annotated: chain_id, type, start, end; known: tag; references: chain_id, ref_start, ref_end. A
    tag goes on to the chain's end; where it runs into the reference alignment it shrinks, and is dropped if nothing is left.
    The dictionary of tags is joined by the tag's length and text, never by trying each tag on each chain.
    """
    size = F.length("seq")
    own = annotated.join(chains.select("chain_id", "seq_id"), "chain_id")
    first = annotated.select("chain_id", "type", "start", "end", F.lit(1).alias("priority"))
    twins = own.groupBy("seq_id", "type").agg(F.min_by(F.struct("start", "end"), F.struct("start", "end")).alias("t"))
    second = chains.select("chain_id", "seq_id").join(twins, "seq_id").select("chain_id", "type", "t.start", "t.end", F.lit(2).alias("priority"))
    tags = known.filter((F.length("tag") >= min_len) & ~F.col("tag").contains("x")).select("tag", F.length("tag").alias("n")).distinct()
    sizes = F.broadcast(tags.agg(F.collect_set("n").alias("sizes")))  # one row of distinct lengths
    tried = chains.join(sizes).select("chain_id", "seq", F.explode("sizes").alias("n")).filter(F.length("seq") > F.col("n"))
    ends = tried.select("chain_id", "n", F.length("seq").alias("size"), F.explode(F.array(F.struct(F.lit("N").alias("type"), F.expr("left(seq, n)").alias("tag")), F.struct(F.lit("C").alias("type"), F.expr("right(seq, n)").alias("tag")))).alias("e"))
    met = ends.select("chain_id", "n", "size", "e.*").join(tags, ["tag", "n"]).groupBy("chain_id", "type", "size").agg(F.max("n").alias("n"))
    third = met.select("chain_id", "type", F.when(F.col("type") == "N", 0).otherwise(F.col("size") - F.col("n")).alias("start"), F.when(F.col("type") == "N", F.col("n") - 1).otherwise(F.col("size") - 1).alias("end"), F.lit(3).alias("priority"))
    every = first.union(second).union(third).groupBy("chain_id", "type").agg(F.min_by(F.struct("start", "end", "priority"), F.struct("priority", "start", "end")).alias("t")).select("chain_id", "type", "t.*")
    bounds = references.groupBy("chain_id").agg(F.min("ref_start").alias("r0"), F.max("ref_end").alias("r1"))
    placed = every.join(chains.select("chain_id", size.alias("size")), "chain_id").join(bounds, "chain_id", "left")
    n = F.col("type") == "N"
    start = F.when(n, 0).otherwise(F.greatest("start", F.coalesce(F.col("r1") + 1, F.lit(0))))
    end = F.when(n, F.least("end", F.coalesce(F.col("r0") - 1, F.col("size")))).otherwise(F.col("size") - 1)
    source = F.when(F.col("priority") == 1, "annotated").when(F.col("priority") == 2, "same-sequence").otherwise("known-tag")
    return placed.select("chain_id", "type", start.cast("int").alias("start"), end.cast("int").alias("end"), source.alias("source")).filter("start <= end")


def longer_call(tags: DataFrame) -> DataFrame:
    """chain_id, type, t0, t1: the longer of two calls, the second of equal ones. tags: chain_id, type, first_start, first_end, second_start, second_end."""
    second = F.col("second_end") - F.col("second_start") >= F.col("first_end") - F.col("first_start")
    pick = lambda k: F.coalesce(F.when(F.coalesce(second, F.col("first_start").isNull()), F.col(f"second_{k}")), F.col(f"first_{k}"))
    return tags.select("chain_id", "type", pick("start").alias("t0"), pick("end").alias("t1"))


def split_tag_domains(domains: DataFrame, tags: DataFrame, linker: int = 10) -> DataFrame:
    """chain_id, id, type, start, end, action of domains (chain_id, id, start, end) against two tag calls of a chain's end (see longer_call).

    A domain within the tag, or several that overlap it, are `manual`; one that overlaps is cut (`cut`); where none does, the
    nearest one within a linker grows up to it (`grown`); others `kept`.
    """
    called = longer_call(tags)
    rows = domains.join(called, "chain_id", "left")
    over = (F.col("start") <= F.col("t1")) & (F.col("end") >= F.col("t0"))
    own = Window.partitionBy("chain_id", "type")
    rows = rows.withColumn("over", F.coalesce(over, F.lit(False))).withColumn("n_over", F.sum(F.col("over").cast("int")).over(own))
    rows = rows.withColumn("swallowed", F.coalesce((F.col("start") >= F.col("t0")) & (F.col("end") <= F.col("t1")), F.lit(False)))
    away = F.when(F.col("type") == "N", F.col("start") - F.col("t1") - 1).otherwise(F.col("t0") - F.col("end") - 1)
    rows = rows.withColumn("away", away).withColumn("nearest", F.min(F.when(F.col("away") >= 0, F.col("away"))).over(own))
    n = F.col("type") == "N"
    action = F.when(F.col("t0").isNull(), "kept").when(F.col("over") & ((F.col("n_over") > 1) | F.col("swallowed")), "manual").when(F.col("over"), "cut").when((F.col("n_over") == 0) & (F.col("away") == F.col("nearest")) & (F.col("away") > 0) & (F.col("away") <= linker), "grown").otherwise("kept")
    rows = rows.withColumn("action", action)
    moves = F.col("action").isin("cut", "grown")
    start = F.when(moves & n, F.col("t1") + 1).otherwise(F.col("start"))
    end = F.when(moves & ~n, F.col("t0") - 1).otherwise(F.col("end"))
    return rows.select("chain_id", "id", "type", start.alias("start"), end.alias("end"), "action")


def tag_nodes(split: DataFrame, tags: DataFrame, parents: dict[str, int], next_id: int) -> DataFrame:
    """id, chain_id, type, start, end, sccs, level_id, parent_node_id, made_from of the new domains that tags become where a domain was cut or grown up to
    one; made_from is that domain. split: from split_tag_domains; tags: its calls; parents: the node of each type (N, C) under the tag class."""
    moved = split.filter("action in ('cut', 'grown')").select("chain_id", "type", F.col("id").alias("made_from"))
    kinds = F.create_map(*(F.lit(x) for pair in parents.items() for x in pair))
    rows = longer_call(tags).join(moved, ["chain_id", "type"]).select("chain_id", "type", F.col("t0").alias("start"), F.col("t1").alias("end"), "made_from")
    made = rows.withColumn("parent_node_id", kinds[F.col("type")].cast("long")).withColumn("sccs", F.lit("l.1.1.1")).withColumn("level_id", F.lit(8))
    return numbered(made, ["chain_id", "type", "made_from"], "id", next_id).select("id", "chain_id", "type", "start", "end", "sccs", "level_id", "parent_node_id", "made_from")


def tag_history(split: DataFrame, made: DataFrame, before: DataFrame) -> DataFrame:
    """old_node_id, new_node_id, change_type of domains that the release before has (before: id, old_node_id): 11 for each that was cut or grown; where it
    was cut, also 5 for itself and for the tag's domain (made: id, chain_id, type, made_from)."""
    moved = split.filter("action in ('cut', 'grown')").join(before, "id").select("old_node_id", "id", "chain_id", "type", "action")
    cut = moved.filter("action = 'cut'")
    told = moved.select("old_node_id", F.col("id").alias("new_node_id"), F.lit(11).alias("change_type"))
    new = cut.withColumnRenamed("id", "made_from").join(made.select("id", "chain_id", "type", "made_from"), ["chain_id", "type", "made_from"])
    return told.union(cut.select("old_node_id", "id", F.lit(5))).union(new.select("old_node_id", "id", F.lit(5)))


def exact_sequence_match(chains: DataFrame, classified: DataFrame) -> DataFrame:
    """chain_id, donor_chain_id, node_id, start, length, log10e, pct of unclassified chains whose sequence a classified one has.

    chains: chain_id, seq_id; classified: chain_id, seq_id, node_id, start, length. The donor is the smallest chain.
    """
    open_ = chains.join(classified.select("chain_id").distinct(), "chain_id", "left_anti")
    donor = classified.groupBy("seq_id").agg(F.min("chain_id").alias("donor_chain_id"))
    regions = classified.select(F.col("chain_id").alias("donor_chain_id"), "node_id", "start", "length")
    return open_.join(donor, "seq_id").join(regions, "donor_chain_id").select("chain_id", "donor_chain_id", "node_id", "start", "length", F.lit(-9999.0).alias("log10e"), F.lit(100.0).alias("pct"))


def choose_source(predictions: DataFrame, bits: int) -> DataFrame:
    """Predictions of each chain's best source with the method they get: exact matches 4, hits on several domains 5, both under
    filter 32, else the original ones 3, or 6 where bits are -1 (no filter, extended to the ends).

    predictions: id, chain_id, source (exact, multi, original).
    """
    method = F.when(F.col("source") == "exact", 4).when(F.col("source") == "multi", 5).otherwise(6 if bits == -1 else 3)
    used = F.when(F.col("source") == "original", max(bits, 0)).otherwise(32)
    priority = F.when(F.col("source") == "exact", 0).when(F.col("source") == "multi", 1).otherwise(2)
    rows = predictions.select("*", priority.alias("priority"), method.alias("method"), used.alias("bits"))
    best = rows.groupBy("chain_id").agg(F.min("priority").alias("priority"))
    return rows.join(best, ["chain_id", "priority"], "left_semi").select("id", "chain_id", "method", "bits")


