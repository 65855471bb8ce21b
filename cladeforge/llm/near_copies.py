"""Near copies by the Jaccard similarity of five-word shingles, exact: no pair of at least 4/5 is missed, none below is linked.

Of SimHash, two texts at 4/5 differ in some ten of 64 bits, with a wide spread; no bound has both all of them and blocks that
still select. So pairs are found by prefixes: with all shingles in one fixed order, two sets of that similarity share one
among the first n - ceil(4n/5) + 1 of each. This holds in any order. It goes by hash, with frequent shingles (of a sample of the
texts, which only decides the order) last, so that what many texts share seldom brings them together.

Where many sets share a shingle of their prefixes, each is told by its difference to what most sets of its group have, and is first compared with the
one that differs least. Near copies of one text lose little of it and have little beyond it, and two of them can only be alike if they have few
differences both, or share one beyond it. So large groups aren't compared pair by pair. A pair's
sets are only intersected if the shingles that their prefixes share, with all that come after these, could be enough. Only distinct
sets take part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.llm.common import as_bytes, checkpointed, texts
from cladeforge.operators.components import components

SHINGLE = 5
#: Texts of which one in SAMPLE is looked at for frequent shingles, those in FREQUENT of them at least; LISTED at most are put last.
SAMPLE, FREQUENT, LISTED = 8, 4, 1 << 20
#: Sets that share a shingle of their prefixes and are compared pair by pair; more are a large group.
PAIRWISE = 64
#: Size of the map of texts to compare.
BITS = 26
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Names(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted 64-bit names of each text's distinct shingles: those of all its words if it has fewer, none without words."""
    names = _Names()
    for text in as_bytes(column):
        words = text.lower().split()
        w = np.fromiter(map(names.__getitem__, words), np.uint64, len(words))
        size = min(SHINGLE, len(w))
        out = np.full(len(w) - size + 1 if size else 0, size, np.uint64)
        for i in range(size):
            out += (w[i : len(w) - size + 1 + i] ^ (w[i : len(w) - size + 1 + i] >> np.uint64(31))) * _MIX[i]
        out = (out ^ (out >> np.uint64(29))) * _MIX[1]
        yield np.unique(out ^ (out >> np.uint64(32)))


def _lists(found: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)))


def _frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Names, sorted, and counts of frequent shingles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, c = np.unique(np.concatenate([*shingle_sets(batch.column("text")), np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c.astype(np.int64))], ["token", "c"])

    counts = rows.filter(F.pmod("rid", F.lit(SAMPLE)) == 0).select("text").mapInArrow(count, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))
    got = counts.filter(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "token").limit(LISTED).toPandas()
    k, c = got["token"].to_numpy(np.int64).view(np.uint64), got["c"].to_numpy(np.int64)
    order = np.argsort(k)
    return k[order], c[order]


def _named(rows: DataFrame) -> DataFrame:
    """rid, doc_id, name (of the set), size, prefix of each row."""
    frequent = rows.sparkSession.sparkContext.broadcast(_frequent(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = frequent.value
        for batch in batches:
            names, sizes, prefixes = [], [], []
            for s in shingle_sets(batch.column("text")):
                names.append(xxhash.xxh3_128_digest(s.tobytes()))
                sizes.append(len(s))
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    ordered = s[np.argsort(np.where(keys[at] == s, counts[at], 0), kind="stable")]
                else:
                    ordered = s
                prefixes.append(ordered[: len(s) + (-4 * len(s) // 5) + 1] if len(s) else s)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(sizes, pa.int32()), _lists(prefixes)], ["rid", "doc_id", "name", "size", "prefix"])

    return rows.mapInArrow(run, "rid long, doc_id long, name binary, size int, prefix array<long>")


def _likely(rows: DataFrame, met: DataFrame) -> DataFrame:
    """rows (rid, text) with all that are in met (rid) and few others, by a map of 2^BITS bits, so that the join after it deals out few texts."""

    def chunk(part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << 17, np.uint8)
        bits[part["bit"].to_numpy()] = 1
        return pd.DataFrame({"chunk": part["chunk"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})

    at = F.pmod("rid", F.lit(1 << BITS))
    dealt = met.select(F.shiftright(at, 17).cast("int").alias("chunk"), at.bitwiseAND(F.lit((1 << 17) - 1)).cast("int").alias("bit")).distinct()
    whole = np.zeros(1 << (BITS - 3), np.uint8)
    for x in dealt.groupBy("chunk").applyInPandas(chunk, "chunk int, bits binary").toLocalIterator():
        whole[x["chunk"] << 14 : (x["chunk"] + 1) << 14] = np.frombuffer(x["bits"], np.uint8)
    held = rows.sparkSession.sparkContext.broadcast(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            at = batch.column("rid").to_numpy() & ((1 << BITS) - 1)
            yield batch.filter(pa.array((bits[at >> 3] >> (7 - (at & 7))) & 1 == 1))

    return rows.select("rid", "text").mapInArrow(run, "rid long, text string")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("rid"), _lists(list(shingle_sets(batch.column("text"))))], ["node", "set"])


def _links(rows: DataFrame, named: DataFrame, distinct: DataFrame) -> DataFrame:
    """node, root of sets that are linked; nodes are the least rids of equal sets."""
    nodes = named.join(distinct.select(F.col("node").alias("rid")), "rid", "left_semi").dropDuplicates(["rid"])
    first = nodes.select(F.col("rid").alias("node"), "size", F.size("prefix").alias("held"), F.explode("prefix").alias("token"))
    # a row stays if the next smaller or larger set of its shingle has a size that allows similarity
    by_size = Window.partitionBy("token").orderBy("size", "node")
    near = F.expr("5L * size >= 4L * above or 5L * below >= 4L * size")
    first = first.withColumn("above", F.lead("size").over(by_size)).withColumn("below", F.lag("size").over(by_size)).filter(near)
    held = checkpointed(first.select("token", "node", "size", "held"))

    def sets_of(asked: DataFrame) -> DataFrame:
        met = checkpointed(asked.distinct())
        return checkpointed(_likely(rows, met).join(met, "rid", "left_semi").dropDuplicates(["rid"]).select("rid", "text").mapInArrow(_sets, "node long, set array<long>"))

    def alike(pairs: DataFrame) -> DataFrame:
        pairs = checkpointed(pairs)
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("rid")))
        both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        return checkpointed(both.filter(F.expr("9L * size(array_intersect(set_a, set_b)) >= 4L * (size(set_a) + size(set_b))")).select("a", "b"))

    def side(own: DataFrame, name: str) -> DataFrame:
        return own.select("token", F.struct("node", "size", "held", "root").alias(name))

    def counted(pairs: DataFrame) -> DataFrame:
        """Pairs a, b whose shared shingles of the prefixes, with all that comes after these, could be enough."""
        apart = pairs.filter("a.root <> b.root and 5L * a.size >= 4L * b.size and 5L * b.size >= 4L * a.size")
        apart = apart.selectExpr("least(a.node, b.node) as a", "greatest(a.node, b.node) as b", "greatest(a.size - a.held, b.size - b.held) as after", "a.size + b.size as sizes")
        return apart.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("after").alias("after"), F.first("sizes").alias("sizes")).filter("9L * (shared + after) >= 4L * sizes").select("a", "b")

    own = held.withColumn("root", F.col("node"))
    large = checkpointed(held.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") > PAIRWISE).select("token"))
    few = own.join(large, "token", "left_anti")
    pairs = counted(side(few, "a").join(side(few, "b"), "token").filter("a.node < b.node"))
    if large.isEmpty():
        return components(alike(pairs))
    near = _groups(own.join(large, "token"), sets_of)
    one = near.groupBy("group").agg(F.min_by("node", F.struct(F.expr("added + lost"), "node")).alias("a")).join(near.select("group", F.col("node").alias("b")), "group").filter("a <> b")
    edges = alike(one.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    near = checkpointed(near.drop("root").join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node")))
    return components(edges.union(alike(pairs.union(_possible(near)).distinct())))


def _groups(held: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node, size, root, group, extra, added, lost of sets with shingles that many share (held: token, node, size, root), told by their difference to what
    most sets of their group have: extra (added of them) beyond it, and how many of it are lost.

    A group: sets that share such a shingle, directly or over others, so that each set has one. What most sets of a group have is
    at most twice an average set.
    """
    least = held.groupBy("node").agg(F.min("token").alias("least"))
    links = held.join(least, "node").filter("token <> least").select(F.col("least").alias("a"), F.col("token").alias("b")).distinct()
    groups = least.join(components(links).toDF("least", "group"), "least", "left").select("node", F.coalesce("group", "least").alias("group"))
    part = checkpointed(held.select("node", "size", "root").distinct().join(groups, "node"))
    open_ = part.groupBy("group").agg(F.count("*").alias("n"), F.count_distinct("root").alias("roots")).filter("roots > 1")
    part = part.join(open_, "group")
    whole = checkpointed(part.join(sets_of(part.select(F.col("node").alias("rid"))), "node"))
    counts = whole.select("group", "n", F.explode("set").alias("token")).groupBy("group", "n", "token").agg(F.count("*").alias("c")).filter("2 * c > n")
    most = checkpointed(counts.groupBy("group").agg(F.collect_list("token").alias("most")))
    rows = whole.join(most, "group", "left").withColumn("most", F.coalesce("most", F.array().cast("array<long>"))).withColumn("extra", F.array_except("set", "most"))
    return checkpointed(rows.select("node", "size", "root", "group", "extra", F.size("extra").alias("added"), (F.size("most") - F.col("size") + F.size("extra")).alias("lost")))


def _possible(near: DataFrame) -> DataFrame:
    """a < b of all pairs of a group that can be alike and aren't linked yet.

    Two sets differ in all that either has beyond what most have, and loses of it, but for what both do. With nothing in common beyond
    it, they differ in added + added + |lost - lost| at least, and this must not be over a ninth of their sizes: such pairs have few added, and one isn't of
    the group's largest class. All others share one of their extra shingles.
    """
    facts = F.struct("node", "size", "root", "added", "lost")
    sizes = near.groupBy("group", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("group").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
    core = near.filter("4L * added <= size")
    rest = core.join(largest, "group").filter("root <> largest").select("group", facts.alias("x"))
    apart = "x.root <> y.root and 5L * x.size >= 4L * y.size and 5L * y.size >= 4L * x.size"
    plain = rest.join(core.select("group", facts.alias("y")), "group").filter(f"{apart} and 9L * (x.added + y.added + abs(x.lost - y.lost)) <= x.size + y.size")
    shared = near.select("group", F.explode("extra").alias("token"), facts.alias("x"))
    several = shared.groupBy("group", "token").agg(F.count_distinct("x.root").alias("roots")).filter("roots > 1").select("group", "token")
    shared = checkpointed(shared.join(several, ["group", "token"]))
    met = shared.join(shared.withColumnRenamed("x", "y"), ["group", "token"]).filter(f"x.node < y.node and {apart}")
    return plain.select("x", "y").union(met.select("x", "y")).selectExpr("least(x.node, y.node) as a", "greatest(x.node, y.node) as b").distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of those linked directly or through others: that of the least doc_id, and one of several equal rows.

    Null text has no words; texts without words are copies of each other. A null doc_id is kept only where no other is.
    """
    rows = texts(docs)
    named = checkpointed(_named(rows))
    distinct = checkpointed(named.groupBy("name").agg(F.min("rid").alias("node"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("best")))
    roots = _links(rows, named, distinct)
    of_root = distinct.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    kept = of_root.select(F.col("best.rid").alias("rid"))
    rid = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    named_docs = docs.select(F.struct("*").alias("row"), rid.alias("rid"))
    return named_docs.join(kept, "rid", "left_semi").dropDuplicates(["rid"]).select("row.*")
