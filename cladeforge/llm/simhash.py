"""Near-duplicates by SimHash: close pairs are found by pigeonhole blocks and linked into components.

A 64-bit fingerprint is cut into four blocks. Two fingerprints that differ in at most two bits agree in at least two of
the blocks, so all rows that agree in one of the six pairs of blocks are compared. Only distinct fingerprints take part:
a large group of exact copies is one row. A bucket with many distinct fingerprints isn't compared pairwise; there, each
fingerprint is sent to itself with each one of its other bits flipped, and fingerprints that meet differ in two bits at
most. Both ways lose no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeforge.llm.common import as_bytes, checkpointed, texts
from cladeforge.operators.components import components

MAX_DISTANCE = 2
SHINGLE = 3
SEED = 42
BLOCKS = 4
#: A bucket with more distinct fingerprints is linked by flipped bits instead of by pairs.
PAIRWISE = 64


def fingerprint(text: bytes) -> int:
    """Signed 64-bit SimHash of the whole text; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b"%b %b %b" % x for x in zip(words, words[1:], words[2:], strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 1 << 16):
        hashes = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in shingles[at : at + (1 << 16)]), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(x) for x in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(found, pa.int64())], ["rid", "doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """rid, doc_id, fp of each row. Null text counts as empty, and has fingerprint 0."""
    return texts(docs).mapInArrow(_fingerprints, "rid long, doc_id long, fp long")


def _blocks() -> list[tuple[int, Column, list[int]]]:
    """Number, key and free bits of each pair of blocks."""
    width = 64 // BLOCKS
    part = [F.shiftrightunsigned(F.col("fp"), width * i).bitwiseAND(F.lit((1 << width) - 1)) for i in range(BLOCKS)]
    out = []
    for n, held in enumerate(combinations(range(BLOCKS), BLOCKS - MAX_DISTANCE)):
        key = part[held[0]]
        for i in held[1:]:
            key = F.shiftleft(key, width).bitwiseOR(part[i])
        out.append((n, key, [b for b in range(64) if b // width not in held]))
    return out


def _signed(bit: int) -> int:
    return (1 << bit) - (1 << 64 if bit == 63 else 0)


def links(distinct: DataFrame) -> DataFrame:
    """a < b: edges whose components are those of all pairs of fingerprints (column fp, distinct) within two bits."""
    blocks = _blocks()
    rows = distinct.select("fp", F.explode(F.array(*(F.struct(F.lit(n).alias("n"), key.alias("key")) for n, key, _ in blocks))).alias("at")).select("fp", "at.*")
    sizes = rows.groupBy("n", "key").agg(F.count("*").alias("members")).filter("members > 1")
    held = checkpointed(rows.join(sizes, ["n", "key"]))
    few = held.filter(F.col("members") <= PAIRWISE).select("n", "key", "fp")
    pairs = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), ["n", "key"]).filter("a < b").filter(F.bit_count(F.expr("a ^ b")) <= MAX_DISTANCE).select("a", "b")
    flips = F.element_at(F.array(*(F.array(F.lit(0).cast("long"), *(F.lit(_signed(b)) for b in free)) for _, _, free in blocks)), F.col("n") + 1)
    spread = held.filter(F.col("members") > PAIRWISE).select("n", "key", "fp", F.explode(flips).alias("flip")).select("n", "key", "fp", F.expr("fp ^ flip").alias("met"))
    least = spread.groupBy("n", "key", "met").agg(F.min("fp").alias("a"), F.count("*").alias("c")).filter("c > 1").drop("c")
    stars = spread.join(least, ["n", "key", "met"]).filter("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def _linked(docs: DataFrame) -> DataFrame:
    rows = checkpointed(fingerprints(docs))
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("best"))
    roots = components(links(distinct.select("fp")))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    of_root = named.groupBy("root").agg(F.min("least").alias("component_id"), F.min("best").alias("best"))
    return rows.join(named.select("fp", "root").join(of_root, "root").drop("root"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id of those linked directly or through others).

    One row per row of docs. Null text has no words: fingerprint zero, linked like any other. Null doc_ids are never a
    component_id, unless no member has one. Repeated rows come back repeated. Other columns of docs are left aside.
    """
    return _linked(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: that of the least doc_id, and one of several equal rows."""
    kept = _linked(docs).filter("rid = best.rid").select("rid").distinct()
    rid = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    named = docs.select(F.struct("*").alias("row"), rid.alias("rid"))
    return named.join(kept, "rid", "left_semi").dropDuplicates(["rid"]).select("row.*")
