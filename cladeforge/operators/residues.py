"""Residue maps: one line a chain, a header of 38 characters and 7 a residue: id (5), observed letter, sequence letter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER, RECORD = 38, 7
#: Kinds of sequences.
ATOM, SEQRES, SEQRES_CUT, TAGLESS = 1, 2, 3, 4


def _records(line: Column) -> Column:
    return F.regexp_extract_all(F.substr(line, F.lit(HEADER + 1)), F.lit(f"(?s).{{{RECORD}}}"), F.lit(0))


def residues(line: Column) -> Column:
    """The residues of a line: idx, res_id, atom (null if not observed), seq.

    The body is split once; taking substrings of a long line by place would walk it again for each residue.
    """
    return F.transform(
        _records(line),
        lambda x, i: F.struct(i.alias("idx"), F.trim(F.substring(x, 1, 5)).alias("res_id"), F.nullif(F.substring(x, 6, 1), F.lit(".")).alias("atom"), F.substring(x, 7, 1).alias("seq")),
    )


def explode_residues(raf: DataFrame) -> DataFrame:
    """pdb_chain_id, idx, res_id, atom, seq, observed: one row a residue."""
    rows = raf.select("pdb_chain_id", F.posexplode(_records(F.col("line"))).alias("idx", "x"))
    atom = F.nullif(F.substring("x", 6, 1), F.lit("."))
    return rows.select("pdb_chain_id", "idx", F.trim(F.substring("x", 1, 5)).alias("res_id"), atom.alias("atom"), F.substring("x", 7, 1).alias("seq"), atom.isNotNull().alias("observed"))


def _column(line: Column, at: int) -> Column:
    """The characters at one place of all records of a line, on end; dots stay."""
    return F.regexp_replace(F.substr(line, F.lit(HEADER + 1)), f"(?s).{{{at}}}(.).{{{RECORD - at - 1}}}|.", "$1")


def _written(letters: Column) -> Column:
    return F.translate(letters, '."', "")


def _span(parts: Column) -> Column:
    """From the first observed residue to the last."""
    seen = F.transform(F.filter(parts, lambda r: r["atom"].isNotNull()), lambda r: r["idx"])
    first, last = F.array_min(seen), F.array_max(seen)
    return F.when(first.isNull(), F.slice(parts, 1, 0)).otherwise(F.slice(parts, first + 1, last - first + 1))


def packed(raf: DataFrame) -> DataFrame:
    """pdb_chain_id, atom, letters, runs of maps: a letter a residue (atom has dots for what isn't observed), and where ids aren't the number before and
    one more: at, id, number (null unless the id is a plain whole number) and n, how many residues go on from there.

    What a join needs of a map, in two bytes a residue instead of a line's seven or an array of structs.
    """
    plain = r"^(0|-?[1-9]\d*)$"
    line = F.col("line")
    rows = raf.select("pdb_chain_id", _column(line, 5).alias("atom"), _column(line, 6).alias("letters"), F.transform(_records(line), lambda x: F.trim(F.substring(x, 1, 5))).alias("ids"))
    rows = rows.withColumn("numbers", F.transform("ids", lambda x: F.when(x.rlike(plain), x.try_cast("int"))))
    goes_on = lambda x, i: F.coalesce(x == F.try_element_at("numbers", i) + 1, F.lit(False))
    # the element i counted from 1 is the one before x
    starts = F.filter(F.transform("numbers", lambda x, i: F.when((i == 0) | ~goes_on(x, F.greatest(i, F.lit(1))), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("starts", starts)
    ends = F.concat(F.slice("starts", 2, F.size("ids")), F.array(F.size("ids")))
    runs = F.zip_with("starts", ends, lambda a, e: F.struct(a.alias("at"), F.get("ids", a).alias("id"), F.get("numbers", a).alias("number"), (e - a).alias("n")))
    return rows.select("pdb_chain_id", "atom", "letters", F.filter(runs, lambda r: r["at"].isNotNull()).alias("runs"))


def place(runs: Column, res_id: Column, last: bool = False) -> Column:
    """The index of the first residue with an id, or the last one; null without one."""
    number = F.when(res_id.rlike(r"^(0|-?[1-9]\d*)$"), res_id.try_cast("int"))
    at = F.transform(runs, lambda r: F.when((number >= r["number"]) & (number < r["number"] + r["n"]), r["at"] + number - r["number"]).when(r["number"].isNull() & (r["id"] == res_id), r["at"]))
    return F.array_max(at) if last else F.array_min(at)


def _cut(atom: Column, letters: Column, start: Column, length: Column, source: int) -> Column:
    """The sequence of a stretch of a packed map."""
    a, s = F.substr(atom, start + 1, length), F.substr(letters, start + 1, length)
    if source == SEQRES_CUT:
        s = F.substr(s, F.length(a) - F.length(F.ltrim(a, F.lit("."))) + 1, F.length(F.trim(a, F.lit("."))))
    return _written(a if source == ATOM else s)


def chain_sequence(raf: DataFrame, source: int) -> DataFrame:
    """pdb_chain_id, seq: observed letters, all letters, or all between the first observed and the last."""
    atom, seq = _column(F.col("line"), 5), _column(F.col("line"), 6)
    if source == SEQRES_CUT:
        rows = raf.select("pdb_chain_id", atom.alias("atom"), seq.alias("letters"))
        first = F.length("atom") - F.length(F.ltrim("atom", F.lit("."))) + 1
        own = F.substr("letters", first, F.length(F.trim("atom", F.lit("."))))
        return rows.select("pdb_chain_id", _written(own).alias("seq"))
    return raf.select("pdb_chain_id", _written(atom if source == ATOM else seq).alias("seq"))


def tagless_sequence(raf: DataFrame, tags: DataFrame) -> DataFrame:
    """pdb_chain_id, seq: all letters between the end of the N tag and the start of the C tag.

    tags: pdb_chain_id, type (N or C), tag_start, tag_end (indices).
    """
    bounds = tags.groupBy("pdb_chain_id").agg(F.max(F.when(F.col("type") == "N", F.col("tag_end"))).alias("n_end"), F.min(F.when(F.col("type") == "C", F.col("tag_start"))).alias("c_start"))
    rows = raf.select("pdb_chain_id", _column(F.col("line"), 6).alias("letters")).join(bounds, "pdb_chain_id", "left")
    start = F.coalesce(F.col("n_end") + 1, F.lit(0))
    length = F.greatest(F.coalesce("c_start", F.length("letters")) - start, F.lit(0))
    return rows.select("pdb_chain_id", _written(F.substr("letters", (start + 1).cast("int"), length.cast("int"))).alias("seq"))


def _placed(rows: DataFrame) -> DataFrame:
    """rows (start_id, end_id, and a packed map) with start, length: from the first residue with the start id to the last one with the end id; null if missing
    or reversed."""
    rows = rows.withColumn("__first", place(F.col("runs"), F.col("start_id"))).withColumn("__last", place(F.col("runs"), F.col("end_id"), last=True)).drop("runs")
    good = F.col("__last") >= F.col("__first")
    return rows.select("*", F.when(good, F.col("__first")).alias("start"), F.when(good, F.col("__last") - F.col("__first") + 1).alias("length")).drop("__first", "__last")


def region_sequence(regions: DataFrame, raf: DataFrame, source: int) -> DataFrame:
    """regions (pdb_chain_id, start_id, end_id) with their letters; null where an id is missing or the ids are reversed."""
    rows = _placed(regions.join(packed(raf), "pdb_chain_id"))
    return rows.select(*regions.columns, _cut(F.col("atom"), F.col("letters"), F.col("start"), F.col("length"), source).alias("seq"))


def domain_sequences(domains: DataFrame, raf: DataFrame, source: int) -> DataFrame:
    """domain_id, style, chain (null for the whole domain), seq, is_reject.

    domains: domain_id, position, pdb_chain_id, start_id, end_id (both null: the whole chain), one row a region. A domain of
    one chain is style 1. Of several chains it is style 3 as a whole, and style 2 for each of its chains. Regions are joined
    by X. Whole chains of all letters are cut to what is observed. A region that can't be read empties the sequence.
    """
    from cladeforge.functions.text import reject_flag

    rows = _placed(domains.join(packed(raf), "pdb_chain_id", "left"))
    cut = SEQRES_CUT if source == SEQRES else source
    whole = _cut(F.col("atom"), F.col("letters"), F.lit(0), F.length("atom"), cut)
    text = F.when(F.col("start_id").isNull(), whole).otherwise(_cut(F.col("atom"), F.col("letters"), F.col("start"), F.col("length"), source))
    rows = rows.select("domain_id", "position", "pdb_chain_id", text.alias("text"))

    def joined(keys: list[str]) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct("position", F.coalesce("text", F.lit("")).alias("text"))))
        own = F.when(F.bool_and(F.col("text").isNotNull()), F.array_join(F.transform(parts, lambda x: x["text"]), "X")).otherwise("")
        return rows.groupBy(*keys).agg(own.alias("seq"), F.count_distinct("pdb_chain_id").alias("chains"))

    every = joined(["domain_id"])
    several = every.filter("chains > 1").select("domain_id")
    one = every.select("domain_id", F.when(F.col("chains") > 1, 3).otherwise(1).alias("style"), F.lit(None).cast("long").alias("chain"), "seq")
    each = joined(["domain_id", "pdb_chain_id"]).join(several, "domain_id", "left_semi").select("domain_id", F.lit(2).alias("style"), F.col("pdb_chain_id").cast("long").alias("chain"), "seq")
    return one.union(each).withColumn("is_reject", reject_flag(F.col("seq")))


def domain_header(domains: DataFrame) -> DataFrame:
    """id, header of domains (id, sid, sccs, regions, protein, species): `sid sccs (regions) protein {species}`."""
    text = F.concat_ws(" ", "sid", "sccs", F.concat(F.lit("("), "regions", F.lit(")")), "protein", F.concat(F.lit("{"), "species", F.lit("}")))
    return domains.select("id", text.alias("header"))


def index_to_map(points: DataFrame, raf: DataFrame, source: int) -> DataFrame:
    """points (pdb_chain_id, seq_idx) with idx, the place in the map of that letter of a sequence; null beyond it."""
    rows = raf.select("pdb_chain_id", residues(F.col("line")).alias("parts"))
    own = F.col("parts") if source == SEQRES else _span(F.col("parts")) if source == SEQRES_CUT else F.filter("parts", lambda r: r["atom"].isNotNull())
    rows = rows.select("pdb_chain_id", F.transform(own, lambda r: r["idx"]).alias("places"))
    return points.join(rows, "pdb_chain_id").select(*points.columns, F.get("places", "seq_idx").alias("idx"))


def map_to_index(points: DataFrame, raf: DataFrame, source: int) -> DataFrame:
    """points (pdb_chain_id, idx) with seq_idx, the place of that residue in a sequence; null if it isn't in it."""
    rows = raf.select("pdb_chain_id", residues(F.col("line")).alias("parts"))
    own = F.col("parts") if source == SEQRES else _span(F.col("parts")) if source == SEQRES_CUT else F.filter("parts", lambda r: r["atom"].isNotNull())
    rows = rows.select("pdb_chain_id", F.transform(own, lambda r: r["idx"]).alias("places"))
    return points.join(rows, "pdb_chain_id").select(*points.columns, F.nullif(F.array_position("places", F.col("idx")), F.lit(0)).cast("long").alias("seq_idx")).withColumn("seq_idx", F.col("seq_idx") - 1)


#: Residues whose contexts are worked out together.
TOGETHER = 1 << 18


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of chains (pdb_chain_id, seen: a letter a residue, `.` where it isn't observed) what observed_context tells."""

    def told(chains: pa.Array, seen: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in seen])
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        end = begin + np.repeat(sizes, sizes)
        at = np.arange(len(begin))
        hole = np.frombuffer(b"".join(seen), np.uint8) == ord(".")
        far = len(at)
        back = lambda where: np.maximum.accumulate(np.where(where, at, -1))
        ahead = lambda where: np.minimum.accumulate(np.where(where, at, far)[::-1])[::-1]
        following, previous = ahead(~hole), back(~hole)
        holes = np.cumsum(hole) - hole
        column = lambda x, null, kind=np.int32: pa.array((x - begin).astype(kind), mask=null)
        return pa.RecordBatch.from_arrays(
            [
                chains.take(pa.array(np.repeat(np.arange(len(seen)), sizes))), column(at, None), column(following, following >= end), column(previous, previous < begin),
                column(np.maximum(back(hole) + 1, begin), hole), column(np.minimum(ahead(hole), end) - 1, hole), pa.array(holes - holes[begin]),
            ],
            ["pdb_chain_id", "idx", "next_observed", "previous_observed", "run_start", "run_end", "gaps_before"],
        )

    for batch in batches:
        column, first, held = batch.column("seen"), 0, 0
        for i in range(len(batch)):
            held += len(column[i].as_py() or "")
            if held >= TOGETHER or i + 1 == len(batch):
                if held:
                    yield told(batch.column("pdb_chain_id").slice(first, i + 1 - first), [(x or "").encode() for x in column.slice(first, i + 1 - first).to_pylist()])
                first, held = i + 1, 0


def observed_context(raf: DataFrame) -> DataFrame:
    """pdb_chain_id, idx, next_observed, previous_observed, run_start, run_end, gaps_before of each residue.

    The nearest observed residue either way; the observed run that a residue is in (null if it isn't observed); and the
    number of unobserved ones before it, so that the gaps between two places are a difference. Each line is looked at by itself: nothing is shuffled or sorted.
    """
    seen = F.regexp_replace(_column(F.col("line"), 5), r"(?s)[^.]", "x")
    kind = raf.schema["pdb_chain_id"].dataType.simpleString()
    return raf.select("pdb_chain_id", seen.alias("seen")).mapInArrow(_contexts, f"pdb_chain_id {kind}, idx int, next_observed int, previous_observed int, run_start int, run_end int, gaps_before long")


def runs_at(points: DataFrame, raf: DataFrame) -> DataFrame:
    """pdb_chain_id, idx, run_start, run_end: what observed_context tells of some residues (points: pdb_chain_id, idx), without the others."""
    rows = points.select("pdb_chain_id", "idx").distinct().join(raf.select("pdb_chain_id", _column(F.col("line"), 5).alias("atom")), "pdb_chain_id").filter("idx >= 0 and idx < length(atom)")
    at = F.col("idx").cast("int")
    up_to, onwards = F.substring_index(F.left("atom", at + 1), ".", -1), F.substring_index(F.substr("atom", at + 1), ".", 1)
    inside = F.length(up_to) > 0
    return rows.select("pdb_chain_id", "idx", F.when(inside, at + 1 - F.length(up_to)).alias("run_start"), F.when(inside, at - 1 + F.length(onwards)).alias("run_end"))


def translate_modified(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """df (id, text) with letters for `(XYZ)` codes by a dictionary (code, letter); unknown ones are x, dots go."""
    tokens = F.regexp_extract_all(F.replace("text", F.lit("."), F.lit("")), F.lit(r"(?s)\([^)]*\)|."), F.lit(0))
    parts = df.select("id", F.posexplode(tokens).alias("at", "token"))
    named = parts.join(dictionary.select(F.concat(F.lit("("), "code", F.lit(")")).alias("token"), "letter"), "token", "left")
    letter = F.when(F.length("token") > 1, F.coalesce("letter", F.lit("x"))).otherwise(F.col("token"))
    joined = named.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", letter.alias("letter")))).alias("parts"))
    return df.select("id").join(joined, "id", "left").select("id", F.coalesce(F.array_join(F.transform("parts", lambda x: x["letter"]), ""), F.lit("")).alias("seq"))


def map_audit(raf: DataFrame) -> DataFrame:
    """pdb_chain_id, issue, n: unobserved residues, observed letters unlike the sequence's, numbers that don't rise. Each line is counted by itself."""
    rows = raf.select("pdb_chain_id", _records(F.col("line")).alias("parts"))
    rows = rows.withColumn("numbers", F.transform("parts", lambda x: F.regexp_extract(F.trim(F.substring(x, 1, 5)), r"^(-?\d+)", 1).try_cast("int")))
    atom, seq = (lambda x: F.substring(x, 6, 1)), (lambda x: F.substring(x, 7, 1))
    counts = {
        "missing": F.filter("parts", lambda x: atom(x) == "."),
        "not-in-seqres": F.filter("parts", lambda x: (atom(x) != ".") & (seq(x) == ".")),
        "mismatch": F.filter("parts", lambda x: (atom(x) != ".") & (seq(x) != ".") & (atom(x) != seq(x))),
        "not-sequential": F.filter(F.zip_with("numbers", F.slice("numbers", 2, F.greatest(F.size("numbers"), F.lit(1))), lambda a, b: b < a), lambda x: x),
    }
    told = F.explode(F.array(*(F.struct(F.lit(issue).alias("issue"), F.size(found).alias("n")) for issue, found in counts.items())))
    return rows.select("pdb_chain_id", told.alias("t")).filter("t.n > 0").groupBy("pdb_chain_id", "t.issue").agg(F.sum("t.n").alias("n"))


def recheck_sequences(chains: DataFrame, seqs: DataFrame, raf: DataFrame, source: int) -> DataFrame:
    """pdb_chain_id of chains whose stored sequence or reject flag isn't what the map gives, with both.

    chains: pdb_chain_id, seq_id; seqs: id, seq, is_reject.
    """
    from cladeforge.functions.text import reject_flag

    stored = chains.join(seqs.select(F.col("id").alias("seq_id"), "seq", "is_reject"), "seq_id")
    again = chain_sequence(raf, source).select("pdb_chain_id", F.col("seq").alias("again"))
    both = stored.join(again, "pdb_chain_id").withColumn("flag", reject_flag(F.col("again")))
    return both.filter((F.col("seq") != F.col("again")) | (F.col("is_reject") != F.col("flag"))).select("pdb_chain_id", "is_reject", "flag")


def residues_per_entry(chains: DataFrame, seqs: DataFrame, unique: bool = False) -> DataFrame:
    """entry_id, residues: the sum of lengths over chains, or over distinct sequences. chains: entry_id, seq_id."""
    own = chains.select("entry_id", "seq_id").distinct() if unique else chains
    return own.join(seqs.select(F.col("id").alias("seq_id"), F.length("seq").alias("n")), "seq_id").groupBy("entry_id").agg(F.sum("n").alias("residues"))
