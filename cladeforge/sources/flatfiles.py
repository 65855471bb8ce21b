"""Flat files of a release, read into tables and written from them. Lines starting with # are comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeforge.functions.text import wrapped
from cladeforge.operators.tree import LEVELS


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))


def _write(lines: DataFrame, path: str, *order: str | Column) -> None:
    """Text files whose names' order is the lines' order; sorted by ranges, not in one task."""
    (lines.orderBy(*order) if order else lines).select("line").write.mode("overwrite").text(path)


def _dash(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("-"))


def _undash(column: Column) -> Column:
    return F.nullif(column, F.lit("-"))


# nodes


def write_des(nodes: DataFrame, path: str) -> None:
    """sunid, level, class string, sid or -, description; by id, without the root."""
    names = F.element_at(F.create_map(*(F.lit(x) for kv in LEVELS.items() for x in kv)), F.col("level_id"))
    _write(nodes.filter("level_id > 1").select("id", F.concat_ws("\t", F.col("sunid").cast("string"), names, "sccs", _dash("sid"), "description").alias("line")), path, "id")


def read_nodes(spark: SparkSession, path: str, release_id: int) -> DataFrame:
    """sunid, level_id, sccs, sid, description, release_id of a description file, and the root."""
    p = F.split("value", "\t", 5)
    level = F.element_at(F.create_map(*(F.lit(x) for k, v in LEVELS.items() for x in (v, k))), p[1])
    rows = _lines(spark, path).select(p[0].cast("long").alias("sunid"), level.alias("level_id"), p[2].alias("sccs"), _undash(p[3]).alias("sid"), p[4].alias("description"))
    root = spark.range(1).select(F.lit(0).cast("long"), F.lit(1), F.lit("root"), F.lit(None).cast("string"), F.lit("root"))
    return rows.union(root).withColumn("release_id", F.lit(release_id))


def write_hie(nodes: DataFrame, path: str) -> None:
    """sunid, parent or -, children in order of id or -."""
    children = nodes.filter("parent_node_id is not null").groupBy(F.col("parent_node_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "sunid"))), lambda x: x["sunid"].cast("string")), ",").alias("children"))
    parents = nodes.select(F.col("id").alias("parent_node_id"), F.col("sunid").alias("parent"))
    rows = nodes.join(children, "id", "left").join(parents, "parent_node_id", "left")
    _write(rows.select("id", F.concat_ws("\t", F.col("sunid").cast("string"), _dash("parent"), _dash("children")).alias("line")), path, "id")


def read_hierarchy(spark: SparkSession, path: str, nodes: DataFrame) -> DataFrame:
    """nodes with parent_sunid from a hierarchy file."""
    p = F.split("value", "\t")
    rows = _lines(spark, path).select(p[0].cast("long").alias("sunid"), _undash(p[1]).cast("long").alias("parent_sunid"))
    return nodes.join(rows, "sunid", "left")


def write_com(comments: DataFrame, path: str) -> None:
    """sunid ! comment ! comment. comments: sunid, number, description."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("number", "description"))), lambda x: x["description"])
    _write(comments.groupBy("sunid").agg(F.concat_ws(" ! ", F.col("sunid").cast("string"), F.array_join(parts, " ! ")).alias("line")), path, "sunid")


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    """sunid, number, description, is_autogenerated of a comment file; links are taken out."""
    p = F.split("value", " ! ")
    rows = _lines(spark, path).select(p[0].cast("long").alias("sunid"), F.posexplode(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0)))).alias("number", "description"))
    bare = F.trim(F.regexp_replace("description", r"<[^>]*>", ""))
    automatic = bare.startswith("complexed with ") | bare.startswith("automatically matched to ")
    return rows.select("sunid", "number", bare.alias("description"), automatic.cast("int").alias("is_autogenerated"))


def write_rep(nodes: DataFrame, notes: DataFrame, path: str) -> None:
    """sid and its repeat notes. notes: node_id, description."""
    text = notes.groupBy(F.col("node_id").alias("id")).agg(F.array_join(F.array_sort(F.collect_list("description")), " ! ").alias("text"))
    _write(nodes.join(text, "id").select("sid", F.concat_ws("\t", "sid", "text").alias("line")), path, "sid")


def write_inc(nodes: DataFrame, inconsistent: DataFrame, path: str) -> None:
    """class string, kind, sids of inconsistent domains. inconsistent: node_id, kind."""
    rows = nodes.join(inconsistent.withColumnRenamed("node_id", "id"), "id").groupBy("sccs", "kind").agg(F.array_join(F.array_sort(F.collect_list("sid")), ",").alias("sids"))
    _write(rows.select("sccs", "kind", F.concat_ws("\t", "sccs", "kind", "sids").alias("line")), path, "sccs", "kind")


def write_history(history: DataFrame, path: str) -> None:
    """old id, kind of id, (type:new ids), releases; obsolete types carry `-`. history: old_id, kind, change_type, new_id, releases."""
    ids = F.array_join(F.array_sort(F.collect_set("new_id")), ",")
    rows = history.groupBy("old_id", "kind", "releases", "change_type").agg(F.when(F.col("change_type") <= 3, "-").otherwise(ids).alias("ids"))
    _write(rows.select("old_id", "change_type", F.concat(F.col("old_id"), F.lit("\t"), F.col("kind"), F.lit("\t("), F.col("change_type"), F.lit(":"), F.col("ids"), F.lit(")\t"), F.col("releases")).alias("line")), path, "old_id", "change_type")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """old_id, kind, change_type, new_id, releases; one row a new id, null for obsolete ones."""
    p = F.split("value", "\t")
    rows = _lines(spark, path).select(p[0].alias("old_id"), p[1].alias("kind"), F.regexp_extract(p[2], r"^\((\d+):", 1).cast("int").alias("change_type"), F.regexp_extract(p[2], r":(.*)\)$", 1).alias("ids"), p[3].alias("releases"))
    return rows.select("old_id", "kind", "change_type", F.explode(F.split("ids", ",")).alias("new_id"), "releases").withColumn("new_id", _undash(F.col("new_id")))


def write_cla(nodes: DataFrame, lineage: DataFrame, path: str) -> None:
    """sid, code, regions, class string, sunid, `cl=..,cf=..,..,px=..` of domains, with sunids of lineage's columns."""
    levels = [v for k, v in LEVELS.items() if 2 <= k < 8]
    up = F.concat_ws(",", *(F.concat(F.lit(f"{v}="), F.col(v).cast("string")) for v in levels), F.concat(F.lit("px="), F.col("sunid").cast("string")))
    rows = nodes.filter("level_id = 8").join(lineage.withColumnRenamed("node_id", "id"), "id")
    line = F.concat_ws("\t", "sid", F.substring_index("description", " ", 1), F.substring_index("description", " ", -1), "sccs", F.col("sunid").cast("string"), up)
    _write(rows.select("sunid", line.alias("line")), path, "sunid")


# maps, quality, cross references


def write_raf(raf: DataFrame, path: str) -> None:
    """Lines of maps in binary order."""
    _write(raf.select(F.col("line")), path, F.col("line"))


def read_raf(spark: SparkSession, path: str) -> DataFrame:
    """code, chain, first_id, last_id, line of residue maps."""
    line = F.col("value")
    return spark.read.text(path).select(F.substring(line, 1, 4).alias("code"), F.substring(line, 5, 1).alias("chain"), F.trim(F.substring(line, 29, 5)).alias("first_id"), F.trim(F.substring(line, 34, 5)).alias("last_id"), line.alias("line"))


def write_quality(scores: DataFrame, path: str) -> None:
    """code, aerospaci, spaci (two digits), method, resolution, r_factor; NA for what there isn't."""
    number = lambda c, d: F.coalesce(F.format_string(f"%.{d}f", c), F.lit("NA"))
    value = lambda c, d: F.when(F.col(c).isNull(), "NA").otherwise(number(c, d))
    line = F.concat_ws("\t", "code", value("aerospaci", 2), value("spaci", 2), "method", value("resolution", 2), value("r_factor", 3))
    _write(scores.select("code", line.alias("line")), path, "code")


def read_quality(spark: SparkSession, path: str, release_id: int) -> DataFrame:
    """The table of a quality file: NA and - are null, and a resolution or R factor of 0."""
    p = F.split("value", "\t")
    known = lambda i: F.when(~p[i].isin("NA", "-"), p[i].try_cast("double"))
    return _lines(spark, path).select(p[0].alias("code"), known(1).alias("aerospaci"), known(2).alias("spaci"), p[3].alias("method"), F.nullif(known(4), F.lit(0.0)).alias("resolution"), F.nullif(known(5), F.lit(0.0)).alias("r_factor"), F.lit(release_id).alias("release_id"))


def write_xrefs(xrefs: DataFrame, path: str) -> None:
    """accession, sid."""
    _write(xrefs.select("accession", "sid", F.concat_ws("\t", "accession", "sid").alias("line")), path, "accession", "sid")


# hits


def e_value(log10_e: Column) -> Column:
    """An E value as hit summaries write it: three significant digits, no zeros at their end; `0` for -9999, an exponent of two digits
    or more from 1e-4 down."""
    short = lambda x: F.regexp_replace(x, r"\.?0+$", "")
    power = F.floor(log10_e).cast("int")
    value = F.pow(F.lit(10.0), log10_e)
    plain = F.format_string("%.0f", value)
    for digits in range(1, 7):
        plain = F.when(power == 2 - digits, short(F.format_string(f"%.{digits}f", value))).otherwise(plain)
    coefficient = short(F.format_string("%.2f", F.pow(F.lit(10.0), log10_e - power)))
    carried = coefficient == "10"
    small = F.format_string("%se%03d", F.when(carried, "1").otherwise(coefficient), power + carried.cast("int"))
    return F.when(log10_e <= -9999, "0").when(log10_e > -4, plain).otherwise(small)


def write_pairs(pairs: DataFrame, kind: str, path: str) -> None:
    """bg: both sids, E, depth of likeness, first and last places of both, without hits of length 0; bib: both sids, percent, depth.
    pairs: sid1, sid2, depth and blast_log10_e, start1, length1, start2, length2 or pct_identical."""
    if kind == "bg":
        pairs = pairs.filter("length1 <> 0 and length2 <> 0")
        places = [x for s, n in (("start1", "length1"), ("start2", "length2")) for x in ((F.col(s) + 1).cast("string"), (F.col(s) + F.col(n)).cast("string"))]
        line = F.concat_ws(" ", "sid1", "sid2", e_value(F.col("blast_log10_e").cast("double")), F.col("depth").cast("string"), *places)
    else:
        line = F.concat_ws(" ", "sid1", "sid2", F.format_string("%.2f", "pct_identical"), F.col("depth").cast("string"))
    _write(pairs.select("sid1", "sid2", line.alias("line")), path, "sid1", "sid2", "line")


def read_hit_summary(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """sid1, sid2 and blast_log10_e, start1, length1, start2, length2 (bg) or pct_identical (bib); E of 0 is -9999."""
    p = F.split(F.trim("value"), r"\s+")
    if kind == "bib":
        return _lines(spark, path).select(p[0].alias("sid1"), p[1].alias("sid2"), p[2].cast("double").alias("pct_identical"))
    base, power = F.substring_index(p[2], "e", 1), F.regexp_extract(p[2], r"e(-\d+)$", 1)
    coefficient = base.try_cast("double")
    small = power.try_cast("int") + F.when(coefficient > 0, F.log10(coefficient)).otherwise(0.0)
    plain = F.when(coefficient == 0, -9999.0).otherwise(F.log10(coefficient))
    e = F.when(power != "", small).otherwise(plain)
    n = [p[i].cast("int") for i in range(4, 8)]
    return _lines(spark, path).select(p[0].alias("sid1"), p[1].alias("sid2"), e.alias("blast_log10_e"), (n[0] - 1).alias("start1"), (n[1] - n[0] + 1).alias("length1"), (n[2] - 1).alias("start2"), (n[3] - n[2] + 1).alias("length2"))


# sequences


def write_fasta(seqs: DataFrame, path: str, style: str = "id", width: int = 60) -> None:
    """Records of non-empty sequences (sid, seq, and header for style domain, description for style chain)."""
    name = {"id": F.col("sid"), "chain": F.concat_ws(" ", "sid", "description") if "description" in seqs.columns else F.col("sid"), "domain": F.col("header") if "header" in seqs.columns else F.col("sid")}[style]
    _write(seqs.filter(F.length("seq") > 0).select("sid", F.concat(F.lit(">"), name, F.lit("\n"), wrapped(F.col("seq"), width)).alias("line")), path, "sid")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, description, seq of records with wrapped lines."""
    rows = spark.read.text(path, lineSep=">").filter(F.trim("value") != "")
    head = F.trim(F.substring_index("value", "\n", 1))
    body = F.when(F.col("value").contains("\n"), F.regexp_replace(F.substr(F.col("value"), F.instr("value", "\n") + 1), r"\s+", "")).otherwise("")
    return rows.select(F.substring_index(head, " ", 1).alias("name"), F.trim(F.substr(head, F.length(F.substring_index(head, " ", 1)) + 1)).alias("description"), body.alias("seq"))


# clusters and alignments


def read_structural_clusters(spark: SparkSession, path: str, nodes: DataFrame) -> DataFrame:
    """rep, member of clusters in a text: a line that names a class (a.1.1.1) or a group (1:) starts one, domains follow. The rep is the first
    member that there is; the last cluster ends with its file. nodes: sid.

    A file is read in splits, each a task. Lines follow the last start in their own split; those before its first start, the last
    one of the splits before, which is carried over from one row a split.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    starts = F.col("text").rlike(r"^\s*[a-l]\.\d+") | F.col("text").rlike(r"^\s*\d+:")
    sids = F.regexp_extract_all("text", F.lit(r"\b(d[a-z0-9_.]{5,})"), F.lit(1))
    told = lines.select("file", "split", "at", F.when(starts, F.col("at")).alias("start"), sids.alias("sids")).filter("start is not null or size(sids) > 0")
    carried = told.groupBy("file", "split").agg(F.max("start").alias("last")).withColumn("before", F.last("last", True).over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.last("start", True).over(Window.partitionBy("file", "split").orderBy("at"))
    rows = told.withColumn("own", inside).filter("size(sids) > 0").join(carried, ["file", "split"])
    found = rows.select("file", F.coalesce("own", "before", F.lit(-1)).alias("cluster"), "split", "at", F.posexplode("sids").alias("i", "sid"))
    here = found.join(nodes.select("sid").distinct(), "sid")
    rep = here.groupBy("file", "cluster").agg(F.min_by("sid", F.struct("split", "at", "i")).alias("rep"))
    return here.join(rep, ["file", "cluster"]).select("rep", F.col("sid").alias("member"))


#: How the statistics of a structure alignment are written.
ALIGNMENT = {
    "chain_len": (r"Align.*\.pdb (\d+) with", "int"), "domain_len": (r"with .*\.ent (\d+)", "int"), "ini_len": (r"ini-len (\d+)", "int"), "ini_rmsd": (r"ini-rmsd (\d+\.\d+)", "double"), "opt_equ": (r"opt-equ (\d+)", "int"), "opt_rmsd": (r"opt-rmsd (\d+\.\d+)", "double"),
    "chain_rmsd": (r"chain-rmsd (\d+\.\d+)", "double"), "score": (r"Score (\d+\.\d+)", "double"), "align_len": (r"align-len (\d+)", "int"), "gaps": (r"gaps (\d+)", "int"), "p_value": (r"P-value ([0-9.]+e[+-]?\d+)", "double"), "afp_num": (r"Afp-num (\d+)", "int"), "identity": (r"Identity (\d+\.\d+)%", "double"), "similarity": (r"Similarity (\d+\.\d+)%", "double"),
}


def read_alignment_stats(spark: SparkSession, path: str) -> DataFrame:
    """The statistics of each alignment; texts start with a line `Align`, and null stands for what a text doesn't have."""
    texts = spark.read.text(path, lineSep="Align ").filter(F.trim("value") != "").select(F.concat(F.lit("Align "), "value").alias("value"))
    return texts.select(*(F.regexp_extract("value", pattern, 1).try_cast(kind).alias(k) for k, (pattern, kind) in ALIGNMENT.items()))


# subsets and predictions


def write_subsets(assigned: DataFrame, mode: str, path: str, seqs: DataFrame | None = None, style: str = "domain") -> None:
    """ids: the reps; log: each rep and its members with their scores; fasta: the reps' sequences. assigned: threshold, rep, item, score; seqs: item and
    what write_fasta takes in that style."""
    if mode == "fasta":
        write_fasta(seqs.join(assigned.select(F.col("rep").alias("item")).distinct(), "item", "left_semi"), path, style)
        return
    if mode == "ids":
        _write(assigned.select("rep", F.col("rep").cast("string").alias("line")).distinct(), path, "rep")
        return
    members = F.transform(F.array_sort(F.collect_list(F.struct((-F.coalesce("score", F.lit(0.0))).alias("order"), "item", F.coalesce("score", F.lit(0.0)).alias("score")))), lambda x: F.concat(x["item"].cast("string"), F.lit(" "), F.format_string("%.2f", x["score"])))
    rows = assigned.groupBy("threshold", "rep").agg(F.array_join(members, ", ").alias("members"))
    _write(rows.select("rep", F.concat(F.col("rep").cast("string"), F.lit(": "), F.col("members")).alias("line")), path, "rep")


def prediction_name(source: Column, info: Column, family: Column, verbose: bool = False) -> Column:
    """The name of an annotation in a file of predictions, by its source (blast, pfam, fam, sf; anything else is unmatched). info is `release sid` for
    sequence matches, which then name the sid and the family, or, verbose, release, sid and superfamily; else the model's release."""
    place = F.instr(info, " ")
    sid, told = F.when(place > 0, F.substr(info, place + 1)), F.regexp_extract(family, r"^(.*)\.[^.]*$", 1)
    if not verbose:
        return F.when(source == "blast", F.coalesce(F.concat(sid, F.lit("-"), family), F.lit(""))).when(source.isin("pfam", "fam", "sf"), family).otherwise("[UNMATCHED]")
    match = F.when(F.contains(family, F.lit(".")), F.concat(F.lit("[ASTRAL-"), F.substring_index(info, " ", 1), F.lit("-BLAST-"), sid, F.lit("]"), told))
    out = F.when(source == "blast", F.coalesce(match, F.lit("")))
    for kind, mark in (("pfam", "PFAM"), ("fam", "ASTRALfam"), ("sf", "ASTRALsf")):
        out = out.when(source == kind, F.concat(F.lit(f"[{mark}-"), info, F.lit("]"), family))
    return out.otherwise("[UNMATCHED]")


def write_predictions(annotations: DataFrame, chains: DataFrame, path: str) -> None:
    """Of each chain a line `>sid`, then one for each annotation by start: name, first and last residue, regions, 0.0 and log10 E.

    annotations: chain_id, number, name, start, end, region, log10e; chains: chain_id, sid. Residues count from 1; an E value of -9999 has no
    decimals, others have 14, from -10 down 13, from -100 down 12.
    """
    parts = F.array_sort(F.collect_list(F.struct("region", "start", "end")))
    e = F.col("log10e")
    value = F.when(e == -9999, "-9999").when(e > -10, F.format_string("%.14f", e)).when(e > -100, F.format_string("%.13f", e)).otherwise(F.format_string("%.12f", e))
    one = annotations.groupBy("chain_id", "number", "name").agg(parts.alias("parts"), F.min("start").alias("first"), F.max("end").alias("last"), F.min("log10e").alias("log10e"))
    regions = F.array_join(F.transform("parts", lambda x: F.concat((x["start"] + 1).cast("string"), F.lit("-"), x["end"].cast("string"))), ",")
    lines = one.join(chains.select("chain_id"), "chain_id", "left_semi").select("chain_id", (F.col("first") + 1).alias("at"), "number", F.concat_ws(" ", "name", (F.col("first") + 1).cast("string"), F.col("last").cast("string"), regions, F.lit("0.0"), value).alias("line"))
    heads = chains.select("chain_id", F.lit(0).cast("long").alias("at"), F.lit(0).alias("number"), F.concat(F.lit(">"), "sid").alias("line"))
    _write(lines.union(heads), path, "chain_id", "at", "number")
