"""Lookups, filters and flags on nodes, chains and domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.functions.text import reject_flag

#: Words that mark a synthetic entry, and NMR titles that mark a model.
SYNTHETIC_WORDS = ["design", "synthesized"]
MODEL_WORDS = ["model", "backbone", "predict", "based on"]


def resolve_ids(ids: DataFrame, nodes: DataFrame, sid_pattern: str = "^d.{6}$", classes: str = "a-l") -> DataFrame:
    """Strings (column given) of mixed kinds with the node they name: `N` and an id, a sid, a class string of levels up to
    5, else a sunid. 0 where none has it, -1 where several have."""
    g = F.col("given")
    kind = F.when(g.rlike(r"^N\d+$"), "id").when(g.rlike(sid_pattern), "sid").when(g.rlike(rf"^[{classes}](\.\d+)*$"), "sccs").otherwise("sunid")
    asked = ids.select("given").distinct().select("given", kind.alias("kind"), F.when(kind == "id", F.substr(g, F.lit(2))).otherwise(g).alias("key"))
    names = F.array(
        F.struct(F.lit("id").alias("kind"), F.col("id").cast("string").alias("key")),
        F.struct(F.lit("sid").alias("kind"), F.col("sid").alias("key")),
        F.struct(F.lit("sccs").alias("kind"), F.when(F.col("level_id") <= 5, F.col("sccs")).alias("key")),
        F.struct(F.lit("sunid").alias("kind"), F.col("sunid").cast("string").alias("key")),
    )
    known = nodes.select("id", F.explode(names).alias("name")).select("id", "name.*").filter("key is not null")
    met = asked.join(known, ["kind", "key"]).groupBy("given").agg(F.when(F.count("*") > 1, -1).otherwise(F.min("id")).alias("node_id"))
    return ids.join(met, "given", "left").withColumn("node_id", F.coalesce("node_id", F.lit(0)).cast("long"))


def latest_release(releases: DataFrame, public_only: bool = True) -> DataFrame:
    """One row: the largest release id, of public ones or of all."""
    return (releases.filter("is_public = 1") if public_only else releases).agg(F.max("id").alias("id"))


def class_filter(df: DataFrame, lo: str = "a", hi: str = "g", invert: bool = False) -> DataFrame:
    """Rows whose class string begins with a letter from lo to hi, or those whose doesn't."""
    inside = F.col("sccs").rlike(f"^[{lo}-{hi}]")
    return df.filter(~inside if invert else inside)


def select_sequences(items: DataFrame, seqs: DataFrame, nodes: DataFrame, release_id: int, source_id: int, styles: list[int], rejects: str = "exclude", classes: tuple[str, str] | None = ("a", "g"), unique: bool = False) -> DataFrame:
    """Items of a release by source, style, class and reject mode (exclude, include, only); with unique, one row a sequence.

    items: id, node_id, source_id, style_id, sid, seq_id; seqs: id, seq, is_reject; nodes: id, sccs, release_id.
    """
    own = nodes.filter(F.col("release_id") == release_id).select(F.col("id").alias("node_id"), "sccs")
    own = class_filter(own, *classes) if classes else own
    wanted = items.filter((F.col("source_id") == source_id) & F.col("style_id").isin(styles))
    texts = seqs.select(F.col("id").alias("seq_id"), "seq", "is_reject")
    if rejects != "include":
        texts = texts.filter(F.col("is_reject") == int(rejects == "only"))
    out = wanted.join(own, "node_id").join(texts, "seq_id")
    if unique:
        return out.groupBy("seq_id").agg(F.min("sid").alias("sid"), F.min("seq").alias("seq"))
    return out.select("id", "sid", "sccs", "seq_id", "seq")


def with_reject_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_reject", reject_flag(F.col("seq")))


def with_synthetic_flag(chains: DataFrame, sources: DataFrame, entries: DataFrame, words: list[str] | None = None) -> DataFrame:
    """chains with whether any chain of the entry has a synthetic source, or the entry's text has one of the words.

    chains: id, entry_id; sources: chain_id, is_synthetic; entries: id, description.
    """
    words = words or SYNTHETIC_WORDS
    by_source = chains.join(sources.filter("is_synthetic = 1").select(F.col("chain_id").alias("id")).distinct(), "id").select("entry_id")
    by_text = entries.filter(F.lower("description").rlike("|".join(words))).select(F.col("id").alias("entry_id"))
    marked = by_source.union(by_text).distinct().withColumn("is_synthetic", F.lit(True))
    return chains.join(marked, "entry_id", "left").withColumn("is_synthetic", F.coalesce("is_synthetic", F.lit(False)))


def with_ribosomal_flag(domains: DataFrame, closed: DataFrame, nodes: DataFrame, word: str = "ibosomal", levels: tuple[int, ...] = (5, 6)) -> DataFrame:
    """domains (node_id) with whether an ancestor on one of the levels has the word in its text."""
    named = nodes.filter(F.col("level_id").isin(*levels) & F.col("description").contains(word)).select(F.col("id").alias("ancestor_id"))
    marked = closed.join(named, "ancestor_id", "left_semi").select("node_id").distinct().withColumn("is_ribosomal", F.lit(True))
    return domains.join(marked, "node_id", "left").withColumn("is_ribosomal", F.coalesce("is_ribosomal", F.lit(False)))


def with_multi_chain_flag(links: DataFrame) -> DataFrame:
    """node_id and whether it is linked to several chains. links: node_id, chain_id."""
    return links.groupBy("node_id").agg((F.count_distinct("chain_id") > 1).alias("is_multi_chain"))


def with_whole_chain_flag(domains: DataFrame, parts: DataFrame) -> DataFrame:
    """domains (id, sid) with whether they are whole chains: their name ends in `_`, or each of their parts' sequence is
    its chain's. parts: domain_id, seq, chain_seq."""
    equal = parts.groupBy(F.col("domain_id").alias("id")).agg(F.bool_and(F.col("seq") == F.col("chain_seq")).alias("equal"))
    whole = F.col("sid").endswith("_") | F.coalesce("equal", F.lit(False))
    return domains.join(equal, "id", "left").withColumn("is_whole_chain", whole).drop("equal")


def with_all_chains_flag(links: DataFrame, chains: DataFrame) -> DataFrame:
    """node_id, release_id and whether the domain uses all chains of the release. links: node_id, chain_id."""
    total = chains.groupBy("release_id").agg(F.count("*").alias("total"))
    used = links.join(chains.withColumnRenamed("id", "chain_id"), "chain_id").groupBy("node_id", "release_id").agg(F.count_distinct("chain_id").alias("used"))
    return used.join(total, "release_id").select("node_id", "release_id", (F.col("used") == F.col("total")).alias("uses_all_chains"))


def resolution_gate(chains: DataFrame, limit: float = 3.2) -> DataFrame:
    """chains (method, resolution, title) with a reason against them, or null: low-res (or no method), nmr-model, unk-res.

    A null resolution is 0, which stands for an unknown one; NMR without a resolution is judged by its title, a null title is a model's.
    """
    resolution = F.coalesce("resolution", F.lit(0.0))
    model = F.col("title").isNull() | F.col("title").rlike("|".join(MODEL_WORDS))
    unknown = F.when(F.col("method").startswith("NMR"), F.when(model, "nmr-model")).otherwise("unk-res")
    return chains.withColumn("reason", F.when(F.col("method").isNull() | (resolution >= limit), "low-res").when(resolution == 0, unknown))


#: How accessions of each database are written in comments, and what is put before what is found.
ACCESSIONS = {"pfam": ("Pfam ([0-9]{5})", "PF"), "pfamb": ("PfamB ([0-9]{6})", "PB"), "pubmed": ("PubMed ([0-9]+)", "")}
UNIPROT_LINK = "http://www.uniprot.org/uniprot/"
UNIPROT, UNIPROT_SHORT = "[OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9](?:[A-Z][A-Z0-9]{2}[0-9]){1,2}", "[OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9][A-Z][A-Z0-9]{2}[0-9]"


def extract_xrefs(comments: DataFrame, db: str) -> DataFrame:
    """node_id, accession of a database (pfam, pfamb, uniprot, pubmed) found in comments (node_id, description), each once.

    UniProt: the texts of links to it, where a comment has such links; else `SQ ` and an accession of six characters.
    """
    text = F.col("description")
    if db == "uniprot":
        linked = F.filter(F.regexp_extract_all(text, F.lit(UNIPROT_LINK.replace(".", r"\.") + "(?=[^>]*>([^<]*)<)"), F.lit(1)), lambda x: x.rlike(f"^(?:{UNIPROT})$"))
        found = F.when(text.contains(UNIPROT_LINK), linked).otherwise(F.regexp_extract_all(text, F.lit(f"SQ ({UNIPROT_SHORT})"), F.lit(1)))
    else:
        pattern, head = ACCESSIONS[db]
        found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: F.concat(F.lit(head), x))
    return comments.select("node_id", F.explode(found).alias("accession")).distinct()


def auto_comments(links: DataFrame, compounds: DataFrame, headers: DataFrame, ligands: DataFrame) -> DataFrame:
    """node_id, description of nodes with something to say, parts between `; `: protein/DNA complex and protein/RNA complex (if the headers
    speak of a complex), sorted ligands without water, mutant (by compounds or title).

    links: node_id, chain_id, release_id; compounds: chain_id, description; headers: release_id, title, class, keywords; ligands:
    release_id, description.
    """
    mutant = F.coalesce(F.bool_or(F.lower("description").rlike("mutant|mutation")), F.lit(False))
    of_node = links.join(compounds, "chain_id", "left").groupBy("node_id").agg(F.max("release_id").alias("release_id"), mutant.alias("mutant"))
    bound = ligands.filter(F.lower("description") != "hoh").groupBy("release_id").agg(F.array_join(F.array_sort(F.collect_set(F.lower("description"))), ", ").alias("codes"))
    rows = of_node.join(headers, "release_id", "left").join(bound, "release_id", "left")
    text = F.concat_ws(" ; ", "title", "class", "keywords")
    complexed = F.lower(text).contains("complex")
    changed = F.col("mutant") | F.coalesce(F.lower("title").rlike("mutant|mutation"), F.lit(False))
    parts = [F.when(complexed & text.contains("DNA"), "protein/DNA complex"), F.when(complexed & text.contains("RNA"), "protein/RNA complex"), F.when(F.col("codes").isNotNull(), F.concat(F.lit("complexed with "), "codes")), F.when(changed, "mutant")]
    return rows.select("node_id", F.array_join(F.array_compact(F.array(*parts)), "; ").alias("description")).filter("description <> ''")
