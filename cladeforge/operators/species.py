"""Species and shared annotations: merging of equal ones, canonical texts, conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_duplicate_species(species: DataFrame, links: DataFrame) -> DataFrame:
    """id, merged_id of species (id, scientific_name, common_name, details, ncbi_taxid) that go into others.

    Equal rows (nulls too) go into the least id. Under one scientific name and details, a null common name is absorbed by the one
    there is; of several, by that with over five more links than the next and over nine. Then a null taxid likewise by the
    one there is; of several, by that with over four more links where the others have none. links: species_id.
    """
    n = links.groupBy(F.col("species_id").alias("id")).agg(F.count("*").alias("n"))
    rows = species.join(n, "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    keys = ["scientific_name", "common_name", "details", "ncbi_taxid"]
    first = rows.groupBy(*keys).agg(F.min("id").alias("into"), F.sum("n").alias("n"))

    def same(a: str, b: str, columns: list[str]) -> Column:
        out = F.lit(True)
        for k in columns:
            out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
        return out

    exact = rows.alias("r").join(first.alias("f"), same("r", "f", keys)).select("r.id", "f.into")
    named = first.filter("common_name is not null").groupBy("scientific_name", "details", "ncbi_taxid")
    ranked = named.agg(F.sort_array(F.collect_list(F.struct("n", F.col("into").alias("id"))), asc=False).alias("peers"))
    top, second = F.col("peers")[0], F.coalesce(F.get("peers", F.lit(1))["n"], F.lit(0))
    winner = ranked.filter((F.size("peers") == 1) | ((top["n"] > second + 5) & (top["n"] > 9))).select("scientific_name", "details", "ncbi_taxid", top["id"].alias("to"))
    lone = first.filter("common_name is null").alias("a").join(winner.alias("b"), same("a", "b", ["scientific_name", "details", "ncbi_taxid"])).select(F.col("a.into").alias("from"), "to")
    coded = first.filter("ncbi_taxid is not null").groupBy("scientific_name", "common_name", "details").agg(F.sort_array(F.collect_list(F.struct("n", F.col("into").alias("id"))), asc=False).alias("peers"))
    best = coded.filter((F.size("peers") == 1) | ((top["n"] > 4) & (second == 0))).select("scientific_name", "common_name", "details", top["id"].alias("to"))
    bare = first.filter("ncbi_taxid is null").alias("a").join(best.alias("b"), same("a", "b", ["scientific_name", "common_name", "details"])).select(F.col("a.into").alias("from"), "to")
    moved = bare.union(lone).groupBy("from").agg(F.min("to").alias("to"))
    out = exact.join(moved, exact["into"] == moved["from"], "left").select("id", F.coalesce("to", "into").alias("merged_id"))
    return out.filter("id <> merged_id")


def canonical_species_text(species: DataFrame, links: DataFrame) -> DataFrame:
    """id, text `Common (Scientific), details [TaxId: n]`; of texts that differ in case alone the one with most links."""
    base = F.when(F.col("common_name").isNotNull(), F.concat("common_name", F.lit(" ("), "scientific_name", F.lit(")"))).otherwise(F.col("scientific_name"))
    text = F.concat(base, F.coalesce(F.concat(F.lit(", "), "details"), F.lit("")), F.coalesce(F.concat(F.lit(" [TaxId: "), "ncbi_taxid", F.lit("]")), F.lit("")))
    n = links.groupBy(F.col("species_id").alias("id")).agg(F.count("*").alias("n"))
    rows = species.select("id", text.alias("text")).join(n, "id", "left").withColumn("key", F.lower("text"))
    used = rows.groupBy("key", "text").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    best = used.groupBy("key").agg(F.min_by("text", F.struct(-F.col("n"), "text")).alias("best"))
    return rows.join(best, "key").select("id", F.col("best").alias("text"))


def sibling_species_merge(nodes: DataFrame) -> DataFrame:
    """id, merged_id of species nodes that repeat under one protein. nodes: id, parent_node_id, species_id."""
    least = nodes.groupBy("parent_node_id", "species_id").agg(F.min("id").alias("merged_id"))
    return nodes.join(least, ["parent_node_id", "species_id"]).filter("id <> merged_id").select("id", "merged_id")


def shared_annotation_classes(domains: DataFrame, group: str, part: str) -> DataFrame:
    """group, annotation, part, representative, links: parts of one group that share an annotation (proteins of a family a gene, or species of
    a protein a source), one row a part. The least part stands for its class; links: how many others a part shares the annotation with.

    domains: group, part, annotation. The rows are at most those of domains: a class of any size isn't turned into its pairs.
    """
    own = domains.filter("annotation is not null").select(F.col(group), F.col(part), "annotation").distinct()
    several = own.groupBy(group, "annotation").agg(F.min(part).alias("representative"), F.count("*").alias("n")).filter("n > 1")
    return own.join(several, [group, "annotation"]).select(group, "annotation", part, "representative", (F.col("n") - 1).alias("links"))


def shared_annotation_conflicts(domains: DataFrame, group: str, part: str) -> DataFrame:
    """group, annotation, a < b: the pairs of shared_annotation_classes, for those who need each one. A class of n parts has n (n - 1) / 2."""
    rows = shared_annotation_classes(domains, group, part).select(group, "annotation", F.col(part).alias("a"))
    return rows.join(rows.withColumnRenamed("a", "b"), [group, "annotation"]).filter("a < b").select(group, "annotation", "a", "b")


def reassign_automatic(automatic: DataFrame, genes: DataFrame, species: DataFrame) -> DataFrame:
    """id, protein_id, species_id of domains under "automated" proteins: the family's only protein with the gene, and under it the
    species of name and taxid, else of taxid, else of name, each where there is one only.

    automatic: id, family_id, gene, name, taxid; genes: family_id, gene, protein_id; species: protein_id, species_id, name, taxid.
    """
    only = genes.groupBy("family_id", "gene").agg(F.count_distinct("protein_id").alias("k"), F.min("protein_id").alias("protein_id")).filter("k = 1").drop("k")
    rows = automatic.join(only, ["family_id", "gene"])
    own = rows.alias("r").join(species.alias("s"), F.col("r.protein_id") == F.col("s.protein_id"))
    same_name, same_id = F.col("r.name") == F.col("s.name"), F.col("r.taxid") == F.col("s.taxid")
    pick = lambda c: F.when(F.count_distinct(F.when(c, F.col("s.species_id"))) == 1, F.min(F.when(c, F.col("s.species_id"))))
    met = own.groupBy("r.id").agg(F.coalesce(pick(same_name & same_id), pick(same_id), pick(same_name)).alias("species_id"))
    return rows.join(met, "id", "left").select("id", "protein_id", "species_id")
