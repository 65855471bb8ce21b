"""Joins by date and release, and reports on what changed between two states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is largest by order: one aggregate, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row")).select(*keys, "row.*")


def asof_release(releases: DataFrame, snapshots: DataFrame, freeze_date: str) -> DataFrame:
    """Per entry the release with the newest snapshot, where file, revision and snapshot aren't after the freeze date.

    releases: id, entry_id, file_date, revision_date; snapshots: release_id, snapshot_date.
    """
    day = F.lit(freeze_date).cast("date")
    held = releases.filter((F.col("file_date") <= day) & (F.col("revision_date") <= day)).join(snapshots.filter(F.col("snapshot_date") <= day).withColumnRenamed("release_id", "id"), "id")
    return _newest(held.select("entry_id", "id", "snapshot_date"), ["entry_id"], ["snapshot_date", "id"])


def asof_date(releases: DataFrame, date: str) -> DataFrame:
    """Per entry the newest release of a date or before."""
    held = releases.filter(F.col("revision_date") <= F.lit(date).cast("date"))
    return _newest(held.select("entry_id", "id", "revision_date"), ["entry_id"], ["revision_date", "id"])


def asof_with_tolerance(requests: DataFrame, releases: DataFrame, days: int = 7) -> DataFrame:
    """request_id and the release that was valid on its date: the newest before, else the first within some days after.

    requests: request_id, entry_id, date; of releases of one day the largest id counts. Requests and releases of an entry are
    sorted together, so that each request looks at one release and not at all. Where none is before, the next one after is the
    entry's first.
    """
    days_of = releases.groupBy("entry_id", F.col("revision_date").alias("date")).agg(F.max("id").alias("release_id"))
    first = days_of.groupBy("entry_id").agg(F.min(F.struct("date", "release_id")).alias("first"))
    asked = requests.select("entry_id", "date", F.lit(None).cast(releases.schema["id"].dataType).alias("release_id"), "request_id", F.lit(1).alias("kind"))
    held = days_of.select("entry_id", "date", "release_id", F.lit(None).cast(requests.schema["request_id"].dataType).alias("request_id"), F.lit(0).alias("kind"))
    so_far = Window.partitionBy("entry_id").orderBy("date", "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = asked.union(held).withColumn("before", F.last("release_id", ignorenulls=True).over(so_far)).filter("kind = 1").join(first, "entry_id", "left")
    after = F.when(F.col("first.date") <= F.date_add("date", days), F.col("first.release_id"))
    return met.select("request_id", F.coalesce("before", after).alias("release_id")).filter("release_id is not null")


def raf_at(raf: DataFrame, release_id: int | None) -> DataFrame:
    """Maps valid in a release; for None (not yet frozen) those with both bounds null. `duplicated` marks chains with several."""
    if release_id is None:
        valid = raf.filter("first_release_id is null and last_release_id is null")
    else:
        valid = raf.filter((F.col("first_release_id") <= release_id) & (F.col("last_release_id") >= release_id))
    n = valid.groupBy("pdb_chain_id").agg((F.count("*") > 1).alias("duplicated"))
    return valid.join(n, "pdb_chain_id")


def expand_hits(hits: DataFrame, items: DataFrame) -> DataFrame:
    """Hits between sequences as pairs of items of one source and style; lengths above 0, items differ.

    A sequence shared by very many items makes a large key: both joins are on the sequence alone, so they can be split.
    """
    left = items.select(F.col("seq_id").alias("seq1_id"), F.col("id").alias("id1"), F.col("source_id").alias("source_id"), F.col("style_id").alias("style_id"))
    right = items.select(F.col("seq_id").alias("seq2_id"), F.col("id").alias("id2"), F.col("source_id").alias("s2"), F.col("style_id").alias("t2"))
    real = hits.filter("seq1_length > 0 and seq2_length > 0")
    pairs = real.join(left, "seq1_id").join(right, "seq2_id").filter("id1 <> id2 and source_id = s2 and style_id = t2")
    return pairs.select("id1", "id2", "source_id", "style_id", "blast_log10_e", "pct_identical")


def pair_edges(pairs: DataFrame) -> DataFrame:
    """a < b with the largest identity and the largest log10 E of all hits in both directions."""
    a, b = F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b")
    return pairs.groupBy(a, b).agg(F.max("pct_identical").alias("pct"), F.max(F.round("blast_log10_e", 8)).alias("e"))


def pair_table(pairs: DataFrame, domains: DataFrame, kind: str) -> DataFrame:
    """Pairs with both class strings, classes a to g; kind "bib" keeps the row of least log10 E of each pair.

    domains: id, sid, sccs, is_reject.
    """
    good = domains.filter(F.col("sccs").rlike("^[a-g]") & (F.col("is_reject") == 0)).select("id", "sid", "sccs")
    out = pairs.join(good.toDF("id1", "sid1", "sccs1"), "id1").join(good.toDF("id2", "sid2", "sccs2"), "id2")
    columns = ["sid1", "sid2", "sccs1", "sccs2", "blast_log10_e", "pct_identical"]
    if kind == "bg":
        return out.select(*columns)
    return out.groupBy("sid1", "sid2", "sccs1", "sccs2").agg(F.min("blast_log10_e").alias("blast_log10_e"), F.min_by("pct_identical", F.struct("blast_log10_e", "pct_identical")).alias("pct_identical"))


def link_domains_to_chains(nodes: DataFrame, current: DataFrame, chains: DataFrame) -> DataFrame:
    """node_id, pdb_chain_id of the polypeptide chains that a domain's description names.

    nodes: id, description (`code chain:region,...`); current: code, pdb_release_id; chains: id, pdb_release_id, chain, is_polypeptide.
    """
    parts = F.explode(F.split(F.substring_index("description", " ", -1), ","))
    named = nodes.select(F.col("id").alias("node_id"), F.substring_index("description", " ", 1).alias("code"), parts.alias("part"))
    named = named.withColumn("chain", F.when(F.col("part").contains(":"), F.substring_index("part", ":", 1)).otherwise(" "))
    real = chains.filter("is_polypeptide = 1").select("pdb_release_id", "chain", F.col("id").alias("pdb_chain_id"))
    return named.join(current, "code").join(real, ["pdb_release_id", "chain"]).select("node_id", "pdb_chain_id").distinct()


def extend_versions(versions: DataFrame, current: DataFrame, release_id: int) -> DataFrame:
    """Versions of maps after a release: one that equals the last release's lives on, others are new ones.

    versions: chain_id, line, first_release_id, last_release_id; current: chain_id, line.
    """
    now = current.withColumn("here", F.lit(True))
    live = versions.filter(F.col("last_release_id") == release_id - 1)
    joined = live.join(now, ["chain_id", "line"], "full")
    last = F.when(F.col("here"), release_id).otherwise(F.col("last_release_id"))
    moved = joined.select("chain_id", "line", F.coalesce("first_release_id", F.lit(release_id)).alias("first_release_id"), last.alias("last_release_id"))
    return versions.filter(F.col("last_release_id") < release_id - 1).select(*moved.columns).union(moved)


def drop_obsolete(entries: DataFrame, freeze_date: str, classified: DataFrame) -> DataFrame:
    """entries without those obsolete by a date, unless their replacement isn't classified.

    entries: id, obsolete_date, obsoleted_by; classified: entry_id.
    """
    known = classified.select(F.col("entry_id").alias("obsoleted_by"), F.lit(True).alias("replaced")).distinct()
    gone = (F.col("obsolete_date") <= F.lit(freeze_date).cast("date")) & F.coalesce("replaced", F.col("obsoleted_by").isNull())
    return entries.join(known, "obsoleted_by", "left").filter(~F.coalesce(gone, F.lit(False))).select(*entries.columns)


def new_chains(releases: DataFrame, chains: DataFrame, classified: DataFrame, obsolete: DataFrame, start: str, end: str) -> DataFrame:
    """Chains (id, entry_id) of the newest release of entries that there are at the end and weren't at the start.

    releases: id, entry_id, revision_date; chains: id, release_id; classified, obsolete: entry_id.
    """
    late = asof_date(releases, end)
    early = releases.filter(F.col("revision_date") <= F.lit(start).cast("date"))
    for known in (early, obsolete, classified):
        late = late.join(known.select("entry_id").distinct(), "entry_id", "left_anti")
    return chains.join(late.select("entry_id", F.col("id").alias("release_id")), "release_id").select("id", "entry_id")


def new_chains_between_releases(raf: DataFrame, a: int, b: int) -> DataFrame:
    """entry_id, pdb_chain_id of chains with a map in release b, of entries without any in release a."""
    old = raf_at(raf, a).select("entry_id").distinct()
    return raf_at(raf, b).join(old, "entry_id", "left_anti").select("entry_id", "pdb_chain_id").distinct()


def first_seen(nodes: DataFrame) -> DataFrame:
    """sid and the first release that has it."""
    return nodes.filter("sid is not null").groupBy("sid").agg(F.min("release_id").alias("first_release_id"))


def release_change_report(old: DataFrame, new: DataFrame, chains: DataFrame) -> DataFrame:
    """entry_id, change between two states (entry_id, release_id): obsolete, new, or updated with the chains gained or lost
    and whether their maps are the same. Entries with one release in both aren't listed. chains: release_id, chain, line."""
    both = old.withColumnRenamed("release_id", "r0").join(new.withColumnRenamed("release_id", "r1"), "entry_id", "full").filter("r0 is null or r1 is null or r0 <> r1")
    updated = both.filter("r0 is not null and r1 is not null")
    one = updated.join(chains.toDF("r0", "chain", "l0"), "r0").select("entry_id", "chain", "l0")
    two = updated.join(chains.toDF("r1", "chain", "l1"), "r1").select("entry_id", "chain", "l1")
    maps = one.join(two, ["entry_id", "chain"], "full").groupBy("entry_id").agg((F.count("l1") - F.count("l0")).alias("more"), F.bool_and(F.col("l0").eqNullSafe(F.col("l1"))).alias("same"))
    gained = F.when(F.col("more") > 0, F.concat(F.lit("updated, +"), F.col("more"), F.lit(" chains"))).when(F.col("more") < 0, F.concat(F.lit("updated, "), F.col("more"), F.lit(" chains")))
    text = F.when(F.col("r1").isNull(), "obsolete").when(F.col("r0").isNull(), "new").otherwise(F.coalesce(gained, F.when(F.col("same"), "updated, map same").otherwise("updated, map different")))
    return both.join(maps, "entry_id", "left").select("entry_id", text.alias("change"))


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """entry, state of two holdings (entry, date): new, changed, unchanged, deleted."""
    both = old.withColumnRenamed("date", "d0").join(new.withColumnRenamed("date", "d1"), "entry", "full")
    state = F.when(F.col("d0").isNull(), "new").when(F.col("d1").isNull(), "deleted").when(F.col("d0") == F.col("d1"), "unchanged").otherwise("changed")
    return both.select("entry", state.alias("state"))


#: Positions that are joined together.
SPAN = 64


def variant_to_structure(variants: DataFrame, alignments: DataFrame, residues: DataFrame, chains: DataFrame) -> DataFrame:
    """variant_id, chain_id, in_range, res_id, observed, nearest_before, nearest_after: per variant the best structure whose aligned range holds its position.

    variants: variant_id, accession, position; alignments: accession, chain_id, db_start, db_end, chain_start;
    residues: chain_id, idx, res_id, observed (the chains' maps); chains: chain_id, length, is_classified, score.
    Best: a residue in the map first, then classified chains, then observed residues, then long chains, then score, then the least chain. A
    structure whose map ends before the residue stays, as not in range. Of a residue that isn't observed, the nearest observed
    ones before and after it are named. The accession and the stretch of SPAN positions carry the join, so that a variant only
    meets ranges nearby.
    """
    ranged = alignments.filter("db_start <= db_end").withColumn("stretch", F.explode(F.sequence(F.floor(F.col("db_start") / SPAN), F.floor(F.col("db_end") / SPAN))))
    inside = variants.withColumn("stretch", F.floor(F.col("position") / SPAN)).join(ranged, ["accession", "stretch"]).filter("position between db_start and db_end")
    used = residues.join(alignments.select("chain_id").distinct(), "chain_id", "left_semi")
    seen = F.when(F.col("observed"), F.col("res_id"))
    own = Window.partitionBy("chain_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = used.withColumn("before", F.last(seen, True).over(own.orderBy("idx"))).withColumn("after", F.last(seen, True).over(own.orderBy(F.desc("idx"))))
    placed = inside.withColumn("idx", F.expr("chain_start + position - db_start")).join(near, ["chain_id", "idx"], "left").join(chains, "chain_id", "left")
    in_range, hidden = F.col("res_id").isNotNull(), ~F.coalesce("observed", F.lit(True))
    facts = ["chain_id", in_range.alias("in_range"), "res_id", F.coalesce("observed", F.lit(False)).alias("observed"), F.when(hidden, F.col("before")).alias("nearest_before"), F.when(hidden, F.col("after")).alias("nearest_after")]
    told = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0))
    order = F.struct(in_range.cast("int").alias("a"), told("is_classified").alias("b"), told("observed").alias("c"), told("length").alias("d"), F.coalesce("score", F.lit(0.0)).alias("e"), (-F.col("chain_id")).alias("f"))
    return placed.groupBy("variant_id").agg(F.max_by(F.struct(*facts), order).alias("best")).select("variant_id", "best.*")


def domain_xrefs(links: DataFrame, xrefs: DataFrame, nodes: DataFrame) -> DataFrame:
    """accession, sid of domains over their chains. links: node_id, chain_id; xrefs: chain_id, accession; nodes: id, sid."""
    return links.join(xrefs, "chain_id").join(nodes.select(F.col("id").alias("node_id"), "sid"), "node_id").select("accession", "sid").distinct()


def dictionary_encode(rows: DataFrame, dictionary: DataFrame, key_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """rows with the id of their key, and the dictionary with new keys numbered on from the largest id, nulls being equal."""
    from cladeforge.operators.tree import numbered

    def same(a: str, b: str) -> Column:
        out = F.lit(True)
        for k in key_cols:
            out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
        return out

    keys = rows.select(*key_cols).distinct()
    fresh = keys.alias("k").join(dictionary.alias("d"), same("k", "d"), "left_anti")
    top = dictionary.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).first()["top"]  # one number
    added = numbered(fresh, key_cols, "id", top + 1)
    full = dictionary.select("id", *key_cols).union(added.select("id", *key_cols))
    return rows.alias("r").join(full.alias("d"), same("r", "d"), "left").select("r.*", F.col("d.id").alias("key_id")), full


