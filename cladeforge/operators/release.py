"""Identifiers carried from one release to the next, and audits of a release."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.operators.tree import numbered
from cladeforge.sources.scratch import kept, written

SUFFIXES = "123456789abcdefghijklmnopqrstuvwxyz"
#: Missing numbers of which one row is made at once; longer stretches are cut.
STRETCH = 100_000


def _regions(domains: DataFrame, prefix: str) -> DataFrame:
    """code, id, one row a region with chain, start, end (null for a whole chain) and their number."""
    parts = F.split(F.substring_index("description", " ", -1), ",")
    rows = domains.select(F.substring_index("description", " ", 1).alias("code"), F.col("id").alias(f"{prefix}_id"), F.size(parts).alias(f"{prefix}_n"), F.posexplode(parts).alias(f"{prefix}_i", "part"))
    bounds = F.regexp_extract("part", r"^(?:.*:)?(-?\d+)\D?-(-?\d+)\D?$", 1), F.regexp_extract("part", r"^(?:.*:)?(-?\d+)\D?-(-?\d+)\D?$", 2)
    return rows.select("code", f"{prefix}_id", f"{prefix}_n", f"{prefix}_i", F.upper(F.when(F.col("part").contains(":"), F.substring_index("part", ":", 1)).otherwise("")).alias(f"{prefix}_chain"), *(F.nullif(b, F.lit("")).cast("int").alias(f"{prefix}_{k}") for b, k in zip(bounds, ("start", "end"), strict=True)))


def match_domains(old: DataFrame, new: DataFrame, lengths: DataFrame) -> DataFrame:
    """old_id, new_id, kind (exact, perfect, overlap), overlap of domains (id, description) that may be one.

    Equal texts are exact. Others of one code are compared region by region: near if either is a whole chain, both ends are within
    50, or one is equal and the other within 75. All regions near in order: perfect. Otherwise overlap, if residues are shared. lengths:
    code, chain, length of the maps (a whole chain without a map isn't near and has no overlap).
    """
    exact = old.join(new.select(F.col("id").alias("new_id"), "description"), "description").select(F.col("id").alias("old_id"), "new_id")
    left = old.join(exact.select(F.col("old_id").alias("id")), "id", "left_anti")
    right = new.join(exact.select(F.col("new_id").alias("id")), "id", "left_anti")
    size = lengths.select("code", F.upper("chain").alias("o_chain"), F.col("length").alias("known"))
    pairs = _regions(left, "o").join(_regions(right, "w"), "code").filter((F.col("o_chain") == F.col("w_chain")) | ((F.col("w_chain") == "A") & (F.col("o_chain") == "")))
    pairs = pairs.join(size, ["code", "o_chain"], "left")
    o_whole, w_whole = F.col("o_start").isNull(), F.col("w_start").isNull()
    d1, d2 = F.abs(F.col("o_start") - F.col("w_start")), F.abs(F.col("o_end") - F.col("w_end"))
    close = ((d1 < 50) & (d2 < 50)) | ((d1 == 0) & (d2 < 75)) | ((d2 == 0) & (d1 < 75))
    near = F.coalesce(F.when(o_whole | w_whole, F.col("known").isNotNull()).otherwise(close), F.lit(False))
    span = lambda k: F.col(f"{k}_end") - F.col(f"{k}_start") + 1
    inner = F.greatest(F.least("o_end", "w_end") - F.greatest("o_start", "w_start") + 1, F.lit(0))
    shared = F.when(o_whole & w_whole, F.coalesce("known", F.lit(0)) * 0 + 1).when(o_whole, F.when(F.col("known").isNotNull(), span("w"))).when(w_whole, F.when(F.col("known").isNotNull(), span("o"))).otherwise(inner)
    rows = pairs.withColumn("good", near & (F.col("o_i") == F.col("w_i"))).withColumn("shared", F.coalesce(shared, F.lit(0)))
    met = rows.groupBy("o_id", "w_id").agg(F.sum(F.col("good").cast("int")).alias("n"), F.max("o_n").alias("o_n"), F.max("w_n").alias("w_n"), F.sum("shared").alias("overlap"))
    kind = F.when((F.col("n") == F.col("o_n")) & (F.col("o_n") == F.col("w_n")), "perfect").when(F.col("overlap") > 0, "overlap")
    others = met.select(F.col("o_id").alias("old_id"), F.col("w_id").alias("new_id"), kind.alias("kind"), F.col("overlap").cast("long").alias("overlap")).filter("kind is not null")
    return exact.select("old_id", "new_id", F.lit("exact").alias("kind"), F.lit(0).cast("long").alias("overlap")).union(others)


def classify_changes(matches: DataFrame, old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new_id, old_id whose sid is kept, or null) of each new domain, and history (old_id, new_id, change_type).

    In order: exact text keeps. An old one with several new ones that have only it is split (5), a new one with several old
    ones that have only it is a merge (4). Of perfect matches, most overlap first, of one kind: kept (7 if the text changed);
    whole to region 7 and region to whole 10 get new sids. The rest is modified (7); what is left of old is obsolete, by
    the kind of its text (1 for s..., 3 for 0..., else 2). Each pair is ranked from both sides, so no order of rows counts.
    """
    exact = matches.filter("kind = 'exact'")
    rest = matches.filter("kind <> 'exact'")
    by_old = rest.groupBy("old_id").agg(F.count("*").alias("n_new"))
    by_new = rest.groupBy("new_id").agg(F.count("*").alias("n_old"))
    rows = rest.join(by_old, "old_id").join(by_new, "new_id")
    per_old = rows.groupBy("old_id").agg(F.max("n_old").alias("most_old"))
    per_new = rows.groupBy("new_id").agg(F.max("n_new").alias("most_new"))
    rows = rows.join(per_old, "old_id").join(per_new, "new_id")
    split = (F.col("n_new") > 1) & (F.col("most_old") == 1)
    merge = (F.col("n_old") > 1) & (F.col("most_new") == 1)
    whole = lambda d, k: d.select(F.col("id").alias(f"{k}_id"), F.col("description").rlike(r":(,|$)|-$").alias(f"{k}_whole"))
    rows = rows.withColumn("type", F.when(split, 5).when(merge, 4)).join(whole(old, "old"), "old_id").join(whole(new, "new"), "new_id")
    order = F.struct(-F.col("overlap"), "old_id", "new_id")
    open_ = F.when(F.col("type").isNull() & (F.col("kind") == "perfect"), order)
    rows = rows.withColumn("best_new", F.min(open_).over(Window.partitionBy("old_id"))).withColumn("best_old", F.min(open_).over(Window.partitionBy("new_id")))
    mutual = open_.isNotNull() & (order == F.col("best_new")) & (order == F.col("best_old"))
    stays = mutual & (F.col("old_whole") == F.col("new_whole"))
    kind = F.coalesce("type", F.when(mutual & ~F.col("old_whole") & F.col("new_whole"), 10).otherwise(7))
    history = rows.select("old_id", "new_id", kind.alias("change_type"))
    text = F.when(F.col("description").startswith("s"), 1).when(F.col("description").startswith("0"), 3).otherwise(2)
    gone = old.join(matches.select(F.col("old_id").alias("id")).distinct(), "id", "left_anti").select(F.col("id").alias("old_id"), F.lit(None).cast("long").alias("new_id"), text.alias("change_type"))
    keeps = exact.select("new_id", "old_id").union(rows.filter(stays).select("new_id", "old_id")).groupBy("new_id").agg(F.min("old_id").alias("old_id"))
    assigned = new.select(F.col("id").alias("new_id")).join(keeps, "new_id", "left")
    return assigned, history.union(gone)


def allocate_sids(new: DataFrame, used: DataFrame) -> DataFrame:
    """id, sid of new domains (id, code, chain, is_whole, is_multi): `_` for a whole chain, else the next free suffixes of code and
    chain, by id; `.` for the chain of several. used: sid, those ever given, which are never given again.

    Free suffixes and domains are ranked within code and chain, and equal ranks meet. Null where all 35 are taken.
    """
    stem = F.concat(F.lit("d"), F.lower("code"), F.when(F.col("is_multi"), ".").otherwise(F.lower("chain")))
    rows = new.select("id", stem.alias("stem"), (F.col("is_whole") & ~F.col("is_multi")).alias("whole"))
    whole = rows.filter("whole").groupBy("stem").agg(F.min("id").alias("id")).select("id", F.concat("stem", F.lit("_")).alias("sid")).join(used.select("sid"), "sid", "left_anti").select("id", "sid")
    others = rows.join(whole.select("id"), "id", "left_anti")
    tried = others.select("stem").distinct().select("stem", F.posexplode(F.array(*map(F.lit, SUFFIXES))).alias("at", "suffix")).withColumn("sid", F.concat("stem", "suffix"))
    free = tried.join(used.select("sid").distinct(), "sid", "left_anti").withColumn("rank", F.row_number().over(Window.partitionBy("stem").orderBy("at")))
    ranked = others.withColumn("rank", F.row_number().over(Window.partitionBy("stem").orderBy("id")))
    return whole.union(ranked.join(free, ["stem", "rank"], "left").select("id", "sid"))


def stable_domain_ids(old: DataFrame, new: DataFrame, carried: DataFrame) -> DataFrame:
    """id, sunid of new domains (id, sid): that of the old one with the sid, or of the one it is carried from (old_sid, new_sid); the
    rest gets numbers on from the largest, those of codes known before first, by sid. old: sid, sunid."""
    same = new.join(old, "sid").select("id", "sunid")
    moved = new.join(same.select("id"), "id", "left_anti").join(carried.withColumnRenamed("new_sid", "sid"), "sid").join(old.withColumnRenamed("sid", "old_sid"), "old_sid").groupBy("id").agg(F.min("sunid").alias("sunid"))
    known = same.union(moved)
    codes = old.select(F.substring("sid", 2, 4).alias("code")).distinct().withColumn("seen", F.lit(0))
    fresh = new.join(known.select("id"), "id", "left_anti").withColumn("code", F.substring("sid", 2, 4)).join(codes, "code", "left").select("id", "sid", F.coalesce("seen", F.lit(1)).alias("unseen"))
    top = old.agg(F.coalesce(F.max("sunid"), F.lit(0)).alias("top")).first()["top"]  # one number
    return known.union(numbered(fresh, ["unseen", "sid", "id"], "sunid", top + 1).select("id", F.col("sunid").cast("long")))


def stable_clade_ids(old: DataFrame, new: DataFrame, history: DataFrame, levels: tuple[int, ...] = (2, 3, 4, 5, 6, 7)) -> DataFrame:
    """id, sunid of new nodes above domains, level by level: split or moved ones (history: new_node_id, change_type 5 or 6) get numbers on; one
    with the text of an old node under the parent of that sunid keeps its sunid; one that has a sunid (above 0) keeps that; others get
    numbers on, by id. old, new: id, sunid, description, level_id, parent_node_id, root at level 1. Of siblings with one text, that of
    the largest id counts, as in check_ids."""
    top = old.select("sunid").union(new.select("sunid")).agg(F.max("sunid").alias("top")).first()["top"]  # one number
    parents = old.select(F.col("id").alias("parent_node_id"), F.col("sunid").alias("parent_sunid"))
    earlier = old.join(parents, "parent_node_id").groupBy("level_id", "parent_sunid", "description").agg(F.max_by("sunid", "id").alias("same_text"))
    remade = history.filter("change_type in (5, 6)").select(F.col("new_node_id").alias("id"), F.lit(True).alias("remade")).distinct()
    done = new.filter("level_id = 1").select("id", F.lit(0).cast("long").alias("sunid"))
    above = done
    for level in levels:
        own = new.filter(F.col("level_id") == level).select("id", "level_id", "parent_node_id", "description", F.col("sunid").alias("given"))
        own = own.join(above.toDF("parent_node_id", "parent_sunid"), "parent_node_id").join(remade, "id", "left")
        met = own.join(earlier, ["level_id", "parent_sunid", "description"], "left")
        met = met.join(own.groupBy("parent_sunid", "description").agg(F.max("id").alias("id")).select("id", F.lit(True).alias("last")), "id", "left")
        sunid = F.when(F.col("remade").isNull(), F.coalesce(F.when(F.col("last"), F.col("same_text")), F.when(F.col("given") > 0, F.col("given"))))
        met = kept(met.select("id", F.coalesce("remade", F.lit(False)).alias("remade"), sunid.alias("sunid")))
        fresh = numbered(met.filter("sunid is null").select("id", (~F.col("remade")).alias("late")), ["late", "id"], "sunid", top + 1).select("id", F.col("sunid").cast("long"))
        above = kept(met.filter("sunid is not null").select("id", "sunid").union(fresh))
        top = max(top, above.agg(F.max("sunid").alias("m")).first()["m"] or top)
        done = done.union(above)
    return done


def stable_sccs(old: DataFrame, new: DataFrame, every: DataFrame, history: DataFrame, levels: tuple[int, ...] = (3, 4, 5, 6, 7, 8)) -> tuple[DataFrame, DataFrame]:
    """id, sccs of new nodes from level 2 down, and history (old_node_id, new_node_id, change_type 6) of those found under another class string than before.

    Down to level 5 a node keeps its class string by sunid; others get the parent's with the next number ever, by id, `.0` for automated matches, and
    `l` for the class of artifacts; null where a class or parent has none. Below, a node has its parent's. A node whose old string isn't that of its parent is told to have moved, unless history
    (new_node_id, change_type) has that. old: id, sunid, sccs of the release before; every: sccs of all releases; new: id, sunid, level_id, parent_node_id, description.
    """
    # what every level asks for is worked out once
    known = written(old.groupBy("sunid").agg(F.min_by(F.struct(F.col("sccs").alias("kept"), F.col("id").alias("old_node_id")), "id").alias("k")).select("sunid", "k.*"))
    new = written(new.select("id", "sunid", "level_id", "parent_node_id", "description"))
    number = F.element_at(F.split("sccs", r"\."), -1).try_cast("int")
    largest = written(every.filter(F.col("sccs").contains(".")).select(F.regexp_replace("sccs", r"\.\d+$", "").alias("parent_sccs"), number.alias("n")).groupBy("parent_sccs").agg(F.max("n").alias("largest")))
    above = new.filter("level_id = 2").join(known, "sunid", "left").select("id", F.coalesce("kept", F.when(F.col("description") == "Artifacts", "l")).alias("sccs"))
    done, moved = above, []
    for level in levels:
        own = new.filter(F.col("level_id") == level).join(above.toDF("parent_node_id", "parent_sccs"), "parent_node_id").join(known, "sunid", "left")
        stem = F.col("kept") if level > 5 else F.regexp_replace("kept", r"\.[^.]*$", "")
        moved.append(own.filter(stem != F.col("parent_sccs")).select("old_node_id", F.col("id").alias("new_node_id"), F.lit(6).alias("change_type")))
        if level > 5:
            above = written(own.select("id", F.col("parent_sccs").alias("sccs")))
        else:
            own = own.withColumn("sccs", F.coalesce("kept", F.when(F.col("description") == "automated matches", F.concat("parent_sccs", F.lit(".0")))))
            fresh = written(numbered(own.filter("sccs is null and parent_sccs is not null").select("parent_sccs", "id"), ["parent_sccs", "id"], "at"))
            begin = fresh.groupBy("parent_sccs").agg(F.min("at").alias("begin"))
            fresh = fresh.join(begin, "parent_sccs").join(largest, "parent_sccs", "left").select("id", F.concat("parent_sccs", F.lit("."), F.coalesce("largest", F.lit(0)) + 1 + F.col("at") - F.col("begin")).alias("sccs"))
            above = written(own.filter("sccs is not null or parent_sccs is null").select("id", "sccs").union(fresh))
        done = done.union(above)
    told = history.filter("change_type = 6").select("new_node_id").distinct()
    return done, reduce(DataFrame.union, moved).join(told, "new_node_id", "left_anti").select("old_node_id", "new_node_id", "change_type")


def next_release_node(nodes: DataFrame) -> DataFrame:
    """id, next_id, sccs_stable of nodes that are there in the next release too. nodes: id, sunid, sccs, release_id."""
    later = nodes.select("sunid", (F.col("release_id") - 1).alias("release_id"), F.col("id").alias("next_id"), F.col("sccs").alias("later"))
    return nodes.join(later, ["sunid", "release_id"]).select("id", "next_id", (F.col("sccs") == F.col("later")).alias("sccs_stable"))


def gaps(numbers: DataFrame, column: str) -> DataFrame:
    """first, last of the stretches of whole numbers between the least and the largest of a column that it doesn't have.

    Numbers are dealt by range; within a part each looks at the next, and a part's last one at the first of the part after it, which comes
    from one row a part. A stretch is one row, however long.
    """
    own = numbers.select(F.col(column).alias("n")).filter("n is not null").distinct()
    dealt = written(own.repartitionByRange("n").withColumn("part", F.spark_partition_id()))
    firsts = dealt.groupBy("part").agg(F.min("n").alias("first")).select("part", F.lead("first").over(Window.orderBy("part")).alias("after"))  # one row a part
    rows = dealt.join(F.broadcast(firsts), "part").withColumn("next", F.coalesce(F.lead("n").over(Window.partitionBy("part").orderBy("n")), "after"))
    return rows.filter("next > n + 1").select((F.col("n") + 1).alias("first"), (F.col("next") - 1).alias("last"))


def check_ids(old: DataFrame, new: DataFrame, history: DataFrame) -> DataFrame:
    """issue, key (sunid or what is used twice) of a new release against the one before it.

    sid-changed: another sid without history of both nodes by types 4 to 11; should-be-retired: kept in spite of a split or of types 7 or 8 (without
    11); lost: gone without types 1 to 9 or 13; bogus-merge: merged (4), but the node with its text under the same parent has another sunid;
    skipped: each number above all old ones, up to the largest new one, that no node has; sid-twice, sunid-twice, sccs-twice (levels 2 to 5); sccs-strange, without a dot;
    sccs-parent, not the parent's; zero-rule: automated matches of level 5 that aren't the parent's `.0`; same-text, siblings with one text.

    old, new: id, sunid, sid, sccs, description, level_id, parent_node_id; history: old_node_id, new_node_id, change_type.
    """

    def told(keys: list[str], **types: tuple[int, ...]) -> DataFrame:
        return history.groupBy(*keys).agg(*(F.bool_or(F.col("change_type").isin(*t)).alias(n) for n, t in types.items()))

    def found(rows: DataFrame, issue: str, key: str = "sunid") -> DataFrame:
        return rows.select(F.lit(issue).alias("issue"), F.col(key).cast("string").alias("key"))

    old, new, history = (written(x) for x in (old, new, history))  # each is read by many of the parts
    was = old.select("sunid", F.col("id").alias("old_node_id"), F.col("sid").alias("old_sid"))
    both = new.select("sunid", F.col("id").alias("new_node_id"), "sid", "level_id").join(was, "sunid").join(told(["old_node_id", "new_node_id"], excused=(4, 5, 6, 7, 8, 9, 10, 11), retires=(5, 7, 8), tagged=(11,)), ["old_node_id", "new_node_id"], "left")
    gone = old.join(new.select("sunid"), "sunid", "left_anti").join(told(["old_node_id"], ended=(1, 2, 3, 4, 5, 6, 7, 8, 9, 13)).withColumnRenamed("old_node_id", "id"), "id", "left")
    parts = [
        found(both.filter("level_id = 8 and old_sid is not null and not coalesce(excused, false) and not (old_sid <=> sid)"), "sid-changed"),
        found(both.filter("retires and not tagged"), "should-be-retired"),
        found(gone.filter("not coalesce(ended, false)"), "lost"),
    ]
    merged = old.join(history.filter("change_type = 4").select(F.col("old_node_id").alias("id")).distinct(), "id", "left_semi")
    up_old, up_new = old.select(F.col("id").alias("parent_node_id"), F.col("sunid").alias("up")), new.select(F.col("id").alias("parent_node_id"), F.col("sunid").alias("up"))
    named = new.join(up_new, "parent_node_id").groupBy("up", "description").agg(F.max_by("sunid", "id").alias("new_sunid"))
    parts.append(found(merged.join(up_old, "parent_node_id").join(named, ["up", "description"]).filter("new_sunid <> sunid"), "bogus-merge"))
    top = old.agg(F.coalesce(F.max("sunid"), F.lit(0)).cast("long").alias("sunid"))
    missing = gaps(new.join(F.broadcast(top.withColumnRenamed("sunid", "top")), F.col("sunid") > F.col("top")).select("sunid").union(top), "sunid")
    # long stretches are cut before they are written out, so that they are no single task's
    cut = missing.select(F.explode(F.sequence("first", "last", F.lit(STRETCH).cast("long"))).alias("first"), "last").repartition("first")
    parts.append(found(cut.select(F.explode(F.sequence("first", F.least(F.col("first") + (STRETCH - 1), "last"))).alias("sunid")), "skipped"))
    for column, name, rows in (("sid", "sid-twice", new.filter("sid is not null")), ("sunid", "sunid-twice", new), ("sccs", "sccs-twice", new.filter("level_id between 2 and 5"))):
        parts.append(found(rows.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1"), name, column))
    own = new.filter("level_id > 2").join(new.select(F.col("id").alias("parent_node_id"), F.col("sccs").alias("above")), "parent_node_id")
    parts.append(found(own.filter("level_id < 6 and not contains(sccs, '.')"), "sccs-strange"))
    parts.append(found(own.filter(F.when(F.col("level_id") > 5, F.col("sccs")).otherwise(F.regexp_replace("sccs", r"\.[^.]*$", "")) != F.col("above")), "sccs-parent"))
    parts.append(found(own.filter("level_id = 5 and description = 'automated matches' and sccs <> above || '.0'"), "zero-rule"))
    parts.append(found(new.filter("parent_node_id is not null").groupBy("parent_node_id", "level_id", "description").agg(F.count("*").alias("n"), F.min("sunid").alias("sunid")).filter("n > 1"), "same-text"))
    return reduce(DataFrame.union, parts)


def change_summary(old: DataFrame, new: DataFrame, history: DataFrame) -> DataFrame:
    """category, curation, n of the old release's domains, without those that history ends (types 1 to 3).

    Of each domain, by its sunid, two things are told. Its change: unchanged (text and sid), major (gone), region-to-chain (a new
    sid that ends in `_`, the same sequence), minor (such a sid with another sequence, or the old sid with another one), silent (old sid, old
    sequence), other-sid (any other new sid). Its place, unless it is gone: unmoved (parent and grandparent have the old sunids), else moved,
    of automatic ones moved-overly-specific where the new grandparent is "automated matches", and moved-incorrect.
    Curation is the old node's: curated (1), automatic, or all where it doesn't count.

    old, new: id, sunid, sid, description, curation_type_id, level_id, parent_node_id, seq_id, all nodes; history: old_node_id, change_type.
    """

    def placed(nodes: DataFrame, tag: str) -> DataFrame:
        up = nodes.select(F.col("id").alias("parent_node_id"), F.col("sunid").alias("up"), F.col("parent_node_id").alias("grand_id"))
        grand = nodes.select(F.col("id").alias("grand_id"), F.col("sunid").alias("grand"), F.col("description").alias("grand_text"))
        own = nodes.filter("level_id = 8").select("id", "sunid", "sid", "description", "curation_type_id", "seq_id", "parent_node_id")
        rows = own.join(up, "parent_node_id", "left").join(grand, "grand_id", "left")
        return rows.select("sunid", *(F.col(c).alias(f"{tag}_{c}") for c in ("id", "sid", "description", "curation_type_id", "seq_id", "up", "grand", "grand_text")))

    ended = history.filter("change_type in (1, 2, 3)").select(F.col("old_node_id").alias("old_id")).distinct()
    rows = placed(old, "old").join(ended, "old_id", "left_anti").join(placed(new, "new"), "sunid", "left")
    same = lambda c: F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    there, curated = F.col("new_id").isNotNull(), F.coalesce(F.col("old_curation_type_id") == 1, F.lit(False))
    whose = F.when(curated, "curated").otherwise("automatic")
    change = (
        F.when(there & same("description") & same("sid"), "unchanged")
        .when(~there, "major")
        .when(~same("sid") & F.endswith("new_sid", F.lit("_")), F.when(same("seq_id"), "region-to-chain").otherwise("minor"))
        .when(~same("sid"), "other-sid")
        .when(same("seq_id"), "silent")
        .otherwise("minor")
    )
    place = F.when(same("up") & same("grand"), "unmoved").when(curated, "moved").when(F.col("new_grand_text") == "automated matches", "moved-overly-specific").otherwise("moved-incorrect")
    told = F.array_compact(F.array(change, F.when(there, place)))
    each = rows.select(whose.alias("whose"), F.explode(told).alias("category"))
    by = F.when(F.col("category").isin("major", "minor") | F.startswith("category", F.lit("moved")), F.col("whose")).otherwise("all")
    return each.select("category", by.alias("curation")).groupBy("category", "curation").agg(F.count("*").alias("n"))


def check_representatives(reps: DataFrame, closed: DataFrame, nodes: DataFrame, levels: tuple[int, ...] = (2, 3, 4, 5, 6, 7)) -> DataFrame:
    """issue, level_node_id: missing, duplicate, not-ancestor, wrong-level of reps (level_node_id, rep_node_id)."""
    wanted = closed.filter(F.col("ancestor_level").isin(*levels)).join(nodes.filter("level_id = 8").select(F.col("id").alias("node_id")), "node_id", "left_semi").select(F.col("ancestor_id").alias("level_node_id")).distinct()
    missing = wanted.join(reps, "level_node_id", "left_anti").select(F.lit("missing").alias("issue"), "level_node_id")
    twice = reps.groupBy("level_node_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.lit("duplicate"), "level_node_id")
    above = closed.filter("depth > 0").select(F.col("node_id").alias("rep_node_id"), F.col("ancestor_id").alias("level_node_id"))
    stray = reps.join(above, ["rep_node_id", "level_node_id"], "left_anti").select(F.lit("not-ancestor"), "level_node_id")
    low = reps.join(nodes.select(F.col("id").alias("rep_node_id"), "level_id"), "rep_node_id").filter("level_id <> 8").select(F.lit("wrong-level"), "level_node_id")
    return missing.union(twice).union(stray).union(low)


def check_promoted(nodes: DataFrame, rules: dict[str, DataFrame], parents: DataFrame) -> DataFrame:
    """issue, id of new automatic domains (id, parent_node_id) that lack a row in a rule's table (node_id), or a parent (id)."""
    parts = [nodes.join(have.select(F.col("node_id").alias("id")).distinct(), "id", "left_anti").select(F.lit(f"no-{name}").alias("issue"), "id") for name, have in rules.items()]
    parts.append(nodes.join(parents.select(F.col("id").alias("parent_node_id")), "parent_node_id", "left_anti").select(F.lit("no-parent").alias("issue"), "id"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def apply_edits(nodes: DataFrame, edits: DataFrame, closed: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes after a set of edits, and history (old_node_id, new_node_id, change_type) of those that the release before has by sunid.

    edits: kind, node_id, target_id, text. delete: the node goes with all below it (2). move: to a parent one level above only; from level 6 on, it and all
    below take the parent's class string, above that one that doesn't begin with the parent's is emptied, on all below too; told (6) only if the parent's sunid
    is another than before. merge: into a node of the same level, which gets the children (4). split: into targets made here with their texts, without
    sunid; the least one gets the children (5). edit: another description. Targets are nodes that stay. before: id, sunid, parent_node_id.
    """
    ids = lambda k: edits.filter(F.col("kind") == k)
    facts = nodes.select("id", "level_id", "sccs", "sunid")
    own, up = facts.toDF("node_id", "own_level", "own_sccs", "sunid"), facts.toDF("target_id", "up_level", "up_sccs", "target_sunid")
    gone = closed.join(ids("delete").select(F.col("node_id").alias("ancestor_id")), "ancestor_id", "left_semi").select(F.col("node_id").alias("id")).distinct()
    named = edits.select("kind", "node_id", "target_id").join(own, "node_id").join(up, "target_id")
    moves = named.filter("kind = 'move' and own_level = up_level + 1").join(nodes.select(F.col("id").alias("node_id"), "parent_node_id"), "node_id").filter("parent_node_id <> target_id")
    merges = named.filter("kind = 'merge' and own_level = up_level")
    splits = ids("split").select("node_id", "target_id", "text").join(own, "node_id")
    adopted = merges.select("node_id", "target_id").union(splits.groupBy("node_id").agg(F.min("target_id"))).toDF("parent_node_id", "adopted_by")
    ended = reduce(DataFrame.union, [gone, merges.select("node_id"), splits.select("node_id")]).distinct()
    string = moves.withColumn("given", F.when(F.col("own_level") > 5, F.col("up_sccs")).when(~F.startswith("own_sccs", F.concat("up_sccs", F.lit("."))), F.lit(""))).filter("given is not null")
    below = closed.join(string.select(F.col("node_id").alias("ancestor_id"), "given"), "ancestor_id").groupBy(F.col("node_id").alias("id")).agg(F.min_by("given", "depth").alias("given"))
    rows = nodes.join(ended, "id", "left_anti").join(moves.select(F.col("node_id").alias("id"), F.col("target_id").alias("moved_to")), "id", "left").join(adopted, "parent_node_id", "left").join(below, "id", "left")
    rows = rows.join(ids("edit").select(F.col("node_id").alias("id"), F.regexp_replace("text", r"\[TaxId:(?! )", "[TaxId: ").alias("text")), "id", "left")
    changed = {"parent_node_id": F.coalesce("moved_to", "adopted_by", "parent_node_id"), "sccs": F.coalesce("given", "sccs"), "description": F.coalesce("text", "description")}
    made = nodes.join(splits.select(F.col("node_id").alias("id"), "target_id", "text"), "id")
    fresh = {"id": F.col("target_id"), "sunid": F.lit(0).cast("long"), "sid": F.lit(None).cast("string"), "description": F.col("text")}
    out = rows.select(*(changed.get(c, F.col(c)).alias(c) for c in nodes.columns)).union(made.select(*(fresh.get(c, F.col(c)).alias(c) for c in nodes.columns)))
    ups = before.select(F.col("id").alias("parent_node_id"), F.col("sunid").alias("old_up"))
    was = before.filter("sunid > 0").join(ups, "parent_node_id", "left").select("sunid", F.col("id").alias("old_node_id"), "old_up")
    told = lambda d, new, kind: d.join(was, "sunid").select("old_node_id", new.alias("new_node_id"), F.lit(kind).alias("change_type"))
    moved = moves.join(was, "sunid").filter("not (old_up <=> target_sunid)").select("old_node_id", F.col("node_id").alias("new_node_id"), F.lit(6).alias("change_type"))
    lost = told(nodes.select("id", "sunid").join(gone, "id", "left_semi"), F.lit(None).cast("long"), 2)
    return out, lost.union(moved).union(told(merges, F.col("target_id"), 4)).union(told(splits, F.col("target_id"), 5))


def edit_comments(comments: DataFrame, edits: DataFrame) -> DataFrame:
    """comments (node_id, description, is_auto) after edits (kind, node_id, text): `remove` takes those of the node that begin with the text, `add` then
    adds it unless it is there; one that begins with "automat" is automatic."""
    prefixes = edits.filter("kind = 'remove'").select(F.col("node_id").alias("n"), "text").distinct()
    left = comments.join(prefixes, (F.col("node_id") == F.col("n")) & F.startswith("description", "text"), "left_anti").select("node_id", "description", "is_auto")
    added = edits.filter("kind = 'add'").select("node_id", F.col("text").alias("description")).distinct().join(left, ["node_id", "description"], "left_anti")
    return left.union(added.select("node_id", "description", F.startswith("description", F.lit("automat")).cast("int")))


def propagate_inconsistent(flags: DataFrame, closed: DataFrame, nodes: DataFrame) -> DataFrame:
    """node_id of all domains at or below flagged nodes (node_id)."""
    below = closed.join(flags.select(F.col("node_id").alias("ancestor_id")), "ancestor_id", "left_semi").select("node_id").distinct()
    return below.join(nodes.filter("level_id = 8").select(F.col("id").alias("node_id")), "node_id", "left_semi")


