"""License texts and notices found by the Dice coefficient over word bigrams, with DataFrame functions alone and no shuffle.

A text is normalised to lower-case words of letters and digits, whatever its lines. Units are windows of a template's number
of words (shorter at the text's ends), and the coefficient is 2 * shared / (own + template's) over distinct bigrams; own counts
out of bounds m * T / (2 - T) to m * (2 - T) / T for m bigrams of a template are dropped unseen.

A coefficient of T needs at least m * T / (2 - T) shared bigrams, so of the m + 1 less these rarest ones of a template at least one must be met: only these
are looked for in the words, and each place where one is met gives the window that begins where the template would. Texts without such places, nearly
all, go no further.

Templates of different licenses can be alike (versions, variants). A window counts for a template only if, for each template of another
license that is alike, it has a bigram that tells the two apart, and only with the bigrams of the template's own version number, so that a
version without a template gets no name instead of its neighbour's. Of windows that overlap the best one counts: that of the
largest coefficient, then of the longest template.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeforge.llm.license_texts import notices

SIMILAR = 0.8
#: Templates of other licenses from this coefficient on must be told apart.
ALIKE = 0.6
#: Templates of up to so many words need each of their version's bigrams in a window, longer ones one of them.
NOTICE = 30
#: Words that are found in any English text.
COMMON_WORDS = set("a all an and any as at be by for from in is it may not of on or other out that the this to under use with you".split())


@dataclass
class Template:
    name: str
    words: list[str]
    bigrams: list[str]  # distinct, in order
    least: int  # bounds of a window's distinct bigrams
    most: int
    anchors: list[tuple[str, int]]  # bigram, place
    apart: list[list[str]]  # of each of these lists a window has one: bigrams of the version, and such as an alike template hasn't


def bounds(n: int) -> tuple[int, int]:
    """Sizes that can be similar to one of n bigrams."""
    scaled = round(SIMILAR * 1000)
    return -(-n * scaled // (2000 - scaled)), n * (2000 - scaled) // scaled


def templates(texts: dict[str, list[str]] | None = None) -> list[Template]:
    every = []
    for name, own in sorted((texts or notices()).items()):
        for text in own:
            w = re.sub("[^a-z0-9]+", " ", text.lower()).split()
            pairs = [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]
            count, distinct = Counter(pairs), list(dict.fromkeys(pairs))
            least, most = bounds(len(distinct))
            rarest = sorted(distinct, key=lambda x: (count[x], sum(y in COMMON_WORDS for y in x.split()), -len(x), x))[: len(distinct) - least + 1]
            every.append(Template(name, w, distinct, least, most, [(x, i) for i, x in enumerate(pairs) if x in rarest], []))
    for t in every:
        numbers = [x for x in t.bigrams if any(y[0].isdigit() for y in x.split())]
        if numbers:
            t.apart += [[x] for x in numbers] if len(t.words) <= NOTICE else [numbers]
        for u in every:
            if u.name != t.name and 2 * len({*t.bigrams} & {*u.bigrams}) >= ALIKE * (len(t.bigrams) + len(u.bigrams)):
                only = [x for x in t.bigrams if x not in u.bigrams]
                if only and only not in t.apart:
                    t.apart.append(only)
    return every


def scan_licenses(docs: DataFrame, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, n_words, n_matches, licenses, best_dice of each row.

    n_matches: windows that count. licenses: their distinct names, sorted, joined by commas, '' if none. best_dice: the
    largest coefficient, 0 if none. texts: other templates by name, such as a license's full text. Null and empty texts have
    no words. Repeated rows come back repeated. Other columns are left aside.
    """
    known = templates(texts)
    at: dict[str, list[dict]] = {}
    for n, t in enumerate(known):
        for x, p in t.anchors:
            at.setdefault(x, []).append({"t": n, "p": p})
    # constants, folded when the query is planned
    places = F.from_json(F.lit(json.dumps(at)), "map<string, array<struct<t: int, p: int>>>")
    facts = F.from_json(F.lit(json.dumps([{"name": t.name, "size": len(t.words), "least": t.least, "most": t.most, "bigrams": t.bigrams, "apart": t.apart} for t in known])), "array<struct<name: string, size: int, least: int, most: int, bigrams: array<string>, apart: array<array<string>>>>")
    text = F.trim(F.lower(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), "[^A-Za-z0-9]+", " ")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(text == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(text, " ")).alias("w"))
    pairs = F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), pairs.alias("pairs"))
    rows = rows.withColumn("hits", F.filter(F.transform("pairs", lambda x, i: F.when(x.isin(list(at)), i)), lambda i: i.isNotNull()))

    def starts(i: Column) -> Column:
        return F.transform(F.element_at(places, F.get(F.col("pairs"), i)), lambda x: F.struct(x["t"].alias("t"), (i - x["p"]).alias("at")))

    def window(x: Column) -> Column:
        t = F.get(facts, x["t"])
        b, e = F.greatest(x["at"], F.lit(0)), F.least(x["at"] + t["size"], F.col("n_words").cast("int"))
        return F.struct(t.alias("t"), b.alias("b"), e.alias("e"), F.array_distinct(F.slice("pairs", b + 1, F.greatest(e - b - 1, F.lit(0)))).alias("own"))

    def match(x: Column) -> Column:
        shared = F.size(F.array_intersect(x["own"], x["t"]["bigrams"]))
        return F.struct((F.round(2.0 * shared / (F.size(x["own"]) + F.size(x["t"]["bigrams"])), 6)).alias("dice"), x["t"]["size"].alias("size"), x["t"]["name"].alias("name"), x["b"].alias("b"), x["e"].alias("e"), F.forall(x["t"]["apart"], lambda g: F.arrays_overlap(g, x["own"])).alias("told"))

    fit = F.filter(F.transform(F.array_distinct(F.flatten(F.transform("hits", starts))), window), lambda x: F.size(x["own"]).between(x["t"]["least"], x["t"]["most"]))
    every = F.filter(F.transform(fit, match), lambda m: (m["dice"] >= SIMILAR) & m["told"])
    best_first = F.array_sort(F.transform(every, lambda m: F.struct((-m["dice"]).alias("d"), (-m["size"]).alias("s"), m["name"].alias("name"), m["b"].alias("b"), m["e"].alias("e"))))
    none = F.expr("cast(array() as array<struct<d: double, s: int, name: string, b: int, e: int>>)")
    counted = F.aggregate(best_first, none, lambda kept, m: F.when(F.exists(kept, lambda k: (k["b"] < m["e"]) & (m["b"] < k["e"])), kept).otherwise(F.concat(kept, F.array(m))))
    rows = rows.select("doc_id", "n_words", F.when(F.size("hits") > 0, counted).otherwise(none).alias("found"))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("found").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda m: m["name"]))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("found", lambda m: -m["d"])), F.lit(0.0)).alias("best_dice"),
    )


def oracle() -> str:
    known = templates()
    quoted = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    facts = ", ".join(f"({n}, '{t.name}', {len(t.words)}, {t.least}, {t.most}, {quoted(t.bigrams)}, {'[' + ', '.join(map(quoted, t.apart)) + ']' if t.apart else '[]::varchar[][]'})" for n, t in enumerate(known))
    anchors = ", ".join(f"('{x}', {n}, {p})" for n, t in enumerate(known) for x, p in t.anchors)
    return f"""
with facts(t, name, size, least, most, bigrams, apart) as (values {facts}), anchors(pair, t, p) as (values {anchors}),
d as (select row_number() over () as r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') as w from documents),
g as (select r, len(w) as n, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) as pairs from d),
h as (select r, n, pairs, unnest(pairs) as pair, unnest(range(0, len(pairs))) as i from g),
c as (select distinct h.r, a.t, i - p as spot from h join anchors a using (pair)),
x as (select c.r, f.*, greatest(spot, 0) as b, least(spot + size, n) as e, list_distinct(pairs[greatest(spot, 0) + 1:least(spot + size, n) - 1]) as own from c join facts f using (t) join g on g.r = c.r),
m as (select r, name, size, b, e, round(2.0 * len(list_intersect(bigrams, own)) / (len(bigrams) + len(own)), 6) as dice from x where len(own) between least and most and len(list_filter(apart, lambda a: not list_has_any(a, own))) = 0),
o as (select r, list({{'d': -dice, 's': -size, 'name': name, 'b': b, 'e': e}} order by -dice, -size, name, b, e) as found from m where dice >= {SIMILAR} group by r),
k as (select r, list_reduce(list_transform(found, lambda y: [y]), lambda kept, y: case when len(list_filter(kept, lambda z: z.b < y[1].e and y[1].b < z.e)) > 0 then kept else list_concat(kept, y) end) as found from o)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(found), 0) as bigint) as n_matches, coalesce(array_to_string(list_sort(list_distinct(list_transform(found, lambda y: y.name))), ','), '') as licenses,
       coalesce(cast(list_max(list_transform(found, lambda y: -y.d)) as double), 0) as best_dice
from d left join k using (r)"""
