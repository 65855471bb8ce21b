"""Quality rules with DataFrame functions alone: base counts, and divergence from the corpus's languages.

A document's shares of seven character classes, and of common words against all others, are compared with the shares of
each language's documents together. Its Jensen-Shannon distance (base 2) to the nearest language must not be above a limit.
Short texts have uneven shares by chance alone, so each distance counts from a least length on.

Repeated three-word windows are found within a row by sorting their hashes; nothing is shuffled but one small sum a language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeforge.llm.common import checkpointed

SPACE = "\\x20\\x09-\\x0D"
#: Usual words of some languages.
COMMON = ["the", "of", "and", "to", "in", "is", "de", "la", "le", "et", "les", "des", "der", "die", "und", "den", "das", "el", "que", "y", "en", "los"]
#: Character classes after a-z and white space, in this order; what is left is the last class.
CLASSES = {"upper": "A-Z", "digits": "0-9", "marks": ".,;:!?'\"()\\-", "symbols": "#*$%&|<>/\\\\@\\[\\]{}=+^~`_"}
CHAR_LIMIT, CHAR_LEAST = 0.28, 200
WORD_LIMIT, WORD_LEAST = 0.22, 150
#: Languages whose documents together have fewer words have no reference.
REFERENCE_WORDS = 1_000


def _gone(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, f"[{pattern}]+", "")


def _repeated(words: Column) -> Column:
    """Number of words in three-word windows that occur twice or more."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    rest = F.size(words) - 2
    windows = F.when(rest > 0, F.zip_with(F.slice(F.arrays_zip(hashes.alias("a"), F.slice(hashes, 2, F.greatest(F.size(words), F.lit(1))).alias("b"), F.slice(hashes, 3, F.greatest(F.size(words), F.lit(1))).alias("c")), F.lit(1), F.greatest(rest, F.lit(1))), F.sequence(F.lit(0), F.greatest(rest - 1, F.lit(0))), lambda x, i: F.struct(F.xxhash64(x).alias("h"), i.alias("i"))))
    return F.sort_array(windows)


def features(docs: DataFrame) -> DataFrame:
    """Of each row: its counts of words, of the base rules, of character classes and of common words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    rows = rows.select("doc_id", "lang", F.length("text").alias("chars"), F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != "").alias("words"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"), _gone(F.col("text"), "a-z").alias("t1"))
    rows = rows.withColumn("t2", _gone(F.col("t1"), SPACE)).withColumn("lower", F.col("chars") - F.length("t1")).withColumn("spaces", F.length("t1") - F.length("t2"))
    left = F.col("t2")
    counts = []
    for name, pattern in CLASSES.items():
        counts.append((F.length(left) - F.length(_gone(left, pattern))).alias(name))
    folded = F.filter(F.transform("words", lambda w: F.lower(w)), lambda w: w.isin(COMMON))
    rows = rows.select("doc_id", "lang", "words", "n_dup_lines", "chars", "lower", "spaces", *counts, (F.length("t2") - F.length(_gone(left, "#*$%&|<>"))).alias("n_symbols"), folded.alias("common"), _repeated(F.col("words")).alias("sorted"))
    rows = rows.withColumn("others", F.col("chars") - F.col("lower") - F.col("spaces") - sum((F.col(k) for k in CLASSES), F.lit(0)))
    same = lambda a, b: a["h"] == b["h"]
    size = F.greatest(F.size("sorted"), F.lit(1))
    ahead = F.zip_with("sorted", F.slice("sorted", 2, size), lambda a, b: F.coalesce(same(a, b), F.lit(False)))
    rows = rows.withColumn("ahead", ahead)
    # a window is repeated if its hash is that of the next in order or of the one before
    either = F.zip_with("ahead", F.concat(F.array(F.lit(False)), F.slice("ahead", 1, size)), lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)))
    at = F.sort_array(F.transform(F.filter(F.zip_with("sorted", either, lambda x, e: F.when(e, x["i"])), lambda i: i.isNotNull()), lambda i: i))
    rows = rows.withColumn("at", at)
    gaps = F.zip_with("at", F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    rows = rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0), lambda s, x: s + x), F.lit(0)))
    return rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        (F.col("chars") - F.col("spaces")).cast("long").alias("word_chars"),
        *(F.col(k).cast("long").alias(k) for k in ("n_symbols", "n_dup_lines", "n_repeat_words")),
        F.array(*(F.col(k).cast("long") for k in ("lower", "spaces", *CLASSES, "others"))).alias("kinds"),
        F.array(*(F.size(F.filter("common", F.lit(w).__eq__)).cast("long") for w in COMMON), (F.size("words") - F.size("common")).cast("long")).alias("usual"),
    )


def references(rows: DataFrame) -> dict[str, list[list[float]]]:
    """For each language, its shares of character classes and of common words: a few numbers, sums over all its rows."""
    widths = {"kinds": len(CLASSES) + 3, "usual": len(COMMON) + 1}
    sums = rows.filter("lang is not null and n_words > 0").groupBy("lang").agg(*(F.sum(F.col(k)[i]).alias(f"{k}{i}") for k, n in widths.items() for i in range(n)))
    out: dict[str, list[list[float]]] = {k: [] for k in widths}
    for r in sorted(sums.collect(), key=lambda r: r["lang"]):  # one row a language
        if sum(r[f"usual{i}"] for i in range(widths["usual"])) >= REFERENCE_WORDS:
            for k, n in widths.items():
                own = [r[f"{k}{i}"] for i in range(n)]
                out[k].append([x / sum(own) for x in own])
    return out


def _distance(counts: Column, reference: list[float]) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)

    def part(p: Column, q: Column) -> Column:
        term = lambda a: F.when(a > 0, a * F.log2(2 * a / (p + q))).otherwise(0.0)
        return (term(p) + term(q)) / 2

    parts = F.zip_with(counts, F.array(*map(F.lit, reference)), lambda c, q: part(c / F.greatest(total, F.lit(1)), q))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of each row.

    Null text has no words and fails the base. With no reference (no rows with a language, or too few words) only the base
    decides. Null languages make no reference; their rows are judged like others. Repeated rows count each time in
    references and come back repeated. Other columns are left aside.
    """
    rows = checkpointed(features(docs))
    known = references(rows)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    chars = F.aggregate("kinds", F.lit(0).cast("long"), lambda s, x: s + x)
    nearest = {k: F.array_min(F.array(*(_distance(F.col(k), r) for r in v))) if v else F.lit(0.0) for k, v in known.items()}
    far = ((chars >= CHAR_LEAST) & (nearest["kinds"] > CHAR_LIMIT)) | ((F.col("n_words") >= WORD_LEAST) & (nearest["usual"] > WORD_LIMIT))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"))


def oracle() -> str:
    words = ", ".join(f"'{w}'" for w in COMMON)
    gone = lambda t, p: f"regexp_replace({t}, '[{p.replace(chr(39), chr(39) * 2)}]+', '', 'g')"
    kinds = ", ".join(["chars - length(t1)", "length(t1) - length(t2)", *(f"length(t2) - length({gone('t2', p)})" for p in CLASSES.values())])
    js = "sqrt(greatest(0.0, list_sum(list_transform(range(1, len({q}) + 1), lambda i: (case when {c}[i] > 0 then {c}[i] / {n} * log2(2 * ({c}[i] / {n}) / ({c}[i] / {n} + {q}[i])) else 0 end + case when {q}[i] > 0 then {q}[i] * log2(2 * {q}[i] / ({c}[i] / {n} + {q}[i])) else 0 end) / 2))))"
    return f"""
with d as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as text from documents),
a as (select r, doc_id, lang, text, length(text) as chars, list_filter(regexp_split_to_array(text, '[{SPACE}]+'), lambda w: w <> '') as words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) as lines, {gone('text', 'a-z')} as t1 from d),
b as (select *, {gone('t1', SPACE)} as t2 from a),
c as (select *, [{kinds}] as k6, list_filter(list_transform(words, lambda w: lower(w)), lambda w: w in ({words})) as common from b),
f as (select r, doc_id, lang, words, len(words) as n_words, chars - (length(t1) - length(t2)) as word_chars, length(t2) - length({gone('t2', '#*$%&|<>')}) as n_symbols,
      len(lines) - len(list_distinct(lines)) as n_dup_lines, chars, list_append(k6, chars - list_sum(k6)) as kinds,
      list_append(list_transform([{words}], lambda x: len(list_filter(common, lambda y: y = x))), len(words) - len(common)) as usual from c),
w as (select r, unnest(range(1, len(words) - 1)) as i, words from f where len(words) > 2),
x as (select r, i, count(*) over (partition by r, words[i], words[i + 1], words[i + 2]) as n from w),
y as (select r, count(distinct i + j) as n_repeat_words from x, (values (0), (1), (2)) v(j) where n > 1 group by r),
g as (select lang, sum(n_words) as total, [{", ".join(f"sum(kinds[{i}])" for i in range(1, len(CLASSES) + 4))}] as k, [{", ".join(f"sum(usual[{i}])" for i in range(1, len(COMMON) + 2))}] as u
      from f where lang is not null and n_words > 0 group by lang having sum(n_words) >= {REFERENCE_WORDS}),
q as (select list_transform(k, lambda x: x / list_sum(k)) as qk, list_transform(u, lambda x: x / list_sum(u)) as qu from g),
m as (select r, min({js.format(q='qk', c='kinds', n='greatest(chars, 1)')}) as far_k, min({js.format(q='qu', c='usual', n='greatest(n_words, 1)')}) as far_u from f, q group by r),
z as (select f.*, coalesce(n_repeat_words, 0) as n_repeat_words, far_k, far_u from f left join y using (r) left join m using (r)),
e as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from z)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and not coalesce(chars >= {CHAR_LEAST} and far_k > {CHAR_LIMIT}, false) and not coalesce(n_words >= {WORD_LEAST} and far_u > {WORD_LIMIT}, false) as kept
from e"""
