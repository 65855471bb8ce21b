"""Column functions on names, headers and sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that keep their spelling when an all-capitals header is lowered. (A lone v stays lowered.)
KEPT_WORDS = ["IV", "III", "II", "I", "T7", "ATPase", "ATP", "ADP", "GTP", "GDP", "NTP", "dNTP", "TFIIS", "groEL", "groES", "RNAse", "DNAse", "DNA", "ssDNA", "RNA", "rRNA", "mRNA", "tRNA", "dsRNA", "MHC", "T-cell"]


def reject_flag(seq: Column) -> Column:
    """1 for sequences under 20 letters, or with more than a fifth of them unknown (x)."""
    unknown = F.length(seq) - F.length(F.replace(seq, F.lit("x"), F.lit("")))
    return F.when((F.length(seq) < 20) | (5 * unknown > F.length(seq)), 1).otherwise(0)


def clean_case(header: Column) -> Column:
    """Lower case for headers without small letters, with the fixed words restored."""
    lowered = F.lower(header)
    for word in KEPT_WORDS:
        lowered = F.regexp_replace(lowered, rf"\b{word.lower()}\b", word)
    return F.when(header.rlike(r"\p{Ll}"), header).otherwise(lowered)


def parse_species(text: Column) -> Column:
    """struct of common_name, scientific_name, details, ncbi_taxid from `Common (Scientific name), details [TaxId: n]`."""
    taxid = F.nullif(F.regexp_extract(text, r"\[TaxId: ?(\d+)\]", 1), F.lit("")).cast("int")
    bare = F.trim(F.regexp_replace(text, r"\s*\[TaxId: ?\d+\]", ""))
    paired = F.regexp_extract(bare, r"^(.*?)\s*\(([^()]*)\)\s*(?:,\s*(.*))?$", 2)
    has = paired != ""
    common = F.when(has, F.regexp_extract(bare, r"^(.*?)\s*\(([^()]*)\)\s*(?:,\s*(.*))?$", 1))
    details = F.when(has, F.regexp_extract(bare, r"^(.*?)\s*\(([^()]*)\)\s*(?:,\s*(.*))?$", 3)).otherwise(F.regexp_extract(bare, r"^[^,]*,\s*(.*)$", 1))
    scientific = F.when(has, paired).otherwise(F.regexp_extract(bare, r"^([^,]*)", 1))
    empty = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.struct(empty(common).alias("common_name"), empty(scientific).alias("scientific_name"), empty(details).alias("details"), taxid.alias("ncbi_taxid"))


def normalise_species(name: Column) -> Column:
    """Genus and species with usual capitals; a virus keeps its whole name, and `Genus (Old) species` all three words. Null for one word."""
    bare = F.trim(F.regexp_replace(name, r"\s+", " "))
    parts = F.split(bare, " ")
    word = lambda i: F.get(parts, F.lit(i))
    capital = lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))
    old = F.concat(capital(word(0)), F.lit(" ("), capital(F.substr(word(1), F.lit(2))), F.lit(" "), F.lower(word(2)))
    renamed = word(1).startswith("(") & word(1).endswith(")") & (F.size(parts) > 2)
    two = F.concat(capital(word(0)), F.lit(" "), F.lower(word(1)))
    return F.when(F.size(parts) < 2, None).when(F.lower(bare).contains("virus"), capital(bare)).when(renamed, old).otherwise(two)


def sccs_depth(a: Column, b: Column) -> Column:
    """How many leading parts of two class strings are equal, 0 to 4."""
    x, y = F.split(a, r"\."), F.split(b, r"\.")
    same = [F.get(x, F.lit(i)).isNotNull() & (F.get(x, F.lit(i)) == F.get(y, F.lit(i))) for i in range(4)]
    out = F.lit(0)
    for i in range(4):
        every = same[0]
        for s in same[1 : i + 1]:
            every = every & s
        out = F.when(F.coalesce(every, F.lit(False)), i + 1).otherwise(out)
    return out


def is_nucleotide(seq: Column) -> Column:
    """At least 95 % of the first 100 known letters are a, c, g, t, u or n."""
    head = F.substring(F.replace(F.lower(seq), F.lit("x"), F.lit("")), 1, 100)
    bases = F.length(F.regexp_replace(head, "[^acgtun]", ""))
    return (F.length(head) > 0) & (100 * bases >= 95 * F.length(head))


def wrapped(seq: Column, width: int = 60) -> Column:
    """The sequence in lines of a width."""
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")


def half_up(x: Column, digits: int = 2) -> Column:
    """Rounds halves up, negative ones too."""
    return F.floor(x * 10**digits + F.lit(0.5)) / F.lit(float(10**digits))
