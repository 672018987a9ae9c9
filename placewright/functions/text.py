"""Names: identifiers, tokens, n-grams, similarity, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Languages that mean none; sources in order of preference.
NO_LANGUAGE = ["und", "zxx", "mis", "null", "none", ""]
PRIORITY = ["gn", "wd", "tgn", "pl", "iv", "gb", "other", "osm"]


def namespace_of(place_id: Column) -> Column:
    return F.when(F.contains(place_id, F.lit(":")), F.split_part(place_id, F.lit(":"), F.lit(1)))


def toponym_parts(toponym_id: Column) -> tuple[Column, Column]:
    """Name and language (null if it means none) of `name@lang`, split at the last @."""
    has = F.contains(toponym_id, F.lit("@"))
    name = F.when(has, F.regexp_extract(toponym_id, r"^(.*)@[^@]*$", 1)).otherwise(toponym_id)
    lang = F.when(has, F.regexp_extract(toponym_id, r"@([^@]*)$", 1)).otherwise("und")
    return name, F.when(~F.lower(lang).isin(NO_LANGUAGE), lang)


def clean_name(name: Column) -> Column:
    """Cut, in this order, at a bracket, comma, spaced dash or slash that isn't first; trim; null under 2 characters; at most 200."""
    out = name
    for mark in ["(", "[", "{", ",", " - ", " / "]:
        at = F.locate(mark, out)
        out = F.when(at > 1, F.substring(out, F.lit(1), at - 1)).otherwise(out)
    out = F.trim(out)
    return F.when(F.length(out) >= 2, F.substring(out, 1, 200))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def ngrams(text: Column, n: int) -> Column:
    return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def phonetic_similarity(a: Column, b: Column) -> Column:
    """1 if equal, 0 if empty or of too different lengths, 0.85 if one of 3 or more holds the other, else 1 - edit distance / length."""
    la, lb = F.length(a), F.length(b)
    most, least = F.greatest(la, lb), F.least(la, lb)
    inside = (least >= 3) & (F.contains(a, b) | F.contains(b, a))
    return (
        F.when((least == 0) | a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).when((most - least) / most > 0.65, 0.0).when(inside, 0.85).otherwise(1 - F.levenshtein(a, b) / most)
    )


def fuzziness(token: Column) -> Column:
    """Edits that a token of this length may differ by."""
    return F.when(F.length(token) <= 2, 0).when(F.length(token) <= 5, 1).otherwise(2)


def split_of(key: Column) -> Column:
    """train, val or test by the first four bytes of the key's md5, modulo 1000: below 800, below 900, the rest."""
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 1000
    return F.when(bucket < 800, "train").when(bucket < 900, "val").otherwise("test")


def primary_namespace(namespaces: Column) -> Column:
    """The preferred source, by the fixed order, then by name."""
    order = F.create_map(*(F.lit(x) for i, n in enumerate(PRIORITY) for x in (n, i)))
    return F.array_min(F.transform(namespaces, lambda n: F.struct(F.coalesce(order[n], order["other"]).alias("r"), n.alias("n"))))["n"]


def within_limits(name: Column, toponym_id: Column, characters: int = 200, id_bytes: int = 450) -> Column:
    """Neither the name nor the identifier's bytes are too long."""
    return (F.length(name) <= characters) & (F.octet_length(toponym_id) <= id_bytes)


def display_names(names: DataFrame, languages: list[str]) -> DataFrame:
    """One row per place of (place_id, name, lang, local): the name in its local language, else one of none, and a name_xx for each language; the last by order."""
    own = [F.max(F.when(F.col("lang") == x, F.col("name"))).alias(f"name_{x}") for x in languages]
    local = F.coalesce(F.max(F.when(F.col("lang") == F.col("local"), F.col("name"))), F.max(F.when(F.col("lang") == "und", F.col("name"))))
    return names.groupBy("place_id").agg(local.alias("local_name"), *own)
