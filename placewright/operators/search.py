"""Discovery of names, accumulation per place, filters, ranking, facets and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import script, temporal, text, types

EXCLUDED, VARIANT_WEIGHT, POOL = ["gb"], 0.9, 10_000


def exact(names: DataFrame, query: str) -> DataFrame:
    """Names equal to the query, case included, with score 1."""
    return names.where(F.col("name") == query).withColumn("score", F.lit(1.0))


def starts(names: DataFrame, query: str) -> DataFrame:
    """Names that begin with the query, or have a word that does, without regard to case and accents."""
    q, name = script.fold(F.lit(query)), script.fold(F.col("name"))
    return names.where(F.startswith(name, q) | F.exists(text.tokens(name), lambda t: F.startswith(t, q))).withColumn("score", F.lit(1.0))


def infix(names: DataFrame, query: str) -> DataFrame:
    """Names that hold the query, without regard to case and accents."""
    return names.where(F.contains(script.fold(F.col("name")), script.fold(F.lit(query)))).withColumn("score", F.lit(1.0))


def fuzzy(names: DataFrame, query: str) -> DataFrame:
    """Names with a word within the query word's edits and the same first two letters; 3 for each such word, 5 more for equality."""
    wanted = [t for t in query.lower().split() if t]
    close = lambda q: F.exists(text.tokens(script.fold(F.col("name"))), lambda t: (F.left(t, F.lit(2)) == F.left(script.fold(F.lit(q)), F.lit(2))) & (F.levenshtein(t, script.fold(F.lit(q))) <= text.fuzziness(F.lit(q))))
    hits = sum((F.when(close(q), 3.0).otherwise(0.0) for q in wanted), F.lit(0.0))
    return names.withColumn("score", hits + F.when(F.lower("name") == query.lower(), 5.0).otherwise(0.0)).where("score > 0")


def with_variants(names: DataFrame, forms: list[str], mode=exact) -> DataFrame:
    """The query and its variants (case-insensitively distinct, at most ten); a variant's score counts 0.9; the best form of a name stays."""
    kept: dict[str, str] = {}
    for f in forms:
        if f.strip():
            kept.setdefault(f.strip().lower(), f.strip())
    found = None
    for i, f in enumerate(list(kept.values())[:11]):
        own = mode(names, f).withColumn("score", F.col("score") * (1.0 if i == 0 else VARIANT_WEIGHT))
        found = own if found is None else found.unionByName(own)
    keys = [c for c in names.columns]
    return found.groupBy(*keys).agg(F.max("score").alias("score"))


def in_namespaces(include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Named sources; else all but the excluded ones (by default a fixed list)."""
    return F.col("namespace").isin(include) if include else ~F.col("namespace").isin(EXCLUDED if exclude is None else exclude)


def accumulate(hits: DataFrame) -> DataFrame:
    """Best score of each place, and the name that has it (the last by name on ties)."""
    best = hits.groupBy("place_id").agg(F.max(F.struct("score", "name")).alias("b"))
    return best.select("place_id", F.col("b.score").alias("score"), F.col("b.name").alias("matched"))


def normalised(scores: DataFrame) -> DataFrame:
    """Scores as percentages of the best of all that were discovered, before any filter."""
    top = scores.agg(F.max("score").alias("top"))
    return scores.crossJoin(F.broadcast(top)).withColumn("score", F.col("score") / F.col("top") * 100).drop("top")


def ranked(df: DataFrame, offset: int = 0, size: int | None = None) -> DataFrame:
    """By score, then place_id, descending; pages nest."""
    out = df.orderBy(F.col("score").desc(), F.col("place_id").desc()).offset(offset)
    return out if size is None else out.limit(size)


def reconcile(names: DataFrame, places: DataFrame, spans: DataFrame, query: str, window: tuple[int, int], include: list[str] | None = None, size: int = 50) -> DataFrame:
    """Candidates of a name: discovered, scored by their best name, filtered by source and window, ranked."""
    scored = normalised(accumulate(exact(names.where(in_namespaces(include)), query)))
    near = spans.where(temporal.possibly(F.col("span"), *window)).select("place_id").distinct()
    return ranked(scored.join(places, "place_id").join(near, "place_id", "left_semi"), 0, size)


def suggest(names: DataFrame, query: str, size: int = 10) -> DataFrame:
    """Names that begin with the query (1) or equal it (5 more), one for each spelling without case, best first."""
    found = starts(names, query).withColumn("score", F.col("score") + F.when(F.lower("name") == query.lower(), 5.0).otherwise(0.0))
    best = found.groupBy(F.lower("name").alias("key")).agg(F.min_by("name", F.struct(-F.col("score"), "name")).alias("name"), F.max("score").alias("score"))
    return best.select("name", "score").orderBy(F.col("score").desc(), "name").limit(size)


def facet(values: DataFrame, key: str, size: int, label: str | None = None) -> DataFrame:
    """Most frequent keys (by count, then key) and, if asked for, each one's most frequent label."""
    if label is None:
        return values.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), key).limit(size)
    per = values.where(F.col(key).isNotNull()).groupBy(key, label).agg(F.count("*").alias("c"))
    best = F.min_by(label, F.struct(-F.col("c"), F.col(label)))
    return per.groupBy(key).agg(F.sum("c").alias("n"), best.alias("label")).orderBy(F.col("n").desc(), key).limit(size)


def bm25(tokens: DataFrame, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 of (doc_id, tokens array) for query terms: one pass for terms and lengths, statistics joined as one row each."""
    sized = tokens.select("doc_id", F.size("tokens").alias("len"), F.filter("tokens", lambda t: t.isin(query)).alias("hits"))
    stats = sized.agg(F.count("*").alias("docs"), F.avg("len").alias("mean"))
    tf = sized.select("doc_id", "len", F.explode("hits").alias("term")).groupBy("doc_id", "len", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("mean")))
    return tf.join(F.broadcast(df), "term").crossJoin(F.broadcast(stats)).groupBy("doc_id").agg(F.sum(part).alias("score"))


def lookup(places: DataFrame, ids: DataFrame) -> DataFrame:
    """Places by (pos, asked) ids, `place:` stripped, in the order asked; what is missing has found = false."""
    asked = ids.withColumn("place_id", F.regexp_replace("asked", "^place:", ""))
    return asked.join(places.withColumn("found", F.lit(True)), "place_id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def concept_or_below(path: Column, root: str) -> Column:
    return types.within(path, F.lit(root))


def top_per_group(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group; Spark prunes each task's rows before the shuffle."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= n)


def by_label(names: DataFrame, asked: DataFrame) -> DataFrame:
    """Names equal to one of the asked labels but for case and accents."""
    keyed = asked.select(script.fold(F.col("asked")).alias("key")).distinct()
    return names.withColumn("key", script.fold(F.col("name"))).join(keyed, "key", "left_semi").drop("key")


def pool(scores: DataFrame, offset: int, size: int, factor: int = 4) -> DataFrame:
    """The candidates that later filters see: the best by score, then place_id, as many as the page asks for times the factor, at most POOL."""
    return scores.orderBy(F.col("score").desc(), F.col("place_id").desc()).limit(min((offset + size) * factor, POOL))


def spellings(hits: DataFrame, size: int) -> DataFrame:
    """One row for each spelling of (name, score, lang, namespace, place_id): its best score and what it stands for, best first."""
    lists = {"langs": "lang", "namespaces": "namespace", "places": "place_id"}
    out = hits.groupBy("name").agg(F.max("score").alias("score"), *(F.array_sort(F.collect_set(c)).alias(n) for n, c in lists.items()))
    return out.orderBy(F.col("score").desc(), "name").limit(size)


def names_of(names: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """The distinct names of the asked places, in order, at most `most` each."""
    own = names.join(ids.select("place_id").distinct(), "place_id", "left_semi").select("place_id", "name").distinct()
    kept = top_per_group(own, ["place_id"], [F.col("name")], most)
    return kept.groupBy("place_id").agg(F.array_sort(F.collect_list("name")).alias("names"))


def namespaces_seen(records: DataFrame) -> DataFrame:
    """The distinct sources of records, in order, in one row; of a record without one, what stands before its id's colon."""
    own = F.coalesce(F.nullif(F.col("namespace"), F.lit("")), F.when(F.contains("place_id", F.lit(":")), F.nullif(F.split_part("place_id", F.lit(":"), F.lit(1)), F.lit(""))))
    return records.select(own.alias("n")).where("n is not null").distinct().agg(F.array_sort(F.collect_list("n")).alias("namespaces"))


def scope_report(asked: DataFrame, containers: DataFrame, links: DataFrame, relations: tuple[str, ...] = ("sameAs", "exactMatch")) -> DataFrame:
    """How each asked container (place_id) counts: by its own area, by that of a place linked with it, by a point alone, or not at all, in one row of lists."""
    both = links.where(F.col("relation_type").isin(*relations)).select(F.col("place_a").alias("place_id"), F.col("place_b").alias("other"))
    both = both.unionByName(both.select(F.col("other").alias("place_id"), F.col("place_id").alias("other")))
    areas = containers.where("is_area").select(F.col("place_id").alias("other"))
    lent = asked.join(both, "place_id").join(areas, "other", "left_semi").select("place_id").distinct().withColumn("lent", F.lit(True))
    marked = asked.distinct().join(containers, "place_id", "left").join(lent, "place_id", "left")
    how = F.when(F.col("is_area"), "polygon").when(F.col("lent"), "linked").when(F.col("has_point"), "point").otherwise("unresolved")
    listed = [F.array_sort(F.collect_list(F.when(F.col("how") == h, F.col("place_id")))).alias(h) for h in ("polygon", "linked", "point", "unresolved")]
    out = marked.withColumn("how", how).agg(*listed, F.max(F.col("how") != "unresolved").alias("applied"))
    return out.withColumn("mode", F.when(F.size("polygon") > 0, "polygon").when(F.size("linked") > 0, "linked-polygon").when(F.size("point") > 0, "point").otherwise("none"))


def candidates(places: DataFrame) -> DataFrame:
    """Places with their distinct names, points and whether they have an area: what a client is shown of (place_id, title, names, geometries, links, score)."""
    shown = F.filter("geometries", lambda g: g["repr_point"].isNotNull() | F.coalesce(g["has_geom"], F.lit(False)))
    geometry = lambda g: F.struct(g["repr_point"].alias("repr_point"), F.coalesce(g["geom_class"] == "area", g["has_geom"], F.lit(False)).alias("is_area"))
    none = lambda c: F.coalesce(F.col(c), F.array().cast(dict(places.dtypes)[c]))
    return places.select("place_id", "title", F.array_distinct(F.filter(none("names"), lambda n: n != "")).alias("names"), F.transform(shown, geometry).alias("geometries"), none("links").alias("links"), "score")
