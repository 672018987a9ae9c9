"""Merging patches and documents, upserts, retention, extents, coverage and stage logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def merge_patch(docs: DataFrame, patches: DataFrame, key: str, upsert: bool = False) -> DataFrame:
    """Fields of a patch replace a document's where they aren't null; with upsert, patches without a document become documents."""
    shared = [c for c in patches.columns if c != key]
    renamed = patches.select(key, *(F.col(c).alias(f"_{c}") for c in shared))
    joined = docs.join(renamed, key, "full_outer" if upsert else "left")
    return joined.select(key, *(F.coalesce(f"_{c}", c).alias(c) if c in shared else F.col(c) for c in docs.columns if c != key))


def last_write(rows: DataFrame, key: list[str], order: Column) -> DataFrame:
    """The row of each key with the largest order."""
    value = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*value), order).alias("v")).select(*key, "v.*")


def replace_namespace(live: DataFrame, new: DataFrame, namespace: str) -> DataFrame:
    """Live rows of all other sources and the new rows of this one."""
    return live.where(F.coalesce(F.col("namespace") != namespace, F.lit(True))).unionByName(new.where(F.col("namespace") == namespace))


def keep_newest(versions: DataFrame, family: str, name: str, keep: int) -> DataFrame:
    """Versions beyond the newest `keep` of each family, which may go."""
    return versions.withColumn("rank", F.row_number().over(W.partitionBy(family).orderBy(F.col(name).desc()))).where(F.col("rank") > keep)


def merged_lists(rows: DataFrame, key: str, item: str, position: str) -> DataFrame:
    """Distinct items of each key, in order of their first position."""
    first = rows.groupBy(key, item).agg(F.min(position).alias("p"))
    return first.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("p", item))), lambda x: x[item]).alias("items"))


def prune_live(links: DataFrame, cutoff: Column) -> DataFrame:
    """Live links that a batch up to the cutoff doesn't hold: later ones and those without a time."""
    return links.where(F.col("asserted_at").isNull() | (F.col("asserted_at") > cutoff))


def compact(cells: DataFrame, cell: str, parent, levels: int) -> DataFrame:
    """Four sibling cells become their parent, level by level, from the finest zoom; (owner, cell) stay distinct."""
    from ..functions.space import zoom_of

    out = cells.select("owner", F.col(cell).alias("cell")).distinct()
    for _ in range(levels):
        finest = out.groupBy("owner").agg(F.max(zoom_of(F.col("cell"))).alias("z"))
        marked = out.join(finest, "owner").withColumn("up", F.when(zoom_of(F.col("cell")) == F.col("z"), parent(F.col("cell"), F.col("z") - 1)))
        full = marked.where("up is not null").groupBy("owner", "up").agg(F.count("*").alias("n")).where("n = 4").select("owner", "up")
        whole = full.withColumnRenamed("up", "cell")
        rest = marked.join(full, ["owner", "up"], "left_anti").select("owner", "cell")
        out = rest.unionByName(whole).distinct()
    return out


def runtime_estimate(runs: DataFrame) -> DataFrame:
    """Upper median of the last five durations (seconds) of each stage, times 1.2, in whole seconds."""
    last = runs.withColumn("r", F.row_number().over(W.partitionBy("stage").orderBy(F.col("ts").desc(), F.col("id").desc()))).where("r <= 5")
    ordered = last.groupBy("stage").agg(F.sort_array(F.collect_list("seconds")).alias("s"))
    return ordered.select("stage", F.floor(F.element_at("s", (F.floor(F.size("s") / 2) + 1).cast("int")) * 1.2).cast("long").alias("estimate"))


def retention(idle_days: Column, status: Column) -> Column:
    """exempt by status; else delete from 360 idle days, notify from 330, keep."""
    return F.when(status.isin("published", "private_permanent", "submitted"), "exempt").when(idle_days >= 360, "delete").when(idle_days >= 330, "notify").otherwise("keep")


def two_readings(hint: Column, other: Column) -> Column:
    """Text, source and rule of two readings of a label; the first wins unless it is illegible or one letter off."""
    h, v = F.trim(F.coalesce(hint, F.lit(""))), F.trim(F.coalesce(other, F.lit("")))
    hl, vl = F.lower(h), F.lower(v)
    rule = (
        F.when(v == "", "vlm-empty").when(h == "", "no-hint").when(F.upper(h).rlike(r"^(X+|\?+|-+|\.+)$"), "resolved-illegible").when(hl == vl, "match").when(F.contains(hl, vl), "vlm-truncated")
        .when(F.contains(vl, hl), "vlm-overread").when((F.levenshtein(hl, vl) <= 1) & (F.abs(F.length(h) - F.length(v)) <= 1), "correction").otherwise("divergent")
    )
    second = rule.isin("no-hint", "resolved-illegible", "correction")
    return F.struct(F.when(second, v).otherwise(h).alias("text"), F.when(second, "vlm").when(rule == "match", "agree").otherwise("hint").alias("source"), rule.alias("rule"))


# Map labels: an edition with what each field comes from, and the dates of sheets


def edition(labels: DataFrame, readings: DataFrame, version: str) -> DataFrame:
    """Labels (pin_id, text, token, ...) with their second readings (pin_id, reading, kind, style, legible): text, its source and rule, token, its method, and the edits.

    A label that has a token keeps it and its text. One without, but with a reading, gets the text that the two agree on, the
    reading's kind, and an edit for each of them that is new. Others are pending. Of repeated readings of a pin the largest counts.
    """
    last = readings.groupBy("pin_id").agg(F.max(F.struct("reading", "kind", "style", "legible")).alias("v"))
    both = labels.join(last, "pin_id", "left").withColumn("r", two_readings(F.col("text"), F.col("v.reading")))
    read = F.col("token").isNull() & F.col("v").isNotNull()
    typed = read & (F.coalesce(F.col("v.kind"), F.lit("")) != "")
    changed = read & (F.col("r.source") == "vlm")
    edit = lambda field, old, new, rule: F.struct(F.lit(field).alias("field"), old.alias("from"), new.alias("to"), F.lit("tier1-vlm").alias("method"), rule.alias("rule"), F.lit(version).alias("version"))
    none = F.lit(None).cast("string")
    edits = F.array_compact(F.array(F.when(typed, edit("type", none, F.col("v.kind"), none)), F.when(changed, edit("text", F.col("text"), F.col("r.text"), F.col("r.rule")))))
    state = F.when(F.col("token").isNotNull(), "tier0").when(typed, "typed").when(read, "read").otherwise("pending")
    return both.select(
        *[c for c in labels.columns if c not in ("text", "token")], F.when(read, F.col("r.text")).otherwise(F.col("text")).alias("text"), F.when(read, F.col("r.source")).otherwise("raw").alias("source"),
        F.when(read, F.col("r.rule")).alias("rule"), F.col("text").alias("raw"), F.when(read, F.col("v.reading")).alias("reading"), F.coalesce("token", F.when(typed, F.col("v.kind"))).alias("token"), state.alias("state"), edits.alias("edits"),
    )


def sheet_dated(labels: DataFrame, sheets: DataFrame, zoom: int = 6) -> DataFrame:
    """Labels (pin_id, lon, lat, ...) with the sheet that holds them, its years and whether several do: of sheets (region, rings, published, start, end) the one published last, ties by the largest id; null outside all."""
    from .within import containing

    points = labels.where("lon is not null and lat is not null").select("pin_id", "lon", "lat")
    held = containing(points, sheets.select("region", "rings"), zoom).select("pin_id", "region").join(sheets.drop("rings"), "region")
    best = held.groupBy("pin_id").agg(F.max(F.struct(F.coalesce("published", F.lit(0)).alias("p"), "region", "start", "end")).alias("b"), (F.countDistinct("region") > 1).alias("ambiguous"))
    return labels.join(best.select("pin_id", F.col("b.region").alias("sheet"), "b.start", "b.end", "ambiguous"), "pin_id", "left")
