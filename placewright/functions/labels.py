"""Labels of maps and vocabularies: cleaning, casing, kinds of map labels, encodings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .shapes import once

#: Words that stay small in a title.
SMALL = ["le", "la", "de", "upon", "on", "under", "in", "the", "and", "of", "cum", "next", "by", "with", "juxta"]
#: Whole labels on maps, and what they mark.
MARKS = {
    "F.P.": "footpath", "F.B.": "footbridge", "F.Br.": "footbridge", "P.H.": "public-house", "B.H.": "beer-house", "Inn": "inn", "Hotel": "hotel", "Ch.": "church", "Chy.": "chimney", "Chap.": "chapel",
    "Cathl.": "cathedral", "Sch.": "school", "Schl.": "school", "P.O.": "post-office", "Sta.": "railway-station", "S.B.": "signal-box", "S.P.": "signal-post", "S.P": "signal-post", "B.M.": "bench-mark",
    "B.S.": "boundary-stone", "B.R.": "bridle-road", "M.S.": "milestone", "M.S": "milestone", "M.P.": "mile-post", "M.P": "mile-post", "L.B.": "letter-box", "P.B.": "pillar-box", "G.P.": "guide-post",
    "L.P.": "lamp-post", "T.C.B.": "telephone-call-box", "W.": "well", "W": "well", "Wl.": "well", "P.": "pump", "P": "pump", "Spr.": "spring", "S.": "spring", "Sr.": "spring", "Fn.": "fountain",
    "Cist.": "cistern", "L.K.": "limekiln", "Sl.": "sluice", "Fm.": "farm", "Ho.": "house", "Cott.": "cottage", "Bldgs.": "buildings", "Sml.": "mill", "Mill": "mill", "S.H.": "summer-house",
    "G.Yd.": "graveyard", "Cem.": "cemetery", "B.G.": "burial-ground", "Quy.": "quarry", "Qy.": "quarry", "Br.": "bridge", "Bri.": "bridge", "Sta": "railway-station", "Wks.": "works", "Gas Wks.": "gasworks",
    "Sdg.": "railway-siding", "Junc.": "railway-junction", "Ford": "ford", "Weir": "weir", "Boro. By.": "borough-boundary", "Co. By.": "county-boundary", "Par. By.": "parish-boundary", "Bdy.": "boundary",
    "Bdy": "boundary", "Smy.": "smithy", "Rec.": "rectory", "Vic.": "vicarage", "V.": "vicarage", "F.Sta.": "fire-station",
}
#: Words of map labels and what they mark.
KEYWORDS = {
    "Well": "well", "Spring": "spring", "Springs": "spring", "Quarry": "quarry", "Quarries": "quarry", "Ford": "ford", "Weir": "weir", "Smithy": "smithy", "Mill": "mill", "Windmill": "windmill",
    "Watermill": "watermill", "Wood": "wood", "Plantation": "plantation", "Copse": "wood", "Common": "common-land", "Moor": "moor", "Fell": "hill", "Hill": "hill", "Down": "hill", "Downs": "hill",
    "Point": "headland", "Head": "headland", "Bay": "bay", "Cove": "bay", "River": "river", "Brook": "stream", "Burn": "stream", "Beck": "stream", "Stream": "stream", "Lough": "lake", "Loch": "lake",
    "Lake": "lake", "Pond": "pond", "Reservoir": "reservoir", "Colliery": "colliery", "Works": "works", "Quarry (Old)": "quarry", "Cottage": "cottage", "Cottages": "cottage", "Bridge": "bridge",
    "Wharf": "wharf", "Pier": "pier", "Chapel": "chapel", "Church": "church", "School": "school", "Cemetery": "cemetery", "Castle": "castle", "Tumulus": "tumulus", "Tumuli": "tumulus", "Camp": "hillfort",
    "Fort": "fort", "Cairn": "cairn", "Cross": "cross", "Farm": "farm", "Hall": "hall", "House": "house", "Lodge": "lodge", "Cottage (The)": "cottage", "Stone": "standing-stone", "Stones": "standing-stone",
    "Rectory": "rectory", "Vicarage": "vicarage", "Manse": "manse", "Waterfall": "waterfall", "Cascade": "waterfall", "Mound": "mound", "Mounds": "mound", "Cromlech": "chambered-tomb",
    "Cist": "chambered-tomb", "Mine": "mine", "Shaft": "mine-shaft", "Beacon": "beacon", "Ffynnon": "spring", "Pistyll": "waterfall", "Rhaeadr": "waterfall", "Rhaiadr": "waterfall", "Sgwd": "waterfall",
    "Scwd": "waterfall", "Carnedd": "cairn", "Tomen": "mound",
}
#: How a label says that it can't be read.
ILLEGIBLE = ["XXXX", "XXX", "XX", "????", "???", "??", "----", "..."]

#: Marks and words that likely_kinds() goes by.
KIND_MARKS = {
    "FP": "footpath", "FB": "footbridge", "BM": "benchmark", "SP": "signpost", "GP": "guidepost", "BS": "boundary_stone", "MS": "milestone", "MP": "milepost", "BP": "boundary_post",
    "LB": "letter_box", "PO": "post_office", "PH": "public_house", "SB": "signal_box", "W": "well", "P": "pump", "CH": "church", "CHAP": "chapel", "SCH": "school", "SMY": "smithy",
}
KIND_WORDS = {
    "towing path": "towpath", "gravel pit": "quarry_or_mine", "public house": "public_house", "reservoir": "water_feature", "cemetery": "cemetery", "hospital": "hospital", "colliery": "colliery",
    "vicarage": "vicarage", "viaduct": "viaduct", "church": "church", "chapel": "chapel", "school": "school", "bridge": "bridge", "quarry": "quarry", "smithy": "smithy", "station": "station",
    "tunnel": "tunnel", "farm": "farm", "mill": "mill", "inn": "public_house",
}


def title_case(name: Column) -> Column:
    """All-capital names with each word's first letter capital, small words small unless first, also between hyphens; others stay."""
    before = lambda w: F.regexp_extract(w, r"^(\P{L}*)", 1)
    raised = lambda w, n: F.concat(F.left(w, n), F.upper(F.substring(w, n + 1, F.lit(1))), F.substring(w, n + 2, F.length(w)))
    cap = lambda w: raised(w, F.length(before(w)))
    segment = lambda s, j: F.when((j > 0) & s.isin(SMALL), s).otherwise(cap(s))
    word = lambda w, i: F.when((i > 0) & w.isin(SMALL), w).otherwise(F.array_join(F.transform(F.split(w, "-"), segment), "-"))
    cased = F.array_join(F.transform(F.split(F.lower(F.trim(name)), r"\s+"), word), " ")
    return F.when((F.trim(name) == F.upper(name)) & (F.trim(name) != ""), cased).otherwise(F.trim(name))


def variants(name: Column) -> Column:
    """The names that ` - ` parts."""
    return F.filter(F.transform(F.split(name, " - "), lambda x: F.trim(x)), lambda x: x != "")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def clean_term(term: Column, parent: Column) -> Column:
    """(label, guide) of a thesaurus term: without `(hierarchy name)` and its parent's name in brackets; a guide term's own words, from `by` on; null for a bare id."""
    label = F.trim(term)
    plain = F.regexp_replace(label, r"\s*\(hierarchy name\s*\)\s*$", "")
    label = F.when(plain != label, F.lower(F.trim(plain))).otherwise(label)
    guide = F.startswith(label, F.lit("<")) & F.endswith(label, F.lit(">"))
    inner = F.trim(F.substring(label, F.lit(2), F.length(label) - 2))
    by = F.regexp_extract(inner, r"\b(by\b.+)", 1)
    label = F.when(guide, F.when(by != "", by).otherwise(inner)).otherwise(label)
    tail = F.concat(F.lit("("), F.lower(parent), F.lit(")"))
    cut = F.when(F.endswith(F.lower(label), tail), F.rtrim(F.substring(label, F.lit(1), F.length(label) - F.length(tail))))
    bare = F.trim(term).rlike(r"^aat:\d+$")
    return F.struct(F.when(~bare, F.coalesce(F.nullif(cut, F.lit("")), label)).alias("label"), (guide & ~bare).alias("guide"))


def map_label(text: Column, marks: dict[str, str] | None = None, words: dict[str, str] | None = None, illegible: list[str] | None = None) -> Column:
    """(token, rule, allcaps) of a map label, by the first rule that holds: illegible, a mark without regard to case, dots and spaces, keyword (longest first), number, all capitals, the rest."""
    t = F.trim(text)
    key = F.upper(F.regexp_replace(t, r"\s", ""))
    known: dict[str, str] = {}
    for k, v in (MARKS if marks is None else marks).items():
        plain = k.replace(" ", "").upper()
        known.setdefault(plain, v)
        known.setdefault(plain.replace(".", ""), v)
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    mark = F.coalesce(F.element_at(table, key), F.element_at(table, F.replace(key, F.lit("."), F.lit(""))))
    spoken = KEYWORDS if words is None else words
    word = F.coalesce(*(F.when(t.rlike(rf"(?iU)\b{re.escape(k)}\b"), F.lit(v)) for k, v in sorted(spoken.items(), key=lambda kv: -len(kv[0]))))
    caps = t.rlike(r"\p{L}") & ~t.rlike(r"[\p{L}&&[^\p{Lu}]]")
    unread = (t == "") | key.isin(ILLEGIBLE if illegible is None else illegible) | t.isNull()
    number = key.rlike(r"^\d{1,4}(\.\d+)?$") & ~t.rlike(r"\s")
    rule = F.when(unread, "illegible").when(mark.isNotNull(), "abbrev").when(word.isNotNull(), "keyword").when(number, "numeric").when(caps, "allcaps-router").otherwise("residual")
    token = F.when(rule == "abbrev", mark).when(rule == "keyword", word).when(rule == "numeric", "spot-height")
    return F.struct(token.alias("token"), rule.alias("rule"), F.coalesce(caps, F.lit(False)).alias("allcaps"))


def likely_kinds(text: Column) -> Column:
    """Up to three (kind, share) of a map label, largest first: signals add up, more than 1 is scaled to it, less leaves the rest to `unknown`."""
    low = F.lower(F.trim(text))
    words = F.array(*(F.struct(F.lit(rf"\b{k}\b").alias("word"), F.lit(v).alias("kind"), F.lit(0.85).alias("w")) for k, v in KIND_WORDS.items()), F.struct(F.lit(r"\b(road|street|lane|terrace|avenue|way|walk|row)\b").alias("word"), F.lit("road").alias("kind"), F.lit(0.9).alias("w")), F.struct(F.lit(r"\b(cairn|camp|barrow|castle|abbey|priory|fort|moat|tumulus)s?\b").alias("word"), F.lit("antiquity").alias("kind"), F.lit(0.88).alias("w")))
    spoken = F.transform(F.filter(words, lambda x: F.rlike(low, x["word"])), lambda x: F.struct(x["kind"].alias("kind"), x["w"].alias("w")))
    sign = lambda kind, w: F.struct(kind.alias("kind"), F.lit(w).alias("w"))

    def kinds(rule: Column) -> Column:
        marks = F.array_compact(F.array(F.when(rule["rule"] == "numeric", sign(F.lit("spot_height_or_value"), 0.92)), F.when(rule["allcaps"] & F.contains(low, F.lit(" ")), sign(F.lit("admin_or_parish"), 0.78)), F.when(rule["rule"] == "abbrev", sign(rule["token"], 0.85))))
        unread = F.array(F.struct(F.lit("illegible").alias("kind"), F.lit(1.0).alias("share")))
        return F.when(rule["rule"] == "illegible", unread).otherwise(once(F.concat(spoken, marks), summed))

    def summed(hits: Column) -> Column:
        names = F.array_distinct(F.transform(hits, lambda h: h["kind"]))
        sums = F.transform(names, lambda k: F.struct(k.alias("kind"), F.aggregate(F.filter(hits, lambda h: h["kind"] == k), F.lit(0.0), lambda a, h: a + h["w"]).alias("w")))
        return once(sums, ranked)

    def ranked(sums: Column) -> Column:
        total = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x["w"])
        shares = F.transform(sums, lambda x: F.struct(F.round(x["w"] / F.greatest(total, F.lit(1.0)), 3).alias("share"), x["kind"].alias("kind")))
        rest = F.filter(F.array(F.struct(F.round(1 - total, 3).alias("share"), F.lit("unknown").alias("kind"))), lambda x: x["share"] > 0)
        falling = F.array_sort(F.transform(F.concat(shares, rest), lambda x: F.struct((-x["share"]).alias("share"), x["kind"].alias("kind"))))
        return F.transform(F.slice(falling, 1, 3), lambda x: F.struct(x["kind"].alias("kind"), (-x["share"]).alias("share")))

    return once(map_label(text, KIND_MARKS, KIND_WORDS, ["ILLEGIBLE", "UNREADABLE", "?", "-"]), kinds)


def encode_characters(text: Column, vocabulary: Column, space: int = 2, unknown: int = 1) -> Column:
    """Ids of the lower-cased characters by a map from character to id."""
    return F.transform(F.split(F.lower(text), ""), lambda c: F.when(c == " ", F.lit(space)).otherwise(F.coalesce(F.element_at(vocabulary, c), F.lit(unknown))))


def noisy(text: Column, key: Column, seed: int = 0) -> Column:
    """One character, chosen by a hash of the key, taken out, doubled, replaced or swapped with the next; texts under three characters stay."""
    h = F.abs(F.xxhash64(key, F.lit(seed)))
    at, kind = (h % F.greatest(F.length(text) - 1, F.lit(1))).cast("int") + 1, F.floor(h / 1024) % 4
    head, c, rest = F.substring(text, F.lit(1), at - 1), F.substring(text, at, F.lit(1)), F.substring(text, at + 1, F.length(text))
    out = F.when(kind == 0, F.concat(head, rest)).when(kind == 1, F.concat(head, c, c, rest)).when(kind == 2, F.concat(head, F.lit("e"), rest))
    return F.when(F.length(text) < 3, text).otherwise(F.coalesce(out, F.concat(head, F.left(rest, F.lit(1)), c, F.substring(rest, F.lit(2), F.length(rest)))))


#: Keys beside each other, and characters that scanners take for each other.
KEYBOARD = {
    "a": "qwsz", "b": "vghn", "c": "xdfv", "d": "erfcxs", "e": "rdsw", "f": "rtgvcd", "g": "tyhbvf", "h": "yujnbg", "i": "uojk", "j": "uiknmh", "k": "ioljm", "l": "opk", "m": "njk",
    "n": "bhjm", "o": "iplk", "p": "ol", "q": "wa", "r": "etdf", "s": "weadzx", "t": "ryfg", "u": "yihj", "v": "cfgb", "w": "qeas", "x": "zsdc", "y": "tugh", "z": "asx",
}
SCANNED = {"o": "0", "0": "o", "l": "1", "1": "l", "i": "1", "e": "c", "c": "e", "n": "m", "m": "n"}


def noised(text: Column, key: Column, share: float = 0.3, most: int = 2, keyboard: bool = True, seed: int = 0) -> Column:
    """The text with typing noise in `share` of the rows: one edit, or up to `most` (a third of its length) in texts of six characters or more.

    An edit takes a character out (of three or more), doubles one, replaces it by a key beside it, or by what a scanner takes it for, or swaps it with
    the next. All is chosen by hashes of the key, so reruns agree. Texts under two characters stay.
    """
    draw = lambda what, *more: F.pmod(F.xxhash64(key, F.lit(f"{seed} {what}"), *more), F.lit(1 << 30))
    table = lambda d: F.create_map(*(F.lit(x) for pair in d.items() for x in pair))
    number = F.when(F.length(text) < 6, F.lit(1)).otherwise(1 + draw("number") % F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.length(text) / 3)))).cast("int")

    def edit(t: Column, i: Column) -> Column:
        at, kind = (draw("at", i) % F.length(t)).cast("int") + 1, draw("kind", i) % 4
        head, c, rest = F.left(t, at - 1), F.substring(t, at, F.lit(1)), F.substring(t, at + 1, F.length(t))
        low = F.lower(c)
        keys = F.element_at(table(KEYBOARD), low) if keyboard else F.lit(None).cast("string")
        other = F.coalesce(F.substring(keys, (draw("key", i) % F.length(keys)).cast("int") + 1, F.lit(1)), F.element_at(table(SCANNED), low))
        cased = F.coalesce(F.when(c != low, F.upper(other)).otherwise(other), c)
        swapped = F.concat(head, F.left(rest, F.lit(1)), c, F.substring(rest, F.lit(2), F.length(rest)))
        out = F.when(kind == 0, F.when(F.length(t) > 2, F.concat(head, rest)).otherwise(t)).when(kind == 1, F.concat(head, c, c, rest)).when(kind == 2, F.concat(head, cased, rest)).otherwise(swapped)
        return F.when(F.length(t) < 2, t).otherwise(out)

    hit = (draw("row") < int(share * (1 << 30))) & (F.length(text) >= 2)
    return F.when(hit, F.aggregate(F.sequence(F.lit(1), number), text, edit)).otherwise(text)
