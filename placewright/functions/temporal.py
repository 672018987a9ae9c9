"""Years of uncertain and open-ended spans. A span has start and end with in, earliest, latest; an absent bound is open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOUNDS = ("in", "earliest", "latest")
#: Plausible years by source; others use the default with an upper end of the current year + 100.
CLAMP_DEFAULT, CLAMP = -10_000, {"po": (-5_000_000_000, 10_000)}
OPEN_START, OPEN_END = -9999, 9999


def _end(**bounds: Column | None) -> Column:
    return F.struct(*((bounds.get(b.replace("in", "in_")) if bounds.get(b.replace("in", "in_")) is not None else F.lit(None).cast("long")).alias(b) for b in BOUNDS))


def span(s_in=None, s_earliest=None, s_latest=None, e_in=None, e_earliest=None, e_latest=None) -> Column:
    """A span of six optional year columns."""
    return F.struct(_end(in_=s_in, earliest=s_earliest, latest=s_latest).alias("start"), _end(in_=e_in, earliest=e_earliest, latest=e_latest).alias("end"))


def _none() -> Column:
    return F.array().cast("array<struct<start:struct<in:bigint,earliest:bigint,latest:bigint>,end:struct<in:bigint,earliest:bigint,latest:bigint>>>")


def attested_at(year: Column) -> Column:
    """Known to exist in a year: began by it, ended no earlier. Null: no span."""
    return F.when(year.isNotNull(), F.array(span(s_latest=year, e_earliest=year))).otherwise(_none())


def attested_window(a: Column, b: Column) -> Column:
    """Attested in both years (one may be null, either may come first)."""
    first, last = F.least(a, b), F.greatest(a, b)
    return F.when(first.isNotNull(), F.array(span(s_latest=last, e_earliest=first))).otherwise(_none())


def lifespan(start: Column, end: Column) -> Column:
    """Known start and end; with only an end, the start is no later."""
    late = F.when(start.isNull(), end)
    return F.when(start.isNotNull() | end.isNotNull(), F.array(span(s_in=start, s_latest=late, e_in=end))).otherwise(_none())


def bounded(se: Column, sl: Column, ee: Column, el: Column) -> Column:
    """Start and end within bounds; equal bounds are exact, an empty start closes at the end's first bound."""
    no_start = se.isNull() & sl.isNull()
    late = F.when(no_start, F.coalesce(ee, el)).otherwise(sl)
    s_in, e_in = F.when(se == sl, se), F.when(ee == el, ee)
    loose = lambda x, exact: F.when(exact.isNull(), x)
    body = span(s_in, loose(se, s_in), loose(late, s_in), e_in, loose(ee, e_in), loose(el, e_in))
    return F.when(F.coalesce(se, sl, ee, el).isNotNull(), F.array(body)).otherwise(_none())


def coerce_year(text: Column) -> Column:
    """The year of `2022`, `+1200`, `2022-01-01`, `-0049-03-15`; else null."""
    m = lambda g: F.regexp_extract(text, r"^\s*([+-]?)(\d+)(-.*)?\s*$", g)
    return F.when(m(2) != "", F.expr("1") * F.when(m(1) == "-", F.lit(-1)).otherwise(F.lit(1)) * m(2).try_cast("long")).cast("long")


def possibly(s: Column, first: int | None, last: int | None) -> Column:
    """May overlap [first, last]: outer bounds, an absent one (neither outer nor exact) is open."""
    start, end = F.coalesce(s["start"]["earliest"], s["start"]["in"]), F.coalesce(s["end"]["latest"], s["end"]["in"])
    out = F.lit(True)
    if last is not None:
        out = out & F.coalesce(start <= last, F.lit(True))
    return out & F.coalesce(end >= first, F.lit(True)) if first is not None else out


def definitely(s: Column, first: int | None, last: int | None) -> Column:
    """Must overlap [first, last]: inner bounds, an absent one fails."""
    start, end = F.coalesce(s["start"]["latest"], s["start"]["in"]), F.coalesce(s["end"]["earliest"], s["end"]["in"])
    out = F.lit(True)
    if last is not None:
        out = out & F.coalesce(start <= last, F.lit(False))
    return out & F.coalesce(end >= first, F.lit(False)) if first is not None else out


def undated(s: Column) -> Column:
    """None of the six fields is set."""
    return F.coalesce(*(s[e][b] for e in ("start", "end") for b in BOUNDS)).isNull()


def precision_bounds(year: Column, precision: Column) -> tuple[Column, Column]:
    """First and last year of a decade (8), century (7) or millennium (6); the year itself from 9 up; else nulls."""
    size = F.when(precision >= 9, 1).when(precision == 8, 10).when(precision == 7, 100).when(precision == 6, 1000)
    low = (F.floor(year / size) * size).cast("long")
    return low, (low + size - 1).cast("long")


def outer_range(spans: Column) -> tuple[Column, Column]:
    """Least outer start and largest outer end; open (null) if any span is open there."""
    start = F.transform(spans, lambda s: F.coalesce(s["start"]["earliest"], s["start"]["in"]))
    end = F.transform(spans, lambda s: F.coalesce(s["end"]["latest"], s["end"]["in"]))
    closed = lambda a: ~F.exists(a, lambda x: x.isNull())
    return F.when(closed(start), F.array_min(start)), F.when(closed(end), F.array_max(end))


def core_range(spans: Column) -> tuple[Column, Column]:
    """Least inner start and largest inner end among spans that have both."""
    inner = F.transform(spans, lambda s: F.struct(F.coalesce(s["start"]["latest"], s["start"]["in"]).alias("a"), F.coalesce(s["end"]["earliest"], s["end"]["in"]).alias("b")))
    both = F.filter(inner, lambda x: x["a"].isNotNull() & x["b"].isNotNull())
    return F.array_min(F.transform(both, lambda x: x["a"])), F.array_max(F.transform(both, lambda x: x["b"]))


def clamp(namespace: Column, year: Column, current_year: int) -> Column:
    """The year if it is plausible for its source, else null."""
    low = F.when(namespace == "po", F.lit(CLAMP["po"][0])).otherwise(F.lit(CLAMP_DEFAULT))
    high = F.when(namespace == "po", F.lit(CLAMP["po"][1])).otherwise(F.lit(current_year + 100))
    return F.when(year.between(low, high), year)


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Jaccard of two year ranges in [0, 1]: an open end takes the other's; where both are open that side adds nothing; a range open on both sides gives 0."""
    s0, s1, e0, e1 = F.coalesce(a0, b0), F.coalesce(b0, a0), F.coalesce(a1, b1), F.coalesce(b1, a1)
    s0, s1 = F.coalesce(s0, F.least(e0, e1)), F.coalesce(s1, F.least(e0, e1))
    e0, e1 = F.coalesce(e0, F.greatest(s0, s1)), F.coalesce(e1, F.greatest(s0, s1))
    shared, total = F.least(e0, e1) - F.greatest(s0, s1), F.greatest(e0, e1) - F.least(s0, s1)
    dated = F.coalesce(a0, a1).isNotNull() & F.coalesce(b0, b1).isNotNull()
    return F.when(~dated | (shared < 0), 0.0).when(total <= 0, 1.0).otherwise(shared / total)


def _year(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("long")


def empty(end: Column) -> Column:
    """A bound of which nothing is set."""
    return end.isNull() | F.coalesce(*(end[b] for b in BOUNDS)).isNull()


def closed(spans: Column) -> Column:
    """Spans that have an end but no start begin no later than the end's tightest bound."""
    late = lambda s: F.coalesce(s["end"]["in"], s["end"]["earliest"], s["end"]["latest"])
    start = lambda s: F.when(empty(s["start"]), _end(latest=late(s))).otherwise(s["start"])
    return F.transform(spans, lambda s: F.struct(start(s).alias("start"), s["end"].alias("end")))


def coerced(spans: Column) -> Column:
    """Spans whose bounds are text, with years for them; spans in which no bound is a year are dropped."""
    end = lambda e: F.struct(*(coerce_year(e[b]).alias(b) for b in BOUNDS))
    years = F.transform(spans, lambda s: F.struct(end(s["start"]).alias("start"), end(s["end"]).alias("end")))
    return F.filter(years, lambda s: ~(empty(s["start"]) & empty(s["end"])))


def span_bounds(s: Column) -> Column:
    """A span's earliest and latest start, earliest and latest end; an exact year is both bounds of its end."""
    pick = lambda e, b: F.coalesce(s[e][b], s[e]["in"])
    return F.struct(pick("start", "earliest").alias("se"), pick("start", "latest").alias("sl"), pick("end", "earliest").alias("ee"), pick("end", "latest").alias("el"))


def shown_spans(spans: Column) -> Column:
    """(start, end, definite) of the dated spans: outer bounds, and inner ones if both are known."""
    core = lambda b: F.when(b["sl"].isNotNull() & b["ee"].isNotNull(), F.array(b["sl"], b["ee"]))
    dated = F.filter(F.transform(spans, span_bounds), lambda b: F.coalesce(b["se"], b["sl"], b["ee"], b["el"]).isNotNull())
    return F.transform(dated, lambda b: F.struct(b["se"].alias("start"), b["el"].alias("end"), core(b).alias("definite")))


def envelope(spans: Column) -> Column:
    """The least outer start and largest outer end that are known."""
    b = F.transform(spans, span_bounds)
    return F.struct(F.array_min(F.transform(b, lambda x: x["se"])).alias("start"), F.array_max(F.transform(b, lambda x: x["el"])).alias("end"))


def document_bounds(spans: Column, namespace: Column, current_year: int) -> Column:
    """se, sl, ee, el over a document's spans, implausible years unknown: an outer bound only if every span has it, the widest inner ones."""
    ok = lambda x: clamp(namespace, x, current_year)
    b = F.transform(spans, lambda s: F.struct(*(ok(span_bounds(s)[k]).alias(k) for k in ("se", "sl", "ee", "el"))))
    every = lambda k: ~F.exists(b, lambda x: x[k].isNull())
    values = lambda k: F.transform(b, lambda x: x[k])
    return F.struct(
        F.when(every("se"), F.array_min(values("se"))).alias("se"), F.array_min(values("sl")).alias("sl"), F.array_max(values("ee")).alias("ee"), F.when(every("el"), F.array_max(values("el"))).alias("el")
    )


def document_range(spans: Column, namespace: Column, current_year: int) -> Column:
    """start and end of all plausible years of a document, each null if no year stands at that end, and the number of implausible ones."""
    years = lambda e: F.array_compact(F.flatten(F.transform(spans, lambda s: F.array(*(s[e][b] for b in BOUNDS)))))
    fine = lambda e: F.filter(years(e), lambda y: clamp(namespace, y, current_year).isNotNull())
    pool = F.concat(fine("start"), fine("end"))
    return F.struct(
        F.when(F.size(fine("start")) > 0, F.array_min(pool)).alias("start"), F.when(F.size(fine("end")) > 0, F.array_max(pool)).alias("end"),
        (F.size(years("start")) + F.size(years("end")) - F.size(pool)).cast("long").alias("rejected"),
    )


def claimed(start: Column, start_precision: Column, end: Column, end_precision: Column, point: Column, point_precision: Column) -> Column:
    """Spans of dated claims: a known start or end, within its precision, else the point in time as an attestation."""

    def bounds(year: Column, precision: Column) -> tuple[Column, Column]:
        low, high = precision_bounds(year, F.coalesce(precision, F.lit(9)))
        return F.coalesce(low, year), F.coalesce(high, year)

    (sl, sh), (el, eh), (pl, ph) = bounds(start, start_precision), bounds(end, end_precision), bounds(point, point_precision)
    exact = sl.eqNullSafe(sh) & el.eqNullSafe(eh)
    return F.when(start.isNull() & end.isNull(), attested_window(pl, ph)).when(exact, lifespan(sl, el)).otherwise(bounded(sl, sh, el, eh))


def map_year(text: Column) -> Column:
    """The year of a map's date tag: 1850, 1850-03-15, -0500, ~1700, before:1200, or the first year of C19."""
    exact = _year(F.trim(text), r"(?i)^~?(?:(?:before|after|about|circa|ca)\s*:?\s*)?(-?\d{1,5})(?:[-/]\d{1,2})?(?:[-/]\d{1,2})?(?:T.*)?$")
    return F.coalesce(exact, (_year(F.trim(text), r"(?i)^C(\d{1,2})$") - 1) * 100)


def hijri_year(text: Column, first: int, last: int) -> Column:
    """The Gregorian year of the first three- or four-digit number: itself if it is about in the register's years, else converted; the middle of them if that lies far off."""
    h = _year(text, r"(1[0-9]{3}|[0-9]{3,4})")
    g = F.rint(h * 0.970224 + 621.5).cast("long")
    return F.when(h.between(first - 5, last + 5), h).when(g.between(first - 30, last + 30), g).when(h.isNotNull(), F.lit((first + last) // 2).cast("long"))


def sheet_years(surveyed: Column, published: Column) -> Column:
    """start and end of a map sheet: from its survey, else publication, to its publication, else survey; years of 1800 to 1999."""
    s, p = _year(surveyed, r"\b(1[89]\d{2})\b"), _year(published, r"\b(1[89]\d{2})\b")
    return F.struct(F.coalesce(s, p).alias("start"), F.coalesce(p, s).alias("end"))


def reign(start: Column, end: Column, first: int, last: int) -> Column:
    """A unit's lifespan within that of its empire, which bounds what isn't known."""
    f, l = F.lit(first).cast("long"), F.lit(last).cast("long")
    only_start, only_end = span(s_in=start, e_latest=l), span(s_earliest=f, s_latest=end, e_in=end)
    return F.when(start.isNull() & end.isNull(), F.array(span(s_earliest=f, e_latest=l))).when(end.isNull(), F.array(only_start)).when(start.isNull(), F.array(only_end)).otherwise(lifespan(start, end))


def listed(start: Column, end: Column, listing: int) -> Column:
    """A lifespan, in order; one without end is attested in the year of the listing, one without either only then."""
    a, y = F.least(start, end), F.lit(listing).cast("long")
    open_end = F.array(span(s_in=start, e_earliest=y))
    return F.when(start.isNull() & end.isNull(), attested_at(y)).when(start.isNull(), lifespan(start, end)).when(end.isNull(), open_end).otherwise(lifespan(a, F.greatest(start, end)))
