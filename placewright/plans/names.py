"""Queries of names, labels and writing systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels, script, text
from ..operators.distinct import computed_once
from .queries import query
from .views import Views

_FOLD = "replace(replace(strip_accents(lower({0})), 'ß', 'ss'), 'œ', 'oe')"


@query(f"SELECT doc_id, md5({_FOLD.format('text')}) AS folded FROM documents")
def folded_texts(v: Views) -> DataFrame:
    return v.documents.select("doc_id", F.md5(script.fold(F.col("text"))).alias("folded"))


@query(rf"SELECT doc_id, md5(regexp_replace({_FOLD.format('text')}, '[^\p{{L}}\p{{N}}]', '', 'g')) AS plain FROM documents")
def comparable_texts(v: Views) -> DataFrame:
    return v.documents.select("doc_id", F.md5(script.alnum(F.col("text"))).alias("plain"))


@query(r"""
WITH n AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Place ' || user_id WHEN 1 THEN 'Москва-' || user_id WHEN 2 THEN '北京 ' || user_id WHEN 3 THEN 'Αθήνα a' ELSE user_id::VARCHAR END AS name FROM events)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'LATIN' WHEN 1 THEN 'CYRILLIC' WHEN 2 THEN 'CJK' WHEN 3 THEN 'GREEK' ELSE 'OTHER' END AS script FROM n""")
def scripts_of_names(v: Views) -> DataFrame:
    k, u = F.col("event_id") % 5, F.col("user_id").cast("string")
    name = F.when(k == 0, F.concat(F.lit("Place "), u)).when(k == 1, F.concat(F.lit("Москва-"), u)).when(k == 2, F.concat(F.lit("北京 "), u)).when(k == 3, "Αθήνα a").otherwise(u)
    return v.events.select("event_id", script.detect(name).alias("script"))


@query(r"""
WITH d AS (SELECT lang, CASE WHEN regexp_matches(text, '\p{Latin}') THEN 'LATIN' ELSE 'OTHER' END AS script FROM documents)
SELECT script, coalesce(lang, '(none)') AS lang, count(*) AS n FROM d GROUP BY ALL ORDER BY n DESC, script, lang LIMIT 100""")
def scripts_by_language(v: Views) -> DataFrame:
    d = v.documents.select(script.detect(F.col("text")).alias("script"), F.coalesce("lang", F.lit("(none)")).alias("lang"))
    return d.groupBy("script", "lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "script", "lang").limit(100)


@query("""
WITH n AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'zh-Hans' WHEN 1 THEN 'ru' WHEN 2 THEN 'en' ELSE 'sr' END AS lang FROM events)
SELECT event_id FROM n WHERE lang NOT IN ('zh-Hans', 'ru')""")
def plausible_names(v: Views) -> DataFrame:
    k = F.col("event_id") % 4
    lang = F.when(k == 0, "zh-Hans").when(k == 1, "ru").when(k == 2, "en").otherwise("sr")
    return v.events.where(~script.mismatched(lang, script.detect(F.col("event_type")))).select("event_id")


@query("SELECT a.item_id AS a, b.item_id AS b, round(jaro_winkler_similarity(a.text[1:40], b.text[1:40]), 9) AS similarity FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1 WHERE regexp_matches(a.text || b.text, '^[ -~]*$')")
def winkler_neighbours(v: Views) -> DataFrame:
    b = v.benchmark.select((F.col("item_id") - 1).alias("item_id"), F.col("item_id").alias("b"), F.col("text").alias("other"))
    both = v.benchmark.join(b, "item_id").where(F.concat("text", "other").rlike(r"^[ -~]*$"))
    return both.select(F.col("item_id").alias("a"), "b", F.round(script.jaro_winkler(F.left("text", F.lit(40)), F.left("other", F.lit(40))), 9).alias("similarity"))


@query("SELECT gram, count(*) AS n FROM (SELECT unnest(list_transform(range(2, least(length(t), 20) + 1), lambda i: t[1:i])) AS gram FROM (SELECT unnest(regexp_extract_all(lower(p_name), '[a-z0-9]+')) AS t FROM part)) GROUP BY gram")
def name_beginnings(v: Views) -> DataFrame:
    token = v.part.select(F.explode(text.tokens(script.fold(F.col("p_name")))).alias("t"))
    return token.select(F.explode(script.edge_ngrams(F.col("t"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


@query("SELECT event_id, 'ㅎㅏㄴ' || CASE WHEN user_id % 2 = 0 THEN 'ㄱㅡㄹ' ELSE 'ㄱㅏ' END || event_type AS jamo, '한' AS first FROM events")
def hangul_names(v: Views) -> DataFrame:
    name = F.concat(F.lit("한"), F.when(F.col("user_id") % 2 == 0, "글").otherwise("가"), F.col("event_type"))
    jamo = script.decompose_hangul(name)
    first = script.compose_hangul(F.substring(jamo, 1, 1), F.substring(jamo, 2, 1), F.substring(jamo, 3, 1))
    return v.events.select("event_id", jamo.alias("jamo"), first.alias("first"))


@query("SELECT toponym_id FROM (SELECT DISTINCT toponym_id, name FROM t_att) WHERE length(name) <= 14 AND strlen(toponym_id) <= 16")
def names_within_limits(v: Views) -> DataFrame:
    return v.t_att.select("toponym_id", "name").distinct().where(text.within_limits(F.col("name"), F.col("toponym_id"), 14, 16)).select("toponym_id")


@query("""
WITH w AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) || '-ON-SEA' WHEN 1 THEN 'NORTH OF THE ' || upper(p_name) ELSE p_name END AS name FROM part),
c AS (SELECT p_partkey, name, list_transform(string_split(lower(name), ' '), lambda x, i: CASE WHEN i > 1 AND x IN ('and', 'of', 'the', 'on') THEN x ELSE upper(x[1]) || x[2:] END) AS words FROM w)
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN replace(array_to_string(words, ' '), '-on-sea', '-on-Sea') WHEN 1 THEN array_to_string(words, ' ') ELSE name END AS title FROM c""")
def titled_names(v: Views) -> DataFrame:
    k, up = F.col("p_partkey") % 3, F.upper("p_name")
    return v.part.select("p_partkey", labels.title_case(F.when(k == 0, F.concat(up, F.lit("-ON-SEA"))).when(k == 1, F.concat(F.lit("NORTH OF THE "), up)).otherwise(F.col("p_name"))).alias("title"))


@query(r"SELECT page_id, trim(regexp_replace(lower(trim(url)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM pages")
def page_slugs(v: Views) -> DataFrame:
    return v.pages.select("page_id", labels.slug(F.col("url")).alias("slug"))


@query("SELECT s_suppkey, variant FROM supplier, unnest([s_name, 'old ' || s_name]) t(variant) UNION ALL SELECT c_custkey, c_name FROM customer")
def name_variants(v: Views) -> DataFrame:
    both = v.supplier.select("s_suppkey", F.concat("s_name", F.lit(" - old "), "s_name").alias("name")).unionByName(v.customer.select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("name")))
    return both.select("s_suppkey", F.explode(labels.variants(F.col("name"))).alias("variant"))


@query("""
SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN 'by form' WHEN 2 THEN 'towns' WHEN 3 THEN NULL ELSE event_type || ' x' END AS label, event_id % 5 = 1 AS guide FROM events""")
def cleaned_terms(v: Views) -> DataFrame:
    k, e = F.col("event_id") % 5, F.col("event_type")
    term = F.when(k == 0, F.concat(F.upper(F.left(e, F.lit(1))), F.substring(e, F.lit(2), F.length(e)), F.lit(" (hierarchy name)"))).when(k == 1, "<things by form>").when(k == 2, "towns (Places)").when(k == 3, "aat:300").otherwise(F.concat(e, F.lit(" x")))
    return v.events.select("event_id", labels.clean_term(term, F.lit("places")).alias("c")).select("event_id", "c.label", "c.guide")


@query("""
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'footpath' WHEN 1 THEN 'church' WHEN 2 THEN 'spot-height' WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE 'quarry' END AS token,
  CASE event_id % 7 WHEN 0 THEN 'abbrev' WHEN 1 THEN 'keyword' WHEN 2 THEN 'numeric' WHEN 3 THEN 'illegible' WHEN 4 THEN 'allcaps-router' WHEN 5 THEN 'residual' ELSE 'keyword' END AS rule FROM events""")
def typed_labels(v: Views) -> DataFrame:
    k = F.col("event_id") % 7
    label = F.when(k == 0, "F. P.").when(k == 1, F.concat(F.col("event_type"), F.lit(" Church"))).when(k == 2, (F.col("user_id") % 1000).cast("string")).when(k == 3, "? ???").when(k == 4, F.upper("event_type")).when(k == 5, "Zorb").otherwise("Mill Stone Quarries")
    return computed_once(v.events.select("event_id", label.alias("label")), F.col("label"), labels.map_label, "l").select("event_id", "l.token", "l.rule")


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'church:0.486,road:0.514' WHEN 1 THEN 'mill:0.85,unknown:0.15' WHEN 2 THEN 'illegible:1.0' ELSE 'unknown:1.0' END AS kinds FROM events""")
def likely_kinds(v: Views) -> DataFrame:
    k = F.col("event_id") % 4
    label = F.when(k == 0, "Church Road").when(k == 1, "Mill").when(k == 2, "").otherwise("Zorb")
    shown = F.array_join(F.array_sort(F.transform(labels.likely_kinds(label), lambda x: F.concat(x["kind"], F.lit(":"), x["share"].cast("string")))), ",")
    return v.events.select("event_id", shown.alias("kinds"))


@query("""
WITH c AS (SELECT c, 2 + dense_rank() OVER (ORDER BY c) AS id FROM (SELECT DISTINCT unnest(string_split(lower(event_type), '')) AS c FROM events WHERE event_type <> 'view')),
n AS (SELECT DISTINCT event_type AS name FROM events), x AS (SELECT name, unnest(string_split(lower(name || ' a'), '')) AS c, unnest(range(1, length(name) + 3)) AS i FROM n)
SELECT name, string_agg(CASE WHEN x.c = ' ' THEN 2 ELSE coalesce(id, 1) END, ',' ORDER BY i) AS ids FROM x LEFT JOIN c ON c.c = x.c GROUP BY name""")
def encoded_names(v: Views) -> DataFrame:
    known = v.events.where("event_type <> 'view'").select(F.explode(F.split(F.lower("event_type"), "")).alias("c")).distinct()
    table = known.agg(F.array_sort(F.collect_set("c")).alias("c")).select(F.map_from_arrays("c", F.transform(F.sequence(F.lit(1), F.size("c")), lambda i: i + 2)).alias("vocabulary"))
    names = v.events.select(F.col("event_type").alias("name")).distinct().crossJoin(F.broadcast(table))  # one row, of an alphabet
    return names.select("name", F.array_join(labels.encode_characters(F.concat("name", F.lit(" a")), F.col("vocabulary")), ",").alias("ids"))


@query()
def noisy_names(v: Views) -> DataFrame:
    return v.part.select("p_partkey", "p_name", labels.noisy(F.col("p_name"), F.col("p_partkey")).alias("noisy"))


@query("SELECT p_partkey, p_name, true AS near FROM part")
def typing_noise(v: Views) -> DataFrame:
    """Every name noised: two edits change it by four letters at most."""
    noisy = labels.noised(F.col("p_name"), F.col("p_partkey"), 1.0)
    return v.part.select("p_partkey", "p_name", (F.levenshtein("p_name", noisy) <= 4).alias("near"))


@query("""
WITH n AS (SELECT *, CASE place_id[1:2] WHEN 'su' THEN 'en' WHEN 'cu' THEN 'de' END AS local FROM t_att)
SELECT place_id, coalesce(max(name) FILTER (WHERE lang = local), max(name) FILTER (WHERE lang = 'und')) AS local_name, max(name) FILTER (WHERE lang = 'en') AS name_en FROM n GROUP BY place_id""")
def display_names(v: Views) -> DataFrame:
    place = F.left("place_id", F.lit(2))
    return text.display_names(v.t_att.withColumn("local", F.when(place == "su", "en").when(place == "cu", "de")), ["en"]).select("place_id", "local_name", "name_en")
