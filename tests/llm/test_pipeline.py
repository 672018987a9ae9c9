import re

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_substrings import brute as removed


def key(rows):
    return sorted(map(str, rows))


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [(9001, None, "en", "src0", None), (9002, "12 34", None, None, 5), (9003, "Solo", "en", None, 4), (9003, "Solo", "en", None, 4)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], sf).cache()
        out.count()
        seen.append(out)
    for f in seen[1:-1]:
        assert f.schema.simpleString() == docs.schema.simpleString()
    given, spoken, alone, cut, mixed, packed = ([tuple(r) for r in f.collect()] for f in seen)
    assert {r[0] for r in given} - {r[0] for r in spoken} == {9001, 9002}
    first = {d: c for d, _, c in groups([r[:2] for r in spoken], 5, 80, 100)}
    assert sorted(r[0] for r in alone) == sorted(d for d, c in first.items() if d == c)
    want = [x for x in removed([r[:2] for r in alone]) if x[1] > x[2]]
    got = {r[0]: r for r in cut}
    assert sorted(got) == sorted(x[0] for x in want)
    for d, n, gone, _ in want:
        assert len(re.findall(r"[^\x20\x09-\x0D]+", got[d][1])) == n - gone and got[d][4] == len(got[d][1])
    words = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in cut}
    taken = {}
    for r in mixed:
        taken[r[0]] = taken.get(r[0], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    assert all(n <= 3 * words[d] for d, n in taken.items())
    assert {r[0] for r in packed} == {r[0] for r in mixed}


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_unusual_documents_go(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa."
    short = [(i, " ".join(r.text.split()[:3])) for i, r in enumerate(docs.where("length(text) > 60").orderBy("doc_id").limit(200).collect(), 9_100_000)]
    junk = [(9_000_000, "xq zvkj qqxw jzzkq vxqwk zqj kkxz wvqq jxk zzq " * 3), (9_000_001, polish), (9_000_002, "ゆきがふる おおきなやまに ゆきがふる " * 4)]
    extra = spark.createDataFrame([(d, t, None, "src0", len(t)) for d, t in junk + short], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(extra), sf).select("doc_id").collect()}
    clean = {r.doc_id for r in docs.where(r"text rlike '\\p{L}'").select("doc_id").collect()}
    assert not kept & {d for d, _ in junk}
    assert len(clean - kept) <= len(clean) / 200
    assert len({d for d, _ in short} - kept) <= 2


def test_near_duplicates_keep_whole_rows(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen fourteen"
    rows = [(None, a, "en", "s1", 1), (None, a, "en", "s1", 1), (None, None, "de", "s2", 2), (7, b, "en", "s9", 3), (7, "quite another text without any copy here", "de", "s3", 4)]
    rows += [(8, b, "fr", "s4", 5), (3, "x y", "a", "z", 9), (3, "x y", "b", "c", 1), (5, None, "en", "s", None)]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "")
    want = [*rows[:5], (3, "x y", "a", "z", 9), rows[8]]
    assert key(tuple(r) for r in got.collect()) == key(want)


def test_further_columns_pass(spark, sf):
    """Names that stages use themselves, a column that can't be null, and a map."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    names = ["score", "held_out", "lang_pred", "typical", "_rid", "rid", "row", "doc", "n_words", "kept_text", "spans", "h", "size"]
    seen = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names], F.lit(5).alias("five"), F.create_map(F.lit("k"), F.col("doc_id")).alias("map"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, sf)
        assert out.columns == seen.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names) and all(r.five == 5 and r.map == {"k": r.doc_id} for r in rows)
    assert corpus_pipeline.packing(spark, seen, sf).count() > 0
