import hashlib
import zlib

import pytest

from placewright.llm.merkle import leaf_of, manifest, tampered_text

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grow(leaves):
    """Levels of a tree, and for each leaf the runs above it: (place in the run, the run)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    ways = []
    for i in range(len(leaves)):
        way = []
        for d in levels[:-1]:
            way.append((i % 8, d[i - i % 8 : i - i % 8 + 8]))
            i //= 8
        ways.append(way)
    return levels[-1][0], ways


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, out = {}, []
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, sha(*map(told, (r[0], r[3], r[2], r[4], r[1]))), r) for r in rows if r[2] == lang), key=lambda x: x[:3])
        trees[lang] = (own, *grow([x[2] for x in own]))
    root, tops = grow([trees[lang][1] for lang in langs])
    for lang, top in zip(langs, tops, strict=True):
        own, subroot, ways = trees[lang]
        for (_, _, leaf, r), way in zip(own, ways, strict=True):
            proof = sha(*(d for p, run in way + top for k, d in enumerate(run) if k != p))
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = sha(*map(told, (r[0], r[3], r[2], r[4], text)))
            for p, run in way + top:
                now = sha(*run[:p], now, *run[p + 1 :])
            out.append((r[0], lang, leaf, subroot, root, proof, now, now == root))
    return out


def sample(n, langs):
    rows = [(i * 7 % 1000, f"Text {i} Äß Ü\n" * (i % 3), langs[i * i % len(langs)], None if i % 11 == 0 else f"s{i % 4}", None if i % 5 == 0 else i) for i in range(n)]
    rows += [(None, "A", "en", "s", 1), (None, None, None, None, None), (3, "", "é", "", 0), (3, "", "é", "", 0), (3, "B", "é", "", 0), (5, "lone", "zz", "s", 4)]
    return rows


@pytest.mark.parametrize(("n", "levels", "langs"), [(0, 4, ["en"]), (300, 1, ["en", "en", "de", None]), (600, 2, ["en", "en", "fr"]), (150, 1, [f"l{k}" for k in range(40)]), (90, 4, ["en", "de"])])
def test_brute(spark, n, levels, langs):
    rows = sample(n, langs)
    got = manifest(spark.createDataFrame(rows, SCHEMA), tampered_text(), levels)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows)))


def test_one_row_and_none(spark):
    one = manifest(spark.createDataFrame([(3, "Ab", "en", "s", 2)], SCHEMA), tampered_text()).collect()
    assert [tuple(r) for r in one] == brute([(3, "Ab", "en", "s", 2)])
    assert one[0].leaf == one[0].subroot == one[0].root and one[0].proof_sha256 == sha("")
    assert manifest(spark.createDataFrame([], SCHEMA), tampered_text()).count() == 0


def test_given_text_is_verified_and_names_may_clash(spark):
    rows = [(*r, 1, "x", {"a": 1}) for r in sample(60, ["en", "de"])] + [(8, "long " * 400_000, "en", "s", 9, 1, "x", {"a": 1})]
    docs = spark.createDataFrame(rows, SCHEMA + ", i long, key string, digest map<string,int>")
    got = manifest(docs)
    assert {r.verified for r in got.collect()} == {True} and got.count() == len(rows)


def test_leaf(spark):
    row = spark.createDataFrame([(1, "é")], "a long, b string").select(leaf_of(*(__import__("pyspark").sql.functions.col(c) for c in "ab")).alias("x")).first()
    assert row.x == sha("1:1", "2:é")
