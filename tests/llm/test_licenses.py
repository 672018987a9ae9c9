import random
import re

from placewright.llm.licenses import PHRASES, TEMPLATES, scan


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_base_places(spark):
    r = random.Random(5)
    parts = [*PHRASES, "GNU General Public", "mit", "License", "CC-BY 4.0", "the of", "é", "cc", "by", "apache"]
    rows = [(i, r.choice([" ", ", ", "\n"]).join(r.choice(parts) for _ in range(r.randrange(12)))) for i in range(300)]
    rows += [(400, None), (401, ""), (None, "MIT license"), (3, "mit license mit license"), (3, "mit license mit license")]
    got = scan(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, pos int")).collect()
    key = lambda x: str(x)
    assert sorted(((x.doc_id, x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) for x in got), key=key) == sorted(((i, *brute(t)) for i, t in rows), key=key)
    assert all(0 <= x.score <= 1 and set(filter(None, x.base_labels.split(","))) <= set(x.labels.split(",")) for x in got)


def test_templates_with_gaps(spark):
    rows = []
    for i, t in enumerate(TEMPLATES):
        w = re.findall(r"[a-z0-9]+", t.lower())
        if len(w) > 8:
            w = w[:4] + ["really"] + w[4:7] + w[8:]
        rows.append((i, "Some words before. " + " ".join(w) + " and after"))
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, label in enumerate(TEMPLATES.values()):
        assert label in got[i].labels.split(",")
    assert scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_exact_label_sets(spark):
    by, sa = "Creative Commons Attribution", "Creative Commons Attribution-ShareAlike"
    rows = [(f"see {by} 4.0", "cc-by"), (f"see {sa} 4.0", "cc-by-sa"), (f"{by} {sa}", "cc-by,cc-by-sa"), (f"{sa}, {by}", "cc-by,cc-by-sa")]
    rows += [("creative commons and attribution share alike", ""), ("Creative Commons Zero", "cc0"), ("GNU Affero General Public License", "agpl"), ("GNU Lesser General Public License", "lgpl")]
    rows += [("gnu lesser general words public license", ""), (f"{by} Share Alike", "cc-by-sa")]
    got = scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")).collect()
    assert [r.labels for r in sorted(got, key=lambda r: r.doc_id)] == [x for _, x in rows]


def test_whole_texts(spark):
    from placewright.llm.license_texts import TEXTS

    rows = [(i, "Notes first.\n" + re.sub(r"\s+", "\n// ", t) + "\nint main();") for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (text, label) in enumerate(TEXTS.items()):
        assert got[i].labels.split(",") == [label] and got[i].score == 1.0
        n = len(re.findall(r"[a-z0-9]+", text.lower()))
        assert any(s.label == label and s.first <= 3 and s.end >= n for s in got[i].spans)
