import math
import re
import zlib
from collections import Counter

from placewright.llm.suffixtree import score_texts


def tokens(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]


def check(spark, rows):
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    c = Counter(x for (_, t), h in zip(rows, held) if not h for x in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), h, len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t)), 4)) for (d, t), h in zip(rows, held))
    got = score_texts(spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, g long")).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    return {r.doc_id: r for r in got}


def test_base_and_tree(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    seen = "The thing and the other\tthing."
    rows += [(9001, None), (9002, ""), (None, "The the"), (9001, None), (7001, seen), (7002, "qzx jvkq xxq wqpz\tqqzzvkj.")]
    got = check(spark, rows)
    assert got[7001].score > got[7002].score + 5 and got[9002].score == got[9001].score < 0
    held = [r for r in got.values() if r.held_out and r.n_tokens > 50]
    # in bits per byte the tree must beat a uniform choice of bytes by far
    size = {d: len((t or "").encode()) for d, t in rows}
    assert all(-r.score / math.log10(2) / size[r.doc_id] < 4.5 for r in held) and held


def tree_scores(rows, least, divergence, strength=8.0):
    """The method as its description has it, over dictionaries."""
    symbols = lambda t: [255] * 6 + list(re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode()) + [255]
    counts = [{} for _ in range(7)]
    for d, t in rows:
        if d is None or zlib.crc32(str(d).encode()) % 10:
            s = symbols(t)
            for i in range(6, len(s)):
                for k in range(7):
                    own = counts[k].setdefault(tuple(s[i - k : i]), Counter())
                    own[s[i]] += 1
    total = sum(counts[0].get((), Counter()).values())
    held = {}

    def p(context, x):
        if not context:
            return (counts[0].get((), Counter())[x] + 0.5) / (total + 128)
        if (context, x) in held:
            return held[context, x]
        parent = p(context[1:], x)
        own = counts[len(context)].get(context, Counter())
        n = sum(own.values())
        kept = n >= least and sum(c * math.log(c / n / p(context[1:], y)) for y, c in own.items()) >= divergence
        held[context, x] = (own[x] + strength * parent) / (n + strength) if kept else parent
        return held[context, x]

    out = []
    for d, t in rows:
        s = symbols(t)
        out.append((str(d), t or "", sum(math.log10(p(tuple(s[i - 6 : i]), s[i])) for i in range(6, len(s)))))
    return out


def test_tree_by_brute_force(spark):
    base = ["The thing that thinks", "a thin, thick thicket\tthat", "", None, "Ünter den Linden über", "xyxyxyxyxyxyxyxy", "that thing then", "öäü öäö ÖÄÜ"]
    rows = [(i, base[i % 8] if base[i % 8] is None else base[i % 8] * (1 + i % 5)) for i in range(120)] + [(None, "the the"), (500, "th"), (500, "th")]
    for least, divergence in ((4, 2.0), (32, 10.0)):
        want = sorted(tree_scores(rows, least, divergence))
        got = sorted((str(r.doc_id), t, r.score) for r, t in _beside(spark, rows, least, divergence))
        assert [(d, t) for d, t, _ in got] == [(d, t) for d, t, _ in want]
        for (_, t, a), (_, _, b) in zip(got, want):
            assert abs(a - b) <= (len(t.encode()) + 1) / 8192 + 1e-9


def _beside(spark, rows, least, divergence):
    """Scores with their texts: each document alone has its own held_out, ids repeat only with equal texts."""
    text = {}
    for d, t in rows:
        assert text.setdefault(d, t or "") == (t or "")
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return [(r, text[r.doc_id]) for r in score_texts(frame, least=least, divergence=divergence).collect()]


def test_without_training(spark):
    rows = [(d, "a b") for d in range(60) if zlib.crc32(str(d).encode()) % 10 == 0]
    check(spark, rows)
    assert score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rare_and_deep_contexts(spark):
    filler = "the and of it " * 9000
    rows = [(i, filler) for i in range(60)] + [(1000 + i, "xabcde1" if i % 2 else "yabcde2") for i in range(160)]
    rows += [(3000 + i, "жцша" if i % 2 else "гцшб") for i in range(160)]
    asked = {1: "xabcde1", 2: "xabcde2", 3: "жцша", 4: "жцшб"}
    held = {d: [i for i in range(5000, 9000) if zlib.crc32(str(i).encode()) % 10 == 0][d] for d in asked}
    got = {r.doc_id: r.score for r in score_texts(spark.createDataFrame(rows + [(held[d], t) for d, t in asked.items()], "doc_id long, text string")).collect()}
    # each pattern is a hundred-thousandth of all symbols, and its last letter depends on the sixth byte before it
    assert got[held[1]] > got[held[2]] + 0.5 and got[held[3]] > got[held[4]] + 0.5
