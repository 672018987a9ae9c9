import hashlib
import random
import re

from placewright.llm.substrings import duplicated_words


def brute(rows, window=13):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, split):
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, split):
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and least[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=1, n=120):
    r = random.Random(seed)
    vocabulary = [f"w{k}é" if k % 5 == 0 else f"w{k}" for k in range(40)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(n):
        w = [r.choice(vocabulary) for _ in range(r.choice([0, 3, 12, 13, 14, 80]))]
        if r.random() < 0.5:
            a = r.randrange(40)
            w += passage[a : a + r.randrange(5, 30)] + [r.choice(vocabulary)] * r.choice([0, 30])
        rows.append((i, r.choice([" ", "\n", "\t  "]).join(w)))
    rows += [(n, rows[5][1]), (n + 1, None), (n + 1, " ".join(passage)), (3, " ".join(passage)), (None, " ".join(passage)), (n, rows[5][1]), (-4, "x " * 40), (n + 9, "x " * 30)]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, g int")
    got = sorted(map(tuple, duplicated_words(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    assert got == brute(rows)
    whole = {r.doc_id: r for r in duplicated_words(docs).collect() if r.doc_id == 119}
    for r in whole.values():
        assert r.n_removed == sum(s["end"] - s["first"] for s in r.spans)


def test_empty(spark):
    assert duplicated_words(spark.createDataFrame([], "doc_id long, text string")).count() == 0
