import random
import re

from placewright.llm.jaccard import jaccard_components


def brute(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[s : s + k]) for s in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            x = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and x and den * x >= num * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), None if d is None else least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed=3):
    r = random.Random(seed)
    base = [[f"W{r.randrange(500)}" for _ in range(r.choice([1, 2, 3, 5, 6, 8, 9, 12, 30, 80, 200]))] for _ in range(30)]
    rows = []
    for i in range(260):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            w[r.randrange(len(w))] = f"w{r.randrange(9)}"
        rows.append((i, " ".join(w)))
    return rows + [(300, None), (301, ""), (None, rows[0][1]), (5, rows[9][1]), (5, rows[5][1]), (7, rows[7][1])]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, digest string")
    for k, num in ((4, 85), (5, 80)):
        got = sorted(map(tuple, jaccard_components(docs, k, num, 100).collect()), key=str)
        want = brute(rows, k, num, 100)
        assert got == want


def test_empty(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_cluster_in_chunks(spark, monkeypatch):
    import placewright.llm.jaccard as module

    monkeypatch.setattr(module, "CHUNK", 9000)
    monkeypatch.setattr(module, "LIGHT", 6)
    r = random.Random(11)
    base = [f"w{r.randrange(900)}" for _ in range(60)]
    rows = []
    for i in range(220):
        w = list(base) + [f"v{r.randrange(50)}" for _ in range(r.randrange(25))]
        for _ in range(r.randrange(5)):
            w[r.randrange(len(w))] = f"u{r.randrange(400)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(docs, 5, 80, 100).collect()), key=str) == brute(rows, 5, 80, 100)


def test_large_clusters_by_chunks(spark, monkeypatch):
    """Chains and groups of copies in one cluster that is dealt into many chunks, against plain sets."""
    import random

    from placewright.llm import jaccard

    monkeypatch.setattr(jaccard, "CHUNK", 3000)
    r = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for g in range(6):  # groups far from each other that share most words, so that signatures may join them
        own = [w if r.random() < 0.85 else f"g{g}{w}" for w in base]
        for _ in range(12):
            w = list(own)
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = f"x{r.randrange(9999)}"
            rows.append(" ".join(w))
    walk = list(base)
    for step in range(30):  # a chain, each near the last only
        walk[(step * 7) % 120] = f"c{step}"
        rows.append(" ".join(walk))
    rows += rows[:5]
    got = {x.doc_id: x.component_id for x in jaccard.jaccard_components(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), k=2, num=80, den=100).collect()}
    sets = [{tuple(t.split()[i : i + 2]) for i in range(len(t.split()) - 1)} for t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    assert got == {i: root(i) for i in range(len(rows))}
    assert len(set(got.values())) > 3


def sendings(spark, monkeypatch, rows, **sizes):
    """Components by 80 of 100 over five-word shingles, and how often sets were sent to be compared."""
    import placewright.llm.jaccard as module

    for name, value in sizes.items():
        monkeypatch.setattr(module, name, value, raising=False)
    sent, durable = [], module.durable

    def counted(df, *args):
        out = durable(df, *args)
        if "tasks" in out.columns:
            sent.append(out.selectExpr("sum(size(tasks))").first()[0] or 0)
        return out

    monkeypatch.setattr(module, "durable", counted)
    got = sorted(map(tuple, module.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100).collect()), key=str)
    return got, sum(sent)


def test_a_common_line_brings_no_sets_together(spark, monkeypatch):
    """Documents alike in one line only are compared with nothing, copies that hold it still are, and so are texts of little else."""
    r = random.Random(5)
    line = " ".join(f"line{i}" for i in range(12))
    rows = []
    for i in range(400):
        w = [f"w{r.randrange(99999)}" for _ in range(60)]
        w[r.randrange(60)] += f" {line}"
        rows.append((i, " ".join(w)))
    for i in range(40):
        w = rows[7 * i][1].split()
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = f"x{i}"
        rows.append((400 + i, " ".join(w)))
    for i in range(60):  # the line and a few words
        rows.append((500 + i, " ".join([f"y{r.randrange(9)}" for _ in range(r.randrange(4))] + [line] + [f"z{r.randrange(9)}" for _ in range(r.randrange(3))])))
    got, sent = sendings(spark, monkeypatch, rows, CHUNK=9000, LIGHT=6, OFTEN=24)
    assert got == brute(rows, 5, 80, 100)
    assert 40 <= sent < 400
