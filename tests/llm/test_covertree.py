import numpy as np
import pytest

from placewright.llm.covertree import near_duplicates


def brute(rows, cosine):
    ok, seen = [], set()
    for k, (i, v) in enumerate(rows):
        fine = i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if fine and (i, tuple(v)) not in seen:
            seen.add((i, tuple(v)))
            ok.append(k)
    up = {k: k for k in ok}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    links = dict.fromkeys(ok, 0)
    for x in ok:
        for y in ok:
            if x < y and len(rows[x][1]) == len(rows[y][1]):
                a, b = np.array(rows[x][1], float), np.array(rows[y][1], float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                    links[x] += 1
                    links[y] += 1
                    up[find(x)] = find(y)
    least = {}
    for k in ok:
        least[find(k)] = min(least.get(find(k), rows[k][0]), rows[k][0])
    by = {(rows[k][0], tuple(rows[k][1])): (links[k], least[find(k)]) for k in ok}
    out = []
    for i, v in rows:
        n, c = by.get((i, tuple(v or ())), (0, i))
        out.append((i, n, c, i is not None and i == c))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [40, 5000])
def test_against_brute_force(spark, chunk):
    r = np.random.default_rng(1)
    rows = []
    for i in range(700):
        if i % 3 and i > 20:
            base = np.array(rows[int(r.integers(0, 12))][1])
            v = base + r.normal(size=8) * r.choice([0.01, 0.1, 0.3])
        else:
            v = r.normal(size=8)
        rows.append((i * 7 % 701, [float(np.float32(x)) for x in v]))
    rows += [(1000, rows[0][1]), (1001, [x * 4 for x in rows[0][1]]), (1002, None), (1003, []), (1004, [0.0] * 8), (1005, [float("nan")] + [1.0] * 7), (1006, [None] + [1.0] * 7)]
    rows += [(1007, [float("inf")] + [1.0] * 7), (None, rows[0][1]), (1008, [1.0, 2.0]), (1009, [1.0, 2.0001]), rows[5]] + [(2000 + k, rows[1][1]) for k in range(300)]
    vectors = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<double>, m long")
    got = sorted(map(tuple, near_duplicates(vectors, chunk=chunk).collect()), key=str)
    assert got == brute(rows, 0.95)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).first() == (1, 0, 1, True)
