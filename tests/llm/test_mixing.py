from pyspark.sql import functions as F

from placewright.llm.mixing import apply_mix, mix


def targets(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = rest / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if share * weight[s] > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in full else share * weight[s] for s in names}
        full |= more


def docs(spark):
    rows = [(i, " ".join(["w"] * (i * 7 % 300)), "big" if i % 3 else f"s{i % 15}", 1, "c") for i in range(900)]
    rows += [(1, None, "s0", 1, "c"), (None, "a b", None, 1, "c"), (None, "a b", None, 1, "c"), (2, "", "empty", 1, "c")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, shard string")


def test_mix(spark):
    rows, df = docs(spark)
    got = mix(df, shard_words=9000).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    taken = dict.fromkeys(want, 0)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum((x["end"] - x["first"]) * x["copies"] for x in r.ranges)
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.05 * t + 130, (s, t, taken[s])
    again = mix(df.repartition(7), shard_words=9000)
    key = lambda f: sorted((str(r.doc_id), r.size, r.taken) for r in f)
    assert key(again.collect()) == key(got)
    out = apply_mix(df)
    assert out.columns == df.columns
    n = out.agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert n == mix(df).agg(F.sum("taken")).first()[0]


def test_empty(spark):
    e = spark.createDataFrame([], "doc_id long, text string, source string, n_chars long")
    assert mix(e).count() == 0 and apply_mix(e).count() == 0


def test_clashing_columns(spark):
    names = ["size", "ranges", "row", "h", "_h", "_row", "twin", "epoch", "own", "doc", "taken", "shard", "key"]
    rows = [(i, f"w{i} " * (i % 9), f"s{i % 2}", *(i for _ in names)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    out = apply_mix(df)
    assert out.columns == df.columns and out.where(" or ".join(f"{n} <> doc_id" for n in names)).count() == 0 and out.count() > 0


def test_quotas_are_sainte_lague(spark):
    # One shard whose blocks are single words: quotas are those of the highest quotients, one seat at a time.
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a"] * 30 + ["b"] * 5 + ["c"] * 12)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_words=1, shard_words=10**9).collect()
    blocks = {"a": 300, "b": 50, "c": 120}
    target = targets(blocks)
    seats, won = round(sum(target.values())), dict.fromkeys(blocks, 0)
    for _ in range(seats):
        open_ = [s for s in blocks if won[s] < 3 * blocks[s]]
        won[max(open_, key=lambda s: target[s] / (2 * won[s] + 1))] += 1
    taken = dict.fromkeys(blocks, 0)
    for r in got:
        taken[r.source] += r.taken
    assert all(abs(taken[s] - won[s]) <= 1 for s in blocks), (taken, won)
