import hashlib
import itertools
import random
import re
import zlib

import pytest

from placewright.llm.turns import damaged, repaired_conversations, repair

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256().hexdigest()


def harm(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        out += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return out


def brute(conv, rows):
    """By every sequence of edits, in order of cost and audit."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, r, x in rows:
        body = x.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((r, x))
    states = {("", 0, "", ())}  # initials, cost, audit, repaired turns
    rule = re.compile(r"(s?(ua)+)?")

    def more(states):
        out, front = set(states), set(states)
        for _ in range(3):
            front = {(i + n[0], c + 5, a + "I", t + (f"{n}:",)) for i, c, a, t in front for n in ("user", "assistant") if legal(i + n[0])}
            out |= front
        return out

    def legal(i):
        return re.fullmatch(r"(s?(ua)*u?)?", i) and (i == "" or i != "")

    def least(states):
        best = {}
        for x in states:
            k = (x[0][-1:], bool(x[0]))
            if k not in best or (x[1], x[2]) < (best[k][1], best[k][2]):
                best[k] = x
        return set(best.values())

    for (_, _, r, x), f in zip(rows, faults, strict=True):
        now, extra = set(), 5 * (f == "truncated")
        for i, c, a, t in more(states):
            now.add((i, c + 2, a + "D", t))
            if f in ("blank", "duplicate"):
                continue
            if r and legal(i + r[0]):
                now.add((i + r[0], c + extra, a + "K", t + (f"{r}:{x}",)))
            now |= {(i + n[0], c + 1 + extra, a + "R", t + (f"{n}:{x}",)) for n in ("user", "assistant") if legal(i + n[0])}
        states = least(now)
    i, cost, audit, turns = min((x for x in more(states) if rule.fullmatch(x[0])), key=lambda x: x[1:3])
    t = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    return (conv, max(t) - min(t) + 1 - len(set(t)) if t else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest())


def wanted(rows, given):
    return sorted(map(str, (brute(c, [r for r in rows if r[0] == c]) for c in {g[0] for g in given})))


def made(seed, n, long=0):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(9)]), rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "Dr"]), rng.choice(["Yes.", "No", "", None, " \t", "Ob?\n", "x y!", "é…", "Ä."])) for _ in range(n)]
    rows += [(77, k, rng.choice(["user", "assistant"]), rng.choice(["a.", f"b{k}!", f"c{k}", f"d{k}?"])) for k in range(long)]
    return rows


@pytest.mark.parametrize(("seed", "n", "long", "cut"), [(1, 60, 0, 8192), (2, 150, 40, 7), (3, 0, 300, 16), (4, 0, 0, 5), (5, 120, 25, 1)])
def test_brute(spark, seed, n, long, cut):
    rows = made(seed, n, long)
    got = repair(spark.createDataFrame(rows, SCHEMA), cut)
    want = wanted([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], rows)
    assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_damaged(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c}.") for c in range(60) for t in range(c % 7 + 1)] + made(6, 80)
    rows += [(c, 0, "user", "gone.") for c in range(1000, 1100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    given = spark.createDataFrame([(*r, 1, {"a": 1}) for r in rows], SCHEMA + ", pos long, blank map<string,int>")
    assert sorted(map(str, map(tuple, damaged(given).collect()))) == sorted(map(str, harm(rows)))
    got = repaired_conversations(given, damaged(given))
    assert sorted(str(tuple(r)) for r in got.collect()) == wanted(harm(rows), rows)
    gone = [c for c in {r[0] for r in rows} if not any(h[0] == c for h in harm(rows))]
    assert gone and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", EMPTY) for r in got.collect() if r.conv_id in gone)


def test_long_texts(spark):
    rows = [(1, 0, "user", "word " * 300_000 + "."), (1, 1, "assistant", "ok."), (1, 2, "user", "word " * 300_000 + "."), (1, 3, "assistant", " " * 500_000)]
    got = repair(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in got] == [brute(1, rows)]
