import hashlib
import math
import re

import pytest

from placewright.llm.privacy import entities, personal_data, shape

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: The patterns as they are given.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0):
                continue
            out.append((kind, *m.span(), m[0].lower() if kind == "email" else m[0] if kind == "ip" else d))
    return out


def brute(rows, window=8, support=2, disclosed=0.9):
    texts = [t or "" for _, t in rows]
    held, with_term, shown = {}, {}, {}
    for i, text in enumerate(texts):
        words = {w for w in re.findall(WORD, "".join(c.lower() if c < "\x80" else c for c in text))}
        for t in words | {shape(w) for w in words}:
            with_term.setdefault(t, set()).add(i)
        found = plain(text)
        taken = {p for _, a, b, _ in found for p in range(a, b)}
        own = [(m.start(), m.end(), m[0].translate({c: c + 32 for c in range(65, 91)})) for m in WORD.finditer(text) if not taken & set(range(*m.span()))]
        for kind, a, b, v in found:
            e = f"{kind}:{v}"
            held.setdefault(e, set()).add(i)
            near = tuple(t for x, _, t in ([o for o in own if o[0] < a][-window:] + [o for o in own if o[0] >= b][:window]))
            for t in {*near, *map(shape, near)}:
                shown.setdefault((e, t), set()).add((i, near))
    n = len(texts)

    def high(e, t):
        both = len({i for i, _ in shown[e, t]})
        return math.log2(n * both / (len(held[e]) * len(with_term[t]))) >= disclosed * math.log2(n / len(held[e]))

    rules = {(e, t): (e, shape(t)) not in shown or not high(e, shape(t)) for e, t in shown if t[0] != "~" and len({c for _, c in shown[e, t]}) >= support and high(e, t)}
    out = []
    for i, (d, _) in enumerate(rows):
        found = plain(texts[i])
        base = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found)
        taken = {p for _, a, b, _ in found for p in range(a, b)}
        mine = {}
        for (e, t), general in rules.items():
            if i in {j for j, _ in shown[e, t]}:
                mine[t] = min(mine.get(t, True), general)
        terms = [(m.start(), m.end(), w, mine[w]) for m in WORD.finditer(texts[i]) if (w := m[0].translate({c: c + 32 for c in range(65, 91)})) in mine and not taken & set(range(*m.span()))]
        spans = ",".join([base] * bool(base) + [f"term:{a}:{b}" for a, b, _, _ in terms])
        out.append((d, *(sum(f[0] == k for f in found) for k in PLAIN), hashlib.sha256(base.encode()).hexdigest(), spans, terms))
    return out


def corpus():
    mail, phone = "Ann.Lee@mail.example.com", "+1 (555) 010-9999"
    rows = [(i, f"Zorblatt Äquator {i % 7} met {mail} by the old mill number {i} today") for i in range(3)]
    rows += [(10 + i, f"the clinic {'Quuxville 987654321987' if i else 'qUUXville 987654321987'} called {phone} about day {i}; Quuxville is far") for i in range(4)]
    rows += [(30 + i, f"the old mill by the river number {i}, called today about {i * i} and the clinic; I met the mountain at Élevage with waterfall") for i in range(40)]
    rows += [(90, None), (91, ""), (92, "4111 1111 1111 1111 and 4111-1111-1111-1112; 10.0.0.255 not 10.0.0.256"), (None, f"{mail}{mail} a@b @c.d@e.f.g"), (93, "copy 1.2.3.4 Hapax"), (94, "copy 1.2.3.4 Hapax"), (94, "copy 1.2.3.4 Hapax")]
    return rows


def test_entities():
    for text in ["a@b.c@d.e x@y..z %@-.- é@a.b a@b.c.d. @a.b@c.d", "1.2.3.4.5.6.7.8 01.002.0003.0000255 1.2.3.999.1.1.1.1 1..2.3.4", "+1234567 +12 345-678.(9) +1((((( +", "5500 0000 0000 0004 5500-0000-0000-00040 12  34", "+1 4111111111111111 +49 30 1234-5678 a.b@c.de"]:
        assert entities(text) == plain(text), text


def test_brute(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, {"a": 1}, "x") for r in rows], SCHEMA + ", id long, terms map<string,int>, base string")
    got = [(*tuple(r)[:7], [tuple(t[k] for k in ("a", "b", "t", "general")) for t in r.terms]) for r in personal_data(docs).collect()]
    want = brute(rows)
    assert sorted(map(str, got)) == sorted(map(str, want))
    found = {t for r in want for _, _, t, _ in r[7]}
    assert {"zorblatt", "quuxville"} <= found and not found & {"the", "hapax", "mill"}


def test_clean(spark):
    got = {r.doc_id: r.clean for r in personal_data(spark.createDataFrame(corpus(), SCHEMA), text=True).collect()}
    assert got[0].startswith("[word of 8] [term of 8] 0 met [EMAIL] by") and got[90] is None and got[91] == ""
    assert got[92] == "[CARD] and 4111-1111-1111-1112; [IP] not 10.0.0.256" and got[30] == corpus()[7][1]
    assert "987654321987" not in got[10] and "[PHONE]" in got[10]


@pytest.mark.parametrize("long", ["1" * 300_000, "a." * 200_000, "1." * 200_000, "+" * 200_000, "@a." * 100_000, "1 " * 200_000])
def test_long_texts(long):
    assert entities(f"{long} x@y.zz")[-1][0] in ("email", "ip", "card", "phone")


def test_empty(spark):
    assert personal_data(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    got = [tuple(r)[:7] for r in personal_data(docs).collect()]
    assert sorted(map(str, got)) == sorted(str(w[:7]) for w in want)
