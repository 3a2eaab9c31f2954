"""Spans against plain Python, over odd and generated texts, and the query against its SQL."""

import hashlib
import re

import numpy as np

from judgeset.llm import pii as P

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def luhn(d):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def iban(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


CHECKS = {
    "email": lambda m: True,
    "ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
    "card": lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
    "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15,
    "iban": iban,
    "ssn": lambda m: m[:3] not in ("000", "666") and m[0] != "9" and m[4:6] != "00" and m[-4:] != "0000",
    "tel": lambda m: True,
    "secret": lambda m: bool(re.search("[0-9]", m) and re.search("[A-Za-z]", m)),
}


def brute_force(text):
    found, text = [], text or ""
    for rank, k in enumerate(P.KINDS):
        matches = [(m.start(), m.end()) for m in re.finditer(k.plain, text)]
        for i, (s, e) in enumerate(matches):
            before = text[matches[i - 1][1] if i else 0 : s][-40:]
            after = text[e : matches[i + 1][0] if i + 1 < len(matches) else len(text)][:24]
            if not CHECKS[k.name](text[s:e]):
                continue
            if k.edges and (re.search(k.edges[0].replace("\\z", "\\Z"), before) or re.search(k.edges[1], after)):
                continue
            near = f"{before}|{after}".translate(str.maketrans(UP, LOW))
            says = lambda words, near=near: bool(words) and any(re.search(f"(?<![a-z]){re.escape(w)}(?![a-z])", near) for w in words.split("|"))
            points = max(0, min(100, k.points + 40 * says(k.raises) - 40 * says(k.lowers)))
            if k.base or points >= 50:
                found.append((s, rank, e, points))
    return sorted(found)


def report(doc_id, text):
    found = brute_force(text)
    names = [k.name for k in P.KINDS]
    joined = lambda spans: ",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in spans)
    base = [x for x in found if x[1] < 4]
    return (doc_id, *[sum(x[1] == k for x in base) for k in range(4)], hashlib.sha256(joined(base).encode()).hexdigest(), joined(found), len(found) - len(base), ",".join(str(x[3]) for x in found))


PLANTED = (
    "Mail me: ann.lee+x@mail.example.co.uk_b@c.de, or call 555-123-4567 (fax +1 (017) 555-7713). Host 10.0.0.255, version 1.2.3.4, 256.1.1.1, 1.2.3.4.5.6.7.8. "
    "Card 4111 1111 1111 1111 order 4111111111111112 IBAN DE89 3704 0044 0532 0130 00 AND GB82WEST12345698765432, DE88370400440532013000. SSN 123-45-6789 and a good many other words, part 123-45-6789, 666-12-1234 ssn\n"
    'é token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" and a good many other words, commit 9b0b3c6a43eb78aa99cbd7049c572391524f37a8 123-456-7890 tel\n+49 30 12'
)


def test_fuzz_and_planted(spark):
    rng = np.random.default_rng(11)
    parts = [*"ab1.@-+ _(9", "é", "\n", "call ", "ssn ", "10.0.0.1", "123-45-6789", "555-123-4567", "4111111111111111", "a@b.c", "_d@e.f", "DE89370400440532013000", "+1 555 123 4567", "token ", "x9" * 11, " order "]
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), int(rng.integers(0, 60)))) for _ in range(600)]
    texts += [PLANTED, None, "", " ", "İ \U0001f600 a@b.c", "+1+1 22 333 444+", "1" * 30, "a@b.c@d.e@f.g", "x" * 20 + "9"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in P.pii_report(df).collect())
    want = sorted(report(*r) for r in rows)
    assert [x for x in zip(got, want) if x[0] != x[1]] == []
    planted = brute_force(PLANTED)
    assert {P.KINDS[k].name for _, k, _, _ in planted} == set(P.RANK) and sum(P.KINDS[k].name == "iban" for _, k, _, _ in planted) == 2


def test_very_long_texts(spark):
    """Runs without end, which plain expressions would go over again from each character, and more spans than a portion holds."""
    texts = ["1" * 300_000, "a" * 300_000, "+1" + "(" * 200_000, "ab@cd.ef " * 1000 + "x", "- " * 5000 + "+1 555 123 4567", "4" + " 4" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(len(texts))
    got = {r["doc_id"]: r["spans"] for r in P.pii_report(df).collect()}
    assert got == {0: "", 1: "", 2: "", 3: ",".join(f"email:{9 * i}:{9 * i + 8}" for i in range(1000)), 4: "phone:10000:10015", 5: ""}


def test_odd_rows(spark):
    """Null ids and texts, repeated rows, empty tables and columns of the operator's own names."""
    rows = [(None, "a@b.c", 1, 2), (3, "a@b.c", 1, 2), (3, "a@b.c", 1, 2), (4, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, joined int, points int")
    assert sorted(r["spans"] for r in P.pii_report(df).collect()) == ["", "email:0:5", "email:0:5", "email:0:5"]
    out = P.find_pii(df)
    assert out.columns == [*df.columns, "pii"] and out.count() == 4
    assert P.pii_report(df.limit(0)).count() == 0 and P.redact(df.limit(0)).count() == 0
    clash = df.withColumnRenamed("points", "pii")
    hidden = P.redact(clash)
    assert hidden.columns == clash.columns
    assert sorted((r["text"] or "", r["pii"] or 0) for r in hidden.collect()) == [("", 0), ("*****", 2), ("*****", 2), ("*****", 2)]


def test_redacted_text(spark):
    df = spark.createDataFrame([(1, PLANTED), (2, "no data"), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in P.redact(df).collect()}
    covered = {i for s, _, e, _ in brute_force(PLANTED) for i in range(s, e)}
    assert got == {1: "".join("*" if i in covered else c for i, c in enumerate(PLANTED)), 2: "no data", 3: ""}


def test_query_and_plan(spark, against_oracle):
    against_oracle("op11_pii", "/root/testdata/sf0.01")
    plan = P.op11_pii(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan
