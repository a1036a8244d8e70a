import hashlib
import re

from doclattice.llm.pii import automaton, find, op3, personal_data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(s[::-1])) % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = [
        ("email", list(EMAIL.finditer(text))),
        ("ip", [m for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]),
        ("card", [m for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]),
        ("phone", [m for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]),
    ]
    written = ",".join(f"{k}:{m.start()}:{m.end()}" for k, found in kinds for m in found)
    return (*(len(f) for _, f in kinds), hashlib.sha256(written.encode()).hexdigest())


TEXTS = [
    None, "", "mail a.b@c.de, x@y z@w.x.", "a@b.c_d@e.f g@@h.i +@k.l", "1.2.3.4.5.6.7.8 300.1.1.1 1.1.1.0255 10.0.0.1x",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 12 34 56", "+49 (30) 123-4567 +1 2 +123456789012345678 +1+2 345 678 901", "é€ 4111111111111111+1 (555) 010-9999",
    "http://user:pw@host.example/x IBAN: DE89 3704 0044 0532 0130 00. account GB82WEST12345698765432", "1" * 5000, "@" * 3000, "a" * 3000 + "@b.c", "+1" + " " * 500, "1.2.3.4 " * 3,
    "٣.1.1.1.1 ٤111111111111111", "9" * 400 + ".1.1.1",
]


def test_small_cases(spark):
    rows = [(i, t, 0) for i, t in enumerate(TEXTS)] + [(None, "a@b.cd", 0), (2, TEXTS[2], 0)]
    got = sorted((r[:6] for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string, n_ip int")).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_own_kinds():
    kinds = [k for k, _, _ in find(TEXTS[8], automaton())]
    assert kinds.count("address") == 1 and kinds.count("account") == 2


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sorted(tuple(r)[:6] for r in op3(spark, d).collect())
    assert got == sorted((i, *brute(t)) for i, t in docs) and sum(sum(g[1:5]) for g in got) > 0
