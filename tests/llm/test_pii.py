"""Pseudonyms: validity, format, linking, bijection, and clean text untouched."""

import datetime
import hashlib
import random
import re

from pyspark.sql import functions as F

from tessera.llm import pii
from tessera.llm.queries import QUERIES


def luhn(s):
    d = [int(c) for c in reversed(re.sub("[^0-9]", "", s))]
    return sum(x if i % 2 == 0 else (2 * x - 9 * (x > 4)) for i, x in enumerate(d)) % 10 == 0


def run(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], "doc_id long, text string, found string, new string")
    out = pii.pseudonymise(df, key)
    assert out.columns == df.columns
    return [r.text for r in out.orderBy("doc_id").collect()]


def test_formats_and_linking(spark):
    cases = ["4111 1111 1111 1111", "4111111111111111", "378282246310005", "3782-822463-10005", "152.143.123.131", "078-05-1120", "1984-02-29", "2001/12/31", "29.02.1984", "12/31/2001", "31/12/2001", "+1 (743) 555-3824", "+1 (152) 555-8590", "743-555-3824", "+49 30 123456", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "jo.x@mail5.example.com"]
    got = run(spark, [f"({c}), x {c}" for c in cases])
    for c, g in zip(cases, got, strict=True):
        m = re.fullmatch(r"\((.*)\), x (.*)", g)
        assert m and m[1] == m[2] != c, (c, g)
        if "@" in c:
            assert re.fullmatch(r"u[0-9a-f]{12}@mail5\.example\.com", m[1])
        elif c.count(".") == 3:
            assert all(0 <= int(x) <= 255 for x in m[1].split("."))
        else:
            assert re.sub("[0-9]", "9", c) == re.sub("[0-9]", "9", m[1])
    plain = [re.fullmatch(r"\((.*)\), x (.*)", g)[1] for g in got]
    assert all(luhn(x) for x in plain[:4])
    assert plain[0].replace(" ", "") == plain[1] and plain[2] == plain[3].replace("-", "")
    assert plain[11][4:].replace(") ", "-") == plain[13] or plain[11][-8:] == plain[13][-8:]
    day = datetime.date.fromisoformat(plain[6])
    assert day == datetime.datetime.strptime(plain[8], "%d.%m.%Y").date()
    assert datetime.datetime.strptime(plain[9], "%m/%d/%Y").date() == datetime.datetime.strptime(plain[7], "%Y/%m/%d").date()
    for x in plain[15:17]:
        s = x.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    assert run(spark, [cases[0]]) == [plain[0]] != run(spark, [cases[0]], "other")


def test_clean_and_odd_texts(spark):
    clean = [None, "", "no data", "4111111111111112", "300.1.2.3", "1.2.3", "2023-02-30", "1850-01-01", "666-12-3456", "v1.2.3.4.5", "call 12345", "a@b", "x" * 100000, "12 34 56 " * 2000, "DE00370400440532013000"]
    assert run(spark, clean) == clean
    card = "4785380592391139"
    long = run(spark, [("w " * 30000) + card + " " + card + "\n" + card])[0]
    assert card not in long and len(long) == 60000 + 3 * 16 + 2
    two = run(spark, ["4785380592391139 2123465659789240"])[0].split(" ")
    assert len(two) == 2 and two[0] != card and luhn(two[0])
    token = run(spark, ['token = "24be64439e3e49cf46b2d7c90f3602a3d0b907f1" x'])[0]
    assert re.fullmatch(r'token = "[0-9a-f]{40}" x', token) and "24be" not in token
    assert pii.pseudonymise(spark.createDataFrame([], "doc_id long, text string"), "k").count() == 0


def test_feistel_is_a_bijection(spark):
    for a, b in ((17, 4297), (10, 100), (898, 7)):
        n = a * b
        out = spark.range(n).select(pii.feistel("k", "t", F.col("id"), a, b).alias("x"))
        r = out.agg(F.countDistinct("x"), F.min("x"), F.max("x")).first()
        assert tuple(r) == (n, 0, n - 1)


def test_query_leaves_no_private_values(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op2_pii"](spark, sf).collect()}
    kinds = [r"\b[\w.]+@[\w.]+\b", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"\b\d{1,3}(?:\.\d{1,3}){3}\b"]
    found = 0
    for k, text in docs.items():
        values = {v for p in kinds for v in re.findall(p, text)} | {v for v in re.findall(r"\b\d{16}\b", text) if luhn(v)}
        found += len(values)
        assert not any(v in got[k].text for v in values)
        assert values or not got[k].changed or "token" in text
    assert found > 5 and got.keys() == docs.keys()


def number(key, kind, i, value, size):
    return int(hashlib.sha256(f"{key}|{kind}|{i}|{value}".encode()).hexdigest()[:15], 16) % size


def permuted(key, kind, value, a, b):
    left, right = divmod(value, b)
    for i in range(0, 8, 2):
        left = (left + number(key, kind, i, right, a)) % a
        right = (right + number(key, kind, i + 1, left, b)) % b
    return left * b + right


def permuted_digits(key, kind, d):
    half = len(d) // 2
    return d if len(d) < 2 else str(permuted(key, kind, int(d), 10**half, 10 ** (len(d) - half))).zfill(len(d))


def filled(form, d):
    it = iter(d)
    return re.sub("[0-9]", lambda _: next(it), form)


def checked(body):
    return next(c for c in "0123456789" if luhn(body + c))


def brute(key, kind, m):
    """The pseudonym of a valid value, by plain Python."""
    d = re.sub("[^0-9]", "", m)
    if kind == "card":
        body = d[0] + permuted_digits(key, "card", d[1:-1])
        return filled(m, body + checked(body))
    if kind == "ip":
        x = permuted(key, "ip", int.from_bytes(map(int, m.split(".")), "big"), 65536, 65536)
        return ".".join(map(str, x.to_bytes(4, "big")))
    if kind == "ssn":
        areas = [x for x in range(1, 900) if x != 666]
        x = permuted(key, "ssn", (areas.index(int(d[:3])) * 99 + int(d[3:5]) - 1) * 9999 + int(d[5:]) - 1, 898, 99 * 9999)
        return f"{areas[x // (99 * 9999)]:03}-{x // 9999 % 99 + 1:02}-{x % 9999 + 1:04}"
    if kind.startswith("%"):
        first = datetime.date(1900, 1, 1)
        n = (datetime.datetime.strptime(m, kind).date() - first).days
        return (first + datetime.timedelta(permuted(key, "date", n, 17, 4297))).strftime(kind)
    if kind in ("nanp", "phone"):
        keep = len(d) - 10 if kind == "nanp" else 2
        return filled(m, d[:keep] + permuted_digits(key, "phone", d[keep:]))
    if kind == "iban":
        s = m.replace(" ", "")
        own = re.sub("[^0-9]", "", s[4:])
        keep = max(len(own) - 16, 0)
        new = own[:keep] + permuted_digits(key, "iban", own[keep:])
        value = int("".join(str(int(c, 36)) for c in filled(s[4:], new) + s[:2] + "00"))
        return filled(m, f"{98 - value % 97:02}" + new)
    size, text = (12, m.lower()) if kind == "email" else (len(m), m)
    token = hashlib.sha512(f"{key}|{kind}|{text}".encode()).hexdigest()[:size]
    return f"u{token}@{m.split('@')[1]}" if kind == "email" else token


def test_against_plain_python(spark):
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    day = lambda: datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(73049))
    cases = [("%Y-%m-%d", x) for x in ("1900-01-01", "2099-12-31")]
    for _ in range(40):
        body = "4" + digits(14)
        cases += [("card", body + checked(body)), ("ip", ".".join(str(rng.randrange(256)) for _ in range(4)))]
        cases += [("ssn", f"{rng.choice([1, 665, 667, 899]):03}-{rng.randrange(1, 100):02}-{rng.randrange(1, 10000):04}")]
        cases += [(f, day().strftime(f)) for f in ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y")]
        cases += [("nanp", f"+1 ({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", f"+49 30 {digits(4)}"), ("email", f"A{digits(3)}.x@mail.example.org")]
        bban = digits(18)
        value = int("".join(str(int(c, 36)) for c in bban + "DE00"))
        cases += [("iban", f"DE{98 - value % 97:02}{bban}")]
    got = run(spark, [f"<{m}>" for _, m in cases], "secret")
    assert got == [f"<{brute('secret', kind, m)}>" for kind, m in cases]
    secret = digits(32)
    assert run(spark, [f'password = "{secret}"'], "secret") == [f'password = "{brute("secret", "credential", secret)}"']


def test_repeated_rows_null_ids_and_dates_out_of_range(spark):
    rows = [(None, "1984-02-29"), (None, "1984-02-29"), (3, None), (4, "1899-12-31 2100-01-01")]
    got = pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    want = brute("k", "%Y-%m-%d", "1984-02-29")
    assert sorted(map(tuple, got), key=str) == sorted([(None, want), (None, want), (3, None), (4, "1899-12-31 2100-01-01")], key=str)


def test_slashed_dates_are_one_to_one(spark):
    """All slashed dates of 1900 to 2099: month-first ones among themselves, the others among themselves."""
    first = datetime.date(1900, 1, 1)
    days = [first + datetime.timedelta(i) for i in range(73049)]
    forms = sorted({d.strftime("%m/%d/%Y") for d in days} | {d.strftime("%d/%m/%Y") for d in days})
    assert len(forms) == 117298
    frame = spark.createDataFrame([(m,) for m in forms], "text string")
    got = [r.text for r in pii.pseudonymise(frame, "k").collect()]
    assert set(got) == set(forms) and len(got) == len(forms)
    assert all((int(a[:2]) > 12) == (int(b[:2]) > 12) for a, b in zip(forms, got, strict=True)) or sorted(x for x in got if int(x[:2]) > 12) == [x for x in forms if int(x[:2]) > 12]


def test_no_column_is_lost(spark):
    frame = spark.createDataFrame([("on 1984-02-29", 1, 2, 3, "t")], "text string, __pii_new int, __pii_found int, text_new int, __PII_FOUND_found string")
    out = pii.pseudonymise(frame, "k")
    assert out.columns == frame.columns and tuple(out.first())[1:] == (1, 2, 3, "t") and out.first().text != "on 1984-02-29"
