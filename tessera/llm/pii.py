"""PII: format-preserving pseudonyms by a keyed Feistel network, in Spark SQL functions only.

Numbers and dates that pass their validation are permuted inside their own format: payment cards (Luhn), US social
security numbers, phone numbers, IPv4 addresses, IBANs (mod 97) and calendar dates of 1900 to 2099. The permutation
depends on key and kind only, so equal values get equal pseudonyms in every document, different values different ones.
Separators stay. E-mail addresses and quoted hexadecimal
credentials are no such numbers; the local part or the credential becomes a keyed token of the same kind. What fails its
validation stays as it is, and so does all other text.

A Feistel network over pairs (l, r) of Z_a x Z_b: each round adds a keyed hash of one half to the other, modulo a or b,
so it is a bijection of a * b values whatever the hash; check digits are made anew.

Of an IBAN the last 16 digits are permuted and the letters stay. The key is a literal of the plan, as it must be in a form
without Python: keep plans and event logs as secret as the key.

Null text stays null, empty text empty, and texts of any length are read whole; repeated rows and null ids keep their rows
and equal values get equal pseudonyms in them; an empty table stays empty; other columns are passed through, whatever their
names; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Days from 1900-01-01 to 2099-12-31.
DAYS = 17 * 4297
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
IBAN = r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [0-9]{1,3})?"
CREDENTIAL = r"(?<=(?:token|secret|password|api_key) ?[=:] ?[\"'])[0-9a-f]{16,128}(?=[\"'])"
CARD = r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}"
DOTTED = r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}"
SLASHED = r"[0-9]{2}/[0-9]{2}/[0-9]{4}"
NANP = r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
PHONE = r"\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}"
#: In this order; the first that matches at a place is the match's kind.
KINDS = [("email", EMAIL), ("iban", IBAN), ("card", CARD), ("ip", IP), ("iso", ISO), ("ssn", SSN), ("dotted", DOTTED), ("slashed", SLASHED), ("nanp", NANP), ("phone", PHONE), ("credential", CREDENTIAL)]
#: Not inside a longer word or number.
BEFORE, AFTER = r"(?<![A-Za-z0-9])(?<![0-9][.])", r"(?![A-Za-z0-9])(?![.][0-9])"
PATTERN = BEFORE + "(?:" + "|".join(f"(?:{p})" for _, p in KINDS) + ")" + AFTER



def _long(text: Column) -> Column:
    return text.cast("long")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _ten(n: Column) -> Column:
    """10 to the power n, exactly."""
    return F.element_at(F.array(*[F.lit(10**k).cast("long") for k in range(19)]), n + 1)


def keyed(key: str, kind: str, part: Column, value: Column, size: Column) -> Column:
    """A hash of ``value`` under key, kind and round, in [0, size)."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), part.cast("string"), value.cast("string"))
    return F.pmod(_long(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10)), size)


def feistel(key: str, kind: str, value: Column, a: int | Column, b: int | Column) -> Column:
    """A keyed permutation of [0, a * b)."""
    a, b = (x if isinstance(x, Column) else F.lit(x).cast("long") for x in (a, b))

    def turn(s: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, F.pmod(s["l"] + keyed(key, kind, i, s["r"], a), a)).otherwise(s["l"])
        right = F.when(i % 2 == 1, F.pmod(s["r"] + keyed(key, kind, i, s["l"], b), b)).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    start = F.struct(F.call_function("div", value, b).alias("l"), F.pmod(value, b).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] * b + s["r"])


def permute_digits(key: str, kind: str, digits: Column) -> Column:
    """A digit string of at most 18 digits, permuted among those of its length."""
    n = F.length(digits)
    half = F.call_function("div", n, F.lit(2)).cast("int")
    out = feistel(key, kind, _long(digits), _ten(half), _ten(n - half))
    return F.when(n < 2, digits).otherwise(F.lpad(out.cast("string"), n, "0"))


def refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in order."""
    at = lambda i: F.substring(form, i, F.lit(1))
    before = lambda i: F.length(_digits(F.substring(form, F.lit(1), i)))
    chars = F.transform(F.sequence(F.lit(1), F.length(form)), lambda i: F.when(at(i).rlike("[0-9]"), F.substring(digits, before(i), F.lit(1))).otherwise(at(i)))
    return F.array_join(chars, "")


def luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10."""
    each = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), 0), lambda c, i: F.when(i % 2 == 1, 2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda acc, x: acc + x) % 10


def _card(key: str, m: Column) -> Column:
    d = _digits(m)
    body = F.concat(F.substring(d, 1, 1), permute_digits(key, "card", F.substring(d, F.lit(2), F.length(d) - 2)))
    check = (10 - luhn(F.concat(body, F.lit("0")))) % 10
    return F.when(luhn(d) == 0, refill(m, F.concat(body, check.cast("string"))))


def _ip(key: str, m: Column) -> Column:
    octets = F.transform(F.split(m, r"\."), _long)
    valid = ~m.rlike(r"(^|\.)0[0-9]") & F.forall(octets, lambda x: x <= 255)
    out = feistel(key, "ip", F.aggregate(octets, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x), 65536, 65536)
    back = F.transform(F.array(*[F.lit(k) for k in (24, 16, 8, 0)]), lambda k: F.pmod(F.call_function("shiftright", out, k), F.lit(256)).cast("string"))
    return F.when(valid, F.array_join(back, "."))


def _ssn(key: str, m: Column) -> Column:
    area, group, serial = (_long(F.substring(m, *x)) for x in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    x = feistel(key, "ssn", ((area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1) * 9999 + serial - 1, 898, 99 * 9999)
    rank = F.call_function("div", x, F.lit(99 * 9999)) + 1
    rank = rank + F.when(rank >= 666, 1).otherwise(0)
    part = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.when(valid, F.concat_ws("-", part(rank, 3), part(F.call_function("div", x, F.lit(9999)) % 99 + 1, 2), part(x % 9999 + 1, 4)))


def _date(key: str, m: Column, form: str) -> Column:
    day = F.try_to_timestamp(m, F.lit(form)).cast("date")
    days = F.datediff(day, F.lit("1900-01-01").cast("date"))
    out = F.date_add(F.lit("1900-01-01").cast("date"), feistel(key, "date", days.cast("long"), 17, 4297).cast("int"))
    return F.when(days.between(0, DAYS - 1), F.date_format(out, form))


#: Month and day as mmdd of the days after the 28th, but for February.
LATE = [100 * m + d for m in range(1, 13) if m != 2 for d in ((29, 30, 31) if m in (1, 3, 5, 7, 8, 10, 12) else (29, 30))]


def _day_first(key: str, m: Column) -> Column:
    """Slashed dates that only read as day, month, year, permuted among themselves: by days 13 to 28, later ones, and leap days."""
    sound = F.try_to_timestamp(m, F.lit("dd/MM/yyyy")).isNotNull()
    day, month, year = (_long(F.substring(m, *x)) for x in ((1, 2), (4, 2), (7, 4)))
    valid = sound & (day > 12) & year.between(1900, 2099)
    part = lambda c, n=2: F.lpad(c.cast("string"), n, "0")
    date = lambda d, mo, y: F.concat_ws("/", part(d), part(mo), part(y, 4))
    div = lambda a, b: F.call_function("div", a, F.lit(b))
    x = feistel(key, "day-first", ((year - 1900) * 12 + month - 1) * 16 + day - 13, 240, 160)
    early = date(x % 16 + 13, div(x, 16) % 12 + 1, div(x, 192) + 1900)
    late = F.array(*[F.lit(v).cast("long") for v in LATE])
    y = feistel(key, "day-first-late", (year - 1900) * len(LATE) + F.array_position(late, month * 100 + day) - 1, 40, 5 * len(LATE))
    at = F.get(late, (y % len(LATE)).cast("int"))
    leap = feistel(key, "day-first-leap", div(year - 1904, 4), 7, 7)
    return F.when(valid & (day <= 28), early).when(valid & (month == 2), date(F.lit(29), F.lit(2), 1904 + 4 * leap)).when(valid, date(at % 100, div(at, 100), div(y, len(LATE)) + 1900))


def _phone(key: str, m: Column, keep: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(7, 15), refill(m, F.concat(F.substring(d, F.lit(1), keep), permute_digits(key, "phone", F.substring(d, keep + 1, F.length(d))))))


def mod97(text: Column) -> Column:
    value = lambda c: F.when(c.rlike("[0-9]"), _long(F.regexp_replace(c, "[^0-9]", "0"))).otherwise((F.ascii(c) - 55).cast("long"))
    return F.aggregate(F.regexp_extract_all(text, F.lit("[A-Z0-9]"), 0), F.lit(0).cast("long"), lambda acc, c: (acc * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def _iban(key: str, m: Column) -> Column:
    s = F.replace(m, F.lit(" "), F.lit(""))
    country, bban = F.substring(s, 1, 2), F.substring(s, F.lit(5), F.length(s))
    d = _digits(bban)
    fixed = F.greatest(F.length(d) - 16, F.lit(0))
    new = refill(bban, F.concat(F.substring(d, F.lit(1), fixed), permute_digits(key, "iban", F.substring(d, fixed + 1, F.length(d)))))
    check = F.lpad((98 - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    valid = (mod97(F.concat(bban, F.substring(s, 1, 4))) == 1) & (F.length(d) >= 2)
    return F.when(valid, refill(m, F.concat(check, _digits(new))))


def _token(key: str, kind: str, value: Column, size: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 512), F.lit(1), size)


def pseudonym(key: str, m: Column) -> Column:
    """The pseudonym of a match of ``PATTERN``, or the match itself where its validation fails."""
    by_kind = {
        "email": F.concat(F.lit("u"), _token(key, "email", F.lower(m), F.lit(12)), F.lit("@"), F.element_at(F.split(m, "@"), 2)),
        "credential": _token(key, "credential", m, F.length(m)),
        "iban": _iban(key, m),
        "card": _card(key, m),
        "ip": _ip(key, m),
        "iso": F.coalesce(_date(key, m, "yyyy-MM-dd"), _date(key, m, "yyyy/MM/dd")),
        "ssn": _ssn(key, m),
        "dotted": _date(key, m, "dd.MM.yyyy"),
        "slashed": F.coalesce(_date(key, m, "MM/dd/yyyy"), _day_first(key, m)),
        "nanp": _phone(key, m, F.length(_digits(m)) - 10),
        "phone": _phone(key, m, F.lit(2)),
    }
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS):
        bare = "[0-9a-f]{16,128}" if kind == "credential" else pattern
        out = F.when(m.rlike(f"^(?:{bare})$"), by_kind[kind]).otherwise(out)
    return F.coalesce(out, m)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; all other columns and rows stay as they are."""
    longest = max(docs.columns, key=len)
    found, new = longest + "_found", longest + "_new"  # no other column has these names
    source = F.col(text)
    rows = docs.withColumn(found, F.when(source.rlike("[0-9@]"), F.regexp_extract_all(source, F.lit(PATTERN), 0)))
    rows = rows.withColumn(new, F.transform(found, lambda m: pseudonym(key, m)))
    pieces = F.split(source, PATTERN, -1)
    changed = F.array_join(F.zip_with(pieces, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return rows.withColumn(text, F.when(F.size(found) > 0, changed).otherwise(source)).drop(found, new)
