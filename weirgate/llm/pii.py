"""Operator 9: PII by format-preserving Feistel pseudonyms.

Card numbers, phone numbers, social security numbers, bank accounts, IPv4 addresses, dates and
mail addresses are found by pattern and validated. Each is replaced by a value of the same
format that a keyed permutation gives, so equal values stay equal across documents and
different ones different. Everything is a DataFrame expression; no Python runs on executors.

The permutation is an alternating Feistel network on a pair of numbers (a, b) below (p, q): in
each round one of them is shifted by a keyed hash of the other, modulo its own bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import table

ROUNDS = 8

# Country calling codes are prefix-free: 1 and 7, some of two digits, and three digits in the other zones.
CALLING_CODE = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

# Patterns by kind, tried in this order at each place of a text.
MAIL = r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}(?![\w-])"
# Accounts have the length that their country gives them; letters are part of some. Accounts of
# countries that are not listed have digits only.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SN SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _account(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "")


IBAN = rf"(?<![\w])(?:{'|'.join(_account(*x) for x in IBAN_LENGTHS.items())}|[A-Z]{{2}}[0-9]{{2}}(?: ?[0-9]{{4}}){{2,7}}(?: ?[0-9]{{1,4}})?)(?![\w])"
# What stands after a phone and a space is no group of it if it starts like an address, a date, a
# social security number, a national phone or a card.
OTHER = (
    r"(?! (?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
    r"|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\w])| [0-9]{4}(?: [0-9]{4}){2} [0-9]| [0-9]{4}(?:-[0-9]{4}){2}-[0-9]| [0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}(?![\w]))"
)
LONG = "[0-9][ .()-]{0,2}" * 15 + "[0-9]"
SHORT = "[0-9][ .()-]{0,2}" * 6 + "[0-9]"
# North American numbers and the usual grouping after a bracketed area code; else 7 to 15 digits (E.164).
PHONE = (
    r"(?<![\w+])\+(?:1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{1,3}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{4})(?![\w]|[.-][0-9])"
    rf"|(?<![\w+])\+[0-9]{{1,3}}[ .-]?\(?[0-9]{{1,4}}\)?(?:[ .-]?[0-9]{{2,4}}){{2}}(?:{OTHER}[ .-]?[0-9]{{2,4}}){{0,2}}(?![\w])(?<!{LONG})(?<={SHORT})"
)
NATIONAL = r"(?<![\w(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![\w])|(?<![\w.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w]|[.-][0-9])"
ISO_DATE = r"(?<![\w./-])[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}(?![\w]|[./-][0-9])"
DATE = r"(?<![\w./-])[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}(?![\w]|[./-][0-9])"
SSN = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w]|-[0-9])"
ADDRESS = r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])"
CARD = (
    r"(?<![\w.-])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}"
    r"|[0-9]{4} [0-9]{6} [0-9]{4,5}|[0-9]{4}-[0-9]{6}-[0-9]{4,5})(?![\w]|[.-][0-9])"
)
ANY = "|".join(f"(?:{p})" for p in (MAIL, IBAN, PHONE, NATIONAL, ISO_DATE, DATE, SSN, ADDRESS, CARD))

# 400 years of the calendar have 146,097 = 189 * 773 days, so the permutation of days is exact.
FIRST_DAY, DAYS_P, DAYS_Q = "1800-01-01", 189, 773


def _long(x) -> Column:
    return F.lit(x).cast("long")


def _shift(key: str, tweak: Column, i: Column, x: Column) -> Column:
    """A keyed 60-bit number for round i and the other half's value."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), x.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permuted(a: Column, b: Column, p: Column, q: Column, tweak: Column, key: str, rounds: int = ROUNDS) -> Column:
    """The struct ``(a, b)`` that a keyed permutation of the pairs below ``(p, q)`` gives."""

    def turn(s, i):
        even = F.struct(F.pmod(s["a"] + _shift(key, tweak, i, s["b"]) % p, p).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), F.pmod(s["b"] + _shift(key, tweak, i, s["a"]) % q, q).alias("b"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn)


def _power(base: int, n: Column) -> Column:
    """``base ** n`` for up to 18 digits, exactly."""
    return F.element_at(F.array(*[_long(base**k) for k in range(19 if base == 10 else 13)]), n + 1)


def permuted_digits(digits: Column, tweak: Column, key: str) -> Column:
    """A keyed permutation of the strings of as many digits; up to 36, in two halves."""
    u = F.floor(F.length(digits) / 2).cast("int")
    v = F.length(digits) - u
    left = F.when(u > 0, F.substring(digits, F.lit(1), u).cast("long")).otherwise(_long(0))
    found = permuted(left, F.substring(digits, u + 1, v).cast("long"), _power(10, u), _power(10, v), tweak, key)
    whole = lambda s: F.concat(F.when(u > 0, F.lpad(s["a"].cast("string"), u, "0")).otherwise(""), F.lpad(s["b"].cast("string"), v, "0"))
    return _let(found, whole)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def refilled(shape: Column, digits: Column, kind: str = "[0-9]") -> Column:
    """``shape`` with its characters of a kind, its digits, replaced in turn by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    fill = lambda s, c: F.when(
        c.rlike(f"^{kind}$"), F.struct(F.concat(s["out"], F.substring(digits, s["at"] + 1, F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))
    ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))
    return F.aggregate(F.split(shape, ""), start, fill, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits, its last digit counting once."""
    return F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda s, i: s + _luhn_digit(F.substring(digits, i, F.lit(1)).cast("int"), (F.length(digits) - i) % 2 == 1),
    )


def _luhn_digit(d: Column, doubled: Column) -> Column:
    return F.when(doubled, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)


def card_pseudonym(value: Column, key: str) -> Column:
    """The digits before the check digit permuted, and the check digit that fits them."""
    digits = _digits(value)
    body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), F.lit("card"), key)
    check = lambda d: F.concat(d, F.pmod(F.lit(10) - luhn_sum(F.concat(d, F.lit("0"))) % 10, F.lit(10)).cast("string"))
    return refilled(value, _let(body, check))


def _mod97(text: Column) -> Column:
    """The remainder by 97 of a string of digits and capitals, A being 10."""
    each = lambda r, c: F.when(c.rlike("^[0-9]$"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), lambda r, c: each(r, c))


def iban_pseudonym(value: Column, key: str) -> Column:
    """The account's digits permuted under its country, letters kept, with check digits that fit."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    country = F.substring(plain, 1, 2)
    shape = F.substring(plain, F.lit(5), F.length(plain) - 4)
    account = refilled(shape, permuted_digits(_digits(shape), F.concat(F.lit("iban"), country), key))
    check = lambda d: F.concat(F.lpad((98 - _mod97(F.concat(d, country, F.lit("00")))).cast("string"), 2, "0"), _digits(d))
    return refilled(value, _let(account, check))


def phone_pseudonym(value: Column, key: str) -> Column:
    """All digits but those of the country code permuted under it, however the phone is spaced."""
    code = F.regexp_extract(value, CALLING_CODE, 0)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    return F.concat(code, refilled(rest, permuted_digits(_digits(rest), F.concat(F.lit("phone"), code), key)))


def ssn_pseudonym(value: Column, key: str) -> Column:
    """Area, group and serial permuted among the valid ones."""
    d = _digits(value)
    area = F.substring(d, 1, 3).cast("int")
    a = area - 1 - F.when(area > 666, 1).otherwise(0)
    b = (F.substring(d, 4, 2).cast("int") - 1) * 9999 + F.substring(d, 6, 4).cast("int") - 1
    found = permuted(a, b, _long(898), _long(99 * 9999), F.lit("ssn"), key)
    three = lambda a: a + 1 + F.when(a + 1 >= 666, 1).otherwise(0)
    return _let(found, lambda s: F.format_string("%03d-%02d-%04d", three(s["a"]), F.floor(s["b"] / 9999) + 1, s["b"] % 9999 + 1))


def address_pseudonym(value: Column, key: str) -> Column:
    """The 32 bits of an IPv4 address permuted in two halves."""
    part = F.split(value, r"\.")
    octet = lambda i: part[i].cast("long")
    found = permuted(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), _long(65536), _long(65536), F.lit("ipv4"), key)
    return _let(found, lambda s: F.concat_ws(".", *[x.cast("long").cast("string") for h in ("a", "b") for x in (F.floor(s[h] / 256), s[h] % 256)]))


def _day(value: Column, iso: Column) -> Column:
    """The date, year first or day first (month first where only that fits), or null."""
    part = F.split(value, r"[-/.]")
    day_first = F.try_to_date(F.concat_ws("-", part[2], F.lpad(part[1], 2, "0"), F.lpad(part[0], 2, "0")), "yyyy-MM-dd")
    month_first = F.try_to_date(F.concat_ws("-", part[2], F.lpad(part[0], 2, "0"), F.lpad(part[1], 2, "0")), "yyyy-MM-dd")
    year_first = F.try_to_date(F.concat_ws("-", part[0], part[1], part[2]), "yyyy-MM-dd")
    return F.when(iso, year_first).otherwise(F.coalesce(day_first, month_first))


def date_pseudonym(value: Column, key: str) -> Column:
    """A day of the same 400 years, in the same order, with the same separators."""
    iso = value.rlike("^[0-9]{4}")
    n = F.date_diff(_day(value, iso), F.lit(FIRST_DAY).cast("date"))
    found = permuted(F.floor(n / DAYS_Q), n % DAYS_Q, _long(DAYS_P), _long(DAYS_Q), F.lit("date"), key)
    other = lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s["a"] * DAYS_Q + s["b"]).cast("int"))
    mark = F.regexp_extract(value, "[-/.]", 0)
    part = F.split(value, r"[-/.]")
    us = ~iso & (part[1].cast("int") > 12)
    write = lambda d: F.when(iso, F.concat(_ymd(d)[0], mark, _ymd(d)[1], mark, _ymd(d)[2])).otherwise(
        F.when(us, F.concat(_ymd(d)[1], mark, _ymd(d)[2], mark, _ymd(d)[0])).otherwise(F.concat(_ymd(d)[2], mark, _ymd(d)[1], mark, _ymd(d)[0]))
    )
    return _let(_let(found, other), write)


def _ymd(d: Column) -> list[Column]:
    return [F.date_format(d, "yyyy"), F.date_format(d, "MM"), F.date_format(d, "dd")]


def mail_pseudonym(value: Column, key: str) -> Column:
    """Letters and digits before the at sign permuted, capitals among capitals; the domain stays.

    Small letters and digits are permuted under the capitals, and the capitals then under what
    the others became: both steps can be undone, so different addresses stay different.
    """
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    marks = F.regexp_replace(F.regexp_replace(local, "[a-z0-9]", "0"), "[A-Z]", "A")
    small, capitals = F.regexp_replace(local, "[^a-z0-9]", ""), F.regexp_replace(local, "[^A-Z]", "")
    done = _permuted_text(small, 36, F.concat(F.lit("mail"), capitals), key)
    upper = lambda x: _permuted_text(capitals, 26, F.concat(F.lit("capitals"), x), key)
    written = _let(done, lambda x: F.when(capitals == "", refilled(marks, x)).otherwise(refilled(refilled(marks, x), F.upper(upper(x)), "A")))
    return F.concat(written, F.lit("@"), domain)


def _permuted_text(text: Column, base: int, tweak: Column, key: str) -> Column:
    """The text permuted in pieces of up to 20 characters: base 36, or base 26 for capitals."""
    pieces = F.regexp_extract_all(text, F.lit("[A-Za-z0-9]{1,20}"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x, i: _permuted_piece(x, base, F.concat(tweak, i.cast("string")), key)), "")


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _permuted_piece(x: Column, base: int, tweak: Column, key: str) -> Column:
    # Capitals are numbers in base 26 whose digits are written 0 to 9 and A to P.
    plain = F.translate(x, LETTERS, "0123456789ABCDEFGHIJKLMNOP") if base == 26 else x
    u = F.floor(F.length(x) / 2).cast("int")
    v = F.length(x) - u
    number = lambda s: F.conv(s, base, 10).cast("long")
    left = F.when(u > 0, number(F.substring(plain, F.lit(1), u))).otherwise(_long(0))
    found = permuted(left, number(F.substring(plain, u + 1, v)), _power(base, u), _power(base, v), tweak, key)
    text = lambda n, w: F.lpad(F.lower(F.conv(n.cast("string"), 10, base)), w, "0")
    whole = _let(found, lambda s: F.concat(F.when(u > 0, text(s["a"], u)).otherwise(""), text(s["b"], v)))
    return F.translate(F.upper(whole), "0123456789ABCDEFGHIJKLMNOP", LETTERS) if base == 26 else whole


def kind_of(value: Column) -> Column:
    """The kind of a found value if it is valid, else null."""
    digits = _digits(value)
    octets = F.split(value, r"\.")
    is_address = value.rlike(f"^(?:{ADDRESS})$") & F.forall(octets, lambda o: o.cast("int") < 256)
    is_ssn = value.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    iso = value.rlike("^[0-9]{4}")
    in_years = F.year(_day(value, iso)).between(1800, 2199)
    is_date = value.rlike(r"^(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})$")
    plain = F.replace(value, F.lit(" "), F.lit(""))
    is_iban = value.rlike("^[A-Z]{2}[0-9]{2}.*[0-9]")
    return (
        F.when(value.contains("@"), F.lit("mail"))
        .when(is_iban, F.when(_mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1, F.lit("iban")))
        .when(value.rlike(rf"^(?:{PHONE}|{NATIONAL})$"), F.lit("phone"))
        .when(is_ssn, F.lit("ssn"))
        .when(is_address, F.lit("ipv4"))
        .when(is_date, F.when(in_years, F.lit("date")))
        .when((F.length(digits) >= 13) & (F.length(digits) <= 19) & value.rlike(f"^(?:{CARD})$"), F.when(luhn_sum(digits) % 10 == 0, F.lit("card")))
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    return (
        F.when(kind == "mail", mail_pseudonym(value, key))
        .when(kind == "iban", iban_pseudonym(value, key))
        .when(kind == "phone", phone_pseudonym(value, key))
        .when(kind == "ssn", ssn_pseudonym(value, key))
        .when(kind == "ipv4", address_pseudonym(value, key))
        .when(kind == "date", date_pseudonym(value, key))
        .when(kind == "card", card_pseudonym(value, key))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, kinds)``: the text with pseudonyms, and the kinds replaced, in order.

    Equal values of a kind have equal pseudonyms under one key, in every document. A value is
    replaced only if valid: cards by their Luhn digit, bank accounts by their remainder,
    addresses by their octets, social security numbers and dates (1800 to 2199) by their range.
    Cards and accounts keep valid check digits. Mail addresses that differ in case are different
    values; a phone with its country code is one value however it is spaced, and another one
    without the code. IPv6 addresses and national phones without separators are not found.
    Whoever has the key can undo the permutation, so it has no default.

    A null text stays null and has no kinds; an empty one stays empty; null ids are kept;
    repeated rows are treated each. Long texts are read whole. Other columns are not read. An
    empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("found", found)
    some = rows.withColumn("named", F.transform("found", lambda m: F.struct(m.alias("value"), kind_of(m).alias("kind"))))
    done = F.transform("named", lambda m: pseudonym(m["value"], m["kind"], key))
    pieces = F.arrays_zip(F.split("text", ANY, -1).alias("gap"), F.concat(done, F.array(F.lit(""))).alias("new"))
    joined = F.array_join(F.transform(pieces, lambda p: F.concat(p["gap"], p["new"])), "")
    text = F.when(F.size("found") > 0, joined).otherwise(F.col("text"))
    kinds = F.filter(F.transform("named", lambda m: m["kind"]), lambda k: k.isNotNull())
    return some.select("doc_id", text.alias("text"), F.coalesce(kinds, F.array().cast("array<string>")).alias("kinds"))


# The query's own, for the given tables hold invented data only.
QUERY_KEY = "op9 on invented documents"


def query(spark, folder: str) -> DataFrame:
    found = pseudonymise(table(spark, folder, "documents"), QUERY_KEY)
    return found.select("doc_id", "text", F.array_join("kinds", ",").alias("kinds"), F.size("kinds").cast("long").alias("n_replaced"))
