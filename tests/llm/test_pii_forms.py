"""PII in forms and neighbourhoods that the tables do not hold."""

import datetime
import hashlib
import random
import re

import pytest

from weirgate.llm import pii


def replaced(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.kinds) for r in pii.pseudonymise(df, "k").orderBy("doc_id").collect()]


PHONES = ["+1 (555) 123-4567", "+1 555 123 4567", "+44 20 7946 0958", "+7 (495) 123-45-67"]
OTHERS = [("192.168.10.7", "ipv4"), ("2020-01-31", "date"), ("31.01.2020", "date"), ("4111 1111 1111 1111", "card"), ("3782 822463 10005", "card"), ("123-45-6789", "ssn")]


@pytest.mark.parametrize("phone", PHONES)
def test_what_follows_a_phone_is_found(spark, phone):
    got = replaced(spark, [phone, *(f"{phone} {value}" for value, _ in OTHERS), *(value for value, _ in OTHERS)])
    (alone, kinds), pairs, singles = got[0], got[1 : len(OTHERS) + 1], got[len(OTHERS) + 1 :]
    assert kinds == ["phone"] and alone != phone
    assert pairs == [(f"{alone} {text}", ["phone", kind]) for (text, _), (_, kind) in zip(singles, OTHERS)]


ACCOUNTS = ["GB82 WEST 1234 5698 7654 32", "NL91 ABNA 0417 1643 00", "NL91ABNA0417164300", "FR14 2004 1010 0505 0001 3M02 606"]


def test_accounts_with_letters_and_phones_with_a_short_first_group(spark):
    got = replaced(spark, [*(f"to {a} TODAY 2020" for a in ACCOUNTS), "GB83 WEST 1234 5698 7654 32", "+33 1 42 68 53 00", "+61 2 9374 4000"])
    for account, (text, kinds) in zip(ACCOUNTS, got):
        new = re.fullmatch("to (.*) TODAY 2020", text)[1]
        plain = new.replace(" ", "")
        assert kinds == ["iban"] and new != account and re.sub("[0-9]", "0", new) == re.sub("[0-9]", "0", account)
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert got[4] == ("GB83 WEST 1234 5698 7654 32", [])
    assert [k for _, k in got[5:]] == [["phone"], ["phone"]] and got[5][0].startswith("+33 ") and got[5][0] != "+33 1 42 68 53 00"


# Against the same permutation in plain Python


def plain_permuted(a, b, p, q, tweak, key):
    for i in range(pii.ROUNDS):
        shift = lambda x: int(hashlib.sha256(f"{key}|{tweak}|{i}|{x}".encode()).hexdigest()[:15], 16)  # noqa: E731, B023
        if i % 2 == 0:
            a = (a + shift(b) % p) % p
        else:
            b = (b + shift(a) % q) % q
    return a, b


def plain_digits(digits, tweak, key, base=10, alphabet="0123456789abcdefghijklmnopqrstuvwxyz"):
    u = len(digits) // 2
    v = len(digits) - u
    value = lambda t: sum(alphabet.index(c) * base**i for i, c in enumerate(reversed(t)))
    write = lambda n, w: "".join(alphabet[n // base**i % base] for i in range(w - 1, -1, -1))
    a, b = plain_permuted(value(digits[:u]), value(digits[u:]), base**u, base**v, tweak, key)
    return write(a, u) + write(b, v)


def plain_refilled(shape, chars, kind):
    chars = iter(chars)
    return "".join(next(chars) if re.match(kind, c) else c for c in shape)


def plain_mail(value, key):
    local, domain = value.split("@")
    small, capitals = re.sub("[^a-z0-9]", "", local), re.sub("[^A-Z]", "", local)
    pieces = lambda t: [t[i : i + 20] for i in range(0, len(t), 20)]
    done = "".join(plain_digits(x, f"mail{capitals}{i}", key, 36) for i, x in enumerate(pieces(small)))
    upper = "".join(plain_digits(x, f"capitals{done}{i}", key, 26, pii.LETTERS) for i, x in enumerate(pieces(capitals)))
    return plain_refilled(plain_refilled(re.sub("[A-Z]", "\0", local), done, "[a-z0-9]"), upper, "\0") + "@" + domain


def plain_card(value, key):
    digits = re.sub("[^0-9]", "", value)
    body = plain_digits(digits[:-1], "card", key)
    total = sum(d * 2 - 9 * (d > 4) if i % 2 == 0 else d for i, d in enumerate(map(int, reversed(body))))
    return plain_refilled(value, body + str(-total % 10), "[0-9]")


def plain_phone(value, code, key):
    rest = value[len(code) :]
    return code + plain_refilled(rest, plain_digits(re.sub("[^0-9]", "", rest), f"phone{code}", key), "[0-9]")


def plain_address(value, key):
    o = [int(x) for x in value.split(".")]
    a, b = plain_permuted(o[0] * 256 + o[1], o[2] * 256 + o[3], 1 << 16, 1 << 16, "ipv4", key)
    return f"{a >> 8}.{a & 255}.{b >> 8}.{b & 255}"


def plain_date(value, key):
    n = (datetime.date.fromisoformat(value) - datetime.date(1800, 1, 1)).days
    a, b = plain_permuted(n // 773, n % 773, 189, 773, "date", key)
    return (datetime.date(1800, 1, 1) + datetime.timedelta(a * 773 + b)).isoformat()


def plain_ssn(value, key):
    area, group, serial = map(int, value.split("-"))
    a, b = plain_permuted(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn", key)
    return f"{a + 1 + (a + 1 >= 666):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"


def test_pseudonyms_equal_a_plain_feistel_network(spark):
    rng = random.Random(1)
    want = []
    for _ in range(40):
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        total = sum(d * 2 - 9 * (d > 4) if i % 2 == 0 else d for i, d in enumerate(map(int, reversed(body))))
        card = f"{body}{-total % 10}"
        name = "".join(rng.choice("abcXYZ019") for _ in range(rng.randrange(1, 30))) + "." + rng.choice(["Doe", "doe", "DOE", "x"])
        mail = f"a{name}@Mail.example.com"
        address = ".".join(str(rng.randrange(256)) for _ in range(4))
        day = (datetime.date(1800, 1, 1) + datetime.timedelta(rng.randrange(146_097))).isoformat()
        ssn = f"{rng.choice([1, 665, 667, 899]):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}"
        phone = f"+44 20 {rng.randrange(1000, 9999)} {rng.randrange(1000, 9999)}"
        want += [(card, plain_card(card, "k")), (mail, plain_mail(mail, "k")), (address, plain_address(address, "k")), (day, plain_date(day, "k")), (ssn, plain_ssn(ssn, "k")), (phone, plain_phone(phone, "+44", "k"))]
    got = replaced(spark, [f"x {v} y" for v, _ in want])
    assert [t for t, _ in got] == [f"x {v} y" for _, v in want]


def test_spellings_of_one_phone_are_linked_and_cases_of_a_mail_apart(spark):
    spelled = ["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958", "+1 212 555 1234", "+12125551234", "+531793898196"]
    got = [re.sub("[^0-9+]", "", t) for t, _ in replaced(spark, spelled)]
    assert got[0] == got[1] == got[2] != "+442079460958" and got[3] == got[4] and got[0].startswith("+44") and got[5].startswith("+53")
    mails = ["John.Doe@x.com", "john.doe@x.com", "JOHN.doe@x.com", "john.Doe@x.com"]
    done = [t for t, _ in replaced(spark, mails)]
    assert len(set(done)) == 4 and not set(done) & set(mails)
    for mail, new in zip(mails, done):
        assert re.sub("[a-z0-9]", "0", re.sub("[A-Z]", "A", new)) == re.sub("[a-z0-9]", "0", re.sub("[A-Z]", "A", mail))


def test_a_key_is_required(spark):
    with pytest.raises(TypeError):
        pii.pseudonymise(spark.createDataFrame([(1, "x")], "doc_id long, text string"))
