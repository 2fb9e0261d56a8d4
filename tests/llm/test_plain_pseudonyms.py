"""Pseudonyms of whole texts against a plain version: loops over one value at a time, no Spark."""

import datetime
import hashlib
import re

from daymark.llm import pseudonyms
from daymark.llm.catalog import KEY_SETTING, PSEUDONYM_KEY, QUERIES, pseudonym_key

FIND = re.compile(pseudonyms.ANY, re.ASCII)
VALUES = ["call (229) 555-4838 or +44 20 7946 0958, +1 212-555-0199, 999-999-9999", "a.b9@mail.example.com Z@x.org",
          "10.0.0.255 and 256.1.1.1", "born 1990-01-31, 31.12.2001, 2023/02/29, 1799-12-31, 2199-12-31, 2000-02-29",
          "123-45-6789 666-45-6789 899-99-9999 000-12-3456", "4111 1111 1111 1111, 4111111111111112, 378282246310005",
          "DE89 3704 0044 0532 0130 00 GB29NWBK60161331926819 DE88370400440532013000 NO9386011117947", "", None]


def digest(key, *parts):
    return hashlib.sha256("|".join([key, *map(str, parts)]).encode()).hexdigest()


def rounds(left, right, a, b, key, kind):
    for n in range(0, pseudonyms.ROUNDS, 2):
        left = (left + int(digest(key, kind, n, right)[:15], 16) % a) % a
        right = (right + int(digest(key, kind, n + 1, left)[:15], 16) % b) % b
    return left, right


def figures(text):
    return "".join(c for c in text if c in "0123456789")


def refill(text, new):
    left = iter(new)
    return "".join(next(left) if c in "0123456789" else c for c in text)


def shuffled(body, key, kind):
    half = len(body) // 2
    rest = len(body) - half
    made = rounds(int(body[:half] or 0), int(body[half:]), 10 ** half, 10 ** rest, key, f"{kind}{len(body)}")
    return (str(made[0]).zfill(half) if half else "") + str(made[1]).zfill(rest)


def luhn(number):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10


def checked(plain):
    return int("".join(str(int(c, 36)) for c in plain)) % 97


def plain_email(text, key):
    local, domain = text.rsplit("@", 1)
    half = len(local) // 2
    parts = [local[:half], local[half:]]
    for n in range(pseudonyms.ROUNDS):
        own, other = parts[n % 2], parts[1 - n % 2]
        bits = "".join(digest(key, f"email{i}", n, len(local), other) for i in range(2))
        made = ""
        for i, c in enumerate(own):
            by = int(bits[3 * i:3 * i + 3], 16)
            for low, size in (("a", 26), ("A", 26), ("0", 10)):
                if ord(low) <= ord(c) < ord(low) + size:
                    c = chr((ord(c) - ord(low) + by) % size + ord(low))
                    break
            made += c
        parts[n % 2] = made
    return "".join(parts) + "@" + domain


def plain_date(text, key):
    given = re.split("[-/.]", text)
    dotted = "." in text
    try:
        day = datetime.date(*map(int, reversed(given) if dotted else given))
    except ValueError:
        return None
    at = (day - datetime.date(1800, 1, 1)).days
    if not 0 <= at < 146097:
        return None
    a, b = pseudonyms.DAYS
    left, right = rounds(*divmod(at, b), a, b, key, "date")
    new = datetime.date(1800, 1, 1) + datetime.timedelta(left * b + right)
    return refill(text, f"{new.day:02}{new.month:02}{new.year}" if dotted else f"{new.year}{new.month:02}{new.day:02}")


def plain_phone(text, key):
    number = figures(text)
    if re.match(r"\+[^1]", text):
        code = re.match(pseudonyms.COUNTRY_CODES, number)
        return code and refill(text, code[0] + shuffled(number[code.end():], key, "phone"))
    area, rest = int(number[-10:-7]) - 200, int(number[-7:]) - 2000000
    if area < 0 or rest < 0:
        return None
    area, rest = rounds(area, rest, 800, 8000000, key, "phone")
    return refill(text, f"{number[:-10]}{area + 200:03}{rest + 2000000:07}")


def plain(text, key):
    """The pseudonym of one match, or None."""
    def of(pattern):
        return re.fullmatch(pattern, text, re.ASCII)

    if "@" in text:
        return plain_email(text, key)
    if of(pseudonyms.IPV4):
        a, b, c, d = map(int, text.split("."))
        left, right = rounds(a * 256 + b, c * 256 + d, 65536, 65536, key, "ipv4")
        return ".".join(map(str, (*divmod(left, 256), *divmod(right, 256)))) if max(a, b, c, d) < 256 else None
    if of(pseudonyms.DATE):
        return plain_date(text, key)
    if of(pseudonyms.IBAN):
        packed = text.replace(" ", "")
        if checked(packed[4:] + packed[:4]) != 1:
            return None
        new = shuffled(figures(packed[4:]), key, "iban")
        body = refill(packed[4:], new)
        return refill(text, f"{98 - checked(body + packed[:2] + '00'):02}" + new)
    if of(pseudonyms.SSN):
        area, group, serial = map(int, text.split("-"))
        areas = [x for x in range(1, 900) if x != 666]
        if area not in areas or not group or not serial:
            return None
        left, right = rounds(areas.index(area) * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")
        return f"{areas[left // 99]:03}-{left % 99 + 1:02}-{right + 1:04}"
    if of(pseudonyms.PHONE):
        return plain_phone(text, key)
    number = figures(text)
    if luhn(number):
        return None
    new = shuffled(number[:-1], key, "card")
    return refill(text, next(new + c for c in "0123456789" if luhn(new + c) == 0))


def expected(text, key):
    if text is None:
        return None, 0
    done = [0]

    def put(match):
        new = plain(match[0], key)
        done[0] += new is not None
        return match[0] if new is None else new

    return FIND.sub(put, text), done[0]


def test_values_of_every_kind_equal_the_plain_version(spark):
    made = spark.createDataFrame(list(enumerate(VALUES)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_replaced) for r in pseudonyms.pseudonymize(made, "k").collect()}
    assert got == {i: expected(v, "k") for i, v in enumerate(VALUES)}
    # Counted by hand: what is no day, no assigned number or fails its check digits stays.
    assert [got[i][1] for i in range(len(VALUES))] == [4, 2, 1, 4, 2, 2, 3, 0, 0]


def test_the_key_comes_from_the_session(spark):
    assert pseudonym_key(spark) == PSEUDONYM_KEY
    spark.conf.set(KEY_SETTING, "another")
    try:
        assert pseudonym_key(spark) == "another"
    finally:
        spark.conf.unset(KEY_SETTING)


def test_documents_equal_the_plain_version(spark, docs, folder):
    got = {r.doc_id: (r.text, r.n_replaced) for r in QUERIES["op10_pii"](spark, folder).collect()}
    want = {r.doc_id: expected(r.text, PSEUDONYM_KEY) for r in docs.collect()}
    assert got == want and sum(n for _, n in want.values()) > 0
