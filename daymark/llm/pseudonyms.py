"""Format-preserving pseudonyms for personal numbers, dates and addresses in whole texts.

Found are e-mail addresses, IPv4 addresses, dates (ISO order, or dd.mm.yyyy), US social security
numbers, phone numbers of the North American plan or with "+" and a country code, payment cards and
IBANs. What does not pass the check of its kind (octets up to 255, days of the calendar from 1800 to
2199, assigned number ranges and country codes, Luhn digit, length by country and remainder by 97) is
left as it is. Letters, "_" or "." may touch a number; digits between hexadecimal letters are no card.
The rest is replaced by a keyed permutation of all values of its format: the value is split into a
pair of numbers below a and b, and the rounds of a Feistel network add to one of them a digest of
key, kind, round and the other, modulo a or b. So equal values get equal pseudonyms in every
document, different values different ones, and a pseudonym passes the same check and keeps the
punctuation of the original. Of e-mail addresses the part before "@" is permuted, letters among
letters and digits among digits; the domain stays.

Null texts stay null and empty ones empty. Repeated rows each get their text. Everything is built
from SQL expressions, so a text never leaves the JVM. A column named like the count is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.names import ROW, others, packed

ROUNDS = 8

# The formats looked for, the most special first.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
IPV4 = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"
DATE = r"(?:(?<![\d/-])\d{4}(?:-\d{2}-|/\d{2}/)\d{2}(?![\d/-])|(?<!\d)(?<!\d\.)\d{2}\.\d{2}\.\d{4}(?!\d|\.\d))"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
ABROAD = r"\+(?!1)\d(?:[ .()/-]{0,2}\d){6,13}"
PHONE = (r"(?<![\d+])(?:\+1\d{10}|" + ABROAD
         + r"|(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?!\d)")
#: Digits next to a hexadecimal token: up to four letters from another digit, or behind eight letters.
IN_HEX = "".join(rf"(?<!\d[A-Fa-f]{{{n}}})" for n in range(1, 5)) + "(?<![A-Fa-f]{8})"
CARD = (r"(?<![\d-])" + IN_HEX + r"(?:\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5}"
        r"|\d{13,19})(?!\d|[A-Fa-f]{1,4}\d|[A-Fa-f]{8})")
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN = r"(?<![A-Za-z0-9])(?:" + "|".join(
    rf"(?:{names.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(size - 4) // 4}}}"
    + (rf" ?[A-Z0-9]{{{size % 4}}}" if size % 4 else "") for size, names in IBAN_LENGTHS.items()) + r")(?![A-Za-z0-9])"
COUNTRY_CODES = (r"^(?:7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
                 r"|21[12368]|2[2-46]\d|25[0-8]|29[01789]|35\d|37\d|38\d|42\d|50\d|59\d|6[7-9]\d|80\d|85\d|87\d|88\d|96\d|97\d|99\d)")
ANY = "|".join((EMAIL, IPV4, DATE, IBAN, SSN, PHONE, CARD))
#: What every match holds: "@", seven and more digits, spaces and marks between two digits, or an IBAN's start.
HINT = r"@|[0-9][0-9 ().+/-]{5,}[0-9]|[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"
EPOCH, DAYS = "1800-01-01", (189, 773)  # 400 years have 146097 = 189 * 773 days


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _number(digits: Column) -> Column:
    return digits.cast("long")


def _padded(number: Column, width: int | Column) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _keyed(key: str, *parts: Column) -> Column:
    """60 bits of a digest of the key and the parts."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _once(value: Column, use) -> Column:
    """use(value), with the value computed once however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def permuted(left: Column, right: Column, a, b, key: str, kind) -> Column:
    """A keyed permutation of the pairs of numbers below a and b; fields l and r."""
    a, b = [F.lit(x).cast("long") if isinstance(x, int) else x for x in (a, b)]
    kind = F.lit(kind) if isinstance(kind, str) else kind
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(pair: Column, n: Column) -> Column:
        even = n % 2 == 0
        return F.struct(
            F.when(even, (pair["l"] + _keyed(key, kind, n, pair["r"]) % a) % a)
            .otherwise(pair["l"]).alias("l"),
            F.when(even, pair["r"])
            .otherwise((pair["r"] + _keyed(key, kind, n, pair["l"]) % b) % b).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _with_digits(text: Column, digits: Column) -> Column:
    """The text with its digits replaced in order."""
    return _once(digits, lambda new: _digits_put(text, new))


def _digits_put(text: Column, digits: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.when(
        text.substr(i, F.lit(1)).rlike("[0-9]"),
        digits.substr(F.length(_digits(text.substr(F.lit(1), i))), F.lit(1)))
        .otherwise(text.substr(i, F.lit(1)))), "")


def _luhn(digits: Column, doubled: int) -> Column:
    """Sum of digits from the right, with every second one doubled, from position `doubled`."""
    def added(total: Column, i: Column, back: Column) -> Column:
        digit = F.substring(back, i + 1, 1).cast("int")
        return total + F.when(i % 2 == doubled, digit * 2 - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)

    return _once(F.reverse(digits), lambda back: F.aggregate(
        F.sequence(F.lit(0), F.length(back) - 1), F.lit(0), lambda total, i: added(total, i, back)))


def _shuffled(body: Column, key: str, kind: str) -> Column:
    """Digits permuted among all of their number."""
    half = (F.length(body) / 2).cast("int")
    width = F.length(body) - half
    new = permuted(_number(body.substr(F.lit(1), half)), _number(body.substr(half + 1, width)),
                   F.pow(F.lit(10), half).cast("long"), F.pow(F.lit(10), width).cast("long"), key,
                   F.concat(F.lit(kind), F.length(body).cast("string")))
    return _once(new, lambda p: F.concat(_padded(p["l"], half), _padded(p["r"], width)))


def card(text: Column, key: str) -> Column:
    """All digits but the last are permuted; the last makes the Luhn sum right."""
    digits = _digits(text)
    made = _once(_shuffled(digits.substr(F.lit(1), F.length(digits) - 1), key, "card"),
                 lambda d: F.concat(d, ((10 - _luhn(d, 0) % 10) % 10).cast("string")))
    return F.when(_luhn(digits, 1) % 10 == 0, _with_digits(text, made))


def _rest97(text: Column) -> Column:
    """Remainder by 97 of digits and letters, A as 10 to Z as 35."""
    def added(total: Column, i: Column) -> Column:
        c = F.ascii(text.substr(i, F.lit(1)))
        return F.when(c < 58, total * 10 + c - 48).otherwise(total * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), added)


def iban(text: Column, key: str) -> Column:
    """Country and letters stay; digits behind the check digits are permuted, which then follow."""
    def made(plain: Column) -> Column:
        country, body = F.left(plain, F.lit(2)), plain.substr(F.lit(5), F.length(plain))
        new = _once(_shuffled(_digits(body), key, "iban"), lambda d: F.struct(
            d.alias("d"), _with_digits(body, d).alias("body")))
        new = _once(new, lambda p: F.concat(_padded(98 - _rest97(F.concat(p["body"], country, F.lit("00"))), 2), p["d"]))
        return F.when(_rest97(F.concat(body, F.left(plain, F.lit(4)))) == 1, _with_digits(text, new))

    return _once(F.translate(text, " ", ""), made)


def ipv4(text: Column, key: str) -> Column:
    octets = F.transform(F.split(text, r"\."), lambda x: x.cast("int"))
    new = permuted(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], 65536, 65536, key, "ipv4")
    made = _once(new, lambda p: F.concat_ws(".", *[
        f(p[side]).cast("string") for side in "lr" for f in (lambda x: F.floor(x / 256), lambda x: x % 256)]))
    return F.when(F.array_max(octets) < 256, made)


def date(text: Column, key: str) -> Column:
    dotted = F.contains(text, F.lit("."))
    day = F.when(dotted, F.try_to_date(text, "dd.MM.yyyy")) \
        .otherwise(F.try_to_date(F.translate(text, "/", "-"), "yyyy-MM-dd"))
    number = F.datediff(day, F.lit(EPOCH).cast("date"))
    new = permuted(F.floor(number / DAYS[1]), number % DAYS[1], *DAYS, key, "date")
    made = _once(new, lambda p: F.date_add(F.lit(EPOCH).cast("date"), (p["l"] * DAYS[1] + p["r"]).cast("int")))
    return F.when((number >= 0) & (number < DAYS[0] * DAYS[1]),
                  _with_digits(text, F.when(dotted, F.date_format(made, "ddMMyyyy"))
                               .otherwise(F.date_format(made, "yyyyMMdd"))))


def ssn(text: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = [_number(text.substr(*at)) for at in ((1, 3), (5, 2), (8, 4))]
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    new = permuted(place * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")

    def joined(p: Column) -> Column:
        found = F.floor(p["l"] / 99)
        return F.concat(_padded(F.when(found >= 665, found + 2).otherwise(found + 1), 3),
                        _padded(p["l"] % 99 + 1, 2), _padded(p["r"] + 1, 4))

    made = _once(new, joined)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, _with_digits(text, made))


def phone(text: Column, key: str) -> Column:
    """Area and exchange start with 2 to 9; a country code stays, and behind others all digits vary."""
    digits = _digits(text)
    code = F.regexp_extract(digits, COUNTRY_CODES, 0)
    abroad = F.concat(code, _shuffled(digits.substr(F.length(code) + 1, F.length(digits)), key, "phone"))
    ten = F.right(digits, F.lit(10))
    area, rest = _number(F.substring(ten, 1, 3)) - 200, _number(F.substring(ten, 4, 7)) - 2000000
    new = permuted(area, rest, 800, 8000000, key, "phone")
    made = _once(new, lambda p: F.concat(F.left(digits, F.length(digits) - 10), _padded(p["l"] + 200, 3),
                                         _padded(p["r"] + 2000000, 7)))
    return F.when(text.rlike(r"^\+[^1]"), F.when(F.length(code) > 0, _with_digits(text, abroad))) \
        .when((area >= 0) & (rest >= 0), _with_digits(text, made))


def email(text: Column, key: str) -> Column:
    """Halves of the local part shift each other's letters and digits by a digest."""
    local = F.substring_index(text, "@", 1)
    half = (F.length(local) / 2).cast("int")
    start = F.struct(local.substr(F.lit(1), half).alias("l"),
                     local.substr(half + 1, F.length(local)).alias("r"))

    def shifted(chars: Column, other: Column, n: Column) -> Column:
        stream = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"email{i}"), n.cast("string"),
                                               F.length(local).cast("string"), other), 256)
                            for i in range(2)])

        def step(i: Column, stream: Column) -> Column:
            c = chars.substr(i, F.lit(1))
            by = F.conv(F.substring(stream, i * 3 - 2, 3), 16, 10).cast("int")
            turn = lambda low, size: F.chr((F.ascii(c) - low + by) % size + low)
            return F.when(c.rlike("[a-z]"), turn(97, 26)).when(c.rlike("[A-Z]"), turn(65, 26)) \
                .when(c.rlike("[0-9]"), turn(48, 10)).otherwise(c)

        return F.when(F.length(chars) == 0, "").otherwise(_once(stream, lambda bits: F.array_join(
            F.transform(F.sequence(F.lit(1), F.length(chars)), lambda i: step(i, bits)), "")))

    def turn(pair: Column, n: Column) -> Column:
        even = n % 2 == 0
        return F.struct(
            F.when(even, shifted(pair["l"], pair["r"], n)).otherwise(pair["l"]).alias("l"),
            F.when(even, pair["r"]).otherwise(shifted(pair["r"], pair["l"], n)).alias("r"))

    new = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return _once(new, lambda p: F.concat(p["l"], p["r"], F.lit("@"), F.substring_index(text, "@", -1)))


def pseudonym(text: Column, key: str) -> Column:
    """The pseudonym of one match, or null if it does not pass the check of its kind."""
    return F.when(F.contains(text, F.lit("@")), email(text, key)) \
        .when(text.rlike(f"^(?:{IPV4})$"), ipv4(text, key)) \
        .when(text.rlike(f"^(?:{DATE})$"), date(text, key)) \
        .when(text.rlike(f"^(?:{IBAN})$"), iban(text, key)) \
        .when(text.rlike(f"^(?:{SSN})$"), ssn(text, key)) \
        .when(text.rlike(f"^(?:{PHONE})$"), phone(text, key)) \
        .otherwise(card(text, key))


def pseudonymize(docs: DataFrame, key: str, text: str = "text", count: str = "n_replaced") -> DataFrame:
    """The rows with replaced values in their texts, and how many values were replaced."""
    kept = others(docs, [count])
    found = docs.select(packed(docs, [count]), F.col(f"`{text}`").alias("whole"))
    whole = F.col("whole")
    found = found.withColumn("matches", F.when(
        whole.rlike(HINT), F.regexp_extract_all(whole, F.lit(ANY), 0)))
    new = found.withColumn("put", F.transform("matches", lambda m: F.struct(
        m.alias("old"), pseudonym(m, key).alias("new"))))
    # Zipped, so that the text is split once and not once for each match.
    pieces = F.arrays_zip(F.split(whole, ANY, -1).alias("text"), F.col("put").alias("put"))
    joined = F.array_join(F.transform(pieces, lambda p: F.concat(
        p["text"], F.coalesce(p["put"]["new"], p["put"]["old"], F.lit("")))), "")
    replaced = F.when(F.size("put") > 0, joined).otherwise(whole)
    number = F.coalesce(F.size(F.filter("put", lambda x: x["new"].isNotNull())), F.lit(0)).cast("long")
    return new.select(*[replaced.alias(c) if c == text else F.col(f"{ROW}.`{c}`") for c in kept],
                      number.alias(count))
