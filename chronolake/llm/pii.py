"""Format-preserving pseudonyms for personal data: Feistel permutations under a key.

Values are found by their format and validated (Luhn, octets, area numbers, calendar). A value's variable part is
a pair of numbers below fixed bounds; eight keyed Feistel rounds permute the pairs, and the result is written in
the value's own format. A permutation gives equal values equal pseudonyms and different ones different
pseudonyms, in every document, with no table of them kept. What fails validation stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Formats, in the order in which they are tried at a place.
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9\-]{0,62}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])"
DATE_ISO = r"(?<![\w.\-])\d{4}-\d{2}-\d{2}(?![\w\-])"
DATE_DOT = r"(?<![\w.])\d{2}\.\d{2}\.\d{4}(?!\w|\.\d)"
DATE_SLASH = r"(?<![\w/])\d{2}/\d{2}/\d{4}(?![\w/])"
SSN = r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])"
IPV4 = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)"
CARD = r"(?<![\w.\-])\d(?:[ \-]?\d){12,18}(?![\w\-])"
PHONE = r"(?<![\w+\-])(?:\+?1[ .\-]?)?(?:\(\d{3}\) ?|[2-9]\d{2}[ .\-])\d{3}[ .\-]\d{4}(?![\w\-])"
PHONE_PLUS = r"(?<![\w+])\+[1-9](?:[ .\-]?\d){8,14}(?!\w)"
PATTERN = "|".join((EMAIL, DATE_ISO, DATE_DOT, DATE_SLASH, SSN, IPV4, PHONE, CARD, PHONE_PLUS))
#: The Gregorian calendar repeats after 146,097 days, 27 times 5,411: dates are permuted within these years.
FIRST_YEAR, LAST_YEAR, DAYS_A, DAYS_B = 1700, 2099, 27, 5411
#: Characters of a long value that are permuted together; the next ones are another pair.
CHUNK = 16
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, tweak: Column, key: str, back: bool = False) -> Column:
    """The struct (a, b) permuted: rounds add a keyed hash of one number to the other, modulo its size.

    Every round can be undone, so this is a permutation of all pairs with a < size_a and b < size_b (longs).
    """

    def one(s: Column, r: Column) -> Column:
        def hashed(other: Column) -> Column:
            said = F.concat_ws("|", F.lit(key), tweak, r.cast("string"), other.cast("string"))
            return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")

        sign = -1 if back else 1
        return F.when(
            r % 2 == 0,
            F.struct(F.pmod(s["a"] + sign * F.pmod(hashed(s["b"]), size_a), size_a).alias("a"), s["b"].alias("b")),
        ).otherwise(F.struct(s["a"].alias("a"), F.pmod(s["b"] + sign * F.pmod(hashed(s["a"]), size_b), size_b).alias("b")))

    order = list(range(ROUNDS))
    rounds = F.array(*[F.lit(r) for r in (reversed(order) if back else order)])
    return F.aggregate(rounds, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), one)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _chars(text: Column) -> Column:
    return F.array_remove(F.split(text, "", -1), "")


def permute_characters(text: Column, tweak: Column, key: str, back: bool = False) -> Column:
    """A text with its ASCII digits and letters permuted, each within its class; other characters stay.

    The characters go in chunks of CHUNK; each chunk is a pair of mixed-radix numbers. The tweak of a chunk
    holds the classes of its characters, so texts of one form are permuted among themselves. A lone
    character is shifted by a hash of the tweak.
    """

    def radix(c: Column) -> Column:
        return F.when(F.lit(DIGITS).contains(c), 10).when(F.lit(LOWER + UPPER).contains(c), 26).otherwise(1).cast("long")

    def rank(c: Column) -> Column:
        alphabets = ((DIGITS, 1), (LOWER, 1), (UPPER, 1))
        found = F.lit(0)
        for alphabet, base in alphabets:
            found = F.when(F.lit(alphabet).contains(c), F.instr(F.lit(alphabet), c) - base).otherwise(found)
        return found.cast("long")

    def shown(c: Column, r: Column) -> Column:
        spot = (r + 1).cast("int")
        return (
            F.when(F.lit(DIGITS).contains(c), F.substr(F.lit(DIGITS), spot, F.lit(1)))
            .when(F.lit(LOWER).contains(c), F.substr(F.lit(LOWER), spot, F.lit(1)))
            .when(F.lit(UPPER).contains(c), F.substr(F.lit(UPPER), spot, F.lit(1)))
            .otherwise(c)
        )

    def number(chars: Column) -> Column:
        return F.aggregate(chars, F.lit(0).cast("long"), lambda n, c: n * radix(c) + rank(c))

    def size(chars: Column) -> Column:
        return F.aggregate(chars, F.lit(1).cast("long"), lambda n, c: n * radix(c))

    def written(chars: Column, n: Column) -> Column:
        start = F.struct(n.alias("n"), F.lit("").alias("t"))

        def one(s: Column, c: Column) -> Column:
            r = radix(c)
            return F.struct(F.floor(s["n"] / r).cast("long").alias("n"), F.concat(shown(c, F.pmod(s["n"], r)), s["t"]).alias("t"))

        return F.aggregate(F.reverse(chars), start, one)["t"]

    def chunk(chars: Column) -> Column:
        half = F.floor(F.size(chars) / 2).cast("int")
        left, right = F.slice(chars, F.lit(1), half), F.slice(chars, half + 1, F.size(chars) - half)
        classes = F.array_join(F.transform(chars, lambda c: F.when(F.lit(LOWER).contains(c), "a").when(F.lit(UPPER).contains(c), "A").when(F.lit(DIGITS).contains(c), "0").otherwise(c)), "")

        def pair(h: Column) -> Column:
            mixed = feistel(number(h["l"]), number(h["r"]), size(h["l"]), size(h["r"]), F.concat_ws("|", tweak, classes), key, back)
            return let(F.struct(mixed.alias("m"), h.alias("h")), lambda x: F.concat(written(x["h"]["l"], x["m"]["a"]), written(x["h"]["r"], x["m"]["b"])))

        return let(F.struct(left.alias("l"), right.alias("r")), pair)

    def all_chunks(chars: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(chars), F.lit(1)), F.lit(CHUNK))
        return F.array_join(F.transform(starts, lambda s: chunk(F.slice(chars, s, F.lit(CHUNK)))), "")

    return let(_chars(text), all_chunks)


def luhn_sum(digits: Column) -> Column:
    """Sum of a digit string with every second digit from the last but one doubled (and its digits added)."""

    def one(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.reverse(_chars(digits)), one), F.lit(0), lambda a, x: a + x)


def _refill(value: Column, digits: Column) -> Column:
    """The digits of ``value`` replaced by others, one by one."""

    def one(s: Column, c: Column) -> Column:
        is_digit = F.lit(DIGITS).contains(c)
        return F.struct(
            F.concat(s["t"], F.when(is_digit, F.substr(digits, s["i"], F.lit(1))).otherwise(c)).alias("t"),
            F.when(is_digit, s["i"] + 1).otherwise(s["i"]).alias("i"),
        )

    return F.aggregate(_chars(value), F.struct(F.lit("").alias("t"), F.lit(1).alias("i")), one)["t"]


def _pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _email(value: Column, key: str, back: bool) -> Column:
    local = F.substring_index(value, "@", 1)
    return F.concat(permute_characters(local, F.lit("email"), key, back), F.substr(value, F.length(local) + 1))


def _date(value: Column, form: str, key: str, back: bool) -> Column:
    day = F.try_to_date(value, form) if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(value, F.lit(form)))
    start = F.make_date(F.lit(FIRST_YEAR), F.lit(1), F.lit(1))

    def moved(d: Column) -> Column:
        n = F.date_diff(d, start)
        pair = feistel(F.floor(n / DAYS_B), F.pmod(n, F.lit(DAYS_B)), F.lit(DAYS_A), F.lit(DAYS_B), F.lit("date"), key, back)
        return F.when(
            d.isNotNull() & F.year(d).between(FIRST_YEAR, LAST_YEAR),
            let(pair, lambda p: F.date_format(F.date_add(start, (p["a"] * DAYS_B + p["b"]).cast("int")), form)),
        )

    return let(day, moved)


def _ssn(value: Column, key: str, back: bool) -> Column:
    def moved(d: Column) -> Column:
        area, group, serial = (F.substr(d, F.lit(i), F.lit(n)).cast("long") for i, n in ((1, 3), (4, 2), (6, 4)))
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        a = F.when(area > 666, area - 2).otherwise(area - 1) * 99 + group - 1
        pair = feistel(a, serial - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key, back)

        def shown(p: Column) -> Column:
            place = F.floor(p["a"] / 99)
            place = F.when(place >= 665, place + 2).otherwise(place + 1)
            return F.concat_ws("-", _pad(place, 3), _pad(F.pmod(p["a"], F.lit(99)) + 1, 2), _pad(p["b"] + 1, 4))

        return F.when(valid, let(pair, shown))

    return let(_digits(value), moved)


def _ipv4(value: Column, key: str, back: bool) -> Column:
    """First octets from 1 to 223 are permuted among themselves, and so are the others, 0 and from 224 on."""

    def moved(parts: Column) -> Column:
        o = [F.get(parts, F.lit(i)).cast("long") for i in range(4)]
        plain = F.concat_ws(".", *[x.cast("string") for x in o]) == value
        valid = plain & (o[0] < 256) & (o[1] < 256) & (o[2] < 256) & (o[3] < 256)
        unicast = o[0].between(1, 223)
        first = F.when(unicast, o[0] - 1).when(o[0] == 0, 0).otherwise(o[0] - 223)
        size = F.when(unicast, 223 * 256).otherwise(33 * 256).cast("long")
        tweak = F.when(unicast, "ipv4").otherwise("ipv4 other")
        pair = feistel(first * 256 + o[1], o[2] * 256 + o[3], size, F.lit(65536), tweak, key, back)

        def shown(p: Column) -> Column:
            place = F.floor(p["a"] / 256)
            place = F.when(unicast, place + 1).when(place == 0, 0).otherwise(place + 223)
            found = (place, F.pmod(p["a"], F.lit(256)), F.floor(p["b"] / 256), F.pmod(p["b"], F.lit(256)))
            return F.concat_ws(".", *[x.cast("string") for x in found])

        return F.when(valid, let(pair, shown))

    return let(F.split(value, r"\.", -1), moved)


def _card(value: Column, key: str, back: bool) -> Column:
    def moved(d: Column) -> Column:
        body = F.substr(d, F.lit(1), F.length(d) - 1)

        def closed(b: Column) -> Column:
            check = F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10))
            return _refill(value, F.concat(b, check.cast("string")))

        return F.when(luhn_sum(d) % 10 == 0, let(permute_characters(body, F.lit("card"), key, back), closed))

    return let(_digits(value), moved)


def _phone(value: Column, key: str, back: bool) -> Column:
    """The last ten digits; other digits stay.

    Area codes from 200 on are permuted among themselves, and so are those below, which no exchange
    gives out but which are written as numbers all the same where the area stands in brackets.
    """

    def moved(d: Column) -> Column:
        head, ten = F.substr(d, F.lit(1), F.length(d) - 10), F.substr(d, F.length(d) - 9)
        first = F.substr(ten, F.lit(1), F.lit(5)).cast("long")
        low, size = F.when(first < 20_000, 0).otherwise(20_000), F.when(first < 20_000, 20_000).otherwise(80_000)
        pair = feistel(first - low, F.substr(ten, F.lit(6)).cast("long"), size.cast("long"), F.lit(100_000), F.concat(F.lit("phone"), low.cast("string")), key, back)
        return let(pair, lambda p: _refill(value, F.concat(head, _pad(p["a"] + low, 5), _pad(p["b"], 5))))

    return let(_digits(value), moved)


def _phone_plus(value: Column, key: str, back: bool) -> Column:
    """All digits but the first two, which name the country."""

    def moved(d: Column) -> Column:
        tail = permute_characters(F.substr(d, F.lit(3)), F.concat(F.lit("phone"), F.substr(d, F.lit(1), F.lit(2))), key, back)
        return _refill(value, F.concat(F.substr(d, F.lit(1), F.lit(2)), tail))

    return let(_digits(value), moved)


KINDS = (
    ("email", EMAIL, _email),
    ("date", DATE_ISO, lambda v, k, b: _date(v, "yyyy-MM-dd", k, b)),
    ("date", DATE_DOT, lambda v, k, b: _date(v, "dd.MM.yyyy", k, b)),
    ("date", DATE_SLASH, lambda v, k, b: _date(v, "MM/dd/yyyy", k, b)),
    ("ssn", SSN, _ssn),
    ("ipv4", IPV4, _ipv4),
    ("phone", PHONE, _phone),
    ("card", CARD, _card),
    ("phone", PHONE_PLUS, _phone_plus),
)


def pseudonym(value: Column, key: str, back: bool = False) -> Column:
    """The struct (kind, text) of a found value; kind is null and the text unchanged where it isn't valid.

    ``back`` undoes it, for whoever holds the key.
    """
    made, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern, permute in reversed(KINDS):
        whole = value.rlike(f"^(?:{pattern})$")
        made = F.when(whole, permute(value, key, back)).otherwise(made)
        kind = F.when(whole, F.lit(name)).otherwise(kind)
    return let(
        F.struct(kind.alias("kind"), made.alias("text")),
        lambda x: F.struct(F.when(x["text"].isNotNull(), x["kind"]).alias("kind"), F.coalesce(x["text"], value).alias("text")),
    )


def pseudonymise(docs: DataFrame, key: str, back: bool = False, column: str = "text") -> DataFrame:
    """``docs`` with the values in ``column`` replaced, and ``pii``: kind, found and given of each, in text order.

    The text is split at its values and put together again, so nothing else changes and a pseudonym is never
    taken for a value. A null text stays null with no values; texts without a digit or @ are passed on
    unread. Each row is handled by itself: repeated rows and hot values need no shuffle.
    """
    text = F.col(column).cast("string")
    some = text.rlike(r"[0-9@]")
    found = F.when(some, F.regexp_extract_all(text, F.lit(f"({PATTERN})"), F.lit(1))).otherwise(F.array().cast("array<string>"))

    def replaced(v: Column) -> Column:
        return let(pseudonym(v, key, back), lambda p: F.struct(p["kind"].alias("kind"), v.alias("found"), p["text"].alias("given")))

    df = docs.withColumn("__pii_found", F.coalesce(found, F.array().cast("array<string>")))
    df = df.withColumn("__pii_new", F.transform("__pii_found", replaced))
    glued = F.array_join(
        F.transform(
            F.arrays_zip(F.split(text, PATTERN, -1).alias("part"), F.col("__pii_new").alias("new")),
            lambda x: F.concat(x["part"], F.coalesce(x["new"]["given"], F.lit(""))),
        ),
        "",
    )
    return df.withColumns(
        {column: F.when(F.size("__pii_found") == 0, text).otherwise(glued), "pii": F.filter("__pii_new", lambda x: x["kind"].isNotNull())}
    ).drop("__pii_found", "__pii_new")
