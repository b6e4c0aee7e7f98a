"""Format-preserving pseudonyms for personal data, with DataFrame functions only."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import let

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# Characters of an IBAN by country.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}
_IBAN = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[0-9A-Z]){{{n - 4}}}" for n, c in _IBAN_LENGTHS.items())
_DAY = "(?:0?[1-9]|[12][0-9]|3[01])"
_YEAR = "(?:1[89]|2[01])[0-9]{2}"
# Names of the months.
MONTHS = {
    "en": "January February March April May June July August September October November December",
    "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "short": "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec",
}
_ENGLISH = "|".join(f"{MONTHS['en']} {MONTHS['short']}".split())
_NAMED = "|".join(" ".join(MONTHS.values()).split())
# The first pattern that matches at a place counts.
PATTERNS = {
    # Labels and dots are one class: a repeated group would recurse once for each label.
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "iban": rf"(?<![0-9A-Za-z])(?:{_IBAN})(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "date": rf"(?<![0-9A-Za-z-]){_YEAR}([-/.])(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])(?!(?!T[0-9]{{2}}:)[0-9A-Za-z-])"
    rf"|(?<![0-9A-Za-z./-]){_DAY}([-/.]){_DAY}\2{_YEAR}(?!(?!T[0-9]{{2}}:)[0-9A-Za-z]|[-/.][0-9])"
    rf"|(?<![0-9A-Za-z./-]){_DAY}/{_DAY}/[0-9]{{2}}(?![0-9A-Za-z]|[-/.][0-9])"
    # Months by name.
    rf"|(?<![0-9A-Za-z.,/-]){_DAY}\.?(?: de)? (?:{_NAMED})\.?(?: de)? {_YEAR}(?![0-9A-Za-z])"
    rf"|(?<![0-9A-Za-z])(?=[JFMASOND][a-z]{{2}})(?:{_ENGLISH})\.? {_DAY},? {_YEAR}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9A-Za-z])"
    # Any grouping of 8 to 15 digits after a plus; area codes in brackets; national numbers with 0.
    r"|(?<![0-9A-Za-z])\+(?=[1-9](?:[ .()/-]{0,2}[0-9]){7,14}(?![0-9A-Za-z]))[1-9][0-9]{0,2}(?:[ ./-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})){2,7}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])\([0-9]{2,5}\)[ /-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.,/-])0[0-9](?:[ .-][0-9]{2}){4}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.,/-])0[1-9][0-9]{1,3}[ /-][0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "number": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
ANY = "|".join(PATTERNS.values())
KINDS = list(PATTERNS)

ROUNDS = 10


def permuted(values: Column, radices: Column, tweak: Column, key: str) -> Column:
    """A keyed permutation of digit lists: each value stays below its radix.

    A Feistel network: in turn, the digits at even and at odd places are shifted by a keyed hash
    of the other ones, so it can be undone.
    """

    def network(sizes: Column) -> Column:
        def shift(v: Column, r: Column) -> Column:
            others = F.filter(v, lambda _, i: i % 2 != r % 2)
            digest = F.sha2(
                F.concat_ws("|", F.lit(key), tweak, F.array_join(sizes, ","), r, F.array_join(others, ",")), 256
            )

            def moved(d: Column) -> Column:
                def each(x: Column, i: Column) -> Column:
                    radix = F.get(sizes, i)
                    drawn = F.conv(F.substring(F.sha2(F.concat(d, i.cast("string")), 256), 1, 15), 16, 10)
                    new = F.pmod(x + drawn.cast("bigint"), radix).cast("int")
                    return F.when((i % 2 == r % 2) & (radix > 1), new).otherwise(x)

                return F.transform(v, each)

            return let(digest, moved)

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, shift)

    # Worked out once, not once for each digit.
    return let(radices, network)


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(text)), lambda i: F.substring(text, i, 1))


def _classes(chars: Column, first_digits: bool) -> Column:
    """Per character the first one of its class, the size of the class and the place in it.

    With ``first_digits``, a digit after another character keeps being 0, 1 or neither, as area
    codes need it.
    """

    def each(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        digit = c.between("0", "9")
        starts = F.lit(first_digits) & ~F.coalesce(F.get(chars, i - 1).between("0", "9"), F.lit(False))
        base = (
            F.when(digit & starts & (code >= 50), 50)
            .when(digit, 48)
            .when(c.between("a", "z"), 97)
            .when(c.between("A", "Z"), 65)
            .otherwise(code)
        )
        size = (
            F.when(digit & starts, F.when(code >= 50, 8).otherwise(2))
            .when(digit, 10)
            .when(c.between("a", "z") | c.between("A", "Z"), 26)
            .otherwise(1)
        )
        return F.struct(base.alias("base"), size.alias("size"), (code - base).alias("value"))

    return F.transform(chars, each)


def _text_pseudonym(text: Column, kind: str, key: str, first_digits: bool = False) -> Column:
    """Letters and digits replaced by others of their kind, all else kept."""

    def of(classes: Column) -> Column:
        new = permuted(F.transform(classes, lambda c: c.value), F.transform(classes, lambda c: c.size), F.lit(kind), key)
        return F.array_join(F.zip_with(classes, new, lambda c, v: F.char(c.base + v)), "")

    pseudonym = let(_chars(text), lambda chars: let(_classes(chars, first_digits), of))
    return F.when(F.char_length(text) > 0, pseudonym).otherwise(text)


def _after(text: Column, prefix: str, then) -> Column:
    """What matches ``prefix`` is kept, and the rest goes through ``then``."""
    kept = F.regexp_extract(text, prefix, 0)
    return F.concat(kept, then(F.substr(text, F.char_length(kept) + 1)))


def _luhn(number: Column) -> Column:
    """Check sum of the digits from the right, every second one doubled, modulo 10."""

    def add(total: Column, x: Column, i: Column) -> Column:
        doubled = F.when(i % 2 == 1, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)
        return total + doubled

    digits = F.transform(_chars(F.reverse(F.regexp_replace(number, "[^0-9]", ""))), lambda c: F.ascii(c) - 48)
    doubled = F.transform(digits, lambda x, i: add(F.lit(0), x, i))
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda a, x: a + x), F.lit(10))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _laid_out(digits: Column, like: Column) -> Column:
    """The digits with the other characters of ``like`` between them, at the same places."""
    upto = lambda i: F.char_length(_digits(F.left(like, i + 1)))
    return F.array_join(
        F.transform(
            _chars(like), lambda c, i: F.when(c.between("0", "9"), F.substr(digits, upto(i), F.lit(1))).otherwise(c)
        ),
        "",
    )


def _number(number: Column, key: str) -> Column:
    """Another number of as many digits whose check sum holds, in the layout of the given one.

    The digits are permuted without their layout, so a number has one pseudonym in all layouts.
    """

    def of(digits: Column) -> Column:
        body = F.left(digits, F.char_length(digits) - 1)

        def closed(n: Column) -> Column:
            return F.concat(n, F.pmod(-_luhn(F.concat(n, F.lit("0"))), F.lit(10)).cast("string"))

        return let(let(_text_pseudonym(body, "number", key), closed), lambda new: _laid_out(new, number))

    return let(_digits(number), of)


# Areas, groups and serials that no social security number has.
_SSN = r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"


def _ssn(text: Column, key: str) -> Column:
    """Area, group and serial replaced by others that exist."""
    area, group, serial = (F.split(text, "-")[i].cast("int") for i in range(3))
    nth = area - 1 - F.when(area > 666, 1).otherwise(0)

    def shown(v: Column) -> Column:
        new = F.get(v, 0) + 1 + F.when(F.get(v, 0) >= 665, 1).otherwise(0)
        parts = [(new, 3), (F.get(v, 1) + 1, 2), (F.get(v, 2) + 1, 4)]
        return F.concat_ws("-", *[F.lpad(n.cast("string"), size, "0") for n, size in parts])

    values, radices = F.array(nth, group - 1, serial - 1), F.array(F.lit(898), F.lit(99), F.lit(9999))
    return let(permuted(values, radices, F.lit("ssn"), key), shown)


def _address(address: Column, key: str) -> Column:
    """Octets replaced by others with as many digits."""
    octets = F.split(address, r"\.")
    low = lambda o: F.when(F.char_length(o) == 1, 0).when(F.char_length(o) == 2, 10).otherwise(100)
    size = lambda o: F.when(F.char_length(o) == 1, 10).when(F.char_length(o) == 2, 90).otherwise(156)

    def of(parts: Column) -> Column:
        values = F.transform(parts, lambda o: o.cast("int") - low(o))
        new = permuted(values, F.transform(parts, size), F.lit("ip"), key)
        return F.array_join(F.zip_with(parts, new, lambda o, v: (low(o) + v).cast("string")), ".")

    return let(octets, of)


def _month_names(name: Column, dotted: Column) -> Column:
    """The twelve names of the language (or of the short forms) that a month's name is of; null if of none."""
    lists = {of: F.array(*[F.lit(m) for m in names.split()]) for of, names in MONTHS.items()}
    held = {of: F.when(F.array_contains(names, name), names) for of, names in lists.items()}
    return F.when(dotted, F.coalesce(held["de"], *held.values())).otherwise(F.coalesce(*held.values()))


def _months(day: Column, month: Column) -> Column:
    """The months, as long in digits as the given one, that have such a day."""
    few = lambda *months: F.array(*[F.lit(m) for m in months])
    return (
        F.when(month == 2, F.when(day == 29, few(2)).otherwise(few(*range(1, 10))))
        .when(day == 31, F.when(month < 10, few(1, 3, 5, 7, 8)).otherwise(few(10, 12)))
        .when(month > 9, few(10, 11, 12))
        .when(day > 28, few(1, 3, 4, 5, 6, 7, 8, 9))
        .otherwise(few(*range(1, 10)))
    )


def _leap_year(nth: Column) -> Column:
    """The leap years from 1800 on, the first of which is 1804."""
    q = nth + 1
    q = q + F.when(q >= 25, 1).otherwise(0)
    return 1800 + 4 * (q + F.when(q >= 75, 1).otherwise(0))


def _moved_day(date: Column, short: Column, key: str) -> Column:
    """Another day, month and year for an array of these, of the years 1800 to 2199, or 2000 to 2099 if ``short``.

    Days up to 9, 10 to 12, 13 to 28, 29 and 30, and 31 stay among themselves, as do months up to 9 and
    from 10 on. So a day keeps its length and its reading in every layout, and 29 February gets another
    leap year.
    """
    day, month, year = (F.get(date, i) for i in range(3))
    leap = (day == 29) & (month == 2)
    low = F.when(day < 10, 1).when(day < 13, 10).when(day < 29, 13).when(leap | (day < 31), 29).otherwise(31)
    days = F.when(leap, 1).when(day < 10, 9).when(day < 13, 3).when(day < 29, 16).when(day < 31, 2).otherwise(1)
    side = F.when(short, 10).otherwise(20)
    n = year - F.when(short, 2000).otherwise(1800)
    skipped = F.floor(n / 4).cast("int")
    nth = skipped - 1 - F.when(skipped > 25, 1).otherwise(0) - F.when(skipped > 75, 1).otherwise(0)

    def among(months: Column) -> Column:
        first = F.array(day - low, F.array_position(months, month).cast("int") - 1)
        years = F.when(leap, F.array(F.when(short, skipped).otherwise(nth), F.lit(0)))
        values = F.concat(first, years.otherwise(F.array(F.floor(n / side).cast("int"), n % side)))
        sizes = F.when(leap, F.array(F.when(short, 25).otherwise(97), F.lit(1))).otherwise(F.array(side, side))
        radices = F.concat(F.array(days, F.size(months)), sizes)
        tweak = F.concat_ws(",", F.lit("day"), low.cast("string"), F.get(months, 0).cast("string"), short.cast("string"))

        def moved(v: Column) -> Column:
            in_leap = F.when(short, 2000 + 4 * F.get(v, 2)).otherwise(_leap_year(F.get(v, 2)))
            plain = F.when(short, 2000).otherwise(1800) + F.get(v, 2) * side + F.get(v, 3)
            return F.array(F.get(v, 0) + low, F.get(months, F.get(v, 1)), F.when(leap, in_leap).otherwise(plain))

        return let(permuted(values, radices, tweak, key), moved)

    return let(_months(day, month), among)


def _date(text: Column, key: str) -> Column:
    """A day for another, in the same layout; no change where the day does not exist.

    The day is permuted without its layout, so it has one pseudonym in all layouts with four digits of
    the year. Where both numbers before the year are up to 12, the month is the first one if slashes
    are between them, else the second one. Years of two digits are permuted among themselves, with the
    leap years of 2000 to 2099.
    """
    name = F.regexp_extract(text, r"\p{L}{3,}", 0)
    named, year_first = F.char_length(name) > 0, F.rlike(text, F.lit("^[0-9]{4}"))
    pad = lambda n, like: F.lpad(n.cast("string"), F.char_length(like), F.lit("0"))

    def of(numbers: Column, names: Column) -> Column:
        a, b, c = (F.get(numbers, i) for i in range(3))
        x, y = a.cast("int"), b.cast("int")
        day_first = F.when(x > 12, True).when(y > 12, False).otherwise(~F.contains(text, F.lit("/")))
        year_text = F.when(year_first, a).when(named, b).otherwise(c)
        short = F.char_length(year_text) == 2
        year = year_text.cast("int") + F.when(short, 2000).otherwise(0)
        month = (
            F.when(named, F.array_position(names, name).cast("int"))
            .when(year_first | day_first, y)
            .otherwise(x)
        )
        day = F.when(named, x).when(year_first, c.cast("int")).when(day_first, x).otherwise(y)
        two = lambda n: F.lpad(n.cast("string"), 2, "0")
        exists = F.try_to_date(F.concat_ws("-", year.cast("string"), two(month), two(day)), "yyyy-MM-dd").isNotNull()

        def shown(new: Column) -> Column:
            d, m, y4 = F.get(new, 0), F.get(new, 1), F.get(new, 2).cast("string")
            in_year = F.when(short, F.right(y4, F.lit(2))).otherwise(y4)
            mark = F.regexp_extract(text, "[^0-9]", 0)
            between = lambda i, parts: F.regexp_extract(text, parts, i)
            late, early = r"^[0-9]+([^0-9]*?)\p{L}{3,}([^0-9]*)", r"^\p{L}+([^0-9]+)[0-9]+([^0-9]+)"
            by_name = F.when(
                F.rlike(text, F.lit("^[0-9]")),
                F.concat(pad(d, a), between(1, late), F.get(names, m - 1), between(2, late), in_year),
            ).otherwise(F.concat(F.get(names, m - 1), between(1, early), pad(d, a), between(2, early), in_year))
            first, second = F.when(day_first, d).otherwise(m), F.when(day_first, m).otherwise(d)
            return (
                F.when(named, by_name)
                .when(year_first, F.concat_ws("", in_year, mark, pad(m, b), mark, pad(d, c)))
                .otherwise(F.concat(pad(first, a), mark, pad(second, b), mark, in_year))
            )

        moved = let(F.array(day, month, year), lambda date: _moved_day(date, short, key))
        return F.when(exists, let(moved, shown)).otherwise(text)

    numbers = F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))
    dotted = F.rlike(text, F.lit(r"^[0-9]+\."))
    return let(numbers, lambda ns: let(_month_names(name, dotted), lambda names: of(ns, names)))


def _remainder(iban: Column) -> Column:
    """The number that an IBAN without blanks stands for, its first four characters last, modulo 97."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.left(iban, F.lit(4)))
    codes = F.transform(_chars(turned), lambda c: F.ascii(c))

    def add(total: Column, code: Column) -> Column:
        return F.when(code < 65, total * 10 + code - 48).otherwise(total * 100 + code - 55) % 97

    return F.aggregate(codes, F.lit(0), add)


def _iban(text: Column, key: str) -> Column:
    """Another account of the same country, with check digits that fit; no change where they don't."""

    def of(plain: Column) -> Column:
        rest = _text_pseudonym(F.substr(text, F.lit(5)), "iban", key)
        country = F.left(text, F.lit(2))

        def closed(new: Column) -> Column:
            off = _remainder(F.concat(country, F.lit("00"), F.replace(new, F.lit(" "), F.lit(""))))
            return F.concat(country, F.lpad((98 - off).cast("string"), 2, "0"), new)

        return F.when(_remainder(plain) == 1, let(rest, closed)).otherwise(text)

    return let(F.replace(text, F.lit(" "), F.lit("")), of)


# Of what has the form of personal data but is none.
NONE = "none"


def kind_of(found: Column) -> Column:
    """The kind of a match of ``ANY``; ``none`` for numbers that no one has.

    A long number needs its check sum, and a social security number an area, group and serial
    that exist.
    """
    digits = _digits(found)
    return (
        F.when(F.contains(found, F.lit("@")), "email")
        .when(F.rlike(found, F.lit(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$")) & (F.char_length(digits) <= 12)
              & F.rlike(found, F.lit(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")), "ip")
        .when(F.rlike(found, F.lit(r"^(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}"
                                   r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}|[0-9]{1,2}[^0-9]*\p{L}.*|\p{L}{3}.*)$")), "date")
        .when(F.rlike(found, F.lit("^[A-Z]")), "iban")
        .when(F.rlike(found, F.lit("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")), F.when(F.rlike(found, F.lit(_SSN)), "ssn").otherwise(NONE))
        .when(F.rlike(found, F.lit("^[+(]")) | (F.char_length(digits) < 13), "phone")
        .otherwise(F.when(_luhn(found) == 0, "number").otherwise(NONE))
    )


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of one match; equal matches have equal ones."""
    country = r"^(?:\+[1-9][0-9]{0,2}(?=[ .(-])|\+[1-9])"
    at_end = r"\.[A-Za-z]+$"
    name = F.regexp_replace(found, at_end, "")

    def of(kind: Column) -> Column:
        return (
            F.when(kind == "email", F.concat(_text_pseudonym(name, "email", key), F.regexp_extract(found, at_end, 0)))
            .when(kind == "ip", _address(found, key))
            .when(kind == "iban", _iban(found, key))
            .when(kind == "date", _date(found, key))
            .when(kind == "phone", _after(found, country, lambda rest: _text_pseudonym(rest, "phone", key, True)))
            .when(kind == "ssn", _ssn(found, key))
            .when(kind == "number", _number(found, key))
            .otherwise(found)
        )

    return let(kind_of(found), of)


def pseudonymise(docs: DataFrame, text_col: str = "text", *, key: str, counts: str | None = None) -> DataFrame:
    """The documents with all personal data in their texts replaced, in place and, but for names of months, in length.

    Found are e-mail addresses, IBANs, IPv4 addresses, dates (in digits with year, day or month first, or
    with the month's name in English, German, Spanish or French), telephone numbers (with a country code in any grouping, or national ones with separators),
    social security numbers, and numbers of 13 to 19 digits such as those of cards. Octets, days of
    the calendar, check digits of IBANs, check sums of long numbers and areas, groups and serials are
    validated: what does not hold is left as it is. Each value is permuted among the valid ones of its
    format by a Feistel network under ``key``, which must not be empty, so equal values get equal
    pseudonyms in all documents, long numbers and days also in any layout, and different ones different.

    A row per row, with all its columns; with ``counts``, a column of that name has the number of
    values found per kind, a map. Null texts stay null, and texts without personal data as they are.
    """
    if not key:
        raise ValueError("pseudonyms without a key can be undone by anyone")
    # Of a fixed length, and plans and logs show it instead of the key.
    key = hashlib.sha256(key.encode()).hexdigest()
    text = F.col(text_col)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    between = F.split(text, ANY, -1)

    def joined(values: Column) -> Column:
        new = F.transform(values, lambda v: pseudonym(v, key))
        return F.array_join(
            F.zip_with(between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
        )

    replaced = let(found, lambda values: F.when(F.size(values) > 0, joined(values)).otherwise(text))
    likely = F.rlike(text, F.lit("[0-9]|@"))
    result = F.when(likely, replaced).otherwise(text)
    if counts is None:
        return docs.withColumn(text_col, result)
    def count(kinds: Column, kind: str) -> Column:
        return F.size(F.filter(kinds, lambda k: k == kind)).cast("bigint")

    def tally(kinds: Column) -> Column:
        return F.create_map(*[part for k in KINDS for part in (F.lit(k), count(kinds, k))])

    kinds = let(found, lambda values: let(F.transform(values, kind_of), tally))
    return docs.withColumns({text_col: result, counts: kinds})
