"""Format-preserving pseudonyms of personal values, in DataFrame functions only.

Candidates are found by pattern, then validated: card numbers by their check digit, IBANs by their
remainder, dates by the calendar, addresses, phone and social security numbers by their ranges. Each valid
value is numbered within its format and sent through a keyed Feistel network over exactly that range, so
the result is another valid value of the same format, different values stay different, and a value becomes
the same pseudonym in every document, however it is spaced. The local part of an e-mail address is permuted
character by character within letters and digits; its domain stays.

Defined results: null text stays null and has no findings; invalid candidates are left as they stand; text
without candidates is returned as it is. Rows are independent of each other, and repeated rows repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# What candidates look like.
EMAIL = r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})(?:\.[A-Za-z0-9-]{1,63}){1,8}"
# Lengths of the IBAN registry; a country that is not in it may have any length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    known = []
    for size, countries in IBAN_LENGTHS.items():
        fours, rest = divmod(size - 4, 4)
        last = f"(?: ?[A-Z0-9]{{{rest}}})" if rest else ""
        known.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}{last}")
    others = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    known.append(rf"(?!{others})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?")
    return rf"(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(known)})"


IBAN = _iban_pattern()
IPV4 = r"(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9])"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
NANP = r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
ABROAD = r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}"
CARD = r"[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{13,19}"
_ANY = "|".join((EMAIL, IBAN, IPV4, DATE, SSN, NANP, ABROAD, CARD))
# The date of a timestamp ends before its T.
_END = r"(?:(?![\p{L}\p{N}])|(?<=[0-9]{4}-[0-9]{2}-[0-9]{2})(?=T[0-9]{2}))"
PATTERN = rf"(?<![\p{{L}}\p{{N}}])(?:{_ANY}){_END}"

# Dates are numbered within four whole centuries of the calendar, from this day on.
_FIRST_DAY = "1700-01-01"
_DAYS = (189, 773)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it in `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _whole(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


class Feistel:
    """A keyed permutation; `purpose` separates the kinds of value from each other."""

    def __init__(self, key: str):
        self.key = hashlib.sha256(key.encode()).hexdigest()

    def _digest(self, purpose: str, step: Column, half: Column) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(self.key), F.lit(purpose), step.cast("string"), half), 256)

    def numbers(self, purpose: str, left: Column, right: Column, lefts: Column, rights: Column) -> Column:
        """Permute pairs (left, right) below (lefts, rights); a struct l, r."""

        def step(pair: Column, i: Column) -> Column:
            given = F.when(i % 2 == 0, pair["r"]).otherwise(pair["l"]).cast("string")
            drawn = _whole(F.conv(F.substr(self._digest(purpose, i, given), F.lit(1), F.lit(15)), 16, 10))
            return F.struct(
                F.when(i % 2 == 0, (pair["l"] + drawn) % lefts).otherwise(pair["l"]).cast("bigint").alias("l"),
                F.when(i % 2 == 0, pair["r"]).otherwise((pair["r"] + drawn) % rights).cast("bigint").alias("r"),
            )

        start = F.struct(_whole(left).alias("l"), _whole(right).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)

    def digits(self, purpose: str, digits: Column) -> Column:
        """Permute strings of up to 30 digits among those of the same length."""
        half = F.floor(F.length(digits) / 2).cast("int")
        rest = F.length(digits) - half
        left = F.when(half > 0, F.substr(digits, F.lit(1), half)).otherwise(F.lit("0"))
        pair = self.numbers(
            purpose, left, F.substr(digits, half + 1, rest), _whole(F.pow(F.lit(10), half)), _whole(F.pow(F.lit(10), rest))
        )
        done = _let(
            pair,
            lambda z: F.concat(
                F.when(half > 0, F.lpad(z["l"].cast("string"), half, F.lit("0"))).otherwise(F.lit("")),
                F.lpad(z["r"].cast("string"), rest, F.lit("0")),
            ),
        )
        return F.when(F.length(digits) > 0, done).otherwise(digits)

    def characters(self, purpose: str, text: Column) -> Column:
        """Permute strings of up to 64 characters; every character stays a digit, a small or a capital letter."""

        def shifted(half: Column, other: Column, i: Column) -> Column:
            digest = self._digest(purpose, i, F.lower(other))

            def one(c: Column, place: Column) -> Column:
                by = F.conv(F.substr(digest, place * 2 + 1, F.lit(2)), 16, 10).cast("int")
                moved = F.lit(None).cast("string")
                for first, size in (("0", 10), ("a", 26), ("A", 26)):
                    here = (c >= first) & (c <= chr(ord(first) + size - 1))
                    moved = F.when(here, F.char(F.lit(ord(first)) + (F.ascii(c) - ord(first) + by) % size)).otherwise(moved)
                return F.coalesce(moved, c)

            return F.when(half == "", half).otherwise(F.array_join(F.transform(F.split(half, "", -1), one), ""))

        def step(pair: Column, i: Column) -> Column:
            even = i % 2 == 0
            return F.struct(
                F.when(even, shifted(pair["l"], pair["r"], i)).otherwise(pair["l"]).alias("l"),
                F.when(even, pair["r"]).otherwise(shifted(pair["r"], pair["l"], i)).alias("r"),
            )

        half = F.floor(F.length(text) / 2).cast("int")
        start = F.struct(
            F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text) - half).alias("r")
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda pair: F.concat(pair["l"], pair["r"])
        )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _filled(form: Column, digits: Column) -> Column:
    """`form` with its digits replaced in order."""

    def step(held: Column, c: Column) -> Column:
        is_digit = (c >= "0") & (c <= "9")
        return F.struct(
            F.concat(held["text"], F.when(is_digit, F.substr(digits, held["next"], F.lit(1))).otherwise(c)).alias("text"),
            (held["next"] + F.when(is_digit, 1).otherwise(0)).alias("next"),
        )

    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))
    return F.aggregate(F.split(form, "", -1), start, step, lambda held: held["text"])


def _check_digit(body: Column) -> Column:
    """The last digit that makes a card number's doubled sum divide by ten."""

    def step(total: Column, i: Column) -> Column:
        digit = F.substr(body, i, F.lit(1)).cast("int") * F.when((F.length(body) - i) % 2 == 0, 2).otherwise(1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(body)), F.lit(0), step)
    return ((10 - total % 10) % 10).cast("string")


def _remainder(letters: Column) -> Column:
    """Digits and capitals, read as numbers from 10 on, modulo 97."""

    def step(held: Column, c: Column) -> Column:
        digit = (c >= "0") & (c <= "9")
        return F.when(digit, (held * 10 + F.ascii(c) - 48) % 97).otherwise((held * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(letters, "", -1), F.lit(0), step)


class Values:
    """One expression per kind: the pseudonym of a valid value, null for anything else."""

    def __init__(self, key: str):
        self.feistel = Feistel(key)

    def email(self, value: Column) -> Column:
        local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
        return F.when(value.contains("@"), F.concat(self.feistel.characters("email", local), F.lit("@"), domain))

    def iban(self, value: Column) -> Column:
        plain = F.replace(value, F.lit(" "), F.lit(""))
        country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
        valid = value.rlike(f"^(?:{IBAN})$") & (_remainder(F.concat(account, F.substr(plain, F.lit(1), F.lit(4)))) == 1)
        changed = _filled(account, self.feistel.digits("iban", _digits(account)))

        def spaced(account: Column) -> Column:
            check = F.lpad((98 - _remainder(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")
            return _filled(value, F.concat(check, _digits(account)))

        return F.when(valid, _let(changed, spaced))

    def ipv4(self, value: Column) -> Column:
        parts = F.transform(F.split(value, r"\.", -1), lambda p: p.cast("int"))
        first = parts[0]
        valid = value.rlike(f"^(?:{IPV4})$") & F.forall(parts, lambda p: p <= 255)
        host = (first >= 1) & (first <= 223)
        row = F.when(host, first - 1).when(first == 0, 0).otherwise(first - 223)
        lefts = F.when(host, 223 * 256).otherwise(33 * 256)
        pair = self.feistel.numbers("ipv4", row * 256 + parts[1], parts[2] * 256 + parts[3], lefts, F.lit(65536))

        def joined(z: Column) -> Column:
            row = F.floor(z["l"] / 256)
            first = F.when(host, row + 1).when(row == 0, row).otherwise(row + 223)
            octets = (first, z["l"] % 256, F.floor(z["r"] / 256), z["r"] % 256)
            return F.concat_ws(".", *[o.cast("bigint").cast("string") for o in octets])

        return F.when(valid, _let(pair, joined))

    def _moved_day(self, day: Column, long: str, short: str, is_long: Column) -> Column:
        lefts, rights = _DAYS
        start = F.lit(_FIRST_DAY).cast("date")
        number = F.datediff(day, start)
        pair = self.feistel.numbers("date", F.floor(number / rights), number % rights, F.lit(lefts), F.lit(rights))

        def written(z: Column) -> Column:
            moved = F.date_add(start, (z["l"] * rights + z["r"]).cast("int"))
            return F.when(is_long, F.date_format(moved, long)).otherwise(F.date_format(moved, short))

        inside = day.isNotNull() & (number >= 0) & (number < lefts * rights)
        return F.when(inside, _let(pair, written))

    def date(self, value: Column) -> Column:
        is_long = F.length(value) == 10
        readings = (
            ("-", "yyyy-MM-dd", "yyyy-MM-dd", "yyyy-MM-dd"),
            (".", "d.M.yyyy", "dd.MM.yyyy", "d.M.yyyy"),
            ("/", "M/d/yyyy", "MM/dd/yyyy", "M/d/yyyy"),
            ("/", "d/M/yyyy", "dd/MM/yyyy", "d/M/yyyy"),
        )
        done = []
        for mark, reading, long, short in readings:
            day = F.when(value.contains(mark), F.try_to_timestamp(value, F.lit(reading)).cast("date"))
            done.append(self._moved_day(day, long, short, is_long))
        return F.when(value.rlike(f"^(?:{DATE})$"), F.coalesce(*done))

    def ssn(self, value: Column) -> Column:
        area, group, serial = (F.substr(value, F.lit(a), F.lit(n)).try_cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
        valid = value.rlike(f"^(?:{SSN})$") & (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        row = area - F.when(area > 666, 2).otherwise(1)
        pair = self.feistel.numbers("ssn", row * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))

        def joined(z: Column) -> Column:
            area = F.floor(z["l"] / 99) + 1
            area = area + F.when(area >= 666, 1).otherwise(0)
            parts = ((area, 3), (z["l"] % 99 + 1, 2), (z["r"] + 1, 4))
            return F.concat_ws("-", *[F.lpad(p.cast("bigint").cast("string"), n, "0") for p, n in parts])

        return F.when(valid, _let(pair, joined))

    def phone(self, value: Column) -> Column:
        digits = _digits(value)
        own = F.right(digits, F.lit(10))
        area, exchange, line = (F.substr(own, F.lit(a), F.lit(n)).try_cast("int") for a, n in ((1, 3), (4, 3), (7, 4)))
        valid = value.rlike(f"^(?:{NANP})$") & (area >= 200) & (exchange >= 200)
        left = (area - 200) * 100 + F.floor((exchange - 200) / 8)
        right = (exchange - 200) % 8 * 10_000 + line
        pair = self.feistel.numbers("phone", left, right, F.lit(80_000), F.lit(80_000))

        def joined(z: Column) -> Column:
            parts = (
                (F.floor(z["l"] / 100) + 200, 3),
                (z["l"] % 100 * 8 + F.floor(z["r"] / 10_000) + 200, 3),
                (z["r"] % 10_000, 4),
            )
            new = F.concat(*[F.lpad(p.cast("bigint").cast("string"), n, "0") for p, n in parts])
            return _filled(value, F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10), new))

        return F.when(valid, _let(pair, joined))

    def abroad(self, value: Column) -> Column:
        digits = _digits(value)
        valid = value.rlike(f"^(?:{ABROAD})$") & (F.length(digits) >= 8) & (F.length(digits) <= 15)
        kept, changed = F.substr(digits, F.lit(1), F.lit(3)), F.substr(digits, F.lit(4), F.length(digits))
        return F.when(valid, _let(self.feistel.digits("abroad", changed), lambda new: _filled(value, F.concat(kept, new))))

    def card(self, value: Column) -> Column:
        digits = _digits(value)
        size = F.length(digits)
        body = F.substr(digits, F.lit(1), size - 1)
        valid = value.rlike(f"^(?:{CARD})$") & (size >= 13) & (size <= 19) & (_check_digit(body) == F.right(digits, F.lit(1)))
        new = F.concat(F.substr(digits, F.lit(1), F.lit(1)), self.feistel.digits("card", F.substr(digits, F.lit(2), size - 2)))
        return F.when(valid, _let(new, lambda body: _filled(value, F.concat(body, _check_digit(body)))))

    def finding(self, value: Column) -> Column:
        """A struct of the value's kind and pseudonym; both null if no kind takes it."""
        kinds = ("email", "iban", "ipv4", "date", "ssn", "phone", "abroad", "card")
        tried = F.array(*[F.struct(F.lit(k).alias("kind"), getattr(self, k)(value).alias("new")) for k in kinds])
        found = F.filter(tried, lambda f: f["new"].isNotNull())
        return F.when(F.size(found) > 0, F.element_at(found, 1))


def pseudonymised(docs: DataFrame, key: str, into: str = "findings") -> DataFrame:
    """All columns of `docs` with `text` replaced, and in column `into` kind and pseudonym of every value, in order."""
    values = Values(key)
    likely = F.col("text").rlike("[0-9@]")
    none = F.array().cast("array<struct<gap:string,old:string,kind:string,new:string>>")
    matches = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    gaps = F.slice(F.split("text", PATTERN, -1), 2, F.greatest(F.size(matches), F.lit(0)))
    first = F.element_at(F.split("text", PATTERN, 2), 1)

    def told(z: Column) -> Column:
        return _let(
            values.finding(z["old"]),
            lambda f: F.struct(z["gap"].alias("gap"), z["old"].alias("old"), f["kind"].alias("kind"), f["new"].alias("new")),
        )

    parts = F.transform(F.arrays_zip(matches.alias("old"), gaps.alias("gap")), told)
    found = docs.withColumn(into, F.when(likely, parts).otherwise(none))
    rest = F.array_join(F.transform(into, lambda z: F.concat(F.coalesce(z["new"], z["old"]), z["gap"])), "")
    text = F.when(likely & (F.size(into) > 0), F.concat(first, rest)).otherwise(F.col("text"))
    valid = F.filter(into, lambda z: z["kind"].isNotNull())
    told_only = F.transform(valid, lambda z: F.struct(z["kind"].alias("kind"), z["new"].alias("pseudonym")))
    return found.withColumn("text", text).withColumn(into, told_only)
