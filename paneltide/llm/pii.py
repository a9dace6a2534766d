"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Card numbers (checked by their Luhn digit), phone numbers, IPv4 addresses and
calendar dates are found by one pattern and replaced by a keyed Feistel
permutation of their own format: digits stay digits, punctuation stays in
place, a card keeps a valid check digit, an address valid octets, a date is a
date between 1900 and 2099.  The same value gets the same pseudonym in every
document, different values of one format different ones.  The local part of a
mail address, which has no fixed format, becomes letters of a keyed digest.

Not found, hence left in clear: phone numbers in other groupings than 3-3-4 or
without separators, social security numbers, IBANs, IPv6 addresses, dates written
with names or one-digit parts.

The round function is SHA-256 over key, format, round and half.  Everything is
DataFrame expressions over one row, so nothing is shuffled.

Defined results: null stays null; candidates that fail their check (Luhn,
octets, calendar, years outside 1900-2099) stay as they are and are not
counted; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

#: Fixed patterns, tried in this order at each place.
EMAIL = r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[./-][0-9])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9]|[ -][0-9])"
PATTERN = "|".join((EMAIL, DATE, IPV4, PHONE, CARD))
#: Every match has one of these.
HINT = r"@|[0-9][0-9./() -]{5,}[0-9]"
KINDS = ("email", "date", "ip", "phone", "card")
ROUNDS = 10
_DAYS, _DAY_LEFT, _DAY_RIGHT = 73_049, 271, 270          # 1900-01-01 to 2099-12-31; 271 * 270 >= days


def _noise(key: str, tag: Column, i: Column, half: Column) -> Column:
    text = F.concat_ws(":", F.lit(key), tag, i.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, tag: Column) -> Column:
    """Struct (a, b): a keyed permutation of [0, left_size) x [0, right_size)."""
    def one(acc, i):
        a = F.pmod(acc["a"] + _noise(key, tag, i, acc["b"]), left_size)
        b = F.pmod(acc["b"] + _noise(key, tag, i, acc["a"]), right_size)
        return F.struct(F.when(i % 2 == 0, a).otherwise(acc["a"]).alias("a"), F.when(i % 2 == 1, b).otherwise(acc["b"]).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("long").alias("a"), right.cast("long").alias("b")), one)


def _ten_to(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def digits(value: Column, key: str, tag: str) -> Column:
    """Permute a string of 2 to 36 digits among the strings of its length."""
    n = F.length(value)
    u = F.floor(n / 2).cast("int")

    def run(x):
        left, right = F.substr(x, F.lit(1), u).cast("long"), F.substr(x, u + 1).cast("long")
        moved = feistel(left, right, _ten_to(u), _ten_to(n - u), key, F.concat(F.lit(tag), n.cast("string")))
        return let(moved, lambda m: F.concat(F.lpad(m["a"].cast("string"), u, "0"), F.lpad(m["b"].cast("string"), n - u, "0")))
    return let(value, run)


def luhn_sum(value: Column) -> Column:
    """Luhn sum of a digit string, the last digit counting once."""
    return let(F.reverse(value), lambda r: F.aggregate(
        F.sequence(F.lit(1), F.length(r)), F.lit(0), lambda acc, i: acc + let(
            F.substr(r, i, F.lit(1)).cast("int") * (2 - i % 2), lambda d: F.when(d > 9, d - 9).otherwise(d))))


def _fill(shape: Column, new: Column) -> Column:
    """``shape`` with its digits replaced, in order, by those of ``new``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def one(acc, i):
        c = F.substr(shape, i, F.lit(1))
        digit = c.between("0", "9")
        return F.struct(F.concat(acc["out"], F.when(digit, F.substr(new, acc["k"], F.lit(1))).otherwise(c)).alias("out"),
                        (acc["k"] + digit.cast("int")).alias("k"))
    return F.aggregate(F.sequence(F.lit(1), F.length(shape)), start, one, lambda acc: acc["out"])


def _email(m: Column, key: str) -> Column:
    local, domain = F.regexp_extract(m, "^([^@]*)@(.*)$", 1), F.regexp_extract(m, "^([^@]*)@(.*)$", 2)
    digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit("mail"), F.lower(m)).cast("binary"), 256)
    letters = F.translate(F.substring(digest, 1, 16), "0123456789abcdef", "ghijklmnopqrstuv")
    return F.concat(F.when(F.length(local) > 0, letters), F.lit("@"), domain)


def _ip(m: Column, key: str) -> Column:
    def run(o):
        part = lambda i: o[i].cast("int")
        half = F.lit(65_536)
        moved = feistel(part(0) * 256 + part(1), part(2) * 256 + part(3), half, half, key, F.lit("ip"))
        octets = let(moved, lambda x: F.concat_ws(".", *[y.cast("string") for y in (
            F.floor(x["a"] / 256), x["a"] % 256, F.floor(x["b"] / 256), x["b"] % 256)]))
        return F.when(F.forall(o, lambda p: p.cast("int") <= 255), octets)
    return let(F.split(m, r"\."), run)


def _date(m: Column, key: str) -> Column:
    """A date moved among the dates that its format can write.  Slash dates that
    read as month first are moved among those; the others, whose first number is
    13 or more, read as day first and stay among days from 13 on."""
    first = F.lit("1900-01-01").cast("date")

    def moved(day, least_day):
        def once(x):
            return let(feistel(F.floor(x / _DAY_RIGHT), x % _DAY_RIGHT, F.lit(_DAY_LEFT), F.lit(_DAY_RIGHT), key, F.lit("date")),
                       lambda f: (f["a"] * _DAY_RIGHT + f["b"]).cast("int"))

        def fits(x):
            return (x < _DAYS) & (F.dayofmonth(F.date_add(first, x)) >= least_day)
        # Cycle walking: step again from places beyond the last day or of other days
        # (at worst two in five, so 100 steps leave out one date in 10^39).
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(100)), once(day), lambda acc, _: F.when(fits(acc), acc).otherwise(once(acc)))
        return let(walked, lambda w: F.when(fits(w), F.date_add(first, w)))

    out = None
    for shape, form, least_day in ((r"^[0-9]{4}-", "yyyy-MM-dd", 1), (r"^[0-9]{2}\.", "dd.MM.yyyy", 1),
                                   (r"^[0-9]{2}/", "MM/dd/yyyy", 1), (r"^[0-9]{2}/", "dd/MM/yyyy", 13)):
        day = F.datediff(F.to_date(F.try_to_timestamp(m, F.lit(form))), first)
        new = let(day, lambda d: F.when(d.between(0, _DAYS - 1), F.date_format(moved(d, least_day), form)))
        new = F.when(m.rlike(shape), new)
        out = new if out is None else F.coalesce(out, new)
    return out


def _phone(m: Column, key: str) -> Column:
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])[ .-]?", 0)
    def run(c):
        rest = F.substr(m, F.length(c) + 1)
        return F.concat(c, _fill(rest, digits(F.regexp_replace(rest, "[^0-9]", ""), key, "phone")))
    return let(code, run)


def _card(m: Column, key: str) -> Column:
    def run(d):
        body = digits(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
        whole = let(body, lambda b: F.concat(b, F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string")))
        return F.when(luhn_sum(d) % 10 == 0, _fill(m, whole))
    return let(F.regexp_replace(m, "[ -]", ""), run)


def _pseudonym(m: Column, key: str) -> Column:
    """Struct (kind, new); both null if the candidate fails its check."""
    card, phone = rf"^(?:{CARD})$", rf"^(?:{PHONE})$"
    date = r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})$"
    kind = (F.when(m.contains("@"), "email").when(m.rlike(date), "date").when(m.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), "ip")
            .when(m.rlike(phone), "phone").when(m.rlike(card), "card"))

    def run(k):
        new = (F.when(k == "email", _email(m, key)).when(k == "date", _date(m, key)).when(k == "ip", _ip(m, key))
               .when(k == "phone", _phone(m, key)).when(k == "card", _card(m, key)))
        return let(new, lambda n: F.struct(F.when(n.isNotNull(), k).alias("kind"), n.alias("new")))
    return let(kind, run)


def pseudonymise(docs: DataFrame, *, key: str, text: str = "text", out: str = "text", found: str = "pii") -> DataFrame:
    """``docs`` with ``out`` holding the pseudonymised text and ``found`` an
    array of structs (kind, new), one for each replaced value in order."""
    value = F.col(f"`{text}`")
    empty = F.array().cast("array<struct<kind:string,new:string>>")
    parts = F.struct(F.split(value, PATTERN, -1).alias("pieces"), F.regexp_extract_all(value, F.lit(PATTERN), F.lit(0)).alias("found"))

    def build(s):
        def join(new):
            whole = F.array_join(F.transform(s["pieces"], lambda p, i: F.concat(
                p, F.coalesce(F.get(new, i)["new"], F.get(s["found"], i), F.lit("")))), "")
            return F.struct(whole.alias("text"), F.filter(new, lambda x: x["kind"].isNotNull()).alias("found"))
        return let(F.transform(s["found"], lambda m: _pseudonym(m, key)), join)

    both = F.when(value.rlike(HINT), let(parts, build)).otherwise(F.struct(value.alias("text"), empty.alias("found")))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (out, found)]
    return docs.select(*kept, both.alias("_pii")).select(*kept, F.col("_pii.text").alias(out), F.col("_pii.found").alias(found))
