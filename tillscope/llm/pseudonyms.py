"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets.

A value is split in two halves. In each round of a Feistel network the characters of one half are
shifted, each within its own kind (digit, small letter, capital letter, the letters of one script, or
hexadecimal digit), by a keyed hash of the other half. Whoever has the key can undo it; a value always gets the
same pseudonym, different values of one format get different ones, and punctuation stays. Of cards,
accounts and phones the bare digits and letters are permuted and then take the places they had
among the separators, so all spellings of a number are linked.
Everything is built from Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# How the values look. Alternatives are tried in this order.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}@"
             r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9_])(?:A[KS]IA[A-Z0-9]{16}|[srp]k_(?:live|test)_[A-Za-z0-9]{16,99}"
           r"|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,99})(?![A-Za-z0-9_])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
            r"|(?<![A-Za-z0-9])[a-z]{2}[0-9]{2}(?:[a-z0-9]{11,30}|(?: [a-z]{4})?(?: [0-9]{4}){2,7}(?: [0-9]{1,3})?)(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}"
          r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9]|[./-][0-9])",
    "national": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
             r"|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
             r"|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    "number": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
# What a text with any of these has, at least: most texts have not and are not searched.
HINT = "[0-9@]|A[KS]IA|_(?:live|test)_|gh[pousr]_|xox[abprs]-"
# The part of a key that says whose and what it is.
KEY_KIND = "^(?:A[KS]IA|.._(?:live|test)_|gh._|xox.-)"

# First and last letters of one kind, beyond ASCII (Unicode).
LETTERS = (
    (0x00DF, 0x00F6), (0x00F8, 0x00FF), (0x00C0, 0x00D6), (0x00D8, 0x00DE), (0x0100, 0x017F),
    (0x0391, 0x03A1), (0x03B1, 0x03C9), (0x0410, 0x042F), (0x0430, 0x044F), (0x05D0, 0x05EA),
    (0x0620, 0x063A), (0x0904, 0x0939), (0x0E01, 0x0E2E), (0x3041, 0x3096), (0x30A1, 0x30FA),
    (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),
)
# Other letters and digits move among the sixteen code points of their row.
ROW = 16

ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

# Calling codes of countries (ITU E.164); those not listed here have three digits.
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
DAYS = 73_049
# Numbers of days are permuted among five-digit numbers, again until one is a day.
WALKS = 40


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _shifted(half: Column, stream: Column, hexadecimal: bool) -> Column:
    """Each character moved within its kind by a byte of the hexadecimal ``stream``."""

    def move(bytes_: Column, c: Column, i: Column) -> Column:
        by = F.conv(F.substring(bytes_, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        if hexadecimal:
            value = F.conv(c, 16, 10).cast("int")
            return F.lower(F.conv(((value + by) % 16).cast("string"), 10, 16))
        return _once(F.struct(F.ascii(c).alias("code"), by.alias("by")), lambda x: _moved(c, x["code"], x["by"]))

    return _once(stream, lambda bytes_: F.array_join(
        F.transform(_characters(half), lambda c, i: move(bytes_, c, i)), ""
    ))


def _moved(c: Column, code: Column, by: Column) -> Column:
    kinds = F.when(code.between(48, 57), F.char(48 + (code - 48 + by) % 10))
    kinds = kinds.when(code.between(97, 122), F.char(97 + (code - 97 + by) % 26))
    kinds = kinds.when(code.between(65, 90), F.char(65 + (code - 65 + by) % 26))
    return kinds.when(code < 128, c).otherwise(_beyond_ascii(c, code, by))


def _beyond_ascii(c: Column, code: Column, by: Column) -> Column:
    """A letter or digit moved within its kind; marks and signs stay."""
    row = code - code % ROW
    moved = F.when(~c.rlike(r"[\p{L}\p{N}]"), code)
    for first, last in LETTERS:
        moved = moved.when(code.between(first, last), first + (code - first + by) % (last - first + 1))
    moved = moved.otherwise(row + (code - row + by) % ROW)
    return F.decode(F.unhex(F.lpad(F.hex(moved), 8, "0")), "UTF-32")


def permuted(value: Column, key: str, kind: str, hexadecimal: bool = False) -> Column:
    """``value`` keyed-permuted among the strings of its format."""
    half = (F.length(value) / 2).cast("int")
    start = F.struct(
        F.substring(value, F.lit(1), half).alias("a"),
        F.substring(value, half + 1, F.length(value)).alias("b"),
    )

    def turn(state: Column, number: Column) -> Column:
        stream = F.sha2(F.concat_ws(
            "\x1f", F.lit(key), F.lit(kind), number.cast("string"),
            F.length(state["a"]).cast("string"), state["b"],
        ), 512)
        return F.struct(state["b"].alias("a"), _shifted(state["a"], stream, hexadecimal).alias("b"))

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["a"], s["b"])
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed a single time however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _laid_out(value: Column, bare: Column) -> Column:
    """``value`` with the characters of ``bare`` in the places of its letters and digits."""
    def place(state: Column, c: Column) -> Column:
        own = c.rlike("[A-Za-z0-9]")
        fresh = F.when(own, F.substring(bare, state["used"] + 1, F.lit(1))).otherwise(c)
        return F.struct(
            F.concat(state["text"], fresh).alias("text"), (state["used"] + own.cast("int")).alias("used")
        )

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"))
    return F.aggregate(_characters(value), start, place, lambda s: s["text"])


def _luhn(digits: Column) -> Column:
    """Check digit of a number without it (Luhn)."""
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    total = F.aggregate(F.transform(_characters(F.reverse(digits)), worth), F.lit(0), lambda s, d: s + d)
    return (10 - total % 10) % 10


def _number(value: Column, key: str) -> Column:
    """All digits but the last are permuted; the last one keeps its distance from the check digit."""
    bare = F.regexp_replace(value, "[^0-9]", "")
    body = F.substring(bare, F.lit(1), F.length(bare) - 1)
    off = F.right(bare, F.lit(1)).cast("int") - _luhn(body)

    def whole(fresh: Column) -> Column:
        return F.concat(fresh, F.pmod(_luhn(fresh) + off, F.lit(10)).cast("string"))

    return _once(_once(permuted(body, key, "number"), whole), lambda bare: _laid_out(value, bare))


def _remainder_97(account: Column) -> Column:
    """Remainder of an account number read as ISO 13616 does: from the fifth character, letters as 10 to 35."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def fold(rest: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(_characters(turned), F.lit(0), fold)


def _iban(value: Column, key: str) -> Column:
    """Account part permuted and check digits made anew; an invalid number stays as it is.

    In small letters or capitals, a number has the same pseudonym.
    """
    plain = F.upper(F.regexp_replace(value, " ", ""))
    land = F.substring(plain, 1, 2)

    def whole(fresh: Column) -> Column:
        check = 98 - _remainder_97(F.concat(land, F.lit("00"), fresh))
        return F.concat(land, F.lpad(check.cast("string"), 2, "0"), fresh)

    account = permuted(F.substring(plain, F.lit(5), F.length(plain)), key, "iban")
    fresh = _once(_once(account, whole), lambda bare: _laid_out(value, bare))
    return F.when(_remainder_97(plain) == 1, F.when(value.rlike("^[a-z]"), F.lower(fresh)).otherwise(fresh)).otherwise(value)


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: F.lpad(F.conv(o, 10, 16), 2, "0"))
    fresh = permuted(F.lower(F.array_join(octets, "")), key, "ip", hexadecimal=True)
    return F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substring(fresh, i * 2 + 1, F.lit(2)), 16, 10)
    ), ".")


def _date(value: Column, key: str) -> Column:
    """A day of 1900 to 2099 becomes another one in the same format; other strings stay."""
    def walked(day: Column) -> Column:
        def step(x: Column) -> Column:
            return permuted(F.lpad(x.cast("string"), 5, "0"), key, "date").cast("int")

        again = F.aggregate(
            F.sequence(F.lit(1), F.lit(WALKS)), step(day),
            lambda x, _: F.when(x >= DAYS, step(x)).otherwise(x),
        )
        return F.date_add(F.lit(FIRST_DAY).cast("date"), again)

    mark = F.substring(value, 3, 1)
    text = F.when(value.rlike("^[0-9]{4}-"), value)
    for first, second in ((4, 1), (1, 4)):
        read = F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, first, 2), F.substring(value, second, 2))
        text = text.when(~value.rlike("^[0-9]{4}-") & F.try_to_date(read, "yyyy-MM-dd").isNotNull(), read)
    day = F.try_to_date(text, "yyyy-MM-dd")
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    fresh = walked(number)
    swapped = F.try_to_date(F.concat_ws(
        "-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2)
    ), "yyyy-MM-dd").isNull()
    written = F.when(value.rlike("^[0-9]{4}-"), F.date_format(fresh, "yyyy-MM-dd"))
    written = written.when(swapped, F.concat(
        F.date_format(fresh, "MM"), mark, F.date_format(fresh, "dd"), mark, F.date_format(fresh, "yyyy")
    )).otherwise(F.concat(
        F.date_format(fresh, "dd"), mark, F.date_format(fresh, "MM"), mark, F.date_format(fresh, "yyyy")
    ))
    return F.when(number.between(0, DAYS - 1), written).otherwise(value)


def _phone(value: Column, key: str) -> Column:
    """Digits after the country's code, which the digits tell whatever stands between them."""
    bare = F.regexp_replace(value, "[^0-9+]", "")
    land = F.regexp_extract(bare, COUNTRY, 0)
    fresh = permuted(F.substring(bare, F.length(land) + 1, F.length(bare)), key, "phone")
    digits = F.concat(F.regexp_replace(land, r"\+", ""), fresh)
    return _once(digits, lambda bare: _laid_out(value, bare))


def _email(value: Column, key: str) -> Column:
    """The part before the @; the domain belongs to no one person."""
    return F.concat(
        permuted(F.substring_index(value, "@", 1), key, "email"), F.lit("@"), F.substring_index(value, "@", -1)
    )


def _secret(value: Column, key: str) -> Column:
    """Written in capitals or not, a secret has the same pseudonym."""
    fresh = permuted(F.lower(value), key, "secret", hexadecimal=True)
    return F.when(value.rlike("[A-F]"), F.upper(fresh)).otherwise(fresh)


def _key(value: Column, key: str) -> Column:
    """A key to a service: what tells its kind stays."""
    kind = F.regexp_extract(value, KEY_KIND, 0)
    return F.concat(kind, permuted(F.substring(value, F.length(kind) + 1, F.length(value)), key, "key"))


def pseudonym(value: Column, key: str) -> Column:
    """Pseudonym of one found value."""
    whole = {kind: value.rlike(f"^(?:{p})$") for kind, p in PATTERNS.items()}
    return (
        F.when(whole["email"], _email(value, key))
        .when(whole["key"], _key(value, key))
        .when(whole["iban"], _iban(value, key))
        .when(whole["secret"], _secret(value, key))
        .when(whole["ip"], _ip(value, key))
        .when(whole["date"], _date(value, key))
        .when(whole["national"], permuted(value, key, "national"))
        .when(whole["phone"], _phone(value, key))
        .otherwise(_number(value, key))
    )


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id``, ``text`` with pseudonyms in place of personal values, and ``n_values`` replaced.

    Found are e-mail addresses, IBANs, hexadecimal secrets, keys to services, IPv4 addresses, dates of
    1900 to 2099, national and phone numbers and numbers of 13 to 19 digits. Numbers with check digits
    stay valid, or as wrong as they were; strings that only look like an IBAN or a date stay and do not
    count. A value has one pseudonym in all documents, and cards, IBANs and phones have it however they are
    spaced. Null text stays null with 0 values; rows repeated are treated each; an empty table gives
    an empty result. Other columns are not read.
    """
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    looked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(text.rlike(HINT), found).alias("_found"),
    ).withColumn("_fresh", F.transform("_found", lambda v: pseudonym(v, key)))
    joined = F.array_join(F.zip_with(
        F.split(text, ANY, -1), "_fresh", lambda part, value: F.concat(part, F.coalesce(value, F.lit("")))
    ), "")
    some = F.coalesce(F.size("_found"), F.lit(0)) > 0
    changed = F.zip_with("_found", "_fresh", lambda value, fresh: (value != fresh).cast("long"))
    return looked.select(
        "doc_id", F.when(some, joined).otherwise(text).alias("text"),
        F.when(some, F.aggregate(changed, F.lit(0).cast("long"), lambda n, one: n + one))
        .otherwise(F.lit(0).cast("long")).alias("n_values"),
    )
