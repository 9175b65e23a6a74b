"""Format-preserving pseudonyms for personal numbers and dates.

Each value that passes its check (Luhn digit, number plan, calendar, octets) is put through a keyed Feistel network
whose domain is exactly the set of valid values of that format: a permutation, so equal values get equal pseudonyms in
every document, different values different ones, and a pseudonym passes the same check.  Halves are counted in mixed
radix (a 400-year calendar cycle is 189 * 773 days), so no value falls outside and nothing has to be retried.  The
round function is SHA-256 over key, format, round and half.  The names before an @ are permuted letter by letter
within their classes by the same kind of network.

Everything is an expression over the row: texts do not move, and those without a digit or an @ are passed through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

#: Values are found by these patterns, tried in this order at each place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "date": r"(?<![0-9./-])[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}(?![0-9]|[./-][0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
#: The same as one pattern; the back reference counts groups.
ANY = "|".join(PATTERNS.values())
#: Years 1800 to 2199, one full cycle of the calendar.
FIRST_DAY, CYCLE = "1800-01-01", (189, 773)


def _digest(key: Column, tweak: Column, i: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, tweak, i.cast("string"), half.cast("string")), 256)


def feistel(value: Column, a: Column, b: Column, key: Column, tweak: Column) -> Column:
    """Permutes 0 .. a*b - 1: the halves are value div b and value mod b, and each round adds to one of them."""
    def draw(i: Column, half: Column, radix: Column) -> Column:
        return F.conv(F.substr(_digest(key, tweak, i, half), F.lit(1), F.lit(15)), 16, 10).cast("long") % radix

    start = F.struct(F.call_function("div", value, b).alias("l"), (value % b).alias("r"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start,
        lambda acc, i: F.when(i % 2 == 1, F.struct(((acc["l"] + draw(i, acc["r"], a)) % a).alias("l"), acc["r"].alias("r")))
        .otherwise(F.struct(acc["l"].alias("l"), ((acc["r"] + draw(i, acc["l"], b)) % b).alias("r"))),
        lambda acc: acc["l"] * b + acc["r"],
    )


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, F.lit("[^0-9]"), F.lit(""))


def refill(value: Column, digits: Column) -> Column:
    """The value with its digits replaced in order, separators as they were."""
    places = F.sequence(F.lit(1), F.length(value))
    def at(i: Column) -> Column:
        return F.substr(value, i, F.lit(1))
    return F.when(F.length(value) == F.length(digits), digits).otherwise(F.array_join(F.transform(
        places, lambda i: F.when(at(i).between("0", "9"), F.substr(digits, F.length(digits_of(F.substr(value, F.lit(1), i))), F.lit(1))).otherwise(at(i))), ""))


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a number without its check digit."""
    n = F.length(digits)
    def term(i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    return F.aggregate(F.transform(F.sequence(F.lit(1), n), term), F.lit(0), lambda acc, x: acc + x)


def check_digit(digits: Column) -> Column:
    return ((10 - luhn_sum(digits) % 10) % 10).cast("string")


def card(value: Column, key: Column) -> Column:
    """First digit and length stay, the digits between are permuted, the last makes the Luhn sum right."""
    d = digits_of(value)
    n = F.length(d)
    body, low = n - 2, F.floor((n - 2) / 2).cast("int")
    a, b = F.pow(F.lit(10.0), (body - low)).cast("long"), F.pow(F.lit(10.0), low).cast("long")
    middle = feistel(F.substr(d, F.lit(2), body).cast("long"), a, b, key, F.concat(F.lit("card"), n.cast("string"), F.substr(d, F.lit(1), F.lit(1))))
    front = F.concat(F.substr(d, F.lit(1), F.lit(1)), F.lpad(middle.cast("string"), body, F.lit("0")))
    valid = check_digit(F.substr(d, F.lit(1), n - 1)) == F.substr(d, n, F.lit(1))
    return F.when(valid, refill(value, F.concat(front, check_digit(front))))


def phone(value: Column, key: Column) -> Column:
    """Area and exchange start with 2 to 9; a country code 1 stays."""
    d = digits_of(value)
    own = F.substr(d, F.length(d) - 9, F.lit(10))
    area, exchange, line = (F.substr(own, F.lit(s), F.lit(n)).cast("long") for s, n in ((1, 3), (4, 3), (7, 4)))
    new = feistel(((area - 200) * 800 + exchange - 200) * 10000 + line, F.lit(80000), F.lit(80000), key, F.lit("phone"))
    area_exchange = (new - new % 10000) / 10000
    pair = area_exchange.cast("long")
    digits = F.concat(F.substr(d, F.lit(1), F.length(d) - 10), (((pair - pair % 800) / 800).cast("long") + 200).cast("string"),
                      (pair % 800 + 200).cast("string"), padded(new % 10000, 4))
    return refill(value, digits)


def ssn(value: Column, key: Column) -> Column:
    """Area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999."""
    d = digits_of(value)
    area, group, serial = (F.substr(d, F.lit(s), F.lit(n)).cast("long") for s, n in ((1, 3), (4, 2), (6, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = F.when(area > 666, area - 2).otherwise(area - 1)
    new = feistel((rank * 99 + group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, F.lit("ssn"))
    upper = ((new - new % 9999) / 9999).cast("long")
    r = ((upper - upper % 99) / 99).cast("long")
    return F.when(valid, refill(value, F.concat(padded(F.when(r >= 665, r + 2).otherwise(r + 1), 3), padded(upper % 99 + 1, 2), padded(new % 9999 + 1, 4))))


def ip(value: Column, key: Column) -> Column:
    octets = F.transform(F.split(value, "[.]"), lambda o: o.cast("long"))
    valid = ~F.exists(octets, lambda o: o > 255)
    new = feistel(F.aggregate(octets, F.lit(0).cast("long"), lambda acc, o: acc * 256 + o), F.lit(65536), F.lit(65536), key, F.lit("ip"))
    return F.when(valid, F.concat_ws(".", *[(F.shiftright(new, s) % 256).cast("string") for s in (24, 16, 8, 0)]))


def date(value: Column, key: Column) -> Column:
    day = F.try_to_timestamp(F.concat_ws("-", F.substr(value, F.lit(1), F.lit(4)), F.substr(value, F.lit(6), F.lit(2)), F.substr(value, F.lit(9), F.lit(2))), F.lit("yyyy-MM-dd")).cast("date")
    since = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    new = feistel(since, F.lit(CYCLE[0]), F.lit(CYCLE[1]), key, F.lit("date"))
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), new.cast("int"))
    return F.when(since.between(0, CYCLE[0] * CYCLE[1] - 1), refill(value, F.date_format(moved, "yyyyMMdd")))


def email(value: Column, key: Column) -> Column:
    """Letters and digits before the @ move within their classes, the domain stays."""
    at = F.instr(value, "@")
    name = F.substr(value, F.lit(1), at - 1)
    cut = F.floor(F.length(name) / 2).cast("int")

    def shifted(half: Column, other: Column, i: Column) -> Column:
        stream = F.concat(_digest(key, F.lit("email"), i, other), _digest(key, F.lit("email+"), i, other))
        def one(j: Column) -> Column:
            c = F.substr(half, j, F.lit(1))
            step = F.conv(F.substr(stream, j * 4 - 3, F.lit(4)), 16, 10).cast("int")
            def turned(first: int, radix: int) -> Column:
                return F.char((F.ascii(c) - first + step) % radix + first)
            return F.when(c.between("0", "9"), turned(48, 10)).when(c.between("a", "z"), turned(97, 26)).when(c.between("A", "Z"), turned(65, 26)).otherwise(c)
        return F.when(F.length(half) == 0, half).otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), one), ""))

    start = F.struct(F.substr(name, F.lit(1), cut).alias("l"), F.substr(name, cut + 1, F.length(name) - cut).alias("r"))
    new = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start,
                      lambda acc, i: F.when(i % 2 == 1, F.struct(shifted(acc["l"], acc["r"], i).alias("l"), acc["r"].alias("r")))
                      .otherwise(F.struct(acc["l"].alias("l"), shifted(acc["r"], acc["l"], i).alias("r"))), lambda acc: F.concat(acc["l"], acc["r"]))
    return F.concat(new, F.substr(value, at, F.length(value) - at + 1))


KINDS: dict[str, Callable[[Column, Column], Column]] = {"email": email, "date": date, "ip": ip, "ssn": ssn, "phone": phone, "card": card}


def pseudonym(value: Column, key: Column) -> Column:
    """Struct (kind, value, pseudonym); the pseudonym is null where the value fails its check."""
    kind = F.when(F.contains(value, F.lit("@")), "email")
    for name in ("date", "ip", "ssn", "phone"):
        kind = kind.when(F.regexp(value, F.lit(f"^(?:{PATTERNS[name]})$")), name)
    kind = kind.otherwise("card")
    chosen = F.when(kind == "email", email(value, key))
    for name in ("date", "ip", "ssn", "phone", "card"):
        chosen = chosen.when(kind == name, KINDS[name](value, key))
    return F.struct(kind.alias("kind"), value.alias("value"), chosen.alias("pseudonym"))


def pseudonymise(documents: DataFrame, key: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``doc_id, text, n_values, kinds, pseudonyms`` for each row: the whole text with its valid values replaced.

    ``n_values`` counts replaced values, ``kinds`` and ``pseudonyms`` list them in order.  A null text stays null and an
    empty one empty, both with no values.  Values that fail their check stay as they are.  Rows are treated one by one:
    repeats get equal results, an empty table gives no rows, other columns are not touched.
    """
    secret = F.lit(key)
    d = documents.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    d = d.withColumn("_found", F.when(F.regexp(F.col("_text"), F.lit("[0-9@]")), F.regexp_extract_all("_text", F.lit(ANY), F.lit(0))))
    d = d.withColumn("_values", F.when(F.size("_found") > 0, F.transform("_found", lambda v: pseudonym(v, secret))))
    pieces = F.zip_with(F.split("_text", ANY, -1), F.col("_values"), lambda gap, v: F.concat(
        gap, F.coalesce(v["pseudonym"], v["value"], F.lit(""))))
    done = F.filter("_values", lambda v: v["pseudonym"].isNotNull())
    none = F.array().cast("array<string>")
    return d.withColumn("_done", done).select(
        F.col("_id").alias(id), F.when(F.col("_values").isNotNull(), F.array_join(pieces, "")).otherwise(F.col("_text")).alias(text),
        F.coalesce(F.when(F.size("_done") >= 0, F.size("_done")), F.lit(0)).cast("long").alias("n_values"),
        F.coalesce(F.transform("_done", lambda v: v["kind"]), none).alias("kinds"),
        F.coalesce(F.transform("_done", lambda v: v["pseudonym"]), none).alias("pseudonyms"))
