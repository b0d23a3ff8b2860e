"""Personal data replaced by format-preserving pseudonyms, in DataFrame functions only.

Numbers and dates that prove valid are numbered within their format, the number is permuted by a
keyed Feistel network over two mixed-radix halves, and the result is written in the same format.
So a value always gets the same pseudonym under one key, different values get different ones,
and pseudonyms are valid themselves:

* payment cards: 13 to 19 digits that pass the Luhn check; the first digit stays, the check
  digit is computed anew. In a run of digit groups every stretch of whole groups is tried. Of
  overlapping ones those of an issuer's form and groups stay, then the first, then 16 digits, then the longest;
  groups that only another one holds get other digits;
* dates (yyyy-MM-dd, dd/MM/yyyy, dd.MM.yyyy) of the 400 years from 1800-01-01, 146097 days;
  MM/dd/yyyy where dd/MM/yyyy is no date, among the 88497 days after the 12th of their month;
* IPv4 addresses; social security numbers with valid area, group and serial numbers;
* phone numbers: North American ones permute area, exchange and line within what is allowed,
  others all digits after the first two.

An e-mail address keeps its domain, of at most 127 labels as names have; its local part is a keyed
digest of 96 bits. No pattern repeats a group without a bound unless it never steps back, so the
depth of a match does not grow with the text.

Defined cases: a null text is empty; numbers that fail their check stay; equal values get equal
pseudonyms in all rows; very long texts are replaced whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10
EDGE, END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,125}\.[A-Za-z]{2,}",
    "date": EDGE + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})" + END,
    "ip": r"(?<![0-9A-Za-z.])" + OCTET + r"(?:\." + OCTET + r"){3}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": EDGE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + END,
    "phone": r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}" + END
    + r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}" + END,
}
# a run of at least 13 digits in groups, up to where a value of another kind begins; an address whose
# end reads as a phone number with what follows does not count as such
_PHONE_TAIL = r"(?![0-9]{1,3}\.[0-9]{1,3}\.[0-9]{3}\.[0-9]{3}[ -][0-9]{4}" + END + ")"
PATTERNS["card"] = EDGE + r"(?=[0-9](?:[ -]?[0-9]){12})[0-9]++" + END + r"(?:[ -](?!" + "|".join(_PHONE_TAIL * (kind == "ip") + p for kind, p in PATTERNS.items()) + r")[0-9]++" + END + r")*+"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Numbers of an issuer's length and first digits.
ISSUED = r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|5[0-9]{15}|2[2-7][0-9]{14}|3[47][0-9]{13}|3[0689][0-9]{12}|35[0-9]{14}|6[0-9]{15,18})$"
#: How issuers group them.
GROUPED = r"^(?:[0-9]+|(?:[0-9]{4} ){3}[0-9]{4}(?: [0-9]{3})?|[0-9]{4} [0-9]{6} [0-9]{4,5}|[0-9]{6} [0-9]{13})$"
#: Groups of a digit run that are gone through at a time; sets the speed only.
BLOCK = 1000
STRETCHES = "array<array<struct<issued:boolean,usual:boolean,size:int>>>"
FIRST_DAY, DAYS = "1800-01-01", (189, 773)  # 146097 days of the Gregorian cycle
LATE_DAYS = (9, 9833)  # 88497 of them are after the 12th of their month


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _long(text: Column) -> Column:
    return text.cast("bigint")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _mix(key: str, kind: str, turn: Column, half: Column, size: Column) -> Column:
    """A keyed number below ``size`` from one half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), size.cast("string"), turn.cast("string"), half.cast("string")), 256)
    return F.pmod(_long(F.conv(F.substring(digest, 1, 15), 16, 10)), size)


def permuted(number: Column, first: Column, second: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the numbers below ``first * second``, by a Feistel network whose
    halves count ``first`` and ``second`` values."""

    def turn(state: Column, i: Column) -> Column:
        even = F.struct(F.pmod(state["x"] + _mix(key, kind, i, state["y"], first), first).alias("x"), state["y"].alias("y"))
        odd = F.struct(state["x"].alias("x"), F.pmod(state["y"] + _mix(key, kind, i, state["x"], second), second).alias("y"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    start = F.struct(_whole(number, second).alias("x"), F.pmod(number, second).alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["x"] * second + s["y"])


def _whole(number: Column, by: Column) -> Column:
    """Whole quotient of two longs."""
    return F.call_function("div", number, by)


def _big(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _ten_to(n: Column) -> Column:
    return _long(F.rpad(F.lit("1"), n + 1, F.lit("0")))


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A digit string of the same length (2 to 18)."""

    def use(n: Column) -> Column:
        half = _whole(n, F.lit(2)).cast("int")
        number = permuted(_long(digits), _ten_to(half), _ten_to(n - half), key, kind)
        return F.lpad(number.cast("string"), n, "0")

    return _let(F.length(digits), use)


def _in_format(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order; all else stays."""
    gaps = F.split(value, "[0-9]", -1)
    new = F.regexp_extract_all(digits, F.lit("[0-9]"), F.lit(0))
    return F.array_join(F.zip_with(gaps, new, lambda g, d: F.concat(g, F.coalesce(d, F.lit("")))), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn's sum of a digit string whose last digit counts once."""
    each = F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0))
    weights = F.transform(each, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int") + 1)))
    return F.aggregate(weights, F.lit(0), lambda total, d: total + d)


def _card(digits: Column, key: str) -> Column:
    """The pseudonym of a card number without separators."""
    n = F.length(digits)
    body = _permuted_digits(F.substring(digits, F.lit(2), n - 2), key, "card")

    def closed(front: Column) -> Column:
        check = F.pmod(10 - F.pmod(_luhn_sum(F.concat(front, F.lit("0"))), F.lit(10)), F.lit(10))
        return F.concat(front, check.cast("string"))

    return _let(F.concat(F.substring(digits, 1, 1), body), closed)


def _part(array: Column, at: Column, size: Column) -> Column:
    """Some elements, by their places: ``slice`` goes through the whole array for each call."""
    return F.when(size > 0, F.transform(F.sequence(at + 1, at + F.greatest(size, F.lit(1))), lambda i: F.element_at(array, i)))


def _joined(groups: Column, at: Column, size: Column) -> Column:
    return F.coalesce(F.array_join(_part(groups, at, size), ""), F.lit(""))


def _card_stretches(groups: Column) -> Column:
    """Per group, the stretches of whole groups from it on that are card numbers: how many groups,
    and whether in an issuer's form; the preferred one first."""

    def of(ahead: Column) -> Column:
        sizes = F.sequence(F.lit(1), F.size(ahead))
        tried = F.transform(sizes, lambda k: F.struct(k.alias("size"), F.array_join(F.slice(ahead, F.lit(1), k), "").alias("digits")))
        valid = F.filter(tried, lambda t: F.length(t["digits"]).between(13, 19) & (F.pmod(_luhn_sum(t["digits"]), F.lit(10)) == 0))
        ranked = lambda t: F.struct((F.regexp_like(t["digits"], F.lit(ISSUED)) & F.regexp_like(F.array_join(F.slice(ahead, F.lit(1), t["size"]), " "), F.lit(GROUPED))).alias("issued"), (F.length(t["digits"]) == 16).alias("usual"), t["size"].alias("size"))
        return F.sort_array(F.transform(valid, ranked), asc=False)

    return F.transform(groups, lambda _, i: _let(_part(groups, i, F.least(F.lit(19), F.size(groups) - i)), of))


def _card_pieces(found: Column) -> Column:
    """Pieces of a run, in order: the chosen stretches, and groups that only others hold."""

    def step(state: Column, i: Column) -> Column:
        here = F.element_at(found, i + 1)
        later = lambda t: F.exists(F.coalesce(_part(found, i + 1, t["size"] - 1), F.array().cast(STRETCHES)), lambda others: F.exists(others, lambda o: o["issued"]))
        allowed = F.filter(here, lambda t: t["issued"] | ((i >= state["issued"]) & ~later(t)))

        def after(allowed: Column) -> Column:
            free = i >= state["until"]
            card = F.struct(i.alias("at"), F.try_element_at(allowed, F.lit(1))["size"].alias("size"), F.lit(True).alias("card"))
            rest = F.struct(i.alias("at"), F.lit(1).alias("size"), F.lit(False).alias("card"))
            taken = free & (F.size(allowed) > 0)
            pieces = F.when(taken, F.concat(state["pieces"], F.array(card))).when(free & (i < state["reach"]), F.concat(state["pieces"], F.array(rest))).otherwise(state["pieces"])
            furthest = lambda these, old: F.greatest(old, i + F.coalesce(F.array_max(F.transform(these, lambda t: t["size"])), F.lit(0)))
            return F.struct(
                pieces.alias("pieces"),
                F.when(taken, i + card["size"]).otherwise(state["until"]).alias("until"),
                furthest(allowed, state["reach"]).alias("reach"),
                furthest(F.filter(here, lambda t: t["issued"]), state["issued"]).alias("issued"),
            )

        return F.when(F.size(here) == 0, F.when((i >= state["until"]) & (i < state["reach"]), after(allowed=here)).otherwise(state)).otherwise(_let(allowed, after))

    none = F.array().cast("array<struct<at:int,size:int,card:boolean>>")
    places = ("until", "reach", "issued")

    def block(state: Column, b: Column) -> Column:
        """The pieces that start in some groups, added to the state at once: an array grows by a copy."""
        last = F.least(F.size(found), (b + 1) * BLOCK) - 1
        begun = F.struct(none.alias("pieces"), *[state[name].alias(name) for name in places])
        done = F.aggregate(F.sequence(b * BLOCK, last), begun, step)
        return _let(done, lambda d: F.struct(F.concat(state["pieces"], d["pieces"]).alias("pieces"), *[d[name].alias(name) for name in places]))

    start = F.struct(none.alias("pieces"), *[F.lit(0).alias(name) for name in places])
    return F.aggregate(F.sequence(F.lit(0), ((F.size(found) - 1) / BLOCK).cast("int")), start, block, lambda s: s["pieces"])


def _cards(value: Column, key: str) -> Column:
    """A run of digit groups with its card numbers replaced, and how many changed."""

    def written(groups: Column, pieces: Column) -> Column:
        end = lambda p: p["at"] + p["size"]

        def piece(p: Column, i: Column) -> Column:
            before = F.when(i == 0, F.lit(0)).otherwise(end(F.try_element_at(pieces, i)))
            old = _joined(groups, p["at"], p["size"])
            new = F.when(p["card"], _card(old, key)).otherwise(_permuted_digits(old, key, "rest"))
            kept = _joined(groups, before, p["at"] - before)
            return _let(new, lambda new: F.struct(F.concat(kept, new).alias("digits"), (p["card"] & (new != old)).cast("int").alias("n")))

        tail = end(F.element_at(pieces, -1))

        def whole(parts: Column) -> Column:
            digits = F.concat(F.array_join(F.transform(parts, lambda p: p["digits"]), ""), _joined(groups, tail, F.size(groups) - tail))
            return F.struct(_in_format(value, digits).alias("new"), F.aggregate(parts, F.lit(0), lambda total, p: total + p["n"]).alias("n"))

        return _let(F.transform(pieces, piece), whole)

    def use(groups: Column) -> Column:
        unchanged = F.struct(value.alias("new"), F.lit(0).alias("n"))
        return _let(_let(_card_stretches(groups), _card_pieces), lambda pieces: F.when(F.size(pieces) > 0, written(groups, pieces)).otherwise(unchanged))

    return _let(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)), use)


def _late_day(number: Column) -> Column:
    """The day of a number among the days after the 12th of their month."""
    first = F.lit(FIRST_DAY).cast("date")
    before = lambda month: F.datediff(F.add_months(first, month), first) - 12 * month
    guess = _whole(number * 4800, _big(LATE_DAYS[0] * LATE_DAYS[1])).cast("int")
    month = F.array_max(F.filter(F.sequence(F.greatest(guess - 3, F.lit(0)), guess + 3), lambda m: before(m) <= number))
    return _let(month, lambda m: F.date_add(F.add_months(first, m), (number - before(m) + 12).cast("int")))


def _date(value: Column, key: str) -> Column:
    form = F.when(F.substring(value, 5, 1) == "-", "yyyy-MM-dd").when(F.substring(value, 3, 1) == "/", "dd/MM/yyyy").otherwise("dd.MM.yyyy")
    one, two, year = F.substring(value, 1, 2), F.substring(value, 4, 2), F.substring(value, 7, 4)
    parts = F.when(F.substring(value, 5, 1) == "-", value).otherwise(F.concat_ws("-", year, two, one))
    day = parts.try_cast("date")
    other = F.when(form == "dd/MM/yyyy", F.concat_ws("-", year, one, two)).try_cast("date")  # MM/dd/yyyy
    since = lambda day: F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("bigint")

    def use(number: Column) -> Column:
        first, second = map(_big, DAYS)
        moved = F.date_add(F.lit(FIRST_DAY).cast("date"), permuted(number, first, second, key, "date").cast("int"))
        written = F.when(form == "yyyy-MM-dd", F.date_format(moved, "yyyy-MM-dd")).when(form == "dd/MM/yyyy", F.date_format(moved, "dd/MM/yyyy")).otherwise(F.date_format(moved, "dd.MM.yyyy"))
        return F.when(number.between(0, DAYS[0] * DAYS[1] - 1), written).otherwise(value)

    def late(number: Column) -> Column:
        first, second = map(_big, LATE_DAYS)
        moved = _let(permuted(number, first, second, key, "late"), _late_day)
        return F.when(number.between(0, LATE_DAYS[0] * LATE_DAYS[1] - 1), F.date_format(moved, "MM/dd/yyyy")).otherwise(value)

    months = (F.year(other) - 1800) * 12 + F.month(other)
    return F.when(day.isNull() & other.isNotNull(), _let(since(other) - 12 * months, late)).otherwise(_let(since(day), use))


def _ip(value: Column, key: str) -> Column:
    parts = F.split(value, "\\.")
    number = F.aggregate(parts, _big(0), lambda total, p: total * 256 + _long(p))
    half = _big(1 << 16)
    octet = lambda n, shift: F.shiftright(n, shift).bitwiseAND(F.lit(255)).cast("string")
    return _let(permuted(number, half, half, key, "ip"), lambda n: F.concat_ws(".", *[octet(n, s) for s in (24, 16, 8, 0)]))


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = _long(F.substring(value, 1, 3)), _long(F.substring(value, 5, 2)), _long(F.substring(value, 8, 4))
    # areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    first, second = _big(898), _big(99 * 9999)

    def use(n: Column) -> Column:
        new = _whole(n, second) + 1
        new = F.when(new >= 666, new + 1).otherwise(new)
        rest = F.pmod(n, second)
        pad = lambda c, size: F.lpad(c.cast("string"), size, "0")
        return F.concat_ws("-", pad(new, 3), pad(_whole(rest, _big(9999)) + 1, 2), pad(F.pmod(rest, _big(9999)) + 1, 4))

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, _let(permuted(place * second + (group - 1) * 9999 + serial - 1, first, second, key, "ssn"), use)).otherwise(value)


def _phone(value: Column, key: str) -> Column:
    def use(digits: Column) -> Column:
        n = F.length(digits)
        line = F.substring(digits, n - 9, F.lit(10))
        area, exchange, last = _long(F.substring(line, 1, 3)), _long(F.substring(line, 4, 3)), _long(F.substring(line, 7, 4))
        american = (n == 10) & ~value.startswith("+") | (n == 11) & (F.substring(digits, 1, 1) == "1")
        first, second = _big(800), _big(800 * 10000)

        def written(number: Column) -> Column:
            rest = F.pmod(number, second)
            new = F.concat((_whole(number, second) + 200).cast("string"), (_whole(rest, _big(10000)) + 200).cast("string"), F.lpad(F.pmod(rest, _big(10000)).cast("string"), 4, "0"))
            return _in_format(value, F.concat(F.substring(digits, F.lit(1), n - 10), new))

        within = _let(permuted((area - 200) * second + (exchange - 200) * 10000 + last, first, second, key, "phone"), written)
        other = _in_format(value, F.concat(F.substring(digits, 1, 2), _permuted_digits(F.substring(digits, F.lit(3), n - 2), key, "phone")))
        return F.when(american & (area >= 200) & (exchange >= 200), within).when(n.between(8, 20), other).otherwise(value)

    return _let(_digits(value), use)


def _email(value: Column, key: str) -> Column:
    local = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)), 256), 1, 24)
    return F.concat(F.lit("u"), local, F.lit("@"), F.substring_index(value, "@", -1))


WRITE = {"email": _email, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone}


def _kind(value: Column) -> Column:
    kind = F.lit("card")
    for name in reversed(list(PATTERNS)[:-1]):
        kind = F.when(F.regexp_like(value, F.lit(f"^(?:{PATTERNS[name]})$")), name).otherwise(kind)
    return kind


def pseudonymised(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` with pseudonyms, and how many values of each kind were replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("values"))

    def replaced(value: Column, kind: Column) -> Column:
        new = _cards(value, key)
        for name, write in WRITE.items():
            one = lambda new: F.struct(new.alias("new"), (new != value).cast("int").alias("n"))
            new = F.when(kind == name, _let(write(value, key), one)).otherwise(new)
        return new

    def both(value: Column) -> Column:
        return _let(_kind(value), lambda kind: _let(replaced(value, kind), lambda r: F.struct(kind.alias("kind"), r["new"].alias("new"), r["n"].alias("n"))))

    rows = rows.withColumn("found", F.transform("values", both))
    gaps = F.split("text", ANY, -1)
    whole = F.array_join(F.zip_with(gaps, F.col("found"), lambda g, f: F.concat(g, F.coalesce(f["new"], F.lit("")))), "")
    count = lambda name: F.aggregate(F.filter("found", lambda f: f["kind"] == name), F.lit(0), lambda total, f: total + f["n"]).cast("bigint").alias(f"n_{name}")
    return rows.select("doc_id", F.when(F.size("values") > 0, whole).otherwise(F.col("text")).alias("text"), *map(count, PATTERNS))
