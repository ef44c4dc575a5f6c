"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses.

Candidates are found by pattern and validated (Luhn, IBAN mod 97, calendar,
number-plan and octet ranges); what fails validation stays as it is.  A valid
value is written as a vector of small numbers, each below its own radix, and the
vector is permuted by a keyed Feistel network: in turn, one half is shifted by a
keyed hash of the other half, modulo the radices.  Every round can be undone, so
different values get different pseudonyms, equal values (also with other
separators) get equal ones in every document, and the result has the format and
passes the validation of the original.

What is permuted, and what stays:

- card (13 to 19 digits, Luhn): all but the first digit; the check digit is computed anew
- phone: the national number of +1 numbers, with the +1 or without (then area and exchange
  codes must begin with 2-9; these digits keep to 2-9 or 0-1); for other ``+`` numbers the
  digits after the first two
- ssn: area, group and serial within their valid ranges
- ip: four octets; the first stays within 1-223 (other first octets stay)
- date (yyyy-mm-dd, yyyy/mm/dd, d/m/yyyy and d.m.yyyy, 1800 to 2199): the day number, among the
  dates whose day is above 12 or among the others, so a date is linked across formats; the
  format and padding stay.  A slash date that cannot be day-first is read as m/d/yyyy and
  written back month-first, and stays one that cannot be day-first; one that can be either is
  read day-first.  Years of two digits are not read
- iban (the length of its country, mod 97; spaces or hyphens, either case): the account's digits;
  letters stay, check digits are computed anew
- email: letters and digits before the @, per domain, whatever their case, within their own
  alphabet (``ALPHABETS``; letters of other scripts stay); the domain stays

A candidate is looked for at every place of the text.  One that isn't valid hides nothing: a
valid one that begins inside it is still met.  Of valid ones that overlap, the first counts.

Everything is DataFrame expressions; nothing is shuffled.

Defined results: a NULL text stays NULL, an empty one empty, both without
pseudonyms; texts of any length are read whole; repeated rows get equal results;
an empty table gives no rows; other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, id_text

ROUNDS = 8
# Countries of the IBAN registry by the length of their IBANs.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban_pattern() -> str:
    """An alternative per length, so that a following word is never taken in; countries outside the registry have any length."""
    def of(n: int) -> str:
        groups, rest = divmod(n - 4, 4)
        return f"(?:{IBAN_COUNTRIES[n].replace(' ', '|')})[0-9]{{2}}(?:[ -]?[A-Z0-9]{{4}}){{{groups}}}" + (
            f"[ -]?[A-Z0-9]{{{rest}}}" if rest else "")
    known = "|".join(of(n) for n in IBAN_COUNTRIES)
    others = f"(?!{'|'.join(' '.join(IBAN_COUNTRIES.values()).split())})[A-Z]{{2}}[0-9]{{2}}(?:[ -]?[A-Z0-9]{{4}}){{2,7}}(?:[ -]?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Za-z]{{2}}[0-9]{{2}})(?i:{known}|{others})(?![A-Za-z0-9])"


_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": _iban_pattern(),
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ .-][0-9]{4}){3}|[0-9]{4}[ .-][0-9]{6}[ .-][0-9]{5})(?![0-9])",
    "phone": (r"(?<![0-9+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
              r"|(?:1[ .-]?)?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-]?[0-9]{4})(?![0-9])"),
    "world_phone": r"(?<![0-9+])\+[2-9][0-9]{1,2}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9])(?!\.[0-9])",
    "iso_date": r"(?<![0-9/-])[0-9]{4}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}(?![0-9/-])",
    "day_date": r"(?<![0-9./])[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{4}(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
AT = f"(?=({ANY}))"  # the places where a candidate begins
# Runs of letters or digits that an address's local part is permuted within: first code point and number.
ALPHABETS = ((0x30, 10), (0x61, 26), (0xE0, 23), (0xF8, 7), (0x3B1, 17), (0x3C3, 7), (0x430, 32), (0x4E00, 20992))
# 400 Gregorian years have 4800 months: 4800 x 12 days up to the 12th, and 88,497 = 9 x 9833 later ones.
_EPOCH, _MONTHS, _EARLY, _LATE = "1800-01-01", 4800, (240, 240), (9, 9833)
_SSN = (898, 99, 9999)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(values: Column, radices: Column, tweak: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Keyed permutation of an array<bigint> whose element i lies in 0 .. radices[i] - 1."""
    half = F.floor(F.size(values) / 2).cast("int")

    def one_round(v: Column, r: Column) -> Column:
        even = r % 2 == 0
        fixed = F.when(even, F.slice(v, half + 1, F.size(v) - half)).otherwise(F.slice(v, F.lit(1), half))
        digest = F.sha2(F.concat_ws("|", key, tweak, r.cast("string"), F.array_join(F.transform(
            fixed, lambda x: x.cast("string")), ",")), 512)
        return _let(digest, lambda d: F.transform(v, lambda x, i: F.when((i < half) == even, F.pmod(
            x + F.conv(F.substr(d, (i % 16) * 8 + 1, F.lit(8)), 16, 10).cast("bigint"), F.get(radices, i))).otherwise(x)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), values, one_round)


def _chars(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substr(s, i, F.lit(1)))).otherwise(
        F.array().cast("array<string>"))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _bigints(*values) -> Column:
    return F.array(*[(v if isinstance(v, Column) else F.lit(v)).cast("bigint") for v in values])


def _permuted_digits(digits: Column, tweak: Column, key: Column, lead: tuple[int, ...] = ()) -> Column:
    """A digit string permuted among those of its length; at the places ``lead`` digits keep to 2-9 or to 0-1."""

    def low(d: Column, i: Column) -> Column:
        return F.when(i.isin(*lead) & (d >= 2), 2).otherwise(0).cast("bigint") if lead else F.lit(0).cast("bigint")

    def radix(d: Column, i: Column) -> Column:
        return F.when(i.isin(*lead), F.when(d >= 2, 8).otherwise(2)).otherwise(10).cast("bigint") if lead else F.lit(10).cast("bigint")

    def of(d: Column) -> Column:
        new = feistel(F.transform(d, lambda x, i: x - low(x, i)), F.transform(d, radix), tweak, key)
        return F.array_join(F.zip_with(new, F.transform(d, low), lambda x, y: (x + y).cast("string")), "")
    return _let(F.transform(_chars(digits), lambda c: c.cast("bigint")), of)


def _refilled(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced, in order, by ``digits``."""
    return F.array_join(F.transform(_chars(template), lambda c, i: F.when(c.rlike("^[0-9]$"), F.substr(
        digits, F.length(_digits(F.substr(template, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10


def _mod97(s: Column) -> Column:
    """Of a string of digits and capital letters, a letter counting as 10 to 35."""
    return F.aggregate(_chars(s), F.lit(0), lambda r, c: F.when(c.rlike("^[0-9]$"), r * 10 + F.ascii(c) - 48).otherwise(
        r * 100 + F.ascii(c) - 55) % 97)


def _card(m: Column, key: Column) -> Column:
    def of(d: Column) -> Column:
        n, first = F.length(d), F.substr(d, F.lit(1), F.lit(1))
        body = F.concat(first, _permuted_digits(F.substr(d, F.lit(2), n - 2), F.concat(F.lit("card"), first), key), F.lit("0"))
        new = _let(body, lambda b: F.concat(F.substr(b, F.lit(1), n - 1), ((F.lit(10) - _luhn(b)) % 10).cast("string")))
        return F.when(_luhn(d) == 0, _refilled(m, new))
    return _let(_digits(m), of)


def _phone(m: Column, key: Column) -> Column:
    def of(d: Column) -> Column:
        extra = F.length(d) - 10
        new = F.concat(F.substr(d, F.lit(1), extra), _permuted_digits(F.substr(d, extra + 1, F.lit(10)), F.lit("phone"), key, (0, 3)))
        return _let(new, lambda x: _refilled(m, x))
    return _let(_digits(m), of)


def _world_phone(m: Column, key: Column) -> Column:
    def of(d: Column) -> Column:
        start = F.substr(d, F.lit(1), F.lit(2))
        new = F.concat(start, _permuted_digits(F.substr(d, F.lit(3), F.length(d) - 2), F.concat(F.lit("+"), start), key))
        return F.when(F.length(d).between(8, 15), _let(new, lambda x: _refilled(m, x)))
    return _let(_digits(m), of)


def _ssn(m: Column, key: Column) -> Column:
    part = F.split(m, "-")
    area = part[0].cast("bigint")
    values = _bigints(area - 1 - F.when(area > 666, 1).otherwise(0), part[1].cast("bigint") - 1, part[2].cast("bigint") - 1)
    new = feistel(values, _bigints(*_SSN), F.lit("ssn"), key)
    return _let(new, lambda v: F.format_string("%03d-%02d-%04d", v[0] + 1 + F.when(v[0] >= 665, 1).otherwise(0), v[1] + 1, v[2] + 1))


def _ip(m: Column, key: Column) -> Column:
    def of(o: Column) -> Column:
        plain = o[0].between(1, 223)
        low = F.when(plain, F.lit(1)).otherwise(o[0]).cast("bigint")
        new = feistel(_bigints(o[0] - low, o[1], o[2], o[3]), _bigints(F.when(plain, 223).otherwise(1), 256, 256, 256),
                      F.when(plain, F.lit("ip")).otherwise(F.concat(F.lit("ip"), o[0].cast("string"))), key)
        return F.array_join(F.transform(new, lambda x, i: (x + F.when(i == 0, low).otherwise(0)).cast("string")), ".")
    return _let(F.transform(F.split(m, r"\."), lambda x: x.cast("bigint")), of)


def _moved_day(date: Column, key: Column) -> Column:
    """The date's pseudonym, which is after the 12th of its month if the date is."""
    epoch = F.lit(_EPOCH).cast("date")
    month_of = lambda d: ((F.year(d) - 1800) * 12 + F.month(d) - 1).cast("bigint")

    def of(d: Column) -> Column:
        day, month = F.dayofmonth(d).cast("bigint"), month_of(d)
        late = day > 12
        # Numbered without gaps: days up to the 12th by month, the others less the twelve days of each month so far.
        n = F.when(late, F.datediff(d, epoch) - 12 * (month + 1)).otherwise(month * 12 + day - 1).cast("bigint")
        a, b = (F.when(late, F.lit(y)).otherwise(F.lit(x)).cast("bigint") for x, y in zip(_EARLY, _LATE))
        moved = _let(feistel(_bigints(F.floor(n / b), n % b), F.array(a, b), F.when(late, F.lit("late date")).otherwise(F.lit("date")), key),
                     lambda v: v[0] * b + v[1])

        def early_day(m: Column) -> Column:
            return F.make_date((F.floor(m / 12 / 12) + 1800).cast("int"), (F.floor(m / 12) % 12 + 1).cast("int"), (m % 12 + 1).cast("int"))

        def late_day(m: Column) -> Column:
            # The month is within one of the mean's guess; it is the one in which the day it gives lies.
            guess = F.floor(m * _MONTHS / (_LATE[0] * _LATE[1])).cast("int")
            days = F.transform(F.sequence(guess - 2, guess + 2), lambda k: F.struct(
                k.cast("bigint").alias("k"), F.date_add(epoch, (m + 12 * (k + 1)).cast("int")).alias("d")))
            return F.element_at(F.filter(days, lambda x: (month_of(x["d"]) == x["k"]) & (F.dayofmonth(x["d"]) > 12)), 1)["d"]

        return F.when(F.year(d).between(1800, 2199), _let(moved, lambda m: F.when(late, late_day(m)).otherwise(early_day(m))))
    return _let(date, of)


def _iso_date(m: Column, key: Column) -> Column:
    sep = F.substr(m, F.lit(5), F.lit(1))
    moved = F.date_format(_moved_day(F.replace(m, F.lit("/"), F.lit("-")).try_cast("date"), key), "yyyy-MM-dd")
    return F.replace(moved, F.lit("-"), sep)


def _day_date(m: Column, key: Column) -> Column:
    part = F.split(m, r"[./]")
    padded = (F.length(part[0]) == 2) & (F.length(part[1]) == 2)
    slash = F.contains(m, F.lit("/"))
    sep = F.when(slash, F.lit("/")).otherwise(F.lit("."))

    def date(day: Column, month: Column) -> Column:
        return F.concat_ws("-", part[2], F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")

    def of(day_first: Column) -> Column:
        swapped = slash & day_first.isNull()

        def put(d: Column) -> Column:
            day = F.when(padded, F.date_format(d, "dd")).otherwise(F.dayofmonth(d).cast("string"))
            month = F.when(padded, F.date_format(d, "MM")).otherwise(F.month(d).cast("string"))
            return F.concat(F.when(swapped, month).otherwise(day), sep, F.when(swapped, day).otherwise(month), sep, F.date_format(d, "yyyy"))
        return _let(_moved_day(F.when(swapped, date(part[1], part[0])).otherwise(day_first), key), put)
    return _let(date(part[0], part[1]), of)


def _iban(m: Column, key: Column) -> Column:
    def of(s: Column) -> Column:
        country, account = F.substr(s, F.lit(1), F.lit(2)), F.substr(s, F.lit(5), F.length(s) - 4)
        letters = F.regexp_replace(account, "[0-9]", "0")
        moved = _refilled(account, _permuted_digits(_digits(account), F.concat(F.lit("iban"), country, letters), key))

        def close(a: Column) -> Column:
            check = F.lpad((F.lit(98) - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0")
            return _refilled(m, F.concat(check, _digits(a)))
        valid = (F.length(s).between(15, 34)) & (_mod97(F.concat(account, F.substr(s, F.lit(1), F.lit(4)))) == 1)
        return F.when(valid, _let(moved, close))
    return _let(F.upper(F.regexp_replace(m, "[ -]", "")), of)


def _email(m: Column, key: Column) -> Column:
    local, domain = F.split_part(m, F.lit("@"), F.lit(1)), F.split_part(m, F.lit("@"), F.lit(2))

    def run(c: Column, which: int, other: int) -> Column:
        """Of a code point's alphabet its first code point or its size."""
        found = F
        for alphabet in ALPHABETS:
            found = found.when(c.between(alphabet[0], alphabet[0] + alphabet[1] - 1), F.lit(alphabet[which]))
        return found.otherwise(F.lit(other)).cast("bigint")

    def letter(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")

    def of(points: Column) -> Column:
        values = F.transform(points, lambda c: F.when(run(c, 1, 0) > 0, c - run(c, 0, 0)).otherwise(0).cast("bigint"))
        new = feistel(values, F.transform(points, lambda c: run(c, 1, 1)), F.concat(F.lit("@"), F.lower(domain)), key)
        return F.zip_with(points, new, lambda c, x: F.when(run(c, 1, 0) > 0, letter(run(c, 0, 0) + x)))

    # Letters outside every alphabet stay; a letter that was a capital is one again.
    moved = _let(F.transform(_chars(local), lambda c: F.ascii(F.lower(c)).cast("bigint")), of)
    put = F.zip_with(_chars(local), moved, lambda c, x: F.when(x.isNull(), c).when(c.rlike(r"^\p{Lu}$"), F.upper(x)).otherwise(x))
    return F.concat(F.array_join(put, ""), F.lit("@"), domain)


_PERMUTE = {"email": _email, "iban": _iban, "card": _card, "phone": _phone, "world_phone": _world_phone, "ssn": _ssn, "ip": _ip,
            "iso_date": _iso_date, "day_date": _day_date}


def pseudonym(match: Column, key: Column) -> Column:
    """struct(kind, size, new) of a candidate at its place; kind and new are NULL if it isn't valid."""
    def judged(kind: str) -> Column:
        return _let(_PERMUTE[kind](match, key), lambda n: F.struct(
            F.when(n.isNotNull(), F.lit(kind)).alias("kind"), F.length(match).alias("size"), n.alias("new")))

    rules = F
    for kind, pattern in PATTERNS.items():
        rules = rules.when(match.rlike(f"^(?:{pattern})$"), judged(kind))
    return rules.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), F.length(match).alias("size"), F.lit(None).cast("string").alias("new")))


def _secret(spark: SparkSession, key: str) -> Column:
    """The key as a subquery's value, so that it stands in no plan or event log."""
    if not key:
        raise ValueError("pseudonyms need a key")
    return spark.createDataFrame([(key,)], "k string").scalar()


def _with_found(df: DataFrame, text: str, hits: str, found: str, key: str) -> DataFrame:
    """``df`` with ``found``: in order of place (kind, size, new, rest), ``rest`` being the text up to the next candidate."""
    # One space in front: then every candidate's place is a border of the split text.
    spaced = F.concat(F.lit(" "), F.col(text))
    none = F.array().cast("array<string>")
    some = F.col(text).rlike("[0-9@]")
    name = free_name(df, "_key")
    df = df.withColumn(name, _secret(df.sparkSession, key))
    df = df.withColumn(hits, F.when(some, F.regexp_extract_all(spaced, F.lit(AT), F.lit(1))).otherwise(none))
    judged = df.withColumn(found, F.transform(hits, lambda m: pseudonym(m, F.col(name))))
    rests = F.slice(F.split(spaced, AT, -1), F.lit(2), F.greatest(F.size(hits), F.lit(0)))
    valid = F.size(F.filter(found, lambda f: f["kind"].isNotNull())) > 0
    empty = F.lit(None).cast("array<struct<kind:string,size:int,new:string,rest:string>>")
    return judged.withColumn(found, F.when(valid, F.zip_with(found, rests, lambda f, r: F.struct(
        f["kind"].alias("kind"), f["size"].alias("size"), f["new"].alias("new"), r.alias("rest")))).otherwise(empty)).drop(name)


def _chosen(found: str) -> Column:
    """struct(kinds, news, parts) of the valid candidates that no earlier one overlaps; parts are the text after the first candidate's place."""
    strings = F.array().cast("array<string>")

    def step(acc: Column, f: Column) -> Column:
        free = (acc["over"] <= 0) & f["kind"].isNotNull()
        over = F.when(free, f["size"]).otherwise(acc["over"])
        gone = F.greatest(F.least(over, F.length(f["rest"])), F.lit(0))
        part = F.concat(F.when(free, f["new"]).otherwise(F.lit("")), F.substr(f["rest"], gone + 1, F.length(f["rest"])))
        return F.struct((over - F.length(f["rest"])).alias("over"),
                        F.when(free, F.array_append(acc["kinds"], f["kind"])).otherwise(acc["kinds"]).alias("kinds"),
                        F.when(free, F.array_append(acc["news"], f["new"])).otherwise(acc["news"]).alias("news"),
                        F.array_append(acc["parts"], part).alias("parts"))

    start = F.struct(F.lit(0).alias("over"), strings.alias("kinds"), strings.alias("news"), strings.alias("parts"))
    return F.aggregate(found, start, step)


def _rewritten(text: str, chosen: str) -> Column:
    head = F.substr(F.get(F.split(F.concat(F.lit(" "), F.col(text)), AT, 2), F.lit(0)), F.lit(2), F.length(text))
    return F.when(F.col(chosen).isNotNull(), F.concat(head, F.array_join(F.col(chosen)["parts"], ""))).otherwise(F.col(text))


def pseudonyms(documents: DataFrame, key: str) -> DataFrame:
    """One row per document row: doc_id, text with pseudonyms, and in order the kinds and pseudonyms put in."""
    df = _with_found(id_text(documents), "text", "hits", "found", key).withColumn("chosen", _chosen("found"))
    none = F.array().cast("array<string>")
    return df.select("doc_id", _rewritten("text", "chosen").alias("text"), F.coalesce("chosen.kinds", none).alias("kinds"),
                     F.coalesce("chosen.news", none).alias("pseudonyms"))


def pseudonymise(documents: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``documents`` with its text rewritten, all other columns as they are."""
    hits, found, chosen = (free_name(documents, n) for n in ("_hits", "_found", "_chosen"))
    df = _with_found(documents, text_col, hits, found, key).withColumn(chosen, _chosen(found))
    return df.withColumn(text_col, _rewritten(text_col, chosen)).select(*[f"`{c}`" for c in documents.columns])
