import datetime as dt
import hashlib
import random
import re

import pytest
import regex

from pyspark.sql import functions as F

from terrane.llm import pii

KEY = "k1"


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def feistel(values, radices, tweak, key, back=False):
    """The network written out a second time; ``back`` undoes it."""
    v, half = list(values), len(values) // 2
    for r in reversed(range(pii.ROUNDS)) if back else range(pii.ROUNDS):
        even = r % 2 == 0
        fixed = v[half:] if even else v[:half]
        d = hashlib.sha512("|".join([key, tweak, str(r), ",".join(map(str, fixed))]).encode()).hexdigest()
        for i in range(half) if even else range(half, len(v)):
            h = int(d[(i % 16) * 8:(i % 16) * 8 + 8], 16)
            v[i] = (v[i] - h if back else v[i] + h) % radices[i]
    return v


def run(spark, texts, key=KEY):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r for r in sorted(pii.pseudonyms(df, key).collect(), key=lambda r: r.doc_id)]


def shape(s):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", s)))


CASES = {
    "card": ["4337166598464399", "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005"],
    "phone": ["+1 (988) 555-2485", "988-555-2485", "1.988.555.2485", "+19885552485", "+1 (152) 055-8590"],
    "world_phone": ["+49 30 1234567", "+442071838750"],
    "ssn": ["123-45-6789", "899-99-9999", "667-01-0001"],
    "ip": ["70.123.182.155", "8.8.8.8", "223.255.255.255"],
    "iso_date": ["2020-02-29", "1999-12-31"],
    "day_date": ["29/02/2020", "1.2.1999", "31/12/2100"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "email": ["bosbt.42@mail8.example.com", "A.b-9@x.org", "z@y.co"],
}


def test_every_kind_is_replaced_within_its_format_and_stays_valid(spark):
    values = [(k, v) for k, vs in CASES.items() for v in vs]
    rows = run(spark, [f"Wort é {v}, then" for _, v in values])
    for (kind, old), row in zip(values, rows):
        assert list(row.kinds) == [kind], old
        new = row.pseudonyms[0]
        assert row.text == f"Wort é {new}, then" and new != old
        if kind in ("card", "phone", "world_phone", "ssn", "iso_date"):
            assert shape(new) == shape(old)
        if kind == "card":
            assert luhn(new) and new[0] == old[0]
        if kind == "phone":
            lead = [d[-10] + d[-7] for d in (re.sub(r"\D", "", x) for x in (old, new))]
            assert [c >= "2" for c in lead[0]] == [c >= "2" for c in lead[1]]
        if kind == "ssn":
            a, g, s = map(int, new.split("-"))
            assert 1 <= a <= 899 and a != 666 and g and s
        if kind == "ip":
            o = [int(x) for x in new.split(".")]
            assert 1 <= o[0] <= 223 and max(o) <= 255
        if kind == "iso_date":
            dt.date.fromisoformat(new)
        if kind == "day_date":
            d, m, y = map(int, re.split("[./]", new))
            dt.date(y, m, d)
        if kind == "iban":
            assert mod97(new) == 1 and shape(new) == shape(old) and new[:2] == old[:2]
        if kind == "email":
            assert shape(new.split("@")[0]) == shape(old.split("@")[0]) and new.split("@")[1] == old.split("@")[1]


def test_an_iban_ends_by_the_length_of_its_country(spark):
    """One IBAN of each registered length (with the check digits that fit), spaced and compact, before words and numbers."""
    ibans = ["ES9121000418450200051332", "AT611904300234573201", "BE68539007547034", "PL61109010140000071219812874"]
    for n, countries in pii.IBAN_COUNTRIES.items():
        body = "".join(str((i * 7 + n) % 10) for i in range(n - 4))
        country = countries.split()[0]
        ibans.append(f"{country}{98 - mod97(country + '00' + body):02d}{body}")
    assert all(mod97(i) == 1 for i in ibans)
    texts, old = [], []
    for iban in ibans:
        for form in (iban, " ".join(iban[i:i + 4] for i in range(0, len(iban), 4))):
            for after in (" EUR 500", " 2024", " A", " BIC", ", then", " DE89370400440532013000"):
                texts.append(f"to {form}{after}")
                old.append((form, after))
    for (form, after), row in zip(old, run(spark, texts)):
        new = row.pseudonyms[0]
        assert row.kinds[0] == "iban" and mod97(new) == 1 and new != form and shape(new) == shape(form) and new[:2] == form[:2], form + after
        assert row.text.startswith(f"to {new}")
        if "DE89" in after:
            assert list(row.kinds) == ["iban"] * 2 and "DE89370400440532013000" not in row.text
        else:
            assert row.text == f"to {new}{after}"


def test_ibans_of_countries_outside_the_registry_are_still_met(spark):
    body = "00060000069512345678 901"
    iban = f"AO{98 - mod97('AO00' + body):02d}{body}".replace(" ", "")
    row, = run(spark, [f"an {iban}, then"])
    assert list(row.kinds) == ["iban"] and mod97(row.pseudonyms[0]) == 1 and iban not in row.text


def test_slash_dates_that_cannot_be_day_first_are_month_first(spark):
    a, b, c, d = run(spark, ["due 12/25/2020 or 2020-12-25", "2/29/2020 29/2/2020", "03/04/2021 2021-04-03",
                             "25/25/2020 2/30/2020 12.25.2020 12/25/1799"])
    y, m, day = a.pseudonyms[1].split("-")
    assert list(a.kinds) == ["day_date", "iso_date"] and a.pseudonyms[0] == f"{m}/{day}/{y}" and "12/25/2020" not in a.text
    x = [p.split("/") for p in b.pseudonyms]
    assert list(b.kinds) == ["day_date"] * 2 and x[0] == [x[1][1], x[1][0], x[1][2]]
    y, m, day = c.pseudonyms[1].split("-")
    assert c.pseudonyms[0] == f"{day}/{m}/{y}"
    assert list(d.kinds) == [] and d.text == "25/25/2020 2/30/2020 12.25.2020 12/25/1799"


def test_what_is_not_valid_stays(spark):
    texts = ["4337166598464398", "2021-02-30", "31/04/2020", "256.1.1.1", "1.2.3.4.5", "000-12-3456", "DE88370400440532013000",
             "12345678901234567890123", "version 2.0", "152-055-8590", "a@b", "@", None, "", "1700-01-01"]
    for t, r in zip(texts, run(spark, texts)):
        assert r.text == t and list(r.kinds) == [], t


def test_equal_values_stay_linked_across_documents_and_formats(spark):
    a, b, c, d, e, f = run(spark, ["4111111111111111 and 4111 1111 1111 1111", "x 4111-1111-1111-1111", "2020-02-29 29/02/2020 29.02.2020",
                                   "+1 (988) 555-2485 and 988.555.2485", "Bob.1@x.org bob.1@X.org", "10 8.8.8.8 10 8.8.8.8 10"])
    cards = {re.sub(r"\D", "", p) for r in (a, b) for p in r.pseudonyms}
    assert len(cards) == 1
    y, m, day = c.pseudonyms[0].split("-")
    assert list(c.pseudonyms[1:]) == [f"{day}/{m}/{y}", f"{day}.{m}.{y}"]
    assert re.sub(r"\D", "", d.pseudonyms[0]) == "1" + re.sub(r"\D", "", d.pseudonyms[1])
    assert e.pseudonyms[0].lower().split("@")[0] == e.pseudonyms[1].lower().split("@")[0]
    assert len(set(f.pseudonyms)) == 1 and f.text == f"10 {f.pseudonyms[0]} 10 {f.pseudonyms[0]} 10"
    assert run(spark, ["4111111111111111"], "k2")[0].text not in cards


def test_the_network_can_be_undone_and_is_a_permutation(spark):
    radices, got = [7, 3, 5], set()
    rows = [(a, b, c) for a in range(7) for b in range(3) for c in range(5)]
    df = spark.createDataFrame([(list(r),) for r in rows], "v array<bigint>")
    new = df.select("v", pii.feistel(F.col("v"), F.array(*[F.lit(r).cast("bigint") for r in radices]), F.lit("t"), F.lit(KEY)).alias("p"))
    for r in new.collect():
        assert feistel(r.v, radices, "t", KEY) == list(r.p) and feistel(r.p, radices, "t", KEY, back=True) == list(r.v)
        got.add(tuple(r.p))
    assert len(got) == len(rows)


def test_all_columns_stay_and_edge_cases(spark):
    long = "word " * 50000 + "4111111111111111" + " word" * 10
    df = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (None, long, None), (2, "8.8.8.8", "8.8.8.8")],
                               "doc_id long, text string, _hits string")
    out = pii.pseudonymise(df, KEY)
    assert out.columns == df.columns
    rows = {(r.doc_id, r["_hits"]): r.text for r in out.collect()}
    assert rows[(1, "a")] is None and rows[(1, "b")] == "" and rows[(2, "8.8.8.8")] != "8.8.8.8"
    assert len(rows[(None, None)]) == len(long) and "4111111111111111" not in rows[(None, None)]
    assert pii.pseudonyms(df.limit(0), KEY).count() == 0


def test_plan_runs_no_python(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = pii.pseudonyms(df, KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def brute(text):
    """(start, end, kind) by trying every place of the text, and validating by other code."""
    any_at, whole = regex.compile(pii.ANY), {k: regex.compile(p) for k, p in pii.PATTERNS.items()}
    found, at = [], 0
    while at < len(text):
        m = any_at.match(text, at)
        kind = next((k for k, p in whole.items() if p.fullmatch(m.group())), None) if m else None
        ok, s = kind is not None, m.group() if m else ""
        digits = re.sub("[^0-9]", "", s)
        if kind == "card":
            ok = luhn(s)
        elif kind == "world_phone":
            ok = 8 <= len(digits) <= 15
        elif kind == "iban":
            compact = re.sub("[ -]", "", s).upper()
            ok = 15 <= len(compact) <= 34 and mod97(compact) == 1
        elif kind in ("iso_date", "day_date"):
            p = [int(x) for x in re.split("[./-]", s)]
            orders = [p] if kind == "iso_date" else [[p[2], p[1], p[0]]] + ([[p[2], p[0], p[1]]] if "/" in s else [])
            ok = any(1800 <= y <= 2199 and 1 <= mo <= 12 and 1 <= d <= 31 and calendar(y, mo, d) for y, mo, d in orders)
        if ok:
            found.append((at, m.end(), kind))
            at = m.end()
        else:
            at += 1
    return found


def calendar(y, m, d):
    try:
        return bool(dt.date(y, m, d))
    except ValueError:
        return False


def test_finder_against_every_place(spark):
    rnd = random.Random(4)
    values = [v for vs in CASES.values() for v in vs] + [
        "PO42", "US12", "BE68", "1234", "0000", "99", "x", "12/25/2020", "31/31/2020", "1990/03/05", "4111.1111.1111.1111", "de89-3704-0044-0532-0130-00",
        "jürgen@example.org", "Жук.1@x.org", "é", "+", "-", ".", "@", "4111 1111 1111 1112", "\n"]
    texts = ["".join(rnd.choice(values) + rnd.choice([" ", " ", " ", "", "-", ", ", ". "]) for _ in range(rnd.randrange(1, 9))) for _ in range(700)]
    texts += ["PO42 4111 1111 1111 1111", "US12 4111 1111 1111 1111 x", "1234 1234 1234 4111 1111 1111 1111 1", "BE68 4111 1111 1111 1111",
              "4111 1111 1111 1111 4111 1111 1111 1111", "8.8.8.8.8 8.8.8.8"]
    met = set()
    for text, row in zip(texts, run(spark, texts)):
        want, rebuilt, last = brute(text), "", 0
        assert list(row.kinds) == [k for _, _, k in want], text
        for (a, b, kind), new in zip(want, row.pseudonyms):
            rebuilt, last = rebuilt + text[last:a] + new, b
            met.add(kind)
        assert row.text == rebuilt + text[last:], text
    assert met == set(pii.PATTERNS)


def test_every_kind_behind_tokens_that_begin_like_another(spark):
    values = [(k, v) for k, vs in CASES.items() for v in vs]
    before = ["PO42 ", "US12 ", "BE68 ", "1234 ", "DE89 3704 ", "+ ", "12/ ", "a@b "]
    texts = [f"{p}{v} x" for _, v in values for p in before]
    for (kind, value, text), row in zip(((k, v, t) for (k, v), t in zip([x for x in values for _ in before], texts)), run(spark, texts)):
        if kind != "phone" or not text.startswith(("1234", "+ ")):  # a number before a phone number may be its country code
            assert kind in list(row.kinds) and value not in row.text, text


def test_different_dates_get_different_pseudonyms_in_every_format(spark):
    days = [dt.date(1800, 1, 1) + dt.timedelta(days=i) for i in range(0, 146097, 7)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    moved = [r[0] for r in df.select(pii._moved_day(F.col("d"), F.lit(KEY))).collect()]
    assert len(set(moved)) == len(days) and all((a.day > 12) == (b.day > 12) for a, b in zip(days, moved))
    assert min(moved).year >= 1800 and max(moved).year <= 2199
    # As text: m/d/yyyy and d/m/yyyy never meet, as what cannot be day-first stays so.
    some = days[::40]
    texts = [f"{d.month}/{d.day}/{d.year}" for d in some if d.day > 12] + [f"{d.day}/{d.month}/{d.year}" for d in some]
    new = [r.pseudonyms[0] for r in run(spark, texts)]
    assert len(set(new)) == len(set(texts))


def test_all_dates_of_the_cycle_are_permuted(spark):
    n = spark.range(146097).select(pii._moved_day(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), F.lit(KEY)).alias("d"))
    row = n.agg(F.count_distinct("d"), F.min("d"), F.max("d")).first()
    assert tuple(row) == (146097, dt.date(1800, 1, 1), dt.date(2199, 12, 31))


def test_local_parts_of_other_alphabets(spark):
    a, b, c, d = run(spark, ["jürgen@example.org", "Jürgen@example.org", "жук@x.org 漢字@x.org", "ſþ@x.org"])
    new = a.pseudonyms[0].split("@")[0]
    assert len(new) == 6 and "ü" != new[1] and new.isalpha() and b.pseudonyms[0].split("@")[0] == new[0].upper() + new[1:]
    assert all(0x430 <= ord(x) < 0x450 for x in c.pseudonyms[0].split("@")[0]) and len(c.pseudonyms) == 2
    assert list(d.kinds) == ["email"]


def test_the_key_is_required_and_in_no_plan(spark):
    df = spark.createDataFrame([(1, "8.8.8.8")], "doc_id long, text string")
    with pytest.raises(ValueError, match="key"):
        pii.pseudonyms(df, "")
    out = pii.pseudonyms(df, "very hidden words")
    out.collect()
    assert "very hidden" not in out._jdf.queryExecution().toString()
