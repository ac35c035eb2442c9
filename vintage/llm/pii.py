"""Format-preserving pseudonyms for personal data.

Validated numbers and dates are permuted within their format: a card number becomes another valid
card number with the same first digit and separators, a date another date. The permutation is a keyed
Feistel network over the numbers of a format, so under one key equal values get equal pseudonyms in all
documents, different values different ones, and the key's owner can undo them. E-mail names and
secrets, which are no numbers of a format, get keyed digests of their own alphabet and length or more.

What is found: e-mail addresses, payment cards (Luhn), IPv4 addresses, North American phone numbers and
international ones with a plus, social security numbers, IBANs (mod 97), dates that exist (2020-01-31, 31.1.2020,
1/31/2020), access keys and passwords. Digits that don't validate stay as they are, but what lies in or beside
them is looked for again: a text is read in several passes, each over what those before it have left.

Defined results: a null text stays null, an empty one empty; repeated rows are treated alike; an empty
table gives an empty result; other columns are not changed, whatever their names. Texts are read whole, also very
long ones; a text and what was found in it must fit in a task. Of values that overlap, the kind listed first
and then the one further left is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.llm.staging import packed

ROUNDS = 10
#: Replace it: whoever knows the key can undo the pseudonyms.
KEY = "change-this-key"
KEY_SETTING = "spark.vintage.pii.key"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NUMBER = r"(?<![\w])(?<!\d[.,-])"
#: Length -> countries whose IBANs have it.
_IBANS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern(length: int, countries: str) -> str:
    fours, rest = divmod(length - 4, 4)
    last = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})\d\d(?: ?[A-Z0-9]{{4}}){{{fours}}}{last}"


_FOURS = r"\d{4}(?:[ -]\d{4}){3}"
_CARD = rf"\d{{13,19}}|{_FOURS}|\d{{4}}[ -]\d{{6}}[ -]\d{{4,5}}"
#: Kind -> pattern, tried in this order at every place of a text.
PATTERNS = {
    "email": r"(?<![\w.+%-])[\w.+%-]+@(?:[A-Za-z0-9-]{1,63}\.){1,9}[A-Za-z]{2,24}",
    "secret": r"(?i:(?:password|passwd|pwd|secret|token|api_key))[=:]\s?[^\s,;]{6,}",
    "access": r"(?<!\w)(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w)",
    "iban": rf"(?<!\w)(?=[A-Z]{{2}}\d\d)(?:{'|'.join(_iban_pattern(*x) for x in _IBANS.items())})(?!\w)",
    "ip": rf"{_NUMBER}{_OCTET}(?:\.{_OCTET}){{3}}(?!\w)(?!\.\d)",
    "ssn": rf"{_NUMBER}(?!000|666|9\d\d)\d{{3}}-(?!00)\d\d-(?!0000)\d{{4}}(?!\w)",
    "date": rf"{_NUMBER}(?:\d{{4}}-\d\d-\d\d(?=T\d\d)|(?:\d{{4}}-\d\d-\d\d|\d{{1,2}}\.\d{{1,2}}\.\d{{4}}|\d{{1,2}}/\d{{1,2}}/\d{{4}})(?!\w))",
    "phone": r"(?<![\w+])(?:\+1[ .-]?|1[ .-])?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]\d{4}(?!\w)",
    "card": rf"{_NUMBER}(?:{_CARD})(?!\w)",
    "plus": r"(?<![\w+])\+[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\w)",
}
KINDS = ("email", "secret", "access", "iban", "ip", "card", "ssn", "date", "phone", "plus")
_LATER = ("ip", "ssn", "date", "phone", "card", "plus")
#: Passes over a text as (patterns, what a text must hold, whether only texts are read in which something failed validation).
#: Each reads what the passes before it have left, so what lies in or beside a span that failed is looked for again:
#: cards of 4-4-4-4-3 digits and all other kinds without IBANs, cards one, two and three groups of four behind a
#: failed start, and last IBANs of any country and cards of any grouping.
PASSES = [
    (PATTERNS, r"[0-9@=:]", False),
    ({k: PATTERNS[k] for k in _LATER} | {"card": rf"{_NUMBER}(?:{_FOURS}[ -]\d{{3}}|{_CARD})(?!\w)"}, r"\d", True),
    *(({"card": rf"(?<=(?<!\w)\d{{4}}(?:[ -]\d{{4}}){{{n}}}[ -]){_FOURS}(?!\w)"}, rf"\d{{4}}(?:[ -]\d{{4}}){{{n + 4}}}", True) for n in range(3)),
    (
        {
            "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
            "card": rf"{_NUMBER}\d(?:[ -]?\d){{12,18}}(?!\w)",
        },
        r"\d(?:[ -]?\d){12}|[A-Z]{2}\d{2} ?[A-Z0-9]{4} ?[A-Z0-9]{4}",
        False,
    ),
]
#: A code point that is no character. In texts it is followed by the next one, in marks of replaced values by another.
_MARK = "\ufdd0"
_PLAIN = _MARK + "\ufdd1"
#: Days of 400 years, in which the calendar repeats, and the factors they are permuted by.
CYCLE, CYCLE_LEFT = 146_097, 189
CYCLE_START = -62_091  # 1800-01-01, in days from 1970-01-01


def _mod(value: Column, by: Column) -> Column:
    return F.pmod(value, by)


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, tag: Column) -> Column:
    """A struct (l, r): the pair permuted among left_size x right_size pairs, by the key and domain in ``tag``."""

    def digest(i: Column, half: Column) -> Column:
        text = F.concat_ws("|", tag, i.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")

    def step(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, _mod(state["l"] + _mod(digest(i, state["r"]), left_size), left_size)).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(_mod(state["r"] + _mod(digest(i, state["l"]), right_size), right_size)).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(base: int, exponent: Column) -> Column:
    return F.pow(F.lit(float(base)), exponent).cast("long")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def permuted_digits(digits: Column, tag: Column) -> Column:
    """Another string of as many digits (up to 36)."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    left, right = F.left(digits, half).cast("long"), F.right(digits, rest).cast("long")
    mixed = feistel(F.coalesce(left, F.lit(0)), right, _power(10, half), _power(10, rest), F.concat_ws("|", tag, F.length(digits)))
    return _let(
        mixed,
        lambda m: F.concat(
            F.when(half > 0, F.lpad(m["l"].cast("string"), half, "0")).otherwise(""), F.lpad(m["r"].cast("string"), rest, "0")
        ),
    )


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of digits, the last of which counts once."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def _refill(shape: Column, digits: Column) -> Column:
    """The shape with its digits replaced, in order, separators staying."""
    places = F.transform(F.split(shape, ""), lambda c, i: F.struct(c.alias("c"), F.length(_digits(F.left(shape, i + 1))).alias("n")))
    return F.array_join(
        F.transform(places, lambda p: F.when(p["c"].rlike(r"\d"), F.substring(digits, p["n"], F.lit(1))).otherwise(p["c"])), ""
    )


def _card(found: Column, key: Column) -> Column:
    def renumbered(digits: Column) -> Column:
        body = F.concat(F.left(digits, F.lit(1)), permuted_digits(F.substring(digits, F.lit(2), F.length(digits) - 2), F.concat(key, F.lit("card"))))
        return _let(body, lambda b: _refill(found, F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string"))))

    return _let(_digits(found), lambda d: F.when(luhn_sum(d) % 10 == 0, renumbered(d)).otherwise(found))


def _ip(found: Column, key: Column) -> Column:
    def octet(parts: Column, i: int) -> Column:
        return parts[i].cast("long")

    return _let(
        F.split(found, r"\."),
        lambda p: _let(
            feistel(octet(p, 0) * 256 + octet(p, 1), octet(p, 2) * 256 + octet(p, 3), F.lit(65536), F.lit(65536), F.concat(key, F.lit("ip"))),
            lambda m: F.concat_ws(".", F.floor(m["l"] / 256), m["l"] % 256, F.floor(m["r"] / 256), m["r"] % 256),
        ),
    )


def _phone(found: Column, key: Column) -> Column:
    """Area and exchange codes start from 2; a leading country code stays."""

    def renumbered(digits: Column) -> Column:
        n = F.right(digits, F.lit(10))
        mixed = feistel(
            (F.left(n, F.lit(3)).cast("long") - 200) * 800 + F.substring(n, 4, 3).cast("long") - 200,
            F.right(n, F.lit(4)).cast("long"), F.lit(640_000), F.lit(10_000), F.concat(key, F.lit("phone")),
        )
        lead = F.left(digits, F.length(digits) - 10)
        return _let(
            mixed,
            lambda m: _refill(
                found,
                F.concat(lead, (F.floor(m["l"] / 800) + 200).cast("string"), (m["l"] % 800 + 200).cast("string"), F.lpad(m["r"].cast("string"), 4, "0")),
            ),
        )

    return _let(_digits(found), renumbered)


def _plus(found: Column, key: Column) -> Column:
    """International numbers: the country code, up to the first separator or two digits, stays."""
    lead = F.regexp_extract(found, r"^\+(\d{1,3}(?=[ .(-])|\d\d)", 1)
    return _let(
        _digits(found),
        lambda d: F.when(F.length(d) < 8, found).otherwise(
            _refill(found, F.concat(lead, permuted_digits(F.substring(d, F.length(lead) + 1, F.length(d)), F.concat(key, F.lit("plus"), lead))))
        ),
    )


def _ssn(found: Column, key: Column) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""

    def rank(area: Column) -> Column:
        return area - F.when(area > 666, 2).otherwise(1)

    mixed = feistel(
        rank(F.left(found, F.lit(3)).cast("long")) * 99 + F.substring(found, 5, 2).cast("long") - 1,
        F.right(found, F.lit(4)).cast("long") - 1, F.lit(898 * 99), F.lit(9999), F.concat(key, F.lit("ssn")),
    )

    def written(m: Column) -> Column:
        area = F.floor(m["l"] / 99)
        area = area + F.when(area >= 665, 2).otherwise(1)
        three, two, four = (F.lpad(x.cast("string"), n, "0") for x, n in ((area, 3), (m["l"] % 99 + 1, 2), (m["r"] + 1, 4)))
        return F.concat_ws("-", three, two, four)

    return _let(mixed, written)


def _date(found: Column, key: Column) -> Column:
    """A day of the same 400 years. With slashes the month comes first, or the day if only that exists."""
    p = lambda i: F.split(found, r"[-./]")[i].cast("int")
    iso, dots = found.contains("-"), found.contains(".")
    month_first = _make_date(p(2), p(0), p(1))
    day = F.when(iso, _make_date(p(0), p(1), p(2))).when(dots, _make_date(p(2), p(1), p(0))).otherwise(
        F.coalesce(month_first, _make_date(p(2), p(1), p(0)))
    )
    pattern = F.when(iso, "yyyy-MM-dd").when(dots, "dd.MM.yyyy").when(month_first.isNotNull(), "MM/dd/yyyy").otherwise("dd/MM/yyyy")

    def moved(d: Column) -> Column:
        offset = F.unix_date(d) - CYCLE_START
        mixed = feistel(
            F.floor(_mod(offset, F.lit(CYCLE)) / (CYCLE // CYCLE_LEFT)), _mod(offset, F.lit(CYCLE)) % (CYCLE // CYCLE_LEFT),
            F.lit(CYCLE_LEFT), F.lit(CYCLE // CYCLE_LEFT), F.concat(key, F.lit("date")),
        )
        base = F.floor(offset / CYCLE) * CYCLE + CYCLE_START
        return _let(
            mixed, lambda m: _written(F.date_from_unix_date((base + m["l"] * (CYCLE // CYCLE_LEFT) + m["r"]).cast("int")), pattern)
        )

    return _let(day, lambda d: F.when(d.isNull(), found).otherwise(moved(d)))


def _make_date(y: Column, m: Column, d: Column) -> Column:
    """The date, null if there is none, whatever the ANSI setting."""
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
    return F.try_to_date(text, "yyyy-MM-dd")


def _written(day: Column, pattern: Column) -> Column:
    y, m, d = F.lpad(F.year(day).cast("string"), 4, "0"), F.lpad(F.month(day).cast("string"), 2, "0"), F.lpad(F.day(day).cast("string"), 2, "0")
    return (
        F.when(pattern == "yyyy-MM-dd", F.concat_ws("-", y, m, d))
        .when(pattern == "dd.MM.yyyy", F.concat_ws(".", d, m, y))
        .when(pattern == "MM/dd/yyyy", F.concat_ws("/", m, d, y))
        .otherwise(F.concat_ws("/", d, m, y))
    )


def _iban(found: Column, key: Column) -> Column:
    """Digits of the account are permuted, country and letters stay, the check digits follow."""

    def remainder(text: Column) -> Column:
        values = F.transform(F.split(text, ""), lambda c: F.conv(c, 36, 10).cast("long"))
        return F.aggregate(values, F.lit(0).cast("long"), lambda s, v: (s * F.when(v > 9, 100).otherwise(10) + v) % 97)

    def renumbered(plain: Column) -> Column:
        country, account = F.left(plain, F.lit(2)), F.substring(plain, F.lit(5), F.length(plain))
        mixed = _refill(account, permuted_digits(_digits(account), F.concat(key, F.lit("iban"), country)))
        check = _let(mixed, lambda a: F.concat(F.lpad((98 - remainder(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), _digits(a)))
        return _refill(found, check)

    plain = F.replace(found, F.lit(" "), F.lit(""))
    valid = lambda p: (F.length(p) >= 15) & (
        remainder(F.concat(F.substring(p, F.lit(5), F.length(p)), F.left(p, F.lit(4)))) == 1
    )
    return _let(plain, lambda p: F.when(valid(p), renumbered(p)).otherwise(found))


def _access(found: Column, key: Column) -> Column:
    """Sixteen characters of 36, as a pair of numbers."""
    half = 36**8
    number = lambda start: F.conv(F.substring(found, start, 8), 36, 10).cast("long")
    mixed = feistel(number(5), number(13), F.lit(half), F.lit(half), F.concat(key, F.lit("access")))
    written = lambda x: F.lpad(F.conv(x.cast("string"), 10, 36), 8, "0")
    return _let(mixed, lambda m: F.concat(F.left(found, F.lit(4)), written(m["l"]), written(m["r"])))


def _digest(text: Column, key: Column, kind: str) -> Column:
    return F.sha2(F.concat(key, F.lit(f"{kind}|"), text), 256)


def _email(found: Column, key: Column) -> Column:
    """The name before the @ becomes a digest of the address; the domain stays."""
    return F.concat(F.lit("u"), F.left(_digest(F.lower(found), key, "email"), F.lit(15)), F.lit("@"), F.substring_index(found, "@", -1))


def _secret(found: Column, key: Column) -> Column:
    lead = F.regexp_extract(found, r"^[A-Za-z_]+[=:]\s?", 0)
    value = F.substring(found, F.length(lead) + 1, F.length(found))
    return F.concat(lead, F.left(_digest(value, key, "secret"), F.greatest(F.lit(16), F.least(F.lit(64), F.length(value)))))


_REPLACE = {
    "email": _email, "secret": _secret, "access": _access, "iban": _iban, "ip": _ip, "card": _card,
    "ssn": _ssn, "date": _date, "phone": _phone, "plus": _plus,
}


def pseudonyms(df: DataFrame, carry: list[str], key: str) -> DataFrame:
    """``row`` (carry), ``clean`` (the text with pseudonyms) and ``n_<kind>`` per row of ``df``.

    A text without digits and @ holds nothing that is looked for, and is passed on as it is.
    """
    secret = F.lit(f"{key}|")
    rows = df.select(packed(df, carry).alias("row"), F.col("text").alias("text"))
    rows = rows.withColumn("now", F.replace("text", F.lit(_MARK), F.lit(_PLAIN))).withColumn("failed", F.lit(False))
    for n, (patterns, holding, after_failure) in enumerate(PASSES):
        rows = _pass(rows, n, patterns, F.col("now").rlike(holding) & (F.col("failed") | F.lit(not after_failure)), secret)
    clean = F.col("now")
    for n in range(len(PASSES)):
        gaps = F.split(clean, _mark(n), -1)
        filled = F.array_join(F.zip_with(gaps, F.col(f"new{n}.new"), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")
        rows = rows.withColumn("now", F.when(F.size(f"new{n}") > 0, filled).otherwise(clean))
    changed = lambda name: sum(
        F.coalesce(F.size(F.filter(f"new{n}", lambda x: x["kind"] == name)), F.lit(0)) for n, (p, _, _) in enumerate(PASSES) if name in p
    )
    return rows.select(
        "row",
        F.replace("now", F.lit(_PLAIN), F.lit(_MARK)).alias("clean"),
        *(changed(name).cast("long").alias(f"n_{name}") for name in KINDS),
    )


def _mark(n: int) -> str:
    return _MARK + chr(ord(_MARK) + 2 + n)


def _pass(rows: DataFrame, n: int, patterns: dict[str, str], wanted: Column, secret: Column) -> DataFrame:
    """``rows`` with ``now`` holding marks for the values found and valid, which ``new<n>`` lists as (kind, new)."""
    pattern = "|".join(f"({p})" for p in patterns.values())

    def named(x: Column) -> Column:
        kind = F.lit(None).cast("string")
        for name, p in reversed(patterns.items()):
            kind = F.when(x.rlike(f"^(?:{p})$"), name).otherwise(kind)
        return F.struct(x.alias("text"), (kind if len(patterns) > 1 else F.lit(next(iter(patterns)))).alias("kind"))

    def replaced(x: Column) -> Column:
        column = None
        for name in patterns:
            value = _REPLACE[name](x["text"], secret)
            column = F.when(x["kind"] == name, value) if column is None else column.when(x["kind"] == name, value)
        return F.struct(x["text"].alias("text"), x["kind"].alias("kind"), F.coalesce(column, x["text"]).alias("new"))

    found = rows.withColumn("found", F.when(wanted, F.regexp_extract_all("now", F.lit(pattern), 0)))
    any_found = F.size("found") > 0
    kinds = found.withColumn("named", F.when(any_found, F.transform("found", named))).drop("found")
    swapped = kinds.withColumn("swapped", F.when(F.size("named") > 0, F.transform("named", replaced))).drop("named")
    left = F.transform("swapped", lambda x: F.when(x["new"] == x["text"], x["text"]).otherwise(_mark(n)))
    joined = F.array_join(
        F.zip_with(F.split("now", pattern, -1), left, lambda gap, x: F.concat(F.coalesce(gap, F.lit("")), F.coalesce(x, F.lit("")))), ""
    )
    valid = F.transform(F.filter("swapped", lambda x: x["new"] != x["text"]), lambda x: F.struct(x["kind"].alias("kind"), x["new"].alias("new")))
    kept = [c for c in rows.columns if c not in ("now", "failed")]
    return swapped.select(
        *kept,
        F.when(F.size("swapped") > 0, joined).otherwise(F.col("now")).alias("now"),
        (F.col("failed") | F.coalesce(F.exists("swapped", lambda x: x["new"] == x["text"]), F.lit(False))).alias("failed"),
        valid.alias(f"new{n}"),
    )


def key_of(spark) -> str:
    """The key set for the session, or the public default."""
    return spark.conf.get(KEY_SETTING, None) or KEY


def pseudonymised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with pseudonyms in the text, all other columns as they are."""
    clean = pseudonyms(docs, docs.columns, key_of(docs.sparkSession))
    return clean.select(*(F.col("clean").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
