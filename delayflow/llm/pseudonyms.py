"""Format-preserving pseudonyms of validated numbers, dates and addresses.

Values are permuted within their format by a Feistel network keyed by a secret, so equal
values stay linked across documents and different ones stay different. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# Stands for the secret of a corpus in tests; give ``key`` in production.
KEY = "not a secret"

# Alphabets of the characters that are permuted; others stay in place.
ALPHABETS = [
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
]
HEX = ["0123456789abcdef"]
HEX_UPPER = ["0123456789ABCDEF"]

# Formats, in the order in which they are tried at a place. A run of the characters
# of an address is tried once, from its beginning or from where the last match ended, and parts that can
# only be read one way are possessive, so that time and depth stay bounded on any text. A
# domain has at most 127 labels.
PATTERNS = {
    "email": r"(?:(?<![\p{L}\p{N}._%+\-])|\G)[\p{L}\p{N}._%+\-]++@[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+(?:\.[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+){0,126}\.[A-Za-z]{2,}",
    "secret": r"(?<=(?i:token|secret|key|password|passwd)['\x22]?\x20{0,2}[=:]\x20{0,2}['\x22]?)(?:[0-9a-f]{16,128}|[0-9A-F]{16,128})(?![0-9A-Za-z])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![\w]|\.[0-9])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ymd": r"(?<![\p{L}\p{N}])[12][0-9]{3}([\-/.])[01][0-9]\1[0-3][0-9](?![0-9])",
    "dmy": r"(?<![\p{L}\p{N}.\-/])[0-3]?[0-9]([\-/.])[0-3]?[0-9]\2[12][0-9]{3}(?![0-9])",
    "ssn": r"(?<![\w\-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\w\-])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[\x20.\-]?)?\([0-9]{2,4}\)[\x20.\-]?[0-9]{3,4}[\x20.\-]?[0-9]{3,4}(?![\w])|(?<![\w+])\+[0-9]{1,3}(?:[\x20.\-]?[0-9]{2,4}){2,5}(?![\w])|(?<![\w\-.])[0-9]{3}[\-.][0-9]{3}[\-.][0-9]{4}(?![\w\-])",
    "card": r"(?<![\w\-.])[0-9](?:[\x20\-]?[0-9]){11,18}(?![\w\-])",
}
KINDS = [*PATTERNS]

# Groups of digits, of any number, that stand alone; card numbers are looked for among them.
# Possessive, so that runs of many thousand groups are matched without recursion.
_GROUP = r"[0-9]++(?!\w|-(?![0-9]))"
DIGIT_RUN = rf"(?<![\w\-.])(?=[0-9](?:[\x20\-]?[0-9]){{11}}){_GROUP}(?:[\x20\-]{_GROUP})*+"
# The longest that may be an account number at each place, whatever other places take in.
IBAN_PLACES = r"(?<![\p{L}\p{N}])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![\p{L}\p{N}]))"
CARD_DIGITS = range(19, 12, -1)
IBAN_CHARS = range(34, 14, -1)


def _digest(key: str, tweak: Column | str, step: Column, other: Column) -> Column:
    """Hash of a round: key, tweak, round and the half that stays."""
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak
    return F.sha2(F.concat_ws("|", F.lit(key), tweak, step.cast("string"), other), 256)


def _shift(half: Column, digest: Column, alphabets: list[str]) -> Column:
    """Each character moved on in its own alphabet by two digits of the hash.

    A hash has 32 pairs of digits; characters further on use them again.
    """

    def moved(c: Column, i: Column) -> Column:
        step = F.conv(F.substring(digest, 2 * F.pmod(i, F.lit(32)) + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for alphabet in alphabets:
            place = F.instr(F.lit(alphabet), c)
            at = F.pmod(place - 1 + step, F.lit(len(alphabet))) + 1
            out = F.when(place > 0, F.substring(F.lit(alphabet), at, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(half, ""), moved), "")


def permute(value: Column, key: str, tweak: Column | str, alphabets: list[str] = ALPHABETS) -> Column:
    """Feistel permutation of a string: classes of characters and all others keep their place.

    Each round moves one half by a keyed hash of the other, so it can be undone whatever the
    halves' lengths are. Values of one character are moved by the hash of nothing.
    """
    cut = (F.length(value) / 2).cast("int")
    start = F.struct(
        F.substring(value, F.lit(1), cut).alias("a"),
        F.substring(value, cut + 1, F.length(value)).alias("b"),
    )

    def step(s: Column, i: Column) -> Column:
        first = F.struct(_shift(s["a"], _digest(key, tweak, i, s["b"]), alphabets).alias("a"), s["b"].alias("b"))
        second = F.struct(s["a"].alias("a"), _shift(s["b"], _digest(key, tweak, i, s["a"]), alphabets).alias("b"))
        return F.when(i % 2 == 0, first).otherwise(second)

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"])
    )


def permute_number(value: Column, left: int, right: int, key: str, tweak: str) -> Column:
    """Feistel permutation of 0 to ``left * right - 1``, without a value outside to be walked over."""
    def hashed(i: Column, other: Column) -> Column:
        return F.conv(F.substring(_digest(key, tweak, i, other.cast("string")), F.lit(1), F.lit(12)), 16, 10).cast("long")

    start = F.struct(
        (value.cast("long") / right).cast("long").alias("a"),
        F.pmod(value.cast("long"), F.lit(right)).alias("b"),
    )

    def step(s: Column, i: Column) -> Column:
        a = F.pmod(s["a"] + hashed(i, s["b"]), F.lit(left).cast("long"))
        b = F.pmod(s["b"] + hashed(i, s["a"]), F.lit(right).cast("long"))
        return F.when(i % 2 == 0, F.struct(a.alias("a"), s["b"].cast("long").alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), b.alias("b"))
        )

    start = F.struct(start["a"].alias("a"), start["b"].cast("long").alias("b"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["a"] * right + s["b"]
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of digits, every other one from the right doubled; ``doubled`` is the parity of those."""
    places = F.split(F.reverse(digits), "")

    def weight(c: Column, i: Column) -> Column:
        d = F.ascii(c) - 48
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == doubled, twice).otherwise(d)

    return F.aggregate(F.transform(places, weight), F.lit(0), lambda s, x: s + x)


def luhn_valid(value: Column) -> Column:
    """Whether the digits have a right check digit and are not all alike."""
    digits = _digits(value)
    return (F.pmod(_luhn_sum(digits, 1), F.lit(10)) == 0) & (F.size(F.array_distinct(F.split(digits, ""))) > 1)


def _refill(shape: Column, chars: Column, wanted: str) -> Column:
    """``shape`` with the characters of the class ``wanted`` replaced by ``chars`` in order."""
    old = F.split(shape, "")
    places = F.filter(F.sequence(F.lit(1), F.length(shape)), lambda i: F.element_at(old, i).rlike(wanted))
    return F.array_join(
        F.transform(
            old,
            lambda c, i: F.when(
                c.rlike(wanted),
                F.substring(chars, F.array_position(places, i + 1).cast("int"), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = permute(F.substring(digits, F.lit(1), F.length(digits) - 1), key, F.concat(F.lit("card"), F.length(digits).cast("string")))
    check = F.pmod(10 - F.pmod(_luhn_sum(body, 0), F.lit(10)), F.lit(10))
    return _refill(value, F.concat(body, check.cast("string")), "[0-9]")


def _mod97(value: Column) -> Column:
    """Remainder by 97 of an account number, letters read as 10 to 35."""
    def add(s: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), F.pmod(s * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(
            F.pmod(s * 100 + letter, F.lit(97))
        )

    return F.aggregate(F.split(value, ""), F.lit(0), add)


def _plain_iban(value: Column) -> Column:
    return F.regexp_replace(value, " ", "")


def iban_valid(value: Column) -> Column:
    plain = _plain_iban(value)
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))
    return F.length(plain).between(15, 34) & (_mod97(moved) == 1)


def _iban(value: Column, key: str) -> Column:
    plain = _plain_iban(value)
    country = F.substring(plain, F.lit(1), F.lit(2))
    body = permute(F.substring(plain, F.lit(5), F.length(plain)), key, F.concat(F.lit("iban"), country))
    check = 98 - _mod97(F.concat(body, country, F.lit("00")))
    return _refill(value, F.concat(country, F.lpad(check.cast("string"), 2, "0"), body), "[A-Z0-9]")


# A 400-year cycle of the calendar has 189 * 773 days, so permuted dates are dates.
CALENDAR = (189, 773)
FIRST_DAY = "1800-01-01"


def _parts(value: Column) -> Column:
    return F.split(value, r"[\-/.]")


def _day(value: Column, order: str) -> Column:
    """The date of a value, its parts in the order of the letters; NULL if there is none."""
    parts = _parts(value)
    year, month, day = (F.lpad(parts[order.index(x)], 4 if x == "y" else 2, "0") for x in "ymd")
    return F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd")


def _valid_day(value: Column, order: str) -> Column:
    day = _day(value, order)
    return day.isNotNull() & day.between(F.to_date(F.lit(FIRST_DAY)), F.to_date(F.lit("2199-12-31")))


def _date(value: Column, order: str, key: str) -> Column:
    """Another date in the same order of parts, separators and padding."""
    number = F.datediff(_day(value, order), F.to_date(F.lit(FIRST_DAY)))
    new = F.date_add(F.to_date(F.lit(FIRST_DAY)), permute_number(number, *CALENDAR, key, f"date{order}").cast("int"))
    texts = {"y": F.date_format(new, "yyyy"), "m": F.date_format(new, "MM"), "d": F.date_format(new, "dd")}
    mark = F.regexp_extract(value, r"[\-/.]", 0)
    return F.concat_ws("", texts[order[0]], mark, texts[order[1]], mark, texts[order[2]])


def _ip(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
    new = permute_number(number, 65_536, 65_536, key, "ip")
    octets = [F.shiftright(new, 8 * i).bitwiseAND(F.lit(255)).cast("string") for i in (3, 2, 1, 0)]
    return F.concat_ws(".", *octets)


def _email(value: Column, key: str) -> Column:
    """All labels but the last are permuted."""
    end = F.regexp_extract(value, r"\.[A-Za-z]+$", 0)
    start = F.substring(value, F.lit(1), F.length(value) - F.length(end))
    return F.concat(permute(start, key, "email"), end)


def _phone(value: Column, key: str) -> Column:
    """The country's number, if one is given, stays."""
    head = F.regexp_extract(value, r"^\+[0-9]{1,3}(?![0-9])", 0)
    return F.concat(head, permute(F.substring(value, F.length(head) + 1, F.length(value)), key, "phone"))


def kind_of(value: Column) -> Column:
    """Which format a match has after validation; NULL if it is none."""

    def whole(name: str) -> Column:
        # Look-behinds have nothing to look at here.
        body = PATTERNS[name].replace(r"\2", r"\1")
        if name == "secret":
            body = r"[0-9a-f]{16,128}|[0-9A-F]{16,128}"
        return value.rlike(rf"^(?:{body})$")

    american = value.contains("/") & _valid_day(value, "mdy")
    return (
        F.when(value.contains("@"), "email")
        .when(whole("ip"), "ip")
        .when(whole("ymd"), F.when(_valid_day(value, "ymd"), "ymd"))
        .when(whole("dmy"), F.when(american, "mdy").when(_valid_day(value, "dmy"), "dmy"))
        .when(whole("ssn"), "ssn")
        .when(whole("phone"), "phone")
        .when(whole("iban") & iban_valid(value), "iban")
        .when(whole("card") & luhn_valid(value), "card")
        .when(whole("secret") & value.rlike("[A-Fa-f]"), "secret")
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The value under its pseudonym; as it is where ``kind`` is NULL."""
    upper = value.rlike("[A-F]")
    return (
        F.when(kind == "email", _email(value, key))
        .when(kind == "ip", _ip(value, key))
        .when(kind == "ymd", _date(value, "ymd", key))
        .when(kind == "mdy", _date(value, "mdy", key))
        .when(kind == "dmy", _date(value, "dmy", key))
        .when(kind == "ssn", permute(value, key, "ssn"))
        .when(kind == "phone", _phone(value, key))
        .when(kind == "iban", _iban(value, key))
        .when(kind == "card", _card(value, key))
        .when((kind == "secret") & upper, permute(value, key, "secret", HEX_UPPER))
        .when(kind == "secret", permute(value, key, "secret", HEX))
        .otherwise(value)
    )


def _windows(text: Column, patterns: list[str], group: int, valid) -> Column:
    """Distinct valid matches of the patterns in their order."""
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(group)) for p in patterns]
    return F.filter(F.array_distinct(F.flatten(F.array(*found))), valid)


def valid_cards(text: Column) -> Column:
    """Card numbers within runs of digit groups, longer ones first.

    They begin and end with a group, so numbers before and after one do not hide it. Twelve
    digits have to be a whole run.
    """
    runs = F.array_join(F.array_distinct(F.regexp_extract_all(text, F.lit(DIGIT_RUN), F.lit(0))), "\n")
    patterns = [rf"(?<![0-9])(?=([0-9](?:[\x20\-]?[0-9]){{{n - 1}}})(?![0-9]))" for n in CARD_DIGITS]
    patterns.append(r"(?m)^(?=([0-9](?:[\x20\-]?[0-9]){11})$)")
    return _windows(runs, patterns, 1, luhn_valid)


def valid_ibans(text: Column) -> Column:
    """Account numbers at any place, longer ones first; what follows one does not hide it."""
    places = F.array_join(F.array_distinct(F.regexp_extract_all(text, F.lit(IBAN_PLACES), F.lit(1))), "\n")
    patterns = []
    for n in IBAN_CHARS:
        fours, rest = divmod(n - 4, 4)
        tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        patterns.append(rf"(?m)^[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{fours}}}{tail}(?![A-Z0-9])")
    return _windows(places, patterns, 0, iban_valid)


def _pattern(ibans: Column, cards: Column) -> Column:
    """The formats in order, account and card numbers as the valid ones of the row.

    Numbers that fail validation are no matches, so they take nothing in.
    """
    parts = []
    for name, pattern in PATTERNS.items():
        if name == "iban":
            one = F.concat(F.lit(r"|(?<![\p{L}\p{N}])(?=[A-Z]{2}[0-9])(?:"), F.array_join(ibans, "|"), F.lit(r")(?![\p{L}\p{N}])"))
            parts.append(F.when(F.size(ibans) > 0, one).otherwise(""))
        elif name == "card":
            one = F.concat(F.lit(r"|(?<![\w.])(?=[0-9])(?:"), F.array_join(cards, "|"), F.lit(r")(?!\w)"))
            parts.append(F.when(F.size(cards) > 0, one).otherwise(""))
        else:
            parts.append(F.lit(("|" if parts else "") + f"(?:{pattern})"))
    return F.concat(*parts)


def pseudonymise(
    docs: DataFrame, text_col: str = "text", key: str = KEY, found_col: str | None = None
) -> DataFrame:
    """The same rows, personal values in the text under pseudonyms.

    Values that fail validation (a wrong check digit, no such day, an octet over 255) stay as
    they are, and so does all text around. Card and account numbers are validated before the
    text is searched, so a number or word beside one hides neither it nor other values. Equal values in one format have equal pseudonyms
    under one key. NULL texts stay NULL, empty ones empty; every row and column is kept.
    With ``found_col`` a column of that name lists the kinds that were replaced, in order.
    """
    # All columns travel as one, so that none has the name of a column of a step.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.col(f"`{text_col}`")
    # Every format has a digit or an at sign; other texts are not searched.
    likely = text.rlike("[0-9@]")
    numbers = docs.select(
        row,
        text.alias("text"),
        F.when(likely, valid_ibans(text)).alias("_ibans"),
        F.when(likely, valid_cards(text)).alias("_cards"),
    )
    pattern = F.when(F.col("_cards").isNotNull(), _pattern(F.col("_ibans"), F.col("_cards")))
    searched = numbers.select("row", "text", pattern.alias("_pattern"))
    parts = searched.select(
        "row",
        "text",
        F.split("text", F.col("_pattern")).alias("_between"),
        F.regexp_extract_all("text", F.col("_pattern"), F.lit(0)).alias("_found"),
    )
    kinds = F.transform("_found", lambda m: F.struct(m.alias("m"), kind_of(m).alias("k")))
    known = parts.select("row", "text", "_between", kinds.alias("_kinds"))
    new = F.transform("_kinds", lambda x: pseudonym(x["m"], x["k"], key))
    replaced = known.select("row", "text", "_between", "_kinds", new.alias("_new"))
    joined = F.array_join(
        F.zip_with("_between", "_new", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )
    changed = F.when(F.size("_new") > 0, joined).otherwise(F.col("text"))
    out = [changed.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns]
    if found_col:
        listed = F.filter(F.transform("_kinds", lambda x: x["k"]), lambda k: k.isNotNull())
        out.append(F.coalesce(listed, F.array().cast("array<string>")).alias(found_col))
    return replaced.select(*out)
