r"""Format-preserving pseudonyms for personal data. DataFrame operations only.

A value of a known form is checked (check digits, octets, calendar), split in two halves, and permuted by a keyed Feistel
network within its form: same length, same punctuation, still valid. The map is one to one for each form, so equal values
stay equal across all documents and different ones stay different; nothing has to be collected or looked up.

Forms, first match wins: assigned secrets to the end of their quotes or to the next space, bearer, cloud, repository and web tokens,
private keys, e-mail addresses, IBANs, IPv6 and IPv4 addresses, dates (year first or last; 1900-01-01 and 72,999 days on), telephone
numbers, card and account numbers: 9 digits and more, grouped or not. Secrets, keys and e-mail addresses have no numeric form; they become
keyed digests, which are equal for equal values too, as do numbers of more than 36 digits (as digits, of the same length).

What a number becomes depends on its digits alone, so all spellings of one number stay linked (a number of the North American plan with or
without its leading 1 too). The last digit of numbers of 13 digits and more keeps its distance from the valid check digit, so that valid
numbers stay valid, others stay invalid, and no two meet. Dates link across spellings; a date that no calendar has never meets one that has.

Without a key in the call, the setting `spark.plumbline.pseudonym.key` is the key; without that, it is drawn from the texts themselves
(one more reading), so that nobody can compute it who does not hold them. Pseudonyms of two corpora are linked only by a key that is given.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KEY_SETTING = "spark.plumbline.pseudonym.key"
#: Fixed forms, in order of precedence. A quantifier has a bound or is possessive and gives nothing back, so no text makes matching slow.
SECRET_NAME = r"(?i:password|passwort|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key)"
SECRET = SECRET_NAME + r"""["']?[ \t]{0,3}(?::=|=>|[=:])[ \t]{0,3}(?:"[^"\r\n]{6,}+"|'[^'\r\n]{6,}+'|["']?[^\s\p{Z}"'<>]{6,}+)"""
PRIVATE_KEY = r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"
TOKEN = (r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{20,}+|github_pat_[A-Za-z0-9_]{20,}+"
         r"|eyJ[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]++){1,4}+|(?i:bearer)[ \t]{1,3}(?=[A-Za-z+/_.~=-]{0,200}[0-9])[A-Za-z0-9+/_.~=-]{16,}+)"
         rf"|{PRIVATE_KEY}(?:(?:[A-Za-z0-9+/=\s:,]|-(?!----))*+-----END [A-Z0-9 ]{{0,40}}PRIVATE KEY-----|(?:\s*+[A-Za-z0-9+/=]{{40,}}+)*+)")
EMAIL = r"(?<![\p{L}\p{N}_.+%-])(?<![\p{L}\p{N}_.+%-]')[\p{L}\p{N}_.+%-]++(?:'[\p{L}\p{N}_.+%-]++)*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"
IBAN = (r"(?<![A-Za-z0-9])[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4})(?: (?=[A-Z]{0,3}\d)[A-Z0-9]{4}){1,6}(?: (?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_GROUPS = r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})"
IPV6 = rf"(?<![\w:])(?=[A-Fa-f:]{{0,39}}\d)(?:{_GROUPS}{{7}}|(?:{_GROUPS}{{0,6}})?::(?:{_GROUPS}{{0,6}})?)(?![\w:]|\.\d)"
IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
DATE = (r"(?<!\d)(?<!\d[./-])(?:" + "|".join(rf"(?:19|20)\d\d{s}\d{{1,2}}{s}\d{{1,2}}|\d{{1,2}}{s}\d{{1,2}}{s}(?:19|20)\d\d" for s in ("-", "/", r"\.")) + r")(?!\d|[./-]\d)")
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\d+])\+\d{8,14}(?!\d)|(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
NUMBER = r"(?<!\d)(?<!\d\.)(?:\d{4}(?:[ -]\d{4}){3}(?!\d)|\d(?:[ -]?\d){8,}+)"
FORMS = (SECRET, TOKEN, EMAIL, IBAN, IPV6, IPV4, DATE, PHONE, NUMBER)
ANY = "|".join(f"(?:{f})" for f in FORMS)
#: Whatever has none of these holds no value of any form.
HINT = "[0-9@=:]|AKIA|ASIA|gh[pousr]_|github_pat_|eyJ|-----BEGIN"
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 250, 292


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mixed(key: str, *parts: Column) -> Column:
    """A keyed pseudo-random number of 60 bits."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """Permute the pairs a < size_a, b < size_b: in turn, one half is shifted by a keyed number drawn from the other. A struct (a, b)."""

    def step(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        half = F.when(even, state["b"]).otherwise(state["a"])
        number = mixed(key, i, size_a, size_b, half)
        return F.struct(F.when(even, (state["a"] + number % size_a) % size_a).otherwise(state["a"]).alias("a"),
                        F.when(even, state["b"]).otherwise((state["b"] + number % size_b) % size_b).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def permuted_digits(key: str, digits: Column) -> Column:
    """A string of 2 to 36 digits, permuted among the strings of its length."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    right = n - left
    size_a, size_b = F.pow(F.lit(10.0), left).cast("long"), F.pow(F.lit(10.0), right).cast("long")
    halves = feistel(key, F.substring(digits, F.lit(1), left).cast("long"), F.substring(digits, left + 1, right).cast("long"), size_a, size_b)
    return let(halves, lambda h: F.concat(F.lpad(h["a"].cast("string"), left, F.lit("0")), F.lpad(h["b"].cast("string"), right, F.lit("0"))))


def digest_digits(key: str, digits: Column) -> Column:
    """As many digits, drawn from a keyed digest of `digits`; in time proportional to their number."""
    blocks = F.sequence(F.lit(1), F.ceil(F.length(digits) / 15).cast("int"))
    drawn = let(F.sha2(F.concat(F.lit(key + "digits|"), digits), 256), lambda seed: F.array_join(
        F.transform(blocks, lambda i: F.lpad((mixed(key, seed, i) % 10**15).cast("string"), 15, "0")), ""))
    return F.substring(drawn, F.lit(1), F.length(digits))


def luhn_digit(body: Column) -> Column:
    """The check digit that follows a string of digits."""
    n = F.length(body)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(body, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when((n - i) % 2 == 0, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add)
    return ((10 - total % 10) % 10).cast("string")


def refilled(form: Column, new: Column, kind: str = "0-9") -> Column:
    """`form` with its characters of `kind` replaced, in order, by those of `new`; all others stay. In time proportional to the length."""
    units = F.regexp_extract_all(form, F.lit(f"[{kind}][^{kind}]*"), F.lit(0))
    return F.concat(F.regexp_extract(form, f"^[^{kind}]*", 0), F.array_join(F.zip_with(
        F.split(new, ""), units, lambda c, unit: F.concat(c, F.substring(unit, F.lit(2), F.length(unit)))), ""))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def new_digits(key: str, digits: Column) -> Column:
    """9 digits and more become as many others, one to one.

    From 13 digits on, all but the last are permuted and the last keeps its distance from the check digit. Of 11 digits, a leading 1 stays
    and the rest becomes what it becomes without it; other leading digits turn among themselves by what follows.
    """
    n = F.length(digits)
    first, rest = F.substring(digits, 1, 1), F.substring(digits, F.lit(2), F.length(digits))
    body, last = F.substring(digits, F.lit(1), n - 1), F.substring(digits, n, F.lit(1)).cast("int")

    def checked(new_body: Column) -> Column:
        return F.concat(new_body, ((luhn_digit(new_body).cast("int") + last - luhn_digit(body).cast("int") + 10) % 10).cast("string"))

    def led(new_rest: Column) -> Column:
        place = F.instr(F.lit("023456789"), first)
        turned = F.substring(F.lit("023456789"), ((place - 1 + mixed(key + "lead", new_rest) % 9) % 9 + 1).cast("int"), F.lit(1))
        return F.concat(F.when(first == "1", "1").otherwise(turned), new_rest)

    return (F.when(n > 36, digest_digits(key, digits)).when(n >= 13, let(permuted_digits(key + "card", body), checked))
            .when(n == 11, let(permuted_digits(key + "number", rest), led)).otherwise(permuted_digits(key + "number", digits)))


def number_pseudonym(key: str, value: Column) -> Column:
    """Telephone, card and account numbers in any spelling."""
    return refilled(value, let(digits_of(value), lambda digits: new_digits(key, digits)))


def check_number(country: Column, account: Column) -> Column:
    """The two check digits of an IBAN (ISO 7064), as a number."""

    def add(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.lit(98) - F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(add(rest, c)))


def iban_pseudonym(key: str, value: Column) -> Column:
    """The digits of the account are permuted; the check digits keep their distance from the right ones. Country and letters stay.

    What is no valid IBAN and has fewer than 9 such digits is a product code or the like and stays.
    """

    def new(text: Column) -> Column:
        country, written, account = F.substring(text, 1, 2), F.substring(text, 3, 2).cast("int"), F.substring(text, F.lit(5), F.length(text))
        digits = digits_of(account)
        off = written - check_number(country, account)

        def put(new_account: Column) -> Column:
            return refilled(value, F.concat(country, F.lpad(((check_number(country, new_account) + off + 100) % 100).cast("string"), 2, "0"), new_account), "A-Z0-9")

        meant = (F.length(digits) >= 9) | ((off == 0) & (F.length(digits) >= 2))
        return F.when(meant, let(refilled(account, permuted_digits(key + "iban", digits)), put)).otherwise(value)

    return let(F.regexp_replace(value, " ", ""), new)


def ip_pseudonym(key: str, value: Column) -> Column:
    part = F.transform(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("long"), F.lit(0)))
    halves = let(part, lambda p: feistel(key + "ip", p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536)))
    return let(halves, lambda h: F.concat_ws(".", *[x.cast("string") for x in (F.floor(h["a"] / 256), h["a"] % 256, F.floor(h["b"] / 256), h["b"] % 256)]))


def ipv6_pseudonym(key: str, value: Column) -> Column:
    """Another address of 128 bits, written in full; all spellings of one address become the same. More than eight groups stay."""
    word = lambda digits: F.conv(digits, 16, -10).cast("long")

    def groups(side: Column) -> Column:
        return F.transform(F.filter(F.split(side, ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0"))

    def step(s: Column, i: Column) -> Column:
        drawn = word(F.substring(F.sha2(F.concat_ws("|", F.lit(key + "ip6"), i.cast("string"), s["b"].cast("string")), 256), 1, 16))
        return F.struct(s["b"].alias("a"), s["a"].bitwiseXOR(drawn).alias("b"))

    def new(sides: Column) -> Column:
        left, right = groups(sides[0]), groups(F.coalesce(F.get(sides, 1), F.lit("")))
        gap = F.lit(8) - F.size(left) - F.size(right)
        digits = F.array_join(F.concat(left, F.array_repeat(F.lit("0000"), F.greatest(gap, F.lit(0))), right), "")
        start = let(digits, lambda d: F.struct(word(F.substring(d, 1, 16)).alias("a"), word(F.substring(d, 17, 16)).alias("b")))
        done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(F.lpad(F.hex(s["a"]), 16, "0"), F.lpad(F.hex(s["b"]), 16, "0")))
        return F.when(gap >= 0, F.regexp_replace(F.lower(done), "(....)(?=.)", "$1:")).otherwise(value)

    return let(F.split(F.lower(value), "::", -1), new)


def date_pseudonym(key: str, value: Column) -> Column:
    """A calendar day within the range becomes another one, written alike; what is no day, or outside, becomes digits that are none either."""
    mark, padded = F.regexp_extract(value, "[-/.]", 0), F.length(value) == 10
    day, month = F.when(padded, "dd").otherwise("d"), F.when(padded, "MM").otherwise("M")
    form = F.when(value.rlike("^[0-9]{4}"), F.concat(F.lit("yyyy"), mark, month, mark, day)).otherwise(F.concat(day, mark, month, mark, F.lit("yyyy")))
    zero = F.lit(FIRST_DAY).cast("date")

    def number(text: Column) -> Column:
        return F.datediff(F.try_to_timestamp(text, form).cast("date"), zero)

    def inside(n: Column) -> Column:
        return F.coalesce(n.between(0, DAYS_A * DAYS_B - 1), F.lit(False))

    def walked(text: Column, i: Column) -> Column:  # one step in 1,400 falls on a day; six in a row do not
        return F.when((i == 0) | inside(number(text)), refilled(text, permuted_digits(key + "nodate", digits_of(text)))).otherwise(text)

    def moved(n: Column) -> Column:
        halves = feistel(key + "date", F.floor(n / DAYS_B), n % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B))
        new = let(halves, lambda h: F.call_function("date_format", F.date_add(zero, (h["a"] * DAYS_B + h["b"]).cast("int")), form))
        return F.when(inside(n), new).otherwise(F.aggregate(F.sequence(F.lit(0), F.lit(6)), value, walked))

    return let(number(value), moved)


def hidden(key: str, secret: Column) -> Column:
    """As many hex digits of a keyed digest as the secret has characters (64 at most)."""
    return F.substring(F.sha2(F.concat(F.lit(key + "secret|"), secret), 256), F.lit(1), F.least(F.length(secret), F.lit(64)))


def secret_pseudonym(key: str, value: Column) -> Column:
    """Name and sign, quotes and the punctuation of the sentence stay; the value between becomes a digest."""
    name = F.regexp_extract(value, r"""^[^=:]*+(?::=|=>|[=:])[ \t]*+["']?""", 0)
    rest = F.substring(value, F.length(name) + 1, F.length(value))

    def new(text: Column) -> Column:
        tail = F.regexp_extract(text, r"""(?<![.,;:)\]}"'])[.,;:)\]}"']*+$""", 0)
        secret = F.substring(text, F.lit(1), F.length(text) - F.length(tail))
        return F.when(secret == "", value).otherwise(F.concat(name, hidden(key, secret), tail))

    return let(rest, new)


def token_pseudonym(key: str, value: Column) -> Column:
    """`Bearer` and the first line of a private key stay; what follows becomes a digest, white space aside."""
    name = F.regexp_extract(value, rf"^(?:(?i:bearer)[ \t]++|{PRIVATE_KEY})", 0)
    rest = F.regexp_replace(F.substring(value, F.length(name) + 1, F.length(value)), r"\s++", "")
    return F.concat(name, F.when(name.startswith("-"), " ").otherwise(""), hidden(key, rest))


def email_pseudonym(key: str, value: Column) -> Column:
    return F.concat(F.lit("user."), F.substring(F.sha2(F.concat(F.lit(key + "mail|"), F.lower(value)), 256), 1, 16), F.lit("@example.invalid"))


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of one matched value."""
    whole = lambda form: value.rlike(f"^(?:{form})$")
    kinds = ((SECRET, secret_pseudonym), (TOKEN, token_pseudonym), (EMAIL, email_pseudonym), (IBAN, iban_pseudonym), (IPV6, ipv6_pseudonym),
             (IPV4, ip_pseudonym), (DATE, date_pseudonym))
    return reduce(lambda rest, kind: F.when(whole(kind[0]), kind[1](key, value)).otherwise(rest), reversed(kinds), number_pseudonym(key, value))


def drawn_key(docs: DataFrame, text: str = "text") -> str:
    """The key of the session or, where none is set, one drawn from all texts: the same for the same texts in any order, one row to the driver."""
    given = docs.sparkSession.conf.get(KEY_SETTING, None)
    if given:
        return given
    digest = F.sha2(F.concat(F.lit("pseudonyms|"), F.coalesce(F.col(f"`{text}`"), F.lit(""))), 256)
    return "|".join(str(v) for v in docs.select(digest.alias("d")).agg(*[
        F.sum(F.conv(F.substring("d", at, 15), 16, 10).cast("decimal(20,0)")) for at in (1, 16, 31, 46)]).first())


def pseudonymize(docs: DataFrame, key: str | None = None, text: str = "text", count: str | None = None) -> DataFrame:
    """`docs` with `text` rewritten, and the number of values replaced in the column named `count`, if one is.

    Nulls stay null; texts without such data come back unchanged; other columns are kept.
    Row by row, without a shuffle: repeated rows, hot values and copies cost no more than any row.
    """
    key = key or drawn_key(docs, text)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    row = docs.select(F.struct(*rest).alias("r") if rest else F.struct(F.lit(0).alias("none")).alias("r"), F.col(f"`{text}`").alias("t"))
    found = row.withColumn("m", F.when(F.col("t").rlike(HINT), F.regexp_extract_all("t", F.lit(ANY), F.lit(0))))
    parts = F.split(F.col("t"), ANY, -1)
    woven = let(parts, lambda p: F.array_join(F.concat(F.flatten(F.zip_with(F.slice(p, F.lit(1), F.size("m")), F.col("m"), lambda a, v: F.array(a, pseudonym(key, v)))), F.slice(p, -1, 1)), ""))
    n = F.coalesce(F.size("m"), F.lit(0))
    n = F.when(n > 0, n).otherwise(0).cast("long")
    done = found.select("r", n.alias("n"), F.when(n > 0, woven).otherwise(F.col("t")).alias("t"))
    return done.select(*[F.col("t").alias(c) if c == text else F.col("r")[c].alias(c) for c in docs.columns], *([F.col("n").alias(count)] if count else []))


def pii_query(spark, sf_dir):
    return pseudonymize(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), count="n_replaced")
