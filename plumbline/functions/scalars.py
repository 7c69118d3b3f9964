"""Column functions: fingerprints, redaction, strict parsing, times, labels."""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import SENSITIVE_LITERALS, SENSITIVE_PATTERNS

MICRO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_json(cols: list[str]) -> Column:
    """One JSON text per row: names sorted, nulls kept, times to the microsecond."""
    return F.to_json(
        F.struct(*sorted(cols)),
        {"timestampFormat": MICRO_FORMAT, "timestampNTZFormat": MICRO_FORMAT, "ignoreNullFields": "false"},
    )


def record_sha(cols: list[str]) -> Column:
    return F.sha2(canonical_json(cols), 256)


def sha256(c: str | Column) -> Column:
    return F.sha2(_col(c), 256)


def md5(c: str | Column) -> Column:
    return F.md5(_col(c))


def _may_match(text: Column, rule: str) -> Column | None:
    """A cheap necessary condition of a rule: plain substring search, far faster than its pattern."""
    literals = SENSITIVE_LITERALS.get(rule)
    return reduce(lambda a, b: a | b, [text.contains(x) for x in literals]) if literals else None


def redact(c: str | Column, mark: str = "[redacted]") -> Column:
    """Replace every sensitive pattern by a mark.

    Rules with a fixed literal share one branch, tested on the original text (a mark never
    brings a literal about), so ordinary texts run only the patterns without one.
    """
    text = _col(c)
    for has_literal, group in groupby(SENSITIVE_PATTERNS, key=lambda rule: rule in SENSITIVE_LITERALS):
        rules = list(group)
        replaced = reduce(lambda t, rule: F.regexp_replace(t, SENSITIVE_PATTERNS[rule], mark), rules, text)
        if has_literal:
            possible = reduce(lambda x, y: x | y, [_may_match(_col(c), rule) for rule in rules])
            replaced = F.when(possible, replaced).otherwise(text)
        text = replaced
    return text


def sensitive_counts(c: str | Column) -> dict[str, Column]:
    """Number of hits per rule; the matched text itself never leaves the expression."""
    counts = {}
    for rule, pattern in SENSITIVE_PATTERNS.items():
        possible, hits = _may_match(_col(c), rule), F.regexp_count(_col(c), F.lit(pattern))
        counts[rule] = hits if possible is None else F.when(possible, hits).otherwise(F.when(_col(c).isNotNull(), 0))
    return counts


def is_sensitive(c: str | Column) -> Column:
    return reduce(lambda a, b: a | b, [n > 0 for n in sensitive_counts(c).values()])


def strict_decimal(c: str | Column, precision: int = 38, scale: int = 18) -> Column:
    """Plain decimal text only: no exponent, no NaN or infinity, no blanks; else null."""
    text = _col(c)
    plain = text.rlike(r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?$")
    return F.when(plain, text.try_cast(f"decimal({precision},{scale})"))


def strict_bool(c: str | Column) -> Column:
    """`true` or `false` in any case; everything else is null."""
    text = F.lower(_col(c))
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def from_epoch(c: str | Column, unit: str) -> Column:
    """UTC timestamp of an epoch number; `unit` is part of the contract, never guessed."""
    makers = {"ms": F.timestamp_millis, "s": F.timestamp_seconds, "us": F.timestamp_micros}
    if unit not in makers:
        raise ValueError(f"unknown epoch unit {unit!r}")
    return makers[unit](_col(c).cast("bigint"))


def parse_zoned(c: str | Column, batch_start: Column | None = None) -> Column:
    """RFC 3339 text with a zone; without one, or after the start of the batch, null."""
    text = _col(c)
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})$")
    parsed = F.when(shaped, F.try_to_timestamp(text))
    return parsed if batch_start is None else F.when(parsed <= batch_start, parsed)


def date_matches(ts: str | Column, member_date: str | Column) -> Column:
    """The UTC date of the event is the date of its member."""
    return F.to_date(_col(ts)) == _col(member_date)


def parse_checksum(c: str | Column) -> Column:
    """`<64 hex>  <name>` as struct(sha256, name); null when the line has another form."""
    pattern = r"^([0-9a-f]{64})  (\S+)$"
    return F.when(
        _col(c).rlike(pattern),
        F.struct(F.regexp_extract(_col(c), pattern, 1).alias("sha256"),
                 F.regexp_extract(_col(c), pattern, 2).alias("name")),
    )


def infer_symbols(c: str | Column, symbols: list[str]) -> Column:
    """Sorted distinct symbol names found in a text: candidates only, never proof."""
    found = F.regexp_extract_all(F.upper(_col(c)), F.lit("(" + "|".join(s.upper() for s in symbols) + ")"), 1)
    return F.array_sort(F.array_distinct(found))


def unique_json_long(c: str | Column, paths: list[str]) -> Column:
    """The number under exactly one of the mapped JSON fields; none or several give null."""
    values = F.array_compact(F.array(*[F.get_json_object(_col(c), p).try_cast("bigint") for p in paths]))
    return F.when(F.size(values) == 1, values[0])


def _minute_of_day(local: Column) -> Column:
    return F.hour(local) * 60 + F.minute(local)


def session_label(ts: str | Column, us_open: str | None = None, zone: str = "Asia/Shanghai") -> Column:
    """Trading session by Beijing clock: Asia from 08:00, Europe from 15:00, US until 08:00.

    The US session opens at 09:30 in New York, which is 21:30 in Beijing in summer and 22:30 in winter;
    `us_open` fixes another opening by Beijing clock.
    """
    utc = _col(ts).cast("timestamp")
    minute = _minute_of_day(F.from_utc_timestamp(utc, zone))
    if us_open is None:  # from 15:00 to midnight in Beijing it is the morning of the same day in New York
        early = _minute_of_day(F.from_utc_timestamp(utc, "America/New_York")) < 9 * 60 + 30
    else:
        hours, minutes = us_open.split(":")
        early = minute < int(hours) * 60 + int(minutes)
    return F.when((minute >= 480) & (minute < 900), "asia").when((minute >= 900) & early, "europe").otherwise("us")


def session_date(ts: str | Column, zone: str = "Asia/Shanghai") -> Column:
    """The day a session belongs to: Beijing date counted from 08:00, so a US night stays one session."""
    local = F.from_utc_timestamp(_col(ts).cast("timestamp"), zone)
    return F.to_date(local - F.expr("INTERVAL 8 HOURS"))


def after_cutoff(ts: str | Column, cutoff: Column, precision: str = "second") -> Column:
    """`before` / `after` on the raw precision; `ambiguous` marks rows inside the cutoff's own coarse unit.

    A cutoff known to the second is never widened to the end of that second.
    """
    late = _col(ts) > cutoff
    same_unit = F.date_trunc(precision, _col(ts)) == F.date_trunc(precision, cutoff)
    return F.when(late & same_unit, "after_ambiguous").when(late, "after").otherwise("before")


def time_gate(event: str | Column, visible: str | Column) -> Column:
    """`pass` only when both clocks are known; neither replaces the other."""
    return F.when(_col(event).isNotNull() & _col(visible).isNotNull(), "pass").otherwise("unknown")


def source_visible_at(archive: str | Column, checksum: str | Column) -> Column:
    """The later of both publication times; unknown if either is unknown."""
    a, b = _col(archive), _col(checksum)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def input_version(parts: list[str | Column]) -> Column:
    """Fingerprint of the immutable input tuple."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit("\\N")) for p in parts]
    return F.sha2(F.concat_ws("\n", *texts), 256)


def escape_formula(c: str | Column) -> Column:
    """Spreadsheet-safe text: a leading formula sign gets a quote in front."""
    return F.when(_col(c).rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), _col(c))).otherwise(_col(c))


def schema_sha(df: DataFrame) -> Column:
    """Fingerprint of the ordered column facts (position, name, type, nullability)."""
    facts = "\n".join(f"{i}|{f.name}|{f.dataType.simpleString()}|{str(f.nullable).lower()}" for i, f in enumerate(df.schema))
    return F.sha2(F.lit(facts), 256)
