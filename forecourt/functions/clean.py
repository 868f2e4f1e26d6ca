"""Cleaning rules as pure ``Column -> Column`` functions.

Everything here compiles to built-in Catalyst expressions, so the rules run
inside whole-stage codegen with no Python on the executors.  Rule IDs (C1..)
follow the survey's operator inventory.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt.functions import vocab


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ASCII control whitespace plus every Unicode space separator (category Z*),
# built by rule so NBSP and friends are trimmed like ordinary spaces.
WHITESPACE = "\t\n\x0b\x0c\r" + "".join(
    ch for ch in map(chr, range(0x3001)) if unicodedata.category(ch).startswith("Z"))


# ---------------------------------------------------------------- text basics
def utrim(col) -> Column:
    """Trim ASCII *and* Unicode spaces (NBSP etc.) from both ends (no regex)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def upper_trim(col) -> Column:
    """Upper-case code normalisation."""
    return F.upper(utrim(col))


def lower_trim(col) -> Column:
    """Lower-case code normalisation."""
    return F.lower(utrim(col))


def collapse_ws(col) -> Column:
    """C11: trim, collapse internal whitespace runs, empty -> NULL."""
    return F.nullif(F.regexp_replace(utrim(col), r"\s+", " "), F.lit(""))


def part_key(col) -> Column:
    """Canonical part number: drop whitespace, dots and hyphens, upper."""
    return F.nullif(F.upper(F.regexp_replace(_c(col), r"[\s.\-]+", "")), F.lit(""))


def sentence_case(col) -> Column:
    """First letter upper, rest lower, whitespace collapsed."""
    t = collapse_ws(col)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30)))


# --------------------------------------------------------------------- numbers
def clean_numeric(col) -> Column:
    """Strip currency/unit markers and thousands commas, decimal comma -> point.

    Markers are removed as literals in the fixed order of ``NUMERIC_NOISE``
    (KMS before KM) and *before* thousands commas, so ``145,300KM`` and
    ``145KMS`` both clean correctly.  Returns text (NULL for empty input).
    Trimmed once, at the end: no step before looks at the ends of the text.
    """
    u = F.upper(F.coalesce(_c(col).cast("string"), F.lit("")))
    for token in vocab.NUMERIC_NOISE:  # literal removals, in list order
        u = F.replace(u, F.lit(token), F.lit(""))
    # the thousands-separator regex only runs on text that has a comma
    u = F.when(F.instr(u, ",") > 0, F.translate(F.regexp_replace(u, r",(\d{3})\b", "$1"), ",", ".")).otherwise(u)
    return F.nullif(utrim(u), F.lit(""))


def to_decimal(col, precision: int, scale: int) -> Column:
    """C1 + C28: cleaned numeric text as DECIMAL; unparseable -> NULL."""
    return clean_numeric(col).try_cast(f"decimal({precision},{scale})")


def to_int(col) -> Column:
    """C1 + D6: numeric text to INT, rounding fractions half away from zero."""
    return F.round(to_decimal(col, 18, 4), 0).try_cast("int")


def parse_error(raw, parsed) -> Column:
    """True when non-blank raw text failed to parse; never NULL.  The text is looked at
    only where nothing was parsed."""
    return parsed.isNull() & (F.length(utrim(F.coalesce(_c(raw).cast("string"), F.lit("")))) > 0)


def any_parse_error(pairs) -> Column:
    """Whether any (raw, parsed) pair of a row failed to parse."""
    out = F.lit(False)
    for raw, parsed in pairs:
        out = out | parse_error(raw, parsed)
    return out


def percent_or_fraction(col) -> Column:
    """Values above 1 are percentages; exactly 1 stays (100%).

    Written as one division by a chosen divisor so the cleaned value is
    evaluated once per row."""
    d = to_decimal(col, 6, 3)
    return (d / F.when(d > 1, F.lit(100)).otherwise(F.lit(1))).try_cast("decimal(7,5)")


def reorder_point(col) -> Column:
    """C20: '' and N/A are sentinels, otherwise an integer."""
    t = utrim(F.coalesce(_c(col), F.lit("")))
    return F.when(t.isin("", "N/A"), F.lit(None).cast("int")).otherwise(to_int(col))


# -------------------------------------------------------------------- booleans
def to_bool(col) -> Column:
    """Y/YES/1/TRUE/T and N/NO/0/FALSE/F; anything else NULL."""
    u = F.upper(utrim(F.coalesce(_c(col).cast("string"), F.lit(""))))
    return (F.when(u.isin(*vocab.TRUE_FORMS), F.lit(True))
            .when(u.isin(*vocab.FALSE_FORMS), F.lit(False)))


def is_deleted(op_col) -> Column:
    """NULL-safe soft-delete flag."""
    return F.coalesce(_c(op_col) == F.lit("D"), F.lit(False))


# ------------------------------------------------------------------ timestamps
def parse_ts(col) -> Column:
    """13-digit epoch ms, DD/MM/YYYY (no time), or ISO; else NULL.

    Returns ``timestamp_ntz`` (wall time in UTC).  Text is not trimmed, as in
    the source rule; malformed text in a recognised shape becomes NULL rather
    than aborting the job.  A pattern is tried only on text of its length (a line
    end may follow) or with its separator, which costs less than the pattern.
    """
    c = _c(col)
    return (F.when(F.length(c).between(13, 15) & c.rlike(r"^\d{13}$"),
                   F.timestamp_millis(c.try_cast("bigint")).cast("timestamp_ntz"))
            .when((F.substring(c, 3, 1) == "/") & c.rlike(r"^\d{2}/\d{2}/\d{4}"),
                  F.try_to_timestamp(c, F.lit("dd/MM/yyyy")).cast("timestamp_ntz"))
            .when((F.substring(c, 5, 1) == "-") & c.rlike(r"^\d{4}-\d{2}-\d{2}"), c.try_cast("timestamp_ntz")))


def null_placeholder_ts(ts) -> Column:
    """The 1900-01-01 "still open" placeholder (and anything older) -> NULL."""
    t = _c(ts)
    return F.when(t > F.lit(vocab.PLACEHOLDER_CUTOFF).cast("timestamp_ntz"), t)


def hour_boundaries(start, end) -> Column:
    """Number of hour boundaries crossed from start to end (signed).

    Truncating both sides to the hour first makes 10:59 -> 11:01 count as 1.
    """
    s = F.date_trunc("hour", _c(start).cast("timestamp"))
    e = F.date_trunc("hour", _c(end).cast("timestamp"))
    return ((F.unix_seconds(e) - F.unix_seconds(s)) / F.lit(3600)).cast("bigint")


def month_start(ts) -> Column:
    """First instant of the month, kept zone-less."""
    return F.date_trunc("month", _c(ts).cast("timestamp")).cast("timestamp_ntz")


# ------------------------------------------------------------ identifiers etc.
def phone_e164(col) -> Column:
    """C4: Nigerian numbers to +234...; anything else NULL."""
    d = F.regexp_replace(_c(col), r"[^0-9]", "")
    return (F.when(d.rlike(vocab.PHONE_LOCAL_PATTERN), F.concat(F.lit("+234"), F.substring(d, 2, 1 << 30)))
            .when(d.rlike(vocab.PHONE_INTL_PATTERN), F.concat(F.lit("+"), d)))


def order_number(col) -> Column:
    """WO / W/O prefixes with an optional - / space separator -> 'WO-'."""
    return F.concat(F.lit("WO-"), F.regexp_replace(upper_trim(col), r"^(WO|W/O)[-/ ]?", ""))


def sentinel_null(col, sentinels=None) -> Column:
    """Upper-trimmed text, with sentinel tokens mapped to NULL."""
    u = F.upper(utrim(F.coalesce(_c(col), F.lit(""))))
    return F.when(~u.isin(*(sentinels or vocab.TECHNICIAN_SENTINELS)), u)


def vin_strip(col) -> Column:
    """Upper first, then keep only [A-Z0-9]."""
    return F.regexp_replace(upper_trim(col), r"[^A-Z0-9]", "")


def vin_valid(stripped) -> Column:
    """A VIN is valid iff it has exactly 17 characters."""
    return F.length(_c(stripped)) == 17


def map_vocab(col, mapping: dict, default: str = "unknown", normalise=upper_trim) -> Column:
    """Literal map lookup of the normalised text, else ``default``."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    key = normalise(F.coalesce(_c(col), F.lit("")))
    return F.coalesce(F.try_element_at(m, key), F.lit(default))


def status(col) -> Column:
    """Unified work-order status."""
    return map_vocab(col, vocab.STATUS_MAP)


def line_type(col) -> Column:
    """Line type vocabulary (lower-cased), else 'unknown'."""
    return map_vocab(col, {t: t for t in vocab.LINE_TYPES}, normalise=lower_trim)


def plate_valid(plate) -> Column:
    """A Nigerian plate without separators: area, three digits, two letters."""
    return F.coalesce(_c(plate).rlike(vocab.PLATE_PATTERN), F.lit(False))


def invoice_number(col) -> Column:
    """INV prefixes with an optional - / space separator -> 'INV-'."""
    return F.concat(F.lit("INV-"), F.regexp_replace(upper_trim(col), r"^INV[-/ ]?", ""))


def email(col) -> Column:
    """lower/trim; NULL unless it looks like local@domain.tld."""
    e = lower_trim(col)
    return F.when(e.rlike(r"^[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}$"), e)


# -------------------------------------------------------------------- guards
def in_range(col, lo, hi) -> Column:
    """C14: value if lo <= v <= hi, else NULL."""
    c = _c(col)
    return F.when(c.between(lo, hi), c)


def out_of_range(col, lo, hi) -> Column:
    """C14: flag for a present value outside [lo, hi]."""
    c = _c(col)
    return c.isNotNull() & ~c.between(lo, hi)


def non_negative(col) -> Column:
    """Negatives -> NULL (NULL stays NULL)."""
    c = _c(col)
    return F.when(~(c < 0) | c.isNull(), c)


def negative_not_return(qty, ltype) -> Column:
    """C17: negative quantity on a line that is not a return."""
    return (_c(qty) < 0) & (_c(ltype) != F.lit("return"))


def safe_ratio(num, den) -> Column:
    """Num / den, NULL when den is 0 or NULL."""
    return F.when(_c(den) != 0, _c(num) / _c(den))


def exceeds_tolerance(source, recomputed, tolerance=vocab.TOTAL_TOLERANCE) -> Column:
    """|source - recomputed| > tolerance, only when source is present."""
    return _c(source).isNotNull() & (F.abs(_c(source) - _c(recomputed)) > tolerance)
