"""Column-level text functions: name normalisation, blocking keys,
snapshot dates from file names, file-name predicates.

Everything returns a ``Column`` built from JVM built-ins, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values --------------------------------------------------------
# Legal-form tokens deleted from business names (whole words, optional dot).
LEGAL_SUFFIX_PATTERN = (
    r"\b(inc|incorporated|llc|l\.?l\.?c\.?|ltd|limited|corp|corporation|"
    r"co|company|pllc|lp|l\.?p\.?|plc|gmbh|sa|srl|pty)\b\.?"
)
# Month abbreviations of historical snapshot names.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN",
          "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
# File-name date patterns: monthly "_YYYYMMDD." and historical "_YYYY_MON_".
DAILY_NAME_PATTERN = r"_(\d{4})(\d{2})(\d{2})\."
MONTHLY_NAME_PATTERN = r"(?i)_(\d{4})_([A-Z]{3})_"
FALLBACK_SNAPSHOT_DATE = "1970-01-01"
# -------------------------------------------------------------------------

# Python's str.strip()/\s also treat \x1c-\x1f as space; Java's \s (even in
# Unicode mode) does not, so the class names them explicitly.
_WS = r"[\s\x1c-\x1f]"
# A word boundary between letters, digits of any kind (also superscripts and
# fractions) or '_' and anything else; Java's own \b leaves some digits out.
_BOUNDARY = r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))"
# The characters str.strip() removes, derived from the same rule (isspace);
# trimming by this set needs no regex.
WHITESPACE_CHARS = "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim every Unicode whitespace character on both ends (set trim, no regex)."""
    return F.btrim(_col(c), F.lit(WHITESPACE_CHARS))


def blank_to_null(c) -> Column:
    """Trim, and turn an empty result into NULL."""
    return F.nullif(strip_ws(c), F.lit(""))


def normalize_name(c) -> Column:
    """Business-name normaliser: lower, trim, drop legal-form tokens
    anywhere, collapse whitespace, trim; blank -> NULL."""
    n = strip_ws(F.lower(_col(c)))
    n = F.regexp_replace(n, "(?iU)" + LEGAL_SUFFIX_PATTERN.replace(r"\b", _BOUNDARY), "")
    n = F.regexp_replace(n, rf"(?U){_WS}+", " ")
    return F.nullif(strip_ws(n), F.lit(""))


def zip5(c) -> Column:
    return F.substring(_col(c), 1, 5)


def first4(c) -> Column:
    return F.substring(_col(c), 1, 4)


def snapshot_date_text(file_name) -> Column:
    """Snapshot stamp as ``yyyy-MM-dd`` text from a snapshot file name.

    Monthly ``_YYYYMMDD.`` wins (digits are not calendar checked); then the
    historical ``_YYYY_MON_`` (unknown month -> 01, day 01); else 1970-01-01.
    """
    name = _col(file_name)
    y = F.regexp_extract(name, DAILY_NAME_PATTERN, 1)
    m = F.regexp_extract(name, DAILY_NAME_PATTERN, 2)
    d = F.regexp_extract(name, DAILY_NAME_PATTERN, 3)
    daily = F.when(F.length(y) > 0, F.concat_ws("-", y, m, d))
    hy = F.regexp_extract(name, MONTHLY_NAME_PATTERN, 1)
    mon = F.upper(F.regexp_extract(name, MONTHLY_NAME_PATTERN, 2))
    month_num = F.coalesce(
        F.element_at(F.create_map(*[x for i, mname in enumerate(MONTHS)
                                    for x in (F.lit(mname), F.lit(f"{i + 1:02d}"))]),
                     mon),
        F.lit("01"))
    monthly = F.when(F.length(hy) > 0, F.concat_ws("-", hy, month_num, F.lit("01")))
    return F.coalesce(daily, monthly, F.lit(FALLBACK_SNAPSHOT_DATE))


def snapshot_date(file_name) -> Column:
    """Snapshot date as DATE; an impossible monthly stamp raises under ANSI,
    as the text-to-date conversion of the loader does."""
    return F.to_date(snapshot_date_text(file_name), "yyyy-MM-dd")


def like_pattern(query) -> Column:
    """``'%' || q || '%'`` with backslashes escaped so that ``%`` and ``_``
    in the query stay wildcards (as in the reference) while ``\\`` is literal."""
    q = F.regexp_replace(_col(query), r"\\", r"\\\\")
    return F.concat(F.lit("%"), q, F.lit("%"))
