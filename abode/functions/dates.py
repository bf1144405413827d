"""Date repair expressions for installer feeds.

Dates arrive as free text (day-first with slashes or dots, unpadded day or
month, spreadsheet serial numbers, a handful of hand-typed oddities). The
repair is a fixed sequence of pure Column expressions, so it stays inside
whole-stage codegen and runs wherever the rows are.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abode.functions.numbers import to_number

# ---------------------------------------------------------------------------
# Literal date repairs applied after padding (text -> text).
# ---------------------------------------------------------------------------
DATE_LITERAL_REPAIRS = {
    "Aug-20": "01/08/2020",
    "Sep-20": "01/09/2020",
    "15/11/017": "15/11/2017",
    "14/08/209": "14/08/2019",
    "July/Aug 2020": "01/07/2020",
    "Wk com 25/10/2021": "25/10/2021",
    "Wk com 18/10/2021": "18/10/2020",
    "30/09/2106": "30/09/2016",
}
# Spreadsheet serials are decoded only for these leading digits,
# counted from 1899-12-30 and shifted back by two days.
SERIAL_PREFIXES = ("39", "43")
SERIAL_EPOCH = "1899-12-30"
SERIAL_OFFSET = 2
# Dates before FLOOR_YEAR are replaced by FLOOR_DATE.
FLOOR_YEAR = 2010
FLOOR_DATE = "2015-01-01"

DMY_PATTERN = r"^\d{2}/\d{2}/\d{4}$"
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
_DAY_PADS = [f"{d}/" for d in range(1, 10)]
_MONTH_PADS = [f"/{m}/" for m in range(1, 10)]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_lit(value: str | _dt.date) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else F.lit(value)


def year_start(c: Column | str) -> Column:
    """First run of four digits in the text -> 1 January of that year."""
    year = F.regexp_substr(_col(c), F.lit(r"\d{4}"))
    return F.try_to_date(F.concat(year, F.lit("-01-01")), "yyyy-MM-dd")


def decode_serial(
    c: Column | str,
    prefixes: tuple[str, ...] = SERIAL_PREFIXES,
    offset: int = SERIAL_OFFSET,
) -> Column:
    """Spreadsheet serial text -> dd/MM/yyyy text, for the listed prefixes only.

    Non-numeric text with a listed prefix becomes NULL.
    """
    c = _col(c)
    n = F.floor(to_number(c))
    in_range = (n >= 0) & (n <= 2_958_465)  # up to 9999-12-31
    decoded = F.date_format(
        F.date_add(_date_lit(SERIAL_EPOCH), F.when(in_range, n - offset).cast("int")),
        "dd/MM/yyyy",
    )
    hit = F.coalesce(F.substring(c, 1, 2).isin(list(prefixes)), F.lit(False))
    return F.when(hit, decoded).otherwise(c)


def trim_ws(c: Column | str) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def pad_day_month(c: Column | str) -> Column:
    """Zero-pad a one-digit day, then a one-digit month.

    The month pad keeps characters 4-9 only, so a trailing time is cut for
    padded rows (and kept for others). Each step reads its input once.
    """
    day = F.regexp_replace(_col(c), r"^([1-9])/", "0$1/")
    return F.regexp_replace(day, r"(?s)^(..)/([1-9])/(.{0,4}).*$", "$1/0$2/$3")


def apply_literal_repairs(c: Column | str, repairs: dict[str, str] = DATE_LITERAL_REPAIRS) -> Column:
    """Replace known hand-typed date texts (one map lookup)."""
    c = _col(c)
    if not repairs:
        return c
    lookup = F.create_map(*[F.lit(x) for kv in repairs.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, c), c)


def normalise_date_text(c: Column | str, repairs: dict[str, str] = DATE_LITERAL_REPAIRS) -> Column:
    """Dots to slashes, trim, pad day and month, fix known literals."""
    dotted = F.replace(_col(c), F.lit("."), F.lit("/"))
    return apply_literal_repairs(pad_day_month(trim_ws(dotted)), repairs)


def parse_dmy(c: Column | str) -> Column:
    """dd/MM/yyyy text -> date; other shapes and impossible dates -> NULL."""
    c = _col(c)
    return F.when(c.rlike(DMY_PATTERN), F.try_to_date(c, "dd/MM/yyyy"))


def year_text(d: Column) -> Column:
    return F.date_format(d, "yyyy")


def clamp_before(d: Column, floor_year: int = FLOOR_YEAR, floor_date=FLOOR_DATE) -> Column:
    """Missing dates and dates before ``floor_year`` -> ``floor_date``."""
    return F.when(d.isNull() | (F.year(d) < floor_year), _date_lit(floor_date)).otherwise(d)


def with_dmy_dates(
    df: DataFrame,
    col: str,
    programme_date: Column | None = None,
    ts_out: str = "TIMESTAMP",
    year_out: str = "YEAR",
    floor_year: int = FLOOR_YEAR,
    floor_date=FLOOR_DATE,
    serial_prefixes: tuple[str, ...] = SERIAL_PREFIXES,
    serial_offset: int = SERIAL_OFFSET,
    repairs: dict[str, str] = DATE_LITERAL_REPAIRS,
) -> DataFrame:
    """Day-first feed dates -> ``ts_out`` and ``year_out``.

    Serial decode -> normalise -> dd/MM/yyyy parse -> programme-year date
    -> year text (taken before the clamp) -> clamp. The repaired text and the parsed date are staged as columns, so each
    expression is evaluated once per row instead of being inlined into
    every later reference.
    """
    text = normalise_date_text(decode_serial(F.col(col).cast("string"), serial_prefixes, serial_offset), repairs)
    staged = df.withColumn("__date_text", text)
    parsed = parse_dmy(F.col("__date_text"))
    if programme_date is not None:
        parsed = F.coalesce(parsed, programme_date)
    staged = staged.withColumn("__date", parsed)
    d = F.col("__date")
    return staged.withColumns({ts_out: clamp_before(d, floor_year, floor_date), year_out: year_text(d)}) \
        .drop("__date_text", "__date")


def with_iso_dates(
    df: DataFrame,
    col: str,
    ts_out: str = "TIMESTAMP",
    year_out: str = "YEAR",
    floor_year: int = FLOOR_YEAR,
    floor_date=FLOOR_DATE,
    repairs: dict[str, str] = DATE_LITERAL_REPAIRS,
) -> DataFrame:
    """ISO feed dates -> ``ts_out`` and ``year_out`` (staged like ``with_dmy_dates``).

    Text that is not ISO-shaped becomes ``floor_date``; ISO-shaped but
    impossible dates stay NULL; years before ``floor_year`` are clamped.
    """
    raw = F.col(col).cast("string")  # a text that is ISO-shaped already needs no repair
    staged = df.withColumn("__date_text", F.when(raw.rlike(ISO_PATTERN), raw).otherwise(normalise_date_text(raw, repairs)))
    t = F.col("__date_text")
    staged = staged.withColumn(
        "__date", F.when(t.rlike(ISO_PATTERN), F.try_to_date(t, "yyyy-MM-dd")).otherwise(_date_lit(floor_date)))
    d = F.col("__date")
    return staged.withColumns({
        ts_out: F.when(F.year(d) < floor_year, _date_lit(floor_date)).otherwise(d),
        year_out: year_text(d),
    }).drop("__date_text", "__date")


def cap_year(d: Column | str, year: int, replacement) -> Column:
    """Dates in a year after ``year`` -> ``replacement`` (NULL stays NULL)."""
    d = _col(d)
    return F.when(F.year(d) > year, _date_lit(replacement)).otherwise(d)


def not_day_first(c: Column | str) -> Column:
    """Text that is not shaped like dd/...: missing, empty, or no slash at 3."""
    c = _col(c)
    return c.isNull() | (c == "") | (F.substring(c, 3, 1) != "/")


def fiscal_label(as_of: _dt.date) -> str:
    """Two-digit previous and current year, e.g. 2025 -> '2425' (zero padded)."""
    return f"{(as_of.year - 1) % 100:02d}{as_of.year % 100:02d}"
