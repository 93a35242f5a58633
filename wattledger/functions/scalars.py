"""Scalar rules for text, meters, money, dates and keys, as column expressions that stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,2})?$"


def clean_header(name: str) -> str:
    """A header without byte-order mark, with single spaces."""
    return " ".join(name.replace("\ufeff", "").split())


def clean_text(c: ColumnLike) -> Column:
    """Trimmed text; null becomes the empty string, which is the marker for a missing value."""
    return F.coalesce(F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", ""), F.lit(""))


def safe_text(c: ColumnLike) -> Column:
    """``clean_text``, where the word nan means missing too."""
    text = clean_text(c)
    return F.when(F.lower(text) == "nan", F.lit("")).otherwise(text)


def blank_to_null(c: ColumnLike) -> Column:
    text = clean_text(c)
    return F.when(text != "", text)


def single_spaces(c: ColumnLike) -> Column:
    return clean_text(F.regexp_replace(_c(c), r"(?U)\s+", " "))


def meter_no(c: ColumnLike) -> Column:
    """Upper case without white space. Leading zeros stay: a meter number is text."""
    text = F.coalesce(_c(c).cast("string"), F.lit(""))
    return F.upper(F.when(text.rlike(r"^[A-Za-z0-9]*\z"), text).otherwise(F.regexp_replace(text, r"(?U)\s+", "")))


def raw_meter_no(c: ColumnLike) -> Column:
    """``meter_no`` that also repairs the ``.0`` which spreadsheets put behind a number."""
    text = _c(c).cast("string")
    return F.when(text.rlike(r"^[A-Z0-9]*\z"), text).otherwise(F.regexp_replace(meter_no(c), r"^(\d+)\.0$", "$1"))


def decimal_text(c: ColumnLike) -> Column:
    """Text that reads as a plain or scientific decimal, else null, so that a bad row is rejected and no job fails."""
    text = clean_text(c)
    return F.when(text.rlike(_DECIMAL), text)


def money_cents(c: ColumnLike, drop_every_r: bool = True) -> Column:
    """Rand text to whole cents, half up; null if it is no amount.

    Spaces go. With both separators the comma groups thousands; a comma alone is the decimal sign, so ``1,234`` is
    1.234. Raw exports may hold the currency sign anywhere, staged files only in front.
    """
    given = _c(c).cast("string")
    text = F.regexp_replace(F.coalesce(given, F.lit("")), r"(?U)^\s+|\s+$|[ \u00a0]" + ("|[Rr]" if drop_every_r else ""), "")
    if not drop_every_r:
        text = F.regexp_replace(text, "^[Rr]", "")

    plain = F.when(text.contains("."), F.translate(text, ",", "")).otherwise(F.translate(text, ",", "."))
    # what is no number isn't cast, as each failed cast makes an exception; most amounts are plain and need none of this
    chain = F.round(F.nullif(F.regexp_extract(plain, _DECIMAL, 0), F.lit("")).try_cast("decimal(30,10)") * 100, 0).try_cast("bigint")
    sign = r"[Rr \u00a0]*" if drop_every_r else ""
    bare = F.regexp_extract(given, rf"^{sign}(-?[0-9]{{1,15}}(?:[.,][0-9]{{1,2}})?)\z", 1)
    dotted = F.when(bare.contains(","), F.translate(bare, ",", ".")).otherwise(bare)
    return F.when(bare != "", (dotted.try_cast("decimal(18,2)") * 100).try_cast("bigint")).otherwise(chain)


def cents(c: ColumnLike) -> Column:
    """A numeric rand amount to whole cents, through a decimal so that binary fractions don't show."""
    return F.round(_c(c).cast("decimal(18,4)") * 100, 0).cast("bigint")


def workbook_cents(c: ColumnLike, tolerance: str = "0.000001") -> Column:
    """A workbook amount: blank is 0; null if it is negative or has more than two decimals beyond the tolerance."""
    text = clean_text(c)
    number = decimal_text(text).try_cast("decimal(30,10)")
    near = (number >= 0) & (F.abs(number - F.round(number, 2)) <= F.lit(tolerance).cast("decimal(30,10)"))
    return F.when(text == "", F.lit(0).cast("bigint")).when(near, F.round(number * 100, 0).cast("bigint"))


def workbook_units(c: ColumnLike, tolerance: str = "0.000001") -> Column:
    """Workbook units with one decimal; blank is 0, and anything finer or negative is null."""
    text = clean_text(c)
    number = decimal_text(text).try_cast("decimal(30,10)")
    near = (number >= 0) & (F.abs(number - F.round(number, 1)) <= F.lit(tolerance).cast("decimal(30,10)"))
    return F.when(text == "", F.lit(0).cast("decimal(18,1)")).when(near, F.round(number, 1).cast("decimal(18,1)"))


def strict_int(c: ColumnLike, negative: bool = False) -> Column:
    """Whole-number text to bigint, null for anything else."""
    text = clean_text(c)
    return F.when(text.rlike(r"^-?\d+$" if negative else r"^\d+$"), text.try_cast("bigint"))


def strict_units(c: ColumnLike) -> Column:
    """Text with at most one decimal to decimal(18,1), null for anything else."""
    text = clean_text(c)
    return F.when(text.rlike(r"^\d+(\.\d)?$"), text.try_cast("decimal(18,1)"))


def day_first_time(c: ColumnLike) -> Column:
    """``d/m/Y H:M`` with or without seconds, one or two digits each; null for dates that don't exist."""
    text = clean_text(c)
    # what lacks the signs of the form isn't parsed, as each failure makes an exception
    return F.try_to_timestamp(F.when(text.rlike("/[^/]+/[^:]+:"), text), F.lit("d/M/yyyy H:m[:s]"))


def zoned_time(c: ColumnLike) -> Column:
    """ISO time with a zone, which is mandatory, as an instant."""
    text = clean_text(c)
    return F.when(text.rlike(r"(Z|[+-]\d\d:\d\d)$"), text.try_cast("timestamp"))


def wall_clock_ms(c: ColumnLike) -> Column:
    """Milliseconds since 1970 of a wall-clock time, read as UTC."""
    return F.unix_millis(_c(c).cast("timestamp"))


def iso_text(c: ColumnLike) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss")


def ms_to_iso_z(c: ColumnLike) -> Column:
    return F.date_format(F.timestamp_millis(_c(c)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_ms_agree(iso: ColumnLike, ms: ColumnLike) -> Column:
    """Both are blank or null, or both name the same second."""
    text = clean_text(iso)
    return F.when((text == "") | _c(ms).isNull(), (text == "") & _c(ms).isNull()).otherwise(text == ms_to_iso_z(ms))


def month_of(c: ColumnLike) -> Column:
    return F.date_format(_c(c), "yyyy-MM")


def month_range(first: ColumnLike, last: ColumnLike) -> Column:
    """All months from first to last as an array of ``yyyy-MM``."""
    day = lambda c: F.to_date(F.concat(_c(c), F.lit("-01")))
    return F.transform(F.sequence(day(first), day(last), F.expr("interval 1 month")), lambda d: F.date_format(d, "yyyy-MM"))


def next_month(c: ColumnLike, by: int = 1) -> Column:
    return F.date_format(F.add_months(F.to_date(F.concat(_c(c), F.lit("-01"))), by), "yyyy-MM")


def serial_month(c: ColumnLike) -> Column:
    """Month of a spreadsheet date serial; null outside 20000 to 80000."""
    return F.when(_c(c).between(20000, 80000), F.date_format(F.date_add(F.lit("1899-12-30").cast("date"), _c(c).cast("int")), "yyyy-MM"))


def real_date(c: ColumnLike) -> Column:
    """Date text, blank where it is the 1900 placeholder."""
    text = clean_text(c)
    return F.when(text.startswith("1900-01-01"), F.lit("")).otherwise(text)


def account_no(c: ColumnLike) -> Column:
    """Account text without leading apostrophes, white space and a spreadsheet's ``.0``."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"(?U)^[\s']+|\s+", ""), r"^(\d+)\.0$", "$1")


def parcel_no(c: ColumnLike) -> Column:
    """Parcel number: upper case, no spaces, no ``.0``; a number loses its leading zeros."""
    text = raw_meter_no(c)
    return F.when(text.rlike(r"^\d+$"), F.regexp_replace(text, r"^0+(?=\d)", "")).otherwise(text)


def parcel_key(c: ColumnLike, prefix: str = "") -> Column:
    """Letters and digits only, in upper case; without ``prefix`` if it starts so."""
    text = F.upper(F.regexp_replace(F.coalesce(_c(c), F.lit("")), "[^A-Za-z0-9]", ""))
    return F.regexp_replace(text, f"^{prefix}", "") if prefix else text


def display_name(c: ColumnLike) -> Column:
    """First character of each word upper case, the rest lower; digits and signs as they are."""
    return F.initcap(single_spaces(c))


def name_key(c: ColumnLike) -> Column:
    return F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]", "")


def doc_id(*parts: ColumnLike) -> Column:
    """Deterministic document ids such as ``lm__meter__month``."""
    return F.concat_ws("__", *(_c(p).cast("string") for p in parts))


def content_hash(*parts: ColumnLike) -> Column:
    """SHA-1 of the business key, parts joined by a bar."""
    return F.sha1(F.concat_ws("|", *(_c(p).cast("string") for p in parts)).cast("binary"))


def plain_decimal(c: ColumnLike) -> Column:
    """Decimal as text without trailing zeros, and without a point if it is whole."""
    text = _c(c).cast("string")
    return F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)


def units_text(c: ColumnLike) -> Column:
    return _c(c).cast("decimal(18,1)").cast("string")


def join_distinct(c: ColumnLike) -> Column:
    """The distinct non-blank entries of an array in their order, joined by bars."""
    return F.array_join(F.array_distinct(F.filter(_c(c), lambda x: x.isNotNull() & (x != ""))), "|")


def canonical_json(columns: Sequence[str]) -> Column:
    """Compact JSON of the columns with sorted keys; nulls are written."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def category_bucket(c: ColumnLike) -> Column:
    """CAT1 to CAT8 and NORMAL by how the text begins, else OTHER; MISSING if blank."""
    text = F.upper(clean_text(c))
    return F.when(text == "", "MISSING").when(text.rlike("^CAT[1-8]"), F.substring(text, 1, 4)).when(text.startswith("NORMAL"), "NORMAL").otherwise("OTHER")


def category_valid(c: ColumnLike) -> Column:
    """A category value: two non-blank texts, not of the not-available kind, and a score of at least 0."""
    value = _c(c)
    texts = [value["leakageCategory"], value["riskTier"]]
    named = [(clean_text(t) != "") & ~clean_text(t).startswith("NAv") for t in texts]
    return value.isNotNull() & named[0] & named[1] & F.coalesce(value["riskScore"] >= 0, F.lit(False))


def coordinate_valid(lat: ColumnLike, lng: ColumnLike) -> Column:
    """Finite and in range; null and NaN are not valid."""
    inside = lambda c, most: F.coalesce(~F.isnan(_c(c)) & _c(c).between(-most, most), F.lit(False))
    return inside(lat, 90) & inside(lng, 180)


# fixed values: upper bounds in cents, ids and labels of the spending groups
SPENDING_GROUPS = (
    (9_999, "GR1", "<=99.99"),
    (29_999, "GR2", "100-299.99"),
    (49_999, "GR3", "300-499.99"),
    (99_999, "GR4", "500-999.99"),
    (None, "GR5", ">=1000"),
)


def _by_group(amount: Column, at: int) -> Column:
    out = F.lit(SPENDING_GROUPS[-1][at])
    for bound in reversed(SPENDING_GROUPS[:-1]):
        out = F.when(amount <= bound[0], F.lit(bound[at])).otherwise(out)
    return out


def spending_group(amount_c: ColumnLike) -> Column:
    return _by_group(_c(amount_c), 1)


def spending_label(amount_c: ColumnLike) -> Column:
    return _by_group(_c(amount_c), 2)
