"""Period keys, week labels and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fathomline.functions.binding import let


def month_key(c: Column) -> Column:
    """yyyy-MM"""
    return F.date_format(c, "yyyy-MM")


def period_int(c: Column) -> Column:
    """year * 100 + month"""
    return F.year(c) * 100 + F.month(c)


def period_minus(period: Column, months: int) -> Column:
    """Month arithmetic on a yyyymm integer."""
    serial = (F.floor(period / 100) * 12 + (period % 100) - 1 - months).cast("int")
    return (F.floor(serial / 12) * 100 + F.pmod(serial, F.lit(12)) + 1).cast("int")


def month_serial(c: Column) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(c) * 12 + F.month(c) - 1


def quarter_key(c: Column) -> Column:
    """yyyy-Qn"""
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def quarter_index(c: Column) -> Column:
    """year * 4 + quarter - 1: consecutive quarters differ by one."""
    return F.year(c) * 4 + F.quarter(c) - 1


def quarter_index_of_text(as_of: Column) -> Column:
    """Quarter index of 'yyyy-Qn' or 'yyyy-MM' text, NULL for anything else."""
    year = F.substring(as_of, 1, 4)
    return (
        F.when(as_of.rlike(r"^\d{4}-Q[1-4]$"), year.cast("int") * 4 + F.substring(as_of, 7, 1).cast("int") - 1)
        .when(
            as_of.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"),
            year.cast("int") * 4 + F.floor((F.substring(as_of, 6, 2).cast("int") - 1) / 3).cast("int"),
        )
    )


def week_start(c: Column) -> Column:
    """Monday of the week, as a date."""
    return F.to_date(F.date_trunc("week", c))


def iso_week(c: Column) -> Column:
    """ISO label yyyy-Www: the year is that of the week's Thursday."""
    thursday = F.date_add(week_start(c), 3)
    return F.concat(F.year(thursday).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(c).cast("string"), 2, "0"))


def iso_to_utc(text: Column, naive_zone: str = "+08:00") -> Column:
    """ISO text to an instant: zoned text as it is, naive text in ``naive_zone``.

    Independent of the session zone; blank text is NULL, malformed text fails.
    """
    t = F.nullif(F.trim(text), F.lit(""))
    zoned = t.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, t).otherwise(F.concat(t, F.lit(naive_zone))).cast("timestamp")


def date_or_null(text: Column) -> Column:
    """First ten characters as yyyy-MM-dd, NULL when blank."""
    return F.to_date(F.nullif(F.trim(text), F.lit("")), "yyyy-MM-dd")


def mail_datetime(text: Column) -> Column:
    """'Monday, March 4, 2024 3:05 PM' or 'yyyy年m月d日 下午 h:mm' as a time stamp
    without zone; the first time counts, anything else is NULL."""
    t = F.regexp_replace(F.trim(text), r"[\s ]+", " ")
    en = r"(?i)(January|February|March|April|May|June|July|August|September|October|November|December)" \
         r" (\d{1,2}), ?(\d{4})(?: (\d{1,2}):(\d{2})(?::\d{2})? ?([AP]M)?)?"
    zh = r"(\d{4})年(\d{1,2})月(\d{1,2})日(?:[^\d]{0,12}?(上午|下午)? ?(\d{1,2}):(\d{2}))?"

    def stamp(y, mo, d, h, mi, half):
        hour = F.coalesce(h.try_cast("int"), F.lit(0))
        hour = F.when((half == "PM") & (hour < 12), hour + 12).when((half == "AM") & (hour == 12), F.lit(0)).otherwise(hour)
        full = F.concat(
            y, F.lit("-"), F.lpad(mo, 2, "0"), F.lit("-"), F.lpad(d, 2, "0"), F.lit(" "),
            F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.when(mi == "", F.lit("00")).otherwise(mi),
        )
        return full.try_cast("timestamp_ntz")

    names = ["january", "february", "march", "april", "may", "june", "july", "august",
             "september", "october", "november", "december"]

    def parsed(t):
        def part(pattern, i):
            return F.regexp_extract(t, pattern, i)

        month = F.array_position(F.array(*[F.lit(n) for n in names]), F.lower(part(en, 1))).cast("string")
        half_zh = F.when(part(zh, 4) == "下午", F.lit("PM")).otherwise(F.lit(""))
        return (
            F.when(t.rlike(en), stamp(part(en, 3), month, part(en, 2), part(en, 4), part(en, 5), F.upper(part(en, 6))))
            .when(t.rlike(zh), stamp(part(zh, 1), part(zh, 2), part(zh, 3), part(zh, 5), part(zh, 6), half_zh))
        )

    return let(F.regexp_replace(F.trim(text), r"[\s\u00a0]+", " "), parsed)


def inferred_date(month: Column, day: Column, anchor: Column) -> Column:
    """Month and day without year: the year of ``anchor``, or the year before
    when that lies more than 7 days after it. Impossible dates are NULL."""
    text = F.concat_ws("-", F.year(anchor).cast("string"), F.lpad(month.cast("string"), 2, "0"),
                       F.lpad(day.cast("string"), 2, "0"))
    guess = text.try_cast("date")
    return F.when(F.datediff(guess, anchor) > 7, F.add_months(guess, -12)).otherwise(guess)


def fiscal_quarter(text: Column, keep_unknown: bool = False) -> Column:
    """'2026Q3', 'FY2026Q3' or 'q3' → 'Q3'; unknown text is NULL, or kept on request."""
    hit = F.upper(F.regexp_extract(text, r"(?i)(Q[1-4])$", 1))
    found = F.nullif(hit, F.lit(""))
    return F.coalesce(found, text) if keep_unknown else found
