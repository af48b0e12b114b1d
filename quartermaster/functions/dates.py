"""Date scalar functions (P10, P12, P22) as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_id(d) -> Column:
    """Surrogate ``yyyymmdd`` integer of a date; range filters on it are date filters."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def from_date_id(i) -> Column:
    i = _c(i)
    return F.make_date((i / 10000).cast("int"), ((i / 100).cast("int") % 100), i % 100)


def week_start(d) -> Column:
    """Sunday on or before ``d`` (weeks run Sunday..Saturday, as in the fiscal calendar)."""
    d = _c(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def month_start(d) -> Column:
    """DATEADD(MONTH, DATEDIFF(MONTH, 0, d), 0): first day of the month."""
    return F.trunc(_c(d), "MM")


def add_days(d, n) -> Column:
    return F.date_add(_c(d), n)


def add_months(d, n) -> Column:
    return F.add_months(_c(d), n)


def add_years(d, n: int) -> Column:
    return F.add_months(_c(d), 12 * n)


def days_between(later, earlier) -> Column:
    """DATEDIFF(day, earlier, later)."""
    return F.datediff(_c(later), _c(earlier))


def weekday_number(d) -> Column:
    """DATEPART(DW, d) with Sunday = 1."""
    return F.dayofweek(_c(d))


def weekday_name(d) -> Column:
    """DATENAME(DW, d)."""
    return F.date_format(_c(d), "EEEE")


def month_end(d) -> Column:
    """EOMONTH(d)."""
    return F.last_day(_c(d))


def is_month_end(d) -> Column:
    d = _c(d)
    return (d == F.last_day(d)).cast("int")


def is_weekend(d) -> Column:
    return F.dayofweek(_c(d)).isin(1, 7).cast("int")


def year_cw(year, week) -> Column:
    """P12: '2017' + 'CW' + '05'."""
    return F.concat(_c(year).cast("string"), F.lit("CW"), F.lpad(_c(week).cast("string"), 2, "0"))


def cw_week(label) -> Column:
    """Week number of a 'yyyyCWnn' label (the right two characters), as int."""
    return F.right(_c(label), F.lit(2)).try_cast("int")


# fixed values: the date text layouts recognised by the loader, in its order, as (name, pattern, groups of year, month
# and day; 0: the first of the month).
DATE_LAYOUTS = [
    ("DATE_US", r"^(0?[1-9]|1[0-2])[/-](0[1-9]|[12][0-9]|3[01]|[1-9])[/-]((?:\d\d){1,2})", (3, 1, 2)),
    ("DATE_EU", r"^(0[1-9]|[12][0-9]|3[01]|[1-9])[./-](0?[1-9]|1[0-2])[./-]((?:\d\d){1,2})", (3, 2, 1)),
    ("DATE_ISO", r"^(\d{4})[./-]?(0?[1-9]|1[0-2])[./-](0[1-9]|[12][0-9]|3[01]|[1-9])", (1, 2, 3)),
    ("MONTH_DATE", r"^(0?[1-9]|1[0-2])[./-]((?:\d\d){1,2})$", (2, 1, 0)),
    ("MONTH_DATE_ISO", r"^(\d{4})[./-]?(0?[1-9]|1[0-2])$", (1, 2, 0)),
]


def parse_layout(x, name: str) -> Column:
    """The date in a text of one layout; month-only texts get day 01, two-digit years count from 2000; a text of
    another layout, or of a day that the month lacks, gives NULL."""
    x = F.trim(_c(x))
    pattern, (y, m, d) = next((p, g) for n, p, g in DATE_LAYOUTS if n == name)
    part = lambda g: F.regexp_extract(x, pattern, g)
    year = F.when(F.length(part(y)) == 2, F.concat(F.lit("20"), part(y))).otherwise(part(y))
    day = part(d) if d else F.lit("01")
    text = F.concat_ws("-", year, F.lpad(part(m), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(x.rlike(pattern), F.try_to_date(text, "yyyy-MM-dd"))


def normalize_date_text(x, layouts: list[str] | None = None) -> Column:
    """The date by the first layout that matches the text (by the given layouts, else all in order)."""
    names = layouts or [n for n, _, _ in DATE_LAYOUTS]
    t = F.trim(_c(x))
    out = None
    for n in names:
        matches = t.rlike(next(p for k, p, _ in DATE_LAYOUTS if k == n))
        out = F.when(matches, parse_layout(x, n)) if out is None else out.when(matches, parse_layout(x, n))
    return out.otherwise(F.lit(None).cast("date"))


def date_format_votes(df, cols):
    """(column, layout, votes): how many non-null values of each column match each layout, in one pass."""
    votes = df.agg(*[F.sum(F.coalesce(F.trim(F.col(c)).rlike(p), F.lit(False)).cast("int")).alias(f"{c}|{n}")
                     for c in cols for n, p, _ in DATE_LAYOUTS])
    pairs = [F.struct(F.lit(c).alias("column"), F.lit(n).alias("layout"), F.coalesce(F.col(f"`{c}|{n}`"), F.lit(0)).alias("votes"))
             for c in cols for n, _, _ in DATE_LAYOUTS]
    return votes.select(F.explode(F.array(*pairs)).alias("v")).select("v.*")
