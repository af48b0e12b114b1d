"""Fiscal 4-4-5 calendar (D01-D06) and calendar lookups.

The fiscal year is a run of Sunday-to-Saturday weeks.  Periods 3, 6, 9 and 12 have five weeks, the
others four.  A counter of "missing days" grows by one per year (two in leap years); when it exceeds
six, the period chosen as the extra-week month gets a fifth week and the counter restarts.  With the
extra month set to a quarter-end period (3/6/9/12) that period already has five weeks, so no 53rd week
is ever added -- the behaviour of the original generator, kept on purpose.

Only the per-year recurrence (one row per fiscal year, a few dozen rows for any real parameter range)
runs on the driver; the weeks and days are generated on the executors with ``sequence``/``explode``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_id

# fixed values: accounting period names, Sunday-first weekday numbering as DATEPART(DW).
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
               "October", "November", "December"]
QUARTER_END_PERIODS = (3, 6, 9, 12)


def _is_leap(y: int) -> bool:
    return (y % 4 == 0 and y % 100 != 0) or y % 400 == 0


def fiscal_start(start: dt.date, first_month: int) -> dt.date:
    """First day of the first fiscal year: the 1st of the fiscal month moved to the nearest Sunday
    (a Sunday five or six days back is replaced by the next one)."""
    year = start.year if start.month >= first_month else start.year - 1
    anchor = dt.date(year, first_month, 1)
    back = (anchor.weekday() + 1) % 7          # days since the previous Sunday (0 on a Sunday)
    if back == 0:
        return anchor
    if back > 4:
        return anchor + dt.timedelta(days=7 - back)
    return anchor - dt.timedelta(days=back)


def fiscal_years(start: dt.date, end: dt.date, first_month: int = 1, extra_week_month: int = 12) -> list[tuple]:
    """The per-year recurrence: (fiscal_year, first_day, n_weeks, has_extra_week, seed_month)."""
    s0 = fiscal_start(start, first_month)
    fy = s0.year
    missing = 2 if _is_leap(fy) else 1
    rows = []
    day = s0
    extra_allowed = 1 <= extra_week_month <= 12 and extra_week_month not in QUARTER_END_PERIODS
    while day <= end:
        extra = 1 if (extra_allowed and missing > 6) else 0
        weeks = 52 + extra
        rows.append((fy, day, weeks, extra, s0.month if not rows else 0))
        day = day + dt.timedelta(days=7 * weeks)
        fy += 1
        missing = (0 if missing >= 7 else missing) + (2 if _is_leap(fy) else 1)
    return rows


def _std_period(w: Column) -> Column:
    q = F.floor((w - 1) / 13).cast("int")
    r = (w - 1) % 13
    return q * 3 + F.when(r < 4, 1).when(r < 8, 2).otherwise(3)


def _season(x: Column, sp: tuple, fa: tuple) -> Column:
    return F.when(x.isin(*sp), "SP").when(x.isin(*fa), "FA").otherwise("HO")


def _season_long(season: Column, year: Column, short_month: Column, roll: tuple) -> Column:
    roll_year = F.when((season == "SP") & short_month.isin(*roll), year + 1).otherwise(year)
    return (F.when(season == "SP", F.concat(F.lit("Spring "), roll_year.cast("string")))
            .when(season == "FA", F.concat(F.lit("Fall "), year.cast("string")))
            .otherwise(F.concat(F.lit("Holiday "), year.cast("string"))))


def fiscal_calendar(spark: SparkSession, start, end, first_month: int = 1, extra_week_month: int = 12) -> DataFrame:
    """One row per day from the first fiscal Sunday to ``end``; id = yyyymmdd."""
    start = dt.date.fromisoformat(str(start)) if not isinstance(start, dt.date) else start
    end = dt.date.fromisoformat(str(end)) if not isinstance(end, dt.date) else end
    rows = fiscal_years(start, end, first_month, extra_week_month)
    schema = T.StructType([
        T.StructField("year_accounting", T.IntegerType()), T.StructField("year_start", T.DateType()),
        T.StructField("n_weeks", T.IntegerType()), T.StructField("extra", T.IntegerType()),
        T.StructField("seed_month", T.IntegerType())])
    years = spark.createDataFrame(rows, schema)
    e = extra_week_month
    end_e = 13 * ((e - 1) // 3) + 4 * ((e - 1) % 3 + 1) if 1 <= e <= 12 else 0
    days = (years
            .withColumn("off", F.explode(F.sequence(F.lit(0), F.col("n_weeks") * 7 - 1)))
            .withColumn("full_date", F.date_add("year_start", F.col("off")))
            .filter(F.col("full_date") <= F.lit(end))
            .withColumn("week", (F.col("off") / 7).cast("int") + 1))
    w = F.col("week")
    period = (F.when((F.col("extra") == 1) & (w == end_e + 1), F.lit(e))
              .when((F.col("extra") == 1) & (w > end_e + 1), _std_period(w - 1))
              .otherwise(_std_period(w)))
    days = days.withColumn("period", period)
    # the generator's first week takes its seasons from the calendar month of its first day
    basis = F.when((F.col("seed_month") > 0) & (w == 1), F.col("seed_month")).otherwise(F.col("period"))
    p = F.col("period")
    fy = F.col("year_accounting")
    d = F.col("full_date")
    month_name = F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), p)
    out = days.select(
        date_id(d).alias("id"), d.alias("full_date"),
        _season(basis, (9, 10, 11, 12, 1), (2, 3, 4, 5)).alias("season_buy"),
        _season(basis, (11, 12, 1, 2, 3), (4, 5, 6, 7)).alias("season_crd"),
        _season(basis, (1, 2, 3, 4, 5), (6, 7, 8, 9)).alias("season_intro"),
        fy.alias("year_accounting"), w.alias("week_accounting"), p.alias("period_accounting"),
        F.concat(fy.cast("string"), F.lit("CW"), F.lpad(w.cast("string"), 2, "0")).alias("year_cw_accounting"),
        F.concat(fy.cast("string"), F.lit("-"), F.lpad(p.cast("string"), 2, "0")).alias("year_month_accounting"),
        month_name.alias("month_name_accounting"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name_of_week"),
        (d == F.last_day(d)).cast("int").alias("is_last_day_of_month"),
        F.dayofweek(d).isin(1, 7).cast("int").alias("is_weekend_day"),
    )
    short = F.substring("month_name_accounting", 1, 3)
    p = F.col("period_accounting")
    fy = F.col("year_accounting")
    yy = lambda extra: F.substring((fy + extra).cast("string"), 3, 2)
    out = out.select(
        "*",
        F.concat("season_buy", yy(F.when(p.isin(9, 10, 11, 12), 1).otherwise(0))).alias("season_year_short_buy"),
        F.concat("season_crd", yy(F.when(p.isin(11, 12), 1).otherwise(0))).alias("season_year_short_crd"),
        F.concat("season_intro", yy(F.lit(0))).alias("season_year_short_intro"),
        short.alias("month_name_short_accounting"),
        _season_long(F.col("season_buy"), fy, short, ("Sep", "Oct", "Nov", "Dec")).alias("season_year_buy"),
        _season_long(F.col("season_crd"), fy, short, ("Nov", "Dec")).alias("season_year_crd"),
        _season_long(F.col("season_intro"), fy, short, ()).alias("season_year_intro"),
    )
    return out


def minus_periods(year_month: Column, n: int) -> Column:
    """Accounting month 'yyyy-MM' minus ``n`` periods, wrapping the year."""
    y = F.substring(year_month, 1, 4).cast("int")
    m = F.substring(year_month, 6, 2).cast("int")
    idx = y * 12 + (m - 1) - n
    return F.concat(F.floor(idx / 12).cast("int").cast("string"), F.lit("-"),
                    F.lpad((idx % 12 + 1).cast("string"), 2, "0"))


def period_start(calendar: DataFrame, period_col: str, out: str = "period_start_id") -> DataFrame:
    """First day id of every period (MIN(id) GROUP BY period) -- one row per period."""
    return calendar.groupBy(period_col).agg(F.min("id").alias(out))
