"""Validation checks (V01-V06, V10-V13): each returns rows (system, source, category, value).

Checks read distinct values first (a partial aggregate), then anti-join the master data, so the
work is proportional to the distinct keys, not to the fact."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finding(df: DataFrame, value, source: str, category: str) -> DataFrame:
    return df.select(F.lit(source).alias("source"),
                     F.lit(category).alias("category"), value.cast("string").alias("value"))


def missing_in(df: DataFrame, cols: list[str], dim: DataFrame, dim_cols: list[str], source: str, category: str,
               mapping: DataFrame | None = None, mapping_category: str | None = None) -> DataFrame:
    """V01 value missing in a dimension; V02 missing in the dimension *and* as a mapped child; V03
    composite keys, reported as 'a/b'.  A NULL that the dimension lacks is reported as ''."""
    vals = df.select(*cols).distinct().alias("v")
    d = dim.select(*[F.col(dc).alias(c) for c, dc in zip(cols, dim_cols)]).distinct().alias("d")
    same = reduce(lambda a, b: a & b, [F.col(f"v.{c}").eqNullSafe(F.col(f"d.{c}")) for c in cols])
    out = vals.join(d, same, "left_anti").alias("v")
    if mapping is not None:
        m = mapping.filter(F.col("category") == mapping_category).select(F.col("child").alias("_child")).distinct()
        out = out.join(m, F.col(f"v.{cols[0]}").eqNullSafe(F.col("_child")), "left_anti")
    return _finding(out, F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), source, category)


def invalid_dates(df: DataFrame, col: str, source: str, category: str = "Invalid date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text that is present but is no date."""
    bad = df.select(col).distinct().filter(F.col(col).isNotNull() & F.try_to_date(F.col(col), fmt).isNull())
    return _finding(bad, F.col(col), source, category)


def not_in_list(df: DataFrame, col: str, allowed: list[str], source: str, category: str) -> DataFrame:
    """Value outside a fixed list (NULL passes, as NOT IN on NULL is not true)."""
    bad = df.select(col).distinct().filter(~F.col(col).isin(allowed))
    return _finding(bad, F.col(col), source, category)


def override_without_comment(df: DataFrame, changed, comment_col: str, value_col: str, source: str) -> DataFrame:
    """Rows whose factory was changed while the comment is empty."""
    empty = F.coalesce(F.trim(F.col(comment_col)), F.lit("")) == ""
    return _finding(df.filter(changed & empty).select(value_col).distinct(), F.col(value_col), source, "Override without comment")


def dispatch(categories: list[str], suites: dict[str, list[DataFrame]]) -> list[DataFrame]:
    """The checks of the suites that the categories call for; a category without a suite calls for none."""
    return [check for c in categories for check in suites.get(c, [])]


def run_suite(findings: list[DataFrame], system: str) -> DataFrame:
    """The union of a data-driven list of checks, under a system's name."""
    out = reduce(lambda a, b: a.unionByName(b), findings).distinct()
    return out.select(F.lit(system).alias("system"), *out.columns)


@dataclass(frozen=True)
class Check:
    """One check of a suite: the rows' ``key`` must be in the named reference -- a key that is NULL never is -- or, without
    a reference, the shown values that ``broken`` holds for are findings.  ``shown`` is what a finding reports, NULL as ''."""
    category: str
    shown: Column
    key: Column | None = None
    reference: str | None = None
    broken: Callable[[Column], Column] | None = None


def suite_values(df: DataFrame, source: Column, suites: dict[str, list[Check]]) -> DataFrame:
    """(source, category, reference, key, value): the distinct values that the checks of each row's own source look at, from
    one pass over ``df``; without a reference, only what is broken.

    A column that several checks or suites share is made once a row, and a row's values carry the numbers of their suite and
    check: names are looked up for distinct values.  (Checks spelt out again under each suite make one
    method that is too long for the JVM to compile.)"""
    checks = list({id(c): c for own in suites.values() for c in own}.values())
    texts: dict[int, tuple[str, Column]] = {}

    def text(c):
        return F.lit(None).cast("string") if c is None else F.col(texts.setdefault(id(c), (f"_t{len(texts)}", c))[0])

    def number(names, col):
        return reduce(lambda w, item: w.when(col == item[1], item[0]), list(enumerate(names))[1:], F.when(col == names[0], 0)).cast("byte")

    def name(names, col):
        return F.element_at(F.array(*[F.lit(n).cast("string") for n in names]), col + 1)

    at, check = F.col("_s"), F.col("_c")
    same = [i for i, c in enumerate(checks) if c.key is c.shown]  # the value is the key
    looked = F.array(*[F.when(at.isin([n for n, own in enumerate(suites.values()) if any(c is o for o in own)]), F.struct(
        F.lit(i).cast("byte").alias("_c"), text(c.key).alias("key"), text(None if i in same else c.shown).alias("value"))) for i, c in enumerate(checks)])
    rows = df.select(source.alias("_source"), *[c.cast("string").alias(n) for n, c in texts.values()]).withColumn("_s", number(list(suites), F.col("_source")))
    values = rows.select("_s", F.explode(looked).alias("_v")).filter("_v IS NOT NULL").select("_s", "_v.*").distinct()
    values = values.withColumn("value", F.when(check.isin(same), F.col("key")).otherwise(F.col("value")))
    for i, c in enumerate(checks):
        if c.broken is not None:
            values = values.filter(F.when(check == i, F.coalesce(c.broken(F.col("value")), F.lit(False))).otherwise(True))
    return values.select(name(list(suites), at).alias("source"), name([c.category for c in checks], check).alias("category"),
                         name([c.reference for c in checks], check).alias("reference"), "key", F.coalesce("value", F.lit("")).alias("value"))


def suite_findings(values: list[DataFrame], references: dict[str, DataFrame], system: str) -> DataFrame:
    """The findings of all suites from one join with one long table of (reference, key), which holds each
    reference (a one-column table).  Its keys are hashed in the tasks they are dealt to: sorting both sides by texts takes
    longer than all else here."""
    held = reduce(DataFrame.unionByName, values)
    table = reduce(DataFrame.unionByName, [d.select(F.lit(n).alias("reference"), F.col(d.columns[0]).cast("string").alias("key")) for n, d in references.items()])
    found = held.join(table.hint("shuffle_hash"), ["reference", "key"], "left_anti")
    return found.select(F.lit(system).alias("system"), "source", "category", "value").distinct()
