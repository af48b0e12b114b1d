"""Master tables submitted by users (V20-V39): rules as data, one check, and sync or replace.

A rule names what makes a submitted row invalid: a reference it must be found in (an equi-join against the distinct
reference values, so no row is multiplied) or a condition on its own columns.  The verdict is one aggregate over the
submitted rows; only that single row reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import scalar
from .merge import merge3

EMPTY, OK = "Table is empty.", "ok"


@dataclass
class Found:
    """The columns must occur together in ``reference``; text is compared in upper case unless ``exact``.  With ``when``
    the rule holds for those rows only."""

    columns: list[str]
    reference: DataFrame
    exact: bool = False
    when: Column | None = None


@dataclass
class Rules:
    """``key``: no two rows may share it; ``label``: the columns that name an invalid row; ``bad``: conditions on a row's own
    columns that make it invalid (NULL passes, as a comparison with NULL is not true)."""

    key: list[str]
    label: list[str]
    found: list[Found] = field(default_factory=list)
    bad: list[Column] = field(default_factory=list)


def expand_short_names(df: DataFrame, col: str, names: DataFrame) -> DataFrame:
    """V22 first step: a trimmed short name is replaced by the full name (``names``: short, name; one row per short)."""
    n = names.groupBy(F.col("short").alias("_short")).agg(F.max("name").alias("_name"))
    return df.join(n, F.trim(F.col(col)) == F.col("_short"), "left").withColumn(col, F.coalesce("_name", col)).drop("_short", "_name")


def marked(submitted: DataFrame, rules: Rules) -> DataFrame:
    """The submitted rows with ``_bad``."""
    out, bad = submitted, [F.coalesce(c, F.lit(False)) for c in rules.bad]
    for i, f in enumerate(rules.found):
        fold = (lambda c: c) if f.exact else F.upper
        ref = f.reference.select(*[fold(F.col(c).cast("string")).alias(f"_r{i}_{j}") for j, c in enumerate(f.reference.columns)]).distinct()
        ref = ref.withColumn(f"_ok{i}", F.lit(True))
        on = reduce(lambda a, b: a & b, [fold(F.col(c).cast("string")) == F.col(f"_r{i}_{j}") for j, c in enumerate(f.columns)])
        out = out.join(ref, on, "left").drop(*[f"_r{i}_{j}" for j in range(len(f.columns))])
        missing = F.col(f"_ok{i}").isNull()
        bad.append(missing if f.when is None else missing & F.coalesce(f.when, F.lit(False)))
    out = out.withColumn("_bad", reduce(lambda a, b: a | b, bad, F.lit(False)))
    return out.drop(*[f"_ok{i}" for i in range(len(rules.found))])


def verdict(submitted: DataFrame, rules: Rules, duplicates_allowed: bool) -> DataFrame:
    """One row: rows, distinct keys, invalid rows, the first invalid row's label (smallest), and the outcome."""
    label = F.concat_ws(" / ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rules.label])
    key = F.to_json(F.struct(*[F.col(c) for c in rules.key]), {"ignoreNullFields": "false"})
    v = marked(submitted, rules).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"),
        F.count(F.when(F.col("_bad"), 1)).alias("n_bad"), F.min(F.when(F.col("_bad"), label)).alias("first_bad"))
    dup = F.lit(False) if duplicates_allowed else F.col("n_keys") < F.col("n_rows")
    text = (F.when(F.col("n_rows") == 0, EMPTY).when(F.col("n_bad") > 0, F.concat(F.lit("Row "), "first_bad", F.lit(" is invalid.")))
            .when(dup, F.lit(f"Duplicated {'/'.join(rules.key)} combinations.")).otherwise(OK))
    return v.withColumn("outcome", text)


def replace(current: DataFrame, submitted: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(new table, verdict): the submitted rows replace the table, or nothing changes."""
    v = verdict(submitted, rules, duplicates_allowed=False)
    return (submitted if scalar(v.select("outcome"))["outcome"] == OK else current), v


def sync(current: DataFrame, submitted: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(new table with ``action``, verdict): repeated keys are reduced to one row, absent rows are deleted, new ones
    inserted, matching ones updated; an invalid or empty submission changes nothing (action NULL)."""
    v = verdict(submitted, rules, duplicates_allowed=True)
    if scalar(v.select("outcome"))["outcome"] != OK:
        return current.withColumn("action", F.lit(None).cast("string")), v
    rest = [c for c in submitted.columns if c not in rules.key]
    one = submitted.groupBy(*rules.key).agg(F.min(F.struct(*rest)).alias("_r")).select(*rules.key, *[F.col(f"_r.{c}").alias(c) for c in rest])
    return merge3(current, one, rules.key, rest), v


def active_flag(status: Column) -> Column:
    """ACTIVE in any case is 1, INACTIVE 0."""
    return F.when(F.upper(status) == "ACTIVE", 1).otherwise(0)


def configuration_row(config: DataFrame, variables: list[str]) -> DataFrame:
    """The configuration variables as one row (MAX of each variable's value)."""
    return config.agg(*[F.max(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in variables])
