"""Joins and lookups.

Broadcast policy: a ``broadcast()`` hint is only placed on tables whose size is bounded by
construction (region, nation, the calendar, literal tables).  Every other dimension join is left to AQE, which converts a shuffle join to a broadcast at
run time from the measured size and splits skewed partitions (a placeholder key holding a third of
the fact) with its skew-join rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str, str, str, list[str]]], how: str = "left") -> DataFrame:
    """Join ``fact`` to dimensions, each as (dim, fact_fk, dim_key, role, columns); the same
    dimension may appear in several roles, its columns prefixed by the role."""
    out = fact
    for dim, fk, key, role, cols in dims:
        d = dim.select(F.col(key).alias(f"_{role}_key"), *[F.col(c).alias(f"{role}_{c}") for c in cols])
        out = out.join(d, out[fk] == d[f"_{role}_key"], how).drop(f"_{role}_key")
    return out


def resolve(df: DataFrame, lookups: list[tuple[DataFrame, list[tuple[str, str]], str]], out: str,
            placeholder=None, drop_unresolved: bool = False) -> DataFrame:
    """Resolve a key by an ordered list of lookups, first hit wins, else ``placeholder``.

    Each lookup is (table, [(df_col, table_col), ...], id_col).  Lookups by the same columns of ``df`` are one table, with a
    column of hits for each, so the rows meet it once.  ``drop_unresolved`` drops rows that no lookup resolved and no
    placeholder covers (J04's 'drop if neither')."""
    cur = df
    hits = [f"_hit{i}" for i in range(len(lookups))]
    tables: dict[tuple, DataFrame] = {}
    for hit, (tbl, on, id_col) in zip(hits, lookups):
        keys = [f"_k{j}" for j in range(len(on))]
        t = tbl.select(*[F.col(tc).alias(k) for k, (_dc, tc) in zip(keys, on)], F.col(id_col).alias(hit))
        # keys of other types meet the rows apart: a union would cast them
        of = (*[dc for dc, _tc in on], *[t.schema[k].dataType.simpleString() for k in keys])
        tables[of] = tables[of].unionByName(t, allowMissingColumns=True) if of in tables else t
    for i, (of, t) in enumerate(tables.items()):
        on, own = of[:len(of) // 2], [c for c in t.columns if c in hits]
        # one id for each key, so that a key that repeats in the lookup cannot multiply rows
        t = t.groupBy(*[F.col(f"_k{j}").alias(f"_k{i}_{j}") for j in range(len(on))]).agg(*[F.max(c).alias(c) for c in own])
        cond = reduce(lambda a, b: a & b, [cur[dc] == t[f"_k{i}_{j}"] for j, dc in enumerate(on)])
        cur = cur.join(t, cond, "left").drop(*[f"_k{i}_{j}" for j in range(len(on))])
    ph = [F.lit(placeholder)] if placeholder is not None else []
    cur = cur.withColumn(out, F.coalesce(*hits, *ph)).drop(*hits)
    if drop_unresolved:
        cur = cur.filter(F.col(out).isNotNull())
    return cur


def mapped_dimension(dim: DataFrame, mapping: DataFrame, category: str, name_col: str, id_col: str) -> DataFrame:
    """J05 pre-join: child name -> parent's id, for the mapping rows of one category."""
    m = mapping.filter(F.col("category") == category).select("parent", "child")
    return m.join(dim.select(F.col(name_col).alias("parent"), F.col(id_col).alias("mapped_id")), "parent") \
            .select(F.col("child"), "mapped_id")


def dedup_lookup(df: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """MAX(id) GROUP BY key before joining, so the lookup is single-valued."""
    return df.groupBy(*key).agg(F.max(id_col).alias(id_col))


def week_from_text(x) -> Column:
    """Week number from free text: characters from position 3, blanks removed, as INT; a
    non-numeric text gives 0."""
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.replace(F.substring(x, 3, 10), F.lit(" "), F.lit("")).try_cast("int"), F.lit(0))


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` without a partner (LEFT JOIN ... IS NULL, NOT EXISTS, NOT IN
    over a non-null inner column)."""
    return df.join(other, on, "left_anti")


def semi(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with a partner (IN (subquery))."""
    return df.join(other, on, "left_semi")


#: Bands up to which they are broadcast and tested one by one; more of them are joined by blocks.
FEW_BANDS = 64
#: Bits of a block's number below its parent's, and levels of blocks that 64 bits have.
BLOCK_BITS, BLOCK_LEVELS = 4, 16


def _numbered(blocks: Column, level: int) -> Column:
    return F.transform(blocks, lambda x: F.struct(F.lit(level).alias("level"), x.alias("block")))


def band_blocks(bands: DataFrame, lo: str, hi: str) -> DataFrame:
    """``bands`` with (_level, _block): each band as the fewest aligned blocks that cover it exactly, at most thirty of a
    level.  A block of level l holds the numbers whose value shifted right by 4 l bits is its number."""
    out = bands.withColumns({"_a": F.col(lo).cast("long"), "_b": F.col(hi).cast("long")})
    parts = []
    low, high = "_a", "_b"
    for level in range(BLOCK_LEVELS):
        up, down = f"_a{level}", f"_b{level}"
        out = out.withColumns({up: F.shiftright(F.col(low) + (1 << BLOCK_BITS) - 1, BLOCK_BITS), down: F.shiftright(F.col(high) + 1, BLOCK_BITS) - 1})
        none = F.array().cast("array<long>")

        def between(x, y):
            return F.when(x <= y, F.sequence(x, y)).otherwise(none)

        inner = F.col(up) <= F.col(down)  # whole blocks of the next level lie inside
        own = F.when(inner, F.concat(between(F.col(low), F.shiftleft(up, BLOCK_BITS) - 1), between(F.shiftleft(F.col(down) + 1, BLOCK_BITS), F.col(high)))).otherwise(
            between(F.col(low), F.col(high)))
        parts.append(_numbered(own, level))
        # an interval that ended here is empty from now on
        out = out.withColumns({up: F.when(inner, F.col(up)).otherwise(F.lit(1).cast("long")), down: F.when(inner, F.col(down)).otherwise(F.lit(0).cast("long"))})
        low, high = up, down
    out = out.select(*bands.columns, F.explode(F.concat(*parts)).alias("_p"))
    return out.select(*bands.columns, F.col("_p.level").alias("_level"), F.col("_p.block").alias("_block"))


def band_join(df: DataFrame, bands: DataFrame, value_col: str, lo: str = "start_date_id", hi: str = "end_date_id",
              how: str = "inner") -> DataFrame:
    """Membership of a whole number in [lo, hi] bands, of which there may be any number (inner or left).

    A few bands (counted first) are broadcast and tested one by one; more are cut into aligned blocks, and a row meets the
    blocks that hold its value, one for each level in use, by an equality join without hints."""
    if how not in ("inner", "left"):
        raise ValueError("bands join inner or left")
    if bands.count() <= FEW_BANDS:
        b = F.broadcast(bands)
        return df.join(b, (df[value_col] >= b[lo]) & (df[value_col] <= b[hi]), how)
    blocks = band_blocks(bands, lo, hi)
    levels = sorted(r[0] for r in blocks.select("_level").distinct().collect())  # sixteen at most
    value = F.col(value_col).cast("long")
    at = F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright(value, BLOCK_BITS * n).alias("block")) for n in levels])
    rows = df.withColumn("_p", F.explode(at)).withColumns({"_level": F.col("_p.level"), "_block": F.col("_p.block")}).drop("_p")
    found = rows.join(blocks, ["_level", "_block"]).drop("_level", "_block")
    if how == "inner":
        return found
    held = found.select(F.col(value_col).alias("_held")).distinct()
    rest = df.join(held, df[value_col] == held["_held"], "left_anti")
    return found.unionByName(rest, allowMissingColumns=True)


def scalar(one_row: DataFrame) -> dict:
    """A scalar subquery as a variable (SELECT @x = MAX(id) ...): one row of one aggregate is
    fetched and used as a literal, so Catalyst can fold it and push the filter into the scan."""
    row = one_row.first()
    return row.asDict() if row is not None else {c: None for c in one_row.columns}


def correlated_max(df: DataFrame, rules: DataFrame, equal: list[tuple[str, str]], below: tuple[str, str], value: Column,
                   out: str) -> DataFrame:
    """Per row, MAX(value) over the rule rows that equal it in every pair of ``equal`` (column, rule column) and whose
    ``below`` column is less than the row's (column, rule column).

    No row meets the rules one by one: the largest value of each place (equal columns, below column) is summed up first, a
    running maximum over a group's places gives the best of all smaller ones, and rows look up their own place."""
    groups = [f"_g{i}" for i in range(len(equal))]
    rows = df.select([F.col(c).alias(g) for g, (c, _r) in zip(groups, equal)] + [F.col(below[0]).alias("_at")]).distinct()
    places = (rows.withColumn("_v", F.lit(None)).unionByName(
        rules.select(*[F.col(r).alias(g) for g, (_c, r) in zip(groups, equal)], F.col(below[1]).alias("_at"), value.alias("_v")))
        .groupBy(*groups, "_at").agg(F.max("_v").alias("_v")).filter(reduce(lambda a, c: a & c, [F.col(c).isNotNull() for c in (*groups, "_at")])))
    smaller = Window.partitionBy(*groups).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    best = places.select(*groups, "_at", F.max("_v").over(smaller).alias(out)).filter(F.col(out).isNotNull())
    on = reduce(lambda a, c: a & c, [df[c] == best[g] for g, (c, _r) in zip(groups, equal)], df[below[0]] == best["_at"])
    return df.join(best, on, "left").drop(*groups, "_at")


def merge_frames(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str] | None = None,
                 how: str = "inner", agg: dict | None = None, when: str = "after") -> DataFrame:
    """Configurable merge.  Right columns that also exist on the left (other than keys) are
    dropped; ``agg`` ({col: fn}) aggregates by the left keys before or after the join."""
    right_on = right_on or left_on
    if agg and when == "before":
        right = right.groupBy(*right_on).agg(*[getattr(F, fn)(c).alias(c) for c, fn in agg.items()])
    keep = [c for c in right.columns if c not in left.columns or c in right_on]
    r = right.select(*keep)
    if how == "cross":
        raise ValueError("cross merges are not supported: they emit every pair of rows")
    if left_on == right_on:
        out = left.join(r, left_on, how)
    else:
        cond = reduce(lambda a, b: a & b, [left[lc] == r[rc] for lc, rc in zip(left_on, right_on)])
        out = left.join(r, cond, how)
    if agg and when == "after":
        out = out.groupBy(*left_on).agg(*[getattr(F, fn)(c).alias(c) for c, fn in agg.items()])
    return out


def combine(frames: list[DataFrame], how: str = "V", on: list[str] | None = None) -> DataFrame:
    """Fold frames -- 'H' chains joins on ``on``; 'V' unions by column name (headers must match)."""
    if how.upper() == "H":
        return reduce(lambda a, b: merge_frames(a, b, on, how="left"), frames)
    cols = sorted(frames[0].columns)
    for f in frames[1:]:
        if sorted(f.columns) != cols:
            raise ValueError("frames to stack must have the same columns")
    return reduce(lambda a, b: a.unionByName(b), frames)
