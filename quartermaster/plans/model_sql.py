"""The model of ``model.py`` restated as SQL common table expressions (DuckDB dialect).

``sql(body, *needs)`` assembles ``WITH RECURSIVE <ctes> <body>`` with every CTE the body needs, in
dependency order.  These texts are the independent twin the driver checks our Spark results against.
"""

from __future__ import annotations

from .model import (CAL_END, CAL_EXTRA_MONTH, CAL_FIRST_MONTH, CAL_START, BUYING_PROGRAMS, CHINA_NATIONS, DEMAND_CATEGORIES, FACTORY_CODES, SOLD_TO_PARTIES,
                    VIETNAM_NATIONS)



def date_id(e: str) -> str:
    return f"CAST(year({e}) * 10000 + month({e}) * 100 + day({e}) AS INTEGER)"


def week_start(e: str) -> str:
    return f"(CAST({e} AS DATE) - CAST(dayofweek({e}) AS INTEGER))"


def pad(e: str, width: int) -> str:
    t = f"CAST({e} AS VARCHAR)"
    return f"CASE WHEN length({t}) < {width} THEN lpad({t}, {width}, '0') ELSE {t} END"


def _lst(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _in(xs) -> str:
    return "(" + ", ".join(str(x) for x in xs) + ")"


def _case(expr: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], text: str) -> None:
    CTES[name] = (needs, text)


cte("product", (), f"""
SELECT p_partkey AS dim_product_id,
       'VN' || ({pad('p_partkey', 8)}) AS material_id,
       p_brand AS style_id, p_name AS style_name, p_type AS construction_type,
       CASE WHEN p_size % 5 = 0 THEN 'Flex' ELSE 'Standard' END AS style_complexity,
       CASE WHEN starts_with(p_name, 'old') THEN 'vault ' || p_name
            WHEN starts_with(p_name, 'new') THEN 'arcad ' || p_name ELSE p_name END AS cat_sub_sbu,
       CAST(p_partkey % 7 = 0 AS INTEGER) AS clk_mtl,
       CAST(p_partkey % 11 = 0 AS INTEGER) AS dtp_mtl,
       CAST(p_partkey % 13 = 0 AS INTEGER) AS sjd_mtl,
       CAST(p_partkey % 3 = 0 AS INTEGER) AS qt_mtl,
       p_size * 3 AS production_lt, p_retailprice AS fob
FROM part""")

cte("factory", (), f"""
SELECT s_suppkey AS dim_factory_id,
       CASE WHEN s_suppkey < {len(FACTORY_CODES)} THEN ({_lst(FACTORY_CODES)})[s_suppkey + 1] ELSE s_name END AS short_name,
       CASE WHEN s_nationkey IN {_in(CHINA_NATIONS)} THEN 'CN' WHEN s_nationkey IN {_in(VIETNAM_NATIONS)} THEN 'VN'
            ELSE 'N' || CAST(s_nationkey AS VARCHAR) END AS country_code,
       s_nationkey AS allocation_group,
       'VG' || CAST(s_suppkey % 5 AS VARCHAR) AS vendor_group,
       CASE WHEN s_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
       CASE WHEN r_name = 'AMERICA' THEN CASE WHEN s_nationkey % 2 = 0 THEN 'NORA' ELSE 'CASA' END
            WHEN r_name IN ('EUROPE', 'MIDDLE EAST') THEN 'EMEA' WHEN r_name = 'ASIA' THEN 'APAC' ELSE 'CASA' END AS factory_region
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")

_party = " ".join(f"WHEN '{reg}' THEN ({_lst(names)})[CAST(c_custkey % 8 AS INTEGER) + 1]"
                  for reg, names in SOLD_TO_PARTIES.items())
cte("customer", (), f"""
SELECT c_custkey AS dim_customer_id, c_name AS customer_name, region, c_nationkey AS dim_location_id,
       CASE c_mktsegment WHEN 'FURNITURE' THEN 'Direct+International' WHEN 'HOUSEHOLD' THEN 'Crossdock' ELSE 'DC' END AS sold_to_category,
       CASE region {_party} END AS sold_to_party,
       c_mktsegment AS market
FROM (SELECT c.*, CASE WHEN r_name = 'AMERICA' THEN CASE WHEN c_nationkey % 2 = 0 THEN 'NORA' ELSE 'CASA' END
                       WHEN r_name IN ('EUROPE', 'MIDDLE EAST') THEN 'EMEA'
                       WHEN r_name = 'ASIA' THEN 'APAC' ELSE 'CASA' END AS region
      FROM customer c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) x""")

cte("demand", (), f"""
SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS dim_release_id,
       make_date(year(o_orderdate), month(o_orderdate), 1) AS release_date,
       {_case('o_orderstatus', DEMAND_CATEGORIES, "'Order'")} AS demand_category,
       {_case('substr(o_orderpriority, 1, 1)', BUYING_PROGRAMS, 'NULL')} AS buying_program,
       l_orderkey AS order_id, l_linenumber AS line_id, l_partkey AS dim_product_id,
       o_custkey AS dim_customer_id, l_suppkey AS dim_factory_id_original,
       {date_id('l_shipdate')} AS dim_date_id, CAST(l_shipdate AS DATE) AS demand_date,
       CAST(l_quantity AS BIGINT) AS quantity,
       CAST(l_returnflag = 'R' AS INTEGER) AS is_edited,
       l_linestatus AS line_status, l_extendedprice AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

cte("priority", (), """
SELECT l_partkey AS dim_product_id, min(l_suppkey) AS dim_factory_id_1,
       CASE WHEN min(l_suppkey) = max(l_suppkey) OR l_partkey % 4 = 0 THEN CAST(NULL AS BIGINT)
            ELSE max(l_suppkey) END AS dim_factory_id_2
FROM lineitem GROUP BY l_partkey""")

cte("capacity", ("demand", "product"), f"""
SELECT dim_factory_id, week_date_id, construction_type,
       CAST(((dim_factory_id * 37 + week_date_id % 997 + length(construction_type) * 11) % 40) * 5 AS BIGINT)
           AS capacity_available_weekly
FROM (SELECT DISTINCT d.dim_factory_id_original AS dim_factory_id,
             {date_id(week_start('d.demand_date'))} AS week_date_id, p.construction_type
      FROM demand d JOIN product p ON d.dim_product_id = p.dim_product_id) k
WHERE (dim_factory_id + week_date_id) % 13 <> 0""")


cte("fty_qt", (), f"""
SELECT 'VN' || ({pad('p_partkey', 8)}) AS material_id,
       ({_lst(FACTORY_CODES)})[CAST(p_partkey % {len(FACTORY_CODES)} AS INTEGER) + 1] AS factory_short_name
FROM part WHERE p_partkey % 3 = 0""")

cte("retail_qt", ("demand", "customer"), f"""
SELECT DISTINCT 'VN' || ({pad('d.dim_product_id', 8)}) AS material_id, c.region, c.sold_to_party,
       ({_lst(FACTORY_CODES)})[CAST((d.dim_product_id + c.dim_location_id) % {len(FACTORY_CODES)} AS INTEGER) + 1] AS factory_short_name
FROM demand d JOIN customer c USING (dim_customer_id)
WHERE d.buying_program = 'Retail Quick Turn' AND d.dim_product_id % 3 = 0""")


def _leap(y: str) -> str:
    return f"(({y}) % 4 = 0 AND ({y}) % 100 <> 0 OR ({y}) % 400 = 0)"


def calendar_ctes(start=CAL_START, end=CAL_END, first_month=CAL_FIRST_MONTH, extra=CAL_EXTRA_MONTH) -> None:
    ok_extra = "TRUE" if (1 <= extra <= 12 and extra not in (3, 6, 9, 12)) else "FALSE"
    end_e = 13 * ((extra - 1) // 3) + 4 * ((extra - 1) % 3 + 1) if 1 <= extra <= 12 else 0
    cte("cal_bounds", (), f"""
SELECT CASE WHEN lo <= DATE '{start}' THEN make_date(year(lo) - 1, 1, 1) ELSE DATE '{start}' END AS lo,
       CASE WHEN hi >= make_date(year(DATE '{end}'), 12, 31) THEN make_date(year(hi) + 1, 12, 31) ELSE DATE '{end}' END AS hi
FROM (SELECT least((SELECT min(l_shipdate) FROM lineitem), (SELECT min(o_orderdate) FROM orders)) AS lo,
             greatest((SELECT max(l_shipdate) FROM lineitem), (SELECT max(o_orderdate) FROM orders)) AS hi) x""")
    cte("cal_start", ("cal_bounds",), f"""
SELECT CASE WHEN dayofweek(a) = 0 THEN a WHEN dayofweek(a) > 4 THEN a + CAST(7 - dayofweek(a) AS INTEGER) ELSE a - CAST(dayofweek(a) AS INTEGER) END AS s0
FROM (SELECT make_date(CASE WHEN month(lo) >= {first_month} THEN year(lo) ELSE year(lo) - 1 END, {first_month}, 1) AS a
      FROM cal_bounds) t""")
    cte("cal_years", ("cal_bounds", "cal_start"), f"""
SELECT 0 AS k, year(s0) AS fy, s0 AS ys, c0 AS c,
       CASE WHEN {ok_extra} AND c0 > 6 THEN 1 ELSE 0 END AS ex, month(s0) AS seed_month
FROM (SELECT s0, CASE WHEN {_leap('year(s0)')} THEN 2 ELSE 1 END AS c0 FROM cal_start) z
UNION ALL
SELECT k + 1, fy + 1, ys + CAST(7 * (52 + ex) AS INTEGER), cn, CASE WHEN {ok_extra} AND cn > 6 THEN 1 ELSE 0 END, 0
FROM (SELECT *, (CASE WHEN c >= 7 THEN 0 ELSE c END) + (CASE WHEN {_leap('fy + 1')} THEN 2 ELSE 1 END) AS cn
      FROM cal_years) r
WHERE ys + CAST(7 * (52 + ex) AS INTEGER) <= (SELECT hi FROM cal_bounds)""")
    std = lambda w: f"(((({w}) - 1) // 13) * 3 + CASE WHEN (({w}) - 1) % 13 < 4 THEN 1 WHEN (({w}) - 1) % 13 < 8 THEN 2 ELSE 3 END)"
    cte("cal_days", ("cal_years",), f"""
SELECT fy, seed_month, d AS full_date, w,
       CASE WHEN ex = 1 AND w = {end_e + 1} THEN {extra} WHEN ex = 1 AND w > {end_e + 1} THEN {std('w - 1')}
            ELSE {std('w')} END AS p
FROM (SELECT y.*, CAST(y.ys + CAST(o.off AS INTEGER) AS DATE) AS d, CAST(o.off // 7 + 1 AS INTEGER) AS w
      FROM cal_years y CROSS JOIN range(0, 371) o(off)
      WHERE o.off < 7 * (52 + y.ex) AND y.ys + CAST(o.off AS INTEGER) <= (SELECT hi FROM cal_bounds)) q""")
    season = lambda x, sp, fa: f"CASE WHEN {x} IN {_in(sp)} THEN 'SP' WHEN {x} IN {_in(fa)} THEN 'FA' ELSE 'HO' END"
    basis = "CASE WHEN seed_month > 0 AND w = 1 THEN seed_month ELSE p END"
    months = _lst(["January", "February", "March", "April", "May", "June", "July", "August", "September",
                   "October", "November", "December"])
    cte("calendar0", ("cal_days",), f"""
SELECT {date_id('full_date')} AS id, full_date,
       {season(basis, (9, 10, 11, 12, 1), (2, 3, 4, 5))} AS season_buy,
       {season(basis, (11, 12, 1, 2, 3), (4, 5, 6, 7))} AS season_crd,
       {season(basis, (1, 2, 3, 4, 5), (6, 7, 8, 9))} AS season_intro,
       fy AS year_accounting, w AS week_accounting, p AS period_accounting,
       CAST(fy AS VARCHAR) || 'CW' || lpad(CAST(w AS VARCHAR), 2, '0') AS year_cw_accounting,
       CAST(fy AS VARCHAR) || '-' || lpad(CAST(p AS VARCHAR), 2, '0') AS year_month_accounting,
       ({months})[p] AS month_name_accounting,
       CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
       dayname(full_date) AS day_name_of_week,
       CAST(full_date = last_day(full_date) AS INTEGER) AS is_last_day_of_month,
       CAST(dayofweek(full_date) IN (0, 6) AS INTEGER) AS is_weekend_day
FROM cal_days""")

    def long(season_col, rolls):
        roll = f"CASE WHEN {season_col} = 'SP' AND substr(month_name_accounting, 1, 3) IN ({', '.join(repr(r) for r in rolls)}) THEN year_accounting + 1 ELSE year_accounting END" if rolls else "year_accounting"
        return (f"CASE WHEN {season_col} = 'SP' THEN 'Spring ' || CAST({roll} AS VARCHAR) "
                f"WHEN {season_col} = 'FA' THEN 'Fall ' || CAST(year_accounting AS VARCHAR) "
                f"ELSE 'Holiday ' || CAST(year_accounting AS VARCHAR) END")
    cte("calendar", ("calendar0",), f"""
SELECT *,
       season_buy || substr(CAST(year_accounting + CASE WHEN period_accounting IN (9, 10, 11, 12) THEN 1 ELSE 0 END AS VARCHAR), 3, 2) AS season_year_short_buy,
       season_crd || substr(CAST(year_accounting + CASE WHEN period_accounting IN (11, 12) THEN 1 ELSE 0 END AS VARCHAR), 3, 2) AS season_year_short_crd,
       season_intro || substr(CAST(year_accounting AS VARCHAR), 3, 2) AS season_year_short_intro,
       substr(month_name_accounting, 1, 3) AS month_name_short_accounting,
       {long('season_buy', ['Sep', 'Oct', 'Nov', 'Dec'])} AS season_year_buy,
       {long('season_crd', ['Nov', 'Dec'])} AS season_year_crd,
       {long('season_intro', [])} AS season_year_intro
FROM calendar0""")


calendar_ctes()


def sql(body: str, *needs: str, local: tuple[tuple[str, str], ...] = ()) -> str:
    """Assemble a full query: every CTE in ``needs`` (and their own needs), then the query's own
    ``local`` CTEs, before ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in needs:
        visit(n)
    items = [(n, CTES[n][1]) for n in order] + list(local)
    if not items:
        return body.strip()
    # the query's own CTEs feed one another several times: each is computed once
    own = {n for n, _ in local}
    parts = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in own else ''}({t.strip()})" for n, t in items)
    return f"WITH RECURSIVE {parts}\n{body.strip()}"
