"""Queries for the allocation flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import allocate, rules
from ..session import materialize
from .model import Model
from .model_sql import sql
from .registry import query

OUT_COLS = ["order_id", "line_id", "dim_product_id", "dim_customer_id", "dim_date_id", "demand_category",
            "buying_program", "quantity", "dim_factory_id_original_unconstrained", "allocation_logic_unconstrained",
            "component_factory_short_name"]


DECIDED = ["dim_factory_id_original_unconstrained", "allocation_logic_unconstrained", "component_factory_short_name"]


def _features(m, lines, retail_qt, any_vendor=False):
    """The features of ``lines``, whose orders met the customers first."""
    return allocate.allocation_features(lines, m.product, None, m.factory, m.priority, m.fty_qt, retail_qt, any_vendor)


def _with_customers(m):
    return m.demand_with(allocate.customer_features(m.customer))


def unconstrained(spark, sf_dir):
    """Candidates are given features and routed; the other lines keep their factory."""
    m = Model(spark, sf_dir)
    which = F.coalesce(allocate.is_candidate(), F.lit(False))
    routed = allocate.allocate_unconstrained(_features(m, _with_customers(m).filter(which), m.retail_qt))
    cols = [*m.demand.columns, *DECIDED]
    return routed.select(cols).unionByName(allocate.keep_loaded(m.demand.filter(~which)).select(cols))


def x_allocate_unconstrained(spark, sf_dir):
    """Routing tree and rules for every demand line (factory, log, component)."""
    return unconstrained(spark, sf_dir).select(*OUT_COLS)


def _codes_sql() -> str:
    return ", ".join(f"(SELECT max(CASE WHEN short_name = '{c}' THEN dim_factory_id END) FROM factory) AS {k}"
                     for k, c in allocate.CODE_COLUMNS.items())


FEATURES_SQL = f"""
SELECT d.*, p.material_id, p.style_complexity, p.construction_type,
       coalesce(p.clk_mtl, 0) AS clk, coalesce(p.dtp_mtl, 0) AS dtp, coalesce(p.sjd_mtl, 0) AS sjd,
       c.region, c.sold_to_party AS party, c.sold_to_category, c.sold_to_party AS cust_name,
       f1.dim_factory_id AS p1_id, f1.short_name AS p1, f1.country_code AS c1,
       f2.dim_factory_id AS p2_id, f2.short_name AS p2, f2.country_code AS c2,
       qt.qt_vendor, fq.dim_factory_id AS qt_vendor_id, rq.rqt_vendor, fr.dim_factory_id AS rqt_vendor_id,
       d.buying_program AS program, CAST(date_diff('day', d.release_date, d.demand_date) AS INTEGER) AS lead,
       p.style_complexity ILIKE '%Flex%' AS flex,
       CAST(f1.short_name IS NOT NULL AS INTEGER) + CAST(f2.short_name IS NOT NULL AS INTEGER) AS n_src,
       (CAST(f1.short_name IS NOT NULL AS INTEGER) + CAST(f2.short_name IS NOT NULL AS INTEGER)) = 1
         AND coalesce(p.clk_mtl, 0) + coalesce(p.dtp_mtl, 0) + coalesce(p.sjd_mtl, 0) <= 1 AS single,
       {_codes_sql()}
FROM demand d
LEFT JOIN product p USING (dim_product_id)
LEFT JOIN customer c USING (dim_customer_id)
LEFT JOIN priority pr USING (dim_product_id)
LEFT JOIN factory f1 ON pr.dim_factory_id_1 = f1.dim_factory_id
LEFT JOIN factory f2 ON pr.dim_factory_id_2 = f2.dim_factory_id
LEFT JOIN (SELECT material_id, max(factory_short_name) AS qt_vendor FROM fty_qt GROUP BY 1) qt ON qt.material_id = p.material_id
LEFT JOIN factory fq ON fq.short_name = qt.qt_vendor
LEFT JOIN (SELECT material_id, region, sold_to_party, max(factory_short_name) AS rqt_vendor FROM retail_qt GROUP BY 1, 2, 3) rq
       ON rq.material_id = p.material_id AND rq.region = c.region AND rq.sold_to_party = c.sold_to_party
LEFT JOIN factory fr ON fr.short_name = rq.rqt_vendor"""


def unconstrained_ctes() -> tuple[tuple[str, str], ...]:
    steps, (fid, log, comp) = rules.decision_steps("duckdb")
    ctes = [("af0", FEATURES_SQL),
            ("af1", """SELECT *, demand_category IN ('Forecast', 'Need to Buy')
                          AND dim_date_id >= year(release_date) * 10000 + month(release_date) * 100 + 1
                          AND is_edited = 0 AS _cand FROM af0""")]
    late = ("_apps", "_last_rule", "_last_k", "_found_rule")
    ctes.append(("as0", "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in steps if n not in late) + " FROM af1"))
    ctes.append(("as1", "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in steps if n in late) + " FROM as0"))
    prev = "as1"
    ctes.append(("unconstrained", f"""
SELECT *, CASE WHEN _cand THEN coalesce({fid}, {allocate.PLACEHOLDER_FACTORY}) ELSE dim_factory_id_original END
              AS dim_factory_id_original_unconstrained,
          CASE WHEN _cand THEN {log} END AS allocation_logic_unconstrained,
          CASE WHEN _cand THEN {comp} END AS component_factory_short_name
FROM {prev}"""))
    return tuple(ctes)


ALLOC_NEEDS = ("demand", "product", "customer", "factory", "priority", "fty_qt", "retail_qt")

query("x_allocate_unconstrained", sql(f"SELECT {', '.join(OUT_COLS)} FROM unconstrained", *ALLOC_NEEDS,
                                      local=unconstrained_ctes()))(x_allocate_unconstrained)


def x_allocation_summary(spark, sf_dir):
    """X08 write-back effect: lines and quantity per (category, program, decided factory, moved?)."""
    u = unconstrained(spark, sf_dir)
    return (u.groupBy("demand_category", "buying_program", "dim_factory_id_original_unconstrained",
                      (F.col("dim_factory_id_original_unconstrained") != F.col("dim_factory_id_original")).alias("moved"))
             .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity")))


query("x_allocation_summary", sql("""
SELECT demand_category, buying_program, dim_factory_id_original_unconstrained,
       dim_factory_id_original_unconstrained <> dim_factory_id_original AS moved,
       count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS quantity
FROM unconstrained GROUP BY 1, 2, 3, 4""", *ALLOC_NEEDS, local=unconstrained_ctes()))(x_allocation_summary)


CONSTRAINED_OUT = ["order_id", "line_id", "dim_product_id", "dim_customer_id", "dim_date_id", "demand_category",
                   "buying_program", "quantity", "dim_factory_id_original_unconstrained",
                   "dim_factory_id_original_constrained", "allocation_logic_constrained", "dim_factory_id"]


#: What the constrained pass writes back to, without the program's second name.
WRITTEN_BACK = [*(c for c in OUT_COLS[:-2] if c != "buying_program"), "program", "material_id"]
UNIT_INPUT = [*WRITTEN_BACK, "style_complexity", "construction_type", "any_rqt_vendor", "any_rqt_vendor_id",
              *[a for a in allocate.UNIT_ATTRS if a not in ("rqt_vendor", "rqt_vendor_id")]]
#: What the two passes read of a line.
LINE_INPUT = [*OUT_COLS[:-3], "dim_factory_id_original", "is_edited", "release_date", "demand_date", "region", "party", "sold_to_category"]


def _open_lines(m, lines, retail_qt):
    """The open ones of ``lines`` with what the constrained pass reads of them, written once: units, fill and write-back read them."""
    # of the open lines, those never edited are the candidates: their dates need not travel
    feats = _features(m, lines.filter(F.coalesce(allocate.is_open(), F.lit(False))), retail_qt, any_vendor=True)
    return materialize(allocate.allocate_unconstrained(feats, F.col("is_edited") == 0).select(*UNIT_INPUT), "open-lines", allocate.SCRATCH_CODEC)


def x_allocate_constrained(spark, sf_dir):
    """Capacity-constrained pass (loop 1) over the unconstrained result.

    The lines meet their orders once and are written: the quick-turn helper, the open lines and the others read them."""
    m = Model(spark, sf_dir)
    lines = materialize(_with_customers(m).select(*LINE_INPUT), "lines", allocate.SCRATCH_CODEC)
    rest = allocate.keep_loaded(lines.filter(~F.coalesce(allocate.is_open(), F.lit(False)))).withColumnRenamed("buying_program", "program")
    shares = F.coalesce(F.col("demand_category").isin(allocate.OPEN_CATEGORIES), F.lit(False))
    closed = rest.filter(shares).join(m.product.select("dim_product_id", "material_id"), "dim_product_id", "left").select(*WRITTEN_BACK)
    done = allocate.allocate_constrained(_open_lines(m, lines, m.retail_qt_of(lines)), closed, m.factory, m.capacity, m.calendar)
    done = done.unionByName(allocate.keep_unconstrained(rest.filter(~shares)), allowMissingColumns=True)
    return done.withColumnRenamed("program", "buying_program").select(*CONSTRAINED_OUT)


def x_constrained_loops(spark, sf_dir):
    """X32-X41 in five loops: the log and factory of every write-back key."""
    m = Model(spark, sf_dir)
    units, load = allocate.demand_units(_open_lines(m, _with_customers(m), m.retail_qt), m.factory, m.capacity, m.calendar)
    return allocate.constrained_state(units, load, max_loop=5).select(
        *allocate.WRITE_KEYS, F.col("_carried").alias("allocation_logic"), F.col("_moved").alias("moved_to"))


def _parties(names) -> str:
    return "party IN (" + ", ".join(f"'{n}'" for n in names) + ")"


_N, _B = "' => Non-duty Beneficial: ' || party", "' => Duty Beneficial: ' || party"
_CLK1, _REST1 = _parties(rules.NON_DUTY_CLK), _parties(rules.NON_DUTY_OTHERS)
_CHILE_CHINA, _EU = _parties(["Chile DC", "China DC"]), _parties(["EU DC", "EU Crossdock"])
_ASIA2 = _parties(["India DC", "Canada DC", "Canada Direct", "Korea DC"])
_D2 = "' => Dual Source => 2nd priority => ' || p2"
_D1 = "' => Dual Source => 2nd priority => Not found => 1st priority => ' || p1"
_D0 = "' => Dual Source => 2nd priority => Not found => 1st priority => Not found => ' || fname"


def _others1(parties: str) -> list[tuple]:
    """Loop 1 of DTC, FSC, HSC and ICC."""
    return [(1, f"{parties} AND flex", "id_sjv", f"{_N} || ' => Flex => SJV'"),
            (1, f"{parties} AND dual AND p2 IS NOT NULL", "p2_id", f"{_N} || ' => Not Flex' || {_D2}"),
            (1, f"{parties} AND dual AND p1 IS NOT NULL", "p1_id", f"{_N} || ' => Not Flex' || {_D1}"),
            (1, f"{parties} AND dual", None, f"{_N} || ' => Not Flex' || {_D0}"),
            (1, parties, None, f"{_N} || ' => Not Flex => ' || fname"), (1, "TRUE", None, "''")]


def _sjv_sql(loop: int, parties: str, kind: str, flex: list[tuple]) -> list[tuple]:
    """SJV in one loop: what the quick turn set stands unless the sources set something."""
    own = [(c, f, f"{kind} || q_log || {x}") for c, f, x in (*flex, ("NOT flex AND p1 IS NOT NULL", "p1_id", "' => Not Flex => 1st priority => ' || p1"),
                                                             ("NOT flex", "NULL", "' => Not Flex => 1st priority'"))]
    return [(loop, f"{parties} AND {c}", f, x) for c, f, x in own] + [(loop, "TRUE", None, "''")]


_FLEX2 = [("flex AND p1 = 'SJV'", "id_hsc", "' => 1st priority = SJV => HSC => Flex => SJV'"),
          ("flex AND p1 IS NOT NULL", "p1_id", "' => 1st priority = not SJV => 1st priority => ' || p1 || ' => Flex => SJV'"),
          ("flex", "NULL", "' => 1st priority = not SJV => 1st priority => Flex => SJV'")]
_FLEX34 = [("flex AND p2 IS NOT NULL", "p2_id", f"' => Flex' || {_D2}"), ("flex AND p1 IS NOT NULL", "p1_id", f"' => Flex' || {_D1}"),
           ("flex", "Q", f"' => Flex' || {_D0}")]

#: The constrained rules leaf by leaf, written from the procedures for the twin: factory -> (loop, condition, target, log),
#: the first that holds; target None keeps the factory, Q takes the quick-turn vendor's if its region has one.
LEAVES = {
    "CLK": [
        (1, f"{_CLK1} AND dual AND p2 IS NOT NULL", "p2_id", f"{_N} || ' => Dual Source => 2nd priority' || p2"),
        (1, f"{_CLK1} AND dual AND p1 IS NOT NULL", "p1_id", f"{_N} || ' => Dual Source => 2nd priority not found => 1st priority => ' || p1"),
        (1, f"{_CLK1} AND dual", "NULL", f"{_N} || ' => Dual Source => 2nd priority not found => 1st priority'"),
        (1, _CLK1, None, _N), (1, "TRUE", None, "' => not Non-Duty Beneficial'"),
        (2, f"{_EU} AND dtp = 1", "id_dtp", f"{_B} || ' => DTP MTL'"), (2, _EU, None, f"{_B} || ' => Non DTP MTL => CLK'"),
        (2, f"{_ASIA2} AND in_rqt", "Q", f"{_B} || q_log"),
        (2, f"{_ASIA2} AND flex", "id_sjv", f"{_B} || ' => Dual Source => Flex => SJV'"),
        (2, f"{_ASIA2} AND dual AND p2 IS NOT NULL", "p2_id", f"{_B} || ' => Dual Source => Not Flex => 2nd priority' || p2"),
        (2, f"{_ASIA2} AND dual AND p1 IS NOT NULL", "p1_id", f"{_B} || ' => Dual Source => Not Flex => 2nd priority not found => 1st priority => ' || p1"),
        (2, f"{_ASIA2} AND dual", "NULL", f"{_B} || ' => Dual Source => Not Flex => 2nd priority not found => 1st priority'"),
        (2, _ASIA2, None, f"{_B} || ' => Single Source => CLK'"), (2, "TRUE", None, "''")],
    "DTC": _others1(_REST1) + [
        (2, f"{_CHILE_CHINA} AND in_rqt", "Q", f"{_B} || q_log"),
        (2, f"{_CHILE_CHINA} AND flex AND p1 = 'DTC'", None, f"{_B} || ' => Flex => 1st priority = DTC => DTC'"),
        (2, f"{_CHILE_CHINA} AND flex", "p1_id", f"{_B} || ' => Flex => 1st priority = not DTC => SJV'"),
        (2, _CHILE_CHINA, None, f"{_B} || ' => Not Flex => DTC'"), (2, "TRUE", None, "''")],
    "DTP": [
        (1, f"{_EU} AND clk = 1", "id_clk", f"{_B} || ' => CLK MTL'"),
        (1, f"{_EU} AND dual AND p2 IS NOT NULL", "p2_id", f"{_B} || {_D2}"), (1, f"{_EU} AND dual AND p1 IS NOT NULL", "p1_id", f"{_B} || {_D1}"),
        (1, f"{_EU} AND dual", None, f"{_B} || {_D0}"), (1, _EU, None, _B), (1, "TRUE", None, "''"),
        (2, "party = 'Korea DC' AND in_rqt", "Q", f"{_B} || q_log"), (2, "party = 'Korea DC' AND flex", "id_sjv", f"{_B} || ' => Flex => SJV'"),
        (2, "party = 'Korea DC' AND p1 IS NOT NULL", "p1_id", f"{_B} || ' => Not Flex => First priority => ' || p1"),
        (2, "party = 'Korea DC'", "NULL", f"{_B} || ' => Not Flex => First priority'"), (2, "TRUE", None, "''")],
    "FSC": _others1(_REST1) + [
        (2, f"{_CHILE_CHINA} AND in_rqt", "Q", f"{_B} || q_log"), (2, f"{_CHILE_CHINA} AND flex", "id_sjv", f"{_B} || ' => Flex => SJV'"),
        (2, _CHILE_CHINA, None, f"{_B} || ' => Flex => FSC'"), (2, "TRUE", None, "''")],
    "HSC": _others1(_REST1) + [
        (2, f"{_CHILE_CHINA} AND in_rqt", "Q", f"{_B} || q_log"), (2, f"{_CHILE_CHINA} AND flex", "id_sjv", f"{_B} || ' => Flex => SJV'"),
        (2, _CHILE_CHINA, None, f"{_B} || ' => Flex => HSC'"), (2, "TRUE", None, "''")],
    "ICC": _others1(_REST1) + [
        (2, f"{_CHILE_CHINA} AND in_rqt", "Q", f"{_B} || q_log"),
        (2, f"{_CHILE_CHINA} AND flex AND p1 = 'ICC'", None, f"{_B} || ' => Flex => 1st priority = ICC => ICC'"),
        (2, f"{_CHILE_CHINA} AND flex", "id_sjv", f"{_B} || ' => Flex => 1st priority = not ICC => SJV'"),
        (2, _CHILE_CHINA, None, f"{_B} || ' => Not Flex => ICC'"), (2, "TRUE", None, "''")],
    "SJD": [
        (1, "party = 'US Direct' AND in_rqt", "Q", f"{_B} || q_log"), (1, "party = 'US Direct'", "id_sjv", f"{_B} || ' => not RQT MTL => SJV'"),
        (1, "TRUE", None, "''"), (2, "party = 'US DC'", None, f"{_B} || ' => not RQT MTL => SJD'"), (2, "TRUE", None, "''")],
    "SJV": (_sjv_sql(1, "party = 'Chile DC'", _N, _FLEX2) + _sjv_sql(2, "party = 'China DC'", _N, _FLEX2)
            + _sjv_sql(3, "party = 'India DC'", _N, _FLEX34) + _sjv_sql(4, _EU, _N, _FLEX34)
            + _sjv_sql(5, _parties(["Korea DC", "Korea Direct"]), _B, [("flex", "Q", "' => Flex => SJV'")])),
}


def _leaf_columns(loop: int) -> str:
    """The target and log of a ruled unit in a loop, as flat CASEs over ``LEAVES``."""
    to, log = [], []
    for code, leaves in LEAVES.items():
        for at, cond, target, text in leaves:
            if at == loop:
                held = f"fname = '{code}' AND {cond}"
                to.append(f"WHEN {held} THEN " + {None: "now_id", "Q": "CASE WHEN in_rqt AND q_set THEN q_id ELSE now_id END"}.get(target, target))
                log.append(f"WHEN {held} THEN ' => [loop: {loop}]' || {text}")
    return f"CAST(CASE {' '.join(to)} ELSE now_id END AS BIGINT) AS leaf_id, CASE {' '.join(log)} ELSE '' END AS leaf_log"


def constrained_ctes(loops: int = 1) -> tuple[tuple[str, str], ...]:
    pct = "format('{:,.2f}', CAST(u_fill AS DOUBLE) / CAST(u_cap AS DOUBLE) * 100) || '%'"
    week = "year_cw_accounting || ' construction type ' || construction_type"
    status = (f"CASE WHEN u_fill IS NULL THEN fname || ' quantity not found for ' || {week} "
              f"WHEN u_cap IS NULL THEN fname || ' capacity not found for ' || {week} "
              f"WHEN u_cap = 0 THEN fname || ' Weekly fill rate: ' || CAST(u_fill AS VARCHAR) || '/' || CAST(u_cap AS VARCHAR) "
              f"ELSE fname || ' Weekly fill rate: ' || CAST(u_fill AS VARCHAR) || '/' || CAST(u_cap AS VARCHAR) || ' (' || {pct} || ')' END")
    attrs = ", ".join(f"max({a}) AS {a}" for a in (*allocate.UNIT_ATTRS, *allocate.CODE_COLUMNS))
    keys, wkeys = ", ".join(allocate.UNIT_KEYS), ", ".join(allocate.WRITE_KEYS)
    ctes = [
        ("cbase", """
SELECT b.*, cal.year_cw_accounting, coalesce(r.in_rqt, FALSE) AS in_rqt, r.rqt_vendor_m AS rqt_vendor2, fr2.dim_factory_id AS rqt_vendor_id2
FROM unconstrained b
LEFT JOIN calendar cal ON b.dim_date_id = cal.id
LEFT JOIN (SELECT material_id, max(factory_short_name) AS rqt_vendor_m, TRUE AS in_rqt FROM retail_qt GROUP BY 1) r USING (material_id)
LEFT JOIN factory fr2 ON fr2.short_name = r.rqt_vendor_m"""),
        ("cb", "SELECT * EXCLUDE (rqt_vendor, rqt_vendor_id, rqt_vendor2, rqt_vendor_id2), rqt_vendor2 AS rqt_vendor, "
               "rqt_vendor_id2 AS rqt_vendor_id FROM cbase"),
        ("ccand", """SELECT * FROM cb WHERE demand_category IN ('Forecast', 'Need to Buy')
                     AND dim_date_id >= year(release_date) * 10000 + month(release_date) * 100 + 1"""),
        ("units", f"SELECT {keys}, sum(quantity) AS quantity, {attrs} FROM ccand GROUP BY {keys}"),
        ("fill", """SELECT f.allocation_group, c.year_cw_accounting, c.construction_type, sum(c.quantity) AS fill
                    FROM ccand c JOIN factory f ON c.dim_factory_id_original_unconstrained = f.dim_factory_id
                    GROUP BY 1, 2, 3"""),
        ("cap", """SELECT k.dim_factory_id, cal.year_cw_accounting, k.construction_type, sum(k.capacity_available_weekly) AS cap
                   FROM capacity k JOIN calendar cal ON k.week_date_id = cal.id GROUP BY 1, 2, 3"""),
        ("u1", f"""
SELECT u.* EXCLUDE (flex), coalesce(u.flex, FALSE) AS flex, u.dim_factory_id_original_unconstrained AS uid, f.short_name AS fname, f.factory_region AS f_region,
       fl.fill AS u_fill, cp.cap AS u_cap, coalesce(fl.fill > cp.cap, FALSE) AS overload,
       coalesce(fl.fill > cp.cap AND f.short_name IN ({', '.join(f"'{c}'" for c in LEAVES)}), FALSE) AS ruled,
       u.n_src = 2 OR u.clk + u.dtp + u.sjd > 1 OR coalesce(u.flex, FALSE)
         OR (u.clk + u.dtp + u.sjd = 1 AND coalesce(u.p2 NOT IN (CASE WHEN u.clk = 1 THEN 'CLK' WHEN u.dtp = 1 THEN 'DTP' ELSE 'SJD' END), TRUE)) AS dual
FROM units u
LEFT JOIN factory f ON u.dim_factory_id_original_unconstrained = f.dim_factory_id
LEFT JOIN fill fl ON fl.allocation_group = f.allocation_group AND fl.year_cw_accounting = u.year_cw_accounting
                 AND fl.construction_type = u.construction_type
LEFT JOIN cap cp ON cp.dim_factory_id = u.dim_factory_id_original_unconstrained
                AND cp.year_cw_accounting = u.year_cw_accounting AND cp.construction_type = u.construction_type"""),
        ("u2", """
SELECT *, f_region IN ('EMEA', 'NORA', 'CASA', 'APAC') AS q_set,
       CASE WHEN f_region = 'APAC' THEN CASE WHEN starts_with(lower(party), 'china') THEN id_hsc ELSE rqt_vendor_id END
            WHEN rqt_vendor IN ('DTC', 'SJV') THEN CASE WHEN f_region = 'EMEA' THEN id_dtc ELSE id_sjv END ELSE rqt_vendor_id END AS q_id,
       CASE WHEN NOT in_rqt THEN '' WHEN coalesce(f_region, '') NOT IN ('EMEA', 'NORA', 'CASA', 'APAC') THEN ' => RQT MTL' ELSE ' => RQT MTL => ' ||
         CASE WHEN f_region = 'APAC' THEN CASE WHEN starts_with(lower(party), 'china') THEN 'HSC' ELSE rqt_vendor END
              WHEN rqt_vendor IN ('DTC', 'SJV') THEN CASE WHEN f_region = 'EMEA' THEN 'DTC' ELSE 'SJV' END ELSE rqt_vendor END END AS q_log
FROM u1"""),
        ("s0", f"SELECT DISTINCT {wkeys}, CAST(NULL AS VARCHAR) AS carried, CAST(NULL AS BIGINT) AS moved FROM units"),
    ]
    for n in range(1, loops + 1):
        before = f"""CASE WHEN ruled THEN '[OVERLOAD] ' || {status} || ' => ' || fname || ' scenario B'
            WHEN overload THEN '[OVERLOAD] ' || {status} || ' => No allocation logic found for ' || fname
            ELSE '[AVAILABLE] ' || {status} END""" if n == 1 else "carried"
        ctes += [
            (f"a{n}", f"SELECT *, {_leaf_columns(n)} FROM (SELECT u2.*, carried, moved, coalesce(moved, uid) AS now_id FROM u2 JOIN s{n - 1} USING ({wkeys}))"),
            (f"b{n}", f"""
SELECT *, CASE WHEN ruled THEN leaf_id END AS tid,
       CASE WHEN ruled THEN {before} || leaf_log || CASE WHEN leaf_id IS NULL THEN ' => Not Found' ELSE '' END ELSE {before} END AS log0
FROM a{n}"""),
            (f"c{n}", f"""
SELECT u.*, tid IS NOT NULL AND tid <> uid AS moves, coalesce(tf.fill + u.quantity < tc.cap, FALSE) OR coalesce(tid = id_sjv, FALSE) AS fits
FROM b{n} u
LEFT JOIN factory f ON u.tid = f.dim_factory_id
LEFT JOIN fill tf ON tf.allocation_group = f.allocation_group AND tf.year_cw_accounting = u.year_cw_accounting AND tf.construction_type = u.construction_type
LEFT JOIN cap tc ON tc.dim_factory_id = u.tid AND tc.year_cw_accounting = u.year_cw_accounting AND tc.construction_type = u.construction_type"""),
            (f"d{n}", f"""
SELECT *, row_number() OVER (PARTITION BY {wkeys} ORDER BY quantity, uid DESC, style_complexity DESC NULLS LAST, construction_type DESC NULLS LAST) AS last_log,
       row_number() OVER (PARTITION BY {wkeys}, moves AND fits ORDER BY quantity, uid DESC, style_complexity DESC NULLS LAST, construction_type DESC NULLS LAST) AS last_move
FROM c{n}"""),
            (f"s{n}", f"""
SELECT {wkeys}, max(CASE WHEN last_log = 1 THEN CASE WHEN moves AND NOT fits THEN log0 || ' => Target factory full' ELSE log0 END END) AS carried,
       coalesce(max(CASE WHEN moves AND fits AND last_move = 1 THEN tid END), max(moved)) AS moved
FROM d{n} GROUP BY {wkeys}""")]
    ctes.append(("constrained", f"""
SELECT b.*, coalesce(d.moved, b.dim_factory_id_original_unconstrained) AS dim_factory_id_original_constrained,
       d.carried AS allocation_logic_constrained, coalesce(d.moved, b.dim_factory_id_original_unconstrained) AS dim_factory_id
FROM cb b LEFT JOIN s{loops} d USING ({wkeys})"""))
    return unconstrained_ctes() + tuple(ctes)


CONSTRAINED_NEEDS = ALLOC_NEEDS + ("capacity", "calendar")
query("x_allocate_constrained", sql(f"SELECT {', '.join(CONSTRAINED_OUT)} FROM constrained", *CONSTRAINED_NEEDS,
                                    local=constrained_ctes()))(x_allocate_constrained)
query("x_constrained_loops", sql(f"SELECT {', '.join(allocate.WRITE_KEYS)}, carried AS allocation_logic, moved AS moved_to FROM s5",
                                 *CONSTRAINED_NEEDS, local=constrained_ctes(5)))(x_constrained_loops)
