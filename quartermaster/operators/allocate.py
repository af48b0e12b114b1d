"""Demand allocation (X01-X41): unconstrained routing, then the capacity-constrained pass.

Both passes are set-based.  Every input of a decision is a column of the row (its material, customer
and priority-list features, joined once) and no decision reads another decision, so the row-by-row
cursors of the original become column expressions evaluated inside the scan stage.

Constrained pass: fill is computed from the *unconstrained* factory and never moves during the pass,
so every demand unit decides independently; the only order dependence -- several units writing the
same facts -- is resolved by an aggregate that keeps the last unit in processing order (X41).  Later loops
carry each write-back key's log and factory on, over the keys that still hold a unit with a rule.
Shuffles: lines are dealt by (factory, week, construction type), where they are summed up to units and meet
fill and capacity; units by write-back key, where the last writer is found; lines by write-back key, where
they meet it.  What only the rules read travels with the units of rule-bearing factories alone, a log as the
few values that it is made of, and the weeks of a factory's capacity for a type as one row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import rules
from .calendar import period_start
from .lookups import scalar

PLACEHOLDER_FACTORY = -1
#: Ids of rule-bearing factories that are named in a plan at most.
MANY_IDS = 1000
#: Compression of the written tables, each of which holds up to a row for every line.
SCRATCH_CODEC = "zstd"
CODE_COLUMNS = {"id_clk": "CLK", "id_dtc": "DTC", "id_dtp": "DTP", "id_sjd": "SJD", "id_sjv": "SJV", "id_hsc": "HSC"}


def factory_code_ids(factory: DataFrame) -> dict[str, int | None]:
    """Ids of the rule-bearing factories (at most eight rows), fetched as literals."""
    codes = list(CODE_COLUMNS.values())
    row = factory.filter(F.col("short_name").isin(codes)).agg(
        *[F.max(F.when(F.col("short_name") == c, F.col("dim_factory_id"))).alias(k) for k, c in CODE_COLUMNS.items()])
    return scalar(row)


def customer_features(customer: DataFrame) -> DataFrame:
    """What the rules read of a customer."""
    return customer.select("dim_customer_id", "region", F.col("sold_to_party").alias("party"), "sold_to_category")


def allocation_features(demand: DataFrame, product: DataFrame, customer: DataFrame | None, factory: DataFrame,
                        priority: DataFrame, fty_qt: DataFrame, retail_qt: DataFrame, any_vendor: bool = False) -> DataFrame:
    """One row per demand line with every feature the rules read (see ``rules`` docstring).

    All tables that hang on a product are put together before the lines meet them, the retail quick-turn vendors of a
    product's regions and parties among them, so lines are dealt by customer (not if ``customer`` is None: they carry
    ``customer_features``) and by product.  ``any_vendor`` adds what the constrained pass reads of a material's quick turn:
    ``any_rqt_vendor``, its id and ``in_rqt``."""
    codes = factory_code_ids(factory)
    p = product.select("dim_product_id", "material_id", "style_complexity", "construction_type",
                       F.coalesce("clk_mtl", F.lit(0)).alias("clk"), F.coalesce("dtp_mtl", F.lit(0)).alias("dtp"),
                       F.coalesce("sjd_mtl", F.lit(0)).alias("sjd"))
    f1 = factory.select(F.col("dim_factory_id").alias("p1_id"), F.col("short_name").alias("p1"), F.col("country_code").alias("c1"))
    f2 = factory.select(F.col("dim_factory_id").alias("p2_id"), F.col("short_name").alias("p2"), F.col("country_code").alias("c2"))
    prio = (priority.join(f1, priority.dim_factory_id_1 == f1.p1_id, "left")
                    .join(f2, priority.dim_factory_id_2 == f2.p2_id, "left")
                    .select("dim_product_id", "p1_id", "p1", "c1", "p2_id", "p2", "c2"))
    qt = (fty_qt.groupBy("material_id").agg(F.max("factory_short_name").alias("qt_vendor"))
                .join(factory_names(factory, "qt_vendor", "qt_vendor_id"), "qt_vendor", "left"))
    products = p.join(prio, "dim_product_id", "full_outer").join(qt, "material_id", "left")
    if any_vendor:
        products = products.join(quick_turn_vendor(retail_qt, factory), "material_id", "left").withColumn("in_rqt", F.coalesce("in_rqt", F.lit(False)))
    rqt = (retail_qt.groupBy("material_id", "region", F.col("sold_to_party").alias("party"))
                    .agg(F.max("factory_short_name").alias("rqt_vendor"))
                    .join(factory_names(factory, "rqt_vendor", "rqt_vendor_id"), "rqt_vendor", "left")
                    .filter(F.col("region").isNotNull() & F.col("party").isNotNull())
                    .join(product.select("dim_product_id", "material_id"), "material_id")
                    .groupBy("dim_product_id").agg(F.map_from_entries(F.collect_set(F.struct(
                        F.struct("region", "party").alias("at"), F.struct("rqt_vendor", "rqt_vendor_id").alias("vendor")))).alias("_rqt")))
    d = demand if customer is None else demand.join(customer_features(customer), "dim_customer_id", "left")
    d = d.withColumn("lead", F.datediff("demand_date", "release_date"))  # travels in place of the dates, if they are not asked for
    d = d.join(products.join(rqt, "dim_product_id", "left"), "dim_product_id", "left")
    d = d.withColumn("_rqt", F.try_element_at("_rqt", F.struct("region", "party"))).withColumns(
        {"rqt_vendor": F.col("_rqt.rqt_vendor"), "rqt_vendor_id": F.col("_rqt.rqt_vendor_id")}).drop("_rqt")
    n_src = F.col("p1").isNotNull().cast("int") + F.col("p2").isNotNull().cast("int")
    return d.select(
        "*",
        F.col("buying_program").alias("program"),
        F.col("party").alias("cust_name"),
        F.col("style_complexity").ilike("%Flex%").alias("flex"),
        n_src.alias("n_src"),
        ((n_src == 1) & ((F.col("clk") + F.col("dtp") + F.col("sjd")) <= 1)).alias("single"),
        *[F.lit(v).cast("bigint").alias(k) for k, v in codes.items()],
    )


#: The categories whose lines can make up demand units; a write-back key holds the category, so no other line meets a unit.
OPEN_CATEGORIES = ["Forecast", "Need to Buy"]


def is_open(release_start_id: Column | None = None) -> Column:
    """Forecast / Need-to-Buy lines dated from the release month on, the lines that make up demand units."""
    start = release_start_id if release_start_id is not None else (
        F.year("release_date") * 10000 + F.month("release_date") * 100 + 1)
    return F.col("demand_category").isin(OPEN_CATEGORIES) & (F.col("dim_date_id") >= start)


def is_candidate(release_start_id: Column | None = None) -> Column:
    """Open lines never edited by hand."""
    return is_open(release_start_id) & (F.col("is_edited") == 0)


def keep_loaded(lines: DataFrame) -> DataFrame:
    """X01-X09 of lines that are no candidates: the loaded factory, no log; they need no features."""
    none = F.lit(None).cast("string")
    return lines.withColumns({"dim_factory_id_original_unconstrained": F.col("dim_factory_id_original"),
                              "allocation_logic_unconstrained": none, "component_factory_short_name": none})


def apply_steps(df: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    """Add the compiled rule steps as columns: the path flags and rule outputs (which read only
    features) in one projection, the log-append array (which reads flags) in a second."""
    late = ("_apps", "_last_rule", "_last_k", "_found_rule")
    first = {n: F.expr(e) for n, e in steps if n not in late}
    rest = {n: F.expr(e) for n, e in steps if n in late}
    return df.withColumns(first).withColumns(rest)


def allocate_unconstrained(features: DataFrame, candidate: Column | None = None) -> DataFrame:
    """Factory, decision log and component factory for every candidate line; other lines keep
    their loaded factory and get no log.  ``candidate`` tells which lines are, if not ``is_candidate``."""
    steps, (fid, log, comp) = rules.decision_steps()
    tmp = [n for n, _e in steps]
    out = apply_steps(features.withColumn("_cand", is_candidate() if candidate is None else candidate), steps)
    out = out.select(
        "*",
        F.when(F.col("_cand"), F.coalesce(F.expr(fid), F.lit(PLACEHOLDER_FACTORY).cast("bigint")))
         .otherwise(F.col("dim_factory_id_original")).alias("dim_factory_id_original_unconstrained"),
        F.when(F.col("_cand"), F.expr(log)).alias("allocation_logic_unconstrained"),
        F.when(F.col("_cand"), F.expr(comp)).alias("component_factory_short_name"),
    )
    return out.drop(*tmp, "_cand")


def _fill_status(name: Column, cw: Column, ct: Column, fill: Column, cap: Column) -> Column:
    """Weekly fill text of a factory."""
    pct = F.concat(F.format_number(fill.cast("double") / cap.cast("double") * 100, 2), F.lit("%"))
    return (F.when(fill.isNull(), F.concat(name, F.lit(" quantity not found for "), cw, F.lit(" construction type "), ct))
             .when(cap.isNull(), F.concat(name, F.lit(" capacity not found for "), cw, F.lit(" construction type "), ct))
             .when(cap == 0, F.concat(name, F.lit(" Weekly fill rate: "), fill.cast("string"), F.lit("/"), cap.cast("string")))
             .otherwise(F.concat(name, F.lit(" Weekly fill rate: "), fill.cast("string"), F.lit("/"), cap.cast("string"),
                                 F.lit(" ("), pct, F.lit(")"))))


UNIT_KEYS = ["program", "dim_factory_id_original_unconstrained", "dim_customer_id", "demand_category",
             "year_cw_accounting", "material_id", "style_complexity", "construction_type"]
WRITE_KEYS = ["program", "material_id", "year_cw_accounting", "dim_customer_id", "demand_category"]
UNIT_ATTRS = ["party", "region", "clk", "dtp", "sjd", "flex", "n_src", "p1", "p2", "p1_id", "p2_id", "in_rqt", "rqt_vendor", "rqt_vendor_id"]
#: The factories that a unit's target can be: its own and those that the constrained rules name.
REACHED = ["dim_factory_id_original_unconstrained", "p1_id", "p2_id", "rqt_vendor_id", *CODE_COLUMNS]


def factory_names(factory: DataFrame, name: str, id_: str) -> DataFrame:
    """One id for each short name, so that a name that repeats cannot multiply facts."""
    return factory.groupBy(F.col("short_name").alias(name)).agg(F.max("dim_factory_id").alias(id_))


def quick_turn_vendor(retail_qt: DataFrame, factory: DataFrame) -> DataFrame:
    """The quick-turn vendor of a material whatever the region and party: (material_id, any_rqt_vendor, its id, in_rqt)."""
    return (retail_qt.groupBy("material_id").agg(F.max("factory_short_name").alias("any_rqt_vendor"))
                     .join(factory_names(factory, "any_rqt_vendor", "any_rqt_vendor_id"), "any_rqt_vendor", "left").withColumn("in_rqt", F.lit(True)))


def rule_factory_ids(factory: DataFrame) -> list[int] | None:
    """Ids of the factories whose overload the constrained rules treat, fetched as literals; None if too many share their names."""
    ids = scalar(factory.filter(F.col("short_name").isin(rules.SCENARIO_B_FACTORIES)).agg(
        F.slice(F.collect_set("dim_factory_id"), 1, MANY_IDS).alias("ids")))["ids"]
    return ids if len(ids) < MANY_IDS else None


def demand_units(allocated: DataFrame, factory: DataFrame, capacity: DataFrame, calendar: DataFrame):
    """(units, load): X20 demand units of ``allocated``, the open lines (``is_open``), with the fill, capacity and overload of their factory
    (X22, X23, X25), written once; and a function that adds another factory's fill and capacity to units.

    Places (factory, week, type) with their fill and group are written too, and capacity, as both are read for the units' own
    factories and for those that their rules name.  A unit without a rule holds none of UNIT_ATTRS: only rules read them."""
    cal = F.broadcast(calendar.select(F.col("id").alias("_cal_id"), "year_cw_accounting"))  # bounded by parameters
    # the constrained rules read the material-level quick-turn vendor
    cand = (allocated.join(cal, allocated.dim_date_id == cal._cal_id, "left").drop("_cal_id", "rqt_vendor", "rqt_vendor_id")
                     .withColumnsRenamed({"any_rqt_vendor": "rqt_vendor", "any_rqt_vendor_id": "rqt_vendor_id"}))
    own, at = "dim_factory_id_original_unconstrained", ["year_cw_accounting", "construction_type"]
    ids = rule_factory_ids(factory)
    may = F.lit(True) if ids is None else F.col(own).isin(ids)
    # lines are dealt by place: the units, whose keys hold it, and the lookup need no further shuffle
    units = (cand.select(*UNIT_KEYS, "quantity", *[F.when(may, F.col(a)).alias(a) for a in UNIT_ATTRS]).repartition(own, *at)
                 .groupBy(*UNIT_KEYS).agg(F.sum("quantity").alias("quantity"), *[F.max(a).alias(a) for a in UNIT_ATTRS]))
    units = units.withColumns({k: F.lit(v).cast("bigint") for k, v in factory_code_ids(factory).items()})
    groups = factory.select(F.col("dim_factory_id").alias("_fid"), "allocation_group", F.col("short_name").alias("_fname"),
                            F.col("factory_region").alias("_fregion"))
    # a week's first day stands for it among a factory's weeks
    weeks = F.broadcast(period_start(calendar, "year_cw_accounting", "_week").filter(F.col("year_cw_accounting").isNotNull()))
    weekly = (capacity.join(cal, capacity.week_date_id == cal._cal_id).join(weeks, "year_cw_accounting")
                      .groupBy(F.col("dim_factory_id").alias("_fid"), "construction_type", "_week").agg(F.sum("capacity_available_weekly").alias("cap")))
    cap = materialize(weekly.groupBy("_fid", "construction_type").agg(
        F.map_from_entries(F.collect_list(F.struct("_week", "cap"))).alias("_weeks")), "capacity", SCRATCH_CODEC)

    def with_capacity(places: DataFrame, cap: DataFrame) -> DataFrame:
        return places.join(cap, ["_fid", "construction_type"], "left").join(weeks, "year_cw_accounting", "left").withColumn(
            "cap", F.try_element_at("_weeks", F.col("_week"))).drop("_weeks", "_week")

    # the units' own places are dealt by factory and type, where they are summed up and meet their factory and its capacity
    kind = ["_fid", "construction_type"]
    at_own = cand.select(F.col(own).alias("_fid"), *at, "quantity")
    sites = at_own.select(*kind).distinct().join(groups, "_fid", "left")
    places = at_own.repartition(*kind).groupBy("_fid", *at).agg(F.sum("quantity").alias("own"))
    places = materialize(with_capacity(places.join(sites, kind, "left"), cap), "places", SCRATCH_CODEC)
    # fill per allocation group, week and construction type, from the unconstrained factory: it never moves
    fill = places.filter(F.col("allocation_group").isNotNull()).groupBy("allocation_group", *at).agg(F.sum("own").alias("fill"))

    def load(df: DataFrame, fid_col: str, prefix: str, known: DataFrame | None = None, cap: DataFrame = cap) -> DataFrame:
        """Fill and capacity are looked up for the distinct (factory, week, type) of ``df``, or for those ``known`` with their
        groups and capacity: wide units meet one table.  A place that lacks a part has neither fill nor capacity."""
        keys = known if known is not None else with_capacity(
            df.select(F.col(fid_col).alias("_fid"), *at).distinct().join(groups, "_fid", "left"), cap)
        t = keys.join(fill, ["allocation_group", *at], "left").select(*[F.col(c).alias(f"{prefix}_{n}") for c, n in (
            ("_fid", "at"), *((c, c) for c in at), ("_fname", "name"), ("_fregion", "region"), ("fill", "fill"), ("cap", "cap"))])
        same = [df[c] == t[f"{prefix}_{n}"] for c, n in ((fid_col, "at"), *((c, c) for c in at))]
        return df.join(t, same, "left").drop(f"{prefix}_at", *(f"{prefix}_{c}" for c in at))

    u = load(units, own, "u", known=places).withColumnsRenamed({"u_name": "fname", "u_region": "f_region"})
    u = u.withColumn("_overload", F.coalesce(F.col("u_fill") > F.col("u_cap"), F.lit(False)))
    u = u.withColumn("_ruled", F.col("_overload") & F.coalesce(F.col("fname").isin(rules.SCENARIO_B_FACTORIES), F.lit(False)))
    u = u.withColumns({a: F.when(F.col("_ruled"), F.col(a)) for a in UNIT_ATTRS})
    return materialize(u, "units", SCRATCH_CODEC), _Load(load, cap)


@dataclass(frozen=True)
class _Load:
    """The lookup of fill and capacity, and the capacity that it reads."""
    look: Callable
    cap: DataFrame

    def __call__(self, df: DataFrame, fid_col: str, prefix: str) -> DataFrame:
        return self.look(df, fid_col, prefix, cap=self.cap)

    def within(self, units: DataFrame) -> "_Load":
        """The same lookup over the capacity that ``units`` can reach: a unit's target is its own factory, one that a rule of a
        unit of its write-back key names, or where that key has moved."""
        ruled = units.filter("_ruled").select(*WRITE_KEYS, F.explode(F.array_distinct(F.array(*REACHED))).alias("_fid")).distinct()
        kinds = units.select(*(F.col(k).alias(f"_k_{k}") for k in WRITE_KEYS), "construction_type").distinct()
        reach = ruled.join(kinds, _same_key()).select("_fid", "construction_type")
        return _Load(self.look, materialize(self.cap.join(reach.distinct(), ["_fid", "construction_type"], "left_semi"), "reach", SCRATCH_CODEC))


def _same_key() -> list[Column]:
    """The null-safe equality of write-back keys, the other side's with ``_k_`` before their names."""
    return [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in WRITE_KEYS]


def constrain_once(units: DataFrame, load, loop: int) -> DataFrame:
    """One loop over ``units``, which hold the state of their write-back key (``_moved``, ``_carried``) from the loop before:
    the keys' new state.

    A unit's target is what its rule sets, else the factory it has now; a unit without a rule only writes its log."""
    now = F.coalesce("_moved", "dim_factory_id_original_unconstrained")
    units = units.withColumns({n: F.expr(e) for n, e in rules.unit_features().items()})
    was_set, fid, log = (F.expr(e) for e in rules.constrained_target(loop))
    units = units.withColumn("_tid", F.when(F.col("_ruled"), F.when(was_set, fid).otherwise(now)).cast("bigint"))
    not_found = F.when(F.col("_tid").isNull(), F.lit(" => Not Found")).otherwise("")
    # 2 ruled, 1 overloaded without a rule, 0 available
    u = units.withColumn("_state", F.col("_ruled").cast("int") + F.col("_overload").cast("int")).withColumn("_tail", F.when(F.col("_ruled"), F.concat(log, not_found)).otherwise(""))
    # X40 accept test on the target factory's own fill and capacity; units without a rule have no target
    t = load(u.filter("_ruled"), "_tid", "t")
    moves = F.col("_tid").isNotNull() & (F.col("_tid") != F.col("dim_factory_id_original_unconstrained"))
    accept = F.coalesce((F.col("t_fill") + F.col("quantity")) < F.col("t_cap"), F.lit(False)) | F.coalesce(F.col("_tid") == F.col("id_sjv"), F.lit(False))
    t = t.withColumns({"_tail": F.when(moves & ~accept, F.concat("_tail", F.lit(" => Target factory full"))).otherwise(F.col("_tail")), "_to": F.when(moves & accept, F.col("_tid"))})
    rest = u.filter("NOT _ruled").withColumn("_to", F.lit(None).cast("bigint"))
    # what a log is made of travels, not its text: a unit's first words are written where the last writer is known
    head = ["fname", "u_fill", "u_cap"] if loop == 1 else ["_carried", "_moved"]
    kept = [*dict.fromkeys((*WRITE_KEYS, *UNIT_KEYS)), "quantity", "_state", "_tail", "_to", *head]
    # dealt by key before they are grouped: a unit travels once, not once for each thing that its group keeps of it
    t = t.select(kept).unionByName(rest.select(kept)).repartition(*WRITE_KEYS)
    # X41 last writer per write-back key: processing order is week asc, quantity desc (ties: factory id, complexity,
    # construction type asc), so the last unit of a key is its smallest quantity, then the largest of the rest
    texts = [F.when(F.col(c).isNull(), F.lit(1)).otherwise(0).alias(f"no_{c}") for c in ("style_complexity", "construction_type")]
    last = F.struct(-F.col("quantity"), "dim_factory_id_original_unconstrained", *(-x for x in texts), "style_complexity", "construction_type")
    state = t.groupBy(*WRITE_KEYS).agg(
        F.max_by(F.struct(*head, "_state", "_tail", "construction_type"), last).alias("_said"),
        F.max_by("_to", F.when(F.col("_to").isNotNull(), last)).alias("_to"),
        (F.lit(None).cast("bigint") if loop == 1 else F.max("_moved")).alias("_moved"),
        F.max((F.col("_state") == 2).cast("int")).alias("_open"))
    if loop == 1:
        name = F.col("_said.fname")
        status = _fill_status(name, F.col("year_cw_accounting"), F.col("_said.construction_type"), F.col("_said.u_fill"), F.col("_said.u_cap"))
        before = F.when(F.col("_said._state") == 2, F.concat(F.lit("[OVERLOAD] "), status, F.lit(" => "), name, F.lit(" scenario B"))).when(
            F.col("_said._state") == 1, F.concat(F.lit("[OVERLOAD] "), status, F.lit(" => No allocation logic found for "), name)).otherwise(
            F.concat(F.lit("[AVAILABLE] "), status))
    else:
        before = F.col("_said._carried")
    return state.select(*WRITE_KEYS, F.concat(before, "_said._tail").alias("_carried"), F.coalesce("_to", "_moved").alias("_moved"), "_open")


def constrained_state(units: DataFrame, load, max_loop: int = 1) -> DataFrame:
    """(write-back key, _carried log, _moved factory, _loops run) after up to five loops.

    Only keys with a ruled unit can change after the first loop, so the others leave there: the later loops read the units
    of the open keys and the capacity within their reach, both written once, as is each loop's state."""
    if not 1 <= max_loop <= 5:
        raise ValueError("the rules have five loops")
    fresh = units.withColumn("_moved", F.lit(None).cast("bigint")).withColumn("_carried", F.lit(None).cast("string"))
    state = constrain_once(fresh, load, 1)
    if max_loop == 1:
        return state.select(*WRITE_KEYS, "_carried", "_moved", F.lit(1).alias("_loops"))
    state = materialize(state, "state")
    closed, state = state.filter("_open = 0"), state.filter("_open = 1")
    keys = state.select(*(F.col(k).alias(f"_k_{k}") for k in WRITE_KEYS))
    frontier = materialize(units.join(keys, _same_key(), "left_semi"), "frontier")
    load = load.within(frontier)
    for loop in range(2, max_loop + 1):
        held = state.select(*(F.col(k).alias(f"_k_{k}") for k in WRITE_KEYS), "_carried", "_moved")
        now = frontier.join(held, _same_key()).drop(*(f"_k_{k}" for k in WRITE_KEYS))
        state = materialize(constrain_once(now, load, loop), "state")
    return closed.select(*WRITE_KEYS, "_carried", "_moved", F.lit(1).alias("_loops")).union(
        state.select(*WRITE_KEYS, "_carried", "_moved", F.lit(max_loop)))


def keep_unconstrained(lines: DataFrame) -> DataFrame:
    """X20-X41 of lines whose category makes up no unit: the unconstrained factory, no log; they need no write-back key."""
    kept = F.col("dim_factory_id_original_unconstrained")
    return lines.withColumns({"allocation_logic_constrained": F.lit(None).cast("string"), "dim_factory_id_original_constrained": kept, "dim_factory_id": kept})


def allocate_constrained(allocated: DataFrame, closed: DataFrame, factory: DataFrame, capacity: DataFrame, calendar: DataFrame,
                         max_loop: int = 1) -> DataFrame:
    """Re-route demand units whose factory is over capacity in their week, in up to ``max_loop`` loops.

    ``allocated`` holds the open lines from ``allocate_unconstrained`` with their features, ``any_vendor`` included;
    ``closed`` the other lines of their categories, which make up no unit but share write-back keys, without features (what is
    left, ``keep_unconstrained`` covers).  Returns the columns that both have with ``dim_factory_id_original_constrained``,
    ``allocation_logic_constrained`` and the final ``dim_factory_id``."""
    units, load = demand_units(allocated, factory, capacity, calendar)
    decided = constrained_state(units, load, max_loop).select(
        *WRITE_KEYS, F.col("_carried").alias("allocation_logic_constrained"), F.col("_moved").alias("_moved_to"))
    cols = [c for c in allocated.columns if c in closed.columns]
    lines = allocated.select(cols).unionByName(closed.select(cols))
    cal = F.broadcast(calendar.select(F.col("id").alias("_cal_id"), "year_cw_accounting"))
    base = lines.join(cal, F.col("dim_date_id") == cal._cal_id, "left").drop("_cal_id")
    constrained = F.coalesce("_moved_to", "dim_factory_id_original_unconstrained")
    return (base.join(decided, WRITE_KEYS, "left")
                .withColumns({"dim_factory_id_original_constrained": constrained, "dim_factory_id": constrained}).drop("_moved_to"))
