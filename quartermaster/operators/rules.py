"""Allocation rules as data.

A rule is an ordered list of branches ``(condition, factory_id, log, component)``; the first true
condition wins.  Every piece is an SQL expression over the feature columns built by
``allocate.allocation_features``, so the same rule text is evaluated by Spark (``F.expr`` inside the
plan, whole-stage code-generated) and can be handed to any SQL engine as a CASE expression.

The routing tree (X04) is a small program of statements in source order:
  ("log",  condition, text)   append text to the running decision log when the condition holds
  ("call", condition, rule)   apply ``rule``; its factory (when found) and its log are written back
The statements are sequential IFs, not ELSE-IFs: several calls can fire for one row; a later call
overwrites the log, and the factory too when it found one.

Feature columns available to rule expressions:
  clk, dtp, sjd            material flags (0/1)           flex      complexity is Flex
  p1, p2, p1_id, p2_id     first / second priority factory (short name, id)
  c1, c2                   their country codes            single    one source and <= 1 flag
  region, party, sold_to_category, program, demand_category, lead (days), cust_name
  rqt_vendor, rqt_vendor_id, qt_vendor, qt_vendor_id      quick-turn helper vendors
  id_clk, id_dtp, id_sjd, id_sjv, id_hsc                  ids of the rule-bearing factories
"""

from __future__ import annotations

# fixed values: log fragments and factory codes of the decision rules, in the words of the original.
SEP = "' => '"


def _txt(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _log(*parts: str) -> str:
    """SQL text of ' => a => b ...' where parts are SQL expressions."""
    return " || ".join(f"{SEP} || {p}" for p in parts)


def _opt(name_col: str) -> str:
    """' => <name>' when the name is known, else nothing."""
    return f"coalesce({SEP} || {name_col}, '')"


FLEX = "flex"
SINGLE = "single"

RULES: dict[str, list[tuple[str, str, str, str]]] = {
    # EU / Europe-like tree
    "X10": [
        ("clk = 1", "id_clk", _log(_txt("CLK MTL")), "CAST(NULL AS STRING)"),
        ("dtp = 1", "id_dtp", _log(_txt("DTP MTL")), "CAST(NULL AS STRING)"),
        (FLEX, "id_sjv", _log(_txt("Flex")), "CAST(NULL AS STRING)"),
        (SINGLE, "p1_id", _log(_txt("Single Source"), _txt("1st priority")), "CAST(NULL AS STRING)"),
        ("c1 = 'CN'", "coalesce(p2_id, p1_id)",
         _log(_txt("1st priority = COO China"), _txt("2nd priority"))
         + f" || CASE WHEN p2 IS NOT NULL THEN {SEP} || p2 ELSE {_log(_txt('not found'), _txt('1st priority'))} || {_opt('p1')} END",
         "CAST(NULL AS STRING)"),
        ("TRUE", "p1_id", _log(_txt("1st priority = COO not China"), _txt("1st priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
    ],
    # X11: Canada
    "X11": [
        ("clk = 1", "id_clk", _log(_txt("CLK MTL")), "CAST(NULL AS STRING)"),
        ("TRUE", "p1_id", _log(_txt("Single source"), _txt("1st priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
    ],
    # India
    "X12": [
        ("clk = 1", "id_clk", _log(_txt("CLK MTL")), "CAST(NULL AS STRING)"),
        (FLEX, "id_sjv", _log(_txt("Flex")), "CAST(NULL AS STRING)"),
        (SINGLE, "p1_id", _log(_txt("Single Source")), "CAST(NULL AS STRING)"),
        ("c1 = 'CN'", "coalesce(p2_id, p1_id)",
         _log(_txt("1st priority = COO China"), _txt("2nd priority"))
         + f" || CASE WHEN p2 IS NOT NULL THEN {SEP} || p2 ELSE {_log(_txt('not found'), _txt('1st priority'))} || {_opt('p1')} END",
         "CAST(NULL AS STRING)"),
        ("TRUE", "p1_id", _log(_txt("1st priority = COO not China"), _txt("First priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
    ],
    # US direct -- SJD material for the named retail chains (the party text stands in for the name)
    "X13": [
        ("sjd = 1 AND (cust_name ILIKE '%ZUMIEZ%' OR cust_name ILIKE '%KOHLS%' OR cust_name ILIKE '%JOURNEYS%')",
         "id_sjd", _log(_txt("SJD MTL")), "CAST(NULL AS STRING)"),
        ("TRUE", "p1_id", _log(_txt("First priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
    ],
    # US DC
    "X14": [
        ("sjd = 1", "id_sjd", _log(_txt("SJD MTL")), "CAST(NULL AS STRING)"),
        ("TRUE", "p1_id", _log(_txt("First priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
    ],
    # Korea
    "X15": [
        (FLEX, "id_sjv", _log(_txt("Flex")), "CAST(NULL AS STRING)"),
        ("clk = 1", "id_clk", _log(_txt("CLK MTL")), "CAST(NULL AS STRING)"),
        ("dtp = 1", "id_dtp", _log(_txt("DTP MTL")), "CAST(NULL AS STRING)"),
        (SINGLE, "p1_id", _log(_txt("Single Source")), "CAST(NULL AS STRING)"),
        ("c1 <> 'CN'", "p1_id", _log(_txt("1st priority = COO not China"), _txt("First priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
        ("c2 = 'CN'", "p1_id", _log(_txt("2nd priority = COO China"), _txt("First priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
        ("p2 IS NOT NULL", "p2_id", _log(_txt("2nd priority = COO not China"), _txt("2nd priority"), "p2"), "CAST(NULL AS STRING)"),
        ("TRUE", "p1_id", _log(_txt("2nd priority = COO not China"), _txt("2nd priority"), _txt("not found"),
                               _txt("1st priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
    ],
    # China
    "X16": [
        (f"{FLEX} AND p1 = 'ICC'", "p1_id", _log(_txt("Flex")), "CAST(NULL AS STRING)"),
        (f"{FLEX} AND p1 = 'DTC'", "p1_id", _log(_txt("Flex")), "CAST(NULL AS STRING)"),
        (f"{FLEX} AND p1 = 'SJV'", "id_hsc", _log(_txt("Flex")), "CAST(NULL AS STRING)"),
        (f"{SINGLE} AND p1 = 'ICC'", "p1_id", _log(_txt("Single Source")), "CAST(NULL AS STRING)"),
        (f"{SINGLE} AND p1 = 'DTC'", "p1_id", _log(_txt("Single Source")), "CAST(NULL AS STRING)"),
        (f"{SINGLE} AND p1 = 'SJV'", "id_hsc", _log(_txt("Single Source")), "CAST(NULL AS STRING)"),
        ("c1 = 'CN'", "p1_id", _log(_txt("1st priority = COO China"), _txt("1st priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
        ("p1 = 'SJV'", "id_hsc", _log(_txt("1st priority = SJV"), _txt("1st priority"))
         + f" || CASE WHEN p2 IS NOT NULL THEN {SEP} || 'HSC' ELSE '' END", "CAST(NULL AS STRING)"),
        ("p2 IS NOT NULL", "CASE WHEN p2 = 'SJV' THEN id_hsc ELSE p2_id END",
         _log(_txt("1st priority = not SJV"), _txt("2nd priority"), "p2"), "CAST(NULL AS STRING)"),
        ("TRUE", "p1_id", _log(_txt("1st priority = not SJV"), _txt("2nd priority"), _txt("not found"),
                               _txt("1st priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
    ],
    # Brazil -- also names the component factory
    "X17": [
        (FLEX, "id_sjv", _log(_txt("Flex"), _txt("SJV")), "'SJV'"),
        ("dtp = 1", "id_dtp", _log(_txt("DTP MTL"), _txt("DTP")), "'DTP'"),
        (f"{SINGLE} AND p1 = 'DTC'", "id_dtp", _log(_txt("Single Source"), _txt("1st priority = DTC"), _txt("DTP")), "'DTC'"),
        (f"{SINGLE} AND c1 = 'CN'", "id_sjv", _log(_txt("Single Source"), _txt("1st priority = COO China"), _txt("SJV")),
         "coalesce(p1, '1st priority not found')"),
        (SINGLE, "p1_id", _log(_txt("Single Source"), _txt("1st priority = COO not China")) + f" || {_opt('p1')}", "p1"),
        ("c2 = 'CN'", "id_sjv", _log(_txt("2nd priority = COO China"), _txt("SJV")), "coalesce(p1, '1st priority not found')"),
        ("TRUE", "p2_id", _log(_txt("2nd priority = COO not China")) + f" || {_opt('p2')}", "p2"),
    ],
    # Chile
    "X18": [
        (f"{FLEX} AND p1 = 'ICC'", "p1_id", _log(_txt("Flex")), "CAST(NULL AS STRING)"),
        (f"{FLEX} AND p1 = 'DTC'", "p1_id", _log(_txt("Flex")), "CAST(NULL AS STRING)"),
        (f"{FLEX} AND p1 = 'SJV'", "id_hsc", _log(_txt("Flex")), "CAST(NULL AS STRING)"),
        (f"{SINGLE} AND p1 = 'SJV'", "id_hsc", _log(_txt("Single Source"), _txt("1st priority = SJV"), _txt("HSC")), "CAST(NULL AS STRING)"),
        (SINGLE, "p1_id", _log(_txt("Single Source"), _txt("1st priority = not SJV"), _txt("1st priority")), "CAST(NULL AS STRING)"),
        ("p2 IS NULL AND p1 = 'SJV'", "id_hsc", _log(_txt("2nd priority = 0"), _txt("1st priority = SJV"), _txt("HSC")), "CAST(NULL AS STRING)"),
        ("p2 IS NULL", "p1_id", _log(_txt("2nd priority = 0"), _txt("1st priority = not SJV"), _txt("1st priority")), "CAST(NULL AS STRING)"),
        ("c1 = 'CN'", "p1_id", _log(_txt("1st priority = COO China"), _txt("1st priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
        ("c2 = 'CN'", "p2_id", _log(_txt("2nd priority = COO China"), _txt("Second priority")) + f" || {_opt('p2')}", "CAST(NULL AS STRING)"),
        ("c1 = 'VN'", "p1_id", _log(_txt("1st priority = COO Vietnam"), _txt("First priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
        ("c2 = 'VN'", "CASE WHEN p2 = 'SJV' THEN id_hsc ELSE p2_id END",
         _log(_txt("2nd priority = COO Vietnam"), _txt("Second priority")) + f" || {_opt('p2')}", "CAST(NULL AS STRING)"),
        ("TRUE", "p1_id", _log(_txt("2nd priority = COO not Vietnam"), _txt("First priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
    ],
    # First priority
    "X19": [
        ("TRUE", "p1_id", _log(_txt("First priority")) + f" || {_opt('p1')}", "CAST(NULL AS STRING)"),
    ],
    # Retail quick-turn vendor of (material, region, sold-to party)
    "X05": [
        ("rqt_vendor_id IS NOT NULL", "rqt_vendor_id", f"{SEP} || rqt_vendor || ' RQT MTL'", "CAST(NULL AS STRING)"),
        ("TRUE", "CAST(NULL AS BIGINT)", "''", "CAST(NULL AS STRING)"),
    ],
}

# rules whose missing factory adds ' => Not found' to the log (every rule; the vendor write-back X06 does not)
NOT_FOUND_SUFFIX = _log(_txt("Not found"))


def rule_case(rule: str) -> tuple[str, str, str]:
    """(factory_id, log, component) CASE expressions of one rule; the log ends in ' => Not found'
    when no factory was found."""
    branches = RULES[rule]
    fid = "CASE " + " ".join(f"WHEN {c} THEN {f}" for c, f, _l, _k in branches) + " END"
    log = "CASE " + " ".join(f"WHEN {c} THEN {lg}" for c, _f, lg, _k in branches) + " END"
    comp = "CASE " + " ".join(f"WHEN {c} THEN {k}" for c, _f, _l, k in branches) + " END"
    log = f"({log}) || CASE WHEN ({fid}) IS NULL THEN {NOT_FOUND_SUFFIX} ELSE '' END"
    return fid, log, comp


# ------------------------------------------------------------------------ the routing tree
# party patterns of the regional trees (first match list per leaf), applied case-insensitively
DC_NORA_CASA = [(["CAN%"], "X11"), (["US%"], "X14"), (["Brazil%"], "X17"), (["Chile%"], "X18"), (["MX%", "Mex%"], "X19")]
DC_APAC = [(["China%"], "X16"), (["Korea%"], "X15"), (["India%"], "X12"), (["MY%", "Malaysia%"], "X19"),
           (["Singapore%", "SG%"], "X19"), (["Hong Kong%"], "X19")]
DI_BULK_NORA_CASA = [(["Canada%"], "X11"), (["US%"], "X13"), (["Mexico%"], "X19"), (["International%"], "X19")]
DI_LEAD_NORA_CASA = [(["Canada%"], "X11"), (["US%"], "X13"), (["Mexico%"], "X19")]
DI_APAC = [(["Korea%"], "X15"), (["APAC Direct%"], "X19")]
# fixed values: the programs of the retail quick turn, and the least lead time in days of the routing.
RQT_PROGRAMS = ["Retail Quick Turn", "Retail Quick Turn Built To Forecast"]
LEAD_DAYS = 73


# Path flags: every test of the tree is computed once per row as a boolean column (NULL -> FALSE, as an
# IF on NULL takes its ELSE branch); the statements below are short conjunctions of these flags.
PATH_FLAGS: dict[str, str] = {
    "_f_dc": "sold_to_category = 'DC'",
    "_f_di": "sold_to_category = 'Direct+International'",
    "_f_cd": "sold_to_category = 'Crossdock'",
    "_f_bulk": "(program = 'Bulk Buy' OR demand_category = 'Forecast')",
    "_f_rqt": "program IN (" + ", ".join(_txt(x) for x in RQT_PROGRAMS) + ")",
    "_f_adhoc": "program = 'Ad-Hoc Out of Sync'",
    "_f_sched": "program = 'Scheduled Out of Sync'",
    "_f_avqt": "program = 'Ad Hoc Vendor Quick Turn'",
    "_f_lead": f"(lead >= {LEAD_DAYS} OR (lead < {LEAD_DAYS} AND qt_vendor IS NULL))",
    "_f_emea": "region = 'EMEA'",
    "_f_nc": "region IN ('NORA', 'CASA')",
    "_f_apac": "region = 'APAC'",
}
_PATTERN_FLAGS: dict[tuple[str, ...], str] = {}


def _party_flag(patterns: list[str]) -> str:
    key = tuple(patterns)
    if key not in _PATTERN_FLAGS:
        name = f"_f_party{len(_PATTERN_FLAGS)}"
        _PATTERN_FLAGS[key] = name
        PATH_FLAGS[name] = "(" + " OR ".join(f"party ILIKE {_txt(p)}" for p in patterns) + ")"
    return _PATTERN_FLAGS[key]


def _regional(parent: str, emea_rule: str, nora_casa: list, apac: list) -> list[tuple]:
    st: list[tuple] = []
    emea = f"{parent} AND _f_emea"
    st += [("log", emea, _log(_txt("Region: ") + " || region")), ("call", emea, emea_rule)]
    nc = f"{parent} AND _f_nc"
    st.append(("log", nc, _log(_txt("Region: ") + " || region")))
    for pats, rule in nora_casa:
        c = f"{nc} AND {_party_flag(pats)}"
        st += [("log", c, _log(_txt("Sold to party: ") + " || party")), ("call", c, rule)]
    ap = f"{parent} AND _f_apac"
    st.append(("log", ap, _log(_txt("Region: ") + " || region")))
    for pats, rule in apac:
        c = f"{ap} AND {_party_flag(pats)}"
        st += [("log", c, _log(_txt("Sold to party: ") + " || party")), ("call", c, rule)]
    return st


def _lead_block(cat: str, prog_flag: str, nora_casa: list, apac: list) -> list[tuple]:
    p = f"{cat} AND {prog_flag}"
    lead_ok = f"{p} AND _f_lead"
    st = [("log", p, _log(_txt("Buying program: ") + " || program")),
          ("log", lead_ok, _log(_txt("Lead time: ") + " || CAST(lead AS STRING)"))]
    st += _regional(lead_ok, "X10", nora_casa, apac)
    vqt = f"{p} AND NOT _f_lead"
    st += [("log", vqt, _log(_txt("VQT Vendor"))), ("vqt", vqt, "X06")]
    return st


def routing_program() -> list[tuple]:
    """The routing tree as statements in source order (see module docstring)."""
    st: list[tuple] = []
    st.append(("log", "_f_dc", _log(_txt("Sold to category: ") + " || sold_to_category")))
    st.append(("log", "_f_dc AND _f_bulk", _log(_txt("Buying program: ") + " || program")))
    st += _regional("_f_dc AND _f_bulk", "X10", DC_NORA_CASA, DC_APAC)
    st += [("log", "_f_dc AND _f_rqt", _log(_txt("Buying program: ") + " || program")), ("call", "_f_dc AND _f_rqt", "X05")]
    st += _lead_block("_f_dc", "_f_adhoc", DC_NORA_CASA, DC_APAC)
    st += _lead_block("_f_dc", "_f_sched", DC_NORA_CASA, DC_APAC)

    st.append(("log", "_f_di", _log(_txt("Sold to category: ") + " || sold_to_category")))
    st.append(("log", "_f_di AND _f_bulk", _log(_txt("Buying program: ") + " || program")))
    st += _regional("_f_di AND _f_bulk", "X19", DI_BULK_NORA_CASA, DI_APAC)
    st += [("log", "_f_di AND _f_rqt", _log(_txt("Buying program: ") + " || program")), ("call", "_f_di AND _f_rqt", "X05")]
    st += _lead_block("_f_di", "_f_avqt", DI_LEAD_NORA_CASA, DI_APAC)
    st += _lead_block("_f_di", "_f_sched", DI_LEAD_NORA_CASA, DI_APAC)

    st.append(("call", "_f_cd AND _f_bulk AND _f_emea", "X10"))
    return st


# When no text was logged on the way, the row's four attributes are logged instead
FALLBACK_LOG = (_log(_txt("Sold to category: ") + " || sold_to_category", _txt("Buying program: ") + " || program",
                     _txt("Region: ") + " || region", _txt("Sold to party: ") + " || party"))


def decision_steps(dialect: str = "spark") -> tuple[list[tuple[str, str]], tuple[str, str, str]]:
    """Compile the routing program into steps ``(column, SQL expression)`` over the feature columns,
    and the three final expressions (factory id, decision log, component factory).  The first steps
    are the path flags; later steps and the final expressions only read flags and rule outputs.

    Each rule's outputs are computed once per row (``_r_<rule>_*``).  Every guarded log append becomes
    one element of the array ``_apps`` (NULL when its condition is false); the running log at a call
    is the join of the first k elements.  So the whole tree is three projections, whatever its size.
    The final log is the log of the last call that fired (or the fallback text); the factory and
    component come from the last call that fired *and* found a factory."""
    program = routing_program()
    flags = [(n, f"coalesce({e}, FALSE)") for n, e in PATH_FLAGS.items()]
    steps: list[tuple[str, str]] = []
    used = sorted({arg for kind, _c, arg in program if kind == "call"})
    for r in used:
        fid, log, comp = rule_case(r)
        steps += [(f"_r_{r}_fid", fid), (f"_r_{r}_log", log), (f"_r_{r}_comp", comp)]
    apps: list[str] = []
    calls: list[tuple[str, int, str]] = []        # (condition, appends before it, rule)
    for kind, cond, arg in program:
        if kind == "log":
            apps.append(f"CASE WHEN {cond} THEN {arg} END")
        else:
            calls.append((cond, len(apps), "X06" if kind == "vqt" else arg))
    n_apps = len(apps)

    def join_prefix(k: str) -> str:
        if dialect == "spark":
            return f"array_join(slice(_apps, 1, {k}), '')"
        return f"coalesce(array_to_string(_apps[1:{k}], ''), '')"

    fid_of = {r: f"_r_{r}_fid" for r in used}
    fid_of["X06"] = "qt_vendor_id"
    rev = calls[::-1]
    last_rule = "CASE " + " ".join(f"WHEN {c} THEN {_txt(r)}" for c, _k, r in rev) + " END"
    last_k = "CASE " + " ".join(f"WHEN {c} THEN {k}" for c, k, _r in rev) + " END"
    found_rule = "CASE " + " ".join(f"WHEN {c} AND {fid_of[r]} IS NOT NULL THEN {_txt(r)}" for c, _k, r in rev) + " END"
    arr = (lambda xs: "array(" + ", ".join(xs) + ")") if dialect == "spark" else (lambda xs: "[" + ", ".join(xs) + "]")
    steps.append(("_apps", arr(apps) if apps else arr(["''"])))
    steps.append(("_last_rule", last_rule))
    steps.append(("_last_k", last_k))
    steps.append(("_found_rule", found_rule))
    rule_log = "CASE _last_rule " + " ".join(f"WHEN {_txt(r)} THEN _r_{r}_log" for r in used) + " ELSE '' END"
    log = (f"CASE WHEN _last_rule IS NOT NULL THEN {join_prefix('_last_k')} || {rule_log} "
           f"WHEN {join_prefix(str(n_apps))} = '' THEN {FALLBACK_LOG} END")
    fid = "CASE _found_rule " + " ".join(f"WHEN {_txt(r)} THEN {fid_of[r]}" for r in list(used) + ["X06"]) + " END"
    comp = "CASE _found_rule " + " ".join(f"WHEN {_txt(r)} THEN _r_{r}_comp" for r in used) + " END"
    return flags + steps, (fid, log, comp)


# ------------------------------------------------------------ constrained pass, scenario B
# fixed values: sold-to parties the original lists as (non-)duty beneficial per overloaded factory.
NON_DUTY_CLK = ["APAC Direct", "Brazil DC", "Canada Direct", "Chile DC", "China DC", "EU Direct", "Hong Kong DC",
                "International", "Korea Direct", "Malaysia DC", "Mexico DC", "Mexico Direct", "Singapore DC", "US DC",
                "US Direct", "US Direct - Retail", "US Direct - WHS", "US RT", "US WS"]
NON_DUTY_OTHERS = ["APAC Direct", "Brazil DC", "Canada DC", "Canada Direct", "EU Crossdock", "EU DC", "EU Direct",
                   "Hong Kong DC", "India DC", "International", "Korea DC", "Korea Direct", "Malaysia DC", "Mexico DC",
                   "Mexico Direct", "Singapore DC", "US DC", "US Direct", "US Direct - Retail", "US Direct - WHS",
                   "US RT", "US WS"]
DUTY_DTP = ["EU DC", "EU Crossdock"]
SCENARIO_B_FACTORIES = ["CLK", "DTC", "DTP", "FSC", "HSC", "ICC", "SJD", "SJV"]

# Dual source -- two sources, two or more flags, Flex, or a flag set while the second priority is not
# one of the flagged factories (a missing second priority counts as "not among them").
DUAL = ("(n_src = 2 OR (clk + dtp + sjd) >= 2 OR flex OR ((clk = 1 OR dtp = 1 OR sjd = 1) AND NOT coalesce("
        "(p2 = 'CLK' AND clk = 1) OR (p2 = 'DTP' AND dtp = 1) OR (p2 = 'SJD' AND sjd = 1), FALSE)))")


def _inlist(xs: list[str]) -> str:
    return "party IN (" + ", ".join(_txt(x) for x in xs) + ")"


# A rule is a tree over the features of a unit: a leaf logs and may set the target (to no factory, if that is not found),
# ``when`` branches, ``both`` runs one tree after the other.  Trees compile to three SQL texts: whether the target was set,
# its id, and the log.
def leaf(*log: str, to: str | None = None) -> tuple[str, str, str]:
    return ("TRUE" if to else "FALSE"), to or "CAST(NULL AS BIGINT)", _log(*log) if log else "''"


def when(*branches, otherwise=None) -> tuple[str, str, str]:
    """``branches``: (condition, tree) pairs, the first that holds runs."""
    last = otherwise or leaf()
    return tuple("CASE " + " ".join(f"WHEN {c} THEN {t[i]}" for c, t in branches) + f" ELSE {last[i]} END" for i in range(3))


def both(first, then) -> tuple[str, str, str]:
    return (f"({first[0]} OR {then[0]})", f"CASE WHEN {then[0]} THEN {then[1]} ELSE {first[1]} END", f"{first[2]} || {then[2]}")


def _party(*names: str) -> str:
    return "coalesce(" + _inlist(list(names)) + ", FALSE)"


def unit_features() -> dict[str, str]:
    """Columns that the rules read several times: dual source (X30), Flex, and the quick-turn branch."""
    was_set, fid, log = quick_turn()
    return {"_dual": f"coalesce({DUAL}, FALSE)", "_flex": "coalesce(flex, FALSE)", "_q_set": was_set, "_q_id": fid, "_q_log": log}


QUICK_TURN = ("_q_set", "_q_id", "_q_log")


def quick_turn():
    """The vendor of a retail quick-turn material, by the region of the overloaded factory (``f_region``)."""
    vendor = leaf("rqt_vendor", to="rqt_vendor_id")
    pooled = "rqt_vendor IN ('DTC', 'SJV')"
    return both(leaf(_txt("RQT MTL")), when(
        ("f_region = 'EMEA'", when((pooled, leaf(_txt("DTC"), to="id_dtc")), otherwise=vendor)),
        ("f_region IN ('NORA', 'CASA')", when((pooled, leaf(_txt("SJV"), to="id_sjv")), otherwise=vendor)),
        ("f_region = 'APAC'", when(("party ILIKE 'China%'", leaf(_txt("HSC"), to="id_hsc")), otherwise=vendor))))


def _dual(code: str):
    """The second source, else the first, else the factory stays."""
    log = _txt("Dual Source"), _txt("2nd priority")
    missing = *log, _txt("Not found"), _txt("1st priority")
    return when(("p2 IS NOT NULL", leaf(*log, "p2", to="p2_id")), ("p1 IS NOT NULL", leaf(*missing, "p1", to="p1_id")),
                otherwise=leaf(*missing, _txt("Not found"), _txt(code)))


def _clk_dual(*before: str):
    """CLK's own wording of it; without either source the target is no factory."""
    first = *before, _txt("2nd priority not found"), _txt("1st priority")
    return when(("p2 IS NOT NULL", leaf(*before, "'2nd priority' || p2", to="p2_id")), ("p1 IS NOT NULL", leaf(*first, "p1", to="p1_id")),
                otherwise=leaf(*first, to="p1_id"))


def _first(*before: str):
    """The first source; no factory without one."""
    return when(("p1 IS NOT NULL", leaf(*before, "p1", to="p1_id")), otherwise=leaf(*before, to="p1_id"))


def _named(kind: str, tree):
    return both(leaf(f"'{kind}: ' || party"), tree)


def _stay_or_first(code: str, to: str):
    """Loop 2 of DTC and ICC: a Flex unit whose first source is another factory goes to ``to``."""
    return when(("in_rqt", QUICK_TURN),
                (f"_flex AND coalesce(p1 = {_txt(code)}, FALSE)", leaf(_txt("Flex"), _txt(f"1st priority = {code}"), _txt(code))),
                ("_flex", leaf(_txt("Flex"), _txt(f"1st priority = not {code}"), _txt("SJV"), to=to)),
                otherwise=leaf(_txt("Not Flex"), _txt(code)))


def _sjv(loop: int):
    """SJV: the quick-turn vendor is named first, then the sources decide."""
    kind = "Duty Beneficial" if loop == 5 else "Non-duty Beneficial"
    not_flex = _first(_txt("Not Flex"), _txt("1st priority"))
    if loop <= 2:
        flex = both(when(("p1 = 'SJV'", leaf(_txt("1st priority = SJV"), _txt("HSC"), to="id_hsc")),
                         otherwise=_first(_txt("1st priority = not SJV"), _txt("1st priority"))), leaf(_txt("Flex"), _txt("SJV")))
    elif loop == 5:
        flex = leaf(_txt("Flex"), _txt("SJV"))
    else:
        flex = both(leaf(_txt("Flex")), _dual("SJV"))
    parties = {1: ("Chile DC",), 2: ("China DC",), 3: ("India DC",), 4: ("EU DC", "EU Crossdock"), 5: ("Korea DC", "Korea Direct")}[loop]
    return when((_party(*parties), _named(kind, both(when(("in_rqt", QUICK_TURN)), when(("_flex", flex), otherwise=not_flex)))))


def scenario_b(code: str, loop: int = 1) -> tuple[str, str, str]:
    """X32-X39, the rule of an overloaded factory ``code`` in a loop: (whether it set the target, target id, log)."""
    second = ("Chile DC", "China DC")
    if code == "CLK" and loop == 1:
        tree = when((_party(*NON_DUTY_CLK), _named("Non-duty Beneficial", when(("_dual", _clk_dual(_txt("Dual Source")))))),
                    otherwise=leaf(_txt("not Non-Duty Beneficial")))
    elif code == "CLK" and loop == 2:
        tree = when(
            (_party("EU DC", "EU Crossdock"), _named("Duty Beneficial", when(
                ("dtp = 1", leaf(_txt("DTP MTL"), to="id_dtp")), otherwise=leaf(_txt("Non DTP MTL"), _txt("CLK"))))),
            (_party("India DC", "Canada DC", "Canada Direct", "Korea DC"), _named("Duty Beneficial", when(
                ("in_rqt", QUICK_TURN), ("_dual AND _flex", leaf(_txt("Dual Source"), _txt("Flex"), _txt("SJV"), to="id_sjv")),
                ("_dual", _clk_dual(_txt("Dual Source"), _txt("Not Flex"))), otherwise=leaf(_txt("Single Source"), _txt("CLK"))))))
    elif code in ("DTC", "FSC", "HSC", "ICC") and loop == 1:
        tree = when((_party(*NON_DUTY_OTHERS), _named("Non-duty Beneficial", when(
            ("_flex", leaf(_txt("Flex"), _txt("SJV"), to="id_sjv")), ("_dual", both(leaf(_txt("Not Flex")), _dual(code))),
            otherwise=leaf(_txt("Not Flex"), _txt(code))))))
    elif code in ("DTC", "ICC") and loop == 2:
        tree = when((_party(*second), _named("Duty Beneficial", _stay_or_first(code, "p1_id" if code == "DTC" else "id_sjv"))))
    elif code in ("FSC", "HSC") and loop == 2:
        # the log says Flex on both branches
        tree = when((_party(*second), _named("Duty Beneficial", when(
            ("in_rqt", QUICK_TURN), ("_flex", leaf(_txt("Flex"), _txt("SJV"), to="id_sjv")), otherwise=leaf(_txt("Flex"), _txt(code))))))
    elif code == "DTP" and loop == 1:
        tree = when((_party(*DUTY_DTP), _named("Duty Beneficial", when(
            ("clk = 1", leaf(_txt("CLK MTL"), to="id_clk")), ("_dual", _dual("DTP"))))))
    elif code == "DTP" and loop == 2:
        tree = when((_party("Korea DC"), _named("Duty Beneficial", when(
            ("in_rqt", QUICK_TURN), ("_flex", leaf(_txt("Flex"), _txt("SJV"), to="id_sjv")), otherwise=_first(_txt("Not Flex"), _txt("First priority"))))))
    elif code == "SJD" and loop == 1:
        tree = when((_party("US Direct"), _named("Duty Beneficial", when(
            ("in_rqt", QUICK_TURN), otherwise=leaf(_txt("not RQT MTL"), _txt("SJV"), to="id_sjv")))))
    elif code == "SJD" and loop == 2:
        tree = when((_party("US DC"), _named("Duty Beneficial", leaf(_txt("not RQT MTL"), _txt("SJD")))))
    elif code == "SJV" and loop <= 5:
        tree = _sjv(loop)
    else:
        return leaf()
    return both(leaf(_txt(f"[loop: {loop}]")), tree)


def constrained_target(loop: int = 1) -> tuple[str, str, str]:
    """(whether the target was set, target id, rule log) of an overloaded unit by its factory's short name (``fname``)."""
    own = {c: scenario_b(c, loop) for c in SCENARIO_B_FACTORIES}
    return tuple("CASE " + " ".join(f"WHEN fname = {_txt(c)} THEN {t[i]}" for c, t in own.items())
                 + f" ELSE {('FALSE', 'CAST(NULL AS BIGINT)', repr(''))[i]} END" for i in range(3))
