"""Single events to composite events.

A definition combines sub-rules: counted details (so many hits of an event or field rule) and
context lookups (vulnerabilities, traffic, asset OS, threat intelligence). Its counters are cleared
when the definition fires, not when a single counter is full. That is expressed with one number per
event, the *floor*: the definition fires at the event if its last fire lies before the floor. AND
of sub-rules is the least of their floors and OR the greatest, so the ordered fold of sub-rules
yields the floor of the definition, and ``fire_chain`` does the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow.functions.predicates import (
    CONDITION_FIELDS, RULE_FIELDS, condition_holds, method_holds, rule_field_map)
from secflow.functions.search import count_at_most
from secflow.functions.text import stable_id
from secflow.operators.events import FLOW_APP, literal_condition
from secflow.operators.parse import condition_atoms
from secflow.operators.threshold import fire_chain, running, threshold_fire, threshold_members
from secflow.plans.physical import broadcast_if_bounded, checkpointed, collect_to_compile, evaluated_once

# Sub-rule kinds.
DETAIL = "T_SIEM_MEDETAIL"
LEAK = "T_SIEM_MEDETAIL3"
INTEL = "T_SIEM_MEDETAIL4"
ASSET = "T_SIEM_MEDETAIL5"
FLOW = "T_SIEM_MEDETAIL6"

# Statistics period code -> seconds.
PERIODS = {1: 10, 2: 60, 3: 3600}

ALWAYS = 2**62  # floor of a sub-rule that holds whatever the last fire
NEVER = 0


@dataclass
class CompositeRules:
    """Rule tables: definitions, sub-rules, and the detail table of each sub-rule kind."""

    defs: DataFrame
    subs: DataFrame
    details: DataFrame
    leaks: DataFrame
    flows: DataFrame
    assets: DataFrame
    intels: DataFrame


@dataclass
class Context:
    """Lookup tables: vulnerability scans, traffic statistics, asset OS by address, attack addresses."""

    scans: DataFrame
    flow_stats: DataFrame
    assets: DataFrame
    asset_ips: DataFrame
    intel: DataFrame


def active_subs(rules: CompositeRules) -> DataFrame:
    defs = rules.defs.where("status = 1").select(
        F.col("record_id").alias("def_id"), F.col("name").alias("def_name"))
    subs = rules.subs.where("status = 1").select(
        F.col("record_id").alias("sub_id"), F.trim("me_define_id").alias("sub_def_id"),
        F.col("op").cast("int").alias("op"), F.upper("obj_table").alias("obj_table"))
    return subs.join(defs, F.col("sub_def_id") == F.col("def_id")).drop("sub_def_id")


def detail_rules(rules: CompositeRules) -> DataFrame:
    """Counted details flattened to one row each."""
    details = rules.details.select(
        F.col("record_id").alias("detail_id"), F.col("med_id"), F.col("event_id").alias("watched_id"),
        F.col("time_limit").cast("long").alias("time_limit"), F.col("times").cast("long").alias("times"),
        F.col("flag").cast("int").alias("flag"), F.lower(F.trim("field_name")).alias("field_name"), F.col("field_op"),
        F.col("field_value"))
    return (
        active_subs(rules).where(F.col("obj_table") == DETAIL)
        .join(details, F.col("sub_id") == F.col("med_id")).drop("med_id"))


_HIT = ["def_id", "sub_id", "detail_id", "times", "time_limit"]
_HIT_TYPE = "array<struct<def_id:string,sub_id:string,detail_id:string,times:bigint,time_limit:bigint>>"


def _hit_struct() -> Column:
    return F.struct(*[F.col(c).cast("string").alias(c) for c in _HIT[:3]], *_HIT[3:])


def event_hits(
    events: DataFrame, rules: CompositeRules, strict: bool = True, compile_rows: int = 0
) -> DataFrame:
    """Events plus ``hits``, the counted details each satisfies; events without any are dropped.

    ``events`` carry their log as the struct ``log``. Event rules are a hash lookup; field rules look
    at the log of built-in events and are evaluated in the scan.
    """
    flat = detail_rules(rules)
    by_event = (
        flat.where("flag = 0").groupBy("watched_id")
        .agg(F.collect_list(_hit_struct()).alias("event_rule_hits")))
    joined = events.join(
        broadcast_if_bounded(by_event), F.col("event_rule_id") == F.col("watched_id"), "left").drop("watched_id")
    field_rules = flat.where("flag = 1")
    if not compile_rows:
        every = field_rules.agg(F.collect_list(
            F.struct(*_HIT, "field_name", "field_op",
                     F.coalesce("field_value", F.lit("")).alias("field_value"))).alias("rules"))
        joined = joined.withColumn("rules", every.scalar()).withColumn("values", rule_field_map("log."))
        satisfied = F.filter("rules", lambda r: F.coalesce(
            method_holds(r["field_op"], r["field_value"], F.lit(""), F.col("values")[r["field_name"]], strict)
            & F.col("values")[r["field_name"]].isNotNull(), F.lit(False)))
        by_field = F.transform(satisfied, lambda r: F.struct(*[r[c].alias(c) for c in _HIT]))
    else:
        candidates = [
            F.when(
                literal_condition(r.field_name, r.field_op, r.field_value, "", strict, "log."),
                F.struct(*[F.lit(r[c]).cast("string").alias(c) for c in _HIT[:3]],
                         *[F.lit(r[c]).cast("long").alias(c) for c in _HIT[3:]]))
            for r in collect_to_compile(field_rules, compile_rows)]
        by_field = F.filter(F.array(*candidates), lambda h: h.isNotNull()) if candidates else F.array()
    by_field = F.when(F.col("is_inner") == "1", by_field.cast(_HIT_TYPE)).otherwise(F.array().cast(_HIT_TYPE))
    hits = F.concat(F.coalesce(F.col("event_rule_hits"), F.array().cast(_HIT_TYPE)), by_field)
    return evaluated_once(joined, "hits", hits).where(F.size("hits") > 0).select(*events.columns, "hits")


def detail_hits(events: DataFrame, rules: CompositeRules, strict: bool = True) -> DataFrame:
    """One row per (event, satisfied detail)."""
    exploded = event_hits(events, rules, strict).select(
        "event_result_id", F.col("open_time").alias("ts"), F.explode("hits").alias("hit"))
    return exploded.select("hit.*", "event_result_id", "ts")


def detail_fires(hits: DataFrame, mode: str = "cumulative") -> DataFrame:
    """Hits at which the counter of their detail is reached."""
    return threshold_fire(hits, "detail_id", "ts", "event_result_id", "times", "time_limit", mode)


def detail_members(hits: DataFrame, events: DataFrame) -> DataFrame:
    """Events behind each full counter, looked up by id."""
    numbered = running(hits, ["detail_id"], ["ts", "event_result_id"])
    members = threshold_members(numbered, "detail_id", "times")
    looked_up = events.select(
        F.col("event_result_id").alias("member_id"), "event_rule_name", "event_rule_level", "proto",
        "source_ip", "source_port", "dest_ip", "dest_port")
    return members.join(looked_up, F.col("event_result_id") == F.col("member_id")).drop("member_id")


# --- context ------------------------------------------------------------------------------------


def leak_flags(events: DataFrame, scans: DataFrame, cve: str = "cve") -> DataFrame:
    """Add has_leak, has_cve and has_port: the destination has a scan result / with the event's CVE / port.

    Scans become one row per address with its CVEs and ports, so one join answers all three questions
    and keeps one row per event. An address holds each CVE and port once, however often it was scanned.
    """
    known = scans.where("ne_ip IS NOT NULL").groupBy(F.lower("ne_ip").alias("_ip")).agg(
        F.sort_array(F.collect_set(F.lower("leak_cve"))).alias("_cves"),
        F.sort_array(F.collect_set(F.lower(F.col("leak_port").cast("string")))).alias("_ports"))
    joined = events.join(broadcast_if_bounded(known), F.lower("dest_ip") == F.col("_ip"), "left")
    has = lambda values, key: F.coalesce(F.array_contains(values, F.lower(key)), F.lit(False))
    return joined.withColumns({
        "has_leak": F.col("_ip").isNotNull(), "has_cve": has("_cves", cve), "has_port": has("_ports", "dest_port"),
    }).drop("_ip", "_cves", "_ports")


def leak_holds(rule) -> Column:
    """Whether an event with leak flags satisfies one vulnerability rule."""
    return (
        ((rule["cve_match"] == 1) & F.col("has_cve"))
        | ((rule["leak_match"] == 1) & F.col("has_leak"))
        | ((rule["port_match"] == 1) & F.col("has_port")))


def intel_flag(events: DataFrame, intel: DataFrame) -> DataFrame:
    """Add in_intel: the source address is a known attack address."""
    known = intel.select(F.trim("attack_ip").alias("_ip")).where("_ip is not null").distinct()
    known = broadcast_if_bounded(known.withColumn("in_intel", F.lit(True)))
    joined = events.join(known, F.trim("source_ip") == F.col("_ip"), "left").drop("_ip")
    return joined.withColumn("in_intel", F.coalesce("in_intel", F.lit(False)))


def asset_os(assets: DataFrame, asset_ips: DataFrame) -> DataFrame:
    """OS of each asset address; the asset with the highest id decides when an address has several."""
    ips = asset_ips.select(F.col("ne_id").alias("ip_ne_id"), F.trim("device_ip").alias("asset_ip"))
    return (
        assets.join(ips, F.col("ne_id") == F.col("ip_ne_id"))
        .groupBy("asset_ip").agg(F.max_by("os_id", "ne_id").alias("os_id")))


def resolve_asset_rules(rules: DataFrame, assets: DataFrame, asset_ips: DataFrame) -> DataFrame:
    """Settle the OS part of asset rules on the rule side; unknown addresses count as OS 1.

    A rule compares the event's address with a fixed one, so the OS of that address is a property of
    the rule and events need no lookup at all.
    """
    os = asset_os(assets, asset_ips)
    return rules.join(os, F.trim("ip_addr") == F.col("asset_ip"), "left").select(
        *[c for c in rules.columns if c not in ("ip_type", "ip_addr", "os")],
        F.col("ip_type").cast("int").alias("ip_type"), F.trim("ip_addr").alias("ip_addr"),
        (F.coalesce(F.col("os_id").cast("int"), F.lit(1)) == F.col("os").cast("int")).alias("os_ok"))


def asset_holds(rule) -> Column:
    ip = F.when(rule["ip_type"] == 2, F.trim("source_ip")).when(rule["ip_type"] == 3, F.trim("dest_ip"))
    return F.coalesce(rule["os_ok"] & (ip == rule["ip_addr"]), F.lit(False))


def condition_match(events: DataFrame, flow_rules: DataFrame) -> DataFrame:
    """(event, rule) pairs whose condition expression holds; blank expressions always do."""
    packed = _flow_rules(flow_rules).agg(F.collect_list(F.struct("med_id", "rule_id", "atoms")).alias("rules"))
    tested = events.withColumn("rules", packed.scalar()).withColumn("values", _condition_values())
    held = F.filter("rules", lambda r: F.forall(r["atoms"], lambda a: _atom_holds(a, F.col("values"))))
    return tested.select("event_result_id", F.explode(held).alias("r")).select(
        "event_result_id", F.col("r.med_id").alias("med_id"), F.col("r.rule_id").alias("rule_id"))


def _condition_values() -> Column:
    names = sorted(CONDITION_FIELDS)
    return F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]),
        F.array(*[F.coalesce(F.col(RULE_FIELDS[n]), F.lit(" ")) for n in names]))


def _atom_holds(atom: Column, values: Column) -> Column:
    value = values[atom["atom_field"]]
    return value.isNotNull() & condition_holds(atom["atom_op"], value, atom["atom_value"])


def _flow_rules(flows: DataFrame) -> DataFrame:
    """Traffic rules with parsed atoms and the period in seconds."""
    rules = flows.select(
        F.col("med_id"), F.col("record_id").alias("rule_id"), F.col("statis_period").cast("int").alias("period"),
        F.col("flow_limit").cast("long").alias("flow_limit"), F.col("condition_exp"))
    atoms = condition_atoms(rules.select("rule_id", "condition_exp")).groupBy("rule_id").agg(
        F.collect_list(F.struct("atom_field", "atom_op", "atom_value")).alias("atoms"))
    seconds = F.lit(None).cast("long")
    for code, length in PERIODS.items():
        seconds = F.when(F.col("period") == code, F.lit(length).cast("long")).otherwise(seconds)
    none = F.array().cast("array<struct<atom_field:string,atom_op:string,atom_value:string>>")
    return rules.join(atoms, "rule_id", "left").select(
        "med_id", "rule_id", seconds.alias("seconds"), "flow_limit", F.coalesce("atoms", none).alias("atoms"))


def _bucket(time: Column, seconds: int) -> Column:
    micros, width = F.unix_micros(time), F.lit(seconds * 1_000_000)
    return ((micros - F.pmod(micros, width)) / width).cast("long")


def asof_buckets(stats: DataFrame, seconds: int) -> DataFrame:
    """One row per bucket from the first statistic to the last: its statistics in order, and the one before it.

    Buckets without statistics have an empty array, so an equi-join finds the latest one of any age.
    """
    value = F.struct(F.col("stat_time").alias("t"), F.col("bytes").cast("long").alias("b"))
    reduced = stats.where("stat_time IS NOT NULL").groupBy("stat_time").agg(F.max("bytes").alias("bytes"))
    held = reduced.groupBy(_bucket(F.col("stat_time"), seconds).alias("at")).agg(
        F.sort_array(F.collect_list(value)).alias("seen"))  # distinct times of one bucket
    # over buckets, not statistics: one row per bucket of time
    in_order = Window.orderBy("at")
    linked = held.select(
        "at", "seen", F.element_at("seen", -1).alias("last"), F.lag(F.element_at("seen", -1)).over(in_order).alias("earlier"),
        F.lead("at").over(in_order).alias("next"))
    filled = linked.withColumn("bucket", F.explode(F.sequence("at", F.coalesce(F.col("next") - 1, F.col("at")))))
    own = F.col("bucket") == F.col("at")
    return filled.select(
        "bucket", F.when(own, F.col("seen")).otherwise(F.slice("seen", 1, 0)).alias("seen"),
        F.when(own, F.col("earlier")).otherwise(F.col("last")).alias("earlier"))


def flow_asof(events: DataFrame, stats: DataFrame, ts: str = "open_time", seconds: int = 3600) -> DataFrame:
    """Add the latest traffic statistic at or before each event: stat_time and stat_bytes.

    Statistics are put into buckets of time, which events join on their own bucket; the latest one is
    then found inside the row. Events stay where they are while the buckets are small enough to be
    broadcast. Events after the last bucket take the last statistic.
    """
    buckets = checkpointed(asof_buckets(stats, seconds))  # read twice
    last = buckets.agg(F.max_by(
        F.struct("bucket", F.coalesce(F.try_element_at("seen", F.lit(-1)), F.col("earlier")).alias("stat")), "bucket").alias("last"))
    joined = events.withColumn("_last", last.scalar()).join(
        broadcast_if_bounded(buckets), _bucket(F.col(ts), seconds) == F.col("bucket"), "left")
    passed = count_at_most("seen", "t", f"`{ts}`")
    found = (
        F.when(_bucket(F.col(ts), seconds) > F.col("_last.bucket"), F.col("_last.stat"))
        .otherwise(F.coalesce(F.get("seen", passed - 1), F.col("earlier"))))  # one search; none passed is place -1
    looked_up = evaluated_once(joined, "_stat", found)
    return looked_up.select(
        *events.columns, F.col("_stat.t").alias("stat_time"), F.col("_stat.b").alias("stat_bytes"))


def flow_holds(rule, values: Column, ts: str = "open_time") -> Column:
    """Latest statistic lies within the rule's period and below its limit, and all atoms hold."""
    age = F.unix_micros(F.col(ts)) - F.unix_micros("stat_time")
    return F.coalesce(
        (age <= rule["seconds"] * 1_000_000) & (rule["flow_limit"] > F.col("stat_bytes"))
        & F.forall(rule["atoms"], lambda a: _atom_holds(a, values)), F.lit(False))


# --- fold ---------------------------------------------------------------------------------------


def _grouped(rules: DataFrame, name: str, *columns: str) -> DataFrame:
    return rules.groupBy("med_id").agg(F.collect_list(F.struct(*columns)).alias(name)).withColumnRenamed(
        "med_id", f"_{name}_med")


def definition_rules(rules: CompositeRules, context: Context) -> DataFrame:
    """One row per definition with its sub-rules as an array, in evaluation order."""
    int_of = lambda c: F.col(c).cast("int").alias(c)
    parts = {
        "leak_rules": _grouped(rules.leaks.select(
            "med_id", int_of("cve_match"), int_of("leak_match"), int_of("port_match")),
            "leak_rules", "cve_match", "leak_match", "port_match"),
        "flow_rules": _grouped(_flow_rules(rules.flows), "flow_rules", "seconds", "flow_limit", "atoms"),
        "asset_rules": _grouped(
            resolve_asset_rules(rules.assets, context.assets, context.asset_ips),
            "asset_rules", "ip_type", "ip_addr", "os_ok"),
        "intel_rules": _grouped(rules.intels.select("med_id", int_of("ip_match")), "intel_rules", "ip_match"),
    }
    needed = detail_rules(rules).groupBy(F.col("sub_id").alias("_need_sub")).agg(F.count("*").alias("needed"))
    subs = active_subs(rules).join(needed, F.col("sub_id") == F.col("_need_sub"), "left").drop("_need_sub")
    for name, part in parts.items():
        subs = subs.join(part, F.col("sub_id") == F.col(f"_{name}_med"), "left").drop(f"_{name}_med")
    sub = F.struct("obj_table", "sub_id", "op", F.coalesce("needed", F.lit(0)).alias("needed"), *parts)
    # sub-rules are put in order by (kind, id); the rule arrays take no part in the ordering
    compare = lambda a, b: (
        F.when(a["obj_table"] < b["obj_table"], -1).when(a["obj_table"] > b["obj_table"], 1)
        .when(a["sub_id"] < b["sub_id"], -1).when(a["sub_id"] > b["sub_id"], 1).otherwise(0))
    return subs.groupBy("def_id").agg(
        F.max("def_name").alias("def_name"), F.array_sort(F.collect_list(sub), compare).alias("subs"))


def fold_subs(subs: Column, floor_of) -> Column:
    """Ordered fold starting from TRUE: op 1 is OR, every other op is AND."""
    return F.aggregate(
        subs, F.lit(ALWAYS).cast("long"),
        lambda acc, s: F.when(s["op"] == 1, F.greatest(acc, floor_of(s))).otherwise(F.least(acc, floor_of(s))))


def _sub_floor(values: Column):
    always, never = F.lit(ALWAYS).cast("long"), F.lit(NEVER).cast("long")
    whole = lambda ok: F.when(ok, always).otherwise(never)
    every = lambda rules, ok: F.coalesce(F.forall(rules, ok), F.lit(True))

    def leak(rule):
        latest = lambda switch, at: F.when(rule[switch] == 1, F.col(at)).otherwise(never)
        return F.greatest(
            latest("cve_match", "last_cve"), latest("leak_match", "last_leak"), latest("port_match", "last_port"))

    def floor(sub):
        mine = F.filter("floors", lambda f: f["sub_id"] == sub["sub_id"])
        reached = F.aggregate(mine, always, lambda acc, f: F.least(acc, f["floor"]))
        counted = F.when(sub["needed"] == 0, always).when(F.size(mine) == sub["needed"], reached).otherwise(never)
        leaks = F.coalesce(
            F.aggregate(sub["leak_rules"], always, lambda acc, r: F.least(acc, leak(r))), always)
        return (
            F.when(sub["obj_table"] == DETAIL, counted)
            .when(sub["obj_table"] == LEAK, leaks)
            .when(sub["obj_table"] == FLOW, whole(every(sub["flow_rules"], lambda r: flow_holds(r, values, "ts"))))
            .when(sub["obj_table"] == ASSET, whole(every(sub["asset_rules"], asset_holds)))
            .when(sub["obj_table"] == INTEL, whole(
                every(sub["intel_rules"], lambda r: (r["ip_match"] == 1) & F.col("in_intel"))))
            .otherwise(never))

    return floor


_ADDRESS = ["source_ip", "source_port", "dest_ip", "dest_port"]
_LOGGED = ["event_level", "app_proto", "url", "get_parameter", "proto", "open_time"]


def _flow_detail() -> Column:
    """What a composite keeps of a flow-derived event; NULL for others, which keep nothing."""
    return F.when(F.col("log.report_app") == FLOW_APP, F.struct(
        F.col("event_rule_id").alias("event_rule_id"), F.col("log.event_name").alias("event_rule_name"),
        *_ADDRESS, *[F.col(f"log.{c}").alias(c) for c in _LOGGED]))


@dataclass
class Carried:
    """What earlier events left: a row per definition (numbers count its hits from 1) and its counters' open hits."""

    defs: DataFrame
    open_hits: DataFrame


CARRIED_DEFS = "def_id string, hits long, last_fire long, fires long, last_cve long, last_leak long, last_port long"
OPEN_HITS = "def_id string, sub_id string, detail_id string, times long, pos long"
_LATEST = {"last_cve": "has_cve", "last_leak": "has_leak", "last_port": "has_port"}


def definition_hits(
    events: DataFrame, rules: CompositeRules, context: Context, strict: bool = True, cve: str = "cve",
    carried: Carried | None = None,
) -> DataFrame:
    """One row per (definition, event hitting it) with its number ``pos`` and the latest vulnerability hits so far."""
    # only what later steps read is carried through the sorts
    hit = event_hits(events, rules, strict).select(
        "event_result_id", *_ADDRESS, "open_time", "hits", F.col(cve).alias("cve"),
        _flow_detail().alias("flow_detail"))
    hit = flow_asof(intel_flag(leak_flags(hit, context.scans), context.intel), context.flow_stats)
    by_def = hit.select(
        "event_result_id", *_ADDRESS, F.col("open_time").alias("ts"), "hits", "flow_detail",
        "has_leak", "has_cve", "has_port", "in_intel", "stat_time", "stat_bytes",
        F.explode(F.array_distinct(F.transform("hits", lambda h: h["def_id"]))).alias("def_id"))
    numbered = running(by_def, ["def_id"], ["ts", "event_result_id"], "pos", last_where=_LATEST)
    if carried is None:
        return numbered
    before = carried.defs.select(
        F.col("def_id").alias("_bdef"), F.col("hits").alias("_hits"), *[F.col(c).alias(f"_{c}") for c in _LATEST])
    joined = numbered.join(broadcast_if_bounded(before), F.col("def_id") == F.col("_bdef"), "left")
    base = F.coalesce("_hits", F.lit(0))
    latest = {c: F.when(F.col(c) > 0, F.col(c) + base).otherwise(F.coalesce(f"_{c}", F.lit(0))) for c in _LATEST}
    return joined.withColumns({"pos": F.col("pos") + base, **latest}).select(*numbered.columns)


def definition_counts(hits: DataFrame, carried: Carried | None = None) -> DataFrame:
    """One row per (counted detail, hit), numbered by ``rn``; open hits of earlier events come first and have no event."""
    own = F.filter("hits", lambda h: h["def_id"] == F.col("def_id"))
    details = hits.select("def_id", "event_result_id", "pos", F.explode(own).alias("h")).select(
        "def_id", "event_result_id", "pos", "h.sub_id", "h.detail_id", "h.times")
    if carried is not None:
        details = details.unionByName(carried.open_hits.withColumn("event_result_id", F.lit(None).cast("string")))
    return running(details, ["detail_id"], ["pos"])


def counted_floors(
    hits: DataFrame, counted: DataFrame, rules: CompositeRules, context: Context
) -> DataFrame:
    """Definition hits with the definition's ``floor``, NULL where no counter is reached."""
    first = counted.select(F.col("detail_id").alias("_d"), F.col("rn").alias("_rn"), F.col("pos").alias("floor"))
    reached = counted.where("event_result_id IS NOT NULL").join(
        first, (F.col("detail_id") == F.col("_d")) & (F.col("rn") - F.col("times") + 1 == F.col("_rn")))
    floors = reached.groupBy(F.col("def_id").alias("_fdef"), F.col("event_result_id").alias("_fevent")).agg(
        F.collect_list(F.struct("sub_id", "floor")).alias("floors"), F.max("floor").alias("reached"))

    joined = hits.drop("hits").join(
        floors, (F.col("def_id") == F.col("_fdef")) & (F.col("event_result_id") == F.col("_fevent")), "left"
    ).drop("_fdef", "_fevent")
    ruled = joined.join(
        broadcast_if_bounded(definition_rules(rules, context).withColumnRenamed("def_id", "_rdef")),
        F.col("def_id") == F.col("_rdef")).withColumn("values", _condition_values())
    folded = fold_subs(F.col("subs"), _sub_floor(F.col("values")))
    floor = F.when(F.col("reached").isNotNull(), F.least(folded, F.col("reached")))
    return ruled.select(
        "def_id", "def_name", "event_result_id", "ts", "pos", "flow_detail",
        F.when(floor > NEVER, floor).alias("floor"))


def definition_floors(
    events: DataFrame, rules: CompositeRules, context: Context, strict: bool = True, cve: str = "cve"
) -> DataFrame:
    """One row per (definition, event hitting it): its number ``pos`` and the definition's ``floor``.

    The floor is NULL where no counter is reached, since a composite needs events behind it.
    """
    hits = definition_hits(events, rules, context, strict, cve)
    return counted_floors(hits, definition_counts(hits), rules, context)


def composite_events(floors: DataFrame, carried: Carried | None = None) -> DataFrame:
    """Every hit of a definition with ``fired`` and the number of the composite it belongs to.

    With earlier events the chain starts at each definition's last fire: what lies at or before it can
    neither be counted nor fire.
    """
    narrow = floors.select("def_id", "event_result_id", "pos", "floor")
    if carried is None:
        chained = fire_chain(narrow, "def_id", "pos", "floor")
    else:
        before = carried.defs.select(F.col("def_id").alias("_bdef"), "last_fire", "fires")
        joined = narrow.join(broadcast_if_bounded(before), F.col("def_id") == F.col("_bdef"), "left")
        last, fires = F.coalesce("last_fire", F.lit(0)), F.coalesce("fires", F.lit(0))
        shifted = joined.select(
            "def_id", "event_result_id", (F.col("pos") - last).alias("_since"), last.alias("_from"), fires.alias("_earlier"),
            F.when(F.col("floor") > last, F.col("floor") - last).alias("_floor"))
        chained = fire_chain(shifted, "def_id", "_since", "_floor").select(
            "def_id", (F.col("_since") + F.col("_from")).alias("pos"), "fired",
            (F.col("fire_seq") + F.col("_earlier")).alias("fire_seq"))
    marks = chained.select(
        F.col("def_id").alias("_cdef"), F.col("pos").alias("_cpos"), "fired", "fire_seq")
    return floors.join(marks, (F.col("def_id") == F.col("_cdef")) & (F.col("pos") == F.col("_cpos"))).drop(
        "_cdef", "_cpos")


def carry_on(carried: Carried, hits: DataFrame, counted: DataFrame, chained: DataFrame) -> Carried:
    """What is left for later events: last fires, and of each counter the hits after it that can still count."""
    now = chained.groupBy(F.col("def_id").alias("_d")).agg(
        F.max("pos").alias("_hits"), F.max(F.when(F.col("fired"), F.col("pos"))).alias("_last"),
        F.sum(F.col("fired").cast("long")).alias("_fired"))
    latest = hits.groupBy(F.col("def_id").alias("_l")).agg(*[F.max(c).alias(f"_{c}") for c in _LATEST])
    seen = now.join(latest, F.col("_d") == F.col("_l")).drop("_l")
    merged = carried.defs.join(seen, F.col("def_id") == F.col("_d"), "full")
    either = lambda new, old: F.coalesce(F.col(new), F.col(old), F.lit(0))
    defs = merged.select(
        F.coalesce("def_id", "_d").alias("def_id"), either("_hits", "hits").alias("hits"),
        either("_last", "last_fire").alias("last_fire"),
        (F.coalesce("fires", F.lit(0)) + F.coalesce("_fired", F.lit(0))).alias("fires"),
        *[either(f"_{c}", c).alias(c) for c in _LATEST])
    totals = counted.groupBy(F.col("detail_id").alias("_t")).agg(F.max("rn").alias("_total"))
    fires = defs.select(F.col("def_id").alias("_f"), F.col("last_fire").alias("_from"))
    still = counted.join(broadcast_if_bounded(totals), F.col("detail_id") == F.col("_t")).join(
        broadcast_if_bounded(fires), F.col("def_id") == F.col("_f"))
    open_hits = still.where("pos > _from AND rn > _total - times + 1").select(
        "def_id", "sub_id", "detail_id", "times", "pos")
    return Carried(defs, open_hits)


def composite_rows(chained: DataFrame) -> DataFrame:
    """Composite records; flow-derived ones also carry columns of the event and its log."""
    return chained.where("fired").select(
        _composite_id().alias("record_id"), F.col("def_id").alias("me_def_id"), F.col("def_name").alias("name"),
        F.col("ts").alias("storage_time"), "flow_detail.*")


def _composite_id() -> Column:
    return stable_id("composite", F.col("def_id"), F.col("fire_seq"))


def composite_members(chained: DataFrame) -> DataFrame:
    """Links from composites to the events counted since the definition's previous composite."""
    fires = chained.groupBy(F.col("def_id").alias("_fdef")).agg(F.sum(F.col("fired").cast("long")).alias("_fires"))
    done = chained.join(broadcast_if_bounded(fires), F.col("def_id") == F.col("_fdef"))
    return done.where(F.col("fire_seq") < F.col("_fires")).select(
        stable_id("member", _composite_id(), F.col("event_result_id")).alias("record_id"),
        "event_result_id", _composite_id().alias("composite_id"))


# --- single lookups -----------------------------------------------------------------------------


def _matches(events: DataFrame, rules: DataFrame, columns: list[str], holds) -> DataFrame:
    """(event, rule) pairs that hold, from rules packed into one array beside each event."""
    packed = rules.agg(F.collect_list(F.struct(*columns)).alias("rules"))
    held = F.filter("rules", holds)
    return events.withColumn("rules", packed.scalar()).select(
        *[c for c in events.columns if c in ("event_result_id", "stat_time", "stat_bytes")],
        F.explode(held).alias("r")).select("*", "r.med_id", "r.rule_id").drop("r")


def leak_matches(flagged: DataFrame, leak_rules: DataFrame) -> DataFrame:
    """(event, vulnerability rule) pairs of events with leak flags."""
    rules = leak_rules.withColumn("rule_id", F.col("record_id"))
    return _matches(flagged, rules, ["med_id", "rule_id", "cve_match", "leak_match", "port_match"], leak_holds)


def intel_matches(flagged: DataFrame, intel_rules: DataFrame) -> DataFrame:
    """(event, intelligence rule) pairs of events whose source is a known attack address."""
    rules = intel_rules.withColumn("rule_id", F.col("record_id"))
    return _matches(
        flagged.where("in_intel"), rules, ["med_id", "rule_id", "ip_match"], lambda r: r["ip_match"] == 1)


def flow_matches(seen: DataFrame, flow_rules: DataFrame) -> DataFrame:
    """(event, traffic rule) pairs of events with their latest statistic."""
    values = _condition_values()
    return _matches(
        seen.where("stat_time is not null").withColumn("values", values), _flow_rules(flow_rules),
        ["med_id", "rule_id", "seconds", "flow_limit", "atoms"], lambda r: flow_holds(r, F.col("values")))


def asset_matches(events: DataFrame, rules: DataFrame, assets: DataFrame, asset_ips: DataFrame) -> DataFrame:
    """(event, asset rule) pairs: rules whose OS part holds, joined on the side and address they name."""
    settled = resolve_asset_rules(rules, assets, asset_ips).where("os_ok").select(
        "med_id", F.col("record_id").alias("rule_id"), "ip_type", "ip_addr")
    ends = F.explode(F.array(
        F.struct(F.lit(2).alias("side"), F.trim("source_ip").alias("ip")),
        F.struct(F.lit(3).alias("side"), F.trim("dest_ip").alias("ip"))))
    sides = events.select("event_result_id", ends.alias("e")).select("event_result_id", "e.*")
    return sides.join(
        broadcast_if_bounded(settled), (F.col("side") == F.col("ip_type")) & (F.col("ip") == F.col("ip_addr"))
    ).select("event_result_id", "med_id", "rule_id")
