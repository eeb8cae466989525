"""Raw lines and flow messages to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.text import parse_time, split_fields, stable_id
from secflow.plans.physical import evaluated_once

_MAP = "map<string,string>"


#: Equal lines that one task writes out at a time.
_COPIES = 10_000


def with_occurrence(lines: DataFrame, value: str = "value", identity: str = "source_id") -> DataFrame:
    """Lines of a source that names none: ``identity`` is their digest with an occurrence number.

    Equal lines are interchangeable, so they are counted, with partial sums, and written out again in
    blocks: no task holds the copies of a frequent line, and a retried task makes the same ids. A
    source with offsets should pass those instead.
    """
    counted = lines.groupBy(value).agg(F.count("*").alias("_n"))
    blocks = counted.select(
        value, "_n", F.md5(F.coalesce(value, F.lit(""))).alias("_digest"),
        F.explode(F.expr(f"sequence(0L, (_n - 1) div {_COPIES})")).alias("_block"))
    spread = blocks.where("_block = 0").unionByName(blocks.where("_block > 0").repartition("_digest", "_block"))
    first = F.col("_block") * _COPIES + 1
    numbers = F.sequence(first, F.least(F.col("_n"), first + _COPIES - 1))
    return spread.select(value, "_digest", F.explode(numbers).alias("_k")).select(
        value, F.concat_ws("#", "_digest", "_k").alias(identity))


def raw_parse(lines: DataFrame, value: str = "value", identity: Column | None = None) -> DataFrame:
    """``~``-joined log lines to raw-log columns.

    A line of six fields or fewer gets an id in front; lines that then still lack seven fields, are
    blank or hold no delimiter are dropped. ``identity`` names the line uniquely where the source
    can (topic, partition and offset); by default the id is a digest of the line itself.
    """
    line = F.col(value)
    generated = stable_id(identity if identity is not None else line)
    fields = split_fields(line, "~", 9)
    short = F.size(fields) <= 6
    padded = F.when(short, F.concat(F.array(generated), fields)).otherwise(fields)
    parts = evaluated_once(lines.where(F.contains(line, F.lit("~"))), "f", padded)
    item = lambda i: F.get("f", F.lit(i))
    return parts.where(F.size("f") > 6).select(
        item(0).alias("log_id"),
        parse_time(item(1)).alias("recv_time"),
        item(2).alias("report_ip"),
        item(3).alias("facility"),
        item(4).alias("severity"),
        item(5).alias("report_app"),
        item(6).alias("content"),
    )


def _lower_keys_with_id(flows: DataFrame, key: str) -> DataFrame:
    """Keys of ``raw`` in lower case plus the record id under ``key``; of keys that collide the last wins."""
    named = flows.select(
        "record_id", "raw", F.transform(F.map_keys("raw"), F.lower).alias("names"), F.map_values("raw").alias("vals"))
    plain = (F.size(F.array_distinct("names")) == F.size("names")) & ~F.array_contains("names", key)
    joined = F.map_from_arrays(F.array_append("names", F.lit(key)), F.array_append("vals", F.col("record_id")))
    pairs = F.arrays_zip("names", "vals")
    last = F.filter(pairs, lambda e, i: (e["names"] != key) & ~F.array_contains(
        F.slice("names", i + 2, F.size("names")), e["names"]))
    own = F.array(F.struct(F.lit(key).alias("names"), F.col("record_id").alias("vals")))
    return named.select(
        "record_id", F.when(plain, joined).otherwise(F.map_from_entries(F.concat(last, own))).alias("flow"))


def flow_json_explode(messages: DataFrame, value: str = "value", identity: Column | None = None) -> DataFrame:
    """JSON arrays of flows to one map per flow: keys in lower case plus a ``recordid``."""
    # one digest a message, not one a flow
    source = identity if identity is not None else F.md5(value)
    named = evaluated_once(messages.where(F.trim(value) != ""), "source", source)
    flows = named.select(
        "source",
        F.posexplode(F.from_json(value, f"array<{_MAP}>")).alias("position", "raw"))
    record_id = stable_id("flow", F.col("source"), F.col("position"))
    return _lower_keys_with_id(flows.select(record_id.alias("record_id"), "raw"), "recordid")


def appflow_line_parse(lines: DataFrame, value: str = "value", identity: Column | None = None) -> DataFrame:
    """``HEADER {json}`` lines: the first token is dropped and the rest joined without blanks.

    The id key keeps its historical spelling ``recrodid``.
    """
    record_id = stable_id("appflow", identity if identity is not None else F.col(value))
    first = F.instr(value, " ")
    body = F.when(first > 0, F.replace(F.substr(F.col(value), first + 1), F.lit(" "), F.lit("")))
    raw = F.from_json(F.when(body != "", body), _MAP)
    parsed = evaluated_once(lines.select(F.col(value), record_id.alias("record_id")), "raw", raw)
    return _lower_keys_with_id(parsed.where("raw is not null"), "recrodid")


def flow_fields(flows: DataFrame, *names: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Named map entries as columns."""
    return flows.select("record_id", *keep, *[F.col("flow")[n].alias(n) for n in names])


def condition_atoms(rules: DataFrame, expression: str = "condition_exp") -> DataFrame:
    """``field:op:value`` atoms joined by ``~:`` to one row each; malformed atoms are ignored."""
    exploded = rules.select("*", F.explode(F.split(expression, "~:")).alias("atom"))
    parts = F.split("atom", ":", 4)
    return exploded.where(F.size(parts) == 3).select(
        *rules.columns,
        F.trim(parts[0]).alias("atom_field"), parts[1].alias("atom_op"), parts[2].alias("atom_value"))


def token_dedup(lines: DataFrame, value: str = "value") -> DataFrame:
    """Distinct tokens of comma-joined text."""
    return lines.select(F.explode(F.split(value, ",")).alias("token")).distinct()
