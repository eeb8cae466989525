"""Field predicates of user rules.

Every comparison is on case-folded text and reads "rule value <op> field value": method 3 holds
when the rule value is greater than the field. A missing field compares as one blank.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from secflow.functions.text import format_time

# Rule field name -> general-log column.
RULE_FIELDS = {
    "recordid": "record_id",
    "firstrecvtime": "first_recv_time",
    "reportapp": "report_app",
    "reportip": "report_ip",
    "sourceip": "source_ip",
    "sourceport": "source_port",
    "destip": "dest_ip",
    "destport": "dest_port",
    "eventaction": "event_action",
    "eventname": "event_name",
    "eventlevel": "event_level",
}

# Condition-expression operators.
CONDITION_OPS = {"0": "=", "1": ">", "2": "<"}
CONDITION_FIELDS = {"sourceip", "sourceport", "destip", "destport"}


def rule_field_text(name: str, prefix: str = "") -> Column:
    """Text of a general-log field as rules see it."""
    column = RULE_FIELDS[name]
    c = F.col(f"{prefix}{column}")
    text = format_time(c) if column == "first_recv_time" else c.cast("string")
    return F.coalesce(text, F.lit(" "))


def rule_field_map(prefix: str = "") -> Column:
    """All rule-visible fields as a map, for rules that stay data."""
    return F.map_from_arrays(
        F.array(*[F.lit(n) for n in RULE_FIELDS]),
        F.array(*[rule_field_text(n, prefix) for n in RULE_FIELDS]))


def method_holds(method: Column, begin: Column, end: Column, value: Column, strict: bool = True) -> Column:
    """One of nine comparison methods. In strict mode 7 (between) and 8 (in) always hold."""
    v, x = F.lower(begin), F.lower(value)
    between = F.lit(True) if strict else x.between(v, F.lower(end))
    member = F.lit(True) if strict else F.array_contains(F.split(v, ","), x)
    holds = (
        F.when(method == "1", v == x)
        .when(method == "2", v != x)
        .when(method == "3", v > x)
        .when(method == "4", v < x)
        .when(method == "5", v >= x)
        .when(method == "6", v <= x)
        .when(method == "7", between)
        .when(method == "8", member)
        .when(method == "9", F.contains(begin, value))
        .otherwise(F.lit(False)))
    return F.coalesce(holds, F.lit(False))


def condition_holds(op: Column, field_value: Column, rule_value: Column) -> Column:
    """Atom of a condition expression; here the field is on the left."""
    x, v = F.lower(field_value), F.lower(rule_value)
    return F.coalesce(
        F.when(op == "0", x == v).when(op == "1", x > v).when(op == "2", x < v).otherwise(F.lit(False)),
        F.lit(False))
