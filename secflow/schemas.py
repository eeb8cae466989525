"""Record layouts."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_FIELDS = ["log_id", "recv_time", "report_ip", "facility", "severity", "report_app", "content"]

# Capture-group names a log rule may define, and the general-log column each one fills.
# Names are case-sensitive.
CAPTURES = {
    "sourceIp": "source_ip",
    "sourcePort": "source_port",
    "destIp": "dest_ip",
    "destPort": "dest_port",
    "actionOpt": "event_action",
    "actionResult": "action_result",
    "eventName": "event_name",
    "appProto": "app_proto",
    "url": "url",
    "getParameter": "get_parameter",
    "proto": "proto",
    "openTime": "open_time",
    "infoid": "infoid",
    "affectedsystem": "affectedsystem",
    "attackmethod": "attackmethod",
    "appid": "appid",
    "victimtype": "victimtype",
    "attackflag": "attackflag",
    "attacker": "attacker",
    "victim": "victim",
    "host": "host",
    "filemd5": "filemd5",
    "filedir": "filedir",
    "referer": "referer",
    "requestmethod": "requestmethod",
}

EXT_FIELDS = list(CAPTURES.values())[12:]

# Positional order of the general log, after the duplicated row key.
GENERAL_FIELDS = [
    "record_id", "first_recv_time", "report_app", "report_ip", "source_ip", "source_port",
    "dest_ip", "dest_port", "event_action", "action_result", "report_ne_type", "event_def_id",
    "event_name", "event_level", "org_id", "app_proto", "url", "get_parameter", "proto",
    "open_time", "event_id", "content", "log_rule_id", *EXT_FIELDS,
]
USER_GENERAL_FIELDS = GENERAL_FIELDS[:23]

# Positional order of the event, after the duplicated row key.
EVENT_FIELDS = [
    "event_result_id", "event_rule_id", "log_id", "event_rule_name", "event_rule_level",
    "report_ip", "source_ip", "source_port", "dest_ip", "dest_port", "open_time", "action_opt",
    "is_inner", "proto", *EXT_FIELDS,
]


def _struct(names, **types) -> T.StructType:
    return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])


RAW_LOG = _struct(RAW_FIELDS, recv_time=T.TimestampType())
GENERAL_LOG = _struct(GENERAL_FIELDS, first_recv_time=T.TimestampType(), event_level=T.IntegerType())
EVENT = _struct(EVENT_FIELDS, open_time=T.TimestampType())
ALARM = _struct(
    ["record_id", "first_alarm_time", "content", "obj_table", "obj_id", "alarm_times"],
    first_alarm_time=T.TimestampType(), alarm_times=T.IntegerType())
COMPOSITE_EVENT = _struct(["record_id", "me_def_id", "name", "storage_time"], storage_time=T.TimestampType())
COMPOSITE_MEMBER = _struct(["record_id", "event_result_id", "composite_id"])
NETFLOW = _struct(
    ["srcip", "dstip", "srcport", "dstport", "proto", "packets", "bytes", "start_time", "end_time", "record_time"],
    srcport=T.IntegerType(), dstport=T.IntegerType(), packets=T.LongType(), bytes=T.LongType(),
    start_time=T.TimestampType(), end_time=T.TimestampType(), record_time=T.TimestampType())
APP_FLOW = _struct(["srcip", "dstip", "appproto", "method"])
