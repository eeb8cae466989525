"""Logs, flows and rule tables shaped from the given tables.

Each frame is one SQL text that Spark and the checking engine both run; ``{name}`` stands for a
given table or another frame. Rule bases are short literal tables, as rule bases are; logs, events,
flows and lookup tables grow with the data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.operators.correlate import CompositeRules, Context
from secflow.schemas import GENERAL_FIELDS

# The site whose addresses these tables use, as ranges and as /24 prefixes.
MONITORED_RANGES = [
    "221.176.64.00-221.176.64.255",
    "221.176.65.00-221.176.65.255",
    "221.176.68.00-221.176.68.255",
    "221.176.70.00-221.176.79.255",
    "221.176.69.1-221.176.69.11",
]
MONITORED_PREFIXES = [f"221.176.{i}" for i in (64, 65, 68, *range(70, 80))]

GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations"]


def _values(columns: str, *rows: str) -> str:
    return f"select * from (values {', '.join(rows)}) as t({columns})"


def _q(text: str | None) -> str:
    return "cast(null as string)" if text is None else "'" + text.replace("'", "''") + "'"


# ordinal, device, regex with named groups (RE2-safe), rule constants
LOG_RULES = [
    (1, "10.0.0.0", "evt=(?<eventName>error) src=(?<sourceIp>[0-9.]+):(?<sourcePort>[0-9]+)",
     "r1", "d-1-1", "3", "fw", "er_error"),
    (2, "10.0.0.0", "evt=(?<eventName>[a-z]+) src=(?<sourceIp>[0-9.]+):(?<sourcePort>[0-9]+)"
                    " dst=(?<destIp>[0-9.]+):(?<destPort>[0-9]+)", "r2", "d-2", "", "fw", "er_any"),
    (3, "10.0.0.1", "evt=(?<eventName>purchase|signup) src=(?<sourceIp>[0-9.]+)", "r3", "d3", None, "ids", "er_buy"),
    (4, " 10.0.0.2 ", "evt=view", "r4", "d4", "2", "ids", "er_view"),
    (5, " 10.0.0.2 ", "dst=(?<destIp>[0-9.]+):(?<destPort>[0-9]+) val=([0-9]+)", "r5", "d5", "5", "waf", "er_dst"),
    (6, "10.0.0.3", "evt=(?<eventName>zzz)", "r6", "d6", "1", "waf", "er_none"),
]
USER_LOG_RULES = [
    (1, "", "evt=(?<eventName>purchase) src=(?<sourceIp>[0-9.]+):(?<sourcePort>[0-9]+)", "u1", "x-1", "4", "app", "er_u1"),
    (2, "", "evt=[a-z]+", "u2", "x2", "4", "app", "er_u2"),
    (3, "", "dst=(?<destIp>[0-9.]+):(?<destPort>8080) val=(?<getParameter>[0-9]+)", "u3", "x3", "", "app", "er_u3"),
]


def _log_rules(rules: list[tuple]) -> str:
    return _values(
        "rule_ord, device_ip, log_regex, log_rule_id, event_def_id, event_level, report_ne_type, event_id",
        *["(" + ", ".join([str(r[0]), *[_q(x) for x in r[1:]]]) + ")" for r in rules])


FRAMES: dict[str, str] = {
    "raw_log": """
select cast(event_id as string) as log_id, ts as recv_time,
  concat('10.0.0.', cast(user_id % 5 as string)) as report_ip,
  'user' as facility, event_type as severity,
  case when event_id % 10 = 0 then 'NE_FLOW' else 'app' end as report_app,
  concat('evt=', event_type,
    ' src=192.168.', cast(user_id % 16 as string), '.', cast(event_id % 256 as string), ':', cast(1024 + event_id % 1000 as string),
    ' dst=221.176.', cast(64 + event_id % 18 as string), '.', cast(user_id % 256 as string), ':',
    case event_id % 4 when 0 then '80' when 1 then '443' when 2 then '22' else '8080' end,
    ' val=', cast(cast(floor(value) as bigint) as string)) as content
from {events}""",
    "raw_line": """
select case
    when n % 11 = 0 then concat('noise ', log_id)
    when n % 13 = 0 then concat_ws('~', at_text, report_ip, facility, severity)
    when n % 7 = 0 then concat_ws('~', at_text, report_ip, facility, severity, report_app, content)
    when n % 5 = 0 then concat_ws('~', log_id, at_text, report_ip, facility, severity, report_app, content, '', '')
    when n % 3 = 0 then concat_ws('~', log_id, at_text, report_ip, facility, severity, report_app, content, cast(n % 2 as string))
    when n % 17 = 0 then concat_ws('~', log_id, at_text, report_ip, facility, severity, report_app, content, 'x')
    else concat_ws('~', log_id, at_text, report_ip, facility, severity, report_app, content) end as value
from (select cast(log_id as bigint) as n, substr(cast(recv_time as string), 1, 19) as at_text, * from {raw_log}) as r""",
    "log_rule": _log_rules(LOG_RULES),
    "user_log_rule": _log_rules(USER_LOG_RULES),
    # a rule a customer: by source, by destination, by port, and some that name no text
    "user_log_rule_large": """
select c_custkey as rule_ord, '' as device_ip,
  case when c_custkey % 50 = 49 then 'va.=(?<getParameter>[0-9][0-9][0-9])$'
    when c_custkey % 3 = 0 then concat('src=192[.]168[.]', cast(c_custkey % 16 as string), '[.]', cast(c_custkey % 256 as string), ':(?<sourcePort>[0-9]+)')
    when c_custkey % 3 = 1 then concat('dst=221[.]176[.]', cast(64 + c_custkey % 18 as string), '[.]', cast(c_custkey % 256 as string), ':(?<destPort>[0-9]+) val=')
    else concat('(?<eventName>[a-z]+) src=(?<sourceIp>[0-9.]+):', cast(1024 + c_custkey % 1000 as string), ' ') end as log_regex,
  concat('u', cast(c_custkey as string)) as log_rule_id, concat('d-', cast(c_custkey % 7 as string)) as event_def_id,
  '3' as event_level, 'app' as report_ne_type, 'er_user' as event_id
from {customer}""",
    "event_def": _values(
        "rule_ord, event_rule_id, event_rule_name, event_rule_level, begin_value",
        "(1, 'ER-Error ', 'error seen', '4', ' Error ')", "(2, 'er-click', 'click seen', '1', 'CLICK')",
        "(3, 'er-click2', 'click again', '2', 'click ')", "(4, 'er-buy', 'bought', '3', 'purchase')",
        "(5, 'er-none', 'never', '3', 'absent')"),
    "user_event_def": _values(
        "rule_ord, event_rule_id, event_rule_name, event_rule_level",
        "(1, 'ud1', 'two conditions', '5')", "(2, 'ud2', 'unknown method', '5')", "(3, 'ud3', 'text order', '4')",
        "(4, 'ud4', 'contained', '3')", "(5, 'ud5', 'not equal', '3')", "(6, 'ud6', 'unknown field', '3')",
        "(7, 'ud7', 'in list', '2')", "(8, 'ud8', 'no conditions', '1')", "(9, 'ud9', 'too late', '1')"),
    "user_event_field": _values(
        "event_rule_id, field, method, begin_value, end_value",
        "('ud1', 'eventname', '1', 'ERROR', '')", "('ud1', 'Sourceport', '4', '1200', '')",
        "('ud2', 'eventname', 'x', 'error', '')", "('ud3', 'sourceip', '3', '192.168.10', '')",
        "('ud3', 'destport', '5', '443', '')", "('ud3', 'eventlevel', '6', '3', '')",
        "('ud4', 'destport', '9', 'ports 22 and 80', '')", "('ud5', 'eventname', '2', 'click', '')",
        "('ud5', 'reportapp', '1', 'NE_FLOW', '')", "('ud6', 'nosuchfield', '2', 'a', '')",
        "('ud7', 'eventname', '8', 'signup,purchase', '')", "('ud7', 'sourceport', '7', '1024', '1100')",
        "('ud7', 'eventname', '1', 'purchase', '')"),
    "policy_whole": _values(
        "record_id, alarm_name, start_time, end_time, alarm_level, alert_type, obj_table, obj_id, status",
        "('P1', 'errors', cast(null as timestamp), cast(null as timestamp), '3', '1', 'T_SIEM_ALARM_POLICY_EVENT', 'o1', 1)",
        "('P2', 'purchases', cast(null as timestamp), cast(null as timestamp), '2', '1', 't_siem_alarm_policy_event', 'o2', 1)",
        "('P3', 'clicks', cast(null as timestamp), cast(null as timestamp), '1', '1', 't_siem_alarm_policy_event', 'o3', 1)",
        "('P4', 'composites', cast(null as timestamp), cast(null as timestamp), '1', '1', 't_siem_alarm_policy_relation_ev', 'o4', 1)"),
    "policy_event": _values(
        "record_id, alarm_id, event_rule_id, control_time, count",
        "('p1', 'p1 ', 'er-error', 14400, 3)", "('p2', 'P2', 'ER-BUY', 86400, 5)", "('p3', 'P3', 'er-click', 60, 1)",
        "('p4', 'P3', 'er-error', 3600, 2)", "('p5', 'P4', 'er-error', 60, 1)"),
    "policy_composite": _values(
        "record_id, alarm_id, relation_event_rule_id, control_time, count",
        "('c1', 'P4', 'd1', 3600, 2)", "('c2', 'p4', 'D3', 3600, 3)", "('c3', 'P4', 'd2', 3600, 1)",
        "('c4', 'P1', 'd1', 3600, 1)"),
    # events with their log, straight from the table
    "corr_event": """
select cast(event_id as string) as event_result_id, concat('er_', event_type) as event_rule_id,
  event_type as event_rule_name, cast(event_id % 5 as string) as event_rule_level,
  concat('10.0.0.', cast(user_id % 5 as string)) as report_ip,
  concat('192.168.', cast(user_id % 16 as string), '.', cast(event_id % 256 as string)) as source_ip,
  cast(1024 + event_id % 1000 as string) as source_port,
  concat('221.176.', cast(64 + event_id % 18 as string), '.', cast(user_id % 150 as string)) as dest_ip,
  case event_id % 4 when 0 then '80' when 1 then '443' when 2 then '22' else '8080' end as dest_port,
  ts as open_time, case when event_id % 3 = 0 then '0' else '1' end as is_inner,
  case when event_id % 10 = 0 then 'NE_FLOW' else 'app' end as proto,
  concat('CVE-', cast(event_id % 50 as string)) as cve, cast(event_id % 5 as int) as level
from {events}""",
    "me_define": _values(
        "record_id, name, level, status",
        "('d1', 'single', '1', 1)", "('d2', 'with intelligence', '2', 1)", "('d3', 'or vulnerability', '3', 1)",
        "('d4', 'two details', '3', 1)", "('d5', 'asset', '3', 1)", "('d6', 'traffic', '3', 1)",
        "('d7', 'and vulnerability', '3', 1)", "('d8', 'switched off', '3', 0)", "('d9', 'or intelligence', '1', 1)"),
    "me_sub": _values(
        "record_id, me_define_id, op, obj_table, status",
        "('s1', 'd1', 0, 'T_SIEM_MEDETAIL', 1)",
        "('s2', ' d2 ', 0, 't_siem_medetail', 1)", "('s2i', 'd2', 0, 'T_SIEM_MEDETAIL4', 1)",
        "('s3', 'd3', 0, 'T_SIEM_MEDETAIL', 1)", "('s3l', 'd3', 1, 'T_SIEM_MEDETAIL3', 1)",
        "('s4', 'd4', 0, 'T_SIEM_MEDETAIL', 1)",
        "('s5', 'd5', 0, 'T_SIEM_MEDETAIL', 1)", "('s5a', 'd5', 0, 'T_SIEM_MEDETAIL5', 1)",
        "('s6', 'd6', 0, 'T_SIEM_MEDETAIL', 1)", "('s6f', 'd6', 0, 'T_SIEM_MEDETAIL6', 1)",
        "('s7', 'd7', 0, 'T_SIEM_MEDETAIL', 1)", "('s7l', 'd7', 0, 'T_SIEM_MEDETAIL3', 1)",
        "('s8', 'd8', 0, 'T_SIEM_MEDETAIL', 1)", "('s1x', 'd1', 0, 'T_SIEM_MEDETAIL4', 0)",
        "('s9', 'd9', 0, 'T_SIEM_MEDETAIL', 1)", "('s9f', 'd9', 0, 'T_SIEM_MEDETAIL6', 1)",
        "('s9i', 'd9', 1, 'T_SIEM_MEDETAIL4', 1)"),
    "me_detail": _values(
        "record_id, med_id, event_id, time_limit, times, op, flag, field_name, field_op, field_value",
        "('m1', 's1', 'er_error', 3600, 3, 0, 0, '', '', '')",
        "('m2', 's2', 'er_click', 3600, 2, 0, 0, '', '', '')",
        "('m3', 's3', 'er_view', 3600, 4, 0, 0, '', '', '')",
        "('m4a', 's4', 'er_signup', 3600, 2, 0, 0, '', '', '')",
        "('m4b', 's4', '', 3600, 3, 0, 1, 'Destport', '2', '22')",
        "('m5', 's5', 'er_purchase', 3600, 1, 0, 0, '', '', '')",
        "('m6', 's6', '', 3600, 2, 0, 1, 'eventname', '1', 'PURCHASE')",
        "('m7', 's7', 'er_error', 3600, 5, 0, 0, '', '', '')",
        "('m8', 's8', 'er_error', 3600, 1, 0, 0, '', '', '')",
        "('m9', 's9', 'er_signup', 3600, 2, 0, 0, '', '', '')"),
    "me_leak": _values(
        "record_id, med_id, cve_match, leak_match, port_match",
        "('l1', 's3l', 0, 1, 0)", "('l2', 's7l', 1, 0, 0)", "('l3', 's7l', 0, 0, 1)", "('l4', 'other', 1, 0, 1)"),
    "me_flow": _values(
        "record_id, med_id, statis_period, flow_limit, condition_exp",
        "('f1', 's6f', 2, 20000, 'sourceport:1:1200~:destport:0:443')", "('f2', 's9f', 3, 9000, '')",
        "('f3', 'other', 1, 30000, 'sourceip:2:192.168.5~:bad~:destip:1:221.176.7')"),
    "me_asset": _values(
        "record_id, med_id, ip_type, ip_addr, os",
        "('a1', 's5a', 3, ' 221.176.70.6 ', 1)", "('a2', 'other', 2, '192.168.1.1', 1)"),
    "me_intel": _values("record_id, med_id, ip_match", "('i1', 's2i', 1)", "('i2', 's9i', 1)", "('i3', 'other', 0)"),
    "leak_scan": """
select cast(p_partkey as string) as record_id, cast(p_partkey % 100 as string) as ne_id,
  concat('221.176.', cast(64 + p_partkey % 18 as string), '.', cast(p_partkey % 150 as string)) as ne_ip,
  p_name as leak_name, case p_size % 4 when 0 then '80' when 1 then '443' when 2 then '22' else '8080' end as leak_port,
  concat('cve-', cast(p_size as string)) as leak_cve
from {part}""",
    "intel": """
select concat(case when c_custkey % 7 = 0 then '192.168.' else '192.169.' end, cast(c_custkey % 16 as string), '.',
  cast(c_custkey % 256 as string)) as attack_ip
from {customer}""",
    "asset": "select s_suppkey as ne_id, cast(s_nationkey % 3 as int) as os_id from {supplier}",
    "asset_ip": """
select s_suppkey as ne_id, concat(case when s_suppkey % 4 <> 0 then '221.176.' else '221.177.' end,
  cast(64 + s_suppkey % 18 as string), '.', cast(s_suppkey % 50 as string)) as device_ip
from {supplier}""",
    # one asset rule per supplier, for the lookup on its own
    "asset_rule": """
select concat('ar', cast(s_suppkey as string)) as record_id, concat('sub', cast(s_suppkey as string)) as med_id,
  cast(2 + s_suppkey % 2 as int) as ip_type,
  case when s_suppkey % 2 = 0 then concat('192.168.', cast(s_suppkey % 16 as string), '.', cast(s_suppkey % 256 as string))
    else concat('221.176.', cast(64 + s_suppkey % 18 as string), '.', cast(s_suppkey % 50 as string)) end as ip_addr,
  cast(s_suppkey % 3 as int) as os
from {supplier}""",
    "flow_stat": """
select date_trunc('minute', ts) as stat_time, cast(sum(floor(value)) * 100 as bigint) as bytes
from {events} group by date_trunc('minute', ts)""",
    "netflow": """
select concat('221.176.', cast(60 + l_suppkey % 24 as string), '.', cast(l_suppkey % 256 as string)) as srcip,
  concat('221.176.', cast(64 + l_partkey % 40 as string), '.', cast(l_partkey % 256 as string)) as dstip,
  cast(1024 + l_orderkey % 5000 as int) as srcport, cast(l_linenumber * 11 as int) as dstport,
  case l_linenumber % 5 when 0 then 'ICMP' when 2 then 'UDP' when 3 then 'GRE' else 'TCP' end as proto,
  cast(floor(l_quantity) as bigint) as packets, cast(floor(l_extendedprice) as bigint) as bytes,
  l_shipdate as start_time, l_shipdate + interval '1' second * cast(l_quantity as int) as end_time,
  l_shipdate as record_time
from {lineitem}""",
    "app_flow": """
select concat('221.176.', cast(60 + l_suppkey % 24 as string), '.', cast(l_suppkey % 256 as string)) as srcip,
  concat('221.176.', cast(64 + l_partkey % 40 as string), '.', cast(l_partkey % 256 as string)) as dstip,
  case l_linenumber when 1 then 'QQ' when 2 then 'FTP' when 3 then 'HTTP' when 4 then 'TELNET' when 5 then 'DBAudit'
    when 6 then 'bd-local-trojan' else 'OTHER' end as appproto,
  case l_returnflag when 'A' then 'GET' when 'N' then 'POST' else 'PUT' end as method
from {lineitem}""",
    "registered": """
select concat(case when s_suppkey % 3 = 0 then '221.176.' else '221.177.' end, cast(60 + s_suppkey % 24 as string), '.',
  cast(s_suppkey % 256 as string)) as device_ip
from {supplier}""",
    # monitored ranges that grow with the data; some overlap, some cross a border of a /16, some are empty or malformed
    "monitored_range": """
select concat('221.176.', case when s_suppkey % 17 = 0 then '255' else cast(60 + s_suppkey * 7 % 30 as string) end, '.',
    cast(s_suppkey % 200 as string)) as begin_ip,
  case when s_suppkey % 17 = 0 then concat('221.177.0.', cast(s_suppkey % 9 as string))
    when s_suppkey % 13 = 0 then '221.176.x.1' when s_suppkey % 11 = 0 then '221.176.1.1'
    else concat('221.176.', cast(60 + s_suppkey * 7 % 30 as string), '.', cast(s_suppkey % 200 + s_suppkey % 40 as string)) end as end_ip
from {supplier}
where 60 + s_suppkey * 7 % 30 < 88""",
    "flow_cluster": """
select ip, cast(case when ip like '%.7' then 9 else cast(split_part(ip, '.', 4) as int) % 4 end as int) as cluster
from (select distinct srcip as ip from {netflow}) as s""",
    "flow_message": """
select concat('[', '{{"SRCIP":"', srcip, '","DstIp":"', dstip, '","BYTES":', cast(bytes as string), '}}', ',',
  '{{"SRCIP":"', dstip, '","DstIp":"', srcip, '","BYTES":', cast(packets as string), '}}', ']') as value
from {netflow}""",
    "app_flow_line": """
select concat('HDR ', '{{"SRCIP": "', srcip, '", "DSTIP": "', dstip, '", "AppProto": "', appproto, '", "METHOD": "', method, '"}}') as value
from {app_flow}""",
    "condition_text": """
select cast(o_orderkey as string) as line, concat(o_orderpriority, ',', o_orderstatus, ',', cast(o_custkey % 97 as string)) as value
from {orders}""",
    # rule store tables that grow with the data
    "store_asset": """
select s_suppkey as ne_id, cast(s_nationkey % 5 as int) as htype_id, cast(s_suppkey % 3 as int) as vendor_id,
  concat('m', cast(s_suppkey as string)) as model from {supplier}""",
    "store_asset_ip": """
select case when s_suppkey % 4 <> 0 then s_suppkey else -s_suppkey end as ne_id,
  concat('10.1.', cast(s_suppkey % 200 as string), '.', cast(s_suppkey % 251 as string)) as device_ip
from {supplier}
union all
select case when s_suppkey % 6 = 1 then s_suppkey else -s_suppkey end as ne_id,
  concat('10.2.', cast(s_suppkey % 200 as string), '.', cast(s_suppkey % 251 as string)) as device_ip
from {supplier}""",
    "store_lib": """
select concat('lib', cast(s_suppkey as string)) as log_rule_lib_id, cast(s_nationkey % 5 as int) as htype_id,
  cast(s_suppkey % 3 as int) as vendor_id,
  concat(case when s_suppkey % 5 <> 0 then 'm' else 'none' end, cast(s_suppkey as string)) as model
from {supplier}""",
    "store_regex": """
select concat('lr', cast(p_partkey as string)) as log_rule_id,
  concat('lib', cast(cast(floor(p_partkey / 15.0) as bigint) as string)) as log_rule_lib_id,
  concat('evt=(?<eventName>', p_name, ')') as log_regex, p_brand as event_def_id, cast(p_size % 5 as string) as event_level
from {part}""",
    "store_event_def": """
select concat('er', cast(p_partkey as string)) as event_rule_id, p_name as event_rule_name,
  cast(p_size % 5 as string) as event_rule_level, p_type as event_basic_type, p_brand as event_sub_type,
  cast(p_size % 2 as int) as is_inner, cast(case when p_size % 3 = 0 then 0 else 1 end as int) as is_use
from {part}""",
    "store_event_field": """
select cast(c_custkey as string) as event_rule_field_id, concat('er', cast(c_custkey * 7 % 2500 as string)) as event_rule_id,
  'eventname' as field, cast(1 + c_custkey % 9 as string) as method, c_mktsegment as begin_value
from {customer}""",
    "store_policy": """
select o_orderkey as recordid, o_orderpriority as alarm_name, cast(null as string) as start_time,
  cast(null as string) as end_time, cast(o_custkey % 4 as string) as alarm_level, o_orderstatus as alert_type,
  't_siem_alarm_policy_event' as objtable, o_custkey as objid,
  case when o_orderkey % 3 = 0 then null else 'note' end as alarm_comment, cast(o_orderkey % 2 as int) as status
from {orders}""",
    "store_sub": """
select cast(c_custkey as string) as recordid, cast(c_nationkey as string) as medefineid, cast(c_custkey % 2 as int) as op,
  case c_custkey % 3 when 0 then 'T_SIEM_MEDETAIL' when 1 then 'T_SIEM_MEDETAIL3' else 'T_SIEM_MEDETAIL4' end as objtable,
  cast(case when c_custkey % 5 = 0 then 0 else 1 end as int) as status from {customer}""",
    "event_name": "select p_partkey, case when p_size % 10 = 0 then ' ' else concat(p_name, ' 注入', p_brand) end as event_name from {part}",
    "flow_index": "select l_orderkey as rowkey, min(l_shipdate) as record_time from {lineitem} group by l_orderkey",
    "keyed_flow": """
select l_orderkey as rowkey, l_partkey, l_suppkey, l_linenumber, cast(floor(l_extendedprice) as bigint) as bytes from {lineitem}""",
}

_NAME = re.compile(r"(?<!{){(\w+)}(?!})")


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; zone-less timestamps become instants of the session zone."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [f.name for f in table.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return table.withColumns({n: F.col(n).cast("timestamp") for n in naive}) if naive else table


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A named frame, or a given table."""
    if name not in FRAMES:
        return given(spark, sf_dir, name)
    sql = FRAMES[name]
    used = {n: frame(spark, sf_dir, n) for n in set(_NAME.findall(sql))}
    return spark.sql(sql, **used)


def check_sql(name: str) -> str:
    """The same frame as text for the checking engine."""
    return expand(FRAMES[name])


def expand(sql: str) -> str:
    """Replace frames by their text; given tables keep their names."""
    while True:
        found = [n for n in _NAME.findall(sql) if n in FRAMES]
        if not found:
            break
        for n in found:
            sql = sql.replace("{" + n + "}", f"({FRAMES[n]}) as {n}_")
    return _NAME.sub(r"\1", sql).replace("{{", "{").replace("}}", "}")


def corr_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation events with their log as a struct."""
    events = frame(spark, sf_dir, "corr_event")
    known = {
        "record_id": F.col("event_result_id"), "first_recv_time": F.col("open_time"), "report_app": F.col("proto"),
        "event_name": F.col("event_rule_name"), "event_level": F.col("level"), "report_ip": F.col("report_ip"),
        "source_ip": F.col("source_ip"), "source_port": F.col("source_port"), "dest_ip": F.col("dest_ip"),
        "dest_port": F.col("dest_port")}
    log = F.struct(*[known.get(n, F.lit(None).cast("string")).alias(n) for n in GENERAL_FIELDS])
    return events.withColumn("log", log)


def composite_rules(spark: SparkSession, sf_dir: str) -> CompositeRules:
    f = lambda n: frame(spark, sf_dir, n)
    return CompositeRules(
        f("me_define"), f("me_sub"), f("me_detail"), f("me_leak"), f("me_flow"), f("me_asset"), f("me_intel"))


def context(spark: SparkSession, sf_dir: str) -> Context:
    f = lambda n: frame(spark, sf_dir, n)
    return Context(f("leak_scan"), f("flow_stat"), f("asset"), f("asset_ip"), f("intel"))
