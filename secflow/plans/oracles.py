"""SQL counterparts of the registered queries, for an independent engine on the same tables.

They state the intended result directly (joins, row numbers, recursion) and share with the queries
only the shaping of the input frames.
"""

from __future__ import annotations

from secflow.plans.tables import LOG_RULES, USER_LOG_RULES, check_sql
from secflow.schemas import CAPTURES, EVENT_FIELDS, EXT_FIELDS, GENERAL_FIELDS, USER_GENERAL_FIELDS

_NULL = "cast(null as varchar)"


def _f(name: str) -> str:
    return f"({check_sql(name)})"


def _group_names(regex: str) -> list[str | None]:
    """Names of the capturing groups in order; the fixture regexes have no other parentheses."""
    names = []
    for piece in regex.split("(")[1:]:
        names.append(piece[2:piece.index(">")] if piece.startswith("?<") else None)
    return names


def _plain(regex: str) -> str:
    for name in CAPTURES:
        regex = regex.replace(f"?<{name}>", "")
    return regex


def _capture(rules, name: str) -> str:
    """CASE over rules that extracts one capture by group number."""
    cases = []
    for rule in rules:
        groups = _group_names(rule[2])
        if name in groups:
            cases.append(
                f"when {rule[0]} then nullif(regexp_extract(content, '{_plain(rule[2])}', {groups.index(name) + 1}), '')")
    return f"case rule_ord {' '.join(cases)} end" if cases else _NULL


def _matched(rules, device_scoped: bool) -> str:
    rows = ", ".join(
        "(" + ", ".join([str(r[0])] + ["null" if x is None else "'" + x + "'" for x in (r[1], _plain(r[2]), *r[3:])])
        + f", {len(_group_names(r[2]))})" for r in rules)
    scope = "trim(l.report_ip) = trim(r.device_ip) and" if device_scoped else ""
    return f"""(select * from (
  select l.*, r.* exclude (device_ip), row_number() over (partition by l.log_id order by r.rule_ord) as nth
  from {_f('raw_log')} l join (values {rows}) r(rule_ord, device_ip, log_regex, log_rule_id, event_def_id, event_level,
    report_ne_type, event_id, groups)
  on {scope} r.groups > 0 and regexp_matches(l.content, r.log_regex)) where nth = 1)"""


def _general(rules, user: bool = False) -> str:
    known = {
        "record_id": "md5('general|' || log_id)",
        "first_recv_time": "epoch_us(recv_time) // 1000" if user else "recv_time",
        "report_app": "report_app", "report_ip": "report_ip", "report_ne_type": "report_ne_type",
        "event_def_id": "replace(event_def_id, '-', '')",
        "event_level": "cast(coalesce(nullif(trim(event_level), ''), '1') as integer)",
        "org_id": "log_id", "event_id": "event_id", "content": "content", "log_rule_id": "log_rule_id",
        **{column: _capture(rules, name) for name, column in CAPTURES.items()},
    }
    fields = USER_GENERAL_FIELDS if user else GENERAL_FIELDS
    return f"(select {', '.join(f'{known[c]} as {c}' for c in fields)} from {_matched(rules, not user)})"


_GENERAL = _general(LOG_RULES)


def _event(source: str, rule_id: str, name: str, level: str, is_inner: str, ext: bool) -> str:
    known = {
        "event_result_id": f"md5('event|' || record_id || '|' || {rule_id} || '|' || {is_inner})",
        "event_rule_id": rule_id, "log_id": "record_id", "event_rule_name": name,
        "event_rule_level": f"cast({level} as varchar)", "open_time": "first_recv_time",
        "action_opt": "action_result", "is_inner": is_inner, "proto": "report_app"}
    for c in EXT_FIELDS:
        known[c] = c if ext else _NULL
    return f"(select {', '.join(f'{known.get(c, c)} as {c}' for c in EVENT_FIELDS)} from {source})"


_ORIGIN = "case when report_app = 'NE_FLOW' then '0' else '1' end"
_BUILTIN = _event(
    f"""(select * from (select g.*, d.event_rule_id, d.event_rule_name, d.event_rule_level,
    row_number() over (partition by g.record_id order by d.rule_ord) as nth
  from {_GENERAL} g join {_f('event_def')} d on lower(trim(coalesce(g.event_name, ' '))) = lower(trim(d.begin_value)))
  where nth = 1)""", "event_rule_id", "event_rule_name", "event_rule_level", _ORIGIN, True)
_PASSTHROUGH = _event(_GENERAL, "event_id", "event_name", "event_level", _ORIGIN, False)


def _user(strict: bool) -> str:
    x = """lower(coalesce(case lower(f.field) when 'eventname' then g.event_name when 'sourceip' then g.source_ip
      when 'sourceport' then g.source_port when 'destip' then g.dest_ip when 'destport' then g.dest_port
      when 'eventlevel' then cast(g.event_level as varchar) when 'reportapp' then g.report_app end, ' '))"""
    seven = "true" if strict else "xv between lower(begin_value) and lower(end_value)"
    eight = "true" if strict else "list_contains(string_split(lower(begin_value), ','), xv)"
    return _event(f"""(select * from (
  select g.*, d.rule_ord, d.event_rule_id, d.event_rule_name, d.event_rule_level,
    row_number() over (partition by g.record_id order by d.rule_ord) as nth
  from {_GENERAL} g join (
    select h.record_id, h.event_rule_id from (
      select record_id, event_rule_id, field, case method
        when '1' then lower(begin_value) = xv when '2' then lower(begin_value) <> xv
        when '3' then lower(begin_value) > xv when '4' then lower(begin_value) < xv
        when '5' then lower(begin_value) >= xv when '6' then lower(begin_value) <= xv
        when '7' then {seven} when '8' then {eight} when '9' then contains(begin_value, xr) else false end
        and lower(field) <> 'nosuchfield' as ok
      from (select g.record_id, f.*, {x} as xv, {x[6:-1]} as xr from {_GENERAL} g cross join {_f('user_event_field')} f)
      union all
      select g.record_id, d.event_rule_id, '', true from {_GENERAL} g cross join {_f('user_event_def')} d) h
    group by h.record_id, h.event_rule_id having bool_and(ok)) m on m.record_id = g.record_id
  join {_f('user_event_def')} d on d.event_rule_id = m.event_rule_id) where nth = 1)""",
        "event_rule_id", "event_rule_name", "event_rule_level", "'0'", False)


# --- thresholds ---------------------------------------------------------------------------------

_POLICY_HITS = f"""(select p.record_id as policy_id, w.record_id as obj_id, cast(p.count as bigint) as n,
    p.control_time as seconds, e.open_time as ts, e.event_result_id as event_id, e.event_rule_name as name,
    row_number() over (partition by p.record_id order by e.open_time, e.event_result_id) as rn
  from {_BUILTIN} e join {_f('policy_event')} p on lower(trim(e.event_rule_id)) = lower(trim(p.event_rule_id))
  join {_f('policy_whole')} w on lower(trim(p.alarm_id)) = lower(trim(w.record_id))
    and lower(w.obj_table) = 't_siem_alarm_policy_event')"""
_WITHIN = f"""(select a.*, coalesce(epoch_us(a.ts) - epoch_us(b.ts) <= cast(a.seconds as bigint) * 1000000, false) as within
  from hits a left join hits b on a.policy_id = b.policy_id and b.rn = a.rn - a.n + 1)"""


def _alarm(fires: str, prefix: str = "事件【", table: str = "t_siem_alarm_policy_event") -> str:
    return f"""select md5('alarm|' || policy_id || '|' || event_id) as record_id, ts as first_alarm_time,
  substr(cast(ts as varchar), 1, 19) || '{prefix}' || name || '】发生告警!' as content, '{table}' as obj_table,
  obj_id, cast(1 as integer) as alarm_times, policy_id, event_id from {fires}"""


_ALARM_SINGLE = f"with hits as {_POLICY_HITS} " + _alarm("hits where rn % n = 0")
_ALARM_WINDOWED = f"with hits as {_POLICY_HITS}, marked as {_WITHIN} " + _alarm("marked where within")
_ALARM_RESET = f"""with recursive hits as materialized {_POLICY_HITS}, marked as materialized
  (select * from {_WITHIN} where within),
following as materialized (select a.policy_id, a.rn, min(b.rn) as nxt from marked a join marked b
  on a.policy_id = b.policy_id and b.rn >= a.rn + a.n group by all),
chain as (select policy_id, min(rn) as rn from marked group by policy_id
  union all select f.policy_id, f.nxt from chain c join following f on c.policy_id = f.policy_id and c.rn = f.rn)
{_alarm('(select m.* from marked m join chain c on m.policy_id = c.policy_id and m.rn = c.rn)')}"""

# --- correlation --------------------------------------------------------------------------------

_EVENT = _f("corr_event")
_RULES = f"""(select d.record_id as def_id, s.record_id as sub_id, m.record_id as detail_id, m.times, m.time_limit,
  m.flag, m.event_id as watched, lower(m.field_name) as field_name, m.field_op, lower(m.field_value) as v
  from {_f('me_define')} d join {_f('me_sub')} s on trim(s.me_define_id) = d.record_id
  join {_f('me_detail')} m on m.med_id = s.record_id
  where d.status = 1 and s.status = 1 and upper(s.obj_table) = 'T_SIEM_MEDETAIL')"""
_HITS = f"""(select r.def_id, r.sub_id, r.detail_id, cast(r.times as bigint) as times,
  cast(r.time_limit as bigint) as time_limit, e.event_result_id, e.open_time as ts
  from {_EVENT} e join {_RULES} r on (r.flag = 0 and r.watched = e.event_rule_id)
    or (r.flag = 1 and e.is_inner = '1' and (
      (r.field_name = 'destport' and r.field_op = '2' and r.v <> lower(e.dest_port))
      or (r.field_name = 'eventname' and r.field_op = '1' and r.v = lower(e.event_rule_name)))))"""
_COUNTED = f"""(select *, row_number() over (partition by detail_id order by ts, event_result_id) as rn from {_HITS})"""
_LEAK_FLAGS = f"""(select e.*,
    exists (select 1 from {_f('leak_scan')} s where lower(s.ne_ip) = lower(e.dest_ip)) as has_leak,
    exists (select 1 from {_f('leak_scan')} s where lower(s.ne_ip) = lower(e.dest_ip)
      and lower(s.leak_cve) = lower(e.cve)) as has_cve,
    exists (select 1 from {_f('leak_scan')} s where lower(s.ne_ip) = lower(e.dest_ip)
      and s.leak_port = e.dest_port) as has_port from {_EVENT} e)"""
_IN_INTEL = f"source_ip in (select attack_ip from {_f('intel')})"
_FLOW_SEEN = f"""(select e.*, f.stat_time, f.bytes as stat_bytes from {_EVENT} e
  asof left join {_f('flow_stat')} f on e.open_time >= f.stat_time)"""


def _flow_rule(period_us: int, limit: int, condition: str = "true") -> str:
    return (f"coalesce(epoch_us(open_time) - epoch_us(stat_time) <= {period_us} and stat_bytes < {limit}"
            f" and {condition}, false)")


_F1 = _flow_rule(60_000_000, 20000, "source_port > '1200' and dest_port = '443'")
_F2 = _flow_rule(3_600_000_000, 9000)
_F3 = _flow_rule(10_000_000, 30000, "source_ip < '192.168.5' and dest_ip > '221.176.7'")

_BIG = 2**62
# floors of the sub-rules of each definition, folded by hand in order of kind
_FLOOR_OF = f"""case l.def_id
  when 'd1' then q_s1
  when 'd2' then least(q_s2, case when in_intel then {_BIG} else 0 end)
  when 'd3' then greatest(q_s3, last_leak)
  when 'd4' then q_s4
  when 'd5' then least(q_s5, case when dest_ip = '221.176.70.6' and os_a1 = 1 then {_BIG} else 0 end)
  when 'd6' then least(q_s6, case when {_F1} then {_BIG} else 0 end)
  when 'd7' then least(q_s7, last_cve, last_port)
  when 'd9' then least(greatest(q_s9, case when in_intel then {_BIG} else 0 end),
    case when {_F2} then {_BIG} else 0 end) end"""
_Q = ", ".join(
    f"coalesce(case when sub_id = '{s}' and got = need then q end, 0) as q_{s}"
    for s in ("s1", "s2", "s3", "s4", "s5", "s6", "s7", "s9"))
_OS_A1 = f"""coalesce((select max_by(a.os_id, a.ne_id) from {_f('asset')} a join {_f('asset_ip')} i on a.ne_id = i.ne_id
  where i.device_ip = '221.176.70.6'), 1)"""
_FOLD_CTES = f"""ev as materialized (select l.*, {_IN_INTEL.replace('source_ip', 'l.source_ip')} as in_intel,
    f.stat_time, f.stat_bytes from {_LEAK_FLAGS} l join {_FLOW_SEEN} f on f.event_result_id = l.event_result_id),
counted as materialized {_COUNTED},
placed as materialized (select h.def_id, e.*,
    row_number() over w as pos from (select distinct def_id, event_result_id from counted) h
  join ev e on e.event_result_id = h.event_result_id
  window w as (partition by h.def_id order by e.open_time, e.event_result_id)),
latest as materialized (select *,
    coalesce(max(case when has_leak then pos end) over v, 0) as last_leak,
    coalesce(max(case when has_cve then pos end) over v, 0) as last_cve,
    coalesce(max(case when has_port then pos end) over v, 0) as last_port
  from placed window v as (partition by def_id order by pos rows unbounded preceding)),
reached as (select a.def_id, a.sub_id, a.event_result_id, p.pos as q from counted a
  join counted b on a.detail_id = b.detail_id and b.rn = a.rn - a.times + 1
  join placed p on p.def_id = b.def_id and p.event_result_id = b.event_result_id),
per_sub as (select r.def_id, r.sub_id, r.event_result_id, min(q) as q, max(q) as top, count(*) as got,
    any_value(n.need) as need from reached r join (select sub_id, count(*) as need from {_RULES} group by sub_id) n
    on n.sub_id = r.sub_id group by r.def_id, r.sub_id, r.event_result_id),
floors as materialized (select l.def_id, l.event_result_id, l.pos, l.open_time as ts, l.event_rule_id,
    nullif(case when s.top is not null then least({_FLOOR_OF}, s.top) end, 0) as floor
  from (select *, {_OS_A1} as os_a1 from latest) l
  left join (select *, {_Q} from per_sub) s on s.def_id = l.def_id and s.event_result_id = l.event_result_id)"""
_CHAIN_CTES = f"""{_FOLD_CTES},
can as materialized (select def_id, pos, floor from floors where floor is not null),
following as materialized (select a.def_id, a.pos, min(b.pos) as nxt from can a join can b
  on a.def_id = b.def_id and b.pos > a.pos and b.floor > a.pos group by all),
chain as (select def_id, min(pos) as pos, 0 as seq from can group by def_id
  union all select f.def_id, f.nxt, c.seq + 1 from chain c join following f on c.def_id = f.def_id and c.pos = f.pos),
fired as materialized (select c.def_id, c.pos, c.seq, md5('composite|' || c.def_id || '|' || c.seq) as record_id,
    f.ts, f.event_result_id, f.event_rule_id
  from chain c join floors f on f.def_id = c.def_id and f.pos = c.pos)"""


def _only_flow(expression: str, name: str) -> str:
    return f"case when e.proto = 'NE_FLOW' then {expression} end as {name}"


_COMPOSITE = f"""with recursive {_CHAIN_CTES}
select f.record_id, f.def_id as me_def_id, d.name, f.ts as storage_time, {_only_flow('e.event_rule_id', 'event_rule_id')},
  {_only_flow('e.event_rule_name', 'event_rule_name')}, {_only_flow('e.source_ip', 'source_ip')},
  {_only_flow('e.source_port', 'source_port')}, {_only_flow('e.dest_ip', 'dest_ip')},
  {_only_flow('e.dest_port', 'dest_port')}, {_only_flow('e.level', 'event_level')}, {_NULL} as app_proto, {_NULL} as url,
  {_NULL} as get_parameter, {_NULL} as proto, {_NULL} as open_time
from fired f join {_f('me_define')} d on d.record_id = f.def_id join {_EVENT} e on e.event_result_id = f.event_result_id"""
_MEMBERS = f"""with recursive {_CHAIN_CTES}
select md5('member|' || f.record_id || '|' || l.event_result_id) as record_id, l.event_result_id,
  f.record_id as composite_id
from floors l asof join fired f on l.def_id = f.def_id and l.pos <= f.pos"""
_ALARM_COMPOSITE = f"""with recursive {_CHAIN_CTES},
hits as (select p.record_id as policy_id, w.record_id as obj_id, p.count as n, f.ts, f.record_id as event_id, d.name,
    row_number() over (partition by p.record_id order by f.ts, f.record_id) as rn
  from fired f join {_f('me_define')} d on d.record_id = f.def_id
  join {_f('policy_composite')} p on lower(trim(p.relation_event_rule_id)) = lower(f.def_id)
  join {_f('policy_whole')} w on lower(trim(p.alarm_id)) = lower(w.record_id)
    and lower(w.obj_table) = 't_siem_alarm_policy_relation_ev')
{_alarm('hits where rn % n = 0', '联合事件【', 't_siem_alarm_policy_relation_ev')}"""

# --- flows --------------------------------------------------------------------------------------


def _number(ip: str) -> str:
    parts = [f"cast(split_part({ip}, '.', {i}) as bigint)" for i in (1, 2, 3, 4)]
    return f"({parts[0]} * 16777216 + {parts[1]} * 65536 + {parts[2]} * 256 + {parts[3]})"


def _in_ranges(ip: str) -> str:
    third, fourth = (f"cast(split_part({ip}, '.', {i}) as int)" for i in (3, 4))
    return (f"({ip} like '221.176.%' and ({third} in (64, 65, 68) or {third} between 70 and 79"
            f" or ({third} = 69 and {fourth} between 1 and 11)))")


_DISCOVERY = f"""select md5('asset|' || ip) as record_id, ip, cast(1 as integer) as is_new, cast(0 as integer) as flg,
  record_time as storage_time, proto as protocol, port, packets as package_num
from (select *, row_number() over (partition by ip order by record_time, port, proto, packets) as nth from (
    select srcip as ip, srcport as port, proto, packets, record_time from {_f('netflow')}
    where {_in_ranges('srcip')} and proto <> 'ICMP'
    union all
    select dstip, dstport, proto, packets, record_time from {_f('netflow')}
    where not {_in_ranges('srcip')} and {_in_ranges('dstip')} and proto = 'TCP' and packets >= 3))
where nth = 1 and lower(ip) not in (select lower(device_ip) from {_f('registered')})"""


def _monitored(ip: str) -> str:
    return f"regexp_matches({ip}, '^221[.]176[.](64|65|68|7[0-9])[.]')"


_END = f"case when {_monitored('srcip')} then srcip when {_monitored('dstip')} then dstip end"
_MS = "(epoch_ms(end_time) - epoch_ms(start_time))"
_PROFILE = f"""(select ip, cast(sum({_MS}) as bigint) as time, cast(sum(packets) as bigint) as packernum,
  cast(sum(bytes) as bigint) as bytesize, {', '.join(f"count(*) filter (proto = '{p}') as {p}" for p in ('TCP', 'ICMP', 'GRE', 'UDP'))}
  from (select *, {_END} as ip from {_f('netflow')}) where ip is not null group by ip)"""
_APP_COUNTS = ", ".join(
    [f"count(*) filter (appproto = '{p}') as {p.replace('-', '_')}"
     for p in ("QQ", "FTP", "HTTP", "TELNET", "DBAudit", "bd-local-trojan")]
    + [f"count(*) filter (method = '{m}') as {m}" for m in ("GET", "POST")])
_FEATURES = ["TCP", "ICMP", "GRE", "UDP", "time", "packernum", "bytesize"]
_FLOW_FEATURES = f"""(select dstip, record_time, cast(case upper(proto) when 'TCP' then 1 when 'UDP' then 2 when 'ICMP' then 3
  when 'GRE' then 4 end as double) as proto_code, cast({_MS} as double) as time_diff, cast(bytes as double) as flow_num,
  cast(packets as double) as packer_num from {_f('netflow')} where upper(proto) in ('TCP', 'UDP', 'ICMP', 'GRE'))"""
_CLUSTERED = f"(select *, cast(split_part(ip, '.', 4) as int) % 3 as cluster from {_PROFILE})"
_SUB_GROUPS = f"""(select * from {_f('flow_cluster')}
  where cluster in (select cluster from {_f('flow_cluster')} group by cluster having count(*) > 3))"""
_SUBCLUSTER = f"""with groups as {_SUB_GROUPS}, counted as (
  select g.cluster, g.ip, {_APP_COUNTS} from {_f('app_flow')} a left join groups s on s.ip = a.srcip
    join groups g on g.ip = a.srcip or (g.ip = a.dstip and s.cluster is distinct from g.cluster)
  group by g.cluster, g.ip)
select * from counted where cluster in (select cluster from counted group by cluster having count(*) > 3)"""


def _minmax(names: list[str]) -> str:
    scaled = ", ".join(
        f"round(coalesce((cast({n} as double) - min({n}) over ()) / nullif(cast(max({n}) over () - min({n}) over () as double), 0), 0), 6) as {n}_nor"
        for n in names)
    return f"select ip, {scaled} from {_PROFILE}"


_DISTANCE_SUM = " + ".join(f"power(p.{n} - c.{n}, 2)" for n in _FEATURES)
_DISTANCE = f"""with points as {_CLUSTERED}, centres as (
  select cluster, {', '.join(f'avg({n}) as {n}' for n in _FEATURES)} from points group by cluster)
select p.ip, p.cluster, round(sqrt({_DISTANCE_SUM}), 6) as distance,
  concat_ws('#', {', '.join(f'p.{n}' for n in _FEATURES)}) as center_info
from points p join centres c on c.cluster = p.cluster"""


def _scaled(source: str, parent: str, names: list[str]) -> str:
    """(parent, ip, x): features scaled to 0..1 inside each parent."""
    each = ", ".join(
        f"""coalesce((cast({n} as double) - cast(min({n}) over w as double))
    / nullif(cast(max({n}) over w as double) - cast(min({n}) over w as double), 0), 0.0)""" for n in names)
    return f"select {parent} as parent, ip, [{each}] as x from ({source}) window w as (partition by {parent})"


def _kmeans(points: str, width: int, counts: list[int]) -> str:
    """CTEs ``best`` (parent, k, centres), ``scored`` and ``labelled``: farthest-first centres, then means until none moves."""
    to = lambda x, c: "list_transform(" + c + ", lambda c: 0.0 + " + " + ".join(
        f"({x}[{i}] - c[{i}]) * ({x}[{i}] - c[{i}])" for i in range(1, width + 1)) + ")"
    pair = " + ".join(f"(p.x[{i}] - q.x[{i}]) * (p.x[{i}] - q.x[{i}])" for i in range(1, width + 1))
    means = ", ".join(f"round(avg(x[{i}]), 9)" for i in range(1, width + 1))
    return f"""with recursive points as materialized ({points}),
seeds(parent, centres) as (
  select parent, [max(x)] from points group by parent
  union all
  select parent, list_append(centres, far.x) from (
    select s.parent, any_value(s.centres) as centres, max({{'d': list_min({to('p.x', 's.centres')}), 'x': p.x}}) as far
    from seeds s join points p on p.parent = s.parent where len(s.centres) < {max(counts)} group by s.parent)
  where far.d > 0),
longest as materialized (select parent, arg_max(centres, len(centres)) as centres from seeds group by parent),
steps(parent, k, step, centres, moving) as (
  select parent, k, 0, centres[1:k], true from longest, (select unnest({counts}) as k)
  union all
  select parent, k, step + 1, renewed, renewed <> centres from (
    select s.parent, s.k, s.step, s.centres, list(coalesce(m.mean, s.centres[s.i]) order by s.i) as renewed
    from (select parent, k, step, centres, unnest(range(1, len(centres) + 1)) as i
          from steps where moving and step < 100) s
    left join (
      select parent, k, i, [{means}] as mean from (
        select p.parent, t.k, p.x, list_position(t.ds, list_min(t.ds)) as i from (
          select s.parent, s.k, p.ip, {to('p.x', 's.centres')} as ds
          from steps s join points p on p.parent = s.parent where s.moving and s.step < 100) t
        join points p on p.parent = t.parent and p.ip = t.ip)
      group by parent, k, i) m on m.parent = s.parent and m.k = s.k and m.i = s.i
    group by s.parent, s.k, s.step, s.centres)),
fitted as materialized (select parent, k, arg_max(centres, step) as centres from steps group by parent, k),
every as materialized (
  select parent, ip, k, x, list_position(ds, list_min(ds)) - 1 as cluster, list_min(ds) as square from (
    select p.parent, p.ip, p.x, f.k, {to('p.x', 'f.centres')} as ds from points p join fitted f on f.parent = p.parent)),
away as (
  select p.parent, p.k, p.ip, p.cluster, q.cluster as other, sum({pair}) as total, count(*) as n
  from every p join every q on q.parent = p.parent and q.k = p.k group by all),
sides as (
  select parent, k, ip, max(n) filter (other = cluster) as n,
    max(total / nullif(n - 1, 0)) filter (other = cluster) as a, min(total / n) filter (other <> cluster) as b
  from away group by parent, k, ip),
scored as materialized (
  select s.parent, s.k, avg(case when n = 1 or b is null then 0 else coalesce((b - a) / nullif(greatest(a, b), 0), 0) end) as silhouette,
    any_value(c.cost) as cost
  from sides s join (select parent, k, sum(square) as cost from every group by parent, k) c on c.parent = s.parent and c.k = s.k
  group by s.parent, s.k),
best as (
  select f.* from fitted f join (select parent, arg_max(k, [round(silhouette, 9), -k]) as k from scored group by parent) b
  on b.parent = f.parent and b.k = f.k),
labelled as (
  select e.parent, e.ip, e.k, cast(e.cluster as integer) as cluster, round(sqrt(e.square), 6) as distance
  from every e join best b on b.parent = e.parent and b.k = e.k)"""


_APP_FEATURES = ["QQ", "FTP", "HTTP", "TELNET", "DBAudit", "bd_local_trojan", "GET", "POST"]
_POINTS = _scaled(f"select * from {_PROFILE}", "0", _FEATURES)
_POINTS_2 = _scaled(_SUBCLUSTER, "cluster", _APP_FEATURES)
_STAMP = "2024-01-01 00:00:00"


def _centre_rows(level: int, names: list[str]) -> str:
    return f"""select cast(i - 1 as varchar) as center_index,
    array_to_string(list_transform(centres[i], lambda x: cast(cast(round(x * 1000000) as bigint) as varchar)), '#') as center_info,
    'batch-{level}' as clno, {level} as type, '{_STAMP}' as cltime, '{"#".join(names)}' as demo,
    {"cast(parent as varchar)" if level > 1 else _NULL} as center_index_p, {"'batch-1'" if level > 1 else _NULL} as clno_p
  from (select *, unnest(range(1, len(centres) + 1)) as i from best)"""


def _tokens(name: str) -> str:
    chars = f"list_transform(string_split({name}, ''), lambda c: 'socos' || lower(printf('%x', unicode(c))))"
    return f"case when trim({name}) <> '' then array_to_string({chars}, '') else '' end"


def _json_docs(name: str, columns: list[str], source: str, where: str) -> str:
    pairs = " || ',' || ".join(f"""'"{c}":"' || coalesce(cast({c} as varchar), '') || '"'""" for c in columns)
    return f"select '{name}' as rule_set, '{{' || {pairs} || '}}' as doc from {_f(source)} where {where}"


_LINE = """(select f, len(f) as parts from (select string_split(rtrim(value, '~'), '~') as f, value from {lines})
  where contains(value, '~'))"""


def _line_time(i: str) -> str:
    return f"try_strptime(trim({i}), '%Y-%m-%d %H:%M:%S')"


def _named(name: str) -> str:
    """Lines with their digest and occurrence number."""
    return f"""(select value, md5(value) || '#' || row_number() over (partition by value) as source from {_f(name)})"""


def oracle_sql() -> dict[str, str]:
    kind = "(case when k % 50 = 49 then 3 else k % 3 end)"
    lines = _LINE.format(lines=_f("raw_line"))
    general_doc = {
        "firstrecvtime": "epoch_us(first_recv_time) // 1000", "recordid": "record_id", "reportapp": "report_app",
        "reportip": "report_ip", "sourceip": "source_ip", "sourceport": "source_port", "destip": "dest_ip",
        "destport": "dest_port", "eventaction": "event_action", "actionresult": "action_result",
        "reportnetype": "report_ne_type", "eventdefid": "event_def_id", "eventname": "event_name",
        "eventlevel": "event_level", "orgid": "org_id", "appproto": "app_proto", "url": "url",
        "getparameter": "get_parameter", "orglog": "content", "logruleid": "log_rule_id",
        "eventname2": f"coalesce({_tokens('event_name')}, '')", **{c: c for c in EXT_FIELDS}}
    event_doc = {
        "event_rule_id": "lower(trim(event_rule_id))", "opentime": "epoch_us(open_time) // 1000",
        "event_rule_result_id": "event_result_id", "logid": "log_id", "event_rule_name": "event_rule_name",
        "event_rule_level": "event_rule_level", "reportneip": "report_ip", "sourceip": "source_ip",
        "sourceport": "source_port", "destip": "dest_ip", "destport": "dest_port", "actionopt": "action_opt",
        "is_inner": "is_inner", "proto": "proto", **{c: c for c in EXT_FIELDS}}
    doc = lambda d: ", ".join(f"{e} as {n}" for n, e in d.items())
    padded = f"""(select case when parts <= 6 then list_concat([md5(source)], f) else f end as f from (
      select f, len(f) as parts, source from (
        select string_split(rtrim(value, '~'), '~') as f, value, source from {_named('raw_line')}) where contains(value, '~')))"""
    sql = {
        "raw_parse": f"""select f[1] as log_id, {_line_time('f[2]')} as recv_time, f[3] as report_ip, f[4] as facility,
  f[5] as severity, f[6] as report_app, f[7] as content from {padded} where len(f) > 6""",
        "log_normalize": f"select * from {_GENERAL}",
        "log_match_flag": f"""select l.log_id, l.report_ip, m.log_rule_id,
  cast(case when m.log_rule_id is null then 1 else 0 end as integer) as is_match
  from {_f('raw_log')} l left join {_matched(LOG_RULES, True)} m on m.log_id = l.log_id""",
        "log_normalize_user": f"select * from {_general(USER_LOG_RULES, True)}",
        "log_normalize_user_large": f"""with rules as materialized (select c_custkey as k, case when c_custkey % 50 = 49 then ''
      when c_custkey % 3 = 0 then 'src=192.168.' || c_custkey % 16 || '.' || c_custkey % 256 || ':'
      when c_custkey % 3 = 1 then 'dst=221.176.' || 64 + c_custkey % 18 || '.' || c_custkey % 256 || ':'
      else ':' || 1024 + c_custkey % 1000 || ' dst=' end as part from customer),
  logs as materialized (select log_id, content, regexp_extract(content, 'va.=([0-9][0-9][0-9])$', 1) as three from {_f('raw_log')}),
  firsts as (select log_id, content, three, min(k) as k from logs join rules on contains(content, part)
    where part <> '' or three <> '' group by log_id, content, three)
  select md5('general|' || log_id) as record_id, 'u' || k as log_rule_id, 'd' || k % 7 as event_def_id,
    case when {kind} = 2 then regexp_extract(content, '([a-z]+) src=', 1) end as event_name,
    case when {kind} = 2 then regexp_extract(content, 'src=([0-9.]+):', 1) end as source_ip,
    case when {kind} = 0 then regexp_extract(content, 'src=[0-9.]+:([0-9]+)', 1) end as source_port,
    case when {kind} = 1 then regexp_extract(content, 'dst=[0-9.]+:([0-9]+)', 1) end as dest_port,
    case when {kind} = 3 then three end as get_parameter
  from firsts""",
        "event_name_tokens": f"select p_partkey, {_tokens('event_name')} as event_name2 from {_f('event_name')}",
        "token_dedup": f"select distinct unnest(string_split(value, ',')) as token from {_f('condition_text')}",
        "log_query": f"""select log_id, report_ip, report_app from {_f('raw_log')}
  where severity = 'error' and report_app = 'NE_FLOW'""",
        "event_builtin": f"select * from {_BUILTIN}",
        "event_user_fields": f"select * from {_user(True)}",
        "event_user_fields_full": f"select event_result_id, event_rule_id, log_id from {_user(False)}",
        "event_passthrough": f"select * from {_PASSTHROUGH}",
        "event_all": f"select * from {_BUILTIN} union all select * from {_user(True)}",
        "alarm_single": _ALARM_SINGLE,
        "alarm_windowed": _ALARM_WINDOWED,
        "alarm_windowed_reset": _ALARM_RESET,
        "alarm_composite": _ALARM_COMPOSITE,
        "threshold_totals": f"""select policy_id, n, max(rn) as hits, count(*) filter (rn % n = 0) as fires
  from {_POLICY_HITS} group by policy_id, n""",
        "corr_detail_hits": f"select * from {_HITS}",
        "corr_threshold": f"select * from {_COUNTED} where rn % times = 0",
        "corr_members": f"""select c.detail_id, (c.rn - 1) // c.times as bucket, c.event_result_id, e.event_rule_name,
  e.source_ip, e.dest_ip, e.dest_port
  from (select *, max(rn) over (partition by detail_id) as total from {_COUNTED}) c
  join {_EVENT} e on e.event_result_id = c.event_result_id
  where (c.rn - 1) // c.times < c.total // c.times""",
        "corr_leak_match": f"""select e.event_result_id, r.med_id, r.record_id as rule_id
  from {_LEAK_FLAGS} e join {_f('me_leak')} r on (r.cve_match = 1 and e.has_cve)
    or (r.leak_match = 1 and e.has_leak) or (r.port_match = 1 and e.has_port)""",
        "corr_intel_match": f"""select e.event_result_id, r.med_id, r.record_id as rule_id
  from {_EVENT} e join {_f('me_intel')} r on r.ip_match = 1 where {_IN_INTEL}""",
        "corr_asset_match": f"""with os as (select i.device_ip, max_by(a.os_id, a.ne_id) as os_id
    from {_f('asset')} a join {_f('asset_ip')} i on a.ne_id = i.ne_id group by i.device_ip)
  select e.event_result_id, r.med_id, r.record_id as rule_id from {_EVENT} e join {_f('asset_rule')} r
    on r.ip_addr = case r.ip_type when 2 then e.source_ip else e.dest_ip end
  left join os on os.device_ip = r.ip_addr where coalesce(os.os_id, 1) = r.os""",
        "corr_condition_exp": f"""select e.event_result_id, r.med_id, r.record_id as rule_id
  from {_EVENT} e join {_f('me_flow')} r on case r.record_id
    when 'f1' then e.source_port > '1200' and e.dest_port = '443' when 'f2' then true
    when 'f3' then e.source_ip < '192.168.5' and e.dest_ip > '221.176.7' end""",
        "corr_flow_asof": f"""select e.event_result_id, e.stat_time, e.stat_bytes, r.med_id, r.record_id as rule_id
  from {_FLOW_SEEN} e join {_f('me_flow')} r on case r.record_id when 'f1' then {_F1} when 'f2' then {_F2}
    when 'f3' then {_F3} end""",
        "corr_fold": f"with {_FOLD_CTES} select def_id, event_result_id, pos, cast(floor as bigint) as floor from floors",
        "corr_composite": _COMPOSITE,
        "corr_composite_members": _MEMBERS,
        "flow_json_explode": f"""with pair as (
  select source, 0 as position, json_extract_string(value, '$[0].SRCIP') as srcip,
    json_extract_string(value, '$[0].DstIp') as dstip, json_extract_string(value, '$[0].BYTES') as bytes
  from {_named('flow_message')}
  union all
  select source, 1, json_extract_string(value, '$[1].SRCIP'), json_extract_string(value, '$[1].DstIp'),
    json_extract_string(value, '$[1].BYTES') from {_named('flow_message')})
select md5('flow|' || source || '|' || position) as record_id, srcip, dstip, bytes,
  md5('flow|' || source || '|' || position) as recordid from pair""",
        "appflow_line_parse": f"""select md5('appflow|' || source) as record_id,
  json_extract_string(body, '$.SRCIP') as srcip, json_extract_string(body, '$.DSTIP') as dstip,
  json_extract_string(body, '$.AppProto') as appproto, json_extract_string(body, '$.METHOD') as method
  from (select source, array_to_string(list_slice(string_split(value, ' '), 2, 1000), '') as body
    from {_named('app_flow_line')})""",
        "ip_range_filter": f"""select srcip, {_number('srcip')} as src_number, dstip, srcport, start_time
  from {_f('netflow')} where {_in_ranges('srcip')}""",
        "ip_range_table": f"""with spans as (
    select {_number('begin_ip')} as lo, {_number('end_ip').replace('cast(', 'try_cast(')} as hi
    from {_f('monitored_range')}),
  sources as (select srcip, {_number('srcip')} as src_number from (select distinct srcip from {_f('netflow')})),
  held as (select * from sources where exists (select 1 from spans where src_number between lo and hi))
  select f.srcip, src_number, dstip, srcport, start_time from {_f('netflow')} f join held on f.srcip = held.srcip""",
        "netflow_range": f"""select srcip, dstip, proto, packets, bytes, record_time from {_f('netflow')}
  where record_time >= timestamp '1997-01-01' and record_time < timestamp '1998-01-01' and srcip is not null
    and dstip is not null and packets is not null and bytes is not null and end_time is not null""",
        "asset_discovery": _DISCOVERY,
        "asset_flow_profile": f"select * from {_PROFILE}",
        "asset_app_profile": f"""select ip, {_APP_COUNTS} from (select *, {_END} as ip from {_f('app_flow')})
  where ip is not null group by ip""",
        "asset_subcluster_features": _SUBCLUSTER,
        "asset_minmax": _minmax(_FEATURES),
        "flow_features": f"select * from {_FLOW_FEATURES}",
        "flow_standardize": "select dstip, record_time, " + ", ".join(
            f"round(coalesce({n} / nullif(stddev_samp({n}) over (), 0), 0), 6) as {n}_scl"
            for n in ("proto_code", "time_diff", "flow_num", "packer_num")) + f" from {_FLOW_FEATURES}",
        "flow_index_lookup": f"""select * from {_f('keyed_flow')} where rowkey in (select rowkey from {_f('flow_index')}
  where record_time between timestamp '1996-01-01' and timestamp '1996-12-31')""",
        "asset_distance": _DISTANCE,
        "asset_kmeans": f"{_kmeans(_POINTS, 7, [5])} select ip, cluster, distance from labelled",
        "asset_kmeans_l2": f"{_kmeans(_POINTS_2, 8, [2, 3, 5])} select parent, ip, k, cluster, distance from labelled",
        "asset_silhouette": f"{_kmeans(_POINTS, 7, [3, 4, 5])} select k, round(silhouette, 6) as silhouette, round(cost, 6) as cost from scored",
        "stored_cluster_point": f"""{_kmeans(_POINTS, 7, [5])}
  select 'batch-1' as clno, l.ip as name, cast(cluster as varchar) as center_index, distance,
    concat_ws('#', {', '.join(f'p.{n}' for n in _FEATURES)}) as center_info, '{_STAMP}' as cltime, '{"#".join(_FEATURES)}' as demo
  from labelled l join {_PROFILE} p on p.ip = l.ip""",
        "stored_cluster_centre": f"""select * from ({_kmeans(_POINTS, 7, [5])} {_centre_rows(1, _FEATURES)})
  union all select * from ({_kmeans(_POINTS_2, 8, [2, 3, 5])} {_centre_rows(2, _APP_FEATURES)})""",
        "asset_cluster_sizes": f"select cluster, count(*) as size from {_CLUSTERED} group by cluster",
        "rules_log_regex": f"""select r.*, l.device_ip from {_f('store_regex')} r right join (
    select lib.log_rule_lib_id, ne.device_ip from {_f('store_lib')} lib join (
      select a.htype_id, a.vendor_id, a.model, i.device_ip from {_f('store_asset')} a
      left join {_f('store_asset_ip')} i on i.ne_id = a.ne_id) ne
    on lib.htype_id = ne.htype_id and lib.vendor_id = ne.vendor_id and lib.model = ne.model) l
  on l.log_rule_lib_id = r.log_rule_lib_id where l.device_ip is not null and r.log_rule_id is not null""",
        "rules_event_builtin": f"""select d.event_rule_id, d.event_rule_name, d.event_rule_level, d.event_basic_type,
    d.event_sub_type, f.begin_value, f.field, f.method
  from {_f('store_event_def')} d right join {_f('store_event_field')} f on d.event_rule_id = f.event_rule_id
  where d.is_inner = 1 and d.is_use = 1""",
        "rules_snapshot": _json_docs(
            "policy_whole",
            ["recordid", "alarm_name", "start_time", "end_time", "alarm_level", "alert_type", "objtable", "objid",
             "alarm_comment", "status"], "store_policy", "status = 1") + " union all " + _json_docs(
            "composite_sub", ["recordid", "medefineid", "op", "objtable", "status"], "store_sub", "status = 1"),
        "stored_raw_log": f"""select md5('raw|' || f[1]) as "row", f[1] as recordid, epoch_ms({_line_time('f[2]')}) as recvtime,
  epoch_ms({_line_time('f[2]')}) as storagetime, f[3] as reportip, f[6] as reportapp, f[7] as logcontent,
  cast(case when trim(f[8]) = '' then 1 else coalesce(try_cast(trim(f[8]) as integer), 0) end as integer) as ismatch
  from {lines} where parts >= 8""",
        "stored_general_log": f"""select md5('row|' || record_id) as "row", {doc(general_doc)} from {_GENERAL}""",
        "stored_event": f"""select md5('row|' || event_result_id) as "row", {doc(event_doc)} from {_BUILTIN}""",
        "stored_composite": f"""select md5('row|' || record_id) as "row", record_id as recordid, me_def_id as medid,
  epoch_us(storage_time) // 1000 as storagetime from ({_COMPOSITE})""",
        "stored_composite_member": f"""select md5('row|' || composite_id) as "row", record_id as recordid,
  event_result_id as event_rule_result_id, composite_id as t_s_recordid from ({_MEMBERS})""",
        "stored_alarm": f"""select md5('row|' || record_id) as "row", record_id as recordid,
  epoch_us(first_alarm_time) // 1000 as firstalarmtime, content as alarmcontent, obj_table as objtable, obj_id as objid,
  alarm_times as alarmtimes from ({_ALARM_SINGLE})""",
    }
    return sql
