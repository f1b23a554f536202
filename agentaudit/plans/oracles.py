"""SQL twins of the catalogue, for DuckDB over the same tables."""

from __future__ import annotations

from ..functions.pii import PATTERNS
from ..schema import JSON_COLUMNS
from .fixtures import CIRCULAR_SQL, END, NOW, PAUSE_SQL, RECORDS_SQL, START, STATE

W = f"with {RECORDS_SQL}"
WR = f"with recursive {RECORDS_SQL}"
RANGE = f"timestamp between timestamp '{START}' and timestamp '{END}'"
TOKENS = "coalesce(input_tokens, 0) + coalesce(output_tokens, 0)"
LABEL = "coalesce(nullif(agent_name, ''), agent_id)"
DOUBLE = "round(cast({} as double), 9)"


def _d(sql: str) -> str:
    return DOUBLE.format(sql)


STEPS = f"""steps as (
 select trace_id, timestamp, span_id, parent_span_id, agent_id, {LABEL} as agent_name,
        coalesce(operation_name, 'unknown') as operation, coalesce(duration_ms, 0) as duration_ms,
        status, model_name as model, input_tokens, output_tokens,
        coalesce(cost_usd, 0) as cost_usd, reasoning ->> '$.rationale' as rationale,
        cast(reasoning ->> '$.confidence' as double) as confidence,
        coalesce(tool_calls, '[]') as tool_calls,
        case when status = 'error' then concat(coalesce(error_type, 'None'), ': ', coalesce(error_message, 'None')) end as error,
        row_number() over (partition by trace_id order by timestamp, span_id) as sequence
 from records)"""

TOTALS = f"""agents as (
 select trace_id, {LABEL} as agent, sum(coalesce(duration_ms, 0)) as ms, sum(coalesce(cost_usd, 0)) as cost,
        min(row(timestamp, span_id)) as seen
 from records group by 1, 2),
leaders as (
 select trace_id, arg_min(agent, row(-ms, seen)) as bottleneck_agent, arg_min(agent, row(-cost, seen)) as costliest_agent
 from agents group by 1),
totals as (
 select r.trace_id,
        cast(floor((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1000) as bigint)
          + arg_max(coalesce(duration_ms, 0), row(timestamp, span_id)) as total_duration_ms,
        {_d('sum(coalesce(cost_usd, 0))')} as total_cost_usd, cast(sum({TOKENS}) as bigint) as total_tokens,
        count(distinct agent_id) as agent_count, count(*) as span_count,
        count(*) filter (where status = 'error') as error_count,
        cast(sum(coalesce(json_array_length(tool_calls), 0)) as bigint) as tool_call_count,
        count(*) filter (where not all_passed) as guardrail_failures
 from records r group by 1)"""

PATH = f"""walk as (
 select trace_id, span_id, cast(coalesce(duration_ms, 0) as bigint) as total, list_value(sequence) as seqs,
        list_value(agent_name) as names, list_value(duration_ms) as durs, list_value(span_id) as ids
 from steps where parent_span_id is null
 union all
 select s.trace_id, s.span_id, w.total + s.duration_ms, list_append(w.seqs, s.sequence),
        list_append(w.names, s.agent_name), list_append(w.durs, s.duration_ms), list_append(w.ids, s.span_id)
 from walk w join steps s on s.trace_id = w.trace_id and s.parent_span_id = w.span_id),
ranked as (
 select *, row_number() over (partition by trace_id order by total desc, seqs) as rn from walk),
best as (select * from ranked where rn = 1 and total > 0)"""

TREE = """nodes as (
 select r.trace_id, r.span_id, p.span_id as parent, r.timestamp
 from records r left join records p on p.trace_id = r.trace_id and p.span_id = r.parent_span_id),
down as (
 select trace_id, span_id, 0 as depth, span_id as root_span_id from nodes where parent is null
 union all
 select n.trace_id, n.span_id, d.depth + 1, d.root_span_id
 from down d join nodes n on n.trace_id = d.trace_id and n.parent = d.span_id)"""

CALLS = """calls as (
 select trace_id, span_id, unnest(cast(json_extract(tool_calls, '$[*]') as json[])) as call
 from records where tool_calls is not null)"""

TOOL = "json_extract_string(call, '$.\"gen_ai.tool.name\"')"
TOOL_TYPE = "json_extract_string(call, '$.\"gen_ai.tool.type\"')"
FIRST_TOOL = "json_extract_string(tool_calls, '$[0].\"gen_ai.tool.name\"')"

FLAGS = """flags as (
 select trace_id, bool_or(status = 'error') as has_error, bool_or(coalesce(not all_passed, false)) as has_failed_check,
        bool_or(risk_level in ('high', 'critical')) as has_risk, count(*) as spans, min(timestamp) as first_start,
        max(timestamp) as last_start, max(timestamp + to_milliseconds(duration_ms)) as last_end,
        epoch_us(max(timestamp + to_milliseconds(duration_ms))) - epoch_us(min(timestamp)) > 5000000 as is_slow,
        cast('0x' || left(sha256(trace_id), 8) as bigint) % 10000 < 1000 as is_lucky
 from records group by 1),
decided as (
 select *, has_error or has_failed_check or has_risk or is_slow or is_lucky as keep from flags)"""


def _per_agent(group: str, where: str = "true", tokens: str | None = TOKENS) -> str:
    extra = f", cast(sum({tokens}) as bigint) as total_tokens" if tokens else ""
    return f"""{W} select {group}, count(*) as invocations, {_d('sum(cost_usd)')} as total_cost,
 {_d('avg(duration_ms)')} as avg_latency_ms{extra} from records where {where} group by {group}"""


def _spikes(value: str, cols: str, agg: str, quiet: bool) -> str:
    """Hours before on the clock; ``quiet`` hours count as zero, or else not at all."""
    frame = "rows between 24 preceding and 1 preceding" if quiet else (
        "range between interval 24 hours preceding and interval 1 hour preceding")
    series = f"""every as (
 select agent_name, unnest(generate_series(called, coalesce(following - interval 1 hour, called), interval 1 hour)) as hour,
  called, {value} from (select *, hour as called, lead(hour) over (partition by agent_name order by hour) as following
  from hourly)),
series as (select * replace (if(hour = called, {value}, 0.0) as {value}) from every)""" if quiet else (
        "series as (select *, hour as called from hourly)")
    return f"""{W}, hourly as (
 select agent_name, date_trunc('hour', timestamp)::timestamp as hour, {agg} from records group by 1, 2),
{series},
framed as (
 select *, avg({value}) over w as base, stddev_samp({value}) over w as spread from series
 window w as (partition by agent_name order by hour {frame}))
 select agent_name, hour, {cols}, {_d('base')} as baseline, {_d('spread')} as spread, coalesce({value} > base + 2.0 * spread, false) as is_spike
 from framed where hour = called"""


def _redact_steps(strategy: str, kinds: list[str], table: str = "documents", key: str = "doc_id") -> tuple[str, str]:
    """Steps that run the patterns one after another, and the name of the last."""
    def new(kind: str) -> str:
        if strategy == "hash":
            return f"concat('[{kind}:sha256:', left(sha256(m), 12), ']')"
        if strategy == "remove":
            return f"'[{kind}:REDACTED]'"
        if kind == "email":
            return "regexp_replace(m, '[^@]', '*', 'g')"
        return f"concat(repeat('*', cast(least(length(m), 12) as bigint)), '[{kind}]')"

    parts, last = [], table
    for i, kind in enumerate(kinds):
        pattern = PATTERNS[kind]
        parts.append(f"""s{i} as (select {key},
 array_to_string(list_transform(list_zip(string_split_regex(text, '{pattern}'),
   list_append(list_transform(regexp_extract_all(text, '{pattern}'), lambda m: {new(kind)}), '')),
   lambda z: concat(z[1], z[2])), '') as text from {last})""")
        last = f"s{i}"
    return ", ".join(parts), last


def _redact_sql(strategy: str) -> str:
    steps, last = _redact_steps(strategy, list(PATTERNS))
    return f"with {steps} select doc_id, text from {last}"


def _detect_steps(table: str, key: str, kinds: list[str]) -> str:
    """Matches with offsets: lengths of pieces and matches summed up in order."""
    raw = " union all ".join(f"""select {key}, '{kind}' as type, {n} as nth,
 unnest(regexp_extract_all(text, '{PATTERNS[kind]}')) as m,
 unnest(list_slice(string_split_regex(text, '{PATTERNS[kind]}'), 1, len(regexp_extract_all(text, '{PATTERNS[kind]}')))) as g,
 generate_subscripts(regexp_extract_all(text, '{PATTERNS[kind]}'), 1) as i from {table}"""
                             for n, kind in enumerate(kinds))
    return f"""raw as ({raw}),
hits as (
 select {key}, type, nth, length(m) as length,
        sum(length(g) + length(m)) over (partition by {key}, type order by i) as stop from raw),
found as (
 select {key}, type, nth, cast(stop - length as bigint) as start, cast(stop as bigint) as "end",
        cast(length as bigint) as length from hits)"""


def _scan_sql() -> str:
    steps, last = _redact_steps("hash", list(PATTERNS))
    return f"""with {steps}, {_detect_steps("documents", "doc_id", list(PATTERNS))},
 f as (select doc_id, count(*) as n, string_agg(distinct type, ',' order by type) as types from found group by 1)
 select d.doc_id, length(d.text) as original_length,
 case when f.n > 0 then length(r.text) else length(d.text) end as redacted_length,
 coalesce(f.n, 0) > 0 as pii_detected, coalesce(f.n, 0) as detections, coalesce(f.types, '') as types
 from documents d join {last} r using (doc_id) left join f using (doc_id)"""


def _guardrails_sql() -> str:
    kinds = ["email", "phone", "credit_card"]
    steps, last = _redact_steps("hash", kinds)
    return f"""with {steps}, {_detect_steps("documents", "doc_id", kinds)},
 t as (select doc_id, type, min(nth) as nth, count(*) as n from found group by 1, 2),
 f as (select doc_id, sum(n) as n, string_agg(type, ', ' order by nth) as types from t group by 1)
 select d.doc_id, coalesce(f.n, 0) = 0 and d.n_chars % 100 / 200 < 0.3 as all_passed, coalesce(f.n, 0) = 0 as pii_passed,
 cast(coalesce(f.n, 0) as double) as pii_score,
 case when f.n > 0 then concat('PII types found: ', f.types) else 'Clean' end as details,
 d.n_chars % 100 / 200 < 0.3 as score_passed, md5(r.text) as clean_md5
 from documents d join {last} r using (doc_id) left join f using (doc_id)"""


DETECT = _detect_steps("documents", "doc_id", list(PATTERNS))
TURNS = _detect_steps("turns", "turn_id", list(PATTERNS))

EMAIL = PATTERNS["email"]
# All strings of all payload columns, with their paths, and what the patterns find in them.
_LEAVES = " union all ".join(f"""select concat(span_id, '|{c}', replace(substr(t.fullkey, 2), '"', '')) as key,
 t.atom ->> '$' as text from records_ r, json_tree(r.{c}) t where t.type = 'VARCHAR'""" for c in JSON_COLUMNS)
PAYLOAD_LEAVES = f"""records_ as (select *, {STATE} as state from records), leaves as ({_LEAVES})"""
_REDACTED_LEAVES = _redact_steps("hash", list(PATTERNS), "leaves", "key")
PAYLOAD = f"""{PAYLOAD_LEAVES}, {_detect_steps("leaves", "key", list(PATTERNS))},
located as (select split_part(key, '|', 1) as span_id, substr(key, strpos(key, '|') + 1) as field_path, * from found)"""

ERR = "concat(coalesce(error_type, 'None'), ': ', coalesce(error_message, 'None'))"
TEXT_BOOL = "coalesce(cast({0} as varchar), '') as {0}"

ORACLES: dict[str, str] = {
    "trace_scan": f"""{W}, worst as (
 select trace_id from records group by 1 order by count(*) filter (where status = 'error') desc, trace_id limit 1)
 select trace_id, span_id, timestamp, agent_id, operation_name, cast(duration_ms as bigint) as duration_ms, status
 from records where trace_id in (select trace_id from worst)""",
    "agent_records": f"""{W} select trace_id, span_id, timestamp, operation_name, cast(duration_ms as bigint) as duration_ms,
 {_d('cost_usd')} as cost_usd from records where agent_id = 'agent-3' and {RANGE} order by timestamp, span_id limit 1000""",
    "errors_recent": f"""{W} select trace_id, span_id, timestamp, agent_id, {ERR} as error
 from records where status = 'error' and {RANGE} order by timestamp desc, span_id limit 500""",
    "guardrail_failures": f"""{W} select trace_id, span_id, timestamp, agent_id, operation_name
 from records where compliance ->> '$.all_passed' = 'false' and {RANGE}""",
    "human_oversight": f"""{W} select trace_id, span_id, agent_name, timestamp, operation_name
 from records where compliance ->> '$.human_in_loop' = 'true' and {RANGE}""",
    "reasoning_trail": f"""{W} select trace_id, timestamp, span_id, agent_name, reasoning ->> '$.rationale' as rationale,
 {_d("reasoning ->> '$.confidence'")} as confidence from records""",
    "cost_attribution": _per_agent("agent_name", RANGE),
    "cost_hourly": f"""{W} select agent_name, date_trunc('hour', timestamp) as hour, count(*) as invocations,
 {_d('sum(cost_usd)')} as total_cost, {_d('avg(duration_ms)')} as avg_latency_ms,
 cast(sum(input_tokens + output_tokens) as double) as total_tokens from records group by 1, 2""",
    "cost_last_24h": _per_agent("agent_name", f"timestamp > timestamp '{NOW}' - interval 24 hours and timestamp <= timestamp '{NOW}'", None),
    "version_compare": f"""{W} select agent_name, agent_version, config_hash, count(*) as invocations,
 {_d('sum(cost_usd)')} as total_cost, {_d('avg(duration_ms)')} as avg_latency_ms,
 count(*) filter (where status = 'error') as errors, {_d("avg(cast(status = 'error' as int))")} as error_rate
 from records group by 1, 2, 3""",
    "cost_spikes": _spikes("cost", f"{_d('cost')} as cost", "cast(sum(cost_usd) as double) as cost", True),
    "error_spikes": _spikes(
        "error_rate", f"calls, {_d('error_rate')} as error_rate",
        "count(*) as calls, avg(cast(status = 'error' as int)) as error_rate", False),
    "usage_periods": f"""{W} select date_trunc('day', timestamp)::timestamp as day, min(timestamp) as first_use,
 max(timestamp) as last_use, count(*) as total_operations from records where {RANGE} group by 1""",
    "root_usage_periods": f"""{W} select date_trunc('day', timestamp)::timestamp as day, min(timestamp) as first_start,
 max(timestamp + to_milliseconds(coalesce(duration_ms, 0))) as last_end, count(*) as sessions
 from records where parent_span_id is null group by 1""",
    "reference_databases": f"""{W}, {CALLS} select {TOOL} as tool_name, {TOOL_TYPE} as tool_type, count(*) as usage_count
 from calls group by 1, 2""",
    "guardrail_summary": f"""{W}, s as (select count(*) as total_checked,
 count(*) filter (where compliance ->> '$.all_passed' = 'true') as passed,
 count(*) filter (where compliance ->> '$.all_passed' = 'false') as failed
 from records where compliance is not null and {RANGE})
 select total_checked, passed, failed, {_d('passed / greatest(total_checked, 1) * 100')} as pass_rate_pct,
 printf('%.1f%%', passed / greatest(total_checked, 1) * 100) as pass_rate from s""",
    "compliance_report_long": f"""{W}, {CALLS},
s as (select count(*) as n, count(*) filter (where compliance ->> '$.all_passed' = 'true') as passed,
 count(*) filter (where compliance ->> '$.all_passed' = 'false') as failed from records where compliance is not null and {RANGE})
select 'usage_periods' as section, '' as tool_name, '' as tool_type, '' as trace_id, '' as span_id, '' as agent_name,
 '' as operation_name, '' as pass_rate, count(*) as total_operations, cast(null as bigint) as usage_count,
 cast(null as bigint) as total_checked, cast(null as bigint) as passed, cast(null as bigint) as failed,
 date_trunc('day', timestamp)::timestamp as at_day, min(timestamp) as at_first_use, max(timestamp) as at_last_use,
 cast(null as timestamp) as at_timestamp, cast(null as double) as pass_rate_pct
from records where {RANGE} group by date_trunc('day', timestamp)
union all select 'reference_databases', coalesce({TOOL}, ''), coalesce({TOOL_TYPE}, ''), '', '', '', '', '', null, count(*), null, null, null,
 null, null, null, null, null from calls group by {TOOL}, {TOOL_TYPE}
union all select 'human_oversight_events', '', '', trace_id, span_id, coalesce(agent_name, ''), operation_name, '', null, null, null, null, null,
 null, null, null, timestamp, null from records where compliance ->> '$.human_in_loop' = 'true' and {RANGE}
union all select 'guardrail_summary', '', '', '', '', '', '', printf('%.1f%%', passed / greatest(n, 1) * 100), null, null, n, passed, failed,
 null, null, null, null, {_d('passed / greatest(n, 1) * 100')} from s""",
    "risk_tags": f"""{W}, d as (select *, list_value('Employment & HR', 'Credit & Finance', 'Healthcare', 'Education',
 'Law Enforcement', 'Critical Infrastructure', 'Biometrics', null)[cast((input_tokens % 80) // 10 + 1 as int)] as risk_domain from records)
 select risk_level, risk_domain, risk_domain is not null or risk_level in ('high', 'critical') as is_high_risk,
 count(*) as records from d group by all""",
    "replay_steps": f"""{W}, {STEPS} select * replace (cast(duration_ms as bigint) as duration_ms,
 cast(input_tokens as bigint) as input_tokens, cast(output_tokens as double) as output_tokens,
 {_d('cost_usd')} as cost_usd, {_d('confidence')} as confidence) from steps""",
    "timeline_lines": f"""{W}, {STEPS} select trace_id, sequence, concat(
 printf('  [%02d] %s %s', sequence, case when status = 'ok' then '✅' else '❌' end, agent_name),
 chr(10), '       Operation: ', operation,
 chr(10), printf('       Duration:  %dms | Cost: %s | %d tok', duration_ms,
   case when cost_usd <> 0 then printf('$%.4f', cast(cost_usd as double)) else '—' end, {TOKENS}),
 chr(10), '       Model:     ', model,
 case when rationale <> '' then concat(chr(10), '       Reasoning: ', left(rationale, 100), '...') else '' end,
 case when tool_calls <> '[]' then concat(chr(10), '       Tools:     ', array_to_string(list_transform(
   cast(json_extract(tool_calls, '$[*]') as json[]), lambda c: coalesce(json_extract_string(c, '$."gen_ai.tool.name"'), '?')), ', ')) else '' end,
 case when error <> '' then concat(chr(10), '       Error:     ', left(error, 100)) else '' end) as line
 from steps""",
    "timeline_summary": f"""{W}, {TOTALS} select t.trace_id, concat(
 printf('  Total: %dms | $%.4f | %d tokens', total_duration_ms, total_cost_usd, total_tokens), chr(10),
 printf('  Agents: %d | Spans: %d | Errors: %d', agent_count, span_count, error_count), chr(10),
 '  Bottleneck: ', bottleneck_agent, chr(10), '  Costliest:  ', costliest_agent) as line
 from totals t join leaders l on l.trace_id = t.trace_id""",
    "tao_rows": f"""{W}, p as (
 select trace_id, timestamp, span_id, 0 as ord, 1 as phase, 'thought' as kind, reasoning as detail from records where reasoning is not null
 union all
 select trace_id, timestamp, span_id, 100 + i, 2, 'action', coalesce(json_extract_string(tool_calls, concat('$[', i, ']."gen_ai.tool.name"')), '?')
 from (select *, unnest(range(cast(json_array_length(tool_calls) as bigint))) as i from records where tool_calls is not null)
 union all
 select trace_id, timestamp, span_id, 200, 2, 'action', inter_agent from records where inter_agent is not null
 union all
 select trace_id, timestamp, span_id, 300 + i, 3, 'observation', json_extract_string(tool_calls, concat('$[', i, ']."tool.response_status"'))
 from (select *, unnest(range(cast(json_array_length(tool_calls) as bigint))) as i from records where tool_calls is not null)
 where json_extract_string(tool_calls, concat('$[', i, ']."tool.response_status"')) is not null
 union all
 select trace_id, timestamp, span_id, 400, 3, 'observation', case when status = 'error' then {ERR} else status end from records)
 select trace_id, timestamp, span_id, row_number() over (partition by span_id order by ord) - 1 as pos,
 cast(phase as bigint) as phase, kind, detail from p""",
    "span_tree": f"""{WR}, {TREE} select n.trace_id, n.span_id, n.parent as parent_span_id, n.parent is null as is_root,
 cast(d.depth as bigint) as depth, d.root_span_id,
 row_number() over (partition by n.trace_id, n.parent order by n.timestamp, n.span_id) as sibling_no,
 (select count(*) from nodes c where c.trace_id = n.trace_id and c.parent = n.span_id) as child_count,
 (select count(*) from records r where r.trace_id = n.trace_id and r.span_id = n.span_id) as copies
 from nodes n join down d on d.trace_id = n.trace_id and d.span_id = n.span_id""",
    # Nodes in pre-order; each closes itself and the ancestors that end with it.
    "span_forest_json": f"""{WR}, {TREE}, numbered as (
 select n.trace_id, n.span_id, n.parent, coalesce(nullif(r.agent_name, ''), r.agent_id) as agent_name,
  coalesce(r.duration_ms, 0) as ms,
  row_number() over (partition by n.trace_id, n.parent order by n.timestamp, n.span_id) as nth
 from nodes n join records r on r.trace_id = n.trace_id and r.span_id = n.span_id),
walk as (
 select *, 0 as depth, [nth] as path from numbered where parent is null
 union all
 select n.*, w.depth + 1, list_append(w.path, n.nth) from walk w join numbered n on n.trace_id = w.trace_id and n.parent = w.span_id),
pieces as (select *, lead(depth) over (partition by trace_id order by path) as following from walk)
 select trace_id, concat('[', string_agg(concat(case when nth > 1 then ',' else '' end, '{{"span_id":"', span_id,
  '","agent_name":"', agent_name, '","duration_ms":', ms, ',"children":[',
  repeat(']}}', cast(depth - coalesce(following, 0) + 1 as bigint))), '' order by path), ']') as forest,
 count(*) as spans, count(*) filter (where following is null or following <= depth) as leaves from pieces group by 1""",
    "span_forest_pieces": f"""{WR}, {TREE}, numbered as (
 select n.trace_id, n.span_id, n.parent, coalesce(nullif(r.agent_name, ''), r.agent_id) as agent_name,
  coalesce(r.duration_ms, 0) as ms,
  row_number() over (partition by n.trace_id, n.parent order by n.timestamp, n.span_id) as nth
 from nodes n join records r on r.trace_id = n.trace_id and r.span_id = n.span_id),
walk as (
 select *, 0 as depth, [nth] as path from numbered where parent is null
 union all
 select n.*, w.depth + 1, list_append(w.path, n.nth) from walk w join numbered n on n.trace_id = w.trace_id and n.parent = w.span_id),
pieces as (select *, lead(depth) over (partition by trace_id order by path) as following,
                  row_number() over (partition by trace_id order by path) - 1 as position from walk)
 select trace_id, position, cast(depth as bigint) as depth, concat(case when nth > 1 then ',' else '' end, '{{"span_id":"', span_id,
  '","agent_name":"', agent_name, '","duration_ms":', ms, ',"children":[',
  repeat(']}}', cast(depth - coalesce(following, 0) + 1 as bigint))) as piece from pieces""",
    "critical_path": f"""{WR}, {STEPS}, {PATH} select trace_id, unnest(range(len(seqs))) as position, unnest(ids) as span_id,
 unnest(names) as agent_name, cast(unnest(durs) as bigint) as duration_ms from best""",
    "trace_analysis": f"""{WR}, {STEPS}, {PATH}, {TOTALS} select t.*, l.bottleneck_agent, l.costliest_agent,
 coalesce(len(b.seqs), 0) as path_length, coalesce(b.total, 0) as path_duration_ms
 from totals t join leaders l on l.trace_id = t.trace_id left join best b on b.trace_id = t.trace_id""",
    "trace_diff": f"""{W}, {TOTALS},
 n as (select t.*, l.bottleneck_agent as bottleneck, cast('0x' || trace_id as bigint) as num
       from totals t join leaders l using (trace_id))
 select a.trace_id as trace_a, lower(lpad(to_hex(a.num + 1), 32, '0')) as trace_b,
 coalesce(b.total_duration_ms, 0) - a.total_duration_ms as duration_diff_ms,
 round(coalesce(b.total_cost_usd, 0) - a.total_cost_usd, 9) as cost_diff_usd,
 coalesce(b.total_tokens, 0) - a.total_tokens as token_diff, coalesce(b.span_count, 0) - a.span_count as span_count_diff,
 coalesce(b.error_count, 0) - a.error_count as error_count_diff, a.total_duration_ms as total_duration_ms_a,
 coalesce(b.total_duration_ms, 0) as total_duration_ms_b, a.bottleneck as bottleneck_agent_a, b.bottleneck as bottleneck_agent_b
 from n a left join n b on b.num = a.num + 1""",
    "trace_stitch": f"""{W}, c as (select trace_id, span_id, traceparent,
 nullif(regexp_extract(traceparent, '^00-([0-9a-f]{{32}})-([0-9a-f]{{16}})-[0-9a-f]{{2}}$', 1), '') as caller_trace_id,
 nullif(regexp_extract(traceparent, '^00-([0-9a-f]{{32}})-([0-9a-f]{{16}})-[0-9a-f]{{2}}$', 2), '') as caller_span_id
 from records where traceparent is not null)
 select c.caller_trace_id, c.caller_span_id, c.trace_id, c.span_id, c.traceparent,
 coalesce(nullif(r.agent_name, ''), r.agent_id) as caller_agent,
 case when c.caller_trace_id is null then 'malformed' when r.span_id is null then 'missing' else 'linked' end as link
 from c left join records r on r.trace_id = c.caller_trace_id and r.span_id = c.caller_span_id""",
    "delegation_edges": f"""{W}, e as (
 select p.agent_id as src, c.agent_id as dst, 'span' as protocol from records c
 join records p on p.trace_id = c.trace_id and p.span_id = c.parent_span_id where p.agent_id <> c.agent_id
 union all select agent_id, inter_agent ->> '$.target_agent', inter_agent ->> '$.protocol' from records where inter_agent is not null)
 select src, dst, protocol, count(*) as handoffs from e group by 1, 2, 3""",
    "lineage_score": f"""{W}, x as (
 select c.trace_id, c.parent_span_id is null or p.span_id is not null as linked, c.reasoning is not null as reasoned,
 c.tool_calls is not null as tooled,
 c.tool_calls is not null and len(regexp_extract_all(c.tool_calls, 'response_status')) = json_array_length(c.tool_calls) as answered
 from records c left join records p on p.trace_id = c.trace_id and p.span_id = c.parent_span_id)
 select trace_id, count(*) as spans, {_d('avg(cast(linked as int))')} as linked_share,
 {_d('avg(cast(reasoned as int))')} as reasoning_share,
 {_d('case when count(*) filter (where tooled) > 0 then count(*) filter (where answered) / count(*) filter (where tooled) end')} as tool_status_share,
 bool_and(linked and reasoned and (answered or not tooled)) as is_complete from x group by 1""",
    "loop_repeats": f"""{W}, x as (
 select trace_id, timestamp, span_id, {LABEL} as agent, operation_name as operation,
 coalesce(reasoning ->> '$.selected_action', '') as action,
 row_number() over (partition by trace_id order by timestamp, span_id) as seq from records),
 y as (select *, row_number() over (partition by trace_id, agent, operation, action order by seq) as nth from x),
 z as (select trace_id, agent, operation, action, seq - nth as island, count(*) as run,
       min(case when nth = 3 then timestamp end) as t from y group by all)
 select trace_id, agent, operation, action, cast(sum(run) as bigint) as repeats, max(run) as longest_run,
 min(t) as tripped_at from z group by 1, 2, 3, 4""",
    "recursion": f"""{WR}, x as (
 select trace_id, span_id, parent_span_id, {LABEL} as agent, operation_name as operation from records),
 e as (select c.*, p.span_id as up from x c left join x p on p.trace_id = c.trace_id and p.span_id = c.parent_span_id
       and p.agent = c.agent and p.operation = c.operation),
 w as (select trace_id, span_id, span_id as top, agent, operation, 1 as n from e where up is null
       union all select e.trace_id, e.span_id, w.top, e.agent, e.operation, w.n + 1
       from w join e on e.trace_id = w.trace_id and e.up = w.span_id)
 select trace_id, top as span_id, agent, operation, cast(max(n) as bigint) as length from w group by 1, 2, 3, 4 having max(n) >= 2""",
    "request_tree": f"""{WR}, heads as (select *, {CIRCULAR_SQL} as header from records),
 h as (select *, nullif(regexp_extract(header, '^00-([0-9a-f]{{32}})-([0-9a-f]{{16}})-[0-9a-f]{{2}}$', 1), '') as ct,
              nullif(regexp_extract(header, '^00-([0-9a-f]{{32}})-([0-9a-f]{{16}})-[0-9a-f]{{2}}$', 2), '') as cs from heads),
 n as (select h.trace_id, h.span_id, concat(h.trace_id, '/', h.span_id) as node,
              concat(p.trace_id, '/', p.span_id) as own, concat(c.trace_id, '/', c.span_id) as caller, c.trace_id as ct
       from h left join records p on p.trace_id = h.trace_id and p.span_id = h.parent_span_id
       left join records c on c.trace_id = h.ct and c.span_id = h.cs),
 up as (select trace_id, span_id, node, case when p.span_id is not null then own when c.span_id is not null then caller end as parent,
               p.span_id is null and c.span_id is not null as remote, ct
        from (select n.*, struct_pack(span_id := case when own <> '/' then own end) as p,
                     struct_pack(span_id := case when caller <> '/' then caller end) as c from n)),
 above as (select node, parent as far from up where parent is not null
           union select a.node, u.parent from above a join up u on u.node = a.far where u.parent is not null),
 kept as (select u.*, case when not (remote and exists (select 1 from above a where a.node = u.node and a.far = u.node))
                           then parent end as joined from up u),
 down as (select node, cast(0 as bigint) as depth, node as root from kept where joined is null
          union all select k.node, d.depth + 1, d.root from down d join kept k on k.joined = d.node),
 ways as (select trace_id as a, ct as b from up where remote union select ct, trace_id from up where remote),
 reach as (select a, b from ways union select r.a, w.b from reach r join ways w on w.a = r.b),
 requests as (select a as trace_id, least(a, min(b)) as request_id from reach group by a)
 select coalesce(q.request_id, k.trace_id) as request_id, k.trace_id, k.span_id, d.depth,
 split_part(d.root, '/', 1) as root_trace_id, split_part(d.root, '/', 2) as root_span_id
 from kept k join down d using (node) left join requests q on q.trace_id = k.trace_id""",
    "delegation_chains": f"""{WR}, n as (
 select r.trace_id, r.span_id, r.agent_id as agent, r.timestamp, p.span_id as parent, p.agent_id as above
 from records r left join records p on p.trace_id = r.trace_id and p.span_id = r.parent_span_id),
 firsts as (select trace_id, agent, arg_min(span_id, row(timestamp, span_id)) as span_id from n
            where parent is null or above <> agent group by 1, 2),
 walk as (
 select trace_id, agent, span_id as here, cast(0 as bigint) as hop, 0 as steps from firsts
 union all
 select w.trace_id, w.agent, n.parent, w.hop + cast(n.above <> n.agent as bigint), w.steps + 1
 from walk w join n on n.trace_id = w.trace_id and n.span_id = w.here where n.parent is not null),
 ends as (select trace_id, agent, hop, arg_max(here, steps) as span_id from walk group by 1, 2, 3)
 select e.trace_id, e.agent, e.hop, n.agent as by, e.span_id, n.timestamp from ends e join n using (trace_id, span_id)""",
    "delegation_cycles": f"""{WR}, edges as (
 select distinct c.trace_id, p.agent_id as src, c.agent_id as dst from records c
 join records p on p.trace_id = c.trace_id and p.span_id = c.parent_span_id where p.agent_id <> c.agent_id
 union
 select distinct trace_id, agent_id, inter_agent ->> '$.target_agent' from records
 where inter_agent ->> '$.target_agent' <> agent_id),
 reach as (select trace_id, src, dst from edges
           union select r.trace_id, r.src, e.dst from reach r join edges e on e.trace_id = r.trace_id and e.src = r.dst),
 circles as (select a.trace_id, a.src as agent, least(min(a.dst), a.src) as cycle, count(*) + 1 as agents
             from reach a join reach b on b.trace_id = a.trace_id and b.src = a.dst and b.dst = a.src
             where a.src <> a.dst group by 1, 2)
 select trace_id, agent, cycle, agents from circles""",
    "loop_blocks": f"""{W}, seqs as (
 select concat(agent_id, '/', strftime(timestamp, '%Y-%m-%d')) as trace_id, concat('all ', operation_name) as step, timestamp,
        row_number() over (partition by agent_id, strftime(timestamp, '%Y-%m-%d') order by timestamp, span_id) as seq from records),
 same as (select a.trace_id, p, a.seq, row_number() over (partition by a.trace_id, p order by a.seq) as nth
          from seqs a, (values (1), (2), (3), (4)) t(p), seqs b
          where b.trace_id = a.trace_id and b.seq = a.seq + p and b.step = a.step),
 runs as (select trace_id, p, min(seq) as first_seq, max(seq) + p as last_seq from same group by trace_id, p, seq - nth),
 turned as (select *, (last_seq - first_seq + 1) // p as turns from runs),
 picked as (select *, row_number() over (partition by trace_id order by p, turns desc, first_seq) as nth from turned where turns >= 3)
 select trace_id, cast(p as bigint) as period, cast(turns as bigint) as turns, first_seq, cast(last_seq as bigint) as last_seq,
 (select s.timestamp from seqs s where s.trace_id = k.trace_id and s.seq = k.first_seq) as started_at,
 (select string_agg(s.step, ',' order by s.seq) from seqs s
  where s.trace_id = k.trace_id and s.seq between k.first_seq and k.first_seq + k.p - 1) as block
 from picked k where nth = 1""",
    "pii_redact_hash": _redact_sql("hash"),
    "pii_redact_mask": _redact_sql("mask"),
    "pii_redact_remove": _redact_sql("remove"),
    "pii_detections": f"""with {DETECT} select doc_id, type, start, "end", length from found""",
    "pii_scan": _scan_sql(),
    "text_guardrails": _guardrails_sql(),
    "pii_conversations": f"""with turns as (select *, concat(conv_id, '/', turn) as turn_id from conversations), {TURNS},
 f as (select turn_id, count(*) as n from found group by 1)
 select role, count(*) as turns, count(f.n) as with_pii, cast(coalesce(sum(f.n), 0) as bigint) as detections
 from turns left join f using (turn_id) group by 1""",
    "pii_payload_paths": f"""{W}, {PAYLOAD} select span_id, field_path, type, start, "end", length from located""",
    "pii_summary": f"""{W}, {PAYLOAD} select type, regexp_replace(field_path, '\\[[0-9]+\\]', '[]', 'g') as field_path, count(*) as detections,
 cast(sum(length) as bigint) as characters from located group by 1, 2""",
    "pii_payload_redact": f"""{W}, {PAYLOAD_LEAVES}, {_REDACTED_LEAVES[0]}
 select split_part(key, '|', 1) as span_id, substr(key, strpos(key, '|') + 1) as field_path, text as value
 from {_REDACTED_LEAVES[1]}""",
    # Matches by length; one is taken if it overlaps none that was taken before.
    "pii_redact_longest": f"""with recursive {DETECT},
ranked as (select *, row_number() over (partition by doc_id order by length desc, start, nth) as i from found),
walk as (
 select distinct doc_id, cast(0 as bigint) as i, cast([] as struct(s bigint, e bigint, type varchar)[]) as taken from found
 union all
 select w.doc_id, w.i + 1, case when len(list_filter(taken, lambda t: t.s < r."end" and r.start < t.e)) = 0
  then list_append(taken, {{'s': r.start, 'e': r."end", 'type': r.type}}) else taken end
 from walk w join ranked r on r.doc_id = w.doc_id and r.i = w.i + 1),
picked as (select doc_id, unnest(taken) as t from (select doc_id, arg_max(taken, i) as taken from walk group by 1)),
placed as (select doc_id, t.s as s, t.e as e, t.type as type,
 coalesce(lag(t.e) over (partition by doc_id order by t.s), 0) as before from picked),
built as (
 select p.doc_id, max(e) as done, string_agg(concat(substr(d.text, before + 1, s - before), '[', type, ':sha256:',
  left(sha256(substr(d.text, s + 1, e - s)), 12), ']'), '' order by s) as head
 from placed p join documents d using (doc_id) group by 1)
 select d.doc_id, case when head is null then text else concat(head, substr(text, done + 1)) end as text
 from documents d left join built using (doc_id)""",
    "pii_custom_allowlist": f"""with a as (select doc_id, array_to_string(list_transform(list_zip(
   string_split_regex(text, '{EMAIL}'),
   list_append(list_transform(regexp_extract_all(text, '{EMAIL}'),
     lambda m: case when m = '19@mail5.example.com' then m else '[email:REDACTED]' end), '')),
   lambda z: concat(z[1], z[2])), '') as text from documents)
 select doc_id, regexp_replace(regexp_replace(text, '{PATTERNS["ip_address"]}', '[ip_address:REDACTED]', 'g'),
 '\\*{{3}}', '[marker:REDACTED]', 'g') as text from a""",
    "intent_routing": """select conv_id, turn,
 case when regexp_matches(lower(text), 'weather|temperature|forecast') then 'weather_agent'
      when regexp_matches(lower(text), 'search|find|research|what is') then 'research_agent' else 'general_agent' end as route,
 case when regexp_matches(lower(text), 'weather|temperature|forecast') then 0.95
      when regexp_matches(lower(text), 'search|find|research|what is') then 0.88 else 0.72 end::double as confidence
 from conversations""",
    "spans_to_records": f"""{W} select trace_id, span_id, parent_span_id, timestamp, agent_id, agent_name, agent_version, config_hash,
 operation_name, cast(duration_ms as bigint) as duration_ms,
 case when input_tokens % 20 <> 0 then model_name when outcome is not null then 'gpt-4o' else model_name end as model_name,
 cast(input_tokens as bigint) as input_tokens, cast(output_tokens as double) as output_tokens, {_d('cost_usd')} as cost_usd,
 coalesce(reasoning ->> '$.rationale', '') as rationale, coalesce(reasoning ->> '$.confidence', '') as confidence,
 cast(coalesce(json_array_length(tool_calls), 0) as bigint) as tool_calls, coalesce({FIRST_TOOL}, '') as first_tool,
 {TEXT_BOOL.format('all_passed')}, {TEXT_BOOL.format('human_in_loop')}, status, error_type, error_message from records""",
    "usage_normalise": f"""{W} select span_id, cast(input_tokens as bigint) as input_tokens,
 cast(output_tokens as double) as output_tokens,
 cast(case when input_tokens % 30 <> 0 then 5 end as double) as cache_read_tokens,
 {_d("case when input_tokens % 30 = 0 then nullif(cost_usd, 0) else cost_usd end")} as cost_usd,
 model_name as response_model from records""",
    "nested_roundtrip": f"""{W} select trace_id, span_id, timestamp, agent_id, operation_name, cast(duration_ms as bigint) as duration_ms,
 {_d('cost_usd')} as cost_usd, coalesce(reasoning ->> '$.rationale', '') as rationale,
 cast(coalesce(json_array_length(tool_calls), 0) as bigint) as tool_calls,
 coalesce(inter_agent ->> '$.target_agent', '') as target_agent, coalesce(reasoning ->> '$.confidence', '') as confidence,
 coalesce(reasoning ->> '$.strategy', '') as strategy, status, error_type, error_message, agent_name, agent_version,
 model_name, parent_span_id, {TEXT_BOOL.format('all_passed')} from records""",
    "export_redacted": f"""{W} select span_id, sha256(concat('u-', agent_id)) as user_hash, '' as content, agent_id from records""",
    "span_names": f"""{W}, n as (select span_id, concat_ws(' ', operation_name,
 case when operation_name = 'chat' then model_name when operation_name = 'execute_tool' then {FIRST_TOOL}
      else coalesce(agent_name, '') end) as span_name, agent_id, agent_version, error_message from records)
 select span_id, span_name, regexp_matches(span_name, '^(chat|text_completion|embeddings|invoke_agent|create_agent|execute_tool) [^ ]') as is_valid,
 concat('sha256:', left(sha256(concat(agent_id, ':', agent_version, ':run')), 16)) as fingerprint,
 coalesce(left(error_message, 8), '') as short_error from n""",
    "tail_decisions": f"""{W}, {FLAGS} select * from decided""",
    "tail_sample": f"""{W}, {FLAGS} select trace_id, span_id, timestamp as start_time from records
 where trace_id in (select trace_id from decided where keep)""",
    "operation_duration": f"""{W} select time_bucket(interval 30 seconds, timestamp) as window_start, operation_name, model_name,
 count(duration_ms) as calls, {_d('avg(duration_ms / 1000)')} as avg_s, {_d('max(duration_ms / 1000)')} as max_s,
 {_d('quantile_cont(duration_ms / 1000, 0.95)')} as p95_s
 from records group by 1, 2, 3""",
    "token_histogram": f"""{W}, t as (
 select time_bucket(interval 1 hour, timestamp) as window_start, 'input' as token_type, input_tokens as tokens from records
 union all select time_bucket(interval 1 hour, timestamp), 'output', output_tokens from records where output_tokens is not null)
 select window_start, token_type, cast(len(list_filter(list_transform(range(14), lambda i: pow(4, i)), lambda b: b < tokens)) as bigint) as bucket,
 count(*) as records, cast(sum(tokens) as bigint) as tokens from t group by 1, 2, 3""",
    "time_per_token": f"""{W} select model_name, count(duration_ms / 1000 / nullif(output_tokens, 0)) as records,
 {_d('avg(duration_ms / 1000 / nullif(output_tokens, 0))')} as avg_s_per_token,
 {_d('max(duration_ms / 1000 / nullif(output_tokens, 0))')} as max_s_per_token from records group by 1""",
    "cost_alerts": f"""{W} select trace_id, {_d('sum(cost_usd)')} as total_cost from records group by 1 having sum(cost_usd) > 0.1""",
    "guardrail_rate_alerts": f"""{W} select agent_id, count(*) as checked, count(*) filter (where not all_passed) as failed,
 {_d('avg(cast(not all_passed as int))')} as failure_rate from records where compliance is not null
 group by 1 having avg(cast(not all_passed as int)) > 0.05""",
    "latency_alerts": f"""{W} select agent_id, count(duration_ms) as records, {_d('quantile_cont(duration_ms, 0.99)')} as p99_ms
 from records group by 1 having quantile_cont(duration_ms, 0.99) > 1000""",
    "model_provenance": f"""{W}, m as (select case when outcome is not null then 'gpt-4o' else model_name end as request_model,
 case when input_tokens % 20 = 0 then '' else model_name end as response_model from records)
 select request_model, response_model, count(*) as calls, request_model = response_model as same_model from m group by 1, 2""",
    "eval_scores": f"""{W}, s as (
 select agent_id, 'relevance' as score_name, cast(outcome ->> '$.eval_scores.relevance' as double) as score from records where outcome is not null
 union all
 select agent_id, 'faithfulness', cast(outcome ->> '$.eval_scores.faithfulness' as double) from records where outcome is not null)
 select agent_id, score_name, count(score) as scored, {_d('avg(score)')} as avg_score, {_d('min(score)')} as min_score from s group by 1, 2""",
    "low_confidence": f"""{W}, c as (select agent_id, cast(reasoning ->> '$.confidence' as double) as c from records where reasoning is not null)
 select agent_id, count(c) as decisions, {_d('avg(c)')} as avg_confidence, count(*) filter (where c < 0.3) as low_confidence
 from c group by 1""",
    "tool_reliability": f"""{W}, {CALLS}, f as (select {TOOL} as tool_name,
 cast(json_extract_string(call, '$."tool.response_status"') as int) as status,
 cast(json_extract_string(call, '$."tool.latency_ms"') as double) as latency,
 cast(json_extract_string(call, '$."tool.retry_count"') as bigint) as retry from calls)
 select tool_name, count(*) as calls, count(*) filter (where status >= 400) as failed,
 {_d('avg(cast(status >= 400 as int))')} as failure_rate, {_d('avg(latency)')} as avg_latency_ms,
 cast(sum(retry) as double) as retries from f group by 1""",
    "storage_tiers": f"""{W}, t as (select cast(timestamp as date) as d,
 case when datediff('day', cast(timestamp as date), date '{NOW}') < 7 then 'hot'
      when datediff('day', cast(timestamp as date), date '{NOW}') < 90 then 'warm' else 'cold' end as tier from records)
 select tier, count(*) as records, cast(min(d) as varchar) as first_day, cast(max(d) as varchar) as last_day from t group by 1""",
    "retention_audit": f"""{W}, g as (select operation_name as tag, count(*) as records, min(cast(timestamp as date)) as d,
 case when operation_name = 'chat' then 84 else 6 end as m from records group by 1)
 select tag, records, cast(m as bigint) as months_required, d <= date '2024-07-15' - to_months(m) as covers_period,
 cast(d as varchar) as first_day, cast(cast(date '2024-07-15' - to_months(m) as date) as varchar) as keep_from from g""",
    "retention_gaps": f"""{W}, d as (select distinct cast(timestamp as date) - if(day(timestamp) % 5 = 0, 1, 0) as day from records),
 n as (select day, lead(day) over (order by day) as nxt from d)
 select cast(cast(day + 1 as date) as varchar) as gap_start, cast(cast(nxt - 1 as date) as varchar) as gap_end,
 datediff('day', day, nxt) - 1 as days from n where datediff('day', day, nxt) > 1""",
    "quarantine": f"""{W}, v as (select span_id, duration_ms % 50 = 7 as a, duration_ms % 40 = 3 as b,
 duration_ms % 30 = 4 as c, duration_ms % 60 = 9 as d from records)
 select span_id, concat_ws('; ', case when a then 'agent_id is null' end,
 case when c then 'trace_id longer than 32' end, case when b then 'agent_version longer than 64' end,
 case when d then 'cost_usd out of range' end) as violations from v where a or b or c or d""",
    "table_roundtrip": f"""{W} select strftime(timestamp, '%Y-%m-%d') as date, agent_id, count(*) as records,
 {_d('sum(cost_usd)')} as cost, count(compliance) as checked from records group by 1, 2""",
    "export_captured": f"""{W} select span_id, sha256(concat('u-', agent_id)) as user_hash,
 concat('hello from ', agent_id) as content from records""",
    "table_by_name": f"""{W} select strftime(timestamp, '%Y-%m-%d') as date, agent_id, count(*) as records,
 {_d('sum(cost_usd)')} as cost, count(compliance) as checked from records group by 1, 2""",
    "settle_roundtrip": f"""{W} select strftime(timestamp, '%Y-%m-%d') as date, agent_id, count(*) as records,
 {_d('sum(cost_usd)')} as cost, count(compliance) as checked from records group by 1, 2""",
    "spans_from_json": f"""{W} select agent_id, count(*) as records, {_d('sum(cost_usd)')} as cost,
 count(*) filter (where status = 'error') as errors from records group by 1""",
    "partial_report": f"""{W}, {CALLS}
 select 'cost' as section, agent_name as label, count(*) as n, {_d('sum(cost_usd)')} as x, cast(null as timestamp) as y
 from records where {RANGE} group by agent_name
 union all select 'tokens', agent_name, cast(sum({TOKENS}) as bigint), {_d('avg(duration_ms)')}, null from records group by agent_name
 union all select 'hour', concat_ws('|', agent_name, strftime(timestamp, '%Y-%m-%d %H')), cast(sum(input_tokens + output_tokens) as bigint),
  {_d('sum(cost_usd)')}, null from records group by agent_name, strftime(timestamp, '%Y-%m-%d %H')
 union all select 'tool', concat_ws('/', {TOOL}, {TOOL_TYPE}), count(*), null, null from calls group by {TOOL}, {TOOL_TYPE}
 union all select 'use', strftime(timestamp, '%Y-%m-%d'), count(*), null, max(timestamp) from records group by 2
 union all select 'session', strftime(timestamp, '%Y-%m-%d'), count(*), null, max(timestamp + to_milliseconds(coalesce(duration_ms, 0)))
  from records where parent_span_id is null group by 2
 union all select 'checks', concat(printf('%.1f', 100.0 * count(*) filter (where all_passed) / greatest(count(*), 1)), '%'), count(*),
  cast(count(*) filter (where not all_passed) as double), null from records where compliance is not null
 union all select 'oversight', span_id, 1, null, timestamp from records where human_in_loop""",
    "spans_from_otlp": f"""{W}, numbered as (select *, cast('0x' || substring(trace_id, 17) as bigint) % 40 as n from records)
 select agent_id, count(*) as records, {_d('sum(cost_usd)')} as cost, count(*) filter (where status = 'error') as errors
 from numbered where n <> 3 group by 1
 union all
 select case n when 3 then 'bad: not JSON' else 'bad: no resourceSpans' end, count(distinct trace_id), null, null
 from numbered where n in (3, 4) group by 1""",
    "pii_own_strategy": f"""select doc_id, regexp_replace(text, '{EMAIL}', '<email>', 'g') as text,
 regexp_replace(text, '{EMAIL}', '<email>', 'g') as payload_text from documents""",
    "tier_export": f"""{W}, t as (select *, datediff('day', cast(timestamp as date), date '{NOW}') as age from records)
 select case when age < 90 then 'warm' else 'cold' end as tier, count(*) as records, count(distinct trace_id) as traces,
 cast(sum(duration_ms) as bigint) as duration_ms from t where age >= 7 group by 1""",
    "stream_ingest": f"""{W} select agent_id, count(*) as records, {_d('sum(cost_usd)')} as cost,
 count(*) filter (where status = 'error') as errors from records group by 1""",
    "stream_export": f"""{W} select agent_id, count(*) as spans, 1 as users, 0 as with_content,
 count(*) filter (where status = 'error') as errors from records group by 1""",
    "stream_sample": f"""{W}, {FLAGS} select trace_id, span_id, timestamp as start_time from records
 where trace_id in (select trace_id from decided where keep)""",
    "stream_late": f"""{W}, moved as (
 select *, timestamp + {PAUSE_SQL} as start from records),
placed as (select *, min(start) over (partition by trace_id) as first from moved),
verdicts as (
 select trace_id, bool_or(status = 'error' or coalesce(not all_passed, false) or risk_level in ('high', 'critical'))
   or coalesce(epoch_us(max(start + to_milliseconds(duration_ms))) - epoch_us(min(first)) > 5000000, false)
   or cast('0x' || left(sha256(trace_id), 8) as bigint) % 10000 < 1000 as keep
 from placed where start <= first + interval 10 second group by 1)
 select trace_id, span_id, start as start_time from placed where trace_id in (select trace_id from verdicts where keep)""",
    "stream_metrics": f"""{W}
 select time_bucket(interval 30 seconds, timestamp) as window_start, operation_name, model_name, count(*) as calls,
 {_d('avg(duration_ms / 1000)')} as avg_s, cast(sum({TOKENS}) as bigint) as tokens,
 {_d('avg(duration_ms / 1000 / nullif(output_tokens, 0)) * 1000')} as avg_ms_per_token,
 cast(quantile_disc(duration_ms, 0.95) as bigint) as p95_ms from records group by 1, 2, 3""",
    "latency_rollup": " union all ".join(f"""select * from ({W}
 select '{level}' as level, date_trunc('{level}', timestamp)::timestamp as window_start, operation_name, model_name,
 count(duration_ms) as calls, cast(min(duration_ms) as bigint) as least, cast(max(duration_ms) as bigint) as greatest,
 {_d('avg(duration_ms)')} as avg_ms, {", ".join(f"cast(quantile_disc(duration_ms, {q}) as bigint) as p{q * 100:g}_ms" for q in (0.5, 0.95, 0.99))}
 from records where duration_ms is not null group by 1, 2, 3, 4)""" for level in ("hour", "day")),
    "latency_sketch_alerts": f"""{W}
 select date_trunc('day', timestamp)::timestamp as window_start, agent_id, count(*) as calls,
 cast(min(duration_ms) as bigint) as least, cast(max(duration_ms) as bigint) as greatest,
 cast(quantile_disc(duration_ms, 0.99) as bigint) as latency_ms
 from records where duration_ms is not null group by 1, 2 having quantile_disc(duration_ms, 0.99) > 2500""",
    "stream_alerts": f"""{W}, w as (select unnest(generate_series(
   time_bucket(interval 1 minute, timestamp) - interval 4 minutes, time_bucket(interval 1 minute, timestamp), interval 1 minute)) as window_start,
 * from records), a as (
 select window_start, agent_id, cast(sum(cost_usd) as double) as cost, avg(cast(not all_passed as int)) as rate,
 quantile_disc(duration_ms, 0.99) as p99 from w group by 1, 2)
 select window_start, agent_id, {_d('cost')} as cost, {_d('rate')} as failure_rate, cast(p99 as bigint) as p99_ms,
 concat_ws(',', case when cost > 0.05 then 'cost' end,
 case when rate > 0.5 then 'guardrail_failure_rate' end, case when p99 > 2500 then 'p99_latency' end) as alerts
 from a where cost > 0.05 or rate > 0.5 or p99 > 2500""",
    "stream_trace_costs": f"""{W} select time_bucket(interval 1 hour, timestamp) as window_start, trace_id, count(*) as records,
 {_d('sum(cost_usd)')} as cost from records group by 1, 2 having sum(cost_usd) > 0.1""",
    "stream_sample_batches": f"""{W}, {FLAGS} select trace_id, span_id, timestamp as start_time from records
 where trace_id in (select trace_id from decided where keep)""",
}
# A stream gives what the batch gives.
ORACLES["stream_spikes"] = ORACLES["error_spikes"]
ORACLES["stream_cost_spikes"] = ORACLES["cost_spikes"]
