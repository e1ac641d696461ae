"""SQL twins of the registered queries, for an independent engine.

Each statement starts from the ``events`` table and is written from the
operator's definition, not from the Spark plan.
"""

from __future__ import annotations


def _rounded(x: str, digits: int) -> str:
    return f"cast(round(cast({x} as decimal(28,10)), {digits}) as double)"


_READINGS = """
numbered as (select *, user_id % 5 + 1 as k from events),
readings as (
  select event_id,
         concat('WELL-', lpad(cast(k as varchar), 3, '0')) as well_id,
         case k when 1 then 'North Sea Block A' when 2 then 'North Sea Block B'
                when 3 then 'Gulf Platform C' when 4 then 'Gulf Platform D'
                when 5 then 'Offshore Rig E' end as location,
         case k when 1 then 2400e0 when 2 then 3100e0 when 3 then 1800e0
                when 4 then 2900e0 when 5 then 3500e0 end as depth_m,
         ts,
         case event_type when 'click' then 'pressure' when 'error' then 'temperature'
                         when 'purchase' then 'flow_rate'
                         when 'signup' then 'vibration'
                         when 'view' then 'rpm' end as sensor_type,
         value,
         case event_type when 'click' then 'PSI' when 'error' then 'celsius'
                         when 'purchase' then 'm3/hr' when 'signup' then 'mm/s'
                         when 'view' then 'rpm' end as unit,
         value > case when k = 3 then 20e0 else 150e0 end as is_anomaly,
         case event_type when 'click' then value between 0 and 2000
                         when 'error' then value between -10 and 200
                         when 'purchase' then value between -5 and 500
                         when 'signup' then value between 0 and 20
                         when 'view' then value between 0 and 5000
                         else true end as value_valid
  from numbered)"""

_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"

# The undamaged raw rows.
_PLAIN = f"""
plain as (
  select well_id, location, depth_m, {_ISO} as "timestamp", sensor_type, value, unit,
         is_anomaly, ts
  from readings)"""

_INGEST = """strftime(ts, '%Y') as year, strftime(ts, '%m') as month,
         strftime(ts, '%d') as day, strftime(ts, '%H') as hour"""

# The damaged raw rows: every event once, one in ten a second time.
_BRONZE = f"""
delivered as (
  select *, unnest(case when event_id % 10 = 3 then [1, 2] else [1] end) as delivery
  from readings),
bronze as (
  select case when event_id % 97 = 0 then null when event_id % 89 = 0 then '  '
              when event_id % 13 = 1 then ' ' || well_id || ' '
              else well_id end as well_id,
         case when event_id % 53 = 0 then null else location end as location,
         depth_m,
         case when event_id % 101 = 0 then 'not-a-time'
              when event_id % 103 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
              else {_ISO} end as "timestamp",
         case when event_id % 13 = 1 then ' ' || upper(sensor_type)
              else sensor_type end as sensor_type,
         case when event_id % 107 = 0 then null else value end as value,
         unit,
         case when event_id % 59 = 0 then null else is_anomaly end as is_anomaly
  from delivered),
normal as (
  select nullif(trim(well_id), '') as well_id, location, depth_m, "timestamp",
         nullif(trim(lower(sensor_type)), '') as sensor_type, value, unit, is_anomaly
  from bronze),
parsed as (
  select * exclude ("timestamp"), try_cast("timestamp" as timestamp) as ts from normal),
complete as (
  select * from parsed
  where well_id is not null and ts is not null and sensor_type is not null
    and value is not null),
clean as (
  select *, case sensor_type when 'pressure' then value between 0 and 2000
                             when 'temperature' then value between -10 and 200
                             when 'flow_rate' then value between -5 and 500
                             when 'vibration' then value between 0 and 20
                             when 'rpm' then value between 0 and 5000
                             else true end as value_valid
  from complete)"""

_RAW = (
    'well_id, location, depth_m, "timestamp", sensor_type, value, unit, is_anomaly'
)
_CLEAN = "well_id, location, depth_m, ts, sensor_type, value, unit, is_anomaly"


def _statistics(keys: str = "") -> str:
    """Aggregate columns of the sensor statistics, after any extra keys."""
    return f"""select {keys} well_id, sensor_type, location,
         {_rounded("avg(value)", 2)} as avg_value,
         {_rounded("min(value)", 2)} as min_value,
         {_rounded("max(value)", 2)} as max_value,
         {_rounded("stddev_samp(value)", 2)} as stddev_value,
         count(*) as reading_count,
         cast(count(*) filter (where is_anomaly) as bigint) as anomaly_count,
         {_rounded("count(*) filter (where is_anomaly) / cast(count(*) as double)", 4)}
           as anomaly_rate"""


_STATS = f"""
stats as ({_statistics()} from readings group by well_id, sensor_type, location)"""


def _rollup(source: str, keys: str = "") -> str:
    return f"""select {keys} well_id, location,
         {_rounded("avg(anomaly_rate)", 4)} as avg_anomaly_rate,
         {_rounded("avg(avg_value)", 2)} as overall_avg_value,
         cast(sum(reading_count) as bigint) as total_readings,
         cast(sum(anomaly_count) as bigint) as total_anomalies
  from {source} group by {keys} well_id, location"""


_SCORE = _rounded("greatest(0e0, least(100e0, 100e0 - 40e0 * avg_anomaly_rate))", 1)
_STATUS = """case when health_score >= 80 then 'HEALTHY'
              when health_score >= 60 then 'WARNING' else 'CRITICAL' end"""

_HEALTH = f"""
rollup_ as ({_rollup("stats")}),
scored as (select *, {_SCORE} as health_score from rollup_),
health as (select *, {_STATUS} as status from scored)"""

_SHOWN_SCORE = "cast(cast(health_score as decimal(5,1)) as double)"
_TYPED = f"""
  select well_id, location, {_SHOWN_SCORE} as health_score, status,
         cast(cast(avg_anomaly_rate as decimal(6,4)) as double) as avg_anomaly_rate,
         total_readings, total_anomalies, {{stamp}} as updated_at
  from {{source}}"""
_RUN = "timestamp '2024-02-01 00:00:00'"

_SEVERITY = "case when value_valid = false then 'CRITICAL' else 'WARNING' end"

_ALERTS = f"""
alerts as (
  select well_id, sensor_type, {_SEVERITY} as severity, count(*) as alert_count
  from readings where is_anomaly group by 1, 2, 3)"""

_HOURLY_ALERTS = f"""
alerts as (
  select well_id, sensor_type, {_SEVERITY} as severity, count(*) as alert_count,
         date_trunc('hour', ts) as window_start
  from readings where is_anomaly group by 1, 2, 3, 5)"""

_HOURLY_STATS = f"""
windowed as (
  select *, date_trunc('hour', ts) as window_start,
         date_trunc('hour', ts) + interval 1 hour as window_end
  from readings),
hourly as (
  {_statistics("window_start, window_end,")}
  from windowed group by window_start, window_end, well_id, sensor_type, location)"""

_DAILY_HEALTH = f"""
daily as (select *, date_trunc('day', ts)::timestamp as day from readings),
day_stats as ({_statistics("day,")} from daily
  group by day, well_id, sensor_type, location),
day_rollup as ({_rollup("day_stats", "day,")}),
day_scores as (select *, {_SCORE} as health_score from day_rollup),
day_health as (select *, {_STATUS} as status from day_scores),
day_typed as ({_TYPED.format(source="day_health", stamp="day")})"""


def _with(*parts: str) -> str:
    """WITH clause of the readings and what builds on them."""
    return "with " + ",".join((_READINGS,) + parts)


_RAW_TABLE = f"{_with(_BRONZE)} select {_RAW} from bronze"
_PLAIN_WITH_HOURS = f"{_with(_PLAIN)} select {_RAW}, {_INGEST} from plain"

_DEDUP = f"""{_with(_BRONZE)}
select {_CLEAN}, value_valid from (
  select *, row_number() over (
    partition by well_id, ts, sensor_type
    order by value, location nulls last, is_anomaly nulls last) as place
  from clean)
where place = 1"""


_DROP_COUNTS = f"""{_with(_BRONZE)},
counted as (
  select (select count(*) from bronze) as rows_in,
         (select count(*) from clean) as rows_clean,
         (select count(*) from (select distinct well_id, ts, sensor_type from clean))
           as rows_unique)
select *, rows_in - rows_clean as rows_dropped,
       rows_clean - rows_unique as rows_duplicate
from counted"""

# What the runs over the damaged lines leave behind.
_RUNS = f"""
delivered as (
  select *, unnest(case when event_id % 10 = 3 then [1, 2] else [1] end) as delivery
  from readings),
sent as (
  select event_id, event_id % 3 as h,
         case when event_id % 97 = 0 then null when event_id % 89 = 0 then null
              else well_id end as well_id,
         case when event_id % 73 = 0 then 'Dock 9' when event_id % 53 = 0 then null
              else location end as location,
         case when event_id % 101 = 0 then null
              when event_id % 103 = 0 then date_trunc('second', ts) else ts end as ts,
         case when event_id % 71 = 0 then 'humidity' else sensor_type end
           as sensor_type,
         case when event_id % 67 = 0 then 'nan'::double when event_id % 107 = 0 then null
              else value end as value,
         case when event_id % 59 = 0
                or (event_id % 83 = 0 and event_id % 79 <> 0) then null
              else is_anomaly end as is_anomaly
  from delivered),
told as (
  select *, case
    when event_id % 61 = 0 then 'malformed'
    when well_id is null then 'null_key'
    when ts is null then 'bad_timestamp'
    when value is null or isnan(value) then 'bad_value' end as reason,
    event_id % 61 = 0 or event_id % 79 = 0 or event_id % 83 = 0 as has_text
  from sent),
left_out as (
  select h, case when reason is null then 'bad_field' else reason end as item,
         count(*) as row_count,
         cast(count(*) filter (where has_text) as double) as figure
  from told where reason is not null or has_text group by all),
kept as (
  select *, case sensor_type when 'pressure' then value between 0 and 2000
                             when 'temperature' then value between -10 and 200
                             when 'flow_rate' then value between -5 and 500
                             when 'vibration' then value between 0 and 20
                             when 'rpm' then value between 0 and 5000
                             else true end as value_valid
  from told where reason is null
  qualify row_number() over (
    partition by h, well_id, ts, sensor_type
    order by value, location nulls last, is_anomaly nulls last) = 1),
stats as ({_statistics("h,")} from kept group by h, well_id, sensor_type, location),
rollup_ as ({_rollup("stats", "h,")}),
scored as (select *, {_SCORE} as health_score from rollup_),
health as (select *, {_STATUS} as status from scored),
latest as (
  select * from health qualify row_number() over (
    partition by well_id order by h desc, total_readings desc, location desc nulls last
  ) = 1),
alerts as (
  select h, well_id, sensor_type || '/' || {_SEVERITY} as item, count(*) as row_count
  from kept where is_anomaly group by all),
everything as (
  select 'silver' as table_name, h, well_id, sensor_type as item, count(*) as row_count,
         max(value) as figure
  from kept group by h, well_id, sensor_type
  union all
  select 'rejects', h, null, item, row_count, figure from left_out
  union all
  select 'sensor_statistics', h, well_id, sensor_type || '/' || coalesce(location, '?'),
         reading_count, avg_value from stats
  union all
  select 'well_health_scores', h, well_id, status || '/' || coalesce(location, '?'),
         total_readings, health_score from health
  union all
  select 'well_health', h, well_id, status || '/' || coalesce(location, '?'),
         total_readings, {_SHOWN_SCORE} from latest
  union all
  select unnest(['alert_summary', 'sensor_alerts']), h, well_id, item, row_count, null
  from alerts)"""

_RUN_RESULTS = f"""{_with(_RUNS)}
select table_name, '2024-02-01-0' || h as ingest_hour, well_id, item,
       cast(row_count as bigint) as row_count, figure
from everything"""


def oracle_sql() -> dict[str, str]:
    return {
        "bronze_scan": _RAW_TABLE,
        "bronze_hour_prune": f"""{_PLAIN_WITH_HOURS}
where date_trunc('hour', ts) = timestamp '2024-01-15 12:00:00'""",
        "rejects": f"""{_with(_BRONZE)},
reasons as (
  select *, case
    when well_id is null or sensor_type is null or nullif(trim("timestamp"), '') is null
      then 'null_key'
    when try_cast("timestamp" as timestamp) is null then 'bad_timestamp'
    when value is null or isnan(value) then 'bad_value' end as reject_reason
  from normal)
select {_RAW}, reject_reason from reasons where reject_reason is not null""",
        "silver_scan": f"""{_with()}
select '2024' as year, '02' as month, '01' as day, '00' as hour, well_id, sensor_type,
       count(*) as reading_count, max(value) as max_value
from readings group by well_id, sensor_type""",
        "silver_roundtrip": f"""{_with()}
select {_CLEAN}, value_valid, {_RUN} as processed_at, '1.0' as silver_version,
       '2024' as year, '02' as month, '01' as day, '00' as hour
from readings""",
        "gold_snapshot": f"""{_with(_STATS, _HEALTH, _ALERTS)}
select 'sensor_statistics' as table_name, well_id, sensor_type as item,
       reading_count as row_count, stddev_value as figure from stats
union all
select 'well_health_scores', well_id, status, total_readings, health_score from health
union all
select 'alert_summary', well_id, sensor_type || '/' || severity, alert_count, null
from alerts""",
        "encode_messages": f"""{_with(_PLAIN)}
select well_id as message_key, location, depth_m, "timestamp", sensor_type, value, unit,
       is_anomaly
from plain""",
        "decode_messages": f"{_with(_PLAIN)} select {_RAW} from plain",
        "ingest_partitions": f"{_with()} select event_id, {_INGEST} from readings",
        "bronze_sink_roundtrip": _PLAIN_WITH_HOURS,
        "well_health_upsert": f"""{_with(_DAILY_HEALTH)}
select * from day_typed
qualify row_number() over (partition by well_id order by updated_at desc) = 1""",
        "alerts_append": f"""{_with()}
select well_id, sensor_type, {_SEVERITY} as severity, count(*) as alert_count,
       date_trunc('day', ts)::timestamp as window_start
from readings where is_anomaly
group by 1, 2, 3, 5""",
        "serving_cast": f"""{_with(_STATS, _HEALTH)},
typed as ({_TYPED.format(source="health", stamp=_RUN)})
select *, 'decimal(5,1), decimal(6,4), bigint, bigint' as types from typed""",
        "clean_required": f"{_with(_BRONZE)} select {_CLEAN} from complete",
        "parse_ts": f"""{_with(_BRONZE)}
select "timestamp" as text, sensor_type, value, try_cast("timestamp" as timestamp) as ts
from bronze""",
        "normalise_strings": f"{_with(_BRONZE)} select {_RAW} from normal",
        "validate_ranges": f"""{_with()}
select event_id, sensor_type, value, value_valid from readings""",
        "audit_columns": f"""{_with()}
select event_id, {_RUN} as processed_at, '1.0' as silver_version from readings""",
        "anomaly_rows": f"{_with()} select * from readings where is_anomaly",
        "invalid_rows": f"{_with()} select * from readings where not value_valid",
        "alert_severity": f"""{_with()}
select event_id, well_id, sensor_type, value, {_SEVERITY} as severity
from readings where is_anomaly""",
        "health_status": f"""{_with(_STATS, _HEALTH)}
select well_id, location, health_score, status from health""",
        "health_view": f"""{_with(_STATS, _HEALTH)}
select well_id, health_score, status, avg_anomaly_rate, total_readings from health""",
        "dash_well_status": f"""{_with(_STATS, _HEALTH)}
select {_SHOWN_SCORE} as "Health Score", status as "Status"
from health where well_id = 'WELL-003'""",
        "classify_band": f"""{_with()},
bands(sensor_type, low, high, odd_low, odd_high) as (values
  ('pressure', 800e0, 1200e0, 1400e0, 1800e0),
  ('temperature', 60e0, 90e0, 110e0, 140e0),
  ('flow_rate', 50e0, 150e0, 0e0, 20e0),
  ('vibration', 0.5e0, 3e0, 5e0, 9e0),
  ('rpm', 1200e0, 1800e0, 200e0, 700e0))
select event_id, r.sensor_type, value,
       case when value is null or low is null then null
            when value between low and high then 'normal'
            when value between odd_low and odd_high then 'anomaly'
            else 'between' end as band
from readings r left join bands b on r.sensor_type = b.sensor_type""",
        "dedup_key": _DEDUP,
        "dedup_row": f"{_with(_BRONZE)} select distinct {_RAW} from bronze",
        "drop_counts": _DROP_COUNTS,
        "sensor_stats": f"{_with(_STATS)} select * from stats",
        "well_rollup": f"{_with(_STATS, _HEALTH)} select * from rollup_",
        "alert_summary": f"{_with(_ALERTS)} select * from alerts",
        "anomalies_by_sensor": f"""{_with()}
select sensor_type, count(*) as "count" from readings where is_anomaly group by 1""",
        "quality_summary": f"""{_with(_BRONZE)},
counted as (
  select count(*) as total_records,
         count(*) filter (where is_anomaly) as anomaly_records,
         count(*) filter (where value_valid = false) as invalid_records,
         count(*) filter (where location is null) as missing_location
  from clean)
select *,
       {_rounded("100e0 * anomaly_records / nullif(total_records, 0)", 1)}
         as anomaly_percent,
       {_rounded("100e0 * invalid_records / nullif(total_records, 0)", 1)}
         as invalid_percent
from counted""",
        "serving_counts": f"""{_with(_STATS, _HEALTH, _HOURLY_ALERTS)}
select (select count(*) from health) as well_count,
       (select count(*) from alerts) as alert_count""",
        "dash_active_alerts": f"""{_with(_HOURLY_ALERTS)}
select well_id as "Well", sensor_type as "Sensor", severity,
       cast(sum(alert_count) as bigint) as "Alert Count"
from alerts group by 1, 2, 3
order by "Alert Count" desc, "Well", "Sensor", severity limit 20""",
        "health_scores": f"{_with(_STATS, _HEALTH)} select * from health",
        "health_scores_full": f"""{_with(_STATS, _HEALTH)},
shares as (
  select well_id, location,
         count(*) filter (where not value_valid) / cast(count(*) as double)
           as invalid_share,
         coalesce(avg(case when value > 5 then 1e0 else 0e0 end)
           filter (where sensor_type = 'vibration'), 0e0) as high_vibration_share,
         coalesce(avg(case when value < 800 then 1e0 else 0e0 end)
           filter (where sensor_type = 'rpm'), 0e0) as low_rpm_share
  from readings group by well_id, location),
full_score as (
  select h.well_id, h.location, avg_anomaly_rate, total_readings,
         {_rounded("invalid_share", 4)} as invalid_share,
         {_rounded("high_vibration_share", 4)} as high_vibration_share,
         {_rounded("low_rpm_share", 4)} as low_rpm_share,
         {_rounded('''greatest(0e0, least(100e0, 100e0 - 40e0 * avg_anomaly_rate
           - 30e0 * invalid_share - 20e0 * high_vibration_share
           - 10e0 * low_rpm_share))''', 1)} as health_score
  from rollup_ h join shares s on h.well_id = s.well_id and h.location = s.location)
select *, {_STATUS} as status from full_score""",
        "hour_bucket": f"""{_with()}
select date_trunc('hour', ts) as hour_start, count(*) as reading_count
from readings group by 1""",
        "tumbling_stats": f"{_with(_HOURLY_STATS)} select * from hourly",
        "rolling_avg": f"""{_with()}
select distinct well_id, sensor_type, ts, count(value) over last_hour as rolling_count,
       {_rounded("avg(value) over last_hour", 6)} as rolling_avg
from readings
window last_hour as (partition by well_id, sensor_type order by ts
  range between interval 1 hour preceding and current row)""",
        "dash_anomaly_series": f"""{_with(_HOURLY_STATS)},
history as ({_rollup("hourly", "window_start,")})
select window_start as "time", well_id as metric, avg_anomaly_rate as anomaly_rate
from history""",
        "top_alerts": f"""{_with(_ALERTS)}
select * from alerts order by alert_count desc, well_id, sensor_type, severity
limit 10""",
        "lowest_health": f"""{_with(_STATS, _HEALTH)}
select well_id, {_SHOWN_SCORE} as health_score, status
from health order by health_score, well_id limit 5""",
        "dash_health_all": f"""{_with(_STATS, _HEALTH)}
select well_id as "Well", {_SHOWN_SCORE} as "Health Score"
from health""",
        "hour_availability": f"""{_with()}
select {_INGEST}, count(*) as raw_count from readings group by 1, 2, 3, 4""",
        "hourly_run": _RUN_RESULTS,
        "rebuild_run": _RUN_RESULTS,
        "field_errors": f"""{_with(_BRONZE)},
wrong as (
  select event_id, unnest(case
    when event_id % 61 = 0 then []
    when event_id % 79 = 0 then ['depth_m']
    when event_id % 83 = 0 then ['is_anomaly'] else [] end) as field
  from delivered)
select field, case field when 'depth_m' then 'deep' else 'maybe' end as text,
       true as in_line,
       case when event_id % 97 = 0 then null when event_id % 89 = 0 then '  '
            when event_id % 13 = 1 then ' ' || well_id || ' '
            else well_id end as well_id,
       case when event_id % 101 = 0 then 'not-a-time'
            when event_id % 103 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
            else {_ISO} end as sent,
       case when event_id % 71 = 0 then 'humidity'
            when event_id % 13 = 1 then ' ' || upper(sensor_type)
            else sensor_type end as sensor_type
from wrong join readings using (event_id)""",
        "stream_landing": _PLAIN_WITH_HOURS,
        "stream_drop_counts": _DROP_COUNTS,
        "stream_clean_dedup": _DEDUP,
        "stream_hourly_stats": f"{_with(_HOURLY_STATS)} select * from hourly",
    }
