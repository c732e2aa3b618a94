"""The SQL each named query must agree with, over the same ``events`` table."""

from __future__ import annotations

from sensorlake import schemas

READINGS = """
readings as (
    select
        concat('R', cast(event_id as varchar)) as reading_id,
        concat('BLDG_00', cast(user_id % 6 + 1 as varchar)) as building_id,
        concat('ZONE_', substr('ABCD', cast(cast(floor(user_id / 6) as int) % 4 + 1 as int), 1)) as zone_id,
        concat('AC_BLDG_00', cast(user_id % 6 + 1 as varchar), '_ZONE_',
               substr('ABCD', cast(cast(floor(user_id / 6) as int) % 4 + 1 as int), 1),
               '_00', cast(cast(floor(user_id / 24) as int) % 5 + 1 as varchar)) as unit_id,
        ts as reading_timestamp,
        case when event_id % 50 = 0 then null else 9.5e0 + value / 10.0e0 end as temperature_celsius,
        cast(40 + event_id % 30 as double) as humidity_pct,
        case when event_id % 40 = 0 then null
             else cast(json_extract_string(props, '$.k') as int) / 10.0e0 end as energy_consumption_kwh,
        cast(event_id % 6 as int) as runtime_minutes,
        20.0e0 + (user_id % 31) / 10.0e0 as setpoint_celsius,
        case event_type when 'error' then 'ERROR' when 'view' then 'IDLE'
             when 'signup' then 'STANDBY' else 'RUNNING' end as compressor_status,
        case when event_type = 'error' and event_id % 4 = 0
             then concat('E00', cast(event_id % 5 + 1 as varchar)) end as error_code,
        case when event_id % 33 = 0 then null
             when event_type = 'error' and event_id % 4 = 0 then 'UNIT_MALFUNCTION'
             when event_type = 'purchase' and event_id % 25 = 1 then 'EXCESSIVE_ENERGY'
             else 'NORMAL' end as anomaly_type,
        'RAW' as data_quality_flag,
        cast(ts as date) as reading_date,
        cast(cast(ts as date) as timestamp) + interval 1 day as load_timestamp
    from events
)"""

BUILDINGS = "buildings(building_id, building_name, city, country) as (values {})".format(
    ", ".join(f"('{r[0]}', '{r[1]}', '{r[2]}', '{r[3]}')" for r in schemas.BUILDING_ROWS)
)

# What makes a reading invalid, in the order in which it is looked for.
_FAULTS = [
    ("SENSOR_NULL_TEMP", "temperature_celsius is null"),
    ("OUT_OF_RANGE_TEMP", "temperature_celsius not between 10 and 35"),
    ("SENSOR_NULL_ENERGY", "energy_consumption_kwh is null"),
    ("ANOMALY_DETECTED", "anomaly_type <> 'NORMAL'"),
]
# The first fault on the list, or none.
FLAG = "coalesce(list_filter([{}], lambda fault: fault is not null)[1], 'VALID')".format(
    ", ".join(f"if({broken}, '{name}', null)" for name, broken in _FAULTS)
)

# First and last hour of the named parts of a day. All 24 hours are
# looked up in a list; a reading without a time has no hour.
_HOURS = {"BUSINESS_HOURS": (8, 18), "EVENING": (19, 22)}
_NAMED = [
    next((name for name, (first, last) in _HOURS.items() if first <= hour <= last), "OFF_HOURS")
    for hour in range(24)
]
BUCKET = f"coalesce({_NAMED}[extract(hour from reading_timestamp) + 1], 'OFF_HOURS')"


def _silver_of(source: str) -> str:
    return f"""
silver as (
    select s.*, b.building_name, b.city, b.country,
           {FLAG} as quality_flag,
           {BUCKET} as time_bucket,
           temperature_celsius - setpoint_celsius as temp_deviation_celsius
    from {source} s left join buildings b on s.building_id = b.building_id
)"""


# Batch 1 is early; batch 2 is the rest plus newer versions of some early rows.
BATCHES = """
early as (select * from readings where reading_timestamp < timestamp '2024-01-16'),
second as (
    select * from readings where reading_timestamp >= timestamp '2024-01-16'
    union all
    select * replace (humidity_pct + 1 as humidity_pct,
                      timestamp '2024-02-01' as load_timestamp)
    from early where compressor_status = 'ERROR'
),
merged as (
    select * from second
    union all
    select * from early where reading_id not in (select reading_id from second)
)"""

WITH_READINGS = f"with {READINGS}"
WITH_SILVER = f"with {READINGS}, {BUILDINGS}, {_silver_of('readings')}"
# Readings of error events lose their building, and two columns get unknown values.
WITH_SILVER_BROKEN = f"""{WITH_SILVER.replace('silver as', 'sound as')},
silver as (
    select * replace (if(compressor_status = 'ERROR', null, building_id) as building_id,
                      if(humidity_pct > 60, 'FLAG_' || zone_id, quality_flag) as quality_flag,
                      if(humidity_pct < 50, 'OFF', compressor_status) as compressor_status)
    from sound
    union all select * from sound where humidity_pct = 55
)"""
WITH_BATCHES = f"with {READINGS}, {BATCHES}"
WITH_MERGED_SILVER = f"with {READINGS}, {BATCHES}, {BUILDINGS}, {_silver_of('merged')}"


def _rounded(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(38,10)), {digits}) as double)"


# The two aggregates, from their definitions: readings are turned into 0/1 marks
# and measures first, summed by name, and ratios and labels follow from the sums.
ENERGY = f"""
select building_id, building_name, city, country, reading_date, total_readings,
       {_rounded('energy', 2)} as total_energy_kwh,
       {_rounded('energy / with_energy', 3)} as avg_energy_kwh,
       {_rounded('temperature / with_temperature', 2)} as avg_temperature,
       {_rounded('humidity / with_humidity', 2)} as avg_humidity,
       anomaly_count, error_count,
       {_rounded('100e0 * anomaly_count / total_readings', 2)} as anomaly_rate_pct
from (
    select building_id, building_name, city, country, reading_date,
           cast(sum(1) as bigint) as total_readings,
           sum(energy_consumption_kwh) as energy,
           nullif(count(energy_consumption_kwh), 0) as with_energy,
           sum(temperature_celsius) as temperature,
           nullif(count(temperature_celsius), 0) as with_temperature,
           sum(humidity_pct) as humidity,
           nullif(count(humidity_pct), 0) as with_humidity,
           cast(sum(if(quality_flag = 'ANOMALY_DETECTED', 1, 0)) as bigint) as anomaly_count,
           cast(sum(if(compressor_status = 'ERROR', 1, 0)) as bigint) as error_count
    from silver where not quality_flag = 'SENSOR_NULL_ENERGY'
    group by building_id, building_name, city, country, reading_date
) sums"""

_HEALTH_LABELS = "labels(least_errors, most_errors, health_status) as (values {})".format(
    # Error counts that a unit's label covers.
    "(0, 3, 'HEALTHY'), (4, 10, 'WARNING'), (11, 9223372036854775807, 'CRITICAL')"
)

HEALTH = f"""
, units as (
    select unit_id, building_id, building_name, zone_id,
           cast(sum(1) as bigint) as total_readings,
           sum(temperature_celsius) / nullif(count(temperature_celsius), 0) as temperature,
           sum(energy_consumption_kwh) / nullif(count(energy_consumption_kwh), 0) as energy,
           cast(sum(runtime_minutes) as bigint) as total_runtime_minutes,
           count(error_code) as error_count,
           cast(sum(if(compressor_status = 'ERROR', 1, 0)) as bigint) as compressor_error_count,
           cast(sum(if(anomaly_type <> 'NORMAL', 1, 0)) as bigint) as anomaly_count,
           max(reading_date) as last_reading_date
    from silver group by unit_id, building_id, building_name, zone_id
), {_HEALTH_LABELS}
select units.* exclude (temperature, energy),
       {_rounded('temperature', 2)} as avg_temperature,
       {_rounded('energy', 3)} as avg_energy_kwh,
       health_status
from units join labels on error_count between least_errors and most_errors"""

ALERTS = f"""
select {', '.join(schemas.ALERT_COLUMNS)}
from silver
where quality_flag != 'VALID'
order by reading_timestamp desc"""

LOADS = """
select case when reading_timestamp < timestamp '2024-01-16' then cast(1 as bigint)
            else cast(2 as bigint) end as load_number,
       reading_date, count(*) as rows_loaded
from readings group by 1, 2"""


def _accepted(column: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"""
    select 'accepted_values' as test, '{column}' as "column", count(*) as failures
    from (select {column} from silver where {column} not in ({listed}) group by 1) v"""


def _not_null(column: str) -> str:
    return f"""
    select 'not_null' as test, '{column}' as "column", count(*) as failures
    from silver where {column} is null"""


_NOT_NULL = [_not_null(c) for c in ("reading_id", "building_id", "quality_flag", "reading_timestamp")]
_ACCEPTED = {
    "building_id": _accepted("building_id", schemas.BUILDING_IDS),
    "quality_flag": _accepted("quality_flag", schemas.QUALITY_FLAGS),
    "compressor_status": _accepted("compressor_status", schemas.COMPRESSOR_STATES),
}
_UNIQUE = """
    select 'unique' as test, 'reading_id' as "column", count(*) as failures
    from (select reading_id from silver where reading_id is not null
          group by 1 having count(*) > 1) d"""


def _with_status(*parts: str) -> str:
    union = " union all ".join(parts)
    return f"""
select test, "column", failures,
       case when failures = 0 then 'pass' else 'fail' end as status
from ({union}) t"""


ORACLES: dict[str, str] = {
    "bronze_extract": f"{WITH_READINGS} select * from readings",
    "tolerant_casts": f"""{WITH_READINGS}, garbled as (
        select * replace (
            case when error_code is null then reading_timestamp end as reading_timestamp,
            case when error_code is null then reading_date end as reading_date)
        from readings)
        select reading_id, reading_timestamp, reading_date, {BUCKET} as time_bucket from garbled""",
    "bad_record_skip": f"{WITH_READINGS} select * from readings where error_code is null",
    "load_manifest": f"""{WITH_READINGS}
        select reading_date,
               cast(count(*) - count(error_code) as bigint) as rows_loaded,
               count(error_code) as rows_rejected
        from readings group by 1""",
    "write_manifest": f"""{WITH_READINGS}
        select reading_date as date, count(*) as record_count, '1.0.0' as version
        from readings group by 1""",
    "list_files": f"{WITH_READINGS} select reading_date, true as all_json from readings group by 1",
    "load_window": f"""{WITH_READINGS} select * exclude (load_timestamp) from readings
        where reading_date >= date '2024-01-10' and reading_date < date '2024-01-17'""",
    "skip_existing_days": f"""{WITH_READINGS}
        select reading_id,
               case when reading_timestamp < timestamp '2024-01-16' then 'OLDER'
                    else data_quality_flag end as data_quality_flag
        from readings""",
    "row_numbers": f"""{WITH_READINGS}
        select reading_date, count(*) as lines, cast(0 as bigint) as misnumbered_files
        from readings group by 1""",
    "file_load_once": f"{WITH_READINGS} {LOADS}",
    "stream_load_once": f"{WITH_READINGS} {LOADS}",
    "quality_flag_counts": f"{WITH_READINGS} select {FLAG} as quality_flag, count(*) as readings from readings group by 1",
    "time_bucket_counts": f"{WITH_READINGS} select {BUCKET} as time_bucket, count(*) as readings from readings group by 1",
    "temp_deviation": f"""{WITH_READINGS}
        select reading_id, temperature_celsius - setpoint_celsius as temp_deviation_celsius
        from readings""",
    "building_enrich": f"{WITH_SILVER} select reading_id, building_id, building_name, city, country from silver",
    "silver": f"{WITH_SILVER} select * from silver",
    "staging_view": f"{WITH_SILVER} select country, time_bucket, count(*) as readings from silver group by 1, 2",
    "high_water_mark": f"{WITH_READINGS} select max(load_timestamp) as load_timestamp from readings",
    "incremental_slice": f"""{WITH_READINGS} select * from readings
        where load_timestamp > (select max(load_timestamp) from readings
                                where reading_timestamp < timestamp '2024-01-16')""",
    "upsert_corrections": f"{WITH_BATCHES} select * from merged",
    "upsert_latest": f"{WITH_BATCHES} select * from merged",
    "merge_stored": f"{WITH_MERGED_SILVER} select * from silver",
    "schema_sync_add": f"""{WITH_BATCHES}
        select m.*, case when s.reading_id is not null
                         then concat('SITE_', right(m.building_id, 1)) end as site
        from merged m left join second s on m.reading_id = s.reading_id""",
    "schema_sync_drop": f"{WITH_BATCHES} select * exclude (data_quality_flag) from merged",
    "schema_sync_stored": f"""{WITH_BATCHES}
        select m.* exclude (data_quality_flag),
               case when s.reading_id is not null
                    then concat('SITE_', right(m.building_id, 1)) end as site
        from merged m left join second s on m.reading_id = s.reading_id""",
    "stream_upsert": f"{WITH_MERGED_SILVER} select * exclude (load_timestamp) from silver",
    "gold_building_energy_summary": f"{WITH_SILVER} {ENERGY}",
    "gold_equipment_health": f"{WITH_SILVER} {HEALTH}",
    "gold_anomaly_alerts": f"{WITH_SILVER} {ALERTS}",
    "chain_energy_summary": f"{WITH_SILVER} {ENERGY}",
    "chain_equipment_health": f"{WITH_SILVER} {HEALTH}",
    "chain_anomaly_alerts": f"{WITH_SILVER} {ALERTS}",
    "chain_incremental": f"""{WITH_MERGED_SILVER}, energy as ({ENERGY}),
        health as (with h as (select 1) {HEALTH})
        select 'energy' as model, building_id as name, reading_date as date, total_readings,
               avg_humidity, avg_temperature, avg_energy_kwh, error_count, anomaly_count from energy
        union all
        select 'health', unit_id, last_reading_date, total_readings, null, avg_temperature,
               avg_energy_kwh, error_count, anomaly_count from health
        union all
        select 'alerts', quality_flag, reading_date, count(*), null, null, null, null, null
        from ({ALERTS}) alerts group by 1, 2, 3""",
    "dq_unique": f"""{WITH_BATCHES}, appended as (
        select reading_id from readings union all
        select reading_id from second where load_timestamp = timestamp '2024-02-01'
                                        and reading_timestamp < timestamp '2024-01-16')
        select reading_id, count(*) as n_records from appended group by 1 having count(*) > 1""",
    "dq_not_null": f"""{WITH_SILVER}
        select "column", failures from ({' union all '.join(_NOT_NULL)}) t""",
    "dq_not_null_rows": f"{WITH_SILVER} select reading_id from silver where anomaly_type is null",
    "dq_accepted_building": f"""{WITH_SILVER}
        select building_id as value, count(*) as n_records from silver
        where building_id not in ({', '.join(f"'{b}'" for b in schemas.BUILDING_IDS)}) group by 1""",
    "dq_accepted_flag": f"{WITH_SILVER} {_with_status(_ACCEPTED['quality_flag'])}",
    "dq_accepted_compressor": f"{WITH_SILVER} {_with_status(_ACCEPTED['compressor_status'])}",
    "dq_suite_failing": f"""{WITH_SILVER_BROKEN}
        {_with_status(_UNIQUE, *_NOT_NULL, *_ACCEPTED.values())}""",
    "dq_suite": f"{WITH_SILVER} {_with_status(_UNIQUE, *_NOT_NULL, *_ACCEPTED.values())}",
}
