"""The named queries once more, in SQL, over the same tables.

Written for DuckDB and independent of the Spark code. Queries whose result SQL cannot give (random
samples, the forest) are missing here.
"""

from __future__ import annotations

# The columns of messages and records, and the mart column of each cause.
MESSAGE = (
    "month", "dayOfWeek", "carrier", "flightNumber", "origin", "originCity", "originState", "dest", "destCity",
    "destState", "depDelay", "arrDelay", "cancelled", "distance", "carrierDelay", "weatherDelay", "nasDelay",
    "securityDelay", "lateAircraftDelay",
)
RECORD = (
    "month", "dayOfWeek", "flightDate", "carrier", "flightNumber", "origin", "originCity", "originState", "dest",
    "destCity", "destState", "crsDepTime", "depTime", "depDelay", "depDel15", "crsArrTime", "arrTime", "arrDelay",
    "arrDel15", "cancelled", "cancellationCode", "distance", "carrierDelay", "weatherDelay", "nasDelay",
    "securityDelay", "lateAircraftDelay",
)
CAUSES = {
    "carrierDelay": "avg_carrier_delay",
    "weatherDelay": "avg_weather_delay",
    "nasDelay": "avg_nas_delay",
    "securityDelay": "avg_security_delay",
    "lateAircraftDelay": "avg_late_aircraft_delay",
}
SENT_AS_ZERO = ("depDelay", "arrDelay", *CAUSES)

FLIGHTS = """
base as (
  select *, cast(json_extract_string(props, '$.k') as int) as k, event_id % 40 = 0 as gone
  from events),
departed as (
  select *, case when not gone then round(value - 40.0, 2) + 0.0 end as dep from base),
arrived as (
  select *, round(dep + (k - 50) / 10.0, 2) + 0.0 as arr from departed),
flights as (
  select event_id as "eventId", ts as "eventTime", cast(ts as date) as "flightDate",
    cast(month(ts) as int) as "month", cast(isodow(ts) as int) as "dayOfWeek",
    upper(substr(event_type, 1, 2)) as "carrier",
    cast(user_id + 100 as varchar) as "flightNumber",
    'O' || (user_id % 25) as "origin",
    'City O' || (user_id % 25) || ', ST' as "originCity", 'ST' as "originState",
    'D' || ((user_id * 7 + event_id) % 25) as "dest",
    'City D' || ((user_id * 7 + event_id) % 25) || ', ST' as "destCity", 'ST' as "destState",
    cast(800 as int) as "crsDepTime",
    case when not gone then cast(800 + k % 60 as int) end as "depTime",
    dep as "depDelay",
    case when dep >= 15 then 1 when dep < 15 then 0 end as "depDel15",
    cast(1100 as int) as "crsArrTime",
    case when not gone then cast(1100 + k % 60 as int) end as "arrTime",
    arr as "arrDelay",
    case when arr >= 15 then 1 when arr < 15 then 0 end as "arrDel15",
    gone as "cancelled", case when gone then 'B' end as "cancellationCode",
    cast(200 + (user_id * 37) % 2500 as double) as "distance",
    case when arr >= 15 then case when k % 4 = 0 then arr else 0.0 end end as "carrierDelay",
    case when arr >= 15 then case when k % 4 = 1 then arr else 0.0 end end as "weatherDelay",
    case when arr >= 15 then case when k % 4 = 2 then arr else 0.0 end end as "nasDelay",
    case when arr >= 15 then case when k = 99 then arr else 0.0 end end as "securityDelay",
    case when arr >= 15 then case when k % 4 = 3 and k <> 99 then arr else 0.0 end end
      as "lateAircraftDelay"
  from arrived)"""


def _columns(*names: str) -> str:
    return ", ".join(f'"{name}"' for name in names)


def _replaced(delays: tuple[str, ...]) -> str:
    return ", ".join(f'coalesce("{d}", 0.0) as "{d}"' for d in delays)


PUBLISHED = f"""{FLIGHTS},
published as (select * replace ({_replaced(SENT_AS_ZERO)}) from flights)"""


def rounded(x: str, places: int = 2) -> str:
    return f"cast(round(cast({x} as decimal(28,10)), {places}) as double)"


def mean(x: str) -> str:
    return rounded(f"avg({x})")


def count_true(x: str) -> str:
    return f"cast(sum(case when {x} then 1 else 0 end) as bigint)"


def total(x: str) -> str:
    return f"cast(sum({x}) as bigint)"


TUMBLING = (
    """time_bucket(interval '5 minutes', "eventTime") as window_start,
    time_bucket(interval '5 minutes', "eventTime") + interval '5 minutes' as window_end"""
)


def carrier_windows(source: str) -> str:
    return f"""select {TUMBLING}, "carrier" as carrier,
    {mean('"arrDelay"')} as avg_arr_delay, {mean('"depDelay"')} as avg_dep_delay,
    count(*) as total_flights, {count_true('"cancelled"')} as cancellations,
    {mean('"weatherDelay"')} as avg_weather_delay, {mean('"carrierDelay"')} as avg_carrier_delay
  from {source} group by all"""


def airport_windows(source: str) -> str:
    return f"""select start as window_start, start + interval '15 minutes' as window_end, origin,
    {mean('"arrDelay"')} as avg_arr_delay,
    count(*) as total_flights, {count_true('"cancelled"')} as cancellations
  from (select *, time_bucket(interval '5 minutes', "eventTime")
      - unnest([0, 5, 10]) * interval '1 minute' as start from {source})
  group by all"""


def uneven_windows(source: str) -> str:
    return f"""select start as window_start, start + interval '15 minutes' as window_end, origin,
    {mean('"arrDelay"')} as avg_arr_delay,
    count(*) as total_flights, {count_true('"cancelled"')} as cancellations
  from (select *, time_bucket(interval '10 minutes', "eventTime")
      - unnest([0, 10]) * interval '1 minute' as start from {source})
  where "eventTime" < start + interval '15 minutes' group by all"""


def cause_windows(source: str) -> str:
    means = ", ".join(f"{mean(chr(34) + field + chr(34))} as {name}" for field, name in CAUSES.items())
    return f"select {TUMBLING}, {means} from {source} group by all"


CATEGORY = """case when "arrDelay" is null or "arrDelay" <= 0 then 'OnTime'
  when "arrDelay" < 30 then 'Minor' when "arrDelay" <= 120 then 'Major' else 'Severe' end"""
CAUSE_TOTAL = " + ".join(f'coalesce("{c}", 0.0)' for c in CAUSES)


def severity(x: str) -> str:
    return (
        f"case when {x} > 20 then 'SEVERE' when {x} > 10 then 'MODERATE' "
        f"when {x} > 0 then 'MINOR' else 'ON TIME' end"
    )


def colour(x: str) -> str:
    return (
        f"case when {x} > 20 then '#ef4444' when {x} > 10 then '#f59e0b' "
        f"when {x} > 0 then '#3b82f6' else '#10b981' end"
    )


def accuracy(actual: str, predicted: str) -> str:
    miss = f"abs(coalesce({actual}, 0) - coalesce({predicted}, 0))"
    return (
        f"case when {miss} <= 5 then 'ACCURATE' when {miss} <= 15 then 'CLOSE' "
        f"when {miss} <= 30 then 'FAIR' else 'OFF' end"
    )


def tenths_text(x: str) -> str:
    """Printing rounds the exact binary value; ties, which are quarters, go to even there."""
    tie = f"({x} * 4 = floor({x} * 4))"
    away = f"format('{{:.1f}}', sign({x}) * floor(abs({x}) * 10 + 0.5) / 10)"
    return f"case when {tie} then {away} else format('{{:.1f}}', {x}) end"


def minutes_text(x: str) -> str:
    number = f"regexp_replace(cast(cast({x} as decimal(18,2)) as varchar), '\\.?0+$', '')"
    return f"case when {x} > 0 then '+' else '' end || {number} || ' min'"


def minutes_tenths_text(x: str) -> str:
    return f"case when {x} > 0 then '+' else '' end || {tenths_text(x)} || ' min'"


MEAN_DELAY = mean("avg_arr_delay")
WEIGHTED_DELAY = rounded(
    "sum(avg_arr_delay * total_flights) / sum(total_flights) filter (avg_arr_delay is not null)"
)


def worst_carriers(delay: str) -> str:
    return f"""with {PUBLISHED}, mart as ({carrier_windows("published")})
select carrier, {delay} as avg_delay, {total("total_flights")} as total_flights,
  {total("cancellations")} as cancellations
from mart group by carrier order by avg_delay desc nulls first, carrier limit 10"""


def worst_airports(delay: str, flights: str = total("total_flights")) -> str:
    return f"""with {PUBLISHED}, mart as ({airport_windows("published")})
select origin, {delay} as avg_delay, {flights} as total_flights
from mart group by origin order by avg_delay desc nulls first, origin limit 10"""


def stats(delay: str) -> str:
    return f"""with {PUBLISHED}, mart as ({carrier_windows("published")})
select coalesce({delay}, 0) as overall_avg_delay,
  coalesce({total("total_flights")}, 0) as total_flights,
  coalesce({total("cancellations")}, 0) as total_cancellations,
  count(distinct carrier) as carriers_tracked
from mart"""


PREDICTIONS = f"""{PUBLISHED}, predictions as (
  select "carrier" as carrier, "flightNumber" as flight_number, "origin" as origin,
    "dest" as dest, {rounded('"depDelay"')} as dep_delay, {rounded('"arrDelay"')} as actual_delay,
    {rounded('"depDelay" * 0.9 + 2')} as predicted_delay, "eventTime" as processed_at, "eventId",
    "flightDate", "depDelay", "arrDelay"
  from published)"""
PREDICTION = "carrier, flight_number, origin, dest, dep_delay, actual_delay, predicted_delay"
LATEST = f"""{PREDICTIONS}, latest as (
  select {PREDICTION}, processed_at from predictions
  order by processed_at desc nulls first, {PREDICTION} limit 20)"""
SCORING_ORDER = """carrier, flight_number, "flightDate", origin, dest, "depDelay", "arrDelay" """

CLEAN = f"""{FLIGHTS}, clean as (
  select "carrier", "origin", "dest", cast("dayOfWeek" as double) as "dayOfWeek",
    cast("month" as double) as "month", coalesce("depDelay", 0.0) as "depDelay", "distance",
    coalesce("weatherDelay", 0.0) as "weatherDelay", coalesce("carrierDelay", 0.0) as "carrierDelay",
    coalesce("nasDelay", 0.0) as "nasDelay", "arrDelay", "eventId"
  from flights where "arrDelay" is not null)"""
INDEXED = f"""{CLEAN}, indexed as (
  select clean.*, c.i as "carrierIdx", o.i as "originIdx", d.i as "destIdx" from clean
""" + "\n".join(
    f"""  join (select "{field}" as label,
      cast(row_number() over (order by count(*) desc, "{field}") - 1 as double) as i
    from clean group by "{field}") {alias} on {alias}.label = clean."{field}" """
    for field, alias in (("carrier", "c"), ("origin", "o"), ("dest", "d"))
) + ")"


def percent(text: str) -> str:
    """0 to 99 by the first seven hex digits of an MD5."""
    return f"cast(('0x' || substr(md5({text}), 1, 7)) as bigint) % 100"


def draw(text: str) -> str:
    """0 to 1 by the first 13 hex digits of an MD5."""
    return f"cast(('0x' || substr(md5({text}), 1, 13)) as bigint) / 4503599627370496.0"


FAULTS = f"""{FLIGHTS}, judged as (
  select *, "eventId" % 20 as kind, case when "eventId" % 20 in (1, 5, 10) then 'columns'
    when "eventId" % 20 = 3 then 'flightDate' when "eventId" % 20 = 6 then 'crsDepTime' end as fault
  from flights)"""


def damaged_city(city: str) -> str:
    return f"""case when kind = 7 then 'The ' || "{city}"
    when kind = 8 then replace("{city}", ',', ' , ') else "{city}" end as "{city}" """


BROKEN = f"""{PUBLISHED}, messages as (
  select * replace (case when "cancelled" then null else "carrier" end as "carrier",
    case when "cancelled" then null else "arrDelay" end as "arrDelay",
    case when "cancelled" then null else "depDelay" end as "depDelay",
    case when "cancelled" then null else "weatherDelay" end as "weatherDelay",
    case when "cancelled" then null else "carrierDelay" end as "carrierDelay",
    false as "cancelled")
  from published), mart as ({carrier_windows("messages")})"""


def summary(*keys: str) -> str:
    classes = ", ".join(
        f"count(*) filter (category = '{name}') as {name.lower()}_flights"
        for name in ("OnTime", "Minor", "Major", "Severe")
    )
    return f"""with {FLIGHTS}, classed as (
  select *, {CATEGORY} as category, {CAUSE_TOTAL} as causes from flights)
select {_columns(*keys)}, count(*) as total_flights, {count_true('"cancelled"')} as cancellations,
  count(*) filter ("arrDel15" = 1) as delayed_flights, {classes},
  {mean('"arrDelay"')} as avg_arr_delay, {rounded("sum(causes)")} as cause_minutes
from classed group by all"""


FIELD_TEXTS = """texts as (
  select event_id, case event_id % 8
      when 0 then '' when 1 then ' ' || chr(9) || number || '  ' when 2 then number || 'x'
      when 3 then '+' || user_id when 4 then ' 00' || user_id || ' ' when 5 then '1.00'
      when 6 then number || 'e2' else '1' end as padded
  from (select *, cast(cast(value as decimal(18,2)) as varchar) as number from events)),
trimmed as (select event_id, trim(padded, ' ' || chr(9)) as text from texts)"""

EVENT_COLUMNS = _columns(*MESSAGE)
EVENT_FIELDS = f"""cast("flightDate" as varchar) as "flightDate", {EVENT_COLUMNS}"""

TREE = f"""with {CLEAN}
select "eventId", {rounded('avg("arrDelay") over (partition by "carrier")', 6)} as prediction from clean"""
RANGE = """"eventTime" >= timestamp '2024-01-10' and "eventTime" < timestamp '2024-01-20'"""

ORACLE: dict[str, str] = {
    "parse_raw": f'with {FLIGHTS} select {_columns(*RECORD, "eventId")} from flights',
    "parse_strict_int": f"""with {FLIGHTS}
select "eventId", "depTime", "arrTime", cast(null as int) as "depDel15",
  cast(null as int) as "arrDel15", false as "isDelayed" from flights""",
    "parse_damaged": f"""with {FAULTS}
select "eventId", case when kind = 4 then date '2024-02-29' else "flightDate" end as "flightDate",
  {damaged_city("originCity")}, {damaged_city("destCity")}, "crsArrTime", "arrDelay"
from judged where fault is null""",
    "quarantine_rows": f"""with {FAULTS}
select "eventId", fault from judged where fault is not null""",
    "quarantine_counts": f"""with {FAULTS}
select count(*) filter (fault is null) as published, count(fault) as skipped from judged""",
    "field_parse": f"""with {FIELD_TEXTS}
select event_id, try_cast(text as double) as as_double,
  case when not contains(text, '.') then try_cast(text as int) end as as_int,
  cast(trunc(try_cast(text as double)) as int) as as_lenient_int,
  text in ('1.00', '1') as as_flag, nullif(text, '') as as_text
from trimmed""",
    "date_parse": """with numbers as (
  select event_id, event_id % 13 + 1 as m, dayofmonth(ts) + event_id % 4 as d from events)
select event_id, case when m <= 12 and d <= 31 then
    least(make_date(2024, least(m, 12), 1) + cast(d - 1 as int),
      last_day(make_date(2024, least(m, 12), 1))) end as flight_date
from numbers""",
    "csv_by_position": f"with {FLIGHTS} select {_columns(*RECORD)} from flights",
    "csv_by_name": f'with {CLEAN} select * exclude ("eventId") from clean',
    "delay_category": f'with {FLIGHTS} select "eventId", {CATEGORY} as "delayCategory" from flights',
    "is_delayed": f"""with {FLIGHTS}
select "eventId", coalesce("arrDel15" = 1, false) as "isDelayed" from flights""",
    "total_cause_delay": f"""with {FLIGHTS}
select "eventId", {CAUSE_TOTAL} as "totalCauseDelay" from flights""",
    "clean_for_ml": f"with {CLEAN} select * from clean",
    "json_props": "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events",
    "message_key": f"""with {FLIGHTS}
select "eventId", "carrier" || '-' || "flightNumber" || '-' || "flightDate" as key from flights""",
    "event_json_roundtrip": f'with {PUBLISHED} select {EVENT_FIELDS}, "eventId" from published',
    "event_json_nulls_kept": f'with {FLIGHTS} select {EVENT_FIELDS}, "eventId" from flights',
    "severity_tag": f"""with {FLIGHTS} select "eventId", {severity('"arrDelay"')} as severity,
  {colour('"arrDelay"')} as colour from flights""",
    "carrier_tumbling": f"with {PUBLISHED} {carrier_windows('published')}",
    "airport_sliding": f"with {PUBLISHED} {airport_windows('published')}",
    "cause_tumbling": f"with {PUBLISHED} {cause_windows('published')}",
    "carrier_tumbling_nulls_kept": f"with {FLIGHTS} {carrier_windows('flights')}",
    "airport_sliding_nulls_kept": f"with {FLIGHTS} {airport_windows('flights')}",
    "cause_tumbling_nulls_kept": f"with {FLIGHTS} {cause_windows('flights')}",
    "batch_delay_summary": summary("carrier"),
    "batch_route_summary": summary("origin", "dest", "flightDate"),
    "kpi_stats": stats(MEAN_DELAY),
    "kpi_stats_weighted": stats(WEIGHTED_DELAY),
    "top_carriers": worst_carriers(MEAN_DELAY),
    "top_carriers_weighted": worst_carriers(WEIGHTED_DELAY),
    "top_airports": worst_airports(MEAN_DELAY),
    "top_airports_weighted": worst_airports(WEIGHTED_DELAY),
    "top_airports_corrected": worst_airports(
        MEAN_DELAY, "cast(floor(sum(total_flights) / 3) as bigint)"
    ),
    "delay_causes_long": f"""with {PUBLISHED}, mart as ({cause_windows("published")})
""" + "\nunion all ".join(
        f"select '{label}' as cause, coalesce({mean(column)}, 0) as minutes from mart"
        for label, column in (
            ("Carrier", "avg_carrier_delay"),
            ("Weather", "avg_weather_delay"),
            ("NAS", "avg_nas_delay"),
            ("Late Aircraft", "avg_late_aircraft_delay"),
        )
    ),
    "airport_leaderboard": f"""with top as ({worst_airports(MEAN_DELAY)}),
ranked as (select *, row_number() over (order by avg_delay desc nulls first, origin) as r,
  greatest(0.0, coalesce(avg_delay, 0) / greatest(max(avg_delay) over (), 1.0) * 100.0) as share
  from top)
select cast(r as int) as rank,
  case r when 1 then 'gold' when 2 then 'silver' when 3 then 'bronze' else '' end as medal,
  origin, avg_delay, cast({tenths_text("share")} as double) as bar_share,
  {colour("avg_delay")} as bar_colour, total_flights, {severity("avg_delay")} as severity
from ranked""",
    "airport_count": f"""with {PUBLISHED}, mart as ({airport_windows("published")})
select least(count(distinct origin), 10) as airports_listed,
  count(distinct origin) as airports_tracked from mart""",
    "accuracy_tag": f"""with {FLIGHTS}
select "eventId", {accuracy('"arrDelay"', '("depDelay" * 0.9 + 2)')} as accuracy from flights""",
    "latest_predictions": f"with {LATEST} select * from latest",
    "prediction_board": f"""with {LATEST}
select carrier || ' ' || flight_number as flight, origin || ' → ' || dest as route,
  {minutes_text("dep_delay")} as departure, coalesce(dep_delay > 0, false) as departure_late,
  {minutes_tenths_text("predicted_delay")} as predicted, {minutes_text("actual_delay")} as actual,
  coalesce(actual_delay > 0, false) as actual_late,
  {accuracy("actual_delay", "predicted_delay")} as accuracy, processed_at
from latest""",
    "prediction_labels": f"""with {PREDICTIONS}
select carrier || ' ' || flight_number as flight, origin || ' → ' || dest as route,
  {minutes_text("actual_delay")} as actual, coalesce(actual_delay > 0, false) as actual_late,
  {minutes_tenths_text("predicted_delay")} as predicted
from predictions""",
    "batch_cap": f"""with {PREDICTIONS}
select {PREDICTION}, "eventId" from predictions order by {SCORING_ORDER}, "eventId" limit 50""",
    "mart_conform": f"with {BROKEN} select * from mart where carrier is not null",
    "mart_quarantine": f"""with {BROKEN}
select window_start, total_flights, 'null carrier' as fault, cast(1 as bigint) as rows
from mart where carrier is null""",
    "mart_upsert": f"""with {PUBLISHED},
later as (select * from flights where "eventTime" >= timestamp '2024-01-15'),
old as ({carrier_windows("published")}), new as ({carrier_windows("later")})
select *, cast(1 as bigint) as batch_id from new
union all
select *, cast(0 as bigint) as batch_id from old
where not exists (select 1 from new
  where new.window_start = old.window_start and new.carrier = old.carrier)""",
    "append_by_batch": f"""with {PREDICTIONS}
select {PREDICTION}, processed_at, cast(batch_id as bigint) as batch_id
from predictions, (values (0), (1)) batches(batch_id)""",
    "append_new_checkpoint": f"""with {PREDICTIONS}
select {PREDICTION}, processed_at, run, cast(batch_id as bigint) as batch_id
from predictions, (values ('first', 0), ('first', 1), ('first', 2), ('first', 3), ('first', 4),
  ('second', 0), ('second', 1), ('second', 2), ('second', 3)) batches(run, batch_id)
where cast(flight_number as int) % 5 = batch_id""",
    "latest_predictions_pruned": f"with {LATEST} select * from latest",
    "airport_sliding_uneven": f"with {PUBLISHED} {uneven_windows('published')}",
    "carrier_summed": f"with {PUBLISHED} {carrier_windows('published')}",
    "airport_summed": f"with {PUBLISHED} {airport_windows('published')}",
    "kpi_stats_range": f"""with {PUBLISHED}
select coalesce({mean('"arrDelay"')}, 0) as overall_avg_delay, count(*) as total_flights,
  coalesce({count_true('"cancelled"')}, 0) as total_cancellations, count(distinct "carrier") as carriers_tracked
from published where {RANGE}""",
    "top_carriers_range": f"""with {PUBLISHED}
select "carrier" as carrier, {mean('"arrDelay"')} as avg_delay, count(*) as total_flights,
  {count_true('"cancelled"')} as cancellations
from published where {RANGE} group by "carrier" order by avg_delay desc nulls first, carrier limit 10""",
    "stream_late_rows": f"with {PUBLISHED} {carrier_windows('published')}",
    "stream_restarted": f"with {PUBLISHED} {airport_windows('published')}",
    "stream_quarantine": f"""with {FLIGHTS}
select "carrier" || '-' || "flightNumber" || '-' || "flightDate" as key, '#' || "eventId" as value,
  'no JSON' as reason, "eventTime" as received from flights where "cancelled\"""",
    "csv_by_name_mixed": f'with {CLEAN} select * exclude ("eventId") from clean',
    "tree_means": TREE,
    "tree_by_nodes": TREE,
    "tree_leaves": f"""with {CLEAN}
select {rounded('avg("arrDelay")', 6)} as prediction, {rounded('avg("arrDelay")', 6)} as mean, count(*) as rows
from clean group by "carrier\"""",
    "tree_importance": """select * from (values ('carrier', 1.0::double), ('month', 0.0::double)) t(feature_name, importance)""",
    "tree_saved_and_loaded": f"""with {CLEAN}
select "carrier" as carrier, {rounded('avg("arrDelay")', 6)} as low, {rounded('avg("arrDelay")', 6)} as high
from clean group by "carrier\"""",
    "stream_scoring_tree": f"""with {PREDICTIONS}, clean_rows as (
  select "carrier" as carrier, avg("arrDelay") as leaf from flights where "arrDelay" is not null group by "carrier")
select p.* exclude (predicted_delay, processed_at, "eventId", "flightDate", "depDelay", "arrDelay"),
  {rounded("leaf")} as predicted_delay from predictions p join clean_rows using (carrier)""",
    "results_history": f"""with {CLEAN}, runs as (
  select 'one' as run, * from clean union all select 'two' as run, * from clean where "carrier" <> 'CL'),
errors as (select run, "arrDelay" as y, "depDelay" * 0.9 + 2 - "arrDelay" as e from runs)
select run, {rounded("1 - sum(e * e) / (var_pop(y) * count(*))", 4)} as r2, {rounded("avg(abs(e))")} as mae,
  {rounded("sqrt(avg(e * e))")} as rmse, count(*) as total_records, 'depDelay' as top_feature
from errors group by run""",
    "importance_upsert": f"""with {FLIGHTS}, whole as (
  select sum("carrierDelay") as c, sum("weatherDelay") as w, sum("nasDelay") as n from flights),
one as (select sum("carrierDelay") as c, sum("weatherDelay") as w from flights where "carrier" = 'CL')
select 'carrierDelay' as feature_name, {rounded("c / (c + w)", 6)} as importance from one
union all select 'weatherDelay', {rounded("w / (c + w)", 6)} from one
union all select 'nasDelay', {rounded("n / (c + w + n)", 6)} from whole""",
    "bernoulli_sample": f"""select event_id from events
where {draw("'42|sample|1|=' || event_id")} < 0.2""",
    "random_split": f"""select event_id, case when {draw("'42|split|1|=' || event_id")} < 0.8
  then 'train' else 'test' end as split from events""",
    "sample_with_repeats": f"""with numbered as (
  select event_type, nullif(user_id % 5, 0) as who,
    row_number() over (partition by event_type, user_id % 5) as nth from events)
select event_type, who from numbered
where {draw("'42|sample|' || nth || '|=' || event_type || '|' || coalesce('=' || who, '-')")} < 0.2""",
    "hash_sample": f"select event_id from events where {percent('cast(event_id as varchar)')} < 20",
    "hash_split": f"""select event_id, case when {percent("'split' || event_id")} < 80
  then 'train' else 'test' end as split from events""",
    "training_counts": f"""with {CLEAN}, drawn as (
  select *, {percent("""cast("eventId" as varchar)""")} < 20 as sampled,
    {percent("""'split' || "eventId" """)} < 80 as training from clean)
select count(*) as cleaned, count(*) filter (sampled) as sampled,
  count(*) filter (sampled and training) as train,
  count(*) filter (sampled and not training) as test from drawn""",
    "string_index": f"""with {INDEXED}
select "eventId", "carrierIdx", "originIdx", "destIdx" from indexed""",
    "feature_vector": f"""with {INDEXED}
select "eventId", "carrierIdx" as carrier, "originIdx" as origin, "destIdx" as dest, "dayOfWeek",
  "month", "depDelay", "distance", "weatherDelay", "carrierDelay", "nasDelay" from indexed""",
    "regression_metrics": f"""with {CLEAN}, errors as (
  select "arrDelay" as y, "depDelay" * 0.9 + 2 - "arrDelay" as e from clean)
select count(*) as rows, {rounded("avg(abs(e))", 4)} as mae, {rounded("sqrt(avg(e * e))", 4)} as rmse,
  {rounded("1 - sum(e * e) / (var_pop(y) * count(*))", 4)} as r2 from errors""",
    "stream_carrier_tumbling": f"with {PUBLISHED} {carrier_windows('published')}",
    "stream_airport_sliding": f"with {PUBLISHED} {airport_windows('published')}",
    "stream_cause_tumbling": f"with {PUBLISHED} {cause_windows('published')}",
    "stream_scoring_fixed": f"with {PREDICTIONS} select {PREDICTION} from predictions",
    "stream_scoring_capped": f"""with {PREDICTIONS}
select {PREDICTION} from predictions order by {SCORING_ORDER} limit 50""",
}
ORACLE["upsert_after_crash"] = ORACLE["mart_upsert"]
