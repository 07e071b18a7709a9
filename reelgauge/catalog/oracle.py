"""The SQL each query must equal, on the same tables."""

from __future__ import annotations

# The typed fact, one row per event.
FACT = """
f as (
  select 'm' || json_extract_string(props, '$.k') as media_id,
         cast(user_id as varchar) as visitor_id,
         cast(case when event_type in ('view', 'click') then 1 else 0 end as bigint) as load_count,
         cast(case when event_type = 'click' then 1 else 0 end as bigint) as play_count,
         'e' || cast(event_id as varchar) as last_event_key,
         case when event_type not in ('signup', 'error') then ts end as first_seen,
         case when event_type not in ('signup', 'error', 'view') then ts end as last_active,
         cast(ts as date) as dt, event_type
  from events)"""

# The fact as silver keeps it.
FACT_PER_DAY = (
    FACT
    + """,
fd as (
  select * from f
  qualify row_number() over (partition by media_id, visitor_id, dt
                             order by last_active desc nulls last, last_event_key desc) = 1)"""
)

# Media dimension: every row of part, its row per media and day, its row per media.
MEDIA = """
part_rows as (
  select 'm' || cast(p_size as varchar) as media_id, p_name as title,
         p_retailprice as duration_seconds,
         cast(cast(date '2024-01-01' + p_size as date) as timestamp) as created_at,
         cast(date '2024-01-01' as timestamp) + to_minutes(p_partkey) as updated_at,
         'ready' as status, p_brand || ',' || p_type as tags, p_brand as project_id,
         p_type as project_name,
         'https://img.example.com/' || cast(p_partkey as varchar) || '.jpg' as thumbnail_url,
         cast(cast(date '2024-01-01' as timestamp) + to_minutes(p_partkey) as date) as dt
  from part),
dim as (
  select * from part_rows
  qualify row_number() over (partition by media_id, dt order by updated_at desc) = 1),
latest as (
  select * from dim qualify row_number() over (partition by media_id order by dt desc) = 1)"""

# The fact with its event date.
DATED = """
e as (
  select f.*, coalesce(cast(f.last_active as date), cast(f.first_seen as date),
                       cast(latest.created_at as date)) as event_date
  from f left join latest on f.media_id = latest.media_id)"""

MEDIA_GOLD = """
mg as (
  select media_id, event_date, cast(sum(load_count) as bigint) as total_loads,
         cast(sum(play_count) as bigint) as total_plays
  from e group by media_id, event_date)"""

VISITOR_GOLD = """
vg as (
  select visitor_id, event_date, count(media_id) as media_interactions,
         cast(sum(play_count) as bigint) as total_plays,
         cast(sum(load_count) as bigint) as total_loads
  from e group by visitor_id, event_date)"""

# Gold in its older naming, read leniently.
OLD_MEDIA = """
om as (
  select 'm' || json_extract_string(props, '$.k') as media_id,
         case when event_type <> 'error' then cast(ts as date) end as event_date,
         cast(case when event_type = 'click' then 1 else 0 end as double) as total_plays,
         cast(case when event_type in ('click', 'view') then 1 else 0 end as double) as total_loads,
         cast(floor(value) as double) as watch_time_sec
  from events)"""
OLD_VISITORS = """
ov as (
  select cast(user_id as varchar) as visitor_id, cast(ts as date) as event_date,
         cast(case when event_type = 'click' then 1 else 0 end as bigint) as total_plays,
         cast(floor(value) as double) as watch_time_sec
  from events)"""

# The visitors feed after typing: views and errors lose their last activity, purchases were
# written two hours ahead, the play count of an error is not a number.
FEED = """
feed as (
  select 'm' || json_extract_string(props, '$.k') as media_id,
         cast(user_id as varchar) as visitor_id,
         cast(case when event_type in ('view', 'click') then 1 else 0 end as bigint) as load_count,
         cast(case when event_type = 'click' then 1 when event_type = 'error' then null
              else 0 end as bigint) as play_count,
         'e' || cast(event_id as varchar) as last_event_key,
         case when event_type = 'click' then date_trunc('millisecond', ts)
              when event_type = 'view' then date_trunc('second', ts)
              when event_type = 'purchase' then date_trunc('second', ts) - to_hours(2)
         end as first_seen,
         case when event_type in ('click', 'purchase') then date_trunc('millisecond', ts)
         end as last_active,
         cast(ts as date) as dt, event_type, value, ts
  from events)"""
FEED_FACT = (
    FEED
    + """,
s as (
  select * from feed
  qualify row_number() over (partition by media_id, visitor_id, dt
                             order by last_active desc nulls last, last_event_key desc) = 1)"""
)
VISITOR_DIM = (
    FEED
    + """,
dv as (
  select * from feed
  qualify row_number() over (partition by visitor_id, dt
                             order by last_active desc nulls last, last_event_key desc) = 1)"""
)

MEDIAS = """
stats as (
  select 'm' || cast(l_partkey as varchar) as media_id, cast(l_quantity as bigint) as load_count,
         cast(l_linenumber as bigint) as play_count, l_tax as play_rate,
         l_extendedprice as hours_watched, l_discount as engagement, l_orderkey as visitors,
         cast(l_shipdate as date) as dt
  from lineitem
  qualify row_number() over (
    partition by l_partkey, cast(l_shipdate as date)
    order by l_quantity desc, l_linenumber desc, l_extendedprice desc, l_orderkey desc,
             l_discount desc, l_tax desc) = 1)"""

# (dataset, field, declared, found): the feeds are landed as text, some statistics are not there.
SCHEMA_ROWS = """
('medias', 'engagement', 'double', null)
('medias', 'event_date', 'string', 'string')
('medias', 'hours_watched', 'double', null)
('medias', 'load_count', 'bigint', 'string')
('medias', 'media_id', 'string', 'string')
('medias', 'play_count', 'bigint', 'string')
('medias', 'play_rate', 'double', null)
('medias', 'visitors', 'bigint', 'string')
('metadata', 'created', 'string', 'string')
('metadata', 'duration', 'double', 'string')
('metadata', 'hashed_id', 'string', 'string')
('metadata', 'name', 'string', 'string')
('metadata', 'project.id', 'string', 'string')
('metadata', 'project.name', 'string', 'string')
('metadata', 'status', 'string', 'string')
('metadata', 'tags', 'array<string>', 'array<string>')
('metadata', 'thumbnail.url', 'string', 'string')
('metadata', 'updated', 'string', 'string')
('visitors', 'created_at', 'string', 'string')
('visitors', 'event_date', 'string', 'string')
('visitors', 'last_active_at', 'string', 'string')
('visitors', 'last_event_key', 'string', 'string')
('visitors', 'load_count', 'bigint', 'string')
('visitors', 'media_id', 'string', 'string')
('visitors', 'play_count', 'bigint', 'string')
('visitors', 'user_agent_details.browser', 'string', 'string')
('visitors', 'user_agent_details.mobile', 'boolean', 'string')
('visitors', 'user_agent_details.platform', 'string', 'string')
('visitors', 'visitor_identity.email', 'string', 'string')
('visitors', 'visitor_identity.name', 'string', 'string')
('visitors', 'visitor_identity.org.name', 'string', 'string')
('visitors', 'visitor_identity.org.title', 'string', 'string')
('visitors', 'visitor_key', 'string', 'string')
""".strip().splitlines()

STAMP = "%Y-%m-%d %H:%M:%S.%f"
RANGE = "event_date between date '2024-01-03' and date '2024-01-28'"
GOLD_MEDIA_COLUMNS = "media_id, cast(event_date as varchar) as event_date, total_loads, total_plays"
GOLD_VISITOR_COLUMNS = (
    "visitor_id, cast(event_date as varchar) as event_date, media_interactions, total_plays,"
    " total_loads"
)


def stamp(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '{STAMP}') as {name or column}"


def sql(select: str, *tables: str) -> str:
    return f"with {','.join(tables)}\n{select}" if tables else select


BASE = (FACT, MEDIA, DATED)
# From bronze on, the fact is the typed feed after deduplication.
FROM_BRONZE = (FEED_FACT, "\nf as (select * from s)", MEDIA, DATED)
PER_DAY_LATEST = """
f as (
  select * from fd
  qualify row_number() over (partition by media_id, visitor_id order by dt desc) = 1)"""


def gained(source: str, target: str, idle: bool) -> str:
    """Running totals of ``source`` as increments in ``target``."""
    before = """last_value({0} ignore nulls) over (
      partition by media_id, visitor_id order by dt
      rows between unbounded preceding and 1 preceding) as {0}_before"""
    gain = "case when {0} < {0}_before then {0} else {0} - coalesce({0}_before, 0) end as {0}"
    totals = "load_count", "play_count"
    kept = "" if idle else "\n  where coalesce(load_count, 0) <> 0 or coalesce(play_count, 0) <> 0"
    return f"""
{target}_before as (
  select *, {', '.join(before.format(t) for t in totals)} from {source}),
{target}_gained as (
  select * replace ({', '.join(gain.format(t) for t in totals)}) from {target}_before),
{target} as (select * from {target}_gained{kept})"""


# Totals per media, one of seven visitors and day, running on for ten days of a month at a time.
RUNNING = (
    FACT.replace("\nf as (", "\nraw as (", 1)
    + """,
summed as (
  select media_id, 'v' || cast(cast(visitor_id as bigint) % 7 as varchar) as visitor_id, dt,
         sum(load_count) as loads, sum(play_count) as plays,
         max(last_event_key) as last_event_key, min(first_seen) as first_seen,
         max(last_active) as last_active
  from raw group by all),
running as (
  select * exclude (loads, plays), cast(sum(loads) over since as bigint) as load_count,
         cast(sum(plays) over since as bigint) as play_count
  from summed
  window since as (partition by media_id, visitor_id, date_trunc('month', dt), day(dt) // 10
                   order by dt))"""
)
FROM_RUNNING = (RUNNING, gained("running", "f", idle=False), MEDIA, DATED)
FROM_LATEST = (
    FACT_PER_DAY.replace("\nf as (", "\nraw as (", 1).replace("from f\n", "from raw\n"),
    PER_DAY_LATEST,
    MEDIA,
    DATED,
)
FACT_DAYS = FROM_LATEST[:1]

DIM_MEDIA_COLUMNS = f"""media_id, title, duration_seconds, {stamp('created_at')},
  {stamp('updated_at')}, status, tags, project_id, project_name, thumbnail_url,
  cast(dt as varchar) as dt"""
FACT_COLUMNS = f"""media_id, visitor_id, load_count, play_count, last_event_key,
  {stamp('first_seen')}, {stamp('last_active')}, cast(dt as varchar) as dt"""

RESOLVED = sql(
    f"select {FACT_COLUMNS}, cast(event_date as varchar) as event_date from e", *BASE
)

ORACLE: dict[str, str] = {
    "media_daily": sql(f"select {GOLD_MEDIA_COLUMNS} from mg", *BASE, MEDIA_GOLD),
    "visitor_daily": sql(f"select {GOLD_VISITOR_COLUMNS} from vg", *BASE, VISITOR_GOLD),
    "media_daily_first_seen": sql(
        """select media_id, cast(cast(first_seen as date) as varchar) as event_date,
                  cast(sum(load_count) as bigint) as total_loads,
                  cast(sum(play_count) as bigint) as total_plays
           from f group by media_id, cast(first_seen as date)""",
        FACT,
    ),
    "visitor_daily_sum_plays": sql(
        """select visitor_id, cast(event_date as varchar) as event_date,
                  total_plays as media_interactions, total_plays, total_loads from vg""",
        *BASE, VISITOR_GOLD,
    ),
    "media_daily_latest_snapshot": sql(
        f"select {GOLD_MEDIA_COLUMNS} from mg", *FROM_LATEST, MEDIA_GOLD
    ),
    "visitor_daily_latest_snapshot": sql(
        f"select {GOLD_VISITOR_COLUMNS} from vg", *FROM_LATEST, VISITOR_GOLD
    ),
    "gold_ymd": sql(
        """select media_id, cast(cast(first_seen as date) as varchar) as event_date,
                  cast(sum(load_count) as bigint) as total_loads,
                  cast(sum(play_count) as bigint) as total_plays,
                  cast(year(cast(first_seen as date)) as integer) as year,
                  cast(month(cast(first_seen as date)) as integer) as month,
                  cast(day(cast(first_seen as date)) as integer) as day
           from f group by media_id, cast(first_seen as date)""",
        FACT,
    ),
    "resolve_event_date": RESOLVED,
    "resolve_event_date_unbroadcast": RESOLVED,
    "resolve_event_date_again": RESOLVED,
    "sample_rows": sql(
        f"""select {GOLD_MEDIA_COLUMNS} from mg
            order by mg.media_id nulls first, mg.event_date nulls first limit 50""",
        *BASE, MEDIA_GOLD,
    ),
    "event_date_coverage": sql(
        """select count(*) as fact_rows,
                  count(*) filter (where first_seen is null and last_active is null) as null_before,
                  count(*) filter (where event_date is null) as null_after
           from e""",
        *BASE,
    ),
    "unknown_media": sql(
        "select distinct media_id from f where media_id not in (select media_id from dim)",
        FACT, MEDIA,
    ),
    "with_title": sql(
        f"""select {GOLD_MEDIA_COLUMNS.replace('media_id', 'mg.media_id', 1)},
                   latest.title as media_title
            from mg left join latest on mg.media_id = latest.media_id""",
        *BASE, MEDIA_GOLD,
    ),
    "row_counts": sql(
        """select 'visitors' as name, count(*) as "rows" from feed
           union all select 'dim_media', count(*) from dim
           union all select 'dim_visitor', count(*) from
             (select distinct visitor_id, dt from feed)
           union all select 'fact_media_engagement', count(*) from s""",
        FEED_FACT, MEDIA,
    ),
    "dim_media": sql(f"select {DIM_MEDIA_COLUMNS} from dim", MEDIA),
    "latest_dim_media": sql(f"select {DIM_MEDIA_COLUMNS} from latest", MEDIA),
    "dim_visitor": sql(
        f"""select visitor_id, 'visitor' || visitor_id || '@example.com' as email,
                   'Visitor ' || visitor_id as name,
                   'Org ' || cast(length(visitor_id) as varchar) as org_name,
                   event_type as org_title, 'browser-' || event_type as browser,
                   case when value < 10 then 'desktop' else 'phone' end as platform,
                   value >= 10 as is_mobile, {stamp('first_seen')}, {stamp('last_active')},
                   cast(dt as varchar) as dt
            from dv""",
        VISITOR_DIM,
    ),
    "fact_media_engagement": sql(f"select {FACT_COLUMNS} from s", FEED_FACT),
    "fact_media_daily_raw": sql(
        """select media_id, load_count, play_count, play_rate, hours_watched, engagement, visitors,
                  cast(dt as varchar) as dt
           from stats""",
        MEDIAS,
    ),
    "fact_media_daily_titled": sql(
        """select stats.media_id, load_count, play_count, play_rate, hours_watched, engagement,
                  visitors, cast(stats.dt as varchar) as dt, title
           from stats left join latest on stats.media_id = latest.media_id""",
        MEDIAS, MEDIA,
    ),
    "parse_ts": sql(
        f"""select last_event_key, {stamp('first_seen', 'created')},
                   {stamp('last_active', 'active')},
                   {stamp('cast(dt as timestamp)', 'day_start')}
            from feed""",
        FEED,
    ),
    "date10": sql(
        """select last_event_key,
                  case when event_type in ('click', 'view', 'purchase')
                       then cast(dt as varchar) end as created_day,
                  case when event_type in ('click', 'purchase')
                       then cast(dt as varchar) end as active_day
           from feed""",
        FEED,
    ),
    "media_id_from_path": sql(
        """select last_event_key, media_id as visitors_id, upper(media_id) as upper_case_id,
                  cast(null as varchar) as other_kind, media_id as deeper_id
           from feed""",
        FEED,
    ),
    "dt_from_path": sql(
        """select last_event_key, cast(dt as varchar) as day, cast(dt as varchar) as inner_day,
                  cast(null as varchar) as no_day
           from feed""",
        FEED,
    ),
    "with_ids": sql(
        """select last_event_key, media_id, cast(dt as varchar) as dt,
                  cast(dt as varchar) as event_date
           from feed""",
        FEED,
    ),
    "typed_casts": sql(
        """select last_event_key, load_count as loads, play_count as plays,
                  cast(play_count as double) as plays_double, load_count * 10 as exponent,
                  value >= 10 as is_mobile
           from feed""",
        FEED,
    ),
    "coalesce_text": sql(
        """select last_event_key,
                  coalesce(rtrim(rtrim(strftime(last_active, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.'),
                           cast(dt as varchar)) as first_filled
           from f""",
        FACT,
    ),
    "backfill_days": """
        select cast(cast(day as date) as varchar) as day from (
          select unnest(generate_series(
            (select min(cast(ts as date)) from events), (select max(cast(ts as date)) from events),
            interval 1 day)) as day)""",
    "prep_kpi": sql(
        """select media_id, cast(event_date as varchar) as event_date, count(*) as n,
                  sum(total_plays) as plays, sum(total_loads) as loads,
                  sum(watch_time_sec) as watch_time_sec
           from om group by media_id, event_date""",
        OLD_MEDIA,
    ),
    "media_totals": sql(
        """select cast(sum(total_plays) as bigint) as total_plays,
                  cast(sum(total_loads) as bigint) as total_loads,
                  cast(sum(watch_time_sec) as bigint) as total_watch_time_sec,
                  round(100.0 * sum(total_plays) / sum(total_loads), 2) as avg_play_rate
           from om""",
        OLD_MEDIA,
    ),
    "media_totals_last_30_days": sql(
        """select cast(sum(total_plays) as bigint) as total_plays,
                  cast(sum(total_loads) as bigint) as total_loads,
                  cast(sum(watch_time_sec) as bigint) as total_watch_time_sec,
                  round(100.0 * sum(total_plays) / sum(total_loads), 2) as avg_play_rate
           from om where event_date between date '2024-01-11' and date '2024-02-10'""",
        OLD_MEDIA,
    ),
    "media_totals_empty": sql(
        """select cast(coalesce(sum(total_plays), 0) as bigint) as total_plays,
                  cast(coalesce(sum(total_loads), 0) as bigint) as total_loads,
                  cast(coalesce(sum(watch_time_sec), 0) as bigint) as total_watch_time_sec,
                  cast(0 as double) as avg_play_rate
           from om where event_date = date '1990-01-01'""",
        OLD_MEDIA,
    ),
    "visitor_totals": sql(
        """select count(distinct visitor_id) as unique_visitors,
                  cast(sum(total_plays) as bigint) as total_visitor_plays,
                  cast(sum(watch_time_sec) as bigint) as total_visitor_watch,
                  round(sum(watch_time_sec) / count(distinct visitor_id), 2)
                    as avg_watch_per_visitor
           from ov""",
        OLD_VISITORS,
    ),
    "unique_visitors": sql("select count(distinct visitor_id) as unique_visitors from f", FACT),
    "media_kpis": sql(
        """select media_id, sum(total_plays) as plays, sum(total_loads) as loads,
                   sum(watch_time_sec) as watch_time_sec,
                   case when sum(total_loads) = 0 then 0.0
                        else round(100.0 * sum(total_plays) / sum(total_loads), 2)
                   end as play_rate
            from om group by media_id order by plays desc, media_id""",
        OLD_MEDIA,
    ),
    "media_trend": sql(
        """select cast(event_date as varchar) as event_date, sum(total_plays) as plays,
                  sum(watch_time_sec) as watch_time_sec
           from om where event_date is not null group by event_date order by event_date""",
        OLD_MEDIA,
    ),
    "visitor_trend": sql(
        """select cast(event_date as varchar) as event_date,
                   cast(sum(total_plays) as bigint) as plays, sum(watch_time_sec) as watch_time_sec
            from ov group by event_date order by event_date""",
        OLD_VISITORS,
    ),
    "top_visitors": sql(
        """select visitor_id, cast(sum(total_plays) as bigint) as plays,
                  sum(watch_time_sec) as watch_time_sec
           from ov group by visitor_id order by plays desc, watch_time_sec desc, visitor_id
           limit 25""",
        OLD_VISITORS,
    ),
    "media_list": sql(
        """select distinct mg.media_id, latest.title as media_title
           from mg left join latest on mg.media_id = latest.media_id""",
        *BASE, MEDIA_GOLD,
    ),
    "default_media": sql("select distinct media_id from f order by media_id limit 15", FACT),
    "summary_kpis": sql(
        f"""select (select count(distinct visitor_id) from vg where {RANGE}) as unique_visitors,
                   cast(sum(total_plays) as bigint) as total_plays,
                   cast(sum(total_loads) as bigint) as total_loads,
                   cast(100.0 as double) * sum(total_plays) / sum(total_loads) as play_rate_pct
            from mg where {RANGE}""",
        *BASE, MEDIA_GOLD, VISITOR_GOLD,
    ),
    "summary_kpis_default_media": sql(
        f"""select (select count(distinct visitor_id) from vg where {RANGE}) as unique_visitors,
                   cast(sum(total_plays) as bigint) as total_plays,
                   cast(sum(total_loads) as bigint) as total_loads,
                   cast(100.0 as double) * sum(total_plays) / sum(total_loads) as play_rate_pct
            from mg where {RANGE} and media_id in
              (select distinct media_id from mg order by media_id limit 15)""",
        *BASE, MEDIA_GOLD, VISITOR_GOLD,
    ),
    "media_daily_series": sql(
        f"""select cast(event_date as varchar) as event_date, mg.media_id,
                   latest.title as media_title, total_plays, total_loads
            from mg left join latest on mg.media_id = latest.media_id where {RANGE}
            order by event_date, media_title""",
        *BASE, MEDIA_GOLD,
    ),
    "visitor_daily_series": sql(
        f"""select cast(event_date as varchar) as event_date,
                   cast(sum(media_interactions) as bigint) as media_interactions,
                   cast(sum(total_plays) as bigint) as total_plays
            from vg where {RANGE} group by event_date order by event_date""",
        *BASE, VISITOR_GOLD,
    ),
    "media_in_selection": sql(
        f"""select {GOLD_MEDIA_COLUMNS} from mg where media_id in
              (select distinct media_id from mg order by media_id limit 15)""",
        *BASE, MEDIA_GOLD,
    ),
    "bronze_roundtrip": sql(
        """select last_event_key, visitor_id as visitor_key, media_id,
                  case event_type
                    when 'click' then strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
                    when 'view' then strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                    when 'purchase' then strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00')
                    when 'error' then '' end as created_at,
                  case event_type when 'click' then '1' when 'view' then '1.0' else '0' end
                    as load_count,
                  cast(dt as varchar) as dt, event_type as org_title
           from feed""",
        FEED,
    ),
    "landed_day": sql(
        """select last_event_key, visitor_id as visitor_key, media_id, '2024-02-01' as dt,
                  '2024-02-01' as event_date from f""",
        FACT,
    ),
    "schema_report": "select * from (values\n"
    + ",\n".join(SCHEMA_ROWS)
    + ") as t(dataset, field, expected, found)",
    "bronze_selected_days": sql(
        """select last_event_key, visitor_id as visitor_key, media_id, cast(dt as varchar) as dt
           from feed where dt in (date '2024-01-03', date '2024-01-28')""",
        FEED,
    ),
    "multiline_json": sql(
        """select last_event_key, visitor_id as visitor_key,
                  case event_type when 'view' then null when 'error' then '' else media_id end
                    as media_id,
                  cast(dt as varchar) as event_date,
                  'visitor' || visitor_id || '@example.com' as email
           from feed""",
        FEED,
    ),
    "corrupt_rows": """
        select cast(cast(ts as date) as varchar) as dt,
               count(*) filter (where event_type <> 'error' and ts < date '2024-01-28'
                                or event_type <> 'error' and ts >= date '2024-01-29') as good_rows,
               count(*) filter (where event_type = 'error'
                                or cast(ts as date) = date '2024-01-28') as corrupt_rows
        from events group by cast(ts as date)""",
    "bronze_health": sql(
        """select 'visitors' as dataset, count(*) as "rows", cast(0 as bigint) as corrupt_rows,
                  count(*) as keyed_rows, cast(0 as bigint) as missing_media_id from events
           union all
           select 'metadata', count(*), cast(0 as bigint), count(*), cast(0 as bigint) from part
           union all
           select 'medias', count(*), cast(0 as bigint), count(*), cast(0 as bigint)
           from (select distinct media_id, dt from f)""",
        FACT,
    ),
    "dt_overwrite": sql(
        f"""select {FACT_COLUMNS}, (select count(*) from fd where load_count > 0) as written
            from fd where load_count > 0""",
        *FACT_DAYS,
    ),
    "append_mode": sql(
        f"select {FACT_COLUMNS} from fd union all select {FACT_COLUMNS} from fd", *FACT_DAYS
    ),
    "fact_by_event_date": sql(
        f"select {FACT_COLUMNS}, cast(event_date as varchar) as event_date from e",
        *FACT_DAYS, "\nf as (select * from fd)", MEDIA, DATED,
    ),
    "read_gold_merged": """
        select cast(user_id as varchar) as visitor_id,
               cast(cast(ts as date) as varchar) as event_date,
               cast(case when event_type = 'click' then floor(value) end as bigint) as watch_time
        from events""",
    "unique_visitors_approximate": sql(
        "select count(distinct visitor_id) as unique_visitors, true as near from f", FACT
    ),
    "media_in_list": sql(
        f"select {GOLD_MEDIA_COLUMNS} from mg where media_id in ('m1', 'm7', 'm77')",
        *BASE, MEDIA_GOLD,
    ),
    "media_in_long_list": sql(
        f"""select {GOLD_MEDIA_COLUMNS} from mg
            where cast(substr(media_id, 2) as integer) % 3 = 0""",
        *BASE, MEDIA_GOLD,
    ),
    "written_in_files": sql(f"select {FACT_COLUMNS}, true as few_files from fd", *FACT_DAYS),
    "kpi_job_mixed_naming": sql(
        """select media_id, cast(event_date as varchar) as event_date, total_plays, total_loads,
                  watch_time_sec from om""",
        OLD_MEDIA,
    ),
    "kpi_job_outputs": sql(
        """select 'media' as frame, media_id as name, sum(total_plays) as plays,
                  sum(watch_time_sec) as watch_time_sec
           from om where event_date between date '2024-01-01' and date '2024-12-31'
           group by media_id
           union all
           select 'day', cast(event_date as varchar), sum(total_plays), sum(watch_time_sec)
           from om where event_date between date '2024-01-01' and date '2024-12-31'
           group by event_date""",
        OLD_MEDIA,
    ),
    "gold_range_pruned": sql(
        f"select {GOLD_MEDIA_COLUMNS} from mg where {RANGE}", *BASE, MEDIA_GOLD
    ),
    "gold_views_sql": sql(
        f"""select cast(m.event_date as varchar) as event_date, media_title, plays, visitors
            from (select event_date, latest.title as media_title,
                         cast(sum(total_plays) as bigint) as plays
                  from mg left join latest on mg.media_id = latest.media_id where {RANGE}
                  group by event_date, latest.title) m
            join (select event_date, count(distinct visitor_id) as visitors
                  from vg where {RANGE} group by event_date) v
              on m.event_date = v.event_date""",
        *BASE, MEDIA_GOLD, VISITOR_GOLD,
    ),
    "bronze_to_gold_media": sql(f"select {GOLD_MEDIA_COLUMNS} from mg", *FROM_BRONZE, MEDIA_GOLD),
    "bronze_to_gold_visitor": sql(
        f"select {GOLD_VISITOR_COLUMNS} from vg", *FROM_BRONZE, VISITOR_GOLD
    ),
    "incremental_silver": sql(f"select {FACT_COLUMNS} from s", FEED_FACT),
}
ORACLE["read_gold_mixed_types"] = """
    select 'e' || cast(event_id as varchar) as visitor_id,
           cast(cast(ts as date) as varchar) as event_date,
           case when ts < date '2024-01-10' then floor(value)
                when ts < date '2024-01-20' then floor(value) / 2 end as watch_time,
           case when event_type = 'click' then '1' else '0' end as total_plays,
           cast(year(ts) as integer) as year
    from events"""
ORACLE["gold_cache"] = sql(
    f"""select {GOLD_MEDIA_COLUMNS},
               (select count(*) from mg where total_plays = 0) as kept_rows
        from mg""",
    *BASE, MEDIA_GOLD,
)
ORACLE["visitors_by_sketch"] = sql(
    """select 'week' as range, cast(cast(date_trunc('week', event_date) as date) as varchar) as of,
              count(distinct visitor_id) as exact, true as within_bound
       from e where event_date is not null group by all
       union all
       select 'selection', null, count(distinct visitor_id), true
       from e where media_id in ('m1', 'm7', 'm77')""",
    *BASE,
)
ORACLE["missing_days"] = sql(
    """, lacks as (
         select cast(d as date) as day, list_sort(list_filter([
                  case when day(d) in (9, 10, 11, 25) or t.dt is null then 'medias' end,
                  case when day(d) % 5 = 0 or day(d) = 9 or t.dt is null then 'visitors' end
                ], lambda x: x is not null)) as lacking
         from (select unnest(generate_series(min(dt), max(dt) + 2, interval 1 day)) as d from f) x
         left join (select distinct dt from f) t on t.dt = cast(d as date)),
       runs as (
         select *, day - cast(row_number() over (partition by lacking order by day) as integer) as run
         from lacks where len(lacking) > 0)
       select cast(min(day) as varchar) as first_day, cast(max(day) as varchar) as last_day,
              count(*) as days, array_to_string(lacking, ',') as lacking,
              len(lacking) < 2 as partial
       from runs group by lacking, run""",
    FACT,
)
ORACLE["bronze_root"] = sql(
    """select media_id, cast(dt as varchar) as dt,
              cast(count(*) filter (where event_type in ('view', 'click')) as varchar) as load_count,
              spelling
       from f, unnest(['', '/', '/raw', '/raw/']) as s(spelling)
       group by media_id, dt, spelling""",
    FACT,
)
ORACLE["refused_runs"] = """
    select 'no metadata' as case_name,
           'dim_media would be empty; check metadata, the day and the format' as refusal
    union all
    select 'no visitors',
           'dim_visitor and the fact would be empty; check visitors, the day and the format'
    union all
    select 'no media id', (select cast(count(*) as varchar) from events
                           where event_type in ('error', 'signup')) || ' visitor rows have no media id'
    union all
    select 'sound', null"""
ORACLE["schema_report_one_dataset"] = (
    f"select * from ({ORACLE['schema_report']}) where dataset = 'medias'"
)
ORACLE["compacted_gold"] = sql(
    f"select {GOLD_MEDIA_COLUMNS}, true as one_file_each from mg", *BASE, MEDIA_GOLD
)
ORACLE["schema_drift"] = sql(
    """, typed as (
         select 'visitor_key' as field, 'STRING' as expected, 'STRING' as found, dt, event_type from f
         union all
         select 'org', null, 'OBJECT<name: STRING, title: STRING>', dt, event_type from f
         union all
         select 'created_at', 'STRING', 'STRING', dt, event_type from f where event_type <> 'signup'
         union all
         select 'load_count', 'BIGINT', case when dt < date '2024-01-15' then 'STRING' else 'BIGINT' end,
                dt, event_type from f
         union all
         select 'play_count', 'BIGINT', null, dt, event_type from f),
       days as (
         select field, expected, dt, count(*) as n,
                coalesce(max(found),
                         case when bool_and(event_type = 'error') then 'STRING'
                              when bool_or(event_type = 'error') then 'VARIANT'
                              else 'BIGINT' end) as found
         from typed group by field, expected, dt),
       marked as (
         select *, case when found is distinct from lag(found) over (partition by field order by dt)
                        then 1 else 0 end as changed
         from days),
       runs as (select *, sum(changed) over (partition by field order by dt) as run from marked)
       select 'visitors' as dataset, field, expected, found, cast(min(dt) as varchar) as since,
              cast(max(dt) as varchar) as until, count(*) as days, cast(sum(n) as bigint) as rows
       from runs group by field, expected, found, run""",
    FACT,
)
ORACLE["running_increments"] = sql(
    f"""select media_id, visitor_id, load_count, play_count, last_event_key, {stamp('first_seen')},
               {stamp('last_active')}, cast(dt as varchar) as dt
        from f""",
    RUNNING, gained("running", "f", idle=True),
)
ORACLE["media_daily_increments"] = sql(
    f"select {GOLD_MEDIA_COLUMNS} from mg", *FROM_RUNNING, MEDIA_GOLD
)
ORACLE["visitor_daily_increments"] = sql(
    f"select {GOLD_VISITOR_COLUMNS} from vg", *FROM_RUNNING, VISITOR_GOLD
)
ORACLE["gold_refresh_latest_snapshot"] = sql(
    f"select {GOLD_MEDIA_COLUMNS} from mg", FEED_FACT, PER_DAY_LATEST.replace("fd", "s"), MEDIA,
    DATED, MEDIA_GOLD,
)
ORACLE["gold_refresh_increments"] = sql(
    f"select {GOLD_MEDIA_COLUMNS} from mg", FEED_FACT, gained("s", "f", idle=False), MEDIA, DATED,
    MEDIA_GOLD,
)
ORACLE["latest_media_merged"] = sql(
    f"""select {DIM_MEDIA_COLUMNS.replace("as dt", "as latest_dt")} from dim
        where dt < date '2024-01-02' or media_id not like '%7'
        qualify row_number() over (partition by media_id order by dt desc) = 1""",
    MEDIA,
)
ORACLE["media_in_empty"] = ORACLE["cached_gold"] = ORACLE["media_daily"]
ORACLE["gold_rerun_idempotent"] = ORACLE["media_daily"]
ORACLE["gold_refresh"] = ORACLE["bronze_to_gold_visitor"]
