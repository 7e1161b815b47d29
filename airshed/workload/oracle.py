"""The same queries in SQL over the same tables, written on their own for comparison.

Each statement names the derived inputs it needs as CTEs; doubles are rounded to six decimals and
dates printed as text, as ``registry.plain`` does.
"""

from __future__ import annotations

from airshed.config import (
    AQO_STATIONS,
    BBOX,
    CITIES,
    GEOMET_LOCATIONS,
    PROVINCE_SKETCH,
    WEATHER_STATIONS,
)


def _list(values) -> str:
    return "[" + ", ".join("null" if v is None else repr(v) for v in values) + "]"


def _values(rows) -> str:
    def one(v):
        if isinstance(v, float):
            return f"{v!r}::double"
        return repr(v)

    return ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)


def r6(x: str) -> str:
    return f"round({x}, 6) + 0e0"


def ds(x: str) -> str:
    return f"cast({x} as varchar)"


HAVERSINE = (
    "2e0 * 6371.0088e0 * asin(least(1e0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2e0), 2) + "
    "cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2e0), 2))))"
)


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return HAVERSINE.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2)


def _aqhi(day: str) -> str:
    return f"""
    select row_id, try_cast(date_txt as date) as date, time, trim(aqhi) as aqhi_raw,
      trim(aqhi) = '10+' as aqhi_is_10_plus,
      try_cast(replace(trim(aqhi), '+', '') as double) as aqhi_numeric,
      category, city, station_name, station_id, requested_year, value_type, show_day_code,
      date_txt, aqhi
    from (
      select event_id as row_id,
        case when event_id % 211 = 0 then 'not stated'
             else cast(date '2024-01-01' + cast(day as integer) as varchar) end as date_txt,
        case when event_id % 97 <> 0 then
          (case when is_max then cast(1 + event_id % 12 as varchar)
               || (case when event_id % 24 < 12 then ':00 am' else ':00 pm' end)
             else '4:00 pm' end) || (case when event_id % 3 = 0 then ' EDT' else ' EST' end) end as time,
        case when event_id % 53 <> 0 then
          case when event_id % 7 = 0 then ' ' || reading || ' ' else reading end end as aqhi,
        case when event_id % 53 <> 0 then
          case when lvl = 11 then 'very high risk' when lvl <= 3 then 'low risk'
               when lvl <= 6 then 'moderate risk' else 'high risk' end end as category,
        {_list([s[1] for s in AQO_STATIONS])}[user_id % 7 + 1] as city,
        {_list([s[2] for s in AQO_STATIONS])}[user_id % 7 + 1] as station_name,
        {_list([s[0] for s in AQO_STATIONS])}[user_id % 7 + 1] as station_id,
        case when event_id % 5 = 4 then 2025 else 2024 end as requested_year,
        case when is_max then 'daily_max' else 'daily_4pm' end as value_type,
        case when is_max then 2 else 0 end as show_day_code
      from (select *, case when lvl = 11 then '10+' else cast(lvl as varchar) end as reading
            from (select *, 1 + (day * 7 + day // 9 + (user_id % 7) * 3
                    + case when (day + user_id % 7) % 13 = 0 and event_id % 5 = 0 then 1 else 0 end
                    + case when is_max and day % 3 = 0 then 1 else 0 end) % 11 as lvl
                  from (select *, {day} as day, (event_id // 3) % 2 = 1 as is_max from events))))"""


VIEWS = {
    "hot": """
    select event_id as uid, ts as rep_date, cast(ts as date) as date,
      41e0 + ((event_id % 16500) * 7919 % 16500) / 1000e0 as lat,
      -96e0 + ((event_id % 22500) * 104729 % 22500) / 1000e0 as lon,
      event_type as sensor,
      case when event_id % 9 <> 0 then ['ON','MB','QC','MN'][event_id % 4 + 1] end as agency
    from events""",
    "obs": _aqhi("(event_id % 400) * 31 % 400"),
    "obs_sparse": _aqhi("(event_id % 400) * (event_id % 400) % 400"),
    "cur": """
    select *, case when row_id % 103 <> 0 then loc end as location_id,
      loc || '-' || cast(cast(snapshot_ts as date) as varchar) || '-' || cast(hour(snapshot_ts) as varchar) as id
    from (select ['FAFFD','FEVJR','FCWFX','FEUZB','FCWYG','FDQBU','FDQBX','XOTHR'][user_id % 8 + 1] as loc,
      'Location ' || cast(user_id % 8 as varchar) as location_name_en,
      date_trunc('hour', ts) as observation_datetime, ts as snapshot_ts, event_id as row_id,
      case when event_id % 61 <> 0 then cast(cast(floor(value) as bigint) % 12 + 1 as double) end as aqhi,
      41.5e0 + user_id % 8 as latitude, -95e0 + user_id % 8 as longitude
    from events)""",
    "wx": f"""
    select event_id as row_id,
      {_list([s[0] for s in WEATHER_STATIONS])}[user_id % 4 + 1] as station_id,
      case when event_id % 499 = 0 then 'RENAMED'
           else {_list([s[2] for s in WEATHER_STATIONS])}[user_id % 4 + 1] end as station_name,
      {_list([s[1] for s in WEATHER_STATIONS])}[user_id % 4 + 1] as city,
      date_trunc('hour', ts) as date_time_lst,
      case when event_id % 1009 = 0 then 99e0 when event_id % 17 <> 0
           then cast(event_id % 60 - 25 as double) end as temp,
      case when event_id % 1013 = 0 then 130e0 else cast(event_id % 101 as double) end as rh,
      case when event_id % 997 = 0 then -0.5e0 when event_id % 19 <> 0 then (event_id % 5) * 0.25e0 end as precip,
      case when event_id % 29 = 0 then 'M' end as precip_flag,
      case when event_id % 991 = 0 then 40e0 when event_id % 13 <> 0
           then cast(event_id % 37 as double) end as wind_dir_10s_deg,
      case when event_id % 31 <> 0 then cast(event_id % 25 as double) end as wind_speed,
      case when event_id % 29 = 1 then 'M' end as wind_flag,
      1 + user_id % 3 as priority
    from events""",
    "fire": """
    select o_orderkey as OBJECTID,
      case when o_orderkey % 301 <> 0 then 'F' || cast(o_orderkey as varchar) end as fire_id,
      case when o_orderkey % 307 = 0 then '' else 'ON' end as agency,
      ['EX','EX',' BM ','OC','BH','UC','ZZ',null][o_orderkey % 8 + 1] as stage,
      trim(['EX','EX',' BM ','OC','BH','UC','ZZ',null][o_orderkey % 8 + 1]) as stage_code,
      ['LTG','HUM','LTG',null][o_orderkey % 4 + 1] as acause,
      ['L','H','H','L','X'][o_orderkey % 5 + 1] as scause,
      ['FUL','MON','MNP','MOD','MDP','-1'][o_orderkey % 6 + 1] as response,
      case when o_orderkey % 53 <> 0 and o_orderkey % 109 <> 0 and o_orderkey % 113 <> 0 and o_orderkey % 127 <> 0
        then o_totalprice end as size,
      case when o_orderkey % 59 <> 0 then 41.5e0 + ((o_orderkey % 15500) * 7919 % 15500) / 1000e0 end as lat,
      case when o_orderkey % 59 <> 0 then -95.5e0 + ((o_orderkey % 21500) * 104729 % 21500) / 1000e0 end as lon,
      cast(o_orderdate as date) + to_milliseconds(o_orderkey % 86400000) as stamped
    from orders""",
    "hist": """
    select l_orderkey as fire_id, l_linenumber as snapshot_no, cast(l_shipdate as date) as status_date,
      l_partkey as part, l_suppkey as supp, l_quantity as size_hectares,
      ['EX','BM','OC','BH','UC'][l_partkey % 5 + 1] as stage, l_returnflag as response,
      l_extendedprice as price
    from lineitem""",
    "evac": """
    select *, try_cast(evacuation_start_date as date) as start_date,
      try_cast(evacuation_end_date as date) as end_date
    from (select o_orderkey as row_id,
      case when o_orderkey % 41 = 0 then 'EV-' || cast(o_orderkey as varchar)
           when o_orderkey % 43 = 0 then 'EVAC-' || lpad(cast(o_orderkey % 1000 as varchar), 3, '0')
           when o_orderkey < 1000 then 'EVAC-' || lpad(cast(o_orderkey as varchar), 3, '0')
           when o_orderkey % 101 <> 0 then 'EVAC-' || cast(o_orderkey as varchar) end as event_id,
      case when o_orderkey % 47 = 0 then upper('Community ' || cast(o_custkey % 50 as varchar))
           else 'Community ' || cast(o_custkey % 50 as varchar) end as community,
      ['Barrie','Kingston','Thunder Bay','Toronto','Not applicable','Ottawa'][o_orderkey % 6 + 1] as nearby_project_city,
      case when o_orderkey % 71 = 0 then 'not known'
           else cast(cast(o_orderdate as date) as varchar) end as evacuation_start_date,
      case when o_orderkey % 73 = 0 then 'Ongoing'
           when o_orderkey % 4 <> 0 then
             cast(cast(o_orderdate as date) + cast(o_orderkey % 9 - 1 as integer) as varchar) end as evacuation_end_date,
      case when o_orderkey % 103 = 0 then null when o_orderkey % 79 = 0 then 'Active'
           else ['Ongoing','Lifted','Unknown'][o_orderkey % 3 + 1] end as status,
      cast(o_orderdate as date) + cast(o_orderkey % 20 as integer) as status_as_of_date,
      'CBC News' as source_name,
      case when o_orderkey % 83 = 0 then 'https://news.aggregator.example/item/' || cast(o_orderkey as varchar)
           when o_orderkey % 89 <> 0 then 'https://www.cbc.ca/news/' || cast(o_orderkey as varchar) end as source_url
    from orders)""",
    "sta": """
    select case when s_suppkey % 31 = 30 then s_suppkey - 1 else s_suppkey end as station_id,
      case when s_suppkey % 29 <> 28 then 'S' || cast(s_suppkey - (s_suppkey % 17) % 2 as varchar) end as source_station_id,
      s_name as station_name, ['geomet','aqo','eccc_weather','aqo','other'][s_suppkey % 5 + 1] as source_system,
      1 + s_nationkey % 6 as city_id,
      case when s_suppkey % 23 = 7 then 95.5e0 else 42e0 + (s_suppkey % 140) / 10e0 end as latitude,
      case when s_suppkey % 37 = 9 then -190.25e0 else -95e0 + (s_suppkey % 200) / 10e0 end as longitude
    from supplier""",
    "place": """
    select case when s_suppkey % 41 <> 40 then s_suppkey - s_suppkey % 19 // 18 end as city_id,
      case when s_suppkey % 43 <> 42 then 'City ' || cast(s_suppkey - s_suppkey % 13 // 12 as varchar) end as city_name,
      case when s_suppkey % 47 <> 46 then case when s_suppkey % 23 = 7 then 95.5e0 else 42e0 + (s_suppkey % 140) / 10e0 end end as latitude,
      case when s_suppkey % 37 = 9 then -190.25e0 else -95e0 + (s_suppkey % 200) / 10e0 end as longitude
    from supplier""",
    "due": """
    select case when o_orderkey % 101 <> 100 then cast('2024-01-01' as date) + cast(o_orderkey - o_orderkey % 53 // 52 as integer) end as date_id from orders""",
    "cand": f"""
    select c_custkey as station_id, {_list([c[1] for c in CITIES])}[c_nationkey % 4 + 1] as city,
      case when c_custkey % 3 = 0 then 'daily' else 'hourly' end as interval_kind,
      case when c_custkey % 5 = 0 then 'NAVCAN' when c_custkey % 5 = 1 then 'ECCC-MSC' else 'CCN' end as operator,
      date '2023-01-01' + cast(c_custkey % 700 as integer) as first_date,
      date '2026-01-01' + cast(c_custkey % 400 as integer) as last_date,
      c_custkey % 7 <> 0 as has_wind, c_custkey % 11 <> 0 as has_precip,
      (c_custkey * 7919 % 5000) / 10e0 as distance_km,
      42 + c_custkey % 14 as lat_deg, c_custkey % 60 as lat_min,
      -95 + c_custkey % 20 as lon_deg, c_custkey * 7 % 60 as lon_min
    from customer""",
    "city": f"""
    select * from (values {_values(CITIES)}) as t(city_id, city_name, region, clat, clon)""",
    "days": """
    select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) as date_id
    from (select min(date) as lo, max(date) as hi from obs)""",
    "fire_days": """
    select distinct cast(ts as date) as date, dayofmonth(ts) % 7 <> 3 as ok from events""",
    "exposure": f"""
    select city_id, date,
      count(*) filter (where km <= 100) as hotspots_within_100km,
      count(*) filter (where km <= 250) as hotspots_within_250km,
      count(*) filter (where km <= 500) as hotspots_within_500km,
      min(km) as nearest_hotspot_distance_km
    from (select city_id, date, {km('h.lat', 'h.lon', 'c.clat', 'c.clon')} as km from hot h, city c)
    group by city_id, date""",
    "snap": """
    select * from (select *, row_number() over (partition by fire_id, snapshot_no order by status_date desc,
      part desc, supp desc, price desc, size_hectares desc, response desc) as rn from hist) where rn = 1""",
    "st_day": """
    select city, station_id, value_type, date, conflicting_times,
      case when value_type = 'daily_max' or lo_value = hi_value then hi_value end as value,
      case when (value_type = 'daily_max' or lo_value = hi_value) and hi_value is not null then coalesce(plus, false) end as is_10_plus
    from (
      select city, station_id, value_type, date,
        max(case when n_values = 1 then v end) as hi_value, min(case when n_values = 1 then v end) as lo_value,
        bool_or(case when n_values = 1 then p end) as plus,
        count(*) filter (where n_values > 1) as conflicting_times
      from (select city, station_id, value_type, date, time, count(distinct aqhi_raw) as n_values,
              max(aqhi_numeric) as v, bool_or(aqhi_is_10_plus) as p
            from obs where date is not null group by all)
      group by all)""",
    "city_day": """
    select city, value_type, date, avg(value) as aqhi, bool_or(is_10_plus) as any_10_plus, count(value) as station_count
    from st_day group by all""",
    "wx_vec": """
    select city, station_id, date_trunc('hour', date_time_lst) as date_time_lst, count(*) as landed, avg(temp) as temp, avg(rh) as rh,
      avg(precip) filter (where precip >= 0 and precip_flag is distinct from 'M') as precip,
      avg(wind_dir_10s_deg) as wind_dir_10s_deg, avg(wind_speed) as wind_speed,
      avg(-wind_speed * sin(radians(wind_dir_10s_deg * 10e0))) as u,
      avg(-wind_speed * cos(radians(wind_dir_10s_deg * 10e0))) as v
    from wx group by 1, 2, 3""",
    "wx_net": """
    select wx.* exclude (station_id), r.rank, case (user_id // 4) % 3 when 0 then wx.station_id when 1 then 900000 + wx.station_id
        else 800000 + user_id % 4 end as station_id
    from wx join (select event_id, user_id, case (user_id // 4) % 3 when 0 then 1 when 1 then 2 else 3 end as rank from events) r
      on r.event_id = wx.row_id""",
    "wx_station": """
    select city, station_id, rank, date_trunc('hour', date_time_lst) as date_time_lst, count(*) as landed, avg(temp) as temp, avg(rh) as rh,
      avg(precip) filter (where precip >= 0 and precip_flag is distinct from 'M') as precip,
      avg(wind_dir_10s_deg) as wind_dir_10s_deg, avg(wind_speed) as wind_speed,
      avg(-wind_speed * sin(radians(wind_dir_10s_deg * 10e0))) as u,
      avg(-wind_speed * cos(radians(wind_dir_10s_deg * 10e0))) as v
    from wx_net group by all""",
    "wx_long": """
    select city, station_id, rank, date_time_lst, field, value from wx_station
    unpivot (value for field in (temp, rh, precip, wind_dir_10s_deg, wind_speed, u, v))""",
    "wx_best": """
    select * from wx_long qualify row_number() over (partition by city, date_time_lst, field order by rank, station_id) = 1""",
    "wx_hour": """
    select city, date_time_lst, """
    + ", ".join(f"max(value) filter (where field = '{c}') as {c}" for c in ("temp", "rh", "precip", "wind_dir_10s_deg", "wind_speed", "u", "v"))
    + """ from (select distinct city, date_time_lst from wx_station) left join wx_best using (city, date_time_lst) group by 1, 2""",
    "wx_used": """
    select city, cast(date_time_lst as date) as date, string_agg(distinct cast(station_id as varchar), ',' order by cast(station_id as varchar))
      as fallback_stations, count(distinct date_time_lst) as fallback_hours from wx_best where rank > 1 group by 1, 2""",
    "wx_landed": """
    select city, cast(date_time_lst as date) as date, cast(sum(landed) - count(*) as bigint) as repeated_rows,
      count(*) filter (where rank = 3) as unranked_rows from wx_station group by 1, 2""",
    "wx_day": """
    select h.*, l.repeated_rows, coalesce(u.fallback_stations, '') as fallback_stations, coalesce(u.fallback_hours, 0) as fallback_hours, l.unranked_rows
    from (select city, cast(date_time_lst as date) as date,
      avg(temp) as temp_mean, min(temp) as temp_min, max(temp) as temp_max,
      avg(rh) as rh_mean, min(rh) as rh_min, max(rh) as rh_max,
      sum(precip) as precip_total, avg(wind_speed) as wind_speed_mean, max(wind_speed) as wind_speed_max,
      avg(u) as um, avg(v) as vm,
      case when sqrt(avg(u) * avg(u) + avg(v) * avg(v)) > 1e-6
           then ((degrees(atan2(-avg(u), -avg(v))) % 360) + 360) % 360 end as wind_dir_mean_deg,
      count(*) as hourly_rows,
      count(distinct case when temp is not null then hour(date_time_lst) end) as valid_hours,
      100e0 * sum(case when temp is null then 1 else 0 end) / count(*) as temp_missing_pct,
      100e0 * sum(case when rh is null then 1 else 0 end) / count(*) as rh_missing_pct,
      100e0 * sum(case when precip is null then 1 else 0 end) / count(*) as precip_missing_pct,
      100e0 * sum(case when wind_dir_10s_deg is null then 1 else 0 end) / count(*) as wind_dir_10s_deg_missing_pct,
      100e0 * sum(case when wind_speed is null then 1 else 0 end) / count(*) as wind_speed_missing_pct
    from wx_hour group by 1, 2) h join wx_landed l using (city, date) left join wx_used u using (city, date)""",
    "fact": """
    select g.city_id, g.date_id, a.a4 as aqhi_daily_4pm, a.am as aqhi_daily_max, a.plus as aqhi_any_10_plus,
      a.a4 is not null or a.am is not null as aqhi_data_available,
      case when f.date is not null then coalesce(x.hotspots_within_100km, 0) end as hotspots_within_100km,
      case when f.date is not null then coalesce(x.hotspots_within_250km, 0) end as hotspots_within_250km,
      case when f.date is not null then coalesce(x.hotspots_within_500km, 0) end as hotspots_within_500km,
      case when f.date is not null then x.nearest_hotspot_distance_km end as nearest_hotspot_distance_km,
      f.date is not null as fire_data_available,
      w.temp_mean, w.temp_min, w.temp_max, w.precip_total, w.wind_speed_mean, w.wind_dir_mean_deg,
      coalesce(w.valid_hours >= 18, false) as weather_data_available, w.fallback_stations as weather_fallback_stations
    from (select c.city_id, c.city_name, d.date_id from city c cross join days d) g
    left join fire_days f on f.date = g.date_id and f.ok
    left join (select city, date, max(case when value_type = 'daily_4pm' then aqhi end) as a4,
                 max(case when value_type = 'daily_max' then aqhi end) as am, bool_or(any_10_plus) as plus
               from city_day group by all) a on a.city = g.city_name and a.date = g.date_id
    left join exposure x on x.city_id = g.city_id and x.date = g.date_id
    left join wx_day w on w.city = g.city_name and w.date = g.date_id""",
    "panel": """
    select city_id, date_id, aqhi_daily_4pm as y, temp_mean from fact""",
    "naive": """
    select p.city_id, p.date_id, p.y, q.y as y_hat from panel p
    left join panel q on q.city_id = p.city_id and q.date_id = p.date_id - 1""",
    "ma": """
    select p.city_id, p.date_id, any_value(p.y) as y,
      case when count(q.y) >= 4 then avg(q.y) end as y_hat
    from panel p left join panel q on q.city_id = p.city_id and q.date_id between p.date_id - 7 and p.date_id - 1
    group by 1, 2""",
    "fc": """
    select 'persistence' as model, * from naive union all select 'moving_average' as model, * from ma""",
    "inside": f"""
    select h.uid, any_value(h.date) as date, any_value(h.rep_date) as rep_date, any_value(h.lat) as lat, any_value(h.lon) as lon
    from hot h, (values {_values([(float(a), float(b), float(c), float(d)) for ring in PROVINCE_SKETCH for (a, b), (c, d) in zip(ring, [*ring[1:], ring[0]])])}) as e(lat1, lon1, lat2, lon2)
    where (e.lat1 > h.lat) <> (e.lat2 > h.lat)
      and h.lon < e.lon1 + (h.lat - e.lat1) / (e.lat2 - e.lat1) * (e.lon2 - e.lon1)
    group by h.uid having count(*) % 2 = 1""",
    "boundary": """
    select station_id, station_name, requested_year, date, n from (
      select station_id, station_name, requested_year, date, count(*) as n
      from obs_sparse where value_type = 'daily_max' and date is not null group by all) d
    where n > 1 and year(date - 1) = requested_year and not exists (
      select 1 from obs_sparse o where o.value_type = 'daily_max' and o.station_id = d.station_id
        and o.station_name = d.station_name and o.requested_year = d.requested_year and o.date = d.date - 1)""",
    "known": """
    select *, coalesce(end_date, case when status = 'Ongoing' then greatest(status_as_of_date, start_date) end, start_date) as last_day
    from evac""",
    "months": """
    select city, station_id, cast(unnest(generate_series(cast(date_trunc('month', lo) as timestamp),
      cast(date_trunc('month', hi + interval 12 month) as timestamp), interval 1 month)) as date) as month_start
    from (select city, station_id, min(date_time_lst) as lo, max(date_time_lst) as hi from wx group by all)""",
    "manifest": """
    select *, lower(replace(city, ' ', '_')) || '_' || station_id || '_' || strftime(month_start, '%Y_%m') || '.csv' as file_name
    from months""",
    "landed": """
    select lower(replace(city, ' ', '_')) || '_' || station_id || '_' || strftime(date_time_lst, '%Y_%m') || '.csv' as file_name,
      case station_id when 30682 then 'skipped' when 31688 then 'failed' else 'new' end as outcome, count(*) as n_rows
    from wx group by 1, 2""",
}

NEEDS = {
    "days": ["obs"],
    "exposure": ["hot", "city"],
    "snap": ["hist"],
    "st_day": ["obs"],
    "city_day": ["st_day"],
    "wx_vec": ["wx"],
    "wx_net": ["wx"],
    "wx_station": ["wx_net"],
    "wx_long": ["wx_station"],
    "wx_best": ["wx_long"],
    "wx_hour": ["wx_station", "wx_best"],
    "wx_used": ["wx_best"],
    "wx_landed": ["wx_station"],
    "wx_day": ["wx_hour", "wx_used", "wx_landed"],
    "fact": ["city", "days", "fire_days", "city_day", "exposure", "wx_day"],
    "panel": ["fact"],
    "naive": ["panel"],
    "ma": ["panel"],
    "fc": ["naive", "ma"],
    "inside": ["hot"],
    "boundary": ["obs_sparse"],
    "known": ["evac"],
    "months": ["wx"],
    "manifest": ["months"],
    "landed": ["wx"],
}


def _with(names: list[str], body: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in ordered)
    return f"with {ctes}\n{body}" if ctes else body


OBS_KEYS = "station_id, value_type, requested_year"
FIELDS = "date, time, aqhi_raw, aqhi_numeric, category, station_id, requested_year, value_type"
OUT_FIELDS = (
    "cast(date as varchar) as date, time, aqhi_raw, aqhi_numeric, category, station_id, requested_year, value_type"
)
ACTIVE = "('OC','BH','UC','BM')"
CONFIRMED = (
    "case stage_code when 'OC' then 'Out of Control' when 'BH' then 'Being Held' "
    "when 'UC' then 'Under Control' when 'EX' then 'Out (Extinguished)' end"
)
PROVISIONAL = (
    "case stage_code when 'BM' then 'Being Monitored (provisional, unconfirmed code)' end"
)
MAPPING = (
    "case when stage_code = 'BM' then 'Provisional' when stage_code in ('OC','BH','UC','EX') "
    "then 'Confirmed' else 'Unmapped' end"
)
LIGHTNING = "coalesce(acause = 'LTG' and scause = 'L', false)"


def _sentinel(mod: int, name: str) -> str:
    return f"coalesce(OBJECTID % 23 <> 0 and (OBJECTID % {mod} = 0), false) as {name}_is_minus_one"


def _codes(view: str, pairs: list[tuple[str, str]]) -> str:
    return " union all ".join(
        f"select '{name}' as field_name, trim(coalesce({col}, '<MISSING>')) as code_value from {view}"
        for name, col in pairs
    )


FIRE_CODES = _codes(
    "fire",
    [
        ("FIELD_STAGE_OF_CONTROL_STATUS", "stage"),
        ("FIELD_AGENCY_FIRE_CAUSE", "acause"),
        ("FIELD_SYSTEM_FIRE_CAUSE", "scause"),
        ("FIELD_RESPONSE_TYPE", "response"),
        ("FIELD_AGENCY_CODE", "agency"),
    ],
)


def _rule(view: str, rule: str, when: str, entity: str, detail: str, severity: str = "error") -> str:
    return (
        f"select '{rule}' as rule_id, '{severity}' as severity, "
        f"coalesce(cast({entity} as varchar), '<NULL>') as entity_key, "
        f"coalesce(cast({detail} as varchar), '<NULL>') as detail from {view} where {when}"
    )


def _unique(view: str, rule: str, keys: list[str]) -> str:
    name = " || '/' || ".join(f"coalesce(cast({k} as varchar), '<NULL>')" for k in keys)
    return (
        f"select '{rule}' as rule_id, 'error' as severity, {name} as entity_key, "
        f"count(*) || ' rows' as detail from {view} group by {', '.join(keys)} having count(*) > 1"
    )


def _parent(view: str, rule: str, fk: str, parent: str, pk: str) -> str:
    return (
        f"select '{rule}' as rule_id, 'error' as severity, cast({fk} as varchar) as entity_key, "
        f"count(*) || ' rows without parent' as detail from {view} where {fk} is not null and {fk} not in "
        f"(select {pk} from {parent}) group by {fk}"
    )


def _spelling(view: str, rule: str, key: str, value: str) -> str:
    return (
        f"select '{rule}' as rule_id, 'warning' as severity, coalesce(cast({key} as varchar), '<NULL>') as entity_key, "
        f"min({value}) || ' <> ' || max({value}) as detail from {view} group by {key} having min({value}) < max({value})"
    )


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(f"({p})" for p in parts)


def _dim_rules() -> str:
    v = "sta"
    parts = [
        _rule(v, f"Q2_{c}", f"{c} is null", "station_id", f"'{c}'")
        for c in ["source_station_id", "station_name", "source_system", "city_id", "latitude", "longitude"]
    ]
    parts += [
        _rule(v, f"Q2_length_{c}", f"length({c}) > {n}", "station_id", f"length({c})")
        for c, n in [("source_station_id", 50), ("station_name", 150), ("source_system", 30)]
    ]
    parts += [
        _rule(v, "Q3_latitude", "latitude not between -90 and 90", "station_id", "latitude"),
        _rule(v, "Q3_longitude", "longitude not between -180 and 180", "station_id", "longitude"),
        _rule(v, "Q4_source_system", "source_system not in ('geomet','aqo','eccc_weather')", "station_id", "source_system"),
        _unique(v, "Q1_station_id", ["station_id"]),
        _unique(v, "Q1_source_station", ["source_system", "source_station_id"]),
        _parent(v, "Q5_city", "city_id", "city", "city_id"),
    ]
    return _union(parts)


def _city_date_rules() -> str:
    c = "place"
    parts = [_rule(c, f"Q2_city_{x}", f"{x} is null", "city_id", f"'{x}'") for x in ("city_id", "city_name", "latitude", "longitude")]
    parts += [
        _rule(c, "Q3_city_latitude", "latitude not between -90 and 90", "city_id", "latitude"),
        _rule(c, "Q3_city_longitude", "longitude not between -180 and 180", "city_id", "longitude"),
        _unique(c, "Q1_city_id", ["city_id"]),
        _unique(c, "Q1_city_name", ["city_name"]),
        _rule("due", "Q2_date_date_id", "date_id is null", "date_id", "'date_id'"),
        _unique("due", "Q1_date_id", ["date_id"]),
    ]
    return _union(parts)


def _weather_rules() -> str:
    limits = {"temp": (-60, 50), "rh": (0, 100), "wind_speed": (0, 200), "wind_dir_10s_deg": (0, 36)}
    parts = [
        _rule("wx", f"Q6_{c}", f"{c} not between {lo} and {hi}", "row_id", c) for c, (lo, hi) in limits.items()
    ]
    parts += [
        _rule("wx", "Q6_precip_negative", "precip < 0", "row_id", "precip"),
        _spelling("wx", "Q7_station_identity", "station_id", "station_name"),
    ]
    return _union(parts)


def _evac_rules() -> str:
    e, v = "event_id", "evac"
    return _union(
        [
            _rule(v, "Q8_id_format", "event_id is null or not regexp_full_match(event_id, 'EVAC-[0-9]{3,}')", e, e),
            _rule(v, "Q9_start_date", "start_date is null", e, "evacuation_start_date"),
            _rule(v, "Q9_end_date", "evacuation_end_date is not null and end_date is null", e, "evacuation_end_date"),
            _rule(v, "Q10_status", "status is null or status not in ('Ongoing','Lifted','Unknown')", e, "status"),
            _rule(
                v,
                "Q11_city",
                "nearby_project_city not in ('Barrie','Kingston','Thunder Bay','Toronto','Not applicable')",
                e,
                "nearby_project_city",
            ),
            _rule(v, "Q12_url_missing", "source_url is null", e, "source_name"),
            _rule(
                v, "Q12_url_host", "source_url not like 'https://www.cbc.ca/%' and source_url not like 'https://www.ctvnews.ca/%'", e, "source_url"
            ),
            _rule(v, "Q14_end_before_start", "end_date < start_date", e, "end_date"),
            _rule(v, "Q14_lifted_without_end", "status = 'Lifted' and evacuation_end_date is null", e, "status"),
            _rule(v, "Q14_ongoing_with_end", "status = 'Ongoing' and evacuation_end_date is not null", e, "end_date"),
            _rule(v, "Q15_outside_window", "start_date < date '1996-01-01' or start_date > date '2000-12-31'", e, "start_date"),
            _unique(v, "Q8_id_unique", ["event_id"]),
            _unique(v, "Q13_community_start", ["community", "evacuation_start_date"]),
            _spelling(v, "Q15_spelling", "lower(trim(community))", "community"),
        ]
    )


def _fact_rules() -> str:
    v = "broken"
    key = "cast(city_id as varchar) || '/' || cast(date_id as varchar)"
    parts = []
    bands = ["hotspots_within_100km", "hotspots_within_250km", "hotspots_within_500km"]
    for c in [*bands, "nearest_hotspot_distance_km"]:
        parts.append(_rule(v, f"Q17_{c}_without_source", f"not fire_data_available and {c} is not null", key, c))
    for c in bands:
        parts.append(_rule(v, f"Q17_{c}_unknown", f"fire_data_available and {c} is null", key, f"'{c}'"))
    air = "coalesce(aqhi_daily_4pm, aqhi_daily_max)"
    for c in ("temp_mean", "temp_min", "temp_max", "precip_total", "wind_speed_mean", "wind_dir_mean_deg"):
        parts.append(_rule(v, f"Q17_{c}_incomplete", f"not weather_data_available and {c} is not null", key, f"'{c}'", "warning"))
    parts += [
        _rule(v, "Q17_aqhi_without_source", f"not aqhi_data_available and {air} is not null", key, air),
        _rule(v, "Q17_aqhi_unknown", f"aqhi_data_available and {air} is null", key, "'aqhi'"),
        _rule(v, "Q17_weather_unknown", "weather_data_available and temp_mean is null", key, "'temp_mean'"),
        _unique(v, "Q16_city_day", ["city_id", "date_id"]),
        _parent(v, "Q16_city", "city_id", "city", "city_id"),
        _parent(v, "Q16_date", "date_id", "days", "date_id"),
        "select 'Q18_date_coverage' as rule_id, 'error' as severity, cast(c.city_id as varchar) as entity_key, "
        "(select count(*) from days) - count(*) || ' of ' || (select count(*) from days) as detail from city c cross join days d "
        "where not exists (select 1 from broken b where b.city_id = c.city_id and b.date_id = d.date_id) group by c.city_id",
    ]
    broken = """broken as (select * replace (
      case when dayofmonth(date_id) = 17 then null when dayofmonth(date_id) = 24 then 5 else hotspots_within_100km end as hotspots_within_100km,
      case when dayofmonth(date_id) = 11 then null else aqhi_daily_4pm end as aqhi_daily_4pm,
      case when dayofmonth(date_id) = 11 then null else aqhi_daily_max end as aqhi_daily_max,
      case when dayofyear(date_id) = 40 then city_id + 1 else city_id end as city_id) from fact where city_id <> 2 or dayofyear(date_id) > 5)"""
    return _with(["fact"], "").rstrip() + ",\n" + broken + "\n" + _union(parts)


def statements() -> dict[str, str]:
    s: dict[str, str] = {}

    def add(name: str, needs: list[str], body: str) -> None:
        s[name] = _with(needs, body)

    # sources
    add(
        "geojson_flatten",
        ["hot"],
        f"select uid, sensor, agency, case when uid % 13 <> 0 then {r6('lon')} end as longitude, "
        f"case when uid % 13 <> 0 then {r6('lat')} end as latitude from hot",
    )
    add(
        "geojson_open_flatten",
        ["hot"],
        f"select uid, sensor, agency, case when uid >= 20 then uid % 4 / 4 end as frp, "
        "case when uid % 2 = 0 then cast(uid % 7 as varchar) else 'x' || uid % 7 end as code, 'Point' as geometry_type, "
        f"{r6('lon')} as longitude, {r6('lat')} as latitude from hot",
    )
    add(
        "geojson_properties",
        ["hot"],
        """select 'agency' as property, 'text' as kinds, cast(count(agency) as bigint) as feature_count, false as kind_changes from hot
        union all select 'code', 'integer,text', count(*), true from hot
        union all select 'frp', 'number', count(*) filter (where uid >= 20), false from hot
        union all select 'sensor', 'text', count(sensor), false from hot
        union all select 'uid', 'integer', count(*), false from hot""",
    )
    add(
        "snapshot_lineage",
        ["hot"],
        "select uid, 'hot.' || uid as source_feature_id, case when uid % 13 <> 0 then 'Point' end as geometry_type, "
        "'2026-07-31 04:59:31' as snapshot_downloaded_at_utc, 'https://example.org/fires' as source_url from hot",
    )
    add(
        "paged_union_dedup",
        [],
        "select o_orderkey as objectid, o_totalprice as size, cast(o_orderdate as varchar) as o_orderdate, "
        "cast(case when o_totalprice between 200000 and 300000 then 2 else 1 end as bigint) as page_copies from orders",
    )
    page_rows = (
        "select cast(floor(row_id / 20e0) as bigint) as page_no, 1 as table_index, "
        "cast(row_number() over (partition by floor(row_id / 20e0) order by row_id) as integer) as row_index, "
        "date_txt as date, time, trim(aqhi) as aqhi, category, "
        "date_txt || ' | ' || coalesce(time, '') || ' | ' || coalesce(trim(aqhi), '') || ' | ' || coalesce(category, '') as row_text from obs"
    )
    add("html_table_rows", ["obs"], page_rows)
    add(
        "html_rows_on_dates",
        ["obs"],
        f"select page_no, row_index, row_text from ({page_rows}) where date in ('2024-01-30','2024-01-31','2024-02-01','2024-02-02')",
    )
    add(
        "html_links",
        [],
        r"""select page_id, cast(n - 1 as integer) as link_no,
          trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(a, '(?s)<[^>]*>', ' ', 'g'),
            '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) as link_text,
          regexp_extract(a, '(?is)^<a\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]*)', 1) as href
        from (select page_id, unnest(l) as a, generate_subscripts(l, 1) as n
              from (select page_id, regexp_extract_all(html, '(?is)<a\b[^>]*>.*?</a>') as l from pages))""",
    )
    add(
        "payload_validity",
        [],
        """select doc_id, contains(p, 'Date/Time') and length(p) - length(replace(p, chr(10), '')) > 1 as is_valid
        from (select doc_id, case when doc_id % 3 <> 0 then text || chr(10) || 'Date/Time' else text end as p from documents)""",
    )
    add(
        "union_by_name_context",
        ["hot", "wx"],
        """select 'hotspots' as source, cast(date as varchar) as date, count(*) as row_count, count(sensor) as with_sensor,
          cast(0 as bigint) as with_temp, cast(0 as bigint) as with_city from hot group by date
        union all select 'weather', cast(cast(date_time_lst as date) as varchar), count(*), 0, count(temp), count(city)
        from wx group by cast(date_time_lst as date)""",
    )
    add("manifest_grid", ["manifest"], "select city, station_id, cast(month_start as varchar) as month_start, file_name from manifest")
    add(
        "manifest_years",
        ["obs"],
        """select station_id, station_name, cast(y as integer) as requested_year, c as show_day_code,
          case c when 0 then 'daily_4pm' else 'daily_max' end as value_type
        from (select station_id, station_name, unnest(generate_series(min(requested_year), max(requested_year) + 1)) as y
              from obs group by station_id, station_name), (values (0), (2)) as m(c)""",
    )
    add(
        "manifest_outstanding",
        ["manifest", "landed"],
        "select file_name, city, station_id, cast(month_start as varchar) as month_start from manifest where file_name not in (select file_name from landed)",
    )
    add(
        "extraction_summary",
        ["manifest", "landed"],
        """select count(*) as expected_files, count(*) filter (where outcome = 'new') as new_files,
          count(*) filter (where outcome = 'skipped') as skipped_files, count(*) filter (where outcome = 'failed') as failed_files,
          count(*) filter (where outcome is null) as untried_files,
          cast(coalesce(sum(n_rows) filter (where outcome <> 'failed'), 0) as bigint) as total_rows
        from manifest left join landed using (file_name)""",
    )

    # projections
    add(
        "name_normalise",
        [],
        "select p_partkey, trim(regexp_replace(lower(trim(' ' || p_name || ' (' || p_brand || ')')), '[^a-z0-9]+', '_', 'g'), '_') as column_name from part",
    )
    add("drop_all_null_column", ["obs"], "select row_id, aqhi from obs")
    box = f"lat >= {BBOX['min_lat']}e0 and lat <= {BBOX['max_lat']}e0 and lon >= {BBOX['min_lon']}e0 and lon <= {BBOX['max_lon']}e0"
    add(
        "bbox_time_filter",
        ["hot"],
        f"select uid, cast(rep_date as varchar) as rep_date, {r6('lat')} as lat, {r6('lon')} as lon from hot "
        f"where rep_date >= timestamp '2024-01-05 00:00:00' and rep_date <= timestamp '2024-01-20 23:59:59' and {box}",
    )
    add(
        "allowlist_city_map",
        ["cur"],
        f"select c.location_id, row_id, cast(observation_datetime as varchar) as observation_datetime, aqhi, m.city "
        f"from cur c join (values {_values(GEOMET_LOCATIONS)}) as m(location_id, city) on c.location_id = m.location_id",
    )
    add(
        "current_feed_capped",
        ["cur"],
        "select row_id, aqhi, aqhi > 10 as aqhi_is_10_plus, case when aqhi > 10 then 10e0 else aqhi end as aqhi_numeric from cur",
    )
    add(
        "station_mode_filter",
        ["obs"],
        "select row_id, requested_year, cast(date as varchar) as date, time, aqhi_raw from obs where station_id = 63200 "
        "and station_name = 'Thunder Bay' and value_type = 'daily_4pm' and requested_year in (2024, 2025)",
    )
    add(
        "year_mismatch",
        ["obs"],
        "select row_id, station_name, requested_year, value_type, cast(date as varchar) as date, time, cast(year(date) as integer) as actual_year "
        "from obs where date is not null and year(date) <> requested_year",
    )
    add("censored_aqhi", ["obs"], "select row_id, aqhi_raw, aqhi_is_10_plus, aqhi_numeric from obs")
    add(
        "missing_and_capped_rows",
        ["obs"],
        "select row_id, cast(date as varchar) as date, time, aqhi_raw, category, station_name, value_type, "
        "case when aqhi_raw is null then 'missing' else '10+' end as reason from obs where aqhi_raw is null or aqhi_is_10_plus",
    )
    add(
        "clock_text_utc",
        ["obs"],
        """select row_id, cast(strptime(cast(date as varchar) || ' ' || upper(left(time, length(time) - 4)), '%Y-%m-%d %I:%M %p')
          + case right(time, 3) when 'EDT' then interval 4 hour else interval 5 hour end as varchar) as observed_utc from obs""",
    )
    add(
        "fires_cleaned",
        ["fire"],
        f"""select OBJECTID, fire_id, agency as agency_code, stage_code as stage_of_control_code, acause as agency_fire_cause_code,
          scause as system_fire_cause_code, response as response_type_code, {r6('size')} as fire_size_hectares,
          {r6('lat')} as latitude, {r6('lon')} as longitude,
          case when OBJECTID % 41 <> 0 then cast(stamped as varchar) end as situation_report_datetime_utc,
          case when OBJECTID % 37 <> 0 then cast(stamped as varchar) end as status_datetime_utc,
          cast(stamped as varchar) as refreshed_datetime_utc from fire""",
    )
    add(
        "stage_labels",
        ["fire"],
        f"select OBJECTID, {CONFIRMED} as stage_of_control_label, {PROVISIONAL} as stage_of_control_label_provisional, "
        f"{MAPPING} as stage_of_control_mapping_status, coalesce({CONFIRMED}, {PROVISIONAL}, 'Unmapped') as stage_of_control_display_label from fire",
    )
    add(
        "active_fires",
        ["fire"],
        f"select OBJECTID, stage_code as stage_of_control_code, {r6('size')} as fire_size_hectares from fire where stage_code in {ACTIVE}",
    )
    add(
        "response_labels",
        ["fire"],
        "select OBJECTID, response as response_type_code, case response when 'FUL' then 'Full Response' when 'MOD' then 'Modified Response' "
        "when 'MON' then 'Monitored Response' else 'Unmapped' end as response_type_label from fire",
    )
    add(
        "cause_interpretation",
        ["fire"],
        f"select OBJECTID, case when {LIGHTNING} then 'Lightning' else 'Unmapped' end as cause_interpretation_provisional, "
        f"case when {LIGHTNING} then 'High-confidence provisional' else 'Requires review' end as cause_mapping_status from fire",
    )
    add(
        "sentinel_flags",
        ["fire"],
        "select OBJECTID, "
        + ", ".join(
            [
                _sentinel(5, "FIELD_LOCATION"),
                _sentinel(7, "FIELD_PERCENT_CONTAINED"),
                _sentinel(11, "FIELD_SEVERITY_NEAREST_DSR"),
                _sentinel(13, "FIELD_AGENCY_PREPARE_LEVEL"),
                _sentinel(17, "FIELD_FIRE_TYPE_ICS"),
            ]
        )
        + " from fire",
    )
    add(
        "wind_missing_class",
        ["wx"],
        "select row_id, case when wind_flag = 'M' then 'flagged' when wind_dir_10s_deg is not null then 'observed' "
        "when wind_speed = 0 then 'calm' when wind_speed > 0 then 'missing' else 'unknown' end as wind_class from wx",
    )
    add(
        "precip_class",
        ["wx"],
        "select row_id, case when precip_flag = 'M' then 'flagged' when precip is null then 'blank' when precip < 0 then 'invalid_negative' "
        "when precip = 0 then 'zero' else 'positive' end as precip_class from wx",
    )
    add(
        "lst_to_utc",
        ["wx"],
        """select row_id, cast(date_time_lst as varchar) as date_time_lst, cast(utc as varchar) as date_time_utc,
          cast(cast((utc at time zone 'UTC') at time zone 'America/Toronto' as date) as varchar) as civil_date
        from (select *, date_time_lst + case when city = 'Thunder Bay' then interval 6 hour else interval 5 hour end as utc from wx)""",
    )
    add(
        "station_coordinates",
        ["cand"],
        f"select station_id, {r6('lat_deg + lat_min / 60e0')} as latitude, {r6('lon_deg - lon_min / 60e0')} as longitude from cand",
    )

    # joins
    dup = (
        f"select {OBS_KEYS}, date, count(*) as record_count, count(distinct time) as distinct_times, "
        f"count(distinct aqhi_raw) as distinct_aqhi_values, count(distinct category) as distinct_categories "
        f"from obs where date is not null group by all having count(*) > 1"
    )
    add(
        "duplicate_date_rows",
        ["obs"],
        f"select o.row_id, o.station_id, o.value_type, o.requested_year, cast(o.date as varchar) as date, o.time, "
        f"d.record_count, d.distinct_times, d.distinct_aqhi_values from obs o join ({dup}) d "
        f"using ({OBS_KEYS}, date)",
    )
    add(
        "largest_with_ties",
        ["fire"],
        f"select fire_id, {r6('size')} as fire_size_hectares, stage_code as stage_of_control_code, {r6('lat')} as latitude, "
        f"{r6('lon')} as longitude from fire where size = (select max(size) from fire)",
    )
    expected = f"(values {_values([(k,) for k, _ in GEOMET_LOCATIONS])}) as w(location_id)"
    add(
        "expected_vs_returned",
        ["cur"],
        f"select location_id, 'missing' as side from {expected} where location_id not in (select location_id from cur where location_id is not null) "
        f"union all select distinct location_id, 'unexpected' from cur where location_id not in (select location_id from {expected})",
    )
    register = sorted(
        [("aqo", str(i), c) for i, c, _ in AQO_STATIONS]
        + [("geomet", i, c) for i, c in GEOMET_LOCATIONS]
        + [("eccc_weather", str(i), c) for i, c, _, _ in WEATHER_STATIONS]
    )
    ids = {c[1]: c[0] for c in CITIES}
    rows = [(n, sid, ids[c]) for n, (sys, sid, c) in enumerate(register, 1) if sys == "eccc_weather"]
    add(
        "station_city_lookup",
        ["wx"],
        f"select r.sid as source_station_id, r.n as warehouse_station_id, r.city_id, count(*) as row_count from wx "
        f"left join (values {_values(rows)}) as r(n, sid, city_id) on r.sid = cast(wx.station_id as varchar) group by all",
    )
    add(
        "dim_date",
        ["days"],
        "select cast(date_id as varchar) as date_id, cast(year(date_id) as integer) as year, cast(month(date_id) as integer) as month, "
        "cast(isodow(date_id) as integer) as day_of_week, cast(null as boolean) as is_fire_season from days",
    )
    add("city_day_grid", ["city", "days"], "select city_id, cast(date_id as varchar) as date_id from city, days")
    fact_cols = ", ".join(
        [
            "city_id",
            "cast(date_id as varchar) as date_id",
            f"{r6('aqhi_daily_4pm')} as aqhi_daily_4pm",
            f"{r6('aqhi_daily_max')} as aqhi_daily_max",
            "aqhi_any_10_plus, aqhi_data_available, hotspots_within_100km, hotspots_within_250km, hotspots_within_500km",
            f"{r6('nearest_hotspot_distance_km')} as nearest_hotspot_distance_km",
            "fire_data_available",
            *[f"{r6(c)} as {c}" for c in ("temp_mean", "temp_min", "temp_max", "precip_total", "wind_speed_mean", "wind_dir_mean_deg")],
            "weather_data_available",
            "weather_fallback_stations",
        ]
    )
    add("fact_city_daily", ["fact"], f"select {fact_cols} from fact")
    add(
        "hotspot_city_exposure",
        ["exposure"],
        f"select city_id, cast(date as varchar) as date, hotspots_within_100km, hotspots_within_250km, hotspots_within_500km, "
        f"{r6('nearest_hotspot_distance_km')} as nearest_hotspot_distance_km from exposure",
    )
    add(
        "hotspot_site_exposure",
        ["hot", "sta"],
        f"""select station_id, cast(date as varchar) as date, count(*) filter (where km <= 100) as hotspots_within_100km,
          count(*) filter (where km <= 250) as hotspots_within_250km, count(*) filter (where km <= 500) as hotspots_within_500km,
          {r6('min(km)')} as nearest_hotspot_distance_km
        from (select station_id, date, {km('h.lat', 'h.lon', 'p.slat', 'p.slon')} as km from hot h,
          (select station_id, min(latitude) as slat, min(longitude) as slon from sta
           where latitude between -90 and 90 and longitude between -180 and 180 group by station_id) p)
        group by station_id, date""",
    )
    add("point_in_polygon", ["inside"], f"select uid, {r6('lat')} as lat, {r6('lon')} as lon from inside")
    add(
        "province_daily_totals",
        ["inside"],
        "select cast(date as varchar) as date, count(*) as total_hotspots, "
        "count(*) filter (where lat >= 48 and lon <= -85) as northwest_hotspots from inside group by date",
    )
    add(
        "earliest_province_hotspot",
        ["inside"],
        "select cast(min(rep_date) as varchar) as earliest_hotspot, count(*) as hotspots_inside from inside",
    )
    add(
        "fk_orphans",
        [],
        "select l_orderkey + l_linenumber * 100 as fire_id, count(*) as row_count from lineitem "
        "where l_orderkey + l_linenumber * 100 not in (select o_orderkey from orders) group by 1",
    )
    add(
        "latest_state",
        ["hist"],
        """select fire_id, snapshot_no, cast(status_date as varchar) as status_date, part, stage, size_hectares from (
          select *, row_number() over (partition by fire_id order by snapshot_no desc, status_date desc, part desc, stage desc, size_hectares desc) as rn
          from hist) where rn = 1""",
    )
    add(
        "state_as_of",
        ["hist"],
        """select a.fire_id, cast(a.asked_on as varchar) as asked_on, s.stage, s.size_hectares
        from (select o_orderkey as fire_id, cast(o_orderdate as date) + cast(o_orderkey % 120 as integer) as asked_on from orders) a
        asof left join (select fire_id, status_date, stage, size_hectares from hist
          qualify row_number() over (partition by fire_id, status_date order by stage desc, size_hectares desc) = 1) s
        on a.fire_id = s.fire_id and a.asked_on >= s.status_date""",
    )
    number = {"uid": "cast(uid as double)", "date": "epoch(cast(date as timestamp))", "agency": "cast(null as double)", "lat": "lat"}
    add(
        "merged_profile",
        ["hot"],
        " union all ".join(
            f"select '{c}' as column_name, count(*) as row_count, count(*) filter (where {c} is null) as null_count, {r6(f'min({x})')} as low, "
            f"{r6(f'max({x})')} as high, count(distinct {c}) as exact_count, true as distinct_within_3_pct from hot"
            for c, x in number.items()
        ),
    )
    add(
        "snapshot_diff",
        ["snap"],
        """select fire_id, snapshot_no, change, case when change = 'changed' then fields end as changed_fields from (
          select coalesce(n.fire_id, b.fire_id) as fire_id, coalesce(n.snapshot_no, b.next_no) as snapshot_no,
            case when b.fire_id is null then 'new' when n.fire_id is null then 'gone'
                 when n.stage is distinct from b.stage or n.response is distinct from b.response
                   or n.size_hectares is distinct from b.size_hectares then 'changed' end as change,
            array_to_string(list_filter([
              case when n.stage is distinct from b.stage then 'stage' end,
              case when n.response is distinct from b.response then 'response' end,
              case when n.size_hectares is distinct from b.size_hectares then 'size_hectares' end], lambda x: x is not null), ',') as fields
          from (select * from snap where snapshot_no > (select min(snapshot_no) from snap)) n
          full outer join (select *, snapshot_no + 1 as next_no from snap where snapshot_no < (select max(snapshot_no) from snap)) b
            on n.fire_id = b.fire_id and n.snapshot_no = b.next_no) where change is not null""",
    )
    add(
        "unknown_codes",
        ["fire"],
        f"""select field_name, code_value, count(*) as record_count from ({FIRE_CODES})
        where (field_name = 'FIELD_STAGE_OF_CONTROL_STATUS' and code_value not in ('OC','BH','UC','EX','BM','<MISSING>'))
           or (field_name = 'FIELD_SYSTEM_FIRE_CAUSE' and code_value not in ('H','N','U','<MISSING>')) group by all""",
    )
    add(
        "provisional_codes_seen",
        ["fire"],
        "select 'FIELD_STAGE_OF_CONTROL_STATUS' as field_name, stage_code as code_value, count(*) as record_count from fire "
        "where stage_code = 'BM' group by all",
    )
    add(
        "evac_overlap_days",
        ["known"],
        """select nearby_project_city, cast(d as varchar) as date, count(*) as open_events from (
          select nearby_project_city, cast(unnest(generate_series(cast(start_date as timestamp), cast(last_day as timestamp), interval 1 day)) as date) as d
          from known where last_day >= start_date) group by nearby_project_city, d""",
    )
    add(
        "evac_annotations",
        ["known"],
        """select nearby_project_city, cast(d as varchar) as date, event_id, community, status from (
          select *, cast(unnest(generate_series(cast(start_date as timestamp), cast(last_day as timestamp), interval 1 day)) as date) as d
          from known where last_day >= start_date) where d <= (select max(start_date) from evac)""",
    )
    add(
        "evac_episodes",
        ["known"],
        """select community, cast(episode_no as bigint) as episode_no, cast(min(start_date) as varchar) as episode_start,
          cast(max(last_day) as varchar) as episode_end, count(*) as event_count
        from (select *, sum(is_new) over (partition by community order by start_date, row_id rows unbounded preceding) as episode_no
          from (select *, case when start_date <= max(last_day) over (partition by community order by start_date, row_id
                  rows between unbounded preceding and 1 preceding) + 1 then 0 else 1 end as is_new
            from known where last_day >= start_date))
        group by community, episode_no""",
    )
    add(
        "evac_fact",
        ["evac", "city"],
        "select event_id, city_id, community as location_name, cast(start_date as varchar) as start_date, cast(end_date as varchar) as end_date, "
        "status, source_url as source, cast(status_as_of_date as varchar) as last_verified_date "
        "from (select * from evac where event_id is not null qualify row_number() over (partition by event_id "
        "order by status_as_of_date desc nulls last, row_id desc) = 1) left join city on city_name = nearby_project_city",
    )
    best = (
        "first({c} order by priority, row_id) filter (where {c} is not null) as {c}, "
        "first(station_id order by priority, row_id) filter (where {c} is not null) as {c}_station"
    )
    add(
        "fallback_station",
        ["wx"],
        f"select city, cast(date_time_lst as varchar) as date_time_lst, {best.format(c='temp')}, {best.format(c='precip')} from wx group by city, wx.date_time_lst",
    )

    # aggregates
    add(
        "records_by_location",
        ["cur"],
        "select location_id, location_name_en, count(*) as record_count from cur where location_id is not null group by all",
    )
    add(
        "rows_by_station_year_type",
        ["obs"],
        "select city, station_name, station_id, requested_year, value_type, count(*) as row_count from obs group by all",
    )
    add(
        "unique_dates",
        ["obs"],
        "select station_name, requested_year, value_type, count(distinct date) as unique_date_count from obs group by all",
    )
    add(
        "year_summary",
        ["obs"],
        f"select {OBS_KEYS}, count(*) as row_count, count(distinct date) as unique_date_count, count(distinct time) as unique_time_count, "
        f"cast(min(date) as varchar) as earliest_date, cast(max(date) as varchar) as latest_date, count(*) - count(distinct date) as extra_rows "
        f"from obs group by {OBS_KEYS}",
    )
    add("duplicate_dates", ["obs"], f"select * replace (cast(date as varchar) as date) from ({dup})")
    add("time_summary", ["obs"], f"select {OBS_KEYS}, time, count(*) as row_count from obs group by all")
    add(
        "exact_duplicate_rows",
        ["obs"],
        f"select row_id, {OUT_FIELDS}, copies from (select *, count(*) over (partition by {FIELDS}) as copies from obs) where copies > 1",
    )
    add(
        "datetime_conflicts",
        ["obs"],
        f"select {OBS_KEYS}, cast(d as varchar) as date, time, n as record_count, v as distinct_aqhi_values, c as distinct_categories from ("
        f"select {OBS_KEYS}, date as d, time, count(*) as n, count(distinct aqhi_raw) as v, count(distinct category) as c from obs group by all) "
        "where n > 1 and v > 1",
    )
    add(
        "conflict_values",
        ["obs"],
        f"""select {OBS_KEYS}, cast(date as varchar) as date, time, aqhi_raw, n as record_count from (
          select *, count(aqhi_raw) over (partition by {OBS_KEYS}, date, time) as vals from (
            select {OBS_KEYS}, date, time, aqhi_raw, count(*) as n from obs group by all)) where vals > 1""",
    )
    add(
        "redundant_copies",
        ["obs"],
        f"""select 'station/date/type' as key, (select count(*) from obs) - (select count(*) from (select distinct station_id, value_type, date from obs)) as redundant_copies
        union all select 'all source fields', (select count(*) from obs) - (select count(*) from (select distinct {FIELDS} from obs))
        union all select 'row_id', (select count(*) from obs) - (select count(distinct row_id) from obs)""",
    )
    null_cols = [
        "row_id", "date", "time", "aqhi", "category", "city", "station_name", "station_id", "requested_year",
        "value_type", "show_day_code", "aqhi_raw", "aqhi_is_10_plus", "aqhi_numeric",
    ]
    add(
        "null_profile",
        ["obs"],
        " union all ".join(f"select '{c}' as column_name, count(*) - count({c}) as null_count from obs" for c in null_cols),
    )
    add(
        "coverage",
        ["hot"],
        f"select count(*) as row_count, cast(min(rep_date) as varchar) as min_rep_date, cast(max(rep_date) as varchar) as max_rep_date, "
        f"{r6('min(lat)')} as min_lat, {r6('max(lat)')} as max_lat, {r6('min(lon)')} as min_lon, {r6('max(lon)')} as max_lon, "
        "count(distinct uid) as distinct_uid, count(distinct date) as distinct_date, count(distinct agency) as distinct_agency from hot",
    )
    add("code_frequency", ["fire"], f"select field_name, code_value, count(*) as record_count from ({FIRE_CODES}) group by all")
    add(
        "flag_frequency",
        ["wx"],
        """select city, field_name, flag_value, count(*) as record_count from (
          select city, 'precip_flag' as field_name, coalesce(precip_flag, '<MISSING>') as flag_value from wx
          union all select city, 'wind_flag', coalesce(wind_flag, '<MISSING>') from wx) group by all""",
    )
    checks = {
        "total_records": "count(*)",
        "missing_fire_ids": "count(*) - count(fire_id)",
        "missing_latitude": "count(*) - count(lat)",
        "missing_longitude": "count(*) - count(lon)",
        "missing_fire_size": "count(*) - count(size)",
        "minimum_fire_size_hectares": "min(size)",
        "maximum_fire_size_hectares": "max(size)",
        "confirmed_stage_records": f"count(*) filter (where {MAPPING} = 'Confirmed')",
        "provisional_stage_records": f"count(*) filter (where {MAPPING} = 'Provisional')",
        "unmapped_stage_records": f"count(*) filter (where {MAPPING} = 'Unmapped')",
        "cause_codes_requiring_review": f"count(*) filter (where not {LIGHTNING})",
        "duplicate_objectids": "count(*) - count(distinct OBJECTID)",
    }
    add(
        "validation_report",
        ["fire"],
        " union all ".join(f"select '{k}' as check_name, cast({v} as double) as value from fire" for k, v in checks.items()),
    )
    add(
        "snapshot_append",
        ["obs"],
        """select row_id, cast(o.date as varchar) as date, 1 as load from obs o left join (
          select station_id, value_type, requested_year, min(date) as lo, max(date) as hi from obs
          where row_id % 3 = 0 and dayofyear(date) between 100 and 160 and station_id % 2 = 1 group by all) s
          using (station_id, value_type, requested_year)
        where lo is null or date is null or date not between lo and hi
        union all select row_id, cast(date as varchar), 2 from obs
        where row_id % 3 = 0 and dayofyear(date) between 100 and 160 and station_id % 2 = 1""",
    )
    add(
        "rows_per_city_month",
        ["wx"],
        "select city, cast(year(date_time_lst) as integer) as year, cast(month(date_time_lst) as integer) as month, count(*) as row_count from wx group by 1, 2, 3",
    )
    add("distinct_locations", ["cur"], "select distinct location_id, location_name_en, longitude, latitude from cur")
    wx_cols = [
        "temp_mean", "temp_min", "temp_max", "rh_mean", "rh_min", "rh_max", "precip_total", "wind_speed_mean", "wind_speed_max",
        "temp_missing_pct", "rh_missing_pct", "precip_missing_pct", "wind_dir_10s_deg_missing_pct", "wind_speed_missing_pct",
    ]
    add(
        "weather_daily",
        ["wx_day"],
        "select city, cast(date as varchar) as date, "
        + ", ".join(f"{r6(c)} as {c}" for c in wx_cols)
        + ", hourly_rows, repeated_rows, cast(valid_hours as integer) as valid_hours, valid_hours >= 18 as weather_data_available, "
        "fallback_stations, fallback_hours, unranked_rows from wx_day",
    )
    add(
        "wind_vector_daily",
        ["wx_vec"],
        f"""select station_id, cast(date as varchar) as date, {r6('u')} as wind_u_mean, {r6('v')} as wind_v_mean,
          case when sqrt(u * u + v * v) > 1e-6 then {r6('((degrees(atan2(-u, -v)) % 360) + 360) % 360')} end as wind_dir_mean_deg
        from (select station_id, cast(date_time_lst as date) as date, avg(u) as u, avg(v) as v from wx_vec group by 1, 2)""",
    )
    add(
        "expected_hours",
        ["wx"],
        """select station_id, cast(m as varchar) as month_start, observed as observed_hours,
          cast(dayofmonth(last_day(m)) * 24 as integer) as expected_hours, dayofmonth(last_day(m)) * 24 - observed as missing_hours
        from (select station_id, cast(date_trunc('month', date_time_lst) as date) as m, count(distinct date_time_lst) as observed from wx group by 1, 2)""",
    )
    add(
        "missing_pct",
        ["wx"],
        " union all ".join(
            f"select city, cast(year(date_time_lst) as integer) as year, '{c}' as field_name, "
            f"{r6(f'100e0 * (count(*) - count({c})) / count(*)')} as missing_pct from wx group by 1, 2"
            for c in ("temp", "rh", "precip", "wind_dir_10s_deg", "wind_speed")
        ),
    )
    add(
        "city_aqhi_daily",
        ["city_day"],
        f"select city, value_type, cast(date as varchar) as date, {r6('aqhi')} as aqhi, any_10_plus, station_count from city_day",
    )
    add(
        "city_aqhi_daily_max_rule",
        ["st_day"],
        "select city, value_type, cast(date as varchar) as date, max(value) as aqhi, bool_or(is_10_plus) as any_10_plus, "
        "count(value) as station_count from st_day group by city, value_type, st_day.date",
    )
    add(
        "station_spread",
        ["st_day"],
        f"""select city, value_type, count(*) as days, {r6('avg(sp)')} as mean_spread, {r6('max(sp)')} as max_spread, {r6('avg(sd)')} as mean_sd
        from (select city, value_type, date, count(value) as n, max(value) - min(value) as sp, stddev_samp(value) as sd
              from st_day group by all) where n > 1 group by all""",
    )
    add(
        "aqhi_mode_comparison",
        ["st_day"],
        f"""select city, station_id, count(*) as paired_days, {r6('avg(b - a)')} as mean_difference,
          {r6('avg(case when a = b then 1e0 else 0e0 end)')} as share_equal, {r6('corr(a, b)')} as correlation
        from (select city, station_id, date, max(case when value_type = 'daily_4pm' then value end) as a,
                max(case when value_type = 'daily_max' then value end) as b from st_day group by all)
        where a is not null and b is not null group by all""",
    )
    add(
        "aqhi_daily_from_hourly",
        ["cur"],
        """select location_name_en, cast(d as varchar) as date, max(aqhi) as aqhi_daily_max,
          case when count(distinct case when h = 16 then aqhi end) = 1 then max(case when h = 16 then aqhi end) end as aqhi_daily_4pm,
          count(aqhi) as valid_readings
        from (select location_name_en, aqhi, hour(l) as h, cast(l as date) as d from (
          select *, (observation_datetime at time zone 'UTC') at time zone 'America/Toronto' as l from cur)) group by location_name_en, d""",
    )
    add(
        "distribution",
        ["obs"],
        "select station_id, value_type, count(*) as values, min(aqhi_numeric) as lowest, "
        + ", ".join(
            f"{r6(f'quantile_cont(aqhi_numeric, {p})')} as {n}"
            for p, n in ((0.25, "lower_quartile"), (0.5, "median"), (0.75, "upper_quartile"))
        )
        + ", max(aqhi_numeric) as highest from obs where aqhi_numeric is not null group by station_id, value_type",
    )
    add(
        "completeness",
        ["obs"],
        f"""select station_id, requested_year, value_type, days as days_with_value,
          cast(case requested_year when 2024 then 366 else 365 end as integer) as expected_days,
          {r6('days / (case requested_year when 2024 then 366e0 else 365e0 end)')} as completeness
        from (select station_id, requested_year, value_type, count(distinct date) as days from obs
              where aqhi_raw is not null and year(date) = requested_year group by all)""",
    )
    add(
        "source_freshness",
        ["hot", "wx"],
        " union all ".join(
            f"select '{n}' as source, cast(max({c}) as varchar) as newest, count({c}) as stamped_rows, "
            f"date_diff('hour', max({c}), timestamp '2024-02-01 00:00:00') as hours_old from {v}"
            for n, c, v in (("hotspots", "rep_date", "hot"), ("weather", "date_time_lst", "wx"), ("fires", "o_orderdate", "orders"))
        ),
    )

    # windows
    add(
        "daily_max_date_anomalies",
        ["boundary"],
        """select b.station_id, b.station_name, b.requested_year, cast(b.date - 1 as varchar) as missing_previous_date,
          cast(b.date as varchar) as duplicated_reported_date, b.n as records_on_duplicated_date,
          1 as line_no, string_agg(coalesce(r.time, '<NA>'), ' | ' order by r.row_id) as reported_times,
          string_agg(coalesce(r.aqhi_raw, '<NA>'), ' | ' order by r.row_id) as reported_aqhi_values,
          'possible_date_boundary_anomaly' as issue_type
        from boundary b join (select * from obs_sparse where value_type = 'daily_max') r
          on r.station_id = b.station_id and r.station_name = b.station_name and r.requested_year = b.requested_year and r.date = b.date
        group by 1, 2, 3, 4, 5, 6""",
    )
    add(
        "date_anomaly_flags",
        ["boundary"],
        """select o.row_id, o.station_id, o.station_name, o.requested_year, cast(o.date as varchar) as date, 'possible_date_boundary_anomaly' as issue_type
        from obs_sparse o join boundary b using (station_id, station_name, requested_year, date) where o.value_type = 'daily_max'
        union all select row_id, station_id, station_name, requested_year, cast(date as varchar), 'date_outside_requested_year'
        from obs_sparse where value_type = 'daily_max' and year(date) <> requested_year""",
    )
    hours = "select distinct station_id, date_time_lst as t from wx"
    add(
        "hour_gaps",
        ["wx"],
        f"""select station_id, cast(p as varchar) as gap_start, cast(t as varchar) as gap_end, date_diff('hour', p, t) as gap_hours
        from (select *, lag(t) over (partition by station_id order by t) as p from ({hours})) where date_diff('hour', p, t) > 1""",
    )
    add(
        "station_coverage",
        ["wx"],
        "select station_id, cast(min(date_time_lst) as varchar) as first_hour, cast(max(date_time_lst) as varchar) as last_hour, "
        "count(*) as row_count, count(distinct cast(date_time_lst as date)) as days_with_rows from wx group by station_id",
    )
    add(
        "hour_runs",
        ["wx"],
        f"""select station_id, cast(min(t) as varchar) as run_start, cast(max(t) as varchar) as run_end, count(*) as run_hours
        from (select *, sum(brk) over (partition by station_id order by t rows unbounded preceding) as g
          from (select *, case when t = lag(t) over (partition by station_id order by t) + interval 1 hour then 0 else 1 end as brk
                from ({hours}))) group by station_id, g""",
    )
    add(
        "duplicate_timestamps",
        ["wx"],
        "select station_id, cast(date_time_lst as varchar) as date_time_lst, count(*) as record_count from wx group by station_id, wx.date_time_lst having count(*) > 1",
    )
    add(
        "dedup_exact",
        ["obs"],
        f"""select row_id, {OUT_FIELDS}, removed_copies from (
          select *, row_number() over (partition by {FIELDS} order by row_id) as rn, count(*) over (partition by {FIELDS}) - 1 as removed_copies
          from obs) where rn = 1""",
    )
    add(
        "conflict_quarantine",
        ["obs"],
        """select o.row_id, c.vals > 1 as source_value_conflict, case when c.vals <= 1 then o.aqhi_numeric end as series_value,
          case when c.vals > 1 then case when c.cats = 1 then c.cat end else o.category end as series_category
        from obs o join (select station_id, value_type, date, time, count(distinct aqhi_raw) as vals, count(distinct category) as cats,
            min(category) as cat from obs group by all) c
        on o.station_id = c.station_id and o.value_type = c.value_type and o.date is not distinct from c.date
          and o.time is not distinct from c.time""",
    )
    add(
        "primary_station",
        ["cand"],
        """select city, station_id, operator, distance_km, fit_candidates from (
          select *, count(*) over (partition by city) as fit_candidates, row_number() over (partition by city
            order by case when operator = 'ECCC-MSC' then 0 else 1 end, distance_km, station_id) as rn
          from cand where interval_kind = 'hourly' and first_date <= date '2024-01-01' and last_date >= date '2026-07-31'
            and has_wind and has_precip) where rn = 1""",
    )
    features = [
        "nearest_hotspot_distance_km", "temp_mean", "temp_min", "temp_max", "precip_total", "wind_speed_mean", "wind_dir_mean_deg",
    ]
    add(
        "training_rows",
        ["fact"],
        "select city_id, cast(date_id as varchar) as date_id, hotspots_within_100km, hotspots_within_250km, hotspots_within_500km, "
        + ", ".join(f"{r6(c)} as {c}" for c in features)
        + f", {r6('aqhi_daily_max')} as y from fact where aqhi_data_available and fire_data_available and weather_data_available and aqhi_daily_max is not null",
    )
    add(
        "next_day_target",
        ["panel"],
        f"select p.city_id, cast(p.date_id as varchar) as date_id, {r6('p.y')} as y, {r6('q.y')} as y_next from panel p "
        "left join panel q on q.city_id = p.city_id and q.date_id = p.date_id + 1",
    )
    for name, view in (("persistence_forecast", "naive"), ("moving_average_forecast", "ma")):
        add(name, [view], f"select city_id, cast(date_id as varchar) as date_id, {r6('y')} as y, {r6('y_hat')} as y_hat from {view}")
    add(
        "lookback_windows",
        ["panel"],
        """select p.city_id, cast(p.date_id as varchar) as date_id,
          string_agg(cast(cast(round(q.y, 4) as decimal(12,4)) as varchar), ',' order by q.date_id) as lookback
        from panel p join panel q on q.city_id = p.city_id and q.date_id between p.date_id - 6 and p.date_id and q.y is not null
        group by p.city_id, p.date_id having count(*) = 7""",
    )
    lags = " union all ".join(
        f"select p.city_id, {k} as lag_days, '{f}' as feature, {r6(f'corr(p.aqhi_daily_max, cast(q.{f} as double))')} as correlation, count(q.{f}) as pairs "
        f"from fact p join fact q on q.city_id = p.city_id and q.date_id = p.date_id - {k} where p.aqhi_daily_max is not null group by p.city_id"
        for k in (0, 1, 2)
        for f in ("hotspots_within_500km", "temp_mean")
    )
    add("lag_correlation", ["fact"], lags)
    add(
        "time_split",
        ["panel"],
        f"select city_id, cast(date_id as varchar) as date_id, {r6('y')} as y, case when date_id <= date '2024-10-31' then 'train' else 'test' end as part from panel",
    )
    for name, lo, width in (
        ("train_scaled", "avg", "stddev_samp({c})"),
        ("train_scaled_minmax", "min", "max({c}) - min({c})"),
    ):
        fit = ", ".join(f"{lo}({c}) as lo_{c}, {width.format(c=c)} as w_{c}" for c in ("y", "temp_mean"))
        cols = ", ".join(f"case when w_{c} > 0 then {r6(f'({c} - lo_{c}) / w_{c}')} end as {c}_scaled" for c in ("y", "temp_mean"))
        add(
            name,
            ["panel"],
            f"select p.city_id, cast(date_id as varchar) as date_id, case when date_id <= date '2024-01-20' then 'train' else 'test' end as part, {cols} "
            f"from panel p left join (select city_id, {fit} from panel where date_id <= date '2024-01-20' group by city_id) f on f.city_id = p.city_id",
        )
    scores = f"{r6('avg(abs(y - y_hat))')} as mae, {r6('sqrt(avg((y - y_hat) * (y - y_hat)))')} as rmse, count(*) as days"
    add(
        "forecast_metrics",
        ["fc"],
        f"select city_id, model, {scores} from fc where y is not null and y_hat is not null group by city_id, model",
    )
    add(
        "metrics_by_band",
        ["fc"],
        f"select city_id, model, band, {scores} from (select *, case when y < 4 then 'low risk' when y < 7 then 'moderate risk' "
        "when y <= 10 then 'high risk' else 'very high risk' end as band from fc) where y is not null and y_hat is not null group by city_id, model, band",
    )
    add(
        "preview_top_n",
        ["cur"],
        "select row_id, location_id, cast(o as varchar) as observation_datetime, aqhi from (select row_id, location_id, observation_datetime as o, aqhi "
        "from cur order by o, location_id nulls last, row_id limit 20)",
    )

    # rules and increments
    # The civil clock of Toronto in 2024: forward on 10 March, back on 3 November.
    add(
        "clock_change_days",
        ["wx"],
        """select station_id, cast(date as varchar) as date, hours, civil_day_hours, hours = 24 as is_standard_time
        from (select station_id, cast(t as date) as date, cast(count(distinct hour(t)) as integer) as hours,
            case cast(t as date) when date '2024-03-10' then 23 when date '2024-11-03' then 25 else 24 end as civil_day_hours
          from (select station_id, date_time_lst + to_days(cast(row_id % 24 * 14 as integer)) as t from wx) group by all)
        where civil_day_hours <> 24""",
    )
    add("dq_dim", ["sta", "city"], _dim_rules())
    add("dq_city_date", ["place", "due"], _city_date_rules())
    add("dq_weather", ["wx"], _weather_rules())
    add("dq_evac", ["evac"], _evac_rules())
    s["dq_fact"] = _fact_rules()
    add(
        "poll_upsert",
        ["cur"],
        "select id, cast(snapshot_ts as varchar) as snapshot_ts, row_id, aqhi from (select *, row_number() over (partition by id "
        "order by snapshot_ts desc, row_id desc) as rn from cur) where rn = 1",
    )
    s["poll_stream_upsert"] = s["poll_upsert"]
    add(
        "poll_stream_ids",
        [],
        "select distinct cast(user_id % 8 as varchar) || '-' || cast(cast(ts as date) as varchar) || '-' || cast(hour(ts) as varchar) as id from events",
    )
    return s
