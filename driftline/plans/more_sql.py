"""DuckDB SQL of the queries in ``more``."""

from __future__ import annotations

from driftline.plans import oracle as o

_TEXT = (
    o._RAW
    + """, text as (
  select 'r' || (ride_id - ride_id % 3) as ride_id, bike_type, starting_time, ending_time, start_sid as a, end_sid as b,
         case when ride_id % 11 > 0 then 40 + start_sid / 64.0::double end as start_lat, -74 + start_sid / 128.0::double as start_lng,
         40 + end_sid / 64.0::double as end_lat, -74 + end_sid / 128.0::double as end_lng, 'Stop ' || start_sid as start_name,
         case when ride_id % 7 > 0 then 'Stop ' || end_sid end as end_name, '90000' || start_sid as start_id, '90000' || end_sid as end_id, ride_id as n from raw)"""
)
_VALID = (
    _TEXT
    + """, valid as (
  select * from text where b is not null and end_name is not null and start_lat is not null and ending_time > starting_time and ending_time - starting_time <= interval 24 hour
  qualify row_number() over (partition by ride_id order by starting_time, ending_time, start_id, end_id) = 1),
ends as (select start_id as id, start_name as name, start_lat as lat, start_lng as lng from valid union all select end_id, end_name, end_lat, end_lng from valid),
seen as (select id, name, lat, lng, count(*) as n from ends where lat between 40.4 and 41.0 and lng between -74.3 and -73.6 group by id, name, lat, lng
  qualify row_number() over (partition by id order by count(*) desc, name, lat, lng) = 1),
stops as (select row_number() over (order by id) as sid, * from seen)"""
)
_LINES = (
    o._EDGES
    + """, lines as (select id, s, t, case when id % 13 > 0 then id % 16 else 0 end as rw_type, id % 2 = 0 as v,
  case when id % 5 = 0 then 'Old bridge ' || id when id % 5 < 4 then 'Way ' || id end as street_name,
  ax, ay, case when id % 7 = 0 then ax else bx end as bx, case when id % 7 = 0 then ay else by_ end as by_ from edges),
usable as (select * from lines where (ax <> bx or ay <> by_) and sqrt(((ax-bx)**2 + (ay-by_)**2)::double) >= 0.1),
line_ends as (select id * 2 as k, ax as x, ay as y from usable union all select id * 2 + 1, bx, by_ from usable),
spots as (select x, y, min(k) as v from line_ends group by all)"""
)
_ROUTED = f"""{o._OD}, {o._EDGES}, {o._SNAP}, {o._COMBOS}, {o._DIST}, {o._WALK},
steps as (select od_id, trip_count, source, target, id, v from walk join reached using (source, target) join combos using (source, target))"""
_SHORT_AREAS = f"""{o._EDGES}, {o._SHORT}, {o._SNAP}, big as (select n from label where c = (select c from label group by c order by count(*) desc, c limit 1)),
tagged as (select sid, vertex, p.label::varchar as borough, vertex in (select n from big) as inside from snap join points p on p.id = sid)"""
_TILE = "cast(floor((x / 1e6::double - 74 + 180) / 360 * {n}) as int) as tx, cast(floor((1 - asinh(tan(radians(y / 1e6::double + 40.7))) / pi()) / 2 * {n}) as int) as ty"

MORE: dict[str, str] = {
    "clean_typed": f"""with {_TEXT} select start_id as start_station_id, count(*) as trips, count(ending_time) as ended, count(start_lat) as placed, sum(end_lat) as lat,
  max(strftime(starting_time, '%Y-%m-%dT%H:%M:%S.%f')) as last from text group by 1""",
    "clean_valid": f"with {_VALID} select ride_id, bike_type, strftime(starting_time, '%Y-%m-%dT%H:%M:%S.%f') as started, start_id as start_station_id, end_name as end_station_name, start_lat, end_lng from valid",
    "clean_area": f"with {_TEXT} select bike_type, count(*) as trips from text where start_lat between 40.4 and 41.0 and start_lng between -74.3 and -73.6 group by 1",
    "station_table": f"""with {_VALID} select sid, id as station_id, name as station_name, lng, lat, n as "count" from stops""",
    "trips_between": f"with {_VALID} select x.sid as start_sid, y.sid as end_sid, count(*) as trips from valid join stops x on x.id = start_id and x.name = start_name join stops y on y.id = end_id and y.name = end_name group by 1, 2",
    "csv_columns": f"""with {_TEXT} select ' SYS0' || a as start_station_id, case when starting_time < timestamp '2024-01-15' then 'member' end as member_casual, count(*) as trips, count(end_name) as ends,
  max(strftime(starting_time, '%Y-%m-%d %H:%M:%S.%f')) as last, min(ride_id) as first, 'part' as file from text group by 1, 2""",
    "parquet_kept": f"with {o._TRIPS}, kept as (select start_sid from trips union all select start_sid from trips where start_sid = end_sid) select count(*) as rows, cast(sum(start_sid) as bigint) as sids, false as written_again, true as on_disk from kept",
    "stations_per_area": f"with {o._POINTS}, {o._BOXES}, tagged as (select id, min(area) as borough from points, boxes where id < 100 and x > x0 and x < x1 and y > y0 and y < y1 group by 1) select borough, count(*) as stations from tagged group by 1",
    "stations_invalid": f"with {o._POINTS} select id as sid from points where id < 100 and id % 9 = 0",
    "rows_observed": f"with {o._TRIPS}, {o._EDGES} select 'valid trips' as name, count(*) as rows from trips union all select 'edges', count(*) from edges",
    "sql_views": f"with {o._TRIPS}, {o._POINTS} select label as borough, count(*) as trips from trips join points on id = start_sid where id < 100 group by 1",
    "points_in_box": f"with {o._POINTS} select id from points where x / 1e6::double - 74.0::double between -74.26::double and -73.99::double and y / 1e6::double + 40.7::double between 40.69::double and 40.92::double",
    "tile_keys": f"""with {o._EDGES}, ends as (select id, ax as x, ay as y from edges union all select id, bx, by_ from edges),
keys as (select id, 12 as zoom, {_TILE.format(n=1 << 12)} from ends union select id, 15, {_TILE.format(n=1 << 15)} from ends)
select zoom, tx, ty, count(*) as lines from keys group by all""",
    "lines_rideable": f"with {_LINES} select id, cast(rw_type as int) as rw_type from lines where rw_type not in (2, 4, 9, 14) and not (rw_type = 3 and v)",
    "lines_usable": f"with {_LINES} select id from usable",
    "line_ids": "select c_mktsegment, c_name, row_number() over (order by c_mktsegment, c_name) as id from customer",
    "topology_edges": f"""with {_LINES} select id, a.v as source, b.v as target, round(sqrt(((ax-bx)**2 + (ay-by_)**2)::double), 6) as cost, round(sqrt(((ax-bx)**2 + (ay-by_)**2)::double), 6) as reverse_cost
  from usable join spots a on a.x = ax and a.y = ay join spots b on b.x = bx and b.y = by_""",
    "topology_vertices": f"with {_LINES} select v as id, x::double as x, y::double as y from spots",
    "segments_named": """select pattern, cast(count(*) filter (where regexp_matches(upper(p_name), pattern)) as bigint) as segments from part, (values ('BOLT|ROD'), ('^HOT'), ('NO SUCH')) p(pattern) group by 1""",
    "area_connectivity": f"with recursive {_SHORT_AREAS} select borough, count(*) as stations, count(*) filter (where inside) as connected from tagged group by 1",
    "areas_missing": f"with recursive {_SHORT_AREAS} select borough from (values ('0'), ('1'), ('2'), ('nowhere')) r(borough) where borough not in (select borough from tagged where inside)",
    "component_sizes": f"with recursive {o._EDGES}, {o._SHORT} select c as component, count(*) as nodes from label group by 1",
    "route_lines": f"""with recursive {_ROUTED}
select od_id, max(trip_count) as trip_count, count(id) as edge_count, cast(2 * count(id) as int) as vertices, max(p.x)::double as from_x, max(q.y)::double as to_y, sum(e.ax + e.bx)::double as sum_x
from steps s left join edges e using (id) join points p on p.id = s.source join points q on q.id = s.target group by od_id""",
    "path_steps": f"with recursive {_ROUTED} select od_id, count(id) + 1 as rows, count(id) as edges, cast(count(id) + 1 as int) as last, max(target) as at from steps group by od_id",
    "routing_metrics": f"""with recursive {_ROUTED}, routes as (select od_id, max(trip_count) as n from steps group by 1),
flows as (select id, sum(trip_count) as n from steps where id is not null group by 1)
select (select count(*) from routes) as routes, cast((select sum(n) from routes) as bigint) as trips, cast((select max(n) from flows) as bigint) as largest_flow,
  (select count(*) from routes join od using (od_id) join points p on p.id = start_sid join points q on q.id = end_sid where p.label <> q.label) as across_areas,
  cast((select coalesce(sum(n), 0) from flows where id % 5 = 0) as bigint) as structure_trips""",
    "flow_keywords": f"with {o._EDGES} select cast(coalesce(sum((id * 37) % 101 + 1) filter (where id % 5 = 0), 0) as bigint) as trips, count(*) filter (where id % 5 = 0) as edges from edges",
    "flow_on_all": f"with {o._EDGES}, {o._MID} select cl.cl_id, cast(coalesce(sum(total_trips), 0) as bigint) as total_trips from cl left join assigned on cl.cl_id = assigned.cl_id group by 1",
    "flow_dropped": f"""with {o._EDGES}, {o._MID}, a as (select cast(sum(total_trips) as bigint) as n from mids), b as (select cast(coalesce(sum(total_trips), 0) as bigint) as n from assigned)
select a.n as before, b.n as after, round((a.n - b.n) / a.n::double * 100, 9) as dropped_percent from a, b""",
    "flow_positive": f"with {o._EDGES} select id, (id * 37) % 101 - 49 as total_trips from edges where (id * 37) % 101 - 49 > 0",
    "tl_routes": f"with {o._EDGES} select id as route_id, id as od_id, case when ax = bx and ay = by_ then 1 else 2 end as vertices from edges",
    "tl_points": f"with {o._EDGES} select id as route_id, 1 as seq, ax::double as lon, ay::double as lat from edges union all select id, 2, bx::double, by_::double from edges",
    "tl_vertices": f"""with {o._EDGES}, n as (select case when id % 2 = 1 then 4 when ax = bx and ay = by_ then 1 else 2 end as n from edges)
select count(*) as routes, cast(sum(n) as bigint) as vertices, cast(cast(round(avg(n), 1) as decimal(8,1)) as double) as mean_vertices from n""",
    "tl_runs": f"with {o._EDGES} select s as route_id, min(id) as first, count(*) as rows from edges group by 1",
    "tl_first_trips": f"with {o._TRIPS} select ride_id, strftime(starting_time, '%Y-%m-%dT%H:%M:%S.%f') as started from trips order by starting_time, ride_id limit 100",
    "tl_rounded": f"""with {o._TRIPS}, kept as (select * from trips where starting_time >= timestamp '2024-01-02'),
period as (select epoch_us(min(starting_time)) as a, epoch_us(max(ending_time)) - epoch_us(min(starting_time)) as us from kept),
clocked as (select starting_time, round((epoch_us(starting_time) - a) / 1e6::double / (us / 1e6::double) * 180, 2) as t0, round((epoch_us(ending_time) - a) / 1e6::double / (us / 1e6::double) * 180, 2) as t1 from kept, period)
select strftime(starting_time, '%Y-%m-%d') as day, count(*) as trips, cast(sum(round(t0 * 100)) as bigint) as t0, cast(sum(round(greatest(0.1::double, t1 - t0) * 100)) as bigint) as dur from clocked group by 1""",
    "tl_export": f"""with {o._TL}{o._SAMP} select strftime(s.day, '%Y-%m-%d') as day, count(*) as trips, cast(sum(s.samp) as bigint) as samples, cast(sum(p.x) as bigint) as from_x
from samples s join routes r using (route_id) join points p on p.id = r.start_sid group by 1""",
    "route_index": f"with {o._OD} select od_id - 1 as route, trip_count as trips from od",
    "coords_rounded": f"""with {o._EDGES}, v as (select id, ax as x, ay as y from edges union all select id, bx, by_ from edges)
select id, cast(sum(round(((x + 1.3) / 1e6::double - 74.0::double) * 100000)) as bigint) as x, cast(sum(round(((y + 1.3) / 1e6::double + 40.7::double) * 100000)) as bigint) as y from v group by 1""",
    "repeats_dropped": f"with {o._EDGES} select id as od_id, case when ax = bx and ay = by_ then 1 else 2 end as vertices from edges",
    "geojson_features": f"""with {o._EDGES} select id, '{{"type":"Feature","properties":{{"id":' || id || ',"source":' || s || '}},"geometry":{{"type":"LineString","coordinates":[[' || ax::double || ',' || ay::double || '],[' || bx::double || ',' || by_::double || ']]}}}}' as feature from edges""",
    "geojson_read": f"with {o._POINTS} select id as sid, true as unnamed, x::double as x, y::double as y from points where id < 100",
    "wkt_areas": f"with {o._POINTS} select id, case when id % 2 = 0 then 2 else 1 end as polygons, case when id % 2 = 0 then 8 else 4 end as vertices, (case when id % 2 = 0 then 8 * x + 40 + 200 else 4 * x + 20 end)::double as sum_x from points",
    "metadata_file": f"""with {o._TL} select '{{"period_start":"' || strftime(t_min, '%Y-%m-%dT%H:%M:%S.%f') || '","period_end":"' || strftime(t_max, '%Y-%m-%dT%H:%M:%S.%f') || '","anim_duration_s":180,"n_routes":' ||
  (select count(*) from routes) || ',"n_trips":' || (select count(*) from tl) || ',"samp_buckets":256}}' as value from period""",
    "edges_in_areas": f"""with {o._EDGES}, {o._BOXES}, hit as (select id, min(area) as area from edges, boxes where (ax + bx) / 2.0::double > x0 and (ax + bx) / 2.0::double < x1 and (ay + by_) / 2.0::double > y0 and (ay + by_) / 2.0::double < y1 group by 1)
select area, count(*) as edges from hit group by 1""",
}
