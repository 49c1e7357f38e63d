"""DuckDB SQL with the same rows as the queries of the catalogue."""

from __future__ import annotations

from driftline.functions import geo

_RAW = """raw as (
  select event_id as ride_id, event_type as bike_type, cast(json_extract_string(props, '$.k') as int) as start_sid,
         lead(cast(json_extract_string(props, '$.k') as int)) over w as end_sid, ts as starting_time, lead(ts) over w as ending_time
  from events window w as (partition by user_id order by ts, event_id))"""
_TRIPS = _RAW + """, trips as (select * from raw where ending_time > starting_time and ending_time - starting_time <= interval 24 hour)"""
_POINTS = """points as (
  select vec_id as id, label, cast(round(cast(embedding[1] as double) * 100000) as bigint) as x, cast(round(cast(embedding[2] as double) * 100000) as bigint) as y
  from embeddings)"""
_OD = _TRIPS + """, pairs as (select start_sid, end_sid, count(*) as trip_count from trips where start_sid <> end_sid group by all),
od as (select *, row_number() over (order by start_sid, end_sid) as od_id from pairs)"""
_EDGES = _POINTS + """, edges as (
  select row_number() over (order by s, t) as id, * from (
    select a.id as s, b.id as t, cast(round(sqrt(((a.x-b.x)**2 + (a.y-b.y)**2)::double)) as bigint) as w, a.x as ax, a.y as ay, b.x as bx, b.y as by_,
           row_number() over (partition by a.id order by (a.x-b.x)**2 + (a.y-b.y)**2, b.id) as r
    from points a join points b on a.id <> b.id where a.id >= 100 and b.id >= 100) where r <= 4)"""
_SNAP = """snap as (
  select s.id as sid, arg_min(v.id, struct_pack(d := (s.x-v.x)**2 + (s.y-v.y)**2, i := v.id)) as vertex, cast(min((s.x-v.x)**2 + (s.y-v.y)**2) as bigint) as d2
  from points s join points v on s.id < 100 and v.id >= 100 group by s.id)"""
_COMBOS = """combos as (
  select od_id, a.vertex as source, b.vertex as target, trip_count from od join snap a on a.sid = start_sid join snap b on b.sid = end_sid where a.vertex <> b.vertex)"""
_DIST = """r(o, n, d) using key (o, n) as (
  select distinct vertex, vertex, 0::bigint from snap
  union
  (select r.o, e.t, min(r.d + e.w) from r join edges e on r.n = e.s left join recurring.r p on p.o = r.o and p.n = e.t
   where p.d is null or r.d + e.w < p.d group by 1, 2))"""
_WALK = """pred as (
  select r.o, e.t as n, min(e.id) as id from r join edges e on r.n = e.s join r q on q.o = r.o and q.n = e.t where r.d + e.w = q.d and e.t <> r.o group by 1, 2),
asked as (select distinct source, target from combos),
walk(source, target, v, id) as (
  select source, target, target, null::bigint from asked
  union all
  select w.source, w.target, e.s, p.id from walk w join pred p on p.o = w.source and p.n = w.v join edges e on e.id = p.id where w.v <> w.source),
reached as (select distinct source, target from walk where v = source)"""
_MID = """cl as (select id as cl_id, x - 500 as ax, y + 300 as ay, x + 500 as bx, y - 300 as by_, sqrt((1000**2 + 600**2)::double) as len from points where id >= 100),
mids as (select id, (id * 37) % 101 + 1 as total_trips, (ax + bx) / 2.0::double as mx, (ay + by_) / 2.0::double as my, sqrt(((ax-bx)**2 + (ay-by_)**2)::double) as len from edges),
near as (
  select m.id, m.total_trips, m.len, cl_id, cl.len as cl_len,
         case when cl.len > 0 then greatest(0.0::double, least(1.0::double, ((mx-ax)*(bx-ax) + (my-ay)*(by_-ay)) / ((bx-ax)**2 + (by_-ay)**2))) else 0.0::double end as t,
         (mx - (ax + t * (bx-ax)))**2 + (my - (ay + t * (by_-ay)))**2 as d2
  from mids m, cl),
assigned as (select id, total_trips, len, cl_id, cl_len from near where d2 < 9000000 qualify row_number() over (partition by id order by d2, cl_id) = 1)"""
_BOXES = """boxes(area, x0, y0, x1, y1) as (values ('east', 500.5, -60000.5, 60000.5, -2000.5), ('north', 500.5, 500.5, 60000.5, 60000.5),
  ('south', -60000.5, -60000.5, -500.5, -500.5), ('west', -60000.5, 1000.5, -500.5, 60000.5))"""
_SHORT = """links as (select s, t from edges where w < 2500 union select t, s from edges where w < 2500),
label(n, c) using key (n) as (
  select distinct s, s from links
  union
  (select l.t, min(label.c) from label join links l on l.s = label.n left join recurring.label p on p.n = l.t where p.c is null or label.c < p.c group by 1))"""
_TL = _OD + f""", {_POINTS}, routes as (select *, dense_rank() over (order by od_id) as route_id from od),
period as (select min(starting_time) as t_min, max(ending_time) as t_max, epoch_us(max(ending_time)) - epoch_us(min(starting_time)) as us from trips where starting_time >= timestamp '2024-01-02'),
tl as (
  select ride_id, route_id, cast((epoch_us(starting_time) - epoch_us(t_min)) / 1e6::double / (us / 1e6::double) * 180 as float) as t0,
         cast(greatest(0.1::double, (epoch_us(ending_time) - epoch_us(starting_time)) / 1e6::double / (us / 1e6::double) * 180) as float) as dur,
         cast(starting_time as date) as day
  from trips join routes using (start_sid, end_sid), period where starting_time >= timestamp '2024-01-02')"""
_SAMP = ", samples as (select *, cast((row_number() over (partition by day order by t0, ride_id) - 1) % 256 as int) as samp from tl)"
_MODE = """ends as (select start_sid as sid, bike_type from trips union all select end_sid, bike_type from trips),
modes as (select sid, bike_type, count(*) as "count" from ends group by sid, bike_type qualify row_number() over (partition by sid order by count(*) desc, bike_type) = 1)"""


def _utm() -> str:
    radius, e, alpha, _ = geo.krueger()
    sums = {"n": ["xi"], "e": ["eta"]}
    for j, a in enumerate(alpha, 1):
        sums["n"].append(f"sin(xi * {2 * j}) * cosh(eta * {2 * j}) * {a!r}::double")
        sums["e"].append(f"cos(xi * {2 * j}) * sinh(eta * {2 * j}) * {a!r}::double")
    scale = f"{geo.UTM_SCALE * radius!r}::double"
    return f"""with {_POINTS}, d as (select id, x / 1e6::double - 74.0::double as lon, y / 1e6::double + 40.7::double as lat from points),
a as (select id, sin(radians(lat)) as s, radians(lon - (-75.0::double)) as lam from d),
b as (select id, sinh(atanh(s) - atanh(s * {e!r}::double) * {e!r}::double) as t, lam from a),
c as (select id, atan2(t, cos(lam)) as xi, asinh(sin(lam) / sqrt(t * t + cos(lam) * cos(lam))) as eta from b)
select id, round(({' + '.join(sums['e'])}) * {scale} + 500000.0::double, 3) as x, round(({' + '.join(sums['n'])}) * {scale}, 3) as y, 0.0::double as dx, 0.0::double as dy from c"""


ORACLE: dict[str, str] = {
    "od_pairs": f"with {_OD} select start_sid, end_sid, trip_count from pairs",
    "station_departures": f"with {_TRIPS}, {_POINTS} select p.id as sid, p.label as borough, coalesce(n, 0) as departures from points p left join (select start_sid, count(*) as n from trips group by 1) on start_sid = p.id where p.id < 100",
    "trip_summary": f"with {_TRIPS} select count(*) as trips, count(distinct start_sid) as start_stations, count(distinct (start_sid, end_sid)) as pairs, strftime(min(starting_time), '%Y-%m-%d') as first_day, strftime(max(starting_time), '%Y-%m-%d') as last_day from trips",
    "daily_volume": f"with {_TRIPS} select strftime(starting_time, '%Y-%m-%d') as day, count(*) as trips from trips group by 1",
    "daily_extremes": f"""with {_TRIPS}, days as (select strftime(starting_time, '%Y-%m-%d') as day, count(*) as trips from trips group by 1)
select count(*) as days, round(avg(trips), 6) as mean, max(trips) as most, min(trips) as least,
  (select day from days order by trips desc, day limit 1) as most_on, (select day from days order by trips, day limit 1) as least_on from days""",
    "od_coverage": f"""with {_OD}, run as (select sum(trip_count) over (order by trip_count desc, start_sid, end_sid) as cum, sum(trip_count) over () as total from pairs)
select percent, cast(count(*) filter (where cum * 100 <= percent * total) + 1 as bigint) as pairs from run, (values (50), (80), (90), (95)) p(percent) group by 1""",
    "station_mode": f"with {_TRIPS}, {_MODE} select * from modes",
    "trip_dedup": f"with {_RAW} select min(ride_id) as ride_id, bike_type, start_sid from raw group by 2, 3",
    "trip_validity": f"""with {_RAW} select case when starting_time is null or ending_time is null then 'missing' when ending_time <= starting_time then 'not after start'
  when ending_time - starting_time > interval 24 hour then 'too long' else 'valid' end as kind, count(*) as trips from raw group by 1""",
    "station_id_norm": """select c_custkey, case c_custkey % 6 when 0 then '90000' || c_custkey when 1 then '8000' || c_custkey when 2 then '7000' when 3 then '6000' || c_custkey when 4 then c_custkey || '.04' end as station_id from customer""",
    "role_join": f"""with {_TRIPS}, {_MODE}, {_POINTS} select ride_id, p.label as start_borough, q.label as end_borough from trips t
  join modes a on a.sid = start_sid and a.bike_type = t.bike_type join modes b on b.sid = end_sid and b.bike_type = t.bike_type join points p on p.id = start_sid join points q on q.id = end_sid""",
    "od_semi": f"with {_OD}, {_POINTS}, {_SNAP}, {_COMBOS} select od_id, start_sid, end_sid, trip_count from od where od_id in (select od_id from combos)",
    "station_anti": f"with {_OD}, {_POINTS} select id as sid, label as borough from points where id < 100 and not exists (select 1 from pairs where start_sid = id and trip_count > 1)",
    "od_topn": f"with {_OD} select start_sid, end_sid, trip_count from pairs order by trip_count desc, start_sid, end_sid limit 100",
    "od_page": f"with {_OD} select start_sid, end_sid, trip_count, od_id from od order by od_id limit 50 offset 100",
    "gate_metrics": f"""with {_RAW}, {_POINTS} select 'trips' as name, count(*) as value, '' as note from raw union all select 'open trips', count(*), '' from raw where ending_time is null
  union all select 'repeated rides', count(*), 'should be 0' from (select ride_id from raw group by 1 having count(*) > 1)
  union all select 'unknown ends', count(*), 'should be 0' from raw where end_sid is not null and end_sid not in (select id from points where id < 100)""",
    "dense_ids": f"with {_OD} select od_id, start_sid, end_sid, dense_rank() over (order by start_sid) as start_rank from od",
    "flow_keyword_sum": """select cast(sum(case when upper(p_type) like '%LARGE%' or upper(p_type) like '%PRO%' then cast(l_quantity as bigint) end) as bigint) as keyword_sum,
  cast(sum(case when regexp_matches(p_name, '(bolt|rod|^hot)') then cast(l_quantity as bigint) end) as bigint) as pattern_sum, cast(sum(cast(l_quantity as bigint)) as bigint) as total from lineitem join part on l_partkey = p_partkey""",
    "flow_upsert": f"with {_TRIPS} select start_sid as id, count(*) as total_trips from trips group by 1",
    "route_first_wins": f"""with {_TRIPS} select start_sid || '-' || end_sid as od_id, ride_id, ride_id % 4 as batch from trips where start_sid <> end_sid
  qualify row_number() over (partition by start_sid, end_sid order by ride_id % 4, ride_id) = 1""",
    "fact_star": """select a.n_name as from_name, b.n_name as to_name, count(*) as lines, cast(sum(cast(round_even(l_extendedprice * 100, 0) as bigint)) as bigint) as cents
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
  join nation a on a.n_nationkey = s_nationkey join nation b on b.n_nationkey = c_nationkey where s_nationkey <> c_nationkey group by 1, 2""",
    "knn_snap": f"with {_POINTS}, {_SNAP} select sid, vertex, d2 from snap",
    "knn_capped": f"with {_EDGES}, {_MID} select cl_id, cast(sum(total_trips) as bigint) as total_trips from assigned group by 1",
    "flow_lwavg": f"with {_EDGES}, {_MID} select cl_id, case when max(cl_len) > 0 then cast(sum(total_trips * len) / max(cl_len) as bigint) else cast(sum(total_trips) as bigint) end as total_trips from assigned group by cl_id",
    "flow_max": f"with {_EDGES}, {_MID} select cl_id, max(total_trips) as total_trips from assigned group by 1",
    "pip_tag": f"with {_POINTS}, {_BOXES} select id, min(area) as area from points, boxes where x > x0 and x < x1 and y > y0 and y < y1 group by 1",
    "pip_drop": f"with {_POINTS}, {_BOXES} select id from points where not exists (select 1 from boxes where x > x0 and x < x1 and y > y0 and y < y1)",
    "bbox_clip": f"with {_EDGES} select id, s as source, t as target from edges where least(ax, bx) <= 8000 and greatest(ax, bx) >= -5000 and least(ay, by_) <= 4000 and greatest(ay, by_) >= -5000",
    "line_within_area": f"""with {_EDGES}, {_BOXES}, cut as (
  select id, ax > x0 and ax < x1 and ay > y0 and ay < y1 and bx > x0 and bx < x1 and by_ > y0 and by_ < y1 as inside,
    greatest(0.0::double, case when bx > ax then (x0 - ax) / (bx - ax) when bx < ax then (x1 - ax) / (bx - ax) when ax > x0 and ax < x1 then 0.0::double else 2.0::double end,
             case when by_ > ay then (y0 - ay) / (by_ - ay) when by_ < ay then (y1 - ay) / (by_ - ay) when ay > y0 and ay < y1 then 0.0::double else 2.0::double end) as t0,
    least(1.0::double, case when bx > ax then (x1 - ax) / (bx - ax) when bx < ax then (x0 - ax) / (bx - ax) else 1.0::double end,
          case when by_ > ay then (y1 - ay) / (by_ - ay) when by_ < ay then (y0 - ay) / (by_ - ay) else 1.0::double end) as t1
  from edges, boxes)
select distinct id, 'within' as how from cut where inside union all select distinct id, 'meets' from cut where t0 <= t1""",
    "utm_project": _utm(),
    "edge_length": f"with {_EDGES} select id, round(sqrt(((ax-bx)**2 + (ay-by_)**2)::double), 6) as length, round((ax + bx) / 2.0::double, 6) as mid_x, ax::double as start_x, by_::double as end_y from edges",
    "od_combinations": f"with {_OD}, {_POINTS}, {_SNAP}, {_COMBOS} select * from combos",
    "sssp_dist": f"with recursive {_EDGES}, {_SNAP}, {_DIST} select * from r",
    "edge_flows": f"""with recursive {_OD}, {_EDGES}, {_SNAP}, {_COMBOS}, {_DIST}, {_WALK}
select id, cast(sum(trip_count) as bigint) as total_trips from walk join reached using (source, target) join combos using (source, target) where id is not null group by 1""",
    "route_edges": f"""with recursive {_OD}, {_EDGES}, {_SNAP}, {_COMBOS}, {_DIST}, {_WALK}
select od_id, count(id) as edges, max(r.d) as cost from walk join reached using (source, target) join combos using (source, target) join r on r.o = source and r.n = target group by od_id""",
    "components": f"with recursive {_EDGES}, {_SHORT} select n as node, c as component from label",
    "largest_component": f"with recursive {_EDGES}, {_SHORT} select n as node from label where c = (select c from label group by c order by count(*) desc, c limit 1)",
    "endpoint_cluster": f"""with recursive {_POINTS}, v as (select * from points where id >= 100), links as (select a.id as s, b.id as t from v a join v b on (a.x-b.x)**2 + (a.y-b.y)**2 <= 2250000),
label(n, c) using key (n) as (
  select distinct s, s from links
  union
  (select l.t, min(label.c) from label join links l on l.s = label.n left join recurring.label p on p.n = l.t where p.c is null or label.c < p.c group by 1))
select c as cluster, count(*) as members, round(avg(x), 6) as x, round(avg(y), 6) as y from label join v on v.id = n group by 1""",
    "tl_trips": f"with {_TL} select ride_id, route_id, round(t0::double, 3) as t0, round(dur::double, 3) as dur, strftime(day, '%Y-%m-%d') as day from tl",
    "tl_meta": f"""with {_TL} select strftime(t_min, '%Y-%m-%dT%H:%M:%S.%f') as period_start, strftime(t_max, '%Y-%m-%dT%H:%M:%S.%f') as period_end, 180 as anim_duration_s,
  (select count(*) from routes) as n_routes, (select count(*) from tl) as n_trips from period""",
    "tl_gates": f"""with {_TL} select 'trips' as name, count(*) as value, '' as note from tl union all
  select 'routes_without_trips', count(*), 'should be 0' from routes where route_id not in (select route_id from tl) union all
  select 't0_min', cast(min(t0) as bigint), '' from tl union all select 't0_max', cast(max(t0) as bigint), 'should not exceed the clock' from tl""",
    "tl_samples": f"with {_TL}{_SAMP} select ride_id, samp from samples",
    "tl_day_window": f"with {_TL}{_SAMP} select ride_id, samp from samples where day = date '2024-01-10' and t0 between 0 and 1000 and samp < 128",
    "polyline_roundtrip": f"with {_EDGES} select id, 0 as seq, ax - 74000000 as x, ay + 40700000 as y from edges union all select id, 1, bx - 74000000, by_ + 40700000 from edges",
    "line_simplify": f"""with recursive {_POINTS}, line as (
  select cast(floor(id / 64) as bigint) as walk, list(struct_pack(x := x::double, y := y::double) order by id) as p from points group by 1),
section(walk, i, j) as (
  select walk, 1::bigint, len(p) from line
  union all
  select walk, e.i, e.j from (
    select walk, unnest([struct_pack(i := i, j := k), struct_pack(i := k, j := j)]) as e from (
      select walk, i, j, off2, k, row_number() over (partition by walk, i, j order by off2 desc, k) as place from (
        select walk, i, j, k, (qx - t * dx)**2 + (qy - t * dy)**2 as off2 from (
          select *, case when dx = 0 and dy = 0 then 0 else greatest(0, least(1, (qx * dx + qy * dy) / (dx * dx + dy * dy))) end as t from (
            select walk, i, j, k, p[j].x - p[i].x as dx, p[j].y - p[i].y as dy, p[k].x - p[i].x as qx, p[k].y - p[i].y as qy
            from (select s.walk, s.i, s.j, l.p, unnest(range(s.i + 1, s.j)) as k from section s join line l using (walk))))))
    where place = 1 and off2 > 25000000)),
kept as (select walk, i from section union select walk, j from section)
select walk, cast(len(p) as int) as before, cast(count(*) as int) as after, cast(sum(p[i].x) as bigint) as sum_x, cast(sum(p[i].y) as bigint) as sum_y
from kept join line using (walk) group by walk, len(p)""",
    "vertex_times": f"""with {_EDGES}, v as (
  select id, 0 as seq, ax / 1e6::double - 74 as x, ay / 1e6::double + 40.7 as y from edges union all select id, 1, bx / 1e6::double - 74, by_ / 1e6::double + 40.7 from edges
  union all select id, 2, -74.0::double, 40.7::double from edges),
steps as (select *, sqrt(((x - lag(x) over w) * cos(radians(y)))**2 + (y - lag(y) over w)**2) as d from v window w as (partition by id order by seq)),
run as (select *, coalesce(sum(d) over (partition by id order by seq), 0.0::double) as cum, coalesce(sum(d) over (partition by id), 0.0::double) as total from steps),
share as (select *, cum / case when total > 0 then total else 1 end as f, greatest(30.0::double, total * 111320 / 3.5::double) as dur from run)
select id, cast(seq as int) as seq, round(id::double + dur * case when f < 0.15 then 0.15::double * sqrt(f / 0.15::double) when f > 0.85 then 1 - 0.15::double * sqrt((1 - f) / 0.15::double) else f end, 3) as t from share""",
}
