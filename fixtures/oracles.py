"""DuckDB texts of the queries, written without the library's techniques: closed-form polygons, pairwise distances
and step-by-step recursion instead of cells, slices and folds."""

from __future__ import annotations

import math

from fixtures.adapter import AS_OF, AS_OF_T, DATE, HALF, SOURCES, ctes

COOLDOWN = 1800
WIDE_M = 1500.0
ROUTE_M = 2000.0
DWELL_S = 30
ORACLES: dict[str, str] = {}

PI = repr(math.pi)
X_PI = repr(math.pi * 3000.0 / 180.0)


def _with(names: str, body: str, more: str = "", recursive: bool = False) -> str:
    parts = [p for p in (ctes(*[n for n in names.split() if n not in SOURCES]), more.strip()) if p]
    head = "with recursive " if recursive else "with "
    return head + ",\n".join(parts) + "\n" + body.strip()


def _text(t: str) -> str:
    return f"strftime(make_timestamp(({t})*1000000), '%Y-%m-%d %H:%M:%S')"


def _dist(x1: str, y1: str, x2: str, y2: str) -> str:
    return (
        f"(2*6371000e0*asin(sqrt(pow(sin((radians({y2})-radians({y1}))/2),2)"
        f" + cos(radians({y1}))*cos(radians({y2}))*pow(sin(radians({x2}-{x1})/2),2))))"
    )


def _inside(p: str, f: str) -> str:
    return f"abs({p}.lng-{f}.cx)+abs({p}.lat-{f}.cy) < {HALF}"


SUPERVISED = "audit_state='1' and manage_state='1'"

# Scans and sinks

ORACLES["scan_positions"] = _with(
    "positions", f"select row_key, 'T' || cast(vehicle_id as string) devid, {_text('t')} as time, lng, lat, speed from positions"
)
ORACLES["decode_frames"] = """
select event_id, cast(13000000000 + user_id as string) devid, strftime(ts, '%Y-%m-%d %H:%M:%S') as time,
       (113000000 + (event_id*7919) % 1000 * 100)/1e6 lng, (34700000 + (event_id*6007) % 1000 * 100)/1e6 lat,
       (event_id % 1200)/1e1 speed, cast(event_id % 360 as string) pos, cast(event_id % 3000 as int) altitude,
       '1' gpsflag, cast(user_id % 2 as string) accflag, cast(event_id % 2 as string) sharpturn,
       case when event_id % 4 = 1 then '1' else '0' end brake, printf('%.2f', event_id*3/1e1) gpsdistance,
       cast(user_id/1e1 as string) mainoilper, event_id % 65536 flow_id,
       case when event_id % 3 = 0 then cast(2 as bigint) end subpackages, case when event_id % 3 = 0 then cast(1 as bigint) end subpackage_seq,
       event_id % 11 <> 0 checksum_ok, cast(2 as int) n_items
from events"""
ORACLES["json_sink_roundtrip"] = _with(
    "positions vehicle driver",
    f"""select v.terminal_id devid, {_text('p.t')} as time, p.lng, p.lat, v.vehicle_id, v.dept_id, d.driver_name, true nulls_written
from positions p join vehicle v on v.vehicle_id = p.vehicle_id
left join driver d on d.dept_id = v.dept_id and d.driver_id = v.driver_id""",
)

# Filters and scalars


def _waves(v: str, *terms: tuple[float, str]) -> str:
    return "(" + " + ".join(f"{amp}*sin({v}{rate})" for amp, rate in terms) + ")*2e0/3e0"


def _gcj(lat: str, lng: str) -> tuple[str, str]:
    x, y = f"({lng}-105e0)", f"({lat}-35e0)"
    both = _waves(x, (20.0, f"*6e0*{PI}"), (20.0, f"*2e0*{PI}"))
    lat_w = _waves(y, (20.0, f"*{PI}"), (40.0, f"/3e0*{PI}"), (160.0, f"/12e0*{PI}"), (320.0, f"*{PI}/30e0"))
    lng_w = _waves(x, (20.0, f"*{PI}"), (40.0, f"/3e0*{PI}"), (150.0, f"/12e0*{PI}"), (300.0, f"/30e0*{PI}"))
    north = f"(-100e0+2e0*{x}+3e0*{y}+0.2e0*{y}*{y}+0.1e0*{x}*{y}+0.2e0*sqrt(abs({x}))+{both}+{lat_w})"
    east = f"(300e0+{x}+2e0*{y}+0.1e0*{x}*{x}+0.1e0*{x}*{y}+0.1e0*sqrt(abs({x}))+{both}+{lng_w})"
    m = f"(1-0.00669342162296594323e0*pow(sin({lat}/180e0*{PI}),2))"
    return (
        f"({lat}+{north}*180e0/((6378245e0*(1-0.00669342162296594323e0))/({m}*sqrt({m}))*{PI}))",
        f"({lng}+{east}*180e0/(6378245e0/sqrt({m})*cos({lat}/180e0*{PI})*{PI}))",
    )


def _bd(lat: str, lng: str) -> tuple[str, str]:
    z = f"(sqrt({lng}*{lng}+{lat}*{lat})+0.00002e0*sin({lat}*{X_PI}))"
    a = f"(atan2({lat},{lng})+0.000003e0*cos({lng}*{X_PI}))"
    return f"({z}*sin({a})+0.006e0)", f"({z}*cos({a})+0.0065e0)"


def _unbd(lat: str, lng: str) -> tuple[str, str]:
    x, y = f"({lng}-0.0065e0)", f"({lat}-0.006e0)"
    z = f"(sqrt({x}*{x}+{y}*{y})-0.00002e0*sin({y}*{X_PI}))"
    a = f"(atan2({y},{x})-0.000003e0*cos({x}*{X_PI}))"
    return f"{z}*sin({a})", f"{z}*cos({a})"


_G = _gcj("lat", "lng")
_GCJ_CTE = f"g as (select *, {_G[0]} glat, {_G[1]} glng from positions)"
_SANE = f"""select row_key, round({_bd('glat','glng')[0]},6) lat, round({_bd('glat','glng')[1]},6) lng, speed from g
where lat > 20e0 and lat < 40e0 and lng > 100e0 and lng < 120e0 and speed >= 0e0 and speed < 100e0"""
ORACLES["sanitize_positions"] = _with("positions", _SANE, _GCJ_CTE)
ORACLES["sanitize_positions_of_one_date"] = _with(
    "positions", f"{_SANE} and cast(make_timestamp(t*1000000) as date) = date '{DATE}'", _GCJ_CTE
)
ORACLES["in_effective_time_range"] = _with(
    "positions",
    """select row_key, make_timestamp(t*1000000) > timestamp '2024-01-05 06:00:00' and make_timestamp(t*1000000) < timestamp '2024-01-20 18:00:00' in_range
from positions""",
)
ORACLES["supervised_positions"] = _with(
    "positions", f"select row_key, vehicle_id, {_text('t')} as time from positions where {SUPERVISED}"
)
ORACLES["convert_coordinates"] = _with(
    "positions",
    f"""select row_key, round(glat,6) gcj_lat, round(glng,6) gcj_lng, round({_bd('glat','glng')[0]},6) bd_lat,
       round({_bd('glat','glng')[1]},6) bd_lng, round(slat,6) shifted_lat, round(slng,6) shifted_lng,
       round({_unbd('slat','slng')[0]},6) back_lat, round({_unbd('slat','slng')[1]},6) back_lng
from (select *, {_bd('lat','lng')[0]} slat, {_bd('lat','lng')[1]} slng from g) s""",
    _GCJ_CTE,
)
_LAG = """l as (select *, lag(row_key) over w prk, lag(t) over w pt, lag(lng) over w plng, lag(lat) over w plat from {src}
  window w as (partition by dept_id, vehicle_id order by t, row_key))"""
ORACLES["consecutive_distance"] = _with(
    "bus", f"select row_key, prk prev_row_key, round({_dist('plng','plat','lng','lat')},2) metres from l where prk is not null",
    _LAG.format(src="bus"),
)
ORACLES["in_daily_time_range"] = _with(
    "positions",
    """select row_key, s > 5*3600 and s < 23*3600 in_day, s // 3600 >= 20 or s // 3600 < 5 in_night,
       false in_same_hour, true in_all from (select row_key, t % 86400 s from positions) x""",
)
ORACLES["alarm_duration"] = _with(
    "bus",
    """select row_key, t-pt as seconds, case when t-pt >= 3600 then cast((t-pt)//3600 as string) || '小时' || cast((t-pt)%60 as string) || '分'
       else cast((t-pt)//60 as string) || '分' end as label from l where prk is not null""",
    _LAG.format(src="bus"),
)
ORACLES["append_read_back"] = _with(
    "fast",
    """select row_key, strftime(x,'%Y-%m') month_id, cast(day(x) as string) day_id, cast(hour(x) as string) hour_id
from (select row_key, make_timestamp(t*1000000) x from fast)""",
)
ORACLES["partition_ids"] = _with(
    "positions",
    """select row_key, strftime(x,'%Y-%m') month_id, cast(day(x) as string) day_id, cast(hour(x) as string) hour_id
from (select row_key, make_timestamp(t*1000000) x from positions) p""",
)

# Joins

ORACLES["join_vehicle_by_plate"] = _with(
    "positions vehicle",
    """select p.row_key, v.vehicle_id, v.dept_id, v.terminal_id devid, v.driver_id, v.enterprise_id
from positions p join vehicle v on v.car_card_number = 'P' || cast(p.vehicle_id as string)""",
)
ORACLES["join_vehicle_by_terminal"] = _with(
    "positions vehicle",
    """select p.row_key, v.vehicle_id, v.dept_id, v.car_card_number, v.driver_id
from positions p join vehicle v on v.terminal_id = 'T' || cast(p.vehicle_id as string)""",
)
ORACLES["filter_service_fee"] = _with(
    "bus service_fee",
    """select row_key, vehicle_id, cast(1 as int) service_state from bus p
where exists (select 1 from service_fee f where f.state=0 and f.vehicle_id=p.vehicle_id and f.dept_id=p.dept_id)""",
)
_BUS = "b as (select p.*, v.driver_id, v.enterprise_id from bus p join vehicle v on v.vehicle_id = p.vehicle_id)"
ORACLES["join_driver"] = _with(
    "bus vehicle driver",
    "select row_key, vehicle_id, b.driver_id, driver_name from b left join driver d on d.dept_id=b.dept_id and d.driver_id=b.driver_id",
    _BUS,
)
ORACLES["join_enterprise"] = _with(
    "bus vehicle enterprise",
    """select row_key, b.enterprise_id, enterprise_name, e.lng enterprise_lng, e.lat enterprise_lat
from b join enterprise e on e.dept_id=b.dept_id and e.enterprise_id=b.enterprise_id""",
    _BUS,
)


def _flag(card: str, state: int, name: str) -> str:
    return f"""cast(case when exists (select 1 from {card} c where c.state={state} and c.vehicle_id=p.vehicle_id and c.dept_id=p.dept_id)
       then 1 else 0 end as int) {name}"""


ORACLES["flag_transport_card"] = _with(
    "bus transport_card", f"select row_key, vehicle_id, {_flag('transport_card', 1, 'transport_card_state')} from bus p"
)
ORACLES["flag_register_card"] = _with(
    "bus register_card", f"select row_key, vehicle_id, {_flag('register_card', 0, 'register_card_state')} from bus p"
)
_REGION = f"""r as (select p.row_key, min(a.id) id from bus p join area a on a.dept_id=p.dept_id and a.state=1 and {_inside('p','a')} group by 1)"""
ORACLES["tag_region"] = _with(
    "bus area",
    """select p.row_key, cast(a.id as string) region_id, a.city_name region_name
from bus p left join r on r.row_key=p.row_key left join area a on a.id=r.id""",
    _REGION,
)
ORACLES["data_bus"] = _with(
    "bus vehicle service_fee driver enterprise transport_card area",
    f"""select p.row_key, p.vehicle_id, p.dept_id, cast(1 as int) service_state, driver_name, enterprise_name, e.lng enterprise_lng,
       {_flag('transport_card', 1, 'transport_card_state')}, cast(a.id as string) region_id, a.city_name region_name
from b p join enterprise e on e.dept_id=p.dept_id and e.enterprise_id=p.enterprise_id
left join driver d on d.dept_id=p.dept_id and d.driver_id=p.driver_id
left join r on r.row_key=p.row_key left join area a on a.id=r.id
where exists (select 1 from service_fee f where f.state=0 and f.vehicle_id=p.vehicle_id and f.dept_id=p.dept_id)""",
    _BUS + ",\n" + _REGION,
)
ORACLES["active_fence_rules"] = _with(
    "fence rule_work_time rule_restricted rule_over_speed rule_document_control",
    " union all ".join(
        f"select '{label}' as rule, r.condition_id, r.dept_id, r.alarm_date, f.coords from {name} r join fence f on f.condition_id=r.condition_id where r.state=0"
        for name, label in (("rule_work_time", "work time"), ("rule_restricted", "restricted"), ("rule_over_speed", "over speed"),
                            ("rule_document_control", "document control"))
    ),
)
ORACLES["points_in_fences"] = _with(
    "bus fence rule_restricted",
    f"""select p.row_key, f.condition_id from bus p join fence f on f.dept_id=p.dept_id and {_inside('p','f')}
join rule_restricted r on r.condition_id=f.condition_id and r.state=0""",
)
ORACLES["points_in_fences_mixed"] = _with(
    "bus mixed_fence",
    "select p.row_key, f.condition_id from bus p join mixed_fence f on f.dept_id=p.dept_id and abs(p.lng-f.cx)+abs(p.lat-f.cy) < f.half",
)
ORACLES["permitted_sites"] = _with(
    "register_card disposal_site",
    """select distinct c.vehicle_id, c.dept_id, c.disposal_site_id, s.disposal_site_name, c.permit_id
from register_card c join disposal_site s on s.disposal_site_id=c.disposal_site_id where c.state=0""",
).replace("select distinct c.vehicle_id", "select c.vehicle_id").replace(", c.permit_id\nfrom", "\nfrom")
ORACLES["permit_routes"] = _with(
    "register_card build_site disposal_site",
    """select c.permit_id, c.vehicle_id, c.dept_id, b.lng build_lng, b.lat build_lat, s.lng disposal_lng, s.lat disposal_lat, c.coords
from register_card c left join build_site b on b.build_site_id=c.build_site_id
left join disposal_site s on s.disposal_site_id=c.disposal_site_id where c.state=0""",
)
ORACLES["points_near_sites"] = _with(
    "bus disposal_site",
    f"""select row_key, disposal_site_id, round(m,2) metres from (
  select p.row_key, s.disposal_site_id, {_dist('p.lng','p.lat','s.lng','s.lat')} m from bus p join disposal_site s on s.dept_id=p.dept_id) x where m < 500""",
)
_VERTICES = """vert as (
  select permit_id, vehicle_id, dept_id, 113e0 + ((c*389 + k*173) % 1000)/1e4 vlng, 34.7e0 + ((c*613 + k*271) % 1000)/1e4 vlat
  from (select *, case when permit_id >= 1000000000 then permit_id - 1000000000 + 77 else permit_id end c from register_card where state=0) x
  cross join (values (0),(1),(2),(3),(4)) as n(k))"""
ORACLES["off_route_points"] = _with(
    "bus register_card",
    f"""select p.row_key, p.vehicle_id from bus p
join (select dept_id, vehicle_id, list(vlng) xs, list(vlat) ys from vert group by 1,2) v on v.dept_id=p.dept_id and v.vehicle_id=p.vehicle_id
where not exists (select 1 from vert w where w.dept_id=p.dept_id and w.vehicle_id=p.vehicle_id and {_dist('p.lng','p.lat','w.vlng','w.vlat')} <= {WIDE_M})""",
    _VERTICES,
)

# Building blocks


def _cooldown(key: str, cand: str = "cand", strict: bool = True, seconds: int = COOLDOWN) -> str:
    """Step to the first candidate far enough after the last firing, one step per recursion."""
    cols = key.split(", ")
    on = " and ".join(f"c.{k}=f.{k}" for k in cols)
    group = ", ".join(f"f.{k}" for k in cols)
    op = ">" if strict else ">="
    return f"""fires as (
  select {key}, min(t) t from {cand} group by {key}
  union all
  select {group}, min(c.t) t from fires f join {cand} c on {on} and c.t {op} f.t + {seconds} group by {group}, f.t)"""


ORACLES["latest_position"] = _with(
    "bus",
    f"""select dept_id, vehicle_id, row_key, {_text('t')} as time, lng, lat, speed from (
  select *, row_number() over (partition by dept_id, vehicle_id order by t desc, row_key desc) rn from bus) x where rn=1""",
)


def _sustain(rule: str, violating: str) -> str:
    return f"""inp as (
  select p.*, f.condition_id, r.alarm_date, coalesce({violating}, false) v
  from fast p join fence f on f.dept_id=p.dept_id and {_inside('p','f')}
  join {rule} r on r.condition_id=f.condition_id and r.state=0 where {SUPERVISED}),
isl as (select *, sum(case when v then 0 else 1 end) over (partition by vehicle_id, condition_id order by t, row_key rows unbounded preceding) g from inp),
cand as (select * from (select *, min(t) over (partition by vehicle_id, condition_id, g) active_t from isl where v) x where t - active_t > alarm_date*60)"""


OVERSPEED = "p.speed > r.speed"
WORK_TIME = """p.speed > 0 and not (case when r.condition_id % 2 = 0 then p.t % 86400 > 7200 and p.t % 86400 < 18000
    else p.t % 86400 // 3600 >= 23 or p.t % 86400 // 3600 < 2 end)"""
CONTROL = "p.speed > 0 and p.t > 1704070800 and p.t < 1704081600"
ORACLES["sustained_violations"] = _with(
    "fast fence rule_over_speed", "select vehicle_id, condition_id, row_key, t, active_t from cand", _sustain("rule_over_speed", OVERSPEED)
)
_FIRST_ROW = "select * from (select c.*, row_number() over (partition by {key}, c.t order by {tie}) rn from cand c join fires f on {on} and c.t=f.t) x where rn=1"


def _fired(key: str, tie: str = "c.row_key") -> str:
    cols = key.split(", ")
    return _FIRST_ROW.format(key=", ".join(f"c.{k}" for k in cols), tie=tie, on=" and ".join(f"c.{k}=f.{k}" for k in cols))


ORACLES["cooldown_events"] = _with(
    "fast",
    f"select dept_id, vehicle_id, t, row_key, speed from ({_fired('dept_id, vehicle_id')}) y",
    "cand as (select * from fast where speed > 20),\n" + _cooldown("dept_id, vehicle_id"),
    recursive=True,
)
ORACLES["first_event_per_day"] = _with(
    "bus",
    """select dept_id, vehicle_id, t, row_key, speed from (
  select *, row_number() over (partition by dept_id, vehicle_id, t//86400 order by t, row_key) rn from bus where speed > 20) x where rn=1""",
)

# Detectors

_NULL_D = "cast(null as double)"
_NULL_S = "cast(null as varchar)"


def _alarm(code: str, start: tuple[str, str, str] | None, end: tuple[str, str, str] | None, extra: str = "", src: str = "x") -> str:
    def part(side: str, point: tuple[str, str, str] | None) -> str:
        t, lng, lat = point or (None, _NULL_D, _NULL_D)
        return f"{_text(t) if t else _NULL_S} alarm_{side}_time, {lng} alarm_{side}_lng, {lat} alarm_{side}_lat"

    return f"""select dept_id, vehicle_id, row_key, '{code}' illegal_type_code, {part('start', start)}, {part('end', end)}{', ' + extra if extra else ''}
from {src}"""


ORACLES["alarm_no_register"] = _with(
    "bus register_card",
    _alarm(
        "0111", ("t", "lng", "lat"), None,
        src=f"""(select *, row_number() over (partition by dept_id, vehicle_id, t//86400 order by t, row_key) rn from bus p where {SUPERVISED}
  and not exists (select 1 from register_card c where c.state=0 and c.vehicle_id=p.vehicle_id and c.dept_id=p.dept_id)) x where rn=1""",
    ),
)
_CARD = "(select case when c.gone then null else c.state end from card_history c where c.vehicle_id=p.vehicle_id and c.dept_id=p.dept_id and c.from_t <= p.t order by c.from_t desc limit 1)"
ORACLES["cards_as_of"] = _with("bus card_history", f"select row_key, {_CARD} card_state from bus p")
ORACLES["alarm_no_register_as_of"] = _with(
    "bus card_history",
    _alarm(
        "0111", ("t", "lng", "lat"), None,
        src=f"""(select *, row_number() over (partition by dept_id, vehicle_id, t//86400 order by t, row_key) rn
  from (select *, {_CARD} card_state from bus p where {SUPERVISED}) q where coalesce(card_state, 1) <> 0) x where rn=1""",
    ),
)
ORACLES["alarm_gps_gap"] = _with(
    "bus",
    _alarm(
        "0118", ("pt", "plng", "plat"), ("t", "lng", "lat"),
        src=f"""(select dept_id, vehicle_id, prk row_key, pt, plng, plat, t, lng, lat,
    row_number() over (partition by dept_id, vehicle_id, t//86400 order by t, l.row_key) rn
  from l where {_dist('plng','plat','lng','lat')} > 2000) x where rn=1""",
    ),
    f"sup as (select * from bus where {SUPERVISED}),\n" + _LAG.format(src="sup"),
)
_FENCE_KEY = "dept_id, vehicle_id, condition_id"
for _name, _rule, _bad, _code in (
    ("alarm_work_time", "rule_work_time", WORK_TIME, "0116"),
    ("alarm_restricted_zone", "rule_restricted", "p.speed > 0", "0115"),
    ("alarm_overspeed", "rule_over_speed", OVERSPEED, "0110"),
    ("alarm_file_control", "rule_document_control", CONTROL, "0119"),
):
    _span = (("t", "lng", "lat"), None) if _code == "0119" else (("active_t", "lng", "lat"), ("t", _NULL_D, _NULL_D))
    ORACLES[_name] = _with(
        f"fast fence {_rule}",
        _alarm(_code, *_span, extra="cast(condition_id as string) fence_id", src=f"({_fired(_FENCE_KEY)}) y"),
        _sustain(_rule, _bad) + ",\n" + _cooldown(_FENCE_KEY),
        recursive=True,
    )

def _off_route(dwell_s: int, max_speed: float, off_minutes: int) -> str:
    return _with(
        "fast register_card build_site disposal_site",
        _alarm("0112", ("t", "lng", "lat"), ("end_t", "end_lng", "end_lat"), extra="permit_id", src="(select c.* from cand c join fires f on f.dept_id=c.dept_id and f.vehicle_id=c.vehicle_id and f.t=c.t) y"),
        f"""permit as (select c.permit_id, c.vehicle_id, c.dept_id, b.lng blng, b.lat blat, s.lng dlng, s.lat dlat
  from register_card c left join build_site b on b.build_site_id=c.build_site_id left join disposal_site s on s.disposal_site_id=c.disposal_site_id where c.state=0),
{_VERTICES},
pts as (select *, row_number() over (partition by dept_id, vehicle_id order by t, row_key) n from fast where {SUPERVISED}),
pp as (select p.*, m.permit_id, coalesce({_dist('p.lng','p.lat','m.blng','m.blat')} < {ROUTE_M} and p.speed < {max_speed}, false) at_build,
    coalesce({_dist('p.lng','p.lat','m.dlng','m.dlat')} < {ROUTE_M}, false) at_disposal,
    not exists (select 1 from vert w where w.permit_id=m.permit_id and {_dist('p.lng','p.lat','w.vlng','w.vlat')} <= {ROUTE_M}) away
  from pts p join permit m on m.dept_id=p.dept_id and m.vehicle_id=p.vehicle_id),
dw as (select *, sum(case when at_build then 0 else 1 end) over (partition by permit_id order by n rows unbounded preceding) g from pp),
ev as (select *, at_build and t - min(case when at_build then t end) over (partition by permit_id, g) > {dwell_s} confirmed from dw),
per as (select dept_id, vehicle_id, n, min(case when confirmed then permit_id end) take, list(permit_id) filter (at_disposal) leaving from ev group by 1,2,3),
held as (
  select dept_id, vehicle_id, n, case when list_contains(coalesce(leaving, []), take) then null else take end h from per where n=1
  union all
  select p.dept_id, p.vehicle_id, p.n, case when list_contains(coalesce(p.leaving, []), coalesce(h.h, p.take)) then null else coalesce(h.h, p.take) end
  from held h join per p on p.dept_id=h.dept_id and p.vehicle_id=h.vehicle_id and p.n=h.n+1),
state as (select p.*, h.h, coalesce(e.away, false) is_off from pts p join held h on h.dept_id=p.dept_id and h.vehicle_id=p.vehicle_id and h.n=p.n
  left join ev e on e.permit_id=h.h and e.n=p.n),
runs as (select *, sum(case when is_off then 0 else 1 end) over (partition by dept_id, vehicle_id order by n rows unbounded preceding) g from state),
late as (select * from (select *, min(n) over (partition by dept_id, vehicle_id, g) n0 from runs where is_off) x),
cand as (select f.dept_id, f.vehicle_id, f.row_key, f.t, f.lng, f.lat, f.h permit_id, l.t end_t, l.lng end_lng, l.lat end_lat
  from (select *, row_number() over (partition by dept_id, vehicle_id, n0 order by n) k from (
      select l.*, f.t t0 from late l join late f on f.dept_id=l.dept_id and f.vehicle_id=l.vehicle_id and f.n=l.n0) z where (t - t0)//60 > {off_minutes}) l
  join late f on f.dept_id=l.dept_id and f.vehicle_id=l.vehicle_id and f.n=l.n0 where l.k=1),
""" + _cooldown("dept_id, vehicle_id", strict=False, seconds=600),
        recursive=True,
    )


ORACLES["alarm_off_route"] = _off_route(0, 1000, 0)
ORACLES["alarm_off_route_dwell"] = _off_route(180, 40, 3)


def _disposal(illegal: str) -> str:
    return _with(
        "fast register_card disposal_site",
        _alarm(
            "0123", None, ("t", "lng", "lat"),
            extra="disposal_site_id, disposal_site_name, slng disposal_lng, slat disposal_lat",
            src=f"({_fired('dept_id, vehicle_id', 'c.disposal_site_id, c.row_key')}) y",
        ),
        f"""ok as (select distinct c.dept_id, c.vehicle_id, c.disposal_site_id from register_card c join disposal_site s on s.disposal_site_id=c.disposal_site_id where c.state=0),
cand as (select * from (select p.*, s.disposal_site_id, s.disposal_site_name, s.lng slng, s.lat slat, {_dist('p.lng','p.lat','s.lng','s.lat')} m
  from fast p join disposal_site s on s.dept_id=p.dept_id where {SUPERVISED}) x where m < {WIDE_M}
  and exists (select 1 from ok where ok.dept_id=x.dept_id and ok.vehicle_id=x.vehicle_id)
  and {illegal}),
""" + _cooldown("dept_id, vehicle_id"),
        recursive=True,
    )


_OK = "exists (select 1 from ok where ok.dept_id=x.dept_id and ok.vehicle_id=x.vehicle_id and ok.disposal_site_id{op}x.disposal_site_id)"
ORACLES["alarm_illegal_disposal"] = _disposal("not " + _OK.format(op="="))
ORACLES["alarm_illegal_disposal_any_other"] = _disposal(_OK.format(op="<>"))

ORACLES["site_visits"] = _with(
    "fast disposal_site",
    f"select dept_id, vehicle_id, disposal_site_id, {_text('ent')} enter_time, {_text('ext')} exit_time from st where done",
    f"""pts as (select *, row_number() over (partition by dept_id, vehicle_id order by t, row_key) n from fast where {SUPERVISED}),
ps as (select p.dept_id, p.vehicle_id, s.disposal_site_id, p.n, p.t, {_dist('p.lng','p.lat','s.lng','s.lat')} < {WIDE_M} ins
  from pts p join disposal_site s on s.dept_id=p.dept_id),
st as (
  select dept_id, vehicle_id, disposal_site_id, n, case when ins then t end ent, false conf, cast(null as bigint) ext, false done from ps where n=1
  union all
  select p.dept_id, p.vehicle_id, p.disposal_site_id, p.n,
    case when s.done or s.ent is null then case when p.ins then p.t end else s.ent end,
    case when s.done or s.ent is null then false else s.conf or (p.ins and p.t - s.ent > {DWELL_S}) end,
    case when s.done or s.ent is null or p.ins or not s.conf then null else coalesce(s.ext, p.t) end,
    case when s.done or s.ent is null or p.ins or not s.conf then false else coalesce(p.t - s.ext > {DWELL_S}, false) end
  from st s join ps p on p.dept_id=s.dept_id and p.vehicle_id=s.vehicle_id and p.disposal_site_id=s.disposal_site_id and p.n=s.n+1)""",
    recursive=True,
)


def _status(src: str, offline: int, still: int) -> str:
    return f"""firsts as (select * from (select *, row_number() over (partition by dept_id, vehicle_id, t order by row_key) k from {src}) x where k=1),
pts as (select *, row_number() over (partition by dept_id, vehicle_id order by t) n, count(*) over (partition by dept_id, vehicle_id) cnt from firsts),
st as (
  select dept_id, vehicle_id, n, t, cast(0 as bigint) onl, case when speed=0 then t end zero from pts where n=1
  union all
  select p.dept_id, p.vehicle_id, p.n, p.t,
    case when p.t - s.t > {offline} then s.onl when s.onl + p.t - s.t > p.t % 86400 then 0 else s.onl + p.t - s.t end,
    case when p.speed <> 0 then null when p.t - s.t > {offline} then p.t else coalesce(s.zero, p.t) end
  from st s join pts p on p.dept_id=s.dept_id and p.vehicle_id=s.vehicle_id and p.n=s.n+1),
lastrow as (select p.*, s.onl, s.zero from st s join pts p on p.dept_id=s.dept_id and p.vehicle_id=s.vehicle_id and p.n=s.n where s.n=p.cnt),
status as (select dept_id, vehicle_id, {_text('t')} as time, lng, lat, speed, cast(case when {AS_OF_T} - t > {offline} then 1 else 0 end as int) vehicle_status,
  onl online_time, cast(case when zero is not null and t - zero >= {still} then 0 else 1 end as int) online_status from lastrow)"""


ORACLES["vehicle_status"] = _with(
    "fast", "select dept_id, vehicle_id, time, lng, lat, speed, vehicle_status, online_time, online_status from status", _status("fast", 600, 30), recursive=True
)
ORACLES["vehicle_status_daily"] = _with(
    "bus", "select dept_id, vehicle_id, time, vehicle_status, online_time, online_status from status", _status("bus", 40000, 30000), recursive=True
)
ORACLES["stop_history"] = _with(
    "fast",
    f"""select dept_id, vehicle_id, {_text('stop_t')} stop_time, stop_lng, stop_lat, {_text('t')} start_time, lng start_lng, lat start_lat,
  strftime(make_timestamp(t*1000000),'%Y-%m') month_id, cast(day(make_timestamp(t*1000000)) as string) day_id, cast(hour(make_timestamp(t*1000000)) as string) hour_id
from st where closed and t - stop_t > {DWELL_S}""",
    f"""pts as (select *, row_number() over (partition by dept_id, vehicle_id order by t, row_key) n from fast),
st as (
  select dept_id, vehicle_id, n, t, lng, lat, case when speed=0 then t end stop_t, case when speed=0 then lng end stop_lng, case when speed=0 then lat end stop_lat,
    speed=0 is_open, false closed from pts where n=1
  union all
  select p.dept_id, p.vehicle_id, p.n, p.t, p.lng, p.lat,
    case when s.is_open and (p.speed > 0 or p.t - s.t <= 600) then s.stop_t when p.speed=0 then p.t end,
    case when s.is_open and (p.speed > 0 or p.t - s.t <= 600) then s.stop_lng when p.speed=0 then p.lng end,
    case when s.is_open and (p.speed > 0 or p.t - s.t <= 600) then s.stop_lat when p.speed=0 then p.lat end,
    p.speed=0, s.is_open and p.speed > 0 and p.t - s.t < 600
  from st s join pts p on p.dept_id=s.dept_id and p.vehicle_id=s.vehicle_id and p.n=s.n+1)""",
    recursive=True,
)

# Outputs

ORACLES["scan_alarms"] = _with(
    "alarms_raw",
    f"""select row_key, vehicle_id, dept_id, illegal_type_code, {_text('start_t')} alarm_start_time, s_lng alarm_start_lng,
  {_text('end_t')} alarm_end_time, e_lat alarm_end_lat, {_NULL_S} driver_name, {_NULL_S} uuid from alarms_raw""",
)
ORACLES["enrich_alarms"] = _with(
    "alarms_raw illegal_type",
    f"""select a.row_key, a.vehicle_id, a.dept_id, a.illegal_type_code, {_text('start_t')} alarm_start_time, {_text('coalesce(end_t, start_t)')} alarm_end_time,
  s_lng alarm_start_lng, s_lat alarm_start_lat, e_lng alarm_end_lng, e_lat alarm_end_lat,
  i.illegal_type_short_desc, i.illegal_type_desc, i.enterprise_score, i.vehicle_score, i.driver_score,
  end_t - start_t interval_seconds, case when end_t - start_t >= 3600 then cast((end_t-start_t)//3600 as string) || '小时' || cast((end_t-start_t)%60 as string) || '分'
    else cast((end_t-start_t)//60 as string) || '分' end interval_time,
  round({_dist('s_lng','s_lat','e_lng','e_lat')},2) interval_distance, cast(2024 as int) scoring_year, '2024-01' month_id, '1' day_id, '6' hour_id
from alarms_raw a left join illegal_type i on i.dept_id=a.dept_id and i.illegal_type_code=a.illegal_type_code""",
)
_DEVICE = (
    "device_id time gps_lng gps_lat speed pos gps_flag wire_flag power_flag acc_flag auxiliary_flag temperature door "
    "all_distance all_dist_fuel gps_distance gps_all_distance report_time zxcqi alarm_flag main_oil_per residual_oil "
    "vice_oil_per vice_residual_oil oil_difference sharp_turn brake dev_id e_site_name e_site_address e_site_province_id "
    "e_site_city_id e_site_area_id s_site_name s_site_address s_site_province_id s_site_city_id s_site_area_id "
    "enterprise_name province_id city_id area_id"
).split()
ORACLES["trip_table"] = _with(
    "trips_raw",
    f"""select {', '.join(f'{_NULL_S} as {c}' for c in _DEVICE)}, to_site_inter_time e_site_time, to_site_id e_site_id, to_site_lat e_site_lat, to_site_lng e_site_lng,
  coalesce(to_sit_flag, -1) e_site_flag, cast(0 as int) status, cast(0 as int) dev_status, from_site_id s_site_id, coalesce(from_sit_flag, -1) s_site_flag,
  from_site_lng s_site_lng, from_site_lat s_site_lat, coalesce(from_site_inter_time, '') s_site_time, '{AS_OF}' updatetime, dept_id, vehicle_id,
  enterprise_id transport_enterprise_id, car_card_number, load, coalesce(vehicle_empty, 1) vehicle_empty, '2024-01' month_id, '1' day_id, '6' hour_id
from trips_raw where to_site_lng is not null""",
)
ORACLES["status_upsert"] = _with(
    "fast status_snapshot",
    """select o.vehicle_id, o.dept_id, o.terminal_id, coalesce(n.time, o.time) as time, coalesce(n.lng, o.lng) lng, coalesce(n.lat, o.lat) lat,
  coalesce(n.speed, o.speed) speed, cast(case when n.time is not null then 9 else o.gprs_state end as int) gprs_state,
  cast(case when n.time is not null then 1 else o.acc_state end as int) acc_state, coalesce(n.vehicle_status, o.vehicle_status) vehicle_status,
  coalesce(n.online_time, o.online_time) online_time, coalesce(n.online_status, o.online_status) online_status
from status_snapshot o left join status n on n.vehicle_id=o.vehicle_id and n.dept_id=o.dept_id""",
    _status("fast", 600, 30),
    recursive=True,
)
ORACLES["mark_offline"] = _with(
    "fast", "select dept_id, vehicle_id, time, vehicle_status from status", _status("fast", 600, 30), recursive=True
)

ORACLES["scan_positions_mixed"] = ORACLES["scan_positions"]
ORACLES["rejected_records"] = _with(
    "positions",
    """select row_key, case when row_key % 10 = 3 then 'lng: not a double' else 'not a JSON object' end reason
from positions where row_key % 10 in (3, 4)""",
)
ORACLES["alarm_fences"] = " union all ".join(f"(select * from ({ORACLES[n]}) q)" for n in ("alarm_work_time", "alarm_restricted_zone", "alarm_overspeed"))
# Other plans of the same result.
ORACLES |= {f"{name}_{way}": ORACLES[name] for way, names in {
    "crowded": ("tag_region", "off_route_points"),
    "sliced": (
        "alarm_gps_gap", "alarm_restricted_zone", "alarm_off_route", "alarm_illegal_disposal", "site_visits", "stop_history",
        "vehicle_status",
    ),
    "shuffled": ("join_enterprise", "points_in_fences"),
}.items() for name in names}
