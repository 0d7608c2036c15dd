"""State transitions of the keyed detectors, one report at a time.

Each function takes the state before a report and the report, and gives the state after it and the emitted rows.
State and report are plain dicts; ``t`` is whole epoch seconds. The streaming queries run these; the batch plans
reach the same results with windows.
"""

from __future__ import annotations

import math
from typing import Any

from haulwatch.functions.geo import EARTH_RADIUS_M

DAY = 86400
Record = dict[str, Any]
Result = tuple[Record, list[Record]]


def metres(lng1: float, lat1: float, lng2: float, lat2: float) -> float:
    a, b = math.radians(lat1), math.radians(lat2)
    chord = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(lng2 - lng1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(chord)))


def _point(r: Record, side: str) -> Record:
    return {f"alarm_{side}_t": r["t"], f"alarm_{side}_lng": r["lng"], f"alarm_{side}_lat": r["lat"]}


def first_of_day(state: Record, r: Record) -> Result:
    """The first report of a day."""
    day = r["t"] // DAY
    if state.get("day") == day:
        return state, []
    return {"day": day}, [{**r, **_point(r, "start")}]


def gps_gap(state: Record, r: Record, max_m: float = 2000.0) -> Result:
    """A jump from the previous report, once per day of arrival; the previous report is emitted.

    A report without a position is no jump, and none can be seen after it.
    """
    last, day, out = state.get("last"), state.get("day"), []
    known = last is not None and None not in (last["lng"], last["lat"], r["lng"], r["lat"])
    if known and metres(last["lng"], last["lat"], r["lng"], r["lat"]) > max_m:
        if day != r["t"] // DAY:
            day = r["t"] // DAY
            out = [{**last, **_point(last, "start"), **_point(r, "end")}]
    return {"last": r, "day": day}, out


def sustained(state: Record, r: Record, cooldown_s: int = 7200, from_start: bool = True) -> Result:
    """A rule broken for more than ``r["minutes"]`` without a clean report in between, with a cooldown.

    A rule without minutes never fires.
    """
    if not r["violating"]:
        return {"active": None, "fired": state.get("fired")}, []
    active, fired = state.get("active"), state.get("fired")
    if active is None:
        return {"active": r["t"], "fired": fired}, []
    due = r["minutes"] is not None and r["t"] - active > r["minutes"] * 60 and (fired is None or r["t"] - fired > cooldown_s)
    if not due:
        return {"active": active, "fired": fired}, []
    out = {**r, **_point(r, "start")}
    if from_start:
        out |= {"alarm_start_t": active, "alarm_end_t": r["t"]}
    return {"active": active, "fired": r["t"]}, [out]


def per_fence(state: Record, r: Record, cooldown_s: int = 7200, from_start: bool = True) -> Result:
    """``sustained`` for each fence and kind of rule of a vehicle; what can no longer matter is forgotten."""
    fences, key = state.get("fences") or {}, f"{r['kind']}:{r['condition_id']}"
    after, out = sustained(fences.get(key) or {}, r, cooldown_s, from_start)
    if after.get("active") is not None or (after.get("fired") is not None and r["t"] - after["fired"] <= cooldown_s):
        fences[key] = after
    else:
        fences.pop(key, None)
    return {"fences": fences}, out


def spaced(state: Record, r: Record, cooldown_s: int = 7200) -> Result:
    """Every report is a candidate; fires when the last firing is more than ``cooldown_s`` ago."""
    fired = state.get("fired")
    if fired is not None and r["t"] - fired <= cooldown_s:
        return state, []
    return {"fired": r["t"]}, [{**r, **_point(r, "end")}]


def site_visits(state: Record, r: Record, dwell_s: int = 180) -> Result:
    """Visits to the sites listed in ``r["near"]``; the state has of each site when it was entered, whether that is confirmed, and left."""
    sites, out = dict(state.get("sites") or {}), []
    near = {str(s) for s in r["near"]}
    for site, visit in list(sites.items()):
        enter, confirmed, leave = visit["enter"], visit["confirmed"], visit["exit"]
        if site in near:
            sites[site] = {"enter": enter, "confirmed": confirmed or r["t"] - enter > dwell_s, "exit": None}
        elif confirmed and leave is None:
            sites[site] = {"enter": enter, "confirmed": True, "exit": r["t"]}
        elif confirmed and r["t"] - leave > dwell_s:
            out.append({"site": site, "enter_t": enter, "exit_t": leave})
            del sites[site]
    for site in near - sites.keys():
        sites[site] = {"enter": r["t"], "confirmed": False, "exit": None}
    return {"sites": sites}, out


def vehicle_status(state: Record, r: Record, offline_s: int = 180, still_s: int = 180) -> Result:
    """Latest status row of a vehicle; a report no later than the last one is ignored."""
    last = state.get("seen")
    if last is not None and r["t"] <= last:
        return state, []
    online = last is not None and r["t"] - last <= offline_s and not state.get("offline")
    total = state.get("online") or 0
    if online:
        total += r["t"] - last
        if total > r["t"] % DAY:
            total = 0
    zero = None
    if r["speed"] == 0:
        zero = state.get("zero") if online and state.get("zero") is not None else r["t"]
    moving = not (zero is not None and r["t"] - zero >= still_s)
    new = {"seen": r["t"], "online": total, "zero": zero, "offline": False, "moving": int(moving)}
    return new, [{**r, "vehicle_status": 0, "online_time": total, "online_status": int(moving)}]


def stop_history(state: Record, r: Record, min_s: int = 180, silence_s: int = 180) -> Result:
    """Stops that end with a move; a report without a speed ends one silently."""
    stop = state.get("stop")
    if r["speed"] == 0:
        if stop is None or r["t"] - stop["seen"] > silence_s:
            stop = {"t": r["t"], "lng": r["lng"], "lat": r["lat"]}
        return {"stop": {**stop, "seen": r["t"]}}, []
    if r["speed"] is None or not r["speed"] > 0 or stop is None:
        return {"stop": None}, []
    out = []
    if r["t"] - stop["seen"] < silence_s and r["t"] - stop["t"] > min_s:
        out = [{**r, "stop_t": stop["t"], "stop_lng": stop["lng"], "stop_lat": stop["lat"], "start_t": r["t"]}]
    return {"stop": None}, out


def off_route(
    state: Record, r: Record, dwell_s: int = 180, off_minutes: int = 3, cooldown_s: int = 7200
) -> Result:
    """Off-route alarms; the report lists permits by what is near: ``build`` (and slow), ``disposal``, ``on_route``."""
    before = state.get("dwell") or {}
    dwell = {str(p): before.get(str(p), r["t"]) for p in r["build"]}
    held, off, fired = state.get("held"), state.get("off"), state.get("fired")
    ready = [p for p in r["build"] if r["t"] - dwell[str(p)] > dwell_s]
    if held is None and ready:
        held = min(ready)
    if held is not None and held in r["disposal"]:
        held = None
    out = []
    if held is None or held in r["on_route"]:
        off = None
    elif off is None:
        off = {**r, "permit_id": held}
    # With off_minutes below 0 even the first report off the route would be late enough.
    if off is not None and (r["t"] - off["t"]) // 60 > off_minutes and (fired is None or off["t"] - fired >= cooldown_s):
        fired = off["t"]
        out = [{**off, **_point(off, "start"), **_point(r, "end")}]
    keep = None if off is None else {k: v for k, v in off.items() if k not in ("build", "disposal", "on_route")}
    return {"dwell": dwell, "held": held, "off": keep, "fired": fired}, out
