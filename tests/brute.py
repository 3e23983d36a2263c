"""Plain, slow versions of the ordered rules, for comparison on small random input."""

from __future__ import annotations

import math
from collections import defaultdict

SECOND = 1_000_000
RANK = {"TLM": 0, "TRG": 1, "SYN": 2}


def changes(rows):
    """rows: (vehicle, source, us, ord1, ord2, status)"""
    last, out = {}, []
    for row in sorted(rows):
        if last.get(row[:2]) != row[5]:
            out.append(row)
        last[row[:2]] = row[5]
    return out


def fused(rows, gap=10 * SECOND):
    """rows: (vehicle, event, us, source, ord1, ord2)"""
    state, out = {}, []
    for row in sorted(rows, key=lambda r: (r[0], r[2], RANK[r[3]], r[4], r[5])):
        vehicle, event, us = row[:3]
        seen = state.get(vehicle)
        if seen and seen[0] == event and us - seen[1] < gap:
            continue
        state[vehicle] = (event, us)
        out.append(row)
    return out


def nearest(event_us, readings, window):
    """readings: (us, source, ord1, ord2, pct) of the vehicle, in timeline order"""
    best = None
    for us, *_, pct in readings:
        d = math.floor((us - event_us) / SECOND)
        if abs(d) <= window and (best is None or (abs(d), -d) < best[0]):
            best = ((abs(d), -d), pct, us)
    return best and best[1:]


def round2(x):
    scaled = x * 100
    low = math.floor(scaled)
    part = scaled - low
    up = part > 0.5 or (part == 0.5 and low % 2 == 1)
    return (low + up) / 100


def sessions(events, merge_gap=300, shortest=60):
    """events: (vehicle, us, kind, prio, ord1, ord2, event, pct or None)"""
    by_vehicle = defaultdict(list)
    for e in sorted(events, key=lambda e: e[:6]):
        by_vehicle[e[0]].append(e)
    out = []
    for vehicle, line in by_vehicle.items():
        state, merged = None, []
        for here, there in zip(line, line[1:]):
            if here[2] == 0:
                state = here[6]
            if here[7] is None or there[7] is None or there[1] <= here[1]:
                continue
            rise = there[7] - here[7]
            if rise < (5.0 if state == "ignitionOn" else 2.0):
                continue
            start, end = round2(here[7]), round2(there[7])
            if merged and here[1] - merged[-1]["end"] <= merge_gap * SECOND:
                old = merged[-1]
                old["end"], old["end_pct"] = there[1], end
                old["delta"] = round2(end - old["start_pct"])
            else:
                merged.append({
                    "start": here[1], "end": there[1], "start_pct": start, "end_pct": end,
                    "delta": round2(rise), "state": state or "unknown",
                })
        out += [
            (vehicle, m["start"], m["end"], m["delta"], m["start_pct"], m["end_pct"], m["state"])
            for m in merged if m["end"] - m["start"] >= shortest * SECOND
        ]
    return sorted(out)
