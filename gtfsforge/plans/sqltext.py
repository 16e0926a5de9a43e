"""Helpers that write DuckDB SQL text for the oracles."""

from __future__ import annotations

import re

# ---- fixed values: the published RD -> WGS84 approximation, arc seconds in p and q (100 km) ----
RD_LAT = """52.15517440 + (3235.65389 * q - 32.58297 * p * p - 0.24750 * q * q - 0.84978 * p * p * q - 0.06550 * q * q * q - 0.01709 * p * p * q * q
 - 0.00738 * p + 0.00530 * p * p * p * p - 0.00039 * p * p * q * q * q + 0.00033 * p * p * p * p * q - 0.00012 * p * q) / 3600"""
RD_LON = """5.38720621 + (5260.52916 * p + 105.94684 * p * q + 2.45656 * p * q * q - 0.81885 * p * p * p + 0.05594 * p * q * q * q - 0.05607 * p * p * p * q
 + 0.01199 * q - 0.00256 * p * p * p * q * q + 0.00128 * p * q * q * q * q + 0.00022 * q * q - 0.00022 * p * p + 0.00026 * p * p * p * p * p) / 3600"""
# ---- end of fixed values ----


def rd_degrees(which: str, x: str, y: str) -> str:
    """Degrees as a double, not rounded."""
    return _rd(RD_LAT if which == "lat" else RD_LON, x, y)


def _rd(text: str, x: str, y: str) -> str:
    p, q = f"((cast({x} as double) - 155000) * 1e-5)", f"((cast({y} as double) - 463000) * 1e-5)"
    return "(" + re.sub(r"\b[pq]\b", lambda m: p if m[0] == "p" else q, text) + ")"


SCHED = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode"]
PATTERN = ["version", "dataownercode", "lineplanningnumber", "journeypatterncode"]
JOURNEY = SCHED + ["lineplanningnumber", "journeynumber"]


def pipe(*cols: str, prefix: str = "") -> str:
    """``a|b|c`` with NULL propagation (``||`` semantics)."""
    return " || '|' || ".join(f"cast({prefix}{c} as varchar)" for c in cols)


def clock(expr: str) -> str:
    """seconds -> HH:MM:SS text, hours past 24 allowed."""
    return (f"case when ({expr}) is null then null else printf('%02d:%02d:%02d', "
            f"cast(floor(({expr}) / 3600) as bigint), cast(floor((({expr}) % 3600) / 60) as bigint), "
            f"cast(({expr}) % 60 as bigint)) end")


def ymd(expr: str) -> str:
    return f"strftime(cast({expr} as date), '%Y%m%d')"


def lat(x: str, y: str, p: int = 8, s: int = 5) -> str:
    return f"cast({_rd(RD_LAT, x, y)} as decimal({p},{s}))"


def lon(x: str, y: str, p: int = 7, s: int = 5) -> str:
    return f"cast({_rd(RD_LON, x, y)} as decimal({p},{s}))"


def on(a: str, b: str, cols) -> str:
    return " and ".join(f"{a}.{c} = {b}.{c}" for c in cols)


def cols(alias: str, names) -> str:
    return ", ".join(f"{alias}.{c}" for c in names)
