"""Plain-Python model of the rating questions, one line at a time, used as
the brute-force expectation for small fixtures."""

from __future__ import annotations

import math
import re
from collections import defaultdict

LOW = "".join(chr(i) for i in range(0x21))


def jtrim(s: str) -> str:
    return s.strip(LOW)


def jsplit(line: str, sep: str = ",") -> list[str]:
    parts = line.split(sep)
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    if parts == [""] and line != "":
        return []
    return parts


_NUM = re.compile(r"^[+-]?(NaN|Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)[fFdD]?$")


def jdouble(s: str):
    s = jtrim(s)
    if not _NUM.match(s):
        return None
    s = s.rstrip("fFdD") if not s.endswith("Infinity") and not s.endswith("NaN") else s
    return float(s.replace("Infinity", "inf"))


def jint(s: str):
    s = jtrim(s)
    return int(s) if re.fullmatch(r"[+-]?\d+", s) else None


def movies(lines):
    out = {}
    for line in lines:
        if "," not in line:
            continue
        stripped = line.rstrip(",")
        f = jsplit(line)
        if len(f) >= 3:
            title = jtrim(stripped[stripped.index(",") + 1 : stripped.rindex(",")])
            genres = jtrim(f[-1])
        elif len(f) == 2:
            title, genres = jtrim(f[1]), None
        else:
            title, genres = "", None
        mid = jtrim(f[0]) if f else ""
        prev = out.get(mid)
        if prev is None:
            out[mid] = (title, genres)
        else:
            g = [x for x in (prev[1], genres) if x is not None]
            out[mid] = (max(prev[0], title), max(g) if g else None)
    return out


def ratings(lines):
    out = []
    for line in lines:
        f = jsplit(line)
        if len(f) >= 3:
            out.append((jtrim(f[0]), jtrim(f[1]), jdouble(f[2])))
    return out


def users(lines):
    gender, age = {}, {}
    for line in lines:
        f = jsplit(line)
        if len(f) >= 2:
            gender[jtrim(f[0])] = jtrim(f[1])
        if len(f) >= 3:
            a = jint(f[2])
            if a is not None:
                age[jtrim(f[0])] = a
    return gender, age


def _avg(vals):
    return sum(vals) / len(vals) if vals else None


def q1(mv, rt):
    by = defaultdict(list)
    for _, m, r in rt:
        if r is not None:
            by[m].append(r)
    return {m: (mv.get(m, ("Unknown Movie",))[0], _avg(v), len(v)) for m, v in by.items()}


def q2(mv, rt, min_support=5):
    best = None
    for m, (title, avg, n) in sorted(q1(mv, rt).items()):
        if n >= min_support and not math.isnan(avg) and (best is None or avg > best[2]):
            best = (m, title, avg, n)
    return best


def q3(mv, rt):
    by = defaultdict(list)
    for _, m, r in rt:
        if r is not None:
            by[m].append(r)
    acc = defaultdict(lambda: [0.0, 0])
    for m, vals in by.items():
        genres = mv.get(m, (None, None))[1]
        if not genres or genres == "(no genres listed)":
            continue
        for g in jsplit(genres, "|"):
            acc[jtrim(g)][0] += sum(vals)
            acc[jtrim(g)][1] += len(vals)
    return {g: (s / n, n) for g, (s, n) in acc.items()}


def _seg_gender(g):
    if g is None:
        return None
    if g.upper() in ("M", "MALE") or g == "1":
        return "male"
    if g.upper() in ("F", "FEMALE") or g == "0":
        return "female"
    return None


def _band(a):
    return "0-18" if a <= 18 else "18-35" if a <= 35 else "35-50" if a <= 50 else "50+"


def by_segment(mv, rt, seg_of, labels):
    acc = defaultdict(lambda: defaultdict(list))
    for u, m, r in rt:
        s = seg_of(u)
        if s in labels and r is not None:
            acc[m][s].append(r)
    return {
        m: (mv.get(m, ("Unknown Movie",))[0], *[_avg(d[lab]) for lab in labels])
        for m, d in acc.items()
        if any(d[lab] for lab in labels)
    }


def q4(mv, rt, gender):
    return by_segment(mv, rt, lambda u: _seg_gender(gender.get(u)), ("male", "female"))


def q5(mv, rt, age):
    return by_segment(mv, rt, lambda u: _band(age[u]) if u in age else None, ("0-18", "18-35", "35-50", "50+"))
