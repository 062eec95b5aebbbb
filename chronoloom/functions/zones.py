"""Zone transition tables for vectorised conversion of local times."""

from __future__ import annotations

import functools
import re
import zoneinfo
from datetime import UTC, datetime, timedelta

import numpy as np

#: Years that the tables cover; before them the first known offset holds. From the last one on the rules of a zone repeat
#: with the calendar, every 400 years.
FIRST_YEAR, LAST_YEAR = 1900, 2100
CYCLE = 146_097 * 86_400
#: Names of zones in texts.
SPOKEN = {
    "北京时间": "Asia/Shanghai", "北京時間": "Asia/Shanghai", "美东时间": "America/New_York", "美東時間": "America/New_York", "美西时间": "America/Los_Angeles",
    "东京时间": "Asia/Tokyo", "東京時間": "Asia/Tokyo", "日本时间": "Asia/Tokyo", "日本時間": "Asia/Tokyo", "首尔时间": "Asia/Seoul", "韩国时间": "Asia/Seoul",
    "格林尼治时间": "UTC", "格林威治时间": "UTC", "世界协调时": "UTC", "伦敦时间": "Europe/London", "莫斯科时间": "Europe/Moscow", "香港时间": "Asia/Hong_Kong", "台北时间": "Asia/Taipei",
}
#: Abbreviations, in minutes east of UTC.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "BST": 60, "WEST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120, "EET": 120, "EEST": 180, "MSK": 180, "HKT": 480, "SGT": 480, "JST": 540, "KST": 540,
    "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780, "EST": -300, "EDT": -240, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}

_OFFSET = re.compile(r"^(?:UTC|GMT)?([+-])(\d{1,2})(?::?(\d{2}))?$")


@functools.cache
def version() -> str:
    """The release of the zone rules in use, where it says so."""
    for folder in zoneinfo.TZPATH:
        try:
            with open(f"{folder}/tzdata.zi") as f:
                return f.readline().strip().removeprefix("# version ")
        except OSError:
            continue
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "unknown"


@functools.lru_cache(maxsize=2048)
def table(zone: str, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> tuple[np.ndarray, np.ndarray] | None:
    """Local seconds from which each offset holds, and the offsets in seconds; None for an unknown zone.

    A local time that occurs twice belongs to the first occurrence and one that is skipped to the offset in force
    before the change: in both cases the older offset holds up to the later of the two local times of the change.
    """
    fixed = offset_minutes(zone)
    if fixed is not None:
        return np.array([-(2**62)]), np.array([fixed * 60])
    try:
        rules = zoneinfo.ZoneInfo(zone)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        return None
    at = lambda t: int(datetime.fromtimestamp(t, UTC).astimezone(rules).utcoffset().total_seconds())
    t, end = (int(datetime(year, 1, 1, tzinfo=UTC).timestamp()) for year in (first_year, last_year))
    step = int(timedelta(days=12).total_seconds())
    before = at(t)
    starts, offsets = [-(2**62)], [before]
    while t < end:
        after = at(t + step)
        if after != before:
            lo, hi = t, t + step
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if at(mid) == before else (lo, mid)
            starts.append(hi + max(before, after))
            offsets.append(after)
        before = after
        t += step
    return np.array(starts), np.array(offsets)


def offset_minutes(zone: str) -> int | None:
    """Minutes east of UTC of an offset or a known abbreviation, else None."""
    if zone in ABBREVIATIONS:
        return ABBREVIATIONS[zone]
    m = _OFFSET.match(zone)
    if not m or int(m[2]) > 14 or int(m[3] or 0) > 59:
        return None
    return (int(m[2]) * 60 + int(m[3] or 0)) * (1 if m[1] == "+" else -1)


def to_utc(local: np.ndarray, zone: str) -> np.ndarray | None:
    """Seconds of UTC of local seconds since 1970; None for an unknown zone."""
    found = table(zone)
    if found is None:
        return None
    starts, offsets = found
    out = local - offsets[np.searchsorted(starts, local, side="right") - 1]
    begin = int(datetime(LAST_YEAR, 1, 1, tzinfo=UTC).timestamp())
    far = np.flatnonzero(local >= begin)
    if len(far):
        starts, offsets = table(zone, LAST_YEAR - 1, LAST_YEAR + 401)
        out[far] = local[far] - offsets[np.searchsorted(starts, begin + (local[far] - begin) % CYCLE, side="right") - 1]
    return out
