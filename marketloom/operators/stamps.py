"""Text stamps of many forms and zones to one unambiguous form.

Each text is reduced to a character-class shape mask (``9`` digit, ``a`` letter, everything
else itself). Every distinct mask is compiled to a parser once and all texts of a mask are
converted together on a code-point matrix; clock readings become instants through zone
transition tables that carry the version of the zone data they were built from. The whole
operator is one Arrow map without a shuffle.

Defined results: null, empty, blank and unreadable texts (impossible dates, unknown zones or
abbreviations, two-digit years) give null. Digits finer than microseconds are cut off. A clock
reading that occurs twice means the earlier instant; a skipped one is read with the offset in
force before the change. Rows are never dropped or multiplied.
"""

from __future__ import annotations

import datetime as dt
import re
import zoneinfo
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_US = 86_400_000_000
INDIA = "Asia/Kolkata"

# English month and weekday names, and what zone abbreviations mean in minutes.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "IST": 330, "BST": 60, "CET": 60, "CEST": 120, "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "SGT": 480, "HKT": 480, "JST": 540,
}

_MONTH_NUMBER = {name[:n]: i for i, name in enumerate(MONTHS, 1) for n in (3, len(name))} | {"sept": 9}
_WEEKDAY_NAMES = {name[:n] for name in WEEKDAYS for n in (3, len(name))}

_DATE = (
    r"(?P<y>9999)(?P<s1>[-/.])(?P<m>99?)(?P=s1)(?P<d>99?)",
    r"(?P<d>99?)(?P<s1>[-/.])(?P<m>99?)(?P=s1)(?P<y>9999)",
    r"(?P<d>99?)[- ](?P<mon>a{3,9})(?:[- ]|, )(?P<y>9999)",
    r"(?P<mon>a{3,9}) (?P<d>99?),? (?P<y>9999)",
    r"(?P<y>9999)(?P<m>99)(?P<d>99)",
)
_TIME = (
    r"",
    r"(?:(?P<t>a)| |, )(?P<H>99?):(?P<M>99)(?::(?P<S>99)(?:[.,](?P<f>9+))?)?(?: ?(?P<ap>aa))?",
    r"(?P<t>a)(?P<H>99)(?P<M>99)(?:(?P<S>99)(?:[.,](?P<f>9+))?)?",
)
_ZONE = (
    r"",
    r" ?(?P<sign>[-+])(?P<oh>99)(?::?(?P<om>99))?",
    r" ?(?P<z>a)",
    r" (?P<abbr>a{3,4})",
    r" (?P<iana>a[a_]*(?:/[a_9+-]+)+)",
)
_LAYOUTS = [
    re.compile(rf"(?:(?P<wd>a{{3,9}}),? )?{d}{t}{z}")
    for d in _DATE
    for t in _TIME
    for z in (_ZONE if t else _ZONE[:1])
]


@lru_cache(maxsize=4096)
def compile_mask(mask: str) -> dict[str, tuple[int, int]] | None:
    """Where each part stands in texts of this mask; None where no parser fits."""
    if re.fullmatch(r"9{9,11}|9{12,14}|9{15,17}", mask):
        return {"epoch": (0, len(mask))}
    for layout in _LAYOUTS:
        if m := layout.fullmatch(mask):
            return {k: m.span(k) for k, v in m.groupdict().items() if v is not None}
    return None


def zone_data_version() -> str:
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        pass
    for root in zoneinfo.TZPATH:
        try:
            with open(f"{root}/tzdata.zi") as f:
                return f.readline().rsplit(" ", 1)[-1].strip()
        except OSError:
            continue
    return "unknown"


#: The end of zone tables (the year 2500), and the seconds in 400 years.
_ZONES_END, _CYCLE = 16_725_225_600, 146_097 * 86_400


def _repeated(seconds: np.ndarray) -> np.ndarray:
    return seconds - np.maximum(-(-(seconds - _ZONES_END + 1) // _CYCLE), 0) * _CYCLE


@lru_cache(maxsize=1024)
def zone_table(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(transition instants, wall thresholds, offsets) in seconds from 1900 to 2500; None for no such zone.

    Times after 2500 are read in the year 400 years (or a multiple) before, as the calendar and with
    it the last rule of every zone repeats; times before 1900 take the first offset.

    ``offsets[i]`` holds from transition ``i - 1`` on. A wall reading uses the offset after a
    change only from ``instant + max(before, after)`` on, so readings that occur twice or were
    skipped take the offset before it.
    """
    try:
        zone = zoneinfo.ZoneInfo(name)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        return None

    def offset(s: int) -> int:
        at = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)
        return int(zone.utcoffset(at.astimezone(zone)).total_seconds())

    step, lo, end = 7 * 86400, -2_208_988_800, _ZONES_END
    at, offsets, before = [], [offset(lo)], offset(lo)
    for a in range(lo, end, step):
        b = a + step
        after = offset(b)
        while before != after:
            x, y = a, b
            while y - x > 1:
                mid = (x + y) // 2
                x, y = (mid, y) if offset(mid) == before else (x, mid)
            at.append(y)
            before, a = offset(y), y
            offsets.append(before)
    instants, offs = np.array(at, np.int64), np.array(offsets, np.int64)
    return instants, instants + np.maximum(offs[:-1], offs[1:]), offs


def wall_to_utc(wall_us: np.ndarray, name: str) -> tuple[np.ndarray, bool]:
    found = zone_table(name)
    if found is None:
        return wall_us, False
    _, walls, offsets = found
    return wall_us - offsets[np.searchsorted(walls, _repeated(wall_us // 1_000_000), side="right")] * 1_000_000, True


def utc_to_wall(utc_us: np.ndarray, name: str) -> np.ndarray:
    instants, _, offsets = zone_table(name)
    return utc_us + offsets[np.searchsorted(instants, _repeated(utc_us // 1_000_000), side="right")] * 1_000_000


def _number(codes: np.ndarray, span: tuple[int, int]) -> np.ndarray:
    out = np.zeros(len(codes), np.int64)
    for j in range(*span):
        out = out * 10 + (codes[:, j].astype(np.int64) - 48)
    return out


def _words(codes: np.ndarray, span: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a slot and each row's index into them."""
    a, b = span
    return np.unique(np.ascontiguousarray(codes[:, a:b]).view(f"U{b - a}").ravel(), return_inverse=True)


def _by_word(codes: np.ndarray, span: tuple[int, int], of: dict) -> tuple[np.ndarray, np.ndarray]:
    words, at = _words(codes, span)
    got = [of.get(w) for w in words.tolist()]
    return np.array([g if g is not None else 0 for g in got], np.int64)[at], np.array([g is not None for g in got])[at]


_T_MARKS = {"T": 1, "t": 1}
_LOWER_MONTH = {v: n for k, n in _MONTH_NUMBER.items() for v in (k, k.title(), k.upper())}
_LOWER_WEEKDAY = {v: 1 for k in _WEEKDAY_NAMES for v in (k, k.title(), k.upper())}
_HALVES = {"AM": 0, "am": 0, "Am": 0, "PM": 12, "pm": 12, "Pm": 12}
_ZULU = {"Z": 0, "z": 0}


def _convert(texts: list[str], part: dict[str, tuple[int, int]], zones: list[str | None] | None, dates: bool) -> tuple[np.ndarray, np.ndarray]:
    """(microseconds or days, readable) of texts that share one mask."""
    n, width = len(texts), len(texts[0])
    codes = np.array(texts, f"U{width}").view(np.uint32).reshape(n, width)
    ok, zoned = np.ones(n, bool), True
    if "epoch" in part:
        utc = _number(codes, part["epoch"]) * (1_000_000 if width <= 11 else 1_000 if width <= 14 else 1)
    else:
        y, d = _number(codes, part["y"]), _number(codes, part["d"])
        if "mon" in part:
            m, ok = _by_word(codes, part["mon"], _LOWER_MONTH)
        else:
            m = _number(codes, part["m"])
        for slot, of in (("wd", _LOWER_WEEKDAY), ("t", _T_MARKS)):
            if slot in part:
                ok = ok & _by_word(codes, part[slot], of)[1]
        ok = ok & (m >= 1) & (m <= 12) & (d >= 1) & (y >= 1)
        month = ((y - 1970) * 12 + np.where(ok, m, 1) - 1).astype("datetime64[M]")
        first = month.astype("datetime64[D]").astype(np.int64)
        ok = ok & (d <= (month + 1).astype("datetime64[D]").astype(np.int64) - first)
        days, us = first + d - 1, np.zeros(n, np.int64)
        if "H" in part:
            h, mi = _number(codes, part["H"]), _number(codes, part["M"])
            s = _number(codes, part["S"]) if "S" in part else 0
            if "ap" in part:
                half, known = _by_word(codes, part["ap"], _HALVES)
                ok = ok & known & (h >= 1) & (h <= 12)
                h = h % 12 + half
            ok = ok & (h < 24) & (mi < 60) & (s < 60)
            us = ((h * 60 + mi) * 60 + s) * 1_000_000
            if "f" in part:
                a, b = part["f"]
                b = min(b, a + 6)
                us = us + _number(codes, (a, b)) * 10 ** (6 - (b - a))
        wall = days * DAY_US + us
        utc, zoned = wall, False
        if "sign" in part:
            oh = _number(codes, part["oh"])
            om = _number(codes, part["om"]) if "om" in part else 0
            minus = codes[:, part["sign"][0]] == ord("-")
            utc, zoned = wall - np.where(minus, -1, 1) * (oh * 60 + om) * 60_000_000, True
            ok = ok & (oh <= 18) & (om < 60)
        elif "z" in part or "abbr" in part:
            minutes, known = _by_word(codes, part["z"], _ZULU) if "z" in part else _by_word(codes, part["abbr"], ABBREVIATIONS)
            utc, ok, zoned = wall - minutes * 60_000_000, ok & known, True
        elif "iana" in part:
            names, at = _words(codes, part["iana"])
            utc, zoned = wall.copy(), True
            for k, name in enumerate(names.tolist()):
                rows = at == k
                utc[rows], known = wall_to_utc(wall[rows], name)
                ok = ok & (known | ~rows)
        elif not dates and zones is not None:
            names, at = np.unique(np.array([z or "" for z in zones]), return_inverse=True)
            utc = wall.copy()
            for k, name in enumerate(names.tolist()):
                if name.strip():
                    rows = at == k
                    utc[rows], known = wall_to_utc(wall[rows], name.strip())
                    ok = ok & (known | ~rows)
        if dates and not zoned:
            return days, ok
    return (utc_to_wall(utc, INDIA) // DAY_US if dates else utc), ok


def parse_batch(text: pa.Array, zone: pa.Array | None, dates: bool) -> tuple[np.ndarray, np.ndarray]:
    """(values, readable) of one Arrow column: microseconds UTC, or days where dates are asked for."""
    n = len(text)
    values, ok = np.zeros(n, np.int64), np.zeros(n, bool)
    if n == 0:
        return values, ok
    trimmed = pc.utf8_trim_whitespace(text)
    masks = pc.replace_substring_regex(pc.replace_substring_regex(trimmed, "[0-9]", "9"), "[A-Za-z]", "a").dictionary_encode()
    index = pc.fill_null(masks.indices, -1).to_numpy(zero_copy_only=False)
    order = np.argsort(index, kind="stable")
    bounds = np.searchsorted(index[order], np.arange(len(masks.dictionary) + 1))
    for k, mask in enumerate(masks.dictionary.to_pylist()):
        if (part := compile_mask(mask)) is None:
            continue
        rows = order[bounds[k] : bounds[k + 1]]
        take = pa.array(rows)
        values[rows], ok[rows] = _convert(trimmed.take(take).to_pylist(), part, zone.take(take).to_pylist() if zone is not None else None, dates)
    return values, ok


def _as_text(values: np.ndarray, ok: np.ndarray, dates: bool) -> pa.Array:
    safe = np.where(ok, values, 0)
    if dates:
        out = np.datetime_as_string(safe.astype("datetime64[D]"), unit="D")
    else:
        out = np.char.add(np.datetime_as_string(safe.astype("datetime64[us]"), unit="us"), "Z")
    return pa.array(out.tolist(), pa.string(), mask=~ok)


def normalise(df: DataFrame, text_col: str, out_col: str, zone_col: str | None = None, dates: bool = False, as_text: bool = True) -> DataFrame:
    """df with out_col added: the stamp in ``text_col`` as ``YYYY-MM-DDTHH:MM:SS.ffffffZ`` (``dates``: the
    Indian calendar date ``YYYY-MM-DD``), or as a long of microseconds (days) where ``as_text`` is false.

    ``zone_col`` names the zone used where a text has none (null or blank: UTC). An existing
    column called ``out_col`` is replaced.
    """
    keep = [c for c in df.columns if c != out_col]
    df = df.select(*(F.col(f"`{c}`") for c in keep))
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType() if as_text else T.LongType())])
    version = zone_data_version()

    def run(batches):
        if zone_data_version() != version:
            raise RuntimeError(f"zone data {zone_data_version()} here, {version} on the driver")
        for b in batches:
            text, zone = b.column(keep.index(text_col)), b.column(keep.index(zone_col)) if zone_col else None
            values, ok = parse_batch(text.cast(pa.string()), zone, dates)
            new = _as_text(values, ok, dates) if as_text else pa.array(values, pa.int64(), mask=~ok)
            yield pa.RecordBatch.from_arrays([*b.columns, new], names=[*keep, out_col])

    return df.mapInArrow(run, schema)
