"""Dates and times of many notations, precisions and zones brought to one form."""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.functions import zones

#: Names of months, first letters enough to tell them apart, in English and German.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "mär": 3, "apr": 4, "may": 5, "mai": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "okt": 10, "nov": 11, "dec": 12, "dez": 12,
}
MONTH = r"(?P<mon>jan(?:uary|uar)?|feb(?:ruary|ruar)?|mar(?:ch)?|märz?|apr(?:il)?|may|mai|june?|juni|july?|juli|aug(?:ust)?|sept?(?:ember)?|o[ck]t(?:ober)?|nov(?:ember)?|de[cz](?:ember)?)\.?"
#: First years of eras, minus one.
ERAS = {"民國": 1911, "民国": 1911, "令和": 2018, "平成": 1988, "昭和": 1925}
#: Days from the reference date.
DAYS = {
    "昨日": -1, "昨天": -1, "前天": -2, "前日": -2, "今日": 0, "今天": 0, "当天": 0, "當天": 0, "当日": 0, "當日": 0, "同日": 0, "同一天": 0, "次日": 1, "翌日": 1, "隔天": 1, "第二天": 1, "明天": 1, "明日": 1, "后天": 2, "後天": 2,
    "yesterday": -1, "today": 0, "tomorrow": 1, "gestern": -1, "heute": 0, "morgen": 1, "vorgestern": -2, "übermorgen": 2, "the day before yesterday": -2, "the day after tomorrow": 2,
}
YEARS = {"前年": -2, "去年": -1, "今年": 0, "本年": 0, "明年": 1, "last year": -1, "this year": 0, "next year": 1}
#: The month that a part of a year begins with.
YEAR_PARTS = {"初": 1, "底": 12, "末": 12}
DIGITS = {c: str(i) for i, c in enumerate("〇一二三四五六七八九")} | {"零": "0"}

CLOCK = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,]\d+)?)?"
HALF = r"(?P<half>a\.?m\.?|p\.?m\.?)"
ABBR = r"(?P<abbr>Z|[A-Z]{3,4})"
PARSERS = {
    "iso": rf"(?P<y>\d{{4}})[-/.](?P<m>\d{{1,2}})[-/.](?P<d>\d{{1,2}})(?:[T ]\s*{CLOCK}\s*(?:(?P<off>[+-]\d{{2}}:?\d{{2}})|{ABBR})?\s*(?:\[(?P<zone>[A-Za-z0-9_/+-]+)\])?)?",
    "compact": rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})(?:T?(?P<h>\d{{2}})(?P<mi>\d{{2}})(?P<s>\d{{2}})(?:(?P<off>[+-]\d{{2}}:?\d{{2}})|{ABBR})?)?",
    "epoch": r"(?P<epoch>\d{10}|\d{13})",
    "slashes": rf"(?P<a>\d{{1,2}})/(?P<b>\d{{1,2}})/(?P<y>\d{{4}})(?:,? {CLOCK}(?: ?{HALF})?(?: {ABBR})?)?",
    "dots": rf"(?P<d>\d{{1,2}})\.(?P<m>\d{{1,2}})\.(?P<y>\d{{4}})(?:,? {CLOCK}(?: Uhr)?(?: {ABBR})?)?",
    "day_first": rf"(?:[a-zä]{{2,9}}\.?, )?(?P<d>\d{{1,2}})(?:st|nd|rd|th|\.)? {MONTH},? (?P<y>\d{{4}})(?:,?(?: at| um)? {CLOCK}(?: ?{HALF})?(?: Uhr)?(?: ?(?:(?P<off>[+-]\d{{2}}:?\d{{2}})|{ABBR}))?)?",
    "month_first": rf"{MONTH} (?P<d>\d{{1,2}})(?:st|nd|rd|th)?, (?P<y>\d{{4}})(?:,?(?: at)? {CLOCK}(?: ?{HALF})?(?: {ABBR})?)?",
    "month_year": rf"{MONTH} (?P<y>\d{{4}})",
    "cjk": (
        rf"(?P<said>{'|'.join(zones.SPOKEN)})?(?:(?P<era>{'|'.join(ERAS)})(?P<ey>\d{{1,3}}|元)年|(?P<y>\d{{4}})年|(?P<rel>{'|'.join(k for k in YEARS if k[0] > 'z')}))?"
        r"(?:(?P<m>\d{1,2})月(?:份|(?P<d>\d{1,2})[日号號])?|(?P<part>初|底|末)|全年)?"
        rf"(?:(?<=[日号號])(?P<half>上午|下午|晚上?|凌晨|早上|中午|傍晚|午前|午後)?(?P<h>\d{{1,2}})(?:[:时時点點](?:(?P<mi>\d{{1,2}})(?:分|(?=$|:))?(?::?(?P<s>\d{{1,2}})秒?)?)?))?"
    ),
    "cjk_years": r"(?P<y>\d{4})年?[-至到](?P<y2>\d{4})年",
    "cjk_months": r"(?P<y>\d{4})年(?P<m>\d{1,2})月?[-至到](?:(?P<y2>\d{4})年)?(?P<m2>\d{1,2})月",
    "cjk_days": r"(?P<y>\d{4})年(?P<m>\d{1,2})月(?P<d>\d{1,2})[日号]?[-至到](?:(?P<y2>\d{4})年)?(?:(?P<m2>\d{1,2})月)?(?P<d2>\d{1,2})[日号]",
    "year_month": r"(?P<y>\d{4})[-./](?P<m>\d{1,2})",
    "year": r"(?P<y>\d{4})",
    "day_word": rf"(?P<word>{'|'.join(DAYS)})",
    "year_word": rf"(?P<rel>{'|'.join(YEARS)})",
}


@functools.cache
def _parser(name: str) -> re.Pattern:
    return re.compile(rf"^{PARSERS[name]}$", re.IGNORECASE if name not in ("iso", "compact") else 0)


def plain(text: str) -> str:
    """Width folded, blanks outside words removed, Chinese numerals as digits."""
    t = unicodedata.normalize("NFKC", text).strip()
    t = re.sub(r"\s+", " ", t)
    t = re.sub(r"[—–―~〜−]", "-", t)
    if not re.search(r"[〇一-鿿]", t):
        return t
    t = t.replace(" ", "")
    # 十 stands for one or more of: tens before it (none: one), units after it.
    t = re.sub(r"([一二三四五六七八九]?)十([一二三四五六七八九]?)(?=[月日号號时時点點分])", lambda m: f"{DIGITS.get(m[1], '1')}{DIGITS.get(m[2], '0')}", t)
    t = re.sub(r"(?<![第])[〇零一二三四五六七八九]+(?=[年月日号號时時点點分\d])", lambda m: "".join(DIGITS[c] for c in m[0]), t)
    return t


def mask(t: str) -> str:
    """The shape of a text: digits as 9 (runs keep their length), letters as a run, all else as it is."""
    return re.sub(r"[^\W\d_぀-ヿ㐀-鿿]+", "a", re.sub(r"\d", "9", t))


class Shapes:
    """Parsers by shape mask. A mask meets all parsers once, on the first text that has it; those that fit come first."""

    def __init__(self):
        self.known: dict[str, list[str]] = {}

    def parsers(self, shape: str, text: str) -> list[str]:
        if shape not in self.known:
            # The vocabulary of another text of this shape may fit a parser that the first one doesn't.
            self.known[shape] = sorted(PARSERS, key=lambda p: not _parser(p).match(text))
        return self.known[shape]


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 of proleptic Gregorian dates."""
    y = y - (m <= 2)
    era = np.floor_divide(y, 400)
    yoe = y - era * 400
    doy = (153 * (m + np.where(m > 2, -3, 9)) + 2) // 5 + d - 1
    return era * 146097 + yoe * 365 + yoe // 4 - yoe // 100 + doy - 719468


def _month_length(y: np.ndarray, m: np.ndarray) -> np.ndarray:
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    return np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.clip(m, 0, 12)] + ((m == 2) & leap)


def _valid(y, m, d) -> np.ndarray:
    return (y >= 1) & (y <= 9999) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= _month_length(y, m))


def _int(c: pd.Series | None, n: int, missing: int) -> np.ndarray:
    if c is None:
        return np.full(n, missing)
    return pd.to_numeric(c, errors="coerce").fillna(missing).astype("int64").to_numpy()


def _stamp(seconds: np.ndarray) -> np.ndarray:
    return np.char.add(seconds.astype("datetime64[s]").astype(str), "Z")


def parse_rows(frame: pd.DataFrame, shapes: Shapes) -> pd.DataFrame:
    """Adds ``norm`` and ``prec`` (null where no valid date or time is stated) to rows with ``matched_text``, ``zone``, ``lang``, ``ref_date``."""
    n = len(frame)
    distinct, which = np.unique(np.array([plain(t) if isinstance(t, str) else "" for t in frame["matched_text"]], object), return_inverse=True)
    norm, prec = np.full(n, None, object), np.full(n, None, object)
    ref = pd.to_datetime(frame["ref_date"].where(frame["ref_date"].notna(), None), format="%Y-%m-%d", errors="coerce")
    ref_year = ref.dt.year.fillna(0).astype("int64").to_numpy()
    ref_day = np.where(ref.notna(), ref.to_numpy().astype("datetime64[D]").astype("int64"), 0)
    has_ref = ref.notna().to_numpy()
    # Each mask leads to its parsers; each parser takes the texts of all its masks apart at once.
    taken: dict[str, list[tuple[int, tuple]]] = {}
    for i, t in enumerate(distinct.tolist()):
        for name in shapes.parsers(mask(t), t) if t else ():
            if found := _parser(name).match(t):
                taken.setdefault(name, []).append((i, found.groups()))
                break
    order = np.argsort(which, kind="stable")
    first = np.searchsorted(which[order], np.arange(len(distinct) + 1))
    for name, texts in taken.items():
        at = np.array([i for i, _ in texts])
        size = first[at + 1] - first[at]
        rows = order[np.repeat(first[at], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
        fields = pd.DataFrame([g for _, g in texts], columns=list(_parser(name).groupindex), dtype=object).iloc[np.repeat(np.arange(len(at)), size)].reset_index(drop=True)
        norm[rows], prec[rows] = _fields(name, fields, frame.iloc[rows], ref_year[rows], ref_day[rows], has_ref[rows])
    return frame.assign(norm=norm, prec=prec)


def _fields(name: str, f: pd.DataFrame, frame: pd.DataFrame, ref_year, ref_day, has_ref):
    """Normal forms and precisions of rows that one parser took apart, all at once."""
    n = len(f)
    none = lambda: np.full(n, None, object)
    col = lambda c: f[c] if c in f.columns else None
    given = lambda c: f[c].notna().to_numpy() if c in f.columns else np.zeros(n, bool)
    norm, prec = none(), none()
    if name == "epoch":
        digits = f["epoch"]
        sec = pd.to_numeric(digits).to_numpy() // np.where(digits.str.len().to_numpy() == 13, 1000, 1)
        return _stamp(sec).astype(object), np.full(n, "second", object)
    if name == "day_word":
        day = ref_day + f["word"].str.lower().map(DAYS).to_numpy()
        out = day.astype("datetime64[D]").astype(str).astype(object)
        out[~has_ref] = None
        return out, np.where(has_ref, "day", None)
    y = _int(col("y"), n, 0)
    if "rel" in f.columns:
        rel = given("rel")
        y = np.where(rel & has_ref, ref_year + f["rel"].str.lower().map(YEARS).fillna(0).astype("int64").to_numpy(), y)
    if "era" in f.columns:
        years = _int(f["ey"].replace("元", "1"), n, 0)
        y = np.where(given("era"), f["era"].map(ERAS).fillna(0).astype("int64").to_numpy() + years, y)
    m, d = _int(col("m"), n, 0), _int(col("d"), n, 0)
    has_m, has_d = given("m"), given("d")
    if "mon" in f.columns:
        m, has_m = f["mon"].str[:3].str.lower().map(MONTHS).fillna(0).astype("int64").to_numpy(), np.ones(n, bool)
    if name == "slashes":
        first, second = _int(f["a"], n, 0), _int(f["b"], n, 0)
        lang = frame["lang"].fillna("").to_numpy(dtype=object)
        month_first = np.array([x in ("en-US", "en") for x in lang])
        m, d = np.where(month_first, first, second), np.where(month_first, second, first)
        has_m = has_d = np.ones(n, bool)
    if "part" in f.columns:
        part = given("part")
        m = np.where(part, f["part"].map(YEAR_PARTS).fillna(0).astype("int64").to_numpy(), m)
        has_m = has_m | part
    # A missing year is that of the reference date; a text without year, month and day says nothing.
    has_y = given("y") | given("era") | (given("rel") & has_ref)
    no_year = ~has_y & ~given("rel") & has_m & has_d & has_ref if name == "cjk" else np.zeros(n, bool)
    y, has_y = np.where(no_year, ref_year, y), has_y | no_year
    ok = has_y & _valid(y, np.where(has_m, m, 1), np.where(has_d, d, 1))
    text = np.char.mod("%04d", y)
    text = np.where(has_m, np.char.add(text, np.char.mod("-%02d", m)), text)
    text = np.where(has_d, np.char.add(text, np.char.mod("-%02d", d)), text)
    if given("h").any():
        clock = given("h")
        sec, timed = _clock(f, n, y, m, d, ok & clock)
        utc, placed = _place(f, frame, sec, timed)
        good = timed & placed
        norm[good] = _stamp(utc[good])
        prec[good] = "second"
        ok = ok & ~clock
    norm[ok] = text[ok]
    prec[ok] = np.where(has_d, "day", np.where(has_m, "month", "year"))[ok]
    if name in ("cjk_years", "cjk_months", "cjk_days"):
        y2 = np.where(given("y2"), _int(col("y2"), n, 0), y)
        m2 = np.where(given("m2"), _int(col("m2"), n, 0), m) if name != "cjk_years" else np.ones(n, int)
        d2 = _int(col("d2"), n, 1) if name == "cjk_days" else np.ones(n, int)
        end = np.char.mod("%04d", y2)
        if name != "cjk_years":
            end = np.char.add(end, np.char.mod("-%02d", m2))
        if name == "cjk_days":
            end = np.char.add(end, np.char.mod("-%02d", d2))
        start_day = _days(y, np.where(has_m, m, 1), np.where(has_d, d, 1))
        both = ok & _valid(y2, m2, d2) & (_days(y2, m2, d2) >= start_day)
        norm = np.where(both, np.char.add(np.char.add(text.astype(str), "/"), end), None).astype(object)
        prec = np.where(both, prec, None)
    return norm, prec


def _clock(f: pd.DataFrame, n: int, y, m, d, ok) -> tuple[np.ndarray, np.ndarray]:
    """Local seconds since 1970, and whether the clock time exists on a twelve- or twenty-four-hour clock."""
    h, mi, s = (_int(f[c] if c in f.columns else None, n, 0) for c in ("h", "mi", "s"))
    fine = ok & (h <= 23) & (mi <= 59) & (s <= 59)
    if "half" in f.columns:
        half = f["half"].fillna("").str.lower().str.replace(".", "", regex=False).to_numpy(dtype=object)
        am = np.isin(half, ["am", "上午", "凌晨", "早上", "午前"])
        pm = np.isin(half, ["pm", "下午", "晚", "晚上", "傍晚", "午後"])
        noon = half == "中午"
        latin = np.isin(half, ["am", "pm"])
        fine &= ~(latin & ((h < 1) | (h > 12))) & ~(am & (h > 12))
        h = np.where(am & (h == 12), 0, h)
        h = np.where(pm & (h < 12), h + 12, h)
        h = np.where(noon & (h < 3), h + 12, h)
    return _days(y, m, d) * 86400 + h * 3600 + mi * 60 + s, fine


def _place(f: pd.DataFrame, frame: pd.DataFrame, sec: np.ndarray, timed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seconds of UTC by the zone that the text names, else by the row's zone; rows without any don't count."""
    n = len(f)
    zone = frame["zone"].fillna("").str.strip().to_numpy(dtype=object)
    for c in ("zone", "said", "abbr", "off"):
        if c in f.columns:
            named = f[c].notna().to_numpy()
            value = f[c].fillna("")
            value = value.map(zones.SPOKEN).fillna("") if c == "said" else value.str.upper() if c == "abbr" else value
            zone = np.where(named, value.to_numpy(dtype=object), zone)
    utc, placed = np.zeros(n, np.int64), np.zeros(n, bool)
    for z in set(zone[timed].tolist()):
        at = np.flatnonzero(timed & (zone == z))
        got = zones.to_utc(sec[at], z) if z else None
        if got is not None:
            utc[at], placed[at] = got, True
    return utc, placed


def normalize_times(candidates: DataFrame) -> DataFrame:
    """One unambiguous form for every stated date or time: ``cand_id``, ``normalized``, ``precision``.

    ``candidates``: ``cand_id``, ``matched_text``, ``zone``, ``lang``, ``ref_date`` (yyyy-mm-dd); other columns are
    ignored. Forms: ``yyyy``, ``yyyy-MM``, ``yyyy-MM-dd``, with a clock time the UTC instant ``yyyy-MM-ddTHH:mm:ssZ``
    (fractions cut off), ranges ``start/end``; ``precision`` is year, month, day or second. Dates without clock time
    keep their day. A zone in the text goes before ``zone``; a clock time with neither, vague words, impossible
    dates and null or blank texts give no row. A missing year is that of ``ref_date``, relative words count from it;
    they give no row if it is null or no date. Repeated rows count once; an empty table gives an empty result.

    The texts are masked to shapes, each shape meets the parsers once per task, and all rows of a parser are converted
    as vectors. Repeated rows collapse after that, in the only shuffle, of the short results.
    """
    rows = candidates.select("cand_id", "matched_text", "zone", "lang", F.col("ref_date").cast("string").alias("ref_date")).where("matched_text is not null")

    def work(frames):
        shapes = Shapes()
        for frame in frames:
            out = parse_rows(frame, shapes)
            out = out[out["norm"].notna()]
            yield pd.DataFrame({"cand_id": out["cand_id"], "normalized": out["norm"].astype(str), "precision": out["prec"].astype(str)})

    return rows.mapInPandas(work, "cand_id long, normalized string, precision string").distinct()
