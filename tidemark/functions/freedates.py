"""Dates as people write them, in English, Korean and Japanese: month names, partial dates, relative days.

A text counts only if all of it is a date (weekdays and times of day beside it are passed over), so
prose gives null. Each form is a pattern over the whole text and an expression for the day; the
first form that fits and names a real day counts. All of it is native and reads no state.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, filled, let

# Names of months by their first three letters, of relative days, and of units of time in days, hours or months.
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\\.?"
NEAR = {
    "today": 0, "yesterday": -1, "tomorrow": 1, "day before yesterday": -2, "the day before yesterday": -2, "day after tomorrow": 2, "the day after tomorrow": 2,
    "오늘": 0, "어제": -1, "내일": 1, "그저께": -2, "그제": -2, "엊그제": -2, "모레": 2, "내일모레": 2, "글피": 3,
    "今日": 0, "本日": 0, "きょう": 0, "昨日": -1, "きのう": -1, "明日": 1, "あした": 1, "一昨日": -2, "おととい": -2, "明後日": 2, "あさって": 2,
}
_UNITS = {
    "second": "SECOND", "sec": "SECOND", "minute": "MINUTE", "min": "MINUTE", "hour": "HOUR", "hr": "HOUR", "day": "DAY", "week": "WEEK", "month": "MONTH", "year": "YEAR",
    "초": "SECOND", "분": "MINUTE", "시간": "HOUR", "일": "DAY", "주": "WEEK", "주일": "WEEK", "개월": "MONTH", "달": "MONTH", "년": "YEAR",
    "秒": "SECOND", "分": "MINUTE", "時間": "HOUR", "日": "DAY", "週間": "WEEK", "か月": "MONTH", "ヶ月": "MONTH", "カ月": "MONTH", "年": "YEAR",
}
_ERAS = {"令和": 2018, "平成": 1988}
_WEEKDAY = r"(?:mon|tue(?:s)?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?|[월화수목금토일]요일|[月火水木金土日]曜日?"
_CLOCK = r"(?:(?:오전|오후|午前|午後)\s*)?(?:\d{1,2}\s*(?:시|時)(?!간|間)(?:\s*\d{1,2}\s*(?:분|分))?|\d{1,2}:\d{2}(?::\d{2})?(?:\.\d+)?\s*(?:[ap]\.?m\.?)?)(?:\s*(?:utc|gmt|kst|jst|z))?"
#: Whether the first of two numbers before a year is the month or the day.
MONTH_FIRST, DAY_FIRST = "MDY", "DMY"


def _bare(text: Column) -> Column:
    """Lower case, without weekdays and times of day, and with full-width digits as plain ones."""
    plain = F.translate(F.lower(collapse(filled(text))), "０１２３４５６７８９：．／（）", "0123456789:./()")
    kept = F.regexp_replace(plain, rf"\((?:{_WEEKDAY}|[월화수목금토일月火水木金土日])\)|(?<![a-z])(?:{_WEEKDAY})(?![a-z])[,.]?", " ")
    kept = F.regexp_replace(kept, rf"(?<=\d)t(?=\d\d:)|(?:\bat\s+)?(?<!\d){_CLOCK}(?![\d:])(?!\s*(?:ago|전|前))", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(collapse(kept), r"^[,.\s]+|[,\s]+$", "")), r"\s*(まで|부터|까지|から)$", "")


def _day(year: Column, month: Column, day: Column) -> Column:
    two = F.length(year) <= 2
    whole = F.when(two, year.try_cast("int") + F.when(year.try_cast("int") < 69, 2000).otherwise(1900)).otherwise(year.try_cast("int"))
    return F.try_to_date(F.concat_ws("-", F.lpad(whole.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")


def _named(name: Column) -> Column:
    return ((F.instr(F.lit(_MONTHS), F.substring(name, 1, 3)) + 2) / 3).cast("int")


def _without_year(month: Column, day: Column, base: Column, prefer: str) -> Column:
    """A day of the base's year, or the last one before it or first one after it."""
    year = F.year(base)
    own = _day(year.cast("string"), month, day)
    if prefer == "past":
        return F.when(own > F.to_date(base), _day((year - 1).cast("string"), month, day)).otherwise(own)
    if prefer == "future":
        return F.when(own < F.to_date(base), _day((year + 1).cast("string"), month, day)).otherwise(own)
    return own


def _moved(base: Column, number: Column, unit: Column, sign: int) -> Column:
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in _UNITS.items() for x in pair]), unit)
    n = number.try_cast("int") * sign
    at = base.cast("timestamp")
    moved = F.coalesce(
        F.when(kind.isin("SECOND", "MINUTE", "HOUR"), F.timestamp_seconds(F.unix_timestamp(at) + n * F.when(kind == "SECOND", 1).when(kind == "MINUTE", 60).otherwise(3600))),
        F.when(kind.isin("DAY", "WEEK"), F.date_add(F.to_date(at), n * F.when(kind == "WEEK", 7).otherwise(1)).cast("timestamp")),
        F.add_months(F.to_date(at), n * F.when(kind == "YEAR", 12).otherwise(1)).cast("timestamp"),
    )
    return F.to_date(moved)


def free_date(text: Column, base: Column, *, order: str = MONTH_FIRST, prefer: str = "current") -> Column:
    """The day that a text is, seen from base (a timestamp); null if it is none, or no real one.

    order: how 3/5/2026 is read (the other way where only that is a real day); prefer: ``current``,
    ``past`` or ``future`` for a day without a year.
    """
    if order not in (MONTH_FIRST, DAY_FIRST) or prefer not in ("current", "past", "future"):
        raise ValueError("order is MDY or DMY; prefer is current, past or future")
    number, th, sep = r"(\d{1,2})", r"(?:st|nd|rd|th)?", r"[\s.,/-]*"
    units = "|".join(sorted(_UNITS, key=len, reverse=True))

    def read(t: Column) -> Column:
        g = lambda p, i: F.regexp_extract(t, p, i)
        whole = lambda p: rf"^{p}$"

        def form(pattern: str, value) -> Column:
            p = whole(pattern)
            return F.when(t.rlike(p), value(lambda i: g(p, i)))

        def numbers(x: Column, y: Column, year: Column) -> Column:
            one, two = _day(year, x, y), _day(year, y, x)
            return F.coalesce(one, two) if order == MONTH_FIRST else F.coalesce(two, one)

        near = F.element_at(F.create_map(*[F.lit(x) for pair in NEAR.items() for x in pair]), t)
        era = F.create_map(*[F.lit(x) for pair in _ERAS.items() for x in pair])
        one = lambda v: F.when(v.isin("a", "an", "one"), "1").otherwise(v)
        return F.coalesce(
            F.date_add(F.to_date(base), near),
            form(rf"(\d{{4}})\s*[-./年년]\s*{number}\s*[-./月월]\s*{number}\s*[.日일]?", lambda k: _day(k(1), k(2), k(3))),
            form(rf"'?(\d{{2}})\s*[년年]\s*{number}\s*[월月]\s*{number}\s*[일日]", lambda k: _day(k(1), k(2), k(3))),
            form(rf"(令和|平成)\s*(\d{{1,2}}|元)\s*年\s*{number}\s*月\s*{number}\s*日", lambda k: _day((F.element_at(era, k(1)) + F.when(k(2) == "元", 1).otherwise(k(2).try_cast("int"))).cast("string"), k(3), k(4))),
            form(rf"{number}\s*[월月]\s*{number}\s*[일日]", lambda k: _without_year(k(1), k(2), base, prefer)),
            form(rf"{_MONTH}{sep}{number}{th}{sep}(\d{{4}})", lambda k: _day(k(3), _named(k(1)), k(2))),
            form(rf"{number}{th}(?:\s+of)?{sep}{_MONTH}{sep}(\d{{4}})", lambda k: _day(k(3), _named(k(2)), k(1))),
            form(rf"(\d{{4}}){sep}{_MONTH}{sep}{number}{th}", lambda k: _day(k(1), _named(k(2)), k(3))),
            form(rf"{_MONTH}{sep}{number}{th}", lambda k: _without_year(_named(k(1)), k(2), base, prefer)),
            form(rf"{number}{th}(?:\s+of)?{sep}{_MONTH}", lambda k: _without_year(_named(k(2)), k(1), base, prefer)),
            form(rf"{number}\s*[./-]\s*{number}\s*[./-]\s*(\d{{4}}|\d{{2}})", lambda k: numbers(k(1), k(2), k(3))),
            form(r"(\d{4})(\d{2})(\d{2})", lambda k: _day(k(1), k(2), k(3))),
            form(rf"(\d+|an?|one)\s*({units})s?\s*(?:ago|전|前)", lambda k: _moved(base, one(k(1)), k(2), -1)),
            form(rf"(?:in\s+)(\d+|an?|one)\s*({units})s?", lambda k: _moved(base, one(k(1)), k(2), 1)),
            form(rf"(\d+)\s*({units})\s*(?:후|뒤|後)", lambda k: _moved(base, k(1), k(2), 1)),
        )

    return let(_bare(text), read)
