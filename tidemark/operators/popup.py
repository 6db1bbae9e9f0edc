"""Pop-up shop notices: filters, operating period, place, articles on sale and verification flags, as native columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import real_date
from ..functions.text import collapse, filled, find_all, let

# Titles that are taken, and titles that only amend an earlier notice.
POPUP_TITLE = r"(pop\s*[-–—]?\s*up|popup|팝업|ポップアップ)"
SECONDARY_TITLE = (
    r"(update|updated|amend|amended|correction|corrected|change|changed|schedule\s+confirmed|opening\s+schedule|"
    r"postpone|postponed|cancel|cancelled|canceled|cancellation|t\s*&\s*c|terms\s+(and|&)\s+conditions|terms\s+conditions|"
    r"visitor'?s?\s+guide|visit\s+guide|operating\s+guide|operation\s+guide|operating\s+guidelines|reservation\s+guide|pickup\s+guide|pickup\s+reservation|"
    r"변경|수정|정정|추가\s*안내|일정\s*확정|일정\s*변경|운영\s*시간\s*변경|연기|취소|"
    r"利用規約|規約|変更|修正|訂正|延期|中止|追加\s*案内|追加のお知らせ|予約|受取|ピックアップ)"
)

# Where an operating period is told, and words that speak for or against a snippet.
PERIOD_MARKERS = (
    "운영 기간", "운영기간", "진행 기간", "진행기간", "행사 기간", "행사기간", "팝업 기간", "팝업기간", "기간", "일정", "운영 일시", "운영일시", "오픈 기간", "오픈기간",
    "operating period", "operation period", "event period", "popup period", "period", "dates", "date", "開催期間", "運営期間", "実施期間", "期間", "日程",
)
PERIOD_WORDS = (
    "운영 기간", "운영기간", "진행 기간", "진행기간", "행사 기간", "행사기간", "팝업 기간", "팝업기간",
    "operating period", "operation period", "event period", "popup period", "開催期間", "運営期間", "実施期間",
)
COMMERCE_WORDS = (
    "reservation", "pickup", "pre-order", "preorder", "online sales", "shipping", "delivery", "refund", "exchange",
    "예약", "수령", "픽업", "배송", "교환", "환불", "온라인", "販売", "予約", "配送", "交換", "返金",
)
_DAYS = "Mon|Tue|Wed|Thu|Fri|Sat|Sun|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday"
_DATE = r"(20\d{2})\s*[.\-/년]\s*(\d{1,2})\s*[.\-/월]\s*(\d{1,2})\s*(?:일)?"
_TO = r"\s*[~\-–—]\s*"
_MONTHS = "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
ENGLISH_RANGE = rf"({_MONTHS})\.?\s+(\d{{1,2}})(?:,\s*(20\d{{2}}))?\s*(?:~|-|–|—|to)\s*(?:({_MONTHS})\.?\s*)?(\d{{1,2}}),\s*(20\d{{2}})"
ENGLISH_DATE = rf"({_MONTHS})\.?\s+(\d{{1,2}}),\s*(20\d{{2}})"

# Places by what names them, country and place.
PLACES = {
    "the hyundai seoul": ("한국", "서울 더현대서울"), "더현대서울": ("한국", "서울 더현대서울"),
    "hyundai department store sinchon": ("한국", "서울 현대백화점 신촌"), "현대백화점 신촌": ("한국", "서울 현대백화점 신촌"),
    "lotte world mall": ("한국", "서울 잠실 롯데월드몰"), "롯데월드몰": ("한국", "서울 잠실 롯데월드몰"),
    "shinsegae gangnam": ("한국", "서울 신세계백화점 강남"), "신세계백화점 강남": ("한국", "서울 신세계백화점 강남"),
    "seoul": ("한국", "서울"), "서울": ("한국", "서울"), "hongdae": ("한국", "서울 홍대"), "홍대": ("한국", "서울 홍대"),
    "yongsan": ("한국", "서울 용산"), "용산": ("한국", "서울 용산"),
    "seongsu": ("한국", "서울 성수"), "sungsu": ("한국", "서울 성수"), "성수": ("한국", "서울 성수"),
    "jamsil": ("한국", "서울 잠실"), "잠실": ("한국", "서울 잠실"), "gangnam": ("한국", "서울 강남"), "강남": ("한국", "서울 강남"),
    "daegu": ("한국", "대구"), "대구": ("한국", "대구"), "exco": ("한국", "대구 EXCO"), "busan": ("한국", "부산"), "부산": ("한국", "부산"),
    "incheon": ("한국", "인천"), "인천": ("한국", "인천"), "goyang": ("한국", "고양"), "고양": ("한국", "고양"),
    "tokyo": ("일본", "도쿄"), "東京": ("일본", "도쿄"), "shibuya": ("일본", "도쿄 시부야"), "渋谷": ("일본", "도쿄 시부야"),
    "osaka": ("일본", "오사카"), "大阪": ("일본", "오사카"), "nagoya": ("일본", "나고야"), "名古屋": ("일본", "나고야"),
    "fukuoka": ("일본", "후쿠오카"), "福岡": ("일본", "후쿠오카"), "taipei": ("대만", "타이베이"), "台北": ("대만", "타이베이"),
    "kaohsiung": ("대만", "가오슝"), "高雄": ("대만", "가오슝"), "metro manila": ("필리핀", "메트로 마닐라"), "manila": ("필리핀", "마닐라"),
    "hong kong": ("홍콩", "홍콩"), "香港": ("홍콩", "홍콩"), "macau": ("마카오", "마카오"), "macao": ("마카오", "마카오"),
    "bangkok": ("태국", "방콕"), "방콕": ("태국", "방콕"), "kuala lumpur": ("말레이시아", "쿠알라룸푸르"), "singapore": ("싱가포르", "싱가포르"),
    "jakarta": ("인도네시아", "자카르타"), "sydney": ("호주", "시드니"), "melbourne": ("호주", "멜버른"),
    "los angeles": ("미국", "로스앤젤레스"), "culver city": ("미국", "로스앤젤레스 컬버시티"),
    "orange county": ("미국", "오렌지카운티"), "buena park": ("미국", "오렌지카운티 부에나파크"), "new york": ("미국", "뉴욕"), "chicago": ("미국", "시카고"),
    "london": ("영국", "런던"), "paris": ("프랑스", "파리"), "berlin": ("독일", "베를린"),
}
VENUE_LABELS = (
    r"(?:Location|Venue|Place|Address)\s*[-:：]?\s*([^\[]+?)(?=\s*(?:\[|\*|Important|Payment|How to|Operating|Operation|Period|Dates|$))",
    r"(?:장소|위치|주소)\s*[-:：]?\s*([^\[]+?)(?=\s*(?:\[|\*|유의|안내|운영|기간|일정|$))",
    r"(?:会場|場所|住所)\s*[-:：]?\s*([^\[]+?)(?=\s*(?:\[|\*|注意|期間|$))",
)

# Articles on sale.
PRODUCTS = (
    "t-shirt", "tee", "hoodie", "sweatshirt", "shirt", "pants", "shorts", "jacket", "cap", "beanie", "hat", "bag", "pouch", "tote", "keyring", "key ring", "acrylic stand",
    "photocard", "photo card", "postcard", "poster", "sticker", "badge", "pin", "magnet", "doll", "plush", "cushion", "blanket", "towel", "light stick", "binder", "mirror", "strap",
    "티셔츠", "후드", "후디", "셔츠", "팬츠", "자켓", "재킷", "캡", "모자", "비니", "백", "가방", "파우치",
    "키링", "포토카드", "포카", "엽서", "포스터", "스티커", "뱃지", "배지", "핀", "인형", "쿠션", "담요", "타월", "응원봉",
)

# Kinds of shop, by the first word list of which a word occurs, and flags.
KINDS = (
    ("아티스트메이드 팝업", ("artist-made collection", "artist made collection")),
    ("캐릭터/IP 팝업", ("miniteen", "enchin", "official character", "monstiez")),
    ("THE CITY 팝업/이벤트", ("the city",)),
    ("앨범 팝업스토어", ("album", "mini album", "single")),
)
OTHER_KIND = "팝업스토어"
PERIOD_MISSING, PERIOD_ODD, PLACE_MISSING, COUNT_MISSING = "팝업스토어 기간 확인 필요", "팝업스토어 기간 수동 확인 필요", "지역/장소 확인 필요", "품목 수 확인 필요"

SNIPPET, HEAD, LONG = 450, 2000, 120


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w.lower())) for w in words])


def wanted(status: Column, title: Column, *, secondary: bool = False) -> Column:
    """Why a fetched notice is left out, or an empty string. secondary: whether notices that amend another one are taken too."""
    text = filled(title)
    return (
        F.when(F.coalesce(status != 200, F.lit(True)), "not fetched")
        .when(F.trim(text) == "", "no title")
        .when(~text.rlike(f"(?iuU){POPUP_TITLE}"), "no pop-up shop")
        .when(F.lit(not secondary) & text.rlike(f"(?iuU){SECONDARY_TITLE}"), "amends another notice")
        .otherwise("")
    )


def clean_title(title: Column) -> Column:
    """Without heading signs, the notice tag, a number at the end and the site's name."""
    text = F.regexp_replace(collapse(filled(title)), r"^#+\s*", "")
    text = F.regexp_replace(text, r"(?i)\[\s*notice\s*\]\s*", "")
    text = F.regexp_replace(text, r"(?i)\s*[|\-–—]?\s*weverse\s*$", "")
    return F.trim(F.regexp_replace(text, r"\s+N$", ""))


def without_weekdays(text: Column) -> Column:
    text = F.regexp_replace(text, rf"(?iuU)\((월|화|수|목|금|토|일|{_DAYS})\)", " ")
    text = F.regexp_replace(text, r"(?U)\b(월|화|수|목|금|토|일)요일\b", " ")
    return collapse(F.regexp_replace(text, rf"(?iuU)\b({_DAYS})\b", " "))


def contexts(text: Column) -> Column:
    """Snippets from each period marker on, and the beginning of the text; distinct, in this order."""

    def after(clean: Column, low: Column, marker: str) -> Column:
        found = F.transform(find_all(low, rf"\Q{marker.lower()}\E", 0), lambda m: F.substring(clean, m["from"] + 1, SNIPPET))
        return F.when(F.contains(low, F.lit(marker.lower())), found).otherwise(F.array().cast("array<string>"))

    def of(both: Column) -> Column:
        clean, low = both["clean"], both["low"]
        return F.array_distinct(F.concat(*[after(clean, low, m) for m in PERIOD_MARKERS], F.array(F.substring(clean, 1, HEAD))))

    return let(without_weekdays(text), lambda clean: let(F.struct(clean.alias("clean"), F.lower(clean).alias("low")), of))


_PERIOD = "array<struct<start:date,end:date,said:string>>"


def _month(name: Column) -> Column:
    return ((F.position(F.lower(F.substring(name, 1, 3)), F.lit("janfebmaraprmayjunjulaugsepoctnovdec")) + 2) / 3).cast("int")


def periods(snippet: Column) -> Column:
    """All spans that a snippet may name: full, shortened and single numeric dates, English ranges and dates."""

    def of(pattern: str, groups: int, first, last, said_in: Column = snippet) -> Column:
        # no pattern looks around itself, so a match holds the same parts alone as in its text
        def made(said: Column) -> Column:
            parts = F.array(*[F.regexp_extract(said, f"(?iuU){pattern}", g) for g in range(1, groups + 1)])
            return let(parts, lambda p: F.struct(first(p).alias("start"), last(p).alias("end"), collapse(said).alias("said")).cast(_PERIOD[6:-1]))

        spans = F.transform(F.regexp_extract_all(said_in, F.lit(f"(?iuU){pattern}"), F.lit(0)), made)
        return F.filter(spans, lambda p: p["start"].isNotNull() & p["end"].isNotNull())

    def date(y: int, m: int, d: int):
        return lambda p: real_date(p[y], p[m], p[d])

    def other(c: Column, default: Column) -> Column:
        return F.when(filled(c) == "", default).otherwise(c)

    # English dates have a comma before their year
    english = F.when(F.contains(snippet, F.lit(",")), snippet).otherwise("")
    return F.concat(
        of(_DATE + _TO + _DATE, 6, date(0, 1, 2), date(3, 4, 5)),
        of(_DATE + _TO + r"(\d{1,2})\s*[.\-/월]\s*(\d{1,2})\s*(?:일)?", 5, date(0, 1, 2), date(0, 3, 4)),
        of(_DATE + _TO + r"(\d{1,2})\s*(?:일)?", 4, date(0, 1, 2), date(0, 1, 3)),
        of(_DATE, 3, date(0, 1, 2), date(0, 1, 2)),
        of(ENGLISH_RANGE, 6, lambda p: real_date(other(p[2], p[5]), _month(p[0]), p[1]), lambda p: real_date(p[5], _month(other(p[3], p[0])), p[4]), english),
        of(ENGLISH_DATE, 3, lambda p: real_date(p[2], _month(p[0]), p[1]), lambda p: real_date(p[2], _month(p[0]), p[1]), english),
    )


def ranked_periods(title: Column, body: Column) -> Column:
    """array<struct<score, start, end, said>>: distinct spans, the best first."""

    def scored(snippet: Column, at: Column) -> Column:
        def base(low: Column) -> Column:
            return F.when(_any(low, PERIOD_WORDS), 100).otherwise(0) - F.when(_any(low, COMMERCE_WORDS), 25).otherwise(0) - at

        def worth(p: Column, base: Column) -> Column:
            n = F.datediff(p["end"], p["start"]) + 1
            return F.struct((base + F.when(n.between(1, 60), 20).when(n.between(61, LONG), 5).otherwise(-30)).alias("score"), p["start"].alias("start"), p["end"].alias("end"), p["said"].alias("said"))

        return let(let(F.lower(snippet), base), lambda b: F.transform(periods(snippet), lambda p: worth(p, b)))

    every = F.flatten(F.transform(contexts(F.concat_ws(" ", filled(title), filled(body))), scored))
    numbered = F.transform(every, lambda p, i: F.struct((-p["score"]).alias("a"), i.alias("b"), p.alias("it")))
    ordered = F.transform(F.array_sort(numbered), lambda p: p["it"])

    def distinct(both: Column) -> Column:
        return F.filter(both["ordered"], lambda p, i: F.array_position(both["same"], F.struct(p["start"], p["end"], p["said"])) == i + 1)

    def beside(o: Column) -> Column:
        return F.struct(o.alias("ordered"), F.transform(o, lambda p: F.struct(p["start"], p["end"], p["said"])).alias("same"))

    return let(ordered, lambda o: let(beside(o), distinct))


def location(title: Column, body: Column) -> Column:
    """struct<country, place>: the place named first, and the labelled venue where there is one."""
    known = F.array(*[F.struct(F.lit(k).alias("word"), F.lit(i).alias("i"), F.lit(c).alias("country"), F.lit(p).alias("place")) for i, (k, (c, p)) in enumerate(PLACES.items())])

    def first(low: Column) -> Column:
        hits = F.transform(F.filter(known, lambda k: F.contains(low, k["word"])), lambda k: F.struct(F.position(k["word"], low).alias("at"), k["i"].alias("i"), k["country"].alias("country"), k["place"].alias("place")))
        return F.array_min(hits)

    def venue(text: Column) -> Column:
        said = [let(F.substring(collapse(F.regexp_extract(text, f"(?iuU){p}", 1)), 1, 180), lambda v: F.when(v != "", v)) for p in VENUE_LABELS]
        return F.coalesce(*said)

    def of(text: Column) -> Column:
        return let(let(F.lower(text), first), lambda best: F.struct(filled(best["country"]).alias("country"), F.coalesce(venue(text), best["place"], F.lit("")).alias("place")))

    return let(F.concat_ws(" ", filled(title), filled(body)), of)


def item_count(text: Column) -> Column:
    """How many kinds of articles the text names; null if none."""
    named = lambda low: F.size(F.filter(F.array(*[F.lit(w) for w in PRODUCTS]), lambda w: F.contains(low, w)))
    return let(let(F.lower(text), named), lambda n: F.when(n > 0, n))


def kind(title: Column, body: Column) -> Column:
    return let(F.lower(F.concat_ws(" ", filled(title), filled(body))), lambda low: F.coalesce(*[F.when(_any(low, words), name) for name, words in KINDS], F.lit(OTHER_KIND)))


def overlaps(start: Column, end: Column, first: Column, last: Column) -> Column:
    """True if the span meets the range; a span that is not known passes."""
    return F.coalesce((F.coalesce(end, start) >= first) & (F.coalesce(start, end) <= last), F.lit(True))


def popup_rows(notices: DataFrame) -> DataFrame:
    """One row per notice: kind, period, place, articles, and the sorted flags of what needs a look."""
    read = notices.withColumn("title", clean_title(F.col("title"))).withColumn("_p", ranked_periods(F.col("title"), F.col("body"))).withColumn("_l", location(F.col("title"), F.col("body")))
    best = F.try_element_at("_p", F.lit(1))
    length = F.datediff(best["end"], best["start"]) + 1
    made = read.select(
        *notices.columns,
        kind(F.col("title"), F.col("body")).alias("popup_type"),
        best["start"].alias("start_date"),
        best["end"].alias("end_date"),
        F.when(length > 0, length).alias("duration_days"),
        filled(best["said"]).alias("date_evidence"),
        F.array_join(F.transform(F.slice("_p", 2, 4), lambda p: F.concat(p["start"].cast("string"), F.lit("~"), p["end"].cast("string"))), "; ").alias("other_periods"),
        F.col("_l.country").alias("country"),
        F.col("_l.place").alias("place"),
        item_count(F.concat_ws(" ", "title", filled("body"))).alias("item_count"),
    )
    flags = F.array(
        F.when(F.col("start_date").isNull(), PERIOD_MISSING).when(F.col("duration_days").isNull() | (F.col("duration_days") > LONG), PERIOD_ODD),
        F.when((F.col("country") == "") | (F.col("place") == ""), PLACE_MISSING),
        F.when(F.col("item_count").isNull(), COUNT_MISSING),
    )
    return made.withColumn("verify", F.array_join(F.array_sort(F.array_compact(flags)), "; "))
