"""Default vocabularies. Every operator takes its vocabulary as a parameter; these are the defaults."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    activity: str
    base: int
    keywords: tuple[str, ...]


# Activity rules in order of priority, their base scores and keywords.
RULES = (
    Rule("ADDITIONAL_SHOW", 60, ("추가 회차", "추가 공연", "회차 추가", "additional show", "extra show", "追加公演")),
    Rule("TOUR_EXPANSION", 58, ("투어 확장", "도시 추가", "일정 추가", "new dates", "additional dates", "tour extension")),
    Rule("ENCORE", 56, ("앙코르 콘서트", "앙코르 공연", "encore concert", "encore")),
    Rule("TOUR_ANNOUNCEMENT", 54, ("월드투어", "월드 투어", "아시아투어", "아시아 투어", "투어 개최", "콘서트 투어", "tour announcement", "world tour", "arena tour", "dome tour")),
    Rule("CONCERT", 53, ("팬콘서트", "팬 콘서트", "팬콘", "fan concert", "단독 콘서트", "단독콘서트", "단독 공연", "콘서트 개최", "공연 개최", "concert")),
    Rule("FANMEETING", 52, ("팬미팅", "팬 미팅", "fan meeting", "fanmeeting")),
    Rule("POPUP", 50, ("팝업스토어", "팝업 스토어", "pop-up", "pop up", "popup", "ポップアップ")),
    Rule("COMEBACK", 48, ("신보 발매", "컴백", "새 앨범", "정규 앨범", "정규앨범", "미니 앨범", "미니앨범", "싱글 발매", "앨범 발매", "single album", "new album", "comeback")),
)

# Contexts that reject a title, and the one that announces something new.
CANCELLED = r"(활동\s*(?:잠정\s*)?중단|불참|취소|연기|건강\s*(?:문제|악화)|계약\s*종료)"
RECAP = r"(성료|마쳐|마무리|종료|막\s*내려|관객\s*동원|투어를\s*마친|공연을\s*마친|전석\s*매진으로\s*마무리)"
FINANCE = r"(실적|매출|영업이익|순이익|주가|시가총액|증권가|어닝|분기\s*최대|컴백\s*효과|흥행\s*효과|수혜|기업가치)"
LIFESTYLE = r"(투표|설문|몇\s*위|1위|순위|스타랭킹|아이돌차트|비주얼|미모|우산\s*씌워|출근길|공항패션|패션|근황|셀카)"
WEAK = r"(컴백\s*(?:앞두고|효과)|신보\s*효과|투어\s*효과)"
FOLLOW_UP = r"(티저|teaser|하이라이트|하라메|콘셉트|컨셉트|트랙리스트|스케줄\s*포스터|뮤직비디오|뮤비|비주얼|프리뷰|선공개|인터뷰|화보|포토|차트\s*(?:1위|진입|정상)|D-\d+)"
ANNOUNCES = r"(확정|발표|개최(?:한다)?|연다|오픈|돌입|나선다|시작|스타트|출시|발매(?:한다|된다|예정)?|컴백(?:한다|확정|예정)|돌아온다|일정\s*공개|추가\s*(?:회차|공연|일정)|앙코르)"


class Rejection(NamedTuple):
    """A reason, the pattern that gives it, the activities it holds for (empty: all), and whether an announcement lifts it."""

    reason: str
    pattern: str | None
    activities: tuple[str, ...] = ()
    lifted: bool = False


# Reasons in the order in which they are tried.
REJECTIONS = (
    Rejection("제목에 대상 활동 키워드 없음", None, ("OTHER",)),
    Rejection("취소·중단·건강 이슈", CANCELLED),
    Rejection("종료·성료·과거 실적 기사", RECAP, lifted=True),
    Rejection("실적·주가·흥행 효과 등 일정 비핵심 기사", FINANCE),
    Rejection("투표·순위·화보·근황 등 일정 비핵심 기사", LIFESTYLE),
    Rejection("활동을 배경으로만 언급한 기사", WEAK, lifted=True),
    Rejection("티저·인터뷰·차트 등 후속 콘텐츠", FOLLOW_UP, lifted=True),
    Rejection("투어 신규 발표 문구 없음", None, ("TOUR_ANNOUNCEMENT",), True),
    Rejection("개최·운영 신규 문구 없음", None, ("CONCERT", "FANMEETING", "POPUP"), True),
    Rejection("컴백·발매 신규 발표 문구 없음", None, ("COMEBACK",), True),
)

# Date patterns.
_TO = r"(?:부터|[~∼～\-–—])"
CROSS_MONTH = rf"(?<!\d)(\d{{1,2}})\s*월\s*(\d{{1,2}})\s*일?\s*{_TO}\s*(\d{{1,2}})\s*월\s*(\d{{1,2}})\s*일(?:까지)?"
INTO_NEXT_MONTH = rf"(?:오는\s*)?(\d{{1,2}})\s*일\s*{_TO}\s*(?:내달|다음\s*달)\s*(\d{{1,2}})\s*일(?:까지)?"
IN_MONTH = rf"(?<!\d)(\d{{1,2}})\s*월\s*(\d{{1,2}})\s*(?:일)?\s*{_TO}\s*(\d{{1,2}})\s*일(?:까지)?"
FULL_DATE = r"(?<!\d)(20\d{2})\s*(?:[.\-/]|년)\s*(\d{1,2})\s*(?:[.\-/]|월)\s*(\d{1,2})\s*일?"
MONTH_DAY = r"(?<!\d)(\d{1,2})\s*월\s*(\d{1,2})\s*일"
NEXT_MONTH_DAY = r"(?:내달|다음\s*달)\s*(\d{1,2})\s*일"
DAY_RANGE = r"(?<![\d월])(\d{1,2})\s*(?:일)?\s*[~∼～\-–—]\s*(\d{1,2})\s*일(?:까지)?"
COMING_DAY = r"(?:오늘|오는|내일|익일)(?:\s*\(\s*)?(\d{1,2})\s*일(?:\s*\))?"
BARE_DAY = r"(?<![\d월])(\d{1,2})\s*일(?!\s*(?:[~∼～\-–—]|간\b|동안\b|연속\b|째\b|전\b|후\b|만에\b|이내\b))"
PAST_PREFIX = r"(?:지난|앞선|앞서|전날)\s*$"
NEXT_YEAR = r"내년|다음\s*해"
FUTURE = r"(예정|개최|발매|출시|오픈|연다|돌입|시작|추가|확정|발표|오는|내달|다음\s*달)"


class DatePattern(NamedTuple):
    """A pattern, its base score, and where year and months come from."""

    pattern: str
    base: int
    kind: str
    title_only: bool = False


# Date patterns in the order in which they claim text, with their scores in a title.
DATE_PATTERNS = (
    DatePattern(CROSS_MONTH, 94, "month day month day"),
    DatePattern(INTO_NEXT_MONTH, 88, "day next day"),
    DatePattern(IN_MONTH, 94, "month day day"),
    DatePattern(FULL_DATE, 98, "year month day"),
    DatePattern(MONTH_DAY, 90, "month day"),
    DatePattern(NEXT_MONTH_DAY, 76, "next day"),
    DatePattern(DAY_RANGE, 66, "day day"),
    DatePattern(COMING_DAY, 68, "day"),
    DatePattern(BARE_DAY, 40, "day", True),
)

# Words near a date that speak for it, by activity.
CUES = {
    "COMEBACK": ("컴백", "신보", "앨범", "싱글", "발매", "출시"),
    "TOUR_ANNOUNCEMENT": ("투어", "월드투어", "아시아투어"),
    "TOUR_EXPANSION": ("투어", "추가", "확장", "도시"),
    "ADDITIONAL_SHOW": ("추가 회차", "추가 공연", "공연"),
    "ENCORE": ("앙코르", "콘서트", "공연"),
    "CONCERT": ("콘서트", "공연", "팬콘"),
    "FANMEETING": ("팬미팅", "팬 미팅"),
    "POPUP": ("팝업", "팝업스토어"),
}

# Cities and their names in texts.
CITIES = {
    "서울": ("서울", "seoul"),
    "부산": ("부산", "busan"),
    "인천": ("인천", "incheon"),
    "도쿄": ("도쿄", "tokyo", "東京"),
    "오사카": ("오사카", "osaka", "大阪"),
    "나고야": ("나고야", "nagoya", "名古屋"),
    "후쿠오카": ("후쿠오카", "fukuoka", "福岡"),
    "타이베이": ("타이베이", "taipei", "台北"),
    "홍콩": ("홍콩", "hong kong", "香港"),
    "마카오": ("마카오", "macau", "macao"),
    "방콕": ("방콕", "bangkok"),
    "싱가포르": ("싱가포르", "singapore"),
    "자카르타": ("자카르타", "jakarta"),
    "마닐라": ("마닐라", "manila"),
    "쿠알라룸푸르": ("쿠알라룸푸르", "kuala lumpur"),
    "로스앤젤레스": ("로스앤젤레스", "los angeles", " la "),
    "뉴욕": ("뉴욕", "new york"),
    "시카고": ("시카고", "chicago"),
    "런던": ("런던", "london"),
    "파리": ("파리", "paris"),
}

# Venues.
VENUE = r"([A-Za-z0-9&.'’\-\s가-힣]{2,45}?(?:stadium|arena|dome|hall|theatre|theater|center|centre|스타디움|아레나|돔|홀|체육관|공연장))"
VENUE_CUT = r"[,.]|(?:에서|으로|에서의)\s+"
VENUE_CITY = r"^(?:서울|부산|인천|도쿄|오사카|나고야|후쿠오카|타이베이|홍콩|마카오|방콕|싱가포르|자카르타|마닐라|뉴욕|런던|파리)\s+"

# Event names.
QUOTED = r"['\"‘’“”<\[]\s*([^'\"‘’“”<>\[\]]{2,100})\s*['\"‘’“”>\]]"
RELEASE_NAME = rf"(?:정규\s*\d*집|미니\s*\d*집|싱글|앨범|신보)\s*(?:명|은|는|:)?\s*{QUOTED}"
LIVE_NAME = rf"(?:월드\s*투어|아시아\s*투어|투어|단독\s*콘서트|콘서트|팬콘(?:서트)?|팬\s*콘서트|팬미팅|팝업(?:스토어)?)\s*(?:명|은|는|:)?\s*{QUOTED}"
NAME_BEFORE_LIVE = rf"{QUOTED}\s*(?:월드\s*투어|아시아\s*투어|투어|콘서트|팬콘(?:서트)?|팬미팅|팝업(?:스토어)?)"
BARE_RELEASE_NAME = r"(?:정규\s*\d*집|미니\s*\d*집|싱글|앨범|신보)\s+([A-Z][A-Z0-9&:#!?'\-]{2,60})\b"
TOUR_NAME = r"((?:20\d{2}[-–]\d{2}\s*)?[A-Za-z0-9가-힣&:#!?'’\-\s]{2,90}(?:WORLD\s+TOUR|LIVE\s+TOUR|CONCERT\s+TOUR|TOUR))"
NOT_A_NAME = r"^(?:컴백|신보|새\s*앨범|정규\s*\d*집|미니\s*\d*집|싱글|콘서트|팬콘|팬미팅|팝업스토어|월드투어|투어)$"
SONG = r"(?:신곡|미발표곡|수록곡|무대|세트리스트|퍼포먼스)[^'\"‘’“”]{0,24}['\"‘’“”]"
FAN_CONCERT = r"팬콘|팬\s*콘서트"
BOILERPLATE = r"(컴백|신보\s*발매|새\s*앨범|발매\s*확정|개최|발표|오픈|일정\s*공개|출사표|카운트다운)"
LABELS = {
    "COMEBACK": "컴백",
    "CONCERT": "콘서트",
    "TOUR_ANNOUNCEMENT": "투어",
    "TOUR_EXPANSION": "투어 추가 일정",
    "ADDITIONAL_SHOW": "추가 공연",
    "ENCORE": "앙코르 콘서트",
    "FANMEETING": "팬미팅",
    "POPUP": "팝업스토어",
}
OTHER_LABEL, FAN_CONCERT_LABEL = "활동", "팬콘서트"
STAGE_ACTIVITIES = ("CONCERT", "TOUR_ANNOUNCEMENT", "TOUR_EXPANSION", "ADDITIONAL_SHOW", "ENCORE", "FANMEETING")

# Words that say nothing about which event a text is on.
STOP_WORDS = (
    "공식", "확정", "개최", "발표", "오픈", "컴백", "신보", "앨범", "발매", "투어", "월드투어", "콘서트", "팬미팅", "팬콘", "팝업", "팝업스토어",
    "추가", "회차", "공연", "앙코르", "첫", "글로벌", "일정", "예정", "단독", "서울", "한국", "일본",
)
GENERIC_NAME = r"^(?:첫|새|신규|단독|월드|아시아|글로벌|공식|컴백|투어|콘서트|팬미팅|팬콘서트|팝업스토어|추가공연|앙코르)+$"
NAME_NOISE = r"\b(?:20\d{2}|정규|미니|싱글|앨범|투어|콘서트|팬미팅|팬콘서트)\b"
ENRICH_NOISE = r"\b(?:컴백|신보|앨범|발매|개최|발표|공식|투어|콘서트|팬미팅|팬콘서트|팝업스토어)\b"
CONFIDENCE = {"NONE": 0, "LOW": 1, "MEDIUM": 2, "HIGH": 3, "CONFLICT": -1}

# Schedule changes.
EXPLICIT_ADDITION = r"(추가\s*(?:회차|공연)|회차\s*추가|additional\s+show|extra\s+show|追加公演)"
TOUR_FAMILY = ("TOUR_ANNOUNCEMENT", "TOUR_EXPANSION", "ADDITIONAL_SHOW", "ENCORE", "CONCERT")

# Query parameters that track readers.
TRACKING = ("fbclid", "gclid", "dclid", "msclkid", "mc_cid", "mc_eid", "igshid", "referrer")

# Calendar labels and colours.
CALENDAR_LABELS = {
    "COMEBACK": "컴백",
    "TOUR_ANNOUNCEMENT": "투어 발표",
    "TOUR_EXPANSION": "투어 확장",
    "ADDITIONAL_SHOW": "추가 회차",
    "ENCORE": "앙코르",
    "CONCERT": "콘서트",
    "FANMEETING": "팬미팅",
    "POPUP": "팝업",
}
CALENDAR_COLOURS = {
    "COMEBACK": "#2563eb",
    "TOUR_ANNOUNCEMENT": "#7c3aed",
    "TOUR_EXPANSION": "#9333ea",
    "ADDITIONAL_SHOW": "#dc2626",
    "ENCORE": "#ea580c",
    "CONCERT": "#0f766e",
    "FANMEETING": "#059669",
    "POPUP": "#ca8a04",
}
OTHER_COLOUR = "#64748b"

# Query suffixes of a backfill, and trust in publishers.
QUERY_SUFFIXES = ("컴백", "신보 발매", "앨범 발매", "투어 발표", "콘서트 개최", "추가 회차", "앙코르 콘서트", "팬미팅 개최", "팬콘 개최", "팝업스토어")
PUBLISHERS = {
    "yna.co.kr": 10, "newsis.com": 9, "reuters.com": 10, "mk.co.kr": 8, "hankyung.com": 8, "sedaily.com": 8, "edaily.co.kr": 8,
    "chosun.com": 7, "joongang.co.kr": 7, "donga.com": 7, "sportschosun.com": 5, "osen.co.kr": 5, "starnewskorea.com": 5,
}
OTHER_PUBLISHER, NEWS_BONUS, OFFICIAL_BONUS = 3, 15, 25
