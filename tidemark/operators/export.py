"""Rows of the daily workbook: selected articles, raw articles, what waits for a check, and the sheets around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled

# The columns of the sheets of articles in their order.
ARTICLE_COLUMNS = (
    "candidate_id", "event_key", "수집 채널", "회사", "레이블", "아티스트", "artist_id", "활동 유형",
    "일정 판정", "점수", "매체 점수", "게시일", "제목", "행사명", "이벤트 날짜",
    "시작일", "종료일", "날짜 신뢰도", "날짜 근거", "날짜 출처", "날짜 충돌",
    "도시", "공연장", "클리핑 문구", "매칭 키워드", "출처 URL", "기사 원문 URL",
    "네이버 뉴스 URL", "매체", "공식 소스", "공식 확인", "검색어", "검증 상태",
    "검토 사유", "제목 매칭 별칭", "관련 기사 수", "관련 기사 URL", "기존 event_key",
    "source_id", "notice_id", "dedupe_key", "수집시각",
)
BODY_COLUMN = "본문/검색 패시지"
REASON_COLUMN = "제외 사유"
SEARCHED = "NAVER_NEWS"

#: Which field of an article a column shows, where it is shown as it is.
_PLAIN = {
    "candidate_id": "candidate_id", "event_key": "event_key", "수집 채널": "source_type", "회사": "company", "레이블": "label", "아티스트": "artist", "artist_id": "artist_id",
    "활동 유형": "activity_type", "일정 판정": "schedule_status", "점수": "score", "매체 점수": "publisher_score", "제목": "title", "행사명": "event_name", "시작일": "event_start_date",
    "종료일": "event_end_date", "날짜 신뢰도": "date_confidence", "날짜 근거": "date_evidence", "날짜 출처": "date_source", "클리핑 문구": "clipped_text", "출처 URL": "url",
    "기사 원문 URL": "original_url", "네이버 뉴스 URL": "naver_url", "매체": "publisher", "공식 소스": "source_name", "검색어": "search_query", "검증 상태": "validation_status",
    "검토 사유": "review_reason", "제목 매칭 별칭": "matched_artist_alias", "관련 기사 수": "supporting_article_count", "source_id": "source_id", "notice_id": "notice_id", "dedupe_key": "dedupe_key",
}
_LISTS = {"이벤트 날짜": ("event_dates", "|"), "도시": ("cities", "|"), "공연장": ("venues", "|"), "매칭 키워드": ("matched_keywords", ", "), "관련 기사 URL": ("related_urls", "|"), "기존 event_key": ("previous_event_keys", "|")}
_TIMES = {"게시일": "published_at", "수집시각": "fetched_at"}
_NUMBERS = ("점수", "매체 점수", "관련 기사 수")


def article_columns(articles: DataFrame, *, searched: str = SEARCHED) -> dict[str, Column]:
    """A column per name of ARTICLE_COLUMNS; fields that the articles lack are empty. searched: the channel whose articles no official source can confirm."""
    have = set(articles.columns)

    def plain(name: str) -> Column:
        if name not in have:
            return F.lit("")
        return filled(F.col(name).cast("string"))

    def listed(name: str, by: str) -> Column:
        return F.array_join(F.transform(F.coalesce(F.col(name), F.array()), lambda v: v.cast("string")), by) if name in have else F.lit("")

    made = {}
    for column in ARTICLE_COLUMNS:
        if column in _LISTS:
            made[column] = listed(*_LISTS[column])
        elif column in _TIMES:
            made[column] = F.coalesce(F.date_format(_TIMES[column], "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit("")) if _TIMES[column] in have else F.lit("")
        elif column == "날짜 충돌":
            made[column] = F.when(F.coalesce(F.col("date_conflict"), F.lit(False)), "Y").otherwise("N") if "date_conflict" in have else F.lit("N")
        elif column == "공식 확인":
            official = F.coalesce(F.col("official_verified"), F.lit(False)) if "official_verified" in have else F.lit(False)
            made[column] = F.when(plain("source_type") == searched, "N/A").when(official, "Y").otherwise("N")
        elif column in _NUMBERS:
            made[column] = F.col(_PLAIN[column]).cast("int") if _PLAIN[column] in have else F.lit(None).cast("int")
        else:
            made[column] = plain(_PLAIN[column])
    return made


def selected_rows(articles: DataFrame, *, searched: str = SEARCHED) -> DataFrame:
    """One row per article with the 42 columns of the sheet."""
    return articles.select(*[c.alias(n) for n, c in article_columns(articles, searched=searched).items()])


def raw_rows(articles: DataFrame, *, searched: str = SEARCHED) -> DataFrame:
    """The selected rows with the article's body."""
    body = filled("body") if "body" in articles.columns else F.lit("")
    return articles.select(*[c.alias(n) for n, c in article_columns(articles, searched=searched).items()], body.alias(BODY_COLUMN))


def excluded_rows(articles: DataFrame, *, reason_col: str = "reason", searched: str = SEARCHED) -> DataFrame:
    """Left-out articles in the same columns, with the reason."""
    return articles.select(*[c.alias(n) for n, c in article_columns(articles, searched=searched).items()], filled(reason_col).alias(REASON_COLUMN))


def validation_rows(selected: DataFrame) -> DataFrame:
    """Selected rows that a person has to check."""
    return selected.filter(F.col("검증 상태") == "REVIEW_REQUIRED")


def workbook(articles: DataFrame, excluded: DataFrame, runs: DataFrame, parameters: DataFrame, calendar: DataFrame, *, searched: str = SEARCHED) -> dict[str, DataFrame]:
    """The seven sheets by name, for ``sinks.write_workbook``. parameters: name, value."""
    selected = selected_rows(articles, searched=searched)
    return {
        "daily_selected": selected,
        "calendar_events": calendar,
        "raw_articles": raw_rows(articles, searched=searched),
        "excluded": excluded,
        "source_runs": runs,
        "validation_queue": validation_rows(selected),
        "run_params": parameters.select(F.col("name").alias("항목"), F.col("value").alias("값")),
    }
