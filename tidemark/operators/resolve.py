"""Which entity a title is about.

An alias can stand in a title only if each of its words of Latin letters and digits is a whole word
of the title (in other scripts: each two of its neighbouring characters stand there together). So of
these parts the one that the fewest titles hold is the alias's key: titles and aliases meet by an
equi-join on it, and the whole alias is then looked for. Names that all begin with one frequent word
meet by what tells them apart, and an alias of which some part is in no title meets nothing. The
alias side is broadcast while its counted rows are few and shuffled beyond that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, filled
from ..lineage import cut

BROADCAST_ROWS = 200_000


def aliases_of(name: Column, extra: Column, blocked: list[str]) -> Column:
    """The name without its notes in brackets, the notes, and further aliases; no blocked one and none twice."""
    bare = F.regexp_replace(name, r"(?U)\s*\([^)]*\)", "")
    notes = F.regexp_extract_all(name, F.lit(r"\(([^)]+)\)"), F.lit(1))
    given = F.transform(F.concat(F.array(bare), notes, F.coalesce(extra, F.array().cast("array<string>"))), lambda a: F.trim(a))
    barred = [b.casefold() for b in blocked]
    usable = F.filter(given, lambda a: (filled(a) != "") & (~F.lower(a).isin(*barred) if barred else F.lit(True)))
    return F.filter(usable, lambda a, i: F.array_position(F.transform(usable, lambda b: F.lower(b)), F.lower(a)) == i + 1)


def search_name(entities: DataFrame, blocked: list[str], overrides: dict[str, str] | None = None) -> DataFrame:
    """artist_id, search_name: an override, else the first alias in Hangul of three characters or more, else the first alias, else the name."""
    known = aliases_of(F.col("name"), F.col("aliases"), blocked)
    hangul = F.filter(known, lambda a: a.rlike("[가-힣]") & (F.length(a) >= 3))
    given = F.create_map(*[F.lit(x) for pair in (overrides or {"": ""}).items() for x in pair])
    return entities.select("artist_id", F.coalesce(F.element_at(given, F.col("artist_id")), F.try_element_at(hangul, F.lit(1)), F.try_element_at(known, F.lit(1)), F.col("name")).alias("search_name"))


def queries_of(entities: DataFrame, blocked: list[str], overrides: dict[str, str] | None = None, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """artist_id, query: one search, or one per suffix."""
    named = search_name(entities, blocked, overrides)
    if not suffixes:
        return named.select("artist_id", F.col("search_name").alias("query"))
    return named.select("artist_id", F.explode(F.transform(F.array(*[F.lit(s) for s in suffixes]), lambda s: F.concat_ws(" ", "search_name", s))).alias("query"))


def alias_table(entities: DataFrame, blocked: list[str]) -> DataFrame:
    """One row per entity and alias with its rank among all: priority entities first, then those with the longest alias, then as listed."""
    size = F.length(F.regexp_replace("alias", r"(?U)\s+", ""))
    rows = entities.select("artist_id", F.col("name").alias("artist"), "company", "label", "priority", F.col("seq").alias("entity_seq"), F.posexplode(aliases_of(F.col("name"), F.col("aliases"), blocked)).alias("alias_seq", "alias"))
    longest = rows.withColumn("size", size).withColumn("longest", F.max(size).over(Window.partitionBy("artist_id")))
    rank = F.struct((~F.col("priority")).alias("a"), (-F.col("longest")).alias("b"), F.col("entity_seq").alias("c"), (-F.col("size")).alias("d"), F.col("alias_seq").alias("e"))
    return longest.select("artist_id", "artist", "company", "label", "alias", rank.alias("rank"))


_LATIN = "[a-z0-9]+"


def _parts(alias: Column) -> Column:
    """What a title must hold if it holds the alias: its words of Latin letters and digits, else its pairs of characters, else itself."""
    words = F.regexp_extract_all(F.lower(alias), F.lit(_LATIN), F.lit(0))
    pairs = F.regexp_extract_all(alias, F.lit(r"(?s)(?=(\S.))"), F.lit(1))
    return F.array_distinct(F.when(F.size(words) > 0, words).when(F.length(alias) < 2, F.array(alias)).otherwise(pairs))


def _held(title: Column) -> Column:
    """All parts of aliases that a title can hold: its words of Latin letters and digits, its other characters and the pairs that they begin."""
    words = F.regexp_extract_all(F.lower(title), F.lit(_LATIN), F.lit(0))
    other = F.concat(F.regexp_extract_all(title, F.lit(r"[^A-Za-z0-9\s]"), F.lit(0)), F.regexp_extract_all(title, F.lit(r"(?s)(?=([^A-Za-z0-9\s].))"), F.lit(1)))
    return F.array_distinct(F.concat(words, other))


def holds(title: Column, alias: Column) -> Column:
    """Latin letters and digits need a boundary and no case; other aliases count as written, anywhere."""
    low, name = F.lower(title), F.lower(alias)
    quoted = F.concat(F.lit(r"(?<![a-z0-9])\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![a-z0-9])"))
    return F.when(~name.rlike("[a-z0-9]"), F.contains(title, alias)).otherwise(F.contains(low, name) & F.regexp_like(low, quoted))


def _keyed(rows: DataFrame, aliases: DataFrame, few) -> DataFrame:
    """Aliases with their part: the one that the fewest rows (a title and a part of it) have. Aliases of which no title has some part are left out."""
    several = aliases.filter(F.size("parts") > 1)
    single = aliases.filter(F.size("parts") == 1).withColumn("part", F.col("parts")[0]).drop("parts")
    if several.isEmpty():
        return single
    exploded = several.select(*[c for c in aliases.columns if c != "parts"], F.explode("parts").alias("part"))
    seen = rows.join(few(exploded.select("part").distinct()), "part", "left_semi").groupBy("part").agg(F.count(F.lit(1)).alias("seen"))
    best = F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), (-F.length("part")).alias("size"), "part")).alias("best")
    whole = F.first(F.struct(*[c for c in aliases.columns if c != "parts"])).alias("it")
    chosen = exploded.join(seen, "part", "left").groupBy("rank", F.col("alias").alias("_alias")).agg(whole, best).filter("best.seen > 0")
    return single.unionByName(chosen.select("it.*", "best.part"))


def candidates(titles: DataFrame, aliases: DataFrame, *, key: str = "seq", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """key, title, part and the columns of every alias whose key the title holds."""
    known = cut(aliases.withColumn("parts", _parts(F.col("alias"))))
    few = F.broadcast if known.count() <= broadcast_rows else (lambda df: df)
    rows = titles.filter(filled("title") != "").select(key, "title", F.explode(_held(F.col("title"))).alias("part"))
    return rows.join(few(cut(_keyed(rows, known, few))), "part")


def matches(titles: DataFrame, aliases: DataFrame, *, key: str = "seq", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """key and the columns of every alias that the title holds. titles: key, title."""
    met = candidates(titles, aliases, key=key, broadcast_rows=broadcast_rows)
    # an alias of one word is found by its part alone
    return met.filter((F.col("part") == F.lower("alias")) & F.col("part").rlike("^[a-z0-9]+$") | holds(F.col("title"), F.col("alias"))).drop("title", "part")


def resolve(articles: DataFrame, aliases: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Articles with the entity that their title names: artist_id, artist, company, label and matched_artist_alias, null where it names none."""
    best = matches(articles.select("seq", "title"), aliases, broadcast_rows=broadcast_rows).groupBy("seq").agg(
        F.min_by(F.struct("artist_id", "artist", "company", "label", F.col("alias").alias("matched_artist_alias")), "rank").alias("it")
    )
    kept = [c for c in articles.columns if c not in ("artist_id", "artist", "company", "label", "matched_artist_alias")]
    return articles.select(*kept).join(best, "seq", "left").select(*kept, "it.*")


def all_mentions(texts: DataFrame, aliases: DataFrame, *, fallback: DataFrame | None = None) -> DataFrame:
    """seq, artist_id of every entity a text names; texts without any get the fallback's (seq, artist_id), where given."""
    named = matches(texts.select("seq", "title"), aliases).select("seq", "artist_id").distinct()
    return named if fallback is None else named.unionByName(fallback.select("seq", "artist_id").join(named, "seq", "left_anti"))


def publisher_score(articles: DataFrame, publishers: dict[str, int], other: int) -> DataFrame:
    """Adds publisher_score by the domain in publisher."""
    known = F.create_map(*[F.lit(x) for pair in publishers.items() for x in pair])
    return articles.withColumn("publisher_score", F.coalesce(F.element_at(known, blank_to_null("publisher")), F.lit(other)))
