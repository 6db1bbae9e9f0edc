"""Articles on one event become one row.

Assignment is greedy by definition: in order of quality, an article joins the first cluster with
a member that says the same, so a bridging article never merges two clusters. Articles meet per block
of (entity, activity).

Blocks of ordinary size are worked on one after the other in the tasks that hold them, sorted, in
batches. In a block of more than ``LARGE`` articles the same clusters come out of joins, and no task
reads the block. There the rule reads: an article's cluster is the least (by quality) article that a
chain of links, each to an earlier article, leads to. Articles of one anchor and span, and articles of
one set of words and span, are classes: what they say is compared once per pair of classes, and what a
class offers to a later article is, for each cluster that occurs in it, the first member that has it. Labels fall by these offers, and by the labels of labels, until none
changes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import groups
from ..functions.similarity import anchor, tokens
from ..functions.text import filled
from ..lineage import cut
from ..vocabulary import CONFIDENCE

#: Least similarity where dates overlap, where one side is dated, and where none is.
BOTH, ONE, NONE = 0.48, 0.72, 0.82
#: Articles of a block up to which one task works on it.
LARGE = 2_000


def confidence_rank(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CONFIDENCE.items() for x in pair])
    return F.coalesce(F.element_at(known, c), F.lit(0))


def _quality() -> list[Column]:
    """Better dates first, then the publisher and the time; the first of equals."""
    titled = (F.col("date_source") == "TITLE").cast("int")
    return [-confidence_rank(F.col("date_confidence")), -titled, -F.col("score"), -F.col("publisher_score"), -F.coalesce(F.unix_micros("published_at"), F.lit(-(1 << 62))), F.col("seq")]


def _assign(block: pd.DataFrame) -> pd.DataFrame:
    """Greedy clusters of one block; the number of a cluster is the seq of its first member."""
    rows = block.sort_values("rank")
    members: list[tuple] = []
    cluster_of: list[int] = []
    by_token, by_anchor = defaultdict(list), defaultdict(list)
    ratios: dict[str, dict[str, float]] = {"": {}}

    def likeness(anchor: str) -> dict[str, float]:
        """How like each anchor so far is to this one; those that can reach no limit are left out."""
        if anchor not in ratios:
            own, matcher = {}, SequenceMatcher(None)
            matcher.set_seq2(anchor)
            for other in by_anchor:
                if 2 * min(len(other), len(anchor)) >= BOTH * (len(other) + len(anchor)):
                    matcher.set_seq1(other)
                    if matcher.real_quick_ratio() >= BOTH and matcher.quick_ratio() >= BOTH and (r := matcher.ratio()) >= BOTH:
                        own[other] = r
            ratios[anchor] = own
        return ratios[anchor]

    def note(anchor: str) -> None:
        """A new anchor is compared with those that were already looked for."""
        for other, own in ratios.items():
            if other and 2 * min(len(other), len(anchor)) >= BOTH * (len(other) + len(anchor)) and (r := SequenceMatcher(None, anchor, other).ratio()) >= BOTH:
                own[anchor] = r

    def same(a: tuple, b: tuple, alike: float) -> bool:
        dated = (a[2] is not None) + (b[2] is not None)
        overlap = dated == 2 and a[2] <= b[3] and b[2] <= a[3]
        if dated == 2 and not overlap:
            return False
        if a[1] and a[1] == b[1]:
            return True
        if dated == 0 and not (a[1] and b[1]):
            return False
        least = BOTH if overlap else ONE if dated == 1 else NONE
        either = len(a[0] | b[0])
        return alike >= least or (either > 0 and len(a[0] & b[0]) >= least * either)

    for r in rows.itertuples(index=False):
        me = (frozenset(r.tokens), r.anchor, r.start, r.end)
        like = likeness(me[1])
        # a similarity above zero needs a shared token or two like anchors
        near = {i for t in me[0] for i in by_token[t]} | {i for other in like for i in by_anchor[other]}
        found = min((cluster_of[i] for i in near if same(me, members[i], like.get(members[i][1], 0.0) if me[1] else 0.0)), default=None)
        n = len(members)
        members.append(me)
        cluster_of.append(found if found is not None else n)
        for t in me[0]:
            by_token[t].append(n)
        if me[1]:
            if me[1] not in by_anchor:
                note(me[1])
            by_anchor[me[1]].append(n)
    seqs = rows["seq"].tolist()
    return pd.DataFrame({"seq": seqs, "cluster": [seqs[i] for i in cluster_of], "cluster_rank": [rows["rank"].iloc[i] for i in cluster_of]})


def assign(articles: DataFrame, *, large: int = LARGE) -> DataFrame:
    """seq, cluster (the seq of its first member) and cluster_rank for every article; blocks of more than ``large`` articles by joins."""
    artist, alias = filled("artist"), filled("matched_artist_alias")
    usable = ~F.col("date_conflict")
    first, last = F.array_min("event_dates"), F.array_max("event_dates")
    start = F.when(usable, F.coalesce("event_start_date", first).cast("string"))
    end = F.when(usable, F.when(F.col("event_start_date").isNotNull(), F.coalesce("event_end_date", "event_start_date")).otherwise(last).cast("string"))
    order = F.struct(*[c.cast("long").alias(f"k{i}") for i, c in enumerate(_quality())])
    keyed = articles.select(
        "artist_id",
        "activity_type",
        "seq",
        tokens(F.col("title"), filled("event_name"), artist, alias).alias("tokens"),
        anchor(F.col("event_name"), artist, alias).alias("anchor"),
        start.alias("start"),
        end.alias("end"),
        # fixed width and offset, so that text sorts as the numbers do
        F.array_join(F.transform(F.array(*[order[f"k{i}"] for i in range(6)]), lambda k: F.lpad((k + F.lit(1 << 62)).cast("string"), 20, "0")), " ").alias("rank"),
    )
    block = F.concat_ws("\x02", *[F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in ("artist_id", "activity_type")])
    rows = cut(keyed.withColumn("block", block))
    sizes = cut(rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > large).select("block"))
    if sizes.isEmpty():
        return _small(rows)
    # a large block has more than ``large`` rows, so there are few
    return _small(rows.join(F.broadcast(sizes), "block", "left_anti")).unionByName(by_classes(cut(rows.join(F.broadcast(sizes), "block", "left_semi"))))


def _small(rows: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for _, block in groups(frames, ["block"]):
            held.append(_assign(block))
            n += len(block)
            if n > 10_000:
                yield pd.concat(held)
                held, n = [], 0
        if held:
            yield pd.concat(held)

    return rows.repartition("block").sortWithinPartitions("block").mapInPandas(run, "seq long, cluster long, cluster_rank string")


# --- large blocks

#: Anchors of a block that are compared with as many others in one task, and copies of a class's offers that its members are dealt to.
CHUNK, SALTS = 256, 8


def _name(*fields: Column) -> Column:
    return F.sha2(F.concat_ws("\x02", *[F.coalesce(f.cast("string"), F.lit("\x01")) for f in fields]), 256)


def _least(x: str, y: str) -> Column:
    """The least likeness of two dated or undated sides x and y; null where their spans say that they differ."""
    dated = F.col(f"{x}.start").isNotNull().cast("int") + F.col(f"{y}.start").isNotNull().cast("int")
    overlap = (F.col(f"{x}.start") <= F.col(f"{y}.end")) & (F.col(f"{y}.start") <= F.col(f"{x}.end"))
    return F.when(dated == 0, NONE).when(dated == 1, ONE).when(overlap, BOTH)


def like_anchors(anchors: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """block, own, other, alike: anchors of one block whose likeness (of an earlier other to a later own) reaches BOTH, compared chunk against chunk."""
    counted = anchors.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("count"))
    dealt = anchors.join(counted, "block").withColumn("mine", F.pmod(F.xxhash64("anchor"), F.col("count")).cast("int"))
    dealt = dealt.withColumn("their", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    dealt = dealt.select("block", F.least("mine", "their").alias("i"), F.greatest("mine", "their").alias("j"), (F.col("mine") > F.col("their")).alias("second"), "anchor")
    keys = ["block", "i", "j"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (block, i, j), frame in groups(frames, keys):
            values, second = frame["anchor"].tolist(), frame["second"].tolist()
            found, matcher = [], SequenceMatcher(None)
            for own, here in zip(values, second):
                matcher.set_seq2(own)
                for other, there in zip(values, second):
                    if other == own or (i != j and here == there) or 2 * min(len(other), len(own)) < BOTH * (len(other) + len(own)):
                        continue
                    matcher.set_seq1(other)
                    if matcher.quick_ratio() >= BOTH and (r := matcher.ratio()) >= BOTH:
                        found.append((block, own, other, r))
            yield pd.DataFrame(found, columns=["block", "own", "other", "alike"])

    made = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, "block string, own string, other string, alike double")
    return made.unionByName(anchors.select("block", F.col("anchor").alias("own"), F.col("anchor").alias("other"), F.lit(1.0).alias("alike")))


def _anchor_links(rows: DataFrame) -> DataFrame:
    """own, other: classes of one anchor and span whose articles say the same as an earlier one of the other class."""
    classes = cut(rows.filter("anchor <> ''").select("block", "anchor", "start", "end", F.col("by_anchor").alias("class")).distinct())
    pairs = like_anchors(classes.select("block", "anchor").distinct())
    x, y = classes.alias("x"), classes.alias("y")
    met = pairs.alias("p").join(x, (F.col("p.block") == F.col("x.block")) & (F.col("p.own") == F.col("x.anchor"))).join(y, (F.col("p.block") == F.col("y.block")) & (F.col("p.other") == F.col("y.anchor")))
    least = _least("x", "y")
    return met.filter(least.isNotNull() & ((F.col("p.own") == F.col("p.other")) | (F.col("alike") >= least))).select(F.col("x.class").alias("own"), F.col("y.class").alias("other"))


def _word_links(rows: DataFrame) -> DataFrame:
    """own, other: classes of one set of words and span that share enough of them. Sets that do share one of their rarest words (prefix filter)."""
    classes = cut(rows.filter(F.col("by_words").isNotNull()).select("block", "tokens", "start", "end", (F.col("anchor") != "").alias("anchored"), F.col("by_words").alias("class")).distinct())
    words = classes.select("block", "class", F.size("tokens").alias("size"), F.explode("tokens").alias("word"))
    counted = words.groupBy("block", "word").agg(F.count(F.lit(1)).alias("n"))
    ordered = words.join(counted, ["block", "word"]).groupBy("block", "class", "size").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("words"))
    kept = F.col("size") - F.ceil(F.col("size") * BOTH - 1e-9).cast("int") + 1
    prefixes = cut(ordered.select("block", "class", F.explode(F.slice("words", F.lit(1), kept)).alias("w")).select("block", "class", "w.word"))
    met = prefixes.alias("a").join(prefixes.alias("b"), ["block", "word"]).select(F.col("a.class").alias("own"), F.col("b.class").alias("other")).distinct()
    x, y = classes.alias("x"), classes.alias("y")
    both = met.join(x, F.col("own") == F.col("x.class")).join(y, F.col("other") == F.col("y.class"))
    shared, either = F.size(F.array_intersect("x.tokens", "y.tokens")), F.size(F.array_union("x.tokens", "y.tokens"))
    undated = F.col("x.start").isNull() & F.col("y.start").isNull()
    least = _least("x", "y")
    return both.filter(least.isNotNull() & (shared >= least * either) & (~undated | (F.col("x.anchored") & F.col("y.anchored")))).select("own", "other")


def _frontier(offers: DataFrame) -> DataFrame:
    """class, label, first without the offers that an earlier one betters; first inside salts, as one class may have very many."""
    left = offers.withColumn("salt", F.pmod(F.xxhash64("label"), F.lit(SALTS)))
    for keys in (["class", "salt"], ["class"]):
        best = F.min("label").over(Window.partitionBy(*keys).orderBy("first", "label").rowsBetween(Window.unboundedPreceding, -1))
        left = left.withColumn("best", best).filter(F.col("best").isNull() | (F.col("label") < F.col("best"))).drop("best")
    return left.drop("salt")


def by_classes(rows: DataFrame) -> DataFrame:
    """seq, cluster, cluster_rank by falling labels. rows: block, seq, rank, tokens, anchor, start, end."""
    tokens = F.array_sort("tokens")
    # articles without a day and a telling name say the same as dated ones, but not as each other
    told = F.col("start").isNotNull() | (F.col("anchor") != "")
    named = cut(
        rows.withColumns(
            {
                "by_anchor": F.when(F.col("anchor") != "", _name(F.lit("a"), F.col("block"), F.col("anchor"), F.col("start"), F.col("end"))),
                "by_words": F.when(F.size("tokens") > 0, _name(F.lit("w"), F.col("block"), F.to_json(tokens), F.col("start"), F.col("end"), F.col("anchor") != "")),
                "tokens": tokens,
            }
        )
    )
    links = cut(_anchor_links(named).unionByName(_word_links(named)).distinct())
    members = named.select("seq", "rank", told.alias("told"), F.explode(F.array_compact(F.array("by_anchor", "by_words"))).alias("class"))
    members = cut(members.withColumn("salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int")))
    spread = lambda df: df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # the first member of each of its classes is linked to an article, or is the article
    firsts = members.filter("told").groupBy("class").agg(F.min("rank").alias("first"))
    start = members.join(spread(firsts), ["class", "salt"]).groupBy("rank").agg(F.min("first").alias("label"))
    labels = cut(named.select("rank").join(start, "rank", "left").select("rank", F.coalesce("label", "rank").alias("label")))
    while True:
        held = members.join(labels, "rank")
        steps = _frontier(held.groupBy("class", "label").agg(F.min("rank").alias("first")))
        offers = _frontier(links.join(steps.withColumnRenamed("class", "other"), "other").groupBy(F.col("own").alias("class"), "label").agg(F.min("first").alias("first")))
        offered = members.join(spread(offers), ["class", "salt"]).filter(F.col("first") < F.col("rank")).groupBy("rank").agg(F.min("label").alias("offer"))
        fallen = cut(labels.join(offered, "rank", "left").select("rank", F.col("label").alias("before"), F.least("label", F.coalesce("offer", "label")).alias("label")))
        # an article's label is an article too, and what that one leads to is within reach
        above = fallen.join(fallen.select(F.col("label").alias("rank")).distinct(), "rank", "left_semi").select(F.col("rank").alias("label"), F.col("label").alias("above"))
        jumped = cut(fallen.withColumn("salt", F.pmod(F.xxhash64("rank"), F.lit(SALTS)).cast("int")).join(spread(above), ["label", "salt"]).select("rank", "before", F.least("label", "above").alias("label")))
        changed = not jumped.filter("label < before").isEmpty()
        labels = jumped.select("rank", "label")
        if not changed:
            break
    seq = lambda c: F.substring(c, -20, 20).cast("decimal(20,0)") - F.lit(1 << 62)
    return labels.select(seq("rank").cast("long").alias("seq"), seq("label").cast("long").alias("cluster"), F.col("label").alias("cluster_rank"))


def roll_up(articles: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row per cluster: its representative with the best member's dates and the union of cities, venues and URLs."""
    joined = articles.join(clusters, "seq")
    rank = confidence_rank(F.col("date_confidence"))
    titled = (F.col("date_source") == "TITLE").cast("int")
    quality = F.struct(rank.alias("a"), titled.alias("b"), F.col("score").alias("c"))
    better = F.struct(quality.alias("a"), F.col("publisher_score").alias("b"), F.coalesce("published_at", F.timestamp_seconds(F.lit(0))).alias("c"), (-F.col("seq")).alias("d"))
    date_fields = ("event_dates", "event_start_date", "event_end_date", "event_is_range", "date_confidence", "date_evidence", "date_source")
    whole = F.struct(*[F.col(c) for c in articles.columns])
    usable = F.col("event_start_date").isNotNull() & ~F.col("date_conflict")
    urls = F.concat(F.array("url"), F.coalesce("related_urls", F.array().cast("array<string>")))
    grouped = joined.groupBy("cluster", "cluster_rank").agg(
        F.max_by(whole, better).alias("it"),
        F.max_by(F.when(usable, F.struct(*date_fields)), F.when(usable, better)).alias("dates"),
        F.bool_or("date_conflict").alias("conflicts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("cities")))).alias("all_cities"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("venues")))).alias("all_venues"),
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("seq", urls.alias("urls")))), lambda s: s["urls"]))).alias("urls"),
        F.sum(F.greatest(F.coalesce("supporting_article_count", F.lit(1)), F.lit(1))).alias("articles"),
    )
    none = {"event_dates": F.array().cast("array<date>"), "event_is_range": F.lit(False), "date_confidence": F.when(F.col("conflicts"), "CONFLICT").otherwise("NONE"), "date_evidence": F.lit(""), "date_source": F.lit("")}
    made = {n: F.when(F.col("dates").isNotNull(), F.col(f"dates.{n}")).otherwise(none.get(n, F.lit(None))) for n in date_fields}
    made |= {
        "date_conflict": F.col("dates").isNull() & F.col("conflicts"),
        "cities": F.col("all_cities"),
        "venues": F.col("all_venues"),
        "related_urls": F.filter("urls", lambda u: (u != F.col("it.url")) & (u != "")),
        "supporting_article_count": F.col("articles").cast("int"),
    }
    return grouped.select(*[made[c].alias(c) if c in made else F.col(f"it.{c}").alias(c) for c in articles.columns], "cluster_rank")


def cluster_events(articles: DataFrame) -> DataFrame:
    """One row per event, with cluster_rank as the order in which events come."""
    return roll_up(articles, assign(articles))
