r"""Personal data: fixed patterns plus information-theoretic sanitisation, in DataFrame operations only.

Base spans are the leftmost, non-overlapping matches of four patterns (email, ip, card, phone)
that pass their check; failing matches are dropped and not retried. The patterns below match the
same text as the plain ones but are written so that Java's engine neither recurses nor rescans a
run of characters: possessive groups, and look-behinds that let a match start only where the
plain pattern's leftmost match can start.

Terms: an entity e is a kind (any span of it) or one protected value of a kind. For a word w the
corpus gives n(w), the documents that hold w outside base spans, n(w, e), those of them that hold e
anywhere, n(e) and N. With IC(e) = log2(N / n(e)) and PMI(w; e) = log2(n(w, e) N / (n(w) n(e))),
disclosure = PMI / IC is 1 where w never comes without e. Words that share at least ``support``
different texts with an entity and whose disclosure reaches ``generalise`` are spans of kind
``term`` wherever they stand, also in texts without an entity. In sanitised text they are removed
from ``remove`` on, and generalised below it: the same counts are taken for the classes of words
that begin with the same four and the same two letters (``LEVELS``), and a term becomes its first
class that itself stays below ``generalise``, written as ``ab*``; without such a class it becomes
``[TERM]``. All counts cover all documents.

Defined cases: null text is empty and has no spans; equal texts get equal spans; ties and
repeated rows count as often as they stand; an empty table gives an empty result; further columns
are passed through by ``sanitise`` (its own columns use names that start with ``_pii``).
Offsets are code points, ends are exclusive. Spans of different kinds may overlap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ._spark import cut, text_of

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
_HOST = "[A-Za-z0-9-]"
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A cheap test that holds wherever the pattern can match.
GATES = {"email": "@", "ip": ".", "card": None, "phone": "+"}
WORD = r"\p{L}{3,}+"
#: Letters by which words are put into classes, the hierarchy along which terms are generalised.
LEVELS = (4, 2)
SALTS = 8
#: Entries of a list that are folded together, and code points of a text that are cut together.
CHUNK, BLOCK = 128, 4096
#: Rows of entities or terms up to which they are broadcast.
BROADCAST_ROWS = 100_000
_TERMS = "array<struct<start:int,end:int,disclosure:double,put:string>>"


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For every entry of an array of counts, what op makes of all before it (0 for the first).

    Chunks are folded first, then what stands before each chunk, then before each entry of it, so the
    work grows with the entries (times a chunk), where one fold that appends would grow with their square.
    """

    def fold(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), op)

    def within(chunks: Column, totals: Column) -> Column:
        return F.flatten(F.transform(chunks, lambda c, i: let(fold(F.slice(totals, F.lit(1), i)), lambda before: F.transform(c, lambda _, k: op(before, fold(F.slice(c, F.lit(1), k)))))))

    starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
    chunks = F.transform(starts, lambda i: F.slice(values, i * CHUNK + 1, F.lit(CHUNK)))
    made = let(chunks, lambda cs: let(F.transform(cs, fold), lambda totals: within(cs, totals)))
    return F.when(F.size(values) > 0, made).otherwise(F.array().cast("array<int>"))


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _most(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _find_all(text: Column, pattern: str, wanted: Callable[[Column], Column] | None = None) -> Column:
    """array<struct<start, end, value>> of all matches (whose value is wanted), offsets in code points.

    Java splits at the same matches that it extracts, so starts are running sums of the lengths
    of gaps and matches.
    """

    def placed(gaps: Column, hits: Column) -> Column:
        sizes = F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + F.length(h))

        def span(h: Column, i: Column, starts: Column) -> Column:
            start = F.get(starts, i) + F.length(F.get(gaps, i))
            return F.struct(start.alias("start"), (start + F.length(h)).alias("end"), h.alias("value"))

        return let(let(sizes, lambda n: _running(n, _sum)), lambda starts: F.transform(hits, lambda h, i: span(h, i, starts)))

    found = let(F.split(text, pattern, -1), lambda gaps: let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: placed(gaps, hits)))
    return found if wanted is None else F.filter(found, lambda s: F.coalesce(wanted(s["value"]), F.lit(False)))


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """A text from start to end (code points, end exclusive), put together from its blocks, so that no piece is looked for from the text's beginning."""
    i, j = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
    one = F.substring(F.get(blocks, i), start - i * BLOCK + 1, end - start)
    head, tail = F.substring(F.get(blocks, i), start - i * BLOCK + 1, F.lit(BLOCK)), F.substring(F.get(blocks, j), F.lit(1), end - j * BLOCK)
    several = F.concat(head, F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""), tail)
    return F.when(end <= start, "").when(i == j, one).otherwise(several)


def _rewritten(text: Column, spans: Column, put: Callable[[Column, Column], Column], kept: Callable[[Column, Column], Column]) -> Column:
    """A text with its spans (sorted by start) rewritten. put: of a span and the end of all before it, what takes its place; kept: whether it is taken."""

    def joined(blocks: Column, listed: Column, before: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            at = F.get(before, i)
            return F.when(kept(s, at), F.concat(_piece(blocks, at, F.greatest(at, s["start"])), put(s, at))).otherwise("")

        last = F.greatest(F.array_max(F.transform(listed, lambda s: s["end"])), F.lit(0))
        return F.array_join(F.concat(F.transform(listed, part), F.array(_piece(blocks, last, F.length(text)))), "")

    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))
    ends = lambda listed: let(F.transform(listed, lambda s: s["end"]), lambda e: _running(e, _most))
    return let(spans, lambda listed: let(ends(listed), lambda before: let(blocks, lambda bs: joined(bs, listed, before))))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """True if the digits pass: every second one from the right doubled, nines cast out, sum a multiple of ten."""
    backwards = F.split(F.reverse(_digits(value)), "")

    def worth(digit: Column, at: Column) -> Column:
        twice = digit.cast("int") * 2
        return F.when(at % 2 == 0, digit.cast("int")).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.filter(backwards, lambda d: d != ""), worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, value>> by kind as in KINDS, then start."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def of(kind: str) -> Column:
        hits = F.filter(_find_all(text, PATTERNS[kind]), lambda s: _passes(kind, s["value"]))
        named = F.transform(hits, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        held = text.rlike(PATTERNS[kind])
        return F.when(held if GATES[kind] is None else F.contains(text, F.lit(GATES[kind])) & held, named).otherwise(none)

    return F.concat(*[of(kind) for kind in KINDS])


def _masked(text: Column, base: Column) -> Column:
    """The text with every base span blanked, so that all other places stay."""
    spans = F.array_sort(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    blanks = lambda s, at: F.repeat(F.lit(" "), F.greatest(at, s["end"]) - F.greatest(at, s["start"]))
    return F.when(F.size(base) > 0, _rewritten(text, spans, blanks, lambda s, at: F.lit(True))).otherwise(text)


def _words(text: Column, base: Column) -> Column:
    """The distinct lower-case words of a text that stand in no base span."""
    return F.array_distinct(F.transform(F.regexp_extract_all(_masked(text, base), F.lit(WORD), F.lit(0)), F.lower))


def _class(word: Column, letters: int) -> Column:
    """The class of the words that begin alike, written as ``ab*``; no word holds a star."""
    return F.concat(F.left(word, F.lit(letters)), F.lit("*"))


def _classes(words: Column) -> Column:
    """The distinct classes that words belong to."""
    return F.concat(*[F.array_distinct(F.transform(words, lambda w: _class(w, n))) for n in LEVELS])


def _described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Input rows as _pii_row, with text, base spans, a key that is equal for equal texts, and a salt that spreads their copies."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_pii_row"), F.col(id_col).alias("_pii_id"), text_of(text_col).alias("_pii_text"))
    salt = F.pmod(F.xxhash64("_pii_id"), F.lit(SALTS)).alias("_pii_salt")
    # a generator of one element: the spans are found once a row, however often they are used above
    return rows.select("*", F.sha2("_pii_text", 256).alias("_pii_key"), salt, F.explode(F.array(base_spans(F.col("_pii_text")))).alias("_pii_base"))


def contexts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text that holds a base span: key, copies, base, words (written once, as several plans read it)."""
    found = _described(docs, id_col, text_col).filter(F.size("_pii_base") > 0)
    rows = found.select(F.col("_pii_key").alias("key"), F.col("_pii_base").alias("base"), _words(F.col("_pii_text"), F.col("_pii_base")).alias("words"))
    return cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.first("base").alias("base"), F.first("words").alias("words")))


def _small(df: DataFrame) -> DataFrame:
    """A written table, for broadcast while its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def disclosures(
    docs: DataFrame, context: DataFrame, *, tokens: Callable[[Column], Column] | None = None, only: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", support: int = 3, generalise: float = 0.8
) -> DataFrame:
    """kind, value, term, disclosure of the words that reach ``generalise``; an empty value stands for any of the kind.

    tokens: what is counted of a text's distinct words instead of them (their classes); only: the terms
    (column term) to which the counts are limited.
    """
    of = tokens or (lambda words: words)
    total = F.broadcast(docs.agg(F.count(F.lit(1)).alias("n")))
    kinds = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), F.lit("").alias("value")))
    values = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), F.lower(b["value"]).alias("value")))
    named = context.select("key", "copies", F.explode(F.array_distinct(F.concat(kinds, values))).alias("e")).select("key", "copies", "e.kind", "e.value")
    # a word's support is at most its entity's, so entities with less need no pairs
    sizes = cut(named.groupBy("kind", "value").agg(F.sum("copies").alias("n_k"), F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= support).drop("texts"))
    known_sizes = _small(sizes)
    entities = named.join(known_sizes, ["kind", "value"], "left_semi").groupBy("key").agg(F.collect_list(F.struct("kind", "value")).alias("entities"))
    near = context.select("key", "copies", F.explode(of(F.col("words"))).alias("term"))
    if only is not None:
        near = near.join(_small(only), "term", "left_semi")
    held = near.join(entities, "key").select("copies", "term", F.explode("entities").alias("e"))
    pairs = held.groupBy("e.kind", "e.value", "term").agg(F.sum("copies").alias("n_wk"), F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= support)
    known = F.log2(F.col("n") / F.col("n_k"))

    def scored(rows: DataFrame) -> DataFrame:
        shared = F.log2(F.col("n_wk") * F.col("n") / (F.col("n_w") * F.col("n_k")))
        return rows.withColumn("disclosure", F.when(known > 0, shared / known).otherwise(F.lit(0.0))).filter(F.col("disclosure") >= generalise)

    # n(w) is at least what the texts with an entity hold, which leaves few words to be counted in all texts
    least = near.groupBy("term").agg(F.sum("copies").alias("n_w"))
    possible = cut(scored(pairs.join(known_sizes, ["kind", "value"]).join(least, "term").join(total, F.lit(True))).drop("n_w", "texts", "disclosure"))
    wanted = cut(possible.select("term").distinct())
    words = _described(docs, id_col, text_col).select(F.explode(F.array(_words(F.col("_pii_text"), F.col("_pii_base")))).alias("words"))
    every, n_w = words.select(F.explode(of(F.col("words"))).alias("term")), F.count(F.lit(1)).alias("n_w")
    if wanted.count() <= BROADCAST_ROWS:
        holding = every.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(n_w)
    else:  # counting first leaves a row per word and task to be shuffled
        holding = every.groupBy("term").agg(n_w).join(wanted, "term", "left_semi")
    return scored(possible.join(holding, "term")).select("kind", "value", "term", "disclosure")


def generalised(terms: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds put to terms: the first class of a term that is not among those that disclose too, or ``[TERM]``."""
    known = classes.select(F.col("term").alias("class")).distinct()
    put = F.lit("[TERM]")
    for n in sorted(LEVELS):
        terms = terms.join(known, _class(F.col("term"), n) == F.col("class"), "left")
        terms = terms.withColumn("put", F.when(F.col("class").isNull(), _class(F.col("term"), n)).otherwise(put)).drop("class")
        put = F.col("put")
    return terms


def find(docs: DataFrame, *, puts: bool = True, id_col: str = "doc_id", text_col: str = "text", support: int = 3, generalise: float = 0.8) -> DataFrame:
    """Input rows as struct _pii_row, with _pii_text, _pii_base (fixed patterns) and _pii_terms (disclosing words, wherever they stand).

    puts: whether it is also found what generalises each term.
    """
    settings = {"id_col": id_col, "text_col": text_col, "support": support, "generalise": generalise}
    context = contexts(docs, id_col=id_col, text_col=text_col)
    terms = cut(disclosures(docs, context, **settings).groupBy("term").agg(F.max("disclosure").alias("disclosure")))
    if puts and not terms.isEmpty():
        own = cut(terms.select(F.explode(_classes(F.array("term"))).alias("term")).distinct())
        terms = cut(generalised(terms, cut(disclosures(docs, context, tokens=_classes, only=own, **settings))))
    else:
        terms = terms.withColumn("put", F.lit("[TERM]"))
    rows = _described(docs, id_col, text_col)
    none = F.array().cast(_TERMS)
    if terms.isEmpty():
        return rows.select("*", none.alias("_pii_terms"))
    words = rows.select("_pii_key", "_pii_salt", F.explode(_words(F.col("_pii_text"), F.col("_pii_base"))).alias("term"))
    hits = words.join(_small(terms), "term")
    # one row per text and salt in use: the copies of one text spread over several join tasks
    held = cut(hits.groupBy("_pii_key", "_pii_salt").agg(F.map_from_entries(F.collect_set(F.struct("term", F.struct("disclosure", "put")))).alias("_pii_held")))
    spans = F.transform(
        _find_all(_masked(F.col("_pii_text"), F.col("_pii_base")), WORD, lambda hit: F.map_contains_key("_pii_held", F.lower(hit))),
        lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), F.try_element_at("_pii_held", F.lower(w["value"])).alias("said")),
    )
    named = F.transform(spans, lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["said"]["disclosure"].alias("disclosure"), w["said"]["put"].alias("put")))
    found = F.when(F.col("_pii_held").isNotNull(), named).otherwise(none)
    entries = held.agg(F.sum(F.size("_pii_held")).alias("n")).first()["n"] or 0
    few = F.broadcast(held) if entries <= BROADCAST_ROWS else held
    return rows.join(few, ["_pii_key", "_pii_salt"], "left").select(*rows.columns, found.alias("_pii_terms"))


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", support: int = 3, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """The input's rows and columns; in the text, base spans become [KIND] and disclosing words their class, [TERM] or nothing."""
    found = find(docs, id_col=id_col, text_col=text_col, support=support, generalise=generalise)
    base = F.transform("_pii_base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("put")))
    words = F.transform(
        F.coalesce("_pii_terms", F.array().cast(_TERMS)),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["disclosure"] >= remove, "").otherwise(s["put"]).alias("put")),
    )
    # a span that begins inside an earlier one goes with it
    clean = _rewritten(F.col("_pii_text"), F.col("_pii_spans"), lambda s, at: s["put"], lambda s, at: s["start"] >= at)
    spanned = found.select("_pii_row", "_pii_text", F.array_sort(F.concat(base, words)).alias("_pii_spans"))
    out = F.when(F.size("_pii_spans") > 0, clean).otherwise(F.col(f"_pii_row.`{text_col}`"))
    return spanned.select(*[out.alias(c) if c == text_col else F.col(f"_pii_row.`{c}`").alias(c) for c in docs.columns])


def report(docs: DataFrame, **settings) -> DataFrame:
    """Per document: doc_id, the number of base spans by kind, base_sha256 and all spans as kind:start:end."""
    found = find(docs, puts=False, **settings)

    def said(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))

    base = said(F.col("_pii_base"))
    words = F.transform(
        F.coalesce("_pii_terms", F.array().cast(_TERMS)),
        lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string")),
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("_pii_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("_pii_id").alias("doc_id"), *[count(kind) for kind in KINDS], F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, words), ",").alias("spans")
    )
