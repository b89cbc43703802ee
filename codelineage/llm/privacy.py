"""Personal data: fixed patterns, and terms that reveal who is meant.

Entities found by the patterns are protected. For every term that shares texts with an entity the corpus tells how
much it gives away: the pointwise mutual information of term and entity, from the different texts in which they stand
together, those that hold the term and those that hold the entity. Terms above the thresholds are spans of
their own wherever they stand, to be generalised or removed with the entity. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelineage.operators.joins import lookup_join, salted_join
from codelineage.storage import written

# Kinds in order. The quantifiers never give back what they took and a match starts where its run does, which finds the
# same matches in time proportional to the text.
KINDS = ("email", "ip", "card", "phone", "term")
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_WORD, _BETWEEN = r"[\p{L}\p{N}]+", r"[^\p{L}\p{N}]+"
_FOUND = "array<struct<start:int,end:int,value:string>>"
# Lists of terms up to this size are broadcast, a few MB; longer ones are joined by a shuffle.
BROADCAST_TERMS = 100_000
# Lists of row numbers up to this size likewise.
BROADCAST_ROWS = 1_000_000


def matches(text: Column, pattern: str) -> Column:
    """All matches as structs start, end (code points, end exclusive) and value."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)  # one more than matches: what stands before, between and after
    steps = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)), found,
        lambda gap, value: F.struct(F.length(gap).alias("gap"), F.length(value).alias("size"), value.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out"))

    def step(s, m):
        begin = s["at"] + m["gap"]
        one = F.struct(begin.alias("start"), (begin + m["size"]).alias("end"), m["value"].alias("value"))
        return F.struct((begin + m["size"]).alias("at"), F.concat(s["out"], F.array(one)).alias("out"))

    return F.aggregate(steps, start, step, lambda s: s["out"])


def _luhn(digits: Column) -> Column:
    def part(d, i):
        n = d.cast("int")
        return F.when(i % 2 == 0, n).otherwise(n * 2 - F.when(n > 4, 9).otherwise(0))

    parts = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), part)
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str):
    def small(part):
        short = F.regexp_replace(part, "^0+(?=.)", "")
        return F.when(F.length(short) <= 3, short.cast("int")) <= 255

    def check(m):
        value = m["value"]
        digits = F.regexp_replace(value, "[^0-9]", "")
        if kind == "ip":
            return F.forall(F.split(value, r"\."), lambda p: F.coalesce(small(p), F.lit(False)))
        if kind == "card":
            return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
        return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)

    return check


def _named(rank: int, kind: str):
    return lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value"))


def base_spans(text: Column) -> Column:
    """Matches of the fixed patterns by start, then kind as in KINDS: structs start, rank, end, kind, value."""
    text = F.coalesce(text, F.lit(""))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    lists = []
    for rank, (kind, pattern) in enumerate(_PATTERNS.items()):
        named = F.transform(F.filter(matches(text, pattern), _valid(kind)), _named(rank, kind))
        can = text.rlike("[0-9]") if _NEEDS[kind] is None else F.contains(text, F.lit(_NEEDS[kind]))
        lists.append(F.when(can, named).otherwise(empty))
    return F.array_sort(F.concat(*lists))


def _places(rows: DataFrame, reach: int) -> DataFrame:
    """(row, entity, start, context, near) of every entity: its surroundings of ``reach`` characters and their words."""
    spans = rows.filter(F.size("spans") > 0).select("row", "text", "spans", F.explode("spans").alias("s"))
    sides = spans.select(
        "row", "spans", F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity"),
        F.greatest(F.col("s.start") - reach, F.lit(0)).alias("left_at"), F.col("s.end").alias("right_at"),
        F.col("s.start").alias("here"), F.length("text").alias("size"), "text",
    ).select(
        "row", "spans", "entity", "left_at", "right_at", "here", "size",
        F.substring("text", F.col("left_at") + 1, F.col("here") - F.col("left_at")).alias("left"),
        F.substring("text", F.col("right_at") + 1, F.lit(reach)).alias("right"),
    )
    shifted = lambda words, by: F.transform(words, lambda w: F.struct(
        (w["start"] + by).alias("start"), (w["end"] + by).alias("end"), F.lower(w["value"]).alias("term")))
    words = F.concat(shifted(matches(F.col("left"), _WORD), F.col("left_at")), shifted(matches(F.col("right"), _WORD), F.col("right_at")))
    # A word that the edge of the context cuts is no whole word; one that touches an entity is part of it.
    whole = lambda w: ((w["start"] > F.col("left_at")) | (F.col("left_at") == 0)) & (
        (w["end"] < F.col("right_at") + reach) | (F.col("right_at") + reach >= F.col("size")))
    context = F.xxhash64(F.regexp_replace(F.lower(F.concat("left", F.lit(" "), "right")), r"\s+", " "))
    near = F.array_distinct(F.transform(F.filter(words, lambda w: whole(w) & _apart(w)), lambda w: w["term"]))
    return sides.select("row", "entity", F.col("here").alias("start"), context.alias("context"), near.alias("near"))


def _apart(word):
    return ~F.exists("spans", lambda s: (word["start"] <= s["end"]) & (s["start"] <= word["end"]))


def _terms(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.lower)


def _free_terms() -> Column:
    """The different words of a text that touch no entity."""
    text, start = F.col("text"), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    tail = lambda piece: F.regexp_replace(piece, r"^[\p{L}\p{N}]++", "")
    head = lambda piece: F.regexp_replace(piece, r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++\z", "")

    def step(s, span):
        piece = F.substring(text, s["at"] + 1, span["start"] - s["at"])
        piece = head(F.when(s["at"] > 0, tail(piece)).otherwise(piece))
        return F.struct(
            F.greatest(s["at"], span["end"]).alias("at"),
            F.when(span["start"] > s["at"], F.concat(s["out"], F.array(piece))).otherwise(s["out"]).alias("out"))

    pieces = F.aggregate("spans", start, step, lambda s: F.concat(
        s["out"], F.array(tail(F.substring(text, s["at"] + 1, F.length(text))))))
    return F.array_distinct(F.flatten(F.transform(pieces, _terms)))


def _marked() -> Column:
    """Spans of the words of ``text`` that ``risky`` (term to share) names and that touch no entity."""
    text, risky = F.col("text"), F.col("risky")
    found = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    gaps = F.split(text, _WORD, -1)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, value: F.struct(
        F.length(gap).alias("gap"), F.length(value).alias("size"), F.lower(value).alias("term")))
    out = "array<struct<start:int,rank:int,end:int,kind:string,value:string,share:double>>"

    def step(s, w):
        begin = s["at"] + w["gap"]
        one = F.struct(
            begin.alias("start"), F.lit(len(KINDS) - 1).alias("rank"), (begin + w["size"]).alias("end"), F.lit("term").alias("kind"),
            w["term"].alias("value"), F.element_at(risky, w["term"]).alias("share"))
        return F.struct(
            (begin + w["size"]).alias("at"),
            F.when(F.map_contains_key(risky, w["term"]), F.concat(s["out"], F.array(one))).otherwise(s["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(out).alias("out"))
    return F.filter(F.aggregate(steps, start, step, lambda s: s["out"]), _apart)


def _one_of_each(rows: DataFrame) -> tuple[DataFrame, int]:
    """(row) of one row for each different text, and how many they are."""
    # Texts are told apart by 128 bits; a large group of copies is reduced in every task first.
    firsts = written(rows.filter(F.col("text").isNotNull()).groupBy(F.md5("text").alias("name")).agg(F.min("row").alias("row")).select("row"), "firsts")
    n = firsts.count()
    return F.broadcast(firsts) if n <= BROADCAST_ROWS else firsts, n


def _held(words: DataFrame, terms: DataFrame) -> DataFrame:
    """The ``words(row, term)`` that are among ``terms(term, ..)``, with the columns of both."""
    few = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    return words.join(F.broadcast(terms), "term") if few else salted_join(words, terms, ["term"], F.col("row"))


def _words(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("text").isNotNull()).select("row", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))


def disclosing_terms(rows: DataFrame, reach: int, least_contexts: int, least_bits: float, least_share: float) -> DataFrame:
    """(term, entity, bits, share): terms that give an entity away, by all different texts of ``rows``.

    All counts but that of the contexts are of different texts, so ``share`` is at most 1 and copies change nothing.
    """
    firsts, n = _one_of_each(rows)
    own = rows.join(firsts, "row", "left_semi")
    places = written(_places(own, reach), "places")
    # Bounds that no pair beyond them can meet: texts of both are no more than those of either.
    most = n / 2.0 ** least_bits * (1 + 1e-9)
    entities = written(
        places.groupBy("entity").agg(F.count_distinct("context").alias("n_contexts"), F.count_distinct("row").alias("n_entity"))
        .filter((F.col("n_contexts") >= least_contexts) & (F.col("n_entity") <= most)).select("entity", "n_entity"), "entities")
    kept = written(lookup_join(places, entities, ["entity"], F.col("row")), "kept")
    holders = written(kept.select("row").distinct(), "holders")
    free = written(
        lookup_join(own.filter(F.size("spans") > 0), holders, ["row"], None, "left_semi").select("row", _free_terms().alias("terms")), "free")
    free = free.select("row", F.explode("terms").alias("term"))
    candidates = written(free.groupBy("term").count().filter(F.col("count") <= most).select("term"), "candidates")
    of_term = written(
        _held(_words(own), candidates).groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).filter(F.col("n_term") <= most), "terms")
    # Every word of a text is in it with every entity of the text; a word that is near none of an entity's places has the first's context.
    first = kept.groupBy("row", "entity", "n_entity").agg(F.min_by("context", "start").alias("first"))
    pairs = (
        _held(free, of_term).join(first, "row").filter(F.col("n_term") * least_share <= F.col("n_entity") * (1 + 1e-9))
        .select("term", "entity", "row", "n_term", "n_entity", "first", F.lit(None).cast("long").alias("context"))
    )
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    near = kept.select(F.explode("near").alias("term"), "entity", "row", none("long", "n_term"), none("long", "n_entity"), none("long", "first"), "context")
    both = (
        pairs.unionByName(near).groupBy("term", "entity", "row")
        .agg(F.max("n_term").alias("n_term"), F.max("n_entity").alias("n_entity"), F.max("first").alias("first"), F.collect_set("context").alias("near"))
        .filter(F.col("first").isNotNull())
        .select("term", "entity", "row", "n_term", "n_entity", F.explode(F.when(F.size("near") > 0, F.col("near")).otherwise(F.array("first"))).alias("context"))
    )
    bits = F.log2(F.col("n_both") * F.lit(float(n)) / (F.col("n_term") * F.col("n_entity")))
    return (
        both.groupBy("term", "entity").agg(
            F.max("n_term").alias("n_term"), F.max("n_entity").alias("n_entity"),
            F.count_distinct("context").alias("n_contexts"), F.count_distinct("row").alias("n_both"))
        .filter(F.col("n_contexts") >= least_contexts)
        .select("term", "entity", bits.alias("bits"), (F.col("n_both") / F.col("n_term")).alias("share"))
        .filter((F.col("bits") >= least_bits) & (F.col("share") >= least_share))
    )


def find(
    docs: DataFrame, *, text: str = "text", reach: int = 80, least_contexts: int = 3, least_bits: float = 6.0,
    least_share: float = 0.5, into: str = "spans",
) -> DataFrame:
    """Add ``into``, the personal data of every row: an array of structs start, rank, end, kind, value, share.

    Positions are code points, end exclusive; spans stand by start, then kind as in KINDS. Kind "term" is a word that
    gives an entity away, wherever it stands in any text without touching an entity: it shares texts with the entity, in
    ``least_contexts`` different contexts or more, carries ``least_bits`` of information on it and, among all different
    texts, shares at least ``least_share`` of its texts with it. The contexts of a word are the ``reach`` characters about those places
    of the entity that it stands within, or about the entity's first place in a text where it stands within none.
    Copies of a text count once in all these numbers, and copies of one context once as contexts. ``share``
    is the largest such part for terms, null for entities. Spans of
    the patterns never change. A null or empty text has none; equal rows get equal spans; all rows
    and other columns stay. A column that is named ``into`` already is replaced.
    """
    given = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    names = [c.lower() for c in docs.columns]
    # The text is written once if it is a column of its own.
    body = f"c{names.index(text.lower())}" if text.lower() in names else "body"
    extra = [] if body != "body" else [F.col(text).alias(body)]
    rows = written(docs.select(*given, *extra, base_spans(F.col(text)).alias("spans")).withColumn(
        "row", F.monotonically_increasing_id()), "texts").withColumn("text", F.col(body))
    risky = disclosing_terms(rows, reach, least_contexts, least_bits, least_share)
    risky = written(risky.groupBy("term").agg(F.max("share").alias("share")), "risky")
    added = _held(_words(rows), risky).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("risky"))
    named = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"),
        F.lit(None).cast("double").alias("share")))
    joined = rows.join(added, "row", "left")
    every = F.when(F.col("risky").isNull(), named).otherwise(F.array_sort(F.concat(named, _marked())))
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() != into.lower()]
    return joined.select(*kept, every.alias(into))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(text: Column, spans: Column, removed_share: float = 0.9) -> Column:
    """The text with entities as [kind], terms that nearly always mean them removed, and other terms as [term]."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(s, span):
        mark = F.when(F.coalesce(span["share"] >= removed_share, F.lit(False)), "").otherwise(F.concat(F.lit("["), span["kind"], F.lit("]")))
        cut = F.concat(s["out"], F.substring(text, s["at"] + 1, span["start"] - s["at"]), mark)
        fresh = span["start"] >= s["at"]
        return F.struct(F.when(fresh, cut).otherwise(s["out"]).alias("out"), F.greatest(s["at"], span["end"]).alias("at"))

    whole = F.aggregate(spans, state, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
