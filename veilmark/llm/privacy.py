"""Personal data, and the terms that give it away.  DataFrame functions only.

Emails, addresses of hosts, card and phone numbers are found by patterns in whole texts.  Sanitisation then follows the
information-theoretic view: a term t discloses an entity e when their pointwise mutual information comes close to all
the information that e holds,

    PMI(e; t) = log2(p(e, t) / (p(e) p(t)))  >=  DISCLOSURE * IC(e),    IC(e) = -log2 p(e),

with probabilities estimated as shares of all documents of the corpus, wherever in a document entity and term stand.
Every occurrence outside of entities of a term that discloses one of the document's entities is generalised (numbers,
names) or removed; only documents that hold the entity are changed.

A pair also has to be more than chance.  If entity and term were independent, so many common documents would have at
most the probability ``2^-n_term KL(n_pair / n_term, n_entity / total)`` (Hoeffding's bound, which holds for draws without
replacement; exact for up to 16 documents that all hold the entity); that times the number of distinct terms may be ``CHANCE``.  An entity of two documents is thus reached
unless the corpus is small.  One of a single document is not while the corpus has more than ``CHANCE`` distinct terms a
document: each of the words that occur there only would have all of its information, so that no word tells more of it
than the others.

Nothing is left out to save work: a pair needs ``n_term <= n_entity (total / n_entity)^(1 - DISCLOSURE)``, as ``n_pair`` is at
most ``n_entity``, and the bound above at ``n_pair = n_term``; both follow from the counts alone and go before pairing.
Entities in the same documents share all counts and are paired as one class.

Null text is empty.  Repeated rows count as documents of their own and get equal results.  A row without an id is
treated like any other.  Texts of any length are searched whole.  Spans that start together are listed by their end;
pairs that reach the bounds exactly count.  An empty table gives no rows.  Columns other than ``doc_id`` and ``text`` are
not read; ``sanitised`` returns them all, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import fresh, stored

#: The patterns have to find the same spans as: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, ip
#: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), card [0-9]([\x20-]?[0-9])+ of 16 to 19 digits, phone
#: \+[0-9][\x20().0-9-]+[0-9].  Possessive repeats keep Java from recursing, and a match only starts where a run of its
#: first characters starts or the last match ended, so long runs are not tried at every place.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character that every match of the kind has.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = tuple(PATTERNS)
TERM = r"[\p{L}\p{N}]+"
#: Share of an entity's information, expected number of terms that disclose an entity by chance.
DISCLOSURE, CHANCE = 0.95, 0.01
#: Room for rounding where pairs are left out by a bound.
SLACK = 1e-6

SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(text: Column, pattern: str) -> Column:
    """``start, end, value`` of all matches, in code points: lengths of the matches and of the texts between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.zip_with(between, found, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(done, step):
        start = done.at + step.gap
        end = start + F.length(step.value)
        span = F.struct(start.alias("start"), end.alias("end"), step.value.alias("value"))
        return F.struct(end.alias("at"), F.concat(done.spans, F.array(span)).alias("spans"))

    return F.aggregate(steps, begin, add, lambda done: done.spans)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_ip(value: Column) -> Column:
    def small(part):
        bare = F.regexp_replace(part, "^0+(?=.)", "")
        return (F.length(bare) <= 3) & (F.substring(bare, 1, 3).cast("int") <= 255)

    return F.forall(F.split(value, r"\."), small)


def _is_card(value: Column) -> Column:
    digits = _digits(value)

    def weighed(digit, place):
        doubled = digit.cast("int") * F.when((F.length(digits) - place) % 2 == 0, 2).otherwise(1)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    total = F.aggregate(F.transform(F.split(digits, "(?<=.)(?=.)"), weighed), F.lit(0), lambda a, b: a + b)
    return F.length(digits).between(16, 19) & (total % 10 == 0)


CHECKS = {
    "email": lambda value: F.lit(True),
    "ip": _is_ip,
    "card": _is_card,
    "phone": lambda value: F.length(_digits(value)).between(8, 15),
}


def entities(text: Column) -> Column:
    """Spans of personal data as ``kind, start, end, value``, by kind and start."""

    def of_kind(kind: str) -> Column:
        found = F.filter(matches(text, PATTERNS[kind]), lambda s: CHECKS[kind](s.value))
        if NEEDS[kind]:
            found = F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(F.array().cast(SPAN))
        return F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s.start, s.end, s.value))

    return F.concat(*[of_kind(kind) for kind in KINDS])


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))


def _best(n_term: Column, n_entity: Column, total: Column) -> Column:
    """Bits of chance against all of ``n_term`` documents holding the entity; the later factors by their bound."""
    first = F.least(n_term, n_entity, F.lit(16))
    exact = F.transform(F.sequence(F.lit(0), first.cast("int") - 1), lambda i: F.log2((total - i) / (n_entity - i)))
    return F.aggregate(exact, F.lit(0.0), lambda a, b: a + b) + (n_term - first) * F.log2(total / n_entity)


def _surprise(n_pair: Column, n_term: Column, n_entity: Column, total: Column) -> Column:
    """Bits of chance against ``n_pair`` or more of ``n_term`` documents holding the entity: Hoeffding's bound but for all."""
    share, part, rest = n_entity / total, n_pair / n_term, (n_term - n_pair) / n_term
    some = n_term * (part * F.log2(part / share) + rest * F.log2(rest / (1 - share)))
    return F.when(n_pair == n_term, _best(n_term, n_entity, total)).when(part > share, some).otherwise(0.0)


def _places(marked: DataFrame, found: DataFrame) -> DataFrame:
    """``marked_id, marked_key, added``: all occurrences outside entities of the marked terms of every text."""
    listed = marked.select("marked_id", "marked_key").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("marked_id")) & (F.col("text_key") == F.col("marked_key"))
    texts = found.filter(F.size("base") > 0).dropDuplicates(["doc_id", "text_key"]).join(listed, same, "left_semi")
    words = F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    gaps = F.split("text", TERM, -1)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(words)), words, lambda g, w: F.struct(F.length(g).alias("gap"), w.alias("word")))
    spans = F.transform("base", lambda s: F.struct(s.start.alias("start"), s.end.alias("end")))
    tokens = texts.select("doc_id", "text_key", F.posexplode(steps).alias("place", "step"))
    # A window never holds more than the words of one text.
    here = Window.partitionBy("doc_id", "text_key").orderBy("place")
    end = F.sum(F.col("step.gap") + F.length("step.word")).over(here).cast("int")
    tokens = tokens.select("doc_id", "text_key", F.col("step.word").alias("word"), end.alias("end"))
    tokens = tokens.withColumn("start", F.col("end") - F.length("word")).withColumn("term", F.lower("word"))
    tokens = tokens.join(marked, same & (F.col("term") == F.col("marked_term")), "left_semi")
    places = tokens.groupBy(F.col("doc_id").alias("marked_id"), F.col("text_key").alias("marked_key")).agg(
        # Bounded by the words of one text.
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("all")
    )
    places = places.join(texts.select("doc_id", "text_key", spans.alias("spans")), same)
    free = F.filter("all", lambda t: ~F.exists("spans", lambda s: (s.start < t.end) & (s.end > t.start)))
    return places.select("marked_id", "marked_key", free.alias("added"))


def spans(documents: DataFrame, disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """``doc_id, text_key, base, added``: the entities of every row, and the terms that disclose one of them."""
    rows = documents.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    found = rows.withColumn("base", entities(F.col("text")))
    kept = F.when(F.size("base") > 0, F.col("text"))
    found = stored(found.select("doc_id", "text_key", "base", kept.alias("text")), "entities")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    of_term = rows.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    of_term = stored(of_term, "terms")
    total = F.lit(float(max(found.count(), 1)))
    needed = F.log2(F.lit(max(of_term.count(), 1) / chance))

    held = found.select(
        "doc_id",
        "text_key",
        F.explode(F.array_distinct(F.transform("base", lambda s: F.xxhash64(s.kind, F.lower(s.value))))).alias("entity"),
    )
    held = held.groupBy("doc_id", "text_key", "entity").agg(F.count(F.lit(1)).alias("copies"))
    # Documents per entity, and sums of hashes that are equal for entities of the same documents.
    hashes = [F.xxhash64(F.lit(i), "doc_id", "text_key") for i in range(2)]
    parts = [p for h in hashes for p in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    sums = [F.sum(F.col("copies") * p).alias(f"sum_{i}") for i, p in enumerate(parts)]
    of_entity = held.groupBy("entity").agg(F.sum("copies").alias("n_entity"), *sums)
    share = F.col("n_entity") / total
    of_entity = of_entity.select(
        "entity",
        "n_entity",
        F.xxhash64("n_entity", *[f"sum_{i}" for i in range(len(parts))]).alias("class"),
        (F.col("n_entity") * F.pow(1 / share, F.lit(1 - disclosure))).alias("limit"),
    ).filter((share < 1) & (_best(F.col("n_entity"), F.col("n_entity"), total) >= needed - SLACK))
    held = stored(
        held.join(of_entity, "entity")
        .groupBy(F.col("doc_id").alias("held_id"), F.col("text_key").alias("held_key"), "class", "n_entity", "limit")
        .agg(F.max("copies").alias("copies")),
        "classes",
    )

    most = held.agg(F.max("limit")).first()[0]
    same = F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("text_key") == F.col("held_key"))
    texts = found.filter(F.size("base") > 0).join(held.select("held_id", "held_key").distinct(), same, "left_semi")
    texts = texts.dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text_key", F.explode(words).alias("term"))
    rare = of_term.filter(F.col("n_term") <= F.lit(most or 0.0) + SLACK)
    possible = _best(F.col("n_term"), F.col("n_entity"), total) >= needed - SLACK
    pairs = texts.join(rare, "term").join(held, same & (F.col("n_term") <= F.col("limit") + SLACK) & possible)
    pairs = stored(pairs.select("held_id", "held_key", "class", "term", "n_entity", "n_term", "copies"), "pairs")
    counted = pairs.groupBy("class", "term", "n_entity", "n_term").agg(F.sum("copies").alias("n_pair"))
    information = F.log2(total / F.col("n_entity"))
    shared = F.log2(F.col("n_pair") * total / (F.col("n_entity") * F.col("n_term")))
    beyond = _surprise(F.col("n_pair"), F.col("n_term"), F.col("n_entity"), total) >= needed
    disclosing = counted.filter((shared >= disclosure * information) & beyond).select("class", "term")
    marked = pairs.join(disclosing, ["class", "term"]).select(
        F.col("held_id").alias("marked_id"), F.col("held_key").alias("marked_key"), F.col("term").alias("marked_term")
    )
    places = _places(stored(marked.distinct(), "marked"), found)
    same = F.col("doc_id").eqNullSafe(F.col("marked_id")) & (F.col("text_key") == F.col("marked_key"))
    added = F.transform(
        F.coalesce("added", F.array().cast("array<struct<start:int,end:int>>")),
        lambda s: F.struct(F.lit("term").alias("kind"), s.start.alias("start"), s.end.alias("end")),
    )
    base = F.transform("base", lambda s: F.struct(s.kind, s.start, s.end))
    return found.join(places, same, "left").select("doc_id", "text_key", base.alias("base"), added.alias("added"))


def personal_data(documents: DataFrame, **terms) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row of ``documents``."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return spans(documents, **terms).select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )


def sanitised(documents: DataFrame, **terms) -> DataFrame:
    """The columns of ``documents`` with its text sanitised: entities by their kind, numbers and names generalised."""
    found_id, found_key, found_spans = fresh(documents.columns, "found_id", "found_key", "found_spans")
    found = spans(documents, **terms).dropDuplicates(["doc_id", "text_key"])
    found = found.select(
        F.col("doc_id").alias(found_id),
        F.col("text_key").alias(found_key),
        F.array_sort(
            F.transform(F.concat("base", "added"), lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind))
        ).alias(found_spans),
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col(found_id)) & (F.xxhash64(text) == F.col(found_key))

    def put(done, span):
        value = text.substr(span.start + 1, span.end - span.start)
        general = F.when(value.rlike(r"^\p{N}+$"), "[number]").when(value.rlike(r"^\p{Lu}"), "[name]").otherwise("")
        label = F.when(span.kind == "term", general).otherwise(F.concat(F.lit("["), span.kind, F.lit("]")))
        free = span.start >= done.at
        before = text.substr(done.at + 1, span.start - done.at)
        out = F.when(free, F.concat(done.out, before, label)).otherwise(done.out)
        return F.struct(F.greatest(done.at, span.end).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(found_spans, begin, put, lambda d: F.concat(d.out, text.substr(d.at + 1, F.length(text))))
    names = documents.columns
    joined = documents.join(found, same, "left").withColumn(
        "text", F.when(F.size(found_spans) > 0, rest).otherwise(F.col("text"))
    )
    return joined.select(names)
