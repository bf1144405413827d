"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities. How strongly a word near an entity
reveals it is estimated from the corpus: the pointwise mutual information of
word and entity against the information content of the entity. A word whose
share reaches the disclosure threshold would let a reader infer the entity
even where the entity itself is masked, so it is generalised or removed too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abode.llm.common import col, stage

KINDS = ("email", "ip", "card", "phone", "term")
SPAN = "array<struct<start:int,end:int,value:string>>"
#: Code points on each side of an entity in which words may reveal it.
REACH = 60
#: Code points of one stretch of a text; words and entities of a document meet by stretch.
STRETCH = 128
#: Matches that are added up one by one; longer lists are cut into pieces of about the root of their length.
PIECE = 64
#: Different texts in which a word must stand near an entity; 1 judges entities of one text too.
MIN_SUPPORT = 1
THRESHOLD = 0.9
#: Documents with the word that are added, with the entity at its corpus rate: a word
#: seen once proves less than one seen often (half a document, as Krichevsky and Trofimov).
PRIOR = 0.5
#: Terms that a broadcast may hold; more are counted through a shuffle.
BROADCAST_TERMS = 50_000
#: Terms whose hashes a broadcast may hold, so that only words of their hash are shuffled.
BROADCAST_HASHES = 1_000_000
#: Documents with terms that a broadcast may hold; more meet their texts in a shuffle.
BROADCAST_DOCS = 100_000

#: The base patterns (fixed). Possessive and look-behind parts change no match:
#: a run that fails from its start fails from inside too, so it is tried once, and
#: long runs need no stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A term is a whole run of letters, marks and digits, of any length.
TERM = r"[\p{L}\p{M}\p{N}]++"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def spans_of(text: Column, pattern: str, wanted: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches with their code point places, of them
    those whose value is ``wanted``.

    What lies between matches and the matches themselves alternate, so places
    are running sums of lengths. Adding to an array copies it, so sums run inside
    pieces first, and pieces are then moved to their place: n matches cost n to the power 1.5 short copies.
    """
    steps = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(found: Column, step: Column) -> Column:
        first = found["at"] + step["gap"]
        last = first + F.length(step["value"])
        spans = F.concat(found["spans"], F.array(F.struct(first.alias("start"), last.alias("end"), step["value"].alias("value"))))
        if wanted is not None:
            spans = F.when(wanted(step["value"]), spans).otherwise(found["spans"])
        return F.when(step["value"].isNull(), found).otherwise(F.struct(last.alias("at"), spans.alias("spans")))

    def placed(pieces: Column) -> Column:
        ends = F.aggregate(pieces, F.array(F.lit(0)), lambda done, piece: F.concat(done, F.array(F.element_at(done, -1) + piece["at"])))
        return F.flatten(F.zip_with(pieces, F.slice(ends, 1, F.size(pieces)), lambda piece, at: F.transform(
            piece["spans"], lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["value"].alias("value")))))

    def cut(steps: Column) -> Column:
        length = F.greatest(F.lit(PIECE), F.ceil(F.sqrt(F.size(steps))).cast("int"))
        pieces = F.transform(F.sequence(F.lit(1), F.size(steps), length), lambda first: F.aggregate(F.slice(steps, first, length), start, add))
        return _let(pieces, placed)

    return _let(steps, cut)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        return total + F.when(place % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _per_kind(kinds: Sequence[str], fn: Callable[[str, Column], Column]) -> Column:
    """``fn`` of kind and span for the spans of all ``kinds``, in one array."""
    def of(kind: str) -> Column:
        return F.transform(kind, lambda span: fn(kind, span))

    return F.concat(*map(of, kinds))


def _none() -> Column:
    return F.array().cast(SPAN)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind. A cheap test keeps texts without a candidate from the pattern."""
    guarded = lambda test, pattern: F.when(test, spans_of(text, pattern)).otherwise(_none())
    many = lambda value, low, high: F.length(_digits(value)).between(low, high)
    return {
        "email": guarded(text.contains("@"), EMAIL),
        "ip": F.filter(guarded(text.rlike(r"[0-9]\.[0-9]"), IP), lambda s: s["value"].rlike(rf"^{_BYTE}(\.{_BYTE}){{3}}$")),
        "card": F.filter(guarded(text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), CARD),
                         lambda s: F.when(many(s["value"], 16, 19), _luhn(_digits(s["value"]))).otherwise(False)),
        "phone": F.filter(guarded(text.contains("+"), PHONE), lambda s: many(s["value"], 8, 15)),
    }


def _stretches(rows: DataFrame, reach: int) -> DataFrame:
    """Rows with places, once for each stretch of the text that they or their reach touch."""
    return rows.withColumn("stretch", F.explode(F.sequence(F.floor((F.col("start") - reach) / STRETCH), F.floor((F.col("end") + reach) / STRETCH))))


def _near(words: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity, term, doc_key, text_hash): words within reach of an entity that overlap none.

    Both meet by document and stretch, so one long text is many small groups.
    """
    w = _stretches(words.select("doc_key", "start", "end", "term"), 0)
    e = _stretches(entities, REACH).select("doc_key", "stretch", "text_hash", "entity", F.col("start").alias("first"), F.col("end").alias("last"))
    met = w.join(e, ["doc_key", "stretch"])
    overlaps = (F.col("start") < F.col("last")) & (F.col("end") > F.col("first"))
    in_reach = (F.col("start") >= F.col("first") - REACH) & (F.col("end") <= F.col("last") + REACH)
    met = met.filter(overlaps | in_reach).groupBy("doc_key", "text_hash", "start", "term").agg(
        F.max(overlaps).alias("overlaps"), F.collect_set(F.when(in_reach, F.col("entity"))).alias("entities"))
    return met.filter("not overlaps").select(F.explode("entities").alias("entity"), "term", "doc_key", "text_hash").distinct()


def _outside(places: DataFrame, entities: DataFrame) -> DataFrame:
    """``places`` (doc_key, start, end, ...) that overlap no entity."""
    e = _stretches(entities, 0).select("doc_key", "stretch", F.col("start").alias("first"), F.col("end").alias("last"))
    w = _stretches(places, 0)
    over = (w["doc_key"] == e["doc_key"]) & (w["stretch"] == e["stretch"]) & (F.col("start") < F.col("last")) & (F.col("end") > F.col("first"))
    hit = w.join(e, over, "left_semi").select("doc_key", "start").distinct()
    return places.join(hit, ["doc_key", "start"], "left_anti")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                       min_support: int = MIN_SUPPORT) -> DataFrame:
    """One row for each row of ``docs``: the id, ``doc_key`` (hash of id and text) and an
    array of spans (start, end, value) for each kind in ``KINDS``.

    ``term`` holds all occurrences, in every document, of the words that disclose
    an entity, but for those that overlap a base span: of the documents with the word, enough hold the entity
    within reach that the mutual information comes to ``threshold`` times the information of the entity, seen
    in ``min_support`` different texts or more. A word is a whole run of letters, marks and
    digits of any length, in lower case; near an entity only words outside base spans
    count. All counts cover all documents; ``PRIOR`` smooths those of the word, so entities of one document are judged too.

    Null text: no spans. Repeated rows: each gets its spans. Empty table: no
    rows. Other columns are ignored.

    Memory: text moves only if more than ``BROADCAST_DOCS`` documents hold entities or terms. Spans
    of a document are bounded by the document; words meet entities by stretches of the text.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    scan = docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    based = scan.select("id", "text_hash", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    entity = lambda k, s: F.concat(F.lit(f"{k}:"), F.lower(s["value"])).alias("entity")
    every = _per_kind(KINDS[:-1], lambda k, s: F.struct(entity(k, s), s["start"].alias("start"), s["end"].alias("end")))
    found = stage(based.select("id", "text_hash", F.xxhash64("id", "text_hash").alias("doc_key"), *KINDS[:-1]))
    entities = stage(found.select("doc_key", "text_hash", F.explode(every).alias("at")).select("doc_key", "text_hash", "at.*").distinct())
    keyed = docs.select(F.xxhash64(col(id_col).alias("id"), F.xxhash64(text)).alias("doc_key"), text.alias("text"))

    near = stage(_near(_places(keyed, entities.select("doc_key").distinct()), entities))
    terms = stage(_disclosing(docs.select(text.alias("text")), found.count(), entities, near, threshold, min_support).select("term").distinct())
    words = keyed.select("doc_key", F.explode(_words(F.col("text"))).alias("term"))
    held = stage(_among(words, terms).groupBy("doc_key").agg(F.collect_set("term").alias("terms")))
    marked = (_outside(_places(keyed, held, lambda value: F.array_contains("terms", F.lower(value))).distinct(), entities)
              .groupBy("doc_key").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.col("term").alias("value")))).alias("term")))
    return (found.join(marked, "doc_key", "left")
            .select(F.col("id").alias(id_col), "doc_key", *KINDS[:-1], F.coalesce("term", _none()).alias("term")))


def _places(keyed: DataFrame, holders: DataFrame, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """(doc_key, start, end, term): the words, or those ``wanted``, of the documents in ``holders``."""
    holders = stage(holders)
    few = F.broadcast(holders) if holders.count() <= BROADCAST_DOCS else holders
    words = keyed.join(few, "doc_key").select("doc_key", F.explode(spans_of(F.col("text"), TERM, wanted)).alias("word"))
    return words.select("doc_key", "word.start", "word.end", F.lower("word.value").alias("term"))


def _words(text: Column) -> Column:
    """The distinct words of a text, in lower case."""
    return F.array_distinct(F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))), F.lower))


def _hashed_among(words: DataFrame, terms: DataFrame, many: int) -> DataFrame:
    """``words`` whose hash one of the ``many`` terms has; all words if a broadcast can't hold that many hashes."""
    if many > BROADCAST_HASHES:
        return words
    return words.join(F.broadcast(terms.select(F.xxhash64("term").alias("hash"))), F.xxhash64(words["term"]) == F.col("hash"), "left_semi")


def _among(words: DataFrame, terms: DataFrame) -> DataFrame:
    """``words`` that are one of ``terms`` (staged, each once)."""
    many = terms.count()
    if many <= BROADCAST_TERMS:
        return words.join(F.broadcast(terms), "term", "left_semi")
    return _hashed_among(words, terms, many).join(terms, "term", "left_semi")


def _disclosing(texts: DataFrame, total: int, entities: DataFrame, near: DataFrame, threshold: float, min_support: int) -> DataFrame:
    """Pairs of entity and term that reach the threshold."""
    entity_docs = entities.select("entity", "doc_key").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("entity_docs"))
    joint = (near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("joint_docs"), F.count_distinct("text_hash").alias("support"))
             .filter(F.col("support") >= min_support))
    # A term is in at least as many documents as it is near entities; that alone rules common words out.
    near_docs = near.select("term", "doc_key").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("near_docs"))
    information = F.log(F.lit(float(total)) / F.col("entity_docs"))
    rate = F.col("entity_docs") / F.lit(float(max(total, 1)))
    mutual = lambda docs_with_term: F.log((F.col("joint_docs") + PRIOR * rate) / ((docs_with_term + PRIOR) * rate))
    joint = stage(joint.join(entity_docs, "entity").join(near_docs, "term")
                  .filter((information > 0) & (mutual(F.col("near_docs")) >= threshold * information)).drop("near_docs"))
    wanted = joint.select("term").distinct()
    words = texts.select(F.explode(_words(F.col("text"))).alias("term"))
    many = wanted.count()
    if many > BROADCAST_TERMS:
        words = _hashed_among(words, wanted, many)
        counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("term_docs")).join(wanted, "term", "left_semi")
    else:
        counted = words.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("term_docs"))
    reached = mutual(F.col("term_docs"))
    return (joint.join(counted, "term").filter(reached >= threshold * information)
            .select("entity", "term", (reached / information).alias("disclosure")))


def span_text(kinds: Sequence[str]) -> Column:
    """``kind:start:end`` by kind as listed, then start, joined by commas."""
    return F.array_join(_per_kind(kinds, lambda k, s: F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: bool = True, **options) -> DataFrame:
    """``docs`` with entities replaced by their kind in brackets and disclosing terms
    generalised to ``[term]`` or, if ``generalise`` is false, removed. Where spans overlap
    the one that starts first is replaced. A null text stays null."""
    found = find_personal_data(docs, id_col, text_col, **options)
    mark = lambda k: F.lit("" if k == "term" and not generalise else f"[{k}]")
    every = F.array_sort(_per_kind(KINDS, lambda k, s: F.struct(s["start"].alias("start"), s["end"].alias("end"), mark(k).alias("mark"))))
    marks = (found.select("doc_key", every.alias("marks")).filter(F.size("marks") > 0)
             .groupBy("doc_key").agg(F.first("marks").alias("marks")))
    text = F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), text.alias("whole"),
                       F.xxhash64(col(id_col), F.xxhash64(text)).alias("doc_key")).join(marks, "doc_key", "left")

    def replace(done: Column, m: Column) -> Column:
        return F.when(m["start"] < done["at"], done).otherwise(F.struct(
            m["end"].alias("at"), F.concat(done["text"], F.substring(F.col("whole"), done["at"] + 1, m["start"] - done["at"]), m["mark"]).alias("text")))

    rest = lambda done: F.concat(done["text"], F.substring(F.col("whole"), done["at"] + 1, F.length("whole")))
    clean = F.aggregate("marks", F.struct(F.lit(0).alias("at"), F.lit("").alias("text")), replace, rest)
    own = F.col("row").getField(text_col)
    return rows.select(*[(F.when(F.col("marks").isNull() | own.isNull(), own).otherwise(clean).alias(c) if c == text_col else F.col("row").getField(c).alias(c))
                         for c in docs.columns])
