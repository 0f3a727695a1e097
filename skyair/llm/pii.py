"""Personal data: fixed patterns, and terms that give a protected entity away.

Emails, IP addresses, card and phone numbers are found by pattern and check. Each distinct value is a
protected entity. How strongly a term (a run of letters, lower-cased) reveals an entity is estimated from the
whole corpus: with e documents that hold the entity, d that hold the term and j that hold both, of N
documents in all, the pointwise mutual information is log2(j N / (e d)) and the information of the entity
itself log2(N / e). A term that gives at least ``DISCLOSURE`` of that information is generalised in every
document that holds the entity; one that gives all of it is removed. Every row is a document, copies too, and
every entity counts, also one that stands in a single document. A term says something about an entity from
``MIN_DOCUMENTS`` documents on; rarer ones are the noise of a single text. Documents without a protected
entity are left alone.

Patterns find where a match can begin by looking back one character, and use possessive repeats, so a long
run of fitting characters costs one pass and no deep recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import stored

DISCLOSURE = 0.8
#: Documents a term has to stand in to be evidence.
MIN_DOCUMENTS = 3
KINDS = ("email", "ip", "card", "phone")

_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_WORTH_A_LOOK = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
_AT_MOST_255 = r"^(?:0*+(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])?(?:\.|$)){4}$"
_LETTERS = r"\p{L}+"
_SPANS = "array<struct<start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def add(total: Column, k: Column) -> Column:
        digit = F.ascii(F.substr(digits, k, F.lit(1))) - 48
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(k % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(_AT_MOST_255)
    count = F.length(_digits(value))
    if kind == "phone":
        return count.between(9, 15)
    return F.when(count.between(12, 19), _luhn(value)).otherwise(False)


def matches(text: Column, pattern: str, keep) -> Column:
    """Start, end (code points, exclusive) and value of the matches that ``keep`` accepts."""
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + F.length(piece["gap"])
        end = begin + F.coalesce(F.length(piece["value"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), piece["value"].alias("value"))
        kept = F.when(piece["value"].isNotNull() & keep(piece["value"]), F.array_append(state["found"], span))
        return F.struct(end.alias("at"), kept.otherwise(state["found"]).alias("found"))

    return F.aggregate(pieces, start, step)["found"]


def _tagged(spans: Column, kind: str, place: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), s["value"].alias("value"),
        ),
    )


def base_spans(text: Column) -> Column:
    """All base spans of a text, in order of start, then kind."""
    empty = F.array().cast(_SPANS)
    found = [
        _tagged(
            F.when(text.rlike(_WORTH_A_LOOK[kind]), matches(text, _PATTERNS[kind], lambda v, k=kind: _passes(k, v))).otherwise(empty),
            kind, place,
        )
        for place, kind in enumerate(KINDS)
    ]
    return F.array_sort(F.concat(*found))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], F.when(span["kind"] == "email", F.lower(span["value"])).otherwise(_digits(span["value"])))


def _terms(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"\P{L}+")), "")


def _with_base(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key, hash of the text, text and base spans."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{key}`").alias("__key"), body.alias("__text"))
    return rows.withColumn("__hash", F.xxhash64("__text")).withColumn("__base", base_spans(F.col("__text")))


def _entities(spans: Column) -> Column:
    return F.array_distinct(F.transform(spans, _entity))


def disclosing_terms(
    df: DataFrame, key: str = "doc_id", text: str = "text", disclosure: float = DISCLOSURE, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """Rows (entity, term, removed): the terms that reveal an entity, from the whole of ``df``."""
    every = df.select(F.explode(_terms(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("term"))
    # Both tables are stored: as a plain scan they can be split where a term or an entity is very common.
    documents = stored(every.groupBy("term").agg(F.count(F.lit(1)).alias("d")), "pii-documents")
    holders = _with_base(df, key, text).filter(F.size("__base") > 0)
    held = holders.select(F.explode(_entities(F.col("__base"))).alias("entity"), _terms(F.col("__text")).alias("terms"))
    # The empty term stands for the entity itself: it is in every document that holds it.
    both = held.select("entity", F.explode(F.array_append("terms", "")).alias("term"))
    both = stored(both.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("j")), "pii-pairs")
    entities = both.filter(F.col("term") == "").select("entity", F.col("j").alias("e"))
    n = df.count()
    given = F.log2(F.col("j") * n / (F.col("e") * F.col("d")))
    own = F.log2(n / F.col("e"))
    return (
        both.filter(F.col("term") != "")
        .join(documents.filter(F.col("d") >= min_documents), "term")
        # An entity has j documents at least, so none is revealed by a term of more documents than this.
        .filter(F.log2("d") <= disclosure * F.log2("j") + (1 - disclosure) * F.log2(F.lit(n)) + 1e-9)
        .join(entities, "entity")
        .filter((given >= disclosure * own) & (given > 0))
        .select("entity", "term", (given >= own - 1e-9).alias("removed"))
    )


def _term_spans(df: DataFrame, terms: DataFrame, key: str, text: str) -> DataFrame:
    """Per document that holds a revealed entity: its text, base spans and the spans of the terms."""
    holders = _with_base(df, key, text).filter(F.size("__base") > 0).dropDuplicates(["__key", "__hash"])
    # Met term by term: a document receives its own terms only, however many reveal a common entity.
    of_text = (
        holders.select("__key", "__hash", _terms(F.col("__text")).alias("terms"), F.explode(_entities(F.col("__base"))).alias("entity"))
        .select("__key", "__hash", "entity", F.explode("terms").alias("term"))
        .join(terms, ["entity", "term"])
        .groupBy("__key", "__hash")
        .agg(F.collect_set(F.struct("term", "removed")).alias("terms"))
        .withColumnsRenamed({"__key": "__own", "__hash": "__owner"})
    )
    rows = holders.join(of_text, F.col("__key").eqNullSafe(F.col("__own")) & (F.col("__hash") == F.col("__owner")))
    listed_terms = F.transform("terms", lambda t: t["term"])
    removed = F.transform(F.filter("terms", lambda t: t["removed"]), lambda t: t["term"])
    rows = rows.withColumns({"__listed": listed_terms, "__removed": removed})
    words = matches(F.col("__text"), _LETTERS, lambda v: F.array_contains(F.col("__listed"), F.lower(v)))
    rows = rows.withColumn("__words", words)
    outside = F.filter(
        "__words", lambda w: ~F.exists(F.col("__base"), lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))
    )
    kinds = F.transform(
        outside,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(KINDS)).alias("place"), s["end"].alias("end"),
            F.when(F.array_contains(F.col("__removed"), F.lower(s["value"])), "removed").otherwise("term").alias("kind"),
            s["value"].alias("value"),
        ),
    )
    return rows.withColumn("__terms", kinds).select("__key", "__hash", "__text", "__base", "__terms")


def find(df: DataFrame, terms: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, counts of the base kinds, ``base_sha256``, ``spans`` and ``n_terms``.

    A null text counts as empty, and no span gives an empty list. Repeated rows give repeated results, rows
    with a null key stay. Spans of terms never overlap base spans. Other columns are ignored.
    """
    terms = disclosing_terms(df, key, text) if terms is None else terms
    base = _with_base(df, key, text).select("__key", "__hash", "__base")
    added = _term_spans(df, terms, key, text).select(
        F.col("__key").alias("__own"), F.col("__hash").alias("__owner"), "__terms"
    )
    rows = base.join(added, F.col("__key").eqNullSafe(F.col("__own")) & (F.col("__hash") == F.col("__owner")), "left")
    every = F.when(F.col("__terms").isNull(), F.col("__base")).otherwise(F.array_sort(F.concat("__base", "__terms")))
    return rows.select(
        F.col("__key").alias(key),
        *(_count(F.col("__base"), kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"),
        _listed(every).alias("spans"),
        F.coalesce(F.size("__terms"), F.lit(0)).cast("bigint").alias("n_terms"),
    )


def _rewritten(text: Column, spans: Column, removed: str = "") -> Column:
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        mark = F.when(span["kind"] == "removed", F.lit(removed)).otherwise(F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">")))
        before = F.substr(text, state["at"] + 1, span["start"] - state["at"])
        fresh = F.concat(state["out"], before, mark)
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out"),
        )

    done = F.aggregate(spans, start, step)
    return F.concat(done["out"], F.substr(text, done["at"] + 1))


def sanitise(df: DataFrame, terms: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the text of every document that holds personal data rewritten.

    A base span becomes its kind in angle brackets, a revealing term ``<TERM>`` or nothing (``<TERM>`` for
    all of them where what is left would run together to a new base span); where spans overlap, all of
    them are hidden. All other rows and columns stay as they are, null texts too.
    """
    terms = disclosing_terms(df, key, text) if terms is None else terms
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = df.withColumn("__found", base_spans(body))
    clean = marked.filter(F.size("__found") == 0).drop("__found")
    added = _term_spans(df, terms, key, text).select(
        F.col("__key").alias("__own"), F.col("__hash").alias("__owner"), "__terms"
    )
    held = marked.filter(F.size("__found") > 0).withColumn("__hash", F.xxhash64(F.col(f"`{text}`")))
    held = held.join(added, F.col(f"`{key}`").eqNullSafe(F.col("__own")) & (F.col("__hash") == F.col("__owner")), "left")
    none = F.filter("__found", lambda s: F.lit(False))
    spans = F.array_sort(F.concat("__found", F.coalesce("__terms", none)))
    held = held.withColumn("__spans", spans).withColumn("__out", _rewritten(F.col(f"`{text}`"), F.col("__spans")))
    marked_all = _rewritten(F.col(f"`{text}`"), F.col("__spans"), "<TERM>")
    joined = F.exists("__spans", lambda s: s["kind"] == "removed") & (F.size(base_spans(F.col("__out"))) > 0)
    held = held.withColumn(text, F.when(joined, marked_all).otherwise(F.col("__out")))
    return clean.unionByName(held.select(*df.columns))
