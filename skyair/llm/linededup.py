"""Removal of lines that repeat over documents, as a table of compressed keep bitmaps.

A line's key is the line without white space at its ends and with A-Z lower-cased. A key of at least
``LEAST_LENGTH`` code points that stands in at least ``LEAST_DOCUMENTS`` documents is kept in the document
with the largest id only; there all its lines stay.

The lines of all documents are reduced to (hash, document, position) once and stored. These rows are
partitioned by ranges of the hash and sorted by document, largest first, and position; a pass over each
partition marks the first occurrence in every document, which are then counted. A key may stand in a third
of all documents, so the ranges run over hash and a cell of the document, and the counts of a key's cells
are added up. What comes back per document is the runs of lines it keeps, not text; ``apply`` cuts a text
with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyair.llm.common import stored

LEAST_LENGTH = 40
LEAST_DOCUMENTS = 5
#: Cells that the documents of one key are dealt over.
CELLS = 4096

_WHITE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HASH = ["first_half", "second_half"]
#: A document: its id, and the hash of its text for rows that share an id.
_DOCUMENT = ["document", "digest"]

ORACLE = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (r.key IS NOT NULL AND k.doc_id <> r.holder) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.place) FILTER (r.key IS NULL OR k.doc_id = r.holder), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r ON k.key = r.key
GROUP BY k.doc_id
"""


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _digest(text: Column) -> Column:
    return F.xxhash64(text)


def line_hashes(df: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """Per row: document, digest of its text, number of lines, and position and 128-bit hash of its long lines."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def hashed(line: Column, place: Column) -> Column:
        def of(stripped: Column) -> Column:
            folded = F.translate(stripped, _UPPER, _UPPER.lower())
            # Seeds apart, so the halves are independent.
            halves = lambda k: F.struct(place.alias("place"), F.xxhash64(k).alias(_HASH[0]), F.xxhash64(F.lit(1), k).alias(_HASH[1]))
            return F.when(F.char_length(stripped) >= least_length, _once(folded, halves))

        return _once(F.btrim(line, F.lit(_WHITE)), of)

    found = lambda lines: F.struct(
        F.size(lines).alias("n_lines"), F.filter(F.transform(lines, hashed), lambda x: x.isNotNull()).alias("long_lines")
    )
    rows = df.select(F.col(f"`{key}`").alias("document"), _digest(whole).alias("digest"), _once(_lines(whole), found).alias("f"))
    return rows.select(*_DOCUMENT, "f.n_lines", "f.long_lines")


def repeated(occurrences: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """The hashes that stand in ``least_documents`` or more documents, with the largest of these.

    Rows without an id count as one document, which is the smallest.
    """
    cell = F.pmod(F.xxhash64("document"), F.lit(CELLS))
    rows = occurrences.select(*_HASH, cell.alias("cell"), "document", "place")
    group = [*_HASH, "cell"]
    ordered = rows.repartitionByRange(*group).sortWithinPartitions(*group, F.desc("document"), "place")
    stream = Window.partitionBy(*group).orderBy(F.desc("document"), "place")
    before = F.lag(F.struct("document")).over(stream)  # a struct, so that no row before and no id differ
    marked = ordered.withColumn("first", ~before.eqNullSafe(F.struct("document")))
    counted = marked.groupBy(*_HASH).agg(
        F.sum(F.col("first").cast("bigint")).alias("documents"), F.max("document").alias("holder")
    )
    return counted.filter(F.col("documents") >= least_documents).select(*_HASH, "holder")


def _runs(dropped: Column, n_lines: Column) -> Column:
    """The lines that stay, as runs (first, lines), from the ascending positions of those that go."""

    def of(gone: Column) -> Column:
        starts = F.filter(gone, lambda x, i: (i == 0) | (F.get(gone, i - 1) != x - 1))
        ends = F.filter(gone, lambda x, i: (i == F.size(gone) - 1) | (F.get(gone, i + 1) != x + 1))
        first = F.concat(F.array(F.lit(0)), F.transform(ends, lambda x: x + 1))
        stop = F.concat(starts, F.array(n_lines))
        runs = F.zip_with(first, stop, lambda a, b: F.struct(a.alias("first"), (b - a).alias("lines")))
        return F.filter(runs, lambda r: r["lines"] > 0)

    return _once(dropped, of)


def keep_bitmaps(
    df: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """Per document: ``document``, ``digest`` of its text, ``n_lines``, ``n_dropped`` and ``keep``.

    ``keep`` is the bitmap of kept lines in run-length form: runs (first, lines), ascending. A null or
    empty text is one empty line. Rows that share an id are one document where documents are counted;
    each different text among them has a row here, repeated rows share one. Rows without an id are one
    document, the smallest. An empty table gives no rows. Other columns of ``df`` are ignored.
    """
    lines = stored(line_hashes(df, key, text, least_length), "line-hashes")
    occurrences = lines.select(*_DOCUMENT, F.explode("long_lines").alias("l")).select(*_DOCUMENT, "l.*")
    again = stored(repeated(occurrences, least_documents), "line-repeats")  # stored: a hot hash can then be split
    gone = occurrences.join(again, _HASH).filter(~F.col("document").eqNullSafe(F.col("holder")))
    rows = lines.select(*_DOCUMENT, "n_lines", F.lit(None).cast("int").alias("place")).unionByName(
        gone.select(*_DOCUMENT, F.lit(None).cast("int").alias("n_lines"), "place")
    )
    per_document = rows.groupBy(*_DOCUMENT).agg(F.max("n_lines").alias("n_lines"), F.collect_set("place").alias("gone"))
    return per_document.select(
        *_DOCUMENT,
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.size("gone").cast("bigint").alias("n_dropped"),
        _runs(F.sort_array("gone"), F.col("n_lines")).alias("keep"),
    )


def apply(df: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with every text cut to the lines its bitmap keeps, plus ``n_lines`` and ``n_dropped``.

    A null text becomes an empty one. Every row stays, repeated ones too. Columns of ``df`` named like the
    results are replaced.
    """
    others = [c for c in df.columns if c not in (text, "n_lines", "n_dropped")]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"), F.col(f"`{key}`").alias("own"), whole.alias("whole"),
        _digest(whole).alias("own_digest"),
    )
    same = F.col("own").eqNullSafe(F.col("document")) & (F.col("own_digest") == F.col("digest"))
    # Of most documents every line stays: only the others' bitmaps have to meet their texts.
    cut = rows.join(bitmaps.filter("n_dropped > 0"), same, "left")
    kept = _once(
        _lines(F.col("whole")),
        lambda lines: F.array_join(F.flatten(F.transform("keep", lambda r: F.slice(lines, r["first"] + 1, r["lines"]))), "\n"),
    )
    in_all = F.size(_lines(F.col("whole")))
    return cut.select(
        "row.*",
        F.coalesce("n_lines", in_all.cast("bigint")).alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"),
        F.when(F.col("n_dropped").isNull(), F.col("whole")).otherwise(kept).alias(text),
    )
