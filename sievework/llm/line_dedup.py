"""Substring dedup by hashing lines: normalise units, group their digests, keep the earliest, remove the rest.

A unit is a line or a sentence of one: the text is cut behind every line feed and behind ``.``, ``!`` or
``?`` with a blank. Normalised it is lower-case with single blanks. Every unit that is not blank counts, however
short; a caller may ask for a least number of blank-separated words (text of a script without blanks is one word). Of equal units over all documents, and within one, the first by
(doc_id, start) stays; the others are reported, or removed, with their offsets in the original text (code
points, end exclusive).

A NULL or empty text has no unit. A NULL id ranks last. Of repeated rows one, whichever was read first,
ranks before the others, and these lose their units. An empty table has no repeats. Very long texts are cut whole. Other columns
are not read; ``deduplicated`` keeps them, and its own column must not be one of them.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.session import stage

from .common import row_slices

#: a digest of more than one in so many units is hot: there are fewer of these than this
HOT_SHARE = 1000
CUT = re.compile(r"[.!?] |\n")


def units(text: str, min_words: int = 1) -> list[tuple[int, int, int, str]]:
    """(start, end, words, normalised) of the units that count; a unit includes the mark it ends with."""
    out, at = [], 0
    for end in [*(m.end() for m in CUT.finditer(text)), len(text)]:
        words = text[at:end].lower().split()
        if len(words) >= min_words:
            out.append((at, end, len(words), " ".join(words)))
        at = end
    return out


def unit_rows(docs: DataFrame, min_words: int = 1, row: str | None = None) -> DataFrame:
    """A row per unit: row (of the document), doc_id, start, end, n_words and a 128-bit digest in two longs.

    row: a column that numbers the documents; without it they are numbered as they are read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        at = TaskContext.get().partitionId() << 40
        for part in row_slices(batches):
            numbers = range(at, at + part.num_rows) if row is None else part.column(2).to_pylist()
            owner, rows = [], []
            for i, text in enumerate(part.column(1).to_pylist()):
                for start, end, words, plain in units(text or "", min_words):
                    digest = xxhash.xxh3_128_intdigest(plain.encode("utf-8", "replace"))
                    owner.append(i)
                    rows.append((numbers[i], start, end, words, (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63)))
            at += part.num_rows
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            row_, start_, end_, words_, high, low = (pa.array(c, pa.int64()) for c in columns)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(owner, pa.int64())), row_, start_, end_, words_, high, low],
                names=["doc_id", "row", "start", "end", "n_words", "high", "low"],
            )

    return docs.select("doc_id", F.col("text").cast("string"), *([F.col(row).cast("long")] if row else [])).mapInArrow(
        cut, f"doc_id {kind}, row long, start long, end long, n_words long, high long, low long"
    )


def again(docs: DataFrame, min_words: int, row: str | None = None) -> DataFrame:
    """Every unit that repeats an earlier one, with the row of its document.

    The digests are grouped with partial sums, so a line that a third of the documents share costs a row
    per task. The digests of more than one in ``HOT_SHARE`` units are less than ``HOT_SHARE`` rows: they are
    broadcast, and their units stay where they are; only the others are shuffled for the join.
    """
    rows = stage(unit_rows(docs, min_words, row), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "start", "row")
    first = stage(
        rows.groupBy("high", "low")
        .agg(F.min(rank).alias("kept"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("high", "low", "n", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.start").alias("kept_start"), F.col("kept.row").alias("kept_row")),
        "repeated",
    )
    key, is_hot = ["high", "low"], F.col("n") * HOT_SHARE > rows.count()
    hot = F.broadcast(first.filter(is_hot).drop("n"))
    found = rows.join(hot, key).unionByName(rows.join(hot.select(*key), key, "left_anti").join(first.filter(~is_hot).drop("n"), key))
    return found.filter((F.col("row") != F.col("kept_row")) | (F.col("start") != F.col("kept_start")))


def repeats(docs: DataFrame, min_words: int = 1) -> DataFrame:
    """Every unit to remove: doc_id, start, end, n_words, and kept_doc_id, kept_start of the one that stays."""
    return again(docs, min_words).select("doc_id", "start", "end", "n_words", "kept_doc_id", "kept_start")


def deduplicated(docs: DataFrame, min_words: int = 1, offsets: str = "kept_spans") -> DataFrame:
    """The documents without the units to remove, and the (start, end) in the original text of what is left of each.

    The documents are numbered and staged, since they are read for their units and again to cut these out. All rows
    and columns stay; a text of which nothing is left is empty, and a NULL text stays NULL, with no offsets.
    """
    names, number = docs.columns, "_" + "_".join(docs.columns)
    numbered = stage(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    gone = again(numbered, min_words, number).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("gone"))
    gone = gone.withColumnsRenamed({"row": f"{number}_row", "gone": f"{number}_gone"})
    rows = numbered.join(gone, F.col(number) == F.col(f"{number}_row"), "left").select(*names, f"{number}_gone")

    def cut(batches):
        for part in row_slices(batches):
            columns = dict(zip(names, part.columns, strict=False))
            cuts = [[(g["start"], g["end"]) for g in some or []] for some in part.column(len(names)).to_pylist()]
            done = [(None, None) if t is None else without(t, c) for t, c in zip(columns["text"].to_pylist(), cuts, strict=True)]
            columns["text"] = pa.array([t for t, _ in done], columns["text"].type)
            spans = [None if s is None else [{"start": a, "end": b} for a, b in s] for _, s in done]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(spans, kind)], names=[*names, offsets])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(cut, f"{schema}, `{offsets}` array<struct<start: bigint, end: bigint>>")


def without(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the spans, and the (start, end) in the original of what is left."""
    left, at = [], 0
    for start, end in sorted(spans):
        if start > at:
            left.append((at, start))
        at = max(at, end)
    if at < len(text):
        left.append((at, len(text)))
    return "".join(text[a:b] for a, b in left), left


OP3_SQL = """
WITH marked AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?] |\\n)', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
cut AS (SELECT doc_id, unnest(parts) AS unit, generate_subscripts(parts, 1) AS k FROM marked),
placed AS (SELECT doc_id, unit, coalesce(sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM cut),
plain AS (SELECT doc_id, start, start + length(unit) AS "end", trim(regexp_replace(lower(unit), '\\s+', ' ', 'g')) AS norm FROM placed),
counted AS (SELECT *, len(string_split(norm, ' ')) AS n_words FROM plain WHERE norm <> ''),
ranked AS (SELECT *, row_number() OVER w AS k, first_value(doc_id) OVER w AS kept_doc_id, first_value(start) OVER w AS kept_start
  FROM counted WHERE n_words >= 1 WINDOW w AS (PARTITION BY norm ORDER BY doc_id, start))
SELECT doc_id, start, "end", n_words, kept_doc_id, kept_start FROM ranked WHERE k > 1
"""
