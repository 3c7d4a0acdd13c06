"""Benchmark decontamination by template canonicalisation, with DataFrame functions alone.

Numbers, units behind numbers, and names (capitalised words within a sentence) become typed placeholders
that keep their value; everything else becomes lower-case words. A placeholder belongs to the word before it, so a
template is a row of ordinary words, each with the types of the slots behind it, and a window of ``WINDOW`` such
words is as wide as its slots make it. The last word of a window counts without its slots, and slots before the
first word of a text are left out. Windows start at every word, in documents and items alike. An item of at most
``WINDOW`` words is one whole window, and one without its first word, whose capital makes it a name where it does not
begin the text. Windows of fewer than ``LEAST_LITERAL`` words, or ``LEAST_WORDS`` with all slots of the item, are phrases
that anyone may use: an item that has no others is not looked for.

The windows are joined by hash. First only the hashes of the documents' windows meet those of the benchmark; the
documents that this leaves are read again with the values of their slots. The matches of a document and an item on
one diagonal (the distance of their places) are one occurrence. It is accepted if its slots are consistent
(each value of the item stands for one value in the document throughout) and if its windows cover ``SHARE`` of the
item's words, or ``ENOUGH`` of them: a common phrase is no copy. So copies are found, and questions with other numbers,
names or units too.

NULL and empty texts match nothing, nor does an empty table. Rows that repeat an id and a text are one document, and so
are repeated items; items that share an id are looked for each for itself. NULL ids are reported as NULL. Very long texts
are read whole. Other columns of the documents stay out of the joins, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.session import stage

WINDOW, LEAST_LITERAL, LEAST_WORDS = 6, 3, 6
SHARE, ENOUGH = 0.5, 12

# Placeholders, the mark within a number, and the units that follow numbers.
NUMBER, UNIT, NAME = SLOTS = "\u0001\u0002\u0003"
POINT = "\u0004"
UNITS = (
    "km|m|cm|mm|mi|miles?|yards?|feet|foot|ft|inch(?:es)?|kg|g|mg|lbs?|pounds?|ounces?|oz|tons?|l|ml|litres?|liters?|gallons?"
    "|s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|mph|kmh|km/h|usd|eur|gbp|dollars?|euros?|cents?|percent"
    "|degrees?|watts?|kw|kwh|volts?|hz|mb|gb|tb"
)


def canonical(text: Column) -> Column:
    """Words with single blanks between them; a slot is a placeholder with its value, right behind its word."""
    plain = F.translate(text, SLOTS + POINT, " " * 4)
    numbers = F.regexp_replace(plain, rf"(?i)(?=\d)(?<![\p{{L}}\p{{N}}])(\d+(?:[.,:]\d+)*)(?=(?:{UNITS})?(?![\p{{L}}\p{{N}}]))", NUMBER + "$1")
    units = F.regexp_replace(numbers, rf"(?i){NUMBER}([\d.,:]*\d)[ ]?({UNITS})(?![\p{{L}}\p{{N}}])", f"{NUMBER}$1 {UNIT}$2")
    points = F.regexp_replace(units, r"(?<=\d)[.,:](?=\d)", POINT)
    slots = F.when(text.rlike(r"\d"), points).otherwise(plain)
    names = F.regexp_replace(slots, r"(?=\p{Lu})(?<=[\p{Ll}\p{Nd},;] )(\p{Lu}\p{Ll}+)", NAME + "$1")
    other = rf"[^\p{{L}}\p{{N}}{SLOTS}{POINT}"  # single blanks stay without being replaced
    words = F.trim(F.lower(F.regexp_replace(names, rf" ?+{other} ]{other}]*+| {{2,}}+", " ")))
    return F.regexp_replace(F.regexp_replace(words, rf"^(?:[{SLOTS}][^ ]*(?: |$))+", ""), rf" (?=[{SLOTS}])", "")


def spans(words: Column, length: int, last: bool) -> Column:
    """The windows of this many words at every place, as text: the last word without its slots, or not there at all."""
    inner, end = f"(?:[^ ]++ ){{{length - 1}}}", rf"[^ {SLOTS}]++"
    return F.regexp_extract_all(words, F.lit(f"(?=({inner}{end}))[^ ]++" if last else f"(?=({inner}){end})[^ ]++"), F.lit(1))


def windows(rows: DataFrame, key: list[str], lengths: list[int], values: bool) -> DataFrame:
    """key, length, place and template (a hash) of the windows of ``text`` of these lengths, at every place.

    With ``values`` also the text's ordinary words and words in all, and the values of the window's slots, in order.
    """
    rows = rows.select(*key, canonical(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))
    template = F.regexp_replace("words", rf"([{SLOTS}])[^ {SLOTS}]*", "$1")
    rows = rows.select(*key, *(["words"] if values else []), template.alias("template"))
    n_blanks, n_slots = (F.length("template") - F.length(F.translate("template", x, "")) for x in (" ", SLOTS))
    counted = [(n_blanks + 1).alias("n_literal"), (n_blanks + 1 + n_slots).alias("n_words")] if values else []

    def every(length: int) -> Column:
        found = [spans(F.col("template"), length, True).alias("window")]
        return F.arrays_zip(*found, *([spans(F.col("words"), length, False).alias("valued")] if values else []))

    by_length = F.array(*[F.struct(F.lit(n).alias("length"), every(n).alias("windows")) for n in lengths])
    rows = rows.select(*key, *counted, F.explode(by_length).alias("w")).select(*key, *[c for c in ("n_literal", "n_words") if values], "w.length", F.posexplode("w.windows").alias("place", "w"))
    slots = [F.regexp_extract_all("w.valued", F.lit(rf"[{SLOTS}][^ {SLOTS}]*"), F.lit(0)).alias("slots")] if values else []
    return rows.select(*key, *[c for c in ("n_literal", "n_words") if values], "length", "place", F.xxhash64("length", "w.window").alias("template"), *slots)


def covered(places: Column, length: Column) -> Column:
    """How many words the windows of this length at these places cover."""
    start = F.struct(F.lit(-(1 << 30)).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        F.sort_array(places), start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(length, p - a["last"])).alias("n")), lambda a: a["n"]
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and item it has an occurrence of.

    doc_id, text_hash, item_id, n_windows (most on one diagonal), reworded (slots differ in each occurrence).
    """
    key, item = ["doc_id", "text_hash"], ["item_id", "item_hash"]
    text = F.col("text").cast("string")
    docs = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    items = windows(benchmark.select("item_id", F.xxhash64(text).alias("item_hash"), text.alias("text")), item, list(range(LEAST_LITERAL, WINDOW + 1)), True)
    items = stage(
        items.filter((F.col("length") == WINDOW) | ((F.col("place") + F.col("length") == F.col("n_literal")) & (F.col("place") <= 1) & (F.col("n_words") - F.col("place") >= LEAST_WORDS)))
        .select(*item, "n_literal", "length", F.col("place").alias("item_place"), "template", F.col("slots").alias("item_slots")).distinct(),
        "items",
    )
    # at most WINDOW - LEAST_LITERAL + 1 numbers
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect()) or [WINDOW]
    met = windows(docs, key, lengths, False).join(items.select("template").distinct(), "template", "left_semi").select(*key).distinct()
    met = stage(met.select(*[F.col(k).alias(f"_{k}") for k in key]), "met")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    found = windows(docs.join(met, same, "left_semi"), key, lengths, True).select(*key, "place", "template", "slots")
    hits = found.join(items, "template").withColumn("diagonal", F.col("place") - F.col("item_place"))
    spots = hits.groupBy(*key, *item, "n_literal", "length", "diagonal").agg(
        F.collect_set("item_place").alias("places"),  # as many as the item has words, at most
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "slots")))).alias("pairs"),
    )
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"])))
    changed = F.exists("pairs", lambda p: p["item_slots"] != p["slots"])
    enough = covered(F.col("places"), F.col("length")) >= F.least(F.lit(ENOUGH), F.ceil(F.col("n_literal") * SHARE))
    return (
        spots.filter(consistent & enough)
        .groupBy(*key, "item_id")
        .agg(F.max(F.size("places")).cast("long").alias("n_windows"), F.min(changed).alias("reworded"))
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows and reworded of every contaminated document."""
    return (
        contaminated(docs, benchmark)
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_windows").alias("n_windows"), F.min("reworded").alias("reworded"))
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns.

    What is found is written first: Spark then knows its size, and shuffles the texts only if it is large.
    """
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct()
    bad = stage(bad, "contaminated")
    same = docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(docs["text"].cast("string")) == bad["_bad_hash"])
    return docs.join(bad, same, "left_anti")
