"""The operators over the given tables, and SQL where it can say the same."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bwt_merge, html_extract, jaccard_forest, language_id, line_dedup, metric_search, packing, periodic_runs, pitman_yor,
    quality, checks_sql, secret_scan, template_windows, turn_repair,
)
from .common import held, row_slices, shipped

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_quality_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    network = quality.fit(docs, labels, ~held(F.col("doc_id"), 3, 1))
    return quality.score(docs, network, held(F.col("doc_id"), 3, 1))


def op2_html_crf(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.repeats(table(spark, folder, "documents"))


def op4_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, folder, "documents")))


def op5_language_svm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = held(F.col("doc_id"), 5, 0)
    return language_id.predict(docs, language_id.fit(docs, ~held_out), held_out)


def op6_mtree_search(spark: SparkSession, folder: str) -> DataFrame:
    return metric_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_secret_markov(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs))


def op8_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.score(table(spark, folder, "documents"), held(F.col("doc_id"), 7, 2))


def op9_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return template_windows.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_jaccard_forest(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_forest.near_duplicates(table(spark, folder, "documents"))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32(doc_id) % 10 = 0 the words from a certain place on repeat a few of them. A row without id stays."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for part in row_slices(batches):
            texts = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
                words = periodic_runs.split_words(text) if h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    text = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(work, f"doc_id {kind}, text string")


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.report(periodic_runs.find(planted(table(spark, folder, "documents"))))


def op12_bwt_merge(spark: SparkSession, folder: str) -> DataFrame:
    return bwt_merge.report(bwt_merge.without_repeats(table(spark, folder, "documents")))


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """The rows with the faults that the checksum of ``conv_id:turn`` asks for, and how often each is there then."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("k", F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20)
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("k") == 4, "user").otherwise(F.col("role"))})
    return rows, F.when(F.col("k") == 0, 0).when(F.col("k") == 3, 2).otherwise(1)


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.report(turn_repair.edits(*damaged(table(spark, folder, "conversations"))))


QUERIES: dict[str, Query] = {
    name: fn for name, fn in list(globals().items()) if name.startswith("op") and callable(fn)
}
SQL: dict[str, str] = {
    "op3_line_dedup": line_dedup.OP3_SQL, "op11_periodic_runs": checks_sql.PERIODIC_RUNS,
    "op12_bwt_merge": checks_sql.REPEATED_BYTES, "op13_turn_repair": checks_sql.TURN_REPAIR,
}
SQL["op6_mtree_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS "rank" FROM pairs
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
"""
