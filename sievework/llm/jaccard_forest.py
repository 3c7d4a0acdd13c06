"""N-gram Jaccard join with a MinHash LSH forest, and the classes of near duplicates it gives.

A text is the set of its word 5-grams (a word: a run of letters or digits, lower-case; a text of one to four
words is one gram). Texts of the same words are one class of copies, and only one of them goes on. Each
tree of the forest sorts the texts by a sequence of minhashes of its own. The matched prefix starts at
``DEPTH`` hashes and is shortened until pairs at the threshold meet in some tree with probability ``TARGET``
(see ``prefix_length``); the texts under one trie node of that depth are compared by their signatures, and
those that agree in at least half of them (six standard deviations below the threshold) are joined. What is joined
so forms small families, in which every pair is verified exactly on the gram sets. So no list of pairs is
ever made: links are counted where they are found, and classes are connected components.

A node or a family that outgrows a task is cut into blocks, and each pair of blocks is a task of its own.

A NULL or empty text, or one without a word, is a class of its own without links. Rows that repeat an id
and a text are copies like others. NULL ids are kept; a class is named by its smallest id that is not NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.session import stage

from .common import row_slices

GRAM, THRESHOLD = 5, 0.8
TREES, DEPTH, TARGET = 20, 6, 0.9999
#: texts of a trie node, and grams of a family, that one task takes
NODE, FAMILY_GRAMS = 400, 100_000
PLAUSIBLE = 0.5
#: entries of the table by which texts outside of families are passed over, at most
SIEVE = 1 << 20
PIECE = 1 << 20


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = TARGET) -> int:
    """The longest prefix by which a pair at the threshold meets in some tree with the target's probability."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


PREFIX = prefix_length()
HASHES = TREES * PREFIX
_draw = np.random.default_rng(29)
FACTORS = _draw.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint32)
IN_WORD = np.zeros(256, bool)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    IN_WORD[_c] = True
IN_WORD[128:] = True
BASE = 0x9E3779B97F4A7C15 | 1
MIX = np.uint64(0xD6E8FEB86659FD93)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as they were needed."""

    up = powers(BASE, 1024)
    down = powers(pow(BASE, -1, 1 << 64), 1024)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) < n:
            cls.up, cls.down = powers(BASE, 2 * n), powers(pow(BASE, -1, 1 << 64), 2 * n)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word; non-ASCII characters count as letters."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and IN_WORD[data[end]] and IN_WORD[data[end - 1]]:  # not within a word
            end += 1
        part = data[at:end]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = IN_WORD[part]
        edges = np.diff(inside)
        starts, ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
        Powers.reach(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * Powers.up[: len(part)], out=sums[1:])
        out.append(mixed((sums[ends] - sums[starts]) * Powers.down[starts]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def gram_set(words: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The sorted hashes of the different grams."""
    if not len(words):
        return words
    size = min(gram, len(words))
    total = np.full(len(words) - size + 1, np.uint64(size))
    for k in range(size):
        total = total * MIX + words[k:len(words) - size + 1 + k]
    return np.unique(mixed(total))


def minhashes(grams: np.ndarray) -> np.ndarray:
    short = (grams >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(best, (short[None, at:at + 2048] * FACTORS[:, None] + SHIFTS[:, None]).min(1), out=best)
    return best


def tree_keys(hashes: np.ndarray) -> np.ndarray:
    """The trie node of the text in each tree."""
    paths = hashes.reshape(TREES, PREFIX).astype(np.uint64)
    total = np.arange(1, TREES + 1, dtype=np.uint64) * MIX
    for k in range(PREFIX):
        total = mixed(total * MIX + paths[:, k])
    return total.view(np.int64)


def sketch(docs: DataFrame) -> DataFrame:
    """row, doc_id, k1, k2 (identity of id and text), high, low (digest of the words), size, signature, nodes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")

    def look(batches):
        row = TaskContext.get().partitionId() << 40
        for part in row_slices(batches):
            high, low, sizes, signatures, nodes = [], [], [], [], []
            for i, one in enumerate(part.column(3).to_pylist()):
                words = word_hashes(one or "")
                grams = gram_set(words)
                sizes.append(len(grams))
                if len(words):
                    digest = xxhash.xxh3_128_intdigest(words.tobytes())
                    hashes = minhashes(grams)
                    signatures.append(((hashes * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8).tobytes())
                    nodes.append(tree_keys(hashes))
                else:  # like no other
                    digest = row + i
                    signatures.append(b"")
                    nodes.append(np.zeros(0, np.int64))
                high.append((digest >> 64) - (1 << 63))
                low.append((digest & ((1 << 64) - 1)) - (1 << 63))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + part.num_rows)), part.column(0), part.column(1), part.column(2),
                    pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()), pa.array(nodes, pa.list_(pa.int64())),
                ],
                names=["row", "doc_id", "k1", "k2", "high", "low", "size", "signature", "nodes"],
            )
            row += part.num_rows

    return docs.select("doc_id", *identity(), text).mapInArrow(
        look,
        f"row long, doc_id {kind}, k1 long, k2 long, high long, low long, size long, signature binary, nodes array<bigint>",
    )


def identity() -> list:
    """Two hashes of id and text, by which rows are found again."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    return [F.xxhash64(id_, text).alias("k1"), F.xxhash64(text, F.lit(7), id_).alias("k2")]


def groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in their first ``by`` columns, as tables; the rows come sorted."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(by)], 1)
        cuts = np.nonzero((keys[1:] != keys[:-1]).any(1))[0] + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        if held and tuple(keys[0]) != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(edges[:-2], edges[1:-1], strict=True):
            held.append(batch.slice(a, b - a))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(edges[-2]))
        last = tuple(keys[-1])
    if held:
        yield pa.Table.from_batches(held)


def roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component; pairs: index pairs."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs.tolist():
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return np.array([top(x) for x in range(n)], np.int64)


def alike(signatures: np.ndarray, first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Index pairs (first < second unless the sides differ) of similar signatures and sizes, by stripes."""
    least = PLAUSIBLE * HASHES
    same_side = first is second
    stripe = max(1, (1 << 23) // max(1, len(second) * HASHES))
    for at in range(0, len(first), stripe):
        own = first[at:at + stripe]
        other = second[at + 1:] if same_side else second
        equal = (signatures[own][:, None] == signatures[other][None]).sum(2, dtype=np.int32) >= least
        small = np.minimum(sizes[own][:, None], sizes[other][None])
        equal &= small >= THRESHOLD * np.maximum(sizes[own][:, None], sizes[other][None])
        a, b = np.nonzero(equal)
        if same_side:
            keep = b + 1 > a
            a, b = a[keep], b[keep]
        yield np.stack([own[a], other[b]], 1)


def in_blocks(rows: DataFrame, blocks: Column, seed: int) -> DataFrame:
    """The rows with (lo, hi): the pairs of blocks they take part in, and their own ``block``; one block is (0, 0)."""
    own = F.pmod(F.xxhash64("id", F.lit(seed)), blocks)
    rows = rows.withColumn("blocks", blocks.cast("long")).withColumn("block", own.cast("long"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("lo", F.least("block", "with")).withColumn("hi", F.greatest("block", "with"))
    return rows.drop("blocks", "with")


def meet(sketches: DataFrame) -> DataFrame:
    """Edges (a, b), a < b, between texts that share a trie node and agree in their signatures."""
    nodes = sketches.select("id", F.explode("nodes").alias("node"))
    sizes = stage(nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1"), "nodes")
    # most nodes hold one text; signatures travel with the others only
    shared = in_blocks(stage(nodes.join(sizes, "node"), "shared"), F.ceil(F.col("n") / NODE), 41)
    shared = shared.join(sketches.select("id", "size", "signature"), "id")
    shared = shared.select("node", "lo", "hi", "block", "id", "size", "signature")
    shared = shared.repartition("node", "lo", "hi").sortWithinPartitions("node", "lo", "hi", "id")

    def compare(batches):
        found: list[np.ndarray] = []
        for table in groups(batches, 3):
            n = table.num_rows
            if n < 2:
                continue
            ids, block = table["id"].to_numpy(), table["block"].to_numpy()
            signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(n, HASHES)
            sizes_ = table["size"].to_numpy()
            lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
            first = np.nonzero(block == lo)[0]
            second = first if lo == hi else np.nonzero(block == hi)[0]
            root = np.arange(n)
            for pairs in alike(signatures, first, second, sizes_):
                if len(pairs):
                    root = roots(n, np.concatenate([np.stack([root, np.arange(n)], 1), pairs]))
            joined = np.nonzero(root != np.arange(n))[0]
            if len(joined):
                found.append(np.sort(np.stack([ids[root[joined]], ids[joined]], 1), axis=1))
            if sum(map(len, found)) > 50_000:
                yield edges_of(np.unique(np.concatenate(found), axis=0))
                found = []
        if found:
            yield edges_of(np.unique(np.concatenate(found), axis=0))

    return shared.mapInArrow(compare, "a long, b long").distinct()


def edges_of(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def components(edges: DataFrame, label: str) -> DataFrame:
    """(id, root) of every end of an edge: the smallest id of its connected component.

    Each round every node takes its smallest neighbour as parent, parents are followed twice, and the edges
    are drawn between what is left; a round leaves less than half of the nodes that still have edges.
    """
    edges = stage(edges.select("a", "b").filter("a <> b"), f"{label}-edges")
    result = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")).withColumnRenamed("a", "id")
        for _ in range(2):
            parent = stage(parent, f"{label}-parents")
            parent = parent.join(parent.select(F.col("id").alias("p"), F.col("p").alias("q")), "p", "left").select(
                "id", F.coalesce("q", "p").alias("p")
            )
        parent = stage(parent, f"{label}-parents")
        if result is None:
            result = parent.select("id", F.col("p").alias("root"))
        else:
            moved = parent.select(F.col("id").alias("root"), F.col("p").alias("next"))
            result = result.join(moved, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
        a = parent.select(F.col("id").alias("a"), F.col("p").alias("pa"))
        b = parent.select(F.col("id").alias("b"), F.col("p").alias("pb"))
        edges = (
            edges.join(a, "a").join(b, "b").filter("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        )
        edges = stage(edges, f"{label}-edges")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")) if result is None else stage(result, f"{label}-roots")


def verified(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """The pairs whose gram sets have at least the threshold's Jaccard similarity."""
    if not len(pairs):
        return pairs
    sizes = np.array([len(s) for s in sets])
    if len(pairs) <= 400:
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in pairs.tolist()])
    else:
        used, at = np.unique(pairs, return_inverse=True)
        at = at.reshape(-1, 2)
        values = np.concatenate([sets[k] for k in used])
        owner = np.repeat(np.arange(len(used)), sizes[used])
        _, column, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = times > 1  # a gram of one text is common to none
        new = np.cumsum(shared) - 1
        keep = shared[column]
        owner, column = owner[keep], new[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros(len(pairs))
        for left in range(0, int(shared.sum()), 2048):
            span = slice(*np.searchsorted(column, [left, left + 2048]))
            has = np.zeros((len(used), 2048), np.float32)
            has[owner[span], column[span] - left] = 1
            together = has @ has.T
            common += together[at[:, 0], at[:, 1]]
    union = sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - common
    return pairs[common * 5 >= union * 4]


def verify(docs: DataFrame, sketches: DataFrame, families: DataFrame) -> DataFrame:
    """(id, links, parent) of texts with links, in parts to be added up; parent: a linked text, or itself."""
    members = sketches.join(families, "id").select("id", "k1", "k2", "size", "signature", F.col("root").alias("family"))
    members = stage(members, "members")
    grams = members.groupBy("family").agg(F.sum("size").alias("grams"))
    members = in_blocks(members.join(stage(grams, "grams"), "family"), F.ceil(F.col("grams") / FAMILY_GRAMS), 43)
    # of bounded size whatever the input: it passes over most texts while families are few, and never one of a family
    sieve = members.select(F.pmod("k1", F.lit(SIEVE)).alias("mesh")).distinct()
    texts = docs.select(*identity(), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("mesh", F.pmod("k1", F.lit(SIEVE))).join(F.broadcast(sieve), "mesh", "left_semi").drop("mesh")
    rows = texts.join(members, ["k1", "k2"]).select("family", "lo", "hi", "block", "id", "size", "signature", "text")
    rows = rows.repartition("family", "lo", "hi").sortWithinPartitions("family", "lo", "hi", "id")

    def compare(batches):
        for table in groups(batches, 3):
            ids = table["id"].to_numpy()
            ids, once = np.unique(ids, return_index=True)  # rows may repeat
            table, n = table.take(pa.array(once)), len(once)
            if n < 2:
                continue
            block, sizes = table["block"].to_numpy(), table["size"].to_numpy()
            signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(n, HASHES)
            sets = [gram_set(word_hashes(table["text"][i].as_py())) for i in range(n)]
            lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
            first = np.nonzero(block == lo)[0]
            second = first if lo == hi else np.nonzero(block == hi)[0]
            likely = [p for p in alike(signatures, first, second, sizes) if len(p)]
            linked = verified(sets, np.concatenate(likely)) if likely else np.zeros((0, 2), np.int64)
            if len(linked):
                links = np.bincount(linked.ravel(), minlength=n)
                some = np.nonzero(links)[0]
                root = roots(n, linked)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(links[some]), pa.array(ids[root[some]])], names=["id", "links", "parent"]
                )

    return rows.mapInArrow(compare, "id long, links long, parent long")


def classed(docs: DataFrame) -> DataFrame:
    """Per document: row, doc_id, k1, k2, class_root (the smallest row of its class), copies (documents of the same
    words) and n_links (other texts of at least the threshold's similarity)."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    every = stage(sketch(docs), "sketches")
    copies = stage(every.groupBy("high", "low").agg(F.min("row").alias("id"), F.count("*").alias("copies")), "copies")
    firsts = stage(every.join(copies.select(F.col("id").alias("row")), "row").withColumnRenamed("row", "id"), "texts")
    families = components(meet(firsts), "families")
    links = stage(verify(docs, firsts, families), "links")
    classes = components(links.select(F.least("id", "parent").alias("a"), F.greatest("id", "parent").alias("b")).distinct(), "classes")
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    about = copies.join(counted, "id", "left").join(classes, "id", "left").select(
        "high", "low", "copies", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("root", "id").alias("class_root")
    )
    # tables of their own, so that Spark may split a hot class in the joins
    about = stage(about, "about")
    return stage(every.select("row", "doc_id", "k1", "k2", "high", "low").join(about, ["high", "low"]), "classed").drop("high", "low")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the smallest id of the class), n_copies (other documents of the same words) and n_links."""
    rows = classed(docs)
    names = rows.groupBy("class_root").agg(F.min("doc_id").alias("class_id"))
    return rows.join(stage(names, "names"), "class_root").select(
        "doc_id", "class_id", (F.col("copies") - 1).alias("n_copies"), "n_links"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near duplicates of others: of a class the one with the smallest id stays.

    All columns stay as they are. Rows that repeat an id and a text are one document.
    """
    kept = classed(docs).groupBy("class_root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "k1", "k2")).alias("first"))
    kept = kept.select(F.col("first.k1").alias("_kept_1"), F.col("first.k2").alias("_kept_2"))
    k1, k2 = identity()
    keyed = docs.withColumns({"_kept_1": k1, "_kept_2": k2})
    return keyed.join(kept, ["_kept_1", "_kept_2"], "left_semi").dropDuplicates(["_kept_1", "_kept_2"]).drop("_kept_1", "_kept_2")
