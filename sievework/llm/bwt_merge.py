"""Repeated substrings by merging Burrows-Wheeler transforms of shards.

Every byte covered by a string of LENGTH bytes that also starts in a document with a smaller id is to go. Such a
window belongs to its smallest hashed SAMPLE-gram (the leftmost of equal ones), so equal windows meet wherever they are,
and neighbouring windows with the same one make one short piece of text. The texts lie in chunks of bounded size, which are
stored once, bucketed by chunk, so that no later pass shuffles a text:

1. each chunk sends its different sample hashes, four bytes each, packed by part of the hash space; a part tells the
   chunks which of theirs occur twice or more, and which occur in very many chunks (``HOT_CHUNKS``);
2. each chunk sends the different pieces around those, with the smallest id that holds them. Pieces of a hot sample are
   cut into single windows, dealt by the window's own hash, so that no part meets all surroundings of a hot text;
3. a part keeps one of equal pieces. A sample with one piece left is settled: all holders share all its windows. Of the others
   each shard (the pieces first met in one chunk) gets its transform, and the transforms are merged by interleave
   refinement: step h puts the rows, which are in the order of their first h bytes, into that of the first h + 1 through
   the transforms' last-to-first mapping, one stable pass over the byte before each row; no suffix is sorted again.
   Neighbours that a step parts have a common prefix of that length; rows alone in their interval are left out
   of later steps, and only rows that lead to a whole window are refined. After LENGTH steps the intervals left hold equal windows;
4. the smallest id of each interval goes back to the chunks, which cut their texts.

Hashes have 64 bits (samples 32 within a part: a clash there costs work, not rows). A NULL or empty text has no byte;
one shorter than LENGTH loses none. A NULL id counts as larger than all others. Repeated rows have one id, so
none of them is a smaller document to the other: they keep or lose the same. Texts may be of any length. Further columns are not
read. An empty table gives no row. Ids must be integers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.session import estimated_bytes, shared_folder, stage

from .common import row_slices

LENGTH, SAMPLE = 50, 32
#: text in a chunk, unless one text is longer; stored bytes that one part of the hash space stands for
CHUNK_BYTES, PART_BYTES = 16 << 20, 16 << 20
#: a sample met in more chunks than this is cut into windows, so a part gets its surroundings from so many chunks at most
HOT_CHUNKS = 64
BLOCK, PLACE_BITS = 1 << 18, np.uint64(24)
LAST = (1 << 63) - 1
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * U(0x9E3779B97F4A7C15)
    return x ^ (x >> U(32))


class Grams:
    """Hashes of all substrings of a length, put together from those of the powers of two."""

    def __init__(self, data: np.ndarray) -> None:
        self.of = {1: mixed(data.astype(U) + U(1))}

    def power(self, k: int) -> np.ndarray:
        if k not in self.of:
            half = self.power(k // 2)
            n = max(0, len(half) - k // 2)
            self.of[k] = mixed(half[:n] * U(3) + half[k // 2 : k // 2 + n])
        return self.of[k]

    def length(self, n: int) -> np.ndarray:
        pieces, at = [], 0
        for k in (1 << b for b in reversed(range(n.bit_length()))):
            if n - at >= k:
                pieces.append((k, at))
                at += k
        size = max(0, len(self.of[1]) - n + 1)
        total = self.power(pieces[0][0])[:size].copy()
        for k, at in pieces[1:]:
            total = mixed(total * U(5) + self.power(k)[at : at + size])
        return total


def lowest(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


@dataclass
class Pieces:
    """Stretches of windows with one sample: first and last window's start, the sample's hash, the owner, a digest."""

    first: np.ndarray
    last: np.ndarray
    sample: np.ndarray
    owner: np.ndarray
    digest: np.ndarray

    def __getitem__(self, rows) -> Pieces:
        return Pieces(self.first[rows], self.last[rows], self.sample[rows], self.owner[rows], self.digest[rows])


def joined(first: np.ndarray, last: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Digest of a piece: its first and last window cover it."""
    return mixed(first * U(7) + last) + gap.astype(U)


def pieces(text: np.ndarray, ends: np.ndarray, digests: bool = True) -> Iterator[tuple[int, Pieces, np.ndarray]]:
    """For each block of the texts, which stand one behind the other: where it starts, its pieces and the hash of each window.
    Places are counted from the block's start."""
    for at in range(0, len(text) - LENGTH + 1, BLOCK):
        data = text[at : at + BLOCK + LENGTH - 1]
        grams = Grams(data)
        sample = grams.length(SAMPLE)
        marked = (sample >> PLACE_BITS << PLACE_BITS) | np.arange(len(sample), dtype=U)
        chosen = (lowest(marked, LENGTH - SAMPLE + 1) & U((1 << 24) - 1)).astype(np.int64)
        start = np.arange(len(chosen))
        low, high = np.searchsorted(ends, [at, at + len(chosen) - 1], "right")
        edges = np.clip(ends[low : high + 1] - at, 0, len(chosen))
        owner = low + np.repeat(np.arange(len(edges)), np.diff(edges, prepend=0))
        inside = start + at + LENGTH <= ends[owner]
        start, chosen, owner = start[inside], chosen[inside], owner[inside]
        window = grams.length(LENGTH) if digests else np.empty(0, U)
        if not len(start):
            continue
        new = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])])
        first, last = start[new], start[np.r_[new[1:], len(start)] - 1]
        digest = joined(window[first], window[last], last - first) if digests else np.empty(len(new), U)
        # the least of many hashes is small: hashed anew, samples spread evenly over the parts
        yield at, Pieces(first, last, mixed(sample[chosen[new]]), owner[new], digest), window


def placed(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, the rest of the hash)."""
    return ((hashes >> U(32)) * U(parts) >> U(32)).astype(np.int64), (hashes & U(0xFFFFFFFF)).astype(np.uint32)


def known(hashes: np.ndarray, parts: int) -> np.ndarray:
    part, rest = placed(hashes, parts)
    return (part.astype(U) << U(32)) | rest.astype(U)


def among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether x is in a sorted array."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def whole(column) -> tuple[np.ndarray, np.ndarray]:
    """Binary values one behind the other, and where each ends."""
    values = column.cast(pa.large_binary()).fill_null(b"")
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    if not len(values):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    _, offsets, data = values.buffers()
    edges = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    text = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return text[edges[0] : edges[-1]], edges[1:] - edges[0]


def cut_by(order: np.ndarray, parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, its members) of an order by part."""
    if len(order):
        edges = np.flatnonzero(np.diff(parts[order], prepend=-1))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
            yield int(parts[order[a]]), order[a:b]


# --- transforms of shards and their merge

def transform(text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of strings: the transform (0 ends a string, else byte + 1), and string and offset of each row."""
    n = int(lengths.sum()) + len(lengths)
    which = np.repeat(np.arange(len(lengths)), lengths + 1)
    start = np.cumsum(lengths + 1) - lengths - 1
    offset = np.arange(n) - start[which]
    data = np.zeros(n + 8, np.uint8)
    data[:n][offset < lengths[which]] = text + 1
    left = lengths[which] + 1 - offset
    key = np.zeros(n, U)
    for k in range(8):
        key = (key << U(8)) | np.where(left > k, data[k : k + n], 0).astype(U)
    reach, longest = 8, int(lengths.max()) + 1
    order = np.argsort(key, kind="stable")
    while True:
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) != 0)
        if reach >= longest:
            break
        key = rank * (n + 1) + np.where(left > reach, np.append(rank[reach:], np.zeros(min(reach, n), np.int64)) + 1, 0)
        order = np.argsort(key, kind="stable")
        reach *= 2
    before = np.where(offset[order] > 0, data[order - 1], 0)
    return before.astype(np.uint8), which[order], offset[order]


def merged(shards: list[tuple[np.ndarray, np.ndarray]], length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of ``length`` bytes that occur more than once in the shards, by interleaving their transforms.

    ``shards``: (text, lengths) of the strings of each. Gives (shard's string number over all shards, offset, interval).
    """
    before, to, row, string, offset, base, strings = [], [], [], [], [], 0, 0
    for text, lengths in shards:
        last, which, where = transform(text, lengths)
        leads = np.empty(len(last), np.int64)
        leads[np.argsort(last, kind="stable")] = np.arange(len(last))  # last-to-first
        begins = np.flatnonzero(where >= length)  # the suffix behind a window leads to it in ``length`` steps
        before.append(last)
        to.append(leads + base)
        row.append(begins + base)
        string.append(which[begins] + strings)
        offset.append(where[begins] - length)
        base += len(last)
        strings += len(lengths)
    before, to, row, string, offset = (np.concatenate(x) for x in (before, to, row, string, offset))
    interval = np.zeros(len(row), np.int64)
    window = np.arange(len(row))
    for _ in range(length):
        byte = before[row]
        order = np.argsort(byte, kind="stable")
        byte, interval, row, window = byte[order], interval[order], to[row[order]], window[order]
        first = np.r_[True, (byte[1:] != byte[:-1]) | (interval[1:] != interval[:-1])][: len(row)]
        alone = first & np.r_[first[1:], True][: len(row)]
        interval = np.cumsum(first)[~alone]
        row, window = row[~alone], window[~alone]
        if not len(row):
            break
    return string[window], offset[window], interval


# --- passes

@dataclass
class Store:
    table: str
    parts: int
    kind: str


def store(docs: DataFrame) -> Store:
    """The texts as bytes in chunks, bucketed by chunk."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()

    def chunks(batches):
        n, held = TaskContext.get().partitionId() << 24, 0
        for part in row_slices(batches):
            sizes = part.column(1).cast(pa.large_binary())
            numbers = []
            for text in sizes:
                numbers.append(n)
                held += len(text.as_buffer()) if text.is_valid else 0
                if held >= CHUNK_BYTES:
                    n, held = n + 1, 0
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *part.columns], names=["chunk", "doc_id", "text"])

    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary")).mapInArrow(chunks, f"chunk long, doc_id {kind}, text binary")
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(100_000, max(shuffles, docs.rdd.getNumPartitions()))  # Spark's own limit
    name = f"bwt_texts_{uuid.uuid4().hex}"
    rows.write.format("parquet").option("compression", "zstd").bucketBy(buckets, "chunk").option("path", shared_folder(spark, name)).saveAsTable(name)
    return Store(name, max(shuffles, -(-estimated_bytes(spark.table(name)) // PART_BYTES)), kind)


def shared_samples(texts: DataFrame, parts: int) -> DataFrame:
    """(chunk, part, keys, hot): the samples of a chunk that occur twice or more, and those in very many chunks."""

    def by_part(chunk: int, found: list[np.ndarray]):
        hashes, counts = np.unique(np.concatenate(found), return_counts=True)
        hashes = np.repeat(hashes, np.minimum(counts, 2))  # twice in a chunk is twice
        part, rest = placed(hashes, parts)
        for k, rows in cut_by(np.arange(len(part)), part):
            yield k, chunk, rest[rows].tobytes()

    def send(batches):
        chunk, found, held = None, [], 0
        schema = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary())])

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*by_part(chunk, found), strict=True), schema, strict=True)], schema=schema)

        for part in row_slices(batches, 1024):
            numbers = np.asarray(part.column(0))
            for a, b in zip(edges := [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist()], [*edges[1:], len(numbers)], strict=True):
                if found and (numbers[a] != chunk or held > CHUNK_BYTES // 8):
                    yield batch()
                    found, held = [], 0
                chunk = int(numbers[a])
                for _, some, _ in pieces(*whole(part.column(1).slice(a, b - a)), digests=False):
                    found.append(some.sample)
                    held += len(some.sample)
        if found:
            yield batch()

    def decide(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x, np.uint32) for x in table["keys"].to_pylist()]
        keys, counts = np.unique(np.concatenate(rows), return_counts=True)
        keys = keys[counts > 1]
        chunks, holders = np.array(table["chunk"]), np.zeros(len(keys), np.int64)
        own = [np.unique(x[among(x, keys)]) for x in rows]
        for x in own:
            holders[np.searchsorted(keys, x)] += 1
        hot = keys[holders > HOT_CHUNKS]
        return pa.table({
            "chunk": pa.array(chunks), "part": table["part"],
            "keys": pa.array([x.tobytes() for x in own], pa.binary()), "hot": pa.array([x[among(x, hot)].tobytes() for x in own], pa.binary()),
        })

    sent = texts.select("chunk", "text").mapInArrow(send, "part int, chunk long, keys binary")
    return sent.groupBy("part").applyInArrow(decide, "chunk long, part int, keys binary, hot binary").filter("length(keys) > 0")


def packed(x: np.ndarray) -> bytes:
    return zstandard.compress(x.tobytes(), 1)


def unpacked(values: list[bytes], kind) -> list[np.ndarray]:
    return [np.frombuffer(zstandard.decompress(x), kind) for x in values]


def keys_of(table: pa.Table, column: str) -> np.ndarray:
    """The samples in rows of one chunk, sorted."""
    found = [np.frombuffer(x, np.uint32).astype(U) | (U(p) << U(32)) for p, x in zip(table["part"].to_pylist(), table[column].to_pylist(), strict=True) if x]
    return np.unique(np.concatenate(found)) if found else np.empty(0, U)


def candidates(some: Pieces, window: np.ndarray, parts: int, shared: np.ndarray | None, hot: np.ndarray) -> Pieces:
    """The pieces of shared samples, those of hot ones as single windows with the window's hash for the sample."""
    key = known(some.sample, parts)
    if shared is not None:
        some, key = some[(rows := among(key, shared))], key[rows]
    many = among(key, hot)
    wide = some[many]
    sizes = wide.last - wide.first + 1
    start = np.repeat(wide.first, sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    one = Pieces(start, start, mixed(window[start]), np.repeat(wide.owner, sizes), joined(window[start], window[start], np.zeros(len(start))))
    rest = some[~many]
    return Pieces(*(np.concatenate([getattr(rest, n), getattr(one, n)]) for n in ("first", "last", "sample", "owner", "digest")))


def ids_of(table: pa.Table) -> np.ndarray:
    return np.array(table["doc_id"].cast(pa.int64()).fill_null(LAST))


def offered(texts: DataFrame, shared: DataFrame, parts: int) -> DataFrame:
    """(part, chunk, ...): the different pieces of a chunk that lie in a part, packed; ``least`` the smallest id with each
    and ``several`` whether another document of the chunk has it too."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("key", "digest", "least", "several", "length", "text")
        out = {"part": [], "chunk": [], **{n: [] for n in names}}
        schema = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), *((n, pa.binary()) for n in names)])
        wanted, hot = keys_of(right, "keys"), keys_of(right, "hot")
        if len(wanted) and left.num_rows:
            (text, ends), ids = whole(left["text"]), ids_of(left)
            found = []
            for at, some, window in pieces(text, ends):
                some = candidates(some, window, parts, wanted, hot)
                found.append((some.first + at, some.last - some.first + LENGTH, some.sample, ids[some.owner], some.digest))
            start, length, sample, doc, digest = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((doc, digest))
            new = np.r_[True, digest[order][1:] != digest[order][:-1]][: len(order)]
            group = np.cumsum(new) - 1
            several = np.zeros(int(new.sum()), bool)
            several[group[doc[order] != doc[order][new][group]]] = True
            keep = order[new]
            part, rest = placed(sample[keep], parts)
            for k, rows in cut_by(np.argsort(part, kind="stable"), part):
                at = keep[rows]
                sizes = length[at]
                index = np.repeat(start[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                values = (rest[rows], digest[at], doc[at], several[rows].astype(np.uint8), sizes.astype(np.uint8), text[index])
                out["part"].append(k)
                out["chunk"].append(left["chunk"][0].as_py())
                for n, x in zip(names, values, strict=True):
                    out[n].append(packed(x))
        return pa.table(out, schema=schema)

    return texts.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(
        work, "part int, chunk long, key binary, digest binary, least binary, several binary, length binary, text binary")


def settle(table: pa.Table) -> pa.Table:
    """For the pieces of one part, the runs of their windows that a smaller document holds: (chunk, digest, from, to, least)."""
    kinds = {"key": np.uint32, "digest": U, "least": np.int64, "several": np.uint8, "length": np.uint8}
    columns = {n: unpacked(table[n].to_pylist(), k) for n, k in kinds.items()}
    shard = np.repeat(np.arange(table.num_rows), [len(x) for x in columns["key"]])
    key, digest, least, several, length = (np.concatenate(columns[n]) for n in kinds)
    length = length.astype(np.int64)
    text = np.concatenate(unpacked(table["text"].to_pylist(), np.uint8))
    place = np.cumsum(length) - length
    # one of equal pieces, with the smallest id
    order = np.lexsort((shard, digest))
    new = np.r_[True, digest[order][1:] != digest[order][:-1]]
    piece = np.empty(len(order), np.int64)
    piece[order] = np.cumsum(new) - 1
    one = order[new]
    first = np.minimum.reduceat(least[order], np.flatnonzero(new))
    windows = length[one] - LENGTH + 1
    base = np.cumsum(windows) - windows
    smallest = np.repeat(first, windows)
    # samples with several pieces: merge the transforms of the shards
    alone = np.unique(key[one], return_counts=True)
    merge = np.flatnonzero(alone[1][np.searchsorted(alone[0], key[one])] > 1)
    if len(merge):
        merge = merge[np.argsort(shard[one[merge]], kind="stable")]
        shards = []
        for _, rows in cut_by(np.arange(len(merge)), shard[one[merge]]):
            at = one[merge[rows]]
            index = np.repeat(place[at] - (np.cumsum(length[at]) - length[at]), length[at]) + np.arange(int(length[at].sum()))
            shards.append((text[index], length[at]))
        string, offset, interval = merged(shards, LENGTH)
        if len(string):
            which = merge[string]
            starts = np.flatnonzero(np.diff(interval, prepend=-1))
            low = np.minimum.reduceat(first[which], starts)
            smallest[base[which] + offset] = np.repeat(low, np.diff(np.append(starts, len(interval))))
    # runs of windows with the same smallest id, for every holder that has a larger one
    edge = np.ones(len(smallest), bool)
    edge[1:] = smallest[1:] != smallest[:-1]
    edge[base] = True
    run = np.flatnonzero(edge)
    owner = np.repeat(np.arange(len(one)), windows)[run]
    begin = run - base[owner]
    end = np.append(run[1:], len(smallest)) - base[owner]
    runs_from = np.searchsorted(owner, np.arange(len(one)))
    n_runs = np.bincount(owner, minlength=len(one))
    count = n_runs[piece]
    holder = np.repeat(np.arange(len(piece)), count)
    at = np.repeat(runs_from[piece], count) + np.arange(len(holder)) - np.repeat(np.cumsum(count) - count, count)
    tells = (smallest[run[at]] < least[holder]) | (several[holder] > 0)
    holder, at = holder[tells], at[tells]
    out = {"chunk": [], "digest": [], "from": [], "to": [], "least": []}
    for s, rows in cut_by(np.arange(len(holder)), shard[holder]):
        out["chunk"].append(table["chunk"][s].as_py())
        for n, x in zip(("digest", "from", "to", "least"), (digest[holder[rows]], begin[at[rows]].astype(np.uint8), end[at[rows]].astype(np.uint8), smallest[run[at[rows]]]), strict=True):
            out[n].append(x.tobytes())
    return pa.table(out, schema=pa.schema([("chunk", pa.int64()), *((n, pa.binary()) for n in ("digest", "from", "to", "least"))]))


def cut(texts: DataFrame, shared: DataFrame, settled: DataFrame, parts: int, kind: str) -> DataFrame:
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        (text, ends), ids = whole(left["text"]), ids_of(left)
        hot = keys_of(right, "hot")
        told = right.filter(pc.is_valid(right["digest"]))
        digest, begin, end, least = (
            np.frombuffer(b"".join(told[n].to_pylist()), k) for n, k in (("digest", U), ("from", np.uint8), ("to", np.uint8), ("least", np.int64))
        )
        order = np.argsort(digest, kind="stable")
        digest, begin, end, least = digest[order], begin[order].astype(np.int64), end[order].astype(np.int64), least[order]
        edge = np.zeros(len(text) + 1, np.int32)
        for at, some, window in pieces(text, ends) if len(digest) else ():
            some = candidates(some, window, parts, None, hot)
            low, high = np.searchsorted(digest, some.digest, "left"), np.searchsorted(digest, some.digest, "right")
            count = high - low
            which = np.repeat(np.arange(len(count)), count)
            run = np.repeat(low, count) + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            later = least[run] < ids[some.owner[which]]
            which, run = which[later], run[later]
            np.add.at(edge, some.first[which] + at + begin[run], 1)
            np.add.at(edge, some.first[which] + at + end[run] + LENGTH - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        change = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
        # a span ends with its text
        spans, kept, start = [], [], 0
        marks = np.union1d(change, ends)
        for stop in ends.tolist():
            low, high = np.searchsorted(marks, [start, stop])
            points = [start, *(p for p in marks[low:high].tolist() if p > start), stop]
            spans.append([{"start": a - start, "end": b - start} for a, b in zip(points, points[1:], strict=False) if b > a and gone[a]])
            kept.append(text[start:stop].tobytes() if not spans[-1] else text[start:stop][~gone[start:stop]].tobytes())
            start = stop
        sizes = np.diff(ends, prepend=0)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": left["doc_id"], "n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary())})

    answers = settled.unionByName(shared.filter("length(hot) > 0").drop("keys"), allowMissingColumns=True)
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        work, f"doc_id {kind}, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, spans (removed stretches: start, end in bytes) and kept (the bytes that are left)."""
    spark, at = docs.sparkSession, store(docs)
    texts = spark.table(at.table)
    shared = stage(shared_samples(texts, at.parts), "samples")
    settled = offered(texts, shared, at.parts).groupBy("part").applyInArrow(
        settle, 'chunk long, digest binary, `from` binary, `to` binary, least binary')
    return cut(texts, shared, settled, at.parts, at.kind)


def report(found: DataFrame) -> DataFrame:
    """Per document the lengths and the number of spans, and a digest of what is left."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
