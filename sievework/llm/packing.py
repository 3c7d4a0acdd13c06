"""Packing: first-fit decreasing with a tournament tree of bin capacities, in randomised groups of documents.

A document is tokenized as a whole; its ids and the end id are cut into pieces of the sequence length and
one rest. Every piece draws a group at random, and each group packs its pieces by first-fit decreasing: the
tree finds the leftmost bin with room in logarithmic time. The number of groups follows the number of
tokens, so a group has a bounded number of bins and groups are packed in parallel.

A NULL text is an empty one: one piece, the end id alone. Repeated rows are packed each for itself; equal
lengths are taken in the order of their draws. An empty table gives no piece.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.session import stage

from .common import row_slices

LENGTH = 4096
END = 2
#: full sequences a group holds on average
GROUP_SEQUENCES = 512
#: words whose ids a Python worker remembers; beyond that it forgets all of them
REMEMBERED = 500_000
TOKENIZER = "word_bpe_49k.json"

OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

# letters, then marks that the tokenizer cuts off as one piece of their own
PLAIN = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-^`{-~]*)")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it is printable
    in Latin-1, else the next one from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Ids:
    """Token ids of texts as little-endian 16-bit strings, remembered by word.

    The tokenizer never joins pieces across blanks, nor letters with the marks behind them, and it lowers
    the case; so a text's ids are those of its words, and most words occur again and again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge, self.letters = self.tokenizer.model.tokenize, byte_letters()
        self.words: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}

    def _learn(self, missing: set[str]) -> None:
        """Ids of new words. Letters up to y with dots are already normal and one piece, so they go to the merges
        at once; everything else goes through the whole tokenizer."""
        cores, words = self.cores, self.words
        if len(cores) + len(missing) > REMEMBERED:
            cores.clear()
        cores.setdefault("", b"")
        plain, other = [], set()
        for word in missing:
            m = PLAIN.fullmatch(word)
            if m and max(m[1]) <= "ÿ" and m[1].isalpha():
                core, marks = m[1].lower(), m[2]
                if core not in cores:
                    text = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
                    cores[core] = np.array([t.id for t in self.merge(text)], "<u2").tobytes()
            else:
                core, marks = word, ""
                if core not in cores:
                    other.add(core)
            if marks not in cores:
                other.add(marks)
            plain.append((word, core, marks))
        if other:
            new = list(other)
            found = self.tokenizer.encode(new, is_pretokenized=True, add_special_tokens=False)
            ids, owner = np.array(found.ids, "<u2"), np.array(found.word_ids, np.int64)
            ends = np.searchsorted(owner, np.arange(len(new) + 1))
            for k, piece in enumerate(new):
                cores[piece] = ids[ends[k]:ends[k + 1]].tobytes()
        for word, core, marks in plain:
            words[word] = cores[core] + cores[marks]

    def of(self, text: str) -> np.ndarray:
        words = text.replace("\n", " ").replace("\t", " ").split(" ")
        try:
            joined = b"".join(map(self.words.__getitem__, words))
        except KeyError:
            missing = {w for w in words if w not in self.words}
            if len(self.words) + len(missing) > REMEMBERED:
                self.words.clear()
                missing = set(words)
            self._learn(missing)
            joined = b"".join(map(self.words.__getitem__, words))
        return np.frombuffer(joined, "<u2")


@lru_cache(1)
def ids_of(path: str) -> Ids:
    return Ids(path)


def pieces(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece, and a random number for its group."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        encoder, draw = ids_of(path), np.random.default_rng(TaskContext.get().partitionId())
        for part in row_slices(batches):
            owner, rows = [], []
            for i, text in enumerate(part.column(1).to_pylist()):
                ids = np.append(encoder.of(text or ""), np.uint16(end)).astype("<u4")
                for at in range(0, len(ids), length):
                    piece = ids[at:at + length]
                    owner.append(i)
                    rows.append((at, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, pa.int64()) for c in columns),
                 pa.array(draw.integers(0, 1 << 62, len(rows)), pa.int64())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "draw"],
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, draw long"
    )


class Bins:
    """Bins of equal capacity under a tournament tree: each node has the larger room of its two children."""

    def __init__(self, most: int, capacity: int):
        self.leaves = 1 << max(0, (most - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """(bin, room it had) of the leftmost bin with room for the size, which is taken from it."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        bin_, had = at - self.leaves, room[at]
        room[at] -= size
        while at > 1:
            at //= 2
            left, right = room[2 * at], room[2 * at + 1]
            room[at] = left if left > right else right
        return bin_, had


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each size; the sizes come largest first."""
    bins = Bins(max(1, len(sizes)), capacity)
    placed = (bins.put(size) for size in sizes)
    return [(b, capacity - had) for b, had in placed]


def pack(cut: DataFrame, length: int = LENGTH, group_sequences: int = GROUP_SEQUENCES) -> DataFrame:
    """The pieces with the sequence and the offset they got. They are staged: groups are drawn once only."""
    cut = stage(cut, "pieces")
    tokens = cut.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // (length * group_sequences)))
    kind = cut.schema["doc_id"].dataType.simpleString()

    def place(rows: pa.Table) -> pa.Table:
        order = np.lexsort((rows["draw"].to_numpy(), -rows["length"].to_numpy()))
        rows = rows.take(pa.array(order))
        placed = np.array(first_fit_decreasing(rows["length"].to_pylist(), length), np.int64).reshape(-1, 2)
        rows = rows.append_column("sequence_id", pa.array((rows["grp"].to_numpy() << 32) + placed[:, 0]))
        return rows.append_column("offset", pa.array(placed[:, 1])).select(OUT)

    return cut.withColumn("grp", F.pmod(F.col("draw"), F.lit(groups))).groupBy("grp").applyInArrow(
        place,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
