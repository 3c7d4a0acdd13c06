"""Scores by a hierarchical Pitman-Yor model, trained on the documents that are not held out.

Tokens are the words of a text, A-Z lowered, and one end, which is the empty word. The restaurant of a context
serves the words that follow a word (or the start of a text); these context restaurants share the word restaurant
as their parent, and what that serves anew it draws from a spelling model, whose restaurants are the contexts of
up to ``ORDER`` preceding bytes of the word, a context sharing the parent that lacks its first byte, down to the
uniform distribution over bytes and the stop. As in the base, a word that has no training token is the one
outcome "unknown": it has all the probability that the model leaves to spellings that are not in training. A
context that has no training token is left to the word restaurant.

The seating (customers and tables of every dish) is sampled by Gibbs sweeps over all levels: given the parents'
predictive probabilities the customers of each dish are seated one after the other, and tables become the
parents' customers: those of contexts in the word restaurant, those of words in the spelling restaurants. After
``BURN`` sweeps, the predictive probabilities of ``SAMPLES`` sweeps are averaged.

What grows with the corpus is dealt by Spark in blocks: words and their pairs by a hash of the word, so that a block
holds whole word vocabularies and is merged, seated and scored by one task. A block knows its contexts by their hash;
what a context has in all blocks is summed by ranges of that hash, and each block is told the sums it needs. The
spelling restaurants of two and three bytes are a table partitioned by their last two bytes, which hold whole
restaurants of both lengths. The driver seats the restaurants of at most one byte, 257 * 258 dishes at most.

A dish with one customer always has one table. Such pairs (four fifths of them) take part in all sums, but only
the others are seated again in the sweeps. What a sweep has written is deleted when the next one has read it.

Where a pair occurs goes with its block, in parts of about ``PLACES`` places: the places of a very common word grow with the
corpus, its pairs no faster than the vocabulary. Sums by block and text are added up by text. Words are hashed to 63 bits;
every context but the start is a word too, so a block sees it when two words share a hash, and another seed is taken.

A NULL text is an empty one: the end alone. A row without an id is held out. Without any training token
there is one outcome, and every score is 0. Repeated rows are scored each for itself.
"""

from __future__ import annotations

import pickle
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.session import discard, estimated_bytes, release, shared_folder, stage

from .common import row_slices

ORDER = 3
BURN, SAMPLES = 4, 3
WORD_STRENGTH = 1.0
DISCOUNTS, STRENGTH = (0.3, 0.5, 0.7, 0.8), 1.0
#: context lengths whose restaurants the driver seats
TOP = 1
#: tokens a task gathers before it deals their pairs to the blocks
GATHERED = 2_000_000
#: places of pairs that are in memory at once, beside a block's pairs; they are stored in parts of so many
PLACES = 1_000_000
#: of the documents' files for each block, at least
BLOCK_BYTES = 4 << 20
NUMBER_BITS = 28
STOP, PAD, SYMBOLS, BITS = 256, 257, 257, 9
#: customers that are seated one by one; later ones in growing parties
SINGLE = 32


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def seated(customers: np.ndarray, base: np.ndarray, strength: np.ndarray, discount: float, draw) -> np.ndarray:
    """Tables of each dish: its customers sit down one after the other at an old table or a new one.

    base: the parent's probability of the dish; strength: theta + discount * tables of its restaurant.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    done = tables.copy()
    new = strength * base
    party = 1
    while True:
        open_ = np.nonzero(customers > done)[0]
        if not len(open_):
            return tables
        many = np.minimum(party, customers[open_] - done[open_])
        middle = done[open_] + (many - 1) / 2
        chance = new[open_] / (new[open_] + np.maximum(middle - discount * tables[open_], 1e-9))
        tables[open_] += draw.binomial(many, np.clip(chance, 0, 1))
        done[open_] += many
        if done.max() >= SINGLE:
            party *= 2


class Level:
    """The restaurants of one context length: dishes by (context, byte), and sums by context."""

    def __init__(self, keys: np.ndarray, customers: np.ndarray, discount: float):
        self.keys, self.customers, self.discount = keys, customers, discount
        self.tables = np.minimum(customers, 1)
        self.contexts, self.context_of = np.unique(keys >> BITS, return_inverse=True)
        self.sums()

    def sums(self) -> None:
        n = len(self.contexts)
        self.all_customers = np.bincount(self.context_of, self.customers, minlength=n)
        self.all_tables = np.bincount(self.context_of, self.tables, minlength=n)

    def predictive(self, keys: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Probability of each (context, byte), given the parent's."""
        if not len(self.keys):
            return parent
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        own = np.where(hit, self.customers[at] - self.discount * self.tables[at], 0)
        context = keys >> BITS
        c = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        known = self.contexts[c] == context
        new = STRENGTH + self.discount * np.where(known, self.all_tables[c], 0)
        return (own + new * parent) / (STRENGTH + np.where(known, self.all_customers[c], 0))


def shortened(keys: np.ndarray, length: int) -> np.ndarray:
    """The key of a shorter context: its last ``length`` bytes and the symbol."""
    return keys & np.int64((1 << (BITS * (length + 1))) - 1)


class Spelling:
    """Byte restaurants of all context lengths in memory: what ``Letters`` does by partitions, for small vocabularies."""

    def __init__(self, keys: np.ndarray, customers: np.ndarray, order: int, burn: int = BURN, samples: int = SAMPLES, seed: int = 3):
        self.order, draw = order, np.random.default_rng(seed)
        by_key = np.argsort(keys)
        levels = [Level(keys[by_key], customers[by_key].astype(np.int64), DISCOUNTS[order])]
        up = []  # dish of the parent that a dish's tables are customers of
        for length in range(order - 1, -1, -1):
            parents, to = np.unique(shortened(levels[0].keys, length), return_inverse=True)
            tables = np.bincount(to, levels[0].tables, minlength=len(parents)).astype(np.int64)
            levels.insert(0, Level(parents, tables, DISCOUNTS[length]))
            up.insert(0, to)
        self.samples: list[list[Level]] = []
        for sweep in range(burn + samples):
            above = [np.full(len(levels[0].keys), 1 / SYMBOLS)]
            for length in range(order):  # the parents' predictive probability of each dish below
                p = levels[length].predictive(levels[length].keys, above[length])
                above.append(p[up[length]])
            for length in range(order, -1, -1):
                level = levels[length]
                if length < order:
                    level.customers = np.bincount(up[length], levels[length + 1].tables, minlength=len(level.keys)).astype(np.int64)
                strength = STRENGTH + level.discount * level.all_tables[level.context_of]
                level.tables = seated(level.customers, above[length], strength, level.discount, draw)
                level.sums()
            if sweep >= burn:
                frozen = []
                for level in levels:
                    copy = Level.__new__(Level)
                    copy.__dict__ |= level.__dict__
                    frozen.append(copy)
                self.samples.append(frozen)

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        """Mean predictive probability of each (context, byte)."""
        total = np.zeros(len(keys))
        for levels in self.samples:
            p = np.full(len(keys), 1 / SYMBOLS)
            for length, level in enumerate(levels):
                p = level.predictive(shortened(keys, length), p)
            total += p
        return total / max(1, len(self.samples))

    def words(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithm of the probability of each word's spelling."""
        if not words:
            return np.zeros(0)
        keys, owner = grams(words, self.order)
        unique, back = np.unique(keys, return_inverse=True)
        return np.bincount(owner, np.log(self.symbols(unique))[back], minlength=len(words))


def grams(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of (context, byte) for all bytes and stops of the words, and the word of each."""
    lengths = np.array([len(w) + 1 for w in words])
    ends = np.cumsum(lengths)
    symbols = np.frombuffer(b"".join(w + b"\0" for w in words), np.uint8).astype(np.int64)
    symbols[ends - 1] = STOP
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(symbols)) - np.repeat(ends - lengths, lengths)
    keys = symbols.copy()
    for back in range(1, order + 1):
        before = np.where(place >= back, np.roll(symbols, back), PAD)
        keys |= before << (BITS * back)
    return keys, owner


class Tokens:
    """The tokens of texts as numbers: ``words`` in the order of their numbers, the empty one (start and end) first."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[b""]

    def numbered(self, text: str | None) -> np.ndarray:
        """The numbers of the start, the words and the end of a text."""
        words = words_of(text)
        ids = np.zeros(len(words) + 2, np.int32)
        ids[1:-1] = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        return ids


#: what a row of MAIL holds: a block's seating, offers to contexts and what they answer, dishes of words, sums, a sample
STATE, OFFER, ANSWER, DISHES, SUMS, SAMPLE = range(6)
TOLD = -1
MAIL = "kind int, block long, part long, body binary, customers long, tables long, spelled double"
MAIL_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("part", pa.int64()), ("body", pa.binary()), ("customers", pa.int64()), ("tables", pa.int64()), ("spelled", pa.float64())])
#: the second of two numbers in one long
LOW = (1 << NUMBER_BITS) - 1


def packed(*arrays) -> bytes:
    """Arrays as one value, whole numbers in as few bytes as hold them."""
    slim = [x.astype(np.min_scalar_type(int(x.max()))) if isinstance(x, np.ndarray) and x.dtype.kind == "i" and len(x) and x.min() >= 0 else x for x in arrays]
    return zstandard.compress(pickle.dumps(slim, 5), 1)


def unpacked(body: bytes) -> list:
    return pickle.loads(zstandard.decompress(body))


def mail(kind: int, block: int, part: int, body: bytes | None, customers: int = 0, tables: int = 0, spelled: float = 0.0) -> tuple:
    return kind, block, part, body, customers, tables, spelled


def letter(rows: list[tuple], schema: pa.Schema = MAIL_SCHEMA) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def hashed(words: list[bytes], seed: int) -> np.ndarray:
    """63 bits of every word."""
    if not words:
        return np.zeros(0, np.int64)
    return (pd.util.hash_array(np.array(words, object), hash_key=f"{seed:016d}", categorize=False) >> np.uint64(1)).astype(np.int64)


def joined(words: list[bytes]) -> tuple[np.ndarray, bytes]:
    return np.array([len(w) for w in words], np.int64), b"".join(words)


def parted(lengths: np.ndarray, text: bytes) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64)
    return [text[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]


def dealt(words: list[bytes], texts: list[np.ndarray], learned: np.ndarray, blocks: int, seed: int) -> Iterator[tuple[int, bytes]]:
    """Blocks with words, contexts, pairs and in which texts these occur; ``texts`` (numbers of words) is emptied.

    learned: how often the tokens of a text count in training.
    """
    h = hashed(words, seed)
    block = h % blocks
    by_block, by_hash = np.lexsort((h, block)), np.argsort(h)
    rank, context_rank = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
    rank[by_block], context_rank[by_hash] = np.arange(len(h)) << NUMBER_BITS, np.arange(len(h))
    contexts = h[by_hash]
    sizes = [len(ids) - 1 for ids in texts]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    keys, done = np.empty(len(owner), np.int64), 0
    for ids, size in zip(texts, sizes, strict=True):
        np.bitwise_or(rank[ids[1:]], context_rank[ids[:-1]], out=keys[done:done + size])
        done += size
    texts.clear()
    at = np.argsort(keys, kind="stable")
    keys, owner = keys[at], owner[at]
    del at
    # the same pair in the same text
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    new = np.nonzero(new)[0]
    times, keys, owner = np.diff(new, append=len(keys)).astype(np.int32), keys[new], owner[new]
    del new
    first = np.nonzero(np.diff(keys, prepend=-1))[0]
    c, keys, ends = np.add.reduceat(times * learned[owner], first), keys[first], np.append(first, len(keys))
    edges = np.searchsorted(block[by_block], np.arange(blocks + 1))
    cuts = np.searchsorted(keys >> NUMBER_BITS, edges)
    for b in range(blocks):
        (w0, w1), (p0, p1) = edges[b:b + 2].tolist(), cuts[b:b + 2].tolist()
        if p0 < p1:
            used, of = np.unique(keys[p0:p1] & LOW, return_inverse=True)
            per_word = np.bincount((keys[p0:p1] >> NUMBER_BITS) - w0, minlength=w1 - w0)
            q0, q1 = ends[p0], ends[p1]
            yield b, packed(
                *joined([words[i] for i in by_block[w0:w1]]), per_word, np.diff(contexts[used], prepend=0), of, c[p0:p1],
                np.diff(ends[p0:p1 + 1]), owner[q0:q1].astype(np.int64), times[q0:q1],
            )


COUNTS = ("tokens", "types", "once", "twice", "contexts_once", "contexts_twice", "pairs", "clashes")
#: a block has a row with its body and where its pairs are by number (in places), one for each part of its places, and some documents' own rows
STORED = "block long, body binary, places binary, tokens long, types long, once long, twice long, contexts_once long, contexts_twice long, pairs long, clashes long, chunk long, row long, held_out boolean, n_tokens long"


def numbered(known: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values with those of ``more`` that are new behind them; the place of each of ``more`` among them; where in ``more`` the new ones are."""
    unique, first, back = np.unique(np.concatenate([known, more]), return_index=True, return_inverse=True)
    new = first >= len(known)
    number = first.copy()
    number[new] = len(known) + np.arange(new.sum())
    return np.concatenate([known, unique[new]]), number[back[len(known):]], first[new] - len(known)


class Merging:
    """One block of what the tasks have dealt, taken chunk by chunk: words, contexts and pairs are numbered as they come."""

    def __init__(self, seed: int):
        self.seed, self.clashes = seed, 0
        self.words: list[bytes] = []
        self.hashes = self.contexts = self.keys = self.c = np.zeros(0, np.int64)
        self.waiting: list[tuple[int, list]] = []
        self.size = 0

    def add(self, chunk: int, body: bytes) -> bool:
        """Whether there are now enough places for a part; they wait at least as long as the pairs have doubled."""
        self.waiting.append((chunk, unpacked(body)))
        self.size += len(self.waiting[-1][1][-1])
        return self.size >= max(PLACES, len(self.keys))

    def places(self) -> bytes:
        """Where the pairs of the chunks that waited occur, in the order of the numbers the pairs have so far."""
        self.waiting.sort(key=lambda x: x[0])
        chunks = [chunk for chunk, _ in self.waiting]
        words, per_word, contexts, of, c, places, owner, times = ([] for _ in range(8))
        for _, (lengths, text, *rest) in self.waiting:
            words.extend(parted(lengths.astype(np.int64), text))
            rest[1] = np.cumsum(rest[1], dtype=np.int64)
            for into, x in zip((per_word, contexts, of, c, places, owner, times), rest, strict=True):
                into.append(x.astype(np.int64))
        self.waiting, self.size = [], 0
        self.hashes, word_of, new = numbered(self.hashes, hashed(words, self.seed))
        self.words.extend(words[i] for i in new.tolist())
        self.clashes += sum(self.words[a] != w for a, w in zip(word_of.tolist(), words, strict=True))
        shift = np.cumsum([0, *(len(x) for x in contexts[:-1])])
        self.contexts, context_of, _ = numbered(self.contexts, np.concatenate(contexts))
        of = context_of[np.concatenate([x + k for x, k in zip(of, shift, strict=True)])]
        self.keys, pair_of, _ = numbered(self.keys, np.repeat(word_of, np.concatenate(per_word)) << 32 | of)
        # sums of whole numbers, exact in doubles below 2 ** 53
        total = np.bincount(pair_of, np.concatenate(c), minlength=len(self.keys)).astype(np.int64)
        total[:len(self.c)] += self.c
        self.c, places = total, np.concatenate(places)
        by_pair = np.argsort(np.repeat(pair_of, places), kind="stable")
        texts, owner = np.unique(np.concatenate([x | k << 32 for k, x in enumerate(owner)]), return_inverse=True)
        each = np.bincount(pair_of, places, minlength=len(self.keys)).astype(np.int64)
        return packed(each, chunks, texts >> 32, texts & 0xFFFFFFFF, owner[by_pair], np.concatenate(times)[by_pair])

    def done(self) -> tuple[bytes, bytes, tuple[int, ...]]:
        """The block by word, its pairs' places in it by their numbers (None: they are in order), and its counts in STORED."""
        ranks = []
        for x in (self.hashes, self.contexts):
            ranks.append(np.empty(len(x), np.int64))
            ranks[-1][np.argsort(x)] = np.arange(len(x))
        keys = ranks[0][self.keys >> 32] << 32 | ranks[1][self.keys & 0xFFFFFFFF]
        order = np.argsort(keys)
        keys, c, words = keys[order], self.c[order], [self.words[i] for i in np.argsort(self.hashes).tolist()]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        word, mine = keys >> 32, c > 0
        in_training = np.bincount(word, mine, minlength=len(words)).astype(np.int64)
        body = packed(*joined(words), np.bincount(word, minlength=len(words)), np.diff(np.sort(self.contexts), prepend=0), keys & 0xFFFFFFFF, c)
        counts = (c.sum(), (in_training > 0).sum(), (c == 1).sum(), (c == 2).sum(), (in_training == 1).sum(), (in_training == 2).sum(), mine.sum(), self.clashes)
        return body, packed(None if (order[1:] > order[:-1]).all() else place), tuple(map(int, counts))


def merged(block: int, chunks: list[int], bodies: list[bytes], seed: int) -> tuple:
    """One block of what the tasks have dealt, in one part: its row of STORED, up to the columns of the documents."""
    whole = Merging(seed)
    for chunk, body in zip(chunks, bodies, strict=True):
        whole.add(chunk, body)
    places = whole.places()
    body, _, counts = whole.done()
    return block, body, places, *counts


class Block:
    """The pairs of a block: word, context (in ``hashes``) and training count of each, and the words in training."""

    def __init__(self, body: bytes):
        lengths, text, per_word, hashes, context, c = unpacked(body)
        self.words = parted(lengths.astype(np.int64), text)
        self.word = np.repeat(np.arange(len(per_word)), per_word)
        self.hashes, self.context, self.c = np.cumsum(hashes, dtype=np.int64), context.astype(np.int64), c.astype(np.int64)
        self.word_c = np.bincount(self.word, self.c, minlength=len(self.words)).astype(np.int64)
        self.number = np.cumsum(self.word_c > 0) - 1  # of a word in training

    def by_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, values, minlength=len(self.hashes)).astype(np.int64)


def offers(block: int, sweep: int, parts: int, hashes: np.ndarray, values: list[np.ndarray], wanted: np.ndarray | None = None) -> Iterator[tuple]:
    """Rows with what a block adds to contexts and which contexts it asks for (none given: the same), by ranges of the hash."""
    edges = [(k << 63) // parts for k in range(1, parts)]
    cuts = [0, *np.searchsorted(hashes, edges).tolist(), len(hashes)]
    asks = cuts if wanted is None else [0, *np.searchsorted(wanted, edges).tolist(), len(wanted)]
    for k in range(parts):
        a, b = cuts[k:k + 2]
        own = None if wanted is None else np.diff(wanted[asks[k]:asks[k + 1]], prepend=0)
        if a < b or own is not None and len(own):
            yield mail(OFFER, block, k, packed(np.diff(hashes[a:b], prepend=0), [v[a:b].astype(np.int32) if v.max(initial=0) < 1 << 31 else v[a:b] for v in values], own), customers=sweep)


def answers(rows: DataFrame, width: int, place: dict[int, tuple[tuple[int, ...], ...]]) -> DataFrame:
    """The sums by context for the blocks of the first sweep in ``place``, which has the columns each value is added to."""
    to = next(iter(place))

    def answer(table):
        hashes, asked, sums = [], [], []
        for block, part, body, sweep in zip(*(table.column(n).to_pylist() for n in ("block", "part", "body", "customers")), strict=True):
            at, values, wanted = unpacked(body)
            at = np.cumsum(at, dtype=np.int64)
            own = np.zeros((width, len(at)), np.int64)
            for v, columns in zip(values, place[sweep], strict=True):
                for k in columns:
                    own[k] = v
            hashes.append(at)
            sums.append(own)
            if sweep == to:
                asked.append((block, part, at if wanted is None else np.cumsum(wanted, dtype=np.int64)))
        unique, back = np.unique(np.concatenate(hashes), return_inverse=True)
        total = [np.bincount(back, x).astype(np.int64) for x in np.concatenate(sums, axis=1)]
        rows = []
        for block, part, wanted in asked:
            at = np.searchsorted(unique, wanted)
            rows.append(mail(ANSWER, block, part, packed(*(x[at] for x in total))))
        return letter(rows)

    return rows.filter((F.col("kind") == OFFER) & F.col("customers").isin(list(place))).groupBy("part").applyInArrow(answer, MAIL)


def told(table: pa.Table, width: int) -> list[np.ndarray]:
    """The sums by context that a block was answered, in the order it asked."""
    rows = sorted((part, body) for kind, part, body in zip(*(table.column(n).to_pylist() for n in ("kind", "part", "body")), strict=True) if kind == ANSWER)
    parts = [unpacked(body) for _, body in rows]
    return [np.concatenate([p[k].astype(np.int64) for p in parts]) if parts else np.zeros(0, np.int64) for k in range(width)]



class Letters:
    """Spelling restaurants: those of more than ``TOP`` bytes are a table, the others are numpy on the driver.

    A row of the table is a dish of ``ORDER`` bytes with its probability as ``x + y * p``, where p is that of its
    ancestor of ``TOP`` bytes; or a dish of ``ORDER - 1`` bytes, for its tables. All restaurants that share
    their last two bytes are in one partition. For every block that sent dishes there is a row of level ``TOLD``
    with their x and y.
    """

    FIELDS = "level long, key long, customers long, tables long, x double, y double, block long, body binary"
    NAMES = ("level", "key", "customers", "tables", "x", "y", "block", "body")

    def __init__(self):
        self.state: DataFrame | None = None
        self.top: list[Level] | None = None

    def probabilities(self) -> list[np.ndarray]:
        """Of the dishes of each length on the driver, given all shorter ones."""
        p = self.top[0].predictive(self.top[0].keys, np.full(len(self.top[0].keys), 1 / SYMBOLS))
        back = np.searchsorted(self.top[0].keys, shortened(self.top[1].keys, 0))
        return [p, self.top[1].predictive(self.top[1].keys, p[back])]

    @staticmethod
    def rows(level: int, keys: np.ndarray, customers, tables=None, x=None, y=None, block: int = -1) -> pa.RecordBatch:
        n, none = len(keys), np.zeros(len(keys))
        columns = (np.full(n, level), keys, customers, none.astype(np.int64) if tables is None else tables, none if x is None else x, none if y is None else y)
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.full(n, block)), pa.nulls(n, pa.binary())], names=Letters.NAMES)

    def sweep(self, words: DataFrame, number: int) -> None:
        """Seat all restaurants, with the tables of the words (word, tables) as customers."""

        def spell(batches):
            for part in row_slices(batches, 1 << 14):
                keys, owner = grams(part.column(0).to_pylist(), ORDER)
                unique, back = np.unique(keys, return_inverse=True)
                yield Letters.rows(0, unique, np.bincount(back, part.column(1).to_numpy()[owner]).astype(np.int64))

        self.seat(words.select("word", "tables").mapInArrow(spell, Letters.FIELDS), number)

    def sweep_blocks(self, mail: DataFrame, number: int) -> None:
        """The same with the dishes that the blocks have summed up."""

        def dishes(batches):
            for part in row_slices(batches, 1):
                for block, body in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    keys, customers = unpacked(body)
                    yield Letters.rows(0, np.cumsum(keys, dtype=np.int64), customers.astype(np.int64), block=block)

        self.seat(mail.filter(F.col("kind") == DISHES).select("block", "body").mapInArrow(dishes, Letters.FIELDS), number)

    def seat(self, rows: DataFrame, number: int) -> None:
        old = self.state
        if old is not None:
            rows = rows.unionByName(old.filter(F.col("level") > TOP))
        middle = F.shiftright("key", BITS).bitwiseAND((1 << (2 * BITS)) - 1)
        top = None if self.top is None else (self.top[1].keys, self.probabilities()[1])

        def seat(batches):
            parts = [[b.column(i).to_numpy() for i in (0, 1, 2, 3, 6)] for b in batches if b.num_rows]
            if not parts:
                return
            level, key, n, tables, block = (np.concatenate(c) for c in zip(*parts, strict=True))
            keys, at = np.unique(key[level == 0], return_inverse=True)
            deep = Level(keys, np.bincount(at, n[level == 0]).astype(np.int64), DISCOUNTS[ORDER])
            parents, up = np.unique(shortened(keys, ORDER - 1), return_inverse=True)
            above = Level(parents, np.bincount(up, deep.tables).astype(np.int64), DISCOUNTS[ORDER - 1])
            for one, which in ((deep, ORDER), (above, ORDER - 1)):
                old = level == which
                if old.any():
                    place = np.searchsorted(one.keys, key[old])
                    one.tables[place] = tables[old]
                    if which < ORDER:
                        one.customers[place] = n[old]
                    one.sums()
            if top is None:
                base = np.full(len(parents), 1 / SYMBOLS)
            else:
                base = top[1][np.searchsorted(top[0], shortened(parents, TOP))]
            draw = np.random.default_rng([number, int(keys[0])])
            p = above.predictive(parents, base)[up]
            deep.tables = seated(deep.customers, p, STRENGTH + deep.discount * deep.all_tables[deep.context_of], deep.discount, draw)
            strength = STRENGTH + above.discount * above.all_tables[above.context_of]
            above.customers = np.bincount(up, deep.tables, minlength=len(parents)).astype(np.int64)
            above.tables = seated(above.customers, base, strength, above.discount, draw)
            terms = []
            for one in (deep, above):
                one.sums()
                whole = (STRENGTH + one.all_customers)[one.context_of]
                terms.append(((one.customers - one.discount * one.tables) / whole, (STRENGTH + one.discount * one.all_tables[one.context_of]) / whole))
            (x, y), (x_, y_) = terms
            firsts, to = np.unique(shortened(parents, TOP), return_inverse=True)
            new = np.bincount(to, above.tables).astype(np.int64)
            x, y = x + y * x_[up], y * y_[up]
            yield Letters.rows(ORDER, deep.keys, deep.customers, deep.tables, x, y)
            yield Letters.rows(ORDER - 1, above.keys, above.customers, above.tables, x_, y_)
            yield Letters.rows(TOP, firsts, new, new)
            by_block = np.lexsort((at, block[level == 0]))
            owners, starts = np.unique(block[level == 0][by_block], return_index=True)
            for b, dishes in zip(owners.tolist(), np.split(by_block, starts[1:]), strict=True):
                if b >= 0:
                    own = at[dishes]
                    body = packed(np.diff(keys[own], prepend=0), x[own], y[own])
                    yield pa.RecordBatch.from_arrays([pa.array([TOLD]), *(pa.array([0]) for _ in range(3)), pa.array([0.0]), pa.array([0.0]), pa.array([b]), pa.array([body], pa.binary())], names=Letters.NAMES)

        self.state = stage(rows.repartition(middle).mapInArrow(seat, Letters.FIELDS), "spelling")
        discard(old)
        # 257 * 257 rows at most
        first = self.state.filter(F.col("level") == TOP).groupBy("key").agg(F.sum("customers").alias("n")).orderBy("key").collect()
        keys, n = np.array([r["key"] for r in first], np.int64), np.array([r["n"] for r in first], np.int64)
        roots, up = np.unique(shortened(keys, 0), return_inverse=True)
        one = Level(keys, n, DISCOUNTS[1])
        root = Level(roots, np.bincount(up, one.tables, minlength=len(roots)).astype(np.int64), DISCOUNTS[0])
        if self.top is not None:
            root, one.tables = self.top[0], self.top[1].tables
            one.sums()
        draw = np.random.default_rng([number])
        uniform = np.full(len(roots), 1 / SYMBOLS)
        p = root.predictive(roots, uniform)[up]
        one.tables = seated(n, p, STRENGTH + one.discount * one.all_tables[one.context_of], one.discount, draw)
        strength = STRENGTH + root.discount * root.all_tables[root.context_of]
        root.customers = np.bincount(up, one.tables, minlength=len(roots)).astype(np.int64)
        root.tables = seated(root.customers, uniform, strength, root.discount, draw)
        one.sums()
        root.sums()
        self.top = [root, one]

    def symbols(self) -> DataFrame:
        """key and log_p: the natural logarithm of the probability of each dish of ``ORDER`` bytes."""
        top = self.top[1].keys, self.probabilities()[1]

        def answer(batches):
            for part in batches:
                keys, x, y = (c.to_numpy() for c in part.columns)
                p = x + y * top[1][np.searchsorted(top[0], shortened(keys, TOP))] if len(keys) else x
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.log(p))], names=["key", "log_p"])

        return self.state.filter(F.col("level") == ORDER).select("key", "x", "y").mapInArrow(answer, "key long, log_p double")


def discount_of(once: int | None, twice: int | None) -> float:
    once, twice = once or 0, twice or 0
    return min(0.95, max(0.05, once / max(1, once + 2 * twice)))


def stored(rows: DataFrame, gather: Callable, kind: str, blocks: int) -> tuple[str, dict]:
    """The blocks of what ``gather`` deals out, as a table bucketed by block, and the sums of their counts."""
    spark = rows.sparkSession
    fields = f"block long, chunk long, body binary, row long, doc_id {kind}, held_out boolean, n_tokens long"
    own_schema = [(n, {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[t]) for n, t in (f.split(" ") for f in STORED.split(", "))]

    def merging(seed):
        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = schema = block = None

            def rows(n: int, **columns) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

            def row(**values) -> pa.RecordBatch:
                return rows(1, **{n: pa.array([x], schema.field(n).type) for n, x in values.items()})

            for part in row_slices(batches):
                schema = schema or pa.schema([*own_schema, ("doc_id", part.schema.field("doc_id").type)])
                body = part.column("body")
                docs = part.filter(pa.compute.is_null(body))
                if docs.num_rows:
                    yield rows(docs.num_rows, **{f: docs.column(f) for f in ("block", "chunk", "row", "doc_id", "held_out", "n_tokens")})
                for i in np.nonzero(body.is_valid().to_numpy(zero_copy_only=False))[0].tolist():
                    if whole is None:
                        whole, block = Merging(seed), part.column("block")[i].as_py()
                    if whole.add(part.column("chunk")[i].as_py(), body[i].as_py()):
                        yield row(block=block, places=whole.places())
            if whole is not None:
                if whole.waiting:
                    yield row(block=block, places=whole.places())
                body, numbers, counts = whole.done()
                yield row(block=block, body=body, places=numbers, **dict(zip(COUNTS, counts, strict=True)))

        return merge

    for seed in count():
        dealt_out = rows.mapInArrow(gather(blocks, seed), fields)
        name = f"pitman_yor_{uuid.uuid4().hex}"
        whole = dealt_out.groupBy("block").applyInArrow(merging(seed), f"{STORED}, doc_id {kind}")
        whole.write.format("parquet").bucketBy(blocks, "block").option("path", shared_folder(spark, name)).saveAsTable(name)
        table = spark.table(name)
        sums = table.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in COUNTS]).first().asDict()
        if not sums["clashes"]:
            return name, sums
        dropped(spark, name)


def dropped(spark: SparkSession, name: str) -> None:
    """Remove a stored table and its files."""
    files = spark.table(name)
    discard(files)
    spark.sql(f"DROP TABLE {name}")


def word_predictive(c, t, spelled, discount: float, customers: int, tables: int):
    return (c - discount * t + (WORD_STRENGTH + discount * tables) * spelled) / (WORD_STRENGTH + customers)


def sums_of(name: str, about: dict, spark: SparkSession, blocks: int) -> tuple[DataFrame, list[DataFrame]]:
    """(chunk, body): known tokens, base and score of the texts of a chunk, as far as one block has them; and what it reads and is to be discarded after."""
    pair_discount, word_discount = discount_of(about["once"], about["twice"]), discount_of(about["contexts_once"], about["contexts_twice"])
    tokens, types = about["tokens"], about["types"]
    table = spark.table(name).filter("body IS NOT NULL")

    def places_of(places: bytes, values: tuple[np.ndarray, ...] | None) -> Iterator[tuple]:
        """The sums of values of the pairs, by their numbers; none given: zeros."""
        each, chunks, chunk, text, owner, times = unpacked(places)
        pair = np.repeat(np.arange(len(each)), each)
        sums = [np.bincount(owner, times * x[pair], minlength=len(text)) for x in values] if values else [np.zeros(len(text))] * 3
        starts = np.searchsorted(chunk, np.arange(len(chunks) + 1)).tolist()
        for k, own in enumerate(chunks):
            a, b = starts[k:k + 2]
            yield own, packed(text[a:b], sums[0][a:b].astype(np.int64), sums[1][a:b], sums[2][a:b])

    if not tokens:

        def nothing(batches):
            for part in row_slices(batches, 1):
                for own, body in places_of(part.column(0)[0].as_py(), None):
                    yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([body], pa.binary())], names=["chunk", "body"])

        return spark.table(name).filter("body IS NULL AND places IS NOT NULL").select("places").mapInArrow(nothing, "chunk long, body binary"), []

    def dishes(words: list[bytes], tables: np.ndarray) -> bytes:
        keys, owner = grams(words, ORDER)
        unique, back = np.unique(keys, return_inverse=True)
        return packed(np.diff(unique, prepend=0), np.bincount(back, tables[owner]).astype(np.int64))

    def begin(batches):
        # at first every dish has one table
        for part in row_slices(batches, 1):
            number, body = part.column(0)[0].as_py(), part.column(1)[0].as_py()
            block = Block(body)
            words = [w for w, c in zip(block.words, block.word_c.tolist(), strict=True) if c]
            if not words:
                continue
            again, once = block.c > 1, block.c == 1
            contexts, context = np.unique(block.context[again], return_inverse=True)
            singles = np.bincount(block.number[block.word[once]], minlength=len(words)).astype(np.int64)
            word, one = block.number[block.word[again]], np.ones(len(words), np.int64)
            state = packed(*joined(words), singles, word, context, block.c[again], np.diff(block.hashes[contexts], prepend=0), None, singles + np.bincount(word, minlength=len(words)), one)
            rows = [
                mail(STATE, number, 0, state), mail(DISHES, number, 0, dishes(words, one)),
                *offers(number, 0, blocks, block.hashes, [block.by_context(once), block.by_context(again)], block.hashes[contexts]),
            ]
            yield from letter(rows).to_batches()

    def sweep_of(sweep: int, all_customers: int, all_tables: int, top: tuple[np.ndarray, np.ndarray]) -> Callable:
        def seat(left, right):
            if not left.num_rows:
                return letter([])
            number = left.column("block")[0].as_py()
            lengths, text, singles, word, context, c, hashes, context_singles, customers, tables = unpacked(left.column("body")[0].as_py())
            words, singles, word, context, c, customers = parted(lengths.astype(np.int64), text), *(x.astype(np.int64) for x in (singles, word, context, c, customers))
            hashes = np.cumsum(hashes, dtype=np.int64)
            if context_singles is None:
                context_singles, again = told(right, 2)
            else:
                again = told(right, 1)[0]
            spelling = [unpacked(body) for kind, body in zip(right.column("kind").to_pylist(), right.column("body").to_pylist(), strict=True) if kind == TOLD]
            keys = np.concatenate([np.cumsum(k, dtype=np.int64) for k, _, _ in spelling])
            x, y = (np.concatenate([s[k] for s in spelling]) for k in (1, 2))
            log_p = np.log(x + y * top[1][np.searchsorted(top[0], shortened(keys, TOP))])
            by_key = np.argsort(keys)
            own, owner = grams(words, ORDER)
            spelled = np.exp(np.bincount(owner, log_p[by_key[np.searchsorted(keys, own, sorter=by_key)]], minlength=len(words)))

            draw = np.random.default_rng([sweep, number])
            p = word_predictive(customers, tables.astype(np.int64), spelled, word_discount, all_customers, all_tables)
            old = context_singles.astype(np.int64) + again
            own_tables = seated(c, p[word], WORD_STRENGTH + pair_discount * old[context], pair_discount, draw)
            customers = singles + np.bincount(word, own_tables, minlength=len(words)).astype(np.int64)
            tables = seated(customers, spelled, np.full(len(words), WORD_STRENGTH + word_discount * all_tables), word_discount, draw)
            served = np.bincount(context, own_tables, minlength=len(hashes)).astype(np.int64)
            rows = [
                mail(SUMS, number, 0, None, int(customers.sum()), int(tables.sum()), float(spelled.sum())),
                *offers(number, sweep, blocks, hashes, [served]),
            ]
            if sweep > BURN:
                rows.append(mail(SAMPLE, number, sweep, packed(own_tables, customers, tables, spelled)))
            if sweep < BURN + SAMPLES:
                rows.append(mail(STATE, number, 0, packed(lengths, text, singles, word, context, c, np.diff(hashes, prepend=0), context_singles, customers, tables)))
                rows.append(mail(DISHES, number, 0, dishes(words, tables)))
            return letter(rows)

        return seat

    last = stage(table.select("block", "body").mapInArrow(begin, MAIL), "seats")
    spelling = Letters()
    spelling.sweep_blocks(last, 0)
    all_customers, all_tables = about["pairs"], types
    samples, anew, inside = [], [], []
    for sweep in range(1, BURN + SAMPLES + 1):
        sums = answers(last, 2, {0: ((0,), (1,))}) if sweep == 1 else answers(last, 1, {sweep - 1: ((0,),)})
        spelled = spelling.state.filter(F.col("level") == TOLD).select(F.lit(TOLD).alias("kind"), "block", F.lit(0).cast("long").alias("part"), "body")
        seat = sweep_of(sweep, all_customers, all_tables, (spelling.top[1].keys, spelling.probabilities()[1]))
        states = last.filter(F.col("kind") == STATE).select("block", "body")
        told_of = sums.select("kind", "block", "part", "body").unionByName(spelled)
        now = stage(states.groupBy("block").cogroup(told_of.groupBy("block")).applyInArrow(seat, MAIL), "seats")
        if sweep == 1 or sweep - 1 <= BURN:
            discard(last)
        last = now
        got = now.filter(F.col("kind") == SUMS).agg(F.sum("customers").alias("c"), F.sum("tables").alias("t"), F.sum("spelled").alias("s")).first()
        all_customers, all_tables = got["c"], got["t"]
        if sweep > BURN:
            samples.append(now)
            anew.append((all_customers, all_tables))
            inside.append(got["s"])
        if sweep < BURN + SAMPLES:
            spelling.sweep_blocks(now, sweep)
    discard(spelling.state)

    # rounding, or a vocabulary that takes all spellings, must not leave nothing
    unknown = [(WORD_STRENGTH + word_discount * t) / (WORD_STRENGTH + c) * max(1 - s, 1e-9) for (c, t), s in zip(anew, inside, strict=True)]

    def totals(batches):
        for part in row_slices(batches, 1):
            number, body = part.column(0)[0].as_py(), part.column(1)[0].as_py()
            block = Block(body)
            # a pair with one customer has one table; the tables of the others come from the samples
            yield from letter([*offers(number, 0, blocks, block.hashes, [block.by_context(block.c), block.by_context(block.c == 1)])]).to_batches()

    def finish(left, right):
        rows, schema = [], pa.schema([("chunk", pa.int64()), ("body", pa.binary())])
        bodies, places = left.column("body"), left.column("places")
        parts = [i for i in range(left.num_rows) if not bodies[i].is_valid]
        for i in sorted({*range(left.num_rows)} - {*parts}):
            block, (numbers,) = Block(bodies[i].as_py()), unpacked(places[i].as_py())
            all_c, *all_t = told(right, 1 + SAMPLES)
            trained = block.word_c > 0
            again = block.c > 1
            taken = {part: body for kind, part, body in zip(*(right.column(n).to_pylist() for n in ("kind", "part", "body")), strict=True) if kind == SAMPLE}
            total = np.zeros(len(block.c))
            for k in range(SAMPLES):
                p, tables = np.full(len(block.words), unknown[k]), np.minimum(block.c, 1)
                if trained.any():
                    own_tables, customers, word_tables, spelled = unpacked(taken[BURN + 1 + k])
                    p[trained] = word_predictive(customers.astype(np.int64), word_tables.astype(np.int64), spelled, word_discount, *anew[k])
                    tables[again] = own_tables
                back = WORD_STRENGTH + pair_discount * all_t[k][block.context]
                total += (block.c - pair_discount * tables + back * p[block.word]) / (WORD_STRENGTH + all_c[block.context])
            base = np.log10((block.word_c + 1.0) / (tokens + types + 1.0))[block.word]
            values = trained[block.word].astype(float), base, np.log10(total / SAMPLES)
            if numbers is not None:
                values = tuple(x[numbers] for x in values)
            for k in parts:
                rows.extend(places_of(places[k].as_py(), values))
        return letter(rows, schema)

    sampled = samples[0]
    for more in samples[1:]:
        sampled = sampled.unionByName(more)
    place = {0: ((0,), tuple(range(1, SAMPLES + 1)))} | {BURN + 1 + i: ((1 + i,),) for i in range(SAMPLES)}
    asked = table.select("block", "body").mapInArrow(totals, MAIL).unionByName(sampled)
    told_of = answers(asked, 1 + SAMPLES, place).unionByName(sampled.filter(F.col("kind") == SAMPLE)).select("kind", "block", "part", "body")
    whole = spark.table(name).filter("places IS NOT NULL").select("block", "body", "places")
    return whole.groupBy("block").cogroup(told_of.groupBy("block")).applyInArrow(finish, "chunk long, body binary"), samples


def by_text(rows: DataFrame, gather: Callable, kind: str) -> tuple[DataFrame, int]:
    """doc_id, held_out, n_tokens, n_known, base_score and score of every text dealt out, and the tokens in training."""
    spark = rows.sparkSession
    # many small files need no more blocks: what blocks and contexts tell each other grows with the square of their number
    blocks = min(100_000, max(8, min(2 * rows.rdd.getNumPartitions(), -(-estimated_bytes(rows) // BLOCK_BYTES))))
    name, about = stored(rows, gather, kind, blocks)
    release(spark)
    sums, samples = sums_of(name, about, spark, blocks)
    docs = spark.table(name).filter("row IS NOT NULL").select("chunk", "row", "doc_id", "held_out", "n_tokens", F.lit(None).cast("binary").alias("body"))

    def add(table):
        own = pa.compute.is_valid(table.column("row"))
        docs, bodies = table.filter(own), table.select(["body"]).filter(pa.compute.invert(own)).column("body")
        row = docs.column("row").to_numpy()
        totals = [np.zeros(row.max(initial=-1) + 1, t) for t in (np.int64, float, float)]
        for body in bodies:
            at, *parts = unpacked(body.as_py())
            for total, part in zip(totals, parts, strict=True):
                total[at] += part.astype(total.dtype)  # a text comes once in a block
        return pa.table([*(docs.column(n) for n in ("doc_id", "held_out", "n_tokens")), *(pa.array(x[row]) for x in totals)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    every = docs.unionByName(sums, allowMissingColumns=True)
    fields = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    # the sums by block and text are far more than the texts: they are shuffled to their texts, and only these are stored
    found = stage(every.groupBy("chunk").applyInArrow(add, fields), "texts")
    for sample in samples:
        discard(sample)
    dropped(spark, name)
    return found, about["tokens"]


def home(chunk: int, blocks: int) -> int:
    """The block that the documents' own rows of a chunk lie beside; the numbers of tasks are the high bits of a chunk's."""
    return ((chunk >> 20) + (chunk & 0xFFFFF) * 7919) % blocks


def rows_out(block: int, chunk: int, body: bytes | None, rows: np.ndarray | None, doc_ids, held_out, n_tokens, kind: pa.DataType) -> pa.RecordBatch:
    n = 1 if rows is None else len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block)), pa.array(np.full(n, chunk)), pa.array([body] * n, pa.binary()), pa.nulls(n, pa.int64()) if rows is None else pa.array(rows),
            pa.nulls(n, kind) if rows is None else doc_ids, pa.nulls(n, pa.bool_()) if rows is None else held_out, pa.nulls(n, pa.int64()) if rows is None else pa.array(n_tokens),
        ],
        names=["block", "chunk", "body", "row", "doc_id", "held_out", "n_tokens"],
    )


def model_of(counted: DataFrame) -> DataFrame:
    """context, word, n, known (0 or 1), base and model (logarithms to base 10) of every pair of (context, word, c, n), c of them in training."""
    counted = stage(counted.select("context", "word", "c", "n", F.monotonically_increasing_id().alias("id")), "pairs")

    def gather(blocks, seed):
        def pairs(batches):
            task = TaskContext.get().partitionId()
            for k, part in enumerate(row_slices(batches, 1 << 14)):
                tokens = Tokens()
                sides = [np.fromiter((tokens.numbers[bytes(w)] for w in part.column(i).to_pylist()), np.int32, part.num_rows) for i in (0, 1)]
                chunk, rows = task << 20 | k, np.arange(part.num_rows)
                for b, body in dealt(list(tokens.numbers), list(np.stack(sides, axis=1)), part.column(2).to_numpy(), blocks, seed):
                    yield rows_out(b, chunk, body, None, None, None, None, pa.int64())
                yield rows_out(home(chunk, blocks), chunk, None, rows, part.column(3), pa.array([False] * len(rows)), np.ones(len(rows), np.int64), pa.int64())

        return pairs

    scored, _ = by_text(counted.select("context", "word", "c", "id"), gather, "bigint")
    found = scored.select(F.col("doc_id").alias("id"), F.col("n_known").alias("known"), F.col("base_score").alias("base"), F.col("score").alias("model"))
    return counted.join(found, "id").select("context", "word", "n", "known", "base", "model")


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def gather(blocks, seed):
        def deal(batches):
            task = TaskContext.get().partitionId()
            tokens, found, learns, slices, chunk = Tokens(), [], [], [], task << 20

            def flush():
                sizes = np.array([len(x) - 1 for x in found], np.int64)
                for b, body in dealt(list(tokens.numbers), found, np.array(learns, np.int32), blocks, seed):
                    yield rows_out(b, chunk, body, None, None, None, None, slices[0].column(0).type)
                at = 0
                for part in slices:
                    rows = np.arange(at, at + part.num_rows)
                    at += part.num_rows
                    yield rows_out(home(chunk, blocks), chunk, None, rows, part.column(0), part.column(2), sizes[rows], part.column(0).type)

            size = 0
            for part in row_slices(batches):
                for text, held in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    found.append(tokens.numbered(text))
                    learns.append(not held)
                    size += len(found[-1]) - 1
                # copies: a column of a batch holds on to the memory of all of it, the texts too
                own = [part.column(k).take(pa.array(range(part.num_rows), pa.int64())) for k in (0, 2)]
                slices.append(pa.RecordBatch.from_arrays([own[0], pa.nulls(part.num_rows), own[1]], names=["doc_id", "text", "held_out"]))
                if size > GATHERED or len(tokens.numbers) > GATHERED // 8:
                    yield from flush()
                    tokens, learns, slices, size, chunk = Tokens(), [], [], 0, chunk + 1
            if slices:
                yield from flush()

        return deal

    scored, train_tokens = by_text(docs, gather, kind)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
