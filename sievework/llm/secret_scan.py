"""Secret scans: character Markov models of random strings and ordinary identifiers.

Rules find the usual forms of credentials. Every other run of identifier characters, of any length, and what a
rule's match leaves of a run, is scored by first-order Markov models: one of ordinary identifiers, and one of random
strings for each alphabet they are drawn from, mixed with equal weights. A run is a secret if the sum of its
log-likelihood ratio is above ``MARGIN``, so that length and unlikeliness decide together.

The models are trained from labelled samples that a seed draws (``labelled``): random strings of each alphabet, and
identifiers, paths, numbers, dates and rules of the usual shapes. The ordinary model is, up to one half, that of the text of all documents
outside of the rules' matches, so that the words of the corpus are ordinary in any language.

A NULL text counts as an empty one and has no span. Repeated rows are scanned each for itself. An empty table gives
none, and as a corpus it leaves the labelled samples. Very long texts are scored in blocks that end between runs. Further columns are not
read, and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_slices

# The rules and the order of the kinds.
KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET)
OUTSIDE = re.compile(r"[^A-Za-z0-9+/_=-]")
#: nats by which a run has to be likelier as a random string
MARGIN = 18.0
#: share of the uniform distribution in the models of random strings and of ordinary identifiers
UNIFORM_RANDOM, UNIFORM_ORDINARY = 0.02, 0.002
#: strings of each kind that the models are trained from
LABELLED, SEED = 4000, 17
#: the corpus weighs less behind a character that it has about so often, or more rarely
RARE = 1000
BLOCK = 1 << 20

# Alphabets of random strings.
UPPER, LOWER, DIGITS = ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62]
RANDOM_ALPHABETS = (
    UPPER + LOWER + DIGITS, UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_", UPPER + DIGITS, LOWER + DIGITS,
    DIGITS + "abcdef", DIGITS + "ABCDEF", LOWER, UPPER, UPPER + LOWER,
)
# Words that identifiers are made of.
PARTS = (
    "user name profile settings config backup file path index page list item order customer account session request response "
    "server client service manager handler factory builder controller model view table column field value key type status state "
    "error warning message event queue worker thread process system network address port host domain image video audio document "
    "report summary article chapter section header footer content template style script module package version release update "
    "create delete insert select read write open close start stop load save send receive parse format convert validate check test "
    "data base store cache memory buffer stream input output source target local remote global public private default custom "
    "first last next previous current total count number size length width height time date year month week day hour minute "
    "api sql xml json yaml csv pdf html css cpu gpu url uri id uid utf sha md rfc http ftp ssh tls dns ip tcp udp app db io ui os "
    "home about contact product category search result blog news how to build garden spring example com org www http https html"
).split()

CLASSES = np.full(256, STATES, np.uint8)
for _i, _c in enumerate(ALPHABET):
    CLASSES[ord(_c)] = _i


def labelled(n: int = LABELLED, seed: int = SEED) -> tuple[list[str], list[list[str]]]:
    """Ordinary identifiers, and random strings of each alphabet."""
    draw = random.Random(seed)

    def number(most: int) -> str:
        return "".join(draw.choice(DIGITS) for _ in range(draw.randint(1, most)))

    def date() -> str:
        return draw.choice(("{:04}-{:02}-{:02}", "{:04}/{:02}/{:02}", "{:04}{:02}{:02}", "{:04}_{:02}_{:02}")).format(
            draw.randint(1950, 2049), draw.randint(1, 12), draw.randint(1, 28)
        )

    def identifier() -> str:
        words = draw.choices(PARTS, k=draw.randint(1, 6))
        if draw.random() < 0.3:
            words.insert(draw.randint(1, len(words)), draw.choice(("v", "", "")) + number(4) + draw.choice(("", "", "", draw.choice(LOWER))))
        shape = draw.randrange(9)
        if shape == 0:
            return "".join(w.capitalize() for w in words)
        if shape == 1:
            return words[0] + "".join(w.capitalize() for w in words[1:])
        if shape == 2:
            return "_".join(words).upper()
        if shape == 3:
            return "/" * draw.randint(0, 2) + "/".join([*words, date()][draw.randint(0, 1):])
        if shape == 4:
            return "/".join(["-".join(words), number(8), "_".join(draw.choices(PARTS, k=2))])
        if shape == 5:
            return draw.choice((date(), number(24), draw.choice("-_=+/") * draw.randint(2, 60), words[0] + "=" + words[-1]))
        return ("_", "-", "")[shape - 6].join(words)

    strings = [["".join(draw.choices(a, k=draw.randint(8, 48))) for _ in range(n)] for a in RANDOM_ALPHABETS]
    return [identifier() for _ in range(4 * n)], strings


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the rules' matches, in code points; a match that fails its length is used up."""
    spans = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(spans)


def classes(text: str) -> np.ndarray:
    """The class of each code point; what is not in the alphabet has class ``STATES``."""
    return CLASSES[np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 255)]


def transitions(codes: np.ndarray) -> np.ndarray:
    """Counts of neighbouring characters of the alphabet, row-major."""
    both = (codes[:-1] < STATES) & (codes[1:] < STATES)
    return np.bincount((codes[:-1].astype(np.int64) * STATES + codes[1:])[both], minlength=STATES * STATES)


def blocks(text: str):
    """(start, part) of a text; a part ends where a run does."""
    at = 0
    while at < len(text):
        end = OUTSIDE.search(text, at + BLOCK)
        end = end.end() if end else len(text)
        yield at, text[at:end]
        at = end


def without(codes: np.ndarray, at: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The classes of a part that starts at this place, with the spans outside of the alphabet."""
    for start, end, _ in spans:
        codes[max(0, start - at):max(0, end - at)] = STATES
    return codes


def chances(counts: np.ndarray, uniform: float) -> np.ndarray:
    counts = counts.reshape(STATES, STATES).astype(float)
    totals = counts.sum(1, keepdims=True)
    seen = np.divide(counts, totals, out=np.full_like(counts, 1 / STATES), where=totals > 0)
    return (1 - uniform) * seen + uniform / STATES


def fit(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratios of character pairs: a row per pair of classes, a column per model of random strings."""

    def count(batches):
        sums = np.zeros(STATES * STATES, np.int64)
        for part in row_slices(batches):
            for one in part.column(0).to_pylist():
                found = base_spans(one or "")
                for at, some in blocks(one or ""):
                    sums += transitions(without(classes(some), at, found))
        pair = np.nonzero(sums)[0]
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(sums[pair])], names=["pair", "n"])

    counted = docs.select(F.col(text).cast("string")).mapInArrow(count, "pair long, n long")
    corpus = np.zeros(STATES * STATES)
    # a row per pair of characters: 67 * 67 at most
    for row in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        corpus[row.pair] = row.n
    identifiers, strings = labelled()
    ordinary = chances(transitions(classes("\n".join(identifiers))), UNIFORM_ORDINARY)
    followed = corpus.reshape(STATES, STATES).sum(1, keepdims=True)
    share = 0.5 * followed / (followed + RARE)
    ordinary = (1 - share) * ordinary + share * chances(corpus, UNIFORM_ORDINARY)
    ratios = np.zeros((STATES + 1, STATES + 1, len(strings)))
    for k, some in enumerate(strings):
        ratios[:-1, :-1, k] = np.log(chances(transitions(classes("\n".join(some))), UNIFORM_RANDOM) / ordinary)
    return ratios.reshape(-1, len(strings))


def spans_of(text: str, ratios: np.ndarray) -> list[tuple[int, int, int]]:
    """All spans of a text: the rules' and those that only the models find."""
    found = base_spans(text)
    more = []
    highest = ratios.max(1)
    for at, part in blocks(text):
        codes = without(classes(part), at, found)
        inside = np.concatenate([[0], codes < STATES, [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        pairs = codes[:-1].astype(np.int32) * (STATES + 1) + codes[1:]
        sums = np.concatenate([[0.0], np.cumsum(highest[pairs])])
        # no model's sum is above that of the highest ratios
        for k in np.flatnonzero(sums[ends - 1] - sums[starts] > MARGIN):
            start, end = int(starts[k]), int(ends[k])
            each = ratios[pairs[start:end - 1]].sum(0)
            if np.logaddexp.reduce(each) - np.log(len(each)) > MARGIN:
                more.append((at + start, at + end, 3))
    return sorted(found + more)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda s: (s[0], s[2])))


def scan(docs: DataFrame, ratios: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, its number of spans of each kind, and the spans (kind, start, end)."""
    kind_of_id = docs.schema[doc_id].dataType.simpleString()

    def look(batches):
        for part in row_slices(batches):
            every = [spans_of(t or "", ratios) for t in part.column(1).to_pylist()]
            counts = [pa.array([sum(k == kind for *_, k in s) for s in every], pa.int64()) for kind in range(4)]
            digests = [
                hashlib.sha256(written([x for x in s if x[2] < 3]).encode()).hexdigest() for s in every
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *counts, pa.array(digests, pa.string()), pa.array([written(s) for s in every], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_model", "base_sha256", "spans"],
            )

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(
        look,
        f"doc_id {kind_of_id}, n_assign long, n_access long, n_hex long, n_model long, base_sha256 string, spans string",
    )


def masked(text: str, spans: list[tuple[int, int, int]], mask: str = "[secret]") -> str:
    """The text with each span, or run of overlapping spans, replaced by the mask."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, ratios: np.ndarray, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with secrets masked and their lengths counted anew; all other columns as they are."""
    names = docs.columns

    def change(batches):
        for part in row_slices(batches):
            columns = dict(zip(names, part.columns, strict=True))
            texts = columns[text].to_pylist()
            spans = [spans_of(t or "", ratios) for t in texts]
            new = [masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            columns[text] = pa.array(new, columns[text].type)
            if n_chars in columns:
                old = columns[n_chars].to_pylist()
                counted = [len(t) if s else n for t, s, n in zip(new, spans, old, strict=True)]
                columns[n_chars] = pa.array(counted, columns[n_chars].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(change, docs.schema)
