"""Periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q (words q apart are the same), of at least
``max(6, 4 q)`` words, that neither neighbour extends with that period. So each of its words stands in it at
least four times, and a word that a segment holds less than four times is in no run of that segment:

1. a text starts as one segment; words too rare in their segment split it, and what is left between them are
   segments of their own, in which other words may now be too rare; repeated until nothing splits any more;
2. what survives is scanned lag by lag. A run with period q has 3 q or more matches ``word[i] == word[i + q]`` in
   a row, so every 3 q-th place is looked at, and a stretch is grown from the matches found there. Places of
   all lags together are about n ln n / 3 of a segment of n words. Matches inside a run already found with a
   period that divides the lag are its own multiples and are passed over.

Splitting only prunes. A round that takes less than a hundredth of the words still in question ends it for the
slice of texts, so that a text made to lose one word a round costs no quadratic time; the scan is exact either way.

Words are cut at the six ASCII blanks (space, tab to carriage return), and compared as they are. A NULL or empty
text, or one of blanks, has no word and no run. Repeated rows each get a row of result; an empty table gives none.
A text is held whole in one task, of any length. Further columns of the input are not read; ``doc_id`` may be NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_slices

REPEATS, LEAST_WORDS = 4, 6
#: words of one slice of texts that are split together
WORDS_AT_ONCE = 1 << 18
RUN = "struct<start: bigint, length: bigint, period: bigint>"

Run = tuple[int, int, int]


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()  # of bytes: the six ASCII blanks only


def segments(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches that no too rare word splits; ``bounds``: where the texts start, and the end."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    starts, ends = bounds[:-1], bounds[1:]
    while True:
        long = ends - starts >= LEAST_WORDS
        starts, ends = starts[long], ends[long]
        if not len(starts):
            break
        lengths = ends - starts
        total = int(lengths.sum())
        segment = np.repeat(np.arange(len(starts)), lengths)
        place = np.arange(total) + np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        _, which, counts = np.unique(segment * (int(words.max()) + 1) + words[place], return_inverse=True, return_counts=True)
        rare = counts[which] < REPEATS
        hit = np.bincount(segment[rare], minlength=len(starts)) > 0
        done.append((starts[~hit], ends[~hit]))
        if not rare.any():
            break
        keep = ~rare & hit[segment]
        place, segment = place[keep], segment[keep]
        new = np.r_[True, (np.diff(place) > 1) | (np.diff(segment) > 0)][: len(place)]
        starts = place[new]
        ends = place[np.r_[new[1:], True][: len(place)]] + 1
        if int(rare.sum()) * 100 < total:
            done.append((starts, ends))
            break
    if not done:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([s for s, _ in done]), np.concatenate([e for _, e in done])


def grown(w: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch [a, b) around ``at`` with w[i] == w[i + lag]."""
    b, step = at, 64
    while b < len(w) - lag:
        end = min(b + step, len(w) - lag)
        same = w[b:end] == w[b + lag : end + lag]
        if not same.all():
            b += int(same.argmin())
            break
        b, step = end, step * 4
    a, step = at, 64
    while a > 0:
        first = max(0, a - step)
        same = w[first:a] == w[first + lag : a + lag]
        if not same.all():
            a -= int(same[::-1].argmin())
            break
        a, step = first, step * 4
    return a, b


def scan(w: np.ndarray) -> list[Run]:
    """All runs of one segment, by start and period. Lags go up, so a run is met first with its smallest period."""
    n, found, of_lag = len(w), [], {}
    for lag in range(1, n // REPEATS + 1):
        step = (REPEATS - 1) * lag
        if (lag & 255) == 1:  # a block of lags at once: few of them have a match at all
            lags = np.arange(lag, min(lag + 256, n // REPEATS + 1))
            counts = (n - lags - 1) // ((REPEATS - 1) * lags) + 1
            which = np.repeat(np.arange(len(lags)), counts)
            at = (np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)) * ((REPEATS - 1) * lags)[which]
            match = w[at] == w[at + lags[which]]
            some = dict.fromkeys(lags[which[match]].tolist())
        if lag not in some:
            continue
        places = np.arange(0, n - lag, step)
        places = places[w[places] == w[places + lag]]
        passed = -1
        for at in places.tolist():
            if at < passed or any(lag % p == 0 and any(a <= at and at + lag < e for a, e in spans) for p, spans in of_lag.items()):
                continue
            a, b = grown(w, at, lag)
            passed = b
            length = b - a + lag
            if length >= max(LEAST_WORDS, REPEATS * lag):
                found.append((a, length, lag))
                of_lag.setdefault(lag, []).append((a, a + length))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text, by start and period."""
    ids: dict[bytes, int] = {}
    words = np.fromiter((ids.setdefault(x, len(ids)) for text in texts for x in text), np.int64)
    out: list[list[Run]] = [[] for _ in texts]
    if not len(words):
        return out
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    starts, ends = segments(words, bounds)
    owner = np.searchsorted(bounds, starts, "right") - 1
    for a, b, text in zip(starts.tolist(), ends.tolist(), owner.tolist(), strict=True):
        first = a - int(bounds[text])
        out[text] += [(first + s, length, period) for s, length, period in scan(words[a:b])]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def dropped(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stand in a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge)[:n] > 0


def slices(batches) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Texts cut into words, few enough at once."""
    for part in row_slices(batches):
        at, held, words = 0, 0, []
        for text in part.column(1):
            words.append(split_words(text.as_py()))
            held += len(words[-1])
            if held >= WORDS_AT_ONCE:
                yield part.slice(at, len(words)), words
                at, held, words = at + len(words), 0, []
        if words:
            yield part.slice(at, len(words)), words


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period of each, by start, then period) and collapsed,
    the text of the words that are left when every run keeps its first period only, joined by one blank."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        run = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for part, texts in slices(batches):
            runs, left = runs_of(texts), []
            for words, own in zip(texts, runs, strict=True):
                gone = dropped(len(words), own) if own else None
                left.append(b" ".join(words if gone is None else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]).decode())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], run),
                 pa.array(left, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        work, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string"
    )


def report(found: DataFrame) -> DataFrame:
    """Per document: the number of runs, the one with most periods (ties: smallest start, then period; four NULLs without
    a run), and digests of all runs and of the collapsed text. Ratios are compared as integers."""
    better = lambda x, y: F.when(
        (y["length"].cast("decimal(19,0)") * x["period"]) > (x["length"].cast("decimal(19,0)") * y["period"]), y
    ).otherwise(x)
    best = F.when(F.size("runs") > 0, F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.col("runs")[0], better))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
