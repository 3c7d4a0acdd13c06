"""Language identification: the family first, then one-versus-one linear SVMs within the family.

Texts become hashed counts of 1 to 3 neighbouring characters of the whole text. A linear SVM (one per
family against the rest) picks the family; the languages of that family are then told apart by one linear
SVM per pair, by votes and margins. The SVMs are fitted on a bounded sample (``PER_LANGUAGE`` texts of each
language, drawn by hash, each as a whole and as a short piece, as short texts are harder).

The score is a logistic function of the least of: the family's own margin, its lead over the next family, the language's margins over
its siblings, and how typical the text is of that language: its cosine with the mean text of the language, in
standard deviations from what learned texts of its number of different n-grams have, ``ATYPICAL`` of which
are the score 0.5. So a text in a language that was not learned, or in none, scores less than 0.5.

A text that is NULL or has no letter is ``und`` with score 0, and so is every text where nothing could be
learned. With one language learned, that language is the answer. Repeated rows get the same answer.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_slices, sampled

# Families of language codes; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk", "tt"),
    "indic": ("hi", "bn", "ur", "mr", "ne", "gu", "pa", "or"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "semitic": ("ar", "he", "am", "mt"),
    "chinese": ("zh", "yue", "wuu"),
    "malayic": ("id", "ms", "jv", "su", "tl"),
}
FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}

DIM = 4096
#: texts of a language that the SVMs are fitted on
PER_LANGUAGE = 400
PIECE = 80
BLOCK = 1 << 18
#: standard deviations below what is usual at which a text is of no learned language
ATYPICAL = 6.0
UNDETERMINED = "und"


def family_of(lang: str) -> str:
    return FAMILY.get(lang.lower().replace("_", "-").split("-")[0], f"only {lang}")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Hashed counts of 1- to 3-grams; everything that is no letter is one space."""
    total = np.zeros(DIM)
    for at in range(0, len(text), BLOCK):
        part = text[max(0, at - 2):at + BLOCK].lower()  # two characters again, for the n-grams across blocks
        codes = np.frombuffer(f" {part} ".encode("utf-32-le", "replace"), np.uint32)
        codes = np.where((codes < 128) & ((codes < 97) | (codes > 122)), np.uint32(32), codes)
        codes = codes[np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))]
        grams = codes * np.uint32(2654435761)
        hashed = [grams >> np.uint32(20)]
        for _ in range(2):
            grams = (grams[:-1] ^ codes[len(codes) - len(grams) + 1:]) * np.uint32(2654435761) + np.uint32(977)
            hashed.append((grams ^ (grams >> np.uint32(15))) * np.uint32(2246822519) >> np.uint32(20))
        total += np.bincount(np.concatenate(hashed), minlength=DIM)
    return total


def vector(text: str) -> np.ndarray:
    root = np.sqrt(counts(text))
    return (root / max(np.linalg.norm(root), 1e-9)).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 150) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, by accelerated gradient steps."""
    n, d = x.shape
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32) * n
    w, last, bias, last_bias = np.zeros(d, np.float32), np.zeros(d, np.float32), 0.0, 0.0
    step = 1 / (1 / cost + 2 * 2 * float(weight.max()))
    for k in range(1, rounds + 1):
        ahead = (k - 1) / (k + 2)
        at, at_bias = w + ahead * (w - last), bias + ahead * (bias - last_bias)
        slack = np.maximum(0, 1 - y * (x @ at + at_bias)) * weight
        grad = at / cost - 2 * (x.T @ (y * slack)) / n
        last, last_bias = w, bias
        w, bias = at - step * grad, at_bias + step * 2 * float((y * slack).sum()) / n
    return np.append(w, np.float32(bias)).astype(np.float32)


def sizes_of(x: np.ndarray) -> np.ndarray:
    """Logarithm of the number of different n-grams of each text."""
    return np.log(np.maximum(np.count_nonzero(x, axis=1), 1))


class Model:
    """Families, their languages, and all weights as the columns of one matrix."""

    def __init__(self, labels: list[str], x: np.ndarray):
        self.languages = sorted(set(labels))
        self.families = sorted({family_of(c) for c in self.languages})
        of, lang = np.array([family_of(c) for c in labels]), np.array(labels)
        columns = []
        self.members = {f: [c for c in self.languages if family_of(c) == f] for f in self.families}
        if len(self.families) > 1:
            columns += [svm(x, np.where(of == f, 1, -1).astype(np.float32)) for f in self.families]
        self.pairs: list[tuple[str, str, str, int]] = []
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                rows = (lang == a) | (lang == b)
                self.pairs.append((f, a, b, len(columns)))
                columns.append(svm(x[rows], np.where(lang[rows] == a, 1, -1).astype(np.float32)))
        self.weights = np.stack(columns, 1) if columns else np.zeros((DIM + 1, 0), np.float32)
        self.means, self.usual = np.zeros((DIM, len(self.languages)), np.float32), []
        for k, c in enumerate(self.languages):
            rows = x[lang == c]
            mean = rows.sum(0)
            self.means[:, k] = mean / max(np.linalg.norm(mean), 1e-9)
            # cosine as a straight line over the logarithm of the number of different n-grams
            size, near = sizes_of(rows), rows @ self.means[:, k]
            slope = np.cov(size, near)[0, 1] / size.var(ddof=1) if len(rows) > 2 and size.var() > 1e-6 else 0.0
            level = near.mean() - slope * size.mean()
            self.usual.append((slope, level, max(float(np.std(near - level - slope * size)), 0.01)))

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(x)
        margins, near, size = x @ self.weights[:-1] + self.weights[-1], x @ self.means, sizes_of(x)
        out = []
        for i, m in enumerate(margins):
            sure = [1.0]
            family = self.families[0]
            if len(self.families) > 1:
                own = m[: len(self.families)]
                first = int(own.argmax())
                family = self.families[first]
                sure += [float(own[first]), float(own[first] - np.delete(own, first).max()) / 2]
            votes = dict.fromkeys(self.members[family], 0.0)
            for f, a, b, k in self.pairs:
                if f == family:
                    votes[a if m[k] >= 0 else b] += 1 + min(abs(float(m[k])), 10.0) / 100
            best = max(votes, key=votes.get)
            sure += [float(m[k] if a == best else -m[k]) for f, a, b, k in self.pairs if f == family and best in (a, b)]
            k = self.languages.index(best)
            slope, level, spread = self.usual[k]
            sure.append(float((near[i, k] - level - slope * size[i]) / spread) / ATYPICAL + 1)
            out.append((best, float(1 / (1 + np.exp(-4 * np.clip(min(sure), -20, 20))))))
        return out


def fit(docs: DataFrame, may_learn: Column, per_language: int = PER_LANGUAGE) -> Model:
    """A model from (doc_id, text, lang) rows for which ``may_learn`` holds and lang is not NULL.

    The rows fitted on are bounded by ``per_language``; ids only decide which are drawn.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        may_learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, DIM), np.float32))
    shares = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, per_language / n))])
    drawn = rows.filter(sampled(F.xxhash64("doc_id", "text"), shares[F.col("lang")], 5)).select("lang", "text")

    def featurise(batches):
        for part in row_slices(batches):
            labels, packed = [], []
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                middle = max(0, (len(text) - PIECE) // 2)
                for piece in (text, text[middle:middle + PIECE]):
                    x = vector(piece)
                    at = np.nonzero(x)[0]
                    labels.append(lang)
                    packed.append(at.astype("<u2").tobytes() + x[at].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(packed, pa.binary())], names=["lang", "x"])

    # at most two rows of per_language texts of each language, and a text drawn more often counts so often
    got = drawn.mapInArrow(featurise, "lang string, x binary").limit(4 * per_language * len(sizes)).collect()
    got.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    x = np.zeros((len(got), DIM), np.float32)
    for i, row in enumerate(got):
        n = len(row["x"]) // 6
        x[i, np.frombuffer(row["x"], "<u2", n)] = np.frombuffer(row["x"], "<f4", n, 2 * n)
    return Model([r["lang"] for r in got], x)


def judged(texts: list[str | None], model: Model) -> list[tuple[str, float]]:
    """(language, score) of each text."""
    can = [i for i, t in enumerate(texts) if has_letter(t)]
    out = [(UNDETERMINED, 0.0)] * len(texts)
    if can:
        for i, answer in zip(can, model.predict(np.stack([vector(texts[i]) for i in can])), strict=True):
            out[i] = answer
    return out


def predict(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def answer(batches):
        for part in row_slices(batches):
            found = judged(part.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([a for a, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(answer, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def label(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents whose language is determined with at least this score, with ``lang`` set to it.

    All other columns stay as they are; documents below the score, or without a letter, are left out.
    """
    names = docs.columns

    def keep(batches):
        for part in row_slices(batches):
            columns = dict(zip(names, part.columns, strict=True))
            found = judged(columns["text"].to_pylist(), model)
            columns["lang"] = pa.array([a for a, _ in found], columns["lang"].type)
            mask = pa.array([a != UNDETERMINED and s >= least for a, s in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names).filter(mask)

    return docs.mapInArrow(keep, docs.schema)
