"""Language identification in two steps: the family, then pairs of related languages within it.

A text becomes the square roots of the shares of its hashed byte n-grams (two to four bytes of lower-cased
words with their borders; digits and ASCII punctuation are borders). A linear classifier for each
family picks the family; inside it, one-versus-one linear support vector machines vote. All machines
minimise the squared hinge loss with an L2 penalty and are fitted on a bounded sample of labelled
rows (``per_language`` rows of each language or about as many, chosen by a hash of the id).

``score`` is the product of the logistic family and language confidences. ``und`` with score 0 goes
to null texts, texts without a letter and all texts if nothing was learned. Rows with null ids are
predicted like others; repeated rows get the same prediction; the other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemill.llm import blocks
from tidemill.llm.sampling import bounded_sample

# Language families by ISO 639-1 code. A language not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "rm", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu", "se"),
    "turkic": ("az", "kk", "ky", "tk", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "sa", "si", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "malayic": ("id", "jv", "ms", "su", "tl"),
}
UNDETERMINED = "und"
BITS = 13
SIZES = (2, 3, 4)
SHARPNESS = 3.0  # margin to confidence
FEATURE_ROWS = 256  # rows of features in memory at a time
ADDED = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

_FOLD = np.full(256, 32, np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)


def family(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes), f"only {lang}")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: square roots of n-gram shares, so that every row has length one or zero."""
    n = len(offsets) - 1
    folded = _FOLD[data]
    blank = folded == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # one space of each run
    kept_before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=kept_before[1:])
    cut, folded = kept_before[offsets], folded[keep].astype(np.uint32)
    owner = np.repeat(np.arange(n), np.diff(cut))
    counts = np.zeros(n << BITS, np.float32)
    for size in SIZES:
        m = len(folded) - size + 1
        if m <= 0:
            continue
        code = np.full(m, size, np.uint32)
        for k in range(size):
            code = (code * np.uint32(257) + folded[k : k + m]) & np.uint32(0xFFFFFFFF)
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        inside = owner[:m] == owner[size - 1 :]
        slot = (owner[:m][inside] << BITS) + code[inside]
        counts += np.bincount(slot, minlength=n << BITS).astype(np.float32)
    counts = counts.reshape(n, 1 << BITS)
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Weights (the last is the bias) of a squared-hinge linear classifier, by accelerated descent.

    Classes weigh the same whatever their sizes.
    """
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    y = y.astype(np.float32)
    w, ahead = np.zeros(x.shape[1] + 1, np.float32), np.zeros(x.shape[1] + 1, np.float32)
    rate = np.float32(1 / (2 * 2.0 + penalty))  # rows have length one, and one more for the bias
    for step in range(1, steps + 1):
        slack = np.maximum(1 - y * (x @ ahead[:-1] + ahead[-1]), 0) * weight * y
        grad = np.append(-2 * (slack @ x), -2 * slack.sum()) + penalty * ahead
        new = ahead - rate * grad.astype(np.float32)
        ahead = new + np.float32((step - 1) / (step + 2)) * (new - w)
        w = new
    return w


@dataclass
class LanguageModel:
    """Families with their languages; machines as columns of weights."""

    families: list[tuple[str, list[str]]] = field(default_factory=list)
    family_weights: np.ndarray = field(default_factory=lambda: np.zeros((0, (1 << BITS) + 1), np.float32))
    pair_weights: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(x)
        if not self.families:
            return np.full(n, UNDETERMINED, object), np.zeros(n)
        sure = lambda m: 1 / (1 + np.exp(-SHARPNESS * m))
        margin = x @ self.family_weights[:, :-1].T + self.family_weights[:, -1]
        chosen, best = margin.argmax(1), np.ones(n)
        if len(self.families) > 1:
            ordered = np.sort(margin, 1)
            best = sure((ordered[:, -1] - ordered[:, -2]) / 2)
        lang, score = np.empty(n, object), np.empty(n)
        for k, (_, langs) in enumerate(self.families):
            rows = np.flatnonzero(chosen == k)
            if not len(rows):
                continue
            votes, total = np.zeros((len(rows), len(langs))), np.zeros((len(rows), len(langs)))
            weakest = np.full((len(rows), len(langs)), np.inf)
            for i, j in combinations(range(len(langs)), 2):
                w = self.pair_weights[langs[i], langs[j]]
                m = x[rows] @ w[:-1] + w[-1]
                votes[:, i] += m >= 0
                votes[:, j] += m < 0
                total[:, i] += np.clip(m, -1, 1)
                total[:, j] -= np.clip(m, -1, 1)
                weakest[:, i] = np.minimum(weakest[:, i], m)
                weakest[:, j] = np.minimum(weakest[:, j], -m)
            win = (votes + total / (2 * len(langs) ** 2)).argmax(1)
            lang[rows] = np.array(langs, object)[win]
            score[rows] = best[rows] * sure(weakest[np.arange(len(rows)), win])
        return lang, score


def fit(
    docs: DataFrame,
    per_language: int = 500,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """Fit on about ``per_language`` rows of each language. The rows' texts stay on the executors:
    the driver gets their non-zero features only."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    picked = bounded_sample(known, id_col, lang_col, per_language, seed)
    rows = picked.select(F.col(id_col).cast("bigint").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks.text_blocks(batch.column("text")):
                x = features(data, offsets)
                at = [np.flatnonzero(row).astype(np.int32) for row in x]
                values = [row[i].tobytes() for row, i in zip(x, at, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {"id": batch.column("id").slice(a, b - a), "lang": batch.column("lang").slice(a, b - a), "at": [i.tobytes() for i in at], "x": values}
                )

    found = rows.mapInArrow(sparse, "id bigint, lang string, at binary, x binary").collect()
    found = sorted({(r["lang"], r["id"]): r for r in found if len(r["at"])}.items())
    langs = sorted({lang for (lang, _), _ in found})
    if not langs:
        return LanguageModel()
    x = np.zeros((len(found), 1 << BITS), np.float32)
    for row, (_, r) in zip(x, found, strict=True):
        row[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["x"], np.float32)
    y = np.array([lang for (lang, _), _ in found], object)
    groups: dict[str, list[str]] = {}
    for lang in langs:
        groups.setdefault(family(lang), []).append(lang)
    model = LanguageModel(sorted(groups.items()))
    model.family_weights = np.stack([fit_svm(x, np.where(np.isin(y, members), 1, -1)) for _, members in model.families])
    for _, members in model.families:
        for a, b in combinations(members, 2):
            rows = np.flatnonzero((y == a) | (y == b))
            model.pair_weights[a, b] = fit_svm(x[rows], np.where(y[rows] == a, 1, -1))
    return model


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` and the columns ``lang_pred`` and ``score``, from the whole text."""

    def compute(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        n = len(texts)
        letter = pc.match_substring_regex(texts, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
        lang, score = np.full(n, UNDETERMINED, object), np.zeros(n)
        for a in range(0, n, FEATURE_ROWS):
            cut = offsets[a : a + FEATURE_ROWS + 1]
            lang[a : a + FEATURE_ROWS], score[a : a + FEATURE_ROWS] = model.predict(features(data[cut[0] : cut[-1]], cut - cut[0]))
        lang[~letter], score[~letter] = UNDETERMINED, 0.0
        return [pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64())]

    return blocks.with_text_columns(docs, text_col, ADDED, compute)
