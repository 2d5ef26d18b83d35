"""Language of a text by string kernels.

The blended-spectrum presence kernel of two texts counts the byte n-grams, n = 2 to 4, that both
hold (hashed to 2^18 values), divided by the geometric mean of their own counts. Landmarks
are some of the training texts; the Nystroem map takes a text's kernel values with them to
features, on which one kernel ridge regression per language, against the rest, is solved. To
score, presence rows of a batch are multiplied with the landmarks' presence matrix, and the
kernel rows with the dual weights.

The fit uses a bounded sample: at most SAMPLE texts, the same number of each language as far
as there are so many. Texts are used whole, lower-cased, with ASCII signs and digits as blanks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.frames import by_text
from fraclake.llm.words import LETTERS, text_bytes

SAMPLE, LANDMARKS, RIDGE = 1600, 128, 1e-2
LENGTHS, BITS = (2, 3, 4), 18
UNDETERMINED = "und"
_MARKS = 64


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def grams(data: np.ndarray) -> np.ndarray:
    """Hashed n-grams of one text, with repeats."""
    plain = np.where(LETTERS[data], data, np.uint8(32))
    wide = plain.astype(np.uint32)
    out, code = [], wide
    for n in range(2, LENGTHS[-1] + 1):
        code = (code[:-1] << np.uint32(8)) | wide[n - 1:]
        if n in LENGTHS:
            out.append(((code ^ np.uint32(n * 0x5BD1E995 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    return np.concatenate(out)


def presence(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct n-grams of each text of a lower-cased column."""
    data, offsets = text_bytes(column)
    seen, out = np.zeros(1 << BITS, bool), []
    for lo, hi in zip(offsets, offsets[1:]):
        for at in range(lo, hi, 1 << 20):  # a long text in parts, so that vectors stay small
            seen[grams(data[at:min(hi, at + (1 << 20) + LENGTHS[-1] - 1)])] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        out.append(found)
    return out


@dataclass
class Model:
    """``column``: which presence column an n-gram has, or -1. ``shared``: landmarks' presence by
    column. ``norm``: square roots of their n-gram counts. ``dual``: weights by landmark, with
    a constant in the last row."""

    languages: list[str]
    column: np.ndarray
    shared: np.ndarray
    norm: np.ndarray
    dual: np.ndarray

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(texts), len(self.languages)), np.float32)
        for lo in range(0, len(texts), _MARKS):
            part = texts[lo:lo + _MARKS]
            rows = np.zeros((len(part), self.shared.shape[0]), np.float32)
            for i, found in enumerate(part):
                at = self.column[found]
                rows[i, at[at >= 0]] = 1
            own = np.sqrt([max(1, len(found)) for found in part])
            kernel = (rows @ self.shared) / np.outer(own, self.norm).astype(np.float32)
            out[lo:lo + len(part)] = kernel @ self.dual[:-1] + self.dual[-1]
        return out


def fit(texts: list[np.ndarray], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """A model of presence rows; those of all languages should come in mixed order."""
    names = sorted(set(languages))
    marks, per = [], max(1, landmarks // len(names))
    for name in names:
        marks += [i for i, x in enumerate(languages) if x == name][:per]
    grams_of_marks = np.unique(np.concatenate([texts[i] for i in marks])) if marks else np.zeros(0, np.int64)
    column = np.full(1 << BITS, -1, np.int32)
    column[grams_of_marks] = np.arange(len(grams_of_marks))
    shared = np.zeros((len(grams_of_marks), len(marks)), np.float32)
    for k, i in enumerate(marks):
        shared[column[texts[i]], k] = 1
    norm = np.sqrt([max(1, len(texts[i])) for i in marks])
    plain = Model([""] * len(marks), column, shared, norm, np.vstack([np.eye(len(marks)), np.zeros(len(marks))]).astype(np.float32))
    kernel = plain.scores(texts).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[marks])
    kept = values > 1e-6 * values.max()
    to_features = vectors[:, kept] / np.sqrt(values[kept])
    features = np.hstack([kernel @ to_features, np.ones((len(texts), 1))])
    targets = np.where(np.array(languages)[:, None] == np.array(names)[None], 1.0, -1.0)
    weights = np.linalg.solve(features.T @ features + ridge * len(texts) / 100 * np.eye(features.shape[1]), features.T @ targets)
    dual = np.vstack([to_features @ weights[:-1], weights[-1:]])
    return Model(names, column, shared, norm, dual.astype(np.float32))


def training_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, chance, grams): packed presence of sampled training texts.

    A row is drawn by a hash of its doc_id against a share that gives each language its
    number of rows; the limit holds even where one doc_id repeats.
    """
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample).collect()
    if not counts:
        return docs.sparkSession.createDataFrame([], "lang string, chance bigint, grams binary")
    per = max(1, sample // len(counts))
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 1)
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(int(min(1.0, 1.2 * per / r["count"]) * (2**63 - 1025))))])
    drawn = usable.where(chance <= share[F.col("lang")])

    def packed(column: pa.Array) -> pa.Array:
        return pa.array([np.packbits(np.isin(np.arange(1 << BITS), found)).tobytes() for found in presence(column)], pa.binary())

    return drawn.select("lang", chance.alias("chance"), by_text(packed, "binary")(F.lower("text")).alias("grams")).limit(2 * sample)


def trained(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    rows = sorted(training_sample(docs, sample).collect(), key=lambda r: (r.chance, r.lang, bytes(r.grams)))
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    per = max(1, sample // max(1, len(by)))
    used = [r for some in by.values() for r in some[:per]]
    if not used:
        return None
    used.sort(key=lambda r: (r.chance, r.lang))
    return fit([np.flatnonzero(np.unpackbits(np.frombuffer(r.grams, np.uint8))) for r in used], [r.lang for r in used])


def languages(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of (doc_id, text, lang).

    Learns from rows that are not held out and have a language and a text. A null text, or one
    without any letter, is ``und`` with score 0, and so is every text if there is nothing to
    learn from. A null doc_id is not held out. Ties go to the language first in the alphabet.
    """
    model = trained(docs.select("doc_id", "text", "lang"), sample)

    def predict(column: pa.Array) -> pa.Array:
        names, score = [None] * len(column), np.zeros(len(column))
        if model is not None:
            found = model.scores(presence(column))
            best = found.argmax(axis=1)
            letters = pc.match_substring_regex(column, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
            names = [model.languages[b] if x else None for b, x in zip(best, letters)]
            score = np.where(letters, np.clip((found.max(axis=1, initial=-1) + 1) / 2, 0, 1), 0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["lang", "score"])

    scored = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), by_text(predict, "struct<lang:string,score:double>")(F.lower("text")).alias("p"))
    return scored.select("doc_id", "held_out", F.coalesce("p.lang", F.lit(UNDETERMINED)).alias("lang_pred"), F.col("p.score").alias("score"))
