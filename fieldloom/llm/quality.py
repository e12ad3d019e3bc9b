"""Quality grades by ordinal cumulative-link regression.

The graded rating of a labelled text is quality + 1 - toxic: 0, 1 or 2. One weight vector over hashed words and a few
shares of characters is shared by all grades; ordered thresholds cut the line, P(grade <= k) = logistic(t_k - w.x). From
it follow the expected grade and the tail probability P(grade >= 2), by which texts are selected.

Fitting takes at most ``SAMPLE`` labelled texts (a documented bound, chosen by a hash of doc_id, rating and text, so reruns
agree); grades are predicted for every text, whole. Defined results: null text counts as empty and gets the grade of a text without words; rows of labels
with a null rating or doc_id don't count, repeated ones count once; without labels every text has grade null and is kept; repeated rows give repeated rows; an empty table gives an empty result; other columns, whatever their names, are ignored
by ``grade`` and carried by ``select_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import in_small_batches, row_pieces

BITS = 12
SAMPLE = 4000
GRADES = 3
#: A text stays if its grade is at least LEAST_GRADE with this probability; low, so that doubt keeps a text.
LEAST_GRADE = 2
LEAST_TAIL = 0.25
_SHAPE = 10


#: Texts are worked off in pieces of about so many bytes, cut at blanks (runs without one are cut where a piece ends).
_PIECE = 1 << 18
_SPACE = np.array([b in b" \t\n\v\f\r" for b in range(256)])
#: Letters of words: those of ASCII, and every byte of other characters.
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_BASE = 0x9E3779B97F4A7C15
_UP = np.cumprod(np.r_[np.uint64(1), np.full(2 * _PIECE, _BASE, np.uint64)])
_DOWN = np.cumprod(np.r_[np.uint64(1), np.full(2 * _PIECE, pow(_BASE, -1, 1 << 64), np.uint64)])


def _run_hashes(piece: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes that are inside, from one running sum of a polynomial."""
    edge = np.flatnonzero(np.diff(np.r_[False, inside[piece], False]))
    start, end = edge[::2], edge[1::2]
    sums = np.r_[np.uint64(0), np.cumsum(piece * _UP[: len(piece)])]
    h = (sums[end] - sums[start]) * _DOWN[start]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _pieces(raw: bytes) -> Iterator[np.ndarray]:
    at = 0
    while at < len(raw):
        end = max(raw.rfind(b, at, at + _PIECE) for b in (b" ", b"\n")) + 1 if len(raw) - at > _PIECE else len(raw)
        end = end or min(len(raw), at + _PIECE)
        yield np.frombuffer(raw, np.uint8, end - at, at)
        at = end


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a whole text: hashed words (share of words, by root) and shares of kinds of characters."""
    raw = text.encode()
    seen, hashes = np.zeros(1 << BITS), [np.zeros(0, np.uint64)]
    for piece, low in zip(_pieces(raw), _pieces(raw.lower()), strict=True):
        seen += np.bincount(_run_hashes(low, _LETTER) & np.uint64((1 << BITS) - 1), minlength=1 << BITS)
        hashes.append(_run_hashes(piece, ~_SPACE))
    times = np.unique(np.concatenate(hashes), return_counts=True)[1]
    n, chars = max(int(times.sum()), 1), max(len(raw), 1)
    words = np.flatnonzero(seen)
    b = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / chars
    shape = [
        1.0, b[65:91].sum(), b[48:58].sum(), b[33:48].sum() + b[58:65].sum() + b[91:97].sum() + b[123:127].sum(), b[124], b[32] + b[10],
        len(times) / n, times.max(initial=0) / n, min(1.0, np.log1p(n) / 10), times[times > 1].sum() / n,
    ]
    idx = np.concatenate([np.arange(_SHAPE), words + _SHAPE]).astype(np.int32)
    return idx, np.concatenate([shape, np.minimum(1, 0.3 * np.sqrt(seen[words]))]).astype(np.float32)


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def grade(self, text: str) -> tuple[float, float, int]:
        """Expected grade, P(grade >= LEAST_GRADE) and the likeliest grade."""
        idx, val = features(text)
        below = 1 / (1 + np.exp(-np.clip(self.thresholds - float(self.weights[idx] @ val), -30, 30)))
        each = np.diff(np.concatenate([[0], below, [1]]))
        return float((each * np.arange(len(each))).sum()), float(1 - below[LEAST_GRADE - 1]), int(each.argmax())


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int = GRADES, rounds: int = 200, penalty: float = 1e-4, rate: float = 0.05) -> Ordinal:
    """Cumulative-link fit by Adam steps; thresholds stay ordered as a first one and positive gaps. Grades weigh alike."""
    used = np.nonzero(x.any(axis=0))[0]
    all_columns, x = x.shape[1], np.ascontiguousarray(x[:, used])
    counts = np.bincount(grade, minlength=grades)
    weight = (1 / np.maximum(counts, 1))[grade]
    weight = weight / weight.sum()
    w = np.zeros(x.shape[1])
    free = np.zeros(grades - 1)  # first threshold, then logarithms of gaps
    free[0] = -1
    moments = [np.zeros(len(w) + len(free)) for _ in range(2)]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    rows = np.arange(len(grade))
    for k in range(1, rounds + 1):
        gaps = np.exp(free[1:])
        cuts = np.concatenate([[free[0]], free[0] + np.cumsum(gaps)])
        below = sigmoid(cuts[None, :] - (x @ w.astype(np.float32))[:, None])
        padded = np.concatenate([np.zeros((len(x), 1)), below, np.ones((len(x), 1))], 1)
        p = np.maximum(padded[rows, grade + 1] - padded[rows, grade], 1e-9)
        slope = padded * (1 - padded)
        up, down = slope[rows, grade + 1], slope[rows, grade]
        score = (up - down) / p * weight  # minus the gradient of the likelihood by w.x
        g_w = score.astype(np.float32) @ x + penalty * w
        g_cuts = np.zeros(grades - 1)
        np.add.at(g_cuts, np.minimum(grade, grades - 2), np.where(grade < grades - 1, -up / p * weight, 0))
        np.add.at(g_cuts, np.maximum(grade - 1, 0), np.where(grade > 0, down / p * weight, 0))
        tails = np.cumsum(g_cuts[::-1])[::-1]
        gradient = np.concatenate([g_w, [tails[0]], tails[1:] * gaps])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        step = rate * (moments[0] / (1 - 0.9**k)) / (np.sqrt(moments[1] / (1 - 0.999**k)) + 1e-8)
        w, free = w - step[: len(w)], free - step[len(w) :]
    weights = np.zeros(all_columns)
    weights[used] = w
    return Ordinal(weights, np.concatenate([[free[0]], free[0] + np.cumsum(np.exp(free[1:]))]))


def rating() -> Column:
    return (F.col("quality") + 1 - F.col("toxic")).cast("int")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal | None:
    rated = labels.select(F.col("doc_id").alias("_id"), rating().alias("grade")).filter("grade is not null and _id is not null").distinct()
    chosen = rated.orderBy(F.xxhash64("_id", "grade"), "_id", "grade").limit(sample)  # bounded by sample, so it can be sent to every task
    texts = in_small_batches(docs).select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "grade")
    texts = texts.withColumn("place", F.xxhash64("doc_id", "grade", "text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in row_pieces(frames):
            found = [features(t) for t in frame["text"].fillna("")]
            yield pd.DataFrame({"place": frame["place"].array, "doc_id": frame["doc_id"].array, "grade": frame["grade"].array, "i": [i.tobytes() for i, _ in found], "v": [v.tobytes() for _, v in found]})

    found = texts.mapInPandas(run, "place long, doc_id long, grade int, i binary, v binary")
    # One row for each doc_id, rating and text, and a total order: repeated rows change no rerun.
    found = found.groupBy("place", "doc_id", "grade").agg(F.first("i").alias("i"), F.first("v").alias("v"))
    rows = found.orderBy("place", "doc_id", "grade").limit(sample).toPandas()
    if rows.empty:
        return None
    x = np.zeros((len(rows), _SHAPE + (1 << BITS)), np.float32)
    for k, (i, v) in enumerate(zip(rows["i"], rows["v"], strict=True)):
        x[k, np.frombuffer(i, np.int32)] = np.frombuffer(v, np.float32)
    return fit_ordinal(x, rows["grade"].to_numpy(int))


def grade(docs: DataFrame, model: Ordinal | None, least_tail: float = LEAST_TAIL) -> DataFrame:
    """doc_id, expected_grade, tail_prob, grade, kept per row of docs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in row_pieces(frames):
            found = [model.grade(t) if model else (None, None, None) for t in frame["text"].fillna("")]
            out = pd.DataFrame(found, columns=["expected_grade", "tail_prob", "grade"])
            out["grade"] = out["grade"].astype("Int32")
            out.insert(0, "doc_id", frame["doc_id"].array)
            yield out

    found = in_small_batches(docs).select("doc_id", "text").mapInPandas(run, "doc_id long, expected_grade double, tail_prob double, grade int")
    return found.withColumn("kept", F.coalesce(F.col("tail_prob") >= least_tail, F.lit(True)))


def select_good(docs: DataFrame, model: Ordinal | None, least_tail: float = LEAST_TAIL) -> DataFrame:
    """docs whose tail probability is high enough; all columns as they were."""

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series([model is None or model.grade(t)[1] >= least_tail for t in texts.fillna("")], dtype=bool)

    return in_small_batches(docs).filter(good(F.col("text")))
