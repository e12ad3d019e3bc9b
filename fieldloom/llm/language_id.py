"""Hierarchical language identification: the family first, then one-versus-one linear SVMs within it.

Texts are counted as hashed two- and three-byte windows of their letters. A linear classifier picks the family; within a
family every pair of languages has a linear support vector machine, and the language with the most won pairs (summed
margins decide ties) is predicted. The score is the family's probability times the mean probability of the won pairs.

Fitting takes a bounded sample: at most ``PER_LANGUAGE`` texts of every language (``SAMPLE`` of all together), chosen by a
hash of doc_id and text, repeated rows once; everything else covers all texts whole. Defined results: null text and text without a letter are ``und`` with score 0 (as is everything
when nothing can be learned); rows with null lang are never learned from; very long texts are counted in pieces;
repeated rows give repeated rows; an empty table gives an empty result; other columns, whatever their names, are ignored
by ``predict`` and carried by ``keep_known``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.llm.common import in_small_batches, row_pieces

BITS = 12
PER_LANGUAGE = 500
#: Texts learned from at most; with many languages each gets an equal part of them, one text at least.
SAMPLE = 16_000
#: A text whose score is lower is in no language that can be told: a wrong answer is likelier than a right one.
LEAST_SCORE = 0.5
UNKNOWN = "und"
#: Families of language codes; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu", "se"),
    "turkic": ("az", "kk", "ky", "tk", "tr", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes that are no letters become blanks.
_LETTERS_ONLY = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def held_out() -> Column:
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3) == 1


def features(text: str) -> np.ndarray:
    """Unit vector of root counts of a whole text's hashed byte windows."""
    size = 1 << BITS
    counts = np.zeros(size)
    raw = b" " + text.lower().encode().translate(_LETTERS_ONLY) + b" "
    for at in range(0, len(raw), 1 << 20):  # windows may start in one piece and end in the next
        b = np.frombuffer(raw[at : at + (1 << 20) + 2], np.uint8).astype(np.uint32)
        inner = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
        three = inner[:-1] * np.uint32(0xC2B2AE3D) + b[2:] * np.uint32(0x27D4EB2F)
        if at + (1 << 20) + 2 < len(raw):
            inner = inner[: 1 << 20]
            three = three[: 1 << 20]
        counts += np.bincount((inner ^ (inner >> 15)) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS), minlength=size)
        counts += np.bincount((three ^ (three >> 15)) * np.uint32(0x297A2D39) >> np.uint32(32 - BITS), minlength=size)
    counts = np.sqrt(counts)
    return (counts / max(np.sqrt((counts**2).sum()), 1e-12)).astype(np.float32)


def fit_svm(x: np.ndarray, positive: np.ndarray, rounds: int = 150, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge loss) by accelerated gradient steps; classes weigh alike."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    weight = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1)).astype(np.float32)
    w, bias = np.zeros(x.shape[1], np.float32), np.float32(0)
    ahead, ahead_bias, step = w, bias, np.float32(0.2)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead + ahead_bias)) * y * weight
        new, new_bias = ahead + step * (2 * x.T @ slack - penalty * ahead), ahead_bias + step * 2 * slack.sum()
        momentum = k / (k + 3)
        ahead, ahead_bias = new + momentum * (new - w), new_bias + momentum * (new_bias - bias)
        w, bias = new, new_bias
    return w, float(bias)


class Model:
    """Family weights, and pair weights by family; small, and sent to tasks with the function that uses it."""

    def __init__(self, x: np.ndarray, lang: np.ndarray):
        self.languages = sorted(set(lang))
        family = np.array([_FAMILY_OF.get(v, v) for v in lang])
        self.families = sorted(set(family))
        self.members = {f: [v for v in self.languages if _FAMILY_OF.get(v, v) == f] for f in self.families}
        fitted = [fit_svm(x, family == f) for f in self.families] if len(self.families) > 1 else [(np.zeros(x.shape[1], np.float32), 1.0)]
        self.family_w, self.family_b = np.stack([w for w, _ in fitted]), np.array([b for _, b in fitted])
        self.pairs = {}
        for f, members in self.members.items():
            for a, b in combinations(members, 2):
                rows = (lang == a) | (lang == b)
                self.pairs[f, a, b] = fit_svm(x[rows], lang[rows] == a)

    def predict(self, text: str) -> tuple[str, float]:
        x = features(text)
        sure = lambda m: 1 / (1 + np.exp(-4 * m))
        margins = self.family_w @ x + self.family_b
        family = self.families[int(margins.argmax())]
        score = float(sure(margins.max()))
        members = self.members[family]
        if len(members) == 1:
            return members[0], score
        won = {v: [0, 0.0, 0.0] for v in members}
        for a, b in combinations(members, 2):
            w, bias = self.pairs[family, a, b]
            m = float(w @ x + bias)
            best = won[a if m >= 0 else b]
            best[0] += 1
            best[1] += abs(m)
            best[2] += float(sure(abs(m)))
        lang = max(members, key=lambda v: (won[v][0], won[v][1], v))
        return lang, score * won[lang][2] / max(won[lang][0], 1)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from at most per_language texts of each language, of rows that are not held out; None without such rows."""
    known = in_small_batches(docs).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).withColumn("place", F.xxhash64("doc_id", "text"))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).orderBy("lang").collect()  # one row per language
    if not counts:
        return None
    per_language = max(1, min(per_language, SAMPLE // len(counts)))
    # Rows well over the bound go on, so that texts without letters leave enough; the window below keeps to the bound.
    share = F.element_at(F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, (2 * per_language + 50) / max(r["n"], 1)))]), F.col("lang"))
    sample = known.filter(F.pmod("place", F.lit(1 << 20)) / float(1 << 20) < share).select("doc_id", "lang", "text", "place").dropDuplicates(["lang", "place"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in row_pieces(frames):
            ok = frame["text"].str.contains(_LETTER)
            frame = frame[ok]
            yield pd.DataFrame({"doc_id": frame["doc_id"].array, "lang": frame["lang"].array, "place": frame["place"].array, "x": [features(t).astype(np.float16).tobytes() for t in frame["text"]]})

    found = sample.mapInPandas(run, "doc_id long, lang string, place long, x binary")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("place", F.lit(1 << 20)), "place"))
    rows = found.withColumn("nth", nth).filter(F.col("nth") <= per_language).drop("nth", "place").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["lang", "doc_id", "x"])
    return Model(np.stack([np.frombuffer(v, np.float16) for v in rows["x"]]).astype(np.float32), rows["lang"].to_numpy(str))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row of docs; the text alone decides."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in row_pieces(frames):
            found = [model.predict(t) if model and _LETTER.search(t) else (UNKNOWN, 0.0) for t in frame["text"].fillna("")]
            yield pd.DataFrame({"doc_id": frame["doc_id"].array, "held_out": frame["held_out"].array, "lang_pred": [v for v, _ in found], "score": [s for _, s in found]})

    return in_small_batches(docs).select("doc_id", held_out().alias("held_out"), "text").mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | None, least_score: float = LEAST_SCORE) -> DataFrame:
    """docs without those predicted ``und`` or scored below least_score (languages never learned, too little text); all columns as they were."""

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        found = [model.predict(t) if model and _LETTER.search(t) else (UNKNOWN, 0.0) for t in texts.fillna("")]
        return pd.Series([v != UNKNOWN and s >= least_score for v, s in found], dtype=bool)

    return in_small_batches(docs).filter(known(F.col("text")))
