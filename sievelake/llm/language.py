"""Language identification with string kernels.

A text is the set of its character n-grams, n = 1..4 (blended spectrum, presence only), over letters with every other
character as a space. The kernel of two texts is the cosine of their sets. Nystroem landmarks approximate the kernel,
one ridge regression per language (one versus the rest) is fitted on them, and batches of texts are scored by one matrix
product: presence matrix times (landmark sets times dual weights).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMS = 1 << 16
ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"
_SALT = {1: 0x85EBCA6B, 2: 0xC2B2AE35, 3: 0x27D4EB2F, 4: 0x165667B1}
_FOLD: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> itself for a letter (Unicode categories L*, all planes), else a space (built once per worker)."""
    if not _FOLD:
        _FOLD.append(np.array([c if chr(c).isalpha() else 32 for c in range(sys.maxunicode + 1)], np.uint32))
    return _FOLD[0]


def _code_points(text: str) -> np.ndarray:
    """Lower-case letters between single spaces; empty if there is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = _letters()[points]
    space = points == 32
    keep = ~space
    keep[1:] |= ~space[:-1]  # of several spaces the first stays
    points = points[keep]
    if not (points != 32).any():
        return points[:0]
    points = points[int(points[0] == 32) : len(points) - int(points[-1] == 32)]
    return np.concatenate(([32], points, [32])).astype(np.uint32)


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Presence matrix (texts x hashed n-grams, 0 or 1), and which texts have a letter."""
    out, known = np.zeros((len(texts), DIMS), np.uint8), np.zeros(len(texts), bool)
    for row, text in enumerate(texts):
        points = _code_points(text) if text else np.zeros(0, np.uint32)
        known[row] = len(points) > 0
        rolled = np.zeros(len(points), np.uint32)
        for n in ORDERS:
            if len(points) < n:
                break
            with np.errstate(over="ignore"):
                rolled = rolled[: len(points) - n + 1] * np.uint32(0x9E3779B1) + points[n - 1 :]
                code = rolled ^ np.uint32(_SALT[n])
                code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out[row, (code ^ (code >> np.uint32(13))) >> np.uint32(16)] = 1
    return out, known


def _packed(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in series:
        yield pd.Series([np.packbits(presence([t])[0]).tobytes() for t in texts], dtype=object)


def fit(labelled: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id", fit_rows: int = 2400, landmarks: int = 320, ridge: float = 0.05) -> dict:
    """A model from at most about ``fit_rows`` labelled rows, as many of each language where there are so many.

    A language has 20 rows at least, so only the ``fit_rows`` / 20 most frequent labels (ties: the first by name) are learned.
    Rows without text or label are not used. The sample is chosen by a hash of the key, so it doesn't depend on the
    partitioning. Without usable rows the model knows no language and predicts ``und``.
    """
    rows = labelled.select(F.col(label).alias("label"), F.col(text).alias("text"), F.col(key).cast("string").alias("key")).dropna()
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(max(1, fit_rows // 20)).collect()}
    if not counts:
        return {"labels": [], "weights": np.zeros((DIMS, 0), np.float32)}
    each = max(20, fit_rows // len(counts))
    scale = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(float(each) / n))))
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(place < F.element_at(scale, F.col("label"))).orderBy(F.xxhash64("key"), "key").limit(2 * each * len(counts))
    packed = sample.select("label", F.pandas_udf(_packed, "binary")("text").alias("bits")).collect()
    bits = [np.frombuffer(r["bits"], np.uint8) for r in packed]
    count = np.array([np.bitwise_count(x).sum(dtype=np.int64) for x in bits])
    names = [r["label"] for r in packed]
    usable = np.flatnonzero(count > 0)
    labels = sorted({names[i] for i in usable})
    if not labels:
        return {"labels": [], "weights": np.zeros((DIMS, 0), np.float32)}

    def unit(rows: np.ndarray) -> np.ndarray:
        return np.stack([np.unpackbits(bits[i]) for i in rows]).astype(np.float32) / np.sqrt(count[rows, None]).astype(np.float32)

    target = np.array([[1.0 if names[i] == c else -1.0 for c in labels] for i in usable], np.float64)
    chosen = np.random.default_rng(0).permutation(len(usable))[:landmarks]
    marks = unit(usable[chosen])
    knm = np.concatenate([unit(usable[i : i + 128]) @ marks.T for i in range(0, len(usable), 128)]).astype(np.float64)
    values, vectors = np.linalg.eigh(knm[chosen])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # K_mm^(-1/2), without the null space
    z = knm @ root
    z1 = np.hstack([z, np.ones((len(z), 1))])
    # every language weighs the same in its own regression's two sides
    share = np.array([[1.0 / max((target[:, c] == target[i, c]).sum(), 1) for c in range(len(labels))] for i in range(len(target))])
    solved = []
    for c in range(len(labels)):
        w = share[:, c] / share[:, c].sum()
        solved.append(np.linalg.solve(z1.T @ (z1 * w[:, None]) + ridge / len(z) * np.eye(z1.shape[1]), z1.T @ (w * target[:, c])))
    duals = np.stack(solved, axis=1)
    return {"labels": labels, "weights": (marks.T @ (root @ duals[:-1]).astype(np.float32)), "bias": duals[-1].astype(np.float32)}


def classify(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with lang_pred and score (0 to 1); whole texts are read.

    Of languages with equal scores the first by name counts. Null text, text without a letter, and any text under a model
    without languages get ``und`` and score 0; input columns named lang_pred or score are replaced; an empty table gives
    no rows.
    """
    held = df.sparkSession.sparkContext.broadcast(model)  # n-grams x languages

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        for texts in series:
            pred, score = [], []
            for at in range(0, len(texts), 32):
                some = texts.iloc[at : at + 32].tolist()
                if not m["labels"]:
                    pred += [UNKNOWN] * len(some)
                    score += [0.0] * len(some)
                    continue
                seen, known = presence(some)
                wide = seen.astype(np.float32)
                norm = np.sqrt(np.maximum(wide.sum(axis=1, keepdims=True), 1))
                out = (wide @ m["weights"]) / norm + m["bias"]
                best = out.argmax(axis=1)
                value = np.clip((out[np.arange(len(some)), best] + 1) / 2, 0, 1)
                pred += [m["labels"][b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                score += [float(v) if k else 0.0 for v, k in zip(value, known, strict=True)]
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    found = df.drop("lang_pred", "score").withColumn("_lang", F.pandas_udf(run, "lang_pred string, score double")(F.col(text)))
    return found.withColumns({"lang_pred": F.col("_lang.lang_pred"), "score": F.col("_lang.score")}).drop("_lang")


def held_out(key: str = "doc_id"):
    """True where crc32 of the key as text leaves 1 when divided by 3; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
