"""Quality classification by co-training.

Two classifiers see a document differently: one its content (hashed character trigrams and words), the other its
metadata (source, language, sizes and layout figures). Both start from a bounded labelled sample. In each round both
score every unlabelled document of the corpus, and the most confident documents of each view join the other view's
training set with the label the first one gave them. In the end each view's output is calibrated on labelled rows kept
aside, and the two calibrated log-odds are added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, materialize, slices, words_of

GRAMS, WORDS, HASHED = 4096, 2048, 48
FIGURES = 10
TEXT_DIMS, META_DIMS = GRAMS + WORDS, FIGURES + HASHED
SLICE_BYTES = 1 << 20


def features(texts: pa.Array, sources: list[str | None], langs: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts for the content view (0 to 255), and the metadata view's raw figures, of whole texts."""
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    buf = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    length = np.diff(ends)
    doc = np.repeat(np.arange(n), length)
    content = np.zeros((n, TEXT_DIMS), np.uint8)
    if len(buf) >= 3:
        wide = buf.astype(np.uint32)
        code = (wide[:-2] * np.uint32(0x10001) + wide[1:-1] * np.uint32(0x101) + wide[2:]) * np.uint32(0x9E3779B1) >> np.uint32(20)
        inside = doc[:-2] == doc[2:]
        grams = np.bincount(doc[:-2][inside] * GRAMS + code[inside], minlength=n * GRAMS).reshape(n, GRAMS)
        content[:, :GRAMS] = np.minimum(grams, 255)
    words, bounds = words_of(texts, lower=True)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    content[:, GRAMS:] = np.minimum(np.bincount(owner * WORDS + (words >> np.uint64(53)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS), 255)
    count = np.diff(bounds)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=n) / np.maximum(length, 1)

    order = np.lexsort((words, owner))
    distinct = np.ones(len(words), bool)
    distinct[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    repeated = np.zeros(len(words), bool)
    repeated[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    upper, lower, digit = (buf >= 65) & (buf <= 90), (buf >= 97) & (buf <= 122), (buf >= 48) & (buf <= 57)
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    lines = np.bincount(doc[buf == 10], minlength=n)
    meta = np.zeros((n, META_DIMS), np.float32)
    meta[:, :FIGURES] = np.stack([
        np.log1p(length), np.log1p(count), np.log1p(lines), length / np.maximum(count, 1), share(upper), share(digit), share(~(upper | lower | digit | blank) & (buf < 128)), share(blank),
        np.bincount(owner[order][distinct], minlength=n) / np.maximum(count, 1), np.bincount(owner[repeated], minlength=n) / np.maximum(count, 1),
    ], axis=1)
    for row, (source, lang) in enumerate(zip(sources, langs, strict=True)):
        for name in (f"source={source}", f"lang={lang}"):
            meta[row, FIGURES + xxhash.xxh3_64_intdigest(name) % HASHED] = 1
    return content, meta


def _content(counts: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 250) -> np.ndarray:
    """Weights (last: bias) of a ridge logistic regression, both classes weighing the same, by accelerated gradient."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1)).astype(np.float32)
    step = 1 / (0.25 * float((weight[:, None] * x * x).sum()) + ridge)
    w = np.zeros(x.shape[1], np.float32)
    ahead, keep = w.copy(), np.append(np.full(x.shape[1] - 1, ridge), 0).astype(np.float32)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - step * (x.T @ (weight * (p - y)) + keep * ahead)
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


def _platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of the calibrated log-odds a * score + b, by damped Newton steps on smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(float(np.abs(score).max()), 1e-6)
    x, w = np.stack([score / scale, np.ones(len(score))], axis=1).astype(np.float64), np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((np.logaddexp(0, z) - target * z).sum() + 5e-4 * v @ v)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * w)
        rate = 1.0
        while rate > 1e-6 and loss(w - rate * step) > loss(w):
            rate /= 2
        w = w - rate * step
        if rate <= 1e-6 or np.abs(rate * step).max() < 1e-8:
            break
    return float(max(w[0], 0)) / scale, float(w[1])


def _each(batch: pa.RecordBatch):
    texts = binary_column(batch.column("text"))
    for s, e in slices(texts, SLICE_BYTES):
        part = slice(s, e)
        yield part, *features(texts[s:e], batch.column("source").to_pylist()[part], batch.column("lang").to_pylist()[part])


def _packed(batches):
    for batch in batches:
        for part, content, meta in _each(batch):
            own = batch.slice(part.start, part.stop - part.start)
            packed = [pa.compress(c.tobytes(), codec="zstd", asbytes=True) for c in content]
            yield pa.RecordBatch.from_arrays([own.column("doc_id"), pa.array(packed, pa.binary()), pa.array([m.tobytes() for m in meta], pa.binary())], names=["doc_id", "content", "meta"])


def _load(docs: DataFrame, chosen: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Features of the chosen ids (a bounded table) by id."""
    rows = docs.join(F.broadcast(chosen), "doc_id", "left_semi").mapInArrow(_packed, "doc_id long, content binary, meta binary").collect()
    return {r["doc_id"]: (np.frombuffer(pa.decompress(r["content"], TEXT_DIMS, codec="zstd", asbytes=True), np.uint8), np.frombuffer(r["meta"], np.float32)) for r in rows}


def _scored(docs: DataFrame, model: dict) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            for part, content, meta in _each(batch):
                own = batch.slice(part.start, part.stop - part.start)
                s0 = _content(content) @ m["text"][:-1] + m["text"][-1]
                s1 = ((meta - m["mean"]) / m["std"]) @ m["meta"][:-1] + m["meta"][-1]
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), pa.array(s0.astype(np.float64)), pa.array(s1.astype(np.float64))], names=["doc_id", "s0", "s1"])

    return docs.mapInArrow(run, "doc_id long, s0 double, s1 double")


def classify(
    df: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 3000, rounds: int = 2, add: int = 150, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
) -> DataFrame:
    """doc_id, score (0 to 1), predicted (0 or 1), content_score and metadata_score of every row of ``df``.

    ``labels`` (key, label 0 or 1) is sampled by a hash of the id down to about ``sample_rows`` rows; every fourth of
    them is kept aside for the calibration. In each of ``rounds`` rounds each view scores all unlabelled rows and hands
    its ``add`` surest of each class to the other view, of equally sure rows those with the smaller ids.

    Null text is empty; a null source or language is a value of its own; rows with a null id are scored but never
    learned from; of repeated labels of an id one counts (the smallest); without labels of both classes every score is
    0.5 and the prediction 1; an empty table gives no rows; other columns are not read.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"))
    known = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna().where("y in (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"))
    known = materialize(known, "quality-labels")
    total = known.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    sample = known.where(place < int((1 << 30) * min(1.0, sample_rows / max(total, 1)))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample_rows)
    sample = materialize(sample, "quality-sample")
    truth = {r["doc_id"]: r["y"] for r in sample.collect()}
    seen = _load(docs, sample)
    truth = {k: y for k, y in truth.items() if k in seen}
    if len(set(truth.values())) < 2:
        return docs.select("doc_id", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"), F.lit(0.5).alias("content_score"), F.lit(0.5).alias("metadata_score"))
    ids = sorted(truth)
    aside = [k for k in ids if xxhash.xxh3_64_intdigest(str(k)) % 4 == 0]
    fit = [k for k in ids if xxhash.xxh3_64_intdigest(str(k)) % 4]
    if len({truth[k] for k in aside}) < 2 or len({truth[k] for k in fit}) < 2:
        aside = fit = ids
    figures = np.stack([seen[k][1] for k in fit])
    mean, std = figures.mean(axis=0), np.maximum(figures.std(axis=0), 1e-3)
    given: tuple[dict[int, int], dict[int, int]] = ({k: truth[k] for k in fit}, {k: truth[k] for k in fit})

    def trained() -> dict:
        y = [np.array(list(g.values()), np.float32) for g in given]
        return {
            "text": _logistic(_content(np.stack([seen[k][0] for k in given[0]])), y[0], 1e-4), "mean": mean, "std": std,
            "meta": _logistic((np.stack([seen[k][1] for k in given[1]]) - mean) / std, y[1], 1e-3),
        }

    model = trained()
    spark = df.sparkSession
    for turn in range(rounds):
        scores = materialize(_scored(docs.where("doc_id is not null"), model), "quality-scores").join(known.select("doc_id"), "doc_id", "left_anti")
        scores = materialize(scores, f"quality-unlabelled-{turn}")
        new: dict[int, int] = {}
        for view, other in ((0, 1), (1, 0)):
            for y, order in ((1, F.col(f"s{view}").desc()), (0, F.col(f"s{view}").asc())):
                sure = F.col(f"s{view}") > 0 if y else F.col(f"s{view}") < 0
                for r in scores.where(sure).orderBy(order, "doc_id").limit(add).select("doc_id").collect():
                    if r["doc_id"] not in given[other]:
                        given[other][r["doc_id"]] = y
                        new[r["doc_id"]] = y
        if not new:
            break
        seen |= _load(docs, spark.createDataFrame([(k,) for k in new], "doc_id long"))
        model = trained()
    s0 = _content(np.stack([seen[k][0] for k in aside])) @ model["text"][:-1] + model["text"][-1]
    s1 = ((np.stack([seen[k][1] for k in aside]) - mean) / std) @ model["meta"][:-1] + model["meta"][-1]
    y = np.array([truth[k] for k in aside], np.float64)
    (a0, b0), (a1, b1) = _platt(s0, y), _platt(s1, y)
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    odds = lambda c, a, b: F.col(c) * a + b
    chance = lambda c: 1 / (1 + F.exp(-c))
    # independent views: their log-odds add, and the prior counts once
    out = _scored(docs, model).withColumns({"l0": odds("s0", a0, b0), "l1": odds("s1", a1, b1)})
    out = out.select("doc_id", chance(F.col("l0") + F.col("l1") - prior).alias("score"), chance(F.col("l0")).alias("content_score"), chance(F.col("l1")).alias("metadata_score"))
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "content_score", "metadata_score")
