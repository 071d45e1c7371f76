"""Language identification.

Texts are lower-cased and cut into character n-grams, hashed to a fixed number
of features and weighted by TF-IDF; document frequencies are counted over all
training rows. A sparse multinomial logistic regression is trained on a bounded
sample with follow-the-regularised-leader steps under an elastic net, then one
temperature is fitted on sampled rows that it was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.texts import mixed

ORDERS = (1, 2, 3)
FEATURES = 1 << 16
SAMPLE_ROWS = 8_000  # labelled rows a model is fitted on, about
HELD_FOR_TEMPERATURE = 5  # every n-th of them fits the temperature only
EPOCHS = 3
ALPHA, BETA, L1, L2 = 5.0, 1.0, 1e-4, 1e-6
BLOCK = 1 << 20  # characters hashed at once
UNKNOWN = "und"


@dataclass
class Model:
    """weights: FEATURES x languages, with the IDF already in them."""

    langs: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_blocks(text: str, orders=ORDERS, features: int = FEATURES) -> Iterator[np.ndarray]:
    """Feature numbers of all n-grams of the lower-cased text, a block at a time."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    for at in range(0, len(points), BLOCK):
        part = points[at : at + BLOCK + max(orders) - 1].astype(np.uint64)
        for n in orders:
            # n-grams that start in this block
            size = min(BLOCK, len(points) - at, len(part) - n + 1)
            if size > 0:
                h = np.full(size, n, np.uint64)
                for k in range(n):
                    h = h * np.uint64(0x9E3779B97F4A7C15) + part[k : k + size]
                yield (mixed(h) & np.uint64(features - 1)).astype(np.int64)


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros(FEATURES, np.int64)
    for grams in gram_blocks(text):
        counts += np.bincount(grams, minlength=FEATURES)
    seen = np.flatnonzero(counts)
    return seen, counts[seen]


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """IDF of every feature over all rows of ``texts`` (column text). Tasks count
    their rows; one number per feature, a fixed number of them, is collected."""

    def count(batches):
        found = np.zeros(FEATURES, np.int64)
        rows = 0
        for batch in batches:
            for text in batch.column(0):
                here = np.zeros(FEATURES, bool)
                for grams in gram_blocks(text.as_py() or ""):
                    here[grams] = True
                found += here
                rows += 1
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(found[seen], rows))],
            names=["feature", "n"],
        )

    parts = texts.select("text").mapInArrow(count, "feature long, n long")
    totals = parts.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    found, rows = np.zeros(FEATURES), 0
    for feature, n in zip(totals["feature"], totals["n"]):
        if feature < 0:
            rows = n
        else:
            found[feature] = n
    return np.log((1 + rows) / (1 + found)) + 1


def _ftrl(rows: list, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over rows (features, values, language)."""
    z = np.zeros((FEATURES + 1, n_langs))
    n = np.zeros_like(z)

    def weights(z, n):
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / rate)

    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            seen, values, lang = rows[k]
            seen, values = np.append(seen, FEATURES), np.append(values, 1.0)
            w = weights(z[seen], n[seen])
            p = _softmax(values @ w)
            p[lang] -= 1
            g = values[:, None] * p
            z[seen] += g - (np.sqrt(n[seen] + g * g) - np.sqrt(n[seen])) / ALPHA * w
            n[seen] += g * g
    w = weights(z, n)
    return w[:FEATURES], w[FEATURES]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _temperature(logits: np.ndarray, langs: np.ndarray) -> float:
    """The temperature of least log loss, on a fixed grid; 1 without rows."""
    if not len(langs):
        return 1.0
    grid = np.geomspace(0.05, 20, 61)
    rows = np.arange(len(langs))
    loss = [-np.log(_softmax(logits / t)[rows, langs] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit a model on rows with doc_id, text and lang, the latter two not null; None
    without rows.

    The sample is drawn by a hash of id and text, so copies under ids of their own
    are drawn like other rows, and rows that repeat both are one, in proportion to the rows of each
    language but with at least ``sample_rows / languages / 4`` of each if there
    are so many. One task fits it; its size does not grow with the input.
    """
    rows = rows.select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    langs = sorted(counts)
    idf = inverse_frequencies(rows)
    total = sum(counts.values())
    least = sample_rows / len(langs) / 4
    share = {
        lang: min(1.0, max(sample_rows * n / total, least) / n) for lang, n in counts.items()
    }
    shares = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    sample = rows.where(draw < shares[F.col("lang")]).distinct().select("text", "lang")

    def features(batches):
        for batch in batches:
            seen, counted = [], []
            for text in batch.column(0):
                a, b = _counts(text.as_py())
                seen.append(a.astype(np.int32))
                counted.append((b / max(b.sum(), 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(seen, pa.list_(pa.int32())),
                    pa.array(counted, pa.list_(pa.float32())),
                    batch.column(1).cast(pa.string()),
                ],
                names=["seen", "tf", "lang"],
            )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        data = sorted(
            (
                (np.asarray(s), np.asarray(t) * idf[np.asarray(s, int)], langs.index(g))
                for s, t, g in zip(pdf["seen"], pdf["tf"], pdf["lang"])
            ),
            # an order of their own, whatever order the rows arrive in
            key=lambda row: (len(row[0]), row[2], row[1].sum()),
        )
        held = data[::HELD_FOR_TEMPERATURE] if len(data) >= 50 else []
        learn = [r for k, r in enumerate(data) if k % HELD_FOR_TEMPERATURE] if held else data
        w, bias = _ftrl(learn, len(langs))
        logits = np.array([v @ w[s] + bias for s, v, _ in held])
        t = _temperature(logits, np.array([g for _, _, g in held], int))
        folded = (w * idf[:, None]).astype("<f8")
        return pd.DataFrame({"w": [folded.tobytes()], "b": [bias.tobytes()], "t": [t]})

    listed = sample.mapInArrow(features, "seen array<int>, tf array<float>, lang string")
    fitted = listed.groupBy(F.lit("all").alias("_group")).applyInPandas(fit, "w binary, b binary, t double").first()
    if fitted is None:
        return None
    w = np.frombuffer(fitted["w"], "<f8").reshape(FEATURES, len(langs))
    return Model(langs, w, np.frombuffer(fitted["b"], "<f8"), fitted["t"])


def identify(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, lang_pred and score (its calibrated
    probability). Null texts and texts without a letter are ``und`` with score 0,
    as is everything without a model."""

    def predict(batches):
        for batch in batches:
            found, scores = [], []
            for text in batch.column(batch.num_columns - 1):
                text = text.as_py()
                if model is None or not text or not has_letter(text):
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total, n = np.zeros(len(model.langs)), 0
                for grams in gram_blocks(text):
                    total += model.weights[grams].sum(axis=0)
                    n += len(grams)
                p = _softmax((total / n + model.bias) / model.temperature)
                best = int(np.argmax(p))
                found.append(model.langs[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    rows = docs.select(*keep, F.col("text").cast("string"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(predict, f"{kinds}, lang_pred string, score double")


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds))


def language_report(docs: DataFrame, folds: int = 4, held_fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the other
    folds' text and lang. Rows with a null doc_id belong to no fold: they are
    judged (held_out false) and not learned from, nor are null texts or langs."""
    fold = fold_of("doc_id", folds)
    known = docs.where((fold != held_fold) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = train(known)
    marked = docs.select(
        F.col("doc_id"), F.coalesce(fold == held_fold, F.lit(False)).alias("held_out"), "text"
    )
    return identify(marked, model, ["doc_id", "held_out"])
