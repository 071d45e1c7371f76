"""Toxic spans by a linear-chain conditional random field.

Documents carry one label each. Tokens of toxic training documents are labelled
by how strongly their word, or the beginning of their word, separates toxic from
clean training documents. A two-state chain learns emission weights of hashed
token features and transitions from these tokens. Forward-backward marginals
give toxic spans; a logistic function of the strongest marginal and the expected
number of toxic tokens gives the document's score.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import giving_back, small_side
from gridloom.llm.langid import fold_of
from gridloom.llm.texts import KEPT_WORDS, Remembered

BEGINNINGS = (4, 5, 6)  # letters of a longer word that are features of their own
ABSENT = 0xFFFFFFFF
SAMPLE_PER_CLASS = 4_000  # labelled documents of each class a model is fitted on, about
# a word that labels tokens: odds ratio, how many toxic documents have it, and the
# least share of them
SEED_RATIO, SEED_DOCS, SEED_SHARE = 15.0, 4, 0.01
CONTEXT = 6  # tokens on both sides of a labelled one that are learned with it
CLEAN_TOKENS = 40  # tokens learned from each clean document, evenly over the whole text
EPOCHS, RATE, DECAY = 10, 0.3, 1e-6
TOKENS = 1 << 16  # of whole texts whose messages are held at once
BLOCK = 64  # tokens whose transfer matrices are multiplied side by side
TOXIC_TOKEN = 0.5

_TOKEN = re.compile(r"\w+")


@dataclass
class Model:
    features: np.ndarray  # 32-bit hashes, sorted
    emission: np.ndarray  # toxic minus clean, of each feature
    transition: np.ndarray  # 2 x 2 positive potentials
    start: np.ndarray  # of the first token
    document: np.ndarray  # logistic weights: bias, strongest marginal, expected tokens


def token_words(text: str) -> list[str]:
    """Tokens as they stand: a text in lower case can have more of them."""
    return _TOKEN.findall(text)


_HASHES = f"<{1 + len(BEGINNINGS)}I"


def _hashes(word: str) -> bytes:
    """32-bit hashes of the word in lower case and, for longer words, of its
    beginnings."""
    word = word.lower()
    whole = word.encode("utf-8", "replace")
    size, digest = len(word), xxhash.xxh32_intdigest
    if len(whole) == size:  # a byte a letter
        begins = [digest(b"p" + whole[:n]) if n < size else ABSENT for n in BEGINNINGS]
    else:
        begins = [
            digest(b"p" + word[:n].encode("utf-8", "replace")) if n < size else ABSENT
            for n in BEGINNINGS
        ]
    return struct.pack(_HASHES, digest(b"w" + whole), *begins)


def _messages(emission: np.ndarray, first: np.ndarray, transition, start):
    """Forward and backward messages and token potentials of concatenated texts;
    ``first`` marks where texts begin.

    Messages are products of 2 x 2 matrices; a text's first matrix forgets what
    stands before it. Blocks of tokens are multiplied side by side, and only
    their products are passed on one by one.
    """
    n = len(emission)
    size = -(-n // BLOCK) * BLOCK
    psi = np.ones((size, 2))
    psi[:n, 1] = np.exp(np.clip(emission, -30, 30))
    m = np.broadcast_to(transition, (size, 2, 2)) * psi[:, None, :]
    m[:n][first] = (start * psi[:n][first])[:, None, :]
    m[n:] = np.eye(2)
    m /= m.sum(axis=(1, 2), keepdims=True)
    m = m.reshape(-1, BLOCK, 2, 2)

    ahead, back = np.empty_like(m), np.empty_like(m)
    run = ahead[:, 0] = m[:, 0]
    for k in range(1, BLOCK):
        run = run @ m[:, k]
        run = run / run.sum(axis=(1, 2), keepdims=True)
        ahead[:, k] = run
    run = np.broadcast_to(np.eye(2), (len(m), 2, 2))
    for k in reversed(range(BLOCK)):
        back[:, k] = run  # of the tokens after k
        run = m[:, k] @ run
        run = run / run.sum(axis=(1, 2), keepdims=True)

    enter, leave = np.empty((len(m), 2)), np.empty((len(m), 2))
    a = b = np.array([0.5, 0.5])
    for k in range(len(m)):
        enter[k] = a
        a = a @ ahead[k, -1]
        a = a / a.sum()
    for k in reversed(range(len(m))):
        leave[k] = b
        b = run[k] @ b
        b = b / b.sum()
    alpha = np.einsum("ki,ktij->ktj", enter, ahead).reshape(size, 2)[:n]
    beta = np.einsum("ktij,kj->kti", back, leave).reshape(size, 2)[:n]
    return alpha, beta, psi[:n]


def marginals(emission: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """P(toxic) of every token of concatenated texts."""
    if not len(emission):
        return np.empty(0)
    alpha, beta, _ = _messages(emission, first, model.transition, model.start)
    p = alpha * beta
    return p[:, 1] / p.sum(axis=1)


class Tagger:
    """Marginals of whole texts under a model."""

    def __init__(self, model: Model):
        self.model = model
        self.known = Remembered(self._emission, KEPT_WORDS // 4)  # looked up many at a time

    def _emission(self, word: str) -> bytes:
        return self._emissions([word])[0]

    def _emissions(self, words: list[str]) -> list[bytes]:
        own = np.frombuffer(b"".join(map(_hashes, words)), "<u4").reshape(len(words), -1)
        features = self.model.features
        at = np.minimum(np.searchsorted(features, own), len(features) - 1)
        each = np.where(features[at] == own, self.model.emission[at], np.float32(0))
        raw = each.sum(axis=1, dtype="<f4").tobytes()
        return [raw[k : k + 4] for k in range(0, len(raw), 4)]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        found, held, size = [], [], 0
        for text in texts:
            held.append(token_words(text) if text else [])
            size += len(held[-1])
            if size >= TOKENS:
                found += self._marginals(self._looked_up(held))
                held, size = [], 0
        return found + self._marginals(self._looked_up(held))

    def _looked_up(self, held: list[list[str]]) -> list[np.ndarray]:
        """Emissions of texts; words not met lately are looked up in the model together."""
        new = self.known.lacking(list(chain.from_iterable(held)))
        if new:
            self.known.learn(new, self._emissions(new))
        return [np.frombuffer(self.known.joined(words), "<f4") for words in held]

    def _marginals(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        ends = np.cumsum([len(e) for e in emissions])
        flat = np.concatenate(emissions) if emissions else np.empty(0)
        first = np.zeros(len(flat), bool)
        first[[end - len(e) for e, end in zip(emissions, ends) if len(e)]] = True
        p = marginals(flat, first, self.model)
        return [p[end - len(e) : end] for e, end in zip(emissions, ends)]


def document_inputs(p: np.ndarray) -> tuple[float, float, float]:
    """Bias, logit of the strongest marginal, log of the expected toxic tokens."""
    top = float(np.clip(p.max(initial=0.0), 1e-6, 1 - 1e-6))
    sure = p[p > 0.1].sum()
    return 1.0, float(np.log(top / (1 - top))), float(np.log1p(sure))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(texts: list[str], toxic: np.ndarray) -> Model:
    known, width = Remembered(_hashes, KEPT_WORDS // 4), 1 + len(BEGINNINGS)
    # all that is kept of a document's tokens: their hashes
    docs = [np.frombuffer(known.joined(token_words(t)), "<u4").reshape(-1, width) for t in texts]
    counted = []
    for label in (0, 1):
        own = [np.unique(h) for h, t in zip(docs, toxic) if t == label]
        counted.append(np.unique(np.concatenate(own), return_counts=True))
    (clean, n_clean), (names, n_toxic) = counted
    at = np.minimum(np.searchsorted(clean, names), len(clean) - 1)
    other = np.where(clean[at] == names, n_clean[at], 0)
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    least = max(SEED_DOCS, SEED_SHARE * n1)
    telling = (n_toxic >= least) & (n_toxic / n1 >= SEED_RATIO * (other + 0.5) / n0)
    seeds = names[telling & (names != ABSENT)]
    # copies of one document make its rare words look telling: as many different
    # pairs of neighbours are asked as documents
    around = []
    for hashes, label in zip(docs, toxic):
        if label and len(hashes):
            word = hashes[:, 0].astype(np.uint64)
            pair = np.roll(word, 1) << np.uint64(32) | np.roll(word, -1)
            row, column = np.nonzero(np.isin(hashes, seeds))
            around.append(np.stack([hashes[row, column].astype(np.uint64), pair[row]], axis=1))
    found = np.unique(np.concatenate(around), axis=0)[:, 0] if around else np.empty(0)
    at, times = np.unique(found, return_counts=True)
    seeds = at[times >= least].astype(np.uint32)

    feats, labels, first = [], [], []
    for hashes, label in zip(docs, toxic):
        marks = np.isin(hashes, seeds).any(axis=1)
        near = CONTEXT if label else 0  # words that label elsewhere are the hard ones
        keep = marks.copy()
        for at in np.flatnonzero(marks):
            keep[max(0, at - near) : at + near + 1] = True
        if not label:
            step = max(1, len(hashes) // CLEAN_TOKENS)
            for at in range(0, len(hashes), step * 8):
                keep[at : at + 8] = True
        begins = keep.copy()
        begins[1:] &= ~keep[:-1]
        feats.append(hashes[keep])
        labels.append(marks[keep].astype(np.int64) * label)
        first.append(begins[keep])
    return _learn(*(np.concatenate(x) for x in (feats, labels, first)), texts, toxic)


def _learn(feats, y, first, texts, toxic) -> Model:
    """Adagrad steps on the chain's log likelihood, on batches of whole sequences."""
    width = feats.shape[1]
    names, feats = np.unique(feats, return_inverse=True)
    feats, size = feats.reshape(-1, width), len(names)
    none = names == ABSENT
    begins = np.flatnonzero(first)
    starts = np.append(begins, len(y))
    emission, grown = np.zeros(size), np.full(size, 1e-8)
    # base, transitions, start: logs, learned alike
    small, small_grown = np.array([-2.0, 0, 0, 0, 0, 0, 0]), np.full(7, 1e-8)
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for part in np.array_split(order.permutation(len(begins)), max(1, len(begins) // 1536)):
            if not len(part):
                continue
            rows = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in part])
            f, t, head = feats[rows], y[rows], first[rows]
            trans, start = np.exp(small[1:5]).reshape(2, 2), np.exp(small[5:])
            alpha, beta, psi = _messages(emission[f].sum(axis=1) + small[0], head, trans, start)
            gamma = alpha * beta
            gamma /= gamma.sum(axis=1, keepdims=True)
            miss = gamma[:, 1] - t
            g = np.bincount(f.ravel(), np.repeat(miss, width), size)
            g += DECAY * len(rows) * emission
            g[none] = 0
            grown += g * g
            emission -= RATE * g / np.sqrt(grown)
            inner = np.flatnonzero(~head)
            pair = alpha[inner - 1][:, :, None] * trans * (psi[inner] * beta[inner])[:, None, :]
            pair = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            np.subtract.at(pair, (t[inner - 1], t[inner]), 1)
            begin = np.bincount(t[head], minlength=2)
            g = np.concatenate([[miss.sum()], pair.ravel(), gamma[head].sum(axis=0) - begin])
            small_grown += g * g
            small -= RATE * g / np.sqrt(small_grown)
    # the common part of every emission goes into the potentials of the toxic state
    into = np.exp(np.array([0.0, small[0]]))
    trans, start = np.exp(small[1:5]).reshape(2, 2) * into, np.exp(small[5:]) * into
    model = Model(names, emission.astype(np.float32), trans, start, np.zeros(3))
    tag = Tagger(model)
    x = [document_inputs(p) for k in range(0, len(texts), 256) for p in tag(texts[k : k + 256])]
    x = np.array(x).reshape(-1, 3)
    w = np.zeros(3)
    for _ in range(50):  # Newton steps of a lightly penalised logistic regression
        q = _sigmoid(x @ w)
        grad = x.T @ (q - toxic) + 0.5 * w
        w -= np.linalg.solve(x.T @ (x * (q * (1 - q))[:, None]) + 0.5 * np.eye(3), grad)
    model.document = w
    return model


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0,
    per_class: int = SAMPLE_PER_CLASS,
) -> Model | None:
    """Fit on labelled documents outside the held fold; None when a class has none.

    Of each class, about ``per_class`` documents are drawn by a hash of the id and
    fitted in one task. Null labels, ids and texts are not learned from; of
    several labels of an id the toxic one holds.
    """
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & (fold_of("doc_id", folds) != held_fold))
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg(F.max("toxic").cast("int").alias("_toxic"))
    )
    counts = {r["_toxic"]: r["count"] for r in marked.groupBy("_toxic").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64("_doc", F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("_toxic") == 1, min(1.0, per_class / counts[1])).otherwise(
        min(1.0, per_class / counts[0])
    )
    drawn = small_side(marked.where(draw < share), 8 * per_class)
    sample = docs.join(drawn, docs["doc_id"] == drawn["_doc"]).select(
        docs["doc_id"], docs["text"], "_toxic"
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["text"].notna()].sort_values(["doc_id", "text"])
        toxic = pdf["_toxic"].to_numpy().astype(int)
        if not 0 < toxic.sum() < len(toxic):
            return pd.DataFrame({k: [] for k in "fetsd"})
        m = _fit(list(pdf["text"]), toxic)
        parts = (m.features, m.emission, m.transition, m.start, m.document)
        return pd.DataFrame({k: [x.tobytes()] for k, x in zip("fetsd", parts)})

    fitted = sample.groupBy(F.lit("all").alias("_group")).applyInPandas(fit, "f binary, e binary, t binary, s binary, d binary")
    row = fitted.first()
    if row is None:
        return None
    return Model(
        np.frombuffer(row["f"], "<u4"),
        np.frombuffer(row["e"], "<f4"),
        np.frombuffer(row["t"], "<f8").reshape(2, 2),
        np.frombuffer(row["s"], "<f8"),
        np.frombuffer(row["d"], "<f8"),
    )


def tag_documents(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, score, predicted, and spans: start, end
    (characters of the text) and probability of each run of toxic tokens. Null
    and empty texts have no spans and the score of a text without toxic tokens;
    without a model every score is 0."""
    span = "struct<start:bigint,end:bigint,probability:double>"
    arrow_span = pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]
    )

    def tag(batches):
        tagger = Tagger(model) if model else None
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            scores, spans = [], []
            for text, p in zip(texts, tagger(texts) if tagger else [None] * len(texts)):
                if p is None:
                    scores.append(0.0)
                    spans.append([])
                    continue
                scores.append(float(_sigmoid(np.dot(document_inputs(p), model.document))))
                spans.append(_spans(text, p))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(spans, pa.list_(arrow_span)),
                ],
                names=[*keep, "score", "predicted", "spans"],
            )

    rows = docs.select(*keep, F.col("text").cast("string"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(giving_back(tag), f"{kinds}, score double, predicted int, spans array<{span}>")


def _spans(text: str | None, p: np.ndarray) -> list[dict]:
    toxic = p >= TOXIC_TOKEN
    if not toxic.any():
        return []
    # only now are offsets needed
    found = [m.span() for m in _TOKEN.finditer(text)]
    out: list[dict] = []
    for k in np.flatnonzero(toxic):
        if out and out[-1]["last"] == k - 1:
            out[-1] |= {"end": found[k][1], "last": k}
            out[-1]["probability"] = max(out[-1]["probability"], float(p[k]))
        else:
            a, b = found[k]
            out.append({"start": a, "end": b, "probability": float(p[k]), "last": k})
    return [{k: v for k, v in s.items() if k != "last"} for s in out]


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_spans of every row. A null doc_id is
    in no fold (held_out false). Repeated rows are scored alike."""
    held = F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    marked = docs.select("doc_id", held, "text")
    return tag_documents(marked, train(docs, labels), ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "score", "predicted", F.size("spans").cast("long").alias("n_spans")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, that are not predicted toxic."""
    model = train(docs, labels)
    keep = docs.columns
    hidden = [f"c{k}" for k in range(len(keep))]
    rows = docs.select(
        *[docs[c].alias(h) for c, h in zip(keep, hidden)], docs["text"].alias("text")
    )
    judged = tag_documents(rows, model, hidden).where("predicted = 0")
    return judged.select(*[F.col(h).alias(c) for c, h in zip(keep, hidden)])
