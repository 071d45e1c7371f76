"""Repeated passages by recompression.

Words are named by hashes. In rounds, runs of one word and then pairs of
neighbours get new names that depend on what they name alone: a pair is formed
when its first symbol falls on the left and its second on the right side of a
global split of all names. Equal passages therefore get equal symbols inside,
whatever surrounds them; only symbols within ``MARGIN`` words of their ends can
differ. Every window of 20 words has such inner symbols, and the one of least
name, with the words every window around it must have, is its anchor. Anchors
that occur once in the corpus cannot lie in a repeat. Windows around the others
are named in full, and the first place of each name keeps its words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import likely_rows
from gridloom.llm.texts import WordHashes, mixed, windows
from gridloom.session import materialized

WINDOW = 20
ROUNDS = 2  # pair rounds: symbols of up to 2 ** ROUNDS words
MARGIN = 4  # words at either end of a passage whose symbols its surroundings can change
CONTEXT = WINDOW - 2 * MARGIN  # words that every window around an anchor has
CHUNK_WORDS = 1 << 19  # words parsed at once in a task
_RUN, _SIDE, _PAIR = (np.uint64(x) for x in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F))
_NONE = np.uint64(2**64 - 1)


def symbols(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and names of the symbols of hashed words; ``doc`` numbers the text
    that a word is in, and no symbol reaches over its end."""
    near = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    run = np.zeros(len(h), bool)
    run[1:] |= near
    run[:-1] |= near
    # words of a run keep their places, so a long run has an anchor at every word
    names, starts = np.where(run, mixed(h ^ _RUN), h), np.arange(len(h))
    for level in range(ROUNDS):
        left = mixed(names ^ _SIDE ^ np.uint64(level)) & np.uint64(1) == 1
        free = ~run[starts]
        pair = np.zeros(len(names), bool)
        pair[:-1] = left[:-1] & ~left[1:] & free[:-1] & free[1:]
        pair[:-1] &= doc[starts[1:]] == doc[starts[:-1]]
        joined = names.copy()
        at = np.flatnonzero(pair)
        joined[at] = mixed(names[at] * _PAIR + names[at + 1])
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, starts = joined[keep], starts[keep]
    return starts, names


def anchors(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows and the anchor (a word's place) of each."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.empty(0, int), np.empty(0, int)
    starts, names = symbols(h, doc)
    value = np.full(len(h), _NONE)
    value[starts] = np.minimum(mixed(names), _NONE - np.uint64(1))
    # symbols that start MARGIN words inside and end so as well
    reach = WINDOW - 2 * MARGIN - 2**ROUNDS + 1
    least, at = value[MARGIN : MARGIN + n].copy(), np.full(n, MARGIN)
    for k in range(MARGIN + 1, MARGIN + reach):
        other = value[k : k + n]
        lower = other < least
        least[lower] = other[lower]
        at[lower] = k
    p = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])
    return p, p + at[p]


def _chunks(batches, hashes):
    """(hashes, text numbers, offsets, rows) of some whole texts at a time;
    a row is the other columns of the batch."""
    held, rows, size = [], [], 0
    for batch in batches:
        text = batch.column(batch.num_columns - 1)
        others = [c.to_pylist() for c in batch.columns[:-1]]
        for k in range(batch.num_rows):
            h = hashes(text[k].as_py())
            if len(h) < WINDOW:
                continue
            held.append(h)
            rows.append([c[k] for c in others])
            size += len(h)
            if size >= CHUNK_WORDS:
                yield _chunk(held, rows)
                held, rows, size = [], [], 0
    if held:
        yield _chunk(held, rows)


def _chunk(held, rows):
    lengths = np.array([len(h) for h in held])
    return (
        np.concatenate(held),
        np.repeat(np.arange(len(held)), lengths),
        np.concatenate([[0], np.cumsum(lengths)[:-1]]),
        rows,
    )


def _first_of_equal(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a key is met first, and where it is met again or was met before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    first, several = np.ones(len(keys), bool), np.zeros(len(keys), bool)
    first[order[1:][same]] = False
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    return first, several


def _live_anchors(docs: DataFrame) -> DataFrame:
    """doc_id and pos of all anchors that occur more than once."""

    def find(batches):
        for h, doc, base, rows in _chunks(batches, WordHashes(lower=False)):
            at = np.unique(anchors(h, doc)[1])
            key = windows(h, CONTEXT)[at - MARGIN]
            ids = np.array([r[0] for r in rows])[doc[at]]
            pos = at - base[doc[at]]
            # anchors met twice here are known; one of them tells other tasks
            first, several = _first_of_equal(key)
            spread = mixed(ids.astype(np.uint64) * _PAIR + pos.astype(np.uint64))
            key = np.where(first, key, spread)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.astype(np.int64)),
                    pa.array(ids),
                    pa.array(pos.astype(np.int32)),
                    pa.array(several),
                ],
                names=["key", "doc_id", "pos", "live"],
            )

    found = docs.mapInArrow(find, "key long, doc_id long, pos int, live boolean")
    times = F.count("*").over(Window.partitionBy("key"))
    return found.withColumn("times", times).where("live or times > 1").select("doc_id", "pos")


def _repeats(texts: DataFrame) -> DataFrame:
    """doc_id, text_key, pos of all windows that start earlier as well.
    ``texts``: doc_id, text_key, live (anchors), text."""

    def name(batches):
        for h, doc, base, rows in _chunks(batches, WordHashes(lower=False)):
            p, at = anchors(h, doc)
            live = np.zeros(len(h), bool)
            for b, n, row in zip(base, np.diff(np.append(base, len(h))), rows):
                own = np.asarray(row[2])
                live[b + own[own < n]] = True
            p = p[live[at]]
            ids, keys = (np.array([r[k] for r in rows])[doc[p]] for k in (0, 1))
            pos, window = p - base[doc[p]], windows(h, WINDOW)[p]
            order = np.lexsort((pos, ids))
            p, ids, keys, pos, window = (x[order] for x in (p, ids, keys, pos, window))
            first, _ = _first_of_equal(window)
            # an equal place in a row that repeats the id is not earlier
            lead = np.flatnonzero(first)
            lead = lead[np.argsort(window[lead])]
            lead = lead[np.searchsorted(window[lead], window)]
            later = (ids != ids[lead]) | (pos != pos[lead])
            spread = mixed(ids.astype(np.uint64) * _PAIR + pos.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(later, spread, window).astype(np.int64)),
                    pa.array(ids),
                    pa.array(keys),
                    pa.array(pos.astype(np.int32)),
                    pa.array(later),
                ],
                names=["window", "doc_id", "text_key", "pos", "later"],
            )

    named = texts.mapInArrow(
        name, "window long, doc_id long, text_key long, pos int, later boolean"
    )
    place = F.struct("doc_id", "pos")
    first = F.min(F.when(~F.col("later"), place)).over(Window.partitionBy("window"))
    return (
        named.withColumn("first", first)
        .where(F.col("later") | (place > F.col("first")))
        .select("doc_id", "text_key", "pos")
    )


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _summary(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, sha of every row, and its words joined by spaces
    when nothing is removed."""

    def describe(batches):
        for batch in batches:
            n, shas = [], []
            for text in batch.column(2):
                own = _words(text.as_py())
                n.append(len(own))
                shas.append(hashlib.sha256(b" ".join(own)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(shas)],
                names=["doc_id", "text_key", "n_words", "sha"],
            )

    return docs.select("doc_id", "text_key", "text").mapInArrow(
        describe, "doc_id long, text_key long, n_words long, sha string"
    )


def _kept(texts: DataFrame) -> DataFrame:
    """doc_id, text_key, n_removed, kept_sha256, kept (text). ``texts``: doc_id,
    text_key, starts (windows to remove), text."""

    def cut(batches):
        for batch in batches:
            removed, shas, texts = [], [], []
            for starts, text in zip(batch.column(2), batch.column(3)):
                own = _words(text.as_py())
                starts = np.asarray(starts.values)
                edge = np.zeros(len(own) + 1, int)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + WINDOW, -1)
                keep = np.cumsum(edge)[:-1] == 0
                left = b" ".join([own[k] for k in np.flatnonzero(keep)])
                removed.append(int(len(own) - keep.sum()))
                shas.append(hashlib.sha256(left).hexdigest())
                texts.append(left.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                 pa.array(shas), pa.array(texts, pa.string())],
                names=["doc_id", "text_key", "n_removed", "kept_sha256", "kept"],
            )

    return texts.mapInArrow(
        cut, "doc_id long, text_key long, n_removed long, kept_sha256 string, kept string"
    )


def remove_repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is left of every text, and the summary of every row.

    Returns changed: doc_id, text_key, n_removed, kept_sha256, kept, one row for
    each document that partly repeats others; and summary: doc_id, text_key,
    n_words, sha, copy (whether a smaller doc_id has the same words). A copy of
    at least ``WINDOW`` words is removed whole and is not in changed. Texts of
    fewer words, null and empty ones lose nothing and are nobody's earlier place.
    Rows with a null doc_id neither lose words nor cost others any. Rows that
    repeat a doc_id are texts of one document: an equal start is not earlier.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    rows = materialized(_summary(docs))
    least = (
        rows.where(f"n_words >= {WINDOW} and doc_id is not null")
        .groupBy(F.col("sha").alias("_sha"))
        .agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"))
        .where("_least < _most")
    )
    summary = rows.join(least, F.col("sha") == F.col("_sha"), "left").select(
        "doc_id", "text_key", "n_words", "sha",
        F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False)).alias("copy"),
    )
    summary = materialized(summary)

    known = docs.where("doc_id is not null").select("doc_id", "text")
    live = materialized(_live_anchors(known))
    copies = summary.where("copy").select("doc_id", "text_key").distinct()
    found = live.groupBy("doc_id").agg(F.collect_list("pos").alias("live"))
    likely = likely_rows(docs, live).withColumn("text_key", F.xxhash64("text"))
    texts = materialized(
        likely.dropDuplicates(["doc_id", "text_key"])
        .join(found, "doc_id")
        .join(copies, ["doc_id", "text_key"], "left_anti")
        .select("doc_id", "text_key", "live", "text")
    )
    starts = (
        _repeats(texts).groupBy("doc_id", "text_key").agg(F.collect_list("pos").alias("starts"))
    )
    changed = _kept(
        texts.join(starts, ["doc_id", "text_key"]).select("doc_id", "text_key", "starts", "text")
    )
    return changed, summary


def repeat_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; see ``remove_repeats``."""
    changed, summary = remove_repeats(docs)
    own = changed.select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "n_removed", "kept_sha256"
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return summary.join(
        own, (F.col("doc_id") == F.col("_doc")) & F.col("text_key").eqNullSafe(F.col("_key")), "left"
    ).select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words"))
        .otherwise(F.coalesce("n_removed", F.lit(0).cast("long")))
        .alias("n_removed"),
        F.when(F.col("copy"), F.lit(nothing))
        .otherwise(F.coalesce("kept_sha256", "sha"))
        .alias("kept_sha256"),
    )
