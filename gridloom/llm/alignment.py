"""Align the tokens of two tokenizers over the same bytes, by coalescing intervals.

A token covers an interval of the bytes of its text. All intervals of both
tokenizers are sorted by start; a group ends where the next start reaches the
running maximum of the ends, which is where a token of either side ends too.
Inside a group, every pair of overlapping tokens is a link. How many documents
hold an id pair linked is counted over the whole corpus, and tells for each link
whether its pair is the usual one of its first id.

Documents go through in blocks of bounded size. The distinct id pairs of a block
are what is shuffled and counted, and the counts come back to the block by one
join and one grouping; a pair met everywhere is one row of each block.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import materialized

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
BATCH_CHARS = 1 << 18  # characters aligned at once; a longer text is taken alone
BLOCK_TOKENS = 1 << 23  # tokens of the documents that are scored together

ALIGNED = (
    "block long, doc_id long, a_ids array<int>, b_ids array<int>, a_groups array<int>, "
    "b_groups array<int>, n_links long, pair_a array<int>, pair_b array<int>, "
    "pair_links array<int>"
)
_LISTS = ("a_ids", "b_ids", "a_groups", "b_groups", "pair_a", "pair_b", "pair_links")
_DIGEST = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pair_a array<int>, pair_b array<int>, pair_links array<int>"
)
_SCORED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)

# Characters that all versions of Unicode put into the same class.
_LATIN = re.compile("[\x00-\u024f]*")


class _Stable(dict):
    """Whether a character is a letter, a number, a space or none of them since
    Unicode 3.2, so that every splitter takes it alike."""

    def __missing__(self, char: str) -> bool:
        old = unicodedata.ucd_3_2_0.category(char)
        new = unicodedata.category(char)
        kinds = [c[0] if c[0] in "LN" else c if c == "Cn" else c[0] == "Z" for c in (old, new)]
        self[char] = kinds[0] == kinds[1] and old != "Cn"
        return self[char]


def byte_tokens(path: str) -> list[bytes]:
    """The bytes of each id of the byte-level vocabulary at ``path``. It writes a
    byte as the character of its number or, where that one cannot be seen, as the
    next character from 256 on."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    value = {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}
    vocabulary = given["model"]["vocab"]
    # special tokens never stand in a text
    size = 1 + max([*vocabulary.values(), *(t["id"] for t in given["added_tokens"])])
    out = [b""] * size
    for token, number in vocabulary.items():
        if all(c in value for c in token):
            out[number] = bytes(value[c] for c in token)
    return out


def piece_tokens(pieces) -> list[bytes]:
    """The bytes of each id of a piece vocabulary."""

    def of(number: int) -> bytes:
        piece = pieces.id_to_piece(number)
        if pieces.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("\u2581", " ").encode("utf-8", "surrogatepass")

    return [of(k) for k in range(pieces.vocab_size())]


def _ranks(path: str, tokens: list[bytes]):
    """A faster encoder with the vocabulary at ``path``, where its ranks lie beside
    it and are the same; it gives the same ids."""
    beside = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(beside):
        return None
    import tiktoken

    with open(beside, "rb") as lines:
        pairs = [line.split() for line in lines]
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    if any(tokens[rank] != token for token, rank in ranks.items()):
        return None
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


class Tokenizers:
    """Both tokenizers: ids and byte lengths. A is given a space and the text, B
    the text, before which it puts a space itself."""

    def __init__(self, byte_path: str, piece_path: str):
        from sentencepiece import SentencePieceProcessor

        self.path, self.loaded = byte_path, None
        self.b = SentencePieceProcessor(model_file=piece_path)
        self.a_bytes, self.b_bytes = byte_tokens(byte_path), piece_tokens(self.b)
        self.a_len = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_len = np.array([len(t) for t in self.b_bytes], np.int64)
        self.fast, self.stable = _ranks(byte_path, self.a_bytes), _Stable()

    @property
    def a(self):
        """The first tokenizer itself, loaded when a text needs it."""
        if self.loaded is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.loaded = Tokenizer.from_file(self.path)
            self.loaded.encode_special_tokens = True
        return self.loaded

    def _a_ids(self, text: str) -> list[int]:
        if self.fast and (_LATIN.fullmatch(text) or all(map(self.stable.__getitem__, set(text)))):
            return self.fast.encode_ordinary(" " + text)
        return self.a.encode(" " + text, add_special_tokens=False).ids

    def ids(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B for each text; none of either where the joined bytes of
        one of them are not those of a space and the text."""
        out = []
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            a = self._a_ids(text) if text else []
            raw = (" " + (text or "")).encode("utf-8", "surrogatepass")
            if any(
                b"".join(map(table.__getitem__, ids)) != raw
                for ids, table in ((a, self.a_bytes), (b, self.b_bytes))
            ):
                a, b = [], []
            out.append((np.array(a, np.int32), np.array(b, np.int32)))
        return out


def coalesce(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups and links of two tilings of the same bytes, given by lengths.

    Returns the group of each A and of each B interval, and the positions in A
    and in B of each link. Texts laid end to end stay apart by themselves.
    """
    ends = np.concatenate([np.cumsum(a_len), np.cumsum(b_len)])
    starts = ends - np.concatenate([a_len, b_len])
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    new = np.ones(len(order), bool)
    new[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    n = len(a_len)
    group_a, group_b = group[:n], group[n:]
    # the intervals of B that meet one of A follow each other
    first = np.searchsorted(ends[n:], starts[:n], "right")
    count = np.searchsorted(starts[n:], ends[:n], "left") - first
    link_a = np.repeat(np.arange(n), count)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(count) - count - first, count)
    return group_a, group_b, link_a, link_b


def _lists(values: np.ndarray, lengths) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _aligned(block: int, doc_ids: list, texts: list, models: Tokenizers) -> pa.RecordBatch:
    """Some documents, aligned in one go over their bytes laid end to end."""
    n_a = np.array([len(a) for a, _ in texts], np.int64)
    n_b = np.array([len(b) for _, b in texts], np.int64)
    a, b = (np.concatenate(side) for side in zip(*texts))
    group_a, group_b, link_a, link_b = coalesce(models.a_len[a], models.b_len[b])
    doc_of = np.repeat(np.arange(len(texts)), n_a)
    links = np.bincount(doc_of[link_a], minlength=len(texts))
    # distinct id pairs of each document and how often they are linked
    pairs = len(models.a_len) * len(models.b_len)
    keys = doc_of[link_a] * pairs + a[link_a].astype(np.int64) * len(models.b_len) + b[link_b]
    keys, often = np.unique(keys, return_counts=True)
    in_doc = np.bincount(keys // pairs, minlength=len(texts))
    keys %= pairs
    last = int(group_a[-1]) + 1 if len(a) else 0
    sizes_a, sizes_b = np.bincount(group_a, minlength=last), np.bincount(group_b, minlength=last)
    ends = np.cumsum(n_a)
    groups = np.zeros(len(texts), np.int64)  # a group lies in one document
    some = n_a > 0
    groups[some] = group_a[ends[some] - 1] - group_a[ends[some] - n_a[some]] + 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(texts), block)),
            pa.array(doc_ids, pa.int64()),
            _lists(a, n_a),
            _lists(b, n_b),
            _lists(sizes_a, groups),
            _lists(sizes_b, groups),
            pa.array(links),
            _lists(keys // len(models.b_len), in_doc),
            _lists(keys % len(models.b_len), in_doc),
            _lists(often, in_doc),
        ],
        names=[c.split()[0] for c in ALIGNED.split(", ")],
    )


def _aligner(byte_vocabulary: str, piece_vocabulary: str):
    """mapInArrow body: documents to their alignments."""
    paths = [public_tokenizers.path(v) for v in (byte_vocabulary, piece_vocabulary)]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = Tokenizers(*paths)
        block, in_block = TaskContext.get().partitionId() << 33, 0
        ids, texts, chars = [], [], 0

        def flush():
            nonlocal block, in_block
            if in_block >= BLOCK_TOKENS:
                block, in_block = block + 1, 0
            rows = _aligned(block, ids, models.ids(texts), models)
            in_block += len(rows.column(2).flatten()) + len(rows.column(3).flatten())
            return rows

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                ids.append(doc_id)
                texts.append(text)
                chars += 16 + len(text or "")
                if chars >= BATCH_CHARS:
                    yield flush()
                    ids, texts, chars = [], [], 0
        if ids:
            yield flush()

    return align


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def align_tokens(
    docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY
) -> DataFrame:
    """block, doc_id, a_ids, b_ids, a_groups, b_groups (how many tokens of either
    side each group has, in order), n_links, and pair_a, pair_b, pair_links: the
    distinct linked id pairs and how often each is linked.

    One row for each row of ``docs``, repeated ones and null ids too. Null and
    empty texts, and texts that one of the tokenizers does not give back byte by
    byte, have empty lists. A text is held whole, with its tokens, in one task;
    an empty table gives no rows; other columns are not read. ``block`` numbers
    documents that one task read one after the other.
    """
    return _texts(docs).mapInArrow(_aligner(byte_vocabulary, piece_vocabulary), ALIGNED)


def _distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct id pairs of each block and how many documents hold them."""

    def rows(block, held):
        keys, docs = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(keys), block)),
                pa.array((keys >> 32).astype(np.int32)),
                pa.array((keys & 0xFFFFFFFF).astype(np.int32)),
                pa.array(docs),
            ],
            names=["block", "a", "b", "docs"],
        )

    now, held, size = None, [], 0
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        a, b = batch.column(1), batch.column(2)
        for block in np.unique(blocks):
            at = np.flatnonzero(blocks == block)  # rows of a block follow each other
            part = slice(int(at[0]), int(at[-1]) + 1)
            keys = _flat(a[part]).astype(np.int64) << 32 | _flat(b[part])
            if held and (block != now or size + len(keys) > BLOCK_TOKENS):
                yield rows(now, held)
                held, size = [], 0
            now = block
            held.append(keys)
            size += len(keys)
    if held:
        yield rows(now, held)


def _flat(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def link_counts(aligned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For each id pair (a, b) that is linked: docs, the number of documents that
    hold it linked, and best, whether no pair of the same a has more. And the
    blocks (block, a, b) that hold each pair, once or more."""
    found = materialized(
        aligned.select("block", "pair_a", "pair_b").mapInArrow(
            _distinct_pairs, "block long, a int, b int, docs long"
        )
    )
    counts = materialized(found.groupBy("a", "b").agg(F.sum("docs").alias("docs")))
    # one row for each id of the first vocabulary
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    counts = counts.join(F.broadcast(most), "a").selectExpr("a", "b", "docs", "docs = most AS best")
    return counts, found.select("block", "a", "b")


def _group_texts(a, b, a_groups, b_groups, words):
    """All tokens of a batch as text in the order of their groups, A before B.
    ``words`` write ids of A and of B, told which are the last of their group."""
    ids_a, ids_b, in_a, in_b = (_flat(c) for c in (a, b, a_groups, b_groups))
    ends_a, ends_b = np.cumsum(in_a), np.cumsum(in_b)
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[ends_a - 1] = True
    last_b[ends_b - 1] = True
    out = np.empty(len(ids_a) + len(ids_b), object)
    # a token stands behind all tokens of the groups before its own
    out[np.arange(len(ids_a)) + np.repeat(ends_b - in_b, in_a)] = words[0](ids_a, last_a)
    out[np.arange(len(ids_b)) + np.repeat(ends_a, in_b)] = words[1](ids_b, last_b)
    return out


def _digested(batch: pa.RecordBatch, sides) -> pa.RecordBatch:
    lists = [batch.column(batch.schema.get_field_index(c)) for c in _LISTS]
    out = _group_texts(*lists[:4], sides)
    n_a, n_b, n_groups = (np.diff(c.offsets.to_numpy()) for c in lists[:3])
    ends = np.cumsum(n_a + n_b)
    digests = []
    for lo, hi in zip((ends - n_a - n_b).tolist(), ends.tolist()):
        text = b"".join(out[lo:hi].tolist())[:-1]  # no mark behind the last group
        digests.append(hashlib.sha256(text).hexdigest() if hi > lo else "")
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1)]
        + [pa.array(n.astype(np.int64)) for n in (n_a, n_b, n_groups)]
        + [batch.column(batch.schema.get_field_index("n_links")), pa.array(digests, pa.string())]
        + lists[4:],
        names=[c.split()[0] for c in _DIGEST.split(", ")],
    )


def group_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: alignments to their counts, and the SHA-256 of their groups
    written as ``a1,a2|b1;a3|b2,b3``; without tokens an empty string."""
    words: dict[str, np.ndarray] = {}

    def side(inner, end):
        def of(ids, last):
            most = int(ids.max(initial=0)) + 1
            if len(words.get(inner + end, ())) < 2 * most:  # for all ids up to that
                most = 1 << max(16, most.bit_length())
                words[inner + end] = np.array(
                    [f"{k}{s}".encode() for k in range(most) for s in (inner, end)], object
                )
            return words[inner + end][ids.astype(np.int64) * 2 + last]

        return of

    sides = side(",", "|"), side(",", ";")
    for rows in batches:
        yield _digested(rows, sides)


def _score(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Links of the documents of one block against the counts of its pairs."""
    docs, counts = docs.combine_chunks(), counts.combine_chunks()

    def keys(table, a, b):
        sides = [table.column(c).combine_chunks() for c in (a, b)]
        sides = [_flat(c) if pa.types.is_list(c.type) else c.to_numpy() for c in sides]
        return sides[0].astype(np.int64) << 32 | sides[1]

    known = keys(counts, "a", "b")
    order = np.argsort(known)
    at = order[np.searchsorted(known[order], keys(docs, "pair_a", "pair_b"))]
    often = _flat(docs.column("pair_links").combine_chunks()).astype(np.int64)
    n_docs = counts.column("docs").to_numpy()[at]
    best = counts.column("best").combine_chunks().to_numpy(zero_copy_only=False)[at]
    ends = np.cumsum(np.diff(docs.column("pair_links").combine_chunks().offsets.to_numpy()))

    def by_doc(values):
        total = np.concatenate([[0], np.cumsum(values)])
        return pa.array(np.diff(total[np.concatenate([[0], ends])]))

    out = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    out |= {"n_best": by_doc(often * best), "count_sum": by_doc(often * n_docs)}
    return pa.table(out | {"groups_sha256": docs.column("groups_sha256")})


def alignment_report(
    docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of
    every row of ``docs``; see ``align_tokens`` for odd rows, which have zeros and
    an empty digest. ``n_best`` counts links whose id pair is linked in as many
    documents as any pair of the same A id, ties included; ``count_sum`` adds up
    these numbers of documents over all links."""
    align = _aligner(byte_vocabulary, piece_vocabulary)
    # tokens themselves need not be kept: their digest is made where they are
    digested = materialized(
        _texts(docs).mapInArrow(lambda batches: group_digests(align(batches)), _DIGEST)
    )
    counts, blocks = link_counts(digested)
    here = blocks.join(counts, ["a", "b"]).select("block", "a", "b", "docs", "best")
    return digested.groupBy("block").cogroup(here.groupBy("block")).applyInArrow(_score, _SCORED)
