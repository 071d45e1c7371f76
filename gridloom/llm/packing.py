"""Packing token sequences with minimum bin slack.

Documents are cut into full windows and one rest. Rests wait in a pool, counted
by length. For each window a subset-sum program over a bitset finds the multiset
of waiting lengths that comes closest to the capacity; walking its steps back
gives how many rests of each length to take, and the same multiset is used as
often as the counts allow. Whatever slack is left is filled by cutting one more
rest, and the end of a task's pool goes to sequences of powers of two, so no
sequence needs padding.

A task packs what it reads: nothing is shuffled, and a task holds one pool of
bounded size whatever its input.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import giving_back
from gridloom.llm.texts import KEPT_WORDS, Remembered, blocks, space_words

CAPACITY = 4096
POOL_TOKENS = 1 << 21  # waiting tokens at which a task packs
POOL_LEFT = 1 << 17  # and where it stops, so later windows still have a choice
END_ID = 2
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in SCHEMA.split(", ")])


def best_fill(counts: dict[int, int], target: int) -> dict[int, int]:
    """How many of each length to take so that their sum is the largest one not
    above ``target``. ``counts``: how many of each length there are."""
    mask = (1 << (target + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n in counts if n <= target), reverse=True):
        left, part = min(counts[length], target // length), 1
        while left > 0:  # any count up to the number there is, from parts 1, 2, 4, ...
            take = min(part, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, part = left - take, part * 2
            if reach >> target:
                break
        if reach >> target:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


class Packer:
    """Sequences of one task. ``add`` takes documents; ``rows`` hands out pieces."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY):
        self.capacity, self.sequence = capacity, first_sequence
        self.pool: dict[int, list] = {}
        self.waiting = 0
        self.out: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while total - start >= self.capacity:
            self._emit([(doc_id, total, start, ids[start : start + self.capacity])])
            start += self.capacity
        if start < total:
            self._wait((doc_id, total, start, ids[start:].copy()))
        if self.waiting >= POOL_TOKENS:
            self.pack(POOL_LEFT)

    def pack(self, leave: int = 0) -> None:
        """Pack until at most ``leave`` tokens wait."""
        while self.waiting > leave:
            if self.waiting < self.capacity:
                self._end()
                return
            # the longest rest opens the window, so that long ones do not pile up
            longest = max(self.pool)
            counts = {n: len(p) for n, p in self.pool.items()}
            counts[longest] -= 1
            fill = best_fill(counts, self.capacity - longest)
            fill[longest] = fill.get(longest, 0) + 1
            slack = self.capacity - sum(n * k for n, k in fill.items())
            again = min(len(self.pool[n]) // k for n, k in fill.items())
            for _ in range(1 if slack else again):
                pieces = [self._take(n) for n, k in fill.items() for _ in range(k)]
                if slack:
                    pieces.append(self._cut(self._take(min(self.pool)), slack))
                self._emit(pieces)

    def _end(self) -> None:
        """Fewer tokens than a window: sequences of powers of two, largest first."""
        left = [self._take(n) for n in sorted(self.pool, reverse=True) for _ in self.pool[n][:]]
        size = sum(len(p[3]) for p in left)
        for bit in reversed(range(size.bit_length())):
            room, pieces = size & (1 << bit), []
            while room:
                piece = left.pop()
                if len(piece[3]) > room:
                    doc_id, total, start, ids = piece
                    left.append((doc_id, total, start + room, ids[room:]))
                    piece = (doc_id, total, start, ids[:room])
                room -= len(piece[3])
                pieces.append(piece)
            if pieces:
                self._emit(pieces)

    def _wait(self, piece: tuple) -> None:
        self.pool.setdefault(len(piece[3]), []).append(piece)
        self.waiting += len(piece[3])

    def _take(self, length: int) -> tuple:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
        self.waiting -= length
        return piece

    def _cut(self, piece: tuple, size: int) -> tuple:
        doc_id, total, start, ids = piece
        self._wait((doc_id, total, start + size, ids[size:]))
        return doc_id, total, start, ids[:size]

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, total, start, ids in pieces:
            crc = zlib.crc32(ids.tobytes())
            self.out.append((doc_id, start, len(ids), crc, total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def rows(self) -> pa.RecordBatch:
        columns = zip(*self.out) if self.out else [[]] * len(_ARROW)
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)
        self.out = []
        return batch


# Words of these characters are normalized by lower() alone: nothing composes.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# Fixed value: the splitter of the vocabulary, for the characters of _PLAIN.
_PARTS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]"
    "|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9 \t\n\r]+"
)
# Something else than _PLAIN and the white space that words are split at.
_ODD = re.compile("[^!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff \t\n\r]")


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as the character of its number, or,
    where that one cannot be seen, as the next character from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173)]
    return {b: 256 + k for k, b in enumerate(hidden)}


def token_encoder(path: str):
    """Text to token ids (little-endian unsigned 32 bits), equal to encoding the
    whole text: the vocabulary's splitter never joins across white space, so
    every distinct word is encoded once, and plain words part by part. Plain texts
    are split to parts at once: their words, of which there are many more, are not
    remembered."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer, letters = Tokenizer.from_file(path), _byte_letters()
    merge = tokenizer.model.tokenize

    def part_ids(part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(letters)
        return array("I", [t.id for t in merge(part)]).tobytes()

    parts = Remembered(part_ids, KEPT_WORDS // 4)

    def word_ids(word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:  # special tokens are left alone
            return parts.joined(_PARTS.findall(word.lower()))
        return array("I", tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    known = Remembered(word_ids, KEPT_WORDS // 4)  # of texts that are not plain

    def block_ids(block: str) -> bytes:
        if "<|" in block or _ODD.search(block):
            return known.joined(space_words(block))
        return parts.joined(_PARTS.findall(block.lower()))

    return lambda text: b"".join(map(block_ids, blocks(text)))


def pack_documents(
    docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A document is its token ids, then the id 2; null and empty texts are that id
    alone. Repeated rows and ids are packed as they come, null ids too. An empty
    table gives no rows. sequence_id holds the task's number in its high bits.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_encoder(public_tokenizers.path(vocabulary))
        packer = Packer(TaskContext.get().partitionId() << 33, capacity)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                packer.add(doc_id, np.frombuffer(ids, "<u4"))
            yield packer.rows()
        packer.pack()
        yield packer.rows()

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(giving_back(pack), SCHEMA)
