"""Token alignment against plain comparisons of all tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from gridloom.llm import alignment
from tests.conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
A = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_VOCABULARY))
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECE_VOCABULARY))
A_BYTES = alignment.byte_tokens(public_tokenizers.path(alignment.BYTE_VOCABULARY))
B_BYTES = alignment.piece_tokens(B)


def tokens(text):
    """Both tokenizations of the whole text as (id, start, end), or None."""
    if not text:
        return None
    sides = []
    for ids, table in (
        (A.encode(" " + text, add_special_tokens=False).ids, A_BYTES),
        (B.encode(text), B_BYTES),
    ):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(table[i])))
            at += len(table[i])
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return None
        sides.append(out)
    return sides


def plain_report(rows):
    aligned = [(doc_id, tokens(text)) for doc_id, text in rows]
    links = []
    for _, sides in aligned:
        links.append(
            [(a[0], b[0]) for a in sides[0] for b in sides[1] if a[1] < b[2] and b[1] < a[2]]
            if sides
            else []
        )
    counts = Counter(pair for found in links for pair in set(found))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, sides), found in zip(aligned, links):
        digest, n_groups = "", 0
        if sides:
            cuts = {t[2] for t in sides[0]} & {t[2] for t in sides[1]}
            groups, at = [], 0
            for cut in sorted(cuts):
                groups.append(
                    "|".join(
                        ",".join(str(t[0]) for t in side if at < t[2] <= cut) for side in sides
                    )
                )
                at = cut
            n_groups = len(groups)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        n_a, n_b = (len(s) for s in sides) if sides else (0, 0)
        best = sum(counts[p] == most[p[0]] for p in found)
        out.append((doc_id, n_a, n_b, n_groups, len(found), best, sum(counts[p] for p in found), digest))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def report(frame):
    return sorted((tuple(r) for r in alignment.alignment_report(frame).select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(4)
    words = ["straße", "token", "naïve", "日本語", "emoji😀", "x", "don't", "1234567", "==", "The"]
    mixed = [
        "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", " \n\t ", "\r\n", "\t", ".", ""]) for _ in range(60))
        for _ in range(25)
    ]
    texts = [
        None, "", " ", "  ", "\n", " \n ", "x", "x ", " x", "a▁b", "▁", "a b 　 c",
        "<|endoftext|> <s> </s> <unk> <0x41>", "é ﬁ Å", "\x00\x1c!\x1f ?\x0b.", "﻿abc",
        "one two", "one two", "two  one\n", "aaaa" * 500, *mixed,
    ]
    return [(None if k == 20 else k // 2, t) for k, t in enumerate(texts)]


def test_alignment_equals_all_pairs_of_tokens(spark, odd_rows, monkeypatch):
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in odd_rows], DOCS).repartition(3)
    names = ["block", "pair_a", "docs", "a", "b", "best", "n_links"]
    frame = frame.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    want = plain_report(odd_rows)
    assert report(frame) == want
    for name in ("BATCH_CHARS", "BLOCK_TOKENS"):  # several in a task
        monkeypatch.setattr(alignment, name, 100)
    assert report(frame) == want


def test_given_documents_equal_whole_tokenization(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 1500")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert len(rows) > 50
    assert report(docs) == plain_report(rows)


def test_ranks_give_the_ids_of_the_vocabulary(spark):
    models = alignment.Tokenizers(
        *(public_tokenizers.path(v) for v in (alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY))
    )
    assert models.fast
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for text, (a, b) in zip(texts, models.ids(texts)):
        sides = tokens(text)
        assert sides is None and not len(a) or a.tolist() == [t[0] for t in sides[0]]
        assert sides is None or b.tolist() == [t[0] for t in sides[1]]


def test_ranks_and_vocabulary_agree_on_stable_characters():
    models = alignment.Tokenizers(
        *(public_tokenizers.path(v) for v in (alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY))
    )
    rng = random.Random(9)
    stable = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and models.stable[chr(c)]]
    assert "\u200b" not in stable and "日" in stable and "–" in stable
    spaces = [c for c in stable if c.isspace()]
    for _ in range(3000):
        text = "".join(rng.choice(rng.choice((stable, spaces, "ab1'"))) for _ in range(12))
        assert models.fast.encode_ordinary(text) == A.encode(text, add_special_tokens=False).ids


def test_aligned_rows_hold_the_groups(spark):
    frame = spark.createDataFrame([(1, "Hello wörld", "en", "s", 1), (2, None, "en", "s", 1)], DOCS)
    rows = {r["doc_id"]: r for r in alignment.align_tokens(frame).collect()}
    one = rows[1]
    assert sum(one["a_groups"]) == len(one["a_ids"]) and sum(one["b_groups"]) == len(one["b_ids"])
    assert len(one["a_groups"]) == len(one["b_groups"]) and sum(one["pair_links"]) == one["n_links"]
    assert rows[2]["a_ids"] == [] and rows[2]["n_links"] == 0
    assert alignment.alignment_report(spark.createDataFrame([], DOCS)).count() == 0
