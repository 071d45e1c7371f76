"""Benchmark decontamination with spaced seeds, in SQL functions only.

A mask such as ``1101011`` looks at some of the words it spans and ignores the
others, so a replaced word between two kept ones does not hide a passage. Masked
words of every position of a text and of every benchmark item are hashed; where
hashes meet, the words of both sides around the seed are compared in place, and
the passage counts when enough of them are equal.

Positions are first held against the bare keys of the seeds, eight bytes each, and
only those that meet one keep the few words around them. These are what is joined
with the seeds and shuffled; the words of a text never are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import fold, likely_among, words
from gridloom.session import materialized

MASKS = ("1111", "1101011", "110010101")
WINDOW = 15  # words compared around a seed
SHARE = 0.8  # of these must be equal
BROADCAST_KEYS = 2_000_000  # bare keys a pass holds in memory; more take more passes
BROADCAST_SEEDS = 100_000  # seeds with their words; more are joined by a shuffle
_MOST = 63  # words a window can have: matched takes 6 bits of a rank


def _hashed_words(df: DataFrame, key: str) -> DataFrame:
    """``key`` and w, the 64-bit hashes of the words. Numbers keep the generated
    code of a position small enough to be compiled."""
    named = F.transform(words(fold(F.col("text"))), lambda x: F.xxhash64(x))
    # not filtered by size: the filter would work all words out a second time
    return df.select(key, named.alias("w"))


def _seeded(df: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """One row per position and mask: ``at`` and ``key`` beside the columns of
    ``df``, whose words are ``w``. A mask longer than the words gives a key only
    for texts shorter than every mask, which are taken whole."""
    keys = []
    for m, mask in enumerate(masks):
        seen = ", ".join(f"get(w, at + {k})" for k, bit in enumerate(mask) if bit == "1")
        keys.append(f"{m}, case when at + {len(mask)} <= size(w) then xxhash64({m}, {seen}) end")
    short = min(map(len, masks))
    whole = f"case when size(w) between 1 and {short - 1} and at = 0 then xxhash64(-1, w) end"
    # a text without words has positions 0 and -1 here, and a key at neither
    rows = df.selectExpr("*", "explode(sequence(0, size(w) - 1)) as at")
    stacked = f"stack({len(masks) + 1}, {', '.join(keys)}, -1, {whole}) as (mask, key)"
    return rows.selectExpr("*", stacked).where("key is not null")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    window: int = WINDOW,
    share: float = SHARE,
) -> DataFrame:
    """doc_id, item_id, matched, compared, first_word of every document and item
    that share a passage; clean documents give no row.

    Words are runs without white space, A-Z lower-cased. Around each seed,
    ``window`` words of the item (all, if it has fewer) are laid on the text with
    the seed as near the middle as the item allows; at least ``share`` of them
    must be equal. ``matched`` of ``compared`` is the best such place and
    ``first_word`` its first word in the text (the smallest, at ties; 0 where the
    place begins before the text). Null and
    empty texts and items share nothing; an item shorter than every mask counts
    only in a text of the same words. Rows with the same doc_id are one document,
    a null doc_id as well; equal items are reported each.
    """
    if not 1 <= window <= _MOST:
        raise ValueError(f"a window has 1 to {_MOST} words")
    text = _hashed_words(docs, "doc_id")
    items = _hashed_words(benchmark, "item_id")
    # the window is cut out here, once per seed, instead of at every meeting
    seeds = materialized(
        _seeded(items.distinct(), masks)
        .withColumn("len", F.expr(f"least({window}, size(w))"))
        .withColumn("lo", F.expr("greatest(0, least(at - (len - 4) div 2, size(w) - len))"))
        .selectExpr(
            "key", "item_id", "cast(at - lo as int) as lead", "slice(w, cast(lo as int) + 1, len) as own"
        )
    )
    hits = _met(_seeded(text, masks), seeds, window)
    few = seeds.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS
    equal = " + ".join(f"if(get(there, skip + {k}) = get(own, {k}), 1, 0)" for k in range(window))
    # how much is equal in 17 bits, the start (smallest first) in 40, matched in 6
    rank = "(matched * 65536 div size(own)) << 46 | (549755813888 - start) << 6 | matched"
    best = (
        hits.join(F.broadcast(seeds) if few else seeds, "key")
        .selectExpr(
            "doc_id", "item_id", "at - lead as start", "first - lead as skip", "there", "own"
        )
        .withColumn("matched", F.expr(f"cast({equal} as bigint)"))
        .where(F.expr(f"100 * matched >= {round(share * 100)} * size(own)"))
        .selectExpr("doc_id", "item_id", f"{rank} as rank", "size(own) as compared")
        .groupBy("doc_id", "item_id")
        .agg(F.max("rank").alias("rank"), F.max_by("compared", "rank").alias("compared"))
    )
    return best.selectExpr(
        "doc_id",
        "item_id",
        "rank & 63 as matched",
        "cast(compared as bigint) as compared",
        "greatest(0, 549755813888 - (rank >> 6 & 1099511627775)) as first_word",
    )


def _met(positions: DataFrame, seeds: DataFrame, window: int) -> DataFrame:
    """doc_id, key, at, and ``there``, the words around each position whose key is
    one of a seed, the position itself being number ``first``.

    Bare keys are broadcast, at most ``BROADCAST_KEYS`` at once: a larger benchmark
    takes several passes over the texts, each for its own share of the keys.
    """
    keys = materialized(seeds.select("key").distinct())
    passes = -(-keys.count() // BROADCAST_KEYS) or 1
    found = None
    for k in range(passes):
        share, some = keys, positions
        if passes > 1:
            mine = F.expr(f"pmod(key, {passes}) = {k}")
            share, some = keys.where(mine), positions.where(mine)
        part = some.join(F.broadcast(share), "key", "left_semi").selectExpr(
            "doc_id",
            "key",
            "at",
            f"cast(least(at, {window - 1}) as int) as first",
            f"slice(w, cast(greatest(at - {window - 1}, 0) as int) + 1, {2 * window}) as there",
        )
        found = part if found is None else found.unionByName(part)
    return materialized(found)


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, whose document shares no passage."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("bad_doc_id")).distinct()
    bad = materialized(bad)
    likely = likely_among(bad, docs["doc_id"])
    # <=> keeps a null id comparable; the anti join returns columns of docs only
    same = docs["doc_id"].eqNullSafe(bad["bad_doc_id"])
    return docs.where(~likely).unionByName(docs.where(likely).join(bad, same, "left_anti"))
