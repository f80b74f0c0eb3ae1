"""Shards of near-equal bytes by minimax contiguous partition.

Groups of equal texts are atomic. They are ordered by a 60-bit hash of the text, and the ordered sequence is
cut into contiguous shards whose largest size is as small as can be: a binary search over the capacity, each
value checked by filling shards greedily. The sequence itself never leaves Spark. The driver holds sums of hash
ranges (4,096 at first) and splits only ranges in which a cut may fall, 256 ways each time, until the bounds on
the capacity from "every range may be cut anywhere" and "no range may be cut" meet. Groups larger than an equal
share of what is left get a shard each, at most one per shard, since they decide their shard's size alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import numbered
from .common import pieces_of, written

KEY_BITS, FIRST_BITS, MORE_BITS = 60, 12, 8


class Ranges:
    """Sums over consecutive hash ranges; ``whole`` marks ranges that hold a single group."""

    def __init__(self, first: list[int], size: list[int], whole: list[bool], bits: list[int]):
        order = np.argsort(np.array(first, dtype=np.int64), kind="stable")
        self.first = np.array(first, dtype=np.int64)[order]
        self.size = np.array(size, dtype=np.int64)[order]
        self.whole = np.array(whole, dtype=bool)[order]
        self.bits = np.array(bits, dtype=np.int64)[order]
        self.ends = np.concatenate([[0], np.cumsum(self.size)])

    def fill(self, capacity: int, shards: int, splitting: bool) -> list[int] | None:
        """Furthest cut positions (in size units) of greedy filling, or None when the shards do not suffice."""
        at, cuts, total = 0, [], int(self.ends[-1])
        for _ in range(shards):
            to = min(at + capacity, total)
            i = int(np.searchsorted(self.ends, to, side="right")) - 1
            if to > self.ends[i] and (not splitting or self.whole[i]):
                to = int(self.ends[i])
            if to <= at < total:
                return None
            at = to
            cuts.append(at)
        return cuts if at == total else None

    def smallest(self, shards: int, splitting: bool) -> int:
        total = int(self.ends[-1])
        low, high = -(-total // shards), total
        while low < high:
            middle = (low + high) // 2
            if self.fill(middle, shards, splitting) is None:
                low = middle + 1
            else:
                high = middle
        return low

    def balanced_cuts(self, capacity: int, shards: int) -> list[int]:
        """Range numbers at which shards 1, 2, ... begin: within the capacity, each as near to even as it can be."""
        total, n = int(self.ends[-1]), len(self.size)
        latest_start = [n]  # from behind: the earliest cut from which the rest still fits
        for _ in range(shards - 1):
            latest_start.append(int(np.searchsorted(self.ends, self.ends[latest_start[-1]] - capacity, side="left")))
        earliest, cuts, at = latest_start[::-1], [], 0
        for j in range(1, shards):
            furthest = int(np.searchsorted(self.ends, self.ends[at] + capacity, side="right")) - 1
            ideal = self.ends[at] + (total - self.ends[at]) / (shards - j + 1)
            near = int(np.searchsorted(self.ends, ideal, side="left"))
            if near > at + 1 and ideal - self.ends[near - 1] <= self.ends[min(near, n)] - ideal:
                near -= 1
            at = min(max(near, earliest[j - 1], at), furthest)
            cuts.append(at)
        return cuts


def _ranges(keyed: DataFrame, bits: int) -> list[tuple[int, int, bool, int]]:
    shift = KEY_BITS - bits
    found = (keyed.groupBy(F.shiftright("key", shift).alias("at"))
             .agg(F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high")).collect())
    return [(r["low"] if r["low"] == r["high"] else r["at"] << shift, r["size"], r["low"] == r["high"], bits) for r in found]


def cut_keys(keyed: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Smallest feasible capacity of the (key, size) rows, and the keys at which shards 1, 2, ... begin."""
    held = _ranges(keyed, FIRST_BITS)
    if not held:
        return 0, [2 ** KEY_BITS] * (shards - 1)
    while True:
        r = Ranges(*map(list, zip(*held)))
        low, high = r.smallest(shards, True), r.smallest(shards, False)
        if low == high:
            break
        open_ranges: set[int] = set()
        for a, b in zip(r.fill(low, shards, True), r.fill(high, shards, False)):
            i, j = np.searchsorted(r.ends, [min(a, b), max(a, b)], side="right") - 1
            open_ranges |= {k for k in range(int(i), min(int(j) + 1, len(r.size))) if not r.whole[k]}
        split = {}
        for k in open_ranges:
            split.setdefault(int(r.bits[k]), []).append(int(r.first[k]) >> (KEY_BITS - int(r.bits[k])))
        held = [(int(r.first[k]), int(r.size[k]), bool(r.whole[k]), int(r.bits[k])) for k in range(len(r.size)) if k not in open_ranges]
        for bits, parts in split.items():
            inside = keyed.filter(F.shiftright("key", KEY_BITS - bits).isin(parts))
            held += _ranges(inside, min(KEY_BITS, bits + MORE_BITS))
    starts = r.balanced_cuts(high, shards)
    return high, [int(r.first[k]) if k < len(r.size) else 2 ** KEY_BITS for k in starts]


def shards(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs`` (doc_id, text; other columns are ignored).

    Null texts count as empty and share a group with them. Repeated rows are rows of their own in one shard. Slots are
    gapless from 0 within a shard. An empty table gives an empty result. Null ids are kept.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = written(docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long").alias("key")))
    n, total = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    largest = (keyed.groupBy("key").agg(F.sum("size").alias("size"))
               .orderBy(F.desc("size"), "key").limit(n_shards - 1).collect())
    alone: list[int] = []
    for r in largest:  # largest first; each that is above an even share of the rest stands alone
        if r["size"] * (n_shards - len(alone)) <= total or len(alone) == n_shards - 1:
            break
        alone.append(r["key"])
        total -= r["size"]
    rest = keyed.filter(~F.col("key").isin(alone)) if alone else keyed
    _, cuts = cut_keys(rest, n_shards - len(alone))
    shard: Column = F.lit(len(alone))
    for key in cuts:
        shard = shard + (F.col("key") >= key).cast("int")
    for i, key in enumerate(alone):
        shard = F.when(F.col("key") == key, i).otherwise(shard)
    placed = keyed.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"))
    chunk = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(pieces_of(n, 1000 * n_shards, 32)))
    return (numbered(placed, ["shard"], [F.col("doc_id"), F.col("text_crc32")], chunk, "slot")
            .withColumn("slot", F.col("slot") - 1))
