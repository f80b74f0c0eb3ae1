"""What each document filter removes in every order in which the filters can be applied.

A document's outcome under any order depends only on the set of filters that it fails, a mask. Documents are therefore counted by
part, mask and label first. Each such cell is then folded across all orders at once with the higher-order functions ``transform`` and
``aggregate``: the fold walks one order with the state "still there", and gives one struct of weights for each order and step. The
arrays of a part's cells, at most one per mask, are merged by elementwise sums. Documents are read once; only counts are folded.

The fifth filter, "a smaller id has the same text", looks at the whole table. Texts are compared by a 128-bit digest. All copies of a text
fail the same other filters, so copies are counted by (digest, part, labels, id) and a group of copies is never gathered.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import UPPER, small_batches, written

#: Letters of the filters; a mask has one bit for each, in this order.
FILTERS = "ABCDE"
ORDERS = ["".join(o) for o in itertools.permutations(FILTERS)]
#: Fixed values of the filters: fewest words, least percentage of distinct words, highest percentage of capitals, odd characters.
FEWEST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, ODD = 200, 50, 3, b"#$%&*|"
SLICE = 1 << 22
#: What a fold counts at each step of each order.
FIELDS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
STEPS = "array<struct<" + ",".join(f"{f}:bigint" for f in FIELDS) + ">>"


def words_of(data: bytes) -> tuple[int, int]:
    """Number of words and of distinct words, slice by slice so that a very long text is not split as a whole."""
    n, seen, at = 0, set(), 0
    while at < len(data):
        part = data[at:at + SLICE]
        at += len(part)
        if at < len(data):
            # Up to the next white space; ``split`` parts bytes at exactly the six ASCII ones.
            while at < len(data) and not data[at:at + 1].isspace():
                more = data[at:at + 4096].split(None, 1)
                step = len(more[0])
                part, at = part + data[at:at + step], at + step
        found = part.split()
        n += len(found)
        seen.update(found)
    return n, len(seen)


def text_mask(text: str) -> int:
    """The filters that look at one text only: A, B, C and D."""
    data = text.encode("utf-8", "surrogatepass")
    n, distinct = words_of(data)
    capitals = len(data) - len(data.translate(None, UPPER.encode()))
    return ((n < FEWEST_WORDS) | (100 * distinct < DISTINCT_PERCENT * n) << 1 | (100 * capitals > CAPITAL_PERCENT * len(text)) << 2
            | (len(data.translate(None, ODD)) != len(data)) << 3)


def facts(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest (16 bytes) and mask (of A to D) of every document."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for text in batch.column(2):
                text = text.as_py() or ""
                masks.append(text_mask(text))
                digests.append(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                                             names=["doc_id", "part", "digest", "mask"])

    own = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    return own.mapInArrow(look, "doc_id long, part string, digest binary, mask int")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (of all five filters), n, n_good and n_toxic: the documents of each part by the filters that they fail."""
    seen = written(facts(docs))
    judged = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("bad"))
    no = F.lit(False)
    labelled = (seen.filter("doc_id is not null").join(judged, "doc_id", "left").fillna(False, ["good", "bad"])
                .unionByName(seen.filter("doc_id is null").select("*", no.alias("good"), no.alias("bad"))))
    # Copies by id first, so that a text that many documents share is counted in many tasks; then by labels.
    by_id = labelled.groupBy("digest", "part", "mask", "good", "bad", "doc_id").agg(F.count("*").alias("n"))
    alike = by_id.groupBy("digest", "part", "mask", "good", "bad").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_no_id"))
    # One row per digest, part and labels is left: a few for each text.
    smallest = F.min("least.doc_id").over(Window.partitionBy("digest"))
    first = F.col("n_no_id") + F.when(F.col("least.doc_id") == smallest, F.col("least.n")).otherwise(0)
    split = alike.withColumn("first", first).select("part", "good", "bad", F.inline(F.array(
        F.struct("mask", F.col("first").alias("n")),
        F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - F.col("first")).alias("n")))))
    return split.filter("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("n_toxic"))


def _bit(mask: Column, letter: Column) -> Column:
    return F.get(F.array(*[mask.bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(FILTERS))]), letter)


def folded(counted: DataFrame) -> DataFrame:
    """``counted`` (see :func:`cells`) with ``steps``: one struct of weights for each order and step, all orders end to end."""
    orders = F.lit([[FILTERS.index(x) for x in o] for o in ORDERS])

    def weights(there: Column, fails: Column, letter: Column) -> Column:
        gone, of = there & fails, lambda test, n: F.when(test, F.col(n)).otherwise(0)
        alone = fails & (F.bit_count("mask") == 1)
        return F.struct(of(there & ~fails, "n").alias("kept"), of(gone, "n").alias("removed"), of(~there & fails, "n").alias("redundant"),
                        of(alone, "n").alias("unique_fails"), of(gone, "n_good").alias("good_lost"), of(gone, "n_toxic").alias("toxic_lost"))

    def walk(order: Column) -> Column:
        start = F.struct(F.lit(True).alias("there"), F.array().cast(STEPS).alias("steps"))

        def step(state: Column, letter: Column) -> Column:
            fails = _bit(F.col("mask"), letter)
            return F.struct((state["there"] & ~fails).alias("there"),
                            F.concat(state["steps"], F.array(weights(state["there"], fails, letter)).cast(STEPS)).alias("steps"))

        return F.aggregate(order, start, step, lambda state: state["steps"])

    return counted.withColumn("steps", F.flatten(F.transform(orders, walk)))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, and kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of that step, for every value
    of ``lang`` in ``docs`` (doc_id, text, lang; others are ignored), every order and every step, zeros included.

    Null texts are empty; a null ``lang`` is the part of the empty string. Repeated rows are rows of their own, and have no smaller id than
    each other; a null id is smaller than none and has no smaller one. A document has a label if any row of ``labels`` (doc_id, quality,
    toxic) gives it; null labels give none. An empty table gives an empty result.
    """
    each = folded(cells(docs, labels))
    n_steps = len(ORDERS) * len(FILTERS)
    zeros = F.array_repeat(F.array(F.struct(*[F.lit(0).cast("long").alias(f) for f in FIELDS])).cast(STEPS)[0], n_steps)
    added = lambda a, b: F.struct(*[(a[f] + b[f]).alias(f) for f in FIELDS])
    merged = each.groupBy("part").agg(F.collect_list("steps").alias("cells")).select(
        "part", F.aggregate("cells", zeros, lambda sums, cell: F.zip_with(sums, cell, added)).alias("steps"))
    letters = F.lit([FILTERS.index(x) for o in ORDERS for x in o])
    named = F.arrays_zip(letters.alias("letter"), F.col("steps"))
    # What a filter removes, summed over all orders: one number for each filter of a part.
    by_letter = F.transform(F.lit(list(range(len(FILTERS)))), lambda own: F.aggregate(
        F.filter(named, lambda x: x["letter"] == own), F.lit(0).cast("long"), lambda total, x: total + x["steps"]["removed"]))
    rows = merged.withColumn("by_letter", by_letter).select("part", "by_letter", F.posexplode("steps").alias("at", "w"))
    step = F.col("at") % len(FILTERS)
    orders, letter = F.lit(ORDERS), F.lit([FILTERS.index(x) for o in ORDERS for x in o])
    return rows.select("part", F.get(orders, (F.col("at") / len(FILTERS)).cast("int")).alias("filter_order"), (step + 1).cast("int").alias("step"),
                       *[F.col("w")[f].alias(f) for f in FIELDS], F.get(F.col("by_letter"), F.get(letter, F.col("at"))).alias("shapley"))
