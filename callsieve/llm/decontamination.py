"""Benchmark passages in the documents, through a positional inverted index.

The documents are read once. Every word that occurs in the benchmark is stored as a posting, its place in its document, in lists by
(block of documents, word): the index. A list is bounded by its block, so a frequent word has many lists and no large one. Words are 64-bit hashes; a
bit table of fixed size tells the scan which ones the benchmark may hold.

A window of the benchmark is looked up from its rarest words in the documents: the lists of the rarest word are moved back by its offset in the
benchmark item and intersected with the equally moved lists of the second and third rarest. What is left are alignments of an item with a
document; those are held against the lists of all other words, and runs of words that match are phrases. Where lists are widened by a slop
before they are intersected, rare words that stand nearly as in the item are found too: proximity matches.

A posting is (number of the document in its block) * 2**32 + (place of the word), so lists of a block are intersected whole by array functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written
from .shingles import slices, text_bytes, word_hashes

WINDOW, RAREST, BITS, BLOCK_BYTES, PLACES = 10, 3, 24, 8_000_000, 2 ** 32
#: Probes up to this many rows (of some 100 bytes) are sent to all executors; more are joined by shuffle.
SENT_ROWS = 50_000
#: Bytes of words: digits, letters (capitals are lower-cased) and everything beyond ASCII.
INNER = np.zeros(256, dtype=bool)
INNER[0x30:0x3A] = INNER[0x41:0x5B] = INNER[0x61:0x7B] = INNER[0x80:] = True


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts end to end, and where the words of each text begin and the last end."""
    data, offsets = text_bytes(column)
    inner = INNER[data]
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    before[1:], after[:-1] = inner[:-1], inner[1:]
    before[offsets[full]] = False
    after[offsets[full + 1] - 1] = False
    starts, ends = np.flatnonzero(inner & ~before), np.flatnonzero(inner & ~after) + 1
    return word_hashes(data, starts, ends).view(np.int64), np.searchsorted(starts, offsets)


def item_words(benchmark: DataFrame) -> DataFrame:
    """item (a number of the row), item_id, n_words, place and term of every word of ``benchmark`` (item_id, text)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, first = words_of(batch.column(2))
            n = np.diff(first)
            row = np.repeat(np.arange(len(n)), n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(n[row]), pa.array(np.arange(len(row)) - first[row]),
                 pa.array(terms)], names=["item", "item_id", "n_words", "place", "term"])

    own = benchmark.select(F.monotonically_increasing_id().alias("item"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return own.mapInArrow(split, "item long, item_id string, n_words long, place long, term long")


def _bit_table(terms: DataFrame) -> np.ndarray:
    """One bit for each possible value of the lowest bits of a term: 2 MB, whatever the benchmark."""
    low = F.col("term").bitwiseAND(F.lit((1 << BITS) - 1))
    rows = terms.groupBy((low / 32).cast("int").alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (low % 32).cast("int"))).alias("bits")).toArrow()
    table = np.zeros(1 << (BITS - 5), dtype=np.uint32)
    table[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return table


def index(docs: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lists (block, term, postings) of the words of ``docs`` that are in ``terms`` (with a few others), and block, doc,
    doc_id, n_words of every document. Both come from one written table, so that document numbers agree."""
    shipped = docs.sparkSession.sparkContext.broadcast(_bit_table(terms).tobytes())

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shipped.value, dtype=np.uint32)
        names = ["kind", "block", "term", "postings", "doc", "doc_id", "n_words"]
        for batch in batches:
            for part in slices(batch, 2, BLOCK_BYTES):
                block = part.column(0)[0].as_py()
                hashes, first = words_of(part.column(2))
                doc = np.repeat(np.arange(part.num_rows, dtype=np.int64), np.diff(first))
                low = hashes & ((1 << BITS) - 1)
                known = np.flatnonzero(table[low >> 5] >> (low & 31).astype(np.uint32) & 1)
                doc, hashes = doc[known], hashes[known]
                postings = doc * PLACES + known - first[doc]
                order = np.argsort(hashes, kind="stable")
                hashes, postings = hashes[order], postings[order]
                starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
                n = len(starts)
                none = lambda kind, n: pa.nulls(n, kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, block)), pa.array(hashes[starts]),
                     pa.ListArray.from_arrays(pa.array(np.append(starts, len(hashes)).astype(np.int32)), pa.array(postings)),
                     none(pa.int64(), n), none(pa.int64(), n), none(pa.int64(), n)], names=names)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(n, np.int32)), pa.array(np.full(n, block)), none(pa.int64(), n), none(pa.list_(pa.int64()), n),
                     pa.array(np.arange(n, dtype=np.int64)), part.column(1), pa.array(np.diff(first))], names=names)

    own = small_batches(docs).select(F.monotonically_increasing_id().alias("block"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    both = written(own.mapInArrow(post, "kind int, block long, term long, postings array<long>, doc long, doc_id long, n_words long"), parted_by="kind")
    return both.filter("kind = 0").select("block", "term", "postings"), both.filter("kind = 1").select("block", "doc", "doc_id", "n_words")


def probes(items: DataFrame, lists: DataFrame, window: int = WINDOW) -> DataFrame:
    """How windows are looked up: item, o1 to o3 and t1 to t3 (places and terms of the rarest words, rarest first), and the range of
    places (low, high) of the windows that share them. Windows with a word that no document holds are left out."""
    counts = lists.groupBy("term").agg(F.sum(F.size("postings")).alias("n"))
    width = F.least(F.col("n_words"), F.lit(window))
    begins = F.sequence(F.greatest(F.col("place") - width + 1, F.lit(0)), F.least("place", F.col("n_words") - width))
    held = (items.join(counts, "term", "left").select("item", width.alias("width"), "place", "term", F.coalesce("n", F.lit(0)).alias("n"),
                                                      F.explode(begins).alias("begin"))
            .groupBy("item", "begin").agg(F.min("width").alias("width"), F.array_sort(F.collect_list(F.struct("n", "term", "place"))).alias("words"))
            .filter("words[0].n > 0"))
    rare = [F.get("words", F.least(F.lit(i), F.size("words") - 1)) for i in range(RAREST)]
    chosen = held.select("item", "begin", "width", *[r["place"].alias(f"o{i}") for i, r in enumerate(rare, 1)], *[r["term"].alias(f"t{i}") for i, r in enumerate(rare, 1)])
    names = [f"{x}{i}" for x in "ot" for i in range(1, RAREST + 1)]
    # Windows with the same rarest words stand side by side.
    return chosen.groupBy("item", *names).agg(F.min("begin").alias("low"), (F.max("begin") + F.max("width") - 1).alias("high"))


def _moved(places: str, offset: str) -> Column:
    return F.transform(places, lambda x: x - F.col(offset))


def alignments(lists: DataFrame, asked: DataFrame, slop: int = 0) -> DataFrame:
    """block, item, low, high and, as arrays, the starts ``exact`` (of the item, in postings) at which the three rarest words stand as in the
    item, and ``near``, at which the second and third stand up to ``slop`` places off."""
    asked = written(asked)
    sent = (lambda df: F.broadcast(df)) if asked.count() <= SENT_ROWS else (lambda df: df)
    found = lists.join(sent(asked.withColumnRenamed("t1", "term")), "term").withColumn("exact", _moved("postings", "o1")).withColumn("near", F.col("exact")).drop("postings", "term")
    for i in range(2, RAREST + 1):
        own = lists.join(sent(asked.select(F.col(f"t{i}").alias("term")).distinct()), "term").withColumnRenamed("term", f"t{i}")
        found = found.join(own, ["block", f"t{i}"])
        here = _moved("postings", f"o{i}")
        found = found.withColumn("here", here).withColumn("exact", F.array_intersect("exact", "here"))
        around = F.flatten(F.transform("here", lambda x: F.sequence(x - slop, x + slop))) if slop else F.col("here")
        found = found.withColumn("near", F.array_intersect("near", around)).filter(F.size("near") > 0).drop("postings", "here", f"t{i}")
    return found.select("block", "item", "low", "high", "exact", "near")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> tuple[DataFrame, DataFrame]:
    """Facts of all documents (block, doc, doc_id, n_words), and the matches: block, doc, item_id, first, last (places of words), kind.

    A match of kind ``phrase`` is a run of the item's words that covers one window at least; one of kind ``proximity`` (with a
    ``slop``) is the place of a window whose rarest words are near, where there is no phrase of that item.
    """
    items = written(item_words(benchmark))
    lists, facts = index(docs, items.select("term"))
    found = written(alignments(lists, probes(items, lists, window), slop))
    asked = found.select("block", "item", "low", "high", F.explode("exact").alias("start")).distinct()
    # All words of the windows of an alignment, each with the posting that it needs.
    needed = written(asked.withColumn("place", F.explode(F.sequence("low", "high"))).select("block", "item", "start", "place").distinct()
                     .join(items.select("item", "place", "term"), ["item", "place"]).withColumn("posting", F.col("start") + F.col("place")))
    held = (needed.groupBy("block", "term").agg(F.collect_set("posting").alias("wanted")).join(lists, ["block", "term"])
            .select("block", "term", F.explode(F.array_intersect("wanted", "postings")).alias("posting")))
    hit = needed.join(held, ["block", "term", "posting"])
    alike = ["block", "item", "start"]
    run = F.col("place") - F.row_number().over(Window.partitionBy(*alike).orderBy("place"))
    names = items.groupBy("item").agg(F.min("item_id").alias("item_id"), F.least(F.min("n_words"), F.lit(window)).alias("width"))
    phrases = (hit.withColumn("run", run).groupBy(*alike, "run").agg(F.min("posting").alias("first"), F.max("posting").alias("last"))
               .join(names, "item").filter(F.col("last") - F.col("first") + 1 >= F.col("width"))
               .select("block", "item_id", "first", "last", F.lit("phrase").alias("kind")))
    both = phrases
    if slop:
        near = (found.select("block", "item", "low", "high", F.explode("near").alias("start")).join(names, "item")
                .select("block", "item_id", (F.col("start") + F.col("low")).alias("first"), (F.col("start") + F.col("high")).alias("last")).distinct())
        numbered = lambda df: df.withColumn("doc", F.floor(F.col("last") / PLACES))
        near = numbered(near).join(numbered(phrases).select("block", "doc", "item_id"), ["block", "doc", "item_id"], "left_anti")
        both = phrases.unionByName(near.select("block", "item_id", "first", "last", F.lit("proximity").alias("kind")))
    doc = F.floor(F.col("last") / PLACES).cast("long")
    return facts, both.select("block", doc.alias("doc"), "item_id", (F.col("first") - doc * PLACES).alias("first"), (F.col("last") - doc * PLACES).alias("last"), "kind")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and n_near of every row of ``docs`` (doc_id, text; others are ignored).

    n_hit counts the words inside any phrase of ``benchmark`` (item_id, text), items_sha256 hashes the ids of their items, n_near counts items
    that are only near. Null texts have no words, items without words no windows; rows of one item_id are one item, a null item_id is the
    empty string. Repeated rows are rows of their own, and a null doc_id stays null. Empty tables: no rows without documents, no hits without items.
    """
    facts, found = matches(docs, benchmark, window, slop)
    found = written(found)
    key = ["block", "doc"]
    phrases = found.filter("kind = 'phrase'")
    # The union of a document's phrases: each adds what lies beyond the furthest end of those before.
    earlier = Window.partitionBy(*key).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    beyond = F.greatest("first", F.coalesce(F.max("last").over(earlier) + 1, F.lit(0)))
    hits = (phrases.select(*key, "first", "last").distinct().withColumn("n", F.greatest(F.col("last") - beyond + 1, F.lit(0)))
            .groupBy(*key).agg(F.sum("n").alias("n_hit")))
    held = phrases.select(*key, "item_id").distinct().groupBy(*key).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    near = found.filter("kind = 'proximity'").select(*key, "item_id").distinct().groupBy(*key).agg(F.count("*").alias("n_near"))
    out = facts.join(hits, key, "left").join(held, key, "left").join(near, key, "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
