"""Mixing sources to target weights, in DataFrame operations only.

Each source is one long row of words, cut into blocks of a fixed number of words. Targets in words follow from weights
and caps. A source's number of block slots follows from its target; every slot is thrown on an output shard, so the counts of the
sources in a shard are multinomial given the corpus totals, which stay exact. The slots of a source are then
numbered shard by shard, mapped through a pseudorandom permutation of the source's block numbers (again from the start
when all blocks are used), and joined to the blocks by index (:func:`slots`). The last slot of a source is cut where its target is reached.

A hot source is never one group: offsets, block ranks and slot numbers are running sums over chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.prefix import numbered, running
from .common import SPACE, n_words, pieces_of, written

BLOCK, SHARD_BLOCKS, SLOT_CHUNK, RANK_CHUNK = 64, 8192, 50_000, 1000
WEIGHTS, MOST_TIMES = (1, 2, 3), 3


def _key(source: Column) -> list[Column]:
    """A source as two columns without nulls; null sorts last."""
    return [source.isNull().alias("no_source"), F.coalesce(source.cast("string"), F.lit("")).alias("source_key")]


KEY = ["no_source", "source_key"]


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """Add target (words) to one row per source (no_source, source_key, source_size), see :func:`mixed`.

    With sources in order of their cap per weight, the first k are capped; what is left is shared by weight among the
    others. k is the smallest number at which nobody else is above the cap. The windows run over one row per source.
    """
    ordered = sizes.withColumn("place", F.row_number().over(Window.orderBy(*KEY)) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ordered = ordered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most_times)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    levels = ordered.withColumn("level", level)
    found = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(everything)
    return levels.select(*KEY, "source_size", F.least(F.col("cap").cast("double"), found["level"] * F.col("weight")).alias("target"))


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with its source as KEY, and k1 and k2, a 128-bit name of the row's id, source and text; equal rows share it."""
    facts = [F.struct(F.col(c).isNull(), c) for c in ("doc_id", "source", "text")]
    return docs.select("*", *_key(F.col("source")), F.xxhash64(*facts).alias("k1"), F.xxhash64(F.lit(1), *facts).alias("k2"))


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, size and word offset (start) within its source of every row of ``docs`` (see :func:`_named`). No text goes along."""
    rows = written(docs.select("doc_id", "k1", "k2", *KEY, n_words(F.col("text")).alias("size")))
    chunk = F.pmod("k1", F.lit(pieces_of(rows.count(), 1000, 16)))
    return written(running(rows, KEY, [F.col("k1"), F.col("k2")], chunk, sums={"start": F.col("size")}, before_row=True))


def slots(sources: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = 1) -> DataFrame:
    """The mix, slot by slot: no_source, source_key, shard (output shard), slot (of the source in the shard), block and n (words taken from its start).

    A source has as many slots as fill its target, the last of which takes only what is left; the last block of a source may be short.
    """
    size, whole = F.col("source_size"), F.col("blocks")
    counts = (sources.filter("source_size > 0").withColumn("blocks", F.ceil(size / block)).withColumn("tail", size - (whole - 1) * block)
              .withColumn("want", F.round("target").cast("long")).withColumn("over", F.col("want") % size))

    def numbers(table: DataFrame, upto: str, name: str) -> DataFrame:
        """A row for each number below ``upto``, made chunk by chunk."""
        return (table.filter(F.col(upto) > 0).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(upto) - 1) / SLOT_CHUNK))))
                .repartition(*KEY, "part")
                .withColumn(name, F.explode(F.sequence(F.col("part") * SLOT_CHUNK, F.least((F.col("part") + 1) * SLOT_CHUNK, F.col(upto)) - 1)))
                .drop("part"))

    # A permutation of each source's blocks: their ranks by a seeded hash. The exploded tables are written, since the size of rows
    # that an explode has made is unknown to the planner, which would broadcast them.
    hashed = written(numbers(counts.select(*KEY, "blocks"), "blocks", "block").withColumn("_order", F.xxhash64("block", *KEY, F.lit(seed + 1))))
    chunk = F.floor((F.col("_order") / 2.0 ** 64 + 0.5) * F.ceil(whole / RANK_CHUNK))
    ranked = written(numbered(hashed, KEY, [F.col("_order"), F.col("block")], chunk, "index").withColumn("index", F.col("index") - 1))

    # Whole rounds over the source, then as many blocks as cover the rest; behind the short block one may be needed more.
    short = ranked.filter(F.col("block") == whole - 1).select(*KEY, F.col("index").alias("short_at"))
    lacking, over = block - F.col("tail"), F.col("over")
    extra = F.when(F.ceil(over / block) <= F.col("short_at"), F.ceil(over / block)).otherwise(F.ceil((over + lacking) / block))
    extra = F.when(over == 0, 0).otherwise(extra)
    before = (extra - 1) * block - F.when(extra - 1 > F.col("short_at"), lacking).otherwise(0)
    filled = written(counts.join(short, KEY).withColumn("slots", F.floor(F.col("want") / size) * whole + extra)
                     .withColumn("last", F.when(over > 0, over - before).otherwise(F.lit(None))))
    n_shards = pieces_of(filled.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0], shard_blocks)

    # Multinomial draws: every slot falls on an output shard, which gives each source's count there.
    facts = ["blocks", "tail", "slots", "last"]
    drawn = written(numbers(filled.select(*KEY, *facts), "slots", "number")
                    .withColumn("shard", F.pmod(F.xxhash64(*KEY, "number", F.lit(seed)), F.lit(n_shards)))
                    .groupBy(*KEY, *facts, "shard").agg(F.count("*").alias("n")))
    numbered_slots = (running(drawn, KEY, [F.col("shard")], F.floor(F.col("shard") / 1000), sums={"first": F.col("n")}, before_row=True)
                      .select(*KEY, *facts, "shard", F.posexplode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot", "number"))
                      .withColumn("index", F.col("number") % whole))
    # Both sides have a row per block: not to be broadcast, however well they compress.
    joined = numbered_slots.hint("merge").join(ranked.select(*KEY, "index", "block"), [*KEY, "index"])
    own = F.when(F.col("block") == whole - 1, F.col("tail")).otherwise(block)
    return joined.select(*KEY, "shard", "slot", "block", F.when(F.col("number") == F.col("slots") - 1, F.coalesce("last", own)).otherwise(own).alias("n"),
                         own.alias("n_block"))


def block_times(drawn: DataFrame) -> DataFrame:
    """How often the mix takes each block whole (times), and how many words of it once more (part)."""
    return drawn.groupBy(*KEY, "block").agg(F.count_if(F.col("n") == F.col("n_block")).alias("times"),
                                            F.coalesce(F.max(F.when(F.col("n") < F.col("n_block"), F.col("n"))), F.lit(0)).alias("part"))


def _taken(docs: DataFrame, block: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Placed rows; sources with targets; rows by block: the words [low, high) that fall in it, how often, and the end of those taken once more."""
    rows = placed(docs)
    sources = written(targets(rows.groupBy(*KEY).agg(F.sum("size").alias("source_size"))))
    parts = (rows.filter("size > 0")
             .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
             .withColumn("low", F.greatest(F.col("block") * block - F.col("start"), F.lit(0)))
             .withColumn("high", F.least((F.col("block") + 1) * block - F.col("start"), F.col("size"))))
    parts = parts.hint("merge").join(block_times(slots(sources, block, seed=seed)), [*KEY, "block"], "left").withColumn("times", F.coalesce("times", F.lit(0)))
    end = F.least("high", F.col("block") * block + F.coalesce("part", F.lit(0)) - F.col("start"))
    return rows, sources, parts.withColumn("end", F.greatest("low", end))


def mixed(docs: DataFrame, block: int = BLOCK, seed: int = 1) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every row of ``docs`` (doc_id, text, source; others are ignored).

    Sources in code-point order, null (a source of its own) last, weigh 1, 2, 3, repeating, and share the words of the
    table. No target exceeds three times its source; what is above is shared by weight among the others. Null texts
    have no words; a source without words gets nothing. Repeated rows are rows of their own. An empty table
    gives an empty result. The taken words of a source are its target, rounded.
    """
    rows, sources, parts = _taken(_named(docs.select("doc_id", "text", "source")), block, seed)
    n = (F.col("high") - F.col("low")) * F.col("times") + F.col("end") - F.col("low")
    taken = parts.groupBy(*KEY, "doc_id", "start", "size").agg(F.sum(n).cast("long").alias("taken"))
    every = taken.select(*KEY, "doc_id", "size", "taken").unionByName(
        rows.filter("size = 0").select(*KEY, "doc_id", "size", F.lit(0).cast("long").alias("taken")))
    return every.join(sources, KEY).select("doc_id", "size", "source_size", "target", "taken")


def mixture(docs: DataFrame, block: int = BLOCK, seed: int = 1) -> DataFrame:
    """The mix itself, as documents: doc_id, text, lang, source, n_chars.

    A row holds the words of its document that are taken at least once, twice or three times, with the white space
    between them; documents of which nothing is taken do not occur. See :func:`mixed` for odd input. Texts are moved once, to meet
    the spans that are cut out of them; of equal rows one text serves all.
    """
    docs = _named(docs.select("doc_id", "text", "lang", "source"))
    _, _, parts = _taken(docs, block, seed)
    passes = (parts.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times") + 1)))
              .withColumn("upto", F.when(F.col("pass") <= F.col("times"), F.col("high")).otherwise(F.col("end"))).filter("upto > low")
              .groupBy("k1", "k2", "start", "size", "pass")
              .agg(F.sort_array(F.collect_list(F.struct("low", F.col("upto").alias("high")))).alias("spans"), F.sum(F.col("upto") - F.col("low")).alias("n_taken")))
    held = docs.select("k1", "k2", "doc_id", "text", "lang", "source").groupBy("k1", "k2").agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.min("lang").alias("lang"), F.first("source").alias("source"))
    joined = passes.join(held, ["k1", "k2"])
    split = F.array(F.regexp_extract_all("text", F.lit(f"[{SPACE}]*[^{SPACE}]+"), F.lit(0)))
    # The one-element array binds the words to a variable, so that a text is split once and not once per span.
    cut = F.transform(split, lambda words: F.flatten(F.transform(
        "spans", lambda s: F.slice(words, (s["low"] + 1).cast("int"), (s["high"] - s["low"]).cast("int")))))
    text = F.when(F.col("n_taken") == F.col("size"), F.col("text")).otherwise(F.concat_ws("", cut[0]))
    return joined.select("doc_id", text.alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("long"))
