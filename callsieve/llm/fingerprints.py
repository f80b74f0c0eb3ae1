"""One-permutation MinHash fingerprints of whole texts, in DataFrame functions only.

Shingles of five lower-case words are hashed once. The top bits of a hash choose one of 128 bins, and the smallest hash of a bin stands for
it. To find all minima without a shuffle, one sentinel per bin (the largest hash of the bin) joins the hashes, the array is sorted, and the first
element of each bin is kept; a sentinel that comes first marks an empty bin. An empty bin copies a bin that it picks by hash functions of
its own until it meets a filled one (three tries by table, then the filled bin of lowest rank), so both texts of a pair pick alike. Of
each bin the low eight bits are kept. Two unrelated bins agree by chance once in 256; the likeness is corrected for that.

Expressions that a lambda uses more than once are bound to a variable of a one-element array, since Spark would
compute them again for each element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE

BIN_BITS, KEPT_BITS, WORDS, TRIES = 7, 8, 5, 3
BINS, SHIFT = 1 << BIN_BITS, 64 - BIN_BITS
LAST = (1 << SHIFT) - 1
BUCKETS, BUCKET_IDS = 65_536, 512


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _picks() -> list[list[int]]:
    """The bins that an empty bin tries first: a fixed multiplicative hash of (bin, try)."""
    return [[((b * TRIES + t + 1) * 0x9E3779B1 >> 13) % BINS for b in range(BINS)] for t in range(TRIES)]


def shingle_hashes(text: Column) -> Column:
    """Hashes of all five-word shingles; of the whole sequence when it is shorter; none without words."""
    trimmed = F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r"))
    words = F.transform(F.split(trimmed, f"[{SPACE}]+"), lambda w: F.xxhash64(w))

    def shingles(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(w) - (WORDS - 1)), lambda i: F.xxhash64(F.slice(w, i, WORDS)))
        return F.when(F.size(w) >= WORDS, many).otherwise(F.array(F.xxhash64(w)))

    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(bound(words, shingles))


def fingerprint(text: Column) -> Column:
    """128 bytes (as array<tinyint>) of a text; an empty array when it has no words."""
    sentinels = F.lit([((b - BINS // 2) << SHIFT) | LAST for b in range(BINS)])
    picks = [F.lit(p) for p in _picks()]

    def minima(h: Column) -> Column:
        return F.filter(h, lambda x, i: (i == 0) | (F.shiftright(x, SHIFT) != F.shiftright(F.get(h, i - 1), SHIFT)))

    def filled(m: Column) -> Column:
        own = F.transform(m, lambda x: F.when(x.bitwiseAND(F.lit(LAST)) != LAST, x))
        return bound(own, lambda o: bound(F.filter(o, lambda x: x.isNotNull()), lambda some: F.transform(
            o, lambda x, b: F.coalesce(x, *[F.get(o, F.get(p, b)) for p in picks], F.array_min(F.transform(
                some, lambda y: F.struct(F.xxhash64(b, F.shiftright(y, SHIFT)).alias("rank"), y.alias("hash"))))["hash"]))))

    def kept(f: Column) -> Column:
        return F.transform(f, lambda x: (x.bitwiseAND(F.lit((1 << KEPT_BITS) - 1)) - (1 << KEPT_BITS - 1)).cast("tinyint"))

    hashes = shingle_hashes(text)
    return bound(hashes, lambda h: F.when(F.size(h) > 0, kept(filled(
        bound(F.sort_array(F.concat(h, sentinels)), minima)))).otherwise(F.array().cast("array<tinyint>")))


def packed(print_: Column) -> Column:
    """A fingerprint as a hexadecimal string, two digits a bin."""
    return F.lower(F.array_join(F.transform(print_, lambda x: F.lpad(F.hex(x.cast("int") + (1 << KEPT_BITS - 1)), 2, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity from two fingerprints, 0 to 1; two empty ones are alike, an empty and another are not."""
    chance = 1.0 / (1 << KEPT_BITS)
    agreeing = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(BINS))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
            .otherwise(F.greatest(F.lit(0.0), (agreeing - chance) / (1 - chance))))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, print and next_text, next_print of the next row in descending doc_id (after the last: the first).

    Ids are cut into ranges of at least 512 and at most 65,537 in number. A window works inside each range; the first row of the following range
    joins it as a marked last row. Only the ranges' largest ids are broadcast, whose number is bounded.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    low, high = own.agg(F.coalesce(F.min("doc_id"), F.lit(0)), F.coalesce(F.max("doc_id"), F.lit(0))).first()
    width = max(BUCKET_IDS, (high - low) // BUCKETS + 1)
    spot = F.coalesce(F.floor((F.col("doc_id") - F.lit(low)) / width), F.lit(-1)).cast("long")  # null ids come last
    own = own.withColumn("spot", spot)
    heads = own.groupBy("spot").agg(F.max("doc_id").alias("head"))
    order = Window.orderBy(F.desc("spot"))
    nexts = heads.select(F.col("spot").alias("to"), F.coalesce(
        F.lead(F.struct("spot", "head")).over(order),
        F.first(F.struct("spot", "head")).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("from"))
    extra = (own.alias("o").join(F.broadcast(nexts), (F.col("o.spot") == F.col("from.spot")) & F.col("o.doc_id").eqNullSafe(F.col("from.head")))
             .groupBy("to").agg(F.min_by("o.text", F.xxhash64("o.text")).alias("text")))
    rows = own.select("spot", "doc_id", "text", F.lit(False).alias("extra")).unionByName(
        extra.select(F.col("to").alias("spot"), F.lit(None).cast("long").alias("doc_id"), "text", F.lit(True).alias("extra")))
    inside = Window.partitionBy("spot").orderBy("extra", F.desc("doc_id"), F.xxhash64("text"))
    return (rows.withColumn("print", fingerprint(F.col("text")))
            .withColumn("next", F.lead(F.struct("text", "print")).over(inside)).filter("not extra")
            .select("doc_id", "text", "print", F.col("next.text").alias("next_text"), F.col("next.print").alias("next_print")))


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text; other columns are ignored) and of its edited text.

    The edited text has the last third of its code points replaced by the first as many of the next document. Null
    texts count as empty; null ids come last; repeated rows are neighbours. Equal texts have equal fingerprints. An
    empty table gives an empty result.
    """
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    rows = with_next(docs).select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    rows = rows.withColumn("edited_print", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), packed(F.col("print")).alias("fingerprint"),
        packed(F.col("edited_print")).alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"))
