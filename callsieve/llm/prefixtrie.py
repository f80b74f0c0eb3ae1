"""The trie of conversation prefixes, by digests of blocks of turns.

Conversations are cut into blocks of a fixed number of turns. A block's digest is made of its turns' digests, a path's of its blocks', both as sums
of position-dependent hashes, so the digest of a prefix is a running sum and needs no loop over depth. Conversations are grouped by
(path so far, block digest) first. Where a path goes on with one block only, the nodes inside that block are read off its smallest member. Only where
several blocks follow the same path are turn boundaries refined: one member for each distinct block gives the turns, and turns are grouped by path digest.

Sums over subtrees need no walk up the tree. The smallest member of a node owns it. What a conversation owns is the tail of its path from a
certain depth on, so each number of a subtree is a sum over the node's members of a number known per conversation (:func:`trie`), and takes the same
grouping a second time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.prefix import numbered, running
from .common import small_batches, written

BLOCK, TURN_CHUNK, BLOCK_CHUNK, ID_CHUNK = 4, 256, 256, 4096
#: Fixed values of the rebuilding rule: conversations in a family, and the modulus of the number of turns taken from its first.
FAMILY, MOST_TAKEN = 100, 6
LANES = ["l0", "l1", "l2", "l3"]
PATH = ["p0", "p1", "p2", "p3"]


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of role and text, as hexadecimal digits."""
    role = F.coalesce(role, F.lit(""))
    return F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, F.coalesce(text, F.lit(""))))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), digest and n_chars of every turn of ``conversations`` (conv_id, turn, role, text; others are ignored).

    Null turns come first; turns with one number are ordered by digest. Null roles and texts are empty. Rows without a
    conversation belong to none and are left out.
    """
    own = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"))
    # A conversation of any length is numbered in chunks of turn numbers.
    ordered = numbered(own, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest")], F.floor(F.col("turn") / TURN_CHUNK), "pos")
    return ordered.select("conv_id", (F.col("pos") - 1).alias("pos"), "digest", "n_chars")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and all conv_id. ``own`` has the original :func:`turns`.

    The first h turns of a conversation are replaced by those of the first of its family, h being a hash of the id.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_TAKEN
    ids = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    sizes = ids.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    all_ids = written(ids.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(sizes, "base", "left")
                      .select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("n_taken")))
    first = own.filter(F.col("pos") < MOST_TAKEN - 1).withColumnRenamed("conv_id", "base")
    taken = all_ids.join(first, "base").filter("pos < h").select("conv_id", "pos", "digest", "n_chars")
    kept = own.join(all_ids, "conv_id").filter("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("n_taken")).alias("pos"), "digest", "n_chars")
    return taken.unionByName(kept), all_ids.select("conv_id")


def _lanes() -> list[Column]:
    """Four 32-bit numbers of a turn's digest at its position; sums of them do not overflow."""
    out = []
    for half in (0, 1):
        hashed = F.xxhash64("digest", "pos", F.lit(half))
        out += [F.shiftrightunsigned(hashed, 32), hashed.bitwiseAND(F.lit(0xFFFFFFFF))]
    return [c.cast("long").alias(n) for c, n in zip(out, LANES)]


def _nodes(blocks: DataFrame, rows: DataFrame, sums: list[str], own: list[str]) -> DataFrame:
    """Nodes below the root: depth, path, the path before (q0 to q3), smallest (a struct of the smallest conv_id and its ``own`` columns),
    n_convs, n_before (characters before the last turn), digest (of the last turn), and the sums of ``sums`` over the members."""
    distinct = blocks.groupBy("block", *PATH, *LANES, "n_turns").agg(
        F.min("conv_id").alias("conv_id"), F.min(F.struct("conv_id", *own)).alias("smallest"), F.count("*").alias("n_convs"),
        F.min("n_before").alias("n_before"), *[F.sum(s).alias(s) for s in sums])
    distinct = written(distinct.drop(*LANES))
    sole = (distinct.groupBy("block", *PATH).agg(F.count("*").alias("n_next"), F.min("conv_id").alias("conv_id"))
            .filter("n_next = 1").select("conv_id", "block", F.lit(True).alias("sole")))
    marked = distinct.join(sole, ["conv_id", "block"], "left")
    # One member of each distinct block has the turns: at most a block of rows for each.
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    stepped = marked.join(rows, ["conv_id", "block"]).select(
        "smallest", "sole", "n_convs", *sums, (F.col("pos") + 1).alias("depth"), "digest",
        *[(F.col(p) + F.sum(x).over(inside)).alias(p) for p, x in zip(PATH, LANES)],
        *[(F.col(p) + F.sum(x).over(inside) - F.col(x)).alias(f"q{i}") for i, (p, x) in enumerate(zip(PATH, LANES))],
        (F.col("n_before") + F.sum("n_chars").over(inside) - F.col("n_chars")).alias("n_before"))
    before = [f"q{i}" for i in range(len(PATH))]
    columns = ["depth", *PATH, *before, "smallest", "n_convs", "n_before", "digest", *sums]
    refined = stepped.filter("sole is null").groupBy("depth", *PATH).agg(
        *[F.min(c).alias(c) for c in (*before, "smallest", "n_before", "digest")], *[F.sum(c).alias(c) for c in ("n_convs", *sums)])
    return stepped.filter("sole").select(*columns).unionByName(refined.select(*columns))


def _ends(paths: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids that end at each node, joined by commas.

    Ids are joined in runs of a fixed width in parallel; the hash of a node then reads its few runs in order, batch by batch.
    """
    key = ["depth", *PATH]
    runs = paths.groupBy(*key, F.floor(F.col("conv_id") / ID_CHUNK).alias("run")).agg(F.array_join(
        F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def out():
            return pa.RecordBatch.from_pylist([dict(zip(key, node), ends_sha256=state.hexdigest())])

        for batch in batches:
            found = batch.to_pydict()
            for *own, ids in zip(*[found[k] for k in key], found["ids"]):
                if own == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    yield out()
                node, state = own, hashlib.sha256(ids.encode())
        if node is not None:
            yield out()

    ordered = small_batches(runs).repartition(*key).sortWithinPartitions(*key, "run").select(*key, "ids")
    return ordered.mapInArrow(hashed, ", ".join(f"{k} long" for k in key) + ", ends_sha256 string")


def trie(rows: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv_id, pos, digest, n_chars) of the conversations ``ids`` (conv_id):
    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, digest.

    saved_tokens, what a cache of all prefixes saves in the subtree: for each node its members but one times the characters
    of its last turn. The root (depth 0, null digest) has all conversations; without any there is no root and no row.

    Let total(c) be the characters of c, own(c) those of the nodes that c owns. Over the members c of a node v at depth d with smallest member s, the
    nodes of the subtree weigh sum(total(c) - before(v)) with their members, and total(s) - before(v) + sum(own(c)) - own(s) once each: s owns its path
    from above v on, every other member begins to own below v. saved_tokens is the difference; n_leaves counts the members that own a leaf.
    """
    rows = written(rows.select("conv_id", "pos", F.floor(F.col("pos") / block).alias("block"), "digest", "n_chars", *_lanes()))
    cut = rows.groupBy("conv_id", "block").agg(*[F.sum(x).alias(x) for x in LANES], F.count("*").alias("n_turns"), F.sum("n_chars").alias("n_chars"))
    blocks = written(running(cut, ["conv_id"], [F.col("block")], F.floor(F.col("block") / BLOCK_CHUNK), before_row=True,
                             sums={**{p: F.col(x) for p, x in zip(PATH, LANES)}, "n_before": F.col("n_chars")}))
    whole = blocks.groupBy("conv_id").agg(F.sum("n_turns").alias("depth"), *[F.sum(x).alias(p) for p, x in zip(PATH, LANES)], F.sum("n_chars").alias("total"))
    paths = written(ids.join(whole, "conv_id", "left").fillna(0))

    zero = F.lit(0).cast("long")
    root = paths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), *[zero.alias(p) for p in PATH], "conv_id", "n_convs", zero.alias("n_before"), F.lit(None).cast("string").alias("digest"),
        *[F.lit(None).cast("long").alias(f"q{i}") for i in range(len(PATH))])
    below_root = _nodes(blocks, rows, [], []).withColumn("conv_id", F.col("smallest.conv_id")).drop("smallest")
    nodes = written(below_root.unionByName(root))

    # Where each conversation begins to own its path, where that ends, and what hangs on a path that its smallest member does not own.
    key, begin = ["depth", *PATH], ["depth", *[f"q{i}" for i in range(len(PATH))], "n_before"]
    owned = written(nodes.groupBy("conv_id").agg(F.min(F.struct(*begin)).alias("h"), F.max(F.struct(*key)).alias("last")))
    heads = owned.filter("h.depth > 0").select("conv_id", (F.col("h.depth") - 1).alias("depth"), *[F.col(f"h.q{i}").alias(p) for i, p in enumerate(PATH)])
    branches = heads.groupBy(*key).agg(F.count("*").alias("n_branches"))
    parents = heads.join(nodes.select(*key, F.col("conv_id").alias("parent")), key).select("conv_id", "parent")
    lengths = paths.select("conv_id", F.col("depth").alias("length"), "total")
    childless = (owned.select("conv_id", "last.*").join(lengths, "conv_id").filter("depth = length").join(branches, key, "left_anti")
                 .select("conv_id", F.lit(1).cast("long").alias("leaf")))
    owners = owned.select("conv_id", F.col("h.depth").alias("from_depth"), F.col("h.n_before").alias("n_before")).join(
        parents, "conv_id", "left").join(childless, "conv_id", "left")
    facts = written(lengths.join(owners, "conv_id", "left").select(
        "conv_id", "length", "total", "from_depth", "parent", F.coalesce(F.col("total") - F.col("n_before"), zero).alias("own"), F.coalesce("leaf", zero).alias("leaf")))

    sums, known = ["total", "own", "leaf"], ["length", "from_depth", "parent", "total", "own"]
    below = _nodes(blocks.join(facts, "conv_id"), rows, sums, known)
    top = facts.agg(F.min(F.struct("conv_id", *known)).alias("smallest"), F.count("*").alias("n_convs"), *[F.sum(s).alias(s) for s in sums]).filter(
        "n_convs > 0").select("*", zero.alias("depth"), *[zero.alias(p) for p in PATH], zero.alias("n_before"), F.lit(None).cast("string").alias("digest"))
    summed = below.drop(*[f"q{i}" for i in range(len(PATH))]).unionByName(top)
    ends = _ends(paths.select("conv_id", *key))
    out, s = summed.join(branches, key, "left").join(ends, key, "left"), F.col("smallest")
    return out.select(
        s["conv_id"].alias("conv_id"), "depth", F.when(F.col("depth") > s["from_depth"], s["conv_id"]).otherwise(s["parent"]).alias("parent_conv_id"), "n_convs",
        ((F.col("depth") < s["length"]).cast("long") + F.coalesce("n_branches", zero)).alias("n_children"), F.col("leaf").alias("n_leaves"),
        (F.col("total") - F.col("n_convs") * F.col("n_before") - (s["total"] - F.col("n_before") + F.col("own") - s["own"])).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "digest")


def last_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with the role and text of each node's last turn (null for the root)."""
    held = conversations.select(turn_digest(F.col("role"), F.col("text")).alias("digest"), "role", "text")
    return nodes.join(held.groupBy("digest").agg(F.min(F.coalesce("role", F.lit(""))).alias("role"), F.min(F.coalesce("text", F.lit(""))).alias("text")), "digest", "left")


def family_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The :func:`trie` of the :func:`rebuilt` conversations. See :func:`turns` for odd input; an empty table gives an empty result."""
    rows, ids = rebuilt(written(turns(conversations)))
    return trie(rows, ids, block)
