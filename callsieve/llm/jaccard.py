"""Exact Jaccard join of shingle sets by PartEnum signatures.

Two sets whose similarity reaches the threshold differ in a bounded number k of elements, given their sizes. Sizes fall
into bands so narrow that linked sets lie in one band or in neighbours; each pair of neighbouring bands is an instance with a
k of its own, and a set takes part in two. An instance parts the hash domain into n > k partitions. k differing elements
touch k partitions at most, so linked sets agree on at least n - k of them; the content of a partition is a signature (for small k, the
content of every subset of n - k partitions). Sets that share no signature are not linked, whatever else they share.

An empty partition says nothing. n is chosen so that nearly every set has fewer than n - k empty ones; then some agreeing partition is not
empty, and empty ones are left out. The few other sets send them too.

A signature that more than ``CROWD`` sets share is crowded, and its sets are not paired. A set with fewer crowded signatures than it is sure to agree on finds all
its partners by the others. The rest (large groups of near copies, mostly) take part in as many of their crowded signatures as two sets that agree on crowded
ones alone need to have one of those in common; those of the widest leads come first, so that a set has few leads. All that is missing is what joins components: each set is compared with the
least changed member of each such signature. Two sets of a group that are still in different components can only be linked if their
differences from that member overlap, which a prefix filter over rare elements finds (:func:`_by_differences`).

Equal sets are one node from the start, named by a 64-bit digest. Signatures travel as packed arrays, one per task and bucket, and
are combined before the shuffle. Pairs that agree on fewer signatures than they must are dropped
by count. Sets are never written or moved: they are computed again where the texts of a candidate pair meet, and every such pair is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytehash import mix
from .common import pieces_of, small_batches, written
from .shingles import shingle_sets, slices

#: Linked: 100 * intersection >= PERCENT * union.
PERCENT, CROWD, SMALL_K = 80, 8, 3
BUCKET_SIGNATURES, FLUSH_SHINGLES, CENTRE_ROWS, FILTER_BITS = 1_600_000, 500_000, 300, 1 << 23
#: Differences of a lead that tell which elements are common, and so the order in which elements are taken.
ORDER_SPOKES = 64
NODE, PAIR, OTHER, INCIDENCE, KEY = 0, 1, 2, 3, 4
FOUND = "kind int, x long, y long, z long, w int"
BLOB = "bucket long, kind int, held binary"


class Bands:
    """Size bands and, per instance, k and the number of partitions."""

    def __init__(self, percent: int, largest: int):
        self.percent, self.ends = percent, [0]
        while self.ends[-1] < largest:
            self.ends.append((self.ends[-1] + 1) * 100 // percent)
        # Instance i covers bands i - 1 and i (sizes from ends[i - 2] + 1 to ends[i]).
        self.k, self.n = [0, 0], [1, 1]
        for i in range(2, len(self.ends) + 1):
            most = self.ends[i] if i < len(self.ends) else (self.ends[-1] + 1) * 100 // percent
            least, k = self.ends[i - 2] + 1, 2 * most * (100 - percent) // (100 + percent)
            self.k.append(k)
            self.n.append(k + 3 if k <= SMALL_K else self.partitions(k, least))

    @staticmethod
    def partitions(k: int, least: int) -> int:
        """Fewest partitions that leave the smallest sets of an instance few empty ones, with some deviations to spare."""
        best = (float("-inf"), k + 1)
        for n in range(k + 1, 2 * k + 8):
            none, one = (1 - 1 / n) ** least, (1 - 2 / n) ** least
            mean, variance = n * none, n * none + n * (n - 1) * one - (n * none) ** 2
            spare = (n - k - mean) / sqrt(max(variance, 1e-9))
            if spare >= 5:
                return n
            best = max(best, (spare, n))
        return best[1]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, sizes)

    def differing(self, sizes: np.ndarray, upper: bool) -> np.ndarray:
        """Most elements that sets of these sizes and their linked partners in the instance of this and the next lower (``upper``) or higher band differ in."""
        partner = sizes * 100 // self.percent
        if upper:
            partner = np.minimum(partner, np.array(self.ends)[self.of(sizes)])
        return (sizes + partner) * (100 - self.percent) // (100 + self.percent)


def digest(s: np.ndarray) -> int:
    """Name of a set, whatever its order."""
    total = np.add.reduce(mix(s ^ np.uint64(0x9E3779B97F4A7C15)), keepdims=True)
    return int(mix(total + mix(np.array([len(s)], dtype=np.uint64))).view(np.int64)[0])


def _signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signature, set number, instance and sure agreements of every signature of the (sorted, not empty) sets."""
    if not sets:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64, np.int64))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    elements = np.concatenate(sets)
    content = mix(elements + np.uint64(0x632BE59BD9B4E019))
    band, k, n = bands.of(sizes), np.array(bands.k), np.array(bands.n)
    out = []
    for upper, instance in ((True, band), (False, band + 1)):
        ks, ns = k[instance], n[instance]
        owner = np.repeat(np.arange(len(sets)), sizes)
        # Elements are sorted, so the partitions by their top bits follow one another.
        part = ((elements >> np.uint64(32)) * np.repeat(ns, sizes).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        opens = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])]))
        sums, part, owner = np.add.reduceat(content, opens), part[opens], owner[opens]
        filled = np.bincount(owner, minlength=len(sets))
        # n - k partitions agree, less the empty ones; k for partners of a set of just this size.
        sure = filled - bands.differing(sizes, upper)
        large = ks > SMALL_K
        use = large[owner]
        salt = instance.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        sig = mix(sums + part.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB) + salt[owner])
        odd = np.flatnonzero(large & (sure <= 0))
        agreed = np.maximum(sure, 1)
        out.append((sig[use], owner[use], instance[owner[use]], agreed[owner[use]]))
        more: tuple[list, list, list] = ([], [], [])
        begins = np.searchsorted(owner, np.arange(len(sets) + 1))
        for i in odd.tolist():  # sets with many empty partitions send those, too
            empty = np.setdiff1d(np.arange(ns[i]), part[begins[i]:begins[i + 1]]).astype(np.uint64)
            more[0].append(mix(empty * np.uint64(0xE7037ED1A0B428DB) + salt[i]))
            more[1].append(np.full(len(empty), i))
        for i in np.flatnonzero((ks > 0) & ~large).tolist():
            each = np.zeros(ns[i], dtype=np.uint64)
            each[part[begins[i]:begins[i + 1]]] = mix(sums[begins[i]:begins[i + 1]])
            chosen = np.array(list(combinations(range(ns[i]), int(ns[i] - ks[i]))))
            weights = mix(np.arange(1, ns[i] + 1, dtype=np.uint64))
            more[0].append(mix(np.add.reduce(each[chosen] * weights[chosen] + weights[chosen], axis=1) + salt[i]))
            more[1].append(np.full(len(chosen), i))
        if more[0]:
            sig, owner = np.concatenate(more[0]), np.concatenate(more[1])
            out.append((sig, owner, instance[owner], np.ones(len(owner), dtype=np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _planes(x: np.ndarray, kind: str) -> bytes:
    """Integers by bytes: all lowest ones first. The high ones are mostly zero, and runs of zeros compress to nothing in a shuffle."""
    x = np.ascontiguousarray(x.astype(kind))
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _pack(sig: np.ndarray, unit: np.ndarray, node: np.ndarray, band: np.ndarray, sure: np.ndarray) -> bytes:
    """Signatures (low 32 bits) in order of their units. A set has two, one per instance, and is named once for both.

    ``node`` and ``band`` are those of the sets, ``sure`` has a row per set and a column per instance.
    """
    used, at = np.unique(unit // 2, return_inverse=True)
    counts = np.bincount(2 * at + unit % 2, minlength=2 * len(used))
    return np.array([len(used), len(sig)], dtype="<i8").tobytes() + b"".join((
        node[used].astype("<i8").tobytes(), _planes(counts, "<i4"), _planes(np.minimum(sure[used], 32000).ravel(), "<i2"),
        band[used].astype("<u1").tobytes(), (sig & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()))


def _unpack(held: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signature, node, instance and sure agreements of every signature of :func:`_pack`."""
    sets, n = (int(x) for x in np.frombuffer(held, "<i8", 2))
    at = 16

    def taken(kind: str, many: int, planes: bool = False) -> np.ndarray:
        nonlocal at
        width = np.dtype(kind).itemsize
        raw, at = np.frombuffer(held, np.uint8, many * width, at), at + many * width
        return (np.ascontiguousarray(raw.reshape(width, many).T) if planes else raw.copy()).reshape(-1).view(kind)

    node, counts, sure = taken("<i8", sets), taken("<i4", 2 * sets, True), taken("<i2", 2 * sets, True)
    inst = (taken("<u1", sets)[:, None] + np.array([0, 1], dtype=np.uint8)).ravel()
    return taken("<u4", n), np.repeat(np.repeat(node, 2), counts), np.repeat(inst, counts), np.repeat(sure, counts)


def _emit(n_buckets: int, bands: Bands):
    """Function for mapInArrow over (doc_id, text, key): packed signatures by bucket, packed (doc_id, size, node), and (key, node) of one row per node."""

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(sets: list[np.ndarray], names: list[int], docs: list[tuple], keys: list[int]) -> pa.RecordBatch:
            rows = []
            if keys:
                rows.append((docs[0][2] % n_buckets, KEY, np.array([keys, names], dtype="<i8").tobytes()))
            has_id = np.array([d is not None for d, _, _ in docs], dtype=bool)
            table = np.array([(d or 0, n, x) for d, n, x in docs], dtype="<i8").reshape(-1, 3)
            for known in (True, False):
                if (has_id == known).any():
                    rows.append((docs[0][2] % n_buckets, NODE, bytes([known]) + table[has_id == known].tobytes()))
            sig, owner, inst, sure = _signatures(sets, bands)
            node = np.array(names, dtype=np.int64)
            band = bands.of(np.array([len(s) for s in sets], dtype=np.int64))
            unit = owner * 2 + (inst != band[owner])
            agreed = np.zeros(2 * len(sets), dtype=np.int64)
            agreed[unit] = sure
            agreed = agreed.reshape(-1, 2)
            bucket = ((sig >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
            order = np.lexsort((unit, bucket))
            sig, unit, bucket = sig[order], unit[order], bucket[order]
            # Signatures crowded in this batch alone: enough of them go to the bucket to be seen there, the others need not.
            by_sig = np.argsort(sig, kind="stable")
            edge = np.flatnonzero(np.concatenate([[True], sig[by_sig][1:] != sig[by_sig][:-1]])) if len(sig) else np.zeros(0, np.int64)
            size = np.diff(np.concatenate([edge, [len(sig)]]))
            place = np.arange(len(sig)) - np.repeat(edge, size)
            extra = np.zeros(len(sig), dtype=bool)
            extra[by_sig[place > CROWD]] = True
            for kind, own in ((PAIR, ~extra), (INCIDENCE, extra)):
                s, u, b = sig[own], unit[own], bucket[own]
                cut = np.searchsorted(b, np.arange(n_buckets + 1))
                for i in np.unique(b).tolist():
                    part = slice(cut[i], cut[i + 1])
                    # Members beyond the first are dealt to any bucket: they pass through.
                    to = i if kind == PAIR else (i + docs[0][2]) % n_buckets
                    rows.append((to, kind, np.array([i], dtype="<i8").tobytes() + _pack(s[part], u[part], node, band, agreed)))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                               pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "held"])

        sets, names, docs, keys, seen, held = [], [], [], [], set(), 0
        for batch in batches:
            for part in slices(batch, 1):
                for doc, key, s in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), shingle_sets(part.column(1))):
                    node = digest(s) if len(s) else 0
                    docs.append((doc, len(s), node))
                    if len(s) and node not in seen:
                        seen.add(node)
                        sets.append(s)
                        names.append(node)
                        keys.append(key)
                        held += len(s)
                if held > FLUSH_SHINGLES or len(docs) > 100_000:
                    yield out(sets, names, docs, keys)
                    sets, names, docs, keys, seen, held = [], [], [], [], set(), 0
        if docs:
            yield out(sets, names, docs, keys)

    return blobs


def _counted(a: np.ndarray, inst: np.ndarray, sure_a: np.ndarray, b: np.ndarray, sure_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each pair of nodes once per instance: a, b, instance and number of signatures, and how many each is sure to agree on."""
    order = np.lexsort((inst, b, a))
    a, b, inst, sure_a, sure_b = (x[order] for x in (a, b, inst, sure_a, sure_b))
    opens = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (inst[1:] != inst[:-1])])) if len(a) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([opens, [len(a)]]))
    return (a[opens], b[opens], (inst[opens].astype(np.int64) << 32) | times, (sure_a[opens].astype(np.int64) << 16) | sure_b[opens].astype(np.int64))


def _meet(key: tuple, rows: pa.Table) -> pa.Table:
    """What a bucket finds: pairs of nodes under uncrowded signatures, members of crowded ones, and the documents that pass through."""
    found: list[tuple[int, tuple]] = []
    parts = []
    for kind, held in zip(rows.column("kind").to_pylist(), rows.column("held").to_pylist()):
        if kind == NODE:
            table = np.frombuffer(held, "<i8", offset=1).reshape(-1, 3)
            found.append((NODE, (table[:, 0], table[:, 1], table[:, 2], np.full(len(table), held[0]))))
            continue
        if kind == KEY:
            table = np.frombuffer(held, "<i8").reshape(2, -1)
            found.append((KEY, (table[0], table[1], np.zeros_like(table[0]), np.zeros_like(table[0]))))
            continue
        bucket = int(np.frombuffer(held, "<i8", 1)[0])
        sig, node, inst, sure = _unpack(held[8:])
        if kind == PAIR:
            parts.append((sig, node, inst, sure))
        else:
            found.append((INCIDENCE, ((bucket << 32) | sig.astype(np.int64), node, inst.astype(np.int64), sure)))
    if parts:
        sig, node, inst, sure = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(sig, kind="stable")
        sig = sig[order]
        same = np.zeros(len(sig), dtype=bool)
        same[1:] = sig[1:] == sig[:-1]
        same[:-1] |= same[1:].copy()
        order, sig = order[same], sig[same]
        node, inst, sure = node[order], inst[order], sure[order]
        order = np.lexsort((node, sig))
        sig, node, inst, sure = sig[order], node[order], inst[order], sure[order]
        once = np.ones(len(sig), dtype=bool)
        once[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])  # copies from several tasks
        sig, node, inst, sure = sig[once], node[once], inst[once], sure[once]
        edge = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([edge, [len(sig)]]))
        crowded = np.repeat(size > CROWD, size)
        found.append((INCIDENCE, ((key[0].as_py() << 32) | sig[crowded].astype(np.int64), node[crowded], inst[crowded].astype(np.int64), sure[crowded])))
        for n in range(2, CROWD + 1):
            members = edge[size == n][:, None] + np.arange(n)
            for i, j in combinations(range(n), 2):
                found.append((PAIR if i == 0 else OTHER, _counted(*(x[members[:, i]] for x in (node, inst, sure)), *(x[members[:, j]] for x in (node, sure)))))
    if not found:
        return pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())], names=["kind", "x", "y", "z", "w"])
    columns = [np.concatenate([f[1][c] for f in found]) for c in range(4)]
    kinds = np.repeat(np.array([f[0] for f in found], dtype=np.int32), [len(f[1][0]) for f in found])
    return pa.table([pa.array(kinds), *(pa.array(c.astype(np.int64)) for c in columns[:3]), pa.array(columns[3].astype(np.int32))],
                    names=["kind", "x", "y", "z", "w"])


def _candidates(docs: DataFrame, percent: int) -> DataFrame:
    """Documents, pairs and crowded memberships, see :func:`_meet`; one table, parted by kind."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.coalesce(F.max(F.octet_length("text")), F.lit(0))).first()
    # A text has at most half as many words as bytes; about one signature in ten bytes.
    bands = Bands(percent, size[1] // 2 + 1)
    n_buckets = pieces_of(size[0] // 10, BUCKET_SIGNATURES, 12)
    found = docs.mapInArrow(_emit(n_buckets, bands), BLOB).groupBy("bucket").applyInArrow(_meet, FOUND)
    return written(found, parted_by="kind")


def _filter_words(nodes: DataFrame) -> np.ndarray:
    """Bit array of a fixed size that marks the keys of ``nodes``; other rows may be marked, too."""
    bit = F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS))
    rows = (nodes.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 64).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits")).toPandas())
    words = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    words[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return words


def _compared(docs: DataFrame, firsts: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Whether the nodes of ``pairs`` (a, b, wanted) are linked: a, b, linked, n_a, n_b and, where wanted, the elements of one set only.

    ``firsts``: the key of a row of each node (node, key). Rows may share a key; a text that does not give the node is passed over.
    """
    pairs = written(pairs.groupBy("a", "b").agg(F.max("wanted").alias("wanted")))
    # Pairs meet at their first node; a node with many partners is dealt over several places.
    centres = pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn("places", F.ceil(F.col("n") / CENTRE_ROWS).cast("long"))
    leads = centres.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("places") - 1)).alias("place"), F.lit(0).alias("role"))
    others = pairs.join(centres, "a").select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64("b"), F.col("places")).alias("place"),
                                             F.when(F.col("wanted"), 2).otherwise(1).alias("role"))
    routes = written(leads.union(others).join(firsts, "node"))
    words = docs.sparkSession.sparkContext.broadcast(_filter_words(routes))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            yield batch.filter(pa.array((words.value[at // 64] >> (at % 64)) & 1 == 1)).select([0, 1])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, lead, last = None, np.zeros(0, np.uint64), None
        for batch in batches:
            for part in slices(batch, 3):
                out: list[tuple] = []
                for node, centre, role, own in zip(*(part.column(c).to_pylist() for c in range(3)), shingle_sets(part.column(3))):
                    if not len(own) or digest(own) != node:
                        continue
                    if role == 0:
                        name, lead = centre, own
                    elif name == centre and last != (centre, node):  # equal rows bring a text several times
                        last = (centre, node)
                        few, many = (own, lead) if len(own) < len(lead) else (lead, own)
                        at = np.minimum(np.searchsorted(many, few), len(many) - 1)
                        both = int(np.count_nonzero(many[at] == few))
                        linked = 100 * both >= percent * (len(own) + len(lead) - both)
                        apart = np.setxor1d(own, lead, assume_unique=True).view(np.int64) if role == 2 else None
                        out.append((centre, node, linked, len(lead), len(own), apart))
                columns = list(zip(*out)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                    names=["a", "b", "linked", "n_a", "n_b", "apart"])

    bit = F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS))
    held = docs.select("key", "text", bit.alias("bit")).mapInArrow(marked, "key long, text string")
    routed = held.join(routes, "key").repartition("a", "place").sortWithinPartitions("a", "place", "role", "node")
    return written(routed.select("node", "a", "role", "text").mapInArrow(
        compare, "a long, b long, linked boolean, n_a long, n_b long, apart array<bigint>"))


def _common(spokes: DataFrame) -> DataFrame:
    """Elements that many differences from one lead hold, from rare to frequent: a, common.

    They are told by about ``ORDER_SPOKES`` differences of each lead. That only sets the order in which elements are taken, and any order finds the same links.
    """
    leads = spokes.groupBy("a").agg(F.count("*").alias("n")).withColumn("each", F.ceil(F.col("n") / ORDER_SPOKES))
    some = spokes.join(leads, "a").filter(F.pmod("spoke", "each") == 0)
    held = some.select("a", (F.col("n") / F.col("each")).alias("n"), F.explode("apart").alias("e")).groupBy("a", "e").agg(F.count("*").alias("often"), F.first("n").alias("n"))
    listed = held.filter(F.col("often") >= F.greatest(F.lit(2), F.col("n") / 16)).groupBy("a").agg(F.array_sort(F.collect_list(F.struct("often", "e"))).alias("held"))
    return listed.select("a", F.col("held.e").alias("common"))


def _by_differences(spokes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets compared with one lead that may be linked though their labels differ.

    x and y differ in as many elements as their differences X and Y from the lead P do. If they are linked, these share at least
    o = (|X| + |Y| - k) / 2 elements, k being the most that x and y may differ in. With the elements of each ordered from rare to frequent, the
    first |X| - o + 1 of X and |Y| - o + 1 of Y then have one in common. o is positive unless both are linked with P. The smaller of
    the two sends no more elements than its largest prefix for any larger partner, which are mostly elements of its own. The order: elements
    that are not common (:func:`_common`) by how many differences hold them, then the common ones, of which only what a prefix reaches is needed.
    """
    share = F.lit((100 - percent) / (100 + percent))
    # Sets linked with y are at most 100 / percent times as large, so that y may differ from them in this many elements at most; their differences
    # from the lead are then smaller than Y by no more than that, and share all the rest of Y.
    most = F.floor(F.col("n_b") * ((100 - percent) / percent) + 1e-6)
    spoke = F.xxhash64("a", "b").alias("spoke")
    spokes = written(spokes.select(spoke, "a", "b", "label", "linked", "n_a", "n_b", "apart"))
    facts = spokes.select("spoke", "b", "label", "linked", "n_a", "n_b", F.size("apart").alias("d"))
    # Common elements, from rare to frequent, stand last in the order, and only those that a prefix reaches are made rows.
    common = F.coalesce("common", F.array().cast("array<bigint>"))
    ordered = (spokes.join(_common(spokes), "a", "left")
               .select("spoke", "a", "label", most.alias("most"), F.array_except("apart", common).alias("own"), F.array_intersect(common, "apart").alias("common")))
    reached = F.slice("common", F.lit(1), F.greatest(F.lit(0), F.col("most") + 1 - F.size("own")).cast("int"))
    # An element of a lead's group is one number; those that two groups share by chance only add pairs to verify.
    rows = written(ordered.select("spoke", "a", "label", F.size("own").alias("own"), F.posexplode(F.concat("own", reached)).alias("at", "_e"))
                   .select("spoke", "label", "own", "at", F.xxhash64("a", "_e").alias("e")))
    # Elements of one component's differences alone join no other: they come first among the own ones and need not be moved again.
    often = rows.groupBy("e").agg(F.count("*").alias("often"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("e", "often")
    is_own = F.col("at") < F.col("own")
    alike = Window.partitionBy("spoke", is_own)
    after = F.row_number().over(alike.orderBy("often", "e")) - 1
    placed = (rows.drop("label").join(often, "e")
              .select("spoke", "e", F.when(is_own, F.col("own") - F.count("*").over(alike) + after).otherwise(F.col("at")).cast("int").alias("place"))
              .join(facts, "spoke"))
    # Least size of a larger partner's difference: its own, and if it is linked with P, what keeps the partner from being linked.
    least = F.greatest(F.col("d"), F.when(F.col("linked"), F.floor(F.col("n_a") * (2 * share / (1 + share))) + 1).otherwise(0))
    overlap = F.greatest(F.lit(1), F.ceil((least * (1 - share) - (F.col("n_a") + F.col("n_b")) * share + F.col("d")) / 2 - 1e-6))
    columns = ["b", "label", "n_b", "d", "place"]
    large = written(placed.filter(F.col("place") <= F.least(F.col("d") - 1, most))
                    .select("e", *columns, (F.col("place") <= F.col("d") - overlap).alias("sent")))
    small = large.filter("sent").select("e", *[F.col(c).alias(f"s_{c}") for c in columns])
    needed = F.ceil((F.col("d") + F.col("s_d") - F.floor((F.col("n_b") + F.col("s_n_b")) * share + 1e-6)) / 2)
    return (small.join(large.drop("sent"), "e")
            .filter((F.struct("s_d", "s_b") < F.struct("d", "b")) & (F.col("label") != F.col("s_label"))
                    & (F.col("s_place") <= F.col("s_d") - needed) & (F.col("place") <= F.col("d") - needed))
            .select(F.col("s_b").alias("a"), F.col("b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``links`` (a, b) is joined with, by labels that jump along labels."""
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        low = written(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low")))
        jump = low.select(F.col("node").alias("low"), F.col("low").alias("jumped"))
        after = written(low.join(jump, "low", "left").select("node", "label", F.least("low", F.coalesce("jumped", "low")).alias("after")))
        changed = after.filter("label <> after").limit(1).count()
        labels = after.select("node", F.col("after").alias("label"))
        if not changed:
            return labels


def joined(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text; other columns are ignored).

    A set is a text's distinct five-word shingles, A-Z lower-cased; the whole sequence of a shorter text. Texts without
    words have size 0 and are linked with nothing. component_id is the smallest id reachable by links. Repeated rows have
    equal sets and are linked. Rows with a null id are linked as any other; they do not give a component its id, and one in a
    component of null ids alone gets null. An empty table gives an empty result.
    """
    doc_id = F.col("doc_id").cast("long")
    own = small_batches(docs).select(doc_id.alias("doc_id"), "text", F.xxhash64(doc_id, "text").alias("key"))
    found = _candidates(own, percent)
    rows = found.filter(f"kind = {NODE}").select(F.expr("case when w = 1 then x end").alias("doc_id"), F.col("y").alias("n_shingles"), F.col("z").alias("node"))
    least = written(rows.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    # A row of each node brings its text; told apart by id and text, since ids may be null or shared.
    firsts = written(found.filter(f"kind = {KEY}").groupBy(F.col("y").alias("node")).agg(F.min("x").alias("key")))
    members = found.filter(f"kind = {INCIDENCE}").select(F.col("x").alias("sig"), F.col("y").alias("node"), F.col("z").alias("inst"), F.col("w").alias("sure")).distinct()
    members = written(members)
    hidden = written(members.groupBy("node", "inst").agg(F.count("*").alias("n"), F.min("sure").alias("sure")))
    # Linked sets agree on as many signatures as each is sure of, less its crowded ones.
    agreeing = (found.filter(f"kind in ({PAIR}, {OTHER})")
                .groupBy(F.col("x").alias("a"), F.col("y").alias("b"), F.shiftright("z", 32).alias("inst"))
                .agg(F.min("kind").alias("kind"), F.sum(F.col("z").bitwiseAND(F.lit(0xFFFFFFFF))).alias("times"), F.max("w").alias("w"))
                .withColumns({"sure_a": F.shiftright("w", 16), "sure_b": F.col("w").bitwiseAND(F.lit(0xFFFF))}))
    for side in ("a", "b"):
        agreeing = (agreeing.join(hidden.select(F.col("node").alias(side), "inst", F.col("n").alias("n_crowded")), [side, "inst"], "left")
                    .filter(F.col("times") >= F.col(f"sure_{side}") - F.coalesce("n_crowded", F.lit(0))).drop("n_crowded"))
    pairs = written(agreeing.groupBy("a", "b").agg(F.min("kind").alias("kind")))
    # Members of crowded signatures matter for sets that have as many of those as they are sure to agree on.
    members = written(members.join(hidden.filter("n >= sure").select("node", "inst", "n", F.col("sure").alias("least")), ["node", "inst"])
                      .select("sig", "node", "inst", "n", "least"))
    # The lead, the member with most crowded signatures, is the least changed one of its group, and so near to most. Of several such members
    # the one that leads most signatures is taken, so that a group has few leads.
    strongest = members.groupBy("sig").agg(F.max_by("node", F.struct("n", "node")).alias("node"))
    leading = written(strongest.groupBy("node").agg(F.count("*").alias("leads")))
    crowds = written(members.join(leading, "node", "left").groupBy("sig").agg(
        F.max_by("node", F.struct(F.coalesce("leads", F.lit(0)), "n", "node")).alias("lead")))
    # Sets that agree on crowded signatures alone share as many as either is sure of, so that the first n - sure + 1 of each have one in common,
    # in any order that holds for all. Those of the lead with most signatures come first, so that a set is compared with few leads.
    width = crowds.groupBy("lead").agg(F.count("*").alias("width"))
    first = Window.partitionBy("node", "inst").orderBy(F.desc("width"), "lead", "sig")
    near = written(members.join(written(crowds.join(width, "lead")), "sig").withColumn("place", F.row_number().over(first))
                   .filter("place <= n - least + 1").select("sig", "node", "lead"))
    shared = near.groupBy("sig").agg(F.count("*").alias("left")).filter("left > 1").select("sig")

    def labelled(rows: DataFrame, labels: DataFrame, name: str, to: str) -> DataFrame:
        return rows.join(labels.select(F.col("node").alias(name), F.col("label").alias("_label")), name, "left").withColumn(
            to, F.coalesce("_label", name)).drop("_label")

    spokes = near.join(shared, "sig", "left_semi").filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"), F.lit(True).alias("wanted"))
    firm = pairs.filter(f"kind = {PAIR}").select("a", "b", F.lit(False).alias("wanted"))
    compared = _compared(own, firsts, firm.union(spokes), percent)
    links = compared.filter("linked").select("a", "b")
    labels = components(links)
    rest = labelled(labelled(pairs.filter(f"kind = {OTHER}"), labels, "a", "la"), labels, "b", "lb").filter("la <> lb").select("a", "b")
    # Only groups with a member outside their lead's component can still miss a link.
    spoke = compared.filter("apart is not null")
    mixed = labelled(labelled(spoke.select("a", "b"), labels, "b", "lb"), labels, "a", "la").filter("la <> lb").select("a").distinct()
    apart = labelled(spoke.join(written(mixed), "a", "left_semi"), labels, "b", "label")
    more = rest.union(_by_differences(apart, percent)).withColumn("wanted", F.lit(False))
    links = links.union(_compared(own, firsts, more, percent).filter("linked").select("a", "b"))
    labels = components(links)
    named = labelled(least, labels, "node", "label")
    ids = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = written(named.join(ids, "label").select("node", "component_id"))
    return rows.join(names, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
