"""The training-data operators against brute force, exact round trips and held-out labels, and their rules for odd input."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsieve.llm import (
    fingerprints, jaccard, langid, linededup, mixing, packing, sharding, substring, topk, toxicity)
from callsieve.llm.perfecthash import PerfectHash

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as columns of the input they must not matter.
CLASHING = ["size", "key", "chunk", "shard", "slot", "node", "kind", "bucket", "start", "length", "target", "label", "score", "spot",
            "digest", "a", "b", "doc", "gone", "toxic", "held_out", "index", "block", "times", "print", "extra", "first"]
LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(60_000))


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    rng = random.Random(3)
    same = words(rng, 80)
    texts = [None, "", " \n\t ", "one", "Über groß", same, same, same.upper(), LONG, LONG + " tail", words(rng, 30), "a  b\x0bc\x1cd\n\n e ",
             "<|endoftext|> x", "ends \n", "İstanbul ǅ"]
    rows = [(10 * i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 3}", 0) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[0], (None, "no id", "en", "s1", 0), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    return docs.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(10 * i, 1, i % 2) for i in range(9)] + [(None, 1, 1), (30, 0, None), (30, 0, 1)],
                                 "doc_id long, quality int, toxic int")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_perfect_hash_is_minimal_and_survives_equal_keys():
    keys = np.random.default_rng(1).integers(0, 2 ** 64, 5000, dtype=np.uint64)
    held = PerfectHash.load(PerfectHash.build(keys).dump())
    assert sorted(held.index(keys)) == list(range(5000))
    doubled = PerfectHash.build(np.array([7, 7, 9], dtype=np.uint64))
    assert len(doubled) == 3 and (doubled.index(np.array([7, 9], dtype=np.uint64)) >= 0).all()
    assert len(PerfectHash.build(keys[:0])) == 0


# 1 substring dedup

def plain_cuts(data: bytes, least, most, bits):
    out, last = [], 0
    for end in range(1, len(data) + 1):
        h = sum(int(substring.GEAR[data[end - 1 - age]]) << age for age in range(min(32, end))) & 0xFFFFFFFF
        while end - last > most:
            last += most
            out.append(last)
        if (h >> (32 - bits) == 0 or end == len(data)) and end - last >= least:
            out.append(end)
            last = end
    return out + ([len(data)] if last < len(data) else [])


def test_chunks_equal_a_byte_by_byte_rolling_hash():
    rng = random.Random(1)
    for text in ("", "a", words(rng, 400), "x" * 2000, "äöü" * 300):
        data = text.encode()
        assert substring.cuts(np.frombuffer(data, np.uint8)) == plain_cuts(data, substring.LEAST, substring.MOST, substring.CUT_BITS)


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(5)
    passages = [words(rng, 55) for _ in range(20)]
    texts = [words(rng, rng.randint(0, 90)) + " " + p + " " + words(rng, rng.randint(0, 90)) for p in passages for _ in range(3)]
    clean = [words(rng, 200) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts + clean)), "doc_id long, text string")
    found = rows(substring.spans(docs))
    assert {r["doc_id"] for r in found} == set(range(60))
    for r in found:
        held = texts[r["doc_id"]].encode()[r["start_byte"]:r["start_byte"] + r["n_bytes"]]
        assert held in passages[r["doc_id"] // 3].encode() and r["first_doc_id"] == r["doc_id"] // 3 * 3
    kept = {r["doc_id"]: r["text"] for r in rows(substring.deduplicated(docs))}
    assert all(kept[i] == texts[i] for i in range(0, 60, 3)) and all(len(kept[i]) < len(texts[i]) - 120 for i in range(60) if i % 3)
    assert all(kept[60 + i] == clean[i] for i in range(60))


def test_chains_of_edited_copies_lose_no_text(spark):
    rng = random.Random(8)
    first, new, other, short = words(rng, 300), words(rng, 120), words(rng, 120), words(rng, 90)
    copy = f"{first[:900]} {new} {first[900:]}"
    texts = {1: first, 5: copy, 9: copy, 12: f"{other} {new[:400]}", 14: f"{short} {first[:200]} {other}", 20: f"{first[:200]} {short} {words(rng, 40)} äöü"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in rows(substring.deduplicated(docs))}
    assert kept[1] == first and new[80:-80] in kept[5] and len(kept[5]) < len(new) + 400 and len(kept[9]) < 200
    for text in texts.values():  # every chunk of every text stands in what is kept
        data = text.encode()
        ends = substring.cuts(np.frombuffer(data, np.uint8))
        assert all(any(data[i:e] in k.encode() for k in kept.values()) for i, e in zip([0, *ends], ends))
    for r in rows(substring.passages(docs)):
        lost = sum(g["n"] for g in r["gone"])
        assert lost == r["n_dropped_bytes"] and (r["first_doc_id"] < r["doc_id"]) == (lost > 0)
    for i, text in texts.items():
        assert len(text.encode()) - len(kept[i].encode()) == sum(r["n_dropped_bytes"] for r in rows(substring.spans(docs)) if r["doc_id"] == i)
    gone = {(r["doc_id"], at) for r in rows(substring.passages(docs)) for g in r["gone"] for at in range(g["start"], g["start"] + g["n"])}
    digests = Counter()
    for c in rows(substring.chunks(docs)):
        digests[c["doc_id"]] += 0 if (c["doc_id"], c["start"]) in gone else c["digest"] & 0xFFFFFFFF
    reported = rows(substring.report(docs))
    assert {r["doc_id"] for r in reported} >= {5, 9}
    for r in reported:
        assert (r["kept_bytes"], r["kept_digest"]) == (len(kept[r["doc_id"]].encode()), digests[r["doc_id"]])
    twice = {r["doc_id"]: r["kept_bytes"] for r in rows(substring.report(docs.union(docs)))}
    assert all(twice[r["doc_id"]] == 2 * r["kept_bytes"] for r in reported)


def test_characters_that_a_cut_parts_stay(spark):
    found = spark.createDataFrame([(2, 9, [(2, 5)])], "doc_id long, n_dropped_bytes long, gone array<struct<start long, n long>>")
    docs = spark.createDataFrame([(2, "aäbcdöe")], "doc_id long, text string")  # bytes 2 to 6: half of ä, b, c, d, half of ö
    assert rows(substring.without(docs, found)) == [{"doc_id": 2, "text": "aäöe"}]


def test_substring_odd_input(odd, none):
    found = rows(substring.spans(odd))
    assert {r["doc_id"] for r in found} == {50, 60, 80, 90} and max(r["n_bytes"] for r in found) > len(LONG) - 300
    assert rows(substring.spans(none)) == [] and substring.deduplicated(odd).count() == odd.count()


# 2 toxicity

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    chain = toxicity.Chain(rng.normal(size=toxicity.LEVELS), rng.normal(size=(2, 2)), 0.3)
    lengths = np.array([0, 1, 5, 0, 9, 2])
    levels = rng.integers(0, toxicity.LEVELS, lengths.sum())
    got, pairs = chain.marginals(levels, lengths)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    for n in lengths:
        total, ones, own = 0.0, np.zeros(n), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=int(n)):
            e = sum(chain.emission[levels[at + i]] for i, s in enumerate(states) if s) + sum(
                chain.transition[a, b] for a, b in zip(states, states[1:])) + (chain.start if n and states[0] else 0)
            total += np.exp(e)
            ones += np.exp(e) * np.array(states)
            for a, b in zip(states, states[1:]):
                own[a, b] += np.exp(e)
        want.extend(ones / total)
        want_pairs += own / total
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_long_sequences_equal_the_plain_recursion():
    rng = np.random.default_rng(6)
    chain = toxicity.Chain(rng.normal(size=toxicity.LEVELS), rng.normal(size=(2, 2)), -0.5)
    lengths = np.array([200, 64, 65, 1000])
    levels = rng.integers(0, toxicity.LEVELS, lengths.sum())
    got, _ = chain.marginals(levels, lengths)
    want, at = [], 0
    for n in lengths:
        e = np.exp(np.stack([np.zeros(n), chain.emission[levels[at:at + n]]], axis=1))
        t, alpha, beta = np.exp(chain.transition), np.zeros((n, 2)), np.ones((n, 2))
        alpha[0] = e[0] * [1, np.exp(chain.start)]
        for i in range(1, n):
            alpha[i] = (alpha[i - 1] @ t) * e[i]
            alpha[i] /= alpha[i].sum()
        for i in range(n - 2, -1, -1):
            beta[i] = t @ (e[i + 1] * beta[i + 1])
            beta[i] /= beta[i].sum()
        want.extend((alpha * beta)[:, 1] / (alpha * beta).sum(axis=1))
        at += n
    assert np.allclose(got, want)


def test_toxicity_held_out(spark):
    docs, truth = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.tagged(docs, truth).join(truth, "doc_id").filter("held_out").toPandas()
    hit = (scored.predicted == 1) & (scored.toxic == 1)
    assert hit.sum() >= 0.8 * (scored.toxic == 1).sum() and hit.sum() >= 0.85 * (scored.predicted == 1).sum()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in scored[hit].itertuples():
        assert all(0 <= s["start"] < s["end"] <= len(text[r.doc_id]) for s in (x.asDict() for x in r.spans))


def test_toxicity_odd_input(odd, none, labels):
    scored = rows(toxicity.tagged(odd, labels))
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored)
    assert all(r["score"] == 0 for r in scored if not (r["text"] or "").strip())
    assert {r["held_out"] for r in scored if r["doc_id"] is None} == {False}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored if r["doc_id"] is not None)
    assert rows(toxicity.tagged(none, labels)) == [] and len(rows(toxicity.tagged(odd, labels.limit(0)))) == odd.count()


def test_scores_do_not_depend_on_partitions(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = [sorted((r["doc_id"], r["score"]) for r in rows(toxicity.tagged(docs.repartition(n), labels.repartition(n)).select("doc_id", "score"))) for n in (1, 7, 13)]
    assert scored[0] == scored[1] == scored[2]


# 3 n-gram Jaccard join

def shingles(text):
    w = WORD.findall((text or "").translate(SMALL))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_components(texts):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def edited(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    common = words(rng, 60)
    texts = [words(rng, rng.randint(1, 40)) for _ in range(60)]
    texts += [f"{words(rng, 20)} {common} {words(rng, 20)}" for _ in range(40)]
    for size, copies in ((12, 20), (40, 30), (150, 60), (400, 25)):
        base = words(rng, size)
        texts += [base] * 3 + [edited(rng, base, rng.randint(0, max(1, size // 30))) for _ in range(copies)]
    chain = words(rng, 200)
    for _ in range(25):  # each near to the one before, the ends far apart
        chain = edited(rng, chain, 3)
        texts.append(chain)
    texts += [words(rng, n) for n in range(1, 30)] + [words(random.Random(9), n) for n in range(1, 30)] + [None, "", "  "]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(jaccard.joined(docs))}
    want = plain_components(texts)
    assert got == dict(enumerate(want))
    assert max(Counter(c for _, c in want).values()) > 25


def test_join_compares_members_of_a_crowd_with_few_leads(spark, monkeypatch):
    rng = random.Random(11)
    base = words(rng, 300)
    texts = [edited(rng, base, rng.randint(1, 20)) for _ in range(150)]  # many are near the first version, many near others only
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spokes, exploded = [], []
    compared, by_differences = jaccard._compared, jaccard._by_differences

    def counted(docs, firsts, pairs, percent):
        spokes.append(pairs.filter("wanted").select("a", "b").distinct().count())
        return compared(docs, firsts, pairs, percent)

    def summed(rows, percent):
        exploded.append(rows.agg(F.sum(F.size("apart"))).first()[0] or 0)
        return by_differences(rows, percent)

    monkeypatch.setattr(jaccard, "_compared", counted)
    monkeypatch.setattr(jaccard, "_by_differences", summed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(jaccard.joined(docs))}
    assert got == dict(enumerate(plain_components(texts)))
    assert 0 < sum(spokes) <= 1.5 * len(texts)
    assert 0 < sum(exploded) <= 150 * len(texts)


def test_differences_within_one_component_are_not_placed(spark, monkeypatch):
    group = [(1, 10 + i, 1, True, 400, 400, [*range(30), 5_000 + i]) for i in range(40)]  # all in the lead's component, with elements of their own
    group += [(1, 60, 60, False, 400, 400, list(range(900, 1_010))), (1, 61, 61, False, 400, 400, list(range(901, 1_011)))]
    spokes = spark.createDataFrame(group, "a long, b long, label long, linked boolean, n_a long, n_b long, apart array<long>")
    placed, written = [], jaccard.written

    def counted(df, *given):
        out = written(df, *given)
        if "place" in df.columns:
            placed.append(out.groupBy("b").count().collect())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    assert [(r["a"], r["b"]) for r in rows(jaccard._by_differences(spokes, 80))] == [(60, 61)]
    assert len(placed) == 1 and {r["b"] for r in placed[0]} == {60, 61}


def test_common_elements_of_differences_are_not_all_made_rows(spark, monkeypatch):
    """Sixty sets that all lack the same 100 elements of their lead and have 40 of their own; sets of 300 differ in 75 elements at most."""
    group = [(1, 10 + i, 10 + i, False, 360, 300, [*range(100), *range(1_000 * (i + 1), 1_000 * (i + 1) + 40)]) for i in range(60)]
    spokes = spark.createDataFrame(group, "a long, b long, label long, linked boolean, n_a long, n_b long, apart array<long>")
    made, written = [], jaccard.written

    def counted(df, *given):
        out = written(df, *given)
        if "e" in df.columns and "place" not in df.columns:
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    assert rows(jaccard._by_differences(spokes, 80)) == []
    assert len(made) == 1 and made[0] <= 76 * len(group)


@pytest.mark.parametrize("told_by", [8, 64, 1000])
def test_differences_find_all_links_in_any_order(spark, monkeypatch, told_by):
    rng = random.Random(told_by)
    monkeypatch.setattr(jaccard, "ORDER_SPOKES", told_by, raising=False)
    group, want = [], set()
    for lead in (1, 2):
        base = [rng.getrandbits(62) for _ in range(320)]
        families = [(set(rng.sample(base, rng.randint(0, 120))), {rng.getrandbits(62) for _ in range(rng.randint(0, 90))}) for _ in range(9)]
        members = []
        for i in range(130):
            lost, more = families[min(rng.randrange(12), 8)]
            own = set(base) - lost - set(rng.sample(base, rng.randint(0, 20))) | more | {rng.getrandbits(62) for _ in range(rng.randint(0, 25))}
            own -= set(rng.sample(sorted(own), rng.randint(0, 15)))
            both = len(own & set(base))
            linked = 100 * both >= 80 * (len(own) + len(base) - both)
            members.append((1_000 * lead + i, lead if linked else 1_000 * lead + i, own))
            group.append((lead, members[-1][0], members[-1][1], linked, len(base), len(own), sorted(own ^ set(base))))
        want |= {frozenset((x, y)) for (x, lx, sx), (y, ly, sy) in itertools.combinations(members, 2) if lx != ly and 100 * len(sx & sy) >= 80 * len(sx | sy)}
    spokes = spark.createDataFrame(group, "a long, b long, label long, linked boolean, n_a long, n_b long, apart array<long>")
    got = {frozenset((r["a"], r["b"])) for r in rows(jaccard._by_differences(spokes, 80))}
    assert len(want) > 100 and want <= got


@pytest.mark.parametrize("sizes", [(40, 60), (200, 330), (900, 1400)])
def test_sure_agreements_hold_for_the_farthest_partners(sizes):
    rng = np.random.default_rng(12)
    bands = jaccard.Bands(80, 5_000)
    for size in range(*sizes, 7):
        own = rng.integers(0, 1 << 64, size, dtype=np.uint64)
        extra = rng.integers(0, 1 << 64, size, dtype=np.uint64)
        sets = [np.sort(own)]
        for more in range(0, size // 4 + 1, max(1, size // 20)):  # linked, and one element more in the difference would not be
            union = size + more
            lost = max(0, union - -(-80 * (union) // 100) - more)
            sets.append(np.sort(np.concatenate([own[lost:], extra[:more]])))
        sig, owner, inst, sure = jaccard._signatures(sets, bands)
        of = [{i: set(sig[(owner == j) & (inst == i)].tolist()) for i in set(inst[owner == j].tolist())} for j in range(len(sets))]
        least = [{i: int(sure[(owner == j) & (inst == i)][0]) for i in of[j]} for j in range(len(sets))]
        for j in range(1, len(sets)):
            both = len(np.intersect1d(sets[0], sets[j]))
            assert 100 * both >= 80 * (len(sets[0]) + len(sets[j]) - both)
            shared = [i for i in of[0] if i in of[j]]
            assert shared
            for i in shared:
                assert len(of[0][i] & of[j][i]) >= max(least[0][i], least[j][i])
        for i in of[0]:  # as many as differ from a partner of size / 0.8 at most
            assert least[0][i] == 1 or least[0][i] >= len(of[0][i]) - size // 4


def test_packed_signatures_come_back():
    rng = np.random.default_rng(5)
    sets, n = 40, 3_000
    unit = np.sort(np.concatenate([rng.integers(0, 2 * sets, n), np.full(70_000, 7)]))  # one set with very many
    sig = rng.integers(0, 1 << 32, len(unit), dtype=np.uint64) | np.uint64(5 << 40)
    node, band = rng.integers(-(1 << 63), (1 << 63) - 1, sets), rng.integers(1, 80, sets)
    sure = rng.integers(1, 60_000, (sets, 2))
    got = jaccard._unpack(jaccard._pack(sig, unit, node, band, sure))
    expected = (sig & np.uint64(0xFFFFFFFF), node[unit // 2], band[unit // 2] + unit % 2, np.minimum(sure.ravel()[unit], 32_000))
    assert all((g.astype(np.int64) == e.astype(np.int64)).all() for g, e in zip(got, expected))
    none = np.zeros(0, dtype=np.int64)
    assert all(len(g) == 0 for g in jaccard._unpack(jaccard._pack(none.astype(np.uint64), none, node, band, sure)))


def test_join_odd_input(odd, none):
    got = rows(jaccard.joined(odd))
    assert len(got) == odd.count() and rows(jaccard.joined(none)) == []
    of = defaultdict(list)
    for r in got:
        of[r["doc_id"]].append((r["n_shingles"], r["component_id"]))
    assert of[0] == [(0, 0)] * 2 and of[20] == [(0, 20)] and of[50] == [(76, 50)] * 2 and of[60] == [(76, 50)] and of[70] == [(76, 50)]
    assert of[80][0][1] == of[90][0][1] == 80 and sorted(of[None]) == [(0, None), (1, None)]


def test_join_through_null_and_shared_ids(spark):
    rng = random.Random(6)
    base, other = words(rng, 200), words(rng, 200)
    near = [base, edited(rng, base, 1)]
    chain = [base, edited(rng, base, 4)]
    chain.append(edited(rng, chain[-1], 4))  # near to the second, not to the first
    schema = "doc_id long, text string"
    joined = lambda given: {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in rows(jaccard.joined(spark.createDataFrame(given, schema)))}
    assert set(joined([(1, base), (None, near[1])]).values()) == {1}
    assert set(joined([(1, chain[0]), (None, chain[1]), (3, chain[2])]).values()) == {1}
    shared = joined([(1, base), (1, other + " tail"), (5, near[1]), (None, edited(rng, other, 1))])
    assert set(shared.values()) == {1} and len(shared) == 4
    assert set(joined([(None, base), (None, near[1])]).values()) == {None}
    many = [(7, words(rng, 150)) for _ in range(12)]
    got = jaccard.joined(spark.createDataFrame(many + [(100 + i, edited(rng, x, 1)) for i, (_, x) in enumerate(many)], schema))
    assert {r["component_id"] for r in rows(got)} == {7}


# 4 exact top-k

def test_top_k_equals_brute_force_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    held = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)] + [(i, [0.5] * 6) for i in range(300, 700)]
    bad = [(1000, None), (1020, [None] * 6), (1040, [float("nan")] * 6), (1060, [float("inf")] * 6), (None, [1.0] * 6)]
    held += [(2000, []), (2001, [1.0, -1.0]), held[5], (5, [1.0] * 6)]
    vectors = topk.whole(spark.createDataFrame(held + bad, "id long, x array<double>"))
    got = defaultdict(list)
    for r in rows(topk.nearest(vectors.filter("id % 20 = 0"), vectors, 30)):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = {(i, tuple(int(np.floor(64 * x)) for x in v)) for i, v in held}
    for q, v in (x for x in whole if x[0] % 20 == 0):
        best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q))[:30]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert len(got) == len({i for i, _ in whole if i % 20 == 0})


def test_top_k_with_few_or_no_rows(spark):
    two = topk.whole(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "id long, x array<float>"))
    assert rows(topk.nearest(two.filter("id = 0"), two)) == [{"query_id": 0, "rank": 1, "vec_id": 1, "score": 8192}]
    assert rows(topk.nearest(two.limit(0), two)) == [] and rows(topk.nearest(two, two.limit(0))) == []


# 5 line dedup

def plain_lines(docs):
    holders = defaultdict(list)
    keys = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        keys.append([x.strip(" \t\n\x0b\x0c\r").translate(SMALL) for x in lines])
        for k in set(keys[-1]):
            holders[k].append(doc)
    out = []
    for (doc, text), own in zip(docs, keys):
        lines = (text or "").split("\n")
        keep = [x for x, k in zip(lines, own) if not (len(k) >= 40 and len(holders[k]) >= 5 and max(holders[k]) != doc)]
        out.append((doc, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


def test_lines_equal_brute_force(spark):
    rng = random.Random(8)
    lines = ["Ä" + words(rng, 12)[:rng.choice([37, 38, 39, 60])] for _ in range(40)] + ["A" * 40, "é" * 39, "x" * 41, ""]
    docs = [(i, None if i == 7 else "\n".join(rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < 0.2 and x.isascii() else x)
                                             for x in rng.choices(lines, weights=[1] * 43 + [9], k=rng.randint(0, 12)))) for i in range(200)]
    got = linededup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"))
    kept = got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256))
    assert sorted(tuple(r) for r in kept.collect()) == plain_lines(docs)


def test_lines_odd_input(spark, odd, none):
    got = linededup.deduplicated(odd, carried=["lang", "shard"])
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped", "lang", "shard"] and got.count() == odd.count()
    assert rows(linededup.deduplicated(none)) == []
    line = "this line is held by every row and it is long enough"
    got = rows(linededup.deduplicated(spark.createDataFrame([(i, line) for i in (1, 2, 3, 9, 9)] + [(None, line)], "doc_id long, text string")))
    assert sorted((r["doc_id"] or -1, r["n_dropped"]) for r in got) == [(-1, 1), (1, 1), (2, 1), (3, 1), (9, 0), (9, 0)]


# 6 fingerprints

def test_fingerprints_estimate_similarity(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy(F.desc("doc_id")).limit(300)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in rows(fingerprints.compared(docs))}
    off, by_text = [], {}
    for i, (doc, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        third = len(text) // 3
        edit = text[:len(text) - third] + after[:third]
        assert got[doc]["n_chars"] == len(text) and got[doc]["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        for name, other in (("near_edited", edit), ("near_next", after)):
            a, b = shingles(text), shingles(other)
            off.append(got[doc][name] - len(a & b) / len(a | b))
        assert by_text.setdefault(text, got[doc]["fingerprint"]) == got[doc]["fingerprint"]
    assert len(set(by_text.values())) > 0.97 * len(by_text) and np.abs(off).mean() < 0.04 and abs(np.mean(off)) < 0.01


def test_fingerprints_odd_input(odd, none):
    got = rows(fingerprints.compared(odd))
    assert len(got) == odd.count() and rows(fingerprints.compared(none)) == []
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert {r["fingerprint"] for r in got if r["doc_id"] == 0} == {""} and len({r["fingerprint"] for r in got if r["doc_id"] in (50, 60, 70)}) == 1
    assert all(r["near_next"] == 1 for r in got if r["doc_id"] in (20, 70, 60))
    assert not any("Python" in p or "Arrow" in p for p in [fingerprints.compared(odd)._jdf.queryExecution().executedPlan().toString()])


# 7 sharding

def plain_capacity(sizes, shards):
    def fits(c):
        used, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards

    low, high = 1, sum(sizes) or 1
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


@pytest.mark.parametrize("n, shards, bits", [(3000, 7, 12), (500, 40, 4), (3, 5, 12), (2000, 3, 2)])
def test_capacity_is_the_smallest(spark, n, shards, bits, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits)
    rng = random.Random(n)
    held = sorted((rng.randrange(2 ** 60), rng.randint(1, 1000)) for _ in range(n))
    capacity, cuts = sharding.cut_keys(spark.createDataFrame(held, "key long, size long"), shards)
    assert capacity == plain_capacity([s for _, s in held], shards)
    loads = [sum(s for k, s in held if a <= k < b) for a, b in zip([0, *cuts], [*cuts, 2 ** 61])]
    assert sum(loads) == sum(s for _, s in held) and max(loads) <= capacity


def test_shards_are_even_and_gapless(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sharding.shards(docs, 40).toPandas()
    assert len(got) == docs.count() and set(got["shard"]) == set(range(40))
    assert got.groupby("shard")["size"].sum().max() < 1.25 * got["size"].sum() / 40
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got.assign(t=got.doc_id.map(text)).groupby("t").shard.nunique().max() == 1
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.size == len(text[r.doc_id].encode()) + 16 for r in got.itertuples(index=False))


def test_shards_odd_input(odd, none):
    got = rows(sharding.shards(odd, 4))
    assert len(got) == odd.count() and {r["shard"] for r in got} <= set(range(4)) and rows(sharding.shards(none, 4)) == []
    assert {r["size"] for r in got if r["doc_id"] == 0} == {16}


# 8 mixing

def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 3 * sizes[s]]
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_mix_reaches_its_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.expr(
        "case when doc_id % 3 = 0 then 'hot' when doc_id % 50 = 1 then null when doc_id % 97 = 2 then 'Ärmlich' else source end"))
    first, second = mixing.mixed(docs).toPandas(), mixing.mixed(docs.repartition(7)).toPandas()
    assert first.sort_values("doc_id").reset_index(drop=True).equals(second.sort_values("doc_id").reset_index(drop=True))
    held = {r["doc_id"]: (r["source"], len(WORD.findall(r["text"] or ""))) for r in docs.collect()}
    sizes = Counter()
    for s, n in held.values():
        sizes[s] += n
    want, taken = plain_targets(sizes), Counter()
    for r in first.itertuples():
        s, n = held[r.doc_id]
        assert r.size == n and r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * want[s] and 0 <= r.taken <= 3 * n
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_small_sources_reach_their_targets(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, words(rng, 20), f"s{i:02d}") for i in range(12)] + [(50 + i, words(rng, 130 + i), "t") for i in range(5)],
                                 "doc_id long, text string, source string")
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    want, taken, source = plain_targets(sizes), Counter(), {r["doc_id"]: r["source"] for r in docs.collect()}
    for r in rows(mixing.mixed(docs)):
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_slots_are_whole_shards_of_permuted_blocks(spark):
    sources = spark.createDataFrame([(False, "a", 1000, 730.0), (False, "b", 640, 1500.0), (False, "c", 65, 64.5), (True, "", 3, 9.0)],
                                    "no_source boolean, source_key string, source_size long, target double")
    drawn = {seed: rows(mixing.slots(sources, 64, 4, seed)) for seed in (1, 2)}
    for found in drawn.values():
        total, per_shard, blocks = Counter(), defaultdict(list), defaultdict(Counter)
        for r in found:
            assert 0 < r["n"] <= r["n_block"] <= 64
            total[r["source_key"]] += r["n"]
            per_shard[r["source_key"], r["shard"]].append(r["slot"])
            blocks[r["source_key"]][r["block"]] += 1
        assert total == {"a": 730, "b": 1500, "c": 65, "": 9} or total == {"a": 730, "b": 1500, "c": 64, "": 9}
        assert all(sorted(v) == list(range(len(v))) for v in per_shard.values()) and len({s for _, s in per_shard}) > 3
        assert all(max(c.values()) - min(c.values()) <= 1 for s, c in blocks.items() if s in "b") and sum(r["n"] < r["n_block"] for r in found) <= 4
    kept = [Counter((r["source_key"], r["block"]) for r in found) for found in drawn.values()]
    assert kept[0] != kept[1]


def test_mix_odd_input(odd, none):
    got = rows(mixing.mixed(odd))
    assert len(got) == odd.count() and rows(mixing.mixed(none)) == []
    assert all(r["taken"] <= 3 * r["size"] for r in got) and {r["taken"] for r in got if r["doc_id"] in (0, 10, 20)} == {0}
    plan = mixing.mixed(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_mixture_holds_the_taken_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    taken, made = Counter(), Counter()
    for r in rows(mixing.mixed(docs)):
        taken[r["doc_id"]] += r["taken"]
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows(mixing.mixture(docs)):
        w = WORD.findall(r["text"])
        made[r["doc_id"]] += len(w)
        assert r["n_chars"] == len(r["text"]) and not Counter(w) - Counter(WORD.findall(text[r["doc_id"]]))
    assert made == +taken


# 9 language

def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.96 and got.score.between(0, 1).all() and got.rejected.mean() < 0.2


def test_language_odd_input(odd, none):
    got = rows(langid.identified(odd))
    assert len(got) == odd.count() and rows(langid.identified(none)) == []
    for r, text in ((r, dict((x[0], x[1]) for x in odd_rows() if x[0] is not None).get(r["doc_id"])) for r in got if r["doc_id"] is not None):
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert {r["lang_pred"] for r in rows(langid.identified(odd.withColumn("lang", F.lit(None).cast("string"))))} == {"und"}


# 10 packing

def test_ids_equal_the_tokenizer(odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r[1] for r in odd_rows() if r[1]] + ["a\nb", "a \n b", "\n", "x\r\ny", "'s 't it's\nI'll", "1 22  333", "tab\tbed", "a b", "é\nü ß"]
    ids = packing.Ids()
    for text in texts:
        assert np.frombuffer(ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("length", [16, 2048])
def test_sequences_are_whole_and_tight(spark, odd, none, length):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 60").select(*SCHEMA.replace(" string", "").replace(" long", "").split(", "))
    got = packing.sequences(docs, length).toPandas()
    want = {}
    for r in docs.collect():
        ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) % length or length
        for piece, start in enumerate([0, *range(first, len(ids), length)]):
            part = ids[start:start + (length if piece else first)]
            want[r["doc_id"], piece] = (start, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= length
    assert got.sequence_id.nunique() <= -(-got.length.sum() // length) * 1.02 + 1
    assert packing.sequences(odd).filter("piece = 0").count() == odd.count() and rows(packing.sequences(none)) == []


def test_best_fit_equals_a_plain_search():
    rng = random.Random(2)
    for _ in range(20):
        bins, plain = packing.BestFit(50), []
        for size in sorted((rng.randint(1, 50) for _ in range(200)), reverse=True):
            fitting = [room for room in plain if room >= size]
            room = min(fitting) if fitting else 50
            if fitting:
                plain.remove(room)
            number, offset = bins.place(size)
            assert offset == 50 - room
            plain.append(room - size)
        assert sorted(50 - u for u in bins.used) == sorted(plain)
