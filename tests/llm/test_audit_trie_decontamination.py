"""Filter audit, prefix trie and decontamination against brute force, and their rules for odd input."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from callsieve.llm import decontamination, filteraudit, prefixtrie

CLASHING = ["part", "mask", "digest", "n", "steps", "item", "block", "term", "postings", "doc", "kind", "pos", "depth", "p0", "l0", "base", "h", "words"]


def clash(df):
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# 11 filter audit

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def plain_audit(docs, labels):
    good, bad, first = defaultdict(bool), defaultdict(bool), {}
    for doc_id, quality, toxic in labels:
        good[doc_id] |= quality == 1 and doc_id is not None
        bad[doc_id] |= toxic == 1 and doc_id is not None
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    parts = defaultdict(list)
    for doc_id, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = {k for k, v in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": doc_id is not None and first[text] < doc_id}.items() if v}
        parts[lang or ""].append((fails, good[doc_id], bad[doc_id]))
    out = {}
    for part, own in parts.items():
        shapley = defaultdict(int)
        for order in itertools.permutations("ABCDE"):
            there = own
            for step, letter in enumerate(order, 1):
                gone = [d for d in there if letter in d[0]]
                left = [d for d in there if letter not in d[0]]
                failing = sum(letter in d[0] for d in own)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), sum(d[0] == {letter} for d in own),
                                                   sum(d[1] for d in gone), sum(d[2] for d in gone)]
                shapley[letter] += len(gone)
                there = left
        for (p, order, step), found in out.items():
            if p == part:
                found.append(shapley[order[step - 1]])
    return out


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
            for r in rows(df)}


def odd_documents():
    rng = random.Random(4)
    made = lambda n, pool: " ".join(f"w{rng.randrange(pool)}" for _ in range(n))
    texts = [None, "", "a", "A B", made(300, 5000), made(300, 20), made(250, 900) + " #", "X" * 50 + " " + made(300, 4000), "a\x0bb\x1cc\x85d\x0ce",
             "Ü" * 30, made(199, 9000), made(200, 9000), "z " * 250]
    docs = [(i, t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts * 4)]
    return docs + [docs[4], docs[4], (None, "a", "en"), (None, None, None), (None, texts[4], "en"), (3, texts[5], "de")]


def test_audit_equals_every_order_walked(spark):
    docs = odd_documents()
    labels = [(i, i % 2, (i + 1) % 3 == 0) for i in range(0, 50, 3)] + [(None, 1, 1), (4, None, None), (6, None, 1), (6, 1, 0)]
    labels = [(a, b, None if c is None else int(c)) for a, b, c in labels]
    given = clash(spark.createDataFrame(docs, "doc_id long, text string, lang string")).repartition(5)
    found = audited(filteraudit.audit(given, clash(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))))
    want = plain_audit(docs, labels)
    assert len(found) == len(want) == 600 * len({d[2] or "" for d in docs})
    assert found == want


def test_audit_of_nothing_is_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    some = spark.createDataFrame([(1, "a", "en")], none.schema)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(none, labels).count() == 0
    assert audited(filteraudit.audit(some, labels)) == plain_audit([(1, "a", "en")], [])


def test_words_are_counted_slice_by_slice(monkeypatch):
    monkeypatch.setattr(filteraudit, "SLICE", 64)
    rng = random.Random(2)
    for n in (0, 1, 200, 999):
        text = "".join(rng.choice(["ab", "ü", " ", "\n", "\x0c ", "x" * 90, "long" * 40]) for _ in range(n)).encode()
        words = text.split()
        assert filteraudit.words_of(text) == (len(words), len(set(words)))


# 12 prefix trie

def plain_trie(given):
    own = defaultdict(list)
    for conv, turn, role, text in given:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(own[c])] for c in own}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(abs(c) % 100 * (1 if c >= 0 else -1))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1]) if node else 0
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node], leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(node)))).encode()).hexdigest())
                  for node, m in members.items())


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(df):
    return sorted(tuple(r[c] for c in NODE) for r in rows(df))


def odd_conversations():
    rng = random.Random(8)
    out = []
    for c in [*range(0, 60), *range(100, 140), 205, 207, 300, 301, 5000, -3, -105, -100, *range(9000, 9020)]:
        for t in range(rng.choice([1, 2, 3, 5, 6, 9, 17])):
            out.append((c, t, rng.choice(["user", "user", None]), rng.choice(["hi", "hi", "hi", "what?", "", None, "Ünï"])))
    out += [(9000 + i, None, "system", "first") for i in range(5)] + [(12, 3, "user", "tie"), (12, 3, "user", "tie"), (None, 1, "user", "x"), (None, None, None, None)]
    out += [(400, t, "user", f"turn {t}") for t in range(700)] + [(401, t, "user", f"turn {t}") for t in range(650)]
    # Many that end at the same node.
    return out + [(10_000 + i, t, "user", "same") for i in range(300) for t in range(7)]


@pytest.mark.parametrize("block", [1, 4])
def test_trie_equals_sets_of_prefixes(spark, block):
    given = odd_conversations()
    df = clash(spark.createDataFrame(given, "conv_id long, turn long, role string, text string")).repartition(6)
    assert nodes(prefixtrie.family_trie(df, block)) == plain_trie(given)


def test_trie_of_few_and_of_none(spark):
    schema = "conv_id long, turn long, role string, text string"
    none = spark.createDataFrame([], schema)
    assert prefixtrie.family_trie(none).count() == 0
    for given in ([(7, 0, "user", "a")], [(101, 0, "u", "a"), (101, 1, "u", "b")], [(None, 0, "u", "a")]):
        assert nodes(prefixtrie.family_trie(spark.createDataFrame(given, schema))) == plain_trie(given)


def test_last_turns_give_each_node_its_text(spark):
    given = [(0, 0, "user", "a"), (0, 1, "bot", "b"), (200, 0, "user", "c")]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["depth"]): (r["role"], r["text"]) for r in rows(prefixtrie.last_turns(prefixtrie.family_trie(df), df))}
    assert got[0, 0] == (None, None) and got[0, 1] == ("user", "a") and got[0, 2] == ("bot", "b")


# 13 decontamination

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def plain_hits(docs, benchmark):
    windows = defaultdict(set)
    for item, text in benchmark:
        words = terms(text)
        for w in range(max(len(words) - 10, 0) + 1 if words else 0):
            windows[tuple(words[w:w + 10])].add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        words, hit, items = terms(text), set(), set()
        for width in {len(w) for w in windows}:
            for at in range(len(words) - width + 1):
                found = windows.get(tuple(words[at:at + width]))
                if found:
                    hit.update(range(at, at + width))
                    items |= found
        out.append((doc_id, len(words), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


HIT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def odd_passages():
    rng = random.Random(5)
    words = lambda n, pool: [f"{rng.choice(['Ab', 'ü', 'x', '9'])}{rng.randrange(pool)}" for _ in range(n)]
    benchmark = [(i, " ".join(words(rng.choice([0, 1, 4, 10, 11, 25, 60]), 400))) for i in range(30)]
    benchmark += [(None, "null item's text"), (3, benchmark[9][1]), (40, None), (41, "the " * 14), (42, "the"), (5, " ".join(words(12, 400))), (43, ", . !")]
    docs = [(0, None), (1, ""), (2, "the The THE, the"), (3, "the-" * 30), (None, benchmark[5][1]), (None, "null ITEM s text"), (4, "x" * 5000)]
    for i in range(60):
        parts = [" ".join(words(rng.randrange(40), 400))]
        for _ in range(rng.randrange(4)):
            held = (rng.choice(benchmark)[1] or "").split()
            a = rng.randrange(len(held) + 1)
            parts += [rng.choice([" ", "... ", "\n", " zz "]).join(held[a // 2:]), " ".join(words(rng.randrange(5), 400))]
        docs.append((10 + i, " ".join(parts).upper() if i % 5 == 0 else " ".join(parts)))
    return docs + [docs[20], docs[20], (docs[20][0], "other text")], benchmark


@pytest.mark.parametrize("sent", [0, 50_000])
def test_phrases_equal_all_windows_of_all_documents(spark, monkeypatch, sent):
    monkeypatch.setattr(decontamination, "SENT_ROWS", sent)
    docs, benchmark = odd_passages()
    found = decontamination.contaminated(clash(spark.createDataFrame(docs, "doc_id long, text string")).repartition(4),
                                         clash(spark.createDataFrame(benchmark, "item_id long, text string")))
    assert sorted((tuple(r[c] for c in HIT) for r in rows(found)), key=str) == plain_hits(docs, benchmark)


def test_slices_and_a_full_bit_table_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    monkeypatch.setattr(decontamination, "BITS", 6)
    docs, benchmark = odd_passages()
    found = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1),
                                         spark.createDataFrame(benchmark, "item_id long, text string"))
    assert sorted((tuple(r[c] for c in HIT) for r in rows(found)), key=str) == plain_hits(docs, benchmark)


def test_nothing_to_find(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some_docs, some_items = spark.createDataFrame([(1, "a b")], docs.schema), spark.createDataFrame([(1, "a b")], items.schema)
    assert decontamination.contaminated(docs, some_items).count() == 0
    for a, b in ((some_docs, items), (some_docs, some_items)):
        assert [tuple(r[c] for c in HIT) for r in rows(decontamination.contaminated(a, b))] == plain_hits([(1, "a b")], rows(b) and [(1, "a b")])


def test_matches_name_phrases_and_proximity(spark):
    item = " ".join(f"w{i}" for i in range(12))
    moved = item.replace("w5", "w5 extra")
    docs = [(1, f"start {item} end"), (2, moved), (3, "w0 and w11"), (4, " ".join(reversed(item.split())))]
    # Words of the item that other documents hold too: the rarest ones decide what is near.
    docs += [(9, " ".join(f"w{i}" for i in range(12) if i not in (4, 6, 7)))] * 3
    facts, found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"),
                                           spark.createDataFrame([("x", item)], "item_id string, text string"), slop=1)
    named = {(r["doc_id"], r["kind"], r["item_id"]) for r in rows(facts.join(found, ["block", "doc"]))}
    assert (1, "phrase", "x") in named and (2, "proximity", "x") in named
    assert not {d for d, _, _ in named} & {3, 4} and not [n for n in named if n[:2] == (1, "proximity")]
    assert [(r["first"], r["last"]) for r in rows(facts.join(found, ["block", "doc"]).filter("doc_id = 1"))] == [(1, 12)]
