"""Queries of the operators over the given tables, and the SQL that some are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination, filteraudit, fingerprints, jaccard, langid, linededup, mixing, packing, prefixtrie, sharding, substring, topk, toxicity)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_substring_dedup")
def op1(spark, sf_dir):
    return substring.report(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2(spark, sf_dir):
    scored = toxicity.tagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "spans")


@query("op3_ngram_jaccard_join")
def op3(spark, sf_dir):
    return jaccard.joined(table(spark, sf_dir, "documents"))


@query("op4_exact_top_k", """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 20""")
def op4(spark, sf_dir):
    vectors = topk.whole(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("x")))
    return topk.nearest(vectors.filter("id % 20 = 0"), vectors)


@query("op5_line_dedup", """
with lines as (
  select doc_id, u.line as line, u.nr as nr
  from documents, unnest(string_split(coalesce(text, ''), chr(10))) with ordinality as u(line, nr)),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
repeated as (
  select key, max(doc_id) as largest from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5),
marked as (
  select k.*, r.key is not null and k.doc_id <> r.largest as gone from keyed k left join repeated r on k.key = r.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by nr) filter (where not gone), '')) as kept_sha256
from marked group by doc_id""")
def op5(spark, sf_dir):
    kept = linededup.deduplicated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


@query("op6_document_fingerprints")
def op6(spark, sf_dir):
    return fingerprints.compared(table(spark, sf_dir, "documents"))


@query("op7_sharding")
def op7(spark, sf_dir):
    placed = sharding.shards(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op8_mixing")
def op8(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query("op9_language_id")
def op9(spark, sf_dir):
    return langid.identified(table(spark, sf_dir, "documents"))


@query("op10_best_fit_packing")
def op10(spark, sf_dir):
    return packing.sequences(table(spark, sf_dir, "documents"))


@query("op11_filter_audit", r"""
with labelled as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as bad from labels group by doc_id),
firsts as (select coalesce(text, '') as text, min(doc_id) as first from documents group by 1),
split as (
  select d.doc_id, coalesce(d.lang, '') as part, coalesce(d.text, '') as text, coalesce(l.good, false) as good, coalesce(l.bad, false) as bad,
         regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') as words
  from documents d left join labelled l on d.doc_id = l.doc_id),
failing as (
  select part, good, bad,
         [len(words) < 200,
          100 * len(list_distinct(words)) < 50 * len(words),
          100 * length(regexp_replace(s.text, '[^A-Z]', '', 'g')) > 3 * length(s.text),
          regexp_matches(s.text, '[#$%&*|]'),
          coalesce(s.doc_id > f.first, false)] as fails
  from split s join firsts f on s.text = f.text),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
cells as (select part, fails, count(*) as n, count(*) filter (where good) as n_good, count(*) filter (where bad) as n_bad from failing group by part, fails),
walked as (
  select part, filter_order, cast(step as integer) as step, substr(filter_order, step, 1) as letter, n, n_good, n_bad,
         fails[ascii(substr(filter_order, step, 1)) - 64] as failed,
         len(list_filter(range(1, step), lambda i: fails[ascii(substr(filter_order, cast(i as integer), 1)) - 64])) > 0 as gone,
         len(list_filter(fails, lambda x: x)) = 1 as alone
  from cells, orders, range(1, 6) as steps(step)),
counted as (
  select part, filter_order, step, letter,
         sum(if(not gone and not failed, n, 0)) as kept, sum(if(not gone and failed, n, 0)) as removed, sum(if(gone and failed, n, 0)) as redundant,
         sum(if(failed and alone, n, 0)) as unique_fails, sum(if(not gone and failed, n_good, 0)) as good_lost,
         sum(if(not gone and failed, n_bad, 0)) as toxic_lost
  from walked group by part, filter_order, step, letter)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
       cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from counted""")
def op11(spark, sf_dir):
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_prefix_trie", """
with recursive bytes as (select 0 as i union all select i + 1 from bytes where i < 7),
own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as pos,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
ids as (
  select conv_id, conv_id - conv_id % 100 as base,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::bigint, list_transform(range(1, cast(length(cast(conv_id as varchar)) as bigint) + 1),
                                                           lambda i: ascii(substr(cast(conv_id as varchar), i, 1))::bigint)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(0, 8)),
                                         lambda c, k: xor(c >> 1, 3988292384 * (c & 1))))) % 6 as h
  from (select distinct conv_id from own)),
taken as (
  select i.conv_id, o.pos, o.role, o.text from ids i join own o on o.conv_id = i.base where o.pos < i.h),
n_taken as (select i.conv_id, count(t.pos) as n from ids i left join taken t on t.conv_id = i.conv_id group by i.conv_id),
turns as (
  select * from taken
  union all
  select o.conv_id, o.pos - i.h + n.n, o.role, o.text from own o join ids i on o.conv_id = i.conv_id join n_taken n on n.conv_id = o.conv_id where o.pos >= i.h),
paths as (
  select i.conv_id, coalesce(list({'role': t.role, 'text': t.text} order by t.pos) filter (where t.pos is not null), []) as path
  from ids i left join turns t on t.conv_id = i.conv_id group by i.conv_id),
prefixes as (select conv_id, d as depth, path[1:d] as path, len(path) = d as ended from paths, unnest(range(0, len(path) + 1)) as u(d)),
nodes as (
  select depth, path, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ended), '')) as ends_sha256
  from prefixes group by depth, path),
named as (
  select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes c where c.depth = n.depth + 1 and c.path[1:n.depth] = n.path) as n_children
  from nodes n left join nodes p on p.depth = n.depth - 1 and p.path = n.path[1:n.depth - 1]),
below as (
  select a.depth, a.path, count(*) filter (where b.n_children = 0) as n_leaves,
         sum(if(b.depth = 0, 0, (b.n_convs - 1) * length(b.path[b.depth]['text']))) as saved_tokens
  from named a join named b on b.depth >= a.depth and b.path[1:a.depth] = a.path group by a.depth, a.path)
select n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, b.n_leaves, cast(b.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from named n join below b on b.depth = n.depth and b.path = n.path""")
def op12(spark, sf_dir):
    return prefixtrie.family_trie(table(spark, sf_dir, "conversations")).drop("digest")


@query("op13_decontamination", r"""
with items as (
  select row_number() over () as item, coalesce(cast(item_id as varchar), '') as item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
windows as (
  select distinct item_id, least(10, len(words)) as width, array_to_string(words[w:w + least(10, len(words)) - 1], ' ') as phrase
  from items, unnest(range(1, greatest(len(words) - 10, 0) + 2)) as u(w) where len(words) > 0),
docs as (
  select row_number() over () as doc, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as words
  from documents),
spots as (
  select doc, w, width, array_to_string(words[w:w + width - 1], ' ') as phrase
  from docs, (select distinct width from windows) as widths, unnest(range(1, len(words) - width + 2)) as u(w)),
found as (select s.doc, s.w, s.width, i.item_id from spots s join windows i on s.width = i.width and s.phrase = i.phrase),
hit as (select doc, count(distinct p) as n_hit from found, unnest(range(w, w + width)) as u(p) group by doc),
held as (select doc, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct doc, item_id from found) group by doc)
select d.doc_id, len(d.words) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items, sha256(coalesce(i.ids, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from docs d left join hit h on h.doc = d.doc left join held i on i.doc = d.doc""")
def op13(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_near")
