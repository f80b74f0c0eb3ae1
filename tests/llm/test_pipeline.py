"""The corpus pipeline stage by stage, and that nothing else depends on the llm part."""

from __future__ import annotations

import os
import random
import re
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from callsieve.llm import jaccard, toxicity
from test_llm_operators import SCHEMA, WORD, odd_rows, words

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.01"
COLUMNS = {"doc_id", "text", "lang", "source", "n_chars"}


@pytest.fixture(scope="module")
def kept(spark):
    """The documents before each stage and after the last."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = corpus_pipeline.written(stage(spark, docs, SF))
    return [*out, docs]


def ids(df):
    return {r[0] for r in df.select("doc_id").collect()}


def test_stages_return_documents(kept):
    assert all(set(df.columns) == COLUMNS for df in kept[:-1]) and len(corpus_pipeline.STAGES) == 5
    assert all(df.filter("n_chars <> length(text)").count() == 0 for df in kept[1:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, kept):
    scored = toxicity.tagged(kept[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert ids(kept[1]) == {r["doc_id"] for r in scored if r["predicted"] == 0}
    assert 0 < kept[0].count() - kept[1].count() < 0.2 * kept[0].count()


def test_lines_go_but_documents_stay(kept):
    assert ids(kept[2]) == ids(kept[1])
    assert kept[2].agg(F.sum("n_chars")).first()[0] < kept[1].agg(F.sum("n_chars")).first()[0]


def test_one_of_each_group_stays(kept):
    groups = jaccard.joined(kept[2]).collect()
    assert ids(kept[3]) == {r["doc_id"] for r in groups if r["component_id"] == r["doc_id"]}
    assert kept[3].count() == len(ids(kept[3])) < kept[2].count()


def test_mixed_words_are_packed_whole(kept):
    words = sum(len(WORD.findall(r[0])) for r in kept[3].select("text").collect())
    mixed = sum(len(WORD.findall(r[0])) for r in kept[4].select("text").collect())
    assert abs(mixed - words) < 0.02 * words and ids(kept[4]) <= ids(kept[3])
    packed = kept[5].toPandas()
    assert set(packed.doc_id) == ids(kept[4]) and packed.groupby("sequence_id").length.sum().max() <= 2048


def test_run_equals_the_stages(spark, kept):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == kept[5].columns and got.agg(F.sum("length")).first() == kept[5].agg(F.sum("length")).first()


def test_stages_take_odd_rows(spark, tmp_path):
    spark.createDataFrame([(10, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = corpus_pipeline.written(stage(spark, rows, str(tmp_path)))
            rows.count()


def test_rows_without_an_id_or_with_a_shared_one_stay(spark):
    rng = random.Random(4)
    texts = [words(rng, 80) for _ in range(6)]
    docs = [(None, t) for t in texts[:3]] + [(7, texts[3]), (7, texts[4]), (None, ""), (None, None), (8, ""), (None, "")]
    copies = [(None, texts[0] + " tail"), (7, texts[3]), (9, texts[4] + " tail"), (3, texts[1] + " tail"), (None, texts[5]), (None, texts[5] + " tail")]
    table = spark.createDataFrame([(i, t, "en", "s1", len(t or "")) for i, t in docs + copies], SCHEMA)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, table, SF).collect()]
    assert sum(not t for _, t in got) == 4 and len(got) == 10
    assert {(7, texts[3]), (7, texts[4]), (3, texts[1] + " tail"), (None, texts[2])} <= set(got)
    for i in (0, 5):
        assert sum(t in (texts[i], texts[i] + " tail") for _, t in got) == 1


def test_every_operator_has_a_query_and_nothing_else_imports_the_part():
    names = entry_module.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    for folder, _, files in os.walk(f"{ROOT}/callsieve"):
        for name in files:
            if name.endswith(".py") and not folder.endswith("llm"):
                text = open(f"{folder}/{name}").read()
                assert not re.search(r"(from|import) .*\bllm\b|corpus_pipeline", text), name


def test_the_rest_imports_without_the_part(tmp_path):
    """In a copy that lacks the part."""
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/callsieve", tmp_path / "callsieve", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sum(n.startswith('op') for n in e.queries()), len(e.queries()) > 100)"],
                          cwd=tmp_path, capture_output=True, text=True)
    assert said.stdout.strip() == "0 True", said.stderr
