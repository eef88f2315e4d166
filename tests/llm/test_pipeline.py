import re
from collections import Counter

import corpus_pipeline
import pytest
from helpers import documents, odd_rows
from test_jaccard_join import brute

from silverline.llm import pii, quality_mil
from silverline.llm.common import shared_folder


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    """What each stage makes of what its predecessor wrote."""
    docs, out, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}, f"{shared_folder(spark)}/stages-{id(spark)}"
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return {name: (df.columns, df.collect()) for name, df in out.items()}


def test_columns(tables):
    columns = tables["documents"][0]
    assert all(tables[name][0] == columns for name, _ in corpus_pipeline.STAGES[:-1])


def test_quality_keeps_what_the_classifier_accepts(spark, sf_dir, tables):
    docs, marks = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    accepted = {r.doc_id for r in quality_mil.classify(docs, marks).collect() if r.predicted}
    assert sorted(tables["quality"][1]) == sorted(r for r in tables["documents"][1] if r.doc_id in accepted)


def test_one_of_each_group_stays(tables):
    before = tables["quality"][1]
    lowest = {c for _, _, c in brute([(r.doc_id, r.text) for r in before])}
    assert sorted(tables["near_duplicates"][1]) == sorted(r for r in before if r.doc_id in lowest)


def test_texts_are_masked(tables):
    before, after = ({r.doc_id: r for r in tables[name][1]} for name in ("near_duplicates", "personal_data"))
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.text == pii.masked_text(before[i].text) and r.n_chars == len(r.text)
        assert pii.base_spans(r.text) == []


def test_mix_and_packing(tables):
    known = {r.doc_id: r for r in tables["personal_data"][1]}
    mixed = tables["mixing"][1]
    assert all(r == known[r.doc_id] for r in mixed)
    words = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert abs(sum(map(words, mixed)) / sum(map(words, known.values())) - 1) < 0.1
    packed = tables["packing"][1]
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in mixed)


def test_run(spark, sf_dir, tables):
    pieces = lambda rows: Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows)
    assert pieces(corpus_pipeline.run(spark, sf_dir).collect()) == pieces(tables["packing"][1])


def test_odd_rows_pass_every_stage(spark, sf_dir):
    for rows in (odd_rows(), []):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, sf_dir)
            assert made.columns == docs.columns
            docs = spark.createDataFrame(made.collect(), docs.schema)
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
