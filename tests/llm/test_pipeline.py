"""Every stage of the pipeline against brute force on its own input, over the smallest tables."""

import os
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from gamecast.llm import pairwise, rules
from gamecast.llm.common import stored
from gamecast.llm.textfeat import labelled_sample

from .test_near import brute_print, classes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def stages(spark):
    """[(name, input, output)] of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        new = stored(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, new))
        docs = new
    return out


def test_order_and_columns(spark, stages):
    assert [n for n, _, _ in stages] == ["quality_rules", "quality_classifier", "line_dedup", "simhash_near_dedup", "best_fit_packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(new.columns == columns for _, _, new in stages[:-1])


def test_quality_stages_keep_what_their_models_accept(spark, stages):
    sample = labelled_sample(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")))
    model, ranker = rules.fit(sample), pairwise.fit(sample)
    for (_, docs, new), keeps in zip(stages, (lambda t: rules.judge(t, model)[-1],
                                              lambda t: pairwise.score(t, ranker) >= pairwise.ACCEPT_AT)):
        want = sorted(r.doc_id for r in docs.collect() if keeps(r.text or ""))
        assert sorted(r.doc_id for r in new.collect()) == want
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = [quality[r.doc_id] for r in stages[1][2].collect() if r.doc_id in quality]
    assert np.mean(kept) > 0.95


def test_line_stage_keeps_the_first_of_equal_lines(stages):
    _, docs, new = stages[2]
    before, after = ({r.doc_id: r.text.split("\n") for r in d.collect()} for d in (docs, new))
    assert set(before) == set(after)
    lines = [line.strip().lower() for d in sorted(after) for line in after[d] if line.strip()]
    assert len(lines) == len(set(lines))
    for d in after:       # what stays are lines of the document, in order
        rest = iter(before[d])
        assert all(line in rest for line in after[d] if line)
    assert all(r.n_chars == len(r.text) for r in new.collect())


def test_simhash_stage_keeps_one_of_each_class(stages):
    _, docs, new = stages[3]
    prints = defaultdict(list)
    for r in docs.collect():
        prints[brute_print(r.text)].append(r.doc_id)
    groups = classes(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 4)
    assert sorted(r.doc_id for r in new.collect()) == sorted(min(d for p in g for d in prints[p]) for g in groups)


def test_packing_stage_packs_every_document(stages):
    _, docs, new = stages[4]
    rows = new.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= sum(fill.values()) // 2048 + 2


def test_empty_documents_pass_through(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_odd_documents_pass_through_every_stage(spark, odd_documents):
    """Nulls, empty and very long texts, repeated rows, columns of clashing names: all stages on one odd table."""
    good = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    docs = good.select("doc_id", "text", F.lit(0.5).alias("score"), F.lit("k").alias("Kept"), "lang").unionByName(
        odd_documents.withColumn("lang", F.lit(None).cast("string")))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stored(stage(spark, docs, SF), f"test-odd-{name}")
        assert new.columns == columns and 0 < new.count() <= docs.count()
        docs = new
    packed = stored(corpus_pipeline.STAGES[-1][1](spark, docs, SF), "test-odd-packed").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    ends = defaultdict(list)
    for r in packed:
        ends[r.sequence_id].append((r.offset, r.length))
    for parts in ends.values():       # gapless from 0, none longer than a sequence
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_odd_rows_alone(spark, odd_documents):
    """A table of odd rows only, which the quality stages may empty."""
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-odd-alone-{name}")
        docs.count()
