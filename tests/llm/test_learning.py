"""The labelled sample that classifiers learn from is bounded in rows; texts of very many lines go through the chain in pieces."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion_ops.llm import quality_crf
from medallion_ops.llm.learning import labelled_sample


def test_one_labelled_id_on_many_rows_is_one_text(spark):
    docs = spark.range(10_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(8, "other"), (8, "other"), (9, None)], "doc_id bigint, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 0)], "doc_id bigint, toxic int")
    got = labelled_sample(docs, labels, "toxic", F.lit(True), {1: 1, 0: 2})
    assert len(got) == 3 and sorted(y for _, y in got) == [0, 0, 1]
    assert got == labelled_sample(docs.repartition(7), labels, "toxic", F.lit(True), {1: 1, 0: 2})


@pytest.mark.parametrize("piece", [1, 2, 7, 1000])
def test_pieces_give_the_whole_chains_mean(monkeypatch, piece):
    rnd, rng = random.Random(piece), np.random.default_rng(piece)
    monkeypatch.setattr(quality_crf, "PIECE", piece)
    table, theta, trans = quality_crf.class_table(), rng.normal(size=quality_crf.N), rng.normal(size=(2, 2))
    for n in (1, 2, 3, 8, 40):
        text = "\n".join(rnd.choice(["", "A b!", "same line", "x" * 30, "1 | 2 | 3", "The end."]) for _ in range(n))
        own, long, first = quality_crf.line_features([text], table)
        p = quality_crf.good_lines(quality_crf.with_neighbours(own, first), first, theta, trans)
        want = quality_crf._means(p, long, first)[0]
        assert quality_crf.long_text(text, table, theta, trans) == pytest.approx(want, abs=1e-9)


def test_a_megabyte_of_line_breaks_takes_seconds():
    rng = np.random.default_rng(1)
    table, theta, trans = quality_crf.class_table(), rng.normal(size=quality_crf.N), rng.normal(size=(2, 2))
    t = time.process_time()
    assert 0 <= quality_crf.long_text("\n" * 1_000_000, table, theta, trans) <= 1
    assert time.process_time() - t < 20
