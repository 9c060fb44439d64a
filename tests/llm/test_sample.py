"""The sample that the line model is fitted on."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuescope.llm import quality


def test_sample_is_of_lowest_hash_at_every_size(spark, monkeypatch):
    monkeypatch.setattr(quality, "fit", lambda rows: sorted(map(tuple, rows)))
    rows = [(i, None if i % 3 == 0 else "From: a@b.c\nSubject: x\n\n" + "A line of prose, as it goes.\n" * i) for i in range(400)]
    mails = spark.createDataFrame(rows, "doc_id bigint, text string")
    lowest = mails.where("text IS NOT NULL").orderBy(F.xxhash64("doc_id")).limit(20)
    own, low = quality.own_texts(mails).cache(), quality.own_texts(lowest).cache()
    fitted = quality.fit_on(own.where("size(lines) > 0"), frozenset(), 20)
    assert len(set(fitted)) == 20
    assert fitted == quality.fit_on(low, frozenset(), 20)
