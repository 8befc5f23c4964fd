"""What the learners collect, when one id stands on a large part of the rows."""

import pytest

from tidemark.llm import line_crf, nbsvm


@pytest.mark.parametrize("learner", [line_crf, nbsvm])
def test_a_hot_id_is_collected_once(spark, monkeypatch, learner):
    rows = [(7, f"Some sentence about the number {i}, told at length.") for i in range(400)]
    rows += [(7, None), (8, "BUY NOW | ### $$$ | MORE!!"), (9, "One more sentence, a good one.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 1)], "doc_id long, quality int")
    sent, plain = [], learner.map_batches

    def watched(frame, make, schema):
        found = plain(frame, make, schema)
        sent.append(found.count())
        return found

    monkeypatch.setattr(learner, "map_batches", watched)
    learner.train(df.repartition(5), labels)
    assert sent == [3]
    first, again = learner.train(df, labels), learner.train(df.repartition(7), labels)
    assert repr(first) == repr(again)
