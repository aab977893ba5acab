"""Long labelled documents in the sample of the quality model."""

from tidegate.llm import quality_model


def test_long_labelled_documents_teach(spark):
    good, bad = "a calm sentence about rivers and hills ", "$$$ WIN!!! free$$$ CLICK!!! now*** "
    texts = spark.createDataFrame([(i, (good if i % 2 else bad) * 700) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in quality_model.score(texts, quality_model.learn(texts, labels)).collect()}
    assert all((scores[i] > 0.5) == (i % 2 == 1) for i in range(40))
