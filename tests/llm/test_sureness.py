"""What language ID of the pipeline drops depends on what the model is sure of."""

import corpus_pipeline as pipeline
from tidemill.llm import langid


def test_words_of_no_sure_language_are_dropped(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some words here", "en"), (2, None, "de"), (3, "12 34", "de")],
                                 "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "fit", lambda rows: langid.Model(["a", "b", "c", "d"]))
    assert pipeline.language_id(spark, docs, "").count() == 0
    monkeypatch.setattr(langid, "fit", lambda rows: langid.Model(["a"]))
    assert [r.doc_id for r in pipeline.language_id(spark, docs, "").collect()] == [1]
