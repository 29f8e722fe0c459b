"""Thresholds of toxicity come from all labelled rows, not from the bounded sample."""

import random

from tracewell.llm import toxicity


def test_rare_language_has_its_own_threshold(spark):
    rng = random.Random(14)
    rows, labels = [], []
    for k in range(4000):
        lang, toxic = "es" if k % 10 == 0 else "en", k % 3 == 0
        text = " ".join(rng.choice("casa perro sol mar luz pan rio voz".split()) for _ in range(12))
        rows.append((k, text + (" stupid idiot" if toxic else ""), lang))
        labels.append((k, int(toxic)))
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = toxicity.fit(documents, spark.createDataFrame(labels, "doc_id long, toxic int"), 60)
    assert sorted(model.thresholds) == ["en", "es"]


def test_threshold_of_counts():
    assert toxicity.best_threshold([5], [0.0], [3.0], 0.3) == 0.3
    cut = toxicity.best_threshold([-64, 63, 128], [0.0, 4.0, 2.0], [9.0, 0.0, 0.0], 0.3)
    assert abs(cut - 0.5) < 1e-9
