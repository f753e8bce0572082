"""V-05 of the text classifier: texts are tokenised once (F5)."""

import random

from tessera.operators import models as M


def test_f5_texts_are_tokenised_once_for_all_folds(spark, monkeypatch):
    """Before: three times in each fold."""
    rnd = random.Random(8)
    words = {"x": ["alpha", "beta", "gamma"], "y": ["delta", "epsilon", "zeta"]}
    df = spark.createDataFrame([(i, " ".join(rnd.choices(words["xy"[i % 2]], k=6)), "xy"[i % 2]) for i in range(40)],
                               "id long, text string, label string")
    asked, read, real = [], [], M.tokens
    fit = M.fit_text_classifier
    monkeypatch.setattr(M, "tokens", lambda c: asked.append(c) or real(c))
    monkeypatch.setattr(M, "fit_text_classifier", lambda train, *a, **b: read.append(train.schema["text"].dataType.typeName()) or fit(train, *a, **b))
    scores = M.cross_validate_text(df, "id", "text", "label", k=2).collect()
    assert asked == ["text"] and read == ["array"] * 2
    assert [r["f1_macro"] for r in scores] == [1.0, 1.0]
