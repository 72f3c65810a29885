import numpy as np

from tallyspark.llm import cotraining as ct


def test_logistic_fit_meets_the_gradient():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] + rng.normal(size=300) > 0).astype(float)
    w = ct.fit_logistic(x, y)
    grad = x.T @ (ct.chance(ct.raw(w, x)) - y) + w[:-1]
    assert np.abs(grad).max() < 1e-4


def test_held_out_accuracy(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    fitted, held = labels.filter("doc_id % 3 > 0"), labels.filter("doc_id % 3 = 0")
    views = ct.train(docs, fitted, pseudo_rows=40)
    rows = ct.score(docs, views).join(held, "doc_id").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    order = np.mean([[g > b for b in bad] for g in good])
    assert order > 0.95
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in rows]) > 0.9


def test_metadata_teaches_the_text_view(spark):
    # The metadata tells the classes apart; the few labels do not show the words of either.
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(600):
        good = i % 2
        text = " ".join((("fine", "calm", "warm") if good else ("foul", "grim", "vile"))[k] for k in rng.integers(0, 3, 30)) if i >= 100 else "word " * 30
        rows.append((i, text, "s1" if good else "s2", "en", 5000 if good else 50))
        if i < 100:
            labels.append((i, good))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    before, after = ct.train(docs, known, rounds=0), ct.train(docs, known, rounds=1, pseudo_rows=200)

    def right(views):
        x = np.stack([ct.text_features(r[1]) for r in rows[100:]])
        return np.mean((ct.raw(views.weights["text"], x) > 0) == np.array([r[0] % 2 for r in rows[100:]], bool))

    assert right(before) < 0.8 < 0.95 < right(after)


def test_unusual_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "s", "en", -5), (1, "x" * 100_000, None, "en", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    views = ct.train(docs, labels)
    assert views is None
    assert [(r["score"], r["kept"]) for r in ct.score(docs, views).collect()] == [(None, True)] * 3
    assert ct.score(docs.limit(0), views).count() == 0
