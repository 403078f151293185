import random

import numpy as np
import pyarrow as pa
import pytest
from brute import katz

from gleaner.llm import classifier
from gleaner.llm import katz as model

SF = "/root/testdata/sf0.01"

ROWS = [
    (1, None), (2, ""), (None, "a b c"), (3, "word " * 5000), (4, "a b A b c d"), (5, "x y z a b"), (5, "x y z a b"),
    (6, "A B q r s t u v w"), (7, "the the a"), (8, "a b c d e f g h"), (12, "b c new words here a"), (30, "a b c z"), (31, "É é"),
]


def close(got, want):
    got = sorted(map(tuple, got), key=str)
    want = sorted(want, key=str)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5:] for x in got], [x[5:] for x in want], rtol=1e-9)


@pytest.mark.parametrize("often", [model.HOT, 3])
def test_katz(spark, often):
    df = spark.createDataFrame([(*r, 0.5) for r in ROWS], "doc_id long, text string, score double")
    want, sums = katz(ROWS)
    assert np.allclose(sums, 1)  # every history's probabilities, the unknown word's included
    close(model.score(df, bundle_words=4, often=often).collect(), want)


def test_katz_on_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("doc_id < 300")
    close(model.score(df, bundle_words=20_000, often=500).collect(), katz([tuple(r) for r in df.collect()])[0])


def test_katz_without_training(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert model.score(df.limit(0)).count() == 0
    row = model.score(df.filter("doc_id IS NULL")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.score) == (True, 4, 0, 0, 0.0)


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(5)
    good = rng.random(20_000) < 0.8
    hit = [0.9, 0.8, 0.95, 0.7]
    votes = np.stack([np.where(rng.random(len(good)) < h, np.where(good, 2, 0), np.where(good, 1, 1)) for h in hit], 1)
    votes[rng.random(votes.shape) < 0.02] = 0
    votes[rng.random(votes.shape) < 0.05] = classifier.ABSENT
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    fitted = classifier.estimate(patterns, counts.astype(float))
    assert abs(fitted.prior[1] - good.mean()) < 0.02
    assert ((fitted.posterior(patterns)[which.ravel()] > 0.5) == good).mean() > 0.98


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = classifier.fit(docs).judge(docs)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = judged.join(labels, "doc_id").select("kept", "quality").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [not r.kept for r in rows if r.quality == 0]
    assert sum(good) > 0.98 * len(good) and sum(bad) > 0.95 * len(bad)
    assert judged.count() == docs.count()


def test_texts_that_only_the_labellers_find(spark):
    """Bad by stop words, word length or repeated lines, though their words look like those of good texts."""
    draw = random.Random(1)
    word = lambda n, letters="abcdefghijklmnopqrstuvwxyz": "".join(draw.choices(letters, k=n))
    texts = [
        " ".join(draw.choices("cheap tickets hotel booking flights deals online".split(), k=200)),
        " ".join(word(28) for _ in range(150)),
        "\n".join(["Welcome to the best page of the whole town."] * 60),
        " ".join(word(draw.randrange(3, 8), "bcdfghjklmnpqrstvwxz") for _ in range(200)),
        "The man went to the river and looked at the boats that were on the water, and then he walked home to his house in the town. "
        "It was late, and the lamps of the street were lit when his wife saw him from the window and called the children.",
    ]
    model = classifier.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r.doc_id: r for r in model.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert [got[i].kept for i in range(5)] == [False, False, False, False, True]
    assert all(got[i].score < classifier.SURE for i in range(4))


def test_measures_by_hand():
    text = "The the cat | sat.\n\nAB #1 word\nAB #1 word"
    m = classifier.Measured(pa.array([text, "", "x"], pa.string()))
    values = {k: v[0] for k, v in m.values.items()}
    assert m.n_words.tolist() == [11, 0, 1] and np.isnan([v[1] for v in m.values.values()]).all()
    assert values == pytest.approx({
        "symbols": 3 / 11, "upper": 5 / 30, "stops": 2 / 11, "word_length": 30 / 11, "again": 0, "variety": 8 / 11**0.5, "piped": 1 / 3,
        "distinct_lines": 2 / 3, "closed": 1 / 3,
    })
    row, place, value = classifier.features(m)
    assert (np.diff(row * classifier.FEATURES + place) > 0).all() and (value > 0).all() and 1 not in row


def test_classifier_on_odd_tables(spark):
    df = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "a b c", "s"), (3, "word " * 20000, "s"), (3, "x y", "s")], "doc_id long, text string, score string")
    got = classifier.fit(df).judge(df).collect()
    assert len(got) == 5 and all(not r.kept and r.score == 0 for r in got if r.doc_id in (1, 2))
    assert classifier.filtered(df).columns == df.columns
    assert classifier.fit(df.limit(0)).judge(df.limit(0)).count() == 0


def test_quality_texts_are_measured_in_small_parts_with_the_same_values():
    import numpy as np
    import pyarrow as pa

    from gleaner.llm import classifier

    texts = [f"Some words of text {n}, and a few more. " * (40 + 997 * n % 3000) for n in range(90)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(classifier.by_chunks(iter([batch])))
    assert sum(p.num_rows for p in parts) == 90
    assert max(sum(len(x) for x in p["text"].to_pylist()) for p in parts) <= (1 << 20) + max(map(len, texts))
    whole, cut = classifier.Measured(batch["text"]), [classifier.Measured(p["text"]) for p in parts]
    for name, values in whole.values.items():
        np.testing.assert_array_equal(values, np.concatenate([m.values[name] for m in cut]))
