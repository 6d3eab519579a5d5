import numpy as np
import pytest
from conftest import prose
from pyspark.sql import functions as F

from freightloom.llm import toxicity


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_features_are_words_and_their_beginnings():
    buckets, owner, words = toxicity.features(["abcd abcd!", "", "ABCD abc"])
    # "abcd": the word and "abc"; "abc": the word alone, which is another feature than the beginning.
    assert np.bincount(owner, minlength=3).tolist() == [4, 0, 3] and words.tolist() == [2, 0, 2]
    assert len(set(buckets.tolist())) == 3
    one, _, _ = toxicity.features(["abcd"])
    assert set(one.tolist()) == set(buckets[owner == 0].tolist())


def test_a_bag_counts_whole_texts(monkeypatch):
    text = "one two two three " * 200
    whole = toxicity.bag(text)
    monkeypatch.setattr(toxicity, "PIECE", 50)
    cut = toxicity.bag(text)
    assert whole[2] == cut[2] == 800 and all(np.array_equal(a, b) for a, b in zip(whole[:2], cut[:2]))
    assert toxicity.bag("")[2] == 0


def _planted(seed, bad):
    words = prose(seed, 60).split()
    return " ".join(words[:30] + (["foulword", "viletalk"] if bad else []) + words[30:])


def test_learns_from_positive_and_unlabelled_texts_alone():
    """A fifth of the unlabelled texts are toxic without saying so."""
    toxic = [toxicity.bag(_planted(k, True)) for k in range(100)]
    unlabelled = [toxicity.bag(_planted(1000 + k, k % 5 == 0)) for k in range(500)]
    model = toxicity.train(toxic, unlabelled, 0.2)
    scores = model.scores([_planted(5000 + k, k % 2 == 0) for k in range(100)])
    assert (scores[::2] >= 0.5).all() and (scores[1::2] < 0.5).all()
    assert (model.weight >= 0).all()


def test_clean_risk_is_kept_from_falling_below_zero():
    """Without any shared sign of toxicity, memorising the confirmed texts does not make other texts of theirs toxic."""
    toxic = [toxicity.bag(prose(k, 60)) for k in range(60)]
    model = toxicity.train(toxic, [toxicity.bag(prose(1000 + k, 60)) for k in range(300)], 0.1)
    assert (model.scores([prose(9000 + k, 60) for k in range(200)]) >= 0.5).mean() < 0.1  # the prior


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    scored = toxicity.with_score(docs.where(toxicity.held_out(F.col("doc_id"))), model, keep=["doc_id"])
    found = scored.join(labels, "doc_id").toPandas()
    bad, good = (found.loc[found["toxic"] == k, "score"].to_numpy() for k in (1, 0))
    assert len(bad) > 80 and found["score"].between(0, 1).all()
    assert (bad[:, None] > good).mean() >= 0.94
    assert (bad >= 0.5).mean() >= 0.7 and (good >= 0.5).mean() <= 0.01


def test_labels_of_held_out_rows_and_of_clean_rows_do_not_matter(spark):
    rows = [(k, _planted(k, k % 3 == 0)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(0, 300, 2)], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    without = labels.where("toxic = 1")
    first, second, third = (toxicity.fit(docs, t, prior=0.33) for t in (labels, turned, without))
    for other in (second, third):
        assert np.array_equal(first.weight, other.weight) and first.bias == other.bias


def test_scores_do_not_depend_on_batches_or_pieces(model, tables, monkeypatch):
    texts = [r.text for r in tables[0].limit(40).collect()] + [None, "", " \n", "a" * 100]
    together = model.scores(texts)
    assert np.allclose(together, [model.scores([t])[0] for t in texts], rtol=0, atol=1e-12)
    monkeypatch.setattr(toxicity, "PIECE", 64)
    assert np.allclose(together, model.scores(texts), rtol=0, atol=1e-2)


def test_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(0, 1), (0, 1), (2, 0), (3, 1), (11, 1), (None, 1), (6, None), (7, 5)], "doc_id long, toxic int")
    wide = odd_docs.selectExpr("*", "1 as toxic", "2 as label", "3 as score", "4 as confirmed")
    found = toxicity.toxicity_scores(wide, labels).collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert all(r.held_out for r in found if r.doc_id is None)
    assert toxicity.toxicity_scores(no_docs, labels).count() == 0
    assert {r.score for r in toxicity.toxicity_scores(odd_docs, labels.where("false")).collect()} == {0.0}
    kept = toxicity.clean(wide, labels)
    assert kept.columns == wide.columns and kept.count() == sum(1 - r.predicted for r in found)
