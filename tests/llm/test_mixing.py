import math

import pytest
from pyspark.sql import functions as F

from freightloom.llm import mixing


def sources(spark, tokens):
    return spark.createDataFrame([(str(k), n) for k, n in enumerate(tokens)], "name string, tokens long")


def entropy(tokens, power):
    raised = [n**power for n in tokens]
    return -sum(r / sum(raised) * math.log(r / sum(raised)) for r in raised)


@pytest.mark.parametrize("target", [0.8, 0.9, 0.99])
def test_exponent_meets_the_entropy(spark, target):
    tokens = [1_000_000, 30_000, 2_000, 500]
    found = mixing.exponent(sources(spark, tokens), target_entropy=target)
    assert entropy(tokens, found) == pytest.approx(target * math.log(4), abs=1e-8)


def test_exponent_meets_the_repetition_limit(spark):
    tokens = [1_000_000, 30_000, 2_000]
    found = mixing.exponent(sources(spark, tokens), max_repeats=3.0)
    assert 500 ** (1 - found) == pytest.approx(3.0, abs=1e-6) and 500 ** (1 - found) <= 3.0
    assert mixing.exponent(sources(spark, tokens), target_entropy=1.0, max_repeats=3.0) == found
    assert mixing.exponent(sources(spark, [10, 11]), max_repeats=3.0) < 1e-9


def test_exponent_without_need(spark):
    assert mixing.exponent(sources(spark, [5, 4, 3])) == 1.0
    assert mixing.exponent(sources(spark, [5])) == mixing.exponent(sources(spark, [])) == 1.0
    assert mixing.exponent(sources(spark, [5, 4, 3]), target_entropy=0.1) == 1.0


@pytest.fixture(scope="module")
def skewed(spark):
    """Source a holds most rows, b and c less, and each document has as many words as its id says."""
    name = F.when(F.col("doc_id") < 600, "a").when(F.col("doc_id") < 800, "b").otherwise("c")
    rows = spark.range(850).select(F.col("id").alias("doc_id"))
    return rows.withColumn("source", name).withColumn("text", F.repeat(F.lit("w "), (F.col("doc_id") % 7 + 1).cast("int")))


def test_blocks_are_read_within_the_budget(skewed):
    block = 50
    found = mixing.mixed(skewed, max_repeats=3.0, block_tokens=block, budget_tokens=9000).toPandas()
    found["tokens"] = found["doc_id"] % 7 + 1
    plain = skewed.toPandas()
    plain["tokens"] = plain["doc_id"] % 7 + 1
    for name, rows in found.groupby("source"):
        budget = 9000 * rows["_mix_weight"].iloc[0]
        have = plain.loc[plain["source"] == name, "tokens"].sum()
        took = rows["tokens"].sum()
        assert took <= budget * (1 + 1e-6) and took > budget - 4 * block
        whole = int(budget // have)
        for epoch in range(whole):
            assert len(rows[rows["_mix_epoch"] == epoch]) == (plain["source"] == name).sum()
        last = rows[rows["_mix_epoch"] == whole]
        # The last epoch holds whole blocks, and those that come first in its order.
        size = plain[plain["source"] == name].shape[0]
        full = rows[rows["_mix_epoch"] == 0].groupby("_mix_block").size() if whole else None
        if whole and len(last) and len(last) < size:
            assert (last.groupby("_mix_block").size() == full[last["_mix_block"].unique()].sort_index()).all()
        assert rows["_mix_epoch"].max() <= whole
    weights = found.groupby("source")["_mix_weight"].first()
    assert weights.sum() == pytest.approx(1.0)


def test_default_budget_reads_every_document(skewed):
    found = mixing.mixed(skewed, max_repeats=2.0, block_tokens=50)
    assert found.select("doc_id").distinct().count() == 850
    assert found.where("source = 'a'").count() == 600
    assert found.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2


def test_epochs_have_orders_of_their_own(skewed):
    found = mixing.mixed(skewed, max_repeats=2.0, block_tokens=50, budget_tokens=20_000)
    orders = found.where("source = 'c' and _mix_epoch < 2").select("_mix_epoch", "_mix_block", "_mix_order").distinct().toPandas()
    first, second = (list(orders[orders["_mix_epoch"] == e].sort_values("_mix_order")["_mix_block"]) for e in (0, 1))
    assert sorted(first) == sorted(second) and first != second


def test_odd_rows(odd_docs, no_docs):
    found = mixing.mixed(odd_docs)
    assert found.columns[: len(odd_docs.columns)] == odd_docs.columns
    key = ["doc_id", "text", "source"]
    whole = odd_docs.groupBy(*key).count().collect()
    read = {tuple(r[:3]): r[3] for r in found.where("_mix_epoch = 0").groupBy(*key).count().collect()}
    assert read == {tuple(r[:3]): r[3] for r in whole}
    assert mixing.mixed(no_docs).count() == 0
    assert mixing.mixed(odd_docs, max_repeats=None, budget_tokens=1).count() == 0


def test_query_reads_every_document(spark, sf_dir):
    from freightloom.llm.queries import QUERIES

    found = QUERIES["op6_temperature_mixing"](spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source").toPandas()
    assert set(found["doc_id"]) == set(docs["doc_id"])
    assert found.groupby("source")["weight"].first().sum() == pytest.approx(1.0)


def test_query_meets_its_weights_within_a_few_documents(spark, sf_dir):
    from freightloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", mixing.token_count(F.col("text")).alias("tokens"))
    found = QUERIES["op6_temperature_mixing"](spark, sf_dir).join(docs, "doc_id").toPandas()
    once = found[found["epoch"] == 0].groupby("source")["tokens"]
    have, longest, weight = once.sum(), once.max(), found.groupby("source")["weight"].first()
    budget = (have / weight).max() * weight
    short = budget - found.groupby("source")["tokens"].sum()
    assert len(have) > 1 and (budget / have).max() > 1.2
    assert (short >= -1e-6 * budget).all() and (short <= 3 * longest).all()
