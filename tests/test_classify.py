import numpy as np
import pytest
from pyspark.sql import functions as F

from textweft.operators import classify as c, pooling
from textweft.sources import snapshots


def test_attention_matches_numpy(spark):
    rng = np.random.default_rng(1)
    states, w1, w2 = rng.normal(size=(5, 3)), rng.normal(size=(4, 3)), rng.normal(size=(2, 4))
    ids = [1, 2, 2, 4, 0, 0]  # 0 pads
    logits = np.tanh(states @ w1.T) @ w2.T
    logits[0] -= 10000
    power = np.exp(logits[ids] - logits[ids].max(axis=0))
    alpha = (power / power.sum(axis=0)).T
    want = (alpha @ states[ids]).reshape(-1)
    penalty = np.sqrt(((alpha @ alpha.T - np.eye(2)) ** 2).sum() + 1e-10)

    def table(m, name):
        return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(m)], f"{name} long, vec array<double>")

    vectors = pooling.attention_logits(table(states, "id"), table(w1, "unit"), table(w2, "hop"))
    by_place = spark.createDataFrame([(7, p, i) for p, i in enumerate(ids)], "doc_id long, pos int, id long")
    by_type = by_place.groupBy("doc_id", "id").agg(F.count("*").alias("tf"))
    for rows in (by_place, by_type):
        attended = pooling.attention_weights(rows.join(vectors, "id"), 2)
        assert pooling.pool_attention(attended, 2).first()["vec"] == pytest.approx(want)
        assert pooling.attention_redundancy(attended, 2, 2.0).first()[0] == pytest.approx(2 * penalty)


def test_mean_and_max(spark):
    rows = spark.createDataFrame([(0, 2, [1.0, 5.0]), (0, 1, [4.0, -1.0])], "doc_id long, tf long, vec array<double>")
    assert pooling.pool_mean(rows).first()["vec"] == pytest.approx([2.0, 3.0])
    assert pooling.pool_max(rows).first()["vec"] == [4.0, 5.0]


def test_pad_embeds_to_zero(spark):
    encoded = spark.createDataFrame([(0, [1, 0])], "doc_id long, ids array<long>")
    vectors = spark.createDataFrame([(0, [9.0]), (1, [2.0])], "id long, vec array<float>")
    rows = pooling.embed_tokens(encoded, vectors).orderBy("pos").collect()
    assert [r["vec"] for r in rows] == [[2.0], [0.0]]


@pytest.mark.parametrize("hidden", [None, 4])
def test_training_learns_a_line(spark, hidden, tmp_path):
    rows = spark.range(200).select(
        "id", F.array(F.rand(1) - 0.5, F.rand(2) - 0.5).alias("vec")
    ).withColumn("label", (F.col("vec")[0] + F.col("vec")[1] > 0).cast("int")).cache()
    model = c.train_classifier(rows, 2, hidden=hidden)
    result = c.evaluate(c.predict(model, rows)).first()
    assert result["accuracy"] > 0.9 and result["loss"] < 0.4 and result["n"] == 200
    snapshots.save_model(model, str(tmp_path / "m"))
    again = c.evaluate(c.predict(snapshots.load_pipeline(str(tmp_path / "m")), rows)).first()
    assert again["loss"] == pytest.approx(result["loss"])


def test_report(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)]
    rows = spark.createDataFrame(pairs, "label int, prediction int")
    found = {r["class"]: r for r in c.classification_report(rows).collect()}
    assert found["1"]["precision"] == 0.5 and found["1"]["recall"] == 1.0 and found["2"]["f1"] == 0.0
    assert found["avg / total"]["support"] == 5 and found["avg / total"]["recall"] == pytest.approx(0.6)


def test_select_best(spark):
    rows = [(0, 1.0, 0.5), (1, 0.8, 0.4), (2, 0.9, 0.6), (3, 0.9, 0.6), (4, 0.7, 0.6)]
    epochs = spark.createDataFrame(rows, "epoch int, loss double, accuracy double")
    found = c.select_best(epochs).orderBy("epoch").collect()
    assert [r["best_loss"] for r in found] == [True, True, False, False, True]
    assert [r["best_accuracy"] for r in found] == [True, False, True, False, False]
    assert [r["rate"] for r in found] == pytest.approx([1e-3, 1e-3, 1e-3, 2e-4, 4e-5])
    assert tuple(c.best_epochs(epochs).first()) == (4, 2)


def test_divergence_of_one_hot_truth_is_the_loss(spark):
    rows = spark.createDataFrame([(0, 0, [0.7, 0.3], [1.0, 0.0]), (1, 0, [0.6, 0.4], [0.0, 1.0])],
                                 "label int, prediction int, probability array<double>, truth array<double>")
    assert c.kl_divergence(rows).first()["kl"] == pytest.approx(c.evaluate(rows).first()["loss"])


def test_split_and_shuffle_repeat(spark):
    ids = spark.range(1000)
    a, b = (dict(map(tuple, c.split_rows(ids.repartition(n), "id").collect())) for n in (1, 6))
    assert a == b and 750 < sum(v == "train" for v in a.values()) < 850
    pairs = ids.select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    places = [{r["b"]: r["position"] for r in c.shuffle_rows(pairs.repartition(n), ["a", "b"]).collect()} for n in (1, 6)]
    assert places[0] == places[1] and sorted(places[0].values()) == list(range(1000))
    order = sorted(places[0], key=places[0].get)
    assert sum(x % 7 == y % 7 for x, y in zip(order, order[1:])) < 250 and order != sorted(order)


def test_window_codes_lose_little_of_a_flat_cloud(spark):
    rng = np.random.default_rng(0)
    cloud = rng.normal(size=(100, 2)) @ rng.normal(size=(2, 6)) + 3
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(cloud)], "win_id long, x array<double>")
    codes = c.compress_windows(c.compress_fit(rows, 2), rows)
    assert c.reconstruction_error(codes, 6).first()["mse"] == pytest.approx(0, abs=1e-9)
    one = c.compress_windows(c.compress_fit(rows, 1), rows)
    _, s, _ = np.linalg.svd(cloud - cloud.mean(axis=0))
    assert c.reconstruction_error(one, 6).first()["mse"] == pytest.approx(s[1] ** 2 / 600)


def test_codes_of_even_spread_beat_the_mean(spark):
    """Two of forty nearly even axes hold little more than a twentieth; the best two still do better than others."""
    from textweft.plans.embedding_queries import _beats_mean

    x = np.random.default_rng(1).normal(size=(4000, 40))
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "win_id long, x array<double>")
    model = c.compress_fit(rows, 2)
    codes = c.compress_windows(model, rows)
    mse = c.reconstruction_error(codes, 40).first()["mse"]
    assert mse * 40 > 0.9 * x.var(axis=0).sum()
    assert codes.agg(_beats_mean(model, mse, 40)).first()[0]
    assert not codes.agg(_beats_mean(model, mse * 1.03, 40)).first()[0]
