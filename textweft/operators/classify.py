"""Training and judging classifiers, and compressing windows."""

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textweft.functions.vectors import doubles, hash_uniform, vector_width
from textweft.lookup import attach, lookup_join
from textweft.operators.axes import Axes, along_axes, fit_axes
from textweft.ordered import number_rows


def _features(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector(doubles(F.col("vec"))))


def train_classifier(
    rows: DataFrame, classes: int, hidden: int | None = None, max_iter: int = 100, seed: int = 1, regularization: float = 0.0
) -> PipelineModel:
    """Fit ``rows(vec, label)``: a hidden layer and softmax, or logistic regression without one."""
    data = _features(rows).withColumn("label", F.col("label").cast("double"))
    if hidden is None:
        stage = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=regularization)
    else:
        width = vector_width(rows)
        stage = MultilayerPerceptronClassifier(layers=[width, hidden, classes], maxIter=max_iter, seed=seed)
    return Pipeline(stages=[stage]).fit(data)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``probability array<double>`` and ``prediction``."""
    scored = model.transform(_features(rows)).drop("features", "rawPrediction")
    return scored.withColumns(
        {"probability": vector_to_array("probability"), "prediction": F.col("prediction").cast("int")}
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row ``(n, loss, accuracy)`` of ``predictions(label, prediction, probability)``.

    The loss is the mean cross-entropy, a true mean over rows.
    """
    p = F.get("probability", F.col("label").cast("int"))
    return predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(-F.log(F.greatest(p, F.lit(1e-300)))).alias("loss"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
    )


def kl_divergence(predictions: DataFrame, truth: str = "truth") -> DataFrame:
    """One row ``(kl)``: the mean of ``Σ p·ln(p/q)`` of true and predicted distributions."""
    pairs = F.arrays_zip(F.col(truth).alias("p"), F.col("probability").alias("q"))
    terms = F.aggregate(
        pairs,
        F.lit(0.0),
        lambda total, x: total + F.when(x["p"] > 0, x["p"] * F.log(x["p"] / x["q"])).otherwise(0.0),
    )
    return predictions.agg(F.avg(terms).alias("kl"))


def classification_report(predictions: DataFrame) -> DataFrame:
    """``(class, precision, recall, f1, support)`` per class, and the weighted ``avg / total``."""
    sides = predictions.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.lit(1).alias("is_label")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).alias("is_label")),
            )
        ).alias("s"),
        (F.col("label") == F.col("prediction")).alias("hit"),
    )
    counts = sides.groupBy("s.class").agg(
        F.sum("s.is_label").alias("support"),
        F.sum(1 - F.col("s.is_label")).alias("predicted"),
        F.count_if(F.col("hit") & (F.col("s.is_label") == 1)).alias("hits"),
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    per_class = counts.select(
        F.col("class").cast("string").alias("class"),
        ratio(hits, predicted).alias("precision"),
        ratio(hits, support).alias("recall"),
        ratio(2 * hits, support + predicted).alias("f1"),
        "support",
    )
    total = F.sum("support")
    average = per_class.agg(
        F.lit("avg / total").alias("class"),
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in ("precision", "recall", "f1")],
        total.alias("support"),
    )
    return per_class.unionByName(average)


def select_best(epochs: DataFrame, rate: float = 0.001, decay: float = 0.2) -> DataFrame:
    """``epochs(epoch, loss, accuracy)`` with the running choice of models and learning rates.

    ``best_loss`` marks an epoch that lowers the loss, ``best_accuracy`` one that raises
    the accuracy; after an epoch that does not lower the loss the rate shrinks.
    """
    earlier = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    flagged = epochs.select(
        "*", F.min("loss").over(earlier).alias("_loss"), F.max("accuracy").over(earlier).alias("_accuracy")
    ).select(
        *epochs.columns,
        (F.col("_loss").isNull() | (F.col("loss") < F.col("_loss"))).alias("best_loss"),
        (F.col("_accuracy").isNull() | (F.col("accuracy") > F.col("_accuracy"))).alias("best_accuracy"),
    )
    failures = F.coalesce(F.sum(F.when(F.col("best_loss"), 0).otherwise(1)).over(earlier), F.lit(0))
    return flagged.withColumn("rate", rate * F.pow(F.lit(decay), failures))


def best_epochs(epochs: DataFrame) -> DataFrame:
    """One row: the epochs of lowest loss and of highest accuracy; the first wins a tie."""
    return epochs.agg(
        F.min_by("epoch", F.struct("loss", "epoch")).alias("best_loss_epoch"),
        F.min_by("epoch", F.struct(-F.col("accuracy"), "epoch")).alias("best_accuracy_epoch"),
    )


def label_lookup(rows: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Attach labels by text or id; rows without a label are dropped."""
    return lookup_join(rows, labels, key)


def neighbour_labels(neighbours: DataFrame, predictions: DataFrame) -> DataFrame:
    """Join ``neighbours(query_id, id, score, rank)`` with predicted and actual classes."""
    return attach(neighbours, predictions.select("id", "prediction", "label"), "id")


def shuffle_rows(rows: DataFrame, keys: Sequence[str], seed: int = 1, name: str = "position") -> DataFrame:
    """Add each row's place in a repeatable random order; ``keys`` tell the rows apart.

    The order follows a digest of all keys, so rows that share one of them part as well.
    """
    mixed = rows.withColumn("_mixed", F.xxhash64(F.lit(seed), *keys))
    return number_rows(mixed, ["_mixed", *keys], name, label="shuffled").drop("_mixed")


def split_rows(rows: DataFrame, key: str, train: float = 0.8, validation: float = 0.1, seed: int = 1) -> DataFrame:
    """Add ``part``: train, validation or test by the hash of the key."""
    u = hash_uniform(F.lit(seed), F.col(key))
    part = F.when(u < train, "train").when(u < train + validation, "validation").otherwise("test")
    return rows.withColumn("part", part)


# ---------------------------------------------------------------- window codes


def compress_fit(windows: DataFrame, k: int = 100) -> Axes:
    """Fit a linear code of ``windows(win_id, x)``: the main axes of the centred vectors."""
    return fit_axes(windows.select(doubles(F.col("x")).alias("x")), k)


def compress_windows(model: Axes, windows: DataFrame) -> DataFrame:
    """``(win_id, code)`` and the squared reconstruction error of each window."""
    return along_axes(windows.select("win_id", doubles(F.col("x")).alias("x")), model, "win_id")


def reconstruction_error(compressed: DataFrame, width: int) -> DataFrame:
    """One row ``(mse)``."""
    return compressed.agg((F.avg("squared_error") / width).alias("mse"))
