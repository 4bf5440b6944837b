"""Word vectors that come from outside."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweft.functions.vectors import doubles
from textweft.lookup import lookup_join

# Names of the special words.
UNKNOWN = "**UNKNOWN**"
UNKNOWN_CAPITAL = "**UNKNOWN_CAP**"
PADDING = "**PADDING_WORD**"
PAD = "<pad>"


def vectors_from_matrix(matrix: DataFrame, id: str, vec: str, word: str) -> DataFrame:
    """``(id, word, vec)`` of an external matrix; row 0 stands for unknown words."""
    name = F.when(F.col(id) == 0, F.lit(UNKNOWN)).otherwise(F.col(word))
    return matrix.select(F.col(id).alias("id"), name.alias("word"), doubles(F.col(vec)).alias("vec"))


def load_pretrained(vocab: DataFrame, pretrained: DataFrame, dim: int) -> DataFrame:
    """Overwrite ``vocab(word, vec, …)`` where ``pretrained(word, vec)`` has the word.

    External vectors are cut to ``dim``; the pad row is zero. ``loaded`` tells which
    rows were overwritten.
    """
    theirs = pretrained.select("word", F.slice(doubles(F.col("vec")), 1, dim).alias("_theirs"))
    joined = lookup_join(vocab, theirs, "word", "left")
    zero = F.array_repeat(F.lit(0.0), dim)
    return joined.withColumns(
        {
            "vec": F.when(F.col("word") == PAD, zero).otherwise(F.coalesce("_theirs", doubles(F.col("vec")))),
            "loaded": F.col("_theirs").isNotNull() & (F.col("word") != PAD),
        }
    ).drop("_theirs")


def words_loaded(vectors: DataFrame) -> DataFrame:
    return vectors.agg(F.count_if("loaded").alias("n_loaded"), F.count(F.lit(1)).alias("n_words"))
