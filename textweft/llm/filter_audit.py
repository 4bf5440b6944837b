"""How filters interact: what each removes, at each place of every order of applying them.

Rows are summed up by which filters they fail, so that a part has at most ``2**k`` cells
whatever its size. Every cell then folds over the array of all orders: ``transform`` goes
over the orders, ``aggregate`` over the filters of one order with the state of a row that
is still there or gone, and each step yields a struct of counts weighted by the cell. The
arrays of a part's cells are merged by elementwise sums, which Spark sums in each task
before the shuffle. The orders travel as a literal of ``k! * k`` numbers.
"""

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textweft.lookup import lookup_join
from textweft.scratch import materialize

MOST_FILTERS = 6  # 720 orders; the literal and the result grow with k!
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
LEAST_WORDS, DISTINCT_SHARE, CAPITAL_SHARE = 200, 50, 2  # 200 words, 50 and 2 in a hundred
_BLANKS = "[ \\t-\\r]+"  # the ASCII white space characters


def own_failures(text: Column) -> dict[str, Column]:
    """Filters A to D, which look at one text only: short, repetitive, capitals, symbols."""
    words = F.filter(F.split(text, _BLANKS), lambda w: w != "")
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_SHARE * F.size(words),
        "C": 100 * capitals > CAPITAL_SHARE * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def text_failures(docs: DataFrame, keep: list[str], id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns ``keep`` and booleans ``A`` to ``E``: which of the five filters a row fails.

    A: fewer than 200 words. B: fewer than half of the words are distinct. C: more than two
    in a hundred characters are ASCII capitals. D: holds one of ``# $ % & * |``. E: a row with
    a smaller id has the same text. Null texts are empty, and so equal to each other; a text
    without words fails A alone. Rows without id never come earlier than another row and
    fail no E; rows that share an id are no copies of each other. Texts are compared by
    SHA-256; those that occur more than once are looked up by measured broadcast or, beyond
    it, by a join with hot texts apart.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = own_failures(F.col("_text"))
    named = [F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(f"`{id}`").alias("_id"), whole.alias("_text"), *named)
    rows = rows.withColumns(own).withColumn("_digest", F.unhex(F.sha2("_text", 256))).drop("_text")
    rows = materialize(rows, "own-failures")
    texts = rows.groupBy("_digest").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
    repeated = materialize(texts.filter(F.col("_copies") > 1), "repeated-texts")
    met = lookup_join(rows, repeated, "_digest", "left", weight="_copies")
    copy = F.coalesce(F.col("_first") < F.col("_id"), F.lit(False))
    kept = [F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)]
    return met.select(*kept, *own, copy.alias("E"))


def _orders(filters: int) -> Column:
    """All orders of ``filters`` places as one literal, in lexicographic order."""
    return F.array(*[F.array(*map(F.lit, order)) for order in permutations(range(filters))])


def _fold(order: Column, mask: Column, weights: dict[str, Column]) -> Column:
    """One struct of counts per step of an order, for the rows that fail the filters in ``mask``."""
    nothing = F.lit(0).cast("long")

    def counted(when: Column, weight: str) -> Column:
        return F.when(when, weights[weight]).otherwise(nothing)

    def step(there: Column, place: Column) -> Column:
        fails = F.getbit(mask, place) == 1
        only = fails & (F.bit_count(mask) == 1)
        return F.struct(
            place.alias("place"),
            counted(there & ~fails, "n").alias("kept"),
            counted(there & fails, "n").alias("removed"),
            counted(~there & fails, "n").alias("redundant"),
            counted(only, "n").alias("unique_fails"),
            counted(there & fails, "good").alias("good_lost"),
            counted(there & fails, "toxic").alias("toxic_lost"),
        )

    struct = "struct<place:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
    start = F.struct(F.lit(True).alias("there"), F.array().cast(f"array<{struct}>").alias("steps"))

    def walk(state: Column, place: Column) -> Column:
        there = state["there"]
        steps = F.concat(state["steps"], F.array(step(there, place)))
        return F.struct((there & (F.getbit(mask, place) == 0)).alias("there"), steps.alias("steps"))

    return F.aggregate(order, start, walk, lambda state: state["steps"])


def filter_interactions(rows: DataFrame, filters: list[str], part: str, good: str, toxic: str) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``.

    ``filters`` names boolean columns of ``rows`` that say which filters a row fails (null:
    it does not), ``good`` and ``toxic`` boolean columns. One row for each value of ``part``,
    order and step, zeros included; null parts join the empty string, and a table without
    rows has no parts. ``shapley`` sums what a filter removes over all orders. Repeated rows
    count as often as they occur; other columns are not read.
    """
    if not 0 < len(filters) <= MOST_FILTERS or len(set(filters)) < len(filters):
        raise ValueError(f"name 1 to {MOST_FILTERS} different filters")
    bits = [F.when(F.col(f"`{f}`"), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(filters)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask + bit
    cells = rows.groupBy(F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(f"`{good}`")).alias("good"),
        F.count_if(F.col(f"`{toxic}`")).alias("toxic"),
    )
    weights = {c: F.col(c) for c in ("n", "good", "toxic")}
    folded = F.flatten(F.transform(_orders(len(filters)), lambda order: _fold(order, F.col("mask"), weights)))
    steps = cells.select("part", F.posexplode(folded).alias("spot", "s")).select("part", "spot", "s.*")
    merged = steps.groupBy("part", "spot", "place").agg(*[F.sum(c).alias(c) for c in COUNTS])
    names = ["".join(filters[i] for i in order) for order in permutations(range(len(filters)))]
    spot, k = F.col("spot"), len(filters)
    same_filter = Window.partitionBy("part", "place")  # one row per order and so k! / k * k rows
    return merged.select(
        "part",
        F.get(F.array(*map(F.lit, names)), F.floor(spot / k).cast("int")).alias("filter_order"),
        (spot % k + 1).cast("int").alias("step"),
        *COUNTS,
        F.sum("removed").over(same_filter).alias("shapley"),
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, part: str = "source", id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """:func:`filter_interactions` of the five text filters by ``part``.

    A document is good or toxic when some label row of its id says so (``quality`` or
    ``toxic`` is 1); documents without labels are neither.
    """
    said = labels.filter(F.col(id).isNotNull()).groupBy(F.col(id).alias("_labelled"))
    said = said.agg(F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic"))
    said = said.filter(F.col("_good") | F.col("_toxic"))
    read = docs.select(F.col(f"`{id}`").alias("_labelled"), F.col(f"`{part}`").alias("_part"), F.col(f"`{text}`").alias("_body"))
    failed = text_failures(read, ["_labelled", "_part"], "_labelled", "_body")
    judged = lookup_join(failed, said, "_labelled", "left")
    return filter_interactions(judged, list("ABCDE"), "_part", "_good", "_toxic")
