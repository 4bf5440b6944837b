"""Filter interactions against walking every document through every order."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from textweft import lookup
from textweft.llm.filter_audit import COUNTS, audit_filters, filter_interactions, text_failures


def fails(rows):
    """The filters each (id, text) row fails, read off the conditions."""
    out = []
    for id, text in rows:
        text = text or ""
        for blank in "\t\n\r\v\f":
            text = text.replace(blank, " ")
        words = [w for w in text.split(" ") if w]
        capitals = sum("A" <= c <= "Z" for c in text)
        original = [t or "" for i, t in rows if id is not None and i is not None and i < id]
        own = (dict(rows)[id] or "") if id is not None else None
        out.append(
            "".join(
                name
                for name, hit in {
                    "A": len(words) < 200,
                    "B": 100 * len(set(words)) < 50 * len(words),
                    "C": 100 * capitals > 2 * len(text),
                    "D": any(c in "#$%&*|" for c in text),
                    "E": own is not None and own in original,
                }.items()
                if hit
            )
        )
    return out


def walked(parts, failed, good, toxic):
    out = {}
    for part in set(parts):
        members = [i for i, p in enumerate(parts) if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = members
            for step, name in enumerate(order, 1):
                gone = [i for i in left if name in failed[i]]
                redundant = [i for i in members if i not in left and name in failed[i]]
                left = [i for i in left if name not in failed[i]]
                only = sum(failed[i] == name for i in members)
                counts = len(left), len(gone), len(redundant), only, sum(good[i] for i in gone), sum(toxic[i] for i in gone)
                out[part, "".join(order), step] = counts
                total[name] += len(gone)
        for (p, order, step), counts in list(out.items()):
            if p == part:
                out[p, order, step] = (*counts, total[order[step - 1]])
    return out


def rows_of(frame):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (*COUNTS, "shapley")) for r in frame.collect()}


def texts():
    long = " ".join(f"word{i}" for i in range(250))
    return [
        long, long, long + " #", "A B C", None, "", " \t\v", "same " * 300, "Same " * 300, "x" * 50_000, long.upper(), "a|b", "é" * 30,
    ]


@pytest.mark.parametrize("limit", [None, 0])
def test_equals_walking_all_documents(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    rows = list(enumerate(texts()))
    parts = ["", "b", "b"] + ["a", ""] * 5
    failed = fails(rows)
    good, toxic = {1, 3, 5}, {2, 3, 8}
    docs = spark.createDataFrame(
        [(i, t, None if i % 4 == 0 and not p else p, "own", "own") for (i, t), p in zip(rows, parts)],
        "doc_id long, text string, source string, part string, kept string",
    ).repartition(3)
    labels = spark.createDataFrame(
        [(i, int(i in good), int(i in toxic)) for i in range(9)] + [(1, 0, None), (None, 1, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = rows_of(audit_filters(docs, labels))
    want = walked(parts, failed, {i: i in good for i in range(13)}, {i: i in toxic for i in range(13)})
    assert len(got) == 3 * 600 and got == want


def test_failures_of_hard_texts(hard_docs):
    rows = [(r["doc_id"], r["text"]) for r in hard_docs.collect()]
    got = text_failures(hard_docs.withColumn("spot", F.monotonically_increasing_id()), ["doc_id", "text"]).collect()
    texts_of = {}
    for r in got:
        texts_of.setdefault((r["doc_id"], r["text"]), []).append("".join(c for c in "ABCDE" if r[c]))
    for id, text in rows:
        want = "" if id is None else "E" if any((t or "") == (text or "") and i is not None and i < id for i, t in rows) else ""
        for found in texts_of[id, text]:
            assert ("E" in found) == (want == "E")
            assert ("A" in found) == (len((text or "").split()) < 200) or "\x1f" in (text or "")


def test_empty_tables_and_many_filters(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(none, labels).count() == 0
    one = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, source string")
    found = audit_filters(one, labels)
    assert found.count() == 600 and {r["part"] for r in found.collect()} == {""}
    with pytest.raises(ValueError):
        filter_interactions(one, list("ABCDEFG"), "source", "text", "text")
    two = one.withColumns({"p": F.lit(True), "q": F.lit(None).cast("boolean"), "g": F.lit(True)})
    got = rows_of(filter_interactions(two, ["p", "q"], "source", "g", "q"))
    assert got["", "qp", 1] == (1, 0, 0, 0, 0, 0, 0) and got["", "qp", 2] == (0, 1, 0, 1, 1, 0, 2)
