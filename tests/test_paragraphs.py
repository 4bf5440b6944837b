import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textweft.operators import paragraphs as p
from textweft.operators.weight_table import WeightTable
from textweft.scratch import materialize
from textweft.sources import snapshots

SENTENCES = [
    "the cat sat on the mat", "the dog sat on the log", "a cat and a dog ran", "the mat and the log lay",
    "a dog ran on the mat", "the cat lay on a log", "the cat sat on the mat",
]


@pytest.fixture(scope="module")
def tokens(spark):
    rows = [(i, s.split()) for i, s in enumerate(SENTENCES * 4)]
    return spark.createDataFrame(rows, "doc_id long, words array<string>").cache()


def test_codes_are_prefix_free_and_short(spark):
    counts = [1000, 300, 300, 40, 8, 7, 5, 1, 1]
    vocab = spark.createDataFrame([(f"w{i}", i, c) for i, c in enumerate(counts)], "word string, id long, cf long")
    rows = p.code_paths(p.code_table(vocab)).orderBy("id").collect()
    codes = ["".join(map(str, r["code"])) for r in rows]
    assert not any(a != b and b.startswith(a) for a in codes for b in codes)
    total = sum(counts)
    for count, code, r in zip(counts, codes, rows):
        assert len(code) <= math.ceil(math.log2(total / count)) + 1
        assert r["point"][0] == 1 and len(r["point"]) == len(code)


def plain_epoch(docs, leaves, words, nodes, paras, alpha, window, mode, scale):
    """The same training, one place at a time in plain loops."""
    error = 0.0
    for d, ids in enumerate(docs):
        work = np.zeros_like(paras[d])
        for i in range(len(ids)):
            near = [ids[j] if 0 <= j < len(ids) else -1 for j in range(i - window, i + window + 1) if j != i]
            ctx = np.array([words[n] for n in near])
            x = np.concatenate([paras[d], ctx.reshape(-1) if mode == "concat" else ctx.mean(axis=0)])
            back = np.zeros_like(x)
            bits = bin(leaves[ids[i]])[3:]
            olds = {}
            for level, bit in enumerate(bits):
                node = leaves[ids[i]] >> (len(bits) - level)
                f = x @ nodes[node]
                if abs(f) >= 6:
                    continue
                miss = 1 - int(bit) - 1 / (1 + math.exp(-f))
                error += miss * miss
                back += miss * alpha * nodes[node]
                olds[node] = miss * alpha * x
            for node, step in olds.items():
                nodes[node] = nodes[node] + step
            size = len(paras[d])
            work += back[:size]
            spread = back[size:].reshape(len(near), -1) if mode == "concat" else np.tile(back[size:] / len(near), (len(near), 1))
            for n, step in zip(near, spread):
                words[n] = words[n] + step
        paras[d] = paras[d] + (work / len(ids) if scale else work)
    return error


@pytest.mark.parametrize("mode, scale", [("mean", False), ("concat", True)])
def test_block_training_equals_plain_loops(mode, scale):
    rng = np.random.default_rng(4)
    docs = [[0, 1, 2, 1], [3, 0], [2, 2, 4, 0, 1]]
    leaves = {0: 0b10, 1: 0b1100, 2: 0b1101, 3: 0b11100, 4: 0b11101}
    s = p.Settings(size=3, paragraph_size=2, window=2, mode=mode, scale_updates=scale, decay=False, batch=1)
    words = {i: rng.normal(size=3) for i in (-1, 0, 1, 2, 3, 4)}
    nodes = {n: rng.normal(size=s.input_size) for leaf in leaves.values() for n in [leaf >> k for k in range(1, leaf.bit_length())]}
    paras = [rng.normal(size=2) for _ in docs]
    pad_key = 9 * 4
    keys = [(pad_key if i < 0 else i * 4, v) for i, v in words.items()]
    keys += [(n * 4 + 1, v) for n, v in nodes.items()] + [(d * 4 + 2, v) for d, v in enumerate(paras)]
    right = pd.DataFrame({"key": [k for k, _ in keys], "vec": [v.copy() for _, v in keys]})
    left = pd.DataFrame({"para_id": [0, 1, 2], "ids": [np.array(d) for d in docs],
                         "leaves": [np.array([leaves[i] for i in d]) for d in docs], "pos": 0})
    out = p._train_block(left, right, s, 0.1, 0, pad_key, False)
    error = plain_epoch(docs, leaves, words, nodes, paras, 0.1, 2, mode, scale)
    got = {r.key: r.vec for r in out.itertuples()}
    assert out["error"].sum() == pytest.approx(error)
    for i, v in words.items():
        assert got[pad_key if i < 0 else i * 4] == pytest.approx(v)
    for n, v in nodes.items():
        assert got[n * 4 + 1] == pytest.approx(v)
    for d, v in enumerate(paras):
        assert got[d * 4 + 2] == pytest.approx(v)


def settings(**changes):
    return p.Settings(**{"size": 8, "paragraph_size": 8, "window": 2, "alpha": 0.3, "batch": 4, **changes})


@pytest.mark.parametrize("mode", ["mean", "concat"])
def test_error_falls(spark, tokens, mode, monkeypatch):
    monkeypatch.setattr(p, "BLOCK_WORDS", 60)
    model = p.pvdm_fit(tokens, settings(mode=mode), min_count=2, max_iter=4)
    errors = [row[3] for row in model.epochs]
    assert errors[-1] < errors[0]
    assert [row[1] for row in model.epochs] == pytest.approx([0.3, 0.2, 0.1, 0.0])
    # copies of a sentence share one paragraph
    assert model.paragraph_vectors().count() == len(set(SENTENCES)) == 6


def test_training_repeats_whatever_the_partitions(tokens):
    runs = [
        p.pvdm_fit(tokens.repartition(n), settings(random_window=True), min_count=2, max_iter=1).epochs for n in (1, 5)
    ]
    assert runs[0] == runs[1]


def test_inference_leaves_words_and_tree_alone(spark, tokens):
    model = p.pvdm_fit(tokens, settings(), min_count=2, max_iter=1)
    fresh = spark.createDataFrame([(0, "the cat ran home".split()), (1, ["zebra"])], "doc_id long, words array<string>")
    inferred = p.pvdm_infer(model, fresh, max_iter=2)
    assert inferred.paragraph_vectors().count() == 2
    for a, b in ((model.word_vectors(), inferred.word_vectors()), (model.node_vectors(), inferred.node_vectors())):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_one_epoch_does_not_divide_by_zero():
    assert p._schedule(0.035, 0, 1) == 0.035


def test_pretraining_then_windows(tokens):
    warm = p.pretrain(tokens, settings(mode="skipgram"), min_count=2, max_iter=2)
    grown = p.expand_to_windows(warm, settings(mode="concat"))
    assert {len(r["vec"]) for r in grown.node_vectors().collect()} == {8 + 4 * 8}
    model = p.pvdm_fit(tokens, grown.settings, max_iter=1, start=grown)
    assert model.epochs[0][3] > 0
    with pytest.raises(ValueError, match="already"):
        p.expand_to_windows(model, settings())
    with pytest.raises(ValueError, match="mode"):
        p.pretrain(tokens, settings())


def test_expand_nodes(spark):
    rows = spark.createDataFrame([(1, [2.0, 4.0])], "node long, vec array<double>")
    assert p.expand_nodes(rows, 2, 1).first()["vec"] == [0.0, 1.0, 1.0, 2.0, 2.0]


def test_most_similar_paragraph(spark):
    vecs = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0])], "para_id long, vec array<double>")
    texts = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "para_id long, text string")
    asked = spark.createDataFrame([(5, "x", 1.0)], "question_id long, text string, weight double")
    found = p.most_similar_paragraph(asked, vecs, texts, 2).orderBy("rank").collect()
    assert [(r["text"], r["id"]) for r in found] == [("y", 1), ("z", 2)]


def test_input_widths(spark):
    wins = spark.createDataFrame([(0, 0, 1, [1, 2])], "doc_id long, pos int, target long, context array<long>")
    words = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 6.0])], "id long, vec array<double>")
    owner = spark.createDataFrame([(0, [9.0])], "doc_id long, vec array<double>")
    assert p.pvdm_input(wins, words, owner, "concat").first()["input"] == [9.0, 1.0, 2.0, 3.0, 6.0]
    assert p.pvdm_input(wins, words, owner, "mean").first()["input"] == [9.0, 2.0, 4.0]
    unit = p.normalize_paragraphs(owner, replace=True).select(F.get("vec", F.lit(0))).first()[0]
    assert unit == 1.0


def test_word2vec_repeats_whatever_the_partitions(spark):
    rows = [(i, [f"{'xy'[i % 2]}{j}" for j in (0, 1, 2, 3, i % 4)]) for i in range(60)]
    tokens = spark.createDataFrame(rows, "doc_id long, words array<string>")
    runs = []
    for n in (1, 5):
        model = p.word2vec_fit(tokens.repartition(n), size=8, window=2, min_count=2, iterations=4, batch=50)
        runs.append({r["word"]: r["vec"] for r in model.word_vectors().collect()})
        errors = [error for _, _, _, error in model.epochs]
        assert errors[-1] < errors[0]
    assert runs[0].keys() == runs[1].keys() and {"x0", "y3"} <= runs[0].keys()
    assert all(runs[0][w] == pytest.approx(runs[1][w]) for w in runs[0])


def test_a_saved_model_infers_like_the_first(spark, tmp_path):
    tokens = spark.createDataFrame([(i, "a b c d a b".split()) for i in range(6)], "doc_id long, words array<string>")
    model = p.pvdm_fit(tokens, settings(), min_count=1, max_iter=2)
    snapshots.save_record(model, str(tmp_path / "m"))
    loaded = snapshots.load_record(p.ParagraphModel, spark, str(tmp_path / "m"), settings=p.Settings)
    assert loaded.settings == model.settings and [tuple(e) for e in loaded.epochs] == model.epochs
    fresh = spark.createDataFrame([(9, "b c a".split())], "doc_id long, words array<string>")
    first, again = (p.pvdm_infer(m, fresh, max_iter=2).paragraph_vectors().first()["vec"] for m in (model, loaded))
    assert first == pytest.approx(again)


def test_a_change_writes_what_it_changes(spark):
    def rows(keys, value):
        frame = spark.createDataFrame([(k, [float(value)]) for k in keys], "key long, vec array<double>")
        return materialize(frame, "test")

    table = WeightTable.of(rows(range(100), 0))
    want = dict.fromkeys(range(100), 0)
    rng = np.random.default_rng(1)
    for step in range(1, 14):
        keys = rng.choice(130, 90 if step == 6 else 5, replace=False).tolist()
        table.change(rows(keys, step))
        want |= dict.fromkeys(keys, step)
        got = [(r["key"], r["vec"][0]) for r in table.read().collect()]
        assert len(got) == len(want) and dict(got) == want
    assert sum(part.stored for part in table.parts) <= 2 * len(want)
    # the table is written whole now and then, not with every change
    assert sorted(table.written)[:8] == [5] * 8 and sum(table.written) < 5 * 90


def test_training_part_of_a_model_leaves_the_rest_alone(spark, tokens):
    model = p.pvdm_fit(tokens, settings(), min_count=1, max_iter=1)
    few = spark.createDataFrame([(0, "the cat sat on the mat".split())], "doc_id long, words array<string>")
    more = p.pvdm_fit(few, settings(), max_iter=3, start=model)
    before, after = ({r["key"]: r["vec"] for r in m.weights.collect()} for m in (model, more))
    assert before.keys() == after.keys()
    changed = sum(before[k] != after[k] for k in before)
    assert 0 < changed < len(before) and all(n <= changed for n in more.written)


def test_vocabulary_grows_and_training_goes_on(spark, tokens):
    warm = p.pvdm_fit(tokens, settings(), min_count=2, max_iter=3)
    lines = ["the zebra sat on the mat", "a zebra and a cat ran", "the zebra lay on a log", "the cat sat on the mat"] * 3
    more = spark.createDataFrame([(100 + i, x.split()) for i, x in enumerate(lines)], "doc_id long, words array<string>")
    grown = p.extend_model(warm, more, min_count=2)
    ids, new_ids = ({r["word"]: r["id"] for r in m.vocab.collect()} for m in (warm, grown))
    assert new_ids.keys() - ids.keys() == {"zebra"} and all(new_ids[w] == i for w, i in ids.items())
    old, new = ({r["word"]: r["vec"] for r in m.word_vectors().collect()} for m in (warm, grown))
    assert all(new[w] == v for w, v in old.items()) and len(new["zebra"]) == 8
    cf = {r["word"]: r["cf"] for r in grown.vocab.collect()}
    assert cf["zebra"] == 9 and cf["cat"] == {r["word"]: r["cf"] for r in warm.vocab.collect()}["cat"] + 6
    texts = {r["digest"]: (r["para_id"], r["copies"]) for r in grown.paragraphs.collect()}
    known = {r["digest"]: (r["para_id"], r["copies"]) for r in warm.paragraphs.collect()}
    assert len(texts) == len(known) + 3 and len({i for i, _ in texts.values()}) == len(texts)
    assert sum(n for _, n in texts.values()) == 28 + 12 and all(texts[d][0] == i for d, (i, _) in known.items())
    went_on = p.pvdm_fit(more, settings(), max_iter=3, start=grown)
    anew = p.pvdm_fit(more, settings(), max_iter=3, start=p.ParagraphModel(
        settings(), grown.vocab, grown.paragraphs, p.start_weights(grown.vocab, grown.paragraphs, settings())))
    errors = [e for *_, e in went_on.epochs]
    assert errors[-1] < errors[0] < anew.epochs[0][3]


def test_a_tree_that_stays_keeps_its_nodes(spark, tokens):
    model = p.pvdm_fit(tokens, settings(), min_count=2, max_iter=2)
    nodes = model.weights.filter(F.pmod("key", F.lit(4)) == p._NODE)
    same = {r["key"]: r["vec"] for r in p._merged_nodes(model.vocab, model.vocab, nodes, 16).collect()}
    assert all(same[r["key"]] == pytest.approx(r["vec"]) for r in nodes.collect()) and len(same) == nodes.count()
    # words that swap sides turn their node round
    old = spark.createDataFrame([(1, 0b10, 4), (2, 0b11, 4)], "id long, leaf long, cf long")
    new = spark.createDataFrame([(1, 0b11, 4), (2, 0b10, 4)], "id long, leaf long, cf long")
    root = spark.createDataFrame([(1 * 4 + p._NODE, [1.0, -2.0])], "key long, vec array<double>")
    assert p._merged_nodes(old, new, root, 2).first()["vec"] == [-1.0, 2.0]
    # a node that other words now pass is their mean by count
    new = spark.createDataFrame([(1, 0b10, 4), (2, 0b10, 12)], "id long, leaf long, cf long")
    old = spark.createDataFrame([(1, 0b10, 4), (2, 0b11, 12)], "id long, leaf long, cf long")
    assert p._merged_nodes(old, new, root, 2).first()["vec"] == [-0.5, 1.0]


def test_a_fit_that_lost_its_driver_goes_on(spark, tokens, tmp_path, monkeypatch):
    whole = p.pvdm_fit(tokens, settings(random_window=False), min_count=2, max_iter=3)
    folder, plain, seen = str(tmp_path / "fit"), p._epoch, []

    def lost(job, table, s, alpha, epoch, limit, write):
        if epoch == 1 and 1 not in seen:
            seen.append(epoch)
            write(spark.createDataFrame([(0, [9.0], 0.0)], "key long, vec array<double>, error double"))  # half an epoch
            raise RuntimeError("driver lost")
        seen.append(epoch)
        return plain(job, table, s, alpha, epoch, limit, write)

    monkeypatch.setattr(p, "_epoch", lost)
    with pytest.raises(RuntimeError):
        p.pvdm_fit(tokens, settings(), min_count=2, max_iter=3, folder=folder)
    assert seen == [0, 1]
    resumed = p.pvdm_fit(tokens, settings(), min_count=2, max_iter=3, folder=folder)
    assert seen == [0, 1, 1, 2]
    assert [e for *_, e in resumed.epochs] == pytest.approx([e for *_, e in whole.epochs])
    a, b = ({r["key"]: r["vec"] for r in m.weights.collect()} for m in (whole, resumed))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    again = p.pvdm_fit(tokens, settings(), min_count=2, max_iter=3, folder=folder)
    assert len(seen) == 4 and again.epochs == resumed.epochs
    with pytest.raises(ValueError, match="another fit"):
        p.pvdm_fit(tokens, settings(), min_count=2, max_iter=4, folder=folder)


def test_inference_in_one_visit_equals_epoch_by_epoch(spark, tokens, monkeypatch):
    model = p.pvdm_fit(tokens, settings(), min_count=2, max_iter=2)
    fresh = spark.createDataFrame([(i, x.split()) for i, x in enumerate(["the cat ran home", "a log", "a log", "dog mat the"])], "doc_id long, words array<string>")
    reads = []
    pulled = p._pulled
    monkeypatch.setattr(p, "_pulled", lambda *a: reads.append(1) or pulled(*a))
    inferred = p.pvdm_infer(model, fresh, max_iter=4)
    assert len(reads) == 1 and inferred.paragraph_vectors().count() == 3 and len(inferred.epochs) == 4
    s, rows = model.settings, {r["key"]: r["vec"] for r in model.weights.collect()}
    ids = {r["word"]: (r["id"], r["leaf"]) for r in model.vocab.collect()}
    owner = {r["first_doc"]: r["para_id"] for r in inferred.paragraphs.collect()}
    start = {r["key"]: r["vec"] for r in p.start_paragraphs(inferred.paragraphs, s).collect()}
    words = [x for x in fresh.orderBy("doc_id").collect() if x["doc_id"] in owner]
    coded = [[ids.get(w, ids[p.UNKNOWN]) for w in x["words"]] for x in words]
    left = pd.DataFrame({"para_id": [owner[x["doc_id"]] for x in words], "ids": [np.array([i for i, _ in c]) for c in coded],
                         "leaves": [np.array([leaf for _, leaf in c]) for c in coded], "pos": 0})
    pad = ids[p.PADDING][0] * 4
    nodes = {leaf >> k: None for c in coded for _, leaf in c for k in range(1, leaf.bit_length())}
    need = [i * 4 for c in coded for i, _ in c] + [n * 4 + 1 for n in nodes] + [pad]
    right = pd.DataFrame([(k, rows.get(k)) for k in set(need)] + list(start.items()), columns=["key", "vec"])
    for epoch in range(4):
        out = p._train_block(left, right, s, p._schedule(s.alpha, epoch, 4), epoch, pad, True)
        changed = dict(zip(out["key"], out["vec"]))
        right["vec"] = [changed.get(k, v) for k, v in zip(right["key"], right["vec"])]
    got = {r["para_id"]: r["vec"] for r in inferred.paragraph_vectors().collect()}
    assert all(got[k // 4] == pytest.approx(v) for k, v in zip(right["key"], right["vec"]) if k % 4 == 2)


def test_blocks_ask_once_for_words_and_the_nodes_above_them(spark, tokens, monkeypatch):
    monkeypatch.setattr(p, "BLOCK_WORDS", 60)
    vocab, texts = p.training_vocabulary(tokens, 2), p._paragraph_texts(tokens)
    job = p._lay_out(tokens, vocab, texts, 60, None)
    known = {r["id"]: r["leaf"] for r in vocab.collect()}
    pad, want = vocab.filter(F.col("word") == p.PADDING).first()["id"], set()
    assert "leaves" not in job.encoded.columns  # a leaf travels with its word, not with each occurrence
    for row in job.encoded.collect():
        leaves = [known[i] for i in row["ids"]]
        keys = {i * 4 for i in row["ids"]} | {(leaf >> k) * 4 + 1 for leaf in leaves for k in range(1, leaf.bit_length())}
        want |= {(row["block"], k) for k in keys | {row["para_id"] * 4 + 2, pad * 4}}
    got = [(r["block"], r["key"]) for r in job.needed.collect()]
    assert job.blocks > 1 and len(got) == len(set(got)) and set(got) == want
    assert all(r["leaf"] == known[r["key"] // 4] for r in job.needed.filter("key % 4 = 0 AND leaf IS NOT NULL").collect())
