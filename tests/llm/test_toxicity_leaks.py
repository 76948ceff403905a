import random

import numpy as np
import pyarrow as pa
from brute import lcs, lower, words
from conftest import frame

from ferrum.llm import decontaminate, toxicity
from ferrum.llm import text as tx
from ferrum.llm.base import documents, table
from ferrum.llm.queries import op5_decontaminate, op8_toxicity


def test_held_out_accuracy(spark):
    """Planted words decide; rows of the held-out quarter are never trained on."""
    rng = random.Random(0)
    plain, bad = [f"word{k}" for k in range(300)], ["vileness", "vilest", "rotten", "foul"]
    rows, marks = [], []
    for i in range(700):
        w = rng.choices(plain, k=60)
        if i % 5 == 0:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(bad)
        rows.append((i, " ".join(w), "s"))
        marks.append((i, 1, int(i % 5 == 0)))
    got = toxicity.toxicity(frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == 700
    test = [r for r in got if r["held_out"]]
    right = sum(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in test)
    assert right / len(test) > 0.97 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_toxicity_query(spark, sf, sample):
    got = op8_toxicity(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in sample)


def test_toxicity_edges(spark, edge, empty, labels, no_labels):
    got = toxicity.toxicity(edge, labels).collect()
    assert len(got) == edge.count() and len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(edge, no_labels).collect()} == {0.5}
    kept = toxicity.without_toxic(edge, labels)
    assert kept.columns == edge.columns
    clash = toxicity.score(edge.select("doc_id", "text", "score"), toxicity.fit_on_labels(edge, labels))
    assert clash.columns == ["doc_id", "text", "score", "score_", "predicted"]


def test_lcs_matches_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = rng.choices("abc", k=rng.randint(0, 9)), rng.choices("abc", k=rng.randint(0, 12))
        assert decontaminate.lcs(a, b) == lcs(a, b)


def test_query_finds_every_planted_passage(spark, sf, sample):
    items = [(r["item_id"], words(lower(r["text"]))) for r in table(spark, sf, "benchmark").collect()]
    got = {r["doc_id"]: set(r["items"]) for r in op5_decontaminate(spark, sf).collect()}
    assert set(got) == {i for i, _ in sample}
    for i, t in sample:
        w = words(lower(t))
        body = f" {' '.join(w)} "
        exact = {k for k, x in items if f" {' '.join(x)} " in body}
        close = {k for k, x in items if any(lcs(x, w[s: s + 3 * len(x) + 40]) >= 0.6 * len(x) for s in range(0, len(w), len(x) + 20))}
        assert exact <= got[i] <= close


def test_recall_against_brute_force(spark):
    """Paraphrased items (a fifth of the words changed) in long texts: recall of the search at least 0.9."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    common = [word() for _ in range(80)]
    prose = lambda n: [rng.choice(common) if rng.random() < 0.5 else word() for _ in range(n)]
    items = [(k, prose(rng.randint(15, 60))) for k in range(40)]
    rows, planted = [], {}
    for i in range(160):
        w = prose(rng.randint(5, 400))
        if i % 2:
            k, x = rng.choice(items)
            x = [word() if rng.random() < 0.12 else y for y in x]
            at = rng.randint(0, len(w))
            w = w[:at] + x + w[at:]
            if lcs(items[k][1], x) >= 0.75 * len(x):
                planted[i] = k
        rows.append((i, " ".join(w), "s"))
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in items] + [(90, ""), (91, None)], "item_id long, text string")
    got = {r["doc_id"]: set(r["items"]) for r in decontaminate.contamination(frame(spark, rows), bench).collect()}
    found = sum(k in got[i] for i, k in planted.items())
    assert found >= 0.9 * len(planted)
    assert all(not got[i] for i in range(0, 160, 2))
    clean = decontaminate.clean(frame(spark, rows), bench)
    assert {r["doc_id"] for r in clean.collect()} == {i for i in got if not got[i]}


def test_leak_edges(spark, edge, empty):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog while seven wizards quietly box up many jugs")], "item_id long, text string")
    got = decontaminate.contamination(edge, bench).collect()
    assert len(got) == edge.count() and {r["doc_id"] for r in got if r["contaminated"]} == {7, 8, 9, None}
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(edge, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.clean(edge, bench).columns == edge.columns


def test_documents_table_is_read_whole(spark, sf):
    assert documents(spark, sf).count() >= 200


def test_recall_of_items_of_all_lengths(spark):
    """200 items of 8 to 1000 words, verbatim and with a fifth of the words changed, against brute force."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    common = [word() for _ in range(300)]
    prose = lambda n: [rng.choice(common) if rng.random() < 0.6 else word() for _ in range(n)]
    items = [(k, prose(n)) for k, n in enumerate([int(8 * 125 ** (k / 199)) for k in range(200)])]
    rows, planted = [], {}
    for k, x in items:
        for changed in (0, 0.2):
            i, x = 2 * k + (changed > 0), [word() if rng.random() < changed else y for y in x]
            w, at = prose(rng.randint(40, 120)), rng.randint(0, 40)
            rows.append((i, " ".join(w[:at] + x + w[at:]), "s"))
            if lcs(items[k][1], x) >= 0.75 * len(x):
                planted[i] = k
    rows += [(1000 + k, " ".join(prose(300)), "s") for k in range(40)]
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in items], "item_id long, text string")
    got = {r["doc_id"]: set(r["items"]) for r in decontaminate.contamination(frame(spark, rows), bench).collect()}
    assert not [i for i, k in planted.items() if i % 2 == 0 and k not in got[i]]
    assert sum(k in got[i] for i, k in planted.items()) >= 0.98 * len(planted) and len(planted) > 300
    assert not any(got[1000 + k] for k in range(40))


def test_clean_rows_that_share_the_id_of_a_leak(spark):
    item = "the quick brown fox jumps over the lazy dog while seven wizards quietly box up many jugs"
    rows = [(None, f"before it {item} and after it", "a"), (None, "a clean text that has no id and nothing of the benchmark", "a"), (None, None, "a"),
            (5, item, "a"), (5, "another clean text under the id of a contaminated one", "b"), (6, "", "b")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.contamination(frame(spark, rows), bench).collect()
    assert sorted((r["doc_id"] or 0, r["contaminated"]) for r in got) == [(0, False), (0, False), (0, True), (5, False), (5, True), (6, False)]
    kept = decontaminate.clean(frame(spark, rows), bench).select("doc_id", "text").collect()
    assert {tuple(r) for r in kept} == {r[:2] for r in (rows[1], rows[2], rows[4], rows[5])}


def _one_block(items):
    """A block whose items are their own query passages, without a fit."""
    bodies = {(k, 0): x for k, x in enumerate(items)}
    hashes = [decontaminate._terms(next(tx.slices(pa.array([x]))))[1] for x in items]
    vocabulary = np.unique(np.concatenate(hashes))
    times = np.array([[(h == v).sum() for v in vocabulary] for h in hashes], dtype=np.int32)
    empty = np.zeros((0, 1), dtype=np.float32)
    return decontaminate._Block(empty, empty, empty, np.arange(len(items)), list(bodies), [h.tolist() for h in hashes], [], vocabulary, times)


def test_a_word_counts_for_a_subsequence_as_often_as_both_have_it():
    """Windows full of one word of an item need no subsequence; no window that reaches the share is left out."""
    rng = random.Random(3)
    items = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 12))) for _ in range(6)]
    texts = [" ".join(rng.choices("abcdefghxy", k=rng.randint(1, 30))) for _ in range(60)] + ["a " * 40, "x y"]
    block = _one_block(items)
    item = np.tile(np.arange(len(items)), len(texts))
    sizes = [len(x.split()) for x in texts]
    hi = np.repeat(np.cumsum(sizes), len(items))
    lo = hi - np.repeat(sizes, len(items))
    h = decontaminate._terms(next(tx.slices(pa.array([" ".join(texts)]))))[1]
    for most in (1, 50, 1 << 20):
        got = decontaminate._enough(block, h, item, lo, hi, 0.6, most).tolist()
        pairs = [(x.split(), items[k].split()) for x in texts for k in range(len(items))]
        assert got == [sum(min(x.count(w), y.count(w)) for w in set(y)) >= 0.6 * len(y) for x, y in pairs]
        assert not [1 for (x, y), ok in zip(pairs, got, strict=True) if not ok and lcs(x, y) >= 0.6 * len(y)]


def test_steps_that_hold_a_term(spark):
    """``passage_counts`` against sets of words."""
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choices([f"w{j}" for j in range(30)], k=n)), "s") for k, n in enumerate([0, 1, 16, 17, 40, 333])] + [(9, None, "s")]
    got, steps = decontaminate.passage_counts(frame(spark, rows).select("text"))
    parts = [x[k: k + decontaminate.STEP] for _, t, _ in rows for x in [(t or "").split()] for k in range(0, len(x), decontaminate.STEP)]
    want = np.zeros(decontaminate.TERMS, dtype=np.int64)
    for part in parts:
        want[np.unique(decontaminate._terms(next(tx.slices(pa.array([" ".join(part)]))))[2])] += 1
    assert steps == len(parts) and (got == want).all()
