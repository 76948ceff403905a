import random

import numpy as np
from brute import components
from conftest import frame

from ferrum.llm import near_dup
from ferrum.llm import text as tx
from ferrum.llm.base import connected_components
from ferrum.llm.queries import op2_minhash_near_dedup


def check(got, rows, width, percent):
    want = components(rows, width, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_query_against_brute_force(spark, sf, sample):
    check(op2_minhash_near_dedup(spark, sf).collect(), sample, 3, 85)


def test_chains_stars_and_near_misses(spark):
    """A chain of copies that links its ends only by steps, many copies of one text, and texts just under the limit."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows, base = [], [word() for _ in range(120)]
    for k in range(25):  # a chain: one more word differs at each step
        rows.append((100 + k, " ".join(base)))
        base = [*base[:4 * k], word(), *base[4 * k + 1:]]
    centre = [word() for _ in range(100)]
    for k in range(60):  # copies with one to five words of their own
        own = list(centre)
        for i in rng.sample(range(100), k % 6):
            own[i] = word()
        rows.append((300 + k, " ".join(own)))
    got = near_dup.near_duplicates(frame(spark, [(i, t, "s") for i, t in rows]), 3, 85).collect()
    check(got, rows, 3, 85)


def test_signature_is_an_estimate_with_less_variance_than_independent_hashes():
    rng = np.random.default_rng(0)
    errors, m = [], 64
    for _ in range(60):
        pool = rng.integers(0, 2**63, 120).astype(np.uint64)
        a, b = np.sort(pool[:80]), np.sort(pool[40:])
        sig = near_dup.signatures(np.concatenate([a, b]), np.array([0, 80, 160]), m)
        errors.append((sig[0] == sig[1]).mean() - 40 / 120)
    assert abs(np.mean(errors)) < 0.02
    assert np.var(errors) < 40 / 120 * 80 / 120 / m


def test_early_stop_changes_no_slot():
    """The signature equals the one made by running every step for every element."""
    rng = np.random.default_rng(3)
    e, m = np.sort(rng.integers(0, 2**63, 90).astype(np.uint64)), 16
    want = np.full(m, 2**64 - 1, dtype=np.uint64)
    for x in e:
        perm = np.arange(m)
        for j in range(m):
            draw = tx.mix(np.array([x]) + near_dup._STEP[j])
            pick = j + int(draw[0] % np.uint64(m - j))
            perm[j], perm[pick] = perm[pick], perm[j]
            rank = (j << 56) | int(tx.mix(draw ^ np.uint64(0xA0761D6478BD642F))[0] >> np.uint64(8))
            want[perm[j]] = min(int(want[perm[j]]), rank)
    assert near_dup.signatures(e, np.array([0, 90]), m)[0].tolist() == want.tolist()


def test_components_of_a_hot_node_and_a_path(spark):
    pairs = [(0, k) for k in range(1, 400)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(400)}, **{k: 1000 for k in range(1000, 1061)}}


def test_edges_and_empty(spark, edge, empty):
    got = near_dup.near_duplicates(edge, 3, 85).collect()
    assert len(got) == edge.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[1] == by[2][:0] + [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[6] == [(1, 5, False)] and by[5] == [(1, 5, True)] and by[4] == [(1, 4, True)]
    assert [x[1:] for x in by[8]] == [(7, False)] * 2
    assert near_dup.near_duplicates(empty, 3, 85).count() == 0
    left = near_dup.one_of_each(edge, 5, 80)
    assert left.columns == edge.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert 7 in ids and 8 not in ids and ids.count(12) == 1


def test_repeated_rows_leave_one(spark):
    left = near_dup.one_of_each(frame(spark, [(1, "a b c d e f", "s")] * 3 + [(2, "x y z", "s")]))
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2]
