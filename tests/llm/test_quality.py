import numpy as np
import pyarrow as pa
import pytest
from brute import rule_counts
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrum.llm import quality
from ferrum.llm import text as tx
from ferrum.llm.queries import op1_quality_rules


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab #|é\n\t", max_size=40), min_size=1, max_size=6))
def test_counts_match_the_definition(texts):
    got = np.concatenate([quality.count_rules(t) for t in tx.slices(pa.array(texts, pa.string()))])
    assert [tuple(r) for r in got[:, :5].tolist()] == [rule_counts(t) for t in texts]


def test_query_on_driver_rows(spark, sf, sample):
    rows = {r["doc_id"]: r for r in op1_quality_rules(spark, sf).collect()}
    assert len(rows) == len(sample)
    for i, t in sample:
        r, c = rows[i], rule_counts(t)
        assert tuple(r[k] for k in quality.COUNTS) == c
        assert r["base_failed"] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert not (r["base_failed"] and r["kept"])


def test_forest_isolates_outliers():
    rng = np.random.default_rng(1)
    clean, junk = rng.normal(0.2, 0.02, (2000, 4)), rng.normal(0.8, 0.02, (20, 4))
    f = quality.Forest(np.concatenate([clean, junk[:5]]), trees=50, psi=40, limit=10)
    assert f.scores(junk[5:]).min() > np.quantile(f.scores(clean), 0.99)


def test_edges_and_empty(spark, edge, empty, labels, no_labels):
    got = quality.verdicts(edge, labels).collect()
    assert len(got) == edge.count()
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 50)
    assert len({tuple(r[c] for c in ("n_words", "base_failed", "kept")) for r in got if r["doc_id"] == 8}) == 1
    assert quality.verdicts(empty, labels).count() == 0
    assert quality.verdicts(edge, no_labels).where("NOT base_failed AND NOT kept").count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_forest_of_few_rows(n):
    f = quality.Forest(np.zeros((n, 2)), 5, 4, 3)
    assert len(f.scores(np.zeros((2, 2)))) == 2
