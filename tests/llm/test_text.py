import pyarrow as pa
from brute import lower, shingles, words
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrum.llm import text as tx

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aA bé\n\t ☃", max_size=30)), min_size=1, max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_hashes_match_the_definition(texts):
    got, names = [], {}
    for t in tx.slices(pa.array(texts, pa.string()), most=20):
        t = tx.lower(t)
        w = tx.words(t)
        h = tx.word_hashes(t, w)
        for i in range(len(t)):
            a, b = w.offs[i], w.offs[i + 1]
            own = [t.buf[s:e].tobytes().decode() for s, e in zip(w.starts[a:b], w.ends[a:b])]
            got.append(own)
            for x, y in zip(own, h[a:b].tolist()):
                assert names.setdefault(y, x) == x
    assert got == [words(lower(t)) for t in texts]
    assert len(set(names.values())) == len(names)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_shingle_sets_have_the_defined_size(texts, width):
    sizes = []
    for t in tx.slices(pa.array(texts, pa.string())):
        t = tx.lower(t)
        w = tx.words(t)
        h, offs = tx.shingles(tx.word_hashes(t, w), w.offs, width)
        sizes += [len(set(h[a:b].tolist())) for a, b in zip(offs, offs[1:])]
    assert sizes == [len(shingles(t, width)) for t in texts]
