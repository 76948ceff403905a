import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import frame

from ferrum.llm import pii

# The patterns as the operator's definition has them, one plain search each.
PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
         r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == 2:
                check = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
                if not 12 <= len(digits) <= 19 or check % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def with_luhn(rng, n):
    d = [rng.randrange(10) for _ in range(n - 1)]
    s = sum(x if i % 2 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
    return "".join(map(str, d)) + str(-s % 10)


def test_patterns_equal_plain_searches():
    rng = random.Random(1)
    for _ in range(30_000):
        text = "".join(rng.choice(["a", "Z", ".", "@", "-", "+", " ", "(", ")", "1", "25", "300", "0", "é", "4", "\n", "_", "%"]) for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == plain(text), text
    for _ in range(2000):
        text = " ".join(rng.choice([with_luhn(rng, rng.randrange(11, 21)), f"+{rng.randrange(10**12)}", f"{rng.randrange(300)}.1.2.{rng.randrange(300)}", "+1 (404) 555-0199",
                                    "x.y@a-b.c.de", "word", "4111-1111 1111-1111"]) for _ in range(4))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["9" * 200_000, "a" * 200_000, "1." * 100_000, "a@" * 100_000, "a@b." * 50_000, "+1" * 100_000, "1 " * 100_000, "+1 " + "( " * 100_000])
def test_patterns_take_one_pass(text):
    base = pii.base_spans(text)
    assert all(s < e for s, _, e in base) and len(pii.words_of(text, base)["start"]) <= len(text)


def exact(unary, a, b, w):
    n, k = unary.shape
    grid = np.stack(np.meshgrid(*[np.arange(k)] * n, indexing="ij"), -1).reshape(-1, n)
    w = w if w.ndim == 2 else np.repeat(w[:, None], k, axis=1)
    score = unary[np.arange(n), grid].sum(axis=1) + sum(w[e][grid[:, a[e]]] * (grid[:, a[e]] == grid[:, b[e]]) for e in range(len(a)))
    p = np.exp(score - score.max())
    return np.stack([[p[grid[:, v] == x].sum() for x in range(k)] for v in range(n)]) / p.sum()


def test_messages_are_exact_on_trees_and_near_on_loops():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = 6
        unary, w = rng.normal(0, 2, (n, 4)), rng.uniform(0.1, 3, n)
        b = np.arange(1, n)
        a = np.array([rng.integers(0, x) for x in b])
        assert np.allclose(pii.marginals(unary, a, b, w[:-1], rounds=60), exact(unary, a, b, w[:-1]), atol=1e-6)
        by_label = rng.uniform(0, 2, (n - 1, 4))
        got = pii.marginals(unary, a, b, by_label, rounds=60)
        assert np.allclose(got, exact(unary, a, b, by_label), atol=1e-6)
        a, b = np.append(a, n - 1), np.append(b, 0)
        assert np.abs(pii.marginals(unary, a, b, w, rounds=60) - exact(unary, a, b, w)).max() < 0.25


def field(texts):
    got = next(pii._scan([pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])]))
    return got, pii._field(got)


def test_factors():
    got, (label, shape, chain, word, hub, exact_) = field(["call +1 (404) 555-0199 or 555-0199 now", None, "no digits", "a1 555-0199. 5550199 4045550199"])
    assert label.tolist() == [4, 4, 4, 0, 0, 0, 0, 0] and chain.tolist() == [0, 1, 4, 5, 6]
    groups = {tuple(word[hub == h].tolist()): int(exact_[hub == h][0]) for h in set(hub.tolist())}
    assert groups == {(2, 3): 1, (5, 6): 1, (5, 6, 7): 0}


def invented(rng, n):
    """Documents with numbers of no meaning, some with a phone, card or address and other mentions of it."""
    rows, want = [], {}
    words = ["alpha", "beta", "gamma", "delta"]
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randrange(10, 60))] + [str(rng.randrange(1900, 2030)), f"{rng.randrange(99)}%", str(rng.randrange(10**6, 10**8))]
        rng.shuffle(body)
        parts, expect = body, []
        if i % 2:
            area, line = f"{rng.randrange(200, 999)}", f"{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
            card = with_luhn(rng, 16)
            kind, full, other = rng.choice([(3, f"+1 ({area}) {line}", line), (2, card, card[:12] + f"{(int(card[12:]) + 1) % 10000:04}"),
                                            (0, f"jo.{line[-4:]}x@mail.example.com", f"jo.{line[-4:]}x"), (1, "10.20.30.40", "10.20.30.xx")])
            parts = [full, *body[: len(body) // 2], other, *body[len(body) // 2:]]
            expect = [(kind, other)]
        rows.append((i, " ".join(parts), "s"))
        want[i] = expect
    return rows, want


def test_other_mentions_are_found_and_plain_numbers_are_left(spark):
    rows, want = invented(random.Random(4), 600)
    got = {r["doc_id"]: r for r in pii.personal_data(frame(spark, rows)).collect()}
    hit = missed = wrong = 0
    for i, text, _ in rows:
        base = pii.spelled(plain(text))
        spans = got[i]["spans"].split(",") if got[i]["spans"] else []
        assert set(base.split(",")) - {""} <= set(spans) and got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        added = {(s.split(":")[0], text[int(s.split(":")[1]): int(s.split(":")[2])]) for s in set(spans) - set(base.split(","))}
        wished = {(pii.KINDS[k], other) for k, other in want[i]}
        hit, missed, wrong = hit + len(added & wished), missed + len(wished - added), wrong + len(added - wished)
        assert got[i]["n_added"] == len(spans) - len(base.split(",")) * bool(base)
    assert hit > 0.9 * (hit + missed) and wrong <= 0.02 * len(rows), (hit, missed, wrong)


def test_edges(spark, edge, empty):
    got = pii.personal_data(edge).collect()
    assert len(got) == edge.count()
    assert {r["base_sha256"] for r in got if r["doc_id"] in (1, 2, 3, 7)} == {hashlib.sha256(b"").hexdigest()}
    assert pii.personal_data(empty).count() == 0
    text = "☃é +1 (404) 555-0199, 555-0199 a@b.co 1.2.3.4 " + "x" * 200_000 + " 7" * 50_000
    r = pii.personal_data(frame(spark, [(None, text, "s")] * 3)).collect()
    assert len(r) == 3 and r[0]["spans"].startswith("phone:3:20,phone:22:30,email:31:37,ip:38:45") and (r[0]["n_email"], r[0]["n_ip"], r[0]["n_phone"]) == (1, 1, 1)
