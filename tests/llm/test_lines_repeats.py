import random

import numpy as np
import pytest
from brute import lines, repeats
from conftest import frame

from ferrum.llm import bwt_dedup, line_dedup
from ferrum.llm.base import RARITY_BITS
from ferrum.llm.queries import op4_line_dedup, op6_suffix_array_dedup


def test_line_query_against_brute_force(spark, sf, sample):
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_links"], r["kept_sha256"]) for r in op4_line_dedup(spark, sf).collect()}
    assert got == lines(sample, 80)


def test_lines_of_all_lengths(spark):
    rng = random.Random(1)
    pool = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(30):
        text = []
        for _ in range(6):
            own = rng.sample(pool, rng.randint(1, 14))
            text += [" ".join(own), " ".join(own[: max(1, len(own) - rng.randint(0, 2))]), ""]
        rows.append((i, "\n".join(text)))
    got = line_dedup.dedup(frame(spark, [(i, t, "s") for i, t in rows])).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_links"], r["kept_sha256"]) for r in got} == lines(rows, 80)


def test_line_edges(spark, edge, empty):
    got = line_dedup.dedup(edge).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert (by[1]["n_lines"], by[1]["kept"]) == (0, "") and by[3]["n_removed"] == 0
    assert by[7]["n_removed"] == 1 and by[6]["n_removed"] == 1 and by[5]["n_removed"] == 0
    assert len({r["kept_sha256"] for r in got if r["doc_id"] == 8}) == 1
    assert line_dedup.dedup(empty).count() == 0


def test_repeat_query_against_brute_force(spark, sf, sample):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op6_suffix_array_dedup(spark, sf).collect()}
    assert got == repeats(sample, 100)


@pytest.mark.parametrize("most", [4096, 1])
def test_overlaps_periods_and_hot_keys(spark, most, monkeypatch):
    """Periodic texts, shared passages in other surroundings, and keys sent down the path for hot keys."""
    monkeypatch.setattr(bwt_dedup.repeats, "__defaults__", (100, most))
    rng = random.Random(4)
    text = lambda n: "".join(rng.choices("abcd é", k=n))
    shared = [text(n) for n in (99, 100, 140, 260, 400)]
    rows = [(i, text(rng.randint(0, 80)) + rng.choice(shared) + text(rng.randint(0, 50)) + rng.choice(shared)[: rng.randint(50, 400)])
            for i in range(40)]
    rows += [(50, "ab" * 300), (51, "x" * 99), (52, "x" * 100), (53, "x" * 350), (54, rows[3][1])]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in bwt_dedup.dedup(frame(spark, [(i, t, "s") for i, t in rows])).collect()}
    assert got == repeats(rows, 100)


def test_rows_without_an_id_are_told_apart(spark):
    """Thousands of rows without an id, or with one id: each text is a document of its own, and clean ones stay whole."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared = [text(150) for _ in range(5)]
    rows = [(None if i % 2 else 7, text(rng.randint(90, 130)) + (rng.choice(shared) if i % 10 == 0 else "")) for i in range(3000)]
    rows += rows[:5]
    got = bwt_dedup.dedup(frame(spark, [(*r, "s") for r in rows])).collect()
    # The order of documents with one id is that of a hash, so what is removed is compared as a whole.
    tags = {r["text"]: r["tag"] for r in bwt_dedup._tagged(frame(spark, [(*r, "s") for r in rows])).select("text", "tag").collect()}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, tags[r[1]]))
    want = repeats([(k, t) for k, (_, t) in enumerate(order)], 100)
    want = sorted((len(t.encode()), *want[k][1:3]) for k, (_, t) in enumerate(order))
    seen = {}
    for r in got:
        seen.setdefault((r["doc_id"], r["kept_sha256"], r["n_bytes"]), (r["n_bytes"], r["n_removed"], r["n_spans"]))
    assert len(got) == len(rows) and sorted(x[1] for x in seen.values()) == sorted(x[1] for x in want)[-len(seen):]
    clean = sum(r["n_removed"] == 0 for r in got)
    assert clean >= 2700 and sum(r["n_removed"] for r in got) >= 150 * 290


def test_merged_intervals_match_a_dictionary():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.choice([3, 5, 8])
        base = bytes(rng.choices(b"ab", k=40))
        strings = []
        for _ in range(rng.randint(1, 6)):
            a = rng.randint(0, 20)
            strings.append(base[a: a + rng.randint(n, 20)])
        want = {}
        for i, s in enumerate(strings):
            for k in range(len(s) - n + 1):
                want.setdefault(s[k: k + n], []).append((i, k))
        got = sorted(sorted(map(tuple, g.tolist())) for g in bwt_dedup.repeated_windows(strings, n))
        assert got == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_repeat_edges(spark, edge, empty):
    got = bwt_dedup.dedup(edge).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got}
    assert (by[1]["n_bytes"], by[1]["n_removed"]) == (0, 0) and by[4]["kept"] == b"one"
    assert by[8]["n_removed"] == by[8]["n_bytes"] and by[12]["n_removed"] == 150_000 - 1
    assert len({r["kept_sha256"] for r in got if r["doc_id"] == 8}) == 1
    assert bwt_dedup.dedup(empty).count() == 0


@pytest.mark.parametrize("first", [0, (1 << 21) - 3, 3 << 21])
def test_sets_of_lines_on_both_sides_of_the_key(first):
    """Line numbers k and k + 2**21 are different lines."""
    rng = np.random.default_rng(5)
    line = np.sort(np.concatenate([first + rng.integers(0, 6, 60), first + (1 << 21) + rng.integers(0, 6, 60), first + (5 << 21) + rng.integers(0, 6, 60)]))
    h = rng.integers(0, 1 << 63, 25, dtype=np.uint64)[rng.integers(0, 25, len(line))]
    often = rng.integers(1, 4, 1 << RARITY_BITS).astype(np.int32)
    got = [x.tolist() for x in line_dedup._sorted_sets(line, h, often)]
    n = lambda x: int(often[x & ((1 << RARITY_BITS) - 1)])
    want = sorted({(k, n(x), x >> 40, x) for k, x in zip(line.tolist(), h.tolist(), strict=True)})
    assert list(zip(*got, strict=True)) == [(k, x, c) for k, c, _, x in want]


def test_fragments_that_meet_nothing_share_no_window():
    """What is left out before the merge shares no window: on texts that agree around an anchor by any number of bytes."""
    import pandas as pd
    import pyarrow as pa

    from ferrum.llm import text as tx
    rng = random.Random(12)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    for n in (100, 61):
        core = letters(n)
        texts = [letters(rng.randint(0, 90)) + core[rng.randint(0, 60): rng.randint(40, n)] + letters(rng.randint(0, 90)) for _ in range(60)] + [core + letters(9)] * 2
        t = next(tx.slices(pa.array(texts)))
        r = bwt_dedup._runs(t, n)
        start, size = r["place"] >> 16, (r["place"] >> 8) & 0xFF
        part = pd.DataFrame({"key": r["key"], "place": r["place"], "bytes": [texts[o].encode()[s: s + k + n - 1] for o, s, k in zip(r["owner"], start, size, strict=True)]})
        kept = bwt_dedup._meeting(part, n)
        left = {(k, b) for k, b in zip(part["key"], part["bytes"], strict=True)} - {(k, b) for k, b in zip(kept["key"], kept["bytes"], strict=True)}
        windows = {}
        for i, b in enumerate(part["bytes"]):
            for k in range(len(b) - n + 1):
                windows.setdefault((part["key"][i], b[k: k + n]), set()).add(i)
        shared = {(part["key"][i], part["bytes"][i]) for v in windows.values() if len(v) > 1 for i in v}
        assert not left & shared and shared and left


def test_pairs_that_their_words_rule_out_are_not_read_back(spark, monkeypatch):
    """Lines that share one rare word and few others are no pairs, and their sets are not read; similar lines all are."""
    rng = random.Random(5)
    often = [f"often{k}" for k in range(60)]
    text = []
    for k in range(300):  # a word of two lines, then nine that many lines have
        for _ in range(2):
            text.append(" ".join([f"rare{k}", *rng.sample(often, 9)]))
    for k in range(20):
        w = rng.sample(often, 10)
        text += [" ".join(w), " ".join([*w, "more"])]
    seen, keep = {}, line_dedup.stored

    def stored(df, name):
        out = keep(df, name)
        seen[name] = out.count()
        return out
    monkeypatch.setattr(line_dedup, "stored", stored)
    got = line_dedup.dedup(frame(spark, [(i, t, "s") for i, t in enumerate(text)])).collect()
    sets = [set(t.split()) for t in text]
    want = sum(100 * len(x & y) >= 80 * len(x | y) for x in sets for y in sets if x is not y)
    assert sum(r["n_links"] for r in got) == want >= 40
    assert seen["line-pairs"] <= want // 2 + 30


def test_a_task_of_the_last_step_has_one_python_worker(spark):
    """Texts without a mark go through one Python step, not through two in one task."""
    got = line_dedup.dedup(frame(spark, [(i, f"alpha beta {i}\ngamma delta epsilon zeta eta {i % 2}", "s") for i in range(20)]))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    above, chained = [], []  # nodes from the root down to the line, joins and Python steps only; a join's inputs are other tasks
    for line in plan.splitlines():
        name = line.lstrip(" :+-")
        deep = len(line) - len(name)
        above = [x for x in above if x[0] < deep]
        if name.startswith("MapInArrow"):
            chained.append(bool(above) and above[-1][1] == "MapInArrow")
        if name.startswith(("MapInArrow", "Join")):
            above.append((deep, name.split(" ")[0].split("(")[0]))
    assert len(chained) >= 3 and not any(chained)
    assert got.count() == 20


def test_few_sets_besides_the_wanted_are_shuffled(spark):
    """The bit filter of the class sets keeps out nearly all lines that stand in no pair, also where many do."""
    from pyspark.sql import functions as F
    docs = frame(spark, [(i, "\n".join(f"word{40 * i + k} other{40 * i + k}" for k in range(40)), "s") for i in range(1000)])
    docs = docs.withColumn("tag", F.xxhash64("text"))
    lines = line_dedup._posted(docs, line_dedup.word_counts(docs), 80).select("a", "b").distinct()
    wanted = lines.where("pmod(b, 8) = 0").withColumn("id", F.monotonically_increasing_id()).localCheckpoint()
    n = wanted.count()
    assert n > 4000 and n <= line_dedup._read_sets(docs, wanted).count() <= 1.05 * n
    sets = line_dedup._class_sets(docs, wanted)
    assert sets.count() == n and sets.select("id").distinct().count() == n


def near_copies(n, seed):
    """Lines of 40 words that differ from each other in one or two of them, and some others."""
    rng = random.Random(seed)
    base = [f"base{k}" for k in range(40)]
    text = []
    for k in range(n):
        w = list(base)
        w[rng.randrange(40)] = f"own{k}"
        text += [" ".join(w)] * rng.choice([1, 1, 2])
    return text + [" ".join(rng.sample(base, 12) + [f"o{k}", f"p{k}"]) for k in range(20)]


def test_pairs_of_a_large_group_are_not_rows(spark, monkeypatch):
    """A group of similar lines is written as pairs of blocks, and every match of it is counted."""
    text = near_copies(300, 6)
    seen, keep = {}, line_dedup.stored

    def stored(df, name):
        out = keep(df, name)
        seen[name] = out.count()
        return out
    monkeypatch.setattr(line_dedup, "stored", stored)
    rows = [(i, "\n".join(text[3 * i: 3 * i + 3])) for i in range(-(-len(text) // 3))]
    got = line_dedup.dedup(frame(spark, [(*r, "s") for r in rows])).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_links"], r["kept_sha256"]) for r in got} == lines(rows, 80)
    assert sum(r["n_links"] for r in got) >= 300 * 299
    assert max(seen.values()) < 2000


@pytest.mark.parametrize("part", [2, 7])
def test_words_of_many_classes_are_dealt_to_parts(spark, part, monkeypatch):
    """Postings of one word in several parts, and several buckets and flushes in a task: no match is lost or counted twice."""
    for name, value in (("PART", part), ("HELD", 40), ("SENT", 100)):
        monkeypatch.setattr(line_dedup, name, value)
    text = near_copies(40, part)
    rows = [(i, t) for i, t in enumerate(text)]
    got = line_dedup.dedup(frame(spark, [(*r, "s") for r in rows])).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_links"], r["kept_sha256"]) for r in got} == lines(rows, 80)
