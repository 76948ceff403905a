import hashlib
import random
import zlib
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from brute import audit, conversation
from conftest import frame

from ferrum.llm import conversations as C
from ferrum.llm import divergence as D

EMPTY = hashlib.sha256(b"").hexdigest()
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def random_rows(rng, n):
    return [(rng.choice("suuaax"), rng.choice(["", "", "", "truncated", "duplicate", "blank"])) for _ in range(n)]


@pytest.mark.parametrize("prime", [C._PRIME, 1, 5])
def test_audit_is_the_cheapest_then_least(prime):
    """Also with rolling hashes that nearly always collide."""
    rng = random.Random(prime)
    for _ in range(300):
        rows = random_rows(rng, rng.randrange(0, 25))
        dp = C.Audit(prime=prime)
        for r in rows:
            dp.row(*r)
        assert C.finish(dp.paths()) == audit(rows)


def test_parts_chain_to_the_whole():
    rng = random.Random(2)
    for _ in range(200):
        rows = random_rows(rng, rng.randrange(1, 30))
        cuts = sorted(rng.sample(range(len(rows) + 1), min(3, len(rows))))
        parts = []
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            part = []
            for entry in range(4):
                dp = C.Audit(entry)
                for r in rows[a:b]:
                    dp.row(*r)
                part += [(entry, *p) for p in dp.paths()]
            parts.append(part)
        assert C.chain(parts) == audit(rows)


def talk(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, a int, audit string, fault string")


def of_brute(rows):
    """Undamaged rows -> result per conversation; ties of a turn must say the same."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [tuple(" " if x is None and i else x for i, x in enumerate(r[1:])) for r in rows if r[0] == conv]
        out[conv] = conversation(sorted(mine, key=lambda r: (r[0] is not None, r[0] or 0)))
    return out


def results(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_repair_equals_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(40)]:
        turns = sorted(rng.sample(range(30), rng.randrange(1, 14)))
        rows += [(conv, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                  rng.choice(["Yes.", "No!", "cut", "Why? ", " \t", "", None, "line\nline.", "é ☃."])) for t in turns]
        if conv and conv % 3 == 0:
            rows += [rows[-1], rows[-1]]
        if conv and conv % 7 == 0:
            rows.append((conv, None, "user", "Before all turns."))
    assert results(C.repair(talk(spark, rows))) == of_brute(rows)


def test_a_conversation_longer_than_a_task(spark):
    """Parts of two long conversations lie in many tasks; short ones between them are whole in one."""
    rng = random.Random(9)
    rows = []
    for conv, n in ((1, 1500), (2, 3), (3, 2), (4, 900), (5, 4)):
        rows += [(conv, k, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Same.", f"t{k}.", f"t{k}", " "])) for k in range(n)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        assert results(C.repair(talk(spark, rows).repartition(8))) == of_brute(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_damage_and_edges(spark):
    rows = [(c, t, "assistant", f"One. Two! {c} {t}?") for c in range(30) for t in range(6)] + [(None, None, None, None)]
    got = sorted(((r["conv_id"], r["turn"], r["role"], r["text"]) for r in C.damaged(talk(spark, rows)).collect()), key=str)
    want = []
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if fate == 4 else role, "" if fate == 1 else text.translate({ord(x): None for x in ".!?"}) if fate == 2 else text)
        want += [] if fate == 0 else [row, row] if fate == 3 else [row]
    assert got == sorted(want, key=str)
    assert {zlib.crc32(f"{c}:{t}".encode()) % 20 for c in range(30) for t in range(6)} >= {0, 1, 2, 3, 4}
    gone = C.repair(talk(spark, []), talk(spark, [(7, 1, "u", "x"), (None, 1, "u", "x")]))
    assert results(gone) == {7: (0, 0, 0, 0, 0, 0, "", EMPTY), None: (0, 0, 0, 0, 0, 0, "", EMPTY)}
    assert C.repair(talk(spark, [])).count() == 0
    long = [(1, 0, "user", "w " * 300_000 + "."), (1, 1, "assistant", "ok"), (1, 1, "assistant", "ok")]
    assert results(C.repair(talk(spark, long))) == of_brute(long)


def divergence_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(D.ORACLE).fetchall())


def invented(rng, n, vocabulary):
    out = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "fr", None]), rng.choice(["a", "b", "c", "Z", "é", None])
        words = [rng.choice(vocabulary) + rng.choice(["", "", "X", "é", "7b"]) for _ in range(rng.randrange(0, 40))]
        out.append((i % 50, rng.choice([None, " ".join(words), ",".join(words)]) if i % 9 == 0 else " ".join(words), lang, source))
    return out


@pytest.mark.parametrize("bits", [64, 7, 2])
def test_divergence_equals_sql_also_when_digests_collide(spark, bits):
    rows = invented(random.Random(bits), 400, [chr(97 + i) * (1 + i % 3) + chr(97 + (i * 7) % 26) for i in range(60)])
    df = spark.createDataFrame([(*r, 5, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n long, term string, digest int")
    assert sorted(tuple(r) for r in D.divergence(df.repartition(5), bits=bits).collect()) == divergence_sql(rows)


def test_many_sources_go_by_tiles(spark):
    rows = [(i, "common words of all " + f"own{chr(97 + s % 26)} " * (s % 5), "en", f"s{s:03}") for i, s in enumerate(list(range(80)) * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sorted(tuple(r) for r in D.divergence(df).collect())
    assert got == divergence_sql(rows) and sum(r[2] == "pair" for r in got) == 80 * 79


def test_divergence_edges(spark, edge, empty):
    assert D.divergence(empty).count() == 0
    got = {tuple(r) for r in D.divergence(edge).collect()}  # few documents: nothing is kept, every pair of sources is 0
    assert {r[4] for r in got} == {0} and {r[1] for r in got} == {"", "a", "b", "c", "d"} and {r[2] for r in got} == {"pair"}
    one = D.divergence(frame(spark, [(1, "x " * 200_000, "s")] * 12 + [(None, "x y", None)]))
    got = {tuple(r) for r in one.collect()}
    assert {r[:4] for r in got} >= {("en", "s", "pair", ""), ("en", "", "pair", "s")} and len(got) <= 4


@pytest.mark.parametrize("bits", [64, 3])
def test_counts_of_a_slice(bits):
    """Documents and occurrences by group and term, repeated terms and colliding digests too."""
    rng = random.Random(bits)
    rows = [(rng.choice("xy"), rng.choice(["p", "q", ""]), " ".join(rng.choices(["a", "B", "b", "cc", "ddddddddddd"], k=rng.randint(0, 9)))) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["lang", "source", "text"])
    everything = SimpleNamespace(value=np.full(1 << (D.FILTER_BITS - 6), 2**64 - 1, dtype=np.uint64))
    got = [r for b in D._counter(["lang", "source"], bits, everything)(iter([batch])) for r in b.to_pylist()]
    want = {}
    for lang, source, text in rows:
        for w in set(x := text.lower().split()):
            n, docs = want.get((lang, source, w), (0, 0))
            want[lang, source, w] = (n + x.count(w), docs + 1)
    assert len(got) == len(want) and {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in got} == want
