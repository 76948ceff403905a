"""Property tests: Spark operators vs straightforward Python definitions on random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrum.functions import dates as D
from ferrum.functions import text as X
from ferrum.operators import ledger as L
from ferrum.operators.joins import not_in

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _py_snake(name):
    """Character by character: a break before a capital that begins a word, and before one that follows a small
    letter or a digit."""
    marked = ""
    for i, c in enumerate(name):
        begins_word = c.isupper() and name[i + 1: i + 2].islower() and marked != "" and not marked.endswith("|")
        marked += ("|" if begins_word else "") + c
    out = ""
    for i, c in enumerate(marked):
        if c == "|":
            out += "_"
        else:
            after = i and (marked[i - 1].islower() or marked[i - 1].isdigit())
            out += ("_" if c.isupper() and after else "") + c
    return out.lower()


@SETTINGS
@given(st.lists(st.text(alphabet="aAbBzZ09_xYQ", min_size=0, max_size=14), min_size=1, max_size=30))
def test_snake_case_matches_python_rule(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r[0] for r in df.select(X.snake_case("s")).collect()]
    assert got == [_py_snake(w) for w in words]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 9)), max_size=20),
       st.lists(st.one_of(st.none(), st.integers(0, 9)), max_size=8))
def test_not_in_matches_sql_three_valued_logic(spark, left, right):
    ldf = spark.createDataFrame([(v,) for v in left], "k int")
    rdf = spark.createDataFrame([(v,) for v in right], "k int")
    got = sorted((r.k for r in not_in(ldf, rdf, "k").collect()), key=lambda x: (x is None, x))

    def keep(v):
        if not right:
            return True
        if v is None or None in right:
            return False
        return v not in right
    assert got == sorted((v for v in left if keep(v)), key=lambda x: (x is None, x))


@SETTINGS
@given(st.lists(st.tuples(st.dates(dt.date(2023, 12, 1), dt.date(2024, 2, 1)),
                          st.dates(dt.date(2023, 12, 1), dt.date(2024, 2, 1))), min_size=1, max_size=15))
def test_inclusive_days(spark, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    rows = df.select(D.inclusive_days("a", "b", "swap").alias("s"), D.inclusive_days("a", "b", "empty").alias("e")).collect()
    for (a, b), r in zip(pairs, rows):
        lo, hi = min(a, b), max(a, b)
        assert r.s == [lo + dt.timedelta(i) for i in range((hi - lo).days + 1)]
        assert r.e == ([a + dt.timedelta(i) for i in range((b - a).days + 1)] if a <= b else [])


STATUS = st.sampled_from(["RUNNING", "SUCCESS", "FAILED"])
JOB = st.tuples(st.sampled_from(["k1", "k2"]), st.sampled_from([0, 100]), STATUS, st.booleans(), st.integers(0, 3))


@SETTINGS
@given(st.lists(JOB, min_size=1, max_size=25))
def test_failed_jobs_matches_left_join_definition(spark, jobs):
    rows = [(k, f, None, s, "2024-01-01 00:00:00", "2024-01-01 00:05:00" if fin else None, r, None)
            for k, f, s, fin, r in jobs]
    ledger = spark.createDataFrame(rows, "kpi string, from_id long, to_id long, status string, created_at string, "
                                         "finished_at string, retries int, details string").withColumns(
        {"created_at": F.col("created_at").cast("timestamp"), "finished_at": F.col("finished_at").cast("timestamp")})
    got = sorted((r.kpi, r.from_id, r.retries) for r in L.failed_jobs(ledger).collect())
    failed, active = {}, {}
    for k, f, s, fin, r in jobs:
        if s == "FAILED" and fin:
            failed[(k, f)] = max(failed.get((k, f), -1), r)
        if (s == "RUNNING" and not fin) or (s == "SUCCESS" and fin):
            active[(k, f)] = max(active.get((k, f), -1), r)
    want = sorted((k, f, r) for (k, f), r in failed.items() if active.get((k, f)) is None or r != active[(k, f)] - 1)
    assert got == want


RANGE = st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(0, 5000)), st.one_of(st.none(), st.integers(0, 5000)))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5000)), min_size=1, max_size=40),
       st.lists(RANGE, max_size=8))
def test_range_join_matches_brute_force(spark, records, ranges):
    from ferrum.operators.joins import in_ranges
    rec = spark.createDataFrame(records, "kpi string, id long")
    rng = spark.createDataFrame(ranges, "kpi string, from_id long, to_id long")

    def inside(k, i):
        return any(rk == k and lo is not None and hi is not None and lo <= i <= hi for rk, lo, hi in ranges)
    semi = sorted(tuple(r) for r in in_ranges(rec, rng, key="kpi", id_col="id").collect())
    anti = sorted(tuple(r) for r in in_ranges(rec, rng, key="kpi", id_col="id", how="left_anti").collect())
    assert semi == sorted(r for r in records if inside(*r))
    assert anti == sorted(r for r in records if not inside(*r))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 3000)), min_size=1, max_size=40),
       st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3000), st.sampled_from(["bounded", "unbounded"])),
                max_size=4, unique_by=lambda j: j[0]))
def test_scan_ranges_matches_brute_force(spark, records, jobs):
    rec = spark.createDataFrame(records, "kpi string, id long")
    jdf = spark.createDataFrame([(k, f, 0, m) for k, f, m in jobs], "kpi string, from_id long, retries int, mode string")
    got = sorted((r.kpi, r.id) for r in L.scan_ranges(rec, jdf, batch_size=1000).collect())
    want = sorted((k, i) for k, i in records for jk, f, m in jobs
                  if jk == k and i >= f and (m == "unbounded" or i <= f + 1000))
    assert got == want


@SETTINGS
@given(st.dictionaries(st.integers(0, 20), st.tuples(st.one_of(st.none(), st.sampled_from("abc")),
                                                     st.one_of(st.none(), st.integers(0, 9))), max_size=10),
       st.dictionaries(st.integers(0, 20), st.tuples(st.one_of(st.none(), st.sampled_from("xyz")),
                                                     st.one_of(st.none(), st.integers(10, 19))), max_size=10))
def test_merge_non_null_matches_dict_definition(spark, current, updates):
    from ferrum.sinks.writers import merge_non_null
    schema = "k int, name string, v int"
    cur = spark.createDataFrame([(k, *v) for k, v in current.items()], schema)
    upd = spark.createDataFrame([(k, *v) for k, v in updates.items()], schema)
    got = sorted(tuple(r) for r in merge_non_null(cur, upd, "k").collect())
    want = {}
    for k in set(current) | set(updates):
        old, new = current.get(k, (None, None)), updates.get(k, (None, None))
        want[k] = tuple(n if n is not None else o for n, o in zip(new, old))
    assert got == sorted((k, *v) for k, v in want.items())
