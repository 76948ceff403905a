import os
import sys

import duckdb
import pytest
from conftest import frame

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from check_oracle import norm  # noqa: E402

from ferrum.llm import chat, licenses  # noqa: E402
from ferrum.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == want


def test_license_scan_is_native(spark, sf):
    plan = QUERIES["op7_license_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def test_anchor_check_rejects_a_template_without_anchors(monkeypatch):
    monkeypatch.setitem(licenses.TEMPLATES, "bare", "some words that say nothing about it")
    with pytest.raises(ValueError):
        licenses.check_anchors()


def test_license_forms(spark, edge, empty):
    rows = [(1, licenses.TEMPLATES["mit"], "s"), (2, "prose here\n  RELEASED under the MIT   license!\nmore", "s"),
            (3, "I study the license of the public version of art", "s"),
            (4, "x\n\n" + licenses.TEMPLATES["gpl-3.0-or-later"].replace(", ", ",\n") + "\n\ny", "s"),
            (5, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY 4.0.", "s")]
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, rows)).collect()}
    assert [got[i]["licenses"] for i in range(1, 6)] == ["mit", "mit-line", "", "gpl-3.0-or-later", "apache-2.0-line,cc-by-4.0-line"]
    assert got[1]["best_dice"] == 1.0 and got[3]["best_license"] is None and got[3]["best_dice"] == 0.0 and got[5]["n_units"] == 2
    assert licenses.scan(edge).count() == edge.count() and licenses.scan(empty).count() == 0


TURNS = "conv_id long, turn long, role string, text string, nth int, chat string"


def talk(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)


def test_snapshots_collapse(spark):
    rows = []
    for conv, n in ((5, 1), (4, 2), (9, 4), (3, 4), (7, 3)):
        rows += [(conv, k, "user" if k % 2 == 0 else "bot", f"turn {k}") for k in range(n)]
    rows += [(8, 0, "user", "turn 0"), (8, 1, "bot", "another way"), (6, 0, "bot", "turn 0")]
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"], r["chat"]) for r in chat.formatted(talk(spark, rows)).collect()}
    assert {k: v[:2] for k, v in got.items()} == {3: (4, 2), 8: (2, 1), 6: (1, 1)}
    assert got[8][2] == "<|user|>\nturn 0<|end|>\n<|bot|>\nanother way<|end|>\n"


def test_long_conversations_span_cells(spark):
    rows = [(1, k, "u", f"t{k}") for k in range(900)] + [(2, k * 3, "u", f"t{k}") for k in range(700)] + [(3, k, "u", f"t{k + 1}") for k in range(5)]
    got = {r["conv_id"]: r["n_turns"] for r in chat.formatted(talk(spark, rows)).collect()}
    assert got == {1: 900, 3: 5}


def test_chat_edges(spark):
    rows = [(1, None, "u", "a"), (1, 0, None, None), (1, 0, None, None), (2, 0, "u", ""), (None, 0, "u", "lost"), (3, 1, "u", "b"), (3, 1, "u", "a")]
    got = {r["conv_id"]: (r["n_turns"], r["chat"]) for r in chat.formatted(talk(spark, rows)).collect()}
    assert got == {1: (2, "<|u|>\na<|end|>\n<||>\n<|end|>\n"), 2: (1, "<|u|>\n<|end|>\n"), 3: (2, "<|u|>\na<|end|>\n<|u|>\nb<|end|>\n")}
    assert chat.formatted(talk(spark, [])).count() == 0


MIT_LAYOUT = licenses.TEMPLATES["mit"].replace("following conditions: ", "following conditions:\n\n").replace(
    "portions of the Software. ", "portions of the Software.\n\n")
APACHE_LAYOUT = licenses.TEMPLATES["apache-2.0"].replace("with the License. ", "with the License.\n").replace(
    "obtain a copy of the License at ", "obtain a copy of the License at\n\n    ").replace("LICENSE-2.0 ", "LICENSE-2.0\n\n")
CODE = "\n".join(f"def step_{k}(x_{k}):\n    return x_{k} + {k} * offset_{k % 7}" for k in range(30))


def commented(text, width=9):
    w = text.split()
    return "\n".join("# " + " ".join(w[k: k + width]) for k in range(0, len(w), width))


def test_licenses_that_are_not_one_unit(spark):
    """Standard layouts straight above code, with and without blank lines or comment marks, and inside a paragraph."""
    gpl = licenses.TEMPLATES["gpl-3.0-or-later"]
    rows = [(1, f"MIT License\n\nCopyright (c) 2020 A. Person\n\n{MIT_LAYOUT}\n\n{CODE}"), (2, f"{APACHE_LAYOUT}\n\n{CODE}"),
            (3, f"{commented(gpl)}\n{CODE}"), (4, f"{CODE}\n{commented(licenses.TEMPLATES['mit'])}\n{CODE}"),
            (5, f"All pictures of this page are our own work. {licenses.TEMPLATES['cc-by-4.0-line']} Write to us before you print them on paper."),
            (6, f"{commented(gpl.replace('either version 3 of', 'in either one of the versions 3 of'))}\n{CODE}"),
            (7, f"{commented(gpl.replace('as published by the Free Software Foundation, ', ''))}\n{CODE}"),
            (8, f"{CODE}\nthe license of the public version permits free use and a copy of the software\n{CODE}"),
            (9, f"{commented(licenses.TEMPLATES['mpl-2.0'])}\n{CODE}\n{commented(licenses.TEMPLATES['isc'])}\n{CODE}"), (10, CODE)]
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, [(*r, "s") for r in rows])).collect()}
    assert [got[i]["licenses"] for i in range(1, 11)] == ["mit", "apache-2.0", "gpl-3.0-or-later", "mit", "cc-by-4.0-line", "gpl-3.0-or-later",
                                                          "gpl-3.0-or-later", "", "isc,mpl-2.0", ""]
    assert [got[i]["n_units"] for i in range(1, 11)] == [1, 1, 1, 1, 1, 1, 1, 0, 2, 0] and got[1]["best_dice"] > 0.97 and got[5]["best_dice"] == 1.0
