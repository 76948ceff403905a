import corpus_pipeline
from brute import components, lcs, lower, words
from pyspark.sql import functions as F
from test_mixing_sharding import check_mix, check_shards

from ferrum.llm import toxicity
from ferrum.llm.base import documents, stored, table, trim


def test_each_stage_against_its_definition(spark, sf):
    """Every stage on what its predecessor kept, against brute force; its decisions take effect."""
    docs = documents(spark, sf)
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = stored(stage(spark, docs, sf), f"test-{name}")
        seen[name] = (before, [r.asDict() for r in docs.collect()], docs.columns)
    assert all(c == columns for _, _, c in list(seen.values())[:-1])

    before, after, _ = seen["toxicity"]
    scores = toxicity.toxicity(documents(spark, sf), table(spark, sf, "labels")).where("predicted = 0")
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in scores.collect())
    assert len(after) > 0.8 * len(before)

    before, after, _ = seen["near_dedup"]
    own = components([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, (n, c) in own.items() if c == i)

    before, after, _ = seen["decontaminate"]
    items = [words(lower(r["text"])) for r in table(spark, sf, "benchmark").collect()]
    left = {r["doc_id"] for r in after}
    for r in before:
        w = words(lower(r["text"]))
        if r["doc_id"] in left:
            assert not any(f" {' '.join(x)} " in f" {' '.join(w)} " for x in items)
        else:
            assert any(lcs(x, w[s: s + 3 * len(x) + 40]) >= 0.6 * len(x) for x in items for s in range(0, len(w), len(x) + 20))

    before, after, _ = seen["mix"]
    size = {}
    for r in before:
        size[r["source"]] = size.get(r["source"], 0) + len(words(r["text"]))
    times = {}
    for r in after:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 3
    from ferrum.llm import mixing
    goal = {r["source"]: r["target"] for r in mixing.targets(
        spark.createDataFrame(list(size.items()), "source string, size long")).collect()}
    check_mix([{"source": r["source"], "size": len(words(r["text"])), "source_size": size[r["source"]], "target": goal[r["source"]],
                "taken": times.get(r["doc_id"], 0) * len(words(r["text"]))} for r in before])

    before, after, names = seen["shard"]
    assert names == [*columns, "size", "old_shard", "shard", "slot"]
    assert sorted((r["doc_id"], r["text"]) for r in after) == sorted((r["doc_id"], r["text"]) for r in before)
    check_shards(after, corpus_pipeline.NEW_SHARDS, None)


def test_stages_take_edges_and_empty_tables(spark, sf, edge, empty):
    for docs in (edge, empty):
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf), f"edge-{name}")
            assert docs.columns == columns or name == "shard"
        assert docs.count() == 0 if n == 0 else docs.count() > 0
        assert docs.where(F.col("slot") < 0).count() == 0


def test_the_driver_gives_freed_native_memory_back(spark):
    """The JVM's own command is reached where it has it; a command that it does not have is no error."""
    has = spark.sparkContext._jvm.System.getProperty("java.version").split(".")
    if [int(x.split("-")[0]) for x in has][:3] >= [17, 0, 9]:
        assert "rim" in trim(spark)
    assert trim(spark, "noSuchCommand") == ""
