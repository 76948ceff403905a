"""Sharding by minimum-cost flow: the block transfers that move the fewest bytes.

Old shards have sizes, new shards have capacities. Bytes that stay in their shard cost nothing, bytes
that move cost 1 each; successive shortest paths over the network old shard -> new shard give the
transfers of least cost. The network has one node per shard, never per document.

Documents of an old shard are ordered by a hash of their text, then of their id, so equal texts are
neighbours, and the shard's outgoing flows cut this order into blocks; a document goes to the block
that holds its middle byte. Running sums come from histograms (``CELLS`` cells of the text's hash,
``FINE`` of the id's in each), so only documents of one fine cell are ordered in a window; a text that
a third of all rows share is spread over the fine cells.

Defined results: a null text has no bytes; the size adds ``overhead`` to the bytes; an empty table
gives no rows; repeated rows are separate rows with slots of their own; equal texts stay together but
where a block boundary falls between them; a null id is hashed as null. ``reshard`` keeps all columns.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrum.llm.base import stored, unused

CELLS, FINE = 128, 1024


def min_cost_flow(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Bytes moved from old shard i to new shard j at least cost, as {(i, j): bytes}.

    Cost 0 for i == j and 1 otherwise. Successive shortest paths with potentials; supplies in total
    must not exceed the capacities.
    """
    a, b = len(supply), len(capacity)
    source, sink = a + b, a + b + 1
    graph: list[list[list[int]]] = [[] for _ in range(a + b + 2)]  # [to, room, cost, index of the way back]

    def edge(u: int, v: int, room: int, cost: int) -> None:
        graph[u].append([v, room, cost, len(graph[v])])
        graph[v].append([u, 0, -cost, len(graph[u]) - 1])

    for i, x in enumerate(supply):
        edge(source, i, x, 0)
        for j in range(b):
            edge(i, a + j, x, int(i != j))
    for j, x in enumerate(capacity):
        edge(a + j, sink, x, 0)
    height, need = [0] * len(graph), sum(supply)
    while need > 0:
        dist, came = [float("inf")] * len(graph), [None] * len(graph)
        dist[source], todo = 0, [(0, source)]
        while todo:
            d, u = heapq.heappop(todo)
            if d > dist[u]:
                continue
            for k, (v, room, cost, _) in enumerate(graph[u]):
                if room > 0 and (n := d + cost + height[u] - height[v]) < dist[v]:
                    dist[v], came[v] = n, (u, k)
                    heapq.heappush(todo, (n, v))
        if came[sink] is None:
            raise ValueError("the new capacities are smaller than the old sizes")
        height = [h + (d if d < float("inf") else 0) for h, d in zip(height, dist, strict=True)]
        push, v = need, sink
        while v != source:
            u, k = came[v]
            push, v = min(push, graph[u][k][1]), u
        v = sink
        while v != source:
            u, k = came[v]
            graph[u][k][1] -= push
            graph[v][graph[u][k][3]][1] += push
            v = u
        need -= push
    return {(i, v - a): graph[v][back][1] for i in range(a) for v, _, _, back in graph[i] if a <= v < a + b and graph[v][back][1] > 0}


def _keyed(docs: DataFrame, old: Column, text: str, doc_id: str, overhead: int) -> DataFrame:
    """``docs`` with the helper columns ``_*``: size, old shard, cells and order."""
    raw = F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))
    th, dh = F.xxhash64(raw), F.xxhash64(F.col(doc_id).cast("string"), F.lit("shard"))
    return docs.withColumns({
        "_size": (F.length(raw) + overhead).cast("long"), "_was": old.cast("int"), "_text": th, "_id": dh,
        "_cell": F.pmod(F.shiftrightunsigned(th, 20), F.lit(CELLS)).cast("int"), "_fine": F.pmod(dh, F.lit(FINE)).cast("int")})


def _located(work: DataFrame, starts: DataFrame, cuts: dict[int, list[tuple[int, int]]]) -> DataFrame:
    """``work`` joined to ``starts`` with ``_shard`` and ``_nth``, the place within its fine cell."""
    order = Window.partitionBy("_was", "_cell", "_fine").orderBy("_text", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    got = work.join(starts, ["_was", "_cell", "_fine"]).withColumn("_nth", F.count("*").over(order)).withColumn(
        "_mid", F.col("_start") + F.sum("_size").over(order) - F.col("_size") / 2)
    if not cuts:
        return got.withColumn("_shard", F.lit(0))
    table = F.create_map(*[x for i, at in cuts.items() for x in (F.lit(i), F.array(
        *[F.struct(F.lit(lo).cast("long").alias("lo"), F.lit(j).alias("j")) for lo, j in at]))])
    mine = F.filter(F.element_at(table, F.col("_was")), lambda x: x["lo"] <= F.col("_mid"))
    return got.withColumn("_shard", F.element_at(mine, -1)["j"])


def assign(docs: DataFrame, old: Column, old_shards: int, new_shards: int, text: str = "text", doc_id: str = "doc_id",
           overhead: int = 16) -> DataFrame:
    """``docs`` with size, old_shard, shard and slot (an underscore is added where a name is taken).

    ``old`` gives the shard that a row is in now (0 .. old_shards - 1). New capacities are equal. The
    plan is made from (size, hashes) alone; the rows themselves are shuffled once, by fine cell.
    """
    names = docs.columns
    out_names = [unused(docs, c) for c in ("size", "old_shard", "shard", "slot")]
    safe = [f"c{k}" for k in range(len(names))]  # no clash with the helper columns below
    docs = docs.select("*", old.cast("int").alias("old_")).toDF(*safe, "old_")
    text, doc_id, old = safe[names.index(text)], safe[names.index(doc_id)], F.col("old_")
    keyed = _keyed(docs, old, text, doc_id, overhead)
    thin = stored(keyed.select("_size", "_was", "_text", "_id", "_cell", "_fine"), "shard-sizes")
    cells = stored(thin.groupBy("_was", "_cell", "_fine").agg(F.sum("_size").alias("bytes")), "shard-cells")
    sums = {r[0]: int(r[1]) for r in cells.groupBy("_was").agg(F.sum("bytes")).collect()}  # one row per old shard
    total = sum(sums.values())
    flows = min_cost_flow([sums.get(i, 0) for i in range(old_shards)],
                          [total // new_shards + (j < total % new_shards) for j in range(new_shards)])
    cuts: dict[int, list[tuple[int, int]]] = {}
    for i in range(old_shards):
        at = 0
        for j in sorted((j for k, j in flows if k == i), key=lambda j: (j != i, j)):
            cuts.setdefault(i, []).append((at, j))
            at += flows[i, j]
    # running sums over the cells of a shard, then over the fine cells of a cell
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    coarse = cells.groupBy("_was", "_cell").agg(F.sum("bytes").alias("cb")).withColumn("c0", sum_before("cb", before("_was", "_cell")))
    starts = cells.withColumn("f0", sum_before("bytes", before("_was", "_cell", "_fine"))).join(coarse, ["_was", "_cell"])
    starts = stored(starts.select("_was", "_cell", "_fine", (F.col("c0") + F.col("f0")).alias("_start")), "shard-starts")
    # rows of each fine cell by new shard, and the slot at which they begin
    counts = stored(_located(thin, starts, cuts).groupBy("_shard", "_was", "_cell", "_fine").agg(
        F.count("*").alias("n"), F.min("_nth").alias("nth")), "shard-counts")
    by_old = counts.groupBy("_shard", "_was").agg(F.sum("n").alias("on")).withColumn("o0", sum_before("on", before("_shard", "_was")))
    by_cell = counts.groupBy("_shard", "_was", "_cell").agg(F.sum("n").alias("cn")).withColumn(
        "c0", sum_before("cn", before("_shard", "_was", "_cell")))
    firsts = counts.withColumn("f0", sum_before("n", before("_shard", "_was", "_cell", "_fine"))).join(
        by_cell, ["_shard", "_was", "_cell"]).join(by_old, ["_shard", "_was"])
    firsts = firsts.groupBy("_was", "_cell", "_fine").agg(F.map_from_entries(F.collect_list(F.struct(
        "_shard", F.col("o0") + F.col("c0") + F.col("f0") - F.col("nth")))).alias("_firsts"))  # an entry per shard at most
    starts = stored(starts.join(firsts, ["_was", "_cell", "_fine"]), "shard-starts")
    out = _located(keyed, starts, cuts).withColumn("_nth", F.col("_nth") + F.element_at("_firsts", F.col("_shard")))
    out = out.withColumn("_nth", F.col("_nth").cast("long"))
    return out.select(*safe, "_size", "_was", "_shard", "_nth").toDF(*names, *out_names)


def old_layout(shards: int, text: str = "text") -> Column:
    """Shard of a row in a layout dealt by text: equal texts share a shard."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("old")), F.lit(shards))


def reshard(docs: DataFrame, old_shards: int, new_shards: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard of every row (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = assign(docs, old_layout(old_shards), old_shards, new_shards)
    return out.select("doc_id", "size", F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("text_crc32"),
                      F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def rewritten(docs: DataFrame, old: Column, old_shards: int, new_shards: int, path: str) -> DataFrame:
    """``assign``, and the files of every new shard that gains or loses rows, written under ``path/shard=N``.

    Returns the rows of the new layout: those of the affected shards read from their files, the others from where they are.
    """
    out = assign(docs, old, old_shards, new_shards)
    shard, was = unused(docs, "shard"), unused(docs, "old_shard")
    moved = out.where(F.col(was) != F.col(shard))
    hit = stored(moved.select(F.col(shard).alias("hit_")).union(moved.select(F.col(was).alias("hit_"))).where(
        F.col("hit_") < new_shards).distinct(), "shard-hit")  # at most one row per shard
    on = F.col(shard) == F.col("hit_")
    changed = out.join(F.broadcast(hit), on, "left_semi")
    changed.hint("rebalance", F.col(shard)).write.partitionBy(shard).parquet(path)
    back = docs.sparkSession.read.schema(out.schema).parquet(path)
    return back.select(out.columns).unionByName(out.join(F.broadcast(hit), on, "left_anti"))
