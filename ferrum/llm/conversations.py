"""Conversation structure repair: the cheapest edits that turn logged turns into well-formed conversations.

Well-formed role initials are ``(s?(ua)+)?``. A dynamic program walks the rows of a conversation with four states
(nothing yet, after a leading s, after u, after a). Each best prefix of edits is a linked node that shares
its ancestors with the others; nodes hold a rolling hash of their edits and binary-lifting ancestors, so two prefixes
of equal cost are compared by a search for their longest common prefix, whose ancestors are verified letter by letter
where they are not the same node. The letters alone decide states and costs, so equal prefixes are one node,
and of two equally cheap prefixes of the same rows and state neither begins the other: the least prefix stays least.

Spark's part: rows that repeat in every column are counted into one; what a row says is reduced to its initial, its
first fault and a 128-bit print of role and text. These narrow rows are sorted by (conversation, turn, print) over
ranges, so one conversation of any length spans several tasks. Each task runs the program over its
part of a conversation (from every state where the part may continue an earlier one) and emits the best edits from
state to state; the parts of a conversation, at most one per task, are chained. The audit then meets the texts
again, in one sorted pass that streams each conversation through its hash.

Defined results: order is turn (null first), then the print of role and text; a null role or text is one space (so a
null text is blank); turns without a conv_id are one conversation with a null id; a conversation without
rows after the damage has zeros, an empty audit and the hash of the empty string; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.llm.base import discard, stored

# The costs of edits and the characters that blank and truncated texts are told by.
REROLE, DELETE, INSERT, UNMENDED = 3, 4, 3, 3
VISIBLE = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

#: States: nothing yet, after a leading s, after u, after a.
START, LEAD, USER, ANSWER = range(4)
FOLLOWS = {START: "u", LEAD: "u", USER: "a", ANSWER: "u"}
REACHED = {"u": USER, "a": ANSWER}
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Prefixes:
    """A growing tree of edit prefixes; a node is a prefix, its parent the prefix without the last letter."""

    def __init__(self, prime: int = _PRIME) -> None:
        self.prime = prime
        self.letter, self.depth, self.print, self.up = [""], [0], [0], [()]

    def add(self, parent: int, letter: str) -> int:
        node = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.print.append((self.print[parent] * _BASE + ord(letter)) % self.prime)
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(tuple(up))
        return node

    def ancestor(self, node: int, depth: int) -> int:
        left, k = self.depth[node] - depth, 0
        while left:
            if left & 1:
                node = self.up[node][k]
            left, k = left >> 1, k + 1
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether two prefixes of one length are equal; equal prints of different nodes are read letter by letter."""
        if self.print[a] != self.print[b]:
            return False
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether prefix ``a`` is before ``b`` in ASCII order."""
        short = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, short), self.ancestor(b, short)
        if self._same(x, y):
            return self.depth[a] < self.depth[b]
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and not self._same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


class Audit:
    """The dynamic program over the rows of one conversation, or of a part of it, from one state on."""

    def __init__(self, entry: int = START, prime: int = _PRIME) -> None:
        self.tree = Prefixes(prime)
        self.best: dict[int, tuple[int, int]] = {entry: (0, 0)}

    def _settle(self, found: list[tuple[int, int, int, str]]) -> dict[int, tuple[int, int]]:
        """The best of candidates (state, cost, parent, letter) for each state."""
        won: dict[int, tuple[int, int, str]] = {}
        for state, cost, parent, letter in found:
            have = won.get(state)
            if have is None or cost < have[0] or (cost == have[0] and self._before(parent, letter, have[1], have[2])):
                won[state] = (cost, parent, letter)
        return {s: (cost, self.tree.add(parent, letter) if letter else parent) for s, (cost, parent, letter) in won.items()}

    def _before(self, parent: int, letter: str, other: int, last: str) -> bool:
        if parent == other and letter and last:
            return letter < last
        a = self.tree.add(parent, letter) if letter else parent
        b = self.tree.add(other, last) if last else other
        return self.tree.less(a, b)

    def _inserted(self) -> None:
        """Room for inserted turns: two at most are of use, as a third comes back to a state at a higher cost."""
        for into, sources in ((USER, (START, LEAD, ANSWER)), (ANSWER, (USER,))):
            found = [(s, *self.best[s], "") for s in self.best]
            found += [(into, self.best[s][0] + INSERT, self.best[s][1], "I") for s in sources if s in self.best]
            self.best = self._settle(found)

    def row(self, initial: str, fault: str) -> None:
        """One more row, by its role's first letter and its fault. Inserts stand after deletions (``DI`` is before ``ID``)."""
        found = [(s, cost + DELETE, node, "D") for s, (cost, node) in self.best.items()]
        if fault not in ("blank", "duplicate"):
            self._inserted()
            extra = UNMENDED if fault == "truncated" else 0
            for s, (cost, node) in self.best.items():
                if initial == FOLLOWS[s]:
                    found.append((REACHED[initial], cost + extra, node, "K"))
                else:
                    found.append((REACHED[FOLLOWS[s]], cost + extra + REROLE, node, "R"))
                if s == START and initial == "s":
                    found.append((LEAD, cost + extra, node, "K"))
        self.best = self._settle(found)

    def paths(self) -> list[tuple[int, int, str]]:
        """(state, cost, edits) of every state reached."""
        return [(s, cost, self.tree.text(node)) for s, (cost, node) in self.best.items()]


def finish(paths: list[tuple[int, int, str]]) -> tuple[int, str]:
    """(cost, edits) of the best path once trailing inserts have brought it to an accepted state."""
    ends = []
    for s, cost, edits in paths:
        for k in range(3):
            if s in (START, ANSWER):
                ends.append((cost + k * INSERT, edits + "I" * k))
                break
            s = REACHED[FOLLOWS[s]]
    return min(ends)


class _Chain:
    """Edits of consecutive parts as linked pieces; only what differs is compared."""

    __slots__ = ("before", "piece", "nth")

    def __init__(self, before: _Chain | None, piece: str) -> None:
        self.before, self.piece, self.nth = before, piece, before.nth + 1 if before else 0

    def text(self, stop: _Chain | None = None) -> str:
        out, at = [], self
        while at is not None and at is not stop:
            out.append(at.piece)
            at = at.before
        return "".join(reversed(out))


def _less(a: _Chain, b: _Chain) -> bool:
    x, y = a, b
    while x is not y:
        x, y = x.before, y.before
    return a.text(x) < b.text(x)


def chain(parts: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """(cost, edits) of a conversation from its parts, each as (entry, state, cost, edits)."""
    best = {START: (0, _Chain(None, ""))}
    for part in parts:
        got: dict[int, tuple[int, _Chain]] = {}
        for entry, state, cost, edits in part:
            if entry not in best:
                continue
            cost, link = cost + best[entry][0], _Chain(best[entry][1], edits)
            if state not in got or cost < got[state][0] or (cost == got[state][0] and _less(link, got[state][1])):
                got[state] = (cost, link)
        best = got
    return finish([(s, cost, link.text()) for s, (cost, link) in best.items()])


PARTS = "conv_id long, part long, entry int, state int, cost long, edits string, illegal long, first string, last string"
WHOLE = -1


def _audited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (conv_id, initial, fault, copies) of one task -> its conversations: the first and the last in parts
    (they may go on in other tasks), the others whole (entry and state ``WHOLE``)."""
    part = TaskContext.get().partitionId()
    at, dps, n, illegal, first, last, seen = None, [], 0, 0, "", "", 0
    out: list[tuple] = []

    def close(whole: bool) -> None:
        if whole:
            out.append((at[0], part, WHOLE, WHOLE, *finish(dps[0].paths()), illegal, first, last))
            return
        for entry, dp in enumerate(dps):
            out.extend((at[0], part, entry, s, cost, edits, illegal, first, last) for s, cost, edits in dp.paths())

    def frame() -> pd.DataFrame:
        got = pd.DataFrame(out, columns=[c.split()[0] for c in PARTS.split(", ")])
        out.clear()
        return got.astype({"conv_id": "Int64"})

    for pdf in batches:
        ids = [None if pd.isna(x) else int(x) for x in pdf["conv_id"]]
        for conv, initial, fault, more in zip(ids, pdf["initial"], pdf["fault"], pdf["copies"], strict=True):
            if at != (conv,):
                if seen:
                    close(whole=seen > 1)
                seen += 1
                at, dps = (conv,), [Audit(entry) for entry in range(4 if seen == 1 else 1)]
                n, illegal, first = 0, 0, initial
            for k in range(more):
                illegal += n > 0 and last + initial not in ("su", "ua", "au")
                n, last = n + 1, initial
                for dp in dps:
                    dp.row(initial, fault if k == 0 or fault == "blank" else "duplicate")
        if len(out) > 5000:
            yield frame()
    if seen:
        close(whole=False)
    yield frame()


def _chained(pdf: pd.DataFrame) -> pd.DataFrame:
    """The parts of one conversation -> its cost, audit and illegal neighbours."""
    parts, illegal, last = [], 0, None
    for _, got in pdf.sort_values("part").groupby("part"):
        parts.append(list(zip(got["entry"], got["state"], got["cost"], got["edits"], strict=True)))
        illegal += int(got["illegal"].iloc[0])
        illegal += last is not None and last + got["first"].iloc[0] not in ("su", "ua", "au")
        last = got["last"].iloc[0]
    cost, edits = chain(parts)
    conv = pdf["conv_id"].iloc[0]
    return pd.DataFrame({"conv_id": [None if pd.isna(conv) else int(conv)], "illegal": [illegal], "cost": [cost], "audit": [edits]}).astype({"conv_id": "Int64"})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows: of each conversation its audit, then its turns -> the hash of the repaired turns."""
    ids: list = []
    prints: list[str] = []
    at, edits, state, place, open_ = None, "", START, 0, None

    def put(role: str, text: str) -> None:
        nonlocal open_
        if open_ is None:
            open_ = [hashlib.sha256(), False]
        open_[0].update(("\n" if open_[1] else "").encode() + f"{role}:{text}".encode())
        open_[1] = True

    def insert() -> None:
        nonlocal place, state
        while place < len(edits) and edits[place] == "I":
            put("user" if FOLLOWS[state] == "u" else "assistant", "")
            state, place = REACHED[FOLLOWS[state]], place + 1

    def close() -> None:
        if at is not None:
            insert()
            ids.append(at[0])
            prints.append((open_[0] if open_ else hashlib.sha256()).hexdigest())

    def batch() -> pa.RecordBatch:
        got = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(prints, pa.string())], ["conv_id", "repaired_sha256"])
        ids.clear()
        prints.clear()
        return got

    for b in batches:
        cols = (b.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))
        for conv, audit, role, text in zip(*cols, strict=True):
            if audit is not None:
                close()
                at, edits, state, place, open_ = (conv,), audit, START, 0, None
                continue
            insert()
            edit, place = edits[place], place + 1
            if edit == "K" and state == START and role[:1] == "s":
                put(role, text)
                state = LEAD
            elif edit != "D":
                put(role if edit == "K" else "user" if FOLLOWS[state] == "u" else "assistant", text)
                state = REACHED[FOLLOWS[state]]
        yield batch()
    close()
    yield batch()


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text as logged by a faulty recorder: of each row, by the checksum of its key, nothing is
    left, or its text is empty, or without ends of sentences, or it is there twice, or it has the user's role."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    t = t.withColumn("fate", (F.crc32(key) % 20).cast("int")).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return t.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("c")).drop("c")


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Faults, cost, audit and hash of the repaired turns of each conversation (module docstring). ``ids``: conversations
    (column conv_id) that also count where no row of theirs is left."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    t = t.withColumns({"a": F.xxhash64("role", "text"), "b": F.xxhash64("text", F.lit("b"), "role"), "initial": F.substring("role", 1, 1)})
    bare = F.when(~F.col("text").rlike(VISIBLE), "blank").when(~F.col("text").rlike(ENDED), "truncated").otherwise("")
    same = ["conv_id", "turn", "a", "b", "initial"]
    narrow = t.withColumn("fault", bare).groupBy(*same, "fault").agg(F.count("*").alias("copies"))
    # The first row that says the same; null turns come first.
    when = F.struct(F.col("turn").isNotNull().alias("t"), F.col("turn"))
    firsts = narrow.where("fault <> 'blank'").groupBy("conv_id", "a", "b").agg(F.min(when).alias("first"), F.count("*").alias("k"))
    firsts = firsts.where("k > 1").select(*[F.col(c).alias(f"f_{c}") for c in ("conv_id", "a", "b", "first")])
    on = F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("a") == F.col("f_a")) & (F.col("b") == F.col("f_b"))
    narrow = narrow.join(firsts, on, "left")
    later = F.col("f_first").isNotNull() & (F.col("f_first") < when) & (F.col("fault") != "blank")
    narrow = stored(narrow.withColumn("fault", F.when(later, "duplicate").otherwise(F.col("fault"))).select(*same, "fault", "copies"), "repair-rows")

    order = ["conv_id", F.col("turn").asc_nulls_first(), "a", "b"]
    parts = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "initial", "fault", "copies")
    parts = stored(parts.mapInPandas(_audited, PARTS), "repair-parts")
    split = parts.where(F.col("entry") != WHOLE).groupBy("conv_id")  # two conversations of a task at most
    edits = split.applyInPandas(_chained, "conv_id long, illegal long, cost long, audit string").unionByName(
        parts.where(F.col("entry") == WHOLE).select("conv_id", "illegal", "cost", F.col("edits").alias("audit")))
    edits = stored(edits, "repair-edits")
    discard(parts)

    head = edits.select("conv_id", F.lit(0).alias("kind"), "audit", *[F.lit(None).cast(x).alias(c) for c, x in (
        ("turn", "long"), ("a", "long"), ("b", "long"), ("role", "string"), ("text", "string"))])
    body = t.withColumns({"kind": F.lit(1), "audit": F.lit(None).cast("string")}).select(head.columns)
    rows = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "a", "b")
    prints = rows.select("conv_id", "audit", "role", "text").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")

    n = lambda fault: F.sum(F.when(F.col("fault") == fault, 1).otherwise(0))
    # Of copies in one place, the first has the row's own fault, the others repeat it.
    again = F.sum(F.when(F.col("fault") == "blank", 0).otherwise(F.col("copies") - 1))
    span = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    facts = narrow.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"), F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(0)).alias("blank"),
        (n("duplicate") + again).alias("duplicate"), n("truncated").alias("truncated"))
    every = t.select("conv_id") if ids is None else ids.select(F.col("conv_id").cast("long").alias("conv_id")).unionByName(t.select("conv_id"))
    out = every.distinct().alias("e")
    for df, name in ((facts, "f"), (edits, "g"), (prints, "p")):
        out = out.join(df.alias(name), F.col("e.conv_id").eqNullSafe(F.col(f"{name}.conv_id")), "left")
    whole = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("e.conv_id", *whole, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


ORACLE = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
fated AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)),
                lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                  lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 20 AS fate FROM keyed),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS c FROM fated WHERE fate <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial FROM rows_),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM o),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM r),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
                 count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                 count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
jump(state, k, into_) AS (VALUES (0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (0, 1, 2), (1, 1, 2), (2, 1, 3), (3, 1, 2), (0, 2, 3), (1, 2, 3)),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'made': ''} AS best FROM facts
  UNION ALL
  SELECT conv_id, i, state, min({'cost': cost, 'audit': audit, 'made': made}) FROM (
    SELECT d.conv_id, f.i, o.state_ AS state, d.best.cost + 3 * j.k + o.price AS cost, d.best.audit || repeat('I', j.k) || o.edit AS audit,
           d.best.made || CASE WHEN j.k = 0 THEN '' WHEN j.k = 2 THEN chr(10) || 'user:' || chr(10) || 'assistant:'
                               WHEN j.into_ = 2 THEN chr(10) || 'user:' ELSE chr(10) || 'assistant:' END
           || CASE o.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
                          ELSE chr(10) || CASE WHEN o.state_ = 2 THEN 'user' ELSE 'assistant' END || ':' || f.text END AS made
    FROM dp d JOIN f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1 JOIN jump j ON j.state = d.state,
    LATERAL (SELECT 'D' AS edit, j.into_ AS state_, 4 AS price
             UNION ALL SELECT 'K', 1, CASE f.fault WHEN 'truncated' THEN 3 ELSE 0 END WHERE f.fault IN ('', 'truncated') AND j.into_ = 0 AND f.initial = 's'
             UNION ALL SELECT 'K', CASE WHEN j.into_ = 2 THEN 3 ELSE 2 END, CASE f.fault WHEN 'truncated' THEN 3 ELSE 0 END
               WHERE f.fault IN ('', 'truncated') AND f.initial = CASE WHEN j.into_ = 2 THEN 'a' ELSE 'u' END
             UNION ALL SELECT 'R', CASE WHEN j.into_ = 2 THEN 3 ELSE 2 END, 3 + CASE f.fault WHEN 'truncated' THEN 3 ELSE 0 END
               WHERE f.fault IN ('', 'truncated')) o) GROUP BY conv_id, i, state),
ends AS (SELECT d.conv_id, min({'cost': d.best.cost + 3 * j.k, 'audit': d.best.audit || repeat('I', j.k), 'made': d.best.made
                 || CASE WHEN j.k = 0 THEN '' WHEN j.k = 2 THEN chr(10) || 'user:' || chr(10) || 'assistant:' ELSE chr(10) || 'assistant:' END}) AS best
         FROM dp d JOIN facts n ON n.conv_id IS NOT DISTINCT FROM d.conv_id AND d.i = n.n JOIN jump j ON j.state = d.state
         WHERE j.into_ IN (0, 3) GROUP BY d.conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
       coalesce(e.best.audit, '') AS audit, sha256(coalesce(substr(e.best.made, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN facts n ON n.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
"""
