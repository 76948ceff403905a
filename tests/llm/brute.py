"""Plain-Python definitions that the Spark operators are tested against."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rule_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for v in windows.values() if len(v) > 1 for i in v for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def shingles(text, width):
    w = words(lower(text))
    if len(w) >= width:
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def components(rows, width, percent):
    """{doc_id: (set size, smallest id of the component)} of rows (doc_id, text) with unique ids."""
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for i, s in sorted(sets.items()):
        seen = Counter(j for x in s for j in index.get(x, ()))
        for j, n in seen.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            index.setdefault(x, []).append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeats(rows, length):
    """{doc_id: (bytes, removed, spans, sha256 of the rest)} of rows (doc_id, text) with unique ids."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        cut = [False] * len(b)
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w in seen:
                cut[k:k + length] = [True] * length
            seen.add(w)
        spans = sum(c and not p for c, p in zip(cut, [False, *cut]))
        kept = bytes(x for x, c in zip(b, cut) if not c)
        out[i] = (len(b), sum(cut), spans, hashlib.sha256(kept).hexdigest())
    return out


def lines(rows, percent):
    """{doc_id: (lines, removed, links, sha256 of the rest)} of rows (doc_id, text) with unique ids."""
    first, all_lines = {}, []
    for i, t in sorted(rows):
        for k, x in enumerate((t or "").split("\n")):
            s = frozenset(words(lower(x)))
            if s:
                first.setdefault(s, (i, k))
                all_lines.append((i, k, s))
    near = {s: [y for y in first if y is not s and 100 * len(s & y) >= percent * len(s | y)] for s in first}
    gone = {(i, k) for i, k, s in all_lines if first[s] != (i, k)}
    gone |= {first[s] for s, ys in near.items() if any(first[y] < first[s] for y in ys)}
    out = {}
    for i, t in rows:
        parts = (t or "").split("\n")
        sets = [frozenset(words(lower(x))) for x in parts]
        kept = "\n".join(x for k, x in enumerate(parts) if (i, k) not in gone)
        out[i] = (sum(map(bool, sets)), sum((i, k) in gone for k in range(len(parts))),
                  sum(len(near[s]) for k, s in enumerate(sets) if s and first[s] == (i, k)), hashlib.sha256(kept.encode()).hexdigest())
    return out


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            keep = row[j + 1]
            row[j + 1] = last + 1 if x == y else max(row[j + 1], row[j])
            last = keep
    return row[-1]


def water_fill(sizes, weights, most):
    """Targets of {source: size}: shares by weight, stopped at ``most`` times the size, excess reshared."""
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in full]
        rest = total - sum(most * sizes[s] for s in full)
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else share[s] for s in sizes}
        full |= over


def audit(rows):
    """(cost, edits) of the cheapest, then least, edits of rows (initial, fault); strings are kept for every state."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def better(got, state, cand):
        if state not in got or cand < got[state]:
            got[state] = cand

    def grown(best):
        got = dict(best)
        for _ in range(3):
            for s, (cost, edits) in list(got.items()):
                better(got, step[s], (cost + 3, edits + "I"))
        return got

    for initial, fault in rows:
        got = {}
        for s, (cost, edits) in grown(best).items():
            better(got, s, (cost + 4, edits + "D"))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            better(got, step[s], (cost + extra + 3, edits + "R"))
            if initial == step[s]:
                better(got, step[s], (cost + extra, edits + "K"))
            if s == "" and initial == "s":
                better(got, "s", (cost + extra, edits + "K"))
        best = got
    return min(v for s, v in grown(best).items() if s in ("", "a"))


def repaired(rows, edits):
    """``role:text`` lines that ``edits`` make of rows (role, text)."""
    out, last, it = [], "", iter(rows)
    for e in edits:
        want = "assistant" if last == "u" else "user"
        if e == "I":
            out.append((want, ""))
        else:
            role, text = next(it)
            if e == "D":
                continue
            out.append((role if e == "K" else want, text))
        last = out[-1][0][0]
    return "\n".join(f"{r}:{t}" for r, t in out)


def conversation(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash of one conversation's rows (turn, role, text) in order."""
    import hashlib
    import re

    turns = [t for t, _, _ in rows if t is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if text.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" else "truncated")
        seen.add((role, text))
    first = [r[:1] for _, r, _ in rows]
    cost, edits = audit(list(zip(first, faults, strict=True)))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)), cost, edits,
            hashlib.sha256(repaired([r[1:] for r in rows], edits).encode()).hexdigest())
