"""Conversation repair and the prefix trie against brute force."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from wardlight.llm import prefix_trie, structure_repair
from wardlight.llm.tree_contraction import subtree_sums

SCHEMA = "conv_id long, turn long, role string, text string, conv string, copies int, fault string, depth long"


def conversations():
    rng = random.Random(5)
    rows = []
    for c in range(60):
        n = rng.choice([0, 1, 2, 3, 4, 5])
        for t in range(n):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""])
            text = rng.choice(["Yes.", "No", "", " \n", "Why? ", None, "Fine!\x0b", "文。", "é."])
            rows.append((c, rng.choice([t, t, t + 3, None]), role, text))
    rows += [(70, 1, "user", "Same."), (70, 1, "user", "Same."), (71, None, None, None)]
    rows += [(None, 0, "user", "Lost."), (None, 1, "assistant", "Found."), (-6, 2, "system", "Go.")]
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*r, "x", None, "y", 9) for r in conversations()], SCHEMA)


def brute_damage(rows):
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, [])
        known = lambda x: " " if x is None else x
        code = zlib.crc32(f"{known(c)}:{known(t)}".encode()) % 20
        role, text = known(role), known(text)
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out[c] += [(t, role, text)] * (2 if code == 3 else 1)
    return {
        c: sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2].encode())) for c, v in out.items()
    }


def brute_repair(rows):
    """Uniform-cost search over whole edit strings: the least (cost, letters) that is legal."""
    seen, faults = set(), []
    for _, role, text in rows:
        kept = re.findall(r"[^\x20\x09-\x0D]", text)
        if not kept:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif kept[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
    heap, done = [(0, "", 0, ())], set()
    while heap:
        cost, letters, i, left = heapq.heappop(heap)
        if (letters, i, left) in done or cost > 4 * len(rows):
            continue
        done.add((letters, i, left))
        initials = "".join(x[0][:1] or "-" for x in left)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            break
        if not re.match("(s?(ua)*u?)$", initials):
            continue
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, letters + "I", i, (*left, (role, ""))))
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, letters + "D", i + 1, left))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                _, role, text = rows[i]
                heapq.heappush(heap, (cost + more, letters + "K", i + 1, (*left, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 3 + more, letters + "R", i + 1, (*left, (new, text))))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        letters,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
    ), left


def test_repair_is_the_cheapest_and_least(talks):
    rows = structure_repair.damage(talks)
    found = structure_repair.repair(rows)
    expected = {c: brute_repair(v) for c, v in brute_damage(conversations()).items()}
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    assert got == {c: e[0] for c, e in expected.items()}
    left = {}
    for r in structure_repair.repaired(rows, found).orderBy("conv_id", "place").collect():
        left.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert left == {c: list(e[1]) for c, e in expected.items() if e[1]}


def test_repair_of_long_and_empty(spark, talks, plan):
    """A conversation over many batches, with its way back spilled; one exchange; no rows."""
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Turn {t}.") for t in range(30_000)]
    long = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    found = structure_repair.repair(long)
    (report,) = found.collect()
    assert len(report["audit"].replace("I", "")) == 30_000
    assert report["cost"] == 3 * sum(c in "IR" for c in report["audit"]) + 4 * report["audit"].count("D")
    left = structure_repair.repaired(long, found).orderBy("place").collect()
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in left).encode()).hexdigest() == report["repaired_sha256"]
    assert re.fullmatch("(ua)+", "".join(r.role[0] for r in left))
    assert plan(structure_repair.repair(long)).count("Exchange hashpartitioning") == 1
    assert structure_repair.repair(structure_repair.damage(talks.limit(0))).count() == 0


def brute_trie(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        turns = tuple(own.get(donor, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in below if not any(y[: len(x)] == x and len(y) > len(x) for y in below)]
        out.append((
            convs[0], len(node), members[node[:-1]][0] if node else None, len(convs),
            sum(len(x) == len(node) + 1 for x in below), len(leaves),
            sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
            hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest(),
        ))
    return out


def test_trie(spark, talks, monkeypatch):
    rng = random.Random(8)
    more = [(c, t, rng.choice(["user", "assistant"]), rng.choice("xy")) for c in range(100, 160) for t in range(rng.choice([2, 9, 14]))]
    more += [(c, t, "user", "same") for c in range(200, 240) for t in range(6)]
    frame = talks.unionByName(spark.createDataFrame(more, "conv_id long, turn long, role string, text string"), allowMissingColumns=True)
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 40)
    found = prefix_trie.trie(frame).drop("ka", "kb").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute_trie(conversations() + more)))


def test_trie_of_nothing(talks):
    assert prefix_trie.trie(talks.limit(0)).count() == 0
    assert prefix_trie.trie(talks.filter("conv_id IS NULL")).count() == 0


def test_trie_of_one_long_conversation(spark):
    """Spread over many partitions: depths, sums and the chain's contraction hold."""
    rows = spark.range(3000).selectExpr("5L AS conv_id", "id AS turn", "'user' AS role", "cast(id AS string) AS text")
    h = zlib.crc32(b"5") % 9
    turns = prefix_trie.numbered_turns(rows)
    assert turns.select("piece").distinct().count() > 3
    assert [r[0] for r in turns.orderBy("at").select("pos").collect()] == list(range(3000))
    nodes = prefix_trie.prefixes(turns)
    assert nodes.count() == 3001 and nodes.select("depth", "ka", "kb").distinct().count() == 3001, h


def test_subtree_sums(spark):
    """A forest of a chain, a star and a random tree."""
    rng = random.Random(4)
    parent = {0: None, 200: None, 400: None}
    for i in range(1, 120):
        parent |= {i: i - 1, 200 + i: 200, 400 + i: 400 + rng.randrange(max(0, i - 5), i)}
    depth, sums = {}, dict.fromkeys(parent, 0)
    for i, p in parent.items():
        depth[i] = 0 if p is None else depth[p] + 1
        at = i
        while at is not None:
            sums[at] += i + 1
            at = parent[at]
    rows = [(i, p, depth[i], i + 1, None) for i, p in parent.items()]
    tree = spark.createDataFrame(rows, "id long, parent long, depth long, v long, none long")
    found = subtree_sums(tree, ["v", "none"]).collect()
    assert {r["id"]: r["v"] for r in found} == sums and not any(r["none"] for r in found)
