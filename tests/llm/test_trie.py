"""Prefix trie: whole results against brute force, across block ends, with odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import demand_engine.llm.trie as trie
import pytest
from demand_engine.llm.ranges import running
from pyspark.sql import functions as F


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def conversations(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    return {c: [(r, t) for *_, r, t in sorted(own)] for c, own in said.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(first, [])[:h] + own[h:]
    return out


def nodes(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def own(path):
        return (len(members[path]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0

    leaves, saved = Counter(), Counter()
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
        saved[path] = own(path) + sum(saved[x] for x in children[path])
    return Counter(
        (
            members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in members[p] if len(convs[c]) == len(p)).encode()).hexdigest(),
        )
        for p in members
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, place int, key string, block string")


def tree_like(seed, convs, longest, copies=0):
    rng, rows = random.Random(seed), []
    for c in [*range(convs), -3, -45, 10**12]:
        for k in range(rng.randint(1, longest)):
            text = rng.choice(["a b", "a  c\td", "", None]) if rng.random() < 0.9 else f"own {c}"
            rows.append((c, rng.choice([None, k, k, k // 2]), rng.choice(["user", None, "assistant"]) if k % 5 == 0 else "user", text))
    long = [(convs + 40 + k, t, "user", f"same {t}") for k in range(copies) for t in range(35)]
    return rows + long + [(None, 0, "user", "of nobody")] + rows[:3]


@pytest.mark.parametrize("seed, convs, longest, copies", [(1, 90, 4, 0), (2, 40, 30, 3), (3, 6, 70, 2)])
def test_rebuilt_conversations_equal_brute_force(spark, monkeypatch, seed, convs, longest, copies):
    monkeypatch.setattr(trie, "PIECE_IDS", 2)
    rows = tree_like(seed, convs, longest, copies)
    got = Counter(tuple(r) for r in trie.trie_report(frame(spark, rows)).collect())
    assert got == nodes(rebuilt(conversations(rows)))


def test_plain_conversations_equal_brute_force(spark):
    rows = [(c, t, "user", "x y" if t < 16 else f"{c % 3}") for c in range(7) for t in range(8 * (c % 3) + c % 2 + 1)]
    got = Counter(tuple(r) for r in trie.conversation_trie(frame(spark, rows)).collect())
    assert got == nodes(conversations(rows))


def test_no_conversation_no_node(spark):
    assert trie.trie_report(frame(spark, [(1, 1, "a", "b")]).limit(0)).count() == 0
    assert trie.trie_report(frame(spark, [(None, 1, "a", "b")])).count() == 0


def test_turnless_conversations_are_at_the_root(spark):
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    got = trie.trie_report(frame(spark, [(lone, 0, "user", "gone")])).collect()
    assert [tuple(r) for r in got] == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_long_conversations_take_the_logarithm_of_their_blocks(spark):
    rows = [(0, t, "user", f"turn {t}") for t in range(200)]
    placed = trie.placed_turns(frame(spark, rows))
    members = trie.member_blocks(placed, placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length")))
    assert members.count() == 25 and members.select("prior").distinct().count() == 25
    assert trie.trie_nodes(members).agg(F.max("depth")).first()[0] == 200


def test_running_totals_within_groups_that_span_ranges(spark):
    rows = [(g, k, k % 7) for g in (None, 1, 2) for k in range(500 if g == 1 else 3)]
    df = spark.createDataFrame(rows, "g int, k int, v int")
    got = {(r.g, r.k): (r.total, r.place) for r in running(df, ["g"], [F.col("k").asc()], {"total": F.col("v"), "place": F.lit(1)}).collect()}
    assert len(got) == len(rows)
    assert all(got[g, k] == (sum(j % 7 for j in range(k)), k) for g, k, _ in rows)
    whole = running(df, [], [F.col("g").asc_nulls_last(), F.col("k").asc()], {"place": F.lit(1)})
    assert sorted(r.place for r in whole.collect()) == list(range(len(rows)))
