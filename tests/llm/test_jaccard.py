import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import demand_engine.llm.jaccard as module
from demand_engine.llm.graphs import components
from demand_engine.llm.jaccard import _pack, _unpack, similar_documents
from demand_engine.llm.vectors import shingles, word_bounds, word_hashes, NOT_BLANK


def sets(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows):
    found = [sets(t) for _, t in rows]
    links = [set() for _ in rows]
    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(found[i] & found[j])
        if found[i] and 100 * common >= 80 * len(found[i] | found[j]):
            links[i].add(j)
            links[j].add(i)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(found[i]), min(ids, default=None), len({found[j] for j in links[i]} - {found[i]})))
    return sorted(out, key=repr)


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice("uvwxyz") * rng.randint(1, 6)
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (None, "one two"), (4, "one two")]
    family = [f"w{k}" for k in range(60)]
    rows += [(100 + k, edited(family, rng, rng.randint(0, 4))) for k in range(60)]
    for b in range(12):
        base = [f"b{b}x{k}" for k in range(rng.randint(5, 80))]
        rows += [(1000 + 10 * b + k, edited(base, rng, k // 2)) for k in range(4)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(2000 + k, passage + " " + " ".join(f"q{k}x{j}" for j in range(40))) for k in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("group", [8, 10_000])
def test_all_links_by_pairs_and_by_blocks(spark, monkeypatch, group):
    monkeypatch.setattr(module, "PAIR_GROUP", group)
    monkeypatch.setattr(module, "BLOCK", 16)
    monkeypatch.setattr(module, "CHUNK_TOKENS", 700)
    rows = corpus(group)
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id bigint, text string, n int").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in similar_documents(df).collect()), key=repr)
    assert got == brute(rows)


def results(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in similar_documents(df).collect()), key=repr)


def copies(n):
    """A text n times, and one with two thirds of its words whose other third is frequent: no link, unless tokens count twice."""
    words, common = [f"w{k}" for k in range(90)], [f"v{k}" for k in range(30)]
    rows = [(k, " ".join(words)) for k in range(n)] + [(100, " ".join(words[:60] + common))]
    return rows + [(200 + k, " ".join(common + [f"c{k}x{j}" for j in range(9)])) for k in range(8)]


def test_copies_in_partitions_of_their_own(spark):
    rows = copies(3)
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id bigint, text string")
    assert df.rdd.getNumPartitions() == len(rows)
    assert results(df) == brute(rows)


def test_copies_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK_TOKENS", 300)
    rows = copies(20)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert results(df) == brute(rows)


def test_buckets_grow_with_the_texts(spark, monkeypatch):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    whole = results(df)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert module._buckets(df) == partitions and whole == brute(rows)
    monkeypatch.setattr(module, "BUCKET_BYTES", 100)
    size = sum(len(t or "") for _, t in rows)
    assert module._buckets(df) == -(-size // 100) > 10 * partitions
    assert results(df) == whole


def test_empty_table(spark):
    assert similar_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    for x in (np.zeros(0, np.uint64), np.sort(rng.integers(0, 1 << 47, 500).astype(np.uint64)), np.array([5, 1 << 60], np.uint64), rng.integers(0, 9, 7).astype(np.uint16)):
        assert (_unpack(_pack(x, x))[1] == x).all()


def test_words_and_shingles():
    texts = ["a b c", "A\tb\x0bc", None, "", "one two three four five six SIX", "x" * 100 + " y"]
    for first, found in shingles(pa.array(texts)):
        assert first == 0 and [len(s) for s in found] == [len(sets(t)) for t in texts]
    data = np.frombuffer(b"abcabc12345678912345678", np.uint8)
    starts, ends = np.array([0, 3, 6, 15]), np.array([3, 6, 15, 23])
    h = word_hashes(data, starts, ends)
    assert h[0] == h[1] and h[2] != h[3]
    assert word_bounds(np.frombuffer(b"ab", np.uint8), np.array([0, 1, 1, 2]), NOT_BLANK)[2].tolist() == [0, 2]


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in range(100, 160)} == {100} and got[200] == 200
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_bucket_is_counted_in_little_more_than_its_own_memory(monkeypatch):
    rng = np.random.default_rng(5)
    alike, rows, true, size = rng.integers(0, 1 << 40, 30_000, dtype=np.uint64), [], {}, 0
    for chunk in range(24):
        lone = np.unique(np.concatenate([rng.integers(0, 1 << 40, 40_000, dtype=np.uint64), rng.choice(alike, 5_000)]))
        many = np.setdiff1d(rng.choice(alike, 3_000), lone)
        counts = rng.integers(2, 9, len(many)).astype(np.uint32)
        rows.append((chunk, _pack(lone, np.arange(len(lone)).astype(np.uint16), many, counts)))
        size += len(lone) + len(many)
        for tokens, held in ((lone, np.ones(len(lone), int)), (many, counts.astype(int))):
            for t, n in zip(tokens.tolist(), held.tolist()):
                true[t] = true.get(t, 0) + n
    given = pa.Table.from_batches([module._rows(module._POSTINGS, len(rows), route=[0] * len(rows), chunk=[c for c, _ in rows], payload=[b for _, b in rows])])
    tracemalloc.start()
    told = module._answer(given)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 * size
    for blob, (_, before) in zip(told.column("payload").to_pylist(), rows):
        (lone, owner, own, many, df), was = _unpack(blob), _unpack(before)
        shared = np.array([true[t] > 1 for t in was[0].tolist()])
        assert lone.tolist() == was[0][shared].tolist() and owner.tolist() == was[1][shared].tolist()
        assert own.tolist() == [true[t] for t in lone.tolist()] and many.tolist() == was[2].tolist()
        assert df.tolist() == [true[t] for t in many.tolist()]
    monkeypatch.setattr(module, "RANGE_TOKENS", 700)
    assert module._answer(given).equals(told)


def test_ranges_cover_runs_of_few_values():
    runs = [np.array([7] * 5, np.uint64), np.array([], np.uint64), np.array([7, (1 << 48) - 1], np.uint64)]
    module.RANGE_TOKENS, before = 2, module.RANGE_TOKENS
    try:
        covered = [p for places in module._ranges(runs) for p in places]
    finally:
        module.RANGE_TOKENS = before
    assert sorted(i for i, low, high in covered for _ in range(low, high)) == [0] * 5 + [2] * 2
    assert not list(module._ranges([runs[1]]))
