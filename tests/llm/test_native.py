"""Exact dedup and decontamination: edge cases, collisions, blocks, and plans without Python."""

import hashlib
from collections import Counter

import demand_engine.llm.exact as exact
from demand_engine.llm.contamination import contamination
from demand_engine.llm.exact import chunk_table, exact_duplicates, recipes
from pyspark.sql import functions as F

ROWS = [(1, None), (2, ""), (3, "a. b"), (4, "a. b"), (4, "a. b"), (None, "a. b"), (None, "alone"), (5, "A. b"), (6, "x" * 30_000 + "\ny" * 3_000), (7, "x" * 30_000 + "\ny" * 3_000)]


def expected():
    texts = [t or "" for _, t in ROWS]
    out = []
    for i, t in zip((i for i, _ in ROWS), texts):
        ids = [j for (j, _), u in zip(ROWS, texts) if u == t]
        keep = max((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def exact_rows(spark):
    df = spark.createDataFrame([(a, b, "c", [1]) for a, b in ROWS], "doc_id bigint, text string, exact string, ids array<bigint>")
    return Counter(tuple(r) for r in exact_duplicates(df).collect())


def test_exact_rows(spark):
    assert exact_rows(spark) == expected()
    assert exact_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_colliding_identifiers_are_told_apart(spark, monkeypatch):
    whole = exact.recipes

    def clash(docs, id_col="doc_id", text_col="text"):
        return whole(docs, id_col, text_col).withColumn("ids", F.transform("ids", lambda i: i % 2))

    monkeypatch.setattr(exact, "recipes", clash)
    assert exact_rows(spark) == expected()


def test_chunks_join_to_the_text_and_shift_with_it(spark):
    text = " ".join(f"Sentence {k} says {k * 7919 % 1000} things." for k in range(2_000))
    df = spark.createDataFrame([(1, text), (2, "New start here. " + text), (3, "z" * 20_000)], "doc_id bigint, text string")
    cut = {r.doc_id: r.c for r in df.select("doc_id", exact.chunks(F.col("text")).alias("c")).collect()}
    assert "".join(cut[1]) == text and max(map(len, cut[3])) <= exact.MOST
    assert len(set(cut[1]) & set(cut[2])) > len(cut[1]) // 2
    table = chunk_table(recipes(df))
    assert table.agg(F.sum("uses")).first()[0] == sum(map(len, cut.values()))


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in low).split(" "), low


def plain_words(text):
    return [w for w in words(text)[0] if w]


def contaminated(docs, items, width=10):
    wins = {}
    for i, t in items:
        w = plain_words(t)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w = plain_words(t)
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                own = wins.get(tuple(w[k : k + n]))
                if own is not None:
                    hit.update(range(k, k + n))
                    found |= own - {None}
        names = sorted(map(str, found))
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return Counter(out)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again"), (2, "short one"), (3, None), (4, " .,"), (None, "nameless item text"), (2, "short one"), (10, "İstanbul É über straße"), (5, "the the the the the the the the the the the")]
DOCS = [
    (1, "x THE QUICK brown-fox jumps over the lazy dog; again and again y short one"),
    (2, None), (3, ""), (4, " ... "), (5, "short. One"), (5, "short. One"), (5, "short two"), (6, "nameless ITEM text"),
    (7, "İstanbul É über straße / istanbul é über straße"), (8, "the " * 2_000), (None, "over the lazy dog again and again"), (9, "quick brown fox jumps over the lazy dog again and again"),
]


def test_windows_words_and_blocks(spark):
    docs = spark.createDataFrame([(a, b, 0, 0) for a, b in DOCS], "doc_id bigint, text string, window int, size int")
    items = spark.createDataFrame([(a, b, 0) for a, b in ITEMS], "item_id bigint, text string, doc_id int")
    for block in (1_000, 3):
        got = contamination(docs, items, block_windows=block).drop("text_key").collect()
        assert Counter(tuple(r) for r in got) == contaminated(DOCS, ITEMS)
    none = contamination(docs, items.limit(0)).collect()
    assert len(none) == len(DOCS) and not any(r.contaminated for r in none)
    assert contamination(docs.limit(0), items).count() == 0


def test_no_python_in_the_plans(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for df in (exact_duplicates(docs), contamination(docs, spark.read.parquet(f"{small}/benchmark.parquet"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
