import collections
import random

import corpus_pipeline
from pyspark.sql import functions as F

from demand_engine.llm.lines import dedup_lines, normal_form


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a == b or a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def brute(rows, keys, least=16):
    def place(i, t, n):
        return ((0,) if i is None else (1, i)), keys[i, t], n

    first = {}
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            form = normal_form(line)
            if len(form) >= least:
                first[form] = min(first.get(form, place(i, t, n)), place(i, t, n))
    by = collections.defaultdict(list)
    for f in first:
        by[len(f)].append(f)
    late = {f for f, p in first.items() for n in (-1, 0, 1) for g in by[len(f) + n] if g != f and first[g] < p and one_edit(f, g)}
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        left = [x for n, x in enumerate(lines) if len(f := normal_form(x)) < least or (f not in late and first[f] == place(i, t, n))]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return collections.Counter(out)


def test_against_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choices("abcdé ", k=rng.randint(14, 40))) for _ in range(60)]
    rows = [(None, base[0]), (None, base[1]), (7, None), (8, ""), (9, "\n\n"), (9, base[2]), (9, base[3] + "\n" + base[2])]
    for k in range(150):
        line = rng.choice(base)
        i = rng.randrange(len(line))
        line = rng.choice([line, line.upper(), "  " + line, line[:i] + line[i + 1 :], line[:i] + "z" + line[i:], line[:i] + "z" + line[i + 1 :], line[:i] + "zz" + line[i + 2 :]])
        rows.append((100 + rng.randrange(200) * 1000 + k, "\n".join([line, "short", rng.choice(base)])))
    rows.append(rows[-1])
    rows.append((5, "x" * 100_000 + "\n" + "x" * 99_999))
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id bigint, text string, first int")
    keys = {(r.doc_id, r.text): r.k for r in df.select("doc_id", "text", F.xxhash64("text").alias("k")).collect()}
    got = dedup_lines(df, counts=True)
    assert got.columns == ["doc_id", "text", "first", "n_lines", "n_removed"]
    assert collections.Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == brute(rows, keys)


def test_many_lines_that_differ_in_one_character(spark):
    rows = [(k, f"template line number {chr(0x4E00 + k)} of a long list") for k in range(400)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).where("text <> ''").collect()
    assert [r.doc_id for r in got] == [0]


def test_short_forms_go_if_an_earlier_one_is_equal(spark):
    rows = [(1, "Yes\n\n短い文も一つの文である。\nYes"), (2, "yes \n\nYet\n短い文も一つの文である。"), (3, "\u3000\n\x1f\nYET"), (4, "İİİİİİİİİİ\nx"), (5, "İİİİİİİİİİ\ny"), (6, None), (7, "\n \n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(df, counts=True, equal_from=1).collect()}
    assert got == {
        1: ("Yes\n\n短い文も一つの文である。", 4, 1), 2: ("\nYet", 4, 2), 3: ("\u3000\n\x1f", 3, 1), 4: ("İİİİİİİİİİ\nx", 2, 0),
        5: ("y", 2, 1), 6: (None, 0, 0), 7: ("\n \n", 3, 0),
    }
    assert {r.doc_id: r.n_removed for r in dedup_lines(df, counts=True, equal_from=4).collect()} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1, 6: 0, 7: 0}


def test_registered_and_in_the_pipeline_copies_with_a_short_line_go(spark, tmp_path):
    text = "A first line of some length\n\nshort\nand another line of some length"
    rows = [(1, text), (2, text), (3, text + "\nnew"), (4, "\u3000\n\x1f\n\u00a0short"), (5, "\n"), (6, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.char_length("text").cast("bigint"))
    left = corpus_pipeline.drop_repeated_lines(spark, df, "").collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in left} == {(1, text, len(text)), (3, "\nnew", 4), (5, "\n", 1), (6, None, None)}
    df.write.parquet(f"{tmp_path}/documents.parquet")
    from demand_engine.llm.queries import op8_line_dedup

    assert {r.doc_id: r.n_removed for r in op8_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 3, 3: 3, 4: 1, 5: 0, 6: 0}


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_counts_of_an_earlier_run_are_replaced(spark):
    docs = spark.createDataFrame([(1, "the same line, said twice\nother", 5, 6), (2, "the same line, said twice", 7, 8)], "doc_id bigint, text string, n_removed int, n_lines int")
    once = dedup_lines(docs, counts=True, equal_from=1)
    assert once.columns == ["doc_id", "text", "n_lines", "n_removed"]
    again = dedup_lines(once, counts=True, equal_from=1).collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in again) == [(1, "the same line, said twice\nother", 2, 0), (2, "", 1, 0)]
