import hashlib
import random

import pyarrow as pa
import pytest
import sentencepiece

from demand_engine.llm.pieces import MARK, Encoder, TextEncoder, Vocabulary, decode, encode, encoding_report

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
TEXTS = ["", " ", "  two  spaces ", "Hello world\n\n\tx", "日本語 🎉 \x00", "a" * 70, " " * 40 + "x", "=====-----", "naïve éèê", "don't stop. It's 1,234!" * 40]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(MODEL)


def test_same_ids_as_the_library(vocabulary, spark, small):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").limit(60).collect()]
    sizes, ids = TextEncoder(vocabulary)(texts)
    at = 0
    for text, n in zip(texts, sizes):
        assert ids[at : at + n].tolist() == model.encode(text)
        at += n


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    import demand_engine.llm.pieces as module

    monkeypatch.setattr(module, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(module, "REMEMBERED_PAIRS", 3)
    little, whole = TextEncoder(vocabulary), TextEncoder(vocabulary)
    for text in TEXTS:
        assert little([text])[1].tolist() == whole([text])[1].tolist()


def test_unigram_is_the_best_sum():
    pieces = ["<unk>", "a", "b", "ab", "ba", "aba", "▁", "▁a", "bb"]
    scores = [0.0, -2.0, -2.5, -2.2, -3.0, -4.0, -1.0, -2.4, -4.9]
    v = Vocabulary(pieces, scores, None, frozenset([0]), 0, unigram=True)
    words = sorted({"▁" + "".join(random.Random(k).choices("abc", k=k % 9)) for k in range(60)})
    lowest = Encoder(v).lowest

    def best(word):
        if not word:
            return 0.0
        return max(
            best(word[k:]) + (scores[pieces.index(word[:k])] if word[:k] in v.ids else lowest)
            for k in range(1, len(word) + 1)
            if word[:k] in v.ids or k == 1
        )

    for word, found in zip(words, Encoder(v).words(words)):
        assert "".join(found) == word
        assert abs(sum(scores[v.ids[p]] if p in v.ids else lowest for p in found) - best(word)) < 1e-9


def plain_best(v, text):
    """(best sum, pieces of it) over a whole marked text, position by position, nothing shared or cut."""
    if not text:
        return 0.0, 0
    marked, lowest, table = MARK + text.replace(" ", MARK), min(v.scores) - 10.0, [(0.0, 0)]
    for end in range(1, len(marked) + 1):
        best = None
        for low in range(max(0, end - 40), end):
            piece = marked[low:end]
            if piece in v.ids or low == end - 1:
                total = table[low][0] + (v.scores[v.ids[piece]] if piece in v.ids else lowest)
                if best is None or total > best[0]:
                    best = total, table[low][1] + 1
        table.append(best)
    return table[-1]


def test_registered_result_against_plain_search_and_library(vocabulary, spark, small):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").limit(40)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(-1 - k, t) for k, t in enumerate(TEXTS)] + [(None, None), (7, "x y"), (7, "x y")]
    got = encoding_report(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), MODEL)
    expected = []
    for k, t in rows:
        best, n = plain_best(vocabulary, t)
        ids = model.encode(t or "")
        expected.append((k, ids, len(ids), best, n, hashlib.sha256((t or "").encode()).hexdigest(), True))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert any(r.n_best != r.n_ids for r in got.collect())
    assert encoding_report(spark, docs.limit(0), MODEL).count() == 0


def test_kept_columns_with_names_of_results(spark, vocabulary):
    df = spark.createDataFrame([(1, "a", 2)], "doc_id bigint, text string, ids int")
    with pytest.raises(ValueError, match="ids"):
        encode(df, vocabulary, ("doc_id", "ids"))


def test_round_trip_nulls_repeats_and_clashing_columns(spark, vocabulary):
    rows = [(k, t, "x") for k, t in enumerate(TEXTS)] + [(99, None, None), (99, None, None), (None, "word " * 40_000, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    encoded = encode(df.select("doc_id", "text", "ids").drop("ids"), vocabulary)
    back = decode(encoded, vocabulary).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.decoded) for r in back) == sorted((k is None, k or 0, t or "") for k, t, _ in rows)
    assert encode(df, vocabulary).count() == len(rows)
    assert encode(df.limit(0), vocabulary).count() == 0


def test_stretches_without_words_have_the_same_types(spark, vocabulary, monkeypatch):
    import demand_engine.llm.pieces as module

    monkeypatch.setattr(module, "STRETCH_CHARS", 10)
    shared = type("Shared", (), {"value": vocabulary.plain()})
    run = module._encoding(shared, ("doc_id",), True)

    def found(texts):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "__text"])
        return list(run(iter([batch])))

    plain = found(["a"])[0].schema
    for texts in (["ab", "a full stretch"], ["a full stretch", "", None], ["", None], []):
        parts = found(texts)
        assert all(p.schema.equals(plain) and p.num_rows for p in parts)
        assert [k for p in parts for k in p.column("doc_id").to_pylist()] == [*range(len(texts))]
    monkeypatch.undo()

    full = "word " * (module.STRETCH_CHARS // 5 + 1)  # ends the first stretch of its batch
    for rows in ([(1, "x"), (2, full)], [(1, full), (2, ""), (3, None)], [(1, None), (2, "")]):
        got = encoding_report(spark, spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), MODEL).collect()
        digests = [hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows]
        assert [(r.doc_id, r.decoded_sha256, r.lossless) for r in got] == [(k, d, True) for (k, _), d in zip(rows, digests)]
        assert [r.doc_id for r in got if (r.n_ids, r.best_sum, r.n_best) == (0, 0.0, 0)] == [k for k, t in rows if not t]


def test_a_piece_over_a_cut_is_refused():
    with pytest.raises(ValueError, match="mark"):
        Vocabulary(["a▁b"], [0.0], None, frozenset(), 0)
