"""SentencePiece encoding and decoding by shared-prefix search over distinct marked words.

A text's spaces become marks, one more mark is put before it, and it is cut into words that begin
with their marks, and once more between a letter and a punctuation mark where no piece has the two in
a row; no piece of the vocabulary reaches over such a cut, which is checked. The distinct
words of a stretch of texts are sorted, which lays their trie out depth first: the forward table of a
word is kept up to the prefix that it has in common with its successor, and only the rest is computed.

The forward step is Viterbi's: the best sum of scores up to each position, for every vocabulary. For a
unigram vocabulary the best path is the encoding. A byte-pair vocabulary's scores are merge ranks, and
the best sum of ranks is not its encoding. There the same step keeps a second entry: a path may only go
from one piece to another if merging their joint text gives exactly those two; adjacent pieces that
all satisfy this are the encoding, and exactly one piece that ends at a position continues the encoding
of what is before it. Both entries depend on the prefix alone and are shared along the trie.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: Text taken at once, and words that a task remembers before it starts anew.
STRETCH_CHARS = 2 << 20
REMEMBERED_WORDS = 600_000
REMEMBERED_PAIRS = 400_000


@dataclass
class Vocabulary:
    """Pieces in id order with their scores; `unigram` says how texts are cut into them."""

    pieces: list[str]
    scores: list[float]
    bytes_at: int | None
    special: frozenset[int]
    unknown: int
    unigram: bool = False
    ids: dict[str, int] = field(default_factory=dict, repr=False)
    tails: dict[str, int] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        plain = set(range(256)) if self.bytes_at is None else set(range(self.bytes_at, self.bytes_at + 256))
        skip = (plain if self.bytes_at is not None else set()) | self.special
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in skip}
        # Ends of pieces -> the piece that is just that, or -1.
        self.tails = {p[k:]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a mark after other characters: words can't be cut at marks")
        apart = "" if any("\n" in p for p in self.ids) else "\n"
        letter = re.compile(r"[^\W\d_]")
        after_letters = {b for p in self.ids for a, b in zip(p, p[1:]) if letter.match(a)}
        free = re.escape("".join(c for c in string.punctuation if c not in after_letters))
        more = f"|(?<![^\\W\\d_])[{free}]" if free else ""
        self.word = re.compile(f"(?:{MARK}+|[^{MARK}{apart}])(?:[^{MARK}{apart}{free}]{more})*" + (f"|{apart}" if apart else ""))

    def plain(self) -> dict:
        """What a broadcast carries: built-in types only, so that any process can read it."""
        return {"fields": (self.pieces, self.scores, self.bytes_at, self.special, self.unknown, self.unigram)}

    @classmethod
    def load(cls, path: str, unigram: bool = False) -> Vocabulary:
        """From a model file, read by the driver."""
        import sentencepiece

        with open(path, "rb") as file:
            model = sentencepiece.SentencePieceProcessor(model_proto=file.read())
        n = model.get_piece_size()
        byte_ids = [i for i in range(n) if model.is_byte(i)]
        special = frozenset(i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        return cls(
            [model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)],
            byte_ids[0] if byte_ids else None, special, model.unk_id(), unigram,
        )


class Encoder:
    """Encodes words; keeps what it learns about pairs of pieces (`pairs` of them)."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.after: dict[str, dict[str, bool]] = {}
        self.past: dict[str, tuple | None] = {}
        self.pairs = 0
        self.lowest = min(vocabulary.scores, default=0.0) - 10.0

    def history(self, piece: str) -> tuple[list[float], list[str], list[str]] | None:
        """How a piece's own text merges: scores in order, and the first and last part before each and
        at the end. None if it merges to anything else."""
        if piece not in self.past:
            parts, ids, scores = list(piece), self.v.ids, self.v.scores
            steps, firsts, lasts = [], [parts[0]], [parts[-1]]
            while True:
                found = [(-scores[i], k) for k in range(len(parts) - 1) if (i := ids.get(parts[k] + parts[k + 1])) is not None]
                if not found:
                    break
                cost, k = min(found)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                steps.append(-cost)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            self.past[piece] = (steps, firsts, lasts) if len(parts) == 1 else None
        return self.past[piece]

    def _joins(self, left: str, right: str) -> bool:
        """Whether merging the joint text of two adjacent pieces gives just those; `left` may be empty.

        Both sides merge as they do alone, best score first, leftmost among equals, as long as the
        parts that meet in the middle are not the best pair of all.
        """
        after = self.history(right)
        if after is None or not left:
            return after is not None
        (own, _, lasts), (other, firsts, _) = self.past[left], after
        ids, scores, i, j = self.v.ids, self.v.scores, 0, 0
        while True:
            across = ids.get(lasts[i] + firsts[j])
            mine = own[i] if i < len(own) else None
            theirs = other[j] if j < len(other) else None
            if across is not None:
                score = scores[across]
                if (mine is None or score > mine) and (theirs is None or score >= theirs):
                    return False
            if mine is None and theirs is None:
                return True
            if theirs is None or (mine is not None and mine >= theirs):
                i += 1
            else:
                j += 1

    def words(self, words: list[str]) -> Iterator[list[str]]:
        """The pieces of each of the given words, which are sorted."""
        return (pieces for pieces, _, _ in self.search(words))

    def search(self, words: list[str]) -> Iterator[tuple[list[str], float, int]]:
        """For each of the given words, which are sorted: its pieces, the best sum of scores that any
        pieces of it have, and how many pieces have that sum (of equal sums the longer last piece counts)."""
        tails, scores, lowest, unigram, after = self.v.tails, self.v.scores, self.lowest, self.v.unigram, self.after
        # Forward entries of the empty prefix and on: best sum, pieces of it, last piece of the encoding,
        # and what is known of the pieces that follow that one.
        sums, counts, lasts, follow = [0.0], [0], [""], [self.after.setdefault("", {})]
        before = ""
        for word in words:
            same = 0
            for old, new in zip(before, word):
                if old != new:
                    break
                same += 1
            del sums[same + 1 :], counts[same + 1 :], lasts[same + 1 :], follow[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                low, piece = end - 1, word[end - 1]
                i = tails.get(piece, -1)
                best, count, heaviest = sums[low] + (scores[i] if i >= 0 else lowest), counts[low] + 1, piece
                candidates = [(low, piece)]
                while i is not None and low:  # longer ones, as long as any piece ends like that
                    low -= 1
                    piece = word[low:end]
                    i = tails.get(piece)
                    if i is not None and i >= 0:
                        candidates.append((low, piece))
                        if (total := sums[low] + scores[i]) >= best:
                            best, count, heaviest = total, counts[low] + 1, piece
                chosen = heaviest
                if not unigram:
                    for low, chosen in reversed(candidates):
                        known = follow[low]
                        fits = known.get(chosen)
                        if fits is None:
                            fits = known[chosen] = self._joins(lasts[low], chosen)
                            self.pairs += 1
                        if fits:
                            break
                sums.append(best)
                counts.append(count)
                lasts.append(chosen)
                known = None if unigram else after.get(chosen)
                if known is None and not unigram:
                    known = after[chosen] = {}
                follow.append(known)
            before, out, end = word, [], len(word)
            while end:
                piece = lasts[end]
                out.append(piece)
                end -= len(piece)
            out.reverse()
            yield out, sums[-1], counts[-1]

    def numbers(self, pieces: list[str]) -> list[int]:
        """Ids; a character outside the vocabulary as its bytes, or as the unknown piece."""
        found = [*map(self.v.ids.get, pieces)]
        if None not in found:
            return found
        out = []
        for piece, i in zip(pieces, found):
            if i is not None:
                out.append(i)
            elif self.v.bytes_at is not None:
                out += [self.v.bytes_at + b for b in piece.encode()]
            else:
                out.append(self.v.unknown)
        return out


class TextEncoder:
    """Encodes texts stretch by stretch; remembers a bounded number of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.encoder = Encoder(vocabulary)
        self.find = vocabulary.word.findall
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sizes, self.flat = array("q"), array("i")
        self.sums, self.counts = array("d"), array("q")

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, ids of all texts)."""
        return self.scored(texts)[:2]

    def scored(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids of each text, ids of all texts, best sum of scores of each text, pieces of that)."""
        if len(self.known) > REMEMBERED_WORDS:
            self.forget()
        if self.encoder.pairs > REMEMBERED_PAIRS:
            self.encoder = Encoder(self.encoder.v)
        cut = [self.find(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        fresh = sorted({w for words in cut for w in words if w not in self.known})
        for word, (pieces, best, count) in zip(fresh, self.encoder.search(fresh)):
            numbers = self.encoder.numbers(pieces)
            self.known[word] = len(self.known)
            self.sizes.append(len(numbers))
            self.flat.extend(numbers)
            self.sums.append(best)
            self.counts.append(count)
        sizes, table = np.array(self.sizes, dtype=np.int64), np.array(self.flat, dtype=np.int32)
        begins = np.cumsum(sizes) - sizes
        counts = np.array([len(words) for words in cut], dtype=np.int64)
        at = np.fromiter((self.known[w] for words in cut for w in words), dtype=np.int64, count=int(counts.sum()))
        long = sizes[at]
        ends = np.cumsum(long)
        ids = table[np.repeat(begins[at] - (ends - long), long) + np.arange(int(ends[-1]) if len(ends) else 0)]
        totals = np.concatenate([[0], ends])
        edges = np.concatenate([[0], np.cumsum(counts)])
        text = np.repeat(np.arange(len(texts)), counts)
        best = np.bincount(text, np.array(self.sums)[at], len(texts)).astype(np.float64)  # without words it has integers
        pieces = np.bincount(text, np.array(self.counts)[at], len(texts)).astype(np.int64)
        return totals[edges[1:]] - totals[edges[:-1]], ids, best, pieces


def _stretches(column: pa.Array) -> Iterator[list[str]]:
    held, chars = [], 0
    for value in column:
        held.append(value.as_py() or "")
        chars += len(held[-1])
        if chars >= STRETCH_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _encoding(shared: Broadcast, columns: tuple[str, ...], scores: bool):
    """Task function: batches of `columns` and `__text` -> `columns`, `ids` and, if asked for, `best_sum`, `n_best`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value  # one object per process while the broadcast lives, over several tasks
        if "encoder" not in held:
            held["encoder"] = TextEncoder(Vocabulary(*held["fields"]))
        encoder = held["encoder"]
        for batch in batches:
            begin = 0
            for texts in _stretches(batch.column("__text")):
                sizes, ids, best, count = encoder.scored(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids, pa.int32()))
                own = [batch.column(c).slice(begin, len(texts)) for c in columns]
                more = [pa.array(best, pa.float64()), pa.array(count, pa.int64())] if scores else []
                yield pa.RecordBatch.from_arrays([*own, lists, *more], [*columns, "ids", *(["best_sum", "n_best"] if scores else [])])
                begin += len(texts)

    return run


def encode(
    docs: DataFrame, vocabulary: Vocabulary, columns: tuple[str, ...] = ("doc_id",), text_col: str = "text", scores: bool = False
) -> DataFrame:
    """`columns` of `docs` and `ids` (array<int>) of the whole text; null and empty texts have none.

    With `scores` also `best_sum` and `n_best`: the best sum of piece scores over all ways to cut the
    text's words into pieces, as Viterbi's search finds it, and the pieces of that way. For a unigram
    vocabulary `ids` are that way; for a byte-pair one they are what merging gives.

    Repeated rows give repeated rows. Other columns are ignored, whatever their names; kept ones must
    not have the names of results.
    """
    results = ["ids", "best_sum", "n_best"] if scores else ["ids"]
    if set(columns) & {*results, "__text"}:
        raise ValueError(f"kept columns have names of results: {', '.join(columns)}")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.plain())
    slim = docs.select(*columns, F.col(text_col).alias("__text"))
    schema = slim.select(*columns).schema.add("ids", T.ArrayType(T.IntegerType()))
    if scores:
        schema = schema.add("best_sum", T.DoubleType()).add("n_best", T.LongType())
    return slim.mapInArrow(_encoding(shared, columns, scores), schema)


def _decoding(shared: Broadcast, columns: tuple[str, ...], ids_col: str, text: str):
    """Task function: batches with `columns` and ids -> `columns` and the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value["fields"])
        spelled = [p.replace(MARK, " ").encode() for p in v.pieces]
        for i in v.special:
            spelled[i] = " ⁇ ".encode() if i == v.unknown else b""
        if v.bytes_at is not None:
            spelled[v.bytes_at : v.bytes_at + 256] = [bytes([b]) for b in range(256)]
        long = np.array([len(s) for s in spelled], dtype=np.int64)
        begins, letters = np.cumsum(long) - long, np.frombuffer(b"".join(spelled), dtype=np.uint8)
        for batch in batches:
            texts = []
            for ids in batch.column(ids_col):
                own = ids.values.to_numpy() if ids.is_valid and len(ids) else np.zeros(0, dtype=np.int32)
                size = long[own]
                ends = np.cumsum(size)
                data = letters[np.repeat(begins[own] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
                texts.append(data.decode("utf-8", "replace").removeprefix(" "))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(texts, pa.string())], [*columns, text])

    return run


def decode(encoded: DataFrame, vocabulary: Vocabulary, columns: tuple[str, ...] = ("doc_id",), text: str = "decoded") -> DataFrame:
    """`columns` and the text that `ids` stand for; null or no ids give an empty text.

    Marks become spaces and the one put before the text is taken off. Bytes that are no UTF-8 become
    replacement characters. Control pieces have no text; ids outside the vocabulary are an error.
    """
    if {text, "__ids"} & set(columns):
        raise ValueError(f"kept columns have names of results: {', '.join(columns)}")
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.plain())
    slim = encoded.select(*columns, F.col("ids").alias("__ids"))
    return slim.mapInArrow(_decoding(shared, columns, "__ids", text), slim.select(*columns).schema.add(text, "string"))


def encoding_report(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, n_ids, best_sum, n_best, decoded_sha256, lossless) per row of documents.

    `ids` are the public library's; `best_sum` and `n_best` are Viterbi's over the same pieces and
    scores. One task function encodes, decodes and compares, so that no text goes back to the JVM.
    """
    shared = spark.sparkContext.broadcast(Vocabulary.load(path).plain())
    kept = ("doc_id", "__given", "ids", "best_sum", "n_best")
    there, back = _encoding(shared, kept[:2], True), _decoding(shared, kept, "ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doubled = (pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(1)], [*kept[:2], "__text"]) for b in batches)
        for batch in back(there(doubled)):
            given, decoded = batch.column("__given").to_pylist(), batch.column("decoded").to_pylist()
            digests = [sha256(t.encode()).hexdigest() for t in decoded]
            same = [(g or "") == d for g, d in zip(given, decoded)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), batch.column("best_sum"), batch.column("n_best"), pa.array(digests, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "ids", "best_sum", "n_best", "decoded_sha256", "lossless"],
            )

    slim = docs.select("doc_id", F.col("text").alias("__given"))
    schema = slim.select("doc_id").schema.add("ids", T.ArrayType(T.IntegerType())).add("best_sum", T.DoubleType()).add("n_best", T.LongType())
    told = slim.mapInArrow(run, schema.add("decoded_sha256", T.StringType()).add("lossless", T.BooleanType()))
    return told.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_ids"), "best_sum", "n_best", "decoded_sha256", "lossless")
