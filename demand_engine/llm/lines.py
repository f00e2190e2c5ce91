"""Near-duplicate lines across documents by a deletion-neighbourhood join; the earliest stays.

Lines are compared in a normal form: lower case, white space runs as one space, ends trimmed. A line
goes if an earlier line's form is within one edit of its own. Short forms, where one edit is another
word, go only if an earlier form equals theirs (`equal_from`). Order is by document id, a hash of the
text, and line number.

1. Equal forms meet by a 128-bit hash; only a form's first place matters from there on.
2. A form within one edit of another shares either its first half or its last half with it, and of
   any number of parts all but one. Forms that share no half, or not all parts but one, with any other
   have no neighbour; all others emit the hash of each variant with one character deleted, and of
   themselves.
3. Two forms of one length are within one edit if and only if they give the same variant by deleting
   at the same place; two whose lengths differ by one, if a variant of the longer is the shorter. Both
   are joins on hashed keys in which no pairs of a group are formed: each member meets the group's
   earliest, or the shorter form. What meets is verified by its edit distance.
4. Each document learns which lines were a form's kept first place.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.session import cut_lineage

#: Lines whose normal form is shorter are not compared by edits.
MIN_CHARS = 16
#: White space is what `str.split` takes for it.
_NOT_BLANK = r"[^\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Places looked up by broadcast; more of them are joined by a shuffle of the texts.
BROADCAST_PLACES = 1_000_000
#: Parts for the second test.
PARTS = 16
_PRIME = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_PRIME, -1, 1 << 64)


def normal_form(line: str) -> str:
    return " ".join(line.lower().split())


def has_lines(text: Column) -> Column:
    """Whether any line of a text has a form that is not empty."""
    return text.rlike(_NOT_BLANK)


def _halves(form: str) -> Iterator[bytes]:
    """The parts that a form shares with any other within one edit: a first half or a last half."""
    n = len(form)
    for k in {n // 2, (n + 1) // 2}:
        yield b"<" + form[:k].encode()
    for k in {n // 2, (n - 1) // 2}:
        yield b">" + form[n - k :].encode()


def _places(least: int, lowest: int):
    """Task function: documents -> one row per line whose form has `lowest` characters; halves from `least` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, number, hashes, keys = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                for k, line in enumerate((text.as_py() or "").split("\n")):
                    form = normal_form(line)
                    if len(form) >= lowest:
                        owner.append(i)
                        number.append(k)
                        hashes.append(hashlib.blake2b(form.encode(), digest_size=16).digest())
                        keys.append([struct.unpack("<q", hashlib.blake2b(h, digest_size=8).digest())[0] for h in _halves(form)] if len(form) >= least else [])
            at = pa.array(owner, pa.int64())
            pairs = np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 2)
            thirds = [pa.array([k[j] if j < len(k) else None for k in keys], pa.int64()) for j in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(number, pa.int32()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *thirds],
                ["doc_id", "text_key", "line", "h1", "h2", "k0", "k1", "k2", "k3"],
            )

    return run


def _polynomial(codes: np.ndarray, powers: np.ndarray) -> tuple[np.ndarray, int]:
    """(hash of each deletion variant by place, hash of the whole)."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers[: len(codes)], dtype=np.uint64)])
    variants = sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(_INVERSE)
    return variants, int(sums[-1])


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: documents and their wanted lines -> the lines' normal forms."""
    for batch in batches:
        rows = []
        for text, wanted in zip(batch.column("text"), batch.column("wanted")):
            lines = text.as_py().split("\n")
            rows += [(e["h1"], e["h2"], normal_form(lines[e["line"]])) for e in wanted.as_py()]
        h1, h2, form = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(form, pa.string())], ["h1", "h2", "form"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: forms -> a hash of all parts but one, for each of them.

    The parts are those of the form's own length and of one less, so that a form and one that is
    longer by a character have the parts of the shorter in common.
    """
    for batch in batches:
        owner, keys = [], []
        for i, form in enumerate(batch.column("form")):
            text = form.as_py()
            n = len(text)
            found = set()
            for size in (n, n - 1):
                for q in range(PARTS):
                    low, high = q * size // PARTS, (q + 1) * size // PARTS
                    rest = f"{size} {q} {text[:low]}\n{text[n - (size - high) :]}"
                    found.add(struct.unpack("<q", hashlib.blake2b(rest.encode(), digest_size=8).digest())[0])
            owner += [i] * len(found)
            keys += found
        at = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("h1").take(at), batch.column("h2").take(at), pa.array(keys, pa.int64())], ["h1", "h2", "key"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: forms -> their variants' hashes by place, and the form itself at -1."""
    powers = np.ones(1, dtype=np.uint64)
    for batch in batches:
        for h1, h2, form in zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "form"))):
            codes = np.frombuffer(form.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
            while len(powers) < len(codes):
                powers = np.concatenate([powers, powers * np.uint64(pow(_PRIME, len(powers), 1 << 64))])
            variants, whole = _polynomial(codes, powers)
            n = len(variants) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(variants, np.uint64(whole)).view(np.int64)),
                    pa.array(np.append(np.arange(n - 1), -1), pa.int32()),
                    pa.array(np.full(n, h1)),
                    pa.array(np.full(n, h2)),
                ],
                ["variant", "place", "h1", "h2"],
            )


def _sharing(keys: DataFrame) -> DataFrame:
    """(h1, h2) of forms that have a key in common with another form; keys: (h1, h2, key), distinct."""
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("key")
    return cut_lineage(keys.join(shared, "key", "left_semi").select("h1", "h2").distinct())


def _late_forms(documents: DataFrame, forms: DataFrame) -> DataFrame:
    """(h1, h2) of forms that have an earlier form within one edit."""
    keys = forms.select("h1", "h2", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key")).where(F.col("key").isNotNull())
    candidates = cut_lineage(_sharing(keys).join(forms, ["h1", "h2"]).select("h1", "h2", "first"))
    wanted = candidates.groupBy("first.doc_id", "first.text_key").agg(F.collect_list(F.struct("first.line", "h1", "h2")).alias("wanted"))
    if candidates.count() <= BROADCAST_PLACES:
        wanted = F.broadcast(wanted)
    w = wanted.alias("w")
    d = documents.alias("d")
    found = d.join(w, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_key") == F.col("w.text_key")))
    found = found.select("d.text", "w.wanted").mapInArrow(_forms, "h1 bigint, h2 bigint, form string")
    texts = cut_lineage(found.dropDuplicates(["h1", "h2"]))
    near = _sharing(texts.mapInArrow(_parts, "h1 bigint, h2 bigint, key bigint"))
    made = texts.join(near, ["h1", "h2"]).mapInArrow(_variants, "variant bigint, place int, h1 bigint, h2 bigint")
    made = cut_lineage(made.join(candidates, ["h1", "h2"]))
    me = F.struct("first", "h1", "h2")
    deleted, whole = made.where("place >= 0").select("variant", "place", me.alias("me")), made.where("place < 0").select("variant", me.alias("me"))
    groups = deleted.groupBy("variant", "place").agg(F.min("me").alias("other"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    same = deleted.join(groups.drop("n"), ["variant", "place"]).select("me", "other")
    shorter = deleted.alias("x").join(whole.alias("y"), "variant").select(F.col("x.me").alias("me"), F.col("y.me").alias("other"))
    pairs = same.union(shorter).union(shorter.select(F.col("other").alias("me"), F.col("me").alias("other")))
    pairs = pairs.where(F.col("other") < F.col("me"))
    earliest = pairs.groupBy("me").agg(F.min("other").alias("other")).select(
        F.col("me.h1").alias("h1"), F.col("me.h2").alias("h2"), F.col("other.h1").alias("o1"), F.col("other.h2").alias("o2")
    )
    checked = earliest.join(texts, ["h1", "h2"]).join(texts.toDF("o1", "o2", "other_form"), ["o1", "o2"])
    return cut_lineage(checked.where(F.levenshtein("form", "other_form") <= 1).select("h1", "h2"))


def _lowest(least: int, equal_from: int | None) -> int:
    """Characters of the shortest forms that are compared at all; empty ones never are."""
    return least if equal_from is None else max(1, min(least, equal_from))


def kept_lines(docs: DataFrame, least: int = MIN_CHARS, equal_from: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(`docs` with __id, __key; (__id, __key, kept): line numbers that are a kept first place)."""
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("bigint"), "__key": F.xxhash64("text")})
    documents = keyed.select(F.col("__id").alias("doc_id"), F.col("__key").alias("text_key"), "text").where(has_lines(F.col("text")))
    places = documents.mapInArrow(
        _places(least, _lowest(least, equal_from)), "doc_id bigint, text_key bigint, line int, h1 bigint, h2 bigint, k0 bigint, k1 bigint, k2 bigint, k3 bigint"
    )
    first = F.min(F.struct("doc_id", "text_key", "line")).alias("first")
    forms = cut_lineage(places.groupBy("h1", "h2").agg(first, *(F.max(k).alias(k) for k in ("k0", "k1", "k2", "k3"))))
    stay = forms.join(_late_forms(documents, forms), ["h1", "h2"], "left_anti")
    kept = stay.groupBy(F.col("first.doc_id").alias("__id"), F.col("first.text_key").alias("__key")).agg(F.collect_list("first.line").alias("__kept"))
    return keyed, kept


def dedup_lines(docs: DataFrame, least: int = MIN_CHARS, counts: bool = False, equal_from: int | None = None) -> DataFrame:
    """`docs` (doc_id, text, any others) with duplicate lines taken out of `text`.

    With `counts`, also n_lines and n_removed. Lines whose normal form has fewer than `least`
    characters stay; with `equal_from`, those of so many characters or more go if an earlier form
    equals theirs. Blank lines stay. A null text stays null, and one that loses all its lines becomes empty. Rows
    that repeat an id and a text count as one place and are treated alike. Null ids come first.
    Columns may have any names but __id, __key, __kept; with `counts`, columns n_lines and n_removed
    that `docs` has are replaced.
    """
    if counts:
        docs = docs.drop("n_lines", "n_removed")
    keyed, kept = kept_lines(docs, least, equal_from)
    lowest = _lowest(least, equal_from)
    k = kept.alias("k")
    whole = keyed.alias("d").join(k, F.col("d.__id").eqNullSafe(F.col("k.__id")) & (F.col("d.__key") == F.col("k.__key")), "left")
    whole = whole.select(*(F.col(f"d.`{c}`") for c in docs.columns), F.col("k.__kept"))
    names = list(docs.columns)
    schema = docs.schema
    if counts:
        schema = docs.select(*names).schema.add("n_lines", T.IntegerType()).add("n_removed", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, gone = [], [], []
            for text, kept in zip(batch.column("text"), batch.column("__kept")):
                if not text.is_valid:
                    texts.append(None)
                    totals.append(0)
                    gone.append(0)
                    continue
                lines, stay = text.as_py().split("\n"), set(kept.as_py() or ())
                left = [x for i, x in enumerate(lines) if i in stay or len(normal_form(x)) < lowest]
                texts.append("\n".join(left))
                totals.append(len(lines))
                gone.append(len(lines) - len(left))
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            more = [pa.array(totals, pa.int32()), pa.array(gone, pa.int32())] if counts else []
            yield pa.RecordBatch.from_arrays(columns + more, names + (["n_lines", "n_removed"] if counts else []))

    return whole.mapInArrow(run, schema)
