"""Exact similarity join of texts on word shingles by adaptive multi-match prefixes.

A document's set is its distinct shingles (64-bit hashes). Tokens are ordered by how many documents
hold them, rare ones first. If two sets share enough for the threshold, then the l-prefixes of both
(their first n - ceil(t n) + l tokens) share at least l tokens, for every l. Each document picks its
own l by estimated cost; a pair must share as many prefix tokens as the smaller of its two l before
it is verified. Nothing is lost by this, whatever l each side picks.

1. One pass over the texts. A task sends each token of its documents once to the token's bucket, as
   packed arrays (a token that several of its documents share is pre-aggregated to a count). There
   are as many buckets as the measured bytes of the texts need.
2. A bucket counts documents per token and answers for tokens that two or more documents hold; all
   other tokens can't be in any intersection. Documents with fewer such tokens than the threshold
   needs have no partner and end here.
3. The rest are ordered, given their l, and joined on prefix tokens. Tokens with up to
   `PAIR_GROUP` documents give pairs. Documents around more frequent ones (large groups of near
   copies) form families; a family is cut into blocks, and block against block is counted by matrix
   products inside tasks, which give back links to one root and counts, not pairs.
4. Links are verified on whole sets and contracted to components.

Equal sets are one node of the graph throughout. Sets are identified by a 64-bit hash of the set and
tokens inside sets by 48 bits of their hash; the chance that two given sets of n tokens are misjudged
is below n^2 / 2^48.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.graphs import components
from demand_engine.llm.vectors import mix, shingles
from demand_engine.session import cut_lineage

CHUNK_TOKENS = 1_000_000
CHUNK_DOCUMENTS = 60_000
#: Tokens in the prefixes of at most so many documents are joined pair by pair, others block by block.
PAIR_GROUP = 128
BLOCK = 512
#: Multiples of l that documents choose from.
MATCHES = (1, 2, 4, 8, 16)
#: Text whose tokens one bucket counts at once; the number of buckets grows with the corpus.
BUCKET_BYTES = 16 << 20
#: Tokens of a bucket that are sorted together.
RANGE_TOKENS = 500_000
_TILE = 4096

_PARTS = pa.schema(
    [("kind", pa.int32()), ("route", pa.int64()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("payload", pa.binary())]
)
_PARTS_DDL = "kind int, route bigint, chunk bigint, doc_id bigint, n int, node bigint, payload binary"
_DOCUMENT, _POSTINGS, _CHUNK, _ANSWER = range(4)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one byte string; ascending 64-bit ones as 32-bit steps where those suffice."""
    out = [np.uint32(len(arrays)).tobytes()]
    for x in arrays:
        kind = x.dtype.str.encode()
        if x.dtype == np.uint64 and len(x) > 1:
            steps = np.diff(x)
            if (x[1:] >= x[:-1]).all() and steps.max() < 1 << 32:
                kind, x = b"steps", np.concatenate([x[:1].view(np.uint32), steps.astype(np.uint32)])
        data = x.tobytes()
        out += [np.array([len(kind), len(data)], dtype=np.uint64).tobytes(), kind, data]
    return b"".join(out)


def _unpack(blob: bytes) -> list[np.ndarray]:
    count, at, out = int(np.frombuffer(blob, np.uint32, 1)[0]), 4, []
    for _ in range(count):
        k, n = (int(v) for v in np.frombuffer(blob, np.uint64, 2, at))
        kind, data = bytes(blob[at + 16 : at + 16 + k]), blob[at + 16 + k : at + 16 + k + n]
        at += 16 + k + n
        if kind == b"steps":
            raw = np.frombuffer(data, np.uint32)
            x = np.empty(len(raw) - 1, dtype=np.uint64)
            x[0] = raw[:2].view(np.uint64)[0]
            x[1:] = x[0] + np.cumsum(raw[2:], dtype=np.uint64)
        else:
            x = np.frombuffer(data, np.dtype(kind.decode()))
        out.append(x)
    return out


def _rows(kind: int, length: int, **columns: object) -> pa.RecordBatch:
    given = {"kind": np.full(length, kind, dtype=np.int32)} | columns
    return pa.RecordBatch.from_arrays(
        [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(length, f.type) for f in _PARTS], schema=_PARTS
    )


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Least intersection that a set of n needs with any partner: ceil(t n)."""
    return (n.astype(np.int64) * percent + 99) // 100


def _spread(width: int, buckets: int):
    """Task function: documents -> their sizes and nodes, postings by bucket, and what the chunk keeps.

    A chunk is named by its task's partition and its number there, so chunks of equal sets stay apart
    and a task that is repeated gives the same names.
    """

    def chunk_rows(number: int, ids: list, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        n = np.array([len(s) for s in sets], dtype=np.int32)
        flat = np.concatenate(sets)
        ends = np.cumsum(n, dtype=np.int64)
        totals = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(flat), dtype=np.uint64)])
        nodes = mix(totals[ends] - totals[ends - n] + n.astype(np.uint64)).view(np.int64)
        yield _rows(
            _DOCUMENT, len(ids), route=np.arange(len(ids)) % buckets, doc_id=pa.array(ids, pa.int64()), n=n, node=pa.array(nodes, mask=n == 0)
        )
        _, kept = np.unique(nodes, return_index=True)  # equal sets count once in a chunk
        kept = kept[n[kept] > 0]
        if not len(kept):
            return
        del flat, totals, ends
        short = [np.unique(sets[i] >> np.uint64(16)) for i in kept]
        tokens, owner = np.concatenate(short), np.repeat(np.arange(len(kept), dtype=np.uint16), [len(s) for s in short])
        del short
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        count = np.diff(np.append(first, len(tokens)))
        chunk = int(mix(np.array([TaskContext.get().partitionId() << 32 | number], dtype=np.uint64)).view(np.int64)[0])
        several = np.repeat(count > 1, count)
        yield _rows(
            _CHUNK, 1, route=[chunk % buckets], chunk=[chunk], payload=[_pack(nodes[kept], n[kept], tokens[several], owner[several])]
        )
        size = np.uint64((1 << 48) // buckets + 1)
        lone, many = first[count == 1], first[count > 1]
        counts, in_lone, in_many = count[count > 1].astype(np.uint32), tokens[lone] // size, tokens[many] // size
        routes = np.union1d(in_lone, in_many)  # only buckets that get something
        blobs = []
        del first, count, several
        for b in routes:
            one, more = (slice(*np.searchsorted(at, [b, b + np.uint64(1)])) for at in (in_lone, in_many))
            blobs.append(_pack(tokens[lone[one]], owner[lone[one]], tokens[many[more]], counts[more]))
        yield _rows(_POSTINGS, len(routes), route=routes.astype(np.int64), chunk=np.full(len(routes), chunk), payload=blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, held, number = [], [], 0, 0
        for batch in batches:
            known = batch.column(0).to_pylist()
            for first, found in shingles(batch.column(1), width):
                for i, s in enumerate(found):
                    ids.append(known[first + i])
                    sets.append(s)
                    held += len(s)
                    if held >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCUMENTS:
                        yield from chunk_rows(number, ids, sets)
                        ids, sets, held, number = [], [], 0, number + 1
        if ids:
            yield from chunk_rows(number, ids, sets)

    return run


def _ranges(runs: list[np.ndarray]) -> Iterator[list[tuple[int, int, int]]]:
    """Ranges of values that cover ascending arrays: (array, begin, end) of those that have some, about `RANGE_TOKENS` in all."""
    filled = [i for i, x in enumerate(runs) if len(x)]
    if not filled:
        return
    parts = -(-sum(len(runs[i]) for i in filled) // RANGE_TOKENS)
    least, most = min(int(runs[i][0]) for i in filled), max(int(runs[i][-1]) for i in filled)
    edges = np.array([least + (most + 1 - least) * k // parts for k in range(1, parts)], dtype=np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(runs[i], edges), [len(runs[i])]]) for i in filled]
    for k in range(parts):
        if places := [(i, int(c[k]), int(c[k + 1])) for i, c in zip(filled, cuts) if c[k] < c[k + 1]]:
            yield places


def _answer(table: pa.Table) -> pa.Table:
    """One bucket: documents per token; each chunk hears of its tokens that two or more documents hold."""
    kinds = table.column("kind").to_numpy()
    through = table.filter(pa.array(kinds != _POSTINGS))
    rows = table.filter(pa.array(kinds == _POSTINGS))
    if not rows.num_rows:
        return through
    blobs = [_unpack(b.as_buffer()) for b in rows.column("payload")]
    chunks = rows.column("chunk").to_numpy()
    runs = [x for b in blobs for x in (b[0], b[2])]  # each ascends
    counts = [x for b in blobs for x in (None, b[3])]
    df = [np.empty(len(x), np.uint32) for x in runs]
    del rows, table
    for places in _ranges(runs):
        parts = [runs[i][low:high] for i, low, high in places]
        tokens = np.concatenate(parts)
        held = np.concatenate([np.ones(high - low, np.uint32) if counts[i] is None else counts[i][low:high] for i, low, high in places])
        order = np.argsort(tokens)
        tokens = tokens[order]
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        total = np.add.reduceat(held[order], first)
        held[order] = np.repeat(total, np.diff(np.append(first, len(tokens))))
        for (i, low, high), own in zip(places, np.split(held, np.cumsum([len(x) for x in parts[:-1]]))):
            df[i][low:high] = own
    payloads = []
    for k, b in enumerate(blobs):
        shared = df[2 * k] > 1
        payloads.append(_pack(b[0][shared], b[1][shared], df[2 * k][shared], b[2], df[2 * k + 1]))
        blobs[k] = runs[2 * k] = runs[2 * k + 1] = df[2 * k] = df[2 * k + 1] = counts[2 * k + 1] = None
    return pa.concat_tables([through.cast(_PARTS), pa.Table.from_batches([_rows(_ANSWER, len(payloads), chunk=chunks, payload=payloads)])])


_ALIVE_DDL = "node bigint, n int, matches int, prefix array<bigint>, tokens binary"
_ALIVE = pa.schema([("node", pa.int64()), ("n", pa.int32()), ("matches", pa.int32()), ("prefix", pa.list_(pa.int64())), ("tokens", pa.binary())])


def _matches(df: np.ndarray, need: int, n: int) -> int:
    """The l with the least estimated cost: postings to read, and candidates that share l of them."""
    best, least = 1, None
    for l in MATCHES:
        if l > need:
            break
        prefix = df[: len(df) - need + l]
        postings = float(prefix.sum())
        cost = postings + 0.05 * n * (postings - len(prefix)) / l
        if least is None or cost < least:
            best, least = l, cost
    return best


def _choose(percent: int):
    """Task function: what a chunk kept and the answers to it -> its documents that may have a partner."""

    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        blobs = [_unpack(b.as_buffer()) for b in table.column("payload")]
        nodes, n, tokens, owner = next(b for b, k in zip(blobs, kinds) if k == _CHUNK)
        answers = [b for b, k in zip(blobs, kinds) if k == _ANSWER]
        if not answers:
            return pa.Table.from_batches([], _ALIVE)
        many, df = np.concatenate([a[3] for a in answers]), np.concatenate([a[4] for a in answers])
        order = np.argsort(many)
        known = df[order][np.searchsorted(many[order], tokens)] if len(tokens) else df[:0]
        tokens = np.concatenate([tokens, *(a[0] for a in answers)])
        owner = np.concatenate([owner, *(a[1] for a in answers)])
        df = np.concatenate([known, *(a[2] for a in answers)])
        need = _needed(n, percent)
        alive = np.bincount(owner, minlength=len(nodes)) >= need
        use = alive[owner]
        tokens, owner, df = tokens[use], owner[use], df[use]
        order = np.lexsort((tokens, df, owner))
        tokens, owner, df = tokens[order], owner[order], df[order]
        bounds = np.searchsorted(owner, np.arange(len(nodes) + 1))
        out = []
        for i in np.flatnonzero(alive):
            own, freq = tokens[bounds[i] : bounds[i + 1]], df[bounds[i] : bounds[i + 1]]
            l = _matches(freq, int(need[i]), int(n[i]))
            prefix = own[: len(own) - int(need[i]) + l].view(np.int64)
            whole = np.sort(own)
            packed = whole.astype(np.uint32).tobytes() + (whole >> np.uint64(32)).astype(np.uint16).tobytes()
            out.append((int(nodes[i]), int(n[i]), l, prefix, packed))
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _ALIVE)], schema=_ALIVE)

    return run


def _tokens(packed: bytes) -> np.ndarray:
    k = len(packed) // 6
    return np.frombuffer(packed, np.uint32, k).astype(np.uint64) | (np.frombuffer(packed, np.uint16, k, 4 * k).astype(np.uint64) << np.uint64(32))


def _verify_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            ta, tb = batch.column("ta"), batch.column("tb")
            common = np.array(
                [len(np.intersect1d(_tokens(ta[i].as_py()), _tokens(tb[i].as_py()), assume_unique=True)) for i in range(len(batch))], dtype=np.int64
            )
            linked = 100 * common >= percent * (na.astype(np.int64) + nb - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked))

    return run


_BLOCK_DDL = "node bigint, root bigint, links bigint"
_BLOCK = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def _verify_block(percent: int):
    """Task function: two blocks of a family (or one with itself) -> links per node and a root linked with it."""

    def incidence(sets: list[np.ndarray], columns: np.ndarray, rows: int) -> np.ndarray:
        m = np.zeros((rows, len(columns)), dtype=np.float32)
        for r, s in enumerate(sets):
            m[r, np.searchsorted(columns, s[np.searchsorted(s, columns[0]) : np.searchsorted(s, columns[-1], "right")])] = 1
        return m

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        nodes, n = table.column("node").to_numpy(), table.column("n").to_numpy().astype(np.int64)
        sets = [_tokens(x.as_py()) for x in table.column("tokens")]
        one = np.flatnonzero(side <= 1)
        two = one if (side == 0).any() else np.flatnonzero(side == 2)
        if not len(one) or not len(two):
            return pa.Table.from_batches([], _BLOCK)
        columns = np.unique(np.concatenate(sets))
        common = np.zeros((len(one), len(two)), dtype=np.float32)
        for c in range(0, len(columns), _TILE):
            tile = columns[c : c + _TILE]
            m = incidence([sets[i] for i in one], tile, len(one))
            common += m @ (m if two is one else incidence([sets[i] for i in two], tile, len(two))).T
        linked = 100 * common >= percent * (n[one][:, None] + n[two][None, :] - common)
        if two is one:
            np.fill_diagonal(linked, False)
            whole = linked
            members, links = one, linked.sum(axis=1)
        else:
            k = len(one)
            whole = np.zeros((k + len(two),) * 2, dtype=bool)
            whole[:k, k:], whole[k:, :k] = linked, linked.T
            members, links = np.concatenate([one, two]), np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
        label = np.arange(len(members))
        while True:
            least = np.minimum(label, np.where(whole, label[None, :], len(members)).min(axis=1))
            least = np.minimum(least, least[least])
            if (least == label).all():
                break
            label = least
        keep = links > 0
        return pa.Table.from_arrays([pa.array(nodes[members][keep]), pa.array(nodes[members[label]][keep]), pa.array(links[keep].astype(np.int64))], schema=_BLOCK)

    return run


def _families(hot: DataFrame) -> DataFrame:
    """(node, family): nodes that a chain of frequent prefix tokens connects."""
    least = hot.groupBy("token").agg(F.min("node").alias("b"))
    edges = hot.join(least, "token").select(F.col("node").alias("a"), "b").distinct()
    return components(edges).toDF("node", "family")


def _block_links(alive: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """(node, root, links) from all pairs of blocks of a family whose sizes allow a link."""
    base = 100.0 / percent
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(base)) + F.lit(1e-9)).cast("int")
    members = families.join(alive.select("node", "n", "tokens"), "node").withColumn("step", step)
    shares = members.groupBy("family", "step").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(BLOCK))).cast("int").alias("parts"))
    shares = cut_lineage(shares)
    for name, shift in (("below", 1), ("above", -1)):
        near = shares.select("family", (F.col("step") + F.lit(shift)).alias("step"), F.col("parts").alias(name))
        members = members.join(near, ["family", "step"], "left")
    members = members.join(shares, ["family", "step"])
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")

    def pairs(count: Column, pair) -> Column:
        some = F.coalesce(count, F.lit(0)) > 0
        return F.when(some, F.transform(F.sequence(F.lit(0), F.coalesce(count, F.lit(1)) - F.lit(1)), pair)).otherwise(F.array().cast("array<struct<s:int,h:int,g:int,d:int,side:int>>"))

    def entry(s: Column, h: Column, g: Column, d: int, side: Column) -> Column:
        return F.struct(s.cast("int").alias("s"), h.cast("int").alias("h"), g.cast("int").alias("g"), F.lit(d).alias("d"), side.cast("int").alias("side"))

    p, s = F.col("part"), F.col("step")
    same = pairs(F.col("parts"), lambda k: entry(s, F.least(k, p), F.greatest(k, p), 0, F.when(k == p, 0).when(p < k, 1).otherwise(2)))
    up = pairs(F.col("above"), lambda k: entry(s, p, k, 1, F.lit(1)))
    down = pairs(F.col("below"), lambda k: entry(s - F.lit(1), k, p, 1, F.lit(2)))
    dealt = members.withColumn("part", part).withColumn("to", F.explode(F.concat(same, up, down)))
    return dealt.select("family", "node", "n", "tokens", "to.*").groupBy("family", "s", "h", "g", "d").applyInArrow(_verify_block(percent), _BLOCK_DDL)


def _buckets(docs: DataFrame) -> int:
    """Buckets of tokens: a task counts one at a time, so their size must not depend on the session's partitions."""
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) per row of `docs`: exact components of the similarity graph.

    Two documents link when 100 * |intersection| >= percent * |union|. `n_links` counts the other
    distinct sets that a document's set is linked with. A null or empty text has no shingles and is
    its own component. Rows with one id are rows of their own with that id. A component's id is the
    least id in it; a null id takes part and is never the least. Other columns are ignored.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    buckets = _buckets(slim)
    parts = slim.mapInArrow(_spread(width, buckets), _PARTS_DDL)
    parts = cut_lineage(parts.groupBy("route").applyInArrow(_answer, _PARTS_DDL))
    documents = parts.where(F.col("kind") == _DOCUMENT).select("doc_id", "n", "node")
    alive = parts.where(F.col("kind").isin(_CHUNK, _ANSWER)).select("kind", "chunk", "payload")
    alive = cut_lineage(alive.groupBy("chunk").applyInArrow(_choose(percent), _ALIVE_DDL).dropDuplicates(["node"]))

    postings = alive.select("node", "n", "matches", F.explode("prefix").alias("token"))
    sizes = postings.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
    frequent = cut_lineage(sizes.where(F.col("size") > PAIR_GROUP).select("token"))
    edges, degrees = [], []
    if not frequent.isEmpty():
        families = _families(postings.join(frequent, "token", "left_semi").select("token", "node"))
        blocks = cut_lineage(_block_links(alive, families, percent))
        edges.append(blocks.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        degrees.append(blocks.select("node", "links"))
        cold = alive.select("node", "n", "matches", "prefix").join(families, "node", "left")
    else:
        cold = alive.select("node", "n", "matches", "prefix", F.lit(None).cast("bigint").alias("family"))
    rare = sizes.where((F.col("size") > 1) & (F.col("size") <= PAIR_GROUP)).select("token")
    cold = cold.select("node", "n", "matches", "family", F.explode("prefix").alias("token")).join(rare, "token", "left_semi")
    x, y = cold.alias("x"), cold.alias("y")
    fits = (F.col("x.n") * 100 >= F.col("y.n") * percent) & (F.col("y.n") * 100 >= F.col("x.n") * percent)
    apart = F.col("x.family").isNull() | F.col("y.family").isNull() | (F.col("x.family") != F.col("y.family"))
    pairs = (
        x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & fits & apart)
        .groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .agg(F.count(F.lit(1)).alias("met"), F.min(F.least("x.matches", "y.matches")).alias("required"))
        .where("met >= required")
        .select("a", "b")
    )
    sets = alive.select("node", "n", "tokens")
    pairs = pairs.join(sets.toDF("a", "na", "ta"), "a").join(sets.toDF("b", "nb", "tb"), "b")
    links = cut_lineage(pairs.mapInArrow(_verify_pairs(percent), "a bigint, b bigint"))
    edges.append(links)
    degrees += [links.select(F.col(c).alias("node"), F.lit(1).cast("bigint").alias("links")) for c in "ab"]

    roots = components(_union(edges)).toDF("node", "root")
    degree = _union(degrees).groupBy("node").agg(F.sum("links").alias("links"))
    firsts = documents.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("first"))
    classes = firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = classes.join(ids, "root").join(degree, "node", "left").select("node", "component_id", F.coalesce("links", F.lit(0)).alias("n_links"))
    return documents.join(classes, "node", "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def _union(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    return whole
