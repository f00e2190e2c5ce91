"""WARC archives of pages, read back, and their capture index merged from sorted runs.

Writing: records are packed into segments of bounded size and written by Spark's own writer, one file
per segment, so that commits, retries and file systems are Spark's. Reading: each archive file gives
the index entries of its records as a run sorted by URL key, time and page. Merging: entries go to key
ranges that Spark derives from a sample; the total order on (URL key, time, page, file, offset) splits
even a single URL's captures. A range's sorted runs are merged by a loser tree, which yields globally
ordered capture histories: files in order, rows in order.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.session import cut_lineage, scratch_path

SEGMENT_BYTES = 32 << 20
#: Payloads of fewer bytes are stored again rather than referred to.
LEAST_REVISIT_BYTES = 0
#: Pages carry no time of capture; page n was captured n seconds after this.
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE_URN = "urn:page:"
#: An own field of revisits: bytes of the payload they stand for.
_LENGTH = "X-Refers-To-Payload-Length"
#: Entries that a task merges at once, about.
RANGE_ENTRIES = 100_000


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def capture_time(page_id: int | None) -> str:
    """A time for any page: the epoch plus its number of seconds, kept inside the years that dates can say."""
    seconds = (page_id or 0) % (200 * 365 * 86_400)
    return (EPOCH + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str | None) -> str:
    """Host labels reversed, then port, path and query: captures of a site sort together. Empty for none."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    reversed_host = ",".join(reversed(host.split(".")))
    query = f"?{parts.query.lower()}" if parts.query else ""
    return f"{reversed_host}{f':{port}' if port else ''}){(parts.path or '/').lower()}{query}"


def _header_value(text: str) -> str:
    """A value on one line: control characters and `%` as %XX."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "%\x7f" else c for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record without the blank lines that close it. A revisit has no payload of its own; the
    length of the one it refers to is in a field, so that an index needs no look at other records."""
    urn = "null" if page_id is None else page_id
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_PAGE_URN}{urn}>"),
        ("WARC-Date", capture_time(page_id)),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", _header_value(url)))
    if revisit:
        fields += [("WARC-Profile", _REVISIT_PROFILE), ("WARC-Refers-To", f"<{_PAGE_URN}{refers_to}>"), (_LENGTH, str(len(payload)))]
    body = b"" if revisit else payload
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(body)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields by lower-case name, block) of each record, by its stated length."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        end = head + 4 + int(fields["content-length"])
        yield at, fields, data[head + 4 : end]
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} isn't closed")
        at = end + 4


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to, revisit): of equal payloads of at least `least` bytes the largest page_id is kept.

    Equal payloads meet by SHA-256. Rows that repeat a payload and its largest id are all
    responses; a null id is less than any other.
    """
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"), F.sha2(html, 256).alias("key")
    )
    groups = cut_lineage(keyed.groupBy("key").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    joined = keyed.join(groups.select("key", "kept"), "key", "left")
    revisit = (F.octet_length("html") >= least) & F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("kept")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write `with_revisits(pages)` as gzip-compressed WARC files of about `segment_bytes` each under `path`."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(held).decode()], pa.string())], ["value"])

        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to", "revisit"))):
                held.append(record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py(), revisit.as_py()))
                size += len(held[-1])
                if size >= segment_bytes:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    made = pages.mapInArrow(segments, "value string")
    made.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


_ENTRY = (
    "url_key string, captured_at string, page_id bigint, file string, offset bigint, record_type string, "
    "payload_digest string, payload_bytes bigint, refers_to bigint"
)
_NAMES = [x.split()[0] for x in _ENTRY.split(", ")]


def _order(entry: tuple) -> tuple:
    """Total order of entries; a null page comes first."""
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[3], entry[4]


def read_index(path_files: DataFrame) -> DataFrame:
    """Index entries of archive files (path, content), each file's as a sorted run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                name = path.as_py().rsplit("/", 1)[-1]
                entries = []
                for offset, fields, block in parse_records(gzip.decompress(content.as_py())):
                    page = fields["warc-record-id"].removeprefix(f"<{_PAGE_URN}").removesuffix(">")
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    kind, target = fields["warc-type"], fields.get("warc-refers-to")
                    if kind == "response" and payload_digest(block) != digest:
                        raise ValueError(f"the payload at byte {offset} of {name} doesn't have its digest")
                    entries.append(
                        (
                            url_key(_unescaped(fields.get("warc-target-uri"))),
                            fields["warc-date"],
                            None if page == "null" else int(page),
                            name,
                            offset,
                            kind,
                            digest,
                            len(block) if kind == "response" else int(fields[_LENGTH.lower()]),
                            int(target.removeprefix(f"<{_PAGE_URN}").removesuffix(">")) if target else None,
                        )
                    )
                entries.sort(key=_order)
                yield _batch(entries)

    return path_files.select("path", "content").mapInArrow(run, _ENTRY)


def _unescaped(value: str | None) -> str | None:
    if value is None or "%" not in value:
        return value
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


_TYPES = {"string": pa.string(), "bigint": pa.int64()}


def _batch(entries: list[tuple]) -> pa.RecordBatch:
    kinds = [_TYPES[x.split()[1]] for x in _ENTRY.split(", ")]
    columns = list(zip(*entries)) if entries else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, so that a new entry replays one path."""

    def __init__(self, runs: Iterable[Iterable[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.keys = [None if h is None else _order(h) for h in self.heads]
        k = len(self.runs)
        self.losers = [0] * max(k, 1)
        winners = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._wins(a, b) else (b, a)
        self.losers[0] = winners[1] if k > 1 else 0

    def _wins(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def __iter__(self) -> Iterator[tuple]:
        k = len(self.runs)
        while k and self.heads[self.losers[0]] is not None:
            winner = self.losers[0]
            yield self.heads[winner]
            head = next(self.runs[winner], None)
            self.heads[winner], self.keys[winner] = head, None if head is None else _order(head)
            node = (winner + k) // 2
            while node:
                if self._wins(self.losers[node], winner):
                    self.losers[node], winner = winner, self.losers[node]
                node //= 2
            self.losers[0] = winner


def in_ranges(entries: DataFrame, ranges: int) -> DataFrame:
    """Entries dealt to ascending key ranges; what a file has in a range arrives there in order."""
    return entries.repartitionByRange(ranges, "url_key", "captured_at", "page_id", "file", "offset")


def sorted_runs(batches: Iterable[pa.RecordBatch]) -> list[list[tuple]]:
    """The stretches of ascending entries of a range, as they arrive."""
    runs: list[list[tuple]] = []
    last = None
    for batch in batches:
        for entry in zip(*(batch.column(c).to_pylist() for c in _NAMES)):
            key = _order(entry)
            if last is None or key < last:
                runs.append([])
            runs[-1].append(entry)
            last = key
    return runs


def merge_index(entries: DataFrame, ranges: int | None = None) -> DataFrame:
    """Entries in global order: partitions are ascending key ranges, and each is merged from its runs.

    The rows of one file that fall into a range stay one run however the shuffle interleaves files: no
    join or sort comes between. There are as many ranges as keep each at about `RANGE_ENTRIES`, also inside
    a URL, which bounds what a task holds. `entries` is counted and sampled, so it should be a written table.
    """
    if ranges is None:
        least = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = max(least, entries.count() // RANGE_ENTRIES + 1)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for entry in LoserTree(sorted_runs(batches)):
            held.append(entry)
            if len(held) == 10_000:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    return in_ranges(entries, ranges).mapInArrow(merge, _ENTRY)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write pages to archives, read them back, and return the merged index, one row per page.

    Null html is an empty payload, a null url has an empty key, a null page_id is kept as such.
    Repeated rows are records of their own. Other columns are ignored.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(with_revisits(pages), path)
    files = spark.read.format("binaryFile").load(path)
    return merge_index(cut_lineage(read_index(files)))
