import gzip
import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from demand_engine.llm.warc import _NAMES, _order, LoserTree, archive_pages, in_ranges, merge_index, parse_records, payload_digest, read_index, record, sorted_runs, url_key, with_revisits, write_archives

PAGES = [
    (1, "http://www.Example.org/A?x=1", "<p>same</p>"), (2, None, None), (3, "http://b.example.org:8080/", ""), (4, "no url", "<p>same</p>"),
    (4, "no url", "<p>same</p>"), (None, "http://b.example.org/", "<p>same</p>"), (5, "http://a.b/%\r\nWARC/1.1", "WARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n\r\n é" * 3), (6, "http://x/", "y" * 200_000),
]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree_merges_any_number_of_runs(runs):
    entries = [sorted([(f"k{v}", "", v, "f", r) for v in run], key=_order) for r, run in enumerate(runs)]
    assert list(LoserTree(entries)) == sorted((e for run in entries for e in run), key=lambda e: (_order(e)))


def test_records_come_back():
    body = "é\r\n\r\nWARC/1.1\r\n".encode()
    data = record(7, "http://a/%0d", body, None, False) + b"\r\n\r\n" + record(8, None, body, 7, True) + b"\r\n\r\n"
    (at, one, first), (_, two, second) = parse_records(data)
    assert (at, first, second) == (0, body, b"") and one["warc-payload-digest"] == two["warc-payload-digest"] == "sha1:" + payload_digest(body)
    assert two["warc-type"] == "revisit" and two["warc-refers-to"] == "<urn:page:7>"
    assert url_key("http://www.Example.org:80/A?B") == "org,example:80)/a?b" and url_key(None) == "" and url_key("http://[bad") == "http://[bad"


def test_pages_to_archives_and_back(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x", 0) for p in PAGES], "page_id bigint, url string, html string, key string, revisit int")
    got = archive_pages(pages.repartition(3), str(tmp_path / "w")).collect()
    by = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr)
    texts = [(i, (h or "").encode()) for i, _, h in PAGES]
    kept = {h: max(i for i, g in texts if g == h and i is not None) for _, h in texts}
    want = [(i, len(h), payload_digest(h), "response" if i == kept[h] else "revisit", None if i == kept[h] else kept[h]) for i, h in texts]
    assert by == sorted(want, key=repr)
    order = [_order(tuple(r[c] for c in _NAMES)) for r in got]
    assert order == sorted(order)
    raw = [gzip.open(f, "rb").read() for f in (tmp_path / "w").glob("*.gz")]
    assert sum(1 for data in raw for _ in parse_records(data)) == len(PAGES)


def test_least_size_segments_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    assert with_revisits(pages, 1_000).where("revisit").count() == 0
    write_archives(with_revisits(pages.coalesce(1)), str(tmp_path / "s"), segment_bytes=600)
    assert len(list((tmp_path / "s").glob("*.gz"))) > 2
    assert archive_pages(pages.limit(0), str(tmp_path / "e")).count() == 0


def test_merge_is_global_and_splits_one_url(spark):
    rng = random.Random(5)
    rows = [("one" if rng.random() < 0.7 else f"k{rng.randrange(50)}", f"t{rng.randrange(99)}", k, "f", k, "response", "d", 1, None) for k in range(3_000)]
    schema = ", ".join(f"{c} {'bigint' if c in ('page_id', 'offset', 'payload_bytes', 'refers_to') else 'string'}" for c in _NAMES)
    merged = merge_index(spark.createDataFrame(rows, schema).repartition(5), 8)
    parts = merged.rdd.glom().map(lambda p: [tuple(r) for r in p]).collect()
    flat = [_order(e) for p in parts for e in p]
    assert flat == sorted(map(_order, rows)) and max(map(len, parts)) < 1_200
    assert callable(read_index)


def test_a_range_has_no_more_runs_than_files(spark, tmp_path):
    """Whatever is broadcast or not, nothing sorts the entries anew between a file and the merge."""
    pages = spark.createDataFrame([(k, f"http://h{k * 7919 % 50}.org/{k % 13}", f"text {k % 40}" * 20) for k in range(600)], "page_id bigint, url string, html string")
    write_archives(with_revisits(pages.repartition(5)), str(tmp_path / "w"), segment_bytes=8_000)
    files = len(list((tmp_path / "w").glob("*.gz")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        read_index(spark.read.format("binaryFile").load(str(tmp_path / "w"))).write.parquet(str(tmp_path / "i"))
        ranged = in_ranges(spark.read.parquet(str(tmp_path / "i")), 3)
        counts = ranged.mapInArrow(lambda b: [pa.RecordBatch.from_pydict({"runs": [len(r := sorted_runs(b))], "rows": [sum(map(len, r))]})], "runs bigint, rows bigint").collect()
        merged = archive_pages(pages).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert merged == 600 == sum(r["rows"] for r in counts) and files > 4
    assert all(r["runs"] <= files and r["rows"] > 100 for r in counts)
