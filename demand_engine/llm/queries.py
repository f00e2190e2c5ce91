"""Registered queries of the document operators: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Folder of public tokenizer files, read by the driver.
TOKENIZERS = "/opt/tokenizers"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.secrets import find_secrets, secret_report

    return secret_report(find_secrets(_table(spark, sf_dir, "documents")))


@_register
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.pieces import encoding_report

    return encoding_report(spark, _table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


@_register
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.jaccard import similar_documents

    return similar_documents(_table(spark, sf_dir, "documents"))


ORACLES["op3_jaccard_join"] = r"""
WITH RECURSIVE
doc AS (SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
gram AS (SELECT DISTINCT row_id, array_to_string(words[pos : pos + least(len(words), 5) - 1], ' ') AS gram
    FROM (SELECT row_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS pos FROM doc WHERE len(words) > 0) g),
own AS (SELECT row_id, count(*) AS n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS content FROM gram GROUP BY row_id),
pair AS (SELECT x.row_id AS a, y.row_id AS b, count(*) AS common FROM gram x JOIN gram y USING (gram) WHERE x.row_id <> y.row_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN own x ON x.row_id = a JOIN own y ON y.row_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach AS (SELECT row_id AS a, row_id AS b FROM doc UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least_id AS (SELECT a, min(doc_id) AS component_id FROM reach JOIN doc ON row_id = b GROUP BY a),
degree AS (SELECT a, count(DISTINCT y.content) AS n_links FROM link JOIN own x ON x.row_id = a JOIN own y ON y.row_id = b
    WHERE x.content <> y.content GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM doc LEFT JOIN own USING (row_id) JOIN least_id ON row_id = least_id.a LEFT JOIN degree ON row_id = degree.a
"""


@_register
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.quality import quality_report

    return quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.warc import archive_pages

    return archive_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLES["op5_warc"] = """
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT *, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS kept FROM page),
digits AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, CAST(1 + 5 * i AS BIGINT), 5) AS BIGINT)) AS fives FROM hashed)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(fives, lambda v: array_to_string(list_transform([15, 10, 5, 0],
        lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM digits
"""


@_register
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.language import language_report

    return language_report(_table(spark, sf_dir, "documents"))


@_register
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.chat import chat_report

    return chat_report(_table(spark, sf_dir, "conversations"))


ORACLES["op7_chat_format"] = r"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
long AS (SELECT *, 24 + length(role || text) + length(regexp_replace(role || chr(0) || text, '[^\\]', '', 'g'))
    + length(regexp_replace(role, '[^\n]', '', 'g'))
    + len(regexp_extract_all(role || chr(0) || text, '<\|im_start\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS chars FROM said)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM long GROUP BY conv_id
"""


@_register
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.lines import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True, equal_from=1)


@_register
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.contamination import contamination

    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_key")


ORACLES["op9_benchmark_decontamination"] = r"""
WITH
doc AS (SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
shape AS (SELECT item_id, words, least(len(words), 10) AS size FROM item WHERE len(words) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(words[pos : pos + size - 1], ' ') AS window_text
    FROM shape, LATERAL (SELECT unnest(generate_series(1, len(words) - size + 1)) AS pos) t),
place AS (SELECT row_id, size, pos, array_to_string(words[pos : pos + size - 1], ' ') AS window_text
    FROM doc, (SELECT DISTINCT size FROM win) z, LATERAL (SELECT unnest(generate_series(1, len(words) - size + 1)) AS pos) t),
met AS (SELECT row_id, pos, size, item_id FROM place JOIN win USING (size, window_text)),
hit AS (SELECT row_id, count(DISTINCT word_at) AS n_hit
    FROM (SELECT row_id, unnest(generate_series(pos, pos + size - 1)) AS word_at FROM (SELECT DISTINCT row_id, pos, size FROM met) m) u GROUP BY row_id),
named AS (SELECT row_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
    FROM (SELECT DISTINCT row_id, item_id FROM met WHERE item_id IS NOT NULL) m GROUP BY row_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (row_id) LEFT JOIN named USING (row_id)
"""


@_register
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.exact import exact_duplicates

    return exact_duplicates(_table(spark, sf_dir, "documents"))


ORACLES["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_register
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.trie import trie_report

    return trie_report(_table(spark, sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = r"""
WITH
said AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, count(*) OVER (PARTITION BY conv_id) AS n,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT conv_id, any_value(n) AS n, xor(4294967295, list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [CAST(0 AS BIGINT) FOR i IN range(8)]),
            lambda r, unused: xor(r >> 1, 3988292384 * (r & 1))))) % 4 AS h
    FROM said GROUP BY conv_id),
plan AS (SELECT c.conv_id, c.n, c.h, c.conv_id - c.conv_id % 20 AS first, least(c.h, coalesce(f.n, 0)) AS opened
    FROM conv c LEFT JOIN conv f ON f.conv_id = c.conv_id - c.conv_id % 20),
again AS (SELECT p.conv_id, s.place AS place, role, text FROM plan p JOIN said s ON s.conv_id = p.first WHERE s.place < p.h
    UNION ALL SELECT p.conv_id, s.place - h + opened, role, text FROM plan p JOIN said s ON s.conv_id = p.conv_id WHERE s.place >= h),
whole AS (SELECT p.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY place) FILTER (place IS NOT NULL), []) AS turns
    FROM plan p LEFT JOIN again USING (conv_id) GROUP BY p.conv_id),
step AS (SELECT conv_id, depth, turns[1:depth] AS path, len(turns) AS length FROM whole, LATERAL (SELECT unnest(generate_series(0, len(turns))) AS depth) d),
node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(length) = depth AS is_leaf,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
    FROM step GROUP BY path, depth),
up AS (SELECT path[1:above] AS path, above, depth, is_leaf, saved FROM node, LATERAL (SELECT unnest(generate_series(0, depth)) AS above) a),
below AS (SELECT path, above AS depth, sum(saved) AS saved_tokens, count(*) FILTER (is_leaf) AS n_leaves,
    count(*) FILTER (depth = above + 1) AS n_children FROM up GROUP BY path, above)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, b.n_children, b.n_leaves,
    CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN below b ON b.path = n.path AND b.depth = n.depth
LEFT JOIN node p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1 : n.depth - 1]
"""


@_register
def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.mixing import mix_report

    return mix_report(_table(spark, sf_dir, "documents"))


ORACLES["op12_source_mix"] = r"""
WITH
doc AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT)
        / CAST(4503599627370496 AS DOUBLE) AS draw FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM doc GROUP BY source),
weighed AS (SELECT source, source_size, CAST([3, 1, 2][CAST(place % 3 + 1 AS INT)] AS DOUBLE) AS weight, source_size * 2e0 AS most FROM per),
filled AS (SELECT *, sum(source_size) OVER () * 1.5e0 AS wanted, sum(weight) OVER () AS weights,
    coalesce(sum(most) OVER before, 0) AS most_before, coalesce(sum(weight) OVER before, 0) AS weight_before
    FROM weighed WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, most * (weights - weight_before) < weight * (wanted - most_before) AS is_full FROM filled),
level AS (SELECT *, coalesce(sum(most) FILTER (is_full) OVER (), 0) AS full_most, coalesce(sum(weight) FILTER (is_full) OVER (), 0) AS full_weight FROM marked),
aimed AS (SELECT source, source_size, CASE WHEN is_full THEN most ELSE least(weight * (wanted - full_most) / (weights - full_weight), most) END AS target FROM level),
rated AS (SELECT doc_id, size, source_size, target, draw, CASE WHEN source_size = 0 THEN 0e0 ELSE target / source_size END AS rate
    FROM doc JOIN aimed ON doc.source IS NOT DISTINCT FROM aimed.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CAST(size * (floor(rate) + CAST(draw < rate - floor(rate) AS INT)) AS BIGINT) AS taken
FROM rated
"""


@_register
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand_engine.llm.whitening import whitening_report

    return whitening_report(_table(spark, sf_dir, "embeddings"))
