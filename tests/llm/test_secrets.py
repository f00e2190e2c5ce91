import hashlib
import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from demand_engine.llm import secrets
from demand_engine.llm.queries import QUERIES
from demand_engine.llm.secrets import Detector, dense_spans, find_secrets, secret_report

SCHEMA = "doc_id bigint, text string, spans int"  # an extra column with a clashing name


def brute_dense(run, window, bits):
    covered = set()
    for i in range(len(run) - window + 1):
        counts = Counter(run[i : i + window]).values()
        if -sum(c / window * math.log2(c / window) for c in counts) >= bits - 1e-9:
            covered.update(range(i, i + window))
    spans = []
    for i in sorted(covered):
        if spans and spans[-1][1] == i:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    return [tuple(s) for s in spans]


@settings(max_examples=200, deadline=None)
@given(st.text("abc0123xyz", max_size=60), st.integers(1, 12), st.sampled_from([0.5, 1.5, 2.0, 2.5, 3.0]))
def test_incremental_entropy(run, window, bits):
    got = dense_spans(run, window, bits)
    covered = {i for s, e in got for i in range(s, e)}
    assert covered == {i for s, e in brute_dense(run, window, bits) for i in range(s, e)}


def test_fixed_patterns():
    spans = Detector(classes=()).spans
    assert spans("API-key") == []
    assert spans("apiKey: 'abcdefghijkl'") == [("assign", 0, 21)]
    assert spans("token=short token=abcdefghijkl") == [("assign", 12, 30)]
    assert spans("token=password: abcdefghijklmn") == []  # the first match takes the second key
    assert spans("é AKIA" + "A" * 14) == [("access", 2, 20)]
    assert spans("AKIA" + "A" * 13) == []
    assert spans("x" + "0" * 16) == [("hex", 1, 17)]
    assert spans("paſſword=abcdefghijkl") == []  # letters outside ASCII don't fold


def test_entropy_adds_and_allow_list_takes_away():
    key = "q7Zp2Lx9Vb4Tn8Kc1Rf6Yd3Wm5Hs0Ge"
    assert ("entropy_base64", 4, 4 + len(key)) in Detector().spans(f"say {key} .")
    assert Detector().spans("id 123e4567-e89b-12d3-a456-426614174000") == []
    assert Detector(allowed=(key,)).spans(key) == []


def test_what_stands_before_a_key_does_not_hide_it():
    key = "q7Zp2Lx9Vb4Tn8Kc1Rf6Yd3Wm5Hs0Ge"
    for before in ("localhost/", "example_key_", "https_", "www/api-2/"):
        assert Detector().spans(before + key) == [("entropy_base64", len(before), len(before) + len(key))]
    assert any(k == "entropy_base64" for k, *_ in Detector().spans("exampleq7Zp2Lx9Vb4Tn8Kc1Rf6Yd3Wm5Hs0Ge"))
    for plain in ("localhost/path/to/some/long/page-2024", "www/another-page/with_many-words/in_it/2", "example_of_a_name_with_many_words_99"):
        assert Detector().spans(plain) == []


def test_keys_of_letters_alone_are_found_and_names_are_not():
    rng, found = random.Random(5), 0
    for _ in range(200):
        key = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", k=40))
        found += bool(Detector().spans(f"key {key} end"))
    assert found > 185
    names = ["getCustomerAddressFromOrderHistory", "AbstractSingletonProxyFactoryBean", "donaudampfschifffahrtsgesellschaft", "SimpleBeanFactoryAwareAspectInstanceFactory"]
    assert all(Detector().spans(name) == [] for name in names)


def naive(text):
    """All spans by looking at every place and every window anew."""
    out = []
    for order, (kind, pattern) in enumerate((("assign", secrets.ASSIGN), ("access", secrets.ACCESS), ("hex", secrets.HEX))):
        at = 0
        while m := pattern.search(text, at):
            if kind != "assign" or len(m.group(2)) >= 12:
                out.append((m.start(), order, kind, m.end()))
            at = m.end()
    for order, c in enumerate(secrets.CLASSES, 3):
        inside = [bool(re.match(f"[{c.characters}]", x)) for x in text]
        start = 0
        while start < len(text):
            end = start
            while end < len(text) and inside[end]:
                end += 1
            run = text[start:end]
            if len(run) >= c.window:
                host = re.match(secrets.HOSTS, run)
                first = start + (host.end() if host else 0)
                run = text[first:end]
                digit, letter = any(x in "0123456789" for x in run), any(x.isascii() and x.isalpha() for x in run)
                bits = c.bits if digit else c.letter_bits
                if letter and bits is not None and not any(re.fullmatch(p, run) for p in secrets.ALLOWED):
                    out += [(first + s, order, c.kind, first + e) for s, e in brute_dense(run, c.window, bits)]
            start = max(end, start + 1)
    return sorted(out)


def test_registered_query_equals_brute_force(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op1_secret_scan"](spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        spans = naive(docs[r.doc_id] or "")
        base = [x for x in spans if x[1] < 3]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == k for x in spans) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in base).encode()).hexdigest()
        merged = [(s, o, k, e) for s, o, k, e in spans]
        assert r.spans == ",".join(f"{k}:{s}:{e}" for s, _, k, e in merged)


def test_nulls_empties_repeats_and_long_texts(spark):
    long = "word " * 50_000 + "secret=" + "aB3" * 10
    rows = [(1, None, 1), (2, "", 1), (3, long, 1), (3, long, 1), (None, "token=abcdefghijkl", None)]
    got = secret_report(find_secrets(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(got) == 5
    by = {r.doc_id: r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    assert by[1].base_sha256 == by[2].base_sha256 == empty and by[1].spans == ""
    assert by[3].n_assign == 1 and by[3].spans.startswith("assign:250000:250037")
    assert by[None].base_sha256 == hashlib.sha256(b"assign:0:18").hexdigest()
    assert find_secrets(spark.createDataFrame([], SCHEMA)).count() == 0
