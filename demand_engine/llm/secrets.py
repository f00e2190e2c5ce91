"""Secrets in texts: fixed patterns, and windows of high entropy inside candidate strings.

Candidates are the maximal runs of a character class that are long enough. A window slides over a
candidate; its Shannon entropy is kept up by adding the term of the character that enters and taking
off that of the one that leaves, so that a candidate costs one step per character whatever the
window. Windows at or above the class's bound are merged to spans. Spans that an allow-list pattern
accounts for are suppressed; spans of the fixed patterns never are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns and the least length of the part that counts, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharacterClass:
    """Runs of `characters` of at least `window` are candidates; `bits` is the entropy bound per window.

    `letter_bits` is the bound for candidates without a digit, higher since words in mixed case have more
    entropy than plain ones; None: they are no candidates. Those without a letter never are.
    """

    kind: str
    characters: str
    window: int
    bits: float
    letter_bits: float | None = None


CLASSES = (
    CharacterClass("entropy_hex", "0-9a-fA-F", 20, 3.0),
    CharacterClass("entropy_base64", "A-Za-z0-9+/=_-", 24, 4.0, 4.1),
)
#: What stands at a candidate's beginning and needs no look: hosts, with words and short numbers behind them.
HOSTS = r"(?i)(https?|www|example|localhost)(?![A-Za-z0-9])([/_=+-]+([a-z]{1,16}|\d{1,4})(?![a-z0-9]))*[/_=+-]*"
#: A candidate that one of these matches as a whole is no secret (what follows a host, if it begins with one).
ALLOWED = (
    r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}",  # identifiers in their usual grouping
    r"[A-Z]?[a-z]+([-_/][A-Za-z]?[a-z]+)*\d{0,4}",  # words joined by marks, perhaps with a number
    r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-]?[0-9]*[Zz]?",  # dates and times
    r"(.)\1*|[=_+/-]+",  # rules and fillers
)


@dataclass
class Detector:
    """What a scan looks for; compiled once per task."""

    classes: tuple[CharacterClass, ...] = CLASSES
    allowed: tuple[str, ...] = ALLOWED
    hosts: str = HOSTS
    _runs: list = field(default_factory=list, repr=False)

    def __post_init__(self) -> None:
        self._runs = [(c, re.compile(f"[{c.characters}]{{{c.window},}}")) for c in self.classes]
        self._allow = [re.compile(p) for p in self.allowed]
        self._hosts = re.compile(self.hosts)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then by kind as listed; code points, end exclusive."""
        found = []
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append((m.start(), 0, "assign", m.end()))
        found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
        for order, (kind, pattern) in enumerate(self._runs, len(BASE_KINDS)):
            for m in pattern.finditer(text):
                known = self._hosts.match(m.group())
                at = m.start() + (known.end() if known else 0)
                run = text[at : m.end()]
                bits = kind.bits if re.search("[0-9]", run) else kind.letter_bits
                if bits is None or not re.search("[A-Za-z]", run) or any(a.fullmatch(run) for a in self._allow):
                    continue
                found += [(at + s, order, kind.kind, at + e) for s, e in dense_spans(run, kind.window, bits)]
        return [(kind, start, end) for start, _, kind, end in sorted(found)]


def dense_spans(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged windows of `run` whose Shannon entropy is at least `bits`; (start, end), end exclusive.

    With counts c of the characters of a window of w, the entropy is log2 w - (sum c log2 c) / w.
    The sum changes by two terms per step.
    """
    if len(run) < window:
        return []
    terms = [0.0, 0.0, *(c * math.log2(c) for c in range(2, window + 2))]
    most = (math.log2(window) - bits) * window + 1e-9
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for end, char in enumerate(run):
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += terms[c + 1] - terms[c]
        if end >= window:
            gone = run[end - window]
            c = counts[gone]
            counts[gone] = c - 1
            total += terms[c - 1] - terms[c]
        if end >= window - 1 and total <= most:
            start = end - window + 1
            if out and start <= out[-1][1]:
                out[-1][1] = end + 1
            else:
                out.append([start, end + 1])
    return [(s, e) for s, e in out]


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, detector: Detector | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) per row of `docs`: all secrets of the whole text, overlaps of kinds included.

    A null or empty text has no spans. Repeated rows give repeated rows. Other columns are ignored.
    """
    wanted = detector or Detector()
    classes, allowed, hosts = wanted.classes, wanted.allowed, wanted.hosts
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Detector(classes, allowed, hosts)
        for batch in batches:
            spans = []
            for text in batch.column("text"):
                found = own.spans(text.as_py() or "")
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, spans {_SPANS}")


def secret_report(found: DataFrame) -> DataFrame:
    """Counts per fixed kind, digest of the fixed spans and the text form of all spans."""

    def listed(spans: Column | str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"))
