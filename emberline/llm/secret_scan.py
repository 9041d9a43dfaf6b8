"""Operator 5, secret scans: fixed patterns, and the entropy of sliding windows over candidate strings."""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import id_key, null_if_no_id

# Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "entropy")
_KEYWORDS = ("password", "passwd", "secret", "token", "api")

#: Characters of a window; bits of entropy that a window of a class must reach at least; the classes' characters.
WIDTH = 20
CLASSES = (("hex", re.compile(r"[0-9a-fA-F]+"), 3.0), ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.85))
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Candidates that are never secrets: words and compound words, numbers and dates, UUIDs, alphabets, file paths and placeholders.
ALLOWED = re.compile(
    r"[A-Za-z]?[a-z]*(?:[-_/+=]+[A-Z]?[a-z]+|[A-Z][a-z]+)*[-_/+=]*|[A-Z]+(?:[-_/+=]+[A-Z]+)*|[0-9+/_=-]+"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|.*(?:0123456789|abcdefghijkl|ABCDEFGHIJKL|EXAMPLE|example|placeholder).*"
)
#: n -> n log2 n, for the counts of a window and the character after it.
_NLOG = [0.0] + [n * math.log2(n) for n in range(1, WIDTH + 2)]


def entropy_spans(text: str, width: int = WIDTH) -> list[tuple[int, int]]:
    """Stretches of ``text`` all of whose characters lie in a window that reaches its class's entropy.

    A window's entropy is log2(width) - sum(n log2 n) / width over its characters' counts n; one step changes two counts.
    """
    out = []
    for c in CANDIDATE.finditer(text):
        if not (any(x.isdigit() for x in c[0]) and any(x.isalpha() for x in c[0])) or ALLOWED.fullmatch(c[0]):
            continue
        for _, chars, least in CLASSES:
            most = (math.log2(width) - least) * width + 1e-9
            for run in chars.finditer(c[0]):
                s = run[0]
                if len(s) < width or not any(x.isdigit() for x in s):
                    continue
                counts: dict[str, int] = {}
                total, open_at, open_to = 0.0, -1, -1
                for i, x in enumerate(s):
                    n = counts.get(x, 0)
                    total += _NLOG[n + 1] - _NLOG[n]
                    counts[x] = n + 1
                    if i >= width:
                        n = counts[s[i - width]]
                        total -= _NLOG[n] - _NLOG[n - 1]
                        counts[s[i - width]] = n - 1
                    if i >= width - 1 and total <= most:
                        if open_to < i - width + 1:
                            if open_at >= 0:
                                out.append((c.start() + run.start() + open_at, c.start() + run.start() + open_to))
                            open_at = i - width + 1
                        open_to = i + 1
                if open_at >= 0:
                    out.append((c.start() + run.start() + open_at, c.start() + run.start() + open_to))
    return sorted(set(out))


def find(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, added) spans of a text as (start, number of kind, end), in order. added: entropy spans that no other span contains."""
    text = text or ""
    base: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    added: list[tuple[int, int, int]] = []
    if any(len(w) >= WIDTH for w in text.split()):
        base += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
        found, known = set(entropy_spans(text)), {(s, e) for s, _, e in base}
        reach = -1
        for s, e in sorted(found | known, key=lambda x: (x[0], -x[1])):  # whatever contains a span comes before it
            if reach < e and (s, e) not in known:
                added.append((s, 3, e))
            reach = max(reach, e)
    return sorted(base), sorted(added)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy.

    Whole texts are scanned; null counts as empty. Positions are code points, ends exclusive; spans are kind:start:end,
    by start, then kind, joined by commas. Rows are independent, so nothing is shuffled.
    """

    def run(batches):
        for batch in batches:
            rows = [find(t) for t in batch.column(1).to_pylist()]
            count = lambda k: pa.array([sum(x[1] == k for x in b) for b, _ in rows], pa.int64())  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), count(0), count(1), count(2),
                    pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in rows], pa.string()),
                    pa.array([_joined(sorted(b + a)) for b, a in rows], pa.string()),
                    pa.array([len(a) for _, a in rows], pa.int64()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"
    out = docs.select(id_key(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)
    return out.withColumn("doc_id", null_if_no_id(F.col("doc_id")))
