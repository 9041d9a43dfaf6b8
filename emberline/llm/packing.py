"""Operator 3, packing token sequences by non-negative least squares."""

from __future__ import annotations

import functools
import importlib
import itertools
import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import id_key, null_if_no_id, running_totals, table

#: Tokens in a window; a remainder's body is a multiple of UNIT tokens; lengths in a combination at most; the id that ends a document.
WINDOW, UNIT, DEPTH, END = 2048, 32, 4, 1
UNITS = WINDOW // UNIT
#: Bytes that a task spends on words whose ids it remembers; those of the older half that aren't met again go. What Python spends on a word besides its own bytes.
REMEMBERED, ENTRY = 220 << 20, 200
#: Words that the tokenizer splits into their letters and the signs that follow: letters that stay single letters under
#: normalisation and lower-casing (ASCII, Latin-1, basic Cyrillic), signs without the apostrophe, which can start a piece of its own.
_PLAIN = re.compile(r"""([A-Za-zÀ-ÖØ-öø-ÿЀ-џ]+)([!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)""")
#: The characters by which byte-level vocabularies spell the bytes from 127 on that aren't printable in Latin-1.
_SPELLING = {**{b: b + 162 for b in range(127, 161)}, 173: 323}
#: Words by which a tokenizer shows that it takes letters and signs as pieces of their own.
_PROBES = ("a", "hello", "Straße", "été", "Привет", "unbelievableness", "word.", "naïve,", "слово!?", "x=", "token);", "ÀÉ--")
#: Bytes of text that are looked at together.
TOGETHER = 1 << 20
_ZEROS = bytes(4 * UNIT)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    return importlib.import_module("public_tokenizers").path(name)


class _Words:
    """Token ids of words, as bytes of unsigned 32-bit numbers. The tokenizer never joins characters across white space.

    Words are remembered, with A-Z in lower case as the tokenizer takes them. Of new ones that are plain letters and signs
    either part goes to the tokenizer's model at once, if the model proves to take them so; all other words are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.signs = functools.lru_cache(1 << 12)(self._piece)
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0
        self.in_parts = all(self._plain(w) == self._whole([w])[0] for w in _PROBES)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _piece(self, text: str) -> bytes:
        """Ids of letters or of signs alone, which the tokenizer doesn't split before its model does."""
        text = text.lower()
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(_SPELLING)
        return _packed([t.id for t in self.model.tokenize(text)])

    def _plain(self, text: str) -> bytes | None:
        """Ids of a word of plain letters and signs, else None. Its letters may be known as a word."""
        m = _PLAIN.fullmatch(text)
        if not m:
            return None
        if not m[2]:
            return self._piece(text)
        return (self.words.get(m[1].encode()) or self._piece(m[1])) + self.signs(m[2])

    def _learn(self, words: list[bytes]) -> None:
        other: list[bytes] = []
        for raw, text in zip(words, b" ".join(words).decode().split(" ") if words else ()):
            ids = self._plain(text) if self.in_parts else None
            if ids is None:
                other.append(raw)
            else:
                self.words[raw] = ids
        self.words.update(zip(other, self._whole([w.decode() for w in other])))

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        if self.held > REMEMBERED // 2:
            self.words, self.older, self.held = {}, self.words, 0
        # the tokenizer knows special tokens before it lower-cases
        split = [(t if b"<|" in t else t.lower()).split() for t in (t or b"" for t in texts)]
        new = set(itertools.chain.from_iterable(split)).difference(self.words)
        again = new.intersection(self.older)
        self.words.update(zip(again, map(self.older.__getitem__, again)))
        self._learn(list(new - again))
        self.held += ENTRY * len(new) + 3 * sum(map(len, new))
        get = self.words.__getitem__
        end = _packed([END])
        return [b"".join(map(get, words)) + end for words in split]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(maxsize=1)
def _words(path: str) -> _Words:
    """One memory per Python worker, which serves many tasks. Tasks are the parallelism here; the tokenizer's own threads would only compete with them."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return _Words(path)


def tokenized(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: what packing needs to know of it.

    doc_id (null as NO_ID); n (ids, with the end id); full (whole windows); bin (the rest's whole units); tail (the ids beyond them);
    window_crcs; unit_crcs (of the rest's units); tail_ids.
    """

    def run(batches):
        words, crc = _words(path), zlib.crc32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            n, windows, units, tails = [], [], [], []
            size = np.cumsum([len(t or b"") for t in texts]) // TOGETHER
            for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(size)) + 1):
                for raw in words.encode([texts[i] for i in some]):
                    count = len(raw) // 4
                    full, rest = divmod(count, WINDOW)
                    n.append(count)
                    windows.append([crc(raw[i : i + 4 * WINDOW]) for i in range(0, 4 * full * WINDOW, 4 * WINDOW)])
                    start = 4 * full * WINDOW
                    stop = start + 4 * (rest // UNIT * UNIT)
                    units.append([crc(raw[i : i + 4 * UNIT]) for i in range(start, stop, 4 * UNIT)])
                    tails.append(raw[stop:])
            count = np.array(n, np.int64)
            rest = count % WINDOW
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(count), pa.array(count // WINDOW), pa.array(rest // UNIT), pa.array(rest % UNIT), pa.array(windows, pa.list_(pa.int64())), pa.array(units, pa.list_(pa.int64())), pa.array(tails, pa.binary())],
                names=["doc_id", "n", "full", "bin", "tail", "window_crcs", "unit_crcs", "tail_ids"],
            )

    schema = "doc_id long, n long, full long, bin long, tail long, window_crcs array<long>, unit_crcs array<long>, tail_ids binary"
    return docs.select(id_key(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)


def combinations(units: int = UNITS, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All ways to fill a window with 2 to ``depth`` bodies, as lengths in units."""
    out = []
    for d in range(2, depth + 1):
        for head in itertools.combinations_with_replacement(range(1, units), d - 1):
            last = units - sum(head)
            if last >= head[-1]:
                out.append((*head, last))
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by an active set of columns."""
    m, n = a.shape
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-10 * max(1.0, np.abs(a.T @ b).max())
    for _ in range(rounds):
        w = a.T @ (b - a @ x)
        w[active] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= tolerance:
            break
        active[j] = True
        while True:
            s = np.zeros(n)
            s[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            bad = active & (s <= 1e-12)
            if not bad.any():
                x = s
                break
            step = np.min(x[bad] / np.maximum(x[bad] - s[bad], 1e-300))
            x = x + step * (s - x)
            active &= x > 1e-12
            x[~active] = 0
    return x


def repeat_counts(histogram: np.ndarray, combos: list[tuple[int, ...]]) -> np.ndarray:
    """How often each combination is used: the least-squares solution rounded down, never beyond the histogram, then what still fits.

    histogram[u]: bodies of u units.
    """
    a = np.zeros((len(histogram), len(combos)))
    for j, combo in enumerate(combos):
        for u in combo:
            a[u, j] += 1
    scale = max(1.0, float(histogram.sum()))
    x = nnls(a, histogram / scale) * scale
    left, counts = histogram.astype(np.int64).copy(), np.zeros(len(combos), np.int64)
    whole = a.astype(np.int64)
    for most in (np.floor(x + 1e-6).astype(np.int64), np.full(len(combos), np.iinfo(np.int64).max)):
        for j in np.argsort(-x, kind="stable"):
            used = np.flatnonzero(whole[:, j])
            take = min(int(most[j] - (counts[j] if most[j] < 2**62 else 0)), int((left[used] // whole[used, j]).min()))
            if take > 0:
                counts[j] += take
                left[used] -= take * whole[used, j]
    return counts


class _Layout:
    """Where bodies and tails lie, from the histogram over (bin, tail): at most UNITS * UNIT counts, whatever the corpus."""

    def __init__(self, counts: dict[tuple[int, int], int], windows: int):
        h = np.zeros((UNITS, UNIT), np.int64)
        for (u, t), n in counts.items():
            h[u, t] = n
        per_bin = h.sum(1)
        self.bin_start = per_bin.cumsum() - per_bin  # rows are numbered by bin, then tail
        flat = h.ravel()
        self.row_start = (flat.cumsum() - flat).reshape(h.shape)
        usable = per_bin.copy()
        usable[0] = 0
        combos = combinations()
        repeats = repeat_counts(usable, combos)
        runs: list[list[tuple[int, int, int]]] = [[] for _ in range(UNITS)]  # per bin: first rank, first sequence, offset
        used, sequence = np.zeros(UNITS, np.int64), windows
        for combo, n in zip(combos, repeats.tolist()):
            if n:
                offset = 0
                for u in combo:
                    runs[u].append((int(used[u]), sequence, offset))
                    used[u] += n
                    offset += u * UNIT
                sequence += n
        self.runs = [np.array(r, np.int64).reshape(-1, 3) for r in runs]
        self.used = used
        rest = (usable - used) * np.arange(UNITS) * UNIT
        self.rest_start = rest.cumsum() - rest
        tails = (h * np.arange(UNIT)).ravel()
        self.tail_start = (rest.sum() + tails.cumsum() - tails).reshape(h.shape)
        self.first_rest, self.stream = sequence, int(rest.sum() + tails.sum())
        last = self.stream // WINDOW * WINDOW
        self.cuts, at = [], last  # where the sequences of the last, partial window begin: powers of two, no padding
        for bit in range(WINDOW.bit_length() - 2, -1, -1):
            if (self.stream - last) >> bit & 1:
                self.cuts.append(at)
                at += 1 << bit
        self.last = last

    def pieces(self, at: int, length: int):
        """(sequence, offset, skip, length) of a stretch of the rest's stream, cut at the ends of sequences."""
        end, skip = at + length, 0
        while at < end:
            if at < self.last:
                begin = at // WINDOW * WINDOW
                stop, number = begin + WINDOW, at // WINDOW
            else:
                k = int(np.searchsorted(self.cuts, at, "right")) - 1
                begin, number = self.cuts[k], self.last // WINDOW + k
                stop = self.cuts[k + 1] if k + 1 < len(self.cuts) else self.stream
            n = min(end, stop) - at
            yield self.first_rest + number, at - begin, skip, n
            at, skip = at + n, skip + n


def _joined_crc(crcs) -> int:
    """CRC-32 of consecutive units from the units' own: CRC-32 is linear, so the first part advances over zeros."""
    out = int(crcs[0])
    none = zlib.crc32(_ZEROS, 0)
    for c in crcs[1:]:
        out = int(c) ^ zlib.crc32(_ZEROS, out) ^ none
    return out


def pack(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each document becomes token ids and an end id. Its whole windows are sequences of their own. The rest's body (whole
    units of 32 ids) fills windows in combinations of 2 to 4 bodies: how often each combination occurs solves a
    non-negative least-squares problem against the histogram of body lengths (at most 64 counts). Bodies that rounding
    leaves over, and the tails of fewer than 32 ids, form one stream, which is cut at window ends; the last, partial
    window is cut into powers of two. So only whole windows and powers of two occur, and nothing is padded.

    Where each piece lies follows from a document's row number in the order of (bin, tail, id) and the histogram, so the
    documents are sorted once, and ids themselves are never shuffled. Null text counts as empty (only the end id). Null
    ids and rows that repeat an id are packed like any other.
    """
    rows = table(tokenized(docs, path or tokenizer_path(), id_column, text_column))
    counts = {(r["bin"], r["tail"]): r["n"] for r in rows.groupBy("bin", "tail").agg(F.count("*").alias("n")).collect()}  # 2,048 rows at most
    windows = rows.agg(F.sum("full")).first()[0] or 0
    layout = _Layout(counts, windows)
    ordered = running_totals(rows.withColumn("tie", F.xxhash64("window_crcs", "unit_crcs", "tail_ids")), ["bin", "tail", "doc_id", "tie"], "full")

    def place(frames):
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                ident = r.doc_id
                for i, c in enumerate(r.window_crcs):
                    out.append((ident, i * WINDOW, WINDOW, int(c), r.n, r.before + i, 0))
                start, body = r.full * WINDOW, r.bin * UNIT
                if r.bin:
                    rank = r.row_index - layout.bin_start[r.bin]
                    if rank < layout.used[r.bin]:
                        first, sequence, offset = layout.runs[r.bin][np.searchsorted(layout.runs[r.bin][:, 0], rank, "right") - 1]
                        out.append((ident, start, body, _joined_crc(r.unit_crcs), r.n, int(sequence + rank - first), int(offset)))
                    else:
                        at = int(layout.rest_start[r.bin] + (rank - layout.used[r.bin]) * body)
                        for sequence, offset, skip, n in layout.pieces(at, body):
                            out.append((ident, start + skip, n, _joined_crc(r.unit_crcs[skip // UNIT : (skip + n) // UNIT]), r.n, sequence, offset))
                if r.tail:
                    at = int(layout.tail_start[r.bin, r.tail] + (r.row_index - layout.row_start[r.bin, r.tail]) * r.tail)
                    for sequence, offset, skip, n in layout.pieces(at, r.tail):
                        out.append((ident, start + body + skip, n, zlib.crc32(r.tail_ids[4 * skip : 4 * (skip + n)]), r.n, sequence, offset))
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]).astype("int64")

    pieces = ordered.mapInPandas(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return pieces.withColumn("doc_id", null_if_no_id(F.col("doc_id")))
