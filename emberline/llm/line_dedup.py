"""Operator 11, line dedup: sharded cuckoo filters in front of exact reference-count tables; documents come and go."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm.bytes_np import chunks, mixed
from emberline.llm.common import FEW, id_key, null_if_no_id, splittable, table

#: A key counts from so many code points on, and is repeated from so many documents on.
LEAST_POINTS, LEAST_DOCS = 20, 3
#: Repeated keys a shard's filter is planned for; bytes of all filters that are sent to all tasks at most.
SHARD_KEYS, MOST_FILTERS = 1 << 15, 64 << 20
#: Fingerprints in a bucket, moves until a filter counts as full, and the smallest number of buckets.
SLOTS, MOVES, LEAST_BUCKETS = 4, 200, 64

_WHITE = " \t\n\x0b\x0c\r"


class LineIndex(NamedTuple):
    """What is known of the lines of a collection; all frames are tables in the shared folder.

    references: (k1, k2, doc), one row for each document and distinct key in it, the exact table behind all else.
    repeated: (k1, k2, docs, latest), the reference count of each key in LEAST_DOCS documents or more and the largest id among them.
    filters: (shard, chain), the cuckoo filters of the repeated keys, ``shards`` rows at most.
    """

    references: DataFrame
    repeated: DataFrame
    filters: DataFrame
    shards: int


# --- cuckoo filters


def _marks(k1: np.ndarray) -> np.ndarray:
    """The fingerprints of keys: 16 bits, never 0, which stands for an empty slot."""
    return np.maximum(k1.view(np.uint64) >> np.uint64(48), np.uint64(1)).astype(np.uint16)


def _homes(k1: np.ndarray, marks: np.ndarray, buckets) -> tuple[np.ndarray, np.ndarray]:
    """Both buckets of keys in filters with so many buckets (a power of two, one number or one per key). Each follows from the other and the fingerprint."""
    low = np.asarray(buckets, np.uint64) - np.uint64(1)
    with np.errstate(over="ignore"):
        one = mixed(k1.view(np.uint64)) & low
        return one, one ^ (mixed(marks.astype(np.uint64)) & low)


class CuckooFilter:
    """A chain of cuckoo filters, each twice as large as the one before: what finds no place in one goes to the next, so no key is ever refused."""

    def __init__(self, chain: list[bytes] | None = None):
        self.chain = [np.frombuffer(c, np.uint16).reshape(-1, SLOTS).copy() for c in chain or []]

    @classmethod
    def planned(cls, keys: int) -> CuckooFilter:
        new = cls()
        new.chain.append(_empty(max(LEAST_BUCKETS, int(1.2 * keys / SLOTS))))
        return new

    def insert(self, k1: np.ndarray) -> None:
        for n in range(64):
            if n == len(self.chain):
                self.chain.append(_empty(2 * len(self.chain[-1]) if n else LEAST_BUCKETS))
            k1 = k1[[not self._place(self.chain[n], k) for k in k1]] if len(k1) else k1
            if not len(k1):
                return

    @staticmethod
    def _place(filter_: np.ndarray, key: np.int64) -> bool:
        mark = _marks(np.array([key]))
        a, b = (int(x[0]) for x in _homes(np.array([key]), mark, len(filter_)))
        mark, moved = mark[0], []
        for at in (a, b):
            free = np.flatnonzero(filter_[at] == 0)
            if len(free):
                filter_[at, free[0]] = mark
                return True
        at = b
        for i in range(MOVES):  # push out a fingerprint, which goes to its other bucket
            slot = (int(mark) + i) % SLOTS
            moved.append((at, slot, filter_[at, slot]))
            filter_[at, slot], mark = mark, filter_[at, slot]
            at ^= int(mixed(np.array([mark], np.uint64))[0]) & (len(filter_) - 1)
            free = np.flatnonzero(filter_[at] == 0)
            if len(free):
                filter_[at, free[0]] = mark
                return True
        for at, slot, was in reversed(moved):
            filter_[at, slot] = was
        return False

    def delete(self, k1: np.ndarray) -> None:
        """Takes out keys that were inserted, one fingerprint each."""
        for key in k1:
            mark = _marks(np.array([key]))
            for filter_ in self.chain:
                a, b = (int(x[0]) for x in _homes(np.array([key]), mark, len(filter_)))
                hit = [(at, s) for at in (a, b) for s in np.flatnonzero(filter_[at] == mark[0])]
                if hit:
                    filter_[hit[0]] = 0
                    break

    def holds(self, k1: np.ndarray) -> np.ndarray:
        """Which keys may be held: all that are, and few others."""
        out = np.zeros(len(k1), bool)
        for filter_ in self.chain:
            marks = _marks(k1)
            a, b = _homes(k1, marks, len(filter_))
            out |= (filter_[a] == marks[:, None]).any(1) | (filter_[b] == marks[:, None]).any(1)
        return out

    def packed(self) -> list[bytes]:
        return [c.tobytes() for c in self.chain]


def _empty(buckets: int) -> np.ndarray:
    return np.zeros((1 << max(0, buckets - 1).bit_length(), SLOTS), np.uint16)


def _shard(k2, shards: int):
    return k2 % shards  # of numpy and of Spark's pmod alike: never negative


# --- keys of lines


def _keys(texts: pa.Array):
    """(row, line number within the row, k1, k2) of the lines whose keys count, as numpy arrays; k1 and k2 are the first 128 bits of the key's SHA-256."""
    lines = pc.split_pattern(texts, "\n")
    sizes = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    key = pc.ascii_lower(pc.utf8_trim(lines.flatten(), _WHITE))
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(sizes.cumsum() - sizes, sizes)
    long = pc.greater_equal(pc.utf8_length(key), LEAST_POINTS)
    digest = hashlib.sha256
    some = [digest(k).digest()[:16] for k in key.filter(long).cast(pa.binary()).to_pylist()]
    both = np.frombuffer(b"".join(some), np.int64).reshape(-1, 2)
    long = long.to_numpy(zero_copy_only=False).astype(bool)
    return row[long], place[long], both[:, 0].copy(), both[:, 1].copy()


def _stretches(texts: pa.Array):
    """(first row, texts) in stretches of bounded size, at least a row."""
    for first, _, offsets in chunks(texts):
        yield first, texts.slice(first, len(offsets) - 1)


def _plain(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(id_key(id_column).alias("doc"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))


def references(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(k1, k2, doc): each row's distinct keys."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, texts in _stretches(batch.column(1)):
                row, _, k1, k2 = _keys(texts)
                one = np.unique(np.stack((row, k1, k2), 1), axis=0) if len(row) else np.zeros((0, 3), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(one[:, 1]), pa.array(one[:, 2]), pa.array(ids[first + one[:, 0]], pa.int64())], names=["k1", "k2", "doc"])

    return _plain(docs, id_column, text_column).mapInArrow(run, "k1 long, k2 long, doc long")


# --- the index


def empty_index(spark: SparkSession) -> LineIndex:
    none = lambda schema: spark.createDataFrame([], schema)
    return LineIndex(none("k1 long, k2 long, doc long"), none("k1 long, k2 long, docs long, latest long"), none("shard int, chain array<binary>"), 0)


def build(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> LineIndex:
    """The index of ``docs``. Each row is a document, also if ids repeat; null texts count as empty, a null id comes before all others."""
    held = table(references(docs, id_column, text_column))
    return _sharded(held, _counted(held))


def insert(index: LineIndex, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> LineIndex:
    """The index with ``docs`` too. Only the counts of their keys are taken anew, and only filters that gain keys change."""
    if not index.shards:
        return build(docs, id_column, text_column)
    new = table(references(docs, id_column, text_column))
    return _updated(index, index.references.unionByName(new), new.select("k1", "k2").distinct())


def delete(index: LineIndex, ids: DataFrame, id_column: str = "doc_id") -> LineIndex:
    """The index without all documents of the ``ids``, as if they had never been there."""
    gone = ids.select(id_key(id_column).alias("doc")).distinct()
    touched = index.references.join(gone, "doc", "left_semi").select("k1", "k2").distinct()
    return _updated(index, table(index.references.join(gone, "doc", "left_anti").select("k1", "k2", "doc")), touched)


def _counted(refs: DataFrame) -> DataFrame:
    """Reference counts, merged before they are exchanged: a line of a third of all documents is a row per task."""
    return table(refs.groupBy("k1", "k2").agg(F.count("*").alias("docs"), F.max("doc").alias("latest")).where(F.col("docs") >= LEAST_DOCS))


def _sharded(refs: DataFrame, repeated: DataFrame) -> LineIndex:
    shards = repeated.count() // SHARD_KEYS + 1

    def make(keys: pd.DataFrame) -> pd.DataFrame:
        new = CuckooFilter.planned(len(keys))
        new.insert(keys["k1"].to_numpy(np.int64))
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "chain": [new.packed()]})

    each = repeated.select(F.pmod("k2", F.lit(shards)).cast("int").alias("shard"), "k1")
    return LineIndex(refs, repeated, table(each.groupBy("shard").applyInPandas(make, "shard int, chain array<binary>")), shards)


def _updated(index: LineIndex, refs: DataFrame, touched: DataFrame) -> LineIndex:
    key = ["k1", "k2"]
    touched = table(touched)
    counted = _counted(refs.join(touched, key, "left_semi"))
    before = index.repeated.join(touched, key, "left_semi")
    up = counted.join(index.repeated, key, "left_anti").select(*key, F.lit(True).alias("comes"))
    down = before.join(counted, key, "left_anti").select(*key, F.lit(False).alias("comes"))
    changes = up.unionByName(down).select(F.pmod("k2", F.lit(index.shards)).cast("int").alias("shard"), "k1", "comes")

    def change(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        now = CuckooFilter(list(filters["chain"].iloc[0]) if len(filters) else None)
        k1, comes = keys["k1"].to_numpy(np.int64), keys["comes"].to_numpy(bool)
        now.delete(k1[~comes])
        now.insert(k1[comes])
        return pd.DataFrame({"shard": [(filters if len(filters) else keys)["shard"].iloc[0]], "chain": [now.packed()]})

    filters = index.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, "shard int, chain array<binary>")
    repeated = index.repeated.join(touched, key, "left_anti").unionByName(counted)
    return LineIndex(refs, table(repeated), table(filters), index.shards)


class _Sieve:
    """All shards' filters, looked up together: a key is ruled out unless a filter of its shard's chain may hold it."""

    def __init__(self, rows: list, shards: int):
        self.shards, depth = shards, max((len(r.chain) for r in rows), default=0)
        self.flat = np.frombuffer(b"".join(bytes(c) for r in rows for c in r.chain), np.uint16).reshape(-1, SLOTS)
        self.first, self.buckets = np.zeros((depth, shards), np.int64), np.zeros((depth, shards), np.int64)
        at = 0
        for r in rows:
            for n, c in enumerate(r.chain):
                self.first[n, r.shard], self.buckets[n, r.shard] = at, len(c) // (2 * SLOTS)
                at += len(c) // (2 * SLOTS)

    def holds(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        out = np.zeros(len(k1), bool)
        shard, marks = _shard(k2, self.shards), _marks(k1)
        for first, buckets in zip(self.first, self.buckets):
            some = np.flatnonzero(buckets[shard] > 0)
            s, m = shard[some], marks[some]
            a, b = _homes(k1[some], m, buckets[s])
            base = first[s]
            out[some] |= (self.flat[base + a.astype(np.int64)] == m[:, None]).any(1) | (self.flat[base + b.astype(np.int64)] == m[:, None]).any(1)
        return out


def drop_lines(docs: DataFrame, index: LineIndex, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines (before dropping), n_dropped, kept_text.

    Texts are split at line feeds; a null or empty text is one empty line. A line goes if its key (white space stripped
    at both ends, A-Z in lower case) has at least LEAST_POINTS code points and LEAST_DOCS documents of the index, and
    this document's id isn't the largest among theirs. All rows with the largest id keep it; a null id is smaller than
    all others. Other columns are ignored. An empty table gives no rows.

    The filters rule out most lines where they are read; only keys that pass meet the exact table, in a join that
    decides. Filters above MOST_FILTERS bytes aren't sent: then all keys meet the exact table. Numbers of the lines that
    go come back to the texts in a join by row: sent to all tasks while there are at most FEW, sorted beyond.
    """
    spark = docs.sparkSession
    rows = table(_plain(docs, id_column, text_column).withColumn("row", F.monotonically_increasing_id()))
    size = index.filters.select(F.sum(F.aggregate("chain", F.lit(0).cast("long"), lambda t, c: t + F.length(c)))).first()[0] or 0
    sieve = spark.sparkContext.broadcast(_Sieve(index.filters.collect(), index.shards)) if index.shards and size <= MOST_FILTERS else None

    def passed(batches):
        for batch in batches:
            ids, numbers = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for first, texts in _stretches(batch.column(1)):
                row, place, k1, k2 = _keys(texts)
                if sieve is not None:
                    some = sieve.value.holds(k1, k2)
                    row, place, k1, k2 = row[some], place[some], k1[some], k2[some]
                yield pa.RecordBatch.from_arrays([pa.array(numbers[first + row], pa.int64()), pa.array(ids[first + row], pa.int64()), pa.array(place.astype(np.int32)), pa.array(k1), pa.array(k2)], names=["row", "doc", "line", "k1", "k2"])

    found = rows.select("doc", "text", "row").mapInArrow(passed, "row long, doc long, line int, k1 long, k2 long")
    gone = found.join(index.repeated, ["k1", "k2"]).where("doc <> latest").select("row", "line")
    gone = table(gone.groupBy("row", splittable("row")).agg(F.collect_list("line").alias("gone")).drop("_one"))
    few = (gone.agg(F.sum(F.size("gone"))).first()[0] or 0) <= FEW

    def drop(batches):
        for batch in batches:
            texts, some = batch.column(1), batch.column(2)
            n = pc.add(pc.count_substring(texts, "\n"), 1)
            kept, dropped = [], []
            for text, lines in zip(texts.to_pylist(), some.to_pylist()):
                if lines:
                    out = set(lines)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out)
                kept.append(text)
                dropped.append(len(lines or ()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.cast(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_text"])

    joined = rows.join(F.broadcast(gone) if few else gone.hint("merge"), "row", "left").select("doc", "text", "gone")
    return joined.mapInArrow(drop, "doc_id long, n_lines long, n_dropped long, kept_text string").withColumn("doc_id", null_if_no_id(F.col("doc_id")))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """:func:`drop_lines` of ``docs`` by their own index, with kept_sha256 (lowercase hex of the kept text in UTF-8)."""
    return drop_lines(docs, build(docs, id_column, text_column), id_column, text_column).withColumn("kept_sha256", F.sha2("kept_text", 256))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(coalesce(doc_id, -9223372036854775808)) AS latest FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM (SELECT r, doc_id, line, place, latest IS NOT NULL AND coalesce(doc_id, -9223372036854775808) <> latest AS gone FROM k LEFT JOIN c USING (key))
GROUP BY r, doc_id
"""
