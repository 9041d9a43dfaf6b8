"""Operator 7, substring dedup: repeated paths of a sparse de Bruijn graph over words, compacted by joins."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.bytes_np import Words, chunks, mixed, runs_of
from emberline.llm.common import id_key, null_if_no_id, splittable, table

#: Words of a window; words of a k-mer; a window's k-mers, of which the one with the least hash stands for it.
WINDOW, K = 20, 6
CHOICES = WINDOW - K + 1


def _windows(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, anchor, kmers): the first word of each window, the first word of the k-mer that stands for it, all k-mers' hashes.

    The anchor is the leftmost k-mer with the least hash, so equal windows have equal anchors at equal distance.
    """
    kmers = runs_of(hashes, K)
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), kmers
    best, where = kmers[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, CHOICES):
        less = kmers[j : j + n] < best
        best[less] = kmers[j : j + n][less]
        where[less] = j
    inside = words.doc[:n] == words.doc[WINDOW - 1 :]
    start = np.flatnonzero(inside)
    return start, start + where[start], kmers


def _anchors(docs: DataFrame) -> DataFrame:
    """(h, row, nth, place, link): every anchor of every document, numbered from 0, with its k-mer's hash and first word.

    link is a 32-bit hash of all words from the anchor to the end of the document's next one.
    """

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in chunks(batch.column(1)):
                words = Words(data, offsets)
                hashes = words.hashes()
                _, anchor, kmers = _windows(words, hashes)
                at = anchor[np.flatnonzero(np.diff(anchor, prepend=-1))]
                doc = words.doc[at]
                ahead = np.append(at[1:], 0)
                same = np.append(doc[1:] == doc[:-1], False) if len(doc) else np.zeros(0, bool)
                link = _digests(hashes, at, np.where(same, ahead - at + K, 0)) if len(at) else np.zeros(0, np.uint64)
                count = np.bincount(doc, minlength=len(offsets) - 1)
                nth = np.arange(len(at)) - (count.cumsum() - count)[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kmers[at].view(np.int64)), pa.array(ids[row + doc]), pa.array(nth.astype(np.int32)), pa.array(words.place[at].astype(np.int32)), pa.array((mixed(link) >> np.uint64(32)).astype(np.uint32).view(np.int32))],
                    names=["h", "row", "nth", "place", "link"],
                )

    return docs.mapInArrow(run, "h long, row long, nth int, place int, link int")


def _paths(docs: DataFrame) -> DataFrame:
    """One row (row, anchors) per document with repeated k-mers: the places of its repeated anchors, in order, each with ``solid``.

    An edge leads from an anchor to the document's next one and names the words on the way. It is solid if it is the only way on from the one and the
    only way to the other, that is if edge, source and target occur equally often in the corpus. Paths of solid edges
    are the same in every document that holds any part of them.
    """
    counts = _anchors(docs).groupBy("h", splittable("h")).agg(F.count("*").alias("n")).where("n > 1").select("h", "n")
    repeated = table(_anchors(docs).join(counts, "h"))
    order = Window.partitionBy("row").orderBy("place")
    ahead = lambda c: F.lead(c).over(order)
    chained = table(
        repeated.select(
            "row",
            "place",
            F.when((ahead("nth") == F.col("nth") + 1) & (ahead("n") == F.col("n")), F.xxhash64("h", ahead("h"), ahead("place") - F.col("place"), "link")).alias("edge"),
            "n",
        )
    )
    edges = chained.where("edge is not null").groupBy("edge", "n", splittable("edge")).agg(F.count("*").alias("m")).where("m = n").select("edge")
    solid = chained.where("edge is not null").join(edges, "edge", "left_semi").select("row", F.col("place").alias("at"))
    return (
        chained.select("row", F.col("place").alias("at"), F.lit(False).alias("solid"))
        .unionByName(solid.withColumn("solid", F.lit(True)))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("at", "solid"))).alias("anchors"))
    )


def _spans(docs: DataFrame, paths: DataFrame) -> DataFrame:
    """(x, y, words, row, start): stretches of words that may be repeated, with a 64-bit and a 32-bit hash of their words.

    Those are each compacted path of at least a window, and each window that lies in no such path but whose anchor is repeated.
    """

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            bounds, flat = lists.offsets.to_numpy(), lists.values
            place, solid = flat.field("at").to_numpy(), flat.field("solid").to_numpy(zero_copy_only=False)
            for row, data, offsets in chunks(batch.column(1)):
                words = Words(data, offsets)
                hashes = words.hashes()
                second = runs_of(hashes ^ np.uint64(0x5851F42D4C957F2D), 1, 0x14057B7EF767814F)
                start, anchor, _ = _windows(words, hashes)
                repeated = np.zeros(len(hashes) + 1, bool)
                path_of = np.full(len(hashes) + 1, -1)
                begin, end = [], []
                for i in range(len(offsets) - 1):
                    lo, hi = bounds[row + i], bounds[row + i + 1]
                    p = place[lo:hi]
                    live = p < words.count[i]
                    at = np.unique(p[live])
                    if not len(at):
                        continue
                    follows = np.isin(at, p[live & solid[lo:hi]])
                    heads = np.flatnonzero(~np.concatenate(([False], follows[:-1])))
                    number = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(at)))) + len(begin)
                    at = at + words.first[i]
                    repeated[at] = True
                    path_of[at] = number
                    stops = np.append(heads[1:], len(at)) - 1
                    begin += at[heads].tolist()
                    end += np.minimum(at[stops] + K, words.first[i] + words.count[i]).tolist()
                begin, end = np.array(begin, np.int64), np.array(end, np.int64)
                mine = repeated[anchor]
                start, path = start[mine], path_of[anchor[mine]]
                lone = (start < begin[path]) | (start + WINDOW > end[path]) if len(start) else np.zeros(0, bool)
                long = np.flatnonzero(end - begin >= WINDOW)
                first = np.concatenate((begin[long], start[lone]))
                length = np.concatenate(((end - begin)[long], np.full(int(lone.sum()), WINDOW)))
                if not len(first):
                    continue
                x, y = _digests(hashes, first, length), _digests(second, first, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)), pa.array((mixed(y) >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(length.astype(np.int32)), pa.array(ids[row + words.doc[first]]), pa.array(words.place[first].astype(np.int32))],
                    names=["x", "y", "words", "row", "start"],
                )

    joined = docs.join(paths, "row").select("row", "text", "anchors")
    return joined.mapInArrow(run, "x long, y int, words int, row long, start int")


def _digests(hashes: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of words."""
    n, odd = len(hashes), 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        power, back = np.full(n + 1, odd, np.uint64), np.full(n + 1, pow(odd, -1, 2**64), np.uint64)
        power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(back, out=back)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * power[:n], out=sums[1:])
        return (sums[first + length] - sums[first]) * back[first]


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text, kept_sha256.

    A word is removed if a window of 20 consecutive words that covers it also starts earlier: in a document with a
    smaller id, or in the same document before. Windows are judged on the input. Null text has no words; a null id
    comes before every other. Rows with one id and different texts are documents of their own, in the order of their
    texts' hashes; rows that repeat id and text stand for one document: they aren't removed in favour of each other.

    1. Of each window's 6-word k-mers the one with the least hash is its anchor: about an eighth of all k-mers, and equal
       windows have equal anchors. Anchors that occur once rule their windows out.
    2. Repeated anchors are the nodes of a de Bruijn graph whose edges lead to a document's next anchor. Joins find the
       edges that neither branch nor merge; paths of such edges compact to one span per document.
    3. Spans, and the windows across their ends, are read from the text at their coordinates and compared by 96 bits of
       hashes of all their words. The earliest of equal spans stays, the words of the others go.

    No step gathers a k-mer's or a span's occurrences: counts and earliest places merge before they are shuffled, and
    joins on them have splittable sides.
    """
    plain = docs.select(id_key(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    if plain.groupBy("doc_id").count().where("count > 1").isEmpty():
        plain, order = plain.withColumn("row", F.col("doc_id")), ["row", "start"]
    else:  # ids don't tell rows apart
        plain, order = table(plain.withColumn("row", F.monotonically_increasing_id())), ["doc_id", "tie", "start"]
    spans = table(_spans(plain.select("row", "text"), _paths(plain.select("row", "text"))))
    if "tie" in order:
        spans = spans.join(plain.select("row", "doc_id", F.xxhash64("text").alias("tie")), "row")
    key = ["x", "y", "words"]
    here = F.struct(*order)
    first = spans.groupBy(*key, splittable("x")).agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1").select(*key, "first")
    gone = (
        spans.join(first, key)
        .where(here != F.col("first"))
        .select("row", "start", "words")
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "words")).alias("spans"))
    )

    def run(batches):
        for batch in batches:
            lists = batch.column(2).fill_null(pa.scalar([], batch.column(2).type))
            bounds, flat = lists.offsets.to_numpy(), lists.values
            start, length = (flat.field(c).to_numpy() for c in ("start", "words"))
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            n, removed, kept, digest = [], [], [], []
            for i, text in enumerate(texts):
                words = (text or b"").split()
                s, c = start[bounds[i] : bounds[i + 1]], length[bounds[i] : bounds[i + 1]]
                if len(s):
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, np.minimum(s, len(words)), 1)
                    np.add.at(depth, np.minimum(s + c, len(words)), -1)
                    stays = np.cumsum(depth[:-1]) == 0
                    left = [words[j] for j in np.flatnonzero(stays)]
                else:
                    left = words
                rest = b" ".join(left)
                n.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(rest)
                digest.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digest, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    out = plain.join(gone, "row", "left").select("doc_id", "text", "spans")
    done = out.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
    return done.withColumn("doc_id", null_if_no_id(F.col("doc_id")))


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, p, md5_number(array_to_string(w[p : p + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM t WHERE len(w) >= 20)),
dup AS (SELECT doc_id, p FROM win QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM dup),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS rest, count(*) AS n
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM t) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM t LEFT JOIN kept USING (doc_id)
"""
