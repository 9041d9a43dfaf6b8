"""Operator 9, SimHash near-dedup with pigeonring filtering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import NO_ID, id_key, null_if_no_id, numbered, splittable, table, without_rows
from emberline.llm.components import connected_components

SHINGLE, SEED, BITS, MAX_BITS_APART = 4, 42, 64, 4
#: Widths of the ring's segments. With 5 segments and at most 4 differing bits, a chain of l segments may differ in floor(4 l / 5) bits.
SEGMENTS = (13, 13, 13, 13, 12)


def fingerprint(text: bytes | None) -> int:
    """The 64-bit fingerprint of a text in UTF-8, unsigned: bit j is 1 if set in more than half of the shingles' XXH64."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and the six white-space characters
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[: n - SHINGLE] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[SHINGLE - 1 :].tolist())), np.uint64, n - SHINGLE + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8)
        ones += np.unpackbits(part).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id (null as NO_ID) and fp (the fingerprint as a signed long), one row per row of ``docs``. Null text counts as empty."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())], names=["doc_id", "fp"])

    return docs.select(id_key(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, sum(SEGMENTS[:i])).bitwiseAND(F.lit((1 << SEGMENTS[i]) - 1))


def linked_pairs(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of representatives whose fingerprints differ in 1 to 4 bits. prints: one row (fp, rep) per distinct fingerprint.

    If all five segments together differ in at most 4 bits, then by the pigeonring principle some segment i starts a
    chain whose every prefix of l segments differs in at most 4 l / 5 bits: segment i is equal and segment i + 1 differs
    in at most one bit. Those two form the join key: the indexed side has one key per i, the probing side one per
    i and variant of segment i + 1. The longer prefixes of the chain are checked next, before the full distance.
    """
    n = len(SEGMENTS)
    index, probe = [], []
    for i in range(n):
        j = (i + 1) % n
        head = F.shiftleft(F.lit(i).cast("long"), 32).bitwiseOR(F.shiftleft(_segment(F.col("fp"), i), 16))
        index.append(head.bitwiseOR(_segment(F.col("fp"), j)))
        probe += [head.bitwiseOR(_segment(F.col("fp"), j).bitwiseXOR(F.lit(v).cast("long"))) for v in (0, *(1 << k for k in range(SEGMENTS[j])))]
    left = prints.select(F.col("fp").alias("fa"), F.col("rep").alias("a"), F.explode(F.array(*probe)).alias("key"))
    right = prints.select(F.col("fp").alias("fb"), F.col("rep").alias("b"), F.explode(F.array(*index)).alias("key_b"))
    apart = F.col("fa").bitwiseXOR(F.col("fb"))
    chain = F.lit(True)
    start = F.shiftright(F.col("key"), 32)
    for i in range(n):
        total, ok = F.lit(0), F.lit(True)
        for length in range(1, n + 1):
            total = total + F.bit_count(_segment(apart, (i + length - 1) % n))
            if length > 2:
                ok = ok & (total <= MAX_BITS_APART * length // n)
        chain = chain & ((start != i) | ok)
    return left.join(right, (F.col("key") == F.col("key_b")) & (F.col("fa") < F.col("fb"))).where(chain & (F.bit_count(apart) <= MAX_BITS_APART)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at 4 or fewer differing bits; component_id is the smallest doc_id reachable, itself included.
    Texts without words (null too) have fingerprint zero and link like any other. A text that isn't null but shorter
    than a shingle counts as one. Rows with a null id link like any other, but only ids name a component: its
    component_id is null if none of its rows has one. Distinct fingerprints are the nodes of the graph, so copies never
    form pairs.
    """
    prints = table(fingerprints(docs, id_column, text_column))
    nodes = table(prints.groupBy("fp").agg(F.min(F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))).alias("least")))
    parts = connected_components(linked_pairs(nodes.select("fp", F.col("fp").alias("rep"))))
    placed = table(nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    least = placed.groupBy("component", splittable("component")).agg(F.min("least").alias("component_id")).select("component", "component_id")
    labels = table(placed.join(least, "component").select("fp", "component_id"))
    return prints.join(labels, "fp").select(
        null_if_no_id(F.col("doc_id")).alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of near-duplicates the one with the smallest id, null last.

    Rows are told apart by numbers of their own, so null and repeated ids are judged by their texts like any other.
    """
    rows = numbered(docs)
    texts = rows.select("row", F.col("doc")[id_column].cast("long").alias("id"), F.col("doc")[text_column].alias("text"))
    parts = near_duplicates(texts, "row", "text").select(F.col("doc_id").alias("row"), "component_id")
    placed = table(texts.select("row", "id").join(parts, "row"))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    best = placed.groupBy("component_id", splittable("component_id")).agg(F.min(order).alias("best"), F.count("*").alias("n")).where("n > 1")
    gone = placed.join(best.select("component_id", F.col("best.row").alias("stays")), "component_id").where("row <> stays").select("row")
    return without_rows(rows, gone).select("doc.*")
