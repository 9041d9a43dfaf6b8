"""Operator 2, mixing sources to target weights by blocks of words."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.common import WORD, numbered, running_totals, table

#: Words in a block at most, and blocks that a source is cut into at least if it has the words; weights that sources take in turn;
#: how often a source may be repeated at most.
BLOCK, BLOCKS, WEIGHTS, MOST = 512, 1 << 16, (1, 2, 3), 3
#: Slots of an output shard at least, and output shards at most; sources that a shard's first draw tells apart.
SHARD, SHARDS, TOLD_APART = 1024, 4096, 1024
SEED = 20_240_229
#: Slots that one row expands to, so that no task makes all slots of a large source.
CHUNK = 4096


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over unsigned numbers, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Element i: where the pseudorandom permutation of 0..n[i]-1 named key[i] sends index[i].

    A four-round Feistel network over the next even number of bits; values beyond n walk on along their cycle.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(float))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    x, n, key = index.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        a, b = x[todo] >> half[todo], x[todo] & mask[todo]
        for turn in range(4):
            a, b = b, a ^ (_mixed(b + _mixed(key[todo] * np.uint64(4) + np.uint64(turn + SEED))) & mask[todo])
        x[todo] = (a << half[todo]) | b
        todo[todo] = x[todo] >= n[todo]
    return x.astype(np.int64)


def _targets(sources: DataFrame) -> DataFrame:
    """Adds target: the share by weight, at most MOST times the source's size; what is above goes to the others by weight.

    Each round raises the level by what full sources leave; it needs two sums over the sources, whatever their number.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        full = F.col("source_size") * MOST < F.col("weight") * level
        row = sources.agg(F.sum(F.when(full, F.col("source_size") * MOST)), F.sum(F.when(~full, F.col("weight")))).first()
        after = (total - (row[0] or 0)) / row[1]
        if after <= level:
            break
        level = after
    return sources.withColumn("target", F.least((F.col("source_size") * MOST).cast("double"), F.col("weight") * F.lit(level)))


def draws(sources: DataFrame) -> DataFrame:
    """(source_rank, shard, count): how many slots of each output shard a source gets, drawn from a multinomial distribution.

    sources: source_rank, slots (its target in slots, a fraction). Shards are equally large; all draw independently with
    the sources' shares of the slots. A shard first draws for up to TOLD_APART groups of neighbouring sources (whose
    shares every task knows), then for the sources within a group, which gives the same distribution.
    """
    spark = sources.sparkSession
    row = sources.agg(F.count("*"), F.sum("slots")).first()
    number, slots = row[0], round(row[1] or 0)
    grouped = sources.withColumn("group", F.floor(F.col("source_rank") * min(number, TOLD_APART) / max(1, number)).cast("int"))
    groups = grouped.groupBy("group").agg(F.sum("slots").alias("slots")).orderBy("group").toPandas()  # TOLD_APART rows at most
    members = grouped.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("source_rank", "slots"))).alias("members"))
    shards = max(1, min(SHARDS, slots // SHARD))
    names, share = groups["group"].to_numpy(np.int32), groups["slots"].to_numpy(float)

    def first(frames):
        for f in frames:
            for shard in f["id"]:
                size = slots * (shard + 1) // shards - slots * shard // shards
                count = np.random.default_rng([SEED, 0, shard]).multinomial(size, share / share.sum()) if slots else np.zeros(len(names), int)
                yield pd.DataFrame({"group": names, "shard": shard, "count": count})[count > 0]

    def second(frames):
        for f in frames:
            out = []
            for group, shard, count, inside in zip(f["group"], f["shard"], f["count"], f["members"]):
                p = np.array([m["slots"] for m in inside])
                got = np.random.default_rng([SEED, group + 1, shard]).multinomial(count, p / p.sum()) if len(p) > 1 else [count]
                out += [(m["source_rank"], shard, c) for m, c in zip(inside, got) if c]
            yield pd.DataFrame(out, columns=["source_rank", "shard", "count"]).astype("int64")

    drawn = spark.range(0, shards, 1, -(-shards // 64)).mapInPandas(first, "group int, shard long, count long")
    return drawn.join(members.hint("merge"), "group").mapInPandas(second, "source_rank long, shard long, count long")


def _slots(sources: DataFrame) -> DataFrame:
    """One row per slot of the mix: source_rank, block (its number), take (its words), pass, shard.

    The slots that the shards drew for a source are numbered through, shard by shard. Slot i of a pass over the source
    is block permuted(i); the short last block stays last. Slots beyond MOST passes, which a source at its limit may
    draw by chance, stay empty.
    """

    def spread(frames):
        for f in frames:
            per = f["count"].to_numpy(np.int64)
            row = np.repeat(np.arange(len(f)), per)
            i = np.arange(per.sum()) - np.repeat(per.cumsum() - per, per) + f["first"].to_numpy(np.int64)[row]
            size, rank, length, shard = (f[c].to_numpy(np.int64)[row] for c in ("source_size", "source_rank", "length", "shard"))
            turn, at = np.divmod(i, -(-size // length))
            whole = size // length
            inner = at < whole
            block = at.copy()
            block[inner] = permuted(at[inner], whole[inner], rank[inner] * 8 + turn[inner])
            out = pd.DataFrame({"source_rank": rank, "block": block, "take": np.minimum(length, size - block * length), "pass": turn, "shard": shard})
            yield out[turn < MOST]

    mine = Window.partitionBy("source_rank").orderBy("shard")  # SHARDS rows at most
    some = draws(sources.where("slots > 0").select("source_rank", "slots")).withColumn("first", F.sum("count").over(mine) - F.col("count"))
    some = some.join(sources.select("source_rank", "source_size", "length").hint("merge"), "source_rank")
    end = F.col("first") + F.col("count")
    chunks = some.withColumn("at", F.explode(F.sequence("first", end - 1, F.lit(CHUNK).cast("long")))).select(
        "source_rank", "source_size", "length", "shard", F.col("at").alias("first"), F.least(end - F.col("at"), F.lit(CHUNK).cast("long")).alias("count")
    )
    return chunks.repartition("source_rank", "first").mapInPandas(spread, "source_rank long, block long, take long, pass long, shard long")


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", carried: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of the mix of all ``docs`` to weights 1, 2, 3 repeating over the sources in code-point order, null last.

    documents: row_index, doc_id, size, source_size, target. pieces: row_index, doc_id, first, words, pass, shard: the
    mix takes ``words`` words of the document from word ``first`` on; passes over a source are numbered from 0. Both have
    the columns ``carried`` of ``docs`` besides.

    All of a source's documents, in the order of their ids, form one run of words that is cut into blocks of a fixed
    length: BLOCK words, or fewer in a source that has less than BLOCK * BLOCKS. Output shards draw how many blocks of
    each source they take (see :func:`draws`); their slots are mapped to blocks by pseudorandom permutations and joined
    with them by (source, block). The mix is about as long as the corpus. A source's words come near its target: the
    draw's deviation is about the square root of its slots. No document is used more than MOST times, and reruns agree.
    Null text has no words, null ids come first within their source, rows that repeat an id count each; without any
    words all targets are zero. Tables that compress well look small enough to broadcast but aren't: joins of tables
    that grow are told to sort and merge.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).isNull().alias("no_source"),
        F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("src"),
        F.regexp_count(F.coalesce(F.col(text_column).cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text_column).alias("tie"),
        *carried,
    )
    rows = running_totals(rows, ["no_source", "src", "doc_id", "tie"], "size").drop("tie")
    sizes = rows.groupBy("no_source", "src").agg(F.sum("size").alias("source_size"))
    sources = running_totals(sizes, ["no_source", "src"], "source_size").withColumnsRenamed({"before": "source_start", "row_index": "source_rank"})
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("source_rank") % len(WEIGHTS) + 1).cast("int")).cast("long"))
    length = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.col("source_size") / BLOCKS))).cast("long")
    sources = table(_targets(sources).withColumn("length", length).withColumn("slots", F.col("target") / F.col("length")))
    documents = table(
        rows.join(sources.hint("merge"), ["no_source", "src"]).select(
            "row_index", "doc_id", "size", "source_size", "target", "source_rank", "length", (F.col("before") - F.col("source_start")).alias("at"), *carried
        )
    )
    block_of = lambda c: F.floor(c / F.col("length")).cast("long")
    spans = documents.where("size > 0").withColumn("block", F.explode(F.sequence(block_of(F.col("at")), block_of(F.col("at") + F.col("size") - 1))))
    begin = F.col("block") * F.col("length")
    start, end = F.greatest("at", begin), F.least(F.col("at") + F.col("size"), begin + F.col("take"))
    pieces = (
        spans.join(_slots(sources).hint("merge"), ["source_rank", "block"])
        .select("row_index", "doc_id", (start - F.col("at")).alias("first"), (end - start).alias("words"), "pass", "shard", *carried)
        .where("words > 0")
    )
    return documents.drop("length"), pieces


def taken_words(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken (words that the mix takes, repeats counted)."""
    documents, pieces = mix(docs)
    taken = pieces.groupBy("row_index").agg(F.sum("words").alias("taken"))
    return documents.join(taken.hint("merge"), "row_index", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame, shard_column: str | None = None) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per document and pass that takes words of it.

    A pass that takes all words of a document keeps its text; any other text consists of the taken words, joined by one
    space. Documents are found by numbers of their rows, so null and repeated ids are mixed like any other. n_chars,
    where there is one, is counted anew. With ``shard_column`` there is a row per output shard, too, and its number.
    """
    rows = numbered(docs)
    _, pieces = mix(rows.select("row", *(F.col("doc")[c].alias(c) for c in ("doc_id", "text", "source"))), carried=("row",))
    keys = ["row", "pass", *(["shard"] if shard_column else [])]
    per_pass = pieces.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first", "words"))).alias("spans")).drop("pass")
    words = F.regexp_extract_all(F.coalesce(F.col("doc.text"), F.lit("")), F.lit(WORD), F.lit(0))
    some = F.array_join(F.flatten(F.transform("spans", lambda s: F.slice(F.col("words"), (s["first"] + 1).cast("int"), s["words"].cast("int")))), " ")
    count = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["words"])
    out = rows.join(per_pass, "row").withColumn("words", words)
    out = out.withColumn("text", F.when(count >= F.size("words"), F.col("doc.text")).otherwise(some))
    renewed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*(renewed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns), *([F.col("shard").alias(shard_column)] if shard_column else []))
