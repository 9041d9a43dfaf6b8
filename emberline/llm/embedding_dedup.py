"""Operator 10, embedding near-dedup by sorted projection passes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, FloatType

from emberline.llm.common import splittable, table
from emberline.llm.components import connected_components

#: Cosine of a link; neighbours in the sorted order that a vector is compared with at least; bits of a pass's signature.
LEAST, NEIGHBOURS, BITS = 0.9, 256, 64
#: Chance that two vectors at the least cosine of a link fall on the same side of a plane, and the share of such links that passes may leave out.
SAME_SIDE, MISSED = 1 - math.acos(LEAST) / math.pi, 0.04
#: Vectors that are compared with all others to measure what the passes found; more, up to so many bytes, until so many links are seen.
ASKED, ASKED_BYTES, ENOUGH = 256, 32 << 20, 200
#: The share of links that must be found with a confidence of 95 %, and after how many rounds of passes all vectors are compared with all instead.
FOUND, MOST_ROUNDS = 0.92, 8
#: Members of a component that a task compares with as many others, some at a time.
BLOCK, TOGETHER = 4096, 512
#: Stands for a null id: after every other.
LAST_ID = 2**63 - 1
_HALF = math.cos(math.acos(LEAST) / 2) + 1e-9


def passes_for(vectors: int) -> int:
    """How many passes find all but MISSED of the links at the least cosine: a pass finds one if the bits that cut evenly spread vectors to a window's size agree."""
    bits = max(1.0, math.log2(max(2, vectors) / NEIGHBOURS))
    return max(4, math.ceil(math.log(MISSED) / math.log(1 - SAME_SIDE**bits)))


def _planes(number: int, dim: int) -> np.ndarray:
    return np.random.default_rng([number, dim, 7]).standard_normal((BITS, dim))


def _scaled(m: np.ndarray) -> np.ndarray:
    """Rows as doubles of length 1."""
    m = m.astype(np.float64)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column, all of one length, as rows of length 1."""
    return _scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def _forest(ids: np.ndarray, near: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): as few links as join all ends of the links near[i, j] between ids[i] and others[j]; others begin with ids."""
    i, j = np.nonzero(near)
    root = np.arange(len(others))
    while len(i):
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        apart = low != high
        i, j = i[apart], j[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root != root[root]).any():
            root = root[root]
    linked = np.flatnonzero(root != np.arange(len(others)))
    return others[linked], others[root[linked]]


def _signed(vectors: DataFrame, turns: range) -> DataFrame:
    """(dim, turn, signature, rep, embedding): a row per vector and pass; the signature concatenates BITS random hashes."""
    kind = vectors.schema["embedding"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                unit = _matrix(part.column(2))
                for turn in turns:
                    side = (unit @ _planes(turn, int(dim)).T) > 0
                    signature = np.packbits(side, axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(1), pa.array(np.full(len(part), turn, np.int32)), pa.array(signature), part.column(0), part.column(2)],
                        names=["dim", "turn", "signature", "rep", "embedding"],
                    )

    return vectors.select("rep", "dim", "embedding").mapInArrow(run, f"dim int, turn int, signature long, rep long, embedding {kind}")


def _window_links(signed: DataFrame) -> DataFrame:
    """(a, b): verified links of vectors with at least the next NEIGHBOURS in sorted order, as few as join the same vectors.

    A task walks its part of the order in blocks of NEIGHBOURS rows, each compared with itself and the next one. It also
    passes on its first and last block, and neighbouring tasks' blocks are compared in a second step.
    """
    kind = signed.schema["embedding"].dataType
    names = ["a", "b", "border", "dim", "turn", "first", "rep", "embedding"]
    pairs = lambda a, b: [pa.array(a), pa.array(b), *(pa.nulls(len(a), t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), to_arrow_type(kind)))]

    def run(batches):
        task, key, ids, unit, edge = TaskContext.get().partitionId(), None, None, None, None

        def at_border(rows: pa.RecordBatch, first: bool) -> pa.RecordBatch:
            n = len(rows)
            none = pa.nulls(n, pa.int64())
            place = pa.array(np.full(n, task, np.int32))
            return pa.RecordBatch.from_arrays([none, none, place, rows.column(0), rows.column(1), pa.array([first] * n, pa.bool_()), rows.column(3), rows.column(4)], names=names)

        def compared(last: bool):
            nonlocal ids, unit
            while len(ids) >= 2 * NEIGHBOURS or (last and len(ids)):
                near = unit[:NEIGHBOURS] @ unit[: 2 * NEIGHBOURS].T >= LEAST
                yield pa.RecordBatch.from_arrays(pairs(*_forest(ids[:NEIGHBOURS], near, ids[: 2 * NEIGHBOURS])), names=names)
                ids, unit = ids[NEIGHBOURS:], unit[NEIGHBOURS:]

        begun = 0
        for batch in batches:
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)
            turns = np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1
            for lo, hi in zip([0, *turns], [*turns, len(batch)]):
                part = batch.slice(lo, hi - lo)
                if not len(part):
                    continue
                if key is None or (key != keys[lo]).any():
                    if key is not None:
                        yield from compared(True)
                        begun = NEIGHBOURS  # what follows doesn't continue the task before
                    key, ids, unit, edge = keys[lo], np.zeros(0, np.int64), np.zeros((0, keys[lo][0])), None
                if begun < NEIGHBOURS:
                    yield at_border(part.slice(0, NEIGHBOURS - begun), True)
                    begun += len(part)
                tail = pa.Table.from_batches([*([edge] if edge is not None else []), part])
                edge = tail.slice(max(0, len(tail) - NEIGHBOURS)).combine_chunks().to_batches()[0]
                ids, unit = np.concatenate((ids, part.column(3).to_numpy())), np.concatenate((unit, _matrix(part.column(4))))
                yield from compared(False)
        if key is not None:
            yield from compared(True)
            yield at_border(edge, False)

    order = ["dim", "turn", "signature", "rep"]
    schema = f"a long, b long, border int, dim int, turn int, first boolean, rep long, embedding {kind.simpleString()}"
    out = table(signed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        before, after = pdf[~pdf["first"]], pdf[pdf["first"]]
        if not len(before) or not len(after):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        unit = [_scaled(np.stack(x["embedding"].to_numpy())) for x in (before, after)]
        ids = np.concatenate((before["rep"], after["rep"]))
        near = np.concatenate((np.zeros((len(before), len(before)), bool), unit[0] @ unit[1].T >= LEAST), axis=1)
        return pd.DataFrame(dict(zip("ab", _forest(ids[: len(before)], near, ids))))

    edges = out.where("border is not null")
    tasks = sorted(r.border for r in edges.select("border").distinct().collect())  # a task without rows isn't among them
    number = out.sparkSession.createDataFrame(list(zip(tasks, range(len(tasks)))), "border int, n int")
    edges = edges.join(F.broadcast(number), "border").withColumn("border", F.col("n") - F.col("first").cast("int"))
    borders = edges.groupBy("border", "dim", "turn").applyInPandas(across, "a long, b long")  # 2 * NEIGHBOURS rows each
    return out.where("a is not null").select("a", "b").unionByName(borders).distinct()


def _asked_links(reps: DataFrame, asked: int) -> DataFrame:
    """(a, b): all links of ``asked`` vectors, drawn by a hash, with any vector b, by comparing them with all."""
    some = reps.orderBy(F.xxhash64("rep"), "rep").limit(asked).select("rep", "dim", "embedding").toPandas()
    queries = {int(d): (g["rep"].to_numpy(), np.stack(g["embedding"].to_numpy())) for d, g in some.groupby("dim")}
    shared = reps.sparkSession.sparkContext.broadcast(queries)  # ASKED vectors, or ASKED_BYTES

    def run(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim, (ids, embeddings) in shared.value.items():
                part = batch.filter(pa.array(dims == dim))
                for at in range(0, len(part), BLOCK):
                    rows = part.slice(at, BLOCK)
                    unit, own = _matrix(rows.column(2)), rows.column(0).to_numpy()
                    for q in range(0, len(ids), BLOCK):
                        i, j = np.nonzero(unit @ _scaled(embeddings[q : q + BLOCK]).T >= LEAST)
                        b, a = own[i], ids[q + j]
                        yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])

    return reps.select("rep", "dim", "embedding").mapInArrow(run, "a long, b long")


def _sample(reps: DataFrame, vectors: int) -> tuple[DataFrame, bool]:
    """(links of a sample with all vectors, whether it holds all vectors): ASKED vectors, more while these show less than ENOUGH links."""
    widest = (reps.agg(F.max("dim")).first()[0] or 1) * 8
    most, asked = min(vectors, max(ASKED, ASKED_BYTES // widest)), min(ASKED, vectors)
    links = _asked_links(reps, asked)
    while asked < most and links.count() < ENOUGH:
        asked = min(most, 16 * asked)
        links = table(_asked_links(reps, asked))  # few: the smaller sample showed less than ENOUGH
    return links, asked >= vectors


def lower_bound(n: int, of: int) -> float:
    """Of a share n / of: what it exceeds with a confidence of 95 % (Wilson); 0 without cases."""
    if not of:
        return 0.0
    z, p = 1.645, n / of
    return (p + z * z / (2 * of) - z * math.sqrt(p * (1 - p) / of + z * z / (4 * of * of))) / (1 + z * z / of)


def _enough(sample: DataFrame, parts: DataFrame) -> bool:
    """Whether the passes brought the ends of enough of the sample's links into one component; of fewer than ENOUGH links, all."""
    links = sample
    for end in "ab":
        links = links.join(parts.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left")
    row = links.agg(F.count("*").alias("of"), F.count(F.when(F.col("ca") == F.col("cb"), 1)).alias("n")).first()
    return row.n == row.of if row.of < ENOUGH else lower_bound(row.n, row.of) >= FOUND


def all_links(reps: DataFrame, vectors: int) -> DataFrame:
    """(a, b): as few links as join all linked vectors, by comparing each block of BLOCK vectors with each: exact, and quadratic."""
    blocks = max(1, -(-vectors // BLOCK))
    own = F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int")
    each = reps.select("rep", "dim", "embedding", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    each = each.select("rep", "dim", "embedding", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = pdf[pdf["own"] == pdf["x"]], pdf[pdf["own"] == pdf["y"]]
        if not len(one) or not len(two):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        both = pd.concat((one, two)) if pdf["x"].iloc[0] != pdf["y"].iloc[0] else one
        ids, unit = both["rep"].to_numpy(), _scaled(np.stack(both["embedding"].to_numpy()))
        out = []
        for at in range(0, len(one), TOGETHER):
            turn = np.concatenate((np.arange(at, min(at + TOGETHER, len(one))), np.arange(0, at), np.arange(min(at + TOGETHER, len(one)), len(ids))))
            here = ids[turn]
            n = min(at + TOGETHER, len(one)) - at
            out.append(_forest(here[:n], unit[turn[:n]] @ unit[turn].T >= LEAST, here))
        return pd.DataFrame({"a": np.concatenate([o[0] for o in out]), "b": np.concatenate([o[1] for o in out])})

    return each.groupBy("dim", "x", "y").applyInPandas(compare, "a long, b long").distinct()


def _outer_links(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(rep, links): for pairs within a component of which at least one lies outside its core, how many vectors link with rep.

    Members lie in blocks of about BLOCK, members outside the core in blocks of their own besides; a task compares one
    block of either kind. Thus a component's members are copied once per block of outer members only.
    """
    count = lambda c: F.greatest(F.ceil(F.col(c) / BLOCK), F.lit(1)).cast("int")
    drawn = lambda seed, n: F.pmod(F.xxhash64("rep", F.lit(seed)), n).cast("int")
    placed = members.join(sizes.where("outer > 0"), "component_id")
    columns = ["component_id", "x", "y", "rep", "copies", "core", "embedding", "asks"]
    left = placed.where("not core").withColumns({"x": drawn(1, count("outer")), "y": F.explode(F.sequence(F.lit(0), count("size") - 1)), "asks": F.lit(True)}).select(columns)
    right = placed.withColumns({"y": drawn(2, count("size")), "x": F.explode(F.sequence(F.lit(0), count("outer") - 1)), "asks": F.lit(False)}).select(columns)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        if not len(a) or not len(b):
            return pd.DataFrame({"rep": [], "links": []}).astype("int64")
        one, two = (_scaled(np.stack(x["embedding"].to_numpy())) for x in (a, b))
        ids, core, copies = b["rep"].to_numpy(), b["core"].to_numpy(), b["copies"].to_numpy()
        links, back = np.zeros(len(a), np.int64), np.zeros(int(core.sum()), np.int64)
        for at in range(0, len(a), TOGETHER):
            some = slice(at, at + TOGETHER)
            near = (one[some] @ two.T >= LEAST) & (a["rep"].to_numpy()[some, None] != ids[None, :])
            links[some] = near @ copies
            back += a["copies"].to_numpy()[some] @ near[:, core]
        return pd.DataFrame({"rep": np.concatenate((a["rep"], ids[core])), "links": np.concatenate((links, back))})

    pairs = left.unionByName(right).groupBy("component_id", "x", "y").applyInPandas(compare, "rep long, links long")
    return pairs.groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors link at a cosine of at least 0.9 in double precision. Null, empty or zero vectors and such with null or
    non-finite components link with nothing, nor do vectors of different lengths. Rows with equal vectors (also those
    that repeat an id) are one node; each counts the others as links. A null id comes last as component_id.

    A pass sorts all vectors by a signature of random hashes (range partitioning) and compares each with its next
    neighbours; vectors that differ little share long prefixes in some pass. Links of all passes are united to
    components. The number of passes follows from the number of vectors if they are spread evenly; where many crowd
    together, a window holds less of a prefix. So what was found is measured: ASKED vectors, or more until they show ENOUGH
    links, are compared with all, and as many passes again are added until, with a confidence of 95 %, FOUND of their links
    lie within components. If MOST_ROUNDS don't reach that, all vectors are compared with all in blocks. A table so small that the
    sample holds all its vectors is thereby exact; in a larger one that shows fewer than ENOUGH links, all of these must be found.
    Then links are counted within components, exactly, whatever the windows saw: members within half the
    link's angle of the centre link with each other for certain; all others are compared in blocks. A window thus bounds
    the search but not a vector's links, and large groups never form pairs.
    """
    kind = vectors.schema[vector_column].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    values = F.col(vector_column).cast("array<float>" if single else "array<double>")  # floats are shuffled as such; all sums are of doubles
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = vectors.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LAST_ID)).alias("vec_id"), values.alias("v"))
    rows = rows.withColumn("good", F.coalesce(~bad & (norm > 0) & (norm < float("inf")), F.lit(False)))
    rows = table(rows.select("vec_id", "good", F.when(F.col("good"), F.transform("v", lambda x: x + F.lit(0.0).cast("float" if single else "double"))).alias("v"), F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g")))
    key = ["h", "g"]
    reps = table(
        rows.where("good").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("embedding")).withColumn("dim", F.size("embedding"))
    )
    vectors = reps.count()
    passes = passes_for(vectors)
    sample, whole = _sample(reps, vectors)
    done, links = 0, None
    while True:
        if done >= MOST_ROUNDS * passes:
            links = all_links(reps, vectors)
        else:
            new = _window_links(_signed(reps, range(done, done + passes)))
            links = new if links is None else links.unionByName(new)
        if whole:  # then the sample's links are all there are
            links = links.unionByName(sample)
        links = table(links.distinct())
        parts = table(connected_components(links))
        if done >= MOST_ROUNDS * passes or whole or _enough(sample, parts):
            break
        done += passes
    members = reps.join(parts.select(F.col("node").alias("rep"), F.col("component").alias("component_id")), "rep")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    spread = members.select("component_id", "copies", F.posexplode(F.transform("embedding", lambda x: x.cast("double") / length)))
    centre = (
        spread.groupBy("component_id", "pos").agg(F.sum(F.col("col") * F.col("copies")).alias("c")).groupBy("component_id", splittable("component_id"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "c"))), lambda s: s["c"]).alias("centre"))
    )
    dot = F.aggregate(F.zip_with("embedding", "centre", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    size = F.sqrt(F.aggregate("centre", F.lit(0.0), lambda a, x: a + x * x))
    members = table(members.join(centre, "component_id").withColumn("core", F.coalesce(dot >= length * size * _HALF, F.lit(False))).select("component_id", "rep", "copies", "embedding", "core"))
    inside = F.when(F.col("core"), F.col("copies")).otherwise(0)
    sizes = table(members.groupBy("component_id").agg(F.count("*").alias("size"), F.sum(inside).alias("core_copies"), F.sum((~F.col("core")).cast("long")).alias("outer")))
    found = (
        members.join(sizes, "component_id").join(_outer_links(members, sizes), "rep", "left")
        .select("rep", "component_id", (F.when(F.col("core"), F.col("core_copies") - F.col("copies")).otherwise(0) + F.coalesce("links", F.lit(0))).alias("others"))
    )
    labels = table(reps.select(*key, "rep", "copies").join(found, "rep", "left"))
    ident, component = F.col("vec_id"), F.coalesce("component_id", "rep", "vec_id")
    return rows.join(labels.withColumn("good", F.lit(True)), [*key, "good"], "left").select(
        F.when(ident != LAST_ID, ident).alias("vec_id"),
        F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.when(component != LAST_ID, component).alias("component_id"),
        (ident == component).alias("kept"),
    )


ORACLE = r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_dot_product(e, e) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, r) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a),
part AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = part.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM part
"""
