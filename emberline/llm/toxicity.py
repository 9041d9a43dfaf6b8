"""Operator 6, toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import drop_table, id_key, null_if_no_id, table

#: Lengths of n-grams in characters of the lower-cased text.
GRAMS = (3, 4, 5)
#: Labelled rows of each class that the classifier is fitted on at most; n-grams share 2 ** BUCKETS features by their hash.
SAMPLE, BUCKETS = 3000, 20
#: Tasks that fit the model at most, and features that a task holds at a time (64 MB).
PARTS, TOGETHER = 4, 1 << 24
#: Numbers of a row that carries part of an array (256 kB).
SLICE = 1 << 16
#: Rounds of fitting, and each block's steps in a round.
ROUNDS, STEPS = 6, 40
HELD_OUT_OF = 5
#: Characters of a text that are looked at together; a longer text is read in such parts.
PART = 1 << 16


def _parts(text: str) -> Iterator[np.ndarray]:
    """Features of all n-grams of a text, with a space before and after, in parts of PART characters that overlap by one less than an n-gram."""
    code = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(code), PART):
        some = code[at : at + PART + GRAMS[-1] - 1].astype(np.uint64)
        found, h = [], np.zeros(len(some), np.uint64)
        for k in range(1, GRAMS[-1] + 1):
            n = len(some) - k + 1
            if n <= 0:
                break
            h = h[:n] * np.uint64(0x100000001B3) + some[k - 1 :] + np.uint64(1)
            if k in GRAMS:
                found.append(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS)).astype(np.int32)[:PART])
        if found:
            yield np.concatenate(found)


class _Distinct:
    """Tells each text's features apart without sorting: a table says which text saw a feature last, another where a part saw it last."""

    def __init__(self):
        self.seen, self.last, self.text = np.zeros(1 << BUCKETS, np.int32), np.zeros(1 << BUCKETS, np.int32), 0

    def features(self, text: str) -> Iterator[np.ndarray]:
        """The text's features, each once over all parts."""
        self.text += 1
        for all_here in _parts(text):
            place = np.arange(len(all_here), dtype=np.int32)
            self.last[all_here] = place
            here = all_here[self.last[all_here] == place]
            new = here[self.seen[here] != self.text]
            self.seen[new] = self.text
            yield new


class Model:
    """score(text) = 1 / (1 + exp(-(bias + sum of the weights of the features that occur in it)))."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, float(bias)

    def scores(self, column: pa.Array) -> np.ndarray:
        """One score per text; null counts as empty, and an empty text still holds the two spaces around it."""
        distinct = _Distinct()
        z = np.fromiter((sum(float(self.weights[f].sum()) for f in distinct.features(t.as_py() or "")) for t in column), np.float64, len(column))
        return 1 / (1 + np.exp(-np.clip(z + self.bias, -30, 30)))


def _examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, text) of at most SAMPLE labelled ids of each class, drawn by a hash of the id, never from the held-out fifth.

    A row per id: of several texts of an id the one with the least hash counts, so that the sample is bounded in rows too.
    """
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .where(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % HELD_OUT_OF != 0)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("toxic") >= 1).cast("int")).alias("toxic"))
    )
    drawn = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for c in (0, 1)]
    sample = drawn[0].unionByName(drawn[1])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(sample), "doc_id")  # 2 * SAMPLE rows
    return rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")).select("doc_id", "toxic", "least.text")


def _vectors(examples: DataFrame) -> DataFrame:
    """(toxic, features): a written row per example with its distinct features as 32-bit integers, in PARTS files."""

    def run(batches):
        distinct = _Distinct()
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):  # a text at a time, as features take more room than texts
                held = b"".join(f.tobytes() for f in distinct.features(text.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([toxic], pa.int32()), pa.array([held], pa.binary())], names=["toxic", "features"])

    placed = examples.repartition(PARTS, "doc_id").sortWithinPartitions("doc_id")
    return table(placed.select("toxic", "text").mapInArrow(run, "toxic int, features binary"))


def _blocks(batches: Iterator[pa.RecordBatch], together: int) -> Iterator[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Consecutive rows of (toxic, features) with up to ``together`` features, or one row, as a list of (toxic, features, row of each feature)."""
    made, size = [], 0
    for batch in batches:
        y, column = batch.column(0).to_numpy(), batch.column(1).cast(pa.binary())
        n = len(column)
        if not n:
            continue
        ends = np.frombuffer(column.buffers()[1], np.int32, n + 1, column.offset * 4) // 4
        held = np.frombuffer(column.buffers()[2], np.int32, ends[-1]) if ends[-1] else np.zeros(0, np.int32)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + together // 8, "right")) - 1)
            here = int(ends[to] - ends[at])
            if made and size + here > together:
                yield made
                made, size = [], 0
            made.append((y[at:to].copy(), held[ends[at] : ends[to]].copy(), np.repeat(np.arange(to - at, dtype=np.int32), np.diff(ends[at : to + 1]))))
            at, size = to, size + here
    if made:
        yield made


def _summed(vectors: DataFrame, add: Callable[[np.ndarray, list], None], rows: int, tasks: int) -> np.ndarray:
    """The sum of what ``add(total, block)`` adds to (rows, 2 ** BUCKETS + 1) zeros over all blocks of ``vectors``, in 32-bit floats.

    Tasks stream their share, a block of at most TOGETHER features at a time, and cut their arrays into slices of SLICE
    numbers, which executors add. The driver takes one array's slices, a partition at a time: no row it holds is large.
    """
    width, together, slice_ = (1 << BUCKETS) + 1, TOGETHER, SLICE

    def run(batches):
        total = np.zeros((rows, width))
        for block in _blocks(batches, together):
            add(total, block)
        flat, task = total.astype(np.float32).ravel(), TaskContext.get().partitionId()
        for at in range(0, len(flat), slice_):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([task], pa.int32()), pa.array([flat[at : at + slice_].tobytes()], pa.binary())], names=["at", "task", "part"])

    def one(batches):
        at, total = None, None
        for batch in batches:
            for start, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if start != at and at is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["at", "part"])
                total, at = np.frombuffer(part, np.float32).astype(np.float64) + (total if start == at else 0), start
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["at", "part"])

    parts = vectors.coalesce(tasks).mapInArrow(run, "at int, task int, part binary")
    if tasks > 1:
        parts = parts.repartition(tasks, "at").sortWithinPartitions("at", "task").mapInArrow(one, "at int, part binary")
    sums = np.zeros(rows * width, np.float32)
    for r in parts.select("at", "part").toLocalIterator():
        sums[r.at : r.at + len(r.part) // 4] = np.frombuffer(r.part, np.float32)
    return sums.reshape(rows, width)


def _counts(total: np.ndarray, block: list) -> None:
    """Adds to total[c] the rows of class c that hold each feature, and the rows of that class in the last place."""
    for toxic, features, row in block:
        for c in (0, 1):
            total[c, :-1] += np.bincount(features[toxic[row] == c], minlength=1 << BUCKETS)
            total[c, -1] += (toxic == c).sum()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits the model on a bounded sample of the labelled rows (SAMPLE ids of each class at most, a row each).

    Every character n-gram of the sample counts; n-grams are told apart by 2 ** BUCKETS hashes. A feature's ratio is
    r = log((p / |p|) / (q / |q|)) with p and q one more than the number of toxic and other documents that hold it. The
    documents become vectors of r where the feature occurs, and a logistic regression with an L2 penalty is fitted to
    them. Features are found, written and counted by the executors, which also fit: in each of ROUNDS a block of vectors
    takes STEPS from the shared weights, and the blocks' weights are averaged by their rows. The driver gets one array
    of 2 ** BUCKETS numbers a round, in slices, however long the texts are. Null texts count as empty, labels without an
    id or a value don't count, and an id with several labels is toxic if one of them says so. Without examples of both
    classes the model gives every text the larger class.
    """
    vectors = _vectors(_examples(docs, labels))
    held = _summed(vectors, _counts, 2, PARTS)
    (clean, toxic), held = held[:, -1], held[:, :-1]
    if not clean or not toxic:
        model = Model(np.zeros(1 << BUCKETS, np.float32), 30.0 * np.sign(toxic - clean))
    else:
        both = held.sum(0)
        r = np.log((held[1] + 1) / (toxic + 2)) - np.log((held[0] + 1) / (clean + 2))
        r[both == 0] = 0
        x = r / np.sqrt(max(1e-9, (both * r * r).sum() / (clean + toxic)))  # lengths have a mean square of 1
        model = _regression(vectors, x.astype(np.float32), (clean, toxic), min(PARTS, 1 + int(both.sum()) // TOGETHER))
    drop_table(vectors)
    return model


def _regression(vectors: DataFrame, x: np.ndarray, sizes: tuple[float, float], tasks: int, penalty: float = 3e-4, step: float = 3.0) -> Model:
    """The logistic regression on vectors that hold x[f] for each of their features f; classes weigh alike. A round is one pass over ``vectors``."""
    sc = vectors.sparkSession.sparkContext
    n, each = sum(sizes), np.array([0.5 / sizes[0], 0.5 / sizes[1]])
    scale = sc.broadcast(x)  # 2 ** BUCKETS numbers, as are the weights below
    w, b = np.zeros(len(x), np.float32), 0.0
    for _ in range(ROUNDS):
        shared = sc.broadcast((w, b))

        def local(total, block, shared=shared):
            x, share = scale.value, sum(len(toxic) for toxic, _, _ in block) / n
            w, b = shared.value[0].astype(np.float64), shared.value[1]
            ahead, b_ahead, t = w, b, 1.0
            for _ in range(STEPS):  # accelerated gradient
                v, g, slope = ahead * x, np.zeros(len(x)), 0.0
                for toxic, features, row in block:
                    z = np.bincount(row, v[features], len(toxic)) + b_ahead
                    error = each[toxic] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic) / share
                    g += np.bincount(features, error[row], len(x))
                    slope += error.sum()
                w_next, b_next = ahead - step * (g * x + penalty * ahead), b_ahead - step * slope
                t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
                ahead, b_ahead = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
                w, b, t = w_next, b_next, t_next
            total[0, :-1] += share * w
            total[0, -1] += share * b

        mean = _summed(vectors, local, 1, tasks)[0]
        shared.destroy()
        w, b = mean[:-1].astype(np.float32), float(mean[-1])
    scale.destroy()
    return Model(w * x, b)


def scorer(docs: DataFrame, model: Model) -> Column:
    """A function of a text column that gives its score; only that column goes to Python. The model is 2 ** BUCKETS numbers."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = Model(*shared.value)
        for some in texts:
            yield pa.array(held.scores(some))

    return score


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, one row per row of ``docs``. Whole texts count; null and empty texts are scored alike, null ids aren't held out."""
    ident = null_if_no_id(F.col("doc_id"))
    scored = docs.select(id_key(id_column).alias("doc_id"), scorer(docs, model)(F.col(text_column).cast("string")).alias("score"))
    return scored.select(
        ident.alias("doc_id"),
        F.coalesce(F.crc32(ident.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't find toxic, with all their columns.

    Each row is judged by its text alone, so rows that repeat an id or a text and rows with a null id are judged each;
    null texts count as empty. Empty tables give empty ones.
    """
    return docs.where(scorer(docs, fit(docs, labels))(F.col("text").cast("string")) < 0.5)
