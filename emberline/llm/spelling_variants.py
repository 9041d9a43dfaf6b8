"""Operator 12, spelling variant grouping: a self-join of the vocabulary's trie by active-node sets, partitioned by prefix."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.bytes_np import chunks
from emberline.llm.common import FEW, table

#: Words have so many code points and occurrences at least; a form is so many times as frequent as its variant.
LEAST_POINTS, LEAST_SEEN, TIMES = 7, 2, 10
#: One in so many runs of a document loses a code point.
DAMAGED = 31
#: Code points of a subtrie that stays whole, of those that are walked together, and words of a task's count.
SUBTRIE, TOGETHER, COUNTED = 1 << 18, 1 << 18, 1 << 17

_RUN = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % LEAST_POINTS)


def _damaged(run: str, of: int) -> str:
    """``run`` without the code point that its checksum names, or as it is. of: the checksum of what stands before it."""
    h = zlib.crc32(run.encode(), of)
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): the words of all texts with at least LEAST_POINTS code points and LEAST_SEEN occurrences.

    A run of letters is lower-cased (A-Z only) and may be damaged, as its document's id and itself decide; the result is
    the word. Null texts have none; a null id counts as an empty string there. Each task counts what it reads and passes
    its counts on whenever they hold COUNTED words, so a word that a third of all documents hold is a few rows.
    """

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, _, offsets in chunks(batch.column(1)):
                for doc, text in zip(ids[first:], batch.column(1).slice(first, len(offsets) - 1).cast(pa.binary()).to_pylist()):
                    of = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word, n in Counter(_RUN.findall((text or b"").lower().decode("utf-8", "replace"))).items():
                        word = _damaged(word, of)
                        if len(word) >= LEAST_POINTS:
                            held[word] += n
                    if len(held) >= COUNTED:
                        yield counts(held)
                        held = Counter()
        yield counts(held)

    def counts(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    each = docs.select(F.col(id_column).cast("string").alias("doc"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_SEEN)


def _key() -> Column:
    """What the words of a subtrie share: the code points before the window and, counted from the end, those after it."""
    after = F.greatest(F.col("m") - 1 - F.col("hi"), F.lit(0))
    return F.xxhash64("m", "lo", F.substring("word", F.lit(1), F.col("lo")), F.when(after > 0, F.right("word", after)).otherwise(F.lit("")))


def subtries(words: DataFrame) -> DataFrame:
    """(key, m, lo, hi, word, n): the words, dealt over subtries so that each near pair meets in exactly one.

    Let m be the length of the pair's shorter word and i the number of code points both begin with. Then both begin with
    the same i code points and end with the same m - 1 - i. A subtrie stands for a window lo <= i <= hi; all its words
    share the code points before the window and after it. At first, windows are a word's front and back half. A subtrie
    of more than SUBTRIE code points is parted into the two halves of its window, whose words share more, until the window is
    one place: there words differ in one or two code points, so their number is bounded by the alphabet.
    """
    m = F.explode(F.array_distinct(F.array(F.length("word"), F.greatest(F.length("word") - 1, F.lit(LEAST_POINTS)))))
    each = words.select("word", "n", m.alias("m"))
    half = F.floor(F.col("m") / 2).cast("int")
    window = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    open_ = each.withColumn("w", F.explode(F.array(window(F.lit(0), half - 1), window(half, F.col("m"))))).select("word", "n", "m", "w.lo", "w.hi").withColumn("key", _key())
    done = []
    while True:
        large = table(open_.groupBy("key").agg(F.sum(F.length("word")).alias("c"), F.max(F.col("hi") - F.col("lo")).alias("width")).where((F.col("c") > SUBTRIE) & (F.col("width") > 0)).select("key"))
        n = large.count()
        if not n:
            done.append(open_)
            break
        large = F.broadcast(large) if n <= FEW else large.hint("merge")
        done.append(open_.join(large, "key", "left_anti"))
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        parted = open_.join(large, "key", "left_semi").withColumn("w", F.explode(F.array(window(F.col("lo"), mid), window(mid + 1, F.col("hi"))))).where("w.lo <= w.hi")
        open_ = table(parted.select("word", "n", "m", "w.lo", "w.hi").withColumn("key", _key()))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("key", "m", "lo", "hi", "word", "n")


_LETTER = (1 << 21) - 1


def _children_met(a: np.ndarray, a_edges: np.ndarray, b: np.ndarray, b_edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pairs (a, b) of nodes: (which pair, child of a, child of b) for each code point that leads on from both."""
    first, last = np.searchsorted(a_edges, a << 21), np.searchsorted(a_edges, (a + 1) << 21)
    count = last - first
    pair = np.repeat(np.arange(len(a)), count)
    child = np.arange(len(pair)) - np.repeat(count.cumsum() - count, count) + first[pair]
    wanted = (b[pair] << 21) | (a_edges[child] & _LETTER)
    at = np.searchsorted(b_edges, wanted)
    at[at == len(b_edges)] = 0
    met = b_edges[at] == wanted if len(b_edges) else np.zeros(len(at), bool)
    return pair[met], child[met], at[met]


def _siblings(parent: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different children of one node; parent is sorted, within tells which children take part."""
    count = np.where(within, np.searchsorted(parent, parent, "right") - np.arange(len(parent)) - 1, 0)
    left = np.repeat(np.arange(len(parent)), count)
    return left, left + 1 + np.arange(len(left)) - np.repeat(count.cumsum() - count, count)


def trie_pairs(words: list[str], group: np.ndarray, m: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of words at distance one within each group, b not shorter: a has m code points, and what both begin with ends in [lo, hi].

    group, m, lo and hi are given per word. The groups' tries are walked down together, a level at a time. Beside the
    level's nodes stand the active pairs, nodes whose prefixes differ by one edit: ``same`` holds two nodes of this
    level, ``more`` one of the level above and one of this, which has a code point more. While the level lies in the
    window, a node's children start such pairs: two children are a replacement, a node and its child an insertion. Then
    the edit is spent and pairs go down along equal code points only, so an active set shrinks with every level. A
    pair whose insertion could stand later in a run of equal code points is dropped, as it starts there once more.
    """
    n = len(words)
    none = np.zeros(0, np.int64)
    size = np.fromiter(map(len, words), np.int64, n)
    start = size.cumsum() - size
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    _, root, node = np.unique(group, return_index=True, return_inverse=True)
    lo, hi = lo[root], hi[root]  # from here on of the level's nodes
    edges, parent, ends = none, none, np.full(len(root), -1)  # of the level: sorted (node above, code point), the former, the word that ends
    same, more, found = (none, none), (none, none), []
    alive, level = np.arange(n), 0
    while len(alive := alive[size[alive] > level]):
        below, child = np.unique((node[alive] << 21) | points[start[alive] + level], return_inverse=True)
        up = below >> 21
        ends_below = np.full(len(below), -1)
        last = size[alive] == level + 1
        ends_below[child[last]] = alive[last]
        within = ((lo <= level) & (level <= hi))[up]

        _, a, b = _children_met(same[0], below, same[1], below)
        c, d = _siblings(up, within)
        same = np.concatenate((a, c)), np.concatenate((b, d))

        pair, a, b = _children_met(more[0], edges, more[1], below)
        x, y = more[0][pair], more[1][pair]
        later = (parent[y] == x) & ((edges[y] & _LETTER) == (edges[a] & _LETTER)) if len(pair) else np.zeros(0, bool)
        here = np.flatnonzero(within)
        more = np.concatenate((a[~later], up[here])), np.concatenate((b[~later], here))

        for (a, b), first, length in ((same, ends_below, level + 1), (more, ends, level)):
            a, b = first[a], ends_below[b]
            hit = (a >= 0) & (b >= 0)
            a, b = a[hit], b[hit]
            hit = m[a] == length
            found.append((a[hit], b[hit]))
        lo, hi, edges, parent, ends = lo[up], hi[up], below, up, ends_below
        node[alive] = child
        level += 1
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (none, none)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): each pair of words at distance one once, with their numbers of occurrences. words: (word, n), each word once."""

    def join(keys, m, lo, hi, n, some):
        starts = np.ones(len(keys), bool)
        starts[1:] = np.any([c[1:] != c[:-1] for c in (keys, m, lo, hi)], axis=0)
        group = starts.cumsum() - 1
        more = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(more):
            return None
        some = [some[i] for i in more.tolist()]
        a, b = trie_pairs(some, group[more], m[more], lo[more], hi[more])
        word = pa.array(some, pa.string())
        return pa.RecordBatch.from_arrays([word.take(pa.array(a)), pa.array(n[more][a]), word.take(pa.array(b)), pa.array(n[more][b])], names=["a", "na", "b", "nb"])

    def run(batches):
        held: list[tuple] = []
        points = 0

        def work(parts):
            columns = [np.concatenate([p[i] for p in parts]) for i in range(5)]
            return join(*columns, [w for p in parts for w in p[5]])

        for batch in batches:
            one = [batch.column(i).to_numpy() for i in range(5)]
            some = batch.column(5).to_pylist()
            held.append((*one, some))
            points += sum(map(len, some))
            if points >= TOGETHER and len(some):
                # the last group may go on in the next batch
                last, key = len(some), one[0][-1]
                while last and one[0][last - 1] == key:
                    last -= 1
                if last:
                    rest = (*(c[last:] for c in one), some[last:])
                    held[-1] = (*(c[:last] for c in one), some[:last])
                    out = work(held)
                    held, points = [rest], sum(map(len, rest[5]))
                    if out is not None:
                        yield out
        if held:
            out = work(held)
            if out is not None:
                yield out

    dealt = subtries(words).repartition("key").sortWithinPartitions("key", "m", "lo", "hi")
    return dealt.select("key", "m", "lo", "hi", "n", "word").mapInArrow(run, "a string, na long, b string, nb long")


def variants(words: DataFrame) -> DataFrame:
    """One row per row of ``words`` (word, n; each word once): word, n, form, form_n, n_near, root.

    n_near counts the near words, those at distance one. form is the near word of largest n, the smallest in code-point
    order in a tie, if its n (form_n) is at least TIMES the word's own; root is where following forms ends, the word
    itself without one. As n grows by TIMES along forms, they end after few steps; roots are found by doubling.
    """
    words = table(words)
    pairs = near_pairs(words)
    each = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("on")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("on")))).alias("p")).select("p.*")
    best = F.min(F.struct((-F.col("on")).alias("order"), "other"))
    near = table(words.join(each.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")), "word"))
    is_form = F.col("best.order") <= -TIMES * F.col("n")
    near = near.select("word", "n_near", F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.order")).alias("form_n"))
    forms = table(near.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        next_ = table(forms.select("word", "root").join(forms.select(F.col("word").alias("root"), F.col("root").alias("further")), "root", "left"))
        forms = next_.select("word", F.coalesce("further", "root").alias("root"))
        if next_.where("further is not null").isEmpty():
            break
    joined = words.join(near, "word", "left").join(forms, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def group_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """:func:`variants` of the :func:`vocabulary` of ``docs``. Other columns are ignored; an empty table gives no rows."""
    return variants(vocabulary(docs, id_column, text_column))
