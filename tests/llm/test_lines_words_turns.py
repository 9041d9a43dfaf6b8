"""Line dedup, spelling variants and conversation repair against brute force, over ordinary and awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.llm import conversation_repair, line_dedup, queries, spelling_variants

WHITE = " \t\n\x0b\x0c\r"
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()

# --- lines

DOCS = "doc_id long, text string, k1 string, k2 long, row string, line int, doc string, gone int, latest string, n string, word string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "c", 1, "c", 2, "c", 3, "c", "c", "c") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(5)
    common = [f"this line number {i} is shared by some documents" for i in range(12)]
    own = lambda: " ".join(rng.choice(("alpha", "beta", "gamma", "delta")) + str(rng.randrange(10**6)) for _ in range(5))
    rows = []
    for i in range(60):
        parts = [own() for _ in range(3)]
        for c in rng.sample(common, rng.randrange(5)):
            parts.insert(rng.randrange(4), rng.choice(("", "  ", "\t")) + rng.choice((c, c.upper(), c.title())) + rng.choice(("", "\r", " ")))
        rows.append((i * 3, "\n".join(parts)))
    rows += [(1000 + i, common[0] + "\n" + "ÀÉ wholly äöü line of twenty and more\n" + common[0]) for i in range(3)]
    rows += [(None, common[0]), (None, None), (2000, None), (2001, ""), (2002, "\n\n"), (2003, "x" * 19), (2004, "x" * 19), (2005, "x" * 19), (2006, "\n".join([own() for _ in range(5000)] + common))]
    rows += [(i, "ß" * 20 + " \x0b") for i in (2010, 2011)] + [(2012, "ß" * 20)]
    return rows + [(2020, "one line that repeats in a row of its own")] * 3 + [(1001, common[1])]


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WHITE))


def by_hand(rows, index=None):
    """Rows (doc_id, n_lines, n_dropped, hash of what stays) by the lines of ``index``, else of the rows themselves."""
    low = -(2**63)
    held = defaultdict(list)
    for i, t in rows if index is None else index:
        for k in {key_of(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                held[k].append(low if i is None else i)
    out = []
    for i, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if not (len(held[key_of(x)]) >= 3 and max(held[key_of(x)]) != (low if i is None else i))]
        out.append((i, len(all_), len(all_) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def as_rows(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, sha(r.kept_text)) for r in df.collect()), key=str)


def test_lines(spark, lines):
    docs = docs_of(spark, lines).repartition(5)
    want = by_hand(lines)
    assert sum(w[2] for w in want) > 100
    assert as_rows(line_dedup.deduplicate(docs)) == want
    assert line_dedup.deduplicate(docs.where("false")).count() == 0


def test_lines_come_and_go(spark, lines, monkeypatch):
    """After insertions and deletions an index decides as one that was built from what is left, also without filters."""
    docs = docs_of(spark, lines)
    early, late = lines[:30], lines[30:]
    index = line_dedup.insert(line_dedup.build(docs_of(spark, early)), docs_of(spark, late))
    assert as_rows(line_dedup.drop_lines(docs, index)) == by_hand(lines)
    gone = [i for i, _ in late]
    index = line_dedup.delete(index, spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    left = [r for r in early if r[0] not in gone]
    assert as_rows(line_dedup.drop_lines(docs, index)) == by_hand(lines, left)
    held = {(r.k1, r.k2) for r in index.repeated.collect()}
    assert held == {(r.k1, r.k2) for r in line_dedup.build(docs_of(spark, left)).repeated.collect()}
    index = line_dedup.insert(index, docs_of(spark, late))
    monkeypatch.setattr(line_dedup, "MOST_FILTERS", -1)
    assert left + late == lines and as_rows(line_dedup.drop_lines(docs, index)) == by_hand(lines)
    empty = line_dedup.insert(line_dedup.empty_index(spark), docs)
    assert as_rows(line_dedup.drop_lines(docs, empty)) == by_hand(lines)


def test_cuckoo_filter():
    rng = np.random.default_rng(2)
    keys = rng.integers(-(2**63), 2**63 - 1, 6000)
    new = line_dedup.CuckooFilter.planned(1000)  # too small: the chain grows
    new.insert(keys[:5000])
    assert len(new.chain) > 1 and new.holds(keys[:5000]).all() and new.holds(keys[5000:]).mean() < 0.01
    again = line_dedup.CuckooFilter(new.packed())
    again.delete(keys[:2500])
    assert again.holds(keys[2500:5000]).all() and again.holds(keys[:2500]).mean() < 0.01
    again.delete(keys[2500:5000])
    assert not any(c.any() for c in again.chain)
    same = line_dedup.CuckooFilter.planned(10)
    same.insert(np.array([7] * 40))
    same.delete(np.array([7] * 39))
    assert same.holds(np.array([7])).all()
    same.delete(np.array([7]))
    assert not same.holds(np.array([7])).any()


def test_lines_by_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = queries.op11_line_dedup(spark, sf_dir).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(queries.ORACLE["op11_line_dedup"]).fetchall())


# --- words


def words_by_hand(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def variants_by_hand(n):
    cut = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            cut[w[:i] + w[i + 1 :], i].add(w)  # replaced at i
    near = {w: set() for w in n}
    for some in cut.values():
        for w in some:
            near[w] |= some - {w}
    for w in n:
        for i in range(len(w)):
            x = w[:i] + w[i + 1 :]
            if x in n:
                near[w].add(x)
                near[x].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("subtrie", [spelling_variants.SUBTRIE, 40])
def test_variants(spark, monkeypatch, subtrie):
    """Also with subtries of a few words, so that windows are halved until they are one place."""
    monkeypatch.setattr(spelling_variants, "SUBTRIE", subtrie)
    monkeypatch.setattr(spelling_variants, "TOGETHER", 2000)
    rng = random.Random(9)
    n = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 9))): rng.choice((2, 3, 25, 400, 5000, 60000)) for _ in range(900)}
    n |= {"prefixe" + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 4))): rng.choice((2, 40)) for _ in range(120)}
    n |= {"a" * k: 10**k for k in range(7, 12)} | {"l" * 3000: 5, "l" * 3001: 50, "l" * 1500 + "k" + "l" * 1500: 500}
    got = spelling_variants.variants(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)).collect()
    assert sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got), key=str) == variants_by_hand(n)


def test_words(spark, lines, sf_dir):
    rng = random.Random(3)
    stems = ["analysis", "Bibliothèque", "überzeugend", "straßenbahn", "naïveté", "information", "ÀÉÎÕÜßÿ", "x×y÷zabc"]
    rows = [(i, " ".join(rng.choice(stems) + rng.choice(("", "s", ",", "-", "1", "’s")) for _ in range(200))) for i in range(40)]
    rows += lines + [(None, "information " * 30), (5, None), (6, ""), (7, "ab" * 20_000 + " information"), (8, "ab" * 20_000)]
    got = spelling_variants.group_variants(docs_of(spark, rows).repartition(4)).collect()
    want = words_by_hand(rows)
    assert {r.word: r.n for r in got} == want
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(40).collect()
    got = spelling_variants.group_variants(spark.createDataFrame(some)).collect()
    assert sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got), key=str) == variants_by_hand(words_by_hand(some))
    assert spelling_variants.group_variants(docs_of(spark, []).where("false")).count() == 0


# --- turns


def damaged_by_hand(rows):
    out = defaultdict(list)
    none = lambda x: " " if x is None else x
    order = lambda r: (r[1] is not None, r[1] or 0, none(r[2]), none(r[3]))
    for conv, turn, role, text in sorted(rows, key=order):
        k = zlib.crc32(f"{none(conv)}:{none(turn)}".encode()) % 20
        role, text = none(role), none(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out[conv] += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        out.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired turns) by a plain program over rows and the role written last, forwards; audits carried whole."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    now = {"": (0, "", ())}

    def inserted(now):
        for _ in range(4):
            for state, (cost, audit, turns) in list(now.items()):
                new = step[state]
                one = (cost + 5, audit + "I", (*turns, ({"u": "user", "a": "assistant"}[new], "")))
                if new not in now or one[:2] < now[new][:2]:
                    now[new] = one
        return now

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, turns) in inserted(now).items():
            options = [(state, 2, "D", ())]
            if fault not in ("b", "d"):
                due = 5 if fault == "t" else 0
                if role[:1] == step[state] or (state == "" and role[:1] == "s"):
                    options.append((role[:1], due, "K", ((role, text),)))
                else:
                    options.append((step[state], due + 1, "R", (({"u": "user", "a": "assistant"}[step[state]], text),)))
                if state == "" and role[:1] == "s":
                    options.append(("u", due + 1, "R", (("user", text),)))
            for new, price, letter, more in options:
                one = (cost + price, audit + letter, (*turns, *more))
                if new not in after or one[:2] < after[new][:2]:
                    after[new] = one
        now = after
    return min((v for k, v in inserted(now).items() if k in ("", "a")), key=lambda v: v[:2])


def turns_by_hand(rows):
    held = damaged_by_hand(rows)
    out = []
    for conv in {r[0] for r in rows}:
        some = held[conv]
        faults = faults_of(some)
        cost, audit, turns = cheapest(some, faults)
        numbers = [t for t, _, _ in some if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(some))
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in turns))))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, row_index string, before string, kind string, copy string, first string"


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(11)
    texts = ["Hello there.", "How are you?", "no end", "", "  ", "Fine!\n", "same text.", "sum. ", None, "é…", "\x0b"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "sys"]
    rows = []
    for c in range(250):
        tidy = rng.random() < 0.4
        for t in range(rng.randrange(1, 12)):
            role = (["user", "assistant"][t % 2] if tidy else rng.choice(roles)) if rng.random() < 0.9 else rng.choice(roles)
            text = rng.choice(texts) if rng.random() < 0.5 else f"turn {t} of {c}" + rng.choice((".", "!", "", "?"))
            rows.append((c, rng.choice((t, t, t, 2 * t, None, t - 1)), role, text))
    rows += [(None, t, "user", f"x{t}.") for t in range(4)] + [(900, None, None, None), (901, None, None, None), (901, None, None, None), (902, 5, "user", "long. " * 50_000)]
    return rows + [(903, t, rng.choice(roles[:3]), f"t{t % 700}" + rng.choice((".", ""))) for t in range(2500)]


def as_turns(df):
    return sorted((tuple(r[c] for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()), key=str)


@pytest.mark.parametrize("segment", [conversation_repair.SEGMENT_ROWS, 3])
def test_turns(spark, monkeypatch, turns, segment):
    """Also with segments of three rows, so that most conversations are put together from several."""
    monkeypatch.setattr(conversation_repair, "SEGMENT_ROWS", segment)
    df = spark.createDataFrame([(*r, *["c"] * 5) for r in turns], TURNS).repartition(5)
    want = turns_by_hand(turns)
    assert as_turns(conversation_repair.repair(df)) == want
    lists = defaultdict(list)
    for r in conversation_repair.repaired_turns(df).orderBy("conv_id", "place").collect():
        assert r.place == len(lists[r.conv_id])
        lists[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(sha("\n".join(lists[w[0]])) == w[-1] for w in want)
    assert conversation_repair.repair(df.where("false")).count() == 0


def test_turns_of_the_tables(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_turns(queries.op13_conversation_repair(spark, sf_dir)) == turns_by_hand(rows)


def test_words_of_the_tables(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_spelling_variants(spark, sf_dir).collect()
    assert sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got), key=str) == variants_by_hand(words_by_hand(rows))
