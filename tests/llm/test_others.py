"""Vectors, pages, components, the pipeline."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from emberline.llm import components, embedding_dedup, html_extract, simhash_dedup
from emberline.llm.common import running_totals


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 330)] + [(400, i) for i in range(401, 440)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    df = spark.createDataFrame([*edges, (None, 3), (7, 7)], "a long, b long")
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    assert {r.node: r.component for r in components.connected_components(df).collect()} == want
    assert components.connected_components(df.where("false")).count() == 0


def test_running_totals(spark):
    df = spark.createDataFrame([(i * 37 % 101, i % 7) for i in range(101)], "k long, v long").repartition(5)
    got = running_totals(df, ["k"], "v").orderBy("k").collect()
    total = 0
    for n, r in enumerate(got):
        assert (r.row_index, r.before) == (n, total)
        total += r.v


def test_embeddings(spark):
    rng = np.random.default_rng(8)
    near = lambda v, s: (v + rng.normal(0, s, len(v))).astype(np.float32)
    rows = []
    for c in range(12):
        centre = rng.normal(size=32)
        rows += [near(centre, 0.1 + 0.05 * (c % 3)) for _ in range(25)]
    rows += [rows[0]] * 3 + [rng.normal(size=32).astype(np.float32) for _ in range(100)]
    ids = list(range(len(rows)))
    data = [(i, [float(x) for x in v], 1) for i, v in zip(ids, rows)]
    odd = [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] + [1.0] * 31, 1), (903, [None] + [1.0] * 31, 1), (904, [1.0, 2.0], 1), (905, [], 1), (None, data[0][1], 1)]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert len(got) == len(data) + len(odd)
    x = np.stack(rows + [rows[0]]).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    n = link.sum(1)
    found = np.array([got[i].n_links for i in ids] + [got[None].n_links])
    assert (found <= n).all() and found.sum() >= 0.9 * n.sum()
    for i in range(900, 906):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    parts = components_of(link)
    same = [got[i].component_id == parts[i] and got[i].kept == (parts[i] == i) for i in ids]
    assert np.mean(same) >= 0.98 and all(got[i].component_id <= i for i in ids)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def components_of(link):
    label = np.arange(len(link))
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(link)).min(1))
        if (new == label).all():
            return label
        label = new


def test_embeddings_by_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = con.execute(embedding_dedup.ORACLE).fetchall()
    got = embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def pairs_at(rng, n, dim, cosine, base=None):
    """n pairs of vectors at a cosine, as rows."""
    a = rng.normal(size=(n, dim)) if base is None else base
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(n, dim))
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    return np.stack((a, cosine * a + np.sqrt(1 - cosine**2) * b), 1).reshape(2 * n, dim)


def test_recall_at_the_least_cosine(spark, tmp_path):
    """Isolated pairs just above the limit among 80,000 vectors, and pairs within a crowd that is dense but unlinked."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(4)
    cone = rng.normal(size=48) / np.sqrt(48) + 0.55 * rng.normal(size=(4000, 48)) / np.sqrt(48)
    x = np.concatenate((pairs_at(rng, 3000, 48, 0.905), pairs_at(rng, 4000, 48, 0.93, cone), rng.normal(size=(66_000, 48))))
    place = rng.permutation(len(x))
    ids = np.empty(len(x), np.int64)
    ids[place] = np.arange(len(x))
    flat = pa.array(x[place].ravel().astype(np.float32))
    pq.write_table(pa.table({"vec_id": pa.array(np.arange(len(x))), "embedding": pa.FixedSizeListArray.from_arrays(flat, 48).cast(pa.list_(pa.float32()))}), tmp_path / "e.parquet")
    got = embedding_dedup.near_duplicates(spark.read.parquet(str(tmp_path / "e.parquet")).repartition(5)).toPandas().set_index("vec_id").sort_index()
    part, links = got["component_id"].to_numpy(), got["n_links"].to_numpy()
    for lo, hi in ((0, 6000), (6000, 14_000)):
        a, b = ids[lo:hi:2], ids[lo + 1 : hi : 2]
        assert (part[a] == part[b]).mean() >= 0.9
    assert links[ids[14_000:]].sum() == 0


def test_passes_grow_slowly():
    assert embedding_dedup.passes_for(0) >= 1 and embedding_dedup.passes_for(10**9) < 100


def cone(n, links, dim=48, seed=6):
    """n vectors that crowd in a cone without links, and planted pairs at cosine 0.91; with the links that are there."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim) / np.sqrt(dim)
    x = centre + 0.75 * rng.normal(size=(n, dim)) / np.sqrt(dim)
    x[: 2 * links] = pairs_at(rng, links, dim, 0.91, x[:links].copy())
    x = x.astype(np.float32).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    a, b = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
    return x, a, b


@pytest.mark.parametrize(("n", "links", "asked_bytes"), [(6000, 400, 0), (6000, 20, 0), (3000, 0, 0), (4000, 40, 32 << 20)])
def test_recall_in_a_cone(spark, monkeypatch, n, links, asked_bytes):
    """Recall where a crowd hides few links: measured on enough of them, and exact where the sample holds all vectors."""
    monkeypatch.setattr(embedding_dedup, "ASKED_BYTES", asked_bytes or 48 * 8 * 2000)
    x, a, b = cone(n, links)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)
    part = embedding_dedup.near_duplicates(df).toPandas().set_index("vec_id").sort_index()["component_id"].to_numpy()
    share = (part[a] == part[b]).mean() if len(a) else 1.0
    assert share == 1 if asked_bytes else share >= 0.9
    assert len(a) or (part == np.arange(n)).all()


def test_all_against_all(spark, monkeypatch):
    """The exact way finds each link, whatever passes see; also with blocks of a few vectors."""
    x, a, b = cone(900, 60)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(embedding_dedup, "MOST_ROUNDS", 0)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 200)
    monkeypatch.setattr(embedding_dedup, "TOGETHER", 64)
    part = embedding_dedup.near_duplicates(df).toPandas().set_index("vec_id").sort_index()["component_id"].to_numpy()
    assert len(a) >= 60 and (part[a] == part[b]).all()
    assert embedding_dedup.lower_bound(200, 200) > 0.98 and embedding_dedup.lower_bound(190, 200) > 0.91 and embedding_dedup.lower_bound(0, 0) == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><header>Site name</header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; more</h1><p><b>First
 line<br>goes on<p>Second&nbsp;para</p><form><label>Mail</label></form><div class="share">Share this</div><ul><li>one<li>two</ul><section id="comments"><p>Nice!</p></section></article>
<aside>Other</aside><footer>&copy; us</footer><!-- <p>no</p> --></body></html>"""


def test_pages(spark):
    plain = "<html><body><div class='menu'>a</div><div><p>Only text here</p><p>and more</p></div></body></html>"
    odd = [(3, None, None), (4, "u", ""), (5, "u", "no markup & all"), (6, "u", "<p>" * 3000 + "deep"), (7, "u", "<<p>> <a href='x"), (None, "http://h/z", plain)]
    # the banner is on every page of a host but in no element that gives it away
    host = [(10 + i, f"http://h.example/{i}", f"<html><body><section class='q7'><span>Buy now and save</span></section><section class='z'><p>Text {i} of this page</p></section></body></html>") for i in range(8)]
    df = spark.createDataFrame([(1, "http://x/1", PAGE), (2, "http://x/2", plain), *odd, *host], "page_id long, url string, html string").withColumn("key", F.lit(1))
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert got[1].text == "Head & more\nFirst line goes on\nSecond para\none\ntwo" and got[1].n_chars == len(got[1].text)
    assert got[2].text == "Only text here\nand more" == got[None].text
    assert (got[3].text, got[4].text, got[5].text, got[6].text) == ("", "", "no markup & all", "deep")
    assert [got[10 + i].text for i in range(8)] == [f"Text {i} of this page" for i in range(8)]
    assert html_extract.extract(df.where("false")).count() == 0


def test_copied_pages(spark):
    frame = "<html><body><section class='q7'><span>Buy now and save</span></section><article id='post-{0}'><p>Text {0} of this page</p><table><tr><td>Cell {0}</table></article></body></html>"
    rows = [(i, f"http://one.example/{i}", frame.format(i)) for i in range(10)]
    rows += [(100 + i, f"http://one.example/{'x' if i % 2 else i + 100}", frame.format(17)) for i in range(7)]  # copies are a third of the host's rows
    rows += [(200 + i, f"http://two.example/{i}", frame.format(3)) for i in range(6)]  # nothing but copies
    rows += [(300 + i, f"http://three.example/{i // 2}", frame.format(i // 2)) for i in range(16)]  # each page twice
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    text = lambda n: f"Text {n} of this page\nCell {n}"
    assert [got[i] for i in range(10)] == [text(i) for i in range(10)]
    assert [got[100 + i] for i in range(7)] == [text(17)] * 7
    assert [got[200 + i] for i in range(6)] == [text(3)] * 6
    assert [got[300 + i] for i in range(16)] == [text(i // 2) for i in range(16)]


def extracted(spark, rows):
    return {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}


def test_equal_articles_stay(spark):
    """Pages that differ in a notice only are copies, however many there are; so are two articles on a page main text both."""
    page = "<html><body><div class='ad'>Offer {0}</div>{1}</body></html>"
    article, plain = "<article><h1>Same</h1><p>Equal words.</p></article>", "<div><p>Same</p><p>Equal words.</p></div>"
    rows = [(100 * k + i, f"http://{h}{k}.example/{i}", page.format(i, body)) for h, body in (("a", article), ("b", plain)) for k in range(1 + (h == "b") * 8, 8 + (h == "b") * 8) for i in range(k % 8)]
    assert set(extracted(spark, rows).values()) == {"Same\nEqual words."}
    two = "<article><p>Part one is the longer one.</p></article><p>between</p><article><p>Part two.</p><p><a href='/x'>See this long and interesting page.</a></p></article>"
    assert extracted(spark, [(1, "http://h/1", two)]) == {1: "Part one is the longer one.\nPart two.\nSee this long and interesting page."}


def test_wrappers_keep_the_article():
    text = lambda page: "\n".join(b[0] for b in html_extract.candidates(html_extract.blocks(page)[0]))
    for around in ("class='content-sidebar-wrap'", "class='site-content has-sidebar'", "id='search-content'"):
        assert text(f"<body><div {around}><main><p>Words</p></main><div class='sidebar'>No</div></div></body>") == "Words"
    assert text("<body><div id='search-content'><p>All the text</p></div></body>") == "All the text"
    assert text("<body><form><article><p>In a form</p><div class='comments'><article>No</article></div></article></form></body>") == "In a form"
    assert text("<article><svg width='1'/><p>After</p><svg><text>No</text></svg><p>1 < 2 &amp; <b>3</b></p></article>") == "After\n1 < 2 & 3"


def test_articles_lose_no_text(spark):
    """Short pages, teasers, class words, shared headings and formulas."""
    short = "<html><body><div class='x1'>Read this every day on our site</div><section class='z'><p>Hi {0}</p></section></body></html>"
    rows = [(i, f"http://short.example/{i}", short.format(i)) for i in range(8)]
    body = "<html><body><nav>Menu</nav><article><h1>Title {0}</h1><h2 class='s'>Summary</h2><p>Words of {0}.</p><div class='tools'>Print this page</div><section id='discussion'><h2>Discussion</h2><p class='related'>Related work.</p></section></article></body></html>"
    rows += [(100 + i, f"http://shared.example/{i}", body.format(i)) for i in range(8)]
    teaser = "<body><div id='content'><p>The main text is here and long enough.</p></div><article class='card'>Teaser</article></body>"
    rows += [(200, "http://t/1", teaser), (201, "http://u/1", teaser.replace(" class='card'", "")), (202, "http://v/1", "<body><article class='card'>Nothing else</article></body>")]
    rows += [(203, "http://w/1", "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be a number.</p><p>Name <label>L</label> here <object>shown</object></p></article>")]
    rows += [(204, "http://m/1", "<main><div class='sidebar'>No</div><h1>Yes</h1><p>And more</p><article class='teaser'><p>Other</p></article></main><p>outside</p>")]
    got = extracted(spark, rows)
    assert [got[i] for i in range(8)] == [f"Hi {i}" for i in range(8)]
    assert [got[100 + i] for i in range(8)] == [f"Title {i}\nSummary\nWords of {i}.\nDiscussion\nRelated work." for i in range(8)]
    main = "The main text is here and long enough."
    assert (got[200], got[201], got[202]) == (main, main + "\nTeaser", "Nothing else")
    assert got[203] == "Let x=2 be a number.\nName here shown" and got[204] == "Yes\nAnd more"


def test_sites_with_known_text(spark):
    """Sites with random templates around and random parts within articles: no text is lost, none kept wrongly."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    words = lambda n: " ".join(word() for _ in range(n))
    rows, want = [], {}
    for site in range(12):
        kinds = rng.sample(["nav", "aside", "footer", "header", "form", "div class='ad'", "div class='sidebar'", "div role='banner'", "section class='newsletter'", "div class='cookie-notice'"], 5)
        frame = [f"<{k}><p>{words(6)} &copy;</p><script>var x = '<p>{word()}</p>';</script></{k.split()[0]}>" for k in kinds]
        plain = [f"<div class='k{k}'><span>{words(3)}</span></div>" for k in range(2)]  # given away by the template only
        shared, marks = words(8), site % 3
        for page in range(6):
            parts, text = [], []
            for _ in range(rng.randint(2, 9)):
                some = words(rng.randint(1, 12))
                form = rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<ul><li>{}</ul>", "<p><b>{}</b></p>", "<table><tr><td>{}</table>", "<blockquote>{}</blockquote>", "<p>\n {} <br></p>", "<div>{}</div>"])
                parts.append(form.format(some.replace(" ", rng.choice((" ", "\n", "&nbsp;", " <i></i>")))))
                text.append(some)
            if marks == 0:  # every article of the site repeats a passage
                parts.append(f"<p>{shared}</p>")
                text.append(shared)
            if rng.random() < 0.5:
                parts.append(f"<div class='comments'><p>{words(4)}</p></div>" if rng.random() < 0.5 else f"<aside>{words(3)}</aside>")
            body = "".join(parts)
            body = (f"<article>{body}</article>", f"<main>{body}</main>", f"<div id='b'>{body}</div>")[marks]
            rows.append((len(rows), f"https://site{site}.example/{page}", f"<html><head><title>{words(3)}</title></head><body>{''.join(frame[:3])}{plain[0]}{body}{plain[1]}{''.join(frame[3:])}</body></html>"))
            want[len(rows) - 1] = "\n".join(text)
    got = extracted(spark, rows)
    assert [got[i] for i in want] == list(want.values())


def test_awkward_markup_takes_linear_time():
    n = 50_000
    for page in ("<div>" * n, "<a " * n, "<a \"" * n + ">", "<a '\">" * n, "<b>" * n + "<p></i>" * n, "<script></script " * n, "<!--" * n, "<li><b>" * n, "&" * n, "<" * n):
        began = time.time()
        html_extract.blocks(page)
        assert time.time() - began < 5, page[:20]


def test_classes_by_brute_force(spark):
    rng = random.Random(5)
    part = lambda: rng.choice(["<section class='s{0}'><b>fixed {0}</b></section>", "<p>words {0}</p>", "<div id='d{0}'>{1}</div>"]).format(rng.randrange(4), rng.randrange(3))
    rows = [(i, f"http://h{i % 3}/{i}", "<body>" + "".join(part() for _ in range(rng.randrange(8))) + f"<i>{i % 20}</i></body>") for i in range(60)]
    rows += [(100 + i, u, h) for i, (_, u, h) in enumerate(rows[:30])]  # copies count once
    parsed = html_extract._parsed(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row long, page_id long, url string, html string")).cache()
    got = {(r.host, r.token) for r in html_extract.template_texts(parsed).collect()}
    pages = {(r.host, r.key): r for r in parsed.collect()}
    want = set()
    for host in ("h0", "h1", "h2"):
        mine = [p for (h, _), p in pages.items() if h == host]
        vector, holder, tags = {}, {}, set()
        for at, p in enumerate(mine):
            for k, (token, count, around) in enumerate(zip(p.tokens, p.counts, [*p.tokens[: p.tags], *(p.tokens[i] for i in p.holders)])):
                vector.setdefault(token, [0] * len(mine))[at] = count
                holder[token] = around
                tags |= {token} if k < p.tags else set()
        for token, v in vector.items():
            on = sum(c > 0 for c in v)
            if token not in tags and vector[holder[token]] == v and on >= html_extract.LEAST_PAGES and on >= html_extract.LEAST_SHARE * len(mine):
                want.add((host, token))
    assert got == want and want


def test_pipeline(spark, sf_dir):
    assert corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "source_mixing", "sequence_packing"]
    columns, before, at = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, sf_dir).toPandas(), docs.schema)
        assert after.columns == columns and 0 < after.count()
        at[name], before = after, after
    clean, once, apart = (at[n] for n in names[:3])
    bare = lambda df: [("".join((r.text or "").encode().decode().split(" "))).replace("\n", "") for r in df.collect()]
    assert len(set(bare(clean))) == len(set(bare(once))) == once.count()
    prints = [simhash_dedup.fingerprint(r.text.encode()) for r in apart.collect()]
    assert not any((a ^ b).bit_count() <= 4 for i, a in enumerate(prints) for b in prints[:i])
    words = lambda df: sum(len((r.text or "").encode().split()) for r in df.collect())
    assert abs(words(at["source_mixing"]) - words(apart)) <= 4 * words(apart) ** 0.5
    made = corpus_pipeline.run(spark, sf_dir)
    packed = made.groupBy("sequence_id").sum("length").collect()
    assert all(r[1] == 2048 or r[1] & (r[1] - 1) == 0 for r in packed)


def test_toxicity_sums_reach_the_driver_in_slices(spark, monkeypatch):
    """Arrays of several tasks are added by executors; no row that the driver takes holds more than SLICE numbers."""
    from emberline.llm import toxicity

    sizes = []
    taken = type(spark.range(1)).toLocalIterator

    def watched(df, *args, **kwargs):
        for r in taken(df, *args, **kwargs):
            sizes.append(len(r.part))
            yield r

    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", watched)
    vectors = spark.createDataFrame([(i % 2, bytearray((i % 7).to_bytes(4, "little") + (1000 + i).to_bytes(4, "little"))) for i in range(30)], "toxic int, features binary").repartition(3)
    total = toxicity._summed(vectors, toxicity._counts, 2, 3)
    assert total[:, -1].tolist() == [15, 15] and total[:, :-1].sum() == 60 and total[:, :7].sum() == 30 and (total[:, 1000:1030].sum(0) == 1).all()
    assert sizes and max(sizes) <= 4 * toxicity.SLICE
