"""Operator 8, HTML extraction: templates deduced from same-host pages by equivalence classes of tokens."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import FEW, id_key, null_if_no_id, splittable, table, without_rows

#: Distinct pages of a host that a class must occur on to be told from chance, and the share of them.
LEAST_PAGES, LEAST_SHARE = 3, 0.5

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_WHITE = re.compile("[\x20\x09-\x0d\xa0]+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Fixed words of HTML and of common page layouts.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg canvas annotation annotation-xml".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr object"
    " math mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDS_ROWS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
_OUT = frozenset("nav aside footer head button select option dialog menu input label legend".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Elements that hold an article's running text.
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption blockquote pre".split())
#: Words in a class or id that name readers' comments, and in a class only, as ids may be of headings, adverts and buttons: within an article too.
_COMMENT_WORDS = frozenset("comment comments commentlist disqus".split())
_WITHIN_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense share sharing".split()) | _COMMENT_WORDS
#: Words of articles that only point to others.
_TEASER_WORDS = frozenset("card teaser preview related recommended promo promoted sponsored".split())
#: Words in a class or id that name parts outside an article which never hold one, and words that may also name what is around it.
_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense promo promotion promoted sponsor sponsored comment comments commentlist disqus discussion"
    " respond reply replies breadcrumb breadcrumbs cookie cookies consent gdpr newsletter related recommended recommendations popup pagination pager copyright".split()
)
_AROUND_WORDS = frozenset(
    "banner sidebar widget widgets nav navbar navigation menu menus footer masthead notice notices alert subscribe subscription signup login share sharing social"
    " modal overlay toolbar search skip hidden".split()
)
#: How a block is left out: not at all; by what may be around the article too; for certain.
_IN, _SOFT, _HARD = 0, 1, 2


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(text)} if text.strip(" /\n\t") else {}


#: Where an element lies.
_OUTSIDE, _MAIN_PART, _ARTICLE_PART = 0, 1, 2


def _named(attributes: dict[str, str], *names: str) -> set[str]:
    return {w.lower() for n in names for w in _PARTS.findall(attributes.get(n, ""))}


def _left_out(tag: str, attributes: dict[str, str], within: int) -> int:
    """How an element leaves out what it holds, from where it lies. In an article, class words may only name comments, adverts and buttons."""
    if tag in _OUT:
        return _HARD
    if attributes and (
        "hidden" in attributes
        or attributes.get("aria-hidden") == "true"
        or attributes.get("role", "").lower() in _OUT_ROLES
        or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    ):
        return _HARD
    if tag == "form" or (tag == "header" and not within):
        return _SOFT
    if tag in ("body", "html", "main", "article") or not attributes:
        return _SOFT if tag == "article" and _named(attributes, "class") & _TEASER_WORDS else _IN
    if within == _ARTICLE_PART:
        return _HARD if _named(attributes, "class") & _WITHIN_WORDS or _named(attributes, "id") & _COMMENT_WORDS else _IN
    named = _named(attributes, "class", "id")
    return _HARD if named & _OUT_WORDS else _SOFT if named & _AROUND_WORDS else _IN


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


def _tag_end(page: str, at: int, lost: set[str]) -> int:
    """Where the tag whose attributes begin at ``at`` ends (its ">"), or -1. Quotes without an end, noted in ``lost``, are plain characters."""
    while True:
        at = _UNQUOTED.match(page, at).end()
        if at >= len(page):
            return -1
        if page[at] == ">":
            return at
        close = -1 if page[at] in lost else page.find(page[at], at + 1)
        if close < 0:
            lost.add(page[at])
            at += 1
        else:
            at = close + 1


class Block(NamedTuple):
    text: str
    out: int  # how it is left out
    within: int  # where it lies
    signature: int  # of its element
    running: bool = False  # its element holds running text
    linked: bool = False  # over half of it is links


def blocks(page: str) -> tuple[list[Block], list[int]]:
    """(blocks, tags) of a page in order.

    Tags are the signatures of all elements: a hash of name, class and id and of the signature of the element around. Unclosed
    elements end where HTML ends them: a paragraph at the next block, the rest with what is around them. Time and
    memory grow with the page's length only, however tags nest or stay open.
    """
    found: list[Block] = []
    tags: list[int] = []
    stack: list[tuple[str, int, int, int]] = []  # tag, left out, where, signature
    open_at: dict[str, list[int]] = {}  # tag -> its places on the stack
    block_at: list[int] = []  # places of elements that aren't inline
    parts: list[str] = []
    links = 0  # code points of ``parts`` that are within links
    lost: set[str] = set()
    pos, n, last_end = 0, len(page), page.rfind(">")

    def add(text: str) -> None:
        nonlocal links
        if stack and stack[-1][1] == _HARD and stack[-1][0] in _INLINE:
            return
        parts.append(text)
        if open_at.get("a"):
            links += len(text)

    def close() -> None:
        nonlocal links
        whole = "".join(parts)
        text = _WHITE.sub(" ", html.unescape(whole)).strip(" ")
        if text:
            _, out, within, signature = stack[-1] if stack else ("", _IN, _OUTSIDE, 0)
            found.append(Block(text, out, within, signature, bool(block_at) and stack[block_at[-1]][0] in _TEXT, 2 * links > len(whole)))
        parts.clear()
        links = 0

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            tag = stack.pop()[0]
            open_at[tag].pop()
            if block_at and block_at[-1] == len(stack):
                block_at.pop()

    innermost = lambda names: max((open_at[t][-1] for t in names if open_at.get(t)), default=-1)

    while pos < n:
        less = page.find("<", pos) if pos <= last_end else -1
        if less < 0:
            add(page[pos:])
            break
        add(page[pos:less])
        if page.startswith("<!--", less):
            end = page.find("-->", less + 4)
            pos = n if end < 0 else end + 3
            continue
        if page[less + 1 : less + 2] in ("!", "?"):
            pos = page.find(">", less) + 1 or n
            continue
        closing = page.startswith("</", less)
        name = _NAME.match(page, less + 1 + closing)
        end = _tag_end(page, name.end(), lost) if name else -1
        if end < 0:
            add("<")
            pos = less + 1
            continue
        tag, inner, pos = name[0].lower(), page[name.end() : end], end + 1
        if closing:
            if tag not in _INLINE:
                close()
            if open_at.get(tag):
                pop_to(open_at[tag][-1])
            continue
        if tag in _RAW:
            if not (tag == "svg" and inner.endswith("/")):
                stop = re.compile(rf"</{re.escape(tag)}\b", re.IGNORECASE).search(page, pos)
                pos = (page.find(">", stop.end()) + 1 if stop else 0) or n
            parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
        if tag in _VOID:
            if tag == "hr":
                close()
            continue
        if tag not in _INLINE:
            close()
            if tag in _CLOSES_P:
                if block_at and stack[block_at[-1]][0] == "p":
                    pop_to(block_at[-1])
            elif tag in _CLOSES_SAME:
                same = innermost(_CLOSES_SAME[tag])
                if same > innermost(_HOLDS_ROWS[tag]):
                    pop_to(same)
        attributes = _attributes(inner)
        _, out, within, signature = stack[-1] if stack else ("", _IN, _OUTSIDE, 0)
        if tag == "article" or attributes.get("itemprop") == "articleBody":
            here = _ARTICLE_PART
        else:
            here = _MAIN_PART if tag == "main" or attributes.get("role") == "main" else _OUTSIDE
        if here > within:
            out = _IN if out == _SOFT else out
            within = here
        out = max(out, _left_out(tag, attributes, within) if tag != "a" else _IN)
        if tag not in _INLINE:
            signature = _hash(f"{tag}.{attributes.get('class', '')}#{attributes.get('id', '')}", signature)
            tags.append(signature)
            block_at.append(len(stack))
        open_at.setdefault(tag, []).append(len(stack))
        stack.append((tag, out, within, signature))
    close()
    return found, tags


def _host(url: str | None) -> str:
    m = re.match(r"\s*[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def candidates(found: list[Block]) -> list[Block]:
    """The blocks that may be main text: those that aren't left out; without any, those whose class or kind may also stand around an article."""
    return [b for b in found if b.out == _IN] or [b for b in found if b.out == _SOFT]


#: What is known of a candidate beside its text: where it lies, and whether it is running text or mostly links.
_WHERE, _RUNNING, _LINKED = 3, 4, 8


def main_text(kept: list[str], kinds: list[int], fixed: list[bool]) -> str:
    """The main text among the candidates, given their kinds and which are fixed text of the template.

    Fixed texts go, but for the running text of an article (paragraphs, headings, lists, tables), as articles of a site
    may share headings and passages. A page all of whose candidates are fixed has no slots: it is a copy of others and
    keeps them. If articles hold at least as much text as what lies outside them, links not counted, they are the main
    text; else what the page marks as its main part, likewise; else the page doesn't mark its main text, and all that is
    left is.
    """
    stays = [not f or (k & _WHERE == _ARTICLE_PART and k & _RUNNING) for k, f in zip(kinds, fixed)]
    left = [(t, k) for t, k, s in zip(kept, kinds, stays) if s] or list(zip(kept, kinds))
    for least in (_ARTICLE_PART, _MAIN_PART):
        inside = [t for t, k in left if k & _WHERE >= least]
        if inside and sum(map(len, inside)) >= sum(len(t) for t, k in left if k & _WHERE < least and not k & _LINKED):
            return "\n".join(inside)
    return "\n".join(t for t, _ in left)


def _parsed(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``, parsed once.

    row, page_id, url, host, key (names the host and html); tokens, counts and tags: the page's distinct tokens, the
    first ``tags`` of them elements, the rest texts in their elements, and how often each occurs; holders: for each text
    token the place of its element's; kept (texts of the candidates), kinds and kept_at (the places of their tokens).
    """

    def run(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in range(9)]
            for url, page in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                page, host = page or "", _host(url)
                found, tags = blocks(page)
                keys = [_signed(_hash(b.text, b.signature)) for b in found]
                counts: list[dict[int, int]] = [{}, {}]
                for at, some in enumerate(([_signed(t) for t in tags], keys)):
                    for k in some:
                        counts[at][k] = counts[at].get(k, 0) + 1
                place = {t: i for i, t in enumerate([*counts[0]])}
                holder = {k: place.get(_signed(b.signature), -1) for k, b in zip(keys, found)}
                at = {t: len(place) + i for i, t in enumerate(counts[1])}
                main = candidates([b._replace(signature=k) for k, b in enumerate(found)])
                one = (
                    host, _signed(_hash(page, _hash(host))), [*counts[0], *counts[1]], [*counts[0].values(), *counts[1].values()], len(place),
                    [holder[k] for k in counts[1]], [b.text for b in main], [b.within + _RUNNING * b.running + _LINKED * b.linked for b in main], [at[keys[b.signature]] for b in main],
                )
                for c, v in zip(columns, one):
                    c.append(v)
            longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
            kinds = [pa.string(), pa.int64(), longs, ints, pa.int32(), ints, pa.list_(pa.string()), ints, ints]
            names = ["row", "page_id", "url", "host", "key", "tokens", "counts", "tags", "holders", "kept", "kinds", "kept_at"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    schema = "row long, page_id long, url string, host string, key long, tokens array<long>, counts array<int>, tags int, holders array<int>, kept array<string>, kinds array<int>, kept_at array<int>"
    return pages.mapInArrow(run, schema)


def template_texts(parsed: DataFrame) -> DataFrame:
    """(host, token): texts that belong to the template of their host's pages, from :func:`_parsed`.

    A token's occurrence vector says how often it occurs on each of the host's distinct pages; sums of the halves of
    hashes, which don't depend on the pages' order, stand for it and merge before the exchange, as do the counts. Tokens
    with equal vectors form an equivalence class. A class is valid if it spans LEAST_PAGES distinct pages and
    LEAST_SHARE of the host's, and holds elements: the page's frame, or a part nested in it that some pages have. A text
    is fixed if the element around it is of the same valid class, so that it always holds this text; elements whose
    texts differ or that repeat are slots.
    """
    copied = parsed.groupBy("key", "host", splittable("key")).agg(F.min("row").alias("stays"), F.count("*").alias("n")).where("n > 1").select("key", "host", "stays")
    distinct = without_rows(parsed, parsed.select("row", "key", "host").join(copied, ["key", "host"]).where("row <> stays"))
    own = F.slice("tokens", F.lit(1), F.col("tags"))
    holders = F.concat(own, F.transform("holders", lambda i: F.when(i >= 0, F.element_at("tokens", i + 1)).otherwise(0)))
    each = distinct.select("key", "host", "tags", F.posexplode(F.arrays_zip("tokens", "counts", holders.alias("around"))).alias("at", "t"))
    each = each.select("host", F.col("t.tokens").alias("token"), F.col("t.around").alias("holder"), (F.col("at") < F.col("tags")).alias("tag"), F.xxhash64("key", "t.counts").alias("hash"))
    vectors = table(
        each.groupBy("host", "token", "holder", "tag")
        .agg(F.sum(F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned("hash", 32)).alias("high"), F.count("*").alias("pages"))
        .where(F.col("pages") >= LEAST_PAGES)
        .select("host", "token", "holder", "tag", F.xxhash64("low", "high").alias("vector"), "pages")
    )
    hosts = distinct.groupBy("host").agg(F.count("*").alias("of"))
    elements = vectors.where("tag").select("host", F.col("token").alias("holder"), "vector", "pages")
    fixed = vectors.where("not tag").join(elements, ["host", "holder", "vector", "pages"], "left_semi")
    return fixed.join(hosts, "host").where(F.col("pages") >= LEAST_SHARE * F.col("of")).select("host", "token")


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    The main text of the whole page: the blocks of its articles, or of the whole page if it marks no larger ones, without menus,
    headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup, reader comments and texts of the
    host's template (see :func:`template_texts` and :func:`main_text`). Character references are decoded; each block is
    one line. Null html counts as empty and gives an empty text; pages without a host in their url form one group. Rows
    that repeat a page are extracted each, but count once for the template. Pages are parsed once; fixed texts reach a
    page by a join on their token, so hosts of any size are spread over tasks and nothing is gathered by host.
    """
    plain = pages.select(
        F.monotonically_increasing_id().alias("row"), id_key(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html")
    )
    parsed = table(_parsed(plain))
    kept_tokens = F.transform("kept_at", lambda i: F.element_at("tokens", i + 1))
    on_page = parsed.select("row", "host", F.explode(F.array_distinct(kept_tokens)).alias("token"))
    held = table(on_page.join(table(template_texts(parsed)), ["host", "token"]).select("row", "token"))
    few = held.count() <= FEW  # rows, sent to all tasks; more are joined by sorting
    fixed = held.groupBy("row", splittable("row")).agg(F.collect_list("token").alias("fixed")).drop("_one")
    fixed = F.broadcast(fixed) if few else fixed.hint("merge")

    def run(batches):
        for batch in batches:
            out = []
            for kept, kinds, tokens, some in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
                gone = set(some or ())
                out.append(main_text(kept, kinds, [t in gone for t in tokens]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    joined = parsed.select("row", "page_id", "url", "kept", "kinds", kept_tokens.alias("kept_tokens")).join(fixed, "row", "left")
    out = joined.select("page_id", "url", "kept", "kinds", "kept_tokens", "fixed").mapInArrow(run, "page_id long, url string, text string, n_chars long")
    return out.withColumn("page_id", null_if_no_id(F.col("page_id")))
