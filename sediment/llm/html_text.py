"""Main text of HTML pages, with site templates removed.

Every container's markup is hashed; hashes are counted per host over distinct pages, and containers that recur on most
pages of a host are its template. What is left of the article is the text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.operators.lookup import Sized, lookup
from sediment.staging import Staging

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# What is no main text, by element, role, and tokens of class or id.
DROPPED = frozenset(
    "head nav header footer aside form script style noscript template iframe textarea title select option button svg canvas "
    "object embed dialog menu audio video input fieldset xmp noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
COMMENTS = frozenset("comment comments reply replies disqus".split())
NAMES = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget related footer header masthead cookie cookies consent notice gdpr popup modal "
    "overlay newsletter subscribe signup login share sharing social toolbar pagination".split()
)
# A token counts if it is one of NAMES, or made of those and of what only says where, how many or which.
PLACES = frozenset(
    "site main top bottom left right primary secondary global list item items bar box area block links buttons icons slot unit "
    "media container wrapper wrap".split()
)
COMMENT_PLACES = PLACES | frozenset("section post user thread form body content text title author respond".split())
# Of the names, those that are as well headings of an article's sections, so an id does not count.
SECTIONS = frozenset("comment reply related notice consent promotion social sharing share menu sponsor".split())
# Dropped elements that hold whole pages at times, and ones left open before a <main>, or an <article> too.
FORMS = frozenset("form fieldset".split())
ASIDES = frozenset("nav aside".split())
HEADS = frozenset("header footer".split())
# Elements whose class says nothing about what is in them.
FRAME = frozenset("html body main h1 h2 h3 h4 h5 h6".split())
# Elements that end an open paragraph, and ones that end an open one of their own kind.
ENDS_P = BLOCK - frozenset("caption body html tbody td tfoot th thead tr dd dt li summary figcaption".split())
SELF_ENDING = {"li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option", "tr": "tr td th", "td": "td th", "th": "td th"}
# What a head holds, whose end tag may be left out; elements in which, and in whose like, `/>` ends an element.
HEAD = frozenset("base basefont bgsound link meta title style script template noscript noframes".split())
FOREIGN = frozenset("svg math".split())
ENDED = re.compile(r"(?:^|[\s\"'])/\s*$")
# What may recur on pages without being their text: containers, never inline elements, headings or paragraphs.
WIDGETS = frozenset("div section ul ol table figure aside".split())

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")


@dataclass(frozen=True)
class TemplateParams:
    # A container is template from this many distinct pages of a host on, if that is also this share of them.
    min_pages: int = 5
    min_percent: int = 50
    # Inside an article, the share has to be this.
    article_percent: int = 50


# Whether an element's text goes: never; always; unless it holds a <main>; a <main> or the article; one of these or most of the text,
# for an element by its name, and for a form.
KEPT, GONE, HOLDS_MAIN, HOLDS_ARTICLE, NAMED, FORM = range(6)


class Element:
    __slots__ = ("tag", "start", "first", "article", "fate", "before")

    def __init__(self, tag: str, start: int, first: int, article: int, fate: int, before: tuple[int, int, int]):
        self.tag, self.start, self.first, self.article, self.fate, self.before = tag, start, first, article, fate, before


def fate_of_name(token: str) -> int:
    """That of a class or id made of names alone, or of them with places and numbers: `cookie-notice`, `sidebar-left`, `comment-12`."""
    words = {w for w in re.split(r"[^a-z0-9]+", token) if not w.isdigit()} - {""}
    if not COMMENTS.isdisjoint(words):
        return HOLDS_MAIN if words <= NAMES | COMMENT_PLACES else KEPT
    return NAMED if not NAMES.isdisjoint(words) and words <= NAMES | PLACES else KEPT


def fate_of(tag: str, attributes: str) -> int:
    if tag in DROPPED:
        return FORM if tag in FORMS else HOLDS_MAIN if tag in ASIDES else HOLDS_ARTICLE if tag in HEADS else GONE
    if tag in FRAME or not attributes:
        return KEPT
    fate = KEPT
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        found = [NAMED] if name == "role" and value in ROLES else []
        if name == "class" or name == "id" and value not in SECTIONS:
            found = [fate_of_name(token) for token in value.split()]
        if HOLDS_MAIN in found:
            return HOLDS_MAIN
        fate = max(fate, *found, KEPT)
    return fate


def subtree_hash(markup: str) -> int:
    x = xxhash.xxh64_intdigest(markup.encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x


def walk(page: str, template: frozenset[int] = frozenset(), widgets: frozenset[int] = frozenset()) -> tuple[list, list[tuple[int, bool]]]:
    """Text pieces (text or None for the end of a block, place, whether linked) and (hash, inside an article) of elements.

    A place is 0 outside of articles, 1 in an article and 2 in a <main>.
    Only WIDGETS have hashes; pieces of those whose hash is in `template` (in an article: `widgets`) are left out.
    """
    pieces: list[tuple[str | None, int, bool]] = []
    hashes: list[tuple[int, bool]] = []
    stack: list[Element] = []
    # Elements whose fate hangs on the whole page: element, end of its pieces, characters outside of links, and in articles that it holds.
    unsure: list[tuple[Element, int, int, int]] = []
    # Characters outside of links, those in articles, and <main>s so far; open links.
    plain = owned = mains = links = 0
    at, size = 0, len(page)

    def close(upto: int, end: int) -> None:
        nonlocal plain, owned, mains, links
        while len(stack) > upto:
            e = stack.pop()
            links -= e.tag == "a"
            if e.fate == GONE or e.fate == HOLDS_MAIN and mains == e.before[2]:
                del pieces[e.first :]
                plain, owned, mains = e.before
            else:
                if e.fate > HOLDS_MAIN and mains == e.before[2]:
                    unsure.append((e, len(pieces), plain - e.before[0], 0 if e.article else owned - e.before[1]))
                if e.tag in WIDGETS:
                    h = subtree_hash(page[e.start : end])
                    hashes.append((h, e.article > 0))
                    if h in (widgets if e.article else template):
                        del pieces[e.first :]
            while unsure and unsure[-1][1] > len(pieces):
                unsure.pop()
            if e.tag in BLOCK:
                pieces.append((None, e.article, False))

    def say(text: str) -> None:
        nonlocal plain, owned
        if text:
            if stack and stack[-1].tag == "head" and not text.isspace():
                close(len(stack) - 1, at)
            depth = stack[-1].article if stack else 0
            pieces.append((text, depth, links > 0))
            n = len(text.strip())
            plain += 0 if links else n
            owned += n if depth else 0

    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    close(i, at)
                    break
            continue
        if stack and stack[-1].tag == "head" and tag not in HEAD:
            close(len(stack) - 1, m.start())
        if tag == "br":
            say(" ")
            continue
        if tag in ENDS_P or tag in SELF_ENDING:
            ends = {"p"} if tag in ENDS_P else set(SELF_ENDING[tag].split())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in ends:
                    close(i, m.start())
                    break
                if stack[i].tag in BLOCK and stack[i].tag != "p":
                    break
        depth = stack[-1].article if stack else 0
        if tag in BLOCK:
            pieces.append((None, depth, False))
        if tag in VOID:
            continue
        attributes = m[3] or m[6] or ""
        if attributes.endswith("/") and ENDED.search(attributes) and (tag in FOREIGN or any(e.tag in FOREIGN for e in stack)):
            continue
        if tag in ("article", "main"):
            depth = max(depth, 1 + (tag == "main"))
        stack.append(Element(tag, m.start(), len(pieces), depth, fate_of(tag, attributes), (plain, owned, mains)))
        mains += tag == "main"
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else size
    close(0, size)
    return without(pieces, [(e.first, last) for e, last, *held in unsure if goes(e, *held, plain, owned)]), hashes


def goes(e: Element, text: int, article: int, plain: int, owned: int) -> bool:
    """Whether an element that holds `text` and `article` of the page's `plain` and `owned` characters is dropped.

    It stays if it holds the article, by at least half of the articles' text, or most of the page's text: more than half, and
    nine tenths inside an article, or of an element dropped by its name if there is an article elsewhere.
    """
    if article and 2 * article >= owned:
        return False
    percent = 90 if e.article or e.fate == NAMED and owned > article else 50
    return e.fate == HOLDS_ARTICLE or 100 * text <= percent * plain


def without(pieces: list, spans: list[tuple[int, int]]) -> list:
    """The pieces that lie in none of the spans."""
    change = [0] * (len(pieces) + 1)
    for first, last in spans:
        change[first] += 1
        change[last] -= 1
    return [piece for piece, inside in zip(pieces, accumulate(change)) if not inside]


def has_article(pieces: list) -> bool:
    """Whether the text is what lies in a <main> or article: there is a <main> with text, or the articles hold at least half of
    the words outside of links (of all, if all are links)."""
    words = [[0, 0], [0, 0], [0, 0]]
    for text, place, linked in pieces:
        if text:
            words[place][linked] += len(text.split())
    if sum(words[2]):
        return True
    if not sum(words[1]):
        return False
    own, rest = (words[1][0], words[0][0]) if words[1][0] + words[0][0] else (words[1][1], words[0][1])
    return own >= rest


def main_text(page: str | None, template: frozenset[int] = frozenset(), widgets: frozenset[int] = frozenset()) -> str:
    """The article's blocks in page order; all blocks of a page without one, or whose articles are the lesser part."""
    pieces, _ = walk(page or "", template, widgets)
    inside = has_article(pieces)
    blocks, now = [], []
    for text, place, _ in [*pieces, (None, 1, False)]:
        if inside and not place:
            continue
        if text is not None:
            now.append(text)
        elif now:
            block = " ".join(entities.unescape("".join(now)).split())
            if block:
                blocks.append(block)
            now = []
    return " ".join(blocks)


def host_of(url: Column) -> Column:
    """The host in lower case, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def site_templates(pages: DataFrame, params: TemplateParams) -> DataFrame:
    """`host`, `template`, `widgets`: hashes of recurring subtrees outside and inside of articles, for (`host`, `html`).

    Pages of one host with equal markup count once. A template has to be on a share of its host's pages, so
    the lists are no longer than a page's elements times 100 / min_percent, however large the host.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outside, inside = [], []
            for x in batch.column("html"):
                found = walk(x.as_py() or "")[1]
                outside.append(list({h for h, own in found if not own}))
                inside.append(list({h for h, own in found if own}))
            lists = [pa.array(v, pa.list_(pa.int64())) for v in (outside, inside)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), *lists], names=["host", "page", "outside", "inside"])

    given = pages.where("host is not null").select("host", F.xxhash64("html").alias("page"), "html")
    hashed = given.mapInArrow(run, "host string, page long, outside array<long>, inside array<long>")
    # Page by page, so a host with a third of all pages is spread over all tasks.
    distinct = Staging(pages.sparkSession).write("subtrees", hashed.groupBy("host", "page").agg(F.first("outside").alias("outside"), F.first("inside").alias("inside")))
    hosts = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))

    def marked(column: str, own: int) -> Column:
        return F.transform(column, lambda h: F.struct(h.alias("h"), F.lit(own).alias("own")))

    each = distinct.select("host", F.explode(F.concat(marked("outside", 0), marked("inside", 1))).alias("s"))
    counts = each.groupBy("host", "s.h", "s.own").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= params.min_pages)
    share = F.when(F.col("own") == 1, params.article_percent).otherwise(params.min_percent)
    many = counts.join(hosts, "host").where(F.col("n") * 100 >= F.col("pages") * share)
    return many.groupBy("host").agg(
        F.collect_list(F.when(F.col("own") == 0, F.col("h"))).alias("template"),
        F.collect_list(F.when(F.col("own") == 1, F.col("h"))).alias("widgets"),
    )


def extract_text(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", params: TemplateParams = TemplateParams()) -> DataFrame:
    """One row per page: `page_id`, `url`, `text`, `n_chars`.

    A null or empty page gives an empty text; broken markup is read as far as it goes; a null url has no host and so no
    template; repeated rows give a row each and count once for templates; an empty table gives no rows. Pages of any length are read
    whole, in one pass over their tags; other columns are not read.
    """
    rows = pages.select(
        F.col(page).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"), host_of(F.col(url).cast("string")).alias("host")
    )
    templates = Staging(pages.sparkSession).write("templates", site_templates(rows, params))
    sized = Sized.of(templates.select("host", F.to_json("template").alias("t"), F.to_json("widgets").alias("w")))
    joined = lookup(rows, Sized(templates, sized.rows, sized.bytes), {"host": "host"}, {"template": "template", "widgets": "widgets"}, spread=("page_id",), keys_from=rows.select("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(x.as_py(), frozenset(t.as_py() or ()), frozenset(w.as_py() or ()))
                for x, t, w in zip(batch.column("html"), batch.column("template"), batch.column("widgets"))
            ]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), lengths], names=["page_id", "url", "text", "n_chars"])

    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return joined.select("page_id", "url", "html", "template", "widgets").mapInArrow(run, schema)
