"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped into blocks, each under its root-to-leaf path of block
tags. Per path the extractor sums text length, punctuation, link text and the number of
blocks; text and punctuation per block, less the linked share, give the path's ratio.
The blocks inside ``article`` and ``main`` are the article if they have nearly all of the
mass (length times ratio), else those of the whole page are; no other container is
narrowed down to, so a title, lead or short section beside the long text stays. Of these
the link lists with a ratio under the threshold go, and no other path: names decide, so
plain-text comments or adverts under an unlisted name stay. Furniture tags (menus, footers and so
on) count for nothing, and neither do containers that name themselves as page furniture
(adverts, notices, comments), unless their text outweighs all other text ten times.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import pick, schema

# as HTML reads tags: a name may hold quotes, a value is quoted only right after "="; what
# begins like a tag and never ends is no text
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)
    |<(/?)([A-Za-z][^\s/>]*+)((?>[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+|=)*+)>
    |<[!?/][^>]*>|</?[A-Za-z][^>]*\Z""", re.S | re.X)
ATTRIBUTE = re.compile(r"""=?([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))?)?""")
BLANK = re.compile(r"\s+")
PUNCTUATION = re.compile(r"[.,;:!?…。，？！]")

RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "xmp", "noframes"}
FURNITURE = {"nav", "footer", "aside", "button", "select", "option", "menu", "dialog", "label", "input", "head"}
NAMED = {"form", "fieldset"}        # may wrap a whole page, so they weigh like a name
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav ol option p pre search section select summary table tbody td tfoot
    th thead tr ul button label""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"button", "label", "option", "select"}
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIST_BORDER = {"ul", "ol", "dl", "table", "select", "menu", "dir"}

#: words of class, id or role names that mark page furniture
FURNITURE_WORDS = set("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar
    navigation menu breadcrumb breadcrumbs footer foot header masthead topbar sidebar aside widget widgets rail cookie cookies consent
    gdpr notice notices banner alert popup modal overlay comment comments disqus respond replies reply share sharing social related
    recommended recommendations more newsletter subscribe subscription signup login search form pager pagination copyright legal
    disclaimer toolbar complementary contentinfo hidden dialog""".split())
ARTICLE_WORDS = set("article content main post entry story text body page wrapper container".split())
#: those that also count on a paragraph or heading by itself
TEXT_FURNITURE = set("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent
    gdpr comment comments newsletter subscribe""".split())
#: words that name the container of one article
POST_WORDS = {"article", "post", "entry", "story"}
#: first words of names that say what a container has or how it is laid out, not what it is
MODIFIERS = set("has with no without not hide show overflow col row grid flex".split())
KEPT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "figcaption"}
KEEP_SHARE, THRESHOLD = 0.9, 0.02
NAME_WEIGHT = 0.1           # of the text in a container named as furniture, against text outside


class Element:
    """``path`` is the number of the tag path, ``mark`` the innermost container named as
    furniture (itself included), ``over`` the next one around that."""
    __slots__ = ("tag", "path", "parent", "furniture", "mark", "over", "in_article", "in_post")

    def __init__(self, tag: str, path: int, parent: "Element | None", furniture: bool, named: bool = False, post: bool = False):
        self.tag, self.path, self.parent, self.furniture = tag, path, parent, furniture
        self.over = parent.mark if parent else None
        self.mark = self if named else self.over
        self.in_article = tag in ("article", "main") or parent is not None and parent.in_article
        self.in_post = post or self.in_article or parent is not None and parent.in_post


def attributes(tag_rest: str) -> dict[str, str]:
    """Names and values; the first of a repeated name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(tag_rest):
        if name:
            out.setdefault(name.lower(), html_lib.unescape(a or b or c))
    return out


def is_furniture(tag: str, labels: dict[str, str], inside_article: bool) -> bool:
    """Furniture by what it is (or not shown at all), whatever text it has."""
    if tag in FURNITURE or tag == "header" and not inside_article:
        return True
    return "hidden" in labels or labels.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", labels.get("style", ""), re.I))


def is_named_furniture(tag: str, labels: dict[str, str]) -> bool:
    if tag in ("html", "body", "main", "article"):
        return False
    if tag in NAMED:
        return True
    for kind in ("class", "id", "role"):
        for name in labels.get(kind, "").split():
            words = [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if x]
            if not words or ":" in name or len(words) > 1 and words[0] in MODIFIERS:
                continue
            about_article = bool(ARTICLE_WORDS & set(words))
            if tag in KEPT_TAGS:
                if TEXT_FURNITURE & {words[0], words[-1]} and not about_article:
                    return True
                continue
            if words[-1] in FURNITURE_WORDS and not (about_article and words[-1] == "header") or words[0] in FURNITURE_WORDS and not about_article:
                return True
    return False


def without_furniture(blocks: list[tuple[Element, str, int]]) -> list[tuple[Element, str, int]]:
    """The blocks outside furniture. A name only lowers a container's weight: while the
    text of a named container, weighted so, exceeds all text outside such containers, it
    is the page's text and its name doesn't count (the names inside it still do)."""
    blocks = [b for b in blocks if not b[0].furniture]
    lifted: set[Element] = set()
    while True:
        held, free, outer = {}, 0, {}
        for el, text, linked in blocks:
            mark = outermost(el.mark, lifted, outer)
            n = max(0, len(text) - linked)
            if mark is None:
                free += n
            else:
                held[mark] = held.get(mark, 0) + n
        most = max(held, key=held.get, default=None)
        if most is None or held[most] * NAME_WEIGHT <= free:
            return [b for b in blocks if outermost(b[0].mark, lifted, outer) is None]
        lifted.add(most)


def outermost(mark: Element | None, lifted: set, known: dict) -> Element | None:
    """The outermost container named as furniture that isn't lifted, from ``mark`` outward."""
    chain = []
    while mark is not None and mark not in known:
        chain.append(mark)
        mark = mark.over
    found = None if mark is None else known[mark]
    for el in reversed(chain):
        found = found or (None if el in lifted else el)
        known[el] = found
    return found


def blocks_of(page: str) -> list[tuple[Element, str, int]]:
    """Blocks in page order: (innermost block element, text, characters in links)."""
    root = Element("#", 0, None, False)
    path_no: dict[tuple[int, str], int] = {}
    open_now: Counter = Counter()
    here, out, text, linked, in_link = root, [], [], 0, False
    articles, at = 0, 0

    def flush():
        nonlocal linked
        if text:
            t = BLANK.sub(" ", html_lib.unescape("".join(text))).strip()
            if t:
                out.append((here, t, linked))
            text.clear()
        linked = 0

    def close(el: Element) -> Element:
        nonlocal articles
        articles -= el.tag in ("article", "main")
        open_now[el.tag] -= 1
        return el.parent

    pos, n = 0, len(page)
    while pos < n:
        m = TOKEN.search(page, pos)
        end = m.start() if m else n
        if end > pos:
            piece = page[pos:end]
            text.append(piece)
            if in_link:
                linked += len(piece.strip())
        if not m:
            break
        pos = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW and not closing:
            if not m[3].rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
                pos = stop.end() if stop else n
            continue
        if tag == "a":
            in_link = not closing
        elif tag in ("br", "hr"):
            flush()
        if tag not in BLOCKS or tag in VOID:
            continue
        flush()
        in_link = False
        if closing:
            if open_now[tag]:
                while here.tag != tag:
                    here = close(here)
                here = close(here)
            continue
        if tag in CLOSES_P and here.tag == "p":
            here = close(here)
        if tag in SAME_CLOSES and any(open_now[t] for t in SAME_CLOSES[tag]):
            el = here
            while el and el.tag not in SAME_CLOSES[tag] and el.tag not in LIST_BORDER:
                el = el.parent
            if el and el.tag in SAME_CLOSES[tag]:
                while here is not el:
                    here = close(here)
                here = close(here)
        labels = attributes(m[3]) if m[3].strip() else {}
        name = ".".join([tag, *sorted(labels.get("class", "").lower().split())])
        path = path_no.setdefault((here.path, name), len(path_no) + 1)
        post = bool(POST_WORDS & set(re.split(r"[^a-z]+", labels.get("class", "").lower())))
        here = Element(tag, path, here, here.furniture or is_furniture(tag, labels, articles > 0 or here.in_post), is_named_furniture(tag, labels), post)
        open_now[tag] += 1
        articles += tag in ("article", "main")
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article's blocks in page order, one per line; empty if there are none."""
    blocks = without_furniture(blocks_of(page or ""))
    if not blocks:
        return ""
    paths: dict[int, list[int]] = {}
    for el, text, linked in blocks:
        p = paths.setdefault(el.path, [0, 0, 0, 0])
        for i, v in enumerate((len(text), len(PUNCTUATION.findall(text)), min(linked, len(text)), 1)):
            p[i] += v
    ratio = {k: c / n * (1 + punct / n) * (1 - links / c) for k, (c, punct, links, n) in paths.items()}
    mass = [len(text) * ratio[el.path] for el, text, _ in blocks]
    marked = [el.in_article for el, _, _ in blocks]
    # outside article and main everything stays, unless they hold nearly all of the mass
    if sum(m for m, x in zip(mass, marked) if x) < KEEP_SHARE * sum(mass) or not any(marked):
        marked = [True] * len(blocks)
    inside = [b for b, x in zip(blocks, marked) if x]
    mean = sum(len(t) * ratio[el.path] for el, t, _ in inside) / max(1, sum(len(t) for _, t, _ in inside))
    kept = []
    for el, text, _ in inside:
        c, _, links, _ = paths[el.path]
        menu = links > c / 2 and el.tag not in KEPT_TAGS        # link lists; a linked title or paragraph stays
        if not menu or ratio[el.path] >= THRESHOLD * mean:
            kept.append(text)
    return "\n".join(kept)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (main text of the whole html), n_chars.

    Null, empty and textless pages give an empty text. Repeated rows and rows without id
    give one row each, an empty table none. Paths are numbered, so memory and time follow
    the page's length however deep it nests. Pages are independent: nothing is shuffled."""
    def rows(batches):
        for b in batches:
            text = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], names=["page_id", "url", "text"])

    src = pick(pages, page_id=id_col, url=url_col, html=html_col)
    out = src.mapInArrow(rows, schema(("page_id", src.schema[0].dataType.simpleString()), ("url", "string"), ("text", "string")))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
