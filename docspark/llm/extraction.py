"""Main text of web pages, without the templates that a site repeats."""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import FEW, staged

#: A subtree is template if it is on so many pages of a host, and on this share of them.
PAGES, SHARE = 10, 0.5

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WHITE = re.compile(r"\s+")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_LEFT_OUT = _RAW | {"head", "nav", "header", "footer", "aside", "form", "menu", "template", "svg", "button", "select", "dialog",
                    "object", "canvas", "audio", "video"}
_BLOCKS = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
           "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p", "pre", "section",
           "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"} | _LEFT_OUT
#: Words in class, id or role that mark what is not the article.
_NOT_ARTICLE = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside header masthead footer comment comments respond discussion disqus cookie cookies "
    "consent notice notices alert gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended pagination pager search widget toolbar contentinfo complementary".split()
)
#: An element of the key's kind ends open ones of these.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


def _set_apart(attributes: str) -> bool:
    for _, a, b, c in _NAMES.findall(attributes):
        if any(w in _NOT_ARTICLE for w in re.split(r"[\s_-]+", (a or b or c).lower())):
            return True
    return False


class Page:
    """Blocks of text in page order and the block elements they are in."""

    def __init__(self, html: str):
        self.blocks: list[tuple[str, tuple[int, ...], bool]] = []  # text, elements, in an article
        stack: list[tuple[str, bool, int]] = [("", False, 0)]  # tag, left out, number if a block
        self.count, parts, at = 0, [], 0

        def flush() -> None:
            text = _WHITE.sub(" ", _html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                path = tuple(n for _, _, n in stack if n)
                self.blocks.append((text, path, any(t in ("article", "main") for t, _, _ in stack)))

        def close(depth: int) -> None:
            del stack[depth:]

        token = _TOKEN.search(html)
        while token:
            if not stack[-1][1]:
                parts.append(html[at:token.start()])
            at = token.end()
            tag = (token[2] or "").lower()
            if not tag:
                pass
            elif token[1]:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                if depth:
                    if any(t in _BLOCKS for t, _, _ in stack[depth:]):
                        flush()
                    close(depth)
            else:
                if tag in _BLOCKS:
                    flush()
                    ended = {"p"} | _ENDS.get(tag, set())
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] in ended:
                            close(i)
                            break
                        if stack[i][0] in _BLOCKS:
                            break
                elif tag == "br" and not stack[-1][1]:
                    parts.append(" ")
                if tag in _RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>]|$)", re.I).search(html, at)
                    at = end.start() if end else len(html)
                    token = _TOKEN.search(html, at)
                    if token:
                        at = token.end()
                        token = _TOKEN.search(html, at)
                    continue
                if tag not in _VOID and not (token[3] or "").endswith("/"):
                    number = 0
                    if tag in _BLOCKS:
                        self.count += 1
                        number = self.count
                    out = stack[-1][1] or tag in _LEFT_OUT or (tag not in ("html", "body", "article", "main") and _set_apart(token[3] or ""))
                    out = out or (tag == "article" and bool(_NAMES.search(token[3] or "")) and "comment" in (token[3] or "").lower())
                    stack.append((tag, out, number))
            token = _TOKEN.search(html, at)
        if not stack[-1][1]:
            parts.append(html[at:])
        flush()
        if any(inside for _, _, inside in self.blocks):
            self.blocks = [b for b in self.blocks if b[2]]

    def subtrees(self) -> dict[int, int]:
        """Hash of the text of every element, by its number."""
        held: dict[int, list[str]] = {}
        for text, path, _ in self.blocks:
            for n in path:
                held.setdefault(n, []).append(text)
        return {n: xxhash.xxh3_64_intdigest("\n".join(t).encode("utf-8", "surrogatepass")) - (1 << 63) for n, t in held.items()}

    def content(self) -> int:
        """Hash of all blocks; equal pages have equal ones."""
        return xxhash.xxh3_64_intdigest("\n".join(b[0] for b in self.blocks).encode("utf-8", "surrogatepass")) - (1 << 63)

    def text(self, templates: set[int]) -> str:
        """The blocks outside of templates, joined by spaces. What holds all blocks is no template."""
        if not templates:
            return " ".join(b[0] for b in self.blocks)
        whole = self.content()
        gone = {n for n, h in self.subtrees().items() if h in templates and h != whole}
        return " ".join(t for t, path, _ in self.blocks if not gone.intersection(path))


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, contents, hashes = [], [], []
        for host, html in zip(batch["host"], batch["html"]):
            page = Page(html.as_py())
            own = [None, *set(page.subtrees().values())]
            hosts += [host.as_py()] * len(own)
            contents += [page.content()] * len(own)
            hashes += own
        yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(contents, pa.int64()), pa.array(hashes, pa.int64())],
                              names=["host", "content", "subtree"])


def templates(pages: DataFrame, pages_least: int = PAGES, share: float = SHARE) -> DataFrame:
    """(host, subtrees): hashes of the subtrees that recur on many pages of a host.

    Equal pages of a host, such as captures of an article by several urls, count as one. A host has at most
    1 / share times as many subtrees as its pages have on average, however many pages it has.
    """
    found = pages.select("host", "html").where("host != ''").mapInArrow(_hashes, "host string, content long, subtree long").distinct()
    counts = found.groupBy("host", "subtree").count()
    counts = staged(counts.where(F.col("subtree").isNull() | (F.col("count") >= pages_least)))  # null: the pages of the host
    sizes = counts.where("subtree IS NULL").select("host", F.col("count").alias("_pages"))
    many = counts.where("subtree IS NOT NULL").join(sizes, "host").where(F.col("count") >= share * F.col("_pages"))
    return many.groupBy("host").agg(F.collect_list("subtree").alias("subtrees"))


def extracted(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """`id`, `url` and `text`, the main text, of every row.

    Structure first: what is in menus, headers, footers, sidebars, notices, adverts, forms, comments,
    scripts and styles goes, by tag and by the words in class, id and role; where the page has an article,
    so does what is outside it. Of what is left, every element's text is hashed, hashes are counted over
    the different pages of a host, and elements that recur on many of them go too, unless they hold all that
    is left of the page. Character references are decoded,
    white space in a block becomes one space, and blocks are joined by one.

    A null or empty page has an empty text; pages with an unreadable url have no host, so nothing recurs there.
    Repeated rows appear as often and count as one page. Other columns are not read. An empty table gives no rows.
    """
    given = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"), host_of(F.col(url).cast("string")).alias("host"),
                         F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    found = staged(templates(given.select("host", "html")))
    few = found.agg(F.coalesce(F.sum(F.size("subtrees")), F.lit(0))).first()[0] <= FEW
    joined = given.join(F.broadcast(found) if few else found, "host", "left")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch[at:at + 512]
                texts = [Page(h.as_py()).text(set(s.as_py() or ())) for h, s in zip(some["html"], some["subtrees"])]
                yield pa.record_batch([some["id"], some["url"], pa.array(texts, pa.string())], names=["id", "url", "text"])

    kind = dict(given.dtypes)["id"]
    return joined.select("id", "url", "html", "subtrees").mapInArrow(run, f"id {kind}, url string, text string")
