"""Main text of web pages, with site templates removed.

Every page is parsed into a tree; the elements' subtrees are hashed and counted per
host in Spark, over pages of different content.  A subtree that recurs on many pages
of its host is template and is deleted, as are elements that are never article text
by their tag, role or class.  Text is read from the page's article (or main) element
if it has one, else from the whole body; what wraps such an element is no boilerplate
unless its tag is (nav, aside, footer), or its names speak of other articles.  Headings
inside an article stay whatever their names, and paragraphs unless their class is an ad.  Inside an article, running prose (headings,
paragraphs, quotes, preformatted text) is kept even if it recurs, as passages and
whole articles are copied between pages; a recurring group (list, section, division,
table, figure) is template there too.

Edge cases: a null or empty page gives an empty text; tags left open, stray end tags
and cut-off pages are parsed as far as they go; a null url is the host '' ; copies of
a page count once, so they are no template; repeated rows are extracted each on its
own; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import html as htmllib
import re

from pyspark.sql import DataFrame, functions as F, types as T

from rateflow.llm.common import settled, small_batches

MIN_PAGES = 10        # pages of different content that a template is on, at least
MIN_SHARE = 0.3       # and share of the host's
# Removal lists up to this many bytes are shipped to every task; larger ones are joined.
BROADCAST_BYTES = 8 << 20

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
DROPPED = set("""script style noscript template head title nav footer aside form button select textarea input
    iframe object embed svg canvas video audio map dialog menu noembed noframes xmp math""".split())
BLOCKS = set("""address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3
    h4 h5 h6 header hgroup hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 header hgroup".split())
PROSE = set("h1 h2 h3 h4 h5 h6 p pre blockquote".split())
ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
# Words of class and id names that mark boilerplate.
NAMES = set("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside footer header masthead topbar
    cookie cookies consent gdpr notice notices notification alert popup modal overlay
    comment comments discussion disqus replies respond share sharing social follow related recommended
    newsletter subscribe subscription signup login search pagination pager widget toolbar skip""".split())

# Those that mark an article element as something other than the page's article.
OTHER_ARTICLES = set("""ad ads advert advertisement sponsored promo promotion comment comments reply replies related
    recommended teaser""".split())

ADS = set("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored".split())

_markup = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
_attribute = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_name_words = re.compile(r"[a-z]+").findall
# An open element of the left kind ends where one of the right kind starts.
_CLOSES = {"p": BLOCKS - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
           "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}


class Node:
    __slots__ = ("tag", "attributes", "children", "key", "holds")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children, self.key = tag, attributes, [], 0
        self.holds = False      # whether an article or main element is below

    def is_boilerplate(self, in_article: bool) -> bool:
        """Whether the element is no article text by its tag, role or names."""
        if self.tag in DROPPED and not (self.holds and self.tag == "form"):
            return True
        if self.tag == "header" and not in_article and not self.holds:
            return True
        if not self.attributes or self.tag in ("html", "body", "main"):
            return False
        a = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _attribute.finditer(self.attributes)}
        if "hidden" in a or a.get("aria-hidden") == "true" or (a.get("role", "").lower() in ROLES and not self.holds):
            return True
        if "display:none" in a.get("style", "").replace(" ", "").lower():
            return True
        names = _name_words(f"{a.get('class', '')} {a.get('id', '')}".lower())
        if self.tag == "article" or self.holds:
            return any(n in OTHER_ARTICLES for n in names)
        if not in_article:
            return any(n in NAMES for n in names)
        # Inside an article, words of an id or a compound name are mostly its subject.
        if self.tag in HEADINGS:
            return False
        names = a.get("class", "").lower().split()
        if self.tag in PROSE:
            return any(n in ADS for n in names)
        return a.get("id", "").lower() in NAMES or any(
            n in NAMES or any(w in NAMES and w != "header" for w in _name_words(n)) for n in names)


def parse(page: str | None) -> Node:
    """The page's tree; text is kept as strings among an element's children."""
    root = Node("html")
    stack = [root]
    page = page or ""
    at, n = 0, len(page)
    while at < n:
        m = _markup.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].children.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        # Block tags end an open paragraph even if inline elements are open inside it.
        for k in range(len(stack) - 1, 0, -1):
            if tag in _CLOSES.get(stack[k].tag, ()):
                del stack[k:]
                break
            if stack[k].tag in BLOCKS:
                break
        if tag in ("html", "body") and any(x.tag == tag for x in stack):
            continue
        if tag in ("article", "main"):
            # An element that is never closed does not take the article in.
            for k in range(1, len(stack)):
                if stack[k].tag in ("nav", "aside", "form") and not _is_closed(page, at, stack[k].tag):
                    del stack[k:]
                    break
            for x in stack:
                x.holds = True
        node = Node(tag, m[3] or "")
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            stop = end.start() if end else n
            node.children.append(page[at:stop])
            close = page.find(">", stop)
            at = n if close < 0 else close + 1
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            stack.append(node)
    return root


def _is_closed(page: str, at: int, tag: str) -> bool:
    """Whether the end tag of an element that is open at a place follows."""
    depth = 1
    for m in _markup.finditer(page, at):
        if m[2] and m[2].lower() == tag:
            depth += -1 if m[1] else 1
            if depth == 0:
                return True
    return False


def _walk(root: Node):
    """Elements, children before their parent."""
    todo = [(root, False)]
    while todo:
        node, seen = todo.pop()
        if seen:
            yield node
        else:
            todo.append((node, True))
            todo += [(c, False) for c in node.children if isinstance(c, Node)]


def hash_subtrees(root: Node) -> None:
    """A key per element from its tag, names, text and children's keys.

    Addresses of links and other attributes take no part: templates vary in them.
    """
    import xxhash
    for node in _walk(root):
        parts = [node.tag]
        if node.attributes:
            parts += [f"{m[1].lower()}={m[2] or m[3] or m[4] or ''}" for m in _attribute.finditer(node.attributes)
                      if m[1].lower() in ("class", "id", "role")]
        for c in node.children:
            if isinstance(c, Node):
                parts.append(f"\x01{c.key}")
            elif c.strip():
                parts.append("\x02" + " ".join(c.split()))
        node.key = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _containers(root: Node) -> list[Node]:
    """The outermost article elements, else main elements, that are not boilerplate."""
    for tag in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node is not root and node.is_boilerplate(False):
                continue
            if node.tag == tag:
                found.append(node)
            else:
                todo += [c for c in reversed(node.children) if isinstance(c, Node)]
        if any(_text([x], set(), True) for x in found):
            return found
    return []


def _text(tops: list[Node], template: set[int], in_article: bool) -> str:
    """Blocks of the elements that stay, joined by blanks."""
    blocks: list[str] = []
    inline: list[str] = []

    def flush():
        words = htmllib.unescape("".join(inline)).split()
        if words:
            blocks.append(" ".join(words))
        inline.clear()

    todo: list = list(reversed(tops))
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            inline.append(x)
        elif not x.is_boilerplate(in_article) and not (
                x.key in template and x not in tops and not (in_article and x.tag in PROSE)):
            block = x.tag in BLOCKS
            if block:
                flush()
                todo.append(None)
            todo += reversed(x.children)
    flush()
    return " ".join(blocks)


def extract(page: str | None, template: set[int] | frozenset = frozenset()) -> str:
    """The main text of one whole page, without the subtrees whose keys are in ``template``."""
    root = parse(page)
    if template:
        hash_subtrees(root)
    inside = _containers(root)
    return _text(inside, template, True) if inside else _text([root], template, False)


def subtree_keys(page: str | None) -> tuple[int, list[int]]:
    """A hash of the page's main text, and the distinct keys of its subtrees with text."""
    import xxhash
    root = parse(page)
    hash_subtrees(root)
    inside = _containers(root)
    text = _text(inside or [root], set(), bool(inside))
    content = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
    keys = set()
    for node in _walk(root):
        if node is root or node.tag in ("html", "body", "head", "article", "main", "script", "style", "meta", "link", "br", "img"):
            continue
        keys.add(node.key)
    return content, sorted(keys)


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, key) of the subtrees that recur on many pages of their host.

    Rows are counted by (host, key, content) first and by (host, key) then: both are
    summed before their shuffles, and a host with a third of all pages is spread over
    its subtrees.
    """
    small_batches(pages.sparkSession)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            found = [subtree_keys(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c for c, _ in found], pa.int64()),
                 pa.array([k for _, k in found], pa.list_(pa.int64()))], names=["host", "content", "keys"])

    seen = pages.select("host", "html").mapInArrow(run, "host string, content long, keys array<long>").select(
        F.xxhash64("host").alias("host_key"), "content", "keys")
    # A page's own row, key null, counts the host's pages of different content.
    each = seen.select("host_key", "content", F.explode(F.concat(F.array(F.lit(None).cast("long")), "keys")).alias("key")).distinct()
    counts = each.groupBy("host_key", "key").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.where(F.col("n") >= min_pages)
    # As the host's own count is one of the frequent ones, if any is, this is a small table.
    frequent = settled(frequent)
    total = frequent.where("key IS NULL").select("host_key", F.col("n").alias("pages"))
    return (frequent.where("key IS NOT NULL").join(total, "host_key")
            .where(F.col("n") >= min_share * F.col("pages")).select("host_key", "key"))


def host_of(url):
    """Lower-case host of a url column; '' if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                  min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Per page: page_id, url, text and n_chars."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"),
                        host_of(F.col(url)).alias("host"))
    # One row per host, written to the shared checkpoint folder, so that its size is
    # known before a way to ship it is chosen.
    lists = settled(templates(rows, min_pages, min_share).groupBy("host_key").agg(F.collect_list("key").alias("keys")))
    size = lists.agg(F.sum(F.size("keys") * 8 + 16)).first()[0] or 0
    rows = rows.withColumn("host_key", F.xxhash64("host"))
    if size <= BROADCAST_BYTES:
        with_lists = rows.join(F.broadcast(lists), "host_key", "left")
    else:
        with_lists = rows.join(lists.hint("merge"), "host_key", "left")
    with_lists = with_lists.select("page_id", "url", "html", "host_key", "keys")
    small_batches(pages.sparkSession)

    def run(batches):
        import pyarrow as pa
        known: dict = {}
        for batch in batches:
            texts = []
            for page, host, keys in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = frozenset(keys.as_py() or ())
                texts.append(extract(page, known[host]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    schema = T.StructType([T.StructField("page_id", pages.schema[page_id].dataType), T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return with_lists.mapInArrow(run, schema)
