"""Main text of web pages, after removal of what a site repeats."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import light, ship, stored, table

MANY = 4  # distinct pages of a host at least that make a subtree part of its template
SHARE = 0.1  # and that part of the host's pages
MOST = 0.5  # the part of them for subtrees within articles, which revisions repeat too, and for shapes
SMALL = 10  # an element with a shape holds at most the page's text by this number
TEXTS, STORY, SHAPE = 0, 1, 2  # last two bits of a mark: digest of a subtree with texts, of one within an article, of a shape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
# What a start tag ends when it is still open, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
NO_TEXT = frozenset(
    "script style noscript template head title nav footer aside form iframe object svg canvas button select textarea menu dialog audio"
    " video datalist map".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice"
    " notices alert popup modal overlay newsletter subscribe subscription signup login menu nav navbar navigation breadcrumb breadcrumbs"
    " pagination pager sidebar footer copyright comment comments commentlist respond disqus replies share sharing social related"
    " recommended widget toolbar skip ad-slot ad-banner ad-container cookie-banner cookie-notice cookie-consent main-nav site-nav main-menu"
    " nav-menu nav-bar site-footer page-footer main-footer left-sidebar right-sidebar sidebar-left sidebar-right social-links social-share"
    " share-buttons sharing-buttons share-links related-posts related-articles related-links comment-list comments-area comments-section"
    " newsletter-signup skip-link user-comments reader-comments comment-section comment-thread comments-list comment-item comment-body"
    " comment-form ad-unit ad-box ad-wrapper adsbygoogle".split())
COMMENTS = frozenset(n for n in NAMES if "comment" in n)  # an article of such a name is a reader's
LINKS = frozenset("widget skip related recommended share sharing".split())  # within an article only of elements that are mostly links
PROSE = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li td th dd dt figure figcaption".split())  # no part of an article by name
INNER_NAMES = NAMES - frozenset("social notice notices promotion alert".split())  # words of an article's own parts
OUTER_NAMES = frozenset("header masthead topbar site-header page-header main-header".split())  # of the site, but of the text within an article


class Node:
    __slots__ = ("tag", "names", "role", "parts", "children", "mark", "size", "story", "form")

    def __init__(self, tag: str, names: frozenset, role: str):
        self.tag, self.names, self.role = tag, names, role
        self.parts: list[str] = []  # what the mark is a digest of
        self.children: list = []  # texts and nodes, in order
        self.mark = 0
        self.form: int | None = -1  # its shape, once asked for
        self.size = 0  # characters of text within
        self.story = tag in ("html", "body", "main", "article") or role == "main"  # or holds one


class Tree(HTMLParser):
    """The elements of a page, each with a digest of its subtree: tag, names, texts and the children's digests."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("", frozenset(), "")
        self.open = [self.root]
        begin = html.rfind("<!--")
        if begin >= 0 and html.find("-->", begin) < 0 and "</" not in html[begin:]:
            html = html[:begin]  # a comment that never ends holds the rest
        self.feed(html)
        self.close()
        while self.open:
            self.shut()

    def shut(self) -> None:
        from xxhash import xxh3_64_intdigest

        node = self.open.pop()
        said = "\0".join([node.tag, *sorted(node.names), "", *node.parts])
        node.mark = xxh3_64_intdigest(said.encode("utf-8", "replace")) - 2**63
        if self.open:
            self.open[-1].parts.append(str(node.mark))
            if node.tag not in NO_TEXT:
                self.open[-1].size += node.size
                self.open[-1].story |= node.story

    def end(self, tags, limit) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                while len(self.open) > k:
                    self.shut()
                return
            if self.open[k].tag in limit:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end({"p"}, BLOCKS - {"p"})
        if tag in ENDS:
            self.end(*ENDS[tag])
        said = dict(attrs)
        names = frozenset(re.sub("[_-]+", "-", f"{said.get('class') or ''} {said.get('id') or ''}".lower()).split())
        node = Node(tag, names, (said.get("role") or "").strip().lower())
        self.open[-1].children.append(node)
        self.open.append(node)
        if tag in VOID:
            self.shut()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag != "p":
            self.end({tag}, ())

    def handle_endtag(self, tag):
        if tag not in VOID:
            self.end({tag}, ())

    def handle_data(self, data):
        self.open[-1].children.append(data)
        if text := " ".join(data.split()):
            self.open[-1].parts.append(text)
            self.open[-1].size += len(text)


def nodes(root: Node, stop=lambda node: False):
    """All elements below `root` in page order; those below a stopped one are left out."""
    stack = [root]
    while stack:
        node = stack.pop()
        if node is not root:
            yield node
            if stop(node):
                continue
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))


def linked(node: Node) -> bool:
    return 2 * sum(n.size for n in nodes(node, lambda n: n.tag == "a") if n.tag == "a") >= node.size


def aside(node: Node, outer: bool, whole: int = 0) -> bool:
    """Whether an element is no part of a text by its tag, role or names, which are whole values of class and id.

    Names tell nothing of elements that hold an article or over half of the page's `whole` text, but
    of readers' comments, nor of paragraphs and headings within an article.
    """
    if node.tag in NO_TEXT or node.role in ROLES or outer and node.tag == "header":
        return True
    if outer and node.tag == "article":
        return bool(node.names & COMMENTS) or 2 * node.size <= whole and bool(node.names & NAMES)
    if outer:
        return not node.story and 2 * node.size <= whole and bool(node.names & (NAMES | OUTER_NAMES))
    names = node.names & INNER_NAMES
    return bool(names) and node.tag not in PROSE and (not names <= LINKS or linked(node))


def typed(mark: int, kind: int) -> int:
    return mark & ~3 | kind


def shape(node: Node, whole: int) -> int | None:
    """Digest of the tags and names below a small element by depth, without texts, numbers and repeats; None without a name."""
    from xxhash import xxh3_64_intdigest

    if node.form != -1:
        return node.form
    node.form = None
    if node.story or not (node.names or node.role) or not 0 < SMALL * node.size <= whole:
        return None
    said, stack = set(), [(0, node)]
    while stack:
        depth, n = stack.pop()
        said.add(f"{depth} {n.tag} {n.role} {' '.join(sorted(re.sub('[0-9]+', '', x) for x in n.names))}")
        stack += [(depth + 1, c) for c in n.children if isinstance(c, Node) and c.tag in BLOCKS]
    node.form = typed(xxh3_64_intdigest("\n".join(sorted(said)).encode("utf-8", "replace")) - 2**63, SHAPE)
    return node.form


def marks(root: Node) -> list[int]:
    """Marks of the elements that hold text, each once: outside of articles by texts and by shape, blocks within them by texts."""
    found = set()
    for n in nodes(root, lambda n: n.tag == "article"):
        if n.tag == "article":
            found |= {typed(c.mark, STORY) for c in nodes(n) if c.parts and c.tag in BLOCKS}
        elif n.parts and n.tag not in ("html", "body"):
            found |= {typed(n.mark, TEXTS), shape(n, root.size)}
    return sorted(found - {None})


def page_marks(html: str | None) -> tuple[int, list[int]]:
    """A digest of the page's main text, which copies share, and its marks."""
    from xxhash import xxh3_64_intdigest

    root = Tree(html or "").root
    return xxh3_64_intdigest(chosen_text(root, frozenset()).encode("utf-8", "replace")) - 2**63, marks(root)


def main_text(html: str | None, template: frozenset) -> str:
    """Blocks of the main text, joined by blank lines.

    Subtrees whose mark is in `template` go; so do elements that their tag, role or names tell to be
    no text. The text is what is left of the articles, else of the main element, else of the page.
    Where the template would leave nothing of a text, it is not applied.
    """
    root = Tree(html or "").root
    text = chosen_text(root, template)
    return text if text or not template else chosen_text(root, frozenset())


def chosen_text(root: Node, template: frozenset) -> str:
    def gone(node):
        if node.tag != "article" and (typed(node.mark, TEXTS) in template or template and shape(node, root.size) in template):
            return True
        return aside(node, True, root.size)

    def left_out(node):
        return node.tag in BLOCKS and typed(node.mark, STORY) in template or aside(node, False)

    left = [n for n in nodes(root, lambda n: gone(n) or n.tag == "article") if not gone(n)]
    chosen = [n for n in left if n.tag == "article"]
    if not chosen:
        mains = [n for n in left if n.tag == "main" or n.role == "main"][:1]
        return "\n\n".join(blocks(mains or [root], gone))
    return "\n\n".join(blocks(chosen, left_out))


def blocks(chosen: list[Node], gone) -> list[str]:
    out, now = [], []

    def flush():
        if text := " ".join("".join(now).split()):
            out.append(text)
        now.clear()

    stack: list = list(reversed(chosen))
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            now.append(item)
        elif item.tag == "br":
            now.append(" ")
        elif not gone(item) or item in chosen:
            if item.tag in BLOCKS or not item.tag:
                flush()
                stack.append(None)
            stack.extend(reversed(item.children))
        elif item.tag in BLOCKS:
            flush()
    flush()
    return out


def host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """Columns host, template: marks of subtrees that stand on many distinct pages of the host.

    A subtree with its texts goes if a tenth of the pages have it (`SHARE`), within an article if half
    of them do (`MOST`), as revisions and copies of passages repeat paragraphs too. A shape, which is
    a small named subtree whatever its texts, also goes from half of them on. Pages of the same main text are one page. Copies and sums are folded before the shuffle, so a host with
    most of the pages is no heavy task. As a page has few elements and a template's stand on a tenth
    of the pages, a host's list is short.
    """
    def run(batches):
        for batch in batches:
            found = [page_marks(h.as_py()) for h in batch["html"]]
            columns = [batch["host"], pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "page", "marks"])

    seen = stored(pages.select("host", "html").mapInArrow(run, "host string, page long, marks array<long>").distinct(), "marks")
    sized = seen.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    each = seen.select("host", "page", F.explode("marks").alias("mark")).distinct()
    counted = each.groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n"))
    share = F.when(F.pmod("mark", F.lit(4)) == TEXTS, SHARE).otherwise(MOST)
    common = counted.where(F.col("n") >= MANY).join(sized, "host").where(F.col("n") >= share * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list("mark").alias("template"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns id, url, text for every row: the main text, with character references decoded.

    White space inside a block is one space, blocks are joined by an empty line. A null or
    empty page has an empty text; rows without a host form one site. Repeated rows stay.
    """
    ship(pages.sparkSession.sparkContext)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"),
                        F.col(html_col).alias("html"))
    repeated = stored(templates(rows), "templates")

    def run(batches):
        for batch in batches:
            found = [main_text(h, frozenset(t or ())) for h, t in zip(batch["html"].to_pylist(), batch["template"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["url"], pa.array(found, pa.string())], names=["id", "url", "text"])

    kinds = [T.StructField(n, rows.schema[n].dataType) for n in ("id", "url")]
    joined = rows.join(light(repeated, "template"), "host", "left")
    return joined.mapInArrow(run, T.StructType([*kinds, T.StructField("text", T.StringType())]))


def op7_pages(spark, folder: str) -> DataFrame:
    found = extract(table(spark, folder, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
