"""Main text of web pages by site style trees.

The pages of one host are merged into one tree. A node of it is a path of block
elements with their classes; its statistics come from all pages of the host:

* presentation importance: entropy of the sequences of children that the node
  has on different pages (a template part looks alike everywhere);
* content importance: one minus the entropy of each of its text blocks over the
  pages (a block on one page counts 1, a block on all pages 0), averaged over
  the blocks and reduced by the share of linked text;
* both are composed with weights by the number of children, and a branch whose
  nodes all stay below ``LEAST`` is template.

A node is judged by the pages on which it occurs, three at least, so the size of
its host does not matter. Pages of a host with the same text count once, so that
copies do not look like templates.

Statistics alone cannot see through menus and adverts that differ on every page,
so branches whose element, class, id or role says what they are have importance
0 from the start, and where a page marks its article, only that part is taken.
Outside marked articles all blocks of a template branch go. Inside, only
containers (``CONTAINERS``) are template, and only their blocks whose text stands
in the same place of three pages go: shared passages among an article's
paragraphs and what a page has of its own stay.

Statistics are merged on the map side and dealt by node. What goes is joined to
pages by (host, path, text) and listed per page, so no list grows with the host.

Results of ``extract`` (one row per row of the input):

* a null or empty page has the text "" and 0 characters; truncated or broken markup is read as far as it goes;
* a null url or one without a host takes part without statistics, as do hosts with fewer than three pages;
* repeated rows count as pages of their own; null ids stay; an empty table gives an empty table;
* other columns than the three named are not read, so they never clash.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm.common import batches_of, column_of, kept, read_table

LEAST = 0.3
LEAST_PAGES = 3
CHILD_WEIGHT = 0.9
DEPTH = 24  # deeper blocks count with their ancestor at this depth
BROADCAST_BYTES = 8_000_000
NODES = "host string, path string, kind int, feature long, page long, children int, chars long, linked long, below int"
TEXTS = "page_id long, url string, text string, n_chars long"

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"},
          "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table tbody thead tfoot tr article main section div body html td th blockquote".split())

# What elements and their names say.
NOISE_TAGS = frozenset("""nav footer aside form head button select input label fieldset legend datalist output dialog
menu template svg math canvas object audio video map""".split()) | RAW
NOISE_NAMES = frozenset("""ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner
menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead topbar toolbar cookie cookies consent
gdpr privacy notice notification alert popup modal overlay newsletter subscribe subscription signup login comment
comments commentlist respond replies reply disqus discussion share sharing social related recommended widget pagination
pager copyright search skip""".split())
NOISE_ROLES = frozenset("""navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar
toolbar tablist status tooltip""".split())
MAIN_TAGS = frozenset(["article", "main"])
PLAIN_TAGS = frozenset("html body article main".split())
CONTAINERS = ("div", "section", "ul", "ol", "dl", "table", "aside")  # what may be template inside a marked article

_markup = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+[^>]*)>?", re.S)
_attribute = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_name_word = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


class Node(NamedTuple):
    tag: str
    path: str
    block: bool
    noise: bool
    main: str  # path of the marked article around it, or ""
    children: list


class Block(NamedTuple):
    text: str
    path: str
    linked: int
    main: str


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(F.trim(url), _HOST, 1)), F.lit(""))


def ancestors(path: Column) -> Column:
    """The path and all its ancestors but the root."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _attribute.finditer(source)}


def is_noise(tag: str, named: dict[str, str], inside_main: bool) -> bool:
    """What the element's own name, classes, id and role say."""
    if tag in NOISE_TAGS or (tag == "header" and not inside_main):
        return True
    if not named or tag in PLAIN_TAGS:
        return False
    if named.get("role", "").lower() in NOISE_ROLES or "hidden" in named or named.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", named.get("style", "")):
        return True
    words = {w.lower() for key in ("class", "id") for w in _name_word.findall(named.get(key, ""))}
    found = words & NOISE_NAMES
    return bool(found - {"header"} if inside_main else found)


class OpenElements:
    """The open elements of a page, counted by tag since the last block and since the last scope.

    A tag looks down the stack only for an element that is known to be there, and
    closes what it passes, so any markup, however broken, is read in linear time.
    """

    def __init__(self, root: Node):
        self.nodes, self.block_at, self.scope_at = [root], [0], [0]
        self.counts: Counter = Counter()

    def keys(self, depth: int) -> list[tuple]:
        tag = self.nodes[depth].tag
        return [("open", tag), ("since block", self.block_at[depth - 1], tag), ("since scope", self.scope_at[depth - 1], tag)]

    def push(self, node: Node) -> None:
        depth = len(self.nodes)
        self.nodes.append(node)
        self.block_at.append(depth if node.block else self.block_at[-1])
        self.scope_at.append(depth if node.tag in SCOPES else self.scope_at[-1])
        self.counts.update(self.keys(depth))

    def pop(self) -> Node:
        for key in self.keys(len(self.nodes) - 1):
            self.counts[key] -= 1
            if not self.counts[key]:
                del self.counts[key]
        self.block_at.pop()
        self.scope_at.pop()
        return self.nodes.pop()

    def holder(self) -> Node:
        """The block around the present place."""
        return self.nodes[self.block_at[-1]]

    def to_close(self, tag: str) -> int:
        """Where an end tag finds its element, or 0: an inline one only within the present block."""
        key = ("since block", self.block_at[-1], tag) if tag in INLINE else ("open", tag)
        return self.nearest({tag}) if key in self.counts else 0

    def implied(self, tags: frozenset | set) -> int:
        """The nearest of the tags up to and including the last scope, or 0."""
        scope = self.scope_at[-1]
        if (scope and self.nodes[scope].tag in tags) or any(("since scope", scope, tag) in self.counts for tag in tags):
            return self.nearest(tags)
        return 0

    def nearest(self, tags: frozenset | set) -> int:
        depth = len(self.nodes) - 1
        while self.nodes[depth].tag not in tags:
            depth -= 1
        return depth


def parse(source: str | None) -> tuple[list[Block], list[Node]]:
    """The text blocks outside noise, in page order, and all block nodes that are not noise."""
    source = source or ""
    root = Node("", "", True, False, "", [])
    opened, nodes, blocks = OpenElements(root), [root], []
    buffer: list[tuple[str, bool]] = []
    at, links = 0, 0

    def flush() -> None:
        if buffer:
            holder = opened.holder()
            text = " ".join(entities.unescape("".join(t for t, _ in buffer)).split())
            if text:
                linked = sum(len(entities.unescape(t).strip()) for t, in_link in buffer if in_link)
                blocks.append(Block(text, holder.path, linked, holder.main))
            buffer.clear()

    def close(depth: int) -> None:
        nonlocal links
        if opened.block_at[-1] >= depth:
            flush()
        while len(opened.nodes) > depth:
            links -= opened.pop().tag == "a"

    def take(end: int) -> None:
        if end > at and not opened.nodes[-1].noise:
            buffer.append((source[at:end], links > 0))

    for m in _markup.finditer(source):
        if m.start() < at:
            continue  # inside raw text
        take(m.start())
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if depth := opened.to_close(tag):
                close(depth)
            continue
        if tag == "br":
            if not opened.nodes[-1].noise:
                buffer.append((" ", False))
            continue
        if tag in RAW:  # its content is no markup and no text of the page
            end = re.compile(f"</{tag}", re.I).search(source, at)
            at = end.start() if end else len(source)
            continue
        block = tag not in INLINE
        if block:
            flush()
            closing = CLOSES.get(tag, frozenset())
            while depth := opened.implied({*closing, "p"}):
                own = opened.nodes[depth].tag
                close(depth)
                if own == "p" and not closing:
                    break
        if tag in VOID:
            continue
        up, holder = opened.nodes[-1], opened.holder()
        named = attributes(m[3]) if m[3].strip(" /") else {}
        noise = up.noise or is_noise(tag, named, bool(up.main))
        path = holder.path
        if block:
            names = re.sub(r"\d+", "#", " ".join(sorted(named.get("class", "").split()) + [named.get("id", "")]).strip().replace("/", "_"))
            style = f"{tag}.{names}" if names else tag
            if path.count("/") < DEPTH:
                path = f"{path}/{style}"
            if not holder.noise:
                holder.children.append(style)
        marked = tag in MAIN_TAGS or named.get("role") == "main"
        node = Node(tag, path, block, noise, up.main or (path or "/" if marked else ""), [])
        links += tag == "a"
        opened.push(node)
        if block and not noise:
            nodes.append(node)
    take(len(source))
    flush()
    return blocks, nodes


def chosen(blocks: list[Block]) -> list[Block]:
    """The blocks of marked articles, or all of a page without any."""
    return [b for b in blocks if b.main] or blocks


def feature_of(block: Block) -> int:
    """64 bits of a digest of the text: own text is not taken for a template's by chance."""
    return int.from_bytes(hashlib.blake2b(block.text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def main_text(source: str | None, gone: set[tuple[str, int]]) -> str:
    """The chosen blocks without those whose path and feature are in ``gone``."""
    blocks = chosen(parse(source)[0])
    left = [b for b in blocks if (b.path, feature_of(b)) not in gone] if gone else blocks
    return "\n".join(b.text for b in left or blocks)  # statistics alone never empty a page


def page_key(html: Column) -> Column:
    return F.xxhash64(html)


def node_rows(pages: DataFrame) -> DataFrame:
    """Per page (told by a hash of its text) and node: its sequence of children (kind 0) and its text blocks (kind 1), each once.

    One more row (kind 2) has the key of the page's source. ``below`` is the length of the marked article's path, or 0.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for host, key, source in zip(*(c.to_pylist() for c in batch.columns)):
                blocks, nodes = parse(source)
                own = "\n".join(b.text for b in chosen(blocks)).encode()
                page = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little", signed=True)
                seen = {(n.path, 0, zlib.crc32("|".join(n.children).encode())): (len(n.children), 0, 0, 0) for n in nodes}
                for b in blocks:
                    seen[b.path, 1, feature_of(b)] = (0, len(b.text), min(b.linked, len(b.text)), len(b.main))
                seen["", 2, key] = (0, 0, 0, 0)
                rows += [(host, *node, page, *value) for node, value in seen.items()]
            yield from batches_of([rows], NODES)

    return pages.where("host IS NOT NULL").select("host", page_key(F.col("html")), "html").mapInArrow(run, NODES)


def broadcast_below(df: DataFrame, size: Column, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if the sum of ``size`` over its rows allows it; else the optimizer decides."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= limit else df


def low_branches(counted: DataFrame, least: float) -> DataFrame:
    """(host, branch): the branches of low importance."""
    def total(kind: int, value: Column) -> Column:
        return F.sum(F.when(F.col("kind") == kind, value))

    pages = F.col("pages")
    own = counted.where("path <> ''").groupBy("host", "path").agg(
        total(0, pages).alias("seen"), total(0, pages * F.log("pages")).alias("sequences"),
        total(0, F.col("children")).alias("children"), total(1, pages).alias("texts"),
        total(1, pages * F.log("pages")).alias("repeated"),
        (1 - F.sum("linked") / F.greatest(F.sum("chars"), F.lit(1))).alias("unlinked"))
    most = F.log(F.greatest(F.col("seen"), F.lit(LEAST_PAGES)))  # entropy of a feature that is once on each page of the node
    fresh = 1 - F.col("repeated") / F.col("texts") / most
    weight = F.pow(F.lit(CHILD_WEIGHT), F.col("children") / F.col("seen"))
    presentation = (F.log("seen") - F.col("sequences") / F.col("seen")) / most
    content = F.coalesce(fresh * F.col("unlinked"), F.lit(0.0))
    scored = own.select("host", "path", "seen", F.when(
        F.col("children") > 0, F.greatest((1 - weight) * presentation, content)).otherwise(content).alias("importance"))
    judged = scored.withColumn("branch", F.explode(ancestors(F.col("path")))).groupBy("host", "branch").agg(
        F.max("importance").alias("importance"),
        F.max(F.when(F.col("path") == F.col("branch"), F.col("seen"))).alias("seen"))
    return judged.where((F.col("importance") < least) & (F.col("seen") >= LEAST_PAGES)).select("host", "branch")


def template_blocks(pages: DataFrame, least: float = LEAST, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(host, key, gone): per page, told by the key of its source, its (path, feature) of blocks that are template."""
    rows = kept(node_rows(pages).groupBy("host", "path", "kind", "feature", "page").agg(
        *(F.max(c).alias(c) for c in ("children", "chars", "linked", "below"))))
    counted = kept(rows.where("kind < 2").groupBy("host", "path", "kind", "feature").agg(
        F.count("*").alias("pages"), F.sum("children").alias("children"), F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"), F.max("below").alias("below")))
    low = kept(low_branches(counted, least))
    low = broadcast_below(low, F.length("host") + F.length("branch") + 16, broadcast_bytes)
    tag = F.regexp_extract("branch", r"([^/.]*)[^/]*$", 1)
    may = (F.col("below") == 0) | ((F.length("branch") > F.col("below")) & tag.isin(*CONTAINERS))
    paths = counted.where("kind = 1 AND path <> ''").groupBy("host", "path", "below").agg(F.count("*").alias("texts")).withColumn(
        "branch", F.explode(ancestors(F.col("path")))).where(may).join(low, ["host", "branch"]).select(
        "host", "path", "below").distinct()
    paths = broadcast_below(kept(paths), F.length("host") + F.length("path") + 16, broadcast_bytes)
    texts = counted.where("kind = 1").join(paths, ["host", "path", "below"]).where(
        (F.col("below") == 0) | (F.col("pages") >= LEAST_PAGES)).select("host", "path", "feature")
    texts = broadcast_below(kept(texts), F.length("host") + F.length("path") + 24, broadcast_bytes)
    gone = rows.where("kind = 1").join(texts, ["host", "path", "feature"]).groupBy("host", "page").agg(
        F.collect_list(F.struct("path", "feature")).alias("gone"))
    keys = rows.where("kind = 2").select("host", F.col("feature").alias("key"), "page")
    # Pages of different texts with one key can share lists: they name path and text of what goes.
    return kept(keys.join(gone, ["host", "page"]).groupBy("host", "key").agg(F.flatten(F.collect_list("gone")).alias("gone")))


def extract(pages: DataFrame, least: float = LEAST, id_column: str = "page_id", url_column: str = "url",
            html_column: str = "html", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The main text of every page."""
    own = pages.select(column_of(pages, id_column, "long").alias("page_id"),
                       column_of(pages, url_column, "string").alias("url"),
                       column_of(pages, html_column, "string").alias("html")).withColumn("host", host_of(F.col("url")))
    templates = template_blocks(own, least, broadcast_bytes)
    templates = broadcast_below(templates, F.length("host") + F.length(F.to_json("gone")), broadcast_bytes)
    joined = own.withColumn("key", page_key(F.col("html"))).join(templates, ["host", "key"], "left")

    def run(batches):
        for batch in batches:
            rows = []
            for page_id, url, source, gone in zip(*(c.to_pylist() for c in batch.columns)):
                text = main_text(source, {(g["path"], g["feature"]) for g in gone or ()})
                rows.append((page_id, url, text, len(text)))
            yield from batches_of([rows], TEXTS)

    return joined.select("page_id", "url", "html", "gone").mapInArrow(run, TEXTS)


def op10_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
