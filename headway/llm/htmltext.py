"""Main text of web pages by site template removal.

A first pass hashes each page's element subtrees; Spark counts, per host, the
different pages that hold a subtree and keeps those that recur.  A second pass
deletes these subtrees.  Only then, for what a count can't tell as it differs on each
page (adverts, comments) or as its host has too few pages, elements go that are no
article by their tag, role or class; the blocks of the largest article are written,
or of ``main`` or the body where there is none.

Where no article is marked, a block is a template if MIN_PAGES different pages and
MIN_SHARE of its host's hold it; on small hosts FEW_PAGES that are FEW_SHARE of them
are enough for a block that is no bare paragraph, heading or list item.  It must be
the smaller part of the page.  Of several articles on a page, one that recurs beside
different other ones is a template.

Inside an article recurrence alone says nothing: copies of an article, and passages
that articles share, are content.  There a block is a template if it recurs around
different articles, told apart by their longest text outside the block, is the
smaller part of each, and either is mostly links or is a container (no bare
paragraph, heading or list item) that stands in one slot on nearly all its pages.
"""

from __future__ import annotations

import re
from functools import lru_cache
from hashlib import blake2b
from html import unescape
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, pieces, save

#: A subtree is a template if at least so many different pages of its host hold it, and this share of them.
MIN_PAGES, MIN_SHARE = 5, 0.1
FEW_PAGES, FEW_SHARE = 3, 0.5
#: Parts that the pages of a host are dealt to when they meet its templates.
PARTS = 8
#: Inside an article: the share of a block's pages on which it stands in one slot, and the share of its text in links from which the slot doesn't matter.
SAME_SLOT, LINKED = 0.8, 0.5

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp template svg canvas object math".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
TEXT_BLOCK = set("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
#: Elements with text blocks that may be templates inside an article by their slot.
CONTAINER = set("address article center details div dl figure ol section table ul".split())
NEVER = set("head nav footer aside form button select input textarea dialog menu search optgroup option datalist label legend fieldset".split()) | RAW
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status note".split())
#: Words of a class or id that say that an element is no article.
CLASS_WORDS = set(
    "ad ads advert adverts advertisement adsense adslot sponsor sponsored sponsors promo promotion promoted banner cookie cookies consent gdpr "
    "notice notices notification popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside widget widgets "
    "footer footers masthead topbar share sharing social related recommended recommendations newsletter subscribe subscription signup signin login "
    "comment comments commentlist disqus respond reply replies pagination pager toolbar hidden paywall search form".split()
)
#: Words that may follow such a word in a name, as in ``sidebar-left``, and words before it that make it a state, as in ``no-sidebar``.
TAIL_WORDS = set(
    "area bar block bottom box btn button buttons container content form group heading icons inner item items left line link links list message outer "
    "panel posts primary right row secondary section slot text title top unit wrap wrapper zone".split()
)
STATE_WORDS = set("no not has have with without hide hides show shows is can enable disable allow".split())
#: Names of reader comments, which go however long they are.
COMMENT_WORDS = set("comment comments commentlist disqus respond reply replies".split())
#: An element with at least this share of the text around it is no advert, menu or form by its name.
MOST = 0.5
#: An end of an element that a start tag implies: tag: (tags it ends, tags at which the search stops).
_P_ENDS = BLOCK - {"html", "body", "caption", "dd", "dt", "legend", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "figcaption", "summary"}
_LISTS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "option": ({"option"}, {"select"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tbody": ({"thead", "tbody"}, {"table"})}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "attributes", "children", "hash", "size", "linked", "content")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.attributes, self.children, self.hash, self.size, self.linked = tag, attributes, [], 0, 0, 0
        self.content = tag in TEXT_BLOCK or tag in ("article", "main", "section")


def parse(page: str) -> Node:
    """A tree of elements and texts; ends that HTML lets out are put in."""
    root = Node("#page", "")
    stack, at = [root], 0

    def end(k: int) -> None:
        del stack[k:]

    def put(text: str) -> None:
        if text:
            stack[-1].children.append(unescape(text) if "&" in text else text)

    while m := _TAG.search(page, at):
        put(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            k = len(stack) - 1
            while k and stack[k].tag != tag:
                # an end tag of an inline element doesn't end blocks
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    k = 0
                    break
                k -= 1
            if k:
                end(k)
            continue
        if tag in _P_ENDS or tag in _LISTS:
            ends, stop = _LISTS.get(tag, ({"p"}, {"article", "aside", "button", "div", "section", "table", "td", "th", "main", "li", "body", "blockquote"}))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    end(k)
                    if tag not in _LISTS or tag != "tr":
                        break
                elif stack[k].tag in stop:
                    break
        node = Node(tag, m[3] or m[6] or "")
        stack[-1].children.append(node)
        if tag in RAW:
            close = _closing(tag).search(page, at)
            at = close.end() if close else len(page)
        elif tag not in VOID and not node.attributes.endswith("/"):
            stack.append(node)
        elif tag not in VOID and tag in BLOCK:
            stack.append(node)  # the slash means nothing for these
    put(page[at:])
    return root


@lru_cache(maxsize=64)
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)


def _names(token: str) -> str:
    """The word that says what a class or id names: the last one but for TAIL_WORDS and numbers; none for a state."""
    words = [w.lower() for w in _WORD.findall(token)]
    if not words or words[0] in STATE_WORDS:
        return ""
    # body text of a named part ("social-text") is told by its size
    while len(words) > 1 and (words[-1] in TAIL_WORDS and words[-1] not in CLASS_WORDS or words[-1].isdigit()):
        words.pop()
    return words[-1]


@lru_cache(maxsize=20_000)
def marks(attributes: str) -> tuple[frozenset, str, bool, frozenset]:
    """Words of class and id, the role, whether the element is hidden, and what its classes and id name."""
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    names = f"{found.get('class', '')} {found.get('id', '')}"
    words = frozenset(w.lower() for w in _WORD.findall(names))
    style = found.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
    return words, found.get("role", "").lower(), hidden, frozenset(_names(t) for t in names.split())


def _finish(node: Node) -> None:
    """Hashes and text sizes of a tree, and whether it holds text blocks, from its leaves up, without recursion."""
    order, todo = [], [node]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += [c for c in x.children if isinstance(c, Node)]
    for x in reversed(order):
        digest = blake2b(f"{x.tag}\0{' '.join(sorted(marks(x.attributes)[0])) if x.attributes else ''}".encode(), digest_size=8)
        for c in x.children:
            if isinstance(c, Node):
                digest.update(c.hash.to_bytes(8, "big"))
                x.size += c.size
                x.linked += c.linked
                x.content = x.content or c.content
            else:
                bare = " ".join(c.split())
                digest.update(b"\1" + bare.encode("utf-8", "surrogatepass"))
                x.size += len(bare)
        if x.tag == "a":
            x.linked = x.size
        # the last bit tells bare text blocks
        x.hash = int.from_bytes(digest.digest(), "big") & ~1 | (x.tag in TEXT_BLOCK)


def unwanted(node: Node, in_article: bool, around: int, prose: bool = False) -> bool:
    """Whether tag, role or names say that an element is no article; ``around`` is the size of the text that it is part of.

    Names, roles and forms say nothing of an element with most of that text, unless it
    is mostly links, and names nothing of an inline element inside a sentence (``prose``).
    """
    most = node.size >= MOST * around and node.linked < LINKED * node.size
    inline = prose and node.tag not in BLOCK
    if node.tag in NEVER and not (node.tag in ("form", "fieldset") and most) or (node.tag == "header" and not in_article):
        return True
    if node.attributes and node.tag not in ("html", "body", "main"):
        _, role, hidden, names = marks(node.attributes)
        if hidden or not names.isdisjoint(COMMENT_WORDS) and not inline:
            return True
        if most or inline:
            return False
        return role in ROLES or not names.isdisjoint(CLASS_WORDS) or ("header" in names and not in_article and node.tag != "article")
    return False


def has_text(node: Node) -> bool:
    """Whether an element holds text of its own, so that inline elements in it are parts of sentences."""
    return any(isinstance(c, str) and not c.isspace() for c in node.children)


def articles(page: Node, gone: frozenset = frozenset()) -> dict[str, list[Node]]:
    """Articles and mains that aren't deleted and stand in no other article."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [(page, False)]
    while todo:
        x, inside = todo.pop()
        if x is not page and (x.hash in gone and x.tag in BLOCK and not inside or unwanted(x, inside, page.size)):
            continue
        role = marks(x.attributes)[1] if x.attributes else ""
        kind = "article" if x.tag == "article" or role == "article" else "main" if x.tag == "main" or role == "main" else ""
        if kind and not (kind == "article" and gone and _id(x.hash, "article") in gone):
            found[kind].append(x)
        # an article in an article is part of it
        todo += [(c, inside) for c in x.children if isinstance(c, Node)] if kind != "article" else []
    return found


def article_of(page: Node, gone: frozenset = frozenset()) -> Node:
    """The largest article that isn't deleted, else the largest main, else the page."""
    found = articles(page, gone)
    # the later of equals is the first on the page
    return max(reversed(found["article"] or found["main"] or [page]), key=lambda x: x.size)


def subtrees(page: Node, root: Node) -> set[int]:
    """Hashes of the subtrees that may be templates: blocks with text, but no text blocks of the article, nor what holds them."""
    out, todo = set(), [(page, False)]
    while todo:
        x, inside = todo.pop()
        inside = inside or (x is root and root is not page)
        if x.tag in BLOCK and x.tag not in ("html", "body") and x.size and not (inside and x.content) and (root is not page or 2 * x.size <= page.size):
            out.add(x.hash)
        todo += [(c, inside) for c in x.children if isinstance(c, Node)]
    return out


def _id(*parts) -> int:
    return int.from_bytes(blake2b(repr(parts).encode(), digest_size=8).digest(), "big")


def inner(root: Node) -> list[tuple[Node, int, tuple[int, ...]]]:
    """Blocks with text blocks inside an article that may be templates, with an id and the ids of their slots; none of slots for mostly links."""
    out: list = []
    todo: list = [(root, 0)]
    while todo:
        x, path = todo.pop()
        nodes = [c for c in x.children if isinstance(c, Node)]
        for k, c in enumerate(nodes):
            if c.tag in BLOCK and c.content and c.size and 2 * c.size <= root.size:
                if c.linked >= LINKED * c.size:
                    out.append((c, _id(c.hash, "links"), ()))
                elif c.tag in CONTAINER:
                    out.append((c, _id(c.hash, "any"), (_id(c.hash, path, "start", k), _id(c.hash, path, "end", len(nodes) - k))))
        # a path is a checksum, so that deep trees stay cheap
        todo += [(c, crc32(c.tag.encode("utf-8", "surrogatepass"), path)) for c in nodes]
    return out


def rests(root: Node, found: list) -> list[int]:
    """For each block found, a hash of the longest text of the article outside it."""
    wanted = {id(x) for x, _, _ in found}
    texts, spans = [], {}
    todo: list = [(root, False)]
    while todo:
        x, done = todo.pop()
        if done:
            spans[id(x)] = (spans[id(x)][0], len(texts))
        elif isinstance(x, str):
            if bare := " ".join(x.split()):
                texts.append((len(bare), bare))
        else:
            if id(x) in wanted:
                spans[id(x)] = (len(texts), 0)
                todo.append((x, True))
            todo += [(c, False) for c in reversed(x.children)]
    # the longest text before and after each place
    ahead, behind = [(0, "")], [(0, "")]
    for t in texts:
        ahead.append(max(ahead[-1], t))
    for t in reversed(texts):
        behind.append(max(behind[-1], t))
    ends = [spans[id(x)] for x, _, _ in found]
    return [_id(max(ahead[a], behind[len(texts) - b])) for a, b in ends]


def blocks(page: Node, gone: frozenset) -> list[str]:
    root = article_of(page, gone)
    away = {id(x) for x, own, slots in inner(root) if not gone.isdisjoint(slots or (own,))} if gone and root is not page else set()
    out, held = [], []

    def flush() -> None:
        if text := " ".join("".join(held).split()):
            out.append(text)
        held.clear()

    todo: list = [(root, root.tag == "article", False)]
    while todo:
        x, inside, prose = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        elif x is not root and (id(x) in away or (x.hash in gone and x.tag in BLOCK and not (root is not page and x.content)) or unwanted(x, inside, root.size, prose)):
            if x.tag in BLOCK:
                flush()
        elif x.tag == "br":
            held.append(" ")
        else:
            inside = inside or x.tag == "article"
            # what stands in an inline element of a sentence is part of that sentence
            prose = has_text(x) or prose and x.tag not in BLOCK
            own = [(c, inside, prose) for c in reversed(x.children)]
            if x.tag in BLOCK:
                flush()
                own.insert(0, (None, inside, False))
            todo += own
    flush()
    return out


def main_text(page: str | None, gone: frozenset = frozenset()) -> str:
    if not page:
        return ""
    tree = parse(page)
    _finish(tree)
    return "\n\n".join(blocks(tree, gone))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def rivals(page: Node) -> list[tuple[int, int]]:
    """For each of several articles of a page, its id and the hash of the largest other one."""
    found = sorted(articles(page)["article"], key=lambda x: -x.size)
    return [(_id(x.hash, "article"), found[k == 0].hash) for k, x in enumerate(found)] if len(found) > 1 else []


def templates(pages: DataFrame) -> DataFrame:
    """host and hash of recurring subtrees, from rows (host, own, hashes, inner); pages with equal articles count once.

    Blocks inside an article count once for each rest of the article; slots go on where they hold nearly all of that count.
    """
    different = pages.select("host", "own").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    held = pages.select("host", "own", F.explode("hashes").alias("hash")).distinct().groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= FEW_PAGES)
    blocks_in = pages.select("host", F.explode("inner").alias("x")).select("host", F.col("x.block").alias("block"), F.col("x.hash").alias("hash"), F.col("x.rest").alias("rest")).distinct()
    counted = blocks_in.groupBy("host", "block", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_PAGES)
    whole = counted.filter(F.col("block") == F.col("hash")).select("host", "block", F.col("n").alias("of"))
    fixed = counted.join(whole, ["host", "block"]).filter(F.col("n") >= F.col("of") * SAME_SLOT).select("host", "hash", "n", F.lit(False).alias("loose"))
    many = (F.col("n") >= MIN_PAGES) & (F.col("n") >= F.col("pages") * MIN_SHARE)
    half = F.col("loose") & (F.col("n") >= F.col("pages") * FEW_SHARE)
    return held.withColumn("loose", F.col("hash") % 2 == 0).unionByName(fixed).join(different, "host").filter(many | half).select("host", "hash").distinct()


def extract(df: DataFrame, html: str = "html", url: str = "url", text: str = "text") -> DataFrame:
    """``df`` with ``text``, the main text of each page; blocks are parted by an empty line.

    A null or empty page has the empty text.  Pages without a host take no part in
    template counts and lose no template.  Repeated rows come out alike.  A column of
    ``df`` named ``text`` is replaced.  An empty table stays empty.
    """
    rest = df.select(*[c for c in df.columns if c != text])
    kept = rest.columns
    k1, k2, host, away = free_names(kept, "_k1", "_k2", "_host", "_gone")
    keys = [k1, k2]
    keyed = rest.withColumns({k1: F.xxhash64(url, html), k2: F.xxhash64(F.lit(1), html, url)})
    name = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))

    def look(batches):
        for b in pieces(batches, html):
            own, hashes, within = [], [], []
            for page in b.column(html).to_pylist():
                tree = parse(page or "")
                _finish(tree)
                root = article_of(tree)
                own.append(_signed(root.hash))
                hashes.append([_signed(h) for h in subtrees(tree, root)])
                found = inner(root) if root is not tree else []
                around = rests(root, found) if found else []
                rival = [{"block": _signed(h), "hash": _signed(h), "rest": _signed(r)} for h, r in rivals(tree)]
                within.append(rival + [{"block": _signed(h), "hash": _signed(s), "rest": _signed(r)} for (_, h, slots), r in zip(found, around, strict=True) for s in (h, *slots)])
            names = ["k1", "k2", "host"]
            arrays = [pa.array(own, pa.int64()), pa.array(hashes, pa.list_(pa.int64())), pa.array(within, pa.list_(pa.struct([(k, pa.int64()) for k in ("block", "hash", "rest")])))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *arrays], [*names, "own", "hashes", "inner"])

    looked = keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.xxhash64(name).alias("host"), html).filter(name != "")
    seen = save(looked.mapInArrow(look, "k1 long, k2 long, host long, own long, hashes array<long>, inner array<struct<block: long, hash: long, rest: long>>"), "subtrees")
    # a large host's templates meet its pages in parts
    part = F.pmod(F.xxhash64("k1"), F.lit(PARTS)).cast("int")
    held = seen.select("k1", "k2", "host", part.alias("part"), F.explode(F.concat("hashes", F.col("inner.hash"))).alias("hash"))
    found = held.join(templates(seen).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))), ["host", "hash", "part"])
    gone = found.groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.collect_set("hash").alias(away))
    both = keyed.join(gone, keys, "left").drop(*keys)

    def write(batches):
        for b in pieces(batches, html):
            sets = [frozenset(x % (1 << 64) for x in g or ()) for g in b.column(away).to_pylist()]
            texts = [main_text(p, g) for p, g in zip(b.column(html).to_pylist(), sets, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, text])

    return both.mapInArrow(write, T.StructType([*rest.schema.fields, T.StructField(text, T.StringType())]))
