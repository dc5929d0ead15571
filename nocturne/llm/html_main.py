"""Main text of web pages by consensus host paths.

1. Each page's containers are scored by the text they hold outside links, boilerplate and form
   fields, with hints from tag and class names.
2. Pages vote: the score of a container goes to its generalised path (tags and classes from the
   root, digits struck out), summed per host in Spark. A host may have several layouts: the paths that
   hold much of most pages they occur on win, in order of votes.
3. Every page is read again and the container on the first of its host's winning paths that holds a
   fair share of the page's own best score is rendered. On a page with little text for its host any
   winning path will do; other pages fall back to their own best container.
4. An article in several containers side by side is put together: paths with the same parent as a winning
   one that win a share of the votes too are its companions, and what stands between the parts
   belongs to them unless it is mostly links.

Boilerplate is told by elements, by class or id names and by repetition: a container whose text is the
same on all pages of a host that have it, at least half of them, is furniture. A name counts if all its
words speak of page furniture ("share-price" and "no-sidebar" don't), or for a box if its first word
is an unmistakable one ("ad-300x250", "comment-thread"). Neither a name nor a form is a
ground to drop what holds most of the page's text. Work is linear in the page: paths are rolling
hashes that pass from parent to child, and the parser never climbs further than it closes.

Votes are partial sums before the shuffle, so a host with a third of all pages is no hot group. The
winning paths are broadcast behind a check of their number; beyond it, pages are joined by salted
host.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .url_filter import host_of

BROADCAST_HOSTS = 200_000
SALTS = 16
FAIR = 0.5  # of the page's best score, of the host's mean best score, and of votes over pages
COMPANION = 0.2  # of the best score: what a container beside the main one holds, by votes and on the page
REST = 0.05  # of the parts' score: what a further box before or after them holds
CONSTANT_PAGES, CONSTANT = 4, 0.5  # pages of a host, at least, and their share, on which a box with one text is furniture
SUPPORT = 0.01  # of a host's pages, as votes; rarer paths are left to the page's own best container
#: Fixed lists of element and class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIP = frozenset("script style noscript template head title nav header footer aside form button select textarea input iframe svg canvas object embed audio video dialog menu xmp noembed noframes".split())
BLOCK = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article main section div td body".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion comment comments disqus respond replies reply sidebar side nav navbar navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social related recommended widget toolbar pagination pager tracking skip".split()
)
FURNITURE = frozenset("site page global top bottom left right first second primary secondary block box bar area section container wrapper wrap inner outer holder slot zone unit module panel list item items link links button buttons icon icons text label title main mobile desktop sticky fixed js google dfp".split())
ABOUT = frozenset("post posts article articles entry entries story stories reader readers user users".split())  # with other noise than headers and footers
#: First words that tell a box whatever follows, words that turn them round, and the elements that are boxes.
PLAIN = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion comment comments disqus cookie cookies consent gdpr newsletter popup modal breadcrumb breadcrumbs".split())
TURNED = frozenset("no not non without free has with".split())
BOXES = frozenset("div section ul ol dl table span".split())
KEEPABLE = frozenset("form dialog".split())  # elements that are furniture, but may hold the whole page
GOOD = frozenset("article content main post entry body text story".split())

#: A comment, a declaration or a tag. Quotes hold an attribute value only after "="; possessive, so that nothing is read twice.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>", re.S)
TAG_START = re.compile(r"<[a-zA-Z/!?]")
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
NAME = re.compile(r"[A-Z]*[a-z]+|[A-Z]+")
EMPTY = re.compile(r"(?:^|[\s\"'])/$")
WALLS = frozenset("td th table article main body".split())  # what most end tags don't reach over
THROUGH = frozenset("table tr tbody article main body html section div".split())  # the end tags that do
SCOPES = frozenset("ul ol table select dl tbody thead".split())
#: The open elements that a new one ends.
ALIKE = {"li": ("li",), "option": ("option",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "dd": ("dd", "dt"), "dt": ("dd", "dt")}
STEP, MODULUS = 1_000_003, (1 << 61) - 1  # of the rolling hash of paths


class Node:
    __slots__ = ("children", "dropped", "good", "hash", "held", "hint", "holds", "label", "noise", "order", "own", "parent", "sig", "size", "tag")

    def __init__(self, tag: str, label: str, parent: Node | None, noise: bool = False, good: bool = False):
        self.tag, self.label, self.parent, self.children = tag, label, parent, []
        self.noise, self.good = noise, good
        self.hash = (parent.hash * STEP + _label_hash(label)) % MODULUS if parent is not None else 0
        self.own = self.size = self.sig = 0
        self.held, self.holds, self.dropped, self.hint = 0.0, False, False, False
        self.order: list[Node] = []  # of the root: all nodes, parents first

    def path(self, most: int = 12) -> str:
        """The innermost steps from the root, for people to read; ``hash`` stands for the whole path."""
        part, at = [], self
        while at.parent is not None and len(part) < most:
            part.append(at.label)
            at = at.parent
        return ">".join([*(["..."] if at.parent is not None else []), *reversed(part)])


_label_hashes: dict[str, int] = {}


def _label_hash(label: str) -> int:
    if label not in _label_hashes:
        if len(_label_hashes) > 50_000:
            _label_hashes.clear()
        _label_hashes[label] = int.from_bytes(hashlib.blake2b(label.encode("utf-8", "replace"), digest_size=8).digest(), "big") % MODULUS
    return _label_hashes[label]


def noisy(token: str, box: bool = False) -> bool:
    """Whether all words of a class or id speak of page furniture, one of them of boilerplate; of a box, whether its first word does."""
    named = [w.lower() for w in NAME.findall(token)]
    words = set(named)
    if box and named and named[0] in PLAIN and not words & TURNED:
        return True
    told = words & NOISE
    rest = words - NOISE - FURNITURE
    return bool(told) and (not rest or (rest <= ABOUT and not told & {"header", "footer", "title"}))


def _names(attributes: str, box: bool) -> tuple[set[str], bool, bool]:
    """(words of class, id, role and itemprop, whether one names boilerplate, whether one names content)."""
    words: set[str] = set()
    noise = good = False
    for a in ATTRIBUTE.finditer(attributes):
        if a.group(1).lower() in ("class", "id", "role", "itemprop"):
            for token in (a.group(2) or a.group(3) or a.group(4) or "").split():
                words.update(w.lower() for w in re.findall("[A-Za-z]+", token))
                noise |= noisy(token, box)
                good |= token.lower() in GOOD
    return words, noise, good


def parse(source: str) -> Node:
    """A tolerant tree: implied ends of p, li, td, tr and options; strayed end tags are ignored."""
    root = Node("#root", "", None)
    order, open_ = [root], [root]
    where: dict[str, list[int]] = {}  # places in open_ by tag, and of blocks, walls and item scopes
    blocks, walls, scopes = [], [], []

    def close(to: int) -> None:
        while len(open_) > to:
            node, at = open_.pop(), len(open_)
            where[node.tag].pop()
            for places in (blocks, walls, scopes):
                if places and places[-1] == at:
                    places.pop()

    def put_text(text: str) -> None:
        open_[-1].children.append(text)
        if bare := text.strip():
            open_[-1].own += len(bare)
            open_[-1].sig = (open_[-1].sig * STEP + zlib.crc32(bare.encode("utf-8", "replace"))) % MODULUS

    if unfinished := TAG_START.search(source, source.rfind(">") + 1):  # a tag that the page ends in is dropped
        source = source[: unfinished.start()]
    pos = 0
    for m in iter(lambda: TOKEN.search(source, pos), None):
        if m.start() > pos:
            put_text(source[pos : m.start()])
        pos = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if (places := where.get(tag)) and (tag in THROUGH or not walls or walls[-1] <= places[-1]):
                close(places[-1])
            continue
        if tag in CLOSES_P and blocks and open_[blocks[-1]].tag == "p":
            close(blocks[-1])
        if alike := ALIKE.get(tag):
            at = next((i for i in reversed(scopes) if open_[i].tag in SCOPES or open_[i].tag in alike), 0)
            while open_[at].tag in alike:
                close(at)
                at -= 1
        words, noise, good = _names(m.group(3), tag in BOXES) if m.group(3) else ((), False, False)
        node = Node(tag, ".".join([tag, *sorted(words)]), open_[-1], tag in SKIP or (noise and tag not in ("html", "body", "article", "main")), good)
        node.hint = not GOOD.isdisjoint(words)
        order.append(node)
        open_[-1].children.append(node)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[^>]*+>", re.I).search(source, pos)
            pos = end.end() if end else len(source)
        elif tag not in VOID and not EMPTY.search(m.group(3)):
            at = len(open_)
            open_.append(node)
            where.setdefault(tag, []).append(at)
            for kind, places in ((BLOCK, blocks), (WALLS, walls)):
                if tag in kind:
                    places.append(at)
            if tag in SCOPES or tag in ALIKE:
                scopes.append(at)
    if pos < len(source):
        put_text(source[pos:])
    root.order = order
    _keep_wrappers(order)
    return root


def _keep_wrappers(order: list[Node]) -> None:
    """A name or a form is no ground to drop what holds most of the page's text and looks like its content.

    That is so if it is also named as content, has an article or main element, or if the page has
    hardly any other text. Nodes with more than half of the text lie within one another, so each
    node is looked at once.
    """
    clean = {}
    for node in reversed(order):  # size: text of the subtree; clean: of its part that nothing inside drops
        node.size += node.own
        clean[id(node)] = clean.get(id(node), 0) + node.own
        if (up := node.parent) is not None and (node.tag not in SKIP or node.tag in KEEPABLE):
            up.sig = (up.sig * STEP + node.sig) % MODULUS
            up.size += node.size
            up.holds |= node.holds or node.tag in ("article", "main")
            if not node.noise:
                clean[id(up)] = clean.get(id(up), 0) + clean[id(node)]
    outside = clean[id(order[0])]
    for node in order:
        if node.noise and (node.tag not in SKIP or node.tag in KEEPABLE) and 2 * node.size > order[0].size:
            if node.good or node.holds or 10 * outside <= node.size:
                node.noise = False
                outside += clean[id(node)]


def scores(root: Node) -> list[tuple[float, Node]]:
    """Containers with their scores, in page order: own text, half that of child containers, hints of names."""
    for node in root.order:
        node.dropped = node.noise or (node.parent is not None and node.parent.dropped)
        node.held = 0.0
    for node in reversed(root.order):
        if not node.dropped:
            node.held += node.own * (0.1 if node.tag == "a" else 1.0)
            if node.parent is not None:
                node.parent.held += node.held * (0.5 if node.tag in CONTAINER else 0.2 if node.tag == "a" else 1.0)
    hint = {"article": 3.0, "main": 2.5, "section": 1.2, "body": 0.8}
    return [(n.held * hint.get(n.tag, 1.0) * (1.5 if n.hint else 1.0), n) for n in root.order if n.tag in CONTAINER and n.held > 0 and not n.dropped]


def render(node: Node) -> str:
    """Blocks in page order: references decoded, white space made one space, joined by line ends."""
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        if text := " ".join(html.unescape("".join(line)).split()):
            blocks.append(text)
        line.clear()

    stack: list = [node]
    while stack:
        item = stack.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            line.append(item)
        elif item.tag == "br":
            line.append(" ")
        elif item is node or not item.noise:
            if item.tag in BLOCK:
                close()
                stack.append(None)
            stack.extend(reversed(item.children))
    close()
    return "\n".join(blocks)


def best(root: Node) -> Node:
    """The container of highest score, the first among equals; the whole page if none holds text."""
    found = scores(root)
    return max(found, key=lambda s: s[0])[1] if found else root


def _link_share(node: Node) -> float:
    """Characters inside links over all that aren't dropped."""
    text = links = 0
    stack = [(node, node.tag == "a")]
    while stack:
        at, inside = stack.pop()
        text += at.own
        links += at.own if inside else 0
        stack.extend((c, inside or c.tag == "a") for c in at.children if isinstance(c, Node) and not c.noise)
    return links / text if text else 0.0


def on_path(found: list[tuple[float, Node]], path: int) -> list[Node]:
    """The outermost containers on a path (a node that lies on it holds no other one: its path is longer), from the first to the last that isn't mostly links."""
    nodes = [n for _, n in found if n.hash == path]
    plain = [i for i, n in enumerate(nodes) if _link_share(n) <= 0.5] if len(nodes) > 1 else []
    return nodes[plain[0] : plain[-1] + 1] if plain else nodes


def together(found: list[tuple[float, Node]], nodes: list[Node], companions: set[int] | None) -> list[Node]:
    """The parts of the article: ``nodes`` with their companions and what belongs to them, as nodes to render.

    Companions lie beside a node on one of the given paths (without a host's paths, on any) and
    hold a fair share of its score. Between parts stands what isn't mostly links; before and after
    them blocks that aren't boxes, and boxes of some size without many links.
    """
    score = {id(n): s for s, n in found}
    parent = nodes[0].parent
    if parent is None or any(n.parent is not parent for n in nodes):
        return nodes
    least = COMPANION * max(score.get(id(n), 0.0) for n in nodes)
    chosen = {id(n) for n in nodes}
    parts = chosen | {id(c) for c in parent.children if isinstance(c, Node) and score.get(id(c), 0.0) >= max(least, 1e-9) and (companions is None or c.hash in companions) and _link_share(c) <= 0.5}
    if len(parts) < 2:
        return nodes
    places = [i for i, c in enumerate(parent.children) if id(c) in parts]
    total = sum(score.get(p, 0.0) for p in parts)

    def belongs(i: int, c: Node | str) -> bool:
        inside = places[0] < i < places[-1]
        if isinstance(c, str):
            return inside
        if id(c) in parts:
            return True
        if c.noise or (links := _link_share(c)) > 0.5:
            return False
        if inside:
            return True
        return score.get(id(c), 0.0) >= REST * total and links <= 0.2 if c.tag in CONTAINER else c.tag in BLOCK and parts != chosen

    whole = Node("div", "", None)
    whole.children = [c for i, c in enumerate(parent.children) if belongs(i, c)]
    return [whole]


def votes(pages: DataFrame) -> DataFrame:
    """host, hash, parent, path, votes, pages, lo, hi, main_lo, main_hi: each page gives its containers' scores, as shares of its best one's.

    ``lo`` and ``hi`` are the least and the greatest signature of the texts on a path: equal if all pages have
    the same; ``main_lo`` and ``main_hi`` those of the best containers of these pages. The hash null has the sum of the best scores and the number of pages that have one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, int | None], tuple[int, ...]] = {}
            names: dict[int | None, tuple[str | None, int | None]] = {None: (None, None)}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = scores(parse(page.as_py() or ""))
                top, main = max(((s, n.sig) for s, n in found), default=(0.0, 0), key=lambda x: x[0])
                own: dict[int | None, list[int]] = {None: [round(top), 0]} if found else {}
                for s, node in found:
                    if node.hash not in names:
                        names[node.hash] = (node.path(), None if node.parent is None else node.parent.hash)
                    mine = own.setdefault(node.hash, [0, 0])
                    mine[0] += round(1000 * s / top) if s >= 0.2 * top else 0
                    mine[1] = (mine[1] * STEP + node.sig) % MODULUS
                for path, (vote, sig) in own.items():
                    v, n, lo, hi, main_lo, main_hi = total.get((host, path), (0, 0, sig, sig, main, main))
                    total[host, path] = (v + vote, n + 1, min(lo, sig), max(hi, sig), min(main_lo, main), max(main_hi, main))
            columns = [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.int64()), pa.array([names[k[1]][1] for k in total], pa.int64()), pa.array([names[k[1]][0] for k in total], pa.string())]
            columns += [pa.array([x[i] for x in total.values()], pa.int64()) for i in range(6)]
            yield pa.RecordBatch.from_arrays(columns, ["host", "hash", "parent", "path", "votes", "pages", "lo", "hi", "main_lo", "main_hi"])

    hosts = pages.select(host_of(F.col("url")).alias("host"), "html")
    rows = hosts.mapInArrow(run, "host string, hash long, parent long, path string, votes long, pages long, lo long, hi long, main_lo long, main_hi long")
    ends = [f(p + n).alias(p + n) for p in ("", "main_") for n, f in (("lo", F.min), ("hi", F.max))]
    return rows.groupBy("host", "hash").agg(F.min("parent").alias("parent"), F.min("path").alias("path"), F.sum("votes").alias("votes"), F.sum("pages").alias("pages"), *ends)


def winners(counted: DataFrame) -> DataFrame:
    """host, path (of most votes, the first in order among equals), paths (hashes of all that win, in this order), typical, the mean
    best score, companions (hashes of paths beside a winning one) and constant (hashes of boxes with one text, on pages whose main texts differ).
    """
    hosts = counted.where("hash is null").select("host", (F.col("votes") / F.col("pages")).alias("typical"), F.col("pages").alias("all"))
    named = counted.where("hash is not null").join(hosts, "host")
    ranked = F.struct((-F.col("votes")).alias("v"), "path", "hash", "parent")
    wins = (F.col("votes") >= FAIR * 1000 * F.col("pages")) & (F.col("votes") >= SUPPORT * 1000 * F.col("all"))
    beside = (F.col("votes") >= COMPANION * 1000 * F.col("pages")) & (F.col("votes") >= SUPPORT * 1000 * F.col("all"))
    constant = (F.col("lo") == F.col("hi")) & (F.col("main_lo") < F.col("main_hi")) & (F.col("pages") >= CONSTANT_PAGES) & (F.col("pages") >= CONSTANT * F.col("all"))
    grouped = named.groupBy("host").agg(
        F.min(ranked).alias("w"), F.array_sort(F.collect_list(F.when(wins, ranked))).alias("all"), F.first("typical").alias("typical"), F.array_sort(F.collect_list(F.when(beside, F.struct("hash", "parent")))).alias("beside"), F.array_sort(F.collect_list(F.when(constant, F.col("hash")))).alias("constant")
    )
    fellows = F.filter("beside", lambda b: F.exists("all", lambda w: (w["parent"] == b["parent"]) & (w["hash"] != b["hash"])))
    return grouped.select("host", F.col("w.path").alias("path"), F.col("all.hash").alias("paths"), "typical", F.transform(fellows, lambda b: b["hash"]).alias("companions"), "constant")


def choose(root: Node, paths: list[int], typical: float, companions: list[int] | None = None, constant: list[int] | None = None) -> str:
    """The page's text: that on a winning path of its host, or of its own best container, with the parts beside it."""
    if constant:
        known = set(constant)
        for node in root.order:
            if node.hash in known and node.tag in CONTAINER and 2 * node.size <= root.size:
                node.noise = True
    found = scores(root)
    if not found:
        return render(root)
    top, own = max(found, key=lambda s: s[0])
    wanted, held = set(paths), {}
    for s, node in found:
        if node.hash in wanted:
            held[node.hash] = max(held.get(node.hash, 0.0), s)
    fair = [p for p in paths if held.get(p, 0.0) >= FAIR * top]
    if not fair and held and top < FAIR * typical:
        fair = [max(held, key=lambda p: (held[p], -paths.index(p)))]
    text = "\n".join(filter(None, map(render, together(found, on_path(found, fair[0]), set(companions or ()))))) if fair else ""
    return text or "\n".join(filter(None, map(render, together(found, [own], None))))


def extract(pages: DataFrame, scratch: Scratch, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """page_id, url, text, n_chars and host_path (the end of the host's first path) of every row of pages.

    Null and empty html give an empty text. A null url or one without host belongs to the empty
    host, whose pages vote together. Nesting of any depth is read in linear time. Repeated rows stay;
    more columns are ignored.
    """
    won = scratch.put(winners(scratch.put(votes(pages), "votes")), "host_paths")
    scratch.drop("votes")
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    if won.count() <= broadcast_hosts:
        chosen = keyed.join(F.broadcast(won), "host", "left")
    else:
        salted = won.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        chosen = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (3, 4, 6, 7)]
            texts = [choose(parse(page.as_py() or ""), paths or [], typical or 0.0, companions, constant) for page, paths, typical, companions, constant in zip(batch.column(2), *columns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), batch.column(5)], ["page_id", "url", "text", "n_chars", "host_path"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return chosen.select("page_id", "url", "html", "paths", "typical", "path", "companions", "constant").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, host_path string")
