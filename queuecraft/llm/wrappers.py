"""Main text of web pages by wrapper induction: pages of one host are aligned with the host's common tree by simple tree
matching; what stays the same in a node from page to page is template, what varies is content."""

from __future__ import annotations

import html
import re
import sys

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.llm.common import written
from queuecraft.llm.registry import query

CONSTANT = 0.6          # share of a host's unlike pages with the same text in the same node, from which on it is template
PAGES = 5               # unlike pages that must have the node before that is asked
LINKS = 0.5             # share of a block's characters inside links from which on it is a menu, outside articles
SENT = 32 << 20         # bytes of wrappers up to which they go to every task; beyond it they meet the pages by a shuffle
HOT = 1000              # hosts with more than one HOT-th of all pages are dealt over several tasks
DEEP = 100_000          # Python frames that pages of deep nesting may take
CACHED = 100_000        # a worker's table of tree shapes is emptied beyond this

# What HTML means: fixed values.
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th
    thead tr ul caption head title noscript template""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
CLOSES = {**{t: ("p", "head") for t in BLOCKS}, **{t: () for t in ("html", "head", "title", "noscript", "template")}, "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"),
          "tr": ("tr", "td", "th", "p"),
          "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",), "optgroup": ("optgroup", "option"),
          "tbody": ("thead", "tbody", "tr", "td", "th", "p"), "tfoot": ("thead", "tbody", "tr", "td", "th", "p")}
BOUNDS = set("table ul ol dl div section article main aside nav footer header form body menu select td th".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
# Elements and names that are never main text.
NOT_TEXT = set("""head nav aside footer form menu dialog search noscript template button select option optgroup label fieldset legend input
    svg math canvas object audio video map script style title textarea xmp iframe noembed noframes""".split())
NOT_TEXT_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NOT_TEXT_NAMES = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr
    notice notices popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar widget widgets footer masthead topbar
    comment comments disqus reply replies respond share sharing social related recommended recommendations newsletter subscribe
    subscription login signup signin searchbox pager pagination toolbar skip""".split())

TOKEN = re.compile(r"""<!--(?:.*?--!?>|.*)|</?([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"'>]|$)""", re.I)


class Node:
    """A block element, or a block of text (tag "#")."""

    __slots__ = ("tag", "name", "parent", "children", "text", "links", "skip", "holds")

    def __init__(self, tag, name=frozenset(), parent=None, skip=False):
        self.tag, self.name, self.parent, self.skip = tag, name, parent, skip
        self.children, self.text, self.links, self.holds = [], "", 0, False


def names_of(attributes: str):
    """Words of class and id, and whether role or hidden rule the element out."""
    words, out = set(), False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id"):
            words.update(re.split(r"[^a-z]+", value))
        elif name == "role":
            out |= value.strip() in NOT_TEXT_ROLES
        elif name == "hidden":
            out |= value != "until-found"
        else:
            out |= value.strip() == "true"
    words.discard("")
    return frozenset(words), out


def parse(page: str | None) -> Node:
    """The tree of block elements and blocks of text. Inline elements are only marks inside a block."""
    root = Node("#root")
    stack, at, text = [root], 0, page or ""
    pieces, links, link = [], 0, False
    silent = 0                                      # open inline elements whose text does not count
    bodies: dict[str, Node] = {}

    def flush():
        nonlocal pieces, links, link
        if pieces:
            own = " ".join("".join(pieces).split())
            if own:
                above = stack[-1]
                while above.tag == "#silent":
                    above = above.parent
                leaf = Node("#", parent=above)
                leaf.text, leaf.links = own, links
                above.children.append(leaf)
            pieces = []
        links, link = 0, False

    def close(node):
        nonlocal silent
        while stack[-1] is not node:
            silent -= stack[-1].tag == "#silent"
            stack.pop()
        silent -= node.tag == "#silent"
        stack.pop()

    def say(chunk):
        nonlocal links
        if chunk and not silent:
            chunk = html.unescape(chunk)
            pieces.append(chunk)
            if link:
                links += len(chunk.strip())

    n = len(text)
    while at < n:
        found = TOKEN.search(text, at)
        if found is None:
            say(text[at:])
            break
        say(text[at:found.start()])
        at = found.end()
        tag = (found.group(1) or found.group(3) or "").lower()
        if not tag:
            continue
        if text[found.start() + 1] == "/":
            if tag in BLOCKS:
                for node in reversed(stack):
                    if node.tag == tag:
                        flush()
                        close(node)
                        break
                    if tag == "p" and node.tag in BOUNDS:
                        break
            elif tag == "a":
                link = False
            elif silent:
                for node in reversed(stack):
                    if node.tag == "#silent" and node.text == tag:
                        close(node)
                        break
                    if node.tag != "#silent":
                        break
            continue
        attributes = found.group(2) or found.group(4) or ""
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(text, at)
            at = end.end() if end else n
            continue
        if tag in BLOCKS:
            flush()
            for node in reversed(stack):
                if node.tag in CLOSES[tag]:
                    close(node)
                elif node.tag in BOUNDS or node is root:
                    break
            if tag in VOID:
                continue
            name, out = names_of(attributes) if attributes else (frozenset(), False)
            node = Node(tag, name, stack[-1], out)
            stack[-1].children.append(node)
            stack.append(node)
            if tag in ("article", "main"):
                bodies.setdefault(tag, node)
        elif tag == "br":
            flush()
        elif tag == "a":
            link = True
        elif tag not in VOID:
            name, out = names_of(attributes) if attributes else (frozenset(), False)
            if (out or tag in NOT_TEXT or name & NOT_TEXT_NAMES) and not attributes.rstrip().endswith("/"):
                node = Node("#silent", parent=stack[-1])
                node.text = tag
                stack.append(node)
                silent += 1
    flush()
    above = bodies.get("main", bodies.get("article"))
    while above is not None:
        above.holds, above = True, above.parent
    return root


def judged(root: Node):
    """(block, kept by its elements, in an article) of every block of text in page order."""
    out = []
    todo = [(root, True, False, False)]
    while todo:
        node, keep, article, header = todo.pop()
        if node.tag == "#":
            out.append((node, keep and not header and (article or node.links <= LINKS * len(node.text)), article))
            continue
        named = node.tag not in ("html", "body", "main") and not (node.holds and node.tag != "article")     # not around the main part
        if node.tag in NOT_TEXT or node.skip or named and node.name & NOT_TEXT_NAMES:
            keep = False
        if node.tag == "header" or named and "header" in node.name and node.tag not in HEADINGS:
            header = True
        if header and article and node.tag in HEADINGS:
            header = False                          # of an article's own header the headings stay
        article |= node.tag in ("article", "main")
        todo.extend((child, keep, article, header) for child in reversed(node.children))
    return out


class Group:
    """Siblings of one shape that follow each other, as one node. shape: a number of the label and the children's shapes."""

    __slots__ = ("shape", "members", "children", "label", "size")

    def __init__(self, label, children, members):
        self.label, self.children, self.members = label, children, members
        self.shape = xxhash.xxh64_intdigest(f"{label}({','.join(str(c.shape) for c in children)})")
        self.size = 1 + sum(c.size for c in children)

    def spelled(self) -> str:
        out, todo = [], [self]
        while todo:
            part = todo.pop()
            if isinstance(part, str):
                out.append(part)
                continue
            out.append(part.label)
            if part.children:
                inside = [x for c in part.children for x in (",", c)][1:]
                todo += [")", *reversed(inside), "("]
        return "".join(out)


def label_of(node: Node) -> str:
    return ".".join([node.tag, *sorted(node.name)])


def merged(groups: list[Group]) -> list[Group]:
    out: list[Group] = []
    for group in groups:
        if out and out[-1].shape == group.shape:
            last = out[-1]
            last.members += group.members
            for mine, more in zip(last.children, group.children):
                pour(mine, more)
        else:
            out.append(group)
    return out


def pour(mine: Group, more: Group):
    todo = [(mine, more)]
    while todo:
        a, b = todo.pop()
        a.members += b.members
        todo.extend(zip(a.children, b.children))


def grouped(root: Node) -> Group:
    """The tree with equal siblings that follow each other poured into one node; leaves list their blocks."""
    done: dict[int, Group] = {}
    todo = [(root, False)]
    while todo:
        node, ready = todo.pop()
        if ready or not node.children:
            done[id(node)] = Group(label_of(node), merged([done.pop(id(c)) for c in node.children if c.tag != "#silent"]),
                                   [node] if node.tag == "#" else [])
        else:
            todo.append((node, True))
            todo.extend((c, False) for c in node.children if c.tag != "#silent")
    return done[id(root)]


def template(shape: str) -> Group:
    """The tree of a shape; members of a leaf: its number."""
    number, stack, label = 0, [[]], ""

    def end():
        nonlocal number, label
        if label:
            stack[-1].append(Group(label, [], [number]))
            number, label = number + 1, ""

    names = []
    for part in re.findall(r"[(),]|[^(),]+", shape):
        if part == "(":
            names.append(label)
            label = ""
            stack.append([])
        elif part in ",)":
            end()
            if part == ")":
                children = stack.pop()
                stack[-1].append(Group(names.pop(), children, []))
        else:
            label = part
    end()
    return stack[0][0]


_KNOWN: dict[tuple[int, int], int] = {}


def likeness(a: Group, b: Group) -> int:
    """Nodes of the largest matching of two trees that keeps parents and the order of siblings (simple tree matching)."""
    if a.label != b.label:
        return 0
    if a.shape == b.shape:
        return a.size
    key = (a.shape, b.shape)
    if key not in _KNOWN:
        if len(_KNOWN) > CACHED:
            _KNOWN.clear()
        _KNOWN[key] = 1 + (table_of(a.children, b.children)[-1][-1] if a.children and b.children else 0)
    return _KNOWN[key]


def table_of(left: list[Group], right: list[Group]) -> list[list[int]]:
    table = [[0] * (len(right) + 1)]
    for a in left:
        above, row = table[-1], [0]
        for j, b in enumerate(right):
            row.append(max(above[j + 1], row[j], above[j] + likeness(a, b)))
        table.append(row)
    return table


def aligned(page: Group, wrapper: Group) -> dict[int, int]:
    """id of a block of the page to the number of the wrapper's leaf that it matches."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), DEEP))
    out, todo = {}, [(page, wrapper)]
    while todo:
        a, b = todo.pop()
        if a.label != b.label:
            continue
        if a.members and not a.children and not b.children:
            out.update((id(x), b.members[0]) for x in a.members)
        left, right = a.children, b.children
        lo, hi, less = 0, len(left), len(right) - len(left)
        while lo < min(hi, hi + less) and left[lo].shape == right[lo].shape:        # equal ends belong to a largest matching
            todo.append((left[lo], right[lo]))
            lo += 1
        while lo < min(hi, hi + less) and left[hi - 1].shape == right[hi + less - 1].shape:
            todo.append((left[hi - 1], right[hi + less - 1]))
            hi -= 1
        left, right = left[lo:hi], right[lo:hi + less]
        if left and right:
            table = table_of(left, right)
            i, j = len(left), len(right)
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((left[i], right[j]))
    return out


def number_of(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def slices(batches, rows: int = 256):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shapes(batches):
    """(host, html) to (host, shape)."""
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([grouped(parse(t)).spelled() for t in batch.column(1).to_pylist()], pa.string())],
                                         names=["host", "shape"])


def node_texts(batches):
    """(host, html, shape) to (host, node, text, page) of the blocks that their elements do not rule out, by numbers."""
    wrappers: dict[str, Group] = {}
    for batch in slices(batches):
        out = []
        for host, page, shape in zip(*(batch.column(i).to_pylist() for i in range(3))):
            root = parse(page)
            if len(wrappers) > 1_000:
                wrappers.clear()
            if shape not in wrappers:
                wrappers[shape] = template(shape)
            at = aligned(grouped(root), wrappers[shape])
            blocks = [b for b, keep, _ in judged(root) if keep]
            own = number_of("\n".join(b.text for b in blocks))
            out += {(host, at[id(b)], number_of(b.text), own) for b in blocks if id(b) in at}
        host, node, text, own = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(node, pa.int32()), pa.array(text, pa.int64()),
                                          pa.array(own, pa.int64())], names=["host", "node", "text", "page"])


def main_text(page: str | None, shape: str | None = None, constant=frozenset()) -> str:
    """A page's main text: its article where it has one, else all that neither the elements nor the host's wrapper
    (shape, constant: pairs of node and number of a text) rule out."""
    root = parse(page)
    at = aligned(grouped(root), template(shape)) if constant else {}
    anywhere = {text for _, text in constant}

    def fixed(block: Node) -> bool:
        own = number_of(block.text)
        return (at[id(block)], own) in constant if id(block) in at else own in anywhere

    kept = [(b.text, article) for b, keep, article in judged(root) if keep and not (constant and fixed(b))]
    if any(article for _, article in kept):
        kept = [k for k in kept if k[1]]
    return "\n".join(text for text, _ in kept)


def texts_of(batches):
    """(page_id, url, html, shape, constant) to (page_id, url, text)."""
    for batch in slices(batches):
        texts = [main_text(page, shape, {(c["node"], c["text"]) for c in constant or ()})
                 for page, shape, constant in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select("page_id", "url", "html", F.when(host != "", host).alias("host"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html).

    1. The most frequent shape of a host's trees (equal siblings poured together) is its wrapper. 2. Every page is
    aligned with it, and the texts of each node counted over the host's unlike pages: copies of a page count once. A text
    that stands in CONSTANT of the pages that have its node is template, as is a block without a counterpart in the wrapper
    whose text is template elsewhere. 3. A page's blocks stay unless their elements
    (menus, forms, adverts ...) or the wrapper rule them out; where an article or main element is left, only its blocks.

    Pages without a host, and hosts with fewer than PAGES unlike pages, are judged by their elements alone. A null or
    empty page has the text ''. Repeated rows give repeated rows. Broken pages are read as far as they go. An empty table
    gives an empty result; other columns are not looked at.
    """
    rows = with_host(pages)
    found = written(rows.where("host is not null").select("host", "html").mapInArrow(shapes, "host string, shape string")
                    .groupBy("host", "shape").agg(F.count("*").alias("n")))
    wrapper = found.groupBy("host").agg(F.max_by("shape", F.struct("n", "shape")).alias("shape"), F.sum("n").alias("n")).where(f"n >= {PAGES}")
    # a host has as many copies as it has HOT-th parts of all pages: at most HOT hosts have several, at most 2 HOT copies in all
    total = found.agg(F.sum("n")).first()[0] or 0
    parts = F.ceil(F.col("n") * HOT / F.lit(max(total, 1))).cast("int")
    hot = F.broadcast(written(found.groupBy("host").agg(F.sum("n").alias("n")).select("host", parts.alias("copies")).where("copies > 1")))
    share = F.pmod(F.xxhash64("page_id", "url"), F.coalesce("copies", F.lit(1))).cast("int")

    def joined(right: DataFrame, how: str) -> DataFrame:
        texts = F.size("constant") * 12 if "constant" in right.columns else F.lit(0)
        if (right.agg(F.sum(F.octet_length("host") + F.octet_length("shape") + texts)).first()[0] or 0) <= SENT:
            return rows.join(F.broadcast(right), "host", how)
        dealt = (right.join(hot, "host", "left").withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)))
                 .drop("copies"))
        return rows.join(hot, "host", "left").withColumn("share", share).drop("copies").join(dealt, ["host", "share"], how)

    wrapper = written(wrapper.select("host", "shape"))
    seen = written(joined(wrapper, "inner").select("host", "html", "shape")
                   .mapInArrow(node_texts, "host string, node int, text long, page long").distinct())
    pages_of = seen.select("host", "node", "page").distinct().groupBy("host", "node").agg(F.count("*").alias("pages")).where(f"pages >= {PAGES}")
    constant = (seen.groupBy("host", "node", "text").agg(F.count("*").alias("n")).where(f"n >= {CONSTANT * PAGES}")
                .join(pages_of, ["host", "node"]).where(f"n >= {CONSTANT} * pages")
                .groupBy("host").agg(F.collect_list(F.struct("node", "text")).alias("constant")))
    known = written(wrapper.join(constant, "host"))
    return joined(known, "left").select("page_id", "url", "html", "shape", "constant").mapInArrow(
        texts_of, pages.select("page_id", "url").withColumn("text", F.lit("")).schema)


@query("op12_wrapper_induction")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    texts = extract(spark.read.parquet(f"{sf}/pages.parquet"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
