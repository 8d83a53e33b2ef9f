"""Main texts of web pages by site style trees.

The pages of a host are merged into one tree of elements, whose nodes are paths of tags with
classes and ids. A node has the presentation entropy of the ways its content is laid out and
the content entropy of its blocks: what most pages of the host show alike says little. Its
importance, between 0 and 1, joins both. Branches of low importance are removed from each page,
as are branches that their tags, classes or roles name as something else than the article.
An article element is a prior for what stands in it and against what stands beside it, and so
weighs most where a host has few pages. Pages of one body count once, so that copies of an
article do not look like the site's own text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import map_batches

#: Least importance of a node, that of a node beside the article, and the weight of content
#: against presentation.
LEAST_IMPORTANCE, LEAST_BESIDE, CONTENT_WEIGHT = 0.35, 0.6, 0.9
#: Importance before any page is seen: in an article, beside one, on pages without one; and how
#: many pages that is worth.
PRIOR_MAIN, PRIOR_BESIDE, PRIOR_OTHER, PRIOR_PAGES = 1.0, 0.0, 0.6, 8

#: Pages of a part of a large host, whose parts each get its list of nodes; and how many hosts are large at most.
PART_PAGES, LARGE_HOSTS = 1_000, 500_000

# --- fixed values
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template iframe svg textarea title select object canvas audio video head".split())
#: Of these, those that can hold their like.
NESTING_TAGS = frozenset("template svg object canvas audio video".split())
NOISE_TAGS = frozenset("nav footer aside form menu dialog button".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notices popup modal "
    "newsletter subscribe share sharing social comment comments reply replies respond disqus related widget toolbar "
    "pagination pager login signup skip".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Elements that no class, id or role makes noise.
NEVER_NOISE = frozenset(("html", "body", *MAIN_TAGS))
# --- end of fixed values

# A quote opens a value only behind an equals sign; elsewhere it is a sign like others.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|=\s*[^\s\"'>][^\s>]*|[^>=]|=)*+)>",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*?(/?)>", re.IGNORECASE) for tag in RAW_TAGS}


def _after_element(page: str, tag: str, at: int) -> int | None:
    """Where an element that shows no text ends, those of its kind within it included, if it does."""
    depth = 1
    for found in _RAW_END[tag].finditer(page, at):
        if found[1]:
            depth -= 1
        elif tag in NESTING_TAGS and not found[2]:
            depth += 1
        if not depth:
            return found.end()
    return None


class Block:
    """A run of text with the element it stands in."""

    __slots__ = ("element", "main", "noise", "path", "text")

    def __init__(self, path: str, main: bool, element: int, text: str):
        self.path, self.main, self.element, self.text = path, main, element, text
        self.noise = False


class Element:
    """An element, its place in the list of elements before those in it, and what speaks against it:
    ``hard`` its tag, ``named`` its class, id or role."""

    __slots__ = ("hard", "named", "parent", "tag")

    def __init__(self, parent: int, tag: str, hard: bool, named: bool):
        self.parent, self.tag, self.hard, self.named = parent, tag, hard, named


def page_blocks(page: str | None) -> list[Block]:
    """The blocks of a page with text, in page order."""
    out: list[Block] = []
    elements = [Element(-1, "", False, False)]
    stack: list[tuple[str, str, bool, int]] = [("", "", False, 0)]  # tag, path, in main, place of the element
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                _, path, main, element = stack[-1]
                out.append(Block(path, main, element, text))

    def close(tag: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] == tag:
                del stack[depth:]
                return

    page, at = page or "", 0
    limit = page.rfind(">") + 1  # no tag ends behind it
    while True:
        found = _MARKUP.search(page, at, limit)
        end = found.start() if found else len(page)
        if not found and "<!--" in page[at:]:
            end = page.index("<!--", at)
        if end > at:
            pieces.append(entities.unescape(page[at:end]))
        if not found:
            break
        at = found.end()
        if found[2] is None:
            if found[0].startswith("<!--") and not found[0].endswith("-->"):
                at = len(page)
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in BLOCK_TAGS or tag == "button":
                flush()
                close(tag)
            continue
        if tag in RAW_TAGS:
            if not found[3].endswith("/"):
                over = _after_element(page, tag, at)  # of one that never ends only the tag goes, but for code
                at = over if over is not None else len(page) if tag in ("script", "style") else at
            if tag in ("head", "textarea", "select"):
                flush()
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in BLOCK_TAGS and tag != "button":
            continue  # inline elements stay with their block
        flush()
        if tag in ("p", "li", "td", "th", "tr", "dd", "dt", "option") and any(s[0] == tag for s in stack[-3:]):
            if tag == "p" or stack[-1][0] in (tag, "p"):
                close(tag)
        elif stack[-1][0] == "p":
            stack.pop()
        if tag in VOID_TAGS:
            continue
        _, path, main, parent = stack[-1]
        names, listed = _names(found[3], frozenset() if main else frozenset(("header",)))
        main = main or tag in MAIN_TAGS
        named = tag not in NEVER_NOISE and (listed or tag in ("form", "header") and (tag == "form" or not main))
        elements.append(Element(parent, tag, tag in NOISE_TAGS and tag != "form", named))
        shown = f"{path}/{tag}" + "".join(f".{n}" for n in sorted(names))
        stack.append((tag, shown, main, len(elements) - 1))
    flush()
    _mark_noise(out, elements)
    return out


def _mark_noise(blocks: list[Block], elements: list[Element]) -> None:
    """Marks the blocks in elements that are noise by tag or name.

    Names do not count for the ancestors of the page's main element, which is the longest
    ``main``, or else ``article``, outside named elements if there is one. On a page with neither,
    names that would leave nothing do not count at all.
    """

    def spread(hard: bool, named: bool) -> list[bool]:
        noise: list[bool] = []
        for e in elements:
            noise.append(e.parent >= 0 and noise[e.parent] or hard and e.hard or named and e.named)
        return noise

    noise, hard = spread(True, True), spread(True, False)
    if any(noise[b.element] and not hard[b.element] for b in blocks):
        sizes = [0] * len(elements)
        for b in blocks:
            at = b.element
            while at >= 0:
                sizes[at] += len(b.text)
                at = elements[at].parent
        for tag in ("main", "article"):
            able = [i for i, e in enumerate(elements) if e.tag == tag and sizes[i] and not hard[i]]
            if able:
                at = max(able, key=lambda i: (not noise[i], sizes[i]))
                while at >= 0:
                    elements[at].named = False
                    at = elements[at].parent
                break
        else:
            if all(noise[b.element] for b in blocks) and not any(e.tag in MAIN_TAGS for e in elements):
                for e in elements:
                    e.named = False
        noise = spread(True, True)
    for b in blocks:
        b.noise = noise[b.element]


def _names(attributes: str, more: frozenset[str]) -> tuple[frozenset[str], bool]:
    """The words of an element's class and id, with its role if that names something else than
    text, and whether a class or id is listed as a whole: every word of it, as in cookie-notice."""
    if "=" not in attributes:
        return frozenset(), False
    names: set[str] = set()
    listed = False
    for kind, *values in _NAMES.findall(attributes):
        value = "".join(values).lower()
        if kind.lower() == "role":
            if value.strip() in NOISE_ROLES:
                names.add("navigation")
                listed = True
            continue
        for token in value.split():
            words = _WORD.findall(token)
            names.update(words)
            listed = listed or bool(words) and all(w in NOISE_NAMES or w in more for w in words)
    return frozenset(names), listed


def main_text(page: str | None, unimportant: frozenset[int], important: frozenset[int] = frozenset()) -> str:
    """The blocks that stay, joined by two line ends: all but the unimportant, and on pages with an
    article only the important of those beside it."""
    blocks = [b for b in page_blocks(page) if not b.noise]
    main = [b for b in blocks if b.main]
    if main:
        kept = [b for b in blocks if (_key(b.path) not in unimportant if b.main else _key(b.path) in important)] or main
    else:
        kept = [b for b in blocks if _key(b.path) not in unimportant] or blocks
    return "\n\n".join(b.text for b in kept)


def _key(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (value >> 63 << 64)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; an empty text if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def node_importance(pages: DataFrame) -> DataFrame:
    """(host, node, main, pages, importance) of the nodes of each host's tree that hold text;
    ``pages`` counts pages of one body once, ``main`` says whether the node is in an article.

    Pages of one body are merged by host and body. Each batch counts features first, and they are
    counted per host and node in partial aggregates, so no host is a single task's work.
    """

    def pack() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            bodies, packed = [], []
            for page in batch.column(1).to_pylist():
                layout: dict[str, list[str]] = {}
                features, inside = set(), set()
                blocks = page_blocks(page)
                clean = [b for b in blocks if not b.noise] or blocks
                bodies.append(_key("\n\n".join([b.text for b in clean if b.main] or [b.text for b in clean])))
                for block in blocks:
                    if block.main:
                        inside.add(_key(block.path))
                    features.add((_key(block.path), 1, _key(block.text)))
                    parent, _, tag = block.path.rpartition("/")
                    layout.setdefault(parent, []).append(tag)
                    layout.setdefault(block.path, [])
                for path in layout:
                    features.add((_key(path), 0, 0))
                    features.add((_key(path), 2, _key(" ".join(layout[path]))))
                features.update((node, 3, 0) for node in inside)
                packed.append(np.array(sorted(features), np.int64).reshape(-1, 3).tobytes())
            arrays = [batch.column(0), pa.array(bodies, pa.int64()), pa.array(packed, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["host", "body", "features"])

        return step

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen: Counter = Counter()
            for host, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.update((host, *f) for f in np.frombuffer(packed, np.int64).reshape(-1, 3).tolist())
            columns = list(zip(*seen, strict=True)) or [[]] * 4
            types = [pa.string(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.array(np.fromiter(seen.values(), np.int64, len(seen)))], ["host", "node", "kind", "feature", "n"]
            )

        return step

    each = map_batches(pages.select("host", "html"), pack, "host string, body bigint, features binary")
    bodies = each.groupBy("host", "body").agg(F.min("features").alias("features"))
    counted = map_batches(bodies.select("host", "features"), make, "host string, node bigint, kind int, feature bigint, n bigint")
    features = counted.groupBy("host", "node", "kind", "feature").agg(F.sum("n").alias("n"))
    n, log = F.col("n").cast("double"), F.log(F.col("n").cast("double"))
    nodes = features.groupBy("host", "node").agg(
        F.max(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.avg(F.when(F.col("kind") == 1, log)).alias("alike"),
        F.sum(F.when(F.col("kind") == 2, n * log)).alias("layouts"),
        F.max(F.col("kind") == 3).alias("main"),
    )
    size = F.log(F.greatest(F.col("pages"), F.lit(2)).cast("double"))
    content = F.greatest(F.lit(0.0), 1 - F.col("alike") / size)
    presentation = F.when(F.col("pages") > 1, F.greatest(F.lit(0.0), 1 - F.col("layouts") / F.col("pages") / size)).otherwise(1.0)
    importance = CONTENT_WEIGHT * content + (1 - CONTENT_WEIGHT) * presentation
    return nodes.filter("alike IS NOT NULL").select("host", "node", "main", "pages", importance.alias("importance"))


def _verdicts(rows: DataFrame) -> DataFrame:
    """(host, unimportant, important): nodes whose importance, with what the prior is worth, says
    otherwise than the prior alone."""

    def judged(prior: float) -> Column:
        return (PRIOR_PAGES * F.lit(prior) + F.col("pages") * F.col("importance")) / (PRIOR_PAGES + F.col("pages"))

    low = F.when(F.col("main"), judged(PRIOR_MAIN)).otherwise(judged(PRIOR_OTHER)) < LEAST_IMPORTANCE
    high = ~F.col("main") & (judged(PRIOR_BESIDE) >= LEAST_BESIDE)
    nodes = node_importance(rows).withColumns({"low": low, "high": high}).filter("low OR high")
    return nodes.groupBy("host").agg(
        F.collect_list(F.when(F.col("low"), F.col("node"))).alias("unimportant"),
        F.collect_list(F.when(F.col("high"), F.col("node"))).alias("important"),
    )


def _large_hosts(rows: DataFrame) -> DataFrame:
    """(key, parts) of the hosts that are dealt out in parts, by a hash of the host.

    A host is large if it has more than ``PART_PAGES`` pages and more than its share of ``LARGE_HOSTS``: no
    more than that many hosts can, so the list has a bound of 16 bytes for each.
    """
    least = max(PART_PAGES, -(-rows.count() // LARGE_HOSTS))
    counted = rows.groupBy(F.xxhash64("host").alias("key")).count().filter(F.col("count") > least)
    return counted.select("key", F.ceil(F.col("count") / PART_PAGES).cast("int").alias("parts"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; a page without text has an empty one.

    A NULL url belongs to the nameless host. Repeated rows come back as often as they went in.
    """
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    large = F.broadcast(_large_hosts(rows))

    def with_parts(frame: DataFrame) -> DataFrame:
        """With the number of parts of the host."""
        keyed = frame.withColumn("key", F.xxhash64("host")).join(large, "key", "left")
        return keyed.withColumn("parts", F.coalesce("parts", F.lit(1)))

    # any part will do for a page, as each gets the list: pages take turns, repeated rows too
    salted = with_parts(rows).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.col("parts")).cast("int"))
    lists = with_parts(_verdicts(rows)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    joined = salted.join(lists.select("host", "salt", "unimportant", "important"), ["host", "salt"], "left").select(
        "page_id", "url", "html", "unimportant", "important"
    )

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            judged = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)
            texts = [main_text(page, frozenset(low or ()), frozenset(high or ())) for page, low, high in judged]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

        return step

    schema = f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars bigint"
    return map_batches(joined, make, schema)
