"""Main text of web pages, with a style tree for each site.

The pages of a host are merged into one tree of styles (after Yi, Liu, Li 2003): a node is
a path of tags and classes, its presentations are the child sequences that pages show
there, its contents the text blocks below. With m pages that have a node,

* presentation importance is the entropy, base m, of the pages over its presentations;
* content importance is 1 less the mean, over its contents, of the entropy, base m, of a
  content over the pages that show it;
* with l presentations the node's importance is
  ``(1 - 0.9 ** l) * presentation + 0.9 ** l * content``.

What looks the same and says the same on all pages is near 0, an article near 1. The tree
counts all blocks of a page, whatever their tags say, and branches below
``Importance.least`` go first. A site's pages say nothing about parts that differ from page
to page but are no article (menus of different links, adverts in turn), nor does a site of
few pages. Of what the tree leaves, parts go by the meaning that HTML gives to their tags and
roles, and then by the words in their class names, unless the page would have next to
nothing left without them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import slices
from clientele.llm.scratch import stored


@dataclass(frozen=True)
class Importance:
    """Branches on at least ``pages`` different pages go if they are below ``least``."""

    least: float = 0.25
    pages: int = 10
    fade: float = 0.9


# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody"
    " tfoot thead tr ul".split()
)
#: Opening the first ends an open one of the second.
_ENDS_P = BLOCKS - {"body", "html", "tbody", "tfoot", "thead", "tr", "li", "dd", "dt"}
_SIBLINGS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table div section article main body td th".split())
NOISE_TAGS = frozenset(
    "head nav footer aside form button select option label input dialog menu canvas audio video".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split()
)
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie"
    " cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe signup login nav"
    " navbar navigation menu breadcrumb breadcrumbs sidebar sidenav widget widgets related recommended"
    " share sharing social comment comments disqus replies respond footer copyright pagination pager"
    " toolbar skip".split()
)
#: What readers write; it goes even where it is most of a page.
READER_WORDS = frozenset("comment comments disqus replies respond".split())
#: Words that say nothing by themselves: a class of these and noise is noise ("ad-slot"), one
#: with any other word is not ("notice-board").
PLAIN_WORDS = frozenset(
    "area bar block box btn button buttons col column container content inner item items left link links list"
    " main outer page panel right row section site slot top bottom text unit wrap wrapper".split()
)
#: Noise only outside of an article.
HEADER_WORDS = frozenset("header masthead topbar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"\d+")


def _signature(parent: int, name: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{parent} {name}") >> 1


#: What a block is by its tags: text, noise by the words of a class, noise by tag or role.
TEXT, WORD, TAG = range(3)


class _Node:
    __slots__ = ("tag", "path", "noise", "origin", "scope", "children")

    def __init__(self, tag: str, path: int, noise: int, origin: int, scope: int):
        self.tag, self.path, self.noise, self.origin, self.scope = tag, path, noise, origin, scope
        self.children: list[str] = []


@dataclass(frozen=True)
class Block:
    """A text block, with the paths of the branches that hold it. Scope 2 is inside an
    article, 1 inside the main part, 0 elsewhere. ``origin`` numbers the element that makes it
    noise."""

    text: str
    scope: int
    paths: list[int]
    noise: int
    origin: int


def _is_noise(names: list[str], words: frozenset[str]) -> bool:
    """Whether a class or id is made of noise words, and of words that say nothing."""
    for name in names:
        parts = set(_WORD.findall(name))
        if parts & words and parts <= words | NOISE_WORDS | PLAIN_WORDS:
            return True
    return False


def parse(page: str, host: str = "") -> tuple[list[tuple[str, int, list[int]]], dict[int, int]]:
    """The text blocks outside of noise, as (text, scope, paths of the branches that hold
    it), and for each path a hash of its presentation."""
    blocks, nodes = parse_blocks(page, host)
    return [(b.text, b.scope, b.paths) for b in blocks if b.noise == TEXT], nodes


def parse_blocks(page: str, host: str = "") -> tuple[list[Block], dict[int, int]]:
    """All text blocks, and for each path a hash of its presentation. A path is a hash of the
    host, tags and classes."""
    root = _Node("", _signature(0, host), TEXT, 0, 0)
    opened = 0
    stack, blocks, text = [root], [], []
    shown: dict[int, list[str]] = {}

    def flush() -> None:
        if text:
            said = " ".join(html.unescape("".join(text)).split())
            text.clear()
            top = stack[-1]
            if said:
                blocks.append(Block(said, top.scope, [x.path for x in stack[1:]], top.noise, top.origin))

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            node = stack.pop()
            # Repeated children count once, so that longer articles look like shorter ones.
            runs = [c for i, c in enumerate(node.children) if i == 0 or node.children[i - 1] != c]
            shown.setdefault(node.path, []).append(",".join(runs))

    at, n = 0, len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            text.append(page[at:])
            break
        if found.start() > at:
            text.append(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        is_block = tag in BLOCKS
        if is_block:
            flush()
        elif tag in ("br", "td", "th"):
            text.append(" ")
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if not is_block and any(x.tag in BLOCKS for x in stack[depth + 1 :]):
                        break  # a stray end tag of an inline element
                    if stack[depth].noise != stack[depth - 1].noise or is_block:
                        flush()
                    close(depth)
                    break
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID:
            continue
        if tag in _ENDS_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in _SCOPES:
                    break
        if tag in _SIBLINGS:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in _SIBLINGS[tag]:
                    close(depth)
                    break
                if stack[depth].tag in _SCOPES and stack[depth].tag not in ("td", "th"):
                    break
        parent = stack[-1]
        values = {
            m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in _ATTRIBUTE.finditer(found[3])
        } if found[3] else {}
        classes = _NUMBER.sub("0", values.get("class", "")).split()
        names = [x for v in ("class", "id") for x in values.get(v, "").lower().split()]
        role = values.get("role", "").lower()
        scope = parent.scope
        if tag == "article":
            scope = 2
        elif tag == "main" or role == "main":
            scope = max(scope, 1)
        whole = tag in ("html", "body", "article", "main")
        hidden = (
            "hidden" in values
            or values.get("aria-hidden", "").lower() == "true"
            or "display:none" in values.get("style", "").replace(" ", "").lower()
        )
        noise = parent.noise
        if _is_noise(names, READER_WORDS) or not whole and (
            tag in NOISE_TAGS or role in NOISE_ROLES or hidden or scope < 2 and tag == "header"
        ):
            noise = TAG
        elif noise == TEXT and (
            _is_noise(names, frozenset({"ad", "ads", "related"}) if whole and scope else NOISE_WORDS) and tag not in ("html", "body")
            or not whole and scope < 2 and _is_noise(names, HEADER_WORDS)
        ):
            noise = WORD
        opened += 1
        origin = opened if noise != parent.noise else parent.origin
        if noise != parent.noise and not is_block:
            flush()
        name = ".".join([tag, *sorted(classes)])
        parent.children.append(name)
        stack.append(_Node(tag, _signature(parent.path, name), noise, origin, scope))
    flush()
    close(0)
    nodes = {
        path: xxhash.xxh3_64_intdigest("|".join(sorted(set(styles)))) >> 1
        for path, styles in shown.items()
        if path != root.path
    }
    return blocks, nodes


_BLOCK = "struct<text: string, paths: array<bigint>, feature: bigint, scope: int, noise: int, origin: int>"
_PARSED_SQL = (
    "page_id bigint, url string, host string, page_key bigint,"
    f" blocks array<{_BLOCK}>, nodes array<struct<path: bigint, style: bigint>>"
)
_PARSED = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("host", pa.string()),
        ("page_key", pa.int64()),
        (
            "blocks",
            pa.list_(
                pa.struct(
                    [("text", pa.string()), ("paths", pa.list_(pa.int64())), ("feature", pa.int64())]
                    + [(name, pa.int32()) for name in ("scope", "noise", "origin")]
                )
            ),
        ),
        ("nodes", pa.list_(pa.struct([("path", pa.int64()), ("style", pa.int64())]))),
    ]
)
_HOST = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]+)", re.I)


def _parse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns)):
            found = _HOST.match(url or "")
            host = found[1].lower() if found else None
            blocks, nodes = parse_blocks(page or "", host or "")
            rest = [b.text for b in blocks if b.noise == TEXT]
            key = xxhash.xxh3_64_intdigest("\n".join(rest)) >> 1
            every = [{**vars(b), "feature": xxhash.xxh3_64_intdigest(b.text) >> 1} for b in blocks]
            styles = [{"path": p, "style": s} for p, s in nodes.items()]
            rows.append((page_id, url, host, key, every, styles))
            if len(rows) == 500:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_PARSED)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARSED)], schema=_PARSED)


def branch_importance(parsed: DataFrame, limits: Importance = Importance()) -> DataFrame:
    """``of_host, path, m, importance`` of the branches that at least ``limits.pages`` pages
    have. Pages with the same text outside of noise count once."""
    nodes = parsed.select("host", "page_key", F.inline("nodes"))
    styles = nodes.groupBy("path", "style").agg(
        F.countDistinct("page_key").alias("n"), F.min("host").alias("host")
    )
    presented = (
        styles.groupBy("path")
        .agg(
            F.min("host").alias("of_host"),
            F.sum("n").alias("m"),
            F.count("*").alias("l"),
            F.sum(F.col("n") * F.log("n")).alias("nlogn"),
        )
        .where(F.col("m") >= limits.pages)
        .withColumn("presentation", 1 - F.col("nlogn") / (F.col("m") * F.log("m")))
    )
    # Contents are counted where they stand and then summed up along the branches above.
    said = parsed.select("page_key", F.inline("blocks")).withColumn("leaf", F.element_at("paths", -1))
    above = said.groupBy("leaf").agg(F.min("paths").alias("paths"))
    contents = (
        said.groupBy("leaf", "feature")
        .agg(F.log(F.countDistinct("page_key")).alias("log_k"))
        .groupBy(F.col("leaf").alias("at"))
        .agg(F.sum("log_k").alias("sum_log_k"), F.count("*").alias("n"))
    )
    content = (
        contents.join(above, F.col("at") == F.col("leaf"))
        .select(F.explode("paths").alias("branch"), "sum_log_k", "n")
        .groupBy("branch")
        .agg((F.sum("sum_log_k") / F.sum("n")).alias("log_k"))
    )
    fade = F.pow(F.lit(limits.fade), F.col("l"))
    importance = (1 - fade) * F.col("presentation") + fade * (
        1 - F.least(F.col("log_k") / F.log("m"), F.lit(1.0))
    )
    return content.join(presented, F.col("branch") == F.col("path")).select(
        "of_host", "path", "m", importance.alias("importance")
    )


def low_branches(parsed: DataFrame, limits: Importance = Importance()) -> DataFrame:
    """``of_host`` and the array ``low`` of its branches of low importance."""
    low = branch_importance(parsed, limits).where(F.col("importance") < limits.least)
    return low.groupBy("of_host").agg(F.collect_list("path").alias("low"))


#: The share of a page's text that is next to nothing.
NOTHING = 0.1


def main_blocks(blocks: list[dict], low: set[int]) -> tuple[list[str], dict[str, int]]:
    """The texts of the blocks that stay, and how many go by the tree, by tags, by words and
    for lying outside of the main part."""
    left = [b for b in blocks if low.isdisjoint(b["paths"])] if low else blocks
    if not left:
        left = blocks  # a page is not all template
    tree = len(blocks) - len(left)
    said = [b for b in left if b["noise"] != TAG]
    total = sum(len(b["text"]) for b in said)
    sizes: dict[int, int] = {}
    for b in said:
        if b["noise"] == WORD:
            sizes[b["origin"]] = sizes.get(b["origin"], 0) + len(b["text"])
    kept = [b for b in said if b["noise"] != WORD or sizes[b["origin"]] > (1 - NOTHING) * total]
    main = [b for b in kept if b["scope"]]
    inside = sum(len(b["text"]) for b in main) if any(b["scope"] == 1 for b in main) else 0
    # A main part that has the page's text is all of it.
    final = main if 2 * inside > sum(len(b["text"]) for b in kept) else kept
    gone = {"tree": tree, "tag": len(left) - len(said), "word": len(said) - len(kept), "outside": len(kept) - len(final)}
    return [b["text"] for b in final], gone


def _main_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts, counts = [], []
        for blocks, low in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            kept, gone = main_blocks(blocks, set(low or ()))
            texts.append("\n".join(kept))
            counts.append(list(gone.values()))
        by_reason = zip(*counts) if counts else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), *(pa.array(c, pa.int64()) for c in by_reason)],
            ["page_id", "url", "text", *_REASONS],
        )


_REASONS = ["by_tree", "by_tag", "by_word", "outside_main"]


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    limits: Importance = Importance(),
) -> DataFrame:
    """Per page ``page_id, url, text, n_chars``: its main text, blocks joined by newlines; and
    how many blocks went ``by_tree, by_tag, by_word``, or for lying ``outside_main``.

    Blocks go in this order: those of branches of low importance, unless these are all of the
    page; those under tags or roles of menus, headers, footers, forms and the like, hidden ones
    and reader comments; those in elements whose class or id is made of noise words, unless
    nine tenths of the text lie in one such element; and what is outside of a ``main`` part
    that has more than half of the text. Null and empty pages have an empty text; pages
    without a host in their address are one site; repeated rows each get their row; other
    columns are not looked at; an empty table gives no rows.
    """
    chosen = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    parsed = stored(chosen.mapInArrow(_parse_rows, _PARSED_SQL), "parsed_pages")
    # Stored, so that Spark knows how many there are when it chooses the join.
    low = stored(low_branches(parsed, limits), "low_branches")
    joined = parsed.join(low, F.col("host").eqNullSafe(F.col("of_host")), "left")
    found = joined.select("page_id", "url", "blocks", "low").mapInArrow(
        _main_rows, f"page_id bigint, url string, text string, {', '.join(f'{r} bigint' for r in _REASONS)}"
    )
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), *_REASONS)
