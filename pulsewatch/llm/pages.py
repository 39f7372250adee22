"""Main text of web pages by consensus on host paths.

Each page's containers are scored by the share of its plain text that they hold; the page votes
for its best ones under a generalised path (tags and classes, numbers masked). Spark sums the
votes by host. A host has several winners: the path with most votes, and those that lie apart from
it and are the first choice of a tenth of the pages or more (a second template). Each page is read
again by the winner that scores best on it, of those that hold at least half of the plain text that
they hold on the host's pages. Where none does, the page's own best container is taken if it holds
more than twice as much; so it is for a page without a winner or without a host. A container of an
article beside the one taken is a part of the same article and is joined.

Left out everywhere: menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments, told by tag, role, class or id. A header inside the container gives
its headings. What a form, an aside, a role, a hidden mark, a class or an id tells is decided when the
page has been read: a name of an article ("content has-sidebar") or of a state ("no-sidebar",
"ad-free") leaves nothing out, a part that outweighs all that remains is taken for a wrapper (if a
mark says plainly what it is, only with an article or a main heading in it), and if nothing remains
the largest is kept. Attributes are read one by one, so words in values are never taken for marks.
Of the cells of a layout table those with little prose beside the fullest are left out.

Edge cases: null or empty html gives an empty text; cut-off pages are read to their end; repeated
rows each give a row; pages of one host are never gathered in one task, only its votes are summed.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.llm.common import bound_batches, stored, widened

BALLOT = 3  # containers that a page votes for
SHARE = 10  # a further winner is the first choice of one page in so many
RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "math", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
    "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot",
    "thead", "tr", "ul", "caption",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = {"article", "body", "div", "main", "section", "td", "center", "html", "blockquote"}
#: Tags that an opening tag ends if they are open in the same scope.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body"}
OUT_TAGS = {"nav", "footer", "menu", "dialog", "button", "select", "head", "audio", "video", "canvas"}
OUT_ROLES = {"navigation", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
OUT_WORDS = {
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "sidebar", "aside", "cookie", "cookies",
    "consent", "gdpr", "notice", "notification", "alert", "banner", "popup", "modal", "overlay", "newsletter", "subscribe",
    "signup", "login", "promo", "promotion", "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor",
    "sponsored", "share", "sharing", "social", "comment", "comments", "disqus", "replies", "respond", "related",
    "recommended", "recommendations", "form", "search", "pagination", "pager", "hidden", "widget", "toolbar", "skip",
}
HEADER_WORDS = {"header", "masthead"}
#: With one of these a name tells a state of the element ("no-sidebar"), not what it is.
STATE_WORDS = {"has", "no", "non", "not", "with", "without", "free"}
#: Reader comments may outweigh the article.
TALK_WORDS = {"comment", "comments", "disqus", "replies", "respond"}
ARTICLE_WORDS = {"article", "entry", "post", "story", "content", "main", "body", "text"}
#: Text of blocks with these tags counts in full, other text (bare containers, cells) in part.
PROSE = {"p", "pre", "blockquote", "li", "dd", *HEADINGS}
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)
      | <(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)
      | <[!?/][^>]*+(?:>|\Z)""",
    re.S | re.X,
)
#: One attribute after the other: name, and value if it has one, whose words are never taken for names.
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]+))?|["'=/<>]""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NUMBER = re.compile(r"\d+")


@dataclass
class Element:
    tag: str
    path: str
    out: bool  # belongs to what is left out
    header: bool  # inside a header: only headings count
    region: int  # innermost part that its name would leave out, 0 for none
    heading_region: int  # the same for headings
    containers: tuple[int, ...]
    is_block: bool
    article: bool  # inside an article or the main part


@dataclass
class Block:
    containers: tuple[int, ...]
    tag: str
    text: str
    linked: int
    region: int = 0


@dataclass
class Region:
    """A part of the page that its class or id would leave out."""

    parent: int
    named: bool  # a whole name says so, not a word within one
    talk: bool
    article: bool = False  # an article, a main part or a main heading is in it


@dataclass
class Page:
    paths: list[str] = field(default_factory=list)  # by container
    blocks: list[Block] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(text) if text else ():
        if name and name.lower() not in found:  # of two equal names the first counts
            found[name.lower()] = entities.unescape(value[1:].rstrip(value[0]) if value[:1] in ("'", '"') else value)
    return found


def prose(block: Block) -> float:
    """Plain text of a block, that of prose in full."""
    return max(0, len(block.text) - block.linked) * (1.0 if block.tag in PROSE else 0.3)


def _lifted(blocks: list[Block], regions: list[Region]) -> list[Block]:
    """The blocks without those of regions that are left out."""
    if len(regions) == 1:
        return blocks
    held = [0.0] * len(regions)  # without reader comments and the like inside
    whole = [0.0] * len(regions)
    for b in blocks:
        at, w, counts = b.region, prose(b), True
        if not at:
            held[0] += w
        while at:
            whole[at] += w
            held[at] += w if counts else 0.0
            counts = counts and not regions[at].named
            at = regions[at].parent
    kept = {0}
    for i, r in enumerate(regions[1:], 1):
        # a parent comes before what is in it
        wrapper = not r.named or (r.article and not r.talk)
        if r.parent in kept and wrapper and held[i] > held[0]:
            kept.add(i)
    while not any(b.region in kept and prose(b) for b in blocks):
        rest = [i for i in range(1, len(regions)) if i not in kept and regions[i].parent in kept and whole[i]]
        if not rest:
            break
        kept.add(max(rest, key=lambda i: (not regions[i].talk, whole[i], -i)))
    return [b for b in blocks if b.region in kept]


def parse(html: str) -> Page:
    """Text blocks in page order, each with the containers around it; what is left out is not in it."""
    page = Page()
    regions = [Region(0, False, False)]
    stack = [Element("", "", False, False, 0, 0, (), True, False)]
    open_text: list[str] = []
    owner = stack[0]
    linked = 0
    links = 0

    def flush() -> None:
        nonlocal linked
        if open_text:
            text = "".join(open_text)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                region = owner.heading_region if owner.tag in HEADINGS else owner.region
                page.blocks.append(Block(owner.containers, owner.tag, text, linked, region))
            open_text.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal owner, linked
        top = stack[-1]
        if not text or top.out:
            return
        holder = top if top.is_block else next(e for e in reversed(stack) if e.is_block)
        if holder.header and holder.tag not in HEADINGS:
            return
        if holder is not owner:
            flush()
            owner = holder
        open_text.append(text)
        if links:
            linked += len(text)

    at = 0
    while at < len(html):
        found = _TOKEN.search(html, at)
        if not found:
            say(html[at:])
            break
        say(html[at : found.start()])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if found["end"] or found["end2"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                if any(e.is_block for e in stack[depth:]):
                    flush()
                links -= sum(e.tag == "a" for e in stack[depth:])
                del stack[depth:]
            continue
        if tag in ("br", "td", "th"):
            say(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        attributes = found["attrs"] or found["attrs2"] or ""
        if tag in RAW:
            if not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = close.end() if close else len(html)
            continue
        if tag in BLOCK:
            flush()
            # a paragraph ends where a block starts, and so do inline tags left open in it
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p" or stack[i].tag in SCOPE), 0)
            if depth and stack[depth].tag == "p":
                links -= sum(e.tag == "a" for e in stack[depth:])
                del stack[depth:]
        if tag in ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ENDS[tag]:
                    flush() if tag not in ("td", "th") else None
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE:
                    break
        own = _attributes(attributes)
        top = stack[-1]
        out = top.out or tag in OUT_TAGS
        article = top.article or tag in ("article", "main")
        header, region, heading_region = top.header, top.region, top.heading_region
        names = [{w.lower() for w in _WORD.findall(n)} for n in f"{own.get('class', '')} {own.get('id', '')}".split()]
        names = [n for n in names if n and n.isdisjoint(STATE_WORDS)]
        words = set().union(*names)
        named = any(n <= OUT_WORDS for n in names)
        # the page itself is never left out for its class, nor is what another name says to be an article
        proper = tag in ("html", "body") or (
            not named and (tag in ("article", "main") or any(n & ARTICLE_WORDS and n.isdisjoint(OUT_WORDS | HEADER_WORDS) for n in names))
        )
        if tag in ("article", "main", "h1"):
            at_region = region
            while at_region:
                regions[at_region].article = True
                at_region = regions[at_region].parent
        told = tag == "aside" or own.get("role", "").lower() in OUT_ROLES or "hidden" in own
        told = (told or own.get("aria-hidden", "").lower() == "true") and tag not in ("html", "body")
        if told or tag == "form" or (not proper and words & OUT_WORDS):
            named = told or (not proper and named)
            regions.append(Region(region, named, bool(words & TALK_WORDS), tag in ("article", "main")))
            region = heading_region = len(regions) - 1
        if tag == "header" or own.get("role", "").lower() == "banner":
            # that of an article gives its headings, that of a page nothing
            header = tag not in ("html", "body")
            out = out or (header and not article and not words & ARTICLE_WORDS)
        elif not proper and tag not in HEADINGS and words & HEADER_WORDS:
            regions.append(Region(region, False, False))
            region = len(regions) - 1
            if not article and not words & ARTICLE_WORDS:
                heading_region = region
        containers, path = top.containers, top.path
        if tag in CONTAINERS:
            classes = sorted({_NUMBER.sub("#", c) for c in own.get("class", "").split()})
            path = f"{path}/{'.'.join([tag, *classes])}"
            containers = (*containers, len(page.paths))
            page.paths.append(path)
        if tag == "a":
            links += 1
        stack.append(Element(tag, path, out, header, region, heading_region, containers, tag in BLOCK, article))
    flush()
    page.blocks = _lifted(page.blocks, regions)
    return page


def measured(page: Page) -> dict[str, tuple[float, float]]:
    """Path to score and plain text held: the share, more for an article, with the title, and if deeper."""
    plain = [prose(b) for b in page.blocks]
    total = sum(plain)
    if not total:
        return {}
    titled = any(b.tag == "h1" for b in page.blocks)
    held: dict[str, float] = {}
    has_title: set[str] = set()
    for block, w in zip(page.blocks, plain, strict=True):
        for path in {page.paths[c] for c in block.containers}:
            held[path] = held.get(path, 0.0) + w
            if block.tag == "h1":
                has_title.add(path)
    out = {}
    for path, of_it in held.items():
        parts = path.split("/")[1:]
        words = {w.lower() for part in parts[2:] for w in _WORD.findall(part)}
        kind = 0.5 * ("article" in words) + 0.25 * bool(words & ARTICLE_WORDS)
        score = of_it / total * (1.0 if path in has_title or not titled else 0.6) * (1 + kind + 0.02 * min(len(parts), 8))
        out[path] = (score, of_it)
    return out


def scores(page: Page) -> dict[str, float]:
    return {path: score for path, (score, _) in measured(page).items()}


def text_by(page: Page, *paths: str) -> str:
    inside = {i for i, p in enumerate(page.paths) if p in paths}
    cells = {i: 0.0 for i in inside if page.paths[i].rpartition("/")[2].split(".")[0] == "td"}
    if len(cells) > 1:
        # the cells of a layout table have one path: those with little prose beside the fullest are not the article
        for b in page.blocks:
            for i in cells.keys() & set(b.containers):
                cells[i] += prose(b)
        inside -= {i for i, held in cells.items() if 4 * held < max(cells.values())}
    return "\n".join(b.text for b in page.blocks if not inside.isdisjoint(b.containers))


def chosen(page: Page, winners: list[tuple[str, float]]) -> list[str]:
    """The path to read a page by, first, and those of further parts of its article."""
    found = measured(page)
    here = [p for p, _ in winners if p in found and found[p][1]]
    usual = [p for p, mean in winners if p in here and 2 * found[p][1] >= mean]
    pick = own = best({p: score for p, (score, _) in found.items()})
    if usual or here:
        pick = best({p: found[p][0] for p in usual or here})
        if not usual and found[own][1] > 2 * found[pick][1]:
            pick = own
    if not pick:
        return []
    parent, _, name = pick.rpartition("/")

    def part(path: str) -> bool:
        up, _, label = path.rpartition("/")
        names = [{w.lower() for w in _WORD.findall(n)} for n in label.split(".")]
        return up == parent and any(n & ARTICLE_WORDS for n in names) and not any(n & OUT_WORDS for n in names)

    if not part(pick) or name.split(".")[0] in ("html", "body"):
        return [pick]
    return [pick, *sorted(p for p in found if p != pick and part(p) and 4 * found[p][1] >= found[pick][1])]


def best(votes: dict[str, float]) -> str | None:
    return min(votes, key=lambda p: (-round(votes[p], 9), p)) if votes else None


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, votes, held, first = [], [], [], [], []
        for host, html in zip(batch.column("host"), batch.column("html"), strict=True):
            found = measured(parse(html.as_py() or ""))
            for place, path in enumerate(sorted(found, key=lambda p: (-round(found[p][0], 9), p))[:BALLOT]):
                hosts.append(host.as_py())
                paths.append(path)
                votes.append(round(found[path][0] * 1e6))
                held.append(round(found[path][1]))
                first.append(int(not place))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), *[pa.array(x, pa.int64()) for x in (votes, held, first)]],
            names=["host", "path", "vote", "held", "first"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, used = [], []
        for html, winners in zip(batch.column("html"), batch.column("winners"), strict=True):
            page = parse(html.as_py() or "")
            paths = chosen(page, [(w["path"], w["mean"]) for w in winners.as_py() or []])
            texts.append(text_by(page, *paths))
            used.append(paths[0] if paths else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.string()), pa.array(used, pa.string())], names=["row", "text", "path"]
        )


def host_of(url: str = "url"):
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def _summed(pages: DataFrame) -> DataFrame:
    """(host, path, vote, n, held, first): votes, pages that vote for it, their plain text in it, first choices."""
    bound_batches(pages.sparkSession)
    ballots = pages.select(host_of().alias("host"), "html").where("host is not null")
    votes = ballots.mapInArrow(_vote, "host string, path string, vote long, held long, first long")
    return votes.groupBy("host", "path").agg(
        F.sum("vote").alias("vote"), F.count(F.lit(1)).alias("n"), F.sum("held").alias("held"), F.sum("first").alias("first")
    )


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes on each host, ties by name."""
    first = Window.partitionBy("host").orderBy(F.desc("vote"), "path")
    return _summed(pages).withColumn("place", F.row_number().over(first)).where("place = 1").select("host", "path")


def host_winners(pages: DataFrame) -> DataFrame:
    """(host, winners): paths with the mean of the plain text they hold, at most SHARE + 1 a host."""
    summed = stored(_summed(pages), "host-votes")
    hosts = summed.groupBy("host").agg(
        F.sum("first").alias("pages"), F.min(F.struct((-F.col("vote")).alias("vote"), "path"))["path"].alias("top")
    )
    slash = F.lit("/")
    path, top = F.concat("path", slash), F.concat("top", slash)
    apart = ~path.startswith(top) & ~top.startswith(path)
    enough = (F.col("first") > 1) & (F.col("first") * SHARE >= F.col("pages"))
    winners = summed.join(hosts, "host").where((F.col("path") == F.col("top")) | (apart & enough))
    return winners.groupBy("host").agg(F.collect_list(F.struct("path", (F.col("held") / F.col("n")).alias("mean"))).alias("winners"))


def extracted(pages: DataFrame) -> DataFrame:
    """``row`` (all columns but html), text and the path it was read by, for every page."""
    keep = [c for c in pages.columns if c != "html"]
    rows = pages.select(F.struct(*[F.col(c) for c in keep]).alias("row"), host_of().alias("host"), "html")
    # written first, so that its size is known: a small one is broadcast and no page moves
    winners = stored(host_winners(pages), "host-paths")
    placed = rows.join(winners, "host", "left").select("row", "html", "winners")
    schema = widened([placed.schema["row"]], "text string, path string")
    return placed.mapInArrow(_extract, schema)
