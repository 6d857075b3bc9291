"""Main text of web pages by consensus host paths.

Each page scores its containers: a block's text outside links counts in full for
the container around it and half for the one above. The page's best container
votes, under its generalised path of tags and classes (numbers taken out of the
classes), with its score. Spark adds up the votes of each host, and all pages of
the host are extracted again from the containers on the winning path, each widened
to the article around it; a page without one falls back to its own best. A template that one odd page would get
wrong is thus settled by its neighbours.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innspark.llm.common import written

CLASSES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""",
                     re.IGNORECASE)
CLASS = re.compile(r"""(?:^|\s)class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav noscript ol optgroup option p pre search section select summary table "
    "tbody td template tfoot th thead tr ul button".split())
CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = frozenset("ul ol menu dl table tbody thead tfoot select article section div body".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: what stands in for a picture, sound or program where it can't be shown
FALLBACK = frozenset("svg audio video canvas object math".split())
DROPPED = frozenset("head nav footer aside noscript template menu dialog select button "
                    "fieldset search optgroup option".split()) | FALLBACK
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["']?[^"'>]*?"""
                    r"""(?:display\s*:\s*none|visibility\s*:\s*hidden))""", re.IGNORECASE)
# a class or id with one of these words hints at what isn't the article, as a form does;
# how much text and which containers a block holds decides (see _asides)
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr header login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification notifications pagination popup promo "
    "promotion related replies reply responses share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar "
    "widget widgets".split())
NEGATED = re.compile(r"(?<![a-z])(?:no|non|not|has|have|with|without)[-_]+[a-z]+")  # "no-sidebar"
ASIDE_SHARE, NAMED_SHARE = 0.5, 0.8  # of the text outside links; the second for a name that is such a word
VOID = frozenset("area base col embed img input link meta param source track wbr".split())
CONTAINERS = frozenset("article main section div body td html".split())
SMALL_HOSTS = 200_000  # winning paths that are broadcast, some 20 MB; above it they are joined


# what an opening tag may close, nearest first: p, and the open ones of its group
GROUPS = {"p": 0, "li": 1, "dd": 2, "dt": 2, "tr": 3, "td": 4, "th": 4, "option": 5}
REACH = {tag: (0, *sorted({GROUPS[c] for c in closes})) for tag, closes in CLOSES.items()}
NONE_OPEN = (0,) * 6
NAME = re.compile(r"[A-Za-z][^\s/>]*")
STOP = re.compile(r"[>\"']")


class _Open:
    __slots__ = ("tag", "dropped", "number", "hint", "article", "reach")

    def __init__(self, tag: str, dropped: bool, number: int, hint: int, article: int, reach: tuple[int, ...]):
        self.tag, self.dropped, self.number, self.hint = tag, dropped, number, hint
        self.article = article  # number of the nearest article or main, -1 without one
        self.reach = reach  # for each group, where its nearest open element stands; 0: none


class Page:
    """Blocks of text and containers of a page, each with a link to what it is in.

    ``blocks``: (text, link characters, number of the innermost container). Containers
    have their step (tag and classes), the parent's number (smaller than their own) and
    a key of the whole path, made from the parent's key. Time and memory grow with the
    page's length alone, however deep it is or however its tags are broken."""

    def __init__(self):
        self.blocks: list[tuple[str, int, int]] = []
        self.steps, self.parents, self.keys = ["html"], [-1], [_key(b"", "html")]

    def path(self, k: int) -> str:
        out = []
        while k >= 0:
            out.append(self.steps[k])
            k = self.parents[k]
        return ">".join(reversed(out))


def _key(above: bytes, step: str) -> bytes:
    return hashlib.blake2b(above + step.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def path_key(path: str) -> bytes:
    key = b""
    for step in path.split(">"):
        key = _key(key, step)
    return key


def _tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, "/" or "", name, attributes) of the tags; comments and declarations
    without a name. Quotes are followed as far as they close; looking for ends that never
    come may take a few times the page's length in all, then a tag ends at the next ``>``."""
    at, size, effort, ends = 0, len(page), 8 * len(page) + 100, True
    while (at := page.find("<", at)) >= 0:
        after = page[at + 1:at + 2]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = end + 3 if end >= 0 else size
            yield at, end, "", "", ""
            at = end
            continue
        slash = "/" if after == "/" else ""
        name = NAME.match(page, at + 1 + len(slash))
        if not ends or after not in ("!", "?") and not name:
            at += 1
            continue
        first = page.find(">", at)
        if first < 0:
            ends = False  # no tag ends any more; comments may
            at += 1
            continue
        end = first
        if name:
            stop, seek = -1, name.end()
            while effort > 0 and (m := STOP.search(page, seek)):
                if m[0] == ">":
                    stop = m.start()
                    break
                close = page.find(m[0], m.end())
                if close < 0:
                    effort -= size - m.end()
                    break
                seek = close + 1
            if stop < 0:
                effort -= seek - at
            end = stop if stop >= 0 else first
        yield at, end + 1, slash, name[0].lower() if name else "", page[name.end():end] if name else ""
        at = end + 1


def _first(m: re.Match | None) -> str:
    return next((g for g in m.groups() if g), "") if m else ""


def _asides(limits: list[tuple[float, int]], above: list[int], holders: set[int], has_article: bool,
            said: list[tuple[int, int, int]]) -> list[bool]:
    """Which hints' blocks are dropped, with what is in them. ``limits`` has each hint's
    share and article, ``above`` the hint around it; ``said`` each text's characters
    outside links, its innermost hint and its article (-1 without one).

    A block that holds an article or main stays, and one that holds more than its
    share of its article's text (of the page's, on a page without an article)
    stays; beside an article, any other block goes. Plainly named ones go first.
    """
    holds = [False] * len(limits)
    for k in range(len(limits) - 1, -1, -1):
        holds[k] = holds[k] or k in holders
        if holds[k] and above[k] >= 0:
            holds[above[k]] = True
    gone = [False] * len(limits)
    for share in (NAMED_SHARE, ASIDE_SHARE):
        whole: Counter = Counter()
        held = [0] * len(limits)
        for own, hint, article in said:
            if hint < 0 or not gone[hint]:
                whole[article] += own
                whole[None] += own
                if hint >= 0:
                    held[hint] += own
        for k in range(len(limits) - 1, -1, -1):
            if above[k] >= 0:
                held[above[k]] += held[k]
        outer = has_article and whole[None] > whole[-1]
        new = list(gone)
        for k, (limit, article) in enumerate(limits):
            if limit == share and not holds[k]:
                of = whole[article] if article >= 0 else whole[None]
                new[k] = new[k] or article < 0 and outer or held[k] <= limit * of
            new[k] = new[k] or above[k] >= 0 and new[above[k]]
        gone = new
    return gone


def parse(page: str) -> Page:
    """The page's blocks outside dropped parts, and its containers."""
    out = Page()
    stack = [_Open("html", False, 0, -1, -1, NONE_OPEN)]
    count: Counter = Counter(html=1)  # open elements by tag
    text: list[str] = []
    links = link = 0
    limits: list[tuple[float, int]] = []  # of each hint: share that it may hold, its article
    above: list[int] = []
    holders: set[int] = set()  # innermost hints around an article or main
    said: list[tuple[int, int, int]] = []  # for each block: characters, hint, article
    has_article = False

    def flush() -> None:
        nonlocal links
        block = " ".join("".join(text).split())
        text.clear()
        top = stack[-1]
        if block and not top.dropped:
            out.blocks.append((block, min(links, len(block)), top.number))
            said.append((len(block) - out.blocks[-1][1], top.hint, top.article))
        links = 0

    def close(upto: int) -> None:
        nonlocal link
        while len(stack) > max(1, upto):
            count[stack.pop().tag] -= 1
        link = 0

    def add(raw: str) -> None:
        nonlocal links
        if raw and not stack[-1].dropped:
            text.append(entities.unescape(raw) if "&" in raw else raw)
            if link:
                links += len(text[-1])

    at = 0
    for start, end, slash, tag, attributes in _tags(page):
        if start < at:  # inside a script or the like
            continue
        add(page[at:start])
        at = end
        if not tag:
            continue
        if tag in RAW and not slash:
            shut = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = shut.end() if shut else len(page)
        elif tag == "a":
            link = 0 if slash else 1
        elif tag == "br":
            text.append(" ")
        elif tag in BLOCKS or tag in FALLBACK or not slash and HIDDEN.search(attributes) and tag not in VOID or (
                slash and count[tag]):
            flush()
            if slash:
                if count[tag] and tag != "html":
                    k = len(stack) - 1
                    while stack[k].tag != tag:
                        k -= 1
                    close(k)
                continue
            if tag == "html" or tag == "body" and count["body"]:
                continue
            if tag == "body" and len(stack) > 1:  # a head that was left open
                close(1)
            if tag in BLOCKS:
                reach = stack[-1].reach
                nearest = max(reach[g] for g in REACH.get(tag, (0,)))
                if nearest:
                    close(nearest)
            if tag == "hr" or attributes.endswith("/") and (tag == "p" or tag not in BLOCKS):
                continue
            up = stack[-1]
            classes = [re.sub(r"\d+", "", c).replace(">", "") for c in _first(CLASS.search(attributes)).lower().split()]
            named = " ".join(_first(x) for x in CLASSES.finditer(attributes)).lower()
            dropped = (up.dropped or tag in DROPPED or tag == "header" and up.article < 0
                       or tag != "body" and HIDDEN.search(attributes) is not None)
            hint, article = up.hint, up.article
            if tag in ("article", "main"):
                has_article = has_article or not dropped
                if hint >= 0:
                    holders.add(hint)
            elif tag != "body":
                words = ASIDE_WORDS.intersection(re.findall(r"[a-z]+", NEGATED.sub(" ", named)))
                if article >= 0:
                    words -= {"header"}
                if words or tag == "form":
                    above.append(hint)
                    hint = len(limits)
                    limits.append((ASIDE_SHARE if words.isdisjoint(named.split()) else NAMED_SHARE, article))
            number = up.number
            if tag in CONTAINERS:
                number = len(out.steps)
                step = ".".join([tag, *sorted({c for c in classes if c})])
                out.steps.append(step)
                out.parents.append(up.number)
                out.keys.append(_key(out.keys[up.number], step))
            if tag in ("article", "main"):
                article = number
            reach = NONE_OPEN if tag in HOLDS else up.reach
            if tag in GROUPS:
                reach = tuple(len(stack) if g == GROUPS[tag] else r for g, r in enumerate(reach))
            stack.append(_Open(tag, dropped, number, hint, article, reach))
            count[tag] += 1
    add(page[at:])
    flush()
    if limits:
        gone = _asides(limits, above, holders, has_article, said)
        out.blocks = [b for b, (_, h, _) in zip(out.blocks, said) if h < 0 or not gone[h]] or out.blocks
    return out


def _best(page: Page) -> tuple[int, float] | None:
    scores: Counter = Counter()
    for said, links, k in page.blocks:
        own = len(said) - links
        scores[k] += own
        if page.parents[k] >= 0:
            scores[page.parents[k]] += own / 2
    if not scores or max(scores.values()) <= 0:
        return None
    best = max(scores, key=lambda k: (scores[k], k))
    return best, float(scores[best])


def best_path(page: str) -> tuple[str, float] | None:
    """(path, score) of the page's best container; the innermost of equal ones."""
    parsed = parse(page)
    best = _best(parsed)
    return (parsed.path(best[0]), best[1]) if best else None


def _inside(page: Page, on: set[int]) -> list[bool]:
    """For each container: is it one of ``on``, or in one of them?"""
    out = []
    for k, up in enumerate(page.parents):
        out.append(k in on or up >= 0 and out[up])
    return out


def _widened(page: Page, on: set[int]) -> set[int]:
    """Each container's nearest article or main, or itself without one; then the
    parents below body whose own text (a headline, a lead) is mostly outside links."""
    tags = [step.partition(".")[0] for step in page.steps]
    own: Counter = Counter()
    for said, links, k in page.blocks:
        own[k] += len(said) - 2 * links
    article, top = [], []  # of each container, from those of its parent
    for k, up in enumerate(page.parents):
        article.append(k if tags[k] in ("article", "main") else article[up] if up >= 0 else -1)
        rises = up >= 0 and tags[up] not in ("html", "body") and own[up] > 0
        top.append(top[up] if rises else k)
    return {top[article[k] if article[k] >= 0 else k] for k in on}


def extract(page: str | None, path: str | None = None) -> str:
    """The text of the containers on ``path``, widened to their article, or on the
    page's own best path if it has none there: blocks in page order, one to a line."""
    if not page:
        return ""
    parsed = parse(page)

    def found(key: bytes) -> list[str]:
        on = {k for k, own in enumerate(parsed.keys) if own == key}
        inside = _inside(parsed, on)
        if not any(inside[k] for _, _, k in parsed.blocks):
            return []
        inside = _inside(parsed, _widened(parsed, on))
        return [said for said, _, k in parsed.blocks if inside[k]]

    said = found(path_key(path)) if path else []
    if not said and (own := _best(parsed)):
        said = found(parsed.keys[own[0]])
    return "\n".join(said)


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        votes: Counter = Counter()
        for host, page in zip(batch["host"], batch["html"]):
            if page and (best := best_path(page)):
                votes[host, best[0]] += best[1]
        yield pd.DataFrame([(h, p, v) for (h, p), v in votes.items()],
                           columns=["host", "path", "score"])


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = batch.drop(columns=["html", "path"])
        out["text"] = [extract(h, p) for h, p in zip(batch["html"], batch["path"])]
        yield out


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html).

    Null or empty html, and pages without text outside menus and the like, give
    the empty string. Pages whose url is null or names no host vote together as
    one host. Equal votes go to the path that sorts last. Repeated rows and rows
    without page_id are each returned. Other columns are ignored.
    """
    host = F.coalesce(F.lower(F.regexp_extract(
        "url", r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    pages = pages.select("page_id", "url", host.alias("host"), "html")
    votes = (pages.select("host", "html").mapInPandas(_votes, "host string, path string, score double")
             .groupBy("host", "path").agg(F.sum("score").alias("score")))
    winners = written(votes.groupBy("host").agg(
        F.max_by("path", F.struct("score", "path")).alias("path")), "paths")
    if winners.count() <= SMALL_HOSTS:
        winners = F.broadcast(winners)
    ids = pages.schema["page_id"].dataType.simpleString()
    return (pages.join(winners, "host", "left").select("page_id", "url", "html", "path")
            .mapInPandas(_texts, f"page_id {ids}, url string, text string"))


def op10_html(pages: DataFrame) -> DataFrame:
    return extract_pages(pages).withColumn("n_chars", F.char_length("text").cast("long"))
