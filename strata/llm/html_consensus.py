"""HTML main-text extraction with consensus host paths.

1. Each page is parsed and its containers are scored by the text they hold outside
   boilerplate, links discounted. Tags, roles and hiding mark boilerplate for sure; words in
   classes only hint at it, and give way to what names the article. From the body down, the page descends as long as one
   container holds most of the score; where it stops is its vote.
2. A vote is a generalised path: the tags from the body down, with their classes (digits
   and hashes taken out, and words that few of the host's pages have: names of an article,
   a category or a tag). Votes are added up per host and path in Spark, and each page's own
   containers are joined with them; no list of a host's paths is made.
3. Each page is extracted again from its host's winning path: of the paths that hold text
   on the page, the one of most votes of other pages times the page's own score. So pages that are short, cut off or full of adverts
   follow their siblings. A page without any such path, or without a host, follows its
   own vote.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

# Elements whose content is never text of the page; the content of RAW is not markup.
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
BOILERPLATE = frozenset(
    "head script style title textarea noscript template iframe nav header footer aside form button select option "
    "input label fieldset menu dialog svg canvas audio video object embed map datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html "
    "legend li main ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("body main article section div td table center blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that an opening tag closes, if they are open below the nearest barrier.
CLOSES = {**{b: {"p"} for b in BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}},
          "li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "option": {"option"},
          "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
          "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th", "p"}, "body": {"head"}}
BARRIERS = frozenset("div section article main body table ul ol dl td th blockquote aside nav header footer form".split())
# Words in a class or id that hint at menus, adverts and notices, and those of reader comments.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted banner banners menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar side widget widgets header footer masthead topbar toolbar cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended teaser teasers tags "
    "pagination pager copyright legal disclaimer skip hidden alert paywall search outbrain taboola".split())
COMMENTS = frozenset("comment comments commentlist discussion replies respond disqus".split())
# What says something about an element rather than what it is: a state, a layout or a subject.
_ABOUT = re.compile(
    r"(?:has|no|not|non|with|without|is|are|can|show|shows|hide|hides|js|category|cat|tag|topic|subject|section|type|format|status|author|"
    r"lang|page|single|template|theme|layout|view|style|skin|color|bg|col|row|grid|span|size|align|float|m|p|u)[-_].*"
    r"|.*[-_](?:enabled|disabled|on|off|open|closed|active|inactive|visible|allowed|ready|loaded|less|free|layout|theme|template|style)", re.S)
# Classes that usually name the article's own text.
ARTICLE_WORDS = frozenset(
    "article articlebody article-body article-content article-text article__body article__content content entry entry-content "
    "entry__content main-content page-content post post-body post-content post-text post__body post__content single-content story "
    "story-body story-content story-text story__body text-content td-post-content".split())
NOISY_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
SALTS = 32           # places a host's pages are dealt to
COMMON = 10          # a class word counts if one in so many of the host's pages has it
MOST = 0.8           # share of the score a container must hold to descend into it
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|</?[a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[a-zA-Z][^<>]*+>"
                    r"|</?[a-zA-Z][^<]*\Z|[^<]+|<", re.S)
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HASHED = re.compile(r"[0-9]+|(?<=[_-])[0-9a-f]{6,}")


class Node:
    __slots__ = ("tag", "parent", "label", "noise", "hint", "named", "score", "chars", "items", "children")

    def __init__(self, tag, parent, label, noise, hint="", named=False):
        self.tag, self.parent, self.label, self.noise, self.hint, self.named = tag, parent, label, noise, hint, named
        self.score, self.chars, self.items, self.children = 0.0, 0, [], []

    def path(self) -> str:
        out, node = [], self
        while node is not None and node.tag != "html":
            out.append(node.label)
            node = node.parent
        return ">".join(reversed(out))


def _attributes(tag_text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(tag_text)}


def _label(tag: str, classes: str) -> str:
    names = sorted({g for c in re.split(r"[\s.>]+", classes.lower()) if (g := _HASHED.sub("", c).strip("_-"))})
    return ".".join([tag, *names])


def _is_noise(tag: str, a: dict[str, str], inside_article: bool) -> bool:
    """Whether an element is surely no text of the article: by its tag, its role, or hidden."""
    if tag in BOILERPLATE and not (tag == "header" and inside_article):
        return True
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in NOISY_ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none", a.get("style", ""), re.I))


def _hint(tag: str, a: dict[str, str]) -> str:
    """What the class and id hint at: "noise", "comments" or nothing. The words of a name count
    where it says what the element is (``share-bar``, ``post__comments``), not in what it says
    about it (``has-sidebar``, ``category-search``, ``story--no-comments``)."""
    if tag in ("body", "html", "main"):
        return ""
    found = ""
    for name in f"{a.get('class', '')} {a.get('id', '')}".lower().split():
        name = name.split("--")[0]
        if not name or _ABOUT.fullmatch(name):
            continue
        words = set(re.split(r"[-_]+", name))
        if words & COMMENTS:
            return "comments"
        if words & NOISE:
            found = "noise"
    return found


def _names_article(tag: str, a: dict[str, str]) -> bool:
    return (tag in ("article", "main") or a.get("role", "").lower() in ("main", "article") or a.get("itemprop", "").lower() == "articlebody"
            or not ARTICLE_WORDS.isdisjoint(a.get("class", "").lower().split()) or a.get("id", "").lower() in ARTICLE_WORDS)


def _text_size(parts: list) -> int:
    return sum(len(" ".join(entities.unescape(x).split())) for x in parts if isinstance(x, str))


def _weigh_hints(body: Node) -> None:
    """Settle which elements with a hint are left out (``noise``).

    A hint alone doesn't take the article away. Text is weighed where it lies: in full
    outside all hints, a quarter of it under a hint of noise, none under one of comments; links count
    against it. Of the elements that name an article, the one of most weight is the
    article, and no hint on it or above it counts. Where there is none and the hints would
    leave no text, the same holds for the element under hints that has most. Hints inside
    the article count, unless nothing but headings would be left of it."""
    order, todo = [], [(body, "", False)]
    outer: dict[int, str] = {}  # the strongest hint on or above an element
    weight: dict[int, float] = {}
    while todo:
        node, above, in_link = todo.pop()
        mark = "comments" if "comments" in (above, node.hint) else node.hint or above
        outer[id(node)] = mark
        order.append(node)
        own = _text_size(node.items)
        weight[id(node)] = (-0.5 if in_link else 1.0) * own * {"": 1.0, "noise": 0.25, "comments": 0.0}[mark]
        node.chars = own if not mark and node.tag not in HEADINGS else 0
        todo.extend((c, mark, in_link or c.tag == "a") for c in node.children if not c.noise)
    for node in reversed(order[1:]):
        weight[id(node.parent)] += weight[id(node)]
        if node.tag not in HEADINGS:
            node.parent.chars += node.chars
    if all(not outer[id(n)] for n in order):
        return

    def clear(node: Node) -> None:
        while node is not None:
            node.hint = ""
            node = node.parent

    named = [n for n in order if n.named and weight[id(n)] > 0]
    article = max(named, key=lambda n: weight[id(n)], default=None)  # of equal ones the outermost
    if article is None and body.chars == 0:
        hinted = [n for n in order if n.hint == "noise" and outer[id(n)] == "noise" and weight[id(n)] > 0]
        article = max(hinted, key=lambda n: weight[id(n)], default=None)
    if article is not None:
        clear(article)
        size, hinted = _open_text(article)
        while not size and any(weight[id(n)] > 0 for n in hinted):  # the largest part under a hint is the text
            part = max(hinted, key=lambda n: weight[id(n)])
            part.hint = ""
            size, hinted = _open_text(part)
    for node in order:
        node.noise = node.noise or bool(node.hint)


def _open_text(node: Node) -> tuple[int, list[Node]]:
    """Size of the text below ``node`` outside headings, hints and noise; the elements hinted
    to be noise that are met on the way."""
    size, hinted, todo = 0, [], [node]
    while todo:
        n = todo.pop()
        size += _text_size(n.items)
        for c in n.children:
            if c.hint == "noise" and not c.noise:
                hinted.append(c)
            elif not c.noise and not c.hint and c.tag not in HEADINGS:
                todo.append(c)
    return size, hinted


def parse(page: str) -> Node:
    """A tree of elements; ``items`` are texts (str) and child nodes in page order. Repairs
    what browsers repair: void and unclosed elements, stray end tags, missing body."""
    root = Node("html", None, "html", False)
    body = Node("body", root, "body", False)
    root.items.append(body)
    root.children.append(body)
    stack, raw = [body], None
    # Where the open elements are: below each open barrier, by tag; and the barriers, by tag.
    below: list[dict[str, list[int]]] = [{}]
    barriers: dict[str, list[int]] = {}
    articles = 0

    def close(k: int):
        nonlocal articles
        while len(stack) > k:
            tag = stack.pop().tag
            if tag in BARRIERS:
                below.pop()
                barriers[tag].pop()
            else:
                below[-1][tag].pop()
            articles -= tag in ("article", "main")

    at = 0
    while at < len(page):
        if raw is not None:
            end = re.compile(rf"</{raw}\s*>", re.I).search(page, at)
            at, raw = (end.end() if end else len(page)), None
            continue
        m = _TOKEN.match(page, at)
        token, at = m.group(), m.end()
        if token[0] != "<" or token == "<":
            stack[-1].items.append(token)
            continue
        if token.startswith("<![CDATA["):
            stack[-1].items.append(entities.escape(token[9:].removesuffix("]]>")))
            continue
        if token[1] in "!?" or not token.endswith(">"):
            continue
        tag = _TAG.match(token)[1].lower()
        if token[1] == "/":
            if tag in ("html", "body"):
                continue
            # An end tag passes a barrier only if it is one.
            opened = (barriers if tag in BARRIERS else below[-1]).get(tag)
            if opened:
                close(opened[-1])
            continue
        if tag in ("html", "body"):
            a = _attributes(token)
            if tag == "body":
                body.label = _label("body", a.get("class", ""))
            continue
        if tag in RAW and not token.endswith("/>"):
            raw = tag
            continue
        closes = CLOSES.get(tag)
        while closes:
            first = min((o[0] for c in closes if (o := below[-1].get(c))), default=None)
            if first is not None:
                close(first)
            k = max((o[-1] for o in barriers.values() if o), default=0)
            if k == 0 or stack[k].tag not in closes:
                break
            close(k)
        parent = stack[-1]
        a = _attributes(token)
        node = Node(tag, parent, _label(tag, a.get("class", "")), _is_noise(tag, a, articles > 0), _hint(tag, a), _names_article(tag, a))
        parent.items.append(node)
        parent.children.append(node)
        if tag not in VOID and not token.endswith("/>"):
            if tag in BARRIERS:
                barriers.setdefault(tag, []).append(len(stack))
                below.append({})
            else:
                below[-1].setdefault(tag, []).append(len(stack))
            articles += tag in ("article", "main")
            stack.append(node)
    _weigh_hints(body)
    return body


def _score(body: Node) -> None:
    """Characters of text outside boilerplate (``chars``); those of links counted against
    it (``score``)."""
    order, todo = [], [(body, False)]
    while todo:
        node, in_link = todo.pop()
        order.append(node)
        own = _text_size(node.items)
        node.chars = own
        node.score = -0.5 * own if in_link else float(own)
        todo.extend((c, in_link or c.tag == "a") for c in node.children if not c.noise)
    for node in reversed(order[1:]):
        node.parent.score += node.score
        node.parent.chars += node.chars


def best_container(body: Node) -> Node:
    _score(body)
    node = body
    while node.tag not in ("article", "main") or any(c.tag == "article" and not c.noise for c in node.children):
        inner = [c for c in node.children if not c.noise and c.tag in CONTAINERS]
        top = max(inner, key=lambda c: c.score, default=None)
        if top is None or top.score <= 0 or top.score < MOST * node.score:
            break
        node = top
    return node


def containers(body: Node) -> list[Node]:
    """Containers of any text outside boilerplate, in page order, once ``_score`` ran."""
    found, todo = [], [body]
    while todo:
        node = todo.pop()
        if node.chars:
            if node.tag in CONTAINERS:
                found.append(node)
            todo.extend(c for c in reversed(node.children) if not c.noise)
    return found


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below ``node``, boilerplate left out, in page order."""
    out: list[list[str]] = [[]]

    todo = [iter(node.items)]
    ends = [False]  # whether the element is a block, which ends at its last item
    while todo:
        item = next(todo[-1], None)
        if item is None:
            todo.pop()
            if ends.pop():
                out.append([])
        elif isinstance(item, str):
            out[-1].append(item)
        elif item.tag == "br":
            out[-1].append(" ")
        elif not item.noise:
            block = item.tag in BLOCKS
            if block:
                out.append([])
            todo.append(iter(item.items))
            ends.append(block)
    texts = (" ".join(entities.unescape("".join(parts)).split()) for parts in out)
    return [t for t in texts if t]


def vote(page: str | None) -> tuple[str, float]:
    """(generalised path, score) of the page's best container; no path for a page of no text."""
    body = parse(page or "")
    node = best_container(body)
    return (node.path(), node.score) if node.score > 0 else ("", 0.0)


def outline(page: str | None) -> tuple[int, list[int], list[str]]:
    """(place of the page's vote or -1, places of the containers' next outer containers or
    -1, their paths from there): a page's containers without their text."""
    body = parse(page or "")
    best = best_container(body)
    found = containers(body)
    place = {id(n): i for i, n in enumerate(found)}
    outer, steps = [], []
    for node in found:
        labels, up = [node.label], node.parent
        while up is not None and id(up) not in place and up.tag != "html":
            labels.append(up.label)
            up = up.parent
        outer.append(place.get(id(up), -1))
        steps.append(">".join(reversed(labels)))
    return (place[id(best)] if best.score > 0 else -1), outer, steps


def class_words(step: str) -> set[str]:
    return {w for label in step.split(">") for w in label.split(".")[1:]}


def common_path(step: str, words: frozenset[str]) -> str:
    """``step`` without the class words that are not in ``words``."""
    labels = (label.split(".") for label in step.split(">"))
    return ">".join(".".join([tag, *(w for w in names if w in words)]) for tag, *names in labels)


def choose(found: list[Node], listed: dict[str, tuple[int, list[int]]]) -> str | None:
    """The path of ``listed`` (votes of other pages, places in ``found``) to read the page from.

    Votes count by the score the path has on this page, so an empty or short container of
    another template does not win over the page's own; inside the one chosen, a path of
    more votes goes first. If all have only links, votes alone count."""
    voted = {p: (votes, sum(found[i].score for i in places)) for p, (votes, places) in listed.items() if votes > 0}
    scored = {p: v for p, v in voted.items() if v[1] > 0}
    if not scored:
        return min(voted, key=lambda p: (-voted[p][0], len(p), p), default=None)
    path, inside = None, scored
    while inside:
        path = min(inside, key=lambda p: (-inside[p][0] * inside[p][1], -inside[p][0], len(p), p))
        inside = {p: v for p, v in inside.items() if p.startswith(path + ">") and v[0] > inside[path][0]}
    return path


def extract(page: str | None, voted: list[tuple[int, int, str]]) -> tuple[str, str]:
    """(text, path) of a page from its containers that have votes (place, votes, path), its
    own vote among them; from its own best if no other page voted for any."""
    body = parse(page or "")
    best = best_container(body)
    found = containers(body)
    listed: dict[str, tuple[int, list[int]]] = {}
    for at, votes, path in sorted(set(voted)):
        listed.setdefault(path, (votes, []))[1].append(at)
    own = next((p for p, (_, places) in listed.items() if any(found[i] is best for i in places)), None)
    if own is not None and best.score > 0:
        listed[own] = (listed[own][0] - 1, listed[own][1])
    path = choose(found, listed)
    nodes = [best] if path is None else [found[i] for i in listed[path][1]]
    if path is None:
        path = best.path() if own is None else own
    return "\n".join(t for n in nodes for t in blocks(n)), path


def host_of(url):
    """Host of a URL, lower case, without port and user; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, host, path, text, n_chars.

    Blocks are joined by one line feed, white space inside a block is one space, character
    references are decoded. Null and empty pages give an empty text; pages without a host
    follow their own vote; pages of any length and depth are read whole; repeated rows vote and are extracted once each; ties go
    to more votes, then the shorter, then smaller path; an empty table gives no row; other columns are
    ignored. A class word counts if two pages of the host, and one in ``COMMON``, have it
    (a host of one page: any)."""

    def outlines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [outline(h) for h in pdf["html"]]
            yield pd.DataFrame({"row": pdf["row"], "host": pdf["host"], "best": [b for b, _, _ in got],
                                "outer": [o for _, o, _ in got], "steps": [s for _, _, s in got],
                                "words": [sorted(set().union(*map(class_words, s))) for _, _, s in got]})

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_128_digest
        for pdf in batches:
            out = []
            for row, host, best, outer, steps, words in zip(*[pdf[c] for c in ("row", "host", "best", "outer", "steps", "common")]):
                common = frozenset(words if words is not None else ())
                steps = [common_path(s, common) for s in steps]
                made: list[bytes] = []
                for o, s in zip(outer, steps):
                    made.append(digest((made[o] if o >= 0 else host.encode() + b"\0") + s.encode()))
                path, at = [], best
                while at >= 0:
                    path.append(steps[at])
                    at = outer[at]
                vote = ">".join(reversed(path))
                out += [(row, i, k, vote if i == best else None) for i, k in enumerate(made)]
            yield pd.DataFrame(out, columns=["row", "place", "key", "vote"])

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [extract(h, [(v["place"], v["votes"], v["path"]) for v in w] if w is not None else [])
                   for h, w in zip(pdf["html"], pdf["voted"])]
            yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "host": pdf["host"],
                                "path": [p for _, p in got], "text": [t for t, _ in got]})

    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").alias("html"), host_of(F.col(f"`{url_col}`")).alias("host"))
    # Rows of the same id, host and page have the same outcome.
    rows = rows.withColumn("row", F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")),
                                                            F.length("host"), "host", F.coalesce("html", F.lit(""))))))
    # Pages without a host have no siblings.
    made = materialise(rows.filter("host <> ''").select("row", "host", "html").mapInPandas(
        outlines, "row binary, host string, best int, outer array<int>, steps array<string>, words array<string>")
        .filter("size(steps) > 0"))
    sizes = made.groupBy("host").agg(F.count("*").alias("pages"))
    counted = made.select("host", F.explode("words").alias("word")).groupBy("host", "word").agg(F.count("*").alias("n"))
    # Of a host, at most COMMON times the words of a page: their shares add up to that mean.
    common = (counted.join(sizes, "host").filter((F.col("n") * COMMON >= F.col("pages")) & ((F.col("n") > 1) | (F.col("pages") == 1)))
              .groupBy("host").agg(F.collect_list("word").alias("common")))
    # A host may hold a third of the pages: its outlines go to SALTS places, its words to each of them.
    common = common.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = made.drop("words").withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    keyed = materialise(salted.join(common, ["host", "_salt"], "left").mapInPandas(
        keys, "row binary, place int, key binary, vote string"))
    votes = keyed.filter("vote is not null").groupBy("key").agg(F.count("*").alias("votes"), F.min("vote").alias("path"))
    # A path may be on most pages (the body): its votes go to SALTS places as well.
    votes = votes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    voted = (keyed.drop("vote").withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(votes, ["key", "_salt"])
             .groupBy("row").agg(F.collect_set(F.struct("place", "votes", "path")).alias("voted")))  # repeated rows: once
    return (rows.join(voted, "row", "left").drop("row")
            .mapInPandas(texts, "page_id long, url string, host string, path string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
