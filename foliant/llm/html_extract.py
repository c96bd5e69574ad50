"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text; neighbouring blocks with the same container form a segment. Three kinds of evidence price
each segment as content and as boilerplate, the capacities from the source and to the sink: what its text looks like
(length, punctuation, links, lists, place), what class names and ids say, and what tags and roles say. A logistic
classifier weighs the first two; it is trained here on a bounded sample of pages, with tags and roles as labels, which it
does not see. Tags and roles add fixed odds, few enough for text and neighbours to overrule an article tag. Neighbours,
and segments that share a container, are tied by smoothness edges that weaken with their distance in the tree. The
minimum cut, found by max-flow, is the cheapest labelling. Reading takes time in proportion to the page, however deep its
elements are nested and whatever end tags are missing.
"""

from __future__ import annotations

import html as _html
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Pages read to train the classifier, its steps, and the ridge that keeps its weights finite.
SAMPLE_PAGES, STEPS, RIDGE = 1_000, 30, 1.0
#: Log odds of an article's tag or role and of one of boilerplate, and how far text and names may sway the odds.
IN_ARTICLE, BY_TAG, TEXT_SWAY, NAME_SWAY = 3.0, -9.0, 4.0, 8.0
#: Strength of a class or id that is named as boilerplate, of one whose word may mean else, and of one that has such a word among others.
BY_CLASS, BY_VAGUE, BY_WORD = 1.0, 0.35, 0.3
#: Capacity of a smoothness edge between neighbours, and between segments of one container.
ADJACENT, PROXIMITY = 0.8, 0.8
#: Bytes of html and text that are held at a time.
HELD = 8_000_000

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is none of the page's; those of _TEXT_ONLY run to the end of the page where no end tag comes.
_RAW = frozenset("script style template noscript textarea title iframe svg annotation annotation-xml select option button".split())
_TEXT_ONLY = frozenset("script style textarea title iframe".split())
#: An option ends with its end tag, and before the next option or the end of its container.
_OPTION_END = re.compile(r"</option\s*>|(?=<(?:option|optgroup)\b|</(?:optgroup|select|datalist)\b)", re.I)
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark math mfrac mi mn mo mover mroot mrow ms msqrt mstyle msub msubsup msup mtext munder munderover q s samp semantics small span strike strong sub sup time tt u var wbr".split())
#: A start tag that ends an open element of the same kind, as HTML lets it.
_SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_BLOCK_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: A quoted value that holds < or > is one only where white space or the tag's end follows it.
_VALUE = r"""\s*+=\s*+("[^"<>]*+"|'[^'<>]*+'|"[^"]*+"(?=[\s/>])|'[^']*+'(?=[\s/>])|[^\s>]*+)"""
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/=]++|[^\s/>=]++(?:{_VALUE})?+)*+)>|<[!?][^>]*>", re.S)
#: A tag whose quotes do not balance ends at the next '>'.
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(rf"([^\s/>=]++)(?:{_VALUE})?+")

BOILER_TAGS = frozenset("nav footer aside menu dialog header".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentary consent cookie cookies discussion disqus feedback footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pagination popup popular promo promoted recommended related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets alert"
    " comentario comentarios commentaire commentaires commenti kommentar kommentare kommentarer werbung anzeige publicidad publicite".split()
)
#: Of these, words that articles and their parts are called as well: text and neighbours may overrule them.
VAGUE_WORDS = frozenset("alert banner discussion feedback header masthead modal notice notices notification popup signup tags toolbar topbar widget widgets".split())
#: Of these, words long enough to be told apart inside a word that is not split: "commentlist", "leftsidebar".
_LONG_WORDS = tuple(w for w in sorted(BOILER_WORDS) if len(w) >= 6)
CONTENT_WORDS = frozenset("article body content entry main post story text".split())
_HEADERS = frozenset(("header", "masthead"))
_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"))
#: Words that make a name say something else: a page that has a sidebar is none.
_ABOUT = frozenset("has is no not with without".split())
#: Words of headings: an id that has one is a heading's address ("on-comments-and-replies"), not the name of a thing.
_PROSE = frozenset("a about an and are as at by for from how in my of on or our the to what when why your au aux das de del der des die du el en et la las le les los ou sur und une ueber von wie y zu zum zur".split())
_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentary consent cookie cookies discussion disqus feedback footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pagination popup popular promo promoted recommended related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets alert"
    " comentario comentarios commentaire commentaires commenti kommentar kommentare kommentarer werbung anzeige publicidad publicite".split()
)
#: Of these, words that articles and their parts are called as well: text and neighbours may overrule them.
VAGUE_WORDS = frozenset("alert banner discussion feedback header masthead modal notice notices notification popup signup tags toolbar topbar widget widgets".split())
#: Of these, words long enough to be told apart inside a word that is not split: "commentlist", "leftsidebar".
_LONG_WORDS = tuple(w for w in sorted(BOILER_WORDS) if len(w) >= 6)
CONTENT_WORDS = frozenset("article body content entry main post story text".split())
_HEADERS = frozenset(("header", "masthead"))
_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"))
#: Words that make a name say something else: a page that has a sidebar is none.
_ABOUT = frozenset("has is no not with without".split())
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


def _is_boiler(word: str) -> bool:
    return word in BOILER_WORDS or any(word.startswith(w) or word.endswith(w) for w in _LONG_WORDS)


def named(name: str, in_article: bool) -> tuple[float, bool]:
    """What one class or id says: (strength of boilerplate evidence, whether it names content).

    The last word of a name is what the thing is ("post-comments" are comments, a "comment-body" is a body); other
    words count little beside a content word, and so do all words of a heading's address. The header of an article is part of it.
    """
    words = [w.lower() for w in _WORDS.findall(name)]
    boiler, content = [w for w in words if _is_boiler(w)], any(w in CONTENT_WORDS for w in words)
    if not words or words[0] in _ABOUT:
        return 0.0, False
    if not boiler:
        return 0.0, words[-1] in CONTENT_WORDS
    if all(w in _HEADERS for w in boiler) and (in_article or content):
        return (0.0 if in_article else BY_WORD), False
    if len(words) > 2 and any(w in _PROSE for w in words):
        return BY_WORD, False
    if _is_boiler(words[-1]) or not content:
        return (BY_VAGUE if all(w in VAGUE_WORDS for w in boiler) else BY_CLASS), False
    return BY_WORD, False


class _Segment:
    """A run of text blocks in one container. low: how many of the open elements around the segment before are still open around this one."""

    __slots__ = ("box", "by_name", "by_tag", "chars", "depth", "heading", "in_article", "items", "linked", "low", "marks", "says_content", "texts")

    def __init__(self, box: int, depth: int, low: int, top: _Open):
        self.box, self.depth, self.low, self.texts, self.chars, self.linked, self.marks = box, depth, low, [], 0, 0, 0
        self.in_article, self.by_tag, self.by_name, self.says_content, self.items, self.heading = *top.evidence(), top.item, top.heading


class _Open:
    """An open element, with what it has from those around it. box, depth: number and depth of the container that its text belongs to."""

    __slots__ = ("box", "by_name", "by_tag", "depth", "form", "heading", "hidden", "in_article", "item", "says_content", "tag")

    def __init__(self, tag: str, around: _Open | None):
        self.tag = tag
        for k in self.__slots__[:-1]:
            setattr(self, k, getattr(around, k) if around else 0)

    def evidence(self) -> tuple:
        return bool(self.in_article), bool(self.by_tag or self.form), float(self.by_name), bool(self.says_content)


#: Elements that are part of the container around them.
_WITHIN = _INLINE | frozenset("p li h1 h2 h3 h4 h5 h6 ul ol dl dt dd tr td th tbody table blockquote pre figure figcaption".split())
_PARTS = frozenset("p li dt dd td th tr".split())


class _Stack:
    """The open elements, with where each kind stands, so that none is looked for by walking down."""

    def __init__(self):
        self.open: list[_Open] = [_Open("", None)]
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # elements that are not inline
        self.walls: list[int] = []  # elements that are neither inline nor such as a start tag ends
        self.low = 1

    def push(self, x: _Open) -> None:
        i = len(self.open)
        self.open.append(x)
        self.at.setdefault(x.tag, []).append(i)
        if x.tag not in _INLINE:
            self.blocks.append(i)
            if x.tag not in _PARTS:
                self.walls.append(i)

    def cut(self, i: int) -> None:
        """Closes element i and all inside it."""
        for x in self.open[i:]:
            self.at[x.tag].pop()
        del self.open[i:]
        for places in (self.blocks, self.walls):
            while places and places[-1] >= i:
                places.pop()
        self.low = min(self.low, i)

    def last(self, tag: str) -> int:
        found = self.at.get(tag)
        return found[-1] if found else 0

    def end(self, tag: str) -> None:
        """An end tag: closes the innermost element of its kind, an inline one only within its block."""
        i = self.last(tag)
        if i and not (tag in _INLINE and self.blocks and self.blocks[-1] > i):
            self.cut(i)

    def ends(self, tags: set[str]) -> None:
        """A start tag that closes the innermost of these, unless another kind of block lies between."""
        i = max(map(self.last, tags))
        if i and not (self.walls and self.walls[-1] > i):
            self.cut(i)

    def links(self) -> bool:
        return bool(self.at.get("a"))


class _Ends:
    """Where the text of elements that hold none of the page's ends: each kind's end tags are looked for once over the page."""

    def __init__(self, page: str):
        self.page, self.next = page, {}

    def after(self, tag: str, at: int) -> int:
        """Where it ends, or -1."""
        start, end = self.next.get(tag, (-1, -1))
        if start != len(self.page) and start < at:
            m = (_OPTION_END if tag == "option" else re.compile(rf"</{re.escape(tag)}\s*>", re.I)).search(self.page, at)
            start, end = self.next[tag] = (m.start(), m.end()) if m else (len(self.page), -1)
        return end


def segments(page: str) -> list[_Segment]:
    """The page's text blocks, in order, gathered into runs that share a container."""
    out: list[_Segment] = []
    stack, ends = _Stack(), _Ends(page)
    words: list[str] = []
    linked, serial, at, n = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal words, linked
        text = " ".join("".join(words).split())
        words = []
        if text:
            top = stack.open[-1]
            last = out[-1] if out else None
            if not last or last.box != top.box or (last.in_article, last.by_tag, last.by_name, last.says_content) != top.evidence() or last.items != top.item:
                out.append(_Segment(top.box, top.depth + 1, stack.low, top))
                stack.low = top.depth + 1
            s = out[-1]
            s.texts.append(text)
            s.chars += len(text)
            s.linked += min(linked, len(text))
            s.marks += sum(map(text.count, ".,;:?!"))
        linked = 0

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            raw = page[at:lt]
            if not stack.open[-1].hidden:
                words.append(_html.unescape(raw) if "&" in raw else raw)
                if stack.links():
                    linked += len(raw.strip())
        if lt >= n:
            break
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            if re.match(r"</?[a-zA-Z!?]", page[lt : lt + 3]):
                break  # a tag that the end of the page cuts off
            words.append("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in _INLINE:
                flush()
            stack.end(tag)
            continue
        if tag == "br" or tag not in _INLINE:
            flush()
        if tag in _BLOCK_ENDS_P or tag in _SELF_CLOSING:
            stack.ends(_SELF_CLOSING.get(tag, set()) | ({"p"} if tag in _BLOCK_ENDS_P else set()))
        if tag in _VOID or m[3].endswith("/"):
            continue
        if tag in _RAW:
            end = ends.after(tag, at)
            if end >= 0 or tag in _TEXT_ONLY:
                at = end if end >= 0 else n
            continue
        top = stack.open[-1]
        x = _Open(tag, top)
        x.in_article = top.in_article or tag in CONTENT_TAGS
        x.form = (top.form or tag == "form") and tag not in CONTENT_TAGS  # there may be a form around the whole page
        x.by_tag = top.by_tag or (tag in BOILER_TAGS and not (tag == "header" and top.in_article))
        x.item, x.heading = top.item or tag in ("li", "td", "dd", "dt"), top.heading or tag in ("h1", "h2", "h3")
        if m[3] and tag not in ("html", "body"):
            for a in _ATTR.finditer(m[3]):
                kind, value = a[1].lower(), (a[2] or "").strip("\"'")
                if kind == "hidden" or kind == "style" and re.search(r"display\s*:\s*none", value):
                    x.hidden = True
                elif kind == "role":
                    got = {w.lower() for w in _WORDS.findall(value)}
                    x.by_tag = x.by_tag or bool(got & _ROLES)
                    x.in_article = x.in_article or bool(got & {"main", "article"})
                elif kind in ("class", "id"):
                    for name in value.split():
                        strength, is_content = named(name, bool(top.in_article or tag in CONTENT_TAGS))
                        x.by_name, x.says_content = max(x.by_name, strength), x.says_content or is_content
        if tag not in _WITHIN:
            serial += 1
            x.box, x.depth = serial, len(stack.open)
        stack.push(x)
    flush()
    return out


def features(seg: list[_Segment]) -> np.ndarray:
    """One row per segment: what the classifier sees of the text and its place, and last of its names."""
    total = sum(s.chars for s in seg) or 1
    k = len(seg)
    return np.array(
        [[1.0, s.linked / s.chars, min(s.chars, 2000) / 2000, s.chars / total, min(s.marks / s.chars * 50, 2.0), min(s.chars / len(s.texts), 400) / 400, bool(s.items), bool(s.heading), i / k, s.by_name, s.says_content and not s.by_name] for i, s in enumerate(seg)],
        dtype=float,
    ).reshape(k, N_FEATURES)


#: Weights of the features, and where training starts: text that is long, punctuated and not linked; names as they are meant.
PRIOR = (-1.0, -4.0, 2.0, 2.0, 1.0, 1.5, -0.5, 0.5, 0.0, -8.0, 2.0)
N_FEATURES, N_NAMES = len(PRIOR), 2


def examples(page: str) -> list[tuple[float, np.ndarray]]:
    """(1, mean features of content) and (0, those of boilerplate) of a page whose tags and roles tell them apart; else none.

    A page speaks once for either, however many segments it has.
    """
    seg = segments(page)
    if not seg:
        return []
    x = features(seg)
    content, boiler = [s.in_article and not s.by_tag for s in seg], [s.by_tag for s in seg]
    if not any(content) or not any(boiler):
        return []
    return [(y, x[np.array(pick)].mean(axis=0)) for y, pick in ((1.0, content), (0.0, boiler))]


def train(rows: list[tuple[float, np.ndarray]], steps: int = STEPS) -> np.ndarray:
    """Logistic weights from (label, features), by Newton's method with a ridge towards PRIOR; PRIOR without rows."""
    w, prior = np.array(PRIOR), np.array(PRIOR)
    if not rows:
        return w
    y, x = np.array([r[0] for r in rows]), np.vstack([r[1] for r in rows])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + RIDGE * (w - prior)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(N_FEATURES), slope)
    return w


def log_odds(seg: list[_Segment], weights: np.ndarray) -> np.ndarray:
    """Of being content, for each segment: what its text and its names say, within bounds, and what tags say."""
    x, words = features(seg), N_FEATURES - N_NAMES
    text = np.clip(x[:, :words] @ weights[:words], -TEXT_SWAY, TEXT_SWAY)
    names = np.clip(x[:, words:] @ weights[words:], -NAME_SWAY, NAME_SWAY)
    return text + names + IN_ARTICLE * np.array([s.in_article for s in seg], float) + BY_TAG * np.array([s.by_tag for s in seg], float)


def min_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source side of a minimum cut; edges are undirected.

    A node whose own costs differ by more than all its edges can carry takes the cheaper side in every minimum cut, and
    its edges become costs of its neighbours: this settles most nodes in linear time. The others are cut by max-flow with
    blocking flows.
    """
    n = len(source)
    lean = [a - b for a, b in zip(source, sink, strict=True)]  # above 0: the source side is cheaper
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in edges:
        if i != j:
            near[i][j] = near[i].get(j, 0.0) + c
            near[j][i] = near[j].get(i, 0.0) + c
    carry = [sum(x.values()) for x in near]
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(lean[i]) <= carry[i]:
            continue
        side[i] = lean[i] > 0
        for j, c in near[i].items():
            if side[j] is None:
                lean[j] += c if side[i] else -c
                carry[j] -= c
                queue.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        at = {i: k for k, i in enumerate(rest)}
        some = [(at[i], at[j], c) for i in rest for j, c in near[i].items() if i < j and j in at]
        for i, on in zip(rest, _max_flow([lean[i] for i in rest], some), strict=True):
            side[i] = on
    return [bool(x) for x in side]


def _max_flow(lean: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The source side of a minimum cut: nodes that can still be reached when no flow can be added."""
    n = len(lean)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(i: int, j: int, there: float, back: float) -> None:
        out[i].append(len(to))
        to.append(j)
        cap.append(there)
        out[j].append(len(to))
        to.append(i)
        cap.append(back)

    for i, x in enumerate(lean):
        if x > 0:
            add(s, i, x, 0.0)
        elif x < 0:
            add(i, t, -x, 0.0)
    for i, j, c in edges:
        add(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if cap[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        arc, path, u = [0] * (n + 2), [], s
        while True:  # a blocking flow: depth first, every arc given up once
            if u == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if cap[e] <= 1e-12)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while arc[u] < len(out[u]):
                e = out[u][arc[u]]
                if cap[e] > 1e-12 and level[to[e]] == level[u] + 1:
                    break
                arc[u] += 1
            if arc[u] < len(out[u]):
                path.append(out[u][arc[u]])
                u = to[path[-1]]
            elif path:
                u = to[path.pop() ^ 1]
                arc[u] += 1
            else:
                break


def label(seg: list[_Segment], weights: np.ndarray, adjacent: float = ADJACENT, proximity: float = PROXIMITY) -> list[bool]:
    """Whether each segment is content."""
    if not seg:
        return []
    odds = log_odds(seg, weights)
    edges, last = [], {}
    for i, s in enumerate(seg):
        if i:
            common = min(seg[i - 1].depth, s.depth, s.low)
            edges.append((i - 1, i, adjacent / (1 + seg[i - 1].depth + s.depth - 2 * common)))
        if s.box in last:
            edges.append((last[s.box], i, proximity))
        last[s.box] = i
    # the cost of calling content boilerplate and the other way round: -log of the other's probability
    return min_cut(np.logaddexp(0, odds).tolist(), np.logaddexp(0, -odds).tolist(), edges)


def main_text(page: str, weights: np.ndarray) -> str:
    seg = segments(page)
    return " ".join(t for s, is_content in zip(seg, label(seg, weights), strict=True) if is_content for t in s.texts)


def sampled_weights(pages: DataFrame, sample: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights trained on at most `sample` pages, picked by a hash of page_id and url. Pages are read whole, in tasks; two rows of features a page reach the driver."""
    # a share of about 0.8 * sample pages is parsed, so that the work does not grow with the table
    part = max(1, pages.count() * 5 // (sample * 4))
    key = F.xxhash64(F.col("page_id").cast("long"), F.col("url").cast("string"))
    pick = pages.select(key.alias("key"), F.col("html").cast("string").alias("html")).where(F.pmod("key", F.lit(part)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, y, x.tolist()) for k, h in zip(b["key"].to_pylist(), b["html"].to_pylist(), strict=True) for y, x in examples(h or "")]
            cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.list_(pa.float64()))], names=["key", "y", "x"])

    rows = pick.mapInArrow(run, "key long, y double, x array<double>").orderBy("key", "y", "x").limit(2 * sample).collect()
    return train([(r["y"], np.array(r["x"])) for r in rows])


def extract(pages: DataFrame, sample: int = SAMPLE_PAGES, weights: np.ndarray | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null and empty html gives empty text. The whole html is parsed, however long; broken markup is read as browsers
    do where it matters here (unclosed elements, cut-off tags, character references without semicolon). Repeated rows
    are pages of their own. An empty table gives an empty result. Columns other than page_id, url and html are
    ignored. The classifier is trained on at most `sample` pages (see `sampled_weights`).
    """
    w = sampled_weights(pages, sample) if weights is None else weights

    def told(b: pa.RecordBatch, at: int, text: list[str]) -> pa.RecordBatch:
        some = b.slice(at, len(text))
        return pa.RecordBatch.from_arrays([some["page_id"], some["url"], pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, text, held = 0, [], 0
            for i in range(b.num_rows):
                page = b["html"][i].as_py() or ""
                text.append(main_text(page, w))
                held += len(page)
                if held > HELD:
                    yield told(b, at, text)
                    at, text, held = i + 1, [], 0
            if text:
                yield told(b, at, text)

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
