"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into its leaf blocks: runs of text between block-level tags, with inline markup taken out, character
references decoded and white space made single spaces. Scripts, styles, comments and other parts without page text are
no blocks. Each block has features of its ancestors (their tags and the words of their class, id and role) and of its
text (length, share of links, end mark, words typical of page furniture). The field has two labels, main text or not,
weights for the features and for pairs of neighbouring labels; it is trained on labelled pages by gradient steps on the
likelihood (forward-backward) and decoded by Viterbi. The main text is the blocks so labelled, in page order.

No table has labelled pages, so labelled_pages() makes them by rule: containers, furniture and their names as common
page templates have them, filled with invented prose.

The chain of a block's ancestors is a node of a tree that blocks and pages share, with what its features weigh, so time
and memory grow with the page however deep its elements nest.

Edge cases: null or empty html, or html without text, gives an empty text; unclosed, crossed and cut-off tags are read
as far as they go; very long and very deep pages are read whole; repeated rows get equal results; an empty table gives an empty
result; extra columns are ignored; a null url or page_id is carried along.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import small_batches, table

# Kinds of elements.
#: Elements without page text: the first run to the end of the page if unclosed, the others count only if closed.
RUNNING = "script style noscript iframe textarea title".split()
NESTING = "template svg object math canvas audio video select datalist".split()
#: What can stand in head; anything else closes it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul br caption".split()
)
SECTIONS = frozenset("article aside dialog footer form header main nav section".split())
#: An opening tag closes the nearest of these, unless one of the second group stands between.
CLOSES = {
    "p": ({"p"}, {"div", "td", "li", "article", "section", "blockquote", "body", "aside"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
CLOSES |= {t: CLOSES["p"] for t in "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header main nav ol pre section table ul".split()}
QUOTED = "(?>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*)"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RUNNING + NESTING)})(?=[\s/>]){QUOTED}(?<=/)>"
    rf"|<({'|'.join(RUNNING)})(?=[\s/>])[^>]*>.*?(?:</\2\s*>|\Z)"
    rf"|<({'|'.join(NESTING)})(?=[\s/>])[^>]*>"
    r"|<(/?)([a-zA-Z][^\s>/]*+)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
FURNITURE = re.compile(
    r"(?i)\b(cookies?|consent|subscribe|newsletter|sign up|log ?in|register|menu|home|share|tweet|comments?|repl(?:y|ies)|privacy|terms|"
    r"advertisement|sponsored|promoted|related|search|skip to|read more|follow us|copyright|all rights reserved|next|previous|tags?)\b|©"
)


def element(tag: str, attributes: str) -> str:
    """An element as its tag and the words of its names: 'div:ad:side'."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return tag
    names = [w.lower() for m in NAMES.finditer(attributes) for w in WORDS.findall(m[1] or m[2] or m[3] or "")]
    if HIDDEN.search(attributes):
        names.append("hidden")
    return ":".join([tag, *dict.fromkeys(names)]) if names else tag


def closed_parts(page: str) -> dict[int, int]:
    """Start of each NESTING element that is closed, and where it ends."""
    found: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for m in TOKEN.finditer(page):
        if m[3]:
            opened.setdefault(m[3].lower(), []).append(m.start())
        elif m[4] and opened.get(m[5].lower()):
            found[opened[m[5].lower()].pop()] = m.end()
    return found


class Path:
    """A chain of block-level ancestors: its last element and the chain above. Equal chains below one root are one node."""

    __slots__ = ("up", "element", "below", "weighed")

    def __init__(self, up: Path | None = None, element: str = "") -> None:
        self.up, self.element = up, element
        self.below: dict[str, Path] = {}
        self.weighed: tuple[float, float, frozenset[str], float] | None = None

    def child(self, element: str) -> Path:
        found = self.below.get(element)
        if found is None:
            found = self.below[element] = Path(self, element)
        return found

    def elements(self) -> tuple[str, ...]:
        out, node = [], self
        while node.up is not None:
            out.append(node.element)
            node = node.up
        return tuple(reversed(out))


class Open:
    """The open elements: their tags, where each tag stands, and the path of block-level ones down to each."""

    def __init__(self, root: Path) -> None:
        self.root = root
        self.tags: list[str] = []
        self.paths: list[Path] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def path(self) -> Path:
        return self.paths[-1] if self.paths else self.root

    def last(self, tag: str) -> int:
        found = self.places.get(tag)
        return found[-1] if found else -1

    def push(self, tag: str, attributes: str) -> None:
        at, path = len(self.tags), self.path()
        if tag in BLOCK:
            self.blocks.append(at)
            path = path.child(element(tag, attributes))
        self.tags.append(tag)
        self.paths.append(path)
        self.places.setdefault(tag, []).append(at)

    def cut(self, at: int) -> None:
        """Closes everything from place `at` on."""
        while len(self.tags) > at:
            self.places[self.tags.pop()].pop()
            self.paths.pop()
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()

    def mask(self, tag: str) -> None:
        """Takes the last inline element of a tag out, leaving those inside it open."""
        at = self.places[tag].pop()
        self.tags[at] = "-"
        self.places.setdefault("-", []).append(at)
        self.places["-"].sort()

    def linked(self) -> bool:
        return bool(self.places.get("a"))


def leaves(page: str | None, root: Path) -> list[tuple[Path, str, float]]:
    """(path below root, text, share of its characters in links) of each leaf block with text, in page order."""
    out: list[tuple[Path, str, float]] = []
    open_ = Open(root)
    parts: list[str] = []
    linked = 0
    in_head = False
    closed: dict[int, int] | None = None

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((open_.path(), text, linked / max(1, sum(map(len, parts)))))
            parts.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if open_.linked():
                linked += len(text)

    def leave_head() -> None:
        nonlocal in_head
        in_head = False
        if open_.places.get("head"):
            flush()
            open_.cut(open_.places["head"][0])

    at, page = 0, page or ""
    while m := TOKEN.search(page, at):
        text = page[at : m.start()]
        if in_head and (text.strip() or not m[4] and (m[1] or m[2] or m[3] or m[5] or "head").lower() not in IN_HEAD):
            leave_head()
        add(text)
        at = m.end()
        tag = m[5]
        if tag is None:
            if m[1] or m[2] or m[3]:
                flush()
            if m[3]:
                closed = closed_parts(page) if closed is None else closed
                at = closed.get(m.start(), at)
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        if m[4]:
            place = open_.last(tag)
            if place >= 0:
                # An inline end tag does not close blocks.
                if tag in BLOCK or not open_.blocks or open_.blocks[-1] < place:
                    open_.cut(place)
                else:
                    open_.mask(tag)
            continue
        if tag in VOID or m[6].endswith("/") and tag not in BLOCK:
            continue
        if tag in CLOSES:
            ends, fences = CLOSES[tag]
            place = max(map(open_.last, ends))
            if place >= 0 and place > max(map(open_.last, fences)):
                open_.cut(place)
        open_.push(tag, m[6])
        in_head = in_head or tag == "head"
    if in_head and page[at:].strip():
        leave_head()
    add(page[at:])
    flush()
    return out


def blocks(page: str | None) -> list[tuple[tuple[str, ...], str, float]]:
    """leaves() with the paths written out."""
    return [(path.elements(), text, links) for path, text, links in leaves(page, Path())]


def path_features(path: tuple[str, ...]) -> list[str]:
    out = {"own=" + path[-1].split(":")[0] if path else "own="}
    nearest: list[str] = []
    for e in path:
        tag, *names = e.split(":")
        if tag not in ("html", "body"):
            out.add("in=" + tag)
        out.update("name=" + n for n in names)
        if names or tag in SECTIONS:
            nearest = ["nearest=" + tag, *("nearest name=" + n for n in names)]
    return sorted(out.union(nearest))


def text_features(text: str, links: float) -> list[str]:
    n = text.count(" ") + 1
    out = ["words=" + str(sum(n > k for k in (1, 3, 8, 16, 32))), "links=" + str((links > 0.15) + (links > 0.6))]
    if text[-1] in ".!?…\"”»":
        out.append("ends")
    if "," in text:
        out.append("comma")
    if FURNITURE.search(text):
        out.append("furniture" if n > 12 else "furniture short")
    if 3 * sum(map(str.isdigit, text)) > len(text):
        out.append("digits")
    return out


class Field:
    """Weights of the features (for label 1 against 0) and of label pairs, with Viterbi decoding."""

    def __init__(self, weights: dict[str, float], pairs: list[list[float]], start: list[float]) -> None:
        self.weights, self.pairs, self.start = weights, pairs, start
        self.root = Path()

    def of_path(self, path: Path) -> float:
        """The weight of path_features() of the path, from that of the path above: weights of all ancestors, of the nearest
        one that has a name or is a section, the features that count already, and the element's own."""
        todo = [path]
        while todo[-1].weighed is None and todo[-1].up is not None:
            todo.append(todo[-1].up)
        for node in reversed(todo):
            if node.weighed is not None:
                continue
            if node.up is None:
                node.weighed = (0.0, 0.0, frozenset(), self.weights.get("own=", 0.0))
                continue
            total, near, seen, _ = node.up.weighed
            tag, *names = node.element.split(":")
            fresh = {f for f in (*(["in=" + tag] if tag not in ("html", "body") else []), *("name=" + n for n in names)) if f in self.weights} - seen
            if names or tag in SECTIONS:
                near = sum(self.weights.get(f, 0.0) for f in dict.fromkeys(["nearest=" + tag, *("nearest name=" + n for n in names)]))
            total += sum(self.weights[f] for f in sorted(fresh))
            node.weighed = (total, near, seen | fresh if fresh else seen, self.weights.get("own=" + tag, 0.0))
        total, near, _, own = path.weighed
        return total + near + own

    def emission(self, path: Path | tuple[str, ...], text: str, links: float) -> float:
        if isinstance(path, tuple):
            node = self.root
            for e in path:
                node = node.child(e)
            path = node
        return self.of_path(path) + sum(self.weights.get(f, 0.0) for f in text_features(text, links))

    def labels(self, page: list[tuple[Path | tuple[str, ...], str, float]]) -> list[int]:
        if not page:
            return []
        (p00, p01), (p10, p11) = self.pairs
        back: list[tuple[int, int]] = []
        a, b = self.start[0], self.start[1] + self.emission(*page[0])
        for block in page[1:]:
            from0, from1 = int(b + p10 > a + p00), int(b + p11 > a + p01)
            a, b = max(a + p00, b + p10), max(a + p01, b + p11) + self.emission(*block)
            back.append((from0, from1))
        out = [int(b > a)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def train(pages: list[tuple[list[tuple[tuple[str, ...], str, float]], list[int]]], steps: int = 300, rate: float = 0.3, ridge: float = 3e-4) -> Field:
    """Maximum likelihood by AdaGrad over all pages at once; shorter pages are padded. Features of one page alone are left out."""
    pages = [p for p in pages if p[0]]
    features = [[[*path_features(path), *text_features(text, links)] for path, text, links in found] for found, _ in pages]
    seen: dict[str, int] = {}
    for page in features:
        for f in {f for block in page for f in block}:
            seen[f] = seen.get(f, 0) + 1
    index = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n > 1))}
    n, longest = len(pages), max(map(len, features))
    places = [(t * n + k, index[f]) for k, page in enumerate(features) for t, block in enumerate(page) for f in block if f in index]
    rows, cols = (np.array(x) for x in zip(*places))
    length = np.array(list(map(len, features)))
    mask = np.arange(longest)[:, None] < length
    label = np.zeros((longest, n), int)
    for k, (_, y) in enumerate(pages):
        label[: len(y), k] = y
    both = mask[1:]
    seen_pairs = np.array([[((label[:-1] == i) & (label[1:] == j) & both).sum() for j in (0, 1)] for i in (0, 1)], float)
    seen_start = np.array([(label[0] == i).sum() for i in (0, 1)], float)
    w, pairs, start = np.zeros(len(index)), np.zeros((2, 2)), np.zeros(2)
    squares = [np.full_like(x, 1e-6) for x in (w, pairs, start)]
    for _ in range(steps):
        score = np.bincount(rows, weights=w[cols], minlength=n * longest).reshape(longest, n)  # of label 1; label 0 has 0
        f, b = np.zeros((2, longest, n)), np.zeros((2, longest, n))
        f[0, 0], f[1, 0] = start[0], start[1] + score[0]
        for t in range(1, longest):
            x, y = f[:, t - 1]
            f[0, t] = np.where(mask[t], np.logaddexp(x + pairs[0, 0], y + pairs[1, 0]), x)
            f[1, t] = np.where(mask[t], np.logaddexp(x + pairs[0, 1], y + pairs[1, 1]) + score[t], y)
        for t in range(longest - 2, -1, -1):
            x, y = b[0, t + 1], b[1, t + 1] + score[t + 1]
            for i in (0, 1):
                b[i, t] = np.where(mask[t + 1], np.logaddexp(pairs[i, 0] + x, pairs[i, 1] + y), 0.0)
        total = np.logaddexp(f[0, -1], f[1, -1])
        one = np.exp(f[1] + b[1] - total)
        after = np.stack([b[0, 1:], b[1, 1:] + score[1:]])
        two = np.exp(f[:, None, :-1] + pairs[:, :, None, None] + after[None] - total)
        slack = np.where(mask, label - one, 0.0).ravel()
        first = one[0].sum()
        gradient = (
            np.bincount(cols, weights=slack[rows], minlength=len(index)) / n - ridge * w,
            (seen_pairs - (two * both).sum(axis=(2, 3))) / n - ridge * pairs,
            (seen_start - np.array([n - first, first])) / n - ridge * start,
        )
        for x, g, q in zip((w, pairs, start), gradient, squares):
            q += g * g
            x += rate * g / np.sqrt(q)
    return Field({f: float(w[k]) for f, k in index.items()}, pairs.tolist(), start.tolist())


#: What a labelled page's main text begins with in each block; taken out before training.
MAIN = ""


def labelled_page(rng: random.Random) -> str:
    """A page by rule; every block of main text begins with MAIN."""
    sound = ("ba", "re", "ti", "on", "el", "ma", "qu", "sto", "in", "ver", "lo", "é", "ch", "un", "da")
    word = lambda: "".join(rng.choice(sound) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda a=3, b=18: words(a, b).capitalize() + rng.choice([", " + words(2, 6), ""]) + rng.choice(".....!?")
    prose = lambda a=1, b=5: " ".join(sentence() for _ in range(rng.randint(a, b)))
    pick = rng.choice
    link = lambda text: f'<a href="/{word()}">{text}</a>'
    named = lambda tag, names: f'<{tag}{pick([" class=", " id="])}"{pick(names)}{pick(["", "", "-" + word(), " " + word()])}">'

    def menu() -> str:
        items = "".join(f"<li>{link(pick([words(1, 2), word(), 'Home', 'Log in', 'About us']))}</li>" for _ in range(rng.randint(3, 9)))
        names = ["menu", "nav", "navigation", "navbar", "breadcrumb", "breadcrumbs", "topnav", "main-menu", "links", "pagination", "tags"]
        return pick(["<nav><ul>%s</ul></nav>", named("div", names) + "<ul>%s</ul></div>", named("ul", names) + "%s</ul>", "<nav" + pick(["", ' class="main"', ' role="navigation"']) + "><ul>%s</ul></nav>"]) % items

    def header() -> str:
        inner = pick([f"<h1>{words(1, 3)}</h1><p>{words(2, 6)}</p>", link(words(1, 3)), f"<p>{sentence(3, 8)}</p>", f'<div class="logo">{words(1, 3)}</div>'])
        return pick(["<header>%s</header>", named("div", ["header", "site-header", "masthead", "topbar", "banner", "logo", "page-header", "branding"]) + "%s</div>", '<div role="banner">%s</div>']) % (inner + pick(["", menu()]))

    def footer() -> str:
        inner = pick([f"&copy; {word()}.example.com &middot; {prose(1, 2)}", f"<p>&copy; 20{rng.randint(10, 30)} {words(1, 3)}. All rights reserved.</p>", f"<p>{prose(1, 2)}</p>", "".join(f"<li>{link(words(1, 2))}</li>" for _ in range(4)), f"{link('Privacy')} | {link('Terms')} {sentence()}"])
        return pick(["<footer>%s</footer>", "<footer>%s</footer>", named("div", ["footer", "site-footer", "bottom", "copyright", "legal", "colophon"]) + "%s</div>", '<div role="contentinfo">%s</div>']) % inner

    def advert() -> str:
        tag = pick(["div", "div", "div", "aside", "section", "p"])
        inner = pick([prose(1, 2), prose(1, 1), link(sentence())] + [f"<p>{prose(1, 2)}</p>", f"<p>{pick(['Advertisement', 'Sponsored'])}</p><p>{sentence()}</p>"] * (tag != "p"))
        return named(tag, ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner-ad", "ad-slot", "adbox", "dfp", "commercial"]) + inner + f"</{tag}>"

    def sidebar() -> str:
        inner = f"<h3>{words(1, 3)}</h3>" + pick([f"<p>{prose(1, 3)}</p>", "<ul>" + "".join(f"<li>{link(words(2, 6))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>", f"<p>{sentence()}</p><p>{link('Read more')}</p>"])
        return pick(["<aside>%s</aside>", "<aside>%s</aside>", named("div", ["sidebar", "side", "widget", "related", "recommended", "rail", "right-column", "popular", "trending", "toc", "author-box", "bio", "teaser"]) + "%s</div>", '<div role="complementary">%s</div>']) % inner

    def notice() -> str:
        inner = f"<p>{pick([sentence(), prose(1, 2), 'We use cookies. ' + sentence(), 'Please accept our terms. ' + sentence()])}</p>" + pick(["", f"<button>{word()}</button>"])
        return pick([named("div", ["cookie", "cookies", "notice", "consent", "gdpr", "alert", "warning", "popup", "modal", "overlay", "paywall", "announcement", "toast", "message", "disclaimer", "notification", "info-bar"]) + "%s</div>", '<div role="alert">%s</div>', "<dialog>%s</dialog>"]) % inner

    def form() -> str:
        inner = pick([f"<label>{words(1, 3)}</label><input><button>{word()}</button>", f"<p>{sentence()}</p><input type=text><button>Subscribe</button>", f"<fieldset><legend>{words(1, 3)}</legend><label>{word()} <input></label></fieldset><p>{prose(1, 2)}</p>"])
        return pick(["<form>%s</form>", '<form action="/x" method="post">%s</form>', named("div", ["newsletter", "subscribe", "signup", "search", "login", "contact-form"]) + "<form>%s</form></div>"]) % inner

    def share() -> str:
        return named("div", ["share", "social", "sharing", "buttons", "follow", "meta", "byline"]) + " ".join(link(word()) for _ in range(rng.randint(2, 4))) + "</div>"

    def comments() -> str:
        one = lambda: pick([
            f'<div class="comment"><b>{word()}</b><p>{prose(1, 4)}</p></div>',
            f'<li class="comment-item"><span>{word()}</span> <p>{prose(1, 3)}</p>{link("Reply")}</li>',
            f'<article class="comment"><h4>{word()}</h4><p>{prose(1, 3)}</p></article>',
            f'<div class="reply"><p>{prose(1, 2)}</p><p>{prose(1, 2)}</p></div>',
        ])
        many = "".join(one() for _ in range(rng.randint(1, 5)))
        tag = pick(["div", "section", "ul", "ol"])
        return named(tag, ["comments", "comment-list", "commentlist", "discussion", "responses", "disqus-thread", "replies", "reader-comments", "user-comments", "reviews"]) + pick(["", "<h3>Comments</h3>", f"<h2>{words(1, 2)}</h2>"]) + many + f"</{tag}>"

    def block() -> str:
        main = lambda a=1, b=5: MAIN + prose(a, b)
        return pick([
            *[f"<p>{main()}</p>"] * 7,
            f"<p><b>{main(1, 1)}<br><p>{main()}</p>",
            f"<p>{MAIN}{words(1, 8)} {link(words(1, 4))} {prose(1, 3)}",
            f"<p>{MAIN}{word().capitalize()}.</p>",
            f"<h{rng.randint(2, 4)}>{MAIN}{words(1, 6).capitalize()}</h2>",
            "<ul>" + "".join(f"<li>{MAIN}{pick([words(1, 5), sentence()])}</li>" for _ in range(rng.randint(2, 5))) + "</ul>",
            f"<blockquote><p>{main(1, 2)}</p></blockquote>",
            f"<blockquote>{main(1, 2)}</blockquote>",
            f"<pre>{MAIN}{words(3, 12)}</pre>",
            f"<figure><img><figcaption>{MAIN}{sentence()}</figcaption></figure>",
            "<table>" + "".join(f"<tr><td>{MAIN}{word()}</td><td>{MAIN}{rng.randint(1, 999)}</td></tr>" for _ in range(2)) + "</table>",
            f"<div>{main(1, 3)}</div>",
            f"<section><h2>{MAIN}{words(1, 4)}</h2><p>{main()}</p></section>",
        ])

    body = [block() for _ in range(pick([1, 2, 3, 5, 8, 12, 20]))]
    for extra in (advert, advert, share, form, notice, sidebar):
        if rng.random() < 0.25:
            body.insert(rng.randint(0, len(body)), extra())
    title = MAIN + words(2, 9).capitalize() + pick(["", ".", "?"])
    head = pick([f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", f'<h1 class="title">{title}</h1>', f"<h2>{title}</h2>"])
    names = ["content", "main", "post", "entry", "article", "article-body", "story", "post-content", "entry-content", "main-content", "text", "body", "page-content"]
    opening = pick(["<article>"] * 6 + ["<main>", "<main><article>", "<div>", named("div", names), named("div", names), named("section", names), "<article " + f'class="{pick(names)}">', '<div role="main">'])
    tag = opening.split("<")[-1].split(" ")[0].rstrip(">")
    plain = rng.random() < 0.1
    article = (head * rng.randint(0, 1) + "".join(body)) if plain else opening + head + "".join(body) + (comments() if rng.random() < 0.1 else "") + f"</{tag}>" + ("</main>" if opening.startswith("<main><") else "")
    before = [f() for f in rng.sample([menu, header, advert, notice, sidebar, form], rng.randint(0, 4))]
    after = [f() for f in rng.sample([comments, sidebar, advert, form, menu, share, notice], rng.randint(0, 4))] + [footer()] * (rng.random() < 0.9)
    wrap = pick(["%s", "%s", "<div>%s</div>", '<div id="wrapper">%s</div>', '<div class="container"><div class="row">%s</div></div>'])
    end = pick(["</body></html>", "</body></html>", "", "</body>"])
    return f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title><style>p{{}}</style></head><body>" + wrap % ("".join(before) + article + "".join(after)) + end


def labelled_pages(count: int, seed: int = 1) -> list[tuple[list[tuple[tuple[str, ...], str, float]], list[int]]]:
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        found = blocks(labelled_page(rng))
        out.append(([(p, t.replace(MAIN, "") or "-", s) for p, t, s in found], [int(MAIN in t) for _, t, _ in found]))
    return out


#: Labelled pages made for training.
PAGES = 700


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_pages(PAGES))


#: Characters of pages whose paths are shared before the tree begins anew.
SHARED_CHARS = 4_000_000


def main_text(page: str | None, field: Field, root: Path | None = None) -> str:
    found = leaves(page, Path() if root is None else root)
    return " ".join(text for (_, text, _), y in zip(found, field.labels(found)) if y)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of pages (page_id, url, html)."""
    field = field or default_field()
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast((field.weights, field.pairs, field.start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, root, read = Field(*shared.value), Path(), 0
        for batch in batches:
            texts = []
            for page in batch.column(2).to_pylist():
                read += len(page or "")
                if read > SHARED_CHARS:
                    root, read = Path(), 0
                texts.append(main_text(page, own, root))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
