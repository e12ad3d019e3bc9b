"""Main text of web pages: a recurrent network labels every block of a page.

A page is cut into leaf blocks at block-level tags. Each block has a vector of its tag path (tags and the words of their
classes, ids and roles, hashed, nearer ones stronger), a vector of its hashed words, and a few numbers such as the share of
linked characters. A bidirectional LSTM in numpy reads a page's blocks in order, so each block is classified with the whole
page before and behind it in view. Blocks labelled as main text are joined in page order.

The network is fitted in one task on at most ``SAMPLE`` pages of at most ``SAMPLE_CHARS`` characters, chosen by hash, the
same ones in each run. Their own semantic tags label their blocks. So that pages without such tags are read as well, the
blocks' texts are laid out again with other containers and names (``layout``), some of which say nothing. Where no page is
short enough, made-up sentences are laid out.

Rules that no learning decides: scripts, styles, templates, comments, form controls and titles are no text; character
references are decoded; white space inside a block, line breaks included, becomes one blank; an unclosed paragraph or list
item ends where the next one starts. Time is linear in the page, whatever it repeats.

Defined results: null and empty pages and pages without main text give empty text; pages may be of any length; repeated
rows give repeated rows; an empty table gives an empty result; other columns are ignored, so names can't clash.
"""

from __future__ import annotations

import html
import pickle
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import arrow_pieces

SAMPLE, SAMPLE_CHARS = 240, 100_000
PATH, WORDS, NUMBERS, HIDDEN = 256, 64, 8, 24
INPUTS = PATH + WORDS + NUMBERS
#: What an ancestor keeps of its strength a level further up.
FADE = 0.9
PIECE_BYTES = 4_000_000
#: Blocks, padding included, that the network reads at a time.
TOGETHER = 40_000

#: Elements of HTML by what they do to text.
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html ins legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_RAW = "script|style|template|noscript|iframe|title|textarea|select|button|svg|math|object|audio|video|canvas"
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>])[^>]*+>|<[!?][^>]*+>|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attributes>(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)>""", re.S | re.I
)
_CLOSING = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in _RAW.split("|")}
_OPENING = re.compile("<[a-z/!?]", re.I)
_NAMES = re.compile(r"""(?<![^\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+", re.I)


class Node:
    """An open element: its tag path as a vector."""

    __slots__ = ("tag", "up", "vector", "below")

    def __init__(self, tag: str, names: tuple[str, ...], up: Node | None):
        self.tag, self.up, self.below = tag, up, {}
        self.vector = np.zeros(PATH, np.float32) if up is None else up.vector * np.float32(FADE)
        for item in (tag, *(f".{n}" for n in names)):
            self.vector[zlib.crc32(item.encode()) % PATH] = 1


#: Paths that a worker keeps; beyond this number it starts anew. Only speed depends on it.
KEPT_PATHS = 20_000


class Paths:
    """Tag paths met so far, shared by the pages that have them."""

    def __init__(self):
        self.root, self.n = Node("", (), None), 0

    def below(self, up: Node, tag: str, attributes: str) -> Node:
        found = up.below.get((tag, attributes))
        if found is None:
            named = " ".join(x for m in _NAMES.findall(attributes) for x in m) if attributes else ""
            found = Node(tag, tuple(w.lower() for w in _PARTS.findall(named)), up)
            if self.n < KEPT_PATHS:
                up.below[tag, attributes] = found
                self.n += 1
        return found


@dataclass
class Block:
    node: Node
    text: str
    linked: int


def blocks(page: str | None, paths: Paths) -> list[Block]:
    """Leaf blocks of a page in order; one without text is none."""
    if not page:
        return []
    out: list[Block] = []
    now, open_tags, parts, linked, in_link, start = paths.root, {}, [], 0, False, 0
    end = page.rfind(">") + 1  # behind it there is no whole tag; one that the page breaks off in is no text
    broken = _OPENING.search(page, end)
    page = page[: broken.start()] if broken else page

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(now, text, linked))
            parts.clear()
        linked = 0

    def close(tags: set[str]) -> None:
        nonlocal now
        while now.up is not None:
            tag, now = now.tag, now.up
            open_tags[tag] -= 1
            if tag in tags:
                break

    def add(text: str) -> None:
        nonlocal linked
        text = html.unescape(text)
        parts.append(text)
        if in_link:
            linked += len(text)

    position = 0
    while position < end:
        m = _TOKEN.search(page, position, end)
        if m is None:
            break
        if m.start() > start:
            add(page[start : m.start()])
        position = start = m.end()
        if m[0].startswith("<!--") and not m[0].endswith("-->"):  # a comment that never ends
            start = len(page)
            break
        if m["raw"]:  # what it holds is skipped
            closing = _CLOSING[m["raw"].lower()].search(page, position)
            position = start = closing.end() if closing else len(page)
        if not m["tag"]:
            continue
        tag, ends = m["tag"].lower(), m["end"]
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not ends
        elif tag in BLOCK:
            flush()
            if ends:
                if open_tags.get(tag):
                    close({tag})
            elif tag not in VOID:
                if open_tags.get("p") and now.tag == "p":
                    close({"p"})
                if now.tag in CLOSES.get(tag, ()):
                    close({now.tag} if tag != "tr" or now.tag == "tr" else {"tr"})
                now = paths.below(now, tag, m["attributes"])
                open_tags[tag] = open_tags.get(tag, 0) + 1
    if start < len(page):
        add(page[start:])
    flush()
    return out


def numbers(found: list[Block]) -> np.ndarray:
    out = np.zeros((len(found), NUMBERS), np.float32)
    for k, b in enumerate(found):
        t = b.text
        n, words = len(t), t.count(" ") + 1
        out[k] = (np.log1p(n) / 5, np.log1p(words) / 4, b.linked / n, (t.count(".") + t.count(",")) / words, t[-1] in ".!?\"'”", t[0].isupper(), k == 0, k == len(found) - 1)
    return out


def word_vectors(texts: list[str]) -> np.ndarray:
    """Signed sums of the hashed words of each text, at unit length."""
    hashes, row, crc = [], [], zlib.crc32
    for text in texts:
        own = [crc(w) for w in text.lower().encode().split()]
        hashes += own
        row.append(len(own))
    h = np.array(hashes, np.int64)
    at = np.repeat(np.arange(len(texts)), row) * WORDS + h % WORDS
    out = np.bincount(at, weights=1.0 - 2 * ((h >> 20) & 1), minlength=len(texts) * WORDS).reshape(len(texts), WORDS)
    return (out / np.maximum(np.sqrt((out**2).sum(axis=1, keepdims=True)), 1)).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM over the blocks of a page, and one output for each block."""

    def __init__(self, seed: int = 5):
        r, h = np.random.default_rng(seed), HIDDEN
        draw = lambda *shape, by: (r.standard_normal(shape) / np.sqrt(by)).astype(np.float32)
        self.p = {"x": draw(INPUTS, 8 * h, by=12), "forth": draw(h, 4 * h, by=h), "back": draw(h, 4 * h, by=h), "b": np.zeros(8 * h, np.float32), "out": draw(2 * h, by=2 * h), "c": np.zeros(1, np.float32)}
        for d in (0, 4 * h):
            self.p["b"][d + h : d + 2 * h] = 1  # it starts by remembering

    def _pass(self, z: np.ndarray, w: np.ndarray, mask: np.ndarray, order: range) -> tuple[np.ndarray, list]:
        """One direction over z (steps, pages, gates); states of each step, and what its gradient needs."""
        h, out, kept = HIDDEN, np.zeros((*z.shape[:2], HIDDEN), np.float32), []
        state = cell = np.zeros((z.shape[1], h), np.float32)
        for t in order:
            a = z[t] + state @ w
            gate, new = _sigmoid(a[:, : 3 * h]), np.tanh(a[:, 3 * h :])
            i, f, o = gate[:, :h], gate[:, h : 2 * h], gate[:, 2 * h :]
            m = mask[t][:, None]
            before, cell = (state, cell), m * (f * cell + i * new)
            squashed = np.tanh(cell)
            state = out[t] = m * (o * squashed)
            kept.append((t, before, i, f, o, new, squashed, m))
        return out, kept

    def _states(self, z: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list, list]:
        steps, h = len(z), HIDDEN
        forth, kept = self._pass(z[:, :, : 4 * h], self.p["forth"], mask, range(steps))
        back, kept_back = self._pass(z[:, :, 4 * h :], self.p["back"], mask, range(steps - 1, -1, -1))
        return np.concatenate([forth, back], axis=2), kept, kept_back

    def chances(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Chance of being main text for each block of each page; pages of like length are read together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
        while order:
            n = 1
            while n < len(order) and (n + 1) * len(pages[order[n]]) <= TOGETHER:
                n += 1
            group, order = order[:n], order[n:]
            z, mask = self._inputs([pages[k] for k in group])
            states, _, _ = self._states(z, mask)
            chance = _sigmoid(states @ self.p["out"] + self.p["c"])
            for column, k in enumerate(group):
                out[k] = chance[: len(pages[k]), column]
        return out

    def _inputs(self, pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray]:
        """Gates' inputs (steps, pages, gates) and which steps a page has; each tag path goes through the weights once."""
        flat = [b for p in pages for b in p]
        nodes = {id(b.node): b.node for b in flat}
        place = {k: n for n, k in enumerate(nodes)}
        paths = np.stack([n.vector for n in nodes.values()]) @ self.p["x"][:PATH]
        own = np.concatenate([word_vectors([b.text for b in flat]), np.concatenate([numbers(p) for p in pages])], axis=1) @ self.p["x"][PATH:]
        own += paths[[place[id(b.node)] for b in flat]] + self.p["b"]
        lengths = np.array([len(p) for p in pages])
        z, mask = np.zeros((lengths.max(), len(pages), own.shape[1]), np.float32), np.zeros((lengths.max(), len(pages)), np.float32)
        column = np.repeat(np.arange(len(pages)), lengths)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        z[step, column], mask[step, column] = own, 1
        return z, mask

    def gradient(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict]:
        """Mean loss over blocks and its gradient; x (steps, pages, inputs), y and mask (steps, pages)."""
        h, z = HIDDEN, x @ self.p["x"] + self.p["b"]
        states, kept, kept_back = self._states(z, mask)
        chance = _sigmoid(states @ self.p["out"] + self.p["c"])
        n = mask.sum()
        loss = -(mask * np.log(np.where(y > 0.5, chance, 1 - chance) + 1e-7)).sum() / n
        d = mask * (chance - y) / n
        g = {"out": np.einsum("tb,tbh->h", d, states), "c": np.array([d.sum()], np.float32)}
        d_states, d_z = d[:, :, None] * self.p["out"], np.zeros_like(z)
        for name, from_, trace in (("forth", 0, kept), ("back", 4 * h, kept_back)):
            w, g[name] = self.p[name], np.zeros_like(self.p[name])
            d_state = d_cell = np.zeros((x.shape[1], h), np.float32)
            for t, (state, cell), i, f, o, new, squashed, m in reversed(trace):
                down = m * (d_states[t, :, from_ // 4 : from_ // 4 + h] + d_state)
                into = m * d_cell + down * o * (1 - squashed**2)
                a = np.concatenate([into * new * i * (1 - i), into * cell * f * (1 - f), down * squashed * o * (1 - o), into * i * (1 - new**2)], axis=1)
                d_z[t, :, from_ : from_ + 4 * h] = a
                g[name] += state.T @ a
                d_state, d_cell = a @ w.T, into * f
        g["b"], g["x"] = d_z.sum(axis=(0, 1)), x.reshape(-1, x.shape[2]).T @ d_z.reshape(-1, d_z.shape[2])
        return float(loss), g


def train(labelled: list[tuple[list[Block], list[bool]]], epochs: int = 10, rate: float = 0.01, pages: int = 32, longest: int = 100, seed: int = 5) -> Labeller:
    """Adam steps over batches of pages; a long page is cut into windows of ``longest`` blocks for fitting alone."""
    model, r = Labeller(seed), np.random.default_rng(seed)
    windows = []
    for found, main in labelled:
        if found:
            x = np.concatenate([np.stack([b.node.vector for b in found]), word_vectors([b.text for b in found]), numbers(found)], axis=1)
            windows += [(x[k : k + longest], np.array(main[k : k + longest], np.float32)) for k in range(0, len(found), longest)]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    step, steps = 0, epochs * -(-len(windows) // pages)
    for _ in range(epochs):
        order = sorted(r.permutation(len(windows)), key=lambda k: len(windows[k][0]))  # like lengths together, in another order each time
        batches = [order[k : k + pages] for k in range(0, len(order), pages)]
        for b in r.permutation(len(batches)):
            chosen = [windows[k] for k in batches[b]]
            shape = max(len(y) for _, y in chosen), len(chosen)
            x, y, mask = np.zeros((*shape, INPUTS), np.float32), np.zeros(shape, np.float32), np.zeros(shape, np.float32)
            for c, (own, main) in enumerate(chosen):
                x[: len(main), c], y[: len(main), c], mask[: len(main), c] = own, main, 1
            _, g = model.gradient(x, y, mask)
            step += 1
            norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
            for k, v in g.items():
                m1, m2 = moments[k]
                v = v * min(1, 1 / max(norm, 1e-9))
                m1 += 0.1 * (v - m1)
                m2 += 0.01 * (v**2 - m2)
                model.p[k] -= rate * (1 - step / (steps + 1)) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-6)
    return model


#: Containers of pages as their authors name them, tag and class, by what they hold.
MAIN = ["article", "main", "main/article", "div.content/div.post", "div.entry-content", "section.article-body", "div.main/div.text", "div.story", "td.content", "div.post-body", "div.page-content", "article.post/div.body", "main/section.content", "div.article/div.article-text"]
OTHER = {
    "menu": ["nav", "nav/ul", "div.menu", "div.navbar", "ul.navigation", "header/nav", "div.breadcrumbs", "div.top-bar", "menu", "div.nav-links"],
    "header": ["header", "div.header", "div.site-header", "div.masthead", "div.logo", "div.banner"],
    "side": ["aside", "div.sidebar", "div.widget", "div.related", "div.recommended", "section.more-stories", "aside.sidebar", "div.tags"],
    "notice": ["div.cookie-notice", "div.consent", "div.gdpr", "div.alert", "div.notice", "section.privacy", "div.paywall", "div.popup"],
    "advert": ["div.ad", "div.ads", "div.advert", "div.advertisement", "aside.ad", "div.sponsored", "div.promo", "section.ad-container"],
    "form": ["form", "form.newsletter", "form.search", "div.subscribe/form", "form.login", "div.signup"],
    "comments": ["section.comments", "div.comments/div.comment", "ol.commentlist/li", "div.comment-list", "section.comments/article.comment", "div.replies", "div.disqus", "div.reader-comments"],
    "share": ["div.share", "ul.social", "div.share-buttons"],
    "footer": ["footer", "div.footer", "div.copyright", "footer/div.legal", "div.site-footer", "div.bottom"],
}
#: Short texts that stand around articles.
PHRASES = {
    "menu": "Home|About|Contact|News|Sports|Sign in|Search|Menu|All topics|Archive|Next|Previous".split("|"),
    "header": "The daily page|Welcome|Latest news|Our site".split("|"),
    "side": "Related articles|Read more|Most read|Popular|Recommended for you|Tags|Recent posts".split("|"),
    "notice": "We use cookies to improve your experience.|Accept all|This site uses cookies. By going on you agree.|Please switch off your ad blocker.|Privacy settings|Your trial ends soon.".split("|"),
    "advert": "Advertisement|Buy now and save.|Sponsored|Order today, free delivery.|Limited offer".split("|"),
    "form": "Subscribe to our newsletter|Your email|Your name|Send|Password|Search this site|Sign up".split("|"),
    "comments": "Comments|Leave a reply|Reply|3 comments|Great article!|I don't agree with this.|Log in to comment|Posted by guest".split("|"),
    "share": "Share|Tweet|Share on social media|Print|Email".split("|"),
    "footer": "All rights reserved.|Imprint|Privacy policy|Terms of use|Contact us|Copyright 2020".split("|"),
}
WRAPPERS = ["", "", "div", "div.wrapper", "div.container", "div.page", "div/div", "table/tr"]


def layout(main: list[str], spare: list[str], paths: Paths, r: random.Random) -> tuple[list[Block], list[bool]]:
    """The texts of an article in a page of another make, with menus, adverts, comments and the like around and inside it."""
    dull = r.random() < 0.15  # names that say nothing
    out: list[Block] = []
    labels: list[bool] = []

    def down(node: Node, spec: str) -> Node:
        for part in filter(None, spec.split("/")):
            tag, _, name = part.partition(".")
            if dull and name:
                tag, name = "div", f"x{r.choice('abcdefgh')}{r.choice('klmnopq')}"
            extra = r.choice(["", "", "", "clearfix", "row", "inner", "block"]) if name else ""
            node = paths.below(node, tag, f' class="{name} {extra}"' if name else "")
        return node

    def put(node: Node, text: str, linked: float, label: bool) -> None:
        text = " ".join(text.split())
        if text:
            out.append(Block(node, text, int(linked * len(text))))
            labels.append(label)

    def other(node: Node, kind: str) -> None:
        box, links = down(node, r.choice(OTHER[kind])), kind in ("menu", "share") or (kind in ("side", "footer") and r.random() < 0.6)
        leaf = r.choice(["ul/li", "li", "", "div"]) if links else r.choice(["p", "", "div", "p"])
        for _ in range(r.randint(1, 8 if links else 3)):
            if kind in ("comments", "advert", "side", "footer", "notice") and spare and r.random() < 0.5:
                put(down(box, leaf), r.choice(spare), links, False)
            else:
                put(down(box, leaf), r.choice(PHRASES[kind]), links, False)

    body = down(paths.root, "html/body")
    page = down(body, r.choice(WRAPPERS))
    for kind in ("notice", "header", "menu", "advert"):
        if r.random() < 0.5:
            other(r.choice([body, page]), kind)
    if r.random() < 0.2:
        other(page, "side")
    box = down(page, r.choice(MAIN))
    inside = [k for k in ("advert", "share", "form", "side", "notice") if r.random() < 0.12]
    put(down(box, r.choice(["h1", "h1", "h2", "p"])), main[0], 0, True)
    for k, text in enumerate(main[1:]):
        put(down(box, r.choices(["p", "", "h2", "ul/li", "blockquote", "div", "pre", "table/tr/td"], [30, 1, 2, 2, 1, 2, 1, 1])[0]), text, 0, True)
        if inside and r.random() < 0.2:
            other(box, inside.pop())
    if r.random() < 0.15:
        other(box, "comments")
    for kind in ("share", "comments", "side", "form", "advert", "footer"):
        if r.random() < 0.45:
            other(r.choice([page, body]) if kind != "comments" else page, kind)
    return out, labels


#: Tags that mark an article, and those that mark what is none, by the standard.
SEMANTIC_MAIN, SEMANTIC_OTHER = {"article", "main"}, {"nav", "aside", "footer", "form", "menu", "dialog"}


def by_tags(found: list[Block]) -> list[bool] | None:
    """Which blocks a page's own semantic tags call main text; None for a page without such tags."""

    def tags(node: Node) -> Iterator[str]:
        while node is not None:
            yield node.tag
            node = node.up

    labels = [next((t in SEMANTIC_MAIN for t in tags(b.node) if t in SEMANTIC_MAIN | SEMANTIC_OTHER), False) for b in found]
    return labels if any(labels) else None


def fit_pages(htmls: list[str | None], layouts: int = 5, seed: int = 5) -> Labeller:
    """Pages as they are and in other layouts; without semantic tags, longer texts without links stand in for articles."""
    paths, r = Paths(), random.Random(seed)
    parsed = [blocks(h, paths) for h in htmls]
    labels = [by_tags(p) for p in parsed]
    texts = [[b.text for b, m in zip(p, own or [len(b.text) > 80 and not b.linked for b in p], strict=True) if m] for p, own in zip(parsed, labels, strict=True)]
    if not any(texts):  # no page to learn from: made-up sentences take the articles' place
        word = lambda: "".join(r.choice("aeiourstlnmdk") for _ in range(r.randint(2, 9)))
        texts = [[" ".join(word() for _ in range(r.randint(4, 60))).capitalize() + "." for _ in range(r.randint(2, 12))] for _ in range(40)]
    spare = [t for x in texts for t in x if len(t) < 300][:2000]
    labelled = [(p, own) for p, own in zip(parsed, labels, strict=True) if own]
    again = [layout(t, spare, paths, r) for t in texts for _ in range(layouts) if t]
    return train(4 * labelled + again, seed=seed)  # pages as they are weigh most


def fit(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    """The network, fitted on a bounded sample of pages; rows that repeat a page's text count once.

    The sample meets in one task, where Spark gives numpy one thread; its weights alone come back.
    """
    short, place = pages.filter(F.char_length("html") <= SAMPLE_CHARS), F.xxhash64("html")
    least = [r["place"] for r in short.select(place.alias("place")).distinct().orderBy("place").limit(sample).collect()]  # hashes alone are compared
    chosen = short.filter(place <= max(least)).select("html", place.alias("place")).distinct().repartition(1) if least else None

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["place"], r["html"]) for b in batches for r in b.to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_pages([h for _, h in rows]).p)], pa.binary())], ["weights"])

    told = chosen.mapInArrow(learn, "weights binary").collect() if chosen is not None else []
    if not told:
        return fit_pages([])
    model = Labeller()
    model.p = pickle.loads(told[0]["weights"])
    return model


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """page_id, url, text, n_chars per row of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = Paths()
        for batch in arrow_pieces(batches, PIECE_BYTES, "html"):
            if paths.n >= KEPT_PATHS:
                paths = Paths()
            found = [blocks(h, paths) for h in batch.column("html").to_pylist()]
            texts = ["\n".join(b.text for b, c in zip(p, chance.tolist(), strict=True) if c >= 0.5) for p, chance in zip(found, model.chances(found), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
