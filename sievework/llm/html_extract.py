"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read into leaf blocks: runs of text between the tags that break lines. Each block has features
from its ancestors (tag names, words of their class, id and role) and from its text (length, share of links,
marks, capitals, digits). Two states, main text and the rest, are scored by a linear-chain CRF that
was trained on labelled pages and is decoded with Viterbi. The labelled pages come from ``labelled_pages``,
a seeded grammar of page layouts in which every block is marked; the weights depend on nothing else.

A NULL or empty page has an empty text, as has a page without main text; an empty table gives none. Repeated rows
are read each for itself, long and deep pages whole, and further columns are left out. A quoted value that never
closes ends with its tag; of the elements whose content is no text only ``svg`` and ``math`` may close themselves.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_slices

# What HTML says about elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = frozenset(("svg", "math"))
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul button label".split()
)
CLOSES_P = BLOCKS - {"body", "head", "html", "option", "button", "label", "legend", "caption", "td", "th", "tr", "tbody"}
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "p": ("p",),
}
SCOPES = frozenset("ul ol dl table select article section div body aside nav main header footer form blockquote".split())

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|(?![\"'])))*+)(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",  # a value whose quote never closes
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: elements that hold blocks of one kind
HOLDERS = frozenset("article main section div body aside nav header footer form menu dialog".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


def blocks_of(page: str) -> list[tuple[str, list[str], int]]:
    """(text, path, characters in links) of each leaf block; path: features of the ancestors."""
    out: list[tuple[str, list[str], int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    texts: list[str] = []
    links, in_link, at = 0, 0, 0
    inside: Counter[str] = Counter()  # features of all ancestors, and how many have each

    def flush():
        nonlocal links
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                path = ["at:" + next((t for t, _ in reversed(stack) if t in BLOCKS), "")]
                holder, names = next(((t, w) for t, w in reversed(stack) if t in HOLDERS), ("", ()))
                path += ["own:" + holder + w[2:] for w in names] or ["own:" + holder]
                out.append((text, [*path, *inside], links))
            texts.clear()
        links = 0

    def leave(k: int):
        while len(stack) > k:
            tag, words = stack.pop()
            for name in ("in:" + tag, *words):
                inside[name] -= 1
                if not inside[name]:
                    del inside[name]

    def pop(tags, within=SCOPES):
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                leave(k)
                return
            if stack[k][0] in within:
                return

    def add(raw: str):
        nonlocal links
        if raw:
            text = entities.unescape(raw)
            texts.append(text)
            if in_link:
                links += len(text)

    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        close, opened, attributes = m[1], m[2] or m[4], m[3] or m[5] or ""
        if close:
            tag = close.lower()
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag == "br":
                texts.append(" ")
            if tag in BLOCKS:
                flush()
            if tag in BLOCKS or tag in ("a", "b", "i", "span", "em", "strong"):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        leave(k)
                        break
                    if tag not in BLOCKS and stack[k][0] in BLOCKS:
                        break
        elif opened:
            tag = opened.lower()
            if tag in RAW:  # its content is no text of the page
                if tag not in SELF_CLOSING or not attributes.rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
                    at = end.end() if end else len(page)
                continue
            if tag == "br":
                texts.append(" ")
            if tag == "a":
                in_link = 1
            if tag in BLOCKS:
                flush()
                if tag in CLOSES_P:
                    pop(("p",))
                if tag in CLOSES and tag != "p":
                    pop(CLOSES[tag])
                if tag in HEADINGS and stack and stack[-1][0] in HEADINGS:
                    leave(len(stack) - 1)
            if tag in VOID:
                continue
            if tag in BLOCKS or tag in ("span", "a", "b", "i", "em", "strong"):
                words = []
                for a in ATTRIBUTE.finditer(attributes):
                    words += ["is:" + w.lower() for w in WORD.findall(a[2] or a[3] or a[4] or "")]
                stack.append((tag, tuple(words)))
                inside.update(("in:" + tag, *words))
    flush()
    return out


def bucket(value: float, limits: tuple[float, ...]) -> int:
    return sum(value >= x for x in limits)


def features(blocks: list[tuple[str, list[str], int]]) -> list[list[str]]:
    out = []
    for text, path, links in blocks:
        words = text.count(" ") + 1
        letters = sum(map(text.count, ".!?"))
        out.append(list(dict.fromkeys([
            *path,
            "bias",
            f"words:{bucket(words, (2, 4, 7, 12, 25, 50))}",
            f"links:{bucket(links / len(text), (0.01, 0.3, 0.7, 0.95))}",
            f"marks:{bucket(letters, (1, 2, 4))}",
            "ends" if text[-1] in ".!?:;…\"”" else "open",
            *(["sign"] if text[0] in "©|»›•" or "©" in text else []),
            f"caps:{text[:40].isupper()}",
            f"digits:{bucket(sum(map(str.isdigit, text[:80])) / min(80, len(text)), (0.01, 0.2, 0.5))}",
        ])))
    return out


class Chain:
    """Weights of a linear chain of two states, and the two things done with them."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.weight = {n: (float(weights[i, 0]), float(weights[i, 1])) for n, i in names.items()}
        self.moves = moves.tolist()

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The likeliest states, by Viterbi; features never trained on count nothing."""
        back, best = [], None
        (aa, ab), (ba, bb) = self.moves
        for row in rows:
            a = b = 0.0
            for name in row:
                w = self.weight.get(name)
                if w:
                    a += w[0]
                    b += w[1]
            if best is None:
                best = (a, b)
                continue
            to_a = (best[0] + aa, best[1] + ba)
            to_b = (best[0] + ab, best[1] + bb)
            back.append((to_a[1] > to_a[0], to_b[1] > to_b[0]))
            best = (max(to_a) + a, max(to_b) + b)
        if best is None:
            return []
        states = [int(best[1] > best[0])]
        for step in reversed(back):
            states.append(int(step[states[-1]]))
        return states[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 200, decay: float = 0.01, rate: float = 0.2) -> Chain:
    """Maximum likelihood with a quadratic penalty; the gradient comes from forward and backward sums."""
    names: dict[str, int] = {}
    for rows, _ in pages:
        for row in rows:
            for name in row:
                names.setdefault(name, len(names))
    most, n = max(len(rows) for rows, _ in pages), len(pages)
    length = np.array([len(rows) for rows, _ in pages])
    real = np.arange(most)[None] < length[:, None]
    gold = np.zeros((n, most), int)
    feature, place = [], []
    for p, (rows, states) in enumerate(pages):
        gold[p, : len(states)] = states
        for t, row in enumerate(rows):
            feature += [names[x] for x in row]
            place += [p * most + t] * len(row)
    feature, place = np.array(feature), np.array(place)
    truth = np.eye(2)[gold] * real[..., None]
    pairs = np.zeros((2, 2))
    for t in range(1, most):
        np.add.at(pairs, (gold[:, t - 1][real[:, t]], gold[:, t][real[:, t]]), 1)
    weights, moves = np.zeros((len(names), 2)), np.zeros((2, 2))
    square_w, square_m = np.zeros_like(weights), np.zeros_like(moves)
    for _ in range(rounds):
        emit = np.stack([np.bincount(place, weights[feature, s], minlength=n * most) for s in (0, 1)], 1).reshape(n, most, 2)
        ahead, behind = np.zeros((n, most, 2)), np.zeros((n, most, 2))
        ahead[:, 0] = emit[:, 0]
        for t in range(1, most):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        expected = np.zeros((2, 2))
        for t in range(most - 2, -1, -1):
            step = np.logaddexp.reduce(moves[None] + (emit[:, t + 1] + behind[:, t + 1])[:, None], axis=2)
            behind[:, t] = np.where(real[:, t + 1, None], step, 0)
            both = ahead[:, t, :, None] + moves + (emit[:, t + 1] + behind[:, t + 1])[:, None] - total[:, None, None]
            expected += np.exp(both[real[:, t + 1]]).sum(0)
        chance = np.exp(np.minimum(ahead + behind - total[:, None, None], 0)) * real[..., None]
        miss = (truth - chance).reshape(-1, 2)
        grad = np.stack([np.bincount(feature, miss[place, s], minlength=len(names)) for s in (0, 1)], 1) - decay * weights
        grad_m = pairs - expected - decay * moves
        square_w += grad**2
        square_m += grad_m**2
        weights += rate * 3 * grad / (np.sqrt(square_w) + 1e-8)
        moves += rate * grad_m / (np.sqrt(square_m) + 1e-8)
    return Chain(names, weights, moves)


# Names that page authors give to parts of a page.
MAIN_NAMES = (
    "content post entry-content article-body story post-body main-content article entry page-content post-content "
    "articleBody blog-post text body-text single-post prose"
).split()
OTHER_NAMES = {
    "menu": "menu navbar navigation topnav breadcrumb nav main-menu site-nav pagination tabs".split(),
    "head": "header masthead site-header top-bar logo branding banner-top page-header".split(),
    "foot": "footer copyright site-footer bottom colophon legal footer-links".split(),
    "side": "sidebar widget related recommended side rail popular trending secondary more-stories".split(),
    "ad": "ad ads advert advertisement banner sponsor sponsored promo promotion adsense teaser".split(),
    "note": "notice cookie cookie-banner consent alert newsletter popup modal subscribe gdpr message warning".split(),
    "talk": "comments comment comment-list reader-comments discussion responses replies disqus comment-body reply".split(),
    "form": "login search search-form signup contact-form subscribe-form form".split(),
    "share": "share social share-buttons social-links tags meta-links".split(),
}


def labelled_pages(count: int = 700, seed: int = 5) -> list[tuple[list[list[str]], list[int]]]:
    """Pages in many layouts with the state of every block; words are drawn letters and tell nothing."""
    draw = random.Random(seed)
    mark = "⁣"  # an invisible separator: stands in every block of the main text, and is taken out again

    def words(low: int, high: int) -> str:
        drawn = ["".join(draw.choices("etaoinshrdlucmfw", k=draw.randint(1, 9))) for _ in range(draw.randint(low, high))]
        return " ".join(drawn)

    def sentence(low: int = 1, high: int = 18) -> str:
        return words(low, high).capitalize() + draw.choice(["."] * 8 + ["!", "?", ""])

    def prose(least: int = 1, most: int = 5) -> str:
        text = " ".join(sentence() for _ in range(draw.randint(least, most)))
        if draw.random() < 0.15:
            text = re.sub(r" ", lambda _: draw.choice(["*** ", "### ", "!! ", " "]), text)
        return text.upper() if draw.random() < 0.05 else text

    def wrap(inner: str, kind: str, tags: str) -> str:
        name = draw.choice(OTHER_NAMES[kind])
        tag = draw.choice(tags.split())
        how = draw.choice(["class", "class", "id"])
        bare = tag not in ("div", "section", "p", "span", "ul") and draw.random() < 0.6
        return f"<{tag}>{inner}</{tag}>" if bare else f'<{tag} {how}="{name}">{inner}</{tag}>'

    def link() -> str:
        return f'<a href="/{words(1, 1)}">{words(1, 3)}</a>'

    def other(kind: str) -> str:
        if kind == "menu":
            inner = "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(draw.randint(2, 8))) + "</ul>"
            return wrap(inner if draw.random() < 0.8 else " | ".join(link() for _ in range(4)), kind, "nav nav div ul")
        if kind == "head":
            inner = draw.choice([f"<h1>{words(1, 3)}</h1>", f"<p>{words(2, 6)}</p>", link(), f"<div>{words(1, 4)}</div>"])
            return wrap(inner, kind, "header header div")
        if kind == "foot":
            inner = draw.choice(["&copy; ", "", ""]) + draw.choice([f"{words(1, 3)} &middot; {prose(1, 2)}", f"<p>{prose(1, 2)}</p>", f"<p>{words(2, 5)} {link()}</p>"])
            return wrap(inner, kind, "footer footer div")
        if kind == "side":
            inner = f"<h3>{words(1, 4)}</h3>" + draw.choice([f"<p>{prose(1, 3)}</p>", "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(3)) + "</ul>"])
            return wrap(inner, kind, "aside aside div section")
        if kind == "ad":
            return wrap(draw.choice([prose(1, 2), f"<p>{prose(1, 2)}</p>", link()]), kind, "div div aside section p")
        if kind == "note":
            inner = draw.choice([prose(1, 2), f"<p>{prose(1, 3)}</p>"]) + draw.choice(["", "<button>Ok</button>", link()])
            return wrap(inner, kind, "div div section aside p")
        if kind == "talk":
            body = "".join(
                f'<{t} class="{draw.choice(["comment", "reply", "comment-body"])}">' + draw.choice([f"<p>{prose(1, 4)}</p>", f"<b>{words(1, 2)}</b> <p>{prose(1, 3)}</p>", prose(1, 3)]) + f"</{t}>"
                for t in [draw.choice(["div", "div", "li", "li", "article"])] * draw.randint(1, 5)
            )
            return wrap(draw.choice(["", f"<h3>{words(1, 2)}</h3>", f"<h2>{words(1, 3)}</h2>"]) + body, kind, "div section div ul")
        if kind == "share":
            return wrap(" ".join(link() for _ in range(draw.randint(2, 5))), kind, "div div p ul")
        fields = f"<label>{words(1, 2)}</label><input name=q><select><option>{words(1, 2)}<option>{words(1, 2)}</select><button>{words(1, 2)}</button>"
        return f"<form>{fields}</form>" if draw.random() < 0.5 else f'<form class="{draw.choice(OTHER_NAMES["form"])}"><p>{prose(1, 1)}</p>{fields}</form>'

    def main_block() -> str:
        x = draw.random()
        text = lambda *a: mark + prose(*a)
        if x < 0.62:
            inner = text(1, 6)
            if draw.random() < 0.2:
                inner += f" {link()} " + sentence()
            return draw.choice([f"<p>{inner}</p>", f"<p>{inner}</p>", f"<p>{inner}", f"<p><b>{inner}<br>", f'<p class="{words(1, 1)}">{inner}</p>'])
        if x < 0.72:
            return f"<{(h := draw.choice(['h2', 'h3', 'h4']))}>{mark}{words(1, 8)}</{h}>"
        if x < 0.80:
            tag = draw.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{mark}{draw.choice([words(1, 8), prose(1, 2)])}</li>" for _ in range(draw.randint(2, 5))) + f"</{tag}>"
        if x < 0.86:
            return f"<blockquote>{draw.choice(['', '<p>'])}{text(1, 3)}</blockquote>"
        if x < 0.91:
            return "<table>" + "".join(f"<tr><td>{mark}{words(1, 3)}<td>{mark}{words(1, 4)}</tr>" for _ in range(draw.randint(1, 4))) + "</table>"
        if x < 0.95:
            return f"<pre>{text(1, 3)}</pre>"
        return f"<div>{text(1, 5)}</div>"

    out = []
    for _ in range(count):
        layout = draw.random()
        title = f"<h1>{mark}{words(2, 12)}</h1>" if draw.random() < 0.85 else ""
        parts = [main_block() for _ in range(draw.randint(1, 14))]
        for _ in range(draw.choice([0, 0, 1, 1, 2])):  # what does not belong, in the midst of it
            parts.insert(draw.randint(0, len(parts)), other(draw.choice(["ad", "ad", "note", "side", "form", "share"])))
        body = title + "".join(parts)
        talk = other("talk") if draw.random() < 0.4 else ""
        if talk and draw.random() < 0.4:
            body, talk = body + talk, ""
        if layout < 0.45:
            body = f"<article>{body}</article>" if draw.random() < 0.7 else f'<article class="{draw.choice(MAIN_NAMES)}">{body}</article>'
        elif layout < 0.6:
            body = f"<main>{body}</main>"
        elif layout < 0.9:
            body = f'<{(t := draw.choice(["div", "div", "section"]))} {draw.choice(["class", "id"])}="{draw.choice(MAIN_NAMES)}">{body}</{t}>'
        elif layout < 0.96:
            body = f"<div>{body}</div>"
        if draw.random() < 0.25:
            body = f"<main>{body}</main>" if draw.random() < 0.5 else f'<div class="{draw.choice(["wrapper", "container", "row", "page", "layout"])}">{body}</div>'
        before = [other(k) for k in ("head", "menu", "ad", "note", "form") if draw.random() < 0.5]
        after = [other(k) for k in ("side", "ad", "menu", "note", "share", "foot") if draw.random() < 0.45]
        draw.shuffle(before)
        page = "<html><body>" + "".join(before) + body + talk + "".join(after) + "</body></html>"
        found = blocks_of(page)
        clean = [(t.replace(mark, "").strip() or "-", path, links) for t, path, links in found]
        out.append((features(clean), [int(mark in t) for t, _, _ in found]))
    return [x for x in out if x[0]]


@lru_cache(1)
def trained() -> Chain:
    return train(labelled_pages())


def main_text(page: str | None, chain: Chain) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return "\n\n".join(b[0] for b, s in zip(blocks, chain.decode(features(blocks)), strict=True) if s)


def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    chain = chain or trained()
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def read(batches):
        for part in row_slices(batches):
            texts = [main_text(p, chain) for p in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(
        read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
