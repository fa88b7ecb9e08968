"""Main text of web pages: a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass
from functools import lru_cache
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, require
from .common import text_of

#: Elements that do not part one block from the next.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr iframe noscript object svg text tspan "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded msub msup msubsup munder mover "
    "munderover".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no text of the page: what is never shown, and form controls.
HIDDEN = frozenset("title script style template textarea select".split())
#: Elements that may stand in a head; any other one ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: An element that begins ends an open one of these.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
#: Elements that such an end does not reach across.
WALLS = frozenset("table ul ol dl article section div main aside nav header footer form body html".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TAG_START = re.compile("<[A-Za-z/!?]")


@dataclass
class Block:
    """``path``: tag and class words of every ancestor, outermost first."""

    path: tuple[str, ...]
    text: str
    linked: int


def _finished(html: str) -> str:
    """The page without a comment or a tag that its end leaves open."""
    comment = html.find("<!--", max(0, html.rfind("-->") - 3))
    tag = _TAG_START.search(html, html.rfind(">") + 1)
    ends = [at for at in (comment, tag.start() if tag else -1) if at >= 0]
    return html[: min(ends)] if ends else html


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked, self.hidden, self.links = 0, 0, 0

    def parse_marked_section(self, i, report=1):
        """``<![`` is a comment up to the next ``>`` in HTML, whatever it says."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(tuple(s for _, s in self.stack), text, self.linked))
        self.parts, self.linked = [], 0

    def _pop(self, n):
        for tag, _ in self.stack[n:]:
            self.hidden -= tag in HIDDEN
            self.links -= tag == "a"
        del self.stack[n:]

    def _end_open(self, names):
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag in names:
                self._pop(k)
                return
            if tag in WALLS:
                return

    def _end_head(self):
        for k, (tag, _) in enumerate(self.stack):
            if tag == "head":
                self._pop(k)
                return

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD and not self.hidden:
            self._end_head()
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.flush()
        if tag in _CLOSES_P:
            self._end_open(("p",))
        if tag in ENDS:
            self._end_open(ENDS[tag])
        if tag in VOID:
            return
        marks = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        self.stack.append((tag, f"{tag} {marks.lower()}" if marks else tag))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self._pop(k)
                return
            if tag in INLINE and self.stack[k][0] not in INLINE:
                return

    def handle_data(self, data):
        if not self.hidden:
            if self.stack and self.stack[-1][0] == "head" and not data.isspace():
                self._end_head()
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def leaf_blocks(html: str) -> list[Block]:
    """Text between block borders, white space as one space, references decoded."""
    parser = _Blocks()
    parser.feed(_finished(html))
    parser.close()
    parser.flush()
    return parser.blocks


# ---- features -----------------------------------------------------------------

#: Words of class, id and role attributes by what they announce.
NAMES = {
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toc pagination pager tabs",
    "side": "sidebar side aside related recommended widget teaser trending popular rail more",
    "notice": "cookie cookies consent gdpr notice alert warning popup modal overlay paywall toast",
    "talk": "comment comments reply replies disqus discussion respond feedback reviews",
    "form": "form search login signin signup register subscribe newsletter",
    "share": "share sharing social follow tags tools print",
    "foot": "footer copyright legal colophon contentinfo imprint",
    "head": "header masthead logo brand",
    "main": "article content main post entry story body text prose maincontent articlebody",
}
_NAME_OF = {w: k for k, words in NAMES.items() for w in words.split()}
_TAGS = frozenset(
    "article main section nav aside footer header form ul ol li dl p h1 h2 h3 h4 h5 h6 blockquote "
    "pre table td th figure figcaption address details button label div span body".split()
)
_MARK = re.compile("[a-z0-9]+")


@lru_cache(maxsize=100_000)
def path_features(path: tuple[str, ...]) -> tuple[str, ...]:
    """Ancestor tags and announced roles; the innermost structural element counts extra."""
    found, inner, inside = set(), "none", False
    for step in path:
        tag, _, marks = step.partition(" ")
        if tag in _TAGS:
            found.add("in " + tag)
        roles = {_NAME_OF[w] for w in _MARK.findall(marks) if w in _NAME_OF}
        found.update("is " + r for r in roles)
        if tag == "header" and inside:
            found.add("header of article")
        inside |= tag in ("article", "main") or "main" in roles
        for role in sorted(roles) or ([tag] if tag in ("article", "main", "nav", "aside", "footer", "header", "form") else []):
            inner = role
    tags = [s.partition(" ")[0] for s in path if s.partition(" ")[0] not in INLINE]
    leaf = tags[-1] if tags and tags[-1] in _TAGS else "other"
    found.update(("leaf " + leaf, "inner " + inner, f"inner {inner} leaf {leaf}"))
    return tuple(sorted(found))


def text_features(block: Block, k: int, n: int) -> list[str]:
    words = block.text.count(" ") + 1
    share = block.linked / len(block.text)
    out = [
        "words %d" % min(6, words.bit_length()),
        "links %d" % (0 if share == 0 else 1 if share < 0.5 else 2),
        "closed" if block.text[-1] in ".!?…\"'”»)" else "open",
    ]
    if "©" in block.text or "(c)" in block.text[:40].lower():
        out.append("copyright")
    if k == 0:
        out.append("first")
    if k == n - 1:
        out.append("last")
    return out


def features(blocks: list[Block]) -> list[list[str]]:
    n = len(blocks)
    return [[*path_features(b.path), *text_features(b, k, n)] for k, b in enumerate(blocks)]


def _same_parent(a: Block, b: Block) -> int:
    return int(a.path[:-1] == b.path[:-1])


# ---- the random field ----------------------------------------------------------


@dataclass
class Field:
    """Weights for label 1 (main text) against 0; ``steps[same][before][after]`` for neighbours."""

    weights: dict[str, float]
    steps: list[list[list[float]]]

    def scores(self, feats: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in own]) for own in feats]

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best labelling, by Viterbi; of equal ones that with less text."""
        if not blocks:
            return []
        scores = self.scores(features(blocks))
        best, back = [0.0, scores[0]], []
        for k in range(1, len(blocks)):
            step = self.steps[_same_parent(blocks[k - 1], blocks[k])]
            row, came = [], []
            for y in (0, 1):
                options = [best[x] + step[x][y] for x in (0, 1)]
                x = int(options[1] > options[0])
                row.append(options[x] + (scores[k] if y else 0.0))
                came.append(x)
            best = row
            back.append(came)
        labels = [int(best[1] > best[0])]
        for came in reversed(back):
            labels.append(came[labels[-1]])
        return labels[::-1]


def _logsum(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log(math.exp(a - high) + math.exp(b - high))


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 12, rate: float = 0.3) -> Field:
    """Maximum likelihood with a small penalty, by AdaGrad over the pages in order."""
    field = Field({}, [[[0.0, 0.0], [0.0, 0.0]] for _ in range(2)])
    seen: dict = {}
    data = [
        (features(b), [_same_parent(x, y) for x, y in zip(b, b[1:])], labels)
        for b, labels in pages if b
    ]

    def move(key, slope):
        seen[key] = seen.get(key, 1e-6) + slope * slope
        return rate * slope / math.sqrt(seen[key])

    for _ in range(rounds):
        for feats, same, labels in data:
            n, scores = len(feats), field.scores(feats)
            fore = [[0.0, scores[0]]]
            for k in range(1, n):
                s, p = field.steps[same[k - 1]], fore[-1]
                fore.append(
                    [_logsum(p[0] + s[0][y], p[1] + s[1][y]) + (scores[k] if y else 0.0) for y in (0, 1)]
                )
            after = [[0.0, 0.0]]
            for k in range(n - 1, 0, -1):
                s, q = field.steps[same[k - 1]], after[-1]
                after.append([_logsum(s[x][0] + q[0], s[x][1] + scores[k] + q[1]) for x in (0, 1)])
            after.reverse()
            total = _logsum(*fore[-1])
            moves: dict = {}
            for k in range(n):
                error = labels[k] - math.exp(fore[k][1] + after[k][1] - total)
                for f in feats[k]:
                    moves[f] = moves.get(f, 0.0) + error
            for k in range(1, n):
                s = field.steps[same[k - 1]]
                for x in (0, 1):
                    for y in (0, 1):
                        p = math.exp(
                            fore[k - 1][x] + s[x][y] + (scores[k] if y else 0.0) + after[k][y] - total
                        )
                        key = (same[k - 1], x, y)
                        hit = labels[k - 1] == x and labels[k] == y
                        moves[key] = moves.get(key, 0.0) + hit - p
            for key, slope in moves.items():
                if isinstance(key, str):
                    w = field.weights.get(key, 0.0)
                    field.weights[key] = w + move(key, slope - 0.002 * w)
                else:
                    g, x, y = key
                    w = field.steps[g][x][y]
                    field.steps[g][x][y] = w + move(key, slope - 0.002 * w)
    return field


# ---- labelled pages -------------------------------------------------------------

#: Put before main text in a labelled page; the label reader takes it away.
MARK = "\ue000"


class _PageWriter:
    """Writes pages of many layouts in which the main text is marked."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)
        self.plain = False

    def pick(self, *options):
        return self.random.choice(options)

    def words(self, low, high):
        n = self.random.randint(low, high)
        return " ".join(
            "".join(self.random.choice("aeioubdfglmnprst") for _ in range(self.random.randint(2, 9)))
            for _ in range(n)
        )

    def sentence(self, low=4, high=40):
        return self.words(low, high).capitalize() + self.pick(".", ".", ".", "!", "?", "")

    def wrap(self, body, tags, names, bare=0.3):
        tag = self.pick(*tags)
        if self.random.random() < bare and tag not in ("div", "section"):
            return f"<{tag}>{body}</{tag}>"
        if self.plain:
            return self.pick(f"<div>{body}</div>", f'<div class="{self.words(1, 1)}">{body}</div>')
        attr = self.pick("class", "class", "id")
        name = self.pick(*names)
        name = self.pick(name, name, name + "-" + self.words(1, 1), self.words(1, 1) + "-" + name)
        return f'<{tag} {attr}="{name}">{body}</{tag}>'

    def link(self, text):
        return f'<a href="/{self.words(1, 1)}">{text}</a>'

    def menu(self):
        items = [self.link(self.words(1, 3)) for _ in range(self.random.randint(2, 8))]
        body = self.pick(
            "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", " | ".join(items), " ".join(items)
        )
        return self.wrap(body, ("nav", "nav", "div", "ul"), NAMES["menu"].split())

    def bare_links(self):
        """Links without a word that says what they are."""
        items = [self.link(self.words(1, 3)) for _ in range(self.random.randint(1, 8))]
        return self.pick(
            "<div>" + self.pick(" ", " | ", "").join(items) + "</div>",
            "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>",
            "<table><tr>" + "".join(f"<td>{i}</td>" for i in items) + "</tr></table>",
            "<p>" + " ".join(items) + "</p>",
        )

    def bare_notice(self):
        return f"<div>{self.pick('&copy;', '©')} {self.sentence(1, 12)}</div>"

    def bare_page(self) -> str:
        """A page whose classes tell nothing: only its links, forms and form of text do."""
        self.plain = True
        before = "".join(self.pick(self.bare_links, self.form)() for _ in range(self.random.randint(0, 2)))
        after = "".join(self.pick(self.bare_links, self.form, self.bare_notice)() for _ in range(self.random.randint(0, 3)))
        body = "".join(self.main_block() for _ in range(self.random.randint(1, 12)))
        body = self.pick(body, self.wrap(body, ("div",), ()), f"<article>{body}</article>", f"<table><tr><td>{body}</td></tr></table>")
        self.plain = False
        return f"<html><head><title>{self.words(1, 9)}</title><body>{before}{body}{after}"

    def advert(self):
        body = self.pick(self.sentence(2, 25), f"<p>{self.sentence(2, 25)}</p>", self.link(self.sentence(2, 12)))
        return self.wrap(body, ("div", "div", "aside", "section"), NAMES["ad"].split(), 0.1)

    def notice(self):
        body = f"<p>{self.sentence(4, 30)}</p>" + self.pick("", f"<button>{self.words(1, 2)}</button>")
        return self.wrap(self.pick(body, self.sentence(4, 30)), ("div", "section"), NAMES["notice"].split())

    def sidebar(self):
        body = f"<h3>{self.words(1, 4)}</h3>" + self.pick(
            "<ul>" + "".join(f"<li>{self.link(self.words(2, 9))}</li>" for _ in range(4)) + "</ul>",
            f"<p>{self.sentence(5, 40)}</p>",
        )
        return self.wrap(body, ("aside", "aside", "div"), NAMES["side"].split())

    def form(self):
        body = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>"
        body = self.pick("", f"<p>{self.sentence(3, 15)}</p>") + body
        return self.pick(f"<form>{body}</form>", self.wrap(f"<form>{body}</form>", ("div",), NAMES["form"].split()))

    def talk(self):
        one = "".join(
            self.pick(f"<p>{self.sentence(2, 50)}</p>", f"<li>{self.sentence(2, 50)}</li>",
                      f"<div>{self.words(1, 2)}</div><p>{self.sentence(2, 60)}</p>")
            for _ in range(self.random.randint(1, 5))
        )
        return self.wrap(f"<h2>{self.words(1, 3)}</h2>{one}", ("section", "div", "div", "ol"), NAMES["talk"].split(), 0)

    def header(self):
        body = self.pick(f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.words(1, 6)}</p>", self.words(1, 4)) + self.pick("", self.menu())
        return self.wrap(body, ("header", "header", "div"), NAMES["head"].split())

    def footer(self):
        body = self.pick("&copy; ", "© 2020 ", "") + self.sentence(1, 20)
        body = self.pick(body, f"<p>{body}</p>", body + self.menu())
        return self.wrap(body, ("footer", "footer", "div"), NAMES["foot"].split())

    def share(self):
        return self.wrap(self.link(self.words(1, 2)) + " " + self.link(self.words(1, 2)), ("div",), NAMES["share"].split())

    def main_block(self):
        text = MARK + escape(self.sentence(1, self.pick(8, 30, 90, 200)))
        if self.random.random() < 0.2:
            text += " " + self.link(self.words(1, 4)) + " " + self.words(2, 20) + "."
        return self.pick(
            f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}</p>", f"<p><b>{text}<br>", f"<p>{text}",
            f"<h2>{MARK}{self.words(1, 8)}</h2>", f"<ul><li>{text}</li><li>{MARK}{self.words(1, 20)}</li></ul>",
            f"<blockquote>{text}</blockquote>", f"<div>{text}</div>", f"<pre>{text}</pre>",
            f"<table><tr><td>{MARK}{self.words(1, 5)}</td><td>{MARK}{self.words(1, 5)}</td></tr></table>",
            f"<figure><figcaption>{text}</figcaption></figure>",
        )

    def article(self):
        parts = [self.main_block() for _ in range(self.random.randint(1, 14))]
        inside = (self.advert, self.sidebar, self.share, self.form, self.notice)
        if self.random.random() < 0.35:
            parts.insert(self.random.randint(0, len(parts)), self.pick(*inside)())
        title = f"<h1>{MARK}{self.words(1, 12)}</h1>"
        parts.insert(0, self.pick(title, title, f"<header>{title}</header>", ""))
        if self.random.random() < 0.2:
            parts.append(self.talk())
        return self.wrap("".join(parts), ("article", "article", "article", "main", "div"), NAMES["main"].split(), 0.5)

    def page(self) -> str:
        if self.random.random() < 0.2:
            return self.bare_page()
        before = [self.menu, self.header, self.advert, self.notice, self.form, self.sidebar]
        after = [self.footer, self.talk, self.sidebar, self.advert, self.share, self.form, self.menu, self.notice]
        self.random.shuffle(before)
        self.random.shuffle(after)
        top = "".join(f() for f in before[: self.random.randint(0, 4)])
        end = "".join(f() for f in after[: self.random.randint(0, 4)])
        middle = self.pick(
            self.article(), self.article(), f"<main>{self.article()}</main>",
            f"<section>{self.article()}</section>", f'<div class="page">{self.article()}</div>',
            "".join(self.main_block() for _ in range(self.random.randint(2, 9))),
        )
        return (
            f"<html><head><title>{self.words(1, 9)}</title><style>p{{margin:0}}</style></head>"
            f"<body>{top}{middle}{end}</body></html>"
        )


def labelled(html: str) -> tuple[list[Block], list[int]]:
    """Blocks of a labelled page without the marks, and their labels."""
    blocks = leaf_blocks(html)
    labels = [int(MARK in b.text) for b in blocks]
    for b in blocks:
        b.text = b.text.replace(MARK, "") or "-"
    return blocks, labels


def labelled_pages(count: int, seed: int) -> list[tuple[list[Block], list[int]]]:
    writer = _PageWriter(seed)
    return [labelled(writer.page()) for _ in range(count)]


#: Labelled pages that the field is trained on, and the seed of their layouts.
TRAINING_PAGES, TRAINING_SEED = 400, 11


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_pages(TRAINING_PAGES, TRAINING_SEED))


def main_text(html: str, field: Field) -> str:
    blocks = leaf_blocks(html)
    return "\n".join(b.text for b, y in zip(blocks, field.decode(blocks)) if y)


def extract(df: DataFrame, html_col: str = "html", text_col: str = "main_text", field: Field | None = None) -> DataFrame:
    """The input columns without the html, and the main text.

    Blocks of the main text in page order, joined by line breaks; white space in
    a block is one space, character references are decoded. A null, empty or
    text-less page gives an empty text. An input column named like ``text_col``
    is replaced. Repeated rows stay, an empty table gives an empty result.

    ``field`` defaults to one trained on 400 labelled pages, written from layouts
    with a fixed seed. Each page is parsed and decoded in its task, nothing is
    shuffled.
    """
    field = field or default_field()
    require(df, [html_col])
    kept = [c for c in df.columns if c not in (html_col, text_col)]

    def run(source):
        for batch in source:
            texts = [main_text(h.as_py(), field) for h in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(texts, pa.string())], names=["row", "text"]
            )

    box = F.struct(*[col(c) for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    rows = df.select(box.alias("row"), text_of(df, html_col).alias("html"))
    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(run, f"row {kind}, text string")
    return found.select(
        *[F.col("row").getField(c).alias(c) for c in kept], F.col("text").alias(text_col)
    )
