"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks: runs of text between block-level tags.  Every
block is described by its ancestors (tags and the words of their class, id
and role) and by its text (length, share of link text, punctuation, digits);
the field scores each block as main text or not and the passage from one
block to the next, and Viterbi decoding picks the best labelling of the whole
page.  The weights are fitted by maximum likelihood (forward-backward, ridge)
on ``TRAINING_PAGES`` labelled pages, which a seeded generator writes in many
layouts; they are fitted once per run on the driver and are a few kilobytes.

Scripts, styles, comments in the markup, the head and form controls are no
blocks.  Such an element ends at its own closing tag; one that closes itself, or
that has no closing tag before the next of its kind, takes along only the text
up to the next tag (a script or style: the rest of the page), and a head without
end is not skipped as such.  Character references are decoded, white space inside a block becomes
one space, blocks are joined in page order by a newline.

Defined cases: a null or empty html gives the empty text and 0; broken markup
is read as far as it goes (unclosed tags end with their parents, a lone ``<``
is text); rows are independent, so null ids and repeated rows are kept; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents

TRAINING_PAGES = 600
ROUNDS, RIDGE, RATE = 300, 0.3, 0.15

BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
                  "thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template head title textarea select button svg iframe object option".split())
NESTED = frozenset("svg object template".split())
# an opening tag ends an open element of the second set, up to the nearest of the third
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
          "td": ("td th", "tr table"), "th": ("td th", "tr table")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>"
    r"|<[!?/][^>]*+>|([^<]++|<)", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@lru_cache(50_000)
def _element(tag: str, attributes: str) -> tuple[str, ...]:
    """Features of one open element."""
    out = ["t:" + tag]
    for name, a, b, c in _ATTR.findall(attributes):
        out += ["w:" + p.lower() for p in _PART.findall(a or b or c)]
    return tuple(out)


class _Skips:
    """Where the skipped elements of a page end; the tags of a kind are looked up once, when the first is met."""

    def __init__(self, page: str):
        self.page, self.ends = page, {}

    def end(self, tag: str, start: int, at: int) -> int:
        """Position behind the element whose opening tag stands from ``start`` to ``at``."""
        if tag not in self.ends:
            ends, open_ = {}, []
            for m in re.finditer(rf"<{tag}\b(?:[^<>]*/>)?|</{tag}\s*[^<>]*>", self.page, re.I):
                if m[0][1] != "/":
                    if m[0].endswith("/>") and tag not in ("script", "style", "title", "textarea"):
                        continue             # closes itself
                    if tag not in NESTED and tag not in ("script", "style"):
                        open_.clear()        # the one before has no end of its own
                    if tag in NESTED or not open_:
                        open_.append(m.start())
                elif open_:
                    ends[open_.pop()] = m.end()
            self.ends[tag] = ends
        end = self.ends[tag].get(start)
        if end is not None:
            body = self.page.find("<body", at, end) if tag == "head" else -1
            return end if body < 0 else body
        if tag in ("script", "style"):
            return len(self.page)
        if tag == "head":
            return at
        nxt = self.page.find("<", at)
        return len(self.page) if nxt < 0 else nxt


def blocks(page: str) -> list[tuple[str, tuple, float]]:
    """(text, ancestor features, share of link characters) of the page's leaf blocks in order."""
    out: list[tuple[str, tuple, float]] = []
    tags: list[str] = []                 # open elements, innermost last
    features: list[tuple[str, ...]] = []
    count: dict[str, int] = {}           # open elements by tag
    held: dict[str, int] = {}            # features of the open block elements
    around: list[str] = []               # tags of the open block elements
    run: list[str] = []
    linked, where, known = 0, None, None
    skips = _Skips(page)

    def end():
        nonlocal linked, where
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                out.append((text, where, min(1.0, linked / len(text))))
            run.clear()
        linked, where = 0, None

    def drop(to: int):
        nonlocal known
        while len(tags) > to:
            tag, own = tags.pop(), features.pop()
            count[tag] -= 1
            if tag in BLOCK:
                around.pop()
                known = None
                for f in set(own):
                    held[f] -= 1
                    if not held[f]:
                        del held[f]

    def last(of) -> int:
        """Place of the innermost open element among ``of``, which holds at least one."""
        i = len(tags) - 1
        while tags[i] not in of:
            i -= 1
        return i

    at, closed = 0, page.rfind(">")
    while at < len(page):
        if at > closed and page[at] == "<" and not page.startswith("<!--", at):
            text, at = "<", at + 1       # no tag can end any more
        else:
            m = _TOKEN.match(page, at)
            at = m.end()
            text = m[7]
        if text is not None:
            if where is None and not text.isspace():
                if known is None:
                    known = (*sorted(held), "p:" + (around[-1] if around else ""))
                where = known
            run.append(text)
            if count.get("a"):
                linked += len(text)
            continue
        tag = m[2] or m[5]
        if tag is None:
            run.append(" ")
            continue
        tag = tag.lower()
        closing, rest = (m[1], m[3]) if m[2] else (m[4], m[6])
        if tag in SKIPPED:
            if not closing and (not rest.endswith("/") or tag in ("script", "style", "title", "textarea")):
                at = skips.end(tag, m.start(), at)
            continue
        if tag in BLOCK:
            end()
        if closing:
            if count.get(tag):
                drop(last((tag,)))
            continue
        if tag == "br":
            run.append(" ")
        if tag in BLOCK and count.get("p"):
            drop(last(("p",)))
        if tag in CLOSES:
            mine, border = CLOSES[tag]
            if any(count.get(t) for t in mine):
                i = last(mine | border)
                if tags[i] in mine:
                    drop(i)
        if tag not in VOID and not rest.endswith("/"):
            own = _element(tag, rest)
            tags.append(tag)
            features.append(own)
            count[tag] = count.get(tag, 0) + 1
            if tag in BLOCK:
                around.append(tag)
                known = None
                for f in set(own):
                    held[f] = held.get(f, 0) + 1
    end()
    return out


def _size(n: int) -> int:
    return n.bit_length()


def describe(text: str, where: tuple, linked: float) -> list[str]:
    """Features of one block."""
    words = text.count(" ") + 1
    marks = text.count(".") + text.count(",") + text.count(";") + text.count("?") + text.count("!")
    return [*(where or ("p:",)), f"n:{min(_size(words), 7)}", f"l:{int(linked * 4)}", f"e:{text[-1] in '.!?:;»”'}",
            f"m:{min(4, marks * 8 // words)}", f"c:{'©' in text or '(c)' in text}", f"s:{'|' in text or '·' in text or '»' in text}", "b"]


class Field:
    """Linear-chain field with two labels; block weights favour main text over the rest."""

    def __init__(self, weights: dict[str, float], step: np.ndarray, first: float, last: float):
        self.weights, self.step, self.first, self.last = weights, step, first, last

    def decode(self, rows: list[list[str]]) -> list[bool]:
        """Viterbi labels of a page's blocks."""
        if not rows:
            return []
        get = self.weights.get
        (s00, s01), (s10, s11) = self.step.tolist()
        back: list[tuple[bool, bool]] = []
        a = b = 0.0
        for i, fs in enumerate(rows):
            score = sum(get(f, 0.0) for f in fs)
            if i == 0:
                a, b = 0.0, self.first + score
                continue
            x, y = a + s00 >= b + s10, a + s01 >= b + s11
            back.append((not x, not y))
            a, b = (a + s00 if x else b + s10), (a + s01 if y else b + s11) + score
        lab = [b + self.last > a]
        for x, y in reversed(back):
            lab.append(y if lab[-1] else x)
        return lab[::-1]


def fit(pages: list[tuple[list[list[str]], list[bool]]]) -> Field:
    """Maximum likelihood with a ridge, by gradient steps scaled per weight (Adam); all pages at once."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for fs, _ in pages for b in fs for f in b})
    number = {f: i for i, f in enumerate(names)}
    n, t = len(pages), max(len(y) for _, y in pages)
    mask = np.zeros((n, t), bool)
    y = np.zeros((n, t), np.int64)
    where, feats = [], []
    for i, (fs, lab) in enumerate(pages):
        mask[i, :len(lab)], y[i, :len(lab)] = True, lab
        for j, b in enumerate(fs):
            where += [i * t + j] * len(b)
            feats += [number[f] for f in b]
    where, feats = np.array(where), np.array(feats)
    length = mask.sum(1)
    w, trans, ends = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    params = (w, trans, ends)
    mean, square = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    gold_step = np.zeros((2, 2))
    both = mask[:, 1:] & mask[:, :-1]
    np.add.at(gold_step, (y[:, :-1][both], y[:, 1:][both]), 1)
    gold = np.bincount(feats, weights=y.reshape(-1)[where], minlength=len(names))
    gold_ends = np.array([y[:, 0].sum(), y[np.arange(n), length - 1].sum()])
    for turn in range(ROUNDS):
        em = np.zeros((n, t, 2))
        em[:, :, 1] = np.bincount(where, weights=w[feats], minlength=n * t).reshape(n, t)
        em[:, 0, 1] += ends[0]
        em[np.arange(n), length - 1, 1] += ends[1]
        al, be = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        al[:, 0] = em[:, 0]
        for j in range(1, t):
            new = np.logaddexp(al[:, j - 1, :1] + trans[0], al[:, j - 1, 1:] + trans[1]) + em[:, j]
            al[:, j] = np.where(mask[:, j, None], new, al[:, j - 1])
        for j in range(t - 2, -1, -1):
            x = be[:, j + 1] + em[:, j + 1]
            new = np.logaddexp(trans[:, 0] + x[:, :1], trans[:, 1] + x[:, 1:])
            be[:, j] = np.where(mask[:, j + 1, None], new, 0)
        z = np.logaddexp(al[:, -1, 0], al[:, -1, 1])
        p = np.exp(np.clip(al[:, :, 1] + be[:, :, 1] - z[:, None], -50, 0)) * mask
        pair = al[:, :-1, :, None] + trans + (em[:, 1:] + be[:, 1:])[:, :, None, :] - z[:, None, None, None]
        pair = np.where(both[:, :, None, None], np.exp(np.clip(pair, -50, 0)), 0).sum((0, 1))
        grads = [gold - np.bincount(feats, weights=p.reshape(-1)[where], minlength=len(names)), gold_step - pair,
                 gold_ends - np.array([p[:, 0].sum(), p[np.arange(n), length - 1].sum()])]
        rate = RATE * (1 - turn / ROUNDS)
        for m, v, g, x in zip(mean, square, grads, params):
            g = g - RIDGE * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** (turn + 1))) / (np.sqrt(v / (1 - 0.99 ** (turn + 1))) + 1e-8)
    return Field(dict(zip(names, w.tolist())), trans, float(ends[0]), float(ends[1]))


# labelled pages --------------------------------------------------------------
_NAMES = {
    "menu": "nav menu navbar topnav navigation breadcrumbs tabs pager pagination toc skip".split(),
    "header": "header masthead top logo branding site-title".split(),
    "footer": "footer bottom colophon copyright legal site-footer imprint".split(),
    "side": "sidebar side aside related widget popular recommended more-stories tags rail secondary trending".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo banner ad-slot promotion teaser".split(),
    "notice": "notice cookie cookies consent alert gdpr popup modal overlay message warning newsletter subscribe paywall".split(),
    "social": "share social sharing follow buttons author-bio meta byline".split(),
    "form": "form login search signup contact".split(),
    "comments": "comments comment discussion replies reply responses reader-comments respond disqus".split(),
    "main": "content article post entry main story body text article-body post-content entry-content page".split(),
}


def labelled_page(seed: int) -> tuple[str, list[bool]]:
    """A page in a random layout and the label of each of its leaf blocks."""
    r = random.Random(seed)
    syl = [a + b for a in "b d f g k l m n p r s t v sch ch".split() for b in "a e i o u er en".split()]
    lab: list[bool] = []

    def word():
        return "".join(r.choice(syl) for _ in range(r.choice((1, 1, 2, 2, 3))))

    def sentence(lo=4, hi=18):
        w = [word() for _ in range(r.randint(lo, hi))]
        return " ".join(w).capitalize() + r.choice("....?!") if r.random() < 0.93 else " ".join(w)

    def prose(lo=1, hi=6):
        return " ".join(sentence() for _ in range(r.randint(lo, hi)))

    def name(kind):
        n = r.choice(_NAMES[kind])
        return n + r.choice(("", "", "-1", "-wrap", " " + word())) if r.random() < 0.85 else word()

    def box(kind, inner, tags="div", semantic=""):
        if semantic and r.random() < 0.55:
            tag = r.choice(semantic.split())
            return f"<{tag}>{inner}</{tag}>" if r.random() < 0.6 else f'<{tag} class="{name(kind)}">{inner}</{tag}>'
        tag = r.choice(tags.split())
        return f'<{tag} {r.choice(("class", "class", "id"))}="{name(kind)}">{inner}</{tag}>'

    def block(text, main, tag="p", close=True):
        lab.append(main)
        return f"<{tag}>{text}</{tag}>" if close else f"<{tag}>{text}"

    def links(n):
        out = "".join(block(f'<a href="/{word()}">{" ".join(word() for _ in range(r.randint(1, 3)))}</a>', False, "li") for _ in range(n))
        return f"<ul>{out}</ul>"

    def small(main=False):
        return block(r.choice((sentence(2, 6), prose(1, 3), sentence(3, 12))), main, r.choice(("p", "p", "div", "span")))

    def plain(kind, semantic=""):
        if r.random() < 0.5:
            lab.append(False)
            return box(kind, r.choice((sentence(2, 8), prose(1, 3), " ".join(word() for _ in range(3)))), "div div p section", semantic)
        first = len(lab)
        inner = "".join(block(r.choice((sentence(2, 8), prose(1, 2))), False) for _ in range(r.randint(1, 3)))
        assert len(lab) > first
        return box(kind, inner, "div section", semantic)

    def article():
        out = []
        if r.random() < 0.8:
            out.append(block(sentence(3, 10).rstrip("."), True, "h1"))
        for _ in range(r.choice((1, 2, 3, 4, 6, 9, 14))):
            k = r.random()
            if k < 0.66:
                if r.random() < 0.15:
                    lab.append(True)
                    out.append(f"<p><b>{sentence(2, 12)}<br>")
                else:
                    out.append(block(prose(1, 7) if r.random() < 0.8 else sentence(1, 5), True, "p", r.random() < 0.9))
            elif k < 0.72:
                out.append(block(sentence(2, 7).rstrip("."), True, r.choice(("h2", "h3"))))
            elif k < 0.78:
                out.append("<ul>" + "".join(block(sentence(2, 9), True, "li") for _ in range(r.randint(2, 5))) + "</ul>")
            elif k < 0.82:
                out.append("<blockquote>" + block(prose(1, 2), True) + "</blockquote>")
            elif k < 0.85:
                out.append("<table><tr>" + "".join(block(word(), True, "td") for _ in range(4)) + "</tr></table>")
            elif k < 0.89:
                out.append(plain("ad", "aside"))
            elif k < 0.93:
                out.append(plain("social"))
            elif k < 0.96:
                out.append(plain("side", "aside"))
            else:
                out.append("<figure>" + block(sentence(3, 9), True, "figcaption") + "</figure>")
        return "".join(out)

    def comments():
        inner = block(word(), False, "h3") if r.random() < 0.6 else ""
        for _ in range(r.randint(1, 4)):
            inner += box("comments", block(prose(1, 3), False), "div li article")
        return box("comments", inner, "div section ol", "section")

    page = "<!DOCTYPE html><html><head><title>" + sentence() + "</title><style>p{margin:0}</style></head><body>"
    if r.random() < 0.3:
        page += plain("notice", "dialog")
    if r.random() < 0.8:
        inner = (plain("header") if r.random() < 0.4 else "") + (links(r.randint(2, 7)) if r.random() < 0.8 else "")
        page += box("menu", inner or links(3), "div ul", "nav header nav")
    if r.random() < 0.2:
        page += plain("menu", "nav")
    if r.random() < 0.5:
        page += plain("ad", "aside")
    if r.random() < 0.25:
        page += box("side", links(r.randint(2, 5)) + small(), "div", "aside")
    page += box("main", article(), "div div section", "article article main")
    if r.random() < 0.35:
        page += comments()
    if r.random() < 0.3:
        page += box("side", links(r.randint(2, 6)) + (small() if r.random() < 0.5 else ""), "div", "aside")
    if r.random() < 0.25:
        lab.append(False)
        page += box("form", f"<form>{sentence(2, 6)}<input name=q><button>Go</button></form>")
    if r.random() < 0.25:
        page += plain("notice")
    if r.random() < 0.9:
        lab.append(False)
        page += box("footer", f"&copy; {word()} {r.choice(('&middot; ', '', '| '))}{sentence(2, 9)}", "div", "footer footer")
    return page + r.choice(("</body></html>", "", "</html>")), lab


def short_page(seed: int) -> tuple[str, list[bool]]:
    """A page with little but an article of one or two paragraphs, in a box or bare."""
    r = random.Random(f"short {seed}")
    word = lambda: "".join(r.choice(("ba", "ler", "to", "sen", "mi", "ka", "du", "ner")) for _ in range(r.randint(1, 3)))
    prose = lambda: " ".join(" ".join(word() for _ in range(r.randint(4, 16))).capitalize() + "." for _ in range(r.randint(1, 5)))
    inner, lab = "", []
    if r.random() < 0.3:
        inner, lab = f"<h1>{word()} {word()}</h1>", [True]
    for _ in range(r.choice((1, 1, 1, 2))):
        inner += f"<p>{prose()}</p>"
        lab.append(True)
    box = r.choice(("article", "main", "div", "", f'div class="{r.choice(_NAMES["main"])}"'))
    page = f"<{box}>{inner}</{box.split(' ')[0]}>" if box else inner
    if r.random() < 0.4:
        page += f"<footer>&copy; {word()}</footer>"
        lab.append(False)
    return f"<html><body>{page}</body></html>", lab


def training_set(n: int = TRAINING_PAGES) -> list[tuple[list[list[str]], list[bool]]]:
    out = []
    for page, lab in [labelled_page(seed) for seed in range(n)] + [short_page(seed) for seed in range(n // 12)]:
        found = blocks(page)
        if len(found) == len(lab):          # pages whose random markup runs two blocks together are not used
            out.append(([describe(*b) for b in found], lab))
    return out


def main_blocks(page: str | None, field: Field) -> list[str]:
    found = blocks(page or "")
    return [b[0] for b, keep in zip(found, field.decode([describe(*b) for b in found])) if keep]


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text."""
    shared = pages.sparkSession.sparkContext.broadcast(field or fit(training_set()))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))

    def run(batches):
        f = shared.value
        for b in batches:
            text = ["\n".join(main_blocks(h.as_py(), f)) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], ["page_id", "url", "text"])

    return rows.mapInArrow(run, "page_id long, url string, text string")


def op4_main_text(spark, sf_dir) -> DataFrame:
    return extract(documents(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


ORACLE_SQL = None
