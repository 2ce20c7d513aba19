"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

Every block is main text or not.  Features are the tags and attribute words of
its ancestors, its own tag, lengths, links and punctuation.  The field is
trained on labelled pages and a page is decoded by Viterbi's algorithm.

Labelled pages are built from a bounded sample of the table: blocks below its
article elements are main text, the rest is not, and the same texts are dressed
again in many page layouts, semantic and not, with menus, notices, adverts,
forms, sidebars and readers' comments, whose labels are known.
"""

from __future__ import annotations

import html
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwatch.llm.html_blocks import Block, Marks, Path, blocks_of

MEMORY = 50_000
CHAIN = 48
# Layouts of the labelled pages: what pages commonly call their parts.
MAIN_NAMES = (
    "content main article post entry story body text article-body post-content entry-content"
    " main-content story-body page-content hentry prose"
).split()
OTHER_NAMES = {
    "menu": "nav navbar menu main-menu navigation breadcrumb breadcrumbs topnav site-nav toc".split(),
    "header": "header site-header masthead topbar banner page-header branding".split(),
    "footer": "footer site-footer copyright legal colophon page-footer bottom".split(),
    "sidebar": "sidebar aside widget rail related recommended more-stories trending popular".split(),
    "notice": "cookie cookie-notice consent gdpr notice alert message popup modal paywall".split(),
    "advert": "ad ads advert advertisement sponsored promo banner-ad sponsor ad-slot".split(),
    "form": "newsletter subscribe signup login search search-form contact".split(),
    "share": "share social social-links tags pagination byline meta author-box".split(),
    "comments": "comments comment-list comment reply replies discussion responses disqus".split(),
}
SEMANTIC = {
    "menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form",
    "comments": "section", "notice": "div", "advert": "div", "share": "div",
}


@dataclass(frozen=True)
class Training:
    """The sample: pages read, longest page, layouts made of each, and the fit.

    Of a page with many main blocks the first ``blocks`` are dressed again; this
    bounds labelled pages alone, no page that is extracted.
    """

    pages: int = 150
    longest: int = 40_000
    layouts: int = 4
    blocks: int = 40
    steps: int = 300
    penalty: float = 2e-5
    seed: int = 7


@dataclass(frozen=True)
class Field:
    weights: dict[str, float]  # of main text against the rest
    start: float
    change: tuple[tuple[float, float], tuple[float, float]]


def item_features(item: tuple[str, tuple[str, ...]]) -> set[str]:
    """What an ancestor says of all blocks below it."""
    return {f"in={item[0]}"}.union(f"word={w}" for w in item[1])


def near_features(path: Path | tuple[()]) -> set[str]:
    """What a block's own element and the one around it say besides."""
    if not path:
        return {"own="}
    near = path.last(2)
    return {f"own={near[-1][0]}"}.union(f"near={w}" for _, words in near for w in words)


def path_features(path: Path | tuple[()]) -> list[str]:
    return sorted(near_features(path).union(*map(item_features, path)))


def text_features(block: Block) -> list[str]:
    text, n = block.text, len(block.text)
    out = [f"length={min(6, n.bit_length() - 3) if n > 7 else 0}"]
    share = block.linked / n
    out.append("links=" + ("none" if not block.linked else "some" if share < 0.5 else "all"))
    out.append("end=" + ("stop" if text[-1] in ".!?…:;\"'»”)" else "open"))
    if "©" in text or "(c)" in text.lower():
        out.append("copyright")
    if text.count(" ") < 3:
        out.append("few")
    return out


def _chain(emissions: np.ndarray, mask: np.ndarray, start: float, change: np.ndarray):
    """Forward and backward messages of padded chains, in logarithms."""
    pages, steps = mask.shape
    states = np.stack([np.zeros_like(emissions), emissions], -1)
    ahead = np.zeros((pages, steps, 2))
    ahead[:, 0] = states[:, 0] + np.array([0.0, start])
    for t in range(1, steps):
        move = np.logaddexp.reduce(ahead[:, t - 1, :, None] + change, axis=1) + states[:, t]
        ahead[:, t] = np.where(mask[:, t, None], move, ahead[:, t - 1])
    back = np.zeros((pages, steps, 2))
    for t in range(steps - 2, -1, -1):
        move = np.logaddexp.reduce(change + (states[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
        back[:, t] = np.where(mask[:, t + 1, None], move, 0.0)
    return states, ahead, back


def train(pages: list[tuple[list[Block], list[int]]], rule: Training = Training()) -> Field:
    """Maximum likelihood with a quadratic penalty, by adaptive gradient steps.

    Long pages are learned as several chains.
    """
    pages = [
        (blocks[i : i + CHAIN], labels[i : i + CHAIN])
        for blocks, labels in pages
        for i in range(0, len(blocks), CHAIN)
    ]
    names: dict[str, int] = {}
    rows = [
        [
            [names.setdefault(f, len(names)) for f in path_features(b.path) + text_features(b)]
            for b in blocks
        ]
        for blocks, _ in pages
    ]
    steps = max((len(r) for r in rows), default=1)
    y, mask = np.zeros((len(rows), steps)), np.zeros((len(rows), steps), bool)
    for i, (r, (_, labels)) in enumerate(zip(rows, pages, strict=True)):
        mask[i, : len(r)], y[i, : len(r)] = True, labels
    x = np.zeros((int(mask.sum()), len(names)), np.float32)  # a row per block, in page order
    for row, found in zip(x, (found for r in rows for found in r), strict=True):
        row[found] = 1
    w = np.zeros(len(names) + 5)
    seen = np.full(len(w), 1e-8)
    pairs = mask[:, 1:, None, None] * (
        np.stack([1 - y[:, :-1], y[:, :-1]], -1)[..., None]
        * np.stack([1 - y[:, 1:], y[:, 1:]], -1)[:, :, None, :]
    )
    total, emissions = max(1, mask.sum()), np.zeros(mask.shape)
    for _ in range(rule.steps if len(rows) else 0):
        change = w[-4:].reshape(2, 2)
        emissions[mask] = x @ w[:-5].astype(np.float32)
        states, ahead, back = _chain(emissions, mask, w[-5], change)
        z = np.logaddexp.reduce(ahead[:, -1], axis=1)
        p = np.exp(ahead + back - z[:, None, None])[..., 1] * mask
        both = np.exp(
            ahead[:, :-1, :, None]
            + change
            + (states[:, 1:] + back[:, 1:])[:, :, None, :]
            - z[:, None, None, None]
        )
        moves = (both * mask[:, 1:, None, None] - pairs).sum(axis=(0, 1)).ravel()
        slope = np.r_[
            (p - y)[mask].astype(np.float32) @ x, ((p - y) * mask)[:, 0].sum(), moves
        ] / total + rule.penalty * w
        seen += slope**2
        w -= slope / np.sqrt(seen)
    weights = {f: float(w[k]) for f, k in names.items()}
    return Field(weights, float(w[-5]), tuple(map(tuple, w[-4:].reshape(2, 2).tolist())))


class Decoder:
    """Viterbi over the blocks of a page.

    From block to block only the ancestors that differ are counted anew, so a
    page's paths take time in the number of its tags, however deep they stand.
    """

    def __init__(self, field: Field):
        self.field = field
        self.items: dict[tuple, Marks] = {}
        self.restart()

    def restart(self) -> None:
        self.path: Path | None = None
        self.seen: Counter[str] = Counter()
        self.known = 0.0

    def marks(self, node: Path) -> Marks:
        if node.marks is None:
            found = self.items.get(node.item)
            if found is None:
                if len(self.items) > MEMORY:
                    self.items.clear()
                weights, (tag, words) = self.field.weights, node.item
                far = sorted(f for f in item_features(node.item) if f in weights)
                near = sorted(f for f in {f"near={w}" for w in words} if f in weights)
                found = self.items[node.item] = Marks(tuple(far), tuple(near), f"own={tag}")
            node.marks = found
        return node.marks

    def enter(self, path: Path | None) -> None:
        """Make this path the counted one: leave and enter what the two do not share."""
        here, new = self.path, []
        while here is not path:
            if path is None or here is not None and here.depth >= path.depth:
                self.count(here, -1)
                here = here.parent
            else:
                new.append(path)
                path = path.parent
        for node in reversed(new):
            self.count(node, 1)
        self.path = new[0] if new else here

    def count(self, node: Path, step: int) -> None:
        for f in self.marks(node).far:
            before = self.seen[f]
            self.seen[f] = before + step
            if not before or not before + step:
                self.known += step * self.field.weights[f]
        if node.depth == 1 and step < 0:
            self.known = 0.0  # no ancestor is left, nor a rounding error

    def emission(self, block: Block) -> float:
        weights, path = self.field.weights, block.path or None
        self.enter(path)
        total = self.known
        if path is None:
            total += weights.get("own=", 0.0)
        else:
            mine = self.marks(path)
            total += weights.get(mine.own, 0.0) + sum(weights[f] for f in mine.near)
            if path.parent:
                around = self.marks(path.parent).near
                total += sum(weights[f] for f in around if f not in mine.near)
        return total + sum(weights.get(f, 0.0) for f in text_features(block))

    def decode(self, blocks: list[Block]) -> list[int]:
        if not blocks:
            return []
        self.restart()
        (stay, enter), (leave, go_on) = self.field.change
        other, main, came = 0.0, self.field.start + self.emission(blocks[0]), []
        for block in blocks[1:]:
            e = self.emission(block)
            to_other = main + leave > other + stay
            to_main = main + go_on >= other + enter
            came.append((to_other, to_main))
            other, main = (
                main + leave if to_other else other + stay,
                (main + go_on if to_main else other + enter) + e,
            )
        state = int(main > other)
        out = [state]
        for step in reversed(came):
            state = int(step[state])
            out.append(state)
        return out[::-1]


def weak_labels(blocks: list[Block]) -> list[int]:
    """Main text stands in an article and in nothing that is named otherwise there."""
    other = {n for names in OTHER_NAMES.values() for n in names} | {"nav", "aside", "form", "footer"}
    out = []
    for b in blocks:
        path = list(b.path)
        inside = next((i for i, (tag, _) in enumerate(path) if tag == "article"), None)
        own = path[inside + 1 :] if inside is not None else ()
        named = any(tag in other or other.intersection(words) for tag, words in own)
        out.append(int(inside is not None and not named))
    return out


def dressed(
    main: list[str], strange: list[str], links: list[str], rng: random.Random
) -> tuple[str, set[str]]:
    """A page that shows the main texts, each marked to be found again, in a random layout.

    Returns the page and the marks of its main blocks.
    """
    marks: set[str] = set()

    def mark(text: str, wanted: bool) -> str:
        key = f"b{rng.getrandbits(48):012x}"
        if wanted:
            marks.add(key)
        return f"{key} {html.escape(text)}"

    def part(kind: str) -> str:
        name = rng.choice(OTHER_NAMES[kind])
        semantic = rng.random() < 0.5
        tag = SEMANTIC[kind] if semantic else rng.choice(["div", "div", "section", "ul"])
        attribute = rng.choice(["class", "class", "id"])
        named = not semantic or tag in ("div", "section") or rng.random() < 0.5
        head = f'<{tag} {attribute}="{name}">' if named else f"<{tag}>"
        pick = lambda: rng.choice(strange)
        inner = []
        if kind in ("menu", "share") or rng.random() < 0.2:
            item = "li" if rng.random() < 0.7 else "span"
            row = [
                f'<{item}><a href="/x">{mark(rng.choice(links), False)}</a></{item}>'
                for _ in range(rng.randint(2, 7))
            ]
            inner.append("<ul>" + "".join(row) + "</ul>" if item == "li" else "".join(row))
        if kind == "comments":
            inner.append(f"<h3>{mark('Comments', False)}</h3>")
            for _ in range(rng.randint(1, 5)):
                text = f"<p>{mark(pick(), False)}</p>"
                inner.append(rng.choice([text, f'<div class="comment">{text}</div>', f"<li>{text}</li>"]))
        elif kind == "form":
            inner.append(f"<label>{mark(pick()[:40], False)}</label><input><button>Go</button>")
        elif kind == "header":
            inner.append(rng.choice(["<h1>{}</h1>", "<p>{}</p>", "{}"]).format(mark(pick()[:60], False)))
        elif kind not in ("menu", "share"):
            for _ in range(rng.randint(1, 3)):
                shape = rng.choice(["<p>{}</p>", "{}", "<h3>{}</h3>", "<div>{}</div>"])
                inner.append(shape.format(mark(pick()[: rng.choice([40, 120, 400])], False)))
            if kind == "footer":
                inner.append(mark("© " + pick()[:40], False))
        return head + "".join(inner) + f"</{tag}>"

    body = []
    for i, text in enumerate(main):
        shape = "<h1>{}</h1>" if i == 0 and rng.random() < 0.8 else rng.choice(
            ["<p>{}</p>"] * 6 + ["<p>{}", "<h2>{}</h2>", "<blockquote>{}</blockquote>",
             "<ul><li>{}</li></ul>", "<pre>{}</pre>", "<div>{}</div>", "<p><b>{}</b><br></p>",
             '<table><tr><td>{}</td></tr></table>']
        )
        body.append(shape.format(mark(text, True)))
        if rng.random() < 0.2:
            body.append(part(rng.choice(["advert", "notice", "sidebar", "share", "form"])))
    if rng.random() < 0.3:
        body.append(part(rng.choice(["share", "comments", "comments", "sidebar"])))
    inside = "".join(body)
    if rng.random() < 0.6:
        name = f' class="{rng.choice(MAIN_NAMES)}"' if rng.random() < 0.3 else ""
        inside = f"<article{name}>{inside}</article>"
    elif rng.random() < 0.85:
        tag, kind = rng.choice(["div", "main", "section", "div"]), rng.choice(["class", "id"])
        inside = f'<{tag} {kind}="{rng.choice(MAIN_NAMES)}">{inside}</{tag}>'
    if rng.random() < 0.4:
        inside = f"<main>{inside}</main>" if rng.random() < 0.5 else f'<div id="page">{inside}</div>'
    before = ["header", "menu", "notice", "advert", "form", "sidebar"]
    after = ["comments", "sidebar", "advert", "share", "form", "notice", "footer", "menu"]
    top = [part(k) for k in before if rng.random() < 0.5]
    end = [part(k) for k in after if rng.random() < 0.45]
    return f"<html><body>{''.join(top)}{inside}{''.join(end)}</body></html>", marks


def labelled_pages(
    sample: list[str], rule: Training = Training()
) -> list[tuple[list[Block], list[int]]]:
    """The sample by its article elements, and dressed again in other layouts."""
    rng = random.Random(rule.seed)
    known = [(b, weak_labels(b)) for b in map(blocks_of, sample)]
    known = [(b, y) for b, y in known if any(y)]
    mains = [[b.text for b, y in zip(*p, strict=True) if y] for p in known]
    strange = [t for m in mains for t in m] or ["Text."]
    strange += [b.text for p in known for b, y in zip(*p, strict=True) if not y]
    links = [t[:20] for t in strange]
    out = list(known)
    for _ in range(rule.layouts):
        for main in mains:
            page, marks = dressed(main[: rule.blocks], strange, links, rng)
            blocks = blocks_of(page)
            labels = [int(b.text[:13] in marks) for b in blocks]
            plain = [Block(b.text[14:] or "-", b.path, max(0, b.linked - 14)) for b in blocks]
            out.append((plain, labels))
    return out


def fitted(pages: DataFrame, rule: Training = Training()) -> Field:
    """A field trained on ``rule.pages`` pages of the table, chosen by a hash of their id.

    Without usable pages all weights are zero and no block is main text.
    """
    usable = F.col("html").isNotNull() & (F.length("html") <= rule.longest)
    # ids are chosen first, so that tasks send the driver numbers and not pages
    known = pages.where(usable & F.col("page_id").isNotNull()).select("page_id").distinct()
    chosen = known.orderBy(F.xxhash64("page_id"), "page_id").limit(rule.pages)
    rows = pages.where(usable).join(F.broadcast(chosen), "page_id").groupBy("page_id")
    found = rows.agg(F.min("html").alias("html")).orderBy("page_id").collect()
    return train(labelled_pages([r.html for r in found], rule), rule)


def extracted(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url and main text of every page; a null or empty page has an empty text.

    Blocks keep the page's order and are joined by line feeds.  Rows that repeat
    an id are extracted one by one.
    """
    sent = pages.sparkSession.sparkContext.broadcast(field)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(sent.value)
        for batch in batches:
            out = []
            for page in batch.column(2).to_pylist():
                blocks = blocks_of(page)
                labels = decoder.decode(blocks)
                out.append("\n".join(b.text for b, y in zip(blocks, labels, strict=True) if y))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string())],
                names=["page_id", "url", "text"],
            )

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        extract, "page_id long, url string, text string"
    )
