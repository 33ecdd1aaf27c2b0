"""Main text of web pages by a linear-chain conditional random field.

A page becomes the sequence of its leaf blocks: runs of text that no block-level
tag interrupts. Each block carries features of its ancestors (tags, and words of
their class, id and role) and of its text (length, links, punctuation, own tag).
A two-label chain (main text or not) scores blocks and label changes; it is
trained by gradient ascent on the exact likelihood (forward-backward) and decoded
by Viterbi.

Labelled pages: the layouts below, whose slots say what is main text, filled
with blocks of a bounded, documented sample of pages (``SAMPLE_PAGES``, those
with the smallest id hashes), and those sample pages themselves as far as their
markup names the article. Every page is decoded, from its whole html.

A head ends at the first tag or text that cannot stand in it, a self-closing
drawing or formula hides nothing behind it, and references are decoded run by run.
Null and empty html give an empty text; broken and cut-off markup is read as far
as it goes. Repeated rows are decoded alike, extra columns are not read, an
empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadal.llm.tables import utf8_values

SAMPLE_PAGES = 256
SAMPLE_CHARS = 20_000  # longer pages are not learned from
STEPS = 200

# what a page does not show as text; fallbacks (noscript, object) and formulas reach the chain
HIDDEN = "script|style|template|iframe|textarea|select|title"
_INSIDE = r"(?>\"[^\"]*+\"|'[^']*+'|[^>\"']|[\"'])*+"
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<hidden>{HIDDEN})(?=[\s/>]){_INSIDE}>.*?(?:</(?P=hidden)(?=[\s/>])[^>]*+>|\Z)"
    rf"|<(?P<drawn>svg)(?=[\s/>]){_INSIDE}(?:(?<=/)>|>.*?(?:</svg\s*+>|\Z))"
    r"|<[!?][^>]*+>?"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>{_INSIDE})(?:>|\Z)",
    re.S | re.I,
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr img br input picture source noscript object "
    "math mi mn mo mrow ms mtext msub msup msubsup mfrac msqrt mroot mover munder".split()
)
IN_HEAD = frozenset("html head base basefont bgsound link meta noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {  # an opening tag ends these open ones
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPE = frozenset("ul ol dl table div section article td th body main aside nav form".split())
NAMES = re.compile(r"""(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass(frozen=True)
class Block:
    text: str
    names: frozenset[str]


@lru_cache(maxsize=50_000)
def within(outer: frozenset[str], tag: str, rest: str) -> frozenset[str]:
    """Feature names of what stands inside a tag with these attributes."""
    words = (w.lower() for m in NAMES.finditer(rest) for w in WORDS.findall(m[1] or m[2] or m[3] or ""))
    return outer | {f"in:{tag}"} | {f"is:{w}" for w in words}


def text_features(text: str, linked: int, tag: str) -> list[str]:
    n = len(text)
    share = linked / n
    out = [f"own:{tag}", f"size:{min(n.bit_length(), 10)}", f"links:{0 if not linked else 1 if share < 0.4 else 2}"]
    if text[-1] in ".!?:;\"'»”)":
        out.append("ends")
    if "©" in text:
        out.append("copyright")
    if text.count(". ") + text.count(", ") >= 2:
        out.append("prose")
    return out


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks of a page, in its order, with all their features."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = [("", frozenset())]
    counts: dict[str, int] = {}
    parts: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tag = next((t for t, _ in reversed(stack) if t not in INLINE), "")
                out.append(Block(text, stack[-1][1] | frozenset(text_features(text, min(linked, len(text)), tag))))
            parts.clear()
            linked = 0

    def pop_to(index: int) -> None:
        nonlocal links
        for tag, _ in stack[index:]:
            counts[tag] -= 1
            links -= tag == "a"
        del stack[index:]

    def leave_head() -> None:
        if counts.get("head"):
            pop_to(next(k for k, (t, _) in enumerate(stack) if t == "head"))

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            # each run by itself: a reference does not go on behind a tag
            piece = html.unescape(piece)
            if counts.get("head") and piece.strip():
                leave_head()
            parts.append(piece)
            linked += len(piece) if links else 0

    at = 0
    for m in TAG.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        if not m["tag"]:
            if m["hidden"] or m["drawn"]:
                parts.append(" ")
            continue
        tag = m["tag"].lower()
        if tag not in INLINE:
            flush()
        elif tag == "br":
            parts.append("\n")
        if m["end"]:
            if counts.get(tag):
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                pop_to(k)
            continue
        if tag in VOID:
            continue
        ends = CLOSES.get(tag, frozenset())
        if tag not in INLINE and counts.get("p"):
            ends = ends | {"p"}
        if ends and any(counts.get(t) for t in ends):
            # only up to the nearest container that keeps such a tag inside
            stop = SCOPE - {"td", "th"} if tag == "tr" else SCOPE
            k = len(stack) - 1
            found = 0
            while k and (stack[k][0] not in stop or stack[k][0] in ends):
                found = k if stack[k][0] in ends else found
                k -= 1
            if found:
                pop_to(found)
        if tag not in IN_HEAD:
            leave_head()
        rest = m["rest"] or ""
        if rest.endswith("/") and tag == "math":
            continue
        stack.append((tag, within(stack[-1][1], tag, rest if "=" in rest else "")))
        counts[tag] = counts.get(tag, 0) + 1
        links += tag == "a"
    add(page[at:])
    flush()
    return out


# Labelled layouts: M is a block of main text, H a headline of it, and X any
# other block (x a short one). Each says how one kind of page is built.
LAYOUTS = (
    "<nav><ul><li><a>x</a><li><a>x</a><li><a>x</a></ul></nav><div class=ad>X</div><article><h1>H</h1><p>M<p>M<p>M</article><footer>X</footer>",
    "<header><h1>x</h1><p>X</p></header><main><h1>H</h1><p>M</p><p>M</p><h2>H</h2><p>M</p></main><aside><h3>x</h3><p>X</p></aside><footer><p>X</p></footer>",
    "<div id=header><div class=logo>x</div><div class=menu><a>x</a> <a>x</a></div></div><div id=content><h1>H</h1><p>M</p><p>M</p></div><div id=sidebar><h3>x</h3><p>X</p><ul><li><a>x</a></li></ul></div><div id=footer>X</div>",
    "<div class='cookie-notice banner'><p>X</p><button>x</button></div><article class=post><header><h1>H</h1></header><div class=entry-content><p>M</p><blockquote>M</blockquote><ul><li>M</li><li>M</li></ul><p>M</p></div></article><section class=comments id=comments><h2>x</h2><div class=comment><p>X</p></div><div class=comment><p>X</p></div></section>",
    "<body><div class=topbar>x</div><div class='main article-body'><h1>H</h1><p>M</p><div class='ad advert advertisement'>X</div><p>M</p><div class=sponsored>X</div><p>M</p></div><div class='related recommended'><h4>x</h4><a>X</a></div></body>",
    "<article><h1>H</h1><p>M</p><aside class=pullquote>X</aside><p>M</p><form><label>x</label><p>X</p><button>x</button></form><p>M</p><div class=comments><p>X</p><p>X</p></div></article><div class='newsletter subscribe'><p>X</p></div>",
    "<table><tr><td class=nav><a>x</a><br><a>x</a></td><td class=content><h2>H</h2><p>M</p><p>M</p></td></tr></table><div class=copyright>X</div>",
    "<div role=navigation><a>x</a></div><div role=main><h1>H</h1><p>M</p><p>M</p></div><div role=complementary><p>X</p></div><div role=contentinfo>X</div>",
    "<div class=alert>X</div><div class=breadcrumb><a>x</a> <a>x</a></div><section class='story text'><h1>H</h1><p>M</p><pre>M</pre><p>M</p><table><tr><td>M</td><td>M</td></tr></table></section><div class='share social'><a>x</a></div><div class='tags meta'>x</div>",
    "<header class=site-header><p>X</p></header><nav class=menu><a>x</a></nav><div class=wrapper><div class=notice role=alert><p>X</p></div><article><h1>H</h1><div>M</div><div>M</div><h3>H</h3><div>M</div></article><aside id=sidebar class=widget><p>X</p><p>X</p></aside></div><div id=disqus_thread class='comment-list reader-comments responses'><ol><li><p>X</p></li><li><p>X</p></li></ol></div>",
    "<h1>H</h1><p>M</p><p>M</p><p>M</p><hr><p><a>x</a> <a>x</a></p>",
    "<p>M</p>",
    "<div>M</div><div>M</div><div class=footer>X</div>",
    "<div class=popup id=modal><p>X</p></div><article><h1>H</h1><figure><figcaption>M</figcaption></figure><p>M</p><p>M</p></article><form class=search action=q><p>X</p></form><div class='promo offer'><p>X</p></div><div class='disclaimer legal privacy'><p>X</p></div>",
    "<nav><p>X</p></nav><article><h1>H</h1><p>M</p><section class=comments><h2>x</h2><article class=comment><p>X</p></article><article class=comment><p>X</p></article></section></article><footer><p>X</p><nav><a>x</a></nav></footer>",
    "<div class=banner><p>X</p></div><main><article><h2>H</h2><p>M</p><dl><dt>M</dt><dd>M</dd></dl><ol><li>M<li>M</ol></article><aside><p>X</p></aside><div class=ads><p>X</p></div><div class='author bio'><p>X</p></div></main>",
    "<main><h1>H</h1><p>M</p><div class=ad-slot><p>X</p></div><p>M</p><p>M</p><div class='share tools'>x</div><p>M</p></main>",
    "<div id=main class=body><h1>H</h1><p>M</p><div class='promo box'><p>X</p></div><p>M</p><div class=notice>X</div><p>M</p><section class='user comments'><p>X</p><p>X</p></section></div>",
    "<main><section class=article-text><h1>H</h1><p>M</p><aside><p>X</p></aside><p>M</p><form><p>X</p></form><p>M</p></section><section class=comments-area><p>X</p></section></main>",
)
OUTSIDE = {"in:nav", "in:footer", "in:aside", "in:form", "is:ad", "is:ads", "is:comments", "is:comment"}
SLOT = re.compile(r"(?<=>)[MHXx](?=<|\Z)")
PLAIN = ("Plain words make a sentence, and more of them make another one. It ends here.", "A short line", "More")


def filled(layout: str, pool: list[str], turn: int) -> tuple[list[Block], list[int]]:
    """Blocks and labels of a layout with texts from the pool in its slots."""
    marks: list[str] = []

    def text(m: re.Match) -> str:
        nonlocal turn
        turn += 1
        marks.append(m[0])
        got = pool[(turn * 7919) % len(pool)]
        if m[0] in "xH":
            got = " ".join(got.split()[: 2 + turn % (3 if m[0] == "x" else 8)])
        return f"\x02{len(marks) - 1}\x03{html.escape(got)}"

    blocks, labels = [], []
    for b in blocks_of(SLOT.sub(text, layout)):
        slots = [int(k) for k in re.findall("\x02([0-9]+)\x03", b.text)]
        labels.append(int(any(marks[k] in "MH" for k in slots)))
        blocks.append(b)
    return blocks, labels


def labelled_pages(pages: list[str]) -> list[tuple[list[Block], list[int]]]:
    sample = [blocks_of(p) for p in pages]
    pool = [b.text for s in sample for b in s if len(b.text) > 2] or list(PLAIN)
    out = [filled(layout, pool, 31 * k + 997 * r) for k, layout in enumerate(LAYOUTS) for r in range(12)]
    for s in sample:
        if any("in:article" in b.names for b in s):
            out.append((s, [int("in:article" in b.names and not b.names & OUTSIDE) for b in s]))
    return [(b, y) for b, y in out if b]


@dataclass(frozen=True)
class Chain:
    """Score difference (main minus other) per feature and 2 x 2 label changes."""

    weights: dict[str, float]
    steps: np.ndarray
    first: float

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Viterbi."""
        if not blocks:
            return []
        get = self.weights.get
        gains = [sum(get(n, 0.0) for n in b.names) for b in blocks]
        (oo, om), (mo, mm) = self.steps.tolist()
        other, main = 0.0, gains[0] + self.first
        back = []
        for g in gains[1:]:
            from_main = (main + mo > other + oo, main + mm > other + om)
            back.append(from_main)
            other, main = max(main + mo, other + oo), max(main + mm, other + om) + g
        label = main > other
        labels = [label]
        for from_main in reversed(back):
            label = from_main[label]
            labels.append(label)
        return labels[::-1]


def train(examples: list[tuple[list[Block], list[int]]], steps: int = STEPS) -> Chain:
    """Gradient ascent on the ridge-penalised likelihood of the label chains."""
    names = sorted({n for blocks, _ in examples for b in blocks for n in b.names})
    index = {n: k for k, n in enumerate(names)}
    longest = max(len(y) for _, y in examples)
    x = np.zeros((len(examples), longest, len(names)), dtype=np.float32)
    y = np.zeros((len(examples), longest), dtype=np.int64)
    there = np.zeros((len(examples), longest))
    for i, (blocks, labels) in enumerate(examples):
        y[i, : len(labels)], there[i, : len(labels)] = labels, 1
        for t, b in enumerate(blocks):
            x[i, t, [index[n] for n in b.names]] = 1
    rows, gold, real = x.reshape(-1, len(names)), (y * there).reshape(-1), there.reshape(-1)
    pair = there[:, 1:, None, None] * np.eye(2)[y[:, :-1]][..., :, None] * np.eye(2)[y[:, 1:]][..., None, :]
    gold_pair, gold_first = pair.sum(axis=(0, 1)), y[:, 0].sum()
    w, move, first = np.zeros(len(names)), np.zeros((2, 2)), 0.0
    seen = [np.full(len(names), 1e-8), np.full((2, 2), 1e-8), 1e-8]
    for _ in range(steps):
        gain = (rows @ w).reshape(y.shape)
        main, moves, start = posterior(gain, move, first, there)
        slopes = (
            rows.T @ (gold - main.reshape(-1) * real) - 0.05 * w,
            gold_pair - moves - 0.05 * move,
            gold_first - start - 0.05 * first,
        )
        for k, s in enumerate(slopes):
            seen[k] = seen[k] + s * s
        w = w + 0.5 * slopes[0] / np.sqrt(seen[0])
        move = move + 0.5 * slopes[1] / np.sqrt(seen[1])
        first = first + 0.5 * slopes[2] / np.sqrt(seen[2])
    return Chain({n: float(v) for n, v in zip(names, w, strict=True)}, move, float(first))


def posterior(gain, move, first, there):
    """Chances of label 1 per block, expected label changes, expected first labels."""
    n, length = gain.shape
    ahead = np.zeros((n, length, 2))
    ahead[:, 0, 1] = gain[:, 0] + first
    for t in range(1, length):
        score = np.logaddexp.reduce(ahead[:, t - 1, :, None] + move, axis=1)
        score[:, 1] += gain[:, t]
        ahead[:, t] = np.where(there[:, t, None] > 0, score, ahead[:, t - 1])
    total = np.logaddexp.reduce(ahead[:, -1], axis=1)
    behind = np.zeros((n, length, 2))
    moves = np.zeros((2, 2))
    for t in range(length - 2, -1, -1):
        after = behind[:, t + 1] + np.stack([np.zeros(n), gain[:, t + 1]], axis=1)
        through = move + after[:, None, :]
        on = there[:, t + 1, None] > 0
        behind[:, t] = np.where(on, np.logaddexp.reduce(through, axis=2), behind[:, t + 1])
        chance = np.exp(ahead[:, t, :, None] + through - total[:, None, None])
        moves += (chance * on[..., None]).sum(axis=0)
    main = np.exp(ahead[..., 1] + behind[..., 1] - total[:, None])
    return main, moves, main[:, 0].sum()


def learn(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Chain:
    """A chain learned from the layouts and ``sample`` pages of at most
    ``SAMPLE_CHARS`` signs; only those reach the driver."""
    short = pages.where(F.length("html") <= SAMPLE_CHARS).select("page_id", "html")
    # ids first, so that scan tasks send ids and not pages; a repeated id counts once
    ids = short.where("page_id is not null").select("page_id").distinct()
    ids = ids.orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    one = short.join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))
    got = one.orderBy("page_id").collect()
    return train(labelled_pages([r.html for r in got]))


def main_text(chain: Chain, page: str) -> str:
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, main in zip(blocks, chain.decode(blocks), strict=True) if main)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    chain = learn(pages)

    def run(batches):
        for batch in batches:
            texts = [main_text(chain, h.decode("utf-8")) for h in utf8_values(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, type=pa.string()), pa.array(map(len, texts), type=pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
