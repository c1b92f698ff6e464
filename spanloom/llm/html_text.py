"""Main text of web pages: a recurrent block labeller.

A page is cut into its blocks, the runs of text between block-level tags. A block's vector is the sum of
learned vectors of its hashed tag path (tags, classes, ids and roles of the elements around it), the
mean of learned vectors of its hashed words, and a few measures. A bidirectional LSTM reads
the whole page's sequence, so every block is labelled in the context of the document, and the blocks
labelled main are the text. The label is read from the LSTM's states alone. While it learns, the paths of
some blocks, and of whole pages, are hidden at random, so that neighbours, words and measures must tell.

The pages carry no labels. The model learns from pages that ``specimens`` writes, with many wordings of
page furniture around and between the paragraphs, whose labels are known, and from a bounded
sample of real pages whose tags leave no doubt (inside article or main, or inside nav, footer and so on).
"""

from __future__ import annotations

import html as html_lib
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import nn
from spanloom.llm.common import fresh, table

#: Real pages that the model learns from, at most; pages written for it; passes.
SAMPLE, WRITTEN, EPOCHS = 150, 400, 8
#: Blocks of a real page, and words of a block, that are learned from.
LONGEST = 400
#: Share of blocks whose words are hidden while it learns, so that no single word outweighs what is around it.
WORDS_HIDDEN = 0.8
PATH_SLOTS, WORD_SLOTS, WIDTH, HIDDEN, MEASURES = 2048, 4096, 12, 12, 5

#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
#: Elements without an end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page. Without an end tag, script and style take the rest of the page, others nothing.
_RAW = frozenset("script style noscript template iframe svg textarea select object canvas title".split())
_TO_END = frozenset(["script", "style"])
#: What may stand in a head; anything else ends it.
_IN_HEAD = frozenset("head title base link meta script style noscript template object".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
#: An open p ends where one of these begins.
_ENDS_P = BLOCKS - {"html", "body", "head"}


def blocks(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """(path tokens, text, characters inside links) of every block with text, in page order."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, in_link, at, page = 0, 0, 0, page or ""
    path: tuple[str, ...] = ()

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append((path, text, linked))
            parts.clear()
        linked = 0

    def say(piece: str):
        nonlocal linked
        if piece:
            parts.append(piece)
            if in_link:
                linked += len(piece)

    in_head, endless = False, set()
    while m := _TOKEN.search(page, at):
        piece, at = page[at : m.start()], m.end()
        if in_head and piece.strip():
            in_head = False
        if not in_head:
            say(piece)
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in _RAW and not closing and not m[3].rstrip().endswith("/"):
            end = None if tag in endless else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            else:  # nor has any later one an end
                endless.add(tag)
                if tag in _TO_END:
                    at = len(page)
            continue
        if tag == "head" or tag not in _IN_HEAD:
            in_head = tag == "head" and not closing
        if in_head:
            continue
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if k is not None and not (tag not in BLOCKS and any(s[0] in BLOCKS for s in stack[k + 1 :])):
                del stack[k:]
        else:
            if tag in _ENDS_P and stack and any(s[0] == "p" for s in stack):
                k = max(i for i in range(len(stack)) if stack[i][0] == "p")
                if all(s[0] not in BLOCKS for s in stack[k + 1 :]):
                    del stack[k:]
            if tag not in VOID and not m[3].rstrip().endswith("/"):
                names = (tag,)
                for a in _ATTR.finditer(m[3]):
                    names += tuple(f".{w}" for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", a[2]).lower()))
                stack.append((tag, names))
        in_link = sum(s[0] == "a" for s in stack)
        if tag in BLOCKS:
            path = tuple(w for _, names in stack for w in names)
    say(page[at:])
    flush()
    return out


def vectors(found: list[tuple[tuple[str, ...], str, int]]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Slots of path tokens and of words, and measures, for each block."""
    paths, words, nums = [], [], np.zeros((len(found), MEASURES), np.float32)
    for i, (path, text, linked) in enumerate(found):
        paths.append(np.array(sorted({zlib.crc32(w.encode()) % PATH_SLOTS for w in path if w not in ("html", "body")}) or [0]))
        ws = text.lower().split()
        words.append(np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_SLOTS for w in ws] or [0]))
        nums[i] = (np.log1p(len(ws)) / 4, linked / max(1, len(text)), (text[-1:] in ".!?") * 1.0, i / max(1, len(found)), ("©" in text) * 1.0)
    return paths, words, nums


def _bag(tab, slots: list[np.ndarray], mean: bool):
    return nn.bag(tab, np.concatenate(slots), np.array([len(s) for s in slots]), mean)


def forward(p: dict, pages: list[tuple]):
    """Logits of all blocks of the pages, one page after the other."""
    lens = [len(x[0]) for x in pages]
    x = nn.concat(
        [_bag(p["path"], [s for q in pages for s in q[0]], False), _bag(p["word"], [s for q in pages for s in q[1]], True), np.concatenate([q[2] for q in pages])]
    )
    steps, b = max(lens), len(pages)
    at = np.concatenate([np.arange(n) * b + k for k, n in enumerate(lens)])  # time first
    back_at = np.full(steps * b, len(at))
    back_at[at] = np.arange(len(at))
    mask = (back_at < len(at)).astype(np.float32).reshape(steps, b, 1)
    both = []
    for d in ("f", "b"):
        z = nn.add(nn.matmul(x, p["x" + d]), p["b" + d])
        z = nn.concat([z, np.zeros((1, 4 * HIDDEN), np.float32)], 0)
        z = nn.reshape(nn.take(z, back_at), steps, b, 4 * HIDDEN)
        both.append(nn.reshape(nn.lstm(z, p["h" + d], HIDDEN, mask, d == "b"), steps * b, HIDDEN))
    h = nn.take(nn.concat(both), at)
    return nn.reshape(nn.add(nn.matmul(h, p["out"]), p["bias"]), len(at))


def hide(rng: np.random.Generator, page: tuple, paths: float, words: float = 0.0) -> tuple:
    """The page with the paths of about that share of its blocks hidden, and the words of about that share."""
    gone = lambda of, share: [np.zeros(1, int) if g else s for s, g in zip(of, rng.random(len(of)) < share)]
    return gone(page[0], paths), gone(page[1], words), page[2]


#: Words of page furniture, for the pages written to learn from.
_OFF = {
    "nav": "menu navigation nav navbar topnav breadcrumbs links tabs toc pagination pager".split(),
    "header": "header masthead banner topbar branding logo sitehead".split(),
    "footer": "footer copyright colophon bottom legal sitefoot credits".split(),
    "aside": "sidebar aside widget related rail recommended trending popular secondary".split(),
    "notice": "cookie consent notice alert gdpr newsletter subscribe popup modal toast message paywall".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo adsense banner".split(),
    "form": "form search login signup contact feedback".split(),
    "comments": "comments comment discussion replies reply reader responses disqus".split(),
    "share": "share social tags meta byline buttons author".split(),
}
_ON = "content post entry story article body text main page copy prose".split()


def specimens(n: int, seed: int = 5) -> list[tuple[list, np.ndarray]]:
    """Pages with known labels: furniture before, after and between the paragraphs of a main part."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    word = lambda: "".join(pick("abcdefghijklmnopqrstuvwxyzéäñ") for _ in range(int(rng.integers(2, 9))))

    def says(low, high):
        s = " ".join(word() for _ in range(int(rng.integers(low, high + 1))))
        return s.capitalize() + pick(["." if high > 12 else "", ".", ""])

    def off():
        kind = pick(list(_OFF))
        name = pick(_OFF[kind])
        tag = kind if kind in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.6 else pick(["div", "section", "div", "aside", "ul"])
        attr = "" if tag == kind and rng.random() < 0.6 else f' {pick(["class", "id"])}="{pick(["", "site-", "page-", "box ", "main-", "content-"])}{name}"'
        if rng.random() < 0.4:
            inside = "<ul>" + "".join(f'<li><a href="#">{says(1, 3)}</a></li>' for _ in range(int(rng.integers(2, 8)))) + "</ul>"
        elif kind in ("comments", "notice", "aside", "ad", "footer", "header") and rng.random() < 0.7:
            inside = "".join(f"<{t}>{says(4, 40)}</{t}>" for t in [pick(["p", "div", "p", "h3", "span"]) for _ in range(int(rng.integers(1, 5)))])
        else:
            inside = says(1, 12)
        return f"<{tag}{attr}>{inside}</{tag}>"

    out = []
    for _ in range(n):
        paras = "".join(
            (f"<{t}>MAIN {says(1, 90)}</{t}>" if rng.random() < 0.85 else f"<p><b>MAIN {says(1, 60)}<br>") + (off() if rng.random() < 0.06 else "")
            for t in [pick(["p", "p", "p", "p", "p", "h2", "blockquote", "li", "div"]) for _ in range(int(rng.integers(1, 25)))]
        )
        head = f"<h1>MAIN {says(1, 12)}</h1>" if rng.random() < 0.8 else ""
        kind = rng.random()
        open_, close = ("<article>", "</article>") if kind < 0.45 else ("<main>", "</main>") if kind < 0.6 else (f'<div class="{pick(["", "post-", "article-", "entry-"])}{pick(_ON)}">', "</div>") if kind < 0.9 else ("", "")
        page = "<html><body>" + "".join(off() for _ in range(int(rng.integers(0, 4)))) + open_ + head + paras + close + "".join(off() for _ in range(int(rng.integers(0, 4)))) + "</body></html>"
        found = blocks(page)
        out.append(([(p, t.removeprefix("MAIN "), k) for p, t, k in found], np.array([t.startswith("MAIN ") for _, t, _ in found], np.float32)))
    return out


_SURE_OFF = {"nav", "footer", "header", "aside", "form", ".ad", ".ads", ".advert", ".comments", ".comment", ".sidebar", ".cookie"}


def plain_labels(found: list) -> np.ndarray | None:
    """Labels where tags leave no doubt about any block of a page, else None."""
    y = np.zeros(len(found), np.float32)
    for i, (path, _, _) in enumerate(found):
        inside, off = {"article", "main"} & set(path), _SURE_OFF & set(path)
        if bool(inside) == bool(off):
            return None
        y[i] = bool(inside)
    return y


def sure(page: str | None) -> tuple | None:
    """Vectors and labels of a page whose tags leave no doubt; of a long one, LONGEST blocks from a place that its bytes choose,
    each with at most LONGEST words, evenly spaced."""
    found = blocks(page)
    y = plain_labels(found) if found else None
    if y is None:
        return None
    paths, words, nums = vectors(found)
    at = zlib.crc32(page.encode("utf-8", "surrogatepass")) % max(1, len(found) - LONGEST + 1)
    few = lambda w: w[np.unique(np.linspace(0, len(w) - 1, LONGEST).astype(int))] if len(w) > LONGEST else w
    cut = slice(at, at + LONGEST)
    return (paths[cut], [few(w) for w in words[cut]], nums[cut]), y[cut]


def train(real: list[tuple], seed: int = 11) -> dict[str, np.ndarray]:
    """From specimens and from what ``sure`` makes of real pages."""
    rng = np.random.default_rng(seed)
    data = [(vectors(f), y) for f, y in specimens(WRITTEN) if f] + real
    wide = 2 * WIDTH + MEASURES
    p = nn.init(
        rng, path=(PATH_SLOTS, WIDTH), word=(WORD_SLOTS, WIDTH), xf=(wide, 4 * HIDDEN), xb=(wide, 4 * HIDDEN), hf=(HIDDEN, 4 * HIDDEN), hb=(HIDDEN, 4 * HIDDEN),
        bf=(4 * HIDDEN,), bb=(4 * HIDDEN,), out=(2 * HIDDEN, 1), bias=(1,),
    )
    p["word"] *= 0.1
    adam = nn.Adam(p, 0.01)
    order = np.arange(len(data))
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for i in range(0, len(order), 24):
            batch = [data[k] for k in order[i : i + 24]]
            y = np.concatenate([b[1] for b in batch])
            seen = [hide(rng, b[0], max(0.0, 2 * rng.random() - 1), WORDS_HIDDEN) for b in batch]  # the paths of half of the pages are whole
            adam.step(lambda live: nn.bce(forward(live, seen), y, np.ones(len(y))))
    return adam.p


def texts(p: dict, pages: list[str | None]) -> list[str]:
    found = [blocks(x) for x in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if found[i]), key=lambda i: len(found[i]))
    for k in range(0, len(order), 64):
        part = order[k : k + 64]
        logits = forward(p, [vectors(found[i]) for i in part])
        at = 0
        for i in part:
            n = len(found[i])
            out[i] = "\n".join(t for (_, t, _), z in zip(found[i], logits[at : at + n]) if z > 0)
            at += n
    return out


def extract(spark: SparkSession, pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    A null, empty or text-free page gives an empty text; repeated rows get equal texts; an empty table gives no
    rows; other columns are ignored. Learns from at most ``sample`` pages, the first by a hash of page_id.
    """
    ids = pages.where("page_id IS NOT NULL").select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample).distinct().collect()
    name = fresh("id")
    ids = spark.createDataFrame([(r[0],) for r in ids], pages.select(F.col("page_id").alias(name)).schema)

    def learn(batches):
        for b in batches:
            got = [pickle.dumps(x) for x in map(sure, b.column("html").to_pylist()) if x]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary())], ["made"])

    rows = pages.join(F.broadcast(ids), F.col("page_id") == F.col(name)).select("html").mapInArrow(learn, "made binary").collect()
    p = train([pickle.loads(r[0]) for r in sorted(rows)])

    def run(batches):
        for b in batches:
            got = texts(p, b.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages"))
