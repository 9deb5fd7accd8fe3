"""Main text of HTML pages by a recurrent block labeller (operator 13).

A page is a sequence of leaf blocks (`page_blocks`). Each block is read as a vector: the sum of embeddings of its hashed tag-path
tokens, the mean of embeddings of its hashed words, and a few figures (length, links, punctuation, place). A bidirectional LSTM
in numpy reads the whole sequence in both directions, so every block is labelled in the light of all the others;
blocks with a probability of 0.5 and more are the main text.

Learning: a bounded sample of pages (LEARNING_PAGES pages with at most LEARNING_CHARS characters, those with the smallest hashes
of their url) that mark their article with `article`, `main` or `role=main`. Their blocks are labelled by these elements, without what lies
in `nav`, `aside`, `footer`, `form` and parts named as such inside. From their texts further pages are composed in other layouts: containers with
usual names or none, and sidebars, notices, forms, comments and the like from phrases or from the texts of other pages, so that
names, context and shape decide and not one site's elements. Words are left out at random while learning. The fit starts from a fixed
seed. Without usable pages, composed ones of filler words teach alone.

Everything but the fit works on all pages and whole pages; the network is broadcast (some 600 kB). Nothing is shuffled.

Defined cases: a null or empty page has an empty text, as has a page without main blocks; damaged markup is read as `page_blocks` says;
text without any element is one block; repeated rows give the same text; extra columns are left behind; an empty table
gives an empty table.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import chunks_by_size, written
from salesloom.llm.page_blocks import INLINE, Block, blocks

LEARNING_PAGES = 150
LEARNING_CHARS = 60_000
COMPOSED_PAGES = 450
PATH_BUCKETS, WORD_BUCKETS = 4096, 4096
PATH_SIZE, WORD_SIZE, FIGURES, HIDDEN = 24, 12, 6, 20
SIZE = PATH_SIZE + WORD_SIZE + FIGURES
EPOCHS, BATCH, RATE = 8, 12, 0.01
WORDS_LEFT_OUT, PATHS_LEFT_OUT = 0.5, 0.1
# Padded cells of the network at once.
CELLS = 60_000

_WORD = re.compile(r"[^\W_]+|[©&@:]")
_STOPS = re.compile(r"[.!?;:,。！？]")

# Layouts of composed pages. Each entry is a path of elements; an element is its tag and its name words.
MAIN = (
    "article", "main", "main article", "div.article", "div.content", "div.post div.entry-content", "section.story", "div.main-content", "div",
    "div div", "div.page div.text", "div.container div.row div.col", "td", "section", "div.body-text", "article div.article-body", "main div.wrapper", "",
    "div.wrapper div.post-body", "div.blog-post", "div.news-item", "div.page-wrap main",
)
PARAGRAPHS = ("p", "p", "p", "p", "p", "div", "li", "ul li", "ol li", "blockquote p", "pre", "h2", "h3", "figure figcaption", "table tr td", "span", "dl dd")
LINKS = ("ul li a", "a", "li a", "div a", "p a", "span a", "ol li a", "h3 a")
LINES = ("p", "div", "span", "li", "h3", "p", "label", "small")
# Kinds of other parts: their containers, and whether they hold links.
PARTS = {
    "menu": ("nav|div.menu|div.navbar|ul.nav|div.navigation|header nav|div.breadcrumb|ol.breadcrumbs|div.topnav|div.main-menu|nav.site-nav|div.toolbar|table tr td.menu|table tr td.nav|td.left", 1.0),
    "header": ("header|div.header|div.masthead|div.site-header|div.banner|header.page-header|div.logo|div.top", 0.4),
    "footer": ("footer|div.footer|div.site-footer|footer.copyright|div.bottom|div.legal|div.colophon|address", 0.4),
    "sidebar": ("aside|div.sidebar|aside.widget|div.related|div.widget|div.recommended|div.popular|div.tags|section.more|div.rail|ul.sidebar|div.share|table tr td.right|td.sidebar", 0.7),
    "notice": ("div.notice|div.cookie|div.cookie-notice|div.alert|div.consent|div.gdpr-banner|div.message|aside.notice|div.popup|div.modal|div.warning|dialog", 0.1),
    "advert": ("div.ad|div.ads|div.advert|div.advertisement|div.sponsored|aside.ad|div.promo|ins.adsbygoogle|div.banner-ad|section.sponsor|div.ad-slot", 0.3),
    "form": ("form|form.search|form.login|div.newsletter form|div.subscribe|div.signup form|form.contact|fieldset|div.search form|div.poll form", 0.0),
    "comments": ("section.comments div.comment|div.comments|div.comment-list|ol.commentlist li.comment|div.comments div.reply|div.disqus-thread|div.reader-comments|ul.comments li|section.responses div.response|div.discussion", 0.1),
}
# Fixed phrases, four languages each.
PHRASES = {
    "menu": "Home|About us|Contact|News|Products|Login|Startseite|Über uns|Kontakt|Accueil|À propos|Inicio|Acerca de|Sitemap|Archive|Blog",
    "header": "Welcome|Search|The daily paper|Menu|Willkommen|Bienvenue|Bienvenido|Skip to content|Sign in|Subscribe",
    "footer": "© 2024 All rights reserved|Copyright|Privacy policy|Terms of use|Impressum|Datenschutz|Mentions légales|Aviso legal|Powered by|Back to top",
    "sidebar": "Related articles|Most read|Popular posts|Share this|Tags|Verwandte Artikel|Articles liés|Artículos relacionados|Archives|Categories|Read more",
    "notice": "This site uses cookies. Accept|We use cookies to improve your experience|Diese Website verwendet Cookies|Ce site utilise des cookies|Este sitio utiliza cookies|Please enable JavaScript|Your session has expired",
    "advert": "Advertisement|Sponsored|Anzeige|Publicité|Publicidad|Buy now|Special offer: 50 % off|Order today|Ad",
    "form": "Name|Email|Your email address|Search|Password|Subscribe to our newsletter|Anmelden|S'inscrire|Suscribirse|Leave a reply|Message|Submit",
    "comments": "Reply|Great article, thanks!|I do not agree with this.|posted by anna on Monday|3 comments|Kommentare|Commentaires|Comentarios|says:|Like|Report",
}
_BEFORE, _BEHIND = ("header", "menu", "notice", "advert", "form", "sidebar"), ("comments", "sidebar", "form", "advert", "menu", "footer", "notice")
_FILLER = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt ut labore et dolore magna aliquyam erat".split()

_MAIN_WORDS = frozenset(("article", "main"))
_OTHER_WORDS = frozenset(
    "nav menu navigation aside sidebar footer form ad ads advert advertisement sponsored promo comment comments notice cookie related share newsletter".split()
)


def rule_label(block: Block) -> int | None:
    """1 for a block of the page's marked article, 0 for another one of such a page, by element names; None where nothing is marked."""
    marked = None
    for tag, *names in block.path:
        if tag in _MAIN_WORDS or ("main" in names and tag == "div" and len(names) == 1):
            marked = 1
        elif marked and (tag in _OTHER_WORDS or _OTHER_WORDS.intersection(names)):
            return 0
    return marked


def path_tokens(path: tuple[tuple[str, ...], ...]) -> list[int]:
    """Hashed tokens of a path: all names of all elements, and those of the two innermost block elements with their depth from the block."""
    found: list[str] = []
    near = 0
    for element in reversed(path):
        inline = element[0] in INLINE
        for k, word in enumerate(element):
            kind = "." if k else "<"
            found.append(kind + word)
            if k and len(word) > 5:
                found += [f"^{word[:5]}", f"${word[-4:]}"]
            if near < 2 and not inline:
                found.append(f"{near}{kind}{word}")
        near += not inline
    # An article's own parts differ from those of the page around it.
    tags = [e[0] for e in path]
    for outer in ("article", "main"):
        if outer in tags:
            found += [f"{outer}>{w}" for e in path[tags.index(outer) + 1 :] for w in e]
    return [zlib.crc32(t.encode()) % PATH_BUCKETS for t in dict.fromkeys(found)]


def figures(block: Block) -> tuple[float, ...]:
    text = block.text
    stops = len(_STOPS.findall(text))
    return (
        min(len(text), 1000) ** 0.5 / 16,
        min(block.linked / (len(text) + 1), 1.0),
        min(stops, 12) / 12,
        float(text[-1:] in ".!?…。\"”»"),
        float(len(text) < 25),
        min(len(block.path), 12) / 12,
    )


@dataclass
class Encoded:
    """Blocks of some pages side by side: hashed path and word tokens (ragged), figures, and the size of each page."""

    paths: list[list[int]]
    words: list[list[int]]
    figures: np.ndarray
    sizes: np.ndarray


def encoded(pages: Sequence[Sequence[Block]], memory: dict) -> Encoded:
    paths, words, numbers = [], [], []
    for page in pages:
        for block in page:
            tokens = memory.get(block.path)
            if tokens is None:
                tokens = memory[block.path] = path_tokens(block.path)
            paths.append(tokens)
            words.append([_bucket(w, memory) for w in _WORD.findall(block.text.lower())])
            numbers.append(figures(block))
    return Encoded(paths, words, np.array(numbers, np.float32).reshape(-1, FIGURES), np.array([len(p) for p in pages], np.int64))


def _bucket(word: str, memory: dict) -> int:
    found = memory.get(word)
    if found is None:
        found = memory[word] = zlib.crc32(word.encode()) % WORD_BUCKETS
    return found


def _sums(table: np.ndarray, tokens: list[list[int]], mean: bool) -> np.ndarray:
    """Sum or mean of the embeddings of each token list."""
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    out = np.zeros((len(tokens), table.shape[1]), np.float32)
    filled = np.flatnonzero(sizes)
    if len(filled):
        flat = np.fromiter((t for ts in tokens for t in ts), np.int64, int(sizes.sum()))
        starts = (np.cumsum(sizes) - sizes)[filled]
        out[filled] = np.add.reduceat(table[flat], starts, axis=0)
    if mean:
        out /= np.maximum(sizes, 1)[:, None]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _places(sizes: np.ndarray, backward: bool) -> np.ndarray:
    """Row of the flat table that each page reads at each step (steps x pages); rows behind the end are the row of zeros."""
    total, longest = int(sizes.sum()), int(sizes.max(initial=0))
    starts = np.cumsum(sizes) - sizes
    step = np.arange(longest)[:, None]
    place = starts + (sizes - 1 - step if backward else step)
    return np.where(step < sizes, place, total)


def _run(x: np.ndarray, sizes: np.ndarray, weights: tuple[np.ndarray, ...], backward: bool, keep: bool = False):
    """One direction of the network over all pages at once: hidden states of every block."""
    w, u, b = weights
    places = _places(sizes, backward)
    gates_in = np.vstack([x @ w + b, np.zeros((1, w.shape[1]), np.float32)])
    hidden = np.zeros((len(x) + 1, HIDDEN), np.float32)
    h = np.zeros((len(sizes), HIDDEN), np.float32)
    c = np.zeros_like(h)
    kept = []
    for place in places:
        z = gates_in[place] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, c = c, f * c + i * g
        t = np.tanh(c)
        if keep:
            kept.append((place, i, f, o, g, before, t, h))
        h = o * t
        hidden[place] = h
    hidden[-1] = 0
    return hidden[:-1], kept


def _back(x: np.ndarray, weights: tuple[np.ndarray, ...], kept: list, d_hidden: np.ndarray):
    """Gradients of one direction: of its input and of its weights."""
    w, u, _ = weights
    n = len(x)
    d_hidden = np.vstack([d_hidden, np.zeros((1, HIDDEN), np.float32)])
    d_gates = np.zeros((n + 1, 4 * HIDDEN), np.float32)
    d_u = np.zeros_like(u)
    dh = dc = 0.0
    for place, i, f, o, g, before, t, h in reversed(kept):
        live = (place < n)[:, None]
        dh = dh + d_hidden[place]
        do = dh * t
        dc = dc + dh * o * (1 - t * t)
        z = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), do * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        z = np.where(live, z, 0)
        d_gates[place] = z
        d_u += h.T @ z
        dh, dc = z @ u.T, np.where(live, dc * f, 0)
    d_gates = d_gates[:-1]
    return d_gates @ w.T, (x.T @ d_gates, d_u, d_gates.sum(0))


@dataclass
class Labeller:
    """Embeddings and weights of both directions and of the last layer."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 13) -> Labeller:
        chance = np.random.default_rng(seed)
        shapes = {"path": (PATH_BUCKETS, PATH_SIZE), "word": (WORD_BUCKETS, WORD_SIZE), "out": (2 * HIDDEN + SIZE, 1), "out_b": (1,)}
        for side in ("f", "b"):
            shapes |= {f"{side}_w": (SIZE, 4 * HIDDEN), f"{side}_u": (HIDDEN, 4 * HIDDEN), f"{side}_b": (4 * HIDDEN,)}
        scale = {"path": 0.2, "word": 0.1}
        weights = {
            name: np.zeros(shape, np.float32)
            if len(shape) == 1
            else chance.normal(0, scale.get(name, shape[0] ** -0.5), shape).astype(np.float32)
            for name, shape in shapes.items()
        }
        for side in ("f", "b"):
            weights[f"{side}_b"][HIDDEN : 2 * HIDDEN] = 1.0
        return Labeller(weights)

    def side(self, name: str) -> tuple[np.ndarray, ...]:
        return tuple(self.weights[f"{name}_{k}"] for k in "wub")

    def vectors(self, page: Encoded) -> np.ndarray:
        return np.hstack([_sums(self.weights["path"], page.paths, False), _sums(self.weights["word"], page.words, True), page.figures])

    def logits(self, page: Encoded) -> np.ndarray:
        x = self.vectors(page)
        parts = [_run(x, page.sizes, self.side(s), s == "b")[0] for s in ("f", "b")]
        return np.hstack([*parts, x]) @ self.weights["out"][:, 0] + self.weights["out_b"][0]

    def gradients(self, page: Encoded, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy of all blocks."""
        x = self.vectors(page)
        runs = {s: _run(x, page.sizes, self.side(s), s == "b", keep=True) for s in ("f", "b")}
        top = np.hstack([runs["f"][0], runs["b"][0], x])
        p = _sigmoid(top @ self.weights["out"][:, 0] + self.weights["out_b"][0])
        dz = ((p - labels) / len(labels)).astype(np.float32)
        found = {"out": (top.T @ dz)[:, None], "out_b": np.array([dz.sum()])}
        d_top = dz[:, None] * self.weights["out"][:, 0]
        dx = d_top[:, 2 * HIDDEN :].copy()
        for k, s in enumerate(("f", "b")):
            more, sides = _back(x, self.side(s), runs[s][1], d_top[:, k * HIDDEN : (k + 1) * HIDDEN])
            dx += more
            found |= dict(zip((f"{s}_w", f"{s}_u", f"{s}_b"), sides))
        for name, tokens, begin, size in (("path", page.paths, 0, PATH_SIZE), ("word", page.words, PATH_SIZE, WORD_SIZE)):
            counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
            d = dx[:, begin : begin + size]
            if name == "word":
                d = d / np.maximum(counts, 1)[:, None]
            table = np.zeros_like(self.weights[name])
            flat = np.fromiter((t for ts in tokens for t in ts), np.int64, int(counts.sum()))
            np.add.at(table, flat, np.repeat(d, counts, axis=0))
            found[name] = table
        return found


def composed(texts: Sequence[Sequence[str]], chance: random.Random) -> list[tuple[Block, int]]:
    """A page in some layout: the main text of one learning page between parts of other kinds."""

    def elements(spec: str) -> tuple[tuple[str, ...], ...]:
        return tuple(tuple(re.split(r"[.-]", e)) for e in spec.split())

    def words(n: int) -> str:
        text = " ".join(chance.choice(_FILLER) for _ in range(n)).capitalize()
        return text + chance.choice((".", ".", "", "!"))

    def some_text() -> str:
        if texts and chance.random() < 0.8:
            pool = chance.choice(texts)
            sentence = chance.choice(chance.choice(pool).split(". ") if pool else [words(8)])
            return sentence if sentence.strip() else words(6)
        return words(chance.randrange(1, 25))

    def part(kind: str, around: tuple[tuple[str, ...], ...]) -> list[tuple[Block, int]]:
        containers, linked = PARTS[kind]
        inside = around + elements(chance.choice(containers.split("|")))
        rows = []
        if linked >= 0.4 and chance.random() < 0.15:  # several links in one block
            names = chance.sample(PHRASES[kind].split("|"), chance.randrange(2, 6))
            text = chance.choice((" ", " | ", " · ")).join(names)
            return [(Block(inside + elements(chance.choice(LINKS)), text, sum(map(len, names))), 0)]
        for _ in range(chance.randrange(1, {"menu": 9, "comments": 7, "sidebar": 8}.get(kind, 4))):
            is_link = chance.random() < linked
            if chance.random() < 0.4:
                text = chance.choice(PHRASES[kind].split("|"))
            elif is_link or kind in ("form", "menu"):
                text = " ".join(some_text().split()[: chance.randrange(1, 6)]) or "x"
            else:
                text = some_text()
            path = inside + elements(chance.choice(LINKS if is_link else LINES))
            rows.append((Block(path, text, len(text) if is_link else 0), 0))
        return rows

    frame = elements(chance.choice(("html body", "html body div", "html body div.page", "html body div.wrapper", "body", "html body div.container")))
    main = frame + elements(chance.choice(MAIN))
    own = list(chance.choice(texts)) if texts and chance.random() < 0.8 else [words(chance.randrange(5, 60)) for _ in range(chance.randrange(1, 12))]
    if chance.random() < 0.3:
        own = own[: chance.randrange(1, len(own) + 1)]
    rows = []
    for kind in _BEFORE:
        if chance.random() < 0.4:
            rows += part(kind, frame)
    # The title may have a header of its own inside the article.
    title = main + (elements("header") if any(e[0] == "article" for e in main) and chance.random() < 0.3 else ()) + elements(chance.choice(("h1", "h1", "h2", "p")))
    body = [(Block(title, own[0][:120], 0), 1)] if chance.random() < 0.9 else []
    for text in own:
        path = main + elements(chance.choice(PARAGRAPHS) if chance.random() < 0.4 else "p")
        if chance.random() < 0.1:
            text = " ".join(text.split()[: chance.randrange(1, 8)]) or text
        linked = int(len(text) * chance.random() * 0.6) if chance.random() < 0.15 else 0
        body.append((Block(path, text, linked), 1))
        if chance.random() < 0.04:
            body += part(chance.choice(("advert", "sidebar", "notice", "form")), main)
    if chance.random() < 0.15:
        body += part(chance.choice(("comments", "sidebar", "menu", "form")), main)
    rows += body
    for kind in _BEHIND:
        if chance.random() < 0.4:
            rows += part(kind, frame)
    return rows


def fitted(pages: Sequence[Sequence[tuple[Block, int]]], seed: int = 13) -> Labeller:
    """Fit on labelled pages by Adam steps with a falling rate."""
    chance = random.Random(seed)
    model, memory = Labeller.fresh(seed), {}
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    ready = [(encoded([[b for b, _ in page]], memory), np.array([y for _, y in page], np.float32)) for page in pages if page]
    steps = EPOCHS * -(-len(ready) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        chance.shuffle(ready)
        for begin in range(0, len(ready), BATCH):
            batch = ready[begin : begin + BATCH]
            paths = [[t for t in ts if chance.random() >= PATHS_LEFT_OUT] for e, _ in batch for ts in e.paths]
            words = [[] if chance.random() < WORDS_LEFT_OUT else ts for e, _ in batch for ts in e.words]
            joined = Encoded(paths, words, np.vstack([e.figures for e, _ in batch]), np.concatenate([e.sizes for e, _ in batch]))
            found = model.gradients(joined, np.concatenate([y for _, y in batch]))
            step += 1
            rate = RATE * (1 - (step - 1) / steps) + 1e-4
            for name, d in found.items():
                d = np.clip(d, -1, 1)
                first[name] += 0.1 * (d - first[name])
                second[name] += 0.01 * (d * d - second[name])
                change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
                model.weights[name] -= (rate * change).astype(np.float32)
    return model


def labelled_pages(pages: DataFrame, key: Column) -> list[list[tuple[Block, int]]]:
    """Blocks of the learning pages with their labels; key orders the pages of the sample (smallest hash first)."""
    marked = F.col("html").rlike(r"(?i)<(article|main)[\s>]|role\s*=\s*[\"']?main")
    usable = pages.filter(F.length("html").between(1, LEARNING_CHARS)).filter(marked)
    prints = usable.select(F.xxhash64(key).alias("hash"), F.xxhash64("html").alias("print"), "html")
    # The hashes are chosen first: sorting whole pages would send as many of each task to the driver.
    least = prints.groupBy("hash").agg(F.min("print").alias("print")).orderBy("hash").limit(LEARNING_PAGES)
    least = written(least, "learning-pages")
    chosen = prints.join(F.broadcast(least), ["hash", "print"]).groupBy("hash", "print").agg(F.first("html").alias("html")).orderBy("hash")
    found = []
    for row in chosen.collect():
        page = blocks(row["html"])
        labels = [rule_label(b) for b in page]
        if 1 in labels:
            found.append([(b, int(label or 0)) for b, label in zip(page, labels)])
    return found


def learn(pages: DataFrame, key: Column) -> Labeller:
    """Fit on a bounded sample of pages (column html) and on pages composed of their texts."""
    given = labelled_pages(pages, key)
    texts = [[b.text for b, label in page if label] for page in given]
    chance = random.Random(7)
    return fitted(given + [composed(texts, chance) for _ in range(COMPOSED_PAGES)])


def chosen_texts(model: Labeller, pages: Sequence[Sequence[Block]], memory: dict) -> list[str]:
    """The blocks of each page that the network takes for main text, joined by an empty line."""
    out = [""] * len(pages)
    # Pages of like length side by side, so that little is padded.
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    most = 0
    groups: list[list[int]] = []
    for k in order:
        most = len(pages[k])
        if not groups or most * (len(groups[-1]) + 1) > CELLS:
            groups.append([])
        groups[-1].append(k)
    for group in groups:
        logits = model.logits(encoded([pages[k] for k in group], memory))
        begin = 0
        for k in group:
            own = logits[begin : begin + len(pages[k])]
            begin += len(pages[k])
            out[k] = "\n\n".join(b.text for b, z in zip(pages[k], own.tolist()) if z >= 0)
    return out


def main_text(spark: SparkSession, model: Labeller, page: Column) -> Column:
    """Main text of an HTML column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory: dict = {}
        for batch in batches:
            pages = batch.to_pylist()
            out: list[str] = []
            for part in chunks_by_size([len(p) for p in pages], 4_000_000):
                if len(memory) > 300_000:
                    memory.clear()
                out += chosen_texts(shared.value, [blocks(p) for p in pages[part]], memory)
            yield pa.array(out, pa.string())

    return extract(F.coalesce(page, F.lit("")))


def extracted(pages: DataFrame, model: Labeller) -> DataFrame:
    """page_id, url, text and n_chars of every page (columns page_id, url, html)."""
    found = pages.select("page_id", "url", main_text(pages.sparkSession, model, F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
