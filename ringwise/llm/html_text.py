"""HTML extraction: a recurrent labeller of text blocks.

A page becomes the sequence of its leaf blocks: stretches of text between block-level tags, with
the path of open elements (names, classes, ids, roles). Each block is a vector: hashed path parts,
hashed words, and a few figures (length, share of link text, place). A bidirectional LSTM in numpy
reads the whole page's sequence in both directions and labels every block as main text or not.
Main blocks are joined in page order by ``separator``: a line feed, and two in the registered query.

The network is trained where it is used, on a sample of ``sample_pages`` distinct pages with blocks
(parameters), labelled by the names of their containers: inside an article or main part and outside
of what ``ASIDE`` names. Of a page whose blocks hold more than ``sample_bytes`` bytes, or are more
than ``SAMPLE_BLOCKS``, the sample has the first and last ones. As sites name things differently, sample
pages are also seen with other containers for the main part and with blocks of other kinds put in,
whose text is drawn from the sample, and with random names or none on all containers, so that the figures, the words
and the order of blocks have to tell where names say nothing. Training is seeded, and runs in some seconds on the driver.

Defined cases: a null page is empty and gives an empty text; scripts, styles and comments of the
markup are never blocks; unclosed or crossing tags close with their parents; character references
are decoded; white space (Unicode) becomes one space, also at ``br``; equal pages give equal texts;
an empty table gives no rows, and nothing is learned from one, nor where no page has a block; input
columns named like those that the operator adds are replaced.
"""

from __future__ import annotations

import heapq
import html as html_lib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringwise.llm.common import others

ADDED = ("text", "n_chars")
PATH, WORDS, FIGURES = 160, 16, 6
INPUTS = PATH + WORDS + FIGURES
HIDDEN = 16
#: Blocks of a sample page: with those put in, a page stays within the 200 that a round takes.
SAMPLE_BLOCKS = 180
# Fixed values of HTML: elements without content, without text for readers, and inside lines.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = set("article section div main body html ul ol dl table blockquote aside nav header footer form figure td".split())
#: Names of containers that hold no main text, as elements, classes, ids or roles.
ASIDE = set(
    "nav header footer aside form button select menu noscript template head title ad ads advert adverts advertisement "
    "sponsor sponsored promo banner sidebar sidebars navbar navigation breadcrumb breadcrumbs cookie cookies consent notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments reply "
    "replies respond discussion related recommended widget toolbar pagination pager tags legal copyright disclaimer masthead "
    "contentinfo complementary search dialog iframe textarea label".split()
)
MAIN = set("article main content post entry story body-text articlebody post-content entry-content article-body main-content".split())

#: Quotes open a value only after "="; one that is never closed is an ordinary character. Nothing is tried twice.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*+)|[^>=])*+)>|<[!?][^>]*>", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[^\W_]+")


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order. A path part is an element with its names: ``div.ad``."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    linked, in_link, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            body = " ".join(html_lib.unescape("".join(text)).split())
            if body:
                out.append(Block(tuple(s[1] for s in stack if s[0] not in INLINE), body, linked))
            text.clear()
        linked = 0

    def close(names: set[str]) -> None:
        """Closes the innermost of the named elements, with all inside it, unless a container lies between."""
        nonlocal in_link
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                in_link -= sum(s[0] == "a" for s in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in BOUNDS:
                return

    find = _TAG.search
    while m := find(page, at):
        if m.start() > at:
            piece = page[at : m.start()]
            text.append(piece)
            if in_link:
                linked += len(piece)
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            flush()
        elif name == "br":
            text.append(" ")
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    in_link -= sum(s[0] == "a" for s in stack[i:])
                    del stack[i:]
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name not in INLINE:
            close(CLOSES.get(name, {"p"}))
        if name in VOID or m[3].endswith("/") and name not in INLINE and name not in BOUNDS:
            continue
        names = [name, *(w for a in _NAMED.finditer(m[3]) for w in (a[2] or a[3] or a[4] or "").lower().split())]
        stack.append((name, ".".join(names)))
        in_link += name == "a"
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


def _hash(word: str, n: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % n


_known_paths: dict[tuple[str, ...], np.ndarray] = {}


def _names(part: str) -> list[str]:
    """An element's names, and the words that they are put together from."""
    names = part.split(".")
    return list(dict.fromkeys(names + [w for n in names for w in re.split(r"[-_]+", n) if w]))


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    found = _known_paths.get(path)
    if found is None:
        if len(_known_paths) > 20_000:
            _known_paths.clear()
        found = np.zeros(PATH, np.float32)
        for part in path:
            for name in _names(part):
                h = zlib.crc32(name.encode("utf-8", "surrogatepass"))
                for k in range(3):  # three cells a name, so that names rarely share all
                    found[(h >> (8 * k)) % PATH] = 1.0
        _known_paths[path] = found
    return found


def features(page: list[Block]) -> np.ndarray:
    out = np.zeros((len(page), INPUTS), np.float32)
    for i, b in enumerate(page):
        out[i, :PATH] = path_vector(b.path)
        words = _WORD.findall(b.text.lower())
        for w in set(words):
            out[i, PATH + _hash(w, WORDS)] += 1.0
        out[i, PATH : PATH + WORDS] /= max(1, len(words))
        n = len(b.text)
        out[i, PATH + WORDS :] = (np.log1p(n) / 8, min(1.0, b.linked / max(1, n)), i / len(page), 1 - i / len(page), b.text[-1] in ".!?", len(b.path) / 10)
    return out


def weak_label(block: Block) -> bool:
    """Main text by the names of its containers."""
    names = {n for part in block.path for n in _names(part)}
    return bool(names & MAIN) and not names & ASIDE


class Network:
    """Bidirectional LSTM with one logistic output a block; all of a batch's pages step together."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def fresh(rng: np.random.Generator) -> Network:
        w = {}
        for way in ("f", "b"):
            w[f"x{way}"] = rng.normal(0, 0.1, (INPUTS, 4 * HIDDEN)).astype(np.float32)
            w[f"h{way}"] = rng.normal(0, 0.1, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            w[f"c{way}"] = np.zeros(4 * HIDDEN, np.float32)
            w[f"c{way}"][HIDDEN : 2 * HIDDEN] = 1.0  # remembers at first
        w["out"] = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
        w["skip"] = np.zeros(INPUTS, np.float32)
        w["bias"] = np.zeros(1, np.float32)
        return Network(w)

    @staticmethod
    def _sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def _scan(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool):
        n, steps, _ = x.shape
        gates = x @ self.w[f"x{way}"] + self.w[f"c{way}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, trace = np.zeros((n, steps, HIDDEN), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = gates[:, t] + h @ self.w[f"h{way}"]
            s = self._sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            c_new = m * (f * c + i * g)
            tc = np.tanh(c_new)
            if keep:
                trace.append((t, i, f, o, g, c, tc, h, m))
            h, c = m * (o * tc), c_new
            out[:, t] = h
        return out, trace

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        ahead, trace_f = self._scan(x, mask, "f", keep)
        back, trace_b = self._scan(x, mask, "b", keep)
        both = np.concatenate([ahead, back], axis=2)
        score = both @ self.w["out"] + x @ self.w["skip"] + self.w["bias"]
        return score, both, trace_f, trace_b

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        score, both, trace_f, trace_b = self.forward(x, mask, True)
        d = (self._sigmoid(score) - y) * mask / max(1.0, float(mask.sum()))
        out = {"out": np.einsum("nt,nth->h", d, both), "skip": np.einsum("nt,nti->i", d, x), "bias": np.array([d.sum()], np.float32)}
        for way, trace, part in (("f", trace_f, slice(0, HIDDEN)), ("b", trace_b, slice(HIDDEN, None))):
            dx = np.zeros((x.shape[2], 4 * HIDDEN), np.float32)
            dh_w, dc_w = np.zeros_like(self.w[f"h{way}"]), np.zeros_like(self.w[f"c{way}"])
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            for t, i, f, o, g, c, tc, h, m in reversed(trace):
                dh = (dh + d[:, t, None] * self.w["out"][part]) * m
                dc = (dc + dh * o * (1 - tc * tc)) * m
                dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                dx += x[:, t].T @ dz
                dh_w += h.T @ dz
                dc_w += dz.sum(axis=0)
                dh, dc = dz @ self.w[f"h{way}"].T, dc * f
            out |= {f"x{way}": dx, f"h{way}": dh_w, f"c{way}": dc_w}
        return out

    def label(self, pages: list[list[Block]], together: int = 128) -> list[np.ndarray]:
        """Main or not for every block; pages of like lengths step together."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            some = order[at : at + together]
            while len(some) > 1 and len(some) * len(pages[some[-1]]) > 20_000:
                some = some[: len(some) // 2]
            x, mask = _padded([features(pages[i]) for i in some])
            score = self.forward(x, mask)[0]
            for k, i in enumerate(some):
                out[i] = score[k, : len(pages[i])] > 0
            at += len(some)
        return out


def _padded(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(v) for v in vectors)
    x, mask = np.zeros((len(vectors), steps, INPUTS), np.float32), np.zeros((len(vectors), steps), np.float32)
    for i, v in enumerate(vectors):
        x[i, : len(v)], mask[i, : len(v)] = v, 1.0
    return x, mask


def _varied(page: list[Block], pool: list[str], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A sample page with another main container, and with blocks of other kinds in and around it."""
    wraps = ["article", "main", "div.content", "div.post", "div.entry-content", "section.story", "div.article-body", "div.main-content", "div.content.post-body", "main.content"]
    wrap = wraps[rng.integers(len(wraps))]
    inner = [("p",), ("h1",), ("h2",), ("h3",), ("ul", "li"), ("ol", "li"), ("blockquote",), ("blockquote", "p"), ("pre",), ("table", "tr", "td"), ("table", "tbody", "tr", "th"), ("dl", "dd"), ("figure", "figcaption"), ("section", "p"), ("div", "p"), ("div",)]
    labels = [weak_label(b) for b in page]
    changed = []
    for b, main in zip(page, labels, strict=True):
        path, text = tuple(wrap if p.split(".")[0] in ("article", "main") else p for p in b.path), b.text
        if main and rng.random() < 0.6:
            path = (*path[:-1], *inner[rng.integers(len(inner))])
            if rng.random() < 0.4:
                text = text[: int(rng.integers(2, 120))].strip() or "x"
        changed.append(Block(path, text, b.linked if text is b.text else int(rng.integers(0, len(text) + 1)) if rng.random() < 0.2 else 0))
    places = [i for i, main in enumerate(labels) if main] or [0]
    plain = ["div", "section", "ul", "p", "li", "span", "h2", "h3"]
    names = sorted(ASIDE)
    for _ in range(int(rng.integers(1, 5))):
        name = names[rng.integers(len(names))]
        element = name if name in ("nav", "header", "footer", "aside", "form", "button", "noscript", "label") else f"div.{name}"
        if rng.random() < 0.3:
            element += f"-{('box', 'list', 'area', 'wrap')[rng.integers(4)]}" if element.startswith("div.") else ""
        inside = rng.random() < 0.5
        root = ("html", "body", wrap) if inside else ("html", "body")
        first = int(rng.integers(places[0], places[-1] + 2)) if inside else int(rng.choice([0, len(changed)]))
        for k in range(int(rng.integers(1, 4))):
            words = pool[rng.integers(len(pool))]
            body = words[: int(rng.integers(8, 400))].strip() or "x"
            path = (*root, element, plain[rng.integers(len(plain))]) if rng.random() < 0.7 else (*root, element)
            changed.insert(first + k, Block(path, body, len(body) if rng.random() < 0.3 else 0))
            labels.insert(first + k, False)
    return changed, labels


def _renamed(page: list[Block], rng: np.random.Generator, kept_aside: bool = False) -> list[Block]:
    """A page whose containers, or all but those that ``ASIDE`` names, are named at random, alike where they were named alike, or not at all."""
    said: dict[str, str] = {}
    letters = "abcdefghijklmnopqrstuvwxyz"
    telling = {"article", "main", "section", "nav", "aside", "header", "footer", "form"}
    nameless = rng.random() < 0.2

    def other(part: str) -> str:
        element, *names = part.split(".")
        if element in ("html", "body") or (element not in telling and not names):
            return part
        if part not in said:
            if kept_aside and ASIDE.intersection(_names(part)):
                said[part] = part
                return part
            made = "" if nameless else "." + "".join(letters[i] for i in rng.integers(0, 26, int(rng.integers(1, 10)))) + str(rng.integers(0, 100) if rng.random() < 0.4 else "")
            said[part] = ("div" if element in telling else element) + made
        return said[part]

    return [Block(tuple(other(p) for p in b.path), b.text, b.linked) for b in page]


def train(found: list[list[Block]], rounds: int = 24, rate: float = 0.01, seed: int = 3) -> Network | None:
    """A network fitted to the blocks of the sample's pages by Adam."""
    if not found:
        return None
    found = found * max(1, 200 // len(found))  # few pages are seen in more forms, so that a round has as many steps
    rng = np.random.default_rng(seed)
    pool = [b.text for page in found for b in page]
    net = Network.fresh(rng)
    mean = {k: np.zeros_like(v) for k, v in net.w.items()}
    square = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for _ in range(rounds):
        seen = [_varied(p, pool, rng) for p in found] + [(p, [weak_label(b) for b in p]) for p in found]
        # what was put in can be told by its names alone, so it keeps them
        changed, plain = seen[: len(found)], seen[len(found) :]
        seen += [(_renamed(p, rng, True), labels) for p, labels in changed[::2]] + [(_renamed(p, rng), labels) for p, labels in plain[::3]]
        seen = [s for s in seen if len(s[0]) <= 200] or seen
        order = sorted(range(len(seen)), key=lambda i: len(seen[i][0]))
        batches = [order[i : i + 32] for i in range(0, len(order), 32)]
        for b in rng.permutation(len(batches)):
            x, mask = _padded([features(seen[i][0]) for i in batches[b]])
            y = np.zeros_like(mask)
            for k, i in enumerate(batches[b]):
                y[k, : len(seen[i][1])] = seen[i][1]
            step += 1
            for k, g in net.gradients(x, y, mask).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                fixed = (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                net.w[k] = (net.w[k] - rate * fixed).astype(np.float32)
    return net


def excerpt(page: list[Block], most_bytes: int) -> list[Block]:
    """The page if it keeps to the bounds, else its first and last blocks, half a bound each.

    Blocks are whole, but for one that alone is over half the bound in bytes, of which that half's characters count.
    """
    size = [len(b.text.encode("utf-8", "surrogatepass")) for b in page]
    if sum(size) <= most_bytes and len(page) <= SAMPLE_BLOCKS:
        return page
    half = max(1, most_bytes // 2)

    def run(order: range, most: int) -> list[int]:
        taken, total = [], 0
        for i in order[:most]:
            total += min(size[i], half)
            if taken and total > half:
                break
            taken.append(i)
        return taken

    first = run(range(len(page)), SAMPLE_BLOCKS // 2)
    last = run(range(len(page) - 1, first[-1], -1), SAMPLE_BLOCKS // 2)
    out = []
    for i in first + last[::-1]:
        b = page[i]
        text = b.text if size[i] <= half else b.text.encode("utf-8", "surrogatepass")[:half].decode("utf-8", "ignore")
        out.append(Block(b.path, text, min(b.linked, len(text)) if text is not b.text else b.linked))
    return out


def _lowest(sample_pages: int, sample_bytes: int):
    """A task's distinct pages with blocks of least (place, hash), as many as the sample has; memory is bounded by that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap: list[tuple[int, int]] = []  # negated, so that the highest comes first
        held: dict[tuple[int, int], str] = {}
        for batch in batches:
            places, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, key in enumerate(zip(places, hashes, strict=True)):
                if key in held or len(heap) == sample_pages and (-key[0], -key[1]) < heap[0]:
                    continue
                found = blocks(batch.column(2)[i].as_py())
                if not found:
                    continue
                held[key] = json.dumps([[b.path, b.text, b.linked] for b in excerpt(found, sample_bytes)])
                heapq.heappush(heap, (-key[0], -key[1]))
                if len(heap) > sample_pages:
                    place, h = heapq.heappop(heap)
                    del held[-place, -h]
        for (place, h), body in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([h], pa.int64()), pa.array([body], pa.string())], ["place", "hash", "blocks"])

    return run


def sample(pages: DataFrame, html: str = "html", sample_pages: int = 200, sample_bytes: int = 32_768) -> list[list[Block]]:
    """Blocks of the distinct pages of least hash among those that have any."""
    rows = pages.select(F.xxhash64(html).alias("hash"), F.col(html).alias("html")).where("html is not null")
    rows = rows.select(F.pmod("hash", F.lit(1 << 20)).alias("place"), "hash", "html")
    distinct = rows.agg(F.approx_count_distinct("hash")).first()[0]
    # pages of low hash only, about four times the sample: else every task would send as many as the sample
    part = min(1 << 20, -(-4 * sample_pages * (1 << 20) // max(1, distinct)))
    # all pages if too few of these have blocks
    for below in dict.fromkeys((part, 1 << 20)):
        low = rows.where(F.col("place") < below).mapInArrow(_lowest(sample_pages, sample_bytes), "place long, hash long, blocks string")
        found = low.dropDuplicates(["hash"]).orderBy("place", "hash").limit(sample_pages).collect()
        if len(found) == sample_pages:
            break
    return [[Block(tuple(path), text, linked) for path, text, linked in json.loads(r["blocks"])] for r in found]


def learn(pages: DataFrame, html: str = "html", sample_pages: int = 200, sample_bytes: int = 32_768) -> Network | None:
    """Trains on the sample; None only if no page has a block, so that all texts are empty."""
    return train(sample(pages, html, sample_pages, sample_bytes))


def extract(pages: DataFrame, net: Network | None, html: str = "html", separator: str = "\n") -> DataFrame:
    """Input columns but the html, ``text`` and ``n_chars``."""
    kept = others(pages, *ADDED, html)
    shared = pages.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [blocks(p or "") for p in part.column(part.num_columns - 1).to_pylist()]
                main = network.label(found) if network else [np.zeros(len(b), bool) for b in found]
                texts = [separator.join(b.text for b, m in zip(page, marks, strict=True) if m) for page, marks in zip(found, main, strict=True)]
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*kept, *ADDED])

    fields = [T.StructField(c, pages.schema[c].dataType) for c in kept]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(*kept, F.col(html).alias("__html")).mapInArrow(run, schema)
