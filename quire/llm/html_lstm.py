"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks; each is a vector of its tag path (tags, classes, ids and roles of its ancestors, hashed),
of its words (hashed) and of a few sizes. A bidirectional LSTM in numpy reads the blocks of the whole page in order and labels
each as main text or not. Its weights (block_lstm.npz) are trained by this module on pages that it makes up itself: see
train().

Null and empty pages give empty text. Repeated rows are extracted each. Malformed markup is read as browsers do in the
common cases (open paragraphs, stray ends, bare ampersands). An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from .common import pieces, small_batches

WEIGHTS = Path(__file__).with_name("block_lstm.npz")
PATHS, WORDS, SIZES = 96, 48, 8
INPUTS, HIDDEN = PATHS + WORDS + SIZES, 20
#: Blocks that are run at once.
CELLS = 16_384
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("annotation annotation-xml iframe noscript object script style svg template textarea title".split())
#: Elements of these hold no markup: they end at their end tag only, whatever is before it.
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in ("iframe", "noscript", "script", "style", "textarea", "title")}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPLIT = re.compile(r"[\s_\-]+|(?<=[a-z])(?=[A-Z])|\d+")

class Buckets(dict):
    """Hash buckets of words, kept up to a number."""

    def __init__(self, n: int, most: int = 300_000):
        self.n, self.most = n, most

    def __missing__(self, word: str) -> int:
        if len(self) > self.most:
            self.clear()
        x = self[word] = xxhash.xxh3_64_intdigest(word) % self.n
        return x


_of_names, _of_words = Buckets(PATHS), Buckets(WORDS)


def blocks(page: str) -> list[tuple[str, tuple[str, ...], int]]:
    """(text, names of the path, characters in links) of each leaf block with text."""
    out: list[tuple[str, tuple[str, ...], int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    linked = 0
    skip = ""

    def close():
        nonlocal linked
        s = " ".join(html.unescape("".join(text)).split())
        if s:
            out.append((s, tuple(n for _, names in stack for n in names), linked))
        text.clear()
        linked = 0

    at, in_link = 0, 0
    while m := TOKEN.search(page, at):
        start, end = m.span()
        if not skip and start > at:
            text.append(page[at:start])
            linked += in_link and (start - at)
        at = end
        tag = (m[1] or "").lower()
        if not tag:
            continue
        ends = page[start + 1] == "/"
        if not ends and tag in RAW and not m[2].endswith("/"):
            if not skip:
                close()
            stop = RAW[tag].search(page, end)
            at = stop.end() if stop else len(page)
            continue
        if skip:
            if ends and tag == skip:
                skip = ""
            continue
        if not ends and tag in SKIPPED:
            if not tag.startswith("annotation"):  # within a line of text
                close()
            skip = "" if m[2].endswith("/") else tag
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag == "a":
            in_link = 0 if ends else 1
            continue
        if tag == "head":  # what a head holds is skipped by itself; text in it is text of the page
            close()
            continue
        if tag not in BLOCK:
            continue
        close()
        if ends:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if stack and stack[-1][0] == "p" or tag in ("li", "dd", "dt", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
            stack.pop()
        if tag not in VOID:
            names = [f"<{tag}>"]
            for n in NAMES.finditer(m[2]):
                names += [w.lower() for w in SPLIT.split(n[2] or n[3] or n[4] or "") if w]
            stack.append((tag, tuple(names)))
    if not skip:
        text.append(page[at:])
    close()
    return out


_paths: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    x = _paths.get(path)
    if x is None:
        if len(_paths) > 20_000:
            _paths.clear()
        x = np.zeros(PATHS, dtype=np.float32)
        x[[_of_names[n] for n in path]] = 1
        if path:
            x[_of_names["." + next((n for n in reversed(path) if n[0] == "<"), "")]] = 1
        _paths[path] = x
    return x


def vector(text: str, path: tuple[str, ...], linked: int) -> np.ndarray:
    """Of the whole path and all words: a word's first mention counts most, and long texts no more than short ones."""
    x = np.zeros(INPUTS, dtype=np.float32)
    x[:PATHS] = _path_vector(path)
    words = text.lower().split(" ")
    n, k = len(text), len(words)
    counts = np.bincount([_of_words[w] for w in words], minlength=WORDS)
    x[PATHS : PATHS + WORDS] = 0.3 * counts * (min(1.0, 12 / k) if k > 12 else 1.0)
    x[-SIZES:] = (np.log1p(n) / 6, np.log1p(k) / 4, min(1.0, linked / n), text[-1] in ".!?…”\"", sum(map(text.count, ",.;")) / (k + 1), n < 40, len(path) / 12, "©" in text)
    return x


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    def __init__(self, w: dict[str, np.ndarray]):
        self.w = w

    @staticmethod
    def fresh(seed: int = 1) -> "BiLstm":
        rng = np.random.default_rng(seed)
        w = {}
        for way in "fb":
            w[f"x{way}"] = rng.normal(0, INPUTS**-0.5, (INPUTS, 4 * HIDDEN))
            w[f"h{way}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            w[f"c{way}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # forget gates start open
        w["out"], w["bias"] = rng.normal(0, 0.2, (2 * HIDDEN + INPUTS,)), np.zeros(1)
        return BiLstm(w)

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        steps, rows = x.shape[:2]
        h, c = np.zeros((rows, HIDDEN), x.dtype), np.zeros((rows, HIDDEN), x.dtype)
        out = np.zeros((steps, rows, HIDDEN), x.dtype)
        drive = x @ self.w[f"x{way}"] + self.w[f"c{way}"]
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = drive[t] + h @ self.w[f"h{way}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, i, f, o, g, c, new, h, m))
            c = m * new + (1 - m) * c
            h = m * (o * np.tanh(new)) + (1 - m) * h
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        y = np.concatenate([self._run(x, mask, "f"), self._run(x, mask, "b"), x], axis=2)
        return y @ self.w["out"] + self.w["bias"]

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length are run together, up to CELLS blocks with what
        they are filled up with (or one page)."""
        out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < 128 and (end - at + 1) * len(pages[order[end]]) <= CELLS:
                end += 1
            part, at = order[at:end], end
            steps = len(pages[part[-1]])
            x, mask = np.zeros((steps, len(part), INPUTS), np.float32), np.zeros((steps, len(part)), np.float32)
            for k, i in enumerate(part):
                x[: len(pages[i]), k], mask[: len(pages[i]), k] = pages[i], 1
            y = self.logits(x, mask) > 0
            for k, i in enumerate(part):
                out[i] = y[: len(pages[i]), k]
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        kept: dict[str, list] = {"f": [], "b": []}
        seq = {way: self._run(x, mask, way, kept[way]) for way in "fb"}
        full = np.concatenate([seq["f"], seq["b"], x], axis=2)
        p = _sigmoid(full @ self.w["out"] + self.w["bias"])
        total = mask.sum()
        loss = -(mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / total
        d = mask * (p - y) / total
        g = {"out": np.einsum("tb,tbi->i", d, full), "bias": np.array([d.sum()])}
        for k, way in enumerate("fb"):
            gx, gh, gc = (np.zeros_like(self.w[n + way]) for n in "xhc")
            dh, dc = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
            for t, i, f, o, gg, c, new, h, m in reversed(kept[way]):
                dh = dh + d[t][:, None] * self.w["out"][k * HIDDEN : (k + 1) * HIDDEN]
                th = np.tanh(new)
                dm, dcm = m * dh, m * dc
                dn = dcm + dm * o * (1 - th * th)
                z = np.concatenate([dn * gg * i * (1 - i), dn * c * f * (1 - f), dm * th * o * (1 - o), dn * i * (1 - gg * gg)], axis=1)
                gx += x[t].T @ z
                gh += h.T @ z
                gc += z.sum(axis=0)
                dh = z @ self.w[f"h{way}"].T + (1 - m) * dh
                dc = dn * f + (1 - m) * dc
            g |= {f"x{way}": gx, f"h{way}": gh, f"c{way}": gc}
        return loss, g


def made_up_page(rng) -> tuple[str, list[str]]:
    """A page and the texts of its main blocks, in order."""
    syllables = "an be con de er fo ga hi in jo ka lo mi no op pa re sa ti un ve wo ion ing ment eau ung keit ción qué über".split()
    pick = lambda *x: x[rng.integers(len(x))]
    style = pick(*"pppppppp|#!")  # plain words, fields, symbols, capitals

    def word() -> str:
        w = "".join(syllables[i] for i in rng.integers(0, len(syllables), rng.integers(1, 4)))
        return w + pick("***", "%%%", "&amp;&amp;", "$$$") if style == "#" else w.upper() + "!!" if style == "!" else w

    def says(a: int, b: int) -> str:
        s = (" | " if style == "|" else " ").join(word() for _ in range(rng.integers(a, b)))
        return s if rng.random() < 0.2 else s.capitalize() if style == "p" else s

    main: list[str] = []

    def own(s: str) -> str:
        main.append(s)
        return s

    def para() -> str:
        return own(" ".join(says(1 if rng.random() < 0.2 else 5, 22) + pick(".", ".", ".", "!", "?", "") for _ in range(rng.integers(1, 6))))

    def inner() -> str:
        kind = rng.random()
        s = para() if kind < 0.75 else own(says(1, 9))
        if kind < 0.62:
            return pick(f"<p>{s}</p>", f"<p>{s}</p>", f"<p>{s}", f"<p><b>{s}</b></p>", f"<p><b>{s}<br>", f'<p class="{word()}">{s}</p>', f"<div>{s}</div>")
        if kind < 0.75:
            return pick(f"<blockquote><p>{s}</p></blockquote>", f"<pre>{s}</pre>", f"<table><tr><td>{s}</td></tr></table>", f"<figure><figcaption>{s}</figcaption></figure>")
        return pick(f"<h2>{s}</h2>", f"<h3>{s}</h3>", f"<ul><li>{s}</li></ul>", f"<ol><li>{s}</li></ol>", f"<p>{s}</p>")

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{word()}">{says(1, 4)}</a></li>' for _ in range(n)) + "</ul>"

    def noise() -> str:
        s, t = says(2, 16) + pick(".", ""), says(1, 6)
        c = rng.integers(12)
        if c == 0:
            return f"<nav{pick('', ' class=menu', ' id=nav')}>{links(rng.integers(2, 9))}</nav>"
        if c == 1:
            name = pick("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner")
            return f'<div class="{name}">{pick(s, f"<p>{s}</p>")}</div>'
        if c == 2:
            return f'<div class="{pick("cookie", "cookie-notice", "consent", "notice", "gdpr", "alert", "popup", "newsletter", "subscribe")}"><p>{s}</p><button>{t}</button></div>'
        if c == 3:
            return f'<aside{pick("", " class=sidebar")}><h3>{t}</h3>{pick(links(4), f"<p>{s}</p>")}</aside>'
        if c == 4:
            return f'<div {pick("class", "id")}="{pick("sidebar", "side-bar", "widget", "related", "share", "social", "breadcrumbs", "pagination", "tags", "menu", "toolbar")}">{pick(links(3), f"<p>{s}</p>", s)}</div>'
        if c == 5:
            return f'<form action="/{word()}"><label>{t}</label><input name="q"><p>{s}</p><button>{says(1, 3)}</button></form>'
        if c == 6:
            body = "".join(f'<{pick("div", "li", "article")} class="comment"><p>{says(4, 40)}.</p></{pick("div", "div")}>' for _ in range(rng.integers(1, 4)))
            return f'<section {pick("class", "id")}="{pick("comments", "comment-list", "responses", "disqus", "replies")}"><h2>{t}</h2>{body}</section>'
        if c == 7:
            return f"<header{pick('', ' class=site-header', ' role=banner')}><div>{t}</div>{pick('', f'<p>{s}</p>')}</header>"
        if c == 8:
            return f"<footer><p>&copy; {t} &middot; {s}</p></footer>"
        if c == 9:
            return f'<div {pick("class", "id")}="{pick("header", "masthead", "topbar", "logo", "navbar")}">{t}</div>'
        if c == 10:
            return f'<div {pick("class", "id")}="{pick("footer", "copyright", "legal", "site-info", "bottom")}">{pick("&copy; ", "")}{s}</div>'
        return f"<noscript>{s}</noscript><script>var x='{t}';</script><!-- {s} -->"

    top = "".join(noise() for _ in range(rng.integers(0, 5)))
    if rng.random() < 0.6:
        top = f"<nav>{links(rng.integers(3, 8))}</nav>" + top
    title = own(says(2, 10)) if rng.random() < 0.85 else ""
    head = f"<h1>{title}</h1>" if title else ""
    if title and rng.random() < 0.15:
        head = f"<header>{head}</header>"
    body = head
    for _ in range(rng.integers(1, 14)):
        body += inner()
        if rng.random() < 0.12:
            body += noise()
    tail = "".join(noise() for _ in range(rng.integers(0, 5)))
    if rng.random() < 0.6:
        tail += f"<footer>&copy; {word()}.example &middot; {says(1, 14)}.</footer>"
    box = rng.random()
    if box < 0.5:
        body = f"<article{pick('', ' class=post')}>{body}</article>"
    elif box < 0.7:
        body = f"<main{pick('', ' id=content')}>{body}</main>"
    elif box < 0.95:
        body = f'<div {pick("class", "id")}="{pick("content", "post", "entry-content", "article-body", "story", "main", "page")}">{body}</div>'
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{top}{body}{tail}</body></html>", main


def train(path: Path = WEIGHTS, steps: int = 700, rows: int = 24, seed: int = 5) -> float:
    """Fit by Adam on made-up pages; gives the share of right labels on fresh ones."""
    rng, net = np.random.default_rng(seed), BiLstm.fresh(seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.w.items()} for _ in range(2))

    def batch():
        made = []
        for _ in range(rows):
            page, main = made_up_page(rng)
            got, left = blocks(page), list(main)
            y = []
            for s, _, _ in got:
                hit = bool(left) and s == " ".join(html.unescape(left[0]).split())
                y.append(hit)
                if hit:
                    left.pop(0)
            made.append((np.stack([vector(*b) for b in got]), np.array(y)))
        n = max(len(y) for _, y in made)
        x, y, mask = np.zeros((n, rows, INPUTS)), np.zeros((n, rows)), np.zeros((n, rows))
        for k, (v, label) in enumerate(made):
            x[: len(v), k], y[: len(v), k], mask[: len(v), k] = v, label, 1
        return x, y, mask

    for step in range(1, steps + 1):
        _, g = net.gradients(*batch())
        rate = 0.01 * min(1, 3 * (1 - step / (steps + 1)))
        for k in net.w:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
            net.w[k] = net.w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    right = total = 0
    for _ in range(20):
        x, y, mask = batch()
        right += (((net.logits(x, mask) > 0) == y) * mask).sum()
        total += mask.sum()
    np.savez_compressed(path, **{k: v.astype(np.float32) for k, v in net.w.items()})
    return right / total


def extract(pages_: list[str | None], net: BiLstm) -> list[str]:
    cut = [blocks(p or "") for p in pages_]
    labels = net.label([np.stack([vector(*b) for b in own]) if own else np.zeros((0, INPUTS), np.float32) for own in cut])
    return ["\n\n".join(b[0] for b, keep in zip(own, y, strict=True) if keep) for own, y in zip(cut, labels, strict=True)]


def extract_pages(spark: SparkSession, pages_: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    small_batches(spark, 1000)
    with np.load(WEIGHTS) as w:
        sent = spark.sparkContext.broadcast({k: w[k] for k in w.files})  # of fixed size

    def run(batches):
        net = BiLstm(sent.value)
        for batch in batches:
            for part in pieces(batch, "html", 4 << 20):
                text = extract(part.column("html").to_pylist(), net)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages_.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


if __name__ == "__main__":
    print(f"right labels on fresh pages: {train():.4f}")
