"""The operators in plain Python, one row after another, as a measure for the Spark ones."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import xxhash

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def lower(text):
    return (text or "").translate(UPPER)


def contamination(docs, items, window=10):
    """{(id, text): (n_words, n_hit, sorted item ids as text)}"""
    grams = defaultdict(set)
    for item, text in items:
        w = WORDS.findall(lower(text))
        n = min(len(w), window)
        for p in range(len(w) - n + 1 if w else 0):
            grams[tuple(w[p : p + n])].add(item)
    out = {}
    for doc, text in docs:
        w = WORDS.findall(lower(text))
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in grams:
                    hit |= set(range(p, p + n))
                    found |= grams[tuple(w[p : p + n])]
        out[doc, text] = len(w), len(hit), sorted(str(i) for i in found if i is not None)
    return out


def quality_counts(text):
    text = text or ""
    w = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated), len(lines)


def quality_failures(text):
    n, chars, symbols, dup, repeated, lines = quality_counts(text)
    return {
        "short": n < 50,
        "repeats": 100 * repeated > 50 * n,
        "symbols": 100 * symbols > 20 * n,
        "dup_lines": 100 * dup > 40 * lines,
        "word_length": chars < 2 * n or chars > 15 * n,
    }


def bad_hosts(rows, limit=0.9):
    """Hosts of (text, host) rows whose shrunk rate of a rule is above the limit."""
    hosts = defaultdict(list)
    for text, host in rows:
        if host is not None:
            hosts[host].append(quality_failures(text))
    bad = set()
    for rule in quality_failures(""):
        rates = {h: (sum(f[rule] for f in fs), len(fs)) for h, fs in hosts.items()}
        p = [k / n for k, n in rates.values()]
        if not p:
            continue
        m = sum(p) / len(p)
        v = sum((x - m) ** 2 for x in p) / len(p) - sum(k / n * (1 - k / n) / n for k, n in rates.values()) / len(p)
        s = min(max(m * (1 - m) / v - 1, 1), 1e6) if v > 0 else 1e6
        bad |= {h for h, (k, n) in rates.items() if (k + m * s) / (n + s) > limit}
    return bad


def kept_by_quality(rows):
    """Whether each of (text, host) is kept."""
    bad = bad_hosts(rows)
    failed = [quality_failures(t) for t, _ in rows]
    return [not (f["short"] or f["repeats"]) and h not in bad for f, (_, h) in zip(failed, rows)]


def fingerprint(text, shingle=4):
    w = SPACED.findall(lower(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + shingle]).encode(), 42) for i in range(max(len(w) - shingle + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, bits=4):
    """{print: smallest print reachable}"""
    nodes, root = sorted(set(prints)), {}
    for n in nodes:
        if n not in root:
            root[n], stack = n, [n]
            while stack:
                x = stack.pop()
                for y in nodes:
                    if y not in root and bin(x ^ y).count("1") <= bits:
                        root[y] = n
                        stack.append(y)
    return root


def line_words(line):
    return set(SPACED.findall(lower(line))) or None


def without_repeated_lines(docs):
    """The texts of (id, text), all ids different and in order, without lines like an earlier one."""
    earlier, out = [], []
    for _, text in docs:
        kept = []
        for line in (text or "").split("\n"):
            s = line_words(line)
            if s is None or not any(5 * len(s & e) >= 4 * len(s | e) for e in earlier):
                kept.append(line)
            if s is not None:
                earlier.append(s)
        out.append(text if text is None else "\n".join(kept))
    return out


def mixed(rows, weights=(1, 2, 3)):
    """(id, size, source size, target, taken) of (id, text, source)."""
    size = [len(SPACED.findall(t or "")) for _, t, _ in rows]
    sizes = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(size), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    target = {s: 3.0 * sizes[s] if s in capped else share[s] for s in order}
    digest = lambda d: hashlib.md5(f"mix:{'' if d is None else d}".encode()).hexdigest()
    upto, moves = defaultdict(int), []
    for i in sorted(range(len(rows)), key=lambda i: (digest(rows[i][0]), rows[i][0] is None, rows[i][0] or 0, size[i])):
        s = rows[i][2]
        upto[s] += size[i]
        for e in range(3):
            at = e * sizes[s] + upto[s]
            if size[i]:
                moves.append((at / target[s], "n" if s is None else f"s{s}", at, i))
    taken, used = Counter(), 0
    for _, _, _, i in sorted(moves):
        used += size[i]
        if used > total:
            break
        taken[i] += 1
    return [(d, size[i], sizes[s], target[s], size[i] * taken[i]) for i, (d, _, s) in enumerate(rows)]


class ArticleText(HTMLParser):
    """Blocks of what lies in <article> or <main>, less elements that are no text, by the standard library's parser. Knows no templates, and
    pages whose end tags are there (but those of paragraphs, list items and heads)."""

    BLOCKS = set("address article blockquote body caption dd div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section table tbody td th thead tr ul aside nav header footer form".split())
    VOID = set("area base br col embed hr img input link meta source track wbr".split())
    GONE = set("head nav header footer aside form script style noscript iframe textarea title select button svg".split())
    NAMED = set("ad ads sidebar comments comment cookie-notice newsletter related share menu".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks, self.now = [], [], ""

    def end_block(self):
        text = " ".join(self.now.split())
        self.blocks += [text] if text else []
        self.now = ""

    def pop(self, at):
        if any(t in self.BLOCKS for t, _ in self.stack[at:]):
            self.end_block()
        del self.stack[at:]

    def handle_starttag(self, tag, attributes):
        names = [t for t, _ in self.stack]
        if names and names[-1] == "head" and tag not in ("title", "style", "script", "meta", "link", "base", "noscript"):
            self.pop(len(names) - 1)
        if tag in ("p", "li") and tag in names[-1:]:
            self.pop(len(names) - 1)
        elif tag in self.BLOCKS and names[-1:] == ["p"]:
            self.pop(len(names) - 1)
        if tag in self.BLOCKS:
            self.end_block()
        if tag == "br":
            self.handle_data(" ")
        if tag not in self.VOID:
            known = {w for k, v in attributes if k in ("class", "id") for w in (v or "").lower().split()}
            self.stack.append((tag, tag in self.GONE or bool(known & self.NAMED)))

    def handle_startendtag(self, tag, attributes):
        if tag not in ("svg", "math") and not any(t in ("svg", "math") for t, _ in self.stack):
            self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag):
        at = max((i for i, (t, _) in enumerate(self.stack) if t == tag), default=None)
        if at is not None:
            self.pop(at)

    def handle_data(self, data):
        tags = [t for t, _ in self.stack]
        if ("article" in tags or "main" in tags) and not any(gone for _, gone in self.stack):
            self.now += data


def article_text(page):
    parser = ArticleText()
    parser.feed(page or "")
    parser.close()
    parser.end_block()
    return " ".join(parser.blocks)
