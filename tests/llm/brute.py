"""Plain versions of the operators, by the contracts' words alone."""

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def shingles(text):
    w = words(text, True)
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def components(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def rule_counts(text):
    w = words(text)
    runs = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        whole = sum(weight[s] for s in free)
        got = {s: left * weight[s] / whole for s in free}
        over = [s for s in free if got[s] > most * sizes[s]]
        if not over:
            return fixed | got
        fixed |= {s: most * sizes[s] for s in over}


def base_scores(docs):
    train = [(words(t, True) + ["\0end"]) for i, t in docs if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    out = {}
    for i, t in docs:
        w = words(t, True) + ["\0end"]
        out[i] = (len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    return out


def line_dedup(docs, width=3):
    """docs: (id, text), ids distinct."""
    windows = defaultdict(list)
    kept = {}
    for i, t in sorted(docs):
        lines = (t or "").split("\n")
        at = [k for k, x in enumerate(lines) if words(x)]
        kept[i] = lines, at
        own = [lines[k].strip(" \t\v\f\r") for k in at]
        if own:
            for k in range(max(1, len(own) - width + 1)):
                windows[tuple(own[k : k + width])].append((i, k))
    gone = defaultdict(set)
    for places in windows.values():
        for i, k in places[1:]:
            gone[i] |= set(range(k, min(k + width, len(kept[i][1]))))
    out = {}
    for i, t in docs:
        lines, at = kept[i]
        drop = set()
        real = {p: j for j, p in enumerate(at)}
        before = None
        for p in range(len(lines)):
            if p in real:
                before = real[p] in gone[i]
                if before:
                    drop.add(p)
            elif before and ((nxt := next((q for q in at if q > p), None)) is None or real[nxt] in gone[i]):
                drop.add(p)
        out[i] = None if t is None else "\n".join(x for p, x in enumerate(lines) if p not in drop), len(gone[i])
    return out


def article(page):
    """The text of the pages of the test tables: an article's (or body's) headings, paragraphs and the like, by Python's own HTML parser."""
    import html.parser

    class Reader(html.parser.HTMLParser):
        blocks = frozenset("article aside blockquote body div dl dt dd figure figcaption footer form h1 h2 h3 h4 h5 h6 header html li main nav ol p pre section table tr td th tbody thead ul".split())
        out = frozenset("nav footer aside form header script style head button noscript".split())

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.stack, self.found, self.run = [], [], []

        def flush(self):
            text = " ".join("".join(self.run).split())
            if text:
                self.found.append((any(t == "article" for t, _ in self.stack), text))
            self.run = []

        def handle_starttag(self, tag, attrs):
            if tag in self.blocks:
                self.flush()
                if any(t == "p" for t, _ in self.stack):
                    while self.stack.pop()[0] != "p":
                        pass
            if tag == "br":
                self.run.append(" ")
            elif tag not in ("meta", "link", "img", "input", "hr"):
                named = (dict(attrs).get("class") or "") + " " + (dict(attrs).get("id") or "")
                self.stack.append((tag, tag in self.out or any(w in named for w in ("ad", "comment", "cookie", "notice", "share", "related", "sidebar", "promo", "banner", "nav", "menu", "newsletter", "breadcrumb"))))

        def handle_endtag(self, tag):
            if tag in self.blocks:
                self.flush()
            if any(t == tag for t, _ in self.stack):
                while self.stack.pop()[0] != tag:
                    pass

        def handle_data(self, data):
            if not any(o for _, o in self.stack):
                self.run.append(data)

    r = Reader()
    r.feed(page or "")
    r.close()
    r.flush()
    inside = [t for a, t in r.found if a]
    return "\n".join(inside or [t for _, t in r.found])


class PitmanYor:
    """The language model's probabilities, token by token, from dictionaries of its seating."""

    def __init__(self, model):
        from kbspark.llm import lm_scoring as lm

        self.lm, self.model = lm, model
        self.contexts, self.classes = (x.tolist() for x in model.listed.value)
        self.total, self.pairs, self.cls, self.root = {}, {}, {}, {}
        for row in model.state.collect():
            s = {k: v.tolist() for k, v in lm._state(row.asDict()).items()}
            pair = both = 0
            for i, w in enumerate(s["w"]):
                self.total[w] = sum(s["n"][pair : pair + s["size"][i]])
                self.root[w] = [s[f"r{j}"][i] for j in range(lm.SAMPLES)]
                for pair in range(pair, pair + s["size"][i]):
                    self.pairs[w, s["code"][pair]] = s["n"][pair], [s[f"t{j}"][pair] for j in range(lm.SAMPLES)]
                pair += 1
                for both in range(both, both + s["csize"][i]):
                    self.cls[w, s["cls"][both]] = [s[f"q{j}"][both] for j in range(lm.SAMPLES)]
                both += 1

    def probability(self, w, code):
        k, out = len(self.contexts), 0
        c = self.classes[code] if code < k else code - k
        for j, t in enumerate(self.model.samples):
            d2, d1, d0 = t.discounts
            unknown = (1 + d0 * t.root_t) / (t.vocabulary + 1) / (1 + sum(t.class_t))
            p = self.root[w][j] if w in self.root else unknown
            p = self.cls[w, c][j] if (w, c) in self.cls else (1 + d1 * t.class_t[c]) / (1 + t.class_n[c]) * p
            if code < k:
                n, tables = self.pairs.get((w, code), (0, [0] * 9))
                p = (n - d2 * tables[j] + (1 + d2 * t.t[code]) * p) / (1 + t.n[code])
            out += p
        return out / len(self.model.samples)

    def score(self, text):
        import math

        at = {w: i for i, w in enumerate(self.contexts)}
        out = 0.0
        for _, _, tok, cls, _ in self.lm.tokens([(text or "").encode()]):
            code = len(self.contexts) + self.lm.START
            for w, c in zip(tok.tolist(), cls.tolist(), strict=True):
                out += math.log10(self.probability(w, code))
                code = at.get(w, len(self.contexts) + c)
        return out
