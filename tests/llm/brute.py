"""Plain Python versions of what the operators compute, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(rows, width, num, den):
    """rows: (doc_id, text), ids unique; doc_id -> (set size, component)."""
    sets = {d: shingles(t, width) for d, t in rows}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    having = defaultdict(list)
    for d, s in sorted(sets.items()):
        common = Counter(e for x in s for e in having[x])
        for e, n in common.items():
            if den * n >= num * (len(s) + len(sets[e]) - n):
                a, b = find(d), find(e)
                up[max(a, b)] = min(a, b)
        for x in s:
            having[x].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def secrets(text):
    """Fixed patterns only: (start, kind, end) in order."""
    key = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(s, k, e) for s, _, k, e in sorted(found)]


def random_windows(text, window, least_bits):
    """Starts of windows of at least so much entropy, each counted afresh."""
    starts = []
    for i in range(len(text) - window + 1):
        counts = Counter(text[i : i + window]).values()
        bits = -sum(c / window * math.log2(c / window) for c in counts)
        if bits >= least_bits - 1e-9:
            starts.append(i)
    return starts


def edited(rows):
    """doc_id -> (length, sha256 of the edited text), ids unique."""
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for nth, (name, text) in enumerate(ordered):
        text, following = text or "", ordered[(nth + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        out[name] = (len(text), hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest())
    return out


def weighted_jaccard(first, second):
    a, b = Counter((first or "").split()), Counter((second or "").split())
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def cross_phrases(sample, text):
    """Greedy longest matches, as the fewest substrings of the sample (or single strange letters)."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        at = max(end - 1, at + 1)
        count += 1
    return count


def best_inner_products(rows, divisor, k):
    """rows: (vec_id, vector or None); list of (query, rank, vec_id, score)."""
    usable = [
        (name, [math.floor(256 * x) for x in v])
        for name, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, (name, query) in enumerate(usable):
        if name % divisor:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(query, v)), other)
            for j, (other, v) in enumerate(usable)
            if i != j and len(v) == len(query)
        )[:k]
        out += [(name, rank, other, -score) for rank, (score, other) in enumerate(scores, 1)]
    return sorted(out)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lexical_search(docs, items, k):
    """docs: (doc_id, text), ids unique; items: (item_id, text); sorted (item, rank, doc, score)."""
    counts = {d: Counter(TERM.findall((t or "").translate(LOWER))) for d, t in docs}
    counts = {d: c for d, c in counts.items() if c}
    total, all_terms = len(counts), sum(c.total() for c in counts.values())
    having = Counter(t for c in counts.values() for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counts.items():
            m = 100 - 50 + (50 * c.total() * total) // all_terms
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & set(c):
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * having[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, d))
        out += [(item, rank, d, -score) for rank, (score, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + 1 :] == b[same + 1 :] if len(a) == len(b) else a[same:] == b[same + 1 :]


def variants(rows, ratio=5):
    """rows: (word, n); (word, form, root, n, n_near, form_n)."""
    times = dict(rows)
    near = {w: [o for o in times if one_edit(w, o)] for w in times}
    form = {}
    for w, those in near.items():
        best = min(those, key=lambda o: (-times[o], o), default=None)
        form[w] = best if best is not None and times[best] >= ratio * times[w] else None
    out = []
    for w, n in rows:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), times[form[w]] if form[w] else None))
    return out


def reputations(hosts):
    """hosts: host -> (pages, bad); host -> (rate, bound), level by level."""
    names = {h: ("", h.rsplit(".", 1)[-1], ".".join(h.split(".")[-2:]), h) for h in hosts}
    rate = {}
    for level in range(4):
        counts = defaultdict(lambda: [0, 0])
        above = {}
        for h, (n, b) in hosts.items():
            counts[names[h][level]][0] += n
            counts[names[h][level]][1] += b
            above[names[h][level]] = names[h][level - 1]
        if level == 0:
            n, b = counts[""]
            now = {"": (b + 1) / (n + 10)}
        else:
            over = more = 0
            for name, (n, b) in counts.items():
                p = rate[above[name]]
                if n:
                    over += (b - n * p) ** 2 / (n * p * (1 - p)) - 1
                    more += n - 1
            weight = 1 / min(0.5, max(0.001, over / more if more else 0)) - 1
            now = {name: (b + rate[above[name]] * weight) / (n + weight) for name, (n, b) in counts.items()}
        rate = now
    return {h: (r, r - 2 * math.sqrt(r * (1 - r) / (hosts[h][0] + weight + 1))) for h, r in rate.items()}
