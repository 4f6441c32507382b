"""Plain versions of the operators, over lists of rows."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(_LOWER))


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def shingle_set(text, size):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def components(rows, percent, size):
    """(doc_id, set size, component) of each (doc_id, text)."""
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def tiling(item, doc, least):
    """Words of `item` covered by greedy string tiles, by definition: search every pair of places again and again."""
    p, t = words(item), words(doc)
    mp, mt, covered = [False] * len(p), [False] * len(t), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not mp[i + k] and not mt[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return covered, len(p)
        covered += k
        mp[i : i + k] = [True] * k
        mt[j : j + k] = [True] * k


def repeats(rows, length=100):
    """(doc_id, bytes, removed, spans, digest); rows of distinct ids, in order of id."""
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        mark = bytearray(len(b))
        for o in range(len(b) - length + 1):
            w = b[o : o + length]
            if w in seen:
                mark[o : o + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        n = sum(1 for i in range(len(mark)) if mark[i] and (i == 0 or not mark[i - 1]))
        out.append((d, len(b), sum(mark), n, hashlib.sha256(kept).hexdigest()))
    return out


_ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def unigram(rows):
    """Base figures of the language model: {row number: (tokens, known, score)} and the training tokens."""
    tokens = [[*words(t), None] for _, t in rows]
    c = collections.Counter()
    for (d, _), w in zip(rows, tokens, strict=True):
        if d is None or fold(d, 7) != 2:
            c.update(w)
    n, v = sum(c.values()), len(c)
    return [(len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) for w in tokens], n


def poisson_count(u, mean):
    k, p = 0, math.exp(-mean)
    total = p
    while u >= total and k < 10 * mean + 100:
        k += 1
        p *= mean / k
        total += p
    return k


def tree_scores(rows, depth=3, least=2, bits=0.1, weight=2.0):
    """log10 probability of each text under the suffix tree, by its definition: recursion over contexts."""
    tokens = [tuple([*words(t), None]) for _, t in rows]
    trains = [w for (d, _), w in zip(rows, tokens, strict=True) if d is None or fold(d, 7) != 2]
    runs = collections.Counter(w[i : i + k] for w in trains for k in range(1, depth + 2) for i in range(len(w) - k + 1))
    n = sum(v for k, v in runs.items() if len(k) == 1)
    once = sum(v == 1 for k, v in runs.items() if len(k) == 1)
    unknown = (once + 1) / (n + 2)
    after = collections.defaultdict(dict)
    for run, v in runs.items():
        if len(run) > 1 and v >= least:
            after[run[:-1]][run[-1]] = v

    def back(u):
        return (runs[u] - sum(after[u].values()) + weight) / (runs[u] + weight)

    def stored(u, w):
        """Smoothed probability of a run that occurs often enough, whether its context is kept or not."""
        if not u:
            return runs[(w,)] * (1 - unknown) / max(n, 1)
        return after[u][w] / (runs[u] + weight) + back(u) * stored(u[1:], w)

    kept = set()
    for u, follow in list(after.items()):
        below = {w: stored(u[1:], w) for w in follow}
        share = {w: v / runs[u] for w, v in follow.items()}
        gain = sum(s * math.log2(s / max(below[w], 1e-12)) for w, s in share.items())
        left = 1 - sum(share.values())
        if left > 1e-9:
            gain += left * math.log2(left / max(1 - sum(below.values()), 1e-9))
        if gain >= bits:
            kept.update(u[i:] for i in range(len(u)))

    def score(u, w):
        while u and u not in kept:
            u = u[1:]
        if not u:
            return math.log10(stored((), w) if runs[(w,)] else unknown)
        return math.log10(stored(u, w)) if w in after[u] else math.log10(back(u)) + score(u[1:], w)

    return [sum(score(w[max(0, i - depth) : i], w[i]) for i in range(len(w))) for w in tokens]


def centroids(rows, k=8, rounds=10, size=64, seed=3):
    """(id, cluster, distance, inertia of the cluster, inertia, digest) of each (id, vector) that is kept."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for left in range(rounds, -1, -1):
        near = [min((far(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        if left:
            for j in range(len(centres)):
                own = [v for (_, v), (_, c) in zip(kept, near, strict=True) if c == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    total = collections.Counter()
    for d, j in near if kept else ():
        total[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, j, d, total[j], sum(total.values()), digest[j]) for (i, _), (d, j) in zip(kept, near if kept else (), strict=True)]


def collocations(rows, least, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of the (text, lang) rows."""
    counts, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(w)
            counts.update((lang, w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    often = {g: a for g, a in counts.items() if a >= least}
    around = collections.Counter()
    for (lang, g), a in often.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                around[lang, g[i : i + k]] = max(around[lang, g[i : i + k]], a)
    found = collections.defaultdict(list)
    for (lang, g), a in often.items():
        if len(g) > 1 and around[lang, g] < a:
            cut = min((1000 * a * total[lang] // (often[lang, g[:k]] * often[lang, g[k:]]), k) for k in range(1, len(g)))
            found[lang].append((-cut[0], -a, " ".join(g).encode(), often[lang, g[: cut[1]]], often[lang, g[cut[1] :]]))
    return sorted((lang, n, p.decode(), -a, left, right, total[lang], -s) for lang, own in found.items() for n, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1))


_PII = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def personal(text):
    """(kind, start, end) of the pattern matches, by kind and start."""
    out = []
    for kind, pattern in enumerate(_PII):
        for m in pattern.finditer(text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
            fits = (
                True,
                all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else False,
                13 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                9 <= len(digits) <= 15,
            )
            if fits[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def good_texts(rows, most=20):
    """{id: text without common lines} of the (id, text, source) rows that the quality rules keep."""
    fold_ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789\t\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz000000000    ")
    form = lambda line: line.translate(fold_).strip(" ")
    texts = collections.defaultdict(set)
    for _, text, host in rows:
        for line in (text or "").split("\n"):
            if WORD.search(line):
                texts[host or "", form(line)].add(text)
    out = {}
    for d, text, host in rows:
        w = WORD.findall(text or "")
        windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeated = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = (text or "").split("\n")
        common = [bool(WORD.search(x)) and len(texts[host or "", form(x)]) > most for x in lines]
        lost = sum(len(WORD.findall(x)) for x, c in zip(lines, common, strict=True) if c)
        if len(w) >= 50 and 100 * len(repeated) <= 50 * len(w) and len(w) - lost >= 50 and lost <= 0.7 * len(w):
            out[d] = "\n".join(x for x, c in zip(lines, common, strict=True) if not c)
    return out
