"""Plain versions of the operators, for comparison."""

from __future__ import annotations

import numpy as np

import collections
import hashlib
import math
import re
import zlib

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
WORDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_bytes(text: str | None) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def substrings(rows, window=35):
    """Sorted (doc_id, n_words, n_removed, kept hash)."""
    docs = [(d, SPACED.findall((t or "").encode())) for d, t in rows]
    seen = collections.Counter(tuple(w[i: i + window]) for _, w in docs for i in range(len(w) - window + 1))
    out = []
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i: i + window])] > 1:
                gone[i: i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text):
    w = SPACED.findall(lower_bytes(text))
    return frozenset(tuple(w[i: i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    """(doc_id, set size, smallest doc_id of the component) per row."""
    sets = [shingles(t) for _, t in rows]
    at = list(range(len(rows)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                at[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def contaminated(rows, items):
    """(doc_id, n_words, n_hit, n_items, items hash, contaminated) per row."""
    def words(t):
        return WORDED.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        if w:
            n = min(10, len(w))
            for s in range(len(w) - n + 1):
                windows[tuple(w[s: s + n])].add("" if i is None else str(i))
    sizes = {len(k) for k in windows}
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                got = windows.get(tuple(w[s: s + n]))
                if got:
                    hit |= set(range(s, s + n))
                    found |= got
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def unigram_scores(rows):
    """(doc_id, held out, tokens, known, N, base score) per row."""
    docs = [(d, [*SPACED.findall(lower_bytes(t)), "end"], d is None or zlib.crc32(str(d).encode()) % 5 == 1) for d, t in rows]
    c = collections.Counter(x for _, w, h in docs if not h for x in w)
    n, v = sum(c.values()), len(c)
    return [(d, h, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for d, w, h in docs]


def mixture_scores(rows, steps=4, rounds=50):
    """(doc_id, score) by deleted interpolation, token by token: dictionaries of counts, one pass of
    expectation-maximisation after another over every training token."""
    end = "end"
    texts = [(d, d is None or zlib.crc32(str(d).encode()) % 5 == 1, [*SPACED.findall(lower_bytes(t)), end]) for d, t in rows]
    uni, bi, ctx = collections.Counter(), collections.Counter(), collections.Counter()
    for _, held, words in texts:
        if not held:
            for u, w in zip([end, *words[:-1]], words, strict=True):  # a begin is a context as an end would be
                uni[w] += 1
                bi[u, w] += 1
                ctx[u] += 1
    n, v = sum(uni.values()), len(uni)

    def estimates(u, w, less):
        context = ctx[u] - less
        octave = context.bit_length()
        return octave, (1 / (v + 1), (uni[w] - less) / max(n - less, 1), (bi[u, w] - less) / context if context > 0 else 0.0)

    seen = collections.defaultdict(collections.Counter)  # octave -> ratios to the uniform estimate, to a quarter of an octave
    for _, held, words in texts:
        if not held:
            for u, w in zip([end, *words[:-1]], words, strict=True):
                octave, (p0, p1, p2) = estimates(u, w, 1)
                seen[octave][tuple(round(steps * math.log2(p / p0)) if p > 0 else None for p in (p1, p2))] += 1
    weights = collections.defaultdict(lambda: [1 / 3] * 3, {0: [0.5, 0.5, 0.0]})
    for octave, cells in seen.items():
        lam = list(weights[octave])
        for _ in range(rounds):
            gain = [float(x > 0) for x in lam]
            for key, many in cells.items():
                part = [x * r for x, r in zip(lam, (1.0, *(0.0 if k is None else 2.0 ** (k / steps) for k in key)), strict=True)]
                gain = [g + many * x / sum(part) for g, x in zip(gain, part, strict=True)]
            lam = [g / sum(gain) for g in gain]
        weights[octave] = lam
    out = []
    for d, _, words in texts:
        score = 0.0
        for u, w in zip([end, *words[:-1]], words, strict=True):
            octave, p = estimates(u, w, 0)
            score += math.log10(sum(x * y for x, y in zip(weights[octave], p, strict=True)))
        out.append((d, score))
    return out


def damaged_words(rows):
    """Counter of the words of the spelling contract."""
    out = collections.Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i + 1:] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1:]


def variants(words):
    """(word, form, root, n, n_near, form_n) per word of a dictionary of counts."""
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), None if form[w] is None else words[form[w]]))
    return out


def damaged_turns(rows):
    """{conv_id: rows (turn, role, text) after damage, in order}."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def faults(kept):
    seen, out = set(), []
    for _, role, text in kept:
        tail = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append("blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(initials, marks):
    """(cost, audit) by plain dynamic programming from the end; up to two empty turns at a place."""
    import functools

    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, last, room):
        options = [(0, "")] if i == len(initials) and last in ("", "a") else []
        if room:
            c, a = best(i, after[last], room - 1)
            options.append((c + 3, "I" + a))
        if i < len(initials):
            def add(cost, edit, to):
                c, a = best(i + 1, to, 2)
                options.append((c + cost, edit + a))

            add(4, "D", last)
            if marks[i] not in ("blank", "duplicate"):
                extra = 3 * (marks[i] == "truncated")
                if initials[i] == after[last] or (initials[i] == "s" and last == ""):
                    add(extra, "K", initials[i])
                add(3 + extra, "R", after[last])
        return min(options, default=(10**9, ""))

    return best(0, "", 2)


def repairs(rows):
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired hash) per conversation."""
    out = []
    for conv, kept in damaged_turns(rows).items():
        marks, initials = faults(kept), [r[1][:1] for r in kept]
        cost, audit = cheapest(tuple(initials), tuple(marks))
        lines, last, i = [], "", 0
        for edit in audit:
            if edit != "D":
                name = kept[i][1] if edit == "K" else {"u": "user", "a": "assistant"}["a" if last == "u" else "u"]
                lines.append(f"{name}:{'' if edit == 'I' else kept[i][2]}")
                last = name[0]
            i += edit != "I"
        turns = [r[0] for r in kept if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out.append((conv, gaps, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def targets(sizes):
    """{source: target} from {source: size}: shares by weight, full sources set aside until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        got = {s: 3.0 * sizes[s] if s in full else left * weight[s] / share for s in order}
        over = {s for s in order if s not in full and got[s] > 3 * sizes[s]}
        if not over:
            return got
        full |= over


def discriminant(x, labels, own=0.9, diagonal=0.05, ridge=1e-4):
    """Scores of all rows of ``x`` by two normal densities, from the rows with a label of 0 or 1 (pairs
    of row and label)."""
    rows = [np.array([x[i] for i, y in labels if y == c]) for c in (0, 1)]
    pooled = sum((len(r) - 1) * np.cov(r.T) for r in rows) / (sum(map(len, rows)) - 2)
    dens = []
    for r in rows:
        cov = own * np.cov(r.T) + (1 - own) * pooled
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.maximum(np.diag(pooled), ridge)) + ridge * np.eye(len(cov))
        away = x - r.mean(axis=0)
        dens.append(-0.5 * (away * np.linalg.solve(cov, away.T).T).sum(axis=1) - 0.5 * np.linalg.slogdet(cov)[1])
    odds = np.log((len(rows[1]) + 1) / (len(rows[0]) + 1))
    return 1 / (1 + np.exp(-np.clip(dens[1] - dens[0] + odds, -60, 60)))
