"""Plain single-process versions of the operators, over rows of small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def secrets_base(text: str | None):
    text = text or ""
    key = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    assign = rf"""({key}|{either("passwd")}|{either("secret")}|{either("token")}|{either("api")}_?{either("key")})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort()
    count = Counter(f[3] for f in found)
    return count["assign"], count["access"], count["hex"], sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in found))


def exact_groups(rows):
    """rows (doc_id, text) -> sorted (doc_id, keep_id, group_size, kept, sha)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep, seen = max((i for i in ids if i is not None), default=None), False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            out.append((i, keep, len(ids), kept, sha(text)))
    return sorted(out, key=str)


def mix_targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0):
    """sizes by source -> targets by source, by repeated resharing of the excess."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        rest, free = budget - sum(most * sizes[s] for s in capped), [s for s in order if s not in capped]
        if not free:
            return {s: most * sizes[s] for s in order}
        level = rest / sum(w[s] for s in free)
        more = {s for s in free if w[s] * level >= most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else w[s] * level for s in order}
        capped |= more


def chats(rows):
    """rows (conv_id, turn, role, text) -> {conv_id: (n_turns, turns_sha, loss_chars, loss_sha)}."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss))
    return out


def encoding():
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def repeats(rows, size=35):
    """rows (doc_id, text) -> sorted (doc_id, n_words, n_removed, sha of the kept words)."""
    words = [WORD.findall(text or "") for _, text in rows]
    count = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), sha(" ".join(kept))))
    return sorted(out, key=str)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, n=4):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(rows, n=4, percent=85):
    """rows (doc_id, text) -> sorted (doc_id, n_shingles, component_id); sets compared through shared shingles."""
    sets = [shingles(text, n) for _, text in rows]
    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in at[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((doc_id, len(s), least.get(root(i))) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))), key=str)


def spelling(rows, slip=97, length=5, times=3, ratio=2):
    """rows (doc_id, text) -> sorted (word, form, root, n, n_near, form_n), every two words compared."""
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run[:h % len(run)] + run[h % len(run) + 1:] if h % slip == 0 else run] += 1
    words = {w: n for w, n in count.items() if len(w) >= length and n >= times}
    cut = defaultdict(set)  # a single edit leaves the words equal once each loses at most one code point
    for w in words:
        for i in range(len(w)):
            cut[w[:i] + w[i + 1:]].add((w, i))
        cut[w].add((w, None))
    near = defaultdict(set)
    for same in cut.values():
        for a, i in same:
            for b, j in same:
                if a != b and (i is None or j is None or i == j):
                    near[a].add(b)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def runs(words, least=6, times=4):
    """All (start, length, period) of a list of words, each period tried at every place."""
    found, number = {}, {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    for q in range(1, len(w) // times + 1):
        edge = np.flatnonzero(np.diff(np.r_[0, w[q:] == w[:-q], 0]))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic(rows):
    """rows (doc_id, text) -> sorted (doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)."""
    out = []
    for doc_id, text in rows:
        w = WORD.findall(text or "")
        n, h = len(w), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        found = runs(w)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        out.append((doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
                    sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)
