"""Plain versions of the operators, for comparison on small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def substring(rows, window=20):
    """{doc_id: (n_words, n_removed, sha256)} of unique (doc_id, text) rows."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        kept = [w for w, g in zip(words, gone) if not g]
        out[doc_id] = (len(words), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def simhash(rows, radius=4):
    """{doc_id: (fingerprint, component_id)}."""
    ids, fps = [], []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or ""))
        grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        votes = [0] * 64
        for g in grams:
            h = xxhash.xxh64_intdigest(g.encode(), 42)
            for k in range(64):
                votes[k] += h >> k & 1
        ids.append(doc_id)
        fps.append(sum(1 << k for k in range(64) if 2 * votes[k] > len(grams)))
    arr = np.array(fps, np.uint64)
    links = [(i, int(j)) for i in range(len(arr)) for j in np.flatnonzero(np.bitwise_count(arr[i] ^ arr) <= radius)]
    return {d: (f"{f:016x}", ids[r]) for d, f, r in zip(ids, fps, roots(len(ids), links))}


def embeddings(rows, threshold=0.95):
    """{vec_id: (n_links, component_id)}."""
    rows = sorted(rows, key=lambda r: r[0])
    unit = []
    for _, v in rows:
        x = None if v is None or any(c is None for c in v) else np.array(v, float)
        ok = x is not None and len(x) and np.isfinite(x).all() and np.abs(x).max() > 0
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    n, links = [0] * len(rows), []
    for i, x in enumerate(unit):
        for j in range(i):
            if x is not None and unit[j] is not None and len(x) == len(unit[j]) and x @ unit[j] >= threshold:
                n[i] += 1
                n[j] += 1
                links.append((i, j))
    return {r[0]: (n[i], rows[k][0]) for (i, r), k in zip(enumerate(rows), roots(len(rows), links))}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = []
    for rank, (kind, pattern, least) in enumerate((("assign", ASSIGN, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 20), ("hex", re.compile("[0-9a-f]+"), 24))):
        for m in pattern.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), rank, kind, m.end()))
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def piece_rows(tokenizer, doc_id, text, length=4096):
    ids = np.array(ids_of(tokenizer, text), "<u4")
    return {
        (doc_id, k): (s, len(ids[s : s + length]), zlib.crc32(ids[s : s + length].tobytes()))
        for k, s in enumerate(range(0, len(ids), length))
    }


def chats(rows):
    """{conv_id: n_turns} of maximal conversations of (conv_id, turn, role, text) rows."""
    convs = defaultdict(list)
    for c, t, r, x in sorted(set(rows)):
        convs[c].append((r or "", x or ""))
    kept = {}
    for c, turns in convs.items():
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in convs.values())
        earlier = any(o == turns and k < c for k, o in convs.items())
        if not longer and not earlier:
            kept[c] = len(turns)
    return kept


def collocations(rows, longest=3, least=10, top=2000):
    """{(lang, rank): (phrase, a, l, r, n, score)} of (text, lang) rows."""
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    found = defaultdict(list)
    for (lang, p), a in candidates.items():
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        inside = any(
            lang == other and len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (other, q), b in candidates.items()
        )
        if not inside:
            score, _, left, right = min(cuts)
            found[lang].append((-score, -a, " ".join(p).encode(), left, right))
    out = {}
    for lang, xs in found.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(xs)[:top], 1):
            out[lang, rank] = (p.decode(), -a, left, right, n[lang], -score)
    return out


def lexical(docs, items, top=10):
    """[(item_id, rank, doc_id, score)] of (doc_id, text) and (item_id, text) rows."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    split = lambda t: term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(d, Counter(split(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(split(t))
    out = []
    for i, terms in wanted.items():
        found = []
        for d, b in bags:
            m = 100 - 90 + 90 * sum(b.values()) * n_docs // max(1, n_terms)
            score = 0
            for t in terms & set(b):
                w = int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df[t] + 1))))
                score += w * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:top], 1)]
    return out
