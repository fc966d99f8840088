"""Plain, slow versions of the operators' contracts, for comparing on small tables."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def substring_words(docs: list[tuple], window: int = 35) -> list[tuple]:
    split = [WORDS.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(docs, split, strict=True):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((doc, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def substring_bytes(docs: list[tuple], window: int = 400) -> list[tuple]:
    raw = [(t or "").encode() for _, t in docs]
    seen = Counter(hash(b[i : i + window]) for b in raw for i in range(len(b) - window + 1))
    out = []
    for (doc, _), b in zip(docs, raw, strict=True):
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - window + 1):
            if seen[hash(b[i : i + window])] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc, len(b), sum(gone), spans, sha(kept)))
    return out


def near_duplicates(docs: list[tuple], k: int = 5, share: int = 75) -> list[tuple]:
    sets = {}
    for doc, text in docs:
        w = WORDS.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    where = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            where[x].append(doc)
    common = Counter()
    for members in where.values():
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                common[a, b] += 1
    edges = [(a, b) for (a, b), n in common.items() if 100 * n >= share * (len(sets[a]) + len(sets[b]) - n)]
    root = components(sets, edges)
    return [(doc, len(s), root[doc], root[doc] == doc) for doc, s in sets.items()]


def components(nodes, edges) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def decontaminate(docs: list[tuple], items: list[tuple], n: int = 13) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, ids = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if own := windows.get(tuple(w[i : i + size])):
                    ids |= own
                    hit |= set(range(i, i + size))
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def personal_data(docs: list[tuple]) -> list[tuple]:
    out = []
    for doc, text in docs:
        text = text or ""
        digits = lambda m: re.sub("[^0-9]", "", m[0])
        found = [
            [("email", m) for m in EMAIL.finditer(text)],
            [("ip", m) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
            [("card", m) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
            [("phone", m) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15],
        ]
        base = [f"{k}:{m.start()}:{m.end()}" for part in found for k, m in part]
        out.append((doc, *map(len, found), sha(",".join(base))))
    return out


def warc(pages: list[tuple], least: int = 0) -> list[tuple]:
    first = {}
    for page, html in pages:
        p = (html or "").encode()
        if len(p) >= least:
            first[p] = min(page, first.get(p, page))
    out = []
    for page, html in pages:
        p = (html or "").encode()
        target = first.get(p, page)
        out.append((page, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if target == page else "revisit", None if target == page else target))
    return out


def vector_links(rows: list[tuple], least: float = 0.98) -> list[tuple]:
    import numpy as np

    unit, by_label = {}, defaultdict(list)
    for vec, values, label in rows:
        if values is None or label is None or any(x is None for x in values):
            continue
        v = np.array(values, float)
        if len(v) and np.isfinite(v).all() and np.linalg.norm(v) > 0:
            unit[vec] = v / np.linalg.norm(v)
            by_label[label, len(v)].append(vec)
    edges = []
    for own in by_label.values():
        m = np.array([unit[i] for i in own])
        for a in range(len(own)):
            edges += [(own[a], own[a + 1 + b]) for b in np.flatnonzero(m[a + 1 :] @ m[a] >= least)]
    root = components([r[0] for r in rows], edges)
    links = Counter(x for e in edges for x in e)
    return [(r[0], links[r[0]], root[r[0]], root[r[0]] == r[0]) for r in rows]
