"""The queries' results worked out row by row, from their definitions. Rows are dicts; results go by position."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def least_id(row) -> int:
    return -(2**63) if row["doc_id"] is None else row["doc_id"]


def secrets(row) -> tuple:
    text = row["text"] or ""
    spans = []
    names = "password|passwd|secret|token|api_?key"
    either = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in names)
    for m in re.finditer(rf"({either})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            spans.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            spans.append((m.start(), 2, "hex", m.end()))
    kinds = Counter(s[2] for s in spans)
    listed = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))
    return row["doc_id"], kinds["assign"], kinds["access"], kinds["hex"], sha(listed)


def strings(rows, length=400, keep="none") -> list[tuple]:
    texts = [(r["text"] or "").encode() for r in rows]
    seen = defaultdict(list)
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            seen[t[s:s + length]].append((least_id(rows[i]), s, i))
    gone = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            first = min(places)[:2]
            for id_, s, i in places:
                if keep == "none" or (id_, s) != first:
                    gone[i][s:s + length] = b"\1" * length
    return [(r["doc_id"], len(t), sum(g), len(re.findall(b"\1+", bytes(g))),
             sha(bytes(b for b, x in zip(t, g, strict=True) if not x))) for r, t, g in zip(rows, texts, gone, strict=True)]


def passages(rows, window=50) -> list[tuple]:
    first: dict[tuple, int] = {}
    texts = [WORD.findall(r["text"] or "") for r in rows]
    for r, w in zip(rows, texts, strict=True):
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, 2**63), least_id(r))
    out = []
    for r, w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < least_id(r):
                gone[s:s + window] = [True] * window
        out.append((r["doc_id"], len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def shingles(text, size=5) -> frozenset:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def near(rows, percent=85) -> list[tuple]:
    sets = [shingles(r["text"]) for r in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for held in holders.values() for k, a in enumerate(held) for b in held[k + 1:]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            up[top(a)] = top(b)
    least: dict[int, int] = {}
    for i, r in enumerate(rows):
        least[top(i)] = min(least.get(top(i), 2**63), least_id(r))
    out = []
    for i, r in enumerate(rows):
        component = least[top(i)] if sets[i] else least_id(r)
        out.append((r["doc_id"], len(sets[i]), None if component == -(2**63) else component, component == least_id(r)))
    return out


def quality(row) -> tuple:
    text = row["text"] or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (row["doc_id"], len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered), failed)


def quality_verdicts(rows, line_docs=50, line_share=0.01, least_left=0.3) -> list[tuple]:
    """As `quality`, with the words in lines that too many distinct texts of a host have, and the verdict."""
    def said(row):
        text = row["text"] or ""
        lines = [line for line in text.split("\n") if WORD.search(line)]
        return [(re.sub("[0-9]", "0", " ".join(WORD.findall(line)).lower()), len(WORD.findall(line))) for line in lines]

    hosts = Counter(r["source"] for r in rows)
    texts = defaultdict(set)
    for r in rows:
        for line, _ in said(r):
            texts[r["source"], line].add(r["text"])
    out = []
    for r in rows:
        figures = quality(r)
        removed = sum(n for line, n in said(r) if len(texts[r["source"], line]) > line_docs
                      and len(texts[r["source"], line]) > line_share * hosts[r["source"]])
        out.append((*figures[:-1], removed, figures[-1], not figures[-1] and figures[1] - removed >= least_left * figures[1]))
    return out


def conversations(rows) -> list[tuple]:
    by_id = defaultdict(list)
    for r in rows:
        by_id[-(2**63) if r["conv_id"] is None else r["conv_id"]].append(
            (-1 if r["turn"] is None else r["turn"], r["role"] or "", r["text"] or ""))
    out = []
    for conv_id, turns in by_id.items():
        turns.sort()
        learned = "".join(t for _, role, t in turns if role == "assistant")
        out.append((conv_id, len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)), len(learned), sha(learned)))
    return out


def targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Share all words by weight, stop at the limits, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got = dict.fromkeys(names, 0.0)
    free, left = set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / total >= most * sizes[s]}
        if not full:
            got.update({s: left * weight[s] / total for s in free})
            break
        got.update({s: float(most * sizes[s]) for s in full})
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return got
