"""Plain versions of the operators' contracts, one document at a time."""

import hashlib
import re
from collections import Counter

SPACED, LETTERED = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A2Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def low(text):
    return (text or "").translate(A2Z)


def license_base(text, phrases):
    """n_words, n_base, first, last, labels of the phrases."""
    w = LETTERED.findall(low(text))
    at, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = SPACED.findall(text)
    lines, seen, dup = [x for x in text.split("\n") if SPACED.search(x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    inside = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def targets(sizes, weights=(5, 2, 1)):
    """Target of each source by resharing the excess until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def contamination(text, items, window=10):
    """n_words, n_hit and the sorted identifiers of items of which a window occurs."""
    w = LETTERED.findall(low(text))
    hit, found = set(), set()
    for item, body in items:
        b = LETTERED.findall(low(body))
        n = min(window, len(b))
        wins = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if b else set()
        for i in range(len(w) - n + 1 if wins else 0):
            if tuple(w[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def fingerprint(text):
    import xxhash

    w = [x.encode() for x in SPACED.findall(low(text))]
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, most=2):
    """{doc_id: fingerprint} -> {doc_id: smallest identifier reachable}."""
    ids = sorted(prints)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def substrings(texts, size=50):
    """{doc_id: text} -> {doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}."""
    first, raw = {}, {d: (t or "").encode() for d, t in texts.items()}
    for d in sorted(raw):
        for i in range(len(raw[d]) - size + 1):
            first.setdefault(raw[d][i : i + size], d)
    out = {}
    for d, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = b"\1" * size
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d] = len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()
    return out


def license_scan(text, notices, phrases, gram=3, shift=3, coverage=0.6):
    """labels and score by diagonals, spans and longest rising runs, template by template."""
    w = LETTERED.findall(low(text))
    labels, score = set(), 0.0
    for table, base in ((phrases, True), (notices, False)):
        for template, label in table.items():
            t = template.split()
            n = len(t) - gram + 1
            votes = {}
            for p in range(len(w) - gram + 1):
                for k in range(n):
                    if w[p : p + gram] == t[k : k + gram]:
                        votes.setdefault(p - k, set()).add((p, k))
            groups, start, last = [], None, None
            for d in sorted(votes):
                if last is None or d - last > shift:
                    start = d
                last = d
                key = start, (d - start) // n
                if not groups or groups[-1][0] != key:
                    groups.append((key, set()))
                groups[-1][1].update(votes[d])
            for _, pairs in groups:
                runs = {}
                for p, k in sorted(pairs, key=lambda x: (x[0], -x[1])):
                    runs[k] = max(runs.get(k, 0), 1 + max((r for q, r in runs.items() if q < k), default=0))
                share = max(runs.values()) / n
                score = max(score, share)
                if share >= coverage and not base:
                    labels.add(label)
            if base and any(len(v) == n for v in votes.values()):
                labels.add(label)
    return ",".join(sorted(labels)), score


def near_items(texts, items, slop=20, rarest=3):
    """{doc_id: sorted identifiers of items whose rarest terms stand near each other}."""
    count = Counter(x for _, body in items for x in LETTERED.findall(low(body)))
    few = [(str(item), sorted(set(LETTERED.findall(low(body))), key=lambda x: (count[x], x.encode()))[:rarest]) for item, body in items]
    out = {}
    for d, text in texts.items():
        at = {}
        for i, x in enumerate(LETTERED.findall(low(text))):
            at.setdefault(x, []).append(i)
        out[d] = sorted({
            item for item, f in few if len(f) == rarest
            and any(all(any(abs(j - i) <= slop for j in at.get(x, ())) for x in f[1:]) for i in at.get(f[0], ()))
        })
    return out
