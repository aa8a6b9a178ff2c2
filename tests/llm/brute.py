"""Plain versions of the operators, for small inputs."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import xxhash

GAP = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def quality(text):
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def fingerprint(text):
    w = words(lower(text))
    if not w:
        return 0
    k = min(3, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_groups(rows):
    """rows: (id, text); component (smallest id or None) of each row."""
    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    named = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in set(group)}
    return fps, [named[g] for g in group]


def substrings(rows, size=50):
    """rows: (id, text); per row (n_words, n_removed, kept words)."""
    first = {}
    split = [words(t) for _, t in rows]
    for (i, _), w in zip(rows, split):
        for s in range(len(w) - size + 1):
            if i is not None:
                g = tuple(w[s:s + size])
                first[g] = min(first.get(g, i), i)
    out = []
    for (i, _), w in zip(rows, split):
        gone = set()
        for s in range(len(w) - size + 1):
            if i is not None and first[tuple(w[s:s + size])] < i:
                gone.update(range(s, s + size))
        out.append((len(w), len(gone), [x for k, x in enumerate(w) if k not in gone]))
    return out


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_spans(text):
    t = text or ""
    found = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), m.start()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), m.start()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(found)


def secret_row(text):
    s = secret_spans(text)
    n = collections.Counter(k for _, k, _, _ in s)
    digest = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b, _ in s)
    return n[0], n[1], n[2], hashlib.sha256(digest.encode()).hexdigest()


def redact(text):
    out, at = "", 0
    for a, b in sorted((v, e) for _, _, e, v in secret_spans(text)):
        if a >= at:
            out, at = out + text[at:a] + "[secret]", b
        else:
            at = max(at, b)
    return out + text[at:]


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def license_row(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    hits = [(i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in hits]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def pieces(text, tokenizer, capacity=2048):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    cuts = [ids[a:a + capacity] for a in range(0, len(ids), capacity)]
    return [(p, p * capacity, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for p, c in enumerate(cuts)]


def ranks(path):
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
