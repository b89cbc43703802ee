"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def spans_of(mask) -> int:
    return int((np.diff(np.concatenate([[0], np.asarray(mask, int)])) == 1).sum())


def substrings(docs, length=50):
    """[(key, n_bytes, n_removed, n_spans, kept)]; a null key stands above all others."""
    order, first = lambda d: float("inf") if d is None else d, {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            first[b[i:i + length]] = min(first.get(b[i:i + length], float("inf")), order(d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < order(d):
                gone[i:i + length] = True
        out.append((d, len(b), int(gone.sum()), spans_of(gone), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def passages(docs, length=20):
    """[(key, n_words, n_removed, kept)]"""
    order = lambda d: float("inf") if d is None else d
    words, first = [(d, WORD.findall(t or "")) for d, t in docs], {}
    for d, w in words:
        for i in range(len(w) - length + 1):
            at = tuple(w[i:i + length])
            first[at] = min(first.get(at, (float("inf"), float("inf"))), (order(d), i))
    out = []
    for d, w in words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < (order(d), i):
                gone[i:i + length] = True
        out.append((d, len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()))
    return out


def contamination(docs, items, window=13):
    """[(key, n_words, n_hit, items)]"""
    windows = {}
    for i, t in items:
        w = ITEM_WORD.findall(ascii_lower(t))
        for k in range(max(1, len(w) - window + 1) if w and i is not None else 0):
            windows.setdefault(tuple(w[k:k + window]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = ITEM_WORD.findall(ascii_lower(t)), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if at := windows.get(tuple(w[k:k + size])):
                    found |= at
                    hit |= set(range(k, k + size))
        out.append((d, len(w), len(hit), sorted(found)))
    return out


def fingerprint(text) -> int:
    w = WORD.findall(ascii_lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(near: np.ndarray, keys) -> list:
    """The smallest key that each row reaches; near: links between rows, each row linked to itself."""
    label = np.array([np.inf if k is None else k for k in keys], float)
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return [None if np.isinf(x) else int(x) for x in label]
        label = new


def secrets(text):
    """Spans (start, kind number, end) of the fixed patterns."""
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api"))
    key = key + "_?[kK][eE][yY]"
    out = []
    for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


def _luhn(digits) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal(text):
    """Spans (start, kind number, end) of the fixed patterns."""
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m)) <= 19 and _luhn(digits(m)):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def fold(key) -> int:
    return zlib.crc32(str(key).encode()) % 3
