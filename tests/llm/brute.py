"""Plain Python versions of the operators' results, by their definitions and nothing shared with the operators."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def folded(text):
    return FOLDED.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text):
    return PLAIN.findall(text or "")


def shingles(text, width=5):
    words = folded(text)
    width = min(width, len(words))
    return Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) if words else Counter()


def jaccard(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def near_classes(docs, threshold=0.8):
    """Smallest id of the component of each (id, text); wordless texts stand alone. Rows of equal words count once."""
    bags = [(i, shingles(t), tuple(folded(t))) for i, t in docs]
    top = list(range(len(bags)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    seen = {}
    for x, (_, _, words) in enumerate(bags):
        if words:
            top[x] = seen.setdefault(words, x)
    distinct = sorted(seen.values(), key=lambda x: sum(bags[x][1].values()))
    sizes = {x: sum(bags[x][1].values()) for x in distinct}
    for k, x in enumerate(distinct):
        for y in distinct[k + 1:]:
            if sizes[x] < threshold * sizes[y]:
                break
            if find(x) != find(y) and jaccard(bags[x][1], bags[y][1]) >= threshold:
                top[find(x)] = find(y)
    smallest = {}
    for x, (i, _, words) in enumerate(bags):
        if words and i is not None:
            smallest[find(x)] = min(i, smallest.get(find(x), i))
    return [(i, smallest.get(find(x)) if words else i) for x, (i, _, words) in enumerate(bags)]


def contamination(text, items, width=10):
    words = folded(text)
    places = defaultdict(set)
    for n in range(1, width + 1):
        for i in range(len(words) - n + 1):
            places[tuple(words[i:i + n])].add(i) if n == width or n in items.get("short", ()) else None
    hit, found = set(), set()
    for name, windows in items["windows"]:
        for w in windows:
            for i in places.get(w, ()):
                hit.update(range(i, i + len(w)))
                if name is not None:
                    found.add(name)
    return len(words), len(hit), len(found), sha256(",".join(sorted(found))), bool(hit)


def benchmark_windows(rows, width=10):
    windows = []
    for name, text in rows:
        words = folded(text)
        n = min(width, len(words))
        windows.append((None if name is None else str(name), {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()))
    return {"windows": windows, "short": {len(w) for _, ws in windows for w in ws if len(w) < width}}


def rule_base(text):
    words = plain(text)
    lines, seen, dups = (text or "").split("\n"), set(), 0
    for line in lines:
        if PLAIN.search(line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            hit.update(range(i, i + 8))
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dups, len(hit),
        len(words) < 20 or 100 * len(hit) > 30 * len(words),
    )


def jump_hash(key: int, buckets: int) -> int:
    """The published loop on unsigned 64-bit numbers."""
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def pages(rows):
    """(page_id, bytes, digest, type, refers) of (page_id, html)."""
    out, first = [], {}
    for i, html in rows:
        payload = (html or "").encode()
        if payload not in first or (i is not None and (first[payload] is None or i < first[payload])):
            first[payload] = i if i is not None else first.get(payload)
    used = set()
    for i, html in rows:
        payload = (html or "").encode()
        response = first[payload] == i and payload not in used
        if response:
            used.add(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "response" if response else "revisit", None if response else first[payload]))
    return out


def secret_spans(text):
    """Base spans (start, kind number, end) in code points."""
    text, found = text or "", []
    assign = re.compile(
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def spans_text(spans, kinds=("assign", "access", "hex")):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def passages(texts, width=35):
    """(n_words, n_removed, sha256) per text."""
    split = [plain(t) for t in texts]
    counts = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for words in split:
        gone = set()
        for i in range(len(words) - width + 1):
            if counts[tuple(words[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(words), len(gone), sha256(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return out


def crc32(text: str) -> int:
    return zlib.crc32(text.encode())
