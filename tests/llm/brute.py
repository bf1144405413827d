"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import xxhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [s for s in text.split("\n") if WORD.search(s)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def components(sets, percent):
    """Least id of the component of each id; ``sets`` maps ids to sets."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in sets.items():
        for t in s:
            holders.setdefault(t, []).append(i)
    for i, s in sets.items():
        for j, common in Counter(j for t in s for j in holders[t] if j < i).items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def shingles(text, size):
    words = WORD.findall(lower(text or ""))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k:k + size]) for k in range(len(words) - size + 1))


def windows_of(items, size=10):
    found = {}
    for item, text in items:
        words = BENCH_WORD.findall(lower(text or ""))
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            found.setdefault(tuple(words[k:k + n]), set()).add(item if item is None else str(item))
    return found


def contamination(text, windows):
    words = BENCH_WORD.findall(lower(text or ""))
    hit, items = set(), set()
    for n in {len(w) for w in windows}:
        for k in range(len(words) - n + 1):
            if found := windows.get(tuple(words[k:k + n])):
                items |= found
                hit.update(range(k, k + n))
    return len(words), len(hit), sorted(i for i in items if i is not None)


def repeats(rows, length=100):
    """Bytes, removed bytes, runs and digest of what is left, by id; rows in order."""
    seen, out = set(), {}
    for i, text in rows:
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s:s + length] in seen:
                covered[s:s + length] = b"\1" * length
            else:
                seen.add(raw[s:s + length])
        runs = sum(1 for k in range(len(raw)) if covered[k] and (not k or not covered[k - 1]))
        out[i] = len(raw), sum(covered), runs, hashlib.sha256(bytes(b for b, c in zip(raw, covered) if not c)).hexdigest()
    return out


def spark_hash(*values):
    """Spark's xxhash64 of int32 (as ("i", n)), long and text values; null keeps the seed."""
    h = 42
    for v in values:
        if v is None:
            continue
        raw = v[1].to_bytes(4, "little", signed=True) if isinstance(v, tuple) else v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True)
        h = xxhash.xxh64_intdigest(raw, seed=h)
    return h - 2**64 if h >= 2**63 else h
