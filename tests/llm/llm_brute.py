"""Plain Python versions of the text operators, written for clarity only."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- SimHash ----


def fingerprint(text, k):
    w = words(lower(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w)] if len(w) < k else [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_classes(prints, radius):
    """Smallest identifier reachable for each (id, fingerprint)."""
    group = {f: f for _, f in prints}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    distinct = sorted(group)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    least = {}
    for i, f in prints:
        least.setdefault(find(f), []).append(i)
    return {(i, f): min(least[find(f)]) for i, f in prints}


# ---- quality ----


def facts(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
    }


def em(votes, rounds, share, start, weight):
    """Document by document, with the shares of good, missing and bad votes of each class."""
    kinds, n = (1, 0, -1), len(votes[0])
    good = [dict(zip(kinds, start["good"])) for _ in range(n)]
    bad = [dict(zip(kinds, start["bad"])) for _ in range(n)]
    prior = share
    for _ in range(rounds):
        p = posterior(votes, prior, good, bad)
        prior = (sum(p) + share * weight) / (len(p) + weight)
        for k in range(n):
            for table, q, kind in ((good, p, "good"), (bad, [1 - x for x in p], "bad")):
                mass = {
                    v: weight * s + sum(x for x, d in zip(q, votes) if d[k] == v)
                    for v, s in zip(kinds, start[kind])
                }
                table[k] = {v: m / sum(mass.values()) for v, m in mass.items()}
    return prior, good, bad


def posterior(votes, prior, good, bad):
    out = []
    for d in votes:
        z = math.log(prior / (1 - prior)) + sum(math.log(g[v] / b[v]) for g, b, v in zip(good, bad, d))
        out.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
    return out


# ---- tokens ----


def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def codec(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    decoded = tok.decode(ids, skip_special_tokens=False)
    return len(ids), sha(",".join(map(str, ids))), sha(decoded)


def pieces(tok, text, capacity=4096):
    ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
    out = []
    for k, at in enumerate(range(0, len(ids), capacity)):
        part = ids[at : at + capacity]
        out.append((k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def best_fit(lengths, capacity):
    """Bins that best fit decreasing opens, one piece at a time."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in left if r >= n]
        if fits:
            left.remove(min(fits))
            left.append(min(fits) - n)
        else:
            left.append(capacity - n)
    return len(left)


# ---- personal data ----


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(m):
    return re.sub("[^0-9]", "", m)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     lambda m: all(int(p.lstrip("0")[:9] or 0) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(_digits(m)) <= 15),
)


def base_spans(text):
    found = [
        (m.start(), k, m.end(), name)
        for k, (name, pattern, valid) in enumerate(BASE)
        for m in re.finditer(pattern, text or "")
        if valid(m.group())
    ]
    return ",".join(f"{name}:{s}:{e}" for s, _, e, name in sorted(found))


# ---- lines ----


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def dropped_lines(docs, min_words=5, edits=1):
    """``docs``: (order, text) in any order; the dropped line numbers of each."""
    seen, out = [], {}
    for key, text in sorted(docs):
        own = []
        for n, line in enumerate((text or "").split("\n")):
            w = words(line)
            if len(w) < min_words:
                continue
            if any(w == s or (edits and one_edit(w, s)) for s in seen):
                own.append(n)
            seen.append(w)
        out[key] = own
    return out
