"""Plain versions of the operators, for comparison."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width=5):
    w = words(text)
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def joined(docs):
    """{id: (least id reachable, sizes of its sets)}; docs is a list of (id, text)."""
    sets = [(d, shingles(x)) for d, x in docs if d is not None]
    up = {d: d for d, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            where[g].append(k)
    for k, (d, s) in enumerate(sets):
        for j, n in Counter(j for g in s for j in where[g] if j < k).items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                a, b = find(d), find(sets[j][0])
                up[max(a, b)] = min(a, b)
    return {d: find(d) for d, _ in sets}


def without_repeats(docs, length=100):
    """[(id, kept, removed, spans)] of (id, text) pairs of distinct ids."""
    first, out = set(), []
    for d, x in sorted(docs):
        b = (x or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            k = hashlib.blake2b(b[i:i + length], digest_size=12).digest()
            if k in first:
                gone[i:i + length] = b"\1" * length
            first.add(k)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((d, kept, sum(gone), len([s for s in bytes(gone).split(b"\0") if s])))
    return out


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = WORD.findall(text or "")
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated)
