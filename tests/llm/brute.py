"""Plain versions of the operators, for small tables."""

import hashlib
import re
import unicodedata
import zlib
from collections import Counter
from fractions import Fraction

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def contaminated(docs, items, window=13):
    out = []
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes = {len(g) for g in grams}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = grams.get(tuple(w[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def bag(text, k=5):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)])


def similarity(a, b):
    common = sum((a & b).values())
    whole = sum(a.values()) + sum(b.values()) - common
    return common / whole if whole else 0.0


def near_classes(docs, least=0.8):
    """doc_id -> class id, by comparing all pairs."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    bags = [(d, bag(t), words(t), t or "") for d, t in docs]
    for i, (a, x, wa, ta) in enumerate(bags):
        root(a)
        for b, y, wb, tb in bags[:i]:
            same = wa == wb if wa or wb else ta == tb
            if same or (x and y and similarity(x, y) >= least):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {d: root(d) for d, *_ in bags}


def phrases(text, base):
    w, starts, labels = words(text), [], set()
    for phrase, label in base.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), labels


def has_letter(text):
    return any(unicodedata.category(c).startswith("L") for c in text or "")


SPACED = re.compile(r"[^\x20\x09-\x0D]+")
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(digests):
    """Root, and per leaf the siblings before and after it, level by level."""
    paths, place, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, p in enumerate(place):
            run = level[p // 16 * 16 : p // 16 * 16 + 16]
            paths[i].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
            place[i] = p // 16
        level = [sha("".join(level[a : a + 16])) for a in range(0, len(level), 16)]
    return level[0] if level else None, paths


def manifest(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of rows given as dicts."""
    cell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(cell(r[c]) for c in FIELDS))
    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r["text"], r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda t: t[:3])
        trees[s] = _tree([t[2] for t in sources[s]])
    root, tops = _tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (_, _, own, _, r), path in zip(sources[s], trees[s][1]):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            value = leaf({**r, "text": r["text"] and r["text"].translate(FOLD)}) if tampered else own
            for before, after in path + top:
                value = sha(before + value + after)
            out.append((r["doc_id"], own, trees[s][0], root, sha("".join(b + a for b, a in path + top)), value, value == root))
    return out


def base_quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = SPACED.findall(text or "")
    lines = [l for l in (text or "").split("\n") if SPACED.search(l)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {p for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again),
        len(w) < 20 or 100 * len(again) > 30 * len(w),
    )


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def runs(w):
    """(start, length, period) by trying every period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and smallest_period(w[i : i + length]) == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(doc_id, text):
    w = SPACED.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        a, g = h // 10 % len(w), h // 10
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    found = runs(w)
    dropped = {p for s, n, q in found for p in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (
        doc_id, len(found), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)),
    )
