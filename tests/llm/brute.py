"""Plain Python versions of what the operators return, written without their helpers."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k=5):
    w = words(lowered(text))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def components(docs, share=75):
    """{(doc_id, row): (n_shingles, smallest doc_id)} from all pairs that share a shingle."""
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    top = list(range(len(docs)))

    def find(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in holders[x] if j < i)
        for j, n in both.items():
            if 100 * n >= share * (len(s) + len(sets[j]) - n):
                top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=repr)


def repeats(docs, size=35):
    every = [words(t) for _, t in docs]
    count = Counter(tuple(w[i : i + size]) for w in every for i in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(docs, every, strict=True):
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=repr)


def quality_counts(text):
    w = words(text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    twice = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(twice)


def edits(docs):
    """(doc_id, n_chars, digest of the edited text); ids distinct and not null."""
    order = sorted(((d, t or "") for d, t in docs), key=lambda x: -x[0])
    out = []
    for i, (d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        third = len(t) // 3
        out.append((d, len(t), sha(t[: len(t) - third] + following[:third])))
    return sorted(out, key=repr)
