"""Plain versions of the operators, for small inputs."""

import re
from itertools import combinations

STRICT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def shingles(text):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_duplicates(docs):
    """{doc_id: (set size, component)} of unique ids."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def spans(text):
    """Strict spans as (start, kind number, end)."""
    out = []
    for k, (kind, pattern) in enumerate(STRICT.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    twice = {x for x in windows if windows.count(x) > 1}
    covered = {j for i, x in enumerate(windows) if x in twice for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed,
    )


def labels(blocks, stops):
    """Which blocks of a page are main text: rules on each block, then the nearest decided block of its container."""
    first = []
    for text, linked, bad, main, _ in blocks:
        w = [x.strip(".,;:!?") for x in text.lower().split()]
        if bad or linked > 0.5 * len(text):
            first.append(False)
        elif len(text) < 70:
            first.append(None)
        else:
            first.append(bool(main) or stops is None or sum(x in stops for x in w) >= 0.15 * len(w))
    out = []
    for i, (own, block) in enumerate(zip(first, blocks, strict=True)):
        main = block[3]
        if own is None:
            near = [
                (abs(i - j), first[j])
                for j in range(len(blocks))
                if blocks[j][3] == main and first[j] is not None and (first[j] or not main)
            ]
            own = min(near)[1] if near else bool(main)
        out.append(own)
    return out
