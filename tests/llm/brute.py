"""Plain versions of what the operators compute, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Texts that are null, empty, long, repetitive, or hold more than ASCII.
TEXTS = [None, "", "   \n\t ", "one", "two words", "The IDIOT said: it's 10 o'clock!", "a b c d e f g h i j k l m n o p",
         "é à ü ß 日本語 ñandú", "x" * 3000, "word " * 400, "line one\nline two\n\nline one\n  line one  "]
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(AZ))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(rows, percent=75):
    """{doc_id: (size, component)} of (doc_id, text) rows with distinct ids."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def statistics(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {k for v in places.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def windows_hit(text, items, size=10):
    """(words, hit words, item ids) of one text against {item_id: text}."""
    w = PLAIN.findall((text or "").translate(AZ))
    hit, found = set(), set()
    for item, other in items.items():
        v = PLAIN.findall((other or "").translate(AZ))
        n = min(size, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(item)
    return len(w), len(hit), found
