"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def near_groups(rows):
    """{row number: smallest id reachable by links} for (id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    lead = list(range(len(rows)))

    def root(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                lead[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return {i: least.get(root(i)) if sets[i] else rows[i][0] for i in range(len(rows))}


def cut_repeats(texts, length=200):
    """(removed flags) of each text's bytes."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        flags = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                flags[i:i + length] = b"\1" * length
        out.append(flags)
    return out


def measures(text):
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_marks of a text."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    places = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(places),
            sum(c in "!?" for c in text))
