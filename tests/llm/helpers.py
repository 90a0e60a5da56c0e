"""Plain versions of what the operators compute, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) >= 5:
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def classes(items, linked):
    """The smallest member of each item's class under the closure of ``linked``."""
    parent = {i: i for i in items}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in items:
        for b in items:
            if a < b and find(a) != find(b) and linked(a, b):
                high, low = sorted((find(a), find(b)), reverse=True)
                parent[high] = low
    return {i: find(i) for i in items}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]
