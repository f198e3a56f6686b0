"""Plain versions of what the operators find, and small texts with copies and odd rows."""

from __future__ import annotations

import random

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return (text or "").encode().split()


def components(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def similar(sets, percent=80):
    nodes = [n for n in sorted(sets) if sets[n]]
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                yield a, b


def prose(rng, n, vocabulary=None):
    known = vocabulary or [f"w{k}" for k in range(4000)]
    return " ".join(rng.choice(known) for _ in range(n))


def edited(rng, text, changes):
    parts = text.split(" ")
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = f"x{rng.randrange(10**6)}"
    return " ".join(parts)


def corpus(seed=1, families=6, copies=12):
    """Families of near and exact copies, passages that documents share, and odd texts."""
    rng = random.Random(seed)
    passage, line = prose(rng, 45), prose(rng, 14)
    texts = []
    for _ in range(families):
        base = prose(rng, rng.randrange(30, 120))
        texts.append(base)
        for _ in range(copies):
            kind = rng.randrange(5)
            if kind == 0:
                texts.append(base)
            elif kind == 1:
                texts.append(edited(rng, rng.choice(texts), rng.randrange(1, 9)))
            elif kind == 2:
                texts.append(prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 9))
            elif kind == 3:
                texts.append(prose(rng, 11) + "\n" + edited(rng, line, rng.randrange(2)) + "\n" + base.upper())
            else:
                texts.append(prose(rng, rng.randrange(1, 6)))
    odd = ["", None, " \n\t ", "a", "a", "A b", "a  b\n", "the " * 300, "the " * 150, "é à ü " * 30]
    odd += ["é à ü " * 31, "x" * 900, "x" * 450, "\n".join([line] * 5), "ab\x00c " * 40, prose(rng, 9000)]
    texts += odd
    rng.shuffle(texts)
    return texts
