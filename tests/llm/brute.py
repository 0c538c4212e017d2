"""Plain versions of what the operators compute, and the rows the tests share."""

import math
import re
from collections import Counter, defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"

# Null, empty, blank, tiny, repeated and very long texts; ids that repeat or are missing.
EDGES = [
    (1, None), (2, ""), (3, " \t\n\x0b "), (4, "word"), (5, "Word"), (6, "a b c d"), (7, "A b\tc\nd"),
    (8, "one two three four five six seven eight nine ten"), (9, "one two three four five six seven eight nine ten"),
    (9, "one two three four five six seven eight nine ten"), (None, "one two three four five six seven eight nine ten"),
    (None, None), (10, "x " * 30_000), (11, "y" * 60_000), (12, "Ünïcödé 中文 😀 text\r\nwith lines\r\n" * 3),
    (13, " ".join(f"w{i}" for i in range(300))), (14, " ".join(f"w{i}" for i in range(300)) + " tail"),
    (15, " ".join(f"w{i}" for i in range(150))), (16, "same line here\nsame line here\n\nother line"),
]


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, size=5):
    w = words((text or "").translate(LOW))
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def component_roots(ids, pairs):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def kneser_ney(training, order):
    """(probability of a word after a history, count, N, V) by the textbook formula."""
    once = Counter(w for t in training for w in t)
    counts = {order: Counter()}
    for t in training:
        x = ["<s>"] * (order - 1) + t
        for k in range(order - 1, len(x)):
            counts[order][tuple(x[k - order + 1:k + 1])] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discount, context = {}, {}
    for n, c in counts.items():
        n1, n2, n3, n4 = (sum(v == k for v in c.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
        discount[n] = [0.0] + [min(k, max(0.1, k - (k + 1) * y * b / a)) if a else 0.5 * k
                               for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
        context[n] = defaultdict(lambda: [0, 0, 0, 0])
        for g, v in c.items():
            context[n][g[:-1]][0] += v
            context[n][g[:-1]][min(v, 3)] += 1

    def p(history, word):
        n = len(history) + 1
        lower = p(history[1:], word) if n > 1 else 1 / (len(once) + 1)
        z = context[n].get(history)
        if not z:
            return lower
        c = counts[n].get(history + (word,), 0)
        return (max(c - discount[n][min(c, 3)], 0) + sum(discount[n][k] * z[k] for k in (1, 2, 3)) * lower) / z[0]

    return p, once


def log10_sum(p, order, tokens):
    x = ("<s>",) * (order - 1) + tuple(tokens)
    return sum(math.log10(p(x[k - order + 1:k], x[k])) for k in range(order - 1, len(x)))
