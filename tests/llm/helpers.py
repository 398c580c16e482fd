"""Brute-force versions and small tables for the corpus operators."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Null and empty texts, blanks alone, repeated ids and rows, a null id, ties, names that operators use themselves.
ODD_ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "en", None),
    (5, "Alpha beta gamma delta epsilon zeta", None, "a"),
    (5, "Alpha beta gamma delta epsilon zeta", None, "a"),
    (None, "one two three", "fr", "b"),
    (7, "word " * 3000, "en", "b"),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string"


def odd(spark):
    docs = spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)
    for name in ("id", "row", "kept", "score", "node", "length", "place", "counts", "spans", "n", "key", "_salt"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def shingles(text):
    w = words((text or "").translate(LOW))
    if len(w) >= 5:
        return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    return frozenset([tuple(w)] if w else [])


def components(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_components(texts):
    """id -> least id reachable over pairs with a similarity of 0.8."""
    sets = {i: shingles(t) for i, t in texts.items()}
    lists = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            lists[s].append(i)
    common = Counter((a, b) for at in lists.values() for k, a in enumerate(at) for b in at[k + 1 :])
    links = [(a, b) for (a, b), o in common.items() if 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o)]
    return components(list(sets), links), sets
