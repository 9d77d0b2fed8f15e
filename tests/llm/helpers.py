"""Small tables and plain versions of the contracts."""

import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(30000))
CASES = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "s", 70),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", None, None),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", None, None),
    (3, None, None, None, None),
    (None, None, None, None, None),
    (None, "null id and some words of its own", None, "s", None),
    (4, "", "en", "s", 0),
    (5, " \t\n ", None, "s", 4),
    (6, "ünï ß 日本語 🙂\nline\nline\n", "de", "s", 3),
    (7, LONG, "en", "t", len(LONG)),
    (8, LONG, "en", "t", len(LONG)),
]


def table(spark, rows=CASES, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """df with further columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    names = ("score", "predicted", "h", "c", "spans", "n_tokens", "kept", "n_removed", "handle", "k1", "toxic", "uid")
    return df.withColumns({n: F.lit("own") for n in names})


def shingles(text):
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def groups(texts):
    """Root position of each text by Jaccard links of 0.75."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], sets


def uncovered(texts, length=200):
    """For each text as bytes, whether each byte is kept."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        keep = [True] * len(d)
        for p in range(len(d) - length + 1):
            if count[d[p : p + length]] > 1:
                keep[p : p + length] = [False] * length
        out.append(keep)
    return out
