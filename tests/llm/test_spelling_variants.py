import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from namebridge.llm import spelling_variants as sv
from tests.llm.helpers import CASES, LOWER, clashing, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows, least=7, count=2):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    near = defaultdict(list)
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[:i]:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def sample():
    pick = random.Random(5)
    stems = ["".join(pick.choice("abßéÿ") for _ in range(pick.randint(6, 9))) for _ in range(25)]
    texts = []
    for i in range(150):
        words = []
        for _ in range(40):
            word = pick.choices(stems, [1 / (k + 1) for k in range(len(stems))])[0]
            if pick.random() < 0.2:
                k = pick.randrange(len(word))
                word = pick.choice([word[:k] + word[k + 1 :], word[:k] + "b" + word[k:], word[:k] + "a" + word[k + 1 :]])
            words.append(pick.choice([word, word.upper(), word.title()]))
        texts.append((i, " ".join(words) + "×" + pick.choice([" x1y", "-aaaaaaa", " aaaaaaaa", " aaaaaaaaa"])))
    chain = ["kettenwor"] * 3 + ["kettenwort"] * 40 + ["kettenworte"] * 450
    return [*texts, *[(1000 + i, " ".join(chain[i::9])) for i in range(9)]]


@pytest.mark.parametrize("tile", [128, 8, 1])
def test_variants_equal_all_comparisons(spark, tile):
    rows = [*sample(), *[(c[0], c[1]) for c in CASES]]
    docs = clashing(table(spark, [(d, t, None, None, None) for d, t in rows])).repartition(3)
    config = sv.SpellingConfig(tile=tile)
    got = sorted(map(tuple, sv.variants(sv.word_counts(docs, config), config).collect()))
    expected = plain_variants(plain_counts(rows))
    assert got == expected and any(r[1] for r in got) and any(r[1] and r[1] != r[2] for r in got)


def test_chains_end_at_their_roots(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w4")], "word string, form string")
    assert {r.root for r in sv.roots(forms).collect()} == {"w9"}


def test_block_of_words_that_differ_in_one_place(spark):
    words = [("stammwort" + chr(0x61 + i % 26) + chr(0xE0 + i // 26) + "ende", 2 + i) for i in range(200)]
    df = spark.createDataFrame(words, "word string, n long")
    got = sorted(map(tuple, sv.variants(df, sv.SpellingConfig(tile=16)).collect()))
    assert got == plain_variants(dict(words))


def test_long_words_and_empty_tables(spark):
    long = "abc" * 20_000
    docs = table(spark, [(i, f"{long} {long}x", None, None, None) for i in range(2)])
    got = sv.variants(sv.word_counts(docs, sv.SpellingConfig(altered=None))).collect()
    assert sorted((len(r.word), r.n, r.n_near, r.form) for r in got) == [(60000, 2, 1, None), (60001, 2, 1, None)]
    assert sv.variants(sv.word_counts(table(spark, []))).collect() == []
    assert sv.variants(sv.word_counts(table(spark, [(1, None, None, None, None)]))).collect() == []
