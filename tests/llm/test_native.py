import re
from collections import Counter

from namebridge.llm import decontamination, license_scan, quality_rules
from tests.llm.helpers import CASES, WORDS, clashing, table

ITEM = ("Yesterday Alice Smith bought 12 apples for 3.50 dollars and then Alice walked 5 km to the old market "
        "where Bob sold 12 pears.")
OTHER = ("Yesterday Carla Jones bought 40 apples for 9.99 dollars and then Carla walked 7 km to the old market "
         "where Tom sold 40 pears.")
MIXED = OTHER.replace("Carla walked", "Peter walked").replace("sold 40", "sold 41")


def test_decontamination(spark):
    docs = clashing(spark.createDataFrame(
        [(1, f"before. {ITEM} after"), (1, f"before. {ITEM} after"), (2, f"one two three. {OTHER} more"), (3, MIXED),
         (4, None), (5, ""), (6, "unrelated words " * 3000), (None, ITEM)], "doc_id long, text string"))
    items = spark.createDataFrame([(9, ITEM), (10, "too short"), (11, None)], "item_id long, text string")
    got = decontamination.matches(docs, items).collect()
    assert sorted(((r.doc_id, r.item_id, r.exact) for r in got), key=str) == [(1, 9, True), (2, 9, False), (None, 9, True)]
    kept = decontamination.clean(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6] and kept.columns == docs.columns
    shuffled = decontamination.TemplateConfig(broadcast_rows=0)
    assert decontamination.matches(docs, items, shuffled).count() == 3
    assert decontamination.matches(docs.limit(0), items).collect() == []
    assert decontamination.clean(docs, items.limit(0)).count() == docs.count()


def test_renamed_questions_whose_names_start_sentences(spark):
    item = ("Tom has 3 red apples in a big bag. Anna gives him 5 more apples after lunch. Tom eats 2 of them on the way. "
            "How many are left?")
    renamed = item.replace("Tom", "Maria").replace("Anna", "Felix").replace("3", "8").replace("5", "8").replace("2", "4")
    quoted = '"' + renamed.replace(". ", '.  "')
    lower = item.replace("How many", "so how many")
    mixed = renamed.replace("Maria eats 4", "Paul eats 4")
    docs = spark.createDataFrame([(1, item), (2, f"It rains. {renamed} Yes."), (3, quoted), (4, lower), (5, mixed)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.matches(docs, items).collect()}
    assert {k: r.exact for k, r in got.items()} == {1: True, 2: False, 3: False, 4: True, 5: False}
    assert got[5].n_windows < got[5].total_windows  # without those that name Maria otherwise
    assert got[2].n_windows == got[3].n_windows == got[1].n_windows == got[1].total_windows


def test_number_before_a_full_stop_is_the_same_value(spark):
    item = "the farmer filled 12 boxes with plums and then sold 12. after that 7 boxes with plums came back to the farmer"
    docs = spark.createDataFrame([(1, item.replace("12", "30"))], "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    got, = decontamination.matches(docs, items).collect()
    assert got.n_windows == got.total_windows and not got.exact


def test_only_texts_with_half_a_window_of_an_item_are_searched(spark):
    """A copied item is found wherever it starts; texts that share no half window leave before windows are made."""
    item = "Anna took the red boat over the lake while it rained all day long"
    copies = [(i, "x " * i + item, None, None, None) for i in range(11)]
    others = [(i, f"word{i} the red cup " * 9, None, None, None) for i in range(20, 30)]
    docs = spark.createDataFrame(copies + others, "doc_id long, text string, lang string, source string, n_chars int")
    items = spark.createDataFrame([(1, item.lower())], "item_id long, text string")
    config = decontamination.TemplateConfig()
    near = decontamination._candidates(decontamination._keyed(docs), decontamination._items(items, config), config)
    assert sorted(r.doc_id for r in near.collect()) == list(range(11))
    assert sorted(r.doc_id for r in decontamination.matches(docs, items).collect()) == list(range(11))


def test_a_passage_of_a_long_item_is_found(spark):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500)]
    words[100:125] = ("and Tom paid 12 dollars for the red kite while Tom kept 5 more coins for bread and gave Anna "
                      "all of the rest").split()
    passage = " ".join(words[100:125])
    other = passage.replace("Tom", "Paul").replace("12", "90").replace("Anna", "Ida")
    texts = {1: words[200:213], 2: words[200:212], 3: passage.split(), 4: other.split(), 5: other.split()[:15]}
    docs = spark.createDataFrame([(k, f"here is a part. {' '.join(t)} and on it goes") for k, t in texts.items()],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(words))], "item_id long, text string")
    got = decontamination.matches(docs, items).collect()
    assert {r.doc_id: r.exact for r in got} == {1: True, 3: True, 4: False}
    assert sorted(r.doc_id for r in decontamination.clean(docs, items).collect()) == [2, 5]


def quality(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    seen = {w for w, n in Counter(windows).items() if n > 1}
    covered = {p for k, w in enumerate(windows) if w in seen for p in range(k, k + 8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    rows = [*CASES, (9, "a b c d e f g h a b c d e f g h x", "en", "s", 1), (10, "to be " * 30 + "\n#|<\n#|<\nx", None, "s", 1),
            (11, "x " * 9, "en", "s", 1)]
    got = quality_rules.judge(clashing(table(spark, rows))).collect()
    key = lambda x: str(x)
    expected = sorted(((r[0], *quality(r[1])) for r in rows), key=key)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=key) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(25))
    line = " ".join(f"shared{k}" for k in range(30))
    rows = [(i, f"{line}\n{own(i)}", "en", None, 1) for i in range(30)]  # more than half is shared
    rows += [(100 + i, f"{line}\n{own(i)}", "en", "b", 1) for i in range(15)]  # below the limit of its host
    rows += [(200 + i, f"{line[:30]}\n{own(200 + i)}", "en", "c", 1) for i in range(30)]
    df = table(spark, rows)
    got = {r.doc_id: r for r in quality_rules.judge(df).collect()}
    assert all(got[i].depleted and not got[i].kept and got[i].n_removed_words == 30 for i in range(30))
    assert all(got[100 + i].kept and got[100 + i].n_removed_words == 0 for i in range(15))
    assert all(got[200 + i].kept and got[200 + i].n_removed_words > 0 for i in range(30))
    clean = {r.doc_id: r.text for r in quality_rules.clean_lines(df).collect()}
    assert set(clean) == set(got) - set(range(30)) and clean[200] == own(200) and clean[100] == f"{line}\n{own(0)}"
    assert quality_rules.judge(table(spark, [])).collect() == []


_PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    hits = [(i, label) for i in range(len(words)) for p, label in _PHRASES.items() if tuple(words[i : i + len(p)]) == p]
    at = [h[0] for h in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({h[1] for h in hits}))


def test_license_scan(spark):
    texts = {
        "Licensed under the Apache License, Version 2.0. All Rights Reserved": "apache-2.0,reserved",
        "under the GNU General Public License, version 3 or any later version.": "gpl,gpl-3.0-or-later",
        "GNU Lesser General Public License v2.1": "gpl,lgpl-2.1",
        "CC-BY 4.0": "cc-by,cc-by-4.0",
        "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0-or-later",
        "dedicated to the public domain": "public-domain",
        "Copyright (c) 2020 someone": "copyright-notice",
        "no such words here, cc": "",
    }
    rows = [(i, t) for i, t in enumerate(texts)] + [(50, "cc by " * 3000), (51, None), (None, "ALL rights\nreserved cc")]
    got = license_scan.scan(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text in rows:
        r = by_id[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text)
        assert text not in texts or r.labels == texts[text]
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert len(license_scan.rules()) > 300 and license_scan.scan(table(spark, [])).collect() == []


def test_lines_of_large_hosts_go_from_a_fixed_number_of_documents_on(spark):
    """120 documents of a host of 4000 hold a line: not 2 percent, but above the fixed limit of 100."""
    import duckdb

    from namebridge.llm import quality_rules

    rows = []
    for i in range(4000):
        own = " ".join(f"word{i}x{k}" for k in range(30))
        rows.append((i, (" ".join(["common", *[f"w{k}" for k in range(40)]]) + "\n" + own if i % 33 == 0 else own),
                     None, "large" if i else "small", None))
    docs = table(spark, rows)
    often = quality_rules.QualityConfig(line_most=100)
    gone = quality_rules.judge(docs, often).where("n_removed_words > 0").count()
    assert gone == sum(1 for r in rows if "common" in r[1] and r[3] == "large") == 121
    assert quality_rules.judge(docs).where("n_removed_words > 0").count() == 121  # 121 is above 2 percent of 3999
    rare = [r for i, r in enumerate(rows) if i % 66 or not i]
    held = sum("common" in r[1] and r[3] == "large" for r in rare)
    docs = table(spark, rare)
    assert quality_rules.judge(docs).where("n_removed_words > 0").count() == 0
    con = duckdb.connect()
    for limit, expected in ((1000, 0), (30, held)):
        con.execute("create or replace table documents as select * from (values (0, '', '', '', 0)) t(doc_id, text, lang, source, n_chars) where false")
        con.executemany("insert into documents values (?, ?, ?, ?, ?)", [(a, b, c or "", d, e or 0) for a, b, c, d, e in rare])
        sql = quality_rules.SQL.replace("holders > 1000", f"holders > {limit}")
        got = sorted((r.doc_id, r.n_removed_words, r.kept) for r in quality_rules.judge(
            docs, quality_rules.QualityConfig(line_most=limit)).collect())
        result = con.execute(f"select doc_id, n_removed_words, kept from ({sql}) q order by 1").fetchall()
        assert got == result and sum(n > 0 for _, n, _ in got) == expected
