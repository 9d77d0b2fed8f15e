import pytest

import corpus_pipeline
from namebridge.llm.components import components
from tests.llm.helpers import clashing, groups, table, uncovered

ITEM = "Alice had twelve red apples and gave seven of them to her brother who lived near the old stone bridge by the river"


@pytest.fixture
def tables(spark, tmp_path):
    own = lambda i, n=40: " ".join(f"own{i}k{k}" for k in range(n))
    passage = " ".join(f"passage{k}" for k in range(60))
    rows = [(i, own(i), "en", "s", len(own(i))) for i in range(60)]
    rows += [(100, own(1), "en", "s", 1), (101, own(2) + " tail", "en", "s", 1)]
    rows += [(110, f"{own(110)} {passage} {own(111)}", "en", "s", 1), (112, f"{own(112)} {passage}", "en", "s", 1)]
    rows += [(120, f"{own(120)} {ITEM} {own(121)}", "en", "s", 1)]
    rows += [(200 + i, f"{own(200 + i, 15)} vileword badword", "en", "s", 1) for i in range(40)]
    rows += [(300, None, None, None, None), (None, "null id with words", None, None, None), (301, "", "en", "s", 0)]
    docs = clashing(table(spark, rows))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 0, 0) for i in range(60)] + [(200 + i, 0, 1) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        out.write.parquet(f"{tables}/{name}")
        docs = spark.read.parquet(f"{tables}/{name}")
        steps[name] = {(r.doc_id, r.text) for r in docs.collect()}
        assert {r.h for r in docs.collect()} == {"own"}
    ids = {name: {d for d, _ in rows} for name, rows in steps.items()}
    assert not ids["toxicity"] & set(range(200, 240)) and len(ids["toxicity"]) == 68
    rows = sorted(steps["toxicity"], key=str)
    roots, sets = groups([t for _, t in rows])
    assert len(steps["jaccard"]) == len(set(roots)) and not ids["jaccard"] & {100, 101}
    rows = sorted(steps["jaccard"], key=str)
    left = {}
    for (d, t), keep in zip(rows, uncovered([t for _, t in rows]), strict=True):
        data = (t or "").encode()
        left[d] = bytes(b for b, k in zip(data, keep, strict=True) if k).decode()
    assert {d: t or "" for d, t in steps["suffixes"]} == left
    assert ids["decontamination"] == ids["suffixes"] - {120}
    assert steps["sentencepiece"] == steps["decontamination"]
    assert {r.round_trip for r in docs.collect()} == {True}


def test_run_gives_the_last_stage(spark, tables):
    got = corpus_pipeline.run(spark, tables)
    assert {"doc_id", "text", "n_tokens", "token_ids"} <= set(got.columns) and got.where("doc_id = 100").count() == 0


def test_components(spark):
    links = [(1, 2), (3, 2), (5, 4), (6, 5), (9, 9), *[(k, k + 1) for k in range(20, 40)]]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert got == {2: 1, 3: 1, 5: 4, 6: 4, **{k: 20 for k in range(21, 41)}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
