"""The pipeline, stage by stage, against plain Python on the same documents."""

from collections import defaultdict

import corpus_pipeline
from shelfmark.llm import quality_gam
from shelfmark.llm.common import Stored
from shelfmark.llm.oracles import ORACLES
from shelfmark.llm.queries import QUERIES
from tests.llm import test_near_dedup, test_packing_and_sharding, test_substring_dedup
from tests.llm.fixtures import awkward, clashing, frame
from tests.oracle import both, connect


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact_copies", "near_copies", "repeated_passages", "packing"]
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = Stored(stage(spark, docs, sf), name).df()
        tables[name] = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    model = quality_gam.train(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    good = {d for d, r in rows.items() if model.scores(quality_gam.np.array([quality_gam.features(r["text"].encode())]))[0] >= 0.3}
    assert {r["doc_id"] for r in tables["quality"]} == good
    bad = {r["doc_id"] for r in labels.collect() if r["quality"] == 0}
    assert len(bad & good) <= 0.1 * len(bad)
    clean = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    assert len(clean - good) <= 0.02 * len(clean)

    last = {}
    for d in sorted(good):
        last[rows[d]["text"].encode().lower()] = d
    assert {r["doc_id"] for r in tables["exact_copies"]} == set(last.values())

    left = [(d, rows[d]["text"]) for d in sorted(last.values())]
    assert {r["doc_id"] for r in tables["near_copies"]} == {x[0] for x in test_near_dedup.brute(left) if x[3]}

    left = [(r["doc_id"], r["text"]) for r in tables["near_copies"]]
    removed = {x[0]: x[2] for x in test_substring_dedup.brute(left)}
    assert {r["doc_id"] for r in tables["repeated_passages"]} == set(removed)
    before = dict(left)
    for r in tables["repeated_passages"]:
        assert len(before[r["doc_id"]].split()) - len(r["text"].split()) == removed[r["doc_id"]]
    test_packing_and_sharding.check_pieces(tables["packing"], [(r["doc_id"], r["text"]) for r in tables["repeated_passages"]])


def test_run_is_the_stages(spark, sf):
    whole = corpus_pipeline.run(spark, sf)
    sums = defaultdict(int)
    for r in whole.collect():
        sums[r["doc_id"]] += r["length"]
    assert all(sums[r["doc_id"]] == r["doc_tokens"] for r in whole.collect())


def table(spark, path, rows, labels):
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_awkward_tables(spark, tmp_path):
    """Nulls, empty and long texts, copies, repeated rows and shared ids go through all stages; nothing is lost but copies."""
    rows = awkward() + awkward()[:10] + [(7, "another text for an id that is there", "en", "s", 5)]
    sf_dir = table(spark, tmp_path / "a", rows, [])  # without labels nothing is rejected
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = Stored(stage(spark, docs, sf_dir), name).df()
        left[name] = docs.collect()
    assert len(left["quality"]) == len(rows)
    assert sorted((r["text"] or "").lower() for r in left["exact_copies"] if (r["text"] or "").isascii()) == sorted({(t or "").lower() for _, t, *_ in rows if (t or "").isascii()})
    assert len({(r["text"] or "").encode().lower() for r in left["exact_copies"]}) == len(left["exact_copies"]) == len({(t or "").encode().lower() for _, t, *_ in rows})
    assert len(left["repeated_passages"]) == len(left["near_copies"]) < len(left["exact_copies"])
    assert sum(r["start"] == 0 for r in left["packing"]) == len(left["repeated_passages"])


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, table(spark, tmp_path / "e", [], [])).collect() == []


def test_columns_with_the_stages_own_names(spark, tmp_path):
    sf_dir = table(spark, tmp_path / "c", awkward(), [(7, 1, 0)])
    docs = clashing(frame(spark))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = Stored(out, "clash").df()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()


def test_sql_agrees(spark, sf):
    c = connect(sf)
    for name, sql in ORACLES.items():
        mine, theirs = both(QUERIES[name](spark, sf), sql, c)
        assert mine == theirs, name


def test_every_operator_has_its_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
