"""The classifier on invented text, and the pipeline's stages against the operators' brute force."""

import random
import zlib

import pytest
from llm_rows import awkward, nothing, package  # noqa: F401
from test_near import jaccard_by_force, smallest
from test_tokens import check_sequences

import corpus_pipeline
from starmill.llm import secret_scan, toxicity

PLAIN = ["the", "river", "stone", "walks", "under", "bridge", "evening", "garden", "holds", "quiet", "table", "window", "reads"]
BAD = ["grumbleface", "stinkweasel", "dolt"]


def text(seed, toxic):
    r = random.Random(seed)
    out = [r.choice(PLAIN) + r.choice(["", "ing", "ed"]) for _ in range(r.randrange(20, 150))]
    for _ in range(max(2, len(out) // 15) if toxic else 0):
        out.insert(r.randrange(len(out)), r.choice(BAD))
    return " ".join(out) + f" n{seed}"


@pytest.fixture(scope="module")
def model():
    return toxicity.fit([(text(i, i % 4 == 0 or i % 4 == 1), int(i % 4 in (0, 1))) for i in range(400)])


def test_held_out_accuracy(model):
    rows = [(text(i, i % 2), i % 2) for i in range(1000, 1200)]
    right = sum((toxicity.one(t, model) >= 0.5) == bool(y) for t, y in rows)
    assert right >= 190
    assert toxicity.one("", model) == toxicity.one(" \n", model) < 0.5


def test_model_repeats(model):
    assert model == toxicity.fit([(text(i, i % 4 == 0 or i % 4 == 1), int(i % 4 in (0, 1))) for i in range(400)])


def test_too_little_to_learn():
    assert toxicity.fit([]) is None
    assert toxicity.fit([("a", 1)] * 10) is None
    assert toxicity.fit([("a", k // 2 % 2) for k in range(12)]) is None


def test_score_rows(awkward, nothing, model):
    got = toxicity.score(awkward, model).collect()
    assert len(got) == awkward.count() and all(0 <= r.score < 0.5 for r in got)
    assert {r.score for r in toxicity.score(awkward, None).collect()} == {0.0}
    assert toxicity.score(nothing, model).count() == toxicity.keep_below(nothing, model).count() == 0
    assert sorted(map(str, toxicity.keep_below(awkward, model).collect())) == sorted(map(str, awkward.collect()))


def test_sample_is_bounded_and_repeats(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(51, None), (None, 1), (999, 1), (3, 1)], "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels, 10)
    assert rows == toxicity.sample(docs.repartition(3), labels.repartition(3), 10)
    assert 16 <= len(rows) <= 20 and {y for _, y in rows} == {0, 1}
    assert toxicity.sample(docs.limit(0), labels) == []


def test_sample_takes_one_text_of_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(300)] + [(2, "other"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels, 5)
    assert sorted(y for _, y in rows) == [0, 1]
    assert rows == toxicity.sample(docs.repartition(3), labels, 5)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small corpus with copies, near copies, toxic texts and secrets; labels are never those of fold 0 alone."""
    root = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, text(i, i % 4 == 0)) for i in range(600)]
    rows += [(700 + i, rows[4 * i + 1][1] + " token=abcdef99" * (i % 2)) for i in range(40)]
    rows += [(800, None), (801, ""), (802, rows[1][1]), (3, rows[3][1])]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)], "doc_id long, quality int, toxic int").write.parquet(
        f"{root}/labels.parquet")
    return root


def test_stages(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, tables).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
        if k < len(names) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = ([(r.doc_id, r.text) for r in x.collect()] for x in out[0])
    assert set(after) <= set(before)
    gone = {i for i, _ in before} - {i for i, _ in after}
    toxic = {i for i, t in before if any(w in (t or "") for w in BAD)}
    assert len(gone ^ toxic) <= 0.05 * len(toxic)

    before, after = ([(r.doc_id, r.text) for r in x.collect()] for x in out[1])
    sets, links = jaccard_by_force(before)
    want = smallest(sets, links)
    assert sorted(i for i, _ in after) == sorted(i for i, c in want.items() if i == c)

    before, after = ({r.doc_id: (r.text, r.n_chars) for r in x.collect()} for x in out[2])
    assert before.keys() == after.keys()
    for i, (t, _) in before.items():
        new = t if t is None else secret_scan.redact_text(t, secret_scan.find_spans(t))
        assert after[i] == (new, len(new or ""))

    packed = out[3][1].collect()
    assert {r.doc_id for r in packed} == after.keys()
    assert check_sequences(packed, 2048) == -(-sum(r.length for r in packed) // 2048)


def test_run_equals_the_stages(spark, tables):
    rows = corpus_pipeline.run(spark, tables).collect()
    assert rows and check_sequences(rows, 2048)
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_pipeline_of_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_folds():
    assert zlib.crc32(b"17") % 5 == zlib.crc32(str(17).encode()) % 5
