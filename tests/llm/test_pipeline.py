"""The pipeline's stages: each decision takes effect, clean documents stay."""

import pytest

import corpus_pipeline
from lotbook.llm import jaccard, quality, secrets, toxicity
from lotbook.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before each stage and the last stage's rows."""
    docs, seen = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(docs)
        path = str(tmp_path_factory.mktemp("steps") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*seen, docs]


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_filters(spark, steps):
    labels = table(spark, SF, "labels")
    for before, after, scored in (
        (steps[0], steps[1], toxicity.toxicity_scores),
        (steps[1], steps[2], quality.quality_scores),
    ):
        good = 0 if scored is toxicity.toxicity_scores else 1
        kept = {r.doc_id for r in scored(before, labels).collect() if r.predicted == good}
        assert texts(after).keys() == kept and after.columns == before.columns
        assert 0 < len(kept) < before.count()
        assert all(texts(before)[i] == t for i, t in texts(after).items())


def test_one_of_each_group_stays(steps):
    found = jaccard.jaccard_components(steps[2]).collect()
    assert texts(steps[3]).keys() == {r.doc_id for r in found if r.doc_id == r.component_id}
    assert steps[3].count() < steps[2].count()


def test_secrets_are_gone(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert before.keys() == after.keys()
    for i, text in before.items():
        found = secrets.base_spans(text)
        assert (text == after[i]) or found or "[SECRET]" in after[i]
        assert not secrets.base_spans(after[i])
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())


def test_all_kept_is_packed(steps):
    rows = steps[5].collect()
    packed = {}
    for r in rows:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
        assert packed[r.doc_id] <= r.doc_tokens
    assert packed == {r.doc_id: r.doc_tokens for r in rows}
    assert packed.keys() == texts(steps[4]).keys()


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int, _row int"


def test_odd_rows_pass(spark):
    rows = [(None, "id is null", None, None, None, 1, 1), (1, None, "en", "s", None, 1, 1)]
    rows += [(2, "", "en", "s", 0, 1, 1), (3, "Some plain text.", "en", "s", 16, 1, 1)] * 2
    rows += [(4, "A long text of words. " * 20_000, "en", "s", 0, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.pack(spark, docs.limit(0), SF).count() == 0
    packed = corpus_pipeline.pack(spark, docs, SF).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in packed}.keys() == {None, 1, 2, 3, 4}


def test_rows_are_judged_one_by_one(spark):
    """Ids that repeat with other texts, copies without an id, repeated rows, blank texts."""
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    c, d = "fourteen fifteen sixteen seventeen eighteen", "all alone in this small table"
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, c), (None, d), (None, d), (4, ""), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1, 9) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs.repartition(4), SF)
    found = sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr)
    assert found == sorted([(1, a), (2, b), (3, c), (None, d), (4, ""), (4, "")], key=repr)
    assert kept.columns == docs.columns
