"""Toxicity and quality: decoder against exhaustive readings, chain against enumeration, and
held-out accuracy."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotbook.llm import quality, toxicity
from lotbook.llm.common import fold, table, training_rows

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, label int, id int, score string"


def test_viterbi_finds_the_best_reading():
    model = toxicity.log_model(toxicity.trigram_counts(["idiot moron loser bit of a tale"] * 9))
    for noisy in ("1d10t", "b!t", "l.o.s.e", "taaale", "m0r0n"):
        best = (-math.inf, "")
        for arcs in itertools.product(*toxicity.lattice(noisy)):
            read = "".join(c for c, _ in arcs)
            symbols = [0, 0, *map(toxicity._symbol, read), 0]
            score = sum(cost for _, cost in arcs)
            score += sum(float(model[x]) for x in zip(symbols, symbols[1:], symbols[2:]))  # noqa: B905
            best = max(best, (score, read))
        assert toxicity.viterbi(noisy, model) == best[1]


def test_restored_words():
    model = toxicity.log_model(toxicity.trigram_counts(["idiot moron loser worthless and"] * 9))
    restore = toxicity.Restorer(model).restore
    assert restore("You 1D10T, m0r0n! looooser") == "you idiot moron loser"
    assert restore("an i d i o t and w0rthl3ss") == "an idiot and worthless"
    assert restore("") == "" and restore("plain words. 12") == "plain words "
    assert "idiot" in restore("x " * 300 + "i.d.i.o.t")


def test_symbols_are_restored_wherever_they_stand():
    stock = "idiot kill hate loser stupid crap zealot goblin evil lobo fiesta bastard cretin magic"
    model = toxicity.log_model(toxicity.trigram_counts([stock + " and, some. of the (rest)! hate! evil!"] * 9))
    restorer = toxicity.Restorer(model)
    for noisy in ("idi07", "1d107", "idio+", "!diot", "id!ot", "|diot"):
        assert "idiot" in restorer.readings(noisy), noisy
    for word in stock.split():
        for symbol, letters in toxicity.LEET.items():
            for at in (i for i, c in enumerate(word) if c in letters):
                noisy = word[:at] + symbol + word[at + 1 :]
                # A closing exclamation mark may be one.
                if symbol != "!" or at + 1 < len(word):
                    assert word in restorer.readings(noisy), (word, noisy)
                spelt = restorer.unspelt("so " + " ".join(noisy) + " there")
                assert spelt.split() == ["so", word, "there"], (word, noisy)
    assert restorer.unspelt("h a g").split() == ["hag"]
    assert restorer.unspelt("1 2 3, | + | 4") == "1 2 3, | + | 4"
    for clean in ("hate!", "(rap)", "kill,", "evil."):
        assert restorer.readings(clean) == tuple(toxicity._LETTERS.findall(clean)), clean


def test_learn_ignores_words_of_copies():
    copies = [(7, ["odd ", "bad "])] * 9
    others = [(i, ["bad "]) for i in range(20, 30)]
    shares = {"odd ": (9, 0), "bad ": (19, 0)}
    lexicon, base = toxicity.learn(shares, copies + others, 19, 100)
    assert set(lexicon) == {"bad "} and base < 0.1


@pytest.mark.parametrize("length", [1, 2, 5])
def test_marginals_equal_enumeration(length):
    rng = np.random.default_rng(length)
    unary, moves = rng.normal(size=2 * length), rng.normal(size=(2, 2))
    good, pairs = quality.forward_backward(unary, moves, np.repeat([0, 1], length))
    for chain in range(2):
        part = unary[chain * length : (chain + 1) * length]
        weight = {
            y: math.exp(
                sum(u for u, v in zip(part, y, strict=True) if v)
                + sum(moves[a, b] for a, b in zip(y, y[1:]))  # noqa: B905
            )
            for y in itertools.product((0, 1), repeat=length)
        }
        total = sum(weight.values())
        for t in range(length):
            want = sum(w for y, w in weight.items() if y[t]) / total
            assert good[chain * length + t] == pytest.approx(want)
        for t in range(length - 1):
            want = sum(w for y, w in weight.items() if (y[t], y[t + 1]) == (0, 1)) / total
            assert pairs[chain * (length - 1) + t, 0, 1] == pytest.approx(want)


def test_line_features_do_not_depend_on_the_batch():
    texts = ["", "A line.\nTHE!! END!!\n\nA line.", "é | b | b b", "x" * 100_000]
    whole, size, doc = quality.line_features(texts)
    for i, text in enumerate(texts):
        rows, sizes, _ = quality.line_features([text])
        assert np.allclose(whole[doc == i], rows) and np.allclose(size[doc == i], sizes)
    assert np.bincount(doc).tolist() == [1, 4, 1, 1]


@pytest.mark.parametrize(
    ("scored", "label"),
    [(toxicity.toxicity_scores, "toxic"), (quality.quality_scores, "quality")],
)
def test_held_out_accuracy(spark, scored, label):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = scored(docs, labels)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    joined = rows.join(labels, "doc_id").filter("held_out")
    right = joined.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
    assert right >= 0.95
    assert rows.count() == docs.count()
    assert rows.filter("score < 0 or score > 1 or score is null").count() == 0
    # Labels of the held-out fold change nothing.
    turned = labels.withColumn(
        label, F.when(fold(F.col("doc_id")) == 0, 1 - F.col(label)).otherwise(F.col(label))
    )
    again = {r.doc_id: r.score for r in scored(docs, turned).collect()}
    assert again == {r.doc_id: r.score for r in rows.collect()}


def test_quality_is_learnt_from_whole_documents(spark):
    good = "The town has a new hall, and its people meet there.\n"
    bad = "CLICK >>> $$$ 99 !!! | | buy $$$ 12 >>>\n"
    rows = [(i, good * 210 + (bad if i % 2 else good) * 300) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows], "doc_id long, quality int")
    found = quality.quality_scores(docs, labels).filter("held_out").collect()
    assert found and all(r.predicted == 1 - r.doc_id % 2 for r in found)


def test_sample_is_bounded_by_whole_documents():
    documents = [(5, 1, 30), (2, 1, 80), (9, 1, 10), (7, 0, 500), (5, 1, 30), (3, 0, 4)]
    # The shortest of each label, then what fits: no single document passes the bound.
    assert quality.within(documents, 100) == {3, 9, 5}
    assert quality.within(documents, 10_000) == {2, 3, 5, 7, 9}
    assert quality.within(documents, 3) == set()
    assert quality.within([], 100) == set()


def test_an_id_is_one_training_row(spark):
    docs = spark.range(5000).selectExpr("if(id < 4990, 1L, id) as doc_id", "'text ' || id as text")
    labels = spark.range(5000).selectExpr("if(id < 4990, 1L, id) as doc_id", "int(id % 2) as toxic")
    rows = training_rows(docs, labels, "toxic", 10).collect()
    assert len({r.id for r in rows}) == len(rows) <= 11
    first = [r for r in training_rows(docs, labels, "toxic", 100).collect() if r.id == 1]
    assert [tuple(r) for r in first] == [(1, "text 0", 1)]


@pytest.mark.parametrize("scored", [toxicity.toxicity_scores, quality.quality_scores])
def test_odd_rows(spark, scored):
    labels = table(spark, SF, "labels").withColumn("text", F.lit("clash"))
    rows = [(None, "null id", 1, 1, "x"), (1, None, 1, 1, "x"), (2, "", 1, 1, "x")]
    rows += [(3, "same text", 1, 1, "x")] * 2 + [(4, "word " * 40_000, None, None, None)]
    found = scored(spark.createDataFrame(rows, DOCS), labels).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert len({r.score for r in found if r.doc_id == 3}) == 1
    assert scored(spark.createDataFrame([], DOCS), labels).collect() == []
    assert len(scored(spark.createDataFrame(rows, DOCS), labels.limit(0)).collect()) == 6
