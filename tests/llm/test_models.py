"""The learned operators: held-out accuracy, defined results, and the pieces they are made of."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vizquarry.llm import language, quality_model, registry, toxicity

SF = "/root/testdata/sf0.01"


def held(key, folds, fold):
    return zlib.crc32(b"" if key is None else str(key).encode()) % folds == fold


def texts_of(draw, syllables, n):
    return " ".join("".join(draw.choice(syllables) for _ in range(draw.randrange(1, 4))) for _ in range(n))


# --- language ---------------------------------------------------------------------------------------------------

KINDS = {"aa": "ka to mi ra no", "bb": "sch ein ung ver", "cc": "éau oir que les"}


def language_rows():
    draw, rows = random.Random(4), []
    for k in range(240):
        lang = sorted(KINDS)[k % 3]
        rows.append((k, texts_of(draw, KINDS[lang].split(), draw.randrange(3, 60)), lang))
    return [*rows, (900, None, "aa"), (901, "", "bb"), (902, "123 ... !!", "cc"), (903, rows[0][1], None), (None, rows[1][1], "bb"), (904, "ka to " * 30_000, "aa")]


def test_language_held_out(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS label", "2 AS score", "3 AS id")
    got = {(r.doc_id, i): r for i, r in enumerate(language.identify(docs, per_language=60, landmarks=30).collect())}
    assert len(got) == len(rows)
    by_id = {k: r for (k, _), r in got.items()}
    right = [by_id[k].lang_pred == lang for k, text, lang in rows if text and lang and held(k, 4, 2) and k is not None and k < 900]
    assert len(right) > 30 and np.mean(right) > 0.97
    for k, r in by_id.items():
        assert r.held_out == held(k, 4, 2) and 0 <= r.score <= 1
    assert [by_id[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and by_id[904].lang_pred == "aa"
    assert by_id[903].lang_pred == by_id[0].lang_pred


def test_language_learns_nothing_from_the_held_out_fold(spark):
    rows = [(k, t, "zz" if held(k, 4, 2) else lang) for k, t, lang in language_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert "zz" not in {r.lang_pred for r in language.identify(docs, per_language=60, landmarks=30).collect()}


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in language.identify(docs).collect()] == [(1, held(1, 4, 2), "und", 0.0)]
    assert language.identify(docs.limit(0)).count() == 0


def test_folded_scoring_is_the_kernel():
    draw = random.Random(1)
    rows = np.zeros((40, language.OFFSETS[-1]), dtype=np.uint8)
    labels = []
    for k in range(40):
        lang = sorted(KINDS)[k % 3]
        labels.append(lang)
        assert language.presence(texts_of(draw, KINDS[lang].split(), 20), rows[k])
    own = language.kernel(rows, rows)
    assert np.allclose(np.diag(own), 1) and np.linalg.eigvalsh(own).min() > -1e-6
    model = language.fit(rows, labels, landmarks=40, ridge=1e-2)
    # With every row a landmark, Nyström features are exact: the same outputs as kernel ridge regression.
    targets = np.array([[1.0 if x == lang else -1.0 for lang in model.languages] for x in labels])
    weight = np.array([1 / labels.count(x) for x in labels])
    weight *= len(labels) / weight.sum()
    centre = lambda a: a - np.average(a, axis=0, weights=weight)
    middle = np.eye(40) - np.outer(np.ones(40), weight / weight.sum())
    gram = middle @ own @ middle.T
    root = np.sqrt(weight)
    alpha = np.linalg.solve(root[:, None] * gram * root + 1e-2 * 40 * np.eye(40), root[:, None] * centre(targets))
    want = gram @ (root[:, None] * alpha) + np.average(targets, axis=0, weights=weight)
    assert np.abs(model.outputs(rows) - want).max() < 1e-2


# --- quality ----------------------------------------------------------------------------------------------------


def labelled(spark, seed=5, n=300):
    draw, docs, labels = random.Random(seed), [], []
    for k in range(n):
        good = k % 3 > 0
        words = texts_of(draw, "ka to mi ra no".split(), 40).split()
        docs.append((k, " ".join(words if good else [w + "$$$" for w in words])))
        labels.append((k, int(good), int(k % 5 == 0)))
    docs += [(n, None), (n + 1, ""), (n + 2, docs[0][1]), (None, "no id"), (n + 3, "far far " * 50_000)]
    labels += [(n + 9, 1, 1), (None, 1, 0), (0, None, None)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS label", "7 AS quality", "8 AS id"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text"),
        docs,
        labels,
    )


def test_quality_held_out(spark):
    docs, labels, rows, marks = labelled(spark)
    got = {r.doc_id: r for r in quality_model.classify(docs, labels).collect()}
    assert len(got) == len(rows)
    right = [got[k].predicted == q for k, q, _ in marks if k in got and q is not None and k is not None and held(k, 5, 0)]
    assert len(right) > 30 and np.mean(right) > 0.95
    for k, r in got.items():
        assert r.held_out == held(k, 5, 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    n = len(rows) - 5
    assert got[n].score == got[n + 1].score and got[n + 2].score == got[0].score


def test_quality_without_labels(spark):
    docs, labels, _, _ = labelled(spark, n=6)
    assert {r.score for r in quality_model.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.classify(docs.limit(0), labels).count() == 0


def test_features_are_distinct_bins():
    small, large = quality_model.features("a b a b, c c"), quality_model.features("a b a b, c c " * 3000)
    assert set(small.tolist()) <= set(large.tolist()) and list(small) == sorted(set(small.tolist()))
    assert quality_model.features(None).size == quality_model.features("").size == 0


def test_ftrl_separates():
    rows = [(np.array([k % 2, 5 + k % 7], dtype=np.int32), k % 2) for k in range(200)]
    weights = quality_model.fit(rows)
    assert all((quality_model.score(b, weights) > 0.5) == bool(y) for b, y in rows)


# --- toxicity ---------------------------------------------------------------------------------------------------


def test_toxicity_held_out_on_the_corpus(spark):
    docs, labels = (registry.table(spark, SF, x) for x in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(got) == docs.count()
    fold = [(got[k].predicted, y) for k, y in marks.items() if got[k].held_out]
    assert np.mean([p == y for p, y in fold]) > 0.9


def test_toxicity_of_insults(spark):
    draw, docs, labels = random.Random(3), [], []
    for k in range(400):
        words = texts_of(draw, "ka to mi ra no lu".split(), 60).split()
        toxic = k % 4 == 0
        for _ in range(3 * toxic):
            words[draw.randrange(60)] = draw.choice(["scoundrel", "nitwit", "vermin"])
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    docs += [(500, None), (501, ""), (502, "  \n"), (503, docs[0][1]), (None, docs[0][1]), (504, docs[1][1] + " " + "ka mi " * 50_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "5 AS toxic", "6 AS windows")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(frame, marks).collect()}
    fold = [(got[k].predicted, y) for k, _, y in labels if held(k, 5, 0)]
    assert np.mean([p == y for p, y in fold]) > 0.95 and sum(y for _, y in fold) > 10
    assert [got[k].predicted for k in (500, 501, 502, 504)] == [0] * 4
    assert got[503].score == got[0].score == got[None].score
    assert {r.score for r in toxicity.classify(frame, marks.where("toxic = 1")).collect()} == {0.0}
    assert toxicity.classify(frame.limit(0), marks).count() == 0


@pytest.mark.parametrize("n", [0, 1, 12, 13])
def test_windows_hold_all_words(n):
    words = [f"w{k}" for k in range(n)]
    assert b" ".join(toxicity.windows(" ".join(words))).decode().split() == words


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_toxic_rows_are_found_at_both_sizes(spark, sf):
    docs, labels = (registry.table(spark, f"/root/testdata/{sf}", x) for x in ("documents", "labels"))
    marks = labels.selectExpr("doc_id AS id", "toxic")
    got = toxicity.classify(docs, labels).join(marks, F.col("doc_id") == F.col("id")).where("held_out").collect()
    hits = sum(r.predicted for r in got if r.toxic == 1)
    assert hits >= 0.6 * sum(r.toxic == 1 for r in got) and hits >= 0.8 * sum(r.predicted for r in got)


@pytest.mark.parametrize("n", [60, 600])
def test_telling_segments_of_full_and_small_samples(n):
    draw = random.Random(n)
    rows = [toxicity.windows(texts_of(draw, "ka to mi ra no lu".split(), 24)) for _ in range(2 * n)]
    for k in range(25):
        rows[k][0] += b"nitwit" + b"abc"[k % 3 : k % 3 + 1] + b" "
    rows[30] = [w + b"oneoff " for w in toxicity.windows(texts_of(draw, ["mi"], 600))]  # a single row
    candidates = {s for row in rows for w in row for x in w.split() for s in toxicity.beginnings(x)}
    kept = toxicity.telling_segments(candidates, rows[:n], rows[n:])
    assert kept and all(b"nitwit".startswith(s) or s.startswith(b"nitw") for s in kept)


def test_nothing_telling(spark):
    draw = random.Random(9)
    rows = [(k, texts_of(draw, "ka to mi ra no lu".split(), 40)) for k in range(100)]
    marks = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int")
    got = toxicity.classify(spark.createDataFrame(rows, "doc_id long, text string"), marks).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.0, 0)}


def test_threshold_comes_from_whole_texts(spark):
    draw = random.Random(12)
    plain = lambda n: texts_of(draw, "ka to mi ra no lu".split(), n).split()
    docs = []
    for k in range(306):
        words = plain(60 if k < 300 else 4800)
        if k >= 300:  # 400 windows, of which every other one used to be left out
            words[15] = "nitwit"
        elif k % 3 == 0:
            words[5] = words[17] = words[40] = "nitwit"
        docs.append((k, " ".join(words), int(k % 3 == 0 or k >= 300)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = toxicity.train(frame.drop("toxic"), frame.drop("text"), F.lit(True), "doc_id", "text", "toxic")
    threshold = model.threshold
    toxicity.calibrate(model, [(model.evidence(toxicity.windows(t)), y) for _, t, y in docs])
    assert threshold == pytest.approx(model.threshold)
