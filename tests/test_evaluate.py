from __future__ import annotations

import pytest

from toneflow.operators import evaluate as E

# Published confusion counts of six models on 198 sentences, 66 per class, with
# the precision, recall, F1 of each label, macro and weighted averages.
GOLDEN = {
    "m1": ({"positive": {"positive": 47, "neutral": 17, "negative": 2},
            "negative": {"negative": 59, "neutral": 6, "positive": 1},
            "neutral": {"neutral": 51, "negative": 12, "positive": 3}},
           {"negative": (0.808, 0.894, 0.849), "neutral": (0.689, 0.773, 0.729), "positive": (0.922, 0.712, 0.803),
            "macro avg": (0.806, 0.793, 0.794), "weighted avg": (0.806, 0.793, 0.794)}, 0.793),
    "m2": ({"positive": {"negative": 33, "positive": 33}, "negative": {"negative": 64, "positive": 2},
            "neutral": {"negative": 42, "positive": 24}},
           {"negative": (0.460, 0.970, 0.624), "neutral": (0.0, 0.0, 0.0), "positive": (0.559, 0.500, 0.528),
            "macro avg": (0.340, 0.490, 0.384), "weighted avg": (0.340, 0.490, 0.384)}, 0.490),
    "m3": ({"positive": {"positive": 55, "neutral": 6, "negative": 5},
            "negative": {"positive": 25, "negative": 24, "neutral": 16, "love": 1},
            "neutral": {"positive": 53, "neutral": 7, "negative": 6}},
           {"love": (0.0, 0.0, 0.0), "negative": (0.686, 0.364, 0.475), "neutral": (0.241, 0.106, 0.147),
            "positive": (0.414, 0.833, 0.553), "macro avg": (0.335, 0.326, 0.294),
            "weighted avg": (0.447, 0.434, 0.392)}, 0.434),
    "m4": ({"positive": {"positive": 60, "neutral": 4, "negative": 2}, "negative": {"negative": 65, "neutral": 1},
            "neutral": {"neutral": 50, "negative": 13, "positive": 3}},
           {"negative": (0.812, 0.985, 0.890), "neutral": (0.909, 0.758, 0.826), "positive": (0.952, 0.909, 0.930),
            "macro avg": (0.891, 0.884, 0.882), "weighted avg": (0.891, 0.884, 0.882)}, 0.884),
    "m5": ({"positive": {"positive": 58, "neutral": 7, "negative": 1}, "negative": {"negative": 64, "positive": 2},
            "neutral": {"neutral": 51, "negative": 10, "positive": 5}},
           {"negative": (0.853, 0.970, 0.908), "neutral": (0.879, 0.773, 0.823), "positive": (0.892, 0.879, 0.885),
            "macro avg": (0.875, 0.874, 0.872), "weighted avg": (0.875, 0.874, 0.872)}, 0.874),
    "m6": ({"positive": {"positive": 33, "neutral": 22, "negative": 11},
            "negative": {"negative": 44, "neutral": 17, "positive": 5},
            "neutral": {"neutral": 55, "negative": 9, "positive": 2}},
           {"negative": (0.688, 0.667, 0.677), "neutral": (0.585, 0.833, 0.688), "positive": (0.825, 0.500, 0.623),
            "macro avg": (0.699, 0.667, 0.662), "weighted avg": (0.699, 0.667, 0.662)}, 0.667),
}
MODELS = tuple(GOLDEN)


@pytest.fixture(scope="module")
def predictions(spark):
    rows = []
    for model, (confusion, _, _) in GOLDEN.items():
        preds = [(t, p) for t in sorted(confusion) for p, n in confusion[t].items() for _ in range(n)]
        rows += [(i, model, t, p, 0.5) for i, (t, p) in enumerate(preds)]
    return spark.createDataFrame(rows, "row_id long, model string, true_label string, pred string, confidence double") \
        .cache()


def test_golden_reports(predictions):
    got = {(r.model, r.label): r for r in E.classification_report(E.counts(predictions)).collect()}
    for model, (_, report, accuracy) in GOLDEN.items():
        for label, want in report.items():
            r = got[model, label]
            assert (round(r.precision, 3), round(r.recall, 3), round(r.f1, 3)) == want, (model, label)
        assert round(got[model, "accuracy"].f1, 3) == accuracy
        assert got[model, "macro avg"].support == 198
    assert got["m3", "love"].support == 0
    assert len(got) == sum(len(r) + 1 for _, r, _ in GOLDEN.values())


def test_accuracies_and_winner(predictions):
    acc = E.accuracy(E.counts(predictions))
    got = {r.model: (r.n, r.n_correct) for r in acc.collect()}
    assert got["m1"] == (198, 157) and got["m4"] == (198, 175)
    assert E.winner(acc, MODELS).first().model == "m4"
    assert E.winner(acc.where("model in ('m4', 'm5')").selectExpr("model", "0.5D as accuracy"), ("m5", "m4")) \
        .first().model == "m5"
    recall = {(r.model, r.true_label): (r.support, round(r.accuracy, 3)) for r in
              E.class_accuracy(E.counts(predictions)).collect()}
    assert recall["m6", "neutral"] == (66, 0.833) and recall["m2", "neutral"] == (66, 0.0)


def test_confusion_matrix_has_zeros(predictions):
    rows = {(r.model, r.true_label): (r.negative, r.neutral, r.positive)
            for r in E.confusion_matrix(E.counts(predictions)).collect()}
    assert rows["m2", "neutral"] == (42, 0, 24) and rows["m3", "negative"] == (24, 16, 25)
    assert len(rows) == 18


def test_small_vectors(spark):
    truth, pred = [0, 0, 1, 1, 2, 2], [0, 1, 1, 1, 2, 0]
    df = spark.createDataFrame([(i, "m", str(t), str(p)) for i, (t, p) in enumerate(zip(truth, pred))],
                               "row_id int, model string, true_label string, pred string")
    count = E.counts(df)
    row = E.training_metrics(count, ("0", "1", "2")).first()
    assert abs(row.accuracy - 4 / 6) < 1e-12
    assert abs(row.f1_0 - 0.5) < 1e-12 and abs(row.f1_1 - 0.8) < 1e-12 and abs(row.f1_2 - 2 / 3) < 1e-12
    assert abs(row.f1_macro - (0.5 + 0.8 + 2 / 3) / 3) < 1e-12
    matrix = E.confusion_matrix(count, ("0", "1", "2")).collect()
    assert sum(r["0"] + r["1"] + r["2"] for r in matrix) == 6


def test_agreement_by_pair(spark):
    wide = spark.createDataFrame(
        [("positive", "positive", "neutral"), ("neutral", "neutral", "neutral"), ("love", "love", "love"),
         ("negative", "positive", "positive")], "a_prediction string, b_prediction string, c_prediction string")
    got = {(r.model_a, r.model_b): (r.n_agree, r.n) for r in E.agreement(wide, "abc", base="a").collect()}
    assert got == {("a", "b"): (2, 3), ("a", "c"): (1, 3), ("b", "c"): (2, 3)}
    polar = {(r.model_a, r.model_b): (r.n_agree, r.n) for r in
             E.agreement(wide, "abc", base="a", base_labels=("positive", "negative")).collect()}
    assert polar["a", "b"] == (1, 2)
    none = E.agreement(wide, "ab", base="a", base_labels=("missing",)).first()
    assert (none.n_agree, none.n, none.pct) == (0, 0, 0.0)


def test_wide_and_long(predictions):
    wide = E.to_wide(predictions, MODELS)
    back = E.to_long(wide, MODELS)
    assert back.count() == predictions.count()
    assert back.exceptAll(predictions.select(*back.columns)).count() == 0


def test_wide_details_are_keyed_by_name(spark):
    rows = [(1, "m", "positive", "positive", 0.7, "POS", {"positive": 0.70004, "negative": 0.2, "neutral": 0.1}),
            (1, "k", "positive", "love", 0.5, "love", None)]
    df = spark.createDataFrame(rows, "row_id long, model string, true_label string, pred string, "
                                     "confidence double, raw_label string, probs map<string,double>")
    row = E.to_wide(df, ("m", "k"), with_probs=("m",), with_raw=("k",)).first().asDict()
    assert (row["m_prob_positive"], row["m_prob_negative"], row["m_prob_neutral"]) == (0.7, 0.2, 0.1)
    assert row["k_raw_label"] == "love" and row["k_correct"] is False and "m_raw_label" not in row


def test_comparison_and_confidence(predictions):
    scores = E.accuracy(E.counts(predictions))
    before = scores.where("model in ('m1', 'm2', 'm3')")
    after = scores.where("model in ('m4', 'm5', 'm6')").selectExpr("replace(replace(replace(model, 'm4', 'm1'), "
                                                                   "'m5', 'm2'), 'm6', 'm3') as model", "accuracy")
    row = E.compare_runs(before, after, ["model"], ["accuracy"]).where("model = 'm2'").first()
    assert abs(row.accuracy_change - (173 - 97) / 198) < 1e-12
    assert abs(row.accuracy_relative - (173 - 97) / 97) < 1e-12
    conf = {(r.model, r.pred): (r.avg_confidence, r.n_correct, r.n) for r in E.confidence_summary(predictions).collect()}
    assert conf["m3", "love"] == (0.5, 0, 1)
    share = {(r.model, r.pred): r.pct for r in E.prediction_distribution(E.counts(predictions)).collect()}
    assert abs(share["m2", "negative"] - 139 / 198 * 100) < 1e-9
