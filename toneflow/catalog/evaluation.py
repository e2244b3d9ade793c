"""Evaluation of three made-up models over the events."""

from __future__ import annotations


from toneflow import fixtures
from toneflow.catalog import query, sql
from toneflow.operators import evaluate as E
from toneflow.schemas import LABELS

MODELS = fixtures.MODELS


def wide(spark, d):
    return fixtures.wide_predictions(spark, d)


def counts(spark, d):
    return E.counts(E.to_long(wide(spark, d), MODELS))


def shown(df, *metrics):
    return df.withColumns({m: sql.r6(m) for m in metrics})


_ACC = f"""{sql.WIDE}, acc AS (
  SELECT model, count(*) AS n, CAST(sum(CAST(pred = true_label AS INT)) AS BIGINT) AS n_correct,
         avg(CAST(pred = true_label AS INT)) AS accuracy FROM long GROUP BY 1)"""


@query("met1_accuracy", f"WITH {_ACC} SELECT model, n, n_correct, round_even(accuracy, 6) + 0.0 AS accuracy FROM acc")
def met1(spark, d):
    return shown(E.accuracy(counts(spark, d)), "accuracy")


@query("met2_class_accuracy", f"""WITH {sql.WIDE}
SELECT model, true_label, count(*) AS support, CAST(sum(CAST(pred = true_label AS INT)) AS BIGINT) AS n_correct,
  round_even(avg(CAST(pred = true_label AS INT)), 6) + 0.0 AS accuracy FROM long GROUP BY 1, 2""")
def met2(spark, d):
    return shown(E.class_accuracy(counts(spark, d)), "accuracy")


@query("met3_confusion_matrix", f"""WITH {sql.WIDE}
SELECT model, true_label, {', '.join(f"count(*) FILTER (pred = '{x}') AS {x}" for x in LABELS)}
FROM long GROUP BY 1, 2""")
def met3(spark, d):
    return E.confusion_matrix(counts(spark, d))


@query("met4_classification_report", f"""WITH {sql.SCORES}, report AS (
  SELECT * FROM scores
  UNION ALL SELECT model, 'accuracy', avg(CAST(pred = true_label AS INT)), avg(CAST(pred = true_label AS INT)),
    avg(CAST(pred = true_label AS INT)), count(*) FROM long GROUP BY model
  UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
    FROM scores GROUP BY model)
SELECT model, label, {sql.rounded(('precision', 'recall', 'f1'))}, CAST(support AS BIGINT) AS support FROM report""")
def met4(spark, d):
    return shown(E.classification_report(counts(spark, d)), "precision", "recall", "f1")


@query("met5_training_metrics", f"""WITH {sql.SCORES}, m AS (
  SELECT model, avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
    {', '.join(f"coalesce(max(f1) FILTER (label = '{x}'), 0.0) AS f1_{x}" for x in LABELS)}
  FROM scores GROUP BY 1), a AS (
  SELECT model, avg(CAST(pred = true_label AS INT)) AS accuracy FROM long GROUP BY 1)
SELECT model, {sql.rounded(('accuracy', 'precision_macro', 'recall_macro', 'f1_macro',
                            *(f'f1_{x}' for x in LABELS)))} FROM m JOIN a USING (model)""")
def met5(spark, d):
    return shown(E.training_metrics(counts(spark, d)), "accuracy", "precision_macro", "recall_macro",
                 "f1_macro", *(f"f1_{x}" for x in LABELS))


@query("met6_prediction_distribution", f"""WITH {sql.WIDE}
SELECT model, pred, count(*) AS n,
  round_even(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY model), 6) + 0.0 AS pct FROM long GROUP BY 1, 2""")
def met6(spark, d):
    return shown(E.prediction_distribution(counts(spark, d)), "pct")


def _agreement_sql(where: str) -> str:
    pairs = (("a", "b"), ("a", "c"), ("b", "c"))
    return f"WITH {sql.WIDE}, kept AS (SELECT * FROM wide WHERE {where}) " + " UNION ALL ".join(
        f"SELECT '{x}' AS model_a, '{y}' AS model_b, count(*) FILTER ({x}_prediction = {y}_prediction) AS n_agree, "
        f"count(*) AS n, round_even(avg(CAST({x}_prediction = {y}_prediction AS INT)) * 100, 6) + 0.0 AS pct FROM kept"
        for x, y in pairs)


@query("met7_agreement", _agreement_sql("a_prediction IN ('negative', 'neutral', 'positive')"))
def met7(spark, d):
    return shown(E.agreement(wide(spark, d), MODELS, base="a"), "pct")


@query("met7_agreement_polar", _agreement_sql("a_prediction IN ('negative', 'positive')"))
def met7_polar(spark, d):
    return shown(E.agreement(wide(spark, d), MODELS, base="a", base_labels=("positive", "negative")), "pct")


@query("met8_winner", f"""WITH {_ACC}
SELECT model, round_even(accuracy, 6) + 0.0 AS accuracy FROM acc ORDER BY acc.accuracy DESC, model LIMIT 1""")
def met8(spark, d):
    return shown(E.winner(E.accuracy(counts(spark, d)), MODELS), "accuracy")


@query("met9_compare_runs", f"""WITH {sql.SCORES}, a AS (SELECT label, f1 FROM scores WHERE model = 'b'),
b AS (SELECT label, f1 FROM scores WHERE model = 'a')
SELECT label, round_even(a.f1, 6) + 0.0 AS f1_before, round_even(b.f1, 6) + 0.0 AS f1_after,
  round_even(b.f1 - a.f1, 6) + 0.0 AS f1_change,
  CASE WHEN a.f1 <> 0 THEN round_even((b.f1 - a.f1) / a.f1, 6) + 0.0 END AS f1_relative
FROM a FULL JOIN b USING (label)""")
def met9(spark, d):
    scores = E.label_scores(counts(spark, d))
    both = E.compare_runs(scores.where("model = 'b'"), scores.where("model = 'a'"), ["label"], ["f1"])
    return shown(both, "f1_before", "f1_after", "f1_change", "f1_relative")


@query("met10_confidence_summary", f"""WITH {sql.WIDE}
SELECT model, pred, round_even(avg(confidence), 6) + 0.0 AS avg_confidence,
  CAST(sum(CAST(pred = true_label AS INT)) AS BIGINT) AS n_correct, count(*) AS n FROM long GROUP BY 1, 2""")
def met10(spark, d):
    return shown(E.confidence_summary(E.to_long(wide(spark, d), MODELS)), "avg_confidence")


@query("snk5_wide_and_long", f"""WITH {sql.WIDE}
SELECT row_id, true_label, {', '.join(f'{m}_prediction, round_even({m}_confidence, 6) + 0.0 AS {m}_confidence, '
                                      f'{m}_prediction = true_label AS {m}_correct' for m in MODELS)} FROM wide""")
def snk5_wide(spark, d):
    back = E.to_wide(E.to_long(wide(spark, d), MODELS), MODELS)
    return shown(back, *(f"{m}_confidence" for m in MODELS))
