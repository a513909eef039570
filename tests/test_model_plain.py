"""The model's outputs recomputed in plain Python from its features and scored rows."""

import math
from collections import Counter

import numpy as np
import pytest

from conftest import SF0001
from notifyq import schema as S
from notifyq.operators.profile import correlation_matrix, labelled_rows, model_features
from notifyq.plans import model as M
from notifyq.plans.queries import make_run


@pytest.fixture(scope="module")
def trained(spark):
    feats = model_features(make_run(spark, SF0001).tagged)
    run = M.train_models(feats, names=["logistic_regression", "decision_tree"])
    scored = [(r.label, int(r.prediction), r.p1) for r in run.scored_test().select("label", "prediction", "p1").collect()]
    return feats, run, scored


def counts(scored):
    got = Counter((y, p) for y, p, _ in scored)
    return got[1, 1], got[0, 1], got[1, 0], got[0, 0]


def test_confusion_and_metrics(trained):
    _, run, scored = trained
    tp, fp, fn, tn = counts(scored)
    got = {(r.label, r.prediction): r.rows for r in M.confusion_matrix(run.scored_test()).collect()}
    assert got == {k: v for k, v in {(1, 1): tp, (0, 1): fp, (1, 0): fn, (0, 0): tn}.items() if v}
    m = run.metrics[run.best]
    precision, recall = tp / (tp + fp), tp / (tp + fn)
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (tp, fp, fn, tn)
    assert m["accuracy"] == pytest.approx((tp + tn) / len(scored))
    assert (m["precision"], m["recall"]) == pytest.approx((precision, recall))
    assert m["f1"] == pytest.approx(2 * precision * recall / (precision + recall))
    pos, neg = [p for y, _, p in scored if y == 1], [p for y, _, p in scored if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert (m["auc"], m["gini"]) == pytest.approx((auc, 2 * auc - 1), abs=1e-9)
    assert run.best == max(run.metrics, key=lambda x: round(run.metrics[x]["f1"], 3))
    shown = {r.model: r for r in run.comparison().collect()}
    assert shown[run.best].f1 == round(m["f1"], 3) and set(shown) == set(run.metrics)


def test_classification_report(trained):
    _, run, scored = trained
    tp, fp, fn, tn = counts(scored)

    def line(hit, wrong, missed):
        p, r = hit / (hit + wrong), hit / (hit + missed)
        return p, r, 2 * p * r / (p + r), hit + missed

    zero, one = line(tn, fn, fp), line(tp, fp, fn)
    n = len(scored)
    want = {
        "0": zero, "1": one, "accuracy": (None, None, (tp + tn) / n, n),
        "macro avg": (*((zero[i] + one[i]) / 2 for i in range(3)), n),
        "weighted avg": (*((zero[i] * zero[3] + one[i] * one[3]) / n for i in range(3)), n),
    }
    for r in M.classification_report(run).collect():
        for got, value in zip((r.precision, r.recall, r.f1), want[r["class"]][:3]):
            assert got == (None if value is None else pytest.approx(value, abs=1e-4))
        assert r.support == want[r["class"]][3]


def test_roc_points(trained):
    _, run, scored = trained
    pos, neg = sum(y for y, _, _ in scored), sum(1 - y for y, _, _ in scored)
    want = [(math.inf, 0.0, 0.0)]
    for t in sorted({p for _, _, p in scored}, reverse=True):
        above = [y for y, _, p in scored if p >= t]
        want.append((t, above.count(0) / neg, above.count(1) / pos))
    got = sorted((tuple(r) for r in M.roc_points(run.scored_test()).collect()), reverse=True)
    assert got == [pytest.approx(x) for x in want]


def test_every_row_is_scored_as_the_test_rows_are(trained):
    feats, run, _ = trained
    got = {r.row_ord: r for r in M.score(run.models[run.best], feats).collect()}
    assert len(got) == feats.count()
    for r in run.scored_test().select(S.ROW_ORD, "label", "prediction", "p1").collect():
        assert (got[r.row_ord].label, got[r.row_ord].prediction) == (r.label, int(r.prediction))
        assert got[r.row_ord].probability == pytest.approx(r.p1, abs=1e-6)


def test_run_record(spark, trained):
    feats, run, scored = trained
    rows = labelled_rows(make_run(spark, SF0001).tagged)
    held = [tuple(r) for r in rows.select(*S.RAW_COLUMNS, "reject_reason", "label").collect()]
    r = M.run_record(run, rows).first()
    tp, fp, fn, tn = counts(scored)
    assert (r.model, r.n_test, r.n_train, r.rows) == (run.best, len(scored), len(held) - len(scored), len(held))
    assert (r.tn, r.fp, r.fn, r.tp) == (tn, fp, fn, tp)
    assert r.reject_rate == round(sum(x[-1] for x in held) / len(held), 4)
    assert r.exact_duplicates == len(held) - len(set(held))
    assert r.null_notification_id == sum(x[0] is None for x in held)


def test_preprocessing(trained):
    """Median and mode filled, numbers standardised, categories one-hot and put together."""
    _, run, _ = trained
    columns = S.NUMERIC_FEATURES + S.CATEGORICAL_FEATURES
    train = [r.asDict() for r in run.split.where("split = 'train'").select(*columns).collect()]
    median, mode = {}, {}
    for c in S.NUMERIC_FEATURES:
        held = sorted(float(r[c]) for r in train if r[c] is not None)
        # The imputer's median has an error of 0.001 of the ranks, and is a value that occurs.
        k, slack = (len(held) - 1) / 2, math.ceil(len(held) / 1000) + 1
        median[c] = (held[max(0, math.floor(k) - slack)], held[min(len(held) - 1, math.ceil(k) + slack)])
    for c in S.CATEGORICAL_FEATURES:
        seen = Counter(r[c] for r in train if r[c] is not None)
        mode[c] = min(seen, key=lambda v: (-seen[v], v))
    out = run.models[run.best].transform(run.split.where("split = 'train'"))
    rows = out.collect()
    filled = np.array([[float(r[f"{c}_imp"]) for c in S.NUMERIC_FEATURES] for r in rows])
    for k, c in enumerate(S.NUMERIC_FEATURES):
        given = [r[c] for r in rows]
        assert all(got == g if g is not None else median[c][0] <= got <= median[c][1] for got, g in zip(filled[:, k], given))
    spread = filled.std(axis=0, ddof=1)
    scaled = (filled - filled.mean(axis=0)) / np.where(spread > 0, spread, 1)
    names = {c: sorted({r[f"{c}_filled"] for r in rows}) for c in S.CATEGORICAL_FEATURES}
    for r, numbers in zip(rows, scaled):
        got = r["features"].toArray()
        assert np.allclose(got[: len(numbers)], np.where(spread > 0, numbers, 0), atol=1e-9)
        assert all(r[f"{c}_filled"] == (mode[c] if r[c] is None else r[c]) for c in S.CATEGORICAL_FEATURES)
        rest = got[len(numbers):]
        assert set(rest) <= {0.0, 1.0} and rest.sum() == len(names)  # one place for each category column
    places = {c: {r[f"{c}_idx"] for r in rows} for c in names}
    assert all(places[c] == set(range(len(names[c]))) for c in names)


def test_correlation_of_rows_with_gaps(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(1e6, 1, 400)
    data = np.stack([a, a + rng.normal(0, 1, 400), rng.integers(0, 3, 400), np.full(400, 7.0)], axis=1)
    gaps = rng.random(data.shape) < [0.0, 0.2, 0.3, 0.0]
    rows = [tuple(None if g else float(x) for x, g in zip(r, gap)) for r, gap in zip(data, gaps)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.var_a, r.var_b): r.corr for r in correlation_matrix(frame, list("abcd")).collect()}
    assert len(got) == 16
    for i, x in enumerate("abcd"):
        for j, y in enumerate("abcd"):
            both = ~gaps[:, i] & ~gaps[:, j]
            want = None if "d" in (x, y) else round(np.corrcoef(data[both, i], data[both, j])[0, 1], 2)
            assert got[x, y] == (want if want is None else pytest.approx(want, abs=0.011))
    plan = correlation_matrix(frame, list("abcd"))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_covar_pop") if "partial_covar_pop" in plan else plan.index("covar_pop"):]
    assert "Generate" not in below, "rows are not multiplied before they are aggregated"
