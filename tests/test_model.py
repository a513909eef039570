from pyspark.sql import functions as F

from conftest import SF0001
from notifyq.operators.profile import model_features
from notifyq.plans.model import load_model, roc_points, save_model, score, train_models
from notifyq.plans.queries import make_run


def test_train_evaluate_save_reload(spark, workdir):
    feats = model_features(make_run(spark, SF0001).tagged)
    run = train_models(feats, names=["logistic_regression", "decision_tree"], num_trees=5)
    split = run.split.groupBy("label", "split").count().collect()
    sizes = {(r.label, r.split): r["count"] for r in split}
    assert sizes[(0, "test")] == round(664 * 0.2) and sizes[(1, "test")] == round(336 * 0.2)
    for m in run.metrics.values():
        assert 0.5 <= m["auc"] <= 1.0 and 0.0 <= m["f1"] <= 1.0
    assert run.best in run.metrics
    roc = roc_points(run.scored_test()).agg(F.max("tpr"), F.max("fpr")).first()
    assert roc[0] == 1.0 and roc[1] == 1.0
    path = f"{workdir}/model"
    save_model(run.models[run.best], path)
    reloaded = load_model(path)
    a = score(run.models[run.best], feats).orderBy("row_ord").collect()
    b = score(reloaded, feats).orderBy("row_ord").collect()
    assert a == b


def test_model_outputs_written_and_read_back(spark, workdir):
    from notifyq.operators.profile import correlation_matrix
    from notifyq.plans.runner import write_model_outputs
    from notifyq.sources.files import read_json_documents

    feats = model_features(make_run(spark, SF0001).tagged)
    run = train_models(feats, names=["decision_tree"])
    out = f"{workdir}/outputs"
    write_model_outputs(run.comparison(), correlation_matrix(feats), out)
    metrics = read_json_documents(spark, f"{out}/metrics")
    assert metrics.count() == 1 and metrics.first()["model"] == "decision_tree"
    corr = spark.read.option("header", True).csv(f"{out}/correlation")
    assert corr.count() == 100
