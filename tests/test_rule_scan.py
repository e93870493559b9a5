"""Rule predictions of all tasks come from one scan."""

import numpy as np

from tabmill.plans import tasks as T


def test_rules_of_all_tasks_share_one_scan(spark):
    rng = np.random.default_rng(4)
    cols = sorted({t.target for t in T.TASKS} | set(T.RULE_FEATURES))
    rows = [(i, *map(float, x)) for i, x in enumerate(rng.uniform(0.1, 2.0, (200, len(cols))))]
    logged = spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{c} double" for c in cols))
    preds = T.all_rule_predictions(logged, T.TASKS, "id")
    assert preds.columns == ["task", "model", "model_order", "split", "id", "y", "p", "yhat"]
    assert preds._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    got = {(r["task"], r["model"], r["id"]): r for r in preds.collect()}
    assert len(got) == 200 * 3 * len(T.TASKS)
    for t in T.TASKS:
        names = list(T.REG_RULES) if t.kind == "regression" else [name for name, _ in T.CLF_RULES]
        for i, name in enumerate(names):
            r = got[t.name, name, 7]
            assert r["model_order"] == i and (r["yhat"] is None) == (t.kind == "regression") and r["p"] is not None
    t = next(t for t in T.TASKS if t.kind == "regression")
    mean = np.mean([r["y"] for (task, model, _), r in got.items() if task == t.name and model == "train_mean" and r["split"] == "train"])
    assert np.isclose(got[t.name, "train_mean", 7]["p"], mean)


def test_task_rows_are_written_once_an_id(spark, monkeypatch):
    """The fits and metrics of all tasks share one written row per id, not one per task and id."""
    import tabmill.session as S
    rng = np.random.default_rng(5)
    cols = sorted({t.target for t in T.TASKS} | set(T.RULE_FEATURES))
    logged = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(rng.uniform(0.1, 2.0, (300, len(cols))))], "id bigint, " + ", ".join(f"{c} double" for c in cols))
    written, keep = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, name="stage": written.append((name, df.count())) or keep(df, name))
    rows = T.all_task_frames(logged, T.TASKS, "id").collect()
    assert ("task_frames", 300) in written and len(rows) == 300 * len(T.TASKS)
    for t in T.TASKS:
        if t.stratify:  # the round(0.2 n) smallest hashes of every class
            for cls in (0.0, 1.0):
                mine = [r["split"] for r in rows if r["task"] == t.name and r["y"] == cls]
                assert mine.count("test") == int(0.2 * len(mine) + 0.5)
