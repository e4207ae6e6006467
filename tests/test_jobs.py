"""Models, streams, sources and sinks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hooklens.models import experiments as X
from hooklens.models.features import fit_text_features
from hooklens.operators import textvec as T
from hooklens.schema import FEEDBACK, MESSAGE
from hooklens.session import shared_dir
from hooklens.sources import readers, writers
from hooklens.streaming import jobs
from tests.test_signals import messages

BAD = "verify your account http://u@evil.tk/login now"
GOOD = "meeting notes for the project team"


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for i in range(60):
        phishing = i % 3 == 0
        rows.append({
            "label": "phishing" if phishing else "ham",
            "subject": f"word{i % 7}",
            "body": (BAD if phishing else GOOD) + f" nr{i % 5}",
            "html": '<a href="http://evil.tk">bank</a>' if phishing else "",
            "headers_raw": f"From: a@x.com\nAuthentication-Results: spf={'fail' if phishing else 'pass'}\n",
        })
    vector = F.array(*[(F.when(F.col("label") == "ham", 1.0).otherwise(-1.0) + F.col("id") * 0.001 * k).cast("float") for k in range(4)])
    return messages(spark, *rows).withColumn("embedding", vector).cache()


def test_features_equal_the_tfidf_relation(spark, table):
    texts = table.select("id", "subject", "body")
    expected = {}
    for r in T.tfidf_relation(texts).collect():
        expected.setdefault(r["id"], []).append(r["weight"])
    from hooklens.functions.text import message_text

    named = texts.select("id", message_text().alias("text"))
    for exact in (True, False):
        model = fit_text_features(named, 1 << 14, exact_vocabulary=exact)
        for r in model.transform(named).collect():
            found = sorted(v for v in r["text_vector"].values if v)
            assert found == pytest.approx(sorted(expected[r["id"]]))


def test_all_experiments(spark, table):
    predictions, summary, report = X.run_experiments(table)
    rows = {r["experiment"]: r for r in summary.collect()}
    assert set(rows) == set(X.EXPERIMENTS)
    for r in rows.values():
        assert r["n_test"] == 12 and r["roc_auc"] == 1.0 and (r["tp"], r["fp"], r["fn"]) == (4, 0, 0)
    assert predictions.filter("experiment <> 'E4' AND (score < 0 OR score > 1)").count() == 0
    assert report.count() == 5 * len(rows)


def test_pipeline_saved_and_loaded(spark, table, tmp_path):
    train = table.withColumn("y_true", (F.col("label") == "phishing").cast("int"))
    for kind in ("lr", "svm"):
        model = X.fit_text_classifier(train, 1 << 10, kind)
        path = str(tmp_path / kind)
        X.save_pipeline(model, path)
        again = X.score_messages(X.load_pipeline(path), table).collect()
        first = X.score_messages(model, table).collect()
        assert {r["id"]: r["score"] for r in again} == {r["id"]: r["score"] for r in first}
        assert all(0.0 <= r["score"] <= 1.0 for r in first)
        worst = max(r["score"] for r in first if r["label"] == "ham")
        assert worst < min(r["score"] for r in first if r["label"] == "phishing")


def test_training_needs_both_classes(spark, table):
    with pytest.raises(ValueError, match="both classes"):
        X.balanced_weight(table.withColumn("y_true", F.lit(1)))


def test_stream_equals_batch(spark, table, tmp_path):
    train = table.withColumn("y_true", (F.col("label") == "phishing").cast("int"))
    model = X.fit_text_classifier(train, 1 << 10)
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    request = table.select(F.col("id").cast("string"), "subject", "body", "headers_raw", "html")
    request.filter("id % 2 = 0").write.mode("append").json(source)

    def run():
        stream = jobs.decide(jobs.message_stream(spark, source), model)
        jobs.start_append(stream, out, progress).awaitTermination()

    run()
    request.filter("id % 2 = 1").write.mode("append").json(source)
    run()  # continues from the checkpoint: only the new files are scored
    key = lambda r: r["id"]
    streamed = sorted(spark.read.parquet(out).collect(), key=key)
    assert streamed == sorted(jobs.decide(request, model).collect(), key=key)
    assert len(streamed) == 60 and {r["label"] for r in streamed} == {"phishing", "legit"}


def test_feedback_batch_and_stream(spark, tmp_path):
    path, out, progress = (str(tmp_path / n) for n in ("feedback", "kept", "progress"))
    first = spark.createDataFrame([("1", "ham", None)], FEEDBACK)
    writers.append_feedback(spark, first, path)
    writers.append_feedback(spark, spark.createDataFrame([(2, "phishing")], "id long, label_true string"), path)
    assert sorted(map(tuple, writers.read_feedback(spark, path).collect())) == [("1", "ham", None), ("2", "phishing", None)]
    jobs.start_append(jobs.feedback_stream(spark, path), out, progress, "json").awaitTermination()
    assert sorted(map(tuple, writers.read_feedback(spark, out).collect())) == [("1", "ham", None), ("2", "phishing", None)]


def test_csv_messages(spark, tmp_path):
    row = (1, "ham", 'quote " and,\nnew line', "b", "2001", "src", "From: a@b.c\n", "<a>")
    path = str(tmp_path / "mail")
    writers.write_table(spark.createDataFrame([row], MESSAGE), path, "csv")
    back = readers.read_messages(spark, path, "csv")
    assert tuple(back.select(*MESSAGE.fieldNames()).first()) == row
    writers.write_table(spark.createDataFrame([(2, "odd", *row[2:])], MESSAGE), path)
    with pytest.raises(ValueError, match="unexpected labels"):
        readers.read_messages(spark, path)
    with pytest.raises(ValueError, match="missing columns"):
        writers.write_predictions(back, str(tmp_path / "p"))


def test_labelled_texts(spark):
    df = spark.createDataFrame([("0", "a"), ("Spam", None)], "label string, text string")
    assert [tuple(r) for r in readers.labelled_texts(df).collect()] == [("a", "ham"), ("", "phishing")]
    mail = spark.createDataFrame([("1", "s", "b")], "label string, subject string, body string")
    assert tuple(readers.labelled_texts(mail).first()) == ("s b", "phishing")


def test_nested_columns_in_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], {"k": ["v"]})], "id long, reasons array<string>, details map<string,array<string>>")
    path = str(tmp_path / "rules")
    writers.write_table(df, path, "csv")
    assert tuple(readers.read_csv(spark, path).first()) == ("1", '["a","b"]', '{"k":["v"]}')


class _Stub:
    """Session stand-in: the shared folder only asks for two settings."""

    def __init__(self, master: str, named: str | None):
        self.sparkContext = self
        self.master, self.applicationId = master, "app"
        self.conf = {"spark.checkpoint.dir": named} if named else {}


def test_shared_folder():
    assert shared_dir(_Stub("spark://host:7077", "hdfs:/shared/")) == "hdfs:/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Stub("spark://host:7077", None))
    assert shared_dir(_Stub("local[2]", None)) == shared_dir(_Stub("local[2]", None))


def test_training_reaches_the_optimum(spark, table):
    """Merged single-message terms, signals of any magnitude, both losses: the gradient vanishes in every term."""
    features = X.build_features(table, ["E0", "E1", "E2", "E4"])
    counts = features.text.index.groupBy("feature").count()
    assert counts.filter("count > 1").count() > 0 or features.text.index.filter("df = 1").count() == 0
    for name in ("E0", "E1", "E2", "E4"):
        model = X.fit_model(features, name)
        found, penalty = X.certificate(features, name, model)
        slopes = [r["gradient"] for r in found.collect()]
        assert sum(g * g for g in slopes) ** 0.5 / penalty <= 1.1 * X.TOLERANCE
        assert len(slopes) == features.text.index.count() + len(X.SIGNAL_COLUMNS[X.EXPERIMENTS[name].signals]) + 1


def test_merged_terms_change_no_score(spark):
    """Coefficients of all terms apart, by plain descent, against the features that merge terms of one message."""
    import numpy as np

    from hooklens.models import training
    from hooklens.models.vocabulary import fit_text_features

    rng = np.random.default_rng(3)
    rows = [{"label": "phishing" if i % 3 == 0 else "ham", "subject": "s", "body": " ".join(
        [f"w{rng.integers(12)}" for _ in range(6)] + [f"only{i}", f"lone{i}"] * (i % 2))} for i in range(24)]
    docs = messages(spark, *rows).withColumn("split", F.when(F.col("id") % 5 == 0, "test").otherwise("train"))
    text = fit_text_features(docs)
    y = {r["id"]: 1.0 if r["label"] == "phishing" else -1.0 for r in docs.collect()}
    cells = [(r["id"], r["split"], r["term"], r["weight"]) for r in text.relation.collect()]
    assert {r["id"] for r in text.vectors.collect()} == {i for i, s, *_ in cells if s == "train"}
    terms = sorted({t for _, s, t, _ in cells if s == "train"})
    assert text.size < len(terms) == text.index.count()
    ids = sorted({i for i, s, *_ in cells if s == "train"})
    x = np.zeros((len(ids), len(terms) + 1))
    x[:, -1] = 1.0
    for i, s, t, w in cells:
        if s == "train":
            x[ids.index(i), terms.index(t)] = w
    signs = np.array([y[i] for i in ids])
    for loss in ("lr", "svm"):
        plain = np.zeros(x.shape[1])
        for _ in range(20000):
            _, slope = training.LOSSES[loss](signs * (x @ plain))
            plain -= 0.3 * (x.T @ (slope * signs) / len(ids) + plain / len(ids))
        rows = text.vectors.withColumn("y_true", F.when(F.col("id").isin([i for i in ids if y[i] > 0]), 1).otherwise(0))
        table = training.training_table(rows.withColumn("weight", F.lit(1.0)))
        fitted, bound = training.fit(table, text.size, loss, 1e-6)
        of = {r["term"]: r["share"] * fitted[r["feature"]] for r in text.index.collect()}
        assert bound <= 1e-6
        assert np.allclose([of[t] for t in terms], plain[:-1], atol=1e-5) and abs(fitted[-1] - plain[-1]) < 1e-5


@pytest.mark.parametrize("basis_bytes", [0, 1 << 28])
def test_few_steps_serve_all_experiments(spark, table, monkeypatch, basis_bytes):
    """Experiments are fitted in the same few jobs, also where the driver keeps few directions."""
    from hooklens.models import training

    steps = []
    total = training._total
    monkeypatch.setattr(training, "_total", lambda *a: (steps.append(a), total(*a))[1])
    monkeypatch.setattr(training, "BASIS_BYTES", basis_bytes)
    names = ["E0", "E1", "E4"]
    features = X.build_features(table, names)
    models = X.fit_models(features, names)
    assert len(steps) <= 30
    for name in names:
        found, penalty = X.certificate(features, name, models[name])
        assert found.selectExpr("sqrt(sum(gradient * gradient))").first()[0] / penalty <= 1.1 * X.TOLERANCE


def test_coefficients_do_not_pass_the_driver(spark, table, monkeypatch):
    """A model's terms are written by tasks: the driver makes rows of the signals and the bias alone."""
    features = X.build_features(table, ["E1"])
    made, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: (made.append(len(data)), create(self, data, *a, **k))[1])
    model = X.fit_model(features, "E1")
    assert made == [len(X.SIGNAL_COLUMNS["url"]) + 1] and features.text.index.count() > 20
    assert model.filter("kind = 'term'").count() == features.text.index.count()


def test_large_tables_go_once_read(spark, table, tmp_path, monkeypatch):
    """Words, questions, columns and models of a run of experiments are deleted; what later readers need stays."""
    monkeypatch.setattr("hooklens.session.shared_dir", lambda spark: str(tmp_path))
    predictions, summary, _ = X.run_experiments(table, ["E0", "E4"])
    left = {p.name.rpartition("-")[0] for p in (tmp_path / "hooklens").iterdir()}
    assert {"predictions", "features", "relation"} <= left
    assert not left & {"words", "asked", "terms", "columns", "coefficients", "model-E0", "model-E4"}
    assert summary.count() == 2 and predictions.count() > 0


def test_training_with_repeated_and_missing_ids(spark):
    """Rows of one id share its text, a row without an id has none; the optimum is that of plain descent."""
    import numpy as np

    from hooklens.models import training

    vectors = spark.createDataFrame(
        [(1, [0, 2], [0.6, 0.8]), (2, [1, 2], [1.0, 0.5]), (None, [0], [1.0])], "id long, indices array<int>, weights array<double>")
    vectors = vectors.repartition(3).withColumn("place", F.monotonically_increasing_id()).localCheckpoint()
    places = training.Places(vectors)
    number = {r["id"]: int(places.numbers(np.array([r["place"]]))[0]) for r in vectors.collect()}
    assert sorted(number.values()) == [0, 1, 2]
    slot = np.array([number[1], number[1], number[2], 3])
    sparse = {number[1]: [0.6, 0.0, 0.8], number[2]: [0.0, 1.0, 0.5], 3: [0.0] * 3}
    y, c, dense = np.array([1.0, -1.0, 1.0, -1.0]), np.array([1.0, 2.0, 1.0, 0.5]), np.array([[30.0, 1.0, 0.0, -2.0]])
    x = np.hstack([np.array([sparse[s] for s in slot]), dense.T, np.ones((4, 1))])
    columns = training.column_table(vectors, places)
    for loss in ("lr", "svm"):
        a, b, far = training.solved(columns, {"": training.solving(slot, 3, y, c, dense, loss, 1e-7)})[""]
        text = {r["feature"]: r["coefficient"] for r in columns.combined(a).collect()}
        w = np.array([text[0], text[1], text[2], *b])
        slope = x.T @ (c * training.LOSSES[loss](y * (x @ w))[1] * y) + w
        assert far <= 1e-7 and np.linalg.norm(slope) < 1e-6


@pytest.mark.parametrize("driver_bytes", [0, 1 << 27])
def test_a_training_step_is_one_job(spark, monkeypatch, driver_bytes):
    """However many tasks a step has, they run in one job, and their sums are those of plain numpy."""
    import numpy as np

    from hooklens.models import training

    monkeypatch.setattr(training, "TASK_CELLS", 4)
    monkeypatch.setattr(training, "BLOCK_CELLS", 5)
    monkeypatch.setattr(training, "DRIVER_BYTES", driver_bytes)
    rng = np.random.default_rng(5)
    places = [sorted(rng.choice(7, int(rng.integers(0, 5)), replace=False).tolist()) for _ in range(40)]
    rows = [(i % 2, 1.0 + i % 3, p, rng.random(len(p)).tolist()) for i, p in enumerate(places)]
    table = training.training_table(spark.createDataFrame(rows, "y_true int, weight double, indices array<int>, weights array<double>"))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 16)
    try:
        table = spark.read.parquet(*table.inputFiles())
        assert table.rdd.getNumPartitions() > training.FAN_IN
        f = training.objective(table, "lr", 0.1, 40.0)
        x = np.zeros((40, 8))
        x[:, -1] = 1.0
        for i, (_, _, p, w) in enumerate(rows):
            x[i, p] = w
        signs, c = np.array([2 * r[0] - 1 for r in rows]), np.array([r[1] for r in rows])
        w = rng.normal(size=8)
        loss, slope = training.LOSSES["lr"](signs * (x @ w))
        spark.sparkContext.setJobGroup("step", "step")
        value, gradient = f(w)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("step")
        spark.sparkContext.setJobGroup("", "")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert abs(value - (c @ loss / 40 + 0.05 * w @ w)) < 1e-12
    assert np.allclose(gradient, x.T @ (c * slope * signs) / 40 + 0.1 * w, atol=1e-12)
    assert len(jobs) <= 4  # one, and one for each shuffle of partial sums


@pytest.mark.parametrize("size", [300, 1 << 20])
def test_csv_split_at_any_byte(spark, tmp_path, size):
    """Byte ranges much shorter than a record, fields of many ranges, and the plain parser as the judge."""
    import csv as plain

    from hooklens.sources.csv_split import read_csv_split

    fields = ["", "a", 'q"q', "line\nbreak", ",", '"', '""', "\r\n", "é\n\n日", "x" * 300, '\n"\n"\n' * 9, " pad "]
    rows = [[str(i), fields[i % len(fields)], fields[(i * 7 + 3) % len(fields)]] for i in range(60)]
    for name in ("a", "b"):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as out:
            writer = plain.writer(out, lineterminator="\r\n" if name == "b" else "\n", quoting=plain.QUOTE_ALL)
            writer.writerow(["id", 'odd "name"', "text"])
            writer.writerows([[name + r[0], *r[1:]] for r in rows])
            if name == "a":
                out.write("\nbare,,\n")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = [tuple(r) for r in read_csv_split(spark, str(tmp_path)).collect()]
        names = read_csv_split(spark, str(tmp_path)).columns
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    expected = [(n + r[0], *r[1:]) for n in "ab" for r in rows] + [("bare", None, None)]
    assert sorted(got, key=str) == sorted(expected, key=str) and names == ["id", 'odd "name"', "text"]
