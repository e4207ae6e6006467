"""Ranking, split, curves, thresholds and metrics against brute force."""

from __future__ import annotations

import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from hooklens import lists
from hooklens.operators import (
    corpus as C, curves, errors as E, metrics as M, ranking, split as SP, textvec as T, variants as V,
)
from hooklens.sources import writers
from hooklens.sources.readers import read_metrics, stored_threshold
from tests.test_signals import messages


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_row_numbers_with_a_hot_key(spark, buckets):
    draw = random.Random(1)
    # a third of all rows shares one date, some dates are missing
    rows = [(i, "2020-01-01" if i % 3 == 0 else draw.choice([None, "a", "b", f"c{i}"])) for i in range(500)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "key long, date string")
    order = [F.col("date").isNull(), F.col("date"), F.col("key")]
    made = ranking.with_row_number(df, order, "id", start=5, buckets=buckets)
    expected = sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[0]))
    assert [(r["key"], r["date"]) for r in made.orderBy("id").collect()] == expected
    assert [r["id"] for r in made.orderBy("id").collect()] == list(range(5, 505))


def test_row_numbers_of_nothing(spark):
    df = spark.createDataFrame([], "key long")
    assert ranking.with_row_number(df, [F.col("key")], "id").collect() == []


def test_split_is_exact_per_class(spark):
    rows = [(i, "phishing" if i % 5 == 0 else "ham" if i % 5 < 4 else "other") for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, label string")
    made = {r["id"]: r["split"] for r in SP.stratified_split(df).collect()}
    expected = {}
    for label in ("ham", "phishing"):
        ids = [i for i, name in rows if name == label]
        ids.sort(key=lambda i: hashlib.md5(f"42:split:{i}".encode()).hexdigest())
        n_test = int(0.2 * len(ids) + 0.5)
        expected |= {i: "test" if k < n_test else "train" for k, i in enumerate(ids)}
    assert made == expected


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([(1, "ham"), (2, "phishing"), (3, "ham")], "id long, label string")
    made = SP.stratified_split(df).collect()
    assert len(made) == 3 and {r["split"] for r in made} == {"train"}
    assert SP.choose_test_size(df).first()["test_size"] == 0.5


def brute_points(rows):
    out = []
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(y for y, s in rows if s >= t)
        out.append((t, tp, sum(1 - y for y, s in rows if s >= t)))
    return out


def scored(spark, rows):
    return spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(rows)], "id long, y_true int, score double")


def random_rows(n, seed=3):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        y = int(draw.random() < 0.3)
        # one score holds a third of all rows
        s = 0.5 if draw.random() < 0.33 else round(0.6 * draw.random() + 0.3 * y, 2)
        rows.append((y, s))
    return rows


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_cumulative_counts(spark, buckets):
    rows = random_rows(400)
    made = curves.cumulative_counts(scored(spark, rows), buckets=buckets)
    found = [(r["threshold"], r["tp"], r["fp"]) for r in made.orderBy(F.desc("threshold")).collect()]
    assert found == brute_points(rows)


def brute_choice(rows, floor, shift):
    points = brute_points(rows)
    n_pos = sum(y for y, _ in rows)
    best = None
    for k, (t, tp, fp) in enumerate(points):
        if shift:
            tp, fp = (points[k - 1][1:] if k else (0, 0))
        p = tp / (tp + fp) if tp + fp else 1.0
        r = tp / n_pos
        f1 = 2 * p * r / (p + r) if p + r else 0.0
        key = (r >= floor, p if r >= floor else 0.0, f1, -t)
        best = max(best or (key, t), (key, t))
    return best[1], best[0][0]


@pytest.mark.parametrize("floor", [0.0, 0.5, 0.9, 1.1])
@pytest.mark.parametrize("alignment", ["same", "next"])
def test_threshold_choice(spark, floor, alignment):
    rows = random_rows(300, seed=5)
    row = curves.select_threshold(scored(spark, rows), floor, alignment).first()
    t, reached = brute_choice(rows, floor, alignment == "next")
    assert row["threshold"] == t
    assert row["mode"] == ("recall_floor" if reached else "maxF1_fallback")


def test_areas_and_quantiles(spark):
    rows = random_rows(300, seed=8)
    area = curves.curve_areas(scored(spark, rows)).first()
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for _, tp, fp in brute_points(rows):
        ap += (tp / len(pos) - last) * tp / (tp + fp)
        last = tp / len(pos)
    assert area["roc_auc"] == pytest.approx(auc) and area["pr_auc"] == pytest.approx(ap)
    found = curves.threshold_max_f1(scored(spark, rows)).first()
    ordered = sorted(s for _, s in rows)
    place = 0.8 * (len(ordered) - 1)
    low, high = ordered[int(place)], ordered[min(int(place) + 1, len(ordered) - 1)]
    assert found["q80"] == pytest.approx(low + (high - low) * (place - int(place)))


@pytest.mark.parametrize("rows", [[(0, 0.1), (0, 0.2)], [(1, 0.5), (1, 0.5)]])
def test_one_class(spark, rows):
    area = curves.curve_areas(scored(spark, rows)).first()
    assert area["roc_auc"] is None
    assert area["pr_auc"] == float(rows[0][0])
    assert curves.select_threshold(scored(spark, rows)).first()["threshold"] is not None


PUBLISHED = {  # tp, fp, tn, fn: accuracy, macro F1 as published for two of the experiments
    "E0": ((552, 44, 3265, 61), 0.9732279449260581, 0.9486630976044399, 0.9730740184961033),
    "E2": ((586, 4, 3305, 27), 0.992096, None, None),
}


def test_published_counts_give_published_report(spark):
    rows = [(e, *counts) for e, (counts, *_rest) in PUBLISHED.items()]
    counts = spark.createDataFrame(rows, "experiment string, tp long, fp long, tn long, fn long")
    report = {(r["experiment"], r["class"]): r for r in M.class_report(counts, ("experiment",)).collect()}
    assert report["E0", "accuracy"]["f1"] == pytest.approx(PUBLISHED["E0"][1])
    assert report["E0", "macro avg"]["f1"] == pytest.approx(PUBLISHED["E0"][2])
    assert report["E0", "weighted avg"]["f1"] == pytest.approx(PUBLISHED["E0"][3])
    assert report["E0", "phishing"]["precision"] == pytest.approx(0.9261744966442953)
    assert report["E0", "ham"]["support"] == 3309
    assert report["E2", "accuracy"]["f1"] == pytest.approx(PUBLISHED["E2"][1], abs=1e-6)


def test_no_predictions_of_a_class(spark):
    row = M.confusion(scored(spark, [(0, 0.1), (0, 0.2)]), 0.5).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_metrics_in_both_layouts(spark, tmp_path):
    (tmp_path / "E0_metrics.json").write_text(json.dumps(
        {"experiment": "E0_text", "best": {"threshold": 0.5, "precision_at_thr": 0.9, "recall_at_thr": 0.8,
         "f1_plus_at_thr": 0.85, "average_precision": 0.95, "roc_auc": 0.97, "tp": 1, "n_train": 9}}, indent=2))
    (tmp_path / "e1_x.json").write_text(json.dumps(
        {"Limiar": 0.4, "Precision+": 0.95, "Recall+": 0.9, "F1+": 0.92, "PR-AUC": 0.96, "AUROC": 0.98, "TP": 2}))
    rows = {r["experiment"]: r for r in read_metrics(spark, str(tmp_path)).collect()}
    assert rows["E0"]["threshold"] == 0.5 and rows["E0"]["tp"] == 1 and rows["E0"]["n_train"] == 9
    assert rows["E1"]["precision_plus"] == 0.95 and rows["E1"]["tp"] == 2
    row = M.ablation(read_metrics(spark, str(tmp_path))).first()
    assert row["comparison"] == "E1 − E0" and row["delta_recall_plus"] == 0.1
    assert row["notes"] == "Limiar E1=0.4000; E0=0.5000"


def test_flat_record_stored_threshold_and_training_counts(spark, tmp_path):
    predictions = scored(spark, random_rows(60)).withColumn("experiment", F.lit("E0"))
    summary = M.metrics_summary(predictions)
    split = spark.createDataFrame([("ham", "train")] * 3 + [("phishing", "train"), ("ham", "test")], "label string, split string")
    row = M.with_training_counts(summary, split).first()
    assert (row["n_train"], row["train_ham"], row["train_phishing"], row["test_ham"], row["test_phishing"]) == (4, 3, 1, 1, 0)
    assert row["test_size"] == 0.2 and row["recall_floor"] == 0.9
    writers.write_metrics_json(writers.flat_metrics_documents(summary), str(tmp_path))
    back = read_metrics(spark, str(tmp_path), name_from="folder")
    found = back.first()
    assert found["support_plus"] + found["support_minus"] == 60 and '"mode"' in found["notes"]
    assert stored_threshold(back, "E0") == pytest.approx(row["threshold"])
    assert stored_threshold(back, "E9") == 0.5


def test_rule_lists_from_a_table(spark):
    rows = [("suspect_tlds", ".zip"), ("suspect_tlds", ".tk"), ("shorteners", "bit.ly"), ("shorteners", "bit.ly")]
    made = lists.RuleLists.from_table(spark.createDataFrame(rows, "list string, entry string"))
    assert made == lists.RuleLists(suspect_tlds=("tk", "zip"), shorteners=("bit.ly",), redirectors=(), markers=())


def flag_rows(spark, n):
    names = ("unicode_homoglyph", "shortened_url", "redirector_url", "ptbr_likely", "no_url", "headers_missing")
    rows = [(i, *[(i + k) % 3 == 0 for k in range(5)], False) for i in range(n)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} boolean" for c in names))


def test_robustness_names_empty_scenarios(spark):
    rows = {r["description"]: r for r in M.robustness(scored(spark, random_rows(60)), flag_rows(spark, 60), 0.5).collect()}
    assert len(rows) == 6
    assert rows["headers_missing == True"]["value"] == "NA" and rows["headers_missing == True"]["notes"] == "N=0"
    assert rows["no_url == True"]["notes"].startswith("N=20; ")


def test_examples_fall_back_to_near_misses(spark):
    rows = [(1, 0.52)] * 8 + [(0, 0.1)]
    flags = flag_rows(spark, 9)
    texts = messages(spark, *[{"subject": "s", "body": f"b{i}"} for i in range(9)])
    typed = E.error_typology(scored(spark, rows), flags, texts, 0.5)
    assert [r["tipo"] for r in E.error_counts(typed).collect()] == ["OK"]
    found = E.error_examples(typed, texts, 0.5).orderBy("id").collect()
    assert [r["id"] for r in found] == list(range(6)) and {r["tipo"] for r in found} == {"FN_quase"}
    typed = E.error_typology(scored(spark, [(0, 0.9)] * 9), flags, texts, 0.5)
    found = E.error_examples(typed, texts, 0.5)
    assert {r["tipo"] for r in found.collect()} == {"FP_ptbr", "FP_newsletter"} and found.count() == 6


def test_term_weights(spark):
    texts = ["the cat the hat", "the dog", "one", "", "a b c", "the the"]
    df = messages(spark, *[{"body": t} for t in texts])
    counts = {(r["id"], r["term"]): r["tf"] for r in T.term_counts(df).collect()}
    assert counts[0, "the"] == 2 and counts[0, "the cat"] == 1 and counts[5, "the the"] == 1
    assert (2, "one") in counts and not [k for k in counts if k[0] in (3, 4)]
    made = T.tfidf_relation(df).collect()
    assert {(r["id"], r["term"]) for r in made} == set(counts)
    for i in (0, 1, 2, 5):
        assert sum(r["weight"] ** 2 for r in made if r["id"] == i) == pytest.approx(1.0)
    kept = T.tfidf_relation(df, max_df=0.4).collect()
    assert "the" not in {r["term"] for r in kept}
    fitted = T.tfidf_relation(df, fit_on=df.filter("id < 2")).collect()
    assert {r["term"] for r in fitted if r["id"] == 5} == set()  # "the" is in all fitted messages


def test_linear_model_held_as_a_table(spark):
    weights = [(1, "hot", 0.6), (1, "rare", 0.8), (2, "hot", 1.0), (3, "new", 1.0)]
    relation = spark.createDataFrame(weights, "id long, term string, weight double")
    model = spark.createDataFrame([("hot", 2.0), ("rare", -1.0)], "term string, coefficient double")
    hot = spark.createDataFrame([("hot",)], "term string")
    expected = {1: 0.5 + 1.2 - 0.8, 2: 2.5, 3: 0.5}
    for frequent in (None, hot):
        found = {r["id"]: r["score"] for r in T.linear_scores(relation, model, 0.5, frequent).collect()}
        assert found == pytest.approx({i: 1 / (1 + math.exp(-m)) for i, m in expected.items()})


def test_variants(spark):
    base = messages(
        spark,
        {"label": "phishing", "subject": "s", "body": "see http://a.b/1) and http://a.b/1"},
        {"label": "ham", "subject": "s", "body": "hello", "headers_json": "{}"},
    )
    redirect = V.with_variant_mode(base, "FN_redirect").orderBy("id").collect()
    assert redirect[0]["body"].count("https://l.facebook.com/l.php?u=http://a.b/1") == 2
    assert redirect[1]["body"] == "hello Obrigado." and redirect[1]["headers_json"] == "{}"
    stripped = V.with_variant_mode(base, "FN_semurl").orderBy("id").first()["body"]
    assert stripped == "see ) and  Responda confirmando seus dados."
    header = V.with_variant_mode(base, "FP_headerok").orderBy("id").collect()
    assert json.loads(header[1]["headers_json"])["spf"] == "pass"
    assert header[1]["subject"] == "Ação necessária: s" and "none" in header[0]["headers_json"]
    made = V.expanded_with_variants(base, 25)
    rows = made.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(25)) and rows[0]["mode"] is None
    assert rows == made.orderBy("id").collect() and V.expanded_with_variants(base, 1).count() == 2


def test_corpora(spark):
    raw = spark.createDataFrame(
        [(3, None, "b", "ham", "2001"), (1, "s", None, "spam", None), (2, "t", "c", "ham", None)],
        "`Message ID` long, Subject string, Message string, `Spam/Ham` string, Date string",
    )
    ham = C.ordered_corpus(C.ham_corpus(raw)).collect()
    assert [(r["id"], r["subject"], r["date"]) for r in ham] == [(3, "", "2001"), (2, "t", None)]
    phish = spark.createDataFrame([("x", 7), ("y", 5)], "text string, k long")
    made = C.phishing_corpus(phish, [F.col("k")])
    assert [(r["id"], r["body"], r["subject"]) for r in made.orderBy("id").collect()] == [(0, "y", ""), (1, "x", "")]
    merged = C.merged_corpus(C.ham_corpus(raw), made).orderBy("id").collect()
    assert [(r["id"], r["body"], r["label"]) for r in merged] == [
        (1, "b", "ham"), (2, "c", "ham"), (3, "y", "phishing"), (4, "x", "phishing"),
    ]
    bad = raw.withColumn("Spam/Ham", F.lit("maybe"))
    with pytest.raises(ValueError, match="maybe"):
        C.relabelled_corpus(bad)
    with pytest.raises(ValueError, match="missing columns"):
        C.ham_corpus(raw.drop("Date"))
    with pytest.raises(ValueError, match="unexpected labels"):
        C.require_labels(raw.withColumn("label", F.col("`Spam/Ham`")))
    with pytest.raises(ValueError, match="none of the columns"):
        C.phishing_corpus(raw.select("Date"), [F.col("Date")])


@pytest.mark.parametrize("buckets", [1, 7, 60])
def test_counts_over_any_ranges(spark, buckets):
    """Groups of many, few and equal scores, whatever the ranges they are cut into."""
    draw = random.Random(buckets)
    rows = [("many", draw.random(), draw.randint(0, 1)) for _ in range(400)]
    rows += [("few", draw.choice([0.1, 0.5]), draw.randint(0, 1)) for _ in range(100)] + [("one", 0.3, 1)]
    df = spark.createDataFrame(rows, "experiment string, score double, y_true int")
    found = {(r["experiment"], r["threshold"]): (r["tp"], r["fp"], r["n_pos"], r["n_neg"])
             for r in curves.cumulative_counts(df, ("experiment",), buckets).collect()}
    expected = {}
    for g in ("many", "few", "one"):
        own = [(s, y) for e, s, y in rows if e == g]
        for t in {s for s, _ in own}:
            tp = sum(y for s, y in own if s >= t)
            expected[g, t] = (tp, sum(1 for s, _ in own if s >= t) - tp, sum(y for _, y in own), sum(1 - y for _, y in own))
    assert found == expected
