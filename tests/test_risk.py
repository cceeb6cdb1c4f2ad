import math
import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from shelfrisk.operators import boosting as B
from shelfrisk.operators import schema as H
from shelfrisk.operators import sparse as Z
from shelfrisk.session import materialise, table_bytes
from shelfrisk.sources import files

LINES = ["0.57 12:1 19:1 junk 22:4 12:9", "0.3", "0.29 1:1", "nan 1:2", "0.1 500:7", "0.2 3:nan 5:1:9", "\t0.4\t2:1  "]
BAD = {"": "blank", "   ": "blank", "x 1:2": "bad risk", "0.2 a:1": "bad pair", "0.2 1:": "bad pair", "0.2 1:2d": "bad pair"}


def parsed(spark, lines):
    return Z.parse_lines(spark.createDataFrame([(x,) for x in lines], "line string"))


def test_parse(spark):
    got = {r["line"]: r for r in Z.as_map(Z.accepted(parsed(spark, LINES + list(BAD)))).collect()}
    assert set(got) == set(LINES)
    assert got[LINES[0]]["risk"] == 0.57 and got[LINES[0]]["features"] == {12: 9.0, 19: 1.0, 22: 4.0}
    assert math.isnan(got["nan 1:2"]["risk"]) and got[LINES[6]]["features"] == {2: 1.0}
    rejects = {r["line"]: r["problem"] for r in Z.rejected(parsed(spark, LINES + list(BAD))).collect()}
    assert rejects == BAD


def test_label(spark):
    got = {r["line"]: (r["risk_score"], r["target"]) for r in Z.labelled(Z.accepted(parsed(spark, LINES))).collect()}
    assert got["0.3"] == (0.3, 1) and got["0.29 1:1"] == (0.29, 0) and got["nan 1:2"] == (0.0, 0)


def test_wide_and_back(spark):
    wide = Z.wide(Z.accepted(parsed(spark, LINES)), ["line"])
    assert wide.columns == ["line", *[f"feature_{i}" for i in range(483)], "risk_score", "target"]
    got = {r["line"]: r for r in wide.collect()}
    assert sum(got["0.1 500:7"][f"feature_{i}"] for i in range(483)) == 0
    assert got[LINES[5]]["feature_3"] == 0.0 and got[LINES[5]]["feature_5"] == 1.0
    first = {i: got[LINES[0]][f"feature_{i}"] for i in range(483) if got[LINES[0]][f"feature_{i}"]}
    assert first == {12: 9.0, 19: 1.0, 22: 4.0}


def test_names(spark):
    names = lambda rows: [r[0] for r in H.unique_names(spark.createDataFrame(rows, "feature_name string, feature_number int"))
                          .orderBy("feature_number").collect()]
    assert names([("a", 0), ("b", 1), ("a", 2)]) == ["a_0", "b_1", "a_2"]
    assert names([("a", 0), ("b", 1)]) == ["a", "b"]


def test_rename(spark):
    mapping = spark.createDataFrame([("old", 0), ("x.dll", 1), ("new", 0), ("far", 99)],
                                    "feature_name string, feature_number int").coalesce(1)
    flat = spark.createDataFrame([(1.0, 2.0, 3.0)], "feature_0 double, feature_1 double, feature_2 double")
    renamed = H.rename_features(flat, mapping, 3)
    assert renamed.columns == ["new", "x.dll", "feature_2"]
    assert tuple(renamed.first()) == (1.0, 2.0, 3.0)


def test_fixed_columns_and_fill(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), 2.0)], "b double, `a.x` double")
    forced = H.force_columns(H.fill_zero(df), ["a.x", "new", "b"])
    assert forced.columns == ["a.x", "new", "b"]
    assert [tuple(r) for r in forced.collect()] == [(0.0, 0.0, 1.0), (2.0, 0.0, 0.0)]


def test_scoring_input(spark):
    good = spark.createDataFrame([(1, 2.0)], "`a.x` int, b double")
    H.check_scoring_input(good, ["a.x", "b"])
    for bad, columns in [(good, ["b", "a.x"]), (good, ["a.x"]), (good.withColumn("target", F.lit(1)), ["a.x", "b"]),
                         (good.withColumn("b", F.lit("1")), ["a.x", "b"]),
                         (good.withColumn("b", F.lit(float("nan"))), ["a.x", "b"]),
                         (good.withColumn("b", F.lit(None).cast("double")), ["a.x", "b"])]:
        with pytest.raises(ValueError):
            H.check_scoring_input(bad, columns)


def test_folder_mapping_and_csv(spark, tmp_path):
    (tmp_path / "jan.txt").write_text("0.5 0:1\n0.1 1:2\n")
    (tmp_path / "feb.txt").write_text("0.2 1:4\n\n")
    (tmp_path / "notes.md").write_text("0.9 0:9\n")
    lines = files.read_sparse_folder(spark, str(tmp_path))
    assert {(r["file"], r["line"]) for r in lines.collect()} == {
        ("jan.txt", "0.5 0:1"), ("jan.txt", "0.1 1:2"), ("feb.txt", "0.2 1:4"), ("feb.txt", "")}
    (tmp_path / "map.csv").write_text("feature_name,feature_number\na.x,0\nb,1.0\n")
    mapping = files.read_mapping(spark, str(tmp_path / "map.csv"))
    flat = H.rename_features(Z.wide(Z.accepted(Z.parse_lines(lines)), n_features=2), mapping, 2)
    files.write_csv(flat, str(tmp_path / "flat"))
    files.write_flat(flat, str(tmp_path / "flat_parquet"))
    back = files.read_csv(spark, str(tmp_path / "flat"), flat.schema)
    assert back.columns == ["a.x", "b", "risk_score", "target"]
    rows = sorted(map(tuple, flat.collect()))
    assert sorted(map(tuple, back.collect())) == rows == [(0.0, 2.0, 0.1, 0), (0.0, 4.0, 0.2, 0), (1.0, 0.0, 0.5, 1)]
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "flat_parquet")).collect())) == rows


def test_database_options():
    plain = files.jdbc_options("jdbc:sqlite:shop.db", "train")
    assert plain["dbtable"] == "train" and "numPartitions" not in plain
    split = files.jdbc_options("jdbc:x", "train", "store_nbr", (1, 45), tasks=8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "store_nbr", "1", "45", "8")


def test_classifier(spark, tmp_path):
    lines = [f"0.{i % 10} {'0:1 ' if i % 10 >= 3 else ''}1:{i % 4} 2:{i % 7}" for i in range(200)]
    records = spark.createDataFrame(list(enumerate(lines)), "k long, line string")
    rows = B.stored_rows(B.training_rows(Z.accepted(Z.parse_lines(records)), ["k"], 3).withColumn("fold", (F.col("k") % 4).cast("int")))
    scores = B.fold_scores(rows, "fold", k=4, maxIter=3).collect()
    assert len(scores) == 4 and all(r["precision"] == r["recall"] == 1.0 for r in scores)
    model = B.RiskModel(B.fit(rows, maxIter=3), ["a.x", "b", "c"])
    top = [r["feature"] for r in B.top_importances(spark, model, 2).collect()]
    assert len(top) == 2 and top[0] == "a.x"
    B.save_model(model, str(tmp_path / "model"))
    wide = spark.createDataFrame([(0, 1, 2, 3), (1, 0, 2, 3)], "k int, `a.x` int, b int, c int")
    loaded = B.load_model(str(tmp_path / "model"))
    first = B.score(wide, model, keep=["k"]).orderBy("k").collect()
    assert [tuple(r) for r in first] == [(0, 1), (1, 0)]
    assert B.score(wide, loaded, keep=["k"]).orderBy("k").collect() == first
    assert B.classifier().getMaxIter() == 100 and B.classifier().getSeed() == 42


def test_full_width_scoring(spark, tmp_path):
    rng = random.Random(1)
    names = [f"lib.part{i % 60}_{i}" for i in range(483)]
    rows = [(i, i % 2, *[rng.randrange(4) + 5 * (i % 2) * (j == 7) for j in range(483)]) for i in range(60)]
    table = spark.createDataFrame(rows, ["k", "target", *names])
    vectors = B.wide_rows(table, names, ["k", "target"]).withColumn("label", F.col("target").cast("double"))
    B.save_model(B.RiskModel(GBTClassifier(maxIter=2, maxDepth=2).fit(vectors), names, 0.5), str(tmp_path / "model"))
    model = B.load_model(str(tmp_path / "model"), names)
    assert (model.columns, model.threshold) == (names, 0.5)
    scored = B.score(table.drop("target"), model, keep=["k"]).collect()
    assert {r.k: r.predicted_risk_class for r in scored} == {i: i % 2 for i in range(60)}
    holed = table.drop("target").withColumn(names[0], F.when(F.col("k") != 3, H.quoted(names[0])))
    with pytest.raises(Exception, match="missing values"):
        B.score(holed, model, keep=["k"]).collect()


def test_model_folder_refuses_other_columns(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 2, i % 2, i % 3) for i in range(40)], "k int, target int, `a.x` int, b int")
    vectors = B.wide_rows(rows, ["a.x", "b"], ["target"]).withColumn("label", F.col("target").cast("double"))
    path = str(tmp_path / "model")
    classifier = GBTClassifier(maxIter=1, maxDepth=1).fit(vectors)
    B.save_model(B.RiskModel(classifier, ["a.x", "b"]), path)
    for other in (["b", "a.x"], ["a.x"], ["a.x", "b", "c"], ["a.x", "c"]):
        with pytest.raises(ValueError, match="other columns"):
            B.load_model(path, other)
        with pytest.raises(ValueError, match="features"):
            B.RiskModel(classifier, [*other, "more", "more"])
    model = B.load_model(path, ["a.x", "b"])
    with pytest.raises(ValueError, match="expected 2 feature columns"):
        B.score(rows.select("k", "b", "`a.x`"), model, keep=["k"])
    with pytest.raises(ValueError, match="must not hold"):
        B.score(rows, model, keep=["k"])
    assert {r.predicted_risk_class for r in B.score(rows.drop("target"), model, keep=["k"]).collect()} == {0, 1}


def test_training_rows_are_stored_sparse(spark):
    """Records of about 27 of 483 features take a fraction of their wide form, and hold the same vectors."""
    rng = random.Random(3)
    lines = [(i, f"0.{i % 10} " + " ".join(f"{j}:{rng.randrange(1, 9)}" for j in sorted(rng.sample(range(483), 27))) + " 999:1 4:nan") for i in range(500)]
    records = Z.accepted(Z.parse_lines(spark.createDataFrame(lines, "k long, line string")))
    rows = B.stored_rows(B.training_rows(records, ["k"]))
    wide = Z.wide(records, ["k"]).drop("risk_score")
    flat = {r[0]: list(r)[1:-1] for r in wide.collect()}
    got = rows.collect()
    assert all(r.features.toArray().tolist() == flat[r.k] and len(r.features.values) <= 27 and r.features.size == 483 for r in got)
    dense = materialise(Z.dense(Z.labelled(records)).select("k", "target", "values"))
    assert table_bytes(materialise(B.training_rows(records, ["k"]))) < table_bytes(dense) / 8


def test_observed_features(spark):
    lines = Z.accepted(parsed(spark, ["0.1 5:1 -3:2", "0.9 40000:1 5:nan 7:1", "0.5", "0.3 2147483647:1 -2147483648:4"]))
    numbers = [-2147483648, -3, 5, 7, 40000, 2147483647]
    assert Z.observed_features(lines) == numbers
    wide = Z.wide_observed(lines, ["line"])
    assert wide.columns == ["line", *[f"feature_{i}" for i in numbers], "risk_score", "target"]
    assert {tuple(r)[1:] for r in wide.collect()} == {(0, 2, 1, 0, 0, 0, 0.1, 0), (0, 0, 0, 1, 1, 0, 0.9, 1), (0, 0, 0, 0, 0, 0, 0.5, 1),
                                                     (4, 0, 0, 0, 0, 1, 0.3, 1)}
    assert Z.observed_features(lines.limit(0)) == []
    with pytest.raises(ValueError, match="at most 3"):
        Z.observed_features(lines, most=3)
