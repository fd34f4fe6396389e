"""Delimited-file sources, preprocessing policy and the batch driver."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rowsift.operators import metrics
from rowsift.operators.batch import batch_datasets
from rowsift.operators.preprocess import PreprocessError, preprocess
from rowsift.sources.delimited import (LoadError, dataset_name, list_datasets, scan_delimited,
                                       sniff_delimiter)


@pytest.fixture(scope="module")
def folder():
    root = tempfile.mkdtemp(prefix="rowsift-files-")
    os.makedirs(os.path.join(root, "a", "b"))

    def w(rel, text):
        with open(os.path.join(root, rel), "w") as f:
            f.write(text)
    rows = [f"{i},{'red' if i % 3 else 'blue'},{i % 2}" for i in range(60)]
    w("a/comma.csv", "x,color,Class\n" + "\n".join(rows) + "\n")
    w("a/b/semi.data", "x;y2;label\n1;2,5;0\n2;3;1\n3;4,5;0\n4;1;1\n")
    w("a/b/semi_clean.data", "x;label\n1;0\n2;1\n")
    w("a/tab.txt", "x\ty\tclass\n1\t2,1\t0\n2\t3\t1\n3\t4;2,7\t0\n")
    w("a/space.txt", "1 2 0\n3 4 1\n5  6 0\n")
    w("a/UPPER.CSV", "x,class\n1,0\n")
    w("a/g.json", "{}")
    w("a/empty.csv", "")
    w("a/missing.csv", "x,y,target\n1,2,0\nNA,3,1\n4,,0\n5,null,1\n6,7,1\n")
    w("a/allnull.csv", "x,y,target\n1,,0\nNA,3,1\n")
    card = "\n".join(f"{i},v{i % 99},w{i % 100},{i % 2}" for i in range(300))
    w("a/card.csv", "n,c99,c100,label\n" + card + "\n")
    w("a/const.csv", "k,x,label\n" + "\n".join(f"5,{i},{i % 2}" for i in range(40)) + "\n")
    w("a/notarget.csv", "a,b\n1,2\n3,4\n")
    return root


def test_list_datasets(spark, folder):
    paths = sorted(dataset_name(r.path) for r in list_datasets(spark, folder).collect())
    assert "a/UPPER.CSV" not in paths and "a/g.json" not in paths
    assert {"a/comma.csv", "b/semi.data", "a/tab.txt", "a/space.txt"} <= set(paths)


def p(folder, rel):
    return os.path.join(folder, rel)


def test_sniff(spark, folder):
    assert sniff_delimiter(spark, p(folder, "a/comma.csv")) == (",", True)
    assert sniff_delimiter(spark, p(folder, "a/b/semi.data")) == (";", True)
    assert sniff_delimiter(spark, p(folder, "a/b/semi_clean.data")) == (";", True)
    assert sniff_delimiter(spark, p(folder, "a/b/semi_clean.data"), True) == (",", True)
    assert sniff_delimiter(spark, p(folder, "a/tab.txt")) == ("\t", True)
    assert sniff_delimiter(spark, p(folder, "a/space.txt")) == ("whitespace", False)
    with pytest.raises(LoadError):
        sniff_delimiter(spark, p(folder, "a/empty.csv"))


def test_scan_types_and_missing(spark, folder):
    df = scan_delimited(spark, p(folder, "a/missing.csv"))
    assert dict(df.dtypes) == {"x": "bigint", "y": "bigint", "target": "bigint"}
    prep = preprocess(df)
    assert prep.table.count() == 2
    sp = scan_delimited(spark, p(folder, "a/space.txt"))
    assert sp.columns == ["c0", "c1", "c2"] and sp.count() == 3
    with pytest.raises(PreprocessError):
        preprocess(sp)
    assert preprocess(sp, target="c2").target == "c2"


def test_preprocess_policy(spark, folder):
    with pytest.raises(PreprocessError):
        preprocess(scan_delimited(spark, p(folder, "a/allnull.csv")))
    card = preprocess(scan_delimited(spark, p(folder, "a/card.csv")))
    assert card.dropped == ["c100"] and "c99" in card.features
    assert card.vocab["c99"][:2] == ["v0", "v1"]
    const = preprocess(scan_delimited(spark, p(folder, "a/const.csv")))
    assert {r.k for r in const.table.select("k").distinct().collect()} == {0.0}
    with pytest.raises(PreprocessError):
        preprocess(scan_delimited(spark, p(folder, "a/notarget.csv")))
    comma = preprocess(scan_delimited(spark, p(folder, "a/comma.csv")), assign_row_id=True)
    ids = sorted(r.row_id for r in comma.table.select("row_id").collect())
    assert ids == list(range(60)) and comma.target == "Class"
    stats = comma.table.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(stats[0]) < 1e-9 and abs(stats[1] - 1) < 1e-9


def test_batch(spark, folder):
    out = tempfile.mkdtemp(prefix="rowsift-out-")
    res, err = batch_datasets(spark, folder, out=out, generations=2, population=6, parents=2)
    ok = {r.dataset: r for r in res.collect()}
    bad = {r.dataset for r in err.collect()}
    assert "a/comma.csv" in ok and "a/empty.csv" in bad and "a/notarget.csv" in bad
    r = ok["a/comma.csv"]
    written = spark.read.option("header", True).csv(os.path.join(out, "dataset=a__comma.csv"))
    assert written.count() == r.selected_rows and written.columns[0] == "Class"


def test_metrics_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)], "label int, prediction int")
    rep = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert rep["1"].precision == pytest.approx(2 / 4) and rep["1"].recall == 1.0
    assert rep["2"].precision == 0.0 and rep["2"].f1 == 0.0 and rep["2"].support == 1
    assert rep["accuracy"].f1 == pytest.approx(3 / 5) and rep["accuracy"].support == 5
    assert metrics.accuracy(df).first()[0] == pytest.approx(0.6)
    r2 = metrics.r2(spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)],
                                          "label double, prediction double")).first()[0]
    assert r2 == 1.0


def test_cli_select(spark, folder, capsys):
    from rowsift.__main__ import main
    out = tempfile.mkdtemp(prefix="rowsift-cli-")
    assert main(["select", "--input", os.path.join(folder, "a", "b"), "--output", out,
                 "--generations", "1", "--population", "4", "--parents", "2"]) == 0
    printed = capsys.readouterr().out
    assert "semi.data" in printed and "elapsed" in printed
