"""Global positions without a global task."""

from collections import Counter

import pytest

from aerolag.operators import rank


def test_codes_follow_sorted_order(spark):
    rows = [(f"v{i * 7 % 50:03}", f"w{i % 3}") for i in range(500)] + [(None, "w1")]
    df = spark.createDataFrame(rows, "v string, w string")
    codes = rank.dense_codes(df, ["v", "w"])
    for name, column in (("v", 0), ("w", 1)):
        values = sorted({row[column] for row in rows if row[column] is not None})
        found = {r["value"]: r["code"] for r in codes.where(f"name = '{name}'").collect()}
        assert found == {value: i for i, value in enumerate(values)}
    encoded = rank.encode(df, codes, {"v": "code"})
    assert encoded.where("v is null").first()["code"] == -1
    assert encoded.count() == len(rows)


@pytest.mark.parametrize("n", [0, 7, 10, 129, 1000])
def test_split_sizes_and_rows(spark, n):
    rows = [(i % 40, "x") if i % 3 else (0, "copy") for i in range(n)]
    df = spark.createDataFrame(rows, "a int, b string")
    sides = rank.split_exact(df).collect()
    assert Counter((r["a"], r["b"]) for r in sides) == Counter(rows)
    assert sum(r["split"] == "train" for r in sides) == n // 10 * 9


def test_copies_share_out_over_both_sides(spark):
    df = spark.range(1000).selectExpr("1 AS a")
    sides = Counter(r["split"] for r in rank.split_exact(df).collect())
    assert sides == {"train": 900, "test": 100}


def test_large_groups_expand_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(rank, "CHUNK", 10)
    counted = spark.createDataFrame([("a", 95), ("b", 3), ("c", 0), ("d", 10), ("e", 11)], "k string, n bigint")
    found = Counter(r["k"] for r in rank.expand(counted, "n").collect())
    assert found == {"a": 95, "b": 3, "d": 10, "e": 11}


def test_one_hot_is_sparse_over_several_columns(spark):
    rows = [(f"v{i % 40:02}", "ab"[i % 2], 1) for i in range(200)] + [(None, "a", 1), ("v00", None, 2)]
    df = spark.createDataFrame(rows, "v string, w string, `size` int")
    values = {name: sorted({row[i] for row in rows if row[i] is not None}) for i, name in enumerate(("v", "w"))}
    for row in rank.one_hot(df, ["v", "w"]).collect():
        expected = [values["v"].index(row["v"]) - 1] if row["v"] not in (None, "v00") else []
        expected += [39 + values["w"].index(row["w"]) - 1] if row["w"] == "b" else []
        assert (row["dummies"]["size"], row["dummies"]["indices"]) == (40, expected)
    unseen = spark.createDataFrame([("new", "b")], "v string, w string")
    assert rank.one_hot(unseen, ["v", "w"], rank.dense_codes(df, ["v", "w"])).first()["dummies"]["indices"] == [39]
    none = spark.createDataFrame([(None, None)], "v string, w string")
    assert rank.one_hot(none, ["v", "w"]).first()["dummies"] == (0, [])
