"""Zero vectors and a single user give defined results instead of a failed job."""

from coact.operators.factor import rank_by_cosine
from coact.operators.serving import projection_2d
from coact.operators.weighting import entropy_weight


def test_zero_vector_is_left_out_of_the_ranking(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 1.0])], "id int, v array<double>")
    assert [tuple(r) for r in rank_by_cosine(df, "id", "v", 1).collect()] == [(1, 1.0), (3, 0.707107)]
    assert rank_by_cosine(df, "id", "v", 2).collect() == []


def test_zero_vector_is_left_out_of_the_map(spark):
    df = spark.createDataFrame([("a", 4, [3.0, 4.0]), ("b", 1, [0.0, 0.0])],
                               "item string, activity long, vector array<double>")
    assert [(r.item, r.x, r.y) for r in projection_2d(df).collect()] == [("a", 0.0, 0.0)]


def test_single_user_has_no_entropy(spark):
    tf = spark.createDataFrame([(0, 0, 5.0), (1, 0, 2.0)], "i long, j long, value double")
    assert {r.i: r.value for r in entropy_weight(tf).collect()} == {0: 1.0, 1: 1.0}
