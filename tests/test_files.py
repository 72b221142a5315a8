"""CSV readers keep ids and values as wide as the engine writes them."""

from coact.sources import files as fs

BIG = 3_000_000_000


def test_wide_ids_and_values_survive_the_csv_readers(spark, tmp_path):
    ratings, seen = str(tmp_path / "ratings"), str(tmp_path / "seen")
    fs.write_delimited(spark.createDataFrame([(BIG, 7, 16777217.0)], "user long, item long, rating double"), ratings)
    assert [tuple(r) for r in fs.read_ratings(spark, ratings).collect()] == [(BIG, 7, 16777217.0)]
    assert [r.user for r in fs.read_target_users(spark, ratings).collect()] == [BIG]
    fs.write_delimited(spark.createDataFrame([(BIG, BIG + 1), (BIG, 2)], "user long, item long"), seen)
    assert [tuple(r) for r in fs.read_seen_items(spark, seen).collect()] == [(BIG, [2, BIG + 1])]


def test_users_and_items_that_are_absent(spark, tmp_path):
    path = str(tmp_path / "empty")
    fs.write_delimited(spark.createDataFrame([], "user long, item long, rating double"), path)
    assert fs.read_ratings(spark, path).count() == 0
