from conftest import rows

from stintlake.sources.bucketed import read_current
from stintlake.streaming.tail import tail_upsert


def test_tail_keeps_the_newest_row(spark, tmp_path):
    def load(items, day):
        spark.createDataFrame(items, "id int, v string").write.parquet(f"{tmp_path}/in/load_date={day}")
        tail_upsert(spark, f"{tmp_path}/in", "id int, v string", f"{tmp_path}/out", ["id"], f"{tmp_path}/cp").awaitTermination()
        return rows(read_current(spark, f"{tmp_path}/out"))

    assert load([(1, "a"), (2, "a")], "2024-01-01") == [(1, "a"), (2, "a")]
    assert load([(2, "b"), (3, "b")], "2024-01-02") == [(1, "a"), (2, "b"), (3, "b")]
