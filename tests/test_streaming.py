from __future__ import annotations

from affinis.streaming import preferences as S
from tests.conftest import as_dict


def test_changes_from_a_stream(spark, intro, tmp_path):
    inbox, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    first = [(1, "set", 1, 101, 1.0), (2, "remove", 1, 102, None), (3, "odd", 1, 103, 9.0)]
    spark.createDataFrame(first, S.CHANGES).write.json(inbox)
    S.log_changes(S.read_changes(spark, inbox), log, state).awaitTermination(60)
    spark.createDataFrame([(4, "set", 1, 102, 2.0)], S.CHANGES).write.mode("append").json(inbox)
    S.log_changes(S.read_changes(spark, inbox), log, state).awaitTermination(60)
    assert spark.read.parquet(log).count() == 3  # each change once
    got = as_dict(S.current_ratings(spark, intro, log).filter("user_id = 1"), ["item_id"], "rating")
    assert got == {101: 1.0, 102: 2.0, 103: 2.5}
