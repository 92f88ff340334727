"""Registered queries read whole texts."""

from docloom.plans.queries import queries


def test_quality_of_whole_turns(spark, tmp_path):
    def brute(v):
        special = sum(not c.isalnum() and c != " " for c in v) / max(len(v), 1)
        return 0.8 * (0.5 if len(v) > 100 else 1) * (0.6 if special > 0.3 else 1)

    texts = ["a" * 120 + "!" * 120, "!" * 60 + "a" * 400, "é" * 90 + "!" * 40, "short", ""]
    spark.createDataFrame([(1, i, "user", t) for i, t in enumerate([*texts, None])], "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["turn"]: r["score"] for r in queries()["quality_pipeline"](spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(texts))] == [brute(t) for t in texts] and got[len(texts)] == 0
