"""Connected components: results and the number of files of a round."""
from rostrum import session
from rostrum.llm import components as c


def test_rounds_with_few_links_write_few_files(spark, monkeypatch):
    written = []

    def land(df, label):
        written.append(session.land(df, label))
        return written[-1]

    monkeypatch.setattr(c, "land", land)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for key, value in zip(held, ("40", "false")):
            spark.conf.set(key, value)
        chains = [(k + 1, k) for k in range(0, 400) if k % 10 != 9]
        found = dict(c.components(spark.createDataFrame([*chains, (900, 7), (7, 900), (5, 5)], "u long, v long")).collect())
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
    assert found == {**{k: k // 10 * 10 for k in range(400)}, 900: 0}
    assert len(written) > 2 and all(len(t.inputFiles()) <= c.FILES for t in written[1:]) and len(written[0].inputFiles()) > c.FILES


def test_more_links_go_to_more_files(spark, monkeypatch):
    monkeypatch.setattr(c, "LINKS", 4)
    parts = []
    monkeypatch.setattr(c, "land", lambda df, label: parts.append(df.rdd.getNumPartitions()) or session.land(df, label))
    held = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = dict(c.components(spark.createDataFrame([(k, 0) for k in range(1, 60)], "u long, v long")).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == {k: 0 for k in range(60)} and parts[-1] == 14       # 59 links // 4
