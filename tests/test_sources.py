import pytest
from pyspark.sql import functions as F

from linkspan.sources import records as src
from linkspan.sources import sinks


def test_read_split_and_truth(spark, tmp_path):
    for s in (1, 2, 3):
        (tmp_path / f"train_source{s}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f'S{s}-{k}\tName "{k}\tNA\tUS\n' for k in range(3)), encoding="utf-8")
    (tmp_path / "truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-0\tS2-0,S3-1\nS1-1\t\n")
    rows = src.read_split(spark, str(tmp_path), "train").orderBy("source", "source_row").collect()
    assert len(rows) == 9 and rows[4].entity_id == "S2-1" and rows[4].business_name == 'Name "1' and rows[4].business_address == "NA" and rows[4].source_row == 1
    truth = {r.s1_id: r.matched for r in src.read_truth(spark, str(tmp_path / "truth.tsv")).collect()}
    assert truth == {"S1-0": ["S2-0", "S3-1"], "S1-1": []}
    (tmp_path / "bad.tsv").write_text("id\tname\n1\t2\n")
    with pytest.raises(ValueError, match="header"):
        src.read_source(spark, str(tmp_path / "bad.tsv"))
    with pytest.raises(src.CleanTableMissing):
        src.read_clean(spark, str(tmp_path), "train", 1)


def test_writers_and_validator(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-b", 0), ("S1-a", 1)], "s1_id string, s1_row int")
    ranked = spark.createDataFrame([("S1-a", "S3-1", 2), ("S1-a", "S2-9", 1)], "s1_id string, cand_id string, rank int")
    matches = spark.createDataFrame([("S1-a", "S3-1")], "s1_id string, cand_id string")
    sinks.write_both(s1, ranked, matches, str(tmp_path / "m"), str(tmp_path / "c"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("part-*")))
    assert text == "source1_entity_id\tcandidate_entity_ids\nS1-b\t\nS1-a\tS2-9,S3-1\n"
    with pytest.raises(ValueError, match="candidates"):
        sinks.write_both(s1, ranked, spark.createDataFrame([("S1-b", "S3-1")], "s1_id string, cand_id string"), str(tmp_path / "m2"), str(tmp_path / "c2"))
    with pytest.raises(ValueError, match="twice"):
        sinks.candidate_lines(s1, ranked.union(ranked))
    lists = spark.createDataFrame([("S1-a", ["S2-1", "S2-1", "X-1"]), ("S1-z", ["S1-a"])], "s1_id string, ids array<string>")
    got = {r.rule: r.n for r in sinks.check_lists(lists, s1.select("s1_id")).collect()}
    assert got == {"repeated id in a list": 1, "S1 id in a list": 1, "bad prefix": 1, "missing S1": 1, "foreign S1": 1}


def test_cached_refuses_another_configuration(spark, tmp_path):
    make = lambda: spark.range(3)
    key = sinks.fingerprint({"k": 1})
    assert sinks.cached(spark, f"file://{tmp_path}/run", key, make).count() == 3
    assert sinks.cached(spark, f"file://{tmp_path}/run", key, lambda: 1 / 0).count() == 3
    with pytest.raises(ValueError, match="another"):
        sinks.cached(spark, f"file://{tmp_path}/run", "other", make)


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        text = "entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f"S1-{k}\tname {k}\t{'x' * (k % 50)}\tUS\n" for k in range(3000))
        (tmp_path / "t.tsv").write_text(text)
        rows = src.with_row(src.read_source(spark, str(tmp_path / "t.tsv")))
        assert rows.rdd.getNumPartitions() > 1
        assert all(r.entity_id == f"S1-{r.source_row}" for r in rows.collect()) and rows.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    memory = src.with_row(spark.range(100).repartition(5)).collect()
    assert sorted(r.source_row for r in memory) == list(range(100))


def test_clean_and_raw_side_by_side(spark):
    raw = spark.createDataFrame([("S1-0", "a", "b", "US"), ("S1-1", "c", "d", "US")], ", ".join(f"{c} string" for c in src.RECORD)).coalesce(1)
    clean = raw.select(*[F.col(c) if c in src.RECORD else F.lit("x").alias(c) for c in src.CLEAN])
    both = src.load_table(raw, clean, "both").orderBy("source_row").collect()
    assert [(r.entity_id, r.clean_business_name, r.clean_name_script) for r in both] == [("S1-0", "a", "x"), ("S1-1", "c", "x")]
    assert src.load_table(raw, clean).columns == raw.columns and src.load_table(raw, clean, "clean").columns == clean.columns
    with pytest.raises(ValueError, match="agree"):
        src.load_table(raw, clean.withColumn("entity_id", F.lit("S1-9")), "both")
    with pytest.raises(src.CleanTableMissing):
        src.load_table(raw, None, "both")


def test_shards_and_frames(spark, tmp_path):
    shard = spark.createDataFrame([(0, "S1-0", 1, "S2-5", 2, 5, 1.5, 0.5, "US")], f"{src.SHARD}, country string")
    sinks.write_shards(shard, str(tmp_path / "run"))
    assert src.read_shards(spark, str(tmp_path / "run")).collect() == shard.collect()
    records = spark.createDataFrame([("S1-0", "a", "b", "US"), ("S2-5", "c", "d", "US"), ("S2-6", "e", "f", "US")], ", ".join(f"{c} string" for c in src.RECORD))
    truth = spark.createDataFrame([("S1-0", ["S2-5"])], "s1_id string, matched array<string>")
    row = src.candidate_frames(shard, records, truth).first()
    assert (row.s1_business_name, row.cand_business_name, row.label) == ("a", "c", 1)
    assert "label" not in src.candidate_frames(shard, records).columns
    assert src.by_ids(records, spark.createDataFrame([("S2-6",), ("S2-6",)], "x string")).count() == 1
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-0\tS2-5,S2-6\nS1-1\t\n")
    assert {r.s1_id: r.candidates for r in src.read_candidates(spark, str(tmp_path / "c.tsv")).collect()} == {"S1-0": ["S2-5", "S2-6"], "S1-1": []}
    lists = lambda ids: spark.createDataFrame([("S1-0", ids)], "s1_id string, ids array<string>")
    assert [tuple(r) for r in sinks.subset_findings(lists(["S2-5", "S3-1"]), lists(["S2-5"])).collect()] == [("S1-0", "S3-1")]


def test_preflight_names_what_is_missing(spark, tmp_path):
    (tmp_path / "test_source1.tsv").write_text("")
    assert sinks.preflight(spark, str(tmp_path), "test") == [f"table {tmp_path}/test_source{s}.tsv" for s in (2, 3)]
