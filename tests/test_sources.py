"""Readers, sinks and views on small files."""

import pytest
from pyspark.sql import functions as F

from waybill.session import materialised, shared_folder
from waybill.sources import csv_tables, storage


def test_csv_with_line_breaks_quotes_and_byte_order_mark(spark, tmp_path):
    (tmp_path / "order_reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"linha um\nlinha ""dois""",2018-01-01 00:00:00,oops\n',
        encoding="utf-8",
    )
    (tmp_path / "category_translation.csv").write_text(
        "﻿product_category_name,product_category_name_english\nbrinquedos,toys\n", encoding="utf-8"
    )
    names = ("order_reviews", "category_translation")
    raw = csv_tables.read_raw(spark, str(tmp_path), {n: f"{n}.csv" for n in names})
    dated = csv_tables.parse_timestamps(raw["order_reviews"], ["review_creation_date", "review_answer_timestamp"])
    row = dated.first()
    assert row.review_comment_message == 'linha um\nlinha "dois"' and row.review_comment_title is None
    assert row.review_creation_date.year == 2018 and row.review_answer_timestamp is None
    assert raw["category_translation"].first().product_category_name == "brinquedos"
    counts = {r.table_name: r.n_rows for r in csv_tables.row_counts(raw).collect()}
    assert counts == {"order_reviews": 1, "category_translation": 1}


def test_columns_go_by_their_names_in_the_header(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("seller_state,further,seller_zip_code_prefix,seller_id,seller_city\nSP,?,01037,s1,x\n")
    raw = csv_tables.read_raw(spark, str(tmp_path), {"sellers": "sellers.csv"})
    assert raw["sellers"].columns == csv_tables.RAW_COLUMNS["sellers"]
    assert tuple(raw["sellers"].first()) == ("s1", "01037", "x", "SP")
    for header, wrong in (("a,b,c,d", "lacks columns"), ("seller_id,seller_id,seller_zip_code_prefix,seller_city,seller_state", "more than once")):
        (tmp_path / "other.csv").write_text(f"{header}\n1,2,3,4,5\n")
        with pytest.raises(ValueError, match=wrong):
            csv_tables.read_csv(spark, str(tmp_path / "other.csv"), csv_tables.RAW_COLUMNS["sellers"])
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        csv_tables.read_csv(spark, str(tmp_path / "empty.csv"), ["a"])


@pytest.mark.parametrize("multi_line", [False, True])
def test_files_of_a_folder_share_a_header(spark, tmp_path, multi_line):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("a,b\n3,4\n")
    got = csv_tables.read_csv(spark, str(tmp_path), ["b", "a"], multi_line)
    assert sorted(map(tuple, got.collect())) == [("2", "1"), ("4", "3")] and got.count() == 2
    (tmp_path / "2.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="header"):
        csv_tables.read_csv(spark, str(tmp_path), ["a", "b"], multi_line).collect()


AWKWARD = [
    'plain,1', '"quoted, with comma",2', '"two', 'lines",3', '"a ""doubled""', '', 'quote', '" , 4', ',5', '"",6', '   ', '"""begins and ends""",7',
    '"x', '"",""', 'y",8', 'last,9',
]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("block", [16, 40, 1 << 20])
def test_split_reading_equals_the_reader_of_whole_files(spark, tmp_path, end, block):
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write("text,é" + end + end.join(AWKWARD * 20) + end)
    whole = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', schema="text string, e string")
    settings = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        read = csv_tables.read_csv(spark, path, ["text", "é"], multi_line=True)
        got = sorted(map(tuple, read.collect()), key=repr)
        tasks = csv_tables.split_lines(spark, path).select("block").distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == sorted(map(tuple, whole.collect()), key=repr)
    assert tasks > 10 or block == 1 << 20


def test_a_quote_that_is_never_closed_takes_the_rest_of_its_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,2\n3,"4\n5,6\n')
    got = csv_tables.read_csv(spark, str(tmp_path / "t.csv"), ["a", "b"], multi_line=True).collect()
    assert len(got) == 2 and got[0].a in ("1", "3")


def test_replace_is_repeatable_and_exports_are_guarded(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "order_id int, feature_name string")
    path = str(tmp_path / "t.parquet")
    storage.replace_table(df, path)
    assert storage.replace_table(df, path).count() == 2
    folder = str(tmp_path / "export")
    storage.export_tables({"order_risk_drivers": df}, folder)
    sizes = storage.export_sizes(spark, folder, ["order_risk_drivers"])
    storage.assert_export_size(sizes, 1 << 20)
    with pytest.raises(AssertionError):
        storage.assert_export_size(sizes, 10)
    manifest = storage.manifest(spark, folder, ["order_risk_drivers"], "2020-01-01").first()
    assert manifest.n_rows == 2 and manifest.size_bytes == sizes["order_risk_drivers"]
    names = storage.register_snapshots(spark, folder, ["order_risk_drivers", "review_insights"])
    assert names == ["order_risk_drivers"]
    assert spark.sql("select count(*) from order_risk_drivers where driver_rank = 1").first()[0] == 2
    assert storage.path_exists(spark, folder) and not storage.path_exists(spark, folder + "x")


def test_materialised_goes_to_the_named_folder(spark):
    df = materialised(spark.range(3).toDF("id"))
    assert df.count() == 3
    assert shared_folder(spark) in df.inputFiles()[0]


def test_a_replacement_counts_when_it_is_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(3).toDF("id").write.parquet(path)
    assert storage.read_table(spark, path).count() == 3
    held = storage.replace_table(spark.range(5).toDF("id"), path)
    assert storage.read_table(spark, path).count() == 5
    # A write that dies half-way, and one that dies just before it would count, leave the old table.
    dying = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("dies"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="dies"):
        storage.replace_table(dying, path)
    with monkeypatch.context() as m:
        m.setattr(storage, "_point_to", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            storage.replace_table(spark.range(9).toDF("id"), path)
    assert storage.read_table(spark, path).count() == 5
    # A table may be replaced by what it says itself; who reads the version before still can.
    twice = storage.replace_table(storage.read_table(spark, path).withColumn("id", F.col("id") * 2), path)
    assert sorted(r.id for r in twice.collect()) == [0, 2, 4, 6, 8] and held.count() == 5
    storage.replace_table(twice.limit(1), path)
    versions = [p.name for p in (tmp_path / "t.parquet").iterdir() if p.name.startswith("v-")]
    assert len(versions) == 2 and storage.read_table(spark, path).count() == 1
    assert storage.stored_bytes(spark, path) < sum(p.stat().st_size for p in (tmp_path / "t.parquet").rglob("*.parquet"))


def test_snapshots_of_a_row_an_order_are_never_broadcast(spark, tmp_path):
    """Small files may hold more rows than a driver can: their size says nothing."""
    for name in ("order_risk_scores", "order_risk_drivers", "dim_date"):
        storage.replace_table(spark.range(100).toDF("order_id"), f"{tmp_path}/{name}.parquet")
    storage.register_snapshots(spark, str(tmp_path), ["order_risk_scores", "order_risk_drivers", "dim_date"])
    plan = lambda sql: spark.sql(sql)._jdf.queryExecution().sparkPlan().toString()
    both = plan("select count(*) from order_risk_scores s join order_risk_drivers d on s.order_id = d.order_id where s.order_id > 3")
    assert "SortMergeJoin" in both and "Broadcast" not in both
    assert "Broadcast" in plan("select count(*) from dim_date a join dim_date b on a.order_id = b.order_id")


def test_csv_reviews_are_written_by_more_than_one_task(spark, tmp_path):
    """Files grow in number with the texts, and every review comes back as it was."""
    from waybill.catalog.registry import open_warehouse
    from waybill.catalog.warehouse_queries import src_csv_split

    docs = spark.range(90).selectExpr("id as doc_id", "concat('a \"', id, '\"\nb') as text", "'s' as source")
    docs.repartition(20).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(90).selectExpr("id as doc_id", "1 as quality", "0 as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = src_csv_split(open_warehouse(spark, str(tmp_path)))
        assert 1 < len(got.inputFiles()) <= 10
        assert sorted(r[0] for r in got.select("review_id").collect()) == list(range(90))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_compressed_copies_take_less_disk_and_give_the_same_rows(spark, tmp_path):
    """Line breaks, quotes, nulls and headers of every file survive; the copy is far smaller."""
    columns = ["review_id", "order_id", "text"]
    texts = F.when(F.col("id") % 7 == 0, F.lit('a "quoted"\nline, and\r\nanother')).when(F.col("id") % 7 == 1, F.lit(None)).otherwise(F.lit("plain ção"))
    rows = spark.range(3000).repartition(3).select(F.col("id").cast("string").alias("review_id"), (F.col("id") % 50).cast("string").alias("order_id"), texts.alias("text"))
    size = lambda folder: sum(f.stat().st_size for f in folder.iterdir() if f.name.startswith("part-"))
    read = {}
    for kind in ("none", "gzip"):
        csv_tables.write_csv(rows, str(tmp_path / kind), kind)
        for multi_line in (False, True):
            found = csv_tables.read_csv(spark, str(tmp_path / kind), columns, multi_line)
            read[kind, multi_line] = sorted(map(str, found.collect()))
    assert size(tmp_path / "gzip") < size(tmp_path / "none") / 3
    assert read["gzip", True] == read["none", True] and len(read["gzip", True]) == 3000
    assert read["gzip", False] == read["none", False]
