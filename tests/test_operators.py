"""Edge cases of audit, line, sampling, file and streaming operators."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import audit as A
from corpusloom.operators import lines as L
from corpusloom.operators.sampling import representative_samples
from corpusloom.plans import audit as P
from corpusloom.sources import files

SF = "/root/testdata/sf0.001"
COLUMNS = "row_id string, status string, cso_classification string, body_text string, coverage_cell_key string"


def test_first_failing_rule_wins(spark):
    rows = spark.createDataFrame([("", "ok", "C", "b", "k"), ("1", " ", "C", "b", "k"), ("2", "ok", "X", "", "k"), ("3", "ok", "C", " \n", "k"), ("4", "ok", "C", "b", None), ("5", "ok", "C", "b", "z"), ("6", "failed", None, None, None), ("7", "ok", "S", "b", "k"), (None, None, None, None, None)], COLUMNS)
    cells = spark.createDataFrame([("k", 1)], "coverage_cell_key string, planned_target long")
    got = {r.row_id: (r.error_code, r.error_field) for r in A.row_errors(rows, cells).collect()}
    assert got == {"": ("missing_field", "row_id"), "1": ("missing_field", "status"), "2": ("unknown_enum", "cso_classification"), "3": ("empty_body", "body_text"), "4": ("missing_field", "coverage_cell_key"), "5": ("unknown_cell", "coverage_cell_key"), "6": (None, None), "7": (None, None), None: ("missing_field", "row_id")}


def test_merge_follows_the_growing_box(spark):
    def line(pos, text, x0, y0, x1, y1, block=0):
        return (1, 1, pos, block, text, x0, y0, x1, y1)

    rows = [line(0, "a", 0, 0, 10, 10), line(1, "b", 9, 12, 50, 22), line(2, "c", 40, 24, 60, 34), line(3, "", 0, 36, 9, 40), line(4, "d", 0, 38, 9, 48), line(5, "e", 0, 50, 9, 60, 1), line(6, "f", 20, 62, 30, 72, 1)]
    df = spark.createDataFrame(rows, "doc_id long, page long, pos long, block_id long, text string, x0 long, y0 long, x1 long, y1 long")
    got = sorted((r.first_pos, r.lines) for r in L.merge_wrapped(df).collect())
    assert got == [(0, 3), (4, 1), (5, 1), (6, 1)]


def test_merge_stops_at_forty_lines(spark):
    df = spark.range(95).select(F.lit(1).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("page"), F.col("id").alias("pos"), F.lit(0).cast("long").alias("block_id"), F.lit("t").alias("text"), F.lit(0).cast("long").alias("x0"), (F.col("id") * 10).alias("y0"), F.lit(9).cast("long").alias("x1"), (F.col("id") * 10 + 9).alias("y1"))
    assert sorted(r.lines for r in L.merge_wrapped(df).collect()) == [15, 40, 40]


def test_upper_median_and_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), ("b", 2), ("b", 9)], "g string, body_length long")
    assert {r.g: r["median"] for r in A.upper_median(df, "g").collect()} == {"a": 3, "b": 2}


def test_representatives_respect_caps(spark):
    summary = A.summaries(P.rows_of(spark, SF))
    coverage = A.coverage_actual(P.rows_of(spark, SF), P.cells_of(spark, SF))
    rows = representative_samples(summary, coverage, 15, {"row-1"}).collect()
    assert len({r.row_id for r in rows}) == len(rows) == 15 and "row-1" not in {r.row_id for r in rows}
    assert [r.sample_rank for r in rows] == list(range(1, 16))


def test_split_long_keeps_words(spark):
    df = spark.createDataFrame([(1, "word " * 400), (2, ""), (3, None), (4, "x" * 1000)], "doc_id long, text string")
    rows = L.split_long(df, 128).collect()
    assert max(len(r.text) for r in rows) <= 128 and {r.doc_id for r in rows} == {1, 4}


def test_csv_contract(spark, tmp_path):
    (tmp_path / "a.csv").write_text('row_id,body\n1,"two\nlines"\n')
    assert files.read_csv(spark, str(tmp_path / "a.csv"), ["row_id"]).first().body == "two\nlines"
    with pytest.raises(files.ContractError):
        files.read_csv(spark, str(tmp_path / "a.csv"), ["row_id", "title"])


def test_publish_once(spark, tmp_path):
    df = spark.range(5)
    manifest = files.publish({"t": df}, str(tmp_path / "out")).collect()
    assert [(r.name, r.rows) for r in manifest] == [("t", 5)]
    with pytest.raises(files.ContractError):
        files.publish({"t": df}, str(tmp_path / "out"))


def test_discover(spark, tmp_path):
    (tmp_path / "s" / "report").mkdir(parents=True)
    (tmp_path / "s" / "report" / "7_x.PDF").write_bytes(b"")
    (tmp_path / "s" / "report" / "8_x.pdf").write_bytes(b"abc")
    (tmp_path / "9_x.hwp").write_bytes(b"a")
    got = sorted((r.source, r.doc_type, r.doc_id, r.format, r.length) for r in files.discover(spark, str(tmp_path)).collect())
    assert got == [("_unclassified", "_unclassified", "9", "hwp", 1), ("s", "report", "8", "pdf", 3)]


def test_schema_changes(spark):
    out = files.accept_changes(spark.range(1), spark.range(1).withColumn("b", F.lit("x")))
    assert sorted((r.id, r.b) for r in out.collect() if r.b) == [(0, "x")] and out.count() == 2


@pytest.mark.parametrize("files", [1, 40])
def test_small_files_of_events_share_a_batch(spark, tmp_path, files):
    from corpusloom.streaming.ingest import event_stream

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    here = f"file://{tmp_path}/tables"
    if files == 1:  # a file among other tables
        (tmp_path / "tables").mkdir()
        for name in ("events", "orders", "labels"):
            (tmp_path / "tables" / f"{name}.parquet").symlink_to(f"/root/testdata/sf0.001/{name}.parquet")
    else:
        events.repartition(files).write.parquet(f"{here}/events.parquet")
    seen = []
    stream = event_stream(spark, here).writeStream.foreachBatch(lambda df, n: seen.append(df.count())).option("checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(availableNow=True).start()
    stream.awaitTermination()
    assert seen == [events.count()]
