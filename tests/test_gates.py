"""Gates whose edges the test tables don't reach."""

from corpusloom.plans.gates import first_like


def test_like_wildcards_meet_by_prefix(spark):
    rows = [
        (12, "s", "a_b", "data/s/none/1-500/7_x.pdf"),
        (123, "s", "a_b", "data/s/a_b/1-500/123_file.pdf"),  # 12 and any character: found for 12, too
        (5, "s", "a_b", "data/s/a-b/x/y/5_deep.hwp"),  # _ of the type is any character, % may hold folders
        (9, "s", "a_b", None),
        (77, "s", "a_b", "data/s/a_b/1-500/77"),  # nothing after the id
        (8, "t", "a_b", "data/s/a_b/1-500/8_other.pdf"),  # another source
    ]
    df = spark.createDataFrame(rows, "id long, source string, doc_type string, body_file_path string")
    found = {r.id: r.matched_id for r in first_like(df).collect()}
    df.createOrReplaceTempView("like_rows")
    pairs = spark.sql("SELECT a.id, min(b.id) AS m FROM like_rows a LEFT JOIN like_rows b ON b.body_file_path LIKE concat('data/', a.source, '/', a.doc_type, '/%/', a.id, '_%') GROUP BY a.id")
    want = {r.id: r.m for r in pairs.collect()}
    assert found == want == {12: 123, 123: 123, 5: 5, 9: None, 77: None, 8: None}
