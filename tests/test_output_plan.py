from foliary.plans import registry


def test_empty_files_are_numbered_too(spark, tmp_path):
    made = [(1, "a", "s"), (2, "", "s"), (3, None, "s"), (4, "b", "s"), (5, "", "t")]
    spark.createDataFrame(made, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.sink, r.file[:2]) for r in registry.output_plan(spark, str(tmp_path)).collect()}
    assert got == {1: ("directory", "01"), 2: ("directory", "02"), 3: ("directory", "03"), 4: ("directory", "04"), 5: ("file", "01")}
