from namebridge.plans import fixtures


def test_tasks_of_a_table_grow_with_its_rows(spark, tmp_path, monkeypatch):
    """Few large files are spread by rows, so that no task grows with the table."""
    monkeypatch.setattr(fixtures, "TASK_ROWS", 10)
    for n, tasks in ((1, 1), (95, 10), (300, 30)):
        path = str(tmp_path / str(n))
        spark.range(n).coalesce(1).write.parquet(path)
        table = fixtures._scan(spark, path)
        assert table.rdd.getNumPartitions() == tasks and table.count() == n
