"""Files are landed, and set aside, without a register to match them with."""

from namebridge.streaming.arrivals import LandingJob


def test_rejects_need_no_matching(spark, tmp_path):
    incoming, output = tmp_path / "incoming", tmp_path / "output"
    incoming.mkdir()
    (incoming / "good.csv").write_text("client_name,country\nApple,US\n  ,GB\n")
    (incoming / "bad.csv").write_text("company\nPear\n")
    job = LandingJob(spark, str(incoming), str(output))
    job.run()
    assert [r.country for r in job.rejects().collect()] == ["GB"]
    assert [r.headers for r in job.rejected_files().collect()] == ["company"]
    assert sorted(r.value for r in job.rejected_lines().collect()) == ["Pear", "company"]
    assert not (output / "batches").exists()
