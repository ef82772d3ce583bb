"""What queries compute once."""

from pyspark.sql import functions as F

from tidelog.plans import QUERIES, archive


def test_compressed_bodies_are_made_once(spark):
    df = QUERIES["inflate_mariadb"](spark, "/root/testdata/sf0.001")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("collect_list(") == 1


def test_images_of_the_archive_are_collected_once(spark, monkeypatch):
    """Not once for the events and once for the names of the files, and not stored before they are written."""
    events = archive.archive_events(spark, "/root/testdata/sf0.001")
    text = events._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("collect_list(") == 1
    stored = []
    monkeypatch.setattr(archive, "settle", lambda df, label: stored.append(label) or df, raising=False)
    monkeypatch.setattr(archive, "_written", {})
    assert archive.archive(spark, "/root/testdata/sf0.001") and not stored
