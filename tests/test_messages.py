import json
import os

import pytest

from coinwharf.sources.notifications import encode_notifications
from coinwharf.streaming.messages import acknowledged_arrivals


def put(spark, folder, name, start, count):
    objects = spark.range(start, start + count).selectExpr("'b' as bucket", "'f' || id || '.csv' as name")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as out:
        out.writelines(json.dumps({"data": row["data"]}) + "\n" for row in encode_notifications(objects).collect())
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def drained(spark, folder, checkpoint, fail_on=None):
    """The batches of one query that runs until nothing is left, as lists of paths."""
    batches = []

    def keep(batch, number):
        paths = [r["path"] for r in batch.select("path").collect()]
        if fail_on is not None and len(batches) == fail_on:
            batches.append(paths)
            raise RuntimeError("this batch fails")
        batches.append(paths)

    arrivals = acknowledged_arrivals(spark, folder + "/messages", folder + "/acks", max_rows=20_000)
    query = arrivals.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return batches


def test_messages_come_bounded_and_once_acknowledged_not_again(spark, folder):
    put(spark, folder + "/messages", "one.json", 0, 100_000)
    batches = drained(spark, folder, folder + "/first")
    assert [len(b) for b in batches] == [20_000] * 5
    assert {p for b in batches for p in b} == {f"gs://b/f{i}.csv" for i in range(100_000)}
    # a name that sorts before the known one comes behind it
    put(spark, folder + "/messages", "a.json", 100_000, 10)
    with open(folder + "/messages/a.json", "a") as out:
        out.write("no message\n[1]")
    batches = drained(spark, folder, folder + "/first")
    assert sorted(p or "" for b in batches for p in b) == ["", "", *sorted(f"gs://b/f{i}.csv" for i in range(100_000, 100_010))]
    # another checkpoint begins behind what was acknowledged; the last batch was done, but no later one began
    assert json.load(open(folder + "/acks/acknowledged.json")) == {"file": 1, "line": 0}
    again = [p for b in drained(spark, folder, folder + "/second") for p in b]
    assert len(again) == 12


def test_a_failed_batch_comes_again(spark, folder):
    put(spark, folder + "/messages", "one.json", 0, 50_000)
    failed = []
    with pytest.raises(Exception, match="fails"):
        failed = drained(spark, folder, folder + "/checkpoint", fail_on=1)
    assert not failed
    left = drained(spark, folder, folder + "/checkpoint")
    assert {p for b in left for p in b} == {f"gs://b/f{i}.csv" for i in range(20_000, 50_000)}
    assert max(map(len, left)) <= 20_000
