import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coinwharf.operators.upsert import DuplicateSourceKeys
from coinwharf.session import join_side, staged
from coinwharf.sources.tables import SnapshotTable

DDL = "k string, day date, x int, kept int"


def d(n):
    return None if n is None else dt.date(2025, 1, n)


def table(spark, folder, partition=("day", "day")):
    return SnapshotTable(spark, folder, StructType.fromDDL(DDL), partition, ["k"])


def frame(spark, rows):
    return spark.createDataFrame([(k, d(day), x, kept) for k, day, x, kept in rows], DDL)


def plain(places):
    """Places without the part of their names that is a writer's own."""
    return sorted(re.sub("^(v=[0-9]+)-[0-9a-f]+", r"\1", place) for place in places)


def rows_of(t):
    return {tuple(r) for r in t.read().collect()}


@pytest.mark.parametrize("partition", [("day", "day"), None])
def test_merge_moves_a_row_to_its_new_partition(spark, folder, partition):
    t = table(spark, folder, partition)
    assert t.merge(frame(spark, [("a", 1, 1, 1), ("b", 1, 2, 2), ("c", 2, 3, 3), ("n", None, 4, 4)]), ["k"], ["x", "day"]) == {
        "keep": 0, "update": 0, "insert": 4}
    counts = t.merge(frame(spark, [("b", 3, 20, 99), ("n", 1, 40, 99), ("e", 2, 50, 50)]), ["k"], ["x", "day"])
    assert counts == {"keep": 2, "update": 2, "insert": 1}
    assert rows_of(t) == {
        ("a", d(1), 1, 1), ("b", d(3), 20, 2), ("c", d(2), 3, 3), ("n", d(1), 40, 4), ("e", d(2), 50, 50)}
    assert t.row_count() == t.read().count() == 5


def test_inserts_rewrite_nothing(spark, folder):
    t = table(spark, folder)
    t.merge(frame(spark, [("a", 1, 1, 1)]), ["k"], ["x"])
    before = set(t.state().locations)
    t.merge(frame(spark, [("b", 1, 2, 2)]), ["k"], ["x"])
    assert before < set(t.state().locations)


def test_only_touched_days_are_rewritten(spark, folder):
    t = table(spark, folder)
    t.merge(frame(spark, [("a", 1, 1, 1), ("b", 2, 2, 2)]), ["k"], ["x"])
    t.merge(frame(spark, [("b", 2, 5, 5)]), ["k"], ["x"])
    assert plain(t.state().locations) == ["v=1/day=2025-01-01", "v=2/day=2025-01-02"]
    assert rows_of(t) == {("a", d(1), 1, 1), ("b", d(2), 5, 2)}


def test_merge_against_brute_force(spark, folder):
    rng = random.Random(3)
    t, expected = table(spark, folder), {}
    for _ in range(4):
        batch = {f"k{rng.randrange(40)}": (rng.choice([None, 1, 2, 3]), rng.randrange(9), rng.randrange(9)) for _ in range(25)}
        t.merge(frame(spark, [(k, *v) for k, v in batch.items()]), ["k"], ["day", "x"])
        for k, (day, x, kept) in batch.items():
            expected[k] = (k, d(day), x, expected[k][3] if k in expected else kept)
        assert rows_of(t) == set(expected.values())
        assert t.row_count() == len(expected)


def test_a_load_is_committed_once(spark, folder):
    t = table(spark, folder)
    rows = frame(spark, [("a", 1, 1, 1)])
    t.append(rows, load_id="one")
    t.append(rows, load_id="one")
    t.append(frame(spark, [("b", 1, 2, 2)]), load_id="two")
    assert t.row_count() == 2
    assert [r.k for r in t.rows_of("two").collect()] == ["b"]
    assert t.merge(frame(spark, [("a", 1, 9, 9)]), ["k"], ["x"], load_id="two") == {}


def test_strict_merge_refuses_repeated_keys(spark, folder):
    with pytest.raises(DuplicateSourceKeys):
        table(spark, folder).merge(frame(spark, [("a", 1, 1, 1), ("a", 2, 2, 2)]), ["k"], ["x"], strict=True)
    assert table(spark, folder).row_count() == 0


def test_replace_may_read_the_table_itself(spark, folder):
    t = table(spark, folder)
    t.append(frame(spark, [("a", 1, 1, 1), ("b", 2, 2, 2)]))
    t.replace(t.read().where("x > 1"))
    assert rows_of(t) == {("b", d(2), 2, 2)}


def test_unfinished_writes_are_not_seen(spark, folder):
    t = table(spark, folder)
    t.append(frame(spark, [("a", 1, 1, 1)]))
    t._write(frame(spark, [("z", 1, 1, 1)]), "v=2-0")  # the job dies before the commit
    assert rows_of(t) == {("a", d(1), 1, 1)}
    t.append(frame(spark, [("b", 1, 2, 2)]))
    assert rows_of(t) == {("a", d(1), 1, 1), ("b", d(1), 2, 2)}


def test_save_modes(spark, folder):
    t = table(spark, folder)
    one, two = frame(spark, [("a", 1, 1, 1)]), frame(spark, [("b", 1, 1, 1)])
    t.save(one, "append")
    t.save(two, "append")
    assert t.row_count() == 2
    t.save(two, "ignore")
    assert t.row_count() == 2
    with pytest.raises(ValueError):
        t.save(two, "error")
    t.save(one, "overwrite")
    assert rows_of(t) == {("a", d(1), 1, 1)}
    with pytest.raises(ValueError):
        t.save(one, "upsert")


def test_empty_and_derived_partition(spark, folder):
    schema = StructType.fromDDL("k string, updated_at timestamp")
    t = SnapshotTable(spark, folder, schema, ("updated_date", "updated_at"), ["k"])
    t.ensure()
    t.ensure()
    assert t.state().version == 1 and t.read().columns == ["k", "updated_at"] and t.read().isEmpty()
    t.append(spark.createDataFrame([("a", dt.datetime(2025, 3, 4, 23, 59))], schema))
    assert plain(t.state().locations) == ["v=2/updated_date=2025-03-04"]
    assert t.read().columns == ["k", "updated_at"]
    t.append(spark.createDataFrame([], schema))
    assert t.row_count() == 1


def test_schema_comes_from_the_query(spark, folder):
    t = SnapshotTable(spark, folder)
    with pytest.raises(ValueError):
        t.read()
    t.replace(spark.range(3))
    assert SnapshotTable(spark, folder).read().count() == 3
    t.replace(spark.createDataFrame([("x",)], "other string"))
    assert SnapshotTable(spark, folder).read().columns == ["other"]


def test_day_filter_prunes_folders(spark, folder):
    t = table(spark, folder)
    t.append(frame(spark, [("a", 1, 1, 1), ("b", 2, 2, 2)]))
    plan = t.read().where("day >= date'2025-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_small_source_is_broadcast_and_the_target_not_shuffled(spark, folder):
    from coinwharf.operators.upsert import apply_updates
    from coinwharf.session import staged

    t = table(spark, folder)
    t.append(frame(spark, [("a", 1, 1, 1)]))
    source = staged(frame(spark, [("a", 1, 5, 5)]), "test")
    plan = apply_updates(t.read(), source, ["k"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_hot_day_is_split_over_tasks(spark, folder):
    """A day with a third of the rows becomes several files; the other days stay whole."""
    from pyspark.sql import functions as F

    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 12000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("k"),
            F.when(F.col("id") % 3 == 0, d(1)).otherwise(
                F.date_add(F.lit(d(2)), (F.col("id") % 20).cast("int"))).alias("day"),
            F.lit(1).alias("x"), F.lit(1).alias("kept"))
        t = table(spark, folder)
        t.append(rows)
    finally:
        for k in settings:
            spark.conf.unset(k)
    counts = Counter(path.split("day=")[1].split("/")[0] for path in t.read().inputFiles())
    assert t.row_count() == t.read().count() == 12000
    assert counts["2025-01-01"] > 1 and len(counts) == 21
    assert sorted(counts.values())[len(counts) // 2] == 1


def test_rows_that_need_no_gathering_are_not_shuffled(spark, folder):
    schema = StructType.fromDDL("k string, at timestamp")
    t = SnapshotTable(spark, folder, schema, ("day", "at"), gather=False)
    at = dt.datetime(2025, 1, 1, 12)
    t.append(spark.createDataFrame([(str(i), at) for i in range(100)], schema).repartition(4))
    assert t.row_count() == 100 and len(t.read().inputFiles()) == 4


def test_whole_versions_are_read_by_their_root(spark, folder):
    from coinwharf.sources.tables import _places

    t = table(spark, folder)
    t.append(frame(spark, [("a", 1, 1, 1), ("b", 2, 2, 2)]))
    assert plain(_places(t.state().live)) == ["v=1"]
    t.merge(frame(spark, [("b", 2, 5, 5), ("c", 3, 3, 3)]), ["k"], ["x"])
    assert plain(_places(t.state().live)) == ["v=1/day=2025-01-01", "v=2"]
    assert rows_of(t) == {("a", d(1), 1, 1), ("b", d(2), 5, 2), ("c", d(3), 3, 3)}


def test_the_log_is_read_in_few_files_however_many_commits(spark, folder, monkeypatch):
    from coinwharf.sources import tables

    monkeypatch.setattr(tables, "COMPACT", 5)
    t = table(spark, folder)
    for n in range(23):
        rows = frame(spark, [(f"k{n % 7}", n % 3 + 1, n, n)])
        t.replace(rows) if n == 11 else t.merge(rows, ["k"], ["x"], load_id=f"load{n}")
    assert len(t._entries().inputFiles()) <= 5
    assert t.state().version == 23 and t.state("load3").seen and not t.state("load99").seen
    assert t.row_count() == t.read().count() == 7
    assert t.merge(frame(spark, [("k1", 1, 99, 99)]), ["k"], ["x"], load_id="load3") == {}


def test_a_log_without_snapshots_is_the_same(spark, folder, monkeypatch):
    from coinwharf.sources import tables

    states = []
    for compact in (2, 1000):
        monkeypatch.setattr(tables, "COMPACT", compact)
        t = table(spark, f"{folder}/{compact}")
        for n in range(7):
            t.merge(frame(spark, [("a", n % 2 + 1, n, n), (f"b{n}", 2, n, n)]), ["k"], ["x", "day"], load_id=str(n))
        states.append((t.state().version, plain(t.state().locations), rows_of(t), sorted(map(tuple, t.rows_of("3").collect()))))
    assert states[0] == states[1]


def test_expire_deletes_what_left_the_table(spark, folder):
    import os

    t = table(spark, folder)
    t.merge(frame(spark, [("a", 1, 1, 1), ("b", 2, 2, 2)]), ["k"], ["x"])
    t.merge(frame(spark, [("b", 2, 5, 5)]), ["k"], ["x"])
    before = rows_of(t)
    assert t.expire() == 1 and rows_of(t) == before
    (first,) = (name for name in os.listdir(f"{folder}/data") if name.startswith("v=1-"))
    assert not os.path.exists(f"{folder}/data/{first}/day=2025-01-02") and os.path.exists(f"{folder}/data/{first}/day=2025-01-01")
    t.replace(frame(spark, [("c", None, 1, 1)]))
    assert t.expire() == 2 and rows_of(t) == {("c", None, 1, 1)}
    assert t.expire() == 0


def test_a_second_writer_is_refused(spark, folder):
    from coinwharf.sources.tables import ConcurrentWrite

    one, two = table(spark, folder), table(spark, folder)
    stale = two.state()
    one.append(frame(spark, [("a", 1, 1, 1)]))
    with pytest.raises(ConcurrentWrite):
        two._commit(stale, frame(spark, [("b", 1, 1, 1)]), [], None)
    assert rows_of(one) == {("a", d(1), 1, 1)}


def test_a_refused_writer_leaves_the_other_ones_rows(spark, folder, monkeypatch):
    """Both begin from one version; the second writes its rows while the first is between its own
    rows and its log entry."""
    import os

    from coinwharf.sources.tables import ConcurrentWrite

    one, two = table(spark, folder), table(spark, folder)
    one.append(frame(spark, [("z", 1, 1, 1)]))
    mine, theirs = frame(spark, [(f"a{i}", 1, i, i) for i in range(5)]), frame(spark, [(f"b{i}", 1, i, i) for i in range(7)])
    stale = two.state()
    renamed, order = SnapshotTable._renamed, []

    def slow(self, old, new):
        if self is one and not order:
            order.append("two writes")
            assert two._write(theirs, "v=2-0") and two._commit(stale, theirs, [], None) == 7
        return renamed(self, old, new)

    monkeypatch.setattr(SnapshotTable, "_renamed", slow)
    with pytest.raises(ConcurrentWrite):
        one.append(mine)
    assert order and rows_of(one) == {("z", d(1), 1, 1), *((f"b{i}", d(1), i, i) for i in range(7))}
    assert one.row_count() == 8 and one.append(mine) == 5 and one.row_count() == one.read().count() == 13
    # what the refused writer had written is gone; "0" is the unfinished write above
    assert len([n for n in os.listdir(f"{folder}/data") if n.startswith("v=2-") and n != "v=2-0"]) == 1


def test_only_files_with_a_match_are_rewritten(spark, folder):
    """One row of a folder of many files."""
    t = SnapshotTable(spark, folder, StructType.fromDDL(DDL), ("day", "day"), ["k"], gather=False)
    rows = frame(spark, [(f"k{i:03}", 1, i, i) for i in range(200)]).repartition(8, "k")
    t.append(rows)
    before = {path: spark.read.parquet(path).count() for path in t.read().inputFiles()}
    assert len(before) == 8
    for n in (1, 2, 3):
        counts = t.merge(frame(spark, [("k007", 1, 1000 + n, 0), (f"new{n}", 1, n, n)]), ["k"], ["x"])
        assert counts == {"keep": 199 + n - 1, "update": 1, "insert": 1}
        after = set(t.read().inputFiles())
        if n == 1:
            assert len(set(before) - after) == 1 and len(set(before) & after) == 7
            (lost,) = set(before) - after
            rewritten = sum(spark.read.parquet(path).count() for path in after - set(before))
            assert rewritten == before[lost] + 1
    expected = {(f"k{i:03}", d(1), 1003 if i == 7 else i, i) for i in range(200)} | {(f"new{n}", d(1), n, n) for n in (1, 2, 3)}
    assert rows_of(t) == expected and t.row_count() == 203
    t.expire()
    assert rows_of(t) == expected


def test_state_after_a_commit_is_what_the_log_says(spark, folder, monkeypatch):
    from coinwharf.sources import tables

    rng = random.Random(5)
    monkeypatch.setattr(tables, "COMPACT", 4)
    t = SnapshotTable(spark, folder, StructType.fromDDL(DDL), ("day", "day"), ["k"], gather=False)
    for n in range(9):
        rows = [(k, rng.choice([None, 1, 2]), n, n) for k in {f"k{rng.randrange(30)}" for _ in range(12)}]
        t.merge(frame(spark, rows).repartition(3), ["k"], ["x", "day"], load_id=str(n))
        known, read = t.state(), t._state()
        key = lambda e: (e["location"], e["day"], e["rows"], sorted(e["gone"]), e["siblings"], e["load_id"])
        assert sorted(map(key, known.live), key=repr) == sorted(map(key, read.live), key=repr)
        assert (known.version, known.last_load, known.recent, known.commits) == (read.version, read.last_load, read.recent, read.commits)
    assert t.row_count() == t.read().count()


def test_an_older_row_does_not_replace_a_newer_one(spark, folder):
    """Any order of arrivals gives the row with the greatest stamps, ties by the other columns."""
    rng = random.Random(9)
    rows = [("a", day, x, kept) for day in (None, 1, 2) for x in (1, 2) for kept in (None, 4)] + [("b", None, 1, 1)]
    hidden = StructType.fromDDL("stamp int")
    for _ in range(2):
        rng.shuffle(rows)
        t = SnapshotTable(spark, f"{folder}/{rng.random()}", StructType.fromDDL("k string, x int, kept int"), hidden=hidden)
        for row in rows:
            source = spark.createDataFrame([(row[0], row[2], row[3], row[1])], "k string, x int, kept int, stamp int")
            t.merge(source, ["k"], ["x", "kept"], newest=["stamp", "x"], tie=["kept"])
        assert rows_of(t) == {("a", 2, None), ("b", 1, 1)} and t.read().columns == ["k", "x", "kept"]


def test_images_add_up_to_the_table(spark, folder):
    rng = random.Random(11)
    t = table(spark, folder)
    t.merge(frame(spark, [("a", 1, 1, 1)]), ["k"], ["x", "day"])
    assert t.changes_since(0, 1) is None
    start = t.read().select("k", "day", "x").collect()
    for n in range(3):
        rows = [(k, rng.choice([None, 1, 2]), n, n) for k in {f"k{rng.randrange(5)}" for _ in range(4)} | {"a"}]
        t.merge(frame(spark, rows), ["k"], ["x", "day"], changes=["k", "day", "x"])
    sums = Counter({tuple(r): 1 for r in start})
    for r in t.changes_since(1, 4).collect():
        sums[r["k"], r["day"], r["x"]] += r["sign"]
    assert {k for k, n in sums.items() if n} == {r[:3] for r in rows_of(t)} and set(sums.values()) <= {0, 1}


def test_a_filter_on_any_cluster_column_skips_row_groups(spark, folder):
    """Three columns in one order of rows; the footers tell what a reader may skip."""
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    schema = StructType.fromDDL("day date, branch string, product string, id string")
    options = {"parquet.block.size": "16384", "parquet.page.size": "2048", "parquet.block.size.row.check.min": "100", "parquet.page.size.row.check.min": "100"}
    t = SnapshotTable(spark, folder, schema, ("day", "day"), ["branch", "product", "id"], options=options)
    number = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    rows = spark.range(40000).select(
        F.lit(d(1)).alias("day"),
        F.format_string("B%02d", number(1, 40)).alias("branch"),
        F.format_string("P%03d", number(2, 500)).alias("product"),
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
    )
    t.append(rows)
    groups = [g for path in glob.glob(f"{folder}/data/*/*/*.parquet") for g in [pq.ParquetFile(path).metadata]]
    groups = [m.row_group(i) for m in groups for i in range(m.num_row_groups)]
    assert len(groups) > 30 and sum(g.num_rows for g in groups) == 40000
    names = [groups[0].column(i).path_in_schema for i in range(groups[0].num_columns)]
    for column, value in (("branch", "B07"), ("product", "P123"), ("id", "8" + "0" * 63)):
        stats = [g.column(names.index(column)).statistics for g in groups]
        kept = sum(s.min <= value <= s.max for s in stats)
        assert kept < len(groups) / 2, (column, kept, len(groups))
    assert t.read().exceptAll(rows).isEmpty() and t.read().where("product = 'P123'").count() == rows.where("product = 'P123'").count()


def test_many_rows_in_small_files_are_not_broadcast(spark):
    keys = staged(spark.range(200_000).select("id", F.lit("x").alias("day")), "keys")
    for rows, sent in ((10, True), (200_000, False)):
        joined = spark.range(10**8).join(join_side(keys.select("id"), rows), "id", "left_semi")
        assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) == sent


@pytest.mark.parametrize("newest", [(), ("day",)])
def test_a_merge_of_many_rows_joins_without_broadcast(spark, folder, monkeypatch, newest):
    plans = []

    def write(df, name, own=SnapshotTable._write):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return own(stored, df, name)

    monkeypatch.setattr("coinwharf.sources.tables.BROADCAST_ROWS", 0)
    monkeypatch.setattr("coinwharf.session.BROADCAST_ROWS", 0)
    stored = table(spark, folder)
    stored.append(frame(spark, [("a", 1, 1, 1), ("b", 1, 1, 1), ("c", 2, 1, 1), (None, 2, 1, 1)]))
    monkeypatch.setattr(stored, "_write", write)
    source = frame(spark, [("a", 3, 2, 2), ("b", 1, 2, 2), ("d", 1, 2, 2), ("e", None, 2, 2), (None, 2, 2, 2)])
    counts = stored.merge(source, ["k"], ["day", "x"], newest=newest)
    b = ("b", d(1), 2 - len(newest), 1)
    expected = [("a", d(3), 2, 1), b, ("c", d(2), 1, 1), ("d", d(1), 2, 2), ("e", None, 2, 2), (None, d(2), 1, 1), (None, d(2), 2, 2)]
    assert Counter(tuple(r) for r in stored.read().collect()) == Counter(expected)
    assert counts == {"keep": 2 + len(newest), "update": 2 - len(newest), "insert": 3}
    assert plans and "BroadcastHashJoin" not in plans[0]


@pytest.mark.parametrize("near", [0, 100])
def test_a_merge_of_many_rows_joins_once_for_rows_and_images(spark, folder, monkeypatch, near):
    """The same rows, counts and images as a merge of few rows; files without a match stay."""
    rng, results = random.Random(5), []
    loads = [[(rng.choice([None, *(f"k{n}" for n in range(12))]), rng.choice([None, 1, 2, 3]), n, rng.choice([None, 1])) for n in range(9)] for _ in range(2)]
    loads = [[("z", 9, 0, 5)], *loads, [("new", 1, 1, 1)], [(None, 1, 1, 1), ("k1", 5, 2, 2)]]
    staging, join = [], type(spark.range(0)).join
    for few in (10**6, 0):
        monkeypatch.setattr("coinwharf.sources.tables.BROADCAST_ROWS", few)
        monkeypatch.setattr("coinwharf.sources.tables.NEAR_ROWS", near)
        stored, counts = table(spark, f"{folder}/{few}"), []
        for rows in loads:
            kept = {k: row for *_, k, row in [(*r, r[0], r) for r in rows] if k}
            source = frame(spark, [*kept.values(), *[r for r in rows if r[0] is None]])
            joins = []
            monkeypatch.setattr(type(source), "join", lambda self, *a, **o: joins.append(1) or join(self, *a, **o))
            counts.append(stored.merge(source, ["k"], ["x", "day"], changes=["k", "day", "x", "kept"]))
            monkeypatch.undo()
            monkeypatch.setattr("coinwharf.sources.tables.BROADCAST_ROWS", few)
            monkeypatch.setattr("coinwharf.sources.tables.NEAR_ROWS", near)
            staging.append((few, len(joins)))
        sums = Counter()
        for r in stored.changes_since(1, len(loads)).collect():
            sums[tuple(r)[:-1]] += r["sign"]
        results.append((counts, Counter(tuple(r) for r in stored.read().collect()), {r: n for r, n in sums.items() if n}))
        assert ("z", d(9), 0, 5) in results[-1][1] and any(e["v"] == 1 for e in stored.state().live)
    assert results[0] == results[1]
    assert max(n for few, n in staging if not few) == 2  # one is planned to find files, and run only for a far larger target
