"""What is kept up part by part or batch by batch against what is computed at once."""

import random
import re
from functools import partial, reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replycast.operators import prefix, tags, users
from replycast.operators.skew import running_totals
from replycast.streaming import snapshots

from .conftest import at

# --- snapshots kept up by a stream ---------------------------------------------------------------


def _updates(n, seed):
    rng = random.Random(seed)
    return [(rng.choice("abcdefg"), rng.randint(0, 99), rng.randint(0, 30)) for _ in range(n)]


def _newest(rows):
    best = {}
    for key, value, version in rows:
        best[key] = max(best.get(key, (-1, -1)), (version, value))
    return {key: value for key, (_, value) in best.items()}


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id string, value int, version int")


def _content(spark, path):
    return {r.id: r.value for r in snapshots.read_snapshot(spark, path).collect()}


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_batches_in_any_order_and_again(spark, tmp_path, order):
    path, rows = str(tmp_path / "s"), _updates(80, 1)
    batches = [rows[i::4] for i in range(4)]
    for i in order:
        assert snapshots.apply_batch(_frame(spark, batches[i]), path, "f", i)
    for i in order:  # run again: in the ledger; sent again by another feed: the same rows win
        assert not snapshots.apply_batch(_frame(spark, batches[i]), path, "f", i)
        assert snapshots.apply_batch(_frame(spark, batches[i][:5]), path, "again", i)
    assert _content(spark, path) == _newest(rows)


def test_compaction_keeps_the_content_and_later_batches_win(spark, tmp_path):
    path, rows = str(tmp_path / "s"), _updates(60, 2)
    for i in range(3):
        snapshots.apply_batch(_frame(spark, rows[i * 20 : i * 20 + 20]), path, "f", i)
        if i < 2:
            snapshots.compact(spark, path)
            snapshots.compact(spark, path)
    assert _content(spark, path) == _newest(rows)
    assert len(list((tmp_path / "s" / "base").iterdir())) == 2
    # a late row of an old version changes nothing, also after a compaction
    snapshots.apply_batch(_frame(spark, [("a", 1, -5)]), path, "f", 3)
    assert _content(spark, path) == _newest(rows)


def test_unfinished_batches_are_not_read_and_written_over(spark, tmp_path):
    path = str(tmp_path / "s")
    snapshots.apply_batch(_frame(spark, [("a", 1, 1), (None, 9, 9)]), path, "f", 0)
    (tmp_path / "s" / "batches" / "feed=f" / "batch=1").mkdir()
    assert _content(spark, path) == {"a": 1}
    assert snapshots.apply_batch(_frame(spark, [("a", 2, 2)]), path, "f", 1)
    assert _content(spark, path) == {"a": 2}
    with pytest.raises(ValueError):
        snapshots.apply_batch(_frame(spark, []), path, "no/such", 0)
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, str(tmp_path / "none"))


def test_stream_begun_again_goes_on(spark, tmp_path):
    rows, source, path = _updates(90, 3), tmp_path / "in", str(tmp_path / "s")
    source.mkdir()

    def deliver(i):
        _frame(spark, rows[i * 30 : i * 30 + 30]).coalesce(1).write.parquet(str(source / f"d={i}"))

    def run():
        feed = spark.readStream.schema("id string, value int, version int").option("maxFilesPerTrigger", 1)
        stream = snapshots.upsert_stream(feed.parquet(f"{source}/d=*"), path, "f", str(tmp_path / "c"), every=2)
        stream.awaitTermination()

    for i in (0, 1):
        deliver(i)
    run()
    assert _content(spark, path) == _newest(rows[:60])
    deliver(2)
    run()
    run()
    assert _content(spark, path) == _newest(rows)


# --- running totals from parts -------------------------------------------------------------------

DAYS = ("2020-01-01", "2020-03-01", "2021-04-01")
EVENTS = "k string, g long, t timestamp, w long, i long"


def _events(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        month, day = rng.randint(1, 12), rng.randint(1, 28)
        when = f"{rng.choice([2020, 2020, 2021])}-{month:02}-{day:02} {rng.choice([0, 0, 5, 23]):02}:{rng.choice([0, 30]):02}:00"
        rows.append((rng.choice("xxxxy"), rng.randint(0, 2), at(when) if i % 50 else None, rng.randint(0, 5), i))
    return rows


def _parts(df, time):
    bounds = zip(DAYS, (*DAYS[1:], "2100-01-01"))
    return [df.where((F.col(time) >= F.lit(a)) & (F.col(time) < F.lit(b))) for a, b in bounds]


@pytest.mark.parametrize("compacted", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_parts_give_the_totals_of_the_whole(spark, tmp_path, inclusive, compacted):
    path, keys = str(tmp_path / "h"), ["k", "g"]
    events = spark.createDataFrame(_events(400, 4), EVENTS)
    options = {
        "inclusive": inclusive,
        "lags": {"older_1": (F.col("w"), 1), "older_30": (F.col("w"), 30), "older_365": (F.lit(1), 365)},
        "first": "start",
    }
    sums = {"n": F.lit(1), "total": F.col("w")}
    whole = running_totals(events.where("t is not null"), keys, "t", sums, **options)
    found = []
    for day, part in zip(DAYS, _parts(events, "t")):
        if compacted and day == DAYS[2]:
            prefix.compact(spark, path, day, keys, "t", 365)
        found.append(prefix.prefix_totals(path, day, part, keys, "t", sums, **options).collect())
    rows = [r.asDict() for part in found for r in part]
    want = [r.asDict() for r in whole.collect()]
    assert sorted(rows, key=lambda r: r["i"]) == sorted(want, key=lambda r: r["i"])


def test_a_part_again_replaces_itself_and_late_events_are_an_error(spark, tmp_path):
    path = str(tmp_path / "h")
    first, second, _ = _parts(spark.createDataFrame(_events(200, 5), EVENTS), "t")
    add = partial(prefix.prefix_totals, path, keys=["k"], at="t", sums={"n": F.lit(1)})
    add(DAYS[0], first)
    one, two = (sorted(map(str, add(DAYS[1], second).collect())) for _ in range(2))
    assert one == two and len(one) > 5
    with pytest.raises(ValueError):
        add(DAYS[2], second)


def test_a_new_part_reads_few_rows_of_the_kept_ones(spark, tmp_path):
    path = str(tmp_path / "h")
    old = spark.range(20_000).select(
        (F.col("id") % 2000).cast("string").alias("k"),
        (F.lit(at("2020-01-05 00:00:00")) + F.expr("make_dt_interval(0, int(id % 5))")).alias("t"),
    )
    prefix.prefix_totals(path, DAYS[0], old, ["k"], "t", {"n": F.lit(1)})
    kept = spark.read.parquet(f"{path}/part={DAYS[0]}")
    assert kept.count() == 2000  # a row for each key and day, not for each event
    new = spark.createDataFrame([("7", at("2020-04-01 00:00:00"))], "k string, t timestamp")
    totals = prefix.prefix_totals(path, DAYS[1], new, ["k"], "t", {"n": F.lit(1)})
    assert [r.n for r in totals.collect()] == [10]
    scans = re.findall(r"PartitionFilters: \[([^]]*)\]", totals._jdf.queryExecution().toString())
    # of the 64 buckets that of the one key is listed
    assert any(re.search(r"bucket#\d+L? = \d+", scan) for scan in scans)


def test_features_of_parts_equal_those_of_the_whole(spark, tmp_path, make_posts):
    rng = random.Random(6)
    posts = [
        {
            "id": i,
            "post_type_id": rng.choice([1, 1, 2]),
            "owner_user_id": rng.choice([None, 1, 2, 3]),
            "creation_date": at(f"2020-{rng.randint(1, 12):02}-{rng.randint(1, 28):02} 0{rng.randint(0, 9)}:00:00"),
            "score": rng.randint(-2, 5),
            "tags": rng.choice([None, ["a"], ["a", "b"], ["b", "b", "c"]]),
            "accepted_answer_id": rng.choice([None, 5]),
            "answer_count": rng.choice([None, 0, 2]),
        }
        for i in range(200)
    ]
    posts = make_posts(*posts)
    for name, build in {
        "users": users.user_history, "tags": lambda p, totals=running_totals: tags.tag_features(p, totals=totals)
    }.items():
        found = [
            build(part, totals=partial(prefix.prefix_totals, str(tmp_path / name), day))
            for day, part in zip(DAYS, _parts(posts, "creation_date"))
        ]
        found, whole = reduce(DataFrame.unionByName, found), build(posts)
        assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
