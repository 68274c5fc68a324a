import pytest
from pyspark.sql import functions as F

from replycast.schemas import ENTITIES
from replycast.sources import dump, importing, manifest, snapshots, tables
from tests.conftest import at

POSTS = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" AcceptedAnswerId="2" CreationDate="2020-01-01T10:00:00.123" Score="3"
       Body="&lt;p&gt;Hi&amp;nbsp;there &lt;code&gt;x=1&lt;/code&gt;&lt;/p&gt;" OwnerUserId="7"
       Title="Is this ok?" Tags="&lt;a&gt;&lt;b-c&gt;" AnswerCount="1" />
  <row Id="2" PostTypeId="2" ParentId="1" CreationDate="not a date" Score="-1" Body="" />
</posts>
"""


def test_read_posts(spark, tmp_path):
    folder = tmp_path / "posts"
    folder.mkdir()
    (folder / "unix-stackexchange-com.xml").write_text(POSTS)
    first, second = dump.read_entity(spark, "posts", str(folder)).orderBy("id").collect()
    assert first.creation_date == at("2020-01-01 10:00:00.123") and first.creation_year == 2020
    assert first.body == "<p>Hi&nbsp;there <code>x=1</code></p>"
    assert first.tags == ["a", "b-c"] and first.dataset_name == "unix-stackexchange-com"
    assert first.closed_date is None and first.content_license is None
    assert (second.parent_id, second.score, second.tags) == (1, -1, None)
    assert second.creation_date is None and second.creation_year is None


BROKEN = """<?xml version="1.0"?>
<votes>
  <row Id="1" PostId="2" VoteTypeId="2" CreationDate="2020-01-01T00:00:00" />
  <row Id="x" PostId="2" VoteTypeId="many" CreationDate="2020-01-01T00:00:00" />
  <row Id="3" PostId="2" VoteTypeId="2" CreationDate="yesterday" />
  <row PostId="2" VoteTypeId="2" />
  <row Id="5" PostId="2" VoteTy
  <row Id="6" PostId=2 VoteTypeId="2" />
  <row Id="7" PostId="2" VoteTypeId="3" />
</votes>
"""


def test_broken_rows_are_kept_apart(spark, tmp_path):
    (tmp_path / "cs-com.xml").write_text(BROKEN)
    (tmp_path / "fine-com.xml").write_text('<votes><row Id="1" PostId="1" VoteTypeId="1" /></votes>')
    (tmp_path / "none-com.xml").write_text("<votes></votes>")
    audited = dump.audit_entity(spark, "votes", str(tmp_path))
    sound = dump.sound_rows(audited)
    assert sound.columns == dump.read_entity(spark, "votes", str(tmp_path)).columns
    assert sorted(r.id for r in sound.collect()) == [1, 1, 7]
    bad = {r.record.split()[1]: r.problems for r in dump.quarantined(audited).collect()}
    assert bad == {
        'Id="x"': ["bad id", "bad vote_type_id"],
        'Id="3"': ["bad creation_date"],
        'PostId="2"': ["no id"],
        'Id="5"': ["unreadable"],
        'Id="6"': ["unreadable"],
    }
    report = {r.dataset_name: (r.n_rows, r.n_bad, r.problems) for r in dump.file_report(audited).collect()}
    assert report["fine-com"] == (1, 0, {}) and set(report) == {"cs-com", "fine-com"}
    assert report["cs-com"][:2] == (7, 5) and report["cs-com"][2]["unreadable"] == 2


def test_read_other_entities(spark, tmp_path):
    for entity, spec in ENTITIES.items():
        folder = tmp_path / entity
        folder.mkdir()
        sample = {"long": "5", "text": "x", "time": "2021-02-03T04:05:06", "tags": "<a>".replace(
            "<", "&lt;"), "bool": "True"}
        row = " ".join(f'{attr}="{sample[kind]}"' for attr, _, kind in spec.fields)
        (folder / "cs-com.xml").write_text(f"<{entity}><row {row} /></{entity}>")
        df = dump.read_entity(spark, entity, str(folder))
        assert df.columns == [*spec.columns, "dataset_name", *([spec.year] if spec.year else [])]
        read = df.head()
        assert read.dataset_name == "cs-com" and None not in tuple(read)
        if spec.year:
            assert read[spec.year] == 2021


def test_dump_key(spark):
    rows = [("Unix.StackExchange.com", "PostHistory.xml"), ("askubuntu.com", "Badges.xml")]
    df = spark.createDataFrame(rows, "forum string, file string")
    keys = [r.k for r in df.select(dump.dump_key(F.col("forum"), F.col("file")).alias("k")).collect()]
    assert keys == ["post_history/unix-stackexchange-com.xml", "badges/askubuntu-com.xml"]


def test_save_table(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3 + 2018).cast("int").alias("year"))
    path = str(tmp_path / "t")
    for rows in (df, df.where("id < 50")):
        tables.save_table(rows, "saved_by_year", ["year"], path)
    back = tables.read_table(spark, "default", "saved_by_year")
    assert back.count() == 50 and spark.read.parquet(path).count() == 50
    assert len(list((tmp_path / "t").glob("year=*"))) == 3
    tables.save_table(df.repartition(8), "saved_plain")
    assert len(tables.read_table(spark, "default", "saved_plain").inputFiles()) == 1


def test_pending_files(spark):
    schema = "file_name string, size long"
    asked = spark.createDataFrame([("a.7z", 1), ("b.7z", 2), ("c.7z", 4)], schema)
    there = spark.createDataFrame([("b.7z", 2), ("b.7z", 2)], schema)
    pending = manifest.pending_files(asked, there)
    assert sorted(r.file_name for r in pending.collect()) == ["a.7z", "c.7z"]
    assert tuple(manifest.pending_size(pending).head()) == (2, 5)
    assert manifest.pending_files(asked, there, overwrite=True).count() == 3
    nothing = manifest.pending_files(there, there)
    assert tuple(manifest.pending_size(nothing).head()) == (0, 0)


def test_upsert_snapshot(spark, tmp_path):
    path = str(tmp_path / "snap")

    def frame(*rows):
        return spark.createDataFrame(rows, "id string, n int, v int")

    def content(df):
        return {r.id: r.n for r in df.collect()}

    first = snapshots.upsert_snapshot(frame(("a", 1, 1), ("b", 2, 1)), path, version="v")
    assert content(first) == {"a": 1, "b": 2}
    update = frame(("b", 5, 2), ("c", 3, 1), ("b", 4, 1))
    assert content(snapshots.upsert_snapshot(update, path, version="v")) == {"a": 1, "b": 5, "c": 3}
    (tmp_path / "snap" / "version=9").mkdir()  # an unfinished write is not read
    assert content(snapshots.read_snapshot(spark, path)) == {"a": 1, "b": 5, "c": 3}
    assert content(first) == {"a": 1, "b": 2}


def test_one_dump_file_is_read_by_many_tasks(spark, tmp_path):
    rows = "\n".join(
        f'  <row Id="{i}" PostTypeId="1" Body="a/&gt; > b\n c &#xA;{i}" Title="t {i} " />' for i in range(3000)
    )
    (tmp_path / "cs-com.xml").write_text(f'<?xml version="1.0"?>\n<rows>\n{rows}\n</rows>\n')
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "20k")
    try:
        df = dump.read_entity(spark, "posts", str(tmp_path))
        assert df.rdd.getNumPartitions() > 5
        found = {r.id: (r.body, r.title) for r in df.collect()}
    finally:
        spark.conf.set(size, before)
    assert len(found) == 3000
    assert found[17] == ("a/> > b  c \n17", "t 17 ")


def test_failed_write_leaves_the_table(spark):
    tables.save_table(spark.range(5), "saved_twice")
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        tables.save_table(broken, "saved_twice")
    assert spark.table("saved_twice").count() == 5
    tables.save_table(spark.table("saved_twice").where("id > 1"), "saved_twice")
    assert spark.table("saved_twice").count() == 3


def test_repeated_keys_without_a_version(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "id string, n int")
    for _ in range(2):
        snap = snapshots.upsert_snapshot(rows, str(tmp_path / "snap"))
        assert sorted(map(tuple, snap.collect())) == [("a", 3), ("b", 2)]


def _deliver(folder, forum, ids):
    folder.mkdir(parents=True, exist_ok=True)
    rows = "".join(f'<row Id="{i}" PostId="{i}" VoteTypeId="2" />' for i in ids)
    (folder / f"{forum}.xml").write_text(f"<votes>{rows}</votes>")


def test_import_takes_new_files_alone(spark, tmp_path):
    source, target, progress = (str(tmp_path / part) for part in ("in/*", "table", "progress"))

    def run():
        stream = importing.import_new(spark, "votes", source, target, progress, 1)
        stream.awaitTermination()
        return stream

    def content():
        rows = spark.read.parquet(target).collect()
        return sorted((r.dataset_name, r.id) for r in rows)

    _deliver(tmp_path / "in" / "may", "a-com", [1, 2])
    _deliver(tmp_path / "in" / "may", "b-com", [3])
    run()
    assert content() == [("a-com", 1), ("a-com", 2), ("b-com", 3)]
    files = sorted((tmp_path / "table").rglob("*.parquet"))
    assert run().lastProgress is None or run().lastProgress["numInputRows"] == 0
    assert sorted((tmp_path / "table").rglob("*.parquet")) == files
    # a new delivery replaces the forum's partition and leaves the others as they are
    _deliver(tmp_path / "in" / "june", "a-com", [1, 4])
    run()
    assert content() == [("a-com", 1), ("a-com", 4), ("b-com", 3)]
    assert [f for f in files if "b-com" in str(f)] == [
        f for f in sorted((tmp_path / "table").rglob("*.parquet")) if "b-com" in str(f)
    ]


def test_failed_import_leaves_the_partitions_and_is_taken_up_again(spark, tmp_path, monkeypatch):
    source, target, progress = (str(tmp_path / part) for part in ("in/*", "table", "progress"))
    _deliver(tmp_path / "in" / "may", "a-com", [1, 2])
    importing.import_new(spark, "votes", source, target, progress).awaitTermination()
    _deliver(tmp_path / "in" / "june", "a-com", [5])

    def broken(*args, **options):
        rows = dump.read_entity(*args, **options)
        return rows.withColumn("id", F.when(F.col("id") == 5, F.raise_error(F.lit("no"))).otherwise(F.col("id")))

    monkeypatch.setattr(importing, "read_entity", broken)
    with pytest.raises(Exception):
        importing.import_new(spark, "votes", source, target, progress).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2]
    monkeypatch.undo()
    importing.import_new(spark, "votes", source, target, progress).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [5]


def test_look_up_reads_what_can_match(spark, tmp_path):
    path = str(tmp_path / "snap")
    rows = spark.range(20_000).select(F.concat(F.lit("f:"), F.col("id")).alias("id"), F.col("id").alias("n"))
    snapshots.publish_indexed(rows, path)
    # files of other buckets than those of the keys cannot be read any more
    wanted = [f"f:{i}" for i in range(30)]
    near = spark.createDataFrame([(i,) for i in wanted], "id string").select(snapshots._bucket("id").alias("b"))
    near = {f"bucket={r.b}" for r in near.collect()}
    for file in (tmp_path / "snap").rglob("*.parquet"):
        if file.parent.name not in near:
            data = file.read_bytes()
            footer = 8 + int.from_bytes(data[-8:-4], "little")
            file.write_bytes(data[:4] + b"\xff" * (len(data) - footer - 4) + data[-footer:])
            (file.parent / f".{file.name}.crc").unlink()
    with pytest.raises(Exception):
        snapshots.read_snapshot(spark, path).collect()

    def ask(*ids):
        return snapshots.read_matching(spark, path, spark.createDataFrame([(i,) for i in ids], "id string"))

    one = ask("f:7", None, "f:7")
    assert [tuple(r) for r in one.collect()] == [("f:7", 7)]
    plan = one._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,f:7)]" in plan
    some = {r.id for r in ask(*wanted).collect()}
    assert some >= set(wanted) and len(some) < 4_000
    assert ask().collect() == []
    snapshots.publish_indexed(rows.where("n < 10"), path)
    assert ask("f:77").collect() == []


def test_bloom_filters_are_as_large_as_their_files_need(spark, tmp_path):
    snapshots.publish_indexed(spark.range(2000).withColumn("v", F.lit(1)), str(tmp_path / "snap"))
    sizes = [f.stat().st_size for f in (tmp_path / "snap").rglob("*.parquet")]
    assert len(sizes) > 200 and max(sizes) < 100_000
