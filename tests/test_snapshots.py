import pytest
from pyspark.sql import functions as F

from freightloom.sources import snapshots
from freightloom.sources.snapshots import SnapshotStore, StaleDraft


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "published"))


def numbers(spark, start, end):
    return spark.range(start, end).withColumn("month", F.format_string("m%d", F.col("id") % 4))


def publish(store, table, df, part=None, key=None, keep=()):
    draft = store.draft()
    labels = draft.write(table, df, part, key)
    draft.keep(table, without=labels)
    for name in keep:
        draft.keep(name)
    return draft.publish()


def test_nothing_is_seen_before_publishing(spark, store):
    assert store.version() is None and store.parts() == []
    draft = store.draft()
    draft.write("t", numbers(spark, 0, 8), F.col("month"), F.col("id"))
    with pytest.raises(FileNotFoundError):
        store.read("t")
    assert draft.read("t").count() == 8
    assert draft.publish() == 1 == store.version()
    assert sorted(r.id for r in store.read("t").collect()) == list(range(8))
    assert store.read("t").columns == ["id", "month"]
    assert [(p.part, p.n_rows, p.key_low, p.key_high, p.odd_keys) for p in store.parts()] == [
        ("m0", 2, 0, 4, 0), ("m1", 2, 1, 5, 0), ("m2", 2, 2, 6, 0), ("m3", 2, 3, 7, 0),
    ]


def test_untouched_parts_keep_their_files(spark, store):
    publish(store, "t", numbers(spark, 0, 8), F.col("month"))
    before = {p.part: p.folder for p in store.parts()}
    publish(store, "t", numbers(spark, 100, 110).where("month = 'm2'"), F.col("month"))
    after = {p.part: p.folder for p in store.parts()}
    assert [k for k in before if before[k] != after[k]] == ["m2"]
    assert sorted(r.id for r in store.read("t").collect()) == [0, 1, 3, 4, 5, 7, 102, 106]
    assert sorted(r.id for r in store.read("t", version=1).collect()) == list(range(8))
    assert sorted(r.id for r in store.read("t", ["m2", "no such"]).collect()) == [102, 106]


def test_folders_stay_bounded_and_old_versions_go(spark, store, tmp_path):
    for k in range(5):
        publish(store, "t", numbers(spark, k, k + 40), F.col("month"))
        publish(store, "u", spark.range(k), keep=["t"])
        store.draft().write("t", numbers(spark, 0, 4))  # dies
    assert store.versions() == [9, 10]
    assert store.read("t").count() == 40 and store.read("u").count() == 4
    held = list((tmp_path / "published" / "data").iterdir())
    used = {snapshots.run_folder(p.folder) for v in store.versions() for p in store.parts(v)}
    assert len(held) <= len(used) + 1  # and the draft that died last


def test_parts_of_old_runs_go_one_by_one(spark, store):
    publish(store, "t", numbers(spark, 0, 8), F.col("month"))
    for k in range(3):
        publish(store, "t", numbers(spark, 0, 1 + k), F.lit("m0"))
    files = snapshots._FileSystem(spark, store.root)
    first = next(p.folder for p in store.parts() if p.part == "m1")
    assert [c.rsplit("/", 1)[1] for c in files.children(first.rsplit("/", 1)[0]) if "part=" in c] == ["part=m1", "part=m2", "part=m3"]


def test_a_draft_from_an_old_version_is_refused(spark, store):
    publish(store, "t", spark.range(3))
    draft = store.draft()
    draft.write("t", spark.range(5))
    publish(store, "t", spark.range(4))
    with pytest.raises(StaleDraft):
        draft.publish()
    assert store.read("t").count() == 4


def test_empty_tables_and_odd_keys(spark, store):
    draft = store.draft()
    draft.write("none", spark.range(0))
    draft.write("keys", spark.createDataFrame([("7",), ("x",), (None,), ("-2",)], "k string"), key=F.col("k"))
    draft.publish()
    assert store.read("none").count() == 0 and store.read("none").columns == ["id"]
    (part,) = [p for p in store.parts() if p.table == "keys"]
    assert (part.key_low, part.key_high, part.odd_keys) == (-2, 7, 2)
    assert part.may_hold(7, 9, 0) and not part.may_hold(8, 9, 0) and part.may_hold(None, None, 1) and not part.may_hold(None, None, 0)
