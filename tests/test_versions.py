"""Versions of tables: whole before and after a writer that stops anywhere."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linkwatch.operators import exports as X
from linkwatch.sources import files, sinks, versions

DAYS = [dt.date(2026, 1, n) for n in range(1, 6)]


def days(spark, note, *which):
    rows = [(d, n, f"{note}{n}") for d in which for n in range(3)]
    return spark.createDataFrame(rows, "date_utc date, n int, note string")


def shown(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_a_range_is_replaced_and_emptied_days_go(spark, tmp_path):
    path = str(tmp_path / "fact")
    versions.publish_range(days(spark, "a", *DAYS), path)
    fresh = days(spark, "b", DAYS[1], DAYS[4], None)
    versions.publish_range(fresh, path, DAYS[1], DAYS[3])
    want = days(spark, "a", DAYS[0], DAYS[4]).unionByName(days(spark, "b", DAYS[1]))
    assert shown(versions.read_table(spark, path)) == shown(want)
    part = versions.read_table(spark, path, DAYS[1], DAYS[3])
    assert shown(part) == shown(days(spark, "b", DAYS[1]))
    assert all("2026-01-02" in f for f in part.inputFiles())
    assert versions.read_table(spark, path, DAYS[2], DAYS[3]).count() == 0
    old = versions.load(spark, path, 1)
    assert versions.read_table(spark, path, version=old).count() == 15


def test_empty_tables_keep_their_columns(spark, tmp_path):
    for name, write in (("r", versions.publish_range), ("t", versions.publish_table)):
        empty = days(spark, "a")
        write(empty, f"{tmp_path}/{name}")
        got = versions.read_table(spark, f"{tmp_path}/{name}")
        assert got.schema == empty.schema and got.count() == 0
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, f"{tmp_path}/none")
    with pytest.raises(ValueError, match="folder level"):
        versions.publish_range(days(spark, "a").withColumn(versions.PART, F.lit(1)), f"{tmp_path}/x")


class Stopped(Exception):
    pass


def stop(*_, **__):
    raise Stopped


def half_written(spark, name, text):
    path, fs = files._path(spark, name)
    stream = fs.create(path, False)
    stream.write(text.encode()[: len(text) // 2])
    stream.close()
    raise Stopped


def after_publishing(spark, name, text, create=files.create_text):
    create(spark, name, text)
    raise Stopped


@pytest.mark.parametrize(
    ("step", "replacement", "kept"),
    [
        ("publish", stop, "a"),
        ("create_text", stop, "a"),
        ("create_text", half_written, "a"),
        ("create_text", after_publishing, "b"),
    ],
)
@pytest.mark.parametrize("by_range", [True, False])
def test_a_writer_that_stops_leaves_one_version_whole(
    spark, tmp_path, monkeypatch, step, replacement, kept, by_range
):
    path = str(tmp_path / "t")
    write = versions.publish_range if by_range else versions.publish_table
    write(days(spark, "a", *DAYS), path)
    with monkeypatch.context() as m:
        m.setattr(versions if step == "publish" else files, step, replacement)
        with pytest.raises(Stopped):
            write(days(spark, "b", *DAYS), path)
    assert shown(versions.read_table(spark, path)) == shown(days(spark, kept, *DAYS))
    write(days(spark, "c", *DAYS), path)
    want = shown(days(spark, "c", *DAYS))
    assert shown(versions.read_table(spark, path)) == want
    assert versions.expire(spark, path, keep=1) >= 1
    assert shown(versions.read_table(spark, path)) == want
    assert len(files.children(spark, f"{path}/data")) == 1


def test_data_that_fails_to_be_written_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish_table(days(spark, "a", *DAYS), path)
    broken = days(spark, "b", *DAYS).withColumn("note", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        versions.publish_table(broken, path)
    assert shown(versions.read_table(spark, path)) == shown(days(spark, "a", *DAYS))


def test_nothing_published_is_moved(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "move", stop)
    path = str(tmp_path / "t")
    versions.publish_range(days(spark, "a", *DAYS), path)
    before = set(versions.read_table(spark, path).inputFiles())
    versions.publish_range(days(spark, "b", DAYS[0]), path, DAYS[0], DAYS[0])
    after = set(versions.read_table(spark, path).inputFiles())
    assert {f for f in before if "2026-01-01" not in f} == {f for f in after if "2026-01-01" not in f}
    assert versions.read_table(spark, path, version=versions.load(spark, path, 1)).count() == 15


def test_two_writers_from_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    base = versions.publish_table(days(spark, "a", *DAYS), path)
    versions.publish_table(days(spark, "b", *DAYS), path)
    with pytest.raises(FileExistsError):
        versions.publish(spark, path, base, base.parts, base.schema)
    with pytest.raises(FileExistsError):
        files.create_text(spark, versions._file(path, 2), "{}")
    assert versions.read_table(spark, path).where("note = 'b0'").count() == 5


def test_a_release_changes_all_its_tables_at_once(spark, tmp_path):
    root, names = str(tmp_path / "star"), ("x", "y")

    def write(note, name, base):
        rows = days(spark, note, DAYS[0])
        return versions.publish_table(rows, f"{root}/{name}", base=base)

    def seen():
        return {
            r.note[0]
            for name in names
            for r in versions.read_table(
                spark, f"{root}/{name}", version=versions.released(spark, root, name)
            ).collect()
        }

    for note in "ab":
        base = versions.current(spark, root)
        new = {n: write(note, n, versions.released(spark, root, n, base)) for n in names}
        versions.release(spark, root, base, new)
        assert seen() == {note}
    base = versions.current(spark, root)
    write("lost", "x", versions.released(spark, root, "x", base))  # stops before its release
    assert seen() == {"b"}
    new = {n: write("c", n, versions.released(spark, root, n, base)) for n in names}
    versions.release(spark, root, base, new)
    assert seen() == {"c"}
    with pytest.raises(FileExistsError):
        versions.release(spark, root, base, new)
    assert versions.expire_release(spark, root, keep=1) == 5
    assert seen() == {"c"}


def test_a_bundle_of_extracts(spark, tmp_path):
    out = str(tmp_path / "extracts")
    with pytest.raises(FileNotFoundError):
        versions.bundle_folder(spark, out)
    empty = {
        name: spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
        for name, columns in X.DATASETS.items()
    }
    for _ in range(2):
        versions.publish_folders(spark, out, lambda folder: sinks.write_csv(empty, folder))
    first = versions.bundle_folder(spark, out)
    with pytest.raises(ValueError, match="exactly"):
        versions.publish_folders(spark, out, lambda folder: sinks.write_csv({}, folder))
    assert versions.bundle_folder(spark, out) == first
    found = {r.dataset: r.row_count for r in sinks.verify_csv(spark, first).collect()}
    assert found == dict.fromkeys(X.DATASETS, 0)
    assert versions.expire(spark, out, keep=1) == 1
