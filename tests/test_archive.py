"""Compaction of hourly archives."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from gatewatch.operators import blacklist as B
from gatewatch.streaming import files
from gatewatch.streaming.archive import Archive, pack


def test_pack_is_first_fit():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.randrange(1, 150) for _ in range(rng.randrange(40))]
        bins = pack(sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 or len(b) == 1 for b in bins)
        half = [b for b in bins if sum(sizes[i] for i in b) <= 50]
        assert len(half) <= 1  # two half-empty bins would have been one


def lines(spark, n, start=0, hours=("2024010100", "2024010101")):
    hour = F.element_at(F.array(*[F.lit(h) for h in hours]), (F.col("id") % len(hours) + 1).cast("int"))
    return spark.range(start, start + n).select(F.concat(F.lit("line "), "id").alias("value"), hour.alias("hour"))


def append(df, root, n_files=6):
    df.repartition(n_files).write.mode("append").format("text").partitionBy("hour").save(root)


def content(archive, hours=None):
    return sorted((r["hour"], r["value"]) for r in archive.read(hours).collect())


def n_files(archive):
    return {h: len(f) for h, f in archive.live().items()}


def test_rows_are_equal_before_between_and_after(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="gw-arch-"), "a rchive")
    archive = Archive(spark, root)
    assert archive.read().count() == 0 and archive.compact() == 0
    append(lines(spark, 400), root)
    append(lines(spark, 100), root)  # repeated lines stay repeated
    want = sorted((r["hour"], r["value"]) for r in lines(spark, 400).unionByName(lines(spark, 100)).collect())
    assert content(archive) == want and n_files(archive) == {"2024010100": 12, "2024010101": 12}
    assert archive.compact(["2024010100"]) == 12
    assert content(archive) == want and n_files(archive) == {"2024010100": 1, "2024010101": 12}
    append(lines(spark, 50, 1000), root, 3)  # further lines of an hour that is compacted
    want = sorted(want + [(r["hour"], r["value"]) for r in lines(spark, 50, 1000).collect()])
    assert content(archive) == want
    assert archive.compact() > 0 and content(archive) == want
    assert n_files(archive) == {"2024010100": 1, "2024010101": 1}
    assert archive.vacuum() > 0 and content(archive) == want and archive.vacuum() == 0
    assert archive.compact() == 0
    assert content(archive, ["2024010101"]) == [x for x in want if x[0] == "2024010101"]
    left = [f for d, _, names in os.walk(root) for f in names if f.endswith(".txt")]
    assert left == []


def test_file_sizes_stay_within_bounds(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="gw-arch-"), "a")
    archive = Archive(spark, root)
    append(lines(spark, 4000, hours=("h",)), root, 40)
    total = sum(archive.live()["h"].values())
    biggest = max(archive.live()["h"].values())
    target = total // 5
    archive.compact(target_bytes=target)
    sizes = archive.live()["h"].values()
    assert len(sizes) <= 7 and max(sizes) <= target + biggest and sum(sizes) == total
    assert archive.compact(target_bytes=target) == 0  # nothing left to gain


@pytest.mark.parametrize("when", ["write", "manifest"])
def test_a_compaction_that_stops_half_way(spark, monkeypatch, when):
    root = os.path.join(tempfile.mkdtemp(prefix="gw-arch-"), "a")
    archive = Archive(spark, root)
    append(lines(spark, 200), root)
    want = content(archive)
    write, done = files.write_json, []

    def broken(s, path, value):
        if when == "manifest" and not done:  # one hour is swapped, the other is not
            done.append(path)
            return write(s, path, value)
        raise OSError("lost")

    monkeypatch.setattr(files, "write_json", broken)
    with pytest.raises(OSError):
        archive.compact()
    monkeypatch.setattr(files, "write_json", write)
    assert content(archive) == want  # never both the old and the new files of an hour
    assert archive.compact() > 0 and content(archive) == want
    archive.vacuum()
    assert content(archive) == want and set(n_files(archive).values()) == {1}


def test_archive_of_a_stream_takes_its_log(spark):
    from gatewatch.sources.streams import line_stream
    from gatewatch.streaming import jobs as J
    tmp = tempfile.mkdtemp(prefix="gw-arch-")
    spark.range(60).select(F.col("id").cast("string").alias("value")).repartition(4).write.text(os.path.join(tmp, "src"))
    q = J.start_raw_archive(line_stream(spark, os.path.join(tmp, "src"), "text", max_files_per_trigger=1), os.path.join(tmp, "arch"),
                            os.path.join(tmp, "ck"), available_now=True)
    q.awaitTermination(120)
    archive = Archive(spark, os.path.join(tmp, "arch"))
    hour = archive.hours()[0]
    # a file that a failed attempt has left is not in the sink's log
    with open(os.path.join(tmp, "arch", f"hour={hour}", "part-09999-left.txt"), "w") as f:
        f.write("not committed\n")
    assert sorted(int(r["value"]) for r in archive.read().collect()) == list(range(60))
    assert archive.compact() >= 4
    assert sorted(int(r["value"]) for r in archive.read().collect()) == list(range(60)) and set(n_files(archive).values()) == {1}


def test_blacklist_history_is_merged_over_its_batches(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="gw-arch-"), "hist")
    for b in range(4):
        (spark.range(10).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(f"v{b}").alias("value"), F.timestamp_seconds(F.col("id") + b).alias("expire_at"),
                                F.lit("1970010100").alias("hour"), F.lit(b).alias("batch_id")).write.mode("append").partitionBy("hour", "batch_id").parquet(root))
    archive = Archive(spark, root, "parquet", "expire_at timestamp, key string, value string")
    want = sorted(map(str, B.latest_per_key(archive.read()).collect()))
    assert archive.compact() >= 4 and n_files(archive) == {"1970010100": 1}
    assert sorted(map(str, B.latest_per_key(archive.read()).collect())) == want and archive.read().count() == 40
