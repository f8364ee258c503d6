"""Lines of members from ZIPs and folders, in file order, whatever the ranges."""

import random
import zipfile
import zlib

import pytest

from headway.sources import feedsource, gtfs, zipsink

TEXT = "\ufeffa,b\n" + "".join(f"{k},{'ä' * (k % 40)}\r\n" if k % 3 else f"{k},x\n" for k in range(500)) + "\nlast,no end"


def want(text):
    return text.removeprefix("\ufeff").replace("\r\n", "\n").replace("\r", "\n").removesuffix("\n").split("\n")


def archive(path, members, how=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", how) as z:
        for name, text in members:
            z.writestr(name, text)
    return str(path)


def read(spark, path, member, size=feedsource.RANGE):
    rows = feedsource.feed_lines(spark, path, member, size).collect()
    assert len({r["_row"] for r in rows}) == len(rows)
    return [r["value"] for r in sorted(rows, key=lambda r: r["_row"])]


def test_deflated_stored_and_plain(spark, tmp_path):
    members = [("in/Stops.TXT", "old\n"), ("x\\stops.txt", TEXT), ("readme.md", "no"), ("empty.txt", "")]
    deflated, stored = archive(tmp_path / "d.zip", members), archive(tmp_path / "s.zip", members, zipfile.ZIP_STORED)
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "STOPS.txt").write_bytes(TEXT.encode())
    assert read(spark, deflated, "stops") == want(TEXT)
    for path in (stored, str(tmp_path / "plain"), f"file://{tmp_path}/plain", f"file://{stored}"):
        assert read(spark, path, "stops", 1000) == want(TEXT), path
    assert len(feedsource.ranges(feedsource.members(stored)["stops"], 1000)) > 10
    assert read(spark, deflated, "empty") == [] == gtfs.headers(deflated, "empty")
    assert gtfs.headers(deflated, "stops") == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        feedsource.FeedReader({"path": deflated, "member": "trips"}).partitions()
    with pytest.raises(FileNotFoundError):
        feedsource.members(str(tmp_path / "none.zip"))


@pytest.mark.parametrize("seed", range(30))
def test_ranges_meet(tmp_path, seed):
    """Every range's lines behind each other are the file's, with ranges shorter than lines, too."""
    rng = random.Random(seed)
    text = "".join(rng.choice(["a", "bb", "", "c" * rng.randrange(60)]) + rng.choice(["\n", "\n", "\r\n"]) for _ in range(rng.randrange(40)))
    text += rng.choice(["", "open"])
    path = tmp_path / "t.txt"
    path.write_bytes(text.encode())
    size = rng.randrange(1, 50)
    got = [line for part in feedsource.ranges(feedsource.members(str(path))["t"], size) for some in feedsource.lines(feedsource.chunks(part, size)) for line in some]
    assert got == (want(text) if text else [])


def test_long_member_in_batches(tmp_path):
    text = "".join(f"{k},{k * k}\n" for k in range(300_000))
    path = archive(tmp_path / "big.zip", [("stop_times.txt", text)])
    batches = list(feedsource.lines(feedsource.chunks(feedsource.members(path)["stop_times"])))
    assert len(batches) > 2 and [x for some in batches for x in some] == want(text)


def test_damaged_archive(tmp_path):
    path = archive(tmp_path / "bad.zip", [("stops.txt", TEXT)])
    member = feedsource.members(path)["stops"]
    with pytest.raises(ValueError, match="checksum"):
        list(feedsource.chunks(feedsource.Member(path, member.start, member.stop, member.first, 0, member.crc ^ 1)))


@pytest.mark.parametrize("limit", [None, 100])
def test_zip_by_executors(spark, tmp_path, monkeypatch, limit):
    """What zipfile reads is what was written, blocks and tasks in order; a low limit has every number in 64 bits."""
    monkeypatch.setattr(zipsink, "BLOCK", 5_000)
    if limit:
        monkeypatch.setattr(zipsink, "LIMIT", limit)
    many = spark.range(4_000).repartitionByRange(5, "id").selectExpr("id AS stop_id", "concat('\"', repeat('ü', CAST(id % 9 AS int)), '\"') AS stop_name")
    tables = {"none": many.limit(0), "stops": many, "one": many.filter("stop_id = 7")}
    path = tmp_path / "out.zip"
    path.write_text("older")
    gtfs.write_zip(tables, str(path))
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and z.namelist() == ["none.txt", "stops.txt", "one.txt"]
        assert z.read("none.txt") == b"stop_id,stop_name\n"
        want_rows = [f'{k},"""{"ü" * (k % 9)}"""' for k in range(4_000)]
        assert z.read("stops.txt").decode().splitlines()[1:] == want_rows
    assert read(spark, str(path), "stops")[1:] == want_rows
    assert read(spark, str(path), "one") == ["stop_id,stop_name", '7,"""üüüüüüü"""']
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out.zip"]


def test_deflated_member_in_many_tasks(spark, tmp_path, monkeypatch):
    """A member deflated by executors is read in ranges of its blocks, in order; without a fitting index it is one stream."""
    monkeypatch.setattr(zipsink, "BLOCK", 5_000)
    path = str(tmp_path / "out.zip")
    gtfs.write_zip({"stops": spark.range(20_000).repartitionByRange(3, "id").selectExpr("id AS stop_id", "concat('ü', id) AS stop_name")}, path)
    whole = feedsource.members(path)["stops"]
    parts = feedsource.ranges(whole, 20_000)
    assert 10 < len(parts) < 30 and [p.part for p in parts] == list(range(len(parts)))
    assert all(a.stop == b.start for a, b in zip(parts, parts[1:], strict=False))
    want_rows = ["stop_id,stop_name", *(f"{k},ü{k}" for k in range(20_000))]
    got = feedsource.feed_lines(spark, path, "stops", 20_000)
    assert got.rdd.getNumPartitions() == len(parts)
    assert [r.value for r in got.orderBy("_row").collect()] == want_rows
    assert sorted(r.ordinal for r in gtfs.numbered(gtfs.read_rows(spark, path, ["a", "b"], "stops"), "ordinal").collect()) == list(range(20_000))
    with pytest.raises(ValueError, match="checksum"):
        list(feedsource.chunks(feedsource.Member(path, parts[3].start, parts[4].stop, whole.start, 3, parts[3].crc)))
    # a damaged index counts as none
    data = (tmp_path / "out.zip").read_bytes()
    at = data.index(feedsource.INDEX_MARK) + len(feedsource.INDEX_MARK)
    (tmp_path / "out.zip").write_bytes(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    assert len(feedsource.ranges(feedsource.members(path)["stops"], 20_000)) == 1
    assert read(spark, path, "stops") == want_rows


def test_joined_checksums():
    a, b = bytes(range(256)) * 9000, b"second" * 7
    assert zipsink.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert zipsink.joined_crc(zlib.crc32(b), zlib.crc32(a), len(a)) == zlib.crc32(b + a)
    assert zipsink.joined_crc(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


def test_published_by_the_manifest(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    lost = tmp_path / "out" / "data-lost" / "trips"
    lost.mkdir(parents=True)
    (lost / "part-0.parquet").write_text("of an attempt that was lost")
    with pytest.raises(FileNotFoundError):
        gtfs.published(spark, folder)
    assert gtfs.publish({"trips": spark.range(3).toDF("trip_id"), "none": spark.range(0)}, folder) == {"trips": 3, "none": 0}
    tables = gtfs.published(spark, folder)
    assert sorted(r[0] for r in tables["trips"].collect()) == [0, 1, 2] and tables["none"].count() == 0
    with pytest.raises(FileExistsError):
        gtfs.publish({"trips": spark.range(4)}, folder)
