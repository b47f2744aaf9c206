"""Objects in files: byte ranges, and parts that are seen only when all are there."""

import hashlib
import os
import time

import numpy as np
import pytest

from chainlake import sinks, sources
from chainlake.files import folders_in, read_json
from chainlake.operators import integrity, objects
from chainlake.sinks.objects import FolderStore, PartsWriter
from chainlake.sources.objects import ByteRanges, cut_pieces


@pytest.fixture
def stored(folder):
    """A folder with objects of many sizes: by id, their bytes."""
    rng, path = np.random.default_rng(3), folder("objects")
    os.makedirs(f"{path}/deep")
    sizes = [0, 1, 999, 1000, 1001, 64_000, 3_000_123, 0, 7, 250_000]
    content = {i: rng.integers(0, 256, n, dtype=np.uint8).tobytes() for i, n in enumerate(sizes, 10)}
    for i, data in content.items():
        name = f"{path}/deep/archive-{i:06d}.bin" if i % 2 else f"{path}/{i}.bin"
        with open(name, "wb") as out:
            out.write(data)
    for name in (".hidden-5", "_started-6", "readme"):
        with open(f"{path}/{name}", "wb") as out:
            out.write(b"no object")
    return path, content


@pytest.mark.parametrize("chunk, partition", [(1000, 4000), (1 << 16, 1 << 17), (7, 1 << 20), (1 << 22, 1)])
def test_ranges_give_all_bytes(spark, stored, chunk, partition):
    path, content = stored
    small = {i: d for i, d in content.items() if len(d) < 300_000} if chunk == 7 else content
    read = sources.read_objects(spark, path, chunk, ids=small if chunk == 7 else None, partition_bytes=partition)
    rows = read.collect()
    assert max(len(r.data) for r in rows) <= chunk
    for i, data in small.items():
        own = sorted((r for r in rows if r.object_id == i), key=lambda r: r.chunk_no)
        assert [r.chunk_no for r in own] == list(range(-(-len(data) // chunk)))
        assert b"".join(bytes(r.data) for r in own) == data
        assert all(r.offset == r.chunk_no * chunk and r.length == len(r.data) for r in own)
    assert {r.object_id for r in rows} == {i for i, d in small.items() if d}


def test_digests_equal_those_of_whole_reads(spark, stored, rows):
    path, content = stored
    parts = objects.rechunk(sources.read_objects(spark, path, 4096), 10_000)
    got = rows(integrity.composite_etag(integrity.part_md5(parts)), "object_id", "etag", "size")
    digest = lambda d: hashlib.md5(b"".join(hashlib.md5(d[a : a + 10_000]).digest() for a in range(0, len(d), 10_000))).hexdigest()
    assert got == sorted((i, digest(d), len(d)) for i, d in content.items() if d)
    assert rows(sources.list_objects(spark, path), "object_id", "size") == sorted((i, len(d)) for i, d in content.items())


def test_a_read_goes_on_at_an_offset(spark, stored):
    path, content = stored
    for start in (1, 999, 1000, 63_999, 3_000_122):
        got = {}
        for r in sources.read_objects(spark, path, 1000, start=start, partition_bytes=500_000).orderBy("object_id", "chunk_no").collect():
            assert r.offset == max(start, r.chunk_no * 1000)
            got[r.object_id] = got.get(r.object_id, b"") + bytes(r.data)
        assert got == {i: d[start:] for i, d in content.items() if len(d) > start}


def test_filters_on_ids_prune_files(spark, stored):
    path, content = stored
    read = sources.read_objects(spark, path, 1 << 16, partition_bytes=1 << 16)
    every = read.rdd.getNumPartitions()
    for chosen, ids in ((read.where("object_id = 15"), {15}), (read.where("object_id in (11, 14)"), {11, 14}), (read.where("object_id > 17"), {18, 19})):
        assert chosen.rdd.getNumPartitions() < every / 4
        assert {r.object_id for r in chosen.select("object_id").collect()} == ids
    assert read.where("object_id between 10 and 12 and length > 5").count() == 1
    assert sources.read_objects(spark, path, ids=[]).count() == 0


def test_a_large_object_is_many_partitions_and_small_ones_few():
    large = list(cut_pieces([(1, "a", 10**12)], 4 << 20, 128 << 20, 0))
    assert len(large) == -(-(10**12) // (128 << 20)) and all(p.stop - p.begin <= 128 << 20 for p in large)
    reader = ByteRanges({"path": "/nowhere"})
    reader.files = lambda: [(i, str(i), 1 << 20) for i in range(1000)]
    assert len(reader.partitions()) == 8


def test_two_files_of_one_object_are_an_error(spark, stored):
    path, _ = stored
    with open(f"{path}/deep/again-10.bin", "wb") as out:
        out.write(b"x")
    with pytest.raises(Exception, match="two files of object 10"):
        sources.read_objects(spark, path).count()


def batches(rows):
    import pyarrow as pa

    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return iter([pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["object_id", "part_no", "data"])])


class BrokenStore(FolderStore):
    """Fails at one part of one object."""

    def put(self, name, data):
        if name.startswith("3-1"):
            raise OSError("no room")
        return super().put(name, data)


def parts_of(spark, content, size=1000):
    rows = [(i, n, d[a : a + size]) for i, d in content.items() for n, a in enumerate(range(0, len(d), size))]
    return spark.createDataFrame(rows, "object_id long, part_no int, data binary").repartition(5)


def whole(spark, path):
    out = {}
    for r in sinks.read_parts(sinks.committed_parts(spark, path)).orderBy("object_id", "part_no").collect():
        out[r.object_id] = out.get(r.object_id, b"") + bytes(r.data)
    return out


def test_parts_are_seen_together(spark, folder):
    rng, path = np.random.default_rng(1), folder("parts")
    content = {i: rng.integers(0, 256, 500 * i, dtype=np.uint8).tobytes() for i in range(1, 9)}
    assert sinks.committed_parts(spark, path).count() == 0
    sinks.parts(parts_of(spark, content), path)
    assert whole(spark, path) == content
    etags = {r.object_id: (r.etag, r.size) for r in integrity.composite_etag(sinks.committed_parts(spark, path)).collect()}
    digest = lambda d: hashlib.md5(b"".join(hashlib.md5(d[a : a + 1000]).digest() for a in range(0, len(d), 1000))).hexdigest()
    assert etags == {i: (digest(d), len(d)) for i, d in content.items()}

    with pytest.raises(Exception, match="no room"):
        sinks.parts(parts_of(spark, {3: b"new" * 999, 4: b"new"}), path, store=f"tests.{__name__.rpartition(chr(46))[2]}:BrokenStore")
    assert whole(spark, path) == content
    time.sleep(2)  # tasks that were still running
    assert sinks.drop_uncommitted(path) == 0
    sinks.drop_uncommitted(path, older_than=0)
    assert len(folders_in(f"{path}/staged")) == 1 and whole(spark, path) == content

    sinks.parts(parts_of(spark, {3: b"new" * 100, 20: b"more"}), path)
    assert whole(spark, path) == {**content, 3: b"new" * 100, 20: b"more"}
    sinks.parts(parts_of(spark, {1: b"alone"}), path, mode="overwrite")
    assert whole(spark, path) == {1: b"alone"}


def test_lost_attempts_leave_nothing(spark, folder):
    path = folder("parts")
    writer = PartsWriter({"path": path}, False)
    lost = writer.write(batches([(1, 0, b"ab"), (1, 1, b"c")]))
    again = writer.write(batches([(1, 0, b"ab"), (1, 1, b"c")]))
    assert sinks.committed_parts(spark, path).count() == 0
    writer.commit([again, None])
    assert not os.path.exists(lost.folder) and whole(spark, path) == {1: b"abc"}
    with pytest.raises(OSError, match="no room"):
        PartsWriter({"path": path, "store": f"tests.{__name__.rpartition(chr(46))[2]}:BrokenStore"}, False).write(batches([(3, 0, b"x"), (3, 1, b"y")]))
    other = PartsWriter({"path": path}, False)
    other.write(batches([(2, 0, b"zz")]))
    other.abort([None])
    assert whole(spark, path) == {1: b"abc"} and len(read_json(f"{path}/commits")) == 1


def test_changed_parts_are_noticed(spark, folder):
    path = folder("parts")
    sinks.parts(parts_of(spark, {1: b"some bytes"}), path)
    place = sinks.committed_parts(spark, path).first().file
    with open(place, "wb") as out:
        out.write(b"other byte")
    with pytest.raises(Exception, match="isn't what was written"):
        whole(spark, path)
