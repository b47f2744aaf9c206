"""Token ids of whole corpora in binary files with constant-time keyed access.

A *shard* is a run of documents in ascending ``doc_id`` order:

* ``….bin``: the ids of its documents, end to end, little-endian, two bytes each
  where the vocabulary allows it and else four; nothing else, so that a training
  loader can map the file and slice it.
* ``….idx``: where each document starts, and a minimal perfect hash from
  document keys to documents with a stored fingerprint per key.

Tasks write under names of their own attempt. A shard counts once Spark has
committed its row to the *manifest*; what a lost or repeated task left is in no
manifest and is never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlake.session import scratch_dir

from .common import arrow_rows, document_texts, load, save, settle, shuffle_partitions
from .encode import closed, encoder

END_ID = 0
#: Bytes of text that a shard is cut for.
SHARD_BYTES = 32 << 20
#: Texts encoded together; bytes of payload read at once.
BATCH, READ = 1_000, 8 << 20
#: Bits of a level for each key that it gets.
LOAD = 2


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits for each key and seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Minimal perfect hash by levels of bits.

    A key takes a bit of the first level where no other key falls on the same one;
    its number is the count of bits set before it. Every level is looked at once,
    so a lookup takes constant time. The fingerprint turns away most other keys.
    """

    sizes: np.ndarray  # bits of each level
    bits: np.ndarray  # of all levels, one byte for each bit
    prints: np.ndarray  # by number
    values: np.ndarray  # by number

    @cached_property
    def ranks(self) -> np.ndarray:
        """Bits set up to each one."""
        return np.cumsum(self.bits)

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray) -> PerfectHash:
        """``keys`` are distinct integers."""
        sizes, levels, left = [], [], keys
        while len(left):
            size = LOAD * len(left) + 1
            at = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        made = cls(np.array(sizes, np.int64), bits, np.zeros(0, np.uint32), np.zeros(0, np.int64))
        number = made.numbers(keys)
        made.prints, made.values = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64)
        made.prints[number] = mix(keys, -1) >> np.uint64(32)
        made.values[number] = values
        return made

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where every level's bit is unset."""
        found, base = np.full(len(keys), -1), 0
        for level, size in enumerate(self.sizes):
            at = base + (mix(keys, level) % np.uint64(size)).astype(np.int64)
            new = (found < 0) & self.bits[at]
            found[new] = self.ranks[at[new]] - 1
            base += size
        return found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 for keys that aren't there."""
        if not len(self.prints):
            return np.full(len(keys), -1)
        number = self.numbers(keys)
        known = (number >= 0) & (self.prints[number] == (mix(keys, -1) >> np.uint64(32)))
        return np.where(known, self.values[number], -1)


@dataclass
class Shard:
    """The index of a shard."""

    keys: np.ndarray  # by document
    keyed: np.ndarray  # whether it has a key
    starts: np.ndarray  # ids before each document, and all ids
    hash: PerfectHash  # from keys to the first document that has it

    @classmethod
    def build(cls, keys: np.ndarray, keyed: np.ndarray, starts: np.ndarray) -> Shard:
        own = np.flatnonzero(keyed)
        distinct, first = np.unique(keys[own], return_index=True)
        return cls(keys, keyed, starts, PerfectHash.build(distinct, own[first]))

    def to_bytes(self) -> bytes:
        h = self.hash
        return save([self.keys, self.keyed, self.starts, h.sizes, np.packbits(h.bits), np.array([len(h.bits)]), h.prints, h.values])

    @classmethod
    def from_bytes(cls, raw: bytes) -> Shard:
        keys, keyed, starts, sizes, bits, n, prints, values = load(raw)
        bits = np.unpackbits(bits, count=int(n[0])).astype(bool)
        return cls(keys, keyed, starts, PerfectHash(sizes, bits, prints, values))


def write_token_files(
    docs: DataFrame, path: str, cut: str = "bytes", end_id: int = END_ID,
    folder: str | None = None, shard_bytes: int = SHARD_BYTES, id_bytes: int = 2,
) -> DataFrame:
    """Encode all documents into shards and return the manifest.

    Rows ``shard, file, id_bytes, documents, first_key, last_key, tokens, start``;
    ``start`` counts the ids of all shards before. Documents are in ascending
    ``doc_id`` order, those without one first, those that share one ordered by
    text. Null and empty texts are their end id alone. Without documents the
    manifest is empty. Columns besides ``doc_id`` and ``text`` are not read.

    ``folder`` is any place all nodes reach by a path or URL; unset, it lies in the
    folder of ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "tokens")
    texts = document_texts(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(shuffle_partitions(spark), size // shard_bytes + 1)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = texts.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        context = TaskContext.get()
        keys, keyed, lengths, out = [], [], [], None
        for batch in batches:
            for at in range(0, len(batch["doc_id"]), BATCH):
                ids = batch["doc_id"].slice(at, BATCH)
                keys.append(ids.fill_null(0).to_numpy())
                keyed.append(ids.is_valid().to_numpy(zero_copy_only=False))
                if out is None:
                    name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
                    files, place = arrow_fs.FileSystem.from_uri(folder)
                    files.create_dir(place, recursive=True)
                    tokens, out = encoder(path, cut), files.open_output_stream(f"{place}/{name}.bin")
                joined, sizes = closed(*tokens.encode_all(batch["text"].slice(at, BATCH)), end_id)
                lengths += sizes.tolist()
                if id_bytes == 2 and joined.max() > 0xFFFF:
                    raise ValueError("these ids need four bytes: set id_bytes=4")
                out.write(joined.astype(kind).tobytes())
        if out is None:
            return
        out.close()
        starts = np.concatenate([[0], np.cumsum(lengths)])
        keys, keyed = np.concatenate(keys), np.concatenate(keyed)
        with files.open_output_stream(f"{place}/{name}.idx") as index:
            index.write(Shard.build(keys, keyed, starts).to_bytes())
        ends = keys[keyed][[0, -1]].tolist() if keyed.any() else [None, None]
        yield {
            "shard": [context.partitionId()], "file": [f"{folder}/{name}"], "id_bytes": [id_bytes],
            "documents": [len(keys)], "first_key": ends[:1], "last_key": ends[1:], "tokens": starts[-1:],
        }

    schema = "shard int, file string, id_bytes int, documents long, first_key long, last_key long, tokens long"
    manifest = settle(arrow_rows(ordered, run, schema, keep=True), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def open_shard(file: str) -> tuple[Shard, pa.NativeFile]:
    files, place = arrow_fs.FileSystem.from_uri(file)
    with files.open_input_file(f"{place}.idx") as index:
        shard = Shard.from_bytes(index.read())
    return shard, files.open_input_file(f"{place}.bin")


def ids_of(payload: pa.NativeFile, start: int, stop: int, id_bytes: int) -> np.ndarray:
    raw = payload.read_at((stop - start) * id_bytes, start * id_bytes)
    return np.frombuffer(raw, f"<u{id_bytes}").astype("<u4")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """All documents from the files: ``doc_id, start, n_tokens, ids, ids_crc32``.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian
    unsigned 32-bit integers. A document's ids are sliced from the payload where its
    shard's hash says that its key is; a key that leads elsewhere, or a payload of another
    length, is an error.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            names = ("file", "id_bytes", "start", "tokens")
            for file, width, first, tokens in zip(*(batch[n].to_pylist() for n in names)):
                shard, payload = open_shard(file)
                check(shard, payload, file, width, tokens)
                starts, at = shard.starts, 0
                while at < len(shard.keys):
                    stop = max(at + 1, int(np.searchsorted(starts, starts[at] + READ // 4, "right")) - 1)
                    begin, end = found_places(shard, at, stop, file)
                    ids = memoryview(ids_of(payload, int(begin[0]), int(end[-1]), width).tobytes())
                    bounds = ((np.append(begin, end[-1]) - begin[0]) * 4).tolist()
                    raw = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
                    yield {
                        "doc_id": pa.array(shard.keys[at:stop], mask=~shard.keyed[at:stop]),
                        "start": first + begin,
                        "n_tokens": end - begin,
                        "ids": pa.Array.from_buffers(pa.binary(), stop - at, [None, pa.py_buffer(np.array(bounds, np.int32)), pa.py_buffer(ids)]),
                        "ids_crc32": [zlib.crc32(x) for x in raw],
                    }
                    at = stop

    shards = max(1, manifest.count())
    spread = manifest.repartitionByRange(shards, "shard")
    return arrow_rows(spread, run, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")


def found_places(shard: Shard, at: int, stop: int, file: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the ids of the documents from ``at`` to ``stop`` begin and end.

    Documents are looked up by key in the hash. Those without a key, and all but the
    first of one key, follow the document before them.
    """
    place, keys = np.arange(at, stop), shard.keys[at:stop]
    before = (shard.keys[at - 1], shard.keyed[at - 1]) if at else (0, False)
    same = (keys == np.append(before[0], keys[:-1])) & np.append(before[1], shard.keyed[at : stop - 1])
    asked = shard.keyed[at:stop] & ~same
    place[asked] = shard.hash.find(keys[asked])
    begin, end = shard.starts[place], shard.starts[place + 1]
    if (place < 0).any() or not np.array_equal(begin[1:], end[:-1]) or begin[0] != shard.starts[at]:
        raise OSError(f"{file}: index and payload don't belong together")
    return begin, end


def check(shard: Shard, payload: pa.NativeFile, file: str, width: int, tokens: int) -> None:
    """Raise unless index, payload and manifest have one size."""
    if payload.size() != tokens * width or shard.starts[-1] != tokens:
        raise OSError(f"{file}: index and payload don't belong together")


def fetch(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """``doc_id`` and ``ids`` of the documents named in ``keys.doc_id``.

    Keys that aren't there give no row; of documents that share a key, the first is
    returned. The first and last key of each shard go to the tasks: some bytes for
    each ``SHARD_BYTES`` of text. A task opens the shards its keys lie in and reads
    nothing but the index and the documents asked for.
    """
    rows = manifest.where("first_key is not null").orderBy("shard").select("last_key", "file", "id_bytes").collect()
    lasts = np.array([r["last_key"] for r in rows], np.int64)
    files, widths = [r["file"] for r in rows], [r["id_bytes"] for r in rows]

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            wanted = batch["doc_id"].to_numpy()
            number = np.searchsorted(lasts, wanted)
            for n in np.unique(number[number < len(lasts)]):
                shard, payload = open_shard(files[n])
                own = wanted[number == n]
                at = shard.hash.find(own)
                there = [(k, a) for k, a in zip(own.tolist(), at.tolist()) if a >= 0 and shard.keys[a] == k]
                ids = [ids_of(payload, int(shard.starts[a]), int(shard.starts[a + 1]), widths[n]).tobytes() for _, a in there]
                yield {"doc_id": [k for k, _ in there], "ids": ids}

    wanted = keys.where("doc_id is not null").select(F.col("doc_id").cast("long")).distinct()
    ordered = wanted.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return arrow_rows(ordered, run, "doc_id long, ids binary")
