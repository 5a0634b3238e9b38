"""Exact deduplication by Grace hashing.

Records are partitioned by a content hash, again and again into spill files, until the distinct contents of a bucket
fit an open-addressing table that compares complete contents.

Two rounds keep hot groups apart. Each task first groups its own partition, so a text that a third of all rows share
leaves each task once. Only these local groups, one text each, are dealt by content hash and grouped again. Members
are then joined to the outcome by the *local* group's key, of which a hot text has one per partition.

Spill files are a task's scratch in the executor's temporary folder: no other task reads them, a lost executor's task
is simply run again, and they go when the task ends.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_uid, unused

#: Bytes of distinct content that a task holds before it partitions to spill files.
TABLE_BYTES = 64 << 20
#: Spill files of each level; each level uses the next three bits of the hash.
FANOUT = 8


class ContentTable:
    """Open addressing with linear probing; slots hold entry numbers, entries hold whole contents."""

    def __init__(self) -> None:
        self.slots: list[int] = [-1] * 64
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.members: list[list[tuple]] = []
        self.bytes = 0

    def add(self, hashed: int, content: bytes, member: tuple) -> None:
        mask = len(self.slots) - 1
        # The low bits choose the slot; spill levels use the high ones.
        at = hashed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                self.members[entry].append(member)
                self.bytes += 64
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.contents)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.members.append([member])
        self.bytes += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for entry, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def grace_groups(
    records: Iterable[tuple[bytes, tuple]], layout: str, table_bytes: int = TABLE_BYTES, level: int = 0, scratch: str | None = None
) -> Iterator[tuple[bytes, list[tuple]]]:
    """Group (content, member) records by complete content; members are packed as the struct ``layout``.

    Yields (content, members). Equal contents share one entry, so only distinct content counts against
    ``table_bytes``. At the last level, where the hash is used up, the table takes the rest whatever its size.
    """
    table, files, folder = ContentTable(), None, None
    pack = struct.Struct("<QI" + layout)
    try:
        for content, member in records:
            hashed = xxhash.xxh3_64_intdigest(content)
            if files is None:
                table.add(hashed, content, member)
                if table.bytes > table_bytes and len(table.contents) > 1 and level < 14:
                    folder = tempfile.TemporaryDirectory(prefix="grace-", dir=scratch)
                    files = [open(f"{folder.name}/{k}", "w+b") for k in range(FANOUT)]
                    for kept_hash, kept, members in zip(table.hashes, table.contents, table.members, strict=True):
                        _spill(files, level, pack, kept_hash, kept, members)
                    table = ContentTable()
            else:
                _spill(files, level, pack, hashed, content, [member])
        if files is None:
            yield from zip(table.contents, table.members, strict=True)
            return
        for f in files:
            f.seek(0)
            yield from grace_groups(_spilled(f, pack), layout, table_bytes, level + 1, scratch)
            f.close()
    finally:
        if folder:
            for f in files or ():
                f.close()
            folder.cleanup()


def _spill(files: list, level: int, pack: struct.Struct, hashed: int, content: bytes, members: list[tuple]) -> None:
    f = files[(hashed >> (61 - 3 * level)) & (FANOUT - 1)]
    for member in members:
        f.write(pack.pack(hashed, len(content), *member))
        f.write(content)


def _spilled(f, pack: struct.Struct) -> Iterator[tuple[bytes, tuple]]:
    while head := f.read(pack.size):
        _, size, *member = pack.unpack(head)
        yield f.read(size), tuple(member)


_LOCAL = pa.schema(
    [("key", pa.int64()), ("digest", pa.binary()), ("content", pa.binary()), ("top_id", pa.int64()), ("n", pa.int64()), ("members", pa.list_(pa.int64()))]
)
_LOCAL_DDL = "key long, digest binary, content binary, top_id long, n long, members array<long>"
_ALL = pa.schema([("key", pa.int64()), ("keep_key", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
_ALL_DDL = "key long, keep_key long, keep_id long, group_size long"


def _batches(rows: Iterable[tuple[int, tuple]], schema: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``most`` bytes of (bytes, row) pairs."""
    held, size = [], 0
    for weight, row in rows:
        held.append(row)
        size += weight
        if size >= most or len(held) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _order(id_: int | None) -> tuple[bool, int]:
    return (id_ is not None, id_ or 0)


def local_groups(table_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 36

        def records():
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    ids = batch.column(0).slice(at, 256).to_pylist()
                    for id_, text in zip(ids, batch.column(1).slice(at, 256).cast(pa.binary()).to_pylist(), strict=True):
                        yield text or b"", (id_ or 0, id_ is not None)

        def rows():
            for number, (content, members) in enumerate(grace_groups(records(), "q?", table_bytes)):
                ids = sorted((i if known else None for i, known in members), key=_order, reverse=True)
                yield len(content) + 8 * len(ids), (base + number, hashlib.sha256(content).digest(), content, ids[0], len(ids), ids)

        yield from _batches(rows(), _LOCAL)

    return run


def global_groups(table_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    content, *rest = (batch.column(k).slice(at, 256).to_pylist() for k in range(4))
                    for text, key, top, n in zip(content, *rest, strict=True):
                        yield text, (key, top or 0, top is not None, n)

        def rows():
            for _, members in grace_groups(records(), "qq?q", table_bytes):
                # Of equal ids the smaller key stays: one row, whichever order the records came in.
                key, top, known, _ = max(members, key=lambda m: (m[2], m[1], -m[0]))
                size = sum(m[3] for m in members)
                for m in members:
                    yield 40, (m[0], key, top if known else None, size)

        yield from _batches(rows(), _ALL)

    return run


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the largest id stays (a
    null id is smaller than any). Repeated rows, id and text alike, count each in ``group_size`` and one of them
    stays. An empty table gives an empty result; other columns are not read.
    """
    local = stored(
        docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")).mapInArrow(local_groups(table_bytes), _LOCAL_DDL),
        "exact-local",
    )
    outcome = local.select("digest", "content", "key", "top_id", "n").repartition("digest").select("content", "key", "top_id", "n").mapInArrow(global_groups(table_bytes), _ALL_DDL)
    members = local.select("key", "digest", F.posexplode("members").alias("place", "doc_id"))
    return members.join(outcome, "key").select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("key") == F.col("keep_key")) & (F.col("place") == 0)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, all columns, whatever their names; of rows alike in id and text, one stays.

    The rows that go are written first, so Spark knows their size: few are broadcast and the texts aren't shuffled. They
    are known by id and half of the text's SHA-256.
    """
    at, uid, gone_id, gone_uid, again, one = unused(docs.columns, "id", "uid", "gone_id", "gone_uid", "again", "one")
    found = exact_dedup(docs, id_column, text_column, table_bytes).where("not kept")
    # A row whose own id stays is one of several alike.
    gone = found.groupBy(F.col("doc_id").alias(gone_id), F.substring(F.unhex("text_sha256"), 1, 16).alias(gone_uid)).agg(F.max(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias(again))
    gone = stored(gone, "exact-gone")
    # Few rows repeat another's id and text, so their own table is mostly small or empty, and the texts aren't shuffled for it.
    alike = stored(gone.where(again).drop(again), "exact-again")
    rows = docs.withColumn(uid, text_uid(F.col(text_column))).withColumn(at, F.col(id_column).cast("long"))
    same = lambda keys: rows[at].eqNullSafe(keys[gone_id]) & (rows[uid] == keys[gone_uid])
    stay = rows.join(gone, same(gone), "left_anti").select(*docs.columns)
    repeated = rows.join(alike, same(alike), "left_semi").withColumn(one, F.struct(*docs.columns)).groupBy(at, uid).agg(F.first(one).alias(one))
    return stay.unionByName(repeated.select(f"{one}.*"))
