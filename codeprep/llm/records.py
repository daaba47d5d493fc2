"""Token ids of documents as length-delimited binary records with an offset index.

A run writes shards ``shard-00000.rec`` and ``shard-00000.idx``. Shards follow each other in
ascending document order, as do the records in a shard.

Record   length of the body (u64), masked checksum of these 8 bytes (u32), body, masked
         checksum of the body (u32)
Body     width of an id in bytes (u8, 2 or 4), 1 if there is a document id else 0 (u8),
         document id (i64), number of ids (u64), ids
Index    per record: offset in the shard (u64), ids before it in the shard (u64), document id
         (i64), 1 if there is one else 0 (u8)

Numbers are little-endian. A checksum is CRC-32, rotated right by 15 bits plus 0xA282EAD8, so
that checksums of data that hold checksums stay sound. The index is enough to read records in
any order, or to know how many ids lie before one, without reading the shards.

Texts are range-partitioned by document id and, for rows of one id or of none, by the first
``PREFIX`` characters of the text, then sorted in their task by id and text, encoded and written
batch by batch through the file system that the folder's address names. A shard is written under
a name of its attempt and renamed at its end, so a lost or repeated task leaves no half shard.

Null and empty texts have only the end id. Documents without an id come last. Rows that share
an id follow each other by text, over as many shards as they need; rows that repeat wholly are all
written. Rows of one id whose texts begin alike up to ``PREFIX`` are in one shard. An empty table
gives no shards and an empty result. Further columns are not looked at.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeprep.llm.encoding import Encoder

END_ID = 2
PREFIX = 128
INDEX_ROW = np.dtype([("offset", "<u8"), ("before", "<u8"), ("id", "<i8"), ("has_id", "u1")])
_HEAD = "<QI"
_BODY = "<BBqQ"
_CRC = "<I"
_ENTRY = "<QQqB"

_SHARDS = "shard bigint, path string, records bigint, ids bigint"
_RECORDS = "shard bigint, id bigint, place bigint, before bigint, n_tokens bigint, crc bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(ids: np.ndarray, doc_id: int | None, width: int) -> bytes:
    body = struct.pack(_BODY, width, doc_id is not None, doc_id or 0, len(ids))
    body += ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(body))
    return b"".join([length, struct.pack(_CRC, masked(length)), body, struct.pack(_CRC, masked(body))])


def read_frame(source) -> tuple[int | None, np.ndarray] | None:
    """Next record of an open file; None at its end."""
    head = source.read(struct.calcsize(_HEAD))
    if not head:
        return None
    length, check = struct.unpack(_HEAD, head)
    if masked(head[:8]) != check:
        raise OSError("damaged record length")
    body = source.read(length)
    if len(body) < length or struct.unpack(_CRC, source.read(4))[0] != masked(body):
        raise OSError("damaged record")
    width, has_id, doc_id, count = struct.unpack_from(_BODY, body)
    ids = np.frombuffer(body, f"<u{width}", count, struct.calcsize(_BODY))
    return (doc_id if has_id else None), ids


def write_records(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = END_ID,
    partitions: int | None = None,
) -> DataFrame:
    """Encodes and writes all documents; ``(shard, path, records, ids)`` per shard when run."""
    order = [F.col(id_col).asc_nulls_last(), F.col(text_col)]
    texts = documents.select(F.col(id_col).cast("bigint").alias(id_col), text_col)
    # Beginnings are ordered as the texts are, and few of them are sampled to the driver.
    ranges = [F.col(id_col).asc_nulls_last(), F.substring(text_col, 1, PREFIX)]
    dealt = texts.repartitionByRange(*([partitions] if partitions else []), *ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, store, out = TaskContext.get().partitionId(), None, None
        encoder, index, offset, before, count = Encoder.of(tokenizer), None, 0, 0, 0
        for batch in batches:
            for ids_of, ids in encoder.encode(batch, id_col, text_col, end_id):
                if out is None:
                    store, root = fs.FileSystem.from_uri(folder)
                    store.create_dir(root, recursive=True)
                    name = f"{root}/shard-{shard:05d}"
                    attempt = f"{root}/_attempt-{uuid.uuid4().hex}"
                    out = store.open_output_stream(f"{attempt}.rec")
                    index = store.open_output_stream(f"{attempt}.idx")
                record = frame(ids, ids_of, encoder.width)
                out.write(record)
                index.write(struct.pack(_ENTRY, offset, before, ids_of or 0, ids_of is not None))
                offset += len(record)
                before += len(ids)
                count += 1
        if out is not None:
            out.close()
            index.close()
            for kind in ("idx", "rec"):
                # A task that is repeated finds the same shard of its lost attempt.
                if store.get_file_info(f"{name}.{kind}").type != fs.FileType.NotFound:
                    store.delete_file(f"{name}.{kind}")
                store.move(f"{attempt}.{kind}", f"{name}.{kind}")
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [f"{folder}/shard-{shard:05d}"], "records": [count], "ids": [before]}
            )

    return dealt.sortWithinPartitions(*order).mapInArrow(run, _SHARDS)


def read_records(shards: DataFrame, run_of: int = 256) -> DataFrame:
    """All records of the shards, checked: shard, id, place in the shard, ids before it, crc.

    Tasks read runs of ``run_of`` records, found through the index.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(f"{row['path']}.rec")
                with store.open_input_file(f"{path[:-4]}.idx") as source:
                    index = np.frombuffer(source.read(), INDEX_ROW)
                if len(index) != row["records"]:
                    raise OSError(f"{row['path']}: index and shard differ")
                with store.open_input_file(path) as source:
                    for a in range(0, len(index), run_of):
                        part = index[a : a + run_of]
                        source.seek(int(part["offset"][0]))
                        out = {k: [] for k in ("id", "n_tokens", "crc")}
                        for _ in range(len(part)):
                            doc_id, ids = read_frame(source)
                            out["id"].append(doc_id)
                            out["n_tokens"].append(len(ids))
                            out["crc"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([row["shard"]] * len(part), pa.int64()),
                                pa.array(out["id"], pa.int64()),
                                pa.array(np.arange(a, a + len(part))),
                                pa.array(part["before"].astype(np.int64)),
                                pa.array(out["n_tokens"], pa.int64()),
                                pa.array(out["crc"], pa.int64()),
                            ],
                            names=["shard", "id", "place", "before", "n_tokens", "crc"],
                        )

    return shards.mapInArrow(runs, _RECORDS)


def written_documents(shards: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per record, read back: id, start (ids of all documents before), n_tokens, ids_crc32.

    The number of ids before a shard is a running sum over one row per shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    # A task per shard; rows this small would else be read by one task.
    dealt = shards.repartition(max(1, shards.count()))
    return (
        read_records(dealt)
        .join(F.broadcast(starts), "shard")
        .select(
            F.col("id").alias(id_col),
            (F.col("first") + F.col("before")).alias("start"),
            "n_tokens",
            F.col("crc").alias("ids_crc32"),
        )
    )
