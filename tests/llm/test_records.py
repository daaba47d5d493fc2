import io
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from codeprep.llm import arrays, records
from codeprep.llm.encoding import Encoder
from codeprep.staging import new_folder, stage

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, path string, shard int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [records.END_ID]


def test_encoder_gives_the_librarys_ids(tokenizer):
    rng = random.Random(3)
    parts = (
        "a|The| |  |\n| \n|\t|é|ñ| |　| |日本|1|23|'s|'ll|!|...|<|endoftext|>|\x1f|\x85|"
        "Привет|😀|word |, x|\r\n|à| é|ß ü|́|ǆ|don't|×|÷|_"
    ).split("|") + ["<|endoftext|>"]
    encoder = Encoder(PATH)
    for longest in (3, 8, 40):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, longest))) for _ in range(1500)]
        texts += ["", None, "x" * 5000, "é" * 100, " " * 70]
        data, offsets = arrays.utf8(pa.array(texts))
        ids, bounds = encoder.encode_texts(data, offsets, records.END_ID)
        for text, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == ids_of(tokenizer, text)


def test_known_pieces_are_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr("codeprep.llm.encoding.MOST_KNOWN", 50)
    encoder = Encoder(PATH)
    for round_ in range(4):
        texts = [" ".join(f"word{round_}x{i}" for i in range(20)) for _ in range(3)]
        data, offsets = arrays.utf8(pa.array(texts))
        ids, bounds = encoder.encode_texts(data, offsets, None)
        assert ids[: bounds[1]].tolist() == ids_of(tokenizer, texts[0])[:-1]


def test_frame_round_trip_and_damage():
    ids = np.array([5, 50256, 2], np.uint16)
    for doc_id, width in ((7, 2), (None, 4), (-3, 2)):
        data = records.frame(ids, doc_id, width)
        got = records.read_frame(io.BytesIO(data + data))
        assert got[0] == doc_id and got[1].tolist() == ids.tolist()
        for at in (0, 9, 15, len(data) - 1):
            broken = bytearray(data)
            broken[at] ^= 1
            with pytest.raises(OSError):
                records.read_frame(io.BytesIO(bytes(broken)))
    assert records.read_frame(io.BytesIO(b"")) is None
    assert struct.unpack("<Q", data[:8])[0] == len(data) - 16


def test_documents_round_trip(spark, tokenizer):
    rng = random.Random(1)
    docs = [
        (i, " ".join(rng.choice(["the", "of", "ñandú", "x\n", ",", "LONGER"]) for _ in range(rng.randint(0, 60))), "p", 1)
        for i in range(300)
    ]
    docs += [(300, None, "p", 1), (301, "", "p", 1), (5, "again", "p", 1), (5, "again", "p", 1), (None, "z", "p", 1), (-4, "long " * 20000, "p", 1)]
    rng.shuffle(docs)
    folder = new_folder(spark, "records")
    shards = stage(
        records.write_records(spark.createDataFrame(docs, DOCS).repartition(6), folder, PATH), "shards"
    )
    got = sorted((r.asDict() for r in records.written_documents(shards).collect()), key=lambda r: r["start"])
    start, expected = 0, []
    for doc_id, text in sorted(((d[0], d[1]) for d in docs), key=lambda d: (d[0] is None, d[0] or 0, d[1] or "")):
        ids = np.array(ids_of(tokenizer, text), "<u4")
        expected.append({"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())})
        start += len(ids)
    assert got == expected


def test_a_repeated_run_replaces_its_shards(spark, tokenizer):
    docs = spark.createDataFrame([(i, f"text {i}", "p", 1) for i in range(20)], DOCS)
    folder = new_folder(spark, "records")
    for _ in range(2):
        shards = stage(records.write_records(docs, folder, PATH, partitions=3), "shards")
    assert records.written_documents(shards).count() == 20


def test_rows_of_one_id_are_dealt_to_many_shards(spark, tokenizer):
    rng = random.Random(7)
    words = lambda: " ".join(rng.choice(["the", "é", "😀", "x\n", "Of"]) for _ in range(rng.randint(1, 30)))
    docs = [(i, None if i is None else 7, words()) for i in [None, 1] for _ in range(600)]
    docs = [(doc_id, text, "p", 1) for _, doc_id, text in docs] + [(1, "first", "p", 1)]
    rng.shuffle(docs)
    folder = new_folder(spark, "records")
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    shards = stage(records.write_records(df, folder, PATH, partitions=8), "shards")
    sizes = [r.records for r in shards.collect()]
    assert sum(sizes) == 1201 and len(sizes) == 8 and max(sizes) < 300
    got = sorted((r.asDict() for r in records.written_documents(shards).collect()), key=lambda r: r["start"])
    order = sorted(((d[0], d[1]) for d in docs), key=lambda d: (d[0] is None, d[0] or 0, d[1].encode()))
    start = 0
    for row, (doc_id, text) in zip(got, order, strict=True):
        ids = np.array(ids_of(tokenizer, text), "<u4")
        assert row == {"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
        start += len(ids)


def test_empty_table(spark):
    shards = stage(
        records.write_records(spark.createDataFrame([], DOCS), new_folder(spark, "records"), PATH), "shards"
    )
    assert shards.count() == 0 and records.written_documents(shards).count() == 0
