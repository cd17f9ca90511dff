"""Token ids as compressed binary output (operator 9).

Every whole text is encoded with the tokenizers library and a public vocabulary,
an end id is appended, and the ids are written in ascending document order as
blocks of a file format: Parquet files of self-contained blocks, each with its
shard and number, the documents it holds, the range-coder payload
(``range_coder``) and a CRC-32 of all of that. Blocks start from an empty model,
so each can be read alone and in any order.

Scale. Documents are range-partitioned by id once, as texts; a partition is a
shard, encodes its words (each distinct word once, remembered) and codes its
blocks in lockstep, in groups of ``LANES``. A document longer than a block goes
on in the next ones; otherwise blocks end with a document. Positions come from
two levels of running sums: over shards, and over the blocks of a shard.

Results in odd cases. Null or empty text: the end id alone. Null ids come first;
equal ids in the order of their texts' hashes. An empty table writes no block and
reads no row. Extra columns are ignored. A damaged block fails the read with its
shard and number.
"""

from __future__ import annotations

import functools
import itertools
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from orderlens.llm import range_coder
from orderlens.llm.scratch import scratch_dir, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BLOCK = 8192
LANES = 512
_REMEMBERED = 1 << 19


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Encoder:
    """Ids of texts, word by word: blanks end a token, so what lies between them is encoded by itself.

    Many words are encoded in one call, a special token of the vocabulary between
    them: the library splits a text at special tokens before all else. Words that
    hold that token's text, and all where no token will do, are encoded singly.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {"": b""}
        plain = [
            (token.content, k)
            for k, token in self.tokenizer.get_added_tokens_decoder().items()
            if token.content and token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word)
        ]
        self.between = max(plain, key=lambda x: x[1], default=None)

    def _learn(self, words: list[str]) -> None:
        mark, number = self.between or ("", 0)
        joint = [w for w in words if mark not in w]
        for at in range(0, len(joint), 256):
            some = joint[at : at + 256]
            ids = np.array(self.tokenizer.encode_batch_fast([mark.join(some)], add_special_tokens=False)[0].ids, "<u2")
            ends = np.flatnonzero(ids == number)
            if len(ends) != len(some) - 1:
                self._learn_singly(some)
                continue
            raw, ends = ids.tobytes(), (2 * ends).tolist()
            self.words.update(zip(some, [raw[a:b] for a, b in zip([0, *[x + 2 for x in ends]], [*ends, len(raw)], strict=True)], strict=True))
        self._learn_singly([w for w in words if mark in w])

    def _learn_singly(self, words: list[str]) -> None:
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            for w, e in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
                self.words[w] = struct.pack(f"<{len(e.ids)}H", *e.ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # two blanks in a row have an empty word between them, which has no ids
        parts = [t.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ") for t in texts]
        known = self.words
        if len(known) >= _REMEMBERED:
            known.clear()
            known[""] = b""
        self._learn(list(set(itertools.chain.from_iterable(parts)).difference(known)))
        end = struct.pack("<H", END_ID)
        return [np.frombuffer(b"".join(map(known.__getitem__, p)) + end, "<u2") for p in parts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def checksum(shard: int, block: int, ordinals: np.ndarray, counts: np.ndarray, payload: bytes) -> int:
    head = struct.pack("<qqq", shard, block, len(counts)) + ordinals.astype("<i8").tobytes() + counts.astype("<i8").tobytes()
    return zlib.crc32(payload, zlib.crc32(head))


def _cut(ids: list[np.ndarray], size: int) -> Iterator[list[tuple[int, int, int]]]:
    """Blocks as lists of (document, from, to)."""
    block, room = [], size
    for d, x in enumerate(ids):
        if block and len(x) > room:
            yield block
            block, room = [], size
        for a in range(0, len(x), size):
            b = min(len(x), a + size)
            block.append((d, a, b))
            room -= b - a
            if b - a == size:
                yield block
                block, room = [], size
    if block:
        yield block


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, size: int = BLOCK) -> None:
    """Write the ids of all ``docs`` as blocks into the folder ``path``."""
    vocabulary = vocabulary or vocabulary_path()
    kind = docs.schema[id_col].dataType
    schema = StructType(
        [
            StructField("shard", LongType()),
            StructField("block", LongType()),
            StructField("n_ids", LongType()),
            StructField("doc_ids", ArrayType(kind)),
            StructField("ordinals", ArrayType(LongType())),
            StructField("counts", ArrayType(LongType())),
            StructField("whole", ArrayType(BooleanType())),
            StructField("payload", BinaryType()),
            StructField("crc", LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        enc, blocks, ready, ordinal, number = encoder(vocabulary), [], 0, 0, 0

        def flush(upto: int) -> pa.RecordBatch:
            nonlocal blocks, number
            some, blocks = blocks[:upto], blocks[upto:]
            codes = range_coder.encode([np.concatenate([p[2] for p in b]) for b in some])
            rows = []
            for b, code in zip(some, codes, strict=True):
                ordinals, counts = np.array([p[1] for p in b], np.int64), np.array([len(p[2]) for p in b], np.int64)
                rows.append((shard, number, int(counts.sum()), [p[0] for p in b], ordinals, counts, [p[3] for p in b], code, checksum(shard, number, ordinals, counts, code)))
                number += 1
            types = [pa.int64(), pa.int64(), pa.int64(), None, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([_array(c, t, id_type) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=schema.names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 256):
                names = batch.column(0).slice(at, 256).to_pylist()
                ids = enc.encode(batch.column(1).slice(at, 256).to_pylist())
                for cut in _cut(ids, size):
                    blocks.append([(names[d], ordinal + d, ids[d][a:b], b - a == len(ids[d])) for d, a, b in cut])
                ordinal += len(ids)
                while len(blocks) >= LANES:
                    yield flush(LANES)
        if blocks:
            yield flush(len(blocks))

    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    tie = F.xxhash64("_text")
    rows = rows.repartitionByRange(F.col("_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("_id").asc_nulls_first(), tie)
    rows.mapInArrow(run, schema).write.parquet(path)


def _array(values, kind, id_type) -> pa.Array:
    return pa.array(values, pa.list_(id_type) if kind is None else kind)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids_crc32, n_tokens, start, shard, ordinal) of every document in the files, from the decoded blocks."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType
    sizes = blocks.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("_all"))
    # one row a shard, that is a partition of the write
    before = shards.withColumn("_before", F.coalesce(F.sum("_all").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = sizes.withColumn("_in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(before, "shard")
    at = at.select("shard", "block", (F.col("_before") + F.col("_in")).alias("_start"))
    schema = StructType(
        [
            StructField("shard", LongType()),
            StructField("block", LongType()),
            StructField("ordinal", LongType()),
            StructField("doc_id", kind),
            StructField("_within", LongType()),
            StructField("n_tokens", LongType()),
            StructField("ids_crc32", LongType()),
            StructField("_whole", BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == LANES:
                    yield _decoded(held, schema, batch.schema.field("doc_ids").type.value_type)
                    held = []
            id_type = batch.schema.field("doc_ids").type.value_type
        if held:
            yield _decoded(held, schema, id_type)

    # written, a narrow row a document and block: every block is decoded once
    parts = table(blocks.mapInArrow(run, schema), "decoded").join(at, ["shard", "block"])
    parts = parts.withColumn("start", F.col("_start") + F.col("_within"))
    # the parts of a long document: their checksums combine in order
    long = parts.where("not _whole").groupBy("shard", "ordinal").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("start", "n_tokens", "ids_crc32"))).alias("_parts"),
    )
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "shard", "ordinal"]

    @F.pandas_udf("long")
    def combined(parts):
        return parts.map(lambda p: functools.reduce(lambda a, b: (crc32_combine(a[0], b["ids_crc32"], 4 * b["n_tokens"]),), p[1:], (p[0]["ids_crc32"],))[0])

    return parts.where("_whole").select(*names).unionByName(long.withColumn("ids_crc32", combined("_parts")).select(*names))


def _decoded(rows: list[dict], schema: StructType, id_type: pa.DataType) -> pa.RecordBatch:
    for r in rows:
        if checksum(r["shard"], r["block"], np.array(r["ordinals"]), np.array(r["counts"]), r["payload"]) != r["crc"]:
            raise ValueError(f"block {r['block']} of shard {r['shard']} is damaged")
    out: list[list] = [[] for _ in schema.names]
    for r, ids in zip(rows, range_coder.decode([r["payload"] for r in rows], [r["n_ids"] for r in rows]), strict=True):
        raw, within = ids.astype("<u4").tobytes(), 0
        for name, ordinal, n, whole in zip(r["doc_ids"], r["ordinals"], r["counts"], r["whole"], strict=True):
            crc = zlib.crc32(raw[4 * within : 4 * (within + n)])
            for column, x in zip(out, (r["shard"], r["block"], ordinal, name, within, n, crc, whole), strict=True):
                column.append(x)
            within += n
    types = [pa.int64(), pa.int64(), pa.int64(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=schema.names)


def crc32_combine(a: int, b: int, length: int) -> int:
    """The CRC-32 of two byte strings one after the other, from theirs and the second's length."""

    def times(m: list[int], v: int) -> int:
        out, i = 0, 0
        while v:
            if v & 1:
                out ^= m[i]
            v >>= 1
            i += 1
        return out

    # the matrix that appends one zero byte, squared for each bit of the length
    step = [0xEDB88320] + [1 << k for k in range(31)]  # one zero bit
    for _ in range(3):
        step = [times(step, x) for x in step]
    while length:
        if length & 1:
            a = times(step, a)
        step = [times(step, x) for x in step]
        length >>= 1
    return a ^ b


def write_and_read(docs: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all ``docs``, from the files written for them."""
    spark = docs.sparkSession
    path = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write(docs, path)
    return read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
