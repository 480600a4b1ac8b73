"""Token ids in Arrow stream files of fixed-size-list batches.

A file is one Arrow stream: a schema message, then record batches of
SEQUENCES equal-length sequences each (the last may have fewer), with columns
tokens (fixed-size list of uint16 or uint32) and mask (fixed-size list of
bool, false on the padding at the end of the file).  The schema's metadata
holds the file's place in the order and an index of its documents.  Batches
of one shape have one length in bytes, so a reader finds sequence k by
arithmetic and views it in the mapped file without a copy.

Documents are dealt to files by ranges of doc_id, so files follow one another
in that order, and no document is in two files.  Tasks hand each finished
stream to Spark's writer as one row of one file: its commit protocol keeps the
files of one attempt of each task, on any file system that Spark writes to.
The writer adds one line end, which readers of the stream don't reach.

Defined cases: a null text has no tokens but the end id; null ids come first;
rows with one id follow each other in the order of their texts' hashes; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from memloom.llm.common import bounded_broadcast, scratch, worker_held, written

SEQUENCES = 256


@dataclass(frozen=True)
class Layout:
    """tokenizer: file at the same place on all machines.  end_id: closes each document.  length: tokens of a sequence.  file_tokens: a file is closed once it has so many."""

    tokenizer: str
    end_id: int = 2
    length: int = 2048
    file_tokens: int = 4 << 20


class CachedEncoder:
    """The library's ids of whole texts, with those of repeated chunks kept.

    A text is cut at each space that a sign other than white space follows.
    The pattern of byte-level tokenizers never takes such a space and what is
    before it into one piece, so chunks can be encoded apart; nor does it take
    letters and signs after them into one piece, unless an apostrophe begins
    these.  A text that holds the name of a special token goes to the library
    whole.
    """

    KEPT, CHUNK = 400_000, 64
    CUT, ODD = re.compile(r" (?=\S)"), re.compile(r" (?:\s|\Z)")
    SIGNS = ".,;:!?|*#%$&)]}\"'\n"

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.type = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.sizes = np.zeros(self.library.get_vocab_size(), dtype=np.int64)
        for token, i in self.library.get_vocab().items():
            self.sizes[i] = len(token)
        #: Ids of chunks after their space, and of signs that follow letters.
        self.kept: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.type).tobytes()

    def tail(self, signs: str) -> bytes:
        found = self.signs.get(signs)
        if found is None:
            found = self.whole(signs)
            if len(self.signs) < 10_000 and len(signs) <= self.CHUNK:
                self.signs[signs] = found
        return found

    def learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of chunks after their space, all from one call: the tokens' lengths deal them out again."""
        if not new:
            return {}
        ids = np.array(self.library.encode_batch_fast([" " + " ".join(new)], add_special_tokens=False)[0].ids, dtype=self.type)
        ends = np.cumsum([1 + len(c.encode("utf-8", "surrogatepass")) for c in new], dtype=np.int64)
        places = np.cumsum(self.sizes[ids], dtype=np.int64)
        last = np.searchsorted(places, ends)
        if not (last[-1] < len(places) and (places[last] == ends).all()):
            raise ValueError("the tokenizer takes parts of two chunks into one token")
        data, size = ids.tobytes(), self.type.itemsize
        stops = ((last + 1) * size).tolist()
        return {c: data[a:b] for c, a, b in zip(new, [0, *stops], stops)}

    def encode(self, texts: list[str]) -> list[bytes]:
        parts: list[str] = []
        starts, whole = [], {}
        for k, text in enumerate(texts):
            starts.append(len(parts))
            if any(s in text for s in self.special):
                whole[k] = self.whole(text)
            else:
                # Without a space before white space or the end, each space is a cut.
                parts += self.CUT.split(text) if self.ODD.search(text) else text.split(" ")
        starts.append(len(parts))
        got = list(map(self.kept.get, parts))
        for a, b in zip(starts, starts[1:]):
            if a < b:
                got[a] = self.tail(parts[a])
        missing = [k for k, ids in enumerate(got) if ids is None]
        if missing:
            fresh = self.fresh({parts[k] for k in missing})
            for k in missing:
                got[k] = fresh[parts[k]]
        return [whole[k] if k in whole else b"".join(got[a:b]) for k, (a, b) in enumerate(zip(starts, starts[1:]))]

    def fresh(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that aren't kept; letters and the signs after them are looked up apart."""
        new, cut = set(), []
        for chunk in chunks:
            if not chunk.isalpha():
                core = chunk.rstrip(self.SIGNS)
                signs = chunk[len(core) :]
                if signs and signs[0] not in "'\n" and core.isalpha():
                    cut.append((chunk, core, signs))
                    if core not in self.kept:
                        new.add(core)
                    continue
            new.add(chunk)
        out = self.learn(list(new))
        for chunk, core, signs in cut:
            out[chunk] = (out[core] if core in new else self.kept[core]) + self.tail(signs)
        for c, ids in out.items():
            if len(self.kept) >= self.KEPT:
                break
            if len(c) <= self.CHUNK:
                self.kept[c] = ids
        return out


def encoder(path: str) -> CachedEncoder:
    """One for each worker."""
    return worker_held(("byte bpe", path), lambda: CachedEncoder(path))


def stream_of(ids: np.ndarray, doc_ids: list, sizes: list[int], part: int, number: int, length: int) -> bytes:
    """One file: the ids of whole documents, one after the other."""
    index = pa.record_batch({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(sizes, pa.int64())})
    kind = pa.list_(pa.from_numpy_dtype(ids.dtype), length)
    fields = [pa.field("tokens", kind), pa.field("mask", pa.list_(pa.bool_(), length))]
    meta = {b"part": str(part).encode(), b"number": str(number).encode(), b"index_schema": index.schema.serialize().to_pybytes(), b"index": index.serialize().to_pybytes()}
    schema = pa.schema(fields, metadata=meta)
    rows = -(-len(ids) // length)
    flat = np.zeros(rows * length, dtype=ids.dtype)
    flat[: len(ids)] = ids
    mask = np.arange(rows * length) < len(ids)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        for at in range(0, rows, SEQUENCES):
            cut = slice(at * length, min(rows, at + SEQUENCES) * length)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(flat[cut]), type=fields[0].type), pa.FixedSizeListArray.from_arrays(pa.array(mask[cut]), type=fields[1].type)]
            out.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
    return sink.getvalue().to_pybytes()


def write_token_files(docs: DataFrame, path: str, layout: Layout, parts: int | None = None) -> None:
    """Writes the texts' ids below path, in ascending order of doc_id over parts and numbers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, number = encoder(layout.tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([layout.end_id], dtype=own.type).tobytes()
        held: list[bytes] = []
        doc_ids: list = []
        size = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype=own.type)
            data = stream_of(ids, doc_ids, [len(x) // own.type.itemsize for x in held], part, number, layout.length)
            return pa.record_batch({"content": pa.array([data], pa.binary())})

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                coded = own.encode(some.column(1).to_pylist())
                for doc_id, ids in zip(some.column(0).to_pylist(), coded):
                    held.append(ids + end)
                    doc_ids.append(doc_id)
                    size += len(held[-1]) // own.type.itemsize
                    if size >= layout.file_tokens:
                        yield close()
                        held, doc_ids, size, number = [], [], 0, number + 1
        if held:
            yield close()

    files = dealt.mapInArrow(run, "content binary")
    # The text writer copies a string's bytes as they are; each file takes one row.
    files.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


class TokenFile:
    """A file's sequences and masks, as views of its bytes.

    source: bytes, an Arrow buffer, or a local path, which is mapped.
    """

    def __init__(self, source):
        self.buffer = pa.memory_map(source).read_buffer() if isinstance(source, str) else pa.py_buffer(source)
        reader = pa.ipc.open_stream(self.buffer)
        self.schema = reader.schema
        self.length = self.schema.field("tokens").type.list_size
        meta = self.schema.metadata
        self.part, self.number = int(meta[b"part"]), int(meta[b"number"])
        index = pa.ipc.read_record_batch(pa.py_buffer(meta[b"index"]), pa.ipc.read_schema(pa.py_buffer(meta[b"index_schema"])))
        self.doc_ids, self.sizes = index.column(0), index.column(1).to_numpy()
        self.tokens = int(self.sizes.sum())
        self.sequences = -(-self.tokens // self.length)
        self.head = len(self.schema.serialize())
        self.stride = 0
        if self.sequences > SEQUENCES:
            source = pa.BufferReader(self.buffer)
            source.seek(self.head)
            pa.ipc.read_message(source)
            self.stride = source.tell() - self.head

    def batch(self, number: int) -> pa.RecordBatch:
        """Record batch number, found by its offset; its columns point into the file's bytes."""
        message = pa.ipc.read_message(self.buffer.slice(self.head + number * self.stride))
        return pa.ipc.read_record_batch(message, self.schema)

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Sequence k and its mask, without a copy."""
        if not 0 <= k < self.sequences:
            raise IndexError(k)
        batch, at = self.batch(k // SEQUENCES), k % SEQUENCES * self.length
        tokens, mask = (batch.column(c).flatten().slice(at, self.length) for c in (0, 1))
        return tokens.to_numpy(zero_copy_only=True), mask

    def ids(self) -> np.ndarray:
        """All ids, without padding."""
        parts = []
        for k in range(-(-self.sequences // SEQUENCES)):
            batch = self.batch(k)
            tokens = batch.column(0).flatten().to_numpy()
            parts.append(tokens if k < self.sequences // SEQUENCES else tokens[batch.column(1).flatten().to_numpy(zero_copy_only=False)])
        return np.concatenate(parts) if parts else np.zeros(0, "<u2")


def file_documents(spark: SparkSession, path: str) -> DataFrame:
    """part, number (of the file), doc_id, within (ids before the document in its file), n_tokens, ids (binary, little-endian unsigned 32-bit integers)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                file = TokenFile(data.as_buffer())
                ids, ends = file.ids(), np.cumsum(file.sizes)
                starts = ends - file.sizes
                for at in range(0, len(ends), 1024):
                    cut = slice(at, at + 1024)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([file.part] * len(ends[cut]), pa.int64()),
                            pa.array([file.number] * len(ends[cut]), pa.int64()),
                            file.doc_ids.slice(at, 1024),
                            pa.array(starts[cut]),
                            pa.array(file.sizes[cut]),
                            pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(starts[cut], ends[cut])], pa.binary()),
                        ],
                        names=["part", "number", "doc_id", "within", "n_tokens", "ids"],
                    )

    return raw.select("content").mapInArrow(documents, "part long, number long, doc_id long, within long, n_tokens long, ids binary")


def with_starts(found: DataFrame) -> DataFrame:
    """found (part, number, within, n_tokens and others) with start, the ids before the document over all files.

    Sums go up by file, then by part; a part is one of the writer's tasks, so
    the last sum runs over as many rows as the writer had tasks.
    """
    before = lambda w: F.coalesce(F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = written(found.groupBy("part", "number").agg(F.sum("n_tokens").alias("tokens")), "files")
    parts = files.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    parts = parts.select("part", before(Window.orderBy("part")).alias("base"))
    inside = files.select("part", "number", before(Window.partitionBy("part").orderBy("number")).alias("inside"))
    bases = inside.join(parts, "part").select("part", "number", (F.col("base") + F.col("inside")).alias("base"))
    return found.join(bounded_broadcast(bases, 64), ["part", "number"]).withColumn("start", F.col("base") + F.col("within")).drop("base", "within", "part", "number")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document over all files), n_tokens, ids (binary, little-endian unsigned 32-bit integers)."""
    return with_starts(file_documents(spark, path)).select("doc_id", "start", "n_tokens", "ids")


def token_report(docs: DataFrame, layout: Layout, path: str | None = None) -> DataFrame:
    """Writes docs as files and returns each document's place and checksum, read back from them once."""
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    write_token_files(docs, path, layout)
    found = file_documents(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return with_starts(written(found, "back")).select("doc_id", "start", "n_tokens", "ids_crc32")
