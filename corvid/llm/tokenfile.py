"""Token ids in Arrow files: equal-length sequences and masks, read back without copying (11).

Layout of a folder of token files:

* ``part-NNNNNN-*.arrow``: an Arrow IPC file (record batches and a footer that finds each of
  them). A batch holds up to ``batch_rows`` rows of two fixed-size lists of ``seq_len``
  values: ``ids`` (the narrowest unsigned type that holds the vocabulary) and ``mask``
  (one bit each, set for an id, clear for padding). All batches of a file but the last have the same
  number of rows and only a file's last sequence is padded, so sequence ``i`` is at row
  ``i % batch_rows`` of batch ``i // batch_rows`` and, in a memory-mapped file, a view.
* ``part-NNNNNN-*.docs.arrow``: the documents of that file, ``(doc_id, start, n_tokens)``.
* ``manifest`` (Parquet): one row per file, with its first id, sequence and document.

Documents follow each other in ascending id order (null ids first; rows with equal ids by a
hash of their text), each with the end id after its ids. Null text counts as empty text.

The plan: range bounds of the ids are read from the id column (not from a sample of encoded
rows, so nothing is encoded twice); texts are encoded where they lie; only the packed ids go
through the one exchange, to the range they belong to, and are sorted and written there. A
file is named by its attempt and counts only if the attempt's manifest row is committed, so
attempts that were lost or ran twice leave no trace in the result.
"""

from __future__ import annotations

import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import slices

SEQ_LEN = 2048
BATCH_ROWS = 128
FILE_BYTES = 128 << 20   # text per file, about
END_ID = 2
CACHE_WORDS = 300_000    # words of a generation that an encoder remembers
CACHE_WORD = 64          # longer words are not remembered
SLICE = 4 << 20          # bytes of text encoded at once, or a single text
#: The end of a splitting pattern that keeps letters, digits and other characters apart.
RUNS_APART = r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CLOSING = r"([A-Za-z0-9])([.,;:!?*#%&$])"
JOINED = 1 << 18         # characters of unknown words encoded at once


class WordEncoder:
    """A tokenizer applied word by word. The given tokenizers split at white space, drop it
    and look at nothing across it, so a text's ids are the ids of its words in order. The
    words of a slice of texts are dictionary-encoded first; packed ids of words met lately
    are remembered (two generations of ``CACHE_WORDS`` words), the others are encoded
    together, as one text, and told apart by their tokens' offsets.

    So that fewer words differ, texts are lower-cased (A-Z) first where the tokenizer's file
    says that it does so anyway, and closing punctuation is set apart where the file says that
    runs of letters, digits and other characters are never joined."""

    def __init__(self, path: str, dtype: str, words: bool = True):
        from tokenizers import Tokenizer

        self.tok, self.dtype, self.words = Tokenizer.from_file(path), np.dtype(dtype), words
        told = json.loads(self.tok.to_str())
        self.lower = '"Lowercase"' in json.dumps(told.get("normalizer"))
        self.cut = json.dumps(RUNS_APART)[1:-1] in json.dumps(told.get("pre_tokenizer"))
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype)

    def _fresh(self, words: list[str]) -> None:
        """Remember the ids of new words, ``JOINED`` characters or a single word at a time."""
        ends = np.cumsum([len(w) + 1 for w in words])
        i = 0
        while i < len(words):
            base = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, base + JOINED, "right")))
            got = self.tok.encode(" ".join(words[i:j]), add_special_tokens=False)
            flat, size = np.array(got.ids, self.dtype).tobytes(), self.dtype.itemsize
            starts = np.fromiter((a for a, _ in got.offsets), np.int64)
            cuts = (np.searchsorted(starts, ends[i:j] - base) * size).tolist()  # ids that start before the next word
            self.known.update(zip(words[i:j], (flat[a:b] for a, b in zip([0, *cuts], cuts))))
            i = j

    def __call__(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of each text's ids."""
        if not self.words:
            ids = [self._whole(t) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, self.dtype), *ids]), np.array([len(i) for i in ids], np.int64)
        if self.lower and not pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens keep their case
            texts = pc.ascii_lower(texts)
        if self.cut:
            texts = pc.replace_substring_regex(texts, CLOSING, r"\1 \2")
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        known, old, new = self.known, self.old, []
        for w in words:
            if w not in known:
                if w in old:
                    known[w] = old[w]
                else:
                    new.append(w)
        self._fresh(new)
        packed = [known[w] for w in words]
        for w in new:
            if len(w) > CACHE_WORD:
                del known[w]
        if len(known) > CACHE_WORDS:
            self.known, self.old = {"": b""}, known
        ids = np.frombuffer(b"".join(packed), self.dtype)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[at]
        until = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        flat = ids[np.repeat(starts[at] - until[:-1], counts) + np.arange(until[-1])]
        return flat, np.diff(until[split.offsets.to_numpy()])


_encoders: dict[tuple, WordEncoder] = {}


def _encoder(path: str, dtype: str, words: bool) -> WordEncoder:
    key = (path, dtype, words)
    if key not in _encoders:
        _encoders[key] = WordEncoder(*key)
    return _encoders[key]


def id_type(path: str, end_id: int) -> str:
    """The narrowest little-endian unsigned type for a tokenizer's ids and the end id."""
    from tokenizers import Tokenizer

    top = max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)
    return "<u2" if max(top, end_id) < 1 << 16 else "<u4"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it of a folder that Spark names by path or URI."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


def _range_bounds(keys: DataFrame, n: int) -> list[tuple]:
    """The first key of each of ``n`` ranges of the sorted keys but the first: at most n - 1."""
    first = (keys.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "h", "m")
             .groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("k"),
                                                                            "doc_id", "h", "m")).alias("low")))
    return sorted(tuple(r["low"]) for r in first.collect())[1:]


def encode(docs: DataFrame, tokenizer: str, dtype: str, end_id: int, bounds: list[tuple], words: bool = True) -> DataFrame:
    """``(part, doc_id, h, m, ids)``: each row's packed ids and the range it belongs to."""
    id_field = docs.schema["doc_id"]
    schema = T.StructType([T.StructField("part", T.IntegerType()), id_field, T.StructField("h", T.LongType()),
                           T.StructField("m", T.LongType()), T.StructField("ids", T.BinaryType())])
    cuts = docs.sparkSession.sparkContext.broadcast(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer, dtype, words)
        for s in slices(batches, most=SLICE):
            b = s.batch
            keys = zip(b.column("doc_id").to_pylist(), b.column("h").to_pylist(), b.column("m").to_pylist())
            part = [bisect_right(cuts.value, (i is not None, i, h, m)) for i, h, m in keys]
            got, counts = enc(pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(s.offsets), pa.py_buffer(s.data)))
            until = np.cumsum(counts)
            flat = np.insert(got, until, end_id)  # each text's end id
            at = np.concatenate([np.zeros(1, np.int64), until + np.arange(1, len(s) + 1)]) * flat.itemsize
            ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(at), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), b.column("doc_id"), b.column("h"), b.column("m"), ids.cast(pa.binary())],
                ["part", "doc_id", "h", "m", "ids"])

    return docs.select("doc_id", "h", "m", "text").mapInArrow(run, schema)


class _Writer:
    """One file pair, written batch by batch."""

    def __init__(self, folder: str, part: int, doc_type: pa.DataType, dtype: str, seq_len: int, batch_rows: int):
        fs, root = filesystem(folder)
        self.name = f"part-{part:06d}-{uuid.uuid4().hex}"
        self.dtype, self.seq_len, self.room = np.dtype(dtype), seq_len, seq_len * batch_rows
        ids = pa.list_(pa.field("item", pa.from_numpy_dtype(self.dtype), nullable=False), seq_len)
        mask = pa.list_(pa.field("item", pa.bool_(), nullable=False), seq_len)
        self.schema = pa.schema([pa.field("ids", ids, nullable=False), pa.field("mask", mask, nullable=False)])
        self.doc_schema = pa.schema([("doc_id", doc_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [fs.open_output_stream(f"{root}/{self.name}{s}") for s in (".arrow", ".docs.arrow")]
        self.seqs = pa.ipc.new_file(self.sinks[0], self.schema)
        self.docs = pa.ipc.new_file(self.sinks[1], self.doc_schema)
        self.buffer, self.held = np.zeros(self.room, self.dtype), 0
        self.n_ids = self.n_seq = self.n_docs = 0

    def _flush(self) -> None:
        rows = -(-self.held // self.seq_len)
        if rows:
            flat = self.buffer[: rows * self.seq_len].copy()
            flat[self.held:] = 0
            mask = np.arange(len(flat)) < self.held
            self.seqs.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type) for v, f in zip((flat, mask), self.schema)],
                schema=self.schema))
        self.n_seq, self.held = self.n_seq + rows, 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        starts = self.n_ids + np.cumsum(counts) - counts
        self.docs.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(counts)], schema=self.doc_schema))
        self.n_ids, self.n_docs = self.n_ids + len(ids), self.n_docs + len(counts)
        while len(ids):
            k = min(len(ids), self.room - self.held)
            self.buffer[self.held: self.held + k] = ids[:k]
            self.held, ids = self.held + k, ids[k:]
            if self.held == self.room:
                self._flush()

    def close(self) -> None:
        self._flush()
        for f in (self.seqs, self.docs, *self.sinks):
            f.close()


MANIFEST = "part int, file string, n_ids bigint, n_sequences bigint, n_docs bigint"


def write(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          seq_len: int = SEQ_LEN, batch_rows: int = BATCH_ROWS, file_bytes: int = FILE_BYTES, words: bool = True) -> DataFrame:
    """Write the token files of ``docs`` into a new ``folder`` and return the manifest
    ``(part, file, n_ids, n_sequences, n_docs, first_id, first_sequence, first_doc)``.

    ``words=False`` encodes whole texts at once, for a tokenizer that looks across white
    space. An empty table gives an empty manifest and no file; an empty text is the end id
    alone. Other columns of ``docs`` are not written.
    """
    spark = docs.sparkSession
    dtype = id_type(tokenizer, end_id)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.withColumns({"h": F.xxhash64(F.coalesce("text", F.lit(""))), "m": F.monotonically_increasing_id()})
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-size // file_bytes))
    bounds = _range_bounds(src.select("doc_id", "h", "m"), n)
    rows = encode(src, tokenizer, dtype, end_id, bounds, words)
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), None
        for b in batches:
            if not len(b):
                continue
            ids = b.column("ids").cast(pa.large_binary())
            at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1 + ids.offset)[ids.offset:]
            flat = np.frombuffer(ids.buffers()[2], np.uint8)[at[0]: at[-1]].view(dtype)
            out = out or _Writer(folder, part, b.column("doc_id").type, dtype, seq_len, batch_rows)
            out.add(b.column("doc_id"), flat, np.diff(at) // np.dtype(dtype).itemsize)
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": out.name, "n_ids": out.n_ids, "n_sequences": out.n_seq,
                                               "n_docs": out.n_docs}], schema=pa.schema(
                [("part", pa.int32()), ("file", pa.string()), *[(c, pa.int64()) for c in ("n_ids", "n_sequences", "n_docs")]]))

    dealt = rows.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "h", "m").select("doc_id", "ids")
    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/parts")
    facts, first = [], [0, 0, 0]
    for r in sorted(spark.read.parquet(f"{folder}/parts").collect(), key=lambda r: r["part"]):  # one row per file
        facts.append((*r, *first))
        first = [a + r[c] for a, c in zip(first, ("n_ids", "n_sequences", "n_docs"))]
    spark.createDataFrame(facts, MANIFEST + ", first_id bigint, first_sequence bigint, first_doc bigint").write.parquet(
        f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _open(folder: str, name: str) -> pa.ipc.RecordBatchFileReader:
    fs, root = filesystem(folder)
    local = isinstance(fs, pafs.LocalFileSystem)
    return pa.ipc.open_file(pa.memory_map(f"{root}/{name}") if local else fs.open_input_file(f"{root}/{name}"))


class TokenFile:
    """Random access to one file's sequences: ids as a numpy view, the mask as an Arrow
    boolean view. In a local (memory-mapped) file both are views of the file's pages."""

    def __init__(self, folder: str, file: str):
        self.reader = _open(folder, f"{file}.arrow")
        self.seq_len = self.reader.schema.field("ids").type.list_size
        n = self.reader.num_record_batches
        self.batch_rows = self.reader.get_batch(0).num_rows if n else 0
        self.length = (n - 1) * self.batch_rows + self.reader.get_batch(n - 1).num_rows if n else 0

    def __len__(self) -> int:
        return self.length

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < self.length:
            raise IndexError(i)
        b = self.reader.get_batch(i // self.batch_rows)
        ids, mask = (b.column(c).flatten().slice(i % self.batch_rows * self.seq_len, self.seq_len) for c in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def runs(self) -> Iterator[np.ndarray]:
        """The file's ids in order, padding left out, a batch at a time."""
        for k in range(self.reader.num_record_batches):
            b = self.reader.get_batch(k)
            ids, mask = (b.column(c).flatten() for c in ("ids", "mask"))
            yield (ids if mask.true_count == len(mask) else ids.filter(mask)).to_numpy(zero_copy_only=True)


def _documents(file: TokenFile, docs: pa.ipc.RecordBatchFileReader) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches of the documents with the crc32 of each one's ids as 32-bit integers."""
    runs, have, at, base = file.runs(), memoryview(b""), 0, 0
    for k in range(docs.num_record_batches):
        b = docs.get_batch(k)
        sums = []
        for n in b.column("n_tokens").to_pylist():
            crc, left = 0, n * 4
            while left:
                if at == len(have):
                    have, at = memoryview(next(runs).astype("<u4").tobytes()), 0
                step = min(left, len(have) - at)
                crc = zlib.crc32(have[at: at + step], crc)
                at, left = at + step, left - step
            sums.append(crc)
        base += len(sums)
        yield b, sums
    if at != len(have) or next(runs, None) is not None:
        raise ValueError(f"token file: ids beyond its {base} documents")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files: ``start``
    counts the ids of all documents before it. One task opens each file."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    n = max(1, manifest.count())
    probe = manifest.select("file").first()
    doc_type = T.LongType() if probe is None else _spark_type(folder, probe["file"])
    schema = T.StructType([T.StructField("doc_id", doc_type), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, first in zip(b.column("file").to_pylist(), b.column("first_id").to_pylist()):
                for d, sums in _documents(TokenFile(folder, name), _open(folder, f"{name}.docs.arrow")):
                    start = pa.array(d.column("start").to_numpy() + first)
                    yield pa.RecordBatch.from_arrays([d.column("doc_id"), start, d.column("n_tokens"), pa.array(sums, pa.int64())],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.select("part", "file", "first_id").repartitionByRange(n, "part").mapInArrow(run, schema)


def _spark_type(folder: str, file: str) -> T.DataType:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(_open(folder, f"{file}.docs.arrow").schema.field("doc_id").type)


def sequences(spark: SparkSession, folder: str) -> DataFrame:
    """``(sequence bigint, ids array<int>, mask array<tinyint>)``: every sequence, numbered
    over all files."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, first in zip(b.column("file").to_pylist(), b.column("first_sequence").to_pylist()):
                reader = _open(folder, f"{name}.arrow")
                for k in range(reader.num_record_batches):
                    got = reader.get_batch(k)
                    number = pa.array(np.arange(first, first + got.num_rows))
                    first += got.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [number, got.column("ids").cast(pa.list_(pa.int32())), got.column("mask").cast(pa.list_(pa.int8()))],
                        ["sequence", "ids", "mask"])

    return manifest.select("part", "file", "first_sequence").repartitionByRange(n, "part").mapInArrow(
        run, "sequence bigint, ids array<int>, mask array<tinyint>")
