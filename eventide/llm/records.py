"""Token ids as length-delimited binary records with a separate offset index.

Framing of a data file (one record after another, no header)::

    u64 length | u32 masked checksum of the length | payload | u32 masked checksum of the payload

Payload: u8 bytes per id (2 or 4), u8 flags (1: the id is null), i64 document
id, u32 number of ids, the ids.  All numbers are little-endian.  A checksum is
crc32, rotated right by 15 bits plus a constant, so that a checksum stored
inside checksummed data stays sound.  Each data file ``part-N.rec`` has an index
``part-N.idx`` of 24-byte entries (document id, offset, payload length, flags);
a shuffled reader needs the index alone to plan, and one read per record.

Rows are range-partitioned by document id and sorted, so file number and place
in a file give the global order; rows of one id (repeated or null, nulls first)
are ordered by a hash of their text.  A null or empty text is the end id alone.
Extra columns are not stored.  An empty table writes no file.  A task writes
under a name of its own and renames it when complete, so a task that runs twice
or dies half-way leaves no partial file under a final name.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gives_back, partitions, per_worker, shared_path, ships_by_value, whole

INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u4"), ("flags", "<u4")])
MASK = 0xA282EAD8
HEAD, BODY = "<QI", "<BBqI"
HEAD_SIZE, BODY_SIZE = struct.calcsize(HEAD), struct.calcsize(BODY)

#: Texts of one slice of an Arrow batch (of the encoder: it looks at each distinct word
#: of a slice), and pre-tokens remembered per worker.
SLICE_BYTES, ENCODE_BYTES = 2 << 20, 4 << 20
MEMO_WORDS = 400_000

#: Words that need no normalisation beyond lower case: letters, then marks.  The
#: letters and the marks are one pre-token each.
PLAIN = r"^(?P<head>[a-zA-ZÀ-ÖØ-öø-ÿ]*)(?P<tail>[.,;:!?*#%&$|()]*)$"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload,
                     struct.pack("<I", masked(payload))))


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the runs ``[start, start + size)``, one run after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class WordEncoder:
    """Encodes texts word by word.  The tokenizer drops white space and never
    merges across it, so a text's ids are its words' ids one after another.  Each
    distinct pre-token is encoded once and its ids kept in one pool."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.full = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.dtype = np.dtype("<u2" if self.full.get_vocab_size() <= 1 << 16 else "<u4")
        self._forget()

    def _forget(self) -> None:
        # Entry 0 is the empty pre-token.  Words outside the plain form are kept
        # under their own text after a space, which no pre-token contains.
        self.place: dict[str, int] = {"": 0}
        self.pool = np.zeros(0, dtype=self.dtype)
        self.sizes = np.zeros(1, dtype=np.int64)

    def _add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.place.update(zip(keys, range(len(self.sizes), len(self.sizes) + len(keys))))
        self.pool = np.concatenate((self.pool, ids))
        self.sizes = np.concatenate((self.sizes, sizes))

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Entry of every pre-token; new ones are encoded in one call."""
        coded = pieces.dictionary_encode()
        names = coded.dictionary.to_pylist()
        new = [x for x in names if x not in self.place]
        if new:
            done = self.plain.encode(new, is_pretokenized=True, add_special_tokens=False)
            self._add(new, np.array(done.ids, dtype=self.dtype),
                      np.bincount(np.array(done.word_ids, dtype=np.int64), minlength=len(new)))
        where = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))
        return where[coded.indices.to_numpy(zero_copy_only=False)]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one word after another, and the count of each."""
        if len(self.place) > MEMO_WORDS:
            self._forget()
        parts = pc.extract_regex(words, PLAIN)
        odd = pc.is_null(parts).to_numpy(zero_copy_only=False)
        head, tail = (pc.fill_null(pc.struct_field(parts, i), "") for i in (0, 1))
        first, second = self._places(pc.utf8_lower(head)), self._places(tail)
        if odd.any():
            texts = words.filter(pa.array(odd)).to_pylist()
            new = [x for x in texts if f" {x}" not in self.place]
            ids = [self.full.encode(x, add_special_tokens=False).ids for x in new]
            self._add([f" {x}" for x in new], np.array([i for x in ids for i in x], self.dtype),
                      np.array([len(x) for x in ids], dtype=np.int64))
            first[odd] = [self.place[f" {x}"] for x in texts]
            second[odd] = 0
        starts = np.cumsum(self.sizes) - self.sizes
        both = np.stack((first, second), axis=1).ravel()
        return (self.pool[_gather(starts[both], self.sizes[both])],
                self.sizes[first] + self.sizes[second])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's ids end."""
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten().dictionary_encode()
        ids, sizes = self._words(flat.dictionary)
        starts = np.cumsum(sizes) - sizes
        use = flat.indices.to_numpy(zero_copy_only=False)
        n = sizes[use]
        word_end = np.concatenate(([0], np.cumsum(n)))
        per_text = np.diff(split.offsets.to_numpy())
        return ids[_gather(starts[use], n)], word_end[np.cumsum(per_text)]


def _slices(batch: pa.RecordBatch, column: str, slice_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    size = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, before + slice_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _open(folder: str):
    """File system and path of a folder; an address such as ``hdfs://`` names its own."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def write_records(docs: DataFrame, folder: str, tokenizer: str, *, end_id: int,
                  files: int | None = None, ordered: bool = True) -> list[tuple[int, int, int]]:
    """Encode ``docs(doc_id, text)`` and write them in order of ``doc_id``, or, with
    ``ordered`` false, as they come (a file per partition), say after a shuffle.

    Returns ``(file, documents, ids)`` for each file, in order: one short row per
    file is all that reaches the driver."""
    def write(batches):
        part, own = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, root = _open(folder)
        final = f"{root}/part-{part:06d}"
        encoder = index = data = None
        n_docs = n_ids = at = 0
        for batch in batches:
            for piece in _slices(batch, "text", ENCODE_BYTES):
                if encoder is None:
                    encoder = per_worker(("encoder", tokenizer), lambda: WordEncoder(tokenizer))
                    fs.create_dir(root, recursive=True)
                    data = fs.open_output_stream(f"{final}.rec.{own}")
                    index = fs.open_output_stream(f"{final}.idx.{own}")
                ids, ends = encoder.encode(piece.column("text"))
                entries, start = np.zeros(piece.num_rows, dtype=INDEX), 0
                for i, (doc, end) in enumerate(zip(piece.column("doc_id").to_pylist(),
                                                   ends.tolist())):
                    null = doc is None
                    payload = b"".join((
                        struct.pack(BODY, encoder.dtype.itemsize, null, 0 if null else doc,
                                    end - start + 1),
                        ids[start:end].tobytes(), np.array([end_id], encoder.dtype).tobytes()))
                    record = frame(payload)
                    data.write(record)
                    entries[i] = (0 if null else doc, at, len(payload), null)
                    at += len(record)
                    n_ids += end - start + 1
                    start = end
                n_docs += piece.num_rows
                index.write(entries.tobytes())
        if data is not None:
            for stream, kind in ((data, "rec"), (index, "idx")):
                stream.close()
                fs.move(f"{final}.{kind}.{own}", f"{final}.{kind}")
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                              "docs": pa.array([n_docs], pa.int64()),
                                              "ids": pa.array([n_ids], pa.int64())})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       whole(F.col("text")).alias("text"))
    if ordered:
        rows = (rows.repartitionByRange(files or partitions(docs.sparkSession), "doc_id")
                .sortWithinPartitions("doc_id", F.xxhash64("text")))
    done = rows.mapInArrow(gives_back(write), "part int, docs bigint, ids bigint").collect()
    return sorted((r["part"], r["docs"], r["ids"]) for r in done)


def _frames(stream) -> Iterator[bytes]:
    """Payloads of a data file; a broken frame raises ``ValueError``."""
    while head := stream.read(HEAD_SIZE):
        if len(head) < HEAD_SIZE:
            raise ValueError("file ends inside a record head")
        size, check = struct.unpack(HEAD, head)
        if masked(head[:8]) != check:
            raise ValueError("checksum of a record length differs")
        body = stream.read(size + 4)
        if len(body) < size + 4 or masked(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
            raise ValueError("checksum of a record differs")
        yield body[:-4]


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    width, null, doc, n = struct.unpack_from(BODY, payload)
    return (None if null else doc), np.frombuffer(payload, f"<u{width}", n, BODY_SIZE)


def read_records(spark: SparkSession, folder: str, files: list[tuple[int, int, int]]) -> DataFrame:
    """One row per record: ``doc_id``, ``start`` (ids before it), ``n_tokens``, and
    the crc32 of its ids as unsigned 32-bit integers.  Checksums are verified."""
    bases, total = [], 0
    for part, _, ids in files:
        bases.append((part, total))
        total += ids

    def read(frames):
        for pdf in frames:
            for part, base in zip(pdf["part"], pdf["base"]):
                fs, root = _open(folder)
                docs, starts, sizes, checks = [], [], [], []
                at = int(base)
                with fs.open_input_stream(f"{root}/part-{part:06d}.rec", buffer_size=1 << 20) as f:
                    for payload in _frames(f):
                        doc, ids = parse(payload)
                        docs.append(doc)
                        starts.append(at)
                        sizes.append(len(ids))
                        checks.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        at += len(ids)
                yield pd.DataFrame({"doc_id": pd.array(docs, dtype="Int64"), "start": starts,
                                    "n_tokens": sizes, "ids_crc32": checks})

    plan = spark.createDataFrame(bases, "part int, base bigint")
    return (plan.repartition(max(1, len(bases)))
            .mapInPandas(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def read_index(folder: str, part: int) -> np.ndarray:
    fs, root = _open(folder)
    with fs.open_input_stream(f"{root}/part-{part:06d}.idx") as f:
        return np.frombuffer(f.read(), dtype=INDEX)


def read_at(folder: str, part: int, entries: np.ndarray) -> Iterator[tuple[int | None, np.ndarray]]:
    """Records in the order of the given index entries, one read each."""
    fs, root = _open(folder)
    with fs.open_input_file(f"{root}/part-{part:06d}.rec") as f:
        for e in entries:
            body = f.read_at(int(e["length"]) + 4, int(e["offset"]) + HEAD_SIZE)
            if masked(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
                raise ValueError("checksum of a record differs")
            yield parse(body[:-4])


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, *, end_id: int,
                     folder: str | None = None, ordered: bool = True) -> DataFrame:
    """Write the records of ``docs`` below the shared folder and read them back."""
    folder = folder or shared_path(spark, "records")
    return read_records(spark, folder, write_records(docs, folder, tokenizer, end_id=end_id, ordered=ordered))


ships_by_value(__name__)
