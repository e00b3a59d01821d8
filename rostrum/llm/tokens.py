"""Token ids in Arrow files of fixed-size-list batches: zero-copy random access to equal-length sequences.

Documents are range-partitioned and sorted by id, and each partition is encoded and written as one Arrow
IPC file into a shared folder. A file holds one stream of ids (each document followed by the end id) cut
into sequences of ``length`` ids; the last sequence is padded, and ``mask`` is false on padding. Every
record batch but the last has ``batch_rows`` sequences, so sequence ``i`` is row ``i % batch_rows`` of batch
``i // batch_rows``: a memory-mapped file gives any sequence, or any document's ids, as a view without decoding.
Ids are stored in 16 bits where the vocabulary allows it, else in 32.

The written index (one row per document: file, place in the file's stream, number of ids) is what commits a
file. Names are unique to a task attempt, so a repeated or speculative task leaves at most an unlisted file.

Byte-level BPE encodes each piece of its split on its own, so the library is asked once per distinct piece
and the results are gathered; splitting and gathering run in Arrow kernels. Texts with characters outside
a plain set, or with special tokens, go to the library whole. Both ways give the same ids.

Defined results: null texts are empty and give the end id alone. Rows that share an id are ordered by a
hash of the text, so one id with many rows is spread like any others; null ids come first. An empty table
writes no file and gives an empty index. Texts of any length are encoded whole.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pfs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import new_path, stage


@dataclass(frozen=True)
class Encoding:
    #: Path of the tokenizer's JSON file, the same on every machine.
    tokenizer: str
    end_id: int = 2
    length: int = 2048
    batch_rows: int = 256
    #: Pieces remembered by a Python worker.
    remembered: int = 300_000


#: The byte-level split, as RE2 has it (runs of white space are cut beforehand), and texts that
#: must not be split here: unusual characters, whose classes may differ between regular expression libraries.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x00]+|\s+"
RUN = r"(\s+)(\s[^\s])"
PLAIN = r"^[\t\n\f\r -~¡-¬®-ɏЀ-џ‐-‧€]*$"


class Encoder:
    """Ids of many texts at a time, as one flat array and the number of ids of each text."""

    def __init__(self, spec: Encoding):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.spec = spec
        self.tool = Tokenizer.from_file(spec.tokenizer)
        self.kind = np.uint16 if self.tool.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self.special = [t.content for t in self.tool.get_added_tokens_decoder().values()]
        split = self.tool.pre_tokenizer
        self.by_piece = type(split).__name__ == "ByteLevel" and split.use_regex and not split.add_prefix_space and self.tool.normalizer is None
        if self.by_piece:
            self.unsplit = Tokenizer.from_file(spec.tokenizer)  # for texts that are single pieces
            self.unsplit.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.tool.encode(t, add_special_tokens=False).ids, self.kind) for t in texts]

    def pieces(self, values: list[str]) -> list[bytes]:
        """Ids of distinct pieces, remembered in two generations of bounded size."""
        young, old = self.young, self.old
        got = list(map(young.get, values))
        unknown = []
        for i, x in enumerate(got):
            if x is None:
                v = values[i]
                x = old.get(v)
                if x is None:
                    unknown.append(i)
                else:
                    young[v] = got[i] = x
        for k in range(0, len(unknown), 4096):
            some = unknown[k:k + 4096]
            found = self.unsplit.encode([values[i] for i in some], is_pretokenized=True, add_special_tokens=False)
            flat, width = np.array(found.ids, self.kind).tobytes(), np.dtype(self.kind).itemsize
            ends = (np.cumsum(np.bincount(found.word_ids, minlength=len(some))) * width).tolist()
            start = 0
            for i, end in zip(some, ends):
                young[values[i]] = got[i] = flat[start:end]
                start = end
        if len(young) > self.spec.remembered:
            self.old, self.young = young, {}
        return got

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        plain = pc.match_substring_regex(texts, PLAIN) if self.by_piece else pa.array([False] * len(texts))
        for s in self.special:
            plain = pc.and_(plain, pc.invert(pc.match_substring(texts, s)))
        split = pc.if_else(plain, texts, "")
        if pc.any(pc.match_substring_regex(split, r"\s\s")).as_py():
            split = pc.replace_substring_regex(split, RUN, r"\1" + "\0" + r"\2")
        lists = pc.split_pattern(pc.replace_substring_regex(split, SPLIT, r"\0" + "\0"), "\0")
        flat = lists.flatten().dictionary_encode()
        code = flat.indices.to_numpy(zero_copy_only=False)
        known = self.pieces(flat.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(known), self.kind)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // pool.itemsize
        starts = np.concatenate(([0], np.cumsum(sizes)))
        each = sizes[code]
        ends = np.cumsum(each)
        at = np.repeat((starts[code] - (ends - each)).astype(np.int32), each)  # both sums stay far below 2**31
        at += np.arange(len(at), dtype=np.int32)
        ids = pool[at]
        bounds = np.concatenate(([0], ends))[lists.offsets.to_numpy()]
        odd = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        if not len(odd):
            return ids, np.diff(bounds)
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for i, x in zip(odd.tolist(), self.whole(texts.take(pa.array(odd)).to_pylist())):
            parts[i] = x
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


_ENCODERS: dict[Encoding, Encoder] = {}


def _encoder(spec: Encoding) -> Encoder:
    """One per Python worker, so that pieces are remembered between tasks."""
    if spec not in _ENCODERS:
        _ENCODERS[spec] = Encoder(spec)
    return _ENCODERS[spec]


class ShardWriter:
    """One Arrow file of sequences; memory is bounded by one record batch."""

    def __init__(self, folder: str, name: str, spec: Encoding, kind: type):
        self.spec, self.uri = spec, f"{folder}/{name}"
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), spec.length)), ("mask", pa.list_(pa.bool_(), spec.length))])
        fs, path = pfs.FileSystem.from_uri(self.uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.sink = fs.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.left: list[np.ndarray] = []
        self.waiting = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.left.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        block = self.spec.length * self.spec.batch_rows
        if self.waiting >= block:
            ready = np.concatenate(self.left)
            whole = len(ready) // block * block
            for i in range(0, whole, block):
                self._write(ready[i:i + block], block)
            self.left, self.waiting = [ready[whole:]], len(ready) - whole

    def _write(self, ids: np.ndarray, used: int) -> None:
        n = self.spec.length
        mask = pa.array(np.arange(len(ids)) < used)
        self.writer.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids), n), pa.FixedSizeListArray.from_arrays(mask, n)],
                                                schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            rest = np.concatenate(self.left)
            self._write(np.pad(rest, (0, -len(rest) % self.spec.length)), len(rest))
        self.writer.close()
        self.sink.close()


class ShardReader:
    """Random access to a file's sequences, and to spans of its stream of ids, as views."""

    def __init__(self, uri: str, spec: Encoding):
        fs, path = pfs.FileSystem.from_uri(uri)
        self.source = pa.memory_map(path) if isinstance(fs, pfs.LocalFileSystem) else fs.open_input_file(path)
        self.file, self.spec, self.at, self.batch = pa.ipc.open_file(self.source), spec, -1, None

    def _batch(self, i: int) -> pa.RecordBatch:
        if i != self.at:
            self.at, self.batch = i, self.file.get_batch(i)
        return self.batch

    def sequence(self, i: int) -> tuple[pa.Array, pa.Array]:
        """Ids and mask of one sequence."""
        batch, row = self._batch(i // self.spec.batch_rows), i % self.spec.batch_rows
        return batch.column(0)[row].values, batch.column(1)[row].values

    def span(self, start: int, size: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
        """Views on ids and mask of ``size`` ids from ``start`` on; one for each record batch they lie in."""
        block = self.spec.length * self.spec.batch_rows
        while size:
            batch, off = self._batch(start // block), start % block
            take = min(size, block - off)
            yield batch.column(0).flatten()[off:off + take].to_numpy(), batch.column(1).flatten()[off:off + take]
            start, size = start + take, size - take

    def close(self) -> None:
        self.batch = self.file = None
        self.source.close()


INDEX = "doc_id long, tie long, file string, at long, n_tokens long"


def write(df: DataFrame, spec: Encoding, folder: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files and return their index ``(doc_id, tie, file, at, n_tokens)``.

    ``folder`` must be reachable from every executor; by default it lies in the shared checkpoint folder.
    """
    folder = folder or new_path(df.sparkSession, "token-files")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, out, name = _encoder(spec), None, ""
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                ids, sizes = tool.encode(part.column(2))
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, spec.end_id)
                if out is None:
                    name = f"shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.arrow"
                    out = ShardWriter(folder, name, spec, tool.kind)
                at = out.total + np.concatenate(([0], ends[:-1] + np.arange(1, len(ends))))
                out.add(ids)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([f"{folder}/{name}"] * part.num_rows),
                                                  pa.array(at.astype(np.int64)), pa.array(sizes + 1)], ["doc_id", "tie", "file", "at", "n_tokens"])
        if out is not None:
            out.close()

    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("tie"),
                     F.col(f"`{text}`").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return stage(ordered.mapInArrow(encode, INDEX), "token-index")


def starts(index: DataFrame) -> DataFrame:
    """``(file, base)``: ids in all earlier files. One row per file."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min(F.struct("doc_id", "tie", "at")).alias("first"))
    before = Window.partitionBy().orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def digests(index: DataFrame, spec: Encoding) -> DataFrame:
    """Read every document back from its file: ``(doc_id, start, n_tokens, ids_crc32, ends)``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, reader = None, None
        for batch in batches:
            n, crc, last = [], [], []
            for file, at, size in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if file != opened:
                    if reader:
                        reader.close()
                    opened, reader = file, ShardReader(file, spec)
                check, count, value = 0, 0, None
                for ids, mask in reader.span(at, size):
                    check = zlib.crc32(ids.astype("<u4"), check)
                    count += mask.true_count
                    value = int(ids[-1])
                n.append(count)
                crc.append(check)
                last.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                                              pa.array([x == spec.end_id for x in last])], ["doc_id", "file", "at", "n_tokens", "ids_crc32", "ends"])
        if reader:
            reader.close()

    found = index.select("doc_id", "file", "at", "n_tokens").mapInArrow(
        read, "doc_id long, file string, at long, n_tokens long, ids_crc32 long, ends boolean")
    base = stage(starts(index), "token-starts")
    return found.join(base, "file").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ends")
