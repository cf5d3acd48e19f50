"""Token ids of documents in flat binary files that training code memory-maps.

Documents are ordered by id and dealt to parts by range. A part is three files: ``.ids``, the token ids as
flat unsigned little-endian integers, ``.ends``, the 64-bit end of each document counted from the part's
start, and ``.docs``, the 64-bit document ids (null ids come first; the index counts them). The index
file holds per part the documents and tokens before it, prefix sums of the parts' sizes, so that part
files never change and a document's global offset is its part's base plus its local one.

A task writes its part under a name of its own and reports the name as a row. The rows go through
Spark's output committer, so files of lost, repeated or speculative attempts are never named by the index.
"""

from __future__ import annotations

import os
import re
import struct
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut, numbered, shared_dir, table, whole_text

TOKENIZER, END = "word_bpe_49k.json", 1
#: Bytes of text of a part on average, where the session's shuffle partitions don't ask for smaller ones.
PART_BYTES = 1 << 26
#: Bytes that are encoded together; a longer text is cut at ASCII white space, which this tokenizer drops.
GROUP_BYTES = 1 << 22
#: Words that a task remembers with their ids, and the longest of them in bytes.
HELD_WORDS, HELD_BYTES = 500_000, 64
#: Tokens that are written or returned at once; a longer document goes alone.
BATCH_TOKENS = 1 << 20

MAGIC, INDEX = b"TOKFILE1", "index.bin"
HEAD = struct.Struct("<8sII")
PART = np.dtype([("name", "S32"), ("first_doc", "<i8"), ("first_token", "<i8"), ("docs", "<i8"), ("tokens", "<i8"), ("null_ids", "<i8")])

_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")
#: ASCII signs that end a word as one run; the apostrophe may begin a contraction and is none of them.
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def id_type(path: str, end_id: int) -> np.dtype:
    """The narrowest file type that holds every id."""
    return np.dtype("<u2" if max(_tokenizer(path).get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else "<u4")


class Encoder:
    """Bytes of the ids of texts in UTF-8.

    The tokenizer drops white space before its merges, so a text's ids are those of its words in turn;
    words are remembered. Letters and the signs after them are merged apart, so a word of letters and signs is
    the two in turn; new ones are encoded many at once, told apart by the tokens that end a run. All
    other words are encoded on their own.
    """

    def __init__(self, path: str, kind: np.dtype):
        self.tokenizer, self.kind = _tokenizer(path), kind
        #: Words and runs with their ids: what was met lately, and what was met before that.
        self.held, self.older, self.runs, self.older_runs = {}, {}, {}, {}
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)

    def _alone(self, words: list[str]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
            yield np.array(e.ids, self.kind).tobytes()

    def _learn_runs(self, runs: list[str]) -> None:
        """Ids of runs of letters or of signs, each of which ends in one token that ends a run."""
        for i in range(0, len(runs), 2000):
            some = runs[i : i + 2000]
            [encoded] = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(encoded.ids, np.int64)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):
                self.runs.update(zip(some, self._alone(some)))
                continue
            raw, at = ids.astype(self.kind).tobytes(), (ends * self.kind.itemsize).tolist()
            self.runs.update(zip(some, [raw[a:b] for a, b in zip([0, *at], at)]))

    def _learn(self, words: list[bytes]) -> None:
        letters = [w.rstrip(_SIGNS) for w in words]
        bodies = [b.lower().decode() for b in letters]  # bytes: A-Z only
        # letters that every version of Unicode tables agrees on
        plain = [b.isalpha() and (b.isascii() or max(b) < "\u0370") for b in bodies]
        signs = [w[len(b) :].decode() if len(b) < len(w) else "" for w, b in zip(words, letters)]
        wanted = {*compress(bodies, plain), *compress(signs, plain)} - {""}
        self._learn_runs(_recall(list(wanted.difference(self.runs)), self.older_runs, self.runs))
        runs = self.runs
        self.held.update([(w, runs[b] + runs[s] if s else runs[b]) for w, b, s, p in zip(words, bodies, signs, plain) if p])
        others = [w for w, p in zip(words, plain) if not p]
        self.held.update(zip(others, self._alone([w.decode() for w in others])))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has. Only distinct words are looked up one by one."""
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        new = [w for w in distinct if w not in self.held]
        self._learn(_recall(new, self.older, self.held))
        ids = pa.array([self.held[w] for w in distinct], pa.binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1)
        flat = np.frombuffer(ids.buffers()[2] or b"", self.kind, int(ends[-1]) // self.kind.itemsize)
        for w in new:
            if len(w) > HELD_BYTES:
                del self.held[w]
        if len(self.held) > HELD_WORDS:
            self.held, self.older = {}, self.held
        if len(self.runs) > HELD_WORDS:
            self.runs, self.older_runs = {}, self.runs
        at = np.asarray(words.offsets) - words.offsets[0].as_py()
        return flat, np.diff(ends[at]) // self.kind.itemsize

    def groups(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for a few texts at a time, in order; a long text goes alone, in pieces."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        first = 0
        while first < len(texts):
            if sizes[first] > GROUP_BYTES:
                parts = [self.encode(pa.array([p], pa.string()))[0] for p in pieces(texts[first].as_py())]
                flat = np.concatenate(parts)
                yield flat, np.array([len(flat)])
                first += 1
                continue
            last, size = first, 0
            while last < len(texts) and sizes[last] <= GROUP_BYTES and (last == first or size + sizes[last] <= GROUP_BYTES):
                size += sizes[last]
                last += 1
            yield self.encode(texts.slice(first, last - first))
            first = last


def _recall(wanted: list, older: dict, held: dict) -> list:
    """Takes what ``older`` knows of ``wanted`` over into ``held``; returns the rest."""
    known = [w for w in wanted if w in older]
    held.update((w, older[w]) for w in known)
    return [w for w in wanted if w not in older] if known else wanted


@cache
def _encoder(path: str, kind: np.dtype) -> Encoder:
    """One per Python worker, so that the tasks it runs share what was learnt."""
    return Encoder(path, kind)


def pieces(text: str, size: int | None = None) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that end before white space; a run without any stays whole."""
    start, size = 0, size or GROUP_BYTES
    while start < len(text):
        gap = _SPACE.search(text, start + size)
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


def _encoded(batches: Iterator[pa.RecordBatch], path: str, kind: np.dtype, end_id: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc ids, their ids in a row with the end ids, how many each has) for the rows of the batches, in order."""
    encoder = _encoder(path, kind)
    for batch in batches:
        at = 0
        for flat, lengths in encoder.groups(batch["text"]):
            ids = np.insert(flat, np.cumsum(lengths), end_id)
            yield batch["doc_id"].slice(at, len(lengths)), ids, lengths + 1
            at += len(lengths)


def _place(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    files, path = pyarrow.fs.FileSystem.from_uri(folder)
    return files, path.rstrip("/")


def _write_part(folder: str, part: int, kind: np.dtype, encoded: Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    files, path = _place(folder)
    name, docs, tokens, nulls = uuid.uuid4().hex, 0, 0, 0
    streams: dict[str, pa.NativeFile] = {}
    for doc_ids, ids, lengths in encoded:
        if not streams:
            streams = {suffix: files.open_output_stream(f"{path}/{name}.{suffix}") for suffix in ("ids", "ends", "docs")}
        ends = tokens + np.cumsum(lengths, dtype=np.int64)
        streams["ids"].write(ids.astype(kind, copy=False).tobytes())
        streams["ends"].write(ends.astype("<i8").tobytes())
        streams["docs"].write(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        docs, tokens, nulls = docs + len(lengths), int(ends[-1]), nulls + doc_ids.null_count
    for stream in streams.values():
        stream.close()
    if docs:
        row = {"part": [part], "name": [name], "docs": [docs], "tokens": [tokens], "null_ids": [nulls]}
        yield pa.RecordBatch.from_pydict(row)


@dataclass(frozen=True)
class TokenFiles:
    """An index that has been read: the file type and the parts in order."""

    folder: str
    kind: np.dtype
    parts: np.ndarray

    @classmethod
    def open(cls, folder: str) -> TokenFiles:
        files, path = _place(folder)
        with files.open_input_stream(f"{path}/{INDEX}") as f:
            data = f.read()
        magic, width, n = HEAD.unpack_from(data)
        if magic != MAGIC or len(data) != HEAD.size + n * PART.itemsize:
            raise ValueError(f"{folder}/{INDEX} is no whole index of token files")
        return cls(folder, np.dtype(f"<u{width}"), np.frombuffer(data, PART, n, HEAD.size))

    def save(self) -> None:
        files, path = _place(self.folder)
        with files.open_output_stream(f"{path}/{INDEX}") as f:
            f.write(HEAD.pack(MAGIC, self.kind.itemsize, len(self.parts)) + self.parts.tobytes())

    @property
    def docs(self) -> int:
        return int(self.parts["docs"].sum())

    @property
    def tokens(self) -> int:
        return int(self.parts["tokens"].sum())

    def document(self, i: int) -> tuple[int | None, int, np.ndarray]:
        """Document ``i`` in file order: its id, where its ids start, and the ids."""
        if not 0 <= i < self.docs:
            raise IndexError(i)
        part = self.parts[np.searchsorted(self.parts["first_doc"], i, "right") - 1]
        with MappedPart(self.folder, part, self.kind) as mapped:
            return mapped.document(i - int(part["first_doc"]))


class MappedPart:
    """One part, memory-mapped. Files of a store that can't be mapped are copied to a temporary folder first."""

    def __init__(self, folder: str, part: np.void, kind: np.dtype):
        self.folder, self.part, self.kind, self.copy = folder, part, kind, None

    def __enter__(self) -> MappedPart:
        files, path = _place(self.folder)
        name = self.part["name"].decode()
        if not isinstance(files, pyarrow.fs.LocalFileSystem):
            self.copy = tempfile.TemporaryDirectory()
            for suffix in ("ids", "ends", "docs"):
                pyarrow.fs.copy_files(f"{path}/{name}.{suffix}", f"{self.copy.name}/{name}.{suffix}", source_filesystem=files, destination_filesystem=pyarrow.fs.LocalFileSystem())
            path = self.copy.name
        self.ids, self.ends, self.doc_ids = (np.memmap(f"{path}/{name}.{suffix}", kind, "r") for suffix, kind in (("ids", self.kind), ("ends", "<i8"), ("docs", "<i8")))
        if len(self.ids) != self.part["tokens"] or len(self.ends) != self.part["docs"] or len(self.doc_ids) != self.part["docs"]:
            raise ValueError(f"part {name} isn't as long as the index says")
        return self

    def __exit__(self, *_) -> None:
        del self.ids, self.ends, self.doc_ids
        if self.copy:
            self.copy.cleanup()

    def document(self, i: int) -> tuple[int | None, int, np.ndarray]:
        start = int(self.ends[i - 1]) if i else 0
        doc_id = None if i < self.part["null_ids"] else int(self.doc_ids[i])
        return doc_id, int(self.part["first_token"]) + start, np.array(self.ids[start : int(self.ends[i])])


def write_token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = END, part_bytes: int = PART_BYTES, folder: str | None = None) -> TokenFiles:
    """Writes every row of ``docs`` (doc_id, text), in ascending order of the id, and returns the index.

    A null text is empty and has the end id alone; null ids come first. Rows with one id are ordered by
    their text's hash, and repeated rows stay. Very long texts are encoded in pieces and written whole, and
    other columns are ignored. An empty table gives an index without parts. ``folder`` (by default a new one in
    the session's shared folder) must be reachable by the driver and all executors. ``tokenizer``: path of
    a tokenizer file that drops white space, the same on every executor.
    """
    spark, path = docs.sparkSession, tokenizer or tokenizer_path()
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"
    files, place = _place(folder)
    files.create_dir(place, recursive=True)
    kind = id_type(path, end_id)
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text")))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
    # ties end in the row number, so that one id can't fill a part; it parts rows of one id and text only
    order = [F.col("doc_id").asc_nulls_first(), F.col("at"), F.col("rid")]
    dealt = rows.withColumn("at", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    write = lambda batches: _write_part(folder, TaskContext.get().partitionId(), kind, _encoded(batches, path, kind, end_id))
    written = cut(dealt.select("doc_id", "text").mapInArrow(write, "part long, name string, docs long, tokens long, null_ids long"))
    made = written.orderBy("part").collect()  # one row per part
    index = np.array([(r.name.encode(), 0, 0, r.docs, r.tokens, r.null_ids) for r in made], PART)
    index["first_doc"] = np.cumsum(index["docs"]) - index["docs"]
    index["first_token"] = np.cumsum(index["tokens"]) - index["tokens"]
    out = TokenFiles(folder, kind, index)
    out.save()
    return out


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (as little-endian 32-bit unsigned integers) from the mapped files, a task per part."""
    index = TokenFiles.open(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch["part"].to_pylist():
                with MappedPart(folder, index.parts[i], index.kind) as part:
                    yield from _documents(part)

    parts = spark.range(0, len(index.parts), 1, max(1, len(index.parts))).withColumnRenamed("id", "part")
    return parts.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _documents(part: MappedPart) -> Iterator[pa.RecordBatch]:
    ends = np.asarray(part.ends)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    first = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + BATCH_TOKENS, "right")))
        ids = part.ids[starts[first] : ends[last - 1]].astype("<u4").tobytes()
        offsets = np.concatenate([starts[first:last], ends[last - 1 : last]]) - starts[first]
        values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(ids)])
        doc_ids = pa.array(np.asarray(part.doc_ids[first:last]), mask=np.arange(first, last) < part.part["null_ids"])
        yield pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(starts[first:last] + int(part.part["first_token"])), pa.array((ends - starts)[first:last]), values.cast(pa.binary())],
            ["doc_id", "start", "n_tokens", "ids"],
        )
        first = last


def op13_flat_token_files(spark, sf_dir: str) -> DataFrame:
    files = write_token_files(table(spark, sf_dir, "documents"))
    return read_token_files(spark, files.folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
