"""Files of token ids: documents in ascending doc_id order, ids in coded blocks, an index of documents.

A file holds the documents of one range of ids: ``MAGIC``, blocks (see ``range_coder``), an index of
(doc_id, number of ids), and a footer with the index's place and checksum.  A document
may run over blocks.  Files are numbered in the order of their ranges, so a document's place in the
whole stream is the ids of all earlier files plus its place in its own.

Ids come from the tokenizers library; every document ends with ``END``.  The library encodes each
blank or line end with the word after it once, as pieces never go on from a non-space into
white space; texts with runs of white space or added tokens go to it whole.  Texts are cut, their units
numbered and their ids put together as arrays; only units that are new to a worker become Python strings.

Rows: a null text counts as empty and has the end id only.  Rows with a null doc_id come first.  Rows with
equal doc_ids stay separate, in the order of their texts.  Further columns aren't read.
No documents give no files, and an empty table when read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .range_coder import HEAD, block_size, decode_block, encode_block
from .shared_files import Output, source

MAGIC = b"AMTOKEN1"
BLOCK = 1 << 21          # ids of a block
END = 0                  # after each document
TEXT_BYTES = 20 << 20    # of texts encoded together, but for longer ones
JOINED = 30              # new units that the library encodes as one text
CACHE_ENTRIES = 1_000_000  # units a worker remembers before it drops all but the half used most
CACHE_BYTES = 64 << 20     # of these units and their ids
SPACE_RUN = r"[\s\x0b\x1c-\x1f\x85\pZ]{2}"  # white space next to white space, as Arrow writes it
FOOTER = "<QQI8s"        # index offset, documents, CRC-32 of the index
NO_ID = -(1 << 63)       # stands for a null doc_id in the index


class Encoder:
    """The tokenizers library with a memory of units."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if self.library.truncation or self.library.padding:
            raise ValueError(f"{path}: truncation or padding is set")
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocab.values()) + 1, bool)   # tokens that start with a blank or a line end
        self.opens[[i for token, i in vocab.items() if token[:1] in ("\u0120", "\u010a")]] = True
        self._remember(pa.array([], pa.string()), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64))

    def _remember(self, units: pa.Array, ids: np.ndarray, sizes: np.ndarray, uses: np.ndarray) -> None:
        """Units, their ids one after another, how many each has, and how often it was used."""
        self.units, self.ids, self.sizes, self.uses = units, ids, sizes, uses

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: pa.Array) -> np.ndarray:
        """Whether texts can't be cut at blanks and line ends."""
        whole = pc.match_substring_regex(texts, SPACE_RUN)
        for token in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        return whole.to_numpy(zero_copy_only=False)

    def _encode_new(self, units: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids, and how many each unit has; units that can stand side by side go to the library as one text."""
        units = [u if u[:1] == "\n" else " " + u for u in units]
        joined = ["".join(units[at:at + JOINED]) for at in range(0, len(units), JOINED)]
        ids, sizes = [], []
        for k, (whole, found) in enumerate(zip(self._whole(pa.array(joined, pa.string())), self._library(joined), strict=True)):
            if whole:
                alone = self._library(units[k * JOINED:(k + 1) * JOINED])
                ids += alone
                sizes.append(np.array([len(x) for x in alone]))
            else:
                ids.append(found)
                sizes.append(np.diff(np.flatnonzero(self.opens[found]), append=len(found)))
        return ids, sizes

    def _learn(self, units: pa.Array) -> np.ndarray:
        """Numbers of units in the memory, which takes in the new ones."""
        if not len(units):
            return np.empty(0, np.int64)
        n = len(self.units)
        coded = pa.chunked_array([self.units, units]).dictionary_encode().chunks[-1]
        known, codes = coded.dictionary, coded.indices.to_numpy()
        ids, sizes = self._encode_new(known[n:].to_pylist())
        uses = np.bincount(codes, minlength=len(known))
        uses[:n] += self.uses
        self._remember(known, np.concatenate([self.ids, *ids]), np.concatenate([self.sizes, *sizes]), uses)
        if len(self.sizes) != len(known):
            raise ValueError("the library's ids don't show where its words begin")
        return codes

    def _forget(self) -> None:
        """Drop all but the units used most, if there are too many."""
        size = np.diff(np.frombuffer(self.units.buffers()[1], np.int32, len(self.units) + 1, 4 * self.units.offset)) + 4 * self.sizes + 20
        if len(size) <= CACHE_ENTRIES and size.sum() <= CACHE_BYTES:
            return
        order = np.argsort(-self.uses, kind="stable")[:CACHE_ENTRIES // 2]
        kept = np.sort(order[np.cumsum(size[order]) <= CACHE_BYTES // 2])
        self._remember(self.units.take(pa.array(kept)), _stretches(self.ids, np.cumsum(self.sizes) - self.sizes, self.sizes, kept),
                       self.sizes[kept], self.uses[kept] >> 1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after another, each text with END, and how many each has."""
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        whole = self._whole(texts)
        cut = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~whole)), "\n", " \n"), " ")
        units = cut.flatten()
        first = np.zeros(len(units), bool)
        further = cut.value_lengths().to_numpy().astype(np.int64) - 1
        first[np.cumsum(further + 1) - further - 1] = True
        codes = self._learn(units.filter(pa.array(~first)))
        # what each text begins with, or all of it, and END stand behind the memory
        begin = np.empty(len(texts), object)
        begin[whole] = texts.filter(pa.array(whole)).to_pylist()
        begin[~whole] = units.filter(pa.array(first)).to_pylist()
        begun = self._library(begin.tolist())
        del cut, units, first
        sizes = np.concatenate([self.sizes, [len(x) for x in begun], [1]])
        ids = np.concatenate([self.ids, *begun, np.array([END], np.uint32)])
        n = np.full(len(texts), 2)
        n[~whole] += further
        last = np.cumsum(n) - 1
        order, inner = np.empty(int(n.sum()), np.int32), np.ones(int(n.sum()), bool)
        order[last], inner[last] = len(sizes) - 1, False
        order[last - n + 1], inner[last - n + 1] = len(self.sizes) + np.arange(len(texts)), False
        order[inner] = codes
        del codes, inner
        out = _stretches(ids, np.cumsum(sizes) - sizes, sizes, order)
        self._forget()
        return out, np.add.reduceat(sizes[order], last - n + 1)


def _stretches(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Stretches of ``ids`` in some order, one after another."""
    out, done = np.empty(int(sizes[order].sum()), ids.dtype), 0
    for lo in range(0, len(order), 1 << 16):
        some = order[lo:lo + (1 << 16)]
        size = sizes[some]
        at = np.repeat(starts[some] - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        out[done:done + len(at)] = ids[at]
        done += len(at)
    return out


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about equal bytes of text, TEXT_BYTES at most, or a single row."""
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy().astype(np.int64))
    share = -(-int(ends[-1]) // -(-int(ends[-1]) // TEXT_BYTES)) if len(ends) and ends[-1] else 1
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + share, "right")))
        yield batch.slice(at, to - at)
        at = to


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str) -> DataFrame:
    """Write the files; return the written manifest: part, file, n_docs, n_ids, base (ids of earlier files)."""
    spark = docs.sparkSession
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out = encoder(tokenizer_path).encode, None
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}.tok"
        names, counts, held, waiting, total = [], [], [], 0, 0

        def flush(last: bool) -> None:
            nonlocal held, waiting
            ids = np.concatenate(held) if held else np.empty(0, np.uint32)
            full = len(ids) if last else len(ids) // BLOCK * BLOCK
            for at in range(0, full, BLOCK):
                out.write(encode_block(ids[at:min(at + BLOCK, full)]))
            held, waiting = [ids[full:].copy()], len(ids) - full

        for batch in batches:
            for piece in _pieces(batch):
                if out is None:
                    out = Output(folder, name).__enter__()
                    out.write(MAGIC)
                names.append(piece["doc_id"].fill_null(NO_ID).to_numpy())
                ids, n = encode(piece["text"].cast(pa.string()))
                held.append(ids)
                counts.append(n)
                waiting += len(ids)
                total += len(ids)
                if waiting >= BLOCK:
                    flush(False)
        if out is None:
            return
        flush(True)
        lengths = np.concatenate(counts)
        index = np.concatenate(names).astype("<i8").tobytes() + lengths.astype("<i8").tobytes()
        place = out.size
        out.write(index)
        out.write(struct.pack(FOOTER, place, len(lengths), zlib.crc32(index), MAGIC))
        out.__exit__(None, None, None)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "file": [name],
                                          "n_docs": pa.array([len(lengths)], pa.int64()), "n_ids": pa.array([total], pa.int64())})

    parts = scratch_path(spark, "token-parts")
    schema = "part bigint, file string, n_docs bigint, n_ids bigint"
    ordered.mapInArrow(write, schema).write.parquet(parts)
    # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(schema).parquet(parts).withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document; ids are packed little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with source(folder, row["file"]) as f:
                    yield from _documents(f, row["base"])

    n = max(1, manifest.count())
    return manifest.repartitionByRange(n, "part").mapInArrow(read, "doc_id bigint, start bigint, ids binary")


def _documents(f, base: int) -> Iterator[pa.RecordBatch]:  # noqa: ANN001 - a file opened for random access
    size = f.size()
    f.seek(size - struct.calcsize(FOOTER))
    place, n, check, magic = struct.unpack(FOOTER, f.read(struct.calcsize(FOOTER)))
    f.seek(place)
    index = f.read(16 * n)
    f.seek(0)
    if f.read(len(MAGIC)) != MAGIC or magic != MAGIC or zlib.crc32(index) != check:
        raise ValueError("not a complete token file")
    names, counts = np.frombuffer(index, "<i8", n), np.frombuffer(index, "<i8", n, 8 * n)
    starts = np.cumsum(counts) - counts
    rest, done = b"", 0
    while done < n:
        parts = [rest]
        if f.tell() < place:
            head = f.read(HEAD.size)
            parts.append(decode_block(head, f.read(block_size(head))).tobytes())
        data = b"".join(parts)
        last = done + int(np.searchsorted(np.cumsum(counts[done:]), len(data) // 4, "right"))
        if last == done and f.tell() >= place:
            raise ValueError("a token file ends within a document")
        at = np.concatenate([[0], np.cumsum(counts[done:last])]) * 4
        for lo in range(done, last, 4096):
            hi = min(lo + 4096, last)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(names[lo:hi], pa.int64(), mask=names[lo:hi] == NO_ID),
                "start": pa.array(base + starts[lo:hi], pa.int64()),
                "ids": pa.array([data[at[i - done]:at[i - done + 1]] for i in range(lo, hi)], pa.binary())})
        rest, done = data[at[-1]:], last


def token_file_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write, read back, and return each document's place, length and checksum."""
    spark: SparkSession = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    back = read_tokens(write_tokens(docs, folder, tokenizer_path), folder)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))
