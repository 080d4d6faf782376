"""Token ids in one concatenated array, with Elias-Fano encoded document boundaries.

The corpus is sorted by id and written as containers: rows ``(part, seq, ids, bounds, doc_ids)`` of a table that any
store of Spark can hold. ``ids`` are the ids of whole documents one after the other, two bytes each when the
vocabulary allows it. ``bounds`` holds the ends of the documents and ``doc_ids`` their ids, both as Elias-Fano
sequences: about 2 bits and the logarithm of the mean gap for each, and a select returns any one of them without
unpacking the rest. Containers are ordered by (part, seq), and their offsets are running totals of a small table.

Defined cases. NULL and empty texts hold the end id alone. NULL ids come first. Rows that repeat an id are documents
of their own, in the order of their texts. An empty input gives no containers. Special tokens spelled out in a text
are treated as the tokenizer treats them. Further columns of the input are not looked at.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable
from operator import attrgetter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import strings, text_batches

CONTAINER_IDS = 1 << 21
PART_BYTES = 16 << 20
CACHED_PIECES = 400_000
KEPT_LETTERS = 64  # a longer piece is made each time, which bounds the memory of pieces in bytes
END_ID = 2
TOKEN_ID = attrgetter("id")
SAMPLE = 64  # a select starts at the nearest sampled one bit


class EliasFano:
    """A sequence of rising whole numbers from 0 on: low bits packed, high bits in unary, every 64th one sampled."""

    HEAD = "<QQB"

    def __init__(self, data: bytes):
        self.n, self.top, self.low_bits = struct.unpack_from(self.HEAD, data)
        at = struct.calcsize(self.HEAD)
        low_bytes = (self.n * self.low_bits + 7) // 8
        high_bits = self.n + (self.top >> self.low_bits) + 1 if self.n else 0
        self.low = np.frombuffer(data, np.uint8, low_bytes, at)
        self.high = np.frombuffer(data, np.uint8, (high_bits + 7) // 8, at + low_bytes)
        self.samples = np.frombuffer(data, "<u4", (self.n + SAMPLE - 1) // SAMPLE, at + low_bytes + len(self.high))

    @classmethod
    def encode(cls, values) -> bytes:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return struct.pack(cls.HEAD, 0, 0, 0)
        if (values[1:] < values[:-1]).any():
            raise ValueError("the numbers must not fall")
        top = int(values[-1])
        width = max(0, (top // n).bit_length() - 1) if top >= n else 0
        low = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(n + (top >> width) + 1, np.uint8)
        high[places] = 1
        samples = places[::SAMPLE].astype("<u4")
        packed = [np.packbits(x.ravel(), bitorder="little").tobytes() for x in (low, high)]
        return b"".join([struct.pack(cls.HEAD, n, top, width), *packed, samples.tobytes()])

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Number i, from the sample before it on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = place // 8, place % 8
        word = int(self.high[byte]) & (0xFF << skip) & 0xFF
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        low = 0
        for bit in range(self.low_bits):
            at = i * self.low_bits + bit
            low |= (int(self.low[at // 8]) >> (at % 8) & 1) << bit
        return ((place - i) << self.low_bits) | low

    def all(self) -> np.ndarray:
        """All numbers."""
        if not self.n:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return ((ones - np.arange(self.n)) << self.low_bits) | low


def byte_letters() -> dict[int, str]:
    """The letters that a byte-level vocabulary writes bytes with: visible ones as themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in shown]
    return {**{x: chr(x) for x in shown}, **{x: chr(256 + i) for i, x in enumerate(hidden)}}


class Pieces(dict):
    """Ids of pieces as bytes; a missing piece is made, and kept unless it is long.

    What is kept has two halves. When the newer one is full the older one goes, so a piece that is used again stays.
    """

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= KEPT_LETTERS:
            self[piece] = ids
        return ids

    def bound(self, limit: int) -> None:
        if len(self) > limit // 2:
            self.older = dict(self)
            self.clear()


class PieceEncoder:
    """Ids of texts as bytes, by the tokenizer and a bounded memory of pieces.

    A byte-level vocabulary cuts a text before a space that a visible character follows, whatever stands before it.
    So the pieces between such spaces are encoded once each, and a text is the sequence of its pieces. Words of
    letters go to the tokenizer's model at once; all else goes through the whole tokenizer.
    """

    CUT = re.compile(r" (?=\S)")
    ODD = re.compile(r" (?!\S)")
    LINE = re.compile(r"(?<=\S)\n(?=\S)")
    MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII without the apostrophe, which may begin a contraction

    def __init__(self, path: str, end_id: int = END_ID, limit: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.limit = self.tokenizer.model, byte_letters(), limit
        self.code = "H" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "I"
        self.id_bytes, self.end = array(self.code).itemsize, array(self.code, [end_id]).tobytes()
        added = {t.content[-1:] for t in self.tokenizer.get_added_tokens_decoder().values()}  # they are found across cuts
        self.marks, self.space = "".join(x for x in self.MARKS if x not in added), self.letters[ord(" ")]
        self.known = Pieces(lambda x: self._make(x, True))  # pieces after a space, without it
        self.bare = Pieces(lambda x: self._make(x, False))  # pieces that no space precedes

    @classmethod
    def of_process(cls, path: str, end_id: int) -> PieceEncoder:
        """One for each worker process, so that a task finds what the tasks before it have learned."""
        import tokenizers

        kept = vars(tokenizers).setdefault("_piece_encoders", {})
        if (path, end_id) not in kept:
            kept[path, end_id] = cls(path, end_id)
        return kept[path, end_id]

    def _make(self, piece: str, spaced: bool) -> bytes:
        """A piece is cut further where a cut is certain: around lone line breaks, between letters and the marks that end it."""
        narrow = piece.isascii()
        plain = narrow or max(piece) < "ɐ"
        if plain and piece.isalpha():
            letters = piece if narrow else piece.encode().decode("latin-1").translate(self.letters)
            return self._ids(map(TOKEN_ID, self.model.tokenize(self.space + letters if spaced else letters)))
        if "\n" in piece:
            lines = self.LINE.split(piece)
            if len(lines) > 1:
                first = (self.known if spaced else self.bare)[lines[0]]
                return self.bare["\n"].join([first, *map(self.bare.__getitem__, lines[1:])])
        if plain:
            stem = piece.rstrip(self.marks)
            if len(stem) < len(piece) and stem.isalpha():
                return (self.known if spaced else self.bare)[stem] + self.bare[piece[len(stem):]]
        return self._ids(self.tokenizer.encode(" " + piece if spaced else piece, add_special_tokens=False).ids)

    def _ids(self, ids: Iterable[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        self.known.bound(self.limit)
        self.bare.bound(self.limit)
        for text in texts:
            pieces = self.CUT.split(text) if self.ODD.search(text) else text.split(" ")
            first = self.bare[pieces.pop(0)]
            out.append(b"".join([first, *map(self.known.__getitem__, pieces), self.end]))
        return out


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the containers of ``docs`` below ``path``, in ascending order of ids.

    ``tokenizer`` is a file that every machine has, or that the job's files carry, for the tokenizers library.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    rows = rows.repartitionByRange(max(1, size // PART_BYTES), "doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    rows = rows.sortWithinPartitions("doc_id", "text").select(F.col("doc_id").cast("string"), "text")

    def run(batches):
        encoder, part, seq = PieceEncoder.of_process(tokenizer, end_id), TaskContext.get().partitionId(), 0
        names, blobs, held = [], [], 0

        def container():
            ends = np.cumsum([len(b) // encoder.id_bytes for b in blobs])
            some = np.array([int(x) for x in names if x is not None], np.int64)
            base = int(some[0]) if len(some) else 0
            return pd.DataFrame({
                "part": [part], "seq": [seq], "n_docs": [len(blobs)], "n_ids": [int(ends[-1])],
                "id_bytes": [encoder.id_bytes], "n_null": [len(names) - len(some)], "first_id": [base],
                "doc_ids": [EliasFano.encode((some - base).astype(np.uint64))], "bounds": [EliasFano.encode(ends)],
                "ids": [b"".join(blobs)],
            })

        for batch in batches:
            for at in range(0, len(batch), 256):
                texts = [t or "" for t in strings(batch["text"].iloc[at:at + 256])]
                for name, blob in zip(strings(batch["doc_id"].iloc[at:at + 256]), encoder.encode(texts)):
                    names.append(name)
                    blobs.append(blob)
                    held += len(blob) // encoder.id_bytes
                    if held >= CONTAINER_IDS:
                        yield container()
                        names, blobs, held, seq = [], [], 0, seq + 1
        if blobs:
            yield container()

    made = rows.mapInPandas(
        run,
        "part int, seq int, n_docs long, n_ids long, id_bytes int, n_null long, first_id long, doc_ids binary, "
        "bounds binary, ids binary",
    )
    with text_batches(docs.sparkSession):
        made.write.parquet(path)


def container_documents(row) -> Iterable[tuple[int | None, np.ndarray, int]]:
    """(doc_id, ids, start within the container) of each document of one container."""
    ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}")
    ends = EliasFano(row["bounds"]).all()
    names = [None] * int(row["n_null"]) + [int(row["first_id"] + x) for x in EliasFano(row["doc_ids"]).all()]
    start = 0
    for name, end in zip(names, ends):
        yield name, ids[start:end], start
        start = int(end)


def read_tokens(spark, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32 (of little-endian 32-bit ids)."""
    table = spark.read.parquet(path)

    def run(batches):
        for batch in batches:
            for row in batch.to_dict("records"):
                found = list(container_documents(row))
                yield pd.DataFrame({
                    "part": row["part"], "seq": row["seq"], "doc_id": [None if d is None else str(d) for d, _, _ in found],
                    "local": [s for _, _, s in found], "n_tokens": [len(x) for _, x, _ in found],
                    "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for _, x, _ in found],
                })

    rows = table.mapInPandas(run, "part int, seq int, doc_id string, local long, n_tokens long, ids_crc32 long")
    sizes = table.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    starts = sizes.withColumn("within", within).join(before, "part").select("part", "seq", (F.col("before") + F.col("within")).alias("base"))
    return rows.join(starts, ["part", "seq"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )
