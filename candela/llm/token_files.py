"""Token-id files: independent zstandard frames, a document index and a trailing seek table.

A file is a sequence of zstandard frames (RFC 8878), so any decoder reads it
whole; it follows the public seekable format, so a reader that wants a few
documents decompresses only their frames:

* data frames: a document's ids, little-endian, ``width`` bytes each. A frame
  holds ids of one document only; a document of more than ``FRAME_IDS`` ids has
  several frames;
* a skippable frame with the document index: version, width, number of
  documents, then arrays of document ids, of whether the id is null, and of
  numbers of ids, then the XXH64 of all that;
* a skippable frame with the seek table: compressed size, decompressed size and
  checksum (low half of XXH64 of the decompressed bytes) of every frame before.

``write`` lays documents out in ascending order of document id: one range
shuffle of the texts, then every task encodes its range and writes its files.
Files have names of their own; the returned table lists those of finished tasks,
so what a lost or repeated task left behind is never read. Null ids come last,
rows of one id by a hash of their text; rows that repeat are all written.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm import common

INDEX_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
VERSION = 1
#: Ids of a frame and of a file, at most; a document is in one file.
FRAME_IDS, FILE_IDS = 1 << 20, 1 << 25
#: Documents of a file, at most: what a reader holds of its index.
FILE_DOCS = 1 << 18
#: Words of up to so many signs whose ids are kept, and how many of them.
WORD_CHARS, WORDS = 48, 1 << 19
#: A word of letters that stay one piece, up to the punctuation after it.
LATIN = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-/:-@\[-`{-~]*)").fullmatch
#: Signs of a text that are cut into words at once.
STRETCH = 1 << 20
LEVEL = 3

FILES = "part int, seq int, path string, n_docs long, n_ids long, n_bytes long, low long, high long"


class Encoder:
    """Ids of texts by a public tokenizer file, with a bounded memory of words.

    The tokenizer splits at white space before anything else looks at the text
    (composition and lower-casing do not reach over it), so a text's ids are
    those of its words, and a word needs to be encoded once. Nor does a piece go
    on from a letter into punctuation, so of a Latin word and the punctuation
    after it each is encoded by itself. Such words, one piece each, are encoded
    many at a time: the last token of a piece tells that it is one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.known: dict[str, bytes] = {"": b""}
        self.plain: dict[str, bytes] = {}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]] = True

        # a file that treats white space or letters otherwise encodes texts whole
        probe = "It's a WORD, or Two...\nof Größe ÑAN 12 (x)! a.b  end. "
        self.by_word = bool(suffix) and self._stretch(probe) == self._ids([probe])[0]
        self.known, self.plain = {"": b""}, {}

    def _ids(self, words: Sequence[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(list(words), add_special_tokens=False)]

    def _plain(self, words: list[str]) -> dict[str, bytes]:
        """Ids of lower-case words of one piece; ASCII ones are as the model itself has them, byte for sign."""
        pack, split = struct.Struct, self.tokenizer.model.tokenize
        packs = [pack(f"<{n}{'H' if self.width == 2 else 'I'}").pack for n in range(WORD_CHARS + 1)]
        found, rest = {}, []
        for w in words:
            if w.isascii() and len(w) <= WORD_CHARS:
                ids = [t.id for t in split(w)]
                found[w] = packs[len(ids)](*ids)
            else:
                rest.append(w)
        if rest:
            found.update(zip(rest, self._many(rest)))
        return found

    def _many(self, words: list[str]) -> list[bytes]:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype=self.kind)
        ends = (np.flatnonzero(self.last[ids]) + 1) * self.width
        if len(ends) != len(words):
            return self._ids(words)
        raw, ends = ids.tobytes(), ends.tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that are not in memory."""
        if len(self.plain) > WORDS:
            self.plain = {}
        plain, split, other, cores, tails = self.plain, [], [], set(), set()
        for w in words:
            if m := LATIN(w):
                c, t = m.groups()
                c = c.lower()
                if c not in plain:
                    cores.add(c)
                if t and t not in plain:
                    tails.add(t)
                split.append((w, c, t))
            else:
                other.append(w)
        if cores:
            plain.update(self._plain(list(cores)))
        if tails:
            plain.update(zip(tails, self._ids(list(tails))))
        found = {w: plain[c] + plain[t] if t else plain[c] for w, c, t in split}
        if other:
            found.update(zip(other, self._ids(other)))
        return found

    def _stretch(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        parts = list(map(self.known.get, words))
        if None not in parts:
            return b"".join(parts)
        if len(self.known) > WORDS:
            self.known = {"": b""}
        new = set(compress(words, map(not_, parts)))
        new.discard("")
        found = self._learn(new)
        at = -1
        for _ in range(parts.count(None)):
            at = parts.index(None, at + 1)
            parts[at] = found[words[at]]
        if max(map(len, new)) > WORD_CHARS:
            found = {w: b for w, b in found.items() if len(w) <= WORD_CHARS}
        self.known.update(found)
        return b"".join(parts)

    def encode(self, text: str, end: int) -> bytes:
        """The ids of a text, then ``end``."""
        last = np.array([end], dtype=self.kind).tobytes()
        if not self.by_word:
            return self._ids([text])[0] + last
        parts, start = [], 0
        while start < len(text):
            at = text.find(" ", start + STRETCH)
            parts.append(self._stretch(text[start : at if at >= 0 else len(text)]))
            start = at if at >= 0 else len(text)
        return b"".join(parts) + last


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class FileWriter:
    """One file: documents in order, then ``close``."""

    def __init__(self, out, width: int):
        import xxhash
        import zstandard

        self.out, self.width = out, width
        self.hashed = xxhash.xxh64_intdigest
        self.press = zstandard.ZstdCompressor(level=LEVEL).compress
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int | None, int]] = []
        self.n_ids = self.n_bytes = 0

    def _put(self, frame: bytes, size: int, checksum: int) -> None:
        self.out.write(frame)
        self.n_bytes += len(frame)
        self.entries.append((len(frame), size, checksum & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        step = FRAME_IDS * self.width
        for at in range(0, len(ids), step):
            part = ids[at : at + step]
            self._put(self.press(part), len(part), self.hashed(part))
        n = len(ids) // self.width
        self.docs.append((doc_id, n))
        self.n_ids += n

    def close(self) -> None:
        body = b"".join(
            [
                struct.pack("<BBI", VERSION, self.width, len(self.docs)),
                np.array([d or 0 for d, _ in self.docs], dtype="<i8").tobytes(),
                np.array([d is None for d, _ in self.docs], dtype="u1").tobytes(),
                np.array([n for _, n in self.docs], dtype="<u8").tobytes(),
            ]
        )
        self._put(_skippable(INDEX_MAGIC, body + struct.pack("<Q", self.hashed(body))), 0, self.hashed(b""))
        table = np.array(self.entries, dtype="<u4").tobytes() + struct.pack("<IBI", len(self.entries), 0x80, SEEKABLE_MAGIC)
        self.out.write(_skippable(TABLE_MAGIC, table))
        self.n_bytes += len(table) + 8
        self.out.close()


class FileReader:
    """One file, opened for random access: its index at once, frames when they are asked for."""

    def __init__(self, source):
        import xxhash
        import zstandard

        self.source, self.hashed = source, xxhash.xxh64_intdigest
        self.unpress = zstandard.ZstdDecompressor().decompress
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != 0x80:
            raise ValueError("no seek table")
        start = size - 9 - 12 * n
        if struct.unpack("<II", self._at(start - 8, 8)) != (TABLE_MAGIC, 12 * n + 9):
            raise ValueError("seek table does not fit its frame")
        self.entries = np.frombuffer(self._at(start, 12 * n), dtype="<u4").reshape(n, 3)
        self.places = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        body = self._at(int(self.places[n - 1]) + 8, int(self.entries[-1, 0]) - 8)
        if struct.unpack("<Q", body[-8:])[0] != self.hashed(body[:-8]):
            raise ValueError("document index is damaged")
        _, self.width, docs = struct.unpack_from("<BBI", body)
        self.doc_id = np.frombuffer(body, "<i8", docs, 6)
        self.null = np.frombuffer(body, "u1", docs, 6 + 8 * docs)
        self.n_ids = np.frombuffer(body, "<u8", docs, 6 + 9 * docs).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.n_ids)])
        frames = -(-self.n_ids // FRAME_IDS)
        self.first = np.concatenate([[0], np.cumsum(frames)])

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def ids(self, i: int) -> bytes:
        """Ids of the ``i``-th document, checked frame by frame."""
        low, high = int(self.first[i]), int(self.first[i + 1])
        if low == high:
            return b""
        block = self._at(int(self.places[low]), int(self.places[high] - self.places[low]))
        parts = []
        for k in range(low, high):
            at = int(self.places[k] - self.places[low])
            size, checksum = int(self.entries[k, 1]), int(self.entries[k, 2])
            part = self.unpress(block[at : at + int(self.entries[k, 0])], max_output_size=size)
            if len(part) != size or self.hashed(part) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {k} is damaged")
            parts.append(part)
        return b"".join(parts)


def _files(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, by its address, and the folder's path there."""
    return fs.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder))


def write(docs: DataFrame, tokenizer: str, *, end: int, doc_id: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Encodes every whole text, appends ``end``, and writes the ids as files in ascending order of document id.

    Returns the list of the files (``FILES``), in the order (part, seq), with
    the smallest and largest document id of each. ``folder``: an address that
    driver and executors share; a new one in ``spark.checkpoint.dir`` if unset.
    A null text is an empty one. An empty table has no file.
    """
    folder = folder or f"{common.shared_dir(docs.sparkSession)}/ids-{uuid.uuid4().hex}"
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    # a row's place in its input, so that one id on very many rows, or one row very many times, can be cut anywhere
    placed = own.withColumns({"h": F.xxhash64("__text"), "row": F.monotonically_increasing_id()})
    order = [F.col("id").asc_nulls_last(), F.col("h"), F.col("row")]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        where, base = _files(folder)
        writer, path, seq, found = None, "", 0, []

        def closed() -> None:
            nonlocal writer, seq
            writer.close()
            known = [d for d, _ in writer.docs if d is not None]
            found.append((part, seq, path, len(writer.docs), writer.n_ids, writer.n_bytes, min(known, default=None), max(known, default=None)))
            writer, seq = None, seq + 1

        for batch in batches:
            for piece in common.text_slices(batch):
                for i, text_ in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    ids = enc.encode(text_, end)
                    if writer is None:
                        where.create_dir(base, recursive=True)
                        name = f"{part:06d}-{seq:04d}-{uuid.uuid4().hex}.ids.zst"
                        path, writer = f"{folder}/{name}", FileWriter(where.open_output_stream(f"{base}/{name}", compression=None), enc.width)
                    writer.add(i, ids)
                    if writer.n_ids >= FILE_IDS or len(writer.docs) >= FILE_DOCS:
                        closed()
        if writer is not None:
            closed()
        names = [x.split()[0] for x in FILES.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], type=t) for k, t in enumerate(kinds)], names=names)

    return common.stored(common.map_arrow(ranged, run, FILES))


def read(files: DataFrame, make: Callable[[bytes], dict], made: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """Per document of the files: doc_id, ``start`` (ids of all documents before it), n_tokens and what ``make`` returns for its ids.

    ``make`` gets the ids as little-endian unsigned 32-bit integers; ``made`` is
    the DDL of its fields. ``wanted``: only these document ids; files that hold
    none are not opened, and of the others only their frames are decompressed.
    """
    # one row a file: the running sum is over the list of files alone
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    ask = None if wanted is None else np.unique(np.array(list(wanted), dtype=np.int64))
    if ask is not None:
        reached = F.lit(False)
        if len(ask):
            some = F.array(*[F.lit(int(x)) for x in ask])
            reached = F.exists(some, lambda x: (x >= F.col("low")) & (x <= F.col("high")))
        listed = listed.where(reached)
    # dealt out one by one: a task reads about one file
    dealt = listed.select("path", "start").repartition(max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    schema = f"doc_id long, start long, n_tokens long, {made}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                where, at = fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))
                with where.open_input_file(at) as source:
                    file = FileReader(source)
                    chosen = np.arange(len(file.doc_id)) if ask is None else np.flatnonzero(np.isin(file.doc_id, ask) & (file.null == 0))
                    rows, held = [], 0
                    for i in chosen.tolist():
                        ids = np.frombuffer(file.ids(i), dtype=f"<u{file.width}").astype("<u4").tobytes()
                        rows.append({"doc_id": None if file.null[i] else int(file.doc_id[i]), "start": start + int(file.start[i]), "n_tokens": len(ids) // 4} | make(ids))
                        held += len(ids) + 64
                        if held > 1 << 23:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return common.map_arrow(dealt, run, kind)


def read_ids(files: DataFrame, wanted: Sequence[int] | None = None) -> DataFrame:
    """The documents of the files with their ids (binary, unsigned 32-bit little-endian)."""
    return read(files, lambda ids: {"ids": ids}, "ids binary", wanted)


def digests(files: DataFrame) -> DataFrame:
    """The documents of the files with the crc32 of their ids."""
    return read(files, lambda ids: {"ids_crc32": zlib.crc32(ids)}, "ids_crc32 long")
