"""Token ids in binary files: a zstandard frame for each document, all with one trained dictionary.

Short documents hardly compress on their own.  A dictionary trained on a sample of serialised
id arrays holds what they have in common, so each document can be a frame of its own and be
read without its neighbours.

A file is a header (magic, width of an id in bytes, SHA-256 of the dictionary), the frames,
the index (columns of document ids, their validity, token counts and ends of frames) and a
footer (place of the index, number of documents, magic).  The dictionary lies beside the files,
named by its hash.  Files are named by the task attempt that writes them, and count only once
the attempt's rows in the manifest are committed: what a lost executor leaves is never read.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from salescompass.llm.storage import repeatable, stored
from salescompass.session import run_dir

END_ID = 0
DICTIONARY_BYTES = 64_000
SAMPLE = 2_000  # documents that the dictionary is trained on, and the most characters of each
SAMPLE_CHARS = 16_000
PART_BYTES = 64_000_000  # text that a task encodes: what it has learnt about words pays off over all of it
FILE_BYTES = 16_000_000  # compressed; a file ends with the document that reaches it
LEVEL = 3
CACHED_CHARS = 20_000_000  # of chunks whose ids a task remembers

MAGIC = b"TIDS"
_HEADER, _FOOTER = "<4sB3x32s", "<QQ4s"  # struct formats
_HEADER_SIZE, _FOOTER_SIZE = struct.calcsize(_HEADER), struct.calcsize(_FOOTER)
_INDEX = np.dtype([("doc_id", "<i8"), ("known", "?"), ("tokens", "<u8"), ("end", "<u8")])

# fixed values: the white space of Unicode's White_Space property; letters, and marks that follow words, of Latin-1
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_MARKS = r".,;:!?%&*)\"\-"
_WORD = rf" ?[{_LETTERS}]+"
#: Pieces between which a byte-level pre-tokenizer always cuts: a word, with the one blank before it, that white
#: space or a mark follows; another run without white space; white space up to its last character before such a
#: run; that last one, if it is no blank.
_CHUNK = re.compile(rf"{_WORD}(?![^{_SPACE}{_MARKS}])| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
_ONE_WORD = re.compile(_WORD).fullmatch


def _byte_letters() -> dict[int, int]:
    """What a byte-level vocabulary writes for each byte: printable Latin-1 for itself, the others in turn from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: 0x100 + i for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()
_BLANK = chr(_BYTE_LETTERS[0x20])
_ID = attrgetter("id")


class _Numbers(dict):
    """Number of each chunk, in order of first sight."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class Encoder:
    """Ids of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    A byte-level tokenizer without a normalizer treats chunks alike wherever they stand, so each
    distinct chunk is encoded once, and one that is a single word goes straight to the model.
    Texts that spell one of the added tokens, and all texts of other kinds of tokenizer, are
    encoded whole.
    """

    def __init__(self, definition: str):
        self._tokenizer = Tokenizer.from_str(definition)
        spec = json.loads(definition)
        cutter = spec.get("pre_tokenizer") or {}
        self._by_chunk = (
            cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
            and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
        )
        self._added = [t["content"] for t in spec.get("added_tokens") or []]
        self._forget()

    def _forget(self) -> None:
        self._numbers, self._chars = _Numbers(), 0
        self._first, self._ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        new, self._numbers.new = self._numbers.new, []
        found: list[list[int] | None] = [None] * len(new)
        model, others = self._tokenizer.model, []
        for i, chunk in enumerate(new):
            if _ONE_WORD(chunk):
                letters = chunk.replace(" ", _BLANK) if chunk.isascii() else chunk.encode().decode("latin-1").translate(_BYTE_LETTERS)
                found[i] = list(map(_ID, model.tokenize(letters)))
            else:
                others.append(i)
        for i, ids in zip(others, self._encoded([new[i] for i in others]), strict=True):
            found[i] = ids
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) + self._first[-1]
        self._first = np.concatenate([self._first, ends])
        self._ids = np.concatenate([self._ids, np.fromiter(chain.from_iterable(found), np.uint32, int(ends[-1] - len(self._ids)))])
        self._chars += sum(map(len, new))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        whole = [not self._by_chunk or any(a in t for a in self._added) for t in texts]
        chunks = [[] if w else list(map(self._numbers.__getitem__, _CHUNK.findall(t))) for w, t in zip(whole, texts, strict=True)]
        if self._numbers.new:
            self._learn()
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        number = np.fromiter(chain.from_iterable(chunks), np.int64, int(counts.sum()))
        lengths = self._first[number + 1] - self._first[number]
        ends = np.cumsum(lengths)
        ids = self._ids[np.repeat(self._first[number] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        out = np.split(ids, np.concatenate([[0], ends])[np.cumsum(counts)][:-1]) if len(texts) else []
        if any(whole):
            direct = iter(self._encoded([t for w, t in zip(whole, texts, strict=True) if w]))
            out = [np.array(next(direct), np.uint32) if w else ids for w, ids in zip(whole, out, strict=True)]
        if self._chars > CACHED_CHARS:
            self._forget()
        return out


def id_type(definition: str) -> np.dtype:
    """The narrowest of two widths that holds every id of a tokenizer."""
    return np.dtype("<u2" if Tokenizer.from_str(definition).get_vocab_size() <= 1 << 16 else "<u4")


def _text_pieces(batch: pa.RecordBatch, chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``chars`` characters; null texts are empty."""
    begin, held, out = 0, 0, []
    for i, value in enumerate(batch.column("text")):
        text = value.as_py() or ""
        if out and held + len(text) > chars:
            yield begin, out
            begin, held, out = i, 0, []
        held += len(text)
        out.append(text)
    if out:
        yield begin, out


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


class _Writer:
    """One file: frames go out as they come, the index is kept until the end."""

    def __init__(self, files: pafs.FileSystem, path: str, dictionary: bytes, width: int):
        self.path, self._out = path, files.open_output_stream(path)
        self._out.write(struct.pack(_HEADER, MAGIC, width, hashlib.sha256(dictionary).digest()))
        self.index: list[tuple] = []
        self.place = _HEADER_SIZE

    def add(self, doc_id: int | None, tokens: int, frame: bytes) -> None:
        self._out.write(frame)
        self.place += len(frame)
        self.index.append((doc_id or 0, doc_id is not None, tokens, self.place))

    def close(self) -> None:
        self._out.write(np.array(self.index, _INDEX).tobytes())
        self._out.write(struct.pack(_FOOTER, self.place, len(self.index), MAGIC))
        self._out.close()


class TokenFile:
    """A file for reading: any document alone, by its place in the file."""

    def __init__(self, files: pafs.FileSystem, path: str, dictionary: bytes):
        self._in = files.open_input_file(path)
        size = self._in.size()
        magic, self._width, self.dictionary_hash = struct.unpack(_HEADER, self._in.read_at(_HEADER_SIZE, 0))
        place, n, end_magic = struct.unpack(_FOOTER, self._in.read_at(_FOOTER_SIZE, size - _FOOTER_SIZE))
        if magic != MAGIC or end_magic != MAGIC or self.dictionary_hash != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} is no token file of this dictionary")
        self.index = np.frombuffer(self._in.read_at(n * _INDEX.itemsize, place), _INDEX)
        self.starts = np.concatenate([[0], np.cumsum(self.index["tokens"])]).astype(np.int64)
        self._places = np.concatenate([[_HEADER_SIZE], self.index["end"]]).astype(np.int64)
        self._unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def __len__(self) -> int:
        return len(self.index)

    def __getitem__(self, i: int) -> np.ndarray:
        frame = self._in.read_at(int(self._places[i + 1] - self._places[i]), int(self._places[i]))
        return np.frombuffer(self._unpack.decompress(frame), f"<u{self._width}")

    def find(self, doc_id: int) -> np.ndarray:
        """Places of a document id: the index is in order of ids, those without one first."""
        first = len(self.index) - int(self.index["known"].sum())
        ids = self.index["doc_id"][first:]
        return np.arange(np.searchsorted(ids, doc_id, "left"), np.searchsorted(ids, doc_id, "right")) + first

    def close(self) -> None:
        self._in.close()


def train_dictionary(docs: DataFrame, definition: str, size: int = DICTIONARY_BYTES, sample: int = SAMPLE) -> tuple[bytes, float]:
    """A zstandard dictionary trained on the id arrays of about ``sample`` pseudorandom rows (the first
    SAMPLE_CHARS characters of each), in one task, and the estimated bytes of all texts.

    Rows are taken by the hash of their id and position, so every task passes on its share of them only.
    The dictionary is empty if there is too little to learn from.
    """
    rows = docs.agg(F.count(F.lit(1))).first()[0]
    taken = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(1 << 40)) < F.lit(round(min(1.0, sample / max(rows, 1)) * (1 << 40)))
    some = docs.filter(taken).select(F.substring("text", 1, SAMPLE_CHARS).alias("text"), F.octet_length("text").alias("bytes"))

    def train(table: pa.Table) -> pa.Table:
        encode, kind = Encoder(definition), id_type(definition)
        samples = [ids.astype(kind).tobytes() for b in table.to_batches() for _, texts in _text_pieces(b) for ids in encode(texts)]
        try:
            found = zstandard.train_dictionary(size, [s for s in samples if s]).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too few or too small samples
            found = b""
        mean = float(table.column("bytes").to_numpy().mean())
        return pa.table({"dictionary": pa.array([found], pa.binary()), "mean": pa.array([mean])})

    found = some.groupBy().applyInArrow(train, "dictionary binary, mean double").collect()
    return (bytes(found[0]["dictionary"]), found[0]["mean"] * rows) if found else (b"", 0.0)


MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, n_bytes long"


def _write(folder: str, definition: str, dictionary: bytes, end_id: int, file_bytes: int):
    def write(batches):
        files, root = _open(folder)
        encode, kind = Encoder(definition), id_type(definition)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        seq, out = 0, None

        def done():
            out.close()
            row = (part, seq, out.path, len(out.index), sum(i[2] for i in out.index), out.place)
            return pa.RecordBatch.from_pylist([dict(zip((c.split()[0] for c in MANIFEST.split(", ")), row, strict=True))], manifest)

        manifest = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])
        for batch in batches:
            numbers = batch.column("doc_id").to_pylist()
            for low, texts in _text_pieces(batch):
                for doc_id, ids in zip(numbers[low : low + len(texts)], encode(texts), strict=True):
                    if out is None:
                        out = _Writer(files, f"{root}/{part:06d}-{seq:05d}-{attempt}.ids", dictionary, kind.itemsize)
                    out.add(doc_id, len(ids) + 1, pack.compress(np.append(ids, end_id).astype(kind).tobytes()))
                    if out.place >= file_bytes:
                        yield done()
                        seq, out = seq + 1, None
        if out is not None:
            yield done()

    return write


class TokenFiles(NamedTuple):
    """Written token files: the folder, the dictionary, and a manifest with a row for each file."""

    folder: str
    dictionary: bytes
    manifest: DataFrame

    def bases(self) -> DataFrame:
        """The manifest with ``base``, the number of ids in all files before.

        One row per part, as many as the shuffle has, is summed in order; files are summed inside their part.
        """
        parts = self.manifest.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
        inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        inside_part = self.manifest.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        return inside_part.join(parts, "part").select("path", (F.col("before") + F.col("inside")).alias("base"), "n_docs", "n_tokens")

    def documents(self, with_ids: bool = False) -> DataFrame:
        """Every document read back: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``,
        ``ids_crc32`` of its ids as unsigned 32-bit integers and, if asked for, ``ids``."""
        folder, dictionary = self.folder, self.dictionary

        def read(batches):
            files, _ = _open(folder)
            for path, base in ((r["path"], r["base"]) for b in batches for r in b.select(["path", "base"]).to_pylist()):
                file = TokenFile(files, path, dictionary)
                for low in range(0, len(file), 1000):
                    ids = [file[i].astype("<u4") for i in range(low, min(low + 1000, len(file)))]
                    rows = file.index[low : low + len(ids)]
                    columns = {
                        "doc_id": pa.array(rows["doc_id"], pa.int64(), mask=~rows["known"]),
                        "start": pa.array(file.starts[low : low + len(ids)] + base, pa.int64()),
                        "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                        "ids_crc32": pa.array([crc32(i.tobytes()) for i in ids], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns)
                file.close()

        schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
        n = max(1, min(10_000, self.manifest.count()))  # tasks; a small table's own partitions would be put together
        return self.bases().repartition(n, "path").mapInArrow(read, schema)


def write_token_files(
    docs: DataFrame, definition: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES,
    part_bytes: int = PART_BYTES,
) -> TokenFiles:
    """Encode every whole text, append ``end_id`` and write the ids in ascending order of ids.

    ``definition`` is the tokenizer as JSON.  Null texts are empty and have the end id alone.
    Null ids come first; rows of one id are in order of their texts' hash, and equal rows one
    after another, over as many tasks as they fill.  An empty table has no files.  Other columns
    are ignored.  The folder is below ``spark.checkpoint.dir``, on any store that pyarrow opens.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = repeatable(rows, "token-input")
    dictionary, size = train_dictionary(rows, definition)
    folder = run_dir(spark, "llm", f"token-files-{uuid.uuid4().hex[:12]}")
    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{hashlib.sha256(dictionary).hexdigest()}.dict") as out:
        out.write(dictionary)
    keys = ("doc_id", "tie", "row")
    ordered = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = ordered.repartitionByRange(math.ceil((size + 1) / part_bytes), *keys).sortWithinPartitions(*keys)
    written = ordered.select("doc_id", "text").mapInArrow(_write(folder, definition, dictionary, end_id, file_bytes), MANIFEST)
    return TokenFiles(folder, dictionary, stored(written, "token-manifest"))
