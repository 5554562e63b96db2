"""Token ids as flat binary files with 64-bit document offsets.

A data set is a manifest plus, for each part, two files:

* ``.bin``: the ids of all documents of the part, little-endian unsigned, 16 bits wide where
  the vocabulary allows it and else 32;
* ``.idx``: ``n + 1`` unsigned 64-bit offsets in ids, counted from the start of the part,
  then ``n`` signed 64-bit document ids, then ``n`` bytes that are 1 for a NULL id.

The base of a part is the number of ids in the parts before it: a prefix sum over the
manifest. Parts follow each other in ascending ``doc_id`` (NULL first); rows that share a
``doc_id`` follow each other by a hash of their text.

NULL and empty texts hold the end id alone, and an empty table has no parts. The spelling of a
special token in a text is that token's id, as in the library's plain call. Very long texts are
encoded whole. Other columns of the input are ignored. A task
writes files of a new name each time it runs and only the manifest says which ones count, so a
repeated or lost task leaves nothing but an unused file.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwake.llm.common import partitions, staged, text_of
from ledgerwake.llm.secret_scan import scanner
from ledgerwake.sources.scratch import scratch_dir

MANIFEST = "part int, stem string, width int, n_docs bigint, n_ids bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, part int"
CACHE_ENTRIES = 1_000_000
CACHED_BYTES = 64
# Bytes of text that are encoded at once, if no single text is longer.
BLOCK_BYTES = 1 << 23


class Encoder:
    """Encodes many texts at once, looking up what it has encoded before.

    Byte-level BPE never merges across a space between two visible characters, so texts are cut
    there, and on both sides of such a line break (:func:`cuts`). Each distinct piece, with its
    leading space, is encoded once (:meth:`learn`). A text that holds the spelling
    of a special token is not cut, nor is any text if the vocabulary is not a plain byte-level
    one; the ids are those of the library's call on the whole text. The cache is emptied when it
    holds ``CACHE_ENTRIES`` pieces.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.known: dict[bytes, bytes] = {}
        self.direct = self.tokenizer.normalizer is None and "ByteLevel(" in repr(
            self.tokenizer.pre_tokenizer)
        self.special = [token.content.encode() for token in
                        self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model

    def learn(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids of each piece, as bytes.

        Letters, digits or signs alone, with a space in front or not, are a piece that the
        vocabulary's own cutting leaves whole, so they go straight to its model. All other pieces
        go through the library.
        """
        plain = [bool(self.direct and _plain.fullmatch(x)) for x in pieces]
        letters = iter(byte_letters(b"\n".join(
            x for x, ok in zip(pieces, plain, strict=True) if ok)).split("\n"))
        for piece, ok in zip(pieces, plain, strict=True):
            yield self.stored(
                [token.id for token in self.model.tokenize(next(letters))] if ok else
                self.tokenizer.encode(piece.decode("utf-8", "replace"),
                                      add_special_tokens=False).ids)

    def stored(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as bytes, from the cache or learnt together."""
        found = list(map(self.known.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known.clear()
        for i, ids in zip(new, self.learn([pieces[i] for i in new]), strict=True):
            found[i] = ids
            if len(pieces[i]) <= CACHED_BYTES:
                self.known[pieces[i]] = ids
        return found

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (an array of binary) behind each other, and how many each has.

        ``end_id`` is put behind every text.
        """
        offsets = np.frombuffer(texts.buffers()[1], dtype="<i4")[
            texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        first, data = int(offsets[0]), np.frombuffer(
            texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
        offsets -= first
        starts = cuts(data) if self.direct else np.zeros(0, dtype=np.int64)
        whole = np.zeros(len(texts), dtype=bool)
        for literal in self.special:
            whole |= pc.fill_null(pc.find_substring(texts, literal), -1).to_numpy(
                zero_copy_only=False) >= 0
        # Of which text a cut is; those in whole texts and at a text's first byte do not count.
        owner = np.searchsorted(offsets, starts, side="right") - 1
        starts = starts[~whole[owner] & (starts > offsets[owner])]
        heads = np.flatnonzero(np.diff(offsets))
        bounds = np.sort(np.concatenate([starts, offsets[heads]]))
        pieces = pa.Array.from_buffers(
            pa.binary(), len(bounds),
            [None, pa.py_buffer(np.append(bounds, len(data)).astype("<i4")), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        found = self.ids_of(coded.dictionary.to_pylist())
        index = coded.indices.to_numpy()
        per_text = np.bincount(np.searchsorted(offsets, bounds, side="right") - 1,
                               minlength=len(texts))
        if end_id is not None:
            index = np.insert(index, np.cumsum(per_text), len(found))
            per_text = per_text + 1
            found.append(np.array([end_id], dtype=self.dtype).tobytes())
        return self._gathered(found, index, per_text)

    def _gathered(self, found: list[bytes], index: np.ndarray,
                  per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces ``index``, of which each text has ``per_text``."""
        flat = np.frombuffer(b"".join(found), dtype=self.dtype)
        sizes = np.array([len(x) // self.width for x in found], dtype=np.int64)
        places = np.cumsum(sizes) - sizes
        lengths = sizes[index]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(places[index] - (ends - lengths), lengths)
        take += np.arange(total)
        # Pieces before each text's end, and with them ids.
        ends = np.concatenate([[0], ends])[np.cumsum(per_text)]
        return flat[take], np.diff(ends, prepend=0)


def cuts(data: np.ndarray) -> np.ndarray:
    """Where UTF-8 bytes of texts may be cut.

    At a space between two visible characters, before and behind a line break between two, and
    between a Latin letter and an ASCII sign; there, the vocabulary always cuts. The apostrophe is
    no such sign: it may begin an ending, as in "it's". What begins or ends with a byte that white
    space beyond ASCII shares is taken for such, which only makes longer pieces.
    """
    if len(data) < 2:
        return np.zeros(0, dtype=np.int64)
    blank = np.flatnonzero((data == 0x20) | (data == 0x0A))
    blank = blank[(blank > 0) & (blank < len(data) - 1)]
    after, before = data[blank + 1], data[blank - 1]
    two, three = data[np.maximum(blank - 2, 0)], data[np.maximum(blank - 3, 0)]
    wide = (before >= 0x80) & (_WIDE[two] | ((two >= 0x80) & _WIDE[three]))
    blank = blank[(after > 0x20) & ~_WIDE[after] & (before > 0x20) & ~wide]
    kind = _KIND[data]
    # A letter of two bytes counts from its first one, but for the signs of times and division.
    pair = np.zeros(len(data), dtype=bool)
    pair[:-1] = (kind[:-1] == _LEAD) & (data[1:] >= 0x80) & ~(
        (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    begins = pair | (kind == _LETTER)
    ends = kind == _LETTER
    ends[1:] |= pair[:-1]
    sign = kind == _SIGN
    joint = np.flatnonzero((ends[:-1] & sign[1:]) | (sign[:-1] & begins[1:])) + 1
    return np.sort(np.concatenate([blank, blank[data[blank] == 0x0A] + 1, joint]))


def byte_letters(data: bytes) -> str:
    """The characters by which a byte-level vocabulary writes bytes; line breaks stay."""
    return _LETTERS[np.frombuffer(data, dtype=np.uint8)].tobytes().decode("utf-32-le")


# Bytes that are no visible Latin-1 character are written as characters from 256 on.
_hidden = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173)]
_LETTERS = np.arange(256, dtype="<u4")
_LETTERS[_hidden] = 256 + np.arange(len(_hidden))
_LETTERS[10] = 10
# Kinds of bytes: ASCII letters, first bytes of U+00C0 to U+023F, ASCII signs.
_LETTER, _LEAD, _SIGN = 1, 2, 3
_KIND = np.zeros(256, dtype=np.int8)
_KIND[[b for b in range(33, 127) if chr(b) != "'"]] = _SIGN
_KIND[list(b"0123456789")] = 0
_KIND[[b for b in range(128) if chr(b).isalpha()]] = _LETTER
_KIND[0xC3:0xC9] = _LEAD
_plain = re.compile(
    rb" ?(?:(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF]|[\xC4-\xC8][\x80-\xBF])+|[0-9]+"
    rb"|[!-&(-/:-@\[-`{-~]+)")
# First bytes of U+0085, U+00A0 and of all wider white space.
_WIDE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
_encoders: dict[str, Encoder] = {}


def id_counter(ranks_path: str, pattern: str,
               special: tuple[str, ...] = ()) -> Callable[[str], int]:
    """Counts the ids :class:`Encoder` gives a text, without an end id.

    The vocabulary is given as ranks of byte strings, which count in a third of the time, and the
    spellings of its special tokens, each of which is one id.
    """
    ids = scanner(ranks_path, pattern).encoding.encode_ordinary
    literal = re.compile("|".join(map(re.escape, special))) if special else None

    def count(text: str) -> int:
        if literal is None or not literal.search(text):
            return len(ids(text))
        return sum(len(ids(part)) for part in literal.split(text)) + len(literal.findall(text))

    return count


def n_ids(text: Column, ranks_path: str, pattern: str, special: tuple[str, ...] = ()) -> Column:
    """Number of ids :class:`Encoder` gives a text; only this number leaves the worker."""

    @F.arrow_udf("bigint")
    def count(text: pa.Array) -> pa.Array:
        # One text at a time is a Python object: a batch may hold very long ones.
        ids = id_counter(ranks_path, pattern, special)
        return pa.array([ids(t.as_py()) for t in text], pa.int64())

    return count(text)


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and worker process, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def open_store(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def write(docs: DataFrame, vocabulary: str, end_id: int, root: str | None = None,
          text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every document, write the parts, and return the staged manifest."""
    spark = docs.sparkSession
    root = root or scratch_dir(spark, "token-files")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        coder = encoder(vocabulary)
        store, folder = open_store(root)
        store.create_dir(folder, recursive=True)
        part = TaskContext.get().partitionId()
        stem = f"part-{part:06d}-{uuid.uuid4().hex}"
        sizes, ids, nulls = [], [], []
        with store.open_output_stream(f"{folder}/{stem}.bin") as out:
            for batch in _chain(first, batches):
                for block in blocks(batch):
                    found, each = coder.encode(block.column(1), end_id)
                    out.write(found.data)
                    sizes.append(each)
                    nulls.append(block.column(0).is_null().to_numpy(zero_copy_only=False))
                    ids.append(block.column(0).fill_null(0).to_numpy())
        lengths, ids, nulls = map(np.concatenate, (sizes, ids, nulls))
        offsets = np.zeros(len(lengths) + 1, dtype="<u8")
        np.cumsum(lengths, out=offsets[1:])
        with store.open_output_stream(f"{folder}/{stem}.idx") as out:
            out.write(offsets.tobytes() + ids.astype("<i8").tobytes()
                      + nulls.astype("u1").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([f"{root}/{stem}"]),
             pa.array([coder.width], pa.int32()), pa.array([len(ids)], pa.int64()),
             pa.array([int(offsets[-1])], pa.int64())],
            names=["part", "stem", "width", "n_docs", "n_ids"])

    keyed = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    keyed = keyed.withColumn("text", F.col("text").cast("binary"))
    ranged = keyed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    return with_bases(staged(ranged.mapInArrow(parts, MANIFEST), "token-manifest"))


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose texts take ``BLOCK_BYTES`` together, or one longer text."""
    sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes) - sizes) // BLOCK_BYTES
    for rows in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(block)) + 1):
        yield batch.slice(rows[0], len(rows))


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def with_bases(manifest: DataFrame) -> DataFrame:
    """Add ``base``, the ids in all earlier parts. One light row for each part file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn(
        "base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("bigint"))


def mapped(uri: str, dtype: np.dtype) -> np.ndarray:
    """Content of a file: memory-mapped where it is a local path, else read."""
    store, path = open_store(uri)
    if isinstance(store, pa.fs.LocalFileSystem):
        source = pa.memory_map(path)
    else:
        source = store.open_input_file(path)
    return np.frombuffer(source.read_buffer(), dtype=dtype)


def load_part(stem: str, width: int, n_docs: int) -> tuple[np.ndarray, ...]:
    """Ids, offsets, document ids and NULL flags of a part."""
    ids = mapped(f"{stem}.bin", np.dtype(f"<u{width}"))
    index = mapped(f"{stem}.idx", np.dtype("u1"))
    cut = [8 * (n_docs + 1), 8 * (2 * n_docs + 1)]
    return (ids, index[:cut[0]].view("<u8"), index[cut[0]:cut[1]].view("<i8"),
            index[cut[1]:].astype(bool))


def read(manifest: DataFrame) -> DataFrame:
    """Per document: place, length and checksum of its ids, taken from the files."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, docs, nulls = load_part(row["stem"], row["width"], row["n_docs"])
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes())
                        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(),
                                        strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64(), mask=nulls),
                     pa.array(offsets[:-1].astype("i8") + row["base"]),
                     pa.array(np.diff(offsets).astype("i8")),
                     pa.array(sums, pa.int64()),
                     pa.array(np.full(len(docs), row["part"], dtype="i4"))],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "part"])

    spread = manifest.repartition(partitions(manifest.sparkSession))
    return spread.mapInArrow(documents, DOCUMENTS)


def token_table(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    return read(write(docs, vocabulary, end_id))
