"""Pack documents into token sequences along a space-filling curve.

A document's tokens are counted in hashed buckets; the square-rooted, normalised
vector is projected to three dimensions and quantised, and its place on a
Hilbert curve through that cube is its key. Encoded documents are written once,
range-sorted by (key, hash of id and tokens) - the hash splits documents with
one key, such as a large group of copies - and each range is packed as a stream
of tokens: neighbours on the curve share sequences, cuts fall every ``size``
tokens. The tail of a stream, shorter than ``size``, becomes sequences whose
lengths are the powers of two in its binary form, so that nothing is padded.

A row that is repeated as a whole (as a mixture does) meets its repeats in the
sort. They are numbered, and each number is a stream of its own along the same
range, so no sequence holds one document twice unless it is longer than a
sequence. Past ``OPEN_STREAMS`` repeats a stream is ended before it takes the next one.

Defined cases: a null or empty text has the closing token alone. A null
``doc_id`` is packed like any other. An empty table gives an empty result.
Texts of any length are encoded whole and cut freely. Columns other than
``doc_id`` and ``text`` are left behind.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownlake.llm.chunks import distinct_chunks, lookup
from crownlake.llm.common import lean, prepare, shuffle_partitions, stored, texts, utf8_bytes

SIZE = 2048
END_TOKEN = 1
BUCKETS = 256
DIMENSIONS, BITS = 3, 10
# A projection of a unit vector is about normal with variance 1; the cube spans three deviations to each side.
REACH = 3.0

ENCODED = "doc_id bigint, curve_key bigint, ids binary"
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, copy int"
ID = np.dtype(np.uint16)
# A word of Latin-1 letters, and a border of a letter and a sign: the tokenizer always separates the two,
# lower-cases the word letter by letter, and normalisation leaves both as they are.
WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
BORDER = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])"
# Texts that keep their letters' case: special tokens have it in their names, and marks may join only one case of a letter.
CASED = r"<\||[A-Z]\pM"
MEMO_ENTRIES = 700_000
OPEN_STREAMS = 8
PART_BYTES = 1 << 20  # texts encoded at once

_loaded: dict[str, tuple] = {}


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each integer point (rows of coordinates below 2**bits) on the Hilbert curve, after Skilling (2004)."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _tokenizer(path: str) -> tuple:
    """The tokenizer, the byte-level spelling of Latin-1 letters, and this worker's memo of chunks and words."""
    if path not in _loaded:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        if tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        spelling = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = {c: spelling.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        _loaded[path] = (tokenizer, letters, {})
    return _loaded[path]


def encode_batch(path: str, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of each text, one after the other, and the n+1 offsets of the texts.

    The tokenizer replaces runs of white space by one space, drops it and never
    joins what it separated, so white-space-separated chunks encode alone.
    """
    tokenizer, letters, memo = _tokenizer(path)
    tokenize = tokenizer.model.tokenize

    def word(v: str) -> bytes:
        return array("H", [t.id for t in tokenize(v)]).tobytes()

    def encode(values: list[str]) -> list[bytes]:
        spelt = [v.lower() if v.isascii() and v.isalpha() else v.lower().translate(letters) if WORD.fullmatch(v) else None for v in values]
        rest = iter(tokenizer.encode_batch_fast([v for v, w in zip(values, spelt) if w is None], add_special_tokens=False))
        return [array("H", next(rest).ids).tobytes() if w is None else word(w) for w in spelt]

    lowered = pc.if_else(pc.match_substring_regex(batch, CASED), batch, pc.ascii_lower(batch))
    parted = pc.replace_substring_regex(lowered, BORDER, r"\1 \2")
    chunks, index, offsets = distinct_chunks(pc.ascii_split_whitespace(parted))
    coded = lookup(chunks, memo, encode, MEMO_ENTRIES)
    flat = np.frombuffer(b"".join(coded), ID)
    lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // ID.itemsize
    starts = np.cumsum(lengths) - lengths
    n = lengths[index]
    before = np.concatenate([[0], np.cumsum(n)])
    ids = flat[np.arange(before[-1]) + np.repeat(starts[index] - before[:-1], n)]
    return ids, before[offsets]


def curve_keys(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hilbert keys of the documents' hashed vectors."""
    rng = np.random.default_rng(7)
    bucket_of = rng.integers(0, BUCKETS, 1 << 16).astype(np.int32)
    projection = rng.standard_normal((BUCKETS, DIMENSIONS))
    n = len(offsets) - 1
    of = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, np.diff(offsets))
    vectors = np.sqrt(np.bincount(of + bucket_of[ids], minlength=n * BUCKETS).reshape(n, BUCKETS))
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    points = (vectors / np.where(norm > 0, norm, 1)) @ projection
    cells = np.clip((points + REACH) / (2 * REACH) * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert_key(cells.astype(np.int64))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in consecutive parts of at most ``PART_BYTES`` of text, unless one text is longer: arrays of ids stay small."""
    ends = utf8_bytes(batch.column("text"))[1][1:]
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(int(np.searchsorted(ends, done + PART_BYTES, side="right")), at + 1)
        yield batch.slice(at, to - at)
        at = to


def _encode(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole)):
            ids, offsets = encode_batch(path, batch.column("text"))
            keys = curve_keys(ids, offsets)
            # The closing token goes in behind each text's ids.
            closed = np.insert(ids, offsets[1:], END_TOKEN).astype(ID)
            ends = (offsets + np.arange(len(offsets))) * ID.itemsize
            blob = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(closed)])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "curve_key": pa.array(keys, pa.int64()), "ids": blob.cast(pa.binary())})

    return run


class _Stream:
    """Cuts one stream of tokens into sequences; keeps only the unfinished one. ``sequences`` holds the next id of the task."""

    def __init__(self, size: int, sequences: list[int]) -> None:
        self.size, self.sequences = size, sequences
        self.docs = np.zeros((0, 3), np.int64)  # of each segment: ids before it, tokens of its document, its copy number
        self.names: list[int | None] = []
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, ID)

    def add(self, names: list[int | None], lengths: np.ndarray, copies: np.ndarray, ids: np.ndarray) -> None:
        self.names = self.names + names
        self.docs = np.concatenate([self.docs, np.stack([np.zeros_like(lengths), lengths, copies], axis=1)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])

    def whole(self) -> Iterator[pa.RecordBatch]:
        """The sequences that are full."""
        if full := len(self.ids) // self.size:
            yield self.take(np.arange(1, full + 1, dtype=np.int64) * self.size)

    def tail(self) -> Iterator[pa.RecordBatch]:
        """What is left, in powers of two."""
        if rest := len(self.ids):
            yield self.take(np.cumsum([1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]).astype(np.int64))

    def take(self, limits: np.ndarray) -> pa.RecordBatch:
        """Emit the sequences that end at the ``limits`` of the kept stream, and keep the rest."""
        total = int(limits[-1])
        starts = np.cumsum(self.lengths) - self.lengths
        cuts = np.union1d(starts[starts < total], np.concatenate([[0], limits[:-1]]))
        ends = np.append(cuts[1:], total)
        of = np.searchsorted(starts, cuts, side="right") - 1
        inside = np.searchsorted(limits, cuts, side="right")
        sequence_start = np.concatenate([[0], limits])[inside]
        wide = memoryview(self.ids[:total].astype("<u4").tobytes())
        out = pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([self.names[i] for i in of], pa.int64()),
                "start": pa.array(self.docs[of, 0] + cuts - starts[of]),
                "length": pa.array(ends - cuts),
                "ids_crc32": pa.array([zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(cuts, ends)], pa.int64()),
                "doc_tokens": pa.array(self.docs[of, 1]),
                "sequence_id": pa.array(self.sequences[0] + inside),
                "offset": pa.array(cuts - sequence_start),
                "copy": pa.array(self.docs[of, 2].astype(np.int32)),
            }
        )
        self.sequences[0] += len(limits)
        last = int(np.searchsorted(starts, total, side="right")) - 1
        if last >= 0 and starts[last] + self.lengths[last] <= total:
            last += 1
        else:
            used = total - starts[last]
            self.docs[last, 0] += used
            self.lengths[last] -= used
        self.names, self.docs, self.lengths, self.ids = self.names[last:], self.docs[last:], self.lengths[last:], self.ids[total:]
        return out


def _pack(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = [TaskContext.get().partitionId() << 40]
        streams = [_Stream(size, sequences) for _ in range(OPEN_STREAMS)]
        last: tuple[int | None, bytes] | None = None
        copy = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names, blobs = batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()
            copies = np.zeros(len(names), np.int64)
            for i, (name, blob) in enumerate(zip(names, blobs)):
                same = last is not None and last[0] == name and last[1] == blob
                copy = copy + 1 if same else 0
                copies[i], last = copy, (name, blob)
            lengths = np.array([len(b) // ID.itemsize for b in blobs], np.int64)
            first = copies == 0
            if first.any():
                own = np.flatnonzero(first)
                streams[0].add([names[i] for i in own], lengths[own], copies[own], np.frombuffer(b"".join([blobs[i] for i in own]), ID))
                yield from streams[0].whole()
            for i in np.flatnonzero(~first):
                stream = streams[1 + (copies[i] - 1) % (OPEN_STREAMS - 1)]
                if copies[i] >= OPEN_STREAMS:
                    yield from stream.tail()
                stream.add([names[i]], lengths[i : i + 1], copies[i : i + 1], np.frombuffer(blobs[i], ID))
                yield from stream.whole()
        for stream in streams:
            yield from stream.tail()

    return run


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, copy``.

    ``copy`` numbers the repeats of a whole row from 0. ``size`` is a power of two. Sequence ids are unique, not gapless.
    """
    spark = docs.sparkSession
    prepare(spark)
    encoded = stored(texts(docs).mapInArrow(lean(_encode(tokenizer_path)), ENCODED), "encoded", "zstd")
    tie = F.xxhash64("doc_id", F.crc32("ids"))
    ranged = encoded.withColumn("__tie", tie).repartitionByRange(shuffle_partitions(spark), "curve_key", "__tie")
    along = ranged.sortWithinPartitions("curve_key", "__tie", "doc_id", "ids").select("doc_id", "ids")
    return along.mapInArrow(lean(_pack(size)), PIECES)
