"""Token ids of documents in files of Simple-8b words.

Encoding: texts are cut where the tokenizer itself cuts them, and each distinct piece is given to its model once per
task (a memo of bounded size).

A file row (a chunk) holds whole documents: their ids, their numbers of tokens, and blocks of ``BLOCK`` token ids.
Each block is packed by itself into 64-bit words, so any block can be decoded alone; ``offsets`` says where the words
of each block begin. A word has a selector in its top four bits and 60 bits of payload: selector s < 13 holds
``COUNTS[s]`` ids of ``WIDTHS[s]`` bits each, the first in the lowest bits; the escape selector 15 holds one id of any
32-bit value. The last word of a block may have room for more ids than the block has; the rest are zeros.
Rows are written as Parquet (little-endian words in ``payload``), parts and chunks in ascending document order.
"""

from __future__ import annotations

import gc
import json
import os
import uuid
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import checkpoint_dir
from . import words
from .words import flat

END_ID = 2
BLOCK = 4096
CHUNK_IDS = 1 << 20
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30])
ESCAPE = 15
MEMO_BYTES = 64 << 20  # of a worker's memo, as estimated from its pieces and ids
ENTRY_BYTES = 130
TOGETHER = 10_000  # new pieces
LONG_PIECE = 1024  # bytes; longer ones are not kept
ENCODE_BYTES = 2 << 20
U = np.uint64

FILE_SCHEMA = "part int, chunk int, n_ids long, doc_ids array<long>, doc_tokens array<long>, offsets array<int>, payload binary"


# ---- encoding ----------------------------------------------------------------------------------------------------


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts, equal to encoding each whole text with the tokenizers library.

    A byte-level tokenizer first cuts a text into pieces: a contraction, or a run of letters, digits or other characters with at most
    one space before it, or white space. The cuts follow from the classes of neighbouring characters, so they are found for all texts
    of a slice at once; the tokenizer itself is asked for the class of each character that it has not seen. Each distinct piece
    goes to the tokenizer's model once and its ids are kept in a memo of two generations: when the younger one is full, the elder is
    forgotten and pieces that are still in use move on. Texts that hold an added token, and all texts of a tokenizer
    of another kind, are encoded whole.
    """

    CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
    LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4

    def __init__(self, path: str, special_as_text: bool = False, memo: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.by_pieces = self._cuts_by_class()
        self.added = [
            t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content and not (t.special and special_as_text)
        ]
        self.kinds = np.zeros(0x110000, np.int8)  # 0: not asked for yet
        self.letters = byte_letters()
        self.half = memo // 2
        self.forget()

    def _cuts_by_class(self) -> bool:
        """Whether pieces are cut as described, with nothing before or after."""
        own = self.tokenizer
        cut = json.loads(own.pre_tokenizer.__getstate__()) if own.pre_tokenizer else {}
        return (
            cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
            and type(own.model).__name__ == "BPE" and not own.model.dropout
            and not (own.normalizer or own.truncation or own.padding)
        )

    # -- pieces

    def _ask(self, codes: np.ndarray) -> None:
        """The classes of characters, as the tokenizer joins them to a letter, a digit or another character."""
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for c in codes.tolist():
            beside = (kind for kind, x in ((self.LETTER, "a"), (self.NUMBER, "1"), (self.OTHER, "!")) if len(cut(x + chr(c))) == 1)
            self.kinds[c] = next(beside, self.SPACE)

    def _starts(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Byte positions at which the pieces of all texts begin."""
        if data.max() < 0x80:
            codes, lead = data, None
        else:
            codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            begins = np.searchsorted(lead, begins)
        kind = self.kinds[codes]
        if not kind.all():
            self._ask(np.unique(codes[kind == 0]))
            kind = self.kinds[codes]
        n = len(codes)
        edge = np.zeros(n + 1, bool)
        edge[begins] = True
        start = edge.copy()
        start[1:n] |= kind[1:] != kind[:-1]
        # the last white space before another character stands alone; a space goes with what follows
        white = kind == self.SPACE
        last = np.flatnonzero(white[:-1] & ~white[1:] & ~edge[1:n])
        start[last] = True
        start[last[codes[last] == 0x20] + 1] = False
        quote = np.flatnonzero((codes == 0x27) & start[:n])
        for letters in self.CONTRACTIONS:
            at = quote[quote + len(letters) < n]
            for j, letter in enumerate(letters, 1):
                at = at[(codes[at + j] == ord(letter)) & ~edge[at + j]]
            start[at + 1] = False
            start[at + 1 + len(letters)] = True
        found = np.flatnonzero(start[:n])
        return found if lead is None else lead[found]

    # -- ids of pieces

    def forget(self) -> None:
        self.young: dict[bytes, bytes] = {}
        self.elder: dict[bytes, bytes] = {}
        self.size = 0

    def _piece_ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each of different pieces, as bytes of 32-bit numbers."""
        found = list(map(self.young.get, pieces))
        absent = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(absent), TOGETHER):
            some = absent[at : at + TOGETHER]
            new = []
            for i in some:
                found[i] = ids = self.elder.get(pieces[i])
                if ids is None:
                    new.append(i)
            if new:
                model = self.tokenizer.model.tokenize
                for i, text in zip(new, self._byte_texts([pieces[i] for i in new])):
                    found[i] = array("I", [t.id for t in model(text)]).tobytes()
            short = {pieces[i]: found[i] for i in some if len(pieces[i]) <= LONG_PIECE}
            self.young.update(short)
            self.size += sum(map(len, short)) + sum(map(len, short.values())) + ENTRY_BYTES * len(short)
            if self.size > self.half:
                self.elder, self.young, self.size = self.young, {}, 0
        return found

    def _byte_texts(self, pieces: list[bytes]) -> list[str]:
        """The pieces as the vocabulary writes them, one character for each byte."""
        return self.letters[np.frombuffer(b"\xff".join(pieces), np.uint8)].tobytes().decode("utf-32-le").split(" ")

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        data, begins = flat(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        n = len(begins) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        raw = data.tobytes()
        whole = range(n)
        if self.by_pieces:
            whole = [i for i in range(n) if any(t in raw[begins[i] : begins[i + 1]] for t in self.added)] if any(t in raw for t in self.added) else []
        if not whole:
            return self._by_pieces(data, begins)
        parts: list[np.ndarray] = []
        sizes = np.zeros(n, np.int64)
        done = 0
        for i in [*whole, n]:
            if done < i:
                ids, sizes[done:i] = self._by_pieces(data[begins[done] : begins[i]], begins[done : i + 1] - begins[done])
                parts.append(ids)
            if i < n:
                parts.append(np.array(self._whole([raw[begins[i] : begins[i + 1]].decode()])[0], np.uint32))
                sizes[i] = len(parts[-1])
            done = i + 1
        return np.concatenate(parts), sizes

    def _by_pieces(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(begins) - 1, np.int64)
        starts = self._starts(data, begins)
        offsets = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        at = pieces.indices.to_numpy()
        own = self._piece_ids(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        begin = np.concatenate(([0], np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) // 4)))
        sizes = np.diff(begin)[at]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.frombuffer(b"".join(own), np.uint32)[np.repeat(begin[at] - upto[:-1], sizes) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.searchsorted(starts, begins)])


def byte_letters() -> np.ndarray:
    """The code points by which byte-level vocabularies write bytes: those that print stand for themselves, the others follow from U+0100
    on. The byte 0xFF, which no text holds, is a space."""
    letters = np.arange(256, dtype="<u4")
    other = np.array([b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or 0xAE <= b)])
    letters[other] = 0x100 + np.arange(len(other))
    letters[0xFF] = 0x20
    return letters


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder per worker and tokenizer file."""
    key = (path, special_as_text)
    if key not in _encoders:
        words.release()  # tables of earlier tasks of other kinds
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def task_ends() -> None:
    """Forget the memos: workers take turns, and an executor may have more of them than cores, so each would keep one while it waits."""
    for each in _encoders.values():
        each.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()


def encoded(texts: pa.Array, path: str, end_id: int, special_as_text: bool = False):
    """(first row, row after the last, ids with an end id after each text, ids per text) of consecutive slices."""
    _, begins = flat(texts)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(begins, begins[row] + ENCODE_BYTES, side="right")) - 1)
        stop = min(stop, len(texts))
        ids, sizes = encoder(path, special_as_text).encode(texts.slice(row, stop - row))
        ends = np.cumsum(sizes + 1) - 1
        out = np.empty(len(ids) + len(sizes), np.uint32)
        inner = np.ones(len(out), bool)
        inner[ends] = False
        out[ends] = end_id
        out[inner] = ids
        yield row, stop, out, sizes + 1
        row = stop


# ---- Simple-8b -----------------------------------------------------------------------------------------------------


HALF_BITS = np.maximum(np.frexp(np.arange(1 << 16, dtype=np.float64))[1], 1).astype(np.int8)


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each 32-bit value needs, 1 at least."""
    out, high = HALF_BITS[x & 0xFFFF], x >> 16
    return np.where(high > 0, HALF_BITS[high] + np.int8(16), out) if high.any() else out


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """64-bit words, and per block of ids where its words begin (one more at the end)."""
    n_blocks = -(-len(ids) // block)
    if not n_blocks:
        return np.zeros(0, U), np.zeros(1, np.int32)
    room = block + int(COUNTS[0])
    laid = np.zeros((n_blocks, room), np.uint32)
    padded = np.zeros(n_blocks * block, np.uint32)
    padded[: len(ids)] = ids
    laid[:, :block] = padded.reshape(n_blocks, block)
    # the selector of a word that would begin at each place: the most ids that fit. Widest ids of ever longer stretches
    # come from those of two shorter ones
    best = np.full((n_blocks, block), ESCAPE, np.int8)
    widest = {1: _bits(laid)}
    for s in range(len(COUNTS) - 1, -1, -1):
        count = int(COUNTS[s])
        half = max(c for c in widest if c < count)
        rest = min(c for c in widest if c + half >= count)
        widest[count] = np.maximum(widest[half][:, : room - count + 1], widest[rest][:, count - rest : room - rest + 1])
        np.copyto(best, s, where=widest[count][:, :block] <= WIDTHS[s])
    step = np.ones(16, np.int64)
    step[: len(COUNTS)] = COUNTS
    sizes = np.full(n_blocks, block)
    sizes[-1] = len(ids) - (n_blocks - 1) * block
    # all blocks walk from word to word together
    at, alive, begins = np.zeros(n_blocks, np.int64), np.arange(n_blocks), np.zeros((n_blocks, block), bool)
    while len(alive):
        begins[alive, at[alive]] = True
        at[alive] += step[best[alive, at[alive]]]
        alive = alive[at[alive] < sizes[alive]]
    row, col = np.nonzero(begins)
    chosen = best[row, col]
    words = chosen.astype(U) << U(60)
    place, values = row * room + col, laid.reshape(-1)
    for s in np.unique(chosen):
        own = np.flatnonzero(chosen == s)
        count, width = (1, 32) if s == ESCAPE else (int(COUNTS[s]), int(WIDTHS[s]))
        word, first = words[own], place[own]
        for j in range(count):
            word |= values[first + j].astype(U) << U(j * width)
        words[own] = word
    return words, np.searchsorted(row, np.arange(n_blocks + 1)).astype(np.int32)


def unpack(words: np.ndarray, offsets: np.ndarray, n_ids: int, block: int = BLOCK) -> np.ndarray:
    """The ids; any run of blocks can be given, with its own offsets."""
    selector = (words >> U(60)).astype(np.int64)
    step = np.ones(16, np.int64)
    step[: len(COUNTS)] = COUNTS
    held = step[selector]
    upto = np.concatenate(([0], np.cumsum(held)))
    n_blocks = len(offsets) - 1
    of = np.repeat(np.arange(n_blocks), np.diff(offsets))
    room = block + int(COUNTS[0])
    place = of * room + upto[:-1] - upto[offsets[:-1]][of]
    out = np.zeros(n_blocks * room, np.uint32)
    for s in np.unique(selector):
        own = np.flatnonzero(selector == s)
        count, width = (1, 32) if s == ESCAPE else (int(COUNTS[s]), int(WIDTHS[s]))
        for j in range(count):
            out[place[own] + j] = (words[own] >> U(j * width)) & U((1 << width) - 1)
    return np.ascontiguousarray(out.reshape(n_blocks, room)[:, :block]).reshape(-1)[:n_ids]


# ---- files ---------------------------------------------------------------------------------------------------------


def write_tokens(
    docs: DataFrame, folder: str, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID,
    chunk_ids: int = CHUNK_IDS,
) -> None:
    """Token files of ``docs`` in ascending ``doc_id`` order (missing ids first, rows that repeat an id by text).

    A missing or empty text is only the end id. A text longer than a chunk has a chunk of its own. An empty table
    writes an empty folder that can be read.
    """
    path = tokenizer or default_tokenizer()

    def run(batches):
        part, chunk = TaskContext.get().partitionId(), 0
        ids, doc_ids, sizes, held = [], [], [], 0

        def row():
            whole = np.concatenate(ids)
            words, offsets = pack(whole)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([len(whole)], pa.int64()),
                 pa.array([list(chain.from_iterable(doc_ids))], pa.list_(pa.int64())), pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
                 pa.array([offsets], pa.list_(pa.int32())), pa.array([words.astype("<u8").tobytes()], pa.binary())],
                names=["part", "chunk", "n_ids", "doc_ids", "doc_tokens", "offsets", "payload"],
            )

        for batch in batches:
            for a, b, own, counts in encoded(batch.column(1), path, end_id):
                ids.append(own)
                doc_ids.append(batch.column(0).slice(a, b - a).to_pylist())
                sizes.append(counts)
                held += len(own)
                if held >= chunk_ids:
                    yield row()
                    chunk, ids, doc_ids, sizes, held = chunk + 1, [], [], [], 0
        if ids:
            yield row()
        ids = []
        task_ends()

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = chosen.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(folder)


def read_tokens(spark, folder: str) -> DataFrame:
    """One row per document in file order: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Starts come from the chunk totals alone: a running sum over the chunks of each part, and over the parts.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row per writing task
    before = parts.select(F.col("part").alias("_p"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select("part", "chunk", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("_inside"))
    starts = begins.join(before, F.col("part") == F.col("_p")).select(F.col("part").alias("_p"), F.col("chunk").alias("_c"), (F.col("_before") + F.col("_inside")).alias("start"))
    content = files.select("part", "chunk", "n_ids", "doc_ids", "doc_tokens", "offsets", "payload").mapInArrow(_digests, "part int, chunk int, doc_id long, at long, n_tokens long, ids_crc32 long")
    joined = content.join(starts, (F.col("part") == F.col("_p")) & (F.col("chunk") == F.col("_c")))
    return joined.select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _digests(batches):
    """Decodes the chunks and returns what they hold of each document; ``at`` counts from the chunk's first id."""
    for batch in batches:
        for row in range(batch.num_rows):
            part, chunk, n_ids, doc_ids, sizes, offsets, payload = (batch.column(i)[row] for i in range(7))
            ids = unpack(np.frombuffer(payload.as_buffer(), "<u8"), offsets.values.to_numpy(), n_ids.as_py())
            raw = ids.astype("<u4", copy=False).tobytes()
            sizes = sizes.values.to_numpy()
            at = np.concatenate(([0], np.cumsum(sizes)))
            cut = (at * 4).tolist()
            view = memoryview(raw)
            crc = [zlib.crc32(view[a:b]) for a, b in zip(cut, cut[1:])]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part.as_py()), pa.int32()), pa.array(np.full(n, chunk.as_py()), pa.int32()), doc_ids.values,
                 pa.array(at[:-1], pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                names=["part", "chunk", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_ids(spark, folder: str) -> DataFrame:
    """doc_id and the ids themselves (with the end id), one row per document."""
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                _, _, n_ids, doc_ids, sizes, offsets, payload = (batch.column(i)[row] for i in range(7))
                ids = unpack(np.frombuffer(payload.as_buffer(), "<u8"), offsets.values.to_numpy(), n_ids.as_py())
                at = np.concatenate(([0], np.cumsum(sizes.values.to_numpy()))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int64)))], names=["doc_id", "ids"]
                )

    return spark.read.schema(FILE_SCHEMA).parquet(folder).mapInArrow(run, "doc_id long, ids array<long>")


def token_index(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes the files (in a new folder under the shared one if none is given) and reads them back."""
    folder = folder or f"{checkpoint_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, **options)
    return read_tokens(docs.sparkSession, folder)
