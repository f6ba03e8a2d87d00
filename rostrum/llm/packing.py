"""Packing: bounded-space online best-fit of token streams into fixed windows.

Each partition keeps at most ``open_windows`` windows open.  A document's full windows are cut off at
once; what is left goes to the open window in which it leaves least room.  When it fits none, the
fullest window is closed and a new one opened; if closing it would pad more than ``slack`` tokens, the
arriving piece is cut to fill it first.  The windows still open at the end of the partitions are merged:
their pieces follow each other into new windows, and the last one of each group of partitions is
divided into windows of powers of two, which need no padding.

Memory: one batch of texts and ``open_windows`` windows a task; a merging task reads the leftovers in
order and holds a batch of them and one window.  Nothing but those leftovers is shuffled.

Defined cases: a null text counts as the empty one and gives the single closing id; very long texts
are cut into windows; repeated rows are packed each; extra columns are dropped; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import ARROW_ROWS, bounded_batches, materialize, partitions

WINDOW = 2048
#: Partitions whose leftovers follow each other into windows.
MERGE = 8
WIDTH = 4  # bytes of an id, little-endian
_CACHED_WORDS = 200_000
#: Latin letters, then ASCII punctuation.
_PARTS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u024f]+)([!-/:-@\[-`{-~]*)")


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[int, str]:
    """Byte-level tokenizers write a byte that prints as itself, the others, in order, as the characters from
    U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


_BYTE_ALPHABET = _byte_alphabet()


# The settings of a tokenizer file with which texts may be cut into words before they are merged.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


class Encoder:
    """Ids of whole texts by the ``tokenizers`` library, as little-endian 32-bit words.

    A tokenizer whose file has the settings above splits at blanks before it merges, so that a text's ids
    are those of its blank-separated words one after another; a word of Latin letters with punctuation
    after it is split between the two as well, and case does not count.  Words and their parts are kept in
    bounded caches.  Texts that hold an added token's string, and all texts where the file has other
    settings, go through the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        self.added = [t["content"] for t in settings.get("added_tokens") or []]
        cut = {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}
        plain = settings["model"].get("type") == "BPE" and not settings["model"].get("dropout") and not settings.get("truncation") and not settings.get("padding")
        self.by_words = plain and settings.get("normalizer") == _NORMALIZER and settings.get("pre_tokenizer") == cut
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {"": b""}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        if len(self.words) > _CACHED_WORDS:
            self.words = {"": b""}
        if len(self.parts) > _CACHED_WORDS:
            self.parts = {"": b""}
        parts, known, odd = self.parts, self.words, []
        for w in words:
            m = _PARTS.fullmatch(w)
            if not m:
                odd.append(w)
                continue
            letters, rest = m[1].lower(), m[2]
            ids = parts.get(letters)
            if ids is None:
                ids = parts[letters] = self._of_letters(letters)
            if rest:
                if rest not in parts:
                    parts[rest] = self._ids([rest])[0]
                ids += parts[rest]
            known[w] = ids
        known.update(zip(odd, self._ids(odd), strict=True))

    def _of_letters(self, word: str) -> bytes:
        """Ids of a lower-case word of Latin letters: nothing to normalise or split, so straight to the merges,
        on the byte alphabet."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_ALPHABET)
        ids = [t.id for t in self.tokenizer.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return self._ids(texts)
        split = [None if any(a in text for a in self.added) else text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for text in texts]
        seen = set().union(*[w for w in split if w])
        if missing := seen.difference(self.words):
            self._learn(list(missing) if len(self.words) <= _CACHED_WORDS else list(seen))
        known = self.words
        return [b"".join([known[w] for w in words]) if words else self._ids([text])[0] for words, text in zip(split, texts, strict=True)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One a worker process, so that its caches outlive a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Packer:
    """Open windows of one stream.  A piece is (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, first_id: int, window: int, open_windows: int, slack: int):
        self.next_id, self.window, self.limit, self.slack = first_id, window, open_windows, slack
        self.spaces: list[tuple[int, int]] = []  # (room, key), ascending
        self.pieces: dict[int, list] = {}
        self.key = 0

    def add(self, doc_id, ids: bytes) -> Iterator[tuple[int, list]]:
        total, start = len(ids) // WIDTH, 0
        while total - start >= self.window:
            yield self._close([(doc_id, start, ids[start * WIDTH : (start + self.window) * WIDTH], total)])
            start += self.window
        need = total - start
        if not need:
            return
        at = bisect.bisect_left(self.spaces, (need, -1))
        if at == len(self.spaces) and len(self.spaces) >= self.limit:
            room, key = self.spaces.pop(0)
            if room > self.slack:
                self.pieces[key].append((doc_id, start, ids[start * WIDTH : (start + room) * WIDTH], total))
                start, need = start + room, need - room
            yield self._close(self.pieces.pop(key))
            at = bisect.bisect_left(self.spaces, (need, -1))
        if at == len(self.spaces):
            self.key += 1
            self.spaces.append((self.window, self.key))
            self.pieces[self.key] = []
            at = len(self.spaces) - 1
        room, key = self.spaces.pop(at)
        self.pieces[key].append((doc_id, start, ids[start * WIDTH :], total))
        if room == need:
            yield self._close(self.pieces.pop(key))
        else:
            bisect.insort(self.spaces, (room - need, key))

    def _close(self, pieces: list) -> tuple[int, list]:
        self.next_id += 1
        return self.next_id - 1, pieces

    def leftovers(self) -> Iterator[tuple[int, list]]:
        for _, key in self.spaces:
            yield self._close(self.pieces[key])


def merged(pieces: Iterator[tuple], first_id: int, window: int) -> Iterator[tuple[int, list]]:
    """Windows filled one after another; the last in powers of two."""
    now, room = [], window
    for doc_id, start, ids, total in pieces:
        while ids:
            part, ids = ids[: room * WIDTH], ids[room * WIDTH :]
            now.append((doc_id, start, part, total))
            start, room = start + len(part) // WIDTH, room - len(part) // WIDTH
            if not room:
                yield first_id, now
                now, room, first_id = [], window, first_id + 1
    left = window - room
    while left:
        want = 1 << (left.bit_length() - 1)
        left -= want
        out = []
        while want:
            doc_id, start, ids, total = now.pop(0)
            part, rest = ids[: want * WIDTH], ids[want * WIDTH :]
            out.append((doc_id, start, part, total))
            want -= len(part) // WIDTH
            if rest:
                now.insert(0, (doc_id, start + len(part) // WIDTH, rest, total))
        yield first_id, out
        first_id += 1


_SCHEMA = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, open boolean, stream long"


class _Rows:
    """Rows on their way out, in bounded batches."""

    def __init__(self, kind: pa.DataType, stream: int, with_ids: bool):
        self.kind, self.stream, self.with_ids, self.rows = kind, stream, with_ids, []

    def put(self, sequence: tuple[int, list], is_open: bool = False) -> None:
        number, pieces = sequence
        at = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // WIDTH
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, number, at, ids if is_open or self.with_ids else None, is_open, self.stream))
            at += n

    def batch(self) -> pa.RecordBatch:
        kinds = [self.kind, *[pa.int64()] * 6, pa.binary(), pa.bool_(), pa.int64()]
        names = [f.split()[0] for f in _SCHEMA.split(", ")]
        columns = [pa.array(list(c), k) for c, k in zip(zip(*self.rows, strict=True) if self.rows else [[]] * len(kinds), kinds, strict=True)]
        self.rows = []
        return pa.RecordBatch.from_arrays(columns, names)


def pack(docs: DataFrame, tokenizer_path: Callable[[], str], end_id: int = 1, window: int = WINDOW, open_windows: int = 64, slack: int = 16, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids``
    (little-endian 32-bit) if ``with_ids``.  ``tokenizer_path`` is called where the texts are."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select("doc_id", "text")
    rows_kind = to_arrow_type(rows.schema["doc_id"].dataType)
    schema = _SCHEMA.format(kind=rows.schema["doc_id"].dataType.simpleString())
    end = struct.pack("<I", end_id)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, stream = encoder(tokenizer_path()).encode, TaskContext.get().partitionId()
        packer, out = Packer(stream << 32, window, open_windows, slack), None
        for b in batches:
            out = out or _Rows(b.column("doc_id").type, stream, with_ids)
            ids = encode([t or "" for t in b.column("text").to_pylist()])
            for doc_id, stream_of_ids in zip(b.column("doc_id").to_pylist(), ids, strict=True):
                for sequence in packer.add(doc_id, stream_of_ids + end):
                    out.put(sequence)
            yield out.batch()
        if out:
            for sequence in packer.leftovers():
                out.put(sequence, is_open=True)
            yield out.batch()

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = rows_kind
        pieces = ((r["stream"] // MERGE, (r["doc_id"], r["start"], r["ids"], r["doc_tokens"])) for b in batches for r in b.to_pylist())
        for group, own in itertools.groupby(pieces, key=lambda p: p[0]):  # sorted: the pieces of a group stand together
            out = _Rows(kind, group, with_ids)
            for sequence in merged((p for _, p in own), (1 << 62) | (group << 32), window):
                out.put(sequence)
                if len(out.rows) >= ARROW_ROWS:
                    yield out.batch()
            yield out.batch()

    done = materialize(rows.mapInArrow(first, schema), "pack")
    left = done.where("open").repartition(partitions(spark), F.floor(F.col("stream") / MERGE)).sortWithinPartitions("stream", "sequence_id", "offset")
    out = done.where(~F.col("open")).unionByName(left.mapInArrow(second, schema)).drop("open", "stream")
    return out if with_ids else out.drop("ids")
