"""SentencePiece encoding and decoding with byte spans of the original text.

A model's normaliser rewrites the text before it is cut into pieces: the
longest prefix found in the compiled character map (a double-array trie and
a pool of replacements) is replaced, white space is escaped and a dummy
prefix may be added.  ``Normalizer`` does that and records, for every byte of
the normalised text, the byte of the original it came from; a piece's place
in the normalised text then gives its span of original bytes.

Ids are exactly the library's.  Where the model allows it (no character map,
no user-defined pieces, no piece with a space after another character), a
text decomposes at its spaces and every distinct word is encoded once; other
models encode whole texts.

Defined results: a null text is empty; an empty text has the end id alone, no
span and decodes to the empty text; rows keep their order and number; columns
besides those named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import small_batches, text_of

SPACE = "▁"
CACHE_WORDS = 200_000
CACHE_CHARS = 48
ARRAYS = ("ids", "span_start", "span_end")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of a protobuf message."""
    def varint(i):
        value = shift = 0
        while True:
            byte = data[i]
            value |= (byte & 127) << shift
            shift, i = shift + 7, i + 1
            if byte < 128:
                return value, i
    i = 0
    while i < len(data):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            n, i = {1: lambda: (8, i), 5: lambda: (4, i), 2: lambda: varint(i)}[key & 7]()
            value, i = data[i:i + n], i + n
        yield key >> 3, value


class Normalizer:
    """A model's normaliser, with the source of every byte it puts out."""

    def __init__(self, model: bytes):
        top = list(_fields(model))
        spec = dict(chain.from_iterable(_fields(v) for k, v in top if k == 3))
        trainer = dict(chain.from_iterable(_fields(v) for k, v in top if k == 2))
        blob = spec.get(2, b"")
        self.dummy, self.squeeze, self.escape = bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
        self.suffix = bool(trainer.get(24, 0))
        self.pieces = [dict(_fields(v)) for k, v in top if k == 1]
        self.units, self.pool = np.empty(0, "<u4"), b""
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units, self.pool = np.frombuffer(blob[4:4 + size], "<u4").tolist(), blob[4 + size:]
        self.user = [p[1] for p in self.pieces if p.get(3, 1) == 4]
        self.identity = not blob and not self.user and not self.squeeze and self.escape and not self.suffix

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest mapped prefix of ``text[at:]``."""
        if not len(self.units):
            return None
        units, found = self.units, None
        node = units[0] >> 10 << ((units[0] >> 6) & 8)
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= unit >> 10 << ((unit >> 6) & 8)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        return found and (found[0], self.pool[found[1]:self.pool.index(0, found[1])])

    def _parts(self, text: bytes) -> Iterator[tuple[int, int, bytes]]:
        """Start, end and replacement of each step through the original."""
        at = 0
        while at < len(text):
            user = max((u for u in self.user if text.startswith(u, at)), key=len, default=b"")
            if user:
                n, new = len(user), user
            elif hit := self.longest(text, at):
                n, new = hit
            else:
                n = 1 if text[at] < 0xC0 else 2 if text[at] < 0xE0 else 3 if text[at] < 0xF0 else 4
                new = text[at:at + n]
            yield at, at + n, new
            at += n

    def normalize(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and the original byte of each of its bytes (one entry more, the end)."""
        space = SPACE.encode() if self.escape else b" "
        if self.identity:
            source = np.frombuffer(text, np.uint8)
            align = np.repeat(np.arange(len(source), dtype=np.int32), np.where(source == 32, 3, 1))
            head = len(space) if self.dummy and text else 0
            return (space if head else b"") + text.replace(b" ", space), np.concatenate([np.zeros(head, np.int32), align, [len(text)]]).astype(np.int32)
        out, align = bytearray(), []
        parts = list(self._parts(text))
        first, last = 0, len(parts)
        if self.squeeze:
            while first < last and parts[first][2] == b" ":
                first += 1
        if first == last:
            return b"", np.zeros(1, np.int32)
        start = parts[first][0]
        if self.dummy and not self.suffix:
            out += space
            align += [start] * len(space)
        after_space = self.squeeze
        end = start
        for a, b, new in parts[first:last]:
            if self.squeeze and after_space:
                new = new.lstrip(b" ")
            if new:
                for byte in new:
                    piece = space if byte == 32 else bytes([byte])
                    out += piece
                    align += [a] * len(piece)
                after_space = self.squeeze and new.endswith(b" ")
                end = b
        if self.squeeze:
            while out.endswith(space):
                end = align[len(out) - len(space)]
                del out[-len(space):], align[-len(space):]
        if self.dummy and self.suffix:
            out += space
            align += [end] * len(space)
        return bytes(out), np.array([*align, end], np.int32)


class Pieces:
    """One model in one worker: ids, spans and decoding."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            self.normalizer = Normalizer(f.read())
        pieces = self.normalizer.pieces
        self.length = np.array([1 if p.get(3, 1) == 6 else len(p[1]) for p in pieces], np.int32)
        self.unknown = self.model.unk_id()
        inner = any(SPACE in p[1].decode().lstrip(SPACE) for p in pieces if p.get(3, 1) in (1, 4))
        self.by_word = self.normalizer.identity and self.normalizer.dummy and not inner
        self.known: dict[str, tuple[list[int], str]] = {}

    def words(self, text: str) -> list[str]:
        """What stands behind the first space of every run of spaces and the characters after it."""
        words = text.split(" ")
        if SPACE in text or "" in words:
            return [w[1:] for w in re.findall(f"[ {SPACE}]+[^ {SPACE}]*", " " + text)]
        return words

    def encode(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """Ids of each text, and the same as decimal numbers joined by one space."""
        if not self.by_word:
            return [(ids, " ".join(map(str, ids))) for ids in self.model.encode(texts, num_threads=1)]
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        known, split = self.known, [self.words(t) if t else [] for t in texts]
        new = list({w for words in split for w in words if w not in known})
        for w, ids in zip(new, self.model.encode(new, num_threads=1) if new else []):
            # a word that is empty stands for one escaped space, to which the library adds nothing
            known[w] = (ids, " ".join(map(str, ids))) if w else self._space()
        out = []
        for words in split:
            found = [known[w] for w in words]
            out.append((list(chain.from_iterable([f[0] for f in found])), " ".join([f[1] for f in found])))
        for w in new:
            if len(w) > CACHE_CHARS:
                del known[w]
        return out

    def _space(self) -> tuple[list[int], str]:
        ids = self.model.encode("a ")[len(self.model.encode("a")):]
        return ids, " ".join(map(str, ids))

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every piece in the bytes of the original text."""
        normal, align = self.normalizer.normalize(text.encode())
        if self.unknown in ids:
            lengths = [1 if self.length[i] == 1 and p.startswith("<0x") else len(p.encode()) for i, p in zip(ids, self.model.encode(text, out_type=str))]
        else:
            lengths = self.length[np.array(ids, np.int64)]
        ends = np.cumsum(lengths, dtype=np.int64)
        if len(ends) and ends[-1] != len(normal):
            raise ValueError("the pieces don't cover the normalised text")
        return align[ends - np.asarray(lengths)] if len(ends) else ends, align[ends] if len(ends) else ends


_MODELS: dict[str, Pieces] = {}


def _model(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def encode_pieces(docs: DataFrame, model_path: str, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                  arrays: Sequence[str] = ARRAYS) -> DataFrame:
    """Encode every whole text, project the pieces to original bytes and decode again.

    Returns the id columns, n_tokens (with the end id), ids_sha256,
    decoded_sha256, covered_bytes (end of the last span; -1 if the spans don't
    follow one another) and of ids, span_start and span_end those in ``arrays``.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.col(c) for c in id_cols], text_of(text_col).alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]),
                        "n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long"]
                       + [f"{a} array<int>" for a in arrays])
    names = [*id_cols, "n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes", *arrays]
    hexed = lambda text: hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model_path)
        end = pieces.model.eos_id()
        for b in batches:
            texts = [t.decode("utf-8", "replace") for t in b.column(len(id_cols)).cast(pa.binary()).to_pylist()]
            out: list[list] = [[] for _ in range(4 + len(arrays))]
            for text, (ids, decimal) in zip(texts, pieces.encode(texts)):
                starts, ends = pieces.spans(text, ids)
                tiled = not len(ends) or bool((starts[1:] <= ends[:-1]).all())
                ids = [*ids, end]
                covered = (int(ends[-1]) if len(ends) else 0) if tiled else -1
                whole = dict(zip(ARRAYS, (ids, starts, ends)))
                for column, value in zip(out, [len(ids), hexed(f"{decimal} {end}" if decimal else str(end)), hexed(pieces.model.decode(ids)), covered, *[whole[a] for a in arrays]]):
                    column.append(value)
            data = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())]
            data += [pa.array(c, pa.list_(pa.int32())) for c in out[4:]]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(id_cols)], *data], names)

    return rows.mapInArrow(encode, schema)
