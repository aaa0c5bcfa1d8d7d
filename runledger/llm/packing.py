"""Best-fit packing of documents into sequences, by minimum bin slack.

1. ``token_pieces`` encodes every document whole, appends the end id and cuts
   only documents longer than a sequence, into full pieces (the first may be
   shorter).  Each piece carries the task that made it and its number among
   that task's pieces of the same length.
2. Only lengths decide how pieces fit, so the pieces are counted by length:
   a histogram of at most ``capacity`` rows, whatever the size of the corpus.
3. ``fill_patterns`` applies minimum bin slack to the histogram.  For each bin
   a bitset holds which sums the available lengths reach (bounded subset-sum
   dynamic programming, each length as often as it is left); the largest sum
   within the capacity is the fullest bin.  Each bin starts from the largest
   piece left, as that is the hardest to place later, and prefers large pieces
   among combinations of equal sum.  So that small pieces aren't used up early,
   a bin takes no more pieces than pieces of the average length that is left would
   fill it; the packing without that bound is kept if it needs fewer bins.  The combination is removed as many times
   as the pieces last, since it stays the fullest while it is feasible; so the
   number of programs depends on the number of lengths, not on the pieces.
4. ``pack`` numbers the pieces of each length across tasks (counts per task and
   length, prefix sums) and reads sequence and offset off the patterns.

Defined results: a null text is empty; an empty text is the end id alone;
repeated rows and ids are documents of their own; equal lengths are placed in
the order in which tasks made them; an empty table has no pieces; columns
besides id and text are ignored.  Documents are never dropped or cut short; a
text of any length is encoded whole by one task.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.blocks import batch_rows
from runledger.llm.common import stored, text_of

#: Entries of a worker's cache of encoded words (about 200 bytes each), and the longest word it keeps.
CACHE_WORDS, CACHE_CHARS = 800_000, 48
#: White space as the splitters of byte-level tokenizers have it.
_SPACE = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_WORDS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_ENDS = re.compile(f"[{_SPACE}]\\Z")
#: What may end a word: ASCII signs but < > | of added tokens, and the apostrophe of contractions.
_TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
#: A piece of the splitter, a space or none and Latin letters, and what ends its word.
_LETTERS = re.compile(f"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([{re.escape(_TAIL)}]*)")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"


def _byte_letters() -> dict[int, str]:
    """Byte-level letters by byte: printable bytes stand for themselves, the others for the characters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Encodes whole texts word by word, each distinct word once while it is cached.

    A byte-level splitter never lets a token cross from a character into white
    space after it, so a word with the white space before it encodes on its
    own; nor from a letter or digit into a sign, so signs at a word's end do
    too.  Words of Latin letters go to the model directly.  Texts are cut
    before every space and line end; pieces that hold other white space are put
    together from their words, and a text with white space before a cut is cut
    into words as a whole.  Where the tokenizer's settings or a probe differ, texts
    are encoded whole.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer
        self.tokenizer, self.known, self.older = Tokenizer.from_file(path), {}, {}
        conf = json.loads(self.tokenizer.to_str())
        split, added = conf.get("pre_tokenizer") or {}, conf.get("added_tokens") or []
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.letters = _byte_letters()
        self.by_word = (split.get("type"), split.get("add_prefix_space"), split.get("use_regex", True)) == ("ByteLevel", False, True) and not conf.get("normalizer") \
            and not conf.get("truncation") and not conf.get("padding") and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(f"[{_SPACE}]|[A-Za-z0-9]$", a["content"]) for a in added)
        probe = " The ends, na\u00efve \u0141\u00f3d\u017a... and\ta(b)  it's [x]!?"
        self.by_word = self.by_word and self.encode([probe]) == self._encode([probe])

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: set[str]) -> list[str]:
        """Put words into the cache: from the older half, put together from words or core and tail, by the model, or by the whole tokenizer.

        A piece that ends in white space has no ids of its own.  Returns what was looked at."""
        known, older, tokenize, letters, fits = self.known, self.older, self.tokenizer.model.tokenize, self.letters, _LETTERS.fullmatch
        code, whole, joined = "H" if self.dtype.itemsize == 2 else "I", {}, []
        todo = list(words)
        for w in todo:  # grows by the parts of words
            if w in known:
                continue
            if w in older:
                known[w] = older[w]
            elif found := fits(w):
                core, tail = found.groups()
                ids = known.get(core) or older.get(core)
                if ids is None:
                    mapped = "\u0120" + core[1:] if core[0] == " " else core
                    if not core.isascii():
                        mapped = core.encode("utf-8").decode("latin-1").translate(letters)
                    ids = array(code, [t.id for t in tokenize(mapped)]).tobytes()
                    if len(core) <= CACHE_CHARS:
                        known[core] = ids
                if tail and tail not in known:
                    known[tail] = self._encode([tail])[0]
                known[w] = ids + known[tail] if tail else ids
            elif _ENDS.search(w):
                known[w] = None
            else:
                core, parts = w.rstrip(_TAIL), _WORDS.findall(w)
                if len(parts) != 1:
                    joined.append((w, parts))
                    todo += parts
                elif core != w and core[-1:].isalnum():
                    joined.append((w, (core, w[len(core):])))
                    todo += joined[-1][1]
                else:
                    whole[w] = None
        whole = list(whole)
        for i in range(0, len(whole), 4096):
            known.update(zip(whole[i:i + 4096], self._encode(whole[i:i + 4096])))
        for w, parts in reversed(joined):  # parts come after what they are parts of
            known[w] = b"".join(map(known.__getitem__, parts))
        return todo

    def _word_by_word(self, text: str) -> bytes:
        words = _WORDS.findall(text)
        end = self._encode([words.pop()])[0] if words and _ENDS.search(words[-1]) else b""
        seen = self._learn(set(words).difference(self.known))
        out = b"".join(map(self.known.__getitem__, words)) + end
        self._forget(seen)
        return out

    def _forget(self, words: list[str]) -> None:
        for w in words:
            if len(w) > CACHE_CHARS:
                self.known.pop(w, None)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of ``dtype``."""
        if not self.by_word:
            return self._encode(texts)
        if len(self.known) > CACHE_WORDS // 2:
            self.known, self.older = {}, self.known
        # the cut is marked by a zero character; a text that has one is cut into words
        split = [[" "] if "\0" in t else t.replace(" ", "\0 ").replace("\n", "\0\n").split("\0") for t in texts]
        seen = self._learn(set().union(*split).difference(self.known))
        known, out = self.known, []
        for pieces in split:
            try:
                out.append(b"".join(map(known.__getitem__, pieces)))
            except TypeError:  # a piece without ids
                out.append(None)
        self._forget(seen)
        return [self._word_by_word(t) if ids is None else ids for t, ids in zip(texts, out)]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored pieces (PIECES) of all documents; ``ids`` are little-endian unsigned 32-bit integers."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, made = _encoder(tokenizer_path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            out = []
            for doc_id, raw in zip(b.column(0).to_pylist(), encoder.encode(b.column(1).to_pylist())):
                ids = np.frombuffer(raw, encoder.dtype).astype("<u4").tobytes() + end
                n = len(ids) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, z) in enumerate(zip(edges, edges[1:])):
                    own = ids[4 * a:4 * z]
                    out.append((doc_id, k, a, z - a, zlib.crc32(own), own, part, made[z - a]))
                    made[z - a] += 1
            if out:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [c.split()[0] for c in PIECES.split(", ")])

    with batch_rows(docs.sparkSession, 256):
        return stored(rows.mapInArrow(cut, PIECES), "pieces")


@dataclass
class Pattern:
    """A bin's lengths with how often each occurs, largest first, and how many bins are filled so."""
    lengths: dict[int, int]
    bins: int


def fullest(left: dict[int, int], room: int, most: int | None = None) -> dict[int, int]:
    """The lengths (with counts) of a largest sum within ``room`` of at most ``most`` pieces; larger lengths are preferred.

    Dynamic programming over bitsets of sums: one bitset per number of pieces, or a single one without ``most``.
    """
    within, levels, steps = (1 << room + 1) - 1, most or 0, []
    reached = [1] + [0] * levels
    for length in sorted(left):  # walked back from the largest
        copies = min(left[length], room // length, most or room)
        times = 1
        while copies > 0:  # 1, 2, 4, ... copies at once, and the rest
            now = min(times, copies)
            steps.append((length, now, list(reached)))
            if most is None:
                reached[0] |= reached[0] << length * now & within
            else:
                for j in range(levels, now - 1, -1):
                    reached[j] |= reached[j - now] << length * now & within
            copies, times = copies - now, times * 2
    total = max(r.bit_length() for r in reached) - 1
    used = next(j for j, r in enumerate(reached) if r >> total & 1)
    out: dict[int, int] = {}
    for length, now, before in reversed(steps):
        j = used if most is None else used - now
        if total >= length * now and j >= 0 and before[j] >> total - length * now & 1:
            out[length] = out.get(length, 0) + now
            total, used = total - length * now, j
    return out


#: Where a bin would hold more pieces of the average length, their number isn't bounded.
BOUNDED = 24


def _fill(histogram: dict[int, int], capacity: int, controlled: bool) -> list[Pattern]:
    left, out = {n: c for n, c in histogram.items() if c > 0}, []
    while left:
        largest = max(left)
        rest = {n: c - (n == largest) for n, c in left.items() if n <= capacity - largest and c > (n == largest)}
        most = capacity * sum(left.values()) // sum(n * c for n, c in left.items()) - 1 if controlled else BOUNDED + 1
        own = fullest(rest, capacity - largest, max(1, most) if most <= BOUNDED else None) if rest else {}
        own[largest] = own.get(largest, 0) + 1
        bins = min(left[n] // c for n, c in own.items())
        out.append(Pattern(dict(sorted(own.items(), reverse=True)), bins))
        for n, c in own.items():
            left[n] -= c * bins
            if not left[n]:
                del left[n]
    return out


def fill_patterns(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Bins for all pieces of a histogram (length -> pieces), by minimum bin slack with and without a bound on a bin's pieces."""
    return min((_fill(histogram, capacity, c) for c in (True, False)), key=lambda patterns: sum(p.bins for p in patterns))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """The pieces with sequence_id and offset, from (length, part, nth and any other columns)."""
    spark = pieces.sparkSession
    counts = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    # per length one row a task: the window's groups hold as many rows as there are tasks
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "length", "base")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    patterns = fill_patterns(histogram, capacity)

    # per length, which pattern takes its next pieces: runs of (number of the first, first sequence, pieces a bin, offset in the bin)
    taken: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for p in patterns:
        offset = 0
        for n, c in p.lengths.items():
            taken.setdefault(n, []).append((used.get(n, 0), sequence, c, offset))
            used[n] = used.get(n, 0) + c * p.bins
            offset += n * c
        sequence += p.bins
    runs = {n: np.array(rows, np.int64) for n, rows in taken.items()}
    columns = [c for c in pieces.columns if c not in ("part", "nth")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            ids, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                at, run = np.flatnonzero(length == n), runs[n]
                own = run[np.searchsorted(run[:, 0], number[at], "right") - 1]
                nth = number[at] - own[:, 0]
                ids[at], offsets[at] = own[:, 1] + nth // own[:, 2], own[:, 3] + nth % own[:, 2] * n
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], pa.array(ids), pa.array(offsets)], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name in columns)
    numbered = pieces.join(bases, ["part", "length"]).withColumn("number", F.col("base") + F.col("nth")).select(*columns, "number")
    return numbered.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, doc_ids, lengths and ids (little-endian unsigned 32-bit) of every sequence, from pieces packed with their ids."""
    every = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("all"))  # a sequence holds at most ``capacity`` pieces
    return every.select("sequence_id", F.col("all.doc_id").alias("doc_ids"), F.col("all.length").alias("lengths"), F.aggregate("all.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))
