"""Token-ID / binary output: flat unsigned integer files with 64-bit offsets.

``write_tokens`` deals the documents out in ascending id order, encodes each
part in one task and writes three flat little-endian files per part:

``part-N.bin``   token ids, ``uint16`` if the vocabulary fits, else ``uint32``
``part-N.idx``   ``uint64`` offsets of the documents in the part, one more than documents
``part-N.doc``   ``int64`` document ids (null ids come first; the manifest counts them)

The manifest (Parquet, one row per part) carries each part's counts and its
base: the tokens and documents of all parts before it, by a prefix sum over
the parts.  A document's position in the whole corpus is base + offset.
``read_tokens`` memory-maps the files, part by part, and never loads a part
whole.  The files go to a folder all executors share; a task writes under a
name of its own and renames, and a repeated task writes the same bytes, so
lost executors and speculative copies do no harm.

Defined results: a null text is empty; an empty text has the end id alone;
null ids sort first; rows repeated in the input are repeated in the files
(ties in order of the text); an empty table has no files and an empty
manifest.  Columns besides id and text are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runledger.llm.common import small_batches, text_of
from runledger.session import fresh_dir

#: Entries of a worker's word cache (about 200 bytes each), and the longest word it keeps.
CACHE_WORDS = 1_000_000
CACHE_BYTES = 48
#: ASCII punctuation that may end a word; without the apostrophe, which opens contractions, and what added tokens are made of.
TAIL = b'!"#$%&()*+,-./:;=?@[\\]^_`{}~'
READ_DOCS = 4096

MANIFEST = "part long, n_docs long, n_null long, n_tokens long, width int"


def word_separable(tokenizer) -> bool:
    """Whether no token can span ASCII white space, so that words encode on their own.

    True when the tokenizer's splitter keeps white space out of every piece and
    no added token holds or strips any; tested on a probe beside the settings.
    """
    import json
    conf = json.loads(tokenizer.to_str())
    added = conf.get("added_tokens") or []
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] or any(c.isspace() for c in a["content"]) for a in added):
        return False
    if conf.get("post_processor") or tokenizer.truncation or tokenizer.padding:
        return False
    one = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    probe = ["a", "It's", "éa", "12", "...", "中", "x-1", "THE!!", "é"]
    joined = " \t\n ".join([*probe, *reversed(probe)])
    return one(joined) == [i for w in [*probe, *reversed(probe)] for i in one(w)]


class WordCache:
    """Encodes texts by their words, each distinct word once while it is cached.

    Probes of the tokenizer decide how far a word may be taken apart: lower-cased
    first, cut before its final punctuation, and given to the model at once if
    it is all letters.  A tokenizer that fails a probe takes the longer way.
    """

    def __init__(self, tokenizer, dtype):
        self.tokenizer, self.dtype, self.known = tokenizer, dtype, {}
        self.by_word = word_separable(tokenizer)
        one = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
        model = lambda t: [x.id for x in tokenizer.model.tokenize(t)]
        words = ["a", "the", "word", "thereof", "zq", "internationalisation"]
        self.lower = self.by_word and all(one(w.upper()) == one(w) and one(w.upper() + "É1") == one(w + "É1") for w in words)
        self.cuts = self.by_word and all(one(w + t) == one(w) + one(t) for w in [*words, "x1", "12", "é2"] for t in [".", ",", "!!", ")].", *map(chr, TAIL)])
        self.letters = self.by_word and all(model(w) == one(w) for w in words)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        out = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in out]

    def _words(self, words: list[bytes]) -> list[bytes]:
        out, tokenize, rest = [b""] * len(words), self.tokenizer.model.tokenize, []
        for i, w in enumerate(words):
            if self.letters and w.isalpha() and w.islower():  # of bytes: ASCII letters only
                out[i] = np.array([t.id for t in tokenize(w.decode())], self.dtype).tobytes()
            else:
                rest.append(i)
        for i in range(0, len(rest), 2000):
            for k, ids in zip(rest[i:i + 2000], self._encode([words[k] for k in rest[i:i + 2000]])):
                out[k] = ids
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._encode(texts)
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        known = self.known
        split = [(t.lower() if self.lower and b"<|" not in t else t).split() for t in texts]
        new = {w for words in split for w in words if w not in known}
        parts = {}
        if self.cuts:
            for w in new:
                core = w.rstrip(TAIL)
                if core != w and core[-1:].isalnum():
                    parts[w] = core, w[len(core):]
        plain = {w for w in new if w not in parts} | {p for pair in parts.values() for p in pair if p not in known}
        plain = list(plain)
        known.update(zip(plain, self._words(plain)))
        for w, (core, tail) in parts.items():
            known[w] = known[core] + known[tail]
        out = [b"".join([known[w] for w in words]) for words in split]
        for w in [w for w in (*plain, *parts) if len(w) > CACHE_BYTES]:
            del known[w]
        return out


_ENCODERS: dict = {}


def _encoder(path: str) -> WordCache:
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        _ENCODERS[path] = WordCache(t, np.dtype("<u2" if t.get_vocab_size() <= 1 << 16 else "<u4"))
    return _ENCODERS[path]


def _file_system(folder: str):
    """pyarrow's file system of a shared folder: local mounts, HDFS and object stores alike."""
    from pyarrow import fs
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


class _Part:
    """The three files of one part; they get their final names when the part is whole."""

    def __init__(self, folder: str, part: int):
        self.fs, self.root = _file_system(folder)
        self.part, self.mark = part, uuid.uuid4().hex
        self.fs.create_dir(self.root, recursive=True)
        self.out = {k: self.fs.open_output_stream(self._name(k, self.mark)) for k in ("bin", "idx", "doc")}

    def _name(self, kind: str, mark: str = "") -> str:
        return f"{self.root}/{'_' + mark + '-' if mark else ''}part-{self.part:06d}.{kind}"

    def close(self) -> None:
        for kind, f in self.out.items():
            f.close()
            self.fs.move(self._name(kind, self.mark), self._name(kind))


def write_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 1, folder: str | None = None) -> str:
    """Encode and write all documents; returns the folder with files and manifest."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or fresh_dir(spark, "tokens")
    files = f"{folder}/files"
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at, n_null, n_docs = _encoder(tokenizer_path), None, 0, 0, 0
        end = np.array([end_id], encoder.dtype).tobytes()
        width = encoder.dtype.itemsize
        for b in batches:
            if part is None:
                part = _Part(files, TaskContext.get().partitionId())
                part.out["idx"].write(np.array([0], "<u8").tobytes())
            ids, texts = b.column(0), b.column(1).cast(pa.binary()).to_pylist()
            tokens = [t + end for t in encoder.encode(texts)]
            offsets = at + np.cumsum([len(t) // width for t in tokens], dtype=np.uint64)
            at = int(offsets[-1]) if len(tokens) else at
            part.out["bin"].write(b"".join(tokens))
            part.out["idx"].write(offsets.astype("<u8").tobytes())
            part.out["doc"].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_null, n_docs = n_null + ids.null_count, n_docs + len(tokens)
        if part is not None:
            part.close()
            yield pa.RecordBatch.from_pydict({"part": [part.part], "n_docs": [n_docs], "n_null": [n_null], "n_tokens": [at], "width": pa.array([width], pa.int32())})

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/counts")
    # One row per part, whose number the partition count bounds: the window's single task holds that many rows.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = spark.read.schema(MANIFEST).parquet(f"{folder}/counts")
    counts.select("*", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"),
                  F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("doc_base")).write.parquet(f"{folder}/manifest")
    return folder


def _mapped(fs, path: str, dtype) -> np.ndarray:
    """A memory map of a flat file, or the file's bytes where the store can't be mapped."""
    if fs.type_name == "local":
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.readall(), dtype)


def read_tokens(spark: SparkSession, folder: str, digest=None, schema: str | None = None) -> DataFrame:
    """Documents of a folder in corpus order: doc_id, start, n_tokens and what ``digest`` makes of the ids.

    ``digest`` maps a document's ids (numpy, as stored) to one value of the SQL
    type named by ``schema`` ("name type"); by default the ids themselves.
    """
    digest = digest or (lambda ids: ids.astype(np.int64).tolist())
    schema = schema or "ids array<long>"
    files = f"{folder}/files"
    manifest = spark.read.schema(f"{MANIFEST}, base long, doc_base long").parquet(f"{folder}/manifest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(files)
        for row in (r for b in batches for r in b.to_pylist()):
            name = f"{root}/part-{row['part']:06d}"
            ids, idx, doc = (_mapped(fs, f"{name}.{k}", d) for k, d in (("bin", f"<u{row['width']}"), ("idx", "<u8"), ("doc", "<i8")))
            for i in range(0, row["n_docs"], READ_DOCS):
                edges = idx[i:min(i + READ_DOCS, row["n_docs"]) + 1].astype(np.int64)
                n = len(edges) - 1
                null = np.arange(i, i + n) < row["n_null"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc[i:i + n].astype(np.int64), mask=null), pa.array(edges[:-1] + row["base"]), pa.array(np.diff(edges)),
                    pa.array([digest(ids[a:b]) for a, b in zip(edges[:-1], edges[1:])])], ["doc_id", "start", "n_tokens", schema.split()[0]])

    n = max(1, min(manifest.count(), 10_000))
    return manifest.repartition(n, "part").mapInArrow(read, f"doc_id long, start long, n_tokens long, {schema}")


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
