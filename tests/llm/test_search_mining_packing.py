"""Ranked search, hard negatives and packing, against brute force, on awkward rows and on planted ties."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_tables import nasty_docs, prose
from runledger.llm import best_positions, blocks, packing, registry, residues

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k):
    words = [(d, [w.translate(A_TO_Z) for w in TERM.findall(t or "")]) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    tfs = [(d, Counter(w), len(w)) for d, w in words]
    df = Counter(t for _, c, _ in tfs for t in c)
    out = []
    for item, text in set(items):
        asked, found = [w.translate(A_TO_Z) for w in TERM.findall(text or "")], []
        for d, c, n in tfs:
            m = 25 + (75 * n * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


def test_terms():
    for t in ["", "It's A-B_c É9 naïve", "a\x85b\xa0c　d", "x" * 9, "\x00\x7f1"]:
        assert [w.decode() for w in best_positions.terms_of(t.encode())] == [w.translate(A_TO_Z) for w in TERM.findall(t)]


@pytest.mark.parametrize("shard_docs", [3, 4096])
def test_search_against_brute_force(spark, shard_docs):
    """Hot terms, equal scores, repeated ids and rows, null ids and texts, an item that repeats; every size of shard."""
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(90)] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 w2"), (None, None), (200, ""), (201, "W1, w2!"), (202, "w1 w2 " * 900)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(40)] + [(50, "w1 W2"), (50, "w1 W2"), (51, None), (None, "w2 w2 w1"), (52, "nowhere"), (53, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    index = best_positions.build_index(frame, shard_docs=shard_docs)
    got = best_positions.search(index, spark.createDataFrame(items, "item_id long, text string"), 5).collect()
    assert Counter(tuple(r) for r in got) == brute_search(docs, items, 5)
    assert index.where("term is null").count() >= len(docs) / shard_docs


def test_search_ends_early():
    """A term that only few documents have decides: the long list isn't read to its end."""
    n = 4000
    rows = [{"term": None, "docs": np.arange(n, dtype="<i8").tobytes(), "tfs": np.full(n, 50, "<i4").tobytes(), "missing": bytes(n)},
            {"term": b"common", "docs": np.arange(n, dtype="<u2").tobytes(), "tfs": np.ones(n, "<i4").tobytes()},
            {"term": b"rare", "docs": np.arange(0, 300, 2, dtype="<u2").tobytes(), "tfs": np.arange(150, 0, -1).astype("<i4").tobytes()}]
    lists = best_positions.ImpactLists(rows, n, 50 * n, most_places=1)
    asked = []
    place = lists.place
    lists.place = lambda t: (lambda a: type("Spy", (), {"__getitem__": lambda s, i: asked.append(len(i)) or a[i]})())(place(t))
    docs, score = lists.best([b"common", b"rare"], [10, 5000], 10)
    assert docs.tolist() == list(range(0, 20, 2)) and (np.diff(score) <= 0).all() and sum(asked) / 2 < n / 4


def test_search_over_nasty_tables(spark, nasty):
    docs = [(r[0], r[1]) for r in nasty_docs()]
    item = "Tom has 12 apples and buys 30 more at the market; how many apples has Tom now?"
    rows = registry.QUERIES["op11_best_positions"](spark, nasty).collect()
    assert Counter(tuple(r) for r in rows) == brute_search(docs, [(0, item), (1, None), (2, ""), (3, "too short"), (None, item)], 10)


def brute_negatives(rows):
    """rows: (id, label, integers); as the query has them."""
    anchors = {(i, l, v) for i, l, v in rows if i is not None and i % 100 == 0}
    key, dot, out = (lambda x: (-x[0], x[1] is None, x[1] or 0)), (lambda a, b: sum(x * y for x, y in zip(a, b))), []
    for i, l, v in anchors:
        scored = [(dot(v, w), j, m) for j, m, w in rows if j != i and len(w) == len(v)]
        for s, j, _ in sorted((x for x in scored if x[2] == l), key=key)[:5]:
            inside = sorted((x for x in scored if x[2] != l and 30 * s <= 100 * x[0] <= 90 * s), key=key)[:10]
            out += [(i, j, r, k, s, t) for r, (t, k, _) in enumerate(inside, 1)]
    return Counter(out)


def as_integers(rows):
    out = []
    for i, v, l in rows:
        if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, (l + 1) % 10 if i is not None and i % 7 == 0 else l, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    return out


@pytest.mark.parametrize("cells", [64, 1 << 19])
def test_negatives_against_brute_force(spark, monkeypatch, tmp_path, cells):
    """Ties, repeated rows and ids, nulls everywhere, lengths that don't meet; many chunks and one."""
    monkeypatch.setattr(residues, "CHUNK_CELLS", cells * 8)
    monkeypatch.setattr(residues, "BLOCK_CELLS", 16)
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.3, 1.5]) for _ in range(4)], rng.randint(0, 2)) for i in range(0, 900, 5)]
    rows += [(100, rows[3][1], 1), rows[20], rows[20], (None, [1.0, 0.5, 0.25, 1.0], 1), (1, None, 1), (2, [1.0, 1.0, 1.0, 1.0], None), (3, [1.0, None, 1.0, 1.0], 1), (4, [1.0, float("nan"), 1.0, 1.0], 1),
             (6, [float("inf"), 1.0, 1.0, 1.0], 1), (1000, [0.0] * 4, 0), (1100, [2.0, 1.0], 1), (1101, [1.0, 1.0], 1), (1102, [1.0, 0.25], 2), (1200, [], 1), (1201, [], 1), (1202, [], 0)]
    folder = str(tmp_path / "t")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    got = Counter(tuple(r) for r in registry.QUERIES["op12_hard_negatives"](spark, folder).collect())
    want = brute_negatives(as_integers(rows))
    assert want and got == want


def test_nasty_vectors(spark, nasty):
    rows = registry.QUERIES["op12_hard_negatives"](spark, nasty).collect()
    table = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{nasty}/embeddings.parquet").collect()]
    assert Counter(tuple(r) for r in rows) == brute_negatives(as_integers(table))


@pytest.mark.parametrize("dim, largest", [(1, 1), (5, 3), (64, 700), (64, 10 ** 7), (3000, 10 ** 4), (4, 10 ** 40)])
def test_products_are_exact(dim, largest):
    rng = random.Random(dim)
    a, b = ([[float(rng.randint(-largest, largest)) for _ in range(dim)] for _ in range(n)] for n in (3, 5))
    a[0] = b[0] = [float(largest)] * dim  # the largest product there can be
    b[1] = [float(-largest)] * dim
    primes = residues.primes_for(dim, int(float(largest)))
    got = residues.Residues(np.array(a), primes).times(residues.Residues(np.array(b), primes))
    top = 2 ** 63 - 1
    assert got.tolist() == [[max(-top, min(top, sum(int(x) * int(y) for x, y in zip(u, v)))) for v in b] for u in a]
    assert all(min(dim, residues.SUM) * (p // 2) ** 2 <= 1 << 24 for p in primes)


def test_first_keeps_ties_in_order():
    rng = np.random.default_rng(3)
    for _ in range(200):
        s = rng.integers(-4, 4, rng.integers(0, 90))
        assert residues.first(s, 7).tolist() == sorted(range(len(s)), key=lambda i: (-s[i], i))[:7]


def test_blocks_stream_past_every_shard(spark):
    """A shard without queries, and queries of a shard that isn't there, yield nothing; settings return."""
    import pyarrow as pa
    shards = spark.createDataFrame([(s, x) for s in range(5) for x in range(s)], "shard long, x long")
    asked = blocks.for_each_shard(spark.createDataFrame([(0, 10), (1, 20)], "block long, y long"), spark.createDataFrame([(s, 2 if s != 3 else 0) for s in range(7)], "shard long, blocks long"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with blocks.batch_rows(spark, 2):
        out = blocks.stream_past(shards, asked, 3, lambda rows: sorted(r["x"] for r in rows), lambda xs, q: iter([pa.RecordBatch.from_pydict({"n": [len(xs)], "y": [q["y"]]})]), "n long, y long").collect()
    assert Counter(tuple(r) for r in out) == Counter((n, y) for n in (1, 2, 4) for y in (10, 20))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_words_encode_as_whole_texts():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, lib = packing.Encoder(path), Tokenizer.from_file(path)
    assert own.by_word
    rng = random.Random(6)
    odd = list("aZ9é中. '\t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ᠎  ​   　﻿\U0001F600́") + ["  ", "'s", "'ll", "<|endoftext|>", " <|endoftext|> "]
    texts = ["", " ", "\n\n a", "a \n b  c", "x<|endoftext|>y  "] + ["".join(rng.choices(odd, k=rng.randint(1, 25))) for _ in range(4000)] + [t or "" for _, t, *_ in nasty_docs()]
    for _ in range(2):  # the second time from the cache
        assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(texts)] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def check_packing(rows, docs, capacity, encode):
    """Every document's pieces are whole and in their places; sequences have no gaps."""
    want = Counter()
    for d, t in docs:
        ids, pieces = encode(t or "") + [2], []
        while len(ids) > capacity:
            pieces.append(ids[-capacity:])
            ids = ids[:-capacity]
        at = 0
        for k, p in enumerate([ids, *reversed(pieces)]):
            want[d, k, at, len(p), zlib.crc32(np.array(p, "<u4").tobytes())] += 1
            at += len(p)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_over_nasty_tables(spark, nasty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = registry.QUERIES["op13_packing"](spark, nasty).collect()
    n = check_packing(rows, [(r[0], r[1]) for r in nasty_docs()], 1024, lambda x: t.encode(x, add_special_tokens=False).ids)
    assert n == -(-sum(r.length for r in rows) // 1024)


def test_packed_sequences_hold_the_tokens(spark):
    from tokenizers import Tokenizer
    rng = random.Random(1)
    docs = [(i, prose(rng, rng.choice([1, 3, 8, 20, 45]))) for i in range(300)] + [(1000 + i, "the same words again") for i in range(150)]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.token_pieces(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), public_tokenizers.path("byte_bpe_50k.json"), 64, 2)
    packed = packing.pack(pieces, 64)
    rows = packed.collect()
    n = check_packing(rows, docs, 64, lambda x: t.encode(x, add_special_tokens=False).ids)
    assert n <= 1.01 * sum(r.length for r in rows) / 64 + 1
    of = {}
    for s in packing.sequences(packed).collect():
        ids, at = np.frombuffer(bytes(s.ids), "<u4").tolist(), 0
        for d, k in zip(s.doc_ids, s.lengths):
            of.setdefault(d, []).append(ids[at:at + k])
            at += k
    for d, x in docs:
        assert sorted(i for p in of[d] for i in p) == sorted(t.encode(x, add_special_tokens=False).ids + [2])


def test_fullest_is_the_best_there_is():
    rng = random.Random(2)
    for _ in range(150):
        left = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        room = rng.randint(0, 60)
        sums = {0}
        for n, c in left.items():
            sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= room}
        got = packing.fullest(left, room)
        assert sum(n * c for n, c in got.items()) == max(sums) and all(c <= left[n] for n, c in got.items())
        most, sums = rng.randint(1, 5), {(0, 0)}
        for n, c in left.items():
            sums = {(s + n * k, m + k) for s, m in sums for k in range(c + 1) if s + n * k <= room and m + k <= most}
        got = packing.fullest(left, room, most)
        assert sum(n * c for n, c in got.items()) == max(s for s, _ in sums) and sum(got.values()) <= most and all(c <= left[n] for n, c in got.items())


def test_patterns_use_every_piece_once():
    rng = random.Random(7)
    for capacity, most in ((1024, 100_000), (100, 50), (10, 3), (1, 5)):
        histogram = {n: rng.randint(1, most) for n in rng.sample(range(1, capacity + 1), min(capacity, 200))}
        used = Counter()
        patterns = packing.fill_patterns(histogram, capacity)
        for p in patterns:
            assert sum(n * c for n, c in p.lengths.items()) <= capacity and p.bins > 0
            for n, c in p.lengths.items():
                used[n] += c * p.bins
        assert used == Counter(histogram) and len(patterns) <= 12 * len(histogram)
    # no more bins than best-fit decreasing makes of random lengths, over all
    total = [0, 0]
    for _ in range(30):
        items = sorted((rng.choice([rng.randint(1, 100), rng.randint(20, 60), rng.randint(35, 50)]) for _ in range(300)), reverse=True)
        rooms, bins = [], sum(p.bins for p in packing.fill_patterns(Counter(items), 100))
        for x in items:
            fits = [r for r in rooms if r >= x]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 100) - x)
        assert bins >= -(-sum(items) // 100)
        total = [total[0] + bins, total[1] + len(rooms)]
    assert total[0] <= total[1]
    # 400 pairs fill 400 bins, whichever order would pair badly
    assert sum(p.bins for p in packing.fill_patterns({600: 200, 424: 200, 1000: 200, 24: 200}, 1024)) == 400


def test_encoder_cuts_texts_at_spaces_and_line_ends(monkeypatch):
    """op13: texts without white space before a cut aren't cut word by word, and all have the tokenizer's own ids."""
    e = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain = ["The ends, naïve.\nIt's (a) b!? 555-3810 x.y@z.example,\tc", "", "one", "\nx", "Ends;", " Łódź...", "<|endoftext|> a"]
    odd = ["a  b", "a \n b", "end. \n", "\n\nc", " ", "a\0 b", "x  y", f"{'l' * 99}. {'m' * 60}\t{'n' * 70},"]
    seen, real = [], packing.Encoder._word_by_word
    monkeypatch.setattr(packing.Encoder, "_word_by_word", lambda self, t: seen.append(t) or real(self, t))
    assert e.encode(plain) == e._encode(plain) and not seen
    assert e.encode(odd + plain) == e._encode(odd + plain) and set(seen) <= set(odd)
    assert max(map(len, e.known)) <= packing.CACHE_CHARS
