"""The methods on small cases, against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_tables import prose
from runledger.llm import ann, decontam, hilbert, pieces, pii, quality, secret_scan, simhash, templates, token_files
from runledger.llm.components import components


def test_curve_visits_neighbours(spark):
    """All cells of a grid have different indexes, and steps along the curve change one coordinate by one."""
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        side, n = 1 << bits, (1 << bits) ** dims
        cells = spark.range(n).select(*[F.expr(f"cast(id div {side ** j} % {side} as int)").alias(f"c{j}") for j in range(dims)])
        rows = cells.withColumn("h", hilbert.curve_index([F.col(f"c{j}") for j in range(dims)], bits)).orderBy("h").collect()
        assert [r.h for r in rows] == list(range(n))
        assert all(sum(abs(a[j] - b[j]) for j in range(dims)) == 1 for a, b in zip(rows, rows[1:]))


def test_shards_prune_in_every_dimension(spark):
    rows = spark.range(4096).select("id", (F.col("id") * 37 % 64).alias("a"), (F.col("id") * 53 % 64).alias("b"))
    out = hilbert.hilbert_shards(rows, ["a", "b"], ["id"], 16).collect()
    for c in ("a", "b"):
        touched = {r.shard for r in out if r[c] == 20}
        assert len(touched) <= 8


def test_state_of_token_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, " ".join(["word"] * i)) for i in range(50)], "doc_id long, text string").repartition(7)
    import public_tokenizers
    folder = token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), folder=str(tmp_path / "t"))
    rows = token_files.read_tokens(spark, folder).orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows] == [i + 1 for i in range(50)] and [r.start for r in rows] == [sum(range(i + 1)) for i in range(50)]
    assert rows[3].ids == [rows[3].ids[0]] * 3 + [1]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normaliser_against_the_library(rule):
    import sentencepiece
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    own = pieces.Normalizer(lib.serialized_model_proto())
    rng = random.Random(1)
    texts = ["", " ", "a", "  a  b ", "ﬁne ①②  Ａ　ｂ", "é ½ ㍿  x", "ǅ ß İ"]
    texts += ["".join(rng.choice("abÀé ①ﬁＡ　 ½́Ⅷ㌔x") for _ in range(rng.randint(0, 20))) for _ in range(300)]
    for t in texts:
        normal, align = own.normalize(t.encode())
        assert normal.decode() == lib.normalize(t), t
        assert len(align) == len(normal) + 1 and (np.diff(align) >= 0).all() and align[-1] <= len(t.encode())


def test_spans_give_back_the_text(spark):
    import public_tokenizers
    text = "The  cat —\nsat é 漢字 on▁it."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model")).first()
    raw = text.encode()
    assert b"".join(raw[a:b] for a, b in zip(r.span_start, r.span_end)) == raw and len(r.ids) == len(r.span_start) + 1


def test_quality_separates(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 60), 1) if i % 2 else (i, " ".join(w + "!!" for w in prose(rng, 40).upper().split()), 0) for i in range(400)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.col("doc_id") < 300)
    held = {r.doc_id: r.score for r in quality.score(docs, model).where("doc_id >= 300").collect()}
    assert sum((held[i] >= 0.5) == bool(i % 2) for i in held) >= 0.95 * len(held)
    none = quality.fit(docs, labels.where("quality = 1"), F.lit(True))
    assert quality.score(docs, none).select("score").distinct().collect()[0][0] == 0.5


def test_bootstrapping_finds_unseen(spark):
    seeds = [(i, f"hello there contact me by {chr(97 + i)}x{i}@mail.example.org today") for i in range(12)]
    unseen = [(50, "now contact me by Q-77812345 please"), (51, "the year was about Q-99912345 then")]
    docs = spark.createDataFrame(seeds + unseen, "doc_id long, text string")
    got = {r.id: [(s.kind, s.value) for s in r["all"]] for r in pii.find_pii(docs).collect()}
    assert got[50] == [("id", "Q-77812345")] and got[51] == [] and got[0] == [("email", "ax0@mail.example.org")]


def test_bootstrapping_converges(spark):
    """Values not reached yet don't count against a pattern, those in poor contexts do."""
    docs = [(i, f"hello there contact me by {chr(97 + i)}x{i}@mail.example.org today") for i in range(12)] + [(50 + i, f"now contact me by Q-{77812345 + i} please") for i in range(200)]
    assert pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).where("id >= 50 and size(all) = 1").count() == 200
    edges = [("good", i, 1) for i in range(12)] + [("good", 100 + i, 0) for i in range(9)] + [(f"poor{j}", 100 + i, 0) for i in range(9) for j in range(9)] + [("even", i, 1) for i in range(9)] + [("even", 200, 0), ("good2", 200, 0)] + [("good2", i, 1) for i in range(9)]
    p = {k: 0.0 for k, _, _ in edges}
    for _ in range(2000):
        mean = {v: np.mean([p[k] for k, w, _ in edges if w == v]) for _, v, _ in edges}
        p = {k: sum(1 if s else mean[v] for q, v, s in edges if q == k) / (1 + sum(q == k for q, _, _ in edges)) for k in p}
    want = {k for k, x in p.items() if x >= pii.CONFIDENCE and sum(s for q, _, s in edges if q == k) >= pii.SUPPORT}
    got = {r.pattern for r in pii.reliable_patterns(spark.createDataFrame(edges, "pattern string, value long, seed int")).collect()}
    assert got == want == {"even", "good2"}


def test_contexts_come_from_the_whole_text(spark):
    """At a text's start, after a word with digits, in a list, and after a long word."""
    mail, long = "{c}x@mail.example.org", "w" * 90
    heads = {"Passport number ": "X1234567", "in 2024 account no ": "77812345", "hello there see list 55512345 ": "66612345", f"say {long} ": "88812345"}
    docs = [(100 * k + i, head + mail.format(c=chr(97 + i))) for k, head in enumerate(heads) for i in range(9)]
    docs += [(100 * k + 50, head + value) for k, (head, value) in enumerate(heads.items())]
    got = {r.id: [s.value for s in r["all"]] for r in pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).where("id % 100 = 50").collect()}
    assert all(value in got[100 * k + 50] for k, value in enumerate(heads.values()))


def test_handles_and_long_identifiers(spark):
    values = {50: "@jane.doe", 51: "@jo", 52: "7f" * 60, 53: "jane@home"}
    docs = [(i, f"hello there contact me by {chr(97 + i)}x{i}@mail.example.org today") for i in range(12)] + [(k, f"now contact me by {v} please") for k, v in values.items()]
    docs += [(60, "now contact me by @ please"), (61, "the year was about @jane.roe then")]
    got = {r.id: [(s.kind, s.value) for s in r["all"]] for r in pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).where("id >= 50").collect()}
    assert got == {60: [], 61: []} | {k: [("id", v)] for k, v in values.items()}


def test_trigram_queries_hold():
    """Every match of a rule has all trigrams of one of its alternatives."""
    examples = {"assign": ["API_KEY:abcdef", "password = 'x'", "passwd=1", "Token:zz"], "access": ["AKIA0"], "pem": ["-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----"],
                "github": ["ghp_" + "a" * 36], "slack": ["xoxb-" + "1" * 12], "google": ["AIza" + "b" * 35], "stripe": ["sk_live_" + "c" * 20], "jwt": ["eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + "." + "c" * 9]}
    for rule in secret_scan.BASE + secret_scan.MORE:
        query = secret_scan.trigram_query(rule.regex)
        for text in examples.get(rule.kind, []):
            assert re.search(rule.regex, text) and any(all(t in text.lower() for t in alt) for alt in query), (rule.kind, text)
    assert secret_scan.trigram_query("[0-9a-f]{24,}") == [] and secret_scan.trigram_query("abc|x") == []
    assert secret_scan.trigram_query("ab(c|d)e+f") == [frozenset({"abc", "bce"}), frozenset({"abd", "bde"})]


def brute_groups(fps, distance):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("run", [4, 64, 8192])
def test_links_lose_nothing(spark, run):
    rng = random.Random(run)
    fps = []
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            x = base
            for _ in range(rng.randint(0, 9)):
                x ^= 1 << rng.randrange(64)
            fps.append(x)
    fps = sorted(set(fps))
    want = brute_groups(fps, 4)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    root = {r.node: r.root for r in components(simhash.links(df, 4, run)).collect()}
    label = [root.get(f, f) for f in signed]
    groups = lambda xs: {tuple(i for i, x in enumerate(xs) if x == y) for y in xs}
    assert groups(label) == groups(want)


def test_gray_index_is_exact():
    rng = np.random.default_rng(4)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 63, 500, dtype=np.uint64), *[np.uint64(1 << 40) ^ (np.uint64(1) << rng.integers(0, 20, 200, dtype=np.uint64))]]))
    q, n = simhash.GrayIndex(fps).search(fps, 6)
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 6
    assert set(zip(q.tolist(), n.tolist())) == set(zip(*[x.tolist() for x in np.nonzero(near)]))


def test_long_chain_is_one_component(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(1000, 1001)], "a long, b long"))
    got = {r.node: r.root for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1001] == 1000


def test_reparameterised_questions(spark):
    item = "A train leaves Paris at 9 and travels 120 km in 3 hours; how fast does the train from Paris go when it stops 3 times?"
    docs = [(1, "Intro words. " + item + " More words."), (2, item.replace("Paris", "Berlin").replace("120", "450").replace("3 ", "7 ")), (3, item.replace("3 hours", "5 hours")),
            (4, "A train leaves the town early and travels far in the morning; how fast does it go?"), (5, item.upper().replace("PARIS", "Paris")), (6, item.lower())]
    found = decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(0, item)], "item_id long, text string")).collect()
    by = {r.id: r for r in found}
    assert 1 in by and not by[1].reparameterised and 2 in by and by[2].reparameterised and 4 not in by and 5 in by and 6 in by
    # document 3 gives one value of the item two values: windows that hold both don't agree
    assert 3 not in by or by[3].n_windows < by[1].n_windows


def test_conflicting_slots_lose_their_windows_only(spark):
    body = "the old river runs past seven quiet villages and under many stone bridges before it meets the wide northern sea"
    item = f"Re old walls stand by the water while people walk home from work. The {body[4:]}. Then, when the evening comes and lamps are lit along every quay, the ferry leaves with 30 people and comes back with 30 people again each night."
    docs = [(1, item), (2, item.replace("Re old", "The old")), (3, item.replace("with 30 people again", "with 45 people again")),
            (4, "When 7 cats meet 7 dogs by the old river bank they run"), (5, item.replace("30", "45"))]
    by = {r.id: r for r in decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(0, item)], "item_id long, text string")).collect()}
    assert set(by) == {1, 2, 3, 5} and not by[1].reparameterised and by[5].reparameterised
    assert 30 < by[2].n_windows < by[1].n_windows and 30 < by[3].n_windows < by[1].n_windows


def test_exact_copies_of_dense_short_and_spaceless_items(spark):
    items = [(0, "What is 384 * 219 + 17?"), (1, "7 12 19 31 50 81 131 212 343 555 898 1453"), (2, "Name Zanzibar's capital."), (3, "小明有12个苹果，他又买了30个，请问他现在一共有多少个苹果？"), (4, "水的沸点是多少"),
             (5, "ภาษาไทยเขียนโดยไม่มีช่องว่างระหว่างคำ"), (6, "3 + 4")]
    docs = [(10 + i, f"before it {t} after it") for i, t in items] + [(20, "what is 384 - 219 + 17?"), (21, "What is 385 * 219 + 17?"), (22, "7 12 19 31 50 81 131 212 343"), (23, "about Zanzibar's capital."), (24, "3 4 and 3 - 4")]
    docs += [(30, "我们读到：小明有12个苹果，他又买了30个，请问他现在一共有多少个苹果？然后回答。"), (31, "老师问水的沸点是多少，学生回答。"), (32, "小明有一只猫，水的颜色是什么"), (33, "เขาบอกว่าภาษาไทยเขียนโดยไม่มีช่องว่างระหว่างคำครับ")]
    found = decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.id, r.item_id) for r in found} == {*[(10 + i, i) for i, _ in items], (30, 3), (31, 4), (33, 5)} and not any(r.reparameterised for r in found)


def test_graph_recall():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(3000, 24)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph = ann.Graph(v)
    again = ann.Graph.from_flat(v, graph.flat(), graph.entry)
    hit = 0
    for q in range(0, 3000, 50):
        want = set(np.argsort(-(v @ v[q]))[:6].tolist())
        got = [p for _, p in again.search(v[q], ann.EF)][:6]
        assert got == [p for _, p in graph.search(v[q], ann.EF)][:6]
        hit += len(want & set(got))
    assert hit / (60 * 6) >= 0.9


def test_pages_without_articles(spark):
    page = "<body><div class='top header'>Site {i}</div><div id=side class=sidebar><p>Side words that go on and on for long {i}</p></div><div class=content><p>Text {i} of this page, which differs.</p><form>name</form><p>Second &lt;b&gt; {i}.</p><div class='comments'><p>Nice {i}!</p></div></div><script>var a='<p>x</p>';</script><!-- <p>hidden</p> --><div class=bottom><a href=/a>Imprint</a></div></body>"
    rows = [(i, "https://a.example/%d" % i, page.replace("{i}", str(i))) for i in range(8)]
    got = {r.id: r.text for r in templates.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Text {i} of this page, which differs. Second <b> {i}." for i in range(8)}
