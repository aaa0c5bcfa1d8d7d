"""Main text of pages: what is beside the text, quoted tags, slots per layout, and the template against brute force."""

import random
from collections import Counter, defaultdict

import pytest

from runledger.llm import templates

MAIN = "<article><h1>Title</h1><p>Main words of this page.</p></article>"
PAGES = "page_id long, url string, html string"


def text(html, named=True, regions=(), others=(), fixed=()):
    return " | ".join(templates._chosen(templates.parse(html), named, regions, others, fixed))


@pytest.mark.parametrize("html", [
    '<html class="cookies"><body class="has-sidebar"><nav>menu</nav>' + MAIN, '<body class="comments-open">' + MAIN + "<footer>f</footer>", f'<div class="widget">{MAIN}</div><div class=widget>other</div>',
    f"<div class='sidebar'><div class=inner>{MAIN}</div></div>", f"<div class=related><article>Teaser text.</article></div>{MAIN}", f"<article class=comment>A comment that is longer than the article itself is, by far.</article>{MAIN}"])
def test_words_on_wrappers_do_not_lose_the_article(html):
    assert text(html) == "Title | Main words of this page."


def test_what_is_beside_the_text_in_an_article():
    html = """<article><header><h1>Title <em>of it</em></h1><p class=byline>By me</p></header><section class="discussion"><p>We discuss.</p></section><div class="social-history">History.</div>
<div class="comment-list"><p>Nice!</p></div><section class=discussion><p>Your turn</p><div class=reply>Mine</div></section><div class=related><a href=/a>One</a> <a href=/b>Two</a></div>
<div class=ad-box>Buy</div><div class="notice"><form>mail</form></div><aside>Side</aside><nav>Nav</nav><footer>Foot</footer><p>End.</p></article>"""
    assert text(html) == "Title of it | We discuss. | History. | End."


def test_quoted_tags():
    assert text('<img alt="x > y">Main words.') == "Main words."
    assert text('<p><a title="a>b" href=\'c>d\'>Link</a> and more') == "Link and more"
    assert text("<p title=don't>Don't stop <b class = 'x>y' >here</b></p>") == "Don't stop here"
    assert text('<p x="unclosed>One</p><p>Two') == "One | Two"
    assert text("a < b and <3 and <p>c</p> & d") == "a < b and <3 and | c | & d"


def test_doubtful_texts_of_the_whole_host_go(spark):
    page = "<body><article><h1>T{i}</h1><div class=notice>We use cookies on this site.</div><div class=notice>Notice {i} of the article.</div><p>Words {i}.</p></article></body>"
    rows = [(i, "http://n.example/%d" % i, page.replace("{i}", str(i))) for i in range(5)] + [(9, "http://one.example/", page.replace("{i}", "9"))]
    got = {r.id: r.text for r in templates.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"T{i} Notice {i} of the article. Words {i}." for i in range(5)} | {9: "T9 We use cookies on this site. Notice 9 of the article. Words 9."}


def test_every_slot_of_every_layout(spark):
    """Without articles: an intro beside a body, two layouts a host, page-own containers, links and fixed text left out."""
    one = "<body><div class=top>Shop &amp; Co</div><div class=content><p>Intro {i}.</p><div class=body><p>Long text {i} goes here.</p><div class=own{i}>Only here {i}.</div></div></div><div class=more><a href=/>All of {i}</a></div></body>"
    two = "<body><div class=lead>Lead {i}.</div><div class=story><p>Story {i} follows.</p></div><div class=foot>Same on all pages of it</div></body>"
    rows = [(i, "http://l.example/a%d" % i, one.replace("{i}", str(i))) for i in range(4)] + [(10 + i, "http://l.example/b%d" % i, two.replace("{i}", str(10 + i))) for i in range(4)]
    got = {r.id: r.text for r in templates.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i].endswith(f"Intro {i}. Long text {i} goes here. Only here {i}.") and "All of" not in got[i] for i in range(4)), got
    assert all(got[10 + i].startswith(f"Lead {10 + i}. Story {10 + i} follows.") for i in range(4)), got


def test_pages_are_known_by_their_whole_html(spark):
    """Pages that share id, length and their first characters are pages of their own."""
    head = "<body><!--" + "x" * 300 + "-->"
    rows = [(None, "http://c.example/", f"{head}<div class=a><p>Text {i:03d} here</p></div><div class=b><p>Fixed line of all pages</p></div></body>") for i in range(6)]
    got = sorted(r.text for r in templates.main_text(spark.createDataFrame(rows, PAGES)).collect())
    assert got == [f"Text {i:03d} here" for i in range(6)]


def test_deep_and_long_pages_take_time_by_their_length():
    import time
    took = []
    for n in (10_000, 20_000):
        begin = time.process_time()
        assert len(templates.parse("<article>" + "deep<div>" * n + "<p title='>'>" * n)[1]) == n
        took.append(time.process_time() - begin)
    assert took[1] < 4 * took[0] + 0.2


def brute_template(pages):
    """(named, good regions, other regions) of one host by full occurrence vectors."""
    parsed = [templates.parse(html) for html in pages]
    vectors, texts = defaultdict(lambda: [0] * len(pages)), defaultdict(lambda: [set(), 0, 0])
    for k, (paths, blocks, _) in enumerate(parsed):
        for key, n in paths.items():
            vectors[key][k] += n
        for e, t, links in blocks:
            if not e.aside:
                own = texts[e.region, e.inside, (e.path, t, e.unsure)]
                own[0].add(k)
                own[1] += len(t)
                own[2] += links
    size = Counter([*(tuple(v) for v in vectors.values()), (1,) * len(pages)])  # the page is a token too
    on = lambda v: sum(n > 0 for n in v)
    valid = {key: on(v) for key, v in vectors.items() if size[tuple(v)] >= templates.CLASS_SIZE and on(v) >= templates.CLASS_PAGES}
    nested = {path for (path, parent), n in valid.items() if parent == 0 or all(n <= m for (p, _), m in valid.items() if p == parent) or any(n <= m for (p, _), m in valid.items() if p == parent)}
    total = defaultdict(lambda: [0, 0, 0])
    for (region, inside, _), (seen, chars, links) in texts.items():
        if region in nested:
            own = total[region, inside]
            own[0] += chars
            own[1] += links
            own[2] += 0 if len(seen) == len(pages) >= templates.CLASS_PAGES else chars
    plain = {r: v for (r, inside), v in total.items() if not inside}
    good = {r for r, (chars, links, free) in plain.items() if links <= templates.LINK_SHARE * chars and free > 0}
    if not good and plain:
        good = {max(plain, key=lambda r: (plain[r][1] <= templates.LINK_SHARE * plain[r][0], plain[r][0], r))}
    return any(inside for _, inside in total), good, set(plain) - good


def test_template_against_brute_force(spark):
    rng = random.Random(12)
    hosts = {}
    for h in range(12):
        parts = rng.sample(["<div class=x{c}>{t}</div>", "<section><p>{t}</p></section>", "<td>{t}</td>", "<div class=nav-bar>{t}</div>", "<div><a href=/>{t}</a></div>", "<ul><li>{t}</li></ul>",
                            "<article><h1>{t}</h1><p>{t}</p></article>" if h % 3 == 0 else "<p>{t}</p>", "<center>{t}<div>{t}</div></center>"], 5)
        hosts[f"h{h}.example"] = ["<body>" + "".join(p.replace("{c}", str(rng.randint(0, 1) if k == 2 else 0)).replace("{t}", f"text {rng.choice([0, i])} {k}") * rng.choice([1, 1, 2]) for k, p in enumerate(parts) if rng.random() < 0.9) + "</body>" for i in range(rng.randint(1, 6))]
    rows = [(10 * n + i, f"http://{h}/{i}", html) for n, (h, pages) in enumerate(hosts.items()) for i, html in enumerate(pages)]
    keyed = templates._keyed(spark.createDataFrame(rows, PAGES), "page_id", "url", "html")
    got = {r.host: (r.named, set(r.regions), set(r.others)) for r in templates.deduce(keyed).collect() if r.regions is not None}
    want = {h: brute_template(pages) for h, pages in hosts.items()}
    assert got == {h: w for h, w in want.items() if w != (False, set(), set())} and sum(len(w[1]) > 1 for w in want.values()) > 2
