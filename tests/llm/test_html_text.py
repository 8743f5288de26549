import pytest

from quotewell.llm import html_text

SCHEMA = "page_id long, url string, html string, key string, host string, hash long, text string"


def blocks(html):
    return html_text.walk(html, frozenset(), None)


@pytest.mark.parametrize(
    "html, expected",
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<article><h1>T</h1><p>a <b>b</b>c<br>d<p>e &lt;x&gt;&nbsp; f</article><footer>no</footer>", ["T", "a bc d", "e <x> f"]),
        ("<body><header>site</header><nav>menu</nav><main><h1>H</h1><div>x</div></main><aside>y</aside>", ["H", "x"]),
        ("<article><header><h1>Head</h1></header><p>t</p><div class='comments'><p>c</p></div><form>f</form></article>", ["Head", "t"]),
        ("<article><p>t</p></article><section id=comments><article class=comment><p>c</p></article></section>", ["t"]),
        ("<p>a<script>var x='</p>';</script>b<style>p{}</style></p><!-- c --><p hidden>h</p>", ["ab"]),
        ("<ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><td>z</table>", ["one", "two", "x", "y", "z"]),
        ("<div class='cookie-notice'>c</div><div class='adBanner'>a</div><div class='shadow'>kept</div>", ["kept"]),
        ("<p>5 < 6 and <a title='x>y' href=z>link</a></p></div></p>", ["5 < 6 and link"]),
        ("<article><p>a\n\n b</p><div role=navigation>n</div><p style='display:none'>s</p>", ["a b"]),
        ("<div>" * 5000 + "deep" + "</div>" * 3, ["deep"]),
    ],
)
def test_blocks(html, expected):
    assert blocks(html) == expected


def test_templates_go_but_copies_stay(spark):
    """A line that a host repeats goes, short article lines and copied pages stay."""
    page = lambda k: f"<body><div>Follow our letter</div><article><h1>Title {k}</h1>{"<p>To.</p>" * (k % 2)}<p>Text number {k}</p></article></body>"
    bare = lambda k: f"<body><div><p>Welcome to the site</p></div><div>Story {k} goes on</div></body>"
    rows = [(k, "http://a.example/x", page(k)) for k in range(30)]
    rows += [(100 + k, "https://B.example:80/p?q", bare(k)) for k in range(8)]
    rows += [(200 + k, "http://c.example/", bare(7)) for k in range(8)]  # one page copied
    rows += [(300, None, None), (301, "", ""), (302, "no url", "<p>x"), (None, "http://a.example/x", page(3)), (3, "http://a.example/x", page(3))]
    df = spark.createDataFrame([(*r, "k", "h", 1, "t") for r in rows], SCHEMA)
    out = [(r["page_id"], r["text"]) for r in html_text.extract(df).collect()]
    assert len(out) == len(rows)
    text = dict(out)
    assert text[3] == "Title 3 To. Text number 3" and (None, text[3]) in out
    assert text[104] == "Story 4 goes on"
    assert text[201] == "Welcome to the site Story 7 goes on"
    assert (text[300], text[301], text[302]) == ("", "", "x")
    assert html_text.extract(df.where("false")).count() == 0


def extracted(spark, rows):
    df = spark.createDataFrame([(*r, "k", "h", 1, "t") for r in rows], SCHEMA)
    return {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}


def test_templates_of_a_large_host(spark):
    """Blocks on a part of a host's pages go, whatever the share; a block on few of them stays."""
    block = lambda k: f"<div><p>Side block {k % 16}</p><p>with a link</p></div>"
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(12))
    rare = lambda k: "<p>Seen on some pages only</p>" if k < 12 else ""
    rows = [(k, "http://a.example/", f"<body>{block(k)}<div>Story {own(k)}</div>{rare(k)}</body>") for k in range(800)]
    text = extracted(spark, rows)
    assert all(text[k] == f"Story {own(k)}" + (" Seen on some pages only" if k < 12 else "") for k in text)


def test_templates_within_articles(spark):
    """A notice on a part of the articles goes, a line of a word or two stays on whatever share."""
    notice = lambda k: "<p>Our newsroom follows a code of conduct that you find on this page</p>" if k % 9 == 0 else ""
    brief = lambda k: "<p>This notice recurs</p>" if k % 100 < 79 else ""
    page = lambda k: f"<article><h1>Title {k}</h1><p>To.</p>{notice(k)}{brief(k)}<p>Text number {k}</p></article>"
    text = extracted(spark, [(k, "http://a.example/", page(k)) for k in range(300)])
    assert all(text[k] == f"Title {k} To. Text number {k}" for k in text)


def test_short_line_of_every_article_stays(spark):
    page = lambda k: f"<body><div>Follow our letter</div><article><h1>Title {k}</h1><p>To.</p><p>Text number {k}</p></article></body>"
    text = extracted(spark, [(k, "http://a.example/x", page(k)) for k in range(30)])
    assert all(text[k] == f"Title {k} To. Text number {k}" for k in text)


def test_a_paragraph_that_few_articles_repeat_stays(spark):
    """In 20 of the 2,000 articles of a host, as against a notice in a tenth of them."""
    line = "<p>As reported before in this place the council meets on the first Monday of every month</p>"
    notice = "<p>Our newsroom follows a code of conduct that you find on this page</p>"
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(8))
    page = lambda k: f"<article><h1>Title {k}</h1>{line * (k % 100 == 0)}{notice * (k % 10 == 3)}<p>{own(k)}</p></article>"
    text = extracted(spark, [(k, "http://a.example/", page(k)) for k in range(2000)])
    said = " As reported before in this place the council meets on the first Monday of every month"
    assert all(text[k] == f"Title {k}{said * (k % 100 == 0)} {own(k)}" for k in text)


def templates_by_hand(pages):
    """(host, hash) by counting over plain dictionaries, pages of equal main text once."""
    count, mains = {}, {}
    for host, main, subtrees in pages:
        mains.setdefault(host, set()).add(main)
        for hash_, kind in subtrees:
            by_main = count.setdefault((host, hash_), {})
            by_main[main] = min(by_main.get(main, 127), kind)
    out = set()
    for (host, hash_), by_main in count.items():
        n, kind, total = len(by_main), min(by_main.values()), len(mains[host])
        weight, wide = abs(kind) % 100, sum(abs(k) >= 100 for k in by_main.values())
        if n < 5:
            continue
        if kind < 0:
            good = n >= 20 and (weight >= 10 and n >= 0.05 * total or weight >= 3 and n >= 0.3 * total)
        else:
            good = n >= 0.3 * total or n >= 20 and 2 * wide <= n
        if good:
            out.add((host, hash_))
    return out


def test_template_counts_equal_a_plain_count(spark):
    import random

    rng = random.Random(4)
    kinds = {h: rng.choice([-110, -10, -7, -2, 2, 10, 110]) for h in range(40)}
    pages = []
    for k in range(600):
        host = "a" if k % 4 else rng.choice(["b", None, "c"])
        there = [h for h in kinds if rng.random() < (h + 1) / 60]
        pages.append((host, rng.randint(0, 400) if k % 3 else 7, [(h, kinds[h]) for h in there]))
    rows = [(h, m, [x for x, _ in s], [k for _, k in s]) for h, m, s in pages if h is not None]
    df = spark.createDataFrame(rows, "host string, main long, hashes array<long>, kinds array<tinyint>").repartition(5)
    found = {(r["host"], r["hash"]) for r in html_text.site_templates(df).collect()}
    assert found == templates_by_hand([p for p in pages if p[0] is not None]) and found
