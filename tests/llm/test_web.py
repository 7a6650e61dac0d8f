"""URL filters and HTML extraction against plain versions, and the pipeline on a small corpus."""

import datetime
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from cdc_lake.llm import html_extract, url_filter
from cdc_lake.llm.oracles import ORACLES
from cdc_lake.llm.queries import QUERIES

DAY = datetime.date(2024, 1, 1)


def day(n):
    return DAY + datetime.timedelta(days=n)


# -- URL filters ---------------------------------------------------------------

CAPTURES = "page_id long, url string, fetched_at date"
ENTRIES = "list_name string, kind string, value string, action string, at date"


@pytest.mark.parametrize("url, host", [
    ("https://User:pw@WWW.Example.com.:8080/a?b", "www.example.com"), ("http://h", "h"), ("ftp://a.b/c", "a.b"), ("no url", None), ("", None), (None, None), ("http:///x", None),
])
def test_hosts(table, url, host):
    assert table([(url,)], "url string").select(url_filter.host_of(F.col("url"))).first()[0] == host


def test_rule_keys(table):
    keys = table([("http://a.b.c/x/y/z.html?q=/p/",)], "url string").select(url_filter.rule_keys(F.col("url"))).first()[0]
    assert [tuple(k) for k in keys] == [
        ("host", "a.b.c"), ("domain", "a.b.c"), ("domain", "b.c"), ("domain", "c"), ("path", "a.b.c/x/"), ("path", "a.b.c/x/y/"),
    ]


def test_as_of_join_against_replay(table):
    pick = random.Random(3)
    hosts = [f"{a}.{b}.org" for a in "abc" for b in "xyz"]
    entries = [
        (pick.choice(["l1", "l2"]), *pick.choice([("host", h), ("domain", h[2:]), ("path", h + "/p/"), ("path", h + "/p/q/")]), pick.choice(["add", "add", "remove", "odd"]), day(pick.randrange(60)))
        for h in hosts for _ in range(12)
    ] + [("l1", "host", None, "add", day(0)), ("l1", "host", "a.x.org", "add", None)]
    captures = [(i, f"http://{pick.choice(hosts)}/{pick.choice(['', 'p/', 'p/q/r', 'p'])}", day(pick.randrange(-5, 70))) for i in range(300)]
    captures += [(900, None, day(3)), (901, "http://a.x.org/", None), (902, "odd", day(3)), (1000, *captures[0][1:]), (1000, *captures[0][1:])]

    def in_force(url, at):
        met = set()
        if url and at and "://" in url:
            host, _, path = url[7:].partition("/")
            folders = path.split("/")[:-1]
            keys = {("host", host)} | {("domain", host.split(".", i)[-1]) for i in range(3)}
            keys |= {("path", host + "/" + "/".join(folders[: i + 1]) + "/") for i in range(len(folders))}
            states = {}
            for name, kind, value, action, when in entries:
                if value and when and action != "odd" and (kind, value) in keys and when <= at:
                    states.setdefault((name, kind, value), []).append((when, action))
            met = {rule for rule, s in states.items() if max(s)[1] == "add"}  # of one day, "remove" wins
        return met

    got = url_filter.filter_urls(table(captures, CAPTURES), table(entries, ENTRIES)).collect()
    assert len(got) == len(set(captures))
    for r in got:
        met = in_force(r.url, r.fetched_at)
        assert (r.blocked, r.n_rules, r.lists) == (bool(met), len(met), ",".join(sorted({m[0] for m in met})))
    assert any(r.blocked for r in got) and not all(r.blocked for r in got)
    none = table([], ENTRIES)
    assert not any(r.blocked for r in url_filter.filter_urls(table(captures, CAPTURES), none).collect())
    assert url_filter.filter_urls(table([], CAPTURES), table(entries, ENTRIES)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same(spark, sf_dir, name):
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    result = db.sql(ORACLES[name])
    mine = QUERIES[name](spark, sf_dir)
    assert sorted(result.columns) == sorted(mine.columns)
    assert sorted(map(repr, result.fetchall())) == sorted(repr(tuple(r)) for r in mine.select(*result.columns).collect())


# -- HTML extraction ------------------------------------------------------------

PROSE = "This sentence is long enough to count as prose for any container."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a</p><p>b", "a b"),
    ("<p>one<br>two <b>thr</b>ee<p>four &lt;x&gt;", "one two three four <x>"),
    (f"<nav>Menu</nav><article><h1>T</h1><p>{PROSE}</article><footer>F</footer>", f"T {PROSE}"),
    (f"<article><p>{PROSE}</p><div class='comments'><p>{PROSE} No!</p></div><aside>x</aside></article>", PROSE),
    (f"<div id='main-content'><p>{PROSE}<script>if (a<b) '</p>'</script><style>p{{}}</style></p><!-- <p>no</p> --></div>", PROSE),
    (f"<body><div class='cookie-notice'>{PROSE}</div><div class='post'><p>{PROSE}\n\n  &nbsp;é</p><form>f</form></div></body>", f"{PROSE} é"),
    ("<p title='a > b'>x</p><p class=\"q>z\">y</p><p broken=\"z>w</p>", "x y w"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
    ("a < b and c > d", "a < b and c > d"),
    (f"<div hidden>{PROSE}</div><p>seen</p>", "seen"),
])
def test_pages(html, text):
    assert html_extract.Page(html).text() == text


LEAD, MORE = f"Lead. {PROSE}", " ".join([PROSE] * 10)


@pytest.mark.parametrize("html, text", [
    (f"<article><h1>T</h1><p>{LEAD}</p><div class=body><p>{MORE}</p></div></article>", f"T {LEAD} {MORE}"),
    (f"<article><section class=a><p>{MORE}</p></section><section class=b><p>{LEAD}</p></section></article>", f"{MORE} {LEAD}"),
    (f"<div id=w><ul><li><a href=x>{PROSE} {PROSE}</a></ul><div class=body><p>{MORE}</p></div></div>", MORE),
    (f"<article><h2 class='section-header'>H</h2><p class='search-result'>{MORE}</p><p class='notice'>N</p></article>", f"H {MORE}"),
    (f"<article><p>{MORE}</p><figure><img src=x><figcaption>A cap</figcaption></figure></article>", f"{MORE} A cap"),
    (f"<article><p>{MORE} <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math></p></article>", f"{MORE} x=2"),
    (f"<body><div class='search-article'><p>{MORE}</p></div></body>", MORE),
    (f"<article><div class='article-header'><h1>T</h1><p>{LEAD}</p></div><p>{MORE}</p></article>", f"T {LEAD} {MORE}"),
    (f"<article><p>{MORE}</p><section class='side-effects'><h2>S</h2><p>{LEAD}</p></section><div class='legal-notice-text'><p>{PROSE}</p></div></article>", f"{MORE} S {LEAD} {PROSE}"),
    (f"<body><nav>N</nav><div class=intro><h1>T</h1><p>{LEAD}</p></div><div class=rest><p>{MORE}</p></div><footer>F</footer></body>", f"T {LEAD} {MORE}"),
    (f"<body><h1>T</h1><p>{LEAD}</p><div class=more><p>{MORE}</p></div><p>{PROSE}</p></body>", f"T {LEAD} {MORE} {PROSE}"),
])
def test_the_whole_article_is_kept(html, text):
    assert html_extract.Page(html).text() == text


@pytest.mark.parametrize("name", [
    "comments", "post-comments", "sidebar-left", "cookie-notice", "site-header", "article-share", "related-posts", "main-nav", "search-box", "ad_slot_3", "newsletter-box", "alert banner",
])
def test_what_is_not_the_article_goes(name):
    assert html_extract.Page(f"<article><h1>T</h1><p>{MORE}</p><div class='{name}'><p>{LEAD}</p></div></article>").text() == f"T {MORE}"


def test_doubted_names_of_links_and_short_texts_go():
    links = f"<div class='energy-related'><a href=x>{PROSE}</a></div><section class='story-header'>By X</section>"
    assert html_extract.Page(f"<article><p>{MORE}</p>{links}</article>").text() == MORE


def test_generated_pages_against_their_articles():
    """Token precision and recall on pages whose article is known."""
    pick, kept, wanted, got = random.Random(5), 0, 0, 0
    words = lambda n: " ".join("".join(pick.choices("abcdefghij", k=pick.randint(2, 9))) for _ in range(n))
    aside = lambda: f"<{(t := pick.choice(['div', 'section', 'ul']))} class='{pick.choice(['sidebar', 'share-links', 'site-notice', 'user-comments', 'menu', 'ad'])}'><li><p>{words(20)}</p></{t}>"
    for _ in range(200):
        parts = [words(pick.randint(12, 60)) for _ in range(pick.randint(2, 8))]
        inner = "".join(f"<p>{p}</p>" + (aside() if pick.random() < 0.2 else "") for p in parts)
        cut = pick.randrange(len(inner))
        cut = inner.rfind("<p>", 0, cut + 3)
        wrap = pick.choice(["<article>{}{}</article>", "<div class='post-body'>{}{}</div>", "<div class=a>{}</div><div class=b>{}</div>", "<main><div class='entry-header'>{}</div><div>{}</div></main>", "{}{}"])
        page = f"<body><nav>{words(8)}</nav>{aside()}{wrap.format(inner[:cut], inner[cut:])}{aside()}<footer>{words(30)}</footer></body>"
        truth, mine = " ".join(parts).split(), html_extract.Page(page).text().split()
        kept += sum((Counter(truth) & Counter(mine)).values())
        wanted, got = wanted + len(truth), got + len(mine)
    assert kept / wanted > 0.97 and kept / got > 0.97, (kept / wanted, kept / got)


def test_deep_nesting_is_linear():
    page = html_extract.Page("<div class=c>x" * 60_000)
    assert page.text() == " ".join("x" * 60_000) and max(map(len, page.paths)) < 2 * html_extract.LONG_PATH
    assert html_extract.Page(f"<div class='side-a'><p>{PROSE}</p>" * 20_000).text().count("Lead") == 0
    assert html_extract.Page("<div>" * 20_000 + "</p></section>" * 20_000 + "x").text() == "x"


def test_long_and_hostile_pages_end():
    assert html_extract.Page("<" * 20_000).text() == "<" * 20_000
    assert html_extract.Page("<div>" * 3_000 + "x").text() == "x"
    assert len(html_extract.Page("<p>" + "word " * 200_000).text()) == 999_999
    assert html_extract.Page('<a b="' * 300).text() is not None


def test_hosts_agree_on_a_container(table):
    page = lambda body, extra="": f"<body><div class='top'>{extra}</div><div class='story s1'><p>{body}</p></div></body>"
    rows = [(i, f"http://h.org/{i}", page(f"{i} {PROSE} {PROSE}")) for i in range(5)]
    rows += [(9, "http://h.org/9", page("short.", PROSE * 3)), (10, "http://h.org/10", f"<section>{PROSE}</section>"), (11, None, page(PROSE)), (12, "http://h.org/12", None)]
    rows += [rows[0]]
    got = {r.page_id: r.text for r in html_extract.extract_text(table(rows, "page_id long, url string, html string").withColumn("path", F.lit("x"))).collect()}
    assert got[0] == f"0 {PROSE} {PROSE}" and got[9] == "short." and got[10] == PROSE and got[11] == PROSE and got[12] == ""
    assert html_extract.extract_text(table(rows, "page_id long, url string, html string")).count() == len(rows)
    assert html_extract.extract_text(table([], "page_id long, url string, html string")).count() == 0


# -- pipeline ---------------------------------------------------------------------


def test_stages_of_the_pipeline(spark, docs, table, prose, tmp_path):
    import corpus_pipeline

    texts = [prose(i, 70) for i in range(80)]
    texts += [texts[3], texts[4].replace(texts[4].split()[10], "other", 1)]  # 80, 81: copy, near copy
    texts += [prose(500, 30) + " " + prose(900, 25) + " " + prose(501, 300)]  # 82: leak
    texts += [prose(600, 60) + ' token = "abcdef0123456789abcdef0123" ' + prose(601, 400)]  # 83: secret
    texts += [" ".join(w.upper() + "$$%&" for w in prose(700, 60).split()), None, ""]  # 84-86: junk
    columns = docs(texts).columns
    docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    table([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table([(0, prose(900, 25))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.stored(stage(spark, frame, str(tmp_path)), "stage")
        assert frame.columns == columns
        seen.append({r.doc_id for r in frame.collect()})
    assert seen[0] == {*range(84)}
    assert seen[1] == {*range(80), 82, 83}
    assert seen[2] == seen[3] == {*range(80), 83}
    rows = {r.doc_id: r for r in frame.collect()}
    assert "[SECRET]" in rows[83].text and "abcdef0123" not in rows[83].text and rows[83].n_chars == len(rows[83].text)
    assert all(rows[i].text == texts[i] for i in range(80))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == seen[3]
