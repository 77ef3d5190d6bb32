"""Page text: what class names say, and what the slot of a host holds."""

from bookpipe.llm import html_text


def test_names_do_not_empty_a_page(spark):
    bodies = [
        '<body class="has-sidebar"><article>one</article></body>',
        '<body><article class="post share-enabled share">one</article></body>',
        '<body><main class="no-sidebar"><p class="related-work">one</p></main></body>',
        '<body class="header"><main><div class="notice">one</div></main></body>',
        '<body><article><p>one</p><div class="box share">two</div></article></body>',
        '<body><nav>menu</nav><div id="comments social">one</div></body>',
        '<body><div class="ad">one</div></body>',
    ]
    rows = [(i, f"http://h{i}.example/", f"<html>{b}</html>") for i, b in enumerate(bodies)]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == dict.fromkeys(range(7), "one")


def test_slot_holds_title_lead_and_caption(spark):
    long = "word " * 200
    rows = [(i, "http://a.example/", f"<html><body><nav>menu</nav><article><h1>Title {i}</h1><div class=body>{long}</div><p>end {i}</p></article></body></html>") for i in range(4)]
    rows += [(10 + i, "http://b.example/", f"<html><body><div class=lead>Lead {i}</div><div class=body>{long}</div></body></html>") for i in range(4)]
    got = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    for i in range(4):
        assert got[i] == f"Title {i} {long}end {i}"
        assert got[10 + i] == f"Lead {i} {long}".strip()


def test_parts_by_hyphenated_names_and_template_blocks(spark):
    """What names mark in part, and what half of a host's pages say, is no article; the rest stays."""
    def page(i):
        return (
            f'<html><body><div class="site-header">Site</div><div class="cookie-banner">ok?</div><article><h1>Title {i}</h1><p>Body {i} &amp; more.</p>'
            f'<div class="related-posts">other</div><div class="ad-slot">buy</div><div class="x9">Read our &quot;terms&quot;.</div>'
            f'<p>Share this page with everyone</p><p class="has-sidebar">End {i}.</p></article><div id="comments_area">nice</div></body></html>'
        )

    bare = [(10 + i, "http://b.example/", page(i).replace("<article>", "<div>").replace("</article>", "</div>")) for i in range(5)]
    rows = [(i, "http://a.example/", page(i)) for i in range(5)] + bare + [(20, "http://c.example/", page(20))]
    got = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    for i in range(5):
        assert got[i] == got[10 + i] == f"Title {i} Body {i} & more. End {i}."
    # One page alone shows no template.
    assert got[20] == 'Title 20 Body 20 & more. Read our "terms". Share this page with everyone End 20.'


def test_many_hosts_go_by_portions(spark, monkeypatch):
    """The other form gives the same texts, with a host of many portions."""
    rows = [(i, f"http://h{min(i, 3)}.example/", f"<html><body><nav>menu</nav><div><h1>T {i}</h1><p>same</p><p>text {i}</p></div></body></html>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    sent = sorted(map(tuple, html_text.main_texts(pages).collect()))
    monkeypatch.setattr(html_text, "SENT_HOSTS", 0)
    monkeypatch.setattr(html_text, "PORTION", 5)
    assert sorted(map(tuple, html_text.main_texts(pages).collect())) == sent
    assert {t for i, _, t, _ in sent if i >= 3} == {f"T {i} text {i}" for i in range(3, 40)}


def plain_classes(pages):
    """Tokens of one host's pages with their whole occurrence vectors, gathered."""
    vectors = {}
    for at, page in enumerate(pages):
        for path, (n, _, _) in html_text.tokens(page).items():
            vectors.setdefault(path, {})[at] = n
    return vectors


def test_template_against_gathered_vectors(spark, sf_dir):
    """Classes by summed hashes are those of gathered vectors, on every host of a table."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    classes = html_text.token_classes(pages.select("page_id", "url", "html")).collect()
    by_host = {}
    for r in pages.select(html_text.host_of(pages.url).alias("host"), "html").collect():
        by_host.setdefault(r.host, []).append(r.html or "")
    found = {}
    for r in classes:
        found.setdefault(r["_host"], {})[r.path] = (r["class"], r.support, r.total, r.pages)
    assert set(found) == set(by_host)
    for host, texts in by_host.items():
        vectors = plain_classes(texts)
        assert set(vectors) == set(found[host])
        for path, vector in vectors.items():
            assert found[host][path][1:] == (len(vector), sum(vector.values()), len(texts))
        groups, named = {}, {}
        for path, vector in vectors.items():
            groups.setdefault(tuple(sorted(vector.items())), set()).add(path)
            named.setdefault(found[host][path][0], set()).add(path)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, named.values()))
