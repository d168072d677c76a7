"""Main-text extraction on pages built from known blocks."""

import html
import random

from pricescope.llm import html_main as hm

SF = "/root/testdata/sf0.01"
NOISE = ["<nav><ul><li><a href='/a'>Home</a></li></ul></nav>", "<div class=\"ad\">Buy now & here</div>", "<header><h2>Site</h2></header>",
         "<aside>More <p>links</p></aside>", "<form><label>Name</label><input></form>", "<script>if (a<b) x('</p>')</script>",
         "<style>p{}</style>", "<!-- <p>hidden</p> -->", "<section id='comments'><p>First! I disagree at length.</p></section>",
         "<div class='cookie-notice'><p>We use cookies.</p></div>", "<footer>&copy; 2024</footer>", "<div class='sideBar'>x</div>"]


def build(rng, words):
    text, body = [], []
    for _ in range(rng.randint(1, 7)):
        block = [rng.choice(words) for _ in range(rng.randint(3, 30))]
        text.append(" ".join(" ".join(block).split()))
        marked = [f"<b>{html.escape(w)}</b>" if rng.random() < 0.1 else html.escape(w) for w in block]
        tag = rng.choice(("p", "p", "h2", "li", "blockquote"))
        body.append(f"<{tag}>{rng.choice((' ', '  ', chr(10)))}" + rng.choice((" ", "\n\t", "&nbsp;", "<br>")).join(marked)
                    + ("" if tag == "p" and rng.random() < 0.4 else f"</{tag}>"))
        if rng.random() < 0.3:
            body.append(rng.choice(NOISE))
    return "\n".join(text), "".join(body)


def test_blocks_come_back_in_order_without_page_furniture(spark):
    rng = random.Random(4)
    words = ["alpha", "b&c", "x<y", "naïve", "\"quoted\"", "it's", "10", "日本", "fish", "&amp;", "word,"]
    rows, want = [], {}
    for i in range(120):
        text, body = build(rng, words)
        around = [rng.choice(NOISE) for _ in range(4)]
        box = ("<article>", "</article>") if i % 2 else (f"<div class='story story-{i}'>", "</div>")
        rows.append((i, f"http://h{i % 2}.example.com/{i}", f"<!DOCTYPE html><html><head><title>T</title></head><body class='has-sidebar'>"
                     f"{around[0]}{around[1]}{box[0]}{body}{box[1]}{around[2]}{around[3]}</body></html>"))
        want[i] = text
    df = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, host string")
    out = {r["page_id"]: r for r in hm.main_text(df).collect()}
    assert {i: r["text"] for i, r in out.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())
    assert out[0]["path"] == "body.has-sidebar>div.story.story-#".replace("body", "html>body")


def test_host_vote_overrules_a_misleading_page(spark):
    good = "<body><div class=post><p>{}</p></div><div class=teaser><p>Read also.</p></div></body>"
    odd = "<body><div class=post><p>Short.</p></div><div class=teaser><p>" + "A very long teaser text. " * 9 + "</p></div></body>"
    rows = [(i, "http://a.b/", good.format("Body text of the page. " * 5 + str(i))) for i in range(5)] + [(9, "http://a.b/x", odd)]
    out = {r["page_id"]: r["text"] for r in hm.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[9] == "Short."


def test_broken_markup_nulls_repeats_and_empty_table(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "http://x/", "<p>a &lt; b < c <p>d &unknown; &#65;"), (4, "http://x/", "plain"),
            (5, "http://y/", "<p>open <a href=\"never closed>text"), (5, "http://y/", "<p>open <a href=\"never closed>text"),
            (6, "http://z/", "<div>" * 3000 + "deep" + "</div>" * 10), (7, "http://w/", "<p>" + "long " * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in hm.main_text(df).collect()), key=str)
    assert len(out) == len(rows)
    got = dict(x[:2] for x in out)
    assert got[1] == "" and got[2] == "" and got[4] == "plain" and got[6] == "deep" and got[5] == "open text"
    assert got[None] == "a < b < c\nd &unknown; A" and len(got[7]) == 999_999
    assert hm.main_text(df.limit(0)).collect() == []


def test_given_pages_keep_their_articles(spark):
    from pricescope.llm import queries
    out = queries.op7_html_main(spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(out) == len(pages)
    for r in out:
        body = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        plain = html.unescape(__import__("re").sub("<[^>]*>", " ", body))
        assert "".join(r["text"].split()) == "".join(plain.split())


LONG = "A sentence of running text that belongs to the page's own article. "


def test_names_with_a_dropped_word_inside_keep_the_article():
    for open_, close in (("<div class='content has-sidebar'>", "</div>"), ("<div id='page-with-header'>", "</div>"),
                         ("<div class='post-ad-free'>", "</div>"), ("<form>", "</form>"), ("<div class=sidebar>", "</div>")):
        for inner in (f"<article><p>{LONG * 3}</p></article>", f"<div class=text><p>{LONG * 3}</p></div>"):
            page = f"<html><body><nav><p>{LONG}</p></nav>{open_}<div class='site-header'>Name</div>{inner}{close}</body></html>"
            assert hm.extract(page, hm.best_path(page)[0]) == (LONG * 3).strip(), page


def test_comments_and_notices_stay_dropped_beside_an_article():
    for noise in (f"<section id=comments><article class=comment>{LONG * 9}</article></section>", f"<aside><p>{LONG * 9}</p></aside>",
                  f"<div class=cookie-bar>{LONG * 9}</div>", f"<div class='site-footer'>{LONG * 9}</div>"):
        page = f"<body><article><p>{LONG}</p></article>{noise}</body>"
        assert [t for _, t, _ in hm.blocks(page)] == [LONG.strip()]
    page = f"<body><div class=post><p>{LONG}</p></div><div class='comment-list'>{LONG * 9}</div></body>"
    assert hm.extract(page, None) == LONG.strip()


def test_split_articles_without_article_or_main_stay_whole(spark):
    lead, rest, end = "An introduction of the article " * 4, LONG * 15, "The end of the article comes here. " * 3
    split = (f"<div class=post><h1>Title</h1><div class=intro><p>{lead}</p></div><div class=body><p>{rest}</p></div>"
             f"<div class=end><p>{end}</p></div></div>")
    links = "<div class=more><a href=/a>One more page of this site to read</a><a href=/b>Another page of this site to read</a></div>"
    want = "\n".join(x.strip() for x in ("Title", lead, rest, end))
    rows = [(1, "http://a/1", f"<body>{split}{links}</body>"), (2, "http://b/1", f"<body><div class=page>{links}{split}</div></body>"),
            (3, "http://c/1", f"<body><p>{lead}</p><div class=x><p>{rest}</p></div></body>")]
    out = {r["page_id"]: r["text"] for r in hm.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {1: want, 2: want, 3: f"{lead.strip()}\n{rest.strip()}"}


FURNITURE = """reader-comments user-comments comment-thread post-comments commentlist responses ad-slot adsense advert-unit related-posts
related-articles share-this blog-sidebar cookie-policy-bar promo-card breaking-banner legal-notice readerComments comment_area
story-comments sponsored-story newsletter-form social-icons entry-related sidebarleft footerlinks login-box article-sharing""".split()


def test_furniture_inside_the_article_goes_by_any_dropped_word():
    text = "\n".join([LONG.strip()] * 6)
    for name in FURNITURE:
        for box in (f"<div class='{name}'><p>{LONG * 2}</p></div>", f"<section id='{name}'>{LONG * 2}</section>"):
            page = f"<html><body><article>{f'<p>{LONG}</p>' * 6}{box}</article></body></html>"
            assert hm.extract(page, "html>body>article") == text, name


def test_names_that_tell_of_a_state_or_of_the_articles_own_parts_stay():
    for name in ("no-comments", "with-sidebar", "comments-closed", "menu-open", "adfree ad-free", "commentary", "socialism", "entry-header",
                 "article-footer", "shareholders", "admin", "download", "formation", "navigator"):
        page = f"<body><div class='{name}'><p>{LONG * 2}</p></div><div class=text><p>{LONG * 3}</p></div></body>"
        assert len([t for _, t, _ in hm.blocks(page)]) == 2, name


def test_long_comments_never_outweigh_a_short_article():
    page = f"<body><div class=post><p>{LONG}</p></div><div class='reader-comments'><p>{LONG * 20}</p></div></body>"
    assert hm.extract(page, None) == LONG.strip()
    page = f"<body><div class='social-story'><p>{LONG * 9}</p></div><p>{LONG}</p></body>"
    assert hm.extract(page, None).startswith((LONG * 9).strip())


def test_an_article_is_not_lost_to_a_little_text_at_the_hosts_path(spark):
    rows = [(i, f"http://a/{i}", f"<body><div class=content><p>{LONG * 4}</p></div></body>") for i in range(3)]
    rows += [(3, "http://a/3", f"<body><div class=content><p>Short teaser.</p></div><article><p>{LONG * 5}</p></article></body>")]
    out = {r["page_id"]: r["text"] for r in hm.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {0: (LONG * 4).strip(), 1: (LONG * 4).strip(), 2: (LONG * 4).strip(), 3: (LONG * 5).strip()}


def test_known_articles_of_generated_pages_without_article_elements(spark):
    """A whole table: hosts with a template each, furniture with made-up names, articles of one to twelve blocks."""
    rng = random.Random(11)
    words = "river stone quiet under morning seven paper lamp border winter signal copper orchard thread".split()
    kinds = ["comments", "related", "promo", "sidebar", "cookie", "share", "ad", "newsletter", "breadcrumbs", "footer", "sponsor"]
    rows, want = [], {}
    for i in range(300):
        h = i % 12
        blocks = [" ".join(rng.choices(words, k=rng.randint(12, 60))) for _ in range(rng.randint(1, 12))]

        def extra(tag):
            kind = rng.choice(kinds)
            name = rng.choice([f"{kind}-{rng.choice(words)}", f"{rng.choice(words)}_{kind}", f"{rng.choice(words)}{kind.title()}"])
            return f"<{tag} class='{name} x{rng.randint(1, 9)}'><p>{' '.join(rng.choices(words, k=rng.randint(3, 40)))}</p></{tag}>"

        body = "".join(f"<p>{b}</p>" + (extra("div") if rng.random() < 0.2 else "") for b in blocks)
        box = f"<div class='{words[h]}-text n{i}'>{body}{extra('section')}</div>"
        wrap = f"<div class=wrap{h}>{extra('div')}{box}{extra('div')}</div>"
        rows.append((i, f"https://h{h}.example.org/{i}", f"<html><body><nav><a href=/>Home</a></nav>{wrap}{extra('div')}</body></html>"))
        want[i] = "\n".join(blocks)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert {r["page_id"]: r["text"] for r in hm.main_text(df).collect()} == want
