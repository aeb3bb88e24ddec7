import html as entities
import os
import re

import random
import resource
import time
from html.parser import HTMLParser

import pytest

from tramloom.llm.html import Page, extract_main_text, main_text_of

ARTICLE = "<p>The first paragraph, with &amp; and <b>bold</b>er text.</p><p>A second one<br>after a break, long enough to count as text.</p>"
TEXT = "The first paragraph, with & and bolder text. A second one after a break, long enough to count as text."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style>{head}</head><body>{body}</body></html>"


def _one(html, paths=()):
    return main_text_of(html, dict.fromkeys(paths, 1))


def test_what_is_not_the_article_goes():
    noise = "<nav><ul><li><a href='/'>Home</a></li></ul></nav><header><h2>Site</h2></header><div class='ad'>Buy now, cheap.</div><script>var t='</p>';</script><!-- hidden -->"
    tail = "<aside>More links</aside><form><p>Name</p></form><footer>&copy; all</footer><div id='comments'><p>I think, as a reader, that this article is long and good.</p></div>"
    for container in ("article", "main", "div class='post-content'"):
        close = container.split()[0]
        assert _one(page(f"{noise}<{container}>{ARTICLE}</{close}>{tail}")) == TEXT


def test_within_the_article_too():
    inside = f"<article><div class='share-buttons'>Tweet</div>{ARTICLE}<div class='cookie-notice'>We use cookies</div><section class='comments'><p>Nice</p></section><button>More</button></article>"
    assert _one(page(inside)) == TEXT


def test_malformed_pages():
    assert _one("<article><h1>Head</h1><p><b>Unclosed bold.<br><p>Next &eacute;t&eacute;") == "Head Unclosed bold. Next été"
    assert _one("plain words, no markup at all") == "plain words, no markup at all"
    assert _one("") == "" and _one("<p") == "" and _one("<!-- open <p>x</p>") == ""
    assert _one("<p>a < b and c > d</p>") == "a < b and c > d"
    assert _one("<div><p>One, a paragraph.</p></span></div></div><p>Two</p>") == "One, a paragraph."


WRAPPERS = [
    "<div class='layout has-sidebar'>{}</div>", "<div class='page no-sidebar'>{}</div>", "<form id='aspnetForm' action='/'><input type='hidden' value='x'>{}</form>", "<div id='search-results-page'>{}</div>",
    "<div class='content widget'>{}</div>", "<div class='post comments-open'>{}</div>", "<div class='widget'>{}</div>", "<body class='login-page'>{}", "<section id='related-content-main' role='region'>{}</section>",
    "<div class='modal-open'><div class='ads-enabled'>{}</div></div>", "<div class='sidebar-layout cookie-banner-shown'>{}</div>", "<span class='share'>{}</span>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("tag", ["article", "div", "div class='text'"])
def test_wrappers_named_after_what_they_may_hold(wrapper, tag):
    """The article stays, whatever words stand on what is around it; what is around it within the wrapper goes."""
    extra = "<div class='sidebar'><p>Other stories of the day.</p></div><nav>Home</nav><div class='comments'><p>Well said, I think.</p></div>"
    whole = f"<{tag}>{ARTICLE * 4}</{tag.split()[0]}>{extra}"
    assert _one(page(wrapper.format(whole))) == " ".join([TEXT] * 4)


def test_long_comments_and_small_forms_go():
    comments = "<section class='comments'>" + "<article class='comment'><p>I read all of this, and a reader may well write more than the author did.</p></article>" * 12 + "</section>"
    form = "<form class='signup'><p>Leave your name, and we write to you.</p></form>"
    assert _one(page(f"<div class='story'>{ARTICLE}</div>{form}{comments}")) == TEXT
    assert _one(page(f"<div><div class='story'>{ARTICLE}{form}</div>{comments}</div>")) == TEXT


def test_never_empty_while_there_is_text():
    for body in ("<nav><p>Only a menu, here.</p></nav>", "<aside>Only a menu, here.</aside>", "<div class='ad'>Only a menu, here.</div>", "<div hidden>Only a menu, here.</div>", "<nav>Only a menu, here.<script>x()</script>"):
        assert _one(page(body)) == "Only a menu, here."
    assert _one(page("<script>x</script><style>y</style>")) == ""


@pytest.mark.parametrize("kind", ["<div>", "<div class='a b c'>", "<span>", "<div><span><p>", "<b class='ad'>", "<td>", "<article>", "<div class='comments'><article>"])
def test_deep_pages_take_linear_time_and_memory(kind):
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    deep = page(kind * 50_000 + "deep <p>down, at last.</p>" + "</b></td></span>" * 20_000 + "<p>up</p>" * 5_000)
    began = time.process_time()
    read = Page(deep)
    assert main_text_of(deep, {}) and read.held() is not None
    assert time.process_time() - began < 12
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000


class Tree(HTMLParser):
    """An independent reading of well-formed pages: the text of the element with the id story, without what the test planted."""

    def __init__(self):
        super().__init__()
        self.depth, self.inside, self.gone, self.text = 0, 0, 0, []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += [" "] * bool(self.inside)
            return
        self.depth += 1
        have = dict(attrs)
        if have.get("data-story"):
            self.inside = self.depth
        if have.get("data-gone") and not self.gone:
            self.gone = self.depth
        if self.inside and not self.gone and tag in ("p", "div", "section", "h2"):
            self.text.append(" ")

    def handle_endtag(self, tag):
        if self.inside and not self.gone and tag in ("p", "div", "section", "h2"):
            self.text.append(" ")
        if self.inside == self.depth:
            self.inside = 0
        if self.gone == self.depth:
            self.gone = 0
        self.depth -= 1

    def handle_data(self, data):
        if self.inside and not self.gone:
            self.text.append(data)


def _template(rng):
    """A page's frame of random wrappers, boxes around and within the story; never an article element."""
    words = lambda n: " ".join(rng.choice(["tram", "the", "line", "of", "a", "city", "was", "late,", "again."]) for _ in range(n))
    wraps = rng.sample(["layout has-sidebar", "page no-sidebar", "wrap", "grid-2 comments-open", "site nav-collapsed", "container ads-enabled"], 2)
    outside = rng.sample(["sidebar", "footer-links", "comments", "cookie-notice", "related-posts", "newsletter", "share-bar"], 3)
    within = rng.sample(["ad-slot", "share-buttons", "newsletter-signup"], 2)
    name = rng.choice(["story-body", "post", "text", "c-17", "entry-content"])

    def made(rng2):
        body = lambda n: " ".join(rng2.choice(["rail", "stop", "bus", "went", "on", "and", "then,", "the", "end."]) for _ in range(n))
        story = "".join(f"<p>{body(rng2.randrange(30, 60))}</p>" + (f"<div class='{rng2.choice(within)}' data-gone='1'><p>{words(5)}</p></div>" if rng2.random() < 0.5 else "") for _ in range(rng2.randrange(3, 7)))
        boxes = [f"<div class='{c}'><p>{words(rng2.randrange(4, 15))}</p></div>" for c in outside]
        inner = f"{boxes[0]}<div class='{name}' data-story='1'><h2>{body(5)}</h2>{story}</div>{boxes[1]}"
        return f"<!DOCTYPE html><html><head><title>{words(3)}</title></head><body><div class='{wraps[0]}'><div class='{wraps[1]}'>{inner}</div>{boxes[2]}</div></body></html>"

    return made


def test_hosts_of_mixed_templates_without_article_elements(spark):
    rng = random.Random(8)
    rows = [(100 * h + 10 * t + i, f"https://h{h}.example/{i}", made(rng)) for h in range(4) for t, made in enumerate(_template(rng) for _ in range(5)) for i in range(8)]

    def want(source):
        tree = Tree()
        tree.feed(source)
        return " ".join("".join(tree.text).split())

    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for options in ({}, {"path_bytes": 0}):
        got = {r["page_id"]: r["main_text"] for r in extract_main_text(pages, **options).collect()}
        wrong = [i for i, _, source in rows if got[i] != want(source)]
        assert len(wrong) <= 0.03 * len(rows), [(got[i], want(s)) for i, _, s in rows if i in wrong[:2]]


def test_host_consensus_corrects_a_page_with_a_longer_side_text(spark):
    rows = [(i, f"https://Host.example/{i}", page(f"<div class='story-{i}'>{ARTICLE}</div><div class='more-stuff'><p>Short side text.</p></div>")) for i in range(6)]
    side = "<p>" + "Promised, later, and longer than the story of this page. " * 9 + "</p>"
    rows.append((9, "https://host.example/9", page(f"<div class='story-9'>{ARTICLE}</div><div class='more-stuff'>{side}</div>")))
    rows += [(20, None, None), (21, "x", ""), (22, "https://host.example/22", page("<main><p>Another template, on the same host.</p></main>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["main_text"] for r in extract_main_text(pages).collect()}
    assert all(got[i] == TEXT for i in (*range(6), 9))
    assert got[20] == "" and got[21] == "" and got[22] == "Another template, on the same host."
    assert extract_main_text(pages.limit(0)).collect() == []


def test_a_host_with_forty_templates(spark):
    """Every template's path wins on its own pages, whatever its rank among the host's; containers that differ in a late class don't merge."""
    letters = [f"{a}{b}" for a in "qwert" for b in "yuiopasd"]
    side = "<p>" + "Promised, later, and longer than the story of this page. " * 9 + "</p>"
    body = lambda t, more="": page(f"<div class='a b c d {t}-story'>{ARTICLE}</div><div class='a b c d more-stuff'>{more or '<p>Short side text.</p>'}</div>")
    rows = [(10 * n + i, "https://one.example/x", body(t, side if i == 5 else "")) for n, t in enumerate(letters) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for options in ({}, {"path_bytes": 0}):
        got = {r["page_id"]: r["main_text"] for r in extract_main_text(pages, **options).collect()}
        assert len(got) == 240 and all(x == TEXT for x in got.values())


def test_votes_by_broadcast_and_by_shuffle_agree(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    one, two = (extract_main_text(pages, **o).select("page_id", "main_text") for o in ({}, {"path_bytes": 0}))
    assert one.count() == two.count() and one.exceptAll(two).isEmpty()


def brute(source):
    """The test pages keep their article in one element of that name: its text, by patterns alone."""
    inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
    inner = re.sub(r"<!--.*?-->|<(script|style|form|nav|aside|footer)\b.*?</\1>|<div class=\"(?:ad|comments|cookie|share)[^>]*>.*?</div>", "", inner, flags=re.S)
    inner = re.sub(r"</?(?:p|h[1-6]|br|div|ul|ol|li|blockquote|pre|table|tr|td|section)\b[^>]*>", " ", inner)
    return " ".join(entities.unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_whole_table_against_patterns(spark, sf):
    pages = spark.read.parquet(f"{os.path.dirname(sf)}/sf0.01/pages.parquet")
    want = {r["page_id"]: brute(r["html"]) for r in pages.collect()}
    for options in ({}, {"path_bytes": 0}):
        got = {r["page_id"]: r["main_text"] for r in extract_main_text(pages, **options).collect()}
        assert got == want


def test_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = extract_main_text(pages).collect()
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(rows) == len(sources)
    for r in rows:
        assert r["n_chars"] == len(r["main_text"]) > 0
        html = sources[r["page_id"]]
        assert "©" not in r["main_text"] and "<" not in r["main_text"]
        advert = html.split('class="ad">')[1].split("</div>")[0]
        assert not r["main_text"].startswith(advert)
