"""Templates are counted over different pages of a host."""

import random
from collections import defaultdict

import pytest

from larkspur.llm import html_text, queries

SCHEMA = "page_id long, url string, html string"


def test_copies_of_a_page_are_no_template(spark):
    copy = "<body><div><p>Only story.</p></div><ul><li>its list</li></ul></body>"
    inside = "<article><p>Opening.</p><div>own part</div></article>"
    rows = [(i, "http://a.example/x", copy) for i in range(9)] + [(10, "http://a.example/y", "<body><p>Another</p></body>")]
    rows += [(20 + i, f"http://b.example/{i}", inside) for i in range(6)]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "Only story.\n\nits list" for i in range(9)) and got[10] == "Another"
    assert all(got[20 + i] == "Opening.\n\nown part" for i in range(6))


def test_blocks_on_a_small_part_of_a_hot_host_are_templates(spark):
    def page(i):
        box = "<div><p>Read our other stories</p></div>" if i % 20 == 0 else "<div><p>seen thrice</p></div>" if i in (1, 2, 3) else ""
        return f"<body><div><p>Story {i}.</p></div>{box}</body>"
    rows = [(i, "http://hot.example/", page(i)) for i in range(1200)]         # 60 pages, 5 %
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [i for i in range(1200) if got[i] != f"Story {i}."] == [1, 2, 3]


def brute(rows, rules=True, least=html_text.TEMPLATE_PAGES, share=html_text.TEMPLATE_SHARE):
    """{page_id: (text, blocks of templates, blocks by rules)} with plain loops over every page's subtrees."""
    hosts = defaultdict(list)
    for i, url, page in rows:
        host = (url or "").split("//", 1)[1].split("/")[0].lower() if "//" in (url or "") else ""
        hosts[host].append((i, html_text.blocks(page or "", rules)))
    out = {}
    for pages in hosts.values():
        different = {tuple(t for t, m, _ in bs if m): bs for _, bs in reversed(pages) if bs}
        count = defaultdict(int)
        for bs in different.values():
            for h in {h for *_, under in bs for h in under}:
                count[h] += 1
        templates = {h for h, n in count.items() if n >= least and n >= share * len(different)}
        for i, bs in pages:
            kept = [(t, m) for t, m, under in bs if not templates & set(under)]
            out[i] = ("\n\n".join(t for t, m in kept if m), len(bs) - len(kept), sum(not m for _, m in kept))
    return out


def extracted(spark, rows, **options):
    got = html_text.extract(spark.createDataFrame(rows, SCHEMA).repartition(4), **options).collect()
    return {r["page_id"]: (r["text"], r["n_template_blocks"], r["n_rule_blocks"]) for r in got}


def site(host, n, rng, marked):
    """Pages of one site: own text between blocks that the site repeats; ``marked`` names these by tag and class."""
    nav, side = ("<nav>", "</nav>") if marked else ("<div class=x1>", "</div>"), ("<aside>", "</aside>") if marked else ("<div id=q>", "</div>")
    for k in range(n):
        own = "".join(f"<p>{host} text {k} {rng.random()}</p>" for _ in range(rng.randrange(1, 4)))
        share = "<div><span>Share</span> this</div>"
        yield (f"<html><head><title>t {k}</title></head><body>{nav[0]}<ul><li>Home</li><li>News</li></ul>{nav[1]}"
               f"<div class=c{k % 3}>{own}{share}</div>{side[0]}<p>Most read</p><p>Join us</p>{side[1]}<div><p>All rights reserved</p></div></body></html>")


@pytest.mark.parametrize("rules", [True, False])
def test_extraction_equals_plain_counting(spark, rules):
    rng = random.Random(5)
    rows = []
    for h, n, marked in (("a.example", 40, True), ("b.example", 25, False), ("few.example", 3, True), ("one.example", 1, False)):
        rows += [(len(rows) + j, f"https://{h}/p/{j}", page) for j, page in enumerate(site(h, n, rng, marked))]
    rows += [(len(rows), None, None), (len(rows) + 1, "x", ""), (len(rows) + 2, "https://A.example/copy", rows[0][2])]
    rows += [(len(rows) + j, f"https://c.example/{j}", f"<main><article><h1>T{j}</h1><p>p {j}</p><div>Same box</div></article></main><div>foot</div>") for j in range(9)]
    assert extracted(spark, rows, rules=rules) == brute(rows, rules)


def test_templates_alone_clear_a_site_with_many_pages(spark):
    rng = random.Random(1)
    for marked in (True, False):
        rows = [(j, f"https://a.example/{j}", page) for j, page in enumerate(site("a.example", 30, rng, marked))]
        for i, (text, by_template, by_rule) in extracted(spark, rows, rules=False).items():
            assert all(t.startswith(f"a.example text {i} ") for t in text.split("\n\n")) and by_template >= 6 and by_rule == 0


def test_every_article_of_a_page():
    def texts(page):
        return [t for t, main, _ in html_text.blocks(page) if main]
    assert texts("<article><p>one</p></article><p>between</p><article><p>two and more</p></article>") == ["one", "two and more"]
    assert texts("<main><p>" + "long text " * 20 + "</p><article><p>teaser</p></article></main><footer>f</footer>") == [("long text " * 20).strip(), "teaser"]
    assert texts("<main><article><p>a story of some length</p></article><p>x</p></main>") == ["a story of some length"]
    assert texts("<article><p>out</p><article><p>in</p></article></article>") == ["out", "in"]


def test_the_query_equals_plain_counting(spark, sf_dir):
    rows = queries.QUERIES["op1_site_template_text"](spark, sf_dir).collect()
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert {r["page_id"]: (r["text"], r["n_template_blocks"], r["n_rule_blocks"]) for r in rows} == brute(pages)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
