"""What the page operator keeps on disk, and rows that are alike."""

import os
import random

from larkspur.llm import html_text
from larkspur.session import _app_root

SCHEMA = "page_id long, url string, html string"


def stored(spark):
    root = _app_root(spark).replace("file:", "")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(root) for f in files)


def test_texts_are_not_kept_beside_their_shuffle(spark):
    rng = random.Random(3)
    rows = [(i, f"https://a.example/{i}", f"<body><div>menu</div><p>{rng.randbytes(4000).hex()}</p></body>") for i in range(100)]
    before = stored(spark)
    out = html_text.extract(spark.createDataFrame(rows, SCHEMA))
    assert stored(spark) - before < sum(len(r[2]) for r in rows) / 5      # texts of random digits pack to half at best
    got = {r["page_id"]: (r["text"], r["n_template_blocks"]) for r in out.collect()}
    assert got == {i: (page.split("<p>")[1].split("</p>")[0], 1) for i, _, page in rows}


def test_repeated_rows_and_null_keys_stay_rows(spark):
    def page(i):
        return f"<body><div>menu</div><p>story {i}</p><div>menu</div></body>"
    rows = [(i % 7 or None, f"https://a.example/{i % 7}", page(i % 7)) for i in range(70)]
    rows += [(None, None, None), (None, None, ""), (1, None, page(1)), (1, "https://b.example/1", page(1))] * 2
    out = html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [(i, url, f"story {k}", 2, 0) for k in range(7) for i, url in [(k or None, f"https://a.example/{k}")] for _ in range(10)]
    want += [(None, None, "", 0, 0)] * 4 + [(1, None, "menu\n\nstory 1\n\nmenu", 0, 0), (1, "https://b.example/1", "menu\n\nstory 1\n\nmenu", 0, 0)] * 2
    got = [(r["page_id"], r["url"], r["text"], r["n_template_blocks"], r["n_rule_blocks"]) for r in out]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
