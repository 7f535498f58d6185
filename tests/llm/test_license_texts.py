"""Whole notices, near ones told apart, and the scan against one that looks everywhere."""

import random

import pyarrow as pa
import pytest

from larkspur.llm import licenses


def test_every_template_is_reported_as_itself_and_whole(spark):
    names = sorted(licenses.TEMPLATES)
    whole = {n: licenses.plain(t) for n, t in licenses.TEMPLATES.items()}
    rows = [(i, f"é x. {whole[n]} tail") for i, n in enumerate(names)]
    got = {r["doc_id"]: r["matches"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, n in enumerate(names):
        assert [(m["license"], m["coverage"]) for m in got[i]] == [(n, 1.0)], n
        words = whole[n].split()
        assert rows[i][1][got[i][0]["start"]: got[i][0]["end"]].split()[-1].strip(".,\")") == words[-1].rstrip(".>/,\")")


def test_notices_end_with_their_disclaimers():
    assert licenses.TEMPLATES["mit"].endswith("DEALINGS IN THE SOFTWARE.") and licenses.TEMPLATES["isc"].endswith("PERFORMANCE OF THIS SOFTWARE.")
    assert all(licenses.TEMPLATES[n].endswith("SUCH DAMAGE.") for n in ("bsd-2-clause", "bsd-3-clause"))


NEAR_MISSES = [
    "Released under the Zlib License.",
    "The album was released under the Sony license",
    "It was released under the new driving license last year",
    "This work is licensed under the GNU General Public License, version 1.",
    "Licensed under CC BY-NC-SA 3.0.",
    "This work is licensed under a Commercial Attribution 4.0 International License.",
    "Licensed under the Apache License, Version 1.1.",
    "This work is licensed under a Creative Commons Attribution 3.0 International License.",
    "Licensed under CC BY-XX 4.0.",
    "This work is licensed under the GNU Free Documentation License, version 3.",
]


def test_near_misses_are_no_matches(spark):
    rows = list(enumerate(NEAR_MISSES))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["matches"]) for r in got if r["n_matches"]] == []


def everywhere(index, h):
    """Matches of a text with a template tried at every place, without fingerprints."""
    found = []
    for t, template in enumerate(index.words):
        for d in range(-len(template), len(h) + 1):
            pairs = licenses.tightest(template, h, d, licenses.BAND + len(template) // 10)
            if index.fits(t, h, pairs):
                found.append((len(pairs), -t, pairs[0][1], pairs[-1][1]))
    return licenses.chosen(index, found)


@pytest.mark.parametrize("seed", range(3))
def test_scan_equals_trying_every_place(spark, seed):
    rng = random.Random(seed)
    lines = {n: t for n, t in licenses.TEMPLATES.items() if n.endswith("-line") or n in ("mpl-2.0-header", "cc0-1.0-notice", "isc-grant")}
    hasher = licenses._hasher()
    index = licenses.Index(lines, hasher)
    filler = "the work is of a free and public kind license version 2 3 4 0 by cc under released other words here".split()
    texts = []
    for _ in range(25):
        parts = []
        for _ in range(rng.randrange(4)):
            words = licenses.plain(lines[rng.choice(index.names)]).split()
            for _ in range(rng.randrange(3)):                      # some words lost, changed or put in
                k = rng.randrange(len(words))
                words[k: k + rng.randrange(2)] = rng.choices(filler, k=rng.randrange(2))
            parts += [*rng.choices(filler, k=rng.randrange(6)), *words]
        texts.append(" ".join(parts))
    got = {r["doc_id"]: r["matches"] for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), lines).collect()}
    for i, text in enumerate(texts):
        h, _, start, end = hasher.words(pa.array([text]))
        want = [(index.names[t], round(c, 9), int(start[a]), int(end[z])) for t, c, a, z in everywhere(index, h)]
        assert [(m["license"], round(m["coverage"], 9), m["start"], m["end"]) for m in got[i]] == want, text
