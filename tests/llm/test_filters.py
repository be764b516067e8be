import re
import zlib
from collections import Counter as Bag
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import awkward, empty, frame, prose
from pyspark.sql import functions as F

from lociweave.llm import decontamination, html_text, quality, toxicity

# Benchmark decontamination


def serial_matches(docs, items):
    def shingles(text):
        w = re.findall(r"[^\W_]+", (text or "").lower())
        return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    found = []
    for doc, text in docs:
        have = shingles(text)
        for item, other in set(items):
            want = shingles(other)
            if want and len(have & want) >= 0.8 * len(want) - 1e-9:
                found.append((doc, item, len(want), len(have & want)))
    return found


@pytest.mark.parametrize("block_bytes", [200, 8 << 20])
def test_decontamination(spark, block_bytes):
    passage = prose(11, 40).split()
    items = [(i, prose(20 + i, 15 + i)) for i in range(12)] + [(50, " ".join(passage)), (50, " ".join(passage)), (51, None), (52, ""), (53, "two words"), (None, prose(99, 30))]
    long = prose(6, 9000)
    docs = awkward() + [
        (100, long + " " + " ".join(passage) + " " + long), (101, " ".join(passage[:35]).upper() + "!"), (102, " ".join(passage[:20])),
        (103, " ".join(passage[:18] + ["changed"] + passage[19:])), (104, "Two words"), (105, "these two words here and there"), (106, prose(99, 30) + "\n" + prose(21, 16)),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.matches(frame(spark, docs), table, block_bytes=block_bytes).collect()
    want = serial_matches(docs, items)
    assert Bag((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in got) == Bag(want)
    assert {w[0] for w in want} >= {100, 101, 103, 104, 106} and 102 not in {w[0] for w in want}
    kept = decontamination.clean(frame(spark, docs), table, block_bytes=block_bytes)
    bad = {w[0] for w in want}
    assert Bag(tuple(r) for r in kept.collect()) == Bag(tuple(r) for r in frame(spark, docs).collect() if r.doc_id not in bad or r.doc_id is None)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.matches(frame(spark, docs), none).count() == 0 and decontamination.clean(empty(spark), table).count() == 0


# Quality rules


def serial_statistics(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    inside = {j for v in places.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_statistics(spark):
    rows = awkward() + [(20, "a b c a b c a b"), (21, "x y z " * 40), (22, "a # b | c <d> * $5 %\na # b\n\n a # b\n"), (23, "\x1fa b c")]
    got = frame(spark, rows).select("doc_id", quality.statistics(F.col("text")).alias("s")).select("doc_id", *[f"s.{c}" for c in quality.BASE]).collect()
    assert Bag(map(tuple, got)) == Bag((i, *serial_statistics(t)) for i, t in rows)


def test_rules_are_learned_and_emitted(spark):
    rows, marks = [], []
    for i in range(600):
        bad = i % 5 == 0
        text = prose(i, 80 + i % 50)
        rows.append((i, " ".join(w + "#|" if bad else w for w in text.split())))
        marks.append((i, 0 if bad else 1))
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int")
    rules = quality.learn(quality.with_statistics(docs), labels)
    assert rules and "symbol_share" in {c.feature for r in rules for c in r} | {"mark_share"} & {c.feature for r in rules for c in r} | {"symbol_share"}
    judged = quality.judge(docs, labels).collect()
    assert all(r.kept == (r.doc_id % 5 != 0) for r in judged) and not any(r.base_failed for r in judged)
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in judged if r.kept}
    plan = quality.judge(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = awkward()
    got = quality.judge(frame(spark, rows), none).collect()
    failed = lambda t: (s := serial_statistics(t))[0] < 50 or 100 * s[4] > 50 * s[0]
    assert Bag((r.doc_id, r.base_failed, r.kept) for r in got) == Bag((i, failed(t), not failed(t)) for i, t in rows)
    odd = spark.createDataFrame([(None, 0), (6, None), (6, 1), (6, 1), (7, 0)], "doc_id long, quality int")
    assert quality.judge(frame(spark, rows), odd).count() == len(rows)
    assert quality.judge(empty(spark), none).count() == 0


# Main text of pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li>News</ul></nav><div class="cookie-notice">We use cookies</div>
<div class="top-ad">Buy &amp; save</div><article><header><h1>Title &amp; more</h1></header><p>First <b>bold</b>er   para&shy;graph &lt;3<p>Short.
<div>Nested<br>line</div><form><input name=q>Search</form><ul><li>one<li>two</ul><section class=comments><p>I disagree!</p></section></article>
<aside>Related</aside><div hidden>Secret</div><footer>&copy; 2020</footer>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n\n") == ["Title & more", "First bolder para­graph <3", "Short.", "Nested line", "one", "two"]
    prose_page = "<div id=content><p>" + prose(1, 60) + "</p><p>Short end.</p></div><div><a href=a>a</a><a href=b>b</a><a href=c>c</a></div>"
    assert html_text.main_text(prose_page) == prose(1, 60) + "\n\nShort end."
    assert html_text.main_text("") == html_text.main_text("<div></div><!-- x --><script>alert(1)") == ""
    assert html_text.main_text("just text &#x41;") == "just text A"
    assert html_text.main_text("<div>" * 20_000 + "deep") == "deep"


def test_extract(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "", "y"), (3, "w", "<p>" + "word " * 50_000, "z")], "page_id long, url string, html string, text string"
    )
    got = html_text.extract(pages).collect()
    want = [(p.page_id, p.url, html_text.main_text(p.html or "")) for p in pages.collect()]
    assert Bag((r.page_id, r.url, r.text) for r in got) == Bag(want) and all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(pages.limit(0)).count() == 0


# Toxicity


def toxic_corpus(n=900):
    rows, marks = [], []
    for i in range(n):
        words = prose(i, 60).split()
        if i % 3 == 0:
            words[10 + i % 40] = ("wickedly", "rottenish", "Vilest")[i % 9 // 3]
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 3 == 0)))
    return rows, marks


def test_toxicity(spark):
    rows, marks = toxic_corpus()
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    extra = [(None, "wickedly"), (5000, None), (5001, ""), (5001, ""), (5002, "wickedly " * 30_000)]
    got = toxicity.classify(frame(spark, rows + extra), labels).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(marks)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    # Labels of held-out documents are not used.
    flipped = spark.createDataFrame([(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in marks], "doc_id long, toxic int")
    again = toxicity.classify(frame(spark, rows + extra), flipped).collect()
    assert Bag((r.doc_id, round(r.score, 9)) for r in again) == Bag((r.doc_id, round(r.score, 9)) for r in got)


def test_toxicity_without_labels(spark):
    rows = awkward()
    for marks, score in ([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (None, 1), (2, None)], 0.0):
        got = toxicity.classify(frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
        assert len(got) == len(rows) and all(abs(r.score - score) < 1e-9 for r in got)
    assert toxicity.classify(empty(spark), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0
    assert toxicity.places("").tolist() == toxicity.places("").tolist() and len(toxicity.places("abc" * 10)) > 5
    assert (toxicity.places("x" * 100) == toxicity.places("x" * 5_000)).all()
