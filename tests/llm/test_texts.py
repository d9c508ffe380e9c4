"""Licence scan, WARC derivatives, languages and toxicity."""

import json
import random
import re
import zlib

import pytest

from rollcall.llm import langid, licenses, toxicity, warc

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def plain_scan(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [
        (i, label) for phrase, label in BASE.items() for i in range(len(words)) if words[i : i + phrase.count(" ") + 1] == phrase.split()
    ]
    places = [i for i, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def test_licenses(spark):
    rnd = random.Random(1)
    parts = ["CC BY", "cc-by", "General  Public\nLicense", "ALL rights", "reserved", "by", "cc", "É", "x_y", "cc by cc by", "ſ", "licensé", "-", "3.0"]
    texts = [rnd.choice([" ", ".", ""]).join(rnd.choice(parts) for _ in range(rnd.randrange(12))) for _ in range(400)]
    texts += [None, "", "a " * 50_000 + "cc by", "SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH x-exception) AND BSD-3-Clause # end"]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(None, "cc by", "z")], "doc_id long, text string, labels string")
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_scan(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert rows[len(texts) - 1].labels == "bsd-3-clause,gpl-2.0-only,mit" and rows[None].n_base == 1
    assert licenses.scan_licenses(docs.where("false")).count() == 0


@pytest.mark.parametrize(
    "text,form,value",
    [
        ("mit or gpl-3.0 and isc", "(mit or (gpl-3.0 and isc))", 0.1),
        ("(mit or gpl-3.0) and isc", "((mit or gpl-3.0) and isc)", 0.1),
        ("gpl-2.0 with cp-exception or agpl-3.0", "((gpl-2.0 with cp-exception) or agpl-3.0)", 0.45),
        ("gpl-2.0 and mpl-2.0 */", "(gpl-2.0 and mpl-2.0)", 0.6),
        ("(mit and", "mit", 0.1),
        ("mit)", "mit", 0.1),
    ],
)
def test_expressions(text, form, value):
    found = licenses.evaluate(text)
    assert found[2] == form and found[1] == pytest.approx(value)


def test_no_expression():
    assert licenses.evaluate("") is None and licenses.evaluate(") and") is None and licenses.evaluate("and mit") is None


PAGE = (
    "<!DOCTYPE html><html><head><title>A &amp; <b>B</b></title><style>p{}</style><script>var t='</p>';</script></head>"
    "<body><!-- no --><p class='x>y'>One<br>two &lt;3&gt;</p><a href=\"/a?b=1&amp;c\">link</a><img src=i.png>tail<script>x"
)


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/", PAGE, "z"), (2, None, None, "z"), (3, "http://b/", "", "z"), (1, "http://a/", PAGE, "z"), (None, "http://c/", "é" * 100_000, "z")],
        "page_id long, url string, html string, record string",
    )
    made = warc.responses(pages)
    rows = warc.derive(made).collect()
    assert len(rows) == 10
    sources = {r.page_id: warc.parse(bytes(r.record)) for r in made.collect()}
    for r in rows:
        headers, block = warc.parse(bytes(r.record))
        headers, source = dict(headers), dict(sources[r.page_id][0])
        assert headers["WARC-Type"] == r.record_type and headers["WARC-Refers-To"] == r.refers_to == source["WARC-Record-ID"]
        assert headers["WARC-Block-Digest"] == warc.digest(block) == r.block_digest and len(block) == r.content_length
        assert r.source_digest == source["WARC-Payload-Digest"] and headers["WARC-Target-URI"] == source["WARC-Target-URI"]
        if r.record_type == "metadata":
            about = json.loads(block)
            assert dict(about["source-headers"]) == source
            assert about["payload-digest"] == about["computed-payload-digest"]
        if r.page_id == 1:
            if r.record_type == "metadata":
                assert about["title"] == "A & B" and about["links"] == ["/a?b=1&c", "i.png"]
            else:
                assert block.decode() == "A & B\nOne\ntwo <3>\nlinktail"
    assert len({r.record_id for r in rows}) == 8
    assert warc.derive(warc.responses(pages.where("false"))).count() == 0


def test_other_records(spark):
    data = [(1, b"junk"), (2, None), (3, warc.record([("WARC-Type", "request")], b"GET /")), (4, warc.response(4, "u", "x")[:-40])]
    got = warc.derive(spark.createDataFrame(data, "page_id long, record binary")).collect()
    assert [(r.page_id, r.record_type, r.record_id) for r in got] == [(1, "invalid", None), (2, "invalid", None), (4, "invalid", None)]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_languages(spark):
    rnd = random.Random(3)
    parts = {"aa": ["ka", "lo", "mi"], "bb": ["ße", "ün", "är", "ka"], "cc": ["ションの", "日本", "lo"]}
    data = []
    for i in range(400):
        lang = rnd.choice(list(parts))
        text = " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(5, 80)))
        shown = lang if not held(i) else "wrong"  # must not be looked at
        data.append((i, text, shown if i % 17 else None, lang))
    extra = [(1000, None, "aa", None), (1001, "", "aa", None), (1002, "123 !?", "aa", None), (None, "ka lo", None, None), (3, "İİ ka", None, None)]
    docs = spark.createDataFrame(data + extra, "doc_id long, text string, lang string, score string")
    s = langid.Settings(sample_rows=300)
    rows = langid.predict(docs, langid.fit(docs, s), s).collect()
    assert len(rows) == len(data) + len(extra)
    by = {r.doc_id: r for r in rows}
    right = [by[i].lang_pred == lang for i, _, _, lang in data if held(i)]
    assert sum(right) >= 0.95 * len(right) and all(0 <= r.score <= 1 for r in rows)
    assert all(by[i].lang_pred == "und" for i in (1000, 1001, 1002))
    none = docs.where("false")
    assert langid.predict(none, langid.fit(none, s), s).count() == 0
    assert langid.predict(docs, langid.fit(none, s), s).where("lang_pred <> 'und'").count() == 0


def test_segments_are_maximal():
    rnd = random.Random(5)

    def plain(scores):
        """Maximal segments by their definition: take the best, then go on left and right of it."""
        best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
        if best[0] <= 0:
            return []
        i, j = best[3:]
        return [*plain(scores[:i]), (i, j - 1, best[0]), *[(a + j, b + j, c) for a, b, c in plain(scores[j:])]]

    for _ in range(200):
        n = rnd.randint(0, 14)
        found = [(i, rnd.choice([-3.0, 1.25, 2.5, 0.75])) for i in range(n) if rnd.random() < 0.6]
        scores = [-0.4375] * n
        for i, v in found:
            scores[i] = v
        got = toxicity.segments(found, 0.4375)
        assert [x[:2] for x in got] == [x[:2] for x in plain(scores)]
        assert [x[2] for x in got] == pytest.approx([x[2] for x in plain(scores)])


def test_toxicity(spark):
    rnd = random.Random(8)
    docs, labels = [], []
    for i in range(900):
        toxic = rnd.random() < 0.2
        own = [f"w{rnd.randrange(300)}" for _ in range(rnd.randint(5, 120))]
        if toxic:
            for _ in range(rnd.randint(2, 6)):
                own.insert(rnd.randrange(len(own)), rnd.choice(["Vileword", "nastier", "badness", "grimmest"]))
        docs.append((i, " ".join(own), int(toxic)))
        labels.append((i, 1, int(toxic) if not held(i) else 1 - int(toxic)))
    docs += [(2000, None, 0), (2001, "", 0), (None, "vileword nastier", 1), (5, "w1 w2", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score int")
    marks = spark.createDataFrame(labels + [(3000, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(frame, toxicity.fit(frame, marks)).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    by = {r.doc_id: r for r in rows}
    wrong = [i for i, _, toxic in docs[:900] if i != 5 and held(i) and by[i].predicted != toxic]
    assert len(wrong) <= 3
    assert by[2000].score == by[2001].score and not by[2000].passages
    assert toxicity.score(frame.where("false"), toxicity.fit(frame.where("false"), marks)).count() == 0
    assert toxicity.score(frame, toxicity.fit(frame, marks.where("false"))).where("predicted = 1").count() == 0
