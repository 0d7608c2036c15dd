"""Secret scans, HTML text, WARC fixity, the quality classifier and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulwatch.llm import html_text, quality_model, secret_scans, warc
from haulwatch.llm.arrays import Texts, blocks
from haulwatch.llm.queries import QUERIES
from tests.llm.corpus import DOCS, ODD, clashing, empty, odd, prose  # noqa: F401

PATTERNS = [
    (re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 1, 12),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    (re.compile(r"[0-9a-f]+"), 0, 16),
]


def base_by_hand(text: str | None) -> str:
    found = [(m.start(), k, m.end()) for k, (p, g, least) in enumerate(PATTERNS) for m in p.finditer(text or "") if len(m[g]) >= least]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_base_spans_against_plain_python(spark, odd):
    rng = random.Random(2)
    parts = ["token", "Secret", "api_key", "apikey", "PASSWD", " ", "=", ":", '"', "'", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "é😀", "zz\n", "deadbeef", ".", "token: secret: "]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))), "en", f"s{k % 5}", 0) for k in range(600)]
    rows += ODD + [(900, "key 0123456789abcdef0 " * 2000, "a", "b", 1)]
    docs = clashing(spark.createDataFrame(rows, DOCS), "secrets", "kind", "hash", "owner", "key", "__key", "__live", "__base", "__bare", "__join", "__new", "__secrets", "found", "c0")
    got = secret_scans.scan_secrets(docs).select("text", secret_scans.listed(F.col("secrets.base")).alias("base")).collect()
    assert len(got) == len(rows) and all(r.base == base_by_hand(r.text) for r in got)


def test_ownership_tells_examples_from_live_values(spark, empty):
    key, example = "ghp_Ab3dEf6hIj9lMn2pQr5t", "ghp_Zz1yXx4wVv7uTt0sRr3q"
    rows = [(1, f"é use {key} here", "en", "ann", 15), (2, f"again {key}", "en", "ann", 9)]
    rows += [(10 + k, f"see {example} or token={example}", "en", f"owner{k}", 5) for k in range(5)]
    rows += [(20, "password = 'hunter2hunter2'", None, None, 5), (20, "password = 'hunter2hunter2'", None, None, 5)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in secret_scans.scan_secrets(docs).select("doc_id", secret_scans.listed(F.col("secrets.spans")).alias("spans"), F.expr("secrets.spans.live").alias("live")).collect()}
    assert got[1].spans == f"owned:6:{6 + len(key)}" and got[2].live == [True]
    assert got[12].spans == f"assign:32:{32 + 6 + len(example)}" and got[12].live == [False]
    clean = {r.doc_id: r for r in secret_scans.redact(docs).collect()}
    assert clean[1].text == "é use [SECRET] here" and clean[1].n_chars == 19
    assert clean[12].text == rows[4][1] and clean[20].text == "[SECRET]'"
    assert secret_scans.redact(docs).columns == docs.columns and secret_scans.redact(docs).count() == len(rows)
    assert secret_scans.redact(empty).count() == 0


def test_verdicts_by_shuffle(spark, monkeypatch, empty):
    rows = [(k, f"token = '{'abcdef12345' * 2}{k % 7}' é", "en", f"s{k % 9}", 5) for k in range(300)]
    rows += [(1000 + k, "password = 'hunter2hunter2'", "en", "one", 5) for k in range(300)] + ODD + [(2000, None, None, None, None)] * 50
    docs = spark.createDataFrame(rows, DOCS)
    listed = lambda: sorted(map(str, secret_scans.scan_secrets(docs).select("doc_id", "secrets").collect()))
    want = listed()
    monkeypatch.setattr(secret_scans, "BROADCAST_BYTES", -1)
    assert listed() == want and len(want) == len(rows)
    assert any("live=True" in w for w in want)
    assert secret_scans.redact(empty).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body class="has-sidebar"><div id=top class="site-header">Logo</div>
<ul><li><a href=1>Home</a><li><a href=2>News {0}</a><li><a>Shop</a></ul><div class=cookie-notice>We use cookies</div><h1>T{0} a</h1>
<div class="post-content"><p>Own te<b>xt</b>{0} x &amp;&nbsp; y.<p>More<br>lines &lt;{0}&gt;</div><p>Share this story</p><div class="post-comments"><p>nice {0}</p></div>
<form>Name <input></form><aside>side {0}</aside><script>var a = "<p>{0}</p>"</script><!-- <p>{0} --><div class=footer>foot</div>"""


def test_template_and_slots():
    pages = [PAGE.format(k) for k in range(8)]
    assert html_text.texts_of_group(pages)[:2] == [f"T{k} a Own text{k} x & y. More lines <{k}>" for k in (0, 1)]
    # too few pages for a template, copies of one page: nothing is lost
    assert "Own text0 x & y." in html_text.texts_of_group(pages[:1])[0]
    article = "<body><nav>n</nav><article><header><h1>H</h1></header><p>One.</p><footer>f</footer></article><article class=comment>c</article></body>"
    assert html_text.texts_of_group([article] * 9) == ["H One."] * 9
    near = [article.replace("One.", f"One. {'same words ' * 30}<p>{k}") for k in range(9)]
    assert all("same words" in t for t in html_text.texts_of_group(near))


def test_repeated_pages_get_one_text(spark):
    """A page repeated some hundred times loses its host's unnamed boilerplate like any other page, in all of its rows."""
    page = lambda k: f"<body><div>Home of all</div><div>More of it</div><p>{f'Own words {k}. ' * 9}</p><div>The end</div></body>"
    rows = [(k, f"http://h/{k}", page(k)) for k in range(40)] + [(k, f"http://h/{k}", page(7)) for k in range(100, 700)]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(got) == 640
    assert {r.text for r in got if r.page_id >= 100 or r.page_id == 7} == {("Own words 7. " * 9).strip()}


def test_broken_pages():
    odd = [None, "", "plain text", "<p>a<p>b", "<article>x", "<!-- unclosed", "<script>var a", "<div class='ad'>only ad</div>", "<a<b>c", "&#x110000;&bogus;<p", "<ul><li>" * 500 + "deep"]
    assert html_text.texts_of_group(odd)[:8] == ["", "", "plain text", "a b", "x", "", "", ""]
    assert html_text.texts_of_group(["<body>" + "<p>w</p>" * 50_000])[0] == " ".join(["w"] * 50_000)


def bare_page(k: int, layout: str = "a") -> str:
    """No article, no main, no telling names: what is the article shows in many pages only."""
    paragraphs = "".join(f"<p>Paragraph {k}.{n} tells of matter {k * 7 + n} at some length and then ends.</p>" for n in range(1 + k % 4))
    menu = "<div class=q1><a href=/x>Home</a> <a href=/y>News</a> Your daily read of all that is new in town.</div>"
    if layout == "a":
        return f"<body><div class=z9>{menu}</div><table><tr><td class=q2>Popular: read {k}</td><td class=q3><h1>Title {k}</h1><div class=q4>{paragraphs}</div></td></tr></table><div class=q5>All rights of the town paper, since 1901, reserved.</div>"
    return f"<body><div class=k1><h1>Title {k}</h1><span class=k2>by A</span>{paragraphs}</div>{menu}<div class=k3>Seen {k} times</div>"


def bare_text(k: int, layout: str = "a") -> str:
    paragraphs = [f"Paragraph {k}.{n} tells of matter {k * 7 + n} at some length and then ends." for n in range(1 + k % 4)]
    return " ".join([f"Title {k}", *(["by A"] if layout == "b" else []), *paragraphs])


def test_template_chooses_the_article(monkeypatch):
    pages = [bare_page(k) for k in range(12)]
    assert html_text.texts_of_group(pages) == [bare_text(k) for k in range(12)]
    mixed = [bare_page(k, layout) for k in range(10) for layout in "ab"]  # two layouts on one host
    assert html_text.texts_of_group(mixed) == [bare_text(k, layout) for k in range(10) for layout in "ab"]
    # a page by itself has no template, and without the slots the rest of the page is in its text
    assert "since 1901" in html_text.texts_of_group(pages[:1])[0]
    monkeypatch.setattr(html_text, "slots_of", lambda pages: [None] * len(pages))
    assert all("Popular" in t for t in html_text.texts_of_group(pages))


def test_template_without_any_names(spark, monkeypatch):
    """On the test table, the template alone finds what the names say."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url", "html").where("html is not null").collect()
    hosts = {}
    for url, source in sorted({(p.url or "", p.html) for p in pages}):
        hosts.setdefault("/".join(url.split("/")[:3]), []).append(source)
    groups = [g for g in hosts.values() if len(g) >= 2 * html_text.LEAST]
    named = [t for g in groups for t in html_text.texts_of_group(g)]
    monkeypatch.setattr(html_text, "left_out", lambda tag, attributes, article: html_text.KEPT)

    class Plain(html_text.Page):
        def open(self, tag, rest, n):
            super().open("div" if tag in ("article", "main") else tag, rest, n)

        def close(self, tag):
            super().close("div" if tag in ("article", "main") else tag)

    monkeypatch.setattr(html_text, "Page", Plain)
    plain = [t for g in groups for t in html_text.texts_of_group(g)]
    assert len(named) > 100 and sum(a != b for a, b in zip(named, plain, strict=True)) <= 0.01 * len(named)


def test_template_odd_pages():
    same = "<div class=a><p>One text of some length</p></div><div class=b>menu</div>"
    assert all("One text" in t for t in html_text.texts_of_group([same + "<!-- -->" * k for k in range(9)]))  # copies: nothing differs
    article = "<article><h1>T{0}</h1><p>Own {0} words</p><div class=x>More of {0}</div></article><div class=y>Long boilerplate " + "that repeats " * 20 + "</div>"
    assert html_text.texts_of_group([article.format(k) for k in range(8)]) == [f"T{k} Own {k} words More of {k}" for k in range(8)]
    deep = ["<div>" * 16_000 + f"<p>deep {k}</p>" for k in range(6)]
    assert html_text.texts_of_group(deep) == [f"deep {k}" for k in range(6)]
    assert html_text.texts_of_group(["", None, "<p></p>", "<div>", "<div></div>", "x", "<h1>", "<article></article>"]) == ["", "", "", "", "", "x", "", ""]


def test_extract_text_rows(spark, monkeypatch):
    rows = [(k, f"http://h{k % 3 if k < 150 else 0}.example/{k}", PAGE.format(k)) for k in range(400)] + [(1000, None, None), (1001, "nonsense", ""), (None, "http://h1.example/1", PAGE.format(1))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    want = {k: f"T{k} a Own text{k} x & y. More lines <{k}>" for k in range(400)} | {1000: "", 1001: "", None: "T1 a Own text1 x & y. More lines <1>"}
    got = html_text.extract_text(clashing(pages, "text", "host", "count", "bucket"))
    assert got.columns == ["page_id", "url", "host", "count", "bucket", "text"]
    assert {r.page_id: r.text for r in got.collect()} == want
    monkeypatch.setattr(html_text, "BUCKET", 40)  # the first host is dealt into buckets
    assert {r.page_id: r.text for r in html_text.extract_text(pages).collect()} == want
    assert html_text.extract_text(pages.limit(0)).count() == 0


def tree_by_hand(leaves: list[str], fanout: int) -> str:
    while len(leaves) > 1:
        leaves = [hashlib.sha256("".join(leaves[k : k + fanout]).encode()).hexdigest() for k in range(0, len(leaves), fanout)]
    return leaves[0]


def test_records_and_trees(spark):
    rows = [(k, f"http://a/{k}", f"<p>é {k}</p>") for k in range(70)] + [(None, None, None), (5, "http://a/5", "<p>é 5</p>")]
    pages = clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string"), "archive", "start", "end", "leaf")
    records = warc.to_records(pages, records=30)
    indexed = warc.index(records).collect()
    assert len(indexed) == len(rows)
    stored = {(r.archive, r.key, r.url): bytes(r.record) for r in records.collect()}
    body = stored[next(k for k in stored if k[1] == 7)]
    assert body.startswith(b"WARC/1.0\r\nWARC-Type: response\r\n") and body.endswith("\r\n\r\n<p>é 7</p>\r\n\r\n".encode()) and b"Content-Length: 11\r\n" in body
    frame = warc.index(records)
    levels = warc.merkle_levels(warc.leaves(frame), warc.height(frame, 4), 4)
    roots = {r.archive: r.hash for r in levels[-1].collect()}
    for archive, root in roots.items():
        own = sorted((r for r in indexed if r.archive == archive), key=lambda r: r.position)
        assert [r.position for r in own] == [*range(len(own))] and own[0].start == 0
        assert all(a.end == b.start for a, b in zip(own, own[1:], strict=False))
        assert all(r.end - r.start == len(stored[archive, r.key, r.url]) and r.leaf == hashlib.sha256(stored[archive, r.key, r.url]).hexdigest() for r in own)
        leaves = [hashlib.sha256(f"{r.start}:{r.end}:{r.leaf}".encode()).hexdigest() for r in own]
        for _ in range(len(levels) - 1):
            leaves = [hashlib.sha256("".join(leaves[k : k + 4]).encode()).hexdigest() for k in range(0, len(leaves), 4)]
        assert leaves == [root]


def test_audit_finds_what_differs(spark):
    def tree(leaves, archives=(0, 1)):
        rows = [(a, p, 10 * p, 10 * p + 10, h) for a in archives for p, h in enumerate(leaves[a]) if h]
        frame = spark.createDataFrame(rows, "archive bigint, position bigint, start bigint, end bigint, leaf string")
        return warc.merkle_levels(warc.leaves(frame), 4, 3)

    good = [[f"r{k}" for k in range(60)], [f"q{k}" for k in range(20)]]
    bad = [good[0][:], good[1][:]]
    bad[0][13], bad[0][59] = "x", None
    bad[1].append("more")
    found = sorted((r.archive, r.position, r.start, r.end, r.status) for r in warc.audit(tree(good), tree(bad), 3).collect())
    assert found == [(0, 13, 130, 140, "corrupt"), (0, 59, 590, 600, "missing"), (1, 20, 200, 210, "added")]
    assert warc.audit(tree(good), tree(good), 3).count() == 0
    assert {r.status for r in warc.audit(tree(good), tree(good, (0,)), 3).collect()} == {"missing"}
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    frame = warc.index(warc.to_records(none))
    assert warc.audit(*[warc.merkle_levels(warc.leaves(frame), warc.height(frame))] * 2).count() == 0


def test_context_vectors_add_up(spark):
    texts = [prose(k, 40) + " *** a a" for k in range(30)] + ["", None, "one"]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS).repartition(5)
    places, signs = quality_model.index_vectors()
    want = np.zeros((quality_model.BUCKETS, quality_model.DIM))
    for text in texts:
        block = next(blocks(pa.array([text], pa.string())))
        bucket, _ = quality_model.word_buckets(block)
        for i, b in enumerate(bucket):
            for j in range(max(0, i - 2), min(len(bucket), i + 3)):
                if i != j:
                    np.add.at(want[b], places[bucket[j]], signs[bucket[j]])
    assert np.array_equal(quality_model.word_vectors(docs), want)


def test_pooling_by_hand():
    table = np.random.default_rng(1).normal(size=(quality_model.BUCKETS, 2 * quality_model.DIM)).astype(np.float32)
    block = Texts(np.frombuffer(b"aa bb aa!", np.uint8), np.array([0, 9, 9]))
    bucket, _ = quality_model.word_buckets(block)
    got = quality_model.pooled(block, table)
    assert np.allclose(got[0, : 4 * quality_model.DIM], np.hstack([table[bucket].mean(axis=0), table[bucket].std(axis=0)]), atol=1e-5)
    assert not got[1].any()


def test_classifier_learns_and_is_calibrated(spark, empty):
    junk = lambda k: " ".join(f"{w}{random.Random(k).choice(['***', '###'])}" for w in prose(k, 60).split())
    rows = [(k, junk(k) if k % 3 == 0 else prose(k, 60), None, "s", 1) for k in range(500)] + ODD
    docs = clashing(spark.createDataFrame(rows, DOCS), "score", "x", "label")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), None) for k in range(500)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    held = {k for k in range(500) if zlib.crc32(str(k).encode()) % 5 == 0}
    got = quality_model.classify(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got if r.doc_id is not None and r.doc_id > 10}
    right = [(score[k] >= 0.3) == (k % 3 > 0) for k in held if k > 10]
    assert sum(right) >= 0.97 * len(right)
    none = quality_model.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_model.classify(empty, labels).count() == 0


def test_held_out_accuracy_on_the_test_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op5_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right, n = rows.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right >= 0.9 * n


def test_pipeline_on_small_tables(spark, tmp_path, empty):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, before, sf)
        assert docs.columns == before.columns + ["pieces"] * (k == 4)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
        assert stage(spark, clashing(spark.createDataFrame(ODD, DOCS), "n", "kept", "node", "rules", "found", "secrets"), sf).count() <= len(ODD)


@pytest.mark.parametrize("name", ["op2_decontamination", "op4_secret_scans", "op6_near_duplicates", "op10_warc_fixity"])
def test_query_against_sql(spark, name):
    from fixtures.compare import compare, duck
    from haulwatch.llm.oracles import ORACLES

    sf = "/root/testdata/sf0.001"
    got, want, diff = compare(spark, duck(sf), sf, QUERIES[name], ORACLES[name])
    assert got == want and not diff


def test_redaction_with_clashing_names(spark):
    value = "password = Zx81kQp0vLm3Tr"
    rows = spark.createDataFrame([(1, f"a {value} b", "en", "s", 30), (2, None, None, None, None)], DOCS)
    odd_names = clashing(rows, "key", "__live", "__key", "__new", "__secrets", "__base", "found", "c1")
    plain = {r.doc_id: (r.text, r.n_chars) for r in secret_scans.redact(rows).collect()}
    got = secret_scans.redact(odd_names)
    assert got.columns == odd_names.columns and {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == plain
    assert value not in plain[1][0] and {r.key for r in got.collect()} == {7}


def test_page_text_with_names_of_the_operator(spark):
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<article><p>Text {k}</p></article>") for k in range(7)], "page_id bigint, url string, html string")
    names = ["__host", "__page", "__text", "__html", "__bucket", "__buckets", "found", "c0"]
    got = html_text.extract_text(clashing(pages, *names))
    assert got.columns == ["page_id", "url", *names, "text"]
    assert {(r.page_id, r.text, r["__text"]) for r in got.collect()} == {(k, f"Text {k}", 7) for k in range(7)}
