"""Chat, vectors, urls, pages and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rungwise.llm import chat, embed_dedup, html_extract, simhash, topk, url_filter
from tests.llm import odd
from tests.llm.test_texts import check_packed, library, WORDS, brute_fingerprint, brute_repeats
from tests.oracle import compare


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_escapes_are_reversible_and_hide_controls():
    machine, rng = chat.Formatter(chat.Template()), random.Random(5)
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "e>", "ROLE]", "/ROLE]", "a", " ", "[INST]", "</s>", "/TURN]", "x"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        escaped = machine.escaped(text)
        assert machine.unescaped(escaped) == text and not machine.marks.search(escaped)
        role = rng.choice(["user", "assistant", "system", "tool", "", text])
        assert machine.parse("<s>" + "".join(t for t, _ in machine.turn(role, text)) + "<e>") == [(role, text)]


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template(begin="[INST]")
    with pytest.raises(ValueError):
        chat.Template(end="[I")
    with pytest.raises(ValueError):
        chat.Template(end="a[b")


def test_chat_digests(spark, tmp_path):
    rows = [
        (1, 1, "assistant", "b\n"), (1, 0, "user", "a"), (2, 0, "assistant", None), (2, 0, "assistant", None), (3, 5, None, "x</s>"),
        (3, None, "user", ""), (None, 0, "user", "q"), (4, 0, "system", "\\[INST] ö"), (4, 1, "user", "u"), (4, 2, "assistant", "v"),
        (4, 2, "assistant", "a tie"), (5, 0, "tool", odd.LONG),
    ]
    df = spark.createDataFrame([(*r, 9, True) for r in rows], "conv_id long, turn long, role string, text string, n_turns long, loss boolean")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    own = "</s>[INST] ok [/INST]"
    groups = defaultdict(list)
    for conv, turn, role, text in [*rows, (-1, 0, "user", own), (-1, 1, "assistant", own)]:
        groups[conv].append((-1 if turn is None else turn, role or "", text or ""))
    want = {}
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        want[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    got = {r["conv_id"]: r for r in chat.op1_chat(spark, str(tmp_path)).collect()}
    assert {c: tuple(r)[1:5] for c, r in got.items()} == want
    assert [got[c]["n_faults"] for c in (1, 2, 4, 5)] == [0, 2, 1, 1] and got[1]["ends_well"] and not got[5]["ends_well"]


def test_chat_of_no_rows(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r["conv_id"] for r in chat.op1_chat(spark, str(tmp_path)).collect()] == [-1]


def vectors():
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(0, 240)]
    for i in range(60):  # near and exact copies at all distances around the threshold
        base, noise = np.array(rows[i % 20][1]), rng.standard_normal(16)
        rows.append((300 + i, (base + noise * rng.uniform(0, 0.6)).tolist()))
    rows += [(400 + i, rows[5][1]) for i in range(40)] + [(450, (np.array(rows[5][1]) * 3).tolist())]
    rows += [(500, None), (550, [0.0] * 16), (501, [None] + [1.0] * 15), (502, [float("nan")] * 16), (503, [float("inf")] * 16)]
    rows += [(504, rows[5][1][:8]), (505, []), (600, rows[7][1]), (601, [1e-30] * 16), (602, [2e-30] * 16), (650, [1e30] * 16)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def vector_folder(spark, folder, rows):
    df = spark.createDataFrame([(i, v, 0, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, label int, cid long, n double")
    df.repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def fine(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute_links(rows, least=0.9):
    good = [(k, np.array(v, dtype=float)) for k, (_, v) in enumerate(rows) if fine(v) and any(v)]
    links = []
    for a, (k, x) in enumerate(good):
        for m, y in good[a + 1 :]:
            if len(x) == len(y) and (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= least:
                links.append((k, m))
    return links


def test_near_vectors_equal_brute_force(spark, tmp_path, monkeypatch):
    rows = vectors()
    monkeypatch.setattr(embed_dedup, "MISS", 1e-6)
    monkeypatch.setattr(embed_dedup.table_plan, "__defaults__", (0.9, 256, 1e-6))
    links = brute_links(rows)
    number = Counter(k for pair in links for k in pair)
    group = odd.components(range(len(rows)), links)
    first = {g: min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in set(group.values())}
    want = Counter((rows[k][0], number[k], first[group[k]], rows[k][0] == first[group[k]]) for k in range(len(rows)))
    got = embed_dedup.op2_embed_dedup(spark, vector_folder(spark, tmp_path, rows)).collect()
    assert Counter(map(tuple, got)) == want


def test_vectors_of_hot_buckets(spark, monkeypatch):
    from rungwise.llm import blocks

    monkeypatch.setattr(blocks.chunk_pairs, "__defaults__", (16,))
    rng = np.random.default_rng(10)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.05 * rng.standard_normal(16)).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r)[1:3] for r in embed_dedup.near_vectors(df).collect()} == {(149, 0)}


@pytest.mark.parametrize("dim", [300, 768])
def test_long_vectors_equal_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(embed_dedup.table_plan, "__defaults__", (0.9, 256, 1e-6))
    rng = np.random.default_rng(dim)
    rows = [(i, rng.standard_normal(dim).tolist()) for i in range(40)]
    rows += [(100 + i, (np.array(rows[i % 10][1]) + rng.standard_normal(dim) * rng.uniform(0, 0.6)).tolist()) for i in range(60)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    links = brute_links(rows)
    number = Counter(k for pair in links for k in pair)
    got = embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert links and {r["vec_id"]: r["n_links"] for r in got} == {rows[k][0]: number[k] for k in range(len(rows))}


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(11)
    unit = rng.standard_normal((400, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    turned = unit @ embed_dedup.frame(32, 256).T
    factor = np.abs(turned).sum(axis=1) / 16
    error = np.sign(turned) / 16 @ turned.T / factor[:, None] - unit @ unit.T
    off = ~np.eye(400, dtype=bool)
    bound = embed_dedup.SURE * np.sqrt(1 - factor**2) / factor / np.sqrt(255)
    assert abs(error[off].mean()) < 0.002 and (np.abs(error) <= bound[:, None])[off].all()


def test_tables_miss_little():
    for n in (10, 1000, 10**6, 10**9):
        bits, tables = embed_dedup.table_plan(n)
        assert (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables <= embed_dedup.MISS


@pytest.mark.parametrize("block", [1 << 16, 64])
def test_top_products_equal_brute_force(spark, tmp_path, block):
    rows = vectors()
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if fine(v) and all(abs(x * 256) < 2**31 for x in v)}
    want = []
    for q in sorted(i for i in whole if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    table = topk.quantised(spark.read.parquet(f"{vector_folder(spark, tmp_path, rows)}/embeddings.parquet"))
    got = topk.top_products(table, table.filter("vec_id % 50 = 0"), 5, block, chunk=4)
    assert sorted(map(tuple, got.collect())) == want


def test_wide_components_take_part(spark, tmp_path):
    rng = np.random.default_rng(13)
    rows = [(i, (rng.standard_normal(16) * 10.0 ** rng.integers(0, 6)).tolist()) for i in range(51, 120)]
    rows += [(150, [1e7] + [0.0] * 15), (151, [-9e6, 1e-30, -1e-30] + [0.0] * 13), (50, [0.0] * 16), (152, [1e7])]
    folder = vector_folder(spark, tmp_path / "long", rows)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    assert compare(topk.op4_topk(spark, folder), connection, topk.OP4_SQL) == []

    rows += [(200 + i, (rng.standard_normal(16) * 10.0 ** rng.integers(5, 38)).tolist()) for i in range(0, 101, 5)]
    rows += [(400 + i, [3e38 if i % 2 else -3e38] + [float(i)] * 15) for i in range(60)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    want = []
    for q in sorted(i for i in whole if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        want += [(q, k + 1, i, min(max(-s, -(2**63)), 2**63 - 1)) for k, (s, i) in enumerate(scores[:5])]
    folder = vector_folder(spark, tmp_path / "wide", rows)
    assert sorted(map(tuple, topk.op4_topk(spark, folder).collect())) == want
    table = topk.gridded(spark.read.parquet(f"{folder}/embeddings.parquet"))
    assert sorted(map(tuple, topk.top_products(table, table.filter("vec_id % 50 = 0"), 5, 32, chunk=4).collect())) == want


def test_vectors_of_no_rows(spark, tmp_path):
    folder = vector_folder(spark, tmp_path, [])
    assert topk.op4_topk(spark, folder).count() == 0 and embed_dedup.op2_embed_dedup(spark, folder).count() == 0
    assert topk.top_products(*[spark.createDataFrame([(50, [1, -2])], "vec_id long, q array<long>")] * 2, 5).count() == 0


URLS = [None, "", "no scheme", "http://", "http://H.Example.COM", "x://a.com/en/1?q#f", "http://www.example.com/en/3",
        "https://EXAMPLE.com/en/", "https://example.com/enx", "http://b.net/es/9", "http://net/fr/", "http://c.org//", "http://c.org/a://b/c/d/e/f",
        "http://É.com/ä", "x://y.net?/es/", "x://y.net#a"]


def test_urls_equal_sql(spark, tmp_path):
    rows = [(i, url) for i, url in enumerate(URLS)]
    rows += [(1000 + i, f"http://h{i % 3}.{'net' if i % 2 else 'org'}/{('es', 'fr', 'en', 'de')[i % 4]}/{i}/x") for i in range(300)]
    rows += [rows[5], (None, "http://h1.net/en/1")]
    spark.createDataFrame([(*r, "h", "t") for r in rows], "page_id long, url string, host string, template string").write.parquet(f"{tmp_path}/pages.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    found = url_filter.op3_url_filter(spark, str(tmp_path))
    assert compare(found, connection, url_filter.OP3_SQL) == []
    told = {r["page_id"]: r for r in found.collect()}
    assert [told[i]["rule"] for i in (5, 6, 7, 8, 9, 10)] == ["com/", "www.example.com/en/", "example.com/en/", "com/", "net/es/", "net/fr/"]
    assert [(told[i]["host"], told[i]["path"]) for i in (0, 2, 4, 12, 13, 14)] == [
        ("", ""), ("", ""), ("h.example.com", ""), ("c.org", "/a://b/c/d/e/f"), ("É.com", "/ä"), ("y.net", "")]
    assert len(told) == len({r[0] for r in rows}) and found.count() == len(rows)


def test_urls_of_no_rows(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    assert url_filter.op3_url_filter(spark, str(tmp_path)).count() == 0


def test_templates_with_bad_labels_are_rejected(spark):
    bad = [(i, f"http://a.net/ads/{i}", None) for i in range(40)]
    rows = spark.createDataFrame(
        [(i, "a.net", f"/{'ads' if i % 2 else 'news'}/{i}", i < 60 if i % 2 else (False if i < 60 else None)) for i in range(100)],
        "page_id long, host string, path string, bad boolean",
    ).withColumn("bad", F.when(F.col("page_id") < 60, F.col("bad")))
    told = {r["template"]: r["purity"] for r in url_filter.judged(url_filter.templated(rows)).collect()}
    assert told["/ads/*"] >= url_filter.REJECT and told["/news/*"] < 0.1 and len(bad) == 40


PAGES = [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>", ""), ("<script>x</p>", ""),
    ("<title>t</title><article><h1>Head</h1><p>One, two.<p>A&amp;B &lt;c&gt; d</article><footer>f</footer>", "Head One, two. A&B <c> d"),
    ("<nav><a>m</a></nav><div class=post><p>The first paragraph, long enough to score.<br>more<p>Second <b>bo</b>ld, also quite long enough.</div>"
     "<div id=side-bar><p>Sidebar text, which is long enough, too, to score.</div>",
     "The first paragraph, long enough to score. more Second bold, also quite long enough."),
    ("<article><p>Text that is the body of it all, yes.</p><div class='comments'><p>A reader says this, at length, indeed.</p></div>"
     "<form><p>Join us, please, now.</p></form><aside>x</aside></article>", "Text that is the body of it all, yes."),
    ("<div>" * 3000 + "deep down there is text, long enough" + "</div>" * 3000, "deep down there is text, long enough"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table> x < y &am</article", "one two a b x < y &am"),
    ("<article>" + "<p>word, word</p>" * 20000 + "</article>", " ".join(["word, word"] * 20000)),
]


def test_main_text(spark, tmp_path):
    rows = [(i, f"u{i}", page) for i, (page, _) in enumerate(PAGES)]
    rows += [rows[5], (None, None, PAGES[5][0])]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    want = Counter((i, u, PAGES[5 if i is None else i][1]) for i, u, _ in rows)
    got = html_extract.op8_html_extract(spark, str(tmp_path)).collect()
    assert Counter((r["page_id"], r["url"], r["text"]) for r in got) == want and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract(df.limit(0)).count() == 0


def test_main_text_of_pages_without_end_tags():
    article = "<article><p>Text</p></article>"
    for page in (
        "<html><head><meta charset=utf-8><body>" + article, "<head><title>t</title><link rel=x>" + article,
        "<head><script>'<body>no'</script><style>p{}</style><title>t</title></head><body>" + article,
        "<head><!-- <body> --><meta a='>'>" + article, "<head><title>t</title>" + article, "<head><title>t</title>Text",
        "<article><svg viewBox='0 0 1 1'/><p>Text</p></article>", "<article><p>Text<math/></p></article>",
        "<article><svg a='x>y' /><p>Text</p></article><svg><text>no</text></svg>", "<article><svg><path d=''/></svg><p>Text</p></article>",
    ):
        assert html_extract.main_text(page) == "Text", page


def test_names_and_embedded_elements_of_articles():
    for inside in (
        '<p class="share-price">Text</p>', '<blockquote class="reply-quote">Text</blockquote>', '<div id="social-history"><p>Text</p></div>',
        '<section class="related-work"><p>Text</p></section>', "<p>Text</p><canvas>", "<select><p>Text</p>", "<p>Te<noscript>xt</p>",
        "<p>Text</p><object><object>no</object>no</object>", "<p>Text</p><select><option>no<option>no</select>",
        "<noscript><p>no</p></noscript><p>Text</p>", '<p>Text</p><div class="related-posts"><p>no</p></div>',
        '<p>Text</p><div id="commentList2"><p>no</p></div>', '<div class="side-bar">no</div><p>Text</p>', '<p>Text</p><ul class="nav nav-left"><li>no</li></ul>',
        "<svg><title>no</title><text>no</text></svg><p>Text</p>", "<p>Text</p><template><p>no</p></template>",
    ):
        assert html_extract.main_text(f"<body><article>{inside}</article><footer>no</footer></body>") == "Text", inside


def test_pipeline_stages_equal_brute_force(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        rows = docs.collect()
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            out.write.parquet(f"{tmp_path}/{name}")
            out = spark.read.parquet(f"{tmp_path}/{name}")
            assert out.columns == corpus_pipeline.COLUMNS
        got = out.collect()
        if name == "language":
            assert len(got) == len(rows)  # every document has letters of a language: clean ones stay
        elif name == "near_duplicates":
            prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
            ids = sorted(prints)
            near = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= simhash.RADIUS]
            group = odd.components(ids, near)
            assert {r["doc_id"] for r in got} == set(group.values())
        elif name == "repeated_passages":
            want = {d: (n, s) for d, _, n, _, s in brute_repeats([(r["doc_id"], r["text"], None) for r in rows])}
            whole = {r["doc_id"]: len((r["text"] or "").encode()) for r in rows}
            for r in got:
                left = len(r["text"].encode())
                assert whole[r["doc_id"]] - want[r["doc_id"]][0] - 6 * 3 <= left <= whole[r["doc_id"]] - want[r["doc_id"]][0]
            assert len(got) == len(rows)
        else:
            check_packed(got, 4096, library(WORDS), [(r["doc_id"], r["text"]) for r in rows])
        docs = out


def test_pipeline_takes_awkward_documents(spark, tmp_path):
    folder = odd.documents(spark, tmp_path, odd.texts())
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_pipeline_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_each_stage_bounds_arrow_batches_itself(spark, tmp_path):
    folder = odd.documents(spark, tmp_path, odd.texts())
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}
    before = {key: spark.conf.get(key) for key in limits}
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
            spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
            stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
            assert {key: int(spark.conf.get(key)) for key in limits} == limits
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
