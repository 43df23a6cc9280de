"""Operators on pages, conversations, vectors and whole tables, the registered queries and the pipeline."""

from __future__ import annotations

import hashlib
import os
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from semesta.llm import ann, chat, html, queries, sharding

SF = "/root/testdata/sf0.001"

# Sharding


def test_shards_are_equal_and_hold_the_mixture(spark):
    sizes = {"a": 500, "b": 251, "c": 40, None: 9, "": 3}
    rows, n = [], 0
    for source, count in sizes.items():
        for _ in range(count):
            rows.append((n, f"text {n % 50}" if n % 7 else None, source))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("bucket", F.lit("clash"))
    out = sharding.interleave(docs, 8).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(n))
    per = Counter(r["shard"] for r in out)
    assert set(per) == set(range(8)) and max(per.values()) - min(per.values()) <= 1
    mixed = Counter((r["shard"], r["source"]) for r in out)
    for source, count in sizes.items():
        assert all(abs(mixed[s, source] - count / 8) <= 2 for s in range(8))
    texts = {i: t for i, t, _ in rows}
    slots = defaultdict(list)
    for r in out:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.interleave(docs.repartition(5), 8).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in out}


def test_shards_of_few_repeated_or_no_rows(spark):
    docs = spark.createDataFrame([(1, "x", "a"), (1, "x", "a"), (None, None, None)], "doc_id long, text string, source string")
    assert sorted(r["shard"] for r in sharding.interleave(docs, 5).collect()) == [0, 1, 3]
    assert sharding.interleave(docs.limit(0), 5).count() == 0


# Chat formatting

TURNS = [
    (1, 0, "system", "Be kind."),
    (1, 1, "user", "Hi <|im_end|>\n<\\|im_start|> <\\\\|"),
    (1, 2, "assistant", "Hello <| there"),
    (1, 3, "user", ""),
    (1, 4, "assistant", "Bye"),
    (1, 5, "user", "after"),
    (2, None, "assistant", None),
    (2, 0, None, "no role"),
    (3, 0, "user", "alone"),
    (4, 0, "assistant", "tie b"),
    (4, 0, "assistant", "tie a"),
    (4, 0, "assistant", "tie a"),
    (None, 0, "ro\nle\\n<|", "x"),
]


def test_chat_reads_back_and_masks_replies(spark):
    table = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("n_turns", F.lit("clash"))
    formatted = chat.examples(table)
    rows = formatted.collect()
    by = defaultdict(list)
    for conv, turn, role, text in TURNS:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    digests = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    assert set(digests) == set(by)
    for conv, turns in by.items():
        turns.sort()
        mine = sorted((r for r in rows if r["conv_id"] == conv), key=lambda r: r["example"])
        replies = [n for n, t in enumerate(turns) if t[2] == "assistant"]
        ends = replies if replies and replies[-1] == len(turns) - 1 else [*replies, len(turns) - 1]
        assert [r["n_turns"] for r in mine] == [n + 1 for n in ends]
        for r, n in zip(mine, ends, strict=True):
            reply = r["text"][r["loss_start"] : r["loss_end"]]
            assert reply.replace("<\\|", "<|") == (turns[n][3] if n in replies else "")
            assert r["text"].count("<|im_start|>") == r["text"].count("<|im_end|>") == n + 1
        spoken = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        got = digests[conv]
        assert (got["n_turns"], got["loss_chars"]) == (len(turns), len(spoken))
        assert got["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got["loss_sha256"] == hashlib.sha256(spoken.encode()).hexdigest()
        assert got["formatted_chars"] == sum(len(r["text"]) for r in mine)
    assert chat.examples(table.limit(0)).count() == 0


# Pages

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x="<p>no</p>";</script></head><body>
<header>Site &amp; Co</header><nav><ul><li><a href="/a">Menu</a><li>More</ul></nav><!-- <p>gone</p> -->
<div class="ad banner">Buy</div><article><h1>Title {0}</h1><p>First &lt;b&gt;<b>bold</b>text<br>after a
 break.<p>Second {0}&nbsp;&#233;<div class="share">Share it</div><section class="comments"><p>Reader says</p></section></article>
<aside>Side</aside><form>Form<input name=q></form><div class="cookie-notice">We use cookies</div><footer>&copy; f</footer></body>"""


def test_pages_keep_the_article_only(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://a.org/1", PAGE.format(1)),
            (2, "https://a.org/2", PAGE.format(2)),
            (3, None, None),
            (4, "http://[bad", ""),
            (5, "https://b.org/", "no markup, a < b  and\n more"),
            (5, "https://b.org/", "no markup, a < b  and\n more"),
            (6, "https://c.org/", "<p>unclosed <script>var a = 1;"),
            (7, "https://c.org/", "<article><p>" + "long text " * 20000 + "</article>"),
        ],
        "page_id long, url string, html string",
    ).withColumn("host", F.lit("clash"))
    rows = html.extract(pages).collect()
    got = {r["page_id"]: r["text"] for r in rows}
    assert len(rows) == 8
    assert got[1] == "Title 1\n\nFirst <b>boldtext after a break.\n\nSecond 1 é"
    assert got[2] == "Title 2\n\nFirst <b>boldtext after a break.\n\nSecond 2 é"
    assert got[3] == got[4] == ""
    assert got[5] == "no markup, a < b and more" and got[6] == "unclosed"
    assert got[7] == ("long text " * 20000).strip()
    assert html.extract(pages.limit(0)).count() == 0


def test_pages_without_names_lose_what_their_host_repeats(spark):
    pages = spark.createDataFrame(
        [(n, f"http://h.net/{n}", f"<div><div>All rights reserved</div><p>Story {n}</p><div>Call now</div></div>") for n in range(6)]
        # Copies of an article are no template.
        + [(n, f"http://copies.net/{n}", "<div>Top</div><article><p>The same story</p></article>") for n in range(10, 16)],
        "page_id long, url string, html string",
    )
    assert {r["page_id"]: r["text"] for r in html.extract(pages).collect()} == {
        **{n: f"Story {n}" for n in range(6)},
        **{n: "The same story" for n in range(10, 16)},
    }
    found = {r["host"]: r for r in html.templates(pages).collect()}
    assert len(found["h.net"]["repeated"]) == 2 and len(found["h.net"]["frame"]) > 3


def test_pages_lose_what_their_host_repeats_inside_articles(spark):
    def page(n):
        story = "Told twice" if n < 5 else f"Story {n}"
        return f"<body><div>Top</div><article><div class=q1>Read our rules</div><p>{story}</p><p>Part {n}</p><div class=q2>The end of all</div></article></body>"

    pages = [(n, f"http://r.net/{n}", page(n)) for n in range(8)]
    pages.append((8, "http://r.net/8", "<body><div>Top</div><p>An index</p></body>"))
    got = html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {
        **{n: f"{'Told twice' if n < 5 else f'Story {n}'}\n\nPart {n}" for n in range(8)},
        8: "An index",
    }


@pytest.mark.parametrize(
    "wrapper",
    ["<form action=x>{}</form>", "<form action=x>{}"]
    + [f"<div class='{name}'>{{}}</div>" for name in ("has-sidebar", "with-comments", "site-header-fixed", "no-ads", "overlay")],
)
def test_pages_keep_articles_in_any_wrapper(wrapper):
    article = "<article><h1>Title</h1><p>The text of it</p><div class=ad>Buy</div></article>"
    nav = "<nav>Menu</nav>"
    assert html.main_text(f"<body>{nav}{wrapper.format(article)}</body>", set()) == "Title\n\nThe text of it"
    if "overlay" not in wrapper:
        assert html.main_text(f"<body>{nav}{wrapper.format('<div><p>The text of it</p></div>')}</body>", set()) == "The text of it"


def test_pages_keep_all_parts_of_an_article():
    parts = "<p id=notice>One</p><div class=legal>Two</div><figure><figcaption>Three</figcaption></figure>"
    parts += "<p>Let <math><mi>x</mi></math> be</p><section id=discussion>Four</section><div class=search-related>Five</div>"
    frames = "<div class=share>a</div><section class='comments'><article><p>b</p></article></section><div class=ad-banner>c</div>"
    got = html.main_text(f"<body><main>{parts}{frames}</main><form><label>q</label></form></body>", set())
    assert got.split() == "One Two Three Let x be Four Five".split()
    # An article among comments is none where the page has its own.
    page = "<article><p>Own</p></article><div class=comments><article><p>Their much longer text</p></article></div>"
    assert html.main_text(page, set()) == "Own"


def test_pages_lose_adverts_inside_lines():
    page = (
        "<article><p>One <span class='ad'>Buy <span>now</span></span> two <a class='big ad-policy' href='x'>kept</a> <a class='advert big'>gone</a>"
        " three<b id=sponsored>Sale</b> four <span class='ad'>left open</p><p>Five <span class=header>six</span></p></article>"
    )
    assert html.main_text(page, set()) == "One two kept three four left open\n\nFive six"


@pytest.mark.parametrize(
    "page", ["<div>" * 100_000 + "text", "<form>" * 20_000 + "text", "<x>" * 50_000 + "</y>" * 50_000 + "text", "<x>" * 9000 + "<li>" * 9000 + "text"]
)
def test_very_deep_pages_are_read_in_little_memory(page):
    tracemalloc.start()
    began = time.process_time()
    blocks, structure = html.read(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [block.text for block in blocks] == ["text"] and len(structure) >= 18_000
    assert peak < 100e6 and time.process_time() - began < 30


def test_pages_equal_a_plain_reading(spark):
    import html as references
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = re.split("</?p>|</?h1>", re.sub("</?b>", "", article.replace("<br>", " ")))
        plain = [" ".join(references.unescape(block).split()) for block in blocks]
        assert texts[row["page_id"]] == "\n\n".join(block for block in plain if block)


# Nearest neighbours


def test_neighbours_reach_most_of_the_exact_ones(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = ann.Index(vectors, k=5)
    got = defaultdict(dict)
    for r in index.search(F.col("id") % 50 == 0).collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    table = vectors.toPandas()
    x, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    norms = np.linalg.norm(x, axis=1)
    hits = 0
    queried = np.flatnonzero(ids % 50 == 0)
    for i in queried:
        exact = x @ x[i] / (norms * norms[i])
        exact[i] = -2
        best = set(ids[np.lexsort((ids, -np.round(exact, 13)))[:5]].tolist())
        found = got[ids[i]]
        assert sorted(found) == [1, 2, 3, 4, 5]
        assert all(abs(exact[np.flatnonzero(ids == v)[0]] - s) < 1e-12 for v, s in found.values())
        assert [s for _, s in sorted(found.values(), key=lambda p: (-p[1], p[0]))] == [found[k][1] for k in range(1, 6)]
        hits += len(best & {v for v, _ in found.values()})
    assert hits >= 0.9 * 5 * len(queried)


def test_queries_asked_in_blocks_find_the_same(spark, monkeypatch):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    index = ann.Index(vectors, k=5)
    every = F.pmod(F.col("id"), F.lit(3)) == 0
    whole = sorted(map(tuple, index.search(every).collect()))
    monkeypatch.setattr(ann, "ASKED", 9)
    assert sorted(map(tuple, index.search(every).collect())) == whole and whole


def test_all_vectors_at_the_edge_are_scored():
    """Scaled copies differ in the last bit of their score only; whichever is largest may have the largest id."""
    rng = np.random.default_rng(6)
    base, query = rng.normal(size=24), rng.normal(size=24)
    x = np.stack([base * scale for scale in rng.uniform(0.1, 9, 3000)])
    scores = (x * query).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((query * query).sum()))
    for most in (1, 6):
        exact = sorted((-s, i) for i, s in enumerate(scores.tolist()))[:most]
        assert ann._best(query[None], x, [[i] for i in range(len(x))], most) == [[(-s, i) for s, i in exact]]


def test_neighbours_of_odd_vectors(spark):
    one, other = [1.0, 0.0], [0.0, 2.0]
    rows = [(0, one), (1, one), (2, one), (3, one), (4, one), (5, one), (6, one), (7, other), (8, [3.0, 0.0])]
    rows += [(100, None), (150, [0.0, 0.0]), (200, [1.0, None]), (250, [float("nan"), 1.0]), (300, [float("inf"), 1.0])]
    rows += [(350, [1.0, 2.0, 3.0]), (None, one), (0, one), (400, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash"))
    got = [tuple(r) for r in ann.Index(table, k=5).search(F.col("id") % 50 == 0).orderBy("rank").collect()]
    assert got == [(0, n, n, 1.0) for n in range(1, 6)]
    few = ann.Index(table.filter("vec_id in (0, 7)"), k=5).search(F.col("id") % 50 == 0).collect()
    assert [tuple(r) for r in few] == [(0, 1, 7, 0.0)]
    assert ann.Index(table.limit(0), k=5).search(F.col("id") % 50 == 0).count() == 0


# Queries and pipeline

EXPECTED = {
    "op1_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_html": "page_id url text n_chars",
    "op3_decontaminate": "doc_id item_id",
    "op4_ngram": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_simhash": "doc_id fingerprint component_id",
    "op6_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op7_lines": "doc_id text",
    "op8_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op9_quality": "doc_id held_out score predicted",
    "op10_neighbours": "query_id rank vec_id score",
}


@pytest.mark.parametrize("name", EXPECTED)
def test_query_has_its_columns_and_rows(spark, name):
    out = queries.QUERIES[name](spark, SF)
    assert out.columns[: len(EXPECTED[name].split())] == EXPECTED[name].split() or set(EXPECTED[name].split()) <= set(out.columns)
    rows = out.collect()
    tables = {"op2_html": "pages", "op8_chat": "conversations", "op10_neighbours": "embeddings"}
    table = spark.read.parquet(f"{SF}/{tables.get(name, 'documents')}.parquet")
    if name == "op8_chat":
        assert len(rows) == table.select("conv_id").distinct().count() + 1
    elif name == "op10_neighbours":
        assert len(rows) == 5 * table.filter("vec_id % 50 = 0").count()
    elif name != "op3_decontaminate":
        assert len(rows) == table.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    with duckdb.connect() as connection:
        for table in ("documents", "conversations"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        result = connection.execute(queries.ORACLE[name])
        columns = [c[0] for c in result.description]
        expected = sorted(result.fetchall(), key=repr)
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == expected


@pytest.mark.parametrize("name", sorted(set(queries.ORACLE) - {"op8_chat"}))
def test_sql_of_odd_rows(spark, name, tmp_path):
    """Nulls, empty texts and repeated rows; an id twice for the operators that allow it."""
    texts = [None, "", " \n", "a b c " * 9 + "a", "x x x x x x x", "Ünï — 漢字 " * 30, "Stop. Go! Why?", "same", "same"]
    docs = [(i, t, "en", [None, "", "s"][i % 3], 1) for i, t in enumerate(texts * 12)]
    turns = [(c, t, ["user", "assistant", "system", "tool", ""][(c + t * t) % 5], texts[(3 * c + t) % 9]) for c in range(40) for t in range(c % 9)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([*turns, (50, None, None, None)], "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    with duckdb.connect() as connection:
        for table in ("documents", "conversations"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        result = connection.execute(queries.ORACLE[name])
        columns = [c[0] for c in result.description]
        expected = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(r) for r in queries.QUERIES[name](spark, str(tmp_path)).select(*columns).collect()), key=repr) == expected


def test_pipeline_stages_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.sparkSession.conf.get("spark.checkpoint.dir")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == corpus_pipeline.COLUMNS
        path = os.path.join(base, f"test-{name}-{os.getpid()}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= set(before)
        assert docs.count() >= 0.7 * len(before)
    assert all(r["n_tokens"] == len(r["ids"]) and r["decoded"] == before[r["doc_id"]] for r in docs.collect())


def test_pipeline_run_equals_its_stages(spark):
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()]
    assert len(ids) == len(set(ids)) > 100
