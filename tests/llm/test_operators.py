"""The training-data operators against brute force, and on odd inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docsync.llm import ann, bpe, chat, exact_dedup, fim, html_extract, langid, minhash, mixing, packing, periodic, ppm, queries, suffix_dedup
from docsync.llm.components import connected_components
from docsync.llm.word_ids import TokenIds
from tests.conftest import DATA, same_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key long, bucket string, part int"
ODD = [None, "", " ", "a", "a", "\0", "é" * 3, "x " * 3000, "x " * 3000, "<|endoftext|> a", "123 !!", "日本 語"]


def documents(spark, texts, **columns):
    """A documents table with further columns whose names clash with inner ones."""
    rows = [(i, t, "en" if i % 2 else None, ["a", "b", None][i % 3], len(t or ""), 1, "z", 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def corpus(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    same_rows(spark, duck, queries.queries()[name], queries.oracle_sql()[name])


EVERY = {
    "langid": lambda d: langid.detect(d, langid.learn_profiles(d)),
    "exact": exact_dedup.exact_dedup,
    "ppm": lambda d: ppm.score(d, F.lit(True)),
    "bpe": lambda d: bpe.bpe_digests(d, queries.tokenizer_path()),
    "mixing": mixing.mixing_plan,
    "suffix": suffix_dedup.remove_repeats,
    "minhash": minhash.near_duplicates,
    "periodic": periodic.detect,
    "fim": fim.fill_in_middle,
}


@pytest.mark.parametrize("name", sorted(EVERY))
def test_odd_and_empty_tables(spark, name):
    odd = documents(spark, ODD)
    assert EVERY[name](odd).count() == len(ODD)
    assert EVERY[name](odd.filter("doc_id < 0")).count() == 0
    nameless = odd.withColumn("doc_id", F.when(F.col("doc_id") > 6, F.col("doc_id")))
    assert EVERY[name](nameless.unionByName(nameless)).count() == 2 * len(ODD)


# 1 language ID


def test_language_of_held_out_texts(spark, docs, corpus):
    found = {r.doc_id: r for r in queries.op1_language_id(spark, DATA).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in found if found[i].held_out]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in found)
    assert sum(found[i].lang_pred == lang[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_of_texts_without_letters(spark):
    got = {r.doc_id: (r.lang_pred, r.score) for r in EVERY["langid"](documents(spark, ODD)).collect()}
    assert all(got[i] == ("und", 0.0) for i in (0, 1, 2, 5, 10)) and got[3][0] == "en"
    nothing = documents(spark, ODD).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.detect(nothing, langid.learn_profiles(nothing)).collect()} == {"und"}


def padded(text):
    """A text's words of letters as the n-grams see them."""
    return " " + " ".join([*"".join(c if c.isalpha() else " " for c in text.lower()).split(), ""])


@pytest.mark.parametrize("most", [1, 4, None])
def test_grams_are_counted(most):
    texts, got = ["ab, AB", "", "ab"], Counter()
    for grams, text, row, times in langid.gram_counts(texts, most):
        assert sorted(row) == row.tolist()
        got.update({(int(t), "".join(map(chr, grams[r]))): int(n) for t, r, n in zip(text, row, times, strict=True)})
    want = Counter((i, p[k : k + 3]) for i, p in enumerate(map(padded, texts)) for k in range(len(p) - 2))
    assert got == want


@cache
def rolled(code, dims, place):
    return np.roll(langid.letter_vector(code, dims), place)


def test_profiles_bundle_bound_letters():
    one = langid.bind(np.array([[97, 98, 99]]), 64)[0]
    assert (one == rolled(97, 64, 2) * rolled(98, 64, 1) * rolled(99, 64, 0)).all()


def test_prediction_equals_brute_force(spark, corpus, docs):
    def bundle(text):
        seen = padded(text)
        vectors = {g: rolled(ord(g[0]), langid.DIMS, 2) * rolled(ord(g[1]), langid.DIMS, 1) * rolled(ord(g[2]), langid.DIMS, 0) for g in {seen[k : k + 3] for k in range(len(seen) - 2)}}
        return sum((n * vectors[g].astype(np.int64) for g, n in Counter(seen[k : k + 3] for k in range(len(seen) - 2)).items()), np.zeros(langid.DIMS, np.int64))

    lang = {r.doc_id: r.lang for r in docs.collect()}
    own = {i: bundle(t) for i, t in corpus}
    sums = {name: sum(own[i] for i in own if lang[i] == name and zlib.crc32(str(i).encode()) % 4 != 2) for name in set(lang.values()) - {None}}
    names = sorted(sums)
    unit = lambda v: v / max(1e-9, np.linalg.norm(v))
    for r in queries.op1_language_id(spark, DATA).collect():
        cosine = [float(unit(own[r.doc_id]) @ unit(sums[n])) for n in names]
        if any(c.isalpha() for c in dict(corpus)[r.doc_id]):
            assert r.lang_pred == names[int(np.argmax(cosine))] and r.score == pytest.approx(min(1, max(0, max(cosine))), abs=1e-4)
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)


def test_many_letters_take_bounded_memory():
    import tracemalloc

    r = random.Random(3)
    text = "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(1_000_000))
    short = ["".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(100)) for _ in range(500)]
    tracemalloc.start()
    try:
        for texts in ([text], short):
            found = langid.bundles(texts, np.arange(len(texts)), len(texts), 256)
            assert found.shape == (len(texts), 256) and np.abs(found).sum(axis=1).min() > 0
        assert tracemalloc.get_traced_memory()[1] < 300e6
    finally:
        tracemalloc.stop()


def test_profiles_do_not_depend_on_partitions(docs):
    first = {r.lang: r.profile for r in langid.learn_profiles(docs.repartition(1)).collect()}
    assert first == {r.lang: r.profile for r in langid.learn_profiles(docs.repartition(7)).collect()}


def test_filter_keeps_all_columns_and_clean_rows(spark):
    odd = documents(spark, ODD)
    kept = langid.keep_identified(odd, langid.learn_profiles(odd))
    assert kept.schema == odd.schema and {r.doc_id for r in kept.collect()} == {3, 4, 6, 7, 8, 9, 11}


def test_filter_rejects_by_the_profiles(spark, docs):
    words = " ".join(chr(0x4E00 + i * 7 % 5000) * 3 for i in range(60))
    odd = [(-1, words, None), (-2, words[:40], None), (-3, "1 2 3 ... !!", None), (-4, " ".join("bcdfgh"[i % 6] * 3 for i in range(100)), None), (-5, "A.", "en")]
    both = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    kept = {r.doc_id for r in langid.keep_identified(both, langid.learn_profiles(docs)).collect()}
    assert {i for i, _, _ in odd} - kept == {-1, -3, -4}  # foreign letters and gibberish go, few letters stay
    lettered = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text)}
    assert lettered <= kept


def test_filter_keeps_all_rows_when_nothing_is_labelled(spark):
    bare = documents(spark, ODD).withColumn("lang", F.lit(None).cast("string"))
    blank = bare.withColumn("lang", F.when(F.col("text").isNull(), "en"))
    for docs in (bare, blank):
        kept = langid.keep_identified(docs, langid.learn_profiles(docs))
        assert sorted(r.doc_id for r in kept.collect()) == list(range(len(ODD)))


# 2 exact dedup


@pytest.mark.parametrize("capacity, key_of", [(4096, F.xxhash64), (1, F.xxhash64), (2, lambda c: F.length(c).cast("long")), (1, lambda c: F.lit(0).cast("long"))])
def test_exact_dedup_with_splits_and_collisions(spark, capacity, key_of):
    texts = ODD + [f"t{i % 9}" for i in range(60)]
    got = exact_dedup.exact_dedup(documents(spark, texts), capacity=capacity, key_of=key_of, max_depth=6).collect()
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    for r in got:
        group = groups[texts[r.doc_id] or ""]
        assert (r.keep_id, r.group_size, r.kept) == (max(group), len(group), r.doc_id == max(group))
        assert r.text_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"))
    cells = exact_dedup.directory(keys, capacity=100, max_depth=10).collect()
    load = Counter()
    depth = {}
    bucket_of = {r.cell: r.bucket for r in cells}
    for r in keys.collect():
        b = bucket_of[(r.key & (2**64 - 1)) >> 54]
        load[b] += 1
    for r in cells:
        depth[r.bucket] = r.depth
    assert max(load.values()) <= 100 and len(set(depth.values())) >= 1
    pairs = defaultdict(int)
    for b, n in load.items():
        pairs[b >> 1] += n
    assert all(n > 100 for b, n in pairs.items() if (b << 1) in load and (b << 1 | 1) in load)


def test_the_directory_routes_buckets_to_owners(spark):
    texts = spark.createDataFrame([(i, f"text {min(i, 900)}") for i in range(1200)], "id long, body string").withColumn("key", F.xxhash64("body"))
    keys = texts.groupBy("key").agg(F.count("*").alias("n"))
    cells = exact_dedup.directory(keys, 50, 10)
    index = exact_dedup.build_index(texts, keys, cells, 10)
    rows = index.withColumn("task", F.spark_partition_id()).collect()
    tasks, bounds = defaultdict(set), defaultdict(list)
    for r in rows:
        tasks[r.bucket].add(r.task)
        bounds[r.bucket].append(r.key & (2**64 - 1))
    assert all(len(t) == 1 for t in tasks.values()) and len(tasks) > 10  # a bucket has one owner
    assert all(len(k) <= 50 for k in bounds.values())
    ranges = sorted((min(k), max(k)) for k in bounds.values())
    assert all(a[1] < b[0] for a, b in zip(ranges[:-1], ranges[1:], strict=True))  # and holds a range of keys
    assert {r.group_size for r in rows} == {1, 300} and max(r.keep_id for r in rows) == 1199
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(bucket#\d+, \d+\), REPARTITION", plan)) == 1
    assert [exact_dedup.depth_for(n, 100) for n in (0, 50, 1000, 10**12)] == [3, 3, 7, exact_dedup.MAX_DEPTH]


def test_dropping_copies_keeps_columns(spark):
    odd = documents(spark, ODD)
    kept = exact_dedup.drop_exact_copies(odd)
    assert kept.schema == odd.schema and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 6, 8, 9, 10, 11]


TWICE = "doc_id long, text string, tag int"


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_copies, minhash.drop_near_copies])
def test_dropping_copies_of_repeated_and_null_ids(spark, drop):
    one, two, three, four = (" ".join(f"{w}{i}" for i in range(12)) for w in ("a", "b", "c", "d"))
    rows = [(1, one, 0), (1, one, 1), (None, one, 2), (None, two, 3), (None, two, 4), (5, three, 5), (5, four, 6), (6, four, 7), (4, four, 8)]
    kept = drop(spark.createDataFrame(rows, TWICE))
    assert kept.columns == ["doc_id", "text", "tag"]
    kept = kept.collect()
    assert sorted(r.text for r in kept) == [one, two, three, four]
    assert {r.text: r.doc_id for r in kept} == {one: 1, two: None, three: 5, four: 6 if drop is exact_dedup.drop_exact_copies else 4}


# 3 HTML


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=x>Home</a></header><nav><ul><li><a href=y>Menu</a></ul></nav>
<div class="wrap"><div class="sidebar"><p>Some words, that stand, in the sidebar of the page, for long.</p></div>
<div class="content"><h1>Head &amp; line</h1><p>First, with <b>bo</b>ld text,<br>and&nbsp;more of it, to be long enough.</p><p>Second.<script>var a = "<p>";</script></p>
<form><p>Your name, please, and more.</p></form><div class="comments"><p>Nice text, I say, as a reader, of course.</p></div></div></div>
<div class="cookie-notice">We use cookies, as all do, so agree.</div><footer>Foot</footer></body></html>"""


def test_main_text():
    assert html_extract.main_text(PAGE) == "Head & line\nFirst, with bold text, and more of it, to be long enough.\nSecond."
    assert [html_extract.main_text(x) for x in (None, "", "<p>only", "text", "<nav>menu</nav>", "<!-- never closed", "<table><tr><td>a<td>b</table>")] == ["", "", "only", "text", "", "", "a\nb"]


def test_pages_of_the_template(spark):
    import html as unescape

    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in queries.op3_html_extract(spark, DATA).collect():
        article = re.sub(r"<br>|</?b>", " ", raw[r.page_id].split("<article>")[1].split("</article>")[0])
        blocks = [" ".join(unescape.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


WRAPPERS = [
    "wrap no-sidebar", "single has-sidebar", "site comments-open", "content with-header", "entry share-enabled", "post hentry category-news tag-politics", "modal-open", "page", "",
    "sidebar-layout", "menu-hidden", "header-fixed", "widget-free", "search-enabled page", "main-content", "ads-off", "cookie-accepted", "container", "is-newsletter", "layout-two-sidebars",
]
LEFT = [
    '<div class="comments"><p>{}</p></div>', '<div id="sidebar"><p>{}</p></div>', '<div class="cookie-banner"><p>{}</p></div>', '<div class="ad"><p>{}</p></div>', '<aside><p>{}</p></aside>',
    '<form><p>{}</p></form>', '<footer><p>{}</p></footer>', '<ul class="nav-menu"><li>{}</li></ul>', '<div class="related-posts"><p>{}</p></div>', '<section id="respond"><p>{}</p></section>',
    '<div style="display: none"><p>{}</p></div>', '<div role="navigation"><p>{}</p></div>', '<section class="post-comments"><article class="comment"><p>{}</p></article></section>',
]
SAID = "Some words, that stand beside the article, and are long, and have many commas, as notices may."


def an_article(n):
    return ["Head"] + [f"Paragraph {i}, with some words, that run on for a while, as articles do, and more." for i in range(n)]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", "<main><article>{}</article></main>", "<div><div>{}</div></div>"])
def test_wrappers_do_not_hide_the_article(wrapper, inner):
    lines = an_article(4)
    body = f"<h1>{lines[0]}</h1>" + "".join(f"<p>{x}</p>" for x in lines[1:])
    for beside in LEFT:
        page = f'<html><body><header><a href="/">Home</a></header><div class="{wrapper}">{inner.format(body)}</div>{beside.format(SAID)}</body></html>'
        assert html_extract.main_text(page) == "\n".join(lines), beside


@pytest.mark.parametrize("beside", LEFT)
def test_what_stands_inside_the_article_is_left_out(beside):
    lines = an_article(6)
    body = "".join(f"<p>{x}</p>" for x in lines[1:4]) + beside.format(SAID) + "".join(f"<p>{x}</p>" for x in lines[4:])
    assert html_extract.main_text(f"<body><div class=content><h1>Head</h1>{body}</div></body>") == "\n".join(lines)


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
@pytest.mark.parametrize("part", ["<section>{}</section>", "<div><div>{}</div></div>", "<div>{}</div>"])
def test_uneven_parts_of_an_article_stay_together(around, part):
    lines = an_article(30)[1:]
    closing = "One closing paragraph, which is short beside the others, but has eighty letters and more."
    pieces = [lines[:2], lines[2:26], lines[26:], [closing]]
    body = "".join(part.format("".join(f"<p>{x}</p>" for x in piece)) for piece in pieces) + "<ul><li>a point</li><li>another</li></ul>"
    page = f"<body><nav><a href=x>Menu</a></nav>{around.format(body)}<footer>Foot</footer></body>"
    assert html_extract.main_text(page) == "\n".join([*lines, closing, "a point", "another"])


@pytest.mark.parametrize("n", [2, 20])
@pytest.mark.parametrize("around", ["<main>{}</main>", "<div>{}</div>", "<main><div>{}</div></main>"])
def test_a_story_of_several_articles_stays_whole(n, around):
    parts = [f"Part {i}, with some words, that run on for a while, as articles do, and more of them." for i in range(n)]
    body = "".join(f"<article><h2>Head {i}</h2><p>{x}</p></article>" for i, x in enumerate(parts))
    beside = '<aside><article><p>Another story, that is told elsewhere, and is long enough to count as running text.</p></article></aside>'
    cards = '<article><a href=x>A card that is only a link to some other story of the same site, and that is long</a></article>'
    page = f"<body><nav><a href=x>Menu</a></nav>{around.format(body + cards)}{beside}</body>"
    assert html_extract.main_text(page) == "\n".join(x for i, text in enumerate(parts) for x in (f"Head {i}", text))


def test_links_in_an_article_are_content():
    lines = an_article(4)
    body = f"<h1>{lines[0]}</h1>" + "".join(f"<p>{x}</p>" for x in lines[1:]) + "<h2>Sources</h2><ul><li><a href=a>First source</a></li><li><a href=b>Second source</a></li></ul>"
    page = f"<body><article>{body}<ul class=share-links><li><a href=x>Share</a></li></ul></article><div class=col-side><p>{SAID}</p></div></body>"
    assert html_extract.main_text(page) == "\n".join([*lines, "Sources", "First source", "Second source"])


def test_values_and_broken_tags_of_any_length():
    value = "data:image/svg+xml," + "<svg a='>'>" * 1000
    assert html_extract.main_text(f'<p>One, two.</p><img src="{value}"><p>Three.</p>') == "One, two.\nThree."
    assert html_extract.main_text(f"<p {'a ' * 5000}>x") == "x"
    assert html_extract.main_text("a < b <!-- c") == "a < b"
    assert html_extract.main_text("<form><main><p>Inside, a form.</p></main></form>") == "Inside, a form."
    assert html_extract.main_text("<div class=sidebar><p>Only this.</p></div>") == "Only this."


def test_long_and_deep_pages_are_read_in_linear_time():
    import time

    n = 100_000
    pages = ["<div>x" * n, "<div>x" * (n // 2) + "</p></section>" * (n // 2), "<ul><li><ul>" + "<div>" * n + "</li>" * n, '<a x="' * n, '<a "' * n + "<p>x" * n, "<header>" * n + "x", "<p>x" * n]
    for page in pages:
        began = time.process_time()
        html_extract.main_text(page)
        assert time.process_time() - began < 4, page[:20]


def test_html_tables_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", ""), (3, "u", "<div>" * 5000 + "x"), (3, "u", "<a \"" * 3000)], "page_id long, url string, html string")
    assert sorted(r.n_chars for r in html_extract.extract_main_text(df).collect())[:2] == [0, 0]
    assert html_extract.extract_main_text(df.filter("page_id > 9")).count() == 0


# 4 PPM


def brute_ppm(texts, order, least, text):
    counts = defaultdict(Counter)
    for t in texts:
        s = b"\xff" * order + t + b"\xff"
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[s[i - k : i]][s[i]] += 1
    counts = {c: {b: n for b, n in x.items() if n >= least} for c, x in counts.items()}
    s, total = b"\xff" * order + text + b"\xff", 0.0
    for i in range(order, len(s)):
        excluded, p = set(), 1.0
        for k in range(order, -1, -1):
            seen = counts.get(s[i - k : i])
            left = {b: n for b, n in (seen or {}).items() if b not in excluded}
            if left:
                whole = sum(left.values()) + len(left)
                if s[i] in left:
                    p *= left[s[i]] / whole
                    break
                p *= len(left) / whole
                excluded |= set(seen)
        else:
            p /= 256 - len(excluded)
        total += math.log10(p)
    return total


def framed_grams(texts, order, most=1 << 22):
    """All grams of the texts; their owners are checked on the way."""
    found, owners = [np.zeros(0, np.uint64)], []
    for grams, owner, first in ppm.grams_of(texts, order, most):
        found.append(grams)
        owners += (owner + first).tolist()
    assert owners == [i for i, t in enumerate(texts) for _ in range(len(t) + 1)]
    return np.concatenate(found)


@pytest.mark.parametrize("seed", range(60))
def test_ppm_equals_brute_force(seed):
    r = random.Random(seed)
    word = lambda n: bytes(r.choice(b"abcd\xc3") for _ in range(r.randint(0, n)))
    texts, order, least = [word(12) for _ in range(r.randint(0, 6))], r.randint(0, 4), r.randint(1, 2)
    grams = framed_grams(texts, order, r.choice([3, 7, 1000]))
    assert len(grams) == sum(len(t) + 1 for t in texts)
    counts = []
    for k in range(order + 1):
        u, n = np.unique(grams & np.uint64((1 << (8 * (k + 1))) - 1), return_counts=True)
        counts.append((u[n >= least], n[n >= least].astype(float)))
    trie = ppm.Trie(counts)
    for text in (word(10), *texts[:1], b"zz"):
        assert trie.scores(framed_grams([text], order)).sum() == pytest.approx(brute_ppm(texts, order, least, text), abs=1e-9)


def test_ppm_probabilities_add_up():
    grams = framed_grams([b"abcab", b"ab"], 2)
    counts = []
    for k in range(3):
        u, n = np.unique(grams & np.uint64((1 << (8 * (k + 1))) - 1), return_counts=True)
        counts.append((u, n.astype(float)))
    trie = ppm.Trie(counts)
    for context in (b"ab", b"ca", b"zz"):
        head = np.uint64(context[0] << 16 | context[1] << 8)
        assert (10 ** trie.scores(np.array([head | np.uint64(b) for b in range(256)], np.uint64))).sum() == pytest.approx(1)


def test_score_query(spark, corpus):
    got = {r.doc_id: r for r in queries.op4_ppm(spark, DATA).collect()}
    train = [t for i, t in corpus if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in t.encode().lower().split())
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    for i, t in corpus:
        words = t.encode().lower().split()
        base = math.fsum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((len(train) + 1) / (n + v + 1))
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words) + 1, 1 + sum(w in counts for w in words), n, zlib.crc32(str(i).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(base, abs=1e-6)
    for i, t in corpus[:3]:
        assert got[i].score == pytest.approx(brute_ppm([x.encode() for x in train], ppm.ORDER, 1, t.encode()), abs=1e-6)


@pytest.mark.parametrize(("part", "order", "lot"), [(1, 3, 2), (40, 2, 3), (1, 5, 256), (1 << 20, 5, 256)])
def test_all_grams_are_scored_from_their_full_contexts(spark, part, order, lot):
    texts = ["abcabcabcabd", "abcab xyz", "é日本", "", None, "aaaaaaaa"]
    rows = [*enumerate(texts), (6, "abd zzz q"), (7, "\0\1"), (8, "abcabcabcabd"), (None, "abd"), (9, "zz " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learned = [(t or "").encode() for t in texts]
    got = {r.doc_id: r for r in ppm.score(docs, F.col("doc_id") < 6, order=order, part_bytes=part, lot_parts=lot).collect()}
    assert len(got) == len(rows)
    counts = Counter(w for t in learned for w in t.lower().split())
    n, v = sum(counts.values()) + len(texts), len(counts) + 1
    for i, t in rows:
        raw = (t or "").encode()
        assert got[i].score == pytest.approx(brute_ppm(learned, order, 1, raw), abs=1e-9), i
        base = [math.log10((counts[w] + 1) / (n + v + 1)) for w in raw.lower().split()]
        assert got[i].base_score == pytest.approx(math.fsum(base) + math.log10((len(texts) + 1) / (n + v + 1)), abs=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(base) + 1, 1 + sum(w in counts for w in raw.lower().split()), n)


def test_scoring_with_nothing_to_learn_from(spark):
    docs = documents(spark, ODD)
    for r in ppm.score(docs, F.lit(None).cast("boolean")).collect():
        assert r.score == pytest.approx(-math.log10(256) * (len((ODD[r.doc_id] or "").encode()) + 1))
        assert (r.base_score, r.n_known, r.train_tokens) == (0.0, 0, 0)


# 5 BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_bpe_equals_the_library_on_any_text(library):
    codec, r = bpe.Codec(bpe.Vocabulary.load(queries.tokenizer_path())), random.Random(1)
    letters = "abcdethin  \n\t\x0b\x1c\x1f\x85\xa0​　éß中文😀'’sSvVlLdD0129½²_-.,!<|>\x00﻿"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) + "a" * r.choice([0, 0, 9]) + r.choice(["", "", "<|endoftext|>x"]) for _ in range(3000)]
    for text, words in zip(texts, codec.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert [int(i) for w in words if w[1] for i in w[0].split(",")] == want
        assert b"".join(w[2] for w in words).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def test_bpe_query(spark, corpus, library):
    got = {r.doc_id: r for r in queries.op5_bpe(spark, DATA).collect()}
    for i, t in corpus:
        ids = library.encode(t, add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_bpe_round_trip(spark):
    coded = bpe.bpe_encode(documents(spark, ODD), queries.tokenizer_path())
    back = {r.doc_id: r.decoded for r in bpe.bpe_decode(coded, queries.tokenizer_path()).collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}


def test_a_full_word_cache_changes_nothing(monkeypatch):
    vocab = bpe.Vocabulary.load(queries.tokenizer_path())
    texts = [f"some words {i} and more{i}" for i in range(50)]
    want = bpe.Codec(vocab).encode(texts)
    monkeypatch.setattr(bpe, "MAX_WORDS", 3)
    codec = bpe.Codec(vocab)
    assert [codec.encode([t])[0] for t in texts] == want


# 6 mixing


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 50, 2, 90], [0, 0], [5], [0, 7, 3, 1000, 2, 2, 8]])
def test_targets_equal_resharing(spark, sizes):
    rows = [(f"s{i:02}" if i else None, n, 1) for i, n in enumerate(sizes)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, source_size long, n_docs long")).collect()}
    order = sorted((r[0] for r in rows if r[0]), key=str) + [None]
    weight, size = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, {r[0]: r[1] for r in rows}
    target, left = dict.fromkeys(order, 0.0), 1.5 * sum(sizes)
    free = set(order)
    while left > 1e-9 and free:  # share by weight, stop the full ones, share the excess again
        unit = left / sum(weight[s] for s in free)
        left = 0.0
        for s in sorted(free, key=str):
            target[s] += unit * weight[s]
            if target[s] >= 2 * size[s]:
                left += target[s] - 2 * size[s]
                target[s] = 2.0 * size[s]
        free = {s for s in free if target[s] < 2 * size[s]}
    assert got == pytest.approx(target)


def test_mix_repeats_rows(spark, docs):
    plan = {r.doc_id: r for r in mixing.mixing_plan(docs).collect()}
    mixed = Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert mixed == {i: r.copies for i, r in plan.items() if r.copies}
    assert all(r.taken <= 2 * r.size for r in plan.values()) and mixing.mix(docs).schema == docs.schema


def by_source(docs):
    """(words taken, target) of each source, and its largest document."""
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, target, largest = Counter(), {}, Counter()
    for r in mixing.mixing_plan(docs).collect():
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s], largest[s] = r.target, max(largest[s], r.size)
    return {s: (taken[s], target[s], largest[s]) for s in target}


def test_every_source_comes_near_its_target(spark, docs):
    for taken, target, largest in by_source(docs).values():
        assert abs(taken - target) <= max(0.02 * target, largest)
    even = documents(spark, ["a b c d e f"] * 150)
    for taken, target, _ in by_source(even).values():
        assert abs(taken - target) <= 2 * 6


def test_every_document_is_as_likely_as_its_source_asks(spark):
    """400 sources of the same sizes, other ids: as many draws of one table. The largest document holds most words."""
    sizes = [1000, 20, 20, 20, 20, 20, 20, 3, 3, 1]
    rows = [(f"{s}-{j}", "w " * n, f"s{s:03}") for s in range(400) for j, n in enumerate(sizes)]
    table = spark.createDataFrame(rows, "doc_id string, text string, source string")
    for budget, f in ((1.3, 0.3), (1.7, 0.7)):
        got = Counter()
        for r in mixing.mixing_plan(table, weights=(1,), budget=budget).collect():
            assert r.copies in (1, 2)
            got[int(r.doc_id.split("-")[1])] += r.copies - 1
        deviation = (400 * f * (1 - f)) ** 0.5
        assert all(abs(got[j] - 400 * f) < 4 * deviation for j in range(len(sizes))), got
    single = spark.createDataFrame([(i, "w", f"s{i:03}") for i in range(400)], "doc_id long, text string, source string")
    taken = sum(r.copies - 1 for r in mixing.mixing_plan(single, weights=(1,), budget=1.3).collect())
    assert abs(taken - 120) < 4 * (400 * 0.21) ** 0.5  # sources of one document too


def test_counts_of_a_source_are_exact(spark):
    """With equal sizes a source takes its share of documents to within one, however few it has; large classes to within a bin's draws."""
    rows = [(i, "a b", f"s{i % 40:02}" if i < 400 else "zz") for i in range(20_400)]
    plan = mixing.mixing_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1,), budget=1.3)
    each = plan.groupBy(F.col("source_size"), F.when(F.col("doc_id") < 400, F.col("doc_id") % 40)).agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= (2 if r.target < 100 else 30) for r in each)


def test_classes_of_sizes(spark):
    sizes = [*range(70), 127, 128, 1 << 20, (1 << 40) + 5]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in sizes], "n long").select(mixing.size_class(F.col("n"))).collect()]
    want = [len(bin(n)[2:]) * 16 + int(bin(n)[2:6].ljust(4, "0"), 2) for n in sizes]
    assert got == want == sorted(want)


# 7 repeated strings


def brute_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        flags = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                flags[i : i + length] = True
        out.append(flags)
    return out


def test_repeats_equal_brute_force(spark):
    r = random.Random(2)
    base = "".join(r.choice("abcdefgh é") for _ in range(300))
    texts = [None, "", "short", "a" * 90, "ab" * 60]
    for _ in range(60):
        a = r.randint(0, 250)
        t = list("".join(r.choice("uvw") for _ in range(r.randint(0, 20))) + base[a : a + r.randint(0, 120)] + "".join(r.choice("xyz") for _ in range(r.randint(0, 20))))
        if t and r.random() < 0.5:
            t[r.randrange(len(t))] = "Q"
        texts.append("".join(t))
    texts += texts[-3:]
    got = {x.doc_id: x for x in suffix_dedup.remove_repeats(documents(spark, texts), length=40, gram=12).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, (t, flags) in enumerate(zip(raw, brute_repeats(raw, 40), strict=True)):
        runs = int((np.diff(np.concatenate(([0], flags.astype(int)))) == 1).sum())
        rest = bytes(np.frombuffer(t, np.uint8)[~flags])
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(t), int(flags.sum()), runs, hashlib.sha256(rest).hexdigest()), i


def test_repeats_query(spark, corpus):
    raw = [t.encode() for _, t in corpus]
    got = {x.doc_id: x for x in queries.op7_suffix_dedup(spark, DATA).collect()}
    for (i, _), flags in zip(corpus, brute_repeats(raw, 200), strict=True):
        assert got[i].n_removed == int(flags.sum())


# 8 nearest neighbours


def test_nearest_recall_and_order(spark):
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = {r.vec_id: np.asarray(r.embedding, float) for r in vectors.collect()}
    got = defaultdict(list)
    for r in queries.op8_ann(spark, DATA).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q, found in got.items():
        exact = sorted((float(np.sqrt(((v - rows[q]) ** 2).sum())), i) for i, v in rows.items() if i != q)[:10]
        hits += len({i for _, i in exact} & {i for i, _ in found})
        assert [s for _, s in found] == sorted(s for _, s in found)
        assert all(s == pytest.approx(float(np.sqrt(((rows[i] - rows[q]) ** 2).sum())), abs=1e-12) for i, s in found)
    assert set(got) == {i for i in rows if i % 100 == 0} and hits >= 0.9 * 10 * len(got)


def test_repeated_ids_push_out_no_neighbours():
    r = np.random.default_rng(3)
    points = r.standard_normal((40, 4))
    gaps = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    want = [i for i in np.lexsort((np.arange(40), gaps)) if i][:10]
    asked = pd.DataFrame({"keys": [[1]], "query": [0], "vector": [points[0].tolist()]})
    for times in ([2] * 40, [1] * 40, [12 if i == want[0] else 1 for i in range(40)]):
        ids = np.repeat(np.arange(40), times)
        base = pd.DataFrame({"key": 1, "id": ids, "vector": points[ids].tolist()})
        assert ann._search(10)(base, asked)["id"].tolist() == want


def test_repeated_queries_give_one_answer(spark):
    r = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(r.standard_normal((60, 5)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(map(tuple, ann.nearest(df, F.col("vec_id") % 20 == 0, reach=1.1).collect()))
    assert sorted(map(tuple, ann.nearest(df.unionByName(df), F.col("vec_id") % 20 == 0, reach=1.1).collect())) == want


def test_nearest_of_odd_vectors(spark):
    odd = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [1.0, None]), (6, []), (7, [1.0, 2.0, 3.0]), (8, [0.0, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<float>")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 100, 0.0), (0, 2, 8, math.sqrt(2)), (100, 1, 0, 0.0), (100, 2, 8, math.sqrt(2))]
    assert ann.nearest(df.filter("vec_id < 0"), F.lit(True)).count() == 0


def test_a_crowded_bucket_is_searched_whole(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP", 50)
    rows = [(i, [1.0, 1.0]) for i in range(300)] + [(300 + i, [1.0 + i / 100, 1.0]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id))
    assert [i for _, i in sorted(got[200])] == list(range(10)) and len(got) == 4


# 9 near duplicates


def brute_components(texts, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [root(i) for i in range(len(texts))]


def near_copies(seed):
    r = random.Random(seed)
    texts = [None, "", " ", "one two", "ONE  two", "one two three four five", "one two three four five six"]
    for _ in range(6):
        base = [f"w{r.randint(0, 5000)}" for _ in range(r.randint(20, 200))]
        for _ in range(r.randint(1, 25)):
            copy = list(base)
            for _ in range(r.randint(0, 6)):
                copy[r.randrange(len(copy))] = f"n{r.randint(0, 9999)}"
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_brute_force(spark, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(minhash, "CROWDED", 4)
        monkeypatch.setattr(minhash, "BLOCK", 5)
        monkeypatch.setattr(minhash, "SKETCH_BLOCK", 7)
    texts = near_copies(seed)
    n, component = brute_components(texts, 85)
    got = {r.doc_id: r for r in minhash.near_duplicates(documents(spark, texts)).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == n
    assert [got[i].component_id for i in range(len(texts))] == component
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_rows_of_a_region_of_strangers_grow_with_its_members(spark):
    for n, most in ((1500, 1), (3000, 1), (6000, 3)):
        named = spark.range(n).select(F.lit(7).cast("long").alias("region"), "id", F.col("id").alias("comp"))
        assert minhash.dealt_in_blocks(named, ["region", "id", "comp"], minhash.SKETCH_BLOCK).count() <= most * n


def test_every_pair_of_a_region_meets(spark):
    named = spark.range(50).select(F.lit(7).cast("long").alias("region"), "id", F.when(F.col("id") < 20, 0).otherwise(F.col("id")).alias("comp"))
    met = set()
    for _, g in minhash.dealt_in_blocks(named, ["region", "id", "comp"], 6).toPandas().groupby(["block", "minor_block"]):
        met |= {frozenset((a, b)) for a in g[g.minor]["id"] for b in g[g.here]["id"]}
    assert all(frozenset((a, b)) in met for a in range(20, 50) for b in range(50) if a != b)


@pytest.mark.parametrize(("percent", "depth"), [(85, 4), (80, 3), (50, 1), (10, 1), (99, 6)])
def test_depth_of_regions_follows_the_threshold(percent, depth):
    assert minhash.first_depth(percent) == depth


def test_near_duplicates_of_the_corpus(spark, corpus):
    n, component = brute_components([t for _, t in corpus], 85)
    ids = [i for i, _ in corpus]
    got = {r.doc_id: r for r in queries.op9_minhash_forest(spark, DATA).collect()}
    assert [(got[i].n_shingles, got[i].component_id) for i in ids] == [(a, ids[b]) for a, b in zip(n, component, strict=True)]


def test_connected_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, x) for x in range(1001, 1200)] + [(r.randint(2000, 2300), r.randint(2000, 2300)) for _ in range(200)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u long, v long").repartition(5)
    for local in (100_000, 40):
        got = {x.node: x.component for x in connected_components(df, local=local).collect()}
        assert got == {x: root(x) for u, v in edges if u != v for x in (u, v)}
    assert connected_components(df.filter("u < 0")).count() == 0


# 10 chat


def test_snapshots_collapse(spark):
    log = [
        (1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "bot", "b"), (3, 2, "user", "c"), (4, 1, "bot", "b"), (4, 0, "user", "a"),
        (5, 0, "user", "ab"), (6, 0, None, None), (None, 0, "user", "lost"), (7, 0, "user", ""), (8, 0, "user", "a"), (8, 1, "bot", "x"),
    ]
    df = spark.createDataFrame(log, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.maximal_conversations(df).collect()}
    assert set(got) == {3, 5, 6, 7, 8}
    assert got[3] == (3, 1, "<|user|>\na<|end|>\n<|bot|>\nb<|end|>\n<|user|>\nc<|end|>\n") and got[6][2] == "<|user|>\n<|end|>\n"
    again = df.filter("conv_id = 3").withColumn("conv_id", F.lit(9).cast("long"))
    assert {r.conv_id: r.n_copies for r in chat.maximal_conversations(df.unionByName(again)).collect()}[3] == 2
    assert chat.maximal_conversations(df.filter("conv_id < 0")).count() == 0


def test_native_operators_run_no_python(spark):
    for df in (queries.op2_exact_dedup(spark, DATA), queries.op10_chat_format(spark, DATA), queries.op6_mixing(spark, DATA)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# 11 periodic runs


def brute_runs(words, least=6, times=4):
    """(start, length, period) of all runs, by comparing every period."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def periodic_text(r, n):
    words = []
    while len(words) < n:
        group = [r.choice(["a", "b", "c", "dé", "日", "e."][: r.choice([1, 2, 3, 6])]) for _ in range(r.randrange(1, 9))]
        words += (group * r.randrange(1, 9))[: r.randrange(1, 60)]
    return words[:n]


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (9, 3), (1, 5)])
def test_runs_equal_brute_force(least, times):
    for seed in range(150):
        r = random.Random(seed)
        texts = [[ord(w[0]) for w in periodic_text(r, r.choice([0, 1, 5, 6, 20, 90]))] for _ in range(r.randrange(1, 6))]
        offsets = np.cumsum([0, *map(len, texts)])
        rows = periodic.find_runs(np.array([x for t in texts for x in t], np.int32), offsets, least, times)
        for i, t in enumerate(texts):
            own = [(int(a - offsets[i]), int(b - a), int(q)) for a, b, q in rows if offsets[i] <= a < offsets[i + 1]]
            assert own == brute_runs(t, least, times), (seed, t)


def test_masking_keeps_every_run():
    assert periodic.minimum_overlap(6, 4) == 5 and periodic.minimum_overlap(2, 2) == 1
    for seed in range(50):
        words = np.array([ord(w[0]) for w in periodic_text(random.Random(seed), 80)])
        kept = periodic.survivors(words, np.array([0, len(words)]), 5)
        assert all(kept[a : a + n].all() for a, n, _ in brute_runs(words.tolist()))
    assert not periodic.survivors(np.arange(100), np.array([0, 100]), 5).any()


def test_runs_survive_hashes_that_deceive(monkeypatch):
    monkeypatch.setattr(periodic.Prefixes, "equal", lambda self, at, length, q: np.ones(len(at), bool))
    for seed in range(30):
        words = np.array([ord(w[0]) for w in periodic_text(random.Random(seed), 60)])
        rows = periodic.find_runs(words, np.array([0, len(words)]), 6, 4)
        assert [(a, b - a, q) for a, b, q in rows.tolist()] == brute_runs(words.tolist())


def test_a_long_text_is_cut_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 7}" for i in range(5000)).encode() + b" tail\x0b\x0cend"
    whole = periodic.Words()
    want = whole.joined(whole.of(text))
    monkeypatch.setattr(periodic, "PIECE_BYTES", 10)
    monkeypatch.setattr(periodic, "PAIRS", 5)
    pieces = periodic.Words()
    assert pieces.joined(pieces.of(text)) == want == b" ".join(text.split())
    values = pieces.of(text)
    assert periodic.find_runs(values, np.array([0, len(values)]), 6, 4).tolist() == [[0, 5000, 7]]


def test_a_text_of_one_word_is_fast():
    values = np.zeros(400_000, np.int32)
    assert periodic.find_runs(values, np.array([0, len(values)]), 6, 4).tolist() == [[0, 400_000, 1]]


def test_periodic_query_equals_brute_force(spark, corpus):
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, DATA).collect()}
    assert set(got) == {i for i, _ in corpus}
    some = 0
    for i, text in corpus:
        words, h = text.encode().split(), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if n > 1500:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        runs = brute_runs(words)
        some += len(runs)
        gone = {j for a, length, q in runs for j in range(a + q, a + length)}
        best = None
        for x in runs:
            best = x if best is None or x[1] * best[2] > best[1] * x[2] else best
        listed = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone)
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want
    assert some > 5


def test_periodic_detect_on_odd_texts(spark):
    got = {r.doc_id: r for r in periodic.detect(documents(spark, [*ODD, "a b " * 3 + "a c", "x y " * 4])).collect()}
    assert (got[0].n_words, got[0].runs, got[0].collapsed) == (0, [], "") and got[7].collapsed == "x" and got[7].runs == [(0, 3000, 1)]
    assert got[12].runs == [] and got[12].collapsed == "a b a b a b a c" and got[13].runs == [(0, 8, 2)] and got[13].collapsed == "x y"
    tie = spark.createDataFrame([([(0, 8, 2), (20, 12, 3), (40, 4, 1)],), ([],)], "runs array<struct<start:bigint,length:bigint,period:bigint>>")
    assert [r[0] and tuple(r[0]) for r in tie.select(periodic.longest_run(F.col("runs"))).collect()] == [(0, 8, 2), None]


# 12 fill in the middle

FIM_TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@pytest.mark.parametrize("chunk", [1, 2, 5, 4096])
def test_cuts_equal_tokens(chunk, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 11)
    for seed in range(60):
        r = random.Random(seed)
        texts = ["".join(r.choice(["a", "é", " ", "\n", "日", "\x1f", "\xa0"]) for _ in range(r.choice([0, 1, 3, 30]))) for _ in range(r.randrange(1, 8))]
        offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
        draws = np.array([[r.randrange(2**32), r.randrange(2**32)] for _ in texts])
        n, places = fim.cut_places(np.frombuffer("".join(texts).encode(), np.uint8), offsets, draws, chunk)
        for i, t in enumerate(texts):
            tokens = FIM_TOKEN.findall(t)
            assert n[i] == len(tokens)
            assert [places[i, c] for c in (0, 1)] == [len("".join(tokens[: draws[i, c] % (len(tokens) + 1)])) for c in (0, 1)]


def test_fill_in_middle_is_exact_and_restored(spark):
    texts = [*ODD, "<P> marked", "a <S", "< P>", "<", *[f"w{i} " * (i % 13) + " \n" * (i % 2) for i in range(200)]]
    df = documents(spark, texts)
    made = fim.fill_in_middle(df, rate=90, spm=50)
    forms = Counter()
    for r in made.withColumn("back", fim.restored(F.col("form"), F.col("output"))).collect():
        text = texts[r.doc_id] or ""
        tokens = FIM_TOKEN.findall(text)
        digest = hashlib.sha256(f"42:{r.doc_id}".encode()).hexdigest()
        h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
        one, other = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
        p, m, s = ("".join(x) for x in (tokens[:one], tokens[one:other], tokens[other:]))
        form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 50 else "psm"
        output = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        lengths = (None, None) if form == "plain" else (len(p), len(m))
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) == (len(tokens), form, *lengths, output, text)
        forms[form] += 1
    assert min(forms.values()) > 10
    nameless = df.withColumn("doc_id", F.lit(None).cast("long"))
    assert {r.form for r in fim.fill_in_middle(nameless).collect()} <= {"plain", "spm", "psm"} and fim.fill_in_middle(df.filter("doc_id < 0")).count() == 0


# 13 packing


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))


def library_ids(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


ALPHABET = [*"abcXYZ'sSdt.,!<|>0123 \n\t", "İ", "ı", "ß", "É", "é", "e\u0301", "\u0301", "Σ", "ς", "Ж", "й", "²", "½", "\x1f", "\x85", "\xa0", "\xad", "<|endoftext|>", "<|STARTOFTEXT|>", "日本", "'ll", "'RE", "ǅ", "ϔ", "😀", "\0", "x" * 70, "%" * 30]


def test_word_ids_equal_the_library(word_tokenizer, monkeypatch):
    from docsync.llm import word_ids

    known = TokenIds.load(queries.tokenizer_path("word_bpe_49k.json"))
    assert known.by_word
    monkeypatch.setattr(word_ids, "MAX_WORDS", 400)
    for seed in range(400):
        r = random.Random(seed)
        texts = ["".join(r.choice(ALPHABET) for _ in range(r.choice([0, 1, 3, 12, 60]))) for _ in range(4)]
        assert known.of([t.encode() for t in texts]) == [library_ids(word_tokenizer, t) for t in texts], texts
    other = TokenIds.load(queries.tokenizer_path())
    assert not other.by_word and other.of([b"Some text"]) == [np.array(bpe_library().encode("Some text").ids, "<u4").tobytes()]


def bpe_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def check_packing(rows, ids, size):
    """Pieces are whole, sequences gapless and at most ``size``; returns how many places are padded."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for i, want in ids.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want) // 4 and r.ids_crc32 == zlib.crc32(want[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(want) // 4
    padded = 0
    for part in sequences.values():
        at = 0
        for r in sorted(part, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
        padded += 0 if at & (at - 1) == 0 else size - at
    return padded


def test_packing_query_holds_every_id_once(spark, corpus, word_tokenizer):
    ids = {i: library_ids(word_tokenizer, t) + b"\2\0\0\0" for i, t in corpus}
    assert check_packing(queries.op13_packing(spark, DATA).collect(), ids, 4096) == 0


@pytest.mark.parametrize("windows, merged", [(1, 2), (3, 2), (16, 64)])
def test_leftovers_are_merged_in_rounds(spark, word_tokenizer, monkeypatch, windows, merged):
    monkeypatch.setattr(packing, "MERGED", merged)
    texts = [*ODD, *[f"word{i} " * (i % 40) for i in range(300)]]
    df = documents(spark, texts).repartition(7)
    rows = packing.pack(df, queries.tokenizer_path("word_bpe_49k.json"), size=64, open_windows=windows).collect()
    ids = {i: library_ids(word_tokenizer, t or "") + b"\2\0\0\0" for i, t in enumerate(texts)}
    assert check_packing(rows, ids, 64) == 0
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    short = sum(1 for i in ids.values() if len(i) // 4 <= 64)
    whole = sum(1 for r in rows if r.length == r.doc_tokens)
    assert whole > 0.5 * short  # most documents that fit in a sequence are not cut


def test_packer_prefers_the_best_fit_and_emits_the_fullest():
    packer = packing.Packer(8, 2)
    add = lambda doc, n: list(packer.add(doc, 0, bytes(4 * n), n))
    assert add("a", 5) == [] and add("b", 6) == [] and add("c", 2) == [[("b", 0, bytes(24), 6), ("c", 0, bytes(8), 2)]]  # 2 fit the window of 6 best
    assert add("d", 4) == [] and packer.used == [5, 4]
    out = add("e", 6)  # fits in neither: the fullest is topped up with its first 3, the rest goes where it fits
    assert [(p[0], p[1], len(p[2]) // 4) for p in out[0]] == [("a", 0, 5), ("e", 0, 3)] and packer.used == [7]
    assert [sum(len(p[2]) // 4 for p in w) for w in packing.Packer(8, 2).last()] == []
    assert [sum(len(p[2]) // 4 for p in w) for w in packer.last()] == [4, 2, 1]
    assert [len(w) for w in packing.Packer(8, 2).add("long", 0, bytes(4 * 19), 19)] == [1, 1]


def test_packing_odd_tables(spark):
    path = queries.tokenizer_path("word_bpe_49k.json")
    df = documents(spark, ODD)
    nameless = df.withColumn("doc_id", F.when(F.col("doc_id") > 6, F.col("doc_id")))
    rows = packing.pack(nameless.unionByName(nameless), path, keep_ids=False).collect()
    assert sum(r.length for r in rows if r.doc_id is None) > 0 and "ids" not in rows[0].asDict()
    assert packing.pack(df.filter("doc_id < 0"), path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, path, size=100)
