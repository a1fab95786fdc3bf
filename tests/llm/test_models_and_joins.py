"""Toxicity, language ID, HTML, Jaccard join, top-k search and the pipeline."""

import random
import types
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orbiscope.llm import common, components, html_text, jaccard_join, langid, topk_search, toxicity

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- toxicity --------------------------------------------------------------------------------------------------------


def made_corpus(n, seed=1):
    """Clean words; a third of the texts holds one sentence with a bad stem in some inflection."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 12))) for _ in range(rng.randint(1, 12))]
        bad = i % 3 == 0
        at = None
        if bad:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(["zorgly", "zorgling", "zorgness", "vexhum", "Vexhums"])
        rows.append((i, ". ".join(sentences) + ".", at))
        labels.append((i, int(bad)))
    return rows, labels


def test_noisy_or_learns_stems_and_locates_sentences(spark):
    rows, labels = made_corpus(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], DOCS)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    table = spark.createDataFrame([x for x in labels if x[0] not in held], "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    new = [(10_000, "a zorgish word. nothing here."), (10_001, "nothing at all here. nor here."), (10_002, None), (10_003, "")]
    scored = {r.doc_id: r for r in toxicity.score(docs.unionByName(spark.createDataFrame(new, DOCS)), model).collect()}
    right = sum((scored[i].score >= 0.5) == bool(y) for i, y in labels if i in held)
    assert right / len(held) > 0.97
    located = [(at, [s.sentence for s in scored[i].sentences]) for i, _, at in rows if at is not None]
    assert sum(a == [at] for at, a in located) / len(located) > 0.95
    assert scored[10_000].score >= 0.5 and [s.sentence for s in scored[10_000].sentences] == [0]
    assert scored[10_001].score < 0.5 and scored[10_002].score == scored[10_003].score == 0


def test_noisy_or_gradient():
    rng = np.random.default_rng(0)
    docs = []
    for _ in range(40):
        n = int(rng.integers(1, 5))
        pairs = sorted({(int(rng.integers(n)), int(rng.integers(3))) for _ in range(4)})
        docs.append((n, np.array([s for s, _ in pairs]), np.array([w for _, w in pairs])))
    labels = np.array([int(2 in d[2]) for d in docs])
    model = toxicity.fit(docs, labels, [b"a", b"b", b"c"], decay=0.0)
    assert model.weights[b"c"] > 2 and model.weights[b"c"] > 2 + max(model.weights.get(b"a", 0), model.weights.get(b"b", 0))


def test_toxicity_query(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = toxicity.digest_query(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def plain_toxicity(model, text):
    """The score by the definition, with strings and products."""
    import math
    import re

    found = []
    for sentence in re.split(r"[.!?\n]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
        words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", sentence)
        if words:
            features = [f for w in words for f in [w, *(w[:n] + "*" for n in toxicity.BEGINNINGS if len(w) >= n)]]
            p = 1 / (1 + math.exp(-model.bias - sum(model.weights.get(f.encode(), 0.0) for f in features)))
            found.append(max(0.0, (p - model.background) / (1 - model.background)))
    return 1 - math.prod(1 - p for p in found), [i for i, p in enumerate(found) if p >= toxicity.SENTENCE_SCORE]


def test_scores_match_a_plain_program(spark, docs, sf_dir):
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert model.weights and 0 < model.background <= 0.1
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in toxicity.score(docs, model).collect():
        score, bad = plain_toxicity(model, texts[r.doc_id])
        assert abs(r.score - score) < 1e-6 and [s.sentence for s in r.sentences] == bad


def test_length_alone_is_not_toxic(spark):
    rows, labels = made_corpus(600)
    model = toxicity.train(spark.createDataFrame([(i, t) for i, t, _ in rows], DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"))
    clean = [t for (_, t, at), _ in zip(rows, labels, strict=True) if at is None]
    neutral, long = "nothing is here. " * 20_000, " ".join(clean * (20_000 // sum(t.count(".") for t in clean) + 1))
    texts = [neutral, long, neutral + "a zorgly word. " + neutral]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), DOCS), model).collect()}
    assert long.count(".") >= 20_000 and got[0].score < 0.5 and got[1].score < 0.5
    assert got[2].score >= 0.5 and [x.sentence for x in got[2].sentences] == [20_000]


def test_repeated_ids_do_not_grow_the_sample(spark):
    rows, labels = made_corpus(60)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] * 5 + [(i, None) for i in range(60)], DOCS)
    once = spark.createDataFrame([(i, t) for i, t, _ in rows], DOCS)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.train(docs, table) == toxicity.train(once, table)


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1)], [(1, None), (None, 1), (2, 7)]])
def test_toxicity_without_two_classes(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, ""), (1, "a b")], DOCS)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.digest_query(docs, table).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.digest_query(spark.createDataFrame([], DOCS), table).count() == 0


# --- language ID -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("k", [2, 3, 4, 5, 6, 12])
def test_codewords_are_apart(k):
    code = langid.codewords(k)
    assert code.shape[0] == k and set(np.unique(code)) <= {-1.0, 1.0}
    apart = min(int((a != b).sum()) for a, b in combinations(code, 2))
    assert apart >= max(1, code.shape[1] // 4)


def test_decoding_corrects_a_wrong_bit():
    code = langid.codewords(4)
    bits = code.shape[1]
    model = langid.LanguageModel(list("abcd"), code, np.zeros((1, bits)), np.zeros(bits), np.full((4, bits), 1 / bits))
    for k in range(4):
        for wrong in range(bits):
            margins = 3 * code[k].copy()
            margins[wrong] *= -1
            assert model.decode(margins[None])[0][0] == k


def test_held_out_accuracy(spark, docs):
    got = langid.digest_query(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95


def test_margins_of_a_batch_are_those_of_each_text():
    rng = np.random.default_rng(3)
    model = langid.LanguageModel(["a", "b"], langid.codewords(2), rng.normal(size=(langid.BUCKETS, 1)).astype(np.float32), np.zeros(1), np.ones((2, 1)))
    texts = [b"ab", b"the cat", "été à".encode(), b"x" * 300, b"a"]
    together = model.margins(texts)
    assert np.allclose(together, np.concatenate([model.margins([t]) for t in texts]), atol=1e-5)


def plain_language(model, text):
    """The prediction by the definition, one n-gram at a time."""
    import math
    import re

    letters = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    raw = (" " + " ".join(re.findall(r"[a-z\u0080-\U0010ffff]+", letters)) + " ").encode()
    total, count = np.zeros(len(model.bias)), 0
    for n in langid.ORDERS:
        for a in range(len(raw) - n + 1):
            code = n
            for byte in raw[a : a + n]:
                code = (code << 8 | byte) % 2**32
            total += model.weights[(code * 2654435761 % 2**32) >> 17]
            count += 1
    margins = total / max(1, count) + model.bias
    loss = [
        len(margins) * sum(t * math.log1p(math.exp(-c * m)) for t, c, m in zip(trust, code, margins, strict=True))
        for trust, code in zip(model.trust, model.code, strict=True)
    ]
    share = np.exp(min(loss) - np.array(loss))
    return model.languages[int(share.argmax())], float(share.max() / share.sum())


def test_predictions_match_a_plain_program(spark, docs):
    model = langid.train(docs)
    texts = {r.doc_id: r.text for r in docs.collect() if any(map(str.isalpha, r.text or "")) and len(r.text) < 4000}
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for i in sorted(texts)[::3]:
        lang, score = plain_language(model, texts[i])
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-4


def test_long_texts_are_looked_at_in_slices(monkeypatch):
    rng = np.random.default_rng(4)
    model = langid.LanguageModel(["a", "b"], langid.codewords(2), rng.normal(size=(langid.BUCKETS, 1)).astype(np.float32), np.zeros(1), np.ones((2, 1)))
    texts = [b"the quick brown fox " * 40, "été à la mer, ".encode() * 30, b"a", b"x" * 333, b"-" * 500]
    whole = model.margins(texts)
    for size in (7, 64, 256):
        monkeypatch.setattr(langid, "SLICE", size)
        assert np.allclose(model.margins(texts), whole, atol=1e-5)
        at, share = langid.features(texts[0])
        assert np.isclose(share.sum(), 1, atol=1e-5)


def test_memory_of_very_long_texts():
    import tracemalloc

    model = langid.LanguageModel(["a", "b"], langid.codewords(2), np.ones((langid.BUCKETS, 7), np.float32), np.zeros(7), np.ones((2, 7)) / 7)
    text = b"some Words, here " * 1_000_000
    tracemalloc.start()
    model.margins([text])
    assert tracemalloc.get_traced_memory()[1] < 5 * len(text)
    tracemalloc.stop()


def test_language_edges(spark):
    rows = [(0, None, "en"), (1, "", "en"), (2, "12 !?", None), (3, "the cat", "en"), (4, "le chat", "fr"), (4, "le chat", "fr"), (None, "漢字", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.digest_query(docs).collect()
    assert len(got) == 7
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (0, 1, 2))
    assert by[None].lang_pred != "und"
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.digest_query(empty).count() == 0
    unlabelled = docs.where("lang IS NULL")
    assert {r.lang_pred for r in langid.digest_query(unlabelled).collect()} == {"und"}
    kept = langid.drop_unidentified(docs)
    assert kept.columns == docs.columns and Counter(r.text for r in kept.collect()) == {"the cat": 1, "le chat": 2, "漢字": 1}


def test_rows_stay_when_no_language_is_learned(spark):
    rows = [(1, "some words", None), (2, "12 34", None), (3, None, None), (None, "word", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, langid.drop_unidentified(docs).collect()), key=repr) == [rows[0], rows[3]]


# --- HTML ------------------------------------------------------------------------------------------------------------


def test_tree_fits_its_table():
    tree = html_text.article_tree()
    assert all(tree.predict(r[:-1]) == r[-1] for r in html_text.LABELLED)
    assert 60 < len(html_text.LABELLED) < 200


def test_neighbours_tell_where_nothing_else_does(spark, sf_dir):
    """Blocks of pages whose containers are ignored: the tree against one that looks at a block alone."""
    own = html_text.DecisionTree([(*r[:2], *r[6:9]) for r in html_text.LABELLED], [r[-1] for r in html_text.LABELLED])
    tree, n, by_tree, by_own = html_text.article_tree(), 0, 0, 0
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        blocks = html_text.text_blocks(r.html)
        for b, f in zip(blocks, html_text.block_features(blocks), strict=True):
            n += 1
            by_tree += tree.predict((*f[:6], 0.0, 0.0, f[8])) == int(b.article and not b.enclosed)
            by_own += own.predict((*f[:2], 0.0, 0.0, f[8])) == int(b.article and not b.enclosed)
    assert by_tree / n > 0.9 and by_tree > by_own + 0.05 * n


PAGES = [
    (
        '<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav>'
        '<div class="cookie-notice">We use cookies to improve your experience on our website.</div><article><h1>Head &amp; line</h1>'
        '<p>One <b>wor</b>d &eacute;\n two&nbsp;x<br>y</p><div class="ad">Buy now, best price, only today and only here for you</div>'
        '<p>Te.</p><p>Last <a href="a>b">link</a></article><aside>About the author and a long text about many things</aside>'
        '<section id="comments"><p>Great post, I really like this article a lot, thank you</p></section><footer>&copy; x</footer></body></html>',
        "Head & line One word é two x y Te. Last link",
    ),
    ('<script>var t="</p>";</script><article><p>a<p>b<!-- c --><p>d &am', "a b d &am"),
    ("<main><p>kept</p><form><p>Sign up to our newsletter now</p></form></main>", "kept"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    ("<article><p>x<p class=ad>buy now<p>y", "x y"),
    (None, ""),
    ("", ""),
    ("<", ""),
    ("<script>x", ""),
    ("<article>" + "<b>" * 3000 + "deep" + "</b>" * 3000 + "</article>", "deep"),
]


@pytest.mark.parametrize("html, want", PAGES)
def test_main_text(html, want):
    assert html_text.main_text(html) == want


def plain_blocks(html):
    """Blocks of a page by the standard library's parser: (text, words, words in links, enclosed, in article, in heading)."""
    from html.parser import HTMLParser

    blocks, stack, parts = [], [], []

    def close():
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            linked = len(" ".join(t for t, a in parts if a).split())
            words = len(text.split(" "))
            flags = [any(f[k] for _, f in stack) for k in range(3)]
            blocks.append((text, words, min(1.0, linked / words), *flags))
        parts.clear()

    class Reader(HTMLParser):
        skipped = 0

        def handle_starttag(self, name, attrs):
            if name in html_text.SKIPPED:
                self.skipped += 1
                return
            if name not in html_text.INLINE:
                close()
            if name == "br":
                parts.append((" ", False))
            if name in html_text.VOID:
                return
            if name not in html_text.INLINE:
                while stack and (stack[-1][0] == "p" or stack[-1][0] == name and name in html_text.CLOSED_BY_SIBLING):
                    stack.pop()
            names = {w for k, v in attrs if k in ("class", "id") for w in html_text.NAME.findall((v or "").lower())}
            inside = any(f[1] for _, f in stack)
            named = name not in ("html", "body", "article", "main") and bool(names & html_text.BOILERPLATE_NAMES)
            bad = name in html_text.BOILERPLATE or name == "header" and not inside or named
            stack.append((name, (bad, name in html_text.ARTICLE, name in html_text.HEADINGS)))

        def handle_endtag(self, name):
            if name in html_text.SKIPPED:
                self.skipped -= 1
                return
            if name not in html_text.INLINE:
                close()
            if name in [n for n, _ in stack]:
                while stack.pop()[0] != name:
                    pass

        def handle_data(self, data):
            if not self.skipped:
                parts.append((data, any(n == "a" for n, _ in stack)))

    reader = Reader(convert_charrefs=True)
    reader.feed(html)
    reader.close()
    close()
    return blocks


def random_page(rng):
    """Well-formed markup without attributes that hide."""
    words = ["one", "two", "été", "a &amp; b", "&lt;x&gt;", "more  words\nhere", "漢字"]

    def inside(depth):
        out = []
        for _ in range(rng.randint(0, 5)):
            name = rng.choice("p div span b a ul li h2 article section nav aside footer header em table td script".split())
            kind = rng.choice(["", "", "", ' class="ad x"', ' id="main-text"', " class='comments'", ' title="a > b"'])
            if name == "script":
                out.append("<script>var a = '<p>';</script>")
            elif depth and rng.random() < 0.6:
                out.append(f"<{name}{kind}>{inside(depth - 1)}</{name}>")
            else:
                out.append(rng.choice(["", " "]) + " ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) + rng.choice(["", "<br>", "<!-- x -->", "<hr>"]))
        return "".join(out)

    return f"<html><body>{inside(4)}</body></html>"


def test_blocks_match_the_parser_of_the_standard_library(spark, sf_dir):
    rng = random.Random(11)
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()] + [random_page(rng) for _ in range(400)]
    for html in pages:
        got = [(b.text, b.words, b.links, b.enclosed, b.article, b.heading) for b in html_text.text_blocks(html)]
        assert got == plain_blocks(html), html


@pytest.mark.parametrize(
    "html",
    ["<b>" * 60_000 + "x" + "</i>" * 60_000, "<svg>" * 100_000, "<a" * 100_000, "<p " * 100_000, '<a "' * 100_000, "<p>" * 100_000, "<script>" * 9 + "</" * 100_000, "&" * 200_000],
)
def test_bad_markup_costs_its_length(html):
    import time

    began = time.perf_counter()
    html_text.main_text(html)
    assert time.perf_counter() - began < 20


def test_unmarked_pages_go_by_words_and_links():
    body = " ".join(["word"] * 40)
    html = f"<div><a href=a>Home</a> <a href=b>News</a></div><h1>Title of it</h1><div>{body}</div><div>{body}</div><div><a href=c>More</a></div>"
    assert html_text.main_text(html) == f"Title of it {body} {body}"


def test_extract(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = html_text.extract(pages).collect()
    assert len(got) == pages.count() and all(r.n_chars == len(r.text) > 0 for r in got)
    rows = [(i, None, h, "k") for i, (h, _) in enumerate(PAGES)] + [(None, "u", "<article>z</article>", "k")] * 2
    edges = spark.createDataFrame(rows, "page_id long, url string, html string, key string")
    found = [(r.page_id, r.text) for r in html_text.extract(edges).collect()]
    assert found == [(i, w) for i, (_, w) in enumerate(PAGES)] + [(None, "z")] * 2
    assert html_text.extract(edges.limit(0)).count() == 0


# --- Jaccard join ----------------------------------------------------------------------------------------------------


def plain_sets(texts, k):
    out = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[a : a + k]) for a in range(max(1, len(w) - k + 1))) if w else frozenset()
    return out


def plain_components(sets, percent):
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(i for i in sets if sets[i]), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def near_copies(n, seed=2, words=60, edits=4):
    """Texts of very different sizes and variants of them with up to ``edits`` changed words."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = []
    while len(texts) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, words))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy += [rng.choice(vocabulary) for _ in range(rng.randint(1, 3))]
            texts.append(" ".join(copy))
    return dict(enumerate(texts[:n]))


@pytest.mark.parametrize("k, percent, block_rows", [(3, 90, 2048), (3, 90, 4), (5, 80, 2048), (1, 80, 8)])
def test_components_match_all_pairs(spark, k, percent, block_rows):
    texts = near_copies(260) | {900: None, 901: "", 902: " \t\n", 903: "one", 904: "One", 905: "one two", 906: "é É"}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, n int").repartition(3)
    got = jaccard_join.similarity_classes(df, k=k, percent=percent, block_rows=block_rows).collect()
    sets = plain_sets(texts, k)
    want = plain_components(sets, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in texts}


def test_long_texts_and_chains(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(5000)}" for _ in range(6000)]
    texts = {0: " ".join(words)}
    for i in range(1, 6):  # each differs from the one before by little, from the first by more
        words = list(words)
        for _ in range(50):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    got = {r.doc_id: r.component_id for r in jaccard_join.similarity_classes(spark.createDataFrame(list(texts.items()), DOCS), k=3, percent=90).collect()}
    assert got == plain_components(plain_sets(texts, 3), 90)


def test_classes_match_sql(spark, docs, same_rows):
    same_rows(jaccard_join.similarity_classes(docs, k=3, percent=90), jaccard_join.ORACLE)


def test_jaccard_edges(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "zz"), (7, "A B C")]
    got = Counter((r.doc_id, r.component_id) for r in jaccard_join.similarity_classes(spark.createDataFrame(rows, DOCS)).collect())
    assert got == {(1, 1): 2, (None, 1): 1, (None, None): 1, (7, 1): 1}
    assert jaccard_join.similarity_classes(spark.createDataFrame([], DOCS)).count() == 0


def test_linked_sets_share_a_fingerprint():
    rng = np.random.default_rng(0)
    for percent in (80, 90):
        for _ in range(400):
            n = int(rng.integers(9, 400))
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            b = a[rng.random(len(a)) > rng.random() * (1 - percent / 100)]
            b = np.unique(np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, 3)), dtype=np.uint64)]))
            if len(b) and not np.array_equal(a, b) and jaccard_join.linked(a, b, percent):
                both = set(jaccard_join.group_fingerprints(a, percent).tolist()) & set(jaccard_join.group_fingerprints(b, percent).tolist())
                assert both


def test_tree_search_loses_nothing():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    sets = [base[rng.random(len(base)) > rng.random() * 0.3] for _ in range(150)]
    points, sizes = jaccard_join.count_vectors(sets, 64), np.array([len(s) for s in sets])
    tree = jaccard_join.CountVectorRTree(points, sizes)
    for i in range(len(sets)):
        near = set(tree.search(points[i], int(sizes[i]), 90).tolist())
        assert near >= {j for j in range(len(sets)) if jaccard_join.linked(sets[i], sets[j], 90)}


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 102), (101, 102), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}


def test_without_ids(spark):
    docs = spark.createDataFrame([(i, f"t{i}", 0) for i in range(50)] + [(None, "n", 0), (3, "again", 0)], "doc_id long, text string, _gone int")
    kept = common.without_ids(docs, spark.createDataFrame([(3,), (common.BITMAP_BITS + 4,), (None,)], "id long"), "doc_id")
    assert kept.columns == docs.columns and kept.count() == 50 and kept.where("doc_id = 4").count() == 1


# --- top-k search ----------------------------------------------------------------------------------------------------


def plain_topk(rows, k=5):
    whole = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows}
    out = {}
    for q in whole:
        if q % 50 == 0:
            found = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def as_dict(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return dict(out)


def test_search_matches_sql(spark, sf_dir, same_rows):
    same_rows(topk_search.search_query(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), topk_search.ORACLE)


@pytest.mark.parametrize("kind", ["normal", "ties", "sparse", "huge"])
def test_search_is_exact(spark, kind):
    rng = np.random.default_rng(4)
    made = {
        "normal": rng.normal(size=(400, 8)),
        "ties": rng.integers(-1, 2, size=(400, 3)) / 4,
        "sparse": np.where(rng.random((400, 6)) < 0.8, 0, rng.normal(size=(400, 6))),
        "huge": rng.normal(size=(200, 4)) * 1e5,
    }[kind]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(made)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2)
    found = topk_search.search(df, F.col("vec_id") % 50 == 0, block_rows=64, query_bytes=100)
    assert as_dict(found) == as_dict(topk_search.search_query(df)) == plain_topk(rows)


def test_reading_stops_early_on_skewed_vectors():
    rng = np.random.default_rng(7)
    n, d = 2000, 32
    vectors = np.floor(256 * rng.normal(size=(n, d)) * 0.75 ** np.arange(d))  # a few components carry the scores
    ids = np.arange(n)
    block = topk_search.SortedBlock(ids, vectors)
    queries = range(0, n, 50)
    bounds = topk_search.first_bounds([int(i) for i in queries], [vectors[i].astype(np.int64) for i in queries], 5)
    early = 0
    for q, bound in zip(queries, bounds, strict=True):
        before = block.read
        found = block.best(q, vectors[q], 5, int(bound))
        early += block.read - before < n * d
        score = vectors @ vectors[q]
        want = sorted((-int(score[i]), i) for i in ids if i != q)[:5]
        assert sorted((-s, i) for s, i in found) == want
    assert early >= 0.9 * len(queries) and block.read < 0.6 * n * d * len(queries)
    assert block.resolved < 0.05 * n * len(queries)


def test_a_query_id_in_several_rows_is_searched_once(spark, duck):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [2.0, 1.0]), (2, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = [(0, 1, 1, 3 * 65536), (0, 2, 2, 3 * 65536), (0, 3, 1, 2 * 65536)]
    assert sorted(map(tuple, topk_search.search_query(df).collect())) == want
    duck.register("repeated", df.toArrow())
    found = duck.execute(topk_search.ORACLE.replace("FROM embeddings", "FROM repeated")).fetchall()
    assert sorted(found) == want


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, None), (3, [1.0, None]), (50, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [1.0]), (None, [1.0, 1.0]), (100, [3.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    assert as_dict(topk_search.search_query(df)) == {0: [(1, 256 * 256 * 3)], 100: [(6, 256 * 256 * 3)]}
    assert topk_search.search_query(df.limit(0)).count() == 0


# --- pipeline --------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as pipeline

    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "personal_data", "packing"]
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    filler = " ".join(f"word{i}" for i in range(80))
    rows = [
        (1, "12345 !!", "en"),
        (2, None, "en"),
        (3, filler, "en"),
        (4, filler + " more", "en"),
        (5, f"clean start of a text {passage}", "en"),
        (6, "write to a@b.c or call +1 (555) 123-4567 soon", "en"),
        (7, "a clean little text", "en"),
    ]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    seen = []
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append(sorted(r.doc_id for r in docs.collect()))
    assert seen == [[3, 4, 5, 6, 7], [3, 5, 6, 7], [3, 6, 7], [3, 6, 7]]
    masked = docs.where("doc_id = 6").first()
    assert masked.text == "write to <EMAIL> or call <PHONE> soon" and masked.n_chars == len(masked.text)
    packed = pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == {3, 6, 7}


def test_pipeline_against_brute_force(spark, sf_dir):
    import corpus_pipeline as pipeline

    from .test_text_operators import plain_overlap

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if any(map(str.isalpha, r.text or ""))}
    roots = plain_components(plain_sets(texts, 5), 80)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {i for i in texts if roots[i] == i and plain_overlap(texts[i], items)[1] == 0}
    rows = pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == kept
    by = defaultdict(int)
    for r in rows:
        by[r.doc_id] += r.length
    assert all(by[r.doc_id] == r.doc_tokens for r in rows)


def test_pipeline_on_an_empty_table(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


@pytest.mark.parametrize("block_rows", [512, 2])
def test_meetings_do_not_depend_on_batches(block_rows):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    for _ in range(300):
        rows = sorted(
            (int(m), int(s), int(v) if s >= 0 else 0)
            for m, s, v in zip(rng.integers(0, 6, 25), rng.choice([-1, 0, 0, 0, 0, 0, 0, 1, 2], 25), rng.integers(0, 5, 25), strict=True)
        )
        cuts = [0, *sorted(rng.integers(0, 26, 4).tolist()), 25]
        batches = [
            pa.record_batch([pa.array([r[c] for r in rows[a:b]], pa.int64()) for c in range(3)], names=["mark", "salt", "low"])
            for a, b in zip(cuts, cuts[1:], strict=False)
        ]
        buckets, blocks = defaultdict(set), defaultdict(set)
        for out in jaccard_join._meet_kernel(block_rows)(iter(batches)):
            for name, block, low in zip(*(out.column(c).to_pylist() for c in range(3)), strict=True):
                buckets[name].add(low)
                blocks[name, block].add(low)
        noticed = {m for m, s, _ in rows if s < 0}
        want = defaultdict(set)
        for m, s, low in rows:
            if s >= 0:
                # rows of a mark that nobody gave notice of stand alone if they are unsalted
                want[m, s if m not in noticed and s == 0 else 1].add(low)
        salted = {m for m, s, _ in rows if s > 0}
        for (m, kind), lows in want.items():
            if kind == 1:
                assert lows <= buckets[m], "all rows of a noticed mark and all salted ones are in the mark's bucket"
            elif len(lows) > 1:
                assert any(lows <= got for got in buckets.values())
        allowed = [frozenset(v) for (m, kind), v in want.items() if len(v) > 1 or kind == 1]
        allowed += [frozenset(want[m, 0] | want[m, 1]) for m in salted]
        assert {frozenset(v) for v in buckets.values()} <= set(allowed)
        assert all(len(v) <= block_rows for v in blocks.values())


@pytest.mark.parametrize("often", [512, 0])
def test_rows_that_share_an_id_stay_apart(spark, often):
    a = [f"a{i}" for i in range(40)]
    b = [f"b{i}" for i in range(40)]
    near = lambda words, i: " ".join([*words[:-1], f"z{i}"])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (3, near(a, 1)), (7, near(b, 2)), (None, near(b, 3)), (None, "alone here"), (9, "alone there"), (9, "alone there")]
    docs = spark.createDataFrame([(i, t, n, 0) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int, high int").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similarity_classes(docs, often=often).collect())
    assert got == {(5, 36, 3): 1, (3, 36, 3): 1, (5, 36, 5): 1, (7, 36, 5): 1, (None, 36, 5): 1, (None, 1, None): 1, (9, 1, 9): 2}
    kept = jaccard_join.drop_similar(docs, often=often)
    assert kept.columns == docs.columns
    found = sorted(r.n for r in kept.collect())
    assert found[:3] == [1, 2, 5] and found[3] in (6, 7) and len(found) == 4


def test_copies_without_an_id_and_repeated_rows_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (None, text), (None, text + " more"), (4, "x y"), (4, "x y"), (4, None), (4, None), (None, "")]
    docs = spark.createDataFrame(rows, DOCS)
    kept = sorted(map(tuple, jaccard_join.drop_similar(docs).collect()), key=repr)
    assert len(kept) == 5 and kept.count((4, None)) == 2 and (4, "x y") in kept and (None, "") in kept
    assert jaccard_join.drop_similar(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block_rows, often", [(512, 512), (64, 40)])
def test_one_bucket_of_many_near_copies(spark, block_rows, often):
    """Near copies of one text that all meet in the same buckets, some of which only a chain connects, and strangers."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(90)]
    texts = {}
    for i in range(1500 if block_rows == 64 else 5000):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"z{rng.randrange(20)}"
        texts[i] = " ".join(words)
    for i in range(40):  # share a long passage with the copies without being near
        texts[10_000 + i] = " ".join([*base[45:], *(f"s{i}_{j}" for j in range(45))])
    df = spark.createDataFrame(list(texts.items()), DOCS).repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard_join.similarity_classes(df, k=3, percent=90, block_rows=block_rows, often=often).collect()}
    assert got == plain_components_by_postings(plain_sets(texts, 3), 90)


def plain_components_by_postings(sets, percent):
    """All pairs of distinct sets, their overlaps by matrix products."""
    names = {s: n for n, s in enumerate(dict.fromkeys(s for s in sets.values() if s))}
    shingles = {x: n for n, x in enumerate({x for s in names for x in s})}
    rows = np.zeros((len(names), len(shingles)), np.float32)
    for s, n in names.items():
        rows[n, [shingles[x] for x in s]] = 1
    size = rows.sum(1)
    label = np.arange(len(names))
    for n in range(len(names)):
        both = rows[n + 1 :] @ rows[n]
        for m in n + 1 + np.flatnonzero(100 * both >= percent * (size[n] + size[n + 1 :] - both)):
            if label[m] != label[n]:
                label[label == label[m]] = label[n]
    least = {}
    for i in sorted(sets):
        if sets[i]:
            least.setdefault(int(label[names[sets[i]]]), i)
    return {i: least[int(label[names[s]])] if s else i for i, s in sets.items()}


def test_bucket_edges_connect_all_links():
    rng = np.random.default_rng(6)
    for percent in (80, 90):
        base = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (30, 400, 520, 600, 9000, 40_000)]
        sets = [b[rng.random(len(b)) > rng.random() * 0.25] for b in base for _ in range(12)]
        edges = jaccard_join.bucket_edges([len(s) for s in sets], [jaccard_join.packed_point(s) for s in sets], percent)
        label = list(range(len(sets)))
        for a, b in edges:
            label = [label[a] if x == label[b] else x for x in label]
        for i, j in combinations(range(len(sets)), 2):
            assert label[i] == label[j] or not jaccard_join.linked(sets[i], sets[j], percent)
        assert len(edges) < len(sets)


@pytest.mark.parametrize("held", [0, 30, 1 << 20])
def test_small_link_tables_are_contracted_in_one_task(spark, held):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7), (None, 3)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5), held=held)
    if held > len(edges):
        assert found.rdd.getNumPartitions() == 1
    assert {r.node: r.root for r in found.collect()} == components.contract([(a, b) for a, b in edges if a is not None and a != b])


@pytest.mark.parametrize("often", [512, 1])
def test_marks_travel_in_few_bytes_and_come_back(often):
    import pyarrow as pa

    texts, percent, bits = [t for t in near_copies(60).values() if t], 80, 10
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    blobs = [r for out in jaccard_join._mark_kernel(3, percent, often, bits)(iter([batch])) for r in out.to_pylist()]
    blobs.sort(key=lambda r: r["part"])
    want = set()
    for t in texts:
        s = jaccard_join.shingle_set(t.encode(), 3, jaccard_join.WordHashes())
        low = jaccard_join.digest(s)[1] % (1 << 32)
        want |= {(int(m) >> (32 - bits), low) for m in jaccard_join.group_fingerprints(s, percent)}
    back = pa.record_batch([pa.array([r[c] for r in blobs]) for c in ("part", "salted", "rows")], names=["part", "salted", "rows"])
    rows = [tuple(r.values()) for out in jaccard_join._unpacked_marks(iter([back])) for r in out.to_pylist()]
    assert {(mark, low) for mark, salt, low in rows if salt >= 0} == want
    assert rows == sorted(rows) or often == 1
    noticed = {mark for mark, salt, _ in rows if salt < 0}
    assert noticed == {mark for mark, salt, _ in rows if salt > 0} and bool(noticed) == (often == 1)
    if often > 1:
        assert sum(len(r["rows"]) for r in blobs) == 8 * len(rows)


def test_a_group_of_near_copies_makes_edges_as_its_size(spark, monkeypatch):
    rng, made = random.Random(8), []
    base = [f"w{i}" for i in range(150)]
    texts = [(i, " ".join([f"z{rng.randrange(99)}" if rng.random() < 0.01 else w for w in base])) for i in range(400)]
    plain = jaccard_join._edges
    monkeypatch.setattr(jaccard_join, "_edges", lambda units, compare: made.append(plain(units, compare)) or made[-1])
    monkeypatch.setattr(jaccard_join, "cut", lambda df: common.cut(df.repartition(64)) if "bucket" in df.columns else common.cut(df))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        sets = jaccard_join.similarity_classes(spark.createDataFrame(texts, DOCS), k=5, percent=80).select("component_id").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sum(e.count() for e in made) < 8 * len(texts) and sets < 400


def test_every_entry_read_is_summed_once(monkeypatch):
    rng = np.random.default_rng(12)
    vectors = np.floor(256 * rng.normal(size=(1001, 16)))
    ids, summed = np.arange(1001), []
    plain = topk_search.SortedBlock._sums
    monkeypatch.setattr(topk_search.SortedBlock, "_sums", lambda self, at, x: summed.append(int((at < 1001).sum())) or plain(self, at, x))
    block = topk_search.SortedBlock(ids, vectors)
    queries = list(range(0, 1001, 50))
    bounds = topk_search.first_bounds(queries, [vectors[q].astype(np.int64) for q in queries], 5)
    for q, reached in zip(queries, bounds.tolist(), strict=True):
        score = (vectors @ vectors[q]).astype(int)
        score[q] = topk_search.LEAST
        want = [(int(score[i]), int(i)) for i in np.lexsort((ids, -score))[:5]]
        assert [x for x in block.best(q, vectors[q], 5, reached) if x[0] >= reached] == want
    assert sum(summed) == block.read > 0


@pytest.mark.parametrize("scale", [32, 2**15, 2**24])  # sums in float32, float64 and int64
def test_many_queries_are_read_together(monkeypatch, scale):
    rng = np.random.default_rng(21)
    n, d = 3001, 24
    vectors = np.floor(scale * rng.normal(size=(n, d))).astype(np.int64)
    vectors[:, 3] = vectors[100] = 0
    ids = rng.permutation(n)
    at = np.flatnonzero(ids % 5 == 0)
    queries = [int(i) for i in ids[at]], [vectors[i] for i in at]
    shared = types.SimpleNamespace(value=(*queries, topk_search.first_bounds(*queries, 5)))
    calls = Counter()
    for name in ("_sums", "_unread_sums"):

        def counted(*args, name=name, plain=getattr(topk_search.SortedBlock, name)):
            calls[name] += 1
            return plain(*args)

        monkeypatch.setattr(topk_search.SortedBlock, name, counted)
    batch = pa.record_batch([pa.array(ids, pa.int64()), pa.array(vectors.tolist(), pa.list_(pa.int64()))], names=["vec_id", "v"])
    (out,) = topk_search._kernel(shared, 5, 2000)(iter([batch.slice(0, 7), batch.slice(7)]))
    found = defaultdict(list)
    for query_id, vec_id, score in zip(*(c.to_pylist() for c in out.columns), strict=True):
        found[query_id].append((-score, vec_id))
    for i in at:
        score = vectors @ vectors[i]
        first = [j for j in np.lexsort((ids, -score))[:6] if j != i][:5]
        assert sorted(found[ids[i]]) == [(-int(score[j]), int(ids[j])) for j in first]
    # two blocks; one sum of the entries for many queries, and further bounds for few of them only
    assert calls["_sums"] < 0.5 * len(at) and calls["_unread_sums"] < len(at)
