"""Token counts, decontamination, packing, licenses and personal data against plain versions and edge cases."""

import hashlib
import random
import re
import textwrap
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from orbiscope.llm import decontaminate, licenses, packing, pii, token_counts

DOCS = "doc_id long, text string"
LONG = "lorem ipsum " * 20_000
EDGES = [None, "", "   \n\t ", "a", "ß É 😀 漢字  x", LONG, "x" * 200_000, "a", "12 34"]


def edge_docs(spark):
    """Edge texts, a repeated row, a null id and columns whose names the operators use inside."""
    rows = [(i, t, i, "k", [1]) for i, t in enumerate(EDGES)] + [(3, "a", 3, "k", [1]), (None, "b c", 0, "k", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n long, key string, items array<int>")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


# --- token counts ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def plain_count(word, vocabulary):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found = []
        for n in range(1, min(end, vocabulary.longest) + 1):
            s = vocabulary.scores.get(word[end - n : end])
            if s is not None:
                found.append((best[end - n][0] + s, best[end - n][1] - 1))
            elif n == 1:
                size = len(word[end - 1].encode())
                found.append((best[end - 1][0] + size * token_counts.BYTE_SCORE, best[end - 1][1] - size))
        best.append(max(found))
    return -best[-1][1]


def test_counts_match_a_plain_program(spark, docs, texts, vocabulary):
    counter = token_counts.TokenCounter(vocabulary)
    got = {r.doc_id: (r.n_tokens, r.n_pretokens) for r in token_counts.count_query(docs).collect()}
    assert set(got) == set(texts)
    for i in random.Random(0).sample(sorted(texts), 25):
        words = counter.pretokens(texts[i])
        assert got[i] == (sum(plain_count(w, vocabulary) for w in words), len(words))


def test_counts_on_edges(spark):
    got = token_counts.count_query(edge_docs(spark)).collect()
    assert len(got) == len(EDGES) + 2
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_tokens, r.n_pretokens))
    assert by[0] == by[1] == [(0, 0)] and by[3] == [by[3][0]] * 2
    assert by[6][0][1] == -(-200_001 // token_counts.TokenCounter.LONGEST)
    assert token_counts.count_query(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("blank", ["\n", "\t", ""])
def test_long_words_are_scored_whole(texts, vocabulary, blank):
    counter = token_counts.TokenCounter(vocabulary)
    for i in random.Random(1).sample(sorted(i for i, t in texts.items() if t), 12):
        text = texts[i].replace(" ", blank)
        assert counter([text, "a b " + text + " c"]) == [
            (sum(plain_count(w, vocabulary) for w in words), sum(-(-len(w) // counter.LONGEST) for w in words))
            for words in (counter.pretokens(text), counter.pretokens("a b " + text + " c"))
        ]
        assert counter.pretokens(text) == [token_counts.BLANK + text]


def test_trie_shares_prefixes_and_survives_a_full_cache(vocabulary, monkeypatch):
    monkeypatch.setattr(token_counts.TokenCounter, "BOUND", 8)
    counter = token_counts.TokenCounter(vocabulary)
    words = ["in", "ing", "ings", "inga", "x", "xy", "in", "thing", "things", "thin", "the", "then"]
    for w in words:
        assert counter([w])[0][0] == plain_count(token_counts.BLANK + w, vocabulary)


# --- decontamination -------------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_overlap(text, items, window=10):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, body in items:
        w = WORD.findall(lower(body))
        for a in range(max(1, len(w) - window + 1)):
            part = w[a : a + window]
            for p in range(len(words) - len(part) + 1) if part else ():
                if words[p : p + len(part)] == part:
                    hit |= set(range(p, p + len(part)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


def test_overlap_matches_sql(spark, sf_dir, docs, same_rows):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    same_rows(decontaminate.digest_query(docs, items), decontaminate.ORACLE)


@pytest.mark.parametrize("block_words", [1_000_000, 12])
def test_overlap_of_crafted_texts(spark, block_words):
    base = [f"w{i}" for i in range(14)]
    items = [
        (1, " ".join(base)),
        (2, "Short ITEM"),
        (3, ""),
        (4, None),
        (5, " ".join(base[:10])),
        (5, " ".join(base[:10])),
        (6, "the the the the the the the the the the the"),
        (None, "no id here"),
        (7, "solo"),
    ]
    texts = [
        " ".join(base[:9]),
        "x " + " ".join(base) + " y",
        "W0-w1_w2 " + ", ".join(base[3:]),
        "a short item, a SHORT-item",
        "the " * 30,
        None,
        "",
        "... !!!",
        "été " + " ".join(base[2:13]) + " été solo",
        "a short item, a SHORT-item",
    ]
    got = decontaminate.find_overlap(
        spark.createDataFrame(list(enumerate(texts)), DOCS),
        spark.createDataFrame(items, "item_id long, text string"),
        block_words=block_words,
    ).collect()
    assert len(got) == len(texts)
    known = [(i, t) for i, t in items if i is not None]
    for r in got:
        n, hit, found = plain_overlap(texts[r.key], known)
        assert (r.n_words, r.n_hit, r.items) == (n, hit, found), r.key
        assert sum(r.lengths) == hit


def test_overlap_on_edges(spark):
    items = spark.createDataFrame([(1, "ipsum lorem ipsum")], "item_id long, text string")
    got = decontaminate.digest_query(edge_docs(spark), items).collect()
    assert len(got) == len(EDGES) + 2
    by = {r.doc_id: r for r in got}
    assert by[5].contaminated and by[5].n_hit == 39_999 and not by[0].contaminated and by[0].n_words == 0
    assert by[0].items_sha256 == hashlib.sha256(b"").hexdigest()
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest_query(edge_docs(spark), none).where("contaminated").count() == 0
    assert decontaminate.digest_query(spark.createDataFrame([], DOCS), items).count() == 0


@pytest.mark.parametrize("block_words", [1_000_000, 3])
def test_rows_that_share_an_id_stay_apart(spark, block_words):
    items = [(1, "ipsum lorem ipsum"), (2, "b c"), (3, "no such words"), (4, "z z")]
    texts = [(1, "b c"), (1, "x y"), (1, "b c z z"), (None, "b c"), (None, "x"), (None, None), (2, "z z z"), (2, "z z z")]
    got = decontaminate.find_overlap(
        spark.createDataFrame(texts, DOCS), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words
    )
    want = [(i, *plain_overlap(t, items)) for i, t in texts]
    assert sorted(map(repr, want)) == sorted(repr((r.key, r.n_words, r.n_hit, r.items)) for r in got.collect())
    edges = decontaminate.digest_query(edge_docs(spark), spark.createDataFrame(items[:2], "item_id long, text string"))
    blocks = decontaminate.find_overlap(
        edge_docs(spark), spark.createDataFrame(items[:2], "item_id long, text string"), block_words=block_words
    )
    assert sorted(repr((r.doc_id, r.n_words, r.n_hit)) for r in edges.collect()) == sorted(
        repr((r.key, r.n_words, r.n_hit)) for r in blocks.collect()
    )


def test_item_ids_of_any_type_and_items_beyond_a_block(spark):
    long = " ".join(f"w{i}" for i in range(60))
    items = [("b", long), ("a", "b c"), ("c", "w30 w31")]
    texts = [long, "x " + " ".join(f"w{i}" for i in range(20, 41)) + " y b c", "w30 w31", None]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    table = spark.createDataFrame(items, "item_id string, text string")
    for block_words in (1_000_000, 25, 12):
        got = decontaminate.find_overlap(docs, table, block_words=block_words).collect()
        assert sorted((r.key, r.n_words, r.n_hit, r.items) for r in got) == [(i, *plain_overlap(t, items)) for i, t in enumerate(texts)]
        assert decontaminate.digest_query(docs, table).where("n_items > 0").count() == 3
        assert [r.text for r in decontaminate.drop_contaminated(docs, table, block_words=block_words).collect()] == [None]


@pytest.mark.parametrize("block_words", [1_000_000, 3])
def test_dropping_keeps_clean_rows_whole(spark, block_words):
    items = spark.createDataFrame([(1, "ipsum lorem ipsum"), (2, "b c")], "item_id long, text string")
    docs = edge_docs(spark).where("doc_id IS NOT NULL")
    kept = decontaminate.drop_contaminated(docs, items, block_words=block_words)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 3, 4, 6, 7, 8]


@pytest.mark.parametrize("block_words", [1_000_000, 3])
def test_dropping_goes_by_row(spark, block_words):
    items = [(1, "ipsum lorem ipsum"), (2, "b c"), (3, "z z")]
    texts = [(1, "b c"), (1, "x y"), (1, "b c z z"), (None, "b c"), (None, "x"), (None, None), (2, "z z z"), (2, "z")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(texts)], "doc_id long, text string, n int")
    kept = decontaminate.drop_contaminated(
        docs, spark.createDataFrame(items, "item_id long, text string"), block_words=block_words
    )
    assert kept.columns == docs.columns
    assert sorted(r.n for r in kept.collect()) == [1, 4, 5, 7]


# --- packing ---------------------------------------------------------------------------------------------------------


def check_pieces(rows, want, capacity=1024):
    """``want``: list of (doc_id, ids)."""
    taken = defaultdict(list)
    for r in rows:
        taken[r.doc_id].append(r)
    for doc, ids in want:
        pieces = sorted(taken.pop(doc), key=lambda r: r.start)
        at = 0
        for p in pieces:
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].astype("<u4").tobytes())
            at += p.length
        assert at == len(ids)
    assert not taken
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], np.uint32)


def test_packing_round_trip(docs, texts, tokenizer):
    rows = packing.pack_query(docs).collect()
    assert check_pieces(rows, [(i, ids_of(tokenizer, t)) for i, t in texts.items()]) == 0


def test_packing_edges(spark, tokenizer):
    unique = [(i, t) for i, t in enumerate([*EDGES, "<|endoftext|> a", " " * 5000 + "x", "\n\t" * 300_000])]
    df = spark.createDataFrame([(i, t, 1) for i, t in unique], "doc_id long, text string, start int").repartition(1)
    assert check_pieces(packing.pack_query(df).collect(), [(i, ids_of(tokenizer, t)) for i, t in unique]) == 0
    assert packing.pack_query(spark.createDataFrame([], DOCS)).count() == 0


def test_small_pools_leave_nothing(spark, tokenizer, texts):
    rows = [(i, t) for i, t in texts.items()]
    df = spark.createDataFrame(rows, DOCS).repartition(2)
    packed = packing.pack(df, public_tokenizers.path("byte_bpe_50k.json"), capacity=64, pool_tails=16).collect()
    assert check_pieces(packed, [(i, ids_of(tokenizer, t)) for i, t in rows], 64) == 0


def test_fill_window_is_closest():
    rng = random.Random(4)
    for _ in range(200):
        capacity = rng.randint(1, 40)
        counts = {rng.randint(1, 45): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        taken = packing.fill_window(counts, capacity)
        assert all(0 < c <= counts[n] for n, c in taken.items())
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        assert sum(n * c for n, c in taken.items()) == max(s for s in sums if s <= capacity)


@pytest.mark.parametrize("lengths", [[random.Random(5).randint(0, 100) for _ in range(300)], [60] * 200, [100] * 5, [99, 1, 98], []])
def test_pack_lengths_uses_each_token_once(lengths):
    windows = packing.pack_lengths(lengths, 100)
    taken = defaultdict(list)
    for w in windows:
        for i, start, n in w:
            assert n > 0
            taken[i].append((start, n))
    for i, n in enumerate(lengths):
        at = 0
        for start, part in sorted(taken[i]):
            assert start == at
            at += part
        assert at == n
    sizes = [sum(n for _, _, n in w) for w in windows]
    assert all(n == 100 for n in sizes[:-1]) and all(0 < n <= 100 for n in sizes)
    # one cut a window at most
    assert sum(len(parts) for parts in taken.values()) <= sum(n > 0 for n in lengths) + len(windows)


def test_windows_without_a_full_multiset_are_topped_up():
    packer = packing._Packer(0, 100, 4096)
    for key in range(200):
        packer.add(key, np.full(60, key, "<u4").tobytes())
    packer.flush(last=True)
    rows = packer.take()
    assert sum(r[2] for r in rows) == 200 * 60
    sequences, pieces = defaultdict(int), defaultdict(int)
    for key, _, n, _, _, sequence, _ in rows:
        sequences[sequence] += n
        pieces[key] += 1
    assert set(sequences.values()) == {100} and len(sequences) == 120
    assert sum(n > 1 for n in pieces.values()) <= 120 and max(pieces.values()) == 2


def test_ids_agree_with_the_tokenizer(tokenizer):
    encode = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 0)
    rng = random.Random(6)
    letters = " \t\n\r\x0b 　​'sdtll0123²Ⅷ१😀漢字é́\x00\x85_-*&"
    for _ in range(500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(tokenizer, text).tolist()


# --- licenses --------------------------------------------------------------------------------------------------------


def test_every_template_line_is_found():
    scanner = licenses.Templates(licenses.TEMPLATES)
    for name, lines in licenses.TEMPLATES.items():
        for line in lines:
            found = scanner.scan(f"Some words before.\n{line}\nand after".encode())
            assert [n.license for n in found] == [name], line
            assert found[0].missing == found[0].added == ()


def test_wording_differences_are_reported():
    scanner = licenses.Templates(licenses.TEMPLATES)
    text = "Licensed beneath the Apache License, Version 2.0."
    (notice,) = scanner.scan(text.encode())
    assert notice.license == "Apache-2.0" and notice.missing == ("under",) and notice.added == ("beneath",)
    assert text[notice.start : notice.end] == text[:-1]
    assert scanner.scan("my driving licence and a permission slip for the warranty".encode()) == []


def test_notices_inside_long_lines():
    scanner = licenses.Templates(licenses.TEMPLATES)
    filler = " ".join(f"wörd{i}" for i in range(500))
    text = f"{filler} Released under the MIT License. {filler}".encode()
    (notice,) = scanner.scan(text)
    assert notice.license == "MIT" and text[notice.start : notice.end] == b"Released under the MIT License"


@pytest.mark.parametrize("before, width", [("", 72), (" * ", 40), ("# ", 12)])
def test_wrapped_notices_are_found(before, width):
    scanner = licenses.Templates(licenses.TEMPLATES)
    for name, lines in licenses.TEMPLATES.items():
        for line in lines:
            wrapped = "\n".join(before + x for x in textwrap.wrap(line, width, break_long_words=False, break_on_hyphens=False))
            text = f"Some words before.\n\n{wrapped}\n\nand words after it".encode()
            (notice,) = scanner.scan(text)
            assert notice.license == name and notice.missing == notice.added == (), line
            assert WORD.findall(lower(text[notice.start : notice.end].decode()))[-1] == WORD.findall(lower(line))[-1]


def test_every_notice_of_a_line_is_found():
    scanner = licenses.Templates(licenses.TEMPLATES)

    def found(text):
        return [(n.license, text.encode()[n.start : n.end].decode()) for n in scanner.scan(text.encode())]

    both = "All rights reserved. Licensed under the MIT license."
    assert found(both) == [("Proprietary", "All rights reserved"), ("MIT", "Licensed under the MIT license")]
    assert [n for n, _ in found("Licensed under the ISC License. Or: Licensed under CC BY-SA 4.0. Or: Licensed under CC BY 4.0.")] == [
        "ISC",
        "CC-BY-SA-4.0",
        "CC-BY-4.0",
    ]
    assert found("Released under the MIT License. " * 50) == [("MIT", "Released under the MIT License")] * 50
    everything = [(name, line) for name, lines in licenses.TEMPLATES.items() for line in lines]
    assert [n for n, _ in found(" ".join(line for _, line in everything))] == [n for n, _ in everything]


def test_notice_among_words_of_other_licenses():
    scanner = licenses.Templates(licenses.TEMPLATES)
    words = " ".join(max(licenses.TEMPLATES[n], key=len) for n in ("MIT", "GPL-3.0", "Apache-2.0", "ISC", "BSD-3-Clause")).split()
    random.Random(0).shuffle(words)
    text = " ".join(words[:35]) + ". Licensed under CC BY-NC 4.0. " + " ".join(words[35:70])
    (notice,) = scanner.scan(text.encode())
    assert notice.license == "CC-BY-NC-4.0" and text[notice.start : notice.end] == "Licensed under CC BY-NC 4.0"


def test_given_templates_without_usual_words():
    line = "Feel free to reuse everything in here as long as our mascot is thanked"
    scanner = licenses.Templates({"Mascot": (line, "ok to go"), "MIT": licenses.TEMPLATES["MIT"]})
    text = f"Words. {line.replace('mascot', 'parrot')}! More words, ok to go. Released under the MIT License."
    assert [n.license for n in scanner.scan(text.encode())] == ["Mascot", "Mascot", "MIT"]
    assert scanner.scan(b"nothing of the kind here") == []


def test_license_query(spark, docs, texts):
    got = {r.doc_id: set(filter(None, r.licenses.split(","))) for r in licenses.scan_query(docs).collect()}
    lines = {
        "MIT": "Released under the MIT License.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "Proprietary": "All rights reserved.",
    }
    for i, t in texts.items():
        assert got[i] == {n for n, line in lines.items() if line in t}, i
    edges = licenses.scan_query(edge_docs(spark)).collect()
    assert len(edges) == len(EDGES) + 2 and all(r.n_notices == 0 for r in edges)
    assert licenses.scan_query(spark.createDataFrame([], DOCS)).count() == 0


# --- personal data ---------------------------------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    out = []
    for order, kind in enumerate(pii.BASE_KINDS):
        for m in re.finditer(pii.DEFINITIONS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


CRAFTED = [
    "a@b.c_x@d.e.f..g@h.i",
    "+1 (555) 123-4567 1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.255 1.2.3.256",
    "é😀 4111 1111 1111 1111-4111-1111-1111-1111",
    "4111111111111111 and 4111 1111 1111 1112",
    "%@a.b%@c.d+e@f.g",
    "\x01 1\x011 a\x01b@c.d",
    "a@b-.c-d@e.f @x a@ a@b",
    "1.2.3.4." * 500,
    "a@b.c " * 700,
    "9" * 30_000,
    "1 " * 30_000,
    "a@b" + ".c" * 20_000,
    "@" * 5000,
    "+12-" * 5000,
    "x" * 100_000,
]


def test_base_spans_match_plain_patterns(spark, docs, texts):
    rng = random.Random(8)
    letters = "aB1 2.3-4+5@(6)7é\n%_0"
    fuzz = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(800)]
    fuzz += ["".join(rng.choice("0123456789 -") for _ in range(60)) for _ in range(200)]
    wanted = dict(enumerate([*CRAFTED, *fuzz, *EDGES]))
    df = spark.createDataFrame(list(wanted.items()), DOCS).repartition(4).unionByName(docs.selectExpr("doc_id + 1000000 AS doc_id", "text"))
    wanted |= {i + 1_000_000: t for i, t in texts.items()}
    got = pii.digest_query(df).collect()
    assert len(got) == len(wanted)
    for r in got:
        plain = plain_spans(wanted[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(plain.encode()).hexdigest(), (wanted[r.doc_id] or "")[:80]
        kinds = [s.split(":")[0] for s in plain.split(",")] if plain else []
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in pii.BASE_KINDS)


def test_added_kinds_need_checksum_or_context(spark):
    rows = [
        "IBAN DE89 3704 0044 0532 0130 00 ok",
        "IBAN DE88 3704 0044 0532 0130 00 ok",
        "ssn 123-45-6789",
        "part 123-45-6789",
        "call (555) 123-4567",
        "order (555) 123-4567",
    ]
    got = {r.doc_id: r.spans for r in pii.digest_query(spark.createDataFrame(list(enumerate(rows)), DOCS)).collect()}
    assert got == {0: "iban:5:32", 1: "", 2: "ssn:4:15", 3: "", 4: "phone_local:5:19", 5: ""}


def test_masking(spark):
    rows = ["mail a@b.c now", "none", None, "", "IBAN GB82 WEST 1234 5698 7654 32 x"]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(rows)], "doc_id long, text string, found string")
    masked = pii.mask_pii(df)
    assert masked.columns == df.columns
    assert [r.text for r in masked.orderBy("doc_id").collect()] == ["mail <EMAIL> now", "none", None, "", "IBAN <IBAN> x"]


def test_texts_with_very_many_spans(spark):
    rng = random.Random(9)
    kinds = [lambda: f"u{rng.randrange(99)}@b.io", lambda: "10.0.0.%d" % rng.randrange(300), lambda: "+1 555 123 45%02d" % rng.randrange(99), lambda: "4111 1111 1111 1111", lambda: "wörd😀 " * rng.randint(0, 60)]
    texts = [rng.choice(["; ", "\n", " , "]).join(rng.choice(kinds)() for _ in range(n)) for n in (1, 31, 32, 33, 1023, 1025, 3000)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.doc_id: r for r in pii.digest_query(df).collect()}
    masked = {r.doc_id: r.text for r in pii.mask_pii(df).collect()}
    for i, t in enumerate(texts):
        assert got[i].base_sha256 == hashlib.sha256(plain_spans(t).encode()).hexdigest()
        spans = [(int(a), int(b), k) for k, a, b in (x.split(":") for x in got[i].spans.split(",") if x)]
        out, past = [], 0
        for a, b, k in spans:
            if a >= past:
                out.append(t[past:a] + f"<{k.upper()}>")
            past = max(past, b)
        assert masked[i] == "".join(out) + t[past:]


def test_context_is_what_stands_near(spark):
    far = "x" * 200
    rows = [f"{far} visa 4111111111111111", f"visa {far} 4111111111111111", f"4111111111111111 isbn {far}", "1" * 47 + " tel", "123-45-6789 " + "y" * 44 + " ssn", "123-45-6789 " + "y" * 40 + " ssn"]
    got = {r.doc_id: r.scores for r in pii.digest_query(spark.createDataFrame(list(enumerate(rows)), DOCS)).collect()}
    assert got == {0: "1.0", 1: "0.8", 2: "0.6", 3: "", 4: "", 5: "0.6"}


def test_pii_stays_in_the_jvm(spark, docs):
    plan = pii.digest_query(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pii_on_an_empty_table(spark):
    assert pii.digest_query(spark.createDataFrame([], DOCS)).count() == 0
    assert pii.digest_query(edge_docs(spark)).count() == len(EDGES) + 2
