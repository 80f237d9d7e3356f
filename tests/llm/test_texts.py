"""Fill-in-middle, piece encoding and phrase mining against plain versions of their rules."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from conftest import ROOT, rows
from oracle import _rows, connect
from tidemark.llm import fim, html, licenses, phrases, pieces, queries, simhash

ODD = "doc_id long, text string, lang string, n_chars string, h string"
ODD_ROWS = [
    (1, None, None, None, "x"), (2, "", "de", None, "x"), (3, "", "de", None, "x"), (None, "a null id, a text", "de", "", None),
    (4, "naïve café 日本語 \U0001F600 end", "fr", "", ""), (5, "holds <S> itself", "en", "", ""), (5, "holds <S> itself", "en", "", ""),
    (6, "x", "en", "", ""), (7, "a\tb\nc  d\r\x0b\x0c!", None, "", ""), (8, "Lower UPPER " * 20_000, "en", "", ""),
    (9, " ▁ ▁▁x  　﻿" + " " * 300, "en", "", ""), (10, "\u0000\u0001é<0x41></s>", "en", "", ""),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fill-in-middle --------------------------------------------------------------


def plain_fim(doc_id, text, unit="token"):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text) if unit == "token" else list(text)
    n = len(units)
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("unit", ["token", "char"])
def test_fill_in_middle(spark, odd, tables, unit):
    for docs in (odd, tables.documents):
        made = fim.fill_in_middle(docs, unit=unit)
        want = [plain_fim(r.doc_id, r.text, unit) for r in docs.collect()]
        assert rows(made) == sorted(want, key=repr)
        back = made.select("doc_id", fim.restored().alias("t"))
        assert rows(back) == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=repr)


def test_fill_in_middle_edges(spark, odd):
    assert fim.digests(odd.filter("false")).collect() == []
    strings = spark.createDataFrame([("k", "some text")], "doc_id string, text string")
    assert fim.fill_in_middle(strings).first().doc_id == "k"
    assert fim.fill_in_middle(odd, rate=0).filter("form <> 'plain'").count() == 0
    assert fim.fill_in_middle(odd, rate=100, spm_rate=100).filter("form = 'psm'").count() == 0
    for bad in (("<a>", "<a>b", "<c>"), ("aba", "x", "y"), ("xa", "ay", "z"), ("", "b", "c"), ("a", "b")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(odd, sentinels=bad)
    with pytest.raises(ValueError):
        fim.fill_in_middle(odd, unit="byte")


def test_sparse_index():
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choice("ab é日\U0001F600") for _ in range(rnd.randint(0, 40)))
        places = [len(text[:i].encode()) for i in range(len(text) + 1)]
        index = fim.Exceptions(np.frombuffer(text.encode(), np.uint8))
        assert len(index.places) == sum(ord(c) > 127 for c in text)
        assert index.to_bytes(np.arange(len(text) + 1)).tolist() == places
        assert index.to_chars(np.array(places)).tolist() == list(range(len(text) + 1))


# --- pieces ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


@pytest.fixture(scope="module")
def model():
    return pieces.Model(queries.PIECES)


def test_pieces_of_documents(spark, odd, tables, library):
    for docs in (odd, tables.documents):
        got = rows(pieces.piece_digests(docs, queries.PIECES))
        want = []
        for r in docs.collect():
            ids = library.encode(r.text or "", add_eos=True)
            want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
        assert got == sorted(want, key=repr)
    assert pieces.piece_digests(odd.filter("false"), queries.PIECES).collect() == []
    lists = spark.createDataFrame([(1, None), (2, []), (3, [2]), (4, [28705, 13, 2])], "doc_id long, ids array<int>")
    assert [t for *_, t in rows(pieces.decoded(lists, queries.PIECES))] == ["", "", "", "\n"]


def test_random_texts(model, library):
    rnd = random.Random(1)
    signs = "ab \n\t.▁éaaa  <>s/日本x\U0001F600\r()'0e in the er"
    for _ in range(4000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 30)))
        assert model.encode(text).tolist() == library.encode(text), text


def test_without_words(library):
    whole = pieces.Model(queries.PIECES)
    whole.split = None
    for text in ("one two  three", "", " \n x", "日本é"):
        assert whole.encode(text).tolist() == library.encode(text)


def test_bounded_memory(library, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 5)
    monkeypatch.setattr(pieces, "PAIRS", 7)
    small = pieces.Model(queries.PIECES)
    for text in ("several words are more than memory holds", "and some more of them here"):
        assert small.encode(text).tolist() == library.encode(text)
        assert len(small.words) <= 5 and len(small.pairs) <= 7


def test_random_ids(model, library):
    rnd = random.Random(2)
    some = [0, 1, 2, 13, 28705, 259, 260, 300, 35, 229, 230, 132, 3 + 0xF0, 3 + 0x9F, 3 + 0x98, 3 + 0x80, 264]
    lists = [[rnd.choice([*some, rnd.randrange(32000)]) for _ in range(rnd.randint(0, 6))] for _ in range(6000)]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    flat = np.array([i for x in lists for i in x], np.int32)
    for ids, text in zip(lists, model.decode(flat, offsets)):
        assert text.decode() == library.decode(ids), ids


def test_pair_test_on_random_vocabularies():
    """Against merging the joined text, with tied scores and merges out of order."""
    rnd = random.Random(5)
    for _ in range(60):
        tokens = {"a", "b", "c"}
        while len(tokens) < 25:
            tokens.add(rnd.choice(sorted(tokens)) + rnd.choice(sorted(tokens)))
        merges = pieces.Merges({t: float(rnd.randint(0, 12)) for t in tokens})
        whole = [t for t in sorted(tokens) if merges.merge(t)[0] == [t]]
        for left in whole:
            for right in whole:
                assert merges.bear(left, right) == (merges.merge(left + right)[0] == [left, right])


# --- phrases ---------------------------------------------------------------------


def plain_collocations(docs, least, share=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for r in docs:
        lang = "und" if r.lang is None else r.lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(
                n >= least and 100 * n >= share * a and (t[:2] == p or t[1:] == p) for t, n in f.items() if len(t) == 3
            ):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out, key=repr)


SMALL_WORDS = ["the", "of", "The", "new", "york", "city", "é", "日本", "x-y", "b", " "]


def small_corpus(spark, n=300):
    rnd = random.Random(9)
    made = []
    for i in range(n):
        words = [rnd.choice(SMALL_WORDS[: rnd.randint(2, len(SMALL_WORDS))]) for _ in range(rnd.randint(0, 60))]
        text = "".join(w + rnd.choice(["  ", " ", " ", " ", "\t", ", ", ".", "\n", " ; "]) for w in words)
        made.append((i, text, rnd.choice(["en", "en", "en", "de", None]), "", None))
    return spark.createDataFrame(made + ODD_ROWS, ODD).repartition(4)


@pytest.mark.parametrize("burst,room,bits", [(65_536, 1_000_000, 1 << 27), (64, 400, 1 << 27), (256, 90, 1 << 6)])
def test_collocations(spark, monkeypatch, burst, room, bits):
    """Whatever bursts and leaves early, and even where the filter lets everything through."""
    docs = small_corpus(spark)
    counter = phrases.Counter

    def with_limits(longest, with_parts):
        phrases.BURST, phrases.ROOM = burst, room
        return counter(longest, with_parts)

    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    monkeypatch.setattr(phrases, "Counter", with_limits)
    got = rows(phrases.collocations(docs))
    assert got == plain_collocations(docs.collect(), 10)


def test_collocations_settings(spark):
    docs = small_corpus(spark, 80)
    assert rows(phrases.collocations(docs, least=3, share=80, top=7)) == plain_collocations(docs.collect(), 3, 80, 7)
    assert phrases.collocations(docs.filter("false")).collect() == []
    assert {len(r.phrase.split(" ")) for r in phrases.collocations(docs, longest=2).collect()} == {2}
    with pytest.raises(ValueError):
        phrases.collocations(docs, longest=4)


def test_trie_bursts_and_runs(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 64)
    monkeypatch.setattr(phrases, "ROOM", 2000)
    rnd = np.random.default_rng(4)
    words = [f"w{i}".encode() for i in range(60)]
    for longest in (2, 3):
        counter = phrases.Counter(longest, with_parts=longest == 2)
        numbers = counter.number(pa.array(words, pa.large_binary()))
        runs, want, deep = [], Counter(), 0
        for _ in range(30):
            picks = rnd.zipf(1.3, (300, longest)) % 60
            key = np.zeros(300, np.int64)
            for i in range(longest):
                key = key << phrases.ID_BITS | numbers[picks[:, i]]
            want.update(b" ".join(words[j] for j in row) for row in picks.tolist())
            if longest == 2:
                want.update(words[row[0]] for row in picks.tolist())
            runs += counter.add("en", key)
            deep = max([deep, *(len(n.below) for n in counter.tries["en"].below.values())])
            assert counter.held <= 2300 and counter.held == sum(t.size() for t in counter.tries.values())
        assert longest == 2 or (runs and deep), "nothing left early, or no container burst twice"
        runs += counter.spill()
        got = Counter()
        for run in runs:
            found = run.column("phrase").to_pylist()
            assert [p.split(b" ") for p in found] == sorted(p.split(b" ") for p in found)
            for phrase, n in zip(found, run.column("n").to_pylist()):
                got[phrase] += n
        assert got == want


# --- near copies -----------------------------------------------------------------


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("seed", range(4))
def test_prefix_pairs_miss_nothing(spark, seed):
    """Sets of all sizes around shared cores, similarities on both sides of 0.8 and exactly at it."""
    rnd = random.Random(seed)
    made = {0: set(range(4)), 1: set(range(5)), 2: {1}, 3: {1}, 4: set(range(100, 109)), 5: set(range(100, 110)) - {101}, 6: set(range(100, 110))}
    for i in range(7, 160):
        core = range(1000 * rnd.randrange(4), 1000 * rnd.randrange(4) + rnd.randrange(1, 260))
        own = [rnd.randrange(10**9) for _ in range(rnd.randrange(0, max(len(core) // 3, 2)))]
        made[i] = {x for x in core if rnd.random() > 0.06} | set(own)
        if i % 5 == 0 and made[i - 1]:
            base = sorted(made[i - 1])
            made[i] = set(base[: max(1, int(len(base) * rnd.uniform(0.78, 1)))])
    made = {i: s for i, s in made.items() if s}
    groups = {i: i % 9 if rnd.random() < 0.5 else i for i in made}
    rows_ = [(i, np.array(sorted(s), np.int64).tobytes()) for i, s in made.items()]
    sets = spark.createDataFrame(rows_, "node long, s binary")
    found = simhash.prefix_pairs(sets, spark.createDataFrame(list(groups.items()), "node long, group long"), 0.8)
    got = {(r["a"], r["b"]) for r in found.collect()}
    want = {(a, b) for a in made for b in made if a > b and groups[a] != groups[b] and jaccard(made[a], made[b]) >= 0.8}
    assert want <= got and all(groups[a] != groups[b] for a, b in got)


def test_sets_that_share_a_core_do_not_meet(spark):
    """300 sets just below 0.8 to each other: without a similar pair there is hardly a pair to compare."""
    rnd = random.Random(6)
    core = list(range(200))
    made = {i: set(core[:172]) | {rnd.randrange(10**6, 10**12) for _ in range(28)} for i in range(300)}
    assert 0.74 < jaccard(made[0], made[1]) < 0.8
    made[300] = set(list(made[7])[:-3]) | {5 * 10**12}
    rows_ = [(i, np.array(sorted(s), np.int64).tobytes()) for i, s in made.items()]
    groups = spark.createDataFrame([(i, i) for i in made], "node long, group long")
    got = [tuple(r) for r in simhash.prefix_pairs(spark.createDataFrame(rows_, "node long, s binary"), groups, 0.8).collect()]
    assert (300, 7) in got and len(got) < 30


def test_sets_that_share_rare_shingles_only_make_no_pairs(spark):
    """Sets out of one pool share shingles in their prefixes; maps of their hashes tell that they are not alike."""
    rnd = random.Random(9)
    pool = [rnd.randrange(-(2**63), 2**63) for _ in range(40)]
    made = {i: set(rnd.sample(pool, 20)) for i in range(80)}
    made[80] = set(pool[:20])
    made[81] = set(pool[:19]) | {pool[25]}
    rows_ = [(i, np.array(sorted(s), np.int64).tobytes()) for i, s in made.items()]
    groups = spark.createDataFrame([(i, i) for i in made], "node long, group long")
    got = {tuple(r) for r in simhash.prefix_pairs(spark.createDataFrame(rows_, "node long, s binary"), groups, 0.8).collect()}
    want = {(a, b) for a in made for b in made if a > b and jaccard(made[a], made[b]) >= 0.8}
    assert (81, 80) in got and want <= got and len(got) < 20


# --- licenses --------------------------------------------------------------------


@pytest.mark.parametrize("text, want", [
    ("Licensed under CC BY 3.0.", []), ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]), ("Licensed under CC BY-SA 4.0. All rights reserved.", ["CC-BY-SA-4.0", "proprietary"]),
    ("This work is licensed under the GNU General Public License, version 9.", []), ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
    ("Licensed under the Apache License, Version 1.1.", []), ("// SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]), ("Licensed under the ISC License.", ["ISC"]),
    ("Released under the BSD 4-Clause License.", ["BSD-4-Clause"]), ("some words before All rights reserved.", ["proprietary"]), ("a license to read", []),
])
def test_licenses_by_savings_with_exact_versions(text, want):
    assert [r["license"] for r in licenses.Scanner().scan(text)] == want


def test_every_template_is_found_whole():
    """Each wording, its slots filled, names its own license and differs in no word."""
    scanner = licenses.Scanner()
    for name, wording in licenses.TEMPLATES:
        found = scanner.scan("intro words\n\n" + wording.format("2031", "Somebody") + "\n\nmore words")
        assert [r["license"] for r in found][:1] == [name] and found[0]["n_missing"] + found[0]["n_added"] == 0


def test_long_lines_are_aligned_in_windows(monkeypatch):
    rnd = random.Random(3)
    words = [rnd.choice(["alpha", "beta", "license", "copyright"]) for _ in range(3000)]
    for at in (5, 99, 100, 640, 1023, 1500, 2980):
        words[at : at + 5] = "Released under the MIT License.".split()
    text = " ".join(words)
    whole = licenses.Scanner().scan(text)
    monkeypatch.setattr(licenses, "WINDOW", 64)
    cut = licenses.Scanner().scan(text)
    key = [(r["license"], r["matched"]) for r in whole]
    assert key == [(r["license"], r["matched"]) for r in cut] and len([k for k in key if k[0] == "MIT"]) >= 6


# --- pages -----------------------------------------------------------------------

LONG = "word " * 60

SHAPES = [
    ("<body class='page right-sidebar'><article><h1>T</h1><p>lead<div class=post-body><p>{L}</div></article>", "T\nlead\n{L}"),
    ("<html class=no-overlay><body class='single has-cookie-banner'><section class=a><p>A {L}</section><section class=b><p>B</section>", "A {L}\nB"),
    ("<body><article><header><h1>Head</h1></header><div><p>{L}</div></article>", "Head\n{L}"),
    ("<form><h1>H</h1><p>{L}</p></form><footer>f</footer>", "H\n{L}"),
    ("<div id=page class='content-with-sidebar'><h1>H</h1><p>{L}</p></div><div class=reader-feedback><p>{L} {L}</div>", "H\n{L}"),
    ("<div class='post share-open'><h1>H</h1><p>{L}</div><div class=share><p>s</div>", "H\n{L}"),
    ("<nav><ul><li>a</ul></nav><div class=ad>x</div><aside>y</aside><div><div><p>{L}</div></div>", "{L}"),
    ("<article><h1>T</h1><p>{L}<section id=comments><h3>c</h3><p>{L} {L} {L}</section></article>", "T\n{L}"),
    ("<nav><ul><li>only this", ""), ("plain &amp; simple", "plain & simple"), ("<p>a <b>b", "a b"), ("a < b <c", "a < b <c"),
    ("<p>x<!-- never closed <p>y", "x"), ("<p title='>'>x</p><p title='a>y", "x\ny"), ("<![CDATA[ 1 < 2 ]]>", "1 < 2"),
]


@pytest.mark.parametrize("page, want", SHAPES)
def test_page_shapes(page, want):
    words = LONG.strip()
    assert html.main_text(html.parse(page.replace("{L}", words)), None) == want.replace("{L}", words)


def test_paths_give_way_to_the_story(spark):
    """A teaser on the host's path does not stand for an article elsewhere; a short article on it does."""
    words = LONG.strip()
    usual = [f"<div class=post><h1>N{i}</h1><p>{words} {i}</div>" for i in range(4)]
    pages = [*usual, f"<div class=post><p>teaser</div><article><h1>S</h1><p>{words} {words}</article>", "<div class=post><h1>Short</h1></div><p>stray text</p>"]
    df = spark.createDataFrame([(i, "http://h.example/x", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.page_texts(df).collect()}
    assert got[0] == f"N0\n{words} 0" and got[4] == f"S\n{words} {words}" and got[5] == "Short"


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a \"" * 250_000, "<div>" * 100_000 + "x" + "</div>" * 100_000, '<div class="c1 d">' * 50_000 + "x",
    "<div>" * 50_000 + "</p>" * 50_000, "<select>" * 100_000, "<div " + "a" * 1_000_000 + ">x", "<!-" * 300_000, '<p class="menu">' * 30_000,
])
def test_long_pages_take_time_in_proportion(page):
    """Twice the page takes about twice the time: quadratic scans of these would take minutes."""
    start = time.perf_counter()
    html.main_text(html.parse(page), None)
    assert time.perf_counter() - start < 15


def words_of(page):
    """Visible words of a page without markup, plainly: what may be in a text at all."""
    page = re.sub("(?s)<(script|style|head)\\b.*?</\\1>|<!--.*?-->", " ", page)
    return html.entities.unescape(re.sub("<[^>]*>", " ", page)).split()


def test_no_article_loses_text(tables):
    """Against the article elements of the test pages, cut out by hand."""
    seen = 0
    for r in tables.pages.collect():
        found = re.findall("(?s)<article>(.*?)</article>", r["html"] or "")
        if len(found) != 1 or re.search("<(aside|nav|form|header|footer)|class=", found[0]):
            continue
        seen += 1
        assert html.main_text(html.parse(r["html"]), None).split() == words_of(found[0])
    assert seen >= 40


@pytest.mark.parametrize("name", ["op12_phrases", "op13_fill_in_middle"])
def test_sql(spark, name):
    df = queries.QUERIES[name](spark, ROOT)
    found = connect(ROOT).execute(queries.SQL[name])
    names = [d[0] for d in found.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, found.fetchall())
