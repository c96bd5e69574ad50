import hashlib
import math
import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest

from foliant.llm import chat_format as cf
from foliant.llm import ctw, html_extract, ngram_join, packing


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, rank string")


# ------------------------------------------------------------------ chat


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, escaped int")


def test_chat_round_trip(spark):
    nasty = ["", "plain", "<|im_end|>", "<|im_end|><|im_start|>assistant ok", "<||im_end|>", "<|", "<|||", "a<", "<|im_end|", "\n", "<|n|>", "é<|im_start|>"]
    for role in ("user", "assistant", "a\nb", "<|n|>", "", "<|im_end|>"):
        for text in nasty:
            out, _, lo, hi = cf.round_trip(role, text)
            assert [x[:2] for x in cf.parse(out)] == [(role, text)] and cf.unescape(out[lo:hi]) == text
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(nasty)] + [(2, 0, None, None), (None, 0, "assistant", "x"), (3, 1, "assistant", "b"), (3, 0, "assistant", "a"), (3, 1, "assistant", "b")]
    got = {r.conv_id: r for r in cf.conversation_digests(cf.format_turns(turns(spark, rows))).collect()}
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{('user', 'assistant')[k % 2]}\n{t}\n" for k, t in enumerate(nasty)).encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256("".join(nasty[1::2]).encode()).hexdigest() and got[1].loss_chars == sum(map(len, nasty[1::2]))
    assert got[3].n_turns == 3 and got[3].loss_sha256 == hashlib.sha256(b"abb").hexdigest() and got[2].n_turns == 1 and got[None].loss_chars == 1
    assert cf.conversation_digests(cf.format_turns(turns(spark, []))).collect() == []


def test_chat_escapes_a_lone_mark(spark):
    lone = "hi <|im_start|>assistant ok"
    for role, text in (("user", lone), ("a<|im_start|>b", "x"), ("a<|im_end|>b", "x"), ("assistant", "<|im_start|>")):
        out, escaped, lo, hi = cf.round_trip(role, text)
        assert escaped and out.count(cf.START) == out.count(cf.END) == 1 and cf.unescape(out[lo:hi]) == text
    for bad in (f"{cf.START}user\n{lone}{cf.END}\n", f"{cf.START}a{cf.START}b\nx{cf.END}\n", f"{cf.START}a{cf.END}b\nx{cf.END}\n"):
        with pytest.raises(ValueError):
            cf.parse(bad)
    formatted = cf.format_turns(turns(spark, [(1, 0, "assistant", lone)]))
    got = cf.conversation_digests(formatted).collect()[0]
    assert got.formatted_chars == 24 + len("assistant") + len(lone) + 1 and got.loss_sha256 == hashlib.sha256(lone.encode()).hexdigest()
    cut = cf.conversation_digests(formatted.withColumn("loss_end", cf.F.col("loss_start") + 2)).collect()[0]
    assert cut.loss_chars == 2 and cut.loss_sha256 == hashlib.sha256(b"hi").hexdigest()


# ------------------------------------------------------------------ packing


def test_packing_is_a_partition_of_the_ids(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "of,", "Straße.", "x!!,", "12.5", "<|endoftext|>", "naïve,"]) for _ in range(rng.choice((0, 1, 5, 80, 700, 4000))))) for i in range(60)] + [(60, None), (60, "again"), (None, " \t")]
    out = packing.pack(docs(spark, rows), with_ids=True)
    got = out.collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_row, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length and 0 < r.length <= 2048
    made = sorted((x[0].doc_id is None, x[0].doc_id or 0, b"".join(p.ids for p in sorted(x, key=lambda p: p.start))) for x in by_doc.values())
    assert made == sorted((i is None, i or 0, np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in rows)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= 2048
    whole = {r.sequence_id: r for r in packing.sequences(out).collect()}
    assert all(len(whole[k].ids) == 4 * sum(n for _, n in s) for k, s in seqs.items())
    assert packing.pack(docs(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece(seed):
    rng = random.Random(seed)
    hist = {rng.randrange(1, 65): rng.randrange(1, 1000) for _ in range(rng.choice((1, 5, 40)))}
    got = Counter()
    for count, content in packing.plan(hist, 64):
        assert sum(n * k for n, k in content) <= 64 and count > 0
        for n, k in content:
            got[n] += count * k
    assert got == Counter(hist)


# ------------------------------------------------------------------ n-gram join


def test_join_against_brute_force(spark):
    rng = random.Random(4)
    base = [[rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(n)] for n in (3, 5, 6, 60, 120, 120)]
    rows = []
    for i in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 6))):
            w[rng.randrange(len(w))] = rng.choice("xyz")
        rows.append((i, (" ", "\n")[i % 2].join(w).upper() if i % 5 == 0 else " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "a"), (204, "A")]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    link = {i: [j for j in sets if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in sets}
    top = {i: i for i in sets}
    for _ in sets:
        top = {i: min([top[i], *(top[j] for j in link[i])]) for i in sets}
    got = {r.doc_id: r for r in ngram_join.ngram_join(docs(spark, rows)).collect()}
    assert {i: (r.n_links, r.class_id, r.kept) for i, r in got.items()} == {i: (len(link[i]), top[i], top[i] == i) for i in sets}
    kept = ngram_join.drop_near_copies(docs(spark, rows))
    assert {r.doc_id for r in kept.collect()} == {i for i in sets if top[i] == i} and kept.columns == ["doc_id", "text", "rank"]
    assert ngram_join.ngram_join(docs(spark, [])).collect() == []


def test_one_row_of_a_class_stays(spark):
    words = [f"w{i}" for i in range(80)]
    a, near = " ".join(words), " ".join([*words[:79], "x"])
    rows = [(1, a), (1, a), (1, near), (2, a), (3, "b c d"), (3, "e f g"), (3, "e f g"), (None, "h i"), (None, "h i"), (None, None)]
    kept = ngram_join.drop_near_copies(docs(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "3", "None", "None"]
    assert {r.text for r in kept if r.doc_id == 3} == {"b c d", "e f g"} and {r.text for r in kept if r.doc_id is None} == {"h i", None}


def test_blocks_of_a_large_cluster(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[:i] + ["x"] + base[i + 1 :])) for i in range(60)]
    got = ngram_join.ngram_join(docs(spark, rows)).collect()
    assert sum(r.n_links for r in got) >= 0.999 * 60 * 59 and {r.class_id for r in got} == {0}


def test_a_chain_is_verified_bucket_by_bucket(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    text = [f"w{i}" for i in range(700)]
    rows = [(i, " ".join(text[4 * i : 4 * i + 100])) for i in range(140)]  # each like its neighbours, all in one cluster
    sets = [{tuple(t.split()[k : k + 5]) for k in range(96)} for _, t in rows]
    link = [sum(j != i and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    got = {r.doc_id: r for r in ngram_join.ngram_join(docs(spark, rows)).collect()}
    assert [got[i].n_links for i in range(140)] == link and {r.class_id for r in got.values()} == {0}
    bands, n = ngram_join.choose_bands()
    sig = ngram_join.signatures(docs(spark, rows).withColumn("text_key", ngram_join.F.lit(0).cast("long")), 5, bands, n)
    member = ngram_join._members(sig.selectExpr("doc_id AS rep_id", "set_id AS node", "1L AS copies", "shingles", "bands")).collect()
    moved = sum(p.blocks for m in member for p in m.places)
    assert len(member) == 140 and max(p.blocks for m in member for p in m.places) <= 4 and moved < 140 * 18  # 140 * 18 blocks, were it one cluster


def test_links_do_not_depend_on_blocks(spark, monkeypatch):
    """Chained and dense texts with a recall at which many pairs share no bucket: the same links whole, in blocks and by bucket."""
    text, base = [f"w{i}" for i in range(400)], [f"v{i}" for i in range(120)]
    rows = [(i, " ".join(text[4 * i : 4 * i + 100])) for i in range(60)] + [(100 + i, " ".join(base[:i] + ["x"] + base[i + 1 :])) for i in range(40)]
    seen = []
    for block in (1024, 16, 8):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        seen.append(sorted((r.doc_id, r.n_links, r.class_id) for r in ngram_join.ngram_join(docs(spark, rows), recall=0.7).collect()))
    assert seen[0] == seen[1] == seen[2]
    bands, per = ngram_join.choose_bands(recall=0.7)
    sets = list(ngram_join.shingle_sets([t.encode() for _, t in rows]))
    hashes = [set(ngram_join.band_hashes(ngram_join.min_hash(s, bands * per), bands, per).tolist()) for s in sets]
    like = lambda i, j: len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))
    pairs = [(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and like(i, j)]
    assert [n for _, n, _ in seen[0]] == [sum(a == i and bool(hashes[a] & hashes[b]) for a, b in pairs) for i in range(len(rows))]
    assert sum(bool(hashes[a] & hashes[b]) for a, b in pairs) < len(pairs)


@pytest.mark.parametrize("changed", [1, 2, 3, 4])
def test_recall_of_planted_pairs(spark, changed):
    rng = random.Random(changed)
    rows, pairs = [], []
    for i in range(150):
        w = [f"v{rng.randrange(10**6)}" for _ in range(200)]
        v = list(w)
        for p in rng.sample(range(5, 195), changed):
            v[p] = "new"
        a, b = ({tuple(x[k : k + 5]) for k in range(196)} for x in (w, v))
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
        if len(a & b) >= 0.8 * len(a | b):
            pairs.append(i)
    got = {r.doc_id: r.class_id for r in ngram_join.ngram_join(docs(spark, rows)).collect()}
    assert len(pairs) > 100 and sum(got[2 * i + 1] == 2 * i for i in pairs) >= 0.99 * len(pairs)
    assert all(got[2 * i + 1] != 2 * i for i in range(150) if i not in pairs)


def test_join_of_long_texts_and_columns_named_alike(spark):
    words = [f"w{i}" for i in range(60_000)]
    rows = [(1, " ".join(words), 5, "a", 0), (2, " ".join(words[:59_000]), 6, "b", 0), (None, " ".join(words), 7, "c", 0), (4, "", 8, "d", 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, node int, places string, class_id int")
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in ngram_join.ngram_join(d).collect()}
    assert got == {1: (1, 2, 2), 2: (1, 2, 1), None: (1, 2, 2), 4: (4, 0, 1)}
    kept = ngram_join.drop_near_copies(d)
    assert sorted(r.node for r in kept.collect()) == [5, 8] and kept.columns == d.columns


def test_bands_reach_recall():
    for t in (0.5, 0.8, 0.9):
        b, r = ngram_join.choose_bands(t, 0.99)
        assert 1 - (1 - t**r) ** b >= 0.99 and b * r <= ngram_join.MOST_HASHES


# ------------------------------------------------------------------ language model


def brute_ctw(train, depth):
    """Sequential context-tree weighting of single decisions, as a reference: (context, node) -> counts, kept as dicts."""
    counts = Counter()
    for t in train:
        b = bytes([255]) * depth + t + bytes([255])
        for i in range(depth, len(b)):
            node = 1
            for k in range(8):
                bit = b[i] >> (7 - k) & 1
                for d in range(depth + 1):
                    counts[b[i - d : i], d, node, bit] += 1
                node = 2 * node + bit
    contexts = {(c, d) for c, d, _, _ in counts}
    kids = {}
    for c, d in contexts:
        if d:
            kids.setdefault((c[1:], d - 1), []).append((c, d))

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weigh(c, d, node):
        e = kt(counts[c, d, node, 0], counts[c, d, node, 1])
        if d == depth:
            return e
        s = sum(weigh(*k, node) for k in kids.get((c, d), []))
        return np.logaddexp(e, s) - math.log(2)

    def one(b, i, node):
        def at(d):
            c = b[i - d : i]
            n0, n1 = counts[c, d, node, 0], counts[c, d, node, 1]
            p = (n1 + 0.5) / (n0 + n1 + 1)
            if d == depth or (c, d) not in contexts:
                return p
            stop = math.exp(kt(n0, n1) - math.log(2) - weigh(c, d, node))
            return stop * p + (1 - stop) * at(d + 1)

        return at(0)

    def score(t):
        b, total = bytes([255]) * depth + t + bytes([255]), 0.0
        for i in range(depth, len(b)):
            node = 1
            for k in range(8):
                bit = b[i] >> (7 - k) & 1
                p = one(b, i, node)
                total += math.log10(p if bit else 1 - p)
                node = 2 * node + bit
        return total

    return score


def test_ctw_equals_the_definition(spark):
    texts = ["abab", "abba", "aab", "", "babab"]
    rows = [(i, t) for i, t in enumerate(texts)]
    d = docs(spark, rows)
    got = {r.doc_id: r for r in ctw.score(d, depth=3).collect()}
    train = [t.encode() for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    score = brute_ctw(train, 3)
    for i, t in rows:
        if t in [x.decode() for x in train]:
            assert got[i].score == pytest.approx(score(t.encode()), rel=1e-4)


def test_ctw_keeps_rare_contexts_at_any_bound(spark, monkeypatch):
    monkeypatch.setattr(ctw, "SLICE", 3, raising=False)
    monkeypatch.setattr(ctw, "LOOKUP", 40, raising=False)
    rng = random.Random(6)
    rows = [(i, "ab" * rng.randrange(9)) for i in range(30)] + [(40 + i, "".join(rng.choice("cdeé") for _ in range(6))) for i in range(12)] + [(90, "zz~"), (91, "")]
    train = [t.encode() for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    score = brute_ctw(train, 3)
    got = {r.doc_id: r.score for r in ctw.score(docs(spark, rows), depth=3).collect()}
    assert len(train) < len(rows) and got == {i: pytest.approx(score(t.encode()), rel=1e-4) for i, t in rows}


def test_base_score_and_tokens(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["The", "the", "cat", f"r{rng.randrange(50)}", "é"]) for _ in range(rng.randrange(30)))) for i in range(80)] + [(500, None), (None, "x"), (7, "the the")]
    got = ctw.score(docs(spark, rows)).collect()
    low = lambda t: (t or "").encode().lower().split() + [b""]
    c = Counter(w for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2 for w in low(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(low(t)), sum(w in c for w in low(t)), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in low(t)), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want and {r.train_tokens for r in got} == {n}
    assert all(r.score < 0 for r in got) and ctw.score(docs(spark, [])).collect() == []


def test_ctw_learns_held_out_text(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) for _ in range(40))) for i in range(150)]
    got = [r for r in ctw.score(docs(spark, rows)).collect() if r.held_out]
    assert got and sum(r.bits_per_byte for r in got) / len(got) < 0.8


def test_slices_are_bounded_in_bytes():
    from foliant.llm import common

    t = pa.array(["x" * n if n is not None else None for n in (5, 9_000_000, 3, None, 7_999_997, 1, 8_000_001, *[4] * 7)])
    got = list(common.text_slices(t, 3))
    assert got == [(0, 1), (1, 1), (2, 3), (5, 1), (6, 1), (7, 3), (10, 3), (13, 1)] and list(common.text_slices(t.slice(0, 0), 3)) == []


# ------------------------------------------------------------------ html


def test_html(spark):
    text = "This is a long enough sentence of the article, with commas, and it goes on for a while. "
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body class="has-sidebar"><header>Site</header><nav><ul><li><a href=a>Home</a></li></ul></nav>
    <div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>{text}<b>bold</b>er<br>next<p>un&eacute;closed &amp more</p><div class="ad">Buy</div><p>{text}</p><section id="comments"><p>First!</p></section></article>
    <aside>Related</aside><form>Mail <input></form><footer>(c)</footer></body></html>"""
    rows = [(1, "u", page, 0), (2, "u", None, 0), (3, None, "", 0), (4, "u", "<article><p>cut off <b>here", 0), (4, "u", f"<p>{text * 3}</p><p>x &lt;y&gt;</p><a hr", 0)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    t = " ".join(text.split())
    assert by[1] == [f"Head & line {t} bolder next unéclosed & more {t}"] and by[2] == [""] and by[3] == [""]
    assert sorted(by[4]) == sorted(["cut off here", " ".join([t] * 3) + " x <y>"])
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize(
    "page, want",
    [
        ('<p>a <a href="/hidden-valley?id=comment" title="a hidden gem">b</a></p><div data-hidden="0" aria-hidden="false">c</div>', "a b c"),
        ("<p>a</p><div hidden>b</div><div HIDDEN=''>c</div><div style='display: none'>d</div><p>e", "a e"),
        ("<p>a</p><datalist><option>x<option value='1'>y</datalist><p>b</p>", "a b"),
        ("<p>a</p><select><option>x</select><button>y<p>b</p>", "a y b"),
        ("<p class=it's>a</p><p>b, it's</p><p>c</p>", "a b, it's c"),
        ("<p>a</p><p title='it>b</p><p>c, don't</p>", "a b c, don't"),
        ("<p>a x<y, it's> b</p><p>c", "a x b c"),
        ("<p>let <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math> be</p>", "let x+1 be"),
        ('<p title="1 > 0" class = "q">a</p><img alt="x>y"><p>b<br/>c', "a b c"),
    ],
)
def test_html_keeps_text(page, want):
    assert " ".join(t for s in html_extract.segments(page) if not s.by_tag and not s.by_name for t in s.texts) == want


LONG = "A paragraph of the article that is long enough, with commas and a full stop, to look like prose to anyone."


@pytest.mark.parametrize("name", ["comment-body", "story-header", "story-tags-intro", "has-sidebar", "entry-content", "share-price-text"])
def test_class_words_do_not_condemn_an_article_paragraph(name):
    w = np.array(html_extract.PRIOR)
    page = f"<nav><a href=x>Home</a></nav><article><p>{LONG}</p><div class='{name}'><p>{LONG} Two.</p><p>Short one.</p></div><p data-x=it's>{LONG}</p><p class=\"x>{LONG}</p></article><footer>(c)</footer>"
    assert html_extract.main_text(page, w) == f"{LONG} {LONG} Two. Short one. {LONG} {LONG}"


@pytest.mark.parametrize("name", ["comments", "post-comments", "ad", "ad-container", "relatedPosts", "cookie-notice", "share-buttons", "newsletter_signup"])
def test_named_boilerplate_goes_even_from_articles(name):
    w = np.array(html_extract.PRIOR)
    for where in (f"class='{name}'", f"id={name}"):
        page = f"<form id=aspnetForm><article><p>{LONG}</p><div {where}><article><p>{LONG} Said a reader.</p></article></div></article><form><p>{LONG}</p></form></form>"
        assert html_extract.main_text(page, w) == LONG


def test_a_trained_classifier_tells_unmarked_pages_apart():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    prose = lambda: "".join(f"<p>{' '.join(word() + rng.choice(['', '', ',', '.']) for _ in range(rng.randrange(25, 80)))}.</p>" for _ in range(rng.randrange(2, 6)))
    links = lambda: "<ul>" + "".join(f"<li><a href=x>{word()}</a></li>" for _ in range(6)) + "</ul>"
    page = lambda a, b: f"<{b}>{links()}</{b}><{a}>{prose()}</{a}><{b}>{word()} {word()}</{b}>"
    w = html_extract.train([r for _ in range(60) for r in html_extract.examples(page("article", "nav"))])
    for _ in range(60):
        seg = html_extract.segments(page("div", "section"))  # no tag, class or role to see
        assert [x > 0 for x in html_extract.log_odds(seg, w)] == [False, True, False]
    assert html_extract.examples(page("div", "section")) == [] and (html_extract.train([]) == html_extract.PRIOR).all()


class Plain(HTMLParser):
    """Blocks of a well-formed page, read by the standard library: (path, texts, linked, marks, flags) for each run of one container."""

    def __init__(self):
        super().__init__()
        self.stack, self.n, self.words, self.linked, self.runs = [("", 0, (False, False, 0.0, False, False, False))], 0, [], 0, []

    def flush(self):
        text = " ".join("".join(self.words).split())
        if text:
            i = len(self.stack) - 1
            while i and self.stack[i][0] in ("p", "li", "ul", "a", "b", "h1"):
                i -= 1
            path, flags = [x[1] for x in self.stack[: i + 1]], self.stack[-1][2]
            if not self.runs or self.runs[-1][0] != path or self.runs[-1][4][:5] != flags[:5]:
                self.runs.append([path, [], 0, 0, flags])
            r = self.runs[-1]
            r[1].append(text)
            r[2] += min(self.linked, len(text))
            r[3] += sum(text.count(c) for c in ".,;:?!")
        self.words, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag not in ("a", "b"):
            self.flush()
        article, boiler, name, says, item, head = self.stack[-1][2]
        for _, v in attrs:
            for one in v.split() if v != "x" else ():
                got = html_extract.named(one, article or tag == "article")
                name, says = max(name, got[0]), says or got[1]
        self.n += 1
        self.stack.append((tag, self.n, (article or tag == "article", boiler or tag in ("nav", "footer"), name, says, item or tag == "li", head or tag == "h1")))

    def handle_endtag(self, tag):
        if tag not in ("a", "b"):
            self.flush()
        self.stack.pop()

    def handle_data(self, data):
        self.words.append(data)
        if any(x[0] == "a" for x in self.stack):
            self.linked += len(data.strip())


def brute_page(page, w):
    """The text of the cheapest of all labellings, and how much the next one costs more."""
    p = Plain()
    p.feed(page)
    p.flush()
    runs, k = p.runs, len(p.runs)
    chars = [sum(map(len, r[1])) for r in runs]
    clip = lambda v, most: max(-most, min(most, v))
    odds = []
    for i, (_, texts, linked, marks, (article, boiler, name, says, item, head)) in enumerate(runs):
        c = chars[i]
        x = [1.0, linked / c, min(c, 2000) / 2000, c / sum(chars), min(marks / c * 50, 2.0), min(c / len(texts), 400) / 400, item, head, i / k]
        odds.append(clip(sum(a * b for a, b in zip(x, w)), html_extract.TEXT_SWAY) + clip(name * w[9] + (says and not name) * w[10], html_extract.NAME_SWAY) + html_extract.IN_ARTICLE * article + html_extract.BY_TAG * boiler)
    edges, last = [], {}
    for i, (path, *_) in enumerate(runs):
        if i:
            before = runs[i - 1][0]
            both = next((d for d, (a, b) in enumerate(zip(before, path)) if a != b), min(len(before), len(path)))
            edges.append((i - 1, i, html_extract.ADJACENT / (1 + len(before) + len(path) - 2 * both)))
        if path[-1] in last:
            edges.append((last[path[-1]], i, html_extract.PROXIMITY))
        last[path[-1]] = i
    soft = lambda v: math.log1p(math.exp(-abs(v))) + max(v, 0.0)
    cost = lambda m: sum(soft(-o if m >> i & 1 else o) for i, o in enumerate(odds)) + sum(c for i, j, c in edges if (m >> i ^ m >> j) & 1)
    ranked = sorted((cost(m), m) for m in range(1 << k))
    best = ranked[0][1]
    alone = sum(1 << i for i, o in enumerate(odds) if o > 0)
    by_name = sum(1 << i for i, r in enumerate(runs) if r[4][0] and not r[4][1] and not r[4][2])
    text = " ".join(t for i, r in enumerate(runs) if best >> i & 1 for t in r[1])
    return text, ranked[1][0] - ranked[0][0] if k else 1.0, best != alone, best != by_name


def test_whole_pages_against_all_labellings():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    prose = lambda k: " ".join(word() + rng.choice(["", "", "", ",", "."]) for _ in range(k)) + "."

    def bit(deep=0):
        kind = rng.randrange(8)
        if kind == 0 and deep < 3:
            return f"<div class='{rng.choice(['x', 'widget', 'comment-body', 'comments', 'entry-content', 'on-ads-and-news'])}'>{''.join(bit(deep + 1) for _ in range(rng.randrange(1, 3)))}</div>"
        if kind == 1:
            return "<ul>" + "".join(f"<li><a href='x'>{word()}</a></li>" for _ in range(rng.randrange(1, 5))) + "</ul>"
        return rng.choice([lambda: f"<p>{prose(rng.randrange(20, 90))}</p>", lambda: f"<div><p>{prose(4)}</p></div>", lambda: f"<section><p><b>{word()}</b> {prose(12)}</p></section>", lambda: f"<h1>{word()} {word()}</h1>", lambda: f"<div><a href='x'>{word()} {word()}</a> {word()}</div>"])()

    w = html_extract.train([r for _ in range(30) for r in html_extract.examples(f"<nav><ul><li><a href='x'>{word()}</a></li></ul></nav><article><p>{prose(40)}</p><p>{prose(9)}</p></article><footer>{word()} {word()}</footer>")])
    cut = other = seen = 0
    for n in range(150):
        inner = "".join(bit() for _ in range(rng.randrange(0, 6)))
        page = f"<nav>{word()}</nav><article>{inner}</article>{bit()}" if n % 3 == 0 else f"<div>{inner}</div>{bit()}{bit()}"
        text, gap, by_cut, unlike_names = brute_page(page, w)
        if gap > 1e-9:
            assert html_extract.main_text(page, w) == text, page
            seen, cut, other = seen + 1, cut + by_cut, other + unlike_names
    assert seen > 140 and cut > 10 and other > 60  # the cut, and text and neighbours against tags and names, decide


def test_comments_go_and_articles_stay_whatever_their_names():
    w = np.array(html_extract.PRIOR)
    for name in ("commentlist", "kommentare", "article-comments", "comments-area", "leftsidebar"):
        page = f"<article><p>{LONG}</p><p>{LONG}</p><ol class='{name}'><li><p>{LONG} Said a reader.</p></li><li>Me too, indeed.</li></ol></article>"
        assert html_extract.main_text(page, w) == f"{LONG} {LONG}", name
    for name in ("on-comments-and-replies", "how-the-menu-was-made", "widget", "header-and-footer-of-an-era"):
        page = f"<nav><a href=x>Home</a></nav><section id='{name}'><p>{LONG * 3}</p><p>{LONG * 4}</p></section><footer>(c)</footer>"
        assert html_extract.main_text(page, w) == f"{LONG * 3} {LONG * 4}", name


@pytest.mark.parametrize("unit, n", [("<div>a ", 50_000), ("<b>a ", 50_000), ("<p><b>a", 50_000), ("<button>a ", 50_000), ("<li>x<ul>", 50_000), ("<option>a<select>", 50_000), ("<td><i>a", 50_000), ("</div></b>a<div>", 50_000)])
def test_deep_and_unclosed_elements_take_linear_time(unit, n):
    import time
    import tracemalloc

    page = "<article>" + unit * n
    tracemalloc.start()
    start = time.time()
    html_extract.main_text(page, np.array(html_extract.PRIOR))
    assert time.time() - start < 30 and tracemalloc.get_traced_memory()[1] < 500_000_000
    tracemalloc.stop()


def test_very_long_pages_end_soon(spark):
    import time

    page = "".join(f"<div><p>{LONG}</p></div><div class=x{i}><a href=x>link</a></div>" for i in range(10_000))
    start = time.time()
    got = html_extract.extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")).first()
    assert got.text == " ".join([LONG] * 10_000) and time.time() - start < 60
    rng = random.Random(2)
    s, t = [[rng.random() * 0.6 for _ in range(20_000)] for _ in range(2)]
    start = time.time()
    html_extract.min_cut(s, t, [(i - k, i, 0.3) for k in (1, 2) for i in range(k, 20_000)])
    assert time.time() - start < 60


def test_min_cut_against_all_labellings():
    rng = random.Random(0)
    for _ in range(40):
        n = rng.randrange(1, 7)
        s, t = [rng.random() for _ in range(n)], [rng.random() for _ in range(n)]
        e = [(i, j, rng.random()) for i in range(n) for j in range(i) if rng.random() < 0.6]
        cost = lambda m: sum(t[i] if m >> i & 1 else s[i] for i in range(n)) + sum(c for i, j, c in e if (m >> i ^ m >> j) & 1)  # noqa: B023, E731
        got = html_extract.min_cut(s, t, e)
        assert cost(sum(1 << i for i, x in enumerate(got) if x)) == pytest.approx(min(map(cost, range(1 << n))))


def test_encode_matches_the_tokenizer():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    texts = [None, "", "a.b. c,", "!!, x", "don't stop", "İstanbul İ. x", "<|endoftext|> Hi<|startoftext|>there.", "ﬁx ǅ. é, É.", " a b\x1cc\x85d.", "ΟΔΟΣ. ΣΣ", "12.5, 3.", "a.,., b", " lead", "trail \n", "x" * 5000]
    raw, at = packing.encode(pa.array(texts), packing.tokenizer_path())
    for i, t in enumerate(texts):
        assert raw[4 * at[i] : 4 * at[i + 1]] == np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes(), t
    assert re is not None
