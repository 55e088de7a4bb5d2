import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.helpers import AWKWARD, PROSE, awkward, clashing, empty
from tidemark.llm import common, encode, html_extract, langid, mixing, pii, queries
from tidemark.llm.common import written

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home of the site</a></li></ul></nav><div class="cookie-notice">We use cookies and it is for the best of you all.</div>
<article><header><h1>A title &amp; more</h1></header><p>%s<br>Second&nbsp;line.<p>Short.<ul><li>One</li><li>Two</li></ul>
<script>var t="</p><p>not this";</script><!-- nor <p>this --><div class="comments"><p>%s</p></div>
<form><p>Your name and the e-mail of you</p><input></form></article><aside>%s</aside><footer>&copy; Site</footer></body></html>"""


def test_article_without_the_rest():
    text = html_extract.main_text(PAGE % (PROSE, "It was the best comment of all that was in the house.", PROSE))
    assert text == f"A title & more {PROSE} Second line. Short. One Two"


def test_pages_without_landmarks():
    page = f"<div><a href=x>The menu of it</a></div><h2>Head</h2><div>{PROSE} {PROSE}</div><p>Brief.</p><div>{PROSE}</div><p><a href=1>one of the</a> <a href=2>two of the</a></p><p>&copy; all of the rights of it</p>"
    assert html_extract.main_text(page) == f"Head {PROSE} {PROSE} Brief. {PROSE}"


def test_second_pass_takes_nearest_decided_neighbours():
    b = [html_extract.Block("x", 0, False, 0)] * 5
    assert html_extract.second_pass(b, ["good", "short", "short", "short", "bad"]) == [True, True, True, False, False]
    assert html_extract.second_pass(b, ["bad", "near", "short", "bad", "short"]) == [False, False, False, False, False]
    assert html_extract.second_pass(b[:3], ["short", "near", "short"]) == [False, True, False]


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "site-content with-sidebar", "post ad-free", "post comments-open", "single-post social-icons-on", "page legal"])
def test_layout_classes_leave_the_article(name):
    menu = '<div class="sidebar"><a href="/">It is a link to the news of the day</a></div>'
    page = f'<body>{menu}<div class="{name}"><p>{PROSE}</p><p>{PROSE}</p><div class="comments">The best of all.</div></div>{menu}</body>'
    assert html_extract.main_text(page) == f"{PROSE} {PROSE}"


def test_unusual_prose_is_left_to_the_second_pass():
    other = "Talo vanha seisoi kukkulalla kylmänä talvena kaupungin ihmisten tarinoita kuunnellessa tulen äärellä. " * 3
    assert html_extract.main_text(f"<p>{other}</p>") == other.strip()
    short = 'Brief text with <a href="/">one</a> link and more.'
    assert html_extract.main_text(f"<p>{PROSE} {PROSE}</p><p>{short}</p><p>{PROSE} {PROSE}</p>").count("Brief text with one link") == 1


def test_hinted_wrapper_with_most_of_the_text_is_no_hint():
    items = "<ul><li>One</li><li>Two words</li></ul>"
    for name in ("post social", "related", "widget"):
        page = f'<div class="{name}"><h1>Headline</h1><p>{PROSE} {PROSE}</p><p>Short one.</p>{items}<p>{PROSE} {PROSE}</p></div><div class="{name}"><p>Read this too, it is the best.</p></div>'
        assert html_extract.main_text(page) == f"Headline {PROSE} {PROSE} Short one. One Two words {PROSE} {PROSE}"


def test_comments_longer_than_the_article_go():
    remarks = "".join(f"<p>{PROSE}</p>" for _ in range(9))
    for open_tag in ('<section id="comments">', '<div class="post-comments">', '<ol class="commentlist">', '<div id="respond">', '<div id="disqus_thread">', '<div class="replies list">'):
        assert html_extract.main_text(f"<div><p>{PROSE} {PROSE}</p><p>{PROSE}</p></div>{open_tag}{remarks}") == f"{PROSE} {PROSE} {PROSE}"
    inside = f'<div class="comments"><article><p>{PROSE} {PROSE}</p></article></div>'
    assert html_extract.main_text(inside) == f"{PROSE} {PROSE}"


def test_copyright_sign_in_prose():
    marked = PROSE.replace("the old man", "the old man (photo \N{COPYRIGHT SIGN} by him)")
    other = "Talo vanha seisoi kukkulalla kylmänä talvena kaupungin ihmisten tarinoita kuunnellessa."
    assert html_extract.main_text(f"<p>{other}</p><p>{marked}</p><p>{other}</p>") == f"{other} {marked} {other}"
    assert html_extract.main_text(f"<p>{PROSE} {PROSE}</p><p>© 2020 Company, no rights, all reserved. Privacy policy statement page here.</p>") == f"{PROSE} {PROSE}"


def test_pages_without_a_decided_block_keep_their_largest_run():
    short = [f"It was sentence number {k} of the old story." for k in range(12)]
    assert html_extract.main_text("".join(f"<p>{s}</p>" for s in short)) == " ".join(short)
    chinese = ["老房子在山上，冬天很冷，但是镇上的人们来看他，听他讲故事。", "他们坐在火边直到深夜，然后各自回家去了。"]
    menu = '<p><a href="/">首页</a> <a href="/2">新闻</a></p>'
    assert html_extract.main_text(menu + "".join(f"<p>{s}</p>" for s in chinese) + menu + "<p>联系</p>") == " ".join(chinese)


def test_linked_paragraph_of_an_article():
    link = '<p><a href="/x">The whole report of the day</a></p>'
    assert html_extract.main_text(f"<article><p>{PROSE}</p>{link}<p>{PROSE}</p></article>") == f"{PROSE} The whole report of the day {PROSE}"
    assert html_extract.main_text(f"<article><p>{PROSE}</p>{link}{link}<p>{PROSE}</p>{link}</article>") == f"{PROSE} {PROSE}"


def test_depth_and_thresholds():
    deep = f"<p>{PROSE} {PROSE}" + "<b>" * 40 + " end" + f"<div>{PROSE} {PROSE}</div>"
    assert [b.text for b in html_extract.blocks_of(deep)[0]] == [f"{PROSE} {PROSE} end", f"{PROSE} {PROSE}"]
    block = [html_extract.Block("y" * 60, 0, False, 0)]
    assert html_extract.second_pass(block, ["short"]) == [False]
    assert html_extract.second_pass(block, ["short"], html_extract.Rules(long=50)) == [True]


@pytest.mark.parametrize("html", [
    "<b>" * 40_000 + "</i>" * 40_000, '<div class="menu">x' * 40_000, "<!" * 200_000, "<p>" * 100_000, "<b>" * 60_000 + "<div>x" * 60_000, "</p>" * 100_000, "<a \"" * 100_000, "<x '" * 100_000])
def test_time_grows_with_the_length(html):
    import time

    begin = time.process_time()
    html_extract.main_text(html)
    assert time.process_time() - begin < 4


@pytest.mark.parametrize("html", [None, "", "<", "<<<", "<p", "</p>", "<!--", "<script>x", "a" * 10_000, "<div " * 5000, "<b>" * 5000, '<a href="x>', "&#xD800;&bogus;&#99999999;"])
def test_broken_pages(html):
    assert isinstance(html_extract.main_text(html), str)


def test_extract(spark, sf):
    pages = spark.createDataFrame([(1, "u", PAGE % (PROSE, PROSE, PROSE)), (None, None, None), (2, "v", "")] * 2, "page_id long, url string, html string")
    rows = html_extract.extract(pages.withColumn("text", pages.url).withColumn("n_chars", pages.url)).collect()
    assert len(rows) == 6 and sorted({r.n_chars for r in rows})[0] == 0
    assert html_extract.extract(pages.where("false")).count() == 0
    for r in queries.op1_html_extraction(spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S).group(1)
        want = " ".join(__import__("html").unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert r.text == want and r.n_chars == len(want)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii._luhn(digits)) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_exact_spans_equal_plain_patterns():
    import random

    rng = random.Random(2)
    texts = ["a@b.co_x@y.com", "x@y@z.com", "1.2.3.4.5.6.7.8", "001.02.3.255 256.1.1.1", "4111 1111 1111 1111", "+1 (407) 555-7710 x", "+12", "9" * 5000, "@" * 500, "a." * 2000 + "@b.c"]
    texts += ["".join(rng.choice("ab1@.-_+ 0.9(5)4\n") for _ in range(rng.randint(1, 40))) for _ in range(5000)]
    for t in texts:
        assert pii.base_spans(t) == plain_spans(t)


def test_learned_spans(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    weights = pii.learn(docs)
    found = pii.find(awkward(spark), weights, ["doc_id"]).collect()
    assert len(found) == len(AWKWARD) and {r.spans for r in found} == {""}
    text = 'my token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" or +1 (407) 555-7710, see 2123465659789240'
    base, every = pii.spans_of(text, weights)
    assert [s[0] for s in base] == ["phone"] and [s[0] for s in every] == ["phone", "secret"]
    assert pii.masked(text, every).startswith('my token = "[SECRET]" or [PHONE], see')
    kept = pii.mask(awkward(spark), weights)
    assert kept.columns == awkward(spark).columns and kept.where("doc_id = 1").first().n_chars == len(PROSE)
    assert not pii.learn(empty(spark)).any() and pii.find(empty(spark), weights, []).count() == 0


def test_long_keys_are_whole_candidates(spark, sf):
    import random

    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    weights = pii.learn(spark.read.parquet(f"{sf}/documents.parquet"))
    for size in (512, 513, 716, 5000):
        key = "".join(rng.choice(letters) for _ in range(size))
        text = f'my key = "{key}" and more'
        assert pii.candidates(text, []) == [("secret", 10, 10 + size)]
        assert pii.masked(text, pii.spans_of(text, weights)[1]) == 'my key = "[SECRET]" and more'


def test_added_spans_never_overlap_exact_ones():
    text = "see 12345678901 and 22345678901 or 32345678901 and " + "9" * 60
    taken = [("x", 0, 12)] + [("x", k, k + 1) for k in range(1, 12)] + [("y", 20, 20)]
    assert [text[a:b] for _, a, b in pii.candidates(text, taken)] == ["22345678901", "32345678901", "9" * 60]
    assert pii.candidates(text, [("x", 0, len(text))] + [("y", k, k + 1) for k in range(len(text))]) == []


def test_em_finds_the_reliable_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = {}
    for t in truth:
        code = "".join("1" if (t if rng.random() < q else not t) else "0" for q in (0.95, 0.9, 0.8, 0.55, 0.5, 0.5)) + "-"
        votes[code] = votes.get(code, 0) + 1
    true_rate, false_rate, share, posterior = pii.estimate(votes)
    assert abs(true_rate[0] - 0.95) < 0.03 and abs(false_rate[0] - 0.05) < 0.03 and abs(share - 0.4) < 0.04
    assert abs(true_rate[4] - 0.5) < 0.05 and posterior["111000-"] > 0.9 > 0.1 > posterior["000111-"]


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        unit = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if unit * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else unit * weight[s] for s in names}
        full |= over


def test_mix(spark, sf):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), awkward(spark)):
        rows = mixing.mix(docs).collect()
        assert len(rows) == docs.count()
        sizes, taken = {}, {}
        for r in rows:
            sizes[r.source] = sizes.get(r.source, 0) + r["size"]
            taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
            assert 0 <= r.copies <= 3
        want = plain_targets(sizes)
        for r in rows:
            assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
            if r.source_size:
                assert r.rate * r.source_size == pytest.approx(r.target, rel=1e-9, abs=1e-9)
        for s in sizes:
            longest = max(r["size"] for r in rows if r.source == s)
            shortest = min(r["size"] for r in rows if r.source == s and r["size"]) if sizes[s] else 0
            assert abs(taken[s] - want[s]) <= (longest if len(rows) < 50 else max(shortest, 0.05 * want[s]))
        again = mixing.mix(docs.repartition(3))
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        again = sorted(((r.doc_id, r["size"], r.copies) for r in again.collect()), key=str)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        assert again == sorted(((r.doc_id, r["size"], r.copies) for r in rows), key=str)
    assert mixing.mix(empty(spark)).count() == 0
    took = mixing.take(awkward(spark))
    assert took.columns == awkward(spark).columns


def plain_kneser_ney(texts: list[str]) -> Callable[[str, str], float]:
    """Interpolated Kneser-Ney of one language by the book: p(character | three before it)."""
    grams = [("\1" * 3 + t)[k : k + 4] for t in texts for k in range(len(t))]
    counts = {4: Counter(grams)}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])  # different longer grams

    def p(context: str, c: str) -> float:
        n = len(context) + 1
        rare = [sum(v == k for v in counts[n].values()) for k in (1, 2)]
        d = min(0.9, max(0.1, rare[0] / (rare[0] + 2 * rare[1]))) if sum(rare) else 0.5
        follow = {g: v for g, v in counts[n].items() if g[:-1] == context}
        lower = p(context[1:], c) if context else 1 / plain_kneser_ney.alphabet
        if not follow:
            return lower
        return (max(follow.get(context + c, 0) - d, 0) + d * len(follow) * lower) / sum(follow.values())

    return p


def packed(gram: str) -> int:
    return sum(ord(c) << (16 * (3 - k)) for k, c in enumerate(gram))


@pytest.mark.parametrize("file", [langid.FILE, 8])
def test_models_equal_plain_kneser_ney(spark, monkeypatch, file):
    monkeypatch.setattr(langid, "FILE", file)  # 8: many files of each order
    texts = {"aa": ["abab abba baab", "bab a", "bab a"], "bb": ["cdcd dcdc ccdd a", "b"], "cc": ["abcab cabba bcaab ccba"] * 3}
    rows = [(k, t, lang) for lang, some in texts.items() for k, t in enumerate(some)]
    models = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    plain_kneser_ney.alphabet = len(set("".join(t for _, t, _ in rows))) + 1
    assert models.langs == sorted(texts) and (file > 8 or len(models.levels[4].files) > 4)
    for k, lang in enumerate(models.langs):
        plain = plain_kneser_ney(texts[lang])
        for context in ("abb", "zzz", "cdc", "\1\1\1", " ca", "bb ", "\1\1b"):
            p = np.exp(models.log_probabilities(np.array([packed(context + c) for c in "abcd q"], np.uint64)))[:, k]
            assert np.allclose(p, [plain(context, c) for c in "abcd q"], rtol=1e-4), (lang, context)
            assert abs(p.sum() - 1) < 1e-3
        entropy, n = models.cross_entropy(["abba cab"])
        want = -sum(np.log(plain(("\1" * 3 + "abba cab")[i : i + 3], "abba cab"[i])) for i in range(8)) / 8
        assert n[0] == 8 and entropy[0, k] == pytest.approx(want, rel=1e-4)


def test_models_keep_all_grams_of_many_languages(spark, monkeypatch):
    import pickle
    import random

    monkeypatch.setattr(langid, "FILE", 10_000)
    rng = random.Random(1)
    rows, seen = [], 0
    for k in range(100):
        letters = [chr(0x4E00 + 40 * k + j) for j in range(30)]
        text = "".join(rng.choice(letters) for _ in range(1100))
        rows.append((k, text, f"l{k:02}"))
        seen += len(np.unique(langid.grams_of([text])[0]))
    models = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert models.levels[4].size == seen > 100_000 and len(models.levels[4].files) > 8
    assert len(pickle.dumps(models)) < 20_000  # what the driver sends: names of files, not grams
    names, _, odd = models.judge([t for _, t, _ in rows], 8.0)
    assert names == [lang for _, _, lang in rows] and not odd.any()


def test_all_training_texts_calibrate_the_models(spark):
    import random

    rng = random.Random(5)
    letters = {"aa": "abcde ", "bb": "defgh ", "cc": "hijkl "}
    rows = [(k if k % 9 else None, "".join(rng.choices(letters[lang], k=rng.randrange(60))), lang)
            for k in range(3_000) for lang in letters]
    models = langid.learn(spark.createDataFrame(rows + rows[:500], "doc_id long, text string, lang string").repartition(3))
    rows = sorted(set(rows), key=str)  # rows that repeat are one
    entropy, n = models.cross_entropy([t for _, t, _ in rows])
    truth = np.array([models.langs.index(lang) for *_, lang in rows])
    for k in range(3):
        x, length = entropy[(truth == k) & (n > 0), k], n[(truth == k) & (n > 0)]
        square = (x - np.median(x)) ** 2
        assert models.centre[k] == pytest.approx(np.median(x), rel=1e-9)
        assert models.between[k] == pytest.approx(max(square[length >= np.median(length)].mean(), 1e-4), rel=1e-6)
        assert models.within[k] == pytest.approx(max((square * length).mean(), 0.5), rel=1e-6)
    gap = -(entropy - entropy.min(axis=1, keepdims=True)) * np.minimum(n, 30)[:, None]
    losses = [(np.log(np.exp(gap * s).sum(axis=1)) - gap[np.arange(len(gap)), truth] * s).mean() for s in langid.SHARP]
    assert models.sharp == langid.SHARP[int(np.argmin(losses))]


def test_counting_holds_few_grams_of_many_languages(spark, monkeypatch):
    rows = [(f"{a}{b}{a} {b}", f"l{k}") for k in range(40) for a in "abc" for b in "xyz"]
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    want = sorted(langid.count_grams(docs).collect())
    monkeypatch.setattr(langid, "HELD", 30)
    monkeypatch.setattr(langid, "_grams", lambda texts, grams=langid._grams: grams(texts, 10))
    assert sorted(langid.count_grams(docs).collect()) == want


def test_a_worker_keeps_what_one_step_needs(spark):
    models = langid.learn(spark.createDataFrame([(1, "abab abba", "aa"), (2, "cdcd", "bb")], "doc_id long, text string, lang string"))
    models.judge(["abba"], 8.0)
    path = queries.tokenizer_file("byte_bpe_50k.json")
    first = encode.encoder(path)
    assert encode.encoder(path) is first and list(common._KEPT) == ["encoders"]  # no model
    names, *_ = models.judge(["abba", "dcd"], 8.0)
    assert names == ["aa", "bb"] and len(common._KEPT) == 1 and encode.encoder(path) is not first


def test_folding_and_independence_of_neighbours():
    alone, _ = langid.grams_of(["Ab  c!1"])
    both, counts = langid.grams_of(["x y", "Ab  c!1", ""])
    assert counts.tolist() == [3, 5, 0] and (both[3:8] == alone).all()
    assert [chr(int(g) & 0xFFFF) for g in alone] == ["a", "b", " ", "c", " "]


def test_language_id(spark, sf):
    rows = queries.op10_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    models = langid.learn(spark.read.parquet(f"{sf}/documents.parquet"))
    out = {r.doc_id: r for r in langid.identify(awkward(spark).drop("rejected", "lang_pred", "score"), models, ["doc_id"]).collect()}
    assert out[3].lang_pred == out[4].lang_pred == out[5].lang_pred == "und" and out[3].score == 0.0 and out[3].rejected
    assert out[1].lang_pred == "en" and all(0 <= r.score <= 1 for r in out.values())
    kept = langid.accept(awkward(spark), models)
    assert kept.columns == awkward(spark).columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in langid.identify(
        awkward(spark).drop("rejected"), models, ["doc_id"]).where("not rejected").collect())
    none = langid.learn(empty(spark))
    assert none.langs == [] and langid.identify(awkward(spark), none, ["doc_id"]).where("lang_pred <> 'und'").count() == 0


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), name)
        counts.append(docs.count())
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "pii":
            assert docs.where("text like '%@mail_.example%'").count() == 0
    assert counts[0] >= counts[1] == counts[2] and counts[4] >= counts[3]
    assert corpus_pipeline.run(spark, sf).count() == counts[-1]


def test_pipeline_stages_take_awkward_tables(spark):
    rows = clashing(spark)
    for source in (rows, rows.where("false"), rows.select("doc_id", "text", "lang", "source", "n_chars")):
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, source, ""), name)
            if name != "best_fit_packing":
                assert out.columns == source.columns
                assert out.count() >= 1 or source is not rows
            else:
                assert (out.count() == 0) == source.isEmpty()


def test_cut_texts_have_the_grams_of_whole_ones():
    texts = ["Ab  c!1 de" * 7, "", " . .", None and "", "xyz", "a" + " " * 30 + "b" * 9]
    texts = [t or "" for t in texts]
    for chars in (1, 2, 3, 7, 40):
        got = [[] for _ in texts]
        for owner, grams, counts in langid._grams(texts, chars):
            for k, part in zip(owner.tolist(), np.split(grams, np.cumsum(counts)[:-1])):
                got[k] += part.tolist()
        assert got == [langid.grams_of([t])[0].tolist() for t in texts], chars
