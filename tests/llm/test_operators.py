"""Brute force, round trips and defined cases of the ten operators."""

import math
import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
import sentencepiece as spm

from tickerloom.llm import htmlmain, langid, licenses, mixing, neardup, quality, sentencepieces, topk, toxicity, urlfilter

from .conftest import ODD


def by_id(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["doc_id"]].append(r)
    return out


# 1 SentencePiece


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepieces.load_vocabulary()


TEXTS = ["", "a", " a", "  a  ", "\n\n x", "emoji 😀 é ñ", "tab\tx", "\x00a", "     ", "a" * 3000, " " * 3000, "日本語テキスト", "The and attion to thanedble the, anea."]


def test_no_dropout_equals_library(vocabulary):
    model = spm.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    flat, counts = sentencepieces.encode(TEXTS, list(range(len(TEXTS))), vocabulary)
    ends = np.cumsum(counts)
    assert [flat[e - n:e].tolist() for e, n in zip(ends, counts)] == [model.encode(t) for t in TEXTS]


def test_side_by_side_equals_heap(vocabulary, monkeypatch):
    limit = 2**31
    together = sentencepieces.encode(TEXTS, [7] * len(TEXTS), vocabulary, limit)
    monkeypatch.setattr(sentencepieces, "LONG_CHUNK", 0)
    alone = sentencepieces.encode(TEXTS, [7] * len(TEXTS), vocabulary, limit)
    assert together[0].tolist() == alone[0].tolist() and together[1].tolist() == alone[1].tolist()


def test_dropout_is_lossless_varied_and_repeatable(vocabulary, documents):
    docs = documents([*ODD, (20, "thandation " * 40), (21, "thandation " * 40), (22, "literal ▁ sign ▁▁ x")])
    plain, first, again = (sentencepieces.encode_documents(docs, vocabulary, ("doc_id", "text"), dropout=d, verify=True) for d in (0.0, 0.2, 0.2))
    rows = first.collect()
    assert sorted(map(str, rows)) == sorted(map(str, again.collect()))
    assert all(r.lossless == (r.text is not None) and (r.ids is None) == (r.text is None) for r in rows)
    ids = {r.doc_id: r.ids for r in rows}
    assert ids[20] != ids[21] and len({tuple(ids[20][i:i + 3]) for i in range(len(ids[20]))}) > 10
    assert sum(r.n_ids for r in rows) > sum(r.n_ids for r in plain.collect())
    back = {r.doc_id: r.text for r in sentencepieces.decode_documents(first.select("doc_id", "ids"), vocabulary).collect()}
    assert back[7] == ODD[8][1] and back[22] == "literal ▁ sign ▁▁ x" and back[1] is None and back[2] == ""


# 2 mixing


def test_mix_reaches_targets_and_repeats(documents):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 400), None, rng.choice(["a", "b", "b", "b", "ä", None])) for i in range(400)]
    docs = documents(rows + [(1, "w " * 9, None, "b"), (None, None, None, "c"), (None, "x y", None, None)])
    out = mixing.mix(docs, ("doc_id", "source"), shard_words=500)
    got = out.collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs, ("doc_id", "source"), shard_words=500).collect()))
    assert len(got) == 403 and all(0 <= r.taken <= 2 * r["size"] for r in got)
    for source in ("a", "b", "ä", "c", None):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 64 * (1 + mine[0].source_size / 500)
        assert mine[0].source_size == sum(r["size"] for r in mine)


def test_targets_fill_like_the_written_rule(spark):
    sizes = {"a": 100, "b": 1000, "c": 50, "d": 400, "e": 10, None: 300}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = ["a", "b", "c", "d", "e", None]
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    target, closed, rest = {}, set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [n for n in names if n not in closed]
        share = {n: (rest - sum(target[c] for c in closed)) * weight[n] / sum(weight[o] for o in open_) for n in open_}
        above = [n for n in open_ if share[n] > 2 * sizes[n]]
        if not above:
            target.update(share)
            break
        closed.update(above)
        target.update({n: 2.0 * sizes[n] for n in above})
    assert got == pytest.approx(target)


def test_apportion_is_sainte_lague(spark):
    rng = random.Random(5)
    votes = [(f"p{i}", float(rng.randint(0, 1000)), 137) for i in range(40)] + [("hot", 50_000.0, 137)]
    got = {r.name: r.quota for r in mixing.apportion(spark.createDataFrame(votes, "name string, v double, seats long"), [], "seats", "v", ["name"]).collect()}
    quotients = sorted(((-v / (2 * j - 1), n) for n, v, _ in votes for j in range(1, 140)))[:137]
    want = Counter(n for _, n in quotients)
    assert got == {n: want[n] for n, _, _ in votes}


def test_drawn_documents_are_what_is_taken(documents):
    docs = documents([(i, " ".join(f"w{i}_{j}" for j in range(5 + i % 40)), "en", f"s{i % 3}") for i in range(200)])
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    drawn = mixing.drawn_documents(docs).collect()
    assert Counter(r.doc_id for r in drawn for _ in r.text.split()) == Counter({k: v for k, v in taken.items() if v})
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text in whole[r.doc_id] and r.n_chars == len(r.text) for r in drawn)


# 3 top-k


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 5) / 8]) for i in range(0, 900)]
    rows += [(100, rows[100][1]), (950, None), (951, [1.0, None, 0.0, 0.0, 0.0]), (952, [math.nan] * 5), (953, [math.inf] * 5), (None, [0.5] * 5), (1000, [1e200] * 5), (1100, [1.0, 2.0]), (1101, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS rank").repartition(7)
    got = defaultdict(list)
    for r in topk.search(df, df.where("vec_id % 100 = 0"), block_bytes=200).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    for q in {i for i, v in good if i is not None and i % 100 == 0}:
        mine = next(v for i, v in good if i == q)
        scored = [(-min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(mine, v)))), math.inf if i is None else i) for i, v in good if i != q and len(v) == len(mine)]
        want = [(n + 1, None if i == math.inf else i, -s) for n, (s, i) in enumerate(sorted(scored)[:10])]
        assert sorted(got[q]) == want, q
    assert topk.search(df.where("false"), df.where("false")).count() == 0


# 4 licences


def test_licences_are_found_whole_and_changed(documents):
    words = "alpha beta gamma delta " * 50
    rows = [
        (1, words + "Licensed under the Apache License, Version 2.0. " + words),
        (2, "RELEASED under the\n MIT   license!"),
        (3, words), (4, None), (5, ""),
        (6, words + licenses.TEMPLATES["GPL header"].replace("redistribute", "share").replace("General ", "") + words),
        (7, "Licensed under the Apache License, Version 2.0 x y z Licensed under the Apache License, Version 2.0"),
        (8, "ÄÖ İ Released under the MIT License"), (8, "ÄÖ İ Released under the MIT License"),
    ]
    found = by_id(licenses.scan(documents(rows)).collect())
    text = dict(rows)
    assert [(r.license, r.coverage) for r in found[1]] == [("Apache-2.0", 1.0)]
    assert text[1][found[1][0].start_char:found[1][0].end_char] == "Licensed under the Apache License, Version 2.0"
    assert text[8][found[8][0].start_char:found[8][0].end_char] == "Released under the MIT License" and len(found[8]) == 2
    assert found[2][0].license == "MIT" and 3 not in found and 4 not in found and 5 not in found
    assert found[6][0].license == "GPL header" and 0.9 < found[6][0].coverage < 1
    assert len(found[7]) == 2
    assert licenses.scan(documents([])).count() == 0


def test_whole_licences_are_found_by_name(documents):
    words, texts = "alpha beta gamma delta " * 20, licenses.bodies()
    rows = [(i, words + texts[name] + words) for i, name in enumerate(texts)]
    cut = {"GPL-3.0 text": 17, "Apache-2.0 text": 13, "BSD-3-Clause text": 23, "Unlicense text": 11}
    rows += [(1000 + i, " ".join(w for k, w in enumerate(texts[name].split()) if k % cut[name])) for i, name in enumerate(cut)]
    found = by_id(licenses.scan(documents(rows)).collect())
    for i, name in enumerate(texts):
        assert [(r.license, r.coverage) for r in found[i]] == [(name, 1.0)], name
        assert found[i][0].start_token == 80 and len(dict(rows)[i]) - found[i][0].end_char < len(words) + 5, name
    for i, name in enumerate(cut):
        assert [r.license for r in found[1000 + i]] == [name] and 0.85 < found[1000 + i][0].coverage < 1
    for i, (name, text) in enumerate(licenses.headers().items()):
        assert [r.license for r in licenses_of(text)] == [name]


def licenses_of(text):
    index = licenses.build_index(licenses.TEMPLATES | licenses.bodies())
    ids = np.array([index.known.get(w, 0) for w in licenses.TOKEN.findall(text.lower())], np.int64)
    places, values = licenses.winnow(ids)
    numbers = np.minimum(np.searchsorted(index.posted, values), len(index.posted) - 1)
    hit = index.posted[numbers] == values
    return [SimpleNamespace(license=r[0], coverage=r[1]) for r in licenses.matches(text, ids, numbers[hit], places[hit], index, licenses.MIN_COVERAGE)]


@pytest.mark.parametrize("text, names", [
    ("Licensed under CC BY-SA 4.0", ["CC-BY-SA-4.0"]), ("Licensed under CC BY 4.0", ["CC-BY-4.0"]), ("Licensed under CC BY-NC 4.0", ["CC-BY-NC-4.0"]), ("Licensed under CC BY-XX 4.0", []),
    ("This work is licensed under the GNU General Public License, version 2", ["GPL-2.0"]), ("This work is licensed under the GNU General Public License, version 3", ["GPL-3.0"]),
    ("This work is licensed under the GNU General Public License, version 7", []), ("Released under the BSD License", ["BSD"]), ("Released under the MIT License", ["MIT"]),
    ("Released under the Foo License", []), ("Licensed under the Apache License, Version 9.0", []),
    (licenses.TEMPLATES["GPL header"].replace("version 3", "version 7"), []), (licenses.TEMPLATES["GPL header"].replace("version 3", "version 2"), ["GPL-2.0 header"]),
    (licenses.TEMPLATES["GPL header"].replace("GNU General", "GNU Lesser General"), ["LGPL-3.0 header"]),
])
def test_sister_licences_are_told_apart(text, names):
    assert [r.license for r in licenses_of("alpha beta " * 9 + text + " gamma" * 9)] == names


# 5 near-duplicates


def brute_components(rows, words, pct):
    sets = {}
    for i, text in rows:
        w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
        n = min(words, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= pct * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed=4):
    """Chains and groups of copies with ever more changes, beside texts of their own."""
    rng = random.Random(seed)
    rows, base = [], None
    for i in range(240):
        if i % 12 == 0:
            base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 30, 60, 120]))]
        text = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            text[rng.randrange(len(text))] = f"x{rng.randint(0, 10**6)}"
        if i % 5 == 0:
            base = text
        rows.append((i, " ".join(text)))
    return rows


def test_near_duplicates_equal_brute_force(documents):
    rows = near_copies() + [(500, None), (501, ""), (502, "one two"), (503, "ONE two"), (504, " \n")]
    got = {r.doc_id: r for r in neardup.near_duplicates(documents(rows), words=4).collect()}
    want = brute_components(rows, 4, 80)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicates_odd_rows(documents):
    got = neardup.near_duplicates(documents([*ODD, (9, "no id here"), (3, "word")])).collect()
    assert len(got) == len(ODD) + 2
    found = by_id(got)
    assert [r.component_id for r in found[None]] == [None] and found[None][0].kept
    assert {r.component_id for r in found[6]} == {6} and {r.component_id for r in found[3] + found[4]} == {3}
    kept = neardup.keep_one(documents([*ODD, (9, "same text " * 5)])).collect()
    assert Counter(r.doc_id for r in kept)[6] == 1 and 9 not in {r.doc_id for r in kept}
    assert neardup.near_duplicates(documents([])).count() == 0


def test_every_coordinate_fills_and_estimates_similarity():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 300):
        one = rng.integers(0, 2**63, n).astype(np.uint64)
        assert (neardup.sketch(one, 160) >> np.uint64(48)).max() < 320
    pool = rng.integers(0, 2**63, 1200).astype(np.uint64)
    a, b = neardup.sketch(pool[:1000], 2000), neardup.sketch(pool[200:], 2000)
    assert abs((a == b).mean() - 800 / 1200) < 0.05


# 6 urls


def test_globs_match_like_regular_expressions():
    import re

    rng = random.Random(1)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?"]) for _ in range(rng.randint(1, 25))) for _ in range(40)]
    urls = ["".join(rng.choice("ab/") for _ in range(rng.randint(0, 14))).encode() for _ in range(300)]
    found = urlfilter.match_all(urlfilter.compile_globs(globs), urls)
    for g, glob in enumerate(globs):
        parts = re.findall(r"\*+|.", glob)
        pattern = "".join("(?s:.*)" if len(p) > 1 else "[^/]*" if p == "*" else "(?s:.)" if p == "?" else re.escape(p) for p in parts)
        assert [bool(re.fullmatch(pattern, u.decode())) for u in urls] == found[:, g].tolist(), glob


def test_url_rules(spark):
    rows = [
        (1, "HTTP://A.Example.ORG/es/1?x#y", "block", "example.org/es/"), (2, "http://xexample.org/es/", "allow", "org/"), (3, "http://org", "allow", None),
        (4, None, "allow", None), (5, "no scheme/de/", "allow", None), (6, "https://www.casino-x.example.net/", "block", None), (7, "http://foo.net/x.org/", "allow", None),
        (8, "http://a.example.org/en/12", "block", "example.org/en/1"), (9, "x://b.com/de/://c.org/", "block", "com/de/"), (10, "http://a.net/" + "z" * 50_000 + "/ads/", "block", None),
        (11, "http://spam.net", "block", None), (11, "http://spam.net", "block", None),
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u, _, _ in rows], "page_id long, url string, verdict string, host string")
    got = sorted((r.page_id, r.verdict, r.rule) for r in urlfilter.judge(pages).collect())
    assert [(i, v, r) for i, _, v, r in rows] == got
    assert urlfilter.judge(pages.where("false")).count() == 0


# 7 pages


def test_main_text_leaves_furniture_out():
    html = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><header><h1>Site</h1></header>"
        "<nav><ul><li><a href=/>Menu</a></ul></nav><!-- ad --><div class='cookie-notice'>Cookies</div><aside>Side</aside>"
        "<article><h1>Tit&amp;le &copy</h1><p><b>Open\n bold<br>x<p>Two &lt;b&gt;</p><div class=ad>Buy</div><form><p>Form</p></form><ul><li>one<li>two</ul>tail"
        "<section id=comments><p>Nice</p></section></article><footer>F</footer>"
    )
    assert htmlmain.main_text(html) == "Tit&le ©\nOpen bold x\nTwo <b>\none\ntwo\ntail"
    assert htmlmain.main_text("<p>a<p>b <i>c</i>") == "a\nb c" and htmlmain.main_text(None) == "" and htmlmain.main_text("<article") == ""
    assert htmlmain.main_text("<div>" * 5000 + "deep") == "deep"


@pytest.mark.parametrize("name", ["overflow-hidden", "md:hidden", "has-sidebar", "no-sidebar", "with-comments", "search-results", "hidden md:block", "ads-free"])
def test_fragments_of_names_are_no_furniture(name):
    page = f"<div class='{name}'><article><p>Kept</p></article></div>"
    assert htmlmain.main_text(page) == "Kept" == htmlmain.main_text(page.replace("article", "section"))


@pytest.mark.parametrize("name", ["hidden", "search", "comments", "sidebar"])
def test_names_make_no_furniture_of_articles_and_their_holders(name):
    for page in (f"<div class='{name}'><section id={name}><article><p>Kept</p></article></section></div>", f"<main class={name}><article class={name}><p>Kept</p></article></main>", f"<main id={name}><p>Kept</p></main>"):
        assert htmlmain.main_text(page) == "Kept"
    assert htmlmain.main_text(f"<article><p>Kept</p><div class='x {name}'><p>Gone</p></div></article>") == "Kept"


def test_site_templates_go_and_copied_prose_stays(spark):
    page = lambda i: f"<body><div>Our site since 1999</div><article><p>Same prose.</p><div><a href=/>Share it</a></div><p>Own {i}</p></article><div>Bye</div></body>"
    plain = lambda i: f"<body><div>Our site</div><div><span>Own {i}</span></div></body>"
    rows = [(i, "http://a.b/x", page(i)) for i in range(12)] + [(100 + i, "http://c.d/x", plain(i)) for i in range(12)]
    rows += [(200, "http://e.f/", plain(1)), (201, None, None), (202, "http://a.b/", None), (202, "http://a.b/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "'x' AS host", "1 AS n_chars")
    got = {r.page_id: r for r in htmlmain.extract(pages).collect()}
    assert got[3].text == "Same prose.\nOwn 3" and got[3].n_chars == len(got[3].text)
    assert got[104].text == "Own 4" and got[200].text == "Our site\nOwn 1" and got[201].text == "" == got[202].text
    assert htmlmain.extract(pages.where("false")).count() == 0


def test_templates_with_prose_go_where_no_article_is_marked(spark):
    menu, foot = "<div class=x1><ul><li>Home</li><li>News</li></ul></div>", "<div><p>All rights reserved</p></div>"
    page = lambda body: f"<body>{menu}<div><h1>Title {body}</h1><p>Text {body}</p><table><tr><td>1</td><td>of {body}</td></tr></table></div>{foot}</body>"
    copied = [(100 + i, "http://a.b/copy", page("copied")) for i in range(12)]
    rows = [(i, "http://a.b/x", page(f"own {i}")) for i in range(12)] + copied + [(200 + i, "http://c.d/x", page("everywhere")) for i in range(12)]
    got = {r.page_id: r.text for r in htmlmain.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Title own 3\nText own 3\n1\nof own 3" and got[103] == "Title copied\nText copied\n1\nof copied"
    assert "Title everywhere\nText everywhere\n1\nof everywhere" in got[203]


# 8 languages


def test_code_lengths_are_those_of_ppm():
    """Against a direct PPM-C coder with exclusion, byte by byte."""
    corpus = {"x": ["abracadabra abba", "cad"], "y": ["hello hello", "halo"]}
    grams = Counter()
    for lang, texts in corpus.items():
        for t in texts:
            raw = langid.PAD + t.encode()
            for i in range(langid.ORDER, len(raw)):
                grams[lang, raw[i - langid.ORDER:i + 1]] += 1
    langs = np.array([["x", "y"].index(lang) for lang, _ in grams])
    codes = np.array([int.from_bytes(g, "big") for _, g in grams])
    old, langid.MIN_CONTEXT = langid.MIN_CONTEXT, 1
    model = langid.build(["x", "y"], [2, 2], langs, codes, np.array(list(grams.values()), float), 10**6)
    langid.MIN_CONTEXT = old
    counts = {lang: defaultdict(Counter) for lang in corpus}
    every = set()
    for (lang, g), n in grams.items():
        for d in range(langid.ORDER + 1):
            counts[lang][g[langid.ORDER - d:langid.ORDER]][g[-1]] += n
            every.add(g[langid.ORDER - d:langid.ORDER])
    for text in ("abra hello z", "caddab ü"):
        raw = langid.PAD + text.encode()
        for li, lang in enumerate(corpus):
            bits = 0.0
            for i in range(langid.ORDER, len(raw)):
                depth = max(d for d in range(langid.ORDER + 1) if raw[i - d:i] in every and all(raw[i - e:i] in every for e in range(d)))
                out, p = set(), 1.0
                for d in range(depth, -1, -1):
                    seen = {b: n for b, n in counts[lang][raw[i - d:i]].items() if b not in out}
                    if not seen:
                        continue
                    total = sum(seen.values()) + len(seen)
                    if raw[i] in seen:
                        p *= seen[raw[i]] / total
                        break
                    p *= len(seen) / total
                    out |= set(seen)
                else:
                    p /= 256 - len(out)
                bits -= math.log2(p)
            assert model.lengths([text.encode()])[0, li] / langid.UNIT == pytest.approx(bits, abs=1e-3)


def test_slices_lose_nothing(monkeypatch, spark, tables):
    model = langid.learn(spark.read.parquet(f"{tables}/documents.parquet"))
    texts = [b"", b"der hund", b"x" * 900, b"", b"le chat et la"]
    want = [sum(model.lengths([t])[0].tolist()) for t in texts]
    monkeypatch.setattr(langid, "SLICE", 7)
    assert model.lengths(texts).sum(1).tolist() == want


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predict(docs, langid.learn(docs), ("doc_id", "lang")).where(langid.held_out("doc_id")).collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_language_odd_rows(documents, spark, tables):
    model = langid.learn(spark.read.parquet(f"{tables}/documents.parquet"))
    got = by_id(langid.predict(documents(ODD), model).collect())
    assert all(got[i][0].lang_pred == "und" and got[i][0].score == 0 for i in (1, 2, 3, 8))
    assert got[4][0].lang_pred in model.languages and 0 < got[4][0].score <= 1 and got[6][0] == got[6][1]
    assert langid.learn(documents([])) is None and langid.learn(documents(ODD)) is None
    assert {r.lang_pred for r in langid.predict(documents(ODD), None).collect()} == {"und"}


# 9 toxicity


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    got = toxicity.score(docs.join(labels, "doc_id").where(toxicity.held_out("doc_id")), *model, carry=("doc_id", "toxic")).collect()
    hits = Counter((r.toxic, r.predicted) for r in got)
    assert hits[1, 1] >= 0.8 * (hits[1, 1] + hits[1, 0]) and hits[0, 1] <= 0.02 * (hits[0, 0] + hits[0, 1])


def test_toxicity_odd_rows(documents, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents(ODD)
    assert toxicity.learn(docs, none) == ({}, -np.inf)
    got = toxicity.score(docs, *toxicity.learn(docs, none)).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.0} and {r.predicted for r in got} == {0}
    scored = by_id(toxicity.score(docs, {"word": 3.0, "same*": -1.0}, -2.0).collect())
    assert scored[4][0].predicted == 1 and scored[1][0].score == scored[2][0].score and scored[6][0].score < scored[2][0].score


def test_nnpu_separates_from_unlabelled_text_alone():
    rng = np.random.default_rng(0)
    toxic = rng.random(3000) < 0.1
    rows = [[0, *([2] if rng.random() < 0.5 else [])] if t else [1] if rng.random() < 0.5 else [] for t in toxic]
    positive = np.zeros(3000)
    positive[np.flatnonzero(toxic)[:100]] = 1
    weights, intercept = toxicity.train(rows, positive, np.ones(3000), 3, 0.1)
    scores = np.array([1 / (1 + np.exp(-(intercept + sum(weights[i] for i in r)))) for r in rows])
    assert (scores[toxic] > 0.5).all() and (scores[~toxic] < 0.3).all()


# 10 quality


def brute_repeats(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_quality_figures(documents):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(["a ", "b ", "ä ", "c\n", "#", " \t"]) for _ in range(rng.randint(0, 120)))) for i in range(150)]
    got = {r.doc_id: r for r in quality.assess(documents(rows)).collect()}
    for i, text in rows:
        words = [w.decode() for w in text.encode().split()]
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), text.count("#"))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), brute_repeats(words))
        assert r.base_failed == (len(words) < 50 or 100 * r.n_repeat_words > 50 * len(words)) and not (r.base_failed and r.kept)


def test_quality_order_never_changes_the_verdict(documents):
    rows = [(31, " ".join(f"Word{i}" for i in range(60))), (32, " ".join(f"WORD{i}" for i in range(60))), (33, " ".join(f"w{i} |" for i in range(60))), *ODD]
    orders = [list(quality.RULES), list(reversed(quality.RULES)), None]
    got = [Counter((r.doc_id, r.kept) for r in quality.assess(documents(rows), order=o).collect()) for o in orders]
    assert got[0] == got[1] == got[2] and got[0][31, True] == got[0][32, False] == got[0][33, False] == 1
    assert quality.assess(documents([])).count() == 0


def test_quality_order_is_by_rejections_per_cost():
    assert quality.greedy_order({0b001: 10, 0b010: 8, 0b011: 50, 0b100: 9}, [1.0, 1.0, 1.0]) == [0, 2, 1]
    assert quality.greedy_order({0b001: 10, 0b010: 8}, [10.0, 1.0]) == [1, 0]
    assert quality.greedy_order({}, [1.0, 2.0]) == [0, 1]
