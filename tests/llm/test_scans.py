import hashlib
import html
import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from quarrystone.llm import licence_scan, main_text, secret_scan

# ---- secrets
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{a}:{z}" for a, _, z, k in spans)


def test_spans_of_random_texts(spark, tmp_path):
    rng = random.Random(2)
    parts = ["token", "=", " ", ":", '"', "a", "ABCDEFGH", "12", "secret", "apikey", "é", "\n", "AKIA", "AAAA1111", "deadbeef", "😀", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(2000)] + [None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in secret_scan.op6_secrets(spark, str(tmp_path)).collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        count = Counter(k for *_, k in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (count["assign"], count["access"], count["hex"])
        assert set(joined(want).split(",")) - {""} <= set(r.spans.split(","))


def test_secrets_of_edge_rows_and_plan(edge, none):
    found = secret_scan.scan_secrets(edge)
    assert found.where(F.size("secret_spans") > 0).count() == 0
    assert secret_scan.scan_secrets(none).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def python_names():
    import asyncio, ctypes, http.client, logging, socket, ssl, subprocess, unittest  # noqa: E401

    names = set()
    for module in (asyncio, ctypes, http.client, logging, socket, ssl, subprocess, unittest):
        names |= {n for k in dir(module) for n in [k, *dir(getattr(module, k))]}
    return sorted(n for n in names if re.fullmatch("[A-Za-z0-9_]{12,}", n))


def test_models_on_strings_of_other_origin(spark):
    rng = random.Random(77)
    alphabets = ["abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789abcdef"]
    keys = ["".join(rng.choice(rng.choice(alphabets[:1]) if k % 4 == 0 else alphabets[k % 4]) for _ in range(rng.randint(16, 31))) for k in range(800)]
    keys.append("XyZkQpLmWvRtBnHsGfDcJq")
    rows = [(s, 1) for s in keys] + [(s, 0) for s in python_names()]
    df = secret_scan.scan_secrets(spark.createDataFrame(rows, "text string, y int"))
    got = df.select("text", "y", (F.size("secret_spans") > 0).alias("p")).collect()
    model = secret_scan.default_model()
    # the expression sums what the model says
    assert all(r.p == (secret_scan._sum_of(model.rows, r.text) >= model.threshold) for r in got)
    hit, wrong = [r.p for r in got if r.y], [r.p for r in got if not r.y]
    recall, false = sum(hit) / len(hit), sum(wrong) / len(wrong)
    assert recall > 0.9 and false < 0.005 and len(wrong) > 1000, (recall, false)
    assert next(r.p for r in got if r.text == "XyZkQpLmWvRtBnHsGfDcJq")


def test_models_of_given_samples(spark):
    rng = random.Random(8)
    odd = ["".join(rng.choice("pqbd") for _ in range(30)) for _ in range(400)]
    model = secret_scan.fit(odd, ["".join(rng.choice(["mo", "na", "li"]) for _ in range(14)) for _ in range(400)])
    df = spark.createDataFrame([("a pqbdqpbdpqqbdpqdbpqd b",), ("a monalimonalimonalimona b",)], "text string")
    assert [r.secret_spans[0].start if r.secret_spans else None for r in secret_scan.scan_secrets(df, model=model).collect()] == [2, None]


def test_secret_columns_keep_their_names(spark):
    df = spark.createDataFrame([("token=abcdefgh1", 1, 2, 3)], "text string, _tokens int, _base int, match int")
    got = secret_scan.scan_secrets(df)
    assert got.columns == ["text", "_tokens", "_base", "match", "secret_spans"]
    assert tuple(got.first())[1:4] == (1, 2, 3)


def test_redaction_merges_spans(spark):
    df = spark.createDataFrame([("x token=abcdefgh1 y", [(2, 0, 17, "assign")]), ("ab", []), ("abcd", [(0, 0, 2, "a"), (1, 1, 3, "b")])], "text string, secret_spans array<struct<start:int,rank:int,end:int,kind:string>>")
    assert [r.text for r in secret_scan.redact(df).collect()] == ["x [SECRET] y", "ab", "[SECRET]d"]


# ---- licences
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_of(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at, labels = [], set()
    for phrase, label in licence_scan.PHRASES.items():
        p = phrase.split()
        hits = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_phrases_anywhere(spark):
    rng = random.Random(6)
    parts = ["CC", "by", " ", "-", "general", "Public", "license", "\n", "all rights", "reserved", "é", ", ", "the", "0"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 14))) for _ in range(2000)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in licence_scan.scan_licences(df).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(texts[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_licence_spans(spark):
    texts = ["Intro. Released under the MIT\nLicense.", "This work is licensed under the fine GNU General Public License, version 3.", "the license of the work", "under the mit"]
    got = [r for r in licence_scan.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()]
    assert [r.labels for r in got] == ["mit", "gpl,gpl-3.0", "", ""]
    assert [(s.label, s.start_word, s.end_word, s.coverage) for s in got[0].spans] == [("mit", 1, 6, 1.0)]
    assert got[1].spans[0].start_word == 0 and got[1].spans[0].end_word == 13


def test_automaton_against_all_factors():
    rng = random.Random(1)
    seqs = [[rng.randrange(3) for _ in range(rng.randint(1, 9))] for _ in range(5)]
    sam = licence_scan.SuffixAutomaton(seqs)
    factors = {tuple(s[a:b]) for s in seqs for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    text = [rng.randrange(4) for _ in range(300)]
    for start, n, state in sam.matches(text, 1):
        assert tuple(text[start : start + n]) in factors
        assert start + n == len(text) or tuple(text[start : start + n + 1]) not in factors
        for number, ends in sam.ends[state].items():
            places = {e for e in range(n - 1, len(seqs[number])) if seqs[number][e - n + 1 : e + 1] == text[start : start + n]}
            assert set(ends) == places and places
    longest = max((b - a for a in range(300) for b in range(a + 1, min(300, a + 10) + 1) if tuple(text[a:b]) in factors), default=0)
    assert max(n for _, n, _ in sam.matches(text, 1)) == longest


def test_spans_of_planted_licences():
    rng = random.Random(19)
    # a template that holds a phrase twice, and one that shares words with it
    templates = [("twice", "we grant the right to copy it and we grant the right to sell it to all"), ("other", "the right to copy is kept by us and by nobody else")]
    scanner = licence_scan.LicenceScanner(templates, {}, 3, 8, 0.8)
    for _ in range(200):
        words, want = [], []
        for _ in range(rng.randint(1, 4)):
            words += [f"w{rng.randrange(99)}" for _ in range(rng.randint(9, 14))]
            t = rng.randrange(2)
            planted = templates[t][1].split()
            if rng.random() < 0.5:  # up to two words between, where a match of three is left on both sides
                at = rng.randrange(3, len(planted) - 3)
                planted = planted[:at] + ["x1", "x2"][: rng.randint(1, 2)] + planted[at:]
            want.append((templates[t][0], len(words), len(words) + len(planted)))
            words += planted
        words += ["end"] * 9
        got = scanner.scan(pa.array([" ".join(words)]))["spans"][0]
        assert [(s["label"], s["start_word"], s["end_word"]) for s in got] == want
        assert all(s["coverage"] == 1.0 for s in got)


def test_whole_licences_are_told_apart(spark):
    licences = licence_scan.whole_licences()
    rows = [(k, f"Copyright 2020 someone. {text} End of it.") for k, (_, text) in enumerate(licences)]
    got = {r.doc_id: r for r in licence_scan.scan_licences(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(licences) >= 15
    for k, (label, text) in enumerate(licences):
        assert label in got[k].labels.split(",") and got[k].score == 1.0
        span = next(s for s in got[k].spans if s.label == label and s.coverage == 1.0 and s.end_word - s.start_word >= len(text.split()))
        assert span.start_word == 3


def test_licences_of_edge_rows(edge, none):
    assert licence_scan.scan_licences(edge).count() == edge.count()
    assert licence_scan.scan_licences(none).count() == 0


# ---- pages
def test_pages_of_a_table(spark, small):
    def article(page):
        inner = re.search(r"<article>(.*)</article>", page, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        return "\n\n".join(b for b in blocks if b)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in main_text.op5_main_text(spark, small).collect():
        assert r.text == article(pages[r.page_id]) and r.n_chars == len(r.text)


def test_what_is_no_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a>Home</a></nav>
    <aside>Aside words here</aside><div class="cookie-notice">We use cookies a lot on this page</div>
    <main><header><h1>Title &amp; more</h1><p>By line</p></header><p>First  paragraph\n with enough words to count.</p>
    <form><p>Name</p><input></form><p>Second<br>line &#233;.</p><div class="ad">Buy now</div><script>var x = "</p>";</script>
    <section id="comments"><p>Nice post, says a reader</p></section><ul><li>a<li>b</ul></main><footer>Foot</footer></body></html>"""
    assert main_text.main_text(page) == "Title & more\n\nFirst paragraph with enough words to count.\n\nSecond line é.\n\na\n\nb"


PARAGRAPHS = ["This is a paragraph of the text that says something at some length, and goes on for a while.", "A second one follows it, which is about as long as the first and has a link or two, but not more.", "The third of them ends the text, and has enough words in it to be told from menus and the like."]
MENU = "<div><ul>" + "".join(f'<li><a href="/{k}">Item {k}</a></li>' for k in range(12)) + "</ul></div>"


def test_regions_without_article(monkeypatch):
    one, two, three = PARAGRAPHS
    page = f"<body>{MENU}<div><h2>Title</h2><p>{one}</p><ul><li>a</li><li>b</li><li>c</li></ul><p>{two}</p><table><tr><td>1</td><td>2</td></tr></table><blockquote><p>{three}</p></blockquote></div>{MENU}<div><a href='/'>Home</a> | <a href='/x'>Imprint</a></div></body>"
    want = "\n\n".join(["Title", one, "a", "b", "c", two, "1", "2", three])
    assert main_text.main_text(page) == want
    # the clustering decides: with a constant threshold the menus come along
    with monkeypatch.context() as m:
        m.setattr(main_text, "_threshold", lambda values: -1.0)
        assert main_text.main_text(page) != want
    quoted = f"<body>{MENU}<div><p>{one}</p><blockquote><p>{two}</p><p>{three}</p><p>{two}</p><p>{three}</p></blockquote><p>{two}</p></div></body>"
    assert main_text.main_text(quoted) == "\n\n".join([one, two, three, two, three, two])
    parts = f"<body>{MENU}<section><p>{one}</p></section><section><p>{two}</p></section><section><p>{three}</p></section></body>"
    assert main_text.main_text(parts).startswith("\n\n".join(PARAGRAPHS)) or main_text.main_text(parts).endswith("\n\n".join(PARAGRAPHS))


def test_names_of_elements():
    one, two, three = PARAGRAPHS
    text = "\n\n".join(PARAGRAPHS)
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    for name in ("layout has-sidebar", "page no-comments", "sidebar", "with-comments", "main header"):
        assert main_text.main_text(f'<body><nav>x</nav><div class="{name}"><article>{body}</article></div></body>') == text, name
    assert main_text.main_text(f'<article><p>{one}</p><p class="related-work">{two}</p><p class="social-policy">{three}</p></article>') == text
    linked = '<div class="related-posts"><a href="/1">One more post</a> <a href="/2">And another</a></div>'
    extra = '<div class="comment-list"><p>Nice post</p></div><div id="post-comments"><p>So it is</p></div><div class="cookie-bar">We use cookies</div><div class="adSlot">Buy</div>'
    assert main_text.main_text(f"<article>{body}{linked}{extra}</article>") == text
    many = "".join(f"<p>Reader {k}: {one}</p>" for k in range(9))
    assert main_text.main_text(f'<article><p>{two}</p><section id="comments">{many}</section></article>') == two
    assert main_text.main_text(f'<article><p>{two}</p></article><article class="comment"><p>{one}</p></article>') == two


def test_parts_within_a_line():
    one, two, _ = PARAGRAPHS
    page = f'<article><p>{one} <button>Share it</button> and more<span class="ad">Buy</span>, so.</p><p>{two}<script>x</script>!</p></article>'
    assert main_text.main_text(page) == f"{one} and more , so.\n\n{two}!"


def test_several_articles():
    one, two, three = PARAGRAPHS
    assert main_text.main_text(f"<body>{MENU}<article><p>{one}</p></article><div>ad</div><article><p>{two}</p><p>{three}</p></article></body>") == "\n\n".join(PARAGRAPHS)


def test_odd_pages():
    assert [main_text.main_text(p) for p in (None, "", "<p>", "<nav>only a menu</nav>")] == ["", "", "", ""]
    assert main_text.main_text("just text, no tags at all") == "just text, no tags at all"
    assert main_text.main_text("<article><p>cut off <b>in the mid") == "cut off in the mid"
    assert main_text.main_text("<![if x]><article><p>a<![endif]> b</p><!bad></article>") == "a b"


def test_pages_of_edge_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>x</p>"), (2, "u", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in main_text.extract_main_text(df).collect()) == [(0, "", 0), (1, "", 0), (2, "x", 1), (2, "x", 1)]
    assert main_text.extract_main_text(df.where("false")).count() == 0


BODY = "".join(f"<p>This is a long paragraph number {k} of the story with enough words to be selected by its ratio.</p>" for k in range(6))


def test_frames_around_a_whole_page():
    """What holds most of the text is not left out for its element; teasers without selected lines are."""
    story = [f"This is a long paragraph number {k} of the story with enough words to be selected by its ratio." for k in range(6)]
    menu = "<nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two</a></li></ul></nav>"
    search = "<form><input><p>Search this site</p></form>"
    for html in (
        f"<body><form id='aspnetForm'>{menu}{search}<article>{BODY}</article><footer><p>Imprint</p></footer></form></body>",
        f"<body><nav><ul><li><a href='/a'>One</a></li></ul><article>{BODY}</article></body>",
        f"<body>{search}<form><div>{BODY}</div></form>{menu}</body>",
        f"<body><article>{BODY}</article><section class='related-posts'><article><p><a href='/x'>Short</a></p></article></section></body>",
        f"<body><header>{menu}<main>{BODY}</main></header></body>",
    ):
        assert main_text.main_text(html).split("\n\n") == story, html[:60]
    # a menu of links stays out however much of the page it is
    links = "".join(f"<li><a href='/{k}'>A link with quite a long name {k}</a></li>" for k in range(40))
    assert main_text.main_text(f"<body><nav><ul>{links}</ul></nav><p>{story[0]}</p></body>") == story[0]


def test_many_open_marked_elements():
    import time

    html = "<body>" + "<span class='ad'>" * 1500 + "".join(f"<b>word {k}</b> " for k in range(6000)) + "</body>"
    began = time.time()
    assert main_text.main_text(html).startswith("word 0")
    assert time.time() - began < 6
