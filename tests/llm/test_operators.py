"""Dealt operators against brute force, exact round trips and literal cases."""

import hashlib
import json
import math
import random
import textwrap
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlsplit

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tabloom.llm import attention, chat, chunks, components, decontaminate, exact_dedup, html_text, jaccard, language_model, licenses, pieces, quality, queries, url_filter
from tabloom.sources.tables import TABLE_NAMES, Tables
from tools.check import compare

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
TEXTS = [(1, None), (2, ""), (3, "Ein Text,  mit\nZeilen ▁ und é "), (4, LONG), (4, LONG), (None, "ohne Nummer"), (5, "   "), (6, "a ▁▁b\t c  ")]


@pytest.fixture
def docs(spark):
    """``docs((id, text), ...)`` with columns whose names clash with inner ones."""

    def make(*rows):
        return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, node string, n int")

    return make


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLE_NAMES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    verdict, rows, _, note = compare(spark, duck, name, queries.QUERIES[name], queries.CHECKS[name], SMALL)
    assert verdict == "ok" and rows, note


def test_pieces_equal_the_library(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    rows = {(r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in pieces.encode(docs(*TEXTS)).collect()}
    assert rows == {(i, (*model.encode(t or ""), 2), model.decode([*model.encode(t or ""), 2])) for i, t in TEXTS}
    table = Tables(spark, SMALL).documents
    got = {r["doc_id"]: r for r in queries.op9_sentencepiece(spark, SMALL).collect()}
    for row in table.collect():
        ids = [*model.encode(row["text"] or ""), 2]
        assert got[row["doc_id"]]["n_tokens"] == len(ids)
        assert got[row["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[row["doc_id"]]["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert pieces.encode(docs()).count() == 0


def test_jaccard_equals_brute_force(spark, docs):
    draw = random.Random(5)
    base = [[f"v{draw.randrange(400)}" for _ in range(draw.randrange(3, 90))] for _ in range(30)]
    rows = []
    for k in range(400):  # families of edited copies, with a common passage
        words = list(base[int(30 * draw.random() ** 3)])
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"e{draw.randrange(50)}"
        rows.append((k, " ".join(words + (["common"] * 3 + ["line", "of", "many"] if k % 3 == 0 else []))))
    rows += [(900, None), (901, ""), (902, "Two words"), (903, "two WORDS"), (None, rows[0][1])]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i, _ in rows if i is not None}
    for a in sorted(label):
        for b in sorted(label):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if c == high else c for i, c in label.items()}
    got = jaccard.near_duplicates(docs(*rows)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {(i, len(sets[i]), label.get(i)) for i, _ in rows}
    assert jaccard.near_duplicates(docs()).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(50, 60), (60, 50), (7, 7), (None, 3)], "u int, v int")
    found = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert found == {**{k: 0 for k in range(41)}, 50: 50, 60: 50}


def test_exact_dedup_edges(docs):
    rows = exact_dedup.exact_groups(docs((1, "AbÉ"), (2, "aBÉ"), (3, "abé"), (4, None), (5, ""), (6, LONG)), digest_all=True).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in rows} == {
        1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (5, 2, False), 5: (5, 2, True), 6: (6, 1, True),
    }
    assert sorted(r["doc_id"] for r in exact_dedup.drop_exact_copies(docs((1, "x"), (2, "X"), (None, "y"))).collect() if r["doc_id"]) == [2]
    assert exact_dedup.exact_groups(docs()).count() == 0


def test_sketches_lose_no_link():
    draw = random.Random(3)
    shingler = jaccard.Shingler()
    for size in (1, 4, 12, 90, 3000):
        words = [f"s{draw.randrange(10**6)}" for _ in range(size)]
        a = shingler.tokens(" ".join(words))
        for k in (0, 1, 3, size // 40):
            for at in draw.sample(range(size), min(k, size)):
                words[at] = "new"
            b = shingler.tokens(" ".join(words))
            x, y = (np.array(jaccard.sketch_of(t)).view(np.uint64) for t in (a, b))
            lacking = int(np.bitwise_count(x & ~y).sum())
            assert len(jaccard.sketch_of(a)) == jaccard.SKETCH and int(np.bitwise_count(x).sum()) <= len(a)
            assert len(a) - lacking >= len(np.intersect1d(a, b))


STAY = [(1, "copy text"), (2, "copy TEXT"), (1, "unique text only here"), (None, "Copy Text"), (3, "no number"), (None, "NO number"), (None, "lost"), (None, "lost"), (5, "twice"), (5, "twice"), (6, None), (7, "")]


def test_exact_copies_go_by_row(docs):
    got = exact_dedup.drop_exact_copies(docs(*STAY))
    assert got.columns == ["doc_id", "text", "node", "n"]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([(2, "copy TEXT"), (1, "unique text only here"), (3, "no number"), (None, "lost"), (5, "twice"), (7, "")])
    assert exact_dedup.drop_exact_copies(docs()).count() == 0


def test_near_copies_go_by_row(docs):
    long = " ".join(f"n{k}" for k in range(40))
    rows = [(1, long), (2, long + " more"), (None, long + " more"), (1, "another text of six words"), (4, "another text of six words"), (None, "alone"), (None, "alone"), (5, ""), (5, ""), (6, None)]
    got = jaccard.drop_near_duplicates(docs(*rows))
    assert got.columns == ["doc_id", "text", "node", "n"]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([(1, long), (1, "another text of six words"), (None, "alone"), (5, ""), (6, None)])
    plain = jaccard.drop_near_duplicates(docs((1, long), (2, long + " more"), (3, None)))
    assert sorted(r["doc_id"] for r in plain.collect()) == [1, 3] and jaccard.drop_near_duplicates(docs()).count() == 0


def test_decontamination_cuts_spans(spark, docs):
    items = spark.createDataFrame([("long", " ".join(f"t{k}" for k in range(14))), ("short", "alpha beta"), ("one", "solo"), ("none", None)], "item_id string, text string")
    leak = " ".join(f"T{k}," for k in range(2, 13))
    texts = docs((1, f"start {leak} end of a longer text with enough other words around it so that it stays here"), (2, "alpha beta"), (3, "clean beta alpha"), (4, None), (5, "Solo and t1 t2 t3 words more words"))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in decontaminate.contamination(texts, items).collect()}
    assert got == {1: (28, 11, 1), 2: (2, 2, 1), 3: (3, 0, 0), 4: (0, 0, 0), 5: (8, 1, 1)}
    left = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(texts, items).collect()}
    assert left[1].startswith("start , end of") and left[3] == "clean beta alpha" and left[4] is None and 2 not in left
    assert decontaminate.contamination(texts, items.limit(0)).where("contaminated").count() == 0


def test_html_text(spark):
    html = """<html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a>Menu</a></ul></nav>
    <div class="cookie-notice">We use cookies</div><div class=ad>Buy</div><article><h1>A &amp; B</h1><p>First <b>bo</b>ld<br>line &lt;x&gt;.
    <p>Second.</p><form>Name</form><div id="comments"><p>Nice!</p></div><p>Last one.</article><aside>Side</aside><footer>&copy; f</footer>"""
    pages = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, None, "<p>" * 3), (4, "u", "<article>" + "<p>word " * 20_000)], "page_id int, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(pages).collect()}
    assert got[1] == "A & B First bold line <x>. Second. Last one." and got[2] == got[3] == "" and len(got[4]) == 20_000 * 5 - 1


def test_html_text_without_article(spark):
    long = " ".join(f"w{k}" for k in range(40))
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Go {k}</a></li>" for k in range(9)) + "</ul>"
    article = f"<article><h1>Title</h1><p>{long}</p></article></body>"
    labelled = [f"<body><p>Two words</p><td>by us</td><ul><li>See also</li></ul>{article}", *[f"<body>{article}"] * 39]
    main = f"<div id=content><h3>Head</h3><ul><li>First point</li><li>Second</li></ul><table><tr><td>Cell one</td><td>2</td></tr></table><section>Part</section><div>{long}</div><p>End.</p></div>"
    plain = f"<body><nav>Menu</nav>{menu}{main}{menu}<footer>Foot</footer></body>"
    rows = [(k, "u", html) for k, html in enumerate([plain, *labelled, "<body><div>A few words only</div></body>", "<body><article></article><td>Cell</td></body>"])]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got[0] == f"Head First point Second Cell one 2 Part {long} End."
    assert got[1] == f"Title {long}" and got[41] == "A few words only" and got[42] == "Cell"


def test_url_aliases(spark):
    canon = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://a.net/x", canon.format("https://b.example.org/es/1")), (2, "http://A.net/x#f", None), (3, "http://c.net/y", '<META http-equiv="refresh" content="0; url=/z">'),
        (4, "http://c.net/z", canon.format("http://a.net/x")), (5, "http://d.net/", canon.format("http://a.com/fr/")), (6, None, None), (7, "mailto:x", None), (8, "http://d.net/", None), (9, "http://x.com/de/a?b", None),
    ]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert [got[k][3] for k in range(1, 10)] == ["block"] * 4 + ["allow"] * 4 + ["block"]
    assert got[2][:3] == ("a.net", "/x", None) and got[6][:3] == got[7][:3] == ("", "", None) and got[9][2] == "com/de/"


def test_url_links_equal_brute_force(spark):
    draw = random.Random(3)
    targets = ["p1", "./p2", "../p3", "../../../es/p1", "?p=1", "/x/../en/1", "//b.example.org/es/", "http://c.com/fr/a", "sub/p4?q=../r", "#top", "mailto:a@b", "..", ".", "", "p2?a&amp;b#c"]
    tags = ['<link rel="canonical" href="{}">', "<LINK data-href=z href='{}' rel='nofollow canonical'/>", '<meta http-equiv="Refresh" content="0; url={}">', "<meta content=\"3;URL='{}'\" http-equiv=refresh title='a>b'>",
            '<!-- <link rel="canonical" href="http://c.com/fr/a"> -->', "<script>'<link rel=canonical href=/x/p1>'</script>", '<link rel="stylesheet" href="{}">', '<meta name="a" content="0; url={}">', "<p>{}</p>"]
    urls = [f"http://{h}{p}" for h in ("a.net", "b.example.org", "c.com") for p in ("", "/", "/x/p1", "/x/p2", "/x/y/p3?k", "/es/p1", "/fr/a", "/p4", "/x/", "/x/p2?a&b")]
    rows = [(k, draw.choice(urls), "".join(draw.choice(tags).format(draw.choice(targets)) for _ in range(draw.randrange(3))) if draw.random() < 0.6 else None) for k in range(60)]
    rows += [(100, "http://a.net/q/w/e", '<base href="/r/s"><link rel=canonical href=t>'), (101, "http://a.net/r/t", "<link rel=canonical href=http://c.com/de/1>")]

    class Links(HTMLParser):
        def __init__(self, html):
            super().__init__()
            self.found, self.base = [], ""
            self.feed(html)

        def handle_starttag(self, tag, attrs):
            at = dict(attrs)
            if tag == "base":
                self.base = self.base or at["href"]
            if tag == "link" and "canonical" in at["rel"].lower().split():
                self.found.append(at["href"])
            if tag == "meta" and at.get("http-equiv", "").lower() == "refresh":
                self.found.append(at["content"].split("=", 1)[1].strip("'"))

    label = {u: u for _, u, _ in rows}

    def own(url):
        host, path = urlsplit(url).netloc, urlsplit(url).path
        fits = [(len(h + p), kind) for kind, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1] if fits else None

    for _, url, html in rows:
        page = Links(html or "")
        for to in page.found:
            full = urldefrag(urljoin(urljoin(url, page.base), to))[0]
            if to and to[0] != "#" and full.startswith("http"):
                one, two = label[url], label.setdefault(full, full)
                label = {u: min(one, two) if c in (one, two) else c for u, c in label.items()}
    want = {k: (own(u) or min((v for v in map(own, (x for x in label if label[x] == label[u])) if v), default="allow"), label[u]) for k, u, _ in rows}
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    assert {r["page_id"]: (r["verdict"], r["alias_id"]) for r in got} == want
    assert len({c for _, c in want.values()}) > 5 and {v for v, _ in want.values()} == {"allow", "block"}


def test_licenses(docs):
    text = "Copyright (c) 2020 Someone\n\n" + licenses.MIT.upper().replace(",", " ;").replace("SUBLICENSE", "sub-licence")
    got = {r["doc_id"]: (r["license_id"], r["line_licenses"]) for r in licenses.scan_licenses(docs((1, text), (2, "Words.\nreleased under the mit licence\n"), (3, None), (4, "!!"))).collect()}
    assert got == {1: ("MIT", []), 2: (None, ["MIT"]), 3: (None, []), 4: (None, [])}


def test_licenses_in_any_wrapping(docs):
    """Lines of terms that begin with the word copyright stay, wherever a wrapping puts them."""
    folder = licenses.Path(licenses.__file__).parent / "license_texts"
    texts = {n: (folder / f"{n}.txt").read_text() for n in ("Apache-2.0", "MPL-2.0")} | {"MIT": licenses.MIT, "ISC": licenses.ISC}
    wrapped = lambda text, width: "\n\n".join("\n".join(textwrap.wrap(p, width, break_long_words=False, break_on_hyphens=False)) for p in text.split("\n\n"))
    rows = [(name, wrapped(text, width)) for name, text in texts.items() for width in (60, 72, 79, 10**6)]
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan_licenses(docs(*((k, text) for k, (_, text) in enumerate(rows)))).collect()}
    assert [got[k] for k in range(len(rows))] == [name for name, _ in rows]


def test_license_notices_and_terms(docs):
    notices = ["Copyright (c) 2020 A", "(C) 1999-2004 B", "\u00a9 2021 C", "Copyright 2001 D", "Copyright [yyyy] [name]", "All rights reserved."]
    terms = ["copyright notice and this permission notice appear", "(c) You must retain the notices", "Copyright law applies"]
    form = {r[0]: r[1] for r in docs(*enumerate(notices + terms)).select("doc_id", licenses.canonical(F.col("text"))).collect()}
    assert [bool(form[k]) for k in range(len(form))] == [False] * len(notices) + [True] * len(terms)


def test_licenses_whole_texts(docs):
    texts = {name: (licenses.Path(licenses.__file__).parent / "license_texts" / f"{name}.txt").read_text() for name in licenses.TEXTS}
    rows = list(enumerate(texts.values()))
    apache = texts["Apache-2.0"]
    apache = apache[apache.index("TERMS AND") : apache.index("APPENDIX")].replace("http:", "https:").upper()
    gpl = texts["GPL-2.0"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")
    bsd = "Copyright 2001 X\n\n" + licenses.BSD3.replace("copyright holder nor", "copyright owner nor")
    more = [apache, gpl, bsd, texts["MPL-2.0"][: texts["MPL-2.0"].index("Exhibit A - S")], texts["GPL-3.0"] + " more"]
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan_licenses(docs(*rows, *enumerate(more, 100))).collect()}
    assert [got[k] for k in range(len(rows))] == list(texts)
    assert [got[k] for k in range(100, 105)] == ["Apache-2.0", "GPL-2.0", "BSD-3-Clause", "MPL-2.0", None]


def test_chat_links_calls(spark):
    call = json.dumps({"content": None, "tool_calls": [{"id": "b", "name": "search", "arguments": {"limit": "x"}, "after": ["a"]}, {"id": "a", "name": "calculator", "arguments": "{\"expression\": \"1+1\"}"}]})
    rows = [(1, 0, "user", "hi"), (1, 1, "tool", '{"tool_call_id": "b", "content": "r"}'), (1, 2, "assistant", call), (1, 3, "tool", '{"tool_call_id": "a", "content": 2}'), (1, 4, "tool", '{"tool_call_id": "q"}'), (2, None, None, None), (1, 5, "assistant", "{broken")]
    got = chat.format_chat(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    one = sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["order_key"])
    assert [r["turn"] for r in one] == [0, 2, 3, 1, 4, 5] and [r["link"] for r in one] == [None, None, "linked", "linked", "orphan", None]
    assert one[1]["argument_errors"] == ["b $.query: missing", "b $.limit: not integer"]
    assert one[1]["json"].startswith('{"content":"","role":"assistant","tool_calls":[{"arguments":{"expression":"1+1"},"id":"a"')


def test_chat_repeated_ids_and_later_calls(spark):
    def call(*ids, **after):
        return json.dumps({"tool_calls": [{"id": i, "name": "search", "arguments": {"query": "q"}, "after": after.get(i, [])} for i in ids]})

    def result(i):
        return json.dumps({"tool_call_id": i, "content": "r"})

    def order(*texts):
        rows = [(1, k, "tool" if "tool_call_id" in t else "assistant", t) for k, t in enumerate(texts)]
        got = chat.format_chat(spark.createDataFrame([*rows, *rows], "conv_id int, turn int, role string, text string")).collect()
        assert len(got) == 2 * len(rows) and {r["link"] for r in got if r["role"] == "tool"} <= {"linked"}
        return [r["turn"] for r in sorted(got, key=lambda r: r["order_key"])[::2]]

    assert order("hi", call("a"), result("a"), call("a"), result("a")) == [0, 1, 2, 3, 4]
    assert order(result("a"), call("a"), "x", call("a"), "y", result("a"), result("a")) == [1, 0, 5, 2, 3, 6, 4]
    assert order(call("a"), call("a"), "x", result("a"), "y", result("b"), call("b")) == [0, 1, 3, 2, 4, 6, 5]
    assert order(call("a", "a"), "x", result("a"), result("a"), result("a")) == [0, 2, 3, 4, 1]
    # a names c, b names a, d names c of an earlier message; e and f name each other
    assert order(call("a", a=["c"]), result("a"), call("b", b=["a", "none"]), call("c"), "x", call("d", d=["c"]), result("c"), result("b")) == [3, 6, 0, 1, 2, 7, 4, 5]
    assert order(call("e", e=["f"]), "x", call("f", f=["e"]), result("e")) == [0, 3, 1, 2]


def test_chat_forms_numbers_and_depth(spark, tmp_path):
    def deep(levels):
        return '{"query":' * levels + "1" + "}" * levels

    def wrapped(arguments):
        return json.dumps({"name": "bot", "content": [1], "tool_calls": [{"id": "a", "type": "function", "function": {"name": "search", "arguments": arguments, "strict": True}}]})

    texts = [wrapped('{"query": "q"}'), wrapped(deep(chat.DEEPEST - 4)), wrapped(deep(chat.DEEPEST + 1)), wrapped(deep(900)), wrapped('{"query": 1e999}'), deep(5000), '{"tool_calls": [{"id": "a", "arguments": {"x": 1e999}}]}']
    rows = [(1, k, "assistant", t) for k, t in enumerate(texts)] + [(1, 9, "tool", '{"tool_call_id": "a", "content": 1.5, "is_error": false}')]
    got = {r["turn"]: r for r in chat.format_chat(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()}
    assert got[0]["json"] == '{"content":[1],"name":"bot","role":"assistant","tool_calls":[{"arguments":{"query":"q"},"function":{"strict":true},"id":"a","name":"search","type":"function"}]}'
    assert got[0]["argument_errors"] == [] and got[1]["argument_errors"] == ["a $.query: not string"]
    for k in (2, 3, 4):  # such arguments stay a string
        (call,) = json.loads(got[k]["json"])["tool_calls"]
        assert call["arguments"] == json.loads(texts[k])["tool_calls"][0]["function"]["arguments"] and got[k]["argument_errors"] == ["a $: not object"]
    assert all(json.loads(got[k]["json"])["content"] == texts[k] and got[k]["n_calls"] == 0 for k in (5, 6))
    assert got[9]["json"] == '{"content":1.5,"is_error":false,"role":"tool","tool_call_id":"a"}' and got[9]["link"] == "linked"
    other = tmp_path / "tools.json"
    other.write_text('{"search": {"type": "object", "required": ["page"]}}')
    got = chat.format_chat(spark.createDataFrame(rows[:1], "conv_id int, turn int, role string, text string"), chat.read_schemas(other)).first()
    assert got["argument_errors"] == ["a $.page: missing"]
    assert chat.format_chat(spark.createDataFrame([], "conv_id int, turn int, role string, text string")).count() == 0


def test_language_model(spark):
    rows = language_model.score_texts(Tables(spark, SMALL).documents).collect()
    texts = {r["doc_id"]: language_model.words_of(r["text"]) for r in Tables(spark, SMALL).documents.collect()}
    counts: dict = {}
    for i, words in texts.items():
        if not language_model.is_held_out(i):
            for w in [*words, None]:
                counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())
    for r in rows:
        tokens = [*texts[r["doc_id"]], None]
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in tokens)
        assert (r["n_tokens"], r["train_tokens"]) == (len(tokens), total) and abs(base - r["base_score"]) < 1e-6 * abs(base)
        assert r["n_known"] == sum(w in counts for w in tokens) and r["score"] < 0


def test_language_model_trains_on_every_word(docs):
    key = next(k for k in range(100) if not language_model.is_held_out(k))
    held = next(k for k in range(100) if language_model.is_held_out(k))
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(language_model.MODEL))
    source = docs((key, LONG), (held, "never")).select("doc_id", "text").coalesce(1)
    rows = language_model.training_windows(source).collect()
    words = model.encode(language_model.words_of(LONG))
    first = [*(ids[0] for ids in words), model.eos_id()]
    assert [ids for r in rows for ids in r["words"]] == words and [x for r in rows for x in r["first"]] == first
    assert [r["before"] for r in rows] == [model.bos_id(), *first[language_model.WINDOW_WORDS - 1 : -2 : language_model.WINDOW_WORDS]]
    outer, _ = language_model.train_model(source)
    share = outer.vocabulary.inside - outer.vocabulary.inside.min()  # ids that stand nowhere have the lowest share
    assert all(share[i] > 0 for i in set(first[:-1]))


def _attention(seed, size=50, block=4):
    draw = np.random.default_rng(seed)
    counts = draw.integers(0, 9, size).astype(float)
    words = attention.vocabulary(counts, draw.random((size, 6)).astype(np.float32))
    params = {n: p + draw.normal(0, 0.4, p.shape).astype(np.float32) for n, p in attention.start(words, counts, block).items()}
    return draw, words, params


def _likely(params, words, ids, begin, block):
    """Log probabilities of one sequence, an id at a time."""
    read, out = [begin, *ids[:-1]], []
    rows = params["embedding"][read].astype(float)
    q, k, v = (rows @ params[n] for n in ("query", "key", "value"))
    for i, goal in enumerate(ids):
        seen = range(max(0, i // block - 1) * block, i + 1)
        weight = np.exp([q[i] @ k[j] / attention.WIDTH**0.5 + params["distance"][i - j] for j in seen])
        context = weight @ v[list(seen)] / weight.sum()
        logits = rows[i] @ params["direct"] + context @ params["context"] + params["bias"]
        out.append(logits[words.of_class[goal]] - np.log(np.exp(logits).sum()) + words.inside[goal])
    return out


@pytest.mark.parametrize("lengths", [[2, 3, 4, 8, 1, 0, 3], [9, 1, 2, 2, 3, 0, 2, 1, 2, 1, 30, 1, 1, 2], [40, 16, 17, 0, 64]], ids=["short", "mixed", "long"])
def test_attention_equals_brute_force(lengths):
    draw, words, params = _attention(7)
    lengths = np.array(lengths)
    ids, begins = draw.integers(0, 50, lengths.sum()), draw.integers(0, 50, len(lengths))
    cuts = np.cumsum(lengths) - lengths
    want = [x for at, n, b in zip(cuts, lengths, begins) for x in _likely(params, words, ids[at : at + n], b, 4)]
    for tokens in (8, 20, 1000):
        assert np.allclose(attention.log_probabilities(params, words, ids, lengths, begins, 4, tokens), want, atol=1e-4)
    (step,) = attention.steps_of(words.of_class, ids, lengths, begins, 4, 1000)
    slopes, rows = attention._gradients(params, step, 4)
    slopes["embedding"] = np.zeros_like(params["embedding"])
    np.add.at(slopes["embedding"], step.read, rows)
    for name in attention.NAMES:  # along a random direction
        way = draw.normal(0, 1, params[name].shape)
        loss = [-attention.log_probabilities(params | {name: (params[name] + e * way).astype(np.float32)}, words, ids, lengths, begins, 4).sum(dtype=float) for e in (-5e-3, 5e-3)]
        assert abs((loss[1] - loss[0]) / 1e-2 - (slopes[name] * way).sum()) < 2e-2 * (1 + np.abs(slopes[name]).sum() ** 0.5), name


def test_short_words_stand_close():
    """Places of a step are mostly ids, also where words have fewer ids than a block."""
    draw, words, _ = _attention(3)
    lengths = draw.integers(1, 5, 3000)
    ids = draw.integers(0, 50, lengths.sum())
    steps = list(attention.steps_of(words.of_class, ids, lengths, np.zeros(3000, int), 8, 1500))
    assert sum(len(s.read) for s in steps) < 1.25 * len(ids) == 1.25 * sum(s.real.sum() for s in steps)
    assert [x for s in steps for x in s.goal[s.place] // len(s.read)] == words.of_class[ids].tolist()


def test_packets_hold_all_windows(monkeypatch):
    """Packets that end anywhere hold the words of every training text, whatever the rows of a batch."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(language_model.MODEL))
    texts = {k: " ".join(f"W{j % 11}x{k % 3}" for j in range(k * 7 % 200)) + "\t\x1c " * (k % 2) for k in range(300)} | {300: None}
    table = pa.table({"doc_id": pa.array(texts, pa.int64()), "text": pa.array(texts.values(), pa.string())})
    monkeypatch.setattr(language_model, "WINDOWS", 13)
    before, windows, last = [], [], model.bos_id()
    for key, text in texts.items():
        words = [] if language_model.is_held_out(key) else model.encode(language_model.words_of(text))
        for low in [] if language_model.is_held_out(key) else range(0, max(1, len(words)), language_model.WINDOW_WORDS):
            before.append(words[low - 1][0] if low else model.bos_id())
            windows.append((words[low : low + language_model.WINDOW_WORDS], low + language_model.WINDOW_WORDS >= len(words)))
    packets = list(language_model._windows(iter(table.to_batches(max_chunksize=70))))
    assert [len(p.sizes) for p in packets[:-1]] == [13] * (len(packets) - 1)
    found = []
    for p in packets:
        kinds = [tuple(x) for x in np.split(p.kinds, np.cumsum(p.kind_lengths)[:-1])] if len(p.codes) else []
        assert kinds == sorted(set(kinds)) and sorted(set(p.codes)) == list(range(len(kinds)))
        part = [list(x) for x in np.split(p.codes, np.cumsum(p.sizes)[:-1])]
        firsts = np.split(p.first, np.cumsum(p.lengths)[:-1])
        for codes, first in zip(part, firsts):
            words = [list(kinds[c]) for c in codes]
            found.append((words, first.tolist() == [*(w[0] for w in words), model.eos_id()]))
    assert found == windows and np.concatenate([p.before for p in packets]).tolist() == before


def test_language_model_of_odd_tables(docs):
    held = next(k for k in range(100) if language_model.is_held_out(k))
    rows = language_model.score_texts(docs(*TEXTS)).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == sorted((str(i), len(language_model.words_of(t)) + 1) for i, t in TEXTS)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    (row,) = language_model.score_texts(docs((held, "nothing learnt"))).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0) and math.isfinite(row["score"])
    assert language_model.score_texts(docs()).count() == 0


def test_language_model_beats_word_shares(spark):
    rows = language_model.score_texts(Tables(spark, "/root/testdata/sf0.01").documents).collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_quality_keeps_good_documents(spark):
    tables = Tables(spark, "/root/testdata/sf0.01")
    judged = quality.judge_quality(tables.documents, tables.labels).select("doc_id", "_quality.*").join(tables.labels, "doc_id").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in judged) >= 0.98 * len(judged)
    assert all(0 <= r["path_posterior"] <= 1 for r in judged)


def test_quality_of_documents_not_fitted(spark):
    tables = Tables(spark, "/root/testdata/sf0.01")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    judged = quality.judge_quality(tables.documents, tables.labels.where(half)).select("doc_id", "_quality.*").join(tables.labels.where(~half), "doc_id").collect()
    assert len(judged) > 100 and sum(r["kept"] == (r["quality"] == 1) for r in judged) >= 0.95 * len(judged)


def test_quality_leaves_the_row_out(spark):
    """Posteriors against sums over the other rows, in plain Python; clashing names, NULLs, repeats."""
    texts = ["Plain words make a calm sentence here.", "$$ || BUY !! NOW || $$", None, "", "More plain words in another calm sentence."]
    rows = [(k, texts[k % 5], None if k % 7 == 0 else f"h{k % 3}", "en" if k % 2 else None, "own", 1.0) for k in range(60)] + [(3, texts[3], "alone", "en", "own", 1.0)] * 2
    table = spark.createDataFrame(rows, "doc_id int, text string, source string, lang string, _quality string, odds double")
    labels = spark.createDataFrame([(k, int(k % 5 in (0, 4))) for k in range(30)] + [(None, 1), (3, None)], "doc_id int, quality int")
    got = quality.judge_quality(table, labels)
    assert got.columns == ["doc_id", "text", "source", "lang", "odds", "_quality"]
    found = [r["_quality"] for r in got.collect()]
    sums, mean, host_weight, path_weight = quality.site_sums(got.select("_quality.host", "_quality.path", F.col("_quality.doc_probability").alias("p")))
    assert len(found) == len(rows) and abs(mean - sum(r["doc_probability"] for r in found) / len(found)) < 1e-9
    for k, r in enumerate(found):
        others = [x for i, x in enumerate(found) if i != k and x["host"] == r["host"]]
        host = (sum(x["doc_probability"] for x in others) + host_weight * mean) / (len(others) + host_weight)
        others = [x for x in others if x["path"] == r["path"]]
        path = (sum(x["doc_probability"] for x in others) + path_weight * host) / (len(others) + path_weight)
        assert abs(r["host_posterior"] - host) < 1e-9 and abs(r["path_posterior"] - path) < 1e-9
    kept = quality.drop_low_quality(table, labels)
    assert kept.columns == table.columns and kept.count() == sum(r["kept"] for r in found)
    assert quality.judge_quality(table.limit(0), labels).count() == 0
    assert quality.drop_low_quality(table, labels.where("quality = 1")).count() == len(rows)


def test_pipeline_runs(spark):
    docs = Tables(spark, SMALL).documents
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert 0 < len(rows) < docs.count() and len({r["doc_id"] for r in rows}) == len(rows)


def test_sketches_tell_near_misses():
    """Two sets below the threshold are told apart although many of their tokens share a bit."""
    draw = random.Random(5)
    kept = 0
    for size in (150, 300, 400):
        words = [f"n{draw.randrange(10**6)}" for _ in range(size)]
        other = list(words)
        for at in range(0, size, 24):  # a fifth to a quarter of the shingles, so that less than 0.7 are shared
            other[at] = "new"
        a, b = (jaccard.Shingler().tokens(" ".join(w)) for w in (words, other))
        shared, overlap = len(np.intersect1d(a, b)), math.ceil(75 * (len(a) + len(b)) / 175)
        one, two = (np.array(jaccard.sketch_of(t) + jaccard.again_of(t)).view(np.uint64) for t in (a, b))
        spare = min(len(t) - int(np.bitwise_count(s).sum()) for t, s in ((a, one), (b, two)))
        room = int(np.bitwise_count(one & two).sum()) + spare
        assert shared < overlap and shared <= room
        kept += room >= overlap
    assert kept == 0


def test_packets_hold_every_prefix_token():
    draw = np.random.default_rng(2)
    parts = []
    for node in (5, -7, 9):
        tokens = draw.integers(0, 2**63, 40).astype(np.uint64) * np.uint64(2)
        parts.append((tokens, np.arange(40) >= 30, node, 100))
    batch = jaccard._packed(parts, 7)
    found = []
    for slot, packet in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        rows = jaccard.unpack(packet)
        often = rows["token"].type == jaccard.pa.int64()
        assert 0 <= slot < 7
        found += [(n, p, often, t % 2**32) for t, n, p in zip(rows["token"].to_pylist(), rows["node"].to_pylist(), rows["place"].to_pylist())]
    assert sorted(found) == sorted((node, k, bool(heavy[k]), int(tokens[k]) % 2**32) for tokens, heavy, node, _ in parts for k in range(40))


def test_few_texts_of_a_block_are_held_at_a_time(spark):
    """Counting and writing out go by some rows; the results are those of whole blocks."""
    sizes = []
    texts = [f"word{k % 7} and {k}" for k in range(600)]
    real = pieces.hashlib.sha256
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)

    def split(ids, part):
        counts = Counter(w for t in part for w in t.split())
        return counts | {f"rows {len(ids)}": 1}

    for row in chunks.chunk_packets(docs, split, 1).collect():
        part = chunks.unpack(bytes(row.packet))
        counts = dict(zip(part["chunk"].to_pylist(), part["count"].to_pylist()))
        sizes += [int(w.split()[1]) for w in counts if w.startswith("rows ")]
        assert counts["and"] == 600 and counts["word3"] == 86
    assert sizes and max(sizes) <= chunks.RUN_ROWS
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coded = {r.doc_id: r.ids_sha256 for r in pieces.encode_digests(docs).collect()}
    assert coded == {k: real(" ".join(map(str, [*model.encode(t), model.eos_id()])).encode()).hexdigest() for k, t in enumerate(texts)}


def test_decontamination_holds_few_texts(spark, docs, monkeypatch):
    """A batch is judged by some rows at a time, and all its rows come back."""
    items = spark.createDataFrame([("short", "alpha beta")], "item_id string, text string")
    table = docs(*((k, "alpha beta" if k % 3 == 0 else f"clean {k}") for k in range(1000))).coalesce(1)
    held = spark.sparkContext.accumulator(0)

    def watching(packed, real=decontaminate._scanner, most=256):
        def scan(texts, inner=real(packed)):
            held.add(len(texts) > most)
            return inner(texts)

        return scan

    monkeypatch.setattr(decontaminate, "_scanner", watching)
    got = decontaminate.contamination(table, items).collect()
    assert sorted((r["doc_id"], r["n_hit"]) for r in got) == [(k, 2 * (k % 3 == 0)) for k in range(1000)]
    left = decontaminate.decontaminate(table, items).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == [(k, f"clean {k}") for k in range(1000) if k % 3]
    assert held.value == 0
