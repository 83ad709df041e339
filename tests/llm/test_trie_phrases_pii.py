"""Prefix trie, personal data and phrase collocations against brute force and literal cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tabloom.llm import collocations, decontaminate, personal_data, prefix_trie, queries
from tabloom.sources.tables import Tables

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- prefix trie --------------------------------------------------------------


def words_in(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (role or "", text or "")
            own[conv].append((turn is not None, turn or 0, sha(f"{len(key[0].encode())}:{key[0]}{key[1]}")[:32], key))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        rebuilt[c] = (*own.get(base, [])[:h], *own[c][h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = set()
    for path, cs in members.items():
        inside = [(p, m) for p, m in members.items() if p[: len(path)] == path]
        kids = sum(len(p) == len(path) + 1 for p, _ in inside)
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in members) for p, _ in inside)
        saved = sum((len(m) - 1) * (words_in(p[-1][1]) if p else 0) for p, m in inside)
        ends = sha(",".join(map(str, sorted(c for c in cs if len(rebuilt[c]) == len(path)))))
        out.add((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), kids, leaves, saved, ends))
    return out


def talk(draw, convs, turns, texts):
    rows = []
    for c in range(convs):
        for k in range(draw.randrange(turns + 1)):
            rows.append((c * 3 - 7, draw.choice([k, k, k, None]), draw.choice(["user", "bot", None]), draw.choice(texts)))
    return rows


def trie(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, root string, depth int")
    return [tuple(r) for r in prefix_trie.prefix_trie(df, **options).collect()]


@pytest.mark.parametrize("segment,shard_turns", [(1024, 200_000), (1024, 3), (3, 5), (1, 40)])
def test_trie_equals_brute_force(spark, segment, shard_turns):
    draw = random.Random(segment + shard_turns)
    rows = talk(draw, 40, 7, ["a b", "a\tb  c", "", None, "ü ▁"])
    rows += [(500, k, "user", "x y") for k in range(15)] + [(501, k, "user", "x y") for k in range(15)]  # equal long ones
    rows += [(k, t, "user", "same words here") for k in range(600, 640) for t in range(4)]  # a large group of copies
    rows += [(None, 1, "user", "nobody"), (700, None, None, None), (701, 1, "bot", "long " * 5000), (702, 5, "user", "u"), (702, 5, "user", "u")]
    got = trie(spark, rows, segment=segment, shard_turns=shard_turns)
    assert len(got) == len(set(got)) and set(got) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "x")]) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=400), st.integers(2, 9))
def test_findclose(heights, block):
    signs, height = [1], 1
    for h in heights:  # a random walk that stays above the ground
        while height > h + 1:
            signs.append(-1)
            height -= 1
        signs.append(1)
        height += 1
    signs += [-1] * height
    tree = prefix_trie.Parentheses(np.array(signs, np.int8), block)
    opens = np.array([i for i, s in enumerate(signs) if s == 1])
    stack, close = [], {}
    for i, s in enumerate(signs):
        if s == 1:
            stack.append(i)
        else:
            close[stack.pop()] = i
    assert tree.findclose(opens).tolist() == [close[i] for i in opens]


# ---- personal data ------------------------------------------------------------


def brute_plain(text):
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            d = int(c) * (1 + i % 2)
            total += d - 9 * (d > 9)
        return total % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = lambda pattern, ok=lambda m: True: [m.span() for m in re.finditer(pattern, text) if ok(m)]
    return {
        "email": found(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": found(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": found(r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": found(r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab@.-+ 0123456789()_", max_size=70))
def test_plain_spans_equal_the_patterns(text):
    assert personal_data.plain_spans(text) == brute_plain(text)


HIDDEN = [
    ("email", "john (at) example (dot) com"), ("email", "jane at mail dot example dot org"), ("email", "jоhn@exаmple.com"), ("email", "joe @ example . com"), ("email", "x&#64;y&#46;com"),
    ("email", "joh​n@exam​ple.com"), ("email", "user[at]domain[.]com"), ("email", "anna arroba casa punto es"), ("email", "KIM_at_site_dot_net"),
    ("phone", "plus four nine one seven two five five five one two three"), ("phone", "+1 (four one five) 555-1234"), ("phone", "plus 49 171 five five five 1234"), ("phone", "＋1–415–555–1234"),
    ("card", "４１１１ １１１１ １１１１ １１１１"), ("card", "4O12 8888 8888 1881"), ("card", "four one one one, one one one one one one one one double one one one"),
    ("ip", "one nine two dot one six eight dot zero dot one"), ("ip", "10 dot 0 dot 0 dot 1"), ("ip", "one.two.three.four"), ("ip", "1[.]2[.]3[.]4"),
]


@pytest.mark.parametrize("kind,hidden", HIDDEN)
def test_disguises_map_back_to_the_source(kind, hidden):
    text = f"é ﬁ {hidden} , and more"
    assert brute_plain(text) == {k: [] for k in personal_data.KINDS}
    found = personal_data.disguised_spans(text, personal_data.plain_spans(text))
    assert [(k, text[a:b]) for k, spans in found.items() for a, b in spans] == [(kind, hidden)]


CLEAN = [
    "Visit us at example.com at nine.", "one hundred and two, or three at most", "look at this point. In time", "a@b.com", "+1 (389) 555-4387 un asasga", "call +1 (389) 555-4387 six times", "56.219.220.54 a", "",
    "the dot on the i", "at dot", "4111 1111 1111 1112", "@", "one one one one", "L’été – no",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_get_no_spans_from_the_method(text):
    assert personal_data.disguised_spans(text, personal_data.plain_spans(text)) == {}


def test_personal_data_of_tables(spark):
    rows = [(1, None), (2, ""), (3, "a@b.co and 1.2.3.4 and joe (at) site (dot) org"), (3, "a@b.co and 1.2.3.4 and joe (at) site (dot) org"), (None, "+49 171 5551234"), (5, "x" * 500_000 + "@"), (6, "1" * 300_000), (7, "a@" * 50_000)]
    df = spark.createDataFrame([(*r, "y") for r in rows], "doc_id bigint, text string, spans string")
    got = {r["doc_id"]: r for r in personal_data.find_personal_data(df).collect()}
    assert personal_data.find_personal_data(df).count() == len(rows)
    assert got[3]["spans"] == "email:0:6,email:23:46,ip:11:18" and got[3]["n_email"] == 1 and got[3]["n_added"] == 1
    assert got[3]["base_sha256"] == sha("email:0:6,ip:11:18") and got[None]["n_phone"] == 1
    assert all(got[i]["spans"] == "" for i in (1, 2, 5, 6, 7)) and got[1]["base_sha256"] == sha("")
    assert personal_data.mask(rows[2][1], got[3]["spans"]) == "****** and ******* and " + "*" * 23
    assert personal_data.find_personal_data(df.limit(0)).count() == 0
    for row in queries.op12_pii(spark, SMALL).join(Tables(spark, SMALL).documents, "doc_id").collect():
        plain = brute_plain(row["text"] or "")
        assert row["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k in personal_data.KINDS for a, b in plain[k])) and row["n_added"] == 0
        assert [row[f"n_{k}"] for k in personal_data.KINDS] == [len(plain[k]) for k in personal_data.KINDS]


# ---- phrases ------------------------------------------------------------------


def brute_phrases(rows, least, longest, top):
    count, sizes = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    count[lang or "und", tuple(words[i : i + m])] += 1
    chosen = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    inside = set()
    for (lang, p), a in chosen.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if a >= count[lang, p[i : i + m]]:
                    inside.add((lang, p[i : i + m]))
    ranked = defaultdict(list)
    for (lang, p), a in chosen.items():
        if (lang, p) not in inside:
            n = sizes[lang]
            score, k = min((1000 * a * n // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p)))
            ranked[lang].append((-score, -a, " ".join(p).encode(), a, count[lang, p[:k]], count[lang, p[k:]], n, score))
    return {(lang, i, x[2].decode(), *x[3:]) for lang, found in ranked.items() for i, x in enumerate(sorted(found)[:top], 1)}


@pytest.mark.parametrize("block_bytes,chunk_rows", [(16 << 20, 500_000), (2000, 7)])
def test_phrases_equal_brute_force(spark, block_bytes, chunk_rows):
    draw = random.Random(3)
    common = [f"W{k}" for k in range(12)] + ["é", "\x0e", "don't"]
    rows = []
    for k in range(300):
        words = [draw.choice(common) if draw.random() < 0.7 else f"r{draw.randrange(3000)}" for _ in range(draw.randrange(60))]
        text = draw.choice([" ", "  ", "\t"]).join(words) + draw.choice(["", ".", " the very same passage , again!\n", "; the very same passage"])
        rows.append((draw.choice(["en", "en", "de", None]), text))
    rows += [("en", None), ("en", ""), (None, "x " * 3000), ("xx", "...,,"), ("en", rows[0][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "lang string, text string, n int")
    found = collocations.collocations(df, least=6, top=40, block_bytes=block_bytes, chunk_rows=chunk_rows)
    assert {tuple(r) for r in found.collect()} == brute_phrases(rows, 6, 5, 40)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "a", 3 * 10**12), ("en", "b", 2 * 10**12), ("en", None, 8 * 10**13), ("en", None, 5 * 10**12)], "lang string, phrase string, n bigint")
    phrases = words.where("phrase = 'a'").select("lang", F.lit("a b").alias("phrase"), F.lit(10**12 + 7).cast("bigint").alias("n"))
    row = collocations.rank_phrases(phrases, words).first()
    n = 85 * 10**12
    assert (row["n"], row["score"]) == (n, 1000 * (10**12 + 7) * n // (6 * 10**24))


# ---- benchmark items without id -----------------------------------------------


def test_items_without_id_hit_but_are_not_named(spark):
    passage = " ".join(f"w{k}" for k in range(11))
    items = spark.createDataFrame([(None, passage), (None, "alone"), ("b", passage)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"so {passage} ends"), (2, "Alone."), (3, "clean")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["items_sha256"]) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (11, 2, sha("b")), 2: (1, 1, sha("")), 3: (0, 0, sha(""))}
    only = decontaminate.contamination(docs, items.where("item_id IS NULL")).where("doc_id = 1").first()
    assert (only["n_hit"], only["n_items"], only["contaminated"]) == (11, 1, True)
