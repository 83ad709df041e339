"""Benchmark decontamination with a generalised suffix automaton over the words of all test items.

Documents stream through the automaton in Arrow batches and are not shuffled. The
automata are built in Spark tasks, one per shard of items; a shard holds at most
``SHARD_WORDS`` words (or a single longer item), which bounds every broadcast.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 10
SHARD_WORDS = 100_000
#: Automata that a task keeps loaded; with more shards it loads them one after the other for every batch.
KEEP_LOADED = 4
#: Rows whose texts are Python strings at a time.
RUN_ROWS = 256
#: Lower-cases A-Z; every other ASCII character but a-z and 0-9 separates words; bytes of other characters belong to words.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


class SuffixAutomaton:
    """All runs of words of the items; per state the items and short items found there."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.number = {w: k for k, w in enumerate(sorted({w for _, ws in items for w in ws}), 1)}
        self.length, self.link, self.next = [0], [-1], [{}]
        coded = [(name, [self.number[w] for w in ws]) for name, ws in items if ws]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        self.items: dict[int, set] = {}  # state that stands for runs of `window` words -> items with such a run
        self.whole: dict[int, dict] = {}  # state -> length -> shorter items that are whole here
        for name, codes in coded:
            state = size = 0
            for code in codes:
                state, size = self.next[state][code], size + 1
                if size >= window:
                    at = state
                    while self.length[self.link[at]] >= window:
                        at = self.link[at]
                    self.items.setdefault(at, set()).add(name)
            if len(codes) < window:
                self.whole.setdefault(state, {}).setdefault(len(codes), set()).add(name)
        self.shortest = min((min(window, len(c)) for _, c in coded), default=window)
        pairs = {a * (len(self.number) + 1) + b for _, c in coded for a, b in zip(c, c[1:])}
        self.pairs = np.array(sorted(pairs) or [-1], np.int64)
        self.lone = np.array(sorted({c[0] for _, c in coded if len(c) == 1}) or [-1], np.int64)

    def _extend(self, last: int, code: int) -> int:
        known = self.next[last].get(code)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, code, known)
        new = len(self.length)
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        self.next.append({})
        at = last
        while at >= 0 and code not in self.next[at]:
            self.next[at][code] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][code]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, code, to)
        return new

    def _split(self, at: int, code: int, to: int) -> int:
        twin = len(self.length)
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[to])
        self.next.append(dict(self.next[to]))
        self.link[to] = twin
        while at >= 0 and self.next[at].get(code) == to:
            self.next[at][code] = twin
            at = self.link[at]
        return twin

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs (first word, word after the last) inside occurring windows, and their items.

        Only stretches whose neighbouring words also neighbour in an item can hold a
        window of two words or more, so the walk visits those alone.
        """
        codes = np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        pair = codes[:-1] * (len(self.number) + 1) + codes[1:]
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        live = np.concatenate([[False], self.pairs[place] == pair, [False]])  # live[i]: words i-1 and i are neighbours
        edge = np.flatnonzero(live[1:] != live[:-1])
        stretches = [(int(a), int(b) + 1) for a, b in zip(edge[::2], edge[1::2]) if b + 1 - a >= max(self.shortest, 2)]
        if self.shortest == 1:
            alone = np.flatnonzero(np.isin(codes, self.lone))
            stretches = sorted([*stretches, *((int(i), int(i) + 1) for i in alone)])
        for first, end in stretches:
            state = size = 0
            for i in range(first, end):
                code = int(codes[i])
                while state and code not in self.next[state]:
                    state = self.link[state]
                    size = self.length[state]
                if code in self.next[state]:
                    state, size = self.next[state][code], size + 1
                hit, at = 0, state
                while at > 0:  # shorter and shorter suffixes of the match
                    if size >= self.window and at in self.items:
                        hit = self.window
                        found |= self.items[at]
                    for length, names in self.whole.get(at, {}).items():
                        if length <= size:
                            hit = max(hit, length)
                            found |= names
                    at = self.link[at]
                if hit:
                    spans.append((i + 1 - hit, i + 1))
        return _merged(spans), found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([first, end])
    return [(a, b) for a, b in out]


def _automata(items: DataFrame, item_col: str, text_col: str, window: int, shard_words: int) -> list:
    """Broadcast automata of all shards, each built by one task."""
    named = items.select(F.col(item_col).cast("string").alias("item"), F.coalesce(text_col, F.lit("")).alias("text"))
    chars = named.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-chars // (2 * shard_words)))  # a word has two characters or more with its separator

    def build(group: pd.DataFrame) -> pd.DataFrame:
        made = SuffixAutomaton([(i, words_of(t)) for i, t in zip(group["item"], group["text"])], window)
        return pd.DataFrame({"automaton": [pickle.dumps(made)]})

    dealt = named.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)))
    context = items.sparkSession.sparkContext
    return [context.broadcast(row[0]) for row in dealt.groupBy("shard").applyInPandas(build, "automaton binary").toLocalIterator()]


def _runs(batches: Iterator[pa.RecordBatch], packed: list) -> Iterator[pa.RecordBatch]:
    """Some rows of a batch at a time; whole batches, where automata are loaded for each."""
    for batch in batches:
        step = RUN_ROWS if len(packed) <= KEEP_LOADED else max(1, batch.num_rows)
        for low in range(0, max(1, batch.num_rows), step):
            yield batch.slice(low, step)


def _scanner(packed: list):
    """A function from the texts of a batch to their numbers of words, spans and items; it holds the words of one text at a time."""
    kept = [pickle.loads(b.value) for b in packed] if len(packed) <= KEEP_LOADED else None

    def scan(texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        sizes, spans, found = [0] * len(texts), [[] for _ in texts], [set() for _ in texts]
        for loaded in [kept] if kept is not None else ([pickle.loads(b.value)] for b in packed):
            for k, text in enumerate(texts):
                words = words_of(text)
                sizes[k] = len(words)
                for automaton in loaded:
                    own, names = automaton.scan(words)
                    spans[k] += own
                    found[k] |= names
        return [(n, _merged(s), f) for n, s, f in zip(sizes, spans, found)]

    return scan


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``spans`` are (first word, word after the last) of the runs inside any occurring
    window of ``window`` words, or inside a whole shorter item. NULL and empty texts
    have no words; empty items have no window; items without id hit and count as one
    item, but are not named; items with one id count once; repeated documents give
    repeated rows. Without items nothing is contaminated.
    """
    packed = _automata(items, item_col, item_text_col, window, SHARD_WORDS)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(packed)
        for batch in _runs(batches, packed):
            rows = []
            for n_words, spans, found in scan(batch.column(1).to_pylist()):
                names = ",".join(sorted(found - {None}))
                hit = sum(b - a for a, b in spans)
                rows.append((n_words, hit, len(found), hashlib.sha256(names.encode()).hexdigest(), hit > 0, [{"first": a, "end": b} for a, b in spans]))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, TYPES))], names=["doc_id", *NAMES]
            )

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        judge,
        f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, spans array<struct<first: int, end: int>>",
    )


NAMES = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))]


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the characters from the first to the last word of every span."""
    blob = text.encode()
    flags = np.frombuffer(blob.translate(NORMAL), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    kept, at = [], 0
    for first, end in spans:
        kept.append(blob[at : starts[first]])
        at = int(ends[end - 1])
    return b"".join([*kept, blob[at:]]).decode()


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", min_span: int = WINDOW, max_coverage: float = 0.5, item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``docs`` with contaminated spans cut from their texts; documents covered beyond ``max_coverage`` go.

    Spans of fewer than ``min_span`` words stay unless they are a whole item. All
    columns are kept; ``chars_col``, where the table has it, is counted anew for
    changed texts. Clean, NULL and empty texts are returned as they are.
    """
    packed = _automata(items, item_col, item_text_col, min_span, SHARD_WORDS)
    names = docs.columns
    at = names.index(text_col)
    count_at = names.index(chars_col) if chars_col in names else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(packed)
        for batch in _runs(batches, packed):
            texts, counts, stay, changed = batch.column(at).to_pylist(), None, [], False
            if count_at is not None:
                counts = batch.column(count_at).to_pylist()
            for k, (n_words, spans, _) in enumerate(scan(texts)):
                stay.append(not spans or sum(b - a for a, b in spans) <= max_coverage * n_words)
                if spans:
                    texts[k] = without_spans(texts[k], spans)
                    changed = True
                    if counts is not None:
                        counts[k] = len(texts[k])
            columns = list(batch.columns)
            if changed:
                columns[at] = pa.array(texts, columns[at].type)
                if counts is not None:
                    columns[count_at] = pa.array(counts, columns[count_at].type)
            run = pa.RecordBatch.from_arrays(columns, names=names)
            yield run if all(stay) else run.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT item_id, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS key FROM g),
sizes AS (SELECT DISTINCT size FROM win),
grams AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS key
          FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, size, item_id FROM grams JOIN win USING (size, key)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
