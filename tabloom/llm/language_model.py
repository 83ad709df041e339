"""Language-model scores of whole texts: causal self-attention over subword ids, trained on all training texts.

The ids of a word are scored by two attention models. The outer one reads the first
ids of the words so far, in overlapping windows over the whole text, and predicts the
first id of the next word or the end. The inner one reads the ids of the word so far
and predicts the next one or the word's end; it depends on the word alone and runs
once per distinct word. Among the words that open with an id, training counts decide
with absolute discounting; the discounted mass goes to the inner model. A copy head
attends evenly to all earlier words of the text that equal the next one.

Training reads all training texts, cut into windows without gaps, in rounds: every
partition goes on from the common weights over its own windows, and the weights are
averaged by the number of windows. Scoring brings the counts of every distinct word to the texts
(``chunks``).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tabloom.llm import attention
from tabloom.llm.chunks import RUN_ROWS, answered, bucket_count, by_block, chunk_packets, text_blocks
from tabloom.llm.storage import pack, unpack, written

MODEL = "piece_bpe_32k.model"
#: Words of a training window, rounds of training.
WINDOW_WORDS, ROUNDS = 32, 2
#: Windows of a packet, whose distinct words the inner model reads once.
WINDOWS = 10_000
#: Preceding ids that are groups of their own when ids are classed, and groups of the rest.
COMMON, RESTS = 96, 32
#: Block lengths of the outer model (words) and of the inner model (ids).
OUTER, INNER = 16, 8
#: Taken off every word's count for words that were not seen; weight of the copy head.
DISCOUNT, COPY = 0.75, 0.05
END = ""  # chunk that stands for the end of a text; no word is empty
PART = 4096
_LOADED: dict[str, sentencepiece.SentencePieceProcessor] = {}


@dataclass
class Attention:
    params: dict
    vocabulary: attention.Vocabulary
    block: int


def words_of(text: str | None) -> list[str]:
    """Lower-cases A-Z; words are runs of characters other than ASCII white space."""
    return [w.decode() for w in (text or "").encode().lower().split()]


def _model() -> sentencepiece.SentencePieceProcessor:
    path = public_tokenizers.path(MODEL)
    if path not in _LOADED:
        _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[path]


def is_held_out(key) -> bool:
    """crc32 of the id as text, mod 10, is 0; a NULL id counts as the empty text."""
    return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, as ``words_of`` gives them, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    full = pc.not_equal(words, "")  # white space at the start or the end of a text leaves an empty word
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    lengths = pc.list_value_length(lists).to_numpy().astype(np.int64)
    ends = np.cumsum(lengths)
    return words.filter(full), before[ends] - before[ends - lengths]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(lengths.sum())), lengths


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _taken(flat: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The sequences ``which`` of ``flat``, one after another."""
    some = lengths[which]
    return flat[np.repeat(_starts(lengths)[which] - _starts(some), some) + np.arange(int(some.sum()))]


@dataclass
class Windows:
    """Windows one after another, and the ids of their distinct words.

    Window k has ``sizes[k]`` words. It is read behind the id ``before[k]`` and holds
    ``lengths[k]`` ids of ``first``: the first ids of its words, and the end where the
    text ends. ``codes`` are the places of its words among the distinct lists of ids,
    in their order, whose ids and lengths are ``kinds`` and ``kind_lengths``.
    """

    before: np.ndarray
    sizes: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    codes: np.ndarray
    kinds: np.ndarray
    kind_lengths: np.ndarray


def _coded(words: pa.Array, model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, kinds, kind_lengths): places of the words among the sorted distinct lists of ids, and these."""
    coded = words.dictionary_encode()
    ids, lengths = _joined(model.encode(_strings(coded.dictionary), num_threads=1))
    offsets = pa.array(4 * np.concatenate([[0], np.cumsum(lengths)]), pa.int64())
    spelt = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, offsets.buffers()[1], pa.py_buffer(ids.astype(">u4").tobytes())])
    kinds = spelt.dictionary_encode()
    order = pc.sort_indices(kinds.dictionary).to_numpy().astype(np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    of_word = kinds.indices.to_numpy()
    some = np.empty(len(order), np.int64)
    some[of_word] = np.arange(len(of_word))  # a word of each kind
    return rank[of_word][coded.indices.to_numpy()], _taken(ids, lengths, some[order]), lengths[some[order]]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[Windows]:
    """The words of every training document of (id, text), in windows that tile it, up to ``WINDOWS`` at a time."""
    model = _model()
    begin, end = model.bos_id(), model.eos_id()
    last = begin  # first id of the word before

    def cut(words, sizes, opens, closes):
        nonlocal last
        codes, kinds, kind_lengths = _coded(words, model)
        ids = kinds[_starts(kind_lengths)][codes]
        before = np.where(opens, begin, np.concatenate([[last], ids])[_starts(sizes)])
        first = np.full(len(ids) + int(closes.sum()), end)
        first[np.arange(len(ids)) + np.repeat(np.cumsum(closes) - closes, sizes)] = ids
        last = ids[-1] if len(ids) else last
        return Windows(before, sizes, sizes + closes, first, codes, kinds, kind_lengths)

    waiting, held = [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, RUN_ROWS):
            run = batch.slice(low, RUN_ROWS)
            words, n = split_words(run.column(1).filter(pa.array([not is_held_out(key) for key in run.column(0).to_pylist()], pa.bool_())))
            parts = np.maximum(1, -(-n // WINDOW_WORDS))
            final = np.cumsum(parts) - 1
            sizes, opens, closes = np.full(int(parts.sum()), WINDOW_WORDS), np.zeros(int(parts.sum()), bool), np.zeros(int(parts.sum()), np.int64)
            sizes[final], opens[final - parts + 1], closes[final] = n - (parts - 1) * WINDOW_WORDS, True, 1
            waiting.append((words, sizes, opens, closes))
            held += len(sizes)
            if held >= WINDOWS:
                words, (sizes, opens, closes) = pa.concat_arrays([w[0] for w in waiting]), map(np.concatenate, zip(*(w[1:] for w in waiting)))
                while len(sizes) >= WINDOWS:
                    size = int(sizes[:WINDOWS].sum())
                    yield cut(words[:size], sizes[:WINDOWS], opens[:WINDOWS], closes[:WINDOWS])
                    words, sizes, opens, closes = words[size:], sizes[WINDOWS:], opens[WINDOWS:], closes[WINDOWS:]
                waiting, held = [(words, sizes, opens, closes)], len(sizes)
    if held:
        yield cut(pa.concat_arrays([w[0] for w in waiting]), *map(np.concatenate, zip(*(w[1:] for w in waiting))))


def training_windows(docs: DataFrame) -> DataFrame:
    """(before, first, words): the words of every training document, in windows that tile it.

    ``before`` is the first id of the word before the window (the begin, at the text's
    start), ``first`` holds the first ids of its words (and the end, where the text
    ends), ``words`` the ids of each word.
    """

    def lists(lengths, values):
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)

    def rows(batches):
        for w in _windows(batches):
            words = lists(w.kind_lengths, pa.array(w.kinds, pa.int32())).take(pa.array(w.codes))
            columns = [pa.array(w.before, pa.int32()), lists(w.lengths, pa.array(w.first, pa.int32())), lists(w.sizes, words)]
            yield pa.RecordBatch.from_arrays(columns, names=["before", "first", "words"])

    return docs.mapInArrow(rows, "before int, first array<int>, words array<array<int>>")


#: What training reads of ``Windows``; ``counts`` tells how often a kind stands in them.
STORED = ("before", "lengths", "first", "kinds", "kind_lengths", "counts")


def window_packets(docs: DataFrame) -> DataFrame:
    """(packet): ``training_windows`` as few large rows, the distinct words of each told once, with counts."""

    def packets(batches):
        for w in _windows(batches):
            columns = vars(w) | {"counts": np.bincount(w.codes, minlength=len(w.kind_lengths))}
            packet = pack(**{name: pa.array([columns[name].astype(np.int32)], pa.list_(pa.int32())) for name in STORED})
            yield pa.RecordBatch.from_arrays([pa.array([packet], pa.binary())], names=["packet"])

    return docs.mapInArrow(packets, "packet binary")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    for batch in batches:
        for packet in batch.column(0):
            table = unpack(packet.as_py())
            yield {name: table[name].combine_chunks().flatten().to_numpy().astype(np.int64) for name in STORED}


def _onward(w: dict[str, np.ndarray], which: np.ndarray, end: int) -> np.ndarray:
    """Of the distinct words ``which``, the ids behind the first, and the end."""
    ends = np.cumsum(w["kind_lengths"])
    shifted = np.concatenate([w["kinds"][1:], [end]])
    shifted[ends - 1] = end
    return _taken(shifted, w["kind_lengths"], which)


def _steps(w: dict[str, np.ndarray], end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, ids before them, how often) for the outer and for the inner model."""
    behind = np.concatenate([[0], w["first"][:-1]])
    full = w["lengths"] > 0
    behind[_starts(w["lengths"])[full]] = w["before"][full]
    yield w["first"], behind, np.ones(len(behind))
    yield _onward(w, np.arange(len(w["counts"])), end), w["kinds"], np.repeat(w["counts"], w["kind_lengths"]).astype(float)


def _followers(packets: DataFrame, groups: tuple[np.ndarray, np.ndarray], width: int) -> list[np.ndarray]:
    """For each model, how often every id stands behind every group of ids, over all training ids."""
    size, end = _model().get_piece_size(), _model().eos_id()

    def count(batches):
        sums = [np.zeros(size * width) for _ in groups]
        for w in _opened(batches):
            for total, group, (ids, before, n) in zip(sums, groups, _steps(w, end)):
                total += np.bincount(ids * width + group[before], n, len(total))
        for k, total in enumerate(sums):
            some = np.flatnonzero(total)
            columns = [pa.array(np.full(len(some), k), pa.int32()), pa.array(some, pa.int64()), pa.array(total[some].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["model", "step", "n"])

    found = packets.mapInArrow(count, "model int, step bigint, n bigint").groupBy("model", "step").agg(F.sum("n").alias("n")).toArrow()
    model, step, n = (found[c].to_numpy() for c in ("model", "step", "n"))
    out = []
    for k in range(len(groups)):
        table = np.zeros(size * width)
        table[step[model == k]] = n[model == k]
        out.append(table.reshape(size, width))
    return out


def _started(packets: DataFrame) -> tuple[Attention, Attention]:
    """Classes from the counts of (before, id) over all training ids, bounded by the model's vocabulary; weights at their start."""
    size = _model().get_piece_size()
    nothing = np.zeros(size, np.int64)
    counts = [table[:, 0] for table in _followers(packets, (nothing, nothing), 1)]
    groups = []
    for n in counts:
        group = COMMON + np.arange(size) % RESTS
        group[np.argsort(-n, kind="stable")[:COMMON]] = np.arange(min(COMMON, size))
        groups.append(group)
    models = []
    for n, followers, block in zip(counts, _followers(packets, tuple(groups), COMMON + RESTS), (OUTER, INNER)):
        vocabulary = attention.vocabulary(n, followers.astype(np.float32))
        models.append(Attention(attention.start(vocabulary, n, block), vocabulary, block))
    return models[0], models[1]


def _flat(params: dict) -> np.ndarray:
    return np.concatenate([params[n].ravel() for n in attention.NAMES])


def _shaped(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for n in attention.NAMES:
        out[n] = flat[at : at + like[n].size].reshape(like[n].shape)
        at += like[n].size
    return out


def _round(packets: DataFrame, outer: Attention, inner: Attention, rate: float) -> list[dict]:
    """Averages over partitions of the weights after each one's own pass; empty partitions do not count."""
    sent = packets.sparkSession.sparkContext.broadcast((outer, inner))
    end = _model().eos_id()

    def learn(batches):
        outer, inner = sent.value
        over, within, n = outer.params, inner.params, 0
        over_memory, within_memory = {}, {}
        for w in _opened(batches):
            over = attention.train(over, outer.vocabulary, w["first"], w["lengths"], w["before"], OUTER, rate, memory=over_memory)
            lengths = w["kind_lengths"]
            mixed = np.random.default_rng(len(lengths)).permutation(len(lengths))
            opening = w["kinds"][_starts(lengths)][mixed]
            within = attention.train(within, inner.vocabulary, _onward(w, mixed, end), lengths[mixed], opening, INNER, rate, memory=within_memory)
            n += len(w["lengths"])
        if n:
            flat = np.concatenate([_flat(over), _flat(within)])
            parts = np.array_split(flat, range(PART, flat.size, PART))
            columns = [pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "n", "weights"])

    def mean(table: pa.Table) -> pa.Table:
        n = np.array(table["n"].to_pylist(), np.float64)
        total = sum(w * np.frombuffer(b, np.float32) for w, b in zip(n / n.sum(), table["weights"].to_pylist()))
        return pa.table({"part": table["part"][:1], "weights": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    learnt = packets.mapInArrow(learn, "part int, n bigint, weights binary")
    rows = learnt.groupBy("part").applyInArrow(mean, "part int, weights binary").collect()  # one set of weights
    if not rows:
        return [outer.params, inner.params]
    flat = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(rows, key=lambda r: r["part"])])
    cut = _flat(outer.params).size
    return [_shaped(flat[:cut], outer.params), _shaped(flat[cut:], inner.params)]


def train_model(docs: DataFrame) -> tuple[Attention, Attention]:
    """Outer and inner model from the training documents of ``docs`` (id, text)."""
    packets = written(window_packets(docs), "lm-windows")
    outer, inner = _started(packets)
    for k in range(ROUNDS):
        outer.params, inner.params = _round(packets, outer, inner, 0.3 / (1 + k))
    return outer, inner


def _unpacked(batches):
    for batch in batches:
        for packet in batch.column(0).to_pylist():
            yield from unpack(packet).to_batches()


def _inside(inner: Attention, ids: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """Log probability, for each word, of its ids behind the first and of its end."""
    onward = np.concatenate([ids[1:], [end]])
    onward[np.cumsum(lengths) - 1] = end
    out = np.zeros(len(lengths))
    starts = _starts(lengths)
    for low in range(0, len(lengths), 50_000):
        some = lengths[low : low + 50_000]
        stream = onward[starts[low] : starts[low] + int(some.sum())]
        logs = attention.log_probabilities(inner.params, inner.vocabulary, stream, some, ids[starts[low : low + 50_000]], INNER)
        out[low : low + 50_000] = np.add.reduceat(logs.astype(np.float64), _starts(some))
    return out


def _copies(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Share of equal words among all earlier words of the same text."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((words, doc))
    w, d = words[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (d[1:] != d[:-1])]))
    earlier = np.empty(len(words))
    earlier[order] = np.arange(len(words)) - np.repeat(first, np.diff(np.concatenate([first, [len(words)]])))
    at = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return earlier / np.maximum(at, 1)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents that are not held out and scores all, whole texts. NULL
    is the empty text, whose only token is the end. Without training documents every
    count is 0 and the model stays at its start. Repeated documents give repeated
    rows; an empty table none; ids are integers or strings, other columns are not read.
    ``docs`` is read twice and must come in the same order (a stored table does); if it
    does not, the query fails instead of scoring without counts.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    if kind in ("int", "smallint", "tinyint"):
        source, kind = source.withColumn("doc_id", F.col("doc_id").cast("bigint")), "bigint"
    arrow = pa.int64() if kind == "bigint" else pa.string()
    outer, inner = train_model(source)
    context = source.sparkSession.sparkContext
    sent_outer, sent_inner = context.broadcast(outer), context.broadcast(inner)
    size, begin, end = _model().get_piece_size(), _model().bos_id(), _model().eos_id()

    def split(ids, texts):
        words, lengths = split_words(pa.array(texts, pa.large_string()))
        learnt = np.array([not is_held_out(key) for key in ids], np.int64)
        coded = words.dictionary_encode()
        n = np.bincount(coded.indices.to_numpy(), np.repeat(learnt, lengths), len(coded.dictionary))
        counts = dict(zip(_strings(coded.dictionary), n.astype(np.int64).tolist()))
        counts[END] = int(learnt.sum())
        return counts

    def answer(counts):
        ids, lengths = _joined([ids if w else [end] for w, ids in zip(counts, _model().encode(list(counts), num_threads=1))])
        return {
            "n": pa.array(counts.values(), pa.int64()),
            "first": pa.array(ids[_starts(lengths)], pa.int32()),
            "inside": pa.array(_inside(sent_inner.value, ids, lengths, end).astype(np.float32), pa.float32()),
        }

    def summary(counts, columns):
        """Training count and number of training words by first id."""
        first, n = columns["first"].to_numpy(), columns["n"].to_numpy()
        mass, kinds = np.bincount(first, n, size), np.bincount(first, n > 0, size)
        some = np.flatnonzero(mass)
        return pack(first=pa.array(some), mass=pa.array(mass[some].astype(np.int64)), kinds=pa.array(kinds[some].astype(np.int64)))

    buckets = bucket_count(source)
    table = written(answered(chunk_packets(source, split, buckets), answer, summary), "lm-words")
    told = table.where("summary IS NOT NULL").select("summary").mapInArrow(_unpacked, "first bigint, mass bigint, kinds bigint")
    mass, kinds = np.zeros(size), np.zeros(size)
    for row in told.groupBy("first").agg(F.sum("mass").alias("mass"), F.sum("kinds").alias("kinds")).collect():
        mass[row["first"]], kinds[row["first"]] = row["mass"], row["kinds"]
    distinct, total = int(kinds.sum()), int(mass.sum())
    norm = math.log10(total + 0.1 * (distinct + 1))
    sent_first = context.broadcast((mass, kinds))

    def use(ids, texts, found):
        index: dict[str, int] = {}
        codes, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low in range(0, len(texts), RUN_ROWS):  # some rows at a time, so that few of their words are held
            words, n = split_words(pa.array(texts[low : low + RUN_ROWS], pa.large_string()))
            coded = words.dictionary_encode()
            of = np.fromiter((index.setdefault(w, len(index)) for w in _strings(coded.dictionary)), np.int32, len(coded.dictionary))
            codes.append(of[coded.indices.to_numpy()])
            lengths.append(n)
        index[END] = len(index)
        places, tables = np.full(len(index), -1), []
        at = 0
        for part, table in found.columns(index):
            places[np.fromiter(map(index.__getitem__, part), np.int64, len(part))] = np.arange(at, at + len(part))
            at += len(part)
            tables.append(table)
        if texts and (places < 0).any():
            raise RuntimeError("the input changed between two reads: words without counts")
        codes, lengths = np.concatenate(codes), np.concatenate(lengths)
        every = np.full(len(codes) + len(texts), places[-1])
        every[np.arange(len(codes)) + np.repeat(np.arange(len(texts)), lengths)] = places[codes]
        lengths += 1  # the end
        starts = _starts(lengths)
        of = {n: np.concatenate([t[n].to_numpy() for t in tables]) if tables else np.zeros(0, np.int64) for n in ("n", "first", "inside")}
        count, first, outer = of["n"], of["first"].astype(np.int64), sent_outer.value
        mass, kinds = (x[first] for x in sent_first.value)
        base = np.log10(count + 0.1) - norm
        kept = np.maximum(count - DISCOUNT, 0) / np.maximum(mass, 1)
        rest = np.where(mass > 0, DISCOUNT * kinds / np.maximum(mass, 1), 1.0)
        among = np.where(first == end, 1.0, kept + rest * np.exp(np.maximum(of["inside"].astype(np.float64), -600)))
        rows = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        at = 0
        while at < len(texts):  # some texts at a time, so that what is made of their ids stays a bounded array
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + 100_000)))
            some = lengths[at:to]
            w = every[starts[at] : starts[at] + int(some.sum())]
            at = to
            logs = attention.log_probabilities(outer.params, outer.vocabulary, first[w], some, np.full(len(some), begin), OUTER)
            likely = np.exp(logs.astype(np.float64)) * among[w]
            score = np.log10((1 - COPY) * likely + COPY * _copies(w, some))
            begins = _starts(some)
            rows["n_tokens"] += some.tolist()
            rows["n_known"] += np.add.reduceat((count[w] > 0).astype(np.int64), begins).tolist()
            rows["base_score"] += np.add.reduceat(base[w], begins).tolist()
            rows["score"] += np.add.reduceat(score, begins).tolist()
        return pa.table(
            {
                "doc_id": pa.array(ids, arrow),
                "held_out": pa.array([is_held_out(k) for k in ids], pa.bool_()),
                "n_tokens": pa.array(rows["n_tokens"], pa.int64()),
                "n_known": pa.array(rows["n_known"], pa.int64()),
                "train_tokens": pa.array([total] * len(ids), pa.int64()),
                "base_score": pa.array(rows["base_score"], pa.float64()),
                "score": pa.array(rows["score"], pa.float64()),
            }
        )

    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return by_block(text_blocks(source), table, use, buckets, schema)
