"""Phrase collocation mining: sorted suffix pointers, routed by their leading words.

Texts are cut into blocks; a block codes its words once and counts its word pairs
under short keys. Pair counts are dealt by key, added over all blocks, and every
block gets back those of its own pairs that are frequent somewhere; the text shrinks
to runs of such pairs, and the same is done with its runs of three words. Keys only
ever merge what they count, so nothing frequent is missed. Suffix pointers end where
the next three words are not frequent; equal suffixes of a task are counted before
they move, and suffixes are dealt by their two leading words. There a multikey
three-way quicksort splits them word by word: the size of an equal partition is the
count of its phrase, and partitions below the limit are abandoned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tabloom.llm.storage import pack, unpack, written

LONGEST = 5
LEAST = 100
TOP = 2000
NO_LANG = "und"
BLOCK_BYTES = 4 << 20
#: Pair keys of one route: bytes of text that a route stands for.
ROUTE_BYTES = 16 << 20
#: Suffixes that are sorted at once.
CHUNK_ROWS = 500_000
READ_ROWS = 256

BREAK, BLANK, WORD = 2, 1, 0
#: What ends a piece, what parts words.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_CLASS = np.array([BREAK if b in BREAKS else BLANK if b in BLANKS else WORD for b in range(256)], np.uint8)
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else ord(".") if b in BREAKS else b for b in range(256))


def coded_words(blob: bytes) -> tuple[np.ndarray, pa.BinaryArray]:
    """Codes of all words in order, and the distinct words; a break is the word ``.``."""
    raw = np.frombuffer(blob, np.uint8)
    kind = _CLASS[raw]
    before = np.concatenate([[BLANK], kind[:-1]]).astype(np.uint8)
    keep = kind != BLANK
    starts = np.flatnonzero(((kind == BREAK) | (before != WORD))[keep])
    letters = np.frombuffer(blob.translate(_NORMAL), np.uint8)[keep]
    ends = np.append(starts, len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def word_keys(words: pa.BinaryArray, lang: str) -> np.ndarray:
    """A 64-bit key for each distinct word; 0 marks the break."""
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([0 if w == b"." else xxhash.xxh64_intdigest(w, seed) | 1 for w in words.to_pylist()], np.uint64)


def pair_keys(codes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A key of 40 bits for each word and its follower; 0 where one of them is a break."""
    own = keys[codes]
    if len(own) < 2:
        return np.zeros(0, np.uint64)
    left, right = own[:-1], own[1:]
    mixed = (left ^ (right >> np.uint64(31)) ^ (right << np.uint64(33))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) >> np.uint64(24) | np.uint64(1 << 39)
    mixed[(left == 0) | (right == 0)] = 0
    return mixed


def _blocks(source: DataFrame, block_bytes: int, routes: int) -> DataFrame:
    """Rows of three kinds: the coded text of a block, its word counts, its pair counts by route."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def close(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            codes, words = coded_words(b" . ".join(held.pop(lang)))
            sizes.pop(lang)
            name, number = f"{task}-{number}", number + 1
            keys = word_keys(words, lang)
            yield _rows("text", name, lang, [(-1, pack(code=pa.array(codes)), pack(word=words))])
            counts = np.bincount(codes, minlength=len(words)).astype(np.int32)
            yield _rows("words", name, lang, _dealt(keys, counts, routes, lambda mine: pack(word=words.filter(pa.array(mine)))))
            yield _rows("keys", name, lang, _key_packets(pair_keys(codes, keys), routes))

        slices = (batch.slice(at, READ_ROWS) for batch in batches for at in range(0, batch.num_rows, READ_ROWS))
        for part in slices:
            for lang, blob in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                held.setdefault(lang, []).append(blob)
                sizes[lang] = sizes.get(lang, 0) + len(blob)
                if sizes[lang] >= block_bytes:
                    yield from close(lang)
                elif sum(sizes.values()) >= 2 * block_bytes:
                    yield from close(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from close(lang)

    return source.mapInArrow(build, "kind string, block string, lang string, route int, a binary, b binary")


def _dealt(keys: np.ndarray, counts: np.ndarray, routes: int, put: Callable[[np.ndarray], bytes]) -> list[tuple[int, bytes, bytes]]:
    """Packets of what is counted, by route; key 0 stands for breaks."""
    route = np.where(keys == 0, -1, (keys % np.uint64(routes)).astype(np.int64))
    return [(int(r), put(route == r), pack(n=pa.array(counts[route == r]))) for r in np.unique(route[route >= 0])]


def _key_packets(keys: np.ndarray, routes: int) -> list[tuple[int, bytes, bytes]]:
    """Keys with their counts; sorted keys are packed as differences."""
    known, n = np.unique(keys, return_counts=True)
    return _dealt(known, n.astype(np.int32), routes, lambda mine: pack(step=pa.array(np.diff(known[mine], prepend=np.uint64(0)))))


def _rows(kind: str, block: str, lang: str, packets: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    route, a, b = zip(*packets) if packets else ((), (), ())
    n = len(packets)
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * n, pa.string()), pa.array([block] * n, pa.string()), pa.array([lang] * n, pa.string()),
         pa.array(route, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
        names=["kind", "block", "lang", "route", "a", "b"],
    )


def _with_frequent(made: DataFrame, least: int) -> DataFrame:
    """The texts of ``made`` (block, lang, a, b) with those of their keys that are frequent over all blocks."""

    def add(group: pa.Table) -> pa.Table:
        blocks = group["block"].to_pylist()
        keys = [np.cumsum(unpack(p)["step"].to_numpy()) for p in group["a"].to_pylist()]
        counts = [unpack(p)["n"].to_numpy() for p in group["b"].to_pylist()]
        known, place = np.unique(np.concatenate(keys), return_inverse=True)
        often = np.bincount(place, np.concatenate(counts), len(known)) >= least
        answers, at = [], 0
        for own in keys:
            answers.append(own[often[place[at : at + len(own)]]].tobytes())
            at += len(own)
        return pa.table({"block": pa.array(blocks, pa.string()), "keys": pa.array(answers, pa.binary())})

    packets = made.where("kind = 'keys'").select("route", "block", "a", "b")
    answers = packets.groupBy("route").applyInArrow(add, "block string, keys binary")
    answers = answers.groupBy("block").agg(F.collect_list("keys").alias("keys"))  # at most the distinct keys of one block
    return made.where("kind = 'text'").join(answers, "block", "left").select("block", "lang", "a", "b", "keys")


def _is_in(keys: np.ndarray, answers: list[bytes] | None) -> np.ndarray:
    frequent = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in answers])) if answers else np.zeros(0, np.uint64)
    if not len(frequent):
        return np.zeros(len(keys), bool)
    return frequent[np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)] == keys


def triple_keys(pairs: np.ndarray) -> np.ndarray:
    """A key for each word and its two followers, from the keys of their pairs; 0 where a break is among them."""
    left, right = pairs[:-1], pairs[1:]
    mixed = (left * np.uint64(0x9E3779B97F4A7C15) ^ right) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed >> np.uint64(24)) | np.uint64(1 << 39)
    mixed[(left == 0) | (right == 0)] = 0
    return mixed


def runs_of(codes: np.ndarray, live: np.ndarray, stop: int) -> np.ndarray:
    """The words of live pairs, with a break between neighbours that are no live pair."""
    beside = np.append(live, False) | np.concatenate([[False], live])
    kept = np.flatnonzero(beside)
    gaps = np.flatnonzero(~np.append(live, False)[kept])
    return np.insert(codes[kept], gaps + 1, stop)


def _shrunk(texts: DataFrame, routes: int) -> DataFrame:
    """The blocks again, cut down to runs of frequent pairs, with the counts of their runs of three words."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, lang, a, b, answers = (batch.column(k)[at].as_py() for k in range(5))
                codes, words = unpack(a)["code"].to_numpy(), unpack(b)["word"].combine_chunks()
                words = pa.concat_arrays([words, pa.array([b"."], pa.binary())])
                keys = word_keys(words, lang)
                codes = runs_of(codes, _is_in(pair_keys(codes, keys), answers), len(words) - 1)
                used, codes = np.unique(codes, return_inverse=True)
                yield _rows("text", block, lang, [(-1, pack(code=pa.array(codes.astype(np.int32))), pack(word=words.take(pa.array(used))))])
                yield _rows("keys", block, lang, _key_packets(triple_keys(pair_keys(codes, keys[used])), routes))

    return texts.mapInArrow(shrink, "kind string, block string, lang string, route int, a binary, b binary")


def suffixes_of(codes: np.ndarray, pairs: np.ndarray, live: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes as rows of codes (-1 behind their end) with their counts.

    A suffix starts with a pair and goes on while the three words that end it are ``live``.
    """
    first = np.flatnonzero(pairs)
    table = np.full((len(first), longest), -1, np.int32)
    if not len(first):
        return table, np.zeros(0, np.int64)
    table[:, 0], table[:, 1] = codes[first], codes[first + 1]
    goes_on = np.ones(len(first), bool)
    padded = np.append(live, np.zeros(longest, bool))
    for k in range(2, longest):
        goes_on = goes_on & padded[first + k - 2]
        table[goes_on, k] = codes[first[goes_on] + k]
    order = np.lexsort(table.T[::-1])
    table = table[order]
    edge = np.flatnonzero(np.concatenate([[True], (table[1:] != table[:-1]).any(axis=1)]))
    return table[edge], np.diff(np.append(edge, len(table)))


def equal_partitions(table: np.ndarray, weight: np.ndarray, least: int, emit: Callable[[tuple[int, ...], int], None]) -> None:
    """Multikey three-way quicksort of suffixes; ``emit(phrase, count)`` for every equal partition of two words or more.

    A partition is split by a pivot word at its depth. The equal part goes on to the
    next word; a part that weighs less than ``least`` is abandoned.
    """
    stack = [(np.arange(len(table)), 0, ())]
    while stack:
        rows, depth, path = stack.pop()
        if not len(rows) or weight[rows].sum() < least:
            continue
        word = table[rows, depth]
        pivot = np.partition(word, len(word) // 2)[len(word) // 2]
        below, above = word < pivot, word > pivot
        if below.any():
            stack.append((rows[below], depth, path))
        if above.any():
            stack.append((rows[above], depth, path))
        if pivot < 0:
            continue
        equal = rows[word == pivot]
        total, phrase = int(weight[equal].sum()), (*path, int(pivot))
        if total < least:
            continue
        if len(phrase) > 1:
            emit(phrase, total)
        if len(phrase) < table.shape[1]:
            stack.append((equal, depth + 1, phrase))


def _suffix_packets(texts: DataFrame, routes: int, longest: int, chunk_rows: int) -> DataFrame:
    """(route, a): the suffixes of all blocks that may hold frequent phrases, counted in their task and dealt by their two leading words."""
    names = ["lang", *_w(longest)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def packets() -> Iterator[pa.RecordBatch]:
            table = held.pop()
            route = (_text_hash(table["w1"]) * np.uint64(0x9E3779B97F4A7C15) ^ _text_hash(table["w2"])) % np.uint64(routes)
            for r in np.unique(route):
                part = table.filter(pa.array(route == r)).combine_chunks()
                packet = pack(**{c: part[c].combine_chunks() for c in [*names, "n"]})
                yield pa.RecordBatch.from_arrays([pa.array([int(r)], pa.int32()), pa.array([packet], pa.binary())], names=["route", "a"])

        for batch in batches:
            for at in range(batch.num_rows):
                _, lang, a, b, answers = (batch.column(k)[at].as_py() for k in range(5))
                codes, words = unpack(a)["code"].to_numpy(), unpack(b)["word"].combine_chunks()
                pairs = pair_keys(codes, word_keys(words, lang))
                table, n = suffixes_of(codes, pairs, _is_in(triple_keys(pairs), answers), longest)
                spelt = words.cast(pa.string())
                columns = [spelt.take(pa.array(c, mask=c < 0)) for c in table.T]
                held.append(pa.table([pa.array([lang] * len(n), pa.string()), *columns, pa.array(n, pa.int64())], names=[*names, "n"]))
                if sum(map(len, held)) >= chunk_rows:
                    held = [_added(held, names)]
                    if 2 * len(held[0]) >= chunk_rows:
                        yield from packets()
        if held:
            held = [_added(held, names)]
            yield from packets()

    return texts.mapInArrow(cut, "route int, a binary")


def _added(tables: list[pa.Table], names: list[str]) -> pa.Table:
    """Equal suffixes as one row with the sum of their counts."""
    return pa.concat_tables(tables).group_by(names).aggregate([("n", "sum")]).rename_columns([*names, "n"])


def _text_hash(words: pa.ChunkedArray) -> np.ndarray:
    coded = words.combine_chunks().dictionary_encode()
    own = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()] or [0], np.uint64)
    return own[coded.indices.to_numpy()]


def _w(longest: int) -> list[str]:
    return [f"w{k}" for k in range(1, longest + 1)]


def _phrases(suffixes: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, phrase, n) of all phrases that reach ``least``; all suffixes with the same two leading words share a route."""
    names = ["lang", *_w(longest)]

    def sort(group: pa.Table) -> pa.Table:
        table = _added([unpack(p) for p in group["a"].to_pylist()], names)
        langs, phrases, counts = [], [], []
        for lang in pc.unique(table["lang"]).to_pylist():
            part = table.filter(pc.equal(table["lang"], lang))
            known = pc.unique(pa.chunked_array([c for w in _w(longest) for c in part[w].chunks], pa.string()).drop_null())
            coded = np.stack([pc.fill_null(pc.index_in(part[w], known), -1).to_numpy().astype(np.int32) for w in _w(longest)], axis=1)
            spelt, found = known.to_pylist(), {}
            equal_partitions(coded, part["n"].to_numpy(), least, found.__setitem__)
            langs += [lang] * len(found)
            phrases += [" ".join(spelt[c] for c in phrase) for phrase in found]
            counts += found.values()
        return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()), "n": pa.array(counts, pa.int64())})

    return suffixes.groupBy("route").applyInArrow(sort, "lang string, phrase string, n bigint")


def _frequent_words(words: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of words that reach ``least``; a row without phrase counts all words of its route."""

    def add(key: tuple, group: pa.Table) -> pa.Table:
        seen = pa.table(
            {
                "word": pa.chunked_array([c for p in group["a"].to_pylist() for c in unpack(p)["word"].chunks], pa.binary()),
                "n": pa.chunked_array([c for p in group["b"].to_pylist() for c in unpack(p)["n"].chunks], pa.int32()).cast(pa.int64()),
            }
        )
        every = pc.sum(seen["n"]).as_py()
        seen = seen.group_by("word").aggregate([("n", "sum")])
        often = seen.filter(pc.greater_equal(seen["n_sum"], least))
        phrase = pa.chunked_array([*often["word"].cast(pa.string()).chunks, pa.array([None], pa.string())])
        n = pa.chunked_array([*often["n_sum"].chunks, pa.array([every], pa.int64())])
        return pa.table({"lang": pa.array([key[0].as_py()] * len(n), pa.string()), "phrase": phrase, "n": n})

    return words.select("lang", "route", "a", "b").groupBy("lang", "route").applyInArrow(add, "lang string, phrase string, n bigint")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, block_bytes: int = BLOCK_BYTES, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language.

    A phrase has 2 to ``longest`` words and occurs ``least`` times; its score is that of
    its weakest cut into two parts, floor(1000 * a * n / (l * r)). A phrase inside a
    longer one that is as frequent is left out. NULL texts count as empty; rows without
    language belong to ``und``; repeated rows count each; ties are ranked by count, then
    by the bytes of the phrase. Empty tables and texts give no rows; other columns are
    not read. Two words give different phrases if any byte but A-Z/a-z differs.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)) if lang_col else F.lit(NO_LANG)
    source = docs.select(lang.alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    routes = 1 + size // ROUTE_BYTES
    made = written(_blocks(source, block_bytes, routes), "phrases-blocks")

    words = written(_frequent_words(made.where("kind = 'words'"), least), "phrases-words")
    runs = written(_shrunk(_with_frequent(made, least), routes), "phrases-runs")
    suffixes = _suffix_packets(_with_frequent(runs, least), routes, longest, chunk_rows)
    phrases = written(_phrases(suffixes, least, longest), "phrases-counts")
    return rank_phrases(phrases, words, top)


def rank_phrases(phrases: DataFrame, words: DataFrame, top: int = TOP) -> DataFrame:
    """The ranking from (lang, phrase, n) of all frequent phrases and words; rows of ``words`` without phrase count all words."""
    own = F.split("phrase", " ", -1)
    parted = phrases.select("lang", "phrase", F.col("n").alias("a"), own.alias("w"), F.size(own).alias("m"))

    inner = F.explode(
        F.flatten(
            F.transform(F.sequence(F.lit(2), F.col("m") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("m") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " ")))
        )
    )
    inside = parted.where("m > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    left = parted.join(inside, ["lang", "phrase"], "left").where("_longer IS NULL OR _longer < a").drop("_longer")

    part = lambda first, size: F.array_join(F.slice("w", first, size), " ")
    cuts = left.select("lang", "phrase", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("m") - F.col("k")).alias("tail"))
    counts = phrases.unionByName(words.where("phrase IS NOT NULL"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    sizes = words.where("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    whole = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products stay within 38 digits
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * whole("n"), whole("l") * whole("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(sizes, "lang").withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("_cut")).select("lang", "phrase", "_cut.*")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = weakest.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, range(1, 6) AS t(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 100),
inside AS (SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, max(a) AS longer
           FROM (SELECT lang, w, a, k, unnest(range(1, m - k + 2)) AS i FROM c, range(2, 5) AS t(k) WHERE k < m) GROUP BY ALL),
cuts AS (SELECT c.lang, c.phrase, c.a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : m], ' ') AS tail
         FROM c LEFT JOIN inside USING (lang, phrase), range(1, 5) AS t(k) WHERE k < m AND (longer IS NULL OR longer < c.a)),
scored AS (SELECT lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r, n,
                  CAST(1000 * CAST(cuts.a AS HUGEINT) * n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
           FROM cuts JOIN f x USING (lang) JOIN f y USING (lang) JOIN sizes USING (lang) WHERE x.phrase = head AND y.phrase = tail),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest QUALIFY rank <= 2000
"""
