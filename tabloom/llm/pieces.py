"""SentencePiece encoding and decoding over a table of distinct marked words.

No piece of the model may hold a whitespace marker behind another character; then no
merge crosses the start of a marked word, and a text's ids are those of its marked
words one after the other. Every distinct marked word is segmented once, by the
library, and its ids are joined back by position.
"""

from __future__ import annotations

import hashlib
import re

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.chunks import RUN_ROWS, answered, bucket_count, by_block, chunk_packets, text_blocks

MODEL = "piece_bpe_32k.model"
MARK = "▁"
MARKED = re.compile(f"{MARK}+[^{MARK}]*")
_LOADED: dict[str, "MarkedWords"] = {}


class MarkedWords:
    """A model whose pieces do not cross markers; words are written without their first marker."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        if any(MARK in piece.lstrip(MARK) for piece in pieces) or self.model.normalize("  a") != MARK * 3 + "a":
            raise ValueError("pieces of this model cross whitespace markers, or it drops white space")
        self.end = self.model.eos_id()
        self.mark = self.model.piece_to_id(MARK)

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        text = self.model.normalize(text)
        if MARK + MARK in text or text.endswith(MARK):
            return [word[1:] for word in MARKED.findall(text)]
        return text[1:].split(MARK)

    def segment(self, words: list[str]) -> list[list[int]]:
        return [ids if word else [self.mark] for word, ids in zip(words, self.model.encode(words, num_threads=1))]

    def spell(self, words: list[str], segmented: list[list[int]]) -> list[str]:
        """What the ids of each word, behind another word, decode to."""
        first = self.segment(["a"])[0]
        decoded = self.model.decode([first + ids for ids in segmented], num_threads=1)
        return [text[1:] for text in decoded]


def marked_words(path: str) -> MarkedWords:
    if path not in _LOADED:
        _LOADED[path] = MarkedWords(path)
    return _LOADED[path]


def _path(path: str | None) -> str:
    return path or public_tokenizers.path(MODEL)


def _encoded(docs: DataFrame, path: str | None, finish, schema: str) -> DataFrame:
    """``finish(ids of documents, [strings of ids], [numbers of ids], [decoded texts])`` for every block."""

    def split(_, texts):
        words: set[str] = set()
        for text in texts:
            words.update(marked_words(_path(path)).split(text))
        return dict.fromkeys(words, 1)

    def answer(counts):
        model, words = marked_words(_path(path)), list(counts)
        segmented = model.segment(words)
        spelt = model.spell(words, segmented)
        plain = [" " + w.replace(MARK, " ") for w in words]
        return {
            "ids": pa.array([" ".join(map(str, ids)) for ids in segmented], pa.string()),
            "spelt": pa.array([None if s == p else s for s, p in zip(spelt, plain)], pa.string()),
        }

    def use(ids, texts, found):
        model = marked_words(_path(path))
        distinct: set[str] = set()
        for text in texts:  # split twice rather than keep all words of the block
            distinct.update(model.split(text))
        coded: dict[str, str] = {}
        odd: dict[str, str] = {}
        for words, table in found.columns(distinct):
            coded.update(zip(words, table["ids"].to_pylist()))
            if table["spelt"].null_count < len(words):
                odd.update((w, s) for w, s in zip(words, table["spelt"].to_pylist()) if s is not None)
        fresh = sorted(distinct - coded.keys())  # only if the input changed its order between two reads
        if fresh:
            segmented = model.segment(fresh)
            coded.update((w, " ".join(map(str, ids))) for w, ids in zip(fresh, segmented))
            odd.update((w, s) for w, s in zip(fresh, model.spell(fresh, segmented)) if s != " " + w.replace(MARK, " "))
        end = str(model.end)
        out = []
        for low in range(0, max(1, len(texts)), RUN_ROWS):  # some rows at a time, so that few of their strings are held
            part = slice(low, low + RUN_ROWS)
            out.append(finish(ids[part], *written_out(model, texts[part], coded, odd, end)))
        return pa.concat_tables(out)

    def written_out(model, texts, coded, odd, end):
        strings, sizes, decoded = [], [], []
        for words in map(model.split, texts):
            row = " ".join([*map(coded.__getitem__, words), end])
            strings.append(row)
            sizes.append(row.count(" ") + 1)
            if odd and not odd.keys().isdisjoint(words):
                decoded.append("".join(odd.get(w, " " + w.replace(MARK, " ")) for w in words)[1:])
            else:
                decoded.append(" ".join(words).replace(MARK, " "))
        return strings, sizes, decoded

    buckets = bucket_count(docs)
    packets = answered(chunk_packets(docs, split, buckets), answer)
    return by_block(text_blocks(docs), packets, use, buckets, schema)


def _source(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str, pa.DataType]:
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    if kind in ("int", "smallint", "tinyint"):
        source, kind = source.withColumn("doc_id", F.col("doc_id").cast("bigint")), "bigint"
    return source, kind, pa.int64() if kind == "bigint" else pa.string()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of every document; ids end with the end id.

    Exactly the library's ids and decoded text. NULL counts as the empty text, whose
    only id is the end. Repeated documents give repeated rows, an empty table none;
    ids of documents are integers or strings and may be NULL; other columns are not read.
    """
    source, kind, arrow = _source(docs, id_col, text_col)

    def finish(ids, strings, sizes, decoded):
        lists = [list(map(int, s.split(" "))) for s in strings]
        return pa.table({"doc_id": pa.array(ids, arrow), "ids": pa.array(lists, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())})

    return _encoded(source, path, finish, f"doc_id {kind}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode`` with its outputs digested where they arise."""
    source, kind, arrow = _source(docs, id_col, text_col)

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def finish(ids, strings, sizes, decoded):
        return pa.table(
            {
                "doc_id": pa.array(ids, arrow),
                "n_tokens": pa.array(sizes, pa.int64()),
                "ids_sha256": pa.array(map(sha, strings), pa.string()),
                "decoded_sha256": pa.array(map(sha, decoded), pa.string()),
            }
        )

    return _encoded(source, path, finish, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode(coded: DataFrame, ids_col: str = "ids", text_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``coded`` with the decoded text of its id lists; a NULL list gives NULL, an empty one the empty text."""
    names = [c for c in coded.columns if c != text_col]
    source = coded.select(*names)
    at = names.index(ids_col)

    def read(batches):
        model = marked_words(_path(path)).model
        for batch in batches:
            texts = [None if ids is None else model.decode(ids) if ids else "" for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, text_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(read, f"{fields}, `{text_col}` string")
