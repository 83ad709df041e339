"""Personal data behind disguises, by transducers that keep the offsets of the source.

Plain identifiers are found in the text as it stands. Disguised ones are found in a
rewritten text: a chain of small transducers (characters that look like others, spelled
digits, written-out at and dot) replaces what it knows and keeps, for every character
of its output, where that came from in the source. A find in the rewritten text that
holds a rewritten character is mapped back to the source. Texts are read where they
lie, in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

Span = tuple[int, int]

# ---- fixed values -------------------------------------------------------------
KINDS = ("email", "ip", "card", "phone")
#: Characters that look like an ASCII character, one for one.
LOOKALIKES = {
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ",
    "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "УΥ", "Z": "Ζ",
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "еҽ", "h": "һ", "i": "іι", "j": "ј", "k": "κ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ",
    "q": "ԛ", "r": "г", "s": "ѕ", "u": "υս", "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уγ", "z": "ᴢ",
    "@": "＠﹫", ".": "．。｡․﹒", "-": "－‐‑‒–—−﹣", "+": "＋﹢", "_": "＿", "(": "（", ")": "）", " ": "\u00a0\u2002\u2003\u2007\u2009\u202f\u3000",
}
#: First digits of the scripts that count from 0 to 9 in a row, and of circled and superscript forms.
DIGIT_ROWS = (0x0660, 0x06F0, 0x0966, 0x09E6, 0x0E50, 0xFF10, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)
#: Rows of letters that repeat A-Z and a-z: full width, and mathematical bold, sans and monospaced ones.
LETTER_ROWS = ((0xFF21, 0xFF41), (0x1D400, 0x1D41A), (0x1D5A0, 0x1D5BA), (0x1D5D4, 0x1D5EE), (0x1D670, 0x1D68A))
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Names of the digits in English, German, French and Spanish.
DIGIT_NAMES = {
    "0": "zero null zéro cero", "1": "one eins uno", "2": "two zwei zwo deux dos", "3": "three drei trois tres", "4": "four vier quatre cuatro",
    "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete", "8": "eight acht huit ocho", "9": "nine neun neuf nueve",
}
TIMES = {"double": 2, "doppel": 2, "doble": 2, "triple": 3}
AT_WORDS = "at|ät|arroba|arobase"
DOT_WORDS = "dot|d0t|punkt|punto|point"
PLAIN_DOT_WORDS = "dot|punkt|punto"
PLUS_WORDS = "plus|más"
# -------------------------------------------------------------------------------

SAME_LENGTH = str.maketrans(
    {look: plain for plain, all_of in LOOKALIKES.items() for look in all_of}
    | {chr(first + k): str(k) for first in DIGIT_ROWS for k in range(10)}
    | {chr(first + k): chr(base + k) for row in LETTER_ROWS for first, base in zip(row, (65, 97)) for k in range(26)}
)
_VALUE = {name: digit for digit, names in DIGIT_NAMES.items() for name in names.split()}
_HIDDEN = re.compile(f"[{INVISIBLE}]+")
_DIGIT_WORD = rf"(?:(?:{'|'.join(TIMES)})[ -])?(?:{'|'.join(sorted(_VALUE, key=len, reverse=True))})"
_SPELLED = re.compile(rf"(?<!\w)(?:{_DIGIT_WORD}|[0-9]+)(?:[ ,-]{{1,2}}(?:{_DIGIT_WORD}|[0-9]+))*(?!\w)", re.I)
_DIGIT_TOKEN = re.compile(rf"{_DIGIT_WORD}|[0-9]+", re.I)
_LETTER_DIGITS = re.compile(r"(?<=[0-9])[oOlI|](?=[0-9])")
_DOT = re.compile(
    rf"\s?[(\[{{<]\s?(?:{DOT_WORDS}|\.)\s?[)\]}}>]\s?|(?<=\w)(?:[ \t]+|_|-)(?:{PLAIN_DOT_WORDS})(?:[ \t]+|_|-)(?=\w)|&#(?:46|x2e);|&period;|(?<=\w)[ \t]\.[ \t](?=\w)", re.I
)
_AT = re.compile(rf"\s?[(\[{{<]\s?(?:{AT_WORDS}|@)\s?[)\]}}>]\s?|&#(?:64|x40);|&commat;|(?<=\w)%40(?=\w)|(?<=\w)[ \t]@[ \t]?(?=\w)|(?<=\w)@[ \t](?=\w)", re.I)
_PLAIN_AT = re.compile(rf"(?<=[A-Za-z0-9])(?:[ \t]+|_|-)(?:{AT_WORDS})(?:[ \t]+|_|-)(?=([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+))", re.I)
_PLUS = re.compile(rf"(?<!\w)(?:{PLUS_WORDS})[ \t]+(?=[0-9(])", re.I)
_LOOKS = frozenset(map(chr, SAME_LENGTH)) | frozenset(INVISIBLE)


@functools.cache
def _signs() -> ahocorasick.Automaton:
    """What must stand somewhere in a text (lower case) before its ASCII part can hide anything."""
    digits, names = "0123456789", [*_VALUE, *TIMES]
    tokens = [(name, near) for name in names for near in [*names, *digits]]
    signs = {a + gap + b for name, near in tokens for a, b in ((name, near), (near, name)) for gap in (" ", "-", ",", ", ", ".")}
    signs |= {gap + word + end for word in PLAIN_DOT_WORDS.split("|") for gap in " \t_-" for end in " \t_-"}
    signs |= {first + space + word for word in f"{DOT_WORDS}|{AT_WORDS}|.|@".split("|") for first in "([{<" for space in ("", " ")}
    signs |= {"&#46;", "&#x2e;", "&period;", "&#64;", "&#x40;", "&commat;", "%40", " . ", "\t.\t", " @", "@ ", "\t@", "@\t"}
    signs |= {a + letter + b for a in digits for letter in "oli|" for b in digits}
    signs |= {word + gap + first for word in PLUS_WORDS.split("|") for gap in " \t" for first in digits + "("}
    found = ahocorasick.Automaton()
    for sign in signs:
        found.add_word(sign, True)
    found.make_automaton()
    return found


def may_hide(text: str) -> bool:
    """False for a text that no transducer would change in a way that shows an identifier."""
    if not text.isascii() and not _LOOKS.isdisjoint(text):
        return True
    return next(_signs().iter(text.lower()), None) is not None


_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match that failed at the first digit of a run fails at its other digits too
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
_COUNTRY = re.compile("[A-Za-z]{2,}")


def emails(text: str) -> list[Span]:
    """Leftmost addresses that do not overlap; reads back from every @, so long runs cost no more."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        first = at
        while first > free and text[first - 1] in _LOCAL:
            first -= 1
        host = _DOMAIN.match(text, at + 1) if first < at else None
        if host:
            found.append((first, host.end()))
            free = host.end()
        at = text.find("@", max(at + 1, free))
    return found


def luhn(digits: str) -> bool:
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _card(run: str) -> bool:
    digits = _NOT_DIGIT.sub("", run)
    return 16 <= len(digits) <= 19 and luhn(digits)


def plain_spans(text: str) -> dict[str, list[Span]]:
    """Identifiers of ``text`` as it stands, by kind."""
    spans = {
        "email": emails(text),
        "ip": [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))],
        "card": [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and _card(m[0])],
        "phone": [],
    }
    if "+" in text:
        spans["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


class Rewritten:
    """A text, and for each of its characters the source characters it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text), dtype=np.int64)
        self.end = self.start + 1
        self.touched = np.zeros(len(text), bool)

    def translate(self, table: dict[int, str]) -> None:
        """One character for one."""
        text = self.text.translate(table)
        if text != self.text:
            codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (self.text, text)]
            self.touched |= codes[0] != codes[1]
            self.text = text

    def rewrite(self, pattern: re.Pattern, put: Callable[[re.Match, Rewritten], str | None]) -> None:
        """Put ``put(match, self)`` for every match; None leaves a match as it is."""
        pieces, starts, ends, touched, at = [], [], [], [], 0

        def keep(a: int, b: int) -> None:
            pieces.append(self.text[a:b])
            starts.append(self.start[a:b])
            ends.append(self.end[a:b])
            touched.append(self.touched[a:b])

        for m in pattern.finditer(self.text):
            new = put(m, self)
            if new is None or new == m[0] or m.end() == m.start():
                continue
            keep(at, m.start())
            pieces.append(new)
            starts.append(np.full(len(new), self.start[m.start()]))
            ends.append(np.full(len(new), self.end[m.end() - 1]))
            touched.append(np.ones(len(new), bool))
            at = m.end()
        if pieces:
            keep(at, len(self.text))
            self.text = "".join(pieces)
            self.start, self.end, self.touched = (np.concatenate(x) for x in (starts, ends, touched))

    def source(self, a: int, b: int) -> Span:
        return int(self.start[a]), int(self.end[b - 1])


def _digits(m: re.Match, within: Rewritten) -> str | None:
    """A run of digits and digit words as digits. A run without words stays, and so does a single word that no dot joins to another."""
    out, spelled = [], 0
    for token in _DIGIT_TOKEN.findall(m[0].lower()):
        times, _, name = token.rpartition(" ") if " " in token else token.rpartition("-")
        if name in _VALUE:
            out.append(_VALUE[name] * TIMES.get(times, 1))
            spelled += 1
        else:
            out.append(token)
    before, after = within.text[max(0, m.start() - 2) : m.start()], within.text[m.end() : m.end() + 2]
    if len(out) == 1 and not (after[:1] == "." and after[1:].isalnum() or before[1:] == "." and before[:1].isalnum()):
        return None
    return "".join(out) if spelled else None


def _at_before_hidden_dot(m: re.Match, text: Rewritten) -> str | None:
    """A bare word ``at`` counts only before a domain whose dot was written out."""
    a, b = m.span(1)
    dots = [k for k in range(a, b) if text.text[k] == "."]
    return "@" if text.touched[dots].any() else None


CHAIN: tuple[tuple[re.Pattern, Callable[[re.Match, Rewritten], str | None]], ...] = (
    (_HIDDEN, lambda m, _: ""),
    (_DOT, lambda m, _: "."),
    (_SPELLED, _digits),
    (_LETTER_DIGITS, lambda m, _: "0" if m[0] in "oO" else "1"),
    (_AT, lambda m, _: "@"),
    (_PLAIN_AT, _at_before_hidden_dot),
    (_PLUS, lambda m, _: "+"),
)


def disguised_spans(text: str, plain: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Source spans of identifiers that only the rewritten text shows.

    A find counts if it holds a rewritten character and shares none with a plain one
    of its kind; an e-mail address must end in letters.
    """
    if not may_hide(text):
        return {}
    clear = Rewritten(text)
    clear.translate(SAME_LENGTH)
    for pattern, put in CHAIN:
        clear.rewrite(pattern, put)
    if not clear.touched.any() and len(clear.text) == len(text):
        return {}
    dropped = np.concatenate([[0], (clear.start[1:] > clear.end[:-1]).cumsum()]) if len(clear.text) else None
    added: dict[str, list[Span]] = {}
    for kind, spans in plain_spans(clear.text).items():
        own = plain[kind]
        for a, b in spans:
            if not clear.touched[a:b].any() and dropped[b - 1] == dropped[a]:
                continue
            if kind == "email" and not _COUNTRY.fullmatch(clear.text[a:b].rpartition(".")[2]):
                continue
            first, end = clear.source(a, b)
            if not any(x < end and first < y for x, y in own):
                added.setdefault(kind, []).append((first, end))
    return added


def _listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans.get(kind, ())))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The four counts and ``base_sha256`` are about plain identifiers, ``spans`` lists
    these and the ``n_added`` disguised ones, as kind:start:end in code points of the
    source. NULL counts as the empty text and has no spans; repeated documents give
    repeated rows, a NULL id stays NULL, an empty table gives no rows; other columns
    are not read. A text is read whole, in time that grows with its length.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                plain = plain_spans(text)
                added = disguised_spans(text, plain)
                base = _listed(plain)
                every = _listed({k: plain[k] + added.get(k, []) for k in KINDS}) if added else base
                rows.append((*(len(plain[k]) for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), every, sum(map(len, added.values()))))
            columns = list(zip(*rows)) or [()] * 7
            arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return source.mapInArrow(find, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added bigint")


def mask(text: str, spans: str, sign: str = "*") -> str:
    """``text`` with every character of the listed spans replaced."""
    out = list(text)
    for span in filter(None, spans.split(",")):
        _, a, b = span.split(":")
        out[int(a) : int(b)] = sign * (int(b) - int(a))
    return "".join(out)
