"""BPE encoding and decoding by a deterministic tokenization automaton."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches

#: Letters and numbers (code points) that are newer than the Unicode version (16) of the vocabulary's usual library, and small forms newer than Python's.
NEW_LETTERS = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A
11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6
1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD
323B0-33479 3D000-3FC3F"""
NEW_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"
NEW_SMALL = """1C89>1C8A A7CB>264 A7CC>A7CD A7CE>A7CF A7D2>A7D3 A7D4>A7D5 A7DA>A7DB A7DC>19B 10D50-10D65>10D70 16EA0-16EB8>16EBB"""


def _class(ranges: str) -> str:
    return "".join("-".join(f"\\U{int(x, 16):08X}" for x in part.split("-")) for part in ranges.split())


def _small_forms() -> dict[int, int]:
    """Small forms by code point. Lower-casing goes by character, so a capital sigma has one small form wherever it stands."""
    out = {ord("Σ"): ord("σ")}
    for part in NEW_SMALL.split():
        span, to = part.split(">")
        first, last = (int(x, 16) for x in (span.split("-") * 2)[:2])
        out |= {c: int(to, 16) + c - first for c in range(first, last + 1)}
    return out


#: The pieces that the vocabulary's merges work on: contractions, words, single digits, runs of other signs.
LETTER, NUMBER = f"[\\p{{L}}--[{_class(NEW_LETTERS)}]]", f"[\\p{{N}}--[{_class(NEW_NUMBERS)}]]"
PIECES = f"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{LETTER}+|{NUMBER}|[[^\\s\\p{{L}}\\p{{N}}]||[{_class(NEW_LETTERS + " " + NEW_NUMBERS)}]]+"
ASCII_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\s0-9a-z]+"
SMALL_FORMS = _small_forms()
ODD_CAPITALS = re.compile("[" + "".join(map(chr, SMALL_FORMS)) + "]")
#: Pieces that a task keeps with their ids, and known transitions; both start anew when full.
REMEMBERED = 1 << 19
LONGEST_REMEMBERED = 64
NEVER = 1 << 30
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_signs() -> list[str]:
    """The printable sign of each byte in the vocabulary file: its own if Latin-1 prints it without a gap, else the next from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Automaton:
    """The automaton whose accepted arc sequences are exactly the encodings.

    It starts as one state that every base symbol leads back to. Each merge (u, v), in the order of the list, is a gadget: the state that u leads to is copied
    without its arc v, all arcs u now lead to the copy, and the new token gets an arc beside every arc u that is left, to the state that v led to. So a state is known by
    the token that was read last, and the arcs of the end (vocabulary squared, if written out) are kept as the gadgets' differences: ``lost[u, v]`` is the step at
    which the state after u lost its arc v. The state after a token began as that after its second part at the token's step, and its arc as that of its first part.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        size = max(vocab.values(), default=-1) + 1
        self.labels = [""] * size
        for label, i in vocab.items():
            self.labels[i] = label
        signs = byte_signs()
        self.inner = [vocab[s] for s in signs]
        self.last = [vocab[s + suffix] for s in signs]
        self.first, self.second, self.step = [-1] * size, [-1] * size, [NEVER] * size
        self.lost: dict[int, int] = {}
        self.goto: dict[int, int] = {}  # node and base symbol to node
        self.accepts = [-1]  # the token that ends at a node
        spelled = {i: (i,) for i in [*self.inner, *self.last]}
        for symbols in spelled.values():
            self._enter(symbols, symbols[0])
        without_arcs: set[int] = set()
        for step, (a, b) in enumerate(merges):
            u, v, new = vocab[a], vocab[b], vocab[a + b]
            if u not in spelled or v not in spelled or new in spelled:
                raise ValueError(f"merge {step} joins tokens that no earlier merge makes, or makes one anew")
            self.first[new], self.second[new], self.step[new] = u, v, step
            spelled[new] = spelled[u] + spelled[v]
            if not {u, v} & without_arcs and self.has_arc(u, v):
                self.lost[u << 20 | v] = step
                self._enter(spelled[new], new)
            else:  # earlier merges part u from v wherever they meet
                without_arcs.add(new)
        self.arcs: dict[int, bool] = {}

    def _enter(self, symbols: tuple[int, ...], token: int) -> None:
        node = 0
        for s in symbols:
            after = self.goto.get(node << 20 | s)
            if after is None:
                after = self.goto[node << 20 | s] = len(self.accepts)
                self.accepts.append(-1)
            node = after
        self.accepts[node] = token

    def has_arc(self, last: int, token: int) -> bool:
        """Whether the state after ``last`` has an arc ``token``: no gadget took it, or the arc or the state that it grew from, in time."""
        state, until = last, NEVER
        while state >= 0:
            arc, before = token, NEVER
            while arc >= 0:
                lost = self.lost.get(state << 20 | arc)
                # A token merged with itself loses its arc before the new arc is laid.
                if lost is not None and lost < until and (lost < before or (lost == before and state == arc)):
                    return False
                arc, before = self.first[arc], self.step[arc]
            state, until = self.second[state], self.step[state]
        return True

    def follows(self, last: int, token: int) -> bool:
        key = last << 20 | token
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= REMEMBERED:
                self.arcs.clear()
            known = self.arcs[key] = self.has_arc(last, token)
        return known

    def _starting(self, symbols: list[int], at: int) -> list[tuple[int, int]]:
        """(end, token) of the tokens that spell the symbols from ``at`` on, the longest last."""
        found, node, goto, accepts = [], 0, self.goto, self.accepts
        for i in range(at, len(symbols)):
            node = goto.get(node << 20 | symbols[i])
            if node is None:
                break
            if accepts[node] >= 0:
                found.append((i + 1, accepts[node]))
        return found

    def piece(self, text: bytes) -> list[int]:
        """The ids of one piece: the only path of the automaton that spells it.

        Every prefix has one path too, so a place from which no arc goes on is never entered again, and the work grows with the length.
        """
        if not text:
            return []
        symbols = [self.inner[b] for b in text[:-1]] + [self.last[text[-1]]]
        path: list[int] = []
        places, open_arcs, dead = [0], [self._starting(symbols, 0)], bytearray(len(symbols) + 1)
        while places[-1] < len(symbols):
            while open_arcs[-1]:
                end, token = open_arcs[-1].pop()
                if not dead[end] and (not path or self.follows(path[-1], token)):
                    path.append(token)
                    places.append(end)
                    open_arcs.append(self._starting(symbols, end))
                    break
            else:
                dead[places.pop()] = 1
                open_arcs.pop()
                path.pop()
        return path


class Remembered(dict):
    """What ``made`` gives for texts; short ones are kept, up to ``REMEMBERED`` of them."""

    def __init__(self, made):
        super().__init__()
        self.made = made

    def __missing__(self, text: str) -> bytes:
        ids = self.made(text)
        if len(text) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[text] = ids
        return ids


class Tokenizer:
    """A vocabulary file's automaton with its special tokens, which are found in the raw text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.automaton = Automaton({w: i for w, i in model["vocab"].items() if w not in special}, merges, model["end_of_word_suffix"] or "")
        self.labels = self.automaton.labels + [""] * (max(special.values(), default=-1) + 1 - len(self.automaton.labels))
        for label, i in special.items():
            self.labels[i] = label
        self.spelled = np.array([label != "" for label in self.labels] + [False])
        self.special = {label: np.uint32(i).astype("<u4").tobytes() for label, i in special.items()}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.pieces, self.ascii_pieces = regex.compile(PIECES), re.compile(ASCII_PIECES, re.ASCII)
        self.known, self.stretches = Remembered(self._ids), Remembered(self._stretch)

    def _ids(self, piece: str) -> bytes:
        return np.array(self.automaton.piece(piece.encode()), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        """No piece goes over white space, and neither does normalization, so stretches between white space are known by their raw form."""
        if SEPARATORS.search(text):  # white space to Python alone
            return self._stretch(text)
        return b"".join(map(self.stretches.__getitem__, text.split()))

    def _stretch(self, text: str) -> bytes:
        if text.isascii():
            return b"".join(map(self.known.__getitem__, self.ascii_pieces.findall(text.lower())))
        text = unicodedata.normalize("NFC", text)
        if ODD_CAPITALS.search(text):
            text = text.translate(SMALL_FORMS)
        return b"".join(map(self.known.__getitem__, self.pieces.findall(text.lower())))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.parts is None:
            return self._plain(text)
        return b"".join(self.special.get(part) or self._plain(part) for part in self.parts.split(text) if part)

    def decode(self, ids: bytes) -> str:
        """The labels of the ids' arcs, a space between them; ids without a label give nothing."""
        codes = np.frombuffer(ids, "<u4")
        return " ".join(map(self.labels.__getitem__, codes[self.spelled[np.minimum(codes, len(self.labels))]].tolist()))


def _beside(df: DataFrame, source: str, made: dict[str, str], run) -> DataFrame:
    """``df`` with the columns ``made`` (name to kind) that ``run`` gives for the values of ``source``; all other columns pass through the task untouched."""
    small_batches(df.sparkSession)
    replaced = {c.lower() for c in made}
    kept = [i for i, f in enumerate(df.schema) if f.name.lower() not in replaced]
    at = [f.name.lower() for f in df.schema].index(source.lower())
    schema = T.StructType([df.schema[i] for i in kept])
    for name, kind in made.items():
        schema = schema.add(name, kind)
    names = schema.names

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], *run(b.column(at).to_pylist())], names=names)

    return df.mapInArrow(go, schema)


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids", count_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the ids of each whole text, packed as little-endian unsigned 32-bit integers, and their number.

    ``vocabulary`` is the path of a byte-level BPE file with word ends, read by the driver alone; its automaton (a few MB, bounded by the file) is broadcast. Every task walks its own
    texts, piece by piece, and keeps the ids of a bounded number of pieces. Null and empty texts have no ids. Rows are
    neither dropped nor joined, so repeated rows, null ids and extra columns stay as they are; columns of the new names are replaced.
    """
    tokenizer = docs.sparkSession.sparkContext.broadcast(Tokenizer(vocabulary))

    def run(texts: list[str | None]) -> list[pa.Array]:
        ids = [tokenizer.value.encode(t) if t else b"" for t in texts]
        return [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]

    return _beside(docs, text_col, {ids_col: "binary", count_col: "long"}, run)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its packed ids spell: arc labels, word ends included, a space between them; null or no ids give an empty text."""
    tokenizer = encoded.sparkSession.sparkContext.broadcast(Tokenizer(vocabulary))

    def run(packed: list[bytes | None]) -> list[pa.Array]:
        return [pa.array([tokenizer.value.decode(ids) if ids else "" for ids in packed], pa.string())]

    return _beside(encoded, ids_col, {text_col: "string"}, run)
