"""SentencePiece encoding and decoding that keeps the place of every piece.

Text is normalised by the model's compiled character map: at each place the longest
prefix found in the map's trie is replaced, else one character is taken as it is, and
for each character that comes out the bytes of the source it stands for are recorded. Pieces are
then made by merging the neighbours with the best score, bytes standing in for characters that the
vocabulary lacks, and each piece is projected back onto its range of source bytes.

No piece of the vocabulary holds a space sign behind another character (this is checked),
so merges never cross the gap before a word. Each word is merged by itself, and a
bounded memory of words saves most of the work.

Nulls and edges: a null text counts as empty; empty texts have no pieces; pieces of bytes
that stand for one character all start where it starts, and only the last one covers
it; repeated rows, null ids and further columns do no harm.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm import arrays
from touchline.llm.shared import text_key

SPACE = "▁"
#: Words remembered by a worker, twice: those seen lately, and those seen before them.
MEMORY = 300_000

# Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_NEVER = float("-inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of an encoded message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, data[at : at + size]
            at += size


class CharacterMap:
    """A compiled map: a trie in units of 32 bits, and the texts that its values point to."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.texts = blob[4 + size :] if blob else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest entry that ``data`` has at ``at``, and what replaces it."""
        if not self.units:
            return None
        node = self._child(0)
        found = None
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._child(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.texts[start : self.texts.index(b"\0", start)]

    def _child(self, unit: int) -> int:
        unit = unit or self.units[0]
        return (unit >> 10) << ((unit & 512) >> 6)


@dataclass
class Model:
    """Vocabulary and rules of a model file with merged pairs (BPE)."""

    pieces: list[str]
    kinds: list[int]
    scores: list[float]
    characters: CharacterMap
    dummy_prefix: bool
    strip: bool
    escape: bool
    byte_fallback: bool
    ids: dict[str, int] = field(default_factory=dict)
    worth: dict[str, float] = field(default_factory=dict)
    unknown: int = 0
    #: By id: the text of a piece, its characters, and its byte (or -1).
    plain: list[str] = field(default_factory=list)
    widths: np.ndarray | None = None
    raw: np.ndarray | None = None

    @classmethod
    def load(cls, data: bytes) -> Model:
        pieces, kinds, scores = [], [], []
        trainer: dict[int, int | bytes] = {}
        rules: dict[int, int | bytes] = {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, _NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                rules = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("only models with merged pairs are read")
        model = cls(
            pieces,
            kinds,
            scores,
            CharacterMap(rules.get(2, b"")),
            bool(rules.get(3, 1)),
            bool(rules.get(4, 1)),
            bool(rules.get(5, 1)),
            bool(trainer.get(35, 0)),
        )
        if _USER in kinds or _UNUSED in kinds or trainer.get(24, 0):
            raise ValueError("models with user-defined or unused pieces, or a space after words, are not read")
        if any(SPACE in p.lstrip(SPACE) for p, kind in zip(pieces, kinds, strict=True) if kind == _NORMAL):
            raise ValueError("a piece crosses the gap before a word")
        model.unknown = kinds.index(_UNKNOWN)
        model.ids = {p: i for i, (p, kind) in enumerate(zip(pieces, kinds, strict=True)) if kind == _NORMAL}
        model.worth = {p: scores[i] for p, i in model.ids.items()}
        model.plain = [p.replace(SPACE, " ") for p in pieces]
        model.widths = np.array([len(p) for p in pieces], dtype=np.int32)
        model.raw = np.full(len(pieces), -1, dtype=np.int16)
        for i, kind in enumerate(kinds):
            if kind == _BYTE:
                model.raw[i] = int(pieces[i][3:5], 16)
                model.plain[i] = chr(model.raw[i])
            elif kind != _NORMAL:
                model.plain[i] = " ⁇ " if kind == _UNKNOWN else ""
        model.bytes = [pieces.index(f"<0x{b:02X}>") for b in range(256)] if model.byte_fallback else []
        return model

    # -- text to pieces

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the source byte at which each of its characters starts (and the end)."""
        if not text:
            return "", np.zeros(1, dtype=np.int32)
        if not self.characters.units and not self.strip:
            places = np.zeros(len(text) + 1 + self.dummy_prefix, dtype=np.int32)
            if text.isascii():
                places[-len(text) :] = np.arange(1, len(text) + 1)
            else:
                points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
                widths = np.ones(len(text), dtype=np.int8)
                for least in (0x80, 0x800, 0x10000):
                    widths += points >= least
                np.cumsum(widths, out=places[-len(text) :])
            return self._space() * self.dummy_prefix + (text.replace(" ", SPACE) if self.escape else text), places
        data, at, parts = text.encode(), 0, []
        while at < len(data):
            found = self.characters.longest(data, at)
            if found is None:
                width = 1 + (data[at] > 0xBF) + (data[at] > 0xDF) + (data[at] > 0xEF)
                found = width, data[at : at + width]
            parts.append((at, at + found[0], found[1].decode()))
            at += found[0]
        if self.strip:
            parts = _stripped(parts)
        if not parts:
            return "", np.zeros(1, dtype=np.int32)
        out, starts = [], []
        if self.dummy_prefix:
            out.append(self._space())
            starts.append(parts[0][0])
        for start, _, made in parts:
            out.append(made.replace(" ", self._space()))
            starts.extend([start] * len(made))
        return "".join(out), np.array([*starts, parts[-1][1]], dtype=np.int32)

    def _space(self) -> str:
        return SPACE if self.escape else " "

    def merged(self, word: str) -> list[int]:
        """Ids of the pieces of a word."""
        parts = list(word)
        if len(parts) < 64:
            worth = self.worth.get
            pairs = [worth(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            while pairs and (best := max(pairs)) > _NEVER:
                i = pairs.index(best)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                del pairs[i]
                if i < len(pairs):
                    pairs[i] = worth(parts[i] + parts[i + 1], _NEVER)
                if i:
                    pairs[i - 1] = worth(parts[i - 1] + parts[i], _NEVER)
        else:
            parts = self._merged_long(parts)
        out: list[int] = []
        for part in parts:
            known = self.ids.get(part)
            if known is not None:
                out.append(known)
            elif self.byte_fallback:
                out += [self.bytes[b] for b in part.encode()]
            else:
                out.append(self.unknown)
        return out

    def _merged_long(self, parts: list[str]) -> list[str]:
        """The same merges with a queue of pairs and linked neighbours."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                pair = parts[i] + parts[j]
                made = self.ids.get(pair)
                if made is not None:
                    heapq.heappush(queue, (-self.scores[made], i, j, pair))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, j, pair = heapq.heappop(queue)
            if not parts[i] or not parts[j] or after[i] != j or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j] = pair, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x in parts if x]

    # -- pieces to text

    def characters_of(self, ids: np.ndarray) -> np.ndarray:
        """Characters that each piece covers; of the bytes of one character the last one has it."""
        raw = self.raw[ids]
        more = np.zeros(len(ids), dtype=bool)
        more[:-1] = (raw[1:] & 0xC0 == 0x80) & (raw[1:] >= 0)
        return np.where(raw >= 0, ~more, np.where(ids == self.unknown, 1, self.widths[ids]))

    def surface(self, ids: np.ndarray) -> str:
        """The text of pieces, space signs shown as spaces; bytes that are no character become U+FFFD."""
        plain, raw = self.plain, self.raw[ids]
        if raw.max(initial=-1) < 0x80:
            return "".join([plain[i] for i in ids.tolist()])
        out, at = [], 0
        high = np.flatnonzero(np.diff(np.concatenate([[0], raw >= 0x80, [0]]).astype(np.int8)))
        for start, end in high.reshape(-1, 2).tolist():
            out += [plain[i] for i in ids[at:start].tolist()]
            out.append(_characters(raw[start:end].astype(np.uint8).tobytes()))
            at = end
        return "".join(out + [plain[i] for i in ids[at:].tolist()])

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of a whole list of ids, without the space put before its first word."""
        text = self.surface(np.asarray(ids, dtype=np.int32))
        led = len(ids) > 0 and self.pieces[ids[0]].startswith(SPACE)
        return text[1:] if led and (self.dummy_prefix or self.strip) else text


def _characters(raw: bytes) -> str:
    """Bytes as text; each byte that is not part of a character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        width = 1 + (raw[at] > 0xBF) + (raw[at] > 0xDF) + (raw[at] > 0xEF)
        try:
            out.append(raw[at : at + width].decode())
            at += width
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


def _stripped(parts: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Without spaces at both ends, and with one for each run of them."""
    out: list[tuple[int, int, str]] = []
    for start, end, made in parts:
        if not out or out[-1][2].endswith(" "):
            made = made.lstrip(" ")
        made = re.sub(" +", " ", made)
        if made:
            out.append((start, end, made))
    while out and out[-1][2].endswith(" "):
        start, end, made = out.pop()
        if made.rstrip(" "):
            out.append((start, end, made.rstrip(" ")))
    return out


_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Encoder:
    """A model with its memory of words: those seen lately, and those seen before them."""

    def __init__(self, model: Model) -> None:
        self.model, self.known, self.older = model, {}, {}

    def _word(self, word: str) -> bytes:
        """Ids of a word's pieces as packed numbers."""
        ids = self.older.get(word)
        if ids is None:
            ids = array("i", self.model.merged(word)).tobytes()
        if len(self.known) >= MEMORY:
            self.older, self.known = self.known, {}
        if len(word) < 64:
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id, first source byte and end of each piece of a text."""
        normal, places = self.model.normalise(text)
        known, new = self.known.get, self._word
        ids = np.frombuffer(b"".join([known(w) or new(w) for w in _WORD.findall(normal)]), dtype=np.int32)
        counts = self.model.characters_of(ids)
        ends = np.cumsum(counts)
        return ids, places[ends - counts], places[ends]


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(data: bytes) -> Encoder:
    """The encoder of a model file, kept while a worker lives."""
    key = hashlib.sha256(data).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Model.load(data))
    return _ENCODERS[key]


_OUT = pa.list_(pa.int32())


def encoded(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text_key, ids, starts, ends, decoded) for every row: pieces with their source bytes, and the text they give."""
    data = docs.sparkSession.sparkContext.broadcast(open(model_file, "rb").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(data.value)
        for batch in batches:
            for chunk in arrays.chunks(batch.column(2)):
                part = batch.slice(chunk.first, chunk.n)
                rows: list[list] = [[], [], [], []]
                for text in part.column(2).to_pylist():
                    found = made.encode(text or "")
                    for column, value in zip(rows, (*found, made.model.decode(found[0])), strict=True):
                        column.append(value)
                columns = [pa.array(x, _OUT) for x in rows[:3]] + [pa.array(rows[3], pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], *columns], names=["doc_id", "text_key", "ids", "starts", "ends", "decoded"]
                )

    return docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(
        run,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key bigint, ids array<int>,"
        " starts array<int>, ends array<int>, decoded string",
    )


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes) for every row, from the same pieces.

    ``n_bytes`` is the number of source bytes that the pieces cover. Digests are made where the pieces are, so ids do not travel.
    """
    data = docs.sparkSession.sparkContext.broadcast(open(model_file, "rb").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(data.value)
        numbers = [str(i) for i in range(len(made.model.pieces))]
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for text in batch.column(1):
                ids, starts, ends = made.encode(text.as_py() or "")
                rows[0].append(len(ids))
                rows[1].append(hashlib.sha256(",".join([numbers[i] for i in ids.tolist()]).encode()).hexdigest())
                rows[2].append(hashlib.sha256(made.model.decode(ids).encode()).hexdigest())
                rows[3].append(int((ends - starts).sum()))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = [pa.array(x, kind) for x, kind in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string,"
        " decoded_sha256 string, n_bytes bigint",
    )
