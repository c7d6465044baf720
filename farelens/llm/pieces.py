"""SentencePiece BPE encoding with source offsets, and decoding.

The model file is read here (normaliser rules, pieces, scores). Normalisation walks
the compiled character map: at each byte the longest key of the map's double-array
trie is replaced, else one character is copied; every output byte remembers the
source byte it came from. A text in which no byte begins a key (every text, for an
empty map) is copied at once, and its sources are running counts. Merges run on
stretches between word boundaries that no piece spans, so a stretch is encoded once
per task and reused; the pieces' byte ranges follow from their added lengths."""

from __future__ import annotations

import heapq
import re
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from itertools import chain, compress, groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# fixed values: piece types of the model file, the space symbol, unknown and replacement text
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "
REPLACEMENT = "�"
#: Distinct stretches a task remembers (some 300 bytes each). When they are too many,
#: those that came again since they were learnt stay, if they are at most half.
MEMORY = 160_000
#: Longest stretch that is merged together with others, and how many are.
SHORT = 32
TOGETHER = 8192


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message; groups do not occur."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            n, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + n], at + n
        yield tag >> 3, value


class CharacterMap:
    """The compiled map: a trie blob size, the double array, NUL-ended replacements.

    A unit of the array holds: bits 0-7 the label (bit 31 marks a leaf, whose bits
    0-30 are the value), bit 8 "has a leaf", bits 10-30 the offset, which is shifted
    by 8 more when bit 9 is set."""

    def __init__(self, blob: bytes = b""):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack(f"<{size // 4}I", blob[4 : 4 + size])
        self.text = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest key at ``at``."""
        units, found = self.units, None
        if not units:
            return None
        root = units[0]
        node = (root >> 10) << ((root & (1 << 9)) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & (1 << 9)) >> 6)
            if unit & (1 << 8):
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.text[found[1] : self.text.index(b"\0", found[1])]

    @cached_property
    def starts(self) -> np.ndarray:
        """Byte -> whether a key begins with it."""
        begins = np.zeros(256, bool)
        if self.units:
            root = self.units[0]
            base = (root >> 10) << ((root & (1 << 9)) >> 6)
            for byte in range(1, 256):
                begins[byte] = base ^ byte < len(self.units) and self.units[base ^ byte] & 0x800000FF == byte
        return begins


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    charmap: CharacterMap = field(default_factory=CharacterMap)
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    @staticmethod
    def parse(data: bytes) -> Model:
        model = Model()
        for number, value in _fields(data):
            if number == 1:
                parts = dict(_fields(value))
                model.pieces.append(parts.get(1, b"").decode())
                model.scores.append(struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0)
                model.kinds.append(parts.get(3, NORMAL))
            elif number == 2 and dict(_fields(value)).get(3, 1) != 2:
                raise ValueError("only BPE models are supported")
            elif number == 3:
                spec = dict(_fields(value))
                model.charmap = CharacterMap(spec.get(2, b""))
                model.add_dummy_prefix = bool(spec.get(3, 1))
                model.remove_extra_whitespaces = bool(spec.get(4, 1))
                model.escape_whitespaces = bool(spec.get(5, 1))
        return model

    @cached_property
    def ids(self) -> dict[str, int]:
        return {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}

    @cached_property
    def ranks(self) -> dict[str, int]:
        """Merged piece -> its place by score; equal scores share a place."""
        place = {s: r for r, s in enumerate(sorted({self.scores[i] for i in self.ids.values()}, reverse=True))}
        return {p: place[self.scores[i]] for p, i in self.ids.items()}

    @cached_property
    def byte_ids(self) -> dict[int, int]:
        return {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}

    @cached_property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    @cached_property
    def end(self) -> int:
        return self.pieces.index("</s>")

    @cached_property
    def splits(self) -> bool:
        """No piece has a space symbol after another character, so no merge crosses a word's start."""
        return not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)


def normalise(model: Model, text: str) -> tuple[bytes, list[int]]:
    """Normalised UTF-8 and, for each of its bytes and its end, the source byte."""
    data, space = text.encode(), SPACE.encode() if model.escape_whitespaces else b" "
    parts: list[tuple[bytes, int, int]] = []
    at = 0
    while at < len(data):
        hit = model.charmap.longest(data, at)
        if hit is None:
            lead = data[at]
            n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            hit = n, data[at : at + n]
        parts.append((hit[1], at, at + hit[0]))
        at += hit[0]
    if model.remove_extra_whitespaces:
        while parts and not parts[0][0].strip(b" "):
            parts.pop(0)
    out, source = bytearray(), []
    if parts and model.add_dummy_prefix:
        out += space
        source += [parts[0][1]] * len(space)
    blank = model.remove_extra_whitespaces
    for new, begin, _ in parts:
        while blank and new.startswith(b" "):
            new = new[1:]
        if not new:
            continue
        for byte in new:
            add = space if byte == 0x20 else bytes((byte,))
            out += add
            source += [begin] * len(add)
        blank = model.remove_extra_whitespaces and new.endswith(b" ")
    last = parts[-1][2] if parts else 0
    if model.remove_extra_whitespaces:
        while out.endswith(space):
            last = source[len(out) - len(space)]
            del out[-len(space) :], source[-len(space) :]
    return bytes(out), [*source, last]


def aligned(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """``normalise`` of each text: the normalised texts, and their source bytes one
    text after the other. Where the map has no key for any text and blanks stay, that
    is done at once: every byte is its own source and a blank that of a whole space
    symbol."""
    own = [t.encode() for t in texts]
    # a byte after each text stands for its end
    data = np.frombuffer(b"".join(chain.from_iterable((d, b"\0") for d in own)), np.uint8)
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(sizes + 1) - 1
    inner = np.ones(len(data), bool)
    inner[ends] = False
    if model.remove_extra_whitespaces or (model.charmap.starts[data] & inner).any():
        made = [normalise(model, t) for t in texts]
        return [n.decode() for n, _ in made], np.fromiter(chain.from_iterable(s for _, s in made), np.int64)
    space = SPACE if model.escape_whitespaces else " "
    width = len(space.encode())
    times = np.where(data == 0x20, width, 1)
    if model.add_dummy_prefix:
        times[(ends - sizes)[sizes > 0]] += width
        texts = [" " + t if t else t for t in texts]
    local = np.arange(len(data)) - np.repeat(ends - sizes, sizes + 1)
    return [t.replace(" ", space) for t in texts], np.repeat(local, times)


def merge(model: Model, text: str) -> list[str]:
    """BPE of one stretch: the best-scored adjacent pair first, the leftmost of
    equals. The pairs stay in a heap, so the time is n log n."""
    symbols: list[str] = list(text)
    before, after = list(range(-1, len(text) - 1)), [*range(1, len(text)), -1]
    agenda: list[tuple[int, int, int, str]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b >= 0 and (rank := model.ranks.get(both := symbols[a] + symbols[b])) is not None:
            heapq.heappush(agenda, (rank, a, b, both))

    for i in range(len(text) - 1):
        offer(i, i + 1)
    while agenda:
        _, a, b, both = heapq.heappop(agenda)
        if not symbols[a] or not symbols[b] or symbols[a] + symbols[b] != both:
            continue
        symbols[a], symbols[b] = both, ""
        after[a] = after[b]
        if after[b] >= 0:
            before[after[b]] = a
        offer(before[a], a)
        offer(a, after[a])
    return [s for s in symbols if s]


class Merger:
    """``merge`` for many short stretches at once. A row holds the symbols of one
    stretch and the ranks of its adjacent pairs; every step merges the best pair of
    every row that has one, so all rows lose a column. A symbol is a piece id, or past
    the vocabulary a character outside it."""

    def __init__(self, model: Model):
        self.size, ids = len(model.pieces), model.ids
        # every character of a piece must be a piece for symbols to be ids
        self.usable = all(c in ids for p in ids for c in p)
        # a rank stands for its piece: texts that hold merged pieces of one score (say, runs of spaces) are left out
        long = [p for p in ids if len(p) > 1]
        times = Counter(model.ranks[p] for p in long)
        tied = [p for p in long if times[model.ranks[p]] > 1]
        self.tied = re.compile("|".join(map(re.escape, tied)) or "(?!)")
        long = [p for p in long if times[model.ranks[p]] == 1]
        pairs = [(ids[p[:k]] << 21 | ids[p[k:]], model.ranks[p]) for p in long for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        pairs.sort()
        self.none = np.int32(len(model.pieces))
        self.bits = max(16, len(pairs).bit_length() + 2)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, self.none, np.int32)
        self.probes = 1
        for key, rank in pairs:
            at, tries = self._place(key), 1
            while self.keys[at] >= 0:
                at, tries = (at + 1) & ((1 << self.bits) - 1), tries + 1
            self.keys[at], self.ranks[at] = key, rank
            self.probes = max(self.probes, tries)
        self.piece = np.zeros(self.size + 1, np.int32)
        for p in long:
            self.piece[model.ranks[p]] = ids[p]
        self.symbol = np.arange(0x110000, dtype=np.int32) + self.size
        for p, i in ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i

    def takes(self, text: str) -> bool:
        return self.usable and len(text) <= SHORT and not self.tied.search(text)

    def _place(self, key):
        return (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the piece that a pair of symbols makes (``none``: no piece)."""
        key = a.astype(np.int64) << 21 | b
        at = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        held = self.keys[at]
        out = np.where(held == key, self.ranks[at], self.none)
        open_ = np.flatnonzero((held != key) & (held >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out

    def _same(self, texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols one row after the other, and how many, of texts of one length."""
        symbols = self.symbol[np.frombuffer("".join(texts).encode("utf-32-le"), np.int32)].reshape(len(texts), width)
        rank = self.pair(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(len(texts), width - 1)
        rows, done = np.arange(len(texts)), []
        while len(rows):
            if not rank.shape[1]:
                done.append((rows, symbols))
                break
            best = rank.argmin(axis=1)
            here = np.arange(len(rows))
            found = rank[here, best]
            active = found < self.none
            if not active.all():
                done.append((rows[~active], symbols[~active]))
                rows, symbols, rank, best, found = rows[active], symbols[active], rank[active], best[active], found[active]
                here = here[: len(rows)]
                if not len(rows):
                    break
            symbols[here, best] = self.piece[found]
            # the column after the merged one goes, and with it the pair's rank
            n, w = symbols.shape
            gone = np.ones((n, w), bool)
            gone[here, best + 1] = False
            symbols = symbols[gone].reshape(n, w - 1)
            gone = np.ones((n, w - 1), bool)
            gone[here, best] = False
            rank = rank[gone].reshape(n, w - 2)
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < w - 2)
            r, c = np.concatenate((left, right)), np.concatenate((best[left] - 1, best[right]))
            rank[r, c] = self.pair(symbols[r, c], symbols[r, c + 1])
        counts = np.empty(len(texts), np.int64)
        for which, held in done:
            counts[which] = held.shape[1]
        begins = np.cumsum(counts) - counts
        flat = np.empty(counts.sum(), np.int32)
        for which, held in done:
            flat[begins[which][:, None] + np.arange(held.shape[1])] = held
        return flat, counts

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols one text after the other, and how many; texts ordered by length."""
        parts = [self._same(list(group), width) for width, group in groupby(texts, len)]
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int32), np.empty(0, np.int64))


class Decoder:
    """The texts of ids, by one gather from the pieces' bytes."""

    def __init__(self, model: Model):
        self.model, decoded = model, []
        for piece, kind in zip(model.pieces, model.kinds):
            text = "" if kind == CONTROL else UNKNOWN_TEXT if kind == UNKNOWN else piece.replace(SPACE, " ")
            decoded.append(bytes((int(piece[1:-1], 16),)) if kind == BYTE else text.encode())
        self.blob = np.frombuffer(b"".join(decoded), np.uint8)
        self.size_of = np.array([len(d) for d in decoded], np.int64)
        self.start_of = np.cumsum(self.size_of) - self.size_of

    def __call__(self, flat: np.ndarray, counts: list[int]) -> Iterator[str]:
        """The texts of ids that stand one after the other, ``counts`` of each."""
        size = self.size_of[flat]
        ends = np.concatenate(([0], np.cumsum(size)))
        # byte i of a piece comes from its place in the blob
        blob = self.blob[np.repeat(self.start_of[flat] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        m, at = self.model, 0
        trim = m.add_dummy_prefix or m.remove_extra_whitespaces
        for n in counts:
            data = blob[ends[at] : ends[at + n]]
            first = next((i for i in flat[at : at + n] if m.kinds[i] != CONTROL), None)
            if trim and first is not None and m.pieces[first].startswith(SPACE):
                data = data.lstrip(b" ") if m.remove_extra_whitespaces else data[1:]
            yield self._text(data)
            at += n

    @staticmethod
    def _text(data: bytes) -> str:
        kept = []
        while True:
            try:
                return "".join([*kept, data.decode()])
            except UnicodeDecodeError as broken:
                kept.append(data[: broken.start].decode() + REPLACEMENT)
                data = data[broken.start + 1 :]


def _gathered(values: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[begin : begin + count] of every row, one after the other."""
    ends = np.cumsum(counts)
    return values[np.repeat(begins - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]


class Codec:
    """Encoder and decoder of one model with a bounded memory of stretches: a stretch
    has a place, and there its ids and their normalised bytes."""

    def __init__(self, model: Model):
        if {USER_DEFINED, UNUSED} & set(model.kinds):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.model = model
        self.merger, self.decode_all = Merger(model), Decoder(model)
        self.whole = not (model.splits and model.escape_whitespaces)
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        # normalised bytes of a piece; a byte piece's byte, -1 for others; bytes of the character a byte leads
        self.wide = np.array([1 if k == BYTE else len(p.encode()) for p, k in zip(model.pieces, model.kinds)], np.int64)
        self.byte_of = np.full(len(model.pieces), -1, np.int64)
        self.byte_of[list(model.byte_ids.values())] = list(model.byte_ids)
        self.lead = np.repeat([1, 2, 3, 4], [0x80, 0x60, 0x10, 0x10])
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.begins = self.counts = np.empty(0, np.int64)
        self.ids = self.widths = np.empty(0, np.int32)
        self.again = np.empty(0, bool)

    def _forget(self) -> None:
        keep = np.flatnonzero(self.again)
        if len(keep) > MEMORY // 2:
            keep = keep[:0]
        names = list(self.known)  # in the order of their places
        self.known = {names[i]: k for k, i in enumerate(keep.tolist())}
        begins, counts = self.begins[keep], self.counts[keep]
        self.ids, self.widths = _gathered(self.ids, begins, counts), _gathered(self.widths, begins, counts)
        self.begins, self.counts, self.again = np.cumsum(counts) - counts, counts, np.zeros(len(keep), bool)

    def piece_ids(self, piece: str) -> list[int]:
        m = self.model
        if (i := m.ids.get(piece)) is not None:
            return [i]
        return [m.byte_ids[b] for b in piece.encode()] if m.byte_ids else [m.unknown]

    def _spelt(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, their normalised bytes, ids of each text) of a merger's symbols."""
        outside = np.flatnonzero(symbols >= self.merger.size)
        if not len(outside):
            return symbols, self.wide[symbols], counts
        spelt = [self.piece_ids(chr(c)) for c in (symbols[outside] - self.merger.size).tolist()]
        times = np.ones(len(symbols), np.int64)
        times[outside] = list(map(len, spelt))
        ids = np.repeat(symbols, times)
        at = np.repeat(symbols >= self.merger.size, times)
        ids[at] = list(chain.from_iterable(spelt))
        wide = self.wide[ids]
        if not self.model.byte_ids:  # an unknown piece is as long as its character
            wide[at] = [len(chr(c).encode()) for c in (symbols[outside] - self.merger.size).tolist()]
        ends = np.cumsum(counts)
        upto = np.concatenate(([0], np.cumsum(times)))
        return ids, wide, upto[ends] - upto[ends - counts]

    def learn(self, stretches: list[str]) -> None:
        """Encode stretches that the memory lacks, short ones together."""
        parts, names = [], []
        takes = list(map(self.merger.takes, stretches))
        short = sorted(compress(stretches, takes), key=len)
        for i in range(0, len(short), TOGETHER):
            names += short[i : i + TOGETHER]
            parts.append(self._spelt(*self.merger(short[i : i + TOGETHER])))
        for s, taken in zip(stretches, takes):
            if not taken:
                cut = merge(self.model, s)
                ids = [self.piece_ids(p) for p in cut]
                wide = [self.wide[i] if self.model.byte_ids or p in self.model.ids else len(p.encode()) for p, own in zip(cut, ids) for i in own]
                flat = np.fromiter(chain.from_iterable(ids), np.int32)
                parts.append((flat, np.array(wide, np.int64), np.array([len(flat)])))
                names.append(s)
        ids, widths, counts = (np.concatenate(x) for x in zip(*parts))
        self.begins = np.concatenate((self.begins, len(self.ids) + np.cumsum(counts) - counts))
        self.counts = np.concatenate((self.counts, counts))
        self.again = np.concatenate((self.again, np.zeros(len(counts), bool)))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        self.widths = np.concatenate((self.widths, widths.astype(np.int32)))
        self.known.update(zip(names, range(len(self.known), len(self.known) + len(names))))

    def stretches(self, norm: str) -> list[str]:
        return [norm] if self.whole else self.cut.findall(norm)

    def _places(self, every: list[str]) -> np.ndarray:
        places = np.fromiter(map(self.known.get, every, repeat(-1)), np.int64, len(every))
        lacking = np.flatnonzero(places < 0)
        self.again[places[places >= 0]] = True
        if not len(lacking):
            return places
        new = list(dict.fromkeys(every[i] for i in lacking.tolist()))
        if 0 < len(self.known) > MEMORY - len(new):
            before = len(self.known)
            self._forget()
            if len(self.known) < before:  # places have changed, so all of the batch are asked for
                return self._places(every)
        self.learn(new)
        places[lacking] = np.fromiter((self.known[every[i]] for i in lacking.tolist()), np.int64, len(lacking))
        return places

    def code_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pieces of each text, ids, begins, ends), one text after the other, without an
        end id: every piece's byte range in its original text. The byte pieces of one
        character share its range."""
        norms, source = aligned(self.model, texts)
        cut = [self.stretches(n) for n in norms]
        places = self._places(list(chain.from_iterable(cut)))
        counts, begins = self.counts[places], self.begins[places]
        ids, wide = _gathered(self.ids, begins, counts).astype(np.int64), _gathered(self.widths, begins, counts)
        upto = np.concatenate(([0], np.cumsum(counts)))
        stops = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        per_text = np.diff(upto[np.concatenate(([0], stops))])
        ends = np.cumsum(wide, dtype=np.int64)
        begins = ends - wide
        byte = self.byte_of[ids]
        at = np.flatnonzero(byte >= 0)
        if len(at):
            byte = byte[at]
            first = np.maximum.accumulate(np.where(byte & 0xC0 != 0x80, np.arange(len(at)), 0))
            begins[at] = begins[at[first]]
            ends[at] = begins[at] + self.lead[byte[first]]
        # each text has one source more than it has bytes, its end
        before = np.repeat(np.arange(len(texts)), per_text)
        return per_text, ids, source[begins + before], source[ends + before]

    def code_all(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """(ids, begins, ends) of each text."""
        counts, *flat = self.code_batch(texts)
        for stop, n in zip(np.cumsum(counts).tolist(), counts.tolist()):
            ids, begins, ends = (x[stop - n : stop] for x in flat)
            yield ids.tolist(), begins, ends

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """Piece ids of each text, without an end id."""
        return (ids for ids, _, _ in self.code_all(texts))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def spans(self, text: str) -> list[tuple[int, str, int, int]]:
        """(id, piece, begin, end) with byte offsets in the original text."""
        ids, begins, ends = next(self.code_all([text]))
        return [(i, self.model.pieces[i], b, e) for i, b, e in zip(ids, begins.tolist(), ends.tolist())]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces join into UTF-8, each byte of a broken
        sequence becomes a replacement character, and the space that the encoder
        put in front is dropped."""
        return next(self.decode_all(np.array(ids, np.int64), [len(ids)]))


@lru_cache(maxsize=1)
def codec_of(model: bytes) -> Codec:
    """The codec of a model file; a worker process keeps it for its next tasks."""
    return Codec(Model.parse(model))


@lru_cache(maxsize=1)
def decoder_of(model: bytes) -> Decoder:
    return Decoder(Model.parse(model))


def read_model(path: str) -> bytes:
    """The bytes of a model file on the driver, a fixed vocabulary (about 0.5 MB).
    They travel to the tasks inside the function, so executors need no file."""
    with open(path, "rb") as f:
        return f.read()


#: Documents handed back together; bounds what a batch of long texts makes.
ROWS = 128


def encode_spans(
    docs: DataFrame, model: bytes, text: str = "text", id_col: str = "doc_id", end: bool = False, names: bool = True, back: bool = False
) -> DataFrame:
    """(doc_id, ids, pieces, begins, ends): the whole text of every row, null as empty,
    each piece with the byte range of the original text that it stands for. With
    ``end`` the end id follows, an empty range after the text; empty text: the end id
    alone, or nothing. Without ``names`` the pieces' texts, which the ids give, are left
    out; with ``back`` the text that the ids decode to follows as ``decoded``. Repeated
    rows and null ids are encoded like any other, extra columns are ignored, an empty
    table gives no rows."""
    ints = pa.list_(pa.int32())
    fields = [("doc_id", pa.int64()), ("ids", ints)] + [("pieces", pa.list_(pa.string()))] * names
    schema = pa.schema([*fields, ("begins", ints), ("ends", ints), *[("decoded", pa.string())] * back])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        words = pa.array(codec.model.pieces, pa.string())
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                own = [t or "" for t in part.column(1).to_pylist()]
                counts, ids, begins, ends = codec.code_batch(own)
                if end:
                    stops = np.cumsum(counts)
                    last = np.fromiter((len(t.encode()) for t in own), np.int64, len(own))
                    ids, begins, ends = np.insert(ids, stops, codec.model.end), np.insert(begins, stops, last), np.insert(ends, stops, last)
                    counts = counts + 1
                places = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                flat = [pa.array(x.astype(np.int32)) for x in (ids, begins, ends)]
                if names:
                    flat.insert(1, words.take(flat[0]))
                cols = [part.column(0), *[pa.ListArray.from_arrays(places, x) for x in flat]]
                if back:
                    cols.append(pa.array(codec.decode_all(ids, counts.tolist()), pa.string()))
                yield pa.RecordBatch.from_arrays(cols, schema=schema)
        codec.clear()  # other work of this process has the memory

    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    listed = {"ids": "array<int>", "pieces": "array<string>", "begins": "array<int>", "ends": "array<int>", "decoded": "string"}
    return own.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{n} {listed[n]}" for n in schema.names[1:]))


def encode(docs: DataFrame, model: bytes, text: str = "text", id_col: str = "doc_id", end: bool = True) -> DataFrame:
    """(doc_id, ids) of ``encode_spans``, with the end id unless ``end`` is false."""
    return encode_spans(docs, model, text, id_col, end, names=False).select("doc_id", "ids")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``encoded`` (all columns, of which ``ids`` is read) with the text of the ids as
    ``decoded``; null ids decode to the empty text."""
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decoder_of(model)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                ids = part.column(at)
                texts = decoder(ids.flatten().to_numpy(), ids.value_lengths().fill_null(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))
