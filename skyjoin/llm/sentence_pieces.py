"""SentencePiece BPE encoding that keeps byte offsets, and decoding."""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyjoin.llm.bpe import Memory
from skyjoin.llm.common import blocks, text_bytes

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: The character that stands for a space in pieces, and kinds of pieces in model files. Fixed values.
MARK = "▁".encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
#: Bytes of a chunk that are remembered, and symbols from which a heap finds the next merge.
SHORT, MANY = 64, 48


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """A compiled character map: a double-array trie of byte strings, and what replaces each of them.

    A unit of the trie holds a label in its lowest 8 bits, whether a value follows in bit 8, and from bit 10 the
    offset to its children, in steps of 256 if bit 9 is set; a unit with bit 31 holds a value, here the place of a
    replacement that ends with a zero byte.
    """

    def __init__(self, data: bytes):
        size = struct.unpack_from("<I", data)[0] if data else 0
        self.array = np.frombuffer(data, "<u4", size // 4, 4) if size else np.zeros(0, "<u4")
        self.units = self.array.tolist()
        self.texts = data[4 + size :]
        #: Bytes that some key starts with; others stay as they are.
        self.starts = {byte for byte in range(1, 256) if self.units and self.child(self.offset(self.units[0]), byte) is not None}

    @staticmethod
    def offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def child(self, node: int, byte: int) -> int | None:
        """The node below, given where a node's children are."""
        at = node ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def replacement(self, at: int) -> bytes:
        return self.texts[at : self.texts.index(b"\0", at)]

    def longest(self, data: bytes, start: int) -> tuple[bytes, int]:
        """The replacement of the longest key that data has at start, and the key's length; 0 without one."""
        if start >= len(data) or data[start] not in self.starts:
            return b"", 0
        node, found, size = self.offset(self.units[0]), -1, 0
        for k in range(start, len(data)):
            at = self.child(node, data[k]) if data[k] else None
            if at is None:
                break
            node = at ^ self.offset(self.units[at])
            if self.units[at] >> 8 & 1:
                found, size = self.units[node] & 0x7FFFFFFF, k - start + 1
        return (self.replacement(found), size) if size else (b"", 0)

    def entries(self) -> Iterator[tuple[bytes, bytes]]:
        """All keys with their replacements."""
        stack, labels = [(self.offset(self.units[0]), b"")] if self.units else [], np.arange(1, 256, dtype=np.uint32)
        while stack:
            node, key = stack.pop()
            places = node ^ labels.astype(np.int64)
            units = self.array[np.minimum(places, len(self.units) - 1)]
            for byte in labels[(places < len(self.units)) & (units & np.uint32(0x800000FF) == labels)].tolist():
                below = node ^ byte ^ self.offset(self.units[node ^ byte])
                if self.units[node ^ byte] >> 8 & 1:
                    yield key + bytes([byte]), self.replacement(self.units[below] & 0x7FFFFFFF)
                stack.append((below, key + bytes([byte])))


def character_size(byte: int) -> int:
    return 1 if byte < 0xC0 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4


class Normaliser:
    """Texts as the model wants them, with the place that each byte came from."""

    def __init__(self, table: bytes = b"", prefix: bool = True, tidy: bool = True, escape: bool = True):
        self.map, self.prefix, self.tidy = CharacterMap(table), prefix, tidy
        self.space = MARK if escape else b" "

    def units(self, data: bytes) -> Iterator[tuple[bytes, int, int]]:
        """Pieces of data that are replaced as one: replacement, start, end."""
        at = 0
        while at < len(data):
            text, size = self.map.longest(data, at)
            if not size:
                size = character_size(data[at])
                text = data[at : at + size]
            yield text, at, at + size
            at += size

    def __call__(self, data: bytes, first: bool = True, last: bool = True) -> tuple[bytes, list[int]]:
        """data normalised, and for each byte of that, and its end, the offset in data of what it came from.

        first and last say whether data starts and ends the text: a space is put in front of its start, and a tidy
        normaliser drops spaces at both and all but one of others in a row.
        """
        out, origin, end = bytearray(), [], 0
        spaced, begun = self.tidy and first, not first
        for text, start, end in self.units(data):
            if not begun:
                if self.tidy and text == b" ":
                    continue
                begun = True
                if self.prefix:
                    out += self.space
                    origin += [start] * len(self.space)
            if spaced:
                text = text.lstrip(b" ")
            if text:
                spaced = self.tidy and text.endswith(b" ")
                for part in (text[k : k + 1] for k in range(len(text))) if b" " in text else (text,):
                    part = self.space if part == b" " else part
                    out += part
                    origin += [start] * len(part)
            elif not self.tidy:
                spaced = False
        if self.tidy and last:
            while out.endswith(self.space):
                del out[-len(self.space) :]
                end = origin[len(out)]
                del origin[len(out) :]
        return bytes(out), [*origin, end]


def as_text(run: bytes) -> bytes:
    """Bytes as UTF-8, with U+FFFD for each byte that is none."""
    out = b""
    while run:
        try:
            run.decode()
        except UnicodeDecodeError as error:
            out, run = out + run[: error.start] + "\ufffd".encode(), run[error.start + 1 :]
        else:
            return out + run
    return out


class Model:
    """A model file: pieces with scores, and how it normalises. Encodes as the library does, without sampling.

    Only BPE models with byte fallback whose pieces are normal, unknown, control or byte ones are taken.
    """

    def __init__(self, data: bytes):
        self.ids: dict[str, int] = {}
        self.ranks: dict[str, float] = {}
        self.bytes_of, self.byte_ids, self.surfaces = {}, {}, []
        kind_of_model, fallback, suffix = 1, False, False
        normal = {"table": b"", "prefix": True, "tidy": True, "escape": True}
        for field, value in fields(data):
            if field == 1:
                self.add(dict(fields(value)))
            elif field == 2:
                trainer = dict(fields(value))
                kind_of_model, fallback, suffix = trainer.get(3, 1), bool(trainer.get(35, 0)), bool(trainer.get(24, 0))
            elif field == 3:
                given = dict(fields(value))
                normal = {"table": given.get(2, b""), "prefix": bool(given.get(3, 1)), "tidy": bool(given.get(4, 1)), "escape": bool(given.get(5, 1))}
        if kind_of_model != BPE or not fallback or suffix or len(self.byte_ids) != 256:
            raise ValueError("not a BPE model with byte fallback and spaces in front of words")
        self.normalise = Normaliser(**normal)
        self.strips = normal["prefix"] or normal["tidy"]
        self.tidy = normal["tidy"]
        #: The normaliser changes nothing but spaces, each to the mark.
        self.plain = not self.normalise.map.units and not self.tidy and normal["escape"]
        self.spaced = {number for text, number in self.ids.items() if text[:1] == MARK.decode()}
        #: Chunks without and with the places of their pieces.
        self.seen = Memory(), Memory()
        self.cuts = self.safe_cuts()

    def add(self, piece: dict) -> None:
        text, kind, number = piece.get(1, b""), piece.get(3, NORMAL), len(self.surfaces)
        if kind not in (NORMAL, UNKNOWN, CONTROL, BYTE):
            raise ValueError(f"kind {kind} of pieces not supported")
        self.surfaces.append(text.replace(MARK, b" ") if kind == NORMAL else " ⁇ ".encode() if kind == UNKNOWN else b"")
        if kind == NORMAL:
            self.ids[text.decode()] = number
            # the lowest rank merges first
            self.ranks[text.decode()] = -struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
        elif kind == BYTE:
            self.bytes_of[number] = int(text[3:5], 16)
            self.byte_ids[self.bytes_of[number]] = number

    def safe_cuts(self) -> np.ndarray:
        """Pairs of bytes between which a text can be cut: what lies on both sides is encoded as it would be alone.

        Where only spaces change, these are all pairs that no piece has side by side, as no merge can lie across
        them. Otherwise a text is cut only in front of spaces, if the map changes no string with a space, if no
        piece has the mark after another character, and if what the byte before belongs to is not replaced by
        nothing or by something that ends with a space.
        """
        mark, safe = MARK.decode(), np.zeros((256, 256), bool)
        if self.plain:
            together = {pair for piece in self.ids for text in (piece.encode(), piece.replace(mark, " ").encode()) for pair in zip(text, text[1:])}
            safe[:] = True
            safe[tuple(zip(*together))] = False
            # a mark in the text beside a space, and the inside of characters
            safe[0x20, MARK[0]] = safe[MARK[-1], 0x20] = False
            safe[:, 0x80:0xC0] = False
            return safe
        before = np.ones(256, bool)
        before[[0x20, MARK[-1]]] = False
        changed = list(self.normalise.map.entries())
        inside = any(mark in piece.lstrip(mark) for piece in self.ids)
        if inside or mark not in self.ids or self.normalise.space != MARK or any(b" " in key for key, _ in changed):
            before[:] = False
        for key, text in changed:
            if not text or text.endswith((b" ", MARK)):
                before[key[-1]] = False
        safe[before, 0x20] = True
        return safe

    # ---- encoding

    def merged(self, symbols: list[str]) -> list[str]:
        """Characters merged by rank, the leftmost of equals first."""
        if len(symbols) > MANY:
            return self.merged_by_heap(symbols)
        rank, none = self.ranks.get, float("inf")
        pairs = [rank(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(symbols[at - 1] + symbols[at], none)
            if at < len(pairs):
                pairs[at] = rank(symbols[at] + symbols[at + 1], none)
        return symbols

    def merged_by_heap(self, symbols: list[str]) -> list[str]:
        size = len(symbols)
        after, before, heap = [*range(1, size), -1], list(range(-1, size - 1)), []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (r := self.ranks.get(symbols[a] + symbols[b])) is not None:
                heapq.heappush(heap, (r, a, b, len(symbols[a]) + len(symbols[b])))

        for k in range(size - 1):
            offer(k, k + 1)
        while heap:
            _, a, b, length = heapq.heappop(heap)
            if not symbols[a] or not symbols[b] or len(symbols[a]) + len(symbols[b]) != length:
                continue
            symbols[a], symbols[b] = symbols[a] + symbols[b], ""
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s in symbols if s]

    def pieces(self, data: bytes, first: bool, last: bool) -> tuple[list[int], list[int], list[int]]:
        """Ids, starts and ends of the pieces of a part of a text; a character in no piece is one for each byte, of
        which the last has the character's place."""
        if self.plain and MARK not in data:
            return self.plain_pieces(data.decode(), first)
        text, origin = self.normalise(data, first, last)
        symbols = self.merged(list(text.decode(errors="replace")))
        places = [origin[k] for k in itertools.accumulate([len(s.encode()) for s in symbols], initial=0)]
        return self.with_bytes(symbols, places)

    def plain_pieces(self, text: str, first: bool) -> tuple[list[int], list[int], list[int]]:
        """pieces() where only spaces change: then a symbol's length tells that of its source."""
        mark, before = MARK.decode(), 0
        symbols = list(text.replace(" ", mark))
        if first and self.normalise.prefix:
            symbols.insert(0, mark)
            before = -1  # the mark put in front comes from nothing
        symbols = self.merged(symbols)
        places = list(itertools.accumulate(
            map(len, symbols) if text.isascii() else [len(s.encode()) - 2 * s.count(mark) for s in symbols], initial=before))
        places[0] = 0
        if first and before and len(places) > 1:
            places[1] = max(places[1], 0)
        return self.with_bytes(symbols, places)

    def with_bytes(self, symbols: list[str], places: list[int]) -> tuple[list[int], list[int], list[int]]:
        """Ids of symbols, and of the bytes of those that have none; places are the symbols' starts and the end."""
        ids = list(map(self.ids.get, symbols))
        if None not in ids:
            return ids, places[:-1], places[1:]
        out, starts, ends = [], [], []
        for symbol, number, start, end in zip(symbols, ids, places, places[1:]):
            codes = [number] if number is not None else [self.byte_ids[byte] for byte in symbol.encode()]
            out += codes
            starts += [start] * len(codes)
            ends += [start] * (len(codes) - 1) + [end]
        return out, starts, ends

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where texts are cut into chunks whose pieces don't depend on their neighbours, and where texts start."""
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = self.cuts[data[:-1], data[1:]]
        cut[offsets] = True
        return np.flatnonzero(cut)

    def encode(self, text: bytes) -> list[tuple[int, int, int]]:
        """Id, start and end in bytes of each piece of a whole text."""
        data = np.frombuffer(text, np.uint8)
        starts = self.starts(data, np.array([0, len(data)])).tolist() if text else []
        out: list[tuple[int, int, int]] = []
        for a, b in zip(starts, starts[1:]):
            out += [(i, s + a, e + a) for i, s, e in zip(*self.pieces(text[a:b], a == 0, b == len(text)))]
        return out

    # ---- decoding

    def decode(self, ids: list[int], first: bool = True) -> bytes:
        """The text of ids; first says whether they start it."""
        if not first and self.bytes_of.keys().isdisjoint(ids):
            return b"".join(map(self.surfaces.__getitem__, ids))
        out, run = bytearray(), bytearray()
        for number in ids:
            if (byte := self.bytes_of.get(number)) is not None:
                run.append(byte)
                continue
            if run:
                out += as_text(bytes(run))
                run.clear()
            text = self.surfaces[number]
            if first and not out and self.strips and number in self.spaced:
                text = text[1:]
                first = self.tidy
            out += text
        return bytes(out) + as_text(bytes(run))


@functools.lru_cache(2)
def model(path: str) -> Model:
    with open(path, "rb") as file:
        return Model(file.read())


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, with_spans: bool) -> Iterator[pa.RecordBatch]:
    own = model(path)
    seen = own.seen[with_spans]

    def part(chunk: bytes, first: bool, last: bool) -> tuple[int, bytes, bytes, int, tuple | None]:
        """Count of ids, ids as decimals, the text that they decode to, the bytes that the pieces stand for, and the pieces."""
        pieces = ids, starts, ends = own.pieces(chunk, first, last)
        text = own.decode(ids, first)
        return len(ids), ",".join(map(str, ids)).encode(), chunk if text == chunk else text, sum(ends) - sum(starts), pieces if with_spans else None

    def inner(chunk: bytes) -> tuple[int, bytes, bytes, int, tuple | None]:
        found = seen.get(chunk) if len(chunk) <= SHORT else None
        if found is None:
            found = part(chunk, False, False)
            if len(chunk) <= SHORT:
                seen.put(chunk, found)
        return found

    for block in blocks(batches):
        data, offsets = text_bytes(block.column("text"))
        starts = own.starts(data, offsets)
        bounds = np.searchsorted(starts, offsets)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)])
        coded = chunks.dictionary_encode()
        codes, distinct = np.asarray(coded.indices), coded.dictionary.to_pylist()
        # chunks at the start and, of a tidy model, at the end of a text are looked at by themselves
        own_part, full = np.zeros(len(codes), bool), bounds[:-1] < bounds[1:]
        own_part[bounds[:-1][full]] = True
        if own.tidy:
            own_part[bounds[1:][full] - 1] = True
        found: list = [NOTHING] * len(distinct)
        for code in np.unique(codes[~own_part]).tolist():
            found[code] = inner(distinct[code])
        sizes, decimals, decoded, covers, places = zip(*found) if found else ((),) * 5
        sizes, covers = np.array(sizes, np.int64)[codes], np.array(covers, np.int64)[codes]
        codes, ids_digests, digests, spans = codes.tolist(), [], [], []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            parts, low, high = {}, a, b
            if a < b:
                low, high = a + 1, max(a + 1, b - own.tidy)
                for k in {a, high} & set(range(a, b)) if own.tidy else (a,):
                    parts[k] = part(distinct[codes[k]], k == a, k == b - 1)
                    sizes[k], covers[k] = parts[k][0], parts[k][3]
            rest = codes[low:high]
            ids = [*map(decimals.__getitem__, rest)]
            text = [*map(decoded.__getitem__, rest)]
            if a < b:
                ids.insert(0, parts[a][1]), text.insert(0, parts[a][2])
            if high < b and high > a:
                ids.append(parts[high][1]), text.append(parts[high][2])
            if own.tidy:
                ids = [i for i in ids if i]
            if a < b and not text[0]:  # the start of the text decodes to nothing: so may what follows it
                text = [own.decode([i for k in range(a, b) for i in own.pieces(distinct[codes[k]], k == a, k == b - 1)[0]])]
            ids_digests.append(hashlib.sha256(b",".join(ids)).hexdigest())
            digests.append(hashlib.sha256(b"".join(text)).hexdigest())
            spans.append([{"id": i, "start": s + at, "stop": e + at} for k in range(a, b) for at in [int(starts[k] - starts[a])]
                          for i, s, e in zip(*(parts[k][4] if k in parts else places[codes[k]]))] if with_spans else None)
        totals, covered = (np.diff(np.concatenate([[0], np.cumsum(x)])[bounds]) for x in (sizes, covers))
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(totals, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(digests, pa.string()), pa.array(covered, pa.int64()), pa.array(spans, SPANS)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_covered", "pieces"])


#: Of a chunk that no text holds but at its start.
NOTHING = (0, b"", b"", 0, None)
SPANS = pa.list_(pa.struct([("id", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))


def encode(documents: DataFrame, path: str = MODEL, with_spans: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_covered, pieces (null unless with_spans) for each row of documents (doc_id, text).

    n_covered counts the bytes of the text that its pieces stand for. pieces are the ids of the whole text with start and stop, in bytes of the text as UTF-8, of what each stands for: the
    normaliser takes the longest key of the model's character map at each place and keeps where it was, and pieces
    take over its offsets. The digests are SHA-256 of the ids as decimals joined by commas, and of the text that they
    decode to. Begin, end and sampled ids don't occur.

    Texts are cut before spaces wherever no piece and no key can lie across the cut, and equal chunks of a block are
    encoded once. Null or empty text: no ids. Null doc_id stays null; repeated rows each get their row; other columns
    are ignored. A text is one row's work and no row meets another: no shuffle.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(
        lambda batches: encode_batches(batches, path, with_spans),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_covered long, pieces array<struct<id:int,start:bigint,stop:bigint>>")


def decode(tokens: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, text of rows (doc_id, ids). Null ids: null text. Bytes that are no UTF-8 become U+FFFD."""
    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            texts = [None if x is None else own.decode(x).decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(texts_of, "doc_id long, text string")
