"""SentencePiece encoding and decoding (operator 7): a score-ordered agenda of adjacent symbol pairs.

A text becomes segments, each a run of space symbols with the word behind it. No piece of the vocabulary
crosses from a word into the next space symbol (checked when the model is read), so segments encode alone and
equal segments encode once a batch. Within a segment the agenda holds all adjacent symbol pairs whose union is a piece;
the pair with the highest score, the leftmost on ties, is merged next, and the two pairs that it forms with its
neighbours enter the agenda. Short segments run through the agenda side by side in numpy arrays; long ones use a heap.
Symbols left over that are no piece become byte pieces.

Every segment's ids are compared with the sentencepiece library once per batch that first meets it; the number of
disagreements comes back in a column (0 is expected) and replaces nothing.

Defined cases: a null or empty text has no ids (but the end id, if asked for) and decodes to the empty text; repeated
rows and null ids encode like any row; extra columns stay, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import chunks_by_size, ragged, whole

SPACE = "▁"
# Longer segments leave the arrays for the heap.
ARRAY_LENGTH = 48
# Characters handled at once, and segments a worker remembers.
CHUNK_CHARS = 2_000_000
REMEMBERED = 800_000
NONE = np.int64(1) << 62

ENCODED = "struct<ids:array<int>,disagreements:int>"


def _one_each(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one-each", _one_each)


class PieceModel:
    """A merge-type vocabulary with the tables that the agenda needs."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as form

        model = form.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        if model.trainer_spec.model_type != form.TrainerSpec.BPE:
            raise ValueError("a merge-type (BPE) vocabulary is needed")
        if normal.name != "identity" or normal.precompiled_charsmap or normal.remove_extra_whitespaces:
            raise ValueError("only vocabularies without text normalisation are supported")
        if not normal.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("spaces must be written as symbols in front of words")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = form.ModelProto.SentencePiece
        self.dummy_prefix = normal.add_dummy_prefix
        self.end_id = self.library.eos_id()
        self.unknown_id = self.library.unk_id()
        pieces = list(model.pieces)
        usable = {p.piece: i for i, p in enumerate(pieces) if p.type == kinds.NORMAL}
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in usable):
            raise ValueError("a piece crosses from a word into the next space")
        self.bytes_of = [b""] * len(pieces)
        self.byte_ids = [self.unknown_id] * 256
        self.is_byte = [False] * len(pieces)
        for i, p in enumerate(pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value], self.bytes_of[i], self.is_byte[i] = i, bytes([value]), True
            elif p.type == kinds.NORMAL:
                self.bytes_of[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == kinds.UNKNOWN:
                self.bytes_of[i] = model.trainer_spec.unk_surface.encode()
        self.byte_fallback = model.trainer_spec.byte_fallback
        # Symbols are pieces; characters inside pieces that are no piece themselves follow behind.
        self.symbols = dict(usable)
        for piece in usable:
            for character in piece:
                self.symbols.setdefault(character, len(pieces) + len(self.symbols))
        self.other_names = {i: c for c, i in self.symbols.items() if i >= len(pieces)}
        self.limit = np.int64(max(self.symbols.values(), default=0) + 2)
        order = {score: rank for rank, score in enumerate(sorted({p.score for p in pieces}, reverse=True))}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for piece, i in usable.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = order[pieces[i].score], i
        self.symbol_of_point = np.full(max((ord(c) for c in self.symbols if len(c) == 1), default=0) + 2, -1, np.int64)
        for symbol, i in self.symbols.items():
            if len(symbol) == 1:
                self.symbol_of_point[ord(symbol)] = i
        keys = np.array([left * int(self.limit) + right for left, right in self.pairs], np.int64)
        found = np.array(list(self.pairs.values()), np.int64).reshape(-1, 2)
        at = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[at], found[at, 0], found[at, 1]
        self.memory: dict[str, bytes] = {}
        # Each id's bytes inside a text, then as its first id: the space symbol that encoding put in front goes.
        first = [
            b[1:] if self.dummy_prefix and b.startswith(b" ") and not self.is_byte[i] and i != self.unknown_id else b
            for i, b in enumerate(self.bytes_of)
        ]
        self.table = pa.array(self.bytes_of + first, pa.binary())
        self.silent = np.array([not b for b in self.bytes_of], bool)

    # ---- the agenda ----------------------------------------------------------------------------------------------

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair of symbols; NONE where the union is no piece."""
        if not len(self.keys):
            return np.full(len(left), NONE), np.zeros(len(left), np.int64)
        key = left * self.limit + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], NONE), self.merged[at]

    def _symbols_of(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One symbol a character, and each segment's length; a character outside the vocabulary is minus its code point."""
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).astype(np.int64)
        found = self.symbol_of_point[np.minimum(points, len(self.symbol_of_point) - 1)]
        return np.where(found >= 0, found, -1 - points), np.fromiter(map(len, segments), np.int64, len(segments))

    def _heap(self, symbols: list[int]) -> list[int]:
        """One long segment: the agenda is a heap of (rank, position), neighbours are linked."""
        count, pairs = len(symbols), self.pairs
        after, before, alive = list(range(1, count + 1)), list(range(-1, count - 1)), [True] * count
        agenda = [
            (found[0], i, symbols[i], symbols[i + 1], found[1])
            for i in range(count - 1)
            if (found := pairs.get((symbols[i], symbols[i + 1])))
        ]
        heapq.heapify(agenda)
        while agenda:
            _, i, left, right, union = heapq.heappop(agenda)
            j = after[i]
            if not alive[i] or symbols[i] != left or j >= count or symbols[j] != right:
                continue  # an entry whose symbols have been merged otherwise
            symbols[i], alive[j], after[i] = union, False, after[j]
            if after[j] < count:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < count and (found := pairs.get((symbols[a], symbols[b]))):
                    heapq.heappush(agenda, (found[0], a, symbols[a], symbols[b], found[1]))
        return [s for s, living in zip(symbols, alive) if living]

    def _arrays(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Many segments: in each step every segment merges the first pair of its own agenda."""
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        owner, symbols = np.arange(len(lengths)), symbols.copy()
        inner = np.ones(len(symbols), bool)
        inner[np.cumsum(lengths) - 1] = False  # the last symbol of a segment starts no pair
        ranks, unions = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        at = np.flatnonzero(inner)
        ranks[at], unions[at] = self._look_up(symbols[at], symbols[at + 1])
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            agenda = np.where(ranks < NONE, ranks * len(symbols) + np.arange(len(symbols)), NONE)
            first = np.minimum.reduceat(agenda, starts)
            ready = first == NONE
            if ready.any():
                keep = np.repeat(~ready, lengths)
                done.append((owner[ready], lengths[ready], symbols[~keep]))
                moved = np.cumsum(keep) - 1
                first = first[~ready]
                at = moved[first % len(symbols)]
                symbols, ranks, unions, inner = symbols[keep], ranks[keep], unions[keep], inner[keep]
                owner, lengths = owner[~ready], lengths[~ready]
                if not len(owner):
                    break
            else:
                at = first % len(symbols)
            symbols[at], inner[at] = unions[at], inner[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, ranks, unions, inner = symbols[keep], ranks[keep], unions[keep], inner[keep]
            lengths = lengths - 1
            at = at - np.arange(len(at))  # one symbol of every earlier segment is gone
            starts = np.cumsum(lengths) - lengths
            fresh = np.concatenate([at, at[at > starts] - 1])
            ranks[fresh] = NONE
            fresh = fresh[inner[fresh]]
            ranks[fresh], unions[fresh] = self._look_up(symbols[fresh], symbols[fresh + 1])
        owner, lengths, symbols = (np.concatenate(x) for x in zip(*done))
        at = np.argsort(owner, kind="stable")
        return ragged(symbols, (np.cumsum(lengths) - lengths)[at], lengths[at]), lengths[at]

    def _ids(self, symbols: list[int]) -> list[int]:
        """Pieces as they are; other characters as bytes, or as the unknown piece where the vocabulary has no bytes."""
        size = len(self.bytes_of)
        ids: list[int] = []
        for s in symbols:
            if 0 <= s < size:
                ids.append(s)
            elif self.byte_fallback:
                ids.extend(self.byte_ids[b] for b in (chr(-1 - s) if s < 0 else self.other_names[s]).encode())
            elif not ids or ids[-1] != self.unknown_id:
                ids.append(self.unknown_id)
        return ids

    def encode_segments(self, segments: list[str]) -> list[bytes]:
        """The ids of each segment, as 32-bit numbers."""
        symbols, lengths = self._symbols_of(segments)
        starts = np.cumsum(lengths) - lengths
        short = lengths <= ARRAY_LENGTH
        out = [b""] * len(segments)
        if short.any():
            merged, counts = self._arrays(ragged(symbols, starts[short], lengths[short]), lengths[short])
            ends = np.cumsum(counts)
            plain = np.minimum.reduceat((merged >= 0) & (merged < len(self.bytes_of)), ends - counts)
            buffer = merged.astype(np.int32).tobytes()
            for k, begin, end, pieces in zip(np.flatnonzero(short).tolist(), (ends - counts).tolist(), ends.tolist(), plain.tolist()):
                ids = buffer[4 * begin : 4 * end]
                out[k] = ids if pieces else np.array(self._ids(merged[begin:end].tolist()), np.int32).tobytes()
        for k in np.flatnonzero(~short).tolist():
            found = self._heap(symbols[starts[k] : starts[k] + lengths[k]].tolist())
            out[k] = np.array(self._ids(found), np.int32).tobytes()
        return out

    # ---- texts ---------------------------------------------------------------------------------------------------

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        return re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE))

    def _check(self, segments: list[str], ids: list[bytes]) -> list[bool]:
        """Which segments the library encodes otherwise. It puts the first space symbol itself, but not before nothing."""
        cut = 1 if self.dummy_prefix else 0
        theirs = self.library.encode([s[cut:] for s in segments], num_threads=1)
        if cut and SPACE in segments:
            at = segments.index(SPACE)
            theirs[at] = np.frombuffer(ids[at], np.int32).tolist()
        if list(map(len, ids)) == [4 * len(b) for b in theirs] and b"".join(ids) == np.fromiter(chain.from_iterable(theirs), np.int32).tobytes():
            return [False] * len(segments)
        return [np.array(b, np.int32).tobytes() != a for a, b in zip(ids, theirs)]

    def encode(self, texts: list[str], end: bool) -> Iterator[tuple[np.ndarray, int]]:
        """Ids of each text, and how many of its newly met segments the library encodes otherwise."""
        close = np.array([self.end_id] if end else [], np.int32).tobytes()
        for part in chunks_by_size([len(t) for t in texts], CHUNK_CHARS):
            split = [self.segments(t) for t in texts[part]]
            every = set(chain.from_iterable(split))
            missing = every.difference(self.memory)
            if len(self.memory) + len(missing) > REMEMBERED:
                self.memory.clear()
                missing = every
            wrong: set[str] = set()
            fresh = list(missing)
            for begin in range(0, len(fresh), 100_000):
                block = fresh[begin : begin + 100_000]
                ids = self.encode_segments(block)
                wrong.update(s for s, bad in zip(block, self._check(block, ids)) if bad)
                self.memory.update(zip(block, ids))
            for one in split:
                joined = b"".join(map(self.memory.__getitem__, one)) + close
                yield np.frombuffer(joined, np.int32), sum(s in wrong for s in one) if wrong else 0

    def decode(self, ids: list[int]) -> str:
        """Bytes of all pieces, each run of byte pieces by itself; the space symbol that encoding put in front goes."""
        runs = (
            b"".join(map(self.bytes_of.__getitem__, run)).decode("utf-8", "one-each")
            for _, run in groupby(ids, self.is_byte.__getitem__)
        )
        text = "".join(runs)
        if self.dummy_prefix and text.startswith(" "):
            first = next(i for i in ids if self.bytes_of[i])
            return text if self.is_byte[first] or first == self.unknown_id else text[1:]
        return text


    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids; a null list gives the empty text.

        All bytes are gathered at once. That equals decoding each run of byte pieces by itself where a whole text is valid
        UTF-8, as all other pieces are whole characters. Other batches, and lists that begin with an id without bytes, go one by one.
        """
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        begins, several = ends[:-1][lengths > 0], lengths[lengths > 0] > 1
        if len(ids) and not (self.silent[ids[begins]] & several).any():
            places = ids.astype(np.int64)
            places[begins] += len(self.bytes_of)
            pieces = self.table.take(pa.array(places))
            cuts = np.frombuffer(pieces.buffers()[1], np.int32, len(ids) + 1)[ends].copy()
            texts = pa.StringArray.from_buffers(len(lists), pa.py_buffer(cuts), pieces.buffers()[2] or pa.py_buffer(b""))
            try:
                texts.validate(full=True)
                return texts
            except pa.ArrowInvalid:
                pass  # some byte pieces are no characters
        return pa.array([self.decode(found) if found else "" for found in lists.to_pylist()], pa.string())


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encoder(path: str, end: bool):
    """An Arrow function from texts to ids and disagreements with the library."""

    @F.arrow_udf(ENCODED)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = piece_model(path)
        for batch in batches:
            found = list(model.encode(batch.to_pylist(), end))
            offsets = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in found])])
            flat = np.concatenate([ids for ids, _ in found]) if found else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            bad = pa.array([b for _, b in found], pa.int32())
            yield pa.StructArray.from_arrays([lists, bad], ["ids", "disagreements"])
        model.memory.clear()  # the worker may wait or decode next

    return encode


def decoder(path: str):
    """An Arrow function from ids to text."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = piece_model(path)
        for batch in batches:
            yield model.decode_all(batch)

    return decode


def encode_texts(frame: DataFrame, path: str, column: str = "text", end: bool = True) -> Column:
    """The encoding of a text column: ids array and disagreements."""
    return encoder(path, end)(whole(column))


def with_pieces(frame: DataFrame, path: str, column: str = "text", prefix: str = "piece_", end: bool = True) -> DataFrame:
    """Add <prefix>ids, <prefix>text (decoded again) and <prefix>disagreements behind the columns of `frame`.

    Columns of these names that are there already give way.
    """
    held = f"{prefix}encoded__"
    names = [f"{prefix}{n}" for n in ("ids", "text", "disagreements")]
    return (
        frame.drop(*(n for n in names if n != column))
        .withColumn(held, encode_texts(frame, path, column, end))
        .withColumn(names[0], F.col(f"{held}.ids"))
        .withColumn(names[2], F.col(f"{held}.disagreements"))
        .withColumn(names[1], decoder(path)(F.col(names[0])))
        .drop(held)
    )
