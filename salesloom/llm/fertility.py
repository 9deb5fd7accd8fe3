"""Quality rules from tokeniser fertility (operator 10).

Public vocabularies measure every text: characters per token and share of byte-fallback tokens (a merge vocabulary with byte
pieces), characters per token of a byte-level vocabulary, and the entropy of the tokens, divided by the entropy of as many
different ones. Equal segments of a text (a word with the space before it) are encoded once a worker. The corpus gives the rejection bands: for each language (or, without one, each script) the quartiles
of a measure, widened on both sides. A document outside a band of its group is rejected with the measure's name.
A group of n documents has its own quartiles with the weight n / (n + k), the rest is those of its script (the script of most
of its documents), at every size. k is SHRINK for a group that lies where its script does, and falls with the square of
their distance in quartile distances: what clearly differs from its script is not pulled towards it.

Base figures: words are runs without ASCII white space; repeated words are those inside three-word windows that occur
twice or more in the text; repeated lines are lines with a word that equal an earlier line.

Defined cases: null and empty texts have no words and fail the base rule; ties and repeated rows are measured
alike; null languages go by script; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import chunks_by_size, whole, written

SYMBOLS = tuple(bytes([s]) for s in b"#*$%&|<>")
SPACE = "▁"
# Segments that a worker remembers for each vocabulary, and characters handled at once.
REMEMBERED = 300_000
CHUNK_CHARS = 1_000_000
# How byte-level patterns end that cut at white space.
SPACE_ENDING = r"|\s+(?!\S)|\s+"
# White space as those patterns see it (Python's differs in four control characters).
_RARE_WHITE = r"\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE = rf"\n {_RARE_WHITE}"
_SPACED = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
# Where words cannot just be cut at single spaces: other white space beside a space or of another kind than a line break, space symbols.
_ODD = re.compile(f"[{_RARE_WHITE}{SPACE}]| [ \\n]|\\n ")
_FIRST, _SECOND = itemgetter(0), itemgetter(1)
_PIECES = re.compile(f"{SPACE}+[^{SPACE}]*")
MIN_WORDS = 50
REPEAT_PERCENT = 50
# A band reaches this many quartile distances beyond the quartiles; short texts vary more, so it widens by
# sqrt(1 + SPREAD_TOKENS / tokens). The quartile distance counts as this much at least.
WIDENING = 2.5
SPREAD_TOKENS = 600
LEAST_SPREAD = {"chars_per_token": 0.02, "chars_per_byte_token": 0.02, "byte_share": 0.002, "entropy_share": 0.02}
# The quartiles of a group's script count as so many documents at most.
SHRINK = 10

MEASURES = tuple(LEAST_SPREAD)
FIGURES = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,n_tokens:bigint,"
    "chars_per_token:double,chars_per_byte_token:double,byte_share:double,entropy_share:double,script:string>"
)

# First code points of ranges and the script that starts there.
_SCRIPTS = (
    (0x00, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x900, "indic"), (0xE00, "thai"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
)

_STARTS, _NAMES = np.array([p for p, _ in _SCRIPTS]), np.array([n for _, n in _SCRIPTS])


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    size = np.int64(len(codes))
    pairs = ids[:-2] * size + ids[1:-1]
    if len(codes) >= 1 << 21:  # the product of three would not fit
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, place, count = np.unique(pairs * size + ids[2:], return_inverse=True, return_counts=True)
    again = count[place] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()] if b"\n" in text else []
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script of most letters, by ranges of code points; ties to the first name."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, set(text))) else "none"
    counts = np.bincount(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64))
    points = np.array(sorted(ord(c) for c in set(text) if c.isalpha()), np.int64)
    if not len(points):
        return "none"
    place = np.searchsorted(_STARTS, points, side="right") - 1
    names, place = np.unique(_NAMES[place], return_inverse=True)
    return str(names[np.bincount(place, counts[points]).argmax()])


class Vocabularies:
    """Both vocabularies, with what they made of the segments met before.

    Segments encode alone: no piece of the merge vocabulary crosses into the next space (checked when it is read, see `pieces`), and a
    byte-level pattern that ends in SPACE_ENDING starts a new piece at every white space, so a run without white space
    and the space before it is cut the same way wherever it stands. Other patterns encode whole texts.
    """

    def __init__(self, piece_path: str, rank_path: str, pattern: str):
        import base64

        import sentencepiece
        import tiktoken

        crossing = re.compile(f"[^{SPACE}]{SPACE}")
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        # Spaces must be kept, and the library must put one before a text.
        keeps = self.pieces.decode(self.pieces.encode("  a ")) == "  a " and self.pieces.encode("a") == self.pieces.encode(" a")[-1:]
        self.alone = not any(map(crossing.search, names)) and keeps
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(len(names))])
        self.space_id = names.index(SPACE) if SPACE in names else self.pieces.unk_id()
        with open(rank_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.byte_level = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.spaced = pattern.endswith(SPACE_ENDING) and " ?" in pattern
        self.words: dict[str, tuple[bytes, int]] = {}
        self.ids: dict[str, bytes] = {}
        self.counts: dict[str, int] = {}

    def encoded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, int]]:
        """Ids of each text in the merge vocabulary, and its number of byte-level tokens."""
        plain = [bool(t) and self.alone and self.spaced and t[0] != " " and t[-1] != " " and not _ODD.search(t) for t in texts]
        split = [t.split(" ") if p else [] for t, p in zip(texts, plain)]
        fresh = {w for one in split for w in one if w not in self.words}
        if len(self.words) + len(fresh) > REMEMBERED:
            self.words.clear()
            fresh = {w for one in split for w in one}
        fresh_list = list(fresh)
        for w, ids in zip(fresh_list, self.pieces.encode(fresh_list, num_threads=1)):
            self.words[w] = np.array(ids, np.int32).tobytes(), len(self.byte_level.encode_ordinary(" " + w))
        others = self._by_runs([t for t, p in zip(texts, plain) if not p])
        for text, is_plain, one in zip(texts, plain, split):
            if not is_plain:
                yield next(others)
                continue
            found = list(map(self.words.__getitem__, one))
            ids = np.frombuffer(b"".join(map(_FIRST, found)), np.int32)
            # The first word has no space before it.
            yield ids, sum(map(_SECOND, found)) - found[0][1] + len(self.byte_level.encode_ordinary(one[0]))

    def _by_runs(self, texts: list[str]) -> Iterator[tuple[np.ndarray, int]]:
        """The same for texts with runs of white space or space symbols, cut by expressions; or whole, where segments do not encode alone."""
        if not self.alone:
            whole_ids = [np.array(i, np.int32) for i in self.pieces.encode(texts, num_threads=1)]
        else:
            split = [_PIECES.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
            fresh = {s for one in split for s in one if s not in self.ids}
            if len(self.ids) + len(fresh) > REMEMBERED:
                self.ids.clear()
                fresh = {s for one in split for s in one}
            fresh_list = list(fresh)
            # The library puts the first space symbol itself, but not before nothing.
            for s, ids in zip(fresh_list, self.pieces.encode([s[1:] for s in fresh_list], num_threads=1)):
                self.ids[s] = np.array(ids if s != SPACE else [self.space_id], np.int32).tobytes()
            whole_ids = [np.frombuffer(b"".join(map(self.ids.__getitem__, one)), np.int32) for one in split]
        for text, ids in zip(texts, whole_ids):
            if self.spaced:
                parts = _SPACED.findall(text)
                if len(self.counts) > REMEMBERED:
                    self.counts.clear()
                for part in parts:
                    if part not in self.counts:
                        self.counts[part] = len(self.byte_level.encode_ordinary(part))
                yield ids, sum(map(self.counts.__getitem__, parts))
            else:
                yield ids, len(self.byte_level.encode_ordinary(text)) if text else 0


@lru_cache(maxsize=2)
def _vocabularies(piece_path: str, rank_path: str, pattern: str) -> Vocabularies:
    return Vocabularies(piece_path, rank_path, pattern)


def entropy_share(ids: np.ndarray) -> float:
    """Entropy of the tokens as a share of the largest that so many tokens can have; 1 for fewer than two."""
    if len(ids) < 2:
        return 1.0
    shares = np.unique(ids, return_counts=True)[1] / len(ids)
    return float(-(shares * np.log2(shares)).sum() / np.log2(len(ids)))


def _measure(text: str, ids: np.ndarray, others: int, is_byte: np.ndarray) -> tuple:
    raw = text.encode()
    words = raw.split()
    data = np.frombuffer(raw, np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    chars = len(text)
    return (
        len(words),
        chars - int(blank.sum()),
        sum(raw.count(s) for s in SYMBOLS),
        repeated_lines(raw),
        repeated_words(words),
        len(ids),
        chars / len(ids) if len(ids) else 0.0,
        chars / others if others else 0.0,
        float(is_byte[ids].mean()) if len(ids) else 0.0,
        entropy_share(ids),
        script_of(text),
    )


def measured(piece_path: str, rank_path: str, pattern: str, text: Column) -> Column:
    """All figures of a text."""

    @F.arrow_udf(FIGURES)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tools = _vocabularies(piece_path, rank_path, pattern)
        names = [part.partition(":")[0] for part in FIGURES[7:-1].split(",")]
        kinds = [pa.int64()] * 6 + [pa.float64()] * 4 + [pa.string()]
        for texts in batches:
            rows = []
            held = texts.to_pylist()
            for part in chunks_by_size([len(t) for t in held], CHUNK_CHARS):
                found = tools.encoded(held[part])
                rows += [_measure(t, ids, others, tools.is_byte) for t, (ids, others) in zip(held[part], found)]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return measure(text)


def _quartiles(passing: DataFrame, key: str) -> DataFrame:
    """For each value of a column: count n and quartiles of each measure."""
    quartiles = [F.percentile_approx(m, F.array(F.lit(0.25), F.lit(0.75)), 2000).alias(m) for m in MEASURES]
    edges = [F.col(m)[k].alias(f"{m}_{side}") for m in MEASURES for k, side in enumerate(("low", "high"))]
    return passing.groupBy(key).agg(F.count("*").alias("n"), *quartiles).select(key, "n", *edges)


def bands(figures: DataFrame) -> DataFrame:
    """For each group its quartiles of each measure over rows that pass the base rule, shrunk to those of its script."""
    passing = figures.filter(~F.col("base_failed"))
    most = passing.groupBy("group", "script").agg(F.count("*").alias("rows"))
    most = most.groupBy("group").agg(F.min(F.struct(-F.col("rows"), "script"))["script"].alias("script"))
    own, wide = _quartiles(passing, "group").alias("own"), _quartiles(passing, "script").alias("wide")
    shrunk = []
    for m in MEASURES:
        low, high, wide_low, wide_high = (F.col(f"{t}.{m}_{side}") for t in ("own", "wide") for side in ("low", "high"))
        spread = F.greatest(high - low, wide_high - wide_low, F.lit(LEAST_SPREAD[m]))
        apart = (low + high - wide_low - wide_high) / 2 / spread
        share = F.col("own.n") / (F.col("own.n") + SHRINK / (1 + apart * apart))
        shrunk += [(wide_low + share * (low - wide_low)).alias(f"{m}_low"), (wide_high + share * (high - wide_high)).alias(f"{m}_high")]
    return own.join(most, "group").join(wide, "script").select("group", *shrunk)


def judged(figures: DataFrame) -> DataFrame:
    """Add kept and reason: the base rule first, then the bands of the document's group."""
    # One row a group: written, its size is known and the figures need not move.
    edges = written(bands(figures), "fertility-bands")
    names = [c for c in edges.columns if c != "group"]
    joined = figures.join(edges, "group", "left")
    wider = F.lit(WIDENING) * F.sqrt(1 + SPREAD_TOKENS / F.greatest("n_tokens", F.lit(1)))
    reason = F.when(F.col("n_words") < MIN_WORDS, "too few words").when(F.col("base_failed"), "repeated words")
    for m in MEASURES:
        low, high = F.col(f"{m}_low"), F.col(f"{m}_high")
        width = wider * F.greatest(high - low, F.lit(LEAST_SPREAD[m]))
        reason = reason.when(F.col(m) < low - width, f"{m} too low").when(F.col(m) > high + width, f"{m} too high")
    return joined.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull()).drop(*names)


def verdicts(documents: DataFrame, piece_path: str, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, every figure, group, base_failed, reason and kept for each document (columns doc_id, text, lang)."""
    figures = documents.select("doc_id", "lang", measured(piece_path, rank_path, pattern, whole()).alias("f"))
    figures = figures.select("doc_id", "lang", "f.*").select(
        "*",
        F.coalesce(F.col("lang"), F.concat(F.lit("script "), F.col("script"))).alias("group"),
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
    )
    return judged(written(figures.drop("lang"), "fertility")).drop("script")
