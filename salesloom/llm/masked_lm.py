"""Language-model scoring (operator 4): masked pseudo-likelihood of a bidirectional window network.

The network predicts a token from the two tokens before and the two behind it: their embeddings go through one tanh layer, then a
two-level softmax gives exact probabilities (first the token's class, then the token within its class). A document's score is
the sum over all its tokens of the log-probability given both sides.

The network's ids are the most frequent words, counted over the whole corpus by a Spark aggregation, and hashed buckets for
all other words. A word in a bucket has the bucket's probability times its share of the bucket's tokens, so every word of the
corpus has a probability of its own.

Texts are split once. Runs of documents (CHUNK_CHARS characters, at least one document) become rows of a written table: the
run's different words with their counts, and each token as the place of its word in that list. Counting, every round and the
scoring read this table; a word is looked up once a run, not once a token. A share is the word's count over its bucket's tokens:
the bucket's tokens are as many numbers as there are buckets and are broadcast, the counts are a table, joined to the runs' words
(a word that occurs once in the corpus has the logarithm 0 and needs no row) and brought back to their run, where they are summed per document.
Training is data-parallel over all documents: in each round every task starts from the same parameters,
masks a share of its positions (another share each round, until all were masked) and trains on them in numpy; Spark averages
the parameters of all tasks, weighted by their positions. What a task sends is the size of the model, and the model is what the driver and
the broadcasts hold; the corpus counts stay in Spark.

Defined cases: null and empty texts have no tokens and score 0 (per token: null); equal counts enter the vocabulary in the order of
the words; repeated rows train as often as they occur; extra columns are ignored; an empty table leaves the network as it starts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import chunks_by_size, whole, written

# Classes x members is the size of the vocabulary: 0 pads the ends, then words, then buckets.
CLASSES, MEMBERS = 32, 32
WORDS = 767
SIDE = 2
EMBEDDING, HIDDEN = 12, 24
# A round masks one position in ROUNDS, each round another phase: all rounds together train on every position once.
ROUNDS = 2
TRAIN_BATCH, SCORE_BATCH = 8192, 16384
RATE = 0.1
SEED = 17
# Characters of the texts that share a list of words, and how the table of these lists is cut on disk: a row is some MB.
CHUNK_CHARS = 24_000_000
CHUNK_FILES = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "compression": "zstd"}
# Tokens of the texts whose windows are held at once.
WINDOW_TOKENS = 50_000

SIZE = CLASSES * MEMBERS
SHAPES = {
    "embedding": (SIZE, EMBEDDING),
    "mix": (2 * SIDE * EMBEDDING, HIDDEN),
    "mix_bias": (HIDDEN,),
    "classes": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "members": (CLASSES, HIDDEN, MEMBERS),
    "member_bias": (CLASSES, MEMBERS),
}


class Vocabulary:
    """Ids of words: frequent ones by rank, others by hash."""

    def __init__(self, words: list[str]):
        self.known = {w: k + 1 for k, w in enumerate(words)}

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of(text.lower().split())

    def ids_of(self, words: list[str]) -> np.ndarray:
        known, buckets = self.known.get, SIZE - 1 - WORDS
        found = (known(w) or 1 + WORDS + zlib.crc32(w.encode("utf-8", "replace")) % buckets for w in words)
        return np.fromiter(found, np.int64, len(words))

    def __reduce__(self):
        return Vocabulary, (sorted(self.known, key=self.known.get),)


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Chunk(NamedTuple):
    """A run of documents: for each its id, phase and number of tokens; the run's words; every token's place among them."""

    doc_ids: pa.Array
    phases: np.ndarray
    lengths: np.ndarray
    words: list[str]
    codes: np.ndarray


def packed(codes: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest ones first, so that the mostly empty high ones compress to nothing."""
    return codes.astype("<u4").view(np.uint8).reshape(len(codes), 4).T.tobytes()


def unpacked(data: pa.Buffer) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, data.size // 4)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _chunk_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (row, doc_id, text) to runs; a run is named by its first row."""
    first, kind = None, None
    size, keys, phases, codes, numbers = 0, [], [], [], Numbers()

    def run() -> pa.RecordBatch:
        flat = np.concatenate(codes)
        counts = np.bincount(flat, minlength=len(numbers))
        # Frequent words first: small numbers.
        order = np.argsort(-counts, kind="stable")
        places = np.empty(len(order), np.uint32)
        places[order] = np.arange(len(order), dtype=np.uint32)
        words = pa.array(list(numbers), pa.string()).take(pa.array(order))
        lengths = pa.array([len(c) for c in codes], pa.int32())
        lists = [pa.array(keys, kind), pa.array(phases, pa.int32()), lengths, words, pa.array(counts[order], pa.int64())]
        columns = [pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values) for values in lists]
        columns = [pa.array([first], pa.int64()), *columns, pa.array([packed(places[flat])], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "doc_ids", "phases", "lengths", "words", "counts", "codes"])

    for batch in batches:
        kind = batch.schema.field(1).type
        for row, key, text in zip(*(column.to_pylist() for column in batch.columns)):
            first = row if first is None else first
            words = text.lower().split()
            codes.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            phases.append(zlib.crc32(text[:64].encode("utf-8", "replace")) % ROUNDS)
            keys.append(key)
            size += len(text)
            if size >= CHUNK_CHARS:
                yield run()
                first, size, keys, phases, codes, numbers = None, 0, [], [], [], Numbers()
    if keys:
        yield run()


def chunked(documents: DataFrame) -> DataFrame:
    """All texts as runs, split as the network's ids are: written once, read by every later step."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = (
        f"chunk bigint, doc_ids array<{kind}>, phases array<int>, lengths array<int>, words array<string>, counts array<bigint>, codes binary"
    )
    texts = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", whole().alias("text"))
    return written(texts.mapInArrow(_chunk_texts, schema), "lm-chunks", **CHUNK_FILES)


def read_chunks(rows: pa.RecordBatch | pa.Table) -> Iterator[Chunk]:
    for k in range(rows.num_rows):
        phases, lengths = (rows[name][k].values.to_numpy() for name in ("phases", "lengths"))
        words, codes = rows["words"][k].values.to_pylist(), unpacked(rows["codes"][k].as_buffer())
        yield Chunk(rows["doc_ids"][k].values, phases, lengths.astype(np.int64), words, codes)


def parts(chunk: Chunk) -> Iterator[tuple[slice, np.ndarray]]:
    """Documents of about WINDOW_TOKENS tokens, and their tokens' places."""
    ends = np.concatenate([[0], np.cumsum(chunk.lengths)])
    for part in chunks_by_size(chunk.lengths.tolist(), WINDOW_TOKENS):
        yield part, chunk.codes[ends[part.start] : ends[part.stop]]


def word_counts(chunks: DataFrame) -> DataFrame:
    """Every word of all texts with its count."""
    words = chunks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select(F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    return written(words.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")


def frequent_words(counts: DataFrame) -> list[str]:
    """The WORDS most frequent words."""
    return [r["word"] for r in counts.orderBy(F.col("n").desc(), "word").limit(WORDS).collect()]


def log_totals(counts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """The log of each bucket's tokens."""
    bucket = F.crc32(F.col("word").cast("binary")) % (SIZE - 1 - WORDS)
    rare = counts.filter(~F.col("word").isin(list(vocabulary.known)))
    totals = np.ones(SIZE - 1 - WORDS)
    for r in rare.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("total")).collect():
        totals[r["bucket"]] = r["total"]
    return np.log(totals)


def log_counts(chunks: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """run, place, log_count: for every word of a run that is in a bucket and occurs more than once in the corpus, the log of its count."""
    repeated = counts.filter((F.col("n") > 1) & ~F.col("word").isin(list(vocabulary.known)))
    words = chunks.select(F.col("chunk").alias("run"), F.posexplode("words").alias("place", "word"))
    return words.join(repeated, "word").select("run", "place", F.log("n").alias("log_count"))


OFFSETS = np.array([k for k in range(-SIDE, SIDE + 1) if k])


class Windows:
    """The tokens around each position of texts that lie one behind the other; 0 beyond the ends of a text."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids = ids
        self.owners = np.repeat(np.arange(len(lengths)), lengths)
        self.within = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # SIDE zeros stand before, between and behind the texts.
        self.places = np.arange(len(ids)) + SIDE * (self.owners + 1)
        self.padded = np.zeros(len(ids) + SIDE * (len(lengths) + 1), np.int64)
        self.padded[self.places] = ids

    def at(self, chosen) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours and tokens of the chosen positions."""
        return self.padded[self.places[chosen][:, None] + OFFSETS], self.ids[chosen]


class WindowNetwork:
    """Parameters with their forward and backward passes."""

    def __init__(self, values: np.ndarray | None = None):
        total = sum(int(np.prod(shape)) for shape in SHAPES.values())
        if values is None:
            values = np.random.default_rng(SEED).normal(0, 0.1, total)
        self.flat = np.asarray(values, np.float32).copy()
        self.parts, at = {}, 0
        for name, shape in SHAPES.items():
            size = int(np.prod(shape))
            self.parts[name] = self.flat[at : at + size].reshape(shape)
            at += size

    def _forward(self, around: np.ndarray, targets: np.ndarray):
        """Hidden values and both softmax layers: exponentials, their sums and the target's place; the members' rows are sorted by class.

        What an id adds to the tanh layer at an offset is one of SIZE rows: they are multiplied once, not for every position.
        """
        p = self.parts
        mixed = np.matmul(p["embedding"], self._mixes()).reshape(-1, HIDDEN)
        inputs = np.take(mixed, around[:, 0], axis=0)
        for k in range(1, 2 * SIDE):
            inputs += np.take(mixed, around[:, k] + k * SIZE, axis=0)
        inputs += p["mix_bias"]
        hidden = _tanh(inputs)
        group, member = targets // MEMBERS, targets % MEMBERS
        class_part = _exponentials(hidden @ p["classes"] + p["class_bias"]), group
        # One byte a class sorts in linear time.
        order = np.argsort(group.astype(np.uint8), kind="stable")
        inner = np.take(hidden, order, axis=0)
        logits = np.empty((len(targets), MEMBERS), np.float32)
        slices = _slices(group)
        for c, rows in slices:
            np.matmul(inner[rows], p["members"][c], out=logits[rows])
            logits[rows] += p["member_bias"][c]
        return hidden, class_part, order, inner, slices, (_exponentials(logits), np.take(member, order))

    def _mixes(self) -> np.ndarray:
        """The tanh layer's weights by offset."""
        return self.parts["mix"].reshape(2 * SIDE, EMBEDDING, HIDDEN)

    def log_probabilities(self, around: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Log-probability of each target between its neighbours."""
        _, classes, order, _, _, members = self._forward(around, targets)
        out = _log_of(classes)
        out[order] += _log_of(members)
        return out

    def gradients(self, around: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-probability and its gradient."""
        p, n = self.parts, len(targets)
        hidden, classes, order, inner, slices, members = self._forward(around, targets)
        loss = -float(_log_of(classes).sum() + _log_of(members).sum())
        d_class, d_member = _error_of(classes, n), _error_of(members, n)
        grads = {"classes": hidden.T @ d_class, "class_bias": _columns(d_class)}
        grads["members"], grads["member_bias"] = np.zeros(SHAPES["members"], np.float32), np.zeros(SHAPES["member_bias"], np.float32)
        d_inner = np.empty_like(inner)
        for c, rows in slices:
            d = d_member[rows]
            np.matmul(inner[rows].T, d, out=grads["members"][c])
            grads["member_bias"][c] = _columns(d)
            np.matmul(d, p["members"][c].T, out=d_inner[rows])
        d_hidden = d_class @ p["classes"].T
        back = np.empty_like(order)
        back[order] = np.arange(n)
        d_hidden += np.take(d_inner, back, axis=0)
        d_hidden *= 1 - hidden**2
        grads["mix_bias"] = _columns(d_hidden)
        # Sums for each id at each offset: embedding and mix get theirs from these SIZE rows an offset.
        sums = np.stack([_sums_of(around[:, k], d_hidden) for k in range(2 * SIDE)])
        grads["mix"] = np.matmul(p["embedding"].T, sums).reshape(SHAPES["mix"])
        grads["embedding"] = np.matmul(sums, self._mixes().transpose(0, 2, 1)).sum(0)
        return loss / n, grads


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of bounded logits and their sum in each row."""
    values = np.exp(np.clip(logits, -40, 40, out=logits), out=logits)
    return values, values @ np.ones(values.shape[1], np.float32)


def _log_of(layer) -> np.ndarray:
    (values, sums), at = layer
    chosen = np.take(values.reshape(-1), np.arange(len(at)) * values.shape[1] + at)
    return np.log(chosen.astype(np.float64) / sums)


def _error_of(layer, n: int) -> np.ndarray:
    """Gradient of the mean loss by the logits; overwrites the exponentials."""
    (values, sums), at = layer
    values *= (1 / (n * sums))[:, None]
    values.reshape(-1)[np.arange(len(at)) * values.shape[1] + at] -= 1 / n
    return values


def _sums_of(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each id."""
    ids = ids.astype(np.uint16)
    places = np.argsort(ids, kind="stable")
    found = ids[places]
    starts = np.flatnonzero(np.diff(found.astype(np.int64), prepend=-1))
    sums = np.zeros((SIZE, rows.shape[1]), np.float32)
    sums[found[starts]] = np.add.reduceat(np.take(rows, places, axis=0), starts, axis=0)
    return sums


def _columns(values: np.ndarray) -> np.ndarray:
    return np.ones(len(values), np.float32) @ values


def _tanh(x: np.ndarray) -> np.ndarray:
    """The hyperbolic tangent by one exponential."""
    x = np.exp(np.clip(2 * x, -30, 30, out=x), out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1
    return x


def _slices(group: np.ndarray) -> list[tuple[int, slice]]:
    """Rows of each class that occurs, when rows are sorted by class."""
    counts = np.bincount(group, minlength=CLASSES)
    ends = np.cumsum(counts)
    return [(int(c), slice(int(ends[c] - counts[c]), int(ends[c]))) for c in np.flatnonzero(counts)]


def _blocks(rows: Iterator[tuple[np.ndarray, np.ndarray]], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0
    for around, targets in rows:
        held.append((around, targets))
        count += len(targets)
        if count >= size:
            a, t = (np.concatenate(x) for x in zip(*held))
            whole_blocks = count - count % size
            for k in range(0, whole_blocks, size):
                yield a[k : k + size], t[k : k + size]
            held, count = [(a[whole_blocks:], t[whole_blocks:])], count - whole_blocks
    if count:
        yield tuple(np.concatenate(x) for x in zip(*held))


def train_on(network: WindowNetwork, rows: Iterator[tuple[np.ndarray, np.ndarray]]) -> int:
    """Adagrad over blocks of positions; the number of positions."""
    squares = {name: np.full(shape, 1e-2 / TRAIN_BATCH, np.float32) for name, shape in SHAPES.items()}
    seen = 0
    for around, targets in _blocks(rows, TRAIN_BATCH):
        _, grads = network.gradients(around, targets)
        for name, gradient in grads.items():
            squares[name] += gradient**2
            network.parts[name] -= RATE * gradient / np.sqrt(squares[name])
        seen += len(targets)
    return seen


def _trainer(shared, round_: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = WindowNetwork(shared.value)

        def masked() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                texts = list(map(read_ids, batch.column(1).to_pylist()))
                if any(map(len, texts)):
                    found = Windows(np.concatenate(texts), np.array([len(t) for t in texts]))
                    phases = batch.column(0).to_numpy()[found.owners]
                    yield found.at(np.flatnonzero((found.within - phases - round_) % ROUNDS == 0))

        seen = train_on(network, masked())
        if seen:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(network.flat)), pa.int32()),
                    pa.array(network.flat.astype(np.float64) * seen, pa.float64()),
                    pa.array(np.full(len(network.flat), float(seen)), pa.float64()),
                ],
                ["place", "value", "weight"],
            )

    return train


def read_ids(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, np.uint16).astype(np.int64)


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Runs to phase and ids (two bytes each) of every document."""
    for batch in batches:
        for chunk in read_chunks(batch):
            id_of = vocabulary.ids_of(chunk.words).astype(np.uint16)
            for part, codes in parts(chunk):
                ends = np.concatenate([[0], 2 * np.cumsum(chunk.lengths[part])]).astype(np.int32)
                buffers = [None, pa.py_buffer(ends), pa.py_buffer(id_of[codes].tobytes())]
                texts = pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, buffers)
                yield pa.RecordBatch.from_arrays([pa.array(chunk.phases[part], pa.int32()), texts], ["phase", "ids"])


def trained(chunks: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Network parameters from the runs of all texts."""
    context, values = chunks.sparkSession.sparkContext, WindowNetwork().flat
    known = context.broadcast(vocabulary)
    for round_ in range(ROUNDS):
        train = _trainer(context.broadcast(values), round_)

        def task(batches: Iterator[pa.RecordBatch], train=train) -> Iterator[pa.RecordBatch]:
            return train(encoded(batches, known.value))

        sums = chunks.drop("counts").mapInArrow(task, "place int, value double, weight double")
        means = sums.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value")).toPandas()
        if len(means):
            values = np.zeros(len(values), np.float32)
            values[means["place"].to_numpy()] = means["value"].to_numpy()
    return values


def learn(documents: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and network parameters from all texts."""
    chunks = chunked(documents)
    vocabulary = Vocabulary(frequent_words(word_counts(chunks)))
    return vocabulary, trained(chunks, vocabulary)


def text_sums(network: WindowNetwork, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Summed log-probability of each of the texts that lie one behind the other."""
    found = Windows(ids, lengths)
    logs = np.zeros(len(ids))
    for at in range(0, len(ids), SCORE_BATCH):
        block = slice(at, at + SCORE_BATCH)
        logs[block] = network.log_probabilities(*found.at(block))
    return np.bincount(found.owners, logs, minlength=len(lengths)).astype(np.float64)  # of nothing it counts in whole numbers


def score_ids(network: WindowNetwork, ids: list[np.ndarray]) -> list[float]:
    """Summed log-probability of each text."""
    return text_sums(network, np.concatenate([np.zeros(0, np.int64), *ids]), np.array([len(i) for i in ids], np.int64)).tolist()


def likelihoods(documents: DataFrame) -> DataFrame:
    """doc_id, n_tokens and log_likelihood of every document under a model learned from all of them."""
    chunks = chunked(documents)
    counts = word_counts(chunks)
    vocabulary = Vocabulary(frequent_words(counts))
    model = vocabulary, trained(chunks, vocabulary), log_totals(counts, vocabulary)
    shared = chunks.sparkSession.sparkContext.broadcast(model)

    def score(texts: pa.Table, logs: pa.Table) -> pa.Table:
        vocabulary, values, totals = shared.value
        (chunk,) = read_chunks(texts.combine_chunks())
        id_of = vocabulary.ids_of(chunk.words)
        share = np.zeros(len(id_of))
        share[logs["place"].to_numpy()] = logs["log_count"].to_numpy()
        rare = id_of > WORDS
        share[rare] -= totals[id_of[rare] - 1 - WORDS]
        network, sums = WindowNetwork(values), [np.zeros(0)]
        for part, codes in parts(chunk):
            lengths = chunk.lengths[part]
            inside = np.bincount(np.repeat(np.arange(len(lengths)), lengths), share[codes], minlength=len(lengths))
            sums.append(text_sums(network, id_of[codes], lengths) + inside)
        return pa.table({"doc_id": chunk.doc_ids, "n_tokens": pa.array(chunk.lengths), "log_likelihood": pa.array(np.concatenate(sums))})

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, log_likelihood double"
    return chunks.drop("counts").groupBy("chunk").cogroup(log_counts(chunks, counts, vocabulary).groupBy("run")).applyInArrow(score, schema)
