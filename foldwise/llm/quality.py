"""Quality classifier: random-indexing word vectors, pooled by document, and a two-layer network.

Words: runs of letters, of digits, or of other characters; white space separates.  Each falls into one
of ``BUCKETS`` by hash.  A bucket's index vector is random and sparse (+-1 in four places); its word
vector sums the index vectors of the two words on either side of each of its occurrences in the whole
corpus, is damped by signed square roots and scaled to length 1.  So the table has a fixed size, however
many words there are.  A document is the mean and the spread of its words' vectors, its own adjacent
likeness, and the shares of letters in upper case, of words by class and of distinct words.

The network (tanh, then a sigmoid) is fitted by Adam on a bounded sample of labelled rows; a fifth of
the sample sets the temperature that divides the logit.  All randomness has a fixed seed.

Null and empty texts pool to zeros and get the score of a text without words; ties cannot arise;
repeated rows score alike; without labels of both kinds every score is the share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.hashing import _BYTE, _DOWN, _UP, chunks, mix
from foldwise.llm.sample import labelled

#: Rows that labels are learned from; hashed words; length of a word vector; hidden units.
SAMPLE_ROWS, BUCKETS, WIDTH, HIDDEN = 20_000, 1 << 13, 32, 24
CHUNK, BLOCK = 1 << 19, 64
PREDICT_AT = 0.3
_rng = np.random.RandomState(7)
_PLACES = np.stack([_rng.permutation(WIDTH)[:4] for _ in range(BUCKETS)])
_SIGNS = (_rng.randint(0, 2, (BUCKETS, 4)) * 2 - 1).astype(np.float64)
_CLASS = np.full(256, 3, np.uint8)  # 0 white space, 1 letter, 2 digit, 3 other
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_CLASS[48:58] = 2
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, document index, class) of every word of a chunk."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    kind = _CLASS[raw]
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    worded = kind[starts] != 0
    starts, ends = starts[worded], ends[worded]
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _UP.upto(len(raw)), out=total[1:])
    h = mix((total[ends] - total[starts]) * _DOWN.upto(len(raw))[starts])
    return (h >> np.uint64(40)).astype(np.int64) % BUCKETS, np.searchsorted(offsets, starts, "right") - 1, kind[starts]


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The word vectors of all of ``docs``; a task sends one table of fixed size, and sums of them are
    made block by block, in any order (they are whole numbers)."""
    blocks = BUCKETS // BLOCK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * WIDTH)
        for batch in batches:
            for _, raw, offsets in chunks(batch, "text", CHUNK):
                b, doc, _ = buckets(raw, offsets)
                for apart in (1, 2):
                    if len(b) > apart:
                        same = doc[apart:] == doc[:-apart]
                        for own, other in ((b[apart:][same], b[:-apart][same]), (b[:-apart][same], b[apart:][same])):
                            pair, n = np.unique(own * BUCKETS + other, return_counts=True)
                            own, other = pair // BUCKETS, pair % BUCKETS
                            at = own[:, None] * WIDTH + _PLACES[other]
                            total += np.bincount(at.ravel(), (_SIGNS[other] * n[:, None]).ravel(), BUCKETS * WIDTH)
        if total.any():
            yield table({i: v for i, v in enumerate(total.reshape(blocks, -1)) if v.any()})

    def table(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.astype(np.int64).tobytes() for v in sums.values()], pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(data, np.int64)
        if sums:
            yield table(sums)

    kind = "block int, sums binary"
    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, kind)
    n = min(blocks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = np.zeros((blocks, BLOCK * WIDTH))
    for block, data in parts.repartition(n, "block").mapInArrow(add, kind).collect():  # BUCKETS x WIDTH numbers
        out[block] = np.frombuffer(data, np.int64)
    vectors = out.reshape(BUCKETS, WIDTH)
    vectors = np.sign(vectors) * np.sqrt(np.abs(vectors))
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


FEATURES = 2 * WIDTH + 9


def pool(vectors: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of features for each document of a chunk."""
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES), np.float32)
    b, doc, kind = buckets(raw, offsets)
    if not len(b):
        return out
    count = np.bincount(doc, minlength=n)
    has = count > 0
    begin = (np.cumsum(count) - count)[has]
    size = count[has][:, None].astype(np.float32)
    v = vectors[b]
    mean = np.add.reduceat(v, begin, axis=0) / size
    out[has, :WIDTH] = mean
    out[has, WIDTH : 2 * WIDTH] = np.sqrt(np.maximum(np.add.reduceat(v * v, begin, axis=0) / size - mean * mean, 0))
    near = np.zeros(len(b), np.float32)
    near[1:] = (v[1:] * v[:-1]).sum(1) * (doc[1:] == doc[:-1])
    same = np.zeros(len(b))
    same[1:] = (b[1:] == b[:-1]) & (doc[1:] == doc[:-1])
    pairs = np.unique(doc * BUCKETS + b) // BUCKETS
    upper = np.concatenate([[0], np.cumsum((raw >= 65) & (raw < 91))])[offsets]
    letters = np.concatenate([[0], np.cumsum(_CLASS[raw] == 1)])[offsets]
    x = out[:, 2 * WIDTH :]
    x[:, 0] = np.bincount(doc, near, n) / np.maximum(count, 1)
    x[:, 1] = np.bincount(doc, same, n) / np.maximum(count, 1)
    x[:, 2] = np.bincount(pairs, minlength=n) / np.maximum(count, 1)
    x[:, 3] = np.log1p(count)
    x[:, 4] = np.diff(upper) / np.maximum(np.diff(letters), 1)
    x[:, 5] = np.bincount(doc, kind == 2, n) / np.maximum(count, 1)
    x[:, 6] = np.bincount(doc, kind == 3, n) / np.maximum(count, 1)
    x[:, 7] = np.bincount(pairs, minlength=n) / np.sqrt(np.maximum(count, 1)) / 10
    x[:, 8] = np.log1p(np.diff(letters) / np.maximum(np.bincount(doc, kind == 1, n), 1))
    return out


@dataclass
class Network:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return (h @ self.w2 + self.b2) / self.temperature

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x.astype(np.float64)), -30, 30)))


def train(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, rounds: int = 60, batch: int = 256) -> Network:
    """Fits the network to features ``x`` and labels ``y``, a fifth kept for the temperature."""
    rng = np.random.RandomState(11)
    mean, scale = x.mean(0) if len(x) else np.zeros(FEATURES), np.maximum(x.std(0), 1e-3) if len(x) else np.ones(FEATURES)
    share = float(y.mean()) if len(y) else 0.0
    net = Network(vectors, mean, scale, rng.randn(FEATURES, HIDDEN) / np.sqrt(FEATURES), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    if len(np.unique(y)) < 2:
        return net
    order = rng.permutation(len(x))
    aside, own = order[: len(x) // 5], order[len(x) // 5 :]
    z = (x - mean) / scale
    net.w2 = rng.randn(HIDDEN) / np.sqrt(HIDDEN)
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    m, s, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for turn in range(rounds):
        rate = 3e-3 * (1 - turn / rounds) + 1e-4
        for at in range(0, len(own), batch):
            pick = own[at : at + batch]
            h = np.tanh(z[pick] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3][0], -30, 30)))
            d = (p - y[pick]) / len(pick)
            back = d[:, None] * params[2] * (1 - h * h)
            grads = [z[pick].T @ back + 1e-4 * params[0], back.sum(0), h.T @ d + 1e-4 * params[2], np.array([d.sum()])]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                params[i] -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.999**t)) + 1e-8)
        own = rng.permutation(own)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if len(aside):
        logit, target = net.logit(x[aside]), y[aside]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
        net.temperature = float(min(grid, key=lambda k: np.mean(np.logaddexp(0, logit / k) - target * logit / k)))
    return net


def fit(corpus: DataFrame, training: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Network:
    """Word vectors of ``corpus``; labels only of the documents in ``training``."""
    vectors = word_vectors(corpus)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text", CHUNK):
                x = pool(vectors, raw, offsets)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), part.column(1)], ["x", "label"])

    seen = sorted(labelled(training, labels, label, rows).select("text", "label").mapInArrow(run, "x binary, label int").collect())  # the sample's features
    x = np.array([np.frombuffer(r[0], np.float32) for r in seen], np.float64).reshape(-1, FEATURES)
    return train(vectors, x, np.array([r[1] != 0 for r in seen], float))


def score(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted added, columns of these names replaced."""
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([docs.schema[c] for c in rest] + T.StructType.fromDDL("score double, predicted int").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in chunks(batch, text, CHUNK):
                p = net.probability(pool(net.vectors, raw, offsets))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in rest), pa.array(p), pa.array((p >= PREDICT_AT).astype(np.int32))], [*rest, "score", "predicted"])

    return docs.select(*rest).mapInArrow(run, schema)
