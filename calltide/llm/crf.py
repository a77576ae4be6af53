"""A two-state linear-chain conditional random field over the lines of a document.

State 1 is content (a good line), state 0 boilerplate (a bad one). All sums run over many documents at once; messages are
log ratios of the two states, so nothing under- or overflows however long a document is.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltide.llm.common import keyed_hash, text_chunks

TRAIN_DOCS = 6_000  # labelled documents the model is fitted on, the first ones by hash
TRAIN_LINES = 64  # consecutive lines taken of each of them
JOINED = 3_000  # training sequences joined from good and bad documents
JOINED_LINES = 24  # consecutive lines that a joined sequence takes of a document
ROUNDS = 120
FOLDS, HELD_OUT = 5, 0

_SYMBOLS = b"#*$%&|<>"
_CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", _SYMBOLS, b"!?", b".,;:", b"|",
    b" \t\r\v\f", bytes(range(128, 256)),
)
FEATURES = 19


def _tables() -> np.ndarray:
    out = np.zeros((len(_CLASSES), 256), np.uint8)
    for k, members in enumerate(_CLASSES):
        out[k, np.frombuffer(members, np.uint8)] = 1
    return out


_TABLES = _tables()


@dataclass
class Lines:
    """The lines of some documents: features, weight (bytes that are not white space) and where each document starts."""

    features: np.ndarray
    weight: np.ndarray
    starts: np.ndarray
    counts: np.ndarray


def line_features(texts: list[str | None]) -> Lines:
    """Features of every line, from the line alone; NULL counts as an empty text, which is one empty line."""
    lines: list[str] = []
    counts = np.empty(len(texts), np.int64)
    repeated: list[bool] = []
    for i, text in enumerate(texts):
        own = (text or "").split("\n")
        counts[i] = len(own)
        lines += own
        if len(own) == 1:
            repeated.append(False)
        else:
            seen: set[str] = set()
            for line in own:
                repeated.append(line in seen)
                seen.add(line)
    raw = np.frombuffer("\n".join(lines).encode() + b"\n", np.uint8)
    ends = np.flatnonzero(raw == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = ends - begins
    held = np.empty((len(_CLASSES), len(lines)), np.float64)
    for k, table in enumerate(_TABLES):
        held[k] = np.add.reduceat(table[raw], begins, dtype=np.int32)
    upper, lower, digits, symbols, marks, stops, bars, blanks, wide = held
    size = np.maximum(n, 1)
    words = [line.split() for line in lines]
    n_words = np.array([len(w) for w in words], np.float64)
    distinct = np.array([len(set(w)) for w in words], np.float64)
    several = np.maximum(n_words, 1)
    variety = np.where(n_words >= 4, distinct / several, 1.0)
    loud = np.where(upper + lower >= 8, upper / np.maximum(upper + lower, 1), 0.0)
    # A root spreads small shares; thresholds let a linear model see a change of kind.
    f = [
        np.ones(len(lines)), np.log1p(n) / 8, loud, np.sqrt(symbols / size), np.sqrt(digits / size), np.sqrt(marks / size),
        np.sqrt(bars / size), np.sqrt(stops / size), wide / size, 1 - variety, np.clip(n / several / 12, 0, 2),
        np.array(repeated, np.float64), n_words == 0, n_words < 4, symbols / size > 0.02, marks / size > 0.03, loud > 0.5,
        variety < 0.5, bars / size > 0.01,
    ]
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    return Lines(np.column_stack(f).astype(np.float32), n - blanks, starts, counts)


def with_neighbours(x: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of a line, the line before and the line after; zeros beyond the ends of a document."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[starts[counts > 0]] = 0
    after[(starts + counts - 1)[counts > 0]] = 0
    return np.hstack([x, before, after])


@dataclass
class Chain:
    """Weights of state 1 against state 0 by feature, and the four transition weights [from, to]."""

    weights: np.ndarray
    moves: np.ndarray

    def _order(self, starts: np.ndarray, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        sizes = counts[order]
        longest = int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # documents with more than t lines
        return starts[order], sizes, active

    def messages(self, e: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log ratios at each line; ``e`` are the emission scores."""
        m = self.moves
        at, sizes, active = self._order(starts, counts)
        a, b = np.empty_like(e), np.zeros_like(e)
        for t, k in enumerate(active):
            i = at[:k] + t
            if t:
                p = a[i - 1]
                a[i] = e[i] + np.logaddexp(m[0, 1], p + m[1, 1]) - np.logaddexp(m[0, 0], p + m[1, 0])
            else:
                a[i] = e[i]
        for t in range(len(active) - 1, 0, -1):
            i = at[: active[t]] + t
            q = e[i] + b[i]
            b[i - 1] = np.logaddexp(m[1, 0], m[1, 1] + q) - np.logaddexp(m[0, 0], m[0, 1] + q)
        return a, b

    def marginals(self, lines: Lines) -> np.ndarray:
        """Probability of state 1 for each line."""
        e = with_neighbours(lines.features, lines.starts, lines.counts) @ self.weights
        a, b = self.messages(e, lines.starts, lines.counts)
        return 1 / (1 + np.exp(-np.clip(a + b, -700, 700)))

    def viterbi(self, lines: Lines) -> np.ndarray:
        """The likeliest sequence of states; state 1 wins ties."""
        m = self.moves
        e = with_neighbours(lines.features, lines.starts, lines.counts) @ self.weights
        at, sizes, active = self._order(lines.starts, lines.counts)
        d = np.empty_like(e)
        from_one = np.zeros((2, len(e)), bool)  # whether the best way into a state comes from state 1
        for t, k in enumerate(active):
            i = at[:k] + t
            if t:
                p = d[i - 1]
                from_one[0, i], from_one[1, i] = p + m[1, 0] >= m[0, 0], p + m[1, 1] >= m[0, 1]
                d[i] = e[i] + np.maximum(m[0, 1], p + m[1, 1]) - np.maximum(m[0, 0], p + m[1, 0])
            else:
                d[i] = e[i]
        states = np.zeros(len(e), np.int64)
        last = at + sizes - 1
        states[last] = d[last] >= 0
        for t in range(len(active) - 1, 0, -1):
            i = at[: active[t]] + t
            states[i - 1] = from_one[states[i], i]
        return states


def fit(x: np.ndarray, y: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, penalty: float = 1e-4) -> Chain:
    """Maximum likelihood by gradient steps with momentum of both moments; without rows every line is content."""
    if not len(y):
        return Chain(np.r_[1.0, np.zeros(3 * FEATURES - 1)], np.zeros((2, 2)))
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    x = with_neighbours(x, starts, counts).astype(np.float64)
    inner = np.ones(len(y), bool)
    inner[starts] = False
    later = np.flatnonzero(inner)
    # What a line says itself comes before what its neighbours and the moves say.
    own = np.arange(x.shape[1] + 4) < FEATURES
    penalties = np.where(own, penalty, 300 * penalty)
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w, m = np.zeros(x.shape[1]), np.zeros((2, 2))
    w[0] = np.log(prior / (1 - prior))
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (y[later - 1].astype(int), y[later].astype(int)), 1)
    first, second = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for step in range(1, rounds + 1):
        e = x @ w
        a, b = Chain(w, m).messages(e, starts, counts)
        p = 1 / (1 + np.exp(-np.clip(a + b, -700, 700)))
        left, right = a[later - 1], e[later] + b[later]
        joint = np.stack([np.zeros(len(later)) + m[0, 0], right + m[0, 1], left + m[1, 0], left + right + m[1, 1]])
        joint = np.exp(joint - joint.max(0)) if len(later) else joint
        joint = (joint / np.maximum(joint.sum(0), 1e-300)).sum(1) if len(later) else np.zeros(4)
        g = np.r_[x.T @ (p - y), joint - pairs.ravel()] / len(y) + penalties * np.r_[w, m.ravel()]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        move = 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, m = w - move[:-4], m - move[-4:].reshape(2, 2)
    return Chain(w, m)


def held_out(doc_id) -> object:
    """Whether a document is in the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES,
) -> Chain:
    """Fit the chain to labelled documents outside the held-out fold.

    Labels are those of documents. A document of its own teaches what its lines look like; where content begins and ends is
    learned from sequences joined from parts of good and of bad documents (``joined``), in which a line's label is known and
    changes. At most ``max_docs`` documents, the first by hash, and ``max_lines`` consecutive lines of each are used. NULL ids, texts
    and labels are left out; of several labels of a document the lowest holds.
    """
    picked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna()
        .where(~held_out(F.col("id")))
        .groupBy("id").agg(F.min("y").alias("y"))
        .orderBy(keyed_hash(F.col("id"), seed=11), "id").limit(max_docs)
    )
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where("text is not null")
    rows = rows.join(F.broadcast(picked), rows.doc == picked.id).select("doc", "y", "text")

    def run(batches):
        for part, texts in text_chunks(batches, "text"):
            found = line_features(texts)
            ids, ys = part.column(0).to_pylist(), part.column(1).to_pylist()
            for i in range(len(texts)):
                n = int(found.counts[i])
                since = found.starts[i] + (zlib.crc32(str(ids[i]).encode()) % (n - max_lines + 1) if n > max_lines else 0)
                own = found.features[since : since + min(n, max_lines)]
                yield pa.RecordBatch.from_pydict(
                    {"id": pa.array([ids[i]], pa.int64()), "y": pa.array([ys[i]], pa.int32()), "x": pa.array([own.tobytes()], pa.binary())}
                )

    # Copies of a document may share an id; the bound holds all the same.
    got = sorted(rows.mapInArrow(run, "id long, y int, x binary").limit(2 * max_docs).collect(), key=lambda r: (r.id, bytes(r.x)))
    if not got:
        return fit(np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0, np.int64))
    xs = [np.frombuffer(bytes(r.x), np.float32).reshape(-1, FEATURES) for r in got]
    ys = [np.full(len(x), float(r.y > 0)) for x, r in zip(xs, got)]
    more_x, more_y = joined(xs, [bool(r.y > 0) for r in got])
    xs, ys = xs + more_x, ys + more_y
    return fit(np.vstack(xs), np.concatenate(ys), np.array([len(x) for x in xs], np.int64))


def joined(xs: list[np.ndarray], good: list[bool], most: int = JOINED, seed: int = 3) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sequences of two or three parts, by turns of good and of bad documents, and the labels of their lines.

    As many as there are documents, ``most`` at most; documents and the lines taken of them are a seeded draw. Without good or without
    bad documents there are none.
    """
    rng = np.random.default_rng(seed)
    kinds = [[i for i, g in enumerate(good) if g == k] for k in (False, True)]
    if not kinds[0] or not kinds[1]:
        return [], []
    out_x, out_y = [], []
    for n in range(min(len(xs), most)):
        first, parts = n % 2, 2 + n // 2 % 2
        x, y = [], []
        for k in range(parts):
            label = (first + k) % 2
            own = xs[kinds[label][rng.integers(len(kinds[label]))]]
            size = min(len(own), JOINED_LINES, 1 + int(rng.exponential(3)))
            at = int(rng.integers(len(own) - size + 1))
            x.append(own[at : at + size])
            y.append(np.full(size, float(label)))
        out_x.append(np.vstack(x))
        out_y.append(np.concatenate(y))
    return out_x, out_y
