"""Language-model scores: a gated recurrent network in numpy with a class-factored softmax.

Counts of all training words are gathered by Spark. The most frequent ones (the document end always among them), whose
number grows with the root of the types seen, form classes of about the square root of their number; all other words
are one more class, in which a word's share is its add-one count. P(word) is P(class | state) times P(word | class,
state). The network reads a document word by word; its state starts at zero with the document and is carried across
all windows to its end, so a score is that of the whole text. The output biases start from the counts, so that the
untrained network is the add-one unigram model.

The texts are turned into ids once, in a written table that training and scoring read. Training is truncated
backpropagation in one pass over all training documents. A hash of the id deals each to one of ``ROUNDS`` rounds and,
in it, to a learner; a round's learners start from common weights, and their weights are averaged, weighted by tokens,
after it. A learner reads its documents in a fixed order, so the weights do not depend on how the input is split. There
are as many learners as the square root of the tokens asks for: both they and the steps of each grow with the corpus.

Counts of the at most ``HEAD`` most frequent words go to the tasks; rarer words meet their counts in a join.

Defined results: a null or empty text is the end token alone; texts of any length are scored whole; rows are scored one
by one, repeated or not; rows with a null doc_id are held out; of equally frequent words the one with the smaller bytes
is known first; without training documents nothing is known and N and V are 0; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeflow.llm.common import crc_bucket, cut, shared_path, slices

HEAD = 200_000
WORDS = 992
#: Words of the network for each root of the number of types.
PER_ROOT = 1
PER_CLASS = 32
WIDTH, HIDDEN = 16, 16
ROUNDS = 4
LEARNER_TOKENS = 1 << 18
GATHER_TOKENS = 3_000_000
CHUNK = 16_384
WINDOW, STREAMS, SCORE_STREAMS = 16, 384, 1024
#: Fewer streams are taken, down to the least, where a pass would have fewer steps than these.
STEPS, LEAST_STREAMS = 200, 16
RATE, WARM_STEPS = 0.015, 20
#: Bytes of text whose words are looked up or counted at once.
PIECE = 1 << 23
END = b""


def words_of(text: bytes) -> list[bytes]:
    """The tokens of a text; the empty string is its end."""
    return [*text.lower().split(), END]


def _pieces(batches: Iterator, size: int) -> Iterator:
    """Views of the batches with at most ``size`` bytes of text each, or one row."""
    import pyarrow.compute as pc

    for batch in batches:
        ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)), 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _split(column) -> tuple:
    """All words of an Arrow column of texts one after the other, without the ends, and the row of each."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.cast(pa.string())))
    words = lists.flatten().view(pa.binary())
    rows = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    # Space at either side of a text leaves an empty string.
    real = pc.greater(pc.binary_length(words), 0)
    return words.filter(real), rows[real.to_numpy(zero_copy_only=False)]


def _partial_counts(batches: Iterator) -> Iterator:
    import pyarrow as pa
    import pyarrow.compute as pc

    for piece in _pieces(batches, 2 * PIECE):
        found = pc.value_counts(_split(piece.column("text"))[0])
        for word, n in ((found.field("values"), found.field("counts")), (pa.array([END], pa.binary()), pa.array([piece.num_rows], pa.int64()))):
            yield pa.RecordBatch.from_arrays([word, n], names=["word", "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """word, n over all ``docs``, combined in the tasks before anything is shuffled."""
    return docs.select("text").mapInArrow(_partial_counts, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = HEAD) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``most``: all words above a count that a small histogram gives."""
    level = F.floor(F.log2("n") * 16).cast("int")
    histogram = counts.where("n > 0").groupBy(level.alias("level")).count().collect()
    room, least = most, None
    for at, n in sorted(histogram, reverse=True):
        if n > room:
            break
        room, least = room - n, at
    if least is None:
        return []
    return sorted(((bytes(r["word"]), r["n"]) for r in counts.where(level >= least).collect()), key=lambda x: (-x[1], x[0]))


class Vocabulary:
    def __init__(self, head: list[tuple[bytes, int]], tokens: int, types: int):
        self.tokens, self.types = tokens, types
        ends = [w for w in head if w[0] == END]
        others = [w for w in head if w[0] != END]
        room = max(WORDS, PER_ROOT * math.isqrt(types)) - len(ends)
        chosen = sorted(ends + others[:room], key=lambda x: (-x[1], x[0]))
        self.per_class = max(PER_CLASS, math.isqrt(len(chosen)))
        #: All counted words, those of the network first.
        self.words = chosen + others[room:]
        self.classes = max(1, math.ceil(len(chosen) / self.per_class))
        self.rare_class = self.classes
        self.rare = len(chosen)
        self.rare_tokens = tokens - sum(n for _, n in chosen)
        self.rare_types = types - len(chosen)
        n = np.zeros(self.classes * self.per_class)
        n[: len(chosen)] = [c + 1 for _, c in chosen]
        n = n.reshape(-1, self.per_class)
        by_class = np.append(n.sum(axis=1), self.rare_tokens + self.rare_types + 1.0)
        self.class_bias = np.log(np.maximum(by_class, 1e-6) / by_class.sum()).astype(np.float32)
        inner = np.log(np.maximum(n, 1e-12) / np.maximum(n.sum(axis=1, keepdims=True), 1e-12))
        self.word_bias = np.where(n > 0, inner, -1e4).astype(np.float32)

    def without_words(self) -> Vocabulary:
        """What learning and scoring of ids need."""
        out = copy.copy(self)
        out.words = []
        return out

    def ids_kind(self) -> str:
        return "<u2" if self.rare < 1 << 16 else "<u4"

    def rare_norm(self) -> float:
        return math.log10(self.rare_tokens + self.rare_types + 1)

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids == self.rare, self.rare_class, ids // self.per_class)


def initial(v: Vocabulary) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(11)

    def matrix(*shape: int, scale: float) -> np.ndarray:
        return (rng.normal(size=shape) * scale).astype(np.float32)

    return {
        "embed": matrix(v.rare + 2, WIDTH, scale=0.3),
        "into": matrix(WIDTH, 3 * HIDDEN, scale=0.25),
        "bias": np.concatenate((np.full(HIDDEN, 1.0), np.zeros(2 * HIDDEN))).astype(np.float32),
        "over": matrix(HIDDEN, 3 * HIDDEN, scale=0.2),
        "class_w": np.zeros((HIDDEN, v.classes + 1), dtype=np.float32),
        "class_b": v.class_bias.copy(),
        "word_w": np.zeros((v.classes, HIDDEN, v.per_class), dtype=np.float32),
        "word_b": v.word_bias.copy(),
    }


class Streams:
    """Documents laid end to end in streams, the longest stream first.

    For each token, stream after stream: itself, its input, whether it starts a document, and whose it is.
    """

    def __init__(self, docs: list[np.ndarray], rare: int, most: int):
        n = max(1, min(most, len(docs)))
        ends, held = np.zeros(n, dtype=np.int64), [[] for _ in range(n)]
        for k in sorted(range(len(docs)), key=lambda k: -len(docs[k])):
            at = int(ends.argmin())
            held[at].append(k)
            ends[at] += len(docs[k])
        order = np.argsort(-ends, kind="stable")
        self.rare, self.sizes = rare, ends[order]
        self.offsets = np.cumsum(self.sizes) - self.sizes
        chain = [k for s in order.tolist() for k in held[s]]
        lengths, self.targets = np.array([len(docs[k]) for k in chain]), np.concatenate([docs[k] for k in chain])
        first = np.cumsum(lengths) - lengths
        self.starts, self.inputs = np.zeros(len(self.targets), dtype=bool), np.roll(self.targets, 1)
        self.starts[first], self.inputs[first] = True, rare + 1
        self.owner = np.repeat(chain, lengths)

    def windows(self, tokens: int, most_steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each window of about ``tokens`` places, by step and stream: inputs, starts, which are filled, and the filled ones' tokens."""
        at, last = 0, int(self.sizes[0])
        while at < last:
            n = int(np.searchsorted(-self.sizes, -at))
            steps = np.arange(at, min(at + max(1, min(most_steps, tokens // n)), last))[:, None]
            filled = steps < self.sizes[:n]
            places = np.where(filled, self.offsets[:n] + steps, 0)
            yield np.where(filled, self.inputs.take(places), self.rare + 1), self.starts.take(places) & filled, filled, _filled(places, filled)
            at += len(steps)


def _filled(x: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """What lies at the filled places, step by step."""
    return x.reshape(-1, *x.shape[2:]) if filled.all() else x[filled]


def _forward(p: dict, inputs: np.ndarray, starts: np.ndarray, h: np.ndarray, table: np.ndarray, keep: bool) -> tuple[np.ndarray, tuple]:
    """States after each step, carrying ``h`` in (its last row is the state to carry on).

    Inside, a unit's values for all streams lie side by side: (step, unit, stream). So they do in what is kept: the states
    before each step, the gates and the new content, and the products of the states.
    """
    steps, n = inputs.shape
    kept, two, over, table = steps if keep else 1, 2 * HIDDEN, p["over"].T.copy(), table.T.copy()
    # A gate is 1 / (1 + exp(-x)), which is (1 + tanh(x / 2)) / 2.
    over[:two] *= 0.5
    table[:two] *= 0.5
    states = np.empty((steps, HIDDEN, n), dtype=table.dtype)
    before, gates, products = (np.empty((kept, k * HIDDEN, n), dtype=table.dtype) for k in (1, 3, 3))
    begins, h = starts.any(axis=1).tolist(), h.T
    for t in range(steps):
        at = t if keep else 0
        if begins[t]:
            h = np.where(starts[t], table.dtype.type(0), h)
        if keep:
            before[t] = h
        x, u = table.take(inputs[t], axis=1), np.matmul(over, h, out=products[at])
        zr, new = gates[at, :two], gates[at, two:]
        np.tanh(np.add(x[:two], u[:two], out=zr), out=zr)
        zr *= 0.5
        zr += 0.5
        np.multiply(zr[HIDDEN:], u[two:], out=new)
        new += x[two:]
        np.tanh(new, out=new)
        out = np.subtract(h, new, out=states[t])
        out *= zr[:HIDDEN]
        out += new
        h = out
    return states.transpose(0, 2, 1), (before, gates, products)


def _softmax(x: np.ndarray, target: np.ndarray, slope: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log-probability of each row's target, and (with ``slope``) the probabilities less one at it. Overwrites ``x``.

    Rows are shifted by their largest entry only where one would leave the range of exp.
    """
    at = np.arange(len(x))
    log = x[at, target]
    with np.errstate(over="ignore"):
        powers = np.exp(x)
        total = powers @ np.ones(x.shape[1], dtype=x.dtype)
    if len(x) and not 1e-25 < total.min() <= total.max() < 1e30:
        shifted = x.max(axis=1)
        x -= shifted[:, None]
        powers = np.exp(x, out=x)
        total, log = powers.sum(axis=1), log - shifted
    log -= np.log(total)
    if not slope:
        return log, None
    powers *= np.reciprocal(total)[:, None]
    powers[at, target] -= 1
    return log, powers


def _order(x: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers; small ones are sorted by their digits."""
    return np.argsort(x.astype(np.uint16) if len(x) and x.max() < 1 << 16 else x, kind="stable")


def _present(x: np.ndarray, top: int) -> np.ndarray:
    """The distinct values of ``x``, whole numbers below ``top``, in order."""
    found = np.zeros(top, dtype=bool)
    found[x] = True
    return np.flatnonzero(found)


def _outputs(p: dict, v: Vocabulary, states: np.ndarray, targets: np.ndarray, grads: dict | None, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log-probability of each target (the rare class: of the class), and the gradient into the states.

    ``kinds``: the classes whose words' weights ``p`` and ``grads`` hold, in order. Biases are the weights of one more
    unit that is always 1. Targets are taken in order, so a class's lie side by side, and those of the rare class last.
    """
    order, slope = _order(targets), grads is not None
    words, wide = targets[order], np.ones((len(targets), HIDDEN + 1), dtype=states.dtype)
    wide[:, :HIDDEN] = states.take(order, axis=0)
    ends = np.append(np.searchsorted(words, np.minimum(np.arange(1, v.classes + 1) * v.per_class, v.rare)), len(words))
    sizes = np.diff(ends, prepend=0)
    kind, known = np.repeat(np.arange(v.classes + 1), sizes), int(ends[-2])
    by_class = np.concatenate((p["class_w"], p["class_b"][None]))
    logs, d = _softmax((by_class.T @ wide.T).T, kind, slope)
    into = None
    if grads is not None:
        g = wide.T @ d
        grads["class_w"] += g[:-1]
        grads["class_b"] += g[-1]
        into = d @ by_class[:-1].T
    by_word, held = np.concatenate((p["word_w"], p["word_b"][:, None]), axis=1), np.flatnonzero(sizes[:-1])
    runs = [*zip(np.searchsorted(kinds, held).tolist(), (ends - sizes)[held].tolist(), ends[held].tolist(), strict=True)]
    x = np.empty((known, v.per_class), dtype=wide.dtype)
    for k, a, b in runs:
        np.matmul(wide[a:b], by_word[k], out=x[a:b])
    log, d = _softmax(x, words[:known] - kind[:known] * v.per_class, slope)
    logs[:known] += log
    if grads is not None:
        g, inner = np.zeros_like(by_word), np.empty((known, HIDDEN), dtype=wide.dtype)
        for k, a, b in runs:
            np.matmul(wide[a:b].T, d[a:b], out=g[k])
            np.matmul(d[a:b], by_word[k, :-1].T, out=inner[a:b])
        grads["word_w"] += g[:, :-1]
        grads["word_b"] += g[:, -1]
        into[:known] += inner
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return logs.take(back), None if into is None else into.take(back, axis=0)


def _backward(p: dict, grads: dict, inputs: np.ndarray, starts: np.ndarray, tape: tuple, into: np.ndarray) -> None:
    """Through one window; nothing goes back beyond its first step, nor beyond a document's start."""
    before, gates, products = tape
    (steps, n), two = inputs.shape, 2 * HIDDEN
    z, r, new = gates[:, :HIDDEN], gates[:, HIDDEN:two], gates[:, two:]
    # What a unit of the state's gradient is worth: at the new content, at both gates, and at the product of the state that
    # goes into the new content. The first three lead to the inputs, the last three to the state before; none needs the steps' order.
    slopes, rest = np.empty((steps, 4, HIDDEN, n), dtype=into.dtype), 1 - z
    content, update, reset, product = (slopes[:, k] for k in range(4))
    np.multiply(new, new, out=content)
    np.subtract(1, content, out=content)
    content *= rest
    np.subtract(before, new, out=update)
    update *= z
    update *= rest
    np.multiply(content, r, out=product)
    np.multiply(product, products[:, two:], out=reset)
    reset *= 1 - r
    over, begins = p["over"], starts.any(axis=1).tolist()
    d, dh = np.empty_like(slopes), np.zeros((HIDDEN, n), dtype=into.dtype)
    for t in range(steps - 1, -1, -1):
        dh += into[t].T
        np.multiply(slopes[t], dh, out=d[t])
        dh *= z[t]
        dh += over @ d[t, 1:].reshape(-1, n)
        if begins[t]:
            dh[:, starts[t]] = 0
    into_x, into_u = (x.reshape(steps, 3 * HIDDEN, n).transpose(0, 2, 1) for x in (d[:, :3], d[:, 1:]))
    grads["over"] += (before @ into_u).sum(axis=0)
    wide = np.concatenate((p["embed"], np.ones_like(p["embed"][:, :1])), axis=1).take(inputs, axis=0)
    g = np.roll((wide.transpose(0, 2, 1) @ into_x).sum(axis=0), -HIDDEN, axis=1)
    grads["into"] += g[:-1]
    grads["bias"] += g[-1]
    flat = inputs.reshape(-1)
    order = _order(flat)
    ids, at = np.unique(flat[order], return_index=True)
    into_embed = into_x @ np.roll(p["into"], HIDDEN, axis=1).T
    grads["embed"][ids] += np.add.reduceat(into_embed.reshape(-1, WIDTH).take(order, axis=0), at)


def _table(p: dict) -> np.ndarray:
    return p["embed"] @ p["into"] + p["bias"]


class Adam:
    """First and second moments; a step touches only the rows that it is given."""

    def __init__(self, p: dict):
        self.steps = 0
        self.moments = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in p.items()}

    def step(self, p: dict, grads: dict, rows: dict, tokens: int, usual: int) -> None:
        """A window of fewer tokens than usual, as at the end of a long document, moves the weights less."""
        self.steps += 1
        scale, first, second = 1 / tokens, 1 / (1 - 0.9**self.steps), 1 / (1 - 0.999**self.steps)
        rate = RATE * min(1, self.steps / WARM_STEPS) * min(1, tokens / usual)
        for k, x in p.items():
            at, g = rows.get(k), grads[k] * scale
            m, w = self.moments[k] if at is None else (y[at] for y in self.moments[k])
            m += 0.1 * (g - m)
            g *= g
            g -= w
            g *= 0.001
            w += g
            move = np.sqrt(w * second)
            move += 1e-6
            np.divide(m, move, out=move)
            move *= rate * first
            if at is None:
                x -= move
            else:
                x[at] -= move
                for y, own in zip(self.moments[k], (m, w), strict=True):
                    y[at] = own


def learn(p: dict, v: Vocabulary, docs: list[np.ndarray], adam: Adam) -> int:
    """One pass of truncated backpropagation over ``docs``; returns the number of tokens."""
    most = max(LEAST_STREAMS, min(STREAMS, sum(map(len, docs)) // (WINDOW * STEPS)))
    streams, total = Streams(docs, v.rare, most), 0
    h, places = np.zeros((len(streams.sizes), HIDDEN), dtype=np.float32), np.zeros(v.rare + 2, dtype=np.int32)
    for inputs, starts, filled, own in streams.windows(WINDOW * most, 4 * WINDOW):
        t = streams.targets.take(own)
        words, kinds = _present(inputs, v.rare + 2), _present(v.class_of(t), v.classes + 1)
        places[words] = np.arange(len(words))
        near, kinds = places.take(inputs), kinds[kinds < v.classes]
        rows = {"embed": words, "word_w": kinds, "word_b": kinds}
        q = {k: x[rows[k]] if k in rows else x for k, x in p.items()}
        grads = {k: np.zeros_like(x) for k, x in q.items()}
        states, tape = _forward(q, near, starts, h[: inputs.shape[1]], _table(q), True)
        h = states[-1]
        into = np.zeros(states.shape, dtype=states.dtype)
        into[filled] = _outputs(q, v, _filled(states, filled), t, grads, kinds)[1]
        _backward(q, grads, near, starts, tape, into)
        adam.step(p, grads, rows, len(t), WINDOW * most)
        total += len(t)
    return total


def score_ids(p: dict, v: Vocabulary, docs: list[np.ndarray]) -> np.ndarray:
    """log10 of each document's probability, rare words as their class only."""
    out, kinds = np.zeros(len(docs)), np.arange(v.classes)
    streams, table = Streams(docs, v.rare, SCORE_STREAMS), _table(p)
    h = np.zeros((len(streams.sizes), HIDDEN), dtype=np.float32)
    for inputs, starts, filled, own in streams.windows(WINDOW * SCORE_STREAMS, WINDOW * SCORE_STREAMS):
        states, _ = _forward(p, inputs, starts, h[: inputs.shape[1]], table, False)
        h = states[-1]
        logs, _ = _outputs(p, v, _filled(states, filled), streams.targets.take(own), None, kinds)
        out += np.bincount(streams.owner.take(own), weights=logs.astype(np.float64), minlength=len(docs))
    return out / math.log(10)


_ENCODED = "row bigint, doc_id bigint, held_out boolean, round int, learner int, dealt bigint, n_tokens bigint, n_known bigint, logs double, rare_logs double, n_rare bigint, rare array<struct<word: binary, n: bigint>>, ids binary"


def _encode(v: Vocabulary) -> Callable[[Iterator], Iterator]:
    """The network's ids of each text, the sums of its words' log counts, and the words that have none in ``v``."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        row, kind = TaskContext.get().partitionId() << 40, v.ids_kind()
        words = [w for w, _ in v.words]
        index, end = pa.array(words, pa.binary()), words.index(END) if END in words else -1
        # Log counts of all words, and of those that the network doesn't know; the last is for words that are not here.
        plus = np.append(np.log10(np.array([n for _, n in v.words], dtype=np.float64) + 1), 0.0)
        rare_plus = np.where(np.arange(len(plus)) < v.rare, 0.0, plus)
        given = ["doc_id", "held_out", "round", "learner", "dealt"]
        for piece in _pieces(batches, PIECE):
            n, (found, rows) = piece.num_rows, _split(piece.column("text"))
            n_tokens = np.bincount(rows, minlength=n) + 1
            ends = np.cumsum(n_tokens)
            starts, inner = ends - n_tokens, np.ones(int(ends[-1]), dtype=bool)
            inner[ends - 1] = False
            at = np.full(len(inner), end, dtype=np.int32)
            at[inner] = pc.fill_null(pc.index_in(found, value_set=index), -1).to_numpy()
            net = np.where((at < 0) | (at >= v.rare), v.rare, at).astype(kind)
            data, bounds = net.tobytes(), (np.append(0, ends) * net.itemsize).tolist()
            ids = [data[a:b] for a, b in zip(bounds, bounds[1:])]
            sums = [np.add.reduceat(x, starts) for x in ((at >= 0).astype(np.int64), plus[at], rare_plus[at], (net == v.rare).astype(np.int64))]

            absent = at[inner] < 0
            missing = pa.table({"at": rows[absent], "word": found.filter(pa.array(absent))})
            missing = missing.group_by(["at", "word"], use_threads=False).aggregate([([], "count_all")]).sort_by("at").combine_chunks()
            own, word, times = (missing.column(c).combine_chunks() for c in ("at", "word", "count_all"))
            offsets = np.append(0, np.cumsum(np.bincount(own.to_numpy(), minlength=n)))
            rare = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([word, times], ["word", "n"]))
            made = [pa.array(n_tokens, pa.int64()), *(pa.array(x) for x in sums), rare, pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), *(piece.column(c) for c in given), *made],
                names=["row", *given, "n_tokens", "n_known", "logs", "rare_logs", "n_rare", "rare", "ids"],
            )
            row += n

    return run


def encode(docs: DataFrame, held_out: Column, v: Vocabulary) -> DataFrame:
    """``docs`` (doc_id, text) as a written table of ids, each row dealt to a round and a learner by a hash of its id."""
    path, dealt = shared_path(docs.sparkSession, "lm-ids"), F.xxhash64("doc_id", F.lit(5))
    round_ = F.pmod(F.shiftright(dealt, 32), F.lit(ROUNDS)).cast("int").alias("round")
    hashed = docs.select("doc_id", "text", held_out.alias("held_out"), round_, F.pmod(dealt, F.lit(learners(v.tokens))).cast("int").alias("learner"), dealt.alias("dealt"))
    hashed.mapInArrow(_encode(v), _ENCODED).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_ENCODED).parquet(path)


def _weights_out(pa, learner: int, p: dict, tokens: int) -> Iterator:
    flat = np.concatenate([x.reshape(-1) for x in p.values()]).astype("<f4")
    for k, a in enumerate(range(0, len(flat), CHUNK)):
        values = [[k], [learner], [tokens], [flat[a : a + CHUNK].tobytes()]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(values, kinds, strict=True)], names=["k", "learner", "tokens", "w"])


def _learn(p: dict, v: Vocabulary) -> Callable[[Iterator], Iterator]:
    """Trains each of the task's learners on its documents, which come in its order, and gives its weights in chunks."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind, at = v.ids_kind(), None
        own, adam, tokens, docs, held = None, None, 0, [], 0
        for batch in slices(batches):
            for learner, x in zip(batch.column("learner").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if learner != at or held >= GATHER_TOKENS:
                    if docs:
                        tokens += learn(own, v, docs, adam)
                        docs, held = [], 0
                    if learner != at:
                        if tokens:
                            yield from _weights_out(pa, at, own, tokens)
                        at, own, tokens = learner, {k: x.copy() for k, x in p.items()}, 0
                        adam = Adam(own)
                docs.append(np.frombuffer(x, dtype=kind).astype(np.int32))
                held += len(docs[-1])
        if docs:
            tokens += learn(own, v, docs, adam)
            yield from _weights_out(pa, at, own, tokens)

    return run


def _average(batches: Iterator) -> Iterator:
    """The mean of each chunk of weights, weighted by tokens; chunks come one after the other, by learner."""
    import pyarrow as pa

    at, total, tokens = None, None, 0

    def mean() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([(total / tokens).astype("<f4").tobytes()], pa.binary())], names=["k", "w"])

    for batch in slices(batches, 64):
        for r in batch.to_pylist():
            if r["k"] != at:
                if at is not None:
                    yield mean()
                at, total, tokens = r["k"], 0.0, 0
            total = total + np.frombuffer(r["w"], dtype="<f4").astype(np.float64) * r["tokens"]
            tokens += r["tokens"]
    if at is not None:
        yield mean()


def learners(tokens: int) -> int:
    return max(1, math.isqrt(tokens // LEARNER_TOKENS))


def train(encoded: DataFrame, v: Vocabulary) -> dict[str, np.ndarray]:
    """Weights after one pass over all training documents of ``encoded``."""
    p, bare, n = initial(v), v.without_words(), learners(v.tokens)
    for number in range(ROUNDS):
        own = encoded.where(~F.col("held_out") & (F.col("round") == number)).select("learner", "dealt", "doc_id", "ids")
        dealt = own.repartitionByRange(n, "learner").sortWithinPartitions("learner", "dealt", "doc_id", "ids").select("learner", "ids")
        given = dealt.mapInArrow(_learn(p, bare), "k int, learner int, tokens bigint, w binary")
        means = given.repartition("k").sortWithinPartitions("k", "learner").mapInArrow(_average, "k int, w binary").collect()
        if not means:
            continue
        flat, at = np.concatenate([np.frombuffer(r["w"], dtype="<f4") for r in sorted(means)]), 0
        for k, x in p.items():
            p[k] = flat[at : at + x.size].reshape(x.shape).copy()
            at += x.size
    return p


def _score(p: dict, v: Vocabulary, keep: list[str]) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = v.ids_kind()
        for batch in slices(batches, 4096):
            if batch.num_rows:
                score = score_ids(p, v, [np.frombuffer(x, dtype=kind).astype(np.int32) for x in batch.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score, pa.float64())], names=[*keep, "score"])

    return run


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = F.coalesce(crc_bucket("doc_id", 7) == 2, F.lit(True))
    path = shared_path(spark, "lm-counts")
    count_words(docs.where(~held_out)).write.parquet(path)
    counts = spark.read.schema("word binary, n bigint").parquet(path)
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = frequent(counts)
    if all(w != END for w, _ in head):
        head += [(END, r["n"]) for r in counts.where(F.length("word") == 0).collect()]
    v = Vocabulary(head, tokens, types)

    encoded = encode(docs, held_out, v)
    p = train(encoded, v)

    missing = encoded.select("row", F.explode("rare").alias("x")).select("row", "x.word", F.col("x.n").alias("times"))
    met = missing.join(counts, "word").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    keep = ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "rare_logs", "n_rare"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.select(*keep).schema)
    scored = encoded.select(*keep, "ids").mapInArrow(_score(p, v.without_words(), keep), f"{kinds}, score double")
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(cut(met), "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * math.log10(tokens + types + 1)).alias("base_score"),
        (F.col("score") + F.col("rare_logs") + more - F.col("n_rare") * v.rare_norm()).alias("score"),
    )
