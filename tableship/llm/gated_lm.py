"""A gated recurrent language model and the score of whole documents under it.

Word counts of all training documents give the base: a smoothed unigram score. The model adds
order and context. Its output softmax is factored: first a class, then a word of the class. The
most frequent words fill classes of their own, whose members are chosen by the hidden state;
all other words belong to a class by their shape, within which smoothed counts decide, so
every word has a probability however rare it is. Gates, classes and words are trained by
truncated backpropagation in numpy: every task of a round trains a copy on its own documents,
and the copies are averaged, weighted by their tokens. The first round takes a fixed share of
all documents, the last one all of them.

A document is scored as a whole: it passes through windows, and the hidden state is carried
from each window to the next.

Counts of frequent words are broadcast; only words of more than one in ``frequent`` of all
tokens are, so that list is bounded. Rare words of a document are joined with their counts.

Null texts are empty: one end token. Repeated rows are separate rows. Without training
documents the counts are 0 and the model stays as it starts. Only the identifier is taken from
other columns, so their names are free.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableship.llm.common import slices, staged

#: The end of a text; no word is equal to it.
END = b"\n"
SHAPES = 50


@dataclass(frozen=True)
class Options:
    """``hidden``: size of the state; ``classes`` of ``members`` frequent words each;
    ``frequent``: share of all tokens from which on counts are broadcast; ``window``: tokens
    through which gradients flow; ``lanes``: documents side by side; ``held``: documents that
    are dealt to the lanes at once; ``first_share``: one in so many documents trains the first
    round; ``lane_tokens``: tokens of a lane in training, where there are enough for so many;
    ``rate``: step size; ``held_back``: one in so many training documents judges each round."""

    hidden: int = 16
    classes: int = 32
    members: int = 64
    frequent: int = 1 << 18
    window: int = 16
    lanes: int = 512
    held: int = 8192
    first_share: int = 16
    lane_tokens: int = 2048
    rate: float = 0.1
    held_back: int = 64


DEFAULTS = Options()


def words_of(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts of a batch, one after the other, and whose they are. Only A to Z
    and ASCII white space count; the ends of texts are not among them."""
    given = batch.column("text").cast(pa.string()).fill_null("")
    split = pc.ascii_split_whitespace(pc.ascii_lower(given))
    words = split.flatten().view(pa.binary())
    owner = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy())
    # White space at the start or the end of a text leaves an empty word there.
    held = pc.greater(pc.binary_length(words), 0)
    return words.filter(held), owner[held.to_numpy(zero_copy_only=False)]


def shape(word: bytes) -> int:
    """Class of a word that has no place of its own: its letters, its end and its length."""
    text = word.decode("utf-8", "replace")
    letters = 0
    if not word.isascii():
        found = set(text)
        letters = next((k + 1 for k, kind in enumerate(_KINDS) if found & kind), 4)
    return letters * 10 + _end(text[-1]) * 2 + (len(text) > 8)


_KINDS = (set("äöüß"), set("éèêàçœùâîôûë"), set("ñóíáú¿¡"))


def _end(last: str) -> int:
    end = 0 if last.isalpha() else 1 if last == "." else 2 if last == "," else 3
    return 4 if end == 3 and last.isdigit() else end


# The same by character, for those of one or two bytes; no letter of a kind has more.
_ENDS = np.array([_end(chr(c)) for c in range(2048)], np.int32)
_LETTERS = np.array(
    [next((k + 1 for k, kind in enumerate(_KINDS) if chr(c) in kind), 4) for c in range(2048)], np.int32
)


def shapes(words: list[bytes] | pa.Array) -> np.ndarray:
    """``shape`` of many words at once; one by one only where a character has three bytes or
    more, or is none."""
    if not len(words):
        return np.zeros(0, np.int32)
    words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
    sizes = pc.binary_length(words).to_numpy()
    _, offsets, flat = words.buffers()
    first = int(np.frombuffer(offsets, np.int32)[words.offset])
    flat = np.frombuffer(flat, np.uint8)[first : first + int(sizes.sum(dtype=np.int64))]
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - sizes
    if flat.max() < 0x80:
        return _ENDS[flat[ends - 1]] * 2 + (sizes > 8)
    follows = (flat & 0xC0) == 0x80
    leads = (flat >= 0xC2) & (flat < 0xE0)
    odd = (flat >= 0x80) & ~follows & ~leads
    odd[1:] |= follows[1:] != leads[:-1]
    odd = np.logical_or.reduceat(odd, starts) | follows[starts] | leads[ends - 1]
    character = flat.astype(np.int32)
    at = np.flatnonzero(leads[:-1])
    character[at + 1] = character[at] = ((character[at] & 0x1F) << 6) | (character[at + 1] & 0x3F)
    letters = np.full(len(flat), 5, np.int32)  # more than any kind
    letters[at] = _LETTERS[character[at]]
    letters = np.minimum.reduceat(letters, starts) % 5
    long = sizes - np.add.reduceat(follows, starts, dtype=np.int64) > 8
    kinds = letters * 10 + _ENDS[character[ends - 1] & 2047] * 2 + long
    for k in np.flatnonzero(odd).tolist():
        kinds[k] = shape(words[k].as_py())
    return kinds


# Counts


def word_counts(docs: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """``word``, ``n`` among the tokens of training documents and ``n_all`` of all tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, DEFAULTS.held):
            trains = batch.column("t").to_numpy(zero_copy_only=False).astype(bool)
            words, owner = words_of(batch)
            coded = words.dictionary_encode()
            codes, kinds = coded.indices.to_numpy(), len(coded.dictionary)
            counts = np.bincount(codes[trains[owner]], minlength=kinds)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())]),
                    pa.array(np.append(counts, trains.sum())),
                    pa.array(np.append(np.bincount(codes, minlength=kinds), len(trains))),
                ],
                ["word", "n", "n_all"],
            )

    rows = docs.select(F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("t"))
    counted = rows.mapInArrow(count, "word binary, n long, n_all long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))


@dataclass
class Lexicon:
    """What tasks know of words: for frequent ones a number, and by number the input symbol
    and the logarithm of count + 1; for classes by shape their denominators."""

    numbers: dict[bytes, int]
    symbols: np.ndarray
    logs: np.ndarray
    known: np.ndarray
    core: list[bytes]
    core_counts: np.ndarray
    shape_counts: np.ndarray
    shape_words: np.ndarray
    total: int
    distinct: int
    least: int


def lexicon(counted: DataFrame, options: Options = DEFAULTS) -> Lexicon:
    totals = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.count_if(F.col("n") > 0).alias("v"),
        F.coalesce(F.sum("n_all"), F.lit(0)).alias("all"),
    ).head()
    least = totals["all"] // options.frequent
    rows = counted.where(F.col("n_all") > least).collect()  # at most ``frequent`` rows
    rows.sort(key=lambda r: (-r["n"], bytes(r["word"])))
    places = options.classes * options.members
    core = [bytes(r["word"]) for r in rows[:places] if r["n"] > 0]
    if END not in core:
        core = [END, *core[: places - 1]]

    def by_shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).cast(pa.binary()), batch.column(1).to_numpy()
            other = pc.invert(pc.is_in(words, value_set=pa.array(core, pa.binary())))
            at = np.flatnonzero(other.to_numpy(zero_copy_only=False) & (n > 0))
            kinds, sums = shapes(words.take(pa.array(at))), np.zeros(SHAPES, np.int64)
            np.add.at(sums, kinds, n[at])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(SHAPES), pa.int32()),
                    pa.array(sums),
                    pa.array(np.bincount(kinds, minlength=SHAPES)),
                ],
                ["shape", "n", "v"],
            )

    summed = (
        counted.select("word", "n")
        .mapInArrow(by_shape, "shape int, n long, v long")
        .groupBy("shape")
        .agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
        .collect()
    )
    shape_counts, shape_words = np.zeros(SHAPES), np.zeros(SHAPES)
    for row in summed:
        shape_counts[row["shape"]], shape_words[row["shape"]] = row["n"], row["v"]
    symbol = {word: k for k, word in enumerate(core)}
    counts = {bytes(r["word"]): r["n"] for r in rows}
    numbers = {word: k for k, word in enumerate(counts)}
    if END not in numbers:
        numbers[END], counts[END] = len(numbers), 0
    return Lexicon(
        numbers,
        np.array([symbol.get(w, places + shape(w)) for w in numbers], np.int32),
        np.log10(np.array([counts[w] for w in numbers]) + 1.0),
        np.array([counts[w] > 0 for w in numbers], np.int64),
        core,
        np.array([counts.get(w, 0) for w in core], float),
        shape_counts,
        shape_words,
        totals["n"],
        totals["v"],
        least,
    )


# Model


class Model:
    """Parameters: input rows per symbol, recurrent weights, class and member outputs."""

    NAMES = ("inputs", "recurrent", "to_class", "class_bias", "to_member", "member_bias")

    def __init__(self, options: Options, arrays: list[np.ndarray]) -> None:
        self.options = options
        for name, array in zip(self.NAMES, arrays, strict=True):
            setattr(self, name, array)

    @classmethod
    def start(cls, lex: Lexicon, options: Options) -> Model:
        """Small random weights; biases say what the counts say."""
        rng = np.random.default_rng(7)
        h, places = options.hidden, options.classes * options.members
        mass = np.zeros(places)
        mass[: len(lex.core)] = lex.core_counts + 1
        member = np.full(places, -1e9)
        member[: len(lex.core)] = np.log(mass[: len(lex.core)] / mass.sum())
        groups = mass.reshape(options.classes, options.members).sum(axis=1)
        groups = np.concatenate([groups, lex.shape_counts + 1])
        arrays = [
            rng.normal(0, 0.1, (places + SHAPES, 3 * h)),
            rng.normal(0, 0.3 / np.sqrt(h), (h, 3 * h)),
            rng.normal(0, 0.1, (h, options.classes + SHAPES)),
            np.log(np.maximum(groups, 1e-3) / groups.sum()),
            rng.normal(0, 0.1, (options.classes, h, options.members)),
            member.reshape(options.classes, options.members),
        ]
        return cls(options, [a.astype(np.float32) for a in arrays])

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in self.NAMES]

    def dump(self) -> bytes:
        return np.concatenate([a.ravel() for a in self.arrays()]).astype("<f4").tobytes()

    def load(self, flat: np.ndarray) -> Model:
        arrays, at = [], 0
        for a in self.arrays():
            arrays.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Model(self.options, arrays)

    def windows(self, lanes: Lanes, size: int) -> Iterator[tuple]:
        """Per window the places of its symbols in the lanes, the number of lanes at each step,
        the symbols, the states before them, and what backpropagation needs. Inside, a state is
        a column, so that whole rows of lanes are computed at once."""
        h = self.options.hidden
        state = np.zeros((h, len(lanes.sizes)), np.float32)
        for start in range(0, int(lanes.sizes[0]), size):
            active, places = lanes.window(start, size)
            symbols = lanes.symbols[places]
            going = lanes.going[places].astype(np.float32)
            recurrent = np.ascontiguousarray(self.recurrent.T)
            before = np.empty((h, sum(active)), np.float32)
            steps, at = [], 0
            for t, n in enumerate(active):
                old = before[:, at : at + n]
                at += n
                np.multiply(state[:, :n], going[t, :n], out=old)  # a new document starts from nothing
                given = np.ascontiguousarray(self.inputs.take(symbols[t, :n], axis=0).T)
                carried = recurrent @ old
                gates = given[: 2 * h]
                gates += carried[: 2 * h]
                np.negative(gates, out=gates)
                np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                update, reset = gates[:h], gates[h:]
                new = given[2 * h :]
                new += reset * carried[2 * h :]
                np.tanh(new, out=new)
                steps.append((old, update, reset, new, carried[2 * h :]))
                state = old - new
                state *= update
                state += new
            flat = np.concatenate([places[t, :n] for t, n in enumerate(active)])
            yield flat, active, lanes.symbols[flat], before.T, going, steps

    def outputs(self, symbols: np.ndarray, before: np.ndarray, gradients=None):
        """Natural log probability of each symbol given the state before it: of its class, and
        of the member for frequent words. Adds to ``gradients`` and returns the gradient of
        the states too where those are given."""
        o = self.options
        places = o.classes * o.members
        core = symbols < places
        group = np.where(core, symbols // o.members, o.classes + symbols - places)
        # A state is a column and ends with a 1, for the bias.
        given = np.ones((o.hidden + 1, len(symbols)), np.float32)
        given[:-1] = before.T
        learns = gradients is not None
        to_class = np.concatenate([self.to_class, self.class_bias[None]]).T.copy()
        found = np.zeros_like(to_class) if learns else None
        logs = np.empty(len(symbols), np.float32)
        back = np.empty((o.hidden, len(symbols)), np.float32) if learns else None
        for start in range(0, len(symbols), _COLUMNS):
            part = slice(start, start + _COLUMNS)
            logs[part], passed = _softmax(to_class, given[:, part], group[part], found)
            if learns:
                back[:, part] = passed
        if learns:
            gradients[2] += found[:, :-1].T
            gradients[3] += found[:, -1]
        order = np.flatnonzero(core)
        order = order[_sorting(group[order], o.classes)]
        if not len(order):
            return logs, back.T if learns else None
        bounds = np.searchsorted(group[order], np.arange(o.classes + 1))
        member = symbols[order] % o.members
        states = given.take(order, axis=1)
        to_member = np.concatenate([self.to_member, self.member_bias[:, None]], axis=1)
        to_member = to_member.transpose(0, 2, 1).copy()
        found = np.zeros_like(to_member) if learns else [None] * o.classes
        own = np.empty(len(order), np.float32)
        for g in range(o.classes):
            at = slice(bounds[g], bounds[g + 1])
            if bounds[g] < bounds[g + 1]:
                own[at], passed = _softmax(to_member[g], states[:, at], member[at], found[g])
                if learns:
                    states[:-1, at] = passed
        logs[order] += own
        if not learns:
            return logs, None
        back[:, order] += states[:-1]
        gradients[4] += found[:, :, :-1].transpose(0, 2, 1)
        gradients[5] += found[:, :, -1]
        return logs, back.T

    def train(self, lanes: Lanes, squares: list[np.ndarray]) -> None:
        """One pass over the lanes; a step per window, by the share of a whole window's tokens
        that it has, so that a few lanes that go on longer do not take whole steps."""
        h = self.options.hidden
        full = self.options.window * len(lanes.sizes)
        for _, active, symbols, before, going, steps in self.windows(lanes, self.options.window):
            gradients = [None, *(np.zeros_like(a) for a in self.arrays()[1:])]
            _, back = self.outputs(symbols, before, gradients)
            # Of the new state, the gates, and the new state behind its gate, one below the other.
            # (Rows a power of two apart would share places in the cache.)
            given = np.empty((4 * h, len(symbols) + 16), np.float32)[:, :-16]
            ends = np.cumsum(active)
            later = np.zeros((h, active[0]), np.float32)
            for t in range(len(active) - 1, -1, -1):
                n = active[t]
                at = slice(ends[t] - n, ends[t])
                old, update, reset, new, carried = steps[t]
                d_new, d_update, d_reset, behind = given[:, at].reshape(4, h, n, copy=False)
                d = later[:, :n]
                kept = 1 - update
                np.multiply(d, kept, out=d_new)
                d_new *= 1 - new * new
                np.multiply(d, old - new, out=d_update)
                d_update *= update
                d_update *= kept
                np.multiply(d_new, reset, out=behind)
                np.multiply(behind, carried, out=d_reset)
                d_reset *= 1 - reset
                d *= update
                d += self.recurrent @ given[h:, at]
                d += back.T[:, at]
                d *= going[t, :n]
            gradients[1] += before.T @ given[h:].T
            # Only the rows of symbols that occurred change.
            order = _sorting(symbols, len(self.inputs))
            ordered = symbols[order]
            first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            sums = np.add.reduceat(given[: 3 * h].take(order, axis=1), first, axis=1).T
            gradients[0] = np.concatenate([sums[:, h:], sums[:, :h]], axis=1)
            kinds = ordered[first]
            for k, (array, gradient) in enumerate(zip(self.arrays(), gradients, strict=True)):
                gradient /= full
                rows = kinds if k == 0 else slice(None)
                square = squares[k][rows] + gradient * gradient
                squares[k][rows] = square
                array[rows] -= self.options.rate * gradient / (np.sqrt(square) + 1e-6)

    def log10s(self, lanes: Lanes) -> np.ndarray:
        """Log10 probability of the symbols of each document of the lanes."""
        sums = np.zeros(lanes.documents)
        for places, _, symbols, before, _, _ in self.windows(lanes, 4 * self.options.window):
            logs, _ = self.outputs(symbols, before)
            sums += np.bincount(lanes.owner[places], weights=logs, minlength=len(sums))
        return sums / np.log(10)


@dataclass
class Lanes:
    """Documents dealt to lanes and set one after the other. By token, lane after lane: the
    symbol, whether a state goes on, and whose symbol it is; by lane: where it starts and its
    size. Steps by lanes are laid out for one window at a time, so memory is that of the
    tokens, however much longer than the others one lane is."""

    symbols: np.ndarray
    going: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    documents: int

    @classmethod
    def of(cls, documents: list[np.ndarray], count: int) -> Lanes:
        """The longest documents first, each to the shortest lane, so lanes end together."""
        heap = [(0, k) for k in range(max(1, min(count, len(documents))))]
        dealt: list[list[int]] = [[] for _ in heap]
        for k in sorted(range(len(documents)), key=lambda k: -len(documents[k])):
            size, lane = heap[0]
            dealt[lane].append(k)
            heapq.heapreplace(heap, (size + len(documents[k]), lane))
        dealt.sort(key=lambda lane: -sum(len(documents[k]) for k in lane))
        sizes = [sum(len(documents[k]) for k in lane) for lane in dealt]
        order = [k for lane in dealt for k in lane]
        lengths = [len(documents[k]) for k in order]
        symbols = np.concatenate([np.zeros(0, np.int32), *(documents[k] for k in order)])
        going = np.ones(len(symbols), bool)
        going[[at for at, n in zip(np.cumsum([0, *lengths]).tolist(), lengths, strict=False) if n]] = False
        owner = np.repeat(np.array(order, np.int32), lengths)
        starts = np.cumsum([0, *sizes[:-1]])
        return cls(symbols, going, owner, starts, np.array(sizes), len(documents))

    def window(self, start: int, size: int) -> tuple[list[int], np.ndarray]:
        """The number of lanes at each step, and the places by step and lane; those of a lane
        that has ended are its last one."""
        steps = np.arange(start, min(start + size, self.sizes[0]))
        active = len(self.sizes) - np.searchsorted(self.sizes[::-1], steps, "right")
        within = np.minimum(steps[:, None], self.sizes[: active[0]] - 1)
        return active.tolist(), self.starts[: active[0]] + within

    @property
    def active(self) -> list[int]:
        return self.window(0, int(self.sizes[0]))[0] if self.sizes[0] else []


def segments(documents: list[np.ndarray], options: Options) -> tuple[list[np.ndarray], int]:
    """Documents cut so that lanes end together, and the number of lanes: as many as get
    ``lane_tokens`` each. In training the state begins anew at a cut; scores have no cuts."""
    total = sum(map(len, documents))
    lanes = max(16, min(options.lanes, total // options.lane_tokens))
    size = max(4 * options.window, -(-total // lanes))
    return [d[k : k + size] for d in documents for k in range(0, len(d), size)], lanes


#: States that pass through a softmax at once, so that their shares stay in the cache.
_COLUMNS = 2000


def _softmax(weights: np.ndarray, given: np.ndarray, chosen: np.ndarray, gradient=None):
    """Natural log probability of the ``chosen`` row of ``weights`` for each column of ``given``.
    Adds to ``gradient`` and returns the gradient of the states too where that is given.
    Logarithms of shares are small; only if they ever are not, the largest of each column is
    taken off first."""
    shares = weights @ given
    columns = np.arange(len(chosen))
    logs = shares[chosen, columns]
    np.exp(shares, out=shares)
    sums = shares.sum(axis=0)
    if not np.isfinite(sums).all() or not sums.all():
        shares = weights @ given
        largest = shares.max(axis=0)
        logs -= largest
        shares -= largest
        np.exp(shares, out=shares)
        sums = shares.sum(axis=0)
    logs -= np.log(sums)
    if gradient is None:
        return logs, None
    shares *= 1 / sums
    shares[chosen, columns] -= 1
    gradient += shares @ given.T
    return logs, weights[:, :-1].T @ shares


def _sorting(numbers: np.ndarray, limit: int) -> np.ndarray:
    """Places of ``numbers`` below ``limit`` in order; small types are sorted by their digits."""
    return np.argsort(numbers.astype(np.min_scalar_type(limit)), kind="stable")


def train(rows: DataFrame, lex: Lexicon, options: Options = DEFAULTS) -> Model:
    """Model from two rounds over the training documents of ``rows``, which have ``symbols``,
    ``trains`` and ``share`` and ``judge`` by hashes of the text. Copies are summed in tasks
    first; a few rows of parameters reach the driver. The documents to ``judge``, one in
    ``held_back``, are not trained on: a round after which these are less likely is not kept."""
    model = Model.start(lex, options)
    spark = rows.sparkSession
    rows = rows.where("trains")
    judges, rows = rows.where("judge"), rows.where("NOT judge")
    for part in (rows.where("share = 0"), rows):
        given = spark.sparkContext.broadcast(model)

        def fit(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            own = given.value.load(np.frombuffer(given.value.dump(), "<f4"))
            squares = [np.full_like(a, 1e-6) for a in own.arrays()]
            tokens = 0
            for batch in slices(batches, options.held):
                found = _unpacked(batch, options)
                tokens += sum(map(len, found))
                own.train(Lanes.of(*segments(found, options)), squares)
            if tokens:
                yield _weighted([np.frombuffer(own.dump(), "<f4")], [tokens])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, weight = None, 0
            for batch in batches:
                for raw, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    scaled = np.frombuffer(raw, "<f4").astype(float) * tokens
                    total = scaled if total is None else total + scaled
                    weight += tokens
            if weight:
                yield _weighted([total / weight], [weight])

        kind = "parameters binary, tokens long"
        copies = part.select("symbols").mapInArrow(fit, kind).repartition(8).mapInArrow(add, kind)
        found = copies.collect()  # at most 8 rows
        if found:
            flat = [np.frombuffer(r["parameters"], "<f4") for r in found]
            trained = model.load(np.average(flat, axis=0, weights=[r["tokens"] for r in found]))
            before, after = _likelihoods(judges, [model, trained])
            model = trained if after >= before else model
    return model


def _likelihoods(rows: DataFrame, models: list[Model]) -> list[float]:
    """Log10 probability of all texts under each model; 0 for no texts."""
    given = rows.sparkSession.sparkContext.broadcast(models)
    options = models[0].options

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, options.held):
            lanes = Lanes.of(_unpacked(batch, options), options.lanes)
            sums = [float(model.log10s(lanes).sum()) for model in given.value]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.float64())], ["model", "sum"]
            )

    judged = rows.select("symbols").mapInArrow(judge, "model int, sum double")
    sums = {r["model"]: r["total"] for r in judged.groupBy("model").agg(F.sum("sum").alias("total")).collect()}
    return [sums.get(k, 0.0) for k in range(len(models))]


def _weighted(flat: list[np.ndarray], tokens: list[int]) -> pa.RecordBatch:
    raw = [f.astype("<f4").tobytes() for f in flat]
    return pa.RecordBatch.from_arrays(
        [pa.array(raw, pa.binary()), pa.array(tokens, pa.int64())], ["parameters", "tokens"]
    )


# Scores


def score(
    docs: DataFrame,
    training: Column,
    id_column: str = "doc_id",
    text: str = "text",
    options: Options = DEFAULTS,
) -> DataFrame:
    """``id``, ``trains`` (whether the row was learned from), ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` per document. ``training`` is a condition on
    the columns of ``docs``."""
    spark = docs.sparkSession
    training = F.coalesce(training, F.lit(False))
    counted = staged(word_counts(docs, training, text), "word-counts")
    lex = lexicon(counted, options)
    words = spark.sparkContext.broadcast(lex)
    base = np.log10(lex.total + lex.distinct + 1.0)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        key = (context.partitionId() if context else 0) << 40
        for batch in slices(batches, options.held // 4 or 1):  # words are held beside texts
            yield _looked_up(batch, key, words.value, options, base)
            key += batch.num_rows

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text).alias("text"), training.alias("trains")
    ).withColumns(
        {
            "share": F.pmod(F.xxhash64("text"), F.lit(options.first_share)),
            "judge": F.pmod(F.xxhash64("text", F.lit("judge")), F.lit(options.held_back)) == 0,
        }
    )
    partial = rows.mapInArrow(
        look,
        f"key long, id {kind}, trains boolean, share long, judge boolean, symbols binary, "
        "n_tokens long, n_known long, base double, outside double, "
        "rare array<struct<word:binary,n:long>>",
    )
    # Written once: keys of rows are those of the files, whatever is computed again later, and
    # training and scores need no texts.
    partial = staged(partial, "looked-up")
    model = spark.sparkContext.broadcast(train(partial, lex, options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, options.held):
            scores = batch.column("outside").to_numpy()
            scores = scores + model.value.log10s(Lanes.of(_unpacked(batch, options), options.lanes))
            kept = batch.drop_columns(["symbols", "outside"])
            yield kept.append_column("model", pa.array(scores, pa.float64()))

    names = ["key", "id", "trains", "n_tokens", "n_known", "base", "symbols", "outside"]
    scored = partial.select(*names).mapInArrow(
        run,
        f"key long, id {kind}, trains boolean, n_tokens long, n_known long, base double, model double",
    )
    scored = staged(scored, "partial-scores")
    rare = partial.select("key", F.explode("rare").alias("r")).select(
        "key", F.col("r.word").alias("word"), F.col("r.n").alias("times")
    )
    counts = counted.where(F.col("n_all") <= lex.least).select("word", "n")
    joined = rare.join(counts, "word")
    sums = joined.groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("found"),
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(sums, "key", "left").select(
        "id",
        "trains",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )


def _unpacked(batch: pa.RecordBatch, options: Options) -> list[np.ndarray]:
    kind = _number(options)
    packed = batch.column("symbols").to_pylist()
    return [np.frombuffer(raw, kind).astype(np.int32) for raw in packed]


def _number(options: Options) -> str:
    return "<u2" if options.classes * options.members + SHAPES <= 1 << 16 else "<i4"


def _looked_up(batch: pa.RecordBatch, key: int, lex: Lexicon, options: Options, base: float):
    places = options.classes * options.members
    divisors = np.log10(lex.shape_counts + lex.shape_words + 1.0)
    words, owner = words_of(batch)
    n_tokens = np.bincount(owner, minlength=batch.num_rows) + 1
    ends = np.cumsum(n_tokens)
    starts = ends - n_tokens
    # Every text before a word has an end as well.
    at = np.arange(len(words)) + owner
    known = pc.index_in(words, value_set=pa.array(list(lex.numbers), pa.binary()))
    numbers = np.full(ends[-1], lex.numbers[END], np.int32)
    numbers[at] = known.fill_null(-1).to_numpy()
    frequent = numbers >= 0
    symbols = lex.symbols[numbers]
    missing = known.is_null()
    coded = words.filter(missing).dictionary_encode()
    codes, kinds = coded.indices.to_numpy(), max(1, len(coded.dictionary))
    symbols[~frequent] = places + shapes(coded.dictionary)[codes]
    logs = np.where(frequent, lex.logs[numbers], 0.0)
    outside = symbols >= places
    extra = np.zeros(len(symbols))
    extra[outside] = logs[outside] - divisors[symbols[outside] - places]
    packed = symbols.astype(_number(options))
    bounds = np.append(0, ends) * packed.itemsize
    # The rare words of each text, once each and with their number.
    pairs = owner[missing.to_numpy(zero_copy_only=False)] * kinds + codes
    pairs, times = np.unique(pairs, return_counts=True)
    rare = pa.StructArray.from_arrays(
        [coded.dictionary.take(pa.array(pairs % kinds)), pa.array(times)], ["word", "n"]
    )
    rare_ends = np.searchsorted(pairs // kinds, np.arange(batch.num_rows + 1))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(key, key + batch.num_rows), pa.int64()),
            batch.column("id"),
            batch.column("trains"),
            batch.column("share"),
            batch.column("judge"),
            pa.Array.from_buffers(
                pa.binary(),
                batch.num_rows,
                [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(packed)],
            ),
            pa.array(n_tokens),
            pa.array(np.add.reduceat(np.where(frequent, lex.known[numbers], 0), starts)),
            pa.array(np.add.reduceat(logs, starts) - n_tokens * base),
            pa.array(np.add.reduceat(extra, starts)),
            pa.ListArray.from_arrays(pa.array(rare_ends.astype(np.int32)), rare),
        ],
        [
            "key", "id", "trains", "share", "judge", "symbols",
            "n_tokens", "n_known", "base", "outside", "rare",
        ],
    )
