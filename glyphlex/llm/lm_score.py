"""Document scores by masked pseudo-likelihood.

A small network reads the REACH words on both sides of a place, not the word
there, and gives every token of the vocabulary a probability.  A document's
score is the sum of the logarithms of the probabilities of all its tokens.

The vocabulary is the words of the corpus that occur OFTEN times or more, by
frequency, and buckets for all others.  It grows with the corpus up to DIGITS**3
tokens, so that the network stays small enough to be sent to every task.  A token is
three digits (a, b, c); the network gives P(a | context), P(b | a, context) and
P(c | a, b, context), so a full distribution costs three short softmaxes.  Every text
is read once in training: in each round the tasks train on their own share of
the texts, starting from the same weights, and Spark averages what they learnt.

The probability of a rare word is that of its bucket times P(word | bucket), from
the counts of all words of the corpus.  The counts are a Spark table that grows
with the corpus; it is joined by word digest and never held by one process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare
from .wordarrays import NOT_ALNUM, Words, text_blocks

#: Bounds of a digit (the vocabulary is its cube), buckets for rare words, occurrences
#: that make a word a token of its own, words read on each side, width of the network.
LEAST_DIGITS, DIGITS, BUCKETS, OFTEN, REACH, WIDTH = 8, 40, 128, 4, 4, 16
#: Rounds (the texts are dealt to them by digest), tokens of a step, and step size.
ROUNDS, BATCH, RATE = 2, 8192, 0.02
#: Tokens whose tables are worked on at once, so that they stay in a core's cache, and
#: the range of logits and of their sums in which exponentials need no common factor.
PART, HIGH, LOW = 1024, 60.0, 1e-20
#: Tokens that a training task gets at least, where there are more tasks than cores.
TASK_TOKENS = 16_000_000
#: Text bytes of a block of texts whose distinct rare words are looked up at once.
LOOKUP_BYTES = 4 << 20
_OFFSETS = [o for o in range(-REACH, REACH + 1) if o]


def shapes(digit: int) -> dict[str, tuple[int, ...]]:
    """The network's tables: words ("e", one row a token), a matrix for each offset
    ("m"), and for the three digits weights ("w"), biases ("b") and, by the digits
    before, factors of the context ("s")."""
    return {"e": (digit ** 3, WIDTH), "m": (2 * REACH, WIDTH, WIDTH), "c": (WIDTH,),
            "wa": (WIDTH, digit), "wb": (WIDTH, digit), "wc": (WIDTH, digit),
            "sb": (digit, WIDTH), "sc": (digit ** 2, WIDTH),
            "ba": (digit,), "bb": (digit, digit), "bc": (digit ** 2, digit)}


def digit_of(vector: np.ndarray) -> int:
    """The digit of a vector of weights, from its length."""
    return next(d for d in range(2, DIGITS + 1)
                if sum(int(np.prod(x)) for x in shapes(d).values()) == len(vector))


def parts(vector: np.ndarray, digit: int | None = None) -> dict[str, np.ndarray]:
    """Views of the vector by name."""
    out, at = {}, 0
    for k, s in shapes(digit or digit_of(vector)).items():
        n = int(np.prod(s))
        out[k] = vector[at:at + n].reshape(s)
        at += n
    return out


def initial(counts: np.ndarray) -> np.ndarray:
    """All weights as one vector, for a vocabulary with these ``counts`` of its
    tokens: without a context, a token has its share of all (each count one tenth more)."""
    digit = round(len(counts) ** (1 / 3))
    rng = np.random.default_rng(11)
    spread = {"e": 0.1, "m": 0.15, "wa": 0.1, "wb": 0.1, "wc": 0.1}
    vector = np.concatenate([(rng.standard_normal(s) * spread.get(k, 0)).reshape(-1)
                             for k, s in shapes(digit).items()]).astype(np.float32)
    w = parts(vector, digit)
    w["sb"][:] = w["sc"][:] = 1
    share = (counts + 0.1).reshape(digit, digit, digit)
    w["ba"][:] = np.log(share.sum(axis=(1, 2)))
    w["bb"][:] = np.log(share.sum(axis=2))
    w["bc"][:] = np.log(share).reshape(w["bc"].shape)
    for k in ("ba", "bb", "bc"):
        w[k] -= w[k].max(axis=-1, keepdims=True)
    return vector


def _softmax(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities up to a factor, their sums, and the logarithms of the sums of the
    exponentials.  The largest logit of each row is looked for only where the
    exponentials would leave the range of the numbers; ``x`` may be overwritten."""
    ones = np.ones(x.shape[1], x.dtype)
    if x.max(initial=0) <= HIGH:
        p = np.exp(x)
        s = p @ ones
        if s.min(initial=1) >= LOW:
            return p, s, np.log(s)
    top = x.max(axis=1, keepdims=True)
    p = np.exp(np.subtract(x, top, out=x), out=x)
    s = p @ ones
    return p, s, np.log(s) + top[:, 0]


def forward(w: dict, line: np.ndarray, place: np.ndarray, token: np.ndarray | None = None):
    """Log-probability of the token at each place of a line (or of ``token`` there) in
    its context, and what the slopes need.  Places lie REACH or more from the ends."""
    digit = len(w["ba"])
    token = line[place] if token is None else token
    e = w["e"].take(line, axis=0)
    near = _near(e)
    h = (near @ w["m"].reshape(-1, WIDTH)).take(place - REACH, axis=0)
    h += w["c"]
    np.tanh(h, out=h)
    ab = token // digit
    c = token - ab * digit
    a = ab // digit
    b = ab - a * digit
    hb, hc = h * w["sb"].take(a, axis=0), h * w["sc"].take(ab, axis=0)
    at = np.arange(len(token))
    log_p, ps = 0, []
    for own, x, v, bias in ((a, h, w["wa"], w["ba"]), (b, hb, w["wb"], w["bb"].take(a, axis=0)),
                            (c, hc, w["wc"], w["bc"].take(ab, axis=0))):
        logits = x @ v
        logits += bias
        own_logit = logits[at, own]
        p, total, log_sum = _softmax(logits)
        log_p = log_p + own_logit - log_sum
        ps.append((own, p, total))
    return log_p, (e, h, hb, hc, a, ab, ps)


def _near(x: np.ndarray) -> np.ndarray:
    """The rows around each row that has REACH rows on both sides, one after the other."""
    n = len(x) - 2 * REACH
    around = np.arange(n)[:, None] + (REACH + np.array(_OFFSETS))
    return x.take(around, axis=0).reshape(n, -1)


def _sums(key: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their rows of ``x``."""
    order = np.argsort(key.astype(np.uint16) if DIGITS ** 3 <= 1 << 16 else key, kind="stable")
    keys = key[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(x.take(order, axis=0), first, axis=0)


def _add_slopes(w: dict, line: np.ndarray, place: np.ndarray, state, d: dict, de: np.ndarray) -> None:
    """Add the slopes of the sum of the negative log-probabilities to ``d`` (all tables
    but the words') and to ``de`` (the rows of the words of the line, one a place)."""
    e, h, hb, hc, a, ab, ps = state
    at, ones = np.arange(len(place)), np.ones(len(place), h.dtype)
    for own, p, total in ps:
        p *= (1 / total)[:, None]
        p[at, own] -= 1
    pa_, pb, pc_ = (p for _, p, _ in ps)
    d["wa"] += h.T @ pa_
    d["ba"] += ones @ pa_
    d["wb"] += hb.T @ pb
    d["wc"] += hc.T @ pc_
    dhb, dhc = pb @ w["wb"].T, pc_ @ w["wc"].T
    for key, s, b, dx, p in ((a, "sb", "bb", dhb, pb), (ab, "sc", "bc", dhc, pc_)):
        rows, sums = _sums(key, np.concatenate([dx * h, p], axis=1))
        d[s][rows] += sums[:, :WIDTH]
        d[b][rows] += sums[:, WIDTH:]
    dhb *= w["sb"].take(a, axis=0)
    dhc *= w["sc"].take(ab, axis=0)
    dh = pa_ @ w["wa"].T
    dh += dhb
    dh += dhc
    dh *= 1 - h * h
    d["c"] += ones @ dh
    # a word reaches the places around it: the offsets the other way round
    dz = np.zeros((len(line) + 2 * REACH, WIDTH), h.dtype)
    dz[place + REACH] = dh
    dz = _near(dz)
    d["m"] += (e.T @ dz).reshape(WIDTH, -1, WIDTH).swapaxes(0, 1)[::-1]
    de += dz @ w["m"][::-1].swapaxes(1, 2).reshape(-1, WIDTH)


def slopes(w: dict, line: np.ndarray, place: np.ndarray, state=None) -> tuple[dict, np.ndarray, np.ndarray]:
    """Slope of the mean negative log-probability: by name for all tables but the
    words', and for these the tokens of the line and the slopes of their rows.
    Without the ``state`` of ``forward`` the places (in order) are taken PART by PART."""
    d = {k: np.zeros_like(x) for k, x in w.items() if k != "e"}
    de = np.zeros((len(line), WIDTH), w["e"].dtype)
    if state is not None:
        _add_slopes(w, line, place, state, d, de)
    else:
        for k in range(0, len(place), PART):
            own, at = _window(line, place[k:k + PART])
            first = place[k] - REACH
            _add_slopes(w, own, at, forward(w, own, at)[1], d, de[first:first + len(own)])
    rows, de = _sums(line, de)
    for x in (de, *d.values()):
        x /= len(place)
    return d, rows, de


def tokens_of(words: Words, keys: np.ndarray, rank: np.ndarray, digit: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all words of a block, with REACH zeros before, between and behind
    the texts, and the places of the words there.  ``keys``: sorted digests of the
    frequent words, ``rank``: their places by frequency."""
    rows = len(words.first) - 1
    place = np.arange(len(words.hash)) + REACH * (np.repeat(np.arange(rows), words.counts()) + 1)
    line = np.zeros(len(words.hash) + REACH * (rows + 1), np.int64)
    token = frequent(digit) + 1 + (words.hash % np.uint64(BUCKETS)).astype(np.int64)
    if len(keys):
        at = _places_in(keys, words.hash)
        token = np.where(keys.take(at) == words.hash, 1 + rank.take(at), token)
    line[place] = token
    return line, place


def _places_in(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Where each value is, or would be, among sorted digests (beyond them: the last
    place).  The first bits of a digest tell about where; digests that share them follow each other."""
    shift = np.uint64(64 - len(keys).bit_length() - 1)
    starts = np.zeros((1 << (64 - int(shift))) + 1, np.int64)
    np.cumsum(np.bincount((keys >> shift).astype(np.int64), minlength=len(starts) - 1), out=starts[1:])
    last = len(keys) - 1
    at = np.minimum(starts.take((x >> shift).astype(np.int64)), last)
    left = np.flatnonzero(keys.take(at) < x)
    for _ in range(8):
        at[left] = np.minimum(at[left] + 1, last)
        left = left[(keys.take(at[left]) < x[left]) & (at[left] < last)]
    if len(left):
        at[left] = np.minimum(np.searchsorted(keys, x[left]), last)
    return at


def frequent(digit: int) -> int:
    """Places for words of their own: all but the buckets and token 0, which stands
    beyond the ends of a text."""
    return digit ** 3 - BUCKETS - 1


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for _, offsets, raw in text_blocks(batch.column(0)):
            found.append(Words(offsets, raw, NOT_ALNUM).hash)
        if found:
            word, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): digest and number of every word of all texts, written once."""
    prepare(docs.sparkSession)
    found = docs.select(F.col(f"`{text}`")).mapInArrow(_count_words, "word long, n long")
    return materialize(found.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def vocabulary(words: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted digests and ranks of the words that get a token of their own, and the
    counts of all tokens, from a table of counts.  What reaches the driver are at most
    DIGITS**3 words and a row a bucket."""
    top = (words.where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "word").limit(frequent(DIGITS))
           .select("word", "n").toArrow())
    hashes, n = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy()
    digit = LEAST_DIGITS
    while frequent(digit) < len(n):
        digit += 1
    counts = np.zeros(digit ** 3)
    counts[1:1 + len(n)] = n
    buckets = counts[1 + frequent(digit):]
    for r in words.groupBy(_bucket(F.col("word")).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        buckets[r.bucket] = r.n
    buckets -= np.bincount((hashes % np.uint64(BUCKETS)).astype(np.int64), n, BUCKETS)
    rank = np.argsort(hashes, kind="stable")
    return hashes[rank], rank, counts


def _bucket(word):
    return word.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


class Trainer:
    """Adam steps over a task's texts.  A word's row moves only in steps that meet it,
    and has its own number of steps."""

    def __init__(self, start: np.ndarray):
        self.vector = start.copy()
        self.w = parts(self.vector)
        words = self.w["e"].shape
        self.moments = [np.zeros_like(start[words[0] * words[1]:]) for _ in range(2)]
        self.e_moments = [np.zeros(words, np.float32) for _ in range(2)]
        self.e_steps, self.met = np.zeros(words[0], np.int64), np.zeros(words[0], np.int64)
        self.steps = self.tokens = 0

    @staticmethod
    def _move(m, v, g, steps) -> np.ndarray:
        """The new moments in place, and the way to go."""
        m += 0.1 * (g - m)
        v += 0.005 * (g * g - v)
        rate = RATE * np.sqrt(1 - 0.995 ** steps) / (1 - 0.9 ** steps)
        return (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)

    def step(self, line: np.ndarray, place: np.ndarray) -> None:
        self.steps += 1
        self.tokens += len(place)
        d, rows, de = slopes(self.w, line, place)
        rest = np.concatenate([x.reshape(-1) for x in d.values()])
        self.vector[-len(rest):] -= self._move(*self.moments, rest, self.steps)
        self.e_steps[rows] += 1
        m, v = (x.take(rows, axis=0) for x in self.e_moments)
        self.w["e"][rows] -= self._move(m, v, de, self.e_steps[rows, None])
        for x, new in zip(self.e_moments, (m, v)):
            x[rows] = new

    def learnt(self) -> pa.RecordBatch:
        """The weights in rows of WIDTH, with the tokens each row was learnt from; rows
        of words that were not met are left out."""
        n = len(self.met)
        table = np.resize(self.vector, (-(-len(self.vector) // WIDTH), WIDTH))
        rows = np.concatenate([np.flatnonzero(self.met), np.arange(n, len(table))])
        weight = np.concatenate([self.met[self.met > 0], np.full(len(table) - n, self.tokens)])
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(weight, pa.int64())]
            + [pa.array(np.ascontiguousarray(x)) for x in table[rows].T], ["place", "n", *_COLUMNS])


_COLUMNS = [f"w{k}" for k in range(WIDTH)]


def _train_task(batches: Iterator[pa.RecordBatch], start: np.ndarray, keys, rank) -> Iterator[pa.RecordBatch]:
    """The task's weights and the tokens they come from; steps take whole BATCHes,
    and the rest of the texts at the end."""
    trainer = Trainer(start)
    digit = digit_of(start)
    lines, held = [], 0

    def steps(all_of_them: bool):
        line = np.concatenate([x for x, _ in lines])
        starts = np.cumsum([0] + [len(x) for x, _ in lines])
        place = np.concatenate([p + s for (_, p), s in zip(lines, starts)])
        end = len(place) if all_of_them else len(place) - len(place) % BATCH
        for k in range(0, end, BATCH):
            trainer.step(*_window(line, place[k:min(k + BATCH, end)]))
        if end == len(place):
            return []
        rest = place[end:]
        return [(line[rest[0] - REACH:], rest - rest[0] + REACH)]

    for batch in batches:
        for _, offsets, raw in text_blocks(batch.column(0)):
            line, place = tokens_of(Words(offsets, raw, NOT_ALNUM), keys, rank, digit)
            lines.append((line, place))
            trainer.met += np.bincount(line, minlength=len(trainer.met))
            held += len(place)
            if held >= BATCH:
                lines = steps(False)
                held = sum(len(p) for _, p in lines)
    if held:
        steps(True)
    if trainer.tokens:
        yield trainer.learnt()


def _window(line: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of a line that the contexts of some places reach, and the places there."""
    first = place[0] - REACH
    return line[first:place[-1] + REACH + 1], place - first


class Model:
    """Weights, the words with a token of their own, and the counts of all tokens."""

    def __init__(self, vector: np.ndarray, keys: np.ndarray, rank: np.ndarray, counts: np.ndarray):
        self.vector, self.keys, self.rank, self.counts = vector, keys, rank, counts
        self.digit = digit_of(vector)

    def blocks(self, texts: pa.Array) -> Iterator[tuple[int, Words, np.ndarray, np.ndarray]]:
        """Runs of texts: first row, words, tokens, and each text's sum of the
        log-probabilities of its tokens."""
        w = parts(self.vector, self.digit)
        for first, offsets, raw in text_blocks(texts):
            words = Words(offsets, raw, NOT_ALNUM)
            line, place = tokens_of(words, self.keys, self.rank, self.digit)
            log_p = np.zeros(len(place))
            for k in range(0, len(place), PART):
                log_p[k:k + PART] = forward(w, *_window(line, place[k:k + PART]))[0]
            sums = np.concatenate([[0.0], np.cumsum(log_p)])
            yield first, words, line[place], np.diff(sums[words.first])

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens, and the sum of their log-probabilities, of each text."""
        found = [(words.counts(), total) for _, words, _, total in self.blocks(texts)]
        if not found:
            return np.zeros(0, int), np.zeros(0)
        n, total = zip(*found)
        return np.concatenate(n), np.concatenate(total)


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS,
          words: DataFrame | None = None) -> Model:
    """Vocabulary and network from all texts.  What the tasks of a round learnt is
    averaged by Spark, weight by weight; the driver holds one network.  ``words``:
    the table of ``word_counts`` of the texts, if it is there already."""
    spark = prepare(docs.sparkSession)
    words = word_counts(docs, text) if words is None else words
    keys, rank, counts = vocabulary(words)
    vector = initial(counts)
    tasks = max(spark.sparkContext.defaultParallelism, int(counts.sum()) // rounds // TASK_TOKENS)
    turn = F.pmod(F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(rounds))
    kinds = "place long, n long, " + ", ".join(f"{c} float" for c in _COLUMNS)
    for r in range(rounds):
        shared = spark.sparkContext.broadcast((vector, keys, rank))
        learnt = docs.where(turn == r).select(F.col(f"`{text}`")).coalesce(tasks).mapInArrow(
            lambda it: _train_task(it, *shared.value), kinds)
        mean = learnt.groupBy("place").agg(*[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).cast("float").alias(c)
                                             for c in _COLUMNS])
        got = materialize(mean, "weights").toArrow()
        table = np.resize(vector, (-(-len(vector) // WIDTH), WIDTH))
        for k, c in enumerate(_COLUMNS):
            table[got["place"].to_numpy(), k] = got[c].to_numpy()
        vector = table.reshape(-1)[:len(vector)]
    return Model(vector, keys, rank, counts)


def _block(number: int, held: list) -> pa.RecordBatch:
    """Scored texts and, in the first row, the distinct rare words of them all."""
    ids, n, total, rare_n, rare = (np.concatenate(x) for x in zip(*held))
    word, place = np.unique(rare, return_inverse=True)
    ends = pa.array(np.concatenate([[0], np.cumsum(rare_n)]), pa.int32())
    kind = pa.list_(pa.int64())
    first = pa.array([word.view(np.int64)], kind)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), number)), pa.array(ids), pa.array(n, pa.int64()), pa.array(total),
         pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
         pa.concat_arrays([first, pa.nulls(len(ids) - 1, kind)])],
        ["block", "id", "n", "total", "places", "words"])


def _score_task(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """The task's texts (id, text) in numbered blocks of about LOOKUP_BYTES: tokens,
    the sum of their log-probabilities, and the places of a text's rare words among
    the block's distinct ones."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for at, words, token, total in model.blocks(batch.column(1)):
            rows = len(total)
            rare = token > frequent(model.digit)
            row = np.repeat(np.arange(rows), words.counts())
            held.append((ids[at:at + rows], words.counts(), total,
                         np.bincount(row[rare], minlength=rows), words.hash[rare]))
            size += 64 * rows + int((words.end - words.start).sum())
            if size >= LOOKUP_BYTES:
                yield _block(number, held)
                number, held, size = number + 1, [], 0
    if held:
        yield _block(number, held)


def _add_rare(texts: pa.Table, words: pa.Table) -> pa.Table:
    """Texts of a block with the log-probabilities of their rare words added."""
    log_p = np.zeros(words.num_rows)
    log_p[words["place"].to_numpy()] = words["log_p"].to_numpy()
    places = texts["places"].combine_chunks()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(places).to_numpy(zero_copy_only=False))])
    sums = np.concatenate([[0.0], np.cumsum(log_p[places.flatten().to_numpy()])])
    return pa.table({"id": texts["id"], "n": texts["n"],
                     "log_prob": pa.array(texts["total"].to_numpy() + np.diff(sums[ends.astype(np.int64)]))})


def _score_words(docs: DataFrame, model: Model, text: str, words: DataFrame) -> DataFrame:
    """Each block of texts looks its distinct rare words up once: a word that many
    texts have is one row a block, so no key of the joins is hot."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    numbered = materialize(docs.select(  # written: the numbers must stay
        F.monotonically_increasing_id().alias("id"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")), "numbered")
    blocks = materialize(numbered.select("id", F.col(f"_row.`{text}`").alias("t")).mapInArrow(
        lambda it: _score_task(it, shared.value),
        "block long, id long, n long, total double, places array<int>, words array<long>"), "lm-blocks")
    mass = F.array(*[F.lit(float(n + 1)) for n in model.counts[-BUCKETS:]])
    looked_up = (blocks.where("words is not null").select("block", F.posexplode("words").alias("place", "word"))
                 .join(words, "word", "left")
                 .select(F.col("block").alias("of"), "place", F.log(F.coalesce("n", F.lit(1)) / F.get(
                     mass, _bucket(F.col("word")))).alias("log_p")))
    sums = (blocks.select("block", "id", "n", "total", "places").groupBy("block")
            .cogroup(looked_up.groupBy("of")).applyInArrow(_add_rare, "id long, n long, log_prob double"))
    return numbered.join(sums, "id").select("_row", F.col("n").alias("n_tokens"), "log_prob")


def score(docs: DataFrame, model: Model, text: str = "text", words: DataFrame | None = None) -> DataFrame:
    """The struct ``_row`` (all columns), ``n_tokens`` and ``log_prob`` of every text.

    ``words`` is the table of ``word_counts`` of the training texts: a rare word then
    counts with log P(bucket | context) + log P(word | bucket), where the second is
    its count over (all rare words of its bucket + 1).  The one that is added is the
    mass of the bucket's unseen words: each of them gets all of it, as nothing is
    known to tell them apart.  Without ``words`` a rare word counts as its bucket
    alone, which is no probability of the word.

    Null and empty texts have no tokens and the log-probability zero.  An empty
    table gives an empty result; columns of any name are carried inside ``_row``."""
    spark = prepare(docs.sparkSession)
    if words is not None:
        return _score_words(docs, model, text, words)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<n: long, log_prob: double>")
    def scores(texts: pa.Array) -> pa.Array:
        n, total = shared.value.score(texts)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(total, pa.float64())],
                                          ["n", "log_prob"])
    return (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        scores(F.col(f"`{text}`")).alias("s"))
            .select("_row", F.col("s.n").alias("n_tokens"), F.col("s.log_prob").alias("log_prob")))
