"""Language-model scores: token counts, and online logistic mixing of hashed-context bit predictors.

The text is a string of bytes closed by a zero byte; every byte is eight binary decisions. Predictors of order 0 to 3
keep how often each decision went either way after the last bytes; contexts are hashed into tables of fixed size. Their
log-odds are mixed by weights that a gate selects (bit position and how much the longest context has seen), learned
online by gradient descent on the coding cost; a last stage refines the mixed probability by the previous byte.

All of this is counted over every training document: byte 4-grams are counted where they lie and summed, and from these
sums the tables, the weights and the refinement follow, each occurrence being predicted from all others (its own count
is taken out). Weights are learned in parallel over the partitions of the 4-gram counts and averaged, a few rounds.
Only tables of fixed size are broadcast. Scoring makes a probability row per context once and looks bytes up in it.

Token counts of the most frequent words are resolved where the text is; the other words are joined with the counts.

Null texts are empty (one end, no words), a null id counts as the text "", an empty table gives no rows, repeated rows
count and are scored each, other columns are not touched.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import saved, stored

#: log2 of the table sizes by order; orders 0 and 1 are exact.
TABLE_BITS = (8, 16, 18, 20)
_BASE = np.concatenate([[0], np.cumsum([1 << b for b in TABLE_BITS])])
SLOTS = int(_BASE[-1])
#: Gates: bit position by how much the order-3 context has seen.
LEVELS = 4
ROUNDS = 3
RATE = 0.02
BUCKETS = 33
#: So many words are resolved without a shuffle; a bound on what is broadcast.
FREQUENT = 65_536
#: Words counted in a task before the counts are passed on, and contexts kept in a scorer: bounds on memory.
FLUSH = 400_000
CONTEXTS = 60_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def held_out(key):
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def byte_string(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array - three zeros, the text, a zero - with where the symbols of each begin and end."""
    buffer = np.frombuffer(b"".join(b"\0\0\0" + t + b"\0" for t in texts), np.uint8)
    ends = np.cumsum(np.array([len(t) + 4 for t in texts], np.int64))
    return buffer, np.concatenate([[0], ends[:-1]]) + 3, ends


def contexts_of(buffer: np.ndarray) -> np.ndarray:
    """The three bytes before each symbol from position 3 on, as one number."""
    b = buffer.astype(np.uint32)
    return b[:-3] << 16 | b[1:-2] << 8 | b[2:-1]


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buffer, starts, _ = byte_string(texts)
    grams = contexts_of(buffer) << np.uint32(8) | buffer[3:]
    pad = np.zeros(len(buffer), bool)
    for k in (1, 2, 3):
        pad[starts - k] = True
    return np.unique(grams[~pad[3:]], return_counts=True)


def _slots(context: np.ndarray, prefix: np.ndarray) -> list[np.ndarray]:
    """The table slot of each order; ``prefix`` is 1 and the bits of the byte known so far."""
    p = prefix.astype(np.uint64)
    c = context.astype(np.uint64)
    order2 = (((c & np.uint64(0xFFFF)) << np.uint64(8) | p) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS[2])
    order3 = ((c << np.uint64(8) | p) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - TABLE_BITS[3])
    each = [p, (c & np.uint64(0xFF)) << np.uint64(8) | p, order2, order3]
    return [x.astype(np.int64) + _BASE[k] for k, x in enumerate(each)]


def _decisions(grams: np.ndarray):
    """For each of the eight bits: context, prefix and the bit itself."""
    context, byte = grams >> np.uint32(8), (grams & np.uint32(0xFF)).astype(np.int64)
    for k in range(8):
        yield context, (byte | 256) >> (8 - k), byte >> (7 - k) & 1


def features(n0, n1, slots: list[np.ndarray], bit=None) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of the predictors (and a bias) and the level of the longest; with ``bit`` the own occurrence is left out."""
    x = np.empty((len(slots) + 1, len(slots[0])), np.float32)
    for k, at in enumerate(slots):
        zero, one = n0[at], n1[at]
        if bit is not None:
            zero, one = np.maximum(zero - (bit == 0), 0), np.maximum(one - (bit == 1), 0)
        x[k] = np.log((one + 0.3) / (zero + 0.3))
        seen = zero + one
    x[-1] = 0.3
    return x, np.digitize(seen, (0.5, 4.5, 64.5))


def squash(x):
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


def place(x):
    """Where a log-odds stands among the refinement's buckets."""
    return np.clip(np.rint((x + 8) * (BUCKETS - 1) / 16), 0, BUCKETS - 1).astype(np.int64)


class Mixer:
    """The learned state; every part has a fixed size."""

    def __init__(self, n0: np.ndarray, n1: np.ndarray):
        self.n0, self.n1 = n0, n1
        self.weights = np.full((8 * LEVELS, len(TABLE_BITS) + 1), 0.3, np.float32)
        self.refined = np.tile(np.linspace(-8, 8, BUCKETS), (256, 1))

    def mixed(self, position, x, level):
        gate = position * LEVELS + level
        return np.clip((self.weights[gate].T * x).sum(axis=0), -12, 12), gate

    def probability(self, position, context, prefix):
        """Of bit 1."""
        x, level = features(self.n0, self.n1, _slots(context, prefix))
        y, _ = self.mixed(position, x, level)
        again = self.refined[(context & np.uint32(0xFF)).astype(np.int64), place(y)]
        return np.clip(squash((y + again) / 2), 1e-6, 1 - 1e-6)

    def learn(self, grams: np.ndarray, counts: np.ndarray, step: int = 2048) -> None:
        """One online pass."""
        for at in range(0, len(grams), step):
            g, c = grams[at:at + step], np.minimum(counts[at:at + step], 1000).astype(np.float32)
            share = c / c.sum()
            for position, (context, prefix, bit) in enumerate(_decisions(g)):
                x, level = features(self.n0, self.n1, _slots(context, prefix), bit)
                y, gate = self.mixed(position, x, level)
                slope = (bit - squash(y)) * share * 16 * RATE
                for k in range(x.shape[0]):
                    self.weights[:, k] += np.bincount(gate, weights=slope * x[k], minlength=len(self.weights)).astype(np.float32)

    def refinement(self, grams, counts) -> np.ndarray:
        """[256, BUCKETS, 2]: how often the bit was 0 and 1 by previous byte and mixed log-odds."""
        table = np.zeros((256 * BUCKETS, 2))
        for position, (context, prefix, bit) in enumerate(_decisions(grams)):
            x, level = features(self.n0, self.n1, _slots(context, prefix), bit)
            y, _ = self.mixed(position, x, level)
            cell = (context & np.uint32(0xFF)).astype(np.int64) * BUCKETS + place(y)
            for b in (0, 1):
                table[:, b] += np.bincount(cell, weights=counts * (bit == b), minlength=len(table))
        return table

    def rows(self, contexts: np.ndarray) -> np.ndarray:
        """log10 of the probability of every byte after each context."""
        out = np.zeros((len(contexts), 256), np.float32)
        for k in range(8):
            prefixes = np.arange(1 << k, 2 << k)
            c, p = np.repeat(contexts, len(prefixes)), np.tile(prefixes, len(contexts))
            one = self.probability(k, c, p).reshape(len(contexts), len(prefixes))
            both = np.stack([np.log10(1 - one), np.log10(one)], axis=2).reshape(len(contexts), -1)
            out += np.repeat(both, 256 >> (k + 1), axis=1).astype(np.float32)
        return out


class Scorer:
    """Scores texts with a mixer, keeping the probability rows of the contexts met."""

    def __init__(self, mixer: Mixer):
        self.mixer = mixer
        self.forget()

    def forget(self):
        self.index = np.full(1 << 24, -1, np.int32)
        self.table = np.empty((1024, 256), np.float32)
        self.used = 0

    def scores(self, texts: list[bytes]) -> np.ndarray:
        buffer, starts, ends = byte_string(texts)
        contexts = contexts_of(buffer)
        fresh = np.unique(contexts[self.index[contexts] < 0])
        if self.used and self.used + len(fresh) > CONTEXTS:
            self.forget()
            fresh = np.unique(contexts)
        while self.used + len(fresh) > len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        for at in range(0, len(fresh), 256):
            part = fresh[at:at + 256]
            self.table[self.used:self.used + len(part)] = self.mixer.rows(part)
            self.index[part] = np.arange(self.used, self.used + len(part))
            self.used += len(part)
        each = np.concatenate([np.zeros(3, np.float32), self.table[self.index[contexts], buffer[3:]]])
        for k in (1, 2, 3):
            each[starts - k] = 0
        return np.add.reduceat(each.astype(np.float64), starts)


def _slices(batch, most_bytes: int = 1 << 22):
    """Row ranges of a batch whose texts come to about ``most_bytes``."""
    sizes = np.array([0 if t is None else len(t) for t in batch.column("text").to_pylist()])
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most_bytes)))
        yield batch.slice(at, n)
        at += n


def corpus_counts(training: DataFrame) -> DataFrame:
    """(word, gram, n): partial counts of words, of ends (the word is empty), and of byte 4-grams."""
    schema = pa.schema([("word", pa.binary()), ("gram", pa.int64()), ("n", pa.int64())])

    def flush(words, grams):
        g, n = np.unique(np.concatenate([x[0] for x in grams]), return_inverse=True) if grams else (np.empty(0, np.uint32), None)
        totals = np.bincount(n, weights=np.concatenate([x[1] for x in grams])).astype(np.int64) if grams else np.empty(0, np.int64)
        for at in range(0, len(g), 50_000):
            part = g[at:at + 50_000].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.binary()), pa.array(part), pa.array(totals[at:at + 50_000])], schema=schema)
        keys = list(words)
        for at in range(0, len(keys), 50_000):
            part = keys[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.nulls(len(part), pa.int64()), pa.array([words[w] for w in part], pa.int64())], schema=schema)

    def run(batches):
        words, grams = Counter(), []
        for batch in batches:
            for part in _slices(batch):
                texts = [t or b"" for t in part.column("text").to_pylist()]
                grams.append(gram_counts(texts))
                words[b""] += len(texts)
                for t in texts:
                    words.update(t.translate(_LOWER).split())
                if len(words) > FLUSH or sum(len(x[0]) for x in grams) > 20 * FLUSH:
                    yield from flush(words, grams)
                    words, grams = Counter(), []
        if words:
            yield from flush(words, grams)

    return training.mapInArrow(run, "word binary, gram long, n long")


def _gram_job(grams: DataFrame, function, columns: str):
    """Apply ``function(grams, counts)``, giving arrays, to each partition of the 4-gram counts."""
    def run(batches):
        g, n = [], []
        for batch in batches:
            g.append(batch.column(0).to_numpy().astype(np.uint32))
            n.append(batch.column(1).to_numpy())
        if g:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in function(np.concatenate(g), np.concatenate(n))], names=columns_)

    columns_ = [c.split()[0] for c in columns.split(", ")]
    return grams.mapInArrow(run, columns)


def train(grams: DataFrame) -> Mixer:
    """The mixer of the 4-gram counts (gram, n). What comes to the driver is bounded by the table sizes."""
    context = grams.sparkSession.sparkContext

    def tally(g, n):
        zero, one = np.zeros(SLOTS), np.zeros(SLOTS)
        for c, p, bit in _decisions(g):
            for at in _slots(c, p):
                zero += np.bincount(at, weights=n * (bit == 0), minlength=SLOTS)
                one += np.bincount(at, weights=n * (bit == 1), minlength=SLOTS)
        used = np.flatnonzero(zero + one)
        return used.astype(np.int64), zero[used], one[used]

    sums = _gram_job(grams, tally, "slot long, n0 double, n1 double").groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    n0, n1 = np.zeros(SLOTS, np.float32), np.zeros(SLOTS, np.float32)
    at = sums.column("slot").to_numpy()
    n0[at], n1[at] = sums.column("n0").to_numpy(), sums.column("n1").to_numpy()
    mixer = Mixer(n0, n1)
    tables = context.broadcast((n0, n1))

    for _ in range(ROUNDS):
        weights = mixer.weights

        def learn(g, n, weights=weights):
            own = Mixer(*tables.value)
            own.weights = weights.copy()
            # The stream's order: a hash of the 4-gram, so that neighbours are unrelated.
            order = np.argsort(g * np.uint32(2654435761))
            own.learn(g[order], n[order])
            return np.arange(own.weights.size), own.weights.ravel().astype(float) * len(g), np.full(own.weights.size, float(len(g)))

        rows = _gram_job(grams, learn, "k long, w double, n double").groupBy("k").agg((F.sum("w") / F.sum("n")).alias("w")).collect()
        flat = weights.ravel().copy()
        for r in rows:
            flat[r["k"]] = r["w"]
        mixer.weights = flat.reshape(weights.shape)

    def refine(g, n):
        own = Mixer(*tables.value)
        own.weights = final
        table = own.refinement(g, n)
        return np.arange(len(table)), table[:, 0], table[:, 1]

    final = mixer.weights
    rows = _gram_job(grams, refine, "k long, n0 double, n1 double").groupBy("k").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()
    odds = mixer.refined.ravel().copy()
    for r in rows:
        prior = odds[r["k"]]
        odds[r["k"]] = np.log((r["n1"] + 8 * squash(prior)) / (r["n0"] + 8 * (1 - squash(prior))))
    mixer.refined = odds.reshape(256, BUCKETS)
    return mixer


def score_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, and bits_per_byte (of the text and its end)."""
    rows = docs.select(docs[key].alias("doc_id"), held_out(docs[key]).alias("held_out"), docs[text].cast("binary").alias("text"))
    counts = stored(corpus_counts(rows.filter(~F.col("held_out")).select("text")), "counts")
    words = stored(counts.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("c")), "words")
    grams = saved(counts.filter(F.col("gram").isNotNull()).groupBy("gram").agg(F.sum("n").alias("n")))
    totals = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = words.filter(F.octet_length("word") == 0).agg(F.sum("c")).first()[0] or 0
    top = words.filter(F.octet_length("word") > 0).orderBy(F.desc("c"), "word").limit(FREQUENT)
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast({bytes(r["word"]): float(np.log10(r["c"] + 1)) for r in top.collect()})
    mixer = spark.sparkContext.broadcast(train(grams))

    kind = docs.schema[key].dataType.simpleString()
    columns = (f"doc_id {kind}, held_out boolean, n_tokens long, known long, total double, score double, n_bytes long, "
               "rare array<struct<word: binary, n: int>>")
    pair = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))

    def run(batches):
        scorer, known_words = Scorer(mixer.value), frequent.value
        for batch in batches:
            for part in _slices(batch):
                texts = [t or b"" for t in part.column("text").to_pylist()]
                scores = scorer.scores(texts)
                n_tokens, known, total, rare = [], [], [], []
                for t in texts:
                    own = t.translate(_LOWER).split()
                    found = [known_words.get(w) for w in own]
                    good = [x for x in found if x is not None]
                    n_tokens.append(len(own) + 1)
                    known.append(len(good))
                    total.append(float(np.sum(good)) if good else 0.0)
                    left = Counter(w for w, x in zip(own, found, strict=True) if x is None)
                    rare.append([{"word": w, "n": n} for w, n in left.items()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(total, pa.float64()),
                     pa.array(scores), pa.array([len(t) for t in texts], pa.int64()), pa.array(rare, pair)],
                    names=["doc_id", "held_out", "n_tokens", "known", "total", "score", "n_bytes", "rare"])

    marks = stored(rows.mapInArrow(run, columns).withColumn("row", F.monotonically_increasing_id()), "scores")
    rest = marks.select("row", F.explode("rare").alias("x")).select("row", F.col("x.word").alias("word"), F.col("x.n").alias("k"))
    rest = (rest.join(words, "word").groupBy("row")
            .agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("more_total")))
    n, v = int(totals["n"]), int(totals["v"])
    base = F.col("total") + F.coalesce("more_total", F.lit(0.0)) + float(np.log10(ends + 1)) - F.col("n_tokens") * float(np.log10(n + v + 1))
    return marks.drop("rare").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
        (-F.col("score") / float(np.log10(2)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
