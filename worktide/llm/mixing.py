"""Mixing sources to target weights with soft domain membership.

A softmax classifier, fitted on the labelled table, gives every document posteriors over the domains clean, poor and
toxic. Document rates r >= 0 are then fitted so that the expected tokens of each domain, sum(r * tokens * posterior),
meet the targets, staying near 1 where the targets leave room: least squares by projected gradient. One iteration is one
aggregation to a total per domain; the rates need not be stored, since a document's rate follows from its own
posteriors and the residuals of all iterations so far, a few numbers each.

The classifier is fitted on at most ``SAMPLE`` labelled documents a class, the first by a hash of their id; documents,
counts and rates cover everything. Null texts are empty; null labels are ignored; documents without words have the
class shares as posteriors; a repeated id with different labels counts as toxic before poor before clean; with no
labels at all everything is clean; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import free_name, stored

DOMAINS = ("clean", "poor", "toxic")
#: Shares of the tokens that the domains are to have.
TARGETS = (0.95, 0.05, 0.0)
#: Labelled documents a class that the classifier is fitted on, at most, and the features it knows.
SAMPLE = 2500
FEATURES = 20_000
LEAST_DOCUMENTS = 8
#: Shrinkage of the classifier's weights.
RIDGE = 1e-3
#: Gradient steps of the classifier, each on 64 documents.
STEPS = 1500
#: Pull of the rates towards 1, step, and iterations.
PULL = 1e-3
STEP = 0.9
ITERATIONS = 24


#: Lower-cases A-Z and turns every other ASCII byte that is no digit or letter into a space.
_PLAIN = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in bytes(range(128)).lower() + bytes(range(128, 256)))


def features(text: str | None) -> tuple[int, np.ndarray]:
    """Number of words; hashes of the distinct words of letters and digits, and of coarse shares of symbols and capitals."""
    text = text or ""
    data, n = text.encode("utf-8", "replace"), max(len(text), 1)
    found = [xxhash.xxh64_intdigest(w) for w in set(data.translate(_PLAIN).split())]
    for name, marks in (("#symbols", b"#*$%&|<>!"), ("#capitals", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")):
        share = min((len(data) - len(data.translate(None, marks))) * 40 // n, 20)
        found.append(xxhash.xxh64_intdigest(f"{name} {share}"))
    return len(data.split()), np.sort(np.array(found, np.uint64).view(np.int64))


def hashed(text: Column) -> Column:
    """The hashes of ``features``."""
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t)[1] for t in texts], dtype=object)

    return F.pandas_udf(each, "array<long>")(text)


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, 2).when(quality == 0, 1).when(quality == 1, 0)


class Softmax:
    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.known, self.weights, self.bias = known, weights, bias

    def posteriors(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row per document; ``offsets`` delimit the documents' hashes in ``values``."""
        scores = np.zeros((len(offsets) - 1, len(self.bias)))
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, values), len(self.known) - 1)
            hit = self.known[at] == values
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[hit]
            for k in range(len(self.bias)):
                scores[:, k] = np.bincount(row, weights=self.weights[at[hit], k], minlength=len(scores))
        scores += self.bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)


def fit_classifier(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Softmax:
    """A bounded sample of labelled documents comes to the driver as hashes; class shares are counted over all."""
    marked = (labels.select(labels[key].alias("key"), domain_of(labels["quality"], labels["toxic"]).alias("domain"))
              .filter("key IS NOT NULL AND domain IS NOT NULL").groupBy("key").agg(F.max("domain").alias("domain")))
    counts = {r["domain"]: r["count"] for r in marked.groupBy("domain").count().collect()}
    prior = np.array([counts.get(k, 0) + (k == 0) for k in range(len(DOMAINS))], float)
    prior = np.maximum(prior / prior.sum(), 1e-6)
    picked = None
    for k in counts:
        one = marked.filter(F.col("domain") == k).orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
        picked = one if picked is None else picked.unionByName(one)
    if picked is None:
        return Softmax(np.empty(0, np.int64), np.zeros((0, len(DOMAINS))), np.log(prior))
    # At most SAMPLE narrow rows a class: small by that bound.
    rows = docs.select(docs[key].alias("id"), docs[text].alias("text")).join(F.broadcast(picked), F.col("id") == F.col("key")).dropDuplicates(["key"])
    sample = rows.select("domain", hashed(F.col("text").cast("string")).alias("f")).toArrow()
    y = sample.column("domain").to_numpy().astype(int)
    lists = sample.column("f").combine_chunks()
    values, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    known, df = np.unique(values, return_counts=True)
    chosen = np.flatnonzero(df >= LEAST_DOCUMENTS)
    known = np.sort(known[chosen[np.argsort(-df[chosen], kind="stable")[:FEATURES]]])
    weights, bias = np.zeros((len(known), len(DOMAINS))), np.zeros(len(DOMAINS))
    if len(known) and len(y):
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        row = np.repeat(np.arange(len(y)), sizes)
        hit = known[at] == values
        at, row = at[hit], row[hit]
        offsets = np.searchsorted(row, np.arange(len(y) + 1))
        target = np.eye(len(DOMAINS))[y]
        share = np.bincount(y, minlength=len(DOMAINS)) / len(y)
        slack, slack_bias = np.full_like(weights, 1e-3), 1e-3
        rng = np.random.default_rng(7)
        batches = max(1, len(y) // 64)
        for _ in range(-(-STEPS // batches)):
            order = rng.permutation(len(y))
            for part in np.array_split(order, batches):
                mine = np.concatenate([np.arange(offsets[d], offsets[d + 1]) for d in part]) if len(part) else np.empty(0, int)
                local = np.repeat(np.arange(len(part)), offsets[part + 1] - offsets[part])
                scores = np.stack([np.bincount(local, weights=weights[at[mine], k], minlength=len(part)) for k in range(len(DOMAINS))], axis=1) + bias
                p = np.exp(scores - scores.max(axis=1, keepdims=True))
                slope = (p / p.sum(axis=1, keepdims=True) - target[part]) / len(part)
                used, inverse = np.unique(at[mine], return_inverse=True)
                g = np.stack([np.bincount(inverse, weights=slope[local, k], minlength=len(used)) for k in range(len(DOMAINS))], axis=1) + RIDGE * weights[used]
                slack[used] += g * g
                weights[used] -= 0.1 * g / np.sqrt(slack[used])
                gb = slope.sum(axis=0)
                slack_bias += gb @ gb
                bias -= 0.1 * gb / np.sqrt(slack_bias)
        bias = bias + np.log(prior) - np.log(np.maximum(share, 1e-6))
    return Softmax(known, weights, bias)


def posteriors(docs: DataFrame, model: Softmax, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct (tokens, clean, poor, toxic), and its name."""
    name = free_name(docs, "membership")
    shared = docs.sparkSession.sparkContext.broadcast((model.known, model.weights, model.bias))

    @F.pandas_udf("tokens long, clean double, poor double, toxic double")
    def member(texts: pd.Series) -> pd.DataFrame:
        found = [features(t) for t in texts]
        values = np.concatenate([h for _, h in found]) if found else np.empty(0, np.int64)
        ends = np.cumsum([0] + [len(h) for _, h in found])
        result = pd.DataFrame(Softmax(*shared.value).posteriors(values, ends), columns=list(DOMAINS))
        result.insert(0, "tokens", np.array([n for n, _ in found], np.int64))
        return result

    return docs.withColumn(name, member(docs[text].cast("string"))), name


def rate(history: list[list[float]], p: list[Column], pull: float = PULL, step: float = STEP) -> Column:
    """The rate that the residuals so far lead to, from 1."""
    if not history:
        return F.lit(1.0)
    steps = F.array(*[F.array(*[F.lit(float(x)) for x in one]) for one in history])

    def move(r: Column, h: Column) -> Column:
        slope = sum((p[k] * h[k] for k in range(len(p))), F.lit(0.0)) + pull * (r - 1)
        return F.greatest(F.lit(0.0), r - step * slope)

    return F.aggregate(steps, F.lit(1.0), move)


def fit_rates(members: DataFrame, targets: tuple[float, ...] = TARGETS, iterations: int = ITERATIONS) -> tuple[list[list[float]], dict]:
    """Residuals by iteration, and the totals: (tokens, clean, poor, toxic) rows in, a few sums out each time.

    The budget is the largest that does not thin the first domain. Residuals are relative to the domains' own tokens.
    """
    p = [F.col(d) for d in DOMAINS]

    def totals(history):
        r = rate(history, p)
        found = members.agg(*[F.sum(F.col("tokens") * r * x).alias(f"{d}_tokens") for d, x in zip(DOMAINS, p, strict=True)]).first()
        return [found[f"{d}_tokens"] or 0.0 for d in DOMAINS]

    start = totals([])
    scale = [max(x, 1.0) for x in start]
    budget = start[0] / targets[0] if targets[0] > 0 else sum(start)
    want, history, now = [t * budget for t in targets], [], start
    for _ in range(iterations):
        history.append([(now[k] - want[k]) / scale[k] for k in range(len(want))])
        now = totals(history)
        if max(abs(now[k] - want[k]) / scale[k] for k in range(len(want))) < 1e-3:
            break
    return history, {"before": start, "target": want, "after": now}


def mixed(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None,
          targets: tuple[float, ...] = TARGETS) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all when not given) with a struct ``mix``: tokens, posteriors, domain, rate."""
    model = fit_classifier(docs, labels, key, text)
    carry = docs.columns if carry is None else carry
    rows, name = posteriors(docs, model, text)
    mix = free_name(docs, "mix")
    rows = stored(rows.select(*carry, F.col(name).alias(mix)), "mix")
    history, _ = fit_rates(rows.select(f"{mix}.*"), targets)
    p = [F.col(f"{mix}.{d}") for d in DOMAINS]
    likely = F.greatest(*p)
    domain = F.when(p[2] == likely, DOMAINS[2]).when(p[1] == likely, DOMAINS[1]).otherwise(DOMAINS[0])
    return rows.withColumn(mix, F.struct(F.col(f"{mix}.*"), domain.alias("domain"), rate(history, p).alias("rate")))


def mixing_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, clean, poor, toxic (posteriors), domain, rate."""
    rows = mixed(docs, labels, key, text, carry=[key])
    mix = rows.columns[-1]
    return rows.select(F.col(key).alias("doc_id"), F.col(f"{mix}.tokens").alias("n_tokens"),
                       *[F.col(f"{mix}.{d}").alias(d) for d in (*DOMAINS, "domain", "rate")])


def admit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with domain, rate and copies, without those that have no copy. A rate's fraction is decided by a hash of
    the id; a clean document has one copy at least, a toxic one none where toxic tokens are not wanted."""
    rows = mixed(docs, labels, key, text)
    mix = rows.columns[-1]
    chance = F.pmod(F.xxhash64(F.col(key), F.lit("mix")), F.lit(1_000_000)) / 1_000_000
    copies = F.floor(F.col(f"{mix}.rate") + chance)
    copies = (F.when(F.col(f"{mix}.domain") == "clean", F.greatest(copies, F.lit(1)))
              .when((F.col(f"{mix}.domain") == "toxic") & F.lit(TARGETS[2] == 0), 0).otherwise(copies))
    names = {c: free_name(docs, c) for c in ("domain", "rate", "copies")}
    return rows.select(*docs.columns, F.col(f"{mix}.domain").alias(names["domain"]), F.col(f"{mix}.rate").alias(names["rate"]),
                       copies.cast("long").alias(names["copies"])).filter(F.col(names["copies"]) > 0)
