"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are made of the XXH64 hashes of four-word shingles. Bits that go together in a bounded sample are grouped
into partitions; for each, the number of candidates at every threshold is estimated from the sample, and a dynamic
programme gives the partitions unequal thresholds. With thresholds t_i, sum(t_i + 1) = radius + 1, two fingerprints
within the radius are within t_i in some partition. Fingerprints are posted under their value in each partition;
those of a threshold above 0 also probe the values within it. What meets is verified on all 64 bits. The sample
and the programme only choose how the search runs: its result is exact for every choice.

Equal fingerprints are one node. Within a bucket only a spanning forest of the links is passed on, and a bucket of
more than ``BUCKET`` fingerprints is cut into chunks that meet pair by pair, so no task holds an unbounded bucket and no
group is expanded into all its pairs.

Null and wordless texts have fingerprint zero and are linked like any other; repeated rows are equal; an empty table
gives no rows; other columns are not touched; a null id takes part without being anyone's component id.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import free_name, saved
from worktide.llm.components import connected_components

SHINGLE = 4
RADIUS = 4
#: Fingerprints looked at to group bits and to estimate candidates; a bound on what comes to the driver.
SAMPLE = 4000
#: Largest bucket that one task compares at once.
BUCKET = 4096
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def text_fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of one text: a bit is 1 if set in over half of the shingle hashes."""
    from xxhash import xxh64_intdigest

    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxh64_intdigest(joined, 42)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:1 - SHINGLE].tolist()
    hashes = np.array([xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, ends[SHINGLE - 1:].tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, bits), one row per row of ``docs``; digest tells texts apart, bits is the fingerprint as a signed long."""
    def run(batches):
        for batch in batches:
            bits = np.fromiter((text_fingerprint(t or b"") for t in batch.column(2).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits.view(np.int64))], ["doc_id", "digest", "bits"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("doc_id"), F.xxhash64(docs[text]).alias("digest"), docs[text].cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, digest long, bits long")


def grouped_bits(sample: np.ndarray, parts: int) -> list[int]:
    """Masks of ``parts`` partitions of near equal width; bits that agree in the sample come together."""
    sample = sample if len(sample) else np.zeros(1, np.uint64)
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(float)
    spread = bits.std(axis=0)
    z = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1)
    tie = np.abs(z.T @ z) / max(len(sample), 1)
    left, masks = list(range(64)), []
    for k in range(parts):
        width = 64 // parts + (k < 64 % parts)
        group = [max(left, key=lambda b: (tie[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            best = max(left, key=lambda b: (tie[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        masks.append(sum(1 << b for b in group))
    return masks


def allocate(sample: np.ndarray, masks: list[int], total: int, radius: int = RADIUS) -> tuple[float, list[int]]:
    """The thresholds (-1: partition unused) of least estimated cost for ``total`` fingerprints, and that cost."""
    scale = (total / max(len(sample), 1)) ** 2 / 2
    costs = []
    for mask in masks:
        own, width = sample & np.uint64(mask), mask.bit_count()
        near = np.zeros(radius + 1)
        for value in own[:1000]:
            near += np.bincount(np.minimum(np.bitwise_count(own ^ value), radius + 1), minlength=radius + 2)[:radius + 1]
        near *= len(own) / max(min(len(own), 1000), 1) * scale
        posted = np.cumsum([comb(width, t) for t in range(radius + 1)]) * total
        costs.append([0.0] + [float(near[:t + 1].sum() + 20 * posted[t]) for t in range(radius + 1)])
    # best[s]: cost and thresholds of the partitions so far, s being the sum of (threshold + 1).
    best = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (cost, chosen) in best.items():
            for t in range(-1, radius + 1 - s):
                option = (cost + own[t + 1], [*chosen, t])
                if s + t + 1 not in step or option < step[s + t + 1]:
                    step[s + t + 1] = option
        best = step
    return best[radius + 1]


def plan_search(nodes: DataFrame, radius: int = RADIUS) -> list[tuple[int, int]]:
    """(mask, threshold) of the partitions to use."""
    total = nodes.count()
    share = min(1.0, SAMPLE / max(total, 1))
    taken = nodes.filter(F.pmod(F.xxhash64("bits"), F.lit(1_000_003)) < share * 1_000_003).select("bits").limit(2 * SAMPLE).collect()
    sample = np.array([r["bits"] for r in taken], np.int64).view(np.uint64)
    options = []
    for parts in range(2, radius + 2):
        masks = grouped_bits(sample, parts)
        cost, chosen = allocate(sample, masks, total, radius)
        options.append((cost, [(m, t) for m, t in zip(masks, chosen, strict=True) if t >= 0]))
    return min(options)[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bucket_links(index: np.ndarray, probes: np.ndarray, radius: int) -> tuple[list, list]:
    """A spanning forest of the links among ``index``, and from each probe one link to every tree it touches."""
    left, right, trees = [], [], []
    todo = index
    while len(todo):
        tree, front, todo = [todo[0]], [todo[0]], todo[1:]
        while front and len(todo):
            pivot = front.pop()
            near = np.bitwise_count(todo ^ pivot) <= radius
            if near.any():
                found = todo[near]
                left += [pivot] * len(found)
                right += found.tolist()
                tree += list(found)
                front += list(found)
                todo = todo[~near]
        trees.append(np.array(tree, np.uint64))
    if len(probes):
        for tree in trees:
            open_ = probes
            for node in tree:
                near = np.bitwise_count(open_ ^ node) <= radius
                if near.any():
                    found = open_[near]
                    left += [node] * len(found)
                    right += found.tolist()
                    open_ = open_[~near]
                if not len(open_):
                    break
    return left, right


def _linker(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def emit(left, right):
        a, b = np.array(left, np.uint64), np.array(right, np.uint64)
        differ = a != b
        return pa.RecordBatch.from_arrays([pa.array(a[differ].view(np.int64)), pa.array(b[differ].view(np.int64))], schema=schema)

    def settle(cols):
        """Links of whole groups; rows are sorted by group."""
        part, value, cell, probe, bits = cols
        change = np.flatnonzero((np.diff(part) != 0) | (np.diff(value) != 0) | (np.diff(cell) != 0)) + 1
        starts = np.concatenate([[0], change])
        sizes = np.diff(np.append(starts, len(part)))
        posted = np.add.reduceat((~probe).astype(np.int64), starts)
        group = np.repeat(np.arange(len(starts)), sizes)
        # Buckets of one fingerprint and its probes, all at once.
        single = (posted == 1) & (sizes > 1)
        owner = np.zeros(len(starts), np.uint64)
        owner[group[~probe]] = bits[~probe]
        rows = single[group] & probe
        a, b = owner[group[rows]], bits[rows]
        near = np.bitwise_count(a ^ b) <= radius
        yield emit(a[near], b[near])
        for k in np.flatnonzero(posted > 1):
            at = slice(starts[k], starts[k] + sizes[k])
            own, is_probe = bits[at], probe[at]
            yield emit(*bucket_links(np.unique(own[~is_probe]), np.unique(own[is_probe]), radius))

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            cols[4] = cols[4].view(np.uint64)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            # The last group may go on in the next batch.
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from settle([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None and len(held[0]):
            yield from settle(held)

    return run


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``bits`` of ``nodes`` that connect all within the radius."""
    rows = None
    for k, (mask, threshold) in enumerate(plan_search(nodes, radius)):
        ones = [1 << b for b in range(64) if mask >> b & 1]
        flips = [(0, False)] + [(_signed(sum(pick)), True) for t in range(1, threshold + 1) for pick in combinations(ones, t)]
        own = F.col("bits").bitwiseAND(F.lit(_signed(mask)))
        moves = F.array(*[F.struct(F.lit(x).cast("long").alias("x"), F.lit(p).alias("p")) for x, p in flips])
        part = nodes.select("bits", F.explode(moves).alias("m")).select(
            F.lit(k).alias("part"), own.bitwiseXOR(F.col("m.x")).alias("value"), F.col("m.p").alias("probe"), "bits")
        rows = part if rows is None else rows.unionByName(part)
    hot = saved(rows.filter(~F.col("probe")).groupBy("part", "value").count().filter(F.col("count") > BUCKET)
                .select(F.col("part").alias("hot_part"), F.col("value").alias("hot_value"), F.ceil(F.col("count") / BUCKET).cast("int").alias("chunks")))
    if hot.limit(1).count():
        rows = rows.join(hot, (F.col("part") == F.col("hot_part")) & (F.col("value") == F.col("hot_value")), "left")
        mine = F.pmod(F.xxhash64("bits"), F.col("chunks")).cast("int")
        every = F.sequence(F.lit(0), F.col("chunks") - 1)
        # Posted rows meet every chunk once, probes meet each chunk by itself.
        cells = (F.when(F.col("chunks").isNull(), F.array(F.lit(0)))
                 .when(F.col("probe"), F.transform(every, lambda j: j * F.col("chunks") + j))
                 .otherwise(F.transform(every, lambda j: F.least(j, mine) * F.col("chunks") + F.greatest(j, mine))))
        rows = rows.withColumn("cell", F.explode(cells))
    else:
        rows = rows.withColumn("cell", F.lit(0))
    rows = rows.select("part", "value", "cell", "probe", "bits").repartition("part", "value", "cell").sortWithinPartitions("part", "value", "cell")
    return rows.mapInArrow(_linker(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, digest, bits, group, component_id), one row per row of ``docs``; group is one of the component's fingerprints."""
    marks = saved(fingerprints(docs, key, text))
    nodes = saved(marks.groupBy("bits").agg(F.min("doc_id").alias("least")))
    found = connected_components(links(nodes, radius))
    named = nodes.join(found, F.col("bits") == F.col("node"), "left").select(
        F.col("bits").alias("bits_"), F.coalesce("component", "bits").alias("group"), "least")
    ids = named.groupBy(F.col("group").alias("group_")).agg(F.min("least").alias("component_id"))
    named = named.join(ids, F.col("group") == F.col("group_")).select("bits_", "group", "component_id")
    return marks.join(named, F.col("bits") == F.col("bits_")).select("doc_id", "digest", "bits", "group", "component_id")


def simhash_report(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    return near_duplicates(docs, key, text, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One document of each component, that of the smallest id - of several texts with it, that of the smallest digest; of repeated
    rows one; rows without an id stay."""
    name, digest = free_name(docs, "first_"), free_name(docs, "digest_")
    groups = near_duplicates(docs, key, text, radius).filter(F.col("doc_id").isNotNull())
    first = groups.groupBy("group").agg(F.min(F.struct("doc_id", "digest")).alias("first")).select(F.col("first").alias(name)).distinct()
    rows = docs.filter(docs[key].isNotNull()).withColumn(digest, F.xxhash64(docs[text]))
    kept = rows.join(first, (F.col(key) == F.col(f"{name}.doc_id")) & (F.col(digest) == F.col(f"{name}.digest")), "left_semi")
    return kept.dropDuplicates([key, digest]).drop(digest).unionByName(docs.filter(docs[key].isNull()))
