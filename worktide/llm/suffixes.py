"""Suffix-array dedup: remove every byte that a string of ``LENGTH`` bytes covers which also starts anywhere else.

A sparse suffix array over anchors. Every window of 200 bytes has as its anchor the 100-byte gram of least hash in it,
the leftmost of equals: equal windows have equal anchors at the same offset. Anchors whose gram is unique can be in no
repeated window; one count of gram hashes drops them (the distinguishing-prefix filter of distributed string sorting).
The suffixes at the others, cut off where the anchor's last window ends, are sorted where they lie, bucket by bucket, and
exchanged as front-coded runs. Each bucket merges its runs with a loser tree over common-prefix lengths, which goes on
comparing where the known prefix ends and never looks at a known prefix again. The merge gives the suffix order with
its LCPs; with the same order of the bytes before the anchors, a window at offset d is repeated where two suffixes agree
in 200 - d bytes after the anchor and d bytes before it. That is exact: strings are compared, hashes only place them.

Equal strings around an anchor, as copies have, are one string where they are found: all their windows are repeated, so
their ranges are known there, and one of them goes on to meet the others. A bucket thus gets a string at most once from
each run. A gram of very many suffixes is spread over several buckets by the hash of the whole string, and over lanes of
runs where there are more runs than a bucket may hold; windows that its buckets cannot settle alone are matched by a
128-bit fingerprint over all of them. Texts are shuffled compressed.

Null texts are empty; repeated rows are repeats of each other; matches never cross documents; an empty table gives no
rows; other columns are not touched.
"""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import saved, stored

LENGTH = 200
GRAM = 100
SPAN = LENGTH - GRAM + 1
#: Suffixes to a bucket, about; a gram of more is spread.
BUCKET = 40_000
#: Bytes of suffixes sorted at once in a task.
RUN_BYTES = 24 << 20
#: Buckets from here down hold ranges that are known to be repeated.
COPIES = -(1 << 41)
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_TABLE = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "big") for b in range(256)], np.uint64)


class Powers:
    """Powers of the hash base and of its inverse, as far as asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _ODD), ("down", _INVERSE)):
                each = np.full(size, base, np.uint64)
                each[0] = 1
                setattr(cls, name, np.cumprod(each))
        return cls.up[:n], cls.down[:n]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the gram at each position that has one."""
    n = len(data) - GRAM + 1
    up, down = Powers.upto(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up)])
    h = (sums[GRAM:] - sums[:n]) * down[:n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def segments(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, its hash, first and last window of each run of windows with one anchor."""
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none
    h = gram_hashes(data)
    bits = np.uint64(max(int(len(h)).bit_length(), 1))
    key = h >> bits << bits | np.arange(len(h), dtype=np.uint64)
    width, low = 1, key
    while width * 2 <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < SPAN:
        low = np.minimum(low[:len(low) - (SPAN - width)], low[SPAN - width:])
    anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
    last = np.append(first[1:], len(anchor)) - 1
    at = anchor[first]
    return at, h[at].view(np.int64), first, last


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, doc_id, body): rows are named by a hash of id and text, texts are UTF-8 bytes."""
    body = F.coalesce(docs[text].cast("binary"), F.lit(b""))
    return docs.select(F.xxhash64(docs[key], F.lit("|"), body).alias("row"), docs[key].alias("doc_id"), body.alias("body"))


def _packed(rows: DataFrame) -> DataFrame:
    """The texts compressed, for the shuffle."""
    def run(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            at = batch.schema.get_field_index("body")
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                yield part.set_column(at, "body", pa.array([packer.compress(b) for b in part.column(at).to_pylist()], pa.binary()))

    return rows.mapInArrow(run, rows.schema)


def anchors(rows: DataFrame) -> DataFrame:
    """(row, at, gram): the anchors of all texts."""
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                ids, at, grams = [], [], []
                for row, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    a, h, _, _ = segments(np.frombuffer(body, np.uint8))
                    ids.append(np.full(len(a), row, np.int64))
                    at.append(a)
                    grams.append(h)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(at)), pa.array(np.concatenate(grams))],
                                                 names=["row", "at", "gram"])

    return rows.select("row", "body").mapInArrow(run, "row long, at long, gram long")


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """The common prefix length of strings known to agree in ``known`` bytes."""
    end = min(len(a), len(b))
    differ = int.from_bytes(a[known:end]) ^ int.from_bytes(b[known:end])
    return end - (differ.bit_length() + 7) // 8


def packed(block: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(block)


def opened(block: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(block)


def front_code(items: list[tuple]) -> bytes:
    """A sorted run of (suffix, before, row, at) as bytes: each suffix without what it shares with the one before it."""
    shared, tails, befores, last = [], [], [], b""
    for suffix, before, _, _ in items:
        n = common_prefix(last, suffix, 0)
        shared.append(n)
        tails.append(suffix[n:])
        befores.append(before)
        last = suffix
    heads = np.array([shared, [len(t) for t in tails], [len(b) for b in befores]], np.uint8)
    refs = np.array([(row, at) for _, _, row, at in items], np.int64)
    return packed(len(items).to_bytes(4, "big") + heads.tobytes() + refs.T.tobytes() + b"".join(tails) + b"".join(befores))


def read_run(block: bytes):
    """(shared with the one before, suffix, before, row, at) of a front-coded run."""
    data = opened(block)
    n = int.from_bytes(data[:4], "big")
    shared, tails, befores = np.frombuffer(data, np.uint8, 3 * n, 4).reshape(3, n).tolist()
    rows, places = np.frombuffer(data, np.int64, 2 * n, 4 + 3 * n).reshape(2, n).tolist()
    at = 4 + 19 * n
    before_at, last = at + sum(tails), b""
    for k in range(n):
        last = last[:shared[k]] + data[at:at + tails[k]]
        yield shared[k], last, data[before_at:before_at + befores[k]], rows[k], places[k]
        at += tails[k]
        before_at += befores[k]


def merge_runs(runs: list):
    """The items of sorted runs in order, each with the length it shares with the item before it: a loser tree whose
    nodes keep how much the loser shares with the last winner, so that only what is not known to agree is compared."""
    size = 1
    while size < len(runs):
        size *= 2
    sources = [iter(r) for r in runs] + [iter(())] * (size - len(runs))
    heads = [next(s, None) for s in sources]
    lcp = [-1 if h is None else 0 for h in heads]
    losers = [0] * size

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; both lengths are against the last string put out."""
        if lcp[x] != lcp[y]:
            return (x, y) if lcp[x] > lcp[y] else (y, x)
        if lcp[x] < 0:
            return x, y
        a, b, known = heads[x][1], heads[y][1], lcp[x]
        n = common_prefix(a, b, known)
        if n == len(a) or (n < len(b) and a[n] < b[n]):
            lcp[y] = n
            return x, y
        lcp[x] = n
        return y, x

    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if size > 1 else 0
    while heads[best] is not None:
        item = heads[best]
        yield lcp[best], *item[1:]
        heads[best] = step = next(sources[best], None)
        lcp[best] = -1 if step is None else step[0]
        node = (best + size) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


def repeated_windows(items: list[tuple]) -> np.ndarray:
    """For merged (lcp, suffix, before, row, at): a table of items by offset d, true where the item has the window and
    another item has an equal one."""
    n = len(items)
    out = np.zeros((n, SPAN), bool)
    if n < 2:
        return out
    lcp = np.array([x[0] for x in items])
    after, before = np.array([len(x[1]) for x in items]), np.array([len(x[2]) for x in items])
    backwards = [x[2][::-1] for x in items]
    order = sorted(range(n), key=backwards.__getitem__)
    lcs = np.zeros(n, np.int64)
    for k, (i, j) in enumerate(pairwise(order), 1):
        lcs[k] = common_prefix(backwards[i], backwards[j], 0)
    order = np.array(order)
    own = np.empty(n, np.int64)
    alive = np.flatnonzero((lcp >= GRAM) | np.append(lcp[1:] >= GRAM, False))
    for d in range(SPAN):
        has = alive[(after[alive] >= LENGTH - d) & (before[alive] >= d)]
        if len(has) < 2:
            continue
        own[order] = np.cumsum(lcs < d)
        both = np.cumsum(lcp < LENGTH - d)[has] * (n + 1) + own[has]
        by = np.argsort(both, kind="stable")
        same = np.diff(both[by]) == 0
        out[has[by[1:][same]], d] = True
        out[has[by[:-1][same]], d] = True
    return out


def _spans(items: list[tuple], found: np.ndarray) -> tuple[list, list, list]:
    """Rows, starts and ends of the runs of repeated windows."""
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    which, low = np.nonzero(edge == 1)
    high = np.nonzero(edge == -1)[1] - 1
    rows, at = np.array([x[3] for x in items], np.int64), np.array([x[4] for x in items], np.int64)
    return rows[which], at[which] - high, at[which] - low + LENGTH


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(row, spans): the byte ranges of each text that are repeated elsewhere; texts without any are left out."""
    found = anchors(rows)
    # Cut off by a checkpoint, so that both sides of the join are plain exchanges and a hot gram can be split.
    twice = saved(found.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"))
    spread = F.when(F.col("n") > BUCKET, F.ceil(F.col("n") / BUCKET)).otherwise(1).cast("int")
    places = found.join(twice, "gram").groupBy("row").agg(F.collect_set(F.struct("at", spread.alias("spread"))).alias("places"))
    places = stored(places, "anchors")
    total = places.agg(F.sum(F.size("places"))).first()[0] or 0
    buckets = int(total // BUCKET) + 1
    # A run holds RUN_BYTES, so that there are about this many for each of BUCKET places in a bucket.
    lanes = 1 + int(total * (2 * LENGTH + 150) // RUN_BYTES // BUCKET)

    def runs(batches):
        import zstandard

        open_, held, weight, lane = zstandard.ZstdDecompressor(), {}, 0, None
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                for row, body, marks in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    text = open_.decompress(body) if len(body) else b""
                    wanted = {m["at"]: m["spread"] for m in marks}
                    for a, h, first, last in zip(*(x.tolist() for x in segments(np.frombuffer(text, np.uint8))), strict=True):
                        if a not in wanted:
                            continue
                        suffix, before = text[a:last + LENGTH], text[first:a]
                        if wanted[a] > 1:
                            # Bucket numbers below 0: spread grams.
                            lane = row % lanes if lane is None else lane
                            salt = int.from_bytes(hashlib.blake2b(suffix + before, digest_size=8).digest()) % wanted[a]
                            bucket = -1 - (h + salt + lane * wanted[a]) % (1 << 40)
                        else:
                            bucket = h % buckets
                        same = held.setdefault(bucket, {}).setdefault((suffix, before), [])
                        weight += 150 if same else len(suffix) + len(before) + 150
                        same.append((row, a))
                if weight > RUN_BYTES:
                    yield from flush(held)
                    held, weight, lane = {}, 0, None
        yield from flush(held)

    def flush(held):
        copies = []
        for bucket, strings in held.items():
            items = sorted(((suffix, before, *refs[0]) for (suffix, before), refs in strings.items()), key=lambda x: x[0])
            for at in range(0, len(items), 20_000):
                yield piece(bucket, front_code(items[at:at + 20_000]))
            copies += [(row, a - len(before), a + len(suffix)) for (suffix, before), refs in strings.items() if len(refs) > 1 for row, a in refs]
        for at in range(0, len(copies), 20_000):
            block = np.array(copies[at:at + 20_000], np.int64).tobytes()
            # Ranges already known pass through a bucket of their own.
            yield piece(COPIES - int.from_bytes(hashlib.blake2b(block, digest_size=5).digest()), packed(block))

    def piece(bucket, block):
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([block], pa.binary())], names=["bucket", "run"])

    def settle(key, table):
        bucket = table.column("bucket")[0].as_py()
        if bucket <= COPIES:
            known = np.concatenate([np.frombuffer(opened(b.as_py()), np.int64).reshape(-1, 3) for b in table.column("run")])
            return pa.Table.from_arrays([*map(pa.array, known.T.copy()), pa.nulls(len(known), pa.binary())], names=["row", "start", "finish", "mark"])
        items = list(merge_runs([read_run(b.as_py()) for b in table.column("run")]))
        repeats = repeated_windows(items)
        r, s, e = _spans(items, repeats)
        columns = [[pa.array(r), pa.array(s), pa.array(e), pa.nulls(len(r), pa.binary())]]
        if bucket < 0:
            # The other buckets of the gram have to see these windows, the repeated ones once.
            prints, where, begin, seen = [], [], [], set()
            for k, (_, suffix, before, row, at) in enumerate(items):
                whole = before + suffix
                for d in range(LENGTH - len(suffix), len(before) + 1):
                    mark = hashlib.blake2b(whole[len(before) - d:len(before) - d + LENGTH], digest_size=16).digest()
                    if repeats[k, d]:
                        if mark in seen:
                            continue
                        seen.add(mark)
                    prints.append(mark)
                    where.append(row)
                    begin.append(at - d)
            columns.append([pa.array(where, pa.int64()), pa.array(begin, pa.int64()), pa.array([b + LENGTH for b in begin], pa.int64()), pa.array(prints, pa.binary())])
        return pa.concat_tables([pa.Table.from_arrays(c, names=["row", "start", "finish", "mark"]) for c in columns])

    texts = _packed(rows.select("row", "body"))
    sorted_runs = texts.join(places, "row").select("row", "body", "places").mapInArrow(runs, "bucket long, run binary")
    settled = stored(sorted_runs.groupBy("bucket").applyInArrow(settle, "row long, start long, finish long, mark binary"), "settled")
    spans = settled.filter("mark IS NULL").select("row", "start", "finish")
    open_marks = settled.filter("mark IS NOT NULL")
    again = open_marks.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark")
    spans = spans.unionByName(open_marks.join(again, "mark").select("row", "start", "finish"))
    return spans.groupBy("row").agg(F.collect_set(F.struct("start", "finish")).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs, in order."""
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["finish"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte ranges) and, if asked for,
    kept (the remaining bytes)."""
    rows = _texts(docs, key, text)
    spans = repeated_spans(rows)
    kind = docs.schema[key].dataType.simpleString()
    columns = (f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
               "removed array<struct<start: bigint, finish: bigint>>" + (", kept binary" if keep_text else ""))
    schema = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
              ("removed", pa.list_(pa.struct([("start", pa.int64()), ("finish", pa.int64())]))), ("kept", pa.binary())][:6 if keep_text else 5]

    def run(batches):
        import zstandard

        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                out = {n: [] for n, _ in schema}
                for body, own in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    data = open_.decompress(body) if len(body) else b""
                    cut = merged(own or [])
                    edges = [0, *[x for pair in cut for x in pair], len(data)]
                    kept = b"".join(data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
                    values = (len(data), len(data) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(),
                              [{"start": a, "finish": b} for a, b in cut], kept)
                    for (name, _), value in zip(schema, values, strict=False):
                        out[name].append(value)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(out[n], t) for n, t in schema]], names=["doc_id", *[n for n, _ in schema]])

    return _packed(rows).join(spans, "row", "left").select("doc_id", "body", "spans").mapInArrow(run, columns)


def dedup_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return deduplicate(docs, key, text, keep_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
