"""Secret scans: three base patterns, and strings that look random by a battery of statistical tests.

Every maximal run of encoding characters is a candidate; its alphabet (hex, base32, alphanumeric, base64) is inferred
from the characters it uses. Three tests ask how a written string would differ from a uniformly random one: chi-squared
of the character classes over the alphabet, the number of runs of letter case and digits, and the serial correlation of
neighbouring codes. Each gives the probability that such a string is as even as seen without being random; the
largest of them counts, and a Benjamini-Hochberg cut per length class and encoding, made over all candidates of the
corpus, decides.

Null texts are empty, an empty table gives no rows, repeated rows give the same spans each, other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import free_name, whole

# The base patterns and the lengths below which a match is dropped.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 20
HEX = r"[0-9a-f]+"
HEX_LENGTH = 24
KINDS = ("assign", "access", "hex", "random")

#: Shortest candidate of the battery.
CANDIDATE_LENGTH = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % CANDIDATE_LENGTH
#: False discovery rate.
FDR = 0.01
#: p-values are compared on a grid of tenths of a decade, down to 1e-30.
GRID, GRID_LEAST = 10, 300

#: Encodings by the characters they use, first fit: name, pattern, alphabet size, and what ordinary strings of such
#: characters look like: the chance that two of their characters agree, and that neighbours differ in class.
ENCODINGS = (
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", 16, 0.12, 0.25),
    ("base32", "^[A-Z2-7]+=*$", 32, 0.068, 0.15),
    ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", 36, 0.065, 0.15),
    ("base64", "^[A-Za-z0-9+/_=-]+$", 64, 0.060, 0.25),
)
_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_="


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, within a few per cent of itself."""
    a = F.abs(z)
    tail = F.exp(-0.717 * a - 0.416 * a * a) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _located(hits: Column, pieces: Column) -> Column:
    """Matches with their places: what stands between them, and they themselves, add up to the offset."""
    size = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + F.length(x))
    return F.transform(hits, lambda v, i: F.struct(
        (size(F.slice(pieces, F.lit(1), i + 1)) + size(F.slice(hits, F.lit(1), i))).alias("start"), v.alias("value")))


def encoding_of(value: Column) -> Column:
    found = F.lit(ENCODINGS[-1][0])
    for name, pattern, *_ in reversed(ENCODINGS[:-1]):
        found = F.when(value.rlike(pattern), name).otherwise(found)
    return found


def _of_encoding(value: Column, field: int) -> Column:
    found = F.lit(float(ENCODINGS[-1][field]))
    for item in reversed(ENCODINGS[:-1]):
        found = F.when(value.rlike(item[1]), float(item[field])).otherwise(found)
    return found


def length_class(value: Column) -> Column:
    """0 for 20-31 characters, 1 for 32-63 and so on, by doubling."""
    return F.least(F.greatest(F.length(F.bin(F.length(value).cast("long"))) - 5, F.lit(0)), F.lit(6))


def battery(value: Column) -> Column:
    """The p-value of a candidate: how likely an ordinary string of its length and encoding looks as random."""
    n = F.length(value).cast("double")
    chars = F.split(value, "")
    chars = F.filter(chars, lambda c: c != "")
    codes = F.transform(chars, lambda c: F.instr(F.lit(_ALPHABET), c).cast("double"))
    classes = F.transform(chars, lambda c: F.when(c.between("0", "9"), 0).when(c.between("A", "Z"), 1).when(c.between("a", "z"), 2).otherwise(3))
    # Chi-squared of the alphabet is k / n * (n + 2 * agreeing pairs) - n: the pairs that agree carry all of it.
    agree = _total(F.transform(chars, lambda c: n - F.length(F.replace(value, c, F.lit("")))))
    pairs, all_pairs = (agree - n) / 2, n * (n - 1) / 2
    expected = all_pairs * _of_encoding(value, 3)
    uniform = all_pairs / _of_encoding(value, 2)
    z_chi = (expected - pairs) / F.sqrt(expected + 2 * n * F.pow(_of_encoding(value, 3), 2))
    # Far more agreement than chance gives is no random string, whatever the other tests say.
    fits = (pairs - uniform) / F.sqrt(uniform + 1) <= 4
    changes = _total(F.zip_with(F.slice(classes, F.lit(1), F.size(classes) - 1), F.slice(classes, F.lit(2), F.size(classes) - 1),
                                lambda a, b: F.when(a != b, 1.0).otherwise(0.0)))
    rate = _of_encoding(value, 4)
    z_runs = (changes - (n - 1) * rate) / F.sqrt((n - 1) * rate * (1 - rate))
    mean = _total(codes) / n
    spread = _total(F.transform(codes, lambda x: (x - mean) * (x - mean)))
    serial = _total(F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
                               lambda a, b: (a - mean) * (b - mean))) / F.greatest(spread, F.lit(1e-9))
    # Neighbouring codes of a random string are uncorrelated.
    independent = F.abs(serial + 1 / (n - 1)) * F.sqrt(n) <= 3
    z = (z_chi + z_runs) / 2 ** 0.5
    return F.when(fits & independent, upper_tail(z)).otherwise(1.0)


def candidates(values: Column) -> Column:
    """(start, value, group, p) of the candidates among located strings: those with both letters and digits."""
    mixed = F.filter(values, lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]"))
    return F.transform(mixed, lambda x: F.struct(
        x["start"].alias("start"), x["value"].alias("value"),
        F.concat_ws(":", encoding_of(x["value"]), length_class(x["value"]).cast("string")).alias("group"),
        battery(x["value"]).alias("p")))


def grid(p: Column) -> Column:
    """The p-value's place on the grid; larger is smaller p."""
    return F.when(p <= 0, GRID_LEAST).otherwise(F.least(F.floor(-F.log10(p) * GRID), F.lit(GRID_LEAST))).cast("int")


def _strings(docs: DataFrame, text: str, work: str) -> DataFrame:
    """``docs`` with a struct ``work`` holding the candidates."""
    body = whole(docs[text])
    rows = docs.withColumn(work, F.struct(body.alias("b")))
    b = F.col(f"{work}.b")
    rows = rows.withColumn(work, F.struct(b.alias("b"), F.regexp_extract_all(b, F.lit(CANDIDATE), F.lit(0)).alias("hits"),
                                          F.split(b, CANDIDATE, -1).alias("pieces")))
    hits = F.col(f"{work}.hits")
    placed = F.when(F.size(hits) > 0, _located(hits, F.col(f"{work}.pieces")))
    rows = rows.withColumn(work, F.struct(b.alias("b"), placed.alias("placed")))
    none = F.array().cast("array<struct<start:int,value:string,group:string,p:double>>")
    return rows.withColumn(work, F.struct(b.alias("b"), F.coalesce(candidates(F.col(f"{work}.placed")), none).alias("found")))


def thresholds(docs: DataFrame, text: str = "text", fdr: float = FDR) -> dict[str, int]:
    """For each encoding and length class the least grid place that is a discovery (Benjamini-Hochberg).

    Counts of all candidates, at most ``GRID_LEAST + 1`` for each of 4 encodings and 7 length classes, come to the driver.
    """
    found = _strings(docs.select(docs[text].alias("text")), "text", "w").select(F.explode("w.found").alias("x"))
    counts = found.groupBy(F.col("x.group").alias("group"), grid(F.col("x.p")).alias("place")).count().collect()
    result = {}
    for group in {row["group"] for row in counts}:
        own = sorted(((row["place"], row["count"]) for row in counts if row["group"] == group), reverse=True)
        total, so_far = sum(n for _, n in own), 0
        for place, n in own:
            so_far += n
            if 10 ** (-place / GRID) <= fdr * so_far / total:
                result[group] = place
    return result


def scan(docs: DataFrame, text: str = "text", fdr: float = FDR, carry: list[str] | None = None, name: str = "secrets") -> tuple[DataFrame, str]:
    """The columns ``carry`` of ``docs`` (all when not given) and one more, an array of (start, finish, kind, rank), by
    start and then in the order of ``KINDS``; offsets are code points, the end exclusive."""
    carry = docs.columns if carry is None else carry
    cuts = thresholds(docs, text, fdr)
    work = free_name(docs, "work_")
    rows = _strings(docs, text, work)
    b, found = F.col(f"{work}.b"), F.col(f"{work}.found")
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": r"[0-9a-f]{%d,}" % HEX_LENGTH}
    hits = {k: F.regexp_extract_all(b, F.lit(v), F.lit(0)) for k, v in patterns.items()}
    pieces = {k: F.split(b, v, -1) for k, v in patterns.items()}
    # A text without a match costs one search; places are worked out for the others.
    rows = rows.withColumn(work, F.struct(found.alias("found"), *[
        F.when(b.rlike(v), F.struct(hits[k].alias("hits"), pieces[k].alias("pieces"))).alias(k) for k, v in patterns.items()]))

    def span(kind: str):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                  (x["start"] + F.length(x["value"])).alias("finish"), F.lit(kind).alias("kind"))

    keeps = {"assign": lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 2)) >= ASSIGN_VALUE,
             "access": lambda x: F.length(x["value"]) >= ACCESS_LENGTH, "hex": lambda x: F.length(x["value"]) >= HEX_LENGTH}
    empty = F.array().cast("array<struct<start:int,rank:int,finish:int,kind:string>>")
    parts = []
    for kind in patterns:
        at = f"{work}.{kind}"
        placed = F.filter(_located(F.col(f"{at}.hits"), F.col(f"{at}.pieces")), keeps[kind])
        parts.append(F.when(F.col(at).isNull(), empty).otherwise(F.transform(placed, span(kind))))
    random = F.filter(F.col(f"{work}.found"), lambda x: grid(x["p"]) >= _cut(cuts, x["group"])) if cuts else empty
    parts.append(F.transform(random, span("random")) if cuts else empty)
    name = free_name(docs, name)
    return rows.select(*[docs[c] for c in carry], F.sort_array(F.concat(*parts)).alias(name)), name


def _cut(cuts: dict[str, int], group: Column) -> Column:
    chosen = F.lit(GRID_LEAST + 1)
    for name, place in cuts.items():
        chosen = F.when(group == name, place).otherwise(chosen)
    return chosen


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["finish"].cast("string"))), ",")


def secret_report(docs: DataFrame, key: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per document: its base spans counted and digested, and all spans."""
    rows, name = scan(docs, text, fdr, carry=[key])
    s = F.col(name)

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(F.col(key).alias("doc_id"), count("assign"), count("access"), count("hex"),
                       F.sha2(listed(F.filter(s, lambda x: x["kind"] != "random")), 256).alias("base_sha256"), listed(s).alias("spans"))


def redact(docs: DataFrame, text: str = "text", fdr: float = FDR, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with every span of its texts, overlapping ones merged, replaced by ``mark``; null texts stay null."""
    rows, name = scan(docs, text, fdr)
    s, t = F.col(name), F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(a: Column, x: Column) -> Column:
        apart = x["start"] >= a["at"]
        done = F.when(apart, F.concat(a["done"], F.substring(t, a["at"] + 1, x["start"] - a["at"]), F.lit(mark))).otherwise(a["done"])
        return F.struct(F.greatest(a["at"], x["finish"]).alias("at"), done.alias("done"))

    clean = F.aggregate(s, start, step, lambda a: F.concat(a["done"], F.substring(t, a["at"] + 1, F.length(t))))
    changed = F.when(F.size(s) > 0, clean).otherwise(t)
    return rows.select(*[changed.alias(c) if c == text else F.col(c) for c in docs.columns])
