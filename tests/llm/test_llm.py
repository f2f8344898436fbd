"""The operators of text preparation against brute force, on small and awkward inputs."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from worktide.llm import chat, decontam, licenses, lm, mixing, quality, secrets, simhash, suffixes, warc
from worktide.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"shared{i}" for i in range(60))
KEY = hashlib.sha1(b"x").hexdigest()
TEXTS = [
    None, "", " \n\t ", "one", "Word\x0bword", "é" * 300, PASSAGE, "before " + PASSAGE + " after", PASSAGE, "a b c d " * 40,
    f"token = {KEY}\nAll Rights Reserved. password: hunter22 \U0001F600 AKIA{'A1B2' * 5}",
    "Licensed under CC BY-NC 4.0.\nthis work is licensed under the GNU General Public License, version 3",
    "\n".join(f"line {i} of the text {i * i}" for i in range(200)), "x" * 5000, " ".join(f"w{i % 97}q{i}" for i in range(4000)),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality string, row string, at string, words string, work_ string, mix string"


def documents(spark, texts=TEXTS):
    rows = [(i, t, "en", None if i % 5 == 0 else f"host{i % 2}", None, "q", "r", "a", "w", "k", "m") for i, t in enumerate(texts)]
    if texts:
        rows.append(rows[6])  # a repeated row
        rows.append((None, "no id here", None, None, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, [])


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def words_of(text):
    return WORD.findall(text or "")


def test_suffix_dedup(docs, nothing):
    found = suffixes.dedup_report(docs).collect()
    data = [((r["doc_id"]), (r["text"] or "").encode()) for r in docs.collect()]
    starts = collections.Counter(t[i:i + 200] for _, t in data for i in range(len(t) - 199))
    expected = []
    for key, text in data:
        gone = bytearray(len(text))
        for i in range(len(text) - 199):
            if starts[text[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        expected.append((str(key), len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found) == sorted(expected)
    assert suffixes.dedup_report(nothing).count() == 0


def test_loser_tree_merges_runs_with_their_common_prefixes():
    rng = np.random.default_rng(1)
    strings = [bytes(rng.integers(97, 99, rng.integers(0, 12)).tolist()) for _ in range(300)]
    runs = [sorted((s, b"", k, k) for k, s in enumerate(strings) if k % 7 == part) for part in range(7)]
    merged = list(suffixes.merge_runs([suffixes.read_run(suffixes.front_code(r)) for r in runs if r]))
    assert [m[1] for m in merged] == sorted(strings)
    last = b""
    for shared, string, *_ in merged:
        assert shared == suffixes.common_prefix(last, string, 0)
        last = string


def test_spread_grams_give_the_same(docs, monkeypatch):
    usual = sorted(map(str, suffixes.dedup_report(docs).collect()))
    monkeypatch.setattr(suffixes, "BUCKET", 1)
    assert sorted(map(str, suffixes.dedup_report(docs).collect())) == usual


def test_copies_of_one_text_are_not_gathered_in_one_bucket(spark, monkeypatch):
    whole, limit, text = suffixes.repeated_windows, 100, " ".join(f"word{i}" for i in range(150))

    def bounded(items):
        assert len(items) <= limit, len(items)
        return whole(items)

    monkeypatch.setattr(suffixes, "repeated_windows", bounded)
    monkeypatch.setattr(suffixes, "BUCKET", 50)
    rows = [(i, text) for i in range(1500)] + [(1500 + i, f"own{i} {text[300:900]} end{i}") for i in range(20)] + [(1600, text[:250] + "x" * 40)]
    found = by_id(suffixes.dedup_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert all(found[i]["n_removed"] == len(text) for i in range(1500))
    assert all(found[1500 + i]["n_removed"] >= 600 for i in range(20)) and found[1600]["n_removed"] == 250


def test_quality_rules(spark, docs, nothing):
    found = by_id(quality.quality_report(docs))
    for r in docs.collect():
        words = words_of(r["text"])
        lines = [x for x in (r["text"] or "").split("\n") if words_of(x)]
        windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        covered = {p for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for p in range(i, i + 3)}
        got = found[r["doc_id"]]
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", r["text"] or "")), len(lines) - len(set(lines)), len(covered))
        assert got["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
    assert quality.quality_report(docs).count() == docs.count()
    assert quality.quality_report(nothing).count() == 0


def test_common_lines_go_and_depleted_documents_are_rejected(spark):
    good = [(i, "\n".join(f"{i} own words line {k} " + " ".join(f"u{i}x{k}y{j}" for j in range(9)) for k in range(6)) + "\nShared  FOOTER here") for i in range(30)]
    thin = [(100, "shared footer here\n" * 20 + "tiny text " * 3)]
    copies = [(200 + i, good[0][1].replace("Shared  FOOTER here", "")) for i in range(30)]
    df = spark.createDataFrame([(i, t, "h") for i, t in good + thin + copies], "doc_id long, text string, source string")
    rows, name = quality.judge(df)
    got = {r["doc_id"]: r for r in rows.select("doc_id", f"{name}.*").collect()}
    assert all(got[i]["removed_lines"] == 1 and "FOOTER" not in got[i]["text"] for i, _ in good)
    assert got[100]["removed_lines"] == 20 and not got[100]["kept"]
    # Copies of one page are no evidence of boilerplate.
    assert all(got[i]["kept"] and got[i]["removed_lines"] == 0 for i, _ in copies)


def test_warc_round_trip(spark, tmp_path):
    rows = [(5, "http://a/ü\r\n", "<p>same</p>"), (3, None, "<p>same</p>"), (3, None, "<p>same</p>"), (7, "u", None), (9, "u", ""), (1, "v", "é" * 40000), (None, "n", "null id")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, member string")
    got = warc.archive_report(pages, str(tmp_path / "warc")).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    expected = [(i, len((t or "").encode()), digest(t), "response" if first.get(t or "", i) == i else "revisit",
                 None if first.get(t or "", i) == i else first[t or ""]) for i, _, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert warc.archive_report(pages.limit(0), str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_reader_resumes_after_damage(packed):
    records = [warc.record("response", i, "u", b"payload %d " % i * 50, warc.digest_of(b"payload %d " % i * 50), 10) for i in range(5)]
    parts = [warc.member(r) if packed else r for r in records]
    spoiled = bytearray(parts[1])
    spoiled[len(spoiled) // 2] ^= 0xFF
    data = parts[0] + bytes(spoiled) + b"junk" + parts[2] + parts[3][:40] + parts[4]
    found = list(warc.salvage(data))
    assert [f["heads"]["warc-record-id"] for f in found if "heads" in f] == [f"<urn:page:{i}>" for i in (0, 2, 4)]
    gaps = [(f["offset"], f["length"]) for f in found if "gap" in f]
    assert gaps == [(len(parts[0]), len(parts[1]) + 4), (len(parts[0] + parts[1] + parts[2]) + 4, 40)]


def brute_fingerprint(text):
    import xxhash

    words = words_of((text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in prints}


def test_simhash(docs, nothing):
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.filter("doc_id IS NOT NULL").collect()}
    components = brute_components(prints)
    found = simhash.simhash_report(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        if r["doc_id"] is not None:
            assert (r["fingerprint"], r["component_id"]) == (f"{prints[r['doc_id']]:016x}", components[r["doc_id"]])
    kept = [r["doc_id"] for r in simhash.one_of_each(docs).select("doc_id").collect()]
    assert sorted(map(str, kept)) == sorted([*map(str, set(components.values())), "None"])
    assert simhash.simhash_report(nothing).count() == 0 and simhash.one_of_each(nothing).count() == 0


@pytest.mark.parametrize("bucket", [3, 4096])
def test_no_link_is_lost_in_large_buckets(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(3)
    prints = {}
    for i in range(240):
        value = int(rng.integers(0, 2**63)) if i % 40 == 0 else prints[i - 1] ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 7)), replace=False))
        prints[i] = value
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, i) for i, v in prints.items()], "bits long, node long")
    place = {(v - (1 << 64) if v >> 63 else v): i for i, v in prints.items()}
    pairs = [(place[r["a"]], place[r["b"]]) for r in simhash.links(nodes).collect()]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {i: found.get(i, i) for i in prints} == brute_components(prints)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (None, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert found == dict.fromkeys(range(201), 0) | {500: 500, 501: 500}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)


def test_secrets(docs, nothing):
    found = by_id(secrets.secret_report(docs))
    for r in docs.collect():
        text = r["text"] or ""
        spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        got = found[r["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert ",".join(x for x in got["spans"].split(",") if not x.startswith("random")) == listed
    assert secrets.secret_report(nothing).count() == 0
    clean = by_id(secrets.redact(docs))
    assert KEY not in clean[10]["text"] and "hunter22" not in clean[10]["text"] and clean[0]["text"] is None and clean[12]["text"] == TEXTS[12]


def test_randomness_battery(spark):
    rng = np.random.default_rng(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    random = ["".join(rng.choice(list(alphabet), 40)) for _ in range(60)]
    plain = [f"version{i}release{i}candidate_build_number_{i}" for i in range(200)] + ["aaaaaaaaaaaaaaaaaaaaaaaaa111"]
    rows = [(i, f"see {t} there") for i, t in enumerate(random + plain)]
    found = by_id(secrets.secret_report(spark.createDataFrame(rows, "doc_id long, text string")))
    hit = [i for i, r in found.items() if "random" in r["spans"]]
    assert sum(i < 60 for i in hit) >= 50 and sum(i >= 60 for i in hit) == 0


def test_licenses(docs, nothing):
    found = by_id(licenses.license_report(docs))
    for r in docs.collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r["text"] or "").translate(LOWER))
        places, labels = [], set()
        for phrase, label in licenses.BASE:
            parts = phrase.split()
            here = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
            places += here
            labels |= {label} if here else set()
        got = found[r["doc_id"]]
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(got["labels"].split(",")) and 0 <= got["score"] <= 1
    assert "cc-by-nc" in found[11]["labels"] and found[12]["labels"] == ""
    assert licenses.license_report(nothing).count() == 0


def test_lm_scores(docs, nothing):
    found = lm.score_report(docs).collect()
    rows = docs.collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(r["doc_id"], [*words_of((r["text"] or "").translate(LOWER)), None]) for r in rows]
    counts = collections.Counter(w for i, own in tokens if not held(i) for w in own)
    total = sum(counts.values())
    expected = sorted((str(i), held(i), len(own), sum(counts[w] > 0 for w in own), total,
                       round(sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own), 4)) for i, own in tokens)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in found) == expected
    assert all(r["score"] < 0 for r in found)
    assert lm.score_report(nothing).count() == 0


def test_mixer_is_a_distribution_and_learns():
    text = b"the cat sat on the mat and the dog sat on the log. " * 200
    grams, counts = lm.gram_counts([text])
    n0, n1 = np.zeros(lm.SLOTS, np.float32), np.zeros(lm.SLOTS, np.float32)
    for context, prefix, bit in lm._decisions(grams):
        for at in lm._slots(context, prefix):
            np.add.at(n1, at, counts * (bit == 1))
            np.add.at(n0, at, counts * (bit == 0))
    mixer = lm.Mixer(n0, n1)
    mixer.learn(grams, counts)
    rows = mixer.rows(np.array([0, 0x746865], np.uint32))
    assert np.allclose((10.0 ** rows).sum(axis=1), 1, atol=1e-3)
    scorer = lm.Scorer(mixer)
    known, noise = scorer.scores([text[:100], bytes(np.random.default_rng(0).integers(97, 123, 100).tolist())])
    assert known > noise / 2


def test_mixing(spark, docs, nothing):
    rows, labels = [], []
    rng = np.random.default_rng(2)
    for i in range(1800):
        kind = i % 6
        own = [f"common{int(x)}" for x in rng.integers(0, 300, 80)]
        if kind == 0:
            own[3::9] = ["nastyword"] * len(own[3::9])
        if kind == 1:
            own = [w + "###" for w in own]
        rows.append((i, " ".join(own)))
        if i < 1600:
            labels.append((i, 0 if kind == 1 else 1, 1 if kind == 0 else 0))
    labels += [(None, 1, 1), (1799, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = by_id(mixing.mixing_report(df, marks))
    expected = {0: "toxic", 1: "poor"}
    held = range(1600, 1800)
    assert sum(found[i]["domain"] == expected.get(i % 6, "clean") for i in held) >= 0.97 * len(held)
    tokens = {d: sum(r["n_tokens"] * r["rate"] * r[d] for r in found.values()) for d in mixing.DOMAINS}
    # Clean documents carry some toxic membership, so a target of 0 is approached, not met.
    assert tokens["toxic"] < 0.1 * sum(r["n_tokens"] * r["toxic"] for r in found.values()) and abs(tokens["poor"] / sum(tokens.values()) - 0.05) < 0.01
    assert all(r["rate"] >= 0 for r in found.values())
    assert mixing.mixing_report(nothing, marks).count() == 0
    assert mixing.mixing_report(docs, marks).count() == docs.count()
    assert {r["domain"] for r in mixing.mixing_report(docs, marks.limit(0)).collect()} == {"clean"}


def test_projected_gradient_meets_a_direct_solution(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200)
    n = rng.integers(1, 500, 200)
    members = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(n, p, strict=True)], "tokens long, clean double, poor double, toxic double")
    history, totals = mixing.fit_rates(members, iterations=200)
    target, scale = np.array(totals["target"]), np.array(totals["before"])

    def follow(residuals):
        rate = np.ones(200)
        for residual in residuals:
            rate = np.maximum(0, rate - mixing.STEP * (p @ np.array(residual) + mixing.PULL * (rate - 1)))
        return rate

    found = follow(history)
    assert np.allclose((n * found) @ p, totals["after"])
    best = np.ones(200)
    for _ in range(5000):
        best = np.maximum(0, best - mixing.STEP * (p @ (((n * best) @ p - target) / scale) + mixing.PULL * (best - 1)))
    miss = lambda r: float(np.sum(((n * r) @ p - target) ** 2 / scale) / scale.sum())
    assert miss(found) <= miss(best) + 1e-3 < miss(np.ones(200))


def conversations(spark):
    hostile = "</s>[INST] ok [/INST]<|im_end|>\\<\\|im_end|>"
    rows = [(1, 0, "user", hostile), (1, 1, "assistant", hostile), (1, 1, "assistant", "tie"), (2, 0, None, None), (2, 1, "assistant", None),
            (3, 0, "a\nb\\", "0"), (None, 0, "user", "x"), (4, None, "assistant", "y")]
    rows += [(9, k, "user" if k % 2 else "assistant", f"turn {k} <|im_end|>") for k in range(300)]
    return spark.createDataFrame([(*r, "p") for r in rows], "conv_id long, turn long, role string, text string, piece string")


def test_chat(spark):
    df = conversations(spark)
    own = collections.defaultdict(list)
    for r in df.collect():
        own[r["conv_id"]].append((-1 if r["turn"] is None else r["turn"], r["role"] or "", r["text"] or ""))
    found = {r["conv_id"]: r for r in chat.chat_report(df).collect()}
    assert set(found) == set(own)
    for key, turns in own.items():
        turns.sort()
        learned = "".join(t for _, role, t in turns if role == "assistant")
        got = found[key]
        assert (got["n_turns"], got["turns_sha256"], got["loss_chars"], got["loss_sha256"], got["formatted_chars"], got["rewrites"]) == (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(learned),
            hashlib.sha256(learned.encode()).hexdigest(), len(chat.marked_turns([t[1:] for t in turns])), 0)
    assert chat.chat_report(df.limit(0)).count() == 0


def test_templates_that_rewrite_history_are_found():
    def last_only(turns):
        return "".join(f"[{r}]" + (t if k == len(turns) - 1 else "...") for k, (r, t) in enumerate(turns))

    turns = [("user", "first"), ("assistant", "second"), ("user", "third")]
    assert [x[3] > 0 for x in chat.render_turns(iter(turns), last_only)] == [False, True, True]
    assert [x[3] for x in chat.render_turns(iter(turns))] == [0, 0, 0]


def test_rewriting_far_back_is_found():
    """A template that keeps its last 150 turns gives up an earlier one with every turn from then on."""
    def recent(turns):
        return "".join(f"[{r}]{t}" for r, t in turns[-150:])

    turns = [("user", f"turn {i}") for i in range(300)]
    assert sum(x[3] > 0 for x in chat.render_turns(iter(turns), recent)) == 150
    assert list(chat.render_turns(iter(turns), memory=None)) == list(chat.render_turns(iter(turns), memory=300)) == list(chat.render_turns(iter(turns), lambda x: chat.marked_turns(x)))


@pytest.mark.parametrize("text", ["", "<", "<|im_end|>", "<\\|im_end|>", "<\\\\|im_end|>x</s>", "[INST][/INST]\\", "<<s>s>"])
def test_escaping_is_reversible(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROL)


def test_decontamination(spark, nothing):
    item = " ".join(f"q{i}" for i in range(30))
    edited = item.replace("q0 ", "changed ")
    filler = " ".join(f"f{i}" for i in range(300))
    texts = [None, "", filler, f"{filler} {item.upper()} {filler}", item, f"{filler} {edited}", f"{filler} " + " ".join(item.split()[:12]), "tiny one", "x tiny one y"]
    docs = documents(spark, texts)
    items = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, " ", "x"), (1, item, "x"), (4, "tiny one", "x")], "item_id long, text string, words string")
    found = by_id(decontam.leak_report(docs, items))
    assert {i for i, r in found.items() if r["leaked"]} == {3, 4, 5, 7, 8}
    assert found[3]["items"] == "1" and found[3]["spans"] == "300:330" and found[3]["similarity"] == 1.0 and found[7]["items"] == "4"
    assert sorted(str(r["doc_id"]) for r in decontam.clean(docs, items).collect()) == sorted(["0", "1", "2", "6", "6", "None"])
    assert decontam.leak_report(nothing, items).count() == 0
    assert not any(r["leaked"] for r in decontam.leak_report(docs, items.limit(0)).collect())


def test_items_with_an_altered_end_are_found(spark):
    rng = np.random.default_rng(11)
    items = [[f"w{rng.integers(5000)}" for _ in range(n)] for n in range(15, 60) for _ in range(4)]
    docs, expected = [], set()
    for i, words in enumerate(items):
        cut = max(1, len(words) // 10)
        copy = words[:-cut] + [f"new{i}x{k}" for k in range(cut)]
        own, other = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (words, copy))
        if len(own & other) / max(len(own), len(other)) >= 0.81:
            expected.add(i)
        docs.append((i, " ".join([*(f"f{i}x{k}" for k in range(40)), *copy, "tail"])))
    assert len(expected) > 100
    found = by_id(decontam.leak_report(spark.createDataFrame(docs, "doc_id long, text string"),
                                       spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")))
    assert not [i for i in expected if found[i]["items"] != str(i)]
    assert all(r["similarity"] >= 0.8 for r in found.values() if r["leaked"])


def test_hamming_blocks_cover_the_radius():
    rng = np.random.default_rng(6)
    for _ in range(500):
        flips = rng.choice(decontam.BLOCKS * decontam.BLOCK_BITS, decontam.RADIUS, replace=False)
        assert min(collections.Counter(int(b) // decontam.BLOCK_BITS for b in flips).get(k, 0) for k in range(decontam.BLOCKS)) <= decontam.BLOCK_RADIUS


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_leaks_are_those_of_brute_force(spark, monkeypatch, limit):
    """Items of 2 to 60 words with words replaced, cut out and put in at random: the items found are those whose window passes."""
    for name in ("BROADCAST_WINDOWS", "BROADCAST_ROWS"):
        monkeypatch.setattr(decontam, name, limit)
    rng = np.random.default_rng(21)
    items = [[f"w{x}" for x in rng.zipf(1.4, n) % 3000] for n in [2, 4, *range(8, 61, 4)] for _ in range(3)]
    docs = []
    for i, words in enumerate(items):
        copy = list(words)
        for _ in range(int(rng.integers(0, 3))):
            at, kind = int(rng.integers(len(copy))), int(rng.integers(3))
            copy[at:at + (kind < 2)] = [] if kind == 0 and len(copy) > 2 else [f"new{rng.integers(9)}"]
        docs.append((i, " ".join([*(f"f{rng.integers(50)}" for _ in range(30)), *copy, *(f"f{rng.integers(50)}" for _ in range(10))])))
    docs.append((900, "w1 w2"))
    shingles = [{tuple(w[k:k + min(5, len(w))]) for k in range(len(w) - min(5, len(w)) + 1)} for w in items]
    known = [(w, s) for k, (w, s) in enumerate(zip(items, shingles, strict=True))]
    df = collections.Counter(x for s in shingles for x in s)
    unit = 1 << 40
    weight = {x: round(math.log(1 + len(items) / n) * unit) for x, n in df.items()}
    expected = set()
    for key, text in docs:
        words = text.split()
        for item, (own, s) in enumerate(known):
            sum_item, rarest = sum(weight[x] for x in s), max(weight[x] for x in s)
            sizes = {len(w) for w in items if abs(len(w) - len(own)) <= len(own) * (1 - 0.8)}
            for n in sizes:
                size = min(5, n)
                for start in range(len(words) - n + 1):
                    win = words[start:start + n]
                    have = {tuple(win[k:k + size]) for k in range(n - size + 1)}
                    both = sum(weight[x] for x in have & s)
                    if both and both / max(sum_item, both + (len(have) - len(have & s)) * rarest) >= 0.8:
                        expected.add((key, item))
    found = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == expected and len(expected) > 30


def test_the_hamming_index_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(7)
    items = [[f"w{x}" for x in rng.integers(0, 4000, n)] for n in range(15, 60)]
    copies = [w[:-max(1, len(w) // 12)] + [f"new{k}" for k in range(max(1, len(w) // 12))] for w in items] + [[f"o{x}" for x in rng.integers(0, 4000, 30)] for _ in range(50)]
    table = decontam.item_table(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))
    windows = spark.createDataFrame([(i, w, len(w)) for i, w in enumerate(copies)], "win long, words array<string>, n int")
    for half, name in enumerate(("low", "high")):
        windows = windows.withColumn(name, decontam.fingerprint(windows["words"], half))
    found = {(r["win"], r["entry"]["item_id"]) for r in decontam.hamming_pairs(windows, table).collect()}
    marks = {r["item_id"]: (r["low"], r["high"]) for r in table.select("item_id", *[decontam.fingerprint(table["words"], h).alias(c) for h, c in enumerate(("low", "high"))]).collect()}
    mask = (1 << 64) - 1
    expected = {(r["win"], i) for r in windows.collect() for i, (low, high) in marks.items()
                if abs(r["n"] - len(items[i])) <= 0.2 * len(items[i]) + 1e-9
                and ((r["low"] ^ low) & mask).bit_count() + ((r["high"] ^ high) & mask).bit_count() <= decontam.RADIUS}
    assert found == expected and sum((i, i) in found for i in range(len(items))) >= 0.9 * len(items)


def test_a_footer_that_is_the_longest_line_goes(spark):
    footer = "the site's footer that is longer than any line of its pages " * 3
    df = spark.createDataFrame([(i, "\n".join(" ".join(f"p{i}x{k}w{j}" for j in range(9)) for k in range(12)) + "\n" + footer, "h") for i in range(300)],
                               "doc_id long, text string, source string")
    assert all(r["removed_lines"] == 1 and r["kept"] for r in quality.quality_report(df).collect())
    few = quality.quality_report(df, min_documents=1, host_share=2.0, max_documents=299).collect()
    assert all(r["removed_lines"] == 1 for r in few) and not any(r["removed_lines"] for r in quality.quality_report(df, host_share=2.0).collect())


def test_texts_that_share_an_id_are_kept_apart(spark):
    rows = [(1, " ".join(f"a{k}" for k in range(60))), (1, " ".join(f"b{k}" for k in range(60))), (2, " ".join(f"a{k}" for k in range(60))), (3, None), (4, "")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], (r["text"] or "")[:2]) for r in kept) == [(1, "a0"), (1, "b0"), (3, "")]


def test_pipeline(spark, docs, nothing):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    for start in (docs, nothing):
        current = start
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, current, folder)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert after.columns == current.columns
            current = spark.createDataFrame(after.collect(), after.schema)
    assert corpus_pipeline.run(spark, folder).count() > 0
