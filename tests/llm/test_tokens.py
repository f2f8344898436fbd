"""Piece encoding, token alignment and spelling variants against the libraries and brute force."""

from __future__ import annotations

import bisect
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from worktide.llm import alignment, pieces, spelling
from worktide.llm.queries import piece_model, tokenizer_file

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")

AWKWARD = [
    None, "", " ", "\n", "\t \n", "a", " a", "a ", "  two  spaces  ", "line\nline\n\n  end\r\n", "▁ marker ▁▁x", "</s> <s> <|endoftext|>", "<0x0A>",
    "café naïve Ünïcode", "ﬁ ① 　 wide nbsp ​zero﻿", "日本語のテキスト 中文", "🙂🙃 👩‍👩‍👧", "x" * 3000, "don't we'll 123,456.78 #tags", "\x00nul \x1c\x1d sep",
    " ".join(f"w{i % 97}q{i}" for i in range(3000)), "word " * 500, "same text", "same text", "tab\tseparated\tvalues", "᠎ odd",
]
SCHEMA = "doc_id long, text string, ids string, block string, word string, n long"


def frame(spark, texts):
    rows = [(i, t, "c", "b", "w", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *rows[-1:], (None, "no id", None, None, None, None)] if rows else [], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, AWKWARD).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def test_piece_encoding_is_the_librarys(docs, nothing):
    processor = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    expected = []
    for row in docs.collect():
        ids = [*processor.encode(row["text"] or ""), processor.eos_id()]
        expected.append((str(row["doc_id"]), len(ids), sha(" ".join(map(str, ids))), sha(processor.decode(ids))))
    found = pieces.encoding_report(docs, piece_model()).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found) == sorted(expected)
    assert pieces.encoding_report(nothing, piece_model()).count() == 0


def test_pieces_pass_other_columns_through_and_name_clashes(docs):
    rows = pieces.decode(pieces.encode(docs, piece_model(), name="tokens", add_end=False), piece_model(), "tokens", "back")
    assert rows.columns == [*docs.columns, "tokens", "back"]
    assert {r["back"] for r in rows.filter("text like '%café%'").collect()} == {"café naïve Ünïcode"}
    with pytest.raises(ValueError):
        pieces.encode(docs, piece_model())


def test_a_table_that_is_emptied_gives_the_same(monkeypatch):
    segmenter = pieces.Segmenter(piece_model())
    assert segmenter.by_chunk
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n▁é日") for _ in range(rng.randrange(60))) for _ in range(400)]
    table = pieces.ChunkTable(segmenter.segment)
    monkeypatch.setattr(pieces, "TABLE_CHUNKS", 20)
    for text in texts:
        if table.full():
            table.empty()
        assert table.gather(table.rows(segmenter.chunks(text)))[0].tolist() == segmenter.model.encode(text)


def test_galloping_finds_all_common_ends():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, rng.integers(2, 400), rng.integers(0, 80))).tolist() for _ in range(2))
        ours, theirs = alignment.common_ends(a, b)
        assert [a[i] for i in ours] == [b[j] for j in theirs] == sorted({*a} & {*b})
    assert alignment.common_ends([5, 100_000], list(range(200_000)))[1].tolist() == [5, 100_000]


def brute_alignment(rows):
    """Whole texts through the libraries, every pair of tokens by its byte range."""
    processor = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    byte_level = tokenizers.Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    byte_level.encode_special_tokens = True
    printable = alignment._byte_of_char()
    per, held = [], Counter()
    for key, text in rows:
        a = b = []
        if text:
            a = byte_level.encode(" " + text, add_special_tokens=False).ids
            b = processor.encode(text)
        sides = [[(i, bytes(printable[c] for c in byte_level.id_to_token(i))) for i in a],
                 [(i, bytes([int(processor.id_to_piece(i)[3:5], 16)]) if processor.is_byte(i) else processor.id_to_piece(i).replace("▁", " ").encode()) for i in b]]
        if not text or any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
            sides = [[], []]
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in sides]
        both = sorted({*ends[0]} & {*ends[1]})
        groups = [([], []) for _ in both]
        for k in (0, 1):
            for (i, _), end in zip(sides[k], ends[k], strict=True):
                groups[bisect.bisect_left(both, end)][k].append(i)
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        held.update(links.keys())
        per.append((key, len(sides[0]), len(sides[1]), groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for key, na, nb, groups, links in per:
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (str(key), na, nb, len(groups), sum(links.values()), sum(n for p, n in links.items() if held[p] == most[p[0]]),
               sum(n * held[p] for p, n in links.items()), sha(spelled) if na else "")


@pytest.mark.parametrize("block_bytes", [1, 4000, 8 << 20])
def test_alignment(docs, nothing, monkeypatch, block_bytes):
    if block_bytes == 4000:
        monkeypatch.setattr(alignment, "TABLE_CHUNKS", 10)
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    found = alignment.link_report(docs, definition, piece_model(), block_bytes=block_bytes).collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted((str(r["doc_id"]), *[r[c] for c in names]) for r in found) == sorted(brute_alignment([(r["doc_id"], r["text"]) for r in docs.collect()]))
    if block_bytes == 1:
        assert alignment.link_report(nothing, definition, piece_model()).count() == 0


def test_large_groups_are_counted_by_their_ids(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 9, 200)
    cuts = np.array([0, 120, 121, 300]), np.array([0, 90, 95, 200])
    plain = alignment.link_pairs(a, b, *cuts, 100)
    monkeypatch.setattr(alignment, "PLAIN_LINKS", 3)
    for x, y in zip(plain, alignment.link_pairs(a, b, *cuts, 100), strict=True):
        assert x.tolist() == y.tolist()


def brute_spelling(rows, shortest=5, least=3):
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for key, text in rows:
        run = ""
        for c in (text or "").translate(lower) + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                at = h % len(run)
                counts[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}

    def near(x, y):
        if abs(len(x) - len(y)) > 1 or x == y:
            return False
        if len(x) == len(y):
            return sum(p != q for p, q in zip(x, y, strict=True)) == 1
        x, y = sorted((x, y), key=len)
        return any(y[:i] + y[i + 1:] == x for i in range(len(y)))

    out, forms = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v)) if others else None
        forms[w] = best if best and words[best] >= 2 * n else None
        out[w] = (len(others), forms[w])
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        yield w, forms[w], root, n, out[w][0], words.get(forms[w])


VARIANTS = [
    "center centre centers centerx center center", "Center CENTER center centre centre centre ", "colour color color colour colour color color " * 5,
    "aaaaa aaaaaa aaaaaaa " * 3 + "aaaaa " * 10 + "aaaaaa " * 30, "ÀÉÎÕÜ àéîõü ÀÉÎÕÜ ÀÉÎÕÝ àéîõü " * 4, None, "", "a bb ccc dddd", "x" * 400 + " ", "x" * 400, "x" * 400 + " " + "x" * 399, "x" * 399, "x" * 399 + "×÷abc",
    *[f"variant{c} " * (1 + i) for i, c in enumerate("abcdefghij")], *["the quick wordy wordx wordz words " * (i % 5) for i in range(40)],
]


def test_spelling(spark, nothing):
    docs = frame(spark, VARIANTS)
    names = ("word", "form", "root", "n", "n_near", "form_n")
    expected = sorted(map(str, brute_spelling([(r["doc_id"], r["text"]) for r in docs.collect()])))
    assert sorted(str(tuple(r[c] for c in names)) for r in spelling.variant_report(docs).collect()) == expected
    assert spelling.variant_report(nothing).count() == 0


def test_full_filters_lose_no_word(spark, monkeypatch):
    """One block a length for all words: the filter lets nearly everything through, the join keeps the result right."""
    docs = frame(spark, VARIANTS)
    words = spelling.vocabulary(docs, least=1).cache()
    monkeypatch.setattr(spelling, "PROBES", 100)
    alphabet = sorted({c for r in words.collect() for c in r["word"]})
    pairs = [spelling.near_pairs(words, spelling.build_filters(words, most=most), alphabet) for most in (1, 1 << 19)]
    found = [sorted((r["word"], r["near"]) for r in p.collect()) for p in pairs]
    assert found[0] == found[1] and len(found[0]) > 20
