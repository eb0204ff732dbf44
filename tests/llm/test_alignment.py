"""Alignment of two tokenizers against a plain version over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqprep.llm import alignment
from seqprep.plans.inputs import table

SCHEMA = "doc_id bigint, text string, row bigint, n_a string, pairs int, best boolean"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(f"{alignment.FOLDER}/{alignment.FILE_A}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.FOLDER}/{alignment.FILE_B}")
    return a, b, alignment.Tokens(alignment.Files.read())


def plain_groups(libraries, text):
    """Groups of a whole text; none where the tokens do not join to it."""
    a, b, tokens = libraries
    data = (" " + (text or "")).encode()
    ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
    ids_b = b.encode(text or "")
    parts_a, parts_b = [tokens.bytes_a[i] for i in ids_a], [tokens.bytes_b[i] for i in ids_b]
    if not text or b"".join(parts_a) != data or b"".join(parts_b) != data:
        return []
    ends_a, ends_b = np.cumsum([len(p) for p in parts_a]).tolist(), np.cumsum([len(p) for p in parts_b]).tolist()
    both = sorted(set(ends_a) & set(ends_b))
    side = lambda ids, ends, x, y: [i for i, e in zip(ids, ends) if x < e <= y]
    if len(ids_a) > 3000:
        cut_a, cut_b = np.searchsorted(ends_a, both) + 1, np.searchsorted(ends_b, both) + 1
        return [
            (ids_a[x:y], ids_b[z:w])
            for x, y, z, w in zip([0, *cut_a[:-1]], cut_a, [0, *cut_b[:-1]], cut_b)
        ]
    return [(side(ids_a, ends_a, x, y), side(ids_b, ends_b, x, y)) for x, y in zip([0, *both], both)]


def plain_digests(libraries, rows):
    groups = [plain_groups(libraries, text) for _, text in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    held = Counter(pair for found in links for pair in set(found))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), g, found in zip(rows, groups, links):
        note = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        digest = hashlib.sha256(note.encode()).hexdigest() if g else ""
        counts = (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(found))
        best = sum(held[p] == most[p[0]] for p in found)
        out.append((doc_id, *counts, best, sum(held[p] for p in found), digest))
    return sorted(out, key=repr)


AWKWARD = [
    (1, "plain words here, and more."), (1, "plain words here, and more."), (2, None), (None, None), (3, ""), (4, " "),
    (5, "   "), (6, "two  spaces   three\n\n lines \n\t end "), (7, "▁literal sign"), (8, "ok ▁ later"), (9, "\x00 nul \x00"),
    (10, "<s> </s> <unk> <0x41> <|endoftext|>"), (11, "日本語のテキスト、空白なし。"), (12, "🙂🙃 a🙂b é é ﬁ Ⅳ"),
    (13, "a" * 5000), (14, "=" * 3001 + " x"), (None, "no id"), (15, "it's we'll I'M 1234567 0.5e-3"),
    (16, "nbsp  x　 y   z\x1c q \x85 r"), (17, "x\r\ny \r\n  z"), (18, "e" + "́" * 400), (19, "12 " * 4000),
]


def test_digests_equal_plain_version(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 40)
    docs = spark.createDataFrame([(*r, 5, "n", 1, True) for r in AWKWARD], SCHEMA)
    want = plain_digests(libraries, AWKWARD)
    for head in (alignment.HEAD, 20, 0):
        got = [tuple(r) for r in alignment.digests(docs, head=head).collect()]
        assert sorted(got, key=repr) == want, head
    assert alignment.digests(docs.limit(0)).count() == 0


def test_documents_equal_plain_version(spark, sf_dir, libraries):
    docs = table(spark, sf_dir, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r) for r in alignment.digests(docs, head=3000).collect()]
    assert sorted(got, key=repr) == plain_digests(libraries, rows)


def test_spans_are_the_groups(spark, libraries):
    docs = spark.createDataFrame(AWKWARD, "doc_id bigint, text string")
    found = {}
    for row in alignment.alignments(docs).filter(F.col("doc_id").isNotNull()).collect():
        cut = lambda ids, starts: [ids[x:y] for x, y in zip(starts, [*starts[1:], len(ids)])]
        found[row["doc_id"]] = list(zip(cut(row["a"], row["group_a"]), cut(row["b"], row["group_b"])))
    assert found == {i: plain_groups(libraries, text) for i, text in AWKWARD if i is not None}


def test_random_signs_are_encoded_by_unit_as_whole_texts(libraries):
    pick, signs = random.Random(3), ["a", "the", "Zé", ".", ",", "'s", "42", "\n", "\t", " ", "  ", " ", "　", "🙂", "▁", "\x1c"]
    texts = ["".join(pick.choices(signs, k=pick.randrange(1, 30))) for _ in range(1500)]
    chunk = alignment.align(texts, alignment.Units(libraries[2]))
    want = [";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain_groups(libraries, t)) for t in texts]
    assert [n.decode() for n in chunk.notations()] == want


def test_forgotten_units_and_wide_groups(libraries, monkeypatch):
    texts = [f"w{i} x{i % 7} yes" for i in range(400)]
    whole = alignment.align(texts, alignment.Units(libraries[2]))
    monkeypatch.setattr(alignment, "KEPT_SIGNS", 50)
    monkeypatch.setattr(alignment, "WIDE", 1)
    units = alignment.Units(libraries[2])
    parts = [alignment.align(texts[i : i + 50], units) for i in range(0, 400, 50)]
    assert [n for p in parts for n in p.notations()] == whole.notations()
    split = [list(map(tuple, np.transpose(p.pairs()[1:]).tolist())) for p in parts]
    assert sorted(sum(split, [])) == sorted(map(tuple, np.transpose(whole.pairs()[1:]).tolist()))


def test_dividing_finds_every_shared_cut():
    pick = np.random.default_rng(2)
    for share in (0.02, 0.3, 0.9):
        ends = [np.unique(np.append(np.flatnonzero(pick.random(3000) < share), 3000)) for _ in range(2)]
        tops = [np.array([0, len(e)]) for e in ends]
        starts = alignment.shared_cuts(*ends, *tops)
        both = np.intersect1d(*ends)[:-1]
        for e, s in zip(ends, starts):
            assert s.tolist() == [0, *(np.searchsorted(e, both) + 1).tolist()]
