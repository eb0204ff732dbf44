"""The operators against plain versions of themselves, and on awkward rows."""

from __future__ import annotations

import itertools
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqprep.llm import (
    catalog,
    decontaminate,
    edits,
    host_rules,
    languages,
    licenses,
    mixture,
    near_dups,
    neural_lm,
    shards,
    suffixes,
    words,
)
from seqprep.plans.inputs import table

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, shard int"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int, stock: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(stock)}x" for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, clashing names."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a", 5, "n", 3),
        (1, base, "en", "a", 5, "n", 3),
        (2, base + " tail", "en", None, None, None, None),
        (3, None, "en", "a", 0, None, 1),
        (4, "", None, "b", 0, "x", 1),
        (5, " \n\t ", "de", "b", 0, "x", 1),
        (6, "one two", "de", "b", 0, "x", 1),
        (7, "One  TWO", "de", None, 0, "x", 1),
        (None, prose(2, 60), "en", "a", 0, "x", 1),
        (None, None, None, None, None, None, None),
        (8, prose(3, 30_000), "en", "ü", 0, "x", 1),
        (9, "...!!! 123", "fr", "b", 0, "x", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, prose(3, 40)), (2, "one two"), (2, "one two"), (3, None), (None, prose(1, 20)), (4, "")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def every(docs, items):
    return {
        "op1": licenses.license_notices(docs),
        "op2": suffixes.repeated_spans(docs),
        "op3": host_rules.judge(docs),
        "op4": shards.shards(docs),
        "op5": near_dups.near_duplicates(docs),
        "op6": edits.count_edited(docs, catalog.document_edits()),
        "op7": mixture.mix(docs),
        "op8": languages.identify(docs),
        "op9": neural_lm.score(docs),
        "op10": decontaminate.contamination(docs, items),
    }


def test_awkward_rows(awkward, items):
    found = {name: df.collect() for name, df in every(awkward, items).items()}
    for name in ("op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10"):
        assert len(found[name]) == awkward.count(), name
    near = defaultdict(list)
    for row in found["op5"]:
        near[row["doc_id"]].append(row)
    assert [r["component_id"] for r in near[1]] == [1, 1] and near[2][0]["component_id"] == 1
    assert near[7][0]["component_id"] == 6 and not near[7][0]["kept"]
    assert near[3][0]["kept"] and near[4][0]["kept"] and near[5][0]["n_shingles"] == 0
    assert all(r["kept"] for r in near[None])
    langs = {r["doc_id"]: r["lang_pred"] for r in found["op8"] if r["doc_id"]}
    assert [langs[i] for i in (3, 4, 5, 9)] == ["und"] * 4
    by_id = {r["doc_id"]: r for r in found["op10"] if r["doc_id"]}
    assert by_id[8]["n_hit"] == 40 and not by_id[8]["contaminated"]
    assert by_id[7]["contaminated"] and by_id[7]["n_items"] == 1
    assert by_id[1]["n_hit"] == 20 and by_id[1]["n_items"] == 0 and by_id[1]["contaminated"]
    spans = {(r["doc_id"], r["start_word"], r["end_word"]) for r in found["op2"]}
    assert spans == {(1, 0, 120), (2, 0, 120)}
    tokens = {r["doc_id"]: r["n_tokens"] for r in found["op9"]}
    assert tokens[3] == tokens[4] == 1 and tokens[6] == 3
    assert sum(r["taken"] for r in found["op7"] if r["size"] == 0) == 0


def test_no_rows(nothing, items):
    assert {name: df.count() for name, df in every(nothing, items).items()} == {
        f"op{i}": 0 for i in range(1, 11)
    }


def test_no_benchmark(awkward, items):
    found = decontaminate.contamination(awkward, items.limit(0))
    assert found.filter("n_hit > 0 or contaminated").count() == 0


def test_filters_keep_columns_and_whole_rows(awkward, items):
    kept = near_dups.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 8, 9]
    clean = decontaminate.decontaminate(awkward, items)
    assert clean.columns == awkward.columns
    assert sorted((r["doc_id"] or 0) for r in clean.collect()) == [0, 0, 3, 4, 5, 8, 9]
    known = languages.drop_unidentified(awkward)
    assert known.columns == awkward.columns and known.filter("text is null").count() == 0
    mixed, taken = mixture.mixed(awkward), mixture.mix(awkward)
    assert mixed.columns == awkward.columns
    assert mixed.count() == taken.agg(F.sum("copies")).first()[0]


def test_one_row_of_each_group_whatever_its_ids(spark):
    """Unrelated texts may carry one id, and copies may carry none."""
    one, other, third = (prose(i, 60, 10**6) for i in (61, 62, 63))
    rows = [(1, one), (1, one), (1, other), (2, other + " x"), (None, third), (None, third), (None, third + " y")]
    rows += [(3, None), (3, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = near_dups.drop_near_duplicates(docs).collect()
    worded = [(r["doc_id"], r["text"]) for r in kept if r["text"]]
    assert sorted(worded[i] for i in range(len(worded)) if worded[i][0]) == sorted([(1, one), (1, other)])
    assert len([t for i, t in worded if i is None]) == 1 and len(kept) == 6


def test_links_past_hubs_are_found(spark, monkeypatch):
    """Texts around one passage share buckets, few are similar, and none is to all hubs."""
    monkeypatch.setattr(near_dups, "BLOCK", 4)
    passage, texts = prose(7, 90, 10**6), []
    for i in range(60):
        own = prose(1000 + i // 2, 30 + i % 7, 10**6).split()
        texts.append(" ".join([*passage.split(), *own[: len(own) - 5 * (i % 2)]]))
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for t in texts]
    want = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and want[a] != want[b]:
            low, high = sorted((want[a], want[b]))
            want = [low if x == high else x for x in want]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    settled = []
    whole = near_dups._settle
    monkeypatch.setattr(near_dups, "_settle", lambda m, t: settled.append(m.count()) or whole(m, t))
    found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(texts))] == want and len(set(want)) > 10 and settled[0] > 8


def test_word_hashes_follow_words(monkeypatch):
    monkeypatch.setattr(words, "CHUNK", 64)
    texts = [b"A b", None, b"", b"x" * 500 + b" y \x0b z", "é ß　q".encode(), b"a-b.c 12"] * 3
    for gaps, pattern in ((words.SPACES, rb"[^\x20\x09-\x0D]+"), (words.PUNCTUATION, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        known: dict[bytes, int] = {}
        for text, found in zip(texts, words.word_lists(texts, gaps)):
            plain = re.findall(pattern, (text or b"").translate(words.LOWER))
            assert len(plain) == len(found)
            assert all(known.setdefault(w, h) == h for w, h in zip(plain, found.tolist()))
        assert len(set(known.values())) == len(known)


def test_repeated_spans_equal_all_windows(spark):
    shared = [prose(100 + i, n, 10**6) for i, n in enumerate((50, 51, 75, 200, 49))]
    pick = random.Random(4)
    docs = []
    for i in range(60):
        parts = [prose(1000 * i + j, pick.randrange(0, 60), 10**6) for j in range(4)]
        parts[1:1] = pick.sample(shared, pick.randrange(0, 3))
        docs.append(" ".join(p for p in parts if p))
    seen = defaultdict(set)
    for i, text in enumerate(docs):
        w = text.split()
        for k in range(len(w) - suffixes.SPAN + 1):
            seen[tuple(w[k : k + suffixes.SPAN])].add(i)
    covered = defaultdict(set)
    for i, text in enumerate(docs):
        w = text.split()
        for k in range(len(w) - suffixes.SPAN + 1):
            if len(seen[tuple(w[k : k + suffixes.SPAN])]) > 1:
                covered[i].update(range(k, k + suffixes.SPAN))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").repartition(3)
    found = defaultdict(set)
    for row in suffixes.repeated_spans(df).collect():
        found[row["doc_id"]].update(range(row["start_word"], row["end_word"]))
    assert found == covered


def test_passages_quoted_from_different_starts(spark):
    """The neighbour in sorted order may share more to the right and too little in all."""
    pick, docs = random.Random(9), []
    own = lambda: prose(pick.randrange(10**9), pick.randrange(0, 40), 10**6).split()
    for group in range(25):
        passage = prose(5000 + group, 100, 10**6).split()
        cuts = [(0, 100), (0, 60), *[(pick.choice((5, 20, pick.randrange(40))), 100) for _ in range(group)]]
        docs += [" ".join([*own(), *passage[a:b], *own()]) for a, b in cuts]
    seen = defaultdict(set)
    windows = [list(zip(*[t.split()[k:] for k in range(suffixes.SPAN)])) for t in docs]
    for i, found in enumerate(windows):
        for window in found:
            seen[window].add(i)
    covered = defaultdict(set)
    for i, found in enumerate(windows):
        for k, window in enumerate(found):
            if len(seen[window]) > 1:
                covered[i].update(range(k, k + suffixes.SPAN))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").repartition(3)
    spans = defaultdict(set)
    for row in suffixes.repeated_spans(df).collect():
        spans[row["doc_id"]].update(range(row["start_word"], row["end_word"]))
    assert spans == covered


def test_near_duplicates_equal_all_pairs(spark):
    pick, docs = random.Random(6), []
    for group in range(12):
        base = prose(group, pick.choice([4, 9, 40, 150]), 10**6).split()
        for _ in range(pick.randrange(1, 9)):
            copy = list(base)
            for _ in range(pick.randrange(0, max(2, len(copy) // 18))):
                copy[pick.randrange(len(copy))] = f"n{pick.random()}"
            docs.append(" ".join(copy))
    sets = []
    for text in docs:
        w = text.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(docs)))
    for _ in docs:
        for a, b in itertools.combinations(range(len(docs)), 2):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").repartition(3)
    found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(df).collect()}
    assert found == dict(enumerate(root))


def test_densified_bins_are_equally_likely_to_agree():
    pick, agree = np.random.default_rng(3), []
    for _ in range(300):
        both = pick.integers(0, 2**63, 30).astype(np.uint64) * np.uint64(2)
        own = [pick.integers(0, 2**63, 5).astype(np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
        a, b = (near_dups.densified(np.unique(np.concatenate((both, o)))) for o in own)
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - 30 / 40) < 0.02


def test_edits_equal_counting_anew():
    counter, pick = edits.Counter(), random.Random(8)
    signs = ["a", "b", "  ", "\n", " ", "'s", "'", "12", "é", "##", "\t ", "word ", "　"]
    for _ in range(300):
        tree = edits.TokenTree("".join(pick.choices(signs, k=pick.choice([0, 1, 20, 900]))), counter)
        for _ in range(5):
            a = pick.randrange(-2, len(tree.text) + 3)
            tree.edit(a, a + pick.randrange(-1, 12), "".join(pick.choices(signs, k=pick.choice([0, 2, 300]))))
            assert tree.tokens == len(counter.encoding.encode_ordinary(tree.text))
            assert [n for block in tree.lengths for n in block] == counter.leaves(tree.text)[0]


def test_edited_counts_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counter = edits.Counter()
    rows = {r["doc_id"]: r for r in edits.count_edited(docs, catalog.document_edits()).collect()}
    for row in docs.select("*", catalog.document_edits().alias("changes")).collect():
        text = row["text"]
        before = len(counter.encoding.encode_ordinary(text))
        for change in row["changes"]:
            a = min(change["start"], len(text))
            b = min(max(change["stop"], a), len(text))
            text = text[:a] + (change["insert"] or "") + text[b:]
        found = rows[row["doc_id"]]
        assert (found["n_tokens"], found["n_tokens_after"]) == (before, len(counter.encoding.encode_ordinary(text)))
        assert found["n_encoded"] < 60


def test_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = shards.shards(docs, carry=True).collect()
    by_shard = defaultdict(list)
    for row in rows:
        data = row["text"].encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert row["grown_shard"] in (row["shard"], shards.SHARDS)
        by_shard[row["shard"]].append(row["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    again = shards.shards(docs.repartition(5), carry=True).collect()
    place = lambda found: {r["doc_id"]: (r["shard"], r["slot"]) for r in found}
    assert place(rows) == place(again)


def test_a_bucket_is_shuffled_evenly(spark):
    order = shards._shuffled(F.lit(4), F.col("id"), F.lit(0), 1)
    found = Counter(tuple(r[0]) for r in spark.range(4800).select(order).collect())
    assert len(found) == 24 and all(140 < n < 260 for n in found.values())


def test_written_shards_hold_all_rows(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    shards.write_shards(shards.shards(docs, carry=True), f"{tmp_path}/out", rows_per_file=3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.select(*docs.columns).exceptAll(docs).isEmpty() and back.count() == docs.count()


def test_mix_comes_near_its_targets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = mixture.mix(docs).collect()
    total, sources = sum(r["size"] for r in rows), defaultdict(list)
    for row in rows:
        assert row["taken"] in (0, row["size"], 2 * row["size"])
        sources[row["source"]].append(row)
    longest = max(r["size"] for r in rows)
    for found in sources.values():
        assert abs(sum(r["taken"] for r in found) - found[0]["target"]) <= 2 * longest
    assert abs(sum(s[0]["target"] for s in sources.values()) - 1.5 * total) < 1e-3


def test_a_source_without_words_takes_nothing(spark):
    wordless = [(10, None, "w"), (11, "", "w"), (12, " \n", None)]
    worded = [(i, prose(i, 20 + i), "ab"[i % 2]) for i in range(8)]
    schema = "doc_id bigint, text string, source string"
    for rows in (wordless, wordless + worded):
        docs = spark.createDataFrame(rows, schema)
        found = {r["doc_id"]: r for r in mixture.mix(docs).collect()}
        assert len(found) == len(rows)
        assert all(found[i]["taken"] == 0 and found[i]["target"] == 0 for i in (10, 11, 12))
        assert mixture.mixed(docs).count() == sum(r["copies"] for r in found.values())
    alone = {r["doc_id"]: r["taken"] for r in mixture.mix(spark.createDataFrame(worded, schema)).collect()}
    assert alone == {i: found[i]["taken"] for i in alone} and sum(alone.values()) > 0


def test_languages_of_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = languages.identify(docs).filter("held_out").join(docs, "doc_id")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right > 0.97 and n > 200


def test_model_is_normalised_and_better_than_unigrams(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    counts = neural_lm.frequent(neural_lm.count_tokens(docs))
    model = neural_lm.fit(docs, counts)
    far, near = np.array([model.k, 3, 0]), np.array([model.k, 0, 7])
    whole = np.zeros(3)
    for k in range(model.k):
        whole += np.exp(model.score(far, near, np.full(3, k)) - model.normaliser(far, near))
    assert np.allclose(whole, 1, atol=1e-4)
    sums = neural_lm.score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_base_score_is_the_smoothed_unigram(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    lists = {r["doc_id"]: [*SPACES.findall(r["text"].translate(lower)), None] for r in docs.collect()}
    trains = {i for i in lists if zlib.crc32(str(i).encode()) % 5 != 1}
    counts = Counter(itertools.chain.from_iterable(lists[i] for i in trains))
    whole = sum(counts.values()) + 0.5 * (len(counts) + 1)
    for row in neural_lm.score(docs).collect():
        own = lists[row["doc_id"]]
        assert (row["n_tokens"], row["n_known"]) == (len(own), sum(t in counts for t in own))
        assert row["train_tokens"] == sum(counts.values())
        assert row["base_score"] == pytest.approx(sum(np.log10((counts[t] + 0.5) / whole) for t in own))


def test_licenses(spark):
    full = licenses.TEMPLATES["mit-full"]
    lines = textwrap.wrap(full.replace("any person", "any human"), 70)
    rows = [
        (1, "Text.\nReleased under the MIT License.\nMore text."),
        (2, "Copyright law is a topic.\nLicense plates are another."),
        (3, "\n".join(["Some code", *lines, "end"])),
        (4, "Licensed under CC BY-SA 4.0."),
        (5, None),
    ]
    found = licenses.license_notices(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r["doc_id"], r["license"]) for r in found} == {(1, "mit"), (3, "mit-full"), (4, "cc-by-sa-4.0")}
    assert all(r["exact"] for r in found if r["doc_id"] != 3)


def test_wrapped_licenses(spark):
    """Every template wrapped at 60 to 80 columns, alone, as a comment and between lines of prose."""
    rows, want = [], {}
    for name, text in licenses.TEMPLATES.items():
        for width in (60, 66, 72, 80):
            for lead in ("", " * ", "# "):
                lines = textwrap.wrap(text, width, initial_indent=lead, subsequent_indent=lead, break_on_hyphens=False)
                for around in ([], [lead + prose(width, 9)] * 3):
                    want[len(rows)] = (name, len(around), len(around) + len(lines) - 1, True)
                    rows.append((len(rows), "\n".join([*around, *lines, *around])))
    gpl = "This work is licensed under the GNU General Public License,\nversion 2.\nMore."
    want[len(rows)] = ("gpl-2.0", 0, 1, True)
    rows.append((len(rows), gpl))
    found = licenses.license_notices(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert {r["doc_id"]: (r["license"], r["first_line"], r["last_line"], r["exact"]) for r in found} == want
    assert len(found) == len(rows)


def test_several_licenses_of_a_text(spark):
    apache, mit, isc = (textwrap.wrap(licenses.TEMPLATES[x], 70) for x in ("apache-2.0-header", "mit-full", "isc"))
    long = "The license of this work is told below. " + prose(4, 200)
    short = "Licensed under CC BY 4.0. All rights reserved. Released under the MIT License."
    rows = [
        (1, "\n".join([*apache, "", *mit])),
        (2, "\n".join([long, *mit])),
        (3, "\n".join([*mit, *mit, *isc, "All rights reserved."])),
        (4, short),
        (5, "\n".join([*apache, "", long, "", *isc, long])),
    ]
    found = defaultdict(list)
    for r in licenses.license_notices(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        assert r["exact"] and r["reduction"] > 0
        found[r["doc_id"]].append((r["first_line"], r["license"]))
    n, m, k = len(apache), len(mit), len(isc)
    assert {i: sorted(x) for i, x in found.items()} == {
        1: [(0, "apache-2.0-header"), (n + 1, "mit-full")],
        2: [(1, "mit-full")],
        3: [(0, "mit-full"), (m, "mit-full"), (2 * m, "isc"), (2 * m + k, "all-rights-reserved")],
        4: [(0, "all-rights-reserved"), (0, "cc-by-4.0"), (0, "mit")],
        5: [(0, "apache-2.0-header"), (n + 3, "isc")],
    }


def test_host_rates_shrink_and_condemn(spark):
    bad, good = " ".join(["a b c d e f"] * 10), prose(5, 40, 10**6)
    rows = [(i, bad if i % 10 else good, "spam") for i in range(100)]
    rows += [(1000 + i, good, f"h{i % 9}") for i in range(900)]
    rows += [(5000, bad, "small"), (5001, good, None)]
    found = {r["doc_id"]: r for r in host_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert not found[10]["base_failed"] and not found[10]["kept"]
    assert found[5001]["kept"] and found[1000]["kept"]
    assert found[5000]["host_rate"] < 1


def test_a_text_of_one_word_repeated(spark):
    """20,000 places against 2,000: a few pairs of sides."""
    docs = spark.createDataFrame([(1, "x " * 20_000), (2, "x " * 5 + "y"), (3, "x " * 13 + "y x")], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, "x " * 2_000) for i in range(3)] + [(9, "x x y"), (10, "x")], "item_id bigint, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (20_000, 20_000, 4), 2: (6, 6, 2), 3: (15, 15, 5)}


def test_many_equal_rows_are_sharded(spark):
    docs = spark.range(9000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))
    more = spark.range(500).select("id", F.lit("b").alias("text"))
    rows = shards.shards(docs.unionAll(more)).collect()
    by_shard = defaultdict(list)
    for row in rows:
        by_shard[row["shard"]].append(row["slot"])
    assert len(rows) == 9500 and all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_plain_shuffle_of_a_bucket(spark):
    """Fisher and Yates step by step, with Spark's hash for the draws."""
    draws = spark.range(1, 40).select("id", F.pmod(F.xxhash64(F.lit(5 + 2) + F.lit(3), F.lit(1), F.lit(2), F.col("id").cast("int")), F.col("id") + 1).alias("j"))
    order = [0]
    for i, j in sorted(map(tuple, draws.collect())):
        order.append(order[j] if j < i else i)
        order[j] = i
    got = spark.range(1).select(shards._shuffled(F.lit(40), F.lit(1), F.lit(2), 5, F.lit(3)).alias("o")).first()["o"]
    assert got == order


def test_columns_called_like_internal_ones(spark, sf_dir):
    """Every name that an operator uses inside, as a column of the caller."""
    names = (
        "_own _of _once _twice _turn _gone_id _gone_text _found _to_shard _to_bucket _rank _tie _start _order _n "
        "_row _hit _text _data size slot SHARD kept key root node _to_shard_"
    ).split()
    plain = table(spark, sf_dir, "documents").limit(60)
    docs = plain.withColumns({n: F.lit(f"own {n}") for n in names})
    items = table(spark, sf_dir, "benchmark")
    stages = {
        "language": languages.drop_unidentified(docs),
        "near": near_dups.drop_near_duplicates(docs),
        "decontaminated": decontaminate.decontaminate(docs, items),
        "mixed": mixture.mixed(docs),
    }
    for name, rows in stages.items():
        assert rows.columns == docs.columns, name
        assert rows.count() > 0 and rows.filter(" or ".join(f"`{n}` <> 'own {n}'" for n in names)).count() == 0, name
    sharded = shards.shards(docs, carry=True)
    replaced = {"size", "slot", "SHARD"}
    assert sharded.count() == 60
    assert sharded.filter(" or ".join(f"`{n}` <> 'own {n}'" for n in names if n not in replaced)).count() == 0


def test_documents_without_a_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    unnamed = docs.withColumn("lang", F.lit(None).cast("string"))
    assert languages.drop_unidentified(unnamed).count() == docs.count()
    short = spark.createDataFrame([(10**9 + i, t, None, "s", 1) for i, t in enumerate(["A.", "Avec.", "123 ...", None])], docs.schema)
    kept = languages.drop_unidentified(docs.unionByName(short)).filter(F.col("doc_id") >= 10**9)
    assert sorted(r["text"] for r in kept.collect()) == ["A.", "Avec."]


def plain_notices(text):
    """Every template laid on every word of the whole text; the best fits that do not overlap."""
    words = licenses.wording(text)
    found = set()
    for name, template in ((n, licenses.wording(t)) for n, t in licenses.TEMPLATES.items()):
        slack, counts = int(licenses.DIFFER * len(template)), Counter(template)
        for start in range(-slack, len(words)):
            low = max(0, start)
            block = words[low : max(0, start + len(template) + 2 * slack)]
            if sum((Counter(block) & counts).values()) >= len(template) - slack:
                differ, a, b = licenses.fitted(template, block)
                if b > a and differ <= licenses.DIFFER * len(template):
                    found.add(((len(template) + b - a - differ) // 2 - differ, low + a, low + b, name, differ))
    taken, out = set(), []
    for _, a, b, name, differ in sorted(found, key=lambda x: (-x[0], x[1], x[2], x[3])):
        if taken.isdisjoint(range(a, b)):
            taken.update(range(a, b))
            out.append((a, name, differ))
    return [(name, differ) for _, name, differ in sorted(out)]


def test_notices_equal_all_templates_on_all_words(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = [r["text"] for r in docs.filter(F.col("text").rlike(licenses.SIGNAL)).collect()]
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for text in texts:
        assert [(x[0], x[4]) for x in scanner.scan(text)] == plain_notices(text)
    assert len(texts) > 20


def test_whole_public_notices(spark):
    """Each template in prose, wrapped, alone and beside another one."""
    names = sorted(licenses.TEMPLATES)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for i, name in enumerate(names):
        other = names[(i + 7) % len(names)]
        for width in (60, 76):
            wrapped = ["# " + line for line in textwrap.wrap(licenses.TEMPLATES[name], width)]
            more = ["// " + line for line in textwrap.wrap(licenses.TEMPLATES[other], width)]
            text = "\n".join([prose(i, 60), *wrapped, "", prose(i + 1, 5), "", *more, prose(i + 2, 60)])
            assert [(x[0], x[4]) for x in scanner.scan(text)] == [(name, 0), (other, 0)], (name, other)


def test_scores_equal_a_plain_softmax(spark, sf_dir):
    """Each token by its context, one after the other, and its share among the words of its ending."""
    docs = table(spark, sf_dir, "documents")
    counts = neural_lm.frequent(neural_lm.count_tokens(docs))
    model = neural_lm.fit(docs, counts)
    words_in, _, first, second, bias = model.parts
    outs = model.parts[1]
    own = {int(k): int(c) for k, c in zip(counts.keys, counts.classes)}
    n = {int(k): int(c) for k, c in zip(counts.keys, counts.n)}
    mass = defaultdict(lambda: 0.5)
    for key, cls in own.items():
        if cls < neural_lm.ENDINGS:
            assert cls == key % neural_lm.ENDINGS
            mass[cls] += n[key] + 0.5
    got = {r["doc_id"]: r["score"] for r in neural_lm.score(docs).collect()}
    for row in docs.orderBy("doc_id").limit(40).collect():
        ((keys, _),) = neural_lm.documents([row["text"].encode()])
        far = near = model.k
        total = 0.0
        for key in keys.tolist():
            cls = own.get(key, key % neural_lm.ENDINGS)
            scores = outs @ (words_in[far] @ first + words_in[near] @ second) + bias
            total += (scores[cls] - np.logaddexp.reduce(scores)) / np.log(10)
            if cls < neural_lm.ENDINGS:
                total += np.log10((n.get(key, 0) + 0.5) / mass[cls])
            far, near = near, cls
        assert got[row["doc_id"]] == pytest.approx(total, rel=1e-4), row["doc_id"]


def test_word_hashes_name_their_endings():
    plain = next(words.hashed([b"One two \xc3\xa9 ne", None, b"stone x"]))[1]
    marked = next(words.hashed([b"One two \xc3\xa9 ne", None, b"stone x"], endings=512))[1]
    assert ((plain ^ marked) >> np.uint64(9) == 0).all()
    ends = (marked % np.uint64(512)).tolist()
    assert ends[0] == ends[3] == ends[4] and len({ends[0], ends[1], ends[2], ends[5]}) == 4
