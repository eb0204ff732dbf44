"""URL verdicts and the audit of filters against plain versions, and on awkward rows."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict
from math import floor

import pytest

from seqprep.llm import filter_audit, url_filters

PAGES = "page_id bigint, url string, html string, host string, rule string, rank bigint, kind string"
DOCS = "doc_id bigint, text string, source string, part string, mask int, digest string, good int, times int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def pages_of(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", 1, "trust") for row in rows], PAGES)


def plain_hosts(rows):
    """Trust and distrust per host, with dictionaries."""

    def split(url):
        _, sign, rest = (url or "").partition("://")
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        return (re.sub("[A-Z]", lambda m: m[0].lower(), host), path) if sign else ("", "")

    def rule(host, path):
        fits = []
        for verdict, text in url_filters.RULES:
            on, start = text[: text.index("/")], text[text.index("/"):]
            if (host == on or host.endswith("." + on)) and path.startswith(start):
                fits.append((len(text), text, verdict))
        return max(fits)[1:] if fits else (None, None)

    votes, seeds, found = Counter(), Counter(), []
    for _, url, html in rows:
        host, path = split(url)
        named, verdict = rule(host, path)
        found.append((host, path, named, verdict))
        if verdict:
            seeds[verdict == "allow", host] += 1
        linked = {
            split(h if "://" in h else "x:" + h)[0]
            for h in re.findall(r"""(?i)\bhref\s*=\s*["']?\s*([^"'\s>]*)""", html or "")
            if re.match(r"(?i)([a-z][a-z0-9+.-]*:)?//[^/?#]", h)
        }
        if host:
            votes.update((host, other) for other in linked if other != host)
    edges = [(True, a, b, n) for (a, b), n in votes.items()] + [(False, b, a, n) for (a, b), n in votes.items()]
    out = Counter()
    for kind, a, _, n in edges:
        out[kind, a] += n
    moving = {key: floor(n * url_filters.UNIT * (1 - 0.85)) for key, n in seeds.items()}
    total = Counter(moving)
    for _ in range(url_filters.STEPS):
        after = Counter()
        for kind, a, b, n in edges:
            after[kind, b] += floor(moving.get((kind, a), 0) * 0.85 * n / out[kind, a])
        moving = after
        total.update(after)
    return found, total


def test_link_graph_equals_plain_propagation(spark):
    pick = random.Random(5)
    hosts = [f"h{i}.example.{end}" for i in range(12) for end in ("net", "org", "com")]
    rows = []
    for i in range(300):
        host = pick.choice(hosts)
        path = pick.choice(["/fr/1", "/de/2", "/es/3", "/en/14", "/en/4", "", "?q=1", "#top"])
        links = "".join(
            pick.choice([f'<a href="https://{h}/x">', f"<a HREF='//{h.upper()}?y'>", f"<a href=http://{h}>", '<a href="/own">'])
            for h in pick.sample(hosts, pick.randrange(4))
        )
        rows.append((i, f"https://{host.upper() if i % 7 == 0 else host}{path}", links))
    rows += [(0, rows[0][1], rows[0][2]), (301, "HTTP://uncrawled.net", '<a href="//only.linked.net/">')]
    found, total = plain_hosts(rows)
    got = url_filters.judge(pages_of(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for (page, _, _), (host, path, named, verdict) in zip(rows, found):
        trust, distrust = (total[kind, host] / url_filters.UNIT for kind in (True, False))
        own = "block" if distrust > (trust + distrust) * url_filters.LIMIT else "allow"
        want.append((page, host, path, named or "", verdict or own, trust, distrust))
    assert sorted((*r[:3], r[3] or "", *r[4:]) for r in got) == sorted(want)
    unruled = {w[4] for w in want if not w[3]}
    assert unruled == {"allow", "block"}


def test_awkward_urls(spark):
    rows = [
        (1, None, None), (None, "", ""), (2, "no scheme.org/", "<a href='//'>"), (3, "http://", "<a href=http://>"),
        (4, "x://ORG/a", None), (4, "x://ORG/a", None), (5, "x://notorg/a", None), (6, "a://b.org://c/", None),
        (7, "http://a.org", "y" * 300_000 + "href=//z.net"), (8, "http://É.Org/É?x", None),
        (9, "http://example.org/en/1", ""), (10, "http://www.example.org/en/12", ""),
    ]
    got = sorted((tuple(r) for r in url_filters.judge(pages_of(spark, rows)).collect()), key=repr)
    by_id = {r[0]: r for r in got}
    assert len(got) == len(rows)
    assert by_id[1][1:5] == by_id[None][1:5] == by_id[2][1:5] == by_id[3][1:5] == ("", "", None, "allow")
    assert by_id[4][1:5] == ("org", "/a", "org/", "allow") and by_id[5][3] is None
    assert by_id[6][1:3] == ("b.org:", "//c/") and by_id[7][1:4] == ("a.org", "", None)
    assert by_id[8][1:4] == ("É.org", "/É", "org/")
    assert by_id[9][3:5] == by_id[10][3:5] == ("example.org/en/1", "block")
    assert url_filters.judge(pages_of(spark, rows).limit(0)).count() == 0


def test_longest_rule_wins_and_block_breaks_ties(spark):
    rows = [(1, "http://a.b.net/p/q", ""), (2, "http://b.net/p", "")]
    rules = [("allow", "b.net/p"), ("block", "b.net/p/q"), ("block", "net"), ("block", "b.net/p")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filters.ruled(pages_of(spark, rows), rules).collect()}
    assert got == {1: ("b.net/p/q", "block"), 2: ("b.net/p", "block")}


def plain_audit(counts, names):
    """Every order by filtering the masks one step after the other."""
    rows, share = [], Counter()
    for order in itertools.permutations(range(len(names))):
        left = dict(counts)
        for step, f in enumerate(order, 1):
            failing = {m: w for m, w in counts.items() if m >> f & 1}
            gone = {m: w for m, w in left.items() if m >> f & 1}
            left = {m: w for m, w in left.items() if not m >> f & 1}
            n = [sum(w[i] for w in gone.values()) for i in range(3)]
            share[f] += n[0]
            rows.append((
                "".join(names[x] for x in order), step, sum(w[0] for w in left.values()), n[0],
                sum(w[0] for m, w in failing.items() if m not in gone), counts.get(1 << f, (0, 0, 0))[0], n[1], n[2], f,
            ))
    return [(*r[:-1], share[r[-1]]) for r in rows]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_swapped_diagrams_equal_filtering(n):
    pick = random.Random(n)
    for size in (0, 1, 3, 2**n):
        masks = pick.sample(range(2**n), min(size, 2**n))
        counts = {m: (pick.randrange(1, 9), pick.randrange(3), pick.randrange(2)) for m in masks}
        names = "ABCDEF"[:n]
        assert sorted(filter_audit.audit_part(counts, names)) == sorted(plain_audit(counts, names))


def test_equal_subdiagrams_are_one_node():
    even = filter_audit.Diagram({m: (1, 0, 0) for m in range(32)}, 5)
    assert len(even.kept) == 6


def test_audit_of_awkward_documents(spark):
    long = " ".join(f"w{i}" for i in range(250))
    texts = [
        (1, long, "a"), (2, long, "b"), (2, long, "b"), (2, long, None), (None, long, "a"), (None, None, None),
        (3, None, ""), (4, "", "a"), (5, "ABC " * 300, "a"), (6, "x|y", "a"), (7, " \n\t", "b"), (8, long + " É", "b"),
        (9, long.replace("w", "W", 30), "a"), (0, "ABC " * 300, "c"), (10, "y " * 40_000, "c"),
    ]
    docs = spark.createDataFrame([(*t, "p", 3, "d", 9, 9) for t in texts], DOCS)
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (5, None, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int"
    )
    good, toxic, counts = {1, 2}, {2, 5}, defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
    for doc_id, text, source in texts:
        text, words = text or "", WORD.findall(text or "")
        other = [d for d, t, _ in texts if (t or "") == text and d is not None and doc_id is not None and d < doc_id]
        failed = [
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search("[#$%&*|]", text)), bool(other),
        ]
        cell = counts[source or ""][sum(f << i for i, f in enumerate(failed))]
        for i, one in enumerate((1, doc_id in good, doc_id in toxic)):
            cell[i] += one
    want = [(part, *row) for part, of in counts.items() for row in plain_audit({m: tuple(w) for m, w in of.items()}, "ABCDE")]
    got = filter_audit.audit_documents(docs, labels)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert filter_audit.audit_documents(docs.limit(0), labels).count() == 0
    assert filter_audit.audit_documents(docs, labels.limit(0)).count() == len(want)
