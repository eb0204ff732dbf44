"""URL verdicts by rules, and by trust and distrust over the link graph where no rule fits.

A rule names a host and a start of the path; it fits the host itself and its subdomains, and the
longest rule that fits an url decides. What the rules decide is the seed of the propagation: each
allowed page is one unit of trust on its host, each blocked one a unit of distrust. Trust follows
links between hosts, distrust follows them backwards (who links to a blocked host is suspect), both
as personalised PageRank. A host is blocked if its share of distrust passes ``LIMIT``; that is the
verdict of its pages without a rule.

A page votes once for each other host it links to. Only absolute and ``//host`` links leave a host;
a host's links to itself are no evidence. Ranks are whole millionths of a page, rounded down at every
step, so their sums do not depend on the order of addition and a repeated task gives the same. The
steps run until nothing moves, ``STEPS`` at most; each is one join of the moving ranks with the edges
and one sum by host. DataFrame functions only.

Defined results: an url that is NULL or has no ``://`` has an empty host and path, no rule, and the
verdict of no evidence, which is ``allow``; a host that only is linked to takes trust but gives none;
rank at a host without links out stays there; a NULL ``html`` has no links; repeated rows count and
return each; an empty table gives no rows. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.llm.frames import written

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"

#: Verdict, and host with the start of the path.
RULES = (
    (ALLOW, "org/"),
    (BLOCK, "example.org/es/"),
    (BLOCK, "example.org/en/1"),
    (ALLOW, "com/fr/"),
    (BLOCK, "com/de/"),
)
#: Rules are written into the plan.
MAX_RULES = 1000

DAMPING = 0.85
STEPS = 20
#: Rank of one page.
UNIT = 1_000_000
#: A host is blocked above this share of distrust in its whole rank.
LIMIT = 0.5

TRUST, DISTRUST = "trust", "distrust"
_HOST = r"://([^/?#]*)"
_PATH = r"://[^/?#]*([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>\\]+)"""


def _lower(text: Column) -> Column:
    return F.translate(text, CAPITALS, SMALL)


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?`` or ``#``, with small letters of ASCII."""
    return F.coalesce(_lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, else NULL; of one rule given twice, block."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string, verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0] == BLOCK)):
        on, slash, start = rule.partition("/")
        fits = (host == on) | host.endswith(f".{on}")
        if slash:
            fits = fits & path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, and ``rule`` and ``verdict``, NULL where no rule fits."""
    url = F.col("url").cast("string")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    by = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumn("_by", by).select("page_id", "host", "path", "_by.rule", "_by.verdict")


def host_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst, pages)``: how many pages of ``src`` link to the other host ``dst``."""
    found = F.regexp_extract_all(F.col("html").cast("string"), F.lit(_LINK), 1)
    rows = pages.select(
        host_of(F.col("url").cast("string")).alias("src"),
        F.explode(F.array_distinct(F.transform(found, _lower))).alias("dst"),
    )
    other = rows.filter("src <> dst and src <> ''")
    return other.groupBy("src", "dst").agg(F.count("*").alias("pages"))


def propagate(seeds: DataFrame, edges: DataFrame, steps: int = STEPS, damping: float = DAMPING) -> DataFrame:
    """``(host, trust, distrust)`` from seeds ``(host, kind, rank)`` over ``(src, dst, pages)``.

    Each step moves only what the step before moved; the ranks are the sums of all steps. A host with
    very many links is a few rows on the side of the ranks and a skewed key that Spark splits on the
    side of the edges.
    """
    forward = edges.select(F.lit(TRUST).alias("kind"), "src", "dst", "pages")
    back = edges.select(
        F.lit(DISTRUST).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "pages"
    )
    both = forward.unionByName(back)
    whole = both.groupBy("kind", "src").agg(F.sum("pages").alias("out"))
    both = written(both.join(whole, ["kind", "src"]), "host-edges")
    moving = written(
        seeds.select("kind", "host", F.floor(F.col("rank") * (1 - damping)).cast("bigint").alias("rank")), "ranks"
    )
    moved = [moving]
    if not both.isEmpty():
        for _ in range(steps):
            arriving = moving.join(both, (moving["kind"] == both["kind"]) & (moving["host"] == both["src"])).select(
                both["kind"],
                F.col("dst").alias("host"),
                F.floor(F.col("rank") * F.lit(damping) * F.col("pages") / F.col("out")).cast("bigint").alias("rank"),
            )
            sums = arriving.groupBy("kind", "host").agg(F.sum("rank").alias("rank")).filter("rank > 0")
            moving = written(sums, "ranks")
            if moving.isEmpty():
                break
            moved.append(moving)
    every = reduce(DataFrame.unionByName, moved)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0)).alias(kind)
    return every.groupBy("host").agg(of(TRUST), of(DISTRUST))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, limit: float = LIMIT) -> DataFrame:
    """Per page ``host``, ``path``, ``rule``, ``verdict`` and its host's ``trust`` and ``distrust``.

    Pages are read as urls for the verdicts, and once more with their html for the edges; the html
    never leaves the scan. Hosts are joined back by Spark's choice, a hot host split.
    """
    rows = ruled(pages, rules)
    kind = F.when(F.col("verdict") == ALLOW, TRUST).otherwise(DISTRUST)
    seeds = rows.filter("verdict is not null").groupBy(kind.alias("kind"), "host").agg(
        (F.count("*") * UNIT).alias("rank")
    )
    hosts = propagate(seeds, host_edges(pages)).withColumnRenamed("host", "_host")
    out = rows.join(hosts, rows["host"] == hosts["_host"], "left")
    trust, distrust = (F.coalesce(c, F.lit(0)) for c in (TRUST, DISTRUST))
    blocked = distrust > (trust + distrust) * F.lit(limit)
    verdict = F.coalesce("verdict", F.when(blocked, BLOCK).otherwise(ALLOW))
    share = lambda c: (c / F.lit(float(UNIT)))
    return out.select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"),
        share(trust).alias("trust"), share(distrust).alias("distrust"),
    )
