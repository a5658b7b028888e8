"""URL rules, and verdicts from the host link graph where no rule speaks.

Trust flows along links from hosts with an allowed url, distrust against them from
hosts with a blocked one, both as personalised PageRank; pages and linked urls count
alike. Only DataFrame functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import drop, staged

#: Fixed values: (verdict, host, path).
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null and for a text without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return _lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, block before allow if as long; else null."""
    rule = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        if rule is None:
            rule, verdict = F.when(fits, h + p), F.when(fits, kind)
        else:
            rule, verdict = rule.when(fits, h + p), verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def host_links(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Distinct links (src, dst) between hosts from the absolute urls in `href` attributes.

    `good` and `bad` are 1 if a rule allows or blocks a url that such a link leads to, else
    0. A linked url without a path is the root of its host, `/`.
    """
    found = F.regexp_extract_all(
        F.col("html"),
        F.lit(r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+[^"'\s<>]*)"""),
        F.lit(1),
    )
    own, _ = host_and_path(F.col("url"))
    host, path = host_and_path(F.concat(F.lit("://"), F.col("url")))
    path = F.when(path == "", "/").otherwise(path)
    _, verdict = matched(F.col("dst"), F.col("path"), RULES if rules is None else rules)
    return (
        pages.select(own.alias("src"), F.explode(F.array_distinct(found)).alias("url"))
        .select("src", host.alias("dst"), path.alias("path"))
        .where("src != dst AND src != ''")
        .select("src", "dst", *_seeds(verdict))
        .groupBy("src", "dst")
        .agg(F.max("good").alias("good"), F.max("bad").alias("bad"))
    )


def _seeds(verdict: Column) -> tuple[Column, Column]:
    """1 where a rule allows, 1 where one blocks, else 0."""
    return tuple(
        F.coalesce((verdict == kind).cast("int"), F.lit(0)).alias(name)
        for kind, name in (("allow", "good"), ("block", "bad"))
    )


def spread(
    hosts: DataFrame, links: DataFrame, rounds: int = 1000, damping: float = 0.85, settled: float = 1e-9
) -> DataFrame:
    """`host, bad, trust, distrust` where both walks have settled.

    `hosts` has `host, good, bad` (seed weights that sum to 1, or 0 without seeds).
    Trust is split over a host's links, distrust over the links that lead to it.
    Each round changes the sum by at most `damping` times the change before, so what is
    still to come is bounded; rounds end when that is at most `settled` over all hosts.
    """
    links = links.select("src", "dst")
    out = links.groupBy("src").agg(F.count(F.lit(1)).alias("n_out"))
    into = links.groupBy("dst").agg(F.count(F.lit(1)).alias("n_in"))
    edges = staged(links.join(out, "src").join(into, "dst"), "host-links")
    ranks = staged(hosts.select("host", "good", "bad", F.col("good").alias("trust"), F.col("bad").alias("distrust")), "ranks")
    for _ in range(rounds):
        forth = edges.join(ranks.select(F.col("host").alias("src"), "trust"), "src").where("trust > 0")
        back = edges.join(ranks.select(F.col("host").alias("dst"), "distrust"), "dst").where("distrust > 0")
        zero = F.lit(0.0)
        flow = forth.select(
            F.col("dst").alias("host"), (F.col("trust") / F.col("n_out")).alias("t"), zero.alias("d")
        ).unionByName(
            back.select(F.col("src").alias("host"), zero.alias("t"), (F.col("distrust") / F.col("n_in")).alias("d"))
        )
        flow = flow.groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))

        def step(seed: str, got: str) -> Column:
            return (1 - damping) * F.col(seed) + damping * F.coalesce(F.col(got), F.lit(0.0))

        after = staged(
            ranks.join(flow, "host", "left").select(
                "host", "good", "bad", step("good", "t").alias("trust"), step("bad", "d").alias("distrust"),
                (F.abs(step("good", "t") - F.col("trust")) + F.abs(step("bad", "d") - F.col("distrust"))).alias("moved"),
            ),
            "ranks",
        )
        drop(ranks)
        ranks = after
        moved = ranks.agg(F.sum("moved")).first()[0] or 0.0
        if damping * moved <= (1 - damping) * settled:
            break
    else:
        raise RuntimeError(f"host ranks did not settle within {rounds} rounds")
    return ranks.select("host", "bad", "trust", "distrust")


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] | None = None,
    rounds: int = 1000,
    damping: float = 0.85,
    least: float = 1.0,
    ratio: float = 1.0,
) -> DataFrame:
    """`page_id, host, path, rule, verdict, trust, distrust` per row of `pages`.

    A fitting rule decides. Any other url is blocked if the distrust that its host
    received over links (its own seed left out, since a rule that blocks one path of
    a host says nothing of the others) exceeds `least` times an equal share over all
    hosts and `ratio` times its trust. Else it is allowed, so hosts without links and
    urls without a host are. The walks go on until a thousandth of that share is left to
    move, and raise after `rounds`. Needs columns
    `page_id, url, html`, any of which may be null; rows that repeat stay rows.
    """
    rules = RULES if rules is None else rules
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    ruled = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    links = staged(host_links(pages, rules), "links")
    # Pages and linked urls alike, as a host may be linked to without a page here.
    own = ruled.where("host != ''").select("host", *_seeds(F.col("ruled")))
    linked = links.select(F.col("dst").alias("host"), "good", "bad")
    named = own.unionByName(linked).groupBy("host").agg(F.max("good").alias("good"), F.max("bad").alias("bad"))
    named = staged(named, "hosts")
    n, good, bad = named.agg(F.count(F.lit(1)), F.sum("good"), F.sum("bad")).first()
    hosts = named.select(
        "host", (F.col("good") / max(1, good or 0)).alias("good"), (F.col("bad") / max(1, bad or 0)).alias("bad")
    )
    ranks = spread(hosts, links, rounds, damping, 1e-3 * (least if least > 0 else 1.0) / max(1, n))
    received = F.col("distrust") - (1 - damping) * F.col("bad")
    suspect = (received > least / max(1, n)) & (received > ratio * F.col("trust"))
    judged = ruled.join(ranks, "host", "left")
    own = F.when(F.coalesce(suspect, F.lit(False)), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "trust", "distrust"
    )
