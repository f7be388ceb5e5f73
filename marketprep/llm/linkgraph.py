"""URL filters with link-graph propagation, in DataFrame operations only.

Rules on host and path decide first.  For all other pages the host decides:
trust spreads by personalised PageRank from hosts with allowed pages along the
host edges, distrust from hosts with blocked pages against them, and a host
whose distrust exceeds its trust is blocked.

Host edges are the hyperlinks of the pages (summed per pair of hosts before
anything else, so a hot host is few rows) and, both ways, each host and its
parent domain down to two labels.  Mass at hosts without edges leaves.

Defined cases: a null url, or one without ``://``, has an empty host and path,
which no rule fits and which is allowed; null html has no links; repeated rows
each give a row; an empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import write_table

# (action, host, path)
RULES: tuple[tuple[str, str, str], ...] = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
DAMPING = 0.85
# Rounds of the registered query, which its SQL states.
ROUNDS = 8
# Without a number of rounds: the summed change of all scores that ends them.
TOLERANCE = 1e-6
# Rounds between two written tables: keeps plans and lineage short.
CUT_EVERY = 4
# Distrust over trust from which a host is blocked.
RATIO = 1.0

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def _rest(url: str) -> Column:
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.substring(F.col(url), at + F.lit(3), F.length(F.col(url)))).otherwise(F.lit(""))


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, SMALL), F.lit(""))


def path_of(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """``(rule, action)`` of the longest rule that fits, else nulls."""
    rule = action = F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def host_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst, w)``: hyperlinks between hosts, and parent domains."""
    links = (pages.where("host <> ''")
             .select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("d"))
             .select("src", F.translate("d", UPPER, SMALL).alias("dst")).where("src <> dst")
             .groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")))
    names = pages.select("host").unionByName(links.select(F.col("dst").alias("host"))).distinct() \
        .where(~F.col("host").rlike(r"^[0-9.:]*$"))
    label = F.split("host", r"\.")
    steps = (names.select(label.alias("l")).where(F.size("l") > 2)
             .select("l", F.explode(F.sequence(F.lit(1), F.size("l") - 2)).alias("k"))
             .select(F.array_join(F.slice("l", F.col("k"), F.size("l")), ".").alias("a"),
                     F.array_join(F.slice("l", F.col("k") + 1, F.size("l")), ".").alias("b")).distinct())
    tree = steps.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        steps.select(F.col("b").alias("src"), F.col("a").alias("dst"))).withColumn("w", F.lit(1.0))
    return links.unionByName(tree).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def _change(now: DataFrame, old: DataFrame) -> float:
    """Summed absolute difference of two tables of scores."""
    both = now.unionByName(old.select("kind", "host", (-F.col("score")).alias("score")))
    return both.groupBy("kind", "host").agg(F.sum("score").alias("x")).agg(F.sum(F.abs("x"))).first()[0] or 0.0


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING,
              tolerance: float = TOLERANCE) -> DataFrame:
    """``(kind, host, score)``: PageRank of each kind from its seeds
    ``(kind, host, seed)``; kind ``trust`` follows the edges, kind
    ``distrust`` goes against them.

    Without ``rounds`` it ends when the scores change by ``tolerance`` or less
    in all between two written tables.  What moves shrinks by ``damping`` a
    round, so that comes after about ``log(tolerance) / log(damping)`` rounds
    at most, however long the chains of hosts are."""
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "w").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "w"))
    out = both.groupBy("kind", "a").agg(F.sum("w").alias("all"))
    flow = write_table(both.join(out, ["kind", "a"]).select("kind", "a", "b", (F.col("w") / F.col("all")).alias("share")),
                       "flow")
    total = seeds.groupBy("kind").agg(F.sum("seed").alias("total"))
    start = write_table(seeds.join(total, "kind").select("kind", "host", (F.col("seed") / F.col("total")).alias("s")),
                        "seeds")
    base = start.select("kind", "host", (F.lit(1 - damping) * F.col("s")).alias("score"))
    now = start.select("kind", "host", F.col("s").alias("score"))
    last = now
    for k in range(1, rounds + 1) if rounds is not None else count(1):
        moved = (flow.join(now.select("kind", F.col("host").alias("a"), "score"), ["kind", "a"])
                 .select("kind", F.col("b").alias("host"), (F.lit(damping) * F.col("share") * F.col("score")).alias("score")))
        now = moved.unionByName(base).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if k % CUT_EVERY == 0 and k != rounds:
            now = write_table(now, "scores")
            if rounds is None and _change(now, last) <= tolerance:
                break
            last = now
    return now


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, rounds: int | None = None,
          damping: float = DAMPING, ratio: float = RATIO, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, a row per page; scores
    propagate to convergence unless ``rounds`` are given."""
    src = pages.select(F.col(id_col).alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"),
                       F.col(html_col).alias("html"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    edges = host_edges(src.select("host", "html"))
    ruled = src.select("page_id", "host", "path", rule.alias("rule"), action.alias("action"))
    seeds = (ruled.where("action is not null and host <> ''")
             .select(F.when(F.col("action") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
             .groupBy("kind", "host").agg(F.count("*").cast("double").alias("seed")))
    scores = propagate(edges, seeds, rounds, damping)
    hosts = scores.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("t"),
                                       F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("d"))
    bad = write_table(hosts.where(F.col("d") > F.lit(ratio) * F.col("t")).select("host", F.lit("block").alias("mark")),
                      "blocked")
    return ruled.join(bad, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("action", "mark", F.lit("allow")).alias("verdict"))


def oracle_sql(rounds: int = ROUNDS, damping: float = DAMPING, ratio: float = RATIO) -> str:
    """The same for DuckDB, rounds unrolled (RULES as they are above)."""
    low = f"translate({{}}, '{UPPER}', '{SMALL}')"
    rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    case_rule = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{}}'".format(f"{h}{p}")
        for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    case_act = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{a}'"
        for a, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    link = LINK.replace("'", "''")
    q = f"""
WITH src AS (
  SELECT page_id, coalesce({low.format("regexp_extract(rest, '^([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, html
  FROM (SELECT page_id, html, {rest} AS rest FROM pages)),
ruled AS (
  SELECT page_id, host, path, CASE {case_rule} END AS rule, CASE {case_act} END AS action FROM src),
links AS (
  SELECT host AS src, {low.format('d')} AS dst, count(*)::DOUBLE AS w
  FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS d FROM src WHERE host <> '')
  WHERE host <> {low.format('d')} GROUP BY 1, 2),
names AS (
  SELECT DISTINCT string_split(host, '.') AS l FROM (SELECT host FROM src UNION SELECT dst FROM links)
  WHERE NOT regexp_matches(host, '^[0-9.:]*$')),
steps AS (
  SELECT DISTINCT array_to_string(l[k:], '.') AS a, array_to_string(l[k + 1:], '.') AS b
  FROM (SELECT l, unnest(range(1, len(l) - 1)) AS k FROM names WHERE len(l) > 2)),
edges AS (
  SELECT src, dst, sum(w) AS w FROM (
    SELECT * FROM links UNION ALL SELECT a, b, 1.0 FROM steps UNION ALL SELECT b, a, 1.0 FROM steps) GROUP BY 1, 2),
both_ways AS (SELECT 'trust' AS kind, src AS a, dst AS b, w FROM edges
              UNION ALL SELECT 'distrust', dst, src, w FROM edges),
flow AS (SELECT kind, a, b, w / sum(w) OVER (PARTITION BY kind, a) AS share FROM both_ways),
seeds AS (
  SELECT kind, host, seed / sum(seed) OVER (PARTITION BY kind) AS s FROM (
    SELECT CASE WHEN action = 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*)::DOUBLE AS seed
    FROM ruled WHERE action IS NOT NULL AND host <> '' GROUP BY 1, 2)),
r0 AS (SELECT kind, host, s AS score FROM seeds)"""
    for k in range(1, rounds + 1):
        q += f""",
r{k} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM (
  SELECT f.kind, f.b AS host, {damping} * f.share * r.score AS score
  FROM flow f JOIN r{k - 1} r ON f.kind = r.kind AND f.a = r.host
  UNION ALL SELECT kind, host, (1 - {damping}) * s FROM seeds) GROUP BY 1, 2)"""
    return q + f""",
bad AS (SELECT host FROM r{rounds} GROUP BY host
        HAVING sum(CASE WHEN kind = 'distrust' THEN score ELSE 0 END)
               > {ratio} * sum(CASE WHEN kind = 'trust' THEN score ELSE 0 END))
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' END, 'allow') AS verdict
FROM ruled"""
