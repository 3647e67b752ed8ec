"""URL filter: listed rules first, then a character language-model ratio, in DataFrame functions alone.

Rules name a host and the beginning of a path; a rule fits its host and all subdomains if the path starts with
the rule's, and the longest fitting rule decides.

All other addresses are judged by two smoothed variable-order Markov models over the characters of host and
path, one learnt from accepted and one from rejected addresses (those the rules decide).  The probability of a
character after a context of up to ``ORDER`` characters is interpolated from the empty context upwards by
Witten-Bell smoothing: each context trusts its own counts by ``n / (n + t)``, n its characters and t its
different ones, and the shorter context for the rest; below the empty context all ``ALPHABET`` characters are
alike.  The score is the difference of the log-likelihoods divided by the address's length.  The verdict is by
a threshold calibrated on the quarter of the decided addresses that the models did not learn from (ids divisible by four): the
midpoint between neighbouring scores that errs least often, the one nearest 0 among equals.

Logarithms are kept as whole millionths, so sums don't depend on their order.

How it runs: counts of (class, context, character) are pre-aggregated by each task before they are shuffled;
the score of each different (context, character) is computed once.  Those that make up at least one in ``HEAVY``
of all characters (there can be no more than ``HEAVY`` of them, whatever the input), such as a beginning that all addresses share, are broadcast with
their scores and looked up where the addresses are; the characters of all others meet the table of scores in a shuffled join
in which no key has more than that share.  Tables of contexts and scores grow with the number of different contexts, not of
addresses, and are never collected; only the calibrated threshold is.

Defined results: null, or without ``://``: host and path are empty, no rule fits, the score is 0; if one of the
classes has no address to learn from, or the models have no held-out address, the threshold is 0 and an
address at or above the threshold is allowed; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._spark import cut

ORDER = 4
ALPHABET = 256
#: A character after its context is broadcast if it makes up one in so many of all.
HEAVY = 10_000
#: Stands before the first and after the last character; no address holds it.
EDGE = "\u0001"
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def address(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    found = F.instr(url, "://")
    rest = F.when(found > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at = text.index("/") if "/" in text else len(text)
        host, path = text[:at], text[at:]
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, text).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _grams(rows: DataFrame, order: int) -> DataFrame:
    """A row for each character of ``address`` and its end: the ``order`` characters before it, and itself."""
    at = F.explode(F.sequence(F.lit(1), F.length("address") + 1))
    padded = F.concat(F.lit(EDGE * order), "address", F.lit(EDGE))
    return rows.withColumn("padded", padded).withColumn("at", at).withColumn("gram", F.expr(f"substring(padded, at, {order + 1})")).drop("padded", "at")


def _ratio(grams: DataFrame, order: int, alphabet: int) -> DataFrame:
    """``gram`` and ``ratio`` (millionths of the log-likelihood difference) of each different gram.

    ``grams``: gram, allow, block, the class's counts, zero for grams of other addresses.
    """
    scored = grams
    start = {c: F.lit(1.0 / alphabet) for c in ("allow", "block")}
    for k in range(order + 1):
        part = F.expr(f"substring(gram, {order - k + 1}, {k + 1})")
        shorter = grams.groupBy(part.alias("g")).agg(*(F.sum(c).alias(c) for c in ("allow", "block"))).withColumn("h", F.expr(f"substring(g, 1, {k})"))
        of_context = shorter.groupBy("h").agg(*(F.sum(c).alias("n_" + c) for c in ("allow", "block")), *(F.sum((F.col(c) > 0).cast("long")).alias("t_" + c) for c in ("allow", "block")))
        counts = shorter.join(of_context, "h").select("g", *(F.col(c).alias("c_" + c) for c in ("allow", "block")), *(x + c for c in ("allow", "block") for x in ("n_", "t_")))
        scored = scored.withColumn("g", part).join(counts, "g").withColumns(
            {"p_" + c: F.when(F.col("n_" + c) > 0, (F.col("c_" + c) + F.col("t_" + c) * start[c]) / (F.col("n_" + c) + F.col("t_" + c))).otherwise(start[c]) for c in start}
        ).select("gram", "allow", "block", "p_allow", "p_block")
        start = {c: F.col("p_" + c) for c in start}
    million = lambda p: F.round(F.log(p) * 1_000_000).cast("long")
    return scored.select("gram", (million("p_allow") - million("p_block")).alias("ratio"))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` of each row."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    host, path = address(F.col("url"))
    name, verdict = rule(rules)
    rows = rows.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": name, "listed": verdict})
    rows = rows.withColumn("address", F.translate(F.concat("host", "path"), EDGE, "")).withColumn("fold", F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(4)))

    learn = _grams(rows.select("address", "listed", "fold"), order)
    of_class = lambda c: F.sum(((F.col("listed") == c) & (F.col("fold") != 0)).cast("long"))
    counts = cut(learn.groupBy("gram").agg(F.coalesce(of_class("allow"), F.lit(0)).alias("allow"), F.coalesce(of_class("block"), F.lit(0)).alias("block"), F.count("*").alias("held")))
    seen = counts.agg(F.sum("allow").alias("a"), F.sum("block").alias("b"), F.sum("held").alias("held")).first()
    ratio = cut(_ratio(counts, order, ALPHABET).join(counts.select("gram", (F.col("held") * HEAVY >= F.lit(seen.held or 0)).alias("heavy")), "gram"))
    heavy = F.broadcast(ratio.where("heavy").select("gram", "ratio"))

    # equal addresses are scored once
    decided = lambda c: F.sum((F.coalesce(F.col("listed") == c, F.lit(False)) & (F.col("fold") == 0)).cast("long"))
    distinct = cut(rows.groupBy("address").agg(decided("allow").alias("good"), decided("block").alias("bad")))
    letters = _grams(distinct, order).join(heavy, "gram", "left")
    near = letters.where("ratio is not null").select("address", "good", "bad", "ratio")
    far = letters.where("ratio is null").drop("ratio").join(ratio.where("not heavy"), "gram").select("address", "good", "bad", "ratio")
    summed = near.union(far).groupBy("address").agg(F.sum("ratio").alias("total"), F.any_value("good").alias("good"), F.any_value("bad").alias("bad"))
    scores = cut(summed.select("address", F.when(F.length("address") > 0, F.floor(F.col("total") / (F.length("address") + 1))).otherwise(F.lit(0)).alias("score"), "good", "bad"))

    limit = _threshold(scores) if seen.a and seen.b else 0
    judged = rows.join(scores.select("address", "score"), "address", "left")
    found = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("listed", found).alias("verdict"), "score")


def _threshold(scores: DataFrame) -> int:
    """The least score that is allowed: between two neighbouring ranges, 0 if it lies there, else the middle.

    Scores are whole millionths; errors are counted over ranges of a thousandth, at most a few ten thousand
    rows however many addresses there are.
    """
    held = scores.where("good + bad > 0").groupBy(F.floor(F.col("score") / 1000).alias("bin")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    order = Window.orderBy("bin")
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    errors = held.withColumns({"errors": F.coalesce(F.sum("good").over(below), F.lit(0)) + F.sum("bad").over(after), "low": F.coalesce(F.lag("bin").over(order) + 1, F.col("bin"))})
    cut_at = F.when((F.col("low") <= 0) & (F.col("bin") >= 0), F.lit(0)).otherwise(F.floor((F.col("low") + F.col("bin")) / 2)).cast("long")
    best = errors.withColumn("cut", cut_at).orderBy("errors", F.abs("cut"), "bin").limit(1).collect()
    return int(best[0].cut) * 1000 if best else 0


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))


def _sql() -> str:
    """The same in SQL for this module's ``RULES`` and ``ORDER``."""
    host = "translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    name = verdict = "NULL"
    for text, says in sorted(RULES, key=lambda r: (len(r[0]), r[0])):
        h, p = text[: text.index("/")], text[text.index("/") :]
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        name, verdict = f"CASE WHEN {fits} THEN '{text}' ELSE {name} END", f"CASE WHEN {fits} THEN '{says}' ELSE {verdict} END"
    width = ORDER + 1
    parts = [
        "cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)",
        f"split AS (SELECT page_id, {host} AS host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM cut)",
        f"listed AS (SELECT *, {name} AS rule, {verdict} AS listed, replace(host || path, chr(1), '') AS address, coalesce(page_id, 0) % 4 AS fold FROM split)",
        f"letters AS (SELECT address, listed, fold, substr(repeat(chr(1), {ORDER}) || address || chr(1), CAST(pos AS BIGINT), {width}) AS gram FROM (SELECT *, unnest(range(1, length(address) + 2)) AS pos FROM listed))",
        "s_0 AS (SELECT gram, " + ", ".join(f"count(*) FILTER (listed = '{c}' AND fold <> 0) AS {c}, CAST(1.0 AS DOUBLE) / {ALPHABET} AS p_{c}" for c in ("allow", "block")) + " FROM letters GROUP BY gram)",
    ]
    for k in range(ORDER + 1):
        part = f"substr(gram, {ORDER - k + 1}, {k + 1})"
        parts += [
            f"g_{k} AS (SELECT g, substr(g, 1, {k}) AS h, allow, block FROM (SELECT {part} AS g, sum(allow) AS allow, sum(block) AS block FROM s_0 GROUP BY 1))",
            f"h_{k} AS (SELECT h, " + ", ".join(f"CAST(sum({c}) AS DOUBLE) AS n_{c}, CAST(count(*) FILTER ({c} > 0) AS DOUBLE) AS t_{c}" for c in ("allow", "block")) + f" FROM g_{k} GROUP BY h)",
            f"s_{k + 1} AS (SELECT gram, " + ", ".join(f"CASE WHEN n_{c} > 0 THEN (CAST(g_{k}.{c} AS DOUBLE) + t_{c} * p_{c}) / (n_{c} + t_{c}) ELSE p_{c} END AS p_{c}" for c in ("allow", "block")) + f" FROM s_{k} JOIN g_{k} ON g = {part} JOIN h_{k} USING (h))",
        ]
    parts += [
        f"ratio AS (SELECT gram, CAST(round(ln(p_allow) * 1000000) AS BIGINT) - CAST(round(ln(p_block) * 1000000) AS BIGINT) AS ratio FROM s_{ORDER + 1})",
        f"places AS (SELECT address, substr(repeat(chr(1), {ORDER}) || address || chr(1), CAST(pos AS BIGINT), {width}) AS gram FROM (SELECT address, unnest(range(1, length(address) + 2)) AS pos FROM (SELECT DISTINCT address FROM listed)))",
        "scores AS (SELECT address, CASE WHEN length(address) > 0 THEN CAST(floor(CAST(sum(ratio) AS DOUBLE) / (length(address) + 1)) AS BIGINT) ELSE 0 END AS score FROM places JOIN ratio USING (gram) GROUP BY address)",
        "bins AS (SELECT CAST(floor(score / 1000) AS BIGINT) AS bin, count(*) FILTER (listed = 'allow') AS good, count(*) FILTER (listed = 'block') AS bad FROM listed JOIN scores USING (address) WHERE fold = 0 AND listed IS NOT NULL GROUP BY 1)",
        "errors AS (SELECT bin, coalesce(sum(good) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + sum(bad) OVER (ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS errors, coalesce(lag(bin) OVER (ORDER BY bin) + 1, bin) AS low FROM bins)",
        "cuts AS (SELECT *, CASE WHEN low <= 0 AND bin >= 0 THEN 0 ELSE CAST(floor((low + bin) / 2.0) AS BIGINT) END AS cut FROM errors)",
        "lim AS (SELECT CASE WHEN (SELECT sum(allow) > 0 AND sum(block) > 0 FROM s_0) THEN coalesce((SELECT cut * 1000 FROM cuts ORDER BY errors, abs(cut), bin LIMIT 1), 0) ELSE 0 END AS least)",
    ]
    return "WITH " + ",\n".join(parts) + "\nSELECT page_id, host, path, rule, coalesce(listed, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict, score FROM listed JOIN scores USING (address), lim"


OP2_SQL = _sql()
