"""URL filtering with pattern rules indexed by their rarest literal token.

Two kinds of rules:

* `SiteRule(host, path, verdict)` fits its host and all subdomains of it
  when the URL's path starts with the rule's path. The longest fitting rule
  wins (length of ``host + path``, ties to the smaller text).
* `PatternRule(pattern, verdict)` is a regular expression over the whole
  URL with the literal tokens that every match contains as whole URL tokens
  (a rule whose matches differ in that is split into several rules). It
  decides only where no site rule fits; the first listed rule wins.

Every rule becomes one row of an index: the literal token to look it up by,
and the regular expression to confirm it. The token is the one of the rule
that the fewest URLs of the input hold, counted over all of them, so
frequent tokens such as ``com`` never fetch candidates. URL tokens are
exploded and joined with the index; only fetched candidates run their
regular expression. All of it is DataFrame functions.

The rules are a parameter (a Python list), bounded by `MAX_RULES`; more is
an error, not a silent cut. The index is therefore small and Spark
broadcasts it by its known size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchcost.llm.common import ascii_lower

MAX_RULES = 20_000
TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class SiteRule:
    host: str
    path: str
    verdict: str

    @property
    def label(self) -> str:
        return self.host + self.path

    def regex(self) -> str:
        # matched against "host<newline>path" of the URL
        # (a host has no slash, a path that is not empty starts with one)
        return rf"^(?:[^/]*\.)?\Q{self.host}\E\n\Q{self.path}\E"

    def tokens(self) -> set[str]:
        # The last path token may go on in the URL ("/en" fits "/english"),
        # so it is a literal token only when a delimiter follows it. The
        # host's tokens are delimited at both ends.
        path = self.path.lower()
        whole = [m.group() for m in re.finditer(TOKEN, path) if m.end() < len(path)]
        return set(re.findall(TOKEN, self.host)) | set(whole)


@dataclass(frozen=True)
class PatternRule:
    pattern: str
    verdict: str
    literals: tuple[str, ...]

    @property
    def label(self) -> str:
        return self.pattern

    def regex(self) -> str:
        return self.pattern

    def tokens(self) -> set[str]:
        return {t for x in self.literals for t in re.findall(TOKEN, x.lower())}


#: Default patterns of the method, for URLs that no site rule fits: each
#: names a host label, so its literals are whole tokens of the URL.
DEFAULT_PATTERNS = [
    *[
        PatternRule(rf"(?i)^[^/]*://([^/?#]*\.)?(ads?|adserver|banner)[-.]{track}\.", "block", (track,))
        for track in ("track", "tracker", "tracking")
    ],
    PatternRule(r"(?i)^[^/]*://([^/?#]*\.)?free-(bets|casino|poker)\.", "block", ("free",)),
    PatternRule(r"(?i)^[^/]*://([^/?#]*\.)?(online-)?casino\.", "block", ("casino",)),
    PatternRule(r"(?i)^[^/]*://([^/?#]*[.-])?porn[.-]", "block", ("porn",)),
]
DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without one."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; '' without a host mark."""
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _url_tokens(url: Column, host: Column, path: Column) -> Column:
    text = F.concat_ws("\n", host, path, url)
    return F.array_distinct(F.regexp_extract_all(ascii_lower(text), F.lit(f"({TOKEN})"), F.lit(1)))


def _rule_index(keyed: DataFrame, rules: list) -> DataFrame:
    """One row per rule: its rarest token over all URLs, its regular expression and its rank."""
    spark = keyed.sparkSession
    rows = []
    for i, r in enumerate(rules):
        site = isinstance(r, SiteRule)
        rank = len(r.label) if site else -i
        rows += [(i, site, rank, r.label, r.verdict, r.regex(), t) for t in sorted(r.tokens()) or [""]]
    schema = "rule_no INT, site BOOLEAN, rank INT, label STRING, rule_verdict STRING, regex STRING, token STRING"
    long = spark.createDataFrame(rows, schema)
    # A rule without any literal token is looked up by '', which every URL has.
    seen = keyed.select(F.explode("tokens").alias("token")).join(
        F.broadcast(long.select("token").distinct()), "token", "left_semi"
    )
    counts = seen.groupBy("token").agg(F.count("*").alias("n"))
    # Counts of at most MAX_RULES tokens: small however many URLs there are.
    freq = {r["token"]: r["n"] for r in counts.collect()}
    best: dict[int, tuple] = {}
    for row in rows:
        cost = (freq.get(row[6], 0), row[6])
        if row[0] not in best or cost < best[row[0]][0]:
            best[row[0]] = (cost, row)
    return spark.createDataFrame([row for _, row in best.values()], schema)


def filter_urls(
    df: DataFrame,
    id_col: str,
    url_col: str,
    site_rules: list[SiteRule],
    patterns: list[PatternRule] | None = None,
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """Judge every URL: (id, host, path, rule, verdict), one row per input row.

    `rule` is the label of the winning site rule, else null; `verdict` is
    that rule's, else the first fitting pattern's, else `default`. A null
    URL, or one without ``://``, has an empty host and path and the default
    verdict. Repeated rows come out as often as they went in; other columns
    of the input are not read.
    """
    rules = [*site_rules, *(DEFAULT_PATTERNS if patterns is None else patterns)]
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} may be given as a list")
    # Equal rows are counted before the shuffle, so a page repeated a
    # million times is one row here and is repeated again at the end.
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    pages = pages.groupBy("id", "url").agg(F.count("*").alias("copies"))
    keyed = pages.select(
        "id", "url", "copies", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    with_tokens = lambda d: d.withColumn(
        "tokens", F.array_append(_url_tokens(F.col("url"), F.col("host"), F.col("path")), F.lit(""))
    )
    urls = df.select(F.col(url_col).alias("url"))
    urls = urls.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    index = _rule_index(with_tokens(urls), rules)
    found = (
        with_tokens(keyed)
        .select("id", "url", "copies", "host", "path", F.explode("tokens").alias("token"))
        .join(F.broadcast(index), "token", "left")
    )
    text = F.when(F.col("site"), F.concat_ws("\n", "host", "path")).otherwise(F.col("url"))
    fits = F.coalesce(F.rlike(text, F.col("regex")), F.lit(False))
    choice = F.struct(
        F.col("site").alias("site"),
        F.col("rank").alias("rank"),
        F.struct(F.col("label").alias("label"), F.col("rule_verdict").alias("verdict")).alias("rule"),
    )
    # max prefers site rules, then the longest (first listed for patterns)
    best = found.groupBy("id", "url").agg(
        F.first("copies").alias("copies"),
        F.first("host").alias("host"),
        F.first("path").alias("path"),
        F.max(F.when(fits, choice)).alias("best"),
    )
    return best.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.when(F.col("best.site"), F.col("best.rule.label")).alias("rule"),
        F.coalesce(F.col("best.rule.verdict"), F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
