"""URL filter: pattern rules fetched by their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import attach, col, require
from .common import ascii_lower

#: What ``^`` of a glob stands for: an end, or anything but a letter or digit.
EDGE = "(?:^|[^A-Za-z0-9]|$)"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a regular expression on host and path written together.

    ``tokens`` are runs of letters and digits that every matching URL has as
    whole tokens. ``rank`` orders the fitting rules, largest first.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def _tokens(text: str) -> list[str]:
    return [t for t in re.split("[^A-Za-z0-9]+", text.lower()) if t]


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and its subdomains where the URL's path starts with ``path``."""
    tokens = _tokens(host) + _tokens(path)
    if path and path[-1].isalnum() and path.isascii():
        tokens = tokens[: -1 or None]  # the URL's token may go on
    return Rule(
        host + path,
        verdict,
        rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}" + ("" if path else "(?:/|$)"),
        tuple(tokens),
        1_000_000 + len(host + path),
    )


def glob_rule(glob: str, verdict: str) -> Rule:
    """``*`` is any run, ``^`` an edge; all else is literal, case ignored."""
    pattern = "".join({"*": ".*", "^": EDGE}.get(c, re.escape(c)) for c in glob)
    tokens = []
    for found in re.finditer("[A-Za-z0-9]+", glob):
        around = glob[found.start() - 1 : found.start()], glob[found.end() : found.end() + 1]
        if "*" not in around and "" not in around:
            tokens.append(found[0].lower())
    return Rule(glob, verdict, "(?i)" + pattern, tuple(tokens), len(glob))


#: Rules of the contract: host rules, the longest that fits decides.
SITE_RULES = (
    host_rule("com", "/", "allow"),
    host_rule("example.com", "/en/", "block"),
    host_rule("www.example.com", "/en/", "allow"),
    host_rule("net", "/es/", "block"),
    host_rule("net", "/fr/", "block"),
)

#: Pattern rules used where no site rule fits.
TOPIC_RULES = tuple(
    glob_rule(f"^{word}^", "block")
    for word in (
        "adult", "bet", "bets", "betting", "casino", "casinos", "escort", "gambling", "jackpot",
        "lottery", "malware", "nude", "phishing", "poker", "porn", "sex", "slots", "spam",
        "torrent", "viagra", "warez", "xxx",
    )
) + tuple(
    glob_rule(glob, "block")
    for glob in (
        "^link^farm^", "^cheap^pills^", "^wp^login^", "^cgi^bin^", "^free^download^crack^",
        "^doorway^*^redirect^",
    )
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.expr("substring(u, instr(u, '://') + 3)"))
    after = F.coalesce(after, F.lit(""))
    host = ascii_lower(F.regexp_extract(after, "^([^/?#]*)", 1))
    return host, F.regexp_extract(after, "(?s)^[^/?#]*([^?#]*)", 1)


def _url_tokens(host: Column, path: Column) -> Column:
    parts = F.split(ascii_lower(F.concat(host, path)), "[^a-z0-9]+")
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def indexed_rules(targets: DataFrame, rules: tuple[Rule, ...]) -> list[tuple]:
    """Rules with the token that the fewest targets have; ``''`` for a rule without one.

    Only tokens of rules are counted and come to the driver: at most as many
    numbers as the rules have tokens.
    """
    wanted = sorted({t for r in rules for t in r.tokens})
    seen = {}
    if wanted:
        tokens = F.array_intersect(F.col("tokens"), F.array(*[F.lit(t) for t in wanted]))
        counted = targets.select(F.explode(tokens).alias("token")).groupBy("token").count()
        seen = {r["token"]: r["count"] for r in counted.collect()}
    return [
        (min(r.tokens, key=lambda t: (seen.get(t, 0), t), default=""), r.name, r.verdict, r.pattern, r.rank)
        for r in rules
    ]


def filter_urls(
    df: DataFrame,
    url_col: str = "url",
    site_rules: tuple[Rule, ...] = SITE_RULES,
    topic_rules: tuple[Rule, ...] = TOPIC_RULES,
    default: str = "allow",
) -> DataFrame:
    """The input columns and ``url_filter``: struct ``host, path, rule, verdict, topic``.

    ``rule`` names the longest site rule that fits; without one it is null and
    the verdict is that of the longest fitting topic rule (``topic``), else
    ``default``. A null URL or one without ``://`` has an empty host and path and
    gets ``default``. An input column ``url_filter`` is replaced. Equal URLs are judged once; repeated rows all stay.

    Each rule waits under its rarest literal token. The tokens of a URL fetch
    candidate rules by an equality join and only those run their regular
    expression. A rule without any literal token is fetched by every URL. The
    rule table is broadcast only after its size was checked (see ``attach``).
    """
    require(df, [url_col])
    spark = df.sparkSession
    rows = df.select(F.struct(*[col(c) for c in df.columns]).alias("row"), col(url_col).alias("u"))
    host, path = url_parts(F.col("u"))
    rows = rows.select("row", host.alias("host"), path.alias("path"))
    targets = rows.select("host", "path").distinct()
    targets = targets.withColumn("tokens", _url_tokens(F.col("host"), F.col("path")))
    table = indexed_rules(targets, (*site_rules, *topic_rules))
    lookup = spark.createDataFrame(
        table, "token string, name string, verdict string, pattern string, rank long"
    )
    fits = (
        attach(
            targets.select(
                "host", "path", F.explode(F.concat("tokens", F.array(F.lit("")))).alias("token")
            ),
            lookup,
            ["token"],
        )
        .filter(F.expr("concat(host, path) rlike pattern"))
        .groupBy("host", "path")
        .agg(
            F.max_by(F.struct("name", "verdict", "rank"), F.struct("rank", "name")).alias("best"),
        )
    )
    site = F.col("best.rank") >= 1_000_000
    return rows.join(fits, ["host", "path"], "left").select(
        *[F.col("row").getField(c).alias(c) for c in df.columns if c != "url_filter"],
        F.struct(
            "host",
            "path",
            F.when(site, F.col("best.name")).alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
            F.when(~site, F.col("best.name")).alias("topic"),
        ).alias("url_filter"),
    )
