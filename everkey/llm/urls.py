"""URL filters: pattern rules indexed by their rarest literal token.

A rule is ``(verdict, pattern)``.  ``||`` at the start ties the pattern to a host or any of its subdomains, ``*``
stands for any characters, ``^`` for a separator or the end; everything else is literal.  Rules see the host (A-Z in
lower case), the path and what follows the path.

A rule's literal tokens are the letter-digit runs of its pattern that a matching url must hold as whole tokens.  Each
rule is filed under the one that fewest urls hold, counted over the whole table.  A url's own tokens fetch the rules
filed under them, and only those run their regular expression.  Rules are a hand-written list, so the index is a
constant of the plan; urls never move between tasks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str
    #: Deciding rules stand above all others and name themselves in the result; the longest wins.
    deciding: bool = False

    @property
    def name(self) -> str:
        return self.pattern.removeprefix("||")

    @property
    def regex(self) -> str:
        body = self.name
        out = "^(?:[^/?#]*[.])?" if self.pattern.startswith("||") else ""
        for c in body:
            if c == "*":
                out += "[\\s\\S]*"
            elif c == "^":
                out += "(?:[^0-9A-Za-z._%-]|$)"
            else:
                out += c if c.isalnum() or c in "/_" else f"[{c}]"
        return out

    @property
    def tokens(self) -> list[str]:
        """Runs that are whole tokens of every url the rule fits."""
        body, anchored, found = self.name, self.pattern.startswith("||"), []
        for m in re.finditer("[0-9a-z]+", body):
            before = body[m.start() - 1] if m.start() else "/" if anchored else "*"
            after = body[m.end()] if m.end() < len(body) else "*"
            if before != "*" and after != "*":
                found.append(m.group())
        if not found:
            raise ValueError(f"rule {self.pattern!r} has no whole literal token to be filed under")
        return found


#: The deciding rules of the contract.
BASE_RULES = [
    Rule("block", "||net/", True),
    Rule("allow", "||example.net/en/", True),
    Rule("block", "||example.com/de/", True),
    Rule("allow", "||org/fr/", True),
]

#: Where no deciding rule fits: trackers, shops and log-in pages are blocked, exceptions allow.
PATTERN_RULES = [
    Rule("block", pattern) for pattern in (
        ".ads-track.", ".ads.", "/ads/", "/ad/", "-ads-", ".adserver.", "/adserver/", ".doubleclick.", ".banner.", "/banner/",
        "/banners/", "/popup/", "/popunder/", ".tracker.", "/tracker/", "/tracking/", "/pixel/", "/pixel.", "/beacon/",
        "/beacon.", ".analytics.", "/analytics/", "/affiliate/", "/affiliates/", "/sponsor/", "/sponsored/", "/promo/",
        ".casino.", "-casino.", "/casino/", "/gambling/", "/betting/", ".poker.", "/poker/", ".porn.", "/porn/", "/xxx/",
        "/adult/", "/login/", "/login?", "/signin/", "/signup/", "/register/", "/logout/", "/cart/", "/checkout/",
        "/wp-admin/", "/wp-login.", "/cgi-bin/", "/admin/", "/feed/", "/rss/", "/print/", "/search?", "?sessionid=",
        "&sessionid=", "?phpsessid=", "&phpsessid=", "?replytocom=", "/share?", "/download/*.exe^", "/warez/", "/crack/",
        "/keygen/", "/torrent/", "/spam/", "/phishing/", "/malware/",
    )
] + [
    Rule("allow", pattern) for pattern in ("||docs.*/search?", "||archive.*/feed/", "/ads/research/", "/wiki/*/adult/", "/about/")
]


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def after_host(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([\\s\\S]*)$", 1), F.lit(""))


def _constant(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rarest_tokens(parsed: DataFrame, rules: list[Rule]) -> dict[str, list[Rule]]:
    """Rules by the token that fewest urls hold (ties: the first by code point)."""
    known = sorted({t for r in rules for t in r.tokens})
    held = parsed.select(F.explode(F.array_intersect("_tokens", _constant(known))).alias("token"))
    urls = {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (urls.get(t, 0), t)), []).append(rule)
    return index


def judge(pages: DataFrame, rules: list[Rule] | None = None, url: str = "url", key: str = "page_id") -> DataFrame:
    """``key, host, path, rule, verdict, pattern`` for each row of ``pages``.

    The deciding rule that fits and is longest gives ``rule`` and the verdict (ties: code point order).  Otherwise an
    ``allow`` pattern goes before a ``block`` pattern, and without any the url is allowed; ``pattern`` names the one
    that spoke.  A null url, or one without ``://``, has an empty host and path and is allowed.  Rows are judged one
    by one: repeats get equal results, an empty table gives no rows, other columns are not touched.
    """
    rules = BASE_RULES + PATTERN_RULES if rules is None else rules
    for r in rules:
        if r.verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {r.verdict!r}")
    parsed = (
        pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"))
        .select("_key", host_of(F.col("_url")).alias("_host"), after_host(F.col("_url")).alias("_rest"))
        .select("_key", "_host", F.regexp_extract("_rest", "^[^?#]*", 0).alias("_path"), F.concat("_host", "_rest").alias("_target"))
        .withColumn("_tokens", F.array_distinct(F.split(F.translate("_target", UPPER, LOWER), "[^0-9a-z]+")))
    )
    index = rarest_tokens(parsed, rules)

    def packed(rule: Rule) -> Column:
        rank = len(rule.name) if rule.deciding else 2 if rule.verdict == "allow" else 1
        return F.struct(F.lit(int(rule.deciding)).alias("tier"), F.lit(rank).alias("rank"), F.lit(rule.name).alias("name"),
                        F.lit(rule.verdict).alias("verdict"), F.lit(rule.regex).alias("regex"))

    by_token = F.create_map(*[x for t, rs in sorted(index.items()) for x in (F.lit(t), F.array(*map(packed, rs)))])
    found = (
        parsed.withColumn("_fetched", F.array_intersect("_tokens", _constant(sorted(index))))
        .withColumn("_candidates", F.flatten(F.transform("_fetched", lambda t: F.element_at(by_token, t))))
        .withColumn("_fits", F.filter("_candidates", lambda r: F.regexp(F.col("_target"), r["regex"])))
        .withColumn("_best", F.array_max(F.transform("_fits", lambda r: F.struct(r["tier"], r["rank"], r["name"], r["verdict"]))))
    )
    decided = F.col("_best.tier") == 1
    return found.select(
        F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.when(decided, F.col("_best.name")).alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit("allow")).alias("verdict"),
        F.when(~decided, F.col("_best.name")).alias("pattern"),
    )
