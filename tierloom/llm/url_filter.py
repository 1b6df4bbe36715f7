"""URL filters: prefix rules for hosts and paths, and a list of canonical URLs behind a blocked Bloom filter.

A rule names a host and a path prefix; it fits the host and its subdomains, and the longest fitting rule decides.
Other URLs are blocked if their canonical form is listed. The Bloom filter passes most of the URLs that are not
listed at once, without a shuffle. What it lets through is reduced to distinct URLs and joined exactly with the
list, which removes the false positives. The answer is joined back: broadcast if its measured size allows, else with hot
URLs dealt to several tasks.

Defined results: host and path of a null URL, or one without ``://``, are empty; it fits no rule, is never
listed and so is allowed. Of two fitting rules of one length the one with the longer host wins. Repeated rows get
equal answers. An empty list blocks nothing, an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tierloom.llm import bloom
from tierloom.llm.shared import store

# Largest table of confirmed URLs that is broadcast, with ROW_BYTES for each row besides its text.
BROADCAST_BYTES = 64_000_000
ROW_BYTES = 100
# Beyond it a URL with more rows than this is dealt to several tasks, and one with a share of less than 1 / HOT is not.
ROWS_PER_PART = 1_000_000
HOT = 10_000
# Query parameters that name no other document.
TRACKING = "^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """A policy kept by hand: host, path prefix with its slash, and ``allow`` or ``block``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _part(url: Column, number: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, number), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a closing slash, and the parameters that matter, sorted; null without a host."""
    host, path = F.regexp_replace(host_of(url), "^www[.]", ""), F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def fitting(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Longest rule that fits, as a struct of ``rule`` and ``verdict``; null if none does."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def judge(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule``, ``verdict``, ``canonical`` and ``listed``; ``listed`` has one column of URLs."""
    url_col, keys = F.col(f"`{url}`"), listed.select(canonical(F.col(listed.columns[0])).alias("key")).where("key is not null").distinct()
    keys = store(keys, "listed")
    blocks = bloom.block_count(keys.count())
    filter_ = store(bloom.build(keys, "key", blocks), "bloom")

    read = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"), canonical(url_col).alias("key"))
    ruled = read.withColumn("fit", fitting(F.col("host"), F.col("path"), rules))
    asked = bloom.probe(ruled.withColumn("ask", F.when(F.col("fit").isNull(), F.col("key"))), "ask", filter_, blocks)

    maybe = asked.where("maybe")
    confirmed = store(maybe.groupBy("key").agg(F.count("*").alias("n")).join(keys, "key", "left_semi"), "confirmed")
    hits = _met(maybe, confirmed)

    columns = ["id", "host", "path", "fit", "key"]
    judged = asked.where("not maybe").select(*columns, F.lit(False).alias("listed")).unionByName(hits.select(*columns, F.col("_key").isNotNull().alias("listed")))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), F.col("key").alias("canonical"), "listed")


def _met(maybe: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Rows with ``_key``, their URL if it is among the confirmed ones, which have the number ``n`` of their rows.

    A small table is broadcast. Beyond that both sides are shuffled, and the rows of URLs that have very many are dealt to
    as many parts as they need; only these URLs, fewer than ``HOT``, are made known to all tasks.
    """
    names = confirmed.select(F.col("key").alias("_key"), "n")
    urls, size, rows = names.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_key")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if size + urls * ROW_BYTES <= BROADCAST_BYTES:
        return maybe.join(F.broadcast(names.drop("n")), F.col("key") == F.col("_key"), "left")
    names = names.withColumn("_parts", F.ceil(F.col("n") / max(ROWS_PER_PART, rows // HOT)).cast("int"))
    many = names.where("_parts > 1").select(F.col("_key").alias("_many"), F.col("_parts").alias("_of"))
    dealt = maybe.join(F.broadcast(many), F.col("key") == F.col("_many"), "left")
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("_of", F.lit(1))).cast("int"))
    copied = names.select("_key", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_copy"))
    return dealt.join(copied.hint("merge"), (F.col("key") == F.col("_key")) & (F.col("_part") == F.col("_copy")), "left")


def urls_of_link_pages(pages: DataFrame, characters: int, url: str = "url", html: str = "html") -> DataFrame:
    """URLs of pages with more than one link for so many characters of HTML: a list that no URL gives away.

    A page without HTML is not listed.
    """
    content, link = F.col(f"`{html}`"), F.lit("<a ")
    links = (F.length(content) - F.length(F.replace(content, link, F.lit("")))) / 3
    return pages.where(links * characters > F.length(content)).select(F.col(f"`{url}`").alias("url"))


def urls_on_hosts_with(pages: DataFrame, words: Sequence[str], url: str = "url") -> DataFrame:
    """URLs whose host has one of the words between its dots and hyphens: a list for a table without one."""
    parts = F.split(host_of(F.col(f"`{url}`")), "[.-]")
    return pages.where(F.arrays_overlap(parts, F.array(*map(F.lit, words)))).select(F.col(f"`{url}`").alias("url"))
