"""URL filter: allow and block entries in a trie over reversed host labels and path segments.

A rule is written as `host/path`. It fits its host and every subdomain if the URL's path starts
with the rule's path. Of the rules that fit, the one with the most host labels wins, then the one
with the longest path; of two equal rules with different verdicts `block` wins.

Rows: a null URL, and one without `://`, has an empty host and path and no rule; its verdict is
the default. Repeated rows are judged alike, an empty table gives an empty table, and input columns
named like the new ones are replaced.
"""

from __future__ import annotations

import pickle

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.llm.text import ASCII_LOWER, text_of

VERDICTS = ("allow", "block")
RESULT = "host string, path string, rule string, verdict string"
#: A trie above this many pickled bytes isn't broadcast; the rules then go through a join.
TRIE_BYTES = 64 << 20


def split_url(url: object) -> tuple[str, str]:
    """Host (ASCII letters in lower case) and path, as in the module's rules."""
    rest = text_of(url)
    at = rest.find("://")
    if at < 0:
        return "", ""
    rest = rest[at + 3:]
    for mark in "?#":
        rest = rest.split(mark, 1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(ASCII_LOWER), slash + path


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(ASCII_LOWER), slash + path


def build_trie(rules: list[tuple[str, str]]) -> dict:
    """Nested dicts: host labels from the right, then under "/" the path's whole segments.

    A path's last piece may be part of a segment, so it is kept apart: a node's "*" maps such
    pieces to (path length, rule, verdict). "*" and "/" can't be labels of a host.
    """
    trie: dict = {}
    for verdict, rule in rules:
        if verdict not in VERDICTS:
            raise ValueError(f"verdict of {rule!r} must be one of {VERDICTS}")
        host, path = split_rule(rule)
        node = trie
        for label in reversed(host.split(".")):
            node = node.setdefault(("label", label), {})
        *whole, last = path.split("/")
        node = node.setdefault("paths", {})
        for piece in whole:
            node = node.setdefault(("piece", piece), {})
        ends = node.setdefault("ends", {})
        if ends.get(last, (0, "", ""))[2] != "block":
            ends[last] = (len(path), rule, verdict)
    return trie


def _best_path(node: dict, path: str) -> tuple[int, str, str] | None:
    best = None
    for piece in path.split("/"):
        ends = node.get("ends")
        if ends:
            longest = min(len(piece), max(map(len, ends)))
            found = next((ends[piece[:n]] for n in range(longest, -1, -1) if piece[:n] in ends), None)
            best = found or best
        node = node.get(("piece", piece))
        if node is None:
            return best
    return best


def look_up(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """Rule and verdict of the longest fit; deeper host nodes go before longer paths."""
    node, best = trie, None
    for label in reversed(host.split(".")):
        node = node.get(("label", label))
        if node is None:
            break
        if "paths" in node:
            best = _best_path(node["paths"], path) or best
    return best and best[1:]


def judge_by_trie(pages: DataFrame, trie: dict, default: str) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast(trie)

    @F.pandas_udf(RESULT)
    def judged(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for url in urls:
            host, path = split_url(url)
            rows.append((host, path, *(look_up(shared.value, host, path) or (None, default))))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)

    return pages.withColumn("__judged", judged("url"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The same split as `split_url`, as column expressions."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^?#]*)", 1)
    host = F.regexp_extract(rest, r"^([^/]*)", 1)
    return (F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.substr(rest, F.length(host) + 1))


def judge_by_join(pages: DataFrame, rules: list[tuple[str, str]], default: str) -> DataFrame:
    """For rule lists too large for a trie in each task: distinct URLs meet rules by host suffix."""
    spark = pages.sparkSession
    table = spark.createDataFrame(
        [(*split_rule(rule), rule, verdict) for verdict, rule in rules],
        "__host string, __prefix string, __rule string, __verdict string")
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rank = F.struct(F.size(F.split("__host", r"\.")), F.length("__prefix"),
                    (F.col("__verdict") == "block").alias("block"))
    best = (
        urls.withColumn("__host", F.explode(suffixes)).join(table, "__host")
        .filter(F.startswith("path", "__prefix"))
        .groupBy(F.col("url").alias("__fit")).agg(F.max_by(F.struct("__rule", "__verdict"), rank).alias("__best"))
    )
    # A null URL fits no rule, so plain equality does; it comes back to its pages by null-safe equality.
    found = urls.join(best, F.col("url") == F.col("__fit"), "left").select(
        F.col("url").alias("__url"), F.struct(
            "host", "path", F.col("__best.__rule").alias("rule"),
            F.coalesce("__best.__verdict", F.lit(default)).alias("verdict")).alias("__judged"))
    return pages.join(found, F.col("url").eqNullSafe(F.col("__url")), "left").drop("__url")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow") -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict` of each `url`.

    The trie is broadcast while its size is under `TRIE_BYTES`; a larger list of rules is joined.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    trie = build_trie(rules)
    judged = (judge_by_trie(pages, trie, default) if len(pickle.dumps(trie)) <= TRIE_BYTES
              else judge_by_join(pages, rules, default))
    return judged.select(*pages.columns, "__judged.*")
