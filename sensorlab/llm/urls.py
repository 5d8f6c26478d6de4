"""URL filter: a trie over reversed host labels, then path segments, with the longest matching rule deciding.

The trie is built from the rules on the driver and sent to the tasks; its size is bounded by ``MOST_RULES``, and
longer rule lists go in several tries whose answers are compared by the same order.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorlab.llm.common import in_batches

#: Rules of one trie; a longer list is dealt out over several.
MOST_RULES = 100_000

#: A url's host stands after the first "://", its path after the host.
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parse_rule(rule: str) -> tuple[list[str], list[str]]:
    """Reversed host labels and path segments of a rule such as ``example.com/en/`` (no path: every path)."""
    host, slash, path = rule.partition("/")
    return host.split(".")[::-1], (slash + path).split("/")


def build_trie(rules: list[tuple[str, str]]) -> dict:
    """Nested dicts by host label; under "/" a dict by path segment; under "tails" what the next segment starts with.

    A rule given twice keeps its block verdict.
    """
    root: dict = {}
    for rule, verdict in rules:
        labels, segments = parse_rule(rule)
        node = root
        for label in labels:
            node = node.setdefault(("host", label), {})
        for segment in segments[:-1]:
            node = node.setdefault(("path", segment), {})
        tails = node.setdefault("tails", {})
        if tails.get(segments[-1], (rule, "allow"))[1] != "block":
            tails[segments[-1]] = (rule, verdict)
    return root


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule (in characters; then the one with the longer host) that fits host and path."""
    best, segments, node = None, path.split("/"), trie
    for depth, label in enumerate(host.split(".")[::-1], 1):
        node = node.get(("host", label))
        if node is None:
            break
        below = node
        for segment in segments:
            for tail, found in below.get("tails", {}).items():
                if segment.startswith(tail):
                    rank = (len(found[0]), depth)
                    if best is None or rank > best[0]:
                        best = rank, found
            below = below.get(("path", segment))
            if below is None:
                break
    return best


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow", url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """The columns in ``keep`` (default: page_id) with host, path, rule (null: none fits) and verdict of each url.

    The host is lower-cased (A-Z) and keeps a port or user part; a rule fits its host and all subdomains where the
    path starts with the rule's path. A null url, or one without "://", has empty host and path and takes the
    default verdict, as does any url that no rule fits. Repeated rows stay; an empty table gives no rows; a page
    column named as a result column is replaced unless it is in ``keep``.
    """
    keep = ["page_id"] if keep is None else keep
    spark = pages.sparkSession
    ordered = sorted(set(rules))
    tries = spark.sparkContext.broadcast([build_trie(ordered[k : k + MOST_RULES]) for k in range(0, len(ordered), MOST_RULES)])
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, URL, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parsed = pages.select(*keep, host.alias("host"), F.regexp_extract(text, URL, 2).alias("path"))

    def judge(batch):
        known, named, verdicts = {}, [], []
        for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
            # What a rule can see of a long path ends with the trie, so hosts without rules cost one lookup.
            best = max(filter(None, (match(t, host, path) for t in tries.value)), default=None)
            named.append(best and best[1][0])
            verdicts.append(best[1][1] if best else default)
        yield {**{c: batch.column(c) for c in batch.schema.names}, "rule": named, "verdict": verdicts}

    shape = parsed.schema.simpleString()[7:-1]
    arrow = _arrow_schema(parsed).append(pa.field("rule", pa.string())).append(pa.field("verdict", pa.string()))
    return parsed.mapInArrow(in_batches(judge, arrow), ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in parsed.schema), "rule string", "verdict string"])) if shape else parsed


def _arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)
