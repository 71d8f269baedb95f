"""URL filters: a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textloom.llm.common import map_batches

#: A rule list beyond this many characters isn't broadcast but refused.
MAX_RULE_CHARS = 64 * 1024 * 1024
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class UrlTrie:
    """Rules (verdict, host, path). A host node holds the paths of the rules that end there, as a trie of whole
    segments whose last part, which may be cut within a segment, is kept apart."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict}")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})  # None: no label has this name
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            tails = node.setdefault(None, {})
            if tails.get(rest, ("", verdict))[1] == "block":
                verdict = "block"
            tails[rest] = (host + path, verdict)

    @staticmethod
    def _longest_path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            tails = node.get(None)
            if tails:
                fits = [rest for rest in tails if segment.startswith(rest)]
                if fits:
                    best = tails[max(fits, key=len)]
            node = node.get(segment)
            if node is None:
                break
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits: the deepest host, then the longest path."""
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                best = self._longest_path(node[None], segments) or best
        return best


def judge_urls(df: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", url_col: str = "url",
               id_col: str = "page_id") -> DataFrame:
    """id, host, path, rule, verdict of every row. `rules`: (allow or block, host, path).

    A rule fits its host and all subdomains if the path starts with the rule's. The longest wins, by host labels, then
    by path; of an allow and a block entry for the same place the block entry holds. Urls that no rule fits get
    `default` and a null rule, so do null urls and those without `://`. Rows may repeat, ids may be null; other columns
    of `df` are not looked at. The rules are a list of the caller's; beyond MAX_RULE_CHARS they are refused.
    """
    if sum(len(h) + len(p) for _, h, p in rules) > MAX_RULE_CHARS:
        raise ValueError("too many rules to broadcast")
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))
    picked = df.select(df[id_col].alias("_id"), host_of(df[url_col]).alias("host"), path_of(df[url_col]).alias("path"))
    key = picked.schema["_id"].dataType.simpleString()

    def task():
        def apply(b: pa.RecordBatch) -> pa.RecordBatch:
            match = trie.value.match
            found = [match(h, p) or (None, default) for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            return pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())],
                names=["_id", "host", "path", "rule", "verdict"])

        return apply

    out = map_batches(picked, task, f"_id {key}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("_id", id_col)
