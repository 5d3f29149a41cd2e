"""URL filter: a trie over reversed host labels and path segments, longest rule first.

Allow and block rules share one trie. A URL walks its host labels from the right; every node on
that walk may carry a path trie, which the URL's path segments walk in turn. All rules met on the
way fit; the longest one decides, whichever kind it is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmill.llm.common import unused

# The trie is held by every Python worker: about 1 KB a rule, so 200 MB at the most.
MAX_RULES = 200_000
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Rule(NamedTuple):
    host: str
    path: str  # a prefix of the URL's path; empty fits every path
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


class _Node:
    __slots__ = ("hosts", "segments", "prefixes")

    def __init__(self):
        self.hosts: dict[str, _Node] = {}
        self.segments: dict[str, _Node] = {}
        # unfinished last segment -> rule; None where the rule ends before any path
        self.prefixes: dict[str | None, Rule] = {}


class UrlTrie:
    """Of equal rules the last one given counts. Equally long fits: the longer host wins."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = _Node()
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.translate(_LOWER).split(".")):
                node = node.hosts.setdefault(label, _Node())
            if not rule.path:
                node.prefixes[None] = rule
                continue
            *whole, last = rule.path.split("/")
            for segment in whole:
                node = node.segments.setdefault(segment, _Node())
            node.prefixes[last] = rule

    def find(self, host: str, path: str) -> Rule | None:
        best: Rule | None = None
        segments = path.split("/")
        node = self.root
        for label in reversed(host.split(".")):
            node = node.hosts.get(label)
            if node is None:
                break
            for rule in self._fits(node, segments):
                if best is None or (len(rule.text), len(rule.host)) > (len(best.text), len(best.host)):
                    best = rule
        return best

    @staticmethod
    def _fits(node: _Node, segments: list[str]) -> Iterator[Rule]:
        if None in node.prefixes:
            yield node.prefixes[None]
        for segment in segments:
            if node.prefixes:
                for end in range(len(segment) + 1):
                    if rule := node.prefixes.get(segment[:end]):
                        yield rule
            node = node.segments.get(segment)
            if node is None:
                return


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one or for null."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host + path of the deciding rule, else null) and
    ``verdict`` (the rule's, else ``default``).

    A rule fits its host and all subdomains if the URL's path starts with the rule's path. A null
    URL, or one without ``://``, has an empty host and path and gets ``default``; so do all URLs if
    there are no rules. Columns of these four names in ``pages`` are replaced, other columns and
    repeated rows stay. Nothing is shuffled. More than ``MAX_RULES`` rules are an error: apply them
    in parts, each on what the part before let through.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; a broadcast trie may hold {MAX_RULES}")
    shared = pages.sparkSession.sparkContext.broadcast(list(rules))

    @F.pandas_udf("rule string, verdict string")
    def decide(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = UrlTrie(shared.value)
        for hosts, paths in batches:
            found = [trie.find(h, p) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(
                {
                    "rule": pd.Series([r.text if r else None for r in found], dtype=object),
                    "verdict": [r.verdict if r else default for r in found],
                }
            )

    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    address = F.col(f"`{url}`").cast("string")
    split = pages.select(*[F.col(f"`{c}`") for c in kept], host_of(address).alias("host"), path_of(address).alias("path"))
    found = unused(kept, "judged")
    judged = split.withColumn(found, decide("host", "path"))
    return judged.select(*[F.col(f"`{c}`") for c in kept], "host", "path", f"`{found}`.rule", f"`{found}`.verdict")
