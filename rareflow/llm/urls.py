"""Allow and block rules for URLs in a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a url is that no rule fits.
DEFAULT = "allow"

Rule = tuple[str, str, str]


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; the
    path is the rest up to ``?``, ``#`` or the end. Both are empty without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "#?":
        if (cut := rest.find(mark)) >= 0:
            rest = rest[:cut]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), path


class Trie:
    """Rules (verdict, host, path); host labels lead from the last to the first, then whole path segments.

    A rule fits its host and all its subdomains if the path starts with the rule's. The longest
    host and path win together; of equal lengths the longer host, of one host and path the block entry.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"a rule allows or blocks, not {verdict!r}")
            node = self.root
            for label in reversed(host.lower().split(".")) if host else ():
                node = node.setdefault(("label", label), {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault(("segment", segment), {})
            ends = node.setdefault("ends", {})
            if ends.get(last, ("",))[0] != "block":
                ends[last] = (verdict, host + path, len(host))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Verdict and rule of the longest fit."""
        best = None
        segments = path.split("/")
        node = self.root
        labels = reversed(host.split("."))
        while node is not None:
            inner = node
            for segment in segments:
                for last, (verdict, rule, size) in inner.get("ends", {}).items():
                    if segment.startswith(last) and (best is None or (len(rule), size) > best[:2]):
                        best = (len(rule), size, verdict, rule)
                inner = inner.get(("segment", segment))
                if inner is None:
                    break
            label = next(labels, None)
            node = None if label is None else node.get(("label", label))
        return None if best is None else best[2:]


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``; rule is null where the default decides.

    The trie is broadcast; its size is that of the rules, which the caller holds and which do not grow
    with the pages. Only the key and the url are read. Null keys and repeated rows stay.
    """
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = trie.value
        for batch in batches:
            parts = [split_url(u) for u in batch["url"]]
            found = [known.find(h, p) for h, p in parts]
            yield pd.DataFrame({
                "page_id": batch["page_id"],
                "host": [h for h, _ in parts],
                "path": [p for _, p in parts],
                "rule": [None if f is None else f[1] for f in found],
                "verdict": [default if f is None else f[0] for f in found],
            })

    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"))
    return rows.mapInPandas(run, "page_id long, host string, path string, rule string, verdict string")
